import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.cleaning import (
    blank_to_null,
    class_from_file,
    is_blank,
    lookup,
    safe_date,
    safe_double,
    tokens_to_null,
    yes_no_flag,
)
from millrace.functions.columns import missing_columns, normalize_names, require_columns, select_as
from millrace.functions.measures import (
    average,
    guarded_ratio,
    price_bucket,
    rate,
    rating_class,
    ratio,
    score_tier,
    total,
)
from millrace.functions.rules import (
    WINE_BOUNDS,
    keep_rejects,
    keep_valid,
    reject_counts,
    request_rules,
    row_valid,
    trip_rules,
    within,
)
from millrace.functions.text import (
    CITATION_TYPE,
    any_keyword,
    citation_links,
    feature_link,
    link_bucket,
    link_key,
    request_question,
)
from millrace.functions.timeparts import as_timestamp, day_of, minutes_between, month_part, year_part


def test_name_rules(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Fixed Acidity", "PH", "Timely-Response?"])
    assert normalize_names(df, "features").columns == ["fixed_acidity", "pH", "timely-response?"]
    assert normalize_names(df, "landing").columns == ["fixed_acidity", "ph", "timely_response"]
    assert normalize_names(df, "plain").columns == ["Fixed_Acidity", "PH", "Timely-Response?"]


def test_name_clash_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["Sub-issue", "sub issue"])
    with pytest.raises(ValueError, match="sub_issue"):
        normalize_names(df, "landing")


def test_required_columns_are_named_in_order(spark):
    df = spark.createDataFrame([(1,)], ["b"])
    assert missing_columns(df, ["c", "a", "b"]) == ["a", "c"]
    with pytest.raises(ValueError, match=r"\['a', 'c'\]"):
        require_columns(df, ["c", "a", "b"])
    assert select_as(df, {"new": "b"}).columns == ["new"]


def test_flags(one):
    texts = ["Yes", "y", "TRUE", "1", "no", "N", "false", "0", "maybe", "", None, " yes "]
    expected = [True] * 4 + [False] * 4 + [None] * 4
    assert one(yes_no_flag("t"), [(t,) for t in texts], "t string") == expected


def test_blanks(one):
    rows = [("",), ("  ",), (None,), (" a b ",)]
    assert one(blank_to_null("t"), rows, "t string") == [None, None, None, "a b"]
    assert one(is_blank("t"), rows, "t string") == [True, True, True, False]


def test_null_tokens(one):
    rows = [("NA",), ("N/A",), ("null",), ("",), ("na",), (None,)]
    assert one(tokens_to_null("t"), rows, "t string") == [None, None, None, None, "na", None]


def test_dates(one):
    rows = [("2024-01-31",), ("2024-13-01",), ("",), (None,), ("2024-01-31 10:00:00",)]
    dates = one(safe_date("t"), rows, "t string")
    assert dates == [dt.date(2024, 1, 31), None, None, None, dt.date(2024, 1, 31)]
    assert one(year_part("t"), rows, "t string") == ["2024", "unknown", "unknown", "unknown", "2024"]
    assert one(month_part("t"), rows, "t string") == ["01", "00", "00", "00", "01"]


def test_epoch_units(one):
    assert one(day_of("t", "ms"), [(1704067200000,), (None,)], "t long") == [dt.date(2024, 1, 1), None]
    assert one(day_of("t", "s"), [(1704067200,)], "t long") == dt.date(2024, 1, 1)
    assert one(as_timestamp("t"), [("2024-01-01 10:00:00",), ("x",)], "t string") == [
        dt.datetime(2024, 1, 1, 10),
        None,
    ]


def test_minutes_use_whole_seconds(one):
    minutes = minutes_between(
        F.lit("2024-01-01 00:00:00.9").cast("timestamp"), F.lit("2024-01-01 00:01:30").cast("timestamp")
    )
    assert one(minutes) == 1.5


def test_lookup_and_class(one):
    assert one(lookup("t", {"red": 0, "white": 1}), [("red",), ("rose",), (None,)], "t string") == [0, None, None]
    paths = [("/shared/white.csv",), ("/x/winequality-red.csv",)]
    assert one(class_from_file("t", "red", "red", "white"), paths, "t string") == ["white", "red"]


def test_ratios(one):
    assert one(guarded_ratio("a", "b"), [(4.0, 0.5), (4.0, 2.0)], "a double, b double") == [4.0, 2.0]
    assert one(ratio("a", "b"), [(4.0, 0.0), (4.0, 2.0)], "a double, b double") == [None, 2.0]
    assert one(rate(F.lit(1), F.lit(3))) == 0.3333
    assert one(rate(F.lit(1), F.lit(0))) is None


def test_price_and_rating_limits(one):
    prices = [None, "9.99", "10", "49.99", "50", "199.99", "200", "None"]
    assert one(price_bucket("p"), [(p,) for p in prices], "p string") == [
        "unknown", "low", "medium", "medium", "high", "high", "premium", "unknown",
    ]
    ratings = [None, 2.9, 3.0, 3.9, 4.0, 5.0]
    assert one(rating_class("r"), [(r,) for r in ratings], "r double") == [
        "negative_rating", "negative_rating", "neutral_rating",
        "neutral_rating", "positive_rating", "positive_rating",
    ]
    assert one(score_tier("s"), [(5,), (6,), (7,), (8,), (None,)], "s int") == [0, 1, 1, 2, None]


def test_exact_totals_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e6, -1e6] * 100
    sums = set()
    for seed in range(3):
        df = spark.createDataFrame([(v,) for v in values], "v double").orderBy(F.rand(seed))
        sums.add(df.agg(total("v", 2)).first()[0])
    assert sums == {60.0}
    assert spark.createDataFrame([(1.25,), (1.5,), (None,)], "v double").agg(average("v", 2)).first()[0] == 1.375


def _wine(**changes):
    low = {name: bounds[0] for name, bounds in WINE_BOUNDS.items()}
    return tuple({**low, **changes}.values())


def test_bounds_are_inclusive_and_null_fails(spark):
    schema = ", ".join(f"{name} double" for name in WINE_BOUNDS)
    rows = [_wine(), _wine(quality=9.0), _wine(quality=99.0), _wine(pH=None), _wine(alcohol=17.01)]
    df = spark.createDataFrame(rows, schema)
    rules = within(WINE_BOUNDS)
    assert keep_valid(df, rules).count() == 2
    assert [r[0] for r in df.select(row_valid(rules)).collect()] == [True, True, False, False, False]
    counts = {r.rule: r.rejected for r in reject_counts(df, rules).collect()}
    assert (counts["quality"], counts["pH"], counts["alcohol"], counts["density"]) == (1, 1, 1, 0)
    assert sorted(r.failed_rules[0] for r in keep_rejects(df, rules).collect()) == ["alcohol", "pH", "quality"]


def test_trip_limits(spark):
    rows = [(1.0, 10.0, 1), (1.0, 10.0, 6), (1.0, 10.0, 0), (1.0, 10.0, 7), (0.0, 10.0, 1), (1.0, 500.0, 1),
            (1.0, 499.99, 1), (1.0, 0.0, 1), (None, 10.0, 1)]
    df = spark.createDataFrame(rows, "trip_distance double, fare_amount double, passenger_count int")
    assert keep_valid(df, trip_rules()).count() == 3


def test_request_ranges(spark):
    names = [rule.name for rule in request_rules()]
    df = spark.createDataFrame([tuple(1.0 for _ in names)], ", ".join(f"{n} double" for n in names))
    assert keep_valid(df, request_rules()).count() == 1
    for column, bad in (("density", 0.0), ("pH", 14.1), ("wine_type", 2.0), ("alcohol", -0.1)):
        assert keep_valid(df.withColumn(column, F.lit(bad)), request_rules()).count() == 0


def test_citations(one):
    ref = lambda uri: F.struct(F.struct(F.struct(F.lit(uri).cast("string").alias("uri")).alias("s3Location")).alias("location"))  # noqa: E731, E501
    cite = lambda *refs: F.struct(F.array(*refs).alias("retrievedReferences"))
    cited = F.array(cite(ref("b"), ref("")), cite(ref("a"), ref(None)), cite(ref("b"), ref("c")))
    assert one(citation_links(cited)) == ["b", "a", "c"]
    assert one(citation_links(F.lit(None).cast(CITATION_TYPE))) == []
    assert one(citation_links(F.array().cast(CITATION_TYPE))) == []


def test_links(one):
    assert one(link_bucket(F.lit("s3://b/k/x"))) == "b"
    assert one(link_key(F.lit("s3://b/k/x"))) == "k/x"
    assert one(link_bucket(F.lit("https://b/k"))) is None
    assert one(link_key(F.lit("s3://b/"))) is None
    assert one(feature_link(F.lit("b"), F.lit("wine"))) == "s3://b/features/wine"
    assert one(feature_link(F.lit("b"), F.lit("wine"), F.lit("wine_type=0/"))) == "s3://b/features/wine/wine_type=0"


def test_questions_and_keywords(one):
    bodies = ['{"question": "  hi "}', '{"question": "  "}', "{", "{}", None]
    assert one(request_question("b"), [(b,) for b in bodies], "b string") == ["hi", None, None, None, None]
    hit = any_keyword(F.lit("It is MANDATORY"), F.array(F.lit("mfa"), F.lit("mandatory")))
    assert one(hit) is True
    assert one(any_keyword(F.lit(None).cast("string"), F.array(F.lit("x")))) is False
