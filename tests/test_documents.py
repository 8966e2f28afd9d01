import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.guard import (
    BLOCKED_INPUT,
    BLOCKED_OUTPUT,
    DENIED_EXAMPLES,
    anonymize,
    card_numbers,
    findings,
    has_ssn,
)
from millrace.operators.similarity import top_k_similar
from millrace.plans.documents import (
    chunk_documents,
    evaluate_cases,
    evaluation_report,
    fit_lexical,
    guard,
    lexical_vectors,
    report_cases,
)
from millrace.streaming.events import append_events, arriving_files, metric_windows, write_windows


@pytest.mark.parametrize("n,sizes", [(0, []), (1, [1]), (240, [240]), (300, [300]), (301, [300, 61]), (540, [300, 300]), (541, [300, 300, 61])])
def test_chunk_sizes(spark, n, sizes):
    text = " \n".join(f"w{i}" for i in range(n))
    chunks = chunk_documents(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t").orderBy("chunk_no")
    assert [r.n_words for r in chunks.collect()] == sizes


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 60), size=st.sampled_from([5, 10]))
def test_chunks_rebuild_the_text(spark, n, size):
    words = [f"w{i}" for i in range(n)]
    df = spark.createDataFrame([(1, "  ".join(words))], "id int, t string")
    rows = chunk_documents(df, "id", "t", size, 0.2).orderBy("chunk_no").collect()
    rebuilt = []
    for row in rows:
        piece = row.chunk_text.split(" ")
        overlap = size // 5 if rebuilt else 0
        assert rebuilt[len(rebuilt) - overlap :] == piece[:overlap]
        rebuilt += piece[overlap:]
    assert rebuilt == words


def test_null_text_has_no_chunk(spark):
    assert chunk_documents(spark.createDataFrame([(1, None)], "id int, t string"), "id", "t").count() == 0


def test_personal_data(one):
    texts = [
        ("mail a.b+c@mail.example.com or (555) 123-4567 now",),
        ("call +1 (017) 555-7713, 555.123.4567",),
        ("none @ all 12",),
    ]
    assert one(anonymize("t"), texts, "t string") == ["mail {EMAIL} or {PHONE} now", "call {PHONE}, {PHONE}", "none @ all 12"]
    ssn = [("123-45-6789",), ("x 123-45-6789.",), ("0123-45-6789",), ("123-45-67890",), ("no",)]
    assert one(has_ssn("t"), ssn, "t string") == [True, True, False, False, False]
    cards = [
        ("4111 1111 1111 1111",), ("4111-1111-1111-1112",), ("378282246310005",), ("3782 822463 10005",),
        ("41111111111111111111111",), ("1234",),
    ]
    assert one(card_numbers("t"), cards, "t string") == [
        ["4111111111111111"], [], ["378282246310005"], ["378282246310005"], [], [],
    ]


def test_findings_and_messages(spark, one):
    texts = [
        ("You IDIOT, what a moron",), ("one idiot only, idiot",), ("we hate this",), ("whatever",),
        (DENIED_EXAMPLES[0],), (DENIED_EXAMPLES[1],), ("card 4111111111111111 ssn 123-45-6789",), ("a@b.example.com",),
    ]
    assert one(findings("t"), texts, "t string") == [
        ["INSULTS"], [], ["HATE"], [], ["IllegalActivity"], ["IllegalActivity"],
        ["US_SOCIAL_SECURITY_NUMBER", "CREDIT_DEBIT_CARD_NUMBER"], [],
    ]
    df = spark.createDataFrame([("we hate", "input"), ("we hate", "output"), ("a@b.example.com", "input")], "t string, d string")
    rows = guard(df, "t", "d").collect()
    assert [r.guardrail_action for r in rows] == ["INTERVENED", "INTERVENED", "NONE"]
    assert [r.guarded_text for r in rows] == [BLOCKED_INPUT, BLOCKED_OUTPUT, "{EMAIL}"]


CASES = [
    ("k", "It is 26 weeks", ["26"], False, "NONE", ["x"], 10.0),
    ("m", "no idea", ["1500", "x y"], None, None, [], 20.0),
    ("n", "anything", [], False, "NONE", None, 30.0),
    ("u", "26", ["26"], False, "INTERVENED", [], 40.0),
    ("guardrail_block", "Sorry, blocked.", None, True, None, [], 50.0),
    ("b2", "sure", None, True, "NONE", [], 60.0),
    ("b3", None, None, True, "INTERVENED", [], 70.0),
]


def test_evaluation(spark):
    df = spark.createDataFrame(
        CASES,
        "id string, answer string, expected_keywords array<string>, expect_blocked boolean, "
        "guardrail_action string, citations array<string>, latency_ms double",
    )
    judged = evaluate_cases(df)
    rows = {r.id: r for r in report_cases(judged).collect()}
    assert {k: r.passed for k, r in rows.items()} == {
        "k": True, "m": False, "n": True, "u": False, "guardrail_block": True, "b2": False, "b3": True,
    }
    assert rows["m"].notes == ["missing keywords: ['1500', 'x y']"]
    assert rows["u"].notes == ["unexpected guardrail: INTERVENED"]
    assert rows["b2"].notes == ["expected guardrail block"] and rows["k"].notes == []
    assert rows["k"].has_citation and not rows["n"].has_citation
    report = evaluation_report(judged).first()
    assert report[:] == (7, 0.571, 0.5, 0.143, 40.0, False)


def test_lexical_retrieval_finds_the_same_text(spark):
    docs = spark.createDataFrame([(i, f"alpha{i} beta{i % 3} gamma common") for i in range(20)], "id long, t string")
    model = fit_lexical(docs, "t", 256)
    vectors = lexical_vectors(model, docs, "id", "t")
    nearest = top_k_similar(vectors.withColumnRenamed("id", "query_id"), vectors, 1, vector_id="id")
    assert nearest.filter("query_id = id and similarity > 0.999999").count() == 20


EVENT = "user_id string, parent_asin string, rating double, timestamp timestamp"


def _events(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, parent_asin string, rating double, t string")
    return df.select("user_id", "parent_asin", "rating", F.col("t").cast("timestamp").alias("timestamp"))


def test_arriving_files_are_added_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    run = lambda: append_events(arriving_files(spark, source, EVENT), out, checkpoint).awaitTermination()
    _events(spark, [("u", "i", 5.0, "2024-01-01 10:00:00")]).write.mode("append").parquet(source)
    (tmp_path / "in" / "note.csv").write_text("not,for,us")
    run()
    run()
    assert spark.read.parquet(out).count() == 1
    _events(spark, [("u", "j", None, "2024-01-02 10:00:00")]).write.mode("append").parquet(source)
    run()
    rows = {r.item_id: r for r in spark.read.parquet(out).collect()}
    assert rows["i"].event_type == "positive_rating" and rows["j"].event_type == "negative_rating"
    assert str(rows["j"].date) == "2024-01-02"


def test_stream_windows_equal_batch(spark, tmp_path):
    rows = [("u", "m", float(i), f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00") for i in range(180)]
    source = str(tmp_path / "in")
    _events(spark, rows).repartition(3).write.parquet(source)
    stream = metric_windows(arriving_files(spark, source, EVENT), "timestamp", "parent_asin", "rating", late="10 minutes")
    write_windows(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = metric_windows(spark.read.parquet(source), "timestamp", "parent_asin", "rating")
    assert batch.count() == 36
    assert streamed.count() >= 32 and streamed.exceptAll(batch).count() == 0
