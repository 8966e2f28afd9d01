import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.rules import request_rules
from millrace.operators.similarity import centroids, top_k_similar
from millrace.plans.drift import drift_report, drift_summary
from millrace.plans.latency import latency_summary
from millrace.plans.recommend import (
    assign_variant,
    business_metrics,
    daily_volume,
    factorize,
    interaction_weights,
    model_ids,
    model_top_n,
    negative_samples,
    ranking_metrics,
)
from millrace.plans.training import (
    WINE_FEATURES,
    accuracy_and_macro_f1,
    cast_numeric,
    classification_report,
    feature_vector,
    log_loss,
    ranking_rows,
    save_model,
    score,
    train_and_evaluate,
    settings_used,
    stopping_round,
    train_ranker,
    train_tiers,
)


@pytest.mark.parametrize("n", [1, 2, 20, 200])
@pytest.mark.parametrize("floored", [False, True])
def test_latency_ranks(spark, n, floored):
    rng = random.Random(n)
    values = [round(rng.expovariate(0.1), 2) for _ in range(n)]
    row = latency_summary(spark.createDataFrame([(v,) for v in values], "v double"), "v", 10.0, floored).first()
    ordered = sorted(values)
    p95 = max(0, round(0.95 * n) - 1) if floored else int(0.95 * n) - 1
    assert row.latency_p50 == round(ordered[n // 2], 2)
    assert row.latency_p95 == round(ordered[p95], 2)
    assert row.latency_max == round(ordered[-1], 2)
    assert row.requests == n and row.throughput_rps == round(n / 10.0, 1)
    assert row.latency_mean == pytest.approx(sum(values) / n, abs=0.0051)


def test_report_against_counting(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(3), rng.randrange(4)) for _ in range(200)] + [(5, 0)]
    report = classification_report(spark.createDataFrame(pairs, "label int, prediction int"))
    rows = {r["class"]: r for r in report.collect()}
    assert sorted(rows) == [0, 1, 2, 3, 5]
    f1s = []
    for c in rows:
        hits = sum(a == b == c for a, b in pairs)
        support, named = sum(a == c for a, _ in pairs), sum(b == c for _, b in pairs)
        precision, recall = (hits / named if named else 0), (hits / support if support else 0)
        f1s.append(2 * precision * recall / (precision + recall) if precision + recall else 0)
        assert (rows[c].support, rows[c].named, rows[c].hits) == (support, named, hits)
        assert rows[c].f1 == pytest.approx(f1s[-1])
    summed = accuracy_and_macro_f1(report).first()
    assert summed.accuracy == pytest.approx(sum(a == b for a, b in pairs) / len(pairs))
    assert summed.f1_macro == pytest.approx(sum(f1s) / len(f1s))


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.3), (1, 0.0)], "y int, p double")
    expected = -(math.log(0.8) + math.log(0.7) + math.log(1e-15)) / 3
    assert df.agg(log_loss("y", "p")).first()[0] == pytest.approx(expected)


def _psi_and_ks(ref, cur):
    ref, cur = sorted(ref), sorted(cur)
    n = len(ref)
    edges = [ref[math.ceil(j * n / 10) - 1] for j in range(1, 10)]
    share = lambda data: [b - a for a, b in zip([0] + [sum(v <= e for v in data) / len(data) for e in edges],
                                                [sum(v <= e for v in data) / len(data) for e in edges] + [1])]
    r, c = [max(x, 1e-4) for x in share(ref)], [max(x, 1e-4) for x in share(cur)]
    psi = sum((b - a) * math.log(b / a) for a, b in zip(r, c))
    ks = max(abs(sum(v <= x for v in ref) / len(ref) - sum(v <= x for v in cur) / len(cur)) for x in ref + cur)
    return psi, ks


def test_drift_against_counting(spark):
    rng = random.Random(1)
    ref = [(rng.gauss(0, 1), float(rng.randrange(3))) for _ in range(500)]
    cur = [(rng.gauss(1, 1), float(rng.randrange(3))) for _ in range(300)]
    frame = lambda rows: spark.createDataFrame(rows, "a double, b double")
    report = drift_report(frame(ref), frame(cur), ["a", "b"])
    rows = {r.feature: r for r in report.collect()}
    for i, name in enumerate("ab"):
        psi, ks = _psi_and_ks([r[i] for r in ref], [r[i] for r in cur])
        assert rows[name].psi == pytest.approx(psi, abs=1e-9)
        assert rows[name].ks == pytest.approx(ks, abs=1e-12)
    assert rows["a"].drifted and not rows["b"].drifted
    assert drift_summary(report).first()[:] == (500, 300, 2, 1, True)
    lost = drift_report(frame(ref), frame([(None, b) for _, b in cur]), ["a", "b"])
    rows = {r.feature: r for r in lost.collect()}
    assert rows["a"].drifted and rows["a"].psi is None and rows["a"].current_null_share == 1
    assert drift_summary(lost).first()[:2] == (500, 300)
    same = drift_report(frame(ref), frame(ref), ["a"]).first()
    assert same.psi == pytest.approx(0) and same.ks == 0 and not same.drifted


def _brute(queries, vectors, k):
    result = {}
    for qid, q in queries:
        def sim(v):
            a, b = np.array(q), np.array(v)
            norm = np.linalg.norm(a) * np.linalg.norm(b)
            return round(float(a @ b / norm), 9) if norm else 0.0
        ranked = sorted(((-sim(v), vid) for vid, v in vectors))[:k]
        result[qid] = [vid for _, vid in ranked]
    return result


@pytest.mark.parametrize("block", [3, 100])
def test_top_k_against_brute_force(spark, block):
    rng = np.random.default_rng(0)
    vectors = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    vectors += [(300 + i, vectors[i][1]) for i in range(20)] + [(400, [0.0] * 6)]
    queries = [(i, vectors[i][1]) for i in range(0, 50, 5)] + [(99, [0.0] * 6)]
    schema = "array<float>"
    found = top_k_similar(
        spark.createDataFrame(queries, f"query_id long, embedding {schema}"),
        spark.createDataFrame(vectors, f"vec_id long, embedding {schema}").repartition(5),
        4,
        block=block,
    )
    mine = {}
    for row in found.orderBy("query_id", "position").collect():
        mine.setdefault(row.query_id, []).append(row.vec_id)
    as_floats = lambda rows: [(i, np.array(v, dtype="float32").astype("float64")) for i, v in rows]
    assert mine == _brute(as_floats(queries), as_floats(vectors), 4)


def test_top_k_with_text_ids_and_no_queries(spark):
    vectors = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", None)], "id string, embedding array<double>")
    queries = spark.createDataFrame([(1, [2.0, 0.0])], "query_id int, embedding array<double>")
    rows = top_k_similar(queries, vectors, 5, vector_id="id").orderBy("position").collect()
    assert [(r.id, r.similarity) for r in rows] == [("a", 1.0), ("b", 1.0)]
    assert top_k_similar(queries.limit(0), vectors, 5, vector_id="id").count() == 0


def test_centroids(spark):
    df = spark.createDataFrame([(1, [0.0, 2.0]), (1, [2.0, 4.0]), (2, [5.0, 5.0])], "g int, embedding array<float>")
    assert {r.g: list(r.embedding) for r in centroids(df, "g").collect()} == {1: [1.0, 3.0], 2: [5.0, 5.0]}


@pytest.fixture(scope="module")
def wines(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        alcohol = rng.uniform(8, 14)
        rows.append((i, *[rng.uniform(0.5, 1.5) for _ in WINE_FEATURES[:-2]], alcohol, i % 2, 5 if alcohol < 10 else 7 if alcohol < 12 else 8))
    names = ["id", *WINE_FEATURES, "quality"]
    return spark.createDataFrame(rows, names).cache()


@pytest.mark.parametrize("boosted", [False, True])
def test_tier_model(spark, wines, boosted, tmp_path):
    settings = dict(trees=5, depth=4, boosted=boosted)
    model, metrics, report = train_and_evaluate(wines, ["id"], **settings)
    assert report.agg(F.sum("support")).first()[0] == 48
    assert metrics["accuracy"] > 0.8 and metrics["f1_macro"] > 0.7
    bad = wines.limit(1).withColumn("alcohol", F.lit(-1.0))
    scored = score(model, wines.unionByName(bad), "7", request_rules())
    assert scored.count() == 240 and scored.first().model_version == "7"
    assert dict(scored.dtypes)["prediction"] == "int"
    save_model(spark, model, str(tmp_path / "m"), "tiers", metrics, settings_used(**settings))
    stored = spark.read.json(str(tmp_path / "m" / "metadata")).first()
    assert stored.feature_columns == WINE_FEATURES and stored.params.trees == 5 and stored.params.seed == 42
    assert stored.params.test_share == 0.2 and stored.metrics.accuracy > 0.8 and stored.quality_tiers.low == "3-5"


def test_missing_feature_is_an_error(wines):
    with pytest.raises(ValueError, match="alcohol"):
        feature_vector(wines.drop("alcohol"), WINE_FEATURES, "quality")
    assert feature_vector(wines, WINE_FEATURES, "quality").first().features.size == 12


def test_ranker(spark):
    rng = random.Random(2)
    rows = [(i, f"u{i % 5}", f"i{i % 7}", str(rng.randrange(1, 6)), "9.5", True, int(i % 7 < 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "n int, user_id string, item_id string, rating string, price_raw string, has_brand boolean, label int")
    assert dict(cast_numeric(df).dtypes)["rating"] == "double"
    encoded = ranking_rows(df.filter("n < 150"), df.filter("n >= 150"), ["n"])
    assert "user_id_idx" in encoded.columns and "user_id" not in encoded.columns
    model = train_ranker(encoded, ["item_id_idx", "rating", "has_brand"], rounds=5, depth=3)
    report = classification_report(score(model, encoded, "1"))
    assert accuracy_and_macro_f1(report).first().accuracy > 0.95


def test_ranker_stops_after_rounds_without_gain(spark):
    assert stopping_round([3, 2, 1], 2) == 3
    assert stopping_round([3, 2, 2.5, 2.4, 1], 2) == 2
    assert stopping_round([1], 5) == 1
    rng = random.Random(4)
    rows = [(float(rng.random()), rng.randrange(2), i % 4 == 0) for i in range(400)]
    noise = spark.createDataFrame(rows, "x double, label int, is_validation boolean")
    stopped = train_ranker(noise, ["x"], rounds=40, depth=3, patience=2)
    assert stopped.stages[-1].getNumTrees < 40
    whole = train_ranker(noise.withColumn("is_validation", F.lit(False)), ["x"], rounds=4, depth=3)
    assert whole.stages[-1].getNumTrees == 4


def test_ranking_metrics_by_hand(spark):
    recommended = spark.createDataFrame([("u", "a", 1), ("u", "b", 2), ("u", "c", 3), ("v", "a", 1)], "user string, item string, position int")
    relevant = spark.createDataFrame([("u", "a"), ("u", "c"), ("v", "z"), ("w", "a")], "user string, item string")
    row = ranking_metrics(recommended, relevant, "user", "item", 3).first()
    ndcg_u = (1 + 1 / math.log2(4)) / (1 + 1 / math.log2(3))
    assert row.users == 3 and row.hit_rate == pytest.approx(1 / 3)
    assert row.recall == pytest.approx(1 / 3) and row.ndcg == pytest.approx(ndcg_u / 3)
    assert row["map"] == pytest.approx((1 + 2 / 3) / 2 / 3)
    priced = relevant.withColumn("price", F.lit(2.0))
    business = business_metrics(recommended, priced, "user", "item", "price").first()
    assert business.ctr_proxy == pytest.approx(0.5) and business.revenue_per_user == pytest.approx(4 / 3)


def test_negatives_are_unseen(spark):
    pairs = spark.range(400).select((F.col("id") % 20).alias("u"), (F.col("id") * 7 % 50).alias("i")).distinct()
    negatives = negative_samples(pairs, pairs, "u", "i", 2)
    assert negatives.count() > 0 and negatives.join(pairs, ["u", "i"]).count() == 0
    assert negatives.distinct().count() == negatives.count()
    weights = interaction_weights(pairs.withColumn("a", F.lit("other")), "u", "i", "a")
    assert weights.count() == 0


def test_daily_verdicts(spark):
    sizes = [10, 11, 9, 10, 11, 9, 10, 40, 10]
    rows = [(f"2024-01-{d + 1:02d} 00:00:00",) for d, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp").alias("t"))
    verdicts = [r.verdict for r in daily_volume(df, "t").orderBy("day").collect()]
    assert verdicts == ["normal"] * 7 + ["spike", "normal"]


def test_variants_are_stable(spark):
    users = spark.range(1000).select((F.col("id") % 500).alias("u"))
    assigned = assign_variant(users, "u")
    assert assigned.distinct().count() == 500
    assert 0.72 < assigned.filter("variant = 'A'").count() / 1000 < 0.88


def test_factors_recommend_within_the_own_group(spark):
    """Two groups of users with items of their own: nobody is offered the other group's items first."""
    rows = [(n, f"g{n % 2}u{n % 10}", f"g{n % 2}i{(n * 7 // 10) % 8}", "click") for n in range(400)]
    events = spark.createDataFrame(rows, "n int, user string, item string, action string")
    coded = model_ids(events.withColumns({"u": F.col("user"), "i": F.col("item")}), "user", "item", ["n"])
    weights = interaction_weights(coded, "user_idx", "item_idx", "action")
    top = model_top_n(factorize(weights, "user_idx", "item_idx", rank=4), "user_idx", "item_idx", 2)
    users = coded.select("user_idx", F.substring("u", 1, 2).alias("ug")).distinct()
    items = coded.select("item_idx", F.substring("i", 1, 2).alias("ig")).distinct()
    named = top.join(users, "user_idx").join(items, "item_idx")
    assert named.count() == 20 and named.filter("ug <> ig").count() == 0
    assert named.groupBy("user_idx").agg(F.max("position")).filter("`max(position)` <> 2").count() == 0
