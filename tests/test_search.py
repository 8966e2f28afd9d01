"""Index cells, bounded retrieval, inner products, negatives and partitioned tables against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from millrace.operators import similarity
from millrace.operators.inner_product import top_inner_products
from millrace.operators.partitions import (
    VersionClaimed,
    claim,
    forget_versions,
    manifest,
    merge_partitions,
    read_partitions,
    release,
)
from millrace.operators.profile import duplicate_rows, schema_inventory
from millrace.operators.similarity import top_k_similar
from millrace.operators.vector_index import build_index, search_index
from millrace.plans import documents
from millrace.plans.documents import retrieve
from millrace.plans.recommend import assign_variant, model_top_n, negative_samples
from millrace.session import materialize


def clustered(spark, n=600, dims=8, groups=6, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims)) * 4
    rows = [(i, (centres[i % groups] + rng.normal(size=dims) * 0.3).tolist()) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(30)] + [(n + 100, [0.0] * dims), (n + 101, None)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)


@pytest.mark.parametrize("probes", [1, 3])
def test_index_equals_a_full_scan(spark, probes):
    vectors = clustered(spark)
    asked = vectors.filter("vec_id % 7 = 0 or vec_id >= 700").withColumnRenamed("vec_id", "query_id")
    index = build_index(vectors, cells=12, sample_rows=300, ring_rows=20)
    found, scanned = search_index(index, asked, 5, probes=probes, query_rows=16)
    want = top_k_similar(asked.filter("embedding is not null"), vectors, 5)
    mine = {(r["query_id"], r["position"]): (r["id"], r["similarity"]) for r in found.collect()}
    theirs = {(r["query_id"], r["position"]): (r["vec_id"], r["similarity"]) for r in want.collect()}
    assert mine.keys() == theirs.keys()
    for key, (vec, similarity) in theirs.items():
        assert mine[key][1] == pytest.approx(similarity, abs=2e-9)
        assert mine[key][0] == vec or mine[key][1] == pytest.approx(similarity, abs=2e-9)
    assert scanned.first()["scanned"] < 0.5 * 631 * len({q for q, _ in theirs})


def test_index_by_probes_alone_and_of_nothing(spark):
    vectors = clustered(spark, n=300)
    asked = vectors.filter("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")
    index = build_index(vectors, cells=6)
    near, few = search_index(index, asked, 4, probes=2, exact=False)
    exact, all_of_them = search_index(index, asked, 4, probes=2)
    both = near.select("query_id", "id").intersect(exact.select("query_id", "id")).count()
    assert both >= 0.9 * exact.count() and few.first()[0] <= all_of_them.first()[0]
    assert search_index(index, asked.limit(0), 4)[0].count() == 0
    empty = build_index(vectors.limit(0), cells=4)
    assert search_index(empty, asked, 4)[0].count() == 0
    named = vectors.withColumn("vec_id", F.concat(F.lit("v"), F.col("vec_id").cast("string")))
    assert search_index(build_index(named, cells=4), asked, 1)[0].first()["id"].startswith("v")


def test_index_with_less_than_k_vectors_in_a_cell(spark):
    vectors = spark.createDataFrame([(i, [1.0, i / 10]) for i in range(12)], "vec_id long, embedding array<double>")
    asked = vectors.withColumnRenamed("vec_id", "query_id")
    found, _ = search_index(build_index(vectors, cells=8), asked, 6, probes=1)
    want = top_k_similar(asked, vectors, 6).withColumnRenamed("vec_id", "id").select(*found.columns)
    assert found.count() == 72 and found.drop("similarity").exceptAll(want.drop("similarity")).isEmpty()


def test_top_k_sends_no_vectors_to_the_queries(spark):
    # All pairs are scored, though no row of vectors is copied for each block of queries.
    rng = np.random.default_rng(6)
    vectors = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(600)], "vec_id long, embedding array<double>")
    asked = vectors.filter("vec_id < 200").withColumnRenamed("vec_id", "query_id")
    found = top_k_similar(asked, vectors, 3, block=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "stored_data" not in plan
    assert found.count() == 600 and found.filter("position = 1 and query_id = vec_id").count() == 200


@pytest.mark.parametrize("results", [1, 1 << 20])
@pytest.mark.parametrize("text", [False, True])
def test_top_k_over_many_files_equals_brute_force(spark, monkeypatch, results, text):
    monkeypatch.setattr(similarity, "RESULTS", results)
    rng = np.random.default_rng(7)
    points = [[float(x) for x in rng.integers(-2, 3, size=3)] for _ in range(300)] + [[0.0] * 3]  # many equal similarities
    name = (lambda i: "v" * (i % 9) + str(i)) if text else (lambda i: (1 << 53) + i)
    vectors = [(name(i), v) for i, v in enumerate(points)] + [(name(0), points[1]), (name(400), None)]
    asked = [((1 << 53) + i, points[i]) for i in range(0, 301, 4)] + [((1 << 53) + 4, points[7]), (None, points[9]), (5, None)]
    found = top_k_similar(
        spark.createDataFrame(asked, "query_id long, embedding array<double>").repartition(3),
        spark.createDataFrame(vectors, f"vec_id {'string' if text else 'long'}, embedding array<double>").repartition(7), 4, block=5,
    )
    want = {}
    for q, a in asked:
        for v, b in vectors if a else ():
            if b:
                size = np.linalg.norm(a) * np.linalg.norm(b)
                want.setdefault(q, []).append((-round(float(np.dot(a, b) / size), 9) if size else 0.0, v))
    mine = {}
    for r in found.orderBy("query_id", "position").collect():
        mine.setdefault(r["query_id"], []).append((-r["similarity"], r["vec_id"]))
    assert mine == {q: sorted(scores)[:4] for q, scores in want.items()}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_top_k_of_vectors_without_ids(spark, kind):
    ids = [None, (1 << 53) + 1, None, (1 << 53) + 3]
    rows = [(i if kind == "long" or i is None else str(i), v) for i, v in zip(ids, [[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], [1.0, 1.0]], strict=True)]
    vectors = spark.createDataFrame(rows, f"vec_id {kind}, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    found = [(r["vec_id"], r["similarity"]) for r in top_k_similar(asked, vectors, 3).orderBy("position").collect()]
    assert found == [(None, 1.0), (rows[1][0], 1.0), (rows[3][0], 0.707106781)]
    assert top_k_similar(asked, vectors.filter("vec_id is null"), 3).count() == 2


def test_top_k_of_vectors_of_unequal_length(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, [1.0])], "vec_id long, embedding array<double>").coalesce(1)
    with pytest.raises(Exception, match="vectors have 1 to 2 numbers"):
        top_k_similar(vectors.withColumnRenamed("vec_id", "query_id"), vectors, 3).count()


def brute_retrieve(questions, texts, k):
    counts = {key: {} for key, _ in texts}
    for key, text in texts:
        for w in (text or "").lower().split():
            counts[key][w] = counts[key].get(w, 0) + 1
    counts = {key: c for key, c in counts.items() if c}
    held = {}
    for c in counts.values():
        for w in c:
            held[w] = held.get(w, 0) + 1
    idf = {w: math.log((len(counts) + 1) / (n + 1)) for w, n in held.items()}

    def unit(words):
        weights = {w: n * idf[w] for w, n in words.items() if idf.get(w, 0) > 0}
        size = math.sqrt(sum(x * x for x in weights.values()))
        return {w: x / size for w, x in weights.items()}

    stored = {key: unit(c) for key, c in counts.items()}
    out = set()
    for q, text in questions:
        words = {}
        for w in text.lower().split():
            words[w] = words.get(w, 0) + 1
        asked = unit(words)
        scores = [(-round(sum(x * asked[w] for w, x in v.items() if w in asked), 9), key) for key, v in stored.items() if asked.keys() & v.keys()]
        out |= {(q, key, round(-s, 6), i + 1) for i, (s, key) in enumerate(sorted(scores)[:k])}
    return out


@pytest.mark.parametrize("seeds", [1, 3, 50])
def test_retrieval_equals_brute_force(spark, seeds):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [(f"t{i:03d}", " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 40)))) for i in range(150)]
    texts += [("none", None), ("blank", " "), ("twin", texts[0][1])]
    questions = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 8)))) for i in range(25)] + [(99, "unknown words")]
    found = retrieve(
        spark.createDataFrame(questions, "item_id long, text string"),
        spark.createDataFrame(texts, "chunk_id string, chunk_text string"), 4, seeds=seeds,
    )
    assert {(r[0], r[1], round(r[2], 6), r[3]) for r in found.collect()} == brute_retrieve(questions, texts, 4)


@pytest.mark.parametrize("block_bytes", [1, 200, 1 << 20])
def test_retrieval_by_blocks_of_any_size_equals_brute_force(spark, block_bytes):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ärger", "naïve", "日本", "\u00a0", "a\x0bb", "x"]
    text = lambda n: rng.choice([" ", "\t", "\r\n", " \f "]).join(rng.choices(vocabulary, k=n)).join(rng.choice([("", ""), (" ", "\n")]))
    texts = [(i, text(rng.randint(1, 30))) for i in range(80)] + [(3, text(9)), (3, text(2)), (7, "\n"), (200, ""), (201, None)]
    texts += [(300 + i, texts[5][1]) for i in range(10)]
    questions = [(i, text(rng.randint(1, 6))) for i in range(20)] + [(50, texts[5][1]), (50, "x w1"), (51, "unknown")]
    merged = {}
    for q, words in questions:
        merged[q] = f"{merged.get(q, '')} {words}"
    ascii_blanks = [(key, "".join(c if c not in "\u00a0\x0b" else "_" for c in t or "")) for key, t in texts]
    asked = [(q, t.replace("\u00a0", "_").replace("\x0b", "_")) for q, t in merged.items()]
    found = retrieve(
        spark.createDataFrame(questions, "item_id long, text string"),
        spark.createDataFrame(texts, "chunk_id long, chunk_text string").repartition(3), 6, block_bytes=block_bytes, question_terms=10,
    )
    assert {(r[0], r[1], round(r[2], 6), r[3]) for r in found.collect()} == brute_retrieve(asked, ascii_blanks, 6)


def test_retrieval_of_nothing(spark):
    questions = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    texts = spark.createDataFrame([("t", "a b"), ("u", " ")], "chunk_id string, chunk_text string")
    assert retrieve(questions, texts.limit(0)).isEmpty() and retrieve(questions, texts.filter("chunk_id = 'u'")).isEmpty()
    assert retrieve(questions.limit(0), texts).isEmpty()


def test_retrieval_stores_vocabularies_and_no_row_for_each_word_of_a_text(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(50)]
    texts = [(f"t{i}", " ".join(rng.choices(vocabulary, k=100))) for i in range(300)]
    stored = []
    monkeypatch.setattr(documents, "materialize", lambda df, label="step": stored.append(materialize(df, label)) or stored[-1])
    questions = spark.createDataFrame([(1, "w1 w2 w3"), (2, "w4")], "item_id long, text string")
    found = retrieve(questions, spark.createDataFrame(texts, "chunk_id string, chunk_text string"), 3)
    assert found.count() == 6
    pairs = sum(len(set(t.split())) for _, t in texts)
    assert max(df.count() for df in stored) < pairs / 20


@pytest.mark.parametrize(("item_rows", "user_rows"), [(7, 5), (100, 100)])
def test_inner_products_equal_all_pairs(spark, item_rows, user_rows):
    rng = np.random.default_rng(3)
    users = [(i, rng.normal(size=4).tolist()) for i in range(40)] + [(90, [0.0] * 4), (91, None)]
    items = [(i, (rng.normal(size=4) * (i % 9)).tolist()) for i in range(60)] + [(60, items_ := [3.0] * 4), (61, items_), (62, None)]
    found = top_inner_products(
        spark.createDataFrame(users, "user_id long, factors array<double>"),
        spark.createDataFrame(items, "item_id long, factors array<double>").repartition(3), 5,
        item_rows=item_rows, user_rows=user_rows,
    )
    mine = {}
    for r in found.orderBy("user_id", "position").collect():
        mine.setdefault(r["user_id"], []).append((r["item_id"], r["score"]))
    for user, vector in users[:41]:
        scores = sorted((-round(float(np.dot(vector, v)), 9) + 0.0, i) for i, v in items if v is not None)[:5]
        assert [i for i, _ in mine[user]] == [i for _, i in scores]
        assert [s for _, s in mine[user]] == pytest.approx([-s for s, _ in scores], abs=2e-9)
    assert 91 not in mine


def test_inner_products_send_users_once(spark):
    # Equal lengths rule nothing out: every user meets every item, though no user's row is sent to each block.
    rng = np.random.default_rng(5)
    unit = lambda: (lambda v: (v / np.linalg.norm(v)).tolist())(rng.normal(size=8))
    users = spark.createDataFrame([(i, unit()) for i in range(300)], "user_id long, factors array<double>")
    items = spark.createDataFrame([(i, unit()) for i in range(200)], "item_id long, factors array<double>")
    found = top_inner_products(users, items, 3, item_rows=4, user_rows=16)
    assert found.count() == 900
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in plan and "Join" not in plan


def test_factors_equal_the_library(spark):
    rows = [(n % 23, n * 7 % 31, float(1 + n % 5)) for n in range(300)]
    model = ALS(userCol="u", itemCol="i", ratingCol="w", implicitPrefs=True, rank=4, seed=1).fit(spark.createDataFrame(rows, "u int, i int, w double"))
    want = {}
    for r in model.recommendForAllUsers(6).collect():
        want[r["u"]] = [x["rating"] for x in r["recommendations"]]
    mine = {}
    for r in model_top_n(model, "u", "i", 6).orderBy("u", "position").collect():
        mine.setdefault(r["u"], []).append(r["score"])
    assert mine.keys() == want.keys()
    for user in want:
        assert mine[user] == pytest.approx(want[user], abs=1e-5)


def test_negatives_are_as_many_as_asked(spark):
    rng = random.Random(5)
    positives = [(u, i) for u in range(30) for i in rng.sample(range(20), rng.randint(1, 20))] + [(99, 3)] * 4 + [(None, 3)]
    items = spark.range(20).select(F.col("id").alias("i")).unionByName(spark.createDataFrame([(None,)], "i long"))
    pairs = spark.createDataFrame(positives, "u long, i long")
    found = [tuple(r) for r in negative_samples(pairs, items, "u", "i", 2).collect()]
    touched = {u: {i for v, i in positives if v == u} for u, _ in positives if u is not None}
    assert len(found) == len(set(found))
    for user, own in touched.items():
        mine = {i for u, i in found if u == user}
        assert not mine & own and len(mine) == min(2 * len(own), 20 - len(own))
    again = [tuple(r) for r in negative_samples(pairs.repartition(7), items, "u", "i", 2).collect()]
    assert sorted(found) == sorted(again)
    ten = spark.range(10).select(F.lit(1).alias("u"), F.col("id").alias("i"))
    assert negative_samples(ten, items, "u", "i").count() == 10
    assert negative_samples(pairs.limit(0), items, "u", "i").count() == 0


@pytest.mark.parametrize("share", [0.0, 0.005, 0.015, 0.8, 1.0])
def test_variant_shares_below_a_percent(spark, share):
    users = spark.range(20_000).withColumnRenamed("id", "u")
    assert assign_variant(users, "u", share).filter("variant = 'A'").count() / 20_000 == pytest.approx(share, abs=0.004)


def test_duplicates_by_fingerprints(spark):
    rows = [(None, "a"), ("a", None), (None, "a"), ("x", "y"), ("x", "y"), ("x", "y"), (None, None), ("q", "r")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert duplicate_rows(df).first()[0] == 3
    assert duplicate_rows(df.limit(0)).first()[0] == 0
    plan = duplicate_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_h1" in plan


def test_schema_inventory(spark):
    spark.range(3).createOrReplaceTempView("fct_view")
    found = [tuple(r) for r in schema_inventory(spark, "%MART%", "FCT_%").collect()]
    assert ("", "fct_view", 3) in found
    assert schema_inventory(spark, "x", "fct__").count() == 0


def load(spark, rows):
    return spark.createDataFrame(rows, "k int, day string, v string, at int")


def files_of(root):
    return {p: p.stat().st_mtime_ns for p in root.glob("data/v*/*/part-*.parquet")}


def test_a_run_rewrites_touched_partitions_only(spark, tmp_path):
    root = str(tmp_path / "t")
    day = F.col("day")
    rows = [(k, f"d{k % 5}", "old", 1) for k in range(50)] + [(90, None, "old", 1), (91, "a/b=c", "old", 1)]
    assert merge_partitions(load(spark, rows), root, ["k"], "at", day) == 1
    before = files_of(tmp_path / "t")
    # One changed row, one new row in a new partition, one that moves from d2 to d3.
    news = [(0, "d0", "new", 2), (100, "d9", "new", 2), (2, "d3", "moved", 3), (2, "d2", "earlier", 2)]
    wider = load(spark, rows + news).withColumn("extra", F.lit(7))
    assert merge_partitions(wider, root, ["k"], "at", day) == 2
    after = files_of(tmp_path / "t")
    assert before.items() <= after.items()  # nothing that was written is touched
    assert manifest(spark, root, 2) == {"d0": 2, "d1": 1, "d2": 2, "d3": 2, "d4": 1, "d9": 2, "__null__": 1, "a/b=c": 1}
    now = {r["k"]: (r["v"], r["_part"]) for r in read_partitions(spark, root).collect()}
    want = {k: ("old", d or "__null__") for k, d, _, _ in rows} | {0: ("new", "d0"), 100: ("new", "d9"), 2: ("moved", "d3")}
    assert now == want
    assert merge_partitions(wider, root, ["k"], "at", day) == 3  # nothing new: no file written
    assert files_of(tmp_path / "t") == after and manifest(spark, root, 3) == manifest(spark, root, 2)
    gone = forget_versions(spark, root, keep=2)
    assert sorted(gone) == ["v1/_part=d0", "v1/_part=d2", "v1/_part=d3"]
    assert {r["k"]: (r["v"], r["_part"]) for r in read_partitions(spark, root).collect()} == want


def test_one_writer_per_version(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = load(spark, [(1, "a", "x", 1)])
    assert claim(spark, root) == 1
    with pytest.raises(VersionClaimed):
        merge_partitions(rows, root, ["k"], "at", F.col("day"))
    assert read_partitions(spark, root) is None
    release(spark, root, 1)
    assert merge_partitions(rows, root, ["k"], "at", F.col("day")) == 1
    with pytest.raises(ValueError, match="announced"):
        release(spark, root, 1)


def test_distances_of_large_samples(spark):
    from millrace.plans.drift import drift_distances

    rng = random.Random(2)
    ref = [(rng.gauss(0, 2), float(rng.randrange(3)), None) for _ in range(400)]
    cur = [(rng.gauss(1, 2), float(rng.randrange(2)), 1.0) for _ in range(300)]
    frame = lambda rows: spark.createDataFrame(rows, "a double, b double, c double")
    rows = {r["feature"]: r for r in drift_distances(frame(ref), frame(cur), ["a", "b", "c"]).collect()}
    x, y = sorted(r[0] for r in ref), sorted(r[0] for r in cur)
    points = sorted(x + y)
    below = lambda data, v: sum(d <= v for d in data) / len(data)
    area = sum(abs(below(x, v) - below(y, v)) * (w - v) for v, w in zip(points, points[1:]))
    assert rows["a"]["wasserstein"] == pytest.approx(area / np.std(x)) and rows["a"]["distance"] == rows["a"]["wasserstein"]
    p = [sum(r[1] == v for r in ref) / 400 for v in range(3)]
    q = [sum(r[1] == v for r in cur) / 300 for v in range(3)]
    half = lambda a: sum(s * math.log2(2 * s / (t + u)) for s, t, u in zip(a, p, q) if s) / 2
    assert rows["b"]["distance"] == rows["b"]["jensen_shannon"] == pytest.approx(math.sqrt(half(p) + half(q)))
    assert rows["b"]["drifted"] and rows["c"]["drifted"] and rows["c"]["distance"] is None
    same = drift_distances(frame(ref), frame(ref), ["a"]).first()
    assert same["wasserstein"] == 0 and same["jensen_shannon"] == 0 and not same["drifted"]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_best_of_all_sorts_few(monkeypatch, k):
    """Same answers as sorting whole rows, ties and rounding included, from a few scores of each row."""
    from millrace.operators import similarity

    rng = np.random.default_rng(k)
    scores = rng.normal(size=(20, 400))
    scores[:5] = np.round(scores[:5], 1)
    scores[5:10] += np.where(rng.random((5, 400)) < 0.5, 4e-10, -4e-10) - scores[5:10] + np.round(scores[5:10], 1)
    scores[10] = 0.0
    plain, sizes = similarity._best, []
    for ids in (rng.permutation(400), np.array([f"v{i}" for i in rng.permutation(400)])):
        want = plain([(np.round(scores, similarity.DIGITS), np.broadcast_to(ids, scores.shape))], k)
        got = similarity._best_of_all(scores, ids, k)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    monkeypatch.setattr(similarity, "_best", lambda parts, k: sizes.append(parts[0][0].shape[1]) or plain(parts, k))
    similarity._best_of_all(scores[11:], np.arange(400), k)
    assert sizes == [k]
    assert similarity._best_of_all(np.zeros((0, 400)), np.arange(400), k)[0].shape == (0, k)
    scores[0, 0] = np.nan
    assert (similarity._best_of_all(scores, np.arange(400), k)[0][1:] == plain([(np.round(scores, 9), np.broadcast_to(np.arange(400), scores.shape))], k)[0][1:]).all()
