"""Language model, toxicity and language identification: brute force, gradients, held-out accuracy."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import common, kneser_ney, langid, toxicity
from millrace.llm.common import importable

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score string"


def brute_kneser_ney(texts):
    """Probabilities of a small corpus from dictionaries."""
    lower_case = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = lambda t: ["</s>", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower_case)), "</s>"]
    pairs = Counter(p for t in texts for p in zip(tokens(t), tokens(t)[1:]))
    words, before, follow = Counter(), defaultdict(set), defaultdict(Counter)
    for (u, w), n in pairs.items():
        words[w] += n
        before[w].add(u)
        follow[u][w] = n
    few = lambda counts: kneser_ney.discounts(Counter(c for c in counts if c < 5))
    high, low = few(pairs.values()), few(len(b) for b in before.values())
    cut = lambda d, n: d[min(n, 3) - 1] if n else 0.0
    spare = sum(cut(low, len(b)) for b in before.values()) / len(pairs)

    def score(text):
        total = base = 0.0
        t = tokens(text)
        for u, w in zip(t, t[1:]):
            p = max(len(before[w]) - cut(low, len(before[w])), 0) / len(pairs) + spare / (len(words) + 1)
            if u in follow:
                n, all_n = follow[u][w], sum(follow[u].values())
                p = max(n - cut(high, n), 0) / all_n + sum(cut(high, c) for c in follow[u].values()) / all_n * p
            total += math.log10(p)
            base += math.log10((words[w] + 0.5) / (sum(words.values()) + 0.5 * (len(words) + 1)))
        return total, base, len(t) - 1, sum(words[w] > 0 for w in t[1:])

    return score, sum(words.values()), words


def test_language_model_against_brute_force(spark):
    draw = random.Random(6)
    corpus = [" ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(draw.randint(0, 40))) for _ in range(60)]
    corpus += [None, "", corpus[0], "É é", "A a"]
    asked = ["a b zz", None, "unseen words only", "é", "A É", *corpus]
    frame = lambda rows: spark.createDataFrame([(i, t, None, "x") for i, t in enumerate(rows)], DOCS)
    model = kneser_ney.fit(frame(corpus))
    got = {r["doc_id"]: r for r in kneser_ney.score(frame(asked), model, ["doc_id"]).collect()}
    score, total, _ = brute_kneser_ney(corpus)
    for i, text in enumerate(asked):
        want = score(text)
        assert got[i]["score"] == pytest.approx(want[0], abs=1e-9) and got[i]["base_score"] == pytest.approx(want[1], abs=1e-9)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (*want[2:], total)


def test_language_model_is_a_distribution(spark):
    frame = spark.createDataFrame([(0, "a b a c b a", None, "x"), (1, "c c a", None, "x")], DOCS)
    model = kneser_ney.fit(frame)
    hashes = kneser_ney.WordHash()
    words = np.append(hashes.of([b"a", b"b", b"c", b"unknown"]), kneser_ney.END)
    for u in words:
        _, logs = model.score(np.full(len(words), u), words)
        assert (10**logs).sum() == pytest.approx(1)


def test_bigrams_are_stored_by_first_word(spark, monkeypatch):
    plain, seen = kneser_ney.materialize, {}
    monkeypatch.setattr(kneser_ney, "materialize", lambda df, label: seen.setdefault(label, plain(df, label)))
    draw = random.Random(7)
    kneser_ney.fit(spark.createDataFrame([(i, " ".join(draw.choices("abcdefghijkl", k=40)), None, "x") for i in range(20)], DOCS))
    files = defaultdict(list)
    for r in seen["bigrams"].select("before", F.input_file_name().alias("file")).collect():
        files[r["file"]].append(r["before"])
    assert files and all(rows == sorted(rows) for rows in files.values())


def test_bigrams_are_shuffled_once(spark, monkeypatch):
    """The shuffle that sums them up also deals them out to their files."""
    plain, plans = kneser_ney.materialize, []
    monkeypatch.setattr(kneser_ney, "materialize", lambda df, label: plans.append((label, df._jdf.queryExecution().executedPlan().toString())) or plain(df, label))
    frame = spark.createDataFrame([(i, f"a b c w{i % 7} w{i}", None, "x") for i in range(60)], DOCS)
    model = kneser_ney.fit(frame)
    assert [label for label, _ in plans] == ["bigrams", "words", "contexts", "shards", "shards"]
    assert plans[0][1].count("Exchange") == 1
    # Nothing is lost on the way: files hold every bigram that was counted.
    keys = np.concatenate([kneser_ney._shard(model.bigrams.uri, file, 1)[0] for file in model.bigrams.filled])
    assert len(keys) == len(np.unique(keys)) == model.pairs


def test_hash_of_a_bigram(spark):
    draw = np.random.default_rng(2)
    before, word = (draw.integers(0, 1 << 64, 50_000, np.uint64, endpoint=False) for _ in range(2))
    keys = kneser_ney.pair_key(before, word, 16)
    assert len(np.unique(keys)) == 50_000 and keys.dtype == np.uint64
    for bit in range(16):
        own = (before, word)[bit % 2] >> np.uint64(63 - bit // 2) & np.uint64(1)
        assert (keys >> np.uint64(63 - bit) & np.uint64(1) == own).all()
    # A word with very many neighbours lies in many ranges, on either side.
    hot = np.full_like(word, before[0])
    for pair in ((hot, word), (word, hot)):
        share = np.bincount(kneser_ney.cells(*pair, 6).astype(int), minlength=64)
        assert (share > 0).sum() == 8 and share.max() < 50_000 / 7
    # Spark finds the same keys.
    for bits in (6, 7, 16):
        few = [kneser_ney.cells(before[:300], word[:300], bits), before[:300].view(np.int64), word[:300].view(np.int64)]
        frame = spark.createDataFrame(list(zip(*[c.tolist() for c in few], strict=True)), "cell int, before long, word long")
        got = {(r["before"], r["word"]): r["key"] for r in kneser_ney.keyed(frame, bits).collect()}
        want = kneser_ney.pair_key(before[:300], word[:300], bits).view(np.int64).tolist()
        assert got == dict(zip(zip(few[1].tolist(), few[2].tolist()), want))


def test_files_of_arrays(tmp_path):
    """Files end at a number of rows and where a range of keys ends; keys are found in all of them and nowhere else."""
    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(-(1 << 63), 1 << 63, 3_000))
    large = lambda k: np.where(k > 1 << 62, 1 << 40, 1) + np.abs(k) % 900
    told = []
    for own in (keys[keys < 0], keys[keys >= 0]):
        batches = [common.rows_to_table({"key": own[i : i + 70], "n": large(own[i : i + 70])}) for i in range(0, len(own), 70)]
        rows = list(kneser_ney.array_files(str(tmp_path), ["n"], 2, passed=True, most=200)(iter(batches)))
        assert (np.concatenate([r.column("key").to_numpy() for r in rows]) == own).all()
        passed = np.concatenate([r.column("file").to_numpy() for r in rows])
        assert (passed <= own).all()
        names = [r.column("file")[0].as_py() for r in kneser_ney.array_files(str(tmp_path), ["n"], 2, most=200)(iter(batches))]
        assert names == np.unique(passed).tolist()
        told += names
    # Some 200 rows and never more than a batch beyond; the first key of each quarter begins a file.
    assert 3_000 / 270 <= len(told) <= 3_000 / 200 + 4 and {int(keys[keys >> 62 == q][0]) for q in range(-2, 2)} <= set(told)
    arrays = kneser_ney.SortedArrays(str(tmp_path), tuple(sorted(told)), 1)
    assert (arrays.find(keys)[0] == large(keys)).all()
    other = np.setdiff1d(draw.integers(-(1 << 63), 1 << 63, 3_000), keys)
    assert not arrays.find(other).any()
    assert not kneser_ney.SortedArrays(str(tmp_path), (), 1).find(keys).any()


def test_language_model_empty(spark):
    nothing = spark.createDataFrame([], DOCS)
    model = kneser_ney.fit(nothing)
    assert kneser_ney.score(nothing, model, ["doc_id"]).count() == 0
    row = kneser_ney.score(spark.createDataFrame([(1, "a", None, "x")], DOCS), model, ["doc_id"]).first()
    assert row["score"] == 0 and row["train_tokens"] == 0


def test_model_beats_base_on_held_out(spark):
    r = kneser_ney.op3(spark, SF).groupBy("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).collect()
    assert all(x["s"] > x["b"] for x in r)


PLAIN = "idiot stupid moron loser stone house train apple water river music plant".split()


@pytest.fixture(scope="module")
def chars():
    counts = Counter()
    for word in PLAIN:
        marked = f"^^{word}$"
        counts.update(marked[i : i + 3] for i in range(len(marked) - 2))
    return toxicity.CharModel({k: 20 * n for k, n in counts.items()})


@pytest.mark.parametrize(
    "written,word",
    [("1d10t", "idiot"), ("stup1d", "stupid"), ("st-u-p-i-d", "stupid"), ("m0r0n", "moron"), ("l.o.s.e.r", "loser"),
     ("idiooot", "idiot"), ("$tupid", "stupid"), ("mmmoronnn", "moron"), ("", "")],
)
def test_restoring(chars, written, word):
    assert toxicity.restore(written, chars) == word


def test_outer_signs():
    assert [toxicity.core(w) for w in (b"Word***", b'"a.b",', b"x$$$", b"%%%", b"")] == ["word", "a.b", "x", "", ""]
    assert toxicity.core(b"$tupid!!!") == "$tupid"


def labelled(spark, n=600):
    draw = random.Random(9)
    words = [w for w in PLAIN if w not in PLAIN[:4]]
    rows, labels = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            text[draw.randrange(40)] = draw.choice(PLAIN[:4])
        rows.append((i, " ".join(text), "en", "x"))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_of_hidden_words(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    asked = ["the house is 1d10t water", "you m.o.r.o.n stone", "river s t u p i d plant", "loooser", "music 1234 house", None, "", "apple " * 30_000]
    frame = spark.createDataFrame([(i, t, "en", "x") for i, t in enumerate(asked)], DOCS)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(frame.drop("score"), model, ["doc_id"]).collect()}
    assert [got[i] for i in range(len(asked))] == [1, 1, 1, 1, 0, 0, 0, 0]


def test_toxicity_learns_from_all_labels(spark):
    ids = spark.range(26_000).withColumnRenamed("id", "doc_id")
    rare = F.when(F.col("doc_id") % 2_000 == 0, "zaffle").otherwise("river")
    docs = ids.select("doc_id", F.concat_ws(" ", F.lit("apple"), rare).alias("text"))
    model = toxicity.fit(docs, ids.select("doc_id", (F.col("doc_id") % 2_000 == 0).cast("int").alias("toxic")))
    first = ids.filter(common.share_below("doc_id", 12, 0.5))
    assert model.chars["^^a"] == first.count()
    assert model.chars["^^z"] == first.filter("doc_id % 2000 = 0").count()


def test_toxicity_without_labels(spark):
    docs, labels = labelled(spark, 10)
    model = toxicity.fit(docs, labels.filter("false"))
    assert {r["predicted"] for r in toxicity.toxicity(docs.drop("score"), model, ["doc_id"]).collect()} == {0}
    one_class = toxicity.fit(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert one_class.weights == {}


def shuffled_texts(spark, monkeypatch, docs, labels):
    """What ``fit`` learns, and the columns that its stored plans shuffle beside ids."""
    plain, plans = toxicity.materialize, {}

    def stored(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return plain(df, label)

    monkeypatch.setattr(toxicity, "materialize", stored)
    return toxicity.fit(docs, labels), plans


def test_toxicity_shuffles_texts_that_may_be_labelled(spark, monkeypatch):
    docs, labels = labelled(spark)
    _, plans = shuffled_texts(spark, monkeypatch, docs, labels.filter("doc_id < 100"))
    assert "bitmap_construct_agg" in plans["words"] and "bitmap_construct_agg" in plans["evidence"]
    # Evidence is found before the join, so no text of the second half is sent.
    assert plans["evidence"].index("strategy=merge") < plans["evidence"].index("MapInArrow")


def test_toxicity_of_odd_labels(spark):
    """Null and repeated ids, several labels of one id, ids of another type, texts that are null or come twice."""
    docs, labels = labelled(spark)
    more = spark.createDataFrame([(None, "idiot stone", "en", "x"), (0, "idiot house", "en", "x"), (7, None, "en", "x"), (1_000, "idiot", "en", "x")], DOCS)
    odd = spark.createDataFrame([(None, 1), (1, None), (0, 0), (5_000, 1)], "doc_id long, toxic int")
    docs, labels = docs.union(more), labels.filter("doc_id < 400").union(odd)
    # By hand: the texts of the first half, joined with the largest label of each id.
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    joined = docs.join(known, "doc_id").withColumn("first", common.share_below("doc_id", 12, 0.5))
    rows = joined.select("first", "text", "toxic").collect()
    chars = Counter()
    for r in rows:
        for word in {toxicity.core(w) for w in (r["text"] or "").encode().split()} if r["first"] else ():
            chars.update(f"^^{word}$"[i : i + 3] for i in range(len(word) + 1))
    model = toxicity.fit(docs, labels)
    assert model.chars == chars
    scores = toxicity.WordScores(model)
    x = np.array([[1, *scores.evidence((r["text"] or "").encode())] for r in rows if not r["first"]])
    y = np.array([r["toxic"] for r in rows if not r["first"]])
    # The gradient of the penalised likelihood vanishes over exactly these rows.
    w = np.array(model.logistic)
    assert np.abs(x.T @ (y - 1 / (1 + np.exp(-x @ w))) - np.array([0, 0.1, 0.1, 0.1, 0.1]) * w).max() < 1e-3
    # Join keys of another type match as they did.
    short = toxicity.fit(docs.withColumn("doc_id", F.col("doc_id").cast("int")), labels.withColumn("doc_id", F.col("doc_id").cast("int")))
    assert sum(short.chars.values()) > 0
    assert toxicity.fit(docs, labels.withColumn("doc_id", F.col("doc_id").cast("int"))).chars


def test_toxicity_on_held_out(spark):
    got = toxicity.op2(spark, "/root/testdata/sf0.1").filter("held_out").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    r = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")), F.avg("toxic")).first()
    assert r[0] > 0.97


def test_gradients_of_the_network():
    """Backpropagation through time against differences."""
    network = langid.Network.initial(["a", "b", "c"], 4, 1)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    words, labels = [b"abcab", b"zz", b"q"], np.array([0, 1, 2])
    codes, lengths = langid._codes(words)
    mask = (np.arange(codes.shape[0])[:, None] < lengths)[:, :, None]

    def loss():
        logs = langid.position_logs(network, codes, lengths)
        return -(logs * mask)[:, np.arange(3), labels].sum()

    logs, both, turn, kept_f, kept_b = langid.position_logs(network, codes, lengths, keep=True)
    slope = np.exp(logs)
    slope[:, np.arange(3), labels] -= 1
    slope = np.where(mask, slope, 0)
    up = slope @ network.weights["out"].T
    grads = langid._backward(network.weights, "f", codes, kept_f, up[:, :, :4])
    turned = np.take_along_axis(codes, turn, 0)
    grads |= langid._backward(network.weights, "b", turned, kept_b, np.take_along_axis(up[:, :, 4:], turn[:, :, None], 0))
    draw = np.random.default_rng(0)
    for name, grad in grads.items():
        w = network.weights[name]
        for _ in range(6):
            at = (int(codes[0, 0]) if name.endswith("_in") else draw.integers(w.shape[0]), draw.integers(w.shape[1]))
            old, step = w[at], 1e-3
            w[at] = old + step
            high = loss()
            w[at] = old - step
            low = loss()
            w[at] = old
            assert grad[at] == pytest.approx((high - low) / (2 * step), rel=2e-2, abs=2e-3)


def test_language_on_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = langid.op9(spark, SF).filter("held_out").join(docs, "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_language_odd_rows(spark):
    rows = [(i, f"the house and the water {i}", "en", "x") for i in range(40)]
    rows += [(100 + i, f"das Haus und über Wasser {i}", "de", "x") for i in range(40)]
    rows += [(None, "and then", None, "x"), (300, None, "de", "x"), (301, "", "de", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    network = langid.fit(docs)
    asked = [("the and", "en"), ("und über", "de"), (None, "und"), ("", "und"), ("123 !?", "und"), ("und " * 40_000, "de"), ("the" * 20_000, "en")]
    frame = spark.createDataFrame([(i, t, None, "x") for i, (t, _) in enumerate(asked)], DOCS).drop("score")
    got = {r["doc_id"]: r for r in langid.identify(frame, network, ["doc_id"]).collect()}
    assert [got[i]["lang_pred"] for i in range(len(asked))] == [name for _, name in asked]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(frame.limit(0), network, ["doc_id"]).count() == 0
    lone = langid.fit(docs.filter("lang = 'de'"))
    assert langid.identify(frame, lone, ["doc_id"]).filter("doc_id = 0").first()["lang_pred"] == "de"
    none = langid.fit(docs.filter("lang = 'xx'"))
    assert langid.identify(frame, none, ["doc_id"]).filter("doc_id = 0").first()["lang_pred"] == "und"


def test_a_lost_file_of_the_language_model_raises(spark):
    """Keys of a file that was written and is gone must not pass for unseen."""
    importable(spark)
    frame = spark.createDataFrame([(i, f"a b c w{i}") for i in range(40)], "doc_id long, text string")
    model = kneser_ney.fit(frame)
    assert model.words.filled
    files, path = common.shared_files(model.words.uri)
    for shard in model.words.filled:
        files.delete_file(f"{path}/{shard}")
    kneser_ney._shard.cache_clear()
    with pytest.raises(Exception, match="No such file|FileNotFound"):
        model.words.find(np.sort(kneser_ney.WordHash().of([b"a", b"b"]).view(np.int64)))
