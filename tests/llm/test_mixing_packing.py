"""Mixing and packing: brute force, balance, and odd rows."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import mixing
from millrace.llm.mixing import mix_copies
from millrace.llm.packing import deficit_schedule, pack, vocabulary_path

SF = "/root/testdata/sf0.01"
ODD = [
    (1, "one two three", "a", 5),
    (1, "one two three", "a", 5),
    (2, None, "a", 5),
    (3, "", None, 5),
    (None, "l'été   naïvé x\tY\x0bz 12 <|endoftext|>", "b", 5),
    (5, "word " * 30_000, "b", 5),
    (6, " \n\t ", "", 5),
    (7, "alone", "c", 5),
]
SCHEMA = "doc_id long, text string, source string, size int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, limit=2.0) -> dict:
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(limit * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        now = {s: limit * sizes[s] if s in full else rest * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and now[s] > limit * sizes[s]}
        if not over:
            return now
        full |= over


def check_mix(rows, near):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 2
    for source, wanted in targets(sizes).items():
        assert target[source] == pytest.approx(wanted, rel=1e-9, abs=1e-6)
        assert abs(taken[source] - wanted) <= near(source)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mix_copies(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]]))
    longest = defaultdict(int)
    for r in rows:
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    check_mix(rows, lambda s: longest[s])


def test_mix_converges_for_small_targets(spark):
    """A long-tailed source among thousands: its multiplier goes far beyond what a few bounded steps reach."""
    docs = [(i, "w " * (5000 if i < 100 else 5), "0") for i in range(1000)]
    docs += [(1000 + i, "x " * 1512, f"s{i:04d}") for i in range(3000)]
    mixed = mixing.mix_copies(spark.createDataFrame(docs, "doc_id long, text string, source string")).filter("source = '0'")
    row = mixed.agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).first()
    assert row["target"] < 5000 and abs(row["taken"] - row["target"]) <= 0.02 * row["target"]


def test_tilt_equals_a_solver(spark):
    """Multipliers against bisection in plain numbers."""
    rng = random.Random(3)
    sources = {s: [rng.choice([1, 3, 10, 400]) for _ in range(rng.randint(1, 60))] for s in "abcde"}
    share = {"a": 0.001, "b": 0.3, "c": 1.0, "d": 1.9, "e": 1.9999}
    rows = [(s, n, sizes.count(n)) for s, sizes in sources.items() for n in set(sizes)]
    targets = [(s, sum(x), share[s] * sum(x)) for s, x in sources.items()]
    found = mixing.tilt(
        spark.createDataFrame(rows, "source string, size long, docs long"),
        spark.createDataFrame(targets, "source string, source_size long, target double"), 2,
    )
    for r in found.collect():
        sizes = sources[r["source"]]
        mean = sum(sizes) / len(sizes)
        words = lambda m: sum(n * 2 / (1 + math.exp(min(700, -m * n / mean))) for n in sizes)  # noqa: E731,B023
        assert words(r["multiplier"]) == pytest.approx(r["target"], rel=1e-3, abs=0.01)


def test_mix_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = sorted(mix_copies(docs).select("doc_id", "copies").collect())
    again = sorted(mix_copies(docs.repartition(7)).select("doc_id", "copies").collect())
    assert first == again


def test_mix_odd_rows(spark, odd):
    rows = mix_copies(odd).collect()
    assert len(rows) == len(ODD)
    check_mix(rows, lambda s: 30_000)
    assert all(r["copies"] == 0 for r in rows if r["size"] == 0)


def test_mix_empty(spark):
    assert mix_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def check_pack(rows, docs, width):
    coder = Tokenizer.from_file(vocabulary_path())
    wanted = defaultdict(int)
    ids = {}
    for doc_id, text in docs:
        found = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        ids[doc_id] = np.asarray(found, "<u4")
        wanted[doc_id] += len(found)
    got, used = defaultdict(int), defaultdict(list)
    for r in rows:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["length"] > 0 and len(piece) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert zlib.crc32(piece.tobytes()) == zlib.crc32(bytes(r["piece_ids"]))
        got[r["doc_id"]] += r["length"]
        used[r["sequence_id"]].append((r["offset"], r["length"], r["padding"]))
    assert got == wanted
    for k, pieces in used.items():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        full = at if at & (at - 1) == 0 else width
        assert at <= width and pieces[0][2] == full - at
        if k != max(used):
            assert at == width


def test_pack_matches_tokenizer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pack(docs, vocabulary_path()).collect()
    check_pack(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)


@pytest.mark.parametrize("width", [1, 8, 2048])
def test_pack_odd_rows(spark, odd, width):
    rows = pack(odd.filter("doc_id != 5 OR doc_id IS NULL") if width == 1 else odd, vocabulary_path(), width=width)
    check_pack(rows.collect(), [r[:2] for r in ODD if not (width == 1 and r[0] == 5)], width)


def test_pack_empty(spark):
    assert pack(spark.createDataFrame([], SCHEMA), vocabulary_path()).count() == 0


def test_deficits_follow_round_robin(spark):
    """The closed form sends documents in the order of a simulated deficit round-robin."""
    rng = np.random.default_rng(3)
    rows = [(i, "abc"[int(rng.integers(3))], int(rng.integers(1, 40))) for i in range(200)]
    width = 64
    frame = spark.createDataFrame(rows, "_row long, _source string, tokens long")
    got = [r["_row"] for r in deficit_schedule(frame, width).orderBy("_end").collect()]
    queues = {s: [r for r in rows if r[1] == s] for s in "abc"}
    total = sum(r[2] for r in rows)
    quantum = {s: width * sum(r[2] for r in q) / total for s, q in queues.items()}
    deficit, want = dict.fromkeys(queues, 0.0), []
    while any(queues.values()):
        for s in "abc":
            deficit[s] += quantum[s]
            while queues[s] and queues[s][0][2] <= deficit[s] + 1e-9:
                deficit[s] -= queues[s][0][2]
                want.append(queues[s].pop(0)[0])
    assert got == want


def test_every_sequence_has_the_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.col("lang"))
    rows = pack(docs, vocabulary_path()).groupBy("sequence_id").pivot("source").sum("length").fillna(0).collect()
    whole = np.array([[r[s] for s in ("de", "en", "es", "fr")] for r in rows], float)
    share = whole.sum(0) / whole.sum()
    order = np.argsort([r["sequence_id"] for r in rows])
    drift = np.cumsum(whole[order], 0) - np.cumsum(whole.sum(1)[order])[:, None] * share
    longest = docs.select(F.max(F.length("text"))).first()[0]
    assert np.abs(drift).max() <= longest


def test_words_have_the_ids_of_the_tokenizer():
    from millrace.llm.packing import WordIds

    words = WordIds(vocabulary_path())
    odd = "ΑΣ. İstanbul! İ! ét́. don't. 'tis; x'll! a̸. ≠ ﬁ. ª! 1st.. Ⅷ. ŉ ß? IT'S. ǅ ᾳ <|endoftext|>. ÀÉ,"
    made = [chr(c) + x for c in range(0x21, 0x3000) for x in ("a.", "!", "A")]
    for word in [*odd.split(), *made]:
        if word.split() == [word]:
            ids = words.tokenizer.encode(word, add_special_tokens=False).ids
            assert words.of(word.encode()) == np.asarray(ids, "<u4").tobytes(), word


def test_carried_columns_are_not_sorted(spark, monkeypatch):
    plain, seen = mixing.running_totals, []

    def watched(df, *rest):
        seen.append(df.columns)
        return plain(df, *rest)

    monkeypatch.setattr(mixing, "running_totals", watched)
    docs = spark.createDataFrame([(i, "a b " * (i % 5), "xy"[i % 2]) for i in range(40)], "doc_id long, text string, source string")
    mixed = mixing.mix_copies(docs, carry=("doc_id", "text"))
    assert mixed.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).isEmpty() and mixed.count() == 40
    assert seen and not any(c.startswith("_carry_") for columns in seen for c in columns)


def test_marks_are_told_apart_without_changing_ids():
    import pyarrow as pa

    from millrace.llm.packing import WordIds, marks_apart

    words = WordIds(vocabulary_path())
    tails = ("a. b", "a, ", "a.", "é! x", "×. x", "÷, x", "?. x", "1, x", "a.. x", "a.\u0301 x", "e\u0301. x", "Σ. x", "'S, x")
    made = [None, "", ". a", ", ", *tails, *[f"Ab{x} {y}" for x in tails for y in tails]]
    for column in (pa.array(made), pa.array(["zz, ", *made]).slice(1), pa.array(made, pa.large_string())):
        apart = marks_apart(column)
        assert len(apart) == len(made)
        for text, raw in zip(made, apart, strict=True):
            ids = words.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert words.of(raw) == np.asarray(ids, "<u4").tobytes(), text
    assert marks_apart(pa.array(["Ab, c. d"])) == [b"ab , c . d"]
    assert marks_apart(pa.array([], pa.string())) == []


def test_ids_are_stored_in_as_few_bytes_as_they_need(spark):
    from millrace.llm.packing import tokenize

    docs = spark.createDataFrame([("a bc def",), (None,)], "text string")
    rows = tokenize(docs, "text", [], vocabulary_path()).collect()
    assert [len(r["ids"]) for r in rows] == [2 * r["tokens"] for r in rows]
