"""Collocations, decontamination and periodic runs against brute force and odd rows."""

import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import collocations as col
from millrace.llm import decontaminate as dec
from millrace.llm import periods
from millrace.llm.common import importable

DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    draw = random.Random(5)
    base = [" ".join(draw.choice("abcde") * draw.randint(1, 2) for _ in range(draw.randint(0, 60))) for _ in range(60)]
    rows = [(i, re.sub(" ", lambda m: draw.choice([" ", " ", " ", ", ", ".\n", "\t"]), t), draw.choice(["x", "y", None])) for i, t in enumerate(base)]
    rows += [(100, None, "x"), (101, "", None), (102, " ,.; ", "x"), (None, "A b c d E a b", "y"), (None, "A b c d E a b", "y")]
    rows += [(200 + i, "One Line, of very common words here. " * 9, "x") for i in range(5)]
    rows += [(300, "b a c a " * 3000, "x"), (7, rows[7][1], rows[7][2])]
    return spark.createDataFrame(rows, DOCS).repartition(5)


# --- Collocations


def brute_phrases(rows, longest, least):
    counts, totals = Counter(), Counter()
    for row in rows:
        lang = row["lang"] or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", row["text"] or ""):
            words = [w for w in re.split(r"[\x20\x09]+", re.sub("[A-Z]", lambda m: m[0].lower(), piece)) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return {x: n for x, n in counts.items() if n >= least}, totals


def brute_collocations(rows, longest, least, top):
    f, n = brute_phrases(rows, longest, least)
    out = []
    for (lang, p), a in f.items():
        longer = [q for (x, q) in f if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if len(p) < 2 or any(f[lang, q] >= a for q in longer):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    result = []
    for lang in n:
        best = sorted(x for x in out if x[0] == lang)[:top]
        result += [(lang, i + 1, p.decode(), -a, l, r, m, -s) for i, (_, s, a, p, l, r, m) in enumerate(best)]
    return sorted(result)


@pytest.mark.parametrize("modulus", [1, 3, 32])
@pytest.mark.parametrize(("longest", "least"), [(5, 4), (3, 2), (2, 300)])
def test_collocations_equal_brute_force(docs, monkeypatch, modulus, longest, least):
    monkeypatch.setattr(col, "BLOCK_BYTES", 2000)  # many blocks
    monkeypatch.setattr(col, "SLOT_WORDS", 500)  # and several slots
    rows = docs.collect()
    found = col.collocations(docs, longest=longest, least=least, top=40, modulus=modulus).collect()
    assert sorted(tuple(r) for r in found) == brute_collocations(rows, longest, least, 40)


def test_chunks_share_their_overlap(docs):
    from millrace.llm.common import WordHash

    for row in docs.collect():
        raw = (row["text"] or "").encode()
        tokens = raw.lower().translate(col.BARRIERS).replace(b",", b" , ").split()
        chunks = [c.split() for c, _ in col.parse(raw, WordHash(), 4, 3)]
        assert [t for c in chunks for t in c[:-4]] == tokens
        assert all(a[-4:] == b[:4] for a, b in zip(chunks, chunks[1:]))


def test_blocks_number_their_tokens_without_a_python_step_for_each():
    rng = random.Random(2)
    chunks = [b" ".join(rng.choices([b"a", b"bb", "ß日".encode(), b"\x1c", b",", b"w7"], k=rng.randint(1, 20))) for _ in range(400)]
    row = {
        "langs": ["de", "en"], "chunks": b" \n ".join(chunks), "copies": np.ones(400, np.int64).tobytes(),
        "chunk_langs": np.arange(400, dtype=np.int32).__mod__(2).tobytes(),
    }
    col.Block(row, 4)  # imports what the first call needs
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        block = col.Block(row, 4)
    finally:
        sys.setprofile(None)
    tokens = row["chunks"].split(b" ")
    assert len(calls) < len(tokens) / 4
    names = block.vocabulary.to_pylist()
    assert [names[i] for i in block.words] == tokens and len(set(names)) == block.size
    first, size = np.array([0, 5, len(tokens) - 2]), np.array([3, 1, 2])
    assert block.phrases(first, size) == [b" ".join(tokens[i : i + k]) for i, k in zip(first, size, strict=True)]
    keys = np.unique(np.array([rng.getrandbits(36) for _ in range(500)], np.uint64))
    asked = np.append(keys[::2], np.array([rng.getrandbits(36) for _ in range(500)] + [int(keys[3]) ^ 1 << 30], np.uint64))
    assert col._among(keys, asked << np.uint64(28), 4).tolist() == np.isin(asked, keys).tolist()


def test_collocations_of_nothing(spark, docs):
    assert col.collocations(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, None, 1), ("", "x", 2)], "text string, lang string, f int")
    assert col.collocations(odd, least=1).count() == 0


# --- Decontamination


def windows_of(text, size=10):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    size = min(size, len(words))
    return words, {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_hits(text, items):
    words, hit, found = windows_of(text)[0], set(), set()
    for item, passage in items:
        for window in windows_of(passage)[1]:
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


@pytest.fixture(scope="module")
def passages(spark):
    draw = random.Random(6)
    word = [f"w{i}" for i in range(30)] + ["the"] * 20 + ["Ünd", "12"]
    rows = [(i, " ".join(draw.choice(word) for _ in range(draw.choice([1, 2, 4, 9, 10, 11, 40])))) for i in range(25)]
    rows += [(90, None), (91, " -- "), (None, "null id item"), (5, rows[6][1]), (92, rows[3][1])]
    texts = []
    for i in range(80):
        parts = [" ".join(draw.choice(word) for _ in range(draw.randint(0, 30)))]
        if draw.random() < 0.6:
            words = (draw.choice(rows)[1] or "").upper().split() or ["x"]
            at = draw.randrange(len(words))
            parts += ["!! ".join(words[at:] if draw.random() < 0.5 else words)]
        texts.append((i, " ".join(parts)))
    texts += [(None, None), (None, ""), (None, rows[24][1]), (3, texts[3][1]), (3, "the the the"), (99, " ".join(["the"] * 400))]
    return spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("bound", [dec.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("shingle", [5, 1, 10])
def test_contamination_equals_brute_force(passages, bound, shingle):
    texts, items = passages
    listed = [tuple(r) for r in items.collect()]
    want = Counter((r["doc_id"], n, h, tuple(f)) for r in texts.collect() for n, h, f in [brute_hits(r["text"], listed)])
    clash = texts.withColumn("n_hit", F.lit(1)).withColumn("window", F.lit(2))
    found = dec.contamination(clash, items.withColumn("size", F.lit(0)), shingle=shingle, broadcast_bytes=bound)
    assert Counter((r[0], r[1], r[2], tuple(r[3])) for r in found.collect()) == want


def test_contamination_with_missing_shingles(spark):
    passage = [f"w{i}" for i in range(10)]
    near = passage[:9] + ["other"]
    texts = spark.createDataFrame([(1, " ".join(passage)), (2, " ".join(near)), (3, " ".join(["o", *passage[1:5], "p", *passage[6:]]))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string")
    found = {r["doc_id"]: r["n_hit"] for r in dec.contamination(texts, items, shingle=3, missing=1).collect()}
    assert found == {1: 10, 2: 10, 3: 0}
    assert {r["doc_id"]: r["n_hit"] for r in dec.contamination(texts, items, shingle=3).collect()} == {1: 10, 2: 0, 3: 0}


def test_contamination_of_nothing(passages):
    texts, items = passages
    assert dec.contamination(texts.limit(0), items).count() == 0
    assert {r["n_hit"] for r in dec.contamination(texts, items.limit(0)).collect()} == {0}


# --- Periodic runs


def brute_runs(words, shortest=6, exponent=4):
    found = set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(shortest, exponent * q):
                part = words[i : i + length]
                if not any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_lyndon(word):
    out = []
    for i in range(len(word)):
        j = i + 1
        while j < len(word) and list(word[j:]) > list(word[i:]):
            j += 1
        out.append(j - i)
    return out


def samples():
    draw = random.Random(7)
    for _ in range(400):
        words = []
        for _ in range(draw.randint(0, 6)):
            part = [draw.choice("abc") for _ in range(draw.randint(1, 7))]
            words += part * draw.choice([1, 1, 2, 5, 6]) + part[: draw.randrange(len(part))]
        yield words
    for n in range(1, 12):
        yield [draw.choice("ab") for _ in range(n)]
    yield ["a"] * 500


def test_lyndon_lengths_equal_brute_force():
    for words in samples():
        ids = np.array([ord(w) for w in words], np.int64)
        for order in (ids, -ids):
            assert periods.lyndon_lengths(order).tolist() == brute_lyndon(order.tolist())


@pytest.mark.parametrize(("shortest", "exponent"), [(6, 4), (2, 2), (9, 3)])
def test_runs_equal_brute_force(shortest, exponent):
    for words in samples():
        assert [tuple(r) for r in periods.word_runs(words, shortest, exponent).tolist()] == brute_runs(words, shortest, exponent)


def test_periodic_query_equals_brute_force(spark, docs, tmp_path):
    import hashlib

    docs.withColumn("runs", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    found = periods.op13(spark, str(tmp_path)).collect()
    want = []
    for row in docs.collect():
        words = (row["text"] or "").split()
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if row["doc_id"] is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        drop = {i for s, m, q in runs for i in range(s + q, s + m)}
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        want.append(
            (row["doc_id"], len(runs), *best, best[1] and 1000 * best[1] // best[2],
             hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
        )
    assert Counter(tuple(r) for r in found) == Counter(want)
    assert periods.periodic_runs(docs.limit(0)).count() == 0
