"""The pipeline: each stage on what its predecessor kept, and odd tables."""

import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as pipeline  # noqa: E402
from millrace.session import materialize  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {"documents": docs}
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        found[name] = docs
    return found


def test_columns_and_shrinking(stages):
    order = ["documents", *[name for name, _ in pipeline.STAGES]]
    assert order[1:] == ["toxicity", "quality", "near_dedup", "mixing", "packing"]
    for before, after in zip(order[:3], order[1:4]):
        assert stages[after].columns == stages["documents"].columns
        assert stages[after].exceptAll(stages[before]).count() == 0
    assert stages["mixing"].columns == stages["documents"].columns


def test_clean_documents_stay(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 AND toxic = 0")
    clean = stages["documents"].join(labels, "doc_id", "left_semi")
    clean = clean.filter(F.size(F.split("text", r"\s+")) >= 60)
    assert stages["quality"].join(clean, "doc_id", "left_semi").count() >= 0.95 * clean.count()


def five_word_sets(docs):
    out = {}
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").lower())
        k = min(5, len(words))
        out[r["doc_id"]] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
    return out


def test_no_near_duplicates_stay(stages):
    before, after = five_word_sets(stages["quality"]), five_word_sets(stages["near_dedup"])
    similar = lambda x, y: x and y and len(x & y) >= 0.8 * len(x | y)
    ids = sorted(after)
    assert not any(similar(after[a], after[b]) for i, a in enumerate(ids) for b in ids[:i])
    # Whatever went is linked to a document with a smaller id.
    for gone in set(before) - set(after):
        assert any(similar(before[gone], before[k]) for k in before if k < gone)


def test_mixing_repeats_whole_documents(stages):
    before = Counter(r["doc_id"] for r in stages["near_dedup"].collect())
    after = Counter(r["doc_id"] for r in stages["mixing"].collect())
    assert set(after) <= set(before) and max(after.values()) <= 2


def test_packing_holds_everything(stages):
    wanted = Counter()
    pieces = defaultdict(int)
    for r in stages["packing"].collect():
        pieces[r["doc_id"]] += r["length"]
        wanted[r["doc_id"]] = r["doc_tokens"]
    copies = Counter(r["doc_id"] for r in stages["mixing"].collect())
    assert all(pieces[i] == n * wanted[i] for i, n in copies.items()) and set(pieces) == set(copies)


def test_run_equals_its_stages(spark, stages):
    got = pipeline.run(spark, SF)
    assert got.count() == stages["packing"].count() and got.columns == stages["packing"].columns


ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string, _c0 string, kept string"


def odd_rows():
    plain = " ".join(f"word{i % 70}x{i}" for i in range(90))
    rows = [(i, f"{plain} own{i} tail{i * 7}", "en", "a" if i % 2 else None) for i in range(12)]
    rows += [(20, None, "en", "a"), (21, "", None, None), (None, plain + " nameless", "en", "a"), (None, plain + " nameless", "en", "a")]
    rows += [(5, f"{plain} own5 tail35", "en", "a"), (30, "long " * 20_000 + plain, None, "b")]
    return [(*r, len(r[1] or ""), "s", "n", "c", "k") for r in rows]


@pytest.mark.parametrize("stage", [name for name, _ in pipeline.STAGES])
@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_tables_and_clashing_names(spark, stage, kind):
    docs = spark.createDataFrame(odd_rows() if kind == "odd" else [], ODD)
    out = dict(pipeline.STAGES)[stage](spark, docs, SF)
    rows = out.collect()
    if stage != "packing":
        assert out.columns == docs.columns
    if kind == "empty":
        assert rows == []
    elif stage == "near_dedup":
        ids = Counter(r["doc_id"] for r in rows)
        assert max(ids.values()) == 1
    elif stage == "packing":
        assert sum(r["length"] for r in rows) > 20_000
