"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays.

A text is its words with ``A-Z`` in lower case, then one end token; the end also stands before the
first word. Bigrams are counted in each batch, summed by Spark, and written as arrays sorted by a
64-bit hash: one file per hash range in the shared folder. Workers map these files into memory and
look their bigrams up by binary search, so a model may be far larger than any worker's memory.

The key of a bigram begins with bits of its two words in turn, and bigrams are dealt out by these bits:
the same shuffle serves the sums and the files, a task meets a word again and again, which packs well,
and a word with very many neighbours is spread over many tasks.

Discounts for counts 1, 2, and 3 or more follow from the counts of counts. Words are weighted by the
number of different words they follow; the discount's mass goes to a uniform law over the known words
and one unknown word. The order is 2: counted three words deep, nearly every trigram of a corpus is
new, and the table would outgrow the texts.

Null and empty texts are the end token alone. Repeated rows count repeatedly. Without training text
every word is unknown and has probability 1.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WordHash, fold, mapped_bytes, mix, query, rows_to_table, table, texts, write_shared
from millrace.session import materialize, new_path

END = np.uint64(0xE4D0E4D0E4D0E4D1)  # the hash of the end token; words have hashes of their bytes
SHARD_ROWS = 500_000
MIN_SHARDS = 64
TURNS = 8  # bits of each word at the front of a bigram's key, at most
PRIMES = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)
TURN_BITS = np.array([sum((v >> i & 1) << 2 * i for i in range(TURNS)) for v in range(1 << TURNS)], np.uint64)
BATCH_TOKENS = 4_000_000  # counted at once: about 250 MB in a worker


def token_pairs(raw: bytes, hashes: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's tokens and of the tokens before them."""
    words = hashes.of(raw.lower().split())
    tokens = np.append(words, END)
    return np.concatenate([[END], words]), tokens


def cells(before: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    """A range of keys for each bigram: the first ``bits`` of both words' hashes, in turn."""
    turns = TURN_BITS[before >> np.uint64(64 - TURNS)] << np.uint64(1) | TURN_BITS[word >> np.uint64(64 - TURNS)]
    return turns >> np.uint64(2 * TURNS - bits)


def xxhash64(*columns: np.ndarray) -> np.ndarray:
    """Spark's function of this name, for columns of 64-bit numbers."""
    value = np.full(len(columns[0]), 42, np.uint64)
    with np.errstate(over="ignore"):
        for column in columns:
            mixed = column * PRIMES[1]
            value = value + PRIMES[4] + np.uint64(8) ^ (mixed << np.uint64(31) | mixed >> np.uint64(33)) * PRIMES[0]
            value = (value << np.uint64(27) | value >> np.uint64(37)) * PRIMES[0] + PRIMES[3]
            value = (value ^ value >> np.uint64(33)) * PRIMES[1]
            value = (value ^ value >> np.uint64(29)) * PRIMES[2]
            value ^= value >> np.uint64(32)
    return value


def pair_key(before: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    """The ``key`` of ``keyed``."""
    return cells(before, word, bits) << np.uint64(64 - bits) | xxhash64(before, word) >> np.uint64(bits)


def keyed(bigrams: DataFrame, bits: int) -> DataFrame:
    """Add ``key``, one hash of both words that begins with the ``bits`` of the cell."""
    cell = F.shiftleft(F.col("cell").cast("long"), 64 - bits)
    return bigrams.withColumn("key", cell.bitwiseOR(F.shiftrightunsigned(F.xxhash64("before", "word"), bits)))


def _count(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of parallel arrays with their number, ordered by a hash of the row."""
    key = columns[0] if len(columns) == 1 else mix(*columns)
    _, first, number = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in columns], number


def bigram_counts(docs: DataFrame, text: str, bits: int) -> DataFrame:
    """``cell, before, word, n`` over all texts, dealt out by cells. Each batch sends a bigram once, next to others of
    its first word.
    """

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            before, tokens = [], []
            held = 0
            for raw in texts(batch.column("_text")):
                b, t = token_pairs(raw, hashes)
                before.append(b)
                tokens.append(t)
                held += len(t)
                if held >= BATCH_TOKENS:
                    yield rows(before, tokens)
                    before, tokens, held = [], [], 0
            if tokens:
                yield rows(before, tokens)

    def rows(before, tokens):
        pairs = [np.concatenate(before), np.concatenate(tokens)]
        before.clear()
        tokens.clear()
        (b, t), n = _count(pairs)
        del pairs
        cell = cells(b, t, bits).astype(np.int32)
        order = np.argsort(cell.astype(np.uint64) << np.uint64(64 - bits) | b >> np.uint64(bits))
        found = {"cell": cell, "before": b.view(np.int64), "word": t.view(np.int64), "n": n.astype(np.int64)}
        return rows_to_table({name: column[order] for name, column in found.items()})

    shape = docs.select(F.col(text).alias("_text"))
    counted = shape.mapInArrow(run, "cell int, before long, word long, n long").repartitionById(1 << bits, "cell")
    return counted.groupBy("cell", "before", "word").agg(F.sum("n").alias("n"))


def array_files(uri: str, values: list[str], bits: int, passed: bool = False, most: int = SHARD_ROWS):
    """A ``mapInArrow`` function that writes ``key`` and integer ``values`` of rows sorted by key as arrays, in files
    of some ``most`` rows. It yields ``file``, the first key of each file and its name, or all rows with it if ``passed``.

    A file ends where the first ``bits`` of the key change, so that files of different tasks do not overlap.
    """

    def run(batches):
        held: list[pa.RecordBatch] = []
        file = cell = None
        size = 0

        def flush():
            keys, *counts = [np.concatenate([b.column(n).to_numpy() for b in held]) for n in ("key", *values)]
            # Counts are stored in the narrowest type that holds them.
            kind = np.min_scalar_type(max(int(c.max()) for c in counts))
            write_shared(f"{uri}/{file}-values", b"".join(c.astype(kind).tobytes() for c in counts))
            write_shared(f"{uri}/{file}", keys.tobytes())

        for batch in batches:
            keys = batch.column("key").to_numpy()
            cells = keys >> np.int64(64 - bits)
            cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    if held and (cells[a] != cell or size >= most):
                        flush()
                        held, size = [], 0
                    part = batch.slice(a, b - a)
                    if not held:
                        file, cell = int(keys[a]), cells[a]
                        if not passed:
                            yield rows_to_table({"file": pa.array([file], pa.int64())})
                    held.append(part.select(["key", *values]))
                    size += b - a
                    if passed:
                        yield part.append_column("file", pa.array(np.full(b - a, file)))
        if held:
            flush()

    return run


def write_arrays(rows: DataFrame, uri: str, values: list[str], total: int) -> tuple[int, ...]:
    """Write ``key`` and integer ``values`` as sorted arrays, one file per range of keys; the first keys of the files.

    Keys are hashes, so ranges of equal width hold about equally many.
    """
    shards = max(MIN_SHARDS, 1 << (total // SHARD_ROWS).bit_length())
    bits = shards.bit_length() - 1
    shard = F.shiftright("key", 64 - bits) + F.lit(shards // 2)
    placed = rows.select("key", *values).repartition(shards, shard).sortWithinPartitions("key")
    return first_keys(materialize(placed.mapInArrow(array_files(uri, values, bits), "file long"), "shards"))


def first_keys(written: DataFrame) -> tuple[int, ...]:
    """The ``file`` of rows that were stored: a number per file."""
    return tuple(sorted(row["file"] for row in written.select("file").distinct().collect()))


@lru_cache(maxsize=4096)
def _shard(uri: str, shard: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values that were written. If a file cannot be found the task fails: its keys must not pass for unseen."""
    keys, values = mapped_bytes(f"{uri}/{shard}").view(np.int64), mapped_bytes(f"{uri}/{shard}-values")
    return keys, values.view(f"u{len(values) // (width * len(keys))}").reshape(width, -1)


@dataclass(frozen=True)
class SortedArrays:
    """Look-up of keys in mapped files, which are named by their first keys."""

    uri: str
    filled: tuple[int, ...]
    values: int

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of sorted distinct keys, 0 where there is none: an array ``values x keys``."""
        out = np.zeros((self.values, len(keys)), np.int64)
        numbers = np.searchsorted(np.array(self.filled, np.int64), keys, side="right") - 1
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b == a or numbers[a] < 0:
                continue
            stored, values = _shard(self.uri, self.filled[numbers[a]], self.values)
            at = np.searchsorted(stored, keys[a:b])
            at[at == len(stored)] = 0
            hit = stored[at] == keys[a:b]
            for v in range(self.values):
                out[v, a:b] = np.where(hit, values[v][at], 0)
        return out


def discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of entries seen once to four times."""
    n1, n2, n3, n4 = (counts.get(i, 0) for i in range(1, 5))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the numbers that hold for the whole model."""

    bigrams: SortedArrays
    contexts: SortedArrays  # total, followers seen once, twice, more often
    words: SortedArrays  # count, number of different words before it
    tokens: int
    vocabulary: int
    pairs: int
    high: tuple[float, float, float]
    low: tuple[float, float, float]
    low_spare: float
    bits: int  # of a bigram's key that tell its cell

    def score(self, before: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of tokens and log10 probabilities."""
        word, back = np.unique(tokens.view(np.int64), return_inverse=True)
        count, different = self.words.find(word)
        if self.pairs:
            cut = np.array([0.0, *self.low])[np.minimum(different, 3)]
            lower = (np.maximum(different - cut, 0) / self.pairs + self.low_spare / (self.vocabulary + 1))[back]
        else:
            lower = np.ones(len(tokens))
        known = count[back]
        context, place = np.unique(before.view(np.int64), return_inverse=True)
        total, once, twice, more = self.contexts.find(context)
        spare = self.high[0] * once + self.high[1] * twice + self.high[2] * more
        pair, where = np.unique(pair_key(before, tokens, self.bits).view(np.int64), return_inverse=True)
        (seen,) = self.bigrams.find(pair)
        seen = seen[where]
        cut = np.array([0.0, *self.high])[np.minimum(seen, 3)]
        total, spare = total[place], spare[place]
        with np.errstate(divide="ignore", invalid="ignore"):
            full = np.maximum(seen - cut, 0) / total + spare / total * lower
        return known, np.log10(np.where(total > 0, full, lower))


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``n_tokens, n_known, train_tokens, base_score, score``."""
    kinds = dict(docs.dtypes)
    shape = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            start = 0
            held: list[tuple[np.ndarray, np.ndarray]] = []
            size = 0
            for k, raw in enumerate(texts(batch.column("_text")), 1):
                held.append(token_pairs(raw, hashes))
                size += len(held[-1][1])
                if size >= 1_000_000 or k == batch.num_rows:
                    yield scored(batch.slice(start, k - start), held)
                    start, held, size = k, [], 0

    def scored(part, held):
        lengths = np.array([len(t) for _, t in held])
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        known, logs = model.score(np.concatenate([b for b, _ in held]), np.concatenate([t for _, t in held]))
        base = np.log10((known + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
        out = {n: part.column(n) for n in keep} | {
            "n_tokens": lengths.astype(np.int64),
            "n_known": np.add.reduceat((known > 0).astype(np.int64), first),
            "train_tokens": np.full(len(held), model.tokens, np.int64),
            "base_score": np.add.reduceat(base, first),
            "score": np.add.reduceat(logs, first),
        }
        return rows_to_table(out)

    return shape.mapInArrow(
        run,
        ", ".join(f"`{n}` {kinds[n]}" for n in keep)
        + ", n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Count the texts and write the model into the shared folder."""
    spark = docs.sparkSession
    # A task sums and sorts, so it gets half of a partition.
    bits = min((max(MIN_SHARDS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))) - 1).bit_length(), 2 * TURNS)
    pairs_uri = new_path(spark, "kn-bigrams")
    placed = keyed(bigram_counts(docs, text, bits), bits).drop("cell").sortWithinPartitions("key")
    filed = placed.mapInArrow(array_files(pairs_uri, ["n"], bits, passed=True), "before long, word long, n long, key long, file long")
    # Sorted, so that a word's hash before its followers is stored once and not with each of them.
    bigrams = materialize(filed.drop("key").sortWithinPartitions("before"), "bigrams")
    n = F.col("n")
    words = materialize(
        bigrams.groupBy("word").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("different")), "words"
    )
    contexts = materialize(
        bigrams.groupBy("before").agg(
            F.sum("n").alias("total"), F.count_if(n == 1).alias("once"), F.count_if(n == 2).alias("twice"),
            F.count_if(n > 2).alias("more"),
        ),
        "contexts",
    )

    def of_counts(frame, column):
        few = frame.agg(F.count(F.lit(1)), *[F.count_if(F.col(column) == i) for i in range(1, 5)]).first()
        return few[0], dict(enumerate(few[1:], 1))

    pairs, high = of_counts(bigrams, "n")
    vocabulary, low = of_counts(words, "different")
    low_cuts = discounts(low)
    sums = words.agg(F.coalesce(F.sum("count"), F.lit(0)), *[F.count_if(c) for c in (F.col("different") == 1, F.col("different") == 2, F.col("different") > 2)]).first()
    spare = sum(d * k for d, k in zip(low_cuts, sums[1:], strict=True)) / pairs if pairs else 1.0

    def store(frame, values, total, label):
        uri = new_path(spark, label)
        return SortedArrays(uri, write_arrays(frame, uri, values, total), len(values))

    context_count = contexts.count()
    return Model(
        SortedArrays(pairs_uri, first_keys(bigrams), 1),
        store(contexts.withColumnRenamed("before", "key"), ["total", "once", "twice", "more"], context_count, "kn-contexts"),
        store(words.withColumnRenamed("word", "key"), ["count", "different"], vocabulary, "kn-words"),
        sums[0], vocabulary, pairs, discounts(high), low_cuts, spare, bits,
    )


@query("op3_kneser_ney")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    """All documents under a model of those whose fold is not 1."""
    docs = table(spark, sf, "documents").select("doc_id", "text", (fold("doc_id", 5) == 1).alias("held_out"))
    model = fit(docs.filter("NOT held_out"))
    return score(docs, model, ["doc_id", "held_out"])
