"""Mixture-controlled packing of token ids into sequences.

Each source is a queue of its documents. Deficit round-robin serves the queues in rounds: a round
adds a source's share of one sequence to its deficit and sends documents while the deficit covers
them; what is left is carried on. A queue's document that ends at token ``c`` of the queue is
therefore sent in round ``ceil(c / share)``, which needs running totals and no simulation: carrying
deficits from sequence to sequence and from partition to partition is the running total itself.
The sent stream is cut every ``width`` tokens, so only the last sequence can need padding.

Shares are those of the sources' tokens, so all queues end in the same round and every sequence has
the corpus mixture, up to the deficits carried.

Null and empty texts are documents of the end token alone. Null sources are one queue. Repeated rows
and repeated ids are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.common import null_safe, query, table
from millrace.operators.ranking import running_totals
from millrace.session import materialize, new_path

os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread

END_ID = 1
MARKS = ".,;:!?"
LATIN_END = "\u0250"
CACHE_WORDS = 400_000


def _byte_letters() -> dict[int, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the rest in
    order from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: 256 + i for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


# Bytes by what they are where marks are told apart: 1 letters, 2 marks, 4 white space.
BYTE_KINDS = np.zeros(256, np.uint8)
BYTE_KINDS[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)] = 1
BYTE_KINDS[np.frombuffer(MARKS.encode(), np.uint8)] = 2
BYTE_KINDS[np.frombuffer(b"\t\n\v\f\r ", np.uint8)] = 4


def marks_apart(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes with A-Z in lower case and a blank between a letter and a mark that closes its word.

    No token reaches from a letter to a mark, so ids stay the same, and there are fewer different words.
    Letters are a-z and those that UTF-8 begins with C3; other words keep their marks. Null is the empty text.
    """
    column = column.cast(pa.binary()).fill_null(b"")
    cuts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2].to_pybytes()[cuts[0] : cuts[-1]] if cuts[-1] > cuts[0] else b""
    low, cuts = np.frombuffer(raw.lower(), np.uint8), cuts - cuts[0]
    kinds = BYTE_KINDS[low]
    at = 1 + np.flatnonzero((kinds[1:-1] == 2) & (kinds[2:] == 4))
    last = low[at - 1]
    accented = (at > 1) & (low[at - 2] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)  # not ×, ÷
    at = at[(kinds[at - 1] == 1) | accented]
    wide = np.insert(low, at, ord(" ")).tobytes()
    ends = (cuts + np.searchsorted(at, cuts)).tolist()
    return [wide[i:j] for i, j in zip(ends, ends[1:])]


class WordIds(dict):
    """Ids of blank-free words as little-endian bytes, 32 bits each; 16 if ``narrow`` and the vocabulary allow it.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its words. A
    letter never joins the punctuation after it either, so a word is encoded without its closing
    marks. Words of Latin letters go to the tokenizer's merges directly: its normaliser only puts
    them in lower case, and its pattern takes them whole.
    Two generations of at most ``CACHE_WORDS`` words are held: when the young one is full it becomes
    the old one, from which words that are met again come back.
    """

    def __init__(self, path: str, end_id: int = END_ID, narrow: bool = False):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.kind = "H" if narrow and max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "I"
        self.end = array(self.kind, [end_id]).tobytes()
        self.old: dict[bytes, bytes] = {}

    def _encode(self, text: str) -> bytes:
        lower = text.lower()
        if lower.isalpha() and max(lower) < LATIN_END:
            letters = lower.encode().decode("latin-1").translate(BYTE_LETTERS)
            ids = [t.id for t in self.merges.tokenize(letters)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array(self.kind, ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        found = self.old.get(word)
        if found is None:
            text = word.decode("utf-8")
            stem = text.rstrip(MARKS)
            last = stem[-1:].lower()
            if stem == text or not last.isalpha() or last >= LATIN_END:
                found = self._encode(text)
            else:
                found = self[stem.encode()] + self[text[len(stem) :].encode()]
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found

    def of(self, raw: bytes) -> bytes:
        return b"".join(map(self.__getitem__, raw.split()))


@lru_cache(maxsize=2)
def word_ids(path: str, end_id: int) -> WordIds:
    return WordIds(path, end_id, narrow=True)


def tokenize(docs: DataFrame, text: str, keep: list[str], vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """The columns ``keep``, the ids with the end token as ``WordIds`` gives them, and their number."""
    shape = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches):
        coder = word_ids(vocabulary, end_id)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                ids = [coder.of(raw) + coder.end for raw in marks_apart(part.column("_text"))]
                out = [part.column(n) for n in keep]
                out += [pa.array(ids, pa.binary()), pa.array([len(i) // len(coder.end) for i in ids], pa.int64())]
                yield pa.RecordBatch.from_arrays(out, names=[*keep, "ids", "tokens"])

    kinds = dict(shape.dtypes)
    return shape.mapInArrow(run, ", ".join([*[f"`{n}` {kinds[n]}" for n in keep], "ids binary", "tokens long"]))


def widened(pieces: DataFrame, ids: str, number: str) -> DataFrame:
    """The rows with ``ids`` (of ``number`` ids, never null) in 32 bits each. They are shuffled in as few as they need."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            column = batch.column(at)
            cuts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            if len(column) and cuts[-1] - cuts[0] == 2 * np.sum(batch.column(number).to_numpy()):
                narrow = np.frombuffer(column.buffers()[2], np.uint8)[cuts[0] : cuts[-1]]
                wide = narrow.view("<u2").astype("<u4")
                ends = 2 * (cuts - cuts[0])
                column = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends), pa.py_buffer(wide)])
                batch = batch.set_column(at, batch.schema.field(at), column)
            yield batch

    return pieces.mapInArrow(run, pieces.schema)


def deficit_schedule(queues: DataFrame, width: int) -> DataFrame:
    """Add ``_end``, the position after each document in the sent stream.

    ``queues``: rows ``_row`` (unique), ``_source`` (not null), ``tokens``.
    """
    totals = queues.groupBy("_source").agg(F.sum("tokens").alias("_all"))
    everything = totals.agg(F.sum("_all").alias("_corpus"))  # one row
    shares = materialize(totals.join(F.broadcast(everything), F.lit(True)), "shares")
    run = running_totals(queues, ["_row"], {"_served": "tokens"}, ["_source"])
    placed = null_safe(run, shares, ["_source"], "inner")
    # Round ceil(served / (width * all / corpus)) in whole numbers.
    spent = F.col("_served").cast("decimal(38,0)") * F.col("_corpus").cast("decimal(19,0)")
    quantum = F.col("_all").cast("decimal(19,0)") * F.lit(width)
    numbered = placed.withColumn("_round", F.ceil(spent.cast("double") / quantum.cast("double"))).select(
        "_row", "_source", "_round", "tokens"
    )
    return running_totals(materialize(numbered, "rounds"), ["_round", "_source", "_row"], {"_end": "tokens"})


def pack(
    docs: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    width: int = 2048,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents with their place: id, source, ``start``, ``length``, ``piece_ids``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and ``padding`` (of the sequence: up to ``width``, none at a power of two).
    """
    coded = tokenize(docs.select(F.col(doc_id).alias("_id"), F.col(source).alias("_src"), F.col(text).alias("_text")), "_text", ["_id", "_src"], vocabulary, end_id)
    path = new_path(spark := docs.sparkSession, "tokens")
    numbered = coded.withColumn("_row", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    name = F.coalesce(F.concat(F.lit("0"), F.col("_src").cast("string")), F.lit("1"))
    sent = deficit_schedule(stored.select("_row", name.alias("_source"), "tokens"), width)
    begin = F.col("_end") - F.col("tokens")
    cuts = F.sequence(F.floor(begin / width), F.floor((F.col("_end") - 1) / width))
    pieces = sent.select("_row", "_end", "tokens", begin.alias("_begin"), F.explode(cuts).alias("sequence_id"))
    first = F.greatest(F.col("_begin"), F.col("sequence_id") * width)
    last = F.least(F.col("_end"), (F.col("sequence_id") + 1) * width)
    pieces = pieces.select(
        "_row",
        (first - F.col("_begin")).alias("start"),
        (last - first).alias("length"),
        F.col("tokens").alias("doc_tokens"),
        "sequence_id",
        (first - F.col("sequence_id") * width).alias("offset"),
    )
    corpus = stored.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("_corpus"))  # one row
    joined = pieces.join(stored.select("_row", "_id", "_src", "ids"), "_row").join(F.broadcast(corpus), F.lit(True))
    each = (F.length("ids") / F.col("doc_tokens")).cast("int")  # bytes
    slice_of = F.substring(F.col("ids"), (each * F.col("start") + 1).cast("int"), (each * F.col("length")).cast("int"))
    left = F.least(F.lit(width), F.col("_corpus") - F.col("sequence_id") * width)
    cut = joined.select(
        F.col("_id").alias(doc_id), F.col("_src").alias(source), "start", "length", slice_of.alias("piece_ids"),
        "doc_tokens", "sequence_id", "offset", _padding(left, width).alias("padding"),
    )
    return widened(cut, "piece_ids", "length")


def _padding(used: Column, width: int) -> Column:
    power = F.bit_count(used) == 1
    return F.when(power, F.lit(0)).otherwise(F.lit(width) - used).cast("long")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op4_pack_mixture")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    packed = pack(table(spark, sf, "documents"), vocabulary_path())
    return packed.select(
        "doc_id", "start", "length", F.crc32("piece_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "source", "padding",
    )
