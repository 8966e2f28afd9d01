"""Search by word weights: texts in blocks of numbered terms, every block scored by itself.

A block holds some texts, its own vocabulary and how often each text has each term. What meets by term are the
vocabularies of the blocks, a row for each block and term, not the words of texts: they give the frequencies, which
go back to the blocks that hold the term. A block then weighs its texts and keeps the terms that are asked for; beside
a block of questions it gives each question's best ``k``. Work and shuffles grow with the texts, and a task holds one
block of texts and one of questions.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.similarity import pair_blocks
from millrace.operators.windows import top_per_key
from millrace.session import materialize

BLOCK_BYTES = 8 << 20  # of texts in a block
QUESTION_TERMS = 1 << 16  # in a block of questions
BLANKS = np.isin(np.arange(256), list(b" \t\r\n\f"))  # as in functions.text.words
DIGITS = 9
SLACK = 1e-8  # of bounds, for rounding to nine digits
UNREAD_SHARE = 0.3  # of the k-th score so far: the most that lists which are not read may add up to

# Task functions travel inside the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _numbers(value: bytes, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(value, kind)


def _row(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _listed(values: pa.Array) -> pa.ListArray:
    """One row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _binary(values: np.ndarray, kind: type = np.int32) -> pa.Array:
    return pa.array([np.ascontiguousarray(values, kind).tobytes()], pa.binary())


def _runs(ids: pa.Array) -> np.ndarray:
    """True where another id begins; nulls are one id."""
    codes = ids.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    return np.append(True, codes[1:] != codes[:-1])


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts without nulls, and where each begins, with the end of the last."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between blanks, and the number of the text that each is in."""
    data, bounds = _bytes(texts)
    part = ~BLANKS[data]
    begins = part.copy()
    begins[1:] &= ~part[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] = part[first]
    begins = np.flatnonzero(begins)
    lengths = np.add.reduceat(part, begins, dtype=np.int64) if len(begins) else begins
    offsets = np.append(0, np.cumsum(lengths))
    words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(data[part]))
    return words, np.searchsorted(bounds[1:], begins, side="right")


def _block(rows: pa.Table) -> pa.RecordBatch:
    """Rows of ``id, text`` as one block; rows of one id, which follow each other, are one text."""
    ids, texts = (rows.column(c).combine_chunks() for c in ("id", "text"))
    words, row = split_words(texts)
    worded = np.unique(row)  # a text without words is none
    begins = _runs(ids.take(pa.array(worded))) if len(worded) else np.zeros(0, bool)
    ids = ids.take(pa.array(worded[begins]))
    text = (np.cumsum(begins) - 1)[np.searchsorted(worded, row)]
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()  # by term, so that sums over terms do not depend on the block
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    pairs, n = np.unique(text * len(order) + place[coded.indices.to_numpy()], return_counts=True)
    text, term = np.divmod(pairs, max(len(order), 1))
    return _row(
        {
            "block": pa.array([uuid.uuid4().int >> 65], pa.int64()),
            "texts": pa.array([len(ids) - ids.null_count], pa.int64()),
            "ids": _listed(ids),
            "terms": _listed(coded.dictionary.take(pa.array(order)).cast(pa.string())),
            "held": _listed(pa.array(np.bincount(term, minlength=len(order)), pa.int64())),
            "sizes": _binary(np.bincount(text, minlength=len(ids))),
            "term": _binary(term),
            "n": _binary(n),
        }
    )


def text_blocks(texts: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts in blocks: the ``ids``, the ``terms`` with the number of texts that hold them (``held``), and per text its
    number of terms (``sizes``), their places in ``terms`` and counts.

    Rows of one key are one text; they must follow each other. Texts without a key are in no result, but their terms
    count as held by one.
    """
    id_type = texts.schema[key].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, 0
        for batch in batches:
            bounds = _bytes(batch.column("text"))[1]
            cuts = np.flatnonzero(np.diff(bounds[1:] // block_bytes, prepend=0)) + 1
            cuts = np.unique([0, *cuts, batch.num_rows])
            for low, high in zip(cuts, cuts[1:], strict=False):
                part = pa.Table.from_batches([batch.slice(low, high - low)])
                held = part if held is None else pa.concat_tables([held, part])
                number += int(bounds[high] - bounds[low])
                if number >= block_bytes:
                    # The last id may go on in the next rows.
                    last = int(np.flatnonzero(_runs(held.column("id").combine_chunks()))[-1])
                    if last:
                        yield _block(held.slice(0, last))
                        held = held.slice(last)
                        number = len(_bytes(held.column("text").combine_chunks())[0])
        if held is not None:
            yield _block(held)

    columns = f"block long, texts long, ids array<{id_type}>, terms array<string>, held array<bigint>, sizes binary, term binary, n binary"
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    return texts.select(F.col(key).alias("id"), lowered.alias("text")).mapInArrow(gather, columns)


def held_terms(blocks: DataFrame) -> DataFrame:
    """``term, _held``: the number of texts that hold it."""
    held = blocks.select(F.inline(F.arrays_zip("terms", "held")).alias("term", "held"))
    return held.groupBy("term").agg(F.sum("held").alias("_held"))


def weighted_blocks(blocks: DataFrame, frequencies: DataFrame, wanted: DataFrame, single: float) -> DataFrame:
    """Blocks of texts as unit vectors of count times ``idf``, with the terms of ``wanted`` alone.

    ``frequencies`` has ``term, idf`` of the terms that more than one text holds, and of all that are wanted; others
    have the ``idf`` ``single`` and are not sent. Texts without weight or id are left out.
    """
    marked = frequencies.join(wanted.select("term", F.lit(True).alias("_asked")), "term", "left")
    places = blocks.select("block", F.posexplode("terms").alias("place", "term"))
    entry = F.struct("place", "idf", F.coalesce("_asked", F.lit(False)).alias("asked"))
    answers = places.join(marked, "term").groupBy("block").agg(F.collect_list(entry).alias("answers"))
    id_type = blocks.schema["ids"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, terms, answers = (batch.column(c)[k].values for c in ("ids", "terms", "answers"))
                sizes, term, n = (_numbers(batch.column(c)[k].as_py()) for c in ("sizes", "term", "n"))
                idf, asked = np.full(len(terms), single), np.zeros(len(terms), bool)
                place = answers.field("place").to_numpy()
                idf[place] = answers.field("idf").to_numpy()
                asked[place] = answers.field("asked").to_numpy(zero_copy_only=False)
                text = np.repeat(np.arange(len(sizes)), sizes)
                weight = n * idf[term]
                length = np.sqrt(np.bincount(text, weight * weight, len(sizes)))
                keep = asked[term] & (weight > 0) & (~ids.is_null().to_numpy(zero_copy_only=False))[text]
                text, term = text[keep], term[keep]
                number = np.cumsum(asked) - 1
                yield _row(
                    {
                        "block": batch.column("block").slice(k, 1),
                        "ids": _listed(ids),
                        "terms": _listed(terms.take(pa.array(np.flatnonzero(asked)))),
                        "sizes": _binary(np.bincount(text, minlength=len(sizes))),
                        "term": _binary(number[term]),
                        "weight": _binary(weight[keep] / length[text], np.float64),
                    }
                )

    columns = f"block long, ids {id_type}, terms array<string>, sizes binary, term binary, weight binary"
    met = blocks.join(answers, "block").select("block", "ids", "terms", "answers", "sizes", "term", "n")
    return met.mapInArrow(weigh, columns)


def question_blocks(asked: DataFrame, question_id: str, number: int) -> DataFrame:
    """``asked`` (id, ``term``, ``_asked``) dealt into ``number`` rows of lists."""
    entry = F.struct(F.col(question_id).alias("question"), "term", F.col("_asked").alias("weight"))
    dealt = asked.groupBy(F.pmod(F.xxhash64(question_id), F.lit(number)).alias("questions"))
    return dealt.agg(F.sort_array(F.collect_list(entry)).alias("asked"))


class _Lists:
    """A block's weights by text and, as lists, by term."""

    def __init__(self, sizes: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int):
        self.texts, self.term, self.weight, self.sizes = len(sizes), term, weight, sizes
        self.starts = np.cumsum(sizes) - sizes
        order = np.argsort(term, kind="stable")
        self.text = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.listed = weight[order]
        self.bounds = np.searchsorted(term[order], np.arange(terms + 1))
        self.top = np.zeros(terms)
        np.maximum.at(self.top, term, weight)
        self.asked = np.zeros(terms)

    def full(self, places: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The scores of the texts at these places, over all their terms in order."""
        self.asked[terms] = weights
        sizes = self.sizes[places]
        row = np.repeat(np.arange(len(places)), sizes)
        at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.starts[places][row]
        scores = np.bincount(row, self.weight[at] * self.asked[self.term[at]], len(places))
        self.asked[terms] = 0
        return scores

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, seeds: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and rounded scores of the best ``k`` texts, the first ones among equals."""
        gain = weights * self.top[terms]
        order = np.argsort(-gain, kind="stable")
        rest = np.append(np.cumsum(gain[order][::-1])[::-1], 0.0)  # the most that the lists from here on add
        part = np.zeros(self.texts)
        read, until = 0, min(seeds, len(order))
        while read < until:
            for i in order[read:until].tolist():
                low, high = self.bounds[terms[i]], self.bounds[terms[i] + 1]
                part[self.text[low:high]] += self.listed[low:high] * weights[i]
            read = until
            floor = np.partition(part, self.texts - k)[self.texts - k] if self.texts >= k else 0.0
            spare = np.flatnonzero(rest < UNREAD_SHARE * floor)
            until = int(spare[0]) if len(spare) else len(order)
        # A text of which no list was read has at most the rest, which is below the floor unless all were read.
        places = np.flatnonzero((part > 0) & (part + rest[read] >= floor - SLACK))
        scores = np.floor(self.full(places, terms, weights) * 10**DIGITS + 0.5) / 10**DIGITS
        first = np.lexsort((places, -scores))[:k]
        return places[first], scores[first]


def best_texts(weighted: DataFrame, asked: DataFrame, question_id: str, text_id: str, k: int, seeds: int) -> DataFrame:
    """The ``k`` best texts of each question: ``question_id, text_id, similarity, position``.

    ``weighted`` holds blocks of texts, ``asked`` blocks of questions; each pair of them is a row of work.
    """
    if k < 1 or seeds < 1:
        raise ValueError("k and seeds are at least 1")
    id_type = weighted.schema["ids"].dataType.elementType.simpleString()
    question_type = asked.schema["asked"].dataType.elementType["question"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in range(batch.num_rows):
                ids, terms, entries = (batch.column(c)[j].values for c in ("ids", "terms", "asked"))
                questions = entries.field("question")
                bounds = np.append(np.flatnonzero(_runs(questions)), len(questions))
                term = pc.index_in(entries.field("term"), terms).fill_null(-1).to_numpy()
                weight = entries.field("weight").to_numpy()
                sizes, own = (_numbers(batch.column(c)[j].as_py()) for c in ("sizes", "term"))
                lists = _Lists(sizes, own, _numbers(batch.column("weight")[j].as_py(), np.float64), len(terms))
                found = []
                for low, high in zip(bounds, bounds[1:], strict=False):
                    here = np.flatnonzero(term[low:high] >= 0) + low
                    if len(here):
                        places, scores = lists.best(term[here], weight[here], k, seeds)
                        found.append((np.full(len(places), low), places, scores))
                if found:
                    number, places, scores = (np.concatenate(x) for x in zip(*found, strict=True))
                    yield _row({"question": questions.take(pa.array(number)), "text": ids.take(pa.array(places)), "similarity": pa.array(scores)})

    work = pair_blocks(weighted, asked, "questions").select("ids", "terms", "sizes", "term", "weight", "asked")
    found = work.mapInArrow(scan, f"question {question_type}, text {id_type}, similarity double")
    best = top_per_key(found, ["question"], [F.desc("similarity"), F.asc("text")], k)
    return best.select(F.col("question").alias(question_id), F.col("text").alias(text_id), "similarity", "position")
