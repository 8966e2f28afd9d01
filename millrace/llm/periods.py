"""Periodic runs of words: Baier's grouping gives Lyndon arrays, whose roots are extended into runs.

A run is a maximal stretch with a smallest period ``q`` that it holds at least twice. Every run contains a
root that is the longest Lyndon word beginning at its place, under the order of words or under the
reverse order. The first phase of Baier's suffix sorter groups suffixes by just these Lyndon words, so
the lengths of its groups' contexts are the Lyndon array, and no suffix array is needed. Each root is
extended to both sides by longest common extensions, taken from ranks of blocks of 2^k words.

Runs asked for here have ``exponent`` periods or more. A stretch of ``gram`` words inside such a run recurs
in it (``gram`` follows from the limits), so what no recurring stretch covers can be left out before the
grouping; nothing else is. A text is worked on as a whole by one task, with memory in proportion to it.

Null and empty texts have no words and no runs. Repeated rows get the same result each, null ids are
carried through, an empty table gives an empty result. Output names must not be among the columns kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WORD, fold, query, rows_to_table, table, texts

OUTPUTS = "n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def lyndon_lengths(word: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that begins at each place (phase one of Baier's sorter).

    Suffixes start in groups by their first letter. The greatest group left is finished: each of its members
    adds the group's context to the context of the nearest unfinished place to its left. Places that got
    the same number of contexts leave their group together, those that got more stand higher.
    """
    n = len(word)
    group: list[int] = np.unique(word, return_inverse=True)[1].tolist()
    members: list[list[int]] = [[] for _ in range(max(group, default=-1) + 1)]
    for place, at in enumerate(group):
        members[at].append(place)
    context = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    left = list(range(-1, n - 1))  # nearest place to the left that may be unfinished
    finished = bytearray(n)
    lengths = np.zeros(n, np.int64)
    current = len(members) - 1
    while current >= 0:
        mine = [place for place in members[current] if group[place] == current]
        members[current] = []
        lengths[mine] = context[current]
        for place in mine:
            finished[place] = 1
        got: dict[int, int] = {}
        for place in mine:
            at = left[place]
            while at >= 0 and finished[at]:
                at = left[at]
            while left[place] != at:  # shorten the way for later searches
                left[place], place = at, left[place]
            if at >= 0:
                got[at] = got.get(at, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for place, count in got.items():
            parts.setdefault((group[place], count), []).append(place)
        for old, count in sorted(parts, reverse=True):  # right above the old group, so under those that got more
            fresh, higher = len(members), above[old]
            members.append(parts[old, count])
            context.append(context[old] + context[current] * count)
            below.append(old)
            above.append(higher)
            above[old] = below[higher] = fresh
            for place in parts[old, count]:
                group[place] = fresh
        current = below[current]
    return lengths


class Extensions:
    """Longest common extensions of pairs of places, by ranks of blocks of 2^k words."""

    def __init__(self, word: np.ndarray):
        self.n = len(word)
        self.ranks = [np.unique(word, return_inverse=True)[1].astype(np.int32)]
        size = 1
        while 2 * size <= self.n:
            low = self.ranks[-1].astype(np.int64)
            pairs = low[: len(low) - size] * (self.n + 1) + low[size:]
            self.ranks.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
            size *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on; ``a < b``."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            fits = np.flatnonzero(b + total + (1 << k) <= self.n)
            rank, done = self.ranks[k], total[fits]
            total[fits[rank[a[fits] + done] == rank[b[fits] + done]]] += 1 << k
        return total

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those before ``b``; ``a < b``."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            fits = np.flatnonzero(a - total - (1 << k) >= 0)
            rank, done = self.ranks[k], total[fits] + (1 << k)
            total[fits[rank[a[fits] - done] == rank[b[fits] - done]]] += 1 << k
        return total


def runs_in(word: np.ndarray, shortest: int, exponent: int) -> np.ndarray:
    """Rows ``start, length, period`` of the runs of a sequence of numbers, by start and period."""
    reach = Extensions(word)
    place = np.arange(len(word))
    found = []
    for order in (word, -word):
        period = lyndon_lengths(order)
        inside = np.flatnonzero(place + period < len(word))
        at, size = place[inside], period[inside]
        begin = at - reach.left(at, at + size)
        length = at + size + reach.right(at, at + size) - begin
        keep = (length >= exponent * size) & (length >= shortest)
        found.append(np.stack([begin, length, size], axis=1)[keep])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def gram_size(shortest: int, exponent: int) -> int:
    """The longest stretch that recurs inside every run of these limits, wherever in the run it lies.

    A run of period ``q`` and length ``m`` holds a stretch of ``g`` words at its place and one period on or
    back if ``g + q <= m`` holds for two neighbouring places of it: ``g <= m - 2 * q + 1``.
    """
    sizes = [max(shortest, exponent * q) - 2 * q + 1 for q in range(1, shortest + 1)]
    return max(1, min(sizes))


def candidates(word: np.ndarray, gram: int) -> Iterator[tuple[int, int]]:
    """Stretches that recurring grams cover; every run lies inside one of them."""
    count = len(word) - gram + 1
    if count < 2:
        return
    with np.errstate(over="ignore"):
        mixed = np.zeros(count, np.uint64)
        for k in range(gram):  # equal grams have equal numbers; others may, which only keeps more
            mixed = (mixed ^ word[k : k + count].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return
    again = np.zeros(count, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(again), 1)
    np.add.at(edge, np.flatnonzero(again) + gram, -1)
    covered = np.cumsum(edge[:-1]) > 0
    bounds = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    yield from zip(bounds[::2].tolist(), bounds[1::2].tolist(), strict=True)


def word_runs(words: list, shortest: int = 6, exponent: int = 4) -> np.ndarray:
    """Rows ``start, length, period`` of the runs of a list of words."""
    if len(words) < shortest:
        return np.empty((0, 3), np.int64)
    ids: dict = {}
    word = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    parts = [np.empty((0, 3), np.int64)]
    for begin, end in candidates(word, gram_size(shortest, exponent)):
        if end - begin >= shortest:
            parts.append(runs_in(word[begin:end], shortest, exponent) + np.array([begin, 0, 0]))
    return np.concatenate(parts)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for words that no run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def periodic_runs(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, shortest: int = 6, exponent: int = 4
) -> DataFrame:
    """The columns ``keep`` (all but the text by default), ``n_words``, ``runs`` and the ``collapsed`` text.

    ``runs``: maximal stretches of words with smallest period ``q`` and at least ``max(shortest, exponent * q)``
    words (``exponent`` at least 2), by start and period. ``collapsed``: the words that no run contains after its first period,
    joined by blanks.
    """
    kept = [c for c in docs.columns if c != text] if keep is None else keep
    rows = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(kept)], F.col(text).alias("_text"))
    fields = [f"_k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches):
        for batch in batches:
            counts, runs, collapsed = [], [], []
            for raw in texts(batch.column("_text")):
                words = raw.split()
                found = word_runs(words, shortest, exponent)
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found.tolist()])
                if len(found):
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), found))]
                collapsed.append(b" ".join(words).decode())
            yield rows_to_table(
                {
                    **{f"_k{i}": batch.column(f"_k{i}") for i in range(len(kept))},
                    "n_words": pa.array(counts, pa.int64()),
                    "runs": pa.array(runs, kind),
                    "collapsed": pa.array(collapsed, pa.string()),
                }
            )

    found = rows.mapInArrow(run, ", ".join([*fields, OUTPUTS]))
    return found.withColumnsRenamed({f"_k{i}": c for i, c in enumerate(kept)})


def with_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The texts with the tails of a tenth of the documents made periodic, as the contract of op13 says."""
    plain = F.coalesce(text, F.lit(""))
    chosen = docs.withColumn("_h", fold(doc_id, 1 << 32)).withColumn("_g", F.floor(F.col("_h") / 10))
    # Words only where they are needed; elsewhere a short array.
    marked = F.col(doc_id).isNotNull() & (F.col("_h") % 10 == 0)
    words = F.when(marked, F.regexp_extract_all(plain, F.lit(f"({WORD})"), F.lit(1))).otherwise(F.array().cast("array<string>"))
    listed = chosen.withColumn("_w", words).withColumn("_n", F.size("_w"))
    listed = listed.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    listed = listed.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    index = F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("_n") - 1, F.lit(0))),
        lambda i: F.when(i >= F.col("_a"), F.col("_a") + (i - F.col("_a")) % F.col("_p")).otherwise(i).cast("int"),
    )
    repeated = F.array_join(F.transform(index, lambda i: F.get("_w", i)), " ")
    return listed.withColumn(text, F.when(F.col("_n") > 0, repeated).otherwise(plain)).select(*docs.columns)


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    docs = with_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    found = periodic_runs(docs, keep=["doc_id"])
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("before"), (-r["period"]).alias("shorter")))
    )
    start, length, period = -best["before"], best["length"], -best["shorter"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
