"""Exact top-k inner products by no-random-access aggregation.

Every vector component is a sorted list of (value, vector). Lists are read from their best end (from
the top for a positive query component, from the bottom for a negative one) to a common depth. What
has been read gives each vector a partial sum; what has not is bounded by the last value read above
and the far end of the list below. Reading stops once no vector outside the ``k`` with the best lower
bounds, and none that no list has shown yet, can qualify; only the few that still can are resolved.

Vectors are dealt into blocks, and queries too; each pair of blocks is one row of work, so what a
task holds is bounded by the block sizes, not by the tables. In a block the lists are read for all
queries at once: lower and upper bounds are matrix products with the values read, the rest replaced by
what bounds it. A task sorts a block's lists once for the query blocks that it meets, and goes on with
the queries' ``k`` best scores so far: what cannot beat them is out in the next block.

Vectors that are null, or hold a null or a component that is not finite, take no part. A missing
component of a shorter vector counts as 0. Ties go to the smaller id. Repeated ids are vectors of
their own, except that a query is not compared with vectors of its own id. Null ids take no part.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import query, rows_to_table, table
from millrace.operators.similarity import pair_blocks
from millrace.session import materialize

DEPTHS = (1 / 8, 1 / 4, 1 / 2)
HELD_LISTS = 2  # blocks whose sorted lists a task keeps
HELD_QUERIES = 1024  # blocks of queries whose best scores a task keeps


class SortedLists:
    """The sorted lists of a block: for every entry its place from the top of its list."""

    def __init__(self, vectors: np.ndarray):
        n, _ = vectors.shape
        self.vectors = vectors
        order = np.argsort(-vectors, axis=0, kind="stable")
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.broadcast_to(np.arange(n)[:, None], order.shape), axis=0)
        self.sorted = np.take_along_axis(vectors, order, axis=0)

    def outside(self, queries: np.ndarray, depth: int) -> np.ndarray:
        """The upper bound of vectors that no list has shown."""
        # The next unread values bound the rest: from the top, and from the bottom.
        high, low = self.sorted[depth], self.sorted[len(self.vectors) - 1 - depth]
        return queries.clip(min=0) @ high + queries.clip(max=0) @ low

    def bounds(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower and upper bounds, vectors by queries, and the upper bound of vectors not yet seen."""
        n = len(self.vectors)
        top, bottom = self.place < depth, self.place >= n - depth
        up, down = queries.clip(min=0).T, queries.clip(max=0).T
        between = lambda above, below: np.where(top, self.vectors, above) @ up + np.where(bottom, self.vectors, below) @ down
        lower, upper = between(self.sorted[-1], self.sorted[0]), between(self.sorted[depth], self.sorted[n - 1 - depth])
        return lower, upper, self.outside(queries, depth)


def block_top_k(lists: SortedLists, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, least: np.ndarray):
    """``(query, place, score)`` arrays of the best vectors of a block, at most ``k`` for each query, by rows of both.

    ``least`` holds for each query a score that ``k`` vectors of other blocks reach; what is below it is left out.
    """
    vectors = lists.vectors
    n, number = len(vectors), len(queries)
    alive = ids[:, None] != query_ids[None, :]
    own = ~alive
    # Beyond 2^53 bounds would not be exact: all lists are read to their ends.
    for share in DEPTHS if vectors.dtype.kind == "f" else ():
        depth = int(n * share)
        if depth < 1 or n - depth < k:
            continue
        if np.isfinite(least).all() and (lists.outside(queries, depth) >= least).mean() > 0.5:
            continue  # For most queries even a vector that no list has shown may qualify: the lists are read on.
        lower, upper, outside = lists.bounds(queries, depth)
        lower[own] = -np.inf
        least = np.maximum(least, np.partition(lower, n - k, axis=0)[n - k])
        alive &= upper >= least
        # Vectors that no list has shown are below ``outside``; they stop mattering with it.
        if (outside < least).all() and alive.sum() <= 4 * k * number:
            break
    left = np.flatnonzero(alive.any(axis=1))
    alive = alive[left]
    scores = vectors[left] @ queries.T
    if len(left) > k:
        lowest = -np.inf if scores.dtype.kind == "f" else np.iinfo(scores.dtype).min
        alive &= scores >= np.partition(np.where(alive, scores, lowest), len(left) - k, axis=0)[len(left) - k]
    who, which = np.nonzero(alive & (scores >= least))
    scores, who = scores[who, which].astype(np.int64), left[who]
    order = np.lexsort((ids[who], -scores, which))
    first = np.searchsorted(which[order], np.arange(number))
    keep = order[np.arange(len(order)) - first[which[order]] < k]
    return which[keep], who[keep], scores[keep]


def better(held: np.ndarray, which: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The best scores of each query (row) so far, and of another block; the least comes first."""
    number, k = held.shape
    found = np.full((number, k), -np.inf)
    found[which, np.arange(len(which)) - np.searchsorted(which, which)] = scores
    return np.partition(np.hstack([held, found]), k, axis=1)[:, k:]


def _usable(vector: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def _whole(vector: str, factor: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def _blocks(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    """Rows of ``id, vector`` gathered into blocks of at most ``rows``: a name, and ids, lengths and values as bytes."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                if size + part.num_rows > rows:
                    room = rows - size
                    yield block([*held, part.slice(0, room)])
                    held, size, part = [], 0, part.slice(room)
                held.append(part)
                size += part.num_rows
        if held:
            yield block(held)

    def block(parts):
        ids = np.concatenate([p.column("id").to_numpy() for p in parts])
        lengths = np.concatenate([pc.list_value_length(p.column("vector")).to_numpy() for p in parts])
        values = np.concatenate([p.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64) for p in parts])
        data = ids.astype(np.int64), lengths.astype(np.int32), values
        columns = [[uuid.uuid4().hex], *[pa.array([c.tobytes()], pa.binary()) for c in data]]
        return rows_to_table(dict(zip(names, columns, strict=True)))

    names = [f"{name}_name", f"{name}_ids", f"{name}_lengths", f"{name}_values"]
    return vectors.mapInArrow(run, f"{names[0]} string, " + ", ".join(f"{n} binary" for n in names[1:]))


def _matrix(row: dict, name: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{name}_ids"], np.int64)
    lengths = np.frombuffer(row[f"{name}_lengths"], np.int32)
    values = np.frombuffer(row[f"{name}_values"], np.int64)
    if len(set(lengths.tolist())) == 1 and lengths[0] == width:
        return ids, values.reshape(len(ids), width)
    full = np.zeros((len(ids), width), np.int64)
    full[np.arange(width)[None, :] < lengths[:, None]] = values
    return ids, full


def top_k_inner(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    factor: int = 256,
    block_rows: int = 2048,
    query_rows: int = 512,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best vectors for each query.

    Scores are inner products of components rounded down after multiplication by ``factor``, exact
    as long as they fit 64 bits.
    """

    def whole(frame):
        usable = frame.filter(_usable(vector) & F.col(vec_id).isNotNull())
        return usable.select(F.col(vec_id).cast("long").alias("id"), _whole(vector, factor).alias("vector"))

    asked = _blocks(whole(queries), query_rows, "query")
    stored = _blocks(whole(vectors), block_rows, "block")
    # Blocks against blocks: a block of vectors is sent once, and the smaller blocks of queries go to each. Catalyst does
    # not know how often these are repeated, so it must not broadcast them.
    work = pair_blocks(materialize(asked, "queries").hint("merge"), materialize(stored, "blocks"), "block_name")

    def run(batches):
        best: dict[bytes, np.ndarray] = {}
        lists: dict[tuple[bytes, int, type], SortedLists] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_buffer() for n in batch.schema.names}
                lengths = [np.frombuffer(row[f"{n}_lengths"], np.int32) for n in ("block", "query")]
                width = int(max(own.max() for own in lengths))
                ids, block = _matrix(row, "block", width)
                query_ids, asks = _matrix(row, "query", width)
                size = max(width, 1) * max(int(np.abs(block).max(initial=0)), 1) * max(int(np.abs(asks).max(initial=0)), 1)
                # Whole numbers below 2^24 and 2^53 are exact in single and double precision, which multiply faster.
                kind = np.float32 if size < 1 << 24 else np.float64 if size < 1 << 53 else np.int64
                place = (row["block_name"].to_pybytes(), width, kind)
                if place not in lists:
                    if len(lists) >= HELD_LISTS:
                        lists.clear()
                    lists[place] = SortedLists(block.astype(kind))
                name = row["query_name"].to_pybytes()
                if name not in best and len(best) >= HELD_QUERIES:
                    best.clear()
                held = best.get(name, np.full((len(asks), k), -np.inf))
                which, who, scores = block_top_k(lists[place], ids, asks.astype(kind), query_ids, k, held[:, 0])
                best[name] = better(held, which, scores)
                yield rows_to_table({"query_id": query_ids[which], "vec_id": ids[who], "score": scores})

    best = work.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


@query(
    "op8_exact_top_k",
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(c.e) + 1),
         lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
""",
)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return top_k_inner(vectors, vectors.filter("vec_id % 50 = 0"))
