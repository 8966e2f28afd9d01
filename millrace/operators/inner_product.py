"""Top-n items of every user by inner product, without all users meeting all items.

Items are stored in blocks by falling length, one file per block in the shared folder. By Cauchy's inequality
no item of a block scores more than the user's length times the length of the block's first item. A user
visits the blocks in order, only as long as their bound reaches the n-th score found so far: a prefix, which
shrinks as item lengths fall. Users are dealt out once and read the files; no row is sent to meet each block.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import with_rank
from millrace.operators.shared import mapped_bytes, write_shared
from millrace.operators.similarity import DIGITS, _best
from millrace.operators.windows import top_per_key
from millrace.session import materialize, new_path

ITEM_ROWS = 2048
USER_ROWS = 1024
SLACK = 1e-6  # relative, of bounds, for rounding

# Task functions travel inside the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _measured(rows: DataFrame, key: str, column: str) -> DataFrame:
    """``id, vector, length`` of the rows with a vector."""
    values = F.transform(column, lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
    present = rows.filter(F.col(column).isNotNull())
    return present.select(F.col(key).cast("long").alias("id"), values.alias("vector"), length.alias("length"))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(rows, -1)


def item_files(items: DataFrame, key: str, column: str, rows: int = ITEM_ROWS) -> tuple[str, list[float]]:
    """Items by falling length in files of ``rows``, numbered from 0: ids, then vectors. The folder, and the
    length of each file's first item.
    """
    ordered = _measured(items, key, column).withColumn("_short", -F.col("length"))
    ranked = with_rank(ordered, ["_short", "id"], "_rank").withColumn("block", F.floor((F.col("_rank") - 1) / rows))
    entry = F.struct("_rank", "id", "vector", "length")
    grouped = ranked.groupBy("block").agg(F.array_sort(F.collect_list(entry)).alias("_items"))  # rows of them at most
    uri = new_path(items.sparkSession, "item-blocks")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, vectors in zip(batch.column("block").to_pylist(), batch.column("ids"), batch.column("vectors"), strict=True):
                own = ids.values.to_numpy().astype(np.int64)
                write_shared(f"{uri}/{block}", own.tobytes() + _matrix(vectors.values, len(own)).tobytes())
            yield batch.select(["block", "length"])

    shape = grouped.select("block", F.col("_items")[0]["length"].alias("length"), F.col("_items.id").alias("ids"), F.col("_items.vector").alias("vectors"))
    written = materialize(shape.mapInArrow(write, "block long, length double"), "item-lengths")
    return uri, [row["length"] for row in written.orderBy("block").collect()]  # a number per file


def _read(uri: str, block: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a file."""
    words = mapped_bytes(f"{uri}/{block}").view(np.int64)
    rows = len(words) // (width + 1)
    return words[:rows], words[rows:].view(np.float64).reshape(rows, width)


def _best_of_files(users: np.ndarray, uri: str, lengths: list[float], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the best ``n`` items per user (row)."""
    size = np.linalg.norm(users, axis=1)
    ids, vectors = _read(uri, 0, users.shape[1])
    found = np.round(users @ vectors.T, DIGITS)
    scores, best = _best([(found, np.broadcast_to(ids, found.shape))], n)
    going = np.arange(len(users))
    for block in range(1, len(lengths)):
        if scores.shape[1] == n:  # fewer rule nothing out
            going = going[~(size[going] * lengths[block] * (1 + SLACK) + SLACK < scores[going, -1])]
            if not len(going):
                break
        ids, vectors = _read(uri, block, users.shape[1])
        found = users[going] @ vectors.T
        if scores.shape[1] == n:
            higher = ~(found.max(axis=1) + SLACK < scores[going, -1])
            rows, found = going[higher], np.round(found[higher], DIGITS)
            if len(rows):
                scores[rows], best[rows] = _best([(scores[rows], best[rows]), (found, np.broadcast_to(ids, found.shape))], n)
        else:
            found = np.round(found, DIGITS)
            scores, best = _best([(scores, best), (found, np.broadcast_to(ids, found.shape))], n)
    return scores, best


def top_inner_products(
    users: DataFrame,
    items: DataFrame,
    n: int,
    user: str = "user_id",
    item: str = "item_id",
    user_vector: str = "factors",
    item_vector: str = "factors",
    item_rows: int = ITEM_ROWS,
    user_rows: int = USER_ROWS,
) -> DataFrame:
    """``<user>, <item>, score, position``: the ``n`` items of highest inner product, ties by item.

    Ids are integers, scores are rounded to nine digits. Rows without a vector are left out.
    """
    uri, lengths = item_files(items, item, item_vector, item_rows)
    asked = materialize(_measured(users, user, user_vector).select("id", "vector"), "users")
    cores = users.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-asked.count() // user_rows), 8 * cores))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows if lengths else 0, user_rows):
                part = batch.slice(k, user_rows)
                scores, ids = _best_of_files(_matrix(part.column("vector"), part.num_rows), uri, lengths, n)
                repeated = np.repeat(part.column("id").to_numpy(zero_copy_only=False), scores.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(repeated, pa.int64()), pa.array(ids.ravel(), pa.int64()), pa.array(scores.ravel())], names=["user", "item", "score"])

    found = asked.repartition(parts, "id").mapInArrow(score, "user long, item long, score double")
    best = top_per_key(found, ["user"], [F.desc("score"), F.asc("item")], n)
    return best.select(F.col("user").alias(user), F.col("item").alias(item), "score", "position")
