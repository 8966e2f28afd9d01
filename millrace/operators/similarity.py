"""Exact cosine top-k: the k nearest vectors of each query vector.

Vectors are stored as unit vectors in files of the shared folder, a block in each. Queries are gathered into blocks
of bounded size, as rows of a table: the driver sees none of them. Query blocks are dealt out once, and a task
reads the files one after the other, so no vector is sent to meet a query. A task holds its query blocks, their
best k so far and the similarities of one block to another; the best k are all that is shuffled after it.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from millrace.operators.shared import mapped_bytes, write_shared
from millrace.session import materialize, new_path

QUERY_BLOCK = 1024
BATCH_ROWS = 2048
RESULTS = 1 << 20  # answers that a task gathers before it yields them
DIGITS = 9

# Task functions travel inside the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best(parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query (row) the k highest similarities over the parts; lower id first among equals."""
    scores = np.concatenate([part[0] for part in parts], axis=1)
    ids = np.concatenate([part[1] for part in parts], axis=1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


def _best_of_all(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``_best`` of one part, of rounded similarities. Only those that may be among them after rounding are rounded
    and sorted; they are found without sorting a row.
    """
    rows, number = scores.shape
    if number <= k or np.isnan(scores).any():
        return _best([(np.round(scores, DIGITS), np.broadcast_to(ids, scores.shape))], k)
    kth = np.partition(scores, number - k, axis=1)[:, number - k]
    row, at = np.nonzero(scores >= kth[:, None] - 2 * 10.0**-DIGITS)
    found = np.bincount(row, minlength=rows)
    place = np.arange(len(row)) - np.repeat(np.cumsum(found) - found, found)
    near = np.full((rows, found.max(initial=k)), -np.inf)
    names = np.full(near.shape, ids[0], ids.dtype)
    near[row, place], names[row, place] = np.round(scores[row, at], DIGITS), ids[at]
    return _best([(near, names)], k)


def _improved(
    best: tuple[np.ndarray, np.ndarray] | None, scores: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """``best`` per query (row) after one more block of vectors. Only rows that it may change are sorted."""
    if best is None:
        return _best_of_all(scores, ids, k)
    held, names = best
    if held.shape[1] < k:
        return _best([best, _best_of_all(scores, ids, k)], k)
    rows = np.flatnonzero(~(scores.max(axis=1) < held[:, -1] - 2 * 10.0**-DIGITS))
    if len(rows):
        held[rows], found = _best([(held[rows], names[rows]), _best_of_all(scores[rows], ids, k)], k)
        names = names.astype(np.promote_types(names.dtype, found.dtype), copy=False)  # of longer texts
        names[rows] = found
    return held, names


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of a column of lists of numbers."""
    sizes = pc.min_max(pc.list_value_length(column)).as_py()
    if sizes["min"] != sizes["max"]:
        raise ValueError(f"vectors have {sizes['min']} to {sizes['max']} numbers")
    values = column.flatten().to_numpy(zero_copy_only=False)
    return _unit(values.astype(np.float64, copy=False).reshape(len(column), sizes["max"]))


def _blocks(rows: DataFrame, key: str, column: str, size: int, prefix: str) -> DataFrame:
    """Rows of ids and vectors gathered into rows that hold up to ``size`` of them: ids, and unit vectors as bytes."""
    id_type = rows.schema[key].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                data = pa.array([_matrix(part.column(1)).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, data], names=[f"{prefix}_ids", f"{prefix}_data"])

    present = rows.select(key, column).filter(F.col(column).isNotNull())
    return present.mapInArrow(gather, f"{prefix}_ids array<{id_type}>, {prefix}_data binary")


def vector_files(vectors: DataFrame, key: str, column: str, rows: int = BATCH_ROWS) -> tuple[str, list[Row]]:
    """Unit vectors in files of up to ``rows``, each followed by its ids. The folder, and ``name, number, width, named``
    of each file. Null ids have files of their own.
    """
    uri = new_path(vectors.sparkSession, "vector-blocks")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                for named in (True, False):
                    own = part.filter(pc.equal(part.column(0).is_valid(), named))
                    if not own.num_rows:
                        continue
                    matrix, name, ids = _matrix(own.column(1)), uuid.uuid4().hex, pa.BufferOutputStream()
                    with pa.ipc.new_stream(ids, pa.schema([own.schema.field(0)])) as out:
                        out.write_batch(own.select([0]))
                    write_shared(f"{uri}/{name}", matrix.tobytes() + ids.getvalue().to_pybytes())
                    yield pa.RecordBatch.from_pylist([{"name": name, "number": len(matrix), "width": matrix.shape[1], "named": named}])

    present = vectors.select(key, column).filter(F.col(column).isNotNull())
    # Stored: a repeated task writes other files, and only those that are told of here are read.
    told = materialize(present.mapInArrow(write, "name string, number long, width long, named boolean"), "vector-files")
    return uri, told.collect()  # a row per file


def _read(uri: str, file: Row) -> tuple[pa.Array, np.ndarray]:
    """Ids and unit vectors of a file."""
    data = np.asarray(mapped_bytes(f"{uri}/{file.name}"))
    size = file.number * file.width * 8
    ids = pa.ipc.open_stream(pa.py_buffer(data[size:])).read_next_batch().column(0)
    return ids, data[:size].view(np.float64).reshape(file.number, file.width)


def _names(ids: pa.Array) -> np.ndarray:
    """Ids as an array that sorts; if they are null, one that does not tell them apart."""
    if ids.null_count:
        return np.zeros(len(ids), np.int8)
    if pa.types.is_string(ids.type) or pa.types.is_large_string(ids.type):
        return np.asarray(ids.to_pylist(), dtype=str)
    return ids.to_numpy(zero_copy_only=False)


def pair_blocks(stored: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """Every block of ``stored`` beside every block of the stated queries ``asked`` (a stored table).

    Query blocks are dealt into as many slots as there are blocks, and the other blocks go to each slot: a
    join on the slot, which Catalyst broadcasts only while the query blocks are small in bytes, and
    whose large partitions adaptive execution splits otherwise.
    """
    slots = max(asked.count(), 1)
    dealt = asked.withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(slots)).cast("int"))
    spread = stored.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return spread.join(dealt, "_slot").drop("_slot")


def _scan(asked: DataFrame, uri: str, files: list[Row], k: int, vector_id: str, id_type: str, block: int) -> DataFrame:
    """The best k of each query, once for each group of files that tasks read apart.

    There are only as many groups as it takes to give every core work, and two if some ids are null: a group has files
    with ids or without.
    """
    blocks, cores = asked.count(), asked.sparkSession.sparkContext.defaultParallelism
    wanted = -(-8 * cores // max(blocks, 1))
    kinds = [[file for file in files if file.named == named] for named in (True, False)]
    groups = [kind[start::wanted] for kind in kinds for start in range(min(wanted, len(kind)))] or [[]]
    held = max(RESULTS // max(block * k, 1), 1)

    def answers(part: pa.RecordBatch, group: list[Row]) -> Iterator[pa.RecordBatch]:
        own = [ids.values for ids in part.column("asked_ids")]
        queries = [np.frombuffer(data.as_buffer()).reshape(len(ids), -1) for ids, data in zip(own, part.column("asked_data"), strict=True)]
        best = [None] * len(own)
        for file in group:
            ids, vectors = _read(uri, file)
            names = _names(ids)
            for at, matrix in enumerate(queries):
                best[at] = _improved(best[at], matrix @ vectors.T, names, k)
        if group:
            repeated = [ids.take(pa.array(np.repeat(np.arange(len(ids)), scores.shape[1]))) for ids, (scores, _) in zip(own, best, strict=True)]
            found = [pa.array(n.ravel(), ids.type) if file.named else pa.nulls(n.size, ids.type) for _, n in best]
            similarity = pa.array(np.concatenate([scores.ravel() for scores, _ in best]), from_pandas=True)
            columns = [pa.concat_arrays(repeated), pa.concat_arrays(found), similarity]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", vector_id, "similarity"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column("_group").to_numpy()
            for group in np.unique(of):
                at = np.flatnonzero(of == group)
                for start in range(0, len(at), held):
                    yield from answers(batch.take(pa.array(at[start : start + held])), groups[group])

    work = asked.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))))
    # By number and not by a key, so that each task gets its share of blocks, however few they are.
    dealt = work.repartition(max(1, min(blocks * len(groups), 8 * cores)))
    return dealt.mapInArrow(scan, f"query_id long, {vector_id} {id_type}, similarity double")


def top_k_similar(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 10,
    query_id: str = "query_id",
    vector_id: str = "vec_id",
    column: str = "embedding",
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """Rows ``(query_id, <vector_id>, similarity, position)`` with position 1 to k.

    Query ids are integers, vector ids integers or text. Similarities are rounded to nine digits;
    equal ones are ordered by id. A zero vector has similarity 0 to everything. ``block`` bounds the
    queries that meet a block of vectors at once.
    """
    wanted = queries.select(F.col(query_id).cast("long").alias("query_id"), F.col(column).alias("_query"))
    # Stored: the queries are evaluated once, however many tasks they go to.
    asked = materialize(_blocks(wanted, "query_id", "_query", block, "asked"), "queries")
    uri, files = vector_files(vectors, vector_id, column)
    id_type = vectors.schema[vector_id].dataType.simpleString()
    found = _scan(asked, uri, files, k, vector_id, id_type, block)
    order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), F.col(vector_id))
    ranked = found.withColumn("position", F.row_number().over(order))
    return ranked.filter(F.col("position") <= k)


def centroids(vectors: DataFrame, group: str, column: str = "embedding") -> DataFrame:
    """Mean vector per group. Dimensions are averaged apart, so no task sees a whole group."""
    cells = vectors.select(group, F.posexplode(column).alias("_at", "_x"))
    means = cells.groupBy(group, "_at").agg(F.avg(F.col("_x").cast("double")).alias("_x"))
    sorted_cells = F.array_sort(F.collect_list(F.struct("_at", "_x")))
    return means.groupBy(group).agg(F.transform(sorted_cells, lambda c: c["_x"]).alias(column))
