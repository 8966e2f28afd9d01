"""Nearest vectors by cells: an index over unit vectors, searched exactly or in the nearest cells only.

Centres come from k-means on a bounded sample. Every vector is stored in the cell of its nearest centre, and a
cell is cut into rings: blocks of vectors by distance from the centre. By the triangle inequality a vector
at distance ``d`` from a centre lies at least ``|d - D|`` from a query at distance ``D`` from it. A search
first scans the cells whose centres are nearest, which bounds the k-th distance from above, and then
only the rings of other cells that this bound does not rule out. With ``probes`` set and ``exact`` off it ends after
the first step; recall is then to be measured.

Tasks hold the centres (``cells`` rows), one block of queries and one ring. No query meets a ring that its
bounds rule out, and each pair of blocks returns its best ``k`` per query.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.similarity import DIGITS, _best_of_all, _unit
from millrace.operators.windows import top_per_key
from millrace.session import materialize

RING_ROWS = 2048
QUERY_ROWS = 512
SLACK = 1e-6  # of distances, for rounding

# Task functions travel inside the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class VectorIndex:
    """``centres``: one row per cell. ``rings``: ``cell, low, high, ids, data`` with unit vectors as bytes.

    ``reach``: per cell the least and the greatest distance of its vectors from the centre.
    """

    centres: np.ndarray
    reach: np.ndarray
    rings: DataFrame
    id_type: str


def fit_centres(vectors: DataFrame, column: str, cells: int, sample_rows: int, seed: int = 42) -> np.ndarray:
    """Centres of k-means over about ``sample_rows`` vectors, chosen by hash; all rows if there are fewer."""
    present = vectors.filter(F.col(column).isNotNull())
    share = min(1.0, sample_rows / max(present.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit(seed), column), F.lit(1 << 30)).cast("double") / float(1 << 30)
    chosen = present.filter(draw < share)
    wide = chosen.select(array_to_vector(F.transform(column, lambda x: x.cast("double"))).alias("features"))
    stored = materialize(wide, "sample")
    if stored.isEmpty():
        return np.zeros((0, 0))
    model = KMeans(k=max(cells, 2), maxIter=10, seed=seed, initMode="random").fit(stored)
    return _unit(np.stack(model.clusterCenters()))


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    own = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(own - 2 * points @ centres.T, 0.0))


def _matrix(column: pd.Series) -> np.ndarray:
    return _unit(np.stack(column.to_numpy()).astype("float64"))


def build_index(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    cells: int = 64,
    sample_rows: int = 100_000,
    ring_rows: int = RING_ROWS,
) -> VectorIndex:
    """Every vector in the cell of its nearest centre. Null vectors are left out."""
    centres = fit_centres(vectors, column, cells, sample_rows)
    id_type = vectors.schema[key].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                points = _matrix(batch[column])
                far = _distances(points, centres)
                cell = far.argmin(axis=1)
                data = [row.tobytes() for row in points]
                yield pd.DataFrame({"cell": cell, "far": far[np.arange(len(cell)), cell], "id": batch[key], "data": data})

    present = vectors.select(key, column).filter(F.col(column).isNotNull())
    placed = present.mapInPandas(place, f"cell int, far double, id {id_type}, data binary")
    # Sorted, so that a cell is cut into rings however its rows are spread over partitions.
    ordered = materialize(placed, "placed").repartitionByRange("cell", "far", "id").sortWithinPartitions("cell", "far", "id")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cell, rows in batch.groupby("cell", sort=True):
                for start in range(0, len(rows), ring_rows):
                    part = rows.iloc[start : start + ring_rows]
                    yield pd.DataFrame(
                        {"cell": [cell], "low": [part["far"].min()], "high": [part["far"].max()],
                         "ids": [part["id"].tolist()], "data": [b"".join(part["data"])]}
                    )

    rings = ordered.mapInPandas(cut, f"cell int, low double, high double, ids array<{id_type}>, data binary")
    rings = materialize(rings, "rings")
    reach = np.full((len(centres), 2), [np.inf, -np.inf])
    for row in rings.groupBy("cell").agg(F.min("low"), F.max("high")).collect():  # a row per cell
        reach[row[0]] = row[1], row[2]
    return VectorIndex(centres, reach, rings, id_type)


QUERY_COLUMNS = "cell int, query_id long, away double, bound double, data binary"


def _visits(asked: DataFrame, index: VectorIndex, probes: int, rest: bool) -> DataFrame:
    """``QUERY_COLUMNS``: the cells that each query visits, with its distance from their centre.

    The first step visits the nearest ``probes`` cells; the rest are those not ruled out by ``bound``.
    """
    centres, reach = index.centres, index.reach
    filled = np.isfinite(reach[:, 0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch) or not filled.any():
                continue
            points = np.frombuffer(b"".join(batch["data"])).reshape(len(batch), -1)
            away = _distances(points, centres)
            order = np.argsort(np.where(filled, away, np.inf), axis=1)
            near = np.zeros(away.shape, bool)
            np.put_along_axis(near, order[:, :probes], True, axis=1)
            near &= filled
            if rest:
                least = np.maximum(np.maximum(away - reach[:, 1], reach[:, 0] - away), 0.0)
                near = ~near & filled & (least <= batch["bound"].to_numpy()[:, None] + SLACK)
            query, cell = np.nonzero(near)
            yield pd.DataFrame(
                {"cell": cell, "query_id": batch["query_id"].to_numpy()[query], "away": away[query, cell],
                 "bound": batch["bound"].to_numpy()[query], "data": batch["data"].to_numpy()[query]}
            )

    return asked.mapInPandas(run, QUERY_COLUMNS)


def _query_blocks(visits: DataFrame, rows: int) -> DataFrame:
    """Queries of one cell gathered in rows of up to ``rows``, sorted by distance from the centre."""
    ordered = visits.repartitionByRange("cell", "away", "query_id").sortWithinPartitions("cell", "away", "query_id")

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cell, found in batch.groupby("cell", sort=True):
                for start in range(0, len(found), rows):
                    part = found.iloc[start : start + rows]
                    yield pd.DataFrame(
                        {"cell": [cell], "from": [(part["away"] - part["bound"]).min()], "to": [(part["away"] + part["bound"]).max()],
                         "query_ids": [part["query_id"].tolist()], "away": [part["away"].tolist()],
                         "bound": [part["bound"].tolist()], "asked": [b"".join(part["data"])]}
                    )

    return ordered.mapInPandas(
        gather, "cell int, from double, to double, query_ids array<long>, away array<double>, bound array<double>, asked binary"
    )


def _scan(visits: DataFrame, index: VectorIndex, k: int, rows: int) -> DataFrame:
    """Best ``k`` per query and ring, with ``scanned``: the distances computed, told once per pair of blocks."""
    blocks = _query_blocks(visits, rows).withColumnRenamed("cell", "_cell")
    meets = (F.col("cell") == F.col("_cell")) & (F.col("low") <= F.col("to") + SLACK) & (F.col("high") >= F.col("from") - SLACK)
    work = index.rings.join(blocks, meets)
    id_type = index.id_type

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                away, bound = np.asarray(row.away), np.asarray(row.bound)
                wanted = (row.low <= away + bound + SLACK) & (row.high >= away - bound - SLACK)
                if not wanted.any():
                    continue
                asked = np.frombuffer(row.asked).reshape(len(away), -1)[wanted]
                stored = np.frombuffer(row.data).reshape(len(row.ids), -1)
                ids = np.asarray(row.ids, dtype=str if id_type == "string" else None)
                scores = asked @ stored.T
                number = scores.size
                scores, found = _best_of_all(scores, ids, k)
                told = np.zeros(scores.size, np.int64)
                told[0] = number
                yield pd.DataFrame(
                    {"query_id": np.repeat(np.asarray(row.query_ids)[wanted], scores.shape[1]), "id": found.ravel(),
                     "similarity": scores.ravel(), "scanned": told}
                )

    return work.mapInPandas(scan, f"query_id long, id {id_type}, similarity double, scanned long")


def search_index(
    index: VectorIndex,
    queries: DataFrame,
    k: int = 10,
    query_id: str = "query_id",
    column: str = "embedding",
    probes: int = 2,
    exact: bool = True,
    query_rows: int = QUERY_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Rows ``query_id, id, similarity, position``, and a one-row table with the number of distances computed.

    ``exact`` answers equal those over all vectors; without it only the nearest ``probes`` cells are scanned.
    Similarities are rounded to nine digits, equal ones ordered by id. Null queries get no answers.
    """

    def unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"query_id": batch["query_id"], "data": [row.tobytes() for row in _matrix(batch["_query"])]})

    wanted = queries.select(F.col(query_id).cast("long").alias("query_id"), F.col(column).alias("_query"))
    asked = materialize(wanted.filter(F.col("_query").isNotNull()).mapInPandas(unit, "query_id long, data binary"), "asked")
    order = [F.desc("similarity"), F.asc("id")]
    open_bound = asked.withColumn("bound", F.lit(float("inf")))
    found = materialize(_scan(_visits(open_bound, index, probes, False), index, k, query_rows), "found")
    if exact:
        last = F.when(F.count(F.lit(1)) >= k, F.min("similarity"))
        kth = top_per_key(found, ["query_id"], order, k).groupBy("query_id").agg(last.alias("_kth"))
        # Distance of unit vectors from their similarity. Fewer than k answers rule nothing out.
        distance = F.sqrt(F.greatest(2 - 2 * (F.col("_kth") - 10.0**-DIGITS), F.lit(0.0)))
        bound = F.when(F.col("_kth").isNull(), F.lit(float("inf"))).otherwise(distance)
        bounded = asked.join(kth, "query_id", "left").select("query_id", "data", bound.alias("bound"))
        rest = materialize(_scan(_visits(bounded, index, probes, True), index, k, query_rows), "found")
        found = found.unionByName(rest)
    best = top_per_key(found.drop("scanned"), ["query_id"], order, k)
    return best, found.agg(F.coalesce(F.sum("scanned"), F.lit(0)).alias("scanned"))
