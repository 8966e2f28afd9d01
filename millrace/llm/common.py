"""What the operators share: registration, Arrow helpers, words, and files in the shared folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.shared import mapped_bytes, shared_files, write_shared  # noqa: F401
from millrace.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    Enough for one machine, and for clusters where it lies at the same place; else use ``--py-files``.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, known)])


def query(name: str, sql: str | None = None):
    """Register a query of this subpackage, with its SQL if it has one."""

    def register(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str | Column, parts: int) -> Column:
    """crc32 of a value's text, modulo ``parts``; null counts as the text ``null``."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(value.cast("string"), F.lit("null")).cast("binary")) % parts


def share_below(column: str | Column, seed: int, share: float | Column) -> Column:
    """True for a reproducible share of the values, independent of ``fold``."""
    value = F.col(column) if isinstance(column, str) else column
    draw = F.pmod(F.xxhash64(F.lit(seed), value), F.lit(1 << 30)).cast("double") / float(1 << 30)
    return draw < share


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is the empty text."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def rows_to_table(columns: dict[str, pa.Array | list | np.ndarray]) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


class WordHash(dict):
    """64-bit hashes of words, kept for the words met lately. At most ``size`` are held at once."""

    def __init__(self, size: int = 300_000):
        super().__init__()
        self.size = size

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.size:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One 64-bit hash of an ordered pair of 64-bit hashes."""
    with np.errstate(over="ignore"):
        value = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(31)))
        value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return value ^ (value >> np.uint64(31))


def each_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """A ``mapInArrow`` function from one of single batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield function(batch)

    return run


def null_safe(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on equally named columns, null equal to null. Keeps the left side's columns of that name."""
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in names})
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(renamed[f"_right_{name}"])
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_right_{name}" for name in names])


def hidden(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows under column names that clash with nothing, and the new name of each column."""
    names = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of ``hidden`` under their own names again."""
    return rows.select(*[F.col(new).alias(old) for old, new in names.items()])


def stored_with(df: DataFrame, label: str, measures: dict[str, Column]) -> tuple[DataFrame, dict]:
    """The frame stored, and aggregates of it observed while it was written: no second job for them."""
    run = Observation()
    observed = df.observe(run, *[value.alias(name) for name, value in measures.items()])
    return materialize(observed, label), run.get
