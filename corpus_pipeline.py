"""From raw documents to packed training sequences, in five stages.

Each stage gets what its predecessor kept and returns the columns of ``documents``; the last one
returns pieces of packed sequences. Rows of one ``doc_id`` are one document.

1. toxicity: documents scored toxic go.
2. quality: documents that fail the base rules or lie far outside the mass of their language and
   source go.
3. near_dedup: of each group of near duplicates (five-word shingles, similarity 0.8 or more) the
   document with the smallest id stays, and of repeated rows one.
4. mixing: documents are repeated or left out so that the sources meet their target weights.
5. packing: all tokens are packed into sequences of 2,048.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import hidden, importable, restored
from millrace.llm.minhash import without_near_duplicates
from millrace.llm.mixing import mix_copies
from millrace.llm.packing import pack, vocabulary_path
from millrace.llm.quality import quality_verdicts
from millrace.llm.toxicity import fit, toxicity
from millrace.session import settled


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model learns from the labels of the documents at hand, and scores all of them."""
    importable(spark)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, names = hidden(docs)
    return restored(toxicity(rows, model, rows.columns, names["text"]).filter("predicted = 0"), names)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, names = hidden(docs)
    verdicts = quality_verdicts(rows, names["text"], (names["lang"], names["source"]), tuple(rows.columns))
    return restored(verdicts.filter("kept"), names)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, names = hidden(docs)
    mixed = mix_copies(rows, names["doc_id"], names["text"], names["source"], carry=tuple(rows.columns))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return restored(mixed.filter("copies > 0").select(*rows.columns, copies), names)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = pack(docs, vocabulary_path())
    return packed.select(
        "doc_id", "source", "start", "length", F.crc32("piece_ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset", "padding",
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The stages learn models and iterate, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
    return docs
