"""Documents and answers: chunks, guard, evaluation."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.guard import (
    DEFAULT_POLICY,
    INTERVENED,
    NOT_INTERVENED,
    Policy,
    action_of,
    findings,
    guarded_text,
)
from millrace.functions.text import CHUNK_OVERLAP, CHUNK_TOKENS, any_keyword, chunk_starts, preview, words
from millrace.operators.lexical import (
    BLOCK_BYTES,
    QUESTION_TERMS,
    best_texts,
    held_terms,
    question_blocks,
    text_blocks,
    weighted_blocks,
)
from millrace.session import materialize

# Vector length, the case left out of the faithfulness rate, the pass gate, note texts.
VECTOR_DIMENSIONS = 1024
GUARD_CASE = "guardrail_block"
PASS_GATE = 0.85
NOTE_NOT_BLOCKED = "expected guardrail block"
NOTE_KEYWORDS = "missing keywords: "
NOTE_BLOCKED = "unexpected guardrail: "


def chunk_documents(
    docs: DataFrame,
    key: str,
    text: str,
    size: int = CHUNK_TOKENS,
    overlap: float = CHUNK_OVERLAP,
) -> DataFrame:
    """Overlapping chunks of ``size`` words: ``(key, chunk_no, n_words, chunk_text)``.

    Words stand in for model tokens. Within a chunk, words are joined by single blanks. A text
    without words has no chunk. Each row is cut by itself: no shuffle.
    """
    split = docs.select(key, words(text).alias("_words"))
    starts = F.when(F.size("_words") > 0, chunk_starts(F.size("_words"), size, overlap))

    def cut(start: Column) -> Column:
        piece = F.slice("_words", start + 1, F.lit(size))
        return F.struct(F.size(piece).alias("n_words"), F.array_join(piece, " ").alias("chunk_text"))

    # Only chunks leave the row: its words are not copied for each of them.
    chunks = split.select(key, F.posexplode(F.transform(starts, cut)).alias("chunk_no", "_chunk"))
    return chunks.select(key, "chunk_no", "_chunk.n_words", "_chunk.chunk_text")


def fit_lexical(texts: DataFrame, text: str, dimensions: int = VECTOR_DIMENSIONS) -> PipelineModel:
    """Word-weight model for use where no embedding model is at hand."""
    steps = [
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions),
        IDF(inputCol="_counts", outputCol="_weights"),
        Normalizer(inputCol="_weights", outputCol="_unit"),
    ]
    return Pipeline(stages=steps).fit(texts.select(words(F.lower(F.col(text))).alias("_words")))


def lexical_vectors(
    model: PipelineModel, texts: DataFrame, key: str, text: str, column: str = "embedding"
) -> DataFrame:
    """Unit-length word-weight vector of each text as an array of floats."""
    tokens = texts.select(key, words(F.lower(F.col(text))).alias("_words"))
    return model.transform(tokens).select(key, vector_to_array("_unit", "float32").alias(column))


def term_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Sparse count vectors over words: rows ``(key, term, n)``."""
    terms = texts.select(key, F.explode(words(F.lower(F.col(text)))).alias("term"))
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def inverse_frequencies(held: DataFrame, total: int) -> DataFrame:
    """``term, _held, idf`` over ``total`` texts, ``_held`` of which hold the term; no weight is below zero."""
    weight = F.log((F.lit(total) + 1.0) / (F.col("_held") + 1.0))
    return held.select("term", "_held", F.greatest(weight, F.lit(0.0)).alias("idf"))


def vector_lengths(counts: DataFrame, frequencies: DataFrame, key: str) -> DataFrame:
    """``key, _length`` of the weight vectors; texts without a weighted term are left out."""
    weighted = counts.join(frequencies, "term").select(key, (F.col("n") * F.col("idf")).alias("_w"))
    return weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_length"))


def unit_weights(counts: DataFrame, frequencies: DataFrame, lengths: DataFrame, key: str) -> DataFrame:
    """Sparse unit vectors: rows ``(key, term, weight)``."""
    weighted = counts.join(frequencies, "term").join(lengths, key)
    return weighted.select(key, "term", (F.col("n") * F.col("idf") / F.col("_length")).alias("weight"))


def retrieve(
    questions: DataFrame,
    texts: DataFrame,
    k: int = 5,
    question_id: str = "item_id",
    question: str = "text",
    text_id: str = "chunk_id",
    text: str = "chunk_text",
    seeds: int = 3,
    block_bytes: int = BLOCK_BYTES,
    question_terms: int = QUESTION_TERMS,
    dealt: bool = False,
) -> DataFrame:
    """The ``k`` texts nearest to each question by cosine of word weights: exact, with bounds.

    Texts are gathered into blocks, which meet by the terms of their vocabularies; each block beside each block of
    questions gives every question's best ``k``. There the lists of the ``seeds`` terms that can add most give a first
    k-th score. Lists are read until what is left adds up to a small share of it. Texts whose read weights and the
    maxima of what was not read stay below the k-th score are given up; the others are scored in full. Texts that
    share no term with the question are not returned. Rows of one text id are one text; with ``dealt`` they are in one
    partition already.
    """
    together = texts.select(text_id, text)
    if not dealt:
        together = together.repartition(text_id)
    together = together.sortWithinPartitions(text_id)
    blocks = materialize(text_blocks(together, text_id, text, block_bytes), "blocks")
    # A text without words has no terms; it is none of the texts counted.
    total = blocks.agg(F.coalesce(F.sum("texts"), F.lit(0))).first()[0]
    frequencies = materialize(inverse_frequencies(held_terms(blocks), total), "frequencies")

    words_asked = term_counts(questions.filter(F.col(question_id).isNotNull()), question_id, question)
    words_asked = materialize(words_asked, "words-asked")
    known = words_asked.select("term").distinct().join(frequencies.filter("idf > 0"), "term").select("term", "idf")
    known = materialize(known, "known")
    lengths = vector_lengths(words_asked, known, question_id)
    asked = unit_weights(words_asked, known, lengths, question_id)
    asked = materialize(asked.withColumnRenamed("weight", "_asked"), "questions")
    # What one text holds has one weight, which the blocks need not be told, if nobody asks for it.
    told = frequencies.join(known.select("term", F.lit(True).alias("_known")), "term", "left").filter("_held > 1 OR _known")
    single = max(0.0, math.log((total + 1) / 2))
    weighted = materialize(weighted_blocks(blocks, told.select("term", "idf"), known, single), "weights")

    number = max(1, -(-asked.count() // question_terms))
    gathered = materialize(question_blocks(asked, question_id, number), "question-blocks")
    best = best_texts(weighted, gathered, question_id, text_id, k, seeds)
    return best.select(F.col(question_id).cast("long").alias("query_id"), text_id, "similarity", "position")


def guard(df: DataFrame, text: str, direction: str, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Add ``findings``, ``guardrail_action`` and ``guarded_text``; ``direction`` is input or output."""
    lowered = df.withColumn("_lowered", F.lower(F.col(text)))
    checked = lowered.withColumn("findings", findings(text, policy, "_lowered")).drop("_lowered")
    return checked.withColumns(
        {
            "guardrail_action": action_of(F.col("findings")),
            "guarded_text": guarded_text(text, F.col("findings"), direction),
        }
    )


def evaluate_cases(answers: DataFrame) -> DataFrame:
    """Judge answers. Input: id, answer, expected_keywords, expect_blocked, guardrail_action, citations,
    latency_ms. Adds passed, has_citation, notes and answer_preview.

    A case meant to be blocked passes if the guard intervened or the answer says so. Any other passes
    if it names a keyword (or has none to name) and was not blocked.
    """
    answer = F.coalesce(F.col("answer"), F.lit(""))
    action = F.col("guardrail_action")
    blocked = F.coalesce(action == INTERVENED, F.lit(False)) | F.contains(F.lower(answer), F.lit("blocked"))
    keywords = F.coalesce(F.col("expected_keywords"), F.array().cast("array<string>"))
    keywords_ok = (F.size(keywords) == 0) | any_keyword(answer, keywords)
    let_through = F.coalesce(action == NOT_INTERVENED, F.lit(True))
    wants_block = F.coalesce(F.col("expect_blocked"), F.lit(False))
    quoted = F.array_join(F.transform(keywords, lambda word: F.concat(F.lit("'"), word, F.lit("'"))), ", ")
    notes = F.array(
        F.when(wants_block & ~blocked, F.lit(NOTE_NOT_BLOCKED)),
        F.when(~wants_block & ~keywords_ok, F.concat(F.lit(NOTE_KEYWORDS + "["), quoted, F.lit("]"))),
        F.when(~wants_block & ~let_through, F.concat(F.lit(NOTE_BLOCKED), action)),
    )
    return answers.withColumns(
        {
            "passed": F.when(wants_block, blocked).otherwise(keywords_ok & let_through),
            "has_citation": F.coalesce(F.size("citations") > 0, F.lit(False)),
            "notes": F.array_compact(notes),
            "answer_preview": preview(answer),
        }
    )


def evaluation_report(judged: DataFrame, guard_case: str = GUARD_CASE) -> DataFrame:
    """One row of rates. The faithfulness proxy leaves one named case out; ``gate`` is the verdict."""
    share = lambda flag: F.avg(F.col(flag).cast("double"))
    faithful = F.avg(F.when(F.col("id") != guard_case, F.col("passed").cast("double")))
    rates = judged.agg(
        F.count(F.lit(1)).alias("cases"),
        share("passed").alias("_pass"),
        faithful.alias("_faithful"),
        share("has_citation").alias("_cited"),
        F.avg("latency_ms").alias("_latency"),
    )
    return rates.select(
        "cases",
        F.round("_pass", 3).alias("pass_rate"),
        F.round("_faithful", 3).alias("faithfulness_proxy"),
        F.round("_cited", 3).alias("citation_rate"),
        F.round("_latency", 1).alias("avg_latency_ms"),
        (F.col("_pass") >= PASS_GATE).alias("gate"),
    )


def report_cases(judged: DataFrame) -> DataFrame:
    """The per-case part of a report."""
    return judged.select(
        "id",
        "passed",
        "has_citation",
        "guardrail_action",
        F.round("latency_ms", 1).alias("latency_ms"),
        "answer_preview",
        "notes",
    )
