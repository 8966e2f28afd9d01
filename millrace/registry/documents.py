"""Chunks, retrieval, guard and answer evaluation on documents and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.guard import (
    BLOCKED_INPUT,
    BLOCKED_OUTPUT,
    CARD,
    CATEGORY_WORDS,
    CONTENT_FILTERS,
    EMAIL,
    NOT_LETTERS,
    PHONE,
    SSN,
    TOPIC_PHRASES,
    WORDS_NEEDED,
    anonymize,
    card_numbers,
    has_ssn,
)
from millrace.functions.text import (
    CITATION_TYPE,
    citation_links,
    feature_link,
    link_bucket,
    link_key,
    request_question,
    words,
)
from millrace.operators.vector_index import build_index, search_index
from millrace.operators.similarity import centroids, top_k_similar
from millrace.plans.documents import (
    chunk_documents,
    evaluate_cases,
    evaluation_report,
    guard,
    report_cases,
    retrieve,
)
from millrace.registry import query, table
from millrace.session import spread



def documents(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, dealt out to all cores for the work on their texts."""
    return spread(table(spark, sf, "documents"))


CHUNKS = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(text, '[ \t\r\n\f]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 61, 0) + 1, 240)) AS start FROM w WHERE len(ws) > 0
)
SELECT doc_id, CAST(start // 240 AS INTEGER) AS chunk_no,
       CAST(len(list_slice(ws, start + 1, start + 300)) AS INTEGER) AS n_words,
       array_to_string(list_slice(ws, start + 1, start + 300), ' ') AS chunk_text
FROM s
"""


@query("chunk_documents", CHUNKS)
def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_documents(documents(spark, sf), "doc_id", "text")


@query(
    "topk_similar",
    """
WITH cells AS (
  SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings
), means AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM cells GROUP BY 1, 2
), q AS (SELECT label AS query_id, list(x ORDER BY i) AS v FROM means GROUP BY 1
), scored AS (
  SELECT query_id, vec_id, round(list_cosine_similarity(v, CAST(embedding AS DOUBLE[])), 9) AS similarity
  FROM q CROSS JOIN embeddings
)
SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, round(similarity, 6) AS similarity,
       CAST(row_number() OVER w AS INTEGER) AS position
FROM scored WINDOW w AS (PARTITION BY query_id ORDER BY similarity DESC, vec_id)
QUALIFY row_number() OVER w <= 10
""",
)
def topk(spark: SparkSession, sf: str) -> DataFrame:
    """The ten vectors nearest to the mean vector of each label."""
    vectors = table(spark, sf, "embeddings")
    found = top_k_similar(centroids(vectors, "label"), vectors, 10, query_id="label")
    return found.withColumn("similarity", F.round("similarity", 6))


@query(
    "topk_similar_all",
    """
WITH s AS (
  SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]),
         CAST(v.embedding AS DOUBLE[])), 9) AS similarity
  FROM embeddings q CROSS JOIN embeddings v
)
SELECT query_id, vec_id, round(similarity, 6) AS similarity, CAST(row_number() OVER w AS INTEGER) AS position
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY similarity DESC, vec_id) QUALIFY row_number() OVER w <= 3
""",
)
def topk_all(spark: SparkSession, sf: str) -> DataFrame:
    """The three vectors nearest to every vector, by an index of cells."""
    vectors = table(spark, sf, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    found, _ = search_index(build_index(vectors, cells=32), asked, 3)
    return found.select("query_id", F.col("id").alias("vec_id"), F.round("similarity", 6).alias("similarity"), "position")


@query(
    "topk_similar_each",
    """
WITH s AS (
  SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]),
         CAST(v.embedding AS DOUBLE[])), 9) AS similarity
  FROM embeddings q CROSS JOIN embeddings v WHERE q.label = 3
)
SELECT query_id, vec_id, round(similarity, 6) AS similarity, CAST(row_number() OVER w AS INTEGER) AS position
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY similarity DESC, vec_id) QUALIFY row_number() OVER w <= 3
""",
)
def topk_each(spark: SparkSession, sf: str) -> DataFrame:
    """Every stored vector of one label as a query, in blocks of sixteen."""
    vectors = table(spark, sf, "embeddings")
    asked = vectors.filter("label = 3").select(F.col("vec_id").alias("query_id"), "embedding")
    found = top_k_similar(asked, vectors, 3, block=16)
    return found.withColumn("similarity", F.round("similarity", 6))


TERMS = r"""
SELECT {key} AS key, w AS term, count(*) AS n
FROM (SELECT {key}, unnest(list_filter(string_split_regex(lower({text}), '[ \t\r\n\f]+'), lambda x: x <> '')) AS w FROM {rows})
GROUP BY 1, 2
"""


@query(
    "retrieve_chunks",
    f"""
WITH pieces AS (SELECT doc_id || '-' || chunk_no AS chunk_id, chunk_text FROM ({CHUNKS})
), c AS ({TERMS.format(key="chunk_id", text="chunk_text", rows="pieces")}
), f AS (
  SELECT term, ln(((SELECT count(DISTINCT key) FROM c) + 1.0) / (count(*) + 1.0)) AS idf FROM c GROUP BY 1
), v AS (SELECT key, term, n * idf AS w FROM c JOIN f USING (term) WHERE idf > 0
), vn AS (SELECT key, sqrt(sum(w * w)) AS len FROM v GROUP BY 1
), q AS (
  SELECT key, term, n * idf AS w FROM ({TERMS.format(key="item_id", text="text", rows="benchmark")}) JOIN f USING (term)
  WHERE idf > 0
), qn AS (SELECT key, sqrt(sum(w * w)) AS len FROM q GROUP BY 1
), s AS (
  SELECT q.key AS query_id, v.key AS chunk_id, round(sum(v.w / vn.len * q.w / qn.len), 9) AS similarity
  FROM v JOIN q USING (term) JOIN vn ON vn.key = v.key JOIN qn ON qn.key = q.key GROUP BY 1, 2
)
SELECT CAST(query_id AS BIGINT) AS query_id, chunk_id, round(similarity, 6) AS similarity,
       CAST(row_number() OVER w AS INTEGER) AS position
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY similarity DESC, chunk_id) QUALIFY row_number() OVER w <= 5
""",
)
def retrieve_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The five document chunks nearest to each benchmark text, by word weights."""
    # Dealt by document, so that chunks of one id, even of a repeated document, are in one partition.
    pieces = chunk_documents(table(spark, sf, "documents").repartition("doc_id"), "doc_id", "text").select(
        F.concat_ws("-", F.col("doc_id").cast("string"), F.col("chunk_no").cast("string")).alias("chunk_id"),
        "chunk_text",
    )
    found = retrieve(table(spark, sf, "benchmark"), pieces, 5, dealt=True)
    return found.withColumn("similarity", F.round("similarity", 6))


LUHN = """
list_filter(
  list_transform(regexp_extract_all({text}, '{card}'), lambda m: regexp_replace(m, '[^0-9]', '', 'g')),
  lambda d: length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i:
    CASE WHEN (length(d) - i) % 2 = 1
         THEN 2 * CAST(substr(d, i, 1) AS INTEGER) - CASE WHEN substr(d, i, 1) > '4' THEN 9 ELSE 0 END
         ELSE CAST(substr(d, i, 1) AS INTEGER) END)) % 10 = 0)
"""


def _cards(text: str) -> str:
    return LUHN.format(text=text, card=CARD)


def _clean(text: str) -> str:
    return (
        f"regexp_replace(regexp_replace({text}, '{EMAIL}', '{{EMAIL}}', 'g'), '{PHONE}', '{{PHONE}}', 'g')"
    )


@query(
    "redact_pii",
    f"""
SELECT doc_id, {_clean("text")} AS clean_text, regexp_matches(text, '{SSN}') AS has_ssn,
       CAST(len({_cards("text")}) AS INTEGER) AS cards
FROM documents
""",
)
def redact_pii(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id",
        anonymize("text").alias("clean_text"),
        has_ssn("text").alias("has_ssn"),
        F.size(card_numbers("text")).alias("cards"),
    )


def _found(text: str, tokens: str) -> str:
    categories = ",\n".join(
        f"CASE WHEN len(list_intersect({tokens}, {CATEGORY_WORDS[name]!r})) >= {WORDS_NEEDED[strength]} "
        f"THEN '{name}' END"
        for name, strength in CONTENT_FILTERS.items()
    )
    return f"""concat_ws(',', {categories},
      CASE WHEN regexp_matches(lower({text}), '{"|".join(TOPIC_PHRASES)}') THEN 'IllegalActivity' END,
      CASE WHEN regexp_matches({text}, '{SSN}') THEN 'US_SOCIAL_SECURITY_NUMBER' END,
      CASE WHEN len({_cards(text)}) > 0 THEN 'CREDIT_DEBIT_CARD_NUMBER' END)"""


@query(
    "guard_actions",
    f"""
WITH texts AS (
  SELECT doc_id, text, lang, string_split_regex(lower(text), '{NOT_LETTERS}') AS tokens FROM documents
), found AS (SELECT doc_id, text, lang, {_found("text", "tokens")} AS findings FROM texts)
SELECT doc_id, findings, CASE WHEN findings <> '' THEN 'INTERVENED' ELSE 'NONE' END AS guardrail_action,
       CASE WHEN findings = '' THEN {_clean("text")} WHEN lang = 'en' THEN '{BLOCKED_INPUT}'
            ELSE '{BLOCKED_OUTPUT}' END AS guarded_text
FROM found
""",
)
def guard_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Documents guarded as messages: English ones on their way in, others on their way out."""
    docs = documents(spark, sf).withColumn(
        "direction", F.when(F.col("lang") == "en", "input").otherwise("output")
    )
    checked = guard(docs, "text", "direction")
    return checked.select(
        "doc_id", F.array_join("findings", ",").alias("findings"), "guardrail_action", "guarded_text"
    )


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """User turns as cases, the next turn as the answer.

    Keywords are the question's first three words. Every seventh conversation expects a block, and
    every fifth gets one. Even turns cite a source twice, the others none.
    """
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    # Joined on conversation and turn, so that a long conversation is spread over the tasks.
    replies = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    answered = turns.filter("role = 'user'").join(replies, ["conv_id", "turn"])
    uri = F.concat(F.lit("s3://answers/"), F.col("conv_id").cast("string"))
    reference = F.struct(F.struct(F.struct(uri.alias("uri")).alias("s3Location")).alias("location"))
    citation = F.struct(F.array(reference, reference).alias("retrievedReferences"))
    return answered.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("text").alias("question"),
        "answer",
        F.slice(words("text"), 1, 3).alias("expected_keywords"),
        (F.col("conv_id") % 7 == 0).alias("expect_blocked"),
        F.when(F.col("conv_id") % 5 == 0, "INTERVENED").otherwise("NONE").alias("guardrail_action"),
        F.when(F.col("turn") % 4 == 0, F.array(citation))
        .otherwise(F.array().cast(CITATION_TYPE))
        .alias("citations"),
        F.length("answer").cast("double").alias("latency_ms"),
    )


JUDGED = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer
  FROM conversations
), cases AS (
  SELECT conv_id || '-' || turn AS id, answer, conv_id % 7 = 0 AS wants,
         CASE WHEN conv_id % 5 = 0 THEN 'INTERVENED' ELSE 'NONE' END AS guardrail_action,
         turn % 4 = 0 AS has_citation, CAST(length(answer) AS DOUBLE) AS latency_ms,
         list_slice(list_filter(string_split_regex(text, '[ \t\r\n\f]+'), lambda x: x <> ''), 1, 3) AS kw
  FROM turns WHERE role = 'user' AND answer IS NOT NULL
), checked AS (
  SELECT *, guardrail_action = 'INTERVENED' OR contains(lower(answer), 'blocked') AS blocked,
         len(kw) = 0 OR len(list_filter(kw, lambda k: contains(lower(answer), lower(k)))) > 0 AS kw_ok
  FROM cases
), judged AS (
  SELECT *, CASE WHEN wants THEN blocked ELSE kw_ok AND guardrail_action = 'NONE' END AS passed,
    concat_ws('; ', CASE WHEN wants AND NOT blocked THEN 'expected guardrail block' END,
      CASE WHEN NOT wants AND NOT kw_ok THEN 'missing keywords: [' ||
           array_to_string(list_transform(kw, lambda k: '''' || k || ''''), ', ') || ']' END,
      CASE WHEN NOT wants AND guardrail_action <> 'NONE' THEN 'unexpected guardrail: ' || guardrail_action END)
    AS notes
  FROM checked
)
"""


@query(
    "eval_cases",
    JUDGED
    + """
SELECT id, passed, has_citation, guardrail_action, round(latency_ms, 1) AS latency_ms,
       substr(answer, 1, 200) AS answer_preview, notes FROM judged
""",
)
def eval_cases(spark: SparkSession, sf: str) -> DataFrame:
    judged = report_cases(evaluate_cases(_answers(spark, sf)))
    return judged.withColumn("notes", F.array_join("notes", "; "))


@query(
    "eval_report",
    JUDGED
    + """
SELECT count(*) AS cases, round(avg(CAST(passed AS INTEGER)), 3) AS pass_rate,
       round(avg(CAST(passed AS INTEGER)) FILTER (WHERE id <> '0-0'), 3) AS faithfulness_proxy,
       round(avg(CAST(has_citation AS INTEGER)), 3) AS citation_rate,
       round(avg(latency_ms), 1) AS avg_latency_ms, avg(CAST(passed AS INTEGER)) >= 0.85 AS gate
FROM judged
""",
)
def eval_report(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation_report(evaluate_cases(_answers(spark, sf)), guard_case="0-0")


@query(
    "citation_links",
    """
SELECT doc_id, concat_ws(',', 's3://kb/' || source,
         CASE WHEN lang <> 'fr' AND lang <> source THEN 's3://kb/' || lang END) AS links FROM documents
""",
)
def citations(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as answers that cite their source twice, their language once, and an empty link."""

    def reference(uri: Column) -> Column:
        return F.struct(F.struct(F.struct(uri.alias("uri")).alias("s3Location")).alias("location"))

    source = F.concat(F.lit("s3://kb/"), "source")
    lang = F.when(F.col("lang") != "fr", F.concat(F.lit("s3://kb/"), "lang"))
    cited = F.array(
        F.struct(F.array(reference(source), reference(F.lit(""))).alias("retrievedReferences")),
        F.struct(F.array(reference(lang), reference(source)).alias("retrievedReferences")),
    )
    docs = table(spark, sf, "documents").select("doc_id", cited.alias("citations"))
    return docs.select("doc_id", F.array_join(citation_links("citations"), ",").alias("links"))


@query(
    "object_links",
    """
SELECT page_id, 's3://' || split_part(split_part(url, '://', 2), '/', 1) || '/features/'
         || split_part(split_part(url, '://', 2), '/', 2) AS link,
       split_part(split_part(url, '://', 2), '/', 1) AS bucket,
       'features/' || split_part(split_part(url, '://', 2), '/', 2) AS key, url LIKE 's3://%' AS url_is_link
FROM pages
""",
)
def object_links(spark: SparkSession, sf: str) -> DataFrame:
    """Feature links built from the host and first folder of each page, then taken apart again."""
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)/([^/]*)", 1)
    folder = F.regexp_extract("url", "^[a-z]+://([^/]+)/([^/]*)", 2)
    linked = table(spark, sf, "pages").select("page_id", "url", feature_link(host, folder).alias("link"))
    return linked.select(
        "page_id",
        "link",
        link_bucket("link").alias("bucket"),
        link_key("link").alias("key"),
        link_bucket("url").isNotNull().alias("url_is_link"),
    )


@query(
    "request_questions",
    """
SELECT conv_id, turn, CASE role WHEN 'user' THEN trim(text, ' ') END AS question FROM conversations
""",
)
def request_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as request bodies: user turns well-formed, system turns cut off, other ones blank."""
    asked = F.when(F.col("role") == "user", F.concat(F.lit(" "), "text", F.lit("  "))).otherwise(F.lit("   "))
    body = F.to_json(F.struct(asked.alias("question")))
    broken = F.when(F.col("role") == "system", F.lit('{"question": ')).otherwise(body)
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", request_question(broken).alias("question")
    )
