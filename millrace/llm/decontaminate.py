"""Benchmark passages in documents: a prefix-filtered set join over word shingles.

Every window of an item (``window`` consecutive words; the whole item if it is shorter) is a set of
shingles with their places. Shingles are ordered by rarity in the documents. A window of ``n`` shingles that
occurs but for ``missing`` of them shares one of its ``missing + 1`` rarest with the document, so only
these are joined. The place of the match says where the window would begin; it must begin and end
inside the document. What is left is compared word by word.

Only DataFrame functions are used. Texts are not shuffled: positions stream past a broadcast table of the
items' shingles while that is below ``BROADCAST_BYTES``. Beyond it, hashes of positions are joined by
shuffle, and only documents with a candidate meet their texts again.

Null and empty texts have no words, hold nothing and are never hit; nor are items without words found.
Rows that agree in id and text are judged alike, each by itself; a null id is an id like any other. A null
item id counts as the empty text, and items of one id are one item. Empty tables give no hits. Columns other
than the stated ones are not read, whatever their names. Very long texts are a row as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import null_safe, query, stored_with, table
from millrace.session import materialize

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_BYTES = 32 << 20
DOCUMENT = ["_id", "_digest"]


def words(text: str | Column) -> Column:
    """The words of a text, A-Z in lower case."""
    lower = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, BETWEEN_WORDS), "")


def _shingle(source: str, start: Column, size: Column | int) -> Column:
    """Hash of ``size`` words from a place counted from 0."""
    return F.xxhash64(F.slice(F.col(source), start.cast("int") + 1, F.lit(size) if isinstance(size, int) else size))


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``window, words, size``, and the pairs ``window, item`` of those that hold them."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(text).alias("_words"))
    named = named.filter(F.size("_words") > 0).withColumn("size", F.least(F.size("_words"), F.lit(window)))
    starts = F.explode(F.sequence(F.lit(0), F.size("_words") - F.col("size")))
    cut = named.select("item", "size", "_words", starts.alias("_at"))
    cut = cut.select("item", "size", F.slice("_words", F.col("_at") + 1, F.col("size")).alias("words"))
    cut = materialize(cut.distinct(), "item-windows")
    numbered = cut.select("words", "size").distinct().withColumn("window", F.monotonically_increasing_id())
    windows = materialize(numbered, "windows")
    return windows, materialize(cut.join(windows.drop("size"), "words").select("window", "item"), "window-items")


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``window, size, k, offset, shingle``: a window shorter than a shingle is one by itself."""
    sized = windows.withColumn("k", F.least("size", F.lit(shingle)))
    placed = sized.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("k"))))
    return placed.withColumn("shingle", _shingle("words", F.col("offset"), F.col("k")))


def positions(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """``_id, _digest, _words, _n, at, shingle``: every shingle of every document at its place."""
    told = docs.withColumn("_words", words("_text")).withColumn("_n", F.size("_words"))
    placed = told.select(*DOCUMENT, "_words", "_n", F.posexplode("_words").alias("at", "_word"))
    if len(sizes) == 1:
        each = placed.withColumn("k", F.lit(sizes[0]))
    else:
        each = placed.withColumn("k", F.explode(F.array(*[F.lit(k) for k in sizes])))
    return each.filter(F.col("at") + F.col("k") <= F.col("_n")).withColumn("shingle", _shingle("_words", F.col("at"), F.col("k")))


def _matches(found: Column, wanted: str, shingle: int, missing: int) -> Column:
    """True if all but ``missing`` shingles of a window stand at their places in the words found."""
    if not missing:
        return found == F.col(wanted)
    k = F.least(F.size(wanted), F.lit(shingle))
    same = F.filter(
        F.sequence(F.lit(0), F.size(wanted) - k), lambda o: F.slice(found, o + 1, k) == F.slice(wanted, o + 1, k)
    )
    return F.size(same) >= F.size(wanted) - k + 1 - missing


def window_hits(
    docs: DataFrame,
    windows: DataFrame,
    shingle: int = 5,
    missing: int = 0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``_id, _digest, window, size, start`` of every occurrence, for rows ``_id, _digest, _text``."""
    shingles = materialize(window_shingles(windows, shingle), "shingles")
    # At most ``shingle`` whole numbers: the lengths of shingles that the windows have.
    sizes = sorted(row["k"] for row in shingles.select("k").distinct().collect()) or [shingle]
    keys, known = stored_with(shingles.select("shingle").distinct(), "keys", {"rows": F.count(F.lit(1))})
    small = 16 * known["rows"] <= broadcast_bytes
    seen = positions(docs, sizes).select("shingle").join(F.broadcast(keys) if small else keys, "shingle", "left_semi")
    held = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"))

    # A window one of whose shingles no document holds is given up unless shingles may be missing.
    order = Window.partitionBy("window").orderBy("held", "shingle", "offset")
    ranked = shingles.join(held, "shingle", "left").fillna(0, ["held"]).withColumn("_place", F.row_number().over(order))
    prefix = ranked.filter((F.col("_place") <= missing + 1) & (F.col("held") > 0))
    prefix = prefix.select("shingle", "window", "size", "offset", "words")
    weight = F.coalesce(F.sum(F.octet_length(F.array_join("words", " ")) + 64), F.lit(0))
    prefix, known = stored_with(prefix, "prefix", {"bytes": weight})

    begins = F.col("at") - F.col("offset")
    inside = (begins >= 0) & (begins + F.col("size") <= F.col("_n"))
    found = F.slice("_words", F.col("start") + 1, F.col("size"))
    result = [*DOCUMENT, "window", "size", "start"]
    if known["bytes"] <= broadcast_bytes:
        near = positions(docs, sizes).join(F.broadcast(prefix), "shingle").filter(inside).withColumn("start", begins)
        return near.filter(_matches(found, "words", shingle, missing)).select(*result).distinct()
    near = positions(docs, sizes).drop("_words").join(prefix.drop("words"), "shingle").filter(inside)
    near = near.withColumn("start", begins).select(*result).distinct().join(windows.select("window", "words"), "window")
    texts = docs.withColumn("_words", words("_text")).drop("_text")
    sure = null_safe(near, texts, DOCUMENT, "inner").filter(_matches(found, "words", shingle, missing))
    return sure.select(*result).distinct()


def _covered(hits: DataFrame) -> DataFrame:
    """``_id, _digest, n_hit``: words inside at least one occurrence."""
    earlier = Window.partitionBy(*DOCUMENT).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.groupBy(*DOCUMENT, "start").agg(F.max(F.col("start") + F.col("size")).alias("_end"))
    spans = spans.withColumn("_before", F.coalesce(F.max("_end").over(earlier), F.lit(0)))
    fresh = F.greatest(F.lit(0), F.col("_end") - F.greatest("start", "_before"))
    return spans.groupBy(*DOCUMENT).agg(F.sum(fresh).cast("long").alias("n_hit"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 5,
    missing: int = 0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``<doc_id>, n_words, n_hit, items`` for each row of ``docs``.

    ``n_hit`` counts words inside an occurrence of any window; ``items`` lists the ids, as sorted texts, of
    the items with such windows. With ``missing`` > 0 an occurrence may lack so many of its shingles.
    """
    named = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_digest"), F.col(text).alias("_text"))
    windows, holders = item_windows(items, item_id, item_text, window)
    hits = materialize(window_hits(named, windows, shingle, missing, broadcast_bytes), "hits")
    held = hits.select(*DOCUMENT, "window").distinct().join(holders, "window").select(*DOCUMENT, "item").distinct()
    listed = held.groupBy(*DOCUMENT).agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = materialize(null_safe(_covered(hits), listed, DOCUMENT, "left"), "contaminated")
    cased = F.array_remove(F.split(F.coalesce("_text", F.lit("")), BETWEEN_WORDS), "")
    sizes = named.select(*DOCUMENT, F.size(cased).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return null_safe(sizes, found, DOCUMENT, "left").select(
        F.col("_id").alias(doc_id), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items")
    )


@query(
    "op12_benchmark_decontamination",
    r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws,
    row_number() OVER () AS r FROM documents
), iw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
), it AS (SELECT item_id, ws, least(len(ws), 10) AS size FROM iw WHERE len(ws) > 0
), win AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[p : p + size - 1], ' ') AS w
  FROM (SELECT item_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS p FROM it)
), lens AS (SELECT DISTINCT size FROM win
), dwin AS (
  SELECT r, size, p, array_to_string(ws[p : p + size - 1], ' ') AS w
  FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS p FROM dw CROSS JOIN lens WHERE len(ws) >= size)
), hit AS (SELECT r, p, d.size, item_id FROM dwin d JOIN win USING (size, w)
), cover AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS q FROM hit) GROUP BY 1
), found AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    string_agg(i, ',' ORDER BY i) AS listed FROM (SELECT DISTINCT r, item_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cover USING (r) LEFT JOIN found USING (r)
""",
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
