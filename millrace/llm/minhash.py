"""Near-duplicate documents: many universal hash minima, banding, verification, components.

Documents with equal shingle sets are one node. Each node has ``bands * rows`` minima; nodes that
agree on all minima of a band share a bucket. Buckets are worked off by leaders instead of pairs: the
most central member, the one with the most neighbours over all its buckets, is compared with the
others, and members that turn out to belong to one component need no comparison with each other. This
settles copies of a text, however many, by comparing each with the text they were copied from.

The few nodes in buckets that are not settled are clustered by their rarest shingles, one of which any
two similar sets must share; a passage that many documents hold is not rare and joins nobody. Each
cluster is laid out in blocks ordered by component, and blocks meet block by block: a task holds two
blocks, compares what may be similar and is not connected yet, and gives links only. No cap is set,
no pairs are listed, and no link is lost. Every comparison first holds sizes, and one bit of each
minimum, against each other.

With 64 bands of 8 minima, two documents at similarity 0.8 share no bucket with probability 8e-6.

Null and empty texts have no shingles and are linked with nothing. Rows of one id are one document.
Null ids are allowed: equal texts with null ids are one document, whose ``component_id`` is null
unless it is linked to an id. Ids must be below 2^62. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import WordHash, hidden, mix, query, restored, rows_to_table, stored_with, table, texts
from millrace.llm.components import components
from millrace.operators.joins import only_wanted, with_maybe
from millrace.operators.ranking import with_rank
from millrace.session import materialize, settled

NO_ID = 1 << 62
SEED = 20_240_601
DEVIATIONS = 4.5  # of a signature's disagreements, above those expected, at which a pair is given up
BLOCK = 512  # nodes of a cluster that are compared at once


def shingles(raw: bytes, hashes: WordHash, size: int = 2) -> np.ndarray:
    """The sorted hashes of a text's distinct word shingles; of the whole sequence if it is shorter."""
    words = hashes.of(raw.lower().split())
    if not len(words):
        return words
    size = min(size, len(words))
    found = mix(words[: len(words) - size + 1], np.uint64(size))
    for i in range(1, size):
        found = mix(found, words[i : len(words) - size + 1 + i])
    return np.unique(found)


class MinHasher:
    """Minima of multiply-shift hashes over 32-bit folded shingles, kept as their low bytes."""

    def __init__(self, bands: int, rows: int, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.factors = draw.integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
        self.offsets = draw.integers(0, 1 << 32, bands * rows, np.uint32)

    def signature(self, found: np.ndarray) -> bytes:
        folded = (found ^ (found >> np.uint64(32))).astype(np.uint32)
        low = np.full(len(self.factors), 0xFFFFFFFF, np.uint32)
        for h in range(0, len(low), 64):
            a, b = self.factors[h : h + 64, None], self.offsets[h : h + 64, None]
            for k in range(0, len(folded), 1024):
                np.minimum(low[h : h + 64], (a * folded[k : k + 1024] + b).min(axis=1), out=low[h : h + 64])
        return low.astype(np.uint8).tobytes()

    @staticmethod
    def bits(signature: bytes) -> list[int]:
        """One bit of each minimum, as whole numbers of 64 bits."""
        packed = np.packbits(np.frombuffer(signature, np.uint8) >> 7)
        return np.pad(packed, (0, -len(packed) % 8)).view(np.int64).tolist()

    def buckets(self, signatures: np.ndarray) -> np.ndarray:
        """One 64-bit key per band for each row of a signature matrix."""
        wide = np.zeros((len(signatures), self.bands), np.uint64)
        parts = signatures.reshape(len(signatures), self.bands, self.rows)
        for i in range(self.rows):
            wide = mix(wide, parts[:, :, i].astype(np.uint64))
        return mix(wide, np.arange(self.bands, dtype=np.uint64)[None, :])


def sketch(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``_id, doc_id, n_shingles``, the digest of the set (``hi``, ``lo``), its ``signature`` and ``bits``."""

    def run(batches):
        hashes, hasher = WordHash(), MinHasher(bands, rows)
        for batch in batches:
            counts, high, low, signatures = [], [], [], []
            for raw in texts(batch.column("_text")):
                found = shingles(raw, hashes, size)
                digest = xxhash.xxh3_128_intdigest(found.tobytes())
                counts.append(len(found))
                high.append(digest >> 64)
                low.append(digest & (1 << 64) - 1)
                signatures.append(hasher.signature(found) if len(found) else None)
            yield rows_to_table(
                {
                    "_id": batch.column("_id"),
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array(counts, pa.int64()),
                    "hi": np.array(high, np.uint64).view(np.int64),
                    "lo": np.array(low, np.uint64).view(np.int64),
                    "signature": pa.array(signatures, pa.binary()),
                    "bits": pa.array([s and hasher.bits(s) for s in signatures], pa.list_(pa.int64())),
                }
            )

    return docs.mapInArrow(
        run, "_id long, doc_id long, n_shingles long, hi long, lo long, signature binary, bits array<long>"
    )


def bucket_rows(nodes: DataFrame, bands: int, rows: int) -> DataFrame:
    """``bucket, node``: one row for each band."""

    def run(batches):
        hasher = MinHasher(bands, rows)
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                matrix = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint8)
                keys = hasher.buckets(matrix.reshape(part.num_rows, bands * rows))
                yield rows_to_table(
                    {
                        "bucket": keys.ravel().view(np.int64),
                        "node": np.repeat(part.column("node").to_numpy(zero_copy_only=False), bands),
                    }
                )

    return nodes.mapInArrow(run, "bucket long, node long")


def _plausible(width: int, percent: int) -> Column:
    """True unless sizes or signatures of ``member`` and ``leader`` rule the similarity out.

    Minima differ with probability ``1 - similarity``, and then half of their bits do.
    """
    n, m = F.col("n_shingles"), F.col("_leader_shingles")
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    differ = F.lit(0)
    for i in range(-(-width // 64)):
        differ = differ + F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("_leader_bits")[i]))
    share = (1 - percent / 100) / 2
    return sizes & (differ <= int(width * share + DEVIATIONS * (width * share * (1 - share)) ** 0.5))


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """``node, members``: the sorted hashes of each document's set as bytes."""

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                sets = [shingles(raw, hashes, size).tobytes() for raw in texts(part.column("_text"))]
                yield rows_to_table({"node": part.column("_id"), "members": pa.array(sets, pa.binary())})

    return docs.mapInArrow(run, "node long, members binary")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("_left"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("_right"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("_left"), batch.column("_right"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) else 0
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "_left", "_right").mapInArrow(run, "a long, b long")


def _leaders(members: DataFrame) -> DataFrame:
    """The most central member of each bucket."""
    columns = {"node": "leader", "n_shingles": "_leader_shingles", "bits": "_leader_bits"}
    first = F.max(F.struct("degree", (-F.col("node")).alias("_at"), *columns)).alias("_first")
    led = members.groupBy("bucket").agg(first).select("bucket", *[F.col(f"_first.{c}") for c in columns])
    return led.withColumnsRenamed(columns)


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """``bucket, node``: each node under its rarest shingles.

    Of sets that are similar enough, the ``n - ceil(percent * n) + 1`` rarest shingles of each have one in
    common, in any order of rarity that holds for all. Shingles of one node alone are left out.
    """

    def run(batches):
        for batch in batches:
            for node, members in zip(batch.column("node").to_pylist(), batch.column("members"), strict=True):
                found = np.frombuffer(members.as_buffer(), np.int64)
                yield rows_to_table({"shingle": found, "node": np.full(len(found), node), "n": np.full(len(found), len(found))})

    rows = sets.mapInArrow(run, "shingle long, node long, n long")
    frequent = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("_held"))
    placed = rows.join(frequent, "shingle")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("_held", "shingle"))
    prefix = placed.withColumn("_rank", rank)
    keep = F.col("_rank") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return prefix.filter(keep & (F.col("_held") > 1)).select(F.col("shingle").alias("bucket"), "node")


def _compare_blocks(work: DataFrame, percent: int, width: int) -> DataFrame:
    """Links between the two blocks of each row; ``x`` and ``y`` are arrays of node structs."""
    share = (1 - percent / 100) / 2
    most = int(width * share + DEVIATIONS * (width * share * (1 - share)) ** 0.5)

    def block(items):
        columns = {f: np.array([i[f] for i in items], np.int64) for f in ("node", "root", "cluster", "n_shingles")}
        bits = np.array([i["bits"] for i in items], np.int64).view(np.uint64).reshape(len(items), -1)
        return columns, bits, [np.frombuffer(i["members"], np.uint64) for i in items]

    def links(row):
        (x, x_bits, x_sets), (y, y_bits, y_sets) = block(row["x"]), block(row["y"])
        n, m = x["n_shingles"][:, None], y["n_shingles"][None, :]
        may = (x["cluster"][:, None] == y["cluster"]) & (x["root"][:, None] != y["root"])
        may &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
        if row["bx"] == row["by"]:
            may &= np.tri(len(x_sets), k=-1, dtype=bool)
        joined: dict[int, int] = {}

        def root(r):
            while r in joined:
                r = joined[r]
            return r

        for i in np.flatnonzero(may.any(axis=1)):
            differ = np.bitwise_count(y_bits ^ x_bits[i]).sum(axis=1)
            for j in np.flatnonzero(may[i] & (differ <= most)):
                r, q = root(int(x["root"][i])), root(int(y["root"][j]))
                if r == q:
                    continue
                both = len(np.intersect1d(x_sets[i], y_sets[j], assume_unique=True))
                if 100 * both >= percent * (len(x_sets[i]) + len(y_sets[j]) - both):
                    joined[r] = q
                    yield int(x["node"][i]), int(y["node"][j])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                found = [p for row in batch.slice(k, 1).to_pylist() for p in links(row)]
                if found:
                    a, b = zip(*found, strict=True)
                    yield rows_to_table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work.mapInArrow(run, "a long, b long")


def _within_clusters(nodes: DataFrame, sets: DataFrame, percent: int, width: int) -> DataFrame:
    """Links among unsettled nodes (``node, root, n_shingles, bits``), cluster by cluster."""
    sets = materialize(only_wanted(sets, nodes, "node"), "sets")
    rare = materialize(rare_shingles(sets, percent), "rare")
    first = rare.groupBy("bucket").agg(F.min("node").alias("b"))
    together = rare.join(first, "bucket").select(F.col("node").alias("a"), "b").filter("a != b").distinct()
    clusters = components(together).withColumnRenamed("root", "cluster")
    members = nodes.join(clusters, "node").select("cluster", "root", "node", "n_shingles", "bits")
    ranked = with_rank(materialize(members, "clustered"), ["cluster", "root", "node"], "_rank")
    placed = materialize(ranked.withColumn("block", F.floor((F.col("_rank") - 1) / BLOCK)), "placed")
    # Blocks of a cluster follow each other, so a cluster's pairs of blocks are those of a range.
    spans = placed.groupBy("cluster").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    left = spans.select("high", F.explode(F.sequence("low", "high")).alias("bx"))
    pairs = left.select("bx", F.explode(F.sequence("bx", "high")).alias("by")).distinct()
    settled = placed.groupBy("block").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
    for side in ("bx", "by"):
        one = settled.select(F.col("block").alias(side), F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias(f"_{side}"))
        pairs = pairs.join(one, side)
    pairs = pairs.filter(F.coalesce(F.col("_bx") != F.col("_by"), F.lit(True))).select("bx", "by")
    item = F.struct("node", "root", "cluster", "n_shingles", "bits", "members")
    blocks = placed.join(sets, "node").groupBy("block").agg(F.collect_list(item).alias("items"))
    blocks = materialize(blocks, "blocks")
    work = pairs.join(blocks.select(F.col("block").alias("bx"), F.col("items").alias("x")), "bx")
    work = work.join(blocks.select(F.col("block").alias("by"), F.col("items").alias("y")), "by")
    return _compare_blocks(work, percent, width)


def internal_id(doc_id: str, text: str) -> Column:
    """The id; for a null one, a hash of the text above all ids."""
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(F.lit(NO_ID - 1)) + F.lit(NO_ID)
    return F.coalesce(F.col(doc_id).cast("long"), hashed)


def near_duplicate_roots(named: DataFrame, size: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``_id, doc_id, n_shingles, _root`` per row of ``_id, doc_id, _text``; ``_root`` is the least ``_id``
    reachable.
    """
    sketched = materialize(sketch(named, size, bands, rows), "sketch")
    filled = sketched.filter("n_shingles > 0")
    firsts = [F.first(c).alias(c) for c in ("n_shingles", "signature", "bits")]
    nodes = materialize(filled.groupBy("hi", "lo").agg(F.min("_id").alias("node"), *firsts), "nodes")
    bucketed = bucket_rows(nodes, bands, rows)
    shared = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    placed = materialize(bucketed.join(shared, "bucket").distinct(), "buckets")
    degrees = placed.groupBy("node").agg(F.sum("_n").alias("degree"))
    candidates = materialize(
        nodes.select("node", "n_shingles", "bits").join(degrees, "node").dropDuplicates(["node"]), "candidates"
    )
    members = materialize(placed.select("bucket", "node").join(candidates, "node"), "members")
    wanted = candidates.select(F.col("node").alias("_id"))
    sets = materialize(shingle_sets(only_wanted(named, wanted, "_id").dropDuplicates(["_id"]), size), "sets")

    leaders = materialize(_leaders(members), "leaders")
    facing = members.join(
        leaders,
        (members["bucket"] == leaders["bucket"]) & (F.col("node") != F.col("leader")) & _plausible(bands * rows, percent),
    )
    pairs = facing.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    found = materialize(_linked(pairs, sets, percent), "links")
    roots = components(found)
    rest = members.join(leaders.select("bucket", F.col("leader").alias("node")), ["bucket", "node"], "left_anti")
    marked = rest.select("bucket", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = marked.groupBy("bucket").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
    mixed = mixed.filter("_low != _high").select("bucket")
    unsettled = marked.join(mixed, "bucket", "left_semi").select("node", "root").distinct().join(
        candidates.drop("degree"), "node"
    )
    unsettled, number = stored_with(unsettled, "unsettled", {"rows": F.count(F.lit(1))})
    if number["rows"]:
        more = _within_clusters(unsettled, sets, percent, bands * rows)
        roots = components(more.unionByName(roots.toDF("a", "b")))

    rooted = nodes.join(roots, "node", "left").select("hi", "lo", F.coalesce("root", "node").alias("_root"))
    labelled = sketched.join(rooted, ["hi", "lo"], "left")
    return labelled.select("_id", "doc_id", "n_shingles", F.coalesce("_root", "_id").alias("_root"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    bands: int = 64,
    rows: int = 8,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents are linked whose sets of ``size``-word shingles have a similarity of ``percent`` or more;
    ``component_id`` is the smallest id reachable, and ``kept`` marks its document.
    """
    named = docs.select(
        internal_id(doc_id, text).alias("_id"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text")
    )
    found = settled(lambda: near_duplicate_roots(named, size, percent, bands, rows), "near-duplicates")
    component = F.when(F.col("_root") < NO_ID, F.col("_root"))
    result = found.select(F.col("doc_id").alias(doc_id), "n_shingles", component.alias("component_id"))
    return result.withColumn("kept", F.col(doc_id).eqNullSafe(F.col("component_id")))


def without_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, bands: int = 64, rows: int = 8
) -> DataFrame:
    """The rows of one document of each group: the one with the smallest id, once if its row repeats."""
    wide, names = hidden(docs)
    wide = wide.withColumn("_id", internal_id(names[doc_id], names[text]))
    named = wide.select("_id", F.col(names[doc_id]).cast("long").alias("doc_id"), F.col(names[text]).alias("_text"))
    found = settled(lambda: near_duplicate_roots(named, size, percent, bands, rows), "near-duplicates")
    # Most rows are the only ones of their id and stay: they are not shuffled.
    counted = found.groupBy("_id").agg((F.min("_root") != F.col("_id")).alias("_goes"), F.count(F.lit(1)).alias("_n"))
    touched = materialize(counted.filter("_goes OR _n > 1").select("_id", "_goes"), "touched")
    flagged = with_maybe(wide, touched.select("_id"), "_id", "_maybe")
    clear, maybe = flagged.filter("NOT _maybe").drop("_maybe"), flagged.filter("_maybe").drop("_maybe")
    once = maybe.join(touched, "_id", "left_anti")
    first = maybe.join(touched.filter("NOT _goes"), "_id", "left_semi").dropDuplicates(["_id"])
    return restored(clear.unionByName(once).unionByName(first), names)


@query(
    "op7_minhash_near_dedup",
    r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 1 THEN ws ELSE list_transform(range(1, len(ws)),
    lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), sizes AS (SELECT sh, count(*) AS df FROM s GROUP BY 1
), ranked AS (
  SELECT doc_id, sh, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, sh) AS place
  FROM s JOIN n USING (doc_id) JOIN sizes USING (sh)
), prefix AS (SELECT * FROM ranked WHERE place <= n - ceil(0.8 * n) + 1
), cand AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM prefix x JOIN prefix y
  ON x.sh = y.sh AND x.doc_id < y.doc_id AND 10 * least(x.n, y.n) >= 8 * greatest(x.n, y.n)
), both_sets AS (
  SELECT a, b, count(*) AS i FROM cand JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND x.sh = y.sh GROUP BY 1, 2
), links AS (
  SELECT a, b FROM both_sets JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
), e AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM w UNION SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.node
), c AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.node = w.doc_id
""",
)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), size=2)
