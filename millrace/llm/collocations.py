"""Phrase collocations by prefix-free parsing: phrases are counted in distinct chunks, by their weight.

A text is a sequence of words with a barrier at each sign that ends a piece. Wherever the hash of
``longest - 1`` tokens is divisible by ``modulus``, a chunk ends behind these tokens and the next begins with
them: cuts depend on content alone, so a passage that recurs gives the same chunks. Distinct chunks form a
dictionary with their frequencies. A phrase belongs to the chunk in which it begins before the last
``longest - 1`` tokens; there it lies whole, and in the next chunk it is not counted again.

A phrase is frequent only if its words and pairs of neighbours are. Blocks of chunks send short hashes
of these with their counts to slots, which tell each block which of its own may be frequent (unequal
words of one hash only keep more); then the same for longer phrases made of such pairs. At last the blocks
count what is left by its words, so counts are exact.
Slots grow with the number of words; a block gets back only what it holds; nothing is broadcast.

Null texts are empty, a null language is ``und``. Repeated rows count each. Empty texts and tables give no
phrases. Very long texts are chunks like others. Only the stated columns are read, whatever others are called.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import WordHash, mix, query, rows_to_table, stored_with, table, texts
from millrace.session import materialize

BARRIER, CHUNK_END = b",", b"\n"  # neither is part of a word
BARRIERS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BARRIER * 10)
BLOCK_BYTES = 4 << 20  # of chunks in a block
SLOT_WORDS = 2 << 20  # of the dictionary, for each slot
LOW_BITS = 22  # of short hashes, looked at before these are searched for
DICTIONARY = "lang string, chunk binary, words long, copies long"
BLOCKS = "block string, words long, langs array<string>, lang_words array<bigint>, chunk_langs binary, chunks binary, copies binary"


def parse(raw: bytes, hashes: WordHash, overlap: int, modulus: int) -> list[tuple[bytes, int]]:
    """The chunks of a text, each with the number of words before its overlap."""
    tokens = raw.lower().translate(BARRIERS).replace(BARRIER, b" , ").split()
    if not tokens:
        return []
    tokens += [BARRIER] * overlap
    ids = hashes.of(tokens)
    count = len(tokens) - overlap
    mixed = ids[:count]
    for k in range(1, overlap):
        mixed = mix(mixed, ids[k : count + k])
    cuts = np.flatnonzero(mixed % np.uint64(modulus) == 0)
    cuts = [0, *cuts[cuts > 0].tolist(), count]
    words = np.concatenate([[0], np.cumsum(ids != hashes[BARRIER])])
    return [
        (b" ".join(tokens[low : high + overlap]), int(words[high] - words[low]))
        for low, high in zip(cuts, cuts[1:], strict=False)
    ]


def chunk_dictionary(docs: DataFrame, lang: str, text: str, overlap: int, modulus: int) -> DataFrame:
    """Distinct chunks per language with their frequency ``copies``."""

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            found: Counter = Counter()
            for name, raw in zip(batch.column("lang").to_pylist(), texts(batch.column("_text")), strict=True):
                for chunk in parse(raw, hashes, overlap, modulus):
                    found[name, chunk] += 1
            if found:
                names, chunks = zip(*found, strict=True)
                yield rows_to_table(
                    {
                        "lang": pa.array(names, pa.string()),
                        "chunk": pa.array([c[0] for c in chunks], pa.binary()),
                        "words": pa.array([c[1] for c in chunks], pa.int64()),
                        "copies": pa.array(list(found.values()), pa.int64()),
                    }
                )

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("_text"))
    parsed = rows.mapInArrow(run, DICTIONARY)
    return parsed.groupBy("lang", "chunk", "words").agg(F.sum("copies").alias("copies"))


def in_blocks(dictionary: DataFrame) -> DataFrame:
    """The dictionary in rows of some ``BLOCK_BYTES``, whatever the languages of their chunks.

    ``words`` counts those of the distinct chunks, ``lang_words`` all words by language.
    """

    def block(rows):
        names, chunks, words, copies = zip(*rows, strict=True)
        langs = sorted(set(names))
        code = {name: i for i, name in enumerate(langs)}
        total = [0] * len(langs)
        for name, number, times in zip(names, words, copies, strict=True):
            total[code[name]] += number * times
        return rows_to_table(
            {
                "block": pa.array([uuid.uuid4().hex]),
                "words": pa.array([sum(words)], pa.int64()),
                "langs": pa.array([langs], pa.list_(pa.string())),
                "lang_words": pa.array([total], pa.list_(pa.int64())),
                "chunk_langs": pa.array([np.array([code[x] for x in names], np.int32).tobytes()], pa.binary()),
                "chunks": pa.array([b" \n ".join(chunks)], pa.binary()),
                "copies": pa.array([np.array(copies, np.int64).tobytes()], pa.binary()),
            }
        )

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("lang", "chunk", "words", "copies")), strict=True):
                rows.append(row)
                held += len(row[1])
                if held >= BLOCK_BYTES:
                    yield block(rows)
                    rows, held = [], 0
        if rows:
            yield block(rows)

    return dictionary.mapInArrow(run, BLOCKS)


def each_row(batches):
    """One row after the other: a batch may hold many blocks."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


class Block:
    """A block's tokens as numbers: what begins where, in which language, how often."""

    def __init__(self, row: dict, overlap: int):
        self.raw = row["chunks"]
        coded = self._tokens().dictionary_encode()
        self.vocabulary = coded.dictionary
        self.langs = row["langs"]
        self.words = coded.indices.to_numpy().astype(np.int64)
        self.size = len(self.vocabulary)
        end = self.words == self._number(CHUNK_END)
        wall = end | (self.words == self._number(BARRIER))
        ends = np.append(np.flatnonzero(end), len(end))
        chunk = np.cumsum(end)
        self.lang = np.frombuffer(row["chunk_langs"], np.int32).astype(np.int64)[chunk]
        self.weight = np.frombuffer(row["copies"], np.int64)[chunk]
        self.own = ~wall & (np.arange(len(end)) < (ends - overlap)[chunk])
        self.wall = wall

    def _tokens(self) -> pa.Array:
        """The tokens between single blanks; ``begins`` and ``finishes`` tell where each lies in the block."""
        data = np.frombuffer(self.raw, np.uint8)
        blanks = np.flatnonzero(data == ord(" "))
        self.begins, self.finishes = np.append(0, blanks + 1), np.append(blanks, len(data))
        offsets = np.append(0, np.cumsum(self.finishes - self.begins))
        held = [None, pa.py_buffer(offsets), pa.py_buffer(data[data != ord(" ")])]
        return pa.Array.from_buffers(pa.large_binary(), len(self.begins), held)

    def _number(self, token: bytes) -> int:
        return pc.index(self.vocabulary, pa.scalar(token, pa.large_binary())).as_py()

    def phrases(self, first: np.ndarray, size: np.ndarray) -> list[bytes]:
        """The phrases of so many words that begin at these tokens."""
        ends = self.finishes[first + size - 1]
        return [self.raw[a:b] for a, b in zip(self.begins[first].tolist(), ends.tolist(), strict=True)]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words and of the pairs that begin at each token, apart by language."""
        word = np.array([xxhash.xxh3_64_intdigest(w) for w in self.vocabulary.to_numpy(zero_copy_only=False)], np.uint64)[self.words]
        name = np.array([xxhash.xxh3_64_intdigest(x.encode(), 1) for x in self.langs], np.uint64)
        one = mix(name[self.lang], word)
        return one, np.append(mix(one[:-1], word[1:]), np.uint64(0))

    def pairs(self) -> np.ndarray:
        """True where a pair of neighbours begins, whether this chunk counts it or the next."""
        return ~self.wall & ~np.append(self.wall[1:], True)

    def longer(self, two: np.ndarray, pair: np.ndarray, longest: int):
        """``size, places, hashes`` of the longer phrases that this chunk counts and that consist of the marked pairs."""
        places = np.flatnonzero(pair & self.own)
        mixed = two[places]
        for size in range(3, longest + 1):
            goes_on = pair[places + size - 2]
            places = places[goes_on]
            mixed = mix(mixed[goes_on], two[places + size - 2])
            yield size, places, mixed


def _among(keys: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """True for the hashes whose short form is among the sorted keys."""
    if not len(keys):
        return np.zeros(len(hashes), bool)
    wanted = hashes >> np.uint64(32 - bits)
    held = np.zeros(1 << LOW_BITS, bool)  # most of the others end in bits of none
    held[keys & np.uint64(len(held) - 1)] = True
    near = np.flatnonzero(held[wanted & np.uint64(len(held) - 1)])
    found = np.zeros(len(wanted), bool)
    found[near] = keys[np.minimum(np.searchsorted(keys, wanted[near]), len(keys) - 1)] == wanted[near]
    return found


def _keys(row: dict, name: str) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(row[name] or ()), np.uint64))


def _marked(block: Block, one: np.ndarray, two: np.ndarray, keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that may be frequent, and where a pair begins that may be."""
    places = np.flatnonzero(block.own)
    pair = block.pairs()
    pair[pair] = _among(keys, two[pair], bits)
    return places[_among(keys, one[places], bits)], pair


def screened(blocks: DataFrame, overlap: int, bits: int, least: int, longest: int, name: str) -> DataFrame:
    """``block`` and, as ``name``, the short hashes of those of its phrases that may be frequent.

    Words and pairs at first; for blocks that have the column ``keys`` of these, the longer phrases made of
    such pairs. A short hash is the first ``32 + bits`` bits; the first ``bits`` of them choose the slot.
    """
    short = np.uint64(32 - bits)
    kind = np.uint8 if least < 1 << 8 else np.uint32  # a count goes no higher than the least that suffices
    further = "keys" in blocks.columns

    def phrases(row):
        block = Block(row, overlap)
        one, two = block.hashes()
        if further:
            _, pair = _marked(block, one, two, _keys(row, "keys"), bits)
            found = [(mixed, block.weight[places]) for _, places, mixed in block.longer(two, pair, longest)]
        else:
            pairs = block.pairs()
            found = [(one[block.own], block.weight[block.own]), (two[pairs], (block.weight * block.own)[pairs])]
        return (np.concatenate([x[i] for x in found]) for i in (0, 1))

    def send(batches):
        for row in each_row(batches):
            hashes, weights = phrases(row)
            keys, place = np.unique(hashes >> short, return_inverse=True)
            counts = np.minimum(np.bincount(place, weights, len(keys)), least).astype(kind)
            bounds = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
            low = keys.astype(np.uint32)
            filled = [(s, a, b) for s, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if b > a]
            yield rows_to_table(
                {
                    "slot": pa.array([s for s, _, _ in filled], pa.int64()),
                    "block": pa.array([row["block"]] * len(filled), pa.string()),
                    "hashes": pa.array([low[a:b].tobytes() for _, a, b in filled], pa.binary()),
                    "counts": pa.array([counts[a:b].tobytes() for _, a, b in filled], pa.binary()),
                }
            )

    def answer(rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint32) for x in rows.column("hashes").to_pylist()]
        hashes = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(x, kind) for x in rows.column("counts").to_pylist()])
        keys, place = np.unique(hashes, return_inverse=True)
        enough = np.bincount(place, counts, len(keys)) >= least
        slot = np.uint64(rows.column("slot")[0].as_py() << 32)
        kept = np.split(enough[place], np.cumsum([len(p) for p in parts])[:-1])
        sent = [(slot | p[keep].astype(np.uint64)).tobytes() for p, keep in zip(parts, kept, strict=True)]
        return pa.table({"block": rows.column("block"), "keys": pa.array(sent, pa.binary())})

    hashed = blocks.mapInArrow(send, "slot long, block string, hashes binary, counts binary")
    answers = hashed.groupBy("slot").applyInArrow(answer, "block string, keys binary")
    return answers.filter(F.octet_length("keys") > 0).groupBy("block").agg(F.collect_list("keys").alias(name))


def _phrases(block: Block, row: dict, bits: int, longest: int):
    """``size, first token, hash, weight`` arrays of the block's distinct phrases that may be frequent."""
    one, two = block.hashes()
    words, pair = _marked(block, one, two, _keys(row, "keys"), bits)
    more = _keys(row, "more")
    code = block.words + block.lang * block.size

    def counted(size, places, hashes):
        found, first, number = np.unique(code[places], return_index=True, return_inverse=True)
        weight = np.bincount(number, block.weight[places], len(found)).astype(np.int64)
        if size > 1:
            code[places] = number  # dense again, so that the next product fits
        return size, places[first], hashes[first], weight

    yield counted(1, words, one[words])
    places = np.flatnonzero(pair & block.own)
    if longest > 1:
        code[places] = code[places] * block.size + block.words[places + 1]
        yield counted(2, places, two[places])
    # A phrase that is not frequent begins none that is, so its place is left out for good.
    open_ = np.zeros(len(pair), bool)
    open_[places] = True
    for size, places, mixed in block.longer(two, pair, longest):
        keep = open_[places] & _among(more, mixed, bits)
        open_[:] = False
        open_[places[keep]] = True
        places = places[keep]
        code[places] = code[places] * block.size + block.words[places + size - 1]
        yield counted(size, places, mixed[keep])


def phrase_counts(blocks: DataFrame, overlap: int, bits: int, longest: int, least: int) -> DataFrame:
    """``lang, phrase, size, f`` of the frequent phrases, among those that the columns ``keys`` and ``more`` leave.

    Each block sends its distinct phrases with their counts to slots by hash, as lists; a slot adds them up.
    """

    def send(batches):
        for row in each_row(batches):
            block = Block(row, overlap)
            found = list(_phrases(block, row, bits, longest))
            size = np.concatenate([np.full(len(first), k) for k, first, _, _ in found])
            first, mixed, weight = (np.concatenate([x[i] for x in found]) for i in (1, 2, 3))
            slot = (mixed >> np.uint64(32 - bits) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            bounds = np.searchsorted(slot[order], np.arange((1 << bits) + 1))
            for number, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                if b > a:
                    at = order[a:b]
                    phrases = block.phrases(first[at], size[at])
                    yield rows_to_table(
                        {
                            "slot": pa.array([number], pa.int64()),
                            "langs": pa.array([block.langs], pa.list_(pa.string())),
                            "codes": pa.array([block.lang[first[at]].astype(np.int32).tobytes()], pa.binary()),
                            "phrases": pa.array([b"\n".join(phrases)], pa.binary()),
                            "counts": pa.array([weight[at].tobytes()], pa.binary()),
                        }
                    )

    def add_up(rows: pa.Table) -> pa.Table:
        total: Counter = Counter()
        for row in rows.to_batches():
            for k in range(row.num_rows):
                part = row.slice(k, 1).to_pylist()[0]
                langs = [part["langs"][i] for i in np.frombuffer(part["codes"], np.int32).tolist()]
                counts = np.frombuffer(part["counts"], np.int64).tolist()
                for lang, phrase, count in zip(langs, part["phrases"].split(b"\n"), counts, strict=True):
                    total[lang, phrase] += count
        kept = [(lang, phrase, n) for (lang, phrase), n in total.items() if n >= least]
        return pa.table(
            {
                "lang": pa.array([x[0] for x in kept], pa.string()),
                "phrase": pa.array([x[1] for x in kept], pa.binary()).cast(pa.string()),
                "size": pa.array([x[1].count(b" ") + 1 for x in kept], pa.int32()),
                "f": pa.array([x[2] for x in kept], pa.int64()),
            }
        )

    sent = blocks.mapInArrow(send, "slot long, langs array<string>, codes binary, phrases binary, counts binary")
    return sent.groupBy("slot").applyInArrow(add_up, "lang string, phrase string, size int, f long")


def frequent_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 5, least: int = 100, modulus: int = 32
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, f`` of all phrases of up to ``longest`` words that occur ``least`` times or more
    in their language, and ``lang, n``, the number of all words.
    """
    overlap = max(1, longest - 1)
    dictionary = chunk_dictionary(docs, lang, text, overlap, modulus)
    blocks, known = stored_with(in_blocks(dictionary), "blocks", {"words": F.coalesce(F.sum("words"), F.lit(0))})
    bits = min(31, max(0, int(known["words"] // SLOT_WORDS).bit_length()))
    by_lang = blocks.select(F.inline(F.arrays_zip("langs", "lang_words"))).toDF("lang", "n")
    totals = materialize(by_lang.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    blocks = blocks.drop("words", "lang_words")
    keys = materialize(screened(blocks, overlap, bits, least, longest, "keys"), "keys")
    blocks = blocks.join(keys, "block")
    if longest > 2:
        more = materialize(screened(blocks, overlap, bits, least, longest, "more"), "keys")
        blocks = blocks.join(more, "block", "left")
    else:
        blocks = blocks.withColumn("more", F.lit(None).cast("array<binary>"))
    return materialize(phrase_counts(blocks, overlap, bits, longest, least), "phrases"), totals


def _part(start, size):
    return F.array_join(F.slice("_words", start, size), " ")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    longest: int = 5,
    least: int = 100,
    top: int = 2000,
    absorbed: int = 100,
    modulus: int = 32,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of each language.

    ``score`` is ``floor(1000 * a * n / (l * r))`` at the cut where it is lowest. A phrase goes if a longer
    one around it reaches ``absorbed`` percent of its count.
    """
    phrases, totals = frequent_phrases(docs, lang, text, longest, least, modulus)
    listed = phrases.filter("size > 1").withColumn("_words", F.split("phrase", " "))
    inner_size = F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    inner = listed.filter("size > 2").select("lang", "size", "_words", "f", inner_size.alias("_k"))
    inner = inner.withColumn("_at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("_k") + 1)))
    around = inner.groupBy("lang", _part(F.col("_at"), F.col("_k")).alias("phrase")).agg(F.max("f").alias("_around"))
    lost = F.coalesce(100 * F.col("_around").cast("decimal(38,0)") >= absorbed * F.col("f").cast("decimal(38,0)"), F.lit(False))
    left = listed.join(around, ["lang", "phrase"], "left").filter(~lost)

    cuts = left.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "_k", _part(F.lit(1), F.col("_k")).alias("_first"),
        _part(F.col("_k") + 1, F.col("size") - F.col("_k")).alias("_rest"),
    )
    counts = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(counts.toDF("lang", "_first", "l"), ["lang", "_first"]).join(counts.toDF("lang", "_rest", "r"), ["lang", "_rest"])
    wide = [f"CAST({x} AS DECIMAL(18,0))" for x in ("a", "n", "l", "r")]
    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * {} * {}) div ({} * {})".format(*wide))
    scored = cuts.join(totals, "lang").withColumn("score", score)
    lowest = F.min(F.struct("score", "_k", "l", "r")).alias("_low")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(lowest)
    order = Window.partitionBy("lang").orderBy(F.desc("_low.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "_low.l", "_low.r", "n", "_low.score")


@query(
    "op11_phrase_collocations",
    r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), p AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM d
), n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY 1
), spots AS (
  SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p CROSS JOIN (SELECT unnest(range(1, 6)) AS k)
  WHERE len(ws) >= k
), g AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM spots
  GROUP BY ALL HAVING count(*) >= 100
), c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE k >= 2
), inner_spots AS (
  SELECT lang, ws, a, m, unnest(range(1, k - m + 2)) AS i FROM c CROSS JOIN (SELECT unnest(range(2, 5)) AS m) WHERE m < k
), around AS (
  SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(a) AS most FROM inner_spots GROUP BY ALL
), kept AS (
  SELECT c.* FROM c LEFT JOIN around USING (lang, phrase) WHERE most IS NULL OR most < a
), cuts AS (SELECT lang, phrase, a, k, ws, unnest(range(1, k)) AS cut FROM kept
), scored AS (
  SELECT s.lang, s.phrase, a, cut, x.f AS l, y.f AS r, n.n,
    CAST((CAST(1000 AS HUGEINT) * a * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts s JOIN g x ON x.lang = s.lang AND x.phrase = array_to_string(ws[1 : cut], ' ')
  JOIN g y ON y.lang = s.lang AND y.phrase = array_to_string(ws[cut + 1 : s.k], ' ') JOIN n ON n.lang = s.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
""",
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))
