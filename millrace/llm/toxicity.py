"""Toxicity with noisy-channel deobfuscation.

A word that shows leetspeak, inserted signs, letter repetition, or letters set apart by blanks is a
lattice: each character may stand for letters, be a separator, or repeat the one before. A character
trigram model of ordinary words gives the most probable reading by Viterbi decoding. Restored words,
and the words as they are, are scored by character n-grams that set toxic texts apart; a document's
score is a logistic function of its strongest words and its length.

All models are fitted here, on all labelled rows: n-grams on one half, the logistic function on the
other. Every word of every text is scored.

Null and empty texts have no word and get the score of no evidence. Rows without a label, or with a
null id, are not learned from; with no labelled row at all the score is 0. Several labels of one id
count as the largest. Repeated rows are scored alike. Tokens longer than ``PIECE`` characters are
decoded in pieces.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fold, query, rows_to_table, share_below, table, texts
from millrace.operators.joins import with_maybe
from millrace.session import materialize

# What a sign may stand for in leetspeak.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "+": "t", "|": "il", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = set(".-_*~'`^·,/\\")
PIECE = 48
SWAP, DROP, REPEAT = -1.0, -0.7, -0.4  # log probabilities of the channel's steps

BEFORE = re.compile(r"^[^\w@$!+|(€£]+")
AFTER = re.compile(r"(?:([^\w])\1\1+|[.,;:?\"'()\[\]{}<>…%#&*=~`^/\\-])+$")
SPACED = re.compile(rb"(?<!\S)\S(?:[ \t]\S){3,}(?!\S)")
RUN = re.compile(r"(.)\1\1")
NGRAMS = range(4, 7)
CACHE_WORDS = 300_000


@dataclass
class CharModel:
    """Trigram model of lower-case words, interpolated with bigrams and single characters."""

    counts: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.pairs: Counter = Counter()
        self.contexts: Counter = Counter()
        self.single: Counter = Counter()
        for gram, n in self.counts.items():
            self.contexts[gram[:2]] += n
            self.pairs[gram[1:]] += n
            self.single[gram[2]] += n
        self.before: Counter = Counter()
        for gram, n in self.pairs.items():
            self.before[gram[0]] += n
        self.total = sum(self.single.values()) + 1
        self.cache: dict[str, float] = {}

    def log(self, context: str, char: str) -> float:
        gram = context + char
        if gram not in self.cache:
            p = (self.single[char] + 0.1) / (self.total + 10)
            p = (self.pairs[gram[1:]] + 2 * p) / (self.before[context[1]] + 2)
            p = (self.counts.get(gram, 0) + 2 * p) / (self.contexts[context] + 2)
            self.cache[gram] = math.log(p)
        return self.cache[gram]


def readings(text: str, k: int) -> list[tuple[str, float]]:
    """What the character at ``k`` may stand for, with log probabilities; empty: nothing."""
    char = text[k]
    found = []
    if char.isalpha():
        found.append((char, 0.0))
    for letter in LEET.get(char, ""):
        found.append((letter, SWAP))
    if k and (text[k - 1] == char or char in LEET and text[k - 1] in LEET[char]):
        found.append(("", REPEAT))
    elif char in SEPARATORS or not char.isalpha():
        found.append(("", DROP if char in SEPARATORS else 4 * DROP))
    return found


def restore(text: str, model: CharModel) -> str:
    """The most probable word behind a written form, by Viterbi decoding of its lattice."""
    best: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
    for k in range(len(text)):
        after: dict[str, tuple[float, str]] = {}
        for letter, channel in readings(text, k):
            for context, (score, word) in best.items():
                if letter:
                    state, total, longer = context[1] + letter, score + channel + model.log(context, letter), word + letter
                else:
                    state, total, longer = context, score + channel, word
                if state not in after or total > after[state][0]:
                    after[state] = (total, longer)
        best = after or best
    return max((score + model.log(context, "$"), word) for context, (score, word) in best.items())[1]


def core(word: bytes) -> str:
    """A word in lower case without the signs around it."""
    return AFTER.sub("", BEFORE.sub("", word.decode("utf-8", "replace").lower()))


class Cores(dict):
    """The core of each word of a batch."""

    def __missing__(self, word: bytes) -> str:
        value = self[word] = core(word)
        return value


def obfuscated(text: str) -> bool:
    if text.isalpha():
        return RUN.search(text) is not None
    return any(c.isalpha() for c in text) and any(c in LEET or c in SEPARATORS for c in text)


def decoded(text: str, model: CharModel) -> str:
    return "".join(restore(text[k : k + PIECE], model) for k in range(0, len(text), PIECE))


def grams(word: str) -> set[str]:
    marked = f"^{word}$"
    return {marked[i : i + n] for n in NGRAMS for i in range(len(marked) - n + 1)} | {marked}


@dataclass
class Model:
    """Character model, weights of n-grams, and the logistic function on top."""

    chars: dict[str, int]
    weights: dict[str, float]
    logistic: list[float]


class WordScores(dict):
    """The strongest n-gram of each word, restored where it looks obfuscated."""

    def __init__(self, model: Model):
        super().__init__()
        self.chars = CharModel(model.chars)
        self.weights = model.weights
        self.old: dict[bytes, float] = {}

    def of(self, text: str) -> float:
        best = self.form(text)
        return max(best, self.form(decoded(text, self.chars))) if obfuscated(text) else best

    def form(self, text: str) -> float:
        marked, weights = f"^{text}$", self.weights
        best = weights.get(marked, 0.0)
        for n in NGRAMS:
            for i in range(len(marked) - n + 1):
                gram = marked[i : i + n]
                if gram in weights and weights[gram] > best:
                    best = weights[gram]
        return best

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE_WORDS:
            # The words become the old generation; those that are met again come back from it.
            self.old = dict(self)
            self.clear()
        value = self.old.get(word)
        if value is None:
            value = self.of(core(word))
        self[word] = value
        return value

    def evidence(self, raw: bytes) -> list[float]:
        """The three strongest words, and the logarithm of the number of words."""
        words = raw.split()
        found = list(map(self.__getitem__, words))
        for apart in SPACED.findall(raw):
            found.append(self.of("".join(apart.decode("utf-8", "replace").lower().split())))
        top = sorted(found, reverse=True)[:3] if len(found) < 64 else np.partition(found, -3)[-3:][::-1].tolist()
        return [*top, *[0.0] * (3 - len(top)), math.log1p(len(words))]


def _probability(rows: np.ndarray, logistic: list[float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(rows @ np.array(logistic[1:]) + logistic[0], -30, 30)))


def _evidence(docs: DataFrame, model: Model, keep: list[str], text: str) -> DataFrame:
    kinds = dict(docs.dtypes)
    shape = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches):
        scores = WordScores(model)
        for batch in batches:
            rows = np.array([scores.evidence(raw) for raw in texts(batch.column("_text"))]).reshape(-1, 4)
            out = {n: batch.column(n) for n in keep}
            out |= {f"x{i}": rows[:, i] for i in range(4)} | {"score": _probability(rows, model.logistic)}
            yield rows_to_table(out)

    return shape.mapInArrow(run, ", ".join([*[f"`{n}` {kinds[n]}" for n in keep], *[f"x{i} double" for i in range(4)], "score double"]))


def _word_counts(sample: DataFrame) -> DataFrame:
    """``word, toxic, n``: texts of each label that hold a word."""

    def run(batches):
        for batch in batches:
            counts, cores = (Counter(), Counter()), Cores()
            for raw, toxic in zip(texts(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
                counts[bool(toxic)].update({cores[w] for w in set(raw.split())} - {""})
            for toxic, words in enumerate(counts):
                yield rows_to_table({"word": pa.array(list(words), pa.string()), "toxic": pa.array([toxic] * len(words), pa.int32()), "n": pa.array(list(words.values()), pa.int64())})

    found = sample.mapInArrow(run, "word string, toxic int, n long")
    return found.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
    )


def _gram_counts(words: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            bad, good = Counter(), Counter()
            for word, b, g in zip(*[batch.column(n).to_pylist() for n in ("word", "bad", "good")], strict=True):
                for gram in grams(word[:PIECE]):
                    bad[gram] += b
                    good[gram] += g
            keys = list(bad)
            yield rows_to_table({"gram": pa.array(keys, pa.string()), "bad": pa.array([bad[k] for k in keys], pa.int64()), "good": pa.array([good[k] for k in keys], pa.int64())})

    return words.mapInArrow(run, "gram string, bad long, good long").groupBy("gram").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )


def _char_counts(words: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            counts = Counter()
            for word, b, g in zip(*[batch.column(n).to_pylist() for n in ("word", "bad", "good")], strict=True):
                if word.isalpha():
                    marked = f"^^{word[:PIECE]}$"
                    for i in range(len(marked) - 2):
                        counts[marked[i : i + 3]] += b + g
            yield rows_to_table({"gram": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    return words.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _newton_sums(rows: DataFrame, w: np.ndarray) -> np.ndarray:
    """Hessian (first columns) and gradient (last one) of the log-likelihood: a few numbers from each task."""

    def run(batches):
        total = np.zeros((len(w), len(w) + 1))
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), *[batch.column(f"x{i}").to_numpy() for i in range(len(w) - 1)]])
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            total[:, :-1] += (x * (p * (1 - p))[:, None]).T @ x
            total[:, -1] += x.T @ (batch.column("toxic").to_numpy() - p)
        yield rows_to_table({"sums": pa.array([total.ravel().tolist()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "sums array<double>").collect()
    return np.sum([r["sums"] for r in parts], axis=0).reshape(len(w), -1)


def _logistic(rows: DataFrame) -> list[float]:
    """Newton iterations of a lightly penalised logistic regression; every iteration is a pass over all rows."""
    w = np.zeros(5)
    penalty = np.diag([0.0, *[0.1] * 4]) + 1e-6 * np.eye(5)
    for _ in range(30):
        sums = _newton_sums(rows, w)
        step = np.linalg.solve(sums[:, :-1] + penalty, sums[:, -1] - penalty @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_grams: int = 20_000,
    max_chars: int = 100_000,
) -> Model:
    """Learn from all labelled rows. What reaches the driver is bounded by the two maxima, the model's size."""
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    if known.isEmpty():
        return Model({}, {}, [-30.0, 0, 0, 0, 0])
    known = materialize(known, "labels")
    first = share_below("_id", 12, 0.5)

    def maybe_labelled(own: Column) -> DataFrame:
        rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).filter(own)
        if rows.schema["_id"].dataType != known.schema["_id"].dataType:
            return rows  # Hashes of equal keys differ between types.
        return with_maybe(rows, known.filter(own).select("_id"), "_id", "_maybe").filter("_maybe").drop("_maybe")

    def labelled(rows: DataFrame, own: Column) -> DataFrame:
        # Labels grow with the texts, so they are not broadcast.
        return rows.join(known.filter(own).hint("merge"), "_id")

    half = labelled(maybe_labelled(first), first)
    words = materialize(_word_counts(half.select("text", "toxic")), "words")
    seen = {r["toxic"]: r["count"] for r in half.groupBy("toxic").count().collect()}
    odds = math.log((seen.get(1, 0) + 1) / (seen.get(0, 0) + 1))
    weight = F.log((F.col("bad") + 0.3) / (F.col("good") + 0.3)) - odds
    strong = _gram_counts(words).filter("bad >= 4").withColumn("weight", weight).filter("weight > 1")
    kept = strong.orderBy(F.desc("weight"), F.desc("bad"), "gram").limit(max_grams).collect()
    chars = _char_counts(words).orderBy(F.desc("n"), "gram").limit(max_chars).collect()
    model = Model({r["gram"]: r["n"] for r in chars}, {r["gram"]: r["weight"] for r in kept}, [0.0] * 5)
    # Texts of the other half stay where they are: their evidence meets the labels.
    evidence = _evidence(maybe_labelled(~first), model, ["_id"], "text").drop("score")
    rest = materialize(labelled(evidence, ~first).drop("_id"), "evidence")
    shape = rest.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if 0 < shape["toxic"] < shape["rows"]:
        logistic = _logistic(rest)
    else:
        rate = (seen.get(1, 0) + 0.5) / (sum(seen.values()) + 1)
        logistic = [math.log(rate / (1 - rate)), 0, 0, 0, 0]
    return Model(model.chars, model.weights, logistic)


def toxicity(docs: DataFrame, model: Model, keep: list[str], text: str = "text", limit: float = 0.3) -> DataFrame:
    """The columns ``keep`` with ``score`` and ``predicted``."""
    scored = _evidence(docs, model, keep, text).drop("x0", "x1", "x2", "x3")
    return scored.withColumn("predicted", (F.col("score") >= limit).cast("int"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = fit(docs, labels.filter(fold("doc_id", 4) != 2))
    docs = docs.select("doc_id", "text", (fold("doc_id", 4) == 2).alias("held_out"))
    return toxicity(docs, model, ["doc_id", "held_out"])
