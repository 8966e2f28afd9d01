"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word from both ends, and a softmax labels every position with a
language. It is trained here in numpy by backpropagation through time with Adam. A document's
probabilities pool the log probabilities of all its positions: words keep their own states, so a word
has the same labels wherever it stands and is computed once as long as it is remembered.

A word longer than ``PIECE`` bytes is read in pieces of that length; every byte of every text is
read. Texts that are null or have no letter are ``und`` with score 0. Rows with a null language or
text are not learned from. With fewer than two languages the answer is the one there is, or ``und``.
Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fold, query, rows_to_table, share_below, table

LETTER = regex.compile(r"\p{L}")
PIECE = 24
CACHE_WORDS = 600_000
TEXT_BYTES = 1 << 21  # of texts taken together
PAD = 256
MIN_STEPS = 150


@dataclass
class Network:
    """Weights: embeddings, two directions of gates, and the output layer."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @staticmethod
    def initial(languages: list[str], hidden: int, seed: int) -> Network:
        draw = np.random.default_rng(seed)
        h, n = hidden, len(languages)
        weights = {}
        for d in ("f", "b"):
            # Input weights of a byte are looked up: its embedding times the input matrix.
            weights[f"{d}_in"] = draw.normal(0, 0.3, (257, 3 * h))
            weights[f"{d}_zr"] = draw.normal(0, h**-0.5, (h, 2 * h))
            weights[f"{d}_n"] = draw.normal(0, h**-0.5, (h, h))
        weights["out"] = draw.normal(0, h**-0.5, (2 * h, n))
        weights["bias"] = np.zeros(n)
        return Network(languages, {k: w.astype(np.float32) for k, w in weights.items()})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(weights: dict, direction: str, codes: np.ndarray) -> tuple[np.ndarray, list]:
    """States after each position, ``steps x rows x hidden``, and what the way back needs."""
    recurrent, candidate = weights[f"{direction}_zr"], weights[f"{direction}_n"]
    h = candidate.shape[0]
    given = weights[f"{direction}_in"]
    state = np.zeros((codes.shape[1], h), np.float32)
    states, kept = np.empty((*codes.shape, h), np.float32), []
    for t in range(codes.shape[0]):
        x = given[codes[t]]
        gates = _sigmoid(x[:, : 2 * h] + state @ recurrent)
        z, r = gates[:, :h], gates[:, h:]
        gated = r * state
        new = np.tanh(x[:, 2 * h :] + gated @ candidate)
        kept.append((state, z, r, gated, new))
        state = new + z * (state - new)
        states[t] = state
    return states, kept


def _backward(weights: dict, direction: str, codes: np.ndarray, kept: list, upstream: np.ndarray) -> dict:
    """Gradients of one direction by backpropagation through time."""
    recurrent, candidate = weights[f"{direction}_zr"], weights[f"{direction}_n"]
    h = candidate.shape[0]
    g_in = np.zeros_like(weights[f"{direction}_in"])
    g_zr, g_n = np.zeros_like(recurrent), np.zeros_like(candidate)
    carried = np.zeros((codes.shape[1], h), np.float32)
    for t in range(codes.shape[0] - 1, -1, -1):
        state, z, r, gated, new = kept[t]
        total = upstream[t] + carried
        d_new = total * (1 - z) * (1 - new * new)
        d_gated = d_new @ candidate.T
        d_z = total * (state - new) * z * (1 - z)
        d_r = d_gated * state * r * (1 - r)
        d_gates = np.concatenate([d_z, d_r], axis=1)
        g_n += gated.T @ d_new
        g_zr += state.T @ d_gates
        np.add.at(g_in, codes[t], np.concatenate([d_gates, d_new], axis=1))
        carried = total * z + d_gated * r + d_gates @ recurrent.T
    return {f"{direction}_in": g_in, f"{direction}_zr": g_zr, f"{direction}_n": g_n}


def _reversed(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each position of the backward reading, the position in the text (padding stays)."""
    steps = np.arange(codes.shape[0])[:, None]
    return np.where(steps < lengths, lengths - 1 - steps, steps)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def position_logs(network: Network, codes: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """Log probabilities of the languages at every position, ``steps x rows x languages``."""
    w = network.weights
    turn = _reversed(codes, lengths)
    ahead, kept_f = _forward(w, "f", codes)
    behind, kept_b = _forward(w, "b", np.take_along_axis(codes, turn, 0))
    behind = np.take_along_axis(behind, turn[:, :, None], 0)
    both = np.concatenate([ahead, behind], axis=2)
    logs = _log_softmax(both @ w["out"] + w["bias"])
    return (logs, both, turn, kept_f, kept_b) if keep else logs


def _codes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words, ``steps x words``, padded behind their ends, and their lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = max(int(lengths.max()), 1)
    codes = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(-1, width).T.astype(np.int64)
    codes[np.arange(width)[:, None] >= lengths] = PAD
    return codes, lengths


def train(words: list[bytes], labels: list[int], languages: list[str], hidden: int, epochs: int, seed: int = 7) -> Network:
    """Fit the network on words labelled with the number of their language."""
    network = Network.initial(languages, hidden, seed)
    w = network.weights
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    draw = np.random.default_rng(seed)
    labels, step, size = np.array(labels), 0, 256
    epochs = max(epochs, -(-MIN_STEPS * size // len(words)))
    for epoch in range(epochs):
        order = draw.permutation(len(words))
        for start in range(0, len(words), size):
            part = order[start : start + size]
            codes, lengths = _codes([words[i] for i in part])
            logs, both, turn, kept_f, kept_b = position_logs(network, codes, lengths, keep=True)
            mask = (np.arange(codes.shape[0])[:, None] < lengths)[:, :, None]
            slope = np.exp(logs)
            slope[:, np.arange(len(part)), labels[part]] -= 1
            slope = np.where(mask, slope, 0).astype(np.float32) / lengths.sum()
            flat = slope.reshape(-1, slope.shape[2])
            grads = {"out": both.reshape(len(flat), -1).T @ flat, "bias": flat.sum(0)}
            up = slope @ w["out"].T
            grads |= _backward(w, "f", codes, kept_f, up[:, :, :hidden])
            turned = np.take_along_axis(codes, turn, 0)
            grads |= _backward(w, "b", turned, kept_b, np.take_along_axis(up[:, :, hidden:], turn[:, :, None], 0))
            step += 1
            rate = 0.02 * 0.1 ** (epoch / epochs)
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return network


class WordLogs:
    """Summed log probabilities of the positions of words, remembered while a word keeps coming.

    Texts are taken together, so that the network reads many new words at once, in groups of like length.
    When the table is full, the words of the texts at hand stay and the others go.
    """

    def __init__(self, network: Network):
        self.network = network
        self.place: dict[bytes, int] = {}
        self.table = np.zeros((0, len(network.languages)), np.float32)

    def _read(self, words: list[bytes]) -> np.ndarray:
        """Sums for new words. Words longer than a piece are read piece by piece."""
        sums = np.zeros((len(words), len(self.network.languages)), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        pieces = [(i, words[i][k : k + PIECE]) for i in order for k in range(0, len(words[i]), PIECE)]
        for start in range(0, len(pieces), 4096):
            group = pieces[start : start + 4096]
            codes, lengths = _codes([p for _, p in group])
            logs = position_logs(self.network, codes, lengths)
            logs[np.arange(codes.shape[0])[:, None] >= lengths] = 0
            np.add.at(sums, [i for i, _ in group], logs.sum(0))
        return sums

    def documents(self, raws: list[bytes]) -> np.ndarray:
        """Pooled log probabilities, ``texts x languages``."""
        split = [raw.split() for raw in raws]
        words = list(chain.from_iterable(split))
        distinct = dict.fromkeys(words)
        new = [w for w in distinct if w not in self.place]
        if len(self.place) + len(new) > CACHE_WORDS:
            kept = [w for w in distinct if w in self.place]
            self.table = self.table[[self.place[w] for w in kept]]
            self.place = {w: i for i, w in enumerate(kept)}
        if new:
            self.place.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
            self.table = np.concatenate([self.table, self._read(new)])
        found = self.table[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].astype(np.float64)
        ends = np.cumsum([len(s) for s in split])
        running = np.concatenate([np.zeros((1, found.shape[1])), np.cumsum(found, axis=0)])
        return running[ends] - running[np.concatenate([[0], ends[:-1]])]


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    per_language: int = 300,
    words_per_language: int = 12_000,
    hidden: int = 8,
    epochs: int = 3,
) -> Network:
    """Train on words of about ``per_language`` labelled documents of each language.

    Both numbers bound what is sampled; languages are counted first and drawn by a hash of the id, so
    no language is gathered in one task. At most ``words_per_language`` distinct words of each reach
    the driver.
    """
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}
    languages = sorted(counts)
    if len(languages) < 2:
        return Network(languages, {})
    shares = F.create_map(*[F.lit(x) for name in languages for x in (name, per_language / counts[name])])
    sample = labelled.filter(share_below(F.coalesce(doc_id, F.lit(0)), 21, F.element_at(shares, F.col(lang))))
    word = F.explode(F.split(F.regexp_replace(F.col(text), r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+"))
    words = sample.select(F.col(lang).alias("lang"), word.alias("word")).filter("word != ''").distinct()
    counted = {r[0]: r[1] for r in words.groupBy("lang").count().collect()}
    limits = F.create_map(*[F.lit(x) for name in counted for x in (name, words_per_language / counted[name])])
    drawn = words.filter(share_below("word", 22, F.element_at(limits, F.col("lang")))).collect()
    if not drawn:
        return Network([], {})
    drawn = sorted((r["word"].encode()[:PIECE], languages.index(r["lang"])) for r in drawn)
    return train([d[0] for d in drawn], [d[1] for d in drawn], languages, hidden, epochs)


def identify(docs: DataFrame, network: Network, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``, the pooled probability."""
    kinds = dict(docs.dtypes)
    shape = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches):
        known = WordLogs(network)
        for batch in batches:
            names, scores, held, size = [], [], [], 0
            raws = batch.column("_text").cast(pa.binary()).to_pylist()
            for k, raw in enumerate(raws, 1):
                held.append(raw or b"")
                size += len(held[-1])
                if size >= TEXT_BYTES or k == len(raws):
                    for name, score in answers(known, held):
                        names.append(name)
                        scores.append(score)
                    held, size = [], 0
            out = {n: batch.column(n) for n in keep}
            yield rows_to_table(out | {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    def answers(known: WordLogs, raws: list[bytes]):
        pooled = known.documents(raws) if len(network.languages) > 1 else None
        for i, raw in enumerate(raws):
            if not network.languages or not LETTER.search(raw.decode("utf-8", "replace")):
                yield "und", 0.0
            elif pooled is None:
                yield network.languages[0], 1.0
            else:
                logs = pooled[i]
                best = int(logs.argmax())
                # Positions of a word are not independent: pooled evidence is tempered.
                yield network.languages[best], float(1 / np.exp((logs - logs[best]) / len(raw) ** 0.5).sum())

    return shape.mapInArrow(run, ", ".join([*[f"`{n}` {kinds[n]}" for n in keep], "lang_pred string", "score double"]))


@query("op9_language_id")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", (fold("doc_id", 4) == 2).alias("held_out"))
    network = fit(docs.filter("NOT held_out"))
    return identify(docs, network, ["doc_id", "held_out"])
