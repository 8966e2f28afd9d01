"""Quality rules and robust multivariate outliers.

Each text gets counts and a vector of transformed statistics. Per language and source the location
and scatter of most vectors are estimated by the minimum covariance determinant; a text far from
them by Mahalanobis distance is rejected, and so is one that fails the base rules. How far is too
far follows from the distances of the group itself.

Null and empty texts have no words: they fail the base rules and take no part in the estimates.
Null languages and sources are groups of their own. A group whose scatter is singular is
regularised by ``ridge``; a group with fewer than ``min_own`` texts uses the estimate of all texts
of its language, and a language below that the one of all texts. How widely distances spread is
harder to tell from few texts: a group's figure is drawn towards its language's, by as much as
``min_group`` texts weigh.
"""

from __future__ import annotations

from collections import Counter
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import null_safe, query, table, texts
from millrace.session import materialize

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = ("s0", "s1", "s2", "s3", "s4", "s5")
SYMBOLS = b"#*$%&|<>"
QUARTILE = NormalDist().inv_cdf(0.75)
UPPER = regex.compile(r"\p{Lu}")


def text_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """The base counts of one text."""
    words = raw.split()
    n = len(words)
    continuation = len(raw) - len(raw.translate(None, bytes(range(0x80, 0xC0))))
    chars = sum(map(len, words)) - continuation
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeats = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(found := Counter(windows)) < len(windows):
            hit = np.fromiter(map(found.__getitem__, windows), np.int64, len(windows)) > 1
            covered = np.zeros(n, bool)
            for shift in range(3):
                covered[shift : shift + n - 2] |= hit
            repeats = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeats


def statistics(raw: bytes, counts: tuple[int, int, int, int, int]) -> list[float]:
    """Transformed statistics: logs of ratios, so that ordinary texts form one cloud.

    Shares are damped by a constant, because a rare event in a short text is no sign of junk.
    """
    n, chars, symbols, dup_lines, repeats = counts
    lines = raw.count(b"\n") + 1
    upper = len(UPPER.findall(raw.decode("utf-8", "replace")))
    return [
        float(np.log(chars / n)),
        float(np.log(symbols / n + 0.05)),
        float(np.log(repeats / n + 0.25)),
        float(np.log(dup_lines / lines + 0.5)),
        float(np.log(upper / n + 0.25)),
        float(np.log(len(set(raw.split())) / n ** 0.9 + 0.25)),
    ]


def measure(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the base counts and, unless there is no word, the statistics."""
    shape = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches):
        for batch in batches:
            counts, stats = [], []
            for raw in texts(batch.column("_text")):
                counts.append(text_counts(raw))
                stats.append(statistics(raw, counts[-1]) if counts[-1][0] else [None] * len(STATS))
            out = [batch.column(n) for n in keep]
            out += [pa.array(c, pa.int64()) for c in (zip(*counts) if counts else [[]] * len(COUNTS))]
            out += [pa.array(c, pa.float64()) for c in (zip(*stats) if stats else [[]] * len(STATS))]
            yield pa.RecordBatch.from_arrays(out, names=[*keep, *COUNTS, *STATS])

    kinds = dict(shape.dtypes)
    schema = [f"`{n}` {kinds[n]}" for n in keep]
    schema += [f"{n} long" for n in COUNTS] + [f"{n} double" for n in STATS]
    return shape.mapInArrow(run, ", ".join(schema))


def base_failed(min_words: int = 50, max_repeat: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))


def _moments(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Count, sums and products per group: everything a mean and a covariance need."""
    d = len(STATS)
    sums = [F.sum(c).alias(f"m{i}") for i, c in enumerate(STATS)]
    products = [
        F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)
    ]
    return rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def _estimates(moments: DataFrame, groups: list[str], ridge: float) -> DataFrame:
    """Centre and precision per group from its moments; one small row per group."""
    d = len(STATS)
    kinds = dict(moments.dtypes)

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            centres, precisions, dets = [], [], []
            for r in rows:
                n = max(r["n"], 1)
                centre = np.array([r[f"m{i}"] for i in range(d)]) / n
                cov = np.empty((d, d))
                for i in range(d):
                    for j in range(i, d):
                        cov[i, j] = cov[j, i] = r[f"p{i}_{j}"] / n - centre[i] * centre[j]
                cov += ridge * np.eye(d)
                centres.append(centre.tolist())
                precisions.append(np.linalg.inv(cov).ravel().tolist())
                dets.append(float(np.linalg.slogdet(cov)[1]))
            out = [batch.column(g) for g in groups]
            out += [batch.column("n"), pa.array(centres, pa.list_(pa.float64())), pa.array(precisions, pa.list_(pa.float64())), pa.array(dets, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=[*groups, "n", "centre", "precision", "log_det"])

    schema = [f"`{g}` {kinds[g]}" for g in groups] + ["n long", "centre array<double>", "precision array<double>", "log_det double"]
    return moments.mapInArrow(run, ", ".join(schema))


def _distance() -> Column:
    """Squared Mahalanobis distance of the statistics from ``centre`` under ``precision``."""
    d = len(STATS)
    away = [F.col(STATS[i]) - F.col("centre")[i] for i in range(d)]
    total = F.lit(0.0)
    for i in range(d):
        for j in range(d):
            total = total + away[i] * away[j] * F.col("precision")[i * d + j]
    return total


def chi_squared(p: float, d: int = len(STATS)) -> float:
    """Quantile of the chi-squared law, as Wilson and Hilferty approximate it."""
    return d * (1 - 2 / (9 * d) + NormalDist().inv_cdf(p) * (2 / (9 * d)) ** 0.5) ** 3


def cutoff(tail: float) -> Column:
    """The scaled distance that a share ``tail`` of ordinary texts exceeds, by ``spread``."""
    reach = F.lit(chi_squared(0.5)) * F.exp(NormalDist().inv_cdf(1 - tail) * F.col("spread"))
    return F.greatest(F.lit(chi_squared(0.975)), reach)


def mcd(rows: DataFrame, groups: list[str], share: float = 0.75, steps: int = 3, ridge: float = 1e-2) -> DataFrame:
    """Centre and precision per group by concentration steps, and the scale of its distances.

    The start is the coordinate-wise median and spread. Each step keeps the ``share`` of rows nearest
    to the estimate and estimates again from their moments, which never enlarges the determinant.
    Quantiles come from mergeable sketches and moments from sums, so a hot group is one row per task.
    ``scale`` makes the median distance that of a chi-squared variable. ``spread`` is the standard
    deviation of the logarithm of the distances, from their median and upper quartile: junk of up to
    a quarter of the group does not move it.
    """
    spread = [F.expr(f"percentile_approx({c}, array(0.25, 0.5, 0.75), 2000)").alias(f"q{i}") for i, c in enumerate(STATS)]
    d = len(STATS)
    start = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), *spread)
    widths = [F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(2.0)) + ridge for i in range(d)]
    model = start.select(
        *groups,
        "n",
        F.array(*[F.col(f"q{i}")[1] for i in range(d)]).alias("centre"),
        F.array(*[1 / widths[i] if i == j else F.lit(0.0) for i in range(d) for j in range(d)]).alias("precision"),
        F.lit(0.0).alias("log_det"),
    )
    for _ in range(steps):
        model = materialize(model, "mcd")
        placed = null_safe(rows, model, groups, "inner").withColumn("_d2", _distance())
        cut = materialize(placed.groupBy(*groups).agg(F.percentile_approx("_d2", share, 2000).alias("_cut")), "mcd-cut")
        near = null_safe(placed.drop("n", "centre", "precision", "log_det"), cut, groups, "inner").filter("_d2 <= _cut")
        model = _estimates(_moments(near, groups), groups, ridge)
    model = materialize(model, "mcd")
    placed = null_safe(rows, model, groups, "inner").withColumn("_d2", _distance())
    middle = placed.groupBy(*groups).agg(
        F.percentile_approx("_d2", [0.5, 0.75], 2000).alias("_middle"), F.count(F.lit(1)).alias("members")
    )
    scaled = null_safe(model.drop("n"), middle, groups, "inner")
    half, upper = F.col("_middle")[0] + 1e-9, F.col("_middle")[1] + 1e-9
    scaled = scaled.withColumns({"scale": F.lit(chi_squared(0.5)) / half, "spread": F.log(upper / half) / QUARTILE})
    return materialize(scaled.drop("_middle"), "mcd")


def quality_verdicts(
    docs: DataFrame,
    text: str = "text",
    groups: tuple[str, str] = ("lang", "source"),
    keep: tuple[str, ...] = (),
    tail: float = 1e-3,
    min_group: int = 100,
    min_own: int = 5 * len(STATS),
    min_words: int = 50,
) -> DataFrame:
    """Counts, statistics, ``distance`` and verdicts per document.

    Most ordinary texts repeat nothing at all, so one repeated line is already many deviations away and
    distances have a longer tail than the chi-squared law. Each group's bound is therefore that of a
    log-normal law through its median and upper quartile: a share ``tail`` of ordinary texts lies
    beyond it. It is never less than the chi-squared law's 97.5 % point.
    """
    names = list(groups)
    carried = [c for c in keep if c not in names]
    stored = materialize(measure(docs, text, [*names, *carried]), "quality")
    rows = stored.withColumn("base_failed", base_failed(min_words))
    valid = rows.filter("NOT base_failed").select(*names, *STATS)
    model = mcd(valid, names)
    wide = mcd(valid, names[:1])
    whole = mcd(valid.withColumn("_all", F.lit(1)).select("_all", *STATS), ["_all"])
    parts = ("centre", "precision", "scale", "spread", "members")
    joined = null_safe(rows, model, names, "left")
    joined = null_safe(joined, wide.select(names[0], *[F.col(c).alias(f"_lang_{c}") for c in parts]), names[:1], "left")
    # One row: the estimate over all texts.
    fallback = whole.select("_all", *[F.col(c).alias(f"_all_{c}") for c in parts])
    joined = joined.join(F.broadcast(fallback), F.lit(1) == F.col("_all"), "left").drop("_all")
    own = F.coalesce(F.col("members") >= min_own, F.lit(False))
    common = F.coalesce(F.col("_lang_members") >= min_own, F.lit(False))
    weight = F.col("members") / (F.col("members") + min_group)
    drawn = weight * F.col("spread") + (1 - weight) * F.col("_lang_spread")
    joined = joined.withColumns(
        {
            c: F.when(own, drawn if c == "spread" else F.col(c)).when(common, F.col(f"_lang_{c}")).otherwise(F.col(f"_all_{c}"))
            for c in ("centre", "precision", "scale", "spread")
        }
    )
    distance = F.when(F.col("n_words") > 0, _distance() * F.col("scale"))
    scored = joined.withColumn("distance", distance)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff(tail), F.lit(True))
    return scored.withColumn("kept", kept).select(*names, *carried, *COUNTS, "distance", "base_failed", "kept")


@query("op10_quality_outliers")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    found = quality_verdicts(table(spark, sf, "documents"), keep=("doc_id",))
    return found.select("doc_id", *COUNTS, "base_failed", "kept", "distance")
