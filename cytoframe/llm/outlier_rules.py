"""Quality rules with robust multivariate outliers; DataFrame and SQL functions only.

Every text gets its word statistics in one pass.  Texts that pass the base rules are
described by a vector of transformed statistics (``FEATURES``); per (language, source) a minimum covariance
determinant estimate of centre and scatter is found by concentration steps: from medians and
absolute deviations, the ``SHARE`` nearest vectors are kept, their mean and covariance
taken, distances computed anew, and so on.  Sums, products and sketch quantiles are
all that is gathered, so that a hot source is never sorted or collected.  A text is rejected if its
Mahalanobis distance exceeds the chi-square quantile of ``1 - alpha``.

A (language, source) pair of fewer than ``least`` texts joins the other small ones of its
language, these those of all languages; what is still smaller has no verdict and is kept.
Each feature has a floor added to its variance, so that a statistic that is nearly constant
in a group doesn't reject ordinary texts.

Defined cases: a null text has no words and fails the base rules; null languages and sources
are groups of their own; repeated rows count each time; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import BLANK_RE, BLANKS, table
from cytoframe.session import cut

SYMBOLS = "#*$%&|<>"
SHARE = 0.75
STEPS = 5
#: Feature name: (expression over the statistics, floor of its standard deviation).
FEATURES: dict[str, tuple[str, float]] = {
    "word_length": ("ln(word_chars / n_words)", 0.15),
    "symbols": ("sqrt(n_symbols / n_words)", 0.10),
    "dup_lines": ("sqrt(n_dup_lines / n_lines)", 0.15),
    "repeats": ("sqrt(n_repeat_words / n_words)", 0.12),
    "length": ("ln(n_words)", 0.5),
}
P = len(FEATURES)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with ``value`` computed once per row."""
    return F.transform(F.array(value), f)[0]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RE))


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the array."""
    def covered(windows: Column) -> Column:
        order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(order, lambda s: F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))))
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"))
        total = F.aggregate(places, start, step, lambda acc: acc["n"])
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(total)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(windows, covered))


def statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` and the statistics of each row's whole text."""
    text = F.coalesce("text", F.lit(""))
    removed = lambda chars: F.char_length(F.translate(text, chars, ""))
    lines = let(F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""), lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    told = let(words_of(text), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeat")))
    rows = docs.select(*keep, removed(BLANKS).cast("long").alias("word_chars"), (F.char_length(text) - removed(SYMBOLS)).cast("long").alias("n_symbols"), lines.alias("l"), told.alias("w"))
    return rows.select(
        *keep, F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols", F.col("l.dup").cast("long").alias("n_dup_lines"),
        F.col("w.repeat").alias("n_repeat_words"), F.col("l.n").alias("n_lines"),
    ).withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def chi_square_cdf(x: float, k: float) -> float:
    """By the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, h = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= h / n
        total += term
    return total * math.exp(-h + a * math.log(h) - math.lgamma(a))


def chi_square_quantile(p: float, k: float) -> float:
    low, high = 0.0, 10.0 * k + 200
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, k) < p else (low, mid)
    return high


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """``grp`` per row: its (lang, source), or the small rest of its language, or the rest of all."""
    pairs = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = pairs.where(F.col("n") < least).groupBy("lang").agg(F.sum("n").alias("m"))
    named = pairs.alias("p").join(small.alias("s"), F.col("p.lang").eqNullSafe(F.col("s.lang")), "left").select("p.lang", "p.source", "n", "m")
    grp = F.when(F.col("n") >= least, F.to_json(F.struct("lang", "source"))).when(F.col("m") >= least, F.to_json(F.struct("lang"))).otherwise(F.lit("rest"))
    named = named.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), grp.alias("grp"))
    return rows.join(named, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))).drop("g_lang", "g_source")


def _estimate(chosen: DataFrame, factor: float) -> DataFrame:
    """Per group the mean m0.. and the inverse-ready Cholesky factor l00, l10, .. of the scatter of ``chosen``."""
    xs = list(FEATURES)
    sums = [F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]
    sums += [F.covar_pop(a, b).alias(f"c{i}{j}") for i, a in enumerate(xs) for j, b in enumerate(xs[: i + 1])]
    out = chosen.groupBy("grp").agg(*sums)
    for i in range(P):
        for j in range(i + 1):
            c = F.col(f"c{i}{j}") * factor + (F.lit(FEATURES[xs[i]][1] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(1e-9))) if i == j else c / F.col(f"l{j}{j}"))
    return out.select("grp", *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i in range(P) for j in range(i + 1)])


def _distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``d2``: squared Mahalanobis distance, by forward substitution."""
    out = rows.join(estimate, "grp")
    for i, x in enumerate(FEATURES):
        y = F.col(x) - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    return out.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, P)), F.col("y0") * F.col("y0"))).select(*rows.columns, "d2")


def _nearest(rows: DataFrame) -> DataFrame:
    """The SHARE of each group with the smallest d2."""
    edge = rows.groupBy("grp").agg(F.percentile_approx("d2", F.lit(SHARE), F.lit(2000)).alias("edge"))
    return rows.join(edge, "grp").where("d2 <= edge").drop("edge")


def outliers(stats: DataFrame, alpha: float = 1e-6, least: int = 60) -> DataFrame:
    """``stats`` with ``grp``, ``distance2`` and ``kept``; rows that fail the base rules are not kept.

    ``stats`` should be a written table, as each concentration step reads it.
    """
    columns = stats.columns
    good = stats.where("NOT base_failed")
    good = _groups(good, least).withColumns({k: F.expr(e) for k, (e, _) in FEATURES.items()})
    good = cut(good)
    mid = good.groupBy("grp").agg(*[F.percentile_approx(x, F.lit(0.5), F.lit(2000)).alias(f"m{i}") for i, x in enumerate(FEATURES)], F.count(F.lit(1)).alias("n"))
    mid = cut(mid)
    wide = good.join(mid, "grp")
    mad = wide.groupBy("grp").agg(*[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), F.lit(0.5), F.lit(2000)).alias(f"s{i}") for i, x in enumerate(FEATURES)])
    mad = cut(mad)
    first = F.lit(0.0)
    for i, (x, (_, floor)) in enumerate(FEATURES.items()):
        z = F.col(x) - F.col(f"m{i}")
        first = first + z * z / (F.pow(F.lit(1.4826) * F.col(f"s{i}"), 2) + floor**2)
    near = _nearest(wide.join(mad, "grp").select(*good.columns, first.alias("d2")))
    factor = SHARE / chi_square_cdf(chi_square_quantile(SHARE, P), P + 2)
    for step in range(STEPS):
        estimate = cut(_estimate(near, factor if step == STEPS - 1 else 1.0))
        far = _distance(good, estimate)
        near = _nearest(far)
    edge = chi_square_quantile(1 - alpha, P)
    told = far.join(mid.select("grp", "n"), "grp")
    kept = (F.col("n") < least) | (F.col("d2") <= edge)
    told = told.select(*columns, "grp", F.col("d2").alias("distance2"), kept.alias("kept"))
    bad = stats.where("base_failed").select(*columns, F.lit(None).cast("string").alias("grp"), F.lit(None).cast("double").alias("distance2"), F.lit(False).alias("kept"))
    return told.union(bad)


@query("op6_outlier_rules")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    stats = cut(statistics(table(spark, folder, "documents")))
    return outliers(stats).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
