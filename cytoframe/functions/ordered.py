"""Exact order statistics that never bring one whole group to one task.

A group (a sample, a gene, the whole table) may hold a third of all rows, so a plain
``Window.partitionBy(group).orderBy(x)`` would sort it in a single task.  Every
operator here first cuts each group into ordered buckets at approximate quantiles
(a mergeable sketch), adds up per-bucket totals in a small table, and then works
inside ``(group, bucket)``.  The cut points are only a partitioning choice: results
are exact whatever the sketch returned.

When a count shows that no group has more than ``SMALL_GROUP`` rows the direct form
(one ``percentile`` aggregate, one window) is used instead; both forms agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.session import cut, split_count

SMALL_GROUP = 100_000


def _fits_one_task(df: DataFrame, group: Sequence[str], limit: int | None) -> bool:
    """Measured, not assumed: is the largest group small enough for a single task?"""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_k")) if group else df.agg(F.count(F.lit(1)).alias("_k"))
    largest = sizes.agg(F.max("_k")).head()[0] or 0
    return largest <= (SMALL_GROUP if limit is None else limit)


def _cuts(df: DataFrame, group: Sequence[str], x: str, splits: int) -> DataFrame:
    probs = F.array(*[F.lit(i / splits) for i in range(1, splits)])
    sketch = F.percentile_approx(F.col(x).cast("double"), probs, F.lit(max(1000, 20 * splits)))
    return df.groupBy(*group).agg(F.array_sort(F.array_distinct(sketch)).alias("_cuts"))


def _global_cuts(df: DataFrame, x: str, splits: int) -> Column:
    """Cut points of the whole table as a literal (at most ``splits`` doubles come to the driver)."""
    found = _cuts(df, [], x, splits).head()[0]
    return F.lit([float(c) for c in found or []]).cast("array<double>")


def _position(cuts: Column, x: Column) -> Column:
    """2k for the open interval after k cut points, 2k-1 for a value equal to the k-th."""
    below = F.size(F.filter(cuts, lambda c: c < x))
    return (2 * below + F.array_contains(cuts, x).cast("int")).cast("int")


def add_bucket(
    df: DataFrame, group: Sequence[str], x: str, tiebreak: str | None = None, splits: int | None = None
) -> DataFrame:
    """Add ``_b`` (and ``_b2``): bucket numbers that rise with ``x`` inside each group.

    A value frequent enough to be a cut point gets its own bucket, which is divided
    again by a numeric ``tiebreak`` so heavy ties do not pile up in one task.
    """
    n = splits or split_count(df)
    value = F.col(x).cast("double")
    clean = df.where(F.col(x).isNotNull())
    if group:
        out = clean.join(_cuts(clean, group, x, n), list(group))
        out = out.withColumn("_b", _position(F.col("_cuts"), value)).drop("_cuts")
    else:
        out = clean.withColumn("_b", _position(_global_cuts(clean, x, n), value))
    if tiebreak is None or dict(df.dtypes)[tiebreak] == "string":
        return out.withColumn("_b2", F.lit(0))
    ties = _global_cuts(clean.select(tiebreak), tiebreak, n)
    inner = _position(ties, F.col(tiebreak).cast("double"))
    return out.withColumn("_b2", F.when(F.col("_b") % 2 == 1, inner).otherwise(F.lit(0)))


def running_sums(
    df: DataFrame,
    group: Sequence[str],
    x: str,
    sums: dict[str, Column],
    tiebreak: str | None = None,
    splits: int | None = None,
    keep_bucket: bool = False,
    small_group: int | None = None,
) -> DataFrame:
    """Inclusive running totals in (x, tiebreak) order, one output column per entry."""
    df = cut(df.where(F.col(x).isNotNull()))
    order = [F.col(x).asc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    if _fits_one_task(df, group, small_group):
        whole = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        out = df.select("*", *[F.sum(expr).over(whole).alias(name) for name, expr in sums.items()])
        return out.withColumns({"_b": F.lit(0), "_b2": F.lit(0)}) if keep_bucket else out
    cut_up = add_bucket(df, group, x, tiebreak, splits)
    for name, expr in sums.items():
        cut_up = cut_up.withColumn(f"_v_{name}", expr)
    keys = [*group, "_b", "_b2"]
    totals = cut_up.groupBy(*keys).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    ahead = Window.partitionBy(*group).orderBy("_b", "_b2").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"_t_{n}").over(ahead), F.lit(0)).alias(f"_o_{n}") for n in sums]
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = cut_up.join(offsets, keys)
    for name in sums:
        out = out.withColumn(name, F.col(f"_o_{name}") + F.sum(f"_v_{name}").over(inside))
    drop = [f"_v_{n}" for n in sums] + [f"_o_{n}" for n in sums]
    return out.drop(*drop) if keep_bucket else out.drop(*drop, "_b", "_b2")


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    x: str,
    probs: dict[str, float],
    splits: int | None = None,
    weight: str | None = None,
    small_group: int | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group (NULL values are skipped).

    ``weight`` says how often a row counts; a sparse column adds its implicit zeros as
    one row ``(0.0, n_zero)`` instead of materialising them.

    Three narrow passes: sketch, bucket counts, and a look at only the few buckets that
    contain a wanted rank.  Only those buckets' rows are shuffled.
    """
    group = list(group)
    times = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    slim = df.select(*group, x, times.alias("_c")).where(F.col("_c") > 0)
    if _fits_one_task(slim, group, small_group):
        return slim.groupBy(*group).agg(
            *[F.expr(f"percentile(cast({x} as double), {p!r}D, _c)").alias(k) for k, p in probs.items()]
        )
    cut_up = add_bucket(slim, group, x, None, splits).drop("_b2")
    counts = cut_up.groupBy(*group, "_b").agg(F.sum("_c").alias("_w"))
    upto = Window.partitionBy(*group).orderBy("_b")
    whole = Window.partitionBy(*group)
    ranked = counts.withColumn("_end", F.sum("_w").over(upto)).withColumn("_n", F.sum("_w").over(whole))
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(float(p)).alias("p")) for k, p in probs.items()])
    targets = (
        ranked.select(*group, "_b", "_end", "_n", (F.col("_end") - F.col("_w")).alias("_start"), F.explode(wanted).alias("_q"))
        .withColumn("_h", (F.col("_n") - 1) * F.col("_q.p"))
        .withColumn("_lo", F.floor("_h"))
        .withColumn("_hi", F.ceil("_h"))
        .where(
            ((F.col("_lo") >= F.col("_start")) & (F.col("_lo") < F.col("_end")))
            | ((F.col("_hi") >= F.col("_start")) & (F.col("_hi") < F.col("_end")))
        )
        .groupBy(*group, "_b", "_start")
        .agg(F.collect_list(F.struct("_q.name", "_h", "_lo", "_hi")).alias("_want"))
    )
    rows = cut_up.join(targets, [*group, "_b"]).groupBy(*group, "_b", "_start", "_want", x).agg(
        F.sum("_c").alias("_w")
    )
    inside = Window.partitionBy(*group, "_b").orderBy(x)
    placed = (
        rows.withColumn("_to", F.col("_start") + F.sum("_w").over(inside))
        .withColumn("_from", F.col("_to") - F.col("_w"))
        .select(*group, F.col(x).cast("double").alias("_x"), "_from", "_to", F.explode("_want").alias("_t"))
    )
    at = lambda r: F.max(F.when((F.col(r) >= F.col("_from")) & (F.col(r) < F.col("_to")), F.col("_x")))
    found = placed.groupBy(*group, "_t.name").agg(
        at("_t._lo").alias("_vlo"), at("_t._hi").alias("_vhi"), F.max(F.col("_t._h") - F.col("_t._lo")).alias("_d")
    )
    value = F.when(F.col("_d") == 0, F.col("_vlo")).otherwise(
        F.col("_vlo") * (1 - F.col("_d")) + F.col("_vhi") * F.col("_d")
    )
    return found.groupBy(*group).agg(*[F.max(F.when(F.col("name") == k, value)).alias(k) for k in probs])


def median_and_mad(
    df: DataFrame, group: Sequence[str], x: str, extra: dict[str, float] | None = None, small_group: int | None = None
) -> DataFrame:
    """Per group: ``median``, ``mad`` = max(1.4826 * median|x - median|, 1e-9), plus extra quantiles."""
    df = cut(df.select(*group, x))
    base = cut(exact_quantiles(df, group, x, {"median": 0.5, **(extra or {})}, small_group=small_group))
    dev = df.select(*group, x).join(base.select(*group, "median"), list(group))
    dev = dev.select(*group, F.abs(F.col(x) - F.col("median")).alias("_dev"))
    spread = exact_quantiles(dev, group, "_dev", {"_m": 0.5}, small_group=small_group)
    return base.join(
        spread.select(*group, F.greatest(F.lit(1.4826) * F.col("_m"), F.lit(1e-9)).alias("mad")), list(group)
    )


def benjamini_hochberg(
    df: DataFrame,
    p: str,
    group: Sequence[str] = (),
    out: str = "padj",
    splits: int | None = None,
    small_group: int | None = None,
    n_tests: Column | None = None,
) -> DataFrame:
    """Step-up adjusted p-values; NULL p stays NULL and is not counted.

    ``n_tests`` overrides the number of tests when untested members (p = 1) are implied
    rather than stored.

    Tied p-values share the largest of their ranks, so the step-up runs over distinct
    values with counts and ties collapse before any shuffle.
    """
    group = list(group)
    distinct = cut(df.where(F.col(p).isNotNull()).groupBy(*group, p).agg(F.count(F.lit(1)).alias("_w")))
    ranked = running_sums(
        distinct, group, p, {"_rank": F.col("_w")}, splits=splits, keep_bucket=True, small_group=small_group
    )
    keys = [*group, "_b"]
    if n_tests is not None:
        ranked = ranked.withColumn("_n", n_tests)
    elif group:
        ranked = ranked.join(distinct.groupBy(*group).agg(F.sum("_w").alias("_n")), group)
    else:
        ranked = ranked.withColumn("_n", distinct.agg(F.sum("_w")).scalar())
    ranked = ranked.withColumn("_raw", F.col(p) * F.col("_n") / F.col("_rank"))
    lows = ranked.groupBy(*keys).agg(F.min("_raw").alias("_low"))
    later = Window.partitionBy(*group).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lows = lows.select(*keys, F.min("_low").over(later).alias("_later"))
    down = Window.partitionBy(*keys).orderBy(F.col(p).desc()).rowsBetween(Window.unboundedPreceding, 0)
    adjusted = ranked.join(lows, keys).select(
        *group,
        p,
        F.least(F.greatest(F.least(F.min("_raw").over(down), F.col("_later")), F.lit(0.0)), F.lit(1.0)).alias(out),
    )
    return df.join(adjusted, [*group, p], "left")


def average_ranks(
    df: DataFrame, group: Sequence[str], x: str, weight: str | None = None, small_group: int | None = None
) -> DataFrame:
    """Distinct values of each group with count ``w`` and tie-averaged 1-based ``avg_rank``."""
    group = list(group)
    weigh = F.sum(weight) if weight else F.count(F.lit(1))
    distinct = df.groupBy(*group, x).agg(weigh.alias("w"))
    ranked = running_sums(distinct, group, x, {"_upto": F.col("w")}, small_group=small_group)
    return ranked.select(*group, x, "w", (F.col("_upto") - (F.col("w") - 1) / F.lit(2.0)).alias("avg_rank"))


def place_rank(df: DataFrame, group: Sequence[str], x: str, tiebreak: str, out: str = "rank") -> DataFrame:
    """1-based position in (x, tiebreak) order as BIGINT; ``x`` NULL rows are dropped."""
    return running_sums(df, group, x, {out: F.lit(1).cast("bigint")}, tiebreak=tiebreak)
