"""Cell-type composition per sample and its association with labels, values and survival."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions.ordered import average_ranks, benjamini_hochberg, exact_quantiles, running_sums
from cytoframe.functions.tails import student_p
from cytoframe.operators.pseudobulk import TINY
from cytoframe.schema import require_columns
from cytoframe.session import cut


# ---------------------------------------------------------------- composition tables
def with_proportions(counts: DataFrame) -> DataFrame:
    """n / sample total; an empty sample gets 0."""
    totals = counts.groupBy("sample_id").agg(F.sum("n").alias("_t"))
    share = F.coalesce(F.try_divide(F.col("n").cast("double"), F.col("_t")), F.lit(0.0))
    return counts.join(totals, "sample_id").select("sample_id", "cell_type", "n", share.alias("prop"))


def composition(cells: DataFrame, min_per_sample: int = 20, min_per_type: int = 50) -> DataFrame:
    """Dense sample x cell-type counts: thin samples go first, then thin types among the rest."""
    require_columns(cells, ["sample_id", "cell_type"], "cells")
    counts = cut(
        cells.where(F.col("sample_id").isNotNull() & F.col("cell_type").isNotNull())
        .groupBy("sample_id", "cell_type").agg(F.count(F.lit(1)).alias("n"))
    )
    samples = counts.groupBy("sample_id").agg(F.sum("n").alias("t")).where(F.col("t") >= min_per_sample).select("sample_id")
    kept = counts.join(samples, "sample_id", "left_semi")
    types = kept.groupBy("cell_type").agg(F.sum("n").alias("t")).where(F.col("t") >= min_per_type)
    names = types.agg(F.array_sort(F.collect_set("cell_type"))).scalar()
    grid = samples.select("sample_id", F.explode(names).alias("cell_type"))
    return with_proportions(grid.join(kept, ["sample_id", "cell_type"], "left").na.fill(0, ["n"]))


def wide_counts(counts: DataFrame) -> DataFrame:
    """sample x cell-type pivot for human-readable output."""
    return counts.groupBy("sample_id").pivot("cell_type").agg(F.sum("n")).na.fill(0)


def long_counts(wide: DataFrame, sample_key: str = "sample_id") -> DataFrame:
    """Inverse of ``wide_counts``: every other column is a cell type, missing counts are 0."""
    types = [c for c in wide.columns if c != sample_key]
    cast = wide.select(F.col(sample_key).alias("sample_id"), *[F.coalesce(F.expr(f"try_cast(`{c}` as bigint)"), F.lit(0)).alias(c) for c in types])
    return with_proportions(cast.unpivot(["sample_id"], types, "cell_type", "n"))


def merge_metadata(counts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join on sample_id; a repeated metadata key fails the job."""
    repeated = metadata.groupBy("sample_id").agg(F.count(F.lit(1)).alias("_k"))
    checked = metadata.join(repeated, "sample_id").where(
        F.when(F.col("_k") > 1, F.raise_error(F.lit("duplicate sample_id in metadata")).cast("boolean")).otherwise(F.lit(True))
    )
    return counts.join(checked.drop("_k"), "sample_id", "left")


# ---------------------------------------------------------------- design encoding
def covariate_matrix(metadata: DataFrame, covariates: str | Sequence[str] | None) -> DataFrame:
    """Numeric columns become ddof-0 z-scores, others 0/1 dummies without the first level."""
    if covariates is None:
        names = []
    elif isinstance(covariates, str):
        names = [c.strip() for c in covariates.split(",") if c.strip()]
    else:
        names = list(covariates)
    require_columns(metadata, names, "metadata")
    out = ["sample_id"]
    numeric = {"int", "bigint", "smallint", "tinyint", "float", "double"}
    for name in names:
        if dict(metadata.dtypes)[name] in numeric:
            stats = metadata.agg(F.avg(name).alias("m"), F.stddev_pop(name).alias("s"))
            mean, std = stats.select("m").scalar(), stats.select("s").scalar()
            out.append(F.when(std > 0, (F.col(name) - mean) / F.when(std > 0, std)).otherwise(F.lit(0.0)).alias(name))
        else:
            label = F.coalesce(F.col(name).cast("string"), F.lit("None"))
            levels = [r[0] for r in metadata.select(label).distinct().orderBy(label).limit(1001).collect()]
            if len(levels) > 1000:
                raise ValueError(f"covariate {name} has more than 1000 levels")
            out += [(label == lv).cast("double").alias(f"{name}_{lv}") for lv in levels[1:]]
    return metadata.select(*out)


def binary_labels(metadata: DataFrame, label: str, positive: str, negative: str) -> DataFrame:
    require_columns(metadata, [label], "metadata")
    text = F.col(label).cast("string")
    kept = metadata.where(text.isin([str(positive), str(negative)])).withColumn("y", (text == str(positive)).cast("int"))
    if kept.select("y").distinct().count() != 2:
        raise ValueError("binary mode requires both positive and negative samples")
    return kept


def class_labels(metadata: DataFrame, label: str, reference: str | None = None) -> DataFrame:
    """Integer codes in sorted label order with the reference first; missing labels form the class 'nan'."""
    require_columns(metadata, [label], "metadata")
    text = F.coalesce(F.col(label).cast("string"), F.lit("nan"))
    names = cut(metadata.select(text.alias("_c")).distinct())
    if reference is not None and not names.where(F.col("_c") == str(reference)).limit(1).count():
        raise ValueError(f"reference level {reference!r} is not present")
    if names.limit(2).count() < 2:
        raise ValueError("multiclass mode requires at least two classes")
    ahead = F.lit(0) if reference is None else F.when(F.col("_c") == str(reference), 0).otherwise(1)
    # one row per class: as many as the model has columns
    codes = names.select(F.col("_c"), (F.row_number().over(Window.orderBy(ahead, "_c")) - 1).alias("y"))
    return metadata.drop("y").withColumn("_c", text).join(codes, "_c").drop("_c")


def survival_times(metadata: DataFrame, time: str, event: str) -> DataFrame:
    require_columns(metadata, [time, event], "metadata")
    kept = metadata.withColumns(
        {"time": F.expr(f"try_cast(`{time}` as double)"), "event": F.expr(f"cast(try_cast(`{event}` as double) as int)")}
    ).where(F.col("time").isNotNull() & F.col("event").isNotNull())
    if not (kept.agg(F.sum("event")).head()[0] or 0) >= 1:
        raise ValueError("survival mode requires at least one observed event")
    return kept


# ---------------------------------------------------------------- losses and metrics
def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def bce_with_logits(logit: Column, y: Column, weight: Column | None = None) -> Column:
    loss = F.greatest(logit, F.lit(0.0)) - logit * y + F.log1p(F.exp(-F.abs(logit)))
    return F.avg(loss if weight is None else loss * weight)


def log_softmax(long: DataFrame, row: str, logit: str) -> DataFrame:
    """Adds ``log_prob`` per (row, class); a row has only as many entries as there are classes."""
    norm = long.groupBy(row).agg(F.max(logit).alias("_m"), F.array_sort(F.collect_list(logit)).alias("_l")).select(
        row, (F.col("_m") + F.log(F.aggregate("_l", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("_m"))))).alias("_z")
    )
    return long.join(norm, row).withColumn("log_prob", F.col(logit) - F.col("_z")).drop("_z")


def cross_entropy(long: DataFrame, row: str, logit: str, is_true: str) -> DataFrame:
    return log_softmax(long, row, logit).where(F.col(is_true)).agg((-F.avg("log_prob")).alias("cross_entropy"))


def multinomial_nll(long: DataFrame, row: str, logit: str, count: str) -> DataFrame:
    per = log_softmax(long, row, logit).groupBy(row).agg(
        (-F.sum(F.col(count) * F.col("log_prob")) / F.greatest(F.sum(count), F.lit(1.0))).alias("_nll")
    )
    return per.agg(F.avg("_nll").alias("multinomial_nll"))


def _or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def auc(df: DataFrame, y: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Mann-Whitney AUC from tie-averaged ranks; NULL when one class is absent."""
    group = list(group)
    df = cut(df.select(*group, y, score))
    ranks = average_ranks(df, group, score)
    joined = df.join(ranks, [*group, score])
    n1, n0 = F.count_if(F.col(y) == 1).cast("double"), F.count_if(F.col(y) == 0).cast("double")
    r1 = F.sum(F.when(F.col(y) == 1, F.col("avg_rank")))
    return joined.groupBy(*group).agg(F.try_divide(r1 - n1 * (n1 + 1) / 2.0, n1 * n0).alias("auc"))


def binary_metrics(df: DataFrame, y: str, logit: str) -> DataFrame:
    score = sigmoid(F.col(logit))
    base = df.select(F.col(y).cast("int").alias("y"), score.alias("s")).withColumn("p", (F.col("s") >= 0.5).cast("int"))
    hit = lambda p, t: F.count_if((F.col("p") == p) & (F.col("y") == t))
    low = F.lit(1e-6)
    loss = F.when(F.col("y") == 1, F.ln(F.greatest("s", low))).otherwise(F.ln(F.greatest(1 - F.col("s"), low)))
    sums = base.agg(
        hit(1, 1).alias("tp"), hit(0, 0).alias("tn"), hit(1, 0).alias("fp"), hit(0, 1).alias("fn"),
        F.count(F.lit(1)).alias("n"), (-F.avg(loss)).alias("log_loss"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    sums = sums.withColumns({"precision": _or_zero(tp, tp + fp), "recall": _or_zero(tp, tp + fn), "_spec": _or_zero(tn, tn + fp)})
    return sums.select(
        _or_zero(tp + tn, F.greatest("n", F.lit(1))).alias("accuracy"),
        ((F.col("recall") + F.col("_spec")) / 2).alias("balanced_accuracy"), "precision", "recall",
        _or_zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"), "log_loss",
        auc(base, "y", "s").scalar().alias("auc"),
    )


def multiclass_metrics(long: DataFrame, row: str = "row_id", cls: str = "cls", logit: str = "logit", truth: str = "truth") -> DataFrame:
    """Accuracy, macro scores and log loss from long (row, class, logit, true class); ties go to the first class."""
    long = cut(log_softmax(long, row, logit))
    first = F.max_by(F.col(cls), F.struct(F.col(logit), F.col("_neg")))
    order = F.array_sort(F.collect_set(cls))
    names = long.agg(order).scalar()
    placed = long.withColumn("_neg", -F.array_position(names, F.col(cls)))
    per_row = cut(placed.groupBy(row).agg(
        first.alias("pred"), F.max(truth).alias("truth"), F.max(F.when(F.col(cls) == F.col(truth), F.col("log_prob"))).alias("lp")
    ))
    confusion = per_row.groupBy("pred", "truth").agg(F.count(F.lit(1)).alias("n"))
    both = confusion.select(F.col("pred").alias("c"), (F.col("pred") == F.col("truth")).alias("hit"), "n", F.lit("p").alias("side")).unionByName(
        confusion.select(F.col("truth").alias("c"), (F.col("pred") == F.col("truth")).alias("hit"), "n", F.lit("t").alias("side"))
    )
    size = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    per = both.groupBy("c").agg(
        size(F.col("hit") & (F.col("side") == "p")).alias("tp"), size(F.col("side") == "p").alias("np"), size(F.col("side") == "t").alias("nt")
    )
    per = long.select(F.col(cls).alias("c")).distinct().join(per, "c", "left").na.fill(0)
    prec, rec = _or_zero(F.col("tp"), F.col("np")), _or_zero(F.col("tp"), F.col("nt"))
    per = per.withColumns({"recall": rec, "f1": _or_zero(2 * prec * rec, prec + rec)})
    aucs = auc(long.select(F.col(cls), (F.col(cls) == F.col(truth)).cast("int").alias("_y"), F.round(F.exp("log_prob"), 12).alias("_p")), "_y", "_p", [cls])
    rows = per_row.agg(
        F.avg((F.col("pred") == F.col("truth")).cast("double")).alias("accuracy"),
        (-F.avg(F.ln(F.greatest(F.exp("lp"), F.lit(1e-6))))).alias("log_loss"),
    )
    macro = per.agg(F.avg("recall").alias("r"), F.avg("f1").alias("f"))
    return rows.select(
        "accuracy", macro.select("r").scalar().alias("balanced_accuracy"), macro.select("f").scalar().alias("macro_f1"),
        "log_loss", aucs.agg(F.avg("auc")).scalar().alias("macro_auc"),
    )


def concordance(df: DataFrame, time: str = "time", risk: str = "risk", event: str = "event") -> DataFrame:
    """Concordance index without enumerating pairs.

    Subjects are numbered by distinct time.  "Later than t" is a union of dyadic blocks of
    those numbers, one per binary digit, so each subject joins log2(n) ordered counts
    instead of every later subject: n log n rows, exact, ties worth one half.
    """
    base = cut(df.select(F.col(time).cast("double").alias("t"), F.col(risk).cast("double").alias("r"), (F.col(event) > 0).alias("e")))
    place = cut(running_sums(base.select("t").distinct(), [], "t", {"k": F.lit(1).cast("bigint")}))
    top = place.agg(F.max("k")).head()[0] or 0
    levels = F.sequence(F.lit(0), F.lit(max(int(top).bit_length() - 1, 0)))
    numbered = base.join(place, "t").select("r", "e", "k", F.explode(levels).alias("lv"))
    block = F.expr("shiftright(k, lv)")
    odd = block % 2 == 1
    marks = numbered.select(
        "lv", F.when(odd, block).otherwise(block + 1).alias("b"), "r",
        odd.cast("bigint").alias("m"), (~odd & F.col("e")).cast("bigint").alias("q"),
    ).where((F.col("m") > 0) | (F.col("q") > 0))
    steps = cut(marks.groupBy("lv", "b", "r").agg(F.sum("m").alias("m"), F.sum("q").alias("q")))
    ordered = running_sums(steps, ["lv", "b"], "r", {"upto": F.col("m")})
    wins = ordered.agg(F.sum(F.col("q") * (F.col("upto") - F.col("m") / 2.0)).alias("c")).select("c").scalar()
    pairs = steps.groupBy("lv", "b").agg(F.sum("m").alias("m"), F.sum("q").alias("q"))
    return pairs.agg(F.sum(F.col("m") * F.col("q")).alias("comparable_pairs")).select(
        F.coalesce("comparable_pairs", F.lit(0)).alias("comparable_pairs"),
        F.try_divide(wins, F.col("comparable_pairs").cast("double")).alias("concordance_index"),
    )


def _risk_sets(df: DataFrame, tiebreak: str, sums: dict[str, Column]) -> DataFrame:
    return running_sums(df.withColumn("_late", -F.col("time")), [], "_late", sums, tiebreak=tiebreak)


def cox_nll(df: DataFrame, tiebreak: str) -> DataFrame:
    """Mean negative log partial likelihood over events; columns time, risk, event."""
    df = cut(df)
    top = df.agg(F.max("risk")).scalar()
    sets = _risk_sets(df.withColumn("_w", F.exp(F.col("risk") - top)), tiebreak, {"_s": F.col("_w")})
    log_risk = F.ln(F.greatest("_s", F.lit(TINY))) + top
    loss = F.avg(F.when(F.col("event") > 0, log_risk - F.col("risk")))
    return sets.agg(loss.alias("cox_partial_nll"), F.count_if(F.col("event") > 0).alias("n_events"))


def cox_gradient(df: DataFrame, features: Sequence[str], beta: Sequence[float], tiebreak: str, l2: float = 0.0) -> DataFrame:
    """Loss and gradient of the ridge Cox likelihood from running weighted sums over risk sets."""
    eta = sum((F.col(f) * float(b) for f, b in zip(features, beta)), F.lit(0.0))
    df = cut(df.withColumn("_eta", eta))
    top = df.agg(F.max("_eta")).scalar()
    weighted = df.withColumn("_w", F.exp(F.col("_eta") - top))
    sums = {"_s": F.col("_w"), **{f"_s_{f}": F.col("_w") * F.col(f) for f in features}}
    sets = _risk_sets(weighted, tiebreak, sums).where(F.col("event") > 0)
    total = F.greatest("_s", F.lit(TINY))
    grads = [
        (-F.avg(F.col(f) - F.col(f"_s_{f}") / total) + float(l2) * float(b)).alias(f"grad_{f}") for f, b in zip(features, beta)
    ]
    penalty = 0.5 * float(l2) * math.fsum(float(b) ** 2 for b in beta)
    return sets.agg((F.avg(F.ln(total) + top - F.col("_eta")) + penalty).alias("loss"), *grads)


# ---------------------------------------------------------------- association tables
def ratio_from_coefficient(c: Column) -> Column:
    return F.exp(F.least(F.greatest(c, F.lit(-20.0)), F.lit(20.0)))


def direction(c: Column, up: str = "positive", down: str = "negative") -> Column:
    return F.when(c >= 0, up).otherwise(down)


def label_association(props: DataFrame, labels: DataFrame, group: Sequence[str] = ("cell_type",)) -> DataFrame:
    """Welch t of proportions between y = 1 and y = 0 samples per cell type (NULL when n < 2)."""
    joined = props.join(labels.select("sample_id", *[c for c in group if c not in props.columns], "y"), "sample_id")
    one, zero = F.when(F.col("y") == 1, F.col("prop")), F.when(F.col("y") == 0, F.col("prop"))
    m = joined.groupBy(*group).agg(
        F.avg(one).alias("mean_prop_positive"), F.avg(zero).alias("mean_prop_negative"), F.var_samp(one).alias("v1"),
        F.var_samp(zero).alias("v0"), F.count(one).alias("n1"), F.count(zero).alias("n0"),
    )
    a, b = F.col("v1") / F.col("n1"), F.col("v0") / F.col("n0")
    delta = F.col("mean_prop_positive") - F.col("mean_prop_negative")
    z = F.try_divide(delta, F.sqrt(a + b))
    df = F.try_divide((a + b) * (a + b), a * a / (F.col("n1") - 1) + b * b / (F.col("n0") - 1))
    ok = (F.col("n1") >= 2) & (F.col("n0") >= 2)
    return m.select(*group, "mean_prop_positive", "mean_prop_negative", delta.alias("delta_prop"), F.when(ok, z).alias("z"), F.when(ok, df).alias("df"))


def value_association(props: DataFrame, values: DataFrame) -> DataFrame:
    """Fisher z of the Pearson correlation between proportion and a sample value per cell type."""
    j = props.join(values.select("sample_id", "value"), "sample_id")
    s = j.groupBy("cell_type").agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop("prop", "value").alias("c"), F.stddev_pop("prop").alias("sp"), F.stddev_pop("value").alias("sv")
    )
    r = F.try_divide(F.col("c"), F.col("sp") * F.col("sv"))
    lim = F.least(F.greatest(F.col("r"), F.lit(-0.999999)), F.lit(0.999999))
    s = s.withColumn("r", F.when((F.col("n") >= 3) & (F.col("sp") > 0) & (F.col("sv") > 0), r))
    t = F.col("r") * F.sqrt(F.try_divide((F.col("n") - 2).cast("double"), F.greatest(1 - F.col("r") * F.col("r"), F.lit(TINY))))
    return s.select("cell_type", "n", "r", (0.5 * F.ln((1 + lim) / (1 - lim))).alias("z"), t.alias("t"))


def with_fdr(table: DataFrame, t: str, df: Column) -> DataFrame:
    """p from t, FDR over testable rows, ordered by (padj, pvalue, cell_type) with missing last."""
    tested = cut(cut(table.withColumn("_df", df.cast("double"))).withColumn("pvalue", student_p(t, "_df")))
    out = benjamini_hochberg(tested, "pvalue").drop("_df")
    return out.orderBy(F.asc_nulls_last("padj"), F.asc_nulls_last("pvalue"), "cell_type")


def risk_split_means(props: DataFrame, risk: DataFrame) -> DataFrame:
    """Mean proportion in the high (risk >= median) and low risk samples per cell type."""
    mid = exact_quantiles(risk, [], "risk", {"m": 0.5}).select("m").scalar()
    j = props.join(risk.select("sample_id", (F.col("risk") >= mid).alias("high")), "sample_id")
    return j.groupBy("cell_type").agg(
        F.avg(F.when(F.col("high"), F.col("prop"))).alias("mean_prop_high_risk"),
        F.avg(F.when(~F.col("high"), F.col("prop"))).alias("mean_prop_low_risk"),
    )


def bags(counts: DataFrame, max_instances: int = 2000) -> DataFrame:
    """Per sample the instance counts per cell type, scaled down to ``max_instances``.

    One-hot instances of a bag only matter through their counts, so a bag stays a count
    vector.  Larger bags keep exact proportions by largest remainder (no random draw).
    """
    total = counts.groupBy("sample_id").agg(F.sum("n").alias("_t"))
    checked = counts.join(total, "sample_id").withColumn(
        "_t", F.when(F.col("_t") <= 0, F.raise_error(F.lit("sample has zero cells")).cast("bigint")).otherwise(F.col("_t"))
    )
    scaled = F.col("n") * F.lit(max_instances) / F.col("_t").cast("double")
    parts = checked.withColumns({"_whole": F.floor(scaled), "_rest": scaled - F.floor(scaled)})
    spare = F.lit(max_instances) - F.sum("_whole").over(Window.partitionBy("sample_id"))
    place = F.row_number().over(Window.partitionBy("sample_id").orderBy(F.col("_rest").desc(), "cell_type"))
    size = F.when(F.col("_t") <= max_instances, F.col("n")).otherwise(F.col("_whole") + F.when(place <= spare, 1).otherwise(0))
    return parts.select("sample_id", "cell_type", size.cast("bigint").alias("instances"))


def sample_stats(cells: DataFrame) -> DataFrame:
    """Number of samples and min / median / max cells per sample."""
    per = cells.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))
    mid = exact_quantiles(per, [], "n", {"m": 0.5}).select("m").scalar()
    return per.agg(
        F.count(F.lit(1)).alias("n_samples"), F.min("n").alias("min_cells"), mid.alias("median_cells"), F.max("n").alias("max_cells")
    )
