"""Sparse matrix operators on long ``expr(obs_id, var_id, value)``.

Only non-zeros are stored, so every mean, variance or fraction divides by the number of
cells taken from ``obs`` and never by the number of stored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.functions.ordered import exact_quantiles
from cytoframe.schema import require_columns


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery (stays inside the plan, no driver trip)."""
    return df.agg(F.count(F.lit(1))).scalar()


def drop_zeros(expr: DataFrame) -> DataFrame:
    return require_columns(expr, ["obs_id", "var_id", "value"], "expr").where(F.col("value") != 0)


def require_nonnegative(expr: DataFrame) -> DataFrame:
    """Fail the job on the first negative entry, while streaming rows through."""
    bad = F.raise_error(F.concat(F.lit("negative value for gene "), F.col("var_id").cast("string")))
    return expr.withColumn("value", F.when(F.col("value") < 0, bad.cast("double")).otherwise(F.col("value")))


def cell_sums(expr: DataFrame) -> DataFrame:
    return expr.groupBy("obs_id").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("nnz"))


def gene_sums(expr: DataFrame) -> DataFrame:
    return expr.groupBy("var_id").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("nnz"))


def subset_sums(obs: DataFrame, expr: DataFrame, genes: DataFrame) -> DataFrame:
    """Per cell sum over the listed genes; 0 for cells without any of them."""
    part = expr.join(genes.select("var_id").distinct(), "var_id", "left_semi").groupBy("obs_id").agg(
        F.sum("value").alias("subset_total")
    )
    return obs.select("obs_id").join(part, "obs_id", "left").na.fill(0.0, ["subset_total"])


def gene_moments(expr: DataFrame, obs: DataFrame) -> DataFrame:
    """mean, variance (ddof 0 and 1) and non-zero count per gene over all cells."""
    n = row_count(obs)
    sums = expr.groupBy("var_id").agg(
        F.sum("value").alias("s1"), F.sum(F.col("value") * F.col("value")).alias("s2"), F.count(F.lit(1)).alias("nnz")
    ).withColumn("n_cells", n)
    mean = F.col("s1") / F.col("n_cells")
    spread = F.greatest(F.col("s2") - F.col("n_cells") * mean * mean, F.lit(0.0))
    return sums.select(
        "var_id",
        "nnz",
        "n_cells",
        mean.alias("mean"),
        (spread / F.col("n_cells")).alias("var_pop"),
        F.try_divide(spread, F.col("n_cells") - 1).alias("var_samp"),
    )


def log_normalize(expr: DataFrame, target: float = 1e4) -> DataFrame:
    """log1p(value * target / cell total); zero-preserving, so stored rows suffice."""
    totals = cell_sums(expr).select("obs_id", "total")
    return expr.join(totals, "obs_id").select(
        "obs_id", "var_id", F.log1p(F.col("value") * F.lit(float(target)) / F.col("total")).alias("value")
    )


def scale_to_total(expr: DataFrame, target: float = 1e4) -> DataFrame:
    """value * target / cell total."""
    totals = cell_sums(expr).select("obs_id", "total")
    return expr.join(totals, "obs_id").select("obs_id", "var_id", (F.col("value") * F.lit(float(target)) / F.col("total")).alias("value"))


def scale_no_center(expr: DataFrame, obs: DataFrame) -> DataFrame:
    """value / std (ddof 1); a zero or undefined std counts as 1."""
    std = gene_moments(expr, obs).select("var_id", F.sqrt("var_samp").alias("_sd"))
    return expr.join(std, "var_id").select(
        "obs_id",
        "var_id",
        (F.col("value") / F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(F.lit(1.0))).alias("value"),
    )


def clip_at_quantile(expr: DataFrame, obs: DataFrame, var: DataFrame, q: float = 0.9999) -> DataFrame:
    """Clip at the q-quantile over every entry of the cells x genes matrix, zeros included."""
    cells = row_count(obs)
    zeros = expr.agg(F.count(F.lit(1)).alias("_nnz"), F.count(F.lit(1)).alias("_k")).select(
        F.lit(0.0).alias("value"), (cells * row_count(var) - F.col("_nnz")).alias("w")
    )
    entries = expr.select("value", F.lit(1).cast("bigint").alias("w")).unionByName(zeros)
    top = exact_quantiles(entries, [], "value", {"top": q}, weight="w").select("top").scalar()
    return expr.withColumn("value", F.least(F.col("value"), top))


def scale_samples_to_global(expr: DataFrame, obs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-gene sample means pulled to the global mean; returns (expr, per-sample summary)."""
    cells = row_count(obs)
    sizes = obs.groupBy("sample_id").agg(F.count(F.lit(1)).alias("spots"))
    by_sample = expr.join(obs.select("obs_id", "sample_id"), "obs_id").groupBy("sample_id", "var_id").agg(
        F.sum("value").alias("_s")
    )
    overall = by_sample.groupBy("var_id").agg(F.sum("_s").alias("_all"))
    ratio = (
        by_sample.join(overall, "var_id")
        .join(sizes, "sample_id")
        .where(F.col("_s") > 0)
        .select(
            "sample_id", "var_id", "spots", ((F.col("_all") / cells) / (F.col("_s") / F.col("spots"))).alias("ratio")
        )
    )
    scaled = (
        expr.join(obs.select("obs_id", "sample_id"), "obs_id")
        .join(ratio.select("sample_id", "var_id", "ratio"), ["sample_id", "var_id"], "left")
        .select("obs_id", "var_id", (F.col("value") * F.coalesce("ratio", F.lit(1.0))).alias("value"))
    )
    mid = exact_quantiles(ratio, ["sample_id"], "ratio", {"median_nonzero_scaling_ratio": 0.5})
    summary = ratio.groupBy("sample_id").agg(
        F.max("spots").alias("spots"), F.count(F.lit(1)).alias("genes_with_nonzero_sample_mean")
    )
    return scaled, summary.join(mid, "sample_id")


def top_variable(expr_norm: DataFrame, obs: DataFrame, n_top: int = 3000) -> DataFrame:
    """Genes with the largest ddof-0 variance; ties by gene id."""
    return (
        gene_moments(expr_norm, obs)
        .select("var_id", F.col("var_pop").alias("variance"))
        .orderBy(F.col("variance").desc(), "var_id")
        .limit(n_top)
    )


def compare_matrices(reference: DataFrame, candidate: DataFrame, n_values: Column) -> DataFrame:
    """cosine / Pearson / RMSE / mean absolute difference over every entry, in one aggregate."""
    both = reference.withColumnRenamed("value", "a").join(
        candidate.withColumnRenamed("value", "b"), ["obs_id", "var_id"], "full_outer"
    ).na.fill(0.0, ["a", "b"])
    a, b = F.col("a"), F.col("b")
    sums = both.agg(
        F.sum(a * b).alias("ab"), F.sum(a * a).alias("aa"), F.sum(b * b).alias("bb"), F.sum(a).alias("sa"),
        F.sum(b).alias("sb"), F.sum((a - b) * (a - b)).alias("dd"), F.sum(F.abs(a - b)).alias("ad"),
    ).withColumn("n_values", n_values.cast("bigint"))
    n = F.col("n_values")
    cov = F.col("ab") - F.col("sa") * F.col("sb") / n
    va, vb = F.col("aa") - F.col("sa") * F.col("sa") / n, F.col("bb") - F.col("sb") * F.col("sb") / n
    floor = F.lit(1e-12)
    return sums.select(
        (F.col("ab") / F.greatest(F.sqrt("aa") * F.sqrt("bb"), floor)).alias("cosine"),
        (cov / F.greatest(F.sqrt(F.greatest(va, F.lit(0.0))) * F.sqrt(F.greatest(vb, F.lit(0.0))), floor)).alias("pearson"),
        F.sqrt(F.col("dd") / n).alias("rmse"),
        (F.col("ad") / n).alias("mean_abs"),
        "n_values",
    )


def axis_overlap(reference: DataFrame, candidate: DataFrame, key: str) -> DataFrame:
    """Sizes and Jaccard of two key sets; 1.0 when both are empty."""
    left, right = reference.select(key).distinct(), candidate.select(key).distinct()
    marks = left.withColumn("l", F.lit(1)).join(right.withColumn("r", F.lit(1)), key, "full_outer")
    both = F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull())
    return marks.agg(both.alias("n_common"), F.count(F.lit(1)).alias("n_union")).select(
        F.lit(key).alias("axis"),
        "n_common",
        "n_union",
        F.coalesce(F.try_divide(F.col("n_common").cast("double"), F.col("n_union")), F.lit(1.0)).alias("jaccard"),
    )
