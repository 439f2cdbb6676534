"""Marker genes per group of cells: cosine score and rank-sum test on sparse data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions.ordered import average_ranks, benjamini_hochberg
from cytoframe.functions.tails import normal_p
from cytoframe.operators.matrix import row_count
from cytoframe.schema import require_columns
from cytoframe.session import cut


def group_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("grp").agg(F.count(F.lit(1)).alias("n_in"))


def group_summaries(expr: DataFrame, labels: DataFrame) -> DataFrame:
    """Sum and non-zero count per (gene, group), with the gene's totals over all cells.

    One shuffle of the expression rows; everything after is genes x groups in size.
    """
    require_columns(labels, ["obs_id", "grp"], "labels")
    v = F.col("value")
    per = expr.join(labels, "obs_id").groupBy("var_id", "grp").agg(
        F.sum(v).alias("group_sum"), F.count(F.lit(1)).alias("group_nnz"), F.sum(v * v).alias("_sq")
    )
    gene = per.groupBy("var_id").agg(
        F.sum("group_sum").alias("total_sum"), F.sum("group_nnz").alias("total_nnz"), F.sqrt(F.sum("_sq")).alias("norm")
    )
    return per.drop("_sq").join(gene, "var_id")


def _with_rates(summary: DataFrame, labels: DataFrame) -> DataFrame:
    n_out = F.col("n_cells") - F.col("n_in")
    rates = summary.join(group_sizes(labels), "grp").withColumn("n_cells", row_count(labels))
    zero = F.lit(0.0)
    return rates.withColumns(
        {
            "pct_in": F.col("group_nnz") / F.col("n_in"),
            "pct_out": F.coalesce(F.try_divide((F.col("total_nnz") - F.col("group_nnz")).cast("double"), n_out), zero),
            "mean_in": F.col("group_sum") / F.col("n_in"),
            "mean_out": F.coalesce(F.try_divide(F.col("total_sum") - F.col("group_sum"), n_out), zero),
        }
    ).withColumn("mean_diff", F.col("mean_in") - F.col("mean_out"))


def _fill_grid(summary: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the (gene, group) combinations without any stored value as zeros."""
    names = F.array_sort(F.collect_set("grp"))
    groups = labels.agg(names.alias("g")).scalar()
    gene = summary.select("var_id", "total_sum", "total_nnz", "norm").distinct()
    grid = gene.select("*", F.explode(groups).alias("grp"))
    stored = summary.select("var_id", "grp", "group_sum", "group_nnz")
    return grid.join(stored, ["var_id", "grp"], "left").na.fill(0, ["group_sum", "group_nnz"])


def _requested(df: DataFrame, groups: Sequence[str] | None) -> DataFrame:
    return df if groups is None else df.where(F.col("grp").isin([str(g) for g in groups]))


def cosg(
    expr: DataFrame, labels: DataFrame, top_n: int = 100, min_pct: float = 0.05, groups: Sequence[str] | None = None
) -> DataFrame:
    """Rank genes by cosine between the gene vector and the group indicator.

    The filter on ``rank`` lets Spark keep only top_n rows per group before the shuffle.
    """
    summary = group_summaries(expr, labels)
    if min_pct <= 0:
        summary = _fill_grid(summary, labels)
    score = F.coalesce(F.try_divide(F.col("group_sum"), F.col("norm") * F.sqrt(F.col("n_in"))), F.lit(0.0))
    scored = _requested(_with_rates(summary, labels), groups).withColumn("score", score).where(F.col("pct_in") >= min_pct)
    best = Window.partitionBy("grp").orderBy(F.col("score").desc(), F.col("var_id"))
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top_n)
        .select(
            "grp", F.col("rank").cast("bigint").alias("rank"), F.col("var_id").alias("gene"), "score", "pct_in", "pct_out",
            "mean_in", "mean_out", "mean_diff",
        )
    )


def rank_sum_z(expr: DataFrame, labels: DataFrame, min_pct: float = 0.05) -> DataFrame:
    """Rank-sum z per (gene, group) against all other cells, implicit zeros ranked in one block.

    Values must be non-negative.  Each gene is reduced to distinct values with counts
    before ranking, so a gene expressed everywhere is not sorted in one task.
    """
    tagged = expr.where(F.col("value") > 0).join(labels, "obs_id")
    counts = cut(tagged.groupBy("var_id", "value", "grp").agg(F.count(F.lit(1)).alias("c")))
    ranks = average_ranks(counts, ["var_id"], "value", weight="c")
    above = counts.join(ranks, ["var_id", "value"]).groupBy("var_id", "grp").agg(
        F.sum(F.col("c") * F.col("avg_rank")).alias("_rank_sum"), F.sum("c").alias("_nnz_in")
    )
    table = _with_rates(group_summaries(expr, labels), labels).join(above, ["var_id", "grp"])
    zeros = F.col("n_cells") - F.col("total_nnz")
    n1 = F.col("n_in").cast("double")
    n2 = (F.col("n_cells") - F.col("n_in")).cast("double")
    ranked = (
        F.col("_rank_sum") + F.col("_nnz_in") * zeros + (F.col("n_in") - F.col("_nnz_in")) * (zeros + 1) / F.lit(2.0)
    )
    z = (ranked - n1 * (n1 + n2 + 1) / 2.0) / F.sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0)
    return table.where((F.col("pct_in") >= min_pct) & (n2 > 0)).withColumn("z", z)


def wilcoxon(expr: DataFrame, labels: DataFrame, var: DataFrame, top_n: int = 100, min_pct: float = 0.05) -> DataFrame:
    """Top genes per group by rank-sum statistic; FDR counts every gene of ``var``."""
    tested = cut(rank_sum_z(expr, labels, min_pct)).withColumn("pvalue", normal_p("z"))
    adjusted = benjamini_hochberg(cut(tested), "pvalue", ["grp"], n_tests=row_count(var))
    best = Window.partitionBy("grp").orderBy(F.col("z").desc(), F.col("pvalue"), F.col("var_id"))
    return (
        adjusted.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top_n)
        .select(
            "grp", F.col("rank").cast("bigint").alias("rank"), F.col("var_id").alias("gene"), F.col("z").alias("score"),
            "pvalue", "padj", "pct_in", "pct_out", "mean_in", "mean_out", "mean_diff",
        )
    )
