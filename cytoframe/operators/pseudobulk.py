"""Pseudobulk aggregation and the log-CPM Welch contrast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.functions.ordered import average_ranks, benjamini_hochberg
from cytoframe.functions.tails import student_p
from cytoframe.operators.matrix import row_count
from cytoframe.schema import require_columns
from cytoframe.session import cut

TINY = 2.2250738585072014e-308


@dataclass(frozen=True)
class Pseudobulk:
    counts: DataFrame
    metadata: DataFrame
    summary: DataFrame


def pseudobulk(cells: DataFrame, expr: DataFrame, min_cells: int = 20) -> Pseudobulk:
    """Sum raw counts per cell type x sample x condition, dropping thin groups.

    Group sizes are decided on the small cell table first, so expression rows of dropped
    groups never reach the aggregate.
    """
    keys = ["cell_type", "sample_id", "condition"]
    require_columns(cells, ["obs_id", *keys], "cells")
    aggs = [F.count(F.lit(1)).alias("n_cells")]
    if "donor_id" in cells.columns:
        aggs.append(F.array_join(F.array_sort(F.collect_set(F.col("donor_id").cast("string"))), ";").alias("donor_id"))
    named = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    meta = cells.groupBy(*keys).agg(*aggs).where(F.col("n_cells") >= min_cells).withColumn("pseudobulk_id", named)
    kept = cells.select("obs_id", *keys).join(meta.select(*keys, "pseudobulk_id"), keys)
    counts = expr.join(kept.select("obs_id", "pseudobulk_id"), "obs_id").groupBy("pseudobulk_id", "var_id").agg(
        F.sum("value").alias("count")
    )
    summary = meta.groupBy("cell_type").agg(
        F.count(F.lit(1)).alias("n_pseudobulk_samples"), F.sum("n_cells").alias("total_cells")
    )
    return Pseudobulk(counts, meta, summary)


def contrast_samples(
    metadata: DataFrame, condition: str, ctrl: str, test: str, min_samples: int = 2
) -> tuple[DataFrame, int, int]:
    """Samples of the two contrast groups as (pseudobulk_id, is_test) with the group sizes."""
    require_columns(metadata, ["pseudobulk_id", condition], "metadata")
    label = F.col(condition).cast("string")
    kept = metadata.where(label.isin([str(ctrl), str(test)])).select(
        "pseudobulk_id", (label == str(test)).alias("is_test")
    )
    sizes = {r["is_test"]: r["n"] for r in kept.groupBy("is_test").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_ctrl, n_test = sizes.get(False, 0), sizes.get(True, 0)
    if min(n_ctrl, n_test) < min_samples:
        raise ValueError("not enough pseudobulk samples in one or both groups")
    return kept, n_ctrl, n_test


def expressed_genes(
    counts: DataFrame, samples: DataFrame, n_ctrl: int, n_test: int, min_count: int = 10, min_total: int = 15
) -> DataFrame:
    """Genes seen often enough in either contrast group and overall."""
    need = max(min(n_ctrl, n_test), 1)
    seen = counts.join(samples, "pseudobulk_id").groupBy("var_id").agg(
        F.count_if((F.col("count") >= min_count) & ~F.col("is_test")).alias("n_ctrl_expressed"),
        F.count_if((F.col("count") >= min_count) & F.col("is_test")).alias("n_test_expressed"),
        F.sum("count").alias("total_count"),
    )
    often = (F.col("n_ctrl_expressed") >= need) | (F.col("n_test_expressed") >= need)
    return seen.where(often & (F.col("total_count") >= min_total))


def log_cpm(counts: DataFrame, samples: DataFrame, genes: DataFrame, prior: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Stored entries' log-CPM and, per sample, the log-CPM every implicit zero takes.

    Returns ``(entries, zero_level)``: the dense matrix is described without being built.
    """
    kept = counts.join(genes.select("var_id"), "var_id", "left_semi").join(samples, "pseudobulk_id")
    libs = kept.groupBy("pseudobulk_id").agg(F.sum("count").alias("_lib"))
    n_genes = row_count(genes)
    depth = F.coalesce(F.when(F.col("_lib") > 0, F.col("_lib")), F.lit(1.0)) + F.lit(prior) * n_genes
    level = samples.join(libs, "pseudobulk_id", "left").select("pseudobulk_id", "is_test", depth.alias("depth"))
    cpm = lambda x: F.log2(x / F.col("depth") * F.lit(1e6))
    level = level.withColumn("zero_level", cpm(F.lit(prior)))
    entries = kept.drop("is_test").join(level, "pseudobulk_id").withColumn("log_cpm", cpm(F.col("count") + F.lit(prior)))
    return entries.select("pseudobulk_id", "is_test", "var_id", "log_cpm", "zero_level"), level


def welch_columns(m1: Column, v1: Column, n1, m0: Column, v0: Column, n0) -> dict[str, Column]:
    """t and Welch-Satterthwaite df of mean1 - mean0; df falls back to n - 2 on zero variance."""
    a, b = v1 / n1, v0 / n0
    t = (m1 - m0) / F.sqrt(F.greatest(a + b, F.lit(TINY)))
    n1, n0 = (n if isinstance(n, Column) else F.lit(n) for n in (n1, n0))
    den = a * a / F.greatest(n1 - 1, F.lit(1)) + b * b / F.greatest(n0 - 1, F.lit(1))
    df = F.when(den > 0, (a + b) * (a + b) / den).otherwise(F.greatest(n1 + n0 - 2, F.lit(1)).cast("double"))
    return {"t": t, "df": df}


def welch_contrast(
    counts: DataFrame, metadata: DataFrame, condition: str, ctrl: str, test: str,
    min_count: int = 10, min_total: int = 15, min_samples: int = 2, prior: float = 0.5,
) -> DataFrame:
    """Per gene logFC, logCPM, t and df; moments come from stored entries plus zero levels."""
    samples, n0, n1 = contrast_samples(metadata, condition, ctrl, test, min_samples)
    samples = cut(samples)
    counts = cut(counts.join(samples.select("pseudobulk_id"), "pseudobulk_id", "left_semi"))
    genes = cut(expressed_genes(counts, samples, n0, n1, min_count, min_total).select("var_id"))
    entries, level = log_cpm(counts, samples, genes, prior)
    y, z = F.col("log_cpm"), F.col("zero_level")
    base = level.groupBy().agg(
        F.sum(F.when(~F.col("is_test"), z)).alias("z1c"), F.sum(F.when(~F.col("is_test"), z * z)).alias("z2c"),
        F.sum(F.when(F.col("is_test"), z)).alias("z1t"), F.sum(F.when(F.col("is_test"), z * z)).alias("z2t"),
    ).head()
    gain, gain2 = y - z, y * y - z * z
    sums = entries.groupBy("var_id").agg(
        F.coalesce(F.sum(F.when(~F.col("is_test"), gain)), F.lit(0.0)).alias("s1c"),
        F.coalesce(F.sum(F.when(~F.col("is_test"), gain2)), F.lit(0.0)).alias("s2c"),
        F.coalesce(F.sum(F.when(F.col("is_test"), gain)), F.lit(0.0)).alias("s1t"),
        F.coalesce(F.sum(F.when(F.col("is_test"), gain2)), F.lit(0.0)).alias("s2t"),
    )
    s1c, s2c = F.col("s1c") + base["z1c"], F.col("s2c") + base["z2c"]
    s1t, s2t = F.col("s1t") + base["z1t"], F.col("s2t") + base["z2t"]
    var = lambda s1, s2, n: F.greatest(s2 - s1 * s1 / n, F.lit(0.0)) / max(n - 1, 1)
    shaped = sums.select(
        F.col("var_id").alias("gene"), (s1c / n0).alias("mc"), var(s1c, s2c, n0).alias("vc"), (s1t / n1).alias("mt"),
        var(s1t, s2t, n1).alias("vt"), ((s1c + s1t) / (n0 + n1)).alias("logCPM"),
    )
    stats = welch_columns(F.col("mt"), F.col("vt"), n1, F.col("mc"), F.col("vc"), n0)
    return shaped.select("gene", (F.col("mt") - F.col("mc")).alias("logFC"), "logCPM", stats["t"].alias("t"), stats["df"].alias("df"))


def welch_test(*args, **kwargs) -> DataFrame:
    """``welch_contrast`` with p-values and FDR, ordered by (PValue, gene)."""
    table = cut(welch_contrast(*args, **kwargs))
    table = cut(table.withColumn("PValue", F.coalesce(student_p("t", F.greatest(F.col("df"), F.lit(1.0))), F.lit(1.0))))
    return benjamini_hochberg(table, "PValue", out="FDR").orderBy("PValue", "gene")


def welch_by_type(
    counts: DataFrame, metadata: DataFrame, condition: str, ctrl: str, test: str,
    min_count: int = 10, min_total: int = 15, min_samples: int = 2, prior: float = 0.5,
) -> tuple[DataFrame, DataFrame]:
    """The Welch contrast of every cell type in one job, and (cell_type, n_ctrl, n_test, tested).

    As ``welch_contrast`` with ``cell_type`` as a key: group sizes, gene filter, library sizes and
    zero levels are those of the type.  Types with too few samples have no rows and ``tested`` false.
    """
    label = F.col(condition).cast("string")
    samples = metadata.where(label.isin([str(ctrl), str(test)])).select("cell_type", "pseudobulk_id", (label == str(test)).alias("is_test"))
    sizes = metadata.select("cell_type").distinct().join(
        samples.groupBy("cell_type").agg(F.count_if(~F.col("is_test")).alias("n_ctrl"), F.count_if("is_test").alias("n_test")), "cell_type", "left"
    ).na.fill(0, ["n_ctrl", "n_test"])
    sizes = cut(sizes.withColumn("tested", F.least("n_ctrl", "n_test") >= min_samples))
    samples = cut(samples.join(sizes.where("tested").drop("tested"), "cell_type"))
    held = cut(counts.join(samples, "pseudobulk_id"))
    often = F.count_if((F.col("count") >= min_count) & ~F.col("is_test")), F.count_if((F.col("count") >= min_count) & F.col("is_test"))
    seen = held.groupBy("cell_type", "var_id").agg(often[0].alias("c"), often[1].alias("t"), F.sum("count").alias("total"), F.first(F.least("n_ctrl", "n_test")).alias("need"))
    genes = cut(seen.where(((F.col("c") >= F.col("need")) | (F.col("t") >= F.col("need"))) & (F.col("total") >= min_total)).select("cell_type", "var_id"))
    kept = held.join(genes, ["cell_type", "var_id"])
    libs = kept.groupBy("pseudobulk_id").agg(F.sum("count").alias("lib"))
    room = genes.groupBy("cell_type").agg(F.count(F.lit(1)).alias("n_genes"))
    depth = F.coalesce(F.when(F.col("lib") > 0, F.col("lib")), F.lit(1.0)) + F.lit(prior) * F.col("n_genes")
    cpm = lambda x: F.log2(x / F.col("depth") * F.lit(1e6))
    level = cut(samples.join(libs, "pseudobulk_id", "left").join(room, "cell_type").select("cell_type", "pseudobulk_id", "is_test", depth.alias("depth")).withColumn("zero", cpm(F.lit(prior))))
    z, y = F.col("zero"), cpm(F.col("count") + F.lit(prior))
    split = lambda name, x: [F.coalesce(F.sum(F.when(F.col("is_test") == on, x)), F.lit(0.0)).alias(f"{name}{side}") for on, side in ((False, "c"), (True, "t"))]
    base = level.groupBy("cell_type").agg(*split("z1", z), *split("z2", z * z))
    sums = kept.drop("is_test").join(level.drop("cell_type"), "pseudobulk_id").groupBy("cell_type", "var_id").agg(*split("s1", y - z), *split("s2", y * y - z * z))
    all_ = sums.join(base, "cell_type").join(sizes, "cell_type")
    n = {"c": F.col("n_ctrl"), "t": F.col("n_test")}
    one = {g: F.col(f"s1{g}") + F.col(f"z1{g}") for g in "ct"}
    two = {g: F.col(f"s2{g}") + F.col(f"z2{g}") for g in "ct"}
    mean = {g: one[g] / n[g] for g in "ct"}
    var = {g: F.greatest(two[g] - one[g] * one[g] / n[g], F.lit(0.0)) / F.greatest(n[g] - 1, F.lit(1)) for g in "ct"}
    stats = welch_columns(mean["t"], var["t"], n["t"], mean["c"], var["c"], n["c"])
    table = all_.select(
        "cell_type", F.col("var_id").alias("gene"), (mean["t"] - mean["c"]).alias("logFC"), ((one["c"] + one["t"]) / (n["c"] + n["t"])).alias("logCPM"),
        stats["t"].alias("t"), stats["df"].alias("df"),
    )
    return table, sizes


def compare_contrasts(candidate: DataFrame, reference: DataFrame, score: str = "PValue", top_n: int = 100) -> DataFrame:
    """Rank correlation of logFC, top-n overlap and sign agreement of two result tables."""
    cand = candidate.select("gene", F.col("logFC").alias("a"), F.col(score).alias("pa"))
    ref = reference.select("gene", F.col("logFC").alias("b"), F.col(score).alias("pb"))
    both = cut(cand.join(ref, "gene"))
    ra = average_ranks(both, [], "a").select("a", F.col("avg_rank").alias("ra"))
    rb = average_ranks(both, [], "b").select("b", F.col("avg_rank").alias("rb"))
    sums = both.join(ra, "a").join(rb, "b").agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop("ra", "rb").alias("c"), F.var_pop("ra").alias("va"),
        F.var_pop("rb").alias("vb"), F.avg((F.signum("a") == F.signum("b")).cast("double")).alias("agree"),
    )
    top = lambda df, p: df.orderBy(p, "gene").limit(top_n).select("gene")
    left, right = top(cand, "pa"), top(ref, "pb")
    shared = left.join(right, "gene", "left_semi").agg(F.count(F.lit(1))).scalar()
    room = F.greatest(F.least(F.lit(top_n), row_count(left), row_count(right)), F.lit(1))
    return sums.select(
        F.col("n").alias("n_common_genes"),
        F.try_divide(F.col("c"), F.sqrt(F.col("va") * F.col("vb"))).alias("spearman_logfc"),
        F.lit(top_n).cast("bigint").alias("top_n"),
        (shared.cast("double") / room).alias("top_n_overlap_fraction"),
        F.col("agree").alias("logfc_sign_agreement"),
    )
