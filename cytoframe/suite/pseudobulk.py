"""Pseudobulk and differential-expression queries.

Orders play the cells here: each has one customer nation (sample), segment (cell type)
and priority (condition); genes are brand-by-type combinations.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from cytoframe.adapters import with_ctes
from cytoframe.operators import nbglm, pseudobulk as pb
from cytoframe.session import cut
from cytoframe.suite import query

CELLS = (
    "cells AS (SELECT o_orderkey AS obs_id, c_mktsegment AS cell_type, c_nationkey AS sample_id, o_orderpriority AS condition, "
    "o_orderstatus AS donor_id FROM orders JOIN customer ON o_custkey = c_custkey)"
)
OEXPR = (
    "oexpr AS (SELECT l_orderkey AS obs_id, concat(p_brand, '|', p_type) AS var_id, sum(l_quantity) AS value FROM lineitem "
    "JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"
)
META = (
    "meta AS (SELECT cell_type, sample_id, condition, count(*) AS n_cells, string_agg(DISTINCT donor_id, ';' ORDER BY donor_id) AS donor_id, "
    "concat_ws('|', cell_type, sample_id, condition) AS pseudobulk_id FROM cells GROUP BY 1, 2, 3 HAVING count(*) >= 20)"
)
COUNTS = (
    "cnt AS (SELECT pseudobulk_id, var_id, sum(value) AS count FROM oexpr JOIN cells USING (obs_id) JOIN meta USING (cell_type, sample_id, condition) GROUP BY 1, 2)"
)
BULK = [CELLS, OEXPR, META, COUNTS]
PAIR = [
    CELLS, OEXPR,
    "meta AS (SELECT DISTINCT concat_ws('|', sample_id, condition) AS pseudobulk_id, condition FROM cells)",
    "cnt AS (SELECT concat_ws('|', sample_id, condition) AS pseudobulk_id, var_id, sum(value) AS count FROM oexpr JOIN cells USING (obs_id) GROUP BY 1, 2)",
]


def cells(m):
    who = m.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return m.table("orders").join(who, "o_custkey").select(
        F.col("o_orderkey").alias("obs_id"), F.col("c_mktsegment").alias("cell_type"), F.col("c_nationkey").alias("sample_id"),
        F.col("o_orderpriority").alias("condition"), F.col("o_orderstatus").alias("donor_id"),
    )


def order_expr(m):
    parts = m.table("part").select(F.col("p_partkey").alias("l_partkey"), F.concat_ws("|", "p_brand", "p_type").alias("var_id"))
    return m.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(parts, "l_partkey").groupBy(
        F.col("l_orderkey").alias("obs_id"), "var_id"
    ).agg(F.sum("l_quantity").alias("value"))


def order_lines(m):
    """The lines behind ``order_expr`` as they are, for sums over more than one order: nothing is grouped by order first."""
    parts = m.table("part").select(F.col("p_partkey").alias("l_partkey"), F.concat_ws("|", "p_brand", "p_type").alias("var_id"))
    lines = m.table("lineitem").select(F.col("l_orderkey").alias("obs_id"), "l_partkey", F.col("l_quantity").alias("value"))
    return lines.join(parts, "l_partkey").select("obs_id", "var_id", "value")


def pairs(m):
    """Sample-by-condition pseudobulk over all cell types: (counts, metadata)."""
    pid = F.concat_ws("|", F.col("sample_id").cast("string"), "condition").alias("pseudobulk_id")
    tagged = cells(m).select("obs_id", pid, "condition")
    counts = order_lines(m).join(tagged.select("obs_id", "pseudobulk_id"), "obs_id").groupBy("pseudobulk_id", "var_id").agg(
        F.sum("value").alias("count")
    )
    return counts, tagged.select("pseudobulk_id", "condition").distinct()


@query("a07_pseudobulk_counts", with_ctes(*BULK, "SELECT * FROM cnt"))
def bulk_counts(m):
    return pb.pseudobulk(cells(m), order_expr(m)).counts


@query("a07_pseudobulk_metadata", with_ctes(*BULK, "SELECT * FROM meta"))
def bulk_meta(m):
    return pb.pseudobulk(cells(m), order_expr(m)).metadata


@query(
    "a07_pseudobulk_summary",
    with_ctes(*BULK, "SELECT cell_type, count(*) AS n_pseudobulk_samples, CAST(sum(n_cells) AS BIGINT) AS total_cells FROM meta GROUP BY 1"),
)
def bulk_summary(m):
    return pb.pseudobulk(cells(m), order_expr(m)).summary


SAMPLES = "smp AS (SELECT pseudobulk_id, condition = '5-LOW' AS is_test FROM meta WHERE condition IN ('1-URGENT', '5-LOW'))"
SIZES = "n AS (SELECT count(*) FILTER (NOT is_test) AS n0, count(*) FILTER (is_test) AS n1 FROM smp)"
KEPT = (
    "seen AS (SELECT var_id, count(*) FILTER (count >= {mc} AND NOT is_test) AS n_ctrl_expressed, count(*) FILTER (count >= {mc} AND is_test) AS n_test_expressed, "
    "sum(count) AS total_count FROM cnt JOIN smp USING (pseudobulk_id) GROUP BY 1), "
    "kept AS (SELECT seen.* FROM seen, n WHERE (n_ctrl_expressed >= least(n0, n1) OR n_test_expressed >= least(n0, n1)) AND total_count >= {mt})"
)


@query("p04_contrast_samples", with_ctes(*PAIR, SAMPLES, "SELECT * FROM smp"))
def contrast(m):
    return pb.contrast_samples(pairs(m)[1], "condition", "1-URGENT", "5-LOW")[0]


@query("p05_expressed_genes", with_ctes(*PAIR, SAMPLES, SIZES, KEPT.format(mc=10, mt=2000), "SELECT * FROM kept"))
def expressed(m):
    counts, meta = pairs(m)
    samples, a, b = pb.contrast_samples(meta, "condition", "1-URGENT", "5-LOW")
    return pb.expressed_genes(counts, samples, a, b, 10, 2000)


LOGCPM = [
    *PAIR, SAMPLES, SIZES, KEPT.format(mc=10, mt=15),
    "grid AS (SELECT pseudobulk_id, is_test, var_id, coalesce(count, 0.0) AS count FROM smp CROSS JOIN kept LEFT JOIN cnt USING (pseudobulk_id, var_id))",
    "lib AS (SELECT pseudobulk_id, CASE WHEN sum(count) > 0 THEN sum(count) ELSE 1.0 END AS lib, count(*) AS g FROM grid GROUP BY 1)",
    "cpm AS (SELECT pseudobulk_id, is_test, var_id, count, log2((count + 0.5) / (lib + 0.5 * g) * 1000000.0) AS log_cpm FROM grid JOIN lib USING (pseudobulk_id))",
]
WELCH = [
    *LOGCPM,
    "wm AS (SELECT var_id AS gene, avg(log_cpm) FILTER (is_test) AS mt, avg(log_cpm) FILTER (NOT is_test) AS mc, avg(log_cpm) AS logCPM, "
    "var_samp(log_cpm) FILTER (is_test) / n1 AS a, var_samp(log_cpm) FILTER (NOT is_test) / n0 AS b, n0, n1 FROM cpm, n GROUP BY 1, n0, n1)",
    "welch AS (SELECT gene, mt - mc AS logFC, logCPM, (mt - mc) / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n0 - 1)) AS df FROM wm)",
]


@query(
    "f04_log_cpm",
    with_ctes(*LOGCPM, "SELECT pseudobulk_id, is_test, var_id, round(log_cpm, 6) AS log_cpm FROM cpm WHERE count > 0"),
)
def log_cpm(m):
    counts, meta = pairs(m)
    samples, a, b = pb.contrast_samples(meta, "condition", "1-URGENT", "5-LOW")
    genes = pb.expressed_genes(counts, samples, a, b)
    entries, _ = pb.log_cpm(counts, samples, genes)
    return entries.select("pseudobulk_id", "is_test", "var_id", F.round("log_cpm", 6).alias("log_cpm"))


def _round_welch(df):
    return df.select("gene", *[F.round(c, 5).alias(c) for c in ("logFC", "logCPM", "t", "df")])


@query(
    "d04_welch_logcpm",
    with_ctes(*WELCH, "SELECT gene, round(logFC, 5) AS logFC, round(logCPM, 5) AS logCPM, round(t, 5) AS t, round(df, 5) AS df FROM welch"),
)
def welch(m):
    return _round_welch(pb.welch_contrast(*pairs(m), "condition", "1-URGENT", "5-LOW"))


@query("d04_welch_test")
def welch_test(m):
    return pb.welch_test(*pairs(m), "condition", "1-URGENT", "5-LOW")


def _again(sql: str) -> str:
    """The same CTE chain under new names for a second contrast."""
    renamed = re.sub(r"\b(smp|n|seen|kept|grid|lib|cpm|wm|welch)\b(?! AS (?:c|g)\b)", r"\g<1>_2", sql)
    return renamed.replace("lib_2 +", "lib +").replace("AS lib_2,", "AS lib,").replace("END AS lib_2", "END AS lib").replace("1-URGENT", "2-HIGH")


_SECOND = [_again(s) for s in WELCH[len(PAIR):]]


@query(
    "j08_compare_contrasts",
    with_ctes(
        *WELCH, *_SECOND,
        "bth AS (SELECT gene, a.logFC AS a, b.logFC AS b, a.t AS ta, b.t AS tb FROM welch a JOIN welch_2 b USING (gene))",
        "rk AS (SELECT *, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM bth)",
        "SELECT count(*) AS n_common_genes, round(corr(ra, rb), 6) AS spearman_logfc, CAST(20 AS BIGINT) AS top_n, "
        "(SELECT count(*) FROM (SELECT gene FROM welch ORDER BY abs(t) DESC, gene LIMIT 20) JOIN (SELECT gene FROM welch_2 ORDER BY abs(t) DESC, gene LIMIT 20) USING (gene)) / CAST(20 AS DOUBLE) AS top_n_overlap_fraction, "
        "avg(CAST(sign(a) = sign(b) AS DOUBLE)) AS logfc_sign_agreement FROM rk",
    ),
)
def compare(m):
    counts, meta = pairs(m)
    counts = cut(counts)
    one = pb.welch_contrast(counts, meta, "condition", "1-URGENT", "5-LOW").withColumn("score", -F.abs("t"))
    two = pb.welch_contrast(counts, meta, "condition", "2-HIGH", "5-LOW").withColumn("score", -F.abs("t"))
    out = pb.compare_contrasts(one, two, score="score", top_n=20)
    return out.withColumn("spearman_logfc", F.round("spearman_logfc", 6))


SF = [
    *PAIR, SAMPLES,
    "dat AS (SELECT cnt.* FROM cnt JOIN smp USING (pseudobulk_id) WHERE var_id IN (SELECT var_id FROM cnt JOIN smp USING (pseudobulk_id) GROUP BY 1 HAVING sum(count) >= 10))",
    "geo AS (SELECT var_id, exp(avg(ln(count))) AS geo FROM dat WHERE count > 0 GROUP BY 1 HAVING count(*) = (SELECT count(*) FROM smp))",
    "med AS (SELECT pseudobulk_id, median(count / geo) AS sf FROM dat JOIN geo USING (var_id) GROUP BY 1)",
    "sf AS (SELECT pseudobulk_id, sf / (SELECT exp(avg(ln(sf))) FROM med) AS size_factor FROM med)",
]


@query("d06_size_factors", with_ctes(*SF, "SELECT pseudobulk_id, round(size_factor, 8) AS size_factor FROM sf"))
def size_factors(m):
    return nbglm.prepare(*pairs(m), "condition", "1-URGENT", "5-LOW")[2].withColumn("size_factor", F.round("size_factor", 8))


@query(
    "d07_d08_start_dispersions",
    with_ctes(
        *SF,
        "g AS (SELECT var_id, is_test, coalesce(count, 0.0) / size_factor AS y FROM (SELECT DISTINCT var_id FROM dat) CROSS JOIN smp JOIN sf USING (pseudobulk_id) LEFT JOIN dat USING (var_id, pseudobulk_id))",
        "mm AS (SELECT var_id, avg(y) AS mean, var_samp(y) AS v, greatest(avg(y) FILTER (is_test), 1.0) AS mt, greatest(avg(y) FILTER (NOT is_test), 1.0) AS mc, count(*) AS m FROM g GROUP BY 1)",
        "rr AS (SELECT var_id, sum(((y - CASE WHEN is_test THEN mt ELSE mc END) * (y - CASE WHEN is_test THEN mt ELSE mc END) - CASE WHEN is_test THEN mt ELSE mc END) / "
        "(CASE WHEN is_test THEN mt * mt ELSE mc * mc END)) / (m - 2) AS rough FROM g JOIN mm USING (var_id) GROUP BY 1, m)",
        "SELECT var_id, round(mean, 6) AS base_mean, round(greatest((v - mean) / (mean * mean), 1e-8), 6) AS disp_moments, "
        "round(greatest(least(greatest(rough, 0.0), greatest((v - mean) / (mean * mean), 1e-8)), 1e-8), 6) AS disp_init FROM mm JOIN rr USING (var_id)",
    ),
)
def start(m):
    vectors, d, _ = nbglm.prepare(*pairs(m), "condition", "1-URGENT", "5-LOW")
    return nbglm.gene_fits(vectors, d, with_mle=False).select(
        "var_id", *[F.round(c, 6).alias(c) for c in ("base_mean", "disp_moments", "disp_init")]
    )


@query("d11_gene_dispersions")
def gene_dispersions(m):
    vectors, d, _ = nbglm.prepare(*pairs(m), "condition", "1-URGENT", "5-LOW")
    return nbglm.gene_fits(vectors, d).select("var_id", "base_mean", "beta0", "beta1", "disp_gene")


@query("d09_d10_trend_and_prior")
def trend(m):
    vectors, d, _ = nbglm.prepare(*pairs(m), "condition", "1-URGENT", "5-LOW")
    fits = cut(nbglm.gene_fits(vectors, d))
    fitted = nbglm.add_trend(fits, nbglm.fit_trend(fits))
    prior, spread = nbglm.residual_spread(fitted, len(d.x))
    return fitted.select("var_id", "disp_gene", "disp_fit", F.lit(prior).alias("prior_var"), F.lit(spread).alias("log_resid_var"))


@query("d05_nb_wald")
def nb_wald(m):
    return nbglm.nb_wald(*pairs(m), "condition", "1-URGENT", "5-LOW")


BY_TYPE = [
    *BULK,
    "smp AS (SELECT cell_type, pseudobulk_id, condition = '5-LOW' AS is_test FROM meta WHERE condition IN ('1-URGENT', '5-LOW'))",
    "n AS (SELECT cell_type, count(*) FILTER (NOT is_test) AS n0, count(*) FILTER (is_test) AS n1 FROM smp GROUP BY 1 HAVING least(n0, n1) >= 2)",
    "kept AS (SELECT cell_type, var_id FROM cnt JOIN smp USING (pseudobulk_id) JOIN n USING (cell_type) GROUP BY cell_type, var_id, n0, n1 "
    "HAVING (count(*) FILTER (count >= 10 AND NOT is_test) >= least(n0, n1) OR count(*) FILTER (count >= 10 AND is_test) >= least(n0, n1)) AND sum(count) >= 15)",
    "grid AS (SELECT cell_type, pseudobulk_id, is_test, var_id, coalesce(count, 0.0) AS count FROM smp JOIN kept USING (cell_type) LEFT JOIN cnt USING (pseudobulk_id, var_id))",
    "lib AS (SELECT pseudobulk_id, CASE WHEN sum(count) > 0 THEN sum(count) ELSE 1.0 END AS lib, count(*) AS g FROM grid GROUP BY 1)",
    "cpm AS (SELECT cell_type, is_test, var_id, log2((count + 0.5) / (lib + 0.5 * g) * 1000000.0) AS y FROM grid JOIN lib USING (pseudobulk_id))",
    "wm AS (SELECT cell_type, var_id AS gene, avg(y) FILTER (is_test) AS mt, avg(y) FILTER (NOT is_test) AS mc, avg(y) AS logCPM, "
    "var_samp(y) FILTER (is_test) / n1 AS a, var_samp(y) FILTER (NOT is_test) / n0 AS b, n0, n1 FROM cpm JOIN n USING (cell_type) GROUP BY cell_type, var_id, n0, n1)",
]


SF_TYPE = [
    *BULK,
    "smp AS (SELECT cell_type, pseudobulk_id, condition = '5-LOW' AS is_test FROM meta WHERE condition IN ('1-URGENT', '5-LOW'))",
    "n AS (SELECT cell_type, count(*) FILTER (NOT is_test) AS n0, count(*) FILTER (is_test) AS n1 FROM smp GROUP BY 1 HAVING least(n0, n1) >= 2)",
    "dat AS (SELECT s.cell_type, c.* FROM cnt c JOIN smp s USING (pseudobulk_id) JOIN n USING (cell_type) QUALIFY sum(c.count) OVER (PARTITION BY s.cell_type, c.var_id) >= 10)",
    "geo AS (SELECT cell_type, var_id, exp(avg(ln(count))) AS geo, count(*) = n0 + n1 AS whole FROM dat JOIN n USING (cell_type) GROUP BY cell_type, var_id, n0, n1)",
    "used AS (SELECT * FROM geo QUALIFY whole OR NOT bool_or(whole) OVER (PARTITION BY cell_type))",
    "med AS (SELECT cell_type, pseudobulk_id, median(count / geo) AS sf FROM dat JOIN used USING (cell_type, var_id) GROUP BY 1, 2)",
    "lib AS (SELECT cell_type, pseudobulk_id, sum(count) AS lib FROM dat GROUP BY 1, 2)",
    "raw AS (SELECT s.cell_type, s.pseudobulk_id, CASE WHEN bool_or(coalesce(sf, 0.0) <= 0) OVER (PARTITION BY s.cell_type) THEN coalesce(lib, 1e-8) ELSE sf END AS sf "
    "FROM smp s JOIN n USING (cell_type) LEFT JOIN med USING (cell_type, pseudobulk_id) LEFT JOIN lib USING (cell_type, pseudobulk_id))",
    "sf AS (SELECT cell_type, pseudobulk_id, sf / exp(avg(ln(sf)) OVER (PARTITION BY cell_type)) AS size_factor FROM raw)",
]


def by_type_args(m):
    bulk = pb.pseudobulk(cells(m), order_lines(m))
    return cut(bulk.counts), cut(bulk.metadata), "condition", "1-URGENT", "5-LOW"


@query("d06_size_factors_by_type", with_ctes(*SF_TYPE, "SELECT cell_type, pseudobulk_id, round(size_factor, 8) AS size_factor FROM sf"))
def size_factors_by_type(m):
    data, samples, _ = nbglm.contrast_by_type(*by_type_args(m))
    return nbglm.size_factors_by_type(data, samples).withColumn("size_factor", F.round("size_factor", 8))


@query(
    "d07_d08_start_dispersions_by_type",
    with_ctes(
        *SF_TYPE,
        "g AS (SELECT cell_type, var_id, is_test, coalesce(count, 0.0) / size_factor AS y FROM (SELECT DISTINCT cell_type, var_id FROM dat) JOIN smp USING (cell_type) "
        "JOIN sf USING (cell_type, pseudobulk_id) LEFT JOIN dat USING (cell_type, var_id, pseudobulk_id))",
        "mm AS (SELECT cell_type, var_id, avg(y) AS mean, var_samp(y) AS v, greatest(avg(y) FILTER (is_test), 1.0) AS mt, greatest(avg(y) FILTER (NOT is_test), 1.0) AS mc, count(*) AS m FROM g GROUP BY 1, 2)",
        "rr AS (SELECT cell_type, var_id, sum(((y - CASE WHEN is_test THEN mt ELSE mc END) * (y - CASE WHEN is_test THEN mt ELSE mc END) - CASE WHEN is_test THEN mt ELSE mc END) / "
        "(CASE WHEN is_test THEN mt * mt ELSE mc * mc END)) / greatest(m - 2, 1) AS rough FROM g JOIN mm USING (cell_type, var_id) GROUP BY cell_type, var_id, m)",
        "SELECT cell_type, var_id, round(mean, 6) AS base_mean, round(greatest((v - mean) / (mean * mean), 1e-8), 6) AS disp_moments, "
        "round(greatest(least(greatest(rough, 0.0), greatest((v - mean) / (mean * mean), 1e-8)), 1e-8), 6) AS disp_init FROM mm JOIN rr USING (cell_type, var_id)",
    ),
)
def start_by_type(m):
    vectors, _ = nbglm.prepare_by_type(*by_type_args(m))
    return nbglm.gene_fits(vectors, None, with_mle=False).select(
        "cell_type", "var_id", *[F.round(c, 6).alias(c) for c in ("base_mean", "disp_moments", "disp_init")]
    )


@query("d05_d15_nb_wald_by_type")
def nb_wald_by_type(m):
    """The negative-binomial contrast of all cell types in the same jobs."""
    return nbglm.nb_wald_by_type(*by_type_args(m))[0]


@query(
    "d15_contrast_by_type",
    with_ctes(
        *BY_TYPE,
        "SELECT cell_type, gene, round(mt - mc, 5) AS logFC, round(logCPM, 5) AS logCPM, round((mt - mc) / sqrt(a + b), 5) AS t, "
        "round((a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n0 - 1)), 5) AS df FROM wm",
    ),
)
def by_type(m):
    """All cell types in one job."""
    bulk = pb.pseudobulk(cells(m), order_expr(m))
    table, _ = pb.welch_by_type(bulk.counts, bulk.metadata, "condition", "1-URGENT", "5-LOW")
    return table.select("cell_type", "gene", *[F.round(c, 5).alias(c) for c in ("logFC", "logCPM", "t", "df")])


@query("contrast_run")
def contrast_run(m):
    from cytoframe.plans.workflows import run_contrast

    return run_contrast(cells(m), order_expr(m), "1-URGENT", "5-LOW", method="welch")[0]
