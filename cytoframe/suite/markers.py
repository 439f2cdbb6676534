"""Marker queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.adapters import EXPR, OBS, VAR, with_ctes
from cytoframe.functions.ordered import average_ranks, benjamini_hochberg
from cytoframe.operators import markers as mk
from cytoframe.suite import query

LAB = "lab AS (SELECT obs_id, cluster AS grp FROM obs)"
SIZE = "sz AS (SELECT grp, count(*) AS n_in FROM lab GROUP BY 1), nc AS (SELECT count(*) AS n_cells FROM lab)"
SUMM = (
    "per AS (SELECT var_id, grp, sum(value) AS group_sum, count(*) AS group_nnz, sum(value * value) AS sq FROM expr JOIN lab USING (obs_id) GROUP BY 1, 2), "
    "gene AS (SELECT var_id, sum(group_sum) AS total_sum, CAST(sum(group_nnz) AS BIGINT) AS total_nnz, sqrt(sum(sq)) AS norm FROM per GROUP BY 1)"
)
RATES = (
    "rates AS (SELECT *, group_nnz / CAST(n_in AS DOUBLE) AS pct_in, (total_nnz - group_nnz) / CAST(n_cells - n_in AS DOUBLE) AS pct_out, "
    "group_sum / n_in AS mean_in, (total_sum - group_sum) / (n_cells - n_in) AS mean_out FROM {src} JOIN sz USING (grp), nc)"
)
MARKER_COLS = (
    "round(pct_in, 6) AS pct_in, round(pct_out, 6) AS pct_out, round(mean_in, 6) AS mean_in, round(mean_out, 6) AS mean_out, "
    "round(mean_in - mean_out, 6) AS mean_diff"
)
ROUND = ("score", "pct_in", "pct_out", "mean_in", "mean_out", "mean_diff")


def labels(m):
    return m.obs.select("obs_id", F.col("cluster").alias("grp"))


def tidy(df):
    return df.withColumns({c: F.round(c, 6) for c in ROUND})


@query(
    "a10_group_summaries",
    with_ctes(
        OBS, EXPR, LAB, SUMM,
        "SELECT var_id, grp, group_sum, group_nnz, total_sum, total_nnz, round(norm, 6) AS norm FROM per JOIN gene USING (var_id)",
    ),
)
def summaries(m):
    return mk.group_summaries(m.expr, labels(m)).withColumn("norm", F.round("norm", 6))


COSG_SQL = (
    "SELECT grp, rank, var_id AS gene, round(score, 6) AS score, " + MARKER_COLS + " FROM (SELECT *, row_number() OVER "
    "(PARTITION BY grp ORDER BY score DESC, var_id) AS rank FROM (SELECT *, group_sum / (norm * sqrt(n_in)) AS score FROM rates "
    "WHERE pct_in >= {pct})) WHERE rank <= {top}"
)


@query(
    "d01_cosg",
    with_ctes(OBS, EXPR, LAB, SIZE, SUMM, RATES.format(src="(SELECT * FROM per JOIN gene USING (var_id))"), COSG_SQL.format(pct=0.05, top=10)),
)
def cosg(m):
    return tidy(mk.cosg(m.expr, labels(m), top_n=10))


@query(
    "d01_cosg_all_genes",
    with_ctes(
        OBS, EXPR, LAB, SIZE, SUMM,
        "grid AS (SELECT gene.*, grp, coalesce(group_sum, 0.0) AS group_sum, coalesce(group_nnz, 0) AS group_nnz FROM gene CROSS JOIN sz "
        "LEFT JOIN per USING (var_id, grp))",
        RATES.format(src="grid"), COSG_SQL.format(pct=0.0, top=100),
    ),
)
def cosg_all(m):
    return tidy(mk.cosg(m.expr, labels(m), top_n=100, min_pct=0.0))


@query(
    "w03_cosg_parts",
    with_ctes(
        OBS, EXPR.replace("p_brand", "p_partkey"), LAB, SIZE, SUMM,
        RATES.format(src="(SELECT * FROM per JOIN gene USING (var_id))"), COSG_SQL.format(pct=0.01, top=25),
    ),
)
def cosg_parts(m):
    return tidy(mk.cosg(m.expr_part, labels(m), top_n=25, min_pct=0.01))


@query(
    "w05_average_ranks",
    with_ctes(
        EXPR,
        "SELECT DISTINCT var_id, value, count(*) OVER (PARTITION BY var_id, value) AS w, CAST(rank() OVER (PARTITION BY var_id ORDER BY value) "
        "+ (count(*) OVER (PARTITION BY var_id, value) - 1) / 2.0 AS DOUBLE) AS avg_rank FROM expr",
    ),
)
def ranks(m):
    return average_ranks(m.expr, ["var_id"], "value")


WILCOX = [
    OBS, EXPR, LAB, SIZE, SUMM, RATES.format(src="(SELECT * FROM per JOIN gene USING (var_id))"),
    "rk AS (SELECT var_id, grp, rank() OVER w + (count(*) OVER (PARTITION BY var_id, value) - 1) / CAST(2 AS DOUBLE) AS r FROM expr JOIN lab USING (obs_id) "
    "WINDOW w AS (PARTITION BY var_id ORDER BY value))",
    "rs AS (SELECT var_id, grp, sum(r) AS rsum FROM rk GROUP BY 1, 2)",
    "zz AS (SELECT rates.*, (rsum + group_nnz * (n_cells - total_nnz) + (n_in - group_nnz) * (n_cells - total_nnz + 1) / CAST(2 AS DOUBLE) "
    "- n_in * (n_cells + 1) / CAST(2 AS DOUBLE)) / sqrt(CAST(n_in AS DOUBLE) * (n_cells - n_in) * (n_cells + 1) / CAST(12 AS DOUBLE)) AS z "
    "FROM rates JOIN rs USING (var_id, grp) WHERE pct_in >= 0.05)",
]


@query(
    "d02_wilcoxon_z",
    with_ctes(*WILCOX, "SELECT var_id, grp, round(z, 6) AS z, " + MARKER_COLS + " FROM zz"),
)
def wilcoxon_z(m):
    out = mk.rank_sum_z(m.expr, labels(m))
    cols = ["z", "pct_in", "pct_out", "mean_in", "mean_out", "mean_diff"]
    return out.select("var_id", "grp", *[F.round(c, 6).alias(c) for c in cols])


@query(
    "w04_wilcoxon_rank",
    with_ctes(
        *WILCOX,
        "SELECT grp, rank, var_id AS gene, round(z, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY z DESC, var_id) AS rank FROM zz) WHERE rank <= 10",
    ),
)
def wilcoxon_rank(m):
    return mk.wilcoxon(m.expr, labels(m), m.var, top_n=10).select("grp", "rank", "gene", F.round("score", 6).alias("score"))


@query("d02_wilcoxon")
def wilcoxon(m):
    return mk.wilcoxon(m.expr, labels(m), m.var, top_n=25)


BH = (
    "SELECT o_orderkey, {cols}min(raw) OVER ({part}ORDER BY p DESC, r DESC ROWS UNBOUNDED PRECEDING) AS padj FROM (SELECT *, least(p * n / r, 1.0) AS raw FROM "
    "(SELECT o_orderkey, {cols}o_totalprice / 600000.0 AS p, row_number() OVER ({part}ORDER BY o_totalprice, o_orderkey) AS r, count(*) OVER ({over}) AS n FROM orders))"
)


@query("w01_bh", BH.format(cols="", part="", over=""))
def bh(m):
    t = m.table("orders").select("o_orderkey", (F.col("o_totalprice") / 600000.0).alias("p"))
    return benjamini_hochberg(t, "p").select("o_orderkey", "padj")


@query("w01_bh_grouped", BH.format(cols="o_orderpriority, ", part="PARTITION BY o_orderpriority ", over="PARTITION BY o_orderpriority"))
def bh_grouped(m):
    t = m.table("orders").select("o_orderkey", "o_orderpriority", (F.col("o_totalprice") / 600000.0).alias("p"))
    return benjamini_hochberg(t, "p", ["o_orderpriority"]).select("o_orderkey", "o_orderpriority", "padj")
