"""Matrix reductions, scaling and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.adapters import EXPR, OBS, VAR, with_ctes
from cytoframe.operators import matrix as mx
from cytoframe.suite import query

NCELL = "nc AS (SELECT count(*) AS n FROM obs)"
MOMENTS = (
    "mom AS (SELECT var_id, nnz, n AS n_cells, s1 / n AS mean, greatest(s2 - n * (s1 / n) * (s1 / n), 0.0) / n AS var_pop, "
    "greatest(s2 - n * (s1 / n) * (s1 / n), 0.0) / (n - 1) AS var_samp FROM (SELECT var_id, sum(value) AS s1, sum(value * value) AS s2, "
    "count(*) AS nnz FROM {src} GROUP BY 1), nc)"
)
NORM = (
    "norm AS (SELECT obs_id, var_id, ln(1 + value * 10000.0 / total) AS value FROM expr JOIN "
    "(SELECT obs_id, sum(value) AS total FROM expr GROUP BY 1) USING (obs_id))"
)
SCALED = (
    "scaled AS (SELECT obs_id, var_id, value / CASE WHEN sqrt(var_samp) > 0 THEN sqrt(var_samp) ELSE 1.0 END AS value "
    "FROM expr JOIN mom USING (var_id))"
)


def open_expr(m):
    """Second matrix: the same counts over open line items only."""
    lines = m.table("lineitem").where(F.col("l_linestatus") == "O").select("l_orderkey", "l_partkey", "l_quantity")
    orders = m.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    parts = m.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return (
        lines.join(orders, "l_orderkey").join(parts, "l_partkey")
        .groupBy(F.col("o_custkey").alias("obs_id"), F.col("p_brand").alias("var_id")).agg(F.sum("l_quantity").alias("value"))
    )


OPEN = (
    "expr_open AS (SELECT o_custkey AS obs_id, p_brand AS var_id, sum(l_quantity) AS value FROM lineitem JOIN orders "
    "ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'O' GROUP BY 1, 2)"
)


@query("a01_cell_sums", with_ctes(EXPR, "SELECT obs_id, sum(value) AS total, count(*) AS nnz FROM expr GROUP BY 1"))
def cell_sums(m):
    return mx.cell_sums(m.expr)


@query("a01_gene_sums", with_ctes(EXPR, "SELECT var_id, sum(value) AS total, count(*) AS nnz FROM expr GROUP BY 1"))
def gene_sums(m):
    return mx.gene_sums(m.expr)


@query(
    "a01_subset_gene_sum",
    with_ctes(
        OBS, EXPR, VAR,
        "SELECT obs.obs_id, coalesce(sum(value), 0.0) AS subset_total FROM obs LEFT JOIN (SELECT * FROM expr WHERE var_id IN "
        "(SELECT var_id FROM var WHERE symbol LIKE 'RP%')) e ON e.obs_id = obs.obs_id GROUP BY 1",
    ),
)
def subset_sum(m):
    return mx.subset_sums(m.obs, m.expr, m.var.where(F.col("symbol").startswith("RP")))


@query(
    "a15_gene_moments",
    with_ctes(
        OBS, EXPR, NCELL, MOMENTS.format(src="expr"),
        "SELECT var_id, nnz, n_cells, round(mean, 6) AS mean, round(var_pop, 6) AS var_pop, round(sqrt(var_pop), 6) AS std_pop FROM mom",
    ),
)
def moments(m):
    return mx.gene_moments(m.expr, m.obs).select(
        "var_id", "nnz", "n_cells", F.round("mean", 6).alias("mean"), F.round("var_pop", 6).alias("var_pop"),
        F.round(F.sqrt("var_pop"), 6).alias("std_pop"),
    )


@query(
    "a16_scale_no_center",
    with_ctes(OBS, EXPR, NCELL, MOMENTS.format(src="expr"), SCALED, "SELECT obs_id, var_id, round(value, 6) AS value FROM scaled"),
)
def scale(m):
    return mx.scale_no_center(m.expr, m.obs).withColumn("value", F.round("value", 6))


@query(
    "f26_quantile_ceiling",
    with_ctes(
        OBS, VAR, EXPR, NCELL, MOMENTS.format(src="expr"), SCALED,
        "top AS (SELECT quantile_cont(coalesce(value, 0.0), 0.99) AS t FROM obs CROSS JOIN var LEFT JOIN scaled USING (obs_id, var_id))",
        "SELECT obs_id, var_id, round(least(value, t), 6) AS value FROM scaled, top",
    ),
)
def ceiling(m):
    scaled = mx.scale_no_center(m.expr, m.obs)
    return mx.clip_at_quantile(scaled, m.obs, m.var, 0.99).withColumn("value", F.round("value", 6))


@query("f01_log1p_norm", with_ctes(EXPR, NORM, "SELECT obs_id, var_id, round(value, 6) AS value FROM norm"))
def log_norm(m):
    return mx.log_normalize(m.expr).withColumn("value", F.round("value", 6))


@query(
    "o09_top_variable",
    with_ctes(
        OBS, EXPR, NORM, NCELL, MOMENTS.format(src="norm"),
        "SELECT var_id, round(var_pop, 6) AS variance FROM mom ORDER BY var_pop DESC, var_id LIMIT 10",
    ),
)
def top_variable(m):
    return mx.top_variable(mx.log_normalize(m.expr), m.obs, 10).withColumn("variance", F.round("variance", 6))


@query("p08_nonnegative", with_ctes(EXPR, "SELECT var_id, min(value) AS low FROM expr WHERE value >= 0 GROUP BY 1"))
def nonneg(m):
    return mx.require_nonnegative(m.expr).groupBy("var_id").agg(F.min("value").alias("low"))


BATCH = [
    OBS, EXPR, NCELL,
    "sz AS (SELECT sample_id, count(*) AS spots FROM obs GROUP BY 1)",
    "sm AS (SELECT sample_id, var_id, sum(value) AS s FROM expr JOIN obs USING (obs_id) GROUP BY 1, 2)",
    "gm AS (SELECT var_id, sum(s) AS al FROM sm GROUP BY 1)",
    "rt AS (SELECT sample_id, var_id, spots, (al / n) / (s / spots) AS ratio FROM sm JOIN gm USING (var_id) JOIN sz USING (sample_id), nc WHERE s > 0)",
]


@query(
    "a20_sample_scaling",
    with_ctes(
        *BATCH,
        "SELECT obs_id, var_id, round(value * ratio, 6) AS value FROM expr JOIN obs USING (obs_id) JOIN rt USING (sample_id, var_id)",
    ),
)
def sample_scaling(m):
    return mx.scale_samples_to_global(m.expr, m.obs)[0].withColumn("value", F.round("value", 6))


@query(
    "a20_sample_scaling_summary",
    with_ctes(
        *BATCH,
        "SELECT sample_id, max(spots) AS spots, count(*) AS genes_with_nonzero_sample_mean, "
        "round(median(ratio), 6) AS median_nonzero_scaling_ratio FROM rt GROUP BY 1",
    ),
)
def sample_scaling_summary(m):
    return mx.scale_samples_to_global(m.expr, m.obs)[1].withColumn(
        "median_nonzero_scaling_ratio", F.round("median_nonzero_scaling_ratio", 6)
    )


@query(
    "a19_matrix_agreement",
    with_ctes(
        OBS, VAR, EXPR, OPEN,
        "b AS (SELECT coalesce(e.value, 0.0) AS a, coalesce(o.value, 0.0) AS b FROM obs CROSS JOIN var LEFT JOIN expr e USING (obs_id, var_id) "
        "LEFT JOIN expr_open o USING (obs_id, var_id))",
        "SELECT round(sum(a * b) / greatest(sqrt(sum(a * a)) * sqrt(sum(b * b)), 1e-12), 6) AS cosine, round(corr(a, b), 6) AS pearson, "
        "round(sqrt(sum((a - b) * (a - b)) / count(*)), 6) AS rmse, round(sum(abs(a - b)) / count(*), 6) AS mean_abs, count(*) AS n_values FROM b",
    ),
)
def agreement(m):
    out = mx.compare_matrices(m.expr, open_expr(m), mx.row_count(m.obs) * mx.row_count(m.var))
    return out.withColumns({c: F.round(c, 6) for c in ("cosine", "pearson", "rmse", "mean_abs")})


@query(
    "u03_axis_overlap",
    with_ctes(
        EXPR, OPEN,
        "SELECT k AS axis, n_common, n_union, n_common / CAST(n_union AS DOUBLE) AS jaccard FROM ("
        "SELECT 'obs_id' AS k, (SELECT count(*) FROM (SELECT obs_id FROM expr INTERSECT SELECT obs_id FROM expr_open)) AS n_common, "
        "(SELECT count(*) FROM (SELECT obs_id FROM expr UNION SELECT obs_id FROM expr_open)) AS n_union UNION ALL "
        "SELECT 'var_id', (SELECT count(*) FROM (SELECT var_id FROM expr INTERSECT SELECT var_id FROM expr_open)), "
        "(SELECT count(*) FROM (SELECT var_id FROM expr UNION SELECT var_id FROM expr_open)))",
    ),
)
def overlap(m):
    other = open_expr(m)
    return mx.axis_overlap(m.expr, other, "obs_id").unionByName(mx.axis_overlap(m.expr, other, "var_id"))
