"""Comparing two program sets: segments as programs, nations as cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.adapters import EXPR, OBS, with_ctes
from cytoframe.operators import programs as pg
from cytoframe.session import cut
from cytoframe.suite import query
from cytoframe.suite.matrices import OPEN, open_expr

SETS = [
    OBS, EXPR, OPEN,
    "ra AS (SELECT cluster AS program, var_id, sum(value) AS w FROM expr JOIN obs USING (obs_id) GROUP BY 1, 2)",
    "rb AS (SELECT cluster AS program, var_id, sum(value) AS w FROM expr_open JOIN obs USING (obs_id) GROUP BY 1, 2)",
    "ua AS (SELECT sample_id AS obs_id, cluster AS program, sum(value) AS u FROM expr JOIN obs USING (obs_id) GROUP BY 1, 2)",
    "ub AS (SELECT sample_id AS obs_id, cluster AS program, sum(value) AS u FROM expr_open JOIN obs USING (obs_id) GROUP BY 1, 2)",
    "co AS (SELECT a.program AS reference_program, b.program AS candidate_program, sum(a.w * b.w) / (sqrt((SELECT sum(w * w) FROM ra x WHERE x.program = a.program)) * sqrt((SELECT sum(w * w) FROM rb y WHERE y.program = b.program))) AS cosine "
    "FROM ra a JOIN rb b USING (var_id) GROUP BY 1, 2)",
]
SAME = "(SELECT DISTINCT program AS p FROM ra)"


def spectra(m, expr):
    return expr.join(m.obs.select("obs_id", "cluster"), "obs_id").groupBy(F.col("cluster").alias("program"), "var_id").agg(F.sum("value").alias("w"))


def usages(m, expr):
    return expr.join(m.obs.select("obs_id", "sample_id", "cluster"), "obs_id").groupBy(F.col("sample_id").alias("obs_id"), F.col("cluster").alias("program")).agg(F.sum("value").alias("u"))


def same(m):
    return m.obs.select(F.col("cluster").alias("reference_program"), F.col("cluster").alias("candidate_program")).distinct()


@query("f06_program_cosines", with_ctes(*SETS, "SELECT reference_program, candidate_program, round(cosine, 8) AS cosine FROM co"))
def cosines(m):
    return pg.program_cosines(spectra(m, m.expr), spectra(m, open_expr(m))).withColumn("cosine", F.round("cosine", 8))


@query(
    "f07_usage_pearson",
    with_ctes(
        *SETS,
        "SELECT ua.program AS reference_program, ua.program AS candidate_program, round(corr(ua.u, coalesce(ub.u, 0)), 6) AS usage_pearson FROM ua LEFT JOIN ub ON ua.obs_id = ub.obs_id AND ua.program = ub.program GROUP BY 1, 2",
    ),
)
def pearson(m):
    return pg.usage_pearson(usages(m, m.expr), usages(m, open_expr(m)), same(m)).withColumn("usage_pearson", F.round("usage_pearson", 6))


@query(
    "o05_top_gene_jaccard",
    with_ctes(
        *SETS,
        "ta AS (SELECT program, var_id FROM ra QUALIFY row_number() OVER (PARTITION BY program ORDER BY w DESC, var_id) <= 10)",
        "tb AS (SELECT program, var_id FROM rb QUALIFY row_number() OVER (PARTITION BY program ORDER BY w DESC, var_id) <= 10)",
        "SELECT coalesce(ta.program, tb.program) AS reference_program, coalesce(ta.program, tb.program) AS candidate_program, count(*) FILTER (ta.var_id IS NOT NULL AND tb.var_id IS NOT NULL) / CAST(count(*) AS DOUBLE) AS top_gene_jaccard "
        "FROM ta FULL JOIN tb ON ta.program = tb.program AND ta.var_id = tb.var_id GROUP BY 1, 2",
    ),
)
def jaccard(m):
    return pg.top_gene_jaccard(spectra(m, m.expr), spectra(m, open_expr(m)), same(m), 10)


@query(
    "j15_match_programs",
    with_ctes(
        *SETS,
        "ids AS (SELECT program, row_number() OVER (ORDER BY program) AS i FROM (SELECT DISTINCT program FROM ra))",
        "g AS (SELECT x.i AS r, y.i AS c, cosine FROM co JOIN ids x ON x.program = reference_program JOIN ids y ON y.program = candidate_program)",
        "t AS (SELECT a.c AS c1, b.c AS c2, d.c AS c3, e.c AS c4, f.c AS c5 FROM g a JOIN g b ON a.r = 1 AND b.r = 2 AND b.c <> a.c JOIN g d ON d.r = 3 AND d.c NOT IN (a.c, b.c) JOIN g e ON e.r = 4 AND e.c NOT IN (a.c, b.c, d.c) "
        "JOIN g f ON f.r = 5 AND f.c NOT IN (a.c, b.c, d.c, e.c) ORDER BY a.cosine + b.cosine + d.cosine + e.cosine + f.cosine DESC LIMIT 1)",
        "p AS (SELECT unnest([1, 2, 3, 4, 5]) AS r, unnest([c1, c2, c3, c4, c5]) AS c FROM t)",
        "SELECT x.program AS reference_program, y.program AS candidate_program, round(cosine, 8) AS spectra_cosine FROM p JOIN g ON g.r = p.r AND g.c = p.c JOIN ids x ON x.i = p.r JOIN ids y ON y.i = p.c",
    ),
)
def matched(m):
    pairs = pg.match_programs(pg.program_cosines(spectra(m, m.expr), spectra(m, open_expr(m))))
    return pairs.withColumn("spectra_cosine", F.round("spectra_cosine", 8))


@query("n14_compare_programs")
def compare(m):
    other = cut(open_expr(m))
    return pg.compare_programs(spectra(m, m.expr), spectra(m, other), usages(m, m.expr), usages(m, other), 10)[0]
