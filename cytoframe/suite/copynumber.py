"""Copy-number queries: parts are the genes, nations the samples, segments the lineages."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from cytoframe.adapters import COORDS, EXPR_PART, OBS
from cytoframe.adapters import with_ctes as _with_ctes
from cytoframe.operators import cnv
from cytoframe.plans import workflows
from cytoframe.session import cut
from cytoframe.suite import query



def with_ctes(*parts: str) -> str:
    """``window`` is a keyword for DuckDB and needs quotes there."""
    return re.sub(r"\bwindow\b", '"window"', _with_ctes(*parts)).replace(" AS (", " AS MATERIALIZED (")


CFG = cnv.CnvConfig(window_size=4, window_step=2, top_n_genes=300, threshold_percentile=0.05)
LABELS = ["BUILDING", "FURNITURE"]

GM = (
    "gm AS (SELECT DISTINCT hgnc_symbol, CASE WHEN chromosome_name = 'X' THEN 23 ELSE CAST(chromosome_name AS INTEGER) END AS chromosome_num, "
    "start_position, end_position, chr_arm FROM coords WHERE gene_biotype IN ('protein_coding', 'lncRNA') AND (chromosome_name = 'X' OR TRY_CAST(chromosome_name AS INTEGER) BETWEEN 1 AND 22))"
)
REFS = "refs AS (SELECT obs_id, sample_id, cluster AS label FROM obs WHERE cluster IN ('BUILDING', 'FURNITURE') QUALIFY count(*) OVER (PARTITION BY sample_id, cluster) >= 5)"
EX = "ex AS (SELECT e.* FROM expr_part e WHERE var_id IN (SELECT hgnc_symbol FROM gm))"
AVG = (
    "own AS (SELECT sample_id, count(*) AS n FROM obs WHERE sample_id IN (SELECT sample_id FROM refs) GROUP BY 1), "
    "av AS (SELECT var_id, sum(s / n) / (SELECT count(*) FROM own) AS average FROM (SELECT sample_id, var_id, sum(value) AS s FROM ex JOIN obs USING (obs_id) GROUP BY 1, 2) JOIN own USING (sample_id) GROUP BY 1)"
)
SEL = (
    "best AS (SELECT var_id, row_number() OVER (ORDER BY round(average, 9) DESC, var_id) AS r FROM av), "
    "top AS (SELECT gm.* FROM gm JOIN best ON var_id = hgnc_symbol WHERE r <= 300), "
    "sel AS (SELECT var_id, count(*) AS mult FROM (SELECT hgnc_symbol AS var_id FROM top UNION ALL SELECT var_id FROM best, (SELECT DISTINCT chr_arm FROM gm) WHERE r <= 200) GROUP BY 1)"
)
WIN = (
    "ln AS (SELECT chromosome_num, chr_arm, hgnc_symbol AS var_id, row_number() OVER (PARTITION BY chromosome_num, chr_arm ORDER BY start_position, hgnc_symbol) - 1 AS rn, count(*) OVER (PARTITION BY chromosome_num, chr_arm) AS n FROM top), "
    "win AS (SELECT concat(chromosome_num, '.', chr_arm, i + 1) AS window, chromosome_num, chr_arm, CAST(i + 1 AS INTEGER) AS idx, var_id, CAST(rn AS INTEGER) AS rn FROM ln, LATERAL (SELECT unnest(CASE WHEN n <= 4 THEN [0] ELSE range(0, (n - 4 + 1) // 2) END) AS i) "
    "WHERE n <= 4 OR rn BETWEEN 2 * i AND 2 * i + 4)"
)
CENTRE = (
    "cm AS (SELECT obs_id, sample_id, coalesce(s, 0) / (SELECT sum(mult) FROM sel) AS cell_mean FROM obs LEFT JOIN (SELECT obs_id, sum(log2(1 + value) * mult) AS s FROM ex JOIN sel USING (var_id) GROUP BY 1) USING (obs_id))"
)
SCALE = (
    "lb AS (SELECT DISTINCT label FROM refs), "
    "us AS (SELECT obs_id, sample_id, label FROM refs UNION ALL SELECT obs_id, sample_id, lb.label FROM obs, lb WHERE (sample_id, lb.label) NOT IN (SELECT (sample_id, label) FROM refs)), "
    "un AS (SELECT sample_id, label, count(*) AS n FROM us GROUP BY 1, 2), "
    "ce AS (SELECT label, avg(c) AS centre, count(*) AS k FROM (SELECT us.sample_id, label, avg(cell_mean) AS c FROM us JOIN cm USING (obs_id) GROUP BY 1, 2) GROUP BY 1), "
    "lv AS (SELECT label, var_id, sum(s / n) AS t FROM (SELECT label, us.sample_id, var_id, sum(log2(1 + value)) AS s FROM ex JOIN sel USING (var_id) JOIN us USING (obs_id) GROUP BY 1, 2, 3) JOIN un USING (sample_id, label) GROUP BY 1, 2), "
    "scale AS (SELECT var_id, median(coalesce(t, 0) / k - centre) AS scale FROM sel CROSS JOIN ce LEFT JOIN lv USING (label, var_id) GROUP BY 1)"
)
SCORE = (
    "nv AS (SELECT cm.obs_id, sample_id, sel.var_id, least(greatest(log2(1 + coalesce(value, 0)) - cell_mean - scale, -3), 3) AS v FROM cm CROSS JOIN sel JOIN scale USING (var_id) LEFT JOIN ex ON ex.obs_id = cm.obs_id AND ex.var_id = sel.var_id), "
    "sc AS (SELECT obs_id, sample_id, window, avg(v) AS score FROM win JOIN nv USING (var_id) GROUP BY 1, 2, 3)"
)
TRIM = (
    "lim AS (SELECT window, quantile_cont(score, 0.05) AS lo, quantile_cont(score, 0.95) AS hi FROM sc WHERE obs_id IN (SELECT obs_id FROM refs) GROUP BY 1), "
    "tr AS (SELECT obs_id, sample_id, window, CASE WHEN score BETWEEN lo AND hi THEN 0.0 ELSE score END AS t FROM sc JOIN lim USING (window))"
)
ARMEX = "concat(CASE WHEN split_part(window, '.', 1) = '23' THEN 'X' ELSE split_part(window, '.', 1) END, '.', substr(split_part(window, '.', 2), 1, 1))"
STEPS = [OBS, COORDS, EXPR_PART, GM, REFS, EX, AVG, SEL, WIN, CENTRE, SCALE, SCORE, TRIM]


def coords(m):
    return cnv.normalize_coordinates(m.gene_coordinates)


def known(m):
    return m.expr_part.join(coords(m).select(F.col("hgnc_symbol").alias("var_id")), "var_id", "left_semi")


def refs(m):
    return cnv.reference_cells(m.obs, "cluster", LABELS, True)


def chosen(m, owners=None, expr=None):
    owners = refs(m) if owners is None else owners
    avg = cnv.pooled_average(known(m) if expr is None else expr, m.obs, owners).withColumn("average", F.round("average", 9))
    return cnv.select_genes(cut(avg), coords(m), CFG.top_n_genes)


@query("p06_gene_coordinates", with_ctes(COORDS, GM, "SELECT * FROM gm"))
def coordinates(m):
    return coords(m)


@query("j12_region_genes", with_ctes(COORDS, GM, "SELECT DISTINCT hgnc_symbol AS var_id FROM gm WHERE chromosome_num = 23 AND start_position >= 100 AND end_position <= 1500"))
def region(m):
    return cnv.genes_in_region(coords(m), ("X", 100, 1500))


@query("c06_reference_cells", with_ctes(OBS, REFS, "SELECT * FROM refs"))
def reference_cells(m):
    return refs(m)


@query("c05_reference_cells_single", with_ctes(OBS, "SELECT obs_id, sample_id, cluster AS label FROM obs WHERE cluster IN ('BUILDING', 'FURNITURE')"))
def reference_single(m):
    return cnv.reference_cells(m.obs, "cluster", LABELS, False)


@query(
    "c07_average_expression",
    with_ctes(OBS, COORDS, EXPR_PART, GM, EX, "SELECT var_id, round(sum(value) / (SELECT count(*) FROM obs WHERE cluster = 'BUILDING'), 8) AS average FROM ex WHERE obs_id IN (SELECT obs_id FROM obs WHERE cluster = 'BUILDING') GROUP BY 1"),
)
def average(m):
    cells = cnv.reference_cells(m.obs, "cluster", "BUILDING", False)
    return cnv.average_expression(known(m), cells).withColumn("average", F.round("average", 8))


@query("c08_pooled_average", with_ctes(*STEPS[:7], "SELECT var_id, round(average, 8) AS average FROM av"))
def pooled(m):
    return cnv.pooled_average(known(m), m.obs, refs(m)).withColumn("average", F.round("average", 8))


@query("c09_o02_o03_selected_genes", with_ctes(*STEPS[:8], "SELECT * FROM sel"))
def selected(m):
    return chosen(m)[1]


@query("w08_genomic_windows", with_ctes(*STEPS[:9], "SELECT * FROM win"))
def windows(m):
    return cnv.genomic_windows(chosen(m)[0], CFG.window_size, CFG.window_step)


@query(
    "c16_window_table",
    with_ctes(*STEPS[:9], f"SELECT window, {ARMEX} AS chrom_arm, CAST(count(*) AS INTEGER) AS n_genes, string_agg(CAST(var_id AS VARCHAR), ';' ORDER BY rn) AS genes FROM win GROUP BY 1, 2"),
)
def window_table(m):
    return cnv.window_table(cnv.genomic_windows(chosen(m)[0], CFG.window_size, CFG.window_step)).select("window", "chrom_arm", "n_genes", "genes")


@query("c11_cell_means", with_ctes(*STEPS[:10], "SELECT obs_id, sample_id, round(cell_mean, 8) AS cell_mean FROM cm"))
def cell_means(m):
    return cnv.cell_means(known(m), m.obs, cut(chosen(m)[1])).withColumn("cell_mean", F.round("cell_mean", 8))


@query("c12_c13_scale_factors", with_ctes(*STEPS[:11], "SELECT var_id, round(scale, 8) AS scale FROM scale"))
def scale(m):
    genes = cut(chosen(m)[1])
    return cnv.scale_factors(known(m), m.obs, genes, refs(m)).withColumn("scale", F.round("scale", 8))


def run(m):
    r, expr = refs(m), cut(known(m))
    top, genes = (cut(d) for d in chosen(m, r, expr))
    kept = expr.join(genes.select("var_id"), "var_id", "left_semi")
    factors = cut(cnv.scale_factors(kept, m.obs, genes, r))
    cells, names = cnv.window_scores(kept, m.obs, genes, factors, cnv.genomic_windows(top, CFG.window_size, CFG.window_step))
    return cut(cells), names, r


def trimmed(m):
    cells, names, r = run(m)
    low, high, strict = cnv.window_limits(cells, r, CFG.threshold_percentile)
    return cnv.trim_scores(cells, low, high, strict), names


def _named(df, names, column, out):
    labels = F.lit(list(names))
    return df.select("obs_id", "sample_id", F.posexplode(column).alias("_i", out)).select(
        "obs_id", "sample_id", F.get(labels, F.col("_i")).alias("window"), F.round(out, 6).alias(out)
    )


@query("c14_window_scores", with_ctes(*STEPS[:12], "SELECT obs_id, sample_id, window, round(score, 6) AS score FROM sc"))
def scores(m):
    cells, names, _ = run(m)
    return _named(cells, names, "scores", "score")


@query("c15_trimmed_scores", with_ctes(*STEPS, "SELECT obs_id, sample_id, window, round(t, 6) AS trimmed FROM tr"))
def trimmed_scores(m):
    cells, names = trimmed(m)
    return _named(cells, names, "trimmed", "trimmed")


@query(
    "c15_group_limits",
    with_ctes(
        *STEPS[:12],
        "g AS (SELECT window, cluster, quantile_cont(score, 0.05) AS lo, quantile_cont(score, 0.95) AS hi FROM sc JOIN obs USING (obs_id) GROUP BY 1, 2)",
        "SELECT obs_id, sc.sample_id, window, round(CASE WHEN score > l AND score < h THEN 0.0 ELSE score END, 6) AS trimmed FROM sc JOIN (SELECT window, median(lo) AS l, median(hi) AS h FROM g GROUP BY 1) USING (window)",
    ),
)
def group_limits(m):
    cells, names, _ = run(m)
    groups = m.obs.select("obs_id", F.col("cluster").alias("grp"))
    low, high, strict = cnv.window_limits(cells, None, CFG.threshold_percentile, groups)
    return _named(cnv.trim_scores(cells, low, high, strict), names, "trimmed", "trimmed")


@query("a18_cnv_fraction", with_ctes(*STEPS, "SELECT obs_id, round(avg(CAST(abs(t) > 0 AS DOUBLE)), 6) AS cnv_fraction FROM tr GROUP BY 1"))
def fraction(m):
    return cnv.summarize_cells(*trimmed(m)).select("obs_id", F.round("cnv_fraction", 6).alias("cnv_fraction"))


@query(
    "a17_p10_arm_summary",
    with_ctes(
        *STEPS,
        f"arms AS (SELECT concat(c, '.', a) AS arm FROM (SELECT CAST(range AS VARCHAR) AS c FROM range(1, 23) UNION ALL SELECT 'X') CROSS JOIN (SELECT unnest(['p', 'q']) AS a))",
        f"m AS (SELECT obs_id, {ARMEX} AS arm, avg(t) AS v FROM tr GROUP BY 1, 2)",
        "SELECT obs.obs_id, arms.arm, round(coalesce(v, 0.0), 6) AS arm_cnv, CASE WHEN coalesce(v, 0) < -0.1 THEN 'loss' WHEN coalesce(v, 0) > 0.1 THEN 'gain' ELSE 'no_alteration' END AS classification "
        "FROM obs CROSS JOIN arms LEFT JOIN m ON m.obs_id = obs.obs_id AND m.arm = arms.arm",
    ),
)
def arm_summary(m):
    cells = cnv.summarize_cells(*trimmed(m))
    packed = F.array(*[
        F.struct(F.lit(a).alias("arm"), F.round(F.col(f"`{a}_CNV`"), 6).alias("arm_cnv"), F.col(f"`{a}_CNV_classification`").alias("classification"))
        for a in cnv.ARMS
    ])
    return cells.select("obs_id", F.explode(packed).alias("s")).select("obs_id", "s.*")


LINEAGE = (
    "lin AS (SELECT *, CASE cluster WHEN 'BUILDING' THEN 'T' WHEN 'FURNITURE' THEN 'Myeloid' WHEN 'AUTOMOBILE' THEN 'Neuron' ELSE 'Epithelial' END AS cell_type_lvl1, "
    "CASE WHEN obs_id % 3 = 0 THEN 'normal' ELSE 'tumor' END AS tumor_status FROM obs)"
)
POOL = (
    "pool AS (SELECT *, CASE WHEN cell_type_lvl1 = 'Epithelial' AND tumor_status IN ('normal', 'non_tumor', 'healthy') THEN 'normal_parenchymal' "
    "WHEN cell_type_lvl1 = 'Epithelial' THEN 'candidate_tumor_or_mixed' ELSE 'normal_nonparenchymal' END AS reference_pool FROM lin)"
)


def pool(m):
    lineage = (
        F.when(F.col("cluster") == "BUILDING", "T").when(F.col("cluster") == "FURNITURE", "Myeloid")
        .when(F.col("cluster") == "AUTOMOBILE", "Neuron").otherwise("Epithelial")
    )
    obs = m.obs.withColumns({"cell_type_lvl1": lineage, "tumor_status": F.when(F.col("obs_id") % 3 == 0, "normal").otherwise("tumor")})
    return cnv.reference_pool(obs, status="tumor_status")


@query("p13_reference_pool", with_ctes(OBS, LINEAGE, POOL, "SELECT obs_id, reference_pool FROM pool"))
def reference_pool(m):
    return pool(m).select("obs_id", "reference_pool")


@query(
    "c19_reference_plan",
    with_ctes(
        OBS, LINEAGE, POOL,
        "c AS (SELECT count(*) FILTER (reference_pool = 'normal_nonparenchymal') AS a, count(*) FILTER (reference_pool = 'normal_parenchymal') AS b, count(*) FILTER (reference_pool = 'candidate_tumor_or_mixed') AS d FROM pool)",
        "SELECT a + b AS n_reference_cells, a AS n_normal_nonparenchymal, b AS n_normal_parenchymal, d AS n_candidate_cells, a + b >= 20 AND d > 0 AS should_run, "
        "CASE WHEN NOT (a + b >= 20 AND d > 0) THEN 'too few reference cells or no candidates' WHEN b > 0 THEN 'normal parenchymal cells are separable' ELSE 'non-parenchymal cells only' END AS reason FROM c",
    ),
)
def plan(m):
    return cnv.reference_plan(pool(m))


@query(
    "c20_tumour_evidence",
    with_ctes(
        *STEPS, LINEAGE, POOL,
        "f AS (SELECT pool.obs_id, reference_pool, fr FROM pool JOIN (SELECT obs_id, avg(CAST(abs(t) > 0 AS DOUBLE)) AS fr FROM tr GROUP BY 1) USING (obs_id))",
        "rf AS (SELECT fr FROM f WHERE starts_with(reference_pool, 'normal_'))",
        "th AS (SELECT greatest((SELECT quantile_cont(fr, 0.99) FROM rf), md + 3 * 1.4826 * (SELECT median(abs(fr - (SELECT median(fr) FROM rf))) FROM rf)) AS th FROM (SELECT median(fr) AS md FROM rf))",
        "SELECT obs_id, round(th, 6) AS normal_threshold, CASE WHEN starts_with(reference_pool, 'normal_') THEN 'normal_reference' WHEN fr <= th THEN 'cnv_normal_like' WHEN fr > th THEN 'cnv_tumor_like' ELSE 'cnv_indeterminate' END AS tumor_evidence FROM f, th",
    ),
)
def evidence(m):
    cells = cut(cnv.summarize_cells(*trimmed(m)).select("obs_id", "cnv_fraction"))
    out = cnv.tumour_evidence(pool(m).select("obs_id", "reference_pool").join(cells, "obs_id"))
    return out.select("obs_id", F.round("normal_threshold", 6).alias("normal_threshold"), "tumor_evidence")


@query("c17_c18_cnv_clusters")
def clusters(m):
    return cnv.cluster_cells(*trimmed(m), CFG)


@query("c01_c03_pooled_run")
def pooled_run(m):
    done = cnv.run_cnv(cut(m.expr_part), coords(m), m.obs, "cluster", LABELS, CFG)
    return done.cells.drop("scores", "trimmed")


@query("c02_single_run")
def single_run(m):
    done = cnv.run_cnv(cut(m.expr_part), coords(m), m.obs, "cluster", LABELS, CFG, by_sample=False)
    return done.cells.select("obs_id", "cnv_fraction")


@query("c19_tumour_workflow")
def tumour_workflow(m):
    obs = pool(m).drop("reference_pool")
    return workflows.run_tumour_cnv(obs, cut(m.expr_part), coords(m), CFG, status="tumor_status")[0]
