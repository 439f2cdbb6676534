"""Quality-control queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.adapters import EXPR, OBS, VAR, with_ctes
from cytoframe.operators import qc
from cytoframe.suite import query

FLAGS = (
    "flags AS (SELECT var_id, symbol, starts_with(upper(symbol), 'MT-') AS mt_gene, "
    "regexp_matches(upper(symbol), '^(RPL|RPS)') AS ribo_gene, "
    "regexp_matches(upper(symbol), '^HB[ABDEGQMZ]') AS hb_gene FROM var)"
)
METRICS_SQL = (
    "q AS (SELECT obs_id, sample_id, cluster, total_counts, n_genes_by_counts, "
    "100.0 * mt / greatest(total_counts, 1.0) AS pct_counts_mt, 100.0 * ribo / greatest(total_counts, 1.0) AS pct_counts_ribo, "
    "100.0 * hb / greatest(total_counts, 1.0) AS pct_counts_hb, log10(total_counts + 1) AS log10_total_counts, "
    "log10(n_genes_by_counts + 1) AS log10_n_genes_by_counts FROM (SELECT obs.obs_id, sample_id, cluster, "
    "coalesce(sum(value), 0.0) AS total_counts, count(value) AS n_genes_by_counts, "
    "coalesce(sum(value) FILTER (mt_gene), 0.0) AS mt, coalesce(sum(value) FILTER (ribo_gene), 0.0) AS ribo, "
    "coalesce(sum(value) FILTER (hb_gene), 0.0) AS hb FROM obs LEFT JOIN expr ON obs.obs_id = expr.obs_id "
    "LEFT JOIN flags ON expr.var_id = flags.var_id GROUP BY 1, 2, 3))"
)
BASE = [OBS, VAR, EXPR, FLAGS, METRICS_SQL]
LONG = "lng AS (SELECT obs_id, sample_id, metric, x FROM q UNPIVOT (x FOR metric IN (" + ", ".join(qc.METRICS) + ")))"
THRESH = (
    "md AS (SELECT sample_id, metric, median(x) AS median, quantile_cont(x, 0.05) AS q05, quantile_cont(x, 0.1) AS q10, "
    "quantile_cont(x, 0.9) AS q90, quantile_cont(x, 0.95) AS q95 FROM lng GROUP BY 1, 2),\n"
    "th AS (SELECT md.*, s.mad FROM md JOIN (SELECT lng.sample_id, lng.metric, "
    "greatest(1.4826 * median(abs(x - median)), 1e-9) AS mad FROM lng JOIN md USING (sample_id, metric) GROUP BY 1, 2) s "
    "USING (sample_id, metric))"
)


def cells_of(m):
    return qc.basic_metrics(m.obs, m.expr, qc.gene_flags(m.var))


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("p03_gene_flags", with_ctes(VAR, FLAGS, "SELECT * FROM flags"))
def gene_flags(m):
    return qc.gene_flags(m.var)


@query(
    "p03_gene_flags_mouse",
    with_ctes(
        VAR,
        "mv AS (SELECT var_id, replace(replace(replace(replace(symbol, 'MT-', 'mt-'), 'RPL', 'Rpl'), 'RPS', 'Rps'), 'HBA', 'hbA') AS symbol FROM var)",
        "SELECT *, starts_with(symbol, 'mt-') AS mt_gene, regexp_matches(symbol, '^(Rpl|Rps)') AS ribo_gene, "
        "regexp_matches(lower(symbol), '^hb[ab]') AS hb_gene FROM mv",
    ),
)
def gene_flags_mouse(m):
    s = F.col("symbol")
    for a, b in (("MT-", "mt-"), ("RPL", "Rpl"), ("RPS", "Rps"), ("HBA", "hbA")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return qc.gene_flags(m.var.withColumn("symbol", s), "mouse")


@query(
    "a02_basic_qc",
    with_ctes(
        *BASE,
        "SELECT obs_id, sample_id, cluster, total_counts, n_genes_by_counts, round(pct_counts_mt, 6) AS pct_counts_mt, "
        "round(pct_counts_ribo, 6) AS pct_counts_ribo, round(pct_counts_hb, 6) AS pct_counts_hb, "
        "round(log10_total_counts, 6) AS log10_total_counts, round(log10_n_genes_by_counts, 6) AS log10_n_genes_by_counts FROM q",
    ),
)
def basic_qc(m):
    return rounded(cells_of(m).drop("batch"), qc.METRICS)


@query(
    "a03_sample_thresholds",
    with_ctes(
        *BASE, LONG, THRESH,
        "SELECT sample_id, metric, round(median, 6) AS median, round(mad, 6) AS mad, round(q05, 6) AS q05, "
        "round(q10, 6) AS q10, round(q90, 6) AS q90, round(q95, 6) AS q95 FROM th",
    ),
)
def thresholds(m):
    return rounded(qc.sample_thresholds(cells_of(m)), ["median", "mad", "q05", "q10", "q90", "q95"])


def _flag_ctes(a, b, c, d, e):
    def low(metric, k):
        return (
            f"bool_or(metric = '{metric}' AND x < median - {k} * mad AND x < q10)"
        )

    def high(metric, k, guard):
        return f"bool_or(metric = '{metric}' AND x > median + {k} * mad AND x > {guard})"

    return [
        *BASE, LONG, THRESH,
        "fl AS (SELECT obs_id, sample_id, "
        + f"{low('log10_total_counts', a)} AS lc, {low('log10_n_genes_by_counts', b)} AS lg, "
        + f"{high('pct_counts_mt', c, 'q90')} AS hm, {high('pct_counts_ribo', d, 'q95')} AS hr, {high('pct_counts_hb', e, 'q95')} AS hh "
        + "FROM lng JOIN th USING (sample_id, metric) GROUP BY 1, 2)",
        "cls AS (SELECT *, (lc AND lg) OR (hm AND lg) OR (hm AND lc) AS fail, lc OR lg OR hm OR hr OR hh AS hit FROM fl)",
    ]


FLAG_SELECT = (
    "SELECT obs_id, sample_id, lc AS qc_low_counts_flag, lg AS qc_low_genes_flag, hm AS qc_high_mt_flag, "
    "hr AS qc_high_ribo_flag, hh AS qc_high_hb_flag, NOT fail AS qc_pass, CASE WHEN fail THEN 'fail' WHEN hit THEN 'suspect' "
    "ELSE 'pass' END AS qc_class, concat_ws(';', CASE WHEN lc THEN 'low_counts' END, CASE WHEN lg THEN 'low_genes' END, "
    "CASE WHEN hm THEN 'high_mt' END, CASE WHEN hr THEN 'high_ribo' END, CASE WHEN hh THEN 'high_hb' END) AS qc_failure_reason FROM cls"
)
FLAG_COLUMNS = [
    "obs_id", "sample_id", "qc_low_counts_flag", "qc_low_genes_flag", "qc_high_mt_flag", "qc_high_ribo_flag",
    "qc_high_hb_flag", "qc_pass", "qc_class", "qc_failure_reason",
]
TIGHT = qc.Multipliers(1.0, 1.0, 1.0, 1.0, 1.0)


@query("a04_qc_flags", with_ctes(*_flag_ctes(1.0, 1.0, 1.0, 1.0, 1.0), FLAG_SELECT))
def flags_tight(m):
    return qc.flag_cells(cells_of(m), multipliers=TIGHT)[0].select(FLAG_COLUMNS)


@query("a04_qc_flags_default", with_ctes(*_flag_ctes(3.0, 3.0, 3.0, 4.0, 4.0), FLAG_SELECT))
def flags_default(m):
    return qc.flag_cells(cells_of(m))[0].select(FLAG_COLUMNS)


@query(
    "a04_qc_summary",
    with_ctes(
        *_flag_ctes(1.0, 1.0, 1.0, 1.0, 1.0),
        "SELECT sample_id, count(*) AS n_obs, (count(*) FILTER (fail)) / CAST(count(*) AS DOUBLE) AS fail_fraction, "
        "(count(*) FILTER (hit AND NOT fail)) / CAST(count(*) AS DOUBLE) AS suspect_fraction FROM cls GROUP BY 1",
    ),
)
def flag_summary(m):
    return qc.flag_cells(cells_of(m), multipliers=TIGHT)[1].select("sample_id", "n_obs", "fail_fraction", "suspect_fraction")


@query(
    "a05_review_trigger",
    with_ctes(
        *_flag_ctes(1.0, 1.0, 1.0, 1.0, 1.0),
        "SELECT max(f) AS max_fail_fraction, max(f) > 0.3 AS human_review_required FROM (SELECT "
        "(count(*) FILTER (fail)) / CAST(count(*) AS DOUBLE) AS f FROM cls GROUP BY sample_id)",
    ),
)
def review(m):
    return qc.needs_review(qc.flag_cells(cells_of(m), multipliers=TIGHT)[1])


DOUBLET_SQL = [
    *BASE,
    "sc AS (SELECT q.*, s / total_counts AS doublet_score, s / total_counts > 0.12 AS predicted_doublet FROM q "
    "JOIN (SELECT obs_id, max(value) AS s FROM expr GROUP BY 1) USING (obs_id))",
    "lim AS (SELECT sample_id, quantile_cont(total_counts, 0.95) AS t95, quantile_cont(CAST(n_genes_by_counts AS DOUBLE), 0.95) AS g95, "
    "median(doublet_score) AS score_median, quantile_cont(doublet_score, 0.95) AS score_q95 FROM sc GROUP BY 1)",
    "called AS (SELECT sc.*, score_median, score_q95, CASE WHEN predicted_doublet AND (total_counts > t95 OR n_genes_by_counts > g95) THEN 'doublet' "
    "WHEN predicted_doublet THEN 'ambiguous' ELSE 'singlet' END AS doublet_call FROM sc JOIN lim USING (sample_id))",
]


def _scored(m):
    top = m.expr.groupBy("obs_id").agg(F.max("value").alias("_s"))
    score = F.col("_s") / F.col("total_counts")
    return cells_of(m).join(top, "obs_id").withColumns({"doublet_score": score, "predicted_doublet": score > 0.12}).drop("_s")


@query("a06_doublet_gate", with_ctes(*DOUBLET_SQL, "SELECT obs_id, doublet_call, round(doublet_score, 6) AS doublet_score FROM called"))
def doublets(m):
    return qc.gate_doublets(_scored(m))[0].select("obs_id", "doublet_call", F.round("doublet_score", 6).alias("doublet_score"))


@query(
    "a06_doublet_summary",
    with_ctes(
        *DOUBLET_SQL,
        "SELECT sample_id, count(*) AS n_obs, count(*) FILTER (predicted_doublet) / CAST(count(*) AS DOUBLE) AS predicted_fraction, "
        "count(*) FILTER (doublet_call = 'doublet') / CAST(count(*) AS DOUBLE) AS confident_fraction, "
        "round(max(score_median), 6) AS score_median, round(max(score_q95), 6) AS score_q95 FROM called GROUP BY 1",
    ),
)
def doublet_summary(m):
    return rounded(qc.gate_doublets(_scored(m))[1], ["score_median", "score_q95"])


@query(
    "w02_robust_z",
    with_ctes(
        *BASE,
        "lng AS (SELECT obs_id, sample_id, metric, x FROM q UNPIVOT (x FOR metric IN (log10_total_counts, pct_counts_mt)))",
        "md AS (SELECT sample_id, metric, median(x) AS median FROM lng GROUP BY 1, 2)",
        "sp AS (SELECT lng.sample_id, lng.metric, greatest(1.4826 * median(abs(x - median)), 1e-9) AS mad FROM lng JOIN md USING (sample_id, metric) GROUP BY 1, 2)",
        "SELECT obs_id, round(max((x - median) / mad) FILTER (metric = 'log10_total_counts'), 5) AS log10_total_counts_z_sample, "
        "round(max((x - median) / mad) FILTER (metric = 'pct_counts_mt'), 5) AS pct_counts_mt_z_sample "
        "FROM lng JOIN md USING (sample_id, metric) JOIN sp USING (sample_id, metric) GROUP BY 1",
    ),
)
def robust(m):
    z = qc.robust_z(cells_of(m), ["log10_total_counts", "pct_counts_mt"])
    names = ["log10_total_counts_z_sample", "pct_counts_mt_z_sample"]
    return rounded(z.select("obs_id", *names), names, 5)


@query("qc_run", with_ctes(*_flag_ctes(3.0, 3.0, 3.0, 4.0, 4.0), FLAG_SELECT))
def qc_run(m):
    """The module-level run: metrics, flags and their tables in the work folder."""
    from cytoframe.plans.workflows import run_qc
    from cytoframe.suite.io import work_path

    folder = work_path(m, "qc")
    run_qc(m.obs, m.expr, m.var, folder)
    return m.spark.read.parquet(f"{folder}/cells.parquet").select(FLAG_COLUMNS)
