"""Evidence, decision and rule queries; nations play the clusters, customers make decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.adapters import EXPR, OBS, with_ctes
from cytoframe.operators import evidence as ev
from cytoframe.session import cut
from cytoframe.suite import query

FACTS = (
    "facts AS (SELECT obs_id, sample_id AS cl, batch AS sample_id, concat('P', obs_id % 5 + 1) AS dominant_program, CASE WHEN sample_id % 4 = 0 AND obs_id % 9 = 0 THEN 'Tumor' ELSE 'cnv_normal_like' END AS tumor_evidence, "
    "(obs_id % 100) / CAST(100 AS DOUBLE) AS cnv_fraction, CASE WHEN obs_id % 2 = 0 THEN 'normal_parenchymal' ELSE 'candidate_tumor_or_mixed' END AS reference_pool, NOT (sample_id % 3 = 0 AND obs_id % 11 = 0) AS qc_pass FROM obs)"
)


def facts(m):
    return m.obs.select(
        "obs_id", F.col("sample_id").alias("cl"), F.col("batch").alias("sample_id"), F.concat(F.lit("P"), (F.col("obs_id") % 5 + 1).cast("string")).alias("dominant_program"),
        F.when((F.col("sample_id") % 4 == 0) & (F.col("obs_id") % 9 == 0), "Tumor").otherwise("cnv_normal_like").alias("tumor_evidence"),
        ((F.col("obs_id") % 100) / 100.0).cast("double").alias("cnv_fraction"),
        F.when(F.col("obs_id") % 2 == 0, "normal_parenchymal").otherwise("candidate_tumor_or_mixed").alias("reference_pool"),
        (~((F.col("sample_id") % 3 == 0) & (F.col("obs_id") % 11 == 0))).alias("qc_pass"),
    )


def bundle(m):
    return ev.cluster_evidence(facts(m), "cl", marker_refs=["markers"], nmf_refs=["program_usage"])


@query(
    "a11_evidence_template",
    with_ctes(
        OBS,
        "SELECT cluster, count(*) AS n_cells, count(DISTINCT sample_id) AS n_samples, 'review_required' AS proposed_label, 'pending' AS marker_evidence, 'pending' AS nmf_evidence, 'pending' AS knn_evidence, "
        "'pending' AS reference_evidence, 'low' AS confidence, TRUE AS human_review_required FROM obs GROUP BY 1",
    ),
)
def template(m):
    return ev.evidence_template(m.obs)


EVID = (
    "evid AS (SELECT CAST(cl AS VARCHAR) AS cluster_id, count(*) AS n_cells, count(DISTINCT sample_id) AS n_samples, bool_or(lower(tumor_evidence) IN ('tumor', 'malignant', 'aneuploid', 'positive', 'true', '1')) AS has_tumor_evidence, "
    "avg(cnv_fraction) AS cm, max(cnv_fraction) AS cx, bool_and(qc_pass) AS ok FROM facts GROUP BY 1)"
)


def _flat(column):
    return F.array_join(F.transform(F.array_sort(F.map_entries(column)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")


@query(
    "a12_o04_cluster_evidence",
    with_ctes(
        OBS, FACTS, EVID,
        "pc AS (SELECT CAST(cl AS VARCHAR) AS cluster_id, dominant_program AS v, count(*) AS n FROM facts GROUP BY 1, 2)",
        "tp AS (SELECT cluster_id, string_agg(v, ',' ORDER BY n DESC, v) AS dominant_programs FROM (SELECT * FROM pc QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, v) <= 3) GROUP BY 1)",
        "tc AS (SELECT cluster_id, string_agg(concat(v, '=', n), ';' ORDER BY v) AS tumor_counts FROM (SELECT CAST(cl AS VARCHAR) AS cluster_id, tumor_evidence AS v, count(*) AS n FROM facts GROUP BY 1, 2) GROUP BY 1)",
        "rc AS (SELECT cluster_id, string_agg(concat(v, '=', n), ';' ORDER BY v) AS pool_counts FROM (SELECT CAST(cl AS VARCHAR) AS cluster_id, reference_pool AS v, count(*) AS n FROM facts GROUP BY 1, 2) GROUP BY 1)",
        "SELECT cluster_id, n_cells, n_samples, has_tumor_evidence, round(cm, 8) AS cnv_fraction_mean, cx AS cnv_fraction_max, dominant_programs, tumor_counts, pool_counts, 'reference_pool,cnv_fraction,tumor_evidence' AS cnv_refs, "
        "CASE WHEN ok THEN '' ELSE 'cluster_contains_qc_failed_cells' END AS qc_warnings FROM evid JOIN tp USING (cluster_id) JOIN tc USING (cluster_id) JOIN rc USING (cluster_id)",
    ),
)
def cluster_evidence(m):
    return bundle(m).select(
        "cluster_id", "n_cells", "n_samples", "has_tumor_evidence", F.round("cnv_fraction_mean", 8).alias("cnv_fraction_mean"), "cnv_fraction_max",
        F.array_join("dominant_programs", ",").alias("dominant_programs"), _flat("tumor_evidence_counts").alias("tumor_counts"),
        _flat("reference_pool_counts").alias("pool_counts"), F.array_join("cnv_refs", ",").alias("cnv_refs"), F.array_join("qc_warnings", ",").alias("qc_warnings"),
    )


DEC = (
    "dec AS (SELECT c_custkey AS ord, CASE WHEN c_custkey % 50 = 0 THEN 'missing' ELSE CAST(c_nationkey AS VARCHAR) END AS cluster_id, "
    "CASE c_custkey % 5 WHEN 0 THEN 'Epithelial' WHEN 1 THEN 'T cell' WHEN 2 THEN 'Malignant epithelial' WHEN 3 THEN 'Myeloid' ELSE 'Ribosomal-high' END AS parent_label, c_mktsegment AS canonical_label, "
    "CASE WHEN c_custkey % 17 = 0 THEN ' ' ELSE concat('label ', lower(c_mktsegment)) END AS final_label, CASE WHEN c_custkey % 6 = 0 THEN 'stress' END AS cell_state, "
    "CASE WHEN c_custkey % 29 = 0 THEN 'certain' WHEN c_custkey % 3 = 0 THEN 'high' WHEN c_custkey % 3 = 1 THEN 'medium' ELSE 'low' END AS confidence, "
    "c_custkey % 8 = 0 AS cites, CASE WHEN c_custkey % 4 = 1 THEN 'unknown_table' END AS strange, c_custkey % 10 = 0 AS conflict, c_custkey % 9 = 0 AS review FROM customer)"
)


def decisions(m):
    k = F.col("c_custkey")
    marker = F.array(F.when(k % 4 == 1, "unknown_table").otherwise("markers"))
    return m.table("customer").select(
        k.alias("ord"), F.lit("annotation_decision.v1").alias("schema_version"), F.lit("run").alias("run_id"),
        F.when(k % 50 == 0, "missing").otherwise(F.col("c_nationkey").cast("string")).alias("cluster_id"), F.lit("cl").alias("cluster_key"),
        F.when(k % 5 == 0, "Epithelial").when(k % 5 == 1, "T cell").when(k % 5 == 2, "Malignant epithelial").when(k % 5 == 3, "Myeloid").otherwise("Ribosomal-high").alias("parent_label"),
        F.col("c_mktsegment").alias("canonical_label"), F.when(k % 6 == 0, "stress").alias("cell_state"), F.lit(None).cast("string").alias("functional_modifier"),
        F.when(k % 17 == 0, " ").otherwise(F.concat(F.lit("label "), F.lower("c_mktsegment"))).alias("final_label"),
        F.when(k % 29 == 0, "certain").when(k % 3 == 0, "high").when(k % 3 == 1, "medium").otherwise("low").alias("confidence"),
        F.create_map(F.lit("marker"), marker, F.lit("other"), F.when(k % 8 == 0, F.array(F.lit("manual:cnv_plot"))).otherwise(F.array().cast("array<string>"))).alias("evidence_refs"),
        F.array(F.lit("CD3D")).alias("positive_markers"), F.array().cast("array<string>").alias("negative_markers_absent"),
        F.when(k % 10 == 0, F.array(F.lit("EPCAM"))).otherwise(F.array().cast("array<string>")).alias("conflicts"), (k % 9 == 0).alias("review_required"), F.lit("seen").alias("reason"),
    )


VAL = (
    "va AS (SELECT dec.*, CASE WHEN n_cells IS NULL THEN 'cluster not found in evidence bundle' WHEN confidence = 'certain' THEN 'invalid confidence' WHEN trim(final_label) = '' THEN 'empty final_label' END AS stop, "
    "concat_ws('; ', 'unknown evidence refs: ' || strange, CASE WHEN parent_label = 'Ribosomal-high' AND cell_state IS NULL THEN 'program-dominated label should be represented as cell_state or functional_modifier' END, "
    "CASE WHEN parent_label = 'Malignant epithelial' AND NOT (cites OR has_tumor_evidence) THEN 'tumor/malignant label requires CNV evidence or review' END, "
    "CASE WHEN confidence = 'high' AND conflict THEN 'marker conflicts prevent high confidence' END, CASE WHEN confidence = 'high' AND n_cells < 60 THEN 'cluster has too few cells for high confidence' END, "
    "CASE WHEN confidence = 'high' AND n_samples < 2 THEN 'cluster has too few samples for high confidence' END) AS hits FROM dec LEFT JOIN evid USING (cluster_id)), "
    "vr AS (SELECT *, stop IS NULL AS valid, stop IS NOT NULL OR hits <> '' AS forced_review, NOT (stop IS NOT NULL OR hits <> '' OR review) AS accepted, "
    "CASE WHEN stop IS NOT NULL THEN stop WHEN hits <> '' THEN hits WHEN review THEN 'decision requested review' ELSE 'validation passed' END AS reasons FROM va)"
)


def validated(m):
    return ev.validate(decisions(m), cut(bundle(m)), True, min_cells_high=60)


@query("g03_validate_decisions", with_ctes(OBS, FACTS, EVID, DEC, VAL, "SELECT ord, cluster_id, valid, forced_review, accepted, NOT accepted AS review_required, reasons FROM vr"))
def validate(m):
    return validated(m).select("ord", "cluster_id", "valid", "forced_review", "accepted", "review_required", F.array_join("reasons", "; ").alias("reasons"))


@query("j05_unknown_refs", with_ctes(DEC, "SELECT ord, strange AS refs FROM dec WHERE strange IS NOT NULL"))
def unknown(m):
    refs = ev.unknown_refs(F.array(F.lit("markers")))
    return decisions(m).select("ord", F.array_join(refs, ", ").alias("refs")).where("refs <> ''")


COMMIT = "la AS (SELECT cluster_id, arg_max(parent_label, ord) AS l1, arg_max(canonical_label, ord) AS l2, arg_max(final_label, ord) AS l3, arg_max(coalesce(cell_state, ''), ord) AS st, arg_max(confidence, ord) AS cf FROM vr WHERE accepted GROUP BY 1)"


@query(
    "g04_j07_commit",
    with_ctes(
        OBS, FACTS, EVID, DEC, VAL, COMMIT,
        "SELECT obs_id, coalesce(l1, 'unassigned') AS cell_type_lvl1, coalesce(l2, 'unassigned') AS cell_type_lvl2, coalesce(l3, 'unassigned') AS cell_type_lvl3, coalesce(st, '') AS cell_state, coalesce(cf, 'unassigned') AS annotation_confidence, "
        "CASE WHEN la.cluster_id IS NULL THEN 'unassigned' ELSE 'accepted' END AS annotation_status FROM facts LEFT JOIN la ON CAST(cl AS VARCHAR) = la.cluster_id",
    ),
)
def commit(m):
    return ev.commit_decisions(facts(m), validated(m), "cl", "ord")[0].select("obs_id", *ev.OBS_FIELDS)


@query(
    "g04_merge_log",
    with_ctes(OBS, FACTS, EVID, DEC, VAL, "SELECT ord, cluster_id, 'commit' AS action, n_cells, final_label FROM vr JOIN evid USING (cluster_id) WHERE accepted".replace("n_cells,", "evid.n_cells,")),
)
def merge_log(m):
    return ev.commit_decisions(facts(m), validated(m), "cl", "ord")[1]


@query(
    "f15_g01_decision_json",
    with_ctes(DEC, "SELECT cluster_id, parent_label, final_label, confidence, coalesce(cell_state, '') AS state, conflict AS has_conflict, review AS review_required, 1 AS n FROM dec".replace(", 1 AS n", "")),
)
def decision_json(m):
    """Each decision goes through JSON in one of the three accepted shapes."""
    fields = [c for c in decisions(m).columns if c != "ord"]
    d = decisions(m).select("ord", F.to_json(F.struct(*fields)).alias("j"))
    shaped = F.when(F.col("ord") % 3 == 0, F.col("j")).when(F.col("ord") % 3 == 1, F.concat(F.lit("["), "j", F.lit("]"))).otherwise(F.concat(F.lit('{"decisions": ['), "j", F.lit("]}")))
    return ev.parse_decisions(d.select(shaped.alias("text")), "text").select(
        "cluster_id", "parent_label", "final_label", "confidence", F.coalesce("cell_state", F.lit("")).alias("state"), (F.size("conflicts") > 0).alias("has_conflict"), "review_required"
    )


VOCAB = "['RPL3', 'Rps6', 'MT-CO1', 'HBA1', 'MKI67', 'TOP2A', 'JUN', 'FOS', 'PTPRC', 'EPCAM', 'VWF', 'CD3D', 'LYZ']"
PROG = f"pg AS (SELECT concat(p_brand, '|', p_size) AS program, list(upper(({VOCAB})[CAST((p_partkey * 7 + p_size) % 13 AS INTEGER) + 1])) AS genes FROM part GROUP BY 1)"


def programs(m):
    vocab = F.array(*[F.lit(x) for x in ("RPL3", "Rps6", "MT-CO1", "HBA1", "MKI67", "TOP2A", "JUN", "FOS", "PTPRC", "EPCAM", "VWF", "CD3D", "LYZ")])
    gene = F.get(vocab, ((F.col("p_partkey") * 7 + F.col("p_size")) % 13).cast("int"))
    return m.table("part").groupBy(F.concat_ws("|", "p_brand", F.col("p_size").cast("string")).alias("program")).agg(F.collect_list(gene).alias("genes"))


@query(
    "g06_f10_sanitize_programs",
    with_ctes(
        PROG,
        "c AS (SELECT program, CAST(len(genes) AS DOUBLE) AS n, len(list_filter(genes, lambda g: g LIKE 'RP%')) AS r, len(list_filter(genes, lambda g: g LIKE 'MT-%')) AS t, len(list_filter(genes, lambda g: g LIKE 'HBA%')) AS h, "
        "len(list_filter(genes, lambda g: g IN ('MKI67', 'TOP2A'))) AS cc, len(list_filter(genes, lambda g: g IN ('JUN', 'FOS'))) AS st, len(list_filter(genes, lambda g: g IN ('PTPRC', 'EPCAM', 'VWF'))) AS ln FROM pg)",
        "SELECT program, CAST(n AS INTEGER) AS n_genes, CASE WHEN r / n >= 0.35 THEN 'ribosomal' WHEN t / n >= 0.35 THEN 'mitochondrial' WHEN h / n >= 0.35 THEN 'hemoglobin' WHEN cc >= 2 THEN 'cell_cycle' WHEN st >= 2 THEN 'stress' WHEN ln >= 3 THEN 'mixed' ELSE 'identity' END AS program_class, "
        "CAST(CASE WHEN r / n >= 0.35 THEN r WHEN t / n >= 0.35 THEN t WHEN h / n >= 0.35 THEN h WHEN cc >= 2 THEN cc WHEN st >= 2 THEN st WHEN ln >= 3 THEN ln ELSE 0 END AS INTEGER) AS n_matched FROM c",
    ),
)
def sanitize(m):
    return ev.sanitize_programs(programs(m)).select("program", F.size("top_genes").alias("n_genes"), "program_class", F.size("matched_genes").alias("n_matched"))


@query(
    "g18_origin_label",
    with_ctes(
        "s AS (SELECT event_id, (value - floor(value)) - 0.5 AS d, (event_id % 10) / CAST(10 AS DOUBLE) AS mg FROM events)",
        "SELECT event_id, CASE WHEN d > 0.15 THEN 'Mo-like' WHEN d < -0.15 AND mg > 0.2 THEN 'Microglia-like TRM' WHEN d < -0.15 THEN 'TRM-like' ELSE 'Intermediate' END AS origin_label, round(least(abs(d) / 0.4, 1.0), 6) AS confidence FROM s",
    ),
)
def origin(m):
    v = F.col("value")
    label, conf = ev.origin_label((v - F.floor(v)) - 0.5, F.lit(0.0), ((F.col("event_id") % 10) / 10.0).cast("double"))
    return m.table("events").select("event_id", label.alias("origin_label"), F.round(conf, 6).alias("confidence"))


@query(
    "p11_deconvolution_mode",
    "SELECT o_orderkey, CASE WHEN u IN ('bin', 'stereoseq_bin') AND e <= 3 THEN 'multi' WHEN u IN ('cell', 'segmented_cell') THEN 'doublet' ELSE 'full' END AS mode FROM (SELECT o_orderkey, "
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'bin' WHEN '2-HIGH' THEN 'cell' WHEN '3-MEDIUM' THEN 'spot' WHEN '5-LOW' THEN 'stereoseq_bin' ELSE 'other' END AS u, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey % 7 END AS e FROM orders)",
)
def mode(m):
    unit = F.col("o_orderpriority")
    unit = F.when(unit == "1-URGENT", "BIN").when(unit == "2-HIGH", "cell").when(unit == "3-MEDIUM", "spot").when(unit == "5-LOW", "stereoseq_bin").otherwise("other")
    return m.table("orders").select("o_orderkey", ev.deconvolution_mode(unit, F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderkey") % 7)).alias("mode"))


@query(
    "p12_communication_grouping",
    with_ctes(OBS, "SELECT CASE WHEN (SELECT min(n) FROM (SELECT count(*) AS n FROM obs GROUP BY cluster)) >= 20 THEN 'cluster' ELSE 'batch' END AS grouping, count(*) AS n_cells FROM obs"),
)
def grouping(m):
    chosen = ev.communication_grouping(m.obs, "cluster", "batch", 20)
    return m.obs.agg(F.count(F.lit(1)).alias("n_cells")).select(F.lit(chosen).alias("grouping"), "n_cells")


@query(
    "a14_w09_w10_weight_summary",
    with_ctes(
        EXPR,
        "w AS (SELECT obs_id, var_id, value, value / sum(value) OVER (PARTITION BY obs_id) AS p FROM expr)",
        "SELECT obs_id, arg_min(var_id, (-value, var_id)) AS dominant_type, max(value) AS top1_weight, round(-sum(p * ln(p + 1e-12)), 6) AS entropy, count(*) FILTER (value > 0.05) AS n_types_weight_gt_0_05 FROM w GROUP BY 1",
    ),
)
def weights(m):
    return ev.weight_summary(m.expr, kind="var_id", weight="value").withColumn("entropy", F.round("entropy", 6))


@query(
    "f09_s09_ligand_receptor",
    "SELECT p_partkey, len(regexp_split_to_array(l, '[|;,]')) AS ligand_n_subunits, len(regexp_split_to_array(r, '[|;,]')) AS receptor_n_subunits, "
    "len(regexp_split_to_array(l, '[|;,]')) > 1 OR len(regexp_split_to_array(r, '[|;,]')) > 1 AS complex_sensitive FROM "
    "(SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN replace(p_name, ' ', '|') WHEN 1 THEN replace(p_name, ' ', ';') ELSE p_name END AS l, CASE WHEN p_partkey % 2 = 0 THEN replace(p_type, 'A', ',') ELSE p_type END AS r FROM part)",
)
def ligand_receptor(m):
    k = F.col("p_partkey")
    lr = m.table("part").select(
        "p_partkey", F.when(k % 3 == 0, F.translate("p_name", " ", "|")).when(k % 3 == 1, F.translate("p_name", " ", ";")).otherwise(F.col("p_name")).alias("ligand"),
        F.when(k % 2 == 0, F.translate("p_type", "A", ",")).otherwise(F.col("p_type")).alias("receptor"),
    )
    out = ev.ligand_receptor_flags(lr)
    return out.select("p_partkey", F.col("ligand_n_subunits").cast("bigint").alias("ligand_n_subunits"), F.col("receptor_n_subunits").cast("bigint").alias("receptor_n_subunits"), "complex_sensitive")
