"""Cluster evidence, decision validation and commit, and the smaller gating rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe.schema import DECISION, require_columns

# Vocabularies of the rules.
CONFIDENCE = ("high", "medium", "low")
TUMOUR_TERMS = ("malignant", "tumor", "tumour", "cancer", "neoplastic")
PROGRAM_TERMS = ("ribosomal", "mitochondrial", "stress", "cell-cycle", "cell_cycle", "cycling")
FREE_PREFIXES = ("external:", "manual:", "skill:")
TUMOUR_VALUES = ("tumor", "malignant", "aneuploid", "positive", "true", "1")
CNV_FIELDS = ("reference_pool", "cnv_fraction", "normal_threshold", "tumor_evidence")
OBS_FIELDS = ("cell_type_lvl1", "cell_type_lvl2", "cell_type_lvl3", "cell_state", "annotation_confidence", "annotation_status")
HEMOGLOBIN = ("HBA", "HBB", "HBD", "HBE", "HBG", "HBM", "HBQ", "HBZ")
CELL_CYCLE = ("MKI67", "TOP2A", "UBE2C", "HMGB2", "PCNA", "TYMS", "CCNB1", "CCNB2", "CDK1", "MCM5")
STRESS = ("HSPA1A", "HSPA1B", "HSP90AA1", "JUN", "FOS", "DUSP1", "ATF3", "IER2", "DNAJB1")
LINEAGE = ("PTPRC", "EPCAM", "KRT8", "KRT18", "PECAM1", "VWF", "COL1A1", "DCN")


# ---------------------------------------------------------------- evidence per cluster
def evidence_template(obs: DataFrame, cluster_key: str = "cluster") -> DataFrame:
    pending = {c: F.lit("pending") for c in ("marker_evidence", "nmf_evidence", "knn_evidence", "reference_evidence")}
    base = obs.groupBy(F.col(cluster_key).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_distinct("sample_id").alias("n_samples")
    )
    return base.withColumns(
        {"proposed_label": F.lit("review_required"), **pending, "confidence": F.lit("low"), "human_review_required": F.lit(True)}
    )


def value_counts(obs: DataFrame, cluster_key: str, column: str) -> DataFrame:
    """Counts of a column's values per cluster; the pair count is taken before any list is built."""
    return obs.where(F.col(column).isNotNull()).groupBy(F.col(cluster_key).alias("cluster_id"), F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _as_map(counts: DataFrame, name: str) -> DataFrame:
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n"))))
    return counts.groupBy("cluster_id").agg(entries.alias(name))


def top_values(counts: DataFrame, name: str, n: int = 3) -> DataFrame:
    """The n most frequent values as an array; equal counts are ordered by value."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "value")))
    return counts.groupBy("cluster_id").agg(F.transform(F.slice(ordered, 1, n), lambda s: s["value"]).alias(name))


def cluster_evidence(
    obs: DataFrame, cluster_key: str, marker_refs: Sequence[str] = (), reference_refs: Sequence[str] = (),
    nmf_refs: Sequence[str] = (),
) -> DataFrame:
    """One evidence record per cluster; optional columns of ``obs`` switch their parts on."""
    require_columns(obs, [cluster_key], "obs")
    has = set(obs.columns)
    aggs = [F.count(F.lit(1)).alias("n_cells")]
    if "sample_id" in has:
        aggs.append(F.count_distinct("sample_id").alias("n_samples"))
    if "tumor_evidence" in has:
        aggs.append(F.coalesce(F.bool_or(F.lower("tumor_evidence").isin(*TUMOUR_VALUES)), F.lit(False)).alias("has_tumor_evidence"))
    if "cnv_fraction" in has:
        number = F.expr("try_cast(cnv_fraction as double)")
        aggs += [F.avg(number).alias("cnv_fraction_mean"), F.max(number).alias("cnv_fraction_max")]
    if "qc_pass" in has:
        aggs.append(F.bool_and("qc_pass").alias("_ok"))
    out = obs.groupBy(F.col(cluster_key).alias("cluster_id")).agg(*aggs)
    program = next((c for c in ("dominant_nmf_program", "dominant_program", "program") if c in has), None)
    if program:
        out = out.join(top_values(value_counts(obs, cluster_key, program), "dominant_programs"), "cluster_id", "left")
    for column, name in (("tumor_evidence", "tumor_evidence_counts"), ("reference_pool", "reference_pool_counts")):
        if column in has:
            out = out.join(_as_map(value_counts(obs, cluster_key, column), name), "cluster_id", "left")
    texts = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    warning = F.when(~F.col("_ok"), F.array(F.lit("cluster_contains_qc_failed_cells"))).otherwise(texts([])) if "qc_pass" in has else texts([])
    return out.withColumns(
        {
            "cluster_id": F.col("cluster_id").cast("string"), "marker_refs": texts(marker_refs), "reference_refs": texts(reference_refs),
            "nmf_refs": texts(nmf_refs), "cnv_refs": texts([c for c in CNV_FIELDS if c in has]), "qc_warnings": warning,
        }
    ).drop("_ok")


# ---------------------------------------------------------------- decisions
def parse_decisions(df: DataFrame, text: str) -> DataFrame:
    """Decisions from JSON text: one object, a list, or {"decisions": [...]}; defaults filled in."""
    many = T.ArrayType(DECISION)
    kind = F.substring(F.ltrim(F.col(text)), 1, 1)
    wrapped = F.get_json_object(F.col(text), "$.decisions")
    single = F.array(F.from_json(F.col(text), DECISION))
    items = (
        F.when(kind == "[", F.from_json(F.col(text), many)).when(wrapped.isNull(), single)
        .when(F.substring(wrapped, 1, 1) == "[", F.from_json(wrapped, many)).otherwise(F.array(F.from_json(wrapped, DECISION)))
    )
    out = df.select(F.explode(items).alias("d")).select("d.*")
    empty = F.array().cast("array<string>")
    return out.withColumns(
        {
            "schema_version": F.coalesce("schema_version", F.lit("annotation_decision.v1")),
            "evidence_refs": F.coalesce("evidence_refs", F.create_map().cast("map<string,array<string>>")),
            **{c: F.coalesce(c, empty) for c in ("positive_markers", "negative_markers_absent", "conflicts")},
            "review_required": F.coalesce("review_required", F.lit(False)),
        }
    )


def _mentions(columns: Sequence[str], terms: Sequence[str]) -> Column:
    text = F.lower(F.concat_ws(" ", *[F.col(c) for c in columns]))
    return text.rlike("|".join(terms))


def unknown_refs(known: Column) -> Column:
    """Sorted distinct references that are neither known nor exempt by prefix."""
    refs = F.flatten(F.map_values("evidence_refs"))
    exempt = lambda r: r.startswith(FREE_PREFIXES[0]) | r.startswith(FREE_PREFIXES[1]) | r.startswith(FREE_PREFIXES[2])
    return F.array_sort(F.array_distinct(F.filter(refs, lambda r: ~F.array_contains(known, r) & ~exempt(r))))


def cites_cnv() -> Column:
    key = F.exists(F.map_entries("evidence_refs"), lambda e: F.lower(e["key"]).contains("cnv") & (F.size(e["value"]) > 0))
    ref = F.exists(F.flatten(F.map_values("evidence_refs")), lambda r: F.lower(r).contains("cnv"))
    return key | ref


def validate(
    decisions: DataFrame, evidence: DataFrame, is_tumour: bool, registry_refs: Sequence[str] = (),
    min_cells_high: int = 20, min_samples_high: int = 2,
) -> DataFrame:
    """Ordered rule check of each decision against its cluster's evidence."""
    tumour = F.col("has_tumor_evidence") if "has_tumor_evidence" in evidence.columns else F.lit(False)
    known = F.concat("marker_refs", "nmf_refs", "reference_refs", "cnv_refs", F.array(*[F.lit(r) for r in registry_refs]).cast("array<string>"))
    samples = F.col("n_samples") if "n_samples" in evidence.columns else F.lit(None).cast("bigint")
    facts = evidence.select(
        "cluster_id", F.col("n_cells").alias("_cells"), samples.alias("_samples"), known.alias("_known"),
        ((F.size("cnv_refs") > 0) & F.coalesce(tumour, F.lit(False))).alias("_cnv"), F.lit(True).alias("_found"),
    )
    j = decisions.join(facts, "cluster_id", "left")
    strange = unknown_refs(F.coalesce("_known", F.array().cast("array<string>")))
    labels, states = ("parent_label", "canonical_label", "final_label"), ("cell_state", "functional_modifier")
    high = F.col("confidence") == "high"
    rules = [
        F.when(F.size(strange) > 0, F.concat(F.lit("unknown evidence refs: "), F.array_join(strange, ", "))),
        F.when(_mentions(labels, PROGRAM_TERMS) & ~_mentions(states, PROGRAM_TERMS), "program-dominated label should be represented as cell_state or functional_modifier"),
        F.when(F.lit(is_tumour) & _mentions(labels, TUMOUR_TERMS) & ~(cites_cnv() | F.col("_cnv")), "tumor/malignant label requires CNV evidence or review"),
        F.when(high & (F.size("conflicts") > 0), "marker conflicts prevent high confidence"),
        F.when(high & (F.col("_cells") < min_cells_high), "cluster has too few cells for high confidence"),
        F.when(high & (F.col("_samples") < min_samples_high), "cluster has too few samples for high confidence"),
    ]
    stop = (
        F.when(F.col("_found").isNull(), "cluster not found in evidence bundle")
        .when(~F.coalesce(F.col("confidence").isin(*CONFIDENCE), F.lit(False)), "invalid confidence")
        .when(F.trim(F.coalesce("final_label", F.lit(""))) == "", "empty final_label")
    )
    j = j.withColumns({"_stop": stop, "_hits": F.array_compact(F.array(*rules))})
    valid = F.col("_stop").isNull()
    forced = ~valid | (F.size("_hits") > 0)
    review = forced | F.col("review_required")
    reasons = (
        F.when(~valid, F.array("_stop")).when(F.size("_hits") > 0, F.col("_hits"))
        .when(F.col("review_required"), F.array(F.lit("decision requested review"))).otherwise(F.array(F.lit("validation passed")))
    )
    j = j.withColumns({"valid": valid, "forced_review": forced, "accepted": ~review, "reasons": reasons, "review_required": review})
    return j.drop("_cells", "_samples", "_known", "_cnv", "_found", "_stop", "_hits")


def commit_decisions(obs: DataFrame, validated: DataFrame, cluster_key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """Write accepted labels to the cells of their cluster; the last accepted decision wins.

    Returns (obs with the six fields, merge log).
    """
    require_columns(obs, [cluster_key], "obs")
    accepted = validated.where("accepted")
    fields = F.struct("parent_label", "canonical_label", "final_label", F.coalesce("cell_state", F.lit("")).alias("cell_state"), "confidence")
    last = accepted.groupBy("cluster_id").agg(F.max_by(fields, F.col(order)).alias("_d"))
    start = {c: F.lit("unassigned" if c != "cell_state" else "") for c in OBS_FIELDS if c not in obs.columns}
    base = obs.withColumns(start) if start else obs
    j = base.withColumn("cluster_id", F.col(cluster_key).cast("string")).join(last, "cluster_id", "left")
    new = {
        "cell_type_lvl1": "_d.parent_label", "cell_type_lvl2": "_d.canonical_label", "cell_type_lvl3": "_d.final_label",
        "cell_state": "_d.cell_state", "annotation_confidence": "_d.confidence",
    }
    j = j.withColumns({k: F.coalesce(F.col(v), F.col(k)) for k, v in new.items()})
    j = j.withColumn("annotation_status", F.when(F.col("_d").isNotNull(), "accepted").otherwise(F.col("annotation_status")))
    sizes = obs.groupBy(F.col(cluster_key).cast("string").alias("cluster_id")).agg(F.count(F.lit(1)).alias("n_cells"))
    log = accepted.join(sizes, "cluster_id", "left").select(
        order, "cluster_id", F.lit("commit").alias("action"), F.coalesce("n_cells", F.lit(0)).alias("n_cells"), "final_label"
    )
    return j.drop("cluster_id", "_d"), log


# ---------------------------------------------------------------- rules on programs, labels, resources
def _starting(genes: Column, prefixes: Sequence[str]) -> Column:
    return F.filter(genes, lambda g: g.rlike("^(" + "|".join(prefixes) + ")"))


def sanitize_programs(programs: DataFrame, fraction: float = 0.35, overlap: int = 2) -> DataFrame:
    """Class and action of each gene program from its top genes; first matching rule wins."""
    clean = F.transform(F.filter("genes", lambda g: F.trim(g) != ""), lambda g: F.upper(g))
    p = programs.withColumn("top_genes", clean)
    n = F.size("top_genes")
    inside = lambda values: F.filter("top_genes", lambda g: g.isin(*values))
    empty = F.array().cast("array<string>")
    share = lambda prefixes: F.try_divide(F.size(_starting(F.col("top_genes"), prefixes)).cast("double"), n) >= fraction
    rules = [
        (n == 0, "unknown", "review", empty, "no genes supplied"),
        (share(("RPL", "RPS")), "ribosomal", "exclude_from_identity", _starting(F.col("top_genes"), ("RPL", "RPS")), "ribosomal gene prefix enrichment"),
        (share(("MT-",)), "mitochondrial", "exclude_from_identity", _starting(F.col("top_genes"), ("MT-",)), "mitochondrial gene prefix enrichment"),
        (share(HEMOGLOBIN), "hemoglobin", "exclude_from_identity", _starting(F.col("top_genes"), HEMOGLOBIN), "hemoglobin gene enrichment"),
        (F.size(inside(CELL_CYCLE)) >= overlap, "cell_cycle", "state_only", inside(CELL_CYCLE), "cell-cycle marker overlap"),
        (F.size(inside(STRESS)) >= overlap, "stress", "state_only", inside(STRESS), "stress/immediate-early marker overlap"),
        (F.size(inside(LINEAGE)) >= 3, "mixed", "review", inside(LINEAGE), "multiple incompatible lineage markers"),
        (F.lit(True), "identity", "keep_for_identity", empty, "no nuisance signature detected"),
    ]
    result = None
    for cond, cls, action, matched, reason in rules:
        item = F.struct(F.lit(cls).alias("program_class"), F.lit(action).alias("action"), matched.alias("matched_genes"), F.lit(reason).alias("reason"))
        result = F.when(cond, item) if result is None else result.when(cond, item)
    return p.withColumn("_r", result).select("program", "_r.program_class", "_r.action", "top_genes", "_r.matched_genes", "_r.reason")


def origin_label(mo: Column, trm: Column, microglia: Column) -> tuple[Column, Column]:
    """(origin label, confidence) of a macrophage from three module scores."""
    delta = mo - trm
    label = (
        F.when(delta > 0.15, "Mo-like").when((delta < -0.15) & (microglia > 0.2), "Microglia-like TRM")
        .when(delta < -0.15, "TRM-like").otherwise("Intermediate")
    )
    return label, F.least(F.abs(delta) / 0.4, F.lit(1.0))


def deconvolution_mode(unit: Column, expected_cells: Column, low_resolution: str = "full") -> Column:
    """Mode by spatial unit: bins with at most three cells are 'multi', cells 'doublet', else the default."""
    kind = F.lower(F.coalesce(unit, F.lit("")))
    return (
        F.when(kind.isin("bin", "visium_hd_bin", "stereoseq_bin") & (expected_cells <= 3), "multi")
        .when(kind.isin("cell", "segmented_cell"), "doublet").otherwise(low_resolution)
    )


def weight_summary(weights: DataFrame, unit: str = "obs_id", kind: str = "cell_type", weight: str = "weight") -> DataFrame:
    """Dominant type, its weight, entropy and number of types above 0.05 per spatial unit.

    Absent types have weight 0 and add nothing; ties go to the first type name.
    """
    w = F.col(weight)
    totals = weights.groupBy(unit).agg(F.sum(w).alias("_t"))
    share = w / F.when(F.col("_t") == 0, F.lit(1.0)).otherwise(F.col("_t"))
    per = weights.join(totals, unit).withColumn("_p", share)
    return per.groupBy(unit).agg(
        F.min_by(F.col(kind), F.struct((-w).alias("a"), F.col(kind).alias("b"))).alias("dominant_type"), F.max(w).alias("top1_weight"),
        (-F.sum(F.col("_p") * F.ln(F.col("_p") + 1e-12))).alias("entropy"), F.count_if(w > 0.05).alias("n_types_weight_gt_0_05"),
    )


def ligand_receptor_flags(resource: DataFrame) -> DataFrame:
    """Subunit columns default to the molecule; a side with several subunits makes a complex."""
    require_columns(resource, ["ligand", "receptor"], "ligand-receptor resource")
    side = lambda c: F.col(f"{c}_subunits") if f"{c}_subunits" in resource.columns else F.col(c)
    out = resource.withColumns({"ligand_subunits": side("ligand"), "receptor_subunits": side("receptor")})
    parts = lambda c: F.size(F.split(F.col(c), "[|;,]"))
    out = out.withColumns({"ligand_n_subunits": parts("ligand_subunits"), "receptor_n_subunits": parts("receptor_subunits")})
    return out.withColumn("complex_sensitive", (F.col("ligand_n_subunits") > 1) | (F.col("receptor_n_subunits") > 1))


def communication_grouping(obs: DataFrame, primary: str, fallback: str, min_cells: int) -> str:
    """The primary grouping if its smallest group is large enough, else the fallback."""
    if primary in obs.columns:
        smallest = obs.groupBy(primary).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).head()[0]
        if smallest is not None and smallest >= min_cells:
            return primary
    if fallback in obs.columns:
        return fallback
    raise KeyError(f"neither {primary} nor {fallback} can group the cells")
