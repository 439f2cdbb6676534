"""Source and sink round trips in the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cytoframe.adapters import EXPR, OBS, with_ctes
from cytoframe.operators.abundance import composition, wide_counts
from cytoframe.operators.tables import align_left
from cytoframe.session import ensure_checkpoint_dir
from cytoframe.sources import readers, sinks
from cytoframe.streaming.decision_log import copy_new_entries
from cytoframe.suite import query


def work_path(m, name: str) -> str:
    ensure_checkpoint_dir(m.spark)
    return f"{m.spark.sparkContext.getCheckpointDir()}/io-{uuid.uuid4().hex}/{name}"


def _wide(m):
    return m.expr.groupBy("obs_id").pivot("var_id").agg(F.sum("value"))


@query("s02_s14_counts_tsv", with_ctes(EXPR, "SELECT CAST(obs_id AS VARCHAR) AS obs_id, var_id, value FROM expr"))
def counts_tsv(m):
    path = sinks.write_table(_wide(m), work_path(m, "counts.tsv"))
    return readers.read_counts(m.spark, path, genes_in_rows=False)


@query("s02_counts_parquet", with_ctes(EXPR, "SELECT CAST(obs_id AS VARCHAR) AS obs_id, var_id, value FROM expr"))
def counts_parquet(m):
    path = sinks.write_table(_wide(m).withColumn("obs_id", F.col("obs_id").cast("string")), work_path(m, "counts.parquet"))
    return readers.read_counts(m.spark, path, genes_in_rows=False)


@query("s03_cells_csv", with_ctes(OBS, "SELECT CAST(obs_id AS VARCHAR) AS obs_id, cluster FROM obs"))
def cells_csv(m):
    path = sinks.write_table(m.obs, work_path(m, "cells.csv"))
    return readers.read_cells(m.spark, path).select("obs_id", "cluster")


@query(
    "s05_pseudobulk_dir",
    with_ctes(
        EXPR, OBS,
        "SELECT concat('S', sample_id) AS pseudobulk_id, var_id, sum(value) AS count FROM expr JOIN obs USING (obs_id) WHERE sample_id % 5 > 0 GROUP BY 1, 2",
    ),
)
def pseudobulk_dir(m):
    folder = work_path(m, "bulk")
    sid = F.concat(F.lit("S"), F.col("sample_id").cast("string")).alias("pseudobulk_id")
    wide = m.expr.join(m.obs.select("obs_id", sid), "obs_id").groupBy("pseudobulk_id").pivot("var_id").agg(F.sum("value"))
    sinks.write_table(wide, f"{folder}/counts.tsv", single_file=True)
    sinks.write_table(m.obs.where(F.col("sample_id") % 5 > 0).select(sid, "batch").distinct(), f"{folder}/metadata.tsv", single_file=True)
    return readers.read_pseudobulk(m.spark, folder)[0]


@query(
    "s06_s17_composition_tsv",
    "SELECT CAST(c_nationkey AS VARCHAR) AS sample_id, c_mktsegment AS cell_type, count(*) AS n FROM customer GROUP BY 1, 2",
)
def composition_tsv(m):
    path = sinks.write_table(wide_counts(composition(m.composition, 0, 0)), work_path(m, "counts.tsv"), single_file=True)
    return readers.read_composition(m.spark, path).where("n > 0").select("sample_id", "cell_type", "n")


@query("s11_program_matrix", with_ctes(EXPR, OBS, "SELECT cluster AS program, var_id, sum(value) AS weight FROM expr JOIN obs USING (obs_id) GROUP BY 1, 2"))
def program_matrix(m):
    wide = m.expr.join(m.obs.select("obs_id", "cluster"), "obs_id").groupBy("cluster").pivot("var_id").agg(F.sum("value"))
    return readers.read_program_matrix(m.spark, sinks.write_table(wide, work_path(m, "spectra.tsv"), single_file=True))


@query("s18_file_manifest")
def manifest(m):
    return sinks.file_manifest(m.spark, m.folder)


@query(
    "s20_x03_decision_log",
    "SELECT o_orderpriority AS decision, count(*) AS n, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS n_review FROM orders GROUP BY 1",
)
def decision_log(m):
    """Entries appended in two batches, read incrementally by a stream that runs until it is caught up."""
    log, target, state = work_path(m, "log"), work_path(m, "log.parquet"), work_path(m, "state")
    orders = m.table("orders")
    entry = sinks.log_entry(
        orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), "run", "annotation", F.col("o_orderpriority"), F.lit("rule"),
        F.create_map(F.lit("order"), F.col("o_orderkey").cast("string")), F.create_map(F.lit("status"), F.col("o_orderstatus")),
        F.col("o_orderstatus") == "F", F.when(F.col("o_orderstatus") == "F", "status"),
    )
    sinks.append_jsonl(entry.where(F.col("o_orderstatus") == "F"), log)
    copy_new_entries(m.spark, log, target, state)
    sinks.append_jsonl(entry.where(F.col("o_orderstatus") != "F"), log)
    copy_new_entries(m.spark, log, target, state)
    back = m.spark.read.parquet(target)
    return back.groupBy("decision").agg(F.count(F.lit(1)).alias("n"), F.count_if("human_review_required").alias("n_review"))


@query(
    "s17_composition_folder",
    "SELECT CAST(c_nationkey AS VARCHAR) AS sample_id, c_mktsegment AS cell_type, count(*) AS n, "
    "round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY c_nationkey) AS DOUBLE), 9) AS prop FROM customer GROUP BY c_nationkey, c_mktsegment",
)
def composition_folder(m):
    """Counts and proportions written as wide tables and read back."""
    folder = work_path(m, "composition")
    sinks.write_composition(composition(m.composition, 0, 0), folder)
    counts = readers.read_composition(m.spark, f"{folder}/counts.tsv").where("n > 0").select("sample_id", "cell_type", "n")
    wide = readers.read_table(m.spark, f"{folder}/proportions.tsv")
    types = [c for c in wide.columns if c != "sample_id"]
    props = wide.select("sample_id", *[F.col(f"`{c}`").cast("double").alias(c) for c in types]).unpivot(["sample_id"], types, "cell_type", "prop")
    return counts.join(props, ["sample_id", "cell_type"]).select("sample_id", "cell_type", "n", F.round("prop", 9).alias("prop"))


@query(
    "s10_positions_csv",
    "SELECT CAST(s_suppkey AS VARCHAR) AS barcode, CAST(s_suppkey % 2 AS INTEGER) AS in_tissue, CAST(s_nationkey AS INTEGER) AS array_row, "
    "CAST(s_suppkey % 78 AS INTEGER) AS array_col, CAST(s_acctbal AS DOUBLE) AS pxl_row_in_fullres, CAST(s_suppkey * 1.5 AS DOUBLE) AS pxl_col_in_fullres FROM supplier",
)
def positions_csv(m):
    spots = m.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("barcode"), (F.col("s_suppkey") % 2).cast("int").alias("in_tissue"), F.col("s_nationkey").cast("int").alias("array_row"),
        (F.col("s_suppkey") % 78).cast("int").alias("array_col"), F.col("s_acctbal").cast("double").alias("pxl_row_in_fullres"),
        (F.col("s_suppkey") * 1.5).cast("double").alias("pxl_col_in_fullres"),
    )
    return readers.read_positions(m.spark, sinks.write_table(spots, work_path(m, "positions.csv")))


@query(
    "s22_programs_to_cells",
    with_ctes(
        OBS, EXPR,
        "u AS (SELECT obs_id, sum(value) AS usage FROM expr WHERE var_id LIKE 'Brand#1%' GROUP BY 1)",
        "c AS (SELECT obs_id, CASE WHEN max(value) > 40 THEN 'gain' ELSE 'neutral' END AS cnv_class FROM expr WHERE var_id = 'Brand#23' GROUP BY 1)",
        "SELECT obs_id, sample_id, usage, cnv_class FROM obs LEFT JOIN u USING (obs_id) LEFT JOIN c USING (obs_id)",
    ),
)
def programs_to_cells(m):
    """Program usages and copy-number classes joined back; cells without either stay."""
    use = m.expr.where(F.col("var_id").startswith("Brand#1")).groupBy("obs_id").agg(F.sum("value").alias("usage"))
    kinds = m.expr.where("var_id = 'Brand#23'").groupBy("obs_id").agg(F.when(F.max("value") > 40, "gain").otherwise("neutral").alias("cnv_class"))
    cells = m.obs.select("obs_id", "sample_id")
    return align_left(align_left(cells, use, "obs_id"), kinds, "obs_id")


@query("s15_run_summary", "SELECT count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers FROM orders")
def run_summary(m):
    """Totals of the orders table written as one JSON document and read back."""
    totals = m.table("orders").agg(F.count(F.lit(1)).alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers")).first().asDict()
    path = sinks.write_json(m.spark, totals, work_path(m, "summary.json"))
    return m.spark.read.schema("n_orders bigint, n_customers bigint").json(path)
