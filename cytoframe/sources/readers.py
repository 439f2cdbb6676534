"""Readers: wide or long tables on shared storage into the long model."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.operators.abundance import long_counts
from cytoframe.operators.cnv import normalize_coordinates
from cytoframe.operators.evidence import ligand_receptor_flags
from cytoframe.schema import require_columns


def read_table(spark: SparkSession, path: str, columns: str | None = None) -> DataFrame:
    """Parquet, TSV/TXT or CSV by suffix; delimited text stays STRING unless ``columns`` (DDL) is given."""
    kind = os.path.splitext(path.rstrip("/"))[1].lower()
    if kind in (".parquet", ".pq"):
        return spark.read.parquet(path)
    if kind not in (".tsv", ".txt", ".csv"):
        raise ValueError(f"unsupported table format: {path}")
    reader = spark.read.option("header", True).option("sep", "," if kind == ".csv" else "\t")
    return (reader.schema(columns) if columns else reader).csv(path)


def melt_matrix(wide: DataFrame, row_key: str, column_name: str, value_name: str = "value") -> DataFrame:
    """Wide matrix to non-zero triples; text that is no number counts as 0."""
    names = [c for c in wide.columns if c != row_key]
    typed = wide.select(row_key, *[F.coalesce(F.expr(f"try_cast(`{c}` as double)"), F.lit(0.0)).alias(c) for c in names])
    return typed.unpivot([row_key], names, column_name, value_name).where(F.col(value_name) != 0)


def read_counts(spark: SparkSession, path: str, genes_in_rows: bool = True) -> DataFrame:
    """Matrix file to ``expr``; the first non-numeric column (else the first) names the rows."""
    wide = read_table(spark, path)
    text = [n for n, t in wide.dtypes if t == "string"]
    key = text[0] if text and path.rstrip("/").endswith((".parquet", ".pq")) else wide.columns[0]
    row, col = ("var_id", "obs_id") if genes_in_rows else ("obs_id", "var_id")
    return melt_matrix(wide.withColumnRenamed(key, row), row, col).select("obs_id", "var_id", "value")


def read_cells(spark: SparkSession, path: str, key: str = "obs_id") -> DataFrame:
    return require_columns(read_table(spark, path), [key], "cell metadata")


def read_gene_coordinates(spark: SparkSession, path: str) -> DataFrame:
    return normalize_coordinates(read_table(spark, path))


def read_pseudobulk(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """counts.tsv and metadata.tsv of one folder, both restricted to their common pseudobulk_ids."""
    counts = read_table(spark, os.path.join(folder, "counts.tsv"))
    meta = read_table(spark, os.path.join(folder, "metadata.tsv"))
    for name, df in (("counts", counts), ("metadata", meta)):
        require_columns(df, ["pseudobulk_id"], name)
    shared = counts.select("pseudobulk_id").join(meta.select("pseudobulk_id"), "pseudobulk_id", "left_semi")
    long = melt_matrix(counts, "pseudobulk_id", "var_id", "count").join(shared, "pseudobulk_id", "left_semi")
    return long, meta.join(shared, "pseudobulk_id", "left_semi")


def read_composition(spark: SparkSession, path: str, sample_key: str = "sample_id") -> DataFrame:
    """Wide sample x cell-type counts; unlike counts taken from cells these are not filtered."""
    return long_counts(read_table(spark, path), sample_key)


def read_ligand_receptor(spark: SparkSession, path: str) -> DataFrame:
    return ligand_receptor_flags(read_table(spark, path))


def read_program_matrix(spark: SparkSession, path: str, row: str = "program", column: str = "var_id") -> DataFrame:
    """Spectra or usage TSV whose first column is the index."""
    wide = read_table(spark, path)
    return melt_matrix(wide.withColumnRenamed(wide.columns[0], row), row, column, "weight")


def place_spots(counts: DataFrame, positions: DataFrame, sample: str) -> tuple[DataFrame, DataFrame]:
    """Prefix barcodes with the sample and left-join tissue positions: (expr, obs)."""
    named = F.concat_ws(":", F.lit(sample), "barcode")
    obs = counts.select("barcode").distinct().join(positions, "barcode", "left")
    return counts.select(named.alias("obs_id"), "var_id", "value"), obs.select(
        named.alias("obs_id"), F.lit(sample).alias("sample_id"), *[c for c in positions.columns if c != "barcode"]
    )


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    return read_table(
        spark, path, "barcode string, in_tissue int, array_row int, array_col int, pxl_row_in_fullres double, pxl_col_in_fullres double"
    )


def parse_elapsed(text) -> F.Column:
    """'h:mm:ss', 'm:ss' or plain seconds to seconds."""
    parts = F.transform(F.split(F.trim(text), ":"), lambda p: p.cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda total, p: total * 60 + p)


# Line prefixes of the resource report printed by the `time -v` tool.
TIME_PREFIXES = {
    "elapsed_seconds": "Elapsed (wall clock) time (h:mm:ss or m:ss):",
    "max_rss_mb": "Maximum resident set size (kbytes):",
    "cpu_percent": "Percent of CPU this job got:",
    "user_seconds": "User time (seconds):",
    "system_seconds": "System time (seconds):",
    "exit_status": "Exit status:",
}


def parse_time_logs(lines: DataFrame) -> DataFrame:
    """One row of measurements per log file from (path, value) text lines."""
    line = F.regexp_replace("value", r"^\s+|\s+$", "")

    def field(name):
        prefix = TIME_PREFIXES[name]
        raw = F.trim(F.substring(line, len(prefix) + 1, 200))
        value = {
            "elapsed_seconds": parse_elapsed(raw), "max_rss_mb": F.round(raw.cast("double") / 1024, 1),
            "cpu_percent": F.rtrim(raw, F.lit("%")).cast("double"),
        }.get(name, raw.cast("double"))
        return F.max(F.when(line.startswith(prefix), value)).alias(name)

    signal = F.regexp_extract(line, r"Command terminated by signal (\d+)", 1)
    return lines.groupBy("path").agg(
        *[field(n) for n in TIME_PREFIXES], F.max(F.when(signal != "", signal.cast("int"))).alias("terminated_by_signal")
    )


def read_time_logs(spark: SparkSession, pattern: str) -> DataFrame:
    return parse_time_logs(spark.read.text(pattern).select(F.col("_metadata.file_path").alias("path"), "value"))


def folder_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Number of files and MB below a folder (file listing only, contents are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("length")
    return files.agg(F.count(F.lit(1)).alias("n_files"), (F.sum("length") / 1024 / 1024).alias("mb"))


def read_skills(spark: SparkSession, folder: str) -> DataFrame:
    """Annotation skills, one ``<name>/skill.yaml`` each, parsed where the files are read."""
    def parse(batches):
        import yaml

        for pdf in batches:
            fields = [{str(k): str(v) for k, v in (yaml.safe_load(text) or {}).items()} for text in pdf["value"]]
            yield pd.DataFrame({"skill": [os.path.basename(os.path.dirname(path)) for path in pdf["path"]], "fields": fields})

    files = spark.read.text(os.path.join(folder, "*", "skill.yaml"), wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "value").mapInPandas(parse, "skill string, fields map<string,string>")
