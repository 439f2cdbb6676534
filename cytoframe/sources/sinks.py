"""Writers, file manifest, artifact registry and decision log."""

from __future__ import annotations

import hashlib
import json
import os
import re

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHOLE, PIECE = 128 << 20, 8 << 20

LOG_SCHEMA = (
    "run_id string, ts timestamp, module string, decision string, reason string, parameters map<string,string>, "
    "evidence map<string,string>, human_review_required boolean, review_reason string, actor string"
)


def write_table(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Parquet, TSV/TXT or CSV folder by suffix; ``single_file`` is for small human-readable tables."""
    kind = os.path.splitext(path)[1].lower()
    out = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    if kind == ".parquet":
        out.parquet(path)
    elif kind in (".tsv", ".txt", ".csv"):
        out.option("header", True).option("sep", "," if kind == ".csv" else "\t").csv(path)
    else:
        raise ValueError(f"unsupported table format: {path}")
    return path


def write_json(spark: SparkSession, payload: dict, path: str) -> str:
    """One JSON document with sorted keys, through Spark's filesystem so the path may be remote."""
    text = json.dumps(payload, sort_keys=True, default=str, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def append_jsonl(df: DataFrame, path: str) -> str:
    df.select(*sorted(df.columns)).write.mode("append").json(path)
    return path


def safe_name(c: Column) -> Column:
    """Anything outside letters, digits, '-', '_' and '.' becomes '_'."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}._-]", "_")


def safe_cell_type(c: Column) -> Column:
    return F.translate(c, "/ ", "__")


def write_cnv(cells: DataFrame, window_table: DataFrame, folder: str, mode: str = "compact", sample_key: str = "sample_id") -> None:
    """Cell summary and windows; per-window scores unless compact; one partition folder per sample."""
    if mode not in ("compact", "parquet", "tsv"):
        raise ValueError(f"unknown output mode: {mode}")
    scores = [c for c in ("scores", "trimmed") if c in cells.columns]
    named = cells.withColumn(sample_key, safe_name(F.col(sample_key).cast("string")))
    named.drop(*scores).write.mode("overwrite").partitionBy(sample_key).parquet(os.path.join(folder, "cells.parquet"))
    write_table(window_table, os.path.join(folder, "windows.tsv"), single_file=True)
    if mode != "compact" and scores:
        flat = named.select("obs_id", sample_key, F.posexplode(F.arrays_zip(*scores)).alias("window_no", "s")).select("obs_id", sample_key, "window_no", "s.*")
        target = flat.write.mode("overwrite").partitionBy(sample_key)
        if mode == "parquet":
            target.parquet(os.path.join(folder, "scores.parquet"))
        else:
            target.option("header", True).option("sep", "\t").csv(os.path.join(folder, "scores.tsv"))


def write_composition(counts: DataFrame, folder: str) -> None:
    """counts.tsv and proportions.tsv in wide form."""
    for column, name in (("n", "counts"), ("prop", "proportions")):
        wide = counts.groupBy("sample_id").pivot("cell_type").agg(F.max(column)).na.fill(0)
        write_table(wide, os.path.join(folder, f"{name}.tsv"), single_file=True)


def _hashed(batches):
    """sha256 of the files at ``path``, read a piece at a time."""
    for pdf in batches:
        sums = []
        for path in pdf["path"]:
            # Spark's paths are not escaped, so local ones are no URIs
            local = path.startswith(("file:", "/"))
            source, name = (LocalFileSystem(), re.sub(r"^(file:)?/+", "/", path)) if local else FileSystem.from_uri(re.sub(r"^s3a:", "s3:", path))
            state = hashlib.sha256()
            with source.open_input_stream(name) as stream:
                while piece := stream.read(PIECE):
                    state.update(piece)
            sums.append(state.hexdigest())
        yield pdf.assign(sha256=sums)


def file_manifest(spark: SparkSession, folder: str, skip: str = "manifest.json") -> DataFrame:
    """Relative path, bytes and sha256 of every file below a folder.

    Files above ``WHOLE`` bytes are read in pieces through ``pyarrow.fs``: a task holds one piece, and a file may be larger than a Spark value.
    The hash chains over a file's bytes, so one task still passes over each whole file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = os.path.basename(folder.rstrip("/"))
    rel = F.substring_index("path", f"/{root}/", -1)
    small = files.where(F.col("length") <= WHOLE).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > WHOLE).select("path", "length").mapInPandas(_hashed, "path string, length bigint, sha256 string")
    return small.unionByName(large).select(rel.alias("path"), F.col("length").alias("bytes"), "sha256").where(
        F.element_at(F.split("path", "/"), -1) != skip
    )


def latest_per_key(entries: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Registry upsert: the last entry of each key, as a mergeable aggregate."""
    rest = [c for c in entries.columns if c not in keys]
    return entries.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_e")).select(*keys, "_e.*")


def register_files(registry: DataFrame | None, new: DataFrame) -> DataFrame:
    """Entries (category, key, path, format, sha256, bytes, schema, registered_at) replace older ones of the same key."""
    both = new if registry is None else registry.unionByName(new, allowMissingColumns=True)
    return latest_per_key(both, ["category", "key"], ["registered_at"])


def log_entry(
    df: DataFrame, run_id: str, module: str, decision: Column, reason: Column, parameters: Column, evidence: Column,
    review: Column, review_reason: Column, actor: str = "workflow",
) -> DataFrame:
    return df.select(
        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("ts"), F.lit(module).alias("module"), decision.alias("decision"),
        reason.alias("reason"), parameters.alias("parameters"), evidence.alias("evidence"), review.alias("human_review_required"),
        review_reason.alias("review_reason"), F.lit(actor).alias("actor"),
    )
