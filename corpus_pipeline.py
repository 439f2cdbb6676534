"""A corpus pipeline: each stage reads what the one before has written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import chosen_path, decontaminate, language_backoff, line_ledger, mix_flow
from cytoframe.llm.common import fold, row_key, table
from cytoframe.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: SQL can't fit the language model, search the index or route the flow; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: no letter, or a score below what held-out documents of the length have.

    Where no row has a language to learn from, all documents with a letter stay.
    """
    held = fold("doc_id", 4, 2)
    model = language_backoff.train(docs.where(~held))
    if model is None:
        return docs.select(*COLUMNS).where(r"text RLIKE '\\p{L}'")
    edges = language_backoff.least_scores(docs.where(held), model)
    told = language_backoff.identify(docs.select(*COLUMNS), model).where("lang_pred <> 'und'")
    low = F.lit(False)
    for c, edge in edges.items():
        low = low | ((language_backoff.length_class() == c) & (F.col("score") < edge))
    return told.where(~low).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; a document that keeps no word goes with them."""
    ledger = line_ledger.new_ledger(spark).insert(docs)
    kept = line_ledger.drop_common_lines(docs.select(*COLUMNS), ledger)
    kept = kept.where(r"kept RLIKE '[^\\x20\\x09-\\x0D]'")
    changed = F.col("n_dropped") > 0
    return kept.select(
        "doc_id", F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(changed, F.char_length("kept").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five-word shingles, similarity 0.8) stays: the one with the smallest id."""
    return chosen_path.one_of_each(docs.select(*COLUMNS), k=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    rows = docs.select(*COLUMNS).withColumn("_row", F.xxhash64("doc_id", "text"))
    found = decontaminate.matches(rows.select(F.col("_row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return rows.join(found.select(F.col("doc_id").alias("_row")).distinct(), "_row", "left_anti").select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``taken``: their words times their copies."""
    taken = mix_flow.mix(docs.select("doc_id", "text", "source")).where("taken > 0")
    taken = taken.groupBy("_id", "_t").agg(F.max("taken").alias("taken"))
    return docs.select(*COLUMNS).withColumns(row_key()).join(taken, ["_id", "_t"]).select(*COLUMNS, "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near duplicates", near_stage),
    ("benchmark", benchmark_stage),
    ("mix", mix_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{n}")
        docs = spark.read.parquet(f"{root}/{n}")
    return docs
