"""Shared pieces of the text operators: table access, row keys, ASCII rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.session import ship_package

#: The characters that separate words: space and \x09-\x0D.
BLANKS = " \t\n\x0b\f\r"
BLANK_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The same in DuckDB's SQL.
SQL_BLANKS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def sql_lower(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"




def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def fold(doc_id: str, n: int, rest: int) -> Column:
    """Whether crc32(doc_id as text) mod n is ``rest``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % n == rest, F.lit(False))


def row_key() -> dict[str, Column]:
    """Two columns that only rows of the same document and text share (a null id counts as 0)."""
    return {"_id": F.coalesce(F.col("doc_id"), F.lit(0)).cast("bigint"), "_t": F.xxhash64("text")}


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
