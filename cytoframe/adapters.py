"""Views of the bundled star-schema tables in cell-by-gene form.

Customers play the cells (those without orders have no counts), brands (or single parts) the genes, nations the
samples, market segments the clusters.  ``expr`` holds non-zero summed quantities only.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.session import ship_package

SYMBOL_SQL = (
    "concat(CASE WHEN p_brand LIKE 'Brand#1%' THEN 'MT-' WHEN p_brand LIKE 'Brand#2%' THEN 'RPL' "
    "WHEN p_brand LIKE 'Brand#3%' THEN 'RPS' WHEN p_brand LIKE 'Brand#4%' THEN 'HBA' ELSE 'GENE' END, "
    "substr(p_brand, 7))"
)


class Model:
    """Lazy DataFrames over one table folder; nothing is read until an action runs."""

    def __init__(self, spark: SparkSession, folder: str):
        ship_package(spark)
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def obs(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("obs_id"),
            F.col("c_nationkey").alias("sample_id"),
            F.col("c_mktsegment").alias("cluster"),
            (F.col("c_nationkey") % 4).alias("batch"),
        )

    @cached_property
    def var(self) -> DataFrame:
        return self.table("part").select(F.col("p_brand").alias("var_id"), F.expr(SYMBOL_SQL).alias("symbol")).distinct()

    @property
    def lines(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority"
        )
        return lines.join(orders, "l_orderkey")

    @cached_property
    def expr(self) -> DataFrame:
        """customer x brand."""
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        return (
            self.lines
            .join(parts, "l_partkey")
            .groupBy(F.col("o_custkey").alias("obs_id"), F.col("p_brand").alias("var_id"))
            .agg(F.sum("l_quantity").alias("value"))
        )

    @cached_property
    def expr_part(self) -> DataFrame:
        """customer x part."""
        return self.lines.groupBy(F.col("o_custkey").alias("obs_id"), F.col("l_partkey").alias("var_id")).agg(
            F.sum("l_quantity").alias("value")
        )

    @cached_property
    def expr_condition(self) -> DataFrame:
        """customer x condition x brand (condition = order priority)."""
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        return (
            self.lines
            .join(parts, "l_partkey")
            .groupBy(
                F.col("o_custkey").alias("obs_id"),
                F.col("o_orderpriority").alias("condition"),
                F.col("p_brand").alias("var_id"),
            )
            .agg(F.sum("l_quantity").alias("value"))
        )

    @cached_property
    def gene_coordinates(self) -> DataFrame:
        """Raw genomic intervals for single parts."""
        return self.table("part").select(
            F.col("p_partkey").alias("hgnc_symbol"),
            F.when(F.col("p_size") % 24 == 22, F.lit("X"))
            .when(F.col("p_size") % 24 == 23, F.lit("MT"))
            .otherwise((F.col("p_size") % 24 + 1).cast("string"))
            .alias("chromosome_name"),
            F.col("p_partkey").alias("start_position"),
            (F.col("p_partkey") + 100).alias("end_position"),
            F.when(F.col("p_type") == "ECONOMY", F.lit("pseudogene"))
            .when(F.col("p_type") == "PROMO", F.lit("lncRNA"))
            .otherwise(F.lit("protein_coding"))
            .alias("gene_biotype"),
            F.when(F.col("p_partkey") % 2 == 0, F.lit("p")).otherwise(F.lit("q")).alias("chr_arm"),
        )

    @cached_property
    def pseudobulk_pairs(self) -> DataFrame:
        """nation x condition x brand counts, the pseudobulk table of the DE queries."""
        nat = self.table("customer").select(F.col("c_custkey").alias("obs_id"), F.col("c_nationkey").alias("sample_id"))
        return (
            self.expr_condition.join(nat, "obs_id")
            .groupBy("sample_id", "condition", "var_id")
            .agg(F.sum("value").alias("value"))
        )

    @cached_property
    def composition(self) -> DataFrame:
        """One row per cell with its sample and cell type (nation, segment)."""
        return self.table("customer").select(
            F.col("c_custkey").alias("obs_id"), F.col("c_nationkey").alias("sample_id"), F.col("c_mktsegment").alias("cell_type")
        )

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("obs_id"), F.col("embedding").cast("array<double>").alias("v"), "label"
        )


OBS = (
    "obs AS (SELECT c_custkey AS obs_id, c_nationkey AS sample_id, c_mktsegment AS cluster, "
    "c_nationkey % 4 AS batch FROM customer)"
)
VAR = f"var AS (SELECT DISTINCT p_brand AS var_id, {SYMBOL_SQL} AS symbol FROM part)"
EXPR = (
    "expr AS (SELECT o_custkey AS obs_id, p_brand AS var_id, sum(l_quantity) AS value FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"
)
EXPR_PART = (
    "expr_part AS (SELECT o_custkey AS obs_id, l_partkey AS var_id, sum(l_quantity) AS value FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"
)
EXPR_COND = (
    "expr_cond AS (SELECT o_custkey AS obs_id, o_orderpriority AS condition, p_brand AS var_id, "
    "sum(l_quantity) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"
)
PAIRS = (
    "pairs AS (SELECT c_nationkey AS sample_id, condition, var_id, sum(value) AS value "
    "FROM expr_cond JOIN customer ON c_custkey = obs_id GROUP BY 1, 2, 3)"
)
COMP = "comp AS (SELECT c_custkey AS obs_id, c_nationkey AS sample_id, c_mktsegment AS cell_type FROM customer)"
COORDS = (
    "coords AS (SELECT p_partkey AS hgnc_symbol, CASE WHEN p_size % 24 = 22 THEN 'X' WHEN p_size % 24 = 23 THEN 'MT' "
    "ELSE CAST(p_size % 24 + 1 AS VARCHAR) END AS chromosome_name, p_partkey AS start_position, "
    "p_partkey + 100 AS end_position, CASE WHEN p_type = 'ECONOMY' THEN 'pseudogene' WHEN p_type = 'PROMO' "
    "THEN 'lncRNA' ELSE 'protein_coding' END AS gene_biotype, CASE WHEN p_partkey % 2 = 0 THEN 'p' ELSE 'q' END "
    "AS chr_arm FROM part)"
)


def with_ctes(*parts: str) -> str:
    """Join CTE fragments; the last part is the final SELECT."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]
