"""Alignment, set and naming operators on keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.functions.ordered import place_rank
from cytoframe.operators.cnv import first_per_key


def make_unique(df: DataFrame, name: str, position: str) -> DataFrame:
    """Repeated names get -1, -2, ... in position order (``unique_name``)."""
    ranked = place_rank(df, [name], position, position, "_rn")
    suffix = F.concat(F.col(name), F.lit("-"), (F.col("_rn") - 1).cast("string"))
    return ranked.withColumn("unique_name", F.when(F.col("_rn") == 1, F.col(name)).otherwise(suffix)).drop("_rn")


def align_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keep every left row; unmatched right columns are NULL."""
    return left.join(right, key, "left")


def shared_in_order(first: DataFrame, second: DataFrame, key: str, position: str) -> DataFrame:
    """Keys of ``first`` that occur in ``second``, at their first position."""
    return first_per_key(first.select(key, position), key, position).join(second.select(key).distinct(), key, "left_semi")


def ordered_union(first: DataFrame, second: DataFrame, key: str, position: str) -> DataFrame:
    """Union of keys; a key keeps the place of its first appearance (first list before second)."""
    tagged = first.select(key, F.lit(0).alias("side"), F.col(position).alias("pos")).unionByName(
        second.select(key, F.lit(1).alias("side"), F.col(position).alias("pos"))
    )
    return tagged.groupBy(key).agg(F.min(F.struct("side", "pos")).alias("_p")).select(key, "_p.side", "_p.pos")


def concat_shared_genes(expr: DataFrame, sample_of: DataFrame) -> DataFrame:
    """Cells of all samples over the genes present in every sample, with 'sample:cell' names."""
    tagged = expr.join(sample_of.select("obs_id", "sample_id"), "obs_id")
    present = tagged.groupBy("var_id", "sample_id").agg(F.lit(1).alias("_o")).groupBy("var_id").agg(F.count(F.lit(1)).alias("k"))
    n = sample_of.select("sample_id").distinct().agg(F.count(F.lit(1))).scalar()
    shared = present.where(F.col("k") == n).select("var_id")
    name = F.concat_ws(":", F.col("sample_id").cast("string"), F.col("obs_id").cast("string"))
    return tagged.join(shared, "var_id", "left_semi").select(name.alias("obs_id"), "sample_id", "var_id", "value")


def concat_samples(parts: dict[str, DataFrame]) -> DataFrame:
    """Per-sample result tables stacked with their sample_id."""
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn("sample_id", F.lit(s)) for s, df in parts.items()])


def pending_tasks(tasks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Tasks without a finished output, largest k first."""
    return tasks.join(done.select(*keys).distinct(), keys, "left_anti").orderBy(F.col("k").desc(), "iteration")


def fit_tasks(tasks: DataFrame, seed: int) -> DataFrame:
    """Deterministic seed per (k, iteration)."""
    return tasks.withColumn("seed", F.lit(int(seed)) + F.col("k") * 1000003 + F.col("iteration"))


def balanced_sample(cells: DataFrame, per_sample: int, seed: int = 0) -> DataFrame:
    """A seeded draw of ``per_sample`` cells from every sample that has enough of them."""
    from pyspark.sql import Window

    enough = cells.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= per_sample).select("sample_id")
    order = Window.partitionBy("sample_id").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("obs_id").cast("string"))), "obs_id")
    ranked = cells.join(enough, "sample_id", "left_semi").withColumn("_r", F.row_number().over(order))
    return ranked.where(F.col("_r") <= per_sample).drop("_r")
