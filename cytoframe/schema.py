"""Column contracts shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DECISION = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("cluster_id", T.StringType()),
        T.StructField("cluster_key", T.StringType()),
        T.StructField("parent_label", T.StringType()),
        T.StructField("canonical_label", T.StringType()),
        T.StructField("cell_state", T.StringType()),
        T.StructField("functional_modifier", T.StringType()),
        T.StructField("final_label", T.StringType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("evidence_refs", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        T.StructField("positive_markers", T.ArrayType(T.StringType())),
        T.StructField("negative_markers_absent", T.ArrayType(T.StringType())),
        T.StructField("conflicts", T.ArrayType(T.StringType())),
        T.StructField("review_required", T.BooleanType()),
        T.StructField("reason", T.StringType()),
    ]
)


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "table") -> DataFrame:
    """Fail while the plan is being built, not half-way through a job."""
    missing = [name for name in needed if name not in df.columns]
    if missing:
        raise KeyError(f"{what} is missing columns: {', '.join(sorted(missing))}")
    return df


def keep_listed(df: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """Keep the allow-listed columns that exist, in allow-list order."""
    return df.select([name for name in allowed if name in df.columns])


def flatten_keep(section) -> list[str]:
    """Flatten a nested keep-list (dict of lists / list / scalar) into names."""
    if section is None:
        return []
    if isinstance(section, dict):
        return [name for part in section.values() for name in flatten_keep(part)]
    if isinstance(section, (list, tuple)):
        return [name for part in section for name in flatten_keep(part)]
    return [str(section)]
