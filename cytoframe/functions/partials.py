"""Sums of small matrices over distributed rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "name string, shape array<int>, r bigint, lane int, vals array<double>"

SMALL = 100_000


@dataclass
class Rows:
    """Some rows of a tall matrix: only rows that occur are added and sent; ``matrix_sums`` returns all that occurred, by number."""

    ids: np.ndarray
    values: np.ndarray

    @classmethod
    def by(cls, code: np.ndarray, values: np.ndarray) -> Rows:
        """Sums of ``values`` over equal codes."""
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, int)
        return cls(code[first], np.add.reduceat(values[order], first, axis=0) if len(code) else values[:0])

    def dense(self, n: int) -> np.ndarray:
        out = np.zeros((n, self.values.shape[1]))
        out[self.ids] = self.values
        return out


def matrix_sums(df: DataFrame, part: Callable[[pd.DataFrame], dict[str, np.ndarray | Rows]], most: int | None = None) -> dict[str, np.ndarray | Rows]:
    """Add up the arrays ``part`` returns for every Arrow batch of ``df``, or for every ``most`` rows of one.

    Each task folds its batches into one set of arrays and emits them row by row; rows
    are then added per (name, row) - on wide inputs per (name, row, lane) first - so neither a
    task nor the driver holds more than a bounded stack of matrix rows.  Only the final
    sums return.
    """

    def fold(batches):
        total: dict[str, np.ndarray] = {}
        for pdf in (whole.iloc[at : at + (most or len(whole))] for whole in batches for at in range(0, len(whole), most or len(whole) or 1)):
            for name, value in part(pdf).items():
                if isinstance(value, Rows):
                    held = total.get(name)
                    total[name] = value if held is None else Rows.by(np.concatenate([held.ids, value.ids]), np.concatenate([held.values, value.values]))
                    continue
                value = np.asarray(value, dtype=float)
                total[name] = total[name] + value if name in total else value
        lane = TaskContext.get().partitionId() % 32
        for name, value in total.items():
            if isinstance(value, Rows):
                for at in range(0, len(value.ids), 2048):
                    ids, some = value.ids[at : at + 2048], value.values[at : at + 2048]
                    yield pd.DataFrame({"name": name, "shape": [[-1]] * len(ids), "r": ids.astype("int64"), "lane": lane, "vals": list(some)})
                continue
            flat = value.reshape(1, -1) if value.size <= SMALL else value.reshape(-1, value.shape[-1])
            yield pd.DataFrame(
                {"name": name, "shape": [list(value.shape)] * len(flat), "r": np.arange(len(flat), dtype="int64"), "lane": lane, "vals": list(flat)}
            )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[:1].copy()
        first["vals"] = [np.sum(np.vstack(pdf["vals"].to_numpy()), axis=0)]
        return first

    parts = df.mapInPandas(fold, SCHEMA)
    if df.rdd.getNumPartitions() > 64:
        parts = parts.groupBy("name", "r", "lane").applyInPandas(add, SCHEMA)
    summed = parts.groupBy("name", "r").applyInPandas(add, SCHEMA)
    rows = summed.select("name", "shape", "r", "vals").toPandas()
    out = {}
    for name, group in rows.groupby("name"):
        group = group.sort_values("r")
        shape = tuple(int(s) for s in group["shape"].iloc[0])
        if shape == (-1,):
            out[name] = Rows(group["r"].to_numpy(), np.vstack(group["vals"].to_numpy()))
            continue
        out[name] = np.vstack(group["vals"].to_numpy()).reshape(shape)
    return out
