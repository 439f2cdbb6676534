"""Attention model over sample compositions, fitted by full-batch gradient passes.

One-hot cell instances of a sample only enter through their counts, so a bag is the
sample's count vector and attention becomes a count-weighted softmax over cell types.
Samples stay distributed: an epoch is one pass that adds up gradients, and only the
parameters (cell types x hidden units) live on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.functions.ordered import running_sums
from cytoframe.functions.partials import matrix_sums
from cytoframe.session import cut


@dataclass(frozen=True)
class MilConfig:
    hidden: int = 64
    learning_rate: float = 1e-3
    weight_decay: float = 1e-4
    epochs: int = 500
    seed: int = 0


def _start(n_types: int, n_out: int, n_cov: int, cfg: MilConfig) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(cfg.seed)
    h, head = cfg.hidden, cfg.hidden + n_cov
    mid = max(1, head // 2)
    draw = lambda a, b: rng.uniform(-1, 1, (a, b)) / np.sqrt(a)
    return {
        "e1": draw(n_types, h), "c1": np.zeros((1, h)), "e2": draw(h, h), "c2": np.zeros((1, h)), "av": draw(h, h), "au": draw(h, h), "aw": draw(h, 1),
        "h1": draw(head, mid), "d1": np.zeros((1, mid)), "h2": draw(mid, n_out), "d2": np.zeros((1, n_out)), "ih": draw(h, n_out), "ib": np.zeros((1, n_out)),
    }


def _forward(p: dict, counts: np.ndarray, cov: np.ndarray) -> dict:
    """Every cell type is encoded once; a sample pools the encodings by its counts."""
    z1 = p["e1"] + p["c1"]
    a1 = np.maximum(z1, 0)
    z2 = a1 @ p["e2"] + p["c2"]
    enc = np.maximum(z2, 0)
    tv, su = np.tanh(enc @ p["av"]), 1 / (1 + np.exp(-(enc @ p["au"])))
    score = (tv * su @ p["aw"])[:, 0]
    raw = counts * np.exp(score - score.max())[None, :]
    att = raw / raw.sum(axis=1, keepdims=True)
    x = np.hstack([att @ enc, cov])
    z3 = x @ p["h1"] + p["d1"]
    a3 = np.maximum(z3, 0)
    return dict(z1=z1, a1=a1, z2=z2, enc=enc, tv=tv, su=su, att=att, x=x, z3=z3, a3=a3, out=a3 @ p["h2"] + p["d2"])


def _backward(p: dict, f: dict, d_out: np.ndarray) -> dict[str, np.ndarray]:
    g = {"h2": f["a3"].T @ d_out, "d2": d_out.sum(0, keepdims=True)}
    d3 = d_out @ p["h2"].T * (f["z3"] > 0)
    g["h1"], g["d1"] = f["x"].T @ d3, d3.sum(0, keepdims=True)
    pooled = (d3 @ p["h1"].T)[:, : f["enc"].shape[1]]
    per_type = pooled @ f["enc"].T
    d_score = (f["att"] * (per_type - (f["att"] * per_type).sum(axis=1, keepdims=True))).sum(axis=0)[:, None]
    d_enc = f["att"].T @ pooled
    gate = d_score @ p["aw"].T
    g["aw"] = (f["tv"] * f["su"]).T @ d_score
    dv, du = gate * f["su"] * (1 - f["tv"] ** 2), gate * f["tv"] * f["su"] * (1 - f["su"])
    g["av"], g["au"] = f["enc"].T @ dv, f["enc"].T @ du
    d_enc = d_enc + dv @ p["av"].T + du @ p["au"].T
    d2 = d_enc * (f["z2"] > 0)
    g["e2"], g["c2"] = f["a1"].T @ d2, d2.sum(0, keepdims=True)
    d1 = d2 @ p["e2"].T * (f["z1"] > 0)
    g["e1"], g["c1"] = d1, d1.sum(0, keepdims=True)
    return g


def _loss_gradient(mode: str, out: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss and its derivative in the outputs (mean is taken by the caller)."""
    if mode == "binary":
        z = out[:, 0]
        return float((np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))).sum()), (1 / (1 + np.exp(-z)) - y)[:, None]
    if mode == "multiclass":
        e = np.exp(out - out.max(axis=1, keepdims=True))
        prob = e / e.sum(axis=1, keepdims=True)
        hot = np.eye(out.shape[1])[y.astype(int)]
        return float(-np.log(np.maximum((prob * hot).sum(axis=1), 1e-300)).sum()), prob - hot
    if mode == "continuous":
        gap = out[:, 0] - y
        return float((gap**2).sum()), (2 * gap)[:, None]
    raise ValueError(f"unknown mode: {mode}")


def _stack(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(float)


def predict(samples: DataFrame, params: dict, n_out: int) -> DataFrame:
    """(sample_id, logits) for count vectors."""
    kind = dict(samples.dtypes)["sample_id"]

    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf[["sample_id"]].assign(logits=list(_forward(params, _stack(pdf["counts"]), _stack(pdf["cov"]))["out"]))

    return samples.mapInPandas(run, f"sample_id {kind}, logits array<double>")


def _cox_derivatives(samples: DataFrame, params: dict) -> DataFrame:
    """Adds ``g``: derivative of the mean partial likelihood loss in each sample's risk.

    Two ordered running sums (risk sets by falling time, and event terms by rising time)
    replace the pairwise form, so no task sees all samples.
    """
    risk = samples.join(predict(samples, params, 1).select("sample_id", F.element_at("logits", 1).alias("risk")), "sample_id")
    risk = cut(risk.withColumns({"_late": -F.col("time"), "_order": F.xxhash64("sample_id").cast("double")}))
    top = risk.agg(F.max("risk")).head()[0]
    sets = running_sums(risk.withColumn("_w", F.exp(F.col("risk") - F.lit(top))), [], "_late", {"_s": F.col("_w")}, tiebreak="_order")
    sets = cut(sets.withColumn("_term", F.when(F.col("event") > 0, 1 / F.greatest("_s", F.lit(1e-300))).otherwise(F.lit(0.0))))
    back = running_sums(sets.withColumn("_back", -F.col("_order")), [], "time", {"_later": F.col("_term")}, tiebreak="_back")
    n_events = risk.agg(F.count_if(F.col("event") > 0)).head()[0]
    slope = (F.col("_w") * F.col("_later") - (F.col("event") > 0).cast("double")) / float(n_events)
    loss = F.when(F.col("event") > 0, F.ln("_s") + F.lit(top) - F.col("risk")).otherwise(F.lit(0.0)) / float(n_events)
    return cut(back.select("sample_id", "counts", "cov", slope.alias("g"), loss.alias("loss")))


def fit_mil(samples: DataFrame, mode: str, n_types: int, n_out: int = 1, n_cov: int = 0, cfg: MilConfig = MilConfig()) -> tuple[dict, list[tuple[int, float]]]:
    """Parameters and loss history (every 25 epochs).

    ``samples``: sample_id, counts array<double>, cov array<double> and ``y``, or ``time``
    and ``event`` for mode 'survival'.  AdamW with gradient norm clipped at 1.
    """
    samples = cut(samples)
    n = samples.count()
    p = _start(n_types, n_out, n_cov, cfg)
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    history = []
    for epoch in range(cfg.epochs):
        now = dict(p)
        data = _cox_derivatives(samples, now) if mode == "survival" else samples

        def part(pdf, now=now):
            f = _forward(now, _stack(pdf["counts"]), _stack(pdf["cov"]))
            if mode == "survival":
                loss, d = float(pdf["loss"].sum()), pdf["g"].to_numpy(float)[:, None]
            else:
                loss, d = _loss_gradient(mode, f["out"], pdf["y"].to_numpy(float))
                loss, d = loss / n, d / n
            return {**_backward(now, f, d), "loss": np.array([[loss]])}

        g = matrix_sums(data, part)
        loss = float(g.pop("loss")[0, 0])
        scale = min(1.0, 1.0 / (np.sqrt(sum(float((v**2).sum()) for v in g.values())) + 1e-6))
        for k, v in g.items():
            v = v * scale
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.999 * second[k] + 0.001 * v**2
            step = (first[k] / (1 - 0.9 ** (epoch + 1))) / (np.sqrt(second[k] / (1 - 0.999 ** (epoch + 1))) + 1e-8)
            p[k] = p[k] * (1 - cfg.learning_rate * cfg.weight_decay) - cfg.learning_rate * step
        if epoch % 25 == 0 or epoch == cfg.epochs - 1:
            history.append((epoch, loss))
    return p, history


def type_scores(params: dict) -> np.ndarray:
    """Instance-head score per cell type.  The head is not part of the loss, so these are not identified."""
    enc = np.maximum(np.maximum(params["e1"] + params["c1"], 0) @ params["e2"] + params["c2"], 0)
    return enc @ params["ih"] + params["ib"]


def sample_vectors(bags: DataFrame, types: list[str], covariates: DataFrame | None = None) -> DataFrame:
    """(sample_id, counts, cov) from long instance counts; columns in ``types`` order."""
    value = [F.coalesce(F.sum(F.when(F.col("cell_type") == t, F.col("instances"))), F.lit(0)).cast("double") for t in types]
    out = bags.groupBy("sample_id").agg(F.array(*value).alias("counts"))
    if covariates is None:
        return out.withColumn("cov", F.array().cast("array<double>"))
    names = [c for c in covariates.columns if c != "sample_id"]
    return out.join(covariates.select("sample_id", F.array(*[F.col(c).cast("double") for c in names]).alias("cov")), "sample_id")
