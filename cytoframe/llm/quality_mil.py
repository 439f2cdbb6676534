"""Quality classification by attention over the passages of a document.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded: shares of
character classes, word lengths, repetition within the passage and within the document, and
a signed hash projection of its words.  Document labels alone train a gated attention model:
passage weights are the softmax of w . (tanh(V h) * sigmoid(U h)), the weighted sum of the
encoded passages passes one hidden layer, and its logistic output is the score.

The model is fitted on a sample of about ``per_label`` labelled documents of each label (all
passages of each); scoring encodes every passage of every whole text, batch by batch, in one pass without a shuffle.

Defined cases: a null or empty text is one passage of zeros and gets a score like any other;
documents without a label, and labels that are null, don't train; with fewer than two labels
to learn from every score is the share of label 1 (one half if there is none); repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import fold, table
from cytoframe.llm.tokens import Words, mix, shingles, slices

U = np.uint64
PASSAGE = 64
HASHED = 16
HIDDEN = 16

#: Byte classes counted per passage.
CLASSES = {
    "upper": [range(65, 91)], "lower": [range(97, 123)], "digit": [range(48, 58)], "stop": [b",.;:!?"], "loud": [b"!?"],
    "symbol": [b"#*$%&|<>{}[]()@/\\=+~^_"], "bar": [b"|"], "line": [b"\n"], "wide": [range(128, 256)],
}
_TABLES = np.zeros((len(CLASSES), 256), np.int32)
for _row, _parts in enumerate(CLASSES.values()):
    for _part in _parts:
        _TABLES[_row, list(_part)] = 1
WIDTH = len(CLASSES) + 6 + HASHED


def encode(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Encoded passages of a slice (rows x WIDTH) and bounds per text."""
    counts = np.diff(words.bounds)
    n = np.maximum(1, -(-counts // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros((bounds[-1], WIDTH), np.float32)
    full = np.repeat(counts > 0, n)
    if not full.any():
        return out, bounds
    first = np.repeat(words.bounds[:-1] - PASSAGE * bounds[:-1], n) + PASSAGE * np.arange(bounds[-1])
    owner = np.repeat(np.arange(words.n_texts), n)
    last = np.minimum(first + PASSAGE, words.bounds[1:][owner])
    first, last, owner = first[full], last[full], owner[full]
    size = (last - first).astype(np.float64)
    a, b = words.starts[first], words.ends[last - 1]
    span = np.maximum(b - a, 1).astype(np.float64)
    columns = []
    for row in range(len(CLASSES)):
        sums = np.concatenate([[0], np.cumsum(_TABLES[row][words.raw])])
        columns.append(np.sqrt((sums[b] - sums[a]) / span))
    length = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    columns.append(np.log1p((length[last] - length[first]) / size))
    part = np.repeat(np.arange(len(first)), last - first)
    at = np.arange(len(part)) - np.repeat(np.concatenate([[0], np.cumsum(last - first)])[:-1], last - first) + np.repeat(first, last - first)
    h = words.hashes[at]
    pair = mix(h ^ mix(part.astype(U)))
    columns.append(1 - np.bincount(part[np.unique(pair, return_index=True)[1]], minlength=len(first)) / size)
    # three-word windows seen before in the same document
    windows, wb = shingles(words, 3)
    text_of = np.repeat(np.arange(words.n_texts), np.diff(wb))
    seen = np.ones(len(windows))
    seen[np.unique(mix(windows ^ mix(text_of.astype(U))), return_index=True)[1]] = 0
    again = np.concatenate([[0], np.cumsum(seen)])
    lo = np.minimum(wb[:-1][owner] + first - words.bounds[:-1][owner], wb[1:][owner])
    hi = np.minimum(lo + (last - first), wb[1:][owner])
    columns.append((again[hi] - again[lo]) / size)
    columns.append(np.log(size) / np.log(PASSAGE))
    columns.append(np.log1p(counts[owner]) / 10)
    columns.append(np.full(len(first), 1.0))
    signs = np.stack([np.where((h >> U(j)) & U(1), 1.0, -1.0) for j in range(HASHED)])
    sums = np.concatenate([np.zeros((HASHED, 1)), np.cumsum(signs, axis=1)], axis=1)
    edge = np.concatenate([[0], np.cumsum(last - first)])
    hashed = (sums[:, edge[1:]] - sums[:, edge[:-1]]) / np.sqrt(size)
    out[full] = np.concatenate([np.stack(columns), 0.1 * hashed]).T
    return out, bounds


class Model:
    """Gated attention over passages; plain numpy, trained by Adam on whole bags."""

    def __init__(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int, seed: int):
        self.share = float(labels.mean()) if len(labels) else 0.5
        self.fitted = 0 < labels.sum() < len(labels)
        if not self.fitted:
            return
        rng = np.random.default_rng(seed)
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(axis=0), every.std(axis=0) + 1e-3
        shape = {"V": (WIDTH, HIDDEN), "Ug": (WIDTH, HIDDEN), "w": (HIDDEN,), "A": (WIDTH, HIDDEN), "a": (HIDDEN,), "c": (HIDDEN,), "d": (1,)}
        self.p = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in ("a", "d") else np.zeros(s)) for k, s in shape.items()}
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(bags), 128):
                chosen = order[at : at + 128]
                bounds = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])])
                grad = self._gradient(np.concatenate([bags[i] for i in chosen]), bounds, labels[chosen], weight[chosen])
                t += 1
                for k, g in grad.items():
                    g = g + 1e-4 * self.p[k]
                    m = moment[k]
                    m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.999 * m[1] + 0.001 * g * g
                    self.p[k] -= 0.01 * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.999**t)) + 1e-8)

    def _forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h = np.clip((x - self.mean) / self.scale, -8, 8)
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-h @ p["Ug"]))
        e = (t * g) @ p["w"]
        top = np.maximum.reduceat(e, bounds[:-1])
        e = np.exp(e - np.repeat(top, np.diff(bounds)))
        att = e / np.repeat(np.add.reduceat(e, bounds[:-1]), np.diff(bounds))
        z = np.add.reduceat(att[:, None] * h, bounds[:-1])
        r = np.tanh(z @ p["A"] + p["a"])
        return {"h": h, "t": t, "g": g, "att": att, "z": z, "r": r, "s": 1 / (1 + np.exp(-np.clip(r @ p["c"] + p["d"], -30, 30)))}

    def _gradient(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self._forward(x, bounds)
        out = (f["s"] - y) * weight / len(y)
        back = np.outer(out, p["c"]) * (1 - f["r"] ** 2)
        dz = back @ p["A"].T
        n = np.diff(bounds)
        dot = (np.repeat(dz, n, axis=0) * f["h"]).sum(axis=1)
        mean = np.add.reduceat(f["att"] * dot, bounds[:-1])
        de = f["att"] * (dot - np.repeat(mean, n))
        dt = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        return {
            "V": f["h"].T @ dt, "Ug": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de,
            "A": f["z"].T @ back, "a": back.sum(axis=0), "c": f["r"].T @ out, "d": np.array([out.sum()]),
        }

    def score(self, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores per text and attention per passage."""
        if not self.fitted:
            n = np.diff(bounds)
            return np.full(len(n), self.share), np.repeat(1 / n, n)
        f = self._forward(x, bounds)
        return f["s"], f["att"]


def _encode_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in slices(batch["text"], lower=False):
            x, bounds = encode(words)
            part = batch.slice(words.first, words.n_texts)
            bags = [x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part["_order"], part["_label"], pa.array(bags, pa.binary())], ["_order", "_label", "bag"])


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1500, epochs: int = 30, seed: int = 5) -> Model:
    """Fit on documents (doc_id, text) with labels (doc_id, label 0 or 1)."""
    known = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("label").cast("int").alias("_label")).distinct()
    sizes = known.groupBy("_label").agg(F.count(F.lit(1)).alias("_n")).collect()  # two rows
    order = F.xxhash64("doc_id", F.lit(seed))
    limit = F.create_map(*[F.lit(x) for r in sizes for x in (r["_label"], min(1.0, 1.3 * per_label / r["_n"]))]) if sizes else None
    if limit is None:
        return Model([], np.zeros(0), epochs, seed)
    chance = F.pmod(order, F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(chance < limit[F.col("_label")]).select("doc_id", "_label", order.alias("_order"))
    sample = docs.sparkSession.createDataFrame(sample.collect(), sample.schema)  # about 2.6 * per_label rows
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "_order", "_label").mapInArrow(_encode_bags, "_order long, _label int, bag binary")
    found = rows.toPandas().sort_values(["_order", "_label", "bag"]).groupby("_label").head(per_label)
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH).astype(np.float64) for b in found["bag"]]
    return Model(bags, found["_label"].to_numpy(float), epochs, seed)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, attention, n_passages): ``attention`` is the largest weight of a passage."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            parts = []
            for words in slices(batch["text"], lower=False):
                x, bounds = encode(words)
                s, att = model.score(x.astype(np.float64), bounds)
                parts.append(pd.DataFrame({"s": s, "att": np.maximum.reduceat(att, bounds[:-1]), "n": np.diff(bounds)}))
            if parts:
                told = pd.concat(parts)
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], *[pa.array(told[c].to_numpy()) for c in ("s", "att", "n")]], ["doc_id", "held_out", "score", "attention", "n_passages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, score double, attention double, n_passages long")


@query("op1_attention_bags")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", fold("doc_id", 3, 1).alias("held_out"))
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label")).where(~fold("doc_id", 3, 1))
    scored = score(docs, train(docs.where("NOT held_out"), labels))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "attention", "n_passages")
