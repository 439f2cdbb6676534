"""Hard negatives by segment summaries: bounds of inner products from segment means and deviations.

Index.  Every vector is stored with the mean and the standard deviation of its segments, at each
level of a hierarchy (``LEVELS`` segments: a few long ones, then shorter ones).  For a segment of length L

    L * (mean_a * mean_b - dev_a * dev_b)  <=  <a, b>  <=  L * (mean_a * mean_b + dev_a * dev_b)

so that sums over segments bound the score of a pair.  A pair whose upper bound is below what its
anchor still needs, or whose lower bound is above the anchor's best positive, is settled; the
others go on to the next level, and what passes the last is scored exactly in integers.

Search.  Anchors are taken ``per_pass`` at a time: a pass of bounded size is sent to all tasks, which read
the stored vectors in place and return, for each anchor, the best rows of their part.  A first look at
a hashed sample of about ``sample_rows`` rows gives every anchor a score that it reaches for certain;
this only tightens the bounds, every row is looked at afterwards.  One scan finds the positives, a second
one the negatives of all (anchor, positive) windows.  Each pass is written before the next begins.

Vectors are integers; components beyond +-sqrt(2**62 / length) are cut there, so that a score fits 64 bits.

Defined cases: rows with a null id, label, vector or component take no part; shorter vectors count as padded with zeros; repeated rows are
rows of their own (a row's copies are its other rows; copies of an anchor each return the same); ties go by id; an empty
table, or one without anchors, gives an empty result; other columns are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import table
from cytoframe.session import cut, ensure_checkpoint_dir

LEVELS = (4, 16)
ROWS, ANCHORS = 2048, 512
DENSE = 0.2
NO = np.iinfo(np.int64).min
INDEX = "place long, vec_id long, label int, anchor boolean, v array<int>, mean array<float>, dev array<float>"
FOUND = "place long, anchor_id long, copies long, slot int, positive_id long, positive_score long, id long, score long"


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of every level, levels side by side."""
    means, devs = [], []
    for n in LEVELS:
        parts = v.reshape(len(v), n, -1).astype(np.float64)
        means.append(parts.mean(axis=2))
        devs.append(parts.std(axis=2))
    return np.concatenate(means, axis=1).astype(np.float32), np.concatenate(devs, axis=1).astype(np.float32)


def _lists(column: pa.Array, n: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), n) if len(column) else np.zeros((0, n), kind)


def build_index(vectors: DataFrame, anchor: Column) -> tuple[DataFrame, int]:
    """The stored index of ``vectors`` (vec_id, label, v: integers) and its padded vector length."""
    rows = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(~F.exists("v", lambda x: x.isNull()))
    longest = rows.agg(F.max(F.size("v")).alias("n")).first().n or 1
    size = -(-longest // LEVELS[-1]) * LEVELS[-1]
    most = int(((1 << 62) / size) ** 0.5)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch["v"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            v = np.zeros((batch.num_rows, size), np.int64)
            at = np.repeat(np.cumsum(counts) - counts, counts)
            v[np.repeat(np.arange(len(counts)), counts), np.arange(len(at)) - at] = np.clip(batch["v"].flatten().to_numpy(zero_copy_only=False), -most, most)
            mean, dev = summaries(v)
            listed = lambda x, kind: pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel(), kind))
            columns = [batch["place"], batch["vec_id"], batch["label"], batch["anchor"], listed(v, pa.int32()), listed(mean, pa.float32()), listed(dev, pa.float32())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "vec_id", "label", "anchor", "v", "mean", "dev"])

    most = min(most, np.iinfo(np.int32).max)
    rows = rows.select(F.monotonically_increasing_id().alias("place"), F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col("v").cast("array<bigint>").alias("v"))
    return cut(rows.mapInArrow(make, INDEX)), size


@dataclass
class Side:
    """Anchors or stored rows as arrays."""

    place: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    dev: np.ndarray
    norm: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.norm = np.sqrt((self.v.astype(np.float64) ** 2).sum(axis=1))

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, size: int) -> Side:
        column = lambda name: batch[name].combine_chunks() if isinstance(batch[name], pa.ChunkedArray) else batch[name]
        scalar = [column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "vec_id", "label")]
        n = sum(LEVELS)
        return cls(*scalar, _lists(column("v"), size, np.int32), _lists(column("mean"), n, np.float64), _lists(column("dev"), n, np.float64))

    def part(self, rows: slice) -> Side:
        return Side(self.place[rows], self.ids[rows], self.label[rows], self.v[rows], self.mean[rows], self.dev[rows])


def _products(a: np.ndarray, b: np.ndarray, ai: np.ndarray, bi: np.ndarray) -> np.ndarray:
    """a[ai] . b[bi] for chosen pairs: by one product of matrices where many are chosen."""
    if len(ai) > DENSE * len(a) * len(b):
        return (a @ b.T)[ai, bi]
    out = np.empty(len(ai), np.result_type(a, b))
    for s in range(0, len(ai), 1 << 16):
        out[s : s + (1 << 16)] = np.einsum("ij,ij->i", a[ai[s : s + (1 << 16)]], b[bi[s : s + (1 << 16)]])
    return out


def scored_pairs(a: Side, b: Side, may: np.ndarray, low: np.ndarray, high: np.ndarray | None = None, counts: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact scores of the pairs in ``may`` (anchors x rows) that can reach their anchor's ``low`` without all passing ``high``.

    ``counts``, if given, gets the number of pairs alive before and after every level.
    """
    ai, bi = np.nonzero(may)
    base, size = 0, a.v.shape[1]
    for n in LEVELS:
        if counts is not None:
            counts.append(len(ai))
        cols = slice(base, base + n)
        middle = _products(a.mean[:, cols], b.mean[:, cols], ai, bi) * (size // n)
        reach = _products(a.dev[:, cols], b.dev[:, cols], ai, bi) * (size // n) + 1e-6 * a.norm[ai] * b.norm[bi]  # summaries are rounded
        alive = middle + reach >= low[ai]
        if high is not None:
            alive &= middle - reach <= high[ai]
        ai, bi = ai[alive], bi[alive]
        base += n
    if counts is not None:
        counts.append(len(ai))
    if not len(ai):
        return ai, bi, np.zeros(0, np.int64)
    exact = float(np.abs(a.v).max(initial=0)) * float(np.abs(b.v).max(initial=0)) * size < 2**53
    kind = np.float64 if exact else np.int64
    return ai, bi, _products(a.v.astype(kind), b.v.astype(kind), ai, bi).astype(np.int64)


class Best:
    """The first ``k`` rows of every slot by (score descending, id)."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.low = np.full(slots, NO)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        kept = order[rank < self.k]
        full = np.flatnonzero(rank == self.k - 1)
        self.low[slot[full]] = score[order[full]]
        self.slot, self.score, self.id = slot[rank < self.k], score[kept], ids[kept]


@dataclass
class Task:
    """What a pass sends: anchors with their copies, a least score per slot, and for negatives the positives of each window."""

    anchors: Side
    copies: np.ndarray
    k: int
    low: np.ndarray  # one least score for each slot
    positive: np.ndarray | None = None  # (anchors, windows): scores, NO where there is none
    positive_id: np.ndarray | None = None
    percent: int = 80


def _windows(scores: np.ndarray, percent: int) -> np.ndarray:
    """The least score of each window: percent of the positive's, rounded up; a negative positive has no negatives."""
    whole, rest = np.divmod(np.maximum(scores, 0), 100)  # percent * scores need not fit
    return np.where(scores >= 0, percent * whole - (-percent * rest) // 100, np.iinfo(np.int64).max)


def _search(task: Task, rows: Side, best: Best) -> None:
    """Add the rows of a block to the best of every slot."""
    width = 1 if task.positive is None else task.positive.shape[1]
    for s in range(0, len(task.copies), ANCHORS):
        part = slice(s, s + ANCHORS)
        a = task.anchors.part(part)
        low = np.maximum(task.low, best.low)[s * width : (s + ANCHORS) * width].reshape(-1, width)
        same = a.label[:, None] == rows.label[None, :]
        if task.positive is None:
            ai, bi, score = scored_pairs(a, rows, same & (a.place[:, None] != rows.place[None, :]), low[:, 0])
            keep = score >= low[ai, 0]
            best.add(ai[keep] + s, score[keep], rows.ids[bi[keep]])
            continue
        high = task.positive[part]
        ai, bi, score = scored_pairs(a, rows, ~same & (high.max(axis=1) >= 0)[:, None], low.min(axis=1), high.max(axis=1))
        for w in range(width):
            keep = (score <= high[ai, w]) & (score >= low[ai, w])
            best.add((ai[keep] + s) * width + w, score[keep], rows.ids[bi[keep]])


def _scan(index: DataFrame, size: int, task: Task) -> DataFrame:
    """The best rows of every slot in every part of the index, cut to the first k of all parts."""
    sent = index.sparkSession.sparkContext.broadcast(task)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = sent.value
        width = 1 if task.positive is None else task.positive.shape[1]
        best = Best(len(task.copies) * width, task.k)
        for batch in batches:
            rows = Side.of(batch, size)
            for s in range(0, batch.num_rows, ROWS):
                _search(task, rows.part(slice(s, s + ROWS)), best)
        if len(best.slot):
            a, w = best.slot // width, best.slot % width
            none = np.zeros(len(a), np.int64)
            positive = (none, none) if task.positive is None else (task.positive_id[a, w], task.positive[a, w])
            columns = [task.anchors.place[a], task.anchors.ids[a], task.copies[a], w.astype(np.int32), *positive, best.id, best.score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["place", "anchor_id", "copies", "slot", "positive_id", "positive_score", "id", "score"])

    found = index.mapInArrow(run, FOUND)
    w = Window.partitionBy("place", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= task.k)


def _positives(found: pa.Table, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of each anchor's positives by rank."""
    scores, ids = np.full((len(places), k), NO), np.zeros((len(places), k), np.int64)
    order = np.argsort(places)
    row = order[np.searchsorted(places[order], found["place"].to_numpy())] if found.num_rows else np.zeros(0, np.int64)
    rank = found["rank"].to_numpy() - 1
    scores[row, rank], ids[row, rank] = found["score"].to_numpy(), found["id"].to_numpy()
    return scores, ids


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80, per_pass: int = 16_384, sample_rows: int = 20_000) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and each of its first positives.

    Negatives are the first ``negatives`` rows of other labels that score between ``percent`` % of the positive's score and the positive's score.
    """
    spark = vectors.sparkSession
    index, size = build_index(vectors, anchor)
    anchors = index.where("anchor").groupBy("vec_id", "label", "v", "mean", "dev").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("copies"))
    anchors = cut(anchors)
    totals = index.agg(F.count(F.lit(1)).alias("n")).first().n, anchors.count()
    passes = max(1, -(-totals[1] // per_pass))
    sample = index.where(F.pmod(F.xxhash64("place", F.lit("sample")), F.lit(max(1, totals[0] // sample_rows))) == 0)
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/negatives-{uuid.uuid4().hex}"
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    parts = 0
    for n in range(passes):
        held = anchors.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(passes)) == n).toArrow()
        for s in range(0, held.num_rows, per_pass):
            chosen = held.slice(s, per_pass)
            a, copies = Side.of(chosen, size), chosen["copies"].to_numpy()
            task = Task(a, copies, positives, np.full(len(copies), NO))
            task.low = _least(_scan(sample, size, task).toArrow(), a.place, 1, positives)
            scores, ids = _positives(_scan(index, size, task).toArrow(), a.place, positives)
            task = Task(a, copies, negatives, _windows(scores, percent).ravel(), scores, ids, percent)
            task.low = np.maximum(task.low, _least(_scan(sample, size, task).toArrow(), a.place, positives, negatives))
            out = _scan(index, size, task).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.parquet(f"{root}/{parts}")
            parts += 1
    return spark.read.schema(schema).parquet(*[f"{root}/{k}" for k in range(parts)]) if parts else spark.createDataFrame([], schema)


def _least(found: pa.Table, places: np.ndarray, width: int, k: int) -> np.ndarray:
    """The k-th score of every slot that has k rows in the sample: the whole table's k-th can't be lower."""
    low = np.full(len(places) * width, NO)
    last = found.filter(pa.array(found["rank"].to_numpy() == k)) if found.num_rows else found
    if last.num_rows:
        order = np.argsort(places)
        row = order[np.searchsorted(places[order], last["place"].to_numpy())]
        low[row * width + last["slot"].to_numpy()] = last["score"].to_numpy()
    return low


SQL = """
WITH held AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s
  FROM held a JOIN held b ON a.r <> b.r WHERE a.vec_id % 100 = 0
), positives AS MATERIALIZED (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN scores n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.id) <= 5
"""


@query("op12_segment_summaries", SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding").where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    infinite = F.lit(float("inf"))
    rows = rows.where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"))
    return mine(vectors, F.col("vec_id") % 100 == 0)
