"""Language-model scores of whole texts by a hidden Markov model over words.

Words of training texts are counted exactly.  The ``own`` most frequent words are emission
classes of their own, all others share classes by their hash; a latent state emits a class,
and a class emits its word with probability (c + 1) / (sum of its words' c + 1, plus 1).
Baum-Welch trains the states: every pass computes expected transitions and
emissions of all training tokens (in sequences of ``WINDOW`` tokens) per task, and only these
counts are added up.  They are added as integers, so that a rerun gives the same model.  The
score is the exact likelihood of the whole text by the scaled forward recursion.

The ``listed`` most frequent words travel with the model; the counts of all others are joined
to the texts that hold them, so that base scores are exact whatever the size of the vocabulary.

Defined cases: a null or empty text is the end token alone; a null doc_id is never held out;
repeated rows are scored alike; an empty table gives an empty result, and without training texts
every word is unseen; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import fold, row_key, table
from cytoframe.llm.tokens import mix, slices
from cytoframe.session import cut

U = np.uint64
END = np.int64(0x6E643A65)  # the end token's place among word hashes
STATES = 6
SHARED = 256
WINDOW = 64
SMOOTH = 0.1
UNIT = 1 << 20  # expected counts are added up in this fraction


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pd.Series] = []

    def flush() -> pa.RecordBatch:
        total = pd.concat(held).groupby(level=0).sum()
        held[:] = [total] if len(total) < 500_000 else []
        return None if held else pa.RecordBatch.from_arrays([pa.array(total.index.to_numpy()), pa.array(total.to_numpy())], ["h", "c"])

    for batch in batches:
        for words in slices(batch["text"]):
            h, n = np.unique(words.hashes.view(np.int64), return_counts=True)
            held += [pd.Series(n, h), pd.Series([words.n_texts], np.array([END]))]
        if sum(map(len, held)) > 1_500_000 and (full := flush()) is not None:
            yield full
    if held:
        total = pd.concat(held).groupby(level=0).sum()
        yield pa.RecordBatch.from_arrays([pa.array(total.index.to_numpy()), pa.array(total.to_numpy())], ["h", "c"])


class Lexicon:
    """The listed words with their counts, and the class of any word."""

    def __init__(self, listed: pd.DataFrame, own: int, tokens: int, types: int, shared_totals: np.ndarray):
        listed = listed.sort_values(["c", "h"], ascending=[False, True])
        own_words = np.union1d(listed["h"].to_numpy(np.int64)[:own], [END])
        order = np.argsort(listed["h"].to_numpy(np.int64))
        self.keys = listed["h"].to_numpy(np.int64)[order]
        self.counts = listed["c"].to_numpy(np.int64)[order]
        self.own = own_words
        self.tokens, self.types = tokens, types
        self.classes = len(own_words) + SHARED
        self.shared_totals = shared_totals  # sum of c + 1 over the shared classes' words, plus 1

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class, count, whether listed, whether the class is shared, of word hashes."""
        at = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
        shared = self.own[at] != h
        place = np.where(shared, len(self.own) + shared_class(h), at)
        if len(self.keys):
            k = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            known = self.keys[k] == h
            return place, np.where(known, self.counts[k], 0), known, shared
        return place, np.zeros(len(h), np.int64), np.zeros(len(h), bool), shared


def shared_class(h: np.ndarray) -> np.ndarray:
    return (h.view(U) >> U(40)).astype(np.int64) % SHARED


ENCODED = "doc_id long, _id long, _t long, held_out boolean, n_tokens long, n_known long, base double, words double, seq binary, rare array<long>"


def _encoder(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = sent.value
        end_class, end_count, _, _ = lexicon.look(np.array([END]))
        minus = np.log10(lexicon.shared_totals)
        for batch in batches:
            n_known, base, words_part, seqs, rare, n_tokens = [], [], [], [], [], []
            for words in slices(batch["text"]):
                unique, inverse = np.unique(words.hashes.view(np.int64), return_inverse=True)
                place, count, listed, shared = lexicon.look(unique) if len(unique) else (np.zeros(0, np.int64),) * 4
                logs = np.log10(count + 1.0)
                inner = np.where(shared, logs - minus[np.maximum(place - len(lexicon.own), 0)], 0.0) if len(unique) else logs
                run = lambda v: np.concatenate([[0], np.cumsum(v[inverse])]) if len(unique) else np.zeros(1)  # noqa: B023, E731
                sums = [run(x) for x in (logs, inner, (listed & (count > 0)) if len(unique) else logs)]
                seq = place[inverse].astype("<u2")
                hidden = ~listed[inverse] if len(unique) else np.zeros(0, bool)
                for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
                    n_tokens.append(b - a + 1)
                    base.append(sums[0][b] - sums[0][a] + np.log10(end_count[0] + 1.0))
                    words_part.append(sums[1][b] - sums[1][a])
                    n_known.append(int(sums[2][b] - sums[2][a]) + int(end_count[0] > 0))
                    seqs.append(np.append(seq[a:b], end_class.astype("<u2")).tobytes())
                    rare.append(unique[inverse[a:b]][hidden[a:b]])
            columns = [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(words_part, pa.float64()), pa.array(seqs, pa.binary()), pa.array(rare, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", "_id", "_t", "held_out")), *columns], [x.split()[0] for x in ENCODED.split(", ")])

    return run


class Markov:
    """Start, transition and emission probabilities; emissions are (class, state)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, share: np.ndarray, seed: int) -> Markov:
        """Each state prefers some classes: the corpus share of a class times seeded noise."""
        noise = mix(np.arange(len(share) * STATES, dtype=U) + U(seed << 32)).astype(np.float64) / 2.0**64
        emit = share[:, None] * (0.2 + noise.reshape(-1, STATES) ** 2)
        move = np.full((STATES, STATES), 0.1 / (STATES - 1))
        np.fill_diagonal(move, 0.9)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Markov:
        """Probabilities of expected counts; emissions are smoothed by ``SMOOTH`` of the corpus shares."""
        emit = (1 - SMOOTH) * (emit + share[:, None]) / (emit.sum(axis=0) + 1) + SMOOTH * share[:, None]
        return cls((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(axis=1, keepdims=True), emit)

    def expected(self, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected starts, moves and emissions of independent windows (forward-backward), and their log likelihood."""
        seqs = sorted(seqs, key=len, reverse=True)
        lengths = np.array([len(s) for s in seqs])
        longest = lengths[0]
        x = np.zeros((longest, len(seqs)), np.int64)
        for i, s in enumerate(seqs):
            x[: len(s), i] = s
        live = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
        seen = [self.emit[x[t, : live[t]]] for t in range(longest)]
        alpha, scale = [], []
        now = self.start * seen[0]
        for t in range(longest):
            if t:
                now = (alpha[-1][: live[t]] @ self.move) * seen[t]
            c = now.sum(axis=1)
            alpha.append(now / c[:, None])
            scale.append(c)
        move = np.zeros_like(self.move)
        gamma = [None] * longest
        beta = np.ones((live[-1], STATES))
        gamma[-1] = alpha[-1] * beta
        for t in range(longest - 2, -1, -1):
            ahead = seen[t + 1] * beta / scale[t + 1][:, None]
            move += alpha[t][: live[t + 1]].T @ ahead
            beta = np.ones((live[t], STATES))
            beta[: live[t + 1]] = ahead @ self.move.T
            gamma[t] = alpha[t] * beta
        every = np.concatenate(gamma)
        flat = np.concatenate([x[t, : live[t]] for t in range(longest)])
        emit = np.stack([np.bincount(flat, every[:, k], len(self.emit)) for k in range(STATES)], axis=1)
        return gamma[0].sum(axis=0), move * self.move, emit, float(sum(np.log(c).sum() for c in scale))

    def log10_likelihood(self, seqs: list[np.ndarray]) -> np.ndarray:
        """Exact log10 likelihood of whole sequences: the scaled forward recursion over all of them at once."""
        order = sorted(range(len(seqs)), key=lambda i: -len(seqs[i]))
        lengths = np.array([len(seqs[i]) for i in order])
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        flat = np.concatenate([seqs[i] for i in order]).astype(np.int64)
        live = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        total = np.zeros(len(seqs))
        now = self.start * self.emit[flat[starts]]
        for t in range(lengths[0]):
            n = live[t]
            if t:
                now = (now[:n] @ self.move) * self.emit[flat[starts[:n] + t]]
            c = now.sum(axis=1)
            total[:n] += np.log10(c)
            now /= c[:, None]
        out = np.empty(len(seqs))
        out[order] = total
        return out


def _expecter(sent):
    """One row per task and kind of count: (kind, lane, counts in units of 1 / UNIT)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Markov = sent.value
        sums, held, size = None, [], 0

        def take() -> None:
            nonlocal sums, held, size
            start, move, emit, like = model.expected(held)
            parts = [np.rint(v * UNIT).astype(np.int64).ravel() for v in (start, move, emit, np.array([like]))]
            sums = parts if sums is None else [a + b for a, b in zip(sums, parts, strict=True)]
            held, size = [], 0

        for batch in batches:
            for raw in batch["seq"]:
                seq = np.frombuffer(raw.as_buffer(), "<u2")
                for a in range(0, len(seq), WINDOW):
                    held.append(seq[a : a + WINDOW])
                size += len(seq)
                if size >= 250_000:
                    take()
        if held:
            take()
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(4), pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], ["kind", "counts"])

    return run


def _add(rows: pa.Table) -> pa.Table:
    total = None
    for raw in rows["counts"]:
        one = np.frombuffer(raw.as_buffer(), np.int64)
        total = one.copy() if total is None else total + one
    return pa.table({"kind": rows["kind"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def baum_welch(encoded: DataFrame, share: np.ndarray, passes: int = 4, seed: int = 3) -> tuple[Markov, list[float]]:
    """Train on the rows of ``encoded`` that are not held out; also the log likelihood before each pass."""
    sc = encoded.sparkSession.sparkContext
    model, path = Markov.first(share, seed), []
    rows = encoded.where("NOT held_out").select("seq")
    for _ in range(passes):
        parts = rows.mapInArrow(_expecter(sc.broadcast(model)), "kind int, counts binary").withColumn("lane", F.pmod(F.xxhash64("counts"), F.lit(64)))
        lanes = parts.groupBy("kind", "lane").applyInArrow(_add, "kind int, counts binary")
        got = {r["kind"]: np.frombuffer(r["counts"], np.int64) / UNIT for r in lanes.groupBy("kind").applyInArrow(_add, "kind int, counts binary").collect()}
        if not got:
            break
        path.append(float(got[3][0]))
        model = Markov.of_counts(got[0], got[1].reshape(STATES, STATES), got[2].reshape(-1, STATES), share)
    return model, path


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Markov = sent.value
        for batch in batches:
            if batch.num_rows:
                like = model.log10_likelihood([np.frombuffer(raw.as_buffer(), "<u2") for raw in batch["seq"]])
                names = [n for n in batch.schema.names if n != "seq"]
                yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(like)], [*names, "hidden"])

    return run


def score(docs: DataFrame, own: int = 16_000, listed: int = 250_000, passes: int = 4) -> DataFrame:
    """docs (doc_id, text, held_out) scored: n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    counts = cut(docs.where("NOT held_out").select("text").mapInArrow(_count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")))
    size = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, types = int(size["n"] or 0), int(size["v"])
    end = counts.where(F.col("h") == F.lit(int(END)))
    top = counts.where(F.col("h") != F.lit(int(END))).orderBy(F.desc("c"), "h").limit(listed).union(end).toPandas()
    lexicon = Lexicon(top, own, tokens, types, np.ones(SHARED))
    # words and tokens of each class, over the whole vocabulary
    own_keys = sc.broadcast(lexicon.own)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch["h"].to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(own_keys.value, h), len(own_keys.value) - 1)
            cls = np.where(own_keys.value[at] == h, at, len(own_keys.value) + shared_class(h))
            yield pa.RecordBatch.from_arrays([pa.array(cls), batch["c"]], ["cls", "c"])

    classes = counts.mapInArrow(place, "cls long, c long").groupBy("cls").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toPandas()
    per_class, types_of = np.zeros(lexicon.classes), np.zeros(lexicon.classes)
    per_class[classes["cls"]], types_of[classes["cls"]] = classes["c"], classes["v"]
    first = len(lexicon.own)
    lexicon.shared_totals = per_class[first:] + types_of[first:] + 1
    share = (per_class + 1) / (per_class + 1).sum()

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(n) for n, c in row_key().items()], "held_out", "text")
    encoded = cut(keyed.mapInArrow(_encoder(sc.broadcast(lexicon)), ENCODED))
    model, _ = baum_welch(encoded, share, passes)

    rare = encoded.select("_id", "_t", F.explode("rare").alias("h")).join(counts, "h").groupBy("_id", "_t").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("more"), F.count(F.lit(1)).alias("m"))
    copies = encoded.groupBy("_id", "_t").agg(F.count(F.lit(1)).alias("copies"))
    rare = rare.join(copies, ["_id", "_t"]).select("_id", "_t", (F.col("more") / F.col("copies")).alias("more"), (F.col("m") / F.col("copies")).cast("long").alias("m"))
    slim = encoded.select("doc_id", "_id", "_t", "held_out", "n_tokens", "n_known", "base", "words", "seq")
    names = ", ".join(x for x in ENCODED.split(", ") if x.split()[0] not in ("seq", "rare"))
    told = slim.mapInArrow(_scorer(sc.broadcast(model)), f"{names}, hidden double").join(rare, ["_id", "_t"], "left")
    more = F.coalesce("more", F.lit(0.0))
    return told.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("m", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.log10(F.lit(float(tokens + types + 1)))).alias("base_score"),
        (F.col("hidden") + F.col("words") + more).alias("score"),
    )


@query("op7_hidden_markov")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents").select("doc_id", "text", fold("doc_id", 7, 2).alias("held_out")))
