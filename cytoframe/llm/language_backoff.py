"""Language identification: whole words first, then shorter and shorter character n-grams.

Training counts words and character n-grams (orders 1 to ``ORDERS``) per language on a sample of about
``docs_per_lang`` labelled documents of each language.  Every language chooses its most frequent words (seen twice or
more) and, for each order, its most frequent n-grams; a chosen feature is kept with its counts in
all languages.  The quotas follow from ``max_bytes``, the size of the model: 8 bytes and 4 for each language a feature.  Scoring
reads whole texts: a known word adds its log frequency per language; a word that training
did not keep is scored by its n-grams of the longest order of which it has a known one.
The language with the largest sum wins (ties: first by code point); ``score`` is the softmax
of the sums divided by the square root of the number of words.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text
if there was nothing to learn from; a null doc_id is never held out; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import fold, table
from cytoframe.llm.tokens import Words, mix, randoms, slices
from cytoframe.session import cut

ORDERS = 4
U = np.uint64
LETTER = re.compile(r"[^\W\d_]")
_STEP = randoms(ORDERS + 1, 5) | U(1)


class Grams:
    """Code points of a slice, to hash the character n-grams of chosen words."""

    def __init__(self, words: Words):
        lead = (words.raw & 0xC0) != 0x80
        self.index = np.concatenate([[0], np.cumsum(lead)])
        points = np.frombuffer(words.raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4").astype(U)
        upper = (points >= U(65)) & (points <= U(90))
        self.points = mix(np.where(upper, points + U(32), points))
        self.starts, self.ends = self.index[words.starts], self.index[words.ends]

    def hashes(self, chosen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of order k of the chosen words, and bounds per word."""
        n = np.maximum(self.ends[chosen] - self.starts[chosen] - k + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.starts[chosen] - bounds[:-1], n) + np.arange(bounds[-1])
        total = np.full(len(at), k, U)
        for j in range(k):
            total += self.points[at + j] * _STEP[j]
        return mix(total), bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (lang, order, hash, n); order 0 holds whole words.  Flushed when it grows."""
    held: list[pd.DataFrame] = []

    def flush() -> pa.RecordBatch:
        out = pd.concat(held).groupby(["lang", "k", "h"], as_index=False)["n"].sum()
        held.clear()
        return pa.RecordBatch.from_pandas(out, preserve_index=False)

    for batch in batches:
        langs = np.array(batch["lang"].to_pylist(), dtype=object)
        for words in slices(batch["text"]):
            owner = langs[words.first + words.owners()]
            grams = Grams(words)
            for lang in set(owner):
                mine = np.flatnonzero(owner == lang)
                for k in range(ORDERS + 1):
                    h = words.hashes[mine] if k == 0 else grams.hashes(mine, k)[0]
                    h, n = np.unique(h, return_counts=True)
                    held.append(pd.DataFrame({"lang": lang, "k": np.int32(k), "h": h.view(np.int64), "n": n}))
        if sum(map(len, held)) > 2_000_000:
            yield flush()
    if held:
        yield flush()


class Model:
    """Sorted hashes and a (feature, language) table of log frequencies for each order."""

    def __init__(self, langs: list[str], rows: pa.Table):
        """``rows``: k, h, and for each feature its languages (by number) and counts as two lists."""
        self.langs, self.keys, self.logs, self._sent = langs, [], [], None
        for k in range(ORDERS + 1):
            part = rows.filter(pa.compute.equal(rows["k"], k)).combine_chunks()
            h = part["h"].to_numpy().view(U)
            order = np.argsort(h)
            place = np.empty(len(h), np.int64)
            place[order] = np.arange(len(h))
            logs = np.full((len(h), len(langs)), 0.5, np.float32)
            sizes = part["at"].combine_chunks().value_lengths().to_numpy() if len(h) else np.zeros(0, np.int64)
            logs[np.repeat(place, sizes), part["at"].combine_chunks().flatten().to_numpy()] += part["n"].combine_chunks().flatten().to_numpy().astype(np.float32)
            total = logs.sum(axis=0, dtype=np.float64) + 0.5  # half a count for every feature and one for all others
            np.log(logs, out=logs)
            logs -= np.log(total).astype(np.float32)
            self.keys.append(h[order])
            self.logs.append(logs)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (*self.keys, *self.logs))

    def sent(self, spark: SparkSession):
        """The broadcast of this model; it is sent once."""
        if self._sent is None:
            self._sent = spark.sparkContext.broadcast(self)
        return self._sent

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_sent": None}

    def find(self, k: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys[k]
        if not len(keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return at, keys[at] == h

    def score(self, words: Words) -> np.ndarray:
        """Sums of log frequencies per text and language."""
        n = len(words.hashes)
        per_word = np.zeros((n + 1, len(self.langs)), np.float32)
        unique, inverse = np.unique(words.hashes, return_inverse=True)
        at, known = self.find(0, unique)
        value = np.where(known[:, None], self.logs[0][at] if len(self.keys[0]) else 0, 0).astype(np.float32)
        left = np.flatnonzero(~known)
        if len(left):
            sample = np.zeros(len(unique), np.int64)
            sample[inverse] = np.arange(n)  # one place of each word in the slice
            grams = Grams(words)
            for k in range(ORDERS, 0, -1):
                h, bounds = grams.hashes(sample[left], k)
                at, known = self.find(k, h)
                sums = np.zeros((len(h) + 1, len(self.langs)))
                if len(self.keys[k]):
                    np.cumsum(np.where(known[:, None], self.logs[k][at], 0), axis=0, out=sums[1:])
                hits = np.concatenate([[0], np.cumsum(known)])
                got = hits[bounds[1:]] - hits[bounds[:-1]]
                done = got > 0
                value[left[done]] = ((sums[bounds[1:]] - sums[bounds[:-1]])[done] / got[done, None]).astype(np.float32)
                left = left[~done]
                if not len(left):
                    break
        per_word[1:] = value[inverse]
        total = np.cumsum(per_word, axis=0, dtype=np.float64)
        return total[words.bounds[1:]] - total[words.bounds[:-1]]


def train(docs: DataFrame, docs_per_lang: int = 3000, max_bytes: int = 12_000_000) -> Model | None:
    """Fit on a documented sample: each language's documents are kept with probability docs_per_lang / their number."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row per language, as many as the model has columns; so the sample is drawn where the texts are read
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    sizes = docs.sparkSession.createDataFrame(sizes.collect(), sizes.schema)
    langs = sorted(r.lang for r in sizes.collect())
    if not langs:
        return None
    chance = (F.xxhash64(F.col("doc_id"), F.lit("sample")).bitwiseAND(F.lit((1 << 30) - 1))) / float(1 << 30)
    sample = known.select("doc_id", "lang", "text").join(sizes, "lang").where(chance * F.col("_n") < docs_per_lang)
    counts = sample.select("lang", "text").mapInArrow(_count, "lang string, k int, h long, n long").groupBy("lang", "k", "h").agg(F.sum("n").alias("n"))
    counts = cut(counts)
    # half of the room for words, half for n-grams, in equal parts for languages and orders
    quota = max_bytes // (8 + 4 * len(langs)) // len(langs) // 2
    rank = F.row_number().over(Window.partitionBy("lang", "k").orderBy(F.desc("n"), "h"))
    chosen = counts.where("k > 0 OR n >= 2").withColumn("_r", rank).where(F.col("_r") <= F.when(F.col("k") == 0, quota).otherwise(max(quota // ORDERS, 1)))
    at = (F.array_position(F.lit(langs), F.col("lang")) - 1).cast("int")
    kept = counts.join(chosen.select("k", "h").distinct(), ["k", "h"]).groupBy("k", "h").agg(F.collect_list(F.struct(at.alias("at"), "n")).alias("c"))
    rows = kept.select("k", "h", F.col("c.at").alias("at"), F.col("c.n").alias("n")).toArrow()
    return Model(langs, rows) if rows.num_rows else None


def identify(docs: DataFrame, model: Model | None, keep_text: bool = True) -> DataFrame:
    """``docs`` (which has a ``text``) with ``lang_pred`` and ``score``; other columns pass through."""
    sent = None if model is None else model.sent(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None if sent is None else sent.value
        for batch in batches:
            texts = batch["text"]
            pred = np.full(batch.num_rows, "und", dtype=object)
            score = np.zeros(batch.num_rows)
            if model is not None:
                lettered = np.array([x.is_valid and LETTER.search(x.as_py()) is not None for x in texts], bool)
                for words in slices(texts):
                    rows = slice(words.first, words.first + words.n_texts)
                    sums = model.score(words) / np.sqrt(np.maximum(np.diff(words.bounds), 1))[:, None]
                    best = sums.argmax(axis=1)
                    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                    ok = lettered[rows]
                    pred[rows] = np.where(ok, np.array(model.langs, dtype=object)[best], "und")
                    score[rows] = np.where(ok, share, 0.0)
            names = [c for c in batch.schema.names if c in kept]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(pred, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    kept = [c for c in docs.columns if c != "text" or keep_text]
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c in kept)
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double")


def length_class() -> Column:
    return F.floor(F.log2(F.char_length("text") + 1)).cast("int")


def least_scores(held: DataFrame, model: Model, least_rows: int = 200) -> dict[int, float]:
    """The score below which a text of a length class (powers of two) has no language.

    That is half way from a score that tells nothing (one over the number of languages) to the lowest
    score of a labelled row of ``held`` whose language was found.  A class of fewer than
    ``least_rows`` such rows has no entry.
    """
    told = identify(held.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang"), model).where("lang_pred = lang")
    found = told.groupBy(length_class().alias("c")).agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_rows)
    nothing = 1 / len(model.langs)
    return {r.c: (nothing + r.low) / 2 for r in found.collect()}


@query("op9_language_backoff")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", fold("doc_id", 4, 2).alias("held_out"))
    model = train(docs.where(~F.col("held_out")))
    return identify(docs.select("doc_id", "held_out", "text"), model, keep_text=False)
