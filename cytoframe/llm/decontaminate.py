"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

Test items (in pieces of at most ``PIECE`` words) form the index: per term postings in piece
order, cut in blocks of ``BLOCK`` pieces that know their largest impact.  Impacts are BM25
parts divided by the piece's score for its own words, so that a score of 1 means the passage holds them all.
Every document is cut in overlapping passages of twice the longest piece's length, so that
each piece lies wholly within one passage; each passage is a query for all pieces of at
least ``least`` score.  Block maxima, summed per passage and block for a whole batch at once, rule out
nearly all blocks: those that can't reach ``least`` even with what the most common terms can add.  In
the others WAND moves from pivot to pivot by the block's maxima.  An item whose question and answer
stand so far apart that no passage holds ``least`` of its weight is retrieved by its question: of n shingles, any
n - ceil(0.8 n) + 1 include one of a document that has 80 % of them, so the first ones (by hash, shingles
of few items first) of each question are looked up too; its score is that of the whole document.  The items so retrieved are then
verified on the whole document: 80 % or more of the five-word shingles both of the question
(the words before the answer) and of the answer (its last third) must be there.

The index is fitted to items, not to documents.  It is broadcast in shards of
at most ``shard_items`` items, one pass over the documents each, so that a task's memory doesn't follow the benchmark.

Defined cases: words are compared with ASCII capitals lowered; items of fewer than
``min_words`` words can't be told from chance and are left out; null or empty texts match nothing;
repeated rows are reported once each; null ids are reported as null; no items, no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import sql_lower, table
from cytoframe.llm.tokens import Words, shingles, slices

U = np.uint64
PIECE = 128
BLOCK = 4
COMMON = 0.1  # what the common terms, which block bounds leave out, can add to a score
K1, B = 1.2, 0.75
SHINGLE = 5
OVERLAP = 0.8
DONE = np.iinfo(np.int64).max


def _parts(n: int) -> int:
    """How many of an item's n words are its question; the rest is the answer."""
    return n - n // 3


class Index:
    """Postings of one shard of items; all arrays are sorted by (term, piece)."""

    def __init__(self, items: pd.DataFrame, least: float, min_words: int):
        self.least = least
        self.ids, pieces, owners = [], [], []
        self.question, self.answer = [], []
        for words in slices(pa.array(items["text"], pa.large_string())):
            for i in range(words.n_texts):
                h = words.hashes[words.bounds[i] : words.bounds[i + 1]]
                if len(h) < min_words:
                    continue
                q = _parts(len(h))
                self.question.append(_shingle_set(h[:q]))
                self.answer.append(_shingle_set(h[q:]))
                for a in range(0, len(h), PIECE):
                    pieces.append(h[a : a + PIECE])
                    owners.append(len(self.ids))
                self.ids.append(int(items["item_id"].iloc[words.first + i]))
        self.owners = np.array(owners, np.int64)
        self.keys, self.keyed = self._first_shingles()
        self.longest = max(map(len, pieces), default=1)
        mean = np.mean([len(p) for p in pieces]) if pieces else 1.0
        rows = []
        for d, p in enumerate(pieces):
            terms, tf = np.unique(p, return_counts=True)
            rows.append((terms, np.full(len(terms), d), tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(p) / mean))))
        term = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, U)
        self.piece = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.int64)
        impact = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0)
        self.terms, which, df = np.unique(term, return_inverse=True, return_counts=True)
        impact = impact * np.log(1 + (len(pieces) - df + 0.5) / (df + 0.5))[which]
        own = np.bincount(self.piece, impact, len(pieces))
        impact = impact / own[self.piece] if len(pieces) else impact
        order = np.lexsort((self.piece, which))
        self.piece, self.impact = self.piece[order], impact[order]
        self.bounds = np.concatenate([[0], np.cumsum(df)])
        self.most = np.maximum.reduceat(self.impact, self.bounds[:-1]) if len(self.terms) else np.zeros(0)
        # the most common terms are left out of block bounds and allowed for as a whole
        by_size = np.argsort(self.most, kind="stable")
        self.rare = np.ones(len(self.terms), bool)
        self.rare[by_size[np.cumsum(self.most[by_size]) <= COMMON]] = False
        self.slack = float(self.most[~self.rare].sum())
        # runs of postings of one term in one block
        term_of = np.repeat(np.arange(len(self.terms)), df)
        self.n_blocks = -(-len(pieces) // BLOCK)
        run = term_of * max(1, self.n_blocks) + self.piece // BLOCK
        first = np.flatnonzero(np.diff(run, prepend=-1))
        self.run_start, self.run_end = first, np.append(first[1:], len(run))
        self.run_name = run[first]
        self.run_block = run[first] % max(1, self.n_blocks)
        self.run_most = np.maximum.reduceat(self.impact, first) if len(first) else np.zeros(0)
        self.run_bounds = np.searchsorted(term_of[first], np.arange(len(self.terms) + 1))

    def _first_shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """(shingle, item) of as many shingles of each question as can't all be missing from a match, sorted by shingle."""
        if not self.question:
            return np.zeros(0, U), np.zeros(0, np.int64)
        names, count = np.unique(np.concatenate(self.question), return_counts=True)
        keys = []
        for s in self.question:
            n = len(s) - int(np.ceil(OVERLAP * len(s) - 1e-9)) + 1
            keys.append(s[np.argsort(count[np.searchsorted(names, s)], kind="stable")[:n]])
        key, item = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(x) for x in keys])
        order = np.argsort(key, kind="stable")
        return key[order], item[order]

    def apart(self, words: Words) -> Iterator[tuple[int, int]]:
        """(text, item) of all texts of a slice that hold one of the item's first shingles."""
        h, bounds = shingles(words, SHINGLE)
        low = np.searchsorted(self.keys, h)
        at = np.flatnonzero((low < len(self.keys)) & (self.keys[np.minimum(low, len(self.keys) - 1)] == h))
        high = np.searchsorted(self.keys, h[at], side="right")
        text = np.searchsorted(bounds, at, side="right") - 1
        n = high - low[at]
        item = self.keyed[np.repeat(low[at] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())]
        pair = np.unique(np.repeat(text, n) * len(self.ids) + item)
        yield from zip((pair // len(self.ids)).tolist(), (pair % len(self.ids)).tolist(), strict=True)

    def whole_score(self, item: int, h: np.ndarray) -> float:
        """The best score of an item's pieces for a whole document."""
        terms = np.unique(self.find(h))
        mine = np.isin(np.repeat(np.arange(len(self.terms)), np.diff(self.bounds)), terms)
        return float(np.bincount(self.piece[mine], self.impact[mine], len(self.owners))[self.owners == item].max())

    def find(self, h: np.ndarray) -> np.ndarray:
        """Term numbers of hashes, -1 for words of no item."""
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1)

    def wand(self, terms: np.ndarray, block: int) -> list[tuple[int, float]]:
        """The pieces of a block whose score for these distinct terms is at least the threshold."""
        least, out = self.least - 1e-9, []
        name = terms * self.n_blocks + block
        run = np.searchsorted(self.run_name, name)
        run = run[(run < len(self.run_name)) & (self.run_name[np.minimum(run, len(self.run_name) - 1)] == name)]
        lists = [(self.piece[a:b].tolist(), self.impact[a:b].tolist(), m) for a, b, m in zip(self.run_start[run], self.run_end[run], self.run_most[run], strict=True)]
        heads = [[pieces[0], 0, pieces, impacts, most] for pieces, impacts, most in lists]  # piece, place, list
        while True:
            heads.sort(key=lambda head: head[0])
            bound, pivot = 0.0, -1
            for n, head in enumerate(heads):
                bound += head[4]
                if bound >= least:
                    pivot = n
                    break
            if pivot < 0:
                return out
            doc = heads[pivot][0]
            if heads[0][0] == doc:
                score = sum(head[3][head[1]] for head in heads if head[0] == doc)
                if score >= least:
                    out.append((doc, score))
                to = doc + 1
            else:
                to = doc  # nothing before the pivot can reach the threshold
            for head in heads:
                if head[0] < to:
                    at, pieces = head[1], head[2]
                    while at < len(pieces) and pieces[at] < to:
                        at += 1
                    head[0], head[1] = (pieces[at] if at < len(pieces) else DONE), at
            heads = [head for head in heads if head[0] < DONE]

    def search(self, words: Words) -> Iterator[tuple[int, int, float]]:
        """(text, item, best score) of all passages of a slice."""
        stride = max(32, self.longest)
        hit = self.find(words.hashes)
        at = np.flatnonzero(hit >= 0)
        if not len(at):
            return
        hit, owner = hit[at], words.owners()[at]
        cell = (at - words.bounds[owner]) // stride
        # a passage is two cells: cell c lies in passages c - 1 and c
        span = int(cell.max()) + 2
        slot = np.concatenate([owner * span + cell, (owner * span + cell - 1)[cell > 0]])
        pair = np.unique(slot * len(self.terms) + np.concatenate([hit, hit[cell > 0]]))
        slot, hit = pair // len(self.terms), pair % len(self.terms)
        names, begin, passage = np.unique(slot, return_index=True, return_inverse=True)
        ends = np.append(begin[1:], len(slot))
        rare = self.rare[hit]
        passage, term = passage[rare], hit[rare]
        best: dict[tuple[int, int], float] = {}
        step = max(1, 4_000_000 // self.n_blocks)
        for low in range(0, len(names), step):
            a, b = np.searchsorted(passage, [low, low + step])
            n = (self.run_bounds[term[a:b] + 1] - self.run_bounds[term[a:b]])
            run = np.repeat(self.run_bounds[term[a:b]] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
            where = np.repeat(passage[a:b] - low, n) * self.n_blocks + self.run_block[run]
            bound = np.bincount(where, self.run_most[run], minlength=1)
            for found in np.flatnonzero(bound >= self.least - self.slack - 1e-9).tolist():
                p, block = low + found // self.n_blocks, found % self.n_blocks
                for piece, score in self.wand(hit[begin[p] : ends[p]], block):
                    key = (int(names[p]) // span, int(self.owners[piece]))
                    best[key] = max(best.get(key, 0.0), score)
        for (text, item), score in best.items():
            yield text, item, score

    def verify(self, item: int, mine: np.ndarray) -> tuple[float, float]:
        return tuple(float(np.isin(s, mine).mean()) for s in (self.question[item], self.answer[item]))


def _shingle_set(h: np.ndarray) -> np.ndarray:
    one = Words(0, 1, h, np.array([0, len(h)]), *[np.zeros(0, np.int64)] * 4)
    return np.unique(shingles(one, SHINGLE)[0])


def matches(docs: DataFrame, items: DataFrame, least: float = 0.6, min_words: int = 15, shard_items: int = 20_000) -> DataFrame:
    """(doc_id, item_id, score, question, answer) of every row of ``docs`` and item it contains."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, score double, question double, answer double"
    clean = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text").distinct()
    shards = max(1, -(-clean.count() // shard_items))
    found = None
    for shard in range(shards):
        mine = clean.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard).orderBy("item_id", "text").toPandas()
        index = Index(mine, least, min_words)
        if not index.ids:
            continue
        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_searcher(spark.sparkContext.broadcast(index)), schema)
        found = part if found is None else found.union(part)
    return spark.createDataFrame([], schema) if found is None else found


def _searcher(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            rows = []
            ids = batch["doc_id"].to_pylist()
            for words in slices(batch["text"]):
                if not len(words.hashes):
                    continue
                sets = {}
                scores = {(text, item): score for text, item, score in index.search(words)}
                for text, item in [*scores, *(p for p in index.apart(words) if p not in scores)]:
                    if text not in sets:
                        a, b = words.bounds[text], words.bounds[text + 1]
                        sets[text] = _all_shingles(words.hashes[a:b])
                    question, answer = index.verify(item, sets[text])
                    if min(question, answer) >= OVERLAP - 1e-9:
                        score = scores.get((text, item))
                        if score is None:
                            score = index.whole_score(item, words.hashes[words.bounds[text] : words.bounds[text + 1]])
                        rows.append((ids[words.first + text], index.ids[item], score, question, answer))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "score", "question", "answer"])

    return run


def _all_shingles(h: np.ndarray) -> np.ndarray:
    """Five-word shingles of a document."""
    return _shingle_set(h)


SQL = f"""
WITH iw AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array({sql_lower("text")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM benchmark),
parts AS (
  SELECT item_id, ws[1:len(ws) - len(ws) // 3] AS q, ws[len(ws) - len(ws) // 3 + 1:] AS a FROM iw WHERE len(ws) >= 15
),
sets AS (
  SELECT item_id, list_distinct(list_transform(range(1, len(q) - 3), lambda i: array_to_string(q[i:i + 4], ' '))) AS q,
         list_distinct(list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i + 4], ' '))) AS a FROM parts
),
dw AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array({sql_lower("text")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
ds AS (SELECT r, doc_id, unnest(list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))) AS x FROM dw),
q AS (SELECT item_id, len(q) AS n, unnest(q) AS x FROM sets), a AS (SELECT item_id, len(a) AS n, unnest(a) AS x FROM sets),
hq AS (SELECT r, doc_id, item_id FROM ds JOIN q USING (x) GROUP BY r, doc_id, item_id HAVING 10 * count(*) >= 8 * any_value(n)),
ha AS (SELECT r, doc_id, item_id FROM ds JOIN a USING (x) GROUP BY r, doc_id, item_id HAVING 10 * count(*) >= 8 * any_value(n))
SELECT any_value(hq.doc_id) AS doc_id, CAST(count(DISTINCT item_id) AS BIGINT) AS n_items,
       string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items
FROM hq JOIN ha USING (r, item_id) GROUP BY r
"""


@query("op4_block_max_wand", SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each contaminated document, with the items it contains."""
    found = matches(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    items = F.array_sort(F.collect_set("item_id"))
    out = found.groupBy("doc_id").agg(items.alias("i"))
    return out.select("doc_id", F.size("i").cast("long").alias("n_items"), F.array_join(F.col("i").cast("array<string>"), ",").alias("items"))
