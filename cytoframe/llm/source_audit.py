"""Divergence of sources within a language, from exact term counts made by length-bucketed packing.

Counting.  A task finds the terms of whole Arrow batches (runs of ASCII letters, lowered, and bytes from 0x80 on) and packs
them by length: up to 8 bytes are one big-endian uint64, up to 16 bytes two of them; packed terms are
sorted by a least-significant-digit radix sort on 16-bit digits and counted as runs.  Longer terms lie in buckets of
byte strings of one width (32, 64, 128, ... bytes), each sorted by bytes and counted as runs.  Texts of a batch are put in the
order of their (language, source) group first; as every sort is stable, one pass over the runs gives the
occurrences of a term in a group and the number of the group's documents that hold it.  Tasks merge their
runs, so that a frequent term leaves a task a few times at most, and Spark adds the rest.

Audit.  With V terms kept in a language (those in ``min_docs`` documents or more) and N kept occurrences, a term seen n times has
p = 1 + floor(10^9 (n + a) / (N + a V)) in exact integers.  Sources are compared by the sum of |p - p'| over all
kept terms, in parts of the vocabulary; a source's own terms are those with p above the language's.

Defined cases: null text, language and source count as ''; a group without terms is compared all the same, and has no terms of its
own; a language without kept terms gives 0 for all its pairs; repeated rows are documents of their own; an empty table
gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import LOWER, UPPER, table
from cytoframe.llm.token_store import raw_slices, spread
from cytoframe.session import cut

BILLION = 1_000_000_000
MERGE_ENTRIES = 1_000_000
MERGE_BYTES = 1 << 26
GROUPS_SENT = 200_000
COUNTS = "lang string, source string, term string, n long, docs long"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[97:123] = _TERM[65:91] = _TERM[128:] = True
_KEEP = np.array([0] + [((1 << 64) - 1) << (64 - 8 * n) & ((1 << 64) - 1) for n in range(1, 9)], np.uint64)


def radix_order(words: list[np.ndarray], order: np.ndarray | None = None) -> np.ndarray:
    """A stable order by ``words`` (first word most significant): 16-bit digits from the last to the first; digits that are all alike are passed over."""
    order = np.arange(len(words[0])) if order is None else order
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


@dataclass
class Runs:
    """Counts of terms of one length class: ``words`` is one or two uint64 arrays, or one array of byte strings."""

    words: list[np.ndarray]
    group: np.ndarray
    n: np.ndarray
    docs: np.ndarray

    def __len__(self) -> int:
        return len(self.group)

    @property
    def size(self) -> int:
        return sum(w.nbytes for w in self.words)


def _order(words: list[np.ndarray], order: np.ndarray | None = None) -> np.ndarray:
    if words[0].dtype.kind == "S":
        key = words[0] if order is None else words[0][order]
        found = np.argsort(key, kind="stable")
        return found if order is None else order[found]
    return radix_order(words, order)


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def count_runs(words: list[np.ndarray], doc: np.ndarray, group_of: np.ndarray) -> Runs:
    """Occurrences and documents by (term, group); ``doc`` is ascending and documents stand in the order of their groups."""
    order = _order(words)
    words, doc = [w[order] for w in words], doc[order]
    group = group_of[doc]
    new_term = _changes(words)
    by_group = np.flatnonzero(new_term | _changes([group]))
    by_doc = new_term | _changes([doc])
    total = len(doc)
    return Runs([w[by_group] for w in words], group[by_group], np.diff(np.append(by_group, total)), np.add.reduceat(by_doc.astype(np.int64), by_group) if total else np.zeros(0, np.int64))


def merge_runs(parts: list[Runs]) -> Runs:
    words = [np.concatenate(w) for w in zip(*(p.words for p in parts), strict=True)]
    group, n, docs = (np.concatenate([getattr(p, c) for p in parts]) for c in ("group", "n", "docs"))
    order = _order(words, radix_order([group.astype(np.uint64)]))
    words, group, n, docs = [w[order] for w in words], group[order], n[order], docs[order]
    at = np.flatnonzero(_changes([*words, group]))
    return Runs([w[at] for w in words], group[at], np.add.reduceat(n, at), np.add.reduceat(docs, at))


def pack(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(width in bytes, words, text number) of the terms of a slice, by length class."""
    size = len(raw)
    if not size:
        return
    solid = _TERM[raw]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:size]
    stops[:-1] &= ~solid[1:] | edge[1:size]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(stops) + 1 - starts
    doc = np.searchsorted(offsets, starts, side="right") - 1
    low = np.concatenate([_LOWER[raw], np.zeros(16, np.uint8)])
    eight = np.ndarray((size + 9,), ">u8", buffer=low, strides=(1,))  # the eight bytes from every place on
    first = eight[starts].astype(np.uint64)
    one, two = lengths <= 8, (lengths > 8) & (lengths <= 16)
    if one.any():
        yield 8, [first[one] & _KEEP[lengths[one]]], doc[one]
    if two.any():
        yield 16, [first[two], eight[starts[two] + 8].astype(np.uint64) & _KEEP[lengths[two] - 8]], doc[two]
    long = lengths > 16
    widths = 1 << np.ceil(np.log2(np.maximum(lengths, 17))).astype(np.int64)
    for width in np.unique(widths[long]).tolist():
        mine = long & (widths == width)
        box = np.zeros(int(mine.sum()) * width, np.uint8)
        box[spread(np.arange(int(mine.sum())) * width, lengths[mine])] = low[spread(starts[mine], lengths[mine])]
        yield width, [box.view(f"S{width}")], doc[mine]


def unpack(words: list[np.ndarray]) -> pa.Array:
    """Terms as strings; terms hold no zero byte, so that zeros are padding."""
    n = len(words[0])
    if words[0].dtype.kind == "S":
        box = words[0].view(np.uint8).reshape(n, -1)
    else:
        box = np.stack(words, axis=1).astype(">u8").view(np.uint8).reshape(n, -1)
    held = box != 0
    ends = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(box[held].tobytes())]).cast(pa.string())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names: dict[tuple[str, str], int] = {}
    held: dict[int, list[Runs]] = {}

    def flush(width: int) -> pa.RecordBatch:
        runs, keys = held.pop(width)[0], list(names)
        group = pa.array(runs.group)
        columns = [pc.take(pa.array([k[i] for k in keys], pa.string()), group) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, unpack(runs.words), pa.array(runs.n), pa.array(runs.docs)], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        groups = np.array([names.setdefault(k, len(names)) for k in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True)], np.int64)
        order = np.argsort(groups, kind="stable")
        groups, texts, at = groups[order], batch["text"].take(pa.array(order)), 0
        for raw, offsets in raw_slices(texts):
            group_of = groups[at : at + len(offsets) - 1]
            at += len(offsets) - 1
            for width, words, doc in pack(raw, offsets):
                runs = held.setdefault(width, [])
                runs.append(count_runs(words, doc, group_of))
                if sum(map(len, runs)) > MERGE_ENTRIES or sum(r.size for r in runs) > MERGE_BYTES:
                    held[width] = [merge_runs(runs)]
                    if len(held[width][0]) > MERGE_ENTRIES // 2 or held[width][0].size > MERGE_BYTES // 2:
                        yield flush(width)
    for width in list(held):
        held[width] = [merge_runs(held[width])]
        yield flush(width)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all whole texts."""
    text = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return text.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def per_billion(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 n / total), exactly, by long division in steps of a thousand."""
    n, total = np.broadcast_arrays(n, total)
    if total.size and total.max() > 1 << 52:
        n, total = n.astype(object), total.astype(object)
    out = np.zeros_like(n)
    for _ in range(3):
        n = n * 1000
        out = out * 1000 + n // total
        n = n % total
    return (out + 1).astype(np.int64)


def _p(n: str, total: str, extra: int) -> Column:
    return F.expr(f"1 + CAST({BILLION} AS DECIMAL(10,0)) * CAST({n} + {extra} AS DECIMAL(19,0)) div CAST({total} + {extra} * v AS DECIMAL(20,0))")


def _compare(extra: int):
    def run(entries: pa.Table, groups: pa.Table) -> pa.Table:
        """Sums of |p - p'| over the kept terms of one part of a language's vocabulary, for all pairs of its sources."""
        names = groups["source"].to_pylist()
        order = sorted(range(len(names)), key=lambda i: names[i].encode())
        names = [names[i] for i in order]
        total = (groups["total"].to_numpy() + extra * groups["v"].to_numpy())[order]
        sums = np.zeros((len(names), len(names)), np.int64)
        if entries.num_rows:
            place = {s: i for i, s in enumerate(names)}
            source = np.array([place[s] for s in entries["source"].to_pylist()])
            coded = entries["term"].combine_chunks().dictionary_encode()
            term, n = coded.indices.to_numpy(), entries["n"].to_numpy()
            step = max(1, (1 << 21) // len(names))
            by_term = np.argsort(term, kind="stable")
            edges = np.searchsorted(term[by_term], np.arange(0, len(coded.dictionary) + step, step))
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                rows = by_term[a:b]
                counts = np.zeros((min(step, len(coded.dictionary) - k * step), len(names)), np.int64)
                counts[term[rows] - k * step, source[rows]] = n[rows]
                p = per_billion(counts + extra, total[None, :])
                for i in range(len(names) - 1):
                    sums[i, i + 1 :] += np.abs(p[:, i + 1 :] - p[:, i : i + 1]).sum(axis=0)
        i, j = np.triu_indices(len(names), 1)
        known = pa.array(names, pa.string())
        lang = pa.array([groups["lang"][0].as_py()] * len(i), pa.string())
        return pa.table({"lang": lang, "source": known.take(pa.array(i)), "item": known.take(pa.array(j)), "value": pa.array(sums[i, j])})

    return run


def audit(docs: DataFrame, min_docs: int = 30, extra: int = 5, top: int = 50, part_entries: int = 20_000) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources of the language, and the terms that a source holds beyond its language."""
    counts = cut(term_counts(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n")).where(F.col("docs") >= min_docs).drop("docs")
    entries = cut(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all_n"))
    langs = entries.groupBy("lang", "term").agg(F.max("all_n").alias("all_n")).groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    groups = cut(groups)
    sized = entries.agg(F.count(F.lit(1)).alias("n")).first().n

    parts = max(1, -(-sized // part_entries))
    dealt = entries.select("lang", "source", "term", "n", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("deal"))
    asked = groups.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    sums = dealt.groupBy("lang", "deal").cogroup(asked.groupBy("lang", "deal")).applyInArrow(_compare(extra), "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = sums.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    # one row a group: sent to the tasks while they are few, joined by key beyond
    told = F.broadcast(groups) if groups.count() <= GROUPS_SENT else groups
    own = entries.join(told, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (_p("n", "total", extra) - _p("all_n", "lang_total", extra)).cast("long").alias("value")).where("value > 0")
    ranked = lambda x: x.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    own = ranked(own).where(F.col("rank") <= top)
    out = ranked(pairs).unionByName(own.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
), terms AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM terms GROUP BY lang, source, term
), kept AS MATERIALIZED (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term HAVING sum(docs) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), totals AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT c.* FROM counts c JOIN kept k ON k.lang = c.lang AND k.term = c.term) c ON c.lang = g.lang AND c.source = g.source
  GROUP BY g.lang, g.source
), p AS MATERIALIZED (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + CAST({BILLION} * (coalesce(c.n, 0) + 5)::HUGEINT // (t.n + 5 * l.v)::HUGEINT AS BIGINT) AS p,
         1 + CAST({BILLION} * (k.n + 5)::HUGEINT // (l.n + 5 * l.v)::HUGEINT AS BIGINT) AS q
  FROM totals t JOIN kept k ON k.lang = t.lang JOIN langs l ON l.lang = t.lang
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), own AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query("op13_packed_terms", SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents").select("lang", "source", "text"))
