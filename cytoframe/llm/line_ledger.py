"""Reversible line deduplication: cuckoo filters per shard over exact reference counts.

A line's key is the line without blanks at its ends and with ASCII capitals lowered; it is
carried as two independent 64-bit hashes.  The ledger keeps, in the shared folder,

* ``refs``     (shard, h1, h2, n): in how many documents each key is found, exactly;
* ``filters``  (shard, filter): a cuckoo filter of the keys found in ``min_docs`` documents or more.

Inserting documents adds to the counts, deleting documents takes away; keys that cross the
threshold enter or leave their shard's filter, which a Bloom filter could not do.  Marking
lines sends (hash, document, position) to the shard's filter, and only what passes meets
the exact counts, so that a filter's false positives never drop a line.

Defined cases: a null or empty text is one empty line; keys shorter than ``min_chars`` code
points are never counted or dropped; every row counts as one document, also repeated ones; a
null doc_id is an ordinary value; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import BLANKS, LOWER, SQL_BLANKS, UPPER, ascii_lower, row_key, table, width
from cytoframe.llm.tokens import mix
from cytoframe.session import ensure_checkpoint_dir

SLOTS = 4
KICKS = 500
U = np.uint64
REFS = "shard int, h1 long, h2 long, n long"
FILTERS = "shard int, filter binary"


class Cuckoo:
    """A cuckoo filter: buckets of four 32-bit fingerprints; deletion removes one copy."""

    def __init__(self, n_keys: int):
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, n_keys) / (SLOTS * 0.8)))))
        self.table = np.zeros((buckets, SLOTS), np.uint32)

    @classmethod
    def load(cls, raw: bytes) -> Cuckoo:
        out = cls(0)
        out.table = np.frombuffer(raw, np.uint32).reshape(-1, SLOTS).copy()
        return out

    def dump(self) -> bytes:
        return self.table.tobytes()

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mix(h.astype(np.int64).view(U))
        mark = (h >> U(32)).astype(np.uint32) | np.uint32(1)
        mask = U(len(self.table) - 1)
        one = h & mask
        return mark, one, (one ^ mix(mark.astype(U))) & mask

    def insert(self, h: np.ndarray) -> bool:
        """False when a key finds no place: the caller then builds a larger filter."""
        rng = np.random.default_rng(len(self.table))
        mask = len(self.table) - 1
        for mark, one, two in zip(*self.places(h), strict=True):
            for bucket in (one, two):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = mark
                    break
            else:
                bucket = int(two)
                for _ in range(KICKS):
                    slot = int(rng.integers(SLOTS))
                    mark, self.table[bucket, slot] = self.table[bucket, slot], mark
                    bucket = (bucket ^ int(mix(np.array([mark], U))[0])) & mask
                    free = np.flatnonzero(self.table[bucket] == 0)
                    if len(free):
                        self.table[bucket, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, h: np.ndarray) -> None:
        for mark, one, two in zip(*self.places(h), strict=True):
            for bucket in (one, two):
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break

    def contains(self, h: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(h)
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)


def _filter_of(keys: np.ndarray) -> Cuckoo:
    size = max(16, len(keys))
    while True:
        out = Cuckoo(size)
        if out.insert(keys):
            return out
        size *= 2


def _update_filter(old: pa.Table, moved: pa.Table) -> pa.Table:
    """One shard: take out the keys that left, put in those that came; grow from the kept keys if it is full."""
    shard = (moved if moved.num_rows else old)["shard"][0].as_py()
    h, step = moved["h1"].to_numpy(), moved["step"].to_numpy()
    if old.num_rows:
        box = Cuckoo.load(old["filter"][0].as_py())
        box.delete(h[step < 0])
        if not box.insert(h[step > 0]):
            box = _filter_of(h[step >= 0])
    else:
        box = _filter_of(h[step >= 0])
    return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([box.dump()], pa.binary())})


def _pass_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard, each shard's filter before its lines; lines that pass go on."""
    shard, box = None, None
    for batch in batches:
        shards = batch["shard"].to_numpy(zero_copy_only=False)
        filters = batch["filter"]
        h = batch["h1"].fill_null(0).to_numpy(zero_copy_only=False)
        keep = np.zeros(len(shards), bool)
        is_filter = np.flatnonzero(filters.is_valid().to_numpy(zero_copy_only=False))
        edges = np.unique(np.concatenate([[0], is_filter, is_filter + 1, np.flatnonzero(np.diff(shards)) + 1, [len(shards)]]))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if filters[int(a)].is_valid:
                shard, box = shards[a], Cuckoo.load(filters[int(a)].as_py())
            elif box is not None and shards[a] == shard:
                keep[a:b] = box.contains(h[a:b])
        yield pa.RecordBatch.from_arrays([batch[c] for c in ("h1", "h2", "_id", "_t", "pos")], ["h1", "h2", "_id", "_t", "pos"]).filter(pa.array(keep))


def split_lines(docs: DataFrame) -> DataFrame:
    """(_id, _t, pos, key) of every line; key is null where it is shorter than one code point."""
    line = F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n"))
    rows = docs.select(*[c.alias(k) for k, c in row_key().items()], line.alias("pos", "line"))
    return rows.select("_id", "_t", "pos", ascii_lower(F.btrim("line", F.lit(BLANKS))).alias("key"))


class LineLedger:
    """Counts and filters of all lines inserted so far, in folders below ``root``."""

    def __init__(self, spark: SparkSession, root: str, min_docs: int = 10, min_chars: int = 1, shards: int | None = None):
        self.spark, self.root, self.min_docs, self.min_chars = spark, root, min_docs, min_chars
        self.shards = shards or 4 * width(spark)
        self.version = 0

    def _read(self, name: str, schema: str) -> DataFrame:
        if self.version == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/v{self.version}/{name}")

    def refs(self) -> DataFrame:
        return self._read("refs", REFS)

    def filters(self) -> DataFrame:
        return self._read("filters", FILTERS)

    def _hashes(self) -> list:
        h1 = F.xxhash64("key")
        return [F.pmod(h1, F.lit(self.shards)).cast("int").alias("shard"), h1.alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2")]

    def _counts(self, docs: DataFrame, sign: int) -> DataFrame:
        """Each document counts a key once; the keys of a document are made distinct in its own row."""
        keys = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.translate(F.btrim(x, F.lit(BLANKS)), UPPER, LOWER))
        rows = docs.select(F.explode(F.array_distinct(keys)).alias("key")).where(F.char_length("key") >= self.min_chars)
        return rows.select(*self._hashes()).groupBy("shard", "h1", "h2").agg((F.count(F.lit(1)) * sign).alias("d"))

    def insert(self, docs: DataFrame) -> LineLedger:
        return self._apply(docs, 1)

    def delete(self, docs: DataFrame) -> LineLedger:
        """Take the given documents (as they were inserted) out again."""
        return self._apply(docs, -1)

    def _apply(self, docs: DataFrame, sign: int) -> LineLedger:
        keys = ["shard", "h1", "h2"]
        change = self._counts(docs, sign)
        if self.version:
            change = self.refs().select(*keys, "n", F.lit(0).cast("long").alias("d")).unionByName(change.select(*keys, F.lit(0).cast("long").alias("n"), "d"))
            change = change.groupBy(*keys).agg(F.sum("n").alias("was"), F.sum("d").alias("d"))
        else:
            change = change.withColumn("was", F.lit(0).cast("long"))
        target = f"{self.root}/v{self.version + 1}"
        change.withColumn("n", F.col("was") + F.col("d")).where("n > 0 OR was > 0").write.parquet(f"{target}/changed")
        change = self.spark.read.parquet(f"{target}/changed")
        change.where("n > 0").select(*REFS.replace(" int", "").replace(" long", "").split(", ")).write.parquet(f"{target}/refs")
        over = lambda c: (F.col(c) >= self.min_docs).cast("int")
        moved = change.select("shard", "h1", (over("n") - over("was")).alias("step"), over("n").alias("over")).where("step <> 0 OR over = 1").drop("over")
        new = self.filters().groupBy("shard").cogroup(moved.groupBy("shard")).applyInArrow(_update_filter, FILTERS)
        new.write.parquet(f"{target}/filters")
        self.version += 1
        return self

    def marked(self, docs: DataFrame, lanes: int = 16) -> DataFrame:
        """(_id, _t, drop): the positions of each document's lines whose key is over the threshold.

        A key can hold a large share of all lines, so lines are dealt over ``lanes`` copies of
        their shard's filter.
        """
        lines = split_lines(docs).where(F.char_length("key") >= self.min_chars)
        lane = F.pmod(F.xxhash64("_id", "_t", "pos"), F.lit(lanes)).cast("int").alias("lane")
        lines = lines.select(*self._hashes(), lane, "_id", "_t", "pos", F.lit(None).cast("binary").alias("filter"))
        no = lambda kind, *names: [F.lit(None).cast(kind).alias(x) for x in names]
        boxes = self.filters().select("shard", *no("long", "h1", "h2"), F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), *no("long", "_id", "_t"), *no("int", "pos"), "filter")
        dealt = lines.unionByName(boxes).repartition(width(self.spark), "shard", "lane").sortWithinPartitions("shard", "lane", F.col("filter").isNull())
        passed = dealt.mapInArrow(_pass_filter, "h1 long, h2 long, _id long, _t long, pos int")
        known = self.refs().where(F.col("n") >= self.min_docs).select("h1", "h2")
        return passed.join(known, ["h1", "h2"], "left_semi").groupBy("_id", "_t").agg(F.collect_set("pos").alias("drop"))


def new_ledger(spark: SparkSession, **options) -> LineLedger:
    ensure_checkpoint_dir(spark)
    return LineLedger(spark, f"{spark.sparkContext.getCheckpointDir()}/lines-{uuid.uuid4().hex}", **options)


def drop_common_lines(docs: DataFrame, ledger: LineLedger) -> DataFrame:
    """Documents with ``n_lines``, ``n_dropped`` and ``kept`` (the text of the lines that stay, joined by \\n)."""
    keyed = docs.withColumns(row_key())
    joined = keyed.join(ledger.marked(docs), ["_id", "_t"], "left")
    drop = F.coalesce("drop", F.array().cast("array<int>"))
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    stay = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(drop, i)), "\n")
    return joined.withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.size(drop).cast("long"),
        "kept": F.when(F.col("drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(stay),
    }).drop("_id", "_t", "drop")


SQL = f"""
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM cut
), keyed AS (
  SELECT *, translate(trim(line, {SQL_BLANKS}), '{UPPER}', '{LOWER}') AS k FROM lines
), hot AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
), told AS (
  SELECT *, k IN (SELECT k FROM hot) AS gone FROM keyed
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM told GROUP BY r
"""


@query("op2_line_ledger", SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ledger = new_ledger(spark).insert(docs)
    out = drop_common_lines(docs, ledger)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
