"""Token ids as raw binary shards with a minimal perfect hash index for access by document key.

Writing.  Documents are range-partitioned by (doc_id, hash of the text, place in the input), so that
file order is doc_id order and one repeated key may fill many shards.  Each task encodes its
texts and Spark's text writer lays the ids down as raw little-endian integers: a row is one
document, and the line separator is the end id, so that a shard is the plain run of ids
``[document, end] [document, end] ...`` committed by Spark's own protocol, followed by a footer

    doc_id int64 x n | known uint8 x n | length uint32 x n | n uint64 | b"IDSHARD1" | one end id

Ids take two bytes where the vocabulary allows, else four.

Indexing.  Key (doc_id, copy), copy counting repeated ids from 0, is hashed to a bucket of about
``BUCKET_KEYS`` keys.  A bucket is a minimal perfect hash (levels of bit sets: a key that stands alone in its
level's slot is settled there, the others go to the next level; the slot is the rank of its bit)
over arrays of fingerprints, shards, offsets and lengths.  A lookup touches one bucket and on
average fewer than two levels, and a foreign key is refused by its 32-bit fingerprint.

Encoding.  No alternative of a byte-level pattern runs from a non-blank into a blank, from a letter into another kind of
character, from a digit into another kind, or from a mark into a digit or (but for an apostrophe) a letter.  Texts are cut
there; each different chunk is given to the tokenizer once and its ids are reused, so that the ids are those of the whole
text.  Beside characters outside ASCII, and in slices that hold an added token's text, only blanks are cut at.

The shared folder must be one that ``pyarrow.fs`` opens (a mount, HDFS, S3, GCS): executors read shards by offset.

Defined cases: a null or empty text is the end id alone; a null doc_id is a key of its own and comes last; repeated rows are documents of
their own (rows alike in id and text are interchangeable); an empty table gives an empty store; other columns are left out.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import table, width
from cytoframe.llm.tokens import _BYTES, _IS_BLANK, U, _powers, mix, randoms
from cytoframe.session import cut, ensure_checkpoint_dir

END = 0
MAGIC = b"IDSHARD1"
BUCKET_KEYS = 32_768
GAMMA = 2.0
LEVELS = 64
CACHE_CHUNKS = 1_000_000
SPAN = 1 << 20
SLICE_BYTES = 1 << 21
_SEEDS = randoms(LEVELS, 41)
#: The last two bytes of white space outside ASCII (U+0085, U+00A0, U+1680, U+2000-200A, U+2028-2029, U+202F, U+205F, U+3000).
_WIDE_BLANK = np.zeros(1 << 16, bool)
_WIDE_BLANK[[0xC285, 0xC2A0, 0x9A80, *range(0x8080, 0x808B), 0x80A8, 0x80A9, 0x80AF, 0x819F]] = True
BLANK, LETTER, DIGIT, MARK, WIDE = range(5)
_KIND = np.full(256, MARK, np.uint8)
_KIND[128:] = WIDE
_KIND[np.flatnonzero(_IS_BLANK)] = BLANK
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = LETTER
MANIFEST = "shard int, path string, docs long, ids long, first long, first_known boolean, last long, last_known boolean, last_run long"
INDEX = "bucket int, n int, sizes array<int>, bits binary, marks binary, shards binary, offsets binary, lengths binary"


def raw_slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, text offsets) of a string column, about two megabytes of text at a time; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Encoder:
    """Ids of whole texts; chunks met before are found by hash, checked byte by byte, and have their ids in one pool."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.clear()

    def clear(self) -> None:
        self.hashes, self.places = np.zeros(0, U), np.zeros(0, np.int64)
        self.ids, self.text = Pool(self.kind), Pool(np.uint8)

    def _learn(self, chunks: list[bytes], hashes: np.ndarray) -> None:
        """Append chunks that are not known."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in chunks], add_special_tokens=False)]
        place = self.text.count + np.arange(len(chunks))
        self.ids.add(np.fromiter(chain.from_iterable(got), self.kind), np.fromiter(map(len, got), np.int64, len(got)))
        self.text.add(np.frombuffer(b"".join(chunks), np.uint8), np.fromiter(map(len, chunks), np.int64, len(chunks)))
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.places = np.insert(self.hashes, at, hashes[order]), np.insert(self.places, at, place[order])

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        """Places of hashes, -1 where there is none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.places[at], -1)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and where each text's ids begin (one more entry than texts)."""
        size = len(raw)
        if size == 0:
            return np.zeros(0, self.kind), np.zeros(len(offsets), np.int64)
        starts = np.flatnonzero(self._cuts(raw, offsets)[:size])
        lengths = np.diff(np.append(starts, size))
        up, down = _powers(size + 1)
        sums = np.zeros(size + 1, U)
        np.cumsum(_BYTES[False][raw] * up[:size], out=sums[1:])
        hashes = mix((sums[starts + lengths] - sums[starts]) * down[starts])
        unique, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if self.text.count > CACHE_CHUNKS:
            self.clear()
        unseen = np.flatnonzero(self._known(unique) < 0)
        if len(unseen):
            text, first = raw.tobytes(), example[unseen]
            self._learn([text[a:b] for a, b in zip(starts[first].tolist(), (starts[first] + lengths[first]).tolist(), strict=True)], unique[unseen])
        place = self._known(unique)[inverse]
        if (self.text.sizes(place) != lengths).any() or (self.text.take(place) != raw).any():
            return self._plain(raw, offsets)
        bounds = np.concatenate([[0], np.cumsum(self.ids.sizes(place))])
        return self.ids.take(place), bounds[np.searchsorted(starts, offsets)]

    def _cuts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pre-tokens are sure to end: see ``Encoding`` above."""
        size = len(raw)
        kind = _KIND[raw]
        before, after = kind[:-1], kind[1:]
        pair = np.zeros(size, np.uint16)
        pair[1:] = (raw[:-1].astype(np.uint16) << 8) | raw[1:]
        cuts = np.zeros(size + 1, bool)
        cuts[1:size] = (after == BLANK) & (before != BLANK) & ~_WIDE_BLANK[pair[:-1]]
        if not any(t in raw.tobytes() for t in self.added):
            ascii_ = (before != WIDE) & (after != WIDE)
            cuts[1:size] |= ascii_ & (before != after) & (before != BLANK) & ~((before == MARK) & (after == LETTER) & (raw[:-1] == ord("'")))
        cuts[offsets] = True
        return cuts

    def _plain(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two different chunks have one hash: the texts of the slice are encoded as they are."""
        text = raw.tobytes()
        got = [self.tokenizer.encode(text[a:b].decode("utf-8", "replace"), add_special_tokens=False).ids for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return np.fromiter(chain.from_iterable(got), self.kind), np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64)


class Pool:
    """Runs of numbers one after the other, growing by doubling."""

    def __init__(self, kind: np.dtype | type):
        self.data, self.ends, self.count = np.zeros(1 << 20, kind), np.zeros(1 << 16, np.int64), 0

    def add(self, data: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.ends[self.count])
        while used + len(data) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        while self.count + len(sizes) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.data[used : used + len(data)] = data
        self.ends[self.count + 1 : self.count + len(sizes) + 1] = used + np.cumsum(sizes)
        self.count += len(sizes)

    def sizes(self, place: np.ndarray) -> np.ndarray:
        return self.ends[place + 1] - self.ends[place]

    def take(self, place: np.ndarray) -> np.ndarray:
        return self.data[spread(self.ends[place], self.sizes(place))]


@lru_cache(maxsize=2)
def _encoder(tokenizer_file: str) -> Encoder:
    return Encoder(tokenizer_file)


def open_file(path: str) -> pa.NativeFile:
    for a, b in (("file:///", "/"), ("file:/", "/"), ("s3a://", "s3://")):
        if path.startswith(a):
            path = b + path[len(a) :]
            break
    if path.startswith("/"):
        return fs.LocalFileSystem().open_input_file(path)
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def read_footer(path: str, size: int, item: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, known flags and lengths of a shard's documents."""
    with open_file(path) as f:
        tail = f.read_at(16, size - 16 - item)
        assert tail[8:] == MAGIC, f"{path} is no id shard"
        n = int(np.frombuffer(tail[:8], "<u8")[0])
        body = f.read_at(13 * n, size - 16 - item - 13 * n)
    return np.frombuffer(body, "<i8", n), np.frombuffer(body, np.uint8, n, 8 * n) > 0, np.frombuffer(body, "<u4", n, 9 * n)


class Levels:
    """A minimal perfect hash: bit sets of falling size; a key's slot is the rank of its bit."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits  # bits: one bool for each place of all levels, in turn
        self.bases = np.cumsum(sizes) - sizes
        self.ranks = np.cumsum(bits) - bits

    @staticmethod
    def _places(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(mix(h1 + _SEEDS[level]) ^ h2) % U(size)).astype(np.int64)

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> Levels:
        sizes, bits = [], []
        while len(h1):
            if len(sizes) == LEVELS:
                raise ValueError("two keys share both of their hashes")
            size = int(GAMMA * len(h1)) + 8
            place = cls._places(h1, h2, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = ~alone[place]
            h1, h2 = h1[left], h2[left]
        return cls(np.array(sizes, np.int64), np.concatenate([*bits, np.zeros(0, bool)]))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Each key's slot; -1 for a key that no level knows."""
        out, left = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, (size, base) in enumerate(zip(self.sizes.tolist(), self.bases.tolist(), strict=True)):
            place = base + self._places(h1[left], h2[left], level, size)
            hit = self.bits[place]
            out[left[hit]] = self.ranks[place[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out


def _mark(h2: np.ndarray) -> np.ndarray:
    return (mix(h2) >> U(32)).astype("<u4")


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(U)


def _build(entries: pa.Table) -> pa.Table:
    h1, h2 = _unsigned(entries["h1"]), _unsigned(entries["h2"])
    levels = Levels.of(h1, h2)
    order = np.empty(len(h1), np.int64)
    order[levels.slots(h1, h2)] = np.arange(len(h1))
    column = lambda name, kind: [entries[name].to_numpy()[order].astype(kind).tobytes()]
    return pa.table({
        "bucket": pa.array(entries["bucket"].to_numpy()[:1], pa.int32()), "n": pa.array([len(h1)], pa.int32()), "sizes": pa.array([levels.sizes.tolist()], pa.list_(pa.int32())),
        "bits": pa.array([np.packbits(levels.bits).tobytes()]), "marks": pa.array([_mark(h2)[order].tobytes()]),
        "shards": pa.array(column("shard", "<i4")), "offsets": pa.array(column("at", "<i8")), "lengths": pa.array(column("n", "<u4")),
    })


def _find(keys: pa.Table, index: pa.Table) -> pa.Table:
    columns = {"doc_id": keys["doc_id"], "copy": keys["copy"]}
    if not keys.num_rows or not index.num_rows:
        none = keys.slice(0, 0)
        return pa.table({"doc_id": none["doc_id"], "copy": none["copy"], "shard": pa.array([], pa.int32()), "at": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    row = index.slice(0, 1).to_pylist()[0]
    sizes = np.array(row["sizes"], np.int64)
    levels = Levels(sizes, np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum())).astype(bool))
    h1, h2 = _unsigned(keys["h1"]), _unsigned(keys["h2"])
    slot = levels.slots(h1, h2)
    found = (slot >= 0) & (np.frombuffer(row["marks"], "<u4")[slot] == _mark(h2))
    take = lambda name, kind: np.frombuffer(row[name], kind)[slot[found]]
    kept = pa.table(columns).filter(pa.array(found))
    return kept.append_column("shard", pa.array(take("shards", "<i4"), pa.int32())).append_column("at", pa.array(take("offsets", "<i8"), pa.int64())).append_column("n", pa.array(take("lengths", "<u4").astype(np.int64)))


class TokenStore:
    """Shards of ids below ``root`` with their manifest and index."""

    def __init__(self, spark: SparkSession, root: str, tokenizer_file: str):
        self.spark, self.root, self.tokenizer_file = spark, root, tokenizer_file
        self.item = _encoder(tokenizer_file).kind.itemsize

    def write(self, docs: DataFrame, shards: int | None = None) -> TokenStore:
        """Encode all documents and write shards, manifest and index."""
        order = [F.col("doc_id").asc_nulls_last(), "_t", "_place"]
        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_t"), F.monotonically_increasing_id().alias("_place"))
        rows = rows.repartitionByRange(shards or width(self.spark), *order).sortWithinPartitions(*order)
        file, item = self.tokenizer_file, self.item

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder, ids, lengths = _encoder(file), [], []
            for batch in batches:
                ids.append(batch["doc_id"])
                for raw, offsets in raw_slices(batch["text"]):
                    got, bounds = encoder.encode(raw, offsets)
                    lengths.append(np.diff(bounds) + 1)
                    value = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((bounds * item).astype(np.int32)), pa.py_buffer(got.tobytes())])
                    yield pa.RecordBatch.from_arrays([value], ["value"])
            if lengths:
                keys, sizes = pa.chunked_array(ids).combine_chunks(), np.concatenate(lengths)
                parts = keys.fill_null(0).to_numpy().astype("<i8"), keys.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8), sizes.astype("<u4"), np.array([len(sizes)], "<u8")
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(p.tobytes() for p in parts) + MAGIC])], ["value"])

        out = rows.select("doc_id", "text").mapInArrow(encode, "value binary")
        out.select(F.col("value").cast("string").alias("value")).write.option("lineSep", chr(END) * item).text(f"{self.root}/ids")
        self._list()
        self._index()
        return self

    def _list(self) -> None:
        """The manifest: one row a shard, with the place of its first id and the copies of its first key in shards before."""
        item = self.item

        def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for path, size in zip(batch["path"].to_pylist(), batch["length"].to_pylist(), strict=True):
                    ids, known, lengths = read_footer(path, size, item)
                    changed = np.flatnonzero((ids != ids[-1]) | (known != known[-1]))
                    run = len(ids) - 1 - (changed[-1] if len(changed) else -1)
                    row = {"shard": int(path.rsplit("/part-", 1)[1].split("-")[0]), "path": path, "docs": len(ids), "ids": int(lengths.sum()), "first": int(ids[0]), "first_known": bool(known[0]), "last": int(ids[-1]), "last_known": bool(known[-1]), "last_run": int(run)}
                    yield pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()), ("first", pa.int64()), ("first_known", pa.bool_()), ("last", pa.int64()), ("last_known", pa.bool_()), ("last_run", pa.int64())])
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{self.root}/ids").select("path", "length").where("length > 0")
        rows = files.repartition(width(self.spark)).mapInArrow(tell, MANIFEST)
        # a window without a key: it has one row a shard, the number of which is a parameter
        w = Window.orderBy("shard")
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumns({"base": F.coalesce(F.sum("ids").over(before), F.lit(0)), "_docs": F.coalesce(F.sum("docs").over(before), F.lit(0)), "_goes_on": F.coalesce((F.lag("last").over(w) == F.col("first")) & (F.lag("last_known").over(w) == F.col("first_known")), F.lit(False))})
        begun = F.when(~F.col("_goes_on") | (F.col("last_run") < F.col("docs")), F.col("_docs") + F.col("docs") - F.col("last_run"))
        rows = rows.withColumn("_begun", begun)
        rows = rows.withColumn("carry", F.when(F.col("_goes_on"), F.col("_docs") - F.last("_begun", ignorenulls=True).over(before)).otherwise(F.lit(0)))
        rows.select("shard", "path", "docs", "ids", "base", "carry", "first", "first_known").write.parquet(f"{self.root}/manifest")

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/manifest")

    def entries(self) -> DataFrame:
        """(doc_id, copy, shard, at, n) of every document, from the footers."""
        item = self.item

        def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    ids, known, lengths = read_footer(row["path"], row["length"], item)
                    new = np.ones(len(ids), bool)
                    new[1:] = (ids[1:] != ids[:-1]) | (known[1:] != known[:-1])
                    first = np.flatnonzero(new)
                    copy = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
                    if ids[0] == row["first"] and known[0] == row["first_known"]:
                        copy[: (first[1] if len(first) > 1 else len(ids))] += row["carry"]
                    sizes = lengths.astype(np.int64)
                    columns = [pa.array(ids, mask=~known), pa.array(copy), pa.array(np.full(len(ids), row["shard"], np.int32)), pa.array(np.cumsum(sizes) - sizes), pa.array(sizes)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "shard", "at", "n"])

        rows = self.manifest().withColumn("length", (F.col("ids") * item + F.col("docs") * 13 + 16 + item))
        rows = rows.select("path", "length", "shard", "carry", "first", "first_known").repartition(width(self.spark))
        return rows.mapInArrow(tell, "doc_id long, copy long, shard int, at long, n long")

    def _hashes(self, buckets: int) -> dict[str, Column]:
        h1 = F.xxhash64("doc_id", F.col("doc_id").isNull(), "copy")
        return {"h1": h1, "h2": F.xxhash64(F.lit(1), "doc_id", "copy", F.col("doc_id").isNull()), "bucket": F.pmod(h1, F.lit(buckets)).cast("int")}

    def _index(self) -> None:
        docs = self.manifest().agg(F.sum("docs").alias("n")).first().n or 0
        self.buckets = max(width(self.spark), -(-docs // BUCKET_KEYS))
        entries = self.entries().withColumns(self._hashes(self.buckets)).select("bucket", "h1", "h2", "shard", "at", "n")
        entries.groupBy("bucket").applyInArrow(_build, INDEX).write.parquet(f"{self.root}/index")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Where the documents of ``keys`` (doc_id, and how many ``copies`` of it are asked for; 1 if there is no such column) lie:
        (doc_id, copy, shard, at, n).  Keys that the store doesn't hold give no row; repeated keys give one."""
        copies = F.max("copies") if "copies" in keys.columns else F.lit(1)
        asked = keys.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(copies.alias("copies")).where("copies > 0")
        asked = asked.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("copies") - 1).cast("long"))).alias("copy")).withColumns(self._hashes(self.buckets))
        index = self.spark.read.schema(INDEX).parquet(f"{self.root}/index")
        return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(_find, "doc_id long, copy long, shard int, at long, n long")

    def read(self, found: DataFrame, make: Callable[[np.ndarray], object], column: str, kind: str) -> DataFrame:
        """Read the ids of ``found`` rows (of ``lookup``) from the shards: doc_id, copy, start, n_tokens and ``column``, which ``make`` gets from the ids.

        Rows are dealt by pieces of shards, so that neighbours are read at once and no shard is read by one task alone.
        """
        item, ids = self.item, np.dtype(f"<u{self.item}")
        rows = found.join(self.manifest().select("shard", "path", "base"), "shard")
        rows = rows.repartition(width(self.spark), "shard", F.floor(F.col("at") / SPAN)).sortWithinPartitions("shard", "at")

        def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            path, file = None, None
            for batch in batches:
                paths, at, n = batch["path"].to_pylist(), batch["at"].to_numpy(), batch["n"].to_numpy()
                values, k = [], 0
                while k < len(paths):
                    if paths[k] != path:
                        if file is not None:
                            file.close()
                        path, file = paths[k], open_file(paths[k])
                    to = k + 1
                    while to < len(paths) and paths[to] == path and at[to] == at[to - 1] + n[to - 1] and at[to] + n[to] - at[k] <= SPAN:
                        to += 1
                    raw = np.frombuffer(file.read_at(int(at[to - 1] + n[to - 1] - at[k]) * item, int(at[k]) * item), ids)
                    values.extend(make(raw[at[j] - at[k] : at[j] - at[k] + n[j]]) for j in range(k, to))
                    k = to
                columns = [batch["doc_id"], batch["copy"], pa.array(batch["base"].to_numpy() + at), batch["n"], pa.array(values, arrow)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "start", "n_tokens", column])
            if file is not None:
                file.close()

        arrow = {"long": pa.int64(), "array<int>": pa.list_(pa.int32())}[kind]
        return rows.select("doc_id", "copy", "path", "at", "n", "base").mapInArrow(get, f"doc_id long, copy long, start long, n_tokens long, {column} {kind}")

    def ids(self, keys: DataFrame) -> DataFrame:
        """The ids of the documents of ``keys``, as an array with the end id."""
        return self.read(cut(self.lookup(keys)), lambda x: x.astype(np.int32), "ids", "array<int>")

    def checksums(self, keys: DataFrame) -> DataFrame:
        """The CRC-32 of the ids of the documents of ``keys`` as little-endian 32-bit integers."""
        return self.read(cut(self.lookup(keys)), lambda x: zlib.crc32(x.astype("<u4").tobytes()), "ids_crc32", "long")


def new_store(spark: SparkSession, tokenizer_file: str) -> TokenStore:
    ensure_checkpoint_dir(spark)
    return TokenStore(spark, f"{spark.sparkContext.getCheckpointDir()}/ids-{uuid.uuid4().hex}", tokenizer_file)


@query("op11_perfect_hash_store")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    store = new_store(spark, public_tokenizers.path("byte_bpe_50k.json")).write(docs)
    keys = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"))
    return store.checksums(keys).select("doc_id", "start", "n_tokens", "ids_crc32")
