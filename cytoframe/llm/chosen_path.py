"""Near-duplicate classes by a chosen-path similarity join on shingle sets.

Every document becomes the set of its distinct k-word shingles (64-bit hashes) and a
signature of ``POSITIONS`` minwise tokens.  Documents with equal sets are one node of the
join from the start, so copies are never compared.

1. *Trees.*  Each of ``trees`` independent trees branches all sets by one minwise token.
2. *Stars.*  In every node one member is compared with all others: a linear number of
   pairs.  In a node of up to ``small`` members that is the smallest (in odd trees the largest), so that
   trees agree; in a larger one it is any, so that each tree tries another and a large
   group of near copies becomes one component even if many of its pairs are below the threshold.
3. *Nodes.*  A node that still holds members of different components is compared exhaustively
   if at most ``small`` members are outside the node's largest component (pairs within a component
   are left out, so their number stays linear).
4. *Branches.*  The other nodes are crowded.  Each of their members goes to ``BRANCHES`` children, by as many
   further tokens of the tree; these are nodes as in 3., and the crowded ones among them branch again while the
   tree has tokens and they hold at most ``KEPT`` of their parent.  Texts around a passage are fewer at each level, while a pair at the threshold has
   1.6 common children a level.
5. *Crowds.*  All members of the nodes that are crowded and don't branch meet in an exact join: two sets of the
   similarity share one of the n - ceil(0.8 n) + 1 first shingles of each, in any order that is the
   same for all sets.  The order puts rare shingles first (counts of the crowd in ``SLOTS`` hashed
   places), so that texts that share a passage only don't meet.  Members of different components that
   share such a shingle are a node again; a node with more than ``small`` members outside its
   largest component is compared as it is, in blocks of ``HEAP``.
   Nodes are compared in blocks, whose whole texts meet in one place.
6. A pair is dropped early only if the sizes forbid the similarity, one-bit sketches differ in
   more than ``SKETCH_GAP`` of 128 places (expected at similarity 0.8: 12.8), or (stars) fewer
   than ``ALIKE`` tokens agree; all others are confirmed on the full shingle sets of the whole texts.

A pair at the threshold shares the first token of a tree with probability 0.8, so that none of 16
trees has it in a node with probability 0.2 ** 16; whatever is in one node is compared, joined exactly or branched.
In a node that branches, a pair at the threshold meets down to the last level with probability 0.9375 or more (the
fixed point of f = 1 - (1 - 0.8 f) ** 2), so that it is lost with 0.25 ** 16 even if all its nodes are crowded.
The sketch gap of 6. (4.5 deviations) and ``ALIKE`` lose fewer than one in 10,000, of stars only for ``ALIKE``.

Defined cases: a text without words (or null) has an empty set and is linked with nothing; a
text of fewer than k words is one shingle; rows with a null doc_id get a null class, are
kept and link nobody; repeated rows share their class; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import row_key, table, width
from cytoframe.llm.tokens import mix, randoms, shingles, slices
from cytoframe.session import cut

U = np.uint64
POSITIONS = 128
SKETCH_GAP = 28
SLOTS = 1 << 18
HEAP = 512
BRANCHES = 2  # tokens, and so children, of a member of a crowded node
KEPT = 0.75  # a crowded child with a larger part of its node is near copies, which don't get fewer by branching
ALIKE = 84  # equal tokens of POSITIONS; expected at similarity 0.8: 102.4, deviation 4.5
_A = (randoms(POSITIONS, 31) | U(1))[:, None]
_B = randoms(POSITIONS, 37)[:, None]
MEMBER = ["sid", "n", "bits", "more", "comp"]
PROFILE = "doc_id long, _id long, _t long, n_shingles long, sid binary, bits long, more long, sig binary"


def _distinct_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a column."""
    for words in slices(column):
        hashes, bounds = shingles(words, k)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(hashes[a:b])


def _signature(s: np.ndarray) -> np.ndarray:
    low = np.full(POSITIONS, np.iinfo(np.uint64).max, U)
    for at in range(0, len(s), 65536):
        np.minimum(low, ((s[at : at + 65536] ^ (s[at : at + 65536] >> U(29))) * _A + _B).min(axis=1), out=low)
    return mix(low)


def profile(docs: DataFrame, k: int) -> DataFrame:
    """One row per document: set size, 128-bit name of the set, one-bit sketch and minwise signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = U(1) << np.arange(64, dtype=U)
        for batch in batches:
            size, sid, bits, more, sig = [], [], [], [], []
            for s in _distinct_sets(batch["text"], k):
                size.append(len(s))
                sid.append(np.array([mix(s).sum(dtype=U), mix(s ^ U(0x5BD1E995)).sum(dtype=U)], dtype=U).tobytes())
                tokens = _signature(s)
                bits.append(int(((tokens[:64] & U(1)) * places).sum(dtype=U).view(np.int64)))
                more.append(int(((tokens[64:] & U(1)) * places).sum(dtype=U).view(np.int64)))
                sig.append((tokens >> U(32)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["_id"], batch["_t"], pa.array(size, pa.int64()), pa.array(sid, pa.binary()), pa.array(bits, pa.int64()), pa.array(more, pa.int64()), pa.array(sig, pa.binary())],
                [x.split()[0] for x in PROFILE.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(n) for n, c in row_key().items()], "text").mapInArrow(run, PROFILE)


def sift(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``ALIKE`` tokens or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(-1, POSITIONS) for c in ("sig_a", "sig_b"))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array((one == two).sum(axis=1) >= ALIKE))

    named = pairs.join(sets.select(F.col("sid").alias("a"), F.col("sig").alias("sig_a")), "a").join(sets.select(F.col("sid").alias("b"), F.col("sig").alias("sig_b")), "b")
    return named.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a binary, b binary")


def texts_of(named: DataFrame, texts: DataFrame) -> DataFrame:
    """``named`` (with ``_id`` and ``_t``) with its text, once however often ``texts`` repeats the row."""
    wanted = texts.join(named.select("_id", "_t").distinct(), ["_id", "_t"], "left_semi")
    return named.join(wanted.dropDuplicates(["_id", "_t"]), ["_id", "_t"])


def confirm(pairs: DataFrame, texts: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                keep = []
                for one, two in zip(_distinct_sets(batch["text_a"], k), _distinct_sets(batch["text_b"], k), strict=True):
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    keep.append(100 * both >= percent * (len(one) + len(two) - both))
                yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    places = sets.select("sid", "_id", "_t")
    named = pairs.join(places.select(F.col("sid").alias("b"), "_id", "_t"), "b")
    named = texts_of(named, texts).select("a", "b", F.col("text").alias("text_b"))
    named = named.join(places.select(F.col("sid").alias("a"), "_id", "_t"), "a")
    named = texts_of(named, texts).select("a", "b", F.col("text").alias("text_a"), "text_b")
    return named.mapInArrow(run, "a binary, b binary").distinct()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that come sorted by ``g``, as tables of whole blocks with the blocks' bounds."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        g = rows["g"].to_numpy()
        edges = np.flatnonzero(np.diff(g)) + 1
        if len(edges):
            yield rows.slice(0, edges[-1]), np.concatenate([[0], edges])
            rest = rows.slice(edges[-1])
        else:
            rest = rows
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)


def _may_link(percent: int):
    """Keep the members of a block that have a possible partner of another component.

    A block is renamed after the members it keeps, as trees often meet the same group again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in _blocks(batches):
            n, bits, more = (rows[c].to_numpy() for c in ("n", "bits", "more"))
            bits, more, comp = bits.view(U), more.view(U), _codes(rows["comp"])
            keep, names = np.zeros(rows.num_rows, bool), np.zeros(rows.num_rows, np.int64)
            sids = np.frombuffer(b"".join(rows["sid"].to_pylist()), U).reshape(-1, 2)
            sids = mix(sids[:, 0] ^ mix(sids[:, 1]))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                m, x, y, c = n[a:b], bits[a:b], more[a:b], comp[a:b]
                gap = np.bitwise_count(x[:, None] ^ x).astype(np.int16) + np.bitwise_count(y[:, None] ^ y)
                may = (gap <= SKETCH_GAP) & (c[:, None] != c) & (100 * np.minimum(m[:, None], m) >= percent * np.maximum(m[:, None], m))
                keep[a:b] = may.any(axis=1)
                names[a:b] = mix(sids[a:b][keep[a:b]].sum(dtype=U, keepdims=True)).view(np.int64)[0]
            named = pa.table({"g": names, "sid": rows["sid"], "comp": rows["comp"]})
            yield from named.filter(pa.array(keep)).to_batches()

    return run


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over the shingles that two sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    twice = count[column] > 1
    owner, column = owner[twice], place[column[twice]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
        a, b = np.searchsorted(column, [low, low + 8192])
        block = np.zeros((len(sets), 8192), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        total += block @ block.T
    return np.rint(total).astype(np.int64)


def _link(k: int, percent: int):
    """Links of a block between components, confirmed on full sets; enough of them to span what they connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in _blocks(batches):
            comp, sids, one, two = _codes(rows["comp"]), rows["sid"].combine_chunks(), [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                sets = list(_distinct_sets(rows["text"].slice(a, b - a), k))
                size = np.array([len(s) for s in sets])
                both = _shared_counts(sets)
                linked = 100 * both >= percent * (size[:, None] + size - both)
                root = {c: c for c in comp[a:b].tolist()}

                def find(c: int) -> int:
                    while root[c] != c:  # noqa: B023
                        c = root[c]  # noqa: B023
                    return c

                for i, j in np.argwhere(np.triu(linked, 1) & (comp[a:b, None] != comp[a:b])):
                    x, y = find(int(comp[a + i])), find(int(comp[a + j]))
                    if x != y:
                        root[x] = y
                        one.append(a + i)
                        two.append(a + j)
            yield pa.RecordBatch.from_arrays([sids.take(pa.array(one, pa.int64())), sids.take(pa.array(two, pa.int64()))], ["a", "b"])

    return run


def compare_nodes(leaf: DataFrame, texts: DataFrame, sets: DataFrame, k: int, percent: int, small: int) -> DataFrame:
    """Links (a, b) between the components of each node; leaf: node, sid, n, bits, more, comp, main, size, outside.

    The members outside the main component meet every block of the main one; where they are
    too many for one block, all blocks meet one another.
    """
    blocks = F.when(F.col("outside") <= small, F.ceil((F.col("size") - F.col("outside")) / small)).otherwise(F.ceil(F.col("size") / HEAP))
    mine = F.pmod(F.xxhash64("sid"), blocks)
    every = F.sequence(F.lit(0).cast("long"), blocks - 1)
    met = F.when(F.col("outside") > small, F.transform(every, lambda x: F.xxhash64("node", F.least(x, mine), F.greatest(x, mine))))
    met = met.when(F.col("comp") != F.col("main"), F.transform(every, lambda x: F.xxhash64("node", x))).otherwise(F.array(F.xxhash64("node", mine)))
    dealt = leaf.select(F.explode(met).alias("g"), "sid", "n", "bits", "more", "comp")
    n = width(leaf.sparkSession)
    able = dealt.repartition(n, "g").sortWithinPartitions("g").mapInArrow(_may_link(percent), "g long, sid binary, comp binary")
    able = cut(able.distinct())
    named = texts_of(able.join(sets.select("sid", "_id", "_t"), "sid"), texts).select("g", "sid", "comp", "text")
    return named.repartition(n, "g").sortWithinPartitions("g", "sid").mapInArrow(_link(k, percent), "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(sid, comp) for every end of a link, by alternating large-star and small-star rounds."""

    def star(both: DataFrame) -> DataFrame:
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return both.join(low, "u")

    edges = cut(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = edges.union(edges.select("v", "u"))
        large = star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = star(down)
        edges = cut(small.select(F.col("v").alias("u"), "m").union(small.select("u", "m")).where("u <> m").select("u", F.col("m").alias("v")).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    own = edges.select(F.col("v").alias("sid"), F.col("v").alias("comp")).distinct()
    return cut(edges.select(F.col("u").alias("sid"), F.col("v").alias("comp")).union(own))


def _near(a: str, b: str, percent: int) -> Column:
    sizes = 100 * F.least(f"{a}n", f"{b}n") >= percent * F.greatest(f"{a}n", f"{b}n")
    gap = sum((F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in ("bits", "more")), F.lit(0))
    return sizes & (gap <= SKETCH_GAP)


def _token(at: Column, of: str = "sig", tokens: int = 1) -> Column:
    return F.call_function("substring", F.col(of), at * 4 + 1, F.lit(4 * tokens))


def _crowds(level: DataFrame) -> DataFrame:
    """The members of nodes that hold more than one component, with the node's largest one, size and rest."""
    shares = level.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("c"))
    crowd = shares.groupBy("node").agg(F.sum("c").alias("size"), (F.sum("c") - F.max("c")).alias("outside"), F.max_by("comp", F.struct("c", "comp")).alias("main")).where("outside > 0")
    return level.join(crowd, "node")


def _parted(level: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """The nodes that can be compared as they are, and the crowded ones."""
    return level.where(F.col("outside") <= small).select("node", *MEMBER, "main", "size", "outside"), level.where(F.col("outside") > small)


def branch(crowd: DataFrame, at: int) -> DataFrame:
    """The members of crowded nodes (with ``path``, the tokens of their tree) in the children by the tokens from ``at`` on."""
    nodes = [F.xxhash64("node", F.lit(i), _token(F.lit(i), "path")) for i in range(at, at + BRANCHES)]
    return crowd.select(F.explode(F.array(*nodes)).alias("node"), "path", *MEMBER, F.col("size").alias("was"))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U(46)).astype(np.int64)  # the upper bits of 64, SLOTS values


def rare_nodes(members: DataFrame, k: int, percent: int) -> DataFrame:
    """One node per shingle for the members (sid, n, bits, more, comp, text) that have it among their first ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for s in _distinct_sets(batch["text"], k):
                np.add.at(total, _slot(mix(s)), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["slot", "c"])

    counts = members.select("text").mapInArrow(count, "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).toPandas()
    often = np.zeros(SLOTS, np.int64)
    often[counts["slot"].to_numpy(np.int64)] = counts["c"].to_numpy(np.int64)
    sent = members.sparkSession.sparkContext.broadcast(often)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = sent.value
        for batch in batches:
            nodes, owner = [], []
            for i, s in enumerate(_distinct_sets(batch["text"], k)):
                names = mix(s)
                n = len(s) + (-percent * len(s)) // 100 + 1  # all but as many as a partner must share, and one
                nodes.append(names[np.lexsort((names, often[_slot(names)]))[:n]].view(np.int64))
                owner.append(np.full(len(nodes[-1]), i))
            at = pa.array(np.concatenate(owner) if owner else np.zeros(0, np.int64))
            names = pa.array(np.concatenate(nodes) if nodes else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([names, *(batch[c].take(at) for c in MEMBER)], ["node", *MEMBER])

    return members.mapInArrow(first, "node long, sid binary, n long, bits long, more long, comp binary")


def similar_classes(docs: DataFrame, k: int = 5, percent: int = 80, trees: int = 16, small: int = 64) -> DataFrame:
    """(doc_id, _id, _t, n_shingles, comp, component_id) for every row of ``docs`` (doc_id, text).

    ``comp`` names the class; ``component_id`` is its smallest doc_id, which two classes have in
    common if the doc_id occurs with different texts.
    """
    rows = cut(profile(docs, k))
    texts = docs.select(*[c.alias(n) for n, c in row_key().items()], "text")
    named = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = cut(named.groupBy("sid").agg(F.min(F.struct("doc_id", "_id", "_t")).alias("at"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits"), F.first("more").alias("more"), F.first("sig").alias("sig")).select("sid", "at.*", "n", "bits", "more", "sig"))

    member = F.struct("sid", "n", "bits", "more")
    starts = [t * POSITIONS // trees for t in range(trees)]
    roots = F.array(*[F.struct((F.xxhash64(F.lit(t), _token(F.lit(start))).bitwiseAND(F.lit(-2)) + (t % 2)).alias("node"), F.lit(start).alias("start"), member.alias("m")) for t, start in enumerate(starts)])
    level = sets.select(F.explode(roots).alias("x")).select("x.*")
    crowd = level.groupBy("node").agg(F.min("m").alias("low"), F.max("m").alias("high"), F.min(F.struct(F.xxhash64("node", "m.sid").alias("order"), "m")).alias("any"), F.count(F.lit(1)).alias("size")).where("size > 1")
    centre = F.when(F.col("size") > small, F.col("any.m")).when(F.col("node") % 2 == 0, F.col("low")).otherwise(F.col("high"))
    level = cut(level.join(crowd, "node").select("node", "start", "size", centre.alias("p"), "m"))
    stars = level.where(F.col("p.sid") != F.col("m.sid")).where(_near("p.", "m.", percent))
    stars = cut(sift(stars.select(F.least("p.sid", "m.sid").alias("a"), F.greatest("p.sid", "m.sid").alias("b")).distinct(), sets))
    links = cut(confirm(stars, texts, sets, k, percent))
    comps = components(links)

    level = level.where("size > 2").select("node", "start", "m.*").join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    level = cut(_crowds(level))
    leaf, crowd = _parted(level, small)
    tokens, last = POSITIONS // trees, []
    for at in range(1, tokens - BRANCHES + 1, BRANCHES):
        if crowd.isEmpty():
            break
        if at == 1:
            crowd = crowd.join(sets.select("sid", "sig"), "sid").withColumn("path", _token(F.col("start"), tokens=tokens))
        found, crowd = _parted(cut(_crowds(branch(crowd, at))), small)
        leaf = leaf.union(found)
        last.append(crowd.where(F.col("size") > KEPT * F.col("was")).select(*MEMBER))
        crowd = crowd.where(F.col("size") <= KEPT * F.col("was")).drop("was")
    crowd = reduce(DataFrame.union, last, crowd.select(*MEMBER))
    if not crowd.isEmpty():
        crowd = crowd.distinct().join(sets.select("sid", "_id", "_t"), "sid")
        crowd = cut(texts_of(crowd, texts).select(*MEMBER, "text"))
        leaf = leaf.union(cut(_crowds(cut(rare_nodes(crowd, k, percent)))).select(leaf.columns))
    links = cut(links.union(compare_nodes(leaf, texts, sets, k, percent, small)))
    comps = components(links)

    named = sets.select("sid", "doc_id").join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    lowest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = named.join(lowest, "comp").select("sid", "comp", "component_id")
    own = rows.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "_id", "_t", "n_shingles", F.encode(F.concat_ws("|", F.lit("alone"), "_id", "_t"), "utf-8").alias("comp"), F.col("doc_id").alias("component_id"))
    linked = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").join(named, "sid").select("doc_id", "_id", "_t", "n_shingles", "comp", "component_id")
    return linked.union(own)


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each class, that of the smallest doc_id (then text hash); rows with a null doc_id stay."""
    kept = similar_classes(docs, k, percent).where("doc_id = component_id").groupBy("comp").agg(F.min(F.struct("_id", "_t")).alias("at")).select("at.*")
    mine = docs.withColumns(row_key())
    stay = mine.where("doc_id IS NOT NULL").join(kept, ["_id", "_t"], "left_semi")
    return stay.dropDuplicates(["_id", "_t"]).unionByName(mine.where("doc_id IS NULL")).drop("_id", "_t")


WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
SQL = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM w
),
g AS MATERIALIZED (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
rare AS MATERIALIZED (
  SELECT doc_id, n, x FROM (SELECT g.*, row_number() OVER (PARTITION BY doc_id ORDER BY f, x) AS r FROM g JOIN (SELECT x, count(*) AS f FROM g GROUP BY x) USING (x))
  WHERE 100 * (r - 1) <= 20 * n
),
near AS MATERIALIZED (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM rare a JOIN rare b USING (x) WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT a, b, len(p.sh) + len(q.sh) AS total, len(list_intersect(p.sh, q.sh)) AS common FROM near JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b)
  WHERE 100 * common >= 80 * (total - common)
),
edge AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS doc_id, b AS to_id FROM edge UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.to_id)
SELECT s.doc_id, len(s.sh) AS n_shingles, least(s.doc_id, min(to_id)) AS component_id, s.doc_id = least(s.doc_id, min(to_id)) AS kept
FROM s LEFT JOIN reach USING (doc_id) GROUP BY s.doc_id, s.sh
"""


@query("op10_chosen_path", SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    classes = similar_classes(table(spark, folder, "documents").select("doc_id", "text"), k=4)
    return classes.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
