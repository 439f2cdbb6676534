"""Mixing sources to target weights as a min-cost flow of words.

Documents belong to one source or several.  They are aggregated by membership pattern (the
set of their sources); a small network routes words from patterns to source quotas.  A
pattern offers its words up to ``repeats`` times at rising cost (the first copy 1, the second
2, ...), so that the optimum spends fresh words first and repetition evenly.  Successive shortest
paths solve it on totals only: its size follows the number of patterns, never of documents.
The words routed for each (pattern, source) become whole copies of all its documents plus one more copy of some; those are
selected in the order of a seeded hash, by bucket totals, until the quota is met.

Defined cases: a null text has size 0; a null source is a source of its own and comes last; a
source without words gets target 0; repeated rows are selected as one document, each with
its own copies; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import BLANK_RE, row_key, table, width
from cytoframe.session import cut

REPEATS = 3
BUCKETS = 1024
ROUNDS = 4


def word_count(text: str) -> Column:
    parts = F.split(F.coalesce(F.col(text), F.lit("")), BLANK_RE)
    return (F.size(parts) - F.when(F.element_at(parts, 1) == "", 1).otherwise(0) - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)).cast("long")


def water_fill(sizes: list[int], weights: list[int], repeats: int = REPEATS) -> list[float]:
    """Shares of the total by weight; a share stops at ``repeats`` times its size, the excess goes to the others."""
    caps = [repeats * s for s in sizes]
    left, open_weight, level = Fraction(sum(sizes)), sum(weights), Fraction(0)
    out = [Fraction(0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: Fraction(caps[i], weights[i])):
        level = left / open_weight
        out[i] = min(Fraction(caps[i]), level * weights[i])
        left -= out[i]
        open_weight -= weights[i]
    return [float(x) for x in out]


def route(supply: dict[str, int], members: dict[str, list[int]], demand: list[int], repeats: int = REPEATS) -> dict[tuple[str, int], int]:
    """Words from each pattern to each source, at least cost; copy number c of a pattern's words costs c.

    Successive shortest augmenting paths with potentials over patterns x sources.
    """
    names = sorted(supply)
    n, m = len(names), len(demand)
    start, end = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    to, room, cost = [], [], []

    def arc(a: int, b: int, capacity: int, price: int) -> None:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y), room.append(c), cost.append(p)

    for i, name in enumerate(names):
        for copy in range(1, repeats + 1):
            arc(start, i, supply[name], copy)
    carry = {}
    for i, name in enumerate(names):
        for s in members[name]:
            carry[name, s] = len(to)
            arc(i, n + s, repeats * supply[name], 0)
    for s in range(m):
        arc(n + s, end, demand[s], 0)
    potential = [0] * len(graph)
    while True:
        far, via = [None] * len(graph), [-1] * len(graph)
        far[start], queue = 0, [(0, start)]
        while queue:
            d, x = heapq.heappop(queue)
            if d > far[x]:
                continue
            for e in graph[x]:
                if room[e] > 0:
                    reach = d + cost[e] + potential[x] - potential[to[e]]
                    if far[to[e]] is None or reach < far[to[e]]:
                        far[to[e]], via[to[e]] = reach, e
                        heapq.heappush(queue, (reach, to[e]))
        if far[end] is None:
            return {key: room[e + 1] for key, e in carry.items() if room[e + 1] > 0}
        for x, d in enumerate(far):
            if d is not None:
                potential[x] += d
        amount, x = None, end
        while x != start:
            amount = room[via[x]] if amount is None else min(amount, room[via[x]])
            x = to[via[x] ^ 1]
        x = end
        while x != start:
            room[via[x]] -= amount
            room[via[x] ^ 1] += amount
            x = to[via[x] ^ 1]


def _select(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """``extra`` (0 or 1) per row: seeded documents of each pattern whose sizes come near ``want``.

    Documents are taken in hash order while they fit; those that did not fit make way for
    later ones that do, in a few rounds, and at last the smallest one left goes in if the sum comes
    nearer so: what is missed or exceeded is at most half a document.  Sums over hash buckets find the one bucket of each
    pattern in which the quota runs out; buckets before it are taken whole, and only its rows are sorted.
    """
    buckets = max(BUCKETS, 16 * width(rows.sparkSession))
    rows = rows.withColumns({"b": F.pmod("u", F.lit(buckets)), "extra": F.lit(0)})
    columns = rows.columns
    ahead = Window.partitionBy("pattern").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("pattern").orderBy("u", "_id", "_t", "size").rowsBetween(Window.unboundedPreceding, 0)
    for _ in range(ROUNDS):
        got = rows.groupBy("pattern").agg(F.sum(F.col("size") * F.col("extra")).alias("got"))
        left = cut(quotas.join(got, "pattern").select("pattern", (F.col("want") - F.col("got")).alias("left")))
        fits = rows.join(left, "pattern").where("extra = 0 AND size > 0 AND size <= left")
        totals = fits.groupBy("pattern", "b").agg(F.sum("size").alias("t"))
        totals = totals.withColumn("before", F.coalesce(F.sum("t").over(ahead), F.lit(0))).join(left, "pattern")
        ends = totals.where("before + t > left").groupBy("pattern").agg(F.min_by(F.struct("b", "before"), "b").alias("end"))
        ends = cut(left.join(ends, "pattern", "left").select("pattern", "left", F.coalesce("end.b", F.lit(buckets)).alias("end"), "end.before"))
        told = rows.join(ends, "pattern").withColumn("open", F.expr("extra = 0 AND size > 0 AND size <= left"))
        at_end = told.where("open AND b = end").withColumn("upto", F.col("before") + F.sum("size").over(inside))
        rest = told.where("NOT open OR b <> end").withColumn("extra", F.when(F.col("open") & (F.col("b") < F.col("end")), 1).otherwise(F.col("extra")))
        rows = cut(rest.select(columns).union(at_end.withColumn("extra", (F.col("upto") <= F.col("left")).cast("int")).select(columns)))
    # what no document fits into any more is rounded: the smallest one left goes in if that comes nearer
    got = rows.groupBy("pattern").agg(F.sum(F.col("size") * F.col("extra")).alias("got"))
    left = quotas.join(got, "pattern").select("pattern", (F.col("want") - F.col("got")).alias("left"))
    same = rows.where("extra = 0 AND size > 0").groupBy("pattern", "size", "_id", "_t").agg(F.sum("size").alias("all"))
    near = same.join(left, "pattern").where("all > left AND all < 2 * left").groupBy("pattern").agg(F.min(F.struct("all", "size", "_id", "_t")).alias("at"))
    near = near.select("pattern", "at.size", "at._id", "at._t", F.lit(1).alias("more"))
    return rows.join(near, ["pattern", "size", "_id", "_t"], "left").withColumn("extra", F.coalesce("more", "extra")).select(columns)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = REPEATS, seed: int = 7) -> DataFrame:
    """(doc_id, _id, _t, sources, size, source_size, target, taken) for every row of ``docs`` (doc_id, text, source).

    ``source`` may be a string (one source) or an array of strings (several).
    """
    spark = docs.sparkSession
    several = dict(docs.dtypes)["source"].startswith("array")
    listed = F.array_sort(F.array_distinct("source")) if several else F.array("source")
    rows = docs.select("doc_id", *[c.alias(k) for k, c in row_key().items()], listed.alias("sources"), word_count("text").alias("size"))
    rows = cut(rows.withColumn("pattern", F.to_json(F.struct("sources"))).withColumn("u", F.xxhash64(F.lit(seed), F.col("_id"), F.col("_t"))))
    # one row per pattern; the number of patterns follows the catalogue of sources
    totals = [(r["pattern"], list(r["sources"] or []), int(r["size"])) for r in rows.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("size")).collect()]
    sources = sorted({s for _, listed, _ in totals for s in listed}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(sources)}
    sizes = [0] * len(sources)
    for _, listed, size in totals:
        for s in listed:
            sizes[place[s]] += size
    total = sum(size for _, _, size in totals)
    ranks = [weights[i % len(weights)] for i in range(len(sources))]
    targets = water_fill(sizes, ranks, repeats) if not several else _overlapping(sizes, ranks, total, repeats)
    flow = route({p: size for p, _, size in totals}, {p: [place[s] for s in listed] for p, listed, _ in totals}, [int(round(t)) for t in targets], repeats)
    words: dict[str, int] = {}
    for (p, _), v in flow.items():
        words[p] = words.get(p, 0) + v
    quotas = []
    for p, listed, size in totals:
        whole = min(repeats, words.get(p, 0) // size) if size else 0
        first = place[listed[0]] if listed else None
        quotas.append((p, whole, words.get(p, 0) - whole * size, sizes[first] if listed else 0, targets[first] if listed else 0.0))
    plan = spark.createDataFrame(quotas, "pattern string, whole long, want long, source_size long, target double")
    chosen = _select(rows, plan.select("pattern", "want"))
    out = chosen.join(plan, "pattern")
    return out.select("doc_id", "_id", "_t", "sources", "size", "source_size", "target", ((F.col("whole") + F.col("extra")) * F.col("size")).alias("taken"))


def _overlapping(sizes: list[int], weights: list[int], total: int, repeats: int) -> list[float]:
    """Targets where sources share documents: the words of all documents, by weight, under each source's cap."""
    if not sum(sizes):
        return [0.0] * len(sizes)
    shares = water_fill(sizes, weights, repeats)
    return [x * total / sum(sizes) for x in shares]


@query("op8_mix_flow")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
