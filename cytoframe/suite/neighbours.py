"""Neighbour, graph and clustering queries over the embedding vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.adapters import with_ctes
from cytoframe.operators import graph
from cytoframe.session import cut
from cytoframe.suite import query

KNN = (
    "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
    "p AS (SELECT a.vec_id AS obs_id, b.vec_id AS neighbour_id, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id)",
    "r AS (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY dist, neighbour_id) AS rank FROM p)",
)


@query("j14_nearest_neighbours", with_ctes(*KNN, "SELECT obs_id, neighbour_id, round(dist, 6) AS dist, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10"))
def neighbours(m):
    return graph.nearest_neighbours(m.embeddings, 10).withColumn("dist", F.round("dist", 6))


def edges(m):
    return graph.neighbour_graph(cut(graph.nearest_neighbours(m.embeddings, 14)), 15)


@query("m06_neighbour_graph")
def neighbour_graph(m):
    return edges(m)


@query(
    "m11_graph_density",
    with_ctes(
        *KNN,
        "d AS (SELECT DISTINCT * FROM (SELECT obs_id AS s, neighbour_id AS t FROM r WHERE rank <= 14 UNION ALL SELECT neighbour_id, obs_id FROM r WHERE rank <= 14))",
        "SELECT (SELECT count(*) FROM e) AS n_nodes, count(*) AS n_edges, count(*) / CAST((SELECT count(*) * (count(*) - 1) FROM e) AS DOUBLE) AS density FROM d",
    ),
)
def density(m):
    return graph.graph_density(edges(m), m.embeddings)


@query("m07_communities")
def communities(m):
    return graph.communities(edges(m), [(0.5, 0), (1.0, 0)])


@query("m07_communities_distributed")
def communities_distributed(m):
    return graph.communities(edges(m), [(1.0, 0)])


HUBS = (
    "size AS (SELECT c_nationkey, count(*) AS n, min(c_custkey) AS first FROM customer GROUP BY 1)",
    "place AS (SELECT c_nationkey, CAST(row_number() OVER (ORDER BY n DESC, first) - 1 AS INTEGER) AS label FROM size)",
    "member AS (SELECT c_custkey AS obs_id, c_nationkey FROM customer UNION ALL SELECT DISTINCT 1000000000 + c_nationkey, c_nationkey FROM customer)",
    "SELECT r.resolution, s.seed, obs_id, label FROM member JOIN place USING (c_nationkey), (VALUES (0.5::DOUBLE), (1.0::DOUBLE)) r(resolution), (VALUES (0::BIGINT), (7::BIGINT)) s(seed)",
)


@query("m07_communities_certain", with_ctes(*HUBS))
def communities_certain(m):
    """Customers tied to the hub of their nation, and weakly along a chain: the nations are the best partition."""
    c = m.table("customer")
    one = c.select(F.col("c_custkey").alias("src"), (F.col("c_nationkey") + 1_000_000_000).cast("bigint").alias("dst"), F.lit(1.0).alias("weight"))
    chain = c.select(F.col("c_custkey").alias("src"), (F.col("c_custkey") + 1).alias("dst")).join(c.select(F.col("c_custkey").alias("dst")), "dst")
    half = one.unionByName(chain.select("src", "dst", F.lit(0.001).alias("weight")))
    both = half.unionByName(half.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return graph.communities(both, [(0.5, 0), (0.5, 7), (1.0, 0), (1.0, 7)])


@query("m07_o08_cluster_search")
def search(m):
    return graph.cluster_search(edges(m), (0.5, 1.0, 1.5), (0, 1, 2))[2]


@query(
    "m07_ari_nmi",
    with_ctes(
        "p AS (SELECT c_mktsegment AS a, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE concat('x', c_custkey % 4) END AS b FROM customer)",
        "c AS (SELECT a, b, CAST(count(*) AS DOUBLE) AS n FROM p GROUP BY 1, 2)",
        "x AS (SELECT sum(n) AS n FROM c GROUP BY a)", "y AS (SELECT sum(n) AS n FROM c GROUP BY b)",
        "s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM c) AS ij, (SELECT sum(n * (n - 1) / 2) FROM x) AS sa, (SELECT sum(n * (n - 1) / 2) FROM y) AS sb, (SELECT sum(n) FROM c) AS t, "
        "(SELECT sum(n * ln(n)) FROM c) AS hij, (SELECT sum(n * ln(n)) FROM x) AS ha, (SELECT sum(n * ln(n)) FROM y) AS hb)",
        "SELECT round((ij - sa * sb / (t * (t - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (t * (t - 1) / 2)), 8) AS ari, "
        "round((ln(t) + hij / t - ha / t - hb / t) / ((ln(t) - ha / t + ln(t) - hb / t) / 2), 8) AS nmi FROM s",
    ),
)
def ari_nmi(m):
    k = F.col("c_custkey")
    pairs = m.table("customer").select(
        F.col("c_mktsegment").alias("a"), F.when(k % 3 == 0, F.col("c_mktsegment")).otherwise(F.concat(F.lit("x"), (k % 4).cast("string"))).alias("b")
    )
    return graph.partition_agreement(pairs).select(F.round("ari", 8).alias("ari"), F.round("nmi", 8).alias("nmi"))


@query(
    "o08_choose_resolution",
    with_ctes(
        "s AS (SELECT p_size / CAST(10 AS DOUBLE) AS resolution, round(avg(p_retailprice) / 2000, 3) AS median_ari, count(DISTINCT p_brand) AS n_clusters_seed0 FROM part GROUP BY 1)",
        "SELECT coalesce((SELECT min(resolution) FROM s WHERE median_ari >= 0.5 AND n_clusters_seed0 BETWEEN 2 AND 22), (SELECT resolution FROM s ORDER BY median_ari DESC, n_clusters_seed0 DESC, resolution LIMIT 1)) AS resolution, count(*) AS n FROM s",
    ),
)
def choose(m):
    s = m.table("part").groupBy((F.col("p_size") / 10.0).cast("double").alias("resolution")).agg(
        F.round(F.avg("p_retailprice") / 2000, 3).alias("median_ari"), F.count_distinct("p_brand").alias("n_clusters_seed0")
    )
    best = graph.choose_resolution(s, 0.5, 2, 22)
    return s.agg(F.count(F.lit(1)).alias("n")).select(F.lit(best).alias("resolution"), "n")
