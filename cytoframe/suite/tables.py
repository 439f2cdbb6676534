"""Join, set, naming and selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.adapters import EXPR, EXPR_PART, OBS, VAR, with_ctes
from cytoframe.operators import matrix as mx
from cytoframe.operators import tables as tb
from cytoframe.operators.cnv import first_per_key
from cytoframe.schema import flatten_keep, keep_listed, require_columns
from cytoframe.sources.readers import parse_elapsed, parse_time_logs
from cytoframe.sources.sinks import latest_per_key, safe_cell_type, safe_name
from cytoframe.suite import query

KEEP = {"obs": {"ids": ["c_custkey", "c_name"], "groups": ["c_mktsegment", "absent_column"]}}


@query("p01_keep_listed", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def prune(m):
    return keep_listed(m.table("customer"), flatten_keep(KEEP["obs"]))


@query(
    "p02_unique_names",
    "SELECT p_partkey, p_name, CASE WHEN r = 1 THEN p_name ELSE concat(p_name, '-', r - 1) END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS r FROM part)",
)
def unique_names(m):
    parts = require_columns(m.table("part"), ["p_partkey", "p_name"], "part")
    return tb.make_unique(parts.select("p_partkey", "p_name"), "p_name", "p_partkey")


@query("j01_inner_align", with_ctes(OBS, EXPR, "SELECT obs_id, var_id, value, cluster FROM expr JOIN obs USING (obs_id) WHERE cluster <> 'BUILDING'"))
def inner(m):
    return m.expr.join(m.obs.where(F.col("cluster") != "BUILDING").select("obs_id", "cluster"), "obs_id")


@query("j03_semi", with_ctes(VAR, EXPR, "SELECT * FROM expr WHERE var_id IN (SELECT var_id FROM var WHERE symbol LIKE 'GENE%')"))
def semi(m):
    return m.expr.join(m.var.where(F.col("symbol").startswith("GENE")), "var_id", "left_semi").select("obs_id", "var_id", "value")


@query("j04_anti", "SELECT p_partkey AS var_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def anti(m):
    big = m.table("lineitem").where(F.col("l_quantity") > 49).select(F.col("l_partkey").alias("var_id"))
    return m.table("part").select(F.col("p_partkey").alias("var_id")).join(big, "var_id", "left_anti")


@query("j06_first_position", "SELECT p_name, arg_min(p_partkey, p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand FROM part GROUP BY 1")
def first(m):
    return first_per_key(m.table("part").select("p_name", "p_partkey", "p_brand"), "p_name", "p_partkey")


@query("j06_shared_in_order", "SELECT p_name, min(p_partkey) AS p_partkey FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_size > 40) GROUP BY 1")
def shared(m):
    return tb.shared_in_order(m.table("part"), m.table("part").where(F.col("p_size") > 40), "p_name", "p_partkey")


@query(
    "u02_ordered_union",
    "SELECT p_name, side, pos FROM (SELECT p_name, side, pos, row_number() OVER (PARTITION BY p_name ORDER BY side, pos) AS r FROM (SELECT p_name, 0 AS side, p_partkey AS pos FROM part WHERE p_size <= 20 UNION ALL SELECT p_name, 1, p_partkey FROM part WHERE p_size > 20)) WHERE r = 1",
)
def union(m):
    p = m.table("part")
    return tb.ordered_union(p.where("p_size <= 20"), p.where("p_size > 20"), "p_name", "p_partkey")


@query(
    "u01_s10_concat_shared_genes",
    with_ctes(
        OBS, EXPR_PART,
        "t AS (SELECT obs_id, batch AS sample_id, var_id, value FROM expr_part JOIN obs USING (obs_id))",
        "sh AS (SELECT var_id FROM t GROUP BY 1 HAVING count(DISTINCT sample_id) = (SELECT count(DISTINCT batch) FROM obs))",
        "SELECT concat(sample_id, ':', obs_id) AS obs_id, sample_id, var_id, value FROM t WHERE var_id IN (SELECT var_id FROM sh)",
    ),
)
def concat(m):
    return tb.concat_shared_genes(m.expr_part, m.obs.select("obs_id", F.col("batch").alias("sample_id")))


@query("u04_concat_samples", "SELECT l_orderkey, l_linenumber, l_linestatus AS sample_id FROM lineitem WHERE l_linestatus IN ('O', 'F')")
def stack(m):
    lines = m.table("lineitem")
    return tb.concat_samples({s: lines.where(F.col("l_linestatus") == s).select("l_orderkey", "l_linenumber") for s in ("O", "F")})


@query("u05_known_refs", "SELECT DISTINCT r FROM (SELECT p_brand AS r FROM part UNION SELECT c_mktsegment FROM customer UNION SELECT o_orderpriority FROM orders)")
def known(m):
    cols = (("part", "p_brand"), ("customer", "c_mktsegment"), ("orders", "o_orderpriority"))
    parts = [m.table(t).select(F.col(c).alias("r")) for t, c in cols]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


TASKS = "tasks AS (SELECT p_partkey AS iteration, CAST(p_size AS BIGINT) AS k FROM part)"


def tasks(m):
    return m.table("part").select(F.col("p_partkey").alias("iteration"), F.col("p_size").cast("bigint").alias("k"))


@query("o06_x04_pending_tasks", with_ctes(TASKS, "SELECT * FROM tasks WHERE iteration NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)"))
def pending(m):
    done = m.table("lineitem").where(F.col("l_quantity") == 50).select(F.col("l_partkey").alias("iteration"))
    return tb.pending_tasks(tasks(m), done, ["iteration"])


@query("f23_task_seeds", with_ctes(TASKS, "SELECT iteration, k, 7 + k * 1000003 + iteration AS seed FROM tasks"))
def seeds(m):
    return tb.fit_tasks(tasks(m), 7)


@query(
    "g16_balanced_sample",
    with_ctes(
        OBS,
        "SELECT obs_id, sample_id FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY md5(concat('3:', obs_id)), obs_id) AS r, count(*) OVER (PARTITION BY sample_id) AS n FROM obs) WHERE n >= 55 AND r <= 55",
    ),
)
def sample(m):
    return tb.balanced_sample(m.obs.select("obs_id", "sample_id"), 55, seed=3)


@query("f13_safe_names", "SELECT c_custkey, regexp_replace(c_name, '[^A-Za-z0-9._-]', '_', 'g') AS safe, translate(concat(c_mktsegment, ' / ', c_nationkey), '/ ', '__') AS safe_type FROM customer")
def names(m):
    kind = F.concat("c_mktsegment", F.lit(" / "), F.col("c_nationkey").cast("string"))
    return m.table("customer").select("c_custkey", safe_name(F.col("c_name")).alias("safe"), safe_cell_type(kind).alias("safe_type"))


@query(
    "f14_elapsed",
    "SELECT event_id, CASE event_id % 3 WHEN 0 THEN (event_id % 5) * 3600.0 + (event_id % 60) * 60.0 + 7.25 WHEN 1 THEN (event_id % 60) * 60.0 + 7.25 ELSE 7.25 END::DOUBLE AS seconds FROM events",
)
def elapsed(m):
    e = F.col("event_id")
    minute, tail = (e % 60).cast("string"), F.lit("07.25")
    text = F.when(e % 3 == 0, F.concat_ws(":", (e % 5).cast("string"), minute, tail)).when(e % 3 == 1, F.concat_ws(":", minute, tail)).otherwise(tail)
    return m.table("events").select("event_id", parse_elapsed(text).alias("seconds"))


@query(
    "f14_g15_time_logs",
    "SELECT CAST(user_id AS VARCHAR) AS path, max((event_id % 9) * 60.0 + 5)::DOUBLE AS elapsed_seconds, round(max(event_id) / 1024.0, 1)::DOUBLE AS max_rss_mb, max(event_id % 700)::DOUBLE AS cpu_percent, CAST(0 AS DOUBLE) AS exit_status FROM events GROUP BY 1",
)
def time_logs(m):
    e = F.col("event_id")
    line = F.array(
        F.format_string("\tElapsed (wall clock) time (h:mm:ss or m:ss): %s:05", (e % 9).cast("string")),
        F.format_string("\tMaximum resident set size (kbytes): %s", e.cast("string")),
        F.format_string("\tPercent of CPU this job got: %s%%", (e % 700).cast("string")), F.lit("\tExit status: 0"),
    )
    lines = m.table("events").select(F.col("user_id").cast("string").alias("path"), F.explode(line).alias("value"))
    return parse_time_logs(lines).select("path", "elapsed_seconds", "max_rss_mb", "cpu_percent", "exit_status")


@query("s19_registry_upsert", "SELECT event_type AS category, user_id AS key, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts FROM events GROUP BY 1, 2")
def upsert(m):
    entries = m.table("events").select(F.col("event_type").alias("category"), F.col("user_id").alias("key"), "value", "ts", "event_id")
    return latest_per_key(entries, ["category", "key"], ["ts", "event_id"]).select("category", "key", "value", "ts")


@query("f28_sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def digest(m):
    return m.table("documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query(
    "f11_label_terms",
    "SELECT doc_id, regexp_matches(lower(text), 'malignant|tumor|tumour|cancer|neoplastic') AS tumour_terms, regexp_matches(lower(text), 'ribosomal|mitochondrial|stress|cell-cycle|cell_cycle|cycling') AS program_terms FROM documents",
)
def terms(m):
    from cytoframe.operators.evidence import PROGRAM_TERMS, TUMOUR_TERMS

    low = F.lower("text")
    return m.table("documents").select("doc_id", low.rlike("|".join(TUMOUR_TERMS)).alias("tumour_terms"), low.rlike("|".join(PROGRAM_TERMS)).alias("program_terms"))
