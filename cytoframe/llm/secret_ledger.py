"""Secret scanning with an incremental blob ledger; DataFrame and SQL functions only.

A blob is named by the SHA-256 of its content, so that equal versions of any number of paths are one
blob.  The ledger remembers which (blob, rule, rule version) triples were scanned and what
was found; a scan reads only the blobs with unseen triples, whatever paths or historical
versions bring them, and findings are joined back to every path that holds the blob.

Matches are found as the places between the parts of ``split``: part lengths and match
lengths, summed in order, give offsets in code points.

Defined cases: a null text is an empty blob; null and repeated paths are ordinary rows, each
with its findings; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import row_key, table
from cytoframe.session import cut, ensure_checkpoint_dir


@dataclass(frozen=True)
class Rule:
    """A pattern; ``group`` of a match must have ``least`` characters.  ``hint``: a literal every match holds."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    hint: str = ""
    version: int = 1


#: The base rules, in their order.
BASE = (
    Rule("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 20, hint="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
#: Token formats that their issuers have published.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint="eyJ"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}", hint="AIza"),
    Rule("pay", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}", hint="k_"),
    Rule("login", r"[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%-]+:[^\x20\x09-\x0D/@:]+@", hint="://"),
)
RULES = BASE + MORE


def _parts(text: Column, rule: Rule) -> Column:
    """Array of (kind, i, gap, hit): match i of the rule, and the text between it and the one before."""
    may = F.contains(text, F.lit(rule.hint)) if rule.hint else text.rlike(rule.pattern)
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    zipped = F.zip_with(F.slice(F.split(text, rule.pattern, -1), 1, F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    named = F.transform(zipped, lambda x, i: F.struct(
        F.lit(rule.kind).alias("kind"), i.alias("i"), F.char_length(x["gap"]).alias("gap"), F.char_length(x["hit"]).alias("hit"),
        (F.char_length(F.regexp_extract(x["hit"], rule.pattern, rule.group)) >= rule.least).alias("ok"),
    ))
    return F.when(may, named).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,hit:int,ok:boolean>>"))


class BlobLedger:
    """Scanned triples and findings, in folders below ``root``; every scan appends a batch."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.batches = spark, root, 0

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self.batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{name}/{n}" for n in range(self.batches)])

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, kind string, version int")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob string, kind string, version int, start long, end long")

    def scan(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> BlobLedger:
        """Scan what is new in ``docs`` (doc_id, text)."""
        blobs = docs.select(*[c.alias(n) for n, c in row_key().items()], blob_name().alias("blob"))
        holders = blobs.groupBy("blob").agg(F.min(F.struct("_id", "_t")).alias("at"))
        pairs = F.explode(F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])).alias("rule")
        todo = holders.select("blob", "at", pairs).select("blob", "at", "rule.*")
        if self.batches:
            todo = todo.join(self.scanned(), ["blob", "kind", "version"], "left_anti")
        todo = cut(todo.groupBy("blob", "at").agg(F.collect_set("kind").alias("kinds")).select("blob", "at.*", "kinds"))
        texts = docs.select(*[c.alias(n) for n, c in row_key().items()], F.coalesce("text", F.lit("")).alias("text"))
        found = todo.join(texts, ["_id", "_t"])
        none = F.array().cast("array<struct<kind:string,i:int,gap:int,hit:int,ok:boolean>>")
        parts = [F.when(F.array_contains("kinds", r.kind), _parts(F.col("text"), r)).otherwise(none) for r in rules]
        rows = found.select("blob", F.explode(F.concat(*parts)).alias("x")).select("blob", "x.*")
        rows = rows.groupBy("blob", "kind", "i").agg(F.first("gap").alias("gap"), F.first("hit").alias("hit"), F.first("ok").alias("ok"))
        upto = Window.partitionBy("blob", "kind").orderBy("i")
        end = F.sum(F.col("gap") + F.col("hit")).over(upto).cast("long")
        version = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
        spans = rows.withColumn("end", end).where("ok").select("blob", "kind", version[F.col("kind")].alias("version"), (F.col("end") - F.col("hit")).alias("start"), "end")
        spans.write.parquet(f"{self.root}/findings/{self.batches}")
        todo.select("blob", F.explode("kinds").alias("kind")).select("blob", "kind", version[F.col("kind")].alias("version")).write.parquet(f"{self.root}/scanned/{self.batches}")
        self.batches += 1
        return self

    def paths(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """doc_id and ``spans``, the sorted array of (start, place of the kind among the rules, kind, end), of every row."""
        place = F.create_map(*[F.lit(x) for n, r in enumerate(rules) for x in (r.kind, n)])
        current = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
        mine = self.findings().where(current[F.col("kind")] == F.col("version")).groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("start", place[F.col("kind")].alias("place"), "kind", "end"))).alias("spans"))
        rows = docs.select("doc_id", blob_name().alias("blob"))
        return rows.join(mine, "blob", "left").select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")).alias("spans"))


def blob_name() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def new_ledger(spark: SparkSession) -> BlobLedger:
    ensure_checkpoint_dir(spark)
    return BlobLedger(spark, f"{spark.sparkContext.getCheckpointDir()}/blobs-{uuid.uuid4().hex}")


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    one = """SELECT r, '{kind}' AS kind, {place} AS place, i, length(gap) AS gap, length(hit) AS hit, length(regexp_extract(hit, {p}, {group})) >= {least} AS ok
      FROM (SELECT r, unnest(range(len(regexp_extract_all(t, {p})))) AS i, unnest(regexp_split_to_array(t, {p})[:len(regexp_extract_all(t, {p}))]) AS gap, unnest(regexp_extract_all(t, {p})) AS hit FROM d)"""
    parts = " UNION ALL ".join(one.format(kind=r.kind, place=n, p=quote(r.pattern), group=r.group, least=r.least) for n, r in enumerate(RULES))
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    join = "coalesce(string_agg(kind || ':' || (e - hit) || ':' || e, ',' ORDER BY e - hit, place) {f}, '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({parts}),
placed AS (SELECT *, CAST(sum(gap + hit) OVER (PARTITION BY r, kind ORDER BY i) AS BIGINT) AS e FROM found),
told AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         {join.format(f=f"FILTER (kind IN ({base}))")} AS base, {join.format(f="")} AS spans
  FROM placed WHERE ok GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (r)
"""


@query("op3_blob_ledger", _sql())
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = new_ledger(spark).scan(docs).paths(docs)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(_text(base), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))
