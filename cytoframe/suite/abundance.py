"""Composition, design, survival and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe.adapters import COMP, with_ctes
from cytoframe.operators import abundance as ab
from cytoframe.suite import query

CNT = "cc AS (SELECT sample_id, cell_type, count(*) AS n FROM comp GROUP BY 1, 2)"
TAB = [
    COMP, CNT,
    "s AS (SELECT sample_id FROM cc GROUP BY 1 HAVING sum(n) >= 55)",
    "ty AS (SELECT cell_type FROM cc WHERE sample_id IN (SELECT sample_id FROM s) GROUP BY 1 HAVING sum(n) >= 50)",
    "grid AS (SELECT sample_id, cell_type, coalesce(n, 0) AS n FROM s CROSS JOIN ty LEFT JOIN cc USING (sample_id, cell_type))",
    "tab AS (SELECT *, n / CAST(sum(n) OVER (PARTITION BY sample_id) AS DOUBLE) AS prop FROM grid)",
]
META = (
    "meta AS (SELECT n_nationkey AS sample_id, n_name, r_name AS region, v AS value FROM nation JOIN region ON n_regionkey = r_regionkey "
    "JOIN (SELECT c_nationkey, avg(c_acctbal) AS v FROM customer GROUP BY 1) ON c_nationkey = n_nationkey)"
)


def table(m):
    return ab.composition(m.composition, 55, 50)


def metadata(m):
    avg = m.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.avg("c_acctbal").alias("value"))
    regions = m.table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return m.table("nation").join(regions, "n_regionkey").join(avg, "n_nationkey").select(
        F.col("n_nationkey").alias("sample_id"), "n_name", "region", "value"
    )


@query("a08_composition", with_ctes(*TAB, "SELECT sample_id, cell_type, n FROM tab"))
def comp(m):
    return table(m).select("sample_id", "cell_type", "n")


@query("a09_proportions", with_ctes(*TAB, "SELECT sample_id, cell_type, prop FROM tab"))
def props(m):
    return table(m).select("sample_id", "cell_type", "prop")


@query("s06_counts_roundtrip", with_ctes(*TAB, "SELECT sample_id, cell_type, n, prop FROM tab"))
def roundtrip(m):
    return ab.long_counts(ab.wide_counts(table(m)))


@query(
    "j02_merge_metadata",
    with_ctes(*TAB, META, "SELECT tab.sample_id, cell_type, n, region FROM tab LEFT JOIN (SELECT * FROM meta WHERE region <> 'ASIA') m ON m.sample_id = tab.sample_id"),
)
def merged(m):
    meta = metadata(m).where(F.col("region") != "ASIA").select("sample_id", "region")
    return ab.merge_metadata(table(m), meta).select("sample_id", "cell_type", "n", "region")


@query(
    "f17_f18_covariates",
    with_ctes(
        META,
        "SELECT sample_id, round((value - (SELECT avg(value) FROM meta)) / (SELECT stddev_pop(value) FROM meta), 6) AS value, "
        + ", ".join(f"CAST(region = '{r}' AS DOUBLE) AS \"region_{r}\"" for r in ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))
        + " FROM meta",
    ),
)
def covariates(m):
    return ab.covariate_matrix(metadata(m), "value, region").withColumn("value", F.round("value", 6))


@query("f19_binary_labels", with_ctes(META, "SELECT sample_id, CAST(region = 'ASIA' AS INTEGER) AS y FROM meta WHERE region IN ('ASIA', 'EUROPE')"))
def binary(m):
    return ab.binary_labels(metadata(m), "region", "ASIA", "EUROPE").select("sample_id", "y")


@query(
    "f20_class_labels",
    with_ctes(
        META,
        "SELECT sample_id, CAST(CASE WHEN l = 'EUROPE' THEN 0 ELSE dense_rank() OVER (ORDER BY l = 'EUROPE' DESC, l) - 1 END AS INTEGER) AS y "
        "FROM (SELECT sample_id, CASE WHEN sample_id % 7 = 0 THEN 'nan' ELSE region END AS l FROM meta)",
    ),
)
def classes(m):
    meta = metadata(m).withColumn("region", F.when(F.col("sample_id") % 7 != 0, F.col("region")))
    return ab.class_labels(meta, "region", "EUROPE").select("sample_id", "y")


SUBJ = (
    "subj AS (SELECT c_custkey AS id, CAST(t AS DOUBLE) AS time, e AS event, floor(c_acctbal / 50.0) / 20.0 AS risk, floor(c_acctbal / 50.0) / 100.0 AS x1, "
    "c_nationkey / CAST(10 AS DOUBLE) AS x2 FROM customer JOIN (SELECT o_custkey, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) % 997 AS BIGINT) AS t, "
    "CAST(sum(o_orderkey) % 3 > 0 AS INTEGER) AS e FROM orders GROUP BY 1) ON o_custkey = c_custkey)"
)


def subjects(m):
    per = m.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        (F.sum(F.floor("o_totalprice")) % 997).cast("double").alias("time"), (F.sum("o_orderkey") % 3 > 0).cast("int").alias("event")
    )
    bal = F.floor(F.col("c_acctbal") / 50.0).cast("double")
    return m.table("customer").join(per, "c_custkey").select(
        F.col("c_custkey").alias("id"), "time", "event", (bal / 20.0).alias("risk"), (bal / 100.0).alias("x1"), (F.col("c_nationkey") / 10.0).cast("double").alias("x2")
    )


@query(
    "f21_survival_times",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS time, CAST(value > 50 AS INTEGER) AS event FROM events "
    "WHERE json_extract_string(props, '$.k') IS NOT NULL",
)
def survival(m):
    raw = m.table("events").select("event_id", F.get_json_object("props", "$.k").alias("t_text"), (F.col("value") > 50).cast("int").alias("e_raw"))
    return ab.survival_times(raw, "t_text", "e_raw").select("event_id", "time", "event")


@query(
    "b08_j10_concordance",
    with_ctes(
        SUBJ,
        "SELECT count(*) AS comparable_pairs, sum(CASE WHEN a.risk > b.risk THEN 1.0 WHEN a.risk = b.risk THEN 0.5 ELSE 0.0 END) / CAST(count(*) AS DOUBLE) AS concordance_index "
        "FROM subj a JOIN subj b ON a.event > 0 AND a.time < b.time",
    ),
)
def concordance(m):
    return ab.concordance(subjects(m))


@query(
    "w06_cox_nll",
    with_ctes(
        SUBJ,
        "SELECT round(avg(l - risk) FILTER (event > 0), 8) AS cox_partial_nll, count(*) FILTER (event > 0) AS n_events FROM (SELECT *, "
        "ln(sum(exp(risk - (SELECT max(risk) FROM subj))) OVER (ORDER BY time DESC, id ROWS UNBOUNDED PRECEDING)) + (SELECT max(risk) FROM subj) AS l FROM subj)",
    ),
)
def cox(m):
    return ab.cox_nll(subjects(m), "id").withColumn("cox_partial_nll", F.round("cox_partial_nll", 8))


@query(
    "w07_cox_gradient",
    with_ctes(
        SUBJ,
        "e AS (SELECT *, x1 * 0.3 - x2 * 0.2 AS eta FROM subj)",
        "r AS (SELECT *, sum(exp(eta)) OVER w AS s, sum(exp(eta) * x1) OVER w AS s1, sum(exp(eta) * x2) OVER w AS s2 FROM e WINDOW w AS (ORDER BY time DESC, id ROWS UNBOUNDED PRECEDING))",
        "SELECT round(avg(ln(s) - eta) + 0.5 * 0.1 * 0.13, 8) AS loss, round(-avg(x1 - s1 / s) + 0.03, 8) AS grad_x1, round(-avg(x2 - s2 / s) - 0.02, 8) AS grad_x2 FROM r WHERE event > 0",
    ),
)
def gradient(m):
    out = ab.cox_gradient(subjects(m), ["x1", "x2"], [0.3, -0.2], "id", 0.1)
    return out.withColumns({c: F.round(c, 8) for c in out.columns})


LOGITS = "lg AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y, (o_totalprice - 250000.0) / 100000.0 AS logit FROM orders)"


def logits(m):
    return m.table("orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"), ((F.col("o_totalprice") - 250000.0) / 100000.0).alias("logit")
    )


AUC_SQL = (
    "(SELECT (sum(r) FILTER (y = 1) - n1 * (n1 + 1) / CAST(2 AS DOUBLE)) / (n1 * n0) FROM (SELECT y, rank() OVER (ORDER BY logit) + (count(*) OVER (PARTITION BY logit) - 1) / CAST(2 AS DOUBLE) AS r, "
    "CAST(count(*) FILTER (y = 1) OVER () AS DOUBLE) AS n1, CAST(count(*) FILTER (y = 0) OVER () AS DOUBLE) AS n0 FROM lg) GROUP BY n1, n0)"
)


@query("w11_j11_auc", with_ctes(LOGITS, f"SELECT round({AUC_SQL}, 9) AS auc"))
def auc(m):
    return ab.auc(logits(m), "y", "logit").withColumn("auc", F.round("auc", 9))


@query(
    "a21_binary_metrics",
    with_ctes(
        LOGITS,
        "p AS (SELECT y, 1 / (1 + exp(-logit)) AS s, CAST(1 / (1 + exp(-logit)) >= 0.5 AS INTEGER) AS p FROM lg)",
        "c AS (SELECT CAST(count(*) FILTER (p = 1 AND y = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (p = 0 AND y = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (p = 1 AND y = 0) AS DOUBLE) AS fp, "
        "CAST(count(*) FILTER (p = 0 AND y = 1) AS DOUBLE) AS fn, -avg(CASE WHEN y = 1 THEN ln(greatest(s, 1e-6)) ELSE ln(greatest(1 - s, 1e-6)) END) AS ll FROM p)",
        "SELECT round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 9) AS balanced_accuracy, round(tp / (tp + fp), 9) AS precision, "
        f"round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1, round(ll, 6) AS log_loss, round({AUC_SQL}, 9) AS auc FROM c",
    ),
)
def binary_metrics(m):
    out = ab.binary_metrics(logits(m), "y", "logit")
    return out.withColumns({c: F.round(c, 6 if c == "log_loss" else 9) for c in out.columns})


MULTI = (
    "ml AS (SELECT o_orderkey AS row_id, cls, ((o_orderkey * (k + 3)) % 11) / CAST(5 AS DOUBLE) AS logit, o_orderpriority AS truth FROM orders, (SELECT cls, row_number() OVER (ORDER BY cls) AS k FROM (SELECT DISTINCT o_orderpriority AS cls FROM orders)))"
)


def multi(m):
    orders = m.table("orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderpriority").alias("truth"))
    names = m.table("orders").agg(F.array_sort(F.collect_set("o_orderpriority"))).scalar()
    return orders.select("row_id", "truth", F.posexplode(names).alias("k", "cls")).select(
        "row_id", "cls", (((F.col("row_id") * (F.col("k") + 4)) % 11) / 5.0).cast("double").alias("logit"), "truth"
    )


@query(
    "a21_multiclass_metrics",
    with_ctes(
        MULTI,
        "lp AS (SELECT *, logit - ln(sum(exp(logit)) OVER (PARTITION BY row_id)) AS lp FROM ml)",
        "pr AS (SELECT row_id, arg_max(cls, (logit, -k)) AS pred, any_value(truth) AS truth, max(lp) FILTER (cls = truth) AS lp FROM (SELECT lp.*, dense_rank() OVER (ORDER BY cls) AS k FROM lp) GROUP BY 1)",
        "cl AS (SELECT cls, (SELECT count(*) FROM pr WHERE pred = cls AND truth = cls) AS tp, (SELECT count(*) FROM pr WHERE pred = cls) AS np, (SELECT count(*) FROM pr WHERE truth = cls) AS nt FROM (SELECT DISTINCT cls FROM ml))",
        "rk AS (SELECT cls, CAST(cls = truth AS INTEGER) AS y, rank() OVER (PARTITION BY cls ORDER BY round(exp(lp), 10)) + (count(*) OVER (PARTITION BY cls, round(exp(lp), 10)) - 1) / CAST(2 AS DOUBLE) AS r FROM lp)",
        "au AS (SELECT cls, (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / CAST(2 AS DOUBLE)) / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0)) AS a FROM rk GROUP BY 1)",
        "SELECT round((SELECT avg(CAST(pred = truth AS DOUBLE)) FROM pr), 6) AS accuracy, round((SELECT avg(CAST(tp AS DOUBLE) / nt) FROM cl), 6) AS balanced_accuracy, "
        "round((SELECT avg(2 * CAST(tp AS DOUBLE) / (np + nt)) FROM cl), 6) AS macro_f1, round((SELECT -avg(ln(greatest(exp(lp), 1e-6))) FROM pr), 6) AS log_loss, round((SELECT avg(a) FROM au), 6) AS macro_auc",
    ),
)
def multiclass_metrics(m):
    out = ab.multiclass_metrics(multi(m))
    return out.withColumns({c: F.round(c, 6) for c in out.columns})


@query(
    "f05_losses",
    with_ctes(
        LOGITS, MULTI,
        "lp AS (SELECT *, logit - ln(sum(exp(logit)) OVER (PARTITION BY row_id)) AS lp, (row_id % 5) + 1 AS cnt FROM ml)",
        "SELECT round((SELECT avg(greatest(logit, 0) - logit * y + ln(1 + exp(-abs(logit)))) FROM lg), 6) AS bce, round((SELECT avg((greatest(logit, 0) - logit * y + ln(1 + exp(-abs(logit)))) * (1 + y)) FROM lg), 6) AS weighted_bce, "
        "round((SELECT avg(1 / (1 + exp(-logit))) FROM lg), 6) AS mean_sigmoid, round((SELECT -avg(lp) FROM lp WHERE cls = truth), 6) AS cross_entropy, "
        "round((SELECT avg(l) FROM (SELECT -sum(cnt * lp) / greatest(sum(cnt), 1) AS l FROM lp GROUP BY row_id)), 6) AS multinomial_nll",
    ),
)
def losses(m):
    lg, ml = logits(m), multi(m).withColumn("hit", F.col("cls") == F.col("truth")).withColumn("cnt", (F.col("row_id") % 5 + 1).cast("double"))
    y = F.col("y")
    return lg.agg(
        F.round(ab.bce_with_logits(F.col("logit"), y), 6).alias("bce"),
        F.round(ab.bce_with_logits(F.col("logit"), y, 1 + y), 6).alias("weighted_bce"),
        F.round(F.avg(ab.sigmoid(F.col("logit"))), 6).alias("mean_sigmoid"),
    ).select(
        "*", F.round(ab.cross_entropy(ml, "row_id", "logit", "hit").scalar(), 6).alias("cross_entropy"),
        F.round(ab.multinomial_nll(ml, "row_id", "logit", "cnt").scalar(), 6).alias("multinomial_nll"),
    )


@query(
    "b06_b07_label_association",
    with_ctes(
        *TAB, META,
        "j AS (SELECT cell_type, prop, region = 'ASIA' AS p FROM tab JOIN meta USING (sample_id) WHERE region IN ('ASIA', 'EUROPE'))",
        "w AS (SELECT cell_type, avg(prop) FILTER (p) AS m1, avg(prop) FILTER (NOT p) AS m0, var_samp(prop) FILTER (p) / count(*) FILTER (p) AS a, var_samp(prop) FILTER (NOT p) / count(*) FILTER (NOT p) AS b, count(*) FILTER (p) AS n1, count(*) FILTER (NOT p) AS n0 FROM j GROUP BY 1)",
        "SELECT cell_type, round(m1, 6) AS mean_prop_positive, round(m0, 6) AS mean_prop_negative, round(m1 - m0, 6) AS delta_prop, round((m1 - m0) / sqrt(a + b), 6) AS z, round((a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n0 - 1)), 6) AS df FROM w",
    ),
)
def label_association(m):
    out = ab.label_association(table(m), ab.binary_labels(metadata(m), "region", "ASIA", "EUROPE"))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "cell_type"})


@query("b06_label_association_fdr")
def label_fdr(m):
    t = ab.label_association(table(m), ab.binary_labels(metadata(m), "region", "ASIA", "EUROPE"))
    return ab.with_fdr(t, "z", F.col("df"))


@query(
    "b06_multiclass_contrasts",
    with_ctes(
        *TAB, META,
        "j AS (SELECT cell_type, prop, region FROM tab JOIN meta USING (sample_id))",
        "g AS (SELECT cell_type, region, avg(prop) AS m, var_samp(prop) / count(*) AS a FROM j GROUP BY 1, 2)",
        "SELECT x.cell_type, concat(x.region, '_vs_AFRICA') AS class_or_contrast, round(x.m, 6) AS mean_prop_positive, round(r.m, 6) AS mean_prop_negative, round((x.m - r.m) / sqrt(x.a + r.a), 6) AS z "
        "FROM g x JOIN g r ON r.cell_type = x.cell_type AND r.region = 'AFRICA' WHERE x.region <> 'AFRICA'",
    ),
)
def contrasts(m):
    meta = metadata(m)
    others = F.array(*[F.lit(r) for r in ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")])
    pairs = meta.select("sample_id", "region", F.explode(others).alias("other")).where((F.col("region") == F.col("other")) | (F.col("region") == "AFRICA"))
    labels = pairs.select("sample_id", F.concat("other", F.lit("_vs_AFRICA")).alias("class_or_contrast"), (F.col("region") == F.col("other")).cast("int").alias("y"))
    out = ab.label_association(table(m), labels, ["cell_type", "class_or_contrast"])
    return out.select("cell_type", "class_or_contrast", *[F.round(c, 6).alias(c) for c in ("mean_prop_positive", "mean_prop_negative", "z")])


@query(
    "f08_value_association",
    with_ctes(
        *TAB, META,
        "c AS (SELECT cell_type, count(*) AS n, corr(prop, value) AS r FROM tab JOIN meta USING (sample_id) GROUP BY 1)",
        "SELECT cell_type, n, round(r, 6) AS r, round(0.5 * ln((1 + r) / (1 - r)), 6) AS z, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t FROM c",
    ),
)
def value_association(m):
    out = ab.value_association(table(m), metadata(m))
    return out.withColumns({c: F.round(c, 6) for c in ("r", "z", "t")})


@query("b06_value_association_fdr")
def value_fdr(m):
    return ab.with_fdr(ab.value_association(table(m), metadata(m)), "t", F.col("n") - 2)


@query(
    "b06_risk_split",
    with_ctes(
        *TAB, META,
        "SELECT cell_type, round(avg(prop) FILTER (value >= md), 6) AS mean_prop_high_risk, round(avg(prop) FILTER (value < md), 6) AS mean_prop_low_risk "
        "FROM tab JOIN meta USING (sample_id), (SELECT median(value) AS md FROM meta) GROUP BY 1",
    ),
)
def risk_split(m):
    out = ab.risk_split_means(table(m), metadata(m).withColumnRenamed("value", "risk"))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_prop_high_risk", "mean_prop_low_risk")})


@query(
    "f30_ratio_direction",
    with_ctes(
        META,
        "SELECT sample_id, round(exp(least(greatest((value - 4500) / 10, -20), 20)), 6) AS ratio, CASE WHEN value >= 4500 THEN 'positive' ELSE 'negative' END AS direction FROM meta",
    ),
)
def ratio(m):
    c = (F.col("value") - 4500) / 10
    return metadata(m).select("sample_id", F.round(ab.ratio_from_coefficient(c), 6).alias("ratio"), ab.direction(c).alias("direction"))


@query(
    "b02_bags",
    with_ctes(
        *TAB,
        "p AS (SELECT *, sum(n) OVER (PARTITION BY sample_id) AS t, floor(n * 40 / CAST(sum(n) OVER (PARTITION BY sample_id) AS DOUBLE)) AS w, n * 40 / CAST(sum(n) OVER (PARTITION BY sample_id) AS DOUBLE) AS s FROM grid)",
        "SELECT sample_id, cell_type, CAST(CASE WHEN t <= 40 THEN n ELSE w + CASE WHEN row_number() OVER (PARTITION BY sample_id ORDER BY s - w DESC, cell_type) <= 40 - sum(w) OVER (PARTITION BY sample_id) THEN 1 ELSE 0 END END AS BIGINT) AS instances FROM p",
    ),
)
def bags(m):
    return ab.bags(table(m), 40)


@query(
    "a13_sample_stats",
    with_ctes(COMP, "SELECT count(*) AS n_samples, min(n) AS min_cells, median(n) AS median_cells, max(n) AS max_cells FROM (SELECT count(*) AS n FROM comp GROUP BY sample_id)"),
)
def sample_stats(m):
    return ab.sample_stats(m.composition)


def _bag_vectors(m):
    from cytoframe.operators import mil

    counts = ab.bags(table(m))
    types = [r[0] for r in counts.select("cell_type").distinct().orderBy("cell_type").collect()]
    return mil.sample_vectors(counts, types), types


@query("b03_b05_mil_binary")
def mil_binary(m):
    from cytoframe.operators import mil

    vectors, types = _bag_vectors(m)
    labels = ab.binary_labels(metadata(m).withColumn("half", (F.col("sample_id") % 2).cast("string")), "half", "1", "0")
    data = vectors.join(labels.select("sample_id", F.col("y").cast("double").alias("y")), "sample_id")
    params, _ = mil.fit_mil(data, "binary", len(types), cfg=mil.MilConfig(hidden=16, epochs=5, learning_rate=0.01))
    out = data.join(mil.predict(data, params, 1), "sample_id")
    logit = F.element_at("logits", 1)
    return out.select("sample_id", "y", logit.alias("logit"), ab.sigmoid(logit).alias("probability"))


@query("b03_b05_mil_survival")
def mil_survival(m):
    from cytoframe.operators import mil

    vectors, types = _bag_vectors(m)
    times = metadata(m).select("sample_id", F.col("value").alias("time"), (F.col("sample_id") % 3 > 0).cast("int").alias("event"))
    data = vectors.join(times, "sample_id")
    params, _ = mil.fit_mil(data, "survival", len(types), cfg=mil.MilConfig(hidden=8, epochs=2))
    return data.select("sample_id", "time", "event").join(mil.predict(data, params, 1).select("sample_id", F.element_at("logits", 1).alias("risk")), "sample_id")
