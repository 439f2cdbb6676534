"""Pseudobulk contrasts, composition and survival on small fixtures."""

import numpy as np
import pandas as pd
import pytest

from cytoframe.operators import abundance as ab
from cytoframe.operators import nbglm, pseudobulk as pb


def long(spark, y, genes=None):
    genes = genes or [f"G{j}" for j in range(y.shape[1])]
    rows = [(f"s{i}", genes[j], float(y[i, j])) for i in range(y.shape[0]) for j in range(y.shape[1]) if y[i, j]]
    return spark.createDataFrame(rows, "pseudobulk_id string, var_id string, count double")


def meta(spark, labels):
    return spark.createDataFrame([(f"s{i}", c) for i, c in enumerate(labels)], "pseudobulk_id string, condition string")


def test_nb_wald_finds_changed_gene(spark):
    rng = np.random.default_rng(1)
    y = rng.poisson(80, size=(8, 20)).astype(float)
    y[4:, 0] *= 4
    out = nbglm.nb_wald(long(spark, y), meta(spark, ["ctrl"] * 4 + ["test"] * 4), "condition", "ctrl", "test").toPandas()
    g0 = out[out.gene == "G0"].iloc[0]
    assert g0.log2FoldChange > 1 and g0.pvalue < 0.05 and out.iloc[0].gene == "G0"
    assert ((out.padj >= 0) & (out.padj <= 1)).all()


def test_nb_fit_solves_score_equations(spark):
    """At the optimum the two score sums of the log-link model vanish."""
    rng = np.random.default_rng(4)
    d = nbglm.Design(np.array([0, 0, 0, 1, 1, 1.0]), np.exp(rng.normal(0, 0.2, 6)))
    y = rng.poisson(50, size=(5, 6)).astype(float)
    alpha = np.full(5, 0.1)
    b0, b1, _ = nbglm._irls(y, alpha, d)
    mu = nbglm._mu(b0, b1, d)
    score = (y - mu) / (1 + alpha[:, None] * mu)
    assert np.abs(score.sum(1)).max() < 1e-6 and np.abs(score[:, 3:].sum(1)).max() < 1e-6


def test_size_factors_centre_and_order(spark):
    y = np.array([[10, 20, 30], [20, 40, 60], [5, 10, 15]], dtype=float)
    sf = {r[0]: r[1] for r in nbglm.size_factors(long(spark, y), meta(spark, list("abc"))).collect()}
    assert np.exp(np.mean(np.log(list(sf.values())))) == pytest.approx(1.0)
    assert sf["s1"] > sf["s0"] > sf["s2"]


def relative_cost(m, d, a, b):
    return ((d / (a + b / m) - 1) ** 2).sum()


def test_trends_of_many_types_are_fitted_together(spark):
    """Each type ends where it would alone, at a minimum over the genes inside its band, whatever the other types do."""
    rng = np.random.default_rng(2)
    parts = []
    for k in range(40):
        m = rng.gamma(2, 50, 30 + 10 * k)
        parts.append(pd.DataFrame({"cell_type": f"t{k}", "base_mean": m, "disp_gene": (0.05 * (k % 7 + 1) + (k % 5) / m) * np.exp(rng.normal(0, 0.2, len(m)))}))
    parts.append(pd.DataFrame({"cell_type": "few", "base_mean": [1.0, 2.0, 3.0], "disp_gene": [0.1, 0.2, 0.3]}))
    pdf = pd.concat(parts)
    found = nbglm.fit_trends(spark.createDataFrame(pdf)).set_index("cell_type")
    assert found.type["few"] == "mean" and found.a["few"] == pytest.approx(0.2) and found.type.drop("few").isin(["parametric"]).all()
    for k in (0, 4, 13, 39):
        alone = nbglm.fit_trend(spark.createDataFrame(parts[k].drop(columns="cell_type")))
        assert found.a[f"t{k}"] == pytest.approx(alone["a"], rel=1e-6) and found.b[f"t{k}"] == pytest.approx(alone["b"], rel=1e-4, abs=1e-6)
        m, d, a, b = parts[k].base_mean.to_numpy(), parts[k].disp_gene.to_numpy(), alone["a"], alone["b"]
        rel = d / (a + b / m)
        m, d = m[(rel > 1e-4) & (rel < 15)], d[(rel > 1e-4) & (rel < 15)]
        here = relative_cost(m, d, a, b)
        assert alone["converged"] and all(here <= relative_cost(m, d, a * x, b * y) * (1 + 1e-6) for x in (0.99, 1, 1.01) for y in (0.98, 1, 1.02))


def by_type(rng, types):
    """Counts and metadata of types with their own samples; 'thin' has one test sample."""
    rows, samples = [], []
    for k in range(types):
        n = 4 + k % 3
        y = rng.poisson(rng.gamma(3, 20, 25)[None, :] * rng.uniform(0.6, 1.6, n)[:, None]).astype(float)
        y[n // 2 :, 0] *= 5
        samples += [(f"t{k}", f"t{k}|{i}", "ctrl" if i < n // 2 else "test") for i in range(n)]
        rows += [(f"t{k}|{i}", f"G{j}", float(y[i, j])) for i in range(n) for j in range(25) if y[i, j]]
    samples += [("thin", f"thin|{i}", "test" if i == 0 else "ctrl") for i in range(4)]
    rows += [(f"thin|{i}", "G0", 30.0) for i in range(4)]
    return rows, samples


def test_nb_of_all_types_equals_one_type_at_a_time(spark):
    rows, samples = by_type(np.random.default_rng(6), 5)
    counts = spark.createDataFrame(rows, "pseudobulk_id string, var_id string, count double")
    meta_ = spark.createDataFrame(samples, "cell_type string, pseudobulk_id string, condition string")
    table, sizes = nbglm.nb_wald_by_type(counts, meta_, "condition", "ctrl", "test")
    all_ = table.toPandas()
    assert {r.cell_type: r.tested for r in sizes.collect()} == {**{f"t{k}": True for k in range(5)}, "thin": False} and "thin" not in set(all_.cell_type)
    for k in (0, 1, 2):
        one = nbglm.nb_wald(counts, meta_.where(f"cell_type = 't{k}'"), "condition", "ctrl", "test").toPandas().set_index("gene").sort_index()
        got = all_[all_.cell_type == f"t{k}"].set_index("gene").sort_index()
        assert list(one.index) == list(got.index) and list(one.dispOutlier) == list(got.dispOutlier)
        for c in ("baseMean", "log2FoldChange", "lfcSE", "stat", "pvalue", "padj", "dispersion", "dispFit", "dispMAP"):
            np.testing.assert_allclose(got[c].to_numpy(), one[c].to_numpy(), rtol=2e-4, atol=1e-7)
        assert got.pvalue.idxmin() == "G0" and got.log2FoldChange["G0"] > 1


def test_size_factors_by_type_fall_back_like_the_single_ones(spark):
    rows = [("a0", "G0", 5.0), ("a1", "G1", 8.0), ("a2", "G0", 3.0), ("b0", "G0", 5.0), ("b1", "G0", 10.0), ("b1", "G1", 4.0)]
    counts = spark.createDataFrame([("a" if r[0][0] == "a" else "b", *r) for r in rows], "cell_type string, pseudobulk_id string, var_id string, count double")
    ids = [("a", f"a{i}", 4) for i in range(4)] + [("b", f"b{i}", 2) for i in range(2)]
    got = {r.pseudobulk_id: r.size_factor for r in nbglm.size_factors_by_type(counts, spark.createDataFrame(ids, "cell_type string, pseudobulk_id string, n_samples int")).collect()}
    for k, n in (("a", 4), ("b", 2)):
        part = counts.where(f"cell_type = '{k}'").drop("cell_type")
        alone = nbglm.size_factors(part, spark.createDataFrame([(f"{k}{i}",) for i in range(n)], "pseudobulk_id string"))
        for r in alone.collect():
            assert got[r.pseudobulk_id] == pytest.approx(r.size_factor, rel=1e-9)


def test_welch_matches_dense_computation(spark):
    rng = np.random.default_rng(7)
    y = rng.poisson(30, size=(6, 8)).astype(float)
    y[3:, 0] += 100
    y[1, 4] = 0
    out = pb.welch_test(long(spark, y), meta(spark, ["c"] * 3 + ["t"] * 3), "condition", "c", "t", min_count=1).toPandas().set_index("gene")
    cpm = np.log2((y + 0.5) / (y.sum(1, keepdims=True) + 0.5 * 8) * 1e6)
    a, b = cpm[:3], cpm[3:]
    for j in range(8):
        va, vb = a[:, j].var(ddof=1) / 3, b[:, j].var(ddof=1) / 3
        assert out.loc[f"G{j}", "logFC"] == pytest.approx(b[:, j].mean() - a[:, j].mean(), abs=1e-9)
        assert out.loc[f"G{j}", "t"] == pytest.approx((b[:, j].mean() - a[:, j].mean()) / np.sqrt(va + vb), rel=1e-6)
        assert out.loc[f"G{j}", "df"] == pytest.approx((va + vb) ** 2 / (va**2 / 2 + vb**2 / 2), rel=1e-6)
    assert out.logFC["G0"] > 0 and list(out.PValue) == sorted(out.PValue)
    with pytest.raises(ValueError, match="not enough"):
        pb.welch_test(long(spark, y), meta(spark, ["c"] * 5 + ["t"]), "condition", "c", "t")


def test_contrast_comparison(spark):
    t = spark.createDataFrame([("A", 1.0, 0.01), ("B", -1.0, 0.02), ("C", 0.5, 0.5)], "gene string, logFC double, PValue double")
    r = pb.compare_contrasts(t, t, top_n=2).head()
    assert r["n_common_genes"] == 3 and r["spearman_logfc"] == pytest.approx(1) and r["top_n_overlap_fraction"] == 1 and r["logfc_sign_agreement"] == 1


def test_composition_filters_samples_then_types(spark):
    cells = spark.createDataFrame([("S1", "T"), ("S1", "T"), ("S1", "B"), ("S2", "T"), ("S2", "M"), ("S3", "M"), (None, "T")], "sample_id string, cell_type string")
    got = {(r["sample_id"], r["cell_type"]): (r["n"], r["prop"]) for r in ab.composition(cells, 2, 1).collect()}
    assert {s for s, _ in got} == {"S1", "S2"} and got[("S2", "B")] == (0, 0.0) and got[("S1", "T")][1] == pytest.approx(2 / 3)


def test_covariates_and_labels(spark):
    m = spark.createDataFrame([("a", "x", 1.0, None), ("b", "y", 3.0, "k"), ("c", "x", 5.0, "l")], "sample_id string, batch string, age double, sub string")
    cov = ab.covariate_matrix(m, "batch,age")
    assert cov.columns == ["sample_id", "batch_y", "age"]
    assert sum(r["age"] for r in cov.collect()) == pytest.approx(0)
    codes = {r["sample_id"]: r["y"] for r in ab.class_labels(m, "sub", "l").collect()}
    assert codes == {"c": 0, "b": 1, "a": 2}
    with pytest.raises(ValueError, match="at least one observed event"):
        ab.survival_times(m.selectExpr("sample_id", "'5' AS t", "'0' AS e"), "t", "e")
    with pytest.raises(KeyError, match="nope"):
        ab.binary_labels(m, "nope", "x", "y")


@pytest.mark.parametrize("limit", [0, 100_000])
def test_concordance_equals_pair_count(spark, monkeypatch, limit):
    from cytoframe.functions import ordered

    monkeypatch.setattr(ordered, "SMALL_GROUP", limit)
    rng = np.random.default_rng(8)
    t, r, e = rng.integers(0, 15, 60).astype(float), rng.integers(0, 6, 60).astype(float), rng.integers(0, 2, 60)
    got = ab.concordance(spark.createDataFrame(pd.DataFrame({"time": t, "risk": r, "event": e}))).head()
    pairs = [(i, j) for i in range(60) for j in range(60) if e[i] > 0 and t[i] < t[j]]
    wins = sum(1.0 if r[i] > r[j] else 0.5 if r[i] == r[j] else 0.0 for i, j in pairs)
    assert got["comparable_pairs"] == len(pairs) and got["concordance_index"] == pytest.approx(wins / len(pairs))


def test_cox_gradient_is_the_derivative(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"id": range(40), "time": rng.permutation(40).astype(float), "event": rng.integers(0, 2, 40), "x": rng.normal(size=40)})
    df = spark.createDataFrame(pdf)
    at = lambda b: ab.cox_gradient(df, ["x"], [b], "id", l2=0.3).head()
    slope = (at(0.41)["loss"] - at(0.39)["loss"]) / 0.02
    assert at(0.4)["grad_x"] == pytest.approx(slope, rel=1e-3)
    good = spark.createDataFrame(pdf.assign(risk=-pdf.time))
    bad = spark.createDataFrame(pdf.assign(risk=pdf.time))
    assert ab.cox_nll(good, "id").head()[0] < ab.cox_nll(bad, "id").head()[0]


def test_pair_counts_sum_lines_without_grouping_orders(spark, tmp_path):
    from cytoframe.adapters import Model
    from cytoframe.suite import pseudobulk as suite

    spark.createDataFrame([(1, "A", 0), (2, "A", 1)], "c_custkey bigint, c_mktsegment string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(10, 1, "1-URGENT", "F"), (11, 1, "1-URGENT", "O"), (12, 2, "5-LOW", "F"), (12, 2, "5-LOW", "F")], "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(5, "B", "X"), (6, "C", "X")], "p_partkey bigint, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(10, 5, 1.0), (10, 5, 2.0), (11, 5, 4.0), (12, 6, 3.0), (12, 5, None)], "l_orderkey bigint, l_partkey bigint, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    counts, _ = suite.pairs(Model(spark, str(tmp_path)))
    got = {(r.pseudobulk_id, r.var_id): r["count"] for r in counts.collect()}
    assert got == {("0|1-URGENT", "B|X"): 7.0, ("1|5-LOW", "C|X"): 6.0, ("1|5-LOW", "B|X"): None}
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
