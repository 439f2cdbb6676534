import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytoframe.operators import cnv


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.poisson(5, size=(360, 30)).astype(float)
    x[:80, 15:] *= 2
    genes = [f"G{i:04d}" for i in range(360)]
    raw = pd.DataFrame({
        "hgnc_symbol": genes, "chromosome_name": [str(i // 90 + 1) for i in range(360)], "start_position": [(i % 90) * 1000 + 1 for i in range(360)],
        "end_position": [(i % 90) * 1000 + 101 for i in range(360)], "gene_biotype": "protein_coding", "chr_arm": ["p" if i % 90 < 45 else "q" for i in range(360)],
    })
    expr = [(f"cell{j:03d}", genes[i], float(x[i, j])) for i in range(360) for j in range(30) if x[i, j]]
    obs = [(f"cell{j:03d}", "normal" if j < 15 else "tumor", "s1" if j < 15 else "s2") for j in range(30)]
    return (
        x, spark.createDataFrame(expr, "obs_id string, var_id string, value double"), cnv.normalize_coordinates(spark.createDataFrame(raw)),
        spark.createDataFrame(obs, "obs_id string, annot string, sample_id string"),
    )


CFG = cnv.CnvConfig(window_size=20, window_step=5, top_n_genes=120, cluster_k=2)


def test_single_sample_run_matches_dense_numpy(data):
    x, expr, coords, obs = data
    run = cnv.run_cnv(expr, coords, obs, "annot", "normal", CFG, by_sample=False)
    avg = x[:, :15].mean(axis=1)
    order = np.lexsort((np.arange(360), -avg))
    top, head = order[:120], order[:200]
    mult = np.bincount(np.concatenate([top, head, head]), minlength=360)
    v = np.log2(1 + x)
    v = v - (v * mult[:, None]).sum(0) / mult.sum()
    v = np.clip(v - v[:, :15].mean(1, keepdims=True), -3, 3)
    windows = {}
    for c in range(4):
        for arm, lo in (("p", 0), ("q", 45)):
            g = [i for i in range(c * 90 + lo, c * 90 + lo + 45) if i in set(top)]
            if len(g) > 20:
                for n, mid in enumerate(range(10, len(g) - 10, 5), start=1):
                    windows[f"{c + 1}.{arm}{n}"] = g[mid - 10 : mid + 11]
            elif g:
                windows[f"{c + 1}.{arm}1"] = g
    assert run.window_names == list(windows)
    score = np.array([v[g].mean(axis=0) for g in windows.values()])
    low, high = np.quantile(score[:, :15], [0.01, 0.99], axis=1)
    np.testing.assert_allclose(run.low, low)
    trimmed = np.where((score >= low[:, None]) & (score <= high[:, None]), 0.0, score)
    got = run.cells.orderBy("obs_id").toPandas()
    np.testing.assert_allclose(np.vstack(got["scores"]), score.T, atol=1e-10)
    np.testing.assert_allclose(got["cnv_fraction"], (trimmed != 0).mean(axis=0))
    assert got["22.q_CNV"].eq(0).all() and got["22.q_CNV_classification"].eq("no_alteration").all()
    assert got.loc[15:, "cnv_fraction"].mean() > got.loc[:14, "cnv_fraction"].mean()


def test_pooled_run_and_clusters(data):
    _, expr, coords, obs = data
    run = cnv.run_cnv(expr, coords, obs, "annot", ["normal"], CFG)
    lab = cnv.cluster_cells(run.cells, run.window_names, CFG).toPandas()
    assert len(lab) == 30 and lab.groupby("sample_id").cnv_cluster.min().eq(1).all()
    many = cnv.cluster_cells(run.cells, run.window_names, cnv.CnvConfig(window_size=20, window_step=5, top_n_genes=120, cluster_nodes=6)).toPandas()
    assert sorted(many.obs_id) == sorted(lab.obs_id)


@pytest.mark.parametrize("rows", [1, 2, 7, 400])
def test_window_quantiles_are_exact(spark, rows):
    """Ties, both zeros, tiny and extreme values, several groups; any order of rows and any number of tasks."""
    rng = np.random.default_rng(rows)
    x = np.stack([rng.normal(0, 0.05, rows), rng.choice([0.0, -0.0, 1e-12, -1e-12], rows), np.round(rng.normal(size=rows), 1), np.clip(rng.normal(0, 5, rows), -3, 3), rng.normal(0, 1e-7, rows)], axis=1)
    grp = rng.choice(["", "=a", "=b"], rows)
    cells = spark.createDataFrame([(str(g), [float(v) for v in r]) for g, r in zip(grp, x, strict=True)], "grp string, scores array<double>").repartition(5)
    got = cnv.window_quantiles(cells, {"lo": 0.01, "mid": 0.5, "hi": 0.93}).toPandas()
    assert len(got) == 5 * len(set(grp))
    for r in got.itertuples():
        np.testing.assert_allclose([r.lo, r.mid, r.hi], np.quantile(x[grp == r.grp, r.w], [0.01, 0.5, 0.93]), rtol=1e-12, atol=1e-15)


def test_rank_bins_never_fall():
    v = np.sort(np.concatenate([np.random.default_rng(0).normal(0, s, 300) for s in (1e-12, 1e-4, 1, 100)] + [[0.0, -0.0, 3.0, -3.0]]))
    b = cnv.rank_bins(v)
    assert (np.diff(b) >= 0).all() and b.min() >= 0 and b.max() < cnv.BINS


def test_group_limits_are_medians_over_groups(spark):
    rng = np.random.default_rng(9)
    x, grp = rng.normal(size=(90, 3)), np.array([None, "u", "v"], dtype=object)[np.arange(90) % 3]
    cells = spark.createDataFrame([(i, "s", [float(v) for v in r]) for i, r in enumerate(x)], "obs_id long, sample_id string, scores array<double>")
    groups = spark.createDataFrame([(i, g) for i, g in enumerate(grp)], "obs_id long, grp string")
    low, high, strict = cnv.window_limits(cells, None, 0.1, groups)
    each = np.array([np.quantile(x[np.arange(90) % 3 == k], [0.1, 0.9], axis=0) for k in range(3)])
    np.testing.assert_allclose([low, high], np.median(each, axis=0))
    assert strict


def test_split_nodes_keeps_equal_rows_and_halves_the_widest():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 0.01, (40, 3)), rng.normal(9, 0.01, (20, 3)), np.full((30, 3), 4.0)])
    two = cnv.split_nodes(x, np.ones(90), 3)
    assert len({tuple(two[a:b]) for a, b in ((0, 40), (40, 60), (60, 90))}) == 3 and len(set(two)) == 3
    every = cnv.split_nodes(x, np.ones(90), 500)
    assert len(set(every)) == 61 and len(set(every[60:])) == 1
    assert len(set(cnv.split_nodes(np.array([[0.1 + 0.2], [0.3]]), np.ones(2), 9))) == 2


def test_clusters_over_many_lanes_find_the_planted_profiles(spark, monkeypatch):
    """The same tree with one lane and with many, well above the number of nodes: planted groups stay together."""
    rng = np.random.default_rng(2)
    names = [f"{c}.{a}{i}" for c in (1, 2, 3) for a in "pq" for i in (1, 2)]
    profile = np.array([[1, 0, 0], [0, -1, 0], [0, 0.5, 1.5]])[np.arange(600) % 3].repeat(4, axis=1) + rng.normal(0, 0.05, (600, 12))
    cells = spark.createDataFrame([(i, "s1" if i < 560 else "s2", [float(v) for v in r]) for i, r in enumerate(profile)], "obs_id long, sample_id string, trimmed array<double>")
    cfg = cnv.CnvConfig(cluster_nodes=20, cluster_k=3)
    for rows in (20_000, 60):
        monkeypatch.setattr(cnv, "LANE_ROWS", rows)
        lab = cnv.cluster_cells(cells, names, cfg).toPandas().sort_values("obs_id")
        assert len(lab) == 600
        for _, part in lab.groupby("sample_id"):
            assert len(set(zip(part.obs_id % 3, part.cnv_cluster, strict=True))) == 3 == part.cnv_cluster.nunique()


def test_first_match_for_duplicate_names(spark):
    df = spark.createDataFrame([("G1", 1, 3, 0), ("G1", 10, 30, 1), ("G2", 5, 7, 2)], "g string, a int, b int, pos int")
    got = {r["g"]: (r["a"], r["b"]) for r in cnv.first_per_key(df, "g", "pos").collect()}
    assert got == {"G1": (1, 3), "G2": (5, 7)}


def test_reference_rules_and_thresholds(spark):
    obs = spark.createDataFrame(
        [(f"c{i}", "s", t, s) for i, (t, s) in enumerate([("T", "x"), ("Myeloid", "x"), ("Odd", "x"), ("B", "normal"), ("Epithelial", "normal"), ("Epithelial", "tumor"), ("Epithelial", "tumor"), ("Epithelial", None)])],
        "obs_id string, sample_id string, cell_type_lvl1 string, tumor_status string",
    )
    pool = cnv.reference_pool(obs, status="tumor_status")
    plan = cnv.reference_plan(pool, 5).head()
    assert (plan["n_normal_nonparenchymal"], plan["n_normal_parenchymal"], plan["n_candidate_cells"]) == (4, 1, 3) and plan["should_run"]
    assert not cnv.reference_plan(pool, 20).head()["should_run"]

    def evidence(n):
        rows = [(f"r{i}", "normal_x", i / 100) for i in range(n)] + [("t", "candidate_tumor_or_mixed", 0.9), ("u", "candidate_tumor_or_mixed", 0.0), ("v", "candidate_tumor_or_mixed", None)]
        return cnv.tumour_evidence(spark.createDataFrame(rows, "obs_id string, reference_pool string, cnv_fraction double")).toPandas().set_index("obs_id")

    few, enough = evidence(9), evidence(10)
    assert few.normal_threshold.iloc[0] == pytest.approx(np.quantile([i / 100 for i in range(9)] + [0.9, 0.0], 0.75))
    ref = np.arange(10) / 100
    assert enough.normal_threshold.iloc[0] == pytest.approx(max(np.quantile(ref, 0.99), np.median(ref) + 3 * 1.4826 * np.median(np.abs(ref - np.median(ref)))))
    assert enough.tumor_evidence["t"] == "cnv_tumor_like" and enough.tumor_evidence["u"] == "cnv_normal_like" and enough.tumor_evidence["v"] == "cnv_indeterminate"


def test_ward_merges_obvious_groups():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 0.1, (6, 4)), rng.normal(5, 0.1, (7, 4)), rng.normal(-5, 0.1, (4, 4))])
    merges = cnv.ward_merges(x, np.ones(17))
    lab = cnv.cut_merges(merges, 17, 3)
    assert [len(set(lab[a:b])) for a, b in ((0, 6), (6, 13), (13, 17))] == [1, 1, 1] and len(set(lab)) == 3
    assert cnv.elbow_k(x, np.ones(17), merges) >= 2
    assert list(cnv.merge_similar(np.array([[1.0, 2, 3], [2, 4, 6.1], [3, 1, 0]]), np.array([1, 2, 3]), np.ones(3), 0.98)) == [1, 1, 2]


def test_bad_config():
    with pytest.raises(ValueError):
        cnv.CnvConfig(threshold_percentile=0.7)


def test_halving_a_large_lane_copies_a_slab_and_not_the_lane(monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 400))
    whole = cnv.split_nodes(x[:300], np.ones(300), 20)
    monkeypatch.setattr(cnv, "SLAB", 20_000)
    assert (cnv.split_nodes(x[:300], np.ones(300), 20) == whole).all()
    tracemalloc.start()
    cnv.split_nodes(x, np.ones(3000), 4)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < x.nbytes / 4
