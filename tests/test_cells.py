"""QC, markers and matrix operators on small fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytoframe.functions.tails import normal_p
from cytoframe.operators import markers as mk
from cytoframe.operators import matrix as mx
from cytoframe.operators import qc


def sparse(spark, x, genes=None, cells=None):
    genes = genes or [f"g{j}" for j in range(x.shape[1])]
    cells = cells or [f"c{i:03d}" for i in range(x.shape[0])]
    rows = [(cells[i], genes[j], float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    return spark.createDataFrame(rows, "obs_id string, var_id string, value double")


def test_flags_human_and_mouse(spark):
    var = spark.createDataFrame([("MT-CO1",), ("mt-Co1",), ("RPL3",), ("Rps6",), ("HBA1",), ("hbB-b1",), ("HBP1",)], "symbol string")
    human = {r["symbol"]: (r["mt_gene"], r["ribo_gene"], r["hb_gene"]) for r in qc.gene_flags(var).collect()}
    assert human["mt-Co1"] == (True, False, False) and human["Rps6"] == (False, True, False)
    assert human["HBA1"][2] and not human["HBP1"][2]
    mouse = {r["symbol"]: (r["mt_gene"], r["ribo_gene"], r["hb_gene"]) for r in qc.gene_flags(var, "mouse").collect()}
    assert mouse["mt-Co1"][0] and not mouse["MT-CO1"][0] and mouse["hbB-b1"][2] and not mouse["RPL3"][1]


def test_qc_flags_against_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.poisson(3.0, size=(120, 12)).astype(float)
    x[0] = 0
    x[1, 3:] = 0
    x[2, 0] = 90
    obs = spark.createDataFrame([(f"c{i:03d}", "s1" if i % 3 else "s2") for i in range(120)], "obs_id string, sample_id string")
    var = spark.createDataFrame([(f"g{j}", n) for j, n in enumerate(["MT-A", "RPL1", "HBA1"] + [f"X{j}" for j in range(9)])], "var_id string, symbol string")
    cells, summary = qc.flag_cells(qc.basic_metrics(obs, sparse(spark, x), qc.gene_flags(var)))
    got = cells.orderBy("obs_id").toPandas()
    assert len(got) == 120 and got.loc[0, "total_counts"] == 0 and got.loc[0, "pct_counts_mt"] == 0
    total, genes = x.sum(1), (x > 0).sum(1)
    mt = 100 * x[:, 0] / np.maximum(total, 1)
    lt, lg = np.log10(total + 1), np.log10(genes + 1)
    sample = np.array(["s1" if i % 3 else "s2" for i in range(120)])
    for s in ("s1", "s2"):
        m = sample == s
        med = lambda v: np.median(v[m])
        mad = lambda v: max(1.4826 * np.median(np.abs(v[m] - np.median(v[m]))), 1e-9)
        low = (lt[m] < med(lt) - 3 * mad(lt)) & (lt[m] < np.quantile(lt[m], 0.1))
        few = (lg[m] < med(lg) - 3 * mad(lg)) & (lg[m] < np.quantile(lg[m], 0.1))
        high = (mt[m] > med(mt) + 3 * mad(mt)) & (mt[m] > np.quantile(mt[m], 0.9))
        np.testing.assert_array_equal(got.loc[m, "qc_low_counts_flag"], low)
        np.testing.assert_array_equal(got.loc[m, "qc_high_mt_flag"], high)
        np.testing.assert_array_equal(got.loc[m, "qc_class"] == "fail", (low & few) | (high & few) | (high & low))
    assert got.loc[0, "qc_failure_reason"].startswith("low_counts;low_genes")
    assert {r["sample_id"]: r["n_obs"] for r in summary.collect()} == {"s1": 80, "s2": 40}


def test_cosg_recovers_markers_and_matches_dense(spark):
    x = np.array([[5, 0, 1, 0], [6, 0, 1, 0], [0, 4, 1, 3], [0, 5, 1, 2], [4, 0, 2, 0], [0, 6, 1, 1]], dtype=float)
    lab = np.array(list("AABBAB"))
    labels = spark.createDataFrame([(f"c{i:03d}", lab[i]) for i in range(6)], "obs_id string, grp string")
    got = mk.cosg(sparse(spark, x, ["GA", "GB", "HOUSE", "B2"]), labels, top_n=4, min_pct=0.0).toPandas()
    assert got[(got.grp == "A") & (got["rank"] == 1)].gene.item() == "GA"
    assert got[(got.grp == "B") & (got["rank"] == 1)].gene.item() == "GB"
    for r in got.itertuples():
        j, m = ["GA", "GB", "HOUSE", "B2"].index(r.gene), lab == r.grp
        assert r.score == pytest.approx(x[m, j].sum() / (np.linalg.norm(x[:, j]) * np.sqrt(m.sum())))
        assert r.pct_out == pytest.approx((x[~m, j] > 0).mean()) and r.mean_in == pytest.approx(x[m, j].mean())
    assert len(got) == 8


def test_rank_sum_matches_definition(spark):
    rng = np.random.default_rng(3)
    x = rng.poisson(1.0, size=(40, 5)).astype(float)
    lab = np.where(np.arange(40) < 15, "A", "B")
    labels = spark.createDataFrame([(f"c{i:03d}", str(lab[i])) for i in range(40)], "obs_id string, grp string")
    got = mk.rank_sum_z(sparse(spark, x), labels).toPandas()
    for r in got.itertuples():
        j, m = int(r.var_id[1:]), lab == r.grp
        rank = pd.Series(x[:, j]).rank().to_numpy()
        n1, n2 = m.sum(), (~m).sum()
        z = (rank[m].sum() - n1 * (n1 + n2 + 1) / 2) / np.sqrt(n1 * n2 * (n1 + n2 + 1) / 12)
        assert r.z == pytest.approx(z)
    p = spark.createDataFrame([(1.959963985,), (0.0,)], "z double").select(normal_p("z").alias("p")).collect()
    assert p[0]["p"] == pytest.approx(0.05, abs=1e-9) and p[1]["p"] == 1.0


def test_clip_uses_implicit_zeros(spark):
    x = np.zeros((10, 2))
    x[0] = [10, 4]
    obs = spark.createDataFrame([(f"c{i:03d}",) for i in range(10)], "obs_id string")
    var = spark.createDataFrame([("g0",), ("g1",)], "var_id string")
    got = mx.clip_at_quantile(sparse(spark, x), obs, var, 0.95).agg(F.max("value")).head()[0]
    assert got == pytest.approx(np.quantile(x, 0.95))
    dense = x / np.where(x.std(0, ddof=1) > 0, x.std(0, ddof=1), 1)
    scaled = mx.scale_no_center(sparse(spark, x), obs).agg(F.max("value")).head()[0]
    assert scaled == pytest.approx(dense.max())


def test_negative_values_fail(spark):
    bad = spark.createDataFrame([("c", "g", -1.0)], "obs_id string, var_id string, value double")
    with pytest.raises(Exception, match="negative value"):
        mx.require_nonnegative(bad).collect()


def test_identical_matrices_agree(spark):
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(size=(5, 4)))
    a, b = sparse(spark, x), sparse(spark, x + 1e-4)
    r = mx.compare_matrices(a, b, F.lit(20)).head()
    assert r["cosine"] > 0.999 and r["pearson"] > 0.999 and r["mean_abs"] == pytest.approx(1e-4)
