import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytoframe.functions import ordered as od
from cytoframe.functions.tails import beta_tail, log_gamma, t_two_sided, trigamma


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows and one value is heavily repeated."""
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": np.where(rng.random(3000) < 0.7, "hot", rng.choice(list("abc"), 3000)), "x": rng.normal(size=3000).round(3), "id": np.arange(3000)})
    pdf.loc[rng.random(3000) < 0.3, "x"] = 0.25
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("limit", [0, None])
def test_quantiles_match_numpy(skewed, limit):
    pdf, df = skewed
    probs = {"a": 0.05, "b": 0.5, "c": 0.913}
    got = {r["g"]: r for r in od.exact_quantiles(df, ["g"], "x", probs, small_group=limit).collect()}
    for g, part in pdf.groupby("g"):
        for k, p in probs.items():
            assert got[g][k] == pytest.approx(np.quantile(part["x"], p), abs=1e-12)
    whole = od.exact_quantiles(df, [], "x", {"m": 0.5}, small_group=limit).head()["m"]
    assert whole == pytest.approx(np.median(pdf["x"]))


@pytest.mark.parametrize("limit", [0, None])
def test_weighted_zero_block(spark, limit):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (5.0, 1), (0.0, 7)], "x double, w bigint")
    got = od.exact_quantiles(df, [], "x", {"m": 0.5, "t": 0.95}, weight="w", small_group=limit).head()
    dense = [0.0] * 7 + [1.0, 2.0, 5.0]
    assert got["m"] == 0.0 and got["t"] == pytest.approx(np.quantile(dense, 0.95))


def _bh(p):
    order = np.argsort(p)
    adj = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
    out = np.empty(len(p))
    out[order] = np.clip(adj, 0, 1)
    return out


@pytest.mark.parametrize("limit", [0, None])
def test_step_up_with_ties(spark, limit):
    rng = np.random.default_rng(1)
    p = np.concatenate([rng.random(400).round(2), np.ones(200), [1e-8, 0.03, 0.001, 0.02, 0.5]])
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(p)), "p": p}))
    got = od.benjamini_hochberg(df, "p", small_group=limit).orderBy("id").toPandas()["padj"]
    np.testing.assert_allclose(got, _bh(p), atol=1e-12)


def test_step_up_skips_missing(spark):
    df = spark.createDataFrame([(1, 0.01), (2, None), (3, 0.5)], "id int, p double")
    got = {r["id"]: r["padj"] for r in od.benjamini_hochberg(df, "p").collect()}
    assert got[2] is None and got[1] == pytest.approx(0.02)


@pytest.mark.parametrize("limit", [0, None])
def test_running_sums_respect_tiebreak(skewed, limit):
    pdf, df = skewed
    got = od.running_sums(df, ["g"], "x", {"s": F.col("id").cast("bigint")}, tiebreak="id", small_group=limit).toPandas().sort_values("id")
    ref = pdf.sort_values(["x", "id"]).assign(s=lambda d: d.groupby("g")["id"].cumsum()).sort_values("id")
    np.testing.assert_array_equal(got["s"], ref["s"])


def test_average_ranks(skewed):
    pdf, df = skewed
    got = od.average_ranks(df, ["g"], "x", small_group=0).toPandas()
    ref = pdf.assign(r=pdf.groupby("g")["x"].rank())[["g", "x", "r"]].drop_duplicates()
    both = got.merge(ref, on=["g", "x"])
    assert len(both) == len(ref)
    np.testing.assert_allclose(both["avg_rank"], both["r"])


def test_tails():
    import math

    x = np.array([0.3, 1.0, 5.5, 80.0])
    np.testing.assert_allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)
    assert trigamma(1.0) == pytest.approx(math.pi**2 / 6, rel=1e-10)
    # Student t with 1 df is Cauchy; with 2 df the tail has a closed form.
    t = np.array([0.5, 1.0, 3.0])
    np.testing.assert_allclose(t_two_sided(t, np.ones(3)), 1 - 2 * np.arctan(t) / np.pi, rtol=1e-10)
    np.testing.assert_allclose(t_two_sided(t, np.full(3, 2.0)), 1 - t / np.sqrt(2 + t * t), rtol=1e-10)
    assert beta_tail(2.0, 3.0, 0.4) == pytest.approx(0.5248, abs=1e-10)
