import numpy as np
import pandas as pd
import pytest

from cytoframe.functions.partials import matrix_sums
from cytoframe.operators import mil


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(0)
    counts, cov, y = rng.integers(1, 9, (6, 3)).astype(float), rng.normal(size=(6, 1)), rng.integers(0, 2, 6).astype(float)
    p = mil._start(3, 1, 1, mil.MilConfig(hidden=4, seed=3))
    p = {k: v + 0.05 for k, v in p.items()}
    f = mil._forward(p, counts, cov)
    g = mil._backward(p, f, mil._loss_gradient("binary", f["out"], y)[1])
    for name in ("e1", "e2", "av", "au", "aw", "h1", "h2", "d1"):
        at = tuple(rng.integers(0, s) for s in p[name].shape)
        values = []
        for eps in (1e-6, -1e-6):
            q = {k: v.copy() for k, v in p.items()}
            q[name][at] += eps
            values.append(mil._loss_gradient("binary", mil._forward(q, counts, cov)["out"], y)[0])
        assert g[name][at] == pytest.approx((values[0] - values[1]) / 2e-6, rel=1e-4, abs=1e-7)


def test_cox_derivatives_match_finite_differences(spark):
    rng = np.random.default_rng(1)
    n = 12
    pdf = pd.DataFrame({"sample_id": [f"s{i}" for i in range(n)], "counts": list(rng.integers(1, 9, (n, 3)).astype(float)), "cov": [[] for _ in range(n)], "time": rng.permutation(n).astype(float), "event": [1, 0] * 6})
    df = spark.createDataFrame(pdf, "sample_id string, counts array<double>, cov array<double>, time double, event int")
    p = mil._start(3, 1, 0, mil.MilConfig(hidden=4))
    got = mil._cox_derivatives(df, p).toPandas().set_index("sample_id")
    risk = mil._forward(p, np.vstack(pdf["counts"]), np.zeros((n, 0)))["out"][:, 0]
    order = np.argsort(-pdf["time"].to_numpy())

    def loss(r):
        s, e = r[order], pdf["event"].to_numpy()[order] > 0
        return -(s[e] - np.logaddexp.accumulate(s)[e]).mean()

    assert got["loss"].sum() == pytest.approx(loss(risk))
    for i in range(n):
        step = np.eye(n)[i] * 1e-6
        assert got.loc[f"s{i}", "g"] == pytest.approx((loss(risk + step) - loss(risk - step)) / 2e-6, abs=1e-6)


def test_binary_fit_separates_enriched_types(spark):
    rng = np.random.default_rng(2)
    y = np.repeat([0.0, 1.0], 10)
    counts = np.array([rng.multinomial(200, rng.dirichlet([8, 1, 1] if t else [1, 8, 1])) for t in y]).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"sample_id": [f"s{i}" for i in range(20)], "counts": list(counts), "cov": [[] for _ in y], "y": y}), "sample_id string, counts array<double>, cov array<double>, y double")
    p, history = mil.fit_mil(df, "binary", 3, cfg=mil.MilConfig(hidden=16, epochs=15, learning_rate=0.03))
    logit = mil._forward(p, counts, np.zeros((20, 0)))["out"][:, 0]
    wins = (logit[y == 1][:, None] > logit[y == 0][None, :]).mean()
    assert wins >= 0.9 and history[-1][1] < history[0][1] and mil.type_scores(p).shape == (3, 1)
    assert set(matrix_sums(df, lambda q: {"n": np.array([[len(q)]])})) == {"n"}
