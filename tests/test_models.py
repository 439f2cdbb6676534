"""Embedding, graph and factorisation kernels against numpy."""

import hashlib
from itertools import permutations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytoframe.operators import embed, graph, programs as pg


def vectors(spark, x):
    return spark.createDataFrame([(int(i), [float(a) for a in row]) for i, row in enumerate(x)], "obs_id bigint, v array<double>")


def matrix(df):
    return np.vstack(df.orderBy("obs_id").toPandas()["v"])


def test_pca_matches_svd(spark):
    x = np.random.default_rng(0).normal(size=(60, 6)) @ np.diag([5, 3, 2, 1, 1, 1]) + 7
    scores, load, ratio = embed.pca(vectors(spark, x), 3)
    c = x - x.mean(0)
    u, s, vt = np.linalg.svd(c, full_matrices=False)
    np.testing.assert_allclose(np.abs(matrix(scores)), np.abs(c @ vt[:3].T), atol=1e-8)
    assert embed.subspace_cosine(scores, scores.withColumn("v", F.transform("v", lambda a: -a))) == pytest.approx(1.0)


def test_expression_correction_equals_cluster_loop(spark):
    rng = np.random.default_rng(1)
    x, r = np.abs(rng.normal(3, 1, (40, 5))), rng.dirichlet(np.ones(3), 40)
    batch = np.array(["a", "b"])[rng.integers(0, 2, 40)]
    obs = spark.createDataFrame([(i, str(b)) for i, b in enumerate(batch)], "obs_id bigint, batch string")
    mem = vectors(spark, r).withColumnRenamed("v", "r")
    got = matrix(embed.correct_expression(vectors(spark, x), mem, obs, ["batch"], 1.0))
    phi = np.vstack([np.ones(40), batch == "a", batch == "b"]).astype(float)
    lam, want = np.array([0.0, 1.0, 1.0]), x.copy()
    for k in range(3):
        pr = phi * r[:, k]
        w = np.linalg.solve(pr @ phi.T + lam, pr @ x)
        w[0] = 0
        want -= pr.T @ w
    np.testing.assert_allclose(got, np.maximum(want, 0), atol=1e-9)


def test_harmony_moves_batches_together(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 0.3, (45, 3)) for c in ([4, 0, 0], [0, 4, 0])])
    batch = np.tile(["a", "b"], 45)
    x[batch == "b"] += [0, 0, 1.5]
    obs = spark.createDataFrame([(i, str(b)) for i, b in enumerate(batch)], "obs_id bigint, batch string")
    z = matrix(embed.harmony(vectors(spark, x), obs, ["batch"], max_iter=3)[0])
    gap = lambda m: np.linalg.norm(m[batch == "a"].mean(0) - m[batch == "b"].mean(0))
    assert gap(z) < 0.4 * gap(x)
    same, none = embed.harmony(vectors(spark, x), obs.withColumn("batch", F.lit("z")), ["batch"])
    assert none is None and np.allclose(matrix(same), x)


@pytest.mark.parametrize("leaf, chunk", [(2000, 4096), (20, 4096), (8, 5)])
def test_neighbours_by_tree_of_cells(spark, monkeypatch, leaf, chunk):
    """One and two levels of pivots, leaves of one row and leaves cut into chunks: the same neighbours as by brute force."""
    monkeypatch.setattr(graph, "TOP", 6)
    monkeypatch.setattr(graph, "LEAF", leaf)
    monkeypatch.setattr(graph, "CHUNK", chunk)
    monkeypatch.setattr(graph, "QUERIES", 150)
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(c, 0.3, (n, 3)) for c, n in ((0, 220), (4, 150), (9, 25))] + [[[50.0, 50, 50]], [[50.0, 51, 50]]])
    got = graph.nearest_neighbours(vectors(spark, x), 5).toPandas().sort_values(["obs_id", "rank"])
    assert len(got) == 5 * len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for i, part in got.groupby("obs_id"):
        order = [j for j in np.lexsort((np.arange(len(x)), d[i])) if j != i][:5]
        assert list(part.neighbour_id) == order


def test_few_points_have_fewer_neighbours(spark):
    got = graph.nearest_neighbours(vectors(spark, np.array([[0.0], [1.0], [3.0]])), 5).toPandas()
    assert sorted(zip(got.obs_id, got.neighbour_id, strict=True)) == [(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]


def test_trend_follows_a_smooth_curve(spark):
    m = np.logspace(-1, 2, 300)
    pdf = pd.DataFrame({"b": "x", "var_id": np.arange(300), "mean": m, "var_samp": m + 0.1 * m**2})
    fit = embed.mean_variance_trend(spark.createDataFrame(pdf), "b").toPandas().sort_values("var_id")
    assert np.abs(fit["fit"].to_numpy() - np.log10(pdf["var_samp"].to_numpy())).max() < 0.02


@pytest.mark.parametrize("chunk", [4096, 16])
def test_neighbours_match_brute_force_with_copies(spark, monkeypatch, chunk):
    monkeypatch.setattr(graph, "CHUNK", chunk)
    monkeypatch.setattr(graph, "QUERIES", 40 if chunk == 16 else 50_000)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 4))
    x[30:60] = x[30]
    got = graph.nearest_neighbours(vectors(spark, x), 4).toPandas().sort_values(["obs_id", "rank"])
    for i in range(90):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(90), d)) if j != i][:4]
        part = got[got.obs_id == i]
        assert list(part.neighbour_id) == order
        np.testing.assert_allclose(part.dist, d[order], atol=1e-12)


def test_a_query_is_written_once_however_many_leaves_it_visits(spark, monkeypatch):
    """Vectors of many dimensions visit every leaf; no table of the search grows with the leaves."""
    monkeypatch.setattr(graph, "CHUNK", 20)
    monkeypatch.setattr(graph, "QUERIES", 100)
    counts, cut = [], graph.cut

    def counted(df):
        out = cut(df)
        counts.append(out.count())
        return out

    monkeypatch.setattr(graph, "cut", counted)
    x = np.random.default_rng(5).normal(size=(400, 24)) + 1000.0
    got = graph.nearest_neighbours(vectors(spark, x), 5).toPandas().sort_values(["obs_id", "rank"])
    assert max(counts) == 400
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    assert (got.neighbour_id.to_numpy().reshape(400, 5) == d.argsort(axis=1)[:, :5]).all()


def test_split_communities_are_the_same_in_a_task_and_as_joins(spark, monkeypatch):
    """Communities of a ring with low resolution fall apart; the whole run in a task gives the labels of the joins."""
    rng = np.random.default_rng(8)
    pairs = {(int(a), int(b)) for a, b in rng.integers(0, 150, (260, 2)) if a != b}
    pairs |= {(b, a) for a, b in pairs}
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src bigint, dst bigint, weight double")
    rows = lambda x: sorted(map(tuple, x.to_numpy().tolist()))
    seen = []
    real = graph._connected
    monkeypatch.setattr(graph, "_connected", lambda *a: seen.append(1) or real(*a))
    a = rows(graph.communities(edges, [(0.2, 0), (1.0, 3)]).toPandas())
    assert not seen
    monkeypatch.setattr(graph, "TASK_EDGES", 100)
    assert a == rows(graph.communities(edges, [(0.2, 0), (1.0, 3)]).toPandas()) and seen


def test_no_round_of_harmony_writes_memberships(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    obs = spark.createDataFrame([(i, str(i % 3)) for i in range(300)], "obs_id bigint, batch string")
    columns, cut = [], embed.cut
    monkeypatch.setattr(embed, "cut", lambda df: columns.append(df.columns) or cut(df))
    _, r = embed.harmony(vectors(spark, x), obs, ["batch"], max_iter=2)
    assert columns and not any("r" in c for c in columns)
    weights = np.vstack(r.toPandas()["r"])
    assert weights.shape == (300, 10) and np.allclose(weights.sum(axis=1), 1.0)


def test_manifest_hashes_large_files_in_pieces(spark, tmp_path, monkeypatch):
    from cytoframe.sources import sinks

    monkeypatch.setattr(sinks, "WHOLE", 1000)
    sent = {"small.bin": b"ab", "deep/large one.bin": bytes(range(256)) * 50, "manifest.json": b"{}"}
    (tmp_path / "deep").mkdir()
    for name, data in sent.items():
        (tmp_path / name).write_bytes(data)
    plan = sinks.file_manifest(spark, str(tmp_path))
    got = {r.path: (r.bytes, r.sha256) for r in plan.collect()}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in sent.items() if n != "manifest.json"}
    assert "_hashed" in plan._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def cliques(spark):
    rows = []
    for c in range(6):
        ids = range(c * 8, c * 8 + 8)
        rows += [(i, j, 1.0) for i in ids for j in ids if i != j]
        a, b = c * 8, ((c + 1) % 6) * 8
        rows += [(a, b, 0.5), (b, a, 0.5)]
    return spark.createDataFrame(rows, "src bigint, dst bigint, weight double")


def planted(spark, groups, size, seed):
    """Dense random groups with a few links between them; (edges, group of each node)."""
    rng = np.random.default_rng(seed)
    member = np.repeat(np.arange(groups), size)
    inner = np.concatenate([g * size + np.stack([rng.integers(0, size, 10 * size), rng.integers(0, size, 10 * size)]) for g in range(groups)], axis=1)
    outer = rng.integers(0, groups * size, (2, groups * size // 2))
    pairs = {(int(a), int(b)) for a, b in np.concatenate([inner, outer], axis=1).T if a != b}
    pairs |= {(b, a) for a, b in pairs}
    return spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src bigint, dst bigint, weight double"), member


def test_communities_find_cliques(cliques):
    lab = graph.communities(cliques, [(1.0, 0)]).toPandas().sort_values("obs_id")
    assert len(lab) == 48 and lab.label.nunique() == 6
    assert all(lab.label.iloc[c * 8 : c * 8 + 8].nunique() == 1 for c in range(6))


@pytest.mark.parametrize("groups, size", [(5, 60), (8, 500)])
def test_planted_groups_at_two_sizes_and_many_jobs(spark, groups, size):
    edges, member = planted(spark, groups, size, 1)
    lab = graph.communities(edges, [(0.7, 0), (1.0, 0), (1.0, 5)]).toPandas()
    assert len(lab) == 3 * groups * size
    for _, part in lab.groupby(["resolution", "seed"]):
        found = set(zip(part.label, member[part.obs_id], strict=True))
        assert len(found) == groups and set(part.label) == set(range(groups))
        first = part.groupby("label").agg(n=("obs_id", "size"), low=("obs_id", "min")).reset_index()
        assert first.sort_values(["n", "low"], ascending=[False, True]).label.tolist() == list(range(groups))


def test_labels_do_not_depend_on_partitions_or_on_where_rounds_run(spark, monkeypatch):
    """The rounds as joins and the rounds in a task give one and the same labels, also where moving is far from certain."""
    edges, _ = planted(spark, 6, 40, 2)
    a = graph.communities(edges.repartition(1), [(3.0, 1), (1.0, 4)]).toPandas()
    b = graph.communities(edges.repartition(7, "dst"), [(3.0, 1), (1.0, 4)]).toPandas()
    monkeypatch.setattr(graph, "TASK_EDGES", 600)
    c = graph.communities(edges, [(3.0, 1), (1.0, 4)]).toPandas()
    rows = lambda x: sorted(map(tuple, x.to_numpy().tolist()))
    assert rows(a) == rows(b) == rows(c) and len(a) == 480


def test_settle_ends_in_one_community_or_none_moves():
    """Levels of one node, where a half of the nodes is empty, and nodes that only have loops."""
    src, dst = np.array([0, 1, 1, 2, 0, 2]), np.array([1, 0, 2, 1, 2, 0])
    for seed in range(20):
        h, t = (np.random.default_rng(seed + x).integers(-(1 << 62), 1 << 62, 3) for x in (0, 100))
        assert len(set(graph.settle(src, dst, np.ones(6), h, t, 0.1, 6.0, 20, 0.005))) == 1
        assert graph.settle(np.arange(3), np.arange(3), np.ones(3), h, t, 1.0, 3.0, 20, 0.005).tolist() == [0, 1, 2]


def test_communities_are_connected(spark):
    """Two pairs held together by a node that prefers a third group: no community falls apart."""
    edges, _ = planted(spark, 10, 30, 4)
    lab = graph.communities(edges, [(0.3, 0), (2.0, 0)]).toPandas()
    links = edges.toPandas()
    for _, part in lab.groupby("resolution"):
        of = dict(zip(part.obs_id, part.label, strict=True))
        root = {i: i for i in of}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in zip(links.src, links.dst, strict=True):
            if of[a] == of[b]:
                root[find(a)] = find(b)
        assert len({find(i) for i in of}) == part.label.nunique()


def test_cluster_search_marks_one_resolution(cliques):
    labels, sweep, stability = graph.cluster_search(cliques, (0.5, 1.0, 1.5), (0, 1))
    rows = stability.collect()
    assert sum(r["chosen"] for r in rows) == 1 and {r["phase"] for r in sweep.collect()} == {"coarse", "refine"}
    assert labels.count() == 48
    assert graph.resolution_neighbourhood(1.0, 0.5, 1.25, 0.25, 0.125) == [0.75, 0.875, 1.0, 1.125, 1.25]


def test_agreement_of_relabelled_partition(spark):
    df = spark.createDataFrame([(i % 3, "abc"[i % 3]) for i in range(30)], "a int, b string")
    r = graph.partition_agreement(df).head()
    assert r["ari"] == pytest.approx(1.0) and r["nmi"] == pytest.approx(1.0)


def test_factorisation_recovers_low_rank(spark):
    rng = np.random.default_rng(4)
    x = rng.gamma(1, 1, (50, 3)) @ rng.gamma(1, 1, (3, 8))
    rows = vectors(spark, x)
    for init in ("random", "nndsvda"):
        spectra, errors = pg.factorize(rows, [(3, 0), (2, 0)], max_iter=40, tol=1e-7, init=init)
        assert spectra[(3, 0)].shape == (3, 8) and errors[(3, 0)] < 0.05 * np.linalg.norm(x) and errors[(2, 0)] > errors[(3, 0)]
    w = matrix(pg.usage(rows, spectra[(3, 0)]))
    assert np.linalg.norm(x - w @ spectra[(3, 0)]) == pytest.approx(errors[(3, 0)], rel=0.3, abs=1e-2)
    with pytest.raises(ValueError):
        pg.factorize(vectors(spark, -x), [(2, 0)])


def test_nonnegative_rows_meet_optimality():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(20, 4)), rng.normal(size=(6, 20))
    w = pg.nonnegative_rows(b @ a, a.T @ a, sweeps=500, tol=1e-12)
    grad = w @ (a.T @ a) - b @ a
    assert (w >= 0).all() and (grad > -1e-7).all() and np.abs(grad[w > 0]).max() < 1e-6


def test_assignment_is_optimal():
    rng = np.random.default_rng(6)
    for n, m in ((4, 4), (3, 5), (5, 3)):
        g = rng.random((n, m))
        got = sum(g[i, j] for i, j in pg.assign_optimal(g))
        big = g if n <= m else g.T
        best = max(sum(big[i, p[i]] for i in range(big.shape[0])) for p in permutations(range(big.shape[1]), big.shape[0]))
        assert got == pytest.approx(best)


def test_stability_and_choice(spark):
    base = np.eye(3, 6) + 0.01
    assert pg.stability(np.vstack([base, base[::-1], base]), 3) == pytest.approx(1.0)
    assert pg.stability(base, 3) == 1.0
    s = spark.createDataFrame([(5, 0.6, 3.0), (8, 0.8, 2.0), (10, 0.9, 1.0)], "k int, median_stability double, median_error double")
    assert pg.choose_k(s) == 8 and pg.choose_k(s, 0.95) == 10


def test_permuted_programs_are_matched(spark):
    rng = np.random.default_rng(7)
    s, u = rng.random((2, 3)), rng.random((4, 2))
    long = lambda m, names: spark.createDataFrame([(names[i], f"g{j}", float(m[i, j])) for i in range(2) for j in range(3)], "program string, var_id string, w double")
    use = lambda m, names: spark.createDataFrame([(f"c{i}", names[j], float(m[i, j])) for i in range(4) for j in range(2)], "obs_id string, program string, u double")
    matches, summary = pg.compare_programs(long(s, ["1", "2"]), long(s[::-1], ["x", "y"]), use(u, ["1", "2"]), use(u[:, ::-1], ["x", "y"]))
    assert {(r["reference_program"], r["candidate_program"]) for r in matches.collect()} == {("1", "y"), ("2", "x")}
    row = summary.head()
    assert row["overall_consistency"] == pytest.approx(1.0) and pg.speed_gate(summary, 10.0, 4.0).head()["passed"]


def test_leading_directions_match_svd(spark):
    rng = np.random.default_rng(8)
    x = np.abs(rng.normal(size=(300, 30)) @ np.diag(np.linspace(5, 0.5, 30)))
    s, v = pg.leading_directions(vectors(spark, x), 4, 30)
    _, s0, vt = np.linalg.svd(x, full_matrices=False)
    np.testing.assert_allclose(s, s0[:4], rtol=1e-5)
    assert np.abs(np.abs((v * vt[:4].T).sum(axis=0)) - 1).max() < 1e-3
    s, v = pg.leading_directions(vectors(spark, x[:, :2]), 4, 2)
    assert v.shape == (2, 4) and (s[2:] == 0).all()


def test_silhouette_as_by_hand():
    x, label = np.array([[0.0], [1.0], [10.0], [12.0], [50.0]]), np.array([1, 1, 2, 2, 3])
    want = [(11 - 1) / 11, (10 - 1) / 10, (9.5 - 2) / 9.5, (11.5 - 2) / 11.5, 0.0]
    assert pg.silhouette(x, label) == pytest.approx(np.mean(want))


def test_consensus_of_all_k_equals_one_k_at_a_time(spark):
    rng = np.random.default_rng(9)
    h = np.zeros((3, 12))
    for j in range(3):
        h[j, 4 * j : 4 * j + 4] = rng.uniform(1, 3, 4)
    x = rng.gamma(1, 1, (80, 3)) @ h + 0.01
    rows, tpm = vectors(spark, x / x.std(axis=0)), vectors(spark, x * 100)
    spectra, _ = pg.factorize(rows, [(k, s) for k in (2, 3) for s in range(6)], max_iter=40)
    table = pg.spectra_table(rows, spectra)
    medians, tpm_spectra, usages = pg.consensus_all(rows, tpm, table, density_threshold=2.0)
    for k in (2, 3):
        one_median, one_tpm, one_use = pg.consensus_refit(rows, tpm, spectra, k, density_threshold=2.0)
        got = lambda df, c, k=k: np.vstack(df.where(f"k = {k}").orderBy("program").toPandas()[c])
        np.testing.assert_allclose(got(medians, "spectrum"), one_median, rtol=1e-8)
        np.testing.assert_allclose(got(tpm_spectra, "tpm_spectrum"), one_tpm, rtol=1e-6)
        np.testing.assert_allclose(matrix(usages.where(f"k = {k}")), matrix(one_use), rtol=1e-5, atol=1e-7)
    chosen = pg.k_selection(rows, table).toPandas().set_index("k")
    assert chosen.silhouette[3] > 0.9 and chosen.prediction_error[3] < 0.3 * chosen.prediction_error[2] and set(chosen.n_spectra) == {12, 18}


def test_batches_of_several_variables_solve_the_dense_system(spark):
    """Conjugate gradients over pairs of levels and the arrow of one variable give the dense ridge solution; sums hold only levels that occur."""
    rng = np.random.default_rng(12)
    x, r = rng.normal(size=(60, 4)), rng.dirichlet(np.ones(2), 60)
    a, b = rng.integers(0, 3, 60), 3 + rng.integers(0, 4, 60)
    for codes, lam in ((a[:, None], [1.0] * 3), (np.stack([a, b], axis=1), [1.0] * 3 + [0.5] * 4)):
        m = embed._level_moments(r, x, codes)
        coef = embed.level_coefficients(m, np.r_[0.0, lam], codes.shape[1], everywhere=False)
        full = np.concatenate([np.ones((60, 1)), *[c[:, None] == np.unique(c)[None, :] for c in codes.T]], axis=1).astype(float)
        for k in range(2):
            weighted = full * r[:, k : k + 1]
            want = np.linalg.solve(weighted.T @ full + np.diag(np.r_[0.0, lam]), weighted.T @ x)[1:]
            np.testing.assert_allclose(coef[:, k], want, atol=1e-8)


def test_many_levels_stay_small(spark):
    """4,000 batches: nothing of the size levels x levels or cells x levels."""
    rng = np.random.default_rng(13)
    x = rng.normal(size=(8000, 3)) + 5
    obs = spark.createDataFrame([(i, f"b{i % 4000}") for i in range(8000)], "obs_id bigint, batch string")
    z, r = embed.harmony(vectors(spark, x), obs, ["batch"], max_iter=1, rounds=1)
    assert z.count() == 8000 and r.select(F.size("r")).distinct().head()[0] == 100


def test_program_inputs_are_composed_and_written(spark, tmp_path):
    from cytoframe.plans import workflows

    rng = np.random.default_rng(21)
    x = rng.poisson(rng.gamma(1, 4, (1, 12)) * (1 + 3 * rng.integers(0, 2, (60, 12))))
    counts = spark.createDataFrame([(i, f"g{j:02d}", float(x[i, j])) for i in range(60) for j in range(12) if x[i, j]], "obs_id bigint, var_id string, value double")
    obs = spark.createDataFrame([(i, f"s{i % 3}") for i in range(60)], "obs_id bigint, sample_id string")
    inputs = workflows.run_program_preprocess(obs, counts, n_top=6, n_components=4, max_iter=2)
    assert len(inputs.genes) == 6 and inputs.corrected.count() == 60 and (matrix(inputs.corrected) >= 0).all()
    paths = workflows.prepare_programs(inputs, obs, (2, 3), 5, str(tmp_path))
    read = lambda name: spark.read.parquet(paths[name])
    np.testing.assert_allclose(matrix(read("norm_counts")).std(axis=0, ddof=1), 1.0)
    stats = read("tpm_stats").orderBy("var_id").toPandas()
    tpm = x / x.sum(axis=1, keepdims=True) * 1e4
    np.testing.assert_allclose(stats["mean"], tpm.mean(axis=0))
    np.testing.assert_allclose(stats["std"], tpm.std(axis=0))
    runs = read("runs").toPandas()
    assert len(runs) == 10 and runs.seed.nunique() == 10 and sorted(read("genes").toPandas().var_id) == sorted(inputs.genes)
    with pytest.raises(ValueError, match="batch key"):
        workflows.run_program_preprocess(obs, counts, "absent")


def test_core_query_leaves_the_run_at_its_defaults(monkeypatch):
    import inspect

    from cytoframe.plans import workflows
    from cytoframe.suite import embedding

    given, run = {}, inspect.signature(workflows.run_core)

    class Stop(Exception):
        pass

    def record(*args, **kwargs):
        given.update(run.bind(*args, **kwargs).arguments)
        raise Stop

    monkeypatch.setattr(workflows, "run_core", record)
    monkeypatch.setattr(embedding, "cut", lambda df: df)
    monkeypatch.setattr(embedding, "fine", lambda m: None)
    monkeypatch.setattr(embedding, "_fine_var", lambda m: None)
    with pytest.raises(Stop):
        embedding.core_run(type("Model", (), {"obs": None}))
    assert set(given) == {"obs", "counts", "var", "batch_keys"}
    assert given["batch_keys"] == ["batch"]
    kept = {k: p.default for k, p in run.parameters.items()}
    assert (kept["n_top"], kept["n_components"], kept["harmony_rounds"], len(kept["resolutions"]), len(kept["seeds"])) == (3000, 50, 20, 6, 5)


def test_rounds_on_blocks_give_the_labels_of_the_joins(spark, monkeypatch):
    """Several blocks a level, groups of runs, levels that stay in blocks, splits; no join of edges and labels."""
    rng = np.random.default_rng(8)
    pairs = {(int(a), int(b)) for a, b in rng.integers(0, 60, (110, 2)) if a != b}
    pairs |= {(b, a) for a, b in pairs}
    edges = spark.createDataFrame([(f"n{a}", f"n{b}", 1.0 + (a * b) % 7) for a, b in pairs], "src string, dst string, weight double")
    jobs = [(0.2, 0), (1.0, 3), (2.0, 0)]
    rows = lambda x: sorted(map(tuple, x.to_numpy().tolist()))
    want = rows(graph.communities(edges, jobs, rounds=3).toPandas())
    for name, value in (("TASK_EDGES", 40), ("BLOCK_EDGES", 15), ("BLOCK_LABELS", 120)):
        monkeypatch.setattr(graph, name, value)
    monkeypatch.setattr(graph, "_level", lambda *a: pytest.fail("rounds as joins"))
    assert rows(graph.communities(edges, jobs, rounds=3).toPandas()) == want
    monkeypatch.undo()
    monkeypatch.setattr(graph, "TASK_EDGES", 60)
    monkeypatch.setattr(graph, "BLOCK_NODES", 0)
    assert rows(graph.communities(edges, jobs[1:2], rounds=3).toPandas()) == [r for r in want if r[0] == 1.0]


def test_screen_keeps_every_row_within_the_limit():
    rng = np.random.default_rng(3)
    c, q = rng.normal(size=(700, 9)) + 1000.0, rng.normal(size=(50, 9)) + 1000.0
    d = np.sqrt(((q[:, None] - c[None]) ** 2).sum(axis=2))
    limit = np.sort(d, axis=1)[:, 5]
    limit[0] = np.inf
    parts = [slice(300, 700), slice(0, 123)]
    i, j = graph.Screen(c).within(q, limit, parts)
    got, held = set(zip(i.tolist(), j.tolist(), strict=True)), np.r_[0:123, 300:700]
    want = {(a, int(b)) for a in range(50) for b in held if d[a, b] <= limit[a]}
    assert want <= got and len(got) < len(want) + 40
    flags = rng.random(1003) < 0.02
    assert (graph._marked(flags) == np.flatnonzero(flags)).all()


def test_rounds_of_harmony_pass_over_packed_cells(spark, monkeypatch):
    rng = np.random.default_rng(2)
    obs = spark.createDataFrame([(i, str(i % 3)) for i in range(300)], "obs_id bigint, batch string")
    tables, cut = [], embed.cut

    def counted(df):
        tables.append(cut(df))
        return tables[-1]

    monkeypatch.setattr(embed, "cut", counted)
    z, _ = embed.harmony(vectors(spark, rng.normal(size=(300, 3))).repartition(1), obs, ["batch"], max_iter=2)
    assert tables[0].count() == 300 and all(t.count() < 30 for t in tables[1:]) and len(tables) > 2
    assert sorted(r.obs_id for r in z.select("obs_id").collect()) == list(range(300))
