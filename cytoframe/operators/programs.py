"""Gene programs by non-negative factorisation, consensus and comparison.

The cells x genes matrix stays distributed as one row vector per cell.  A cell's usage
depends only on its own row and the current spectra, and the spectra update needs just
two small sums (usage x usage, usage x genes).  One pass over the cells therefore
advances every (k, seed) replicate at once, and no task holds the matrix.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions.partials import matrix_sums
from cytoframe.operators.embed import map_vectors
from cytoframe.session import cut

DEFAULT_SEEDS = tuple(range(20))
SPECTRA = "k int, seed bigint, component int, spectrum array<double>"


def _stack(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(float)


# ---------------------------------------------------------------- coordinate-descent kernels
def nonnegative_rows(b: np.ndarray, gram: np.ndarray, start: np.ndarray | None = None, sweeps: int = 60, tol: float = 1e-7) -> np.ndarray:
    """Rows w >= 0 minimising w G w' / 2 - b w' by cyclic coordinate descent."""
    w = np.zeros_like(b) if start is None else start.copy()
    diag = np.maximum(np.diag(gram), 1e-300)
    for _ in range(sweeps):
        move = 0.0
        for j in range(gram.shape[0]):
            if gram[j, j] <= 0:
                continue
            fresh = np.maximum(w[:, j] + (b[:, j] - w @ gram[:, j]) / diag[j], 0.0)
            move = max(move, float(np.max(np.abs(fresh - w[:, j]), initial=0.0)))
            w[:, j] = fresh
        if move <= tol * max(float(w.max(initial=0.0)), 1e-12):
            break
    return w


def usage_rows(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    return nonnegative_rows(x @ h.T, h @ h.T)


def leading_directions(rows: DataFrame, k: int, genes: int, passes: int = 12, extra: int = 10, tol: float = 1e-6, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` singular values and right singular vectors (genes x k) of the rows, by a randomised range finder.

    A pass adds up x' (x Q) for a narrow basis Q of k + ``extra`` directions, so that sums are genes x directions and
    never genes x genes; the new basis is the orthonormal range of that sum.  It ends when the singular values have settled.
    """
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(genes, min(genes, k + extra))))[0]
    before = np.zeros(k)
    for _ in range(passes):
        def part(pdf, q=q):
            x = _stack(pdf["v"])
            y = x @ q
            return {"z": x.T @ y, "b": y.T @ y}

        s = matrix_sums(rows, part)
        val, vec = np.linalg.eigh(s["b"])
        missing = max(0, k - len(val))
        now = np.pad(np.sqrt(np.maximum(val[::-1], 0.0)), (0, missing))[:k]
        found = np.pad(q @ vec[:, ::-1], ((0, 0), (0, missing)))[:, :k]
        if np.abs(now - before).max() <= tol * max(now[0], 1e-300):
            break
        before, q = now, np.linalg.qr(s["z"])[0]
    return now, found


def _initial_spectra(rows: DataFrame, k_values: Sequence[int], seeds: Sequence[int], init: str) -> dict:
    """Starting spectra per (k, seed): seeded random, or from the SVD with its zeros filled around the mean by seed."""
    first = matrix_sums(rows, lambda pdf: {"s": _stack(pdf["v"]).sum(axis=0, keepdims=True), "n": np.array([[len(pdf)]])})
    n, genes = first["n"][0, 0], first["s"].shape[1]
    mean = first["s"].sum() / (n * genes)
    if init == "random":
        out = {}
        for k in k_values:
            for seed in seeds:
                rng = np.random.default_rng(int(seed) * 1_000_003 + int(k))
                out[(k, seed)] = np.abs(rng.normal(size=(k, genes))) * np.sqrt(mean / k)
        return out
    s, v = leading_directions(rows, max(k_values), genes)
    safe = np.where(s > 0, s, 1.0)

    def halves(pdf):
        u = _stack(pdf["v"]) @ v / safe
        return {"p": (np.maximum(u, 0.0) ** 2).sum(axis=0, keepdims=True), "m": (np.maximum(-u, 0.0) ** 2).sum(axis=0, keepdims=True)}

    sides = matrix_sums(rows, halves)
    up, um = np.sqrt(sides["p"][0]), np.sqrt(sides["m"][0])
    full = np.zeros((len(s), genes))
    for j in range(len(s)):
        vp, vm = np.maximum(v[:, j], 0.0), np.maximum(-v[:, j], 0.0)
        pos, neg = up[j] * np.linalg.norm(vp), um[j] * np.linalg.norm(vm)
        side, mass = (vp, pos) if pos >= neg else (vm, neg)
        full[j] = np.sqrt(s[j] * mass) * side / max(np.linalg.norm(side), 1e-300)
    full[0] = np.sqrt(s[0]) * np.abs(v[:, 0])
    out = {}
    for seed in seeds:
        fill = mean * np.random.default_rng(int(seed)).uniform(0.5, 1.5, full.shape)
        started = np.where(full < 1e-6, fill, full)
        out.update({(k, seed): started[:k].copy() for k in k_values})
    return out


def factorize(
    rows: DataFrame, tasks: Sequence[tuple[int, int]], max_iter: int = 50, tol: float = 1e-4, init: str = "random",
) -> tuple[dict, dict]:
    """Spectra and reconstruction error per (k, seed) task.

    ``rows``: (obs_id, v) non-negative.  Each iteration solves every cell's usage exactly
    for the current spectra and then runs coordinate descent on the spectra.
    """
    rows = cut(rows.select("obs_id", "v"))
    if rows.where(F.exists("v", lambda x: x < 0)).limit(1).count():
        raise ValueError("factorisation needs non-negative values")
    ks, seeds = sorted({k for k, _ in tasks}), sorted({s for _, s in tasks})
    spectra = {t: h for t, h in _initial_spectra(rows, ks, seeds, init).items() if t in set(tasks)}
    live, errors, first = set(spectra), {}, {}
    for it in range(max_iter + 1):
        now = {t: spectra[t] for t in live}

        def sums(pdf, now=now):
            x = _stack(pdf["v"])
            out = {"xx": np.array([[float((x * x).sum())]])}
            for (k, seed), h in now.items():
                w = usage_rows(x, h)
                out[f"a{k}_{seed}"], out[f"b{k}_{seed}"] = w.T @ w, w.T @ x
            return out

        s = matrix_sums(rows, sums)
        for t in list(live):
            a, b, h = s[f"a{t[0]}_{t[1]}"], s[f"b{t[0]}_{t[1]}"], spectra[t]
            err = float(np.sqrt(max(s["xx"][0, 0] - 2.0 * (b * h).sum() + (a * (h @ h.T)).sum(), 0.0)))
            previous = errors.get(t, np.inf)
            errors[t] = err
            first.setdefault(t, err)
            if it == max_iter or (it and (previous - err) <= tol * first[t]):
                live.discard(t)
                continue
            spectra[t] = nonnegative_rows(b.T, a, start=h.T, sweeps=20).T
        if not live:
            break
    return {t: spectra[t] for t in tasks}, {t: errors[t] for t in tasks}


def scale_rows(rows: DataFrame) -> DataFrame:
    """Vectors over the spread (ddof 1) of each of their columns; a column without spread stays."""
    s = matrix_sums(rows, lambda pdf: {"s1": _stack(pdf["v"]).sum(axis=0, keepdims=True), "s2": (_stack(pdf["v"]) ** 2).sum(axis=0, keepdims=True), "n": np.array([[len(pdf)]])})
    n = s["n"][0, 0]
    std = np.sqrt(np.maximum(s["s2"][0] - s["s1"][0] ** 2 / n, 0.0) / max(n - 1, 1))
    return map_vectors(rows.select("obs_id", "v"), lambda x, _: x / np.where(std > 0, std, 1.0), ["obs_id"])


def spectra_table(rows: DataFrame, spectra: dict) -> DataFrame:
    data = [(int(k), int(s), c + 1, [float(x) for x in h[c]]) for (k, s), h in spectra.items() for c in range(k)]
    return rows.sparkSession.createDataFrame(data, SPECTRA)


def usage(rows: DataFrame, h: np.ndarray) -> DataFrame:
    """(obs_id, v): usage of each program per cell."""
    return map_vectors(rows.select("obs_id", "v"), lambda x, _: usage_rows(x.astype(float), h), ["obs_id"])


def usage_summary(use: DataFrame) -> DataFrame:
    """Dominant program (first maximum) and usage entropy per cell."""
    total = F.greatest(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), F.lit(1e-12))
    p = F.transform("v", lambda x: x / total)
    entropy = -F.aggregate(p, F.lit(0.0), lambda a, x: a + x * F.ln(F.greatest(x, F.lit(1e-12))))
    top = F.array_position("v", F.array_max("v"))
    return use.select("obs_id", F.concat(F.lit("P"), top.cast("string")).alias("dominant_program"), entropy.alias("program_entropy"))


# ---------------------------------------------------------------- multiplicative updates
def factorize_multiplicative(rows: DataFrame, k: int, seed: int, iterations: int = 200, eps: float = 1e-9) -> tuple[DataFrame, np.ndarray, float]:
    """Fixed number of multiplicative updates; usages travel with their rows between rounds."""
    rows = rows.select("obs_id", "v")
    h = _initial_spectra(rows, [k], [seed], "random")[(k, seed)]
    scale = float(h.mean())
    start = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: (F.pmod(F.xxhash64("obs_id", i, F.lit(seed)), F.lit(1000)) + 1) / 1000.0 * scale)
    state = cut(rows.withColumn("w", start))
    kinds = dict(rows.dtypes)
    schema = f"obs_id {kinds['obs_id']}, v {kinds['v']}, w array<double>"
    error = np.inf
    for _ in range(iterations):
        s = matrix_sums(state, lambda pdf: {"a": _stack(pdf["w"]).T @ _stack(pdf["w"]), "b": _stack(pdf["w"]).T @ _stack(pdf["v"])})
        h = h * s["b"] / np.maximum(s["a"] @ h, eps)
        hh = h @ h.T

        def step(batches, h=h, hh=hh):
            for pdf in batches:
                if len(pdf):
                    x, w = _stack(pdf["v"]), _stack(pdf["w"])
                    yield pdf.assign(w=list(w * (x @ h.T) / np.maximum(w @ hh, eps)))

        state = cut(state.mapInPandas(step, schema))
    gap = matrix_sums(state, lambda pdf: {"e": np.array([[float(((_stack(pdf["v"]) - _stack(pdf["w"]) @ h) ** 2).sum())]])})
    error = float(np.sqrt(gap["e"][0, 0]))
    return state.select("obs_id", F.col("w").alias("v")), h, error


# ---------------------------------------------------------------- consensus over replicates
def _unit(h: np.ndarray) -> np.ndarray:
    return h / np.maximum(np.linalg.norm(h, axis=1, keepdims=True), 1e-12)


def average_linkage(dist: np.ndarray, k: int) -> np.ndarray:
    """Labels of k clusters by mean-distance agglomeration."""
    d = dist.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    members = {i: [i] for i in range(len(d))}
    while len(members) > k:
        a, b = np.unravel_index(int(np.argmin(d)), d.shape)
        a, b = min(a, b), max(a, b)
        na, nb = len(members[a]), len(members[b])
        fresh = (na * d[a] + nb * d[b]) / (na + nb)
        d[a], d[:, a] = fresh, fresh
        d[b], d[:, b] = np.inf, np.inf
        d[a, a] = np.inf
        members[a] += members.pop(b)
    out = np.zeros(len(dist), dtype=int)
    for label, idx in enumerate(members.values()):
        out[idx] = label
    return out


def stability(spectra: np.ndarray, k: int) -> float:
    """Median over k clusters of the mean cosine between their spectra; 1 with a single replicate."""
    h = _unit(spectra)
    if len(h) <= k:
        return 1.0
    label = np.unique(average_linkage(1.0 - np.clip(h @ h.T, 0.0, 1.0), k), return_inverse=True)[1]
    n = np.bincount(label).astype(float)
    inside = np.zeros((len(n), h.shape[1]))
    np.add.at(inside, label, h)
    # a sum's squared length holds every ordered pair and each member with itself
    pairs = (inside**2).sum(axis=1) - np.bincount(label, (h**2).sum(axis=1))
    return float(np.median(np.where(n > 1, pairs / np.maximum(n * (n - 1), 1), 1.0)))


def stability_by_k(table: DataFrame) -> DataFrame:
    """One task per k over its replicates' spectra (seeds x k rows)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["k"].iloc[0])
        ordered = pdf.sort_values(["seed", "component"])
        return pd.DataFrame({"k": [k], "median_stability": [stability(_stack(ordered["spectrum"]), k)]})

    return table.groupBy("k").applyInPandas(run, "k int, median_stability double")


def choose_k(summary: DataFrame, threshold: float = 0.70) -> int:
    """Smallest stable k; without one the most stable, then the smallest error."""
    ok = F.col("median_stability") >= threshold
    ranked = summary.withColumn("_ok", ok).orderBy(
        F.col("_ok").desc(), F.when(F.col("_ok"), F.col("k")), F.col("median_stability").desc(), "median_error", "k"
    )
    return int(ranked.select("k").head()[0])


def consensus_programs(
    rows: DataFrame, k_grid: Iterable[int] = (5, 8, 10, 12, 15), seeds: Iterable[int] = DEFAULT_SEEDS, max_iter: int = 50,
    threshold: float = 0.70, init: str = "nndsvda",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary per k, spectra of the chosen run, usage of the chosen run)."""
    rows = cut(rows.select("obs_id", "v"))
    tasks = [(int(k), int(s)) for k in k_grid for s in seeds]
    spectra, errors = factorize(rows, tasks, max_iter=max_iter, init=init)
    table = spectra_table(rows, spectra)
    fits = rows.sparkSession.createDataFrame([(k, s, float(e)) for (k, s), e in errors.items()], "k int, seed bigint, error double")
    summary = fits.groupBy("k").agg(F.median("error").alias("median_error"), F.min("error").alias("min_error"), F.count(F.lit(1)).alias("n_seeds"))
    summary = cut(summary.join(stability_by_k(table), "k"))
    chosen = choose_k(summary, threshold)
    best = min((t for t in tasks if t[0] == chosen), key=lambda t: (errors[t], t[1]))
    picked = table.where((F.col("k") == best[0]) & (F.col("seed") == best[1])).select("component", "spectrum")
    return summary.withColumn("selected", F.col("k") == chosen), picked, usage(rows, spectra[best])


def _kmeans(x: np.ndarray, k: int, restarts: int = 10, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    best, label = np.inf, np.zeros(len(x), dtype=int)
    for _ in range(restarts):
        centres = [x[rng.integers(len(x))]]
        while len(centres) < k:
            d = np.min([((x - c) ** 2).sum(axis=1) for c in centres], axis=0)
            centres.append(x[rng.choice(len(x), p=d / d.sum())] if d.sum() > 0 else x[rng.integers(len(x))])
        c = np.array(centres)
        for _ in range(100):
            d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
            lab = d.argmin(axis=1)
            fresh = np.array([x[lab == j].mean(axis=0) if (lab == j).any() else c[j] for j in range(k)])
            if np.allclose(fresh, c):
                break
            c = fresh
        cost = float(d[np.arange(len(x)), lab].sum())
        if cost < best - 1e-12:
            best, label = cost, lab
    return label


def density_filter(spectra: np.ndarray, k: int, threshold: float = 0.5, neighbourhood: float = 0.30) -> np.ndarray:
    """Mask of replicate spectra lying in a dense neighbourhood of unit vectors."""
    n = int(neighbourhood * len(spectra) / k)
    if n < 1:
        raise ValueError("consensus needs at least one local-density neighbour")
    u = spectra / np.linalg.norm(spectra, axis=1, keepdims=True)
    d = np.sqrt(np.maximum(2.0 - 2.0 * u @ u.T, 0.0))
    near = np.sort(d, axis=1)[:, : n + 1].sum(axis=1) / n
    return near < threshold if threshold < 2 else np.ones(len(u), dtype=bool)


def consensus_refit(
    rows: DataFrame, tpm_rows: DataFrame, replicates: dict, k: int, density_threshold: float = 0.5, neighbourhood: float = 0.30,
) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """(consensus spectra, TPM spectra scaled by gene spread, usage per cell).

    Replicate spectra (seeds x k rows) are filtered by local density, clustered, and their
    medians become the programs.  The three refits are row-parallel or small-sum passes.
    """
    merged = np.vstack([h for (kk, _), h in sorted(replicates.items()) if kk == k])
    unit = merged / np.linalg.norm(merged, axis=1, keepdims=True)
    unit = unit[density_filter(merged, k, density_threshold, neighbourhood)]
    if len(unit) < k:
        raise ValueError("too few spectra remain after density filtering")
    label = _kmeans(unit, k)
    median = np.array([np.median(unit[label == c], axis=0) for c in np.unique(label)])
    median = median / median.sum(axis=1, keepdims=True)

    def shares(pdf):
        w = usage_rows(_stack(pdf["v"]), median)
        return w / np.maximum(w.sum(axis=1, keepdims=True), 1e-300)

    weight = matrix_sums(rows, lambda pdf: {"s": shares(pdf).sum(axis=0, keepdims=True)})["s"][0]
    median = median[np.argsort(-weight, kind="stable")]
    both = cut(rows.select("obs_id", "v").join(tpm_rows.select("obs_id", F.col("v").alias("t")), "obs_id"))

    def sums(pdf):
        u, t = shares(pdf), _stack(pdf["t"])
        return {"a": u.T @ u, "b": u.T @ t, "s1": t.sum(axis=0, keepdims=True), "s2": (t * t).sum(axis=0, keepdims=True), "n": np.array([[len(pdf)]])}

    s = matrix_sums(both, sums)
    n = s["n"][0, 0]
    centred = np.maximum(s["s2"][0] - s["s1"][0] ** 2 / n, 0.0)
    population, sample = np.sqrt(centred / n), np.sqrt(centred / max(n - 1, 1))
    tpm = nonnegative_rows(s["b"].T, s["a"], sweeps=200).T / np.where(population > 0, population, 1.0)
    scaled = map_vectors(both.select("obs_id", F.col("t").alias("v")), lambda x, _: x / np.where(sample > 0, sample, 1.0), ["obs_id"])
    return median, tpm, usage(scaled, tpm)


# ---------------------------------------------------------------- consensus of every k
def silhouette(x: np.ndarray, label: np.ndarray) -> float:
    """Mean silhouette width by Euclidean distance; a point alone in its cluster counts 0."""
    names, at = np.unique(label, return_inverse=True)
    if len(names) < 2:
        return 0.0
    d = np.sqrt(np.maximum(((x[:, None, :] - x[None]) ** 2).sum(axis=2), 0.0))
    size = np.bincount(at)
    total = np.stack([d[:, at == c].sum(axis=1) for c in range(len(names))], axis=1)
    own = total[np.arange(len(x)), at] / np.maximum(size[at] - 1, 1)
    total = total / size
    total[np.arange(len(x)), at] = np.inf
    other = total.min(axis=1)
    return float(np.where(size[at] > 1, (other - own) / np.maximum(np.maximum(own, other), 1e-300), 0.0).mean())


MEDIANS = "k int, program int, spectrum array<double>, n_spectra int, n_kept int, silhouette double"


def consensus_medians(table: DataFrame, density_threshold: float = 0.5, neighbourhood: float = 0.30) -> DataFrame:
    """Median spectra of the clusters of every k's replicate spectra, and the silhouette width of these clusters; one task a k over its seeds x k rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["k"].iloc[0])
        merged = _stack(pdf.sort_values(["seed", "component"])["spectrum"])
        unit = merged / np.linalg.norm(merged, axis=1, keepdims=True)
        kept = unit[density_filter(merged, k, density_threshold, neighbourhood)]
        if len(kept) < k:
            raise ValueError("too few spectra remain after density filtering")
        label = _kmeans(kept, k)
        median = np.array([np.median(kept[label == c], axis=0) for c in np.unique(label)])
        median = median / median.sum(axis=1, keepdims=True)
        return pd.DataFrame({"k": k, "program": range(1, len(median) + 1), "spectrum": list(median), "n_spectra": len(merged), "n_kept": len(kept), "silhouette": silhouette(kept, label)})

    return table.groupBy("k").applyInPandas(run, MEDIANS)


def _medians(found: DataFrame) -> dict[int, np.ndarray]:
    """At most k spectra a k."""
    return {int(k): _stack(part.sort_values("program")["spectrum"]) for k, part in found.select("k", "program", "spectrum").toPandas().groupby("k")}


def k_selection(rows: DataFrame, table: DataFrame, neighbourhood: float = 0.30) -> DataFrame:
    """(k, silhouette, prediction_error, n_spectra) of every k: stability of all replicate spectra, and the squared error of the counts around usages of their medians.

    The clusterings of all k are tasks of one job, the errors of all k are sums of one pass over the cells.
    """
    found = cut(consensus_medians(table, density_threshold=2.0, neighbourhood=neighbourhood))
    medians = _medians(found)

    def part(pdf):
        x = _stack(pdf["v"])
        return {str(k): np.array([[float(((x - usage_rows(x, h) @ h) ** 2).sum())]]) for k, h in medians.items()}

    errors = [(int(k), float(e[0, 0])) for k, e in matrix_sums(rows, part).items()]
    told = rows.sparkSession.createDataFrame(errors, "k int, prediction_error double")
    return found.groupBy("k").agg(F.first("silhouette").alias("silhouette"), F.first("n_spectra").alias("n_spectra")).join(told, "k").select("k", "silhouette", "prediction_error", "n_spectra")


def consensus_all(
    rows: DataFrame, tpm_rows: DataFrame, table: DataFrame, density_threshold: float = 0.5, neighbourhood: float = 0.30,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``consensus_refit`` of every k in the same passes: (k, program, spectrum), (k, program, tpm_spectrum), usages (k, obs_id, v)."""
    medians = _medians(cut(consensus_medians(table, density_threshold, neighbourhood)))

    def shares(x, h):
        w = usage_rows(x, h)
        return w / np.maximum(w.sum(axis=1, keepdims=True), 1e-300)

    weight = matrix_sums(rows, lambda pdf: {str(k): shares(_stack(pdf["v"]), h).sum(axis=0, keepdims=True) for k, h in medians.items()})
    medians = {k: h[np.argsort(-weight[str(k)][0], kind="stable")] for k, h in medians.items()}
    both = cut(rows.select("obs_id", "v").join(tpm_rows.select("obs_id", F.col("v").alias("t")), "obs_id"))

    def sums(pdf):
        x, t = _stack(pdf["v"]), _stack(pdf["t"])
        out = {"s1": t.sum(axis=0, keepdims=True), "s2": (t * t).sum(axis=0, keepdims=True), "n": np.array([[len(pdf)]])}
        for k, h in medians.items():
            u = shares(x, h)
            out[f"a{k}"], out[f"b{k}"] = u.T @ u, u.T @ t
        return out

    s = matrix_sums(both, sums)
    n = s["n"][0, 0]
    centred = np.maximum(s["s2"][0] - s["s1"][0] ** 2 / n, 0.0)
    population, sample = (np.where(x > 0, x, 1.0) for x in (np.sqrt(centred / n), np.sqrt(centred / max(n - 1, 1))))
    tpm = {k: nonnegative_rows(s[f"b{k}"].T, s[f"a{k}"], sweeps=200).T / population for k in medians}
    kind = dict(both.dtypes)["obs_id"]

    def refit(batches):
        for pdf in batches:
            if len(pdf):
                t = _stack(pdf["t"]) / sample
                for k, h in tpm.items():
                    yield pdf[["obs_id"]].assign(k=np.int32(k), v=list(usage_rows(t, h)))

    listed = lambda name, of: rows.sparkSession.createDataFrame([(k, i + 1, [float(x) for x in r]) for k, h in of.items() for i, r in enumerate(h)], f"k int, program int, {name} array<double>")
    return listed("spectrum", medians), listed("tpm_spectrum", tpm), both.mapInPandas(refit, f"obs_id {kind}, k int, v array<double>").select("k", "obs_id", "v")


# ---------------------------------------------------------------- comparing program sets
def program_cosines(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """Cosine of every reference / candidate program pair over their common genes (zero norm gives 0)."""
    genes = reference.select("var_id").distinct().join(candidate.select("var_id").distinct(), "var_id", "left_semi")
    a = reference.join(genes, "var_id", "left_semi").select("var_id", F.col("program").alias("reference_program"), F.col("w").alias("wa"))
    b = candidate.join(genes, "var_id", "left_semi").select("var_id", F.col("program").alias("candidate_program"), F.col("w").alias("wb"))
    na = a.groupBy("reference_program").agg(F.sqrt(F.sum(F.col("wa") * F.col("wa"))).alias("na"))
    nb = b.groupBy("candidate_program").agg(F.sqrt(F.sum(F.col("wb") * F.col("wb"))).alias("nb"))
    dots = a.join(b, "var_id").groupBy("reference_program", "candidate_program").agg(F.sum(F.col("wa") * F.col("wb")).alias("ab"))
    return dots.join(na, "reference_program").join(nb, "candidate_program").select(
        "reference_program", "candidate_program", F.coalesce(F.try_divide("ab", F.col("na") * F.col("nb")), F.lit(0.0)).alias("cosine")
    )


def assign_optimal(gain: np.ndarray) -> list[tuple[int, int]]:
    """One-to-one assignment of rows to columns with the largest total gain (shortest augmenting paths)."""
    cost = -np.asarray(gain, dtype=float)
    flip = cost.shape[0] > cost.shape[1]
    cost = cost.T if flip else cost
    n, m = cost.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        slack, back, seen = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=bool)
        while match[j0]:
            seen[j0] = True
            i0, free = match[j0], np.flatnonzero(~seen[1:]) + 1
            reduced = cost[i0 - 1, free - 1] - u[i0] - v[free]
            better = reduced < slack[free]
            slack[free[better]], back[free[better]] = reduced[better], j0
            j1 = free[int(np.argmin(slack[free]))]
            delta = slack[j1]
            u[match[seen]] += delta
            v[seen] -= delta
            slack[~seen] -= delta
            j0 = j1
        while j0:
            match[j0] = match[back[j0]]
            j0 = back[j0]
    pairs = [(int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j]]
    return sorted((b, a) if flip else (a, b) for a, b in pairs)


def match_programs(cosines: DataFrame, limit: int = 2000) -> DataFrame:
    """Optimal pairing of programs; the program-by-program table is small by construction and checked."""
    pdf = cosines.limit(limit * limit + 1).toPandas()
    if len(pdf) > limit * limit:
        raise ValueError("too many programs to pair")
    grid = pdf.pivot(index="reference_program", columns="candidate_program", values="cosine").fillna(0.0)
    rows = [(str(grid.index[i]), str(grid.columns[j]), float(grid.iat[i, j])) for i, j in assign_optimal(grid.to_numpy())]
    return cosines.sparkSession.createDataFrame(rows, "reference_program string, candidate_program string, spectra_cosine double")


def usage_pearson(reference: DataFrame, candidate: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pearson of matched usage columns over the common cells, absent entries 0; 0 when a side is constant."""
    cells = reference.select("obs_id").distinct().join(candidate.select("obs_id").distinct(), "obs_id", "left_semi")
    n = cells.agg(F.count(F.lit(1))).scalar()
    a = reference.join(cells, "obs_id", "left_semi").withColumnRenamed("program", "reference_program").join(pairs.select("reference_program", "candidate_program"), "reference_program")
    b = candidate.join(cells, "obs_id", "left_semi").withColumnRenamed("program", "candidate_program").join(pairs.select("reference_program", "candidate_program"), "candidate_program")
    keys = ["obs_id", "reference_program", "candidate_program"]
    j = a.select(*keys, F.col("u").alias("x")).join(b.select(*keys, F.col("u").alias("y")), keys, "full_outer").na.fill(0.0, ["x", "y"])
    x, y = F.col("x"), F.col("y")
    s = j.groupBy("reference_program", "candidate_program").agg(
        F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * y).alias("xy"), F.sum(x * x).alias("xx"), F.sum(y * y).alias("yy")
    ).withColumn("n", n)
    cov = F.col("xy") - F.col("sx") * F.col("sy") / F.col("n")
    vx, vy = F.col("xx") - F.col("sx") * F.col("sx") / F.col("n"), F.col("yy") - F.col("sy") * F.col("sy") / F.col("n")
    r = F.coalesce(F.try_divide(cov, F.sqrt(F.greatest(vx * vy, F.lit(0.0)))), F.lit(0.0))
    return s.select("reference_program", "candidate_program", r.alias("usage_pearson"))


def top_gene_jaccard(reference: DataFrame, candidate: DataFrame, pairs: DataFrame, top_n: int = 50) -> DataFrame:
    """Overlap of the top genes of matched programs; ties by gene."""
    def top(df, name):
        w = Window.partitionBy("program").orderBy(F.col("w").desc(), "var_id")
        ranked = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top_n)
        return ranked.select(F.col("program").alias(name), "var_id").join(pairs.select("reference_program", "candidate_program"), name)

    keys = ["reference_program", "candidate_program"]
    both = top(reference, "reference_program").withColumn("l", F.lit(1)).join(top(candidate, "candidate_program").withColumn("r", F.lit(1)), [*keys, "var_id"], "full_outer")
    shared = F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()) / F.count(F.lit(1))
    return pairs.select(*keys).join(both.groupBy(*keys).agg(shared.alias("j")), keys, "left").select(*keys, F.coalesce("j", F.lit(1.0)).alias("top_gene_jaccard"))


def compare_programs(ref_spectra: DataFrame, cand_spectra: DataFrame, ref_usage: DataFrame, cand_usage: DataFrame, top_n: int = 50) -> tuple[DataFrame, DataFrame]:
    """(one row per matched pair, one summary row with the overall consistency)."""
    pairs = cut(match_programs(program_cosines(ref_spectra, cand_spectra)))
    keys = ["reference_program", "candidate_program"]
    matches = cut(pairs.join(usage_pearson(ref_usage, cand_usage, pairs), keys, "left").na.fill(0.0, ["usage_pearson"]).join(
        top_gene_jaccard(ref_spectra, cand_spectra, pairs, top_n), keys
    ))
    summary = matches.agg(
        F.avg("spectra_cosine").alias("mean_spectra_cosine"), F.min("spectra_cosine").alias("min_spectra_cosine"), F.avg("usage_pearson").alias("mean_usage_pearson"),
        F.min("usage_pearson").alias("min_usage_pearson"), F.avg("top_gene_jaccard").alias("mean_top_gene_jaccard"),
    ).withColumn("overall_consistency", F.least("mean_spectra_cosine", "mean_usage_pearson"))
    return matches, summary


def speed_gate(summaries: DataFrame, reference_seconds: float, candidate_seconds: float, min_saved: float = 0.50, min_consistency: float = 0.95) -> DataFrame:
    """Passes when enough time is saved and every k is consistent."""
    saved = (reference_seconds - candidate_seconds) / reference_seconds
    return summaries.agg(F.min("overall_consistency").alias("min_overall_consistency")).select(
        F.lit(reference_seconds / candidate_seconds).alias("speedup"), F.lit(saved).alias("time_saved_fraction"), "min_overall_consistency",
        ((F.lit(saved) >= min_saved) & (F.col("min_overall_consistency") >= min_consistency)).alias("passed"),
    )
