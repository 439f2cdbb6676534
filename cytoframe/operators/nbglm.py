"""Negative-binomial Wald contrast on pseudobulk counts.

Genes are rows with their sample vectors as (position, count) arrays, so every per-gene
fit is one narrow ``mapInPandas`` pass.  Only three small global barriers exist: sample
size factors, the two trend coefficients, and the prior variance.

``nb_wald_by_type`` runs the contrast of all cell types at once: the type is a key of every step, rows carry the
samples of their own type, and the trends of all types are fitted together by grouped sums, each
type with its own state until it has converged.  ``nb_wald`` is the same with one key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.functions.ordered import benjamini_hochberg, exact_quantiles
from cytoframe.functions.tails import log_gamma, normal_p, trigamma
from cytoframe.operators.pseudobulk import contrast_samples
from cytoframe.session import cut

TINY = np.finfo(float).tiny
KEY = "cell_type"
DAMPING = (0.0, 1e-3, 1e-1, 1.0, 1e2)


def size_factors(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Median-of-ratios factor per sample, geometric mean 1.

    Ratios use genes positive in every sample; without any, the geometric mean over
    positive samples; and library size where a median is missing.
    """
    data = counts.where(F.col("count") > 0).join(samples.select("pseudobulk_id"), "pseudobulk_id", "left_semi")
    n = samples.count()
    per_gene = cut(data.groupBy("var_id").agg(F.count(F.lit(1)).alias("k"), F.exp(F.avg(F.ln("count"))).alias("geo")))
    full = per_gene.where(F.col("k") == n)
    used = full if full.limit(1).count() else per_gene
    ratios = data.join(used.select("var_id", "geo"), "var_id").select(
        "pseudobulk_id", (F.col("count") / F.col("geo")).alias("r")
    )
    sf = cut(
        samples.select("pseudobulk_id").join(
            exact_quantiles(ratios, ["pseudobulk_id"], "r", {"sf": 0.5}), "pseudobulk_id", "left"
        )
    )
    if sf.where(F.col("sf").isNull() | (F.col("sf") <= 0)).limit(1).count():
        libs = data.groupBy("pseudobulk_id").agg(F.sum("count").alias("sf"))
        sf = cut(samples.select("pseudobulk_id").join(libs, "pseudobulk_id", "left").na.fill(1e-8, ["sf"]))
    centre = sf.agg(F.exp(F.avg(F.ln("sf")))).scalar()
    return sf.select("pseudobulk_id", (F.col("sf") / centre).alias("size_factor"))


@dataclass(frozen=True)
class Design:
    """Sample vectors: one for all rows, or (with ``on``, the positions that are samples) one for each row."""

    x: np.ndarray
    sf: np.ndarray
    on: np.ndarray | None = None
    min_disp: float = 1e-8
    max_iter: int = 50
    tol: float = 1e-8

    @property
    def used(self) -> np.ndarray:
        return np.ones((1, len(self.x))) if self.on is None else self.on

    @property
    def test(self) -> np.ndarray:
        """1 for samples of the test group, as a matrix of one row or of all."""
        return np.atleast_2d(self.x) * self.used

    @property
    def size(self) -> np.ndarray:
        return self.used.sum(axis=1)

    @property
    def max_disp(self) -> np.ndarray:
        return np.maximum(10.0, self.size)

    def rows(self, chosen: np.ndarray) -> Design:
        return self if self.on is None else replace(self, x=self.x[chosen], sf=self.sf[chosen], on=self.on[chosen])

    @classmethod
    def of_rows(cls, x: pd.Series, sf: pd.Series) -> Design:
        size = x.map(len).to_numpy()
        on = (np.arange(max(size.max(initial=0), 1))[None, :] < size[:, None]).astype(float)
        full_x, full_sf = np.zeros(on.shape), np.ones(on.shape)
        full_x[on > 0], full_sf[on > 0] = np.concatenate(x.to_list() or [[]]), np.concatenate(sf.to_list() or [[]])
        return cls(full_x, full_sf, on)


def _dense(pos: pd.Series, val: pd.Series, m: int) -> np.ndarray:
    y = np.zeros((len(pos), m))
    for i, (p, v) in enumerate(zip(pos, val)):
        y[i, np.asarray(p, dtype=np.intp)] = v
    return y


def _mean(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return (y * weight).sum(axis=1) / np.maximum(weight.sum(axis=1), 1.0)


def _starting_dispersion(norm: np.ndarray, d: Design) -> tuple[np.ndarray, np.ndarray]:
    mean = _mean(norm, d.used)
    var = (d.used * (norm - mean[:, None]) ** 2).sum(axis=1) / np.maximum(d.size - 1, 1.0)
    moments = np.maximum((var - mean) / np.maximum(mean**2, TINY), d.min_disp)
    mu = np.where(d.test > 0, _mean(norm, d.test)[:, None], _mean(norm, d.used - d.test)[:, None])
    mu = np.maximum(mu, 1.0)
    rough = (d.used * ((norm - mu) ** 2 - mu) / mu**2).sum(axis=1) / np.maximum(d.size - 2, 1.0)
    return moments, np.maximum(np.minimum(np.maximum(rough, 0.0), moments), d.min_disp)


def _mu(beta0, beta1, d: Design) -> np.ndarray:
    eta = np.log(np.atleast_2d(d.sf)) + beta0[:, None] + beta1[:, None] * np.atleast_2d(d.x)
    return np.maximum(np.exp(np.clip(eta, -30.0, 30.0)), 0.5)


def _irls(y: np.ndarray, alpha: np.ndarray, d: Design) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two-coefficient log-link fit per gene; a gene stops once its own step is below tol."""
    norm = y / np.atleast_2d(d.sf)
    b0 = np.log(np.maximum(_mean(norm, d.used - d.test), 1e-8))
    b1 = np.log(np.maximum(_mean(norm, d.test), 1e-8)) - b0
    live = np.ones(len(y), dtype=bool)

    def normal_equations(rows, part):
        mu = _mu(b0[rows], b1[rows], part)
        w = part.used * mu / (1.0 + alpha[rows, None] * mu)
        return mu, w, w.sum(axis=1), (w * part.test).sum(axis=1)

    for _ in range(d.max_iter):
        rows = np.flatnonzero(live)
        if not len(rows):
            break
        part = d.rows(rows)
        mu, w, a, b = normal_equations(rows, part)
        z = b0[rows, None] + b1[rows, None] * np.atleast_2d(part.x) + (y[rows] - mu) / mu
        wz = w * z
        s, e = wz.sum(axis=1), (wz * part.test).sum(axis=1)
        det = a * b - b * b
        ok = np.abs(det) > TINY
        safe = np.where(ok, det, 1.0)
        n0 = np.where(ok, (s * b - b * e) / safe, b0[rows])
        n1 = np.where(ok, (a * e - b * s) / safe, b1[rows])
        move = np.maximum(np.abs(n0 - b0[rows]), np.abs(n1 - b1[rows]))
        b0[rows], b1[rows] = n0, n1
        live[rows] = move >= d.tol
    _, _, a, b = normal_equations(np.arange(len(y)), d)
    det = a * b - b * b
    se = np.sqrt(np.where(det > 0, a / np.where(det > 0, det, 1.0), np.inf))
    return b0, b1, se


def _profile(y: np.ndarray, mu: np.ndarray, log_alpha: np.ndarray, d: Design) -> np.ndarray:
    """Cox-Reid adjusted NB log-likelihood of each gene at its log dispersion."""
    alpha = np.maximum(np.exp(log_alpha), TINY)[:, None]
    r = 1.0 / alpha
    ll = (
        d.used * (log_gamma(y + r) - log_gamma(r) - log_gamma(y + 1.0) + r * (np.log(r) - np.log(r + mu)) + y * (np.log(mu) - np.log(r + mu)))
    ).sum(axis=1)
    w = d.used * mu / (1.0 + alpha * mu)
    a, b = w.sum(axis=1), (w * d.test).sum(axis=1)
    return ll - 0.5 * np.log(np.maximum(a * b - b * b, TINY))


def _maximise(f, lo: np.ndarray, hi: np.ndarray, steps: int = 36) -> np.ndarray:
    """Golden-section maximum of a vector of one-dimensional functions."""
    g = (5**0.5 - 1) / 2
    lo, hi = lo.copy(), hi.copy()
    c, e = hi - g * (hi - lo), lo + g * (hi - lo)
    fc, fe = f(c), f(e)
    for _ in range(steps):
        left = fc > fe
        hi, lo = np.where(left, e, hi), np.where(left, lo, c)
        nc, ne = hi - g * (hi - lo), lo + g * (hi - lo)
        probe = np.where(left, nc, ne)
        fp = f(probe)
        c, e, fc, fe = np.where(left, nc, e), np.where(left, c, ne), np.where(left, fp, fe), np.where(left, fc, fp)
    return (lo + hi) / 2


def _by_chunk(batches: Iterator[pd.DataFrame], d: Design | None) -> Iterator[tuple[pd.DataFrame, np.ndarray, Design]]:
    """Bounded blocks of gene rows with their dense counts and design; rows with designs of their own lie beside rows of like length."""
    for whole in batches:
        if d is None:
            whole = whole.iloc[np.argsort(whole["x"].map(len).to_numpy(), kind="stable")]
        start = 0
        while start < len(whole):
            m = len(d.x) if d is not None else max(len(whole["x"].iloc[min(start + 1000, len(whole) - 1)]), 1)
            pdf = whole.iloc[start : start + max(1, min(int(2e6 // max(m, 1)), len(whole) if d is not None else 1000))]
            start += len(pdf)
            own = d if d is not None else Design.of_rows(pdf["x"], pdf["sf"])
            yield pdf, _dense(pdf["pos"], pdf["val"], own.used.shape[1]), own


GENE_FITS = (
    "var_id string, pos array<int>, val array<double>, base_mean double, disp_moments double, disp_init double, "
    "beta0 double, beta1 double, disp_gene double"
)
FINAL_FITS = (
    "gene string, base_mean double, beta1 double, se double, dispersion double, disp_gene double, disp_fit double, "
    "disp_map double, disp_outlier boolean"
)
OWN = ["x", "sf", "n_samples"]
OWN_TYPES = "x array<double>, sf array<double>, n_samples int"


def gene_fits(vectors: DataFrame, d: Design | None, with_mle: bool = True) -> DataFrame:
    """Per-gene estimates; without ``d`` the rows bring their type's samples (``cell_type``, ``x``, ``sf``, ``n_samples``)."""
    extra = [] if d is not None else [KEY, *OWN]

    def run(batches):
        for pdf, y, own in _by_chunk(batches, d):
            norm = y / np.atleast_2d(own.sf)
            moments, init = _starting_dispersion(norm, own)
            b0, b1, disp = np.zeros(len(y)), np.zeros(len(y)), init
            if with_mle:
                b0, b1, _ = _irls(y, init, own)
                mu = _mu(b0, b1, own)
                lo, hi = np.full(len(y), np.log(own.min_disp / 10)), np.broadcast_to(np.log(own.max_disp), len(y))
                disp = np.clip(np.exp(_maximise(lambda t: _profile(y, mu, t, own), lo, hi)), own.min_disp, own.max_disp)
            yield pdf[["var_id", "pos", "val", *extra]].assign(
                base_mean=_mean(norm, own.used), disp_moments=moments, disp_init=init, beta0=b0, beta1=b1, disp_gene=disp
            )

    return vectors.mapInPandas(run, GENE_FITS + (f", {KEY} string, {OWN_TYPES}" if extra else ""))


def _trend_sums(used: DataFrame, tries: pd.DataFrame) -> pd.DataFrame:
    """For every (key, try) of (a, b) pairs: cost, gradient (2) and Gauss-Newton matrix (3) in log a, log b, and the number of genes in the band."""
    table = used.sparkSession.createDataFrame(tries, "k string, t int, a double, b double, band_a double, band_b double")
    m, y = F.col("base_mean"), F.col("disp_gene")
    rel = y / (F.col("band_a") + F.col("band_b") / m)
    inside = used.join(F.broadcast(table), used[KEY] == table["k"]).where(F.col("band_a").isNull() | ((rel > 1e-4) & (rel < 15.0)))
    pred = F.col("a") + F.col("b") / m
    r, slope = y / pred - 1.0, -y / (pred * pred)
    ja, jb = slope * F.col("a"), slope * F.col("b") / m
    terms = {"s0": r * r, "s1": ja * r, "s2": jb * r, "s3": ja * ja, "s4": ja * jb, "s5": jb * jb}
    return inside.groupBy("k", "t").agg(*[F.sum(x).alias(n) for n, x in terms.items()], F.count(F.lit(1)).alias("n")).toPandas()


def fit_trends(fits: DataFrame, min_disp: float = 1e-8, max_bands: int = 20, max_steps: int = 60) -> pd.DataFrame:
    """The trend a + b / mean of every cell type: one row a type with ``type``, ``a``, ``b``, ``converged``, ``n_genes``.

    Relative residuals by damped Gauss-Newton steps, then again without the genes far off the trend until the trend
    stays.  A pass evaluates the next candidates of all types that are still moving, as sums grouped by type; the
    driver holds six sums a candidate.
    """
    y = F.col("disp_gene")
    enough = (F.col("base_mean") > 0) & (y > 100 * min_disp)
    sizes = fits.groupBy(KEY).agg(
        F.count_if(enough).alias("n_genes"), F.avg(F.when(y > 10 * min_disp, y)).alias("flat_low"), F.avg(F.when(y > 100 * min_disp, y)).alias("flat")
    ).toPandas()
    out = pd.DataFrame({KEY: sizes[KEY], "type": "mean", "a": sizes["flat_low"].fillna(min_disp).clip(lower=min_disp), "b": 0.0, "converged": True, "n_genes": sizes["n_genes"]})
    rows = np.flatnonzero(sizes["n_genes"].to_numpy() >= 10)
    if not len(rows):
        return out
    used = cut(fits.where(enough).select(KEY, "base_mean", "disp_gene"))
    names = sizes[KEY].to_numpy(object)[rows]
    place = {k: i for i, k in enumerate(names)}
    n = len(rows)
    coefs, band = np.tile([0.1, 1.0], (n, 1)), np.full((n, 2), np.nan)
    theta, now = np.log(coefs), np.zeros((n, 6))
    bands, steps, fresh, live, settled = np.zeros(n, int), np.zeros(n, int), np.ones(n, bool), np.ones(n, bool), np.zeros(n, bool)
    while live.any():
        tries = np.full((n, len(DAMPING), 2), np.nan)
        tries[live & fresh, 0] = theta[live & fresh]
        moving = np.flatnonzero(live & ~fresh)
        gram = now[moving][:, [3, 4, 4, 5]].reshape(-1, 2, 2)
        for t, damp in enumerate(DAMPING):
            ridge = gram + damp * np.maximum(gram, 1e-12) * np.eye(2)
            step = -(np.linalg.pinv(ridge) @ now[moving][:, 1:3, None])[:, :, 0]
            tries[moving, t] = theta[moving] + np.clip(step, -5.0, 5.0)
        k, t = np.nonzero(np.isfinite(tries[:, :, 0]))
        got = _trend_sums(used, pd.DataFrame({"k": names[k], "t": t.astype("int32"), "a": np.exp(tries[k, t, 0]), "b": np.exp(tries[k, t, 1]), "band_a": band[k, 0], "band_b": band[k, 1]}).replace({np.nan: None}))
        sums, count = np.full((n, len(DAMPING), 6), np.inf), np.zeros(n, int)
        at = got["k"].map(place).to_numpy(int)
        sums[at, got["t"].to_numpy()] = got[[f"s{j}" for j in range(6)]].to_numpy(float)
        count[at] = got["n"].to_numpy()
        first = live & fresh
        live[first & (count < 10)] = False  # too few genes in the band: the last trend stays
        begun = first & live
        now[begun], fresh[begun], steps[begun] = sums[begun, 0], False, 0
        cost = np.where(np.isfinite(sums[moving, :, 0]), sums[moving, :, 0], np.inf)
        best = cost.argmin(axis=1)
        better = cost.min(axis=1) < now[moving, 0] * (1 - 1e-12)
        change = np.abs(tries[moving, best] - theta[moving]).max(axis=1)
        go = moving[better]
        theta[go], now[go] = tries[go, best[better]], sums[go, best[better]]
        steps[moving] += 1
        ended = moving[~better | (change < 1e-9) | (steps[moving] >= max_steps)]
        new = np.exp(theta[ended])
        settled[ended] = (np.log(new / coefs[ended]) ** 2).sum(axis=1) < 1e-6
        coefs[ended], band[ended], fresh[ended] = new, new, True
        bands[ended] += 1
        live[ended[settled[ended] | (bands[ended] >= max_bands)]] = False
    good = np.isfinite(coefs).all(axis=1) & (coefs > 0).all(axis=1)
    flat = sizes["flat"].fillna(min_disp).clip(lower=min_disp).to_numpy()[rows]
    out.loc[rows, "type"] = np.where(good, "parametric", "mean_fallback")
    out.loc[rows, "a"], out.loc[rows, "b"], out.loc[rows, "converged"] = np.where(good, coefs[:, 0], flat), np.where(good, coefs[:, 1], 0.0), settled
    return out


def fit_trend(fits: DataFrame, min_disp: float = 1e-8) -> dict:
    """Parametric trend a + b / mean of one contrast."""
    found = fit_trends(fits.withColumn(KEY, F.lit("all")), min_disp)
    return found.iloc[0].to_dict() if len(found) else {"type": "mean", "a": min_disp, "b": 0.0}


def _with_trend(fits: DataFrame, a: Column, b: Column, min_disp: float) -> DataFrame:
    return fits.withColumn("disp_fit", F.greatest(a + b / F.greatest(F.col("base_mean"), F.lit(float(TINY))), F.lit(min_disp)))


def add_trend(fits: DataFrame, trend: dict, min_disp: float = 1e-8) -> DataFrame:
    return _with_trend(fits, F.lit(float(trend["a"])), F.lit(float(trend["b"])), min_disp)


def residual_spread(fits: DataFrame, n_samples: int, min_disp: float = 1e-8, floor: float = 0.25) -> tuple[float, float]:
    """(prior variance, variance of log residuals over all genes)."""
    row = fits.agg(*_spreads(min_disp)).head()
    return _prior(row["above"], n_samples, floor), float(row["every"] or 0.0)


def _spreads(min_disp: float) -> list[Column]:
    resid = F.ln(F.greatest(F.col("disp_gene"), F.lit(min_disp))) - F.ln(F.greatest(F.col("disp_fit"), F.lit(min_disp)))
    return [F.var_samp(F.when(F.col("disp_gene") >= 100 * min_disp, resid)).alias("above"), F.var_samp(resid).alias("every")]


def _prior(above: float | None, n_samples: int, floor: float) -> float:
    df = n_samples - 2
    return floor if above is None or not np.isfinite(above) or df <= 3 else max(float(above) - trigamma(df / 2.0), floor)


def final_fits(fits: DataFrame, d: Design | None, prior_var: float | None = None, spread: float | None = None) -> DataFrame:
    """Shrunken dispersions and coefficients; without ``d`` the rows bring samples, ``prior_var`` and ``spread`` of their type."""

    def run(batches):
        for pdf, y, own in _by_chunk(batches, d):
            prior = np.maximum(pdf["prior_var"].to_numpy() if d is None else prior_var, 1e-8)
            wide = np.sqrt(np.maximum(pdf["spread"].to_numpy() if d is None else spread, 0.0))
            gene, fit = pdf["disp_gene"].to_numpy(), pdf["disp_fit"].to_numpy()
            mu = _mu(pdf["beta0"].to_numpy(), pdf["beta1"].to_numpy(), own)
            init = np.log(np.clip(np.where(gene > 0.1 * fit, gene, fit), own.min_disp, own.max_disp))
            centre = np.log(np.maximum(fit, own.min_disp))
            lo = np.maximum(np.log(own.min_disp / 10), init - 4.0)
            hi = np.minimum(np.log(own.max_disp), init + 4.0)
            score = lambda t: _profile(y, mu, t, own) - 0.5 * (t - centre) ** 2 / prior  # noqa: B023, E731
            shrunk = np.clip(np.exp(_maximise(score, lo, hi)), own.min_disp, own.max_disp)
            far = np.log(np.maximum(gene, own.min_disp)) > centre + 2.0 * wide
            disp = np.where(far, gene, shrunk)
            _, b1, se = _irls(y, disp, own)
            found = {
                "gene": pdf["var_id"].to_numpy(), "base_mean": pdf["base_mean"].to_numpy(), "beta1": b1, "se": se,
                "dispersion": disp, "disp_gene": gene, "disp_fit": fit, "disp_map": shrunk, "disp_outlier": far,
            }
            yield pd.DataFrame(found | ({KEY: pdf[KEY].to_numpy()} if d is None else {}))

    return fits.mapInPandas(run, FINAL_FITS + (f", {KEY} string" if d is None else ""))


def prepare(
    counts: DataFrame, metadata: DataFrame, condition: str, ctrl: str, test: str, min_total: int = 10, min_samples: int = 2
) -> tuple[DataFrame, Design, DataFrame]:
    """Gene vectors over the contrast's samples, the shared design, and the size factors."""
    samples, _, _ = contrast_samples(metadata, condition, ctrl, test, min_samples)
    samples = cut(samples)
    data = cut(counts.where(F.col("count") > 0).join(samples, "pseudobulk_id", "left_semi"))
    seen = data.groupBy("var_id").agg(F.sum("count").alias("_t")).where(F.col("_t") >= min_total).select("var_id")
    data = cut(data.join(seen, "var_id", "left_semi"))
    factors = cut(size_factors(data, samples))
    table = samples.join(factors, "pseudobulk_id").orderBy("pseudobulk_id").toPandas()
    position = samples.sparkSession.createDataFrame(
        [(p, i) for i, p in enumerate(table["pseudobulk_id"])], "pseudobulk_id string, pos int"
    )
    vectors = data.join(position, "pseudobulk_id").groupBy(F.col("var_id").cast("string").alias("var_id")).agg(
        F.collect_list(F.struct("pos", F.col("count").cast("double").alias("c"))).alias("_e")
    ).select("var_id", F.col("_e.pos").alias("pos"), F.col("_e.c").alias("val"))
    design = Design(table["is_test"].to_numpy(float), table["size_factor"].to_numpy(float))
    return vectors, design, factors


def size_factors_by_type(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """``size_factors`` of every cell type: (cell_type, pseudobulk_id, size_factor).

    ``counts``: positive (cell_type, pseudobulk_id, var_id, count); ``samples``: (cell_type, pseudobulk_id, n_samples).
    """
    both = [KEY, "pseudobulk_id"]
    n = samples.select(KEY, "n_samples").distinct()
    per_gene = counts.groupBy(KEY, "var_id").agg(F.count(F.lit(1)).alias("k"), F.exp(F.avg(F.ln("count"))).alias("geo")).join(n, KEY)
    per_gene = cut(per_gene.withColumn("full", F.col("k") == F.col("n_samples")))
    some = per_gene.groupBy(KEY).agg(F.max("full").alias("some"))
    used = per_gene.join(some, KEY).where(F.col("full") | ~F.col("some"))
    ratios = counts.join(used.select(KEY, "var_id", "geo"), [KEY, "var_id"]).select(*both, (F.col("count") / F.col("geo")).alias("r"))
    libs = counts.groupBy(*both).agg(F.sum("count").cast("double").alias("lib"))
    table = samples.select(*both).join(exact_quantiles(ratios, both, "r", {"sf": 0.5}), both, "left").join(libs, both, "left")
    missing = table.groupBy(KEY).agg(F.max(F.col("sf").isNull() | (F.col("sf") <= 0)).alias("missing"))
    table = cut(table.join(missing, KEY).select(*both, F.when(F.col("missing"), F.coalesce("lib", F.lit(1e-8))).otherwise(F.col("sf")).alias("sf")))
    centre = table.groupBy(KEY).agg(F.exp(F.avg(F.ln("sf"))).alias("centre"))
    return table.join(centre, KEY).select(*both, (F.col("sf") / F.col("centre")).alias("size_factor"))


def contrast_by_type(
    counts: DataFrame, metadata: DataFrame, condition: str, ctrl: str, test: str, min_total: int = 10, min_samples: int = 2
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Positive counts, samples and (cell_type, n_ctrl, n_test, tested) of the contrast of every cell type.

    A type with fewer than ``min_samples`` samples in a group has no counts and ``tested`` false.
    """
    label = F.col(condition).cast("string")
    name = F.col(KEY).cast("string").alias(KEY)
    samples = metadata.where(label.isin([str(ctrl), str(test)])).select(name, "pseudobulk_id", (label == str(test)).alias("is_test"))
    held = samples.groupBy(KEY).agg(F.count_if(~F.col("is_test")).alias("n_ctrl"), F.count_if("is_test").alias("n_test"))
    sizes = metadata.select(name).distinct().join(held, KEY, "left").na.fill(0, ["n_ctrl", "n_test"])
    sizes = cut(sizes.withColumn("tested", F.least("n_ctrl", "n_test") >= min_samples))
    n = (F.col("n_ctrl") + F.col("n_test")).cast("int").alias("n_samples")
    samples = cut(samples.join(sizes.where("tested").select(KEY, n), KEY))
    data = cut(counts.where(F.col("count") > 0).select("pseudobulk_id", F.col("var_id").cast("string").alias("var_id"), F.col("count").cast("double").alias("count")).join(samples.select(KEY, "pseudobulk_id"), "pseudobulk_id"))
    seen = data.groupBy(KEY, "var_id").agg(F.sum("count").alias("_t")).where(F.col("_t") >= min_total).select(KEY, "var_id")
    return cut(data.join(seen, [KEY, "var_id"], "left_semi")), samples, sizes


def prepare_by_type(
    counts: DataFrame, metadata: DataFrame, condition: str, ctrl: str, test: str, min_total: int = 10, min_samples: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Gene vectors of all cell types with their type's samples, and (cell_type, n_ctrl, n_test, tested)."""
    data, samples, sizes = contrast_by_type(counts, metadata, condition, ctrl, test, min_total, min_samples)
    factors = size_factors_by_type(data, samples)
    listed = F.array_sort(F.collect_list(F.struct("pseudobulk_id", F.col("is_test").cast("double").alias("x"), F.col("size_factor").alias("sf"))))
    design = cut(samples.join(factors, [KEY, "pseudobulk_id"]).groupBy(KEY, "n_samples").agg(listed.alias("s")))
    place = design.select(KEY, F.posexplode("s").alias("pos", "s")).select(KEY, F.col("s.pseudobulk_id").alias("pseudobulk_id"), "pos")
    vectors = data.join(place, [KEY, "pseudobulk_id"]).groupBy(KEY, "var_id").agg(F.collect_list(F.struct("pos", "count")).alias("_e"))
    vectors = vectors.join(design.select(KEY, "n_samples", F.col("s.x").alias("x"), F.col("s.sf").alias("sf")), KEY)
    return vectors.select(KEY, "var_id", F.col("_e.pos").alias("pos"), F.col("_e.count").alias("val"), *OWN), sizes


def nb_wald_by_type(
    counts: DataFrame, metadata: DataFrame, condition: str, ctrl: str, test: str, min_total: int = 10, min_samples: int = 2
) -> tuple[DataFrame, DataFrame]:
    """The full contrast of every cell type in the same few jobs, FDR within the type; and (cell_type, n_ctrl, n_test, tested)."""
    vectors, sizes = prepare_by_type(counts, metadata, condition, ctrl, test, min_total, min_samples)
    min_disp = Design.min_disp
    fits = cut(gene_fits(vectors, None))
    spark = fits.sparkSession
    # one row a cell type from here to the final fit
    trends = fit_trends(fits, min_disp)
    trend = F.broadcast(spark.createDataFrame(trends[[KEY, "a", "b"]], f"{KEY} string, a double, b double"))
    fits = _with_trend(fits.join(trend, KEY), F.col("a"), F.col("b"), min_disp).drop("a", "b")
    spread = fits.groupBy(KEY, "n_samples").agg(*_spreads(min_disp)).toPandas()
    rows = [(r[KEY], _prior(r.above, int(r.n_samples), 0.25), float(r.every) if r.every is not None and np.isfinite(r.every) else 0.0) for _, r in spread.iterrows()]
    prior = F.broadcast(spark.createDataFrame(rows, f"{KEY} string, prior_var double, spread double"))
    return _tested(cut(final_fits(fits.join(prior, KEY), None)), [KEY]), sizes


def _tested(done: DataFrame, group: list[str]) -> DataFrame:
    ln2 = float(np.log(2.0))
    z = F.coalesce(F.try_divide(F.col("beta1"), F.col("se")), F.lit(0.0))
    tested = cut(done.withColumn("stat", z).withColumn("pvalue", F.coalesce(normal_p("stat"), F.lit(1.0))))
    return benjamini_hochberg(tested, "pvalue", group).select(
        *group, "gene", F.col("base_mean").alias("baseMean"), (F.col("beta1") / ln2).alias("log2FoldChange"),
        (F.col("se") / ln2).alias("lfcSE"), "stat", "pvalue", "padj", "dispersion", F.col("disp_gene").alias("dispGeneEst"),
        F.col("disp_fit").alias("dispFit"), F.col("disp_map").alias("dispMAP"), F.col("disp_outlier").alias("dispOutlier"),
    )


def nb_wald(
    counts: DataFrame, metadata: DataFrame, condition: str, ctrl: str, test: str, min_total: int = 10, min_samples: int = 2
) -> DataFrame:
    """Full contrast: dispersions, trend, shrinkage, Wald test and FDR, ordered by (pvalue, gene)."""
    vectors, d, _ = prepare(counts, metadata, condition, ctrl, test, min_total, min_samples)
    fits = cut(gene_fits(vectors, d))
    fits = add_trend(fits, fit_trend(fits, d.min_disp), d.min_disp)
    prior, spread = residual_spread(fits, len(d.x), d.min_disp)
    return _tested(cut(final_fits(fits, d, prior, spread)), []).orderBy("pvalue", "gene")
