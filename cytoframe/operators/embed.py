"""Variable genes, program scores, principal components and batch correction.

Cell-sized data stays distributed; what meets on the driver is gene-, component- or
cluster-sized (selected genes x components, clusters x batches).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions.ordered import exact_quantiles, running_sums
from cytoframe.functions.partials import Rows, matrix_sums
from cytoframe.operators.matrix import gene_moments, row_count
from cytoframe.session import cut

# Published stress and cell-cycle gene lists.
STRESS = "FOS JUN JUNB JUND ATF3 EGR1 DUSP1 HSPA1A HSPA1B DNAJB1".split()
CYCLE_S = (
    "MCM5 PCNA TYMS FEN1 MCM2 MCM4 RRM1 UNG GINS2 MCM6 CDCA7 DTL PRIM1 UHRF1 HELLS RFC2 RPA2 NASP RAD51AP1 GMNN WDR76 SLBP CCNE2 UBR7 "
    "POLD3 MSH2 ATAD2 RAD51 RRM2 CDC45 CDC6 EXO1 TIPIN DSCC1 BLM CASP8AP2 USP1 CLSPN POLA1 CHAF1B BRIP1 E2F8"
).split()
CYCLE_G2M = (
    "HMGB2 CDK1 NUSAP1 UBE2C BIRC5 TPX2 TOP2A NDC80 CKS2 NUF2 CKS1B MKI67 TMPO CENPF TACC3 FAM64A SMC4 CCNB2 CKAP2L CKAP2 AURKB BUB1 KIF11 "
    "ANP32E TUBB4B GTSE1 KIF20B HJURP CDCA3 HN1 CDC20 TTK CDC25C KIF2C RANGAP1 NCAPD2 DLGAP5 CDCA2 CDCA8 ECT2 KIF23 HMMR AURKA PSRC1 ANLN "
    "LBR CKAP5 CENPE CTCF NEK2 G2E3 GAS2L3 CBX5 CENPA"
).split()


# ---------------------------------------------------------------- variable genes
def hvg_dispersion(expr_norm: DataFrame, obs: DataFrame, n_top: int) -> DataFrame:
    """Dispersion (variance / mean) standardised by the median and MAD of 5 %-wide mean bins."""
    m = gene_moments(expr_norm, obs).select("var_id", "mean", F.col("var_samp").alias("variance"))
    m = cut(m.withColumn("dispersion", F.col("variance") / F.greatest("mean", F.lit(1e-12))))
    probs = {f"p{p}": p / 100 for p in range(10, 101, 5)}
    edges = exact_quantiles(m, [], "mean", probs).head()
    binned = m.withColumn("bin", sum((F.col("mean") > float(edges[k])).cast("int") for k in probs))
    mid = cut(exact_quantiles(binned, ["bin"], "dispersion", {"med": 0.5}))
    dev = binned.join(mid, "bin").withColumn("dev", F.abs(F.col("dispersion") - F.col("med")))
    mad = exact_quantiles(dev, ["bin"], "dev", {"mad": 0.5})
    scaled = dev.join(mad, "bin").withColumn("dispersion_norm", F.try_divide(F.col("dispersion") - F.col("med"), F.col("mad") / 0.6744897501960817))
    ranked = scaled.orderBy(F.desc_nulls_last("dispersion_norm"), "var_id").limit(n_top).select("var_id", F.lit(True).alias("_t"))
    return scaled.join(ranked, "var_id", "left").select(
        "var_id", "mean", "dispersion", "dispersion_norm", F.coalesce("_t", F.lit(False)).alias("highly_variable")
    )


def _trend_vertices(x_grid: np.ndarray, span: float, count: int) -> list[tuple[float, float]]:
    """(position, bandwidth) at evenly spread quantiles; the bandwidth covers ``span`` of the points."""
    probs = np.linspace(0, 1, len(x_grid))
    out = []
    for x0 in np.unique(np.quantile(x_grid, np.linspace(0, 1, count))):
        lo, hi = 0.0, x_grid[-1] - x_grid[0] + 1e-9
        for _ in range(60):
            h = (lo + hi) / 2
            covered = np.interp(x0 + h, x_grid, probs) - np.interp(x0 - h, x_grid, probs)
            lo, hi = (h, hi) if covered < span else (lo, h)
        out.append((float(x0), float(hi) * 1.0001 + 1e-9))
    return out


def mean_variance_trend(moments: DataFrame, group: str, span: float = 0.3, vertices: int = 48) -> DataFrame:
    """Local quadratic fit of log10 variance on log10 mean per group (``fit``).

    The fit is solved at a few dozen vertices from weighted sums (one aggregate over the
    genes near each vertex) and carried to every gene by cubic Hermite interpolation.
    """
    pts = cut(moments.where((F.col("mean") > 0) & (F.col("var_samp") > 0)).withColumns({"x": F.log10("mean"), "y": F.log10("var_samp")}))
    probs = F.array(*[F.lit(i / 200) for i in range(201)])
    grids = pts.groupBy(group).agg(F.percentile_approx("x", probs, F.lit(10_000)).alias("g")).collect()
    spark = pts.sparkSession
    rows = [(r[group], i, x0, h) for r in grids for i, (x0, h) in enumerate(_trend_vertices(np.sort(np.array(r["g"])), span, vertices))]
    kind = dict(pts.dtypes)[group]
    knots = spark.createDataFrame(rows, f"{group} {kind}, i int, x0 double, h double")
    near = pts.join(knots, group).where(F.abs(F.col("x") - F.col("x0")) < F.col("h"))
    u = F.abs(F.col("x") - F.col("x0")) / F.col("h")
    w, d = F.pow(1 - F.pow(u, 3), 3), F.col("x") - F.col("x0")
    sums = near.groupBy(group, "i", "x0").agg(
        *[F.sum(w * F.pow(d, p)).alias(f"s{p}") for p in range(5)], *[F.sum(w * F.pow(d, p) * F.col("y")).alias(f"t{p}") for p in range(3)]
    ).collect()
    curves: dict = {}
    for r in sorted(sums, key=lambda r: (str(r[group]), r["i"])):
        gram = np.array([[r[f"s{a + b}"] for b in range(3)] for a in range(3)])
        beta = np.linalg.lstsq(gram, np.array([r["t0"], r["t1"], r["t2"]]), rcond=1e-10)[0]
        curves.setdefault(r[group], []).append((r["x0"], beta[0], beta[1]))
    curves = {k: np.array(v) for k, v in curves.items()}

    def interpolate(batches):
        for pdf in batches:
            out = np.zeros(len(pdf))
            for key, idx in pdf.groupby(group, sort=False).indices.items():
                c, x = curves[key], pdf["x"].to_numpy()[idx]
                if len(c) == 1:
                    out[idx] = c[0, 1]
                    continue
                j = np.clip(np.searchsorted(c[:, 0], x) - 1, 0, len(c) - 2)
                step = c[j + 1, 0] - c[j, 0]
                t = np.clip((x - c[j, 0]) / step, 0.0, 1.0)
                out[idx] = (
                    (2 * t**3 - 3 * t**2 + 1) * c[j, 1] + (t**3 - 2 * t**2 + t) * step * c[j, 2]
                    + (3 * t**2 - 2 * t**3) * c[j + 1, 1] + (t**3 - t**2) * step * c[j + 1, 2]
                )
            yield pdf.assign(fit=out)

    fields = ", ".join(f"`{n}` {t}" for n, t in pts.dtypes)
    return pts.mapInPandas(interpolate, f"{fields}, fit double")


def hvg_standardized(counts: DataFrame, obs: DataFrame, n_top: int = 3000, batch_key: str | None = "sample_id", span: float = 0.3) -> DataFrame:
    """Variance of clipped standardised counts per batch; genes ordered by median rank over batches."""
    cells = obs.select("obs_id", (F.col(batch_key).cast("string") if batch_key else F.lit("all")).alias("b"))
    tagged = cut(counts.join(cells, "obs_id"))
    sizes = cells.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    v = F.col("value")
    sums = tagged.groupBy("b", "var_id").agg(F.sum(v).alias("s1"), F.sum(v * v).alias("s2")).join(sizes, "b")
    mean = F.col("s1") / F.col("n")
    moments = sums.select(
        "b", "var_id", "n", mean.alias("mean"), F.try_divide(F.greatest(F.col("s2") - F.col("n") * mean * mean, F.lit(0.0)), F.col("n") - 1).alias("var_samp")
    )
    fitted = cut(mean_variance_trend(moments, "b", span).select("b", "var_id", "n", "mean", "var_samp", F.sqrt(F.pow(F.lit(10.0), F.col("fit"))).alias("sd")))
    top = F.col("mean") + F.col("sd") * F.sqrt("n")
    clipped = tagged.join(fitted, ["b", "var_id"]).withColumn("c", F.least(v, top)).groupBy("b", "var_id", "n", "mean", "sd").agg(
        F.sum("c").alias("c1"), F.sum(F.col("c") * F.col("c")).alias("c2")
    )
    score = (F.col("n") * F.col("mean") * F.col("mean") + F.col("c2") - 2 * F.col("c1") * F.col("mean")) / ((F.col("n") - 1) * F.col("sd") * F.col("sd"))
    scored = clipped.select("b", "var_id", score.alias("vn"))
    order = Window.partitionBy("b").orderBy(F.col("vn").desc(), "var_id")
    ranked = scored.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n_top)
    per_gene = ranked.groupBy("var_id").agg(F.median((F.col("r") - 1).cast("double")).alias("highly_variable_rank"), F.count(F.lit(1)).alias("n_batches"))
    norm = scored.groupBy("var_id").agg(F.avg("vn").alias("variances_norm"))
    overall = gene_moments(counts, obs).select("var_id", F.col("mean").alias("means"), F.col("var_samp").alias("variances"))
    chosen = per_gene.orderBy("highly_variable_rank", F.col("n_batches").desc(), "var_id").limit(n_top).select("var_id", F.lit(True).alias("_t"))
    return overall.join(norm, "var_id", "left").join(per_gene, "var_id", "left").join(chosen, "var_id", "left").select(
        "var_id", "means", "variances", F.coalesce("variances_norm", F.lit(0.0)).alias("variances_norm"), "highly_variable_rank",
        F.coalesce("_t", F.lit(False)).alias("highly_variable"),
    )


def identity_genes(var: DataFrame, biology: str = "highly_variable") -> DataFrame:
    """Variable genes without mitochondrial or explicitly excluded ones."""
    flags = [F.col(c) for c in ("mt_gene", "exclude_from_identity_hvg") if c in var.columns]
    excluded = F.lit(False)
    for f in flags:
        excluded = excluded | F.coalesce(f, F.lit(False))
    return var.withColumns({"excluded_from_identity": excluded, "highly_variable_identity": F.col(biology) & ~excluded})


def program_genes(var: DataFrame, hvg: str | None = None) -> DataFrame:
    """Genes for program discovery: variable (if flagged) and neither mitochondrial nor haemoglobin."""
    keep = F.col(hvg) if hvg and hvg in var.columns else F.lit(True)
    for c in ("mt_gene", "hb_gene"):
        if c in var.columns:
            keep = keep & ~F.col(c)
    return var.where(keep)


# ---------------------------------------------------------------- program scores
def score_gene_set(expr_norm: DataFrame, obs: DataFrame, genes: DataFrame, name: str, n_bins: int = 25, n_control: int = 50, seed: int = 0) -> DataFrame:
    """Mean of the set minus mean of seeded control genes with similar average expression.

    Genes of one expression bin (by rank of the mean) are ordered by a seeded hash and the
    first ``n_control`` outside the set serve as controls.
    """
    wanted = genes.select("var_id").distinct()
    means = cut(gene_moments(expr_norm, obs).select("var_id", "mean"))
    distinct = means.groupBy("mean").agg(F.count(F.lit(1)).alias("w"))
    low = running_sums(distinct, [], "mean", {"_upto": F.col("w")}).select("mean", (F.col("_upto") - F.col("w") + 1).alias("rank"))
    width = F.greatest(F.round(row_count(means) / F.lit(float(n_bins - 1))), F.lit(1.0))
    binned = cut(means.join(low, "mean").select("var_id", F.floor(F.col("rank") / width).alias("bin")))
    inside = binned.join(wanted, "var_id", "left_semi")
    pool = binned.join(inside.select("bin").distinct(), "bin", "left_semi").join(wanted, "var_id", "left_anti")
    shuffled = Window.partitionBy("bin").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("var_id").cast("string"))), "var_id")
    control = pool.withColumn("_r", F.row_number().over(shuffled)).where(F.col("_r") <= n_control)
    roles = cut(inside.select("var_id", F.lit(True).alias("hit")).unionByName(control.select("var_id", F.lit(False).alias("hit"))))
    n_hit, n_ctrl = roles.where("hit").count(), roles.where("not hit").count()
    sums = expr_norm.join(roles, "var_id").groupBy("obs_id").agg(
        F.sum(F.when(F.col("hit"), F.col("value"))).alias("h"), F.sum(F.when(~F.col("hit"), F.col("value"))).alias("c")
    )
    mean = lambda c, n: F.coalesce(F.col(c), F.lit(0.0)) / float(max(n, 1))
    score = mean("h", n_hit) - mean("c", n_ctrl) if n_hit else F.lit(0.0)
    return obs.select("obs_id").join(sums, "obs_id", "left").select("obs_id", score.alias(name))


def score_programs(expr_norm: DataFrame, obs: DataFrame, var: DataFrame, organism: str = "human", symbol: str = "symbol") -> DataFrame:
    """Stress, ribosomal, S, G2M and proliferation scores per cell."""
    case = str.capitalize if organism.lower().startswith("mouse") else str
    by_symbol = lambda names: var.where(F.col(symbol).isin([case(g) for g in names]))
    sets = {"stress_score": by_symbol(STRESS), "cell_cycle_s_score": by_symbol(CYCLE_S), "cell_cycle_g2m_score": by_symbol(CYCLE_G2M)}
    if "ribo_gene" in var.columns:
        sets["ribo_score"] = var.where("ribo_gene")
    out = obs.select("obs_id")
    for name, genes in sets.items():
        out = out.join(score_gene_set(expr_norm, obs, genes, name), "obs_id")
    if "ribo_gene" not in var.columns:
        out = out.withColumn("ribo_score", F.lit(0.0))
    return out.withColumn("proliferation_score", F.greatest("cell_cycle_s_score", "cell_cycle_g2m_score"))


# ---------------------------------------------------------------- vectors
def dense_rows(expr: DataFrame, obs: DataFrame, genes: DataFrame) -> tuple[DataFrame, list]:
    """(obs_id, v): the selected genes of each cell as one array, genes in key order."""
    names = [r[0] for r in genes.select("var_id").distinct().orderBy("var_id").collect()]
    kind = dict(expr.dtypes)["var_id"]
    place = expr.sparkSession.createDataFrame(pd.DataFrame({"var_id": names, "g": np.arange(len(names), dtype="int32")}), f"var_id {kind}, g int")
    packed = expr.join(place, "var_id").groupBy("obs_id").agg(F.collect_list(F.struct("g", F.col("value").cast("double").alias("x"))).alias("e"))
    rows = obs.select("obs_id").join(packed, "obs_id", "left").select("obs_id", F.col("e.g").alias("g"), F.col("e.x").alias("x"))
    width = len(names)

    def fill(batches):
        for pdf in batches:
            v = np.zeros((len(pdf), width))
            for i, (g, x) in enumerate(zip(pdf["g"], pdf["x"])):
                if g is not None:
                    v[i, np.asarray(g, dtype=np.intp)] = x
            yield pd.DataFrame({"obs_id": pdf["obs_id"], "v": list(v)})

    return rows.mapInPandas(fill, f"obs_id {dict(obs.dtypes)['obs_id']}, v array<double>"), names


def _stack(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy())


def map_vectors(df: DataFrame, fn, keep: Sequence[str], out: str = "v") -> DataFrame:
    """Apply a matrix function to the ``v`` arrays batch by batch."""
    kinds = dict(df.dtypes)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf[list(keep)].assign(**{out: list(fn(_stack(pdf["v"]), pdf))})

    return df.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + f", {out} array<double>")


def pca(vectors: DataFrame, k: int = 50) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Centred scores (obs_id, v), components (d x k) and explained variance ratios.

    The components come from the covariance Spark ML sums up over partitions; each has
    its largest loading positive.
    """
    rows = vectors.select("obs_id", "v")
    model = PCA(k=k, inputCol="f", outputCol="p").fit(rows.select(array_to_vector("v").alias("f")))
    load = model.pc.toArray()
    load = load * np.where(load[np.abs(load).argmax(axis=0), np.arange(load.shape[1])] < 0, -1.0, 1.0)
    sums = matrix_sums(rows, lambda pdf: {"s": _stack(pdf["v"]).sum(axis=0, keepdims=True), "n": np.array([[len(pdf)]])})
    centre = (sums["s"] / sums["n"])[0] @ load
    return map_vectors(rows, lambda x, _: x @ load - centre, ["obs_id"]), load, model.explainedVariance.toArray()


def subspace_cosine(a: DataFrame, b: DataFrame, k: int | None = None) -> float:
    """Mean principal cosine between the column spaces of two score tables joined on obs_id.

    With X = Q R, QxT Qy = RxT^-1 (XT Y) Ry^-1, so three small Gram matrices are enough.
    """
    both = a.select("obs_id", F.col("v").alias("x")).join(b.select("obs_id", F.col("v").alias("y")), "obs_id")

    def grams(pdf):
        x, y = _stack(pdf["x"]), _stack(pdf["y"])
        w = min(x.shape[1], y.shape[1], k or 10**9)
        x, y = x[:, :w], y[:, :w]
        return {"xx": x.T @ x, "yy": y.T @ y, "xy": x.T @ y}

    s = matrix_sums(both, grams)
    if not s:
        return 0.0

    def inverse_root(g):
        val, vec = np.linalg.eigh(g)
        good = val > val.max() * 1e-12
        return vec[:, good] / np.sqrt(val[good])

    return float(np.clip(np.linalg.svd(inverse_root(s["xx"]).T @ s["xy"] @ inverse_root(s["yy"]), compute_uv=False), 0.0, 1.0).mean())


# ---------------------------------------------------------------- batch correction
def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _codes(pdf: pd.DataFrame, variables: int) -> np.ndarray:
    """Level numbers of each cell, one column a batch variable; levels of all variables are numbered on."""
    return pdf[[f"b{i}" for i in range(variables)]].to_numpy(np.int64)


def _memberships(z: np.ndarray, codes: np.ndarray, state: dict) -> np.ndarray:
    """Soft cluster weights; clusters already rich in a cell's batch are penalised."""
    score = -2.0 * (1.0 - _unit(z) @ state["y"].T) / state["sigma"]
    for column in codes.T:
        score += state["log_penalty"][column]
    score -= score.max(axis=1, keepdims=True)
    r = np.exp(score)
    return r / r.sum(axis=1, keepdims=True)


def _penalty(observed: np.ndarray, size: np.ndarray, share: np.ndarray, theta: float) -> np.ndarray:
    """(levels, clusters)."""
    expected = share[:, None] * size[None, :]
    return theta * np.log((expected + 1.0) / (observed + 1.0))


def _level_moments(r: np.ndarray, x: np.ndarray, codes: np.ndarray) -> dict[str, np.ndarray | Rows]:
    """Sums of a ridge fit on batch levels: cluster weights and weighted vectors in all and by level, weights by pairs of levels."""
    out: dict[str, np.ndarray | Rows] = {"r": r.sum(axis=0, keepdims=True), "rx": r.T @ x}
    held, moments = [], []
    for column in codes.T:
        order = np.argsort(column, kind="stable")
        levels, first = np.unique(column[order], return_index=True)
        held.append(levels)
        moments += [(r[rows].T @ x[rows]).ravel() for rows in np.split(order, first[1:])]
    out["o"] = Rows.by(codes.T.ravel(), np.tile(r, (codes.shape[1], 1)))
    out["ox"] = Rows(np.concatenate(held), np.array(moments))
    if codes.shape[1] > 1:
        pairs = [codes[:, i] << 32 | codes[:, j] for i in range(codes.shape[1]) for j in range(i)]
        out["pair"] = Rows.by(np.concatenate(pairs), np.tile(r, (len(pairs), 1)))
    return out


def level_coefficients(m: dict[str, np.ndarray | Rows], addend: np.ndarray, variables: int, everywhere: bool, tol: float = 1e-12, most: int = 500) -> np.ndarray:
    """Coefficients (levels, clusters, components) of the ridge fit with an intercept, from the sums of ``_level_moments``.

    With one variable the system of a cluster is an arrow (the intercept and a diagonal) and is solved in closed form;
    with several, conjugate gradients run on all clusters and components at once over the levels and the pairs of levels that occur,
    so no levels x levels matrix is made.  ``everywhere``: the penalties are added to every row of the system instead of its
    diagonal; its solutions are those without a penalty, and of these the one whose penalty-weighted sum is 0.
    """
    lam = addend[1:, None]
    o = m["o"].dense(len(lam))
    ox = m["ox"].dense(len(lam)).reshape(len(lam), o.shape[1], -1)
    size, x = m["r"][0], m["rx"]
    if variables == 1 and everywhere:
        mean = ox / o[:, :, None]
        return mean - (lam[:, :, None] * mean).sum(axis=0) / max(float(lam.sum()), 1e-300)
    if variables == 1:
        held = np.where(o + lam > 0, o + lam, 1.0)
        rest = size - (o * o / held).sum(axis=0)
        solved = rest > 1e-12 * np.maximum(size, 1e-300)
        start = np.where(solved[:, None], (x - (o[:, :, None] * ox / held[:, :, None]).sum(axis=0)) / np.where(solved, rest, 1.0)[:, None], 0.0)
        return (ox - o[:, :, None] * start[None]) / held[:, :, None]
    left, right, both = m["pair"].ids >> 32, m["pair"].ids & 0xFFFFFFFF, m["pair"].values[:, :, None]
    ridge = np.zeros_like(lam) if everywhere else lam

    def times(u0, u):
        out = o[:, :, None] * (u0[None] + u) + ridge[:, :, None] * u
        np.add.at(out, left, both * u[right])
        np.add.at(out, right, both * u[left])
        return size[:, None] * u0 + (o[:, :, None] * u).sum(axis=0), out

    dot = lambda a0, a, b0, b: a0 * b0 + (a * b).sum(axis=0)
    u0, u, r0, r = np.zeros_like(x), np.zeros_like(ox), x.copy(), ox.copy()
    p0, p, gap = r0, r, dot(r0, r, r0, r)
    goal = tol**2 * np.maximum(gap, 1e-300)
    for _ in range(most):
        if (gap <= goal).all():
            break
        q0, q = times(p0, p)
        along = dot(p0, p, q0, q)
        step = np.where((gap > goal) & (along > 0), gap / np.where(along > 0, along, 1.0), 0.0)
        u0, u, r0, r = u0 + step * p0, u + step * p, r0 - step * q0, r - step * q
        after = dot(r0, r, r0, r)
        turn = after / np.where(gap > 0, gap, 1.0)
        p0, p, gap = r0 + turn * p0, r + turn * p, after
    if everywhere:  # moving the intercept against all levels of a variable changes nothing
        u = u - (lam[:, :, None] * u).sum(axis=0) / max(float(lam.sum()), 1e-300)
    return u


def _initial_centres(cells: DataFrame, k: int, seed: int) -> np.ndarray:
    from pyspark.ml.clustering import KMeans

    unit = map_vectors(cells.select("obs_id", "v"), lambda x, _: _unit(x), ["obs_id"])
    model = KMeans(k=k, seed=seed, maxIter=10, featuresCol="f").fit(unit.select(array_to_vector("v").alias("f")))
    return _unit(np.array(model.clusterCenters()))


def penalty_vector(lam: float | Sequence[float], level_counts: Sequence[int]) -> np.ndarray:
    """0 for the intercept, then one value per level (scalar, per variable, or per level)."""
    given, total = np.ravel(np.asarray(lam, dtype=float)), int(np.sum(level_counts))
    times = {1: total, len(level_counts): level_counts, total: 1}
    # a single variable's own value and a scalar mean the same; one value per level comes as it is
    if len(given) not in times:
        raise ValueError("lambda does not match the batch variables or their levels")
    return np.r_[0.0, np.repeat(given, total if len(given) == 1 else times[len(given)])]


def _numbered(obs: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[int]]:
    """(obs_id, b0, b1, ...): level numbers of each batch variable, on from the variable before; and the numbers of levels.  A null is a level."""
    spark, counts = obs.sparkSession, []
    out = obs.select("obs_id", *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"n{i}") for i, k in enumerate(keys)])
    for i, key in enumerate(keys):
        names = sorted(r[0] for r in out.select(f"n{i}").distinct().limit(20_001).collect())
        if len(names) > 20_000:
            raise ValueError(f"batch variable {key} has too many levels")
        table = spark.createDataFrame([(n, j + sum(counts)) for j, n in enumerate(names)], f"n{i} string, b{i} bigint")
        out = out.join(F.broadcast(table), f"n{i}").drop(f"n{i}")
        counts.append(len(names))
    return out, counts


PACK = 2048


def _packed(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """(ids, v, z, codes): up to ``PACK`` cells a row, their vectors as doubles in bytes, as start (``z``) and as they are now (``v``)."""

    def pack(batches):
        for pdf in batches:
            for at in range(0, len(pdf), PACK):
                some = pdf.iloc[at : at + PACK]
                v = _stack(some["v"]).astype(float).tobytes()
                yield pd.DataFrame({"ids": [some["obs_id"].tolist()], "v": [v], "z": [v], "codes": [some[list(names)].to_numpy(np.int64).tobytes()]})

    return cells.mapInPandas(pack, f"ids array<{dict(cells.dtypes)['obs_id']}>, v binary, z binary, codes binary")


def _unpacked(pdf: pd.DataFrame, column: str, variables: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and level numbers of a packed row."""
    codes = np.frombuffer(pdf["codes"].iloc[0], dtype=np.int64).reshape(-1, variables)
    return np.frombuffer(pdf[column].iloc[0]).reshape(len(codes), -1), codes


def harmony(
    vectors: DataFrame, obs: DataFrame, batch_keys: Sequence[str], sigma: float = 0.1, theta: float = 2.0, lam: float = 1.0,
    max_iter: int = 20, rounds: int = 4, tol: float = 1e-4, seed: int = 0,
) -> tuple[DataFrame, DataFrame | None]:
    """(corrected vectors, memberships (obs_id, r)): soft clusters balanced over batches, then a linear shift per cluster.

    Every round is one pass that adds up clusters x components and levels x clusters sums; tasks send only levels they hold.
    Corrected vectors are written to the checkpoint folder once per outer round, memberships (as many numbers as clusters a cell) never.
    """
    keys = [k for k in batch_keys if k in obs.columns]
    tags, counts = _numbered(obs, keys)
    several = [k for k, c in zip(keys, counts, strict=True) if c > 1]
    if not several:
        return vectors.select("obs_id", "v"), None
    if len(several) < len(keys):
        keys = several
        tags, counts = _numbered(obs, keys)
    names, variables = [f"b{i}" for i in range(len(keys))], len(keys)
    cells = cut(vectors.select("obs_id", "v").join(tags, "obs_id"))
    n = cells.count()
    k = max(1, min(int(round(n / 30.0)), 100))
    held = matrix_sums(cells, lambda pdf: {"b": Rows.by(_codes(pdf, variables).T.ravel(), np.ones((len(pdf) * variables, 1)))})["b"]
    share = held.dense(sum(counts))[:, 0] / n
    addend = penalty_vector(lam, counts)
    state = {"y": _initial_centres(cells, k, seed), "sigma": sigma, "log_penalty": np.zeros((len(share), k))}
    kind = dict(cells.dtypes)["obs_id"]
    packs = cut(_packed(cells, names))
    before = np.inf
    for outer in range(max_iter):
        for _ in range(rounds):
            now = dict(state)

            def assign(pdf, s=now):
                z, codes = _unpacked(pdf, "v", variables)
                r = _memberships(z, codes, s)
                u = _unit(z)
                spread = (r * 2.0 * (1.0 - u @ s["y"].T)).sum() + s["sigma"] * (r * np.log(np.maximum(r, 1e-12))).sum()
                return {"ru": r.T @ u, "o": Rows.by(codes.T.ravel(), np.tile(r, (variables, 1))), "r": r.sum(axis=0, keepdims=True), "cost": np.array([[spread]])}

            s = matrix_sums(packs, assign, 1)
            state = {"y": _unit(s["ru"]), "sigma": sigma, "log_penalty": _penalty(s["o"].dense(len(share)), s["r"][0], share, theta)}
        final = dict(state)

        def moments(pdf, s=final):
            v, codes = _unpacked(pdf, "v", variables)
            return _level_moments(_memberships(v, codes, s), _unpacked(pdf, "z", variables)[0], codes)

        coef = level_coefficients(matrix_sums(packs, moments, 1), addend, variables, everywhere=False)
        sent, held = packs.sparkSession.sparkContext.broadcast(coef), packs

        def shift(batches, s=final, w=sent):
            for whole in batches:
                for i in range(len(whole)):
                    pdf = whole.iloc[i : i + 1]
                    v, codes = _unpacked(pdf, "v", variables)
                    yield pdf.assign(v=[(_unpacked(pdf, "z", variables)[0] - _level_effects(_memberships(v, codes, s), codes, w.value)).tobytes()])

        packs = cut(packs.mapInPandas(shift, packs.schema))
        cost = float(s["cost"][0, 0])
        if outer and abs(before - cost) <= tol * max(abs(before), 1.0):
            break
        before = cost

    def single(table: DataFrame, out: str, fn) -> DataFrame:
        def run(batches):
            for whole in batches:
                for i in range(len(whole)):
                    v, codes = _unpacked(whole.iloc[i : i + 1], "v", variables)
                    yield pd.DataFrame({"obs_id": pd.Series(list(whole["ids"].iloc[i])), out: list(fn(v, codes))})

        return table.mapInPandas(run, f"obs_id {kind}, {out} array<double>")

    # the last round's memberships are worked out where they are read: no round writes them
    return single(packs, "v", lambda v, _: v), single(held, "r", lambda v, codes: _memberships(v, codes, final))


def _level_effects(r: np.ndarray, codes: np.ndarray, coef: np.ndarray) -> np.ndarray:
    """What the levels of each cell add in its clusters."""
    out = np.zeros((len(r), coef.shape[2]))
    for column in codes.T:
        order = np.argsort(column, kind="stable")
        levels, first = np.unique(column[order], return_index=True)
        for level, rows in zip(levels, np.split(order, first[1:]), strict=True):
            out[rows] += r[rows] @ coef[level]
    return out


def correct_expression(rows: DataFrame, memberships: DataFrame, obs: DataFrame, batch_keys: Sequence[str], lam: float | Sequence[float] = 1.0) -> DataFrame:
    """Remove each cluster's batch effects from gene vectors (obs_id, v); negatives become 0.

    One pass adds the level x cluster x gene sums and a second pass subtracts.  The penalty vector is
    added to every row of the system.
    """
    tags, counts = _numbered(obs, batch_keys)
    variables = len(counts)
    cells = cut(rows.select("obs_id", "v").join(memberships.select("obs_id", "r"), "obs_id").join(tags, "obs_id"))
    m = matrix_sums(cells, lambda pdf: _level_moments(_stack(pdf["r"]), _stack(pdf["v"]), _codes(pdf, variables)))
    sent = cells.sparkSession.sparkContext.broadcast(level_coefficients(m, penalty_vector(lam, counts), variables, everywhere=True))
    return map_vectors(cells, lambda x, pdf: np.maximum(x - _level_effects(_stack(pdf["r"]), _codes(pdf, variables), sent.value), 0.0), ["obs_id"])
