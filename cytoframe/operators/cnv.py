"""Copy-number evidence from expression averaged over genomic windows.

All samples run as one job with a ``sample_id`` column.  Gene-sized tables (a few
thousand selected genes, windows, cut-offs) are the only things that meet on the
driver; their size is bounded by ``top_n_genes``, never by the number of cells.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions.ordered import exact_quantiles
from cytoframe.operators.matrix import row_count
from cytoframe.schema import require_columns
from cytoframe.session import cut

# Arm order of the summary table and the lineages taken as normal.
ARMS = [f"{c}.{a}" for c in [*range(1, 23), "X"] for a in ("p", "q")]
NONPARENCHYMAL = ("B", "T", "NK", "Myeloid", "Mast", "Plasma", "Endothelial", "Fibroblast", "Stromal", "Pericyte", "Immune")
COORDINATES = ["hgnc_symbol", "chromosome_num", "start_position", "end_position", "chr_arm"]


@dataclass(frozen=True)
class CnvConfig:
    scale_on_reference: bool = True
    threshold_percentile: float = 0.01
    window_size: int = 150
    window_step: int = 10
    top_n_genes: int = 7000
    cluster_k: int | None = None
    merge_threshold: float = 0.98
    peaks: tuple[float, float, float] = (-0.1, 0.0, 0.1)
    cluster_nodes: int = 1500

    def __post_init__(self):
        if not 0 <= self.threshold_percentile < 0.5:
            raise ValueError("threshold_percentile must be in [0, 0.5)")
        if min(self.window_size, self.window_step, self.top_n_genes) < 1 or (self.cluster_k or 1) < 1:
            raise ValueError("window_size, window_step, top_n_genes and cluster_k must be at least 1")
        if not 0 <= self.merge_threshold <= 1 or len(self.peaks) != 3:
            raise ValueError("merge_threshold must be in [0, 1] and peaks must hold 3 values")


# ---------------------------------------------------------------- genes and windows
def normalize_coordinates(raw: DataFrame) -> DataFrame:
    """Autosomes and X of coding and lncRNA genes as numeric intervals (X = 23)."""
    number = lambda c: F.expr(f"try_cast({c} as bigint)")
    if set(COORDINATES) <= set(raw.columns):
        typed = raw.withColumns(
            {"chromosome_num": F.expr("try_cast(chromosome_num as int)"), "start_position": number("start_position"), "end_position": number("end_position")}
        )
        return typed.select(*COORDINATES).dropna()
    require_columns(raw, ["hgnc_symbol", "chromosome_name", "start_position", "end_position", "gene_biotype", "chr_arm"], "gene metadata")
    chrom = F.col("chromosome_name").cast("string")
    kept = raw.where(
        F.col("gene_biotype").isin("protein_coding", "lncRNA")
        & (chrom.isin(*[str(i) for i in range(1, 23)], "X"))
        & (F.coalesce(F.col("hgnc_symbol").cast("string"), F.lit("")) != "")
    )
    out = kept.withColumns(
        {
            "chromosome_num": F.when(chrom == "X", F.lit(23)).otherwise(F.expr("try_cast(chromosome_name as int)")),
            "start_position": number("start_position"), "end_position": number("end_position"),
        }
    )
    return out.select(*COORDINATES).dropna(subset=["start_position", "end_position", "chr_arm"]).dropDuplicates(COORDINATES)


def genes_in_region(coords: DataFrame, region: tuple[str, int, int]) -> DataFrame:
    chrom, start, end = region
    name = F.when(F.col("chromosome_num") == 23, "X").otherwise(F.col("chromosome_num").cast("string"))
    inside = (name == str(chrom)) & (F.col("start_position") >= int(start)) & (F.col("end_position") <= int(end))
    return coords.where(inside).select(F.col("hgnc_symbol").alias("var_id")).distinct()


def first_per_key(df: DataFrame, key: str, position: str) -> DataFrame:
    """Keep the row with the smallest position for each key (an aggregate, not a sort)."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(position)).alias("_r")).select(key, "_r.*")


def average_expression(expr: DataFrame, cells: DataFrame) -> DataFrame:
    """Mean over the given cells, zeros included."""
    kept = expr.join(cells.select("obs_id"), "obs_id", "left_semi")
    return kept.groupBy("var_id").agg((F.sum("value") / row_count(cells)).alias("average"))


def pooled_average(expr: DataFrame, obs: DataFrame, owners: DataFrame | None) -> DataFrame:
    """Mean over samples of whole-sample gene means; with references, only samples owning some."""
    used = obs.select("obs_id", "sample_id")
    if owners is not None:
        used = used.join(owners.select("sample_id").distinct(), "sample_id", "left_semi")
    sizes = used.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))
    per = expr.join(used, "obs_id").groupBy("sample_id", "var_id").agg(F.sum("value").alias("s"))
    return per.join(sizes, "sample_id").groupBy("var_id").agg((F.sum(F.col("s") / F.col("n")) / row_count(sizes)).alias("average"))


def select_genes(
    average: DataFrame, coords: DataFrame, top_n: int, force_genes: Sequence | None = None,
    force_arms: Sequence[str] | None = None, force_region: tuple[str, int, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(coordinates of the top genes, multiplicity of every selected gene).

    The selected list holds one entry per coordinate row of a top gene, and the 200
    highest genes once more for each bare arm letter, because the top-up looks at bare
    arms.  Only multiplicities matter afterwards: they weight the per-cell mean.
    """
    common = average.join(coords.select(F.col("hgnc_symbol").alias("var_id")).distinct(), "var_id", "left_semi")
    best = common.orderBy(F.col("average").desc(), "var_id")
    top = best.limit(top_n).select("var_id")
    if force_genes is not None:
        top = top.union(common.where(F.col("var_id").isin(list(force_genes))).select("var_id"))
    if force_region is not None:
        top = top.union(common.select("var_id").join(genes_in_region(coords, force_region), "var_id", "left_semi"))
    top = top.distinct()
    placed = coords.withColumnRenamed("hgnc_symbol", "var_id")
    top_coords = placed.join(top, "var_id", "left_semi")
    arm_name = F.concat(F.col("chromosome_num").cast("string"), F.col("chr_arm"))
    entries = top_coords.select("var_id", arm_name.alias("arm"))
    bare = coords.select("chr_arm").distinct().join(entries.select(F.col("arm").alias("chr_arm")).distinct(), "chr_arm", "left_anti")
    heads = best.limit(200).select("var_id")
    arms = bare.agg(F.collect_set("chr_arm")).scalar()
    entries = entries.union(heads.select("var_id", F.explode(arms).alias("arm")))
    if force_arms:
        forced = placed.where(arm_name.isin(list(force_arms))).select("var_id", arm_name.alias("arm"))
        entries = entries.where(~F.col("arm").isin(list(force_arms))).union(forced)
    entries = entries.join(common.select("var_id"), "var_id", "left_semi")
    return top_coords, entries.groupBy("var_id").agg(F.count(F.lit(1)).alias("mult"))


def genomic_windows(top_coords: DataFrame, size: int, step: int) -> DataFrame:
    """(window, chrom, arm, idx, var_id, rn): sliding windows of genes along each arm."""
    half = int(np.round(size / 2.0))
    line = Window.partitionBy("chromosome_num", "chr_arm").orderBy("start_position", "var_id")
    arm = Window.partitionBy("chromosome_num", "chr_arm")
    ranked = top_coords.where(F.col("chromosome_num").between(1, 23)).select(
        "chromosome_num", "chr_arm", "var_id", (F.row_number().over(line) - 1).alias("rn"), F.count(F.lit(1)).over(arm).cast("int").alias("n")
    )
    first = F.greatest(F.ceil((F.col("rn") - 2 * half) / float(step)), F.lit(0))
    last = F.least(F.floor(F.col("rn") / float(step)), F.floor((F.col("n") - 2 * half - 1) / float(step)))
    slots = F.when(F.col("n") <= size, F.array(F.lit(0).cast("bigint"))).when(last >= first, F.sequence(first, last))
    out = ranked.select("chromosome_num", "chr_arm", "var_id", "rn", F.explode(slots).alias("slot"))
    idx = (F.col("slot") + 1).cast("int")
    name = F.concat(F.col("chromosome_num").cast("string"), F.lit("."), F.col("chr_arm"), idx.cast("string"))
    return out.select(name.alias("window"), "chromosome_num", "chr_arm", idx.alias("idx"), "var_id", "rn")


def window_arm(window: Column) -> Column:
    """'23.q4' -> 'X.q'."""
    chrom = F.substring_index(window, ".", 1)
    return F.concat(F.when(chrom == "23", "X").otherwise(chrom), F.lit("."), F.substring(F.substring_index(window, ".", -1), 1, 1))


def window_table(windows: DataFrame) -> DataFrame:
    genes = F.transform(F.array_sort(F.collect_list(F.struct("rn", F.col("var_id").cast("string").alias("g")))), lambda s: s["g"])
    per = windows.groupBy("window", "chromosome_num", "chr_arm", "idx").agg(genes.alias("g"))
    return per.select(
        "window", window_arm(F.col("window")).alias("chrom_arm"), F.size("g").alias("n_genes"), F.array_join("g", ";").alias("genes"),
        "chromosome_num", "chr_arm", "idx",
    )


# ---------------------------------------------------------------- reference cells
def reference_cells(
    obs: DataFrame, reference_var: str | None, labels: Sequence[str] | str | None, by_sample: bool, min_cells: int = 5
) -> DataFrame | None:
    """Reference cells as (obs_id, sample_id, label), or None when there are none to scale on.

    Pooled runs need ``min_cells`` per sample and label; a single-sample run needs one cell
    for one label or five for each of several.
    """
    if reference_var is None or labels is None or reference_var not in obs.columns:
        return None
    names = [str(labels)] if isinstance(labels, str) else [str(x) for x in labels]
    tagged = obs.select("obs_id", "sample_id", F.col(reference_var).cast("string").alias("label")).where(F.col("label").isin(names))
    keys = ["sample_id", "label"] if by_sample else ["label"]
    need = min_cells if by_sample else (1 if len(names) == 1 else 5)
    enough = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= need).select(*keys)
    kept = cut(tagged.join(enough, keys, "left_semi"))
    return kept if kept.limit(1).count() else None


def _log_values(expr: DataFrame, genes: DataFrame) -> DataFrame:
    return expr.join(genes, "var_id").withColumn("lv", F.log2(F.lit(1.0) + F.col("value")))


def cell_means(expr: DataFrame, obs: DataFrame, genes: DataFrame) -> DataFrame:
    """Multiplicity-weighted mean of log2(1+x) over the selected genes, per cell."""
    total = genes.agg(F.sum("mult")).scalar()
    sums = _log_values(expr, genes).groupBy("obs_id").agg(F.sum(F.col("lv") * F.col("mult")).alias("s"))
    return obs.select("obs_id", "sample_id").join(sums, "obs_id", "left").select(
        "obs_id", "sample_id", (F.coalesce("s", F.lit(0.0)) / total).alias("cell_mean")
    )


def scale_factors(expr: DataFrame, obs: DataFrame, genes: DataFrame, refs: DataFrame | None, by_sample: bool = True) -> DataFrame:
    """Per gene the centred mean over reference cells; zeros enter through the counts only.

    Pooled: mean over samples of per-sample means, where a sample lacking a label's
    references uses all of its cells; several labels are combined by their median.
    Single sample: mean over the label's cells, again the median over labels.
    """
    cells = obs.select("obs_id", "sample_id")
    if not by_sample:
        cells = cells.withColumn("sample_id", F.lit("all"))
    if refs is None:
        use = cells.withColumn("label", F.lit("all"))
    else:
        local = refs if by_sample else refs.withColumn("sample_id", F.lit("all"))
        names = local.agg(F.collect_set("label")).scalar()
        samples = cells.select("sample_id").distinct().select("sample_id", F.explode(names).alias("label"))
        lacking = samples.join(local.select("sample_id", "label").distinct(), ["sample_id", "label"], "left_anti")
        use = local.select("obs_id", "sample_id", "label").unionByName(cells.join(lacking, "sample_id").select("obs_id", "sample_id", "label"))
    use = cut(use)
    sizes = use.groupBy("sample_id", "label").agg(F.count(F.lit(1)).alias("n"))
    n_samples = sizes.groupBy("label").agg(F.count(F.lit(1)).alias("k"))
    centre = (
        use.join(cell_means(expr, obs, genes).select("obs_id", "cell_mean"), "obs_id")
        .groupBy("sample_id", "label").agg(F.avg("cell_mean").alias("c")).groupBy("label").agg(F.avg("c").alias("centre"))
    )
    per = _log_values(expr, genes).join(use, "obs_id").groupBy("label", "sample_id", "var_id").agg(F.sum("lv").alias("s"))
    level = per.join(sizes, ["sample_id", "label"]).groupBy("label", "var_id").agg(F.sum(F.col("s") / F.col("n")).alias("t"))
    labels = n_samples.join(centre, "label")
    named = labels.agg(F.collect_list(F.struct("label", "k", "centre"))).scalar()
    grid = genes.select("var_id", F.explode(named).alias("_l")).select("var_id", "_l.label", "_l.k", "_l.centre")
    factor = grid.join(level, ["label", "var_id"], "left").select(
        "var_id", (F.coalesce("t", F.lit(0.0)) / F.col("k") - F.col("centre")).alias("f")
    )
    return factor.groupBy("var_id").agg(F.median("f").alias("scale"))


# ---------------------------------------------------------------- scores
def window_scores(expr: DataFrame, obs: DataFrame, genes: DataFrame, scale: DataFrame, windows: DataFrame) -> tuple[DataFrame, list[str]]:
    """One row per cell with the array of window means, and the window names in array order.

    A cell's selected genes (at most ``top_n_genes``) are gathered into one sparse row;
    the dense, centred and clipped form exists only batch by batch inside a task.
    """
    table = genes.join(scale, "var_id").toPandas().sort_values("var_id", ignore_index=True)
    where = {g: i for i, g in enumerate(table["var_id"])}
    members = windows.toPandas().sort_values(["chromosome_num", "chr_arm", "idx", "rn"], ignore_index=True)
    names = list(dict.fromkeys(members["window"]))
    groups = members.groupby("window", sort=False)["var_id"].apply(lambda s: np.array([where[g] for g in s if g in where], dtype=np.intp))
    averager = np.zeros((len(table), len(names)))
    for j, name in enumerate(names):
        np.add.at(averager[:, j], groups[name], 1.0 / max(len(groups[name]), 1))
    mult, offset = table["mult"].to_numpy(float), table["scale"].to_numpy(float)
    weight = mult / mult.sum()
    spark = expr.sparkSession
    kind = dict(expr.dtypes)["var_id"]
    place = spark.createDataFrame(pd.DataFrame({"var_id": table["var_id"], "g": np.arange(len(table), dtype=np.int32)}), f"var_id {kind}, g int")
    packed = expr.join(F.broadcast(place), "var_id").groupBy("obs_id").agg(
        F.collect_list(F.struct("g", F.col("value").cast("double").alias("x"))).alias("_e")
    )
    rows = obs.select("obs_id", "sample_id").join(packed, "obs_id", "left").select(
        "obs_id", "sample_id", F.col("_e.g").alias("g"), F.col("_e.x").alias("x")
    )

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 512):
                pdf = whole.iloc[at : at + 512]
                v = np.zeros((len(pdf), len(weight)))
                for i, (g, x) in enumerate(zip(pdf["g"], pdf["x"])):
                    if g is not None:
                        v[i, np.asarray(g, dtype=np.intp)] = np.log2(1.0 + np.asarray(x))
                v = np.clip(v - (v @ weight)[:, None] - offset[None, :], -3.0, 3.0)
                yield pdf[["obs_id", "sample_id"]].assign(scores=list(v @ averager))

    kinds = dict(obs.dtypes)
    schema = f"obs_id {kinds['obs_id']}, sample_id {kinds['sample_id']}, scores array<double>"
    return rows.mapInPandas(run, schema), names


#: Counters of a window: sixteen for each power of two from 2 ** -30 to 2 ** 3, on both sides of the one around zero.
_STEPS = 33 * 16
BINS = 2 * _STEPS + 1


def rank_bins(v: np.ndarray) -> np.ndarray:
    """The counter of each score: it never falls as the score rises."""
    key = (np.abs(v).view(np.int64) >> 48) - ((1023 - 30) << 4) + 1
    return np.where(v < 0, -1, 1) * np.clip(key, 0, _STEPS) + _STEPS


def _blocks(batches) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(group, scores, counter of every score among those of all windows) of bounded blocks of cells."""
    for whole in batches:
        for at in range(0, len(whole), 2048):
            for grp, part in whole.iloc[at : at + 2048].groupby("grp", sort=False):
                x = np.vstack(part["scores"].to_numpy())
                yield grp, x.ravel(), (rank_bins(x) + np.arange(x.shape[1]) * BINS).ravel()


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sum of the last array over equal rows of the others, sorted."""
    *keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort(keys[::-1])
    keys, n = [k[order] for k in keys], n[order]
    first = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]))
    return (*[k[first] for k in keys], np.add.reduceat(n, first))


def window_quantiles(cells: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles (grp, w, one column a name) of every window's scores, by rank counters; ``cells``: grp (text, never null), scores.

    First scan: each task adds its scores to counters that cover the number line in fixed steps; the totals name
    the counters that hold the ranks asked for.  Second scan: the values of these counters alone, equal ones
    counted together, give the exact ranks.  Both read the score arrays as they are; no cell becomes a row a window.
    """
    def tally(batches):
        held: dict[str, list] = {}
        for grp, _, code in _blocks(batches):
            n = np.bincount(code)
            parts = held.setdefault(grp, [])
            parts.append((np.flatnonzero(n), n[n > 0]))
            if sum(len(p[0]) for p in parts) > 4_000_000:
                held[grp] = [_added(parts)]
        for grp, parts in held.items():
            code, n = _added(parts)
            yield pd.DataFrame({"grp": grp, "w": (code // BINS).astype("int32"), "bin": (code % BINS).astype("int32"), "n": n})

    counted = cells.mapInPandas(tally, "grp string, w int, bin int, n long").groupBy("grp", "w", "bin").agg(F.sum("n").alias("n"))
    line, whole = Window.partitionBy("grp", "w").orderBy("bin"), Window.partitionBy("grp", "w")  # at most BINS rows
    counted = counted.withColumns({"end": F.sum("n").over(line), "total": F.sum("n").over(whole)})
    place = lambda p: (F.col("total") - 1) * F.lit(p)
    ranks = [f(place(p)).cast("long") for p in probs.values() for f in (F.floor, F.ceil)]
    holds = lambda k: (k >= F.col("end") - F.col("n")) & (k < F.col("end"))
    wanted = cut(counted.where(reduce(lambda a, b: a | b, map(holds, ranks))).select("grp", "w", "bin", (F.col("end") - F.col("n")).alias("before"), "total"))
    # at most four counters a group and window
    asked: dict[str, np.ndarray] = {g: np.sort((t["w"].to_numpy(np.int64) * BINS + t["bin"]).to_numpy()) for g, t in wanted.select("grp", "w", "bin").toPandas().groupby("grp")}
    sent = cells.sparkSession.sparkContext.broadcast(asked)

    def pick(batches):
        held: dict[str, list] = {}

        def rows(grp):
            code, value, n = _added(held.pop(grp))
            return pd.DataFrame({"grp": grp, "w": (code // BINS).astype("int32"), "bin": (code % BINS).astype("int32"), "value": value, "n": n})

        for grp, x, code in _blocks(batches):
            known = sent.value[grp]
            hit = known[np.minimum(np.searchsorted(known, code), len(known) - 1)] == code
            held.setdefault(grp, []).append((code[hit], x[hit] + 0.0, np.ones(int(hit.sum()), np.int64)))
            if sum(len(p[0]) for p in held[grp]) > 4_000_000:
                yield rows(grp)
        for grp in list(held):
            if sum(len(p[0]) for p in held[grp]):
                yield rows(grp)

    values = cells.mapInPandas(pick, "grp string, w int, bin int, value double, n long").groupBy("grp", "w", "bin", "value").agg(F.sum("n").alias("n"))
    values = values.join(F.broadcast(wanted), ["grp", "w", "bin"]).withColumn("end", F.col("before") + F.sum("n").over(Window.partitionBy("grp", "w", "bin").orderBy("value")))
    at = lambda k: F.max(F.when(holds(k.cast("long")), F.col("value")))
    found = values.groupBy("grp", "w").agg(F.first("total").alias("total"), *[at(f(place(p))).alias(f"{name}{i}") for name, p in probs.items() for i, f in enumerate((F.floor, F.ceil))])
    share = lambda p: place(p) - F.floor(place(p))
    return found.select("grp", "w", *[(F.col(f"{name}0") + (F.col(f"{name}1") - F.col(f"{name}0")) * share(p)).alias(name) for name, p in probs.items()])


def window_limits(
    cells: DataFrame, refs: DataFrame | None, p: float, groups: DataFrame | None = None
) -> tuple[list[float], list[float], bool]:
    """(low, high, strict) cut-offs per window.

    From reference cells if any; else, given ``groups(obs_id, grp)``, the median over groups
    of each group's quantiles with strict bounds; else from all cells.
    """
    probs = {"lo": p, "hi": 1.0 - p}
    used = cells
    if refs is not None:
        used = cells.join(refs.select("obs_id").distinct(), "obs_id", "left_semi")
    grouped = refs is None and groups is not None
    if grouped:
        used = cells.join(groups.select("obs_id", F.coalesce(F.concat(F.lit("="), F.col("grp").cast("string")), F.lit("")).alias("grp")), "obs_id")
    else:
        used = used.withColumn("grp", F.lit(""))
    per = window_quantiles(cut(used.select("grp", "scores")) if grouped or refs is not None else used.select("grp", "scores"), probs)
    rows = per.groupBy("w").agg(F.median("lo").alias("lo"), F.median("hi").alias("hi")).orderBy("w").collect()
    return [r["lo"] for r in rows], [r["hi"] for r in rows], grouped


def trim_scores(cells: DataFrame, low: Sequence[float], high: Sequence[float], strict: bool = False) -> DataFrame:
    """Scores inside the limits become 0."""
    bounds = F.arrays_zip(F.lit([float(x) for x in low]).alias("lo"), F.lit([float(x) for x in high]).alias("hi"))

    def one(s, b):
        inside = (s > b["lo"]) & (s < b["hi"]) if strict else (s >= b["lo"]) & (s <= b["hi"])
        return F.when(inside, F.lit(0.0)).otherwise(s)

    return cells.withColumn("_b", bounds).withColumn("trimmed", F.zip_with("scores", "_b", one)).drop("_b")


def classify(value: Column, peaks: Sequence[float] = (-0.1, 0.0, 0.1)) -> Column:
    return F.when(value < peaks[0], "loss").when(value > peaks[2], "gain").otherwise("no_alteration")


def summarize_cells(cells: DataFrame, names: Sequence[str], peaks: Sequence[float] = (-0.1, 0.0, 0.1)) -> DataFrame:
    """Fraction of altered windows, mean per chromosome arm and its class, per cell."""
    by_arm: dict[str, list[int]] = {}
    for i, name in enumerate(names):
        chrom, rest = name.split(".", 1)
        by_arm.setdefault(f"{'X' if chrom == '23' else chrom}.{rest[0]}", []).append(i)
    out = cells.withColumn("cnv_fraction", F.size(F.filter("trimmed", lambda x: x != 0)) / F.lit(float(max(len(names), 1))))
    columns = {}
    for arm in ARMS:
        at = by_arm.get(arm)
        if at:
            part = F.slice("trimmed", at[0] + 1, len(at))
            columns[f"{arm}_CNV"] = F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / float(len(at))
        else:
            columns[f"{arm}_CNV"] = F.lit(0.0)
    out = out.withColumns(columns)
    return out.withColumns({f"{arm}_CNV_classification": classify(F.col(f"`{arm}_CNV`"), peaks) for arm in ARMS})


# ---------------------------------------------------------------- clustering inside samples
def ward_merges(x: np.ndarray, size: np.ndarray) -> list[tuple[int, int, float]]:
    """Agglomerate rows by Ward's update on city-block distances; merges sorted by height."""
    n = len(x)
    d = np.abs(x[:, None, :] - x[None, :, :]).sum(axis=2) if n * n * x.shape[1] <= 3e7 else np.array([np.abs(x - r).sum(axis=1) for r in x])
    np.fill_diagonal(d, np.inf)
    size, alive, chain, merges = size.astype(float).copy(), np.ones(n, dtype=bool), [], []
    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        while True:
            a = chain[-1]
            b = int(np.argmin(np.where(alive, d[a], np.inf)))
            if len(chain) > 1 and d[a, chain[-2]] <= d[a, b]:
                b = chain[-2]
                break
            chain.append(b)
        chain = chain[:-2]
        height = d[a, b]
        lo, hi = min(a, b), max(a, b)
        merges.append((lo, hi, float(height)))
        total = size[lo] + size[hi] + size
        fresh = np.sqrt(np.maximum(((size + size[lo]) * d[lo] ** 2 + (size + size[hi]) * d[hi] ** 2 - size * height**2) / total, 0.0))
        fresh[~alive] = np.inf
        d[lo], d[:, lo] = fresh, fresh
        d[hi], d[:, hi] = np.inf, np.inf
        d[lo, lo] = np.inf
        size[lo] += size[hi]
        alive[hi] = False
    return sorted(merges, key=lambda m: m[2])


def cut_merges(merges, n: int, k: int) -> np.ndarray:
    """Labels 1..k, numbered by first member."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b, _ in merges[: max(n - k, 0)]:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    ids = {}
    return np.array([ids.setdefault(find(i), len(ids) + 1) for i in range(n)])


def elbow_k(x: np.ndarray, size: np.ndarray, merges) -> int:
    """Number of clusters (1 to 15) read off the curve of total spread against cluster count.

    Spread of a cluster: half its size-weighted sum of squared city-block distances over
    its size.  Contract: the first bend (second difference of the curve, scaled to the unit square)
    above 5 % of the largest that lies past the first quarter of the counts; else the last such
    bend; without any, the middle of the counts, rounded down on a flat or too short curve.
    The curve is walked from single points along the merge list, each merge adding its two clusters' cross distances.
    """
    most = min(15, int(size.sum()), len(x))
    # sums of squared distances between every two clusters, and inside each
    across = np.array([np.abs(x - r).sum(axis=1) for r in x]) ** 2 * np.outer(size, size)
    weight, inside, home = size.astype(float).copy(), np.zeros(len(x)), np.arange(len(x))
    total, curve = 0.0, {len(x): 0.0}
    for done, (a, b, _) in enumerate(merges, start=1):
        i, j = home[a], home[b]
        inner = inside[i] + inside[j] + across[i, j]
        total += inner / (weight[i] + weight[j]) - (inside[i] / weight[i] + inside[j] / weight[j])
        weight[i], inside[i] = weight[i] + weight[j], inner
        across[i] += across[j]
        across[:, i] += across[:, j]
        home[home == j] = i
        curve[len(x) - done] = total
    y = np.array([curve[k] for k in range(1, most + 1)])
    if most < 3 or np.ptp(y) == 0:
        return 1 + most // 2 if most > 1 else 1
    bends = np.abs(np.diff(y, 2))
    marked = [k for k, bend in enumerate(bends, start=2) if bend > 0.05 * bends.max()]
    if not marked:
        return -(-most // 2)
    return next((k for k in marked if k - 1 > -(-most // 4)), marked[-1])


def merge_similar(profile: np.ndarray, labels: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    """Clusters joined by chains of mean arm profiles that correlate above the threshold, numbered 1..m in order of first label.

    Components of the correlation graph: reach doubles until it no longer grows, and each
    cluster is named after the first one it reaches.
    """
    names, at = np.unique(labels, return_inverse=True)
    weight = np.zeros((len(names), len(labels)))
    weight[at, np.arange(len(labels))] = size
    means = weight @ profile / weight.sum(axis=1, keepdims=True)
    means = means[:, np.abs(means).sum(axis=0) > 0]
    if len(names) < 2 or not means.size:
        return labels
    centred = means - means.mean(axis=1, keepdims=True)
    length = np.sqrt((centred**2).sum(axis=1))
    with np.errstate(invalid="ignore", divide="ignore"):
        near = centred @ centred.T / np.outer(length, length) > threshold
    reach = near | np.eye(len(names), dtype=bool)
    while True:
        wider = reach.astype(int) @ reach.astype(int) > 0
        if (wider == reach).all():
            break
        reach = wider
    return np.unique(reach.argmax(axis=1), return_inverse=True)[1][at] + 1


SLAB = 1 << 20


def split_nodes(x: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """The node of every row: the node of largest spread is halved at the mean of its widest column, until there are ``most`` nodes or all rows of a node are equal."""
    node = np.zeros(len(x), dtype=int)

    def spread(rows: np.ndarray) -> tuple[float, int, float]:
        w = size[rows] / size[rows].sum()
        mean, var = np.empty(x.shape[1]), np.empty(x.shape[1])
        step = max(1, SLAB // len(rows))
        for s in range(0, x.shape[1], step):  # a bounded copy at a time
            part = x[rows, s : s + step]
            mean[s : s + step] = w @ part
            var[s : s + step] = np.where(np.ptp(part, axis=0) > 0, w @ (part - mean[s : s + step]) ** 2, 0.0)
        widest = int(var.argmax())
        return float(var.sum() * size[rows].sum()), widest, float(mean[widest])

    heap, members = [], {0: np.arange(len(x))}
    value, column, middle = spread(members[0])
    heapq.heappush(heap, (-value, 0, column, middle))
    while heap and len(members) < most:
        value, at, column, middle = heapq.heappop(heap)
        if value == 0:
            break
        rows = members[at]
        low = x[rows, column] <= middle
        if low.all():  # the mean was rounded up to the largest value
            low = x[rows, column] < x[rows, column].max()
        for name, part in ((at, rows[low]), (len(members), rows[~low])):
            members[name] = part
            node[part] = name
            value, column, middle = spread(part)
            heapq.heappush(heap, (-value, name, column, middle))
    return node


LANE_ROWS = 20_000


def _summaries(points: DataFrame, most: int) -> DataFrame:
    """Summaries of every (sample_id, lane): a row (key, node) for each point and a row (node, x, size) for each node.

    A node stands for its members by their weighted mean, and is named by its smallest key.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", ignore_index=True)
        x, size = np.vstack(pdf["x"].to_numpy()), pdf["size"].to_numpy(float)
        at = split_nodes(x, size, most)
        first = pd.Series(np.arange(len(at))).groupby(at).min().to_numpy()
        weight = np.bincount(at, weights=size)
        mean = np.zeros((len(weight), x.shape[1]))
        for s in range(0, len(x), 1024):
            np.add.at(mean, at[s : s + 1024], x[s : s + 1024] * size[s : s + 1024, None])
        mean = np.where((np.bincount(at) == 1)[:, None], x[first], mean / weight[:, None])
        names = pdf["key"].to_numpy()[first]
        own = pd.DataFrame({"sample_id": pdf["sample_id"], "lane": pdf["lane"], "key": pdf["key"], "node": names[at], "x": None, "size": np.nan})
        held = pd.DataFrame({"sample_id": pdf["sample_id"].iloc[0], "lane": pdf["lane"].iloc[0], "key": None, "node": names, "x": list(mean), "size": weight})
        return pd.concat([own, held])

    kind = dict(points.dtypes)["sample_id"]
    return cut(points.groupBy("sample_id", "lane").applyInPandas(run, f"sample_id {kind}, lane int, key string, node string, x array<double>, size double"))


def cluster_cells(cells: DataFrame, names: Sequence[str], cfg: CnvConfig) -> DataFrame:
    """Cluster number per cell within its sample.

    Every sample is first brought to at most ``cluster_nodes`` weighted means by a mergeable tree: cells of a lane of about ``LANE_ROWS``
    are halved along their widest windows, lanes are joined a few at a time and halved again.  Equal cells share a node,
    and a sample with no more different cells than nodes is clustered exactly; no task holds a whole large sample.
    """
    arm_of = [("X" if w.split(".")[0] == "23" else w.split(".")[0]) + "." + w.split(".", 1)[1][0] for w in names]
    arms = sorted(set(arm_of))
    to_arm = np.zeros((len(names), len(arms)))
    for i, a in enumerate(arm_of):
        to_arm[i, arms.index(a)] = 1.0 / arm_of.count(a)
    cells = cells.select("obs_id", "sample_id", F.col("obs_id").cast("string").alias("key"), F.col("trimmed").alias("x"), F.lit(1.0).alias("size"))
    sizes = cut(cells.groupBy("sample_id").agg(F.ceil(F.count(F.lit(1)) / float(LANE_ROWS)).cast("int").alias("lanes")))
    lanes = sizes.agg(F.max("lanes")).head()[0] or 1
    dealt = cells.join(sizes, "sample_id").withColumn("lane", F.pmod(F.xxhash64("obs_id"), F.col("lanes")).cast("int"))
    found = _summaries(dealt.select("sample_id", "lane", "key", "x", "size"), cfg.cluster_nodes)
    owners = found.where("key IS NOT NULL").select("sample_id", "key", "node")
    nodes = found.where("key IS NULL").select("sample_id", "lane", F.col("node").alias("key"), "x", "size")
    fan = max(2, LANE_ROWS // cfg.cluster_nodes)
    while lanes > 1:
        found = _summaries(nodes.withColumn("lane", F.floor(F.col("lane") / fan).cast("int")), cfg.cluster_nodes)
        step = found.where("key IS NOT NULL").select("sample_id", F.col("key").alias("node"), F.col("node").alias("next"))
        owners = cut(owners.join(step, ["sample_id", "node"]).select("sample_id", "key", F.col("next").alias("node")))
        nodes = found.where("key IS NULL").select("sample_id", "lane", F.col("node").alias("key"), "x", "size")
        lanes = -(-lanes // fan)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", ignore_index=True)
        x, size = np.vstack(pdf["x"].to_numpy()), pdf["size"].to_numpy(float)
        labels = np.ones(len(x), dtype=int)
        if len(x) >= 2:
            merges = ward_merges(x, size)
            labels = cut_merges(merges, len(x), cfg.cluster_k or elbow_k(x, size, merges))
            labels = merge_similar(x @ to_arm, labels, size, cfg.merge_threshold)
        return pdf[["sample_id"]].assign(node=pdf["key"], cnv_cluster=labels.astype("int32"))

    kind = dict(cells.dtypes)["sample_id"]
    labelled = nodes.groupBy("sample_id").applyInPandas(run, f"sample_id {kind}, node string, cnv_cluster int")
    keyed = cells.select("obs_id", "sample_id", "key").join(owners, ["sample_id", "key"])
    return keyed.join(labelled, ["sample_id", "node"]).select("obs_id", "sample_id", "cnv_cluster")


# ---------------------------------------------------------------- whole runs
@dataclass(frozen=True)
class CnvRun:
    genes: DataFrame
    windows: DataFrame
    window_names: list[str]
    cells: DataFrame
    low: list[float]
    high: list[float]


def run_cnv(
    expr: DataFrame, coords: DataFrame, obs: DataFrame, reference_var: str | None = None, reference_labels=None,
    cfg: CnvConfig = CnvConfig(), by_sample: bool = True, min_reference_cells: int = 5, **force,
) -> CnvRun:
    """Select genes, score windows, trim by reference quantiles and summarise cells.

    ``by_sample`` chooses the pooled rules (samples weigh equally); otherwise all cells
    form one sample.
    """
    expr = expr.join(coords.select(F.col("hgnc_symbol").alias("var_id")).distinct(), "var_id", "left_semi")
    refs = reference_cells(obs, reference_var, reference_labels, by_sample, min_reference_cells)
    scaling = refs if cfg.scale_on_reference else None
    if by_sample:
        average = pooled_average(expr, obs, scaling)
    else:
        average = average_expression(expr, refs.select("obs_id") if refs is not None else obs)
    top, genes = select_genes(cut(average), coords, cfg.top_n_genes, **force)
    top, genes = cut(top), cut(genes)
    kept = cut(expr.join(genes.select("var_id"), "var_id", "left_semi"))
    scale = cut(scale_factors(kept, obs, genes, scaling, by_sample))
    windows = cut(genomic_windows(top, cfg.window_size, cfg.window_step))
    cells, names = window_scores(kept, obs, genes, scale, windows)
    cells = cut(cells)
    groups = None
    if not by_sample and scaling is None and reference_var is not None and reference_var in obs.columns:
        groups = obs.select("obs_id", F.col(reference_var).alias("grp"))
    low, high, strict = window_limits(cells, scaling, cfg.threshold_percentile, groups)
    trimmed = trim_scores(cells, low, high, strict)
    return CnvRun(genes.join(scale, "var_id"), windows, names, summarize_cells(trimmed, names, cfg.peaks), low, high)


# ---------------------------------------------------------------- tumour workflow rules
def reference_pool(
    obs: DataFrame, lineage: str = "cell_type_lvl1", parenchymal: Sequence[str] = ("Epithelial",),
    status: str | None = None, normal_status: Sequence[str] = ("normal", "non_tumor", "healthy"),
) -> DataFrame:
    """Label each cell as normal non-parenchymal, normal parenchymal or candidate."""
    require_columns(obs, [lineage, "sample_id"], "obs")
    major = F.col(lineage).cast("string")
    par = F.coalesce(major.isin(list(parenchymal)), F.lit(False))
    nonpar = F.coalesce(major.isin(list(NONPARENCHYMAL)), F.lit(False)) | ~par
    normal = F.lit(False)
    if status and status in obs.columns:
        normal = par & F.coalesce(F.col(status).cast("string").isin(list(normal_status)), F.lit(False))
    label = F.when(normal, "normal_parenchymal").when(nonpar, "normal_nonparenchymal").otherwise("candidate_tumor_or_mixed")
    return obs.withColumn("reference_pool", label)


def reference_plan(pool: DataFrame, min_reference_cells: int = 20) -> DataFrame:
    """Counts per label and whether the copy-number step should run."""
    hit = lambda v: F.count_if(F.col("reference_pool") == v)
    c = pool.agg(
        hit("normal_nonparenchymal").alias("n_normal_nonparenchymal"), hit("normal_parenchymal").alias("n_normal_parenchymal"),
        hit("candidate_tumor_or_mixed").alias("n_candidate_cells"),
    )
    refs = F.col("n_normal_nonparenchymal") + F.col("n_normal_parenchymal")
    run = (refs >= min_reference_cells) & (F.col("n_candidate_cells") > 0)
    reason = (
        F.when(~run, "too few reference cells or no candidates")
        .when(F.col("n_normal_parenchymal") > 0, "normal parenchymal cells are separable")
        .otherwise("non-parenchymal cells only")
    )
    return c.select(refs.alias("n_reference_cells"), "*", run.alias("should_run"), reason.alias("reason"))


def tumour_evidence(cells: DataFrame) -> DataFrame:
    """Compare each cell's altered fraction with the reference pool's upper limit.

    ``cells``: obs_id, reference_pool, cnv_fraction (NULL when not scored).
    """
    ref = F.col("reference_pool").startswith("normal_")
    refs = cut(cells.where(ref & F.col("cnv_fraction").isNotNull()).select("cnv_fraction"))
    n_ref = cells.where(ref).count()
    if n_ref >= 10:
        base = exact_quantiles(refs, [], "cnv_fraction", {"med": 0.5, "q99": 0.99}).head()
        dev = refs.select(F.abs(F.col("cnv_fraction") - F.lit(base["med"])).alias("d"))
        spread = exact_quantiles(dev, [], "d", {"m": 0.5}).head()["m"]
        limit = max(base["q99"], base["med"] + 3.0 * 1.4826 * spread)
    else:
        limit = exact_quantiles(cells, [], "cnv_fraction", {"q": 0.75}).head()["q"]
    frac = F.col("cnv_fraction")
    call = (
        F.when(ref, "normal_reference").when(frac <= limit, "cnv_normal_like").when(frac > limit, "cnv_tumor_like").otherwise("cnv_indeterminate")
    )
    return cells.withColumns({"normal_threshold": F.lit(float(limit)), "tumor_evidence": call})
