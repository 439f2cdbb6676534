"""Factorisation and consensus queries over customer x brand quantities."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cytoframe.adapters import EXPR, OBS, with_ctes
from cytoframe.operators import embed, matrix as mx, programs as pg
from cytoframe.plans import workflows
from cytoframe.session import cut, ensure_checkpoint_dir
from cytoframe.suite import query
from cytoframe.suite.matrices import MOMENTS, NCELL


def rows(m):
    return cut(embed.dense_rows(mx.log_normalize(m.expr), m.obs, m.var)[0])


def scaled(m):
    return cut(embed.dense_rows(mx.scale_no_center(m.expr, m.obs), m.obs, m.var)[0])


@query("n01_n09_factorize")
def factorize(m):
    x = rows(m)
    spectra, errors = pg.factorize(x, [(3, 0), (3, 1), (5, 0)])
    done = m.spark.createDataFrame([(k, s, e) for (k, s), e in errors.items()], "k int, seed bigint, error double")
    return pg.spectra_table(x, spectra).join(done, ["k", "seed"])


@query("n02_n03_o07_consensus_summary")
def consensus(m):
    return pg.consensus_programs(rows(m), k_grid=(3, 4), seeds=(0, 1, 2), max_iter=8, init="random")[0]


@query("n02_w09_w10_program_usage")
def usage(m):
    _, _, use = pg.consensus_programs(rows(m), k_grid=(3,), seeds=(0,), max_iter=8)
    return use.join(pg.usage_summary(use), "obs_id")


@query("n10_multiplicative")
def multiplicative(m):
    return pg.factorize_multiplicative(rows(m), 3, 0, iterations=4)[0]


@query("n12_consensus_refit")
def refit(m):
    x = scaled(m)
    replicates, _ = pg.factorize(x, [(3, s) for s in range(5)])
    return pg.consensus_refit(x, rows(m), replicates, 3, density_threshold=2.0)[2]


def replicates(m):
    """Replicate spectra of two k with five seeds each: (scaled rows, spectra table)."""
    x = scaled(m)
    spectra, _ = pg.factorize(x, [(k, s) for k in (3, 5) for s in range(5)])
    return x, cut(pg.spectra_table(x, spectra))


@query("n11_k_selection")
def k_selection(m):
    return pg.k_selection(*replicates(m))


@query("n13_consensus_all_k")
def consensus_all(m):
    x, table = replicates(m)
    return pg.consensus_all(x, rows(m), table, density_threshold=2.0)[2]


TPM = "tpm AS (SELECT obs_id, var_id, value * 10000.0 / total AS value FROM expr JOIN (SELECT obs_id, sum(value) AS total FROM expr GROUP BY 1) USING (obs_id))"


@query("n08_tpm_stats", with_ctes(OBS, EXPR, NCELL, TPM, MOMENTS.format(src="tpm"), "SELECT var_id, round(mean, 6) AS mean, round(sqrt(var_pop), 6) AS std FROM mom"))
def tpm_stats(m):
    stats = mx.gene_moments(mx.scale_to_total(m.expr), m.obs)
    return stats.select("var_id", F.round("mean", 6).alias("mean"), F.round(F.sqrt("var_pop"), 6).alias("std"))


@query("n05_n08_program_inputs")
def program_inputs(m):
    """The composed preprocess and prepare runs; the corrected, scaled counts as they were written."""
    inputs = workflows.run_program_preprocess(m.obs, m.expr, "batch", n_top=20)
    ensure_checkpoint_dir(m.spark)
    folder = f"{m.spark.sparkContext.getCheckpointDir()}/programs-{uuid.uuid4().hex}"
    paths = workflows.prepare_programs(inputs, m.obs, (5, 8, 10, 12, 15), 20, folder)
    return m.spark.read.parquet(paths["norm_counts"])
