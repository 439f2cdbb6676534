"""Decision rules, sources and a sample of oracle comparisons."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cytoframe.operators import evidence as ev
from cytoframe.operators import tables as tb
from cytoframe.sources import readers, sinks
from tools.check import TABLES, close, rows_of

FOLDER = "/root/testdata/sf0.001"


def test_program_classes(spark):
    rows = [("a", ["RPL3", "RPS6", "X"]), ("b", ["MKI67", "TOP2A", "UBE2C", "PCNA"]), ("c", ["GENE1", "GENE2"]), ("d", [" "]), ("e", ["PTPRC", "EPCAM", "VWF", "Q", "R"]), ("f", ["jun", "fos", "Z"]), ("g", ["MT-CO1", "X"])]
    got = {r["program"]: (r["program_class"], r["action"]) for r in ev.sanitize_programs(spark.createDataFrame(rows, "program string, genes array<string>")).collect()}
    assert got["a"] == ("ribosomal", "exclude_from_identity") and got["b"] == ("cell_cycle", "state_only") and got["c"] == ("identity", "keep_for_identity")
    assert got["d"] == ("unknown", "review") and got["e"][0] == "mixed" and got["f"][0] == "stress" and got["g"][0] == "mitochondrial"


def _obs(spark, with_cnv):
    cols = [(f"c{i}", str(i // 2), f"s{i % 2 + 1}", "tumor" if i < 2 else "normal", [0.5, 0.4, 0.01, 0.02][i]) for i in range(4)]
    obs = spark.createDataFrame(cols, "obs_id string, cl string, sample_id string, tumor_evidence string, cnv_fraction double")
    return obs if with_cnv else obs.drop("tumor_evidence", "cnv_fraction")


def _decision(spark, **change):
    import json

    base = dict(run_id="r", cluster_id="0", cluster_key="cl", parent_label="Epithelial", canonical_label="Epithelial", final_label="Malignant epithelial", confidence="medium",
                evidence_refs={"marker": ["m1"]}, reason="x")
    return ev.parse_decisions(spark.createDataFrame([(json.dumps({"decisions": [{**base, **change}]}),)], "j string"), "j")


@pytest.mark.parametrize(
    "change, with_cnv, accepted, reason",
    [
        ({}, False, False, "requires CNV evidence"),
        ({}, True, True, "validation passed"),
        ({"evidence_refs": {"marker": ["m1"], "cnv": ["manual:cnv"]}}, False, True, "validation passed"),
        ({"evidence_refs": {"marker": ["nope"]}}, True, False, "unknown evidence refs: nope"),
        ({"confidence": "high"}, True, False, "too few cells"),
        ({"final_label": "Ribosomal epithelial"}, True, False, "program-dominated"),
        ({"cluster_id": "9"}, True, False, "cluster not found"),
        ({"review_required": True}, True, False, "decision requested review"),
        ({"final_label": "  "}, True, False, "empty final_label"),
    ],
)
def test_validator(spark, change, with_cnv, accepted, reason):
    r = ev.validate(_decision(spark, **change), ev.cluster_evidence(_obs(spark, with_cnv), "cl", marker_refs=["m1"]), True).head()
    assert r["accepted"] is accepted and any(reason in x for x in r["reasons"])


def test_commit_updates_only_accepted_cluster(spark):
    d = ev.validate(_decision(spark), ev.cluster_evidence(_obs(spark, True), "cl", marker_refs=["m1"]), True).withColumn("ord", F.lit(1))
    out, log = ev.commit_decisions(_obs(spark, True), d, "cl", "ord")
    got = {r["obs_id"]: (r["cell_type_lvl3"], r["annotation_status"]) for r in out.collect()}
    assert got["c0"] == ("Malignant epithelial", "accepted") and got["c3"] == ("unassigned", "unassigned") and log.head()["n_cells"] == 2


def test_readers_and_sinks(spark, tmp_path):
    wide = spark.createDataFrame([("g1", "1", "x"), ("g2", "0", "2.5")], "gene string, c1 string, c2 string")
    path = sinks.write_table(wide, str(tmp_path / "m.tsv"), single_file=True)
    got = {(r["obs_id"], r["var_id"]): r["value"] for r in readers.read_counts(spark, path).collect()}
    assert got == {("c1", "g1"): 1.0, ("c2", "g2"): 2.5}
    with pytest.raises(ValueError):
        sinks.write_table(wide, str(tmp_path / "m.xlsx"))
    with pytest.raises(KeyError):
        readers.read_cells(spark, path, "barcode")
    new = spark.createDataFrame([("t", "k", "old", 1), ("t", "k", "new", 2)], "category string, key string, path string, registered_at int")
    assert sinks.register_files(None, new).head()["path"] == "new"
    positions = spark.createDataFrame([("AA", 1)], "barcode string, in_tissue int")
    expr, obs = readers.place_spots(spark.createDataFrame([("AA", "g", 1.0), ("BB", "g", 2.0)], "barcode string, var_id string, value double"), positions, "s1")
    assert {(r["obs_id"], r["in_tissue"]) for r in obs.collect()} == {("s1:AA", 1), ("s1:BB", None)}
    named = tb.make_unique(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "n string, pos int"), "n", "pos")
    assert {r["unique_name"] for r in named.collect()} == {"a", "a-1", "b"}


def test_cnv_sink_partitions_by_sample(spark, tmp_path):
    cells = spark.createDataFrame([("c1", "S 1/a", 0.1, [0.5, 0.0])], "obs_id string, sample_id string, cnv_fraction double, trimmed array<double>")
    windows = spark.createDataFrame([("1.p1", 3)], "window string, n_genes int")
    sinks.write_cnv(cells, windows, str(tmp_path / "out"), mode="parquet")
    assert (tmp_path / "out" / "cells.parquet" / "sample_id=S_1_a").is_dir()
    assert spark.read.parquet(str(tmp_path / "out" / "scores.parquet")).count() == 2


def test_ligand_receptor_splits(spark):
    lr = spark.createDataFrame([("A|B", "R"), ("A;B", "R"), ("A", "R,S"), ("A", "R")], "ligand string, receptor string")
    assert [r["complex_sensitive"] for r in ev.ligand_receptor_flags(lr).collect()] == [True, True, True, False]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize(
    "name",
    ["a02_basic_qc", "a04_qc_flags", "d01_cosg", "w01_bh_grouped", "a08_composition", "b08_j10_concordance", "c09_o02_o03_selected_genes", "g03_validate_decisions", "j14_nearest_neighbours", "p02_unique_names"],
)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    res = duck.sql(entry.oracle_sql()[name])
    c1, r1 = rows_of(df.columns, df.collect())
    c2, r2 = rows_of(list(res.columns), res.fetchall())
    assert c1 == c2 and len(r1) == len(r2)
    assert all(close(x, y) for a, b in zip(r1, r2) for x, y in zip(a, b))


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 120
