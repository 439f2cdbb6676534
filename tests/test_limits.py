"""Inputs beyond sizes that once changed results."""

import numpy as np
from pyspark.sql import functions as F

from cytoframe.operators import abundance as ab
from cytoframe.operators import programs as pg
from cytoframe.sources import readers


def test_more_than_ten_thousand_classes(spark):
    meta = spark.range(10_050).select(F.col("id").alias("sample_id"), F.format_string("c%05d", "id").alias("kind"))
    rows = ab.class_labels(meta, "kind", "c07000").collect()
    code = {r["kind"]: r["y"] for r in rows}
    assert len(rows) == 10_050 and sorted(code.values()) == list(range(10_050))
    assert code["c07000"] == 0 and code["c00000"] == 1 and code["c06999"] == 7000 and code["c07001"] == 7001


def test_skills_are_read_where_the_files_are(spark, tmp_path):
    for name, text in (("a", "title: one\nlevel: 2\n"), ("b", "# empty\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "skill.yaml").write_text(text)
    got = {r["skill"]: dict(r["fields"]) for r in readers.read_skills(spark, str(tmp_path)).collect()}
    assert got == {"a": {"title": "one", "level": "2"}, "b": {}}


def test_every_seed_of_the_svd_start_is_fitted(spark):
    rng = np.random.default_rng(0)
    base = np.array([[3.0, 0, 0, 1, 0], [0, 2, 2, 0, 0], [0, 0, 0, 2, 4]])
    x = rng.gamma(0.5, 1.0, (60, 3)) @ base + rng.gamma(0.2, 0.5, (60, 5))
    rows = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "obs_id int, v array<double>")
    spectra, errors = pg.factorize(rows, [(3, 0), (3, 1), (3, 2)], max_iter=8, init="nndsvda")
    assert len(spectra) == len(errors) == 3
    assert not np.allclose(spectra[(3, 0)], spectra[(3, 1)], atol=1e-12)
    assert max(errors.values()) / min(errors.values()) < 1.2
