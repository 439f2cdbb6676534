"""Every stage of the pipeline against brute force on what the stage before it kept."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.samples import awkward, documents, words
from tests.llm.test_lines_and_secrets import brute_lines
from tests.llm.test_models import SOUNDS, speech
from tests.llm.test_near_and_benchmark import brute_classes, brute_matches, edited
from tests.llm.test_rules_and_mix import brute_targets, plain_words

COLUMNS = corpus_pipeline.COLUMNS


def corpus(rng, items):
    rows = [(*r, None, None)[:4] for r in awkward()]
    for i in range(220):
        lang = rng.choice(list(SOUNDS))
        text = speech(rng, lang, rng.randrange(1, 120))
        if i % 9 == 0:
            text = "Read the LICENSE first.\n" + text + "\n read the license first. "
        if i % 11 == 0:
            text += "\n" + rng.choice(items)[1]
        rows.append((100 + i, text, lang, rng.choice(["a", "a", "b", "é", None])))
        if i % 5 == 0:
            rows += [(1000 + 10 * i + j, edited(rng, text, j % 3), lang, "b") for j in range(rng.randrange(0, 4))]
    rows += [(900 + i, rng.choice(["123 456", "...", " \n"]), None, "a") for i in range(4)]
    rows += [(950 + i, "read the license first.", "en", "c") for i in range(3)]
    return rows


def told(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rng = random.Random(7)
    items = [(i, words(rng, rng.randrange(20, 50))) for i in range(6)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = documents(spark, corpus(rng, items))
    docs.write.parquet(f"{folder}/documents.parquet")
    seen = [docs.select(*COLUMNS)]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/out/{n}")
        docs = spark.read.parquet(f"{folder}/out/{n}")
        seen.append(docs)
    return items, folder, seen


def test_columns(stages):
    _, _, seen = stages
    assert all(df.columns == COLUMNS for df in seen[:-1]) and seen[-1].columns == [*COLUMNS, "taken"]


def test_language_stage(stages):
    _, _, seen = stages
    keep = [r for r in told(seen[0]) if r[1] is not None and any(c.isalpha() for c in r[1])]
    assert told(seen[1]) == keep


def test_line_stage(stages):
    _, _, seen = stages
    before = told(seen[1])
    brute = brute_lines(before, 10)
    assert any(b[2] for b in brute)
    expected = sorted([(b[0], b[3]) for b in brute if plain_words(b[3])], key=repr)
    after = told(seen[2])
    assert sorted([r[:2] for r in after], key=repr) == expected and len(after) < len(before)
    assert all(r[4] == len(r[1]) for r in after)


def test_near_stage(stages):
    _, _, seen = stages
    before = told(seen[2])
    keep = sorted({r[0] for r in brute_classes(before, 5, 80) if r[0] is not None and r[0] == r[2]})
    after = told(seen[3])
    assert sorted(r[0] for r in after if r[0] is not None) == keep and len(after) < len(before)
    assert all(r in before for r in after)
    assert [r for r in after if r[0] is None] == [r for r in before if r[0] is None]


def test_benchmark_stage(stages):
    items, _, seen = stages
    before = told(seen[3])
    gone = {i for i, _ in brute_matches(before, items)}
    assert gone and told(seen[4]) == [r for r in before if r[0] not in gone]


def test_mix_stage(stages):
    _, _, seen = stages
    before, after = told(seen[4]), told(seen[5])
    names = sorted({r[3] for r in before}, key=lambda s: (s is None, s or ""))
    size = lambda rows, s: sum(len(plain_words(r[1])) for r in rows if r[3] == s)
    targets = brute_targets([size(before, s) for s in names], [i % 3 + 1 for i in range(len(names))])
    for s, target in zip(names, targets):
        own = [r for r in before if r[3] == s]
        room = max(len(plain_words(r[1])) for r in own) / 2
        assert abs(sum(r[5] for r in after if r[3] == s) - target) <= max(1, room)
    assert all(r[:5] in before and 0 < r[5] <= 3 * len(plain_words(r[1])) for r in after)


def test_run_and_empty_tables(spark, stages, tmp_path):
    _, folder, seen = stages
    assert told(corpus_pipeline.run(spark, folder)) == told(seen[-1])
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
