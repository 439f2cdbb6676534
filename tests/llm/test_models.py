import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cytoframe.llm import hidden_markov, language_backoff, quality_mil
from cytoframe.llm.common import fold
from cytoframe.llm.tokens import slices
from tests.llm.samples import awkward, documents, words
from tests.llm.test_near_and_benchmark import tokens

SOUNDS = {"en": ["the", "and", "ing", "th", "er", "on"], "de": ["der", "und", "sch", "ung", "ei", "ich"], "fr": ["les", "eau", "ment", "ou", "é", "que"]}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def held(n, rest):
    return lambda doc_id: doc_id is not None and zlib.crc32(str(doc_id).encode()) % n == rest


def test_language_of_held_out_documents(spark):
    rng = random.Random(2)
    rows = [(i, speech(rng, lang, rng.randrange(8, 60)), lang) for i, lang in enumerate(rng.choices(list(SOUNDS), k=240))]
    rows += [(*r, None) for r in [(900, None), (901, ""), (902, "123 !? 456"), (903, " \n"), (905, "theand"), (905, "theand"), (None, "undsch ungder")]]
    docs = documents(spark, rows).select("doc_id", "text", "lang", fold("doc_id", 4, 2).alias("held_out"))
    model = language_backoff.train(docs.where("NOT held_out"))
    got = language_backoff.identify(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == held(4, 2)(r.doc_id) and 0 <= r.score <= 1
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    right = [r.lang_pred == r.lang for r in got if r.lang and r.held_out]
    assert len(right) > 30 and np.mean(right) > 0.97
    assert {r.lang_pred for r in got if r.doc_id == 905} == {"en"}


def test_backoff_uses_the_longest_known_ngrams(spark):
    docs = documents(spark, [(i, "abcd abcd zzz zzz", "l1") for i in range(5)] + [(10 + i, "abyy abyy zzz zzz", "l2") for i in range(5)])
    model = language_backoff.train(docs)
    rows = documents(spark, [(1, "xabcdx"), (2, "abyyq"), (3, "qqqq")])
    got = {r.doc_id: r.lang_pred for r in language_backoff.identify(rows.select("doc_id", "text"), model).collect()}
    assert got == {1: "l1", 2: "l2", 3: "l1"}  # nothing known: a tie, the first language


def test_language_without_training_rows(spark):
    docs = documents(spark, awkward()).select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    assert language_backoff.train(docs) is None
    assert {r.lang_pred for r in language_backoff.identify(docs, None).collect()} == {"und"}
    assert language_backoff.identify(docs.limit(0), None).count() == 0


def test_quality_on_held_out_documents(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(300):
        good = rng.random() < 0.6
        text = speech(rng, "en", rng.randrange(5, 300))
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split()) if i % 2 else " ".join(w + rng.choice(["$$$", "***"]) for w in text.split())
        rows.append((i, text))
        labels.append((i, int(good)))
    labels += [(5000, 1), (5001, None), (None, 1)]
    docs = documents(spark, rows + awkward()).select("doc_id", "text", fold("doc_id", 3, 1).alias("held_out"))
    marks = spark.createDataFrame(labels, "doc_id long, label int")
    model = quality_mil.train(docs.where("NOT held_out"), marks.where(~fold("doc_id", 3, 1)))
    got = quality_mil.score(docs, model).collect()
    assert len(got) == len(rows) + len(awkward())
    assert all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    right = [(r.score >= 0.5) == truth[r.doc_id] for r in got if r.doc_id in truth and r.held_out and r.doc_id >= 10]
    assert len(right) > 60 and np.mean(right) > 0.97
    assert max(r.n_passages for r in got) == 938  # the long text, whole


def test_attention_gradient_is_the_numerical_one():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality_mil.WIDTH)) for n in (1, 3, 5, 2)]
    y = np.array([1.0, 0, 1, 0])
    model = quality_mil.Model(bags, y, 1, 0)
    x, bounds, weight = np.concatenate(bags), np.array([0, 1, 4, 9, 11]), np.ones(4)

    def loss():
        s = model._forward(x, bounds)["s"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    grad = model._gradient(x, bounds, y, weight)
    for k, p in model.p.items():
        flat = p.reshape(-1)
        for i in range(0, len(flat), max(1, len(flat) // 5)):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert grad[k].reshape(-1)[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_quality_without_labels(spark):
    docs = documents(spark, awkward()).select("doc_id", "text", F.lit(False).alias("held_out"))
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in quality_mil.score(docs, quality_mil.train(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(6, 1), (4, 1)], "doc_id long, label int")
    assert {r.score for r in quality_mil.score(docs, quality_mil.train(docs, one)).collect()} == {1.0}
    assert quality_mil.score(docs.limit(0), quality_mil.train(docs.limit(0), one)).count() == 0


def brute_base(rows):
    out_of = held(7, 2)
    lists = [(r[0], tokens(r[1]) + [" end"]) for r in rows]
    counts = Counter(w for i, ws in lists if not out_of(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted([(i, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in lists], key=repr), counts


@pytest.mark.parametrize("own,listed", [(16_000, 250_000), (3, 5)])
def test_base_scores_against_brute_force(spark, own, listed):
    rng = random.Random(5)
    rows = awkward() + [(100 + i, words(rng, rng.randrange(1, 60), 9)) for i in range(60)]
    docs = documents(spark, rows).select("doc_id", "text", fold("doc_id", 7, 2).alias("held_out"))
    got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in hidden_markov.score(docs, own, listed, passes=1).collect()], key=repr)
    expected, _ = brute_base(rows)
    for g, e in zip(got, expected, strict=True):
        assert g[:4] == e[:4] and g[4] == pytest.approx(e[4], rel=1e-9)


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(2)
    s = hidden_markov.STATES
    model = hidden_markov.Markov(rng.dirichlet(np.ones(s)), rng.dirichlet(np.ones(s), s), rng.dirichlet(np.ones(4), s).T)
    seqs = [rng.integers(0, 4, n).astype("<u2") for n in (3, 1, 4, 2)]
    got = model.log10_likelihood(seqs)
    for seq, g in zip(seqs, got):
        total = 0.0
        for path in np.ndindex(*(s,) * len(seq)):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= model.move[path[t - 1], path[t]] * model.emit[seq[t], path[t]]
            total += p
        assert g == pytest.approx(math.log10(total))
    # the expected counts of forward-backward are those of all state paths
    start, move, emit, like = model.expected(seqs)
    assert start.sum() == pytest.approx(4) and move.sum() == pytest.approx(6) and emit.sum() == pytest.approx(10)
    assert like / math.log(10) == pytest.approx(got.sum())
    one = seqs[0]
    weights = {}
    for path in np.ndindex(*(s,) * 3):
        p = model.start[path[0]] * model.emit[one[0], path[0]]
        for t in (1, 2):
            p *= model.move[path[t - 1], path[t]] * model.emit[one[t], path[t]]
        weights[path] = p
    z = sum(weights.values())
    brute = np.zeros((s, s))
    for path, p in weights.items():
        for t in (1, 2):
            brute[path[t - 1], path[t]] += p / z
    assert np.allclose(model.expected([one])[1], brute)


def test_word_probabilities_add_up_and_training_helps(spark):
    rng = random.Random(9)
    rows = [(i, speech(rng, rng.choice(list(SOUNDS)), 80)) for i in range(80)]
    docs = documents(spark, rows).select("doc_id", "text", fold("doc_id", 7, 2).alias("held_out"))
    one = {r.doc_id: r for r in hidden_markov.score(docs, passes=1).collect()}
    many = {r.doc_id: r for r in hidden_markov.score(docs, passes=6).collect()}
    again = {r.doc_id: r for r in hidden_markov.score(docs, passes=6).collect()}
    assert all(many[i].score == again[i].score for i in many)
    out = [i for i in many if many[i].held_out]
    assert sum(many[i].score for i in out) > sum(one[i].score for i in out)
    assert sum(many[i].score for i in many) > sum(many[i].base_score for i in many)
    # all one-token texts that differ: known words and one unseen word
    _, counts = brute_base(rows)
    vocabulary = [w for w in counts if w != " end"]
    probe = documents(spark, rows + [(10_000 + i, w) for i, w in enumerate(vocabulary)]).select("doc_id", "text", (fold("doc_id", 7, 2) | (F.col("doc_id") >= 10_000)).alias("held_out"))
    got = [r.score for r in hidden_markov.score(probe, passes=2).collect() if r.doc_id >= 10_000]
    assert 0 < sum(10**x for x in got) <= 1


def test_scores_of_no_documents(spark):
    docs = documents(spark, []).select("doc_id", "text", F.lit(False).alias("held_out"))
    assert hidden_markov.score(docs).count() == 0
    held_only = documents(spark, [(1, "a b")]).select("doc_id", "text", F.lit(True).alias("held_out"))
    r = hidden_markov.score(held_only).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.base_score == 0.0


def test_language_stage_follows_the_model_and_keeps_all_without_one(spark):
    rng = random.Random(21)
    rows = [(i, speech(rng, lang, 40), lang) for i, lang in enumerate(rng.choices(list(SOUNDS), k=2400))]
    strange = [(5000 + i, " ".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(130)), None) for i in range(20)]
    docs = documents(spark, rows + strange).select(*corpus_pipeline.COLUMNS)
    got = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, "").collect()}
    assert got == {r[0] for r in rows}
    unknown = documents(spark, awkward()).withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.language_stage(spark, unknown, "").collect()
    assert sorted(r.text for r in got) == sorted(r[1] for r in awkward() if r[1] and any(c.isalpha() for c in r[1]))


def test_small_language_keeps_its_ngrams(spark):
    rng = random.Random(22)
    rows = [(i, speech(rng, "en", 30), "en") for i in range(400)] + [(900 + i, speech(rng, "fr", 10), "fr") for i in range(3)]
    model = language_backoff.train(documents(spark, rows), max_bytes=16 * 2 * 2 * 100)
    kept = [sum(float((logs[:, i] > logs[:, i].min()).sum()) for logs in model.logs[1:] if len(logs)) for i in range(2)]
    assert min(kept) >= 30


def test_features_are_kept_whole_within_the_bytes(spark):
    """A word that one language chose has its counts in all of them, and the model has the size asked for."""
    rng = random.Random(23)
    rows = [(i, "common shared " + speech(rng, lang, 30), lang) for i, lang in enumerate(["en"] * 300 + ["fr"] * 300 + ["de"] * 5)]
    docs = documents(spark, rows)
    whole = language_backoff.train(docs)
    for size in (20 * 3 * 2 * 60, 20 * 3 * 2 * 400):
        model = language_backoff.train(docs, max_bytes=size)
        assert model.nbytes <= size and model.langs == ["de", "en", "fr"]
        word = next(slices(pa.array(["shared"]))).hashes
        at, known = model.find(0, word)
        counts = np.exp(model.logs[0][at[0]].astype(float))
        assert known[0] and counts.min() > 0.5 * counts.max() / 20
        for k in range(5):
            kept = np.isin(whole.keys[k], model.keys[k])
            assert kept.sum() == len(model.keys[k])
            ratio = np.exp(whole.logs[k][kept].astype(float) - model.logs[k])
            np.testing.assert_allclose(ratio, np.broadcast_to(ratio[:1], ratio.shape), rtol=1e-4)  # the same counts, another total
