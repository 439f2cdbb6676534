import random

import numpy as np
import pyarrow as pa

from cytoframe.llm import chosen_path, decontaminate
from cytoframe.llm.tokens import shingles, slices
from tests.llm.samples import awkward, documents, words


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    for c in "\t\n\x0b\f\r":
        text = (text or "").replace(c, " ")
    return [w for w in lower(text).split(" ") if w]


def shingle_set(text, k):
    ws = tokens(text)
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def brute_classes(rows, k, percent):
    sets = [shingle_set(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted([(r[0], len(sets[i]), None if r[0] is None else low[find(i)]) for i, r in enumerate(rows)], key=repr)


def edited(rng, text, changes):
    ws = text.split(" ")
    for _ in range(changes):
        ws[rng.randrange(len(ws))] = f"edit{rng.randrange(10**6)}"
    return " ".join(ws)


def test_tokens_match_a_plain_loop():
    texts = [r[1] for r in awkward()] + ["A b\x0bC", "a b c", "one two three four five"]
    seen = {}
    for w in slices(pa.array(texts)):
        for t in range(w.n_texts):
            mine = tokens(texts[w.first + t])
            assert len(mine) == w.bounds[t + 1] - w.bounds[t]
            for word, h in zip(mine, w.hashes[w.bounds[t] : w.bounds[t + 1]]):
                assert seen.setdefault(word, h) == h
        hashes, bounds = shingles(w, 4)
        for t in range(w.n_texts):
            assert len(np.unique(hashes[bounds[t] : bounds[t + 1]])) == len(shingle_set(texts[w.first + t], 4))
    assert len(set(map(int, seen.values()))) == len(seen)


def test_near_classes_against_brute_force(spark):
    rng = random.Random(4)
    rows = awkward()
    for g in range(12):
        base = words(rng, rng.randrange(30, 200))
        rows += [(1000 + 50 * g + i, edited(rng, base, rng.randrange(0, 5))) for i in range(rng.randrange(1, 12))]
    passage = words(rng, 60)  # shared by many, near duplicates of none
    rows += [(3000 + i, words(rng, 60) + " " + passage + " " + words(rng, 30)) for i in range(80)]
    big = words(rng, 150)  # a large group with chains around the threshold
    rows += [(5000 + i, edited(rng, big, 3 + i % 5)) for i in range(90)]
    rng.shuffle(rows)
    docs = documents(spark, rows)
    got = chosen_path.similar_classes(docs.select("doc_id", "text"), k=4, small=8)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], key=repr) == brute_classes(rows, 4, 80)


def test_texts_around_a_passage_branch_before_the_rare_join(spark, monkeypatch):
    """Texts that only share a passage don't reach the join on rare shingles, and pairs among them are found."""
    met, join = [], chosen_path.rare_nodes

    def counted(members, k, percent):
        met.append(members.count())
        return join(members, k, percent)

    monkeypatch.setattr(chosen_path, "rare_nodes", counted)
    rng = random.Random(11)
    passage = words(rng, 25)
    rows = [(i, words(rng, 60) + " " + passage + " " + words(rng, 30)) for i in range(160)]
    rows += [(1000 + i, edited(rng, rows[7 * i][1], i % 4)) for i in range(20)]
    got = chosen_path.similar_classes(documents(spark, rows).select("doc_id", "text"), k=4, small=8)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], key=repr) == brute_classes(rows, 4, 80)
    assert sum(met) < len(rows) // 4  # all of them without branches


def test_a_large_group_below_the_threshold_still_meets_in_the_rare_join(spark, monkeypatch):
    """Nodes that stay crowded at the last level are joined exactly."""
    met, join = [], chosen_path.rare_nodes

    def counted(members, k, percent):
        met.append(members.count())
        return join(members, k, percent)

    monkeypatch.setattr(chosen_path, "rare_nodes", counted)
    rng = random.Random(12)
    base = words(rng, 150)
    rows = [(i, edited(rng, base, 6 + i % 3)) for i in range(100)]
    got = chosen_path.similar_classes(documents(spark, rows).select("doc_id", "text"), k=4, small=4)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()], key=repr) == brute_classes(rows, 4, 80)
    assert sum(met) > 0


def test_one_of_each_keeps_columns_and_one_row(spark):
    rows = awkward() + [(50, "a b c d e f g"), (40, "a b c d e f g"), (60, "a b c d e f g h i j k l m n o p")]
    kept = chosen_path.one_of_each(documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = sorted([r.doc_id for r in kept.collect()], key=repr)
    assert ids == sorted([None, None, 1, 2, 3, 4, 5, 6, 7, 40, 60], key=repr)


def test_no_documents(spark):
    docs = documents(spark, []).select("doc_id", "text")
    assert chosen_path.similar_classes(docs).count() == 0
    items = spark.createDataFrame([(1, "one two three four five six " * 4)], "item_id long, text string")
    assert decontaminate.matches(docs, items).count() == 0
    assert decontaminate.matches(documents(spark, awkward()).select("doc_id", "text"), items.limit(0)).count() == 0


def brute_matches(rows, items):
    out = []
    for doc_id, text, *_ in rows:
        mine = shingle_set(text, 5)
        for item, body in items:
            ws = tokens(body)
            if item is None or len(ws) < 15:
                continue
            q = len(ws) - len(ws) // 3
            parts = [shingle_set(" ".join(p), 5) for p in (ws[:q], ws[q:])]
            if all(len(p & mine) >= 0.8 * len(p) for p in parts):
                out.append((doc_id, item))
    return sorted(out, key=repr)


def test_benchmark_matches_against_brute_force(spark):
    rng = random.Random(6)
    items = [(i, words(rng, rng.randrange(12, 90), 300)) for i in range(40)] + [(90, None), (None, "x " * 30), (91, words(rng, 700))]
    rows = awkward()
    for i in range(120):
        body = words(rng, rng.randrange(0, 400), 300)
        if i % 3 == 0:
            item = rng.choice(items[:40])[1]
            body += " " + (edited(rng, item, 1).upper() if i % 2 else item) + "\n" + words(rng, rng.randrange(0, 90), 300)
        if i % 7 == 0:
            body += " " + " ".join(tokens(items[5][1])[: 2 * len(tokens(items[5][1])) // 3])  # question without its answer
        rows.append((100 + i, body))
    rows.append((999, words(rng, 100) + " " + items[-1][1]))
    docs = documents(spark, rows).select("doc_id", "text")
    frame = spark.createDataFrame(items, "item_id long, text string")
    for shard in (20_000, 9):
        got = decontaminate.matches(docs, frame, shard_items=shard)
        assert sorted([(r.doc_id, r.item_id) for r in got.collect()], key=repr) == brute_matches(rows, items)


def test_question_and_answer_far_apart(spark):
    rng = random.Random(9)
    common = words(rng, 20, 300)  # the question's words are in every item, the answer's in one
    items = [(i, " ".join(rng.sample(common.split(" "), 20)) + " " + words(rng, 10)) for i in range(30)]
    rows = []
    for i, text in items:
        ws = text.split(" ")
        rows.append((100 + i, " ".join(ws[20:]) + " " + words(rng, 300) + " " + " ".join(ws[:20])))
    rare = words(rng, 30)  # a plain item, too: no part of it alone has 60 % of the weight if the question has common words
    items.append((50, rare))
    rows.append((200, " ".join(rare.split(" ")[:20]) + " " + words(rng, 300) + " " + " ".join(rare.split(" ")[20:])))
    half = common.split(" ")[:10] + words(rng, 20).split(" ")  # 10 common and 10 rare words, then 10 rare ones
    items.append((51, " ".join(half)))
    rows.append((201, " ".join(half[:20]) + " " + words(rng, 300) + " " + " ".join(half[20:])))
    got = decontaminate.matches(documents(spark, rows).select("doc_id", "text"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted([(r.doc_id, r.item_id) for r in got], key=repr) == brute_matches(rows, items)
    assert {(201, 51), (200, 50)} <= {(r.doc_id, r.item_id) for r in got} and all(0.6 <= r.score <= 1 + 1e-9 for r in got)


def test_wand_equals_scoring_everything():
    import pandas as pd

    rng = random.Random(8)
    items = pd.DataFrame({"item_id": range(150), "text": [words(rng, rng.randrange(15, 60), 12) for _ in range(150)]})
    index = decontaminate.Index(items, 0.3, 15)
    score = np.zeros((len(index.terms), len(index.ids)))
    for t in range(len(index.terms)):
        a, b = index.bounds[t], index.bounds[t + 1]
        score[t, index.piece[a:b]] = index.impact[a:b]
    for _ in range(100):
        terms = sorted(rng.sample(range(len(index.terms)), 40))
        whole = score[terms].sum(axis=0)
        expected = {d: s for d, s in enumerate(whole) if s >= 0.3}
        got = {d: s for block in range(index.n_blocks) for d, s in index.wand(np.array(terms), block)}
        assert got.keys() == expected.keys()
        assert all(abs(got[d] - s) < 1e-9 for d, s in expected.items())


def test_crowd_around_the_threshold_against_brute_force(spark):
    """A large group just below 0.8; single links at 0.8 stand in nodes of several hundred other texts."""
    rng = random.Random(12)
    base = words(rng, 200)
    rows = []
    for i in range(500):
        text = edited(rng, base, 4)
        rows.append((2 * i, text))
        if i % 3 == 0:
            rows.append((10_000 + i, edited(rng, text, 5)))
    names = {}
    sets = [np.array([names.setdefault(x, len(names)) for x in shingle_set(r[1], 4)]) for r in rows]
    has = np.zeros((len(rows), len(names)), np.float32)
    for i, s in enumerate(sets):
        has[i, s] = 1
    both = np.rint(has @ has.T)
    size = has.sum(axis=1)
    near = 100 * both >= 80 * (size[:, None] + size - both)
    low = np.array([r[0] for r in rows])
    while True:
        now = np.where(near, low, low.max()).min(axis=1)
        if (now == low).all():
            break
        low = now
    assert len(set(low)) > 50
    got = chosen_path.similar_classes(documents(spark, rows).select("doc_id", "text"), k=4, small=16)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == sorted(zip([r[0] for r in rows], low.tolist()))


def test_one_id_with_two_texts_keeps_one_row_of_each_class(spark):
    one, two = "a b c d e f g h", "q r s t u v w x"
    rows = [(5, one), (5, two), (7, one), (8, two), (5, one), (9, " "), (9, "")]
    kept = chosen_path.one_of_each(documents(spark, rows).select("doc_id", "text")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(5, one), (5, two), (9, ""), (9, " ")]


def test_repeated_rows_meet_as_one(spark):
    pairs = spark.createDataFrame([(1, 10), (1, 11)], "_id long, _t long")
    texts = spark.createDataFrame([(1, 10, "a")] * 50 + [(1, 11, "b")] * 50 + [(2, 12, "c")], "_id long, _t long, text string")
    assert sorted(r.text for r in chosen_path.texts_of(pairs, texts).collect()) == ["a", "b"]
