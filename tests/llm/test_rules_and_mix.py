import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cytoframe.llm import mix_flow, outlier_rules, surrogates
from cytoframe.session import cut
from tests.llm.samples import awkward, documents, words


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def brute_statistics(text):
    ws = plain_words(text)
    lines = [x for x in (text or "").split("\n") if plain_words(x)]
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in (i, i + 1, i + 2)}
    n = (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
    return (*n, n[0] < 50 or 100 * n[4] > 50 * n[0])


def test_statistics_against_brute_force(spark):
    rng = random.Random(1)
    rows = awkward() + [(100 + i, "\n".join(words(rng, rng.randrange(0, 9), 2) for _ in range(rng.randrange(1, 20)))) for i in range(80)]
    rows += [(300, "a b c a b c"), (301, "a a a a"), (302, "a b c"), (303, "#*$ %&|<> é|"), (304, "x\n x\nx\n\n \n")]
    got = outlier_rules.statistics(documents(spark, rows)).collect()
    made = sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got], key=repr)
    assert made == sorted([(r[0], *brute_statistics(r[1])) for r in rows], key=repr)


def test_outliers_go_and_others_stay(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        lang, source = rng.choice([("en", "a"), ("de", "b"), (None, "c"), ("en", None)])
        rows.append((i, words(rng, rng.randrange(60, 400)), lang, source))
    odd = [(5000 + i, " ".join(w + "$$$" for w in words(rng, 120).split()), "en", "a") for i in range(40)]
    odd += [(6000 + i, " ".join(w * 12 for w in words(rng, 120).split()), "de", "b") for i in range(5)]
    got = outlier_rules.outliers(cut(outlier_rules.statistics(documents(spark, rows + odd + awkward())))).collect()
    assert len(got) == len(rows) + len(odd) + len(awkward())
    assert not [r for r in got if r.doc_id is not None and r.doc_id >= 5000 and r.kept]
    kept = [r.kept for r in got if r.doc_id is not None and 10 <= r.doc_id < 900]
    assert np.mean(kept) > 0.995
    assert all(not r.kept for r in got if r.base_failed)


def test_small_groups_join_and_tiny_tables_have_no_verdict(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, 80), "en", f"s{i % 40}") for i in range(200)] + [(900, words(rng, 90), "xx", "s")]
    got = outlier_rules.outliers(cut(outlier_rules.statistics(documents(spark, rows)))).collect()
    assert {r.grp for r in got if r.lang == "en"} == {'{"lang":"en"}'}
    assert [r.kept for r in got if r.lang == "xx"] == [True]
    assert outlier_rules.outliers(cut(outlier_rules.statistics(documents(spark, [])))).count() == 0


def test_distance_is_mahalanobis_and_chi_square_known(spark):
    assert outlier_rules.chi_square_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert outlier_rules.chi_square_cdf(6.6257, 5) == pytest.approx(0.75, abs=1e-4)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, outlier_rules.P)) @ rng.normal(size=(outlier_rules.P,) * 2)
    frame = spark.createDataFrame([("g", *map(float, v)) for v in x], ["grp", *outlier_rules.FEATURES])
    far = outlier_rules._distance(frame, outlier_rules._estimate(frame, 1.0))
    scatter = np.cov(x.T, bias=True) + np.diag([f**2 for _, f in outlier_rules.FEATURES.values()])
    centred = x - x.mean(axis=0)
    expected = np.einsum("ij,jk,ik->i", centred, np.linalg.inv(scatter), centred)
    assert np.allclose(sorted(r.d2 for r in far.collect()), np.sort(expected))


PRIVATE = [
    (20, "write to Anna.B.42@mail.example.org or ANNA.B.42@MAIL.EXAMPLE.ORG, not a@b"), (21, "call +1 (743) 555-3824 4111111111111111 or +17435553824 now"),
    (22, "host 10.20.30.40 and 10.20.30.40.50, version 1.2.3, 999.1.1.1"), (23, "Mr. John Smith met Mrs Smith and Herr Müller; Dr Smith. Иван Господин Иванов"),
    (24, "123-45-6789 GB82 WEST 1234 5698 7654 32 4111 1111 1111 1111"), (25, None), (26, ""), (27, "é.ñ@mail.com {mail: x_y@z.co}!"), (28, "write to anna.b.42@mail.example.org"), (28, "write to anna.b.42@mail.example.org"),
]


def test_surrogates_keep_type_layout_and_identity(spark):
    got = surrogates.replace(documents(spark, PRIVATE + awkward()), "k").collect()
    assert len(got) == len(PRIVATE) + len(awkward())
    text = {r.doc_id: r.text for r in got}
    n = {r.doc_id: r.n_entities for r in got}
    assert text[25] is None and text[26] == "" and n[26] == 0
    one, two = re.findall(r"\S+@\S+[a-zA-Z]", text[20])[:2]
    assert one.lower() == two.lower() == re.search(r"\S+@\S+", text[28])[0] and two == two.upper() and re.fullmatch(r"[a-z]{4}\.[a-z]\.\d\d@[a-z]{6}\.example\.org", one)
    assert "a@b" in text[20] and n[20] == 2
    a, card, b = re.fullmatch(r"call (\+1 \(\d{3}\) \d{3}-\d{4}) (\d{16}) or (\+1\d{10}) now", text[21]).groups()
    assert re.sub(r"\D", "", a) == b[1:] != "17435553824" and card != "4111111111111111"
    digits = [int(c) for c in card[::-1]]
    assert sum(d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(digits)) % 10 == 0
    assert card == text[24][-19:].replace(" ", "")
    assert "10.20.30.40.50" in text[22] and "1.2.3" in text[22] and "999.1.1.1" in text[22] and not text[22].startswith("host 10.20.30.40 ")
    m = re.match(r"Mr\. (\w+) (\w+) met Mrs (\w+) and Herr (\w+); Dr (\w+)\. Иван Господин (\w+)", text[23])
    given, family, wife, german, doctor, russian = m.groups()
    assert family == wife == doctor and given in surrogates.GIVEN["m"] and "Smith" not in text[23] and "Müller" not in text[23]
    assert re.fullmatch("[А-Я][а-я]{5}", russian) and russian != "Иванов"
    assert re.match(r"\d{3}-\d{2}-\d{4} GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d \d{4} \d{4} \d{4} \d{4}$", text[24])
    assert {r.text for r in got if r.doc_id == 6} == {"same row"}
    other = {r.doc_id: r.text for r in surrogates.replace(documents(spark, PRIVATE), "another key").collect()}
    assert other[20] != text[20] and other[22] != text[22]


def test_surrogates_stay_distinct(spark):
    rows = [(i, f"Mr {a}{b} and 1{i % 10}-{i:02d}") for i, (a, b) in enumerate((a, b) for a in ["Ab", "Cd", "Ef", "Gh", "Kl"] for b in ["o", "a", "in", "er", "el", "us", "ik", "on", "um", "et", "ost", "alm"])]
    rows += [(1000, "Mr Keller"), (1001, "Mr Holm"), (1002, "Mr Novak")]  # real values that the lists hold
    got = {r.doc_id: r.text for r in surrogates.replace(documents(spark, rows)).collect()}
    names = [re.match(r"Mr (\w+)", t)[1] for t in got.values()]
    assert len(set(names)) == len(rows) and not {"Keller", "Holm", "Novak"} & set(names)
    assert surrogates.replace(documents(spark, [])).count() == 0


def test_word_counts(spark):
    rows = awkward() + [(50, " lead"), (51, "trail "), (52, " both \n"), (53, "a\x0bb")]
    got = documents(spark, rows).select("doc_id", mix_flow.word_count("text").alias("n")).collect()
    assert sorted([(r.doc_id, r.n) for r in got], key=repr) == sorted([(r[0], len(plain_words(r[1]))) for r in rows], key=repr)


def brute_targets(sizes, weights):
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while open_:
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        full = [i for i in open_ if share[i] > 3 * sizes[i] + 1e-9]
        if not full:
            for i in open_:
                target[i] = share[i]
            break
        for i in full:
            target[i] = 3.0 * sizes[i]
            left -= target[i]
            open_.discard(i)
    return target


def test_water_filling():
    rng = random.Random(4)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 5, 20, 1000, 30000]) for _ in range(rng.randrange(1, 9))]
        weights = [i % 3 + 1 for i in range(len(sizes))]
        assert np.allclose(mix_flow.water_fill(sizes, weights), brute_targets(sizes, weights))


def test_mix_meets_its_targets(spark):
    rng = random.Random(5)
    rows = awkward() + [(100 + i, words(rng, rng.choice([1, 5, 20, 100, 700])), "en", rng.choice(["a", "B", "é", "z", None, "big", "big", "big"])) for i in range(900)]
    docs = documents(spark, rows).select("doc_id", "text", "source")
    got = mix_flow.mix(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by.setdefault(r.sources[0], []).append(r)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(r.size for r in by[s]) for s in names]
    target = brute_targets(sizes, [i % 3 + 1 for i in range(len(names))])
    for s, n, t in zip(names, sizes, target):
        assert {r.source_size for r in by[s]} == {n} and by[s][0].target == pytest.approx(t)
        if s not in ("src0",):  # one document of 60,000 words
            assert abs(sum(r.taken for r in by[s]) - t) <= max(2, 0.01 * t)
    again = mix_flow.mix(docs).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert mix_flow.mix(documents(spark, []).select("doc_id", "text", "source")).count() == 0


def test_flow_is_the_cheapest():
    """Against every integer flow of a small network of overlapping sources."""
    supply, members, demand = {"p": 3, "q": 2, "r": 2}, {"p": [0], "q": [0, 1], "r": [1]}, [5, 6]
    got = mix_flow.route(supply, members, demand)
    used = Counter()
    for (p, _), v in got.items():
        used[p] += v
    price = lambda u: sum(sum(min(supply[p], max(0, n - c * supply[p])) * (c + 1) for c in range(3)) for p, n in u.items())
    best = min(
        price({"p": a, "q": b + c, "r": d})
        for a in range(10) for b in range(7) for c in range(7 - b) for d in range(7)
        if a + b == demand[0] and c + d == demand[1]
    )
    assert sum(used.values()) == sum(demand) and price(used) == best
    assert [sum(v for (_, s), v in got.items() if s == k) for k in (0, 1)] == demand


def test_documents_of_several_sources(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, 20), sorted(rng.sample(["a", "b", "c"], rng.randrange(1, 3)))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = mix_flow.mix(docs).collect()
    assert len(got) == 200 and all(r.taken <= 3 * r.size for r in got)
    assert abs(sum(r.taken for r in got) - 200 * 20) <= 100
    assert math.isfinite(sum(r.target for r in got))
