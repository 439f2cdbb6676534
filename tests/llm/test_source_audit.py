"""Packed term counts and the audit against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cytoframe.llm.source_audit import audit, pack, per_billion, radix_order, term_counts, unpack
from tests.llm.samples import awkward, documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aBzZ é文🙂1_[`{\x00\x7f\n", max_size=60), min_size=1, max_size=5))
def test_pack_finds_all_terms(texts):
    raw = [t.encode() for t in texts]
    got = Counter()
    for _, words, doc in pack(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])):
        got.update(zip(doc.tolist(), unpack(words).to_pylist(), strict=True))
    assert got == Counter((k, x) for k, t in enumerate(texts) for x in terms_of(t))


def test_radix_order_is_stable_and_right():
    rng = np.random.default_rng(0)
    words = [rng.integers(0, 3, 5000).astype(np.uint64) << np.uint64(40), rng.integers(0, 1 << 63, 5000).astype(np.uint64) % np.uint64(50)]
    assert (radix_order(words) == np.lexsort((np.arange(5000), words[1], words[0]))).all()


def test_per_billion_is_exact():
    n, total = np.array([1, 5, 10**12, 3 * 10**15]), np.array([3, 5, 3 * 10**12 + 1, 4 * 10**15])
    assert per_billion(n, total).tolist() == [1 + 10**9 * int(a) // int(b) for a, b in zip(n, total, strict=True)]
    assert per_billion(np.array([7]), np.array([1 << 60])).tolist() == [1 + 10**9 * 7 // (1 << 60)]


def brute(rows, min_docs, extra, top):
    rows = [(r[1] or "", r[2] or "", r[3] or "") for r in rows]
    count, held, out = defaultdict(Counter), defaultdict(Counter), []
    for text, lang, source in rows:
        count[lang, source].update(terms_of(text))
        held[lang].update(set(terms_of(text)))
    for lang in held:
        kept = sorted((t for t, n in held[lang].items() if n >= min_docs), key=str.encode)
        sources = [s for g, s in count if g == lang]
        whole = sum((count[lang, s] for s in sources), Counter())
        p = lambda c: [1 + 10**9 * (c[t] + extra) // (sum(c[x] for x in kept) + extra * len(kept)) for t in kept]
        by, q = {s: p(count[lang, s]) for s in sources}, p(whole)
        for s in sources:
            far = sorted((-sum(abs(a - b) for a, b in zip(by[s], by[o], strict=True)), o.encode()) for o in sources if o != s)
            out += [(lang, s, "pair", o.decode(), -v, k) for k, (v, o) in enumerate(far, 1)]
            own = sorted((b - a, t.encode()) for t, a, b in zip(kept, by[s], q, strict=True) if count[lang, s][t] and a > b)[:top]
            out += [(lang, s, "term", t.decode(), -v, k) for k, (v, t) in enumerate(own, 1)]
    return sorted(out)


def rows_of(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "Bee", "straße", "donaudampfschiff", "donaudampfschifffahrtsgesellschaft", "文字文字文字", "é" * 30, "x" * 200, *(f"w{'abcdefgh'[i % 8] * (i % 11)}" for i in range(40))]
    return [(i, " ".join(rng.choice(vocabulary[: 10 + 8 * (i % 5)]) for _ in range(rng.randrange(30))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "S1", "é", None, "s2"])) for i in range(300)]


def test_audit_as_brute_force(spark):
    rows = [(*r, *("en", "src0")[len(r) - 2 :])[:4] for r in awkward()] + rows_of(1) + rows_of(2)
    for options in ({"min_docs": 3, "extra": 5, "top": 4}, {"min_docs": 30, "extra": 1, "top": 50}):
        got = sorted(tuple(r) for r in audit(documents(spark, rows), part_entries=37, **options).collect())
        assert got == brute(rows, **options)


def test_nothing_kept_and_empty_table(spark):
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b"), (3, None, "en", "c")]
    assert sorted(tuple(r) for r in audit(documents(spark, rows)).collect()) == brute(rows, 30, 5, 50)
    assert audit(documents(spark, [])).count() == 0


def test_counts_are_exact_over_flushes(spark, monkeypatch):
    rows = rows_of(7)
    got = {(r.lang, r.source, r.term): (r.n, r.docs) for r in term_counts(documents(spark, rows)).collect()}
    n, docs = Counter(), Counter()
    for _, text, lang, source in rows:
        n.update((lang or "", source or "", t) for t in terms_of(text))
        docs.update((lang or "", source or "", t) for t in set(terms_of(text)))
    assert got == {k: (n[k], docs[k]) for k in n}
