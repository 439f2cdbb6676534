"""Ids of whole texts, the raw shards, and keyed access against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cytoframe.llm.token_store import Encoder, Levels, new_store, open_file
from tests.llm.samples import awkward, documents, words

FILE = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(FILE)
ENCODER = Encoder(FILE)


def slice_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abrelv'sté \t\n\r\x00\x1c\u00a0\u0085\u3000\u2009\u2028ß文12!-<|endoftx>²", max_size=40), min_size=1, max_size=6))
def test_chunks_give_the_ids_of_whole_texts(texts):
    ids, bounds = ENCODER.encode(*slice_of(texts))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abst'12!- .\n", max_size=60))
def test_inner_cuts_give_the_ids_of_whole_texts(text):
    ids, _ = ENCODER.encode(*slice_of([text]))
    assert ids.tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_chunks_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr("cytoframe.llm.token_store.mix", lambda x: x * 0)
    ids, bounds = Encoder(FILE).encode(*slice_of(["one two", "three"]))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [PLAIN.encode(t, add_special_tokens=False).ids for t in ("one two", "three")]


def test_special_string_and_long_text():
    texts = ["a <|endoftext|> b", "a12b34-'s x'll'really it's3 -5 '5 a.b,c  d",  " x" * 5000, "\n\n \n end  ", "word\u00a0 next"]
    ids, bounds = ENCODER.encode(*slice_of(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 40_000])
def test_hash_is_perfect_and_minimal(n):
    rng = np.random.default_rng(n)
    h1, h2 = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
    levels = Levels.of(h1, h2)
    assert sorted(levels.slots(h1, h2)) == list(range(n))


def expected(rows):
    """doc_id order with null last; rows of one id by what they hold."""
    coded = [(r[0], [*PLAIN.encode(r[1] or "", add_special_tokens=False).ids, 0]) for r in rows]
    return {(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in coded}, sorted(len(x) for _, x in coded), coded


@pytest.mark.parametrize("shards", [1, 5])
def test_round_trip_with_awkward_rows(spark, shards):
    rng = random.Random(4)
    rows = [(r[0], r[1]) for r in awkward()] + [(i, words(rng, rng.randrange(200))) for i in range(-20, 60)] + [(77, f"copy {i % 3}") for i in range(90)]
    store = new_store(spark, FILE).write(documents(spark, rows), shards)
    keys = documents(spark, rows).groupBy("doc_id").count().withColumnRenamed("count", "copies")
    got = store.checksums(keys).collect()
    want, sizes, coded = expected(rows)
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want and sorted(r.n_tokens for r in got) == sizes
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted((i for i, _ in coded if i is not None)) + [None] * sum(i is None for i, _ in coded)
    assert {(r.doc_id, tuple(r.ids)) for r in store.ids(keys).collect()} == {(i, tuple(x)) for i, x in coded}
    # the shards are the plain ids, end ids included
    raw = b"".join(open_file(r.path).read_at(r.ids * 2, 0) for r in store.manifest().orderBy("shard").collect())
    whole = np.frombuffer(raw, "<u2").astype("<u4")
    assert all(zlib.crc32(whole[r.start : r.start + r.n_tokens].tobytes()) == r.ids_crc32 for r in got)


def test_foreign_and_repeated_keys(spark):
    rows = [(i, f"text {i}") for i in range(50)]
    store = new_store(spark, FILE).write(documents(spark, rows), 3)
    keys = spark.createDataFrame([(i,) for i in [3, 3, 3, 49, 1000, -5, None]], "doc_id long")
    assert sorted(r.doc_id for r in store.ids(keys).collect()) == [3, 49]


def test_empty_table(spark):
    store = new_store(spark, FILE).write(documents(spark, []), 3)
    assert store.checksums(documents(spark, [(1, "x")])).count() == 0
