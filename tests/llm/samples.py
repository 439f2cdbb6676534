"""Small document tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _t int, h1 string, pos string, comp long, pattern string, score string"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); extra columns clash with names used inside the operators."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, *("en", "src0")[len(row) - 2 :])[:4]
        full.append((doc_id, text, lang, source, None if text is None else len(text), "x", 1, "h", "p", 7, "q", "s"))
    return spark.createDataFrame(full, SCHEMA)


def words(rng: random.Random, n: int, size: int = 4000) -> str:
    return " ".join(f"{'bcdfghklmnprst'[rng.randrange(14)]}{'aeiou'[rng.randrange(5)]}{rng.randrange(size)}" for _ in range(n))


def awkward():
    return [(None, None, None, None), (None, "alone without an id", None, "src1"), (1, None), (2, ""), (3, " \t\n\x0b "), (4, "x"), (5, LONG), (6, "same row"), (6, "same row"), (7, "Ünï çödé  文字 🙂\nline\r\n")]
