"""Texts and frames that every operator must take: nulls, empty, short and very long texts, ties, repeated
rows, clashing column names, no rows."""

from __future__ import annotations

import random

LONG = "word " * 30_000
PLAIN = "the quick brown fox jumps over the lazy dog and runs away from the noisy town"

ROWS = [
    (1, PLAIN), (2, PLAIN), (2, PLAIN), (3, None), (4, ""), (5, "x"), (6, LONG), (7, "a" * 60_000), (8, "é🙂 ñ​\x00 \x01"),
    (9, " \n\t "), (None, PLAIN + " now"), (None, None), (10, "12 34 !?"), (11, PLAIN.upper()),
]


def frame(spark, rows=ROWS, case=True):
    """Rows as documents, with columns whose names the operators use inside or (``case``) that differ only in case."""
    clash = ["rid", "text_", "node", "label", "sig", "spans", "score", "unit", "host", "place", "_slot0", "_doc", "Doc_ID", "TEXT"][:None if case else -2]
    data = [(d, t, "en", "s", len(t or ""), *["q"] * len(clash)) for d, t in rows]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    kinds = ["long", "string", "string", "string", "long"] + ["string"] * len(clash)
    schema = ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))
    return spark.createDataFrame(data, schema).toDF(*names, *clash)


def syllables(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "ko", "li", "mu", "ne", "pra", "sto", "ti"]) for _ in range(r.randint(1, 4))) for _ in range(words))
