"""Small tables with every odd case, and the library's own tables."""

from __future__ import annotations

import random

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " ids string, spans string, licenses string, score string, node string, n string, shared string, found string"
)


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, *rows):
    """Rows of (doc_id, text) or (doc_id, text, lang, source); the other columns clash with names used within."""
    full = [(*r, *(None, None)[len(r) - 2 :])[:4] if len(r) < 4 else r for r in rows]
    return spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * 8) for r in full], SCHEMA)


LONG = prose(99, 30_000)
ODD = [(None, "no id here"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, LONG), (5, LONG), (6, "one"), (None, None)]
