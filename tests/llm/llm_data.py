"""Small document tables for the operators' tests."""

from __future__ import annotations

import re

#: Columns that no operator asks for, with names that operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "KEPT string, keep_id string, hash string, size string, `_c0` string, words string"
)
FILL = ("a", "b", "c", "d", "e", "f")


def documents(spark, rows):
    """Rows are (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *(None,) * (4 - len(r)), len(r[1] or ""), *FILL) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sentence(rng, n, vocabulary=2000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
