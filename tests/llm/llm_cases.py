"""Small texts with everything that is unusual, and brute-force definitions."""

import re

LONG = " ".join(f"word{i % 977} of {i}" for i in range(12_000))

TEXTS = [
    (1, "One two three four five six. One two three four five six seven."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, "single"),
    (6, "two words"),
    (7, "One two three four five six. One two three four five six seven."),
    (7, "One two three four five six. One two three four five six seven."),
    (8, LONG),
    (9, LONG + " end"),
    (None, "no id at all here"),
    (None, None),
    (10, "ÄÖÜ ß éclair — 漢字 😀 naïve space 漢字 😀 naïve space 漢字"),
    (11, "#*$ %&| <> a\nsame line\nsame line\n\n\nsame line"),
    (12, "a a a a a a a a"),
]

SCHEMA = "doc_id long, text string, words string, w array<string>, _t int, kept boolean, n_words int, fp string, h string, id string"


def docs(spark, rows=TEXTS):
    """Documents with more columns whose names clash with those used inside."""
    full = [(i, t, "x", ["y"], 7, False, -1, "fp", "h", "id") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def key_order(row):
    return tuple((x is not None, str(x)) for x in row)
