"""Documents with every awkward value at once."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, words string, fingerprint string, n string, `class` string, node long, "
    "component string, kept string, id long, template string, path string, held_out string"
)
LONG = "lorem ipsum dolor sit amet " * 4000


def rows():
    texts = [
        (1, "the quick brown fox jumps over the lazy dog near the river bank today and rests"),
        (2, "the quick brown fox jumps over the lazy dog near the river bank today and rests"),
        (2, "the quick brown fox jumps over the lazy dog near the river bank today and rests"),
        (3, ""),
        (4, None),
        (5, "   \t\n "),
        (6, LONG),
        (7, "12345 --- 678"),
        (None, "a row without an id but with a text of its own"),
        (8, "é́ \U0001f600 中文 ​ x"),
    ]
    return [
        (i, t, None, None, None if t is None else len(t), 0.5, "w", "f", "n", "c", 9, "q", "k", 3)
        + ("t", "p", "h")
        for i, t in texts
    ]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
