"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, component_id long, "
    "copy string, shard int, n_tokens string, sketch binary, cid long, word string, n long"
)
BASE = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood where nobody lives"
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(40_000))
ROWS = [
    (1, BASE, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, "  \n\t ", "fr", "b"),
    (5, BASE + " indeed", "en", "a"),
    (5, BASE + " indeed", "en", "a"),
    (6, BASE.upper(), "en", "a"),
    (7, LONG, "de", "c"),
    (8, LONG + " tail", "de", "c"),
    (9, "only three words", "en", None),
    (10, "only three words", "en", "a"),
    (11, "x" * 5_000, None, "b"),
    (12, "ça va très bien — merci 漢字 😀 <|endoftext|> <s>", "fr", "b"),
    (None, "a row without an id", "en", "a"),
    (None, None, None, None),
]


def documents(spark, rows=ROWS):
    filled = [(i, t, lang, source, 7, 99, "x", 1, "y", b"z", 5, "w", 3) for i, t, lang, source in rows]
    return spark.createDataFrame(filled, SCHEMA)


def listed(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=lambda r: tuple((x is not None, x) for x in r))
