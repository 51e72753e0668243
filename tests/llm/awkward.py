"""Rows that every operator must take: nulls, empty and very long texts, ties, repeats, clashing extra columns."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `q` int, `row` string, `size` double, `sha` string, `key` long, `h` string, `u` int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


def rows():
    plain = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (2, "the quick  brown fox\njumps over the lazy dog again and again", "en", "a"),
        (2, "another text under an id that is taken", "en", "b"),
        (3, "", "en", "b"), (4, None, None, None), (5, " \t\n ", "de", "c"),
        (6, LONG, "en", "a"), (7, LONG, "en", "b"), (8, "one", "fr", "a"), (8, "one", "fr", "a"),
        (None, "a row without an id", "en", "a"), (None, None, None, None), (None, "one", None, "b"),
        (9, "ÄÖ ß 日本語 😀 ſecret Kelvin é", "ja", "é"), (10, "x" * 5000, "en", "😀"), (11, "\x00 nul", "en", "a"),
        (-3, "▁ mark ▁▁ and <s> </s> <unk> <0x41>", "en", "a"), (2 ** 62, "a\r\nb\x0bc\x0cd e", "en", "c"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), 1, "row", 0.5, "sha", 7, "h", 3) for r in plain]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
