import pytest

CLASHES = (
    "words", "row", "m", "print", "at", "salt", "part", "score", "token_ids", "kept", "n_words",
    "place", "shard", "slot", "curve", "size", "text_crc32", "doc", "toxic", "word", "spans",
    "component_id", "task", "lines", "number", "copy", "bucket",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts or (doc_id, text, lang, source) rows, with extra columns if wanted."""

    def make(rows, clashing=False, partitions=3):
        full = [
            (*r, len(r[1] or "")) if isinstance(r, tuple) else (i, r, "en", "src0", len(r or ""))
            for i, r in enumerate(rows)
        ]
        frame = spark.createDataFrame(full, SCHEMA).repartition(partitions)
        if clashing:
            frame = frame.selectExpr("*", *[f"'extra' AS `{c}`" for c in CLASHES])
        return frame

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    prose = "The quick brown fox jumps over the lazy dog and runs away again. "
    return [
        (None, "text without an id, seen once", "en", "src0"),
        (None, None, None, None),
        (1, None, "en", "src0"),
        (2, "", "en", None),
        (3, " \t\n\x0b\x0c\r ", None, "src1"),
        (4, "one", "en", "src1"),
        (5, prose * 400, "en", "src1"),
        (6, "x" * 50_000, "de", "src1"),
        (7, "Über die Brücke\nlief é́ 𝔘 ein\n\n" * 9, "de", "src2"),
        (8, "same text in two rows", "en", "src2"),
        (8, "same text in two rows", "en", "src2"),
        (9, "same text in two rows", "en", "src2"),
        (-3, "\x00 control \x01 letters ﻿", "fr", "src2"),
    ]
