"""Small tables with odd rows, shared by the tests of the training-data operators."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq

DATA = Path("/root/testdata/sf0.001")


def rows_of(name: str, folder: Path = DATA) -> list[dict]:
    return pq.read_table(folder / f"{name}.parquet").to_pylist()


LONG = " ".join(f"Word{i % 977} number{i * 7919 % 1009}," for i in range(6000))


def odd_documents(spark, extra: list[tuple] = ()):
    """NULL ids, texts and sources, empty and long texts, repeated rows, clashing columns."""
    rows = [
        (1, "Alpha beta GAMMA delta epsilon zeta eta theta", "en", "a", 1),
        (1, "Alpha beta GAMMA delta epsilon zeta eta theta", "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \t\n\r\x0b\x0c ", "en", "b", 3),
        (None, "Alpha beta gamma delta epsilon zeta eta theta", None, None, 9),
        (None, None, None, None, None),
        (5, LONG, "en", "b", len(LONG)),
        (6, "Ünïcode ÄÖ 😀 emoji word \x00 <s> </s> ▁x", "de", "c", 5),
        (7, "one", "en", "c", 3),
        *extra,
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, words string, blob int, leak int, size string"
    return spark.createDataFrame([(*r, "w", 1, 2, "s") for r in rows], schema)


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def key(value):
    return repr(value)
