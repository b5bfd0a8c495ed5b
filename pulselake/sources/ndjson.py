"""NDJSON request bodies -> one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def split_lines(body) -> F.Column:
    """Lines of a text that hold more than white space."""
    return F.filter(F.split(body, "\r?\n"), lambda line: line.rlike(r"\S"))


def parse_line(line) -> F.Column:
    """The JSON value of a line, NULL unless the whole line is one value.

    Spark's parser stops after the first value and ignores what follows. Inside
    brackets whatever follows is an error, but for a second element or a stray
    ``]``; the latter is told apart by a second parse of lines that have one.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    single = F.try_variant_get(wrapped, "$[1]", "variant").isNull()
    balanced = F.when(
        F.instr(line, "]") > 0, F.try_parse_json(F.concat(F.lit('{"r":'), line, F.lit("}"))).isNotNull()
    ).otherwise(True)
    return F.when(single & balanced, F.try_variant_get(wrapped, "$[0]", "variant"))


def _fits(body, max_lines: int) -> F.Column:
    return F.coalesce(F.size(split_lines(body)) <= max_lines, F.lit(True))


def parse_ndjson(df: DataFrame, body_col: str = "body", max_lines: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Split bodies into records and errors.

    Blank lines are removed before numbering. A broken line is reported and the
    good lines around it are kept. With ``max_lines`` a body of more lines is
    refused whole and reported; without it every body is taken.
    Records carry ``line_no`` and ``record``, errors carry ``error``.
    """
    keep = [c for c in df.columns if c != body_col]
    body = F.col(body_col)
    # Lines are parsed inside the array: as output of the explode a parsed line
    # is not parsed a second time by a filter on it.
    parsed = F.posexplode(F.transform(split_lines(body), parse_line)).alias("_pos", "_parsed")
    taken = df if max_lines is None else df.where(_fits(body, max_lines))
    numbered = taken.select(*keep, parsed)
    records = numbered.where(F.col("_parsed").isNotNull()).select(
        *keep, (F.col("_pos") + 1).alias("line_no"), F.col("_parsed").alias("record")
    )
    broken = numbered.where(F.col("_parsed").isNull()).select(
        *keep, F.concat(F.lit("Line "), F.col("_pos") + 1, F.lit(": invalid JSON")).alias("error")
    )
    if max_lines is None:
        return records, broken
    refused = df.where(~_fits(body, max_lines)).select(
        *keep,
        F.concat(
            F.lit("Too many NDJSON lines ("), F.size(split_lines(body)), F.lit(f"). Maximum allowed is {max_lines}.")
        ).alias("error"),
    )
    return records, broken.unionByName(refused)


def read_ndjson_files(spark, path: str) -> DataFrame:
    """Lines of NDJSON files as VARIANT, blank lines left out; broken lines are NULL."""
    text = spark.read.text(path)
    return text.where(F.col("value").rlike(r"\S")).select(parse_line(F.col("value")).alias("record"), "value")
