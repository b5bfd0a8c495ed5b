"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the documents of the next one. All but
the last return the columns of the documents; tables that a stage needs
besides are read from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.llm import decontamination, parity_join, quality_gam, secret_ledger, source_mix
from pulselake.llm.common import fresh, prepare, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    prepare(spark)
    name = fresh(docs, "quality_score")
    scored = quality_gam.with_score(docs, table(spark, sf_dir, "labels"), name)
    return scored.where(F.col(name) >= quality_gam.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that with the smallest id."""
    prepare(spark)
    return parity_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    prepare(spark)
    name = fresh(docs, "leak")
    found = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"), name=name)
    return found.where(F.col(name)["n_hit"] == 0).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in a text replaced by its kind in brackets.

    Where a text changes, its number of characters, if known, changes too.
    """
    prepare(spark)
    # The ledger's own columns must not hide columns of the documents.
    renamed = {c: fresh(docs, f"own_{c}") for c in docs.columns if c.lower() in ("blob", "spans")}
    found, _ = secret_ledger.scan_versions(docs.withColumnsRenamed(renamed))
    changed, name = F.size("spans") > 0, fresh(found, "masked")
    found = found.withColumn(name, secret_ledger.masked(F.col("text"), F.col("spans")))
    text = F.col(name)
    columns = []
    for c in docs.columns:
        value = F.col(renamed.get(c, c))
        if c == "text":
            value = text
        elif c == "n_chars":
            value = F.when(changed & value.isNotNull(), F.char_length(text).cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return found.select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, and its source's target."""
    prepare(spark)
    return source_mix.mix(docs)[0]


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
]

# The quality model, its scores and the draws of the mix are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of the folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
