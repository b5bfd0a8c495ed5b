"""Shaping of ingest requests into raw bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions import codes
from pulselake.functions.scalars import field, stable_uuid
from pulselake.sources.ndjson import parse_ndjson


def strip_headers(headers: Column) -> Column:
    """Header map without secrets; names are compared in lower case."""
    return F.map_filter(headers, lambda name, _: ~F.lower(name).isin(codes.SECRET_HEADERS))


def normalize_record_type(df: DataFrame, source: str = "record_type") -> DataFrame:
    """Lower-case trimmed record type. Empty ones are left out, unknown ones only flagged."""
    kind = F.nullif(F.regexp_replace(F.lower(F.col(source)), r"^\s+|\s+$", ""), F.lit(""))
    return (
        df.withColumn("record_type", kind)
        .where(F.col("record_type").isNotNull())
        .withColumn("known_type", F.col("record_type").isin(codes.RECORD_TYPES))
    )


def source_platform(headers: Column) -> Column:
    """Platform from the request headers, ``unknown`` if missing or empty."""
    return F.coalesce(F.nullif(F.lower(F.element_at(headers, "x-platform")), F.lit("")), F.lit("unknown"))


def resolve_user(jwt_sub: Column, forwarded_email: Column) -> Column:
    """Token subject, else forwarded e-mail, else ``anonymous``; empty counts as missing."""
    return F.coalesce(
        F.nullif(jwt_sub, F.lit("")), F.nullif(forwarded_email, F.lit("")), F.lit("anonymous")
    )


def build_bronze(requests: DataFrame, max_lines: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Requests -> (bronze rows, errors).

    A request has ``request_id``, ``received_at``, ``headers`` (lower-case
    names), ``jwt_sub`` and ``body`` (NDJSON text). Record ids follow from the
    request id and the line number, so a retried task gives the same ids.
    """
    typed = normalize_record_type(
        requests.withColumn("record_type", F.element_at("headers", "x-record-type"))
    )
    # What belongs to the request is worked out once, before its lines are split.
    shaped = typed.select(
        "request_id",
        "received_at",
        "record_type",
        "body",
        F.parse_json(F.to_json(strip_headers(F.col("headers")))).alias("headers"),
        source_platform(F.col("headers")).alias("source_platform"),
        resolve_user(F.col("jwt_sub"), F.element_at("headers", "x-forwarded-email")).alias("user_id"),
    )
    records, errors = parse_ndjson(shaped, "body", max_lines)
    bronze = records.select(
        stable_uuid(F.col("request_id"), F.col("line_no")).alias("record_id"),
        F.col("received_at").alias("ingested_at"),
        F.col("record").alias("body"),
        "headers",
        "record_type",
        "source_platform",
        "user_id",
    )
    return bronze, errors.select("request_id", "record_type", "error")


def platform_of(df: DataFrame) -> DataFrame:
    """Fill ``source_platform`` from the stored headers, in either spelling."""
    return df.withColumn(
        "source_platform",
        F.coalesce(
            "source_platform",
            F.try_variant_get("headers", "$['X-Platform']", "string"),
            F.try_variant_get("headers", "$['x-platform']", "string"),
        ),
    )


def null_user(df: DataFrame, mode: str = "fill") -> DataFrame:
    """Rows without a user: ``fill`` with ``unknown`` or ``drop``."""
    if mode == "fill":
        return df.withColumn("user_id", F.coalesce("user_id", F.lit("unknown")))
    if mode == "drop":
        return df.where(F.col("user_id").isNotNull())
    raise ValueError(f"unknown mode {mode!r}")


def route(df: DataFrame, record_type: str) -> DataFrame:
    """Rows of one record type."""
    return df.where(F.col("record_type") == record_type)
