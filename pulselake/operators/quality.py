"""Quality rules, key checks and the ingest validation report."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions import codes
from pulselake.operators.skew import anti_join, union_all
from pulselake.sources.contracts import get_expectations_drop, get_expectations_warn, primary_key


def holds(rule: str) -> Column:
    """True if a rule holds; a NULL outcome is a violation."""
    return F.coalesce(F.expr(rule), F.lit(False))


def expect_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows for which every rule holds."""
    return reduce(lambda d, rule: d.where(holds(rule)), rules.values(), df)


def expect(df: DataFrame, rules: dict[str, str], name: str) -> DataFrame:
    """The same rows; violations per rule are counted while the rows pass by.

    The counts come back through an Observation in batch and through the
    query progress in a stream, under ``name``.
    """
    counts = [F.count_if(~holds(rule)).alias(rule_name) for rule_name, rule in rules.items()]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *counts)


def apply_contract(df: DataFrame, cfg: dict[str, Any], as_of: str | None = None, observe: bool = False) -> DataFrame:
    """Drop rules applied; with ``observe`` all rules are counted on the way."""
    drop = get_expectations_drop(cfg, as_of)
    if observe:
        df = expect(df, {**drop, **get_expectations_warn(cfg, as_of)}, cfg["table"]["name"])
    return expect_or_drop(df, drop)


def expectation_report(df: DataFrame, cfg: dict[str, Any], as_of: str | None = None) -> DataFrame:
    """One row per rule: table, action, rule, rows seen and rows in violation.

    All rules are counted in one pass and unpivoted afterwards.
    """
    rules = [("drop", n, r) for n, r in get_expectations_drop(cfg, as_of).items()]
    rules += [("warn", n, r) for n, r in get_expectations_warn(cfg, as_of).items()]
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(~holds(rule)).alias(f"r{i}") for i, (_, _, rule) in enumerate(rules)],
    )
    per_rule = F.array(
        *[
            F.struct(F.lit(action).alias("action"), F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, (action, name, _) in enumerate(rules)
        ]
    )
    return counted.select(
        F.lit(cfg["table"]["name"]).alias("table_name"), "total_rows", F.explode(per_rule).alias("x")
    ).select("table_name", "x.action", "x.rule", "total_rows", "x.violations")


def duplicate_keys(df: DataFrame, cfg: dict[str, Any]) -> DataFrame:
    """Primary key values that occur more than once."""
    keys = primary_key(cfg)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def orphan_rows(
    df: DataFrame, foreign_key: dict[str, Any], referenced: DataFrame
) -> DataFrame:
    """Rows whose single-column foreign key has no partner; NULL keys are no violation."""
    column = foreign_key["columns"][0]
    return anti_join(
        df.where(F.col(column).isNotNull()), referenced, column, foreign_key["references"]["columns"][0]
    )


def check_keys(tables: dict[str, tuple[DataFrame, dict[str, Any]]], referenced: dict[str, DataFrame]) -> DataFrame:
    """Violations per declared key: duplicate values of primary keys, rows without partner of foreign keys."""
    reports = []
    for name, (df, cfg) in tables.items():
        if primary_key(cfg):
            reports.append(_count_as(duplicate_keys(df, cfg), name, cfg["constraints"]["primary_key"]["name"], "primary"))
        for fk in cfg["constraints"].get("foreign_keys") or []:
            target = referenced[fk["references"]["table"]]
            reports.append(_count_as(orphan_rows(df, fk, target), name, fk["name"], "foreign"))
    return union_all(reports)


def _count_as(df: DataFrame, table: str, constraint: str, kind: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit(constraint).alias("constraint_name"),
        F.lit(kind).alias("kind"),
        "violations",
    )


# Keys every sample payload must carry.
SAMPLE_KEYS = ["uuid", "type", "value", "unit", "start_date", "end_date", "source_name"]


def validate_ingest(bronze: DataFrame, ids: DataFrame, platform: str, user: str) -> DataFrame:
    """End-to-end report over the rows of a list of record ids, one row per check.

    ``ids`` has one column ``record_id``. All checks but the first are one
    grouped pass over the matched rows.
    """
    wanted = ids.select("record_id").distinct()
    matched = bronze.join(wanted, "record_id", "left_semi")
    header_names = F.map_keys(F.try_variant_get("headers", "$", "map<string,string>"))
    body_keys = F.map_keys(F.try_variant_get("body", "$", "map<string,variant>"))
    complete = F.size(F.array_except(F.array(*[F.lit(k) for k in SAMPLE_KEYS]), body_keys)) == 0
    secret = F.arrays_overlap(header_names, F.array(*[F.lit(h) for h in codes.SECRET_HEADERS]))
    facts = matched.agg(
        F.count_if(~F.coalesce(F.col("source_platform") == platform, F.lit(False))).alias("single_platform"),
        F.count_if(F.coalesce(secret, F.lit(False))).alias("no_secret_headers"),
        F.count_if((F.col("record_type") == "samples") & ~F.coalesce(complete, F.lit(False))).alias("sample_keys"),
        *[F.max((F.col("record_type") == t).cast("int")).alias(f"has_{t}") for t in codes.RECORD_TYPES],
        F.count_if(~F.coalesce(F.col("user_id") == user, F.lit(False))).alias("single_user"),
    )
    present = [F.coalesce(F.col(f"has_{t}"), F.lit(0)) for t in codes.RECORD_TYPES]
    facts = facts.withColumn("all_types", len(codes.RECORD_TYPES) - reduce(lambda a, b: a + b, present))
    checks = ["single_platform", "no_secret_headers", "sample_keys", "all_types", "single_user"]
    rows = facts.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).cast("long").alias("violations")) for c in checks])
        ).alias("x")
    ).select("x.*")
    missing = wanted.join(bronze.select("record_id"), "record_id", "left_anti").agg(
        F.lit("all_ids_present").alias("check_name"), F.count(F.lit(1)).alias("violations")
    )
    return missing.unionByName(rows).withColumn("passed", F.col("violations") == 0)
