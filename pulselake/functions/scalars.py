"""Scalar column helpers. All of them are built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulselake.functions import codes


def field(column: str | Column, path: str, dtype: str) -> Column:
    """Typed read of one VARIANT path; a value of the wrong kind gives NULL."""
    return F.try_variant_get(F.col(column) if isinstance(column, str) else column, f"$.{path}", dtype)


def cast_or_null(value: Column, dtype: str) -> Column:
    """Cast that gives NULL on a bad value, also under ANSI mode."""
    return value.try_cast(dtype)


def number_or(value: Column, default: float = 0.0) -> Column:
    """Number in a text or number column; bad or missing values give the default."""
    return F.coalesce(value.try_cast("double"), F.lit(default))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds between two instants as minutes, kept to 6 decimals.

    Both instants are cut to seconds first. The division is a decimal one, so
    100 seconds are 1.666667 minutes.
    """
    seconds = end.cast("long") - start.cast("long")
    return (seconds / F.expr("60.0BD")).cast("double")


def round_half_up(value: Column) -> Column:
    """Rounding of numbers as JavaScript does it: halves go towards +infinity."""
    return F.floor(value + F.lit(0.5))


def lookup(code: Column, names: Mapping, fallback: Column) -> Column:
    """Value of a small fixed table, else the fallback."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), code), fallback)


def named_code(code: Column, names: Mapping[int, str]) -> Column:
    """Name of an integer code; codes outside the table become ``unknown_<code>``."""
    return lookup(code, names, F.concat(F.lit("unknown_"), code.cast("string")))


def ios_sleep_stage(code: Column) -> Column:
    return named_code(code, codes.IOS_SLEEP_STAGES)


def ios_activity(code: Column) -> Column:
    return named_code(code, codes.IOS_ACTIVITIES)


def android_sleep_stage(code: Column) -> Column:
    return named_code(code, codes.ANDROID_SLEEP_STAGES)


def android_exercise(code: Column, names: Mapping[int, str] = codes.ANDROID_EXERCISES) -> Column:
    return named_code(code, names)


def canonical_unit(sample_type: Column) -> Column:
    return lookup(sample_type, codes.QUANTITY_UNITS, F.lit("count"))


def type_label(identifier: Column) -> Column:
    """``HKQuantityTypeIdentifierHeartRate`` -> ``Heart Rate``."""
    prefixes = "|".join([codes.QUANTITY_PREFIX, codes.CATEGORY_PREFIX, codes.CORRELATION_PREFIX])
    name = F.regexp_replace(identifier, f"^(?:{prefixes})", "")
    spaced = F.regexp_replace(name, r"(?<=.)(\p{Lu})", " $1")
    return F.when(spaced == "", identifier).otherwise(spaced)


def short_user(user: Column) -> Column:
    """``pat.lee@example.org`` -> ``pat.lee@``; text without a name part stays."""
    at = F.instr(user, "@")
    return F.when(at > 1, F.substring(user, F.lit(1), at)).otherwise(user)


def pseudonym(value: Column) -> Column:
    """First 12 hex digits of the SHA-256 of an id."""
    return F.substring(F.sha2(value, 256), 1, 12)


def number_label(n: Column) -> Column:
    """``1500`` -> ``1.5K``, ``2000000`` -> ``2.0M``."""
    return (
        F.when(n >= 1_000_000, F.format_string("%.1fM", n / 1e6))
        .when(n >= 1_000, F.format_string("%.1fK", n / 1e3))
        .otherwise(n.cast("string"))
    )


def duration_label(ms: Column) -> Column:
    """``799`` -> ``799ms``, ``3400`` -> ``3.4s``, ``98000`` -> ``1m 38s``."""
    minutes = F.floor(ms / 60_000).cast("string")
    seconds = round_half_up((ms % 60_000) / 1000).cast("string")
    return (
        F.when(ms < 1_000, F.concat(ms.cast("string"), F.lit("ms")))
        .when(ms < 60_000, F.format_string("%.1fs", ms / 1e3))
        .otherwise(F.concat(minutes, F.lit("m "), seconds, F.lit("s")))
    )


def preview(text: Column, length: int = 100) -> Column:
    """First characters of a text, with dots when something was cut."""
    cut = F.concat(F.substring(text, 1, length), F.lit("..."))
    return F.when(F.length(text) > length, cut).otherwise(text)


def stable_uuid(*parts: Column) -> Column:
    """UUID-shaped id derived from the parts, equal on every retry of a task."""
    h = F.md5(F.concat_ws("\x1f", *[p.cast("string") for p in parts]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.upper(F.concat_ws("-", *[F.substring(h, start, size) for start, size in cuts]))
