"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The
ledger says which (blob, rule version) pairs have been scanned and what was
found. A run scans only the pairs that the ledger lacks, once for each blob
however many paths hold it, and joins the findings back to all paths.

Everything is a DataFrame operation; there is no Python on the executors.
Spans come from the pieces that a pattern cuts a text into: the lengths of
pieces and matches, summed up, are the offsets in code points.

Results:

* one row for each input row, NULL and repeated ids included;
* NULL counts as the empty text and has no findings;
* matches of one kind never overlap; those of different kinds may;
* ties of the start are ordered by the order of the rules;
* an empty table gives an empty table and an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import stored

SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"
LEDGER = f"blob string, rule_version string, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches are consumed from left to right.

    Of the matches, those count whose part behind ``skip`` (a pattern for
    what precedes the secret itself) has at least ``least`` characters.
    """

    kind: str
    pattern: str
    least: int
    skip: str | None = None


KEYWORD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = (
    Rule("assign", KEYWORD + r"[A-Za-z0-9+/_.=-]+", 8, KEYWORD),
    # A run that is too short has no longer run within it, so the least length
    # can stand in the pattern; that keeps short runs out of the arrays.
    Rule("access", r"AKIA[A-Z0-9]{12,}", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
RULE_VERSION = "1"


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule as an array, empty where nothing matches."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.transform(F.split(text, rule.pattern, -1), lambda p: F.char_length(p).cast("long"))
    secret = (lambda m: m) if rule.skip is None else (lambda m: F.regexp_replace(m, f"^{rule.skip}", ""))
    # One entry for each match: the piece before it, its length, whether it counts.
    steps = F.zip_with(
        F.slice(pieces, 1, F.size(matches)),
        matches,
        lambda gap, m: F.struct(
            gap.alias("gap"),
            F.char_length(m).cast("long").alias("length"),
            (F.char_length(secret(m)) >= rule.least).alias("counts"),
        ),
    )
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast(SPANS).alias("found")),
        lambda state, step: F.struct(
            (state["at"] + step["gap"] + step["length"]).alias("at"),
            F.when(
                step["counts"],
                F.concat(
                    F.coalesce(state["found"], F.array().cast(SPANS)),
                    F.array(
                        F.struct(
                            (state["at"] + step["gap"]).alias("start"),
                            F.lit(rank).alias("rank"),
                            F.lit(rule.kind).alias("kind"),
                            (state["at"] + step["gap"] + step["length"]).alias("end"),
                        )
                    ).cast(SPANS),
                ),
            )
            .otherwise(state["found"])
            .alias("found"),
        ),
    )["found"]
    return F.coalesce(F.when(text.rlike(rule.pattern), walked), F.array().cast(SPANS))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, version: str = RULE_VERSION) -> DataFrame:
    """Ledger rows of blobs (``blob``, ``text``); every one is scanned."""
    found = [rule_spans(F.col("text"), rule, rank) for rank, rule in enumerate(rules)]
    return blobs.select(
        "blob",
        F.lit(version).alias("rule_version"),
        F.array_sort(reduce(lambda a, b: F.concat(a, b), found)).alias("spans"),
    )


def scan_versions(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    version: str = RULE_VERSION,
) -> tuple[DataFrame, DataFrame]:
    """Findings of every row of ``versions`` and the rows the ledger gains.

    ``versions`` needs ``text``; all its columns come back, with ``blob`` and
    ``spans``, which replace columns of these names. The second result is stored in the shared folder; append it to
    the ledger. Copies of a blob are dropped before the shuffle on the mapping
    side and after it, so a blob that holds a third of all rows costs one row
    for each task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    addressed = versions.drop("blob", "spans").withColumn("blob", F.sha2(text, 256))
    blobs = addressed.select("blob", text.alias("text"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == version).select("blob")
        blobs = blobs.join(seen, "blob", "left_anti")
    unseen = blobs.dropDuplicates(["blob"])
    gained = stored(scan_blobs(unseen, rules, version), "secret-ledger")
    known = gained.where(F.size("spans") > 0)
    if ledger is not None:
        old = ledger.where((F.col("rule_version") == version) & (F.size("spans") > 0))
        known = known.unionByName(old.select(*gained.columns))
    # Only blobs with findings take part; the others have none by definition.
    joined = addressed.join(known.select("blob", "spans"), "blob", "left")
    return joined.withColumn("spans", F.coalesce("spans", F.array().cast(SPANS))), gained


def spans_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined in the order of the spans."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans merge."""
    walked = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda state, s: F.struct(
            F.when(
                s["start"] >= state["at"],
                F.concat(
                    state["out"],
                    F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")),
                    F.concat(F.lit("["), s["kind"], F.lit("]")),
                ),
            )
            .otherwise(state["out"])
            .alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        ),
        lambda state: F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    return F.when(F.size(spans) > 0, walked).otherwise(text)
