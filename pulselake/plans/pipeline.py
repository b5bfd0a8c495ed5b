"""The whole table graph as plain DataFrames: typed -> feeds -> silver -> gold."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from pulselake.operators import cdc, gold, quality, typed
from pulselake.sources.contracts import load_table_config


class HealthGraph:
    """Every table of the pipeline, built on demand from raw bronze.

    ``bronze_of`` returns the raw rows of one record type, batch or stream. Batch
    graphs offer all tables; a stream graph offers the typed tables, the feeds
    and the passthrough, which are all stateless.
    """

    def __init__(self, bronze_of: Callable[[str], DataFrame], as_of: str | None = None):
        self._bronze_of = bronze_of
        self._as_of = as_of

    def typed(self, table: str) -> DataFrame:
        """A typed table with the drop rules of its contract applied."""
        record_type, build = typed.TYPED_TABLES[table]
        return quality.apply_contract(build(self._bronze_of(record_type)), load_table_config(table), self._as_of)

    @cached_property
    def samples(self) -> DataFrame:
        return self.typed("bronze_typed_health_samples")

    @cached_property
    def workouts(self) -> DataFrame:
        return self.typed("bronze_typed_workouts")

    @cached_property
    def sleep_stages(self) -> DataFrame:
        return self.typed("bronze_typed_sleep_stages")

    @cached_property
    def activity_summaries(self) -> DataFrame:
        return self.typed("bronze_typed_activity_summaries")

    @cached_property
    def deletes(self) -> DataFrame:
        return self.typed("bronze_typed_deletes")

    @cached_property
    def cdc_health_samples(self) -> DataFrame:
        return cdc.cdc_health_samples(self.samples, self.deletes)

    @cached_property
    def cdc_workouts(self) -> DataFrame:
        return cdc.cdc_workouts(self.workouts, self.deletes)

    @cached_property
    def cdc_sleep_stages(self) -> DataFrame:
        return cdc.cdc_sleep_stages(self.sleep_stages, self.deletes)

    @cached_property
    def silver_health_samples(self) -> DataFrame:
        return cdc.apply_scd1(self.cdc_health_samples, ["uuid"])

    @cached_property
    def silver_workouts(self) -> DataFrame:
        return cdc.apply_scd1(self.cdc_workouts, ["uuid"])

    @cached_property
    def silver_sleep_stages(self) -> DataFrame:
        return cdc.apply_scd1(self.cdc_sleep_stages, ["stage_uuid"])

    @cached_property
    def silver_health_samples_history(self) -> DataFrame:
        return cdc.apply_scd2(self.cdc_health_samples, ["uuid"])

    @cached_property
    def silver_workouts_history(self) -> DataFrame:
        return cdc.apply_scd2(self.cdc_workouts, ["uuid"])

    @cached_property
    def silver_sleep_stages_history(self) -> DataFrame:
        return cdc.apply_scd2(self.cdc_sleep_stages, ["stage_uuid"])

    @cached_property
    def silver_activity_summaries(self) -> DataFrame:
        return cdc.passthrough(self.activity_summaries)

    @cached_property
    def gold_sleep_sessions(self) -> DataFrame:
        return gold.sleep_sessions(self.silver_sleep_stages)

    @cached_property
    def quarantine_unmatched_deletes(self) -> DataFrame:
        return gold.unmatched_deletes(self.deletes, self.samples, self.workouts, self.sleep_stages)

    @cached_property
    def delete_match_report(self) -> DataFrame:
        return gold.delete_match_report(self.deletes, self.samples, self.workouts, self.sleep_stages)
