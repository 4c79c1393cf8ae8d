"""The lazy medallion plan: raw trips and zones in, every model out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame

from tripmill.operators import facts, marts, silver, staging


class Warehouse:
    """Models as DataFrames over given raw frames; nothing runs until one is used.

    ``facts_by_load`` are the accepted events of each month's own build, which is
    what that month's marts are made of. ``fact_trips`` is the table after all
    months were loaded in order, so a trip is there once, under its last month.
    """

    def __init__(self, trips: DataFrame, zones: Callable[[], DataFrame], dataset_month: str | Column):
        self.trips, self.zones, self.dataset_month = trips, zones, dataset_month

    @cached_property
    def stg_trips(self) -> DataFrame:
        return staging.stg_trips(self.trips, self.dataset_month)

    @cached_property
    def stg_zones(self) -> DataFrame:
        return staging.stg_zones(self.zones())

    @cached_property
    def dim_zone(self) -> DataFrame:
        return staging.dim_zone(self.stg_zones)

    @cached_property
    def silver_trip_events(self) -> DataFrame:
        return silver.silver_trip_events(self.stg_trips)

    @cached_property
    def silver_quarantine(self) -> DataFrame:
        return silver.silver_quarantine(self.silver_trip_events)

    @cached_property
    def facts_by_load(self) -> DataFrame:
        return silver.accepted(self.silver_trip_events)

    @cached_property
    def fact_trips(self) -> DataFrame:
        return facts.latest_load_wins(self.facts_by_load)

    @property
    def silver_trips(self) -> DataFrame:
        return self.fact_trips

    @cached_property
    def guarded(self) -> DataFrame:
        return marts.guarded(self.facts_by_load)

    @cached_property
    def mart_daily_demand(self) -> DataFrame:
        return marts.mart_daily_demand(self.guarded)

    @cached_property
    def mart_zone_performance(self) -> DataFrame:
        return marts.mart_zone_performance(self.guarded, self.dim_zone)

    @cached_property
    def mart_hourly_pattern(self) -> DataFrame:
        return marts.mart_hourly_pattern(self.guarded)

    def models(self, *names: str) -> Mapping[str, DataFrame]:
        return {name: getattr(self, name) for name in names}
