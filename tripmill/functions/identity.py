"""Deterministic trip identity."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns that make up a trip's identity, in digest order.
IDENTITY_COLUMNS = (
    "vendor_id",
    "pickup_at",
    "dropoff_at",
    "pickup_zone_id",
    "dropoff_zone_id",
    "total_amount",
)
INSTANTS = ("pickup_at", "dropoff_at")


def _instant_text(moment: str) -> str:
    return f"concat(CAST({moment} AS STRING), '+00')"


def instant_text(moment: str) -> Column:
    """``2024-02-01 01:00:00.12+00``: no trailing zeros, explicit offset."""
    return F.expr(_instant_text(moment))


def derived_id(columns: Collection[str]) -> dict[str, Column]:
    """The digest as a column to compute where it is written, if rows of these columns have one.

    It is 64 bytes that hardly compress, and a function of values that travel anyway.
    """
    return {"trip_id": trip_id()} if {"trip_id", *IDENTITY_COLUMNS} <= set(columns) else {}


def trip_id() -> Column:
    """SHA-256 over the identity columns; NULL enters as the empty string."""
    parts = ", ".join(
        f"coalesce({_instant_text(name) if name in INSTANTS else f'CAST({name} AS STRING)'}, '')"
        for name in IDENTITY_COLUMNS
    )
    return F.expr(f"sha2(concat_ws('|', {parts}), 256)")
