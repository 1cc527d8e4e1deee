"""Shipments seen from both hubs they touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import interval_days

HUB = "warehouse_id"


def hub_touches(shipments: DataFrame, columns: list[str | Column], once: bool = False) -> DataFrame:
    """Two rows per shipment, one for its origin and one for its destination hub, from one scan.

    ``once=True`` keeps a single row where both hubs are the same, so each row is a distinct
    (shipment, hub) pair.
    """
    origin = F.struct(F.col("origin_warehouse_id").alias(HUB), F.lit("Origin").alias("warehouse_role"))
    target = F.struct(
        F.col("destination_warehouse_id").alias(HUB), F.lit("Destination").alias("warehouse_role")
    )
    sides = F.array(origin, target)
    if once:
        same = F.col("origin_warehouse_id").eqNullSafe(F.col("destination_warehouse_id"))
        sides = F.when(same, F.array(origin)).otherwise(sides)
    return shipments.select(*columns, F.inline(sides))


def incident_days(incidents: DataFrame, columns: list[str | Column] | None = None) -> DataFrame:
    """One row per incident and day of its window."""
    wanted = columns or ["candidate_incident_id", HUB, "anomaly_score"]
    return interval_days(incidents, "start_date", "end_date", "report_date", wanted)


def incident_shipments(shipments: DataFrame, days: DataFrame, carry: list[str]) -> DataFrame:
    """Distinct shipments that touch an incident hub on one of the given days.

    The either-hub condition becomes one row per touched hub, and the date range one row per day,
    so the match is an equi-join on (hub, day) instead of a nested loop over ranges.
    """
    touches = hub_touches(shipments, ["shipment_id", F.col("shipment_date").alias("report_date")], once=True)
    hits = touches.drop("warehouse_role").join(days, [HUB, "report_date"])
    return hits.select("shipment_id", *carry).distinct()
