"""Age of tables against their SLA, severities, and where alerts go."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.functions import cells
from truegrain.operators import measures
from truegrain.session import known_rows


@dataclass(frozen=True)
class FreshnessSLA:
    table_name: str
    sla_hours: float
    warning_multiplier: float = 1.0
    critical_multiplier: float = 2.0


SLA_SCHEMA = "table_name string, sla_hours double, warning_multiplier double, critical_multiplier double"

# Alert channels by severity.
CHANNELS = {
    "OK": ("log",),
    "WARNING": ("chat",),
    "CRITICAL": ("chat", "page"),
}


def sla_frame(spark: SparkSession, slas: Sequence[FreshnessSLA]) -> DataFrame:
    rows = [
        (s.table_name, float(s.sla_hours), float(s.warning_multiplier), float(s.critical_multiplier))
        for s in slas
    ]
    return known_rows(spark, rows, SLA_SCHEMA)


def latest_by(df: DataFrame, timestamp: str, table: str) -> DataFrame:
    """``table_name, latest_timestamp`` for each value of a column."""
    dtype = df.schema[timestamp].dataType
    newest = df.groupBy(cells.column(table).alias("table_name")).agg(
        cells.latest(timestamp, dtype).alias("newest")
    )
    return newest.select("table_name", cells.latest_instant("newest", dtype).alias("latest_timestamp"))


def latest_of(df: DataFrame, timestamp: str, table_name: str) -> DataFrame:
    """``table_name, latest_timestamp`` of a whole table, null if it is empty."""
    dtype = df.schema[timestamp].dataType
    newest = df.agg(cells.latest(timestamp, dtype).alias("newest"))
    return newest.select(
        F.lit(table_name).alias("table_name"),
        cells.latest_instant("newest", dtype).alias("latest_timestamp"),
    )


def check(latest: DataFrame, sla: DataFrame, as_of: datetime) -> DataFrame:
    """Every table with an SLA, by age; one without data is CRITICAL and infinitely old."""
    joined = sla.join(latest, "table_name", "left")
    age = F.coalesce(measures.age_hours(F.col("latest_timestamp"), as_of), F.lit(float("inf")))
    severity = (
        F.when(F.col("latest_timestamp").isNull(), "CRITICAL")
        .when(F.col("age") >= F.col("sla_hours") * F.col("critical_multiplier"), "CRITICAL")
        .when(F.col("age") >= F.col("sla_hours") * F.col("warning_multiplier"), "WARNING")
        .otherwise("OK")
    )
    message = F.when(
        F.col("latest_timestamp").isNull(),
        F.format_string("%s: no data found — CRITICAL", "table_name"),
    ).otherwise(
        F.format_string(
            "%s: %.1fh old, SLA %sh — %s",
            F.col("table_name"),
            F.col("age"),
            F.col("sla_hours").cast("string"),
            F.col("severity"),
        )
    )
    rounded = F.when(F.col("latest_timestamp").isNull(), F.col("age")).otherwise(F.round("age", 2))
    return joined.withColumn("age", age).withColumn("severity", severity).select(
        "table_name",
        measures.as_of_column(as_of).alias("checked_at"),
        "latest_timestamp",
        rounded.alias("age_hours"),
        "sla_hours",
        "severity",
        (F.col("severity") != "OK").alias("is_breached"),
        message.alias("message"),
    )


def alert_routes(results: DataFrame) -> DataFrame:
    """One row per table and channel to notify."""
    channels = F.lit(None).cast("array<string>")
    for severity, names in CHANNELS.items():
        listed = F.array(*(F.lit(n) for n in names))
        channels = F.when(F.col("severity") == severity, listed).otherwise(channels)
    return results.select(
        "table_name", "severity", F.explode(channels).alias("channel"), "message"
    )
