"""Gate decisions as rows: what was checked, what was seen, and whether to stop.

Columns: ``gate, check_kind, column_name, passed, severity, observed, threshold``, where
severity is OK, WARN (go on) or STOP. Acting on a STOP is up to the caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.operators.score import ScorerConfig
from truegrain.session import known_rows
from truegrain.sources.contract import Contract

GATE_SCHEMA = (
    "gate string, check_kind string, column_name string, passed boolean, severity string, "
    "observed double, threshold double"
)


def facts_row(spark: SparkSession, facts: Mapping[str, int]) -> DataFrame:
    """Counts that are already known, as one local row: plain expressions of it are worked out without a job."""
    return known_rows(spark, [tuple(facts.values())], ", ".join(f"`{name}` long" for name in facts))


def _rows(source: DataFrame, gate: str, severity: Column) -> DataFrame:
    return source.select(
        F.lit(gate).alias("gate"),
        "check_kind",
        "column_name",
        "passed",
        severity.alias("severity"),
        "observed",
        "threshold",
    )


def expectation_gate(results: DataFrame, gate: str) -> DataFrame:
    """Schema and type failures stop; nulls only warn."""
    failed = F.when(F.col("check_kind") == "null", "WARN").otherwise("STOP")
    return _rows(results, gate, F.when(F.col("passed"), "OK").otherwise(failed))


def malformed_gate(counted: DataFrame, limit: float, gate: str) -> DataFrame:
    """Lines of a raw file that don't have one cell per column (``total_lines, malformed_lines``): any warn, too large a share stops."""
    share = F.coalesce(F.try_divide(F.col("malformed_lines"), F.col("total_lines")), F.lit(0.0))
    line = counted.select(
        F.lit("malformed_lines").alias("check_kind"),
        F.lit("").alias("column_name"),
        (F.col("malformed_lines") == 0).alias("passed"),
        F.col("malformed_lines").cast("double").alias("observed"),
        F.lit(float(limit)).alias("threshold"),
        share.alias("share"),
    )
    return _rows(line, gate, F.when(F.col("passed"), "OK").when(F.col("share") <= F.lit(float(limit)), "WARN").otherwise("STOP"))


def quarantine_gate(rate: DataFrame, gate: str) -> DataFrame:
    """Too large a share of quarantined rows stops."""
    line = rate.select(
        F.lit("quarantine_rate").alias("check_kind"),
        F.lit("").alias("column_name"),
        "passed",
        F.col("quarantine_rate").alias("observed"),
        F.col("quarantine_rate_threshold").alias("threshold"),
    )
    return _rows(line, gate, F.when(F.col("passed"), "OK").otherwise("STOP"))


def score_gate(card: DataFrame, config: ScorerConfig, gate: str) -> DataFrame:
    """PASS and WARN go on, FAIL stops."""
    line = card.select(
        F.lit("score").alias("check_kind"),
        F.lit("").alias("column_name"),
        (F.col("status") != "FAIL").alias("passed"),
        F.col("total_score").alias("observed"),
        F.lit(config.warn_threshold * 100).alias("threshold"),
        "status",
    )
    words = F.when(F.col("status") == "PASS", "OK").when(F.col("status") == "WARN", "WARN")
    return _rows(line, gate, words.otherwise("STOP"))


def history_gate(spark: SparkSession, gate: str, appended: int, due: int = 1) -> DataFrame:
    """How many of the runs that were added the history holds, read back; fewer than were due warn, as the data itself is loaded."""
    passed = appended == due
    row = (gate, "history", "", passed, "OK" if passed else "WARN", float(appended), float(due))
    return known_rows(spark, [row], GATE_SCHEMA)


def contract_gate(spark: SparkSession, contract: Contract, gate: str = "contract") -> DataFrame:
    """A declared breaking change warns; without one there is no row."""
    notice = contract.breaking_change_notice()
    name = f"{contract.previous_version} -> {contract.version}"
    rows = [(gate, "breaking_change", name, False, "WARN", None, None)] if notice else []
    return known_rows(spark, rows, GATE_SCHEMA)


def transform_gate(counts: DataFrame, gate: str = "transform") -> DataFrame:
    """Rows in, rows out and duplicates removed by the transform, as rows that never stop."""
    kinds = ("input_records", "output_records", "duplicates_removed")
    lines = F.inline(F.array(*(F.struct(F.lit(k).alias("check_kind"), F.col(k).alias("n")) for k in kinds)))
    rows = counts.select(lines).select(
        "check_kind",
        F.lit("").alias("column_name"),
        F.lit(True).alias("passed"),
        F.col("n").cast("double").alias("observed"),
        F.lit(None).cast("double").alias("threshold"),
    )
    return _rows(rows, gate, F.lit("OK"))


def load_gate(loaded: DataFrame, gate: str = "gold") -> DataFrame:
    """A gold table with another number of rows than silver stops."""
    line = loaded.select(
        F.lit("records_loaded").alias("check_kind"),
        F.lit("").alias("column_name"),
        "passed",
        F.col("records_loaded").cast("double").alias("observed"),
        F.col("records_due").cast("double").alias("threshold"),
    )
    return _rows(line, gate, F.when(F.col("passed"), "OK").otherwise("STOP"))
