"""The orders flow: bronze file, gates, silver, gold, score history.

Each layer is written once and the next one starts from what was written. Only gate
rows come back to the driver, to decide whether to go on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from truegrain.functions import cells
from truegrain.operators import anomaly, expect, gates, score, transform
from truegrain.plans import settings
from truegrain.session import known_rows, remove_path
from truegrain.sources import files, landing, sinks
from truegrain.sources.contract import Contract


def orders_gates(
    spark: SparkSession,
    bronze: DataFrame,
    flagged: DataFrame,
    card: DataFrame,
    silver: SilverWrite,
    contract: Contract = settings.ORDERS_CONTRACT,
) -> DataFrame:
    """The contract's notice, gates 1 to 4 and the transform's counts as one lazy frame.

    ``flagged`` is bronze after outlier detection and ``card`` the clean rows' scorecard, both written tables.
    """
    return (
        gates.contract_gate(spark, contract)
        .unionByName(gates.expectation_gate(_expectations(bronze), "gate_1"))
        .unionByName(_quarantine_gate(flagged))
        .unionByName(gates.score_gate(card, settings.ORDERS_CONFIG, "gate_3"))
        .unionByName(silver.transform_rows)
        .unionByName(silver.gate_rows)
    )


def _agreed() -> tuple[list[str], dict[str, str], list[str]]:
    """Required columns, column types and non-nullable columns of an order."""
    contract = settings.ORDERS_CONTRACT
    return contract.required_columns(), settings.ORDERS_TYPES, contract.non_nullable_columns()


def _expectations(df: DataFrame) -> DataFrame:
    return expect.expectations(df, *_agreed())


def _quarantine_gate(flagged: DataFrame) -> DataFrame:
    rate = anomaly.quarantine_rate(flagged, settings.ORDERS_QUARANTINE_LIMIT)
    return gates.quarantine_gate(rate, "gate_2")


@dataclass(frozen=True)
class SilverWrite:
    """Where silver went, and the rows of the transform's gate and of gate 4, counted while it was written."""

    path: str
    transform_rows: DataFrame
    gate_rows: DataFrame


def write_silver(clean: DataFrame, path: str) -> SilverWrite:
    """Clean, normalize, deduplicate and write; rows in, rows out and their expectations are counted on the way."""
    spark = clean.sparkSession
    going_in, coming_out = Observation(), Observation()
    silver = orders_silver(clean.observe(going_in, F.count("*").alias("input_records")))
    plan = expect.expectation_plan(silver, *_agreed())
    sinks.write_parquet(silver.observe(coming_out, *plan.counts), path)
    before, after = going_in.get["input_records"], coming_out.get["total_records"]
    counts = gates.facts_row(spark, {"input_records": before, "output_records": after, "duplicates_removed": before - after})
    facts = gates.facts_row(spark, coming_out.get)
    return SilverWrite(path, gates.transform_gate(counts), gates.expectation_gate(plan.rows(facts), "gate_4"))


MALFORMED = "__malformed"


def malformed_counts() -> list[Column]:
    """All lines and malformed ones, for counting along with another pass over a read with :data:`MALFORMED`."""
    return [F.count("*").alias("total_lines"), F.count(MALFORMED).alias("malformed_lines")]


def malformed_lines(read: DataFrame) -> DataFrame:
    """The quarantined lines as they stand, with their first cell and the number of cells that were due."""
    first, due = cells.column(read.columns[0]), len(read.columns) - 1
    line = F.col(MALFORMED)
    return read.where(line.isNotNull()).select(line.alias("line"), first.alias("first_cell"), F.lit(due).alias("cells_due"))


def orders_silver(clean: DataFrame) -> DataFrame:
    """Clean rows as silver holds them: without the anomaly flag, one row per order."""
    keys = settings.ORDERS_CONTRACT.uniqueness_columns
    return transform.to_silver(clean.drop("is_anomaly"), keys, settings.ORDERS_DATES)


@dataclass(frozen=True)
class MedallionRun:
    """Where a run left its layers, its gate rows, and whether it got to the end."""

    bronze: str
    flagged: str | None
    silver: str | None
    gold: str | None
    history: str | None
    gate_rows: DataFrame
    completed: bool
    malformed: str | None = None

    def clear_layers(self, spark: SparkSession, keep: Sequence[str] = ("silver", "gold", "history")) -> None:
        """Remove the layers of this run that are not to be kept."""
        for name in ("bronze", "flagged", "silver", "gold", "history"):
            path = getattr(self, name)
            if path and name not in keep:
                remove_path(spark, path)


def run_orders(
    spark: SparkSession,
    source: str,
    target: str,
    as_of: datetime,
    history: str | None = None,
    gold_table: str | None = None,
    multi_line: bool = False,
) -> MedallionRun:
    """Run the flow from a raw CSV at ``source`` into folders below ``target``.

    ``multi_line`` reads quoted line breaks as part of a cell. Stops after the first gate with a STOP row. The flagged table keeps the quarantined
    rows and why they were flagged. Lines with too few or too many cells go to a table of their own, if there are any.
    """
    contract = settings.ORDERS_CONTRACT
    config = settings.ORDERS_CONFIG
    bronze = f"{target}/bronze"
    landing.land(spark, source, bronze, multi_line)
    decided: list[Row] = []

    def settle(rows: DataFrame) -> bool:
        """Keep a gate's few rows and say whether the run may go on."""
        kept = rows.collect()
        decided.extend(kept)
        return all(row["severity"] != "STOP" for row in kept)

    def ended(**layers: str | None) -> MedallionRun:
        paths = {"flagged": None, "silver": None, "gold": None, "history": None, "malformed": None, **layers}
        rows = known_rows(spark, decided, gates.GATE_SCHEMA)
        return MedallionRun(bronze=bronze, gate_rows=rows, completed=paths["history"] is not None, **paths)

    settle(gates.contract_gate(spark, contract))

    # Gate 1 counts the raw texts while they are turned into a typed table: the file is parsed once.
    read = landing.read_landed(spark, bronze, multi_line, MALFORMED)
    lines, seen = Observation(), Observation()
    counted = read.observe(lines, *malformed_counts())
    raw = files.null_tokens(counted.where(F.col(MALFORMED).isNull()).drop(MALFORMED))
    plan = expect.expectation_plan(raw, *_agreed(), raw_text=True)
    typed_rows = files.typed(raw.observe(seen, *plan.counts), contract.struct_type())
    typed = sinks.layer(typed_rows, f"{target}/typed")
    broken = None
    if lines.get["malformed_lines"]:
        broken = sinks.write_parquet(malformed_lines(read), f"{target}/malformed")
    fit = settle(gates.malformed_gate(gates.facts_row(spark, lines.get), settings.ORDERS_MALFORMED_LIMIT, "gate_1"))
    facts = gates.facts_row(spark, seen.get)
    if not settle(gates.expectation_gate(plan.rows(facts), "gate_1")) or not fit:
        return ended(malformed=broken)

    seen = Observation()
    found = anomaly.detect(typed, settings.ORDERS_ANOMALY_COLUMNS).observe(seen, *anomaly.rate_counts())
    staged = f"{target}/flagged"
    clean, _ = anomaly.quarantine(sinks.layer(found, staged))
    rate = anomaly.rate_of(gates.facts_row(spark, seen.get), settings.ORDERS_QUARANTINE_LIMIT)
    if not settle(gates.quarantine_gate(rate, "gate_2")):
        return ended(malformed=broken, flagged=staged)

    card = score.scorecard(clean, settings.ORDERS_SPEC, config, as_of)
    card = spark.createDataFrame(card.toArrow(), card.schema)  # one row, used for gate and history
    if not settle(gates.score_gate(card, config, "gate_3")):
        return ended(malformed=broken, flagged=staged)

    silver = write_silver(clean, f"{target}/silver")
    settle(silver.transform_rows)
    if not settle(silver.gate_rows):
        return ended(malformed=broken, flagged=staged, silver=silver.path)

    gold = f"{target}/gold"
    if not settle(gates.load_gate(sinks.load_gold(spark, silver.path, gold, gold_table))):
        return ended(malformed=broken, flagged=staged, silver=silver.path)
    scores = sinks.append_scores(card, history or f"{target}/score_history")
    settle(gates.history_gate(spark, "gate_5", sinks.history_runs(spark, scores, card)))
    return ended(malformed=broken, flagged=staged, silver=silver.path, gold=gold, history=scores)
