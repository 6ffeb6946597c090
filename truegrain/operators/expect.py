"""Schema, type and null expectations, and the contract as check rows.

All expectations of a table are decided in one aggregate; what the schema alone
decides is filled in as literals and costs no scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.functions import cells
from truegrain.operators import measures
from truegrain.sources.contract import TYPES, Contract

RESULT_COLUMNS = ("check_kind", "column_name", "passed", "observed", "threshold")


def _line(kind: str, name: str, passed: str, observed: str, threshold: str = "0") -> str:
    """One check row as SQL over the aggregated counts, so that many rows stay one expression."""
    return (
        f"{cells.sql_text(kind)}, {cells.sql_text(name)}, {passed}, "
        f"CAST({observed} AS DOUBLE), CAST({threshold} AS DOUBLE)"
    )


def _rows(facts: DataFrame, lines: Sequence[str], *kept: str) -> DataFrame:
    """The check rows of a one-row frame of counts."""
    names = ", ".join(RESULT_COLUMNS)
    return facts.selectExpr(*kept, f"stack({len(lines)}, {', '.join(lines)}) AS ({names})").select(
        *RESULT_COLUMNS, *kept
    )


def _known(kind: str, name: str, passed: bool) -> str:
    """A check row that the schema alone decides."""
    return _line(kind, name, str(passed).lower(), "0" if passed else "1")


def _matches_family(dtype: T.DataType, family: str) -> bool:
    if family == "numeric":
        return isinstance(dtype, T.NumericType) and not isinstance(dtype, T.DecimalType)
    return cells.is_text(dtype)


@dataclass(frozen=True)
class ExpectationPlan:
    """What to count on a table, and the check rows to make of the counts."""

    counts: Sequence[Column]
    lines: Sequence[str]

    def rows(self, facts: DataFrame) -> DataFrame:
        """The check rows of a one-row frame that holds the counts."""
        return _rows(facts, self.lines, "total_records")


def expectations(
    df: DataFrame,
    required: Sequence[str],
    types: Mapping[str, str],
    not_null: Sequence[str],
    raw_text: bool = False,
) -> DataFrame:
    """One row per expectation: ``check_kind`` (schema, type, null), ``column_name, passed, observed, threshold``.

    ``types`` maps a column to ``numeric`` or ``string`` and looks at the column's type.
    With ``raw_text`` the table is all text as read from a file: a numeric column then has
    to hold nothing but numbers, and a text column something that is no number, as type
    inference on the file would find. ``observed`` counts the cells against it. An
    expectation on an absent column fails.
    """
    plan = expectation_plan(df, required, types, not_null, raw_text)
    return plan.rows(df.agg(*plan.counts))


def expectation_plan(
    df: DataFrame,
    required: Sequence[str],
    types: Mapping[str, str],
    not_null: Sequence[str],
    raw_text: bool = False,
) -> ExpectationPlan:
    """The parts of :func:`expectations`, for counting along with another pass over the table."""
    aggregates = [F.count("*").alias("total_records")]
    lines = []
    for name in required:
        lines.append(_known("schema", name, name in df.columns))
    for i, (name, family) in enumerate(types.items()):
        if family not in ("numeric", "string"):
            continue
        dtype = cells.dtype_of(df, name)
        if dtype is None:
            lines.append(_line("type", name, "false", "NULL"))
        elif raw_text:
            value = cells.column(name)
            odd = value.isNotNull() & cells.number(name, dtype).isNull()
            aggregates.append(F.count_if(odd).alias(f"odd_{i}"))
            aggregates.append(F.count(value).alias(f"held_{i}"))
            if family == "numeric":
                lines.append(_line("type", name, f"odd_{i} = 0", f"odd_{i}"))
            else:  # a column of nothing but numbers, or of nulls, is read as numbers
                lines.append(_line("type", name, f"odd_{i} > 0", f"IF(odd_{i} > 0, 0, held_{i})"))
        else:
            lines.append(_known("type", name, _matches_family(dtype, family)))
    for i, name in enumerate(not_null):
        dtype = cells.dtype_of(df, name)
        if dtype is None:
            lines.append(_line("null", name, "false", "NULL"))
            continue
        value = cells.column(name)
        null = value.isNull() | F.isnan(value) if cells.is_fraction(dtype) else value.isNull()
        aggregates.append(F.count_if(null).alias(f"null_{i}"))
        lines.append(_line("null", name, f"null_{i} = 0", f"null_{i}"))
    return ExpectationPlan(aggregates, lines)


def expectation_summary(results: DataFrame) -> DataFrame:
    """Roll expectation rows up to one: overall, and per kind."""

    def all_of(kind: str) -> Column:
        return F.coalesce(
            F.bool_and(F.when(F.col("check_kind") == kind, F.col("passed"))), F.lit(True)
        )

    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
        F.max("total_records").alias("total_records"),
        F.count_if(~F.col("passed")).alias("failed_expectations"),
        all_of("schema").alias("schema_passed"),
        all_of("type").alias("types_passed"),
        all_of("null").alias("nulls_passed"),
    )


def infer_families(df: DataFrame) -> dict[str, str]:
    """Which all-text columns hold only numbers; reads the table once, brings back one row."""
    tests = [
        F.coalesce(
            F.bool_and(F.when(cells.column(c).isNotNull(), cells.number(c, df.schema[c].dataType).isNotNull())),
            F.lit(True),
        ).alias(c)
        for c in df.columns
    ]
    found = df.agg(*tests).first()
    return {c: "numeric" if found[c] else "string" for c in df.columns}


def _type_fits(dtype: T.DataType, wanted: str) -> bool:
    if wanted == "integer":
        return isinstance(dtype, T.IntegralType)
    if wanted == "float":
        return isinstance(dtype, T.NumericType)
    if wanted == "timestamp":
        return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))
    return dtype == TYPES[wanted]


def contract_check(
    df: DataFrame,
    contract: Contract,
    ranges: Mapping[str, Mapping[str, float]] | None = None,
    sets: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """The table against its contract, one row per check.

    Kinds: ``schema`` (column present), ``type`` (column type as agreed), ``null``
    (non-nullable column without nulls), ``completeness`` and ``accuracy`` (score at or
    above its threshold; accuracy by the rules given), ``unique`` (no repeated key).
    """
    aggregates = [F.count("*").alias("n")]
    lines = []
    for spec in contract.columns:
        dtype = cells.dtype_of(df, spec.name)
        lines.append(_known("schema", spec.name, dtype is not None))
        lines.append(_known("type", spec.name, dtype is not None and _type_fits(dtype, spec.type)))
    for i, name in enumerate(contract.non_nullable_columns()):
        nulls = cells.column(name).isNull() if name in df.columns else F.lit(True)
        aggregates.append(F.count_if(nulls).alias(f"null_{i}"))
        lines.append(_line("null", name, f"null_{i} = 0", f"null_{i}"))

    pooled = {
        "completeness": measures.completeness_checks(df, contract.required_columns()),
        "accuracy": measures.accuracy_checks(df, ranges, sets),
    }
    limits = {
        "completeness": contract.completeness_threshold,
        "accuracy": contract.accuracy_threshold,
    }
    for kind, checks in pooled.items():
        if not checks:
            continue
        for i, check in enumerate(checks):
            aggregates.append(F.count_if(check.failed).alias(f"{kind}_{i}"))
        failed = " + ".join(f"{kind}_{i}" for i in range(len(checks)))
        score = f"coalesce(1.0D - try_divide({failed}, n * {len(checks)}), 0.0D)"
        limit = f"{float(limits[kind])}D"
        lines.append(_line(kind, "", f"{score} >= {limit}", score, limit))

    facts = df.agg(*aggregates)
    if contract.uniqueness_columns:
        keys = measures.key_counts(df, contract.uniqueness_columns)
        facts = facts.crossJoin(F.broadcast(keys))  # two global aggregates: one row each
        lines.append(_line("unique", ",".join(contract.uniqueness_columns), "excess = 0", "excess"))
    return _rows(facts, lines)


_COLUMN_SCHEMA = "column_name string, type string, nullable boolean"


def contract_diff(spark: SparkSession, old: Contract, new: Contract) -> DataFrame:
    """Columns that differ between two contracts: ``column_name, change, breaking`` and both sides."""

    def rows(contract: Contract, side: str) -> DataFrame:
        listed = [(c.name, c.type, c.nullable) for c in contract.columns]
        frame = spark.createDataFrame(listed, _COLUMN_SCHEMA)
        return frame.select(
            "column_name", F.col("type").alias(f"{side}_type"), F.col("nullable").alias(f"{side}_nullable")
        )

    both = rows(old, "old").join(rows(new, "new"), "column_name", "full_outer")
    change = (
        F.when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type").isNull(), "added")
        .when(F.col("old_type") != F.col("new_type"), "type changed")
        .when(~F.col("old_nullable") & F.col("new_nullable"), "now nullable")
        .when(F.col("old_nullable") & ~F.col("new_nullable"), "no longer nullable")
    )
    return (
        both.withColumn("change", change)
        .where(F.col("change").isNotNull())
        .withColumn("breaking", F.col("change").isin("removed", "type changed", "now nullable"))
    )
