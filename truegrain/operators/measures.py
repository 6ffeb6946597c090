"""The six quality dimensions of a table, whole or per group.

Every row-level test of every dimension goes into one aggregate, so a scorecard
reads the table once for them, with partial sums on the map side. Uniqueness needs
a shuffle by key, so it is its own branch that reads nothing but the key columns:
shipping keys alone is far cheaper than carrying all sums through that shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions import cells
from truegrain.functions.joins import join_on
from truegrain.functions.rules import Rule, holds

# The dimensions, in scoring order.
DIMENSIONS = ("completeness", "validity", "accuracy", "consistency", "uniqueness", "timeliness")


@dataclass(frozen=True)
class MeasureSpec:
    """What to measure. A dimension left out is not measured."""

    completeness: Sequence[str] = ()
    validity: Mapping[str, str] = field(default_factory=dict)
    ranges: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    sets: Mapping[str, Iterable] = field(default_factory=dict)
    rules: Mapping[str, Rule] = field(default_factory=dict)
    unique: Sequence[str] = ()
    timestamp: str | None = None
    sla_hours: float | None = None
    measured: Sequence[str] = DIMENSIONS


@dataclass(frozen=True)
class Check:
    """One row-level test; ``failed`` is never null."""

    dimension: str
    column_name: str
    rule: str
    failed: Column


def completeness_checks(df: DataFrame, columns: Sequence[str]) -> list[Check]:
    return [
        Check("completeness", name, "missing", cells.missing(name, cells.dtype_of(df, name)))
        for name in columns
    ]


def validity_checks(df: DataFrame, types: Mapping[str, str]) -> list[Check]:
    """An unknown type counts as checked and never fails; a missing column is skipped."""
    tests = {"numeric": cells.not_numeric, "string": cells.not_text, "email": cells.not_email}
    checks = []
    for name, kind in types.items():
        dtype = cells.dtype_of(df, name)
        if dtype is None:
            continue
        failed = tests[kind](name, dtype) if kind in tests else F.lit(False)
        checks.append(Check("validity", name, kind, failed))
    return checks


def accuracy_checks(
    df: DataFrame,
    ranges: Mapping[str, Mapping[str, float]] | None = None,
    sets: Mapping[str, Iterable] | None = None,
) -> list[Check]:
    """Range and set rules; a missing column is skipped."""
    checks = []
    for name, bounds in (ranges or {}).items():
        dtype = cells.dtype_of(df, name)
        if dtype is not None:
            failed = cells.out_of_range(name, dtype, bounds.get("min"), bounds.get("max"))
            checks.append(Check("accuracy", name, "range", failed))
    for name, allowed in (sets or {}).items():
        if name in df.columns:
            checks.append(Check("accuracy", name, "set", cells.not_in_set(name, allowed)))
    return checks


def consistency_checks(df: DataFrame, rules: Mapping[str, Rule]) -> list[Check]:
    return [Check("consistency", "", name, ~holds(df, rule)) for name, rule in rules.items()]


def row_checks(df: DataFrame, spec: MeasureSpec) -> list[Check]:
    return [
        *completeness_checks(df, spec.completeness),
        *validity_checks(df, spec.validity),
        *accuracy_checks(df, spec.ranges, spec.sets),
        *consistency_checks(df, spec.rules),
    ]


def any_of(conditions: Sequence[Column]) -> Column:
    verdict = F.lit(False)
    for condition in conditions:
        verdict = verdict | condition
    return verdict


def count_where(condition: Column) -> Column:
    """How many rows meet a condition; 0 rather than null on an empty table."""
    return F.count_if(condition)


def share_passed(failed: Column, checked: Column) -> Column:
    """1 - failed / checked, and 0.0 where nothing was checked."""
    return F.coalesce(F.lit(1.0) - F.try_divide(failed, checked), F.lit(0.0))


def violations(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """Failures per check in long form, all counted in one pass.

    Columns: ``by``, ``dimension, column_name, rule, violations, checked``.
    """
    if not checks:
        raise ValueError("no checks to count")
    counted = df.groupBy(*by).agg(
        F.count("*").alias("checked"),
        *(count_where(check.failed).alias(f"v{i}") for i, check in enumerate(checks)),
    )
    lines = ", ".join(
        f"{cells.sql_text(check.dimension)}, {cells.sql_text(check.column_name)}, "
        f"{cells.sql_text(check.rule)}, v{i}"
        for i, check in enumerate(checks)
    )
    long = counted.selectExpr(
        *(f"`{name}`" for name in by),
        "checked",
        f"stack({len(checks)}, {lines}) AS (dimension, column_name, rule, violations)",
    )
    return long.select(*by, "dimension", "column_name", "rule", "violations", "checked")


def age_hours(moment: Column, as_of: datetime) -> Column:
    """Hours from a timestamp to ``as_of`` (UTC), to the microsecond."""
    now = F.unix_micros(F.lit(_utc_text(as_of)).cast("timestamp"))
    return (now - F.unix_micros(moment)) / F.lit(3.6e9)


def _utc_text(moment: datetime) -> str:
    """An instant as text with its offset, so the session's zone cannot shift it."""
    return moment.isoformat() if moment.tzinfo else moment.isoformat() + "+00:00"


def as_of_column(as_of: datetime) -> Column:
    return F.lit(_utc_text(as_of)).cast("timestamp")


def timeliness_score(latest: Column, sla_hours: float, as_of: datetime) -> Column:
    """max(0, 1 - age / SLA). A future timestamp scores above 1; no timestamp scores 0."""
    left = F.lit(1.0) - age_hours(latest, as_of) / F.lit(float(sla_hours))
    return F.coalesce(F.greatest(F.lit(0.0), left), F.lit(0.0))


def key_counts(df: DataFrame, subset: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and excess rows over one per key; null keys equal each other.

    The inner count is partly summed before the shuffle, so a key that fills a third
    of the table sends one row per map task.
    """
    keys = df.groupBy(*by, *(name for name in subset if name not in by)).agg(
        F.count("*").alias("n")
    )
    return keys.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("key_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"),
    )


def dimension_scores(
    df: DataFrame, spec: MeasureSpec, as_of: datetime, by: Sequence[str] = ()
) -> DataFrame:
    """One row per group: ``by``, ``row_count`` and ``score_<dimension>`` for each measured one.

    Without ``by`` there is exactly one row, also for an empty table.
    """
    wanted = [d for d in DIMENSIONS if d in spec.measured]
    facts = df.groupBy(*by).agg(*fact_aggregates(df, spec))
    if "uniqueness" in wanted:
        facts = attach(facts, key_counts(df, unique_columns(df, spec), by), by)
    return scores_of(facts, spec, as_of, by)


def unique_columns(df: DataFrame, spec: MeasureSpec) -> Sequence[str]:
    absent = [name for name in spec.unique if name not in df.columns]
    if absent or not spec.unique:
        raise ValueError(f"uniqueness columns not in the table: {absent or 'none given'}")
    return spec.unique


def fact_aggregates(df: DataFrame, spec: MeasureSpec) -> list[Column]:
    """What a table's rows say of all dimensions but uniqueness: counts that add up over parts, and the latest instant."""
    checks = row_checks(df, spec)
    aggregates = [F.count("*").alias("row_count")]
    for dimension in ("completeness", "validity", "accuracy"):
        own = [check for check in checks if check.dimension == dimension]
        for i, check in enumerate(own):
            aggregates.append(count_where(check.failed).alias(f"{dimension}_{i}"))
    broken = [check.failed for check in checks if check.dimension == "consistency"]
    aggregates.append(count_where(any_of(broken)).alias("rows_broken"))
    if "timeliness" in spec.measured:
        if spec.timestamp is None or spec.sla_hours is None:
            raise ValueError("timeliness needs a timestamp column and sla_hours")
        dtype = cells.dtype_of(df, spec.timestamp)
        if dtype is None:
            raise ValueError(f"timeliness column {spec.timestamp!r} is not in the table")
        aggregates.append(cells.latest(spec.timestamp, dtype).alias("latest"))
    return aggregates


def scores_of(facts: DataFrame, spec: MeasureSpec, as_of: datetime, by: Sequence[str] = ()) -> DataFrame:
    """The dimension scores of counted facts, with ``excess`` and ``key_rows`` beside them if uniqueness is measured."""
    wanted = [d for d in DIMENSIONS if d in spec.measured]
    scores = {}
    for dimension in ("completeness", "validity", "accuracy"):
        own = [c for c in facts.columns if re.fullmatch(rf"{dimension}_\d+", c) and c not in by]
        failed = F.lit(0)
        for name in own:
            failed = failed + F.col(name)
        scores[dimension] = share_passed(failed, F.col("row_count") * F.lit(len(own)))
    scores["consistency"] = (
        share_passed(F.col("rows_broken"), F.col("row_count")) if spec.rules else F.lit(1.0)
    )
    if "uniqueness" in wanted:
        scores["uniqueness"] = share_passed(F.col("excess"), F.col("key_rows"))
    if "timeliness" in wanted:
        newest = cells.latest_instant("latest", cells.dtype_of(facts, "latest"))
        scores["timeliness"] = timeliness_score(newest, spec.sla_hours, as_of)
    return facts.select(
        *by, "row_count", *(scores[d].alias(f"score_{d}") for d in wanted)
    )


def attach(facts: DataFrame, keys: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join two results of the same grouping."""
    if not by:
        return facts.crossJoin(F.broadcast(keys))  # both are global aggregates: one row each
    return join_on(facts, keys, by)


def _single(df: DataFrame, dimension: str, spec: MeasureSpec, as_of: datetime, by: Sequence[str]):
    scored = dimension_scores(df, spec, as_of, by)
    return scored.select(*by, F.col(f"score_{dimension}").alias(dimension))


_NO_CLOCK = datetime(1970, 1, 1)


def completeness(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Share of cells that are present."""
    spec = MeasureSpec(completeness=columns, measured=("completeness",))
    return _single(df, "completeness", spec, _NO_CLOCK, by)


def validity(df: DataFrame, types: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Share of cells that have the type or format asked for."""
    spec = MeasureSpec(validity=types, measured=("validity",))
    return _single(df, "validity", spec, _NO_CLOCK, by)


def accuracy(
    df: DataFrame,
    ranges: Mapping[str, Mapping[str, float]] | None = None,
    sets: Mapping[str, Iterable] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Share of cells inside their range or set, pooled."""
    spec = MeasureSpec(ranges=ranges or {}, sets=sets or {}, measured=("accuracy",))
    return _single(df, "accuracy", spec, _NO_CLOCK, by)


def consistency(df: DataFrame, rules: Mapping[str, Rule], by: Sequence[str] = ()) -> DataFrame:
    """Share of rows that keep every rule."""
    spec = MeasureSpec(rules=rules, measured=("consistency",))
    return _single(df, "consistency", spec, _NO_CLOCK, by)


def uniqueness(df: DataFrame, subset: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Share of rows that are not a second or later copy of their key."""
    counted = key_counts(df, unique_columns(df, MeasureSpec(unique=subset)), by)
    score = share_passed(F.col("excess"), F.col("key_rows"))
    return counted.select(*by, score.alias("uniqueness"))


def timeliness(
    df: DataFrame, timestamp: str, sla_hours: float, as_of: datetime, by: Sequence[str] = ()
) -> DataFrame:
    """Freshness of the newest row against the SLA."""
    spec = MeasureSpec(timestamp=timestamp, sla_hours=sla_hours, measured=("timeliness",))
    return _single(df, "timeliness", spec, as_of, by)


def first_broken_rule(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """The rows that break a rule, with the name of the first one broken."""
    broken = F.coalesce(
        *(F.when(~holds(df, rule), F.lit(name)) for name, rule in rules.items()),
        F.lit(None).cast("string"),
    )
    return df.withColumn("broken_rule", broken).where(F.col("broken_rule").isNotNull())


def reference_violations(df: DataFrame, name: str, reference: DataFrame, key: str) -> DataFrame:
    """Set membership against a reference table of any size.

    Values are counted before the join, so a value that fills a third of the table
    meets the reference as one row. Null is outside. One row:
    ``column_name, violations, checked, accuracy``.
    """
    values = df.groupBy(cells.column(name).alias("value")).agg(F.count("*").alias("n"))
    known = reference.select(cells.column(key).alias("known")).distinct()
    matched = values.join(known, F.col("value") == F.col("known"), "left")
    totals = matched.agg(
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("violations"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
    )
    return totals.select(
        F.lit(name).alias("column_name"),
        "violations",
        "checked",
        share_passed(F.col("violations"), F.col("checked")).alias("accuracy"),
    )


def issue_profile(
    df: DataFrame,
    nulls: Sequence[str] = (),
    negatives: Sequence[str] = (),
    sets: Mapping[str, Iterable] | None = None,
    unique: Sequence[str] = (),
) -> DataFrame:
    """Counts of planted or suspected faults in one row: rows, nulls, negatives, odd values, repeats."""
    counts = [F.count("*").alias("total_rows")]
    counts += [F.count_if(cells.column(c).isNull()).alias(f"null_{c}") for c in nulls]
    counts += [F.count_if(cells.column(c) < 0).alias(f"negative_{c}") for c in negatives]
    counts += [
        F.count_if(cells.not_in_set(c, allowed)).alias(f"invalid_{c}")
        for c, allowed in (sets or {}).items()
    ]
    profile = df.agg(*counts)
    if not unique:
        return profile
    repeats = key_counts(df, unique).select(F.col("excess").alias("duplicate_" + "_".join(unique)))
    return profile.crossJoin(F.broadcast(repeats))  # two global aggregates: one row each
