"""Scorecards and quantiles of a table that grows by partitions, without reading old partitions again.

Each partition leaves a state: counts of every row check, its latest instant, how often each key occurs, and quantile
sketches of numeric columns. States merge: counts add up, keys are added up by key, sketches are merged. So a day's run
reads the rows of new partitions, and of states as little as is needed.

A state's parts are written to folders of their own, ``facts`` last: a partition counts as measured once its facts are there. One
that is measured again, as after a late correction, or because a run broke off, replaces its own state.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.functions import cells
from truegrain.operators import measures, quantiles
from truegrain.operators.measures import MeasureSpec
from truegrain.operators.score import ScorerConfig, with_score
from truegrain.sources import storage

NO_PART = "(none)"
SKETCH_K = 2000
#: KLL's published error: a rank is off by more than 2.296 / k^0.9021 of the rows in one of a hundred cases.
RANK_ERROR = 2.296 / SKETCH_K**0.9021
RESERVED = ("part", "key", "n", "column_name", "sketch", "checks", "row_count", "rows_broken", "latest")


def _part_of(name: str) -> Column:
    return F.coalesce(cells.column(name).cast("string"), F.lit(NO_PART))


def _write(df: DataFrame, path: str) -> None:
    df.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A folder of states; its partition names stay text."""
    stored = spark.read.option("basePath", path).parquet(path)
    return stored.withColumn("part", F.col("part").cast("string"))


def measured_parts(spark: SparkSession, path: str) -> list[str]:
    """The partitions whose states are stored: one name each, so as many as the table has partitions."""
    if not any(name.startswith("part=") for name in storage.child_names(spark, f"{path}/facts")):
        return []
    facts = spark.read.parquet(f"{path}/facts")
    return sorted(row[0] for row in facts.select("__part").distinct().collect())


def measure_parts(
    df: DataFrame,
    spec: MeasureSpec,
    part: str,
    path: str,
    by: Sequence[str] = (),
    sketched: Sequence[str] = (),
    again: Sequence[str] = (),
) -> list[str]:
    """Store the states of the partitions of ``df`` (by column ``part``) that have none yet, and of those in ``again``.

    Returns the partitions that were read. The filter is on the partition column alone, so a table
    that is stored by it is read in its new folders only. A null partition is named ``(none)``. ``sketched`` are numeric columns
    to sketch. All partitions below a path must be measured by the same checks and groups, which are compared.
    """
    spark = df.sparkSession
    if set(by) & set(RESERVED):
        raise ValueError(f"rename the grouping columns {sorted(set(by) & set(RESERVED))}: the states use them")
    known = set(measured_parts(spark, path)) - set(again)
    new = df.where(~_part_of(part).isin(sorted(known))) if known else df
    parts = sorted(row[0] for row in new.select(_part_of(part)).distinct().collect())
    if not parts:
        return []
    new = new.withColumn("part", _part_of(part)) if part != "part" else new.withColumn("part", _part_of("part"))
    if "uniqueness" in spec.measured:
        key = F.struct(*(cells.column(c).alias(f"k{i}") for i, c in enumerate(measures.unique_columns(df, spec))))
        _write(new.groupBy(*by, "part", key.alias("key")).agg(F.count("*").alias("n")), f"{path}/keys")
    if sketched:
        values = quantiles.numbers(new, sketched, [*by, "part"])
        sketch = F.kll_sketch_agg_double("value", F.lit(SKETCH_K))
        _write(values.groupBy(*by, "part", "column_name").agg(sketch.alias("sketch")), f"{path}/sketches")
    labels = [f"{c.dimension}.{c.column_name}.{c.rule}" for c in measures.row_checks(df, spec)]
    facts = new.groupBy(*by, "part").agg(*measures.fact_aggregates(df, spec))
    marked = facts.withColumns({"checks": F.lit("\n".join([*labels, *by])), "__part": F.col("part")})
    _write(marked, f"{path}/facts")
    return parts


def merged_facts(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """The facts of all stored partitions together, as one table's would be."""
    facts = _read(spark, f"{path}/facts")
    checks = [row[0] for row in facts.select("checks").distinct().limit(2).collect()]
    if len(checks) > 1:
        raise ValueError(f"the partitions at {path} were measured by different checks: measure them again")
    counts = [c for c in facts.columns if c not in (*by, *RESERVED, "__part")] + ["row_count", "rows_broken"]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]
    latest = [F.max("latest").alias("latest")] if "latest" in facts.columns else []
    return facts.groupBy(*by).agg(*sums, *latest)


def merged_key_counts(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows and excess rows over one per key, over all partitions: a key of many partitions is one key.

    A partition sends one row per key, so that a hot key is as many rows as there are partitions; these are added up
    before the shuffle as well.
    """
    keys = _read(spark, f"{path}/keys").groupBy(*by, "key").agg(F.sum("n").alias("n"))
    return keys.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("key_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess")
    )


def merged_scores(spark: SparkSession, path: str, spec: MeasureSpec, as_of: datetime, by: Sequence[str] = ()) -> DataFrame:
    """The scores of all stored partitions: those that ``measures.dimension_scores`` gives of all rows."""
    facts = merged_facts(spark, path, by)
    if "uniqueness" in spec.measured:
        facts = measures.attach(facts, merged_key_counts(spark, path, by), by)
    return measures.scores_of(facts, spec, as_of, by)


def merged_scorecard(
    spark: SparkSession, path: str, spec: MeasureSpec, config: ScorerConfig, as_of: datetime, by: Sequence[str] = ()
) -> DataFrame:
    """The scorecard of all stored partitions, with the columns of ``score.scorecard``."""
    scored = with_score(merged_scores(spark, path, spec, as_of, by), config)
    dims = [c for c in scored.columns if c.startswith("score_")]
    return scored.select(
        F.lit(config.pipeline_name).alias("pipeline_name"), *by, measures.as_of_column(as_of).alias("scored_at"),
        "row_count", *dims, "total_score", "status", "hard_block_triggered",
    )


def latest_of_parts(spark: SparkSession, path: str, by: str, table: str | None = None) -> DataFrame:
    """``table_name, latest_timestamp`` for each group ``by``, or of one table as a whole, from the states alone: no data is read."""
    facts = merged_facts(spark, path, [by])
    latest = cells.latest_instant("latest", cells.dtype_of(facts, "latest"))
    if table is None:
        return facts.select(cells.column(by).alias("table_name"), latest.alias("latest_timestamp"))
    return facts.agg(F.max(latest).alias("latest_timestamp")).select(F.lit(table).alias("table_name"), "latest_timestamp")


def merged_quantiles(
    spark: SparkSession, path: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles of all stored partitions, ``by, column_name, n, q0, q1, ...``, each a value within ``RANK_ERROR`` of its rank.

    A column without numbers has no row.
    """
    sketches = _read(spark, f"{path}/sketches").groupBy(*by, "column_name")
    merged = sketches.agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))
    marks = [
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(probabilities)
    ]
    return merged.select(*by, "column_name", F.kll_sketch_get_n_double("sketch").alias("n"), *marks)


def rank_check(
    df: DataFrame, marks: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """How far sketched quantiles are from their ranks: ``by, column_name, p, rows, rank_low, rank_high, within``.

    The ranks of a mark are the shares of values below it and up to it; it is right if p, give or take four times
    ``RANK_ERROR``, lies between them. One pass over the values.
    """
    lines = [F.struct(F.lit(float(p)).alias("p"), F.col(f"q{i}").alias("mark")) for i, p in enumerate(probabilities)]
    wanted = marks.select(*by, "column_name", F.array(*lines).alias("__marks"))
    counted = quantiles.numbers(df, columns, by)
    met = measures.join_on(counted, wanted, [*by, "column_name"])
    sums = []
    for i in range(len(probabilities)):
        mark = F.col("__marks")[i]["mark"]
        sums += [F.count_if(F.col("value") < mark).alias(f"__below_{i}"), F.count_if(F.col("value") <= mark).alias(f"__upto_{i}")]
    ranked = met.groupBy(*by, "column_name").agg(F.count("*").alias("rows"), *sums)
    shares = [
        F.struct(
            F.lit(float(p)).alias("p"), (F.col(f"__below_{i}") / F.col("rows")).alias("rank_low"),
            (F.col(f"__upto_{i}") / F.col("rows")).alias("rank_high"),
        )
        for i, p in enumerate(probabilities)
    ]
    told = ranked.select(*by, "column_name", "rows", F.inline(F.array(*shares)))
    reach = F.lit(4 * RANK_ERROR)
    within = (F.col("rank_low") - reach <= F.col("p")) & (F.col("p") <= F.col("rank_high") + reach)
    return told.select(*by, "column_name", "p", "rows", "rank_low", "rank_high", within.alias("within"))
