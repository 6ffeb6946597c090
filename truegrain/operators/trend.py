"""Trends in a score history: rolling mean, baseline z-score, summaries and alerts.

A history has ``pipeline_name, scored_at, total_score`` and ``score_<dimension>``
columns, one row per run. All pipelines are handled in one job, and none of them is
gathered in one task: first and last rows come from limits that Spark applies on the
map side, everything else from aggregates or windows over pieces of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from truegrain.functions.joins import join_on
from truegrain.operators.anomaly import z_score
from truegrain.operators.score import long_scores

KEY = "pipeline_name"
TIME = "scored_at"
VALUE = "total_score"

# Rows compared at either end of a history, and the least it must hold.
END_ROWS = 7
MIN_RECORDS = 7

BLOCK_ROWS = 100_000  # rows one task of the rolling window handles


def _order(history: DataFrame, descending: bool = False) -> list[Column]:
    """By time; runs scored at the same instant are ordered by their other columns."""
    names = [TIME, *(c for c in history.columns if c not in (KEY, TIME))]
    return [F.col(c).desc() if descending else F.col(c).asc() for c in names]


def first_rows(history: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each pipeline, numbered from 1 in ``row_no``."""
    rank = F.row_number().over(W.partitionBy(KEY).orderBy(*_order(history)))
    return history.withColumn("row_no", rank).where(F.col("row_no") <= n)


def last_rows(history: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of each pipeline, numbered from the end in ``row_no``."""
    rank = F.row_number().over(W.partitionBy(KEY).orderBy(*_order(history, descending=True)))
    return history.withColumn("row_no", rank).where(F.col("row_no") <= n)


def numbered(history: DataFrame) -> DataFrame:
    """Number the rows of each pipeline in time order, from 1 in ``row_no``.

    Rows are ordered within each hour only; the numbers before an hour come from a
    running sum over hourly counts, so a long history is spread over its hours.
    """
    hour = F.date_trunc("hour", F.col(TIME))
    counts = history.groupBy(KEY, hour.alias("__hour")).agg(F.count("*").alias("__n"))
    running = F.sum("__n").over(
        W.partitionBy(KEY).orderBy("__hour").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    offsets = counts.select(KEY, "__hour", (running - F.col("__n")).alias("__before"))
    within = F.row_number().over(W.partitionBy(KEY, "__hour").orderBy(*_order(history)))
    placed = join_on(history.withColumn("__hour", hour), offsets, [KEY, "__hour"])
    return placed.withColumn("row_no", F.col("__before") + within).drop("__hour", "__before")


def rolling_average(history: DataFrame, window: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``rolling_avg``, the mean of the last ``window`` rows, fewer at the start.

    Rows are cut into blocks by their number; the last rows of a block are repeated at
    the head of the next, so that every window is whole inside one block.
    """
    size = max(block_rows, window)
    rows = numbered(history)
    block = F.floor((F.col("row_no") - 1) / F.lit(size))
    place = (F.col("row_no") - 1) % F.lit(size)
    near_end = place >= F.lit(size - (window - 1))
    copies = F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block))
    spread = rows.withColumn("__own", block).withColumn("__block", F.explode(copies))
    frame = W.partitionBy(KEY, "__block").orderBy("row_no").rowsBetween(-(window - 1), W.currentRow)
    averaged = spread.withColumn("rolling_avg", F.avg(VALUE).over(frame))
    return averaged.where(F.col("__own") == F.col("__block")).drop("__own", "__block", "row_no")


def baseline(history: DataFrame, rows: int = 14) -> DataFrame:
    """Mean and sample deviation of each pipeline's first rows."""
    return (
        first_rows(history.select(KEY, TIME, VALUE), rows)
        .groupBy(KEY)
        .agg(F.avg(VALUE).alias("mean_baseline"), F.stddev_samp(VALUE).alias("std_baseline"))
    )


def score_anomalies(history: DataFrame, baseline_rows: int = 14, z_threshold: float = 2.0) -> DataFrame:
    """Add ``mean_baseline, std_baseline, z_score, is_anomaly``; only low scores are anomalous."""
    joined = join_on(history, baseline(history, baseline_rows), [KEY], "left")
    z = z_score(F.col(VALUE), F.col("mean_baseline"), F.col("std_baseline"))
    return joined.withColumns(
        {
            "z_score": z,
            "is_anomaly": F.coalesce(z < F.lit(-float(z_threshold)), F.lit(False)),
        }
    )


def trend_summary(
    history: DataFrame,
    window: int = 7,
    baseline_rows: int = 14,
    z_threshold: float = 2.0,
) -> DataFrame:
    """One row per pipeline: period, records, rolling mean at row 7 and at the end, direction.

    Histories shorter than 7 rows take their last row in place of the 7th. The rolling
    mean is only worked out at those two rows.
    """
    slim = history.select(KEY, TIME, VALUE)
    period = score_anomalies(slim, baseline_rows, z_threshold).groupBy(KEY).agg(
        F.min(TIME).alias("first_scored_at"),
        F.max(TIME).alias("last_scored_at"),
        F.count("*").alias("total_records"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.max("mean_baseline").alias("mean_baseline"),
        F.max("std_baseline").alias("std_baseline"),
    )
    head = (
        first_rows(slim, END_ROWS)
        .where(F.col("row_no") > F.lit(END_ROWS - window))
        .groupBy(KEY)
        .agg(F.avg(VALUE).alias("head_avg"), F.max("row_no").alias("head_rows"))
    )
    tail = last_rows(slim, window).groupBy(KEY).agg(F.avg(VALUE).alias("last_rolling"))
    joined = join_on(join_on(period, head, [KEY], "left"), tail, [KEY], "left")
    short = F.col("total_records") < F.lit(END_ROWS)
    first = F.when(short, F.col("last_rolling")).otherwise(F.col("head_avg"))
    delta = F.col("last_rolling") - first
    return joined.select(
        KEY,
        "first_scored_at",
        "last_scored_at",
        "total_records",
        first.alias("first_rolling"),
        "last_rolling",
        delta.alias("trend_delta"),
        F.when(delta > 0, "improving").otherwise("degrading").alias("trend_direction"),
        "anomaly_count",
        "mean_baseline",
        "std_baseline",
    )


def dimension_trend(history: DataFrame, rows: int = END_ROWS) -> DataFrame:
    """Per pipeline and dimension: mean of the first and last rows, change, arrow, alert flag."""
    dims = [c for c in history.columns if c.startswith("score_")]

    def means(ends: DataFrame, name: str) -> DataFrame:
        wide = ends.groupBy(KEY).agg(*(F.avg(c).alias(c) for c in dims))
        return long_scores(wide, [KEY]).withColumnRenamed("score", name)

    both = join_on(
        means(first_rows(history, rows), "avg_first"),
        means(last_rows(history, rows), "avg_last"),
        [KEY, "dimension"],
    )
    delta = F.col("avg_last") - F.col("avg_first")
    return both.withColumn("delta", delta).withColumns(
        {
            "arrow": F.when(F.col("delta") > 0.005, "↑").when(F.col("delta") < -0.005, "↓").otherwise("→"),
            "is_alert": F.coalesce(F.col("delta") < -0.02, F.lit(False)),
        }
    )


def trend_alert(summary: DataFrame, min_records: int = MIN_RECORDS) -> DataFrame:
    """One row per pipeline: ``alert``, ``stable`` or ``skipped`` for too short a history."""
    enough = F.col("total_records") >= min_records
    direction = F.when(enough, F.col("trend_direction")).otherwise("insufficient_data")
    count = F.when(enough, F.col("anomaly_count")).otherwise(F.lit(0))
    delta = F.when(enough, F.round("trend_delta", 2)).otherwise(F.lit(0.0))
    base = F.when(enough, F.round("mean_baseline", 2))
    action = (
        F.when(~enough, "skipped")
        .when((direction == "degrading") | (count > 0), "alert")
        .otherwise("stable")
    )
    return summary.select(
        KEY,
        "total_records",
        direction.alias("trend_direction"),
        count.alias("anomaly_count"),
        delta.alias("trend_delta"),
        base.alias("mean_baseline"),
        action.alias("action"),
    )
