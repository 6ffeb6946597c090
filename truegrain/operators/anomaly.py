"""Outliers by z-score and interquartile range, and the clean / quarantine split.

Statistics are taken for all columns together, written as one small table, and brought
back to the rows: as one broadcast row for a whole table, by a join on the group otherwise. As the
small table is read back, Spark knows its size when it plans that join, and a plan that uses
flagged rows more than once doesn't work the statistics out again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions import cells
from truegrain.functions.joins import join_on
from truegrain.operators import quantiles
from truegrain.session import stored

# Name starts of the columns that detection adds.
DETECTION_PREFIXES = ("z_score_", "is_anomaly_", "iqr_lower_", "iqr_upper_")


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 1.5,
    by: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """Quartiles and outlier limits: ``by, column_name, q1, q3, iqr_lower, iqr_upper``."""
    take = quantiles.exact_quantiles if exact else quantiles.sketched_quantiles
    marks = take(df, columns, (0.25, 0.75), by)
    reach = F.lit(float(multiplier)) * (F.col("q1") - F.col("q0"))
    return marks.select(
        *by,
        "column_name",
        F.col("q0").alias("q1"),
        F.col("q1").alias("q3"),
        (F.col("q0") - reach).alias("iqr_lower"),
        (F.col("q1") + reach).alias("iqr_upper"),
    )


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """Distance from the mean in deviations; infinite off the mean of a column without spread."""
    flat = F.when(value < mean, F.lit(float("-inf"))).when(value > mean, F.lit(float("inf")))
    return F.when(deviation == 0, flat).otherwise((value - mean) / deviation)


def _bring(df: DataFrame, statistics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Put group statistics on the rows of the group; a whole table's are one row."""
    if not by:
        return df.crossJoin(F.broadcast(statistics))
    return join_on(df, statistics, by, "left")


def detect(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "iqr",
    multiplier: float = 1.5,
    threshold: float = 3.0,
    by: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """Flag outliers by ``iqr``, ``zscore`` or ``both``.

    Per column: ``iqr_lower_<c>, iqr_upper_<c>, is_anomaly_iqr_<c>`` and / or
    ``z_score_<c>, is_anomaly_zscore_<c>``; and ``is_anomaly``, true where any flag is.
    Columns the table lacks are skipped, another method name flags nothing, and a cell
    that is no number is never flagged.
    """
    present = [name for name in columns if name in df.columns]
    added: dict[str, Column] = {}
    flags: list[Column] = []
    scratch: list[str] = []
    statistics: DataFrame | None = None

    if present and method in ("iqr", "both"):
        bounds = iqr_bounds(df, present, multiplier, by, exact)
        statistics = bounds.groupBy(*by).agg(
            *(
                F.max(F.when(F.col("column_name") == name, F.col(f"iqr_{end}"))).alias(f"iqr_{end}_{name}")
                for name in present
                for end in ("lower", "upper")
            )
        )
    if present and method in ("zscore", "both"):
        moments = []
        for name in present:
            value = cells.number(name, df.schema[name].dataType)
            moments.append(F.avg(value).alias(f"__mean_{name}"))
            moments.append(F.stddev_samp(value).alias(f"__sd_{name}"))
            scratch += [f"__mean_{name}", f"__sd_{name}"]
        spread = df.groupBy(*by).agg(*moments)
        statistics = spread if statistics is None else _bring(spread, statistics, by)
    out = df if statistics is None else _bring(df, stored(statistics, "statistics"), by)

    for name in present:
        value = cells.number(name, df.schema[name].dataType)
        if method in ("iqr", "both"):
            low, high = cells.column(f"iqr_lower_{name}"), cells.column(f"iqr_upper_{name}")
            flag = F.coalesce((value < low) | (value > high), F.lit(False))
            added[f"is_anomaly_iqr_{name}"] = flag
            flags.append(flag)
        if method in ("zscore", "both"):
            z = z_score(value, cells.column(f"__mean_{name}"), cells.column(f"__sd_{name}"))
            flag = F.coalesce(F.abs(z) > F.lit(float(threshold)), F.lit(False))
            added[f"z_score_{name}"] = z
            added[f"is_anomaly_zscore_{name}"] = flag
            flags.append(flag)

    verdict = F.lit(False)
    for flag in flags:
        verdict = verdict | flag
    added["is_anomaly"] = verdict
    return out.withColumns(added).drop(*scratch)


def detect_zscore(
    df: DataFrame, columns: Sequence[str], threshold: float = 3.0, by: Sequence[str] = ()
) -> DataFrame:
    return detect(df, columns, "zscore", threshold=threshold, by=by).drop("is_anomaly")


def detect_iqr(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = 1.5,
    by: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    return detect(df, columns, "iqr", multiplier=multiplier, by=by, exact=exact).drop("is_anomaly")


def quarantine(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split on ``is_anomaly``. Clean rows lose the detection columns but keep the flag."""
    if "is_anomaly" not in flagged.columns:
        raise ValueError("run detect() before quarantine(): there is no is_anomaly column")
    detection = [c for c in flagged.columns if c.startswith(DETECTION_PREFIXES)]
    return (
        flagged.where(~F.col("is_anomaly")).drop(*detection),
        flagged.where(F.col("is_anomaly")),
    )


def split_anomalies(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "iqr",
    multiplier: float = 1.5,
    threshold: float = 3.0,
    by: Sequence[str] = (),
    exact: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Detect, then split into clean and quarantined rows."""
    return quarantine(detect(df, columns, method, multiplier, threshold, by, exact))


def quarantine_rate(flagged: DataFrame, limit: float = 0.2) -> DataFrame:
    """Share of flagged rows against a limit, in one row."""
    return rate_of(flagged.agg(*rate_counts()), limit)


def rate_counts() -> list[Column]:
    """What :func:`rate_of` needs counted, for counting along with another pass over flagged rows."""
    return [F.count("*").alias("total_input"), F.count_if(F.col("is_anomaly")).alias("quarantine_records")]


def rate_of(counted: DataFrame, limit: float = 0.2) -> DataFrame:
    """The quarantine rate of a one-row frame of counts."""
    rate = F.coalesce(
        F.round(F.try_divide(F.col("quarantine_records"), F.col("total_input")), 4), F.lit(0.0)
    )
    return counted.select(
        "total_input",
        (F.col("total_input") - F.col("quarantine_records")).alias("clean_records"),
        "quarantine_records",
        rate.alias("quarantine_rate"),
        F.lit(float(limit)).alias("quarantine_rate_threshold"),
        (rate <= F.lit(float(limit))).alias("passed"),
    )
