"""The bronze-to-silver transform: clean texts, normalize dates, remove duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.functions.cells import column, is_text
from truegrain.operators.duplicates import copy_counts, deduplicate


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim spaces off every text column and turn what is then empty into null."""
    return df.select(
        *(
            F.nullif(F.trim(column(f.name)), F.lit("")).alias(f.name)
            if is_text(f.dataType)
            else column(f.name)
            for f in df.schema.fields
        )
    )


def normalize_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn columns into dates; a text that is no date becomes null, absent columns are skipped."""
    dates = {}
    for name in columns:
        if name in df.columns:
            dtype = df.schema[name].dataType
            as_date = column(name).try_cast("date") if is_text(dtype) else column(name).cast("date")
            dates[name] = column(name) if isinstance(dtype, T.DateType) else as_date
    return df.withColumns(dates) if dates else df


def to_silver(
    df: DataFrame,
    key: Sequence[str],
    dates: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Clean, normalize, deduplicate."""
    return deduplicate(normalize_dates(clean_strings(df), dates), key, order_by)


def transform_counts(df: DataFrame, key: Sequence[str], dates: Sequence[str]) -> DataFrame:
    """Rows in, rows out and duplicates removed by :func:`to_silver`; reads the key columns only."""
    return copy_counts(normalize_dates(clean_strings(df.select(*key)), dates), key)
