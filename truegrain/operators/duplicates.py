"""Repeated keys: marking them and removing them, without putting a hot key in one task.

Null keys equal each other throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from truegrain.functions.cells import column, is_text


def _others(df: DataFrame, subset: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in subset]


def _ordering(df: DataFrame, subset: Sequence[str], order_by: Sequence[str] | None) -> list[str]:
    """The columns that rank copies: those asked for, then the rest, so that ties are identical rows."""
    chosen = list(order_by or ())
    return chosen + [c for c in _others(df, subset) if c not in chosen]


def deduplicate(
    df: DataFrame, subset: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the least by ``order_by``, then by the other columns.

    Spark turns ``row_number() = 1`` into a limit per key on the map side, so a hot key
    sends one row per map task through the shuffle.
    """
    order = _ordering(df, subset, order_by)
    if not order:
        return df.distinct()
    rank = F.row_number().over(
        W.partitionBy(*(column(c) for c in subset)).orderBy(*(column(c) for c in order))
    )
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def _suspects(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows whose key may be repeated, judged by a hash of it.

    Text keys can be long, so hashes are counted first and only rows whose hash occurs
    twice go through a shuffle whole. Equal keys have equal hashes, so none is lost.
    """
    if not any(is_text(df.schema[c].dataType) for c in subset):
        return df
    hashed = df.withColumn("__hash", F.xxhash64(*(column(c) for c in subset)))
    twice = hashed.groupBy("__hash").agg(F.count("*").alias("__n")).where(F.col("__n") > 1)
    return hashed.join(twice.select("__hash"), "__hash", "left_semi").drop("__hash")


def _placed(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, WindowSpec]:
    """Add ``__nth``, a row's place among those of its key in one input partition, and the window of its key's leaders.

    A partition's first row of a key is its leader. Leaders of a key meet in one window, which so has a
    row per partition at most; all other rows stay apart by partition. Rows travel as they are, so a hot key
    needs no treatment of its own and no cell is changed.
    """
    keys = [column(c) for c in subset]
    by_order = [column(c) for c in order] or [F.col("__part")]
    parted = df.withColumn("__part", F.spark_partition_id())
    nth = F.row_number().over(W.partitionBy(*keys, "__part").orderBy(*by_order))
    numbered = parted.withColumn("__nth", nth)
    slot = F.when(F.col("__nth") == 1, F.lit(-1)).otherwise(F.col("__part"))
    return numbered.withColumn("__slot", slot), W.partitionBy(*keys, "__slot").orderBy(*by_order, "__part")


def all_copies(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Every row of a key that occurs more than once."""
    numbered, leaders = _placed(_suspects(df, subset), subset, ())
    whole = leaders.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    local = W.partitionBy(*(column(c) for c in subset), "__part")
    many = numbered.withColumn("__here", F.count("*").over(local)).withColumn("__leaders", F.count("*").over(whole))
    kept = many.where((F.col("__here") > 1) | (F.col("__leaders") > 1))
    return kept.select(*(column(c) for c in df.columns))


def later_copies(df: DataFrame, subset: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Every row of a key but its first, by the order of :func:`deduplicate`.

    A row that isn't its partition's first of the key is a later copy; of the partitions' firsts all but one are.
    """
    numbered, leaders = _placed(df, subset, _ordering(df, subset, order_by))
    led = numbered.withColumn("__led", F.row_number().over(leaders))
    kept = led.where((F.col("__nth") > 1) | (F.col("__led") > 1))
    return kept.select(*(column(c) for c in df.columns))


def copy_counts(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows in, rows out and rows removed by :func:`deduplicate`, without doing it."""
    groups = df.groupBy(*(column(c) for c in subset)).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input_records"),
        F.count("*").alias("output_records"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_removed"),
    )
