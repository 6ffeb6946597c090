"""Equi-joins on keys that may be null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.functions.cells import column


def join_on(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    also: Column | None = None,
    broadcast: bool = False,
) -> DataFrame:
    """Join with null keys equal to each other; the result has the left keys once.

    Columns other than the keys must differ in name, so ``also`` can add a condition on
    both sides by name. ``broadcast`` is for right sides known to be small; otherwise
    Spark chooses by measured size.
    """
    marked = right.select(
        *(column(k).alias(f"__right_{k}") for k in keys),
        *(column(c) for c in right.columns if c not in keys),
    )
    if broadcast:
        marked = F.broadcast(marked)
    condition = F.lit(True)
    for k in keys:
        condition = condition & column(k).eqNullSafe(column(f"__right_{k}"))
    if also is not None:
        condition = condition & also
    joined = left.join(marked, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*(f"__right_{k}" for k in keys))
