"""Exact quantiles with linear interpolation, without gathering a column in one task.

1. Rows are counted per distinct value, partly on the map side: a hot value is one row per map task.
2. The counted values are sorted over the cluster by group and value, in ranges of equal size, and
   written to the shared folder. As they are distinct, no range is hot, whatever the distribution.
3. The sums of the ranges say which range holds a wanted rank; only there a running sum over the
   values of the range finds it.

Wanted ranks travel as rows, so their number costs next to nothing. The same steps are taken at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from truegrain.functions import cells
from truegrain.functions.cells import column
from truegrain.functions.joins import join_on
from truegrain.session import stored


def numbers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The numeric cells as rows ``by, column_name, value``; what is no number is left out."""
    lines = [
        F.struct(
            F.lit(name).alias("column_name"), cells.number(name, df.schema[name].dataType).alias("value")
        )
        for name in columns
    ]
    return df.select(*by, F.inline(F.array(*lines))).where(F.col("value").isNotNull())


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles per column, in long form: ``by, column_name, q0, q1, ...``.

    A group or column that holds no number has no row. The table is read when this is called.
    """
    group = [*by, "column_name"]
    order = [column(c) for c in (*group, "value")]
    counted = numbers(df, columns, by).groupBy(*order).agg(F.count("*").alias("n"))
    ranges = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    values = stored(ranges.withColumn("__range", F.spark_partition_id()), "quantiles")

    sums = values.groupBy(*group, "__range").agg(F.sum("n").alias("held"))
    ahead = W.partitionBy(*group).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumns(
        {
            "before": F.coalesce(F.sum("held").over(ahead), F.lit(0)),
            "total": F.sum("held").over(W.partitionBy(*group)),
        }
    )
    # Two ranks a probability: the one at or below its place, and the next.
    place = F.col("p") * (F.col("total") - 1)
    low = F.floor(place)
    marks = F.array(
        *(F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities))
    )
    wanted = sums.select(*group, "__range", "held", "before", "total", F.inline(marks)).withColumn(
        "rank", F.explode(F.array_distinct(F.array(low, F.least(low + 1, F.col("total") - 1))))
    )
    inside = wanted.where(F.col("rank").between(F.col("before"), F.col("before") + F.col("held") - 1))
    inside = inside.withColumn("__nth", F.col("rank") - F.col("before"))

    upto = W.partitionBy(*group, "__range").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = values.withColumn("upto", F.sum("n").over(upto))
    here = (F.col("__nth") < F.col("upto")) & (F.col("__nth") >= F.col("upto") - F.col("n"))
    found = join_on(running, inside, [*group, "__range"], also=here)

    ends = found.groupBy(*group, "i", "p", "total").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    part = place - low
    mark = F.when((part == 0) | (F.col("a") == F.col("b")), F.col("a"))
    told = ends.withColumn("mark", mark.otherwise(F.col("a") + (F.col("b") - F.col("a")) * part))
    wide = [F.max(F.when(F.col("i") == i, F.col("mark"))).alias(f"q{i}") for i in range(len(probabilities))]
    return told.groupBy(*group).agg(*wide)


def _marks(probabilities: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(p)) for p in probabilities))


def _listed(values: DataFrame, aggregate: Column, group: Sequence[str], n: int) -> DataFrame:
    found = values.groupBy(*group).agg(aggregate.alias("marks"))
    return found.select(*group, *(F.col("marks")[i].alias(f"q{i}") for i in range(n)))


def sketched_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10000,
) -> DataFrame:
    """As :func:`exact_quantiles` in one pass, each within ``rows / accuracy`` ranks."""
    sketch = F.percentile_approx("value", _marks(probabilities), F.lit(accuracy))
    return _listed(numbers(df, columns, by), sketch, [*by, "column_name"], len(probabilities))
