"""What the operators share: stored steps, row numbers, and words in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.session import fresh_path, remove_path

#: The white space between words, as a Java regular expression; all other characters belong to words.
SPACES = r"[\x20\x09-\x0D]+"


class Scratch:
    """A run's own folder under the shared one; each stored step is written once and read back.

    A stored step cuts lineage and survives lost executors. ``clear`` removes the folder once
    the caller has written its result; ``cleared_after`` does so for all folders made inside it.
    """

    _watching: list[list[Scratch]] = []

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = fresh_path(spark, label)
        self._steps = 0
        for made in Scratch._watching:
            made.append(self)

    def store(self, df: DataFrame) -> DataFrame:
        self._steps += 1
        path = f"{self.path}/{self._steps:03d}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        remove_path(self.spark, self.path)


@contextmanager
def cleared_after() -> Iterator[None]:
    """Write a result inside; the folders that operators made meanwhile are removed at the end."""
    made: list[Scratch] = []
    Scratch._watching.append(made)
    try:
        yield
    finally:
        Scratch._watching[:] = [x for x in Scratch._watching if x is not made]
        for scratch in made:
            scratch.clear()


def growing(df: DataFrame) -> DataFrame:
    """The side of a join that grows with the data: it is never broadcast.

    Spark judges stored tables by their compressed size, which can be many times less than what a broadcast holds.
    """
    return df.hint("merge")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with as many underscores after it as it takes to differ from all columns."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def only_rows(docs: DataFrame, rows: DataFrame, row: str) -> DataFrame:
    """The documents whose row id is in column ``row`` of ``rows``, with all their columns, whatever their names."""
    name = free_name(docs, row)
    return with_row_id(docs, name).join(growing(rows.select(F.col(row).alias(name))), name, "left_semi").drop(name)


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Name rows by their file and their place in it: a table of files read again, even split otherwise, as when
    executors have come or gone, gets the same names. Call it on the table itself, before columns are chosen.

    Rows that come from elsewhere are numbered as they come; then the rows must come alike on each reading.
    """
    file, place = F.hex(F.xxhash64("_metadata.file_path")), F.lpad(F.hex("_metadata.row_index"), 12, "0")
    try:
        return df.withColumn(name, F.concat(file, F.lit(":"), place))
    except AnalysisException:
        return df.withColumn(name, F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))


def ranked(scratch: Scratch, df: DataFrame, *order: Column, name: str) -> DataFrame:
    """Number rows from 0 in a total order, by a range sort: no task sees more than its range.

    Rows that tie in ``order`` share a range, so end the order with a unique column.
    """
    place, part = f"__{name}_place", f"__{name}_part"
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = scratch.store(
        ordered.withColumn(part, F.spark_partition_id()).withColumn(
            place, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        )
    )
    before, starts = 0, []
    for row in stored.groupBy(part).count().orderBy(part).collect():  # one row per partition
        starts.append((row[part], before))
        before += row["count"]
    offsets = scratch.spark.createDataFrame(starts, f"{part} int, __start long")
    return stored.join(F.broadcast(offsets), part).select(
        *df.columns, (F.col("__start") + F.col(place)).alias(name)
    )


def lowest(df: DataFrame, columns: list[str], n: int, total: int) -> DataFrame:
    """At most ``n`` of ``total`` rows, those of the least hash: a sample that is the same on each run.

    The rows are thinned by the hash first, so that little more than ``n`` of them meet in one task, whatever the number of tasks.
    """
    scale = 1 << 40
    mark = F.pmod(F.xxhash64(*columns), F.lit(scale))
    share = min(1.0, 1.2 * n / max(total, 1))
    return df.where(mark < int(share * scale)).orderBy(mark, *columns).limit(n)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def slices(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text; one row is never cut."""
    lengths = pa.compute.binary_length(batch.column(text).cast(pa.string()))
    sizes = pa.compute.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def blanking(letters: str) -> bytes:
    """A table for ``bytes.translate`` that lowers A-Z and blanks ASCII characters but those of the character class ``letters``.

    Bytes from 128 on stay, so what ``bytes.split`` then gives are the words of a text in UTF-8.
    """
    kept = re.compile(f"[{letters}]")
    lowered = (chr(i).lower() if "A" <= chr(i) <= "Z" else chr(i) for i in range(128))
    return bytes(ord(c) if kept.match(c) else 32 for c in lowered) + bytes(range(128, 256))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
