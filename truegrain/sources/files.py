"""Reading tables, raw text files and histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.functions import cells
from truegrain.operators.expect import infer_families

# Texts a raw file uses for a missing cell.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def csv_reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    """How raw files are read: nothing trimmed, an empty cell null and a quoted one empty."""
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "\x00")  # stands for a bare empty cell, so that a quoted "" stays text
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def read_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV with a header, every column as the text it holds.

    Files are split between tasks unless ``multi_line`` is set, which quoted line breaks need.
    """
    return csv_reader(spark, multi_line).option("inferSchema", False).csv(path)


def null_tokens(df: DataFrame) -> DataFrame:
    """Turn the texts that stand for a missing cell into null."""
    tokens = [F.lit(token) for token in NA_TOKENS]
    return df.select(
        *(
            F.when(~cells.column(f.name).isin(tokens), cells.column(f.name)).alias(f.name)
            if cells.is_text(f.dataType)
            else cells.column(f.name)
            for f in df.schema.fields
        )
    )


def _typed(name: str, dtype: T.DataType) -> Column:
    """A text cell as its type. A whole number may be written with a fraction, as 3.0."""
    value = cells.column(name)
    if isinstance(dtype, T.IntegralType):
        as_number = cells.number(name, T.StringType())
        whole = F.when(as_number == F.floor(as_number), as_number.try_cast(dtype))
        return F.coalesce(value.try_cast(dtype), whole)
    if isinstance(dtype, T.FractionalType):
        return cells.number(name, T.StringType()).cast(dtype)
    return value.try_cast(dtype)


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the text columns a schema names; a cell that does not fit becomes null."""
    given = {f.name: f.dataType for f in schema.fields}
    return raw.select(
        *(_typed(c, given[c]).alias(c) if c in given else cells.column(c) for c in raw.columns)
    )


def read_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """A raw CSV with missing cells as null and numbers as numbers.

    With a ``schema`` its columns are cast (a cell that does not fit becomes null); columns
    beyond it stay text. Without one, ``infer`` reads the file once more to find the columns
    that hold only numbers. With neither, all columns stay text.
    """
    raw = null_tokens(read_raw(spark, path, multi_line))
    if schema is not None:
        return typed(raw, schema)
    if not infer:
        return raw
    families = infer_families(raw)
    return raw.select(
        *(
            cells.number(c, T.StringType()).alias(c) if families[c] == "numeric" else cells.column(c)
            for c in raw.columns
        )
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def history_table(spark: SparkSession, table: str) -> DataFrame:
    """A score history kept under a name in the catalog, one row per run and dimension."""
    return spark.table(table).drop("run")


def history_of(history: DataFrame, pipeline_name: str) -> DataFrame:
    """One pipeline's score history in time order."""
    return history.where(F.col("pipeline_name") == pipeline_name).orderBy("scored_at")


def read_history_csv(spark: SparkSession, path: str, dimensions: Sequence[str]) -> DataFrame:
    """A wide score history kept as CSV; times are UTC, an empty hard block is null."""
    scores = ", ".join(f"score_{d} double" for d in dimensions)
    schema = (
        "pipeline_name string, scored_at timestamp, total_score double, status string, "
        f"hard_block_triggered string, {scores}"
    )
    read = csv_reader(spark, False).schema(schema).csv(path).drop("run_of", "run")
    return read.withColumn("hard_block_triggered", F.nullif("hard_block_triggered", F.lit("")))


def file_times(spark: SparkSession, path: str, table_name: str) -> DataFrame:
    """``table_name, latest_timestamp``: when the newest file of a table was written.

    File listings only: no file is opened. Null where there is no such path.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "modificationTime timestamp")
    return files.agg(F.max("modificationTime").alias("latest_timestamp")).select(
        F.lit(table_name).alias("table_name"), "latest_timestamp"
    )
