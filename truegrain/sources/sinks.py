"""Writing the layers and the histories. All writes use Spark's committed output."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from truegrain.functions import cells
from truegrain.operators.score import long_scores
from truegrain.session import known_rows, remove_path
from truegrain.sources import storage

RUN_COLUMNS = ("pipeline_name", "scored_at", "total_score", "status", "hard_block_triggered")


def _raw_options(writer: DataFrameWriter) -> DataFrameWriter:
    return (
        writer.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_raw(df: DataFrame, path: str) -> str:
    """Write texts as CSV with a header in every part, no value trimmed or altered."""
    _raw_options(df.write.mode("overwrite")).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    """Write or replace a layer."""
    df.write.mode("overwrite").parquet(path)
    return path


def layer(df: DataFrame, path: str) -> DataFrame:
    """Write or replace a layer and read it back; its schema is known, so no file is opened for it."""
    return df.sparkSession.read.schema(df.schema).parquet(write_parquet(df, path))


VERSIONS = "_versions"


def gold_versions(spark: SparkSession, path: str) -> list[str]:
    """The gold versions that were published, oldest first: a number and the folder that has the rows."""
    return [name for name in storage.child_names(spark, f"{path}/{VERSIONS}") if name[0] != "."]


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The gold table as last published."""
    published = gold_versions(spark, path)
    if not published:
        raise FileNotFoundError(f"no gold was published at {path}")
    return spark.read.parquet(f"{path}/{published[-1].partition('-')[2]}")


def load_gold(spark: SparkSession, silver: str, path: str, table: str | None = None, keep: int = 2) -> DataFrame:
    """Replace the gold table by what silver holds; one row: ``passed, records_loaded, records_due, table``.

    Rows go to a folder of their own. It is published, by a small file that is there at once, only if it has as many rows
    as silver gave; until then, and if the load fails at any point, readers have the version before. ``table`` is a view
    of the catalog, moved to the new version afterwards. The last ``keep`` versions stay for readers that have begun.
    """
    before = gold_versions(spark, path)
    number = int(before[-1].partition("-")[0]) + 1 if before else 1
    folder = f"rows-{uuid.uuid4().hex}"
    due = Observation()
    rows = spark.read.parquet(silver)
    rows.observe(due, F.count("*").alias("records_due")).write.parquet(f"{path}/{folder}")
    loaded = spark.read.schema(rows.schema).parquet(f"{path}/{folder}").count()
    passed = loaded == due.get["records_due"]
    if passed:
        storage.publish_text(spark, f"{path}/{VERSIONS}/{number:09d}-{folder}", folder)
        if table:
            spark.sql(f"CREATE OR REPLACE VIEW `{table}` AS SELECT * FROM parquet.`{path}/{folder}`")
        for old in before[: max(0, len(before) + 1 - keep)]:
            remove_path(spark, f"{path}/{VERSIONS}/{old}")
            remove_path(spark, f"{path}/{old.partition('-')[2]}")
    else:
        remove_path(spark, f"{path}/{folder}")
    line = [(passed, loaded, due.get["records_due"], table or path)]
    return known_rows(spark, line, "passed boolean, records_loaded long, records_due long, table string")


def _replacing(rows: DataFrame, *by: str) -> DataFrameWriter:
    """A writer that replaces the partitions that the rows belong to and leaves all others: a run written again is there once."""
    tidy = rows.repartition(*by).write.mode("overwrite")
    return tidy.option("partitionOverwriteMode", "dynamic").partitionBy(*by)


def _run_of(moment: Column) -> Column:
    """An instant as the name of a run, to the microsecond."""
    return F.date_format(moment, "yyyyMMdd'T'HHmmssSSSSSS")


def _long_runs(card: DataFrame) -> DataFrame:
    run_at = cells.instant(F.col("scored_at"), card.schema["scored_at"].dataType)
    return long_scores(card.withColumn("scored_at", run_at), list(RUN_COLUMNS)).withColumn("run", _run_of(F.col("scored_at")))


def append_scores(card: DataFrame, path: str, table: str | None = None) -> str:
    """Add score runs to the history, one row per run and dimension.

    The long form takes any set of dimensions, so runs with different ones share a table. A run is known by
    pipeline and instant and has a partition of its own: one that is written again, as by a job that is tried again,
    takes the place of what it wrote before. Under the name ``table`` in the catalog if one is given.
    """
    runs = _long_runs(card)
    _replacing(runs, "pipeline_name", "run").parquet(path)
    if table:
        spark = card.sparkSession
        if not spark.catalog.tableExists(table):
            columns = f"{HISTORY_SCHEMA}, run string"
            spark.sql(f"CREATE TABLE `{table}` ({columns}) USING parquet PARTITIONED BY (pipeline_name, run) LOCATION '{path}'")
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
    return path


def history_runs(spark: SparkSession, path: str, card: DataFrame) -> int:
    """How many of a scorecard's runs the history holds, read back from it with all their dimensions.

    The runs of one scorecard are named on the driver, so that only their partitions of the history are read.
    """
    counts = lambda rows: rows.groupBy("pipeline_name", "run").agg(F.count("*").alias("n")).collect()
    due = {(row["pipeline_name"], row["run"]): row["n"] for row in counts(_long_runs(card))}
    history = read_scores(spark, path, with_run=True)
    named = history.where(F.col("pipeline_name").isin(sorted({p for p, _ in due})) & F.col("run").isin(sorted({r for _, r in due})))
    return sum(due.get((row["pipeline_name"], row["run"])) == row["n"] for row in counts(named))


HISTORY_SCHEMA = (
    "scored_at timestamp, total_score double, status string, hard_block_triggered string, "
    "dimension string, score double, pipeline_name string"
)


def read_scores(spark: SparkSession, path: str, with_run: bool = False) -> DataFrame:
    """The history in long form. The schema is given, so a pipeline named ``2024`` stays text."""
    history = spark.read.schema(f"{HISTORY_SCHEMA}, run string").parquet(path)
    return history if with_run else history.drop("run")


def wide_scores(history: DataFrame, dimensions: list[str]) -> DataFrame:
    """The history with one row per run and a ``score_<dimension>`` column for each named."""
    return (
        history.groupBy(*RUN_COLUMNS)
        .agg(*(F.max(F.when(F.col("dimension") == d, F.col("score"))).alias(f"score_{d}") for d in dimensions))
    )


def append_scores_csv(card: DataFrame, path: str) -> str:
    """Add score runs to a wide CSV history; every run in it must have the same dimensions, and one written again is there once."""
    dims = [c for c in card.columns if c.startswith("score_")]
    run_at = cells.instant(F.col("scored_at"), card.schema["scored_at"].dataType)
    keys = (F.col("pipeline_name").alias("run_of"), _run_of(run_at).alias("run"))
    _raw_options(_replacing(card.select(*RUN_COLUMNS, *dims, *keys), "run_of", "run")).csv(path)
    return path


FRESHNESS_COLUMNS = (
    "table_name", "checked_at", "age_hours", "sla_hours", "severity", "is_breached", "message",
)


def append_freshness(results: DataFrame, path: str) -> str:
    """Add freshness checks to their history, once per table and instant; the latest timestamp itself is not kept."""
    checked_at = cells.instant(F.col("checked_at"), results.schema["checked_at"].dataType)
    rows = results.select(*FRESHNESS_COLUMNS, F.col("table_name").alias("checked_table"), _run_of(checked_at).alias("run"))
    _replacing(rows, "run", "checked_table").parquet(path)
    return path


def read_freshness(spark: SparkSession, path: str) -> DataFrame:
    """The history of freshness checks."""
    return spark.read.parquet(path).select(*FRESHNESS_COLUMNS)
