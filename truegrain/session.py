"""Session settings the engine counts on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def build_session(app_name: str = "truegrain", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides or adds settings.

    Master, memory and shuffle width are left to the cluster unless given.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call-site lookup per column
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A session on one machine that names none gets a temporary folder set as its own; a
    cluster has to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="truegrain-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/truegrain/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result to a path of its own in the shared folder and read it back."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path through the file system it names, local or remote."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def known_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows that the driver already holds, as a local relation: Spark reads it without Python tasks and knows its size."""
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, to_arrow_schema(fields))], fields.names), fields)
