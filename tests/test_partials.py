"""States of partitions merged, against the whole table."""

import random
import shutil
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from truegrain.operators import freshness, measures, partials, score
from truegrain.operators.measures import MeasureSpec
from truegrain.session import fresh_path

NOW = datetime(2026, 8, 4, 14, 0)
SPEC = MeasureSpec(
    completeness=("a", "s", "gone"), validity={"s": "numeric"}, ranges={"a": {"min": 2}}, sets={"s": ("1", "x")},
    rules={"r": lambda row: row["a"] < 8}, unique=("a", "s"), timestamp="at", sla_hours=100.0,
)
CONFIG = score.ScorerConfig("t", {"completeness": score.Dimension(0.5), "uniqueness": score.Dimension(0.5, 0.9)})


def rows(seed, days):
    rng = random.Random(seed)
    for _ in range(400):
        day = rng.choice(days)
        s = rng.choice([None, "1", "x", "N/A", "7"])
        yield (day, rng.choice(["g", "h", None]), rng.choice([None, *range(12)]), s, datetime(2026, 8, rng.randint(1, 4)), rng.gauss(0, 1))


SCHEMA = "day string, g string, a int, s string, at timestamp_ntz, v double"


def same(a, b):
    """Counts are whole numbers, so scores are the same to the last digit."""
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_merged_card_is_the_whole_card(spark, tmp_path, by):
    """Old partitions are not read again: their files are gone when new ones are measured."""
    table, states = str(tmp_path / "t"), fresh_path(spark, "states")
    every = spark.createDataFrame(list(rows(1, ["01", "02", "a/b c", None, ""])), SCHEMA)
    late = spark.createDataFrame(list(rows(2, ["03", "01x"])), SCHEMA)
    every.write.partitionBy("day").parquet(table)
    whole = spark.read.parquet(table).unionByName(late, allowMissingColumns=True)
    kept = whole.select(*SCHEMA.replace(",", " ").split()[::2])
    kept.write.parquet(str(tmp_path / "whole"))
    whole = spark.read.parquet(str(tmp_path / "whole"))
    read = partials.measure_parts(spark.read.parquet(table), SPEC, "day", states, by, ["v"])
    assert read == sorted(["01", "02", "a/b c", partials.NO_PART])
    for folder in (tmp_path / "t").iterdir():
        if folder.is_dir():
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"broken")
    schema = spark.read.parquet(str(tmp_path / "whole")).schema
    late.write.mode("append").partitionBy("day").parquet(table)
    assert partials.measure_parts(spark.read.schema(schema).parquet(table), SPEC, "day", states, by, ["v"]) == ["01x", "03"]
    assert partials.measure_parts(spark.read.schema(schema).parquet(table), SPEC, "day", states, by, ["v"]) == []
    merged = partials.merged_scorecard(spark, states, SPEC, CONFIG, NOW, by)
    same(merged, score.scorecard(whole, SPEC, CONFIG, NOW, by))
    marks = partials.merged_quantiles(spark, states, (0.1, 0.5), by)
    assert all(r["within"] for r in partials.rank_check(whole, marks, ["v"], (0.1, 0.5), by).collect())
    assert marks.agg(F.sum("n")).first()[0] == whole.count()


def test_a_partition_measured_again_replaces_its_state(spark):
    states = fresh_path(spark, "states")
    first, second = (spark.createDataFrame(list(rows(n, ["01", "02"])), SCHEMA) for n in (3, 4))
    partials.measure_parts(first, SPEC, "day", states)
    mended = first.where("day = '01'").unionByName(second.where("day = '02'"))
    assert partials.measure_parts(mended, SPEC, "day", states) == []
    assert partials.measure_parts(mended, SPEC, "day", states, again=["02"]) == ["02"]
    same(partials.merged_scores(spark, states, SPEC, NOW), measures.dimension_scores(mended, SPEC, NOW))


def test_latest_comes_from_states_alone(spark):
    states = fresh_path(spark, "states")
    table = spark.createDataFrame(list(rows(7, ["01", "02"])), SCHEMA)
    partials.measure_parts(table, SPEC, "day", states, ["g"])
    for found, wanted in (
        (partials.latest_of_parts(spark, states, "g"), freshness.latest_by(table, "at", "g")),
        (partials.latest_of_parts(spark, states, "g", "t"), freshness.latest_of(table, "at", "t")),
    ):
        same(found, wanted)
        assert all(f"{states}/facts" in f for f in found.inputFiles())


def test_a_broken_run_is_measured_again(spark):
    """Keys without facts, as a run that stopped between them leaves, count for nothing."""
    states = fresh_path(spark, "states")
    table = spark.createDataFrame(list(rows(5, ["01", "02"])), SCHEMA)
    partials.measure_parts(table, SPEC, "day", states)
    shutil.rmtree(f"{states}/facts")
    assert partials.measure_parts(table, SPEC, "day", states) == ["01", "02"]
    same(partials.merged_scores(spark, states, SPEC, NOW), measures.dimension_scores(table, SPEC, NOW))


def test_states_of_other_checks_do_not_mix(spark):
    states = fresh_path(spark, "states")
    table = spark.createDataFrame(list(rows(6, ["01", "02"])), SCHEMA)
    partials.measure_parts(table.where("day = '01'"), SPEC, "day", states)
    partials.measure_parts(table, replace(SPEC, completeness=("s", "a", "gone")), "day", states)
    with pytest.raises(ValueError, match="different checks"):
        partials.merged_scores(spark, states, SPEC, NOW)
    with pytest.raises(ValueError, match="rename"):
        partials.measure_parts(table.withColumnRenamed("g", "part"), SPEC, "day", states, ["part"])


def test_empty_table_leaves_no_state(spark):
    states = fresh_path(spark, "states")
    assert partials.measure_parts(spark.createDataFrame([], SCHEMA), SPEC, "day", states, (), ["v"]) == []
    assert partials.measured_parts(spark, states) == []
