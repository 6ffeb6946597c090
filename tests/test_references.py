"""Membership behind bitmaps, and rules across tables."""

import random

import pytest
from pyspark.sql import functions as F

from truegrain.operators import measures, references


@pytest.mark.parametrize("kind", ["int", "string", "date", "double", "decimal(9,2)"])
def test_prefiltered_membership(spark, kind):
    rng = random.Random(2)
    table = spark.createDataFrame([(rng.choice([None, *range(4000)]),) for _ in range(6000)], "v int")
    known = spark.createDataFrame([(i,) for i in [*range(0, 3000, 3), 5, 5, 6]] + [(None,)], "k int")
    cast = lambda df, c: df.select(F.date_add(F.lit("2020-01-01"), F.col(c)).alias(c) if kind == "date" else F.col(c).cast(kind).alias(c))
    table, known = cast(table, "v"), cast(known, "k")
    wanted = measures.reference_violations(table, "v", known, "k").first()
    assert wanted["violations"] > 1000
    for bitmaps in (1, 256):
        assert references.prefiltered_violations(table, "v", known, "k", bitmaps).first() == wanted
    if kind != "double":
        told = references.with_possible(table, "v", known, "k", "possible")
        inside = told.join(known.distinct(), F.col("v") == F.col("k"), "left_semi")
        assert inside.where("not possible").count() == 0
        assert told.where("possible").count() < 1.1 * inside.count()  # few others go on to the shuffle
        assert told.count() == table.count() and told.where("v is null and possible").count() == 0


def test_prefilter_of_little(spark):
    table, none = spark.createDataFrame([(1,), (None,)], "v int"), spark.createDataFrame([], "k int")
    assert tuple(references.prefiltered_violations(table, "v", none, "k").first()) == ("v", 2, 2, 0.0)
    assert tuple(references.prefiltered_violations(table.limit(0), "v", none, "k").first()) == ("v", 0, 0, 0.0)
    text = table.select(F.col("v").cast("string"))
    assert references.prefiltered_violations(text, "v", table.withColumnRenamed("v", "k"), "k").first()["violations"] == 1


def test_only_possible_values_are_shuffled(spark):
    """The plan groups after the bitmaps, which are broadcast, have been asked."""
    table, known = spark.range(1000).withColumnRenamed("id", "v"), spark.range(10).withColumnRenamed("id", "k")
    text = references.prefiltered_violations(table, "v", known, "k")._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange hashpartitioning") < text.index("__bits") and "BroadcastHashJoin [__at" in text


def test_cross_rules(spark):
    lines = spark.createDataFrame([(1, 10, "a"), (2, 5, "a"), (3, 1, "b"), (None, 1, "b"), (1, 99, None)], "order int, n int, kind string")
    orders = spark.createDataFrame([(1, 50), (2, 2), (2, 3), (None, 7)], "id int, most int")
    kinds = spark.createDataFrame([("a",)], "name string")
    tables = {
        "orders": references.Reference(orders, {"order": "id"}, ["most"]),
        "kinds": references.Reference(kinds, {"kind": "name"}, small=True),
        "unread": references.Reference(kinds, {"gone": "name"}),
    }
    rules = {
        "known": references.CrossRule(lambda row: row["orders_found"].is_present(), ["orders"]),
        "enough": references.CrossRule(lambda row: row["n"] <= row["orders_most"], ["orders"]),
        "kind": references.CrossRule(lambda row: row["kinds_found"].is_present(), ["kinds"]),
        "own": references.CrossRule(lambda row: row["n"] > 0),
    }
    got = {r["rule"]: (r["violations"], r["checked"]) for r in references.cross_violations(lines, tables, rules).collect()}
    assert got == {"known": (2, 5), "enough": (4, 5), "kind": (3, 5), "own": (0, 5)}
    assert references.with_references(lines, tables, {"own": rules["own"]}).columns == lines.columns
    with pytest.raises(ValueError, match="not declared"):
        references.with_references(lines, {}, rules)
