"""Weighted scores, hard blocks and PASS / WARN / FAIL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.functions.cells import sql_text
from truegrain.operators import measures
from truegrain.operators.measures import MeasureSpec
from truegrain.session import known_rows


@dataclass(frozen=True)
class Dimension:
    """A weight, and a floor under which the whole run fails."""

    weight: float
    hard_block: float | None = None


@dataclass(frozen=True)
class ScorerConfig:
    """Weights of one pipeline. They must sum to 1."""

    pipeline_name: str
    dimensions: Mapping[str, Dimension]
    pass_threshold: float = 0.80
    warn_threshold: float = 0.60

    def __post_init__(self):
        total = sum(d.weight for d in self.dimensions.values())
        if abs(total - 1.0) >= 1e-9:
            raise ValueError(f"dimension weights must sum to 1.0, got {total:.4f}")


CONFIG_SCHEMA = (
    "pipeline_name string, ord int, dimension string, weight double, hard_block double, "
    "pass_threshold double, warn_threshold double"
)


def config_frame(spark: SparkSession, configs: Sequence[ScorerConfig]) -> DataFrame:
    """Configurations as rows, for scoring many pipelines in one job."""
    rows = [
        (c.pipeline_name, i, name, d.weight, d.hard_block, c.pass_threshold, c.warn_threshold)
        for c in configs
        for i, (name, d) in enumerate(c.dimensions.items())
    ]
    return known_rows(spark, rows, CONFIG_SCHEMA)


def block_message(dimension: Column, score: Column, floor: Column) -> Column:
    return F.format_string("%s score %.2f below hard block %s", dimension, score, floor.cast("string"))


def status(total: Column, block: Column, pass_at: Column, warn_at: Column) -> Column:
    """A hard block fails the run whatever the total, which is compared unrounded."""
    return (
        F.when(block.isNotNull(), "FAIL")
        .when(total >= pass_at, "PASS")
        .when(total >= warn_at, "WARN")
        .otherwise("FAIL")
    )


def weighted_score(scores: DataFrame, config: DataFrame) -> DataFrame:
    """Score runs held in long form (``pipeline_name, run_id, dimension, score``).

    The configuration drives the result: a dimension without a score counts as 0.0,
    and a score outside the configuration is ignored. A run of a pipeline without a configuration
    stays, with status UNCONFIGURED and no total. Returns one row per pipeline and
    run: ``pipeline_name, run_id, total_score, status, hard_block_triggered``.

    A run's few scores are gathered in its row; the configuration, which people write, is broadcast.
    """
    runs = scores.groupBy("pipeline_name", "run_id").agg(
        F.collect_list(F.struct("dimension", "score")).alias("__scores")
    )
    weights = F.sort_array(F.collect_list(F.struct("ord", "dimension", "weight", "hard_block")))
    plans = config.groupBy("pipeline_name").agg(
        weights.alias("__weights"),
        F.first("pass_threshold").alias("pass_threshold"),
        F.first("warn_threshold").alias("warn_threshold"),
    )
    due = runs.join(F.broadcast(plans), "pipeline_name", "left")

    def score_of(dimension: Column) -> Column:
        own = F.filter("__scores", lambda s: s["dimension"] == dimension)
        return F.aggregate(own, F.lit(0.0), lambda total, s: total + F.coalesce(s["score"], F.lit(0.0)))

    lines = F.transform(
        "__weights",
        lambda w: F.struct(
            w["dimension"].alias("dimension"),
            w["weight"].alias("weight"),
            w["hard_block"].alias("floor"),
            score_of(w["dimension"]).alias("score"),
        ),
    )
    # Parts are added up in configuration order, so the last digit never depends on task order.
    told = due.withColumn("__lines", lines).withColumn(
        "__total", F.aggregate("__lines", F.lit(0.0), lambda total, x: total + x["score"] * x["weight"])
    )
    blocked = F.filter("__lines", lambda x: F.coalesce(x["score"] < x["floor"], F.lit(False)))
    first = F.get(blocked, F.lit(0))
    block = F.when(F.size(blocked) > 0, block_message(first["dimension"], first["score"], first["floor"]))
    judged = told.withColumn("hard_block_triggered", block)
    known = F.col("__weights").isNotNull()
    verdict = status(
        F.col("__total"), F.col("hard_block_triggered"), F.col("pass_threshold"), F.col("warn_threshold")
    )
    return judged.select(
        "pipeline_name",
        "run_id",
        F.when(known, F.round(F.col("__total") * 100, 2)).alias("total_score"),
        F.when(known, verdict).otherwise("UNCONFIGURED").alias("status"),
        "hard_block_triggered",
    )


def with_score(scored: DataFrame, config: ScorerConfig) -> DataFrame:
    """Add ``total_score, status, hard_block_triggered`` beside ``score_<dimension>`` columns.

    The same rules as :func:`weighted_score`, as plain expressions on each row: no join,
    no shuffle.
    """
    total: Column = F.lit(0.0)
    blocks = []
    for name, dimension in config.dimensions.items():
        present = f"score_{name}" in scored.columns
        score = F.coalesce(F.col(f"score_{name}"), F.lit(0.0)) if present else F.lit(0.0)
        total = total + score * F.lit(dimension.weight)
        if dimension.hard_block is not None:
            floor = F.lit(float(dimension.hard_block))
            blocks.append(F.when(score < floor, block_message(F.lit(name), score, floor)))
    block = F.coalesce(*blocks, F.lit(None).cast("string"))
    kept = scored.withColumns({"__total": total, "hard_block_triggered": block})
    verdict = status(
        F.col("__total"),
        F.col("hard_block_triggered"),
        F.lit(config.pass_threshold),
        F.lit(config.warn_threshold),
    )
    return kept.withColumns(
        {"total_score": F.round(F.col("__total") * 100, 2), "status": verdict}
    ).drop("__total")


def scorecard(
    df: DataFrame,
    spec: MeasureSpec,
    config: ScorerConfig,
    as_of: datetime,
    by: Sequence[str] = (),
) -> DataFrame:
    """Measure and score a table, whole or per group.

    Columns: ``pipeline_name, by, scored_at, row_count, score_<dimension>..., total_score,
    status, hard_block_triggered``.
    """
    taken = {"pipeline_name", "scored_at", "row_count", "total_score", "status", "hard_block_triggered"}
    if taken & set(by):
        raise ValueError(f"rename the grouping columns {sorted(taken & set(by))}: the scorecard uses them")
    scored = with_score(measures.dimension_scores(df, spec, as_of, by), config)
    dims = [c for c in scored.columns if c.startswith("score_")]
    return scored.select(
        F.lit(config.pipeline_name).alias("pipeline_name"),
        *by,
        measures.as_of_column(as_of).alias("scored_at"),
        "row_count",
        *dims,
        "total_score",
        "status",
        "hard_block_triggered",
    )


def long_scores(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``score_<dimension>`` columns as rows: ``keys, dimension, score``."""
    dims = [c for c in scored.columns if c.startswith("score_")]
    lines = ", ".join(f"{sql_text(c.removeprefix('score_'))}, `{c}`" for c in dims)
    return scored.selectExpr(
        *(f"`{k}`" for k in keys), f"stack({len(dims)}, {lines}) AS (dimension, score)"
    )


def score_report(card: DataFrame, keys: Sequence[str] = ("pipeline_name",)) -> DataFrame:
    """The report lines of a scorecard: a 20-step bar and a percentage per dimension."""
    full, empty = "█", "░"
    lines = long_scores(
        card, [*keys, "row_count", "total_score", "status", "hard_block_triggered"]
    )
    steps = F.floor(F.col("score") * 20).cast("int")
    return lines.withColumns(
        {
            "bar": F.concat(F.repeat(F.lit(full), steps), F.repeat(F.lit(empty), F.lit(20) - steps)),
            "percent": F.round(F.col("score") * 100, 1),
        }
    )
