"""Every operator as a named query over the sample tables.

Each takes a session and the folder of the tables and returns a DataFrame. Computed
doubles are rounded to six places, clocks are pinned. Queries that write do so into a
path of their own under the cluster's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from truegrain.operators import (
    anomaly,
    duplicates,
    expect,
    freshness,
    gates,
    measures,
    partials,
    references,
    score,
    transform,
    trend,
)
from truegrain.plans import medallion, settings
from truegrain.session import fresh_path, stored
from truegrain.sources import files, landing, sinks, views

ORDERS_AS_OF = datetime(2001, 8, 1, 3, 0)
EVENTS_AS_OF = datetime(2024, 1, 31)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _round_scores(df: DataFrame) -> DataFrame:
    return rounded(df, *(c for c in df.columns if c.startswith("score_")))


# --- scans and sinks -----------------------------------------------------------------

RAW_COLUMNS = (
    "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "order_date",
    "order_date_text", "status", "customer_email", "quantity_text",
)
TEXT_COLUMNS = (
    "order_id", "customer_id", "product_id", "quantity_text", "order_date_text", "status",
    "customer_email",
)


def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the orders as a raw file has them: money with two digits, times to the second."""
    texts = {
        "quantity": F.col("quantity").cast("string"),
        "unit_price": F.col("unit_price").cast("decimal(18,2)").cast("string"),
        "total_amount": F.col("total_amount").cast("decimal(18,2)").cast("string"),
        "order_date": F.date_format("order_date", "yyyy-MM-dd HH:mm:ss"),
    }
    return views.dirty_orders(spark, sf_dir).select(*RAW_COLUMNS).withColumns(texts)


@query
def bronze_csv_scan(spark, sf_dir):
    path = sinks.write_raw(_raw_orders(spark, sf_dir), fresh_path(spark, "bronze"))
    return files.read_bronze(spark, path)


@query
def bronze_land(spark, sf_dir):
    source = sinks.write_raw(_raw_orders(spark, sf_dir), fresh_path(spark, "incoming"))
    target = fresh_path(spark, "bronze")
    landing.land(spark, source, target)
    return landing.read_landed(spark, target)


@query
def bronze_land_check(spark, sf_dir):
    """The landed files against their sources: records, and whether all lines are the same by digest."""
    source = sinks.write_raw(_raw_orders(spark, sf_dir), fresh_path(spark, "incoming"))
    target = fresh_path(spark, "bronze")
    checked = landing.landing_check(spark, landing.land(spark, source, target), target)
    records = F.sum(F.col("lines") - 1)  # each file has a header
    return checked.agg(records.alias("records"), F.every("same_lines").alias("same_lines"), (F.sum("bytes") > 0).alias("has_bytes"))


def _orders_run(spark: SparkSession, sf_dir: str) -> medallion.MedallionRun:
    day = F.col("order_date").cast("date").alias("order_date")
    raw = views.contract_orders(spark, sf_dir)
    source = sinks.write_raw(
        raw.select(*(day if c == "order_date" else c for c in raw.columns)), fresh_path(spark, "incoming")
    )
    run = medallion.run_orders(spark, source, fresh_path(spark, "orders"), ORDERS_AS_OF)
    if not run.completed:
        raise RuntimeError("the orders run was stopped by a gate")
    return run


@query
def medallion_silver(spark, sf_dir):
    return rounded(files.read_silver(spark, _orders_run(spark, sf_dir).silver), "total_amount")


@query
def medallion_gold(spark, sf_dir):
    return rounded(sinks.read_gold(spark, _orders_run(spark, sf_dir).gold), "total_amount")


def _broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed from a raw file in which every 13th key lacks its last cell and every 17th has one too many."""
    key = F.col("o_orderkey")
    cells = F.concat_ws(",", key, "o_custkey", "o_orderstatus")
    line = F.when(key % 13 == 0, F.concat_ws(",", key, "o_custkey")).when(key % 17 == 0, F.concat_ws(",", cells, F.lit("more")))
    lines = files.table(spark, sf_dir, "orders").select(F.coalesce(line, cells).alias("order_key,customer_key,status"))
    source, target = fresh_path(spark, "incoming"), fresh_path(spark, "bronze")
    lines.write.option("header", True).option("sep", "\x01").csv(source)  # one cell a line, its commas as they are
    landing.land(spark, source, target)
    return landing.read_landed(spark, target, malformed=medallion.MALFORMED)


@query
def malformed_lines(spark, sf_dir):
    return stored(medallion.malformed_lines(_broken_lines(spark, sf_dir)), "malformed")


@query
def malformed_gate(spark, sf_dir):
    """The lines that have their cells are written; the gate's row comes from counts taken on the way."""
    read, lines = _broken_lines(spark, sf_dir), Observation()
    fit = read.observe(lines, *medallion.malformed_counts()).where(F.col(medallion.MALFORMED).isNull())
    kept = spark.read.parquet(sinks.write_parquet(fit.drop(medallion.MALFORMED), fresh_path(spark, "typed")))
    row = gates.malformed_gate(gates.facts_row(spark, lines.get), 0.2, "gate_1")
    return rounded(row.crossJoin(F.broadcast(kept.agg(F.count("*").alias("kept_lines")))), "observed")  # one row each


@query
def gold_replaced(spark, sf_dir):
    """Gold loaded from pending orders and then from all: readers see the last published version alone."""
    gold = fresh_path(spark, "gold")
    orders = files.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for part in (orders.where("o_orderstatus = 'P'"), orders):
        sinks.load_gold(spark, sinks.write_parquet(part, fresh_path(spark, "silver")), gold)
    return sinks.read_gold(spark, gold)


@query
def silver_validate(spark, sf_dir):
    flagged = anomaly.detect(views.contract_orders(spark, sf_dir), settings.ORDERS_ANOMALY_COLUMNS)
    clean, _ = anomaly.quarantine(flagged)
    silver = sinks.write_parquet(medallion.orders_silver(clean), fresh_path(spark, "silver"))
    return expect.expectations(
        files.read_silver(spark, silver),
        settings.ORDERS_CONTRACT.required_columns(),
        settings.ORDERS_TYPES,
        settings.ORDERS_CONTRACT.non_nullable_columns(),
    )


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score history: each event type a pipeline, each of its days a scored run."""
    daily = measures.dimension_scores(
        views.event_days(spark, sf_dir), settings.EVENT_SPEC, EVENTS_AS_OF, by=["pipeline_name", "run_at"]
    )
    return score.with_score(daily, settings.EVENT_CONFIG).withColumnRenamed("run_at", "scored_at")


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history as a written table, as a run that follows it would find it."""
    return stored(event_history(spark, sf_dir), "history")


EVENT_DIMENSIONS = tuple(settings.EVENT_CONFIG.dimensions)
HISTORY_COLUMNS = (
    "pipeline_name", "scored_at", "total_score", "status", "hard_block_triggered",
    *(f"score_{d}" for d in EVENT_DIMENSIONS),
)


@query
def history_scan(spark, sf_dir):
    path = sinks.append_scores_csv(event_history(spark, sf_dir), fresh_path(spark, "history"))
    history = files.read_history_csv(spark, path, EVENT_DIMENSIONS)
    return _round_scores(files.history_of(history, "purchase"))


@query
def history_table_scan(spark, sf_dir):
    """The long history under a name in the catalog, one pipeline of it in time order."""
    path = fresh_path(spark, "history")
    table = f"score_history_{path.rsplit('-', 1)[1]}"
    sinks.append_scores(event_history(spark, sf_dir), path, table)
    return rounded(files.history_of(files.history_table(spark, table), "purchase"), "score")


@query
def score_history_append(spark, sf_dir):
    path = fresh_path(spark, "history")
    early = F.col("scored_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    runs = stored_history(spark, sf_dir)
    sinks.append_scores(runs.where(early), path)
    sinks.append_scores(runs.where(~early), path)
    return _round_scores(sinks.wide_scores(sinks.read_scores(spark, path), list(EVENT_DIMENSIONS)))


@query
def score_history_rerun(spark, sf_dir):
    """A history whose later half was first written with other scores and then again: each run is there once, as last written."""
    path = fresh_path(spark, "history")
    early = F.col("scored_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    runs = stored_history(spark, sf_dir)
    sinks.append_scores(runs, path)
    sinks.append_scores(runs.where(~early).withColumn("score_accuracy", F.lit(0.0)), path)
    sinks.append_scores(runs.where(~early), path)
    return _round_scores(sinks.wide_scores(sinks.read_scores(spark, path), list(EVENT_DIMENSIONS)))


@query
def freshness_history_append(spark, sf_dir):
    path = fresh_path(spark, "freshness")
    for as_of in (EVENTS_AS_OF, datetime(2024, 2, 1), EVENTS_AS_OF):  # the first check is written twice
        sinks.append_freshness(_freshness(spark, sf_dir, as_of), path)
    return sinks.read_freshness(spark, path)


# --- the six dimensions --------------------------------------------------------------


@query
def completeness(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir)
    return rounded(measures.completeness(orders, settings.ORDERS_SPEC.completeness), "completeness")


@query
def missing_by_column(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir)
    names = [*settings.ORDERS_SPEC.completeness, "discount_code"]
    return measures.violations(orders, measures.completeness_checks(orders, names))


VALIDITY_TYPES = {
    "quantity_text": "numeric", "unit_price": "numeric", "product_id": "string",
    "quantity": "string", "customer_email": "email", "status": "colour", "discount_code": "numeric",
}


@query
def validity(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir)
    return rounded(measures.validity(orders, VALIDITY_TYPES), "validity")


@query
def validity_by_column(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir)
    return measures.violations(orders, measures.validity_checks(orders, VALIDITY_TYPES))


ACCURACY_RANGES = {
    **settings.ORDERS_RANGES,
    "quantity_text": {"min": 3},
    "discount_code": {"max": 5},
}
ACCURACY_SETS = {"status": settings.ORDERS_STATUSES, "customer_id": ("N/A", "CUST-1")}


@query
def accuracy(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir)
    return rounded(measures.accuracy(orders, ACCURACY_RANGES, ACCURACY_SETS), "accuracy")


@query
def accuracy_by_column(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir)
    return measures.violations(orders, measures.accuracy_checks(orders, ACCURACY_RANGES, ACCURACY_SETS))


@query
def accuracy_reference_antijoin(spark, sf_dir):
    known = files.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    orders = files.table(spark, sf_dir, "orders")
    return rounded(measures.reference_violations(orders, "o_custkey", known, "c_custkey"), "accuracy")


@query
def accuracy_reference_prefiltered(spark, sf_dir):
    """The same membership, with values that a bitmap of the reference rules out counted before any shuffle."""
    known = files.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    orders = files.table(spark, sf_dir, "orders")
    return rounded(references.prefiltered_violations(orders, "o_custkey", known, "c_custkey"), "accuracy")


CONSISTENCY_RULES = {
    **settings.ORDERS_RULES,
    "priced_if_ordered": lambda row: ~((row["quantity"] > 0) & (row["unit_price"] <= 300)),
    "email_after_order": lambda row: row["customer_email"] >= row["order_id"],
    "known_status": "status in ('completed', 'pending', 'cancelled')",
}


@query
def consistency(spark, sf_dir):
    return rounded(
        measures.consistency(views.dirty_orders(spark, sf_dir), CONSISTENCY_RULES), "consistency"
    )


@query
def rule_violations(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir)
    return measures.violations(orders, measures.consistency_checks(orders, CONSISTENCY_RULES))


@query
def consistency_rules(spark, sf_dir):
    broken = measures.first_broken_rule(views.dirty_orders(spark, sf_dir), CONSISTENCY_RULES)
    return broken.select(
        "order_id", "quantity", "unit_price", "total_amount", "status", "customer_email", "broken_rule"
    )


# Which line status goes with which order status.
STATUS_PAIRS = (("F", "F"), ("O", "O"), ("P", "F"), ("P", "O"))


@query
def consistency_ship_order(spark, sf_dir):
    """Rules across two tables, and a pair of columns against a table of allowed pairs."""
    pairs = spark.createDataFrame(STATUS_PAIRS, "pair_order string, pair_line string")
    lines = files.table(spark, sf_dir, "lineitem").join(
        files.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    paired = lines.join(
        F.broadcast(pairs),  # four fixed rows
        (F.col("o_orderstatus") == F.col("pair_order")) & (F.col("l_linestatus") == F.col("pair_line")),
        "left",
    )
    rules = {
        "shipped_after_order": lambda row: row["o_orderdate"] <= row["l_shipdate"],
        "status_pair": lambda row: row["pair_order"].is_present(),
    }
    return measures.violations(paired, measures.consistency_checks(paired, rules), by=["l_returnflag"])


@query
def cross_table_rules(spark, sf_dir):
    """The same two rules, declared with the tables they read."""
    found = references.Reference
    tables = {
        "orders": found(files.table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}, ["o_orderdate", "o_orderstatus"]),
        "pairs": found(
            spark.createDataFrame(STATUS_PAIRS, "pair_order string, pair_line string"),
            {"orders_o_orderstatus": "pair_order", "l_linestatus": "pair_line"},
            small=True,
        ),
        "parts": found(files.table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"}, ["p_size"]),  # no rule reads it
    }
    rules = {
        "shipped_after_order": references.CrossRule(lambda row: row["orders_o_orderdate"] <= row["l_shipdate"], ["orders"]),
        "status_pair": references.CrossRule(lambda row: row["pairs_found"].is_present(), ["orders", "pairs"]),
    }
    return references.cross_violations(files.table(spark, sf_dir, "lineitem"), tables, rules, ["l_returnflag"])


@query
def uniqueness(spark, sf_dir):
    lines = files.table(spark, sf_dir, "lineitem")
    return rounded(measures.uniqueness(lines, ["l_orderkey", "l_linenumber"]), "uniqueness")


@query
def uniqueness_with_nulls(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir)
    return rounded(
        measures.uniqueness(orders, ["customer_id", "quantity"], by=["status"]), "uniqueness"
    )


@query
def timeliness(spark, sf_dir):
    events = files.table(spark, sf_dir, "events")
    return rounded(
        measures.timeliness(events, "ts", 24.0, EVENTS_AS_OF, by=["event_type"]), "timeliness"
    )


@query
def issue_profile(spark, sf_dir):
    return measures.issue_profile(
        views.shop_orders(spark, sf_dir),
        nulls=["customer_id", "price"],
        negatives=["quantity"],
        sets={"status": settings.SHOP_STATUSES},
        unique=["order_id"],
    )


@query
def duplicate_rows_first(spark, sf_dir):
    lines = files.table(spark, sf_dir, "lineitem")
    return duplicates.later_copies(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def duplicate_rows_all(spark, sf_dir):
    return duplicates.all_copies(files.table(spark, sf_dir, "documents"), ["text"]).select(
        "doc_id", "n_chars"
    )


# --- scores --------------------------------------------------------------------------


@query
def scorecard_transactions(spark, sf_dir):
    card = score.scorecard(
        views.transactions(spark, sf_dir),
        settings.TRANSACTION_SPEC,
        settings.TRANSACTION_CONFIG,
        ORDERS_AS_OF,
    )
    return _round_scores(card)


@query
def scorecard_orders_v1(spark, sf_dir):
    clean, _ = anomaly.split_anomalies(views.shop_orders(spark, sf_dir), settings.SHOP_ANOMALY_COLUMNS)
    return _round_scores(score.scorecard(clean, settings.SHOP_SPEC, settings.SHOP_CONFIG, ORDERS_AS_OF))


def _orders_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _ = anomaly.split_anomalies(
        views.contract_orders(spark, sf_dir), settings.ORDERS_ANOMALY_COLUMNS
    )
    return score.scorecard(clean, settings.ORDERS_SPEC, settings.ORDERS_CONFIG, ORDERS_AS_OF)


@query
def scorecard_orders(spark, sf_dir):
    return _round_scores(_orders_card(spark, sf_dir))


@query
def scorecard_by_group(spark, sf_dir):
    orders = views.contract_orders(spark, sf_dir).withColumn("order_status", F.col("status"))
    card = score.scorecard(
        orders, settings.ORDERS_SPEC, settings.ORDERS_CONFIG, ORDERS_AS_OF, by=["order_status"]
    )
    return _round_scores(card)


PARTS_SPEC = replace(
    settings.EVENT_SPEC, timestamp="ts", sla_hours=48.0, measured=(*settings.EVENT_SPEC.measured, "timeliness")
)


def _event_states(spark: SparkSession, sf_dir: str) -> str:
    """States of the events' days: half of them, then those that came since, then one day again."""
    path = fresh_path(spark, "states")
    events = views.event_days(spark, sf_dir)
    early = F.col("run_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    for arrived, again in ((events.where(early), ()), (events, ()), (events, ("2024-01-20 00:00:00",))):
        partials.measure_parts(arrived, PARTS_SPEC, "run_at", path, ["pipeline_name"], ["value"], again)
    return path


@query
def scorecard_from_parts(spark, sf_dir):
    """A scorecard put together from the states of daily partitions."""
    scored = partials.merged_scores(spark, _event_states(spark, sf_dir), PARTS_SPEC, EVENTS_AS_OF, ["pipeline_name"])
    return _round_scores(score.with_score(scored, settings.EVENT_CONFIG))


QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)


@query
def quantiles_from_parts(spark, sf_dir):
    """Quantiles from merged sketches of daily partitions, held against the ranks of all values."""
    marks = partials.merged_quantiles(spark, _event_states(spark, sf_dir), QUANTILES, ["pipeline_name"])
    checked = partials.rank_check(views.event_days(spark, sf_dir), marks, ["value"], QUANTILES, ["pipeline_name"])
    return checked.select("pipeline_name", "p", "rows", "within")


@query
def score_report(spark, sf_dir):
    return rounded(score.score_report(_orders_card(spark, sf_dir)), "score")


@query
def weighted_score(spark, sf_dir):
    return _weighted(spark, sf_dir).select("pipeline_name", "run_id", "total_score")


@query
def quality_status(spark, sf_dir):
    return _weighted(spark, sf_dir).select("pipeline_name", "run_id", "status", "hard_block_triggered")


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in long form against weights that name a dimension nobody measured."""
    runs = stored_history(spark, sf_dir).withColumnRenamed("scored_at", "run_id")
    dimensions = {
        "completeness": score.Dimension(0.30, 0.80),
        "timeliness": score.Dimension(0.05),
        "accuracy": score.Dimension(0.45, 0.84),
        "uniqueness": score.Dimension(0.20, 0.76),
    }
    types = ("click", "error", "purchase", "signup", "view")
    configs = [score.ScorerConfig(name, dimensions, 0.88, 0.85) for name in types]
    return score.weighted_score(
        score.long_scores(runs, ["pipeline_name", "run_id"]), score.config_frame(spark, configs)
    )


# --- outliers ------------------------------------------------------------------------


@query
def zscore_flags(spark, sf_dir):
    events = files.table(spark, sf_dir, "events").select("event_id", "value")
    return rounded(anomaly.detect_zscore(events, ["value"]), "z_score_value")


@query
def iqr_flags(spark, sf_dir):
    events = files.table(spark, sf_dir, "events").select("event_id", "value")
    return rounded(anomaly.detect_iqr(events, ["value"]), "iqr_lower_value", "iqr_upper_value")


@query
def iqr_bounds(spark, sf_dir):
    lines = files.table(spark, sf_dir, "lineitem")
    bounds = anomaly.iqr_bounds(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(bounds, "q1", "q3", "iqr_lower", "iqr_upper")


@query
def iqr_bounds_by_group(spark, sf_dir):
    events = files.table(spark, sf_dir, "events")
    bounds = anomaly.iqr_bounds(events, ["value", "user_id"], by=["event_type"])
    return rounded(bounds, "q1", "q3", "iqr_lower", "iqr_upper")


@query
def anomaly_by_group(spark, sf_dir):
    events = files.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    flagged = anomaly.detect(events, ["value"], "both", by=["event_type"])
    return rounded(flagged, "z_score_value", "iqr_lower_value", "iqr_upper_value")


@query
def anomaly_any(spark, sf_dir):
    flagged = anomaly.detect(
        views.dirty_orders(spark, sf_dir), ["quantity", "unit_price", "quantity_text", "discount_code"], "both"
    )
    return flagged.select(
        "order_id",
        "quantity",
        "unit_price",
        "quantity_text",
        *(c for c in flagged.columns if c.startswith("is_anomaly")),
    )


def _flagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.detect(views.contract_orders(spark, sf_dir), settings.ORDERS_ANOMALY_COLUMNS)


@query
def quarantine_clean(spark, sf_dir):
    return anomaly.quarantine(_flagged_orders(spark, sf_dir))[0]


@query
def quarantine_rows(spark, sf_dir):
    rows = anomaly.quarantine(_flagged_orders(spark, sf_dir))[1]
    return rounded(rows, *(c for c in rows.columns if c.startswith("iqr_")))


@query
def quarantine_rate(spark, sf_dir):
    return anomaly.quarantine_rate(_flagged_orders(spark, sf_dir), settings.ORDERS_QUARANTINE_LIMIT)


# --- transform -----------------------------------------------------------------------


@query
def clean_strings(spark, sf_dir):
    return transform.clean_strings(views.dirty_orders(spark, sf_dir).select(*TEXT_COLUMNS, "quantity"))


@query
def normalize_dates(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir).select("order_id", "order_date", "order_date_text")
    return transform.normalize_dates(orders, ["order_date", "order_date_text", "ship_date"])


@query
def dedup_orders(spark, sf_dir):
    orders = views.contract_orders(spark, sf_dir)
    return duplicates.deduplicate(orders, ["order_id"], ["order_date"])


@query
def transform_counts(spark, sf_dir):
    return transform.transform_counts(
        views.contract_orders(spark, sf_dir), ["customer_id", "order_date"], ["order_date"]
    )


# --- contract, expectations, gates ---------------------------------------------------


@query
def expect_types(spark, sf_dir):
    orders = views.dirty_orders(spark, sf_dir)
    texts = orders.select(
        "order_id",
        "quantity_text",
        F.col("quantity").cast("string").alias("quantity"),
        F.col("unit_price").cast("string").alias("unit_price"),
        "status",
    )
    types = {
        "order_id": "string", "status": "string", "quantity": "numeric", "unit_price": "string",
        "quantity_text": "numeric", "discount_code": "numeric",
    }
    return expect.expectations(texts, [], types, [], raw_text=True)


@query
def expect_not_null(spark, sf_dir):
    names = [*views.ORDER_COLUMNS, "discount_code"]
    return expect.expectations(views.contract_orders(spark, sf_dir), [], {}, names)


@query
def expectation_summary(spark, sf_dir):
    contract = settings.ORDERS_CONTRACT
    results = expect.expectations(
        views.contract_orders(spark, sf_dir),
        contract.required_columns(),
        settings.ORDERS_TYPES,
        contract.non_nullable_columns(),
    )
    return expect.expectation_summary(results)


@query
def contract_check(spark, sf_dir):
    checks = expect.contract_check(
        views.contract_orders(spark, sf_dir),
        settings.ORDERS_CONTRACT,
        settings.ORDERS_RANGES,
        {"status": settings.ORDERS_STATUSES},
    )
    return rounded(checks, "observed")


@query
def gate_results(spark, sf_dir):
    flagged = stored(_flagged_orders(spark, sf_dir), "flagged")
    clean, _ = anomaly.quarantine(flagged)
    bronze = views.contract_orders(spark, sf_dir)
    silver = medallion.write_silver(clean, fresh_path(spark, "silver"))
    changed = replace(settings.ORDERS_CONTRACT, breaking_change=True, previous_version="0.9.0", version="1.0.0")
    card = stored(score.scorecard(clean, settings.ORDERS_SPEC, settings.ORDERS_CONFIG, ORDERS_AS_OF), "card")
    history = sinks.append_scores(card, fresh_path(spark, "history"))
    rows = medallion.orders_gates(spark, bronze, flagged, card, silver, changed)
    loaded = sinks.load_gold(spark, silver.path, fresh_path(spark, "gold"))
    held = sinks.history_runs(spark, history, card)
    rows = rows.unionByName(gates.load_gate(loaded)).unionByName(gates.history_gate(spark, "gate_5", held))
    return rounded(rows, "observed")


@query
def scorecard_v1_trend(spark, sf_dir):
    """The earlier entry point: a scorecard per month of orders, appended to a history, and its trend."""
    clean, _ = anomaly.split_anomalies(views.shop_orders(spark, sf_dir), settings.SHOP_ANOMALY_COLUMNS)
    orders = clean.withColumn("month", F.date_trunc("month", "ordered_at").cast("timestamp_ntz"))
    measured = ("completeness", "validity", "accuracy", "consistency", "uniqueness")
    spec = replace(settings.SHOP_SPEC, measured=measured)
    monthly = score.scorecard(orders, spec, settings.SHOP_CONFIG, ORDERS_AS_OF, by=["month"])
    runs = monthly.drop("scored_at").withColumnRenamed("month", "scored_at")
    path = sinks.append_scores(runs, fresh_path(spark, "history"))
    dims = [c.removeprefix("score_") for c in runs.columns if c.startswith("score_")]
    history = sinks.wide_scores(sinks.read_scores(spark, path), dims)
    summary = trend.trend_summary(history)
    return rounded(summary, "first_rolling", "last_rolling", "trend_delta", "mean_baseline", "std_baseline")


# --- trend ---------------------------------------------------------------------------


@query
def rolling_avg_score(spark, sf_dir):
    averaged = trend.rolling_average(stored_history(spark, sf_dir))
    return rounded(averaged.select("pipeline_name", "scored_at", "total_score", "rolling_avg"), "rolling_avg")


@query
def score_baseline_anomaly(spark, sf_dir):
    flagged = trend.score_anomalies(stored_history(spark, sf_dir))
    kept = flagged.select(
        "pipeline_name", "scored_at", "total_score", "mean_baseline", "std_baseline", "z_score", "is_anomaly"
    )
    return rounded(kept, "mean_baseline", "std_baseline", "z_score")


@query
def trend_summary(spark, sf_dir):
    summary = trend.trend_summary(stored_history(spark, sf_dir))
    return rounded(
        summary, "first_rolling", "last_rolling", "trend_delta", "mean_baseline", "std_baseline"
    )


@query
def dimension_trend(spark, sf_dir):
    return rounded(trend.dimension_trend(stored_history(spark, sf_dir)), "avg_first", "avg_last", "delta")


@query
def trend_alert(spark, sf_dir):
    return trend.trend_alert(trend.trend_summary(stored_history(spark, sf_dir)))


# --- freshness -----------------------------------------------------------------------

SLAS: Sequence[freshness.FreshnessSLA] = (
    freshness.FreshnessSLA("click", 24.0),
    freshness.FreshnessSLA("error", 0.5, 0.5, 1.0),
    freshness.FreshnessSLA("purchase", 0.25),
    freshness.FreshnessSLA("signup", 1.0, 0.2, 2.0),
    freshness.FreshnessSLA("lineitem", 24.0),
    freshness.FreshnessSLA("user_profiles", 6.0),
)


def _freshness(spark: SparkSession, sf_dir: str, as_of: datetime) -> DataFrame:
    latest = freshness.latest_by(files.table(spark, sf_dir, "events"), "ts", "event_type").unionByName(
        freshness.latest_of(files.table(spark, sf_dir, "lineitem"), "l_shipdate", "lineitem")
    )
    return freshness.check(latest, freshness.sla_frame(spark, SLAS), as_of)


@query
def freshness_check(spark, sf_dir):
    return _freshness(spark, sf_dir, EVENTS_AS_OF)


@query
def freshness_alert_routes(spark, sf_dir):
    return freshness.alert_routes(_freshness(spark, sf_dir, EVENTS_AS_OF))


@query
def freshness_from_parts(spark, sf_dir):
    """Freshness of the events' types from the states of their days, without their rows."""
    latest = partials.latest_of_parts(spark, _event_states(spark, sf_dir), "pipeline_name")
    slas = freshness.sla_frame(spark, [s for s in SLAS if s.table_name not in ("lineitem", "user_profiles")])
    return freshness.check(latest, slas, EVENTS_AS_OF)
