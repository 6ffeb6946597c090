"""Every registered query against its SQL, and the plans of the main operators."""

import os
import re

import pytest

import __spark_entry__ as contract
from tests.compare import connect, mismatch
from truegrain.operators import anomaly, duplicates, measures, quantiles, score, trend
from truegrain.plans import catalog, settings
from truegrain.sources import files, views

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_matches_its_sql(spark, oracle, name):
    assert mismatch(contract.queries()[name](spark, SF_DIR), oracle, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 1


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


WRITING = {
    "bronze_csv_scan", "bronze_land", "medallion_silver", "medallion_gold", "silver_validate", "gate_results",
    "history_scan", "history_table_scan", "score_history_append", "freshness_history_append", "scorecard_v1_trend",
    "bronze_land_check", "malformed_lines", "malformed_gate", "gold_replaced", "score_history_rerun", "scorecard_from_parts", "quantiles_from_parts", "freshness_from_parts",
}


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in WRITING])
def test_plans_stay_in_spark(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert "Python" not in text
    assert "CartesianProduct" not in text
    assert not re.search(r"Exchange SinglePartition.*\n.*(Sort|Window)", text)


def test_row_measures_read_the_table_once(spark):
    orders = views.contract_orders(spark, SF_DIR)
    checks = measures.row_checks(orders, settings.ORDERS_SPEC)
    assert plan(measures.violations(orders, checks)).count("FileScan") == 1
    card = score.scorecard(orders, settings.ORDERS_SPEC, settings.ORDERS_CONFIG, catalog.ORDERS_AS_OF)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(card))
    assert len(scans) == 2
    assert any(re.fullmatch(r"o_orderkey#\d+L", s) for s in scans)  # the key branch reads the key


def test_quantiles_come_from_sorted_counts(spark):
    lines = files.table(spark, SF_DIR, "lineitem")
    text = plan(quantiles.exact_quantiles(lines, ["l_tax"], (0.25, 0.75)))
    assert "percentile" not in text and "l_tax" not in text  # the table was read once, before
    assert not re.search("SinglePartition|Cartesian", text)


def test_first_rows_are_limited_before_the_shuffle(spark):
    lines = files.table(spark, SF_DIR, "lineitem")
    for frame in (
        duplicates.deduplicate(lines, ["l_orderkey"]),
        trend.first_rows(catalog.event_history(spark, SF_DIR), 7),
        trend.last_rows(catalog.event_history(spark, SF_DIR), 7),
    ):
        assert re.search(r"WindowGroupLimit .* Partial", plan(frame))


def test_marking_copies_reads_the_table_once(spark):
    lines = files.table(spark, SF_DIR, "lineitem")
    text = plan(duplicates.later_copies(lines, ["l_orderkey"], ["l_shipdate"]))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2 and "Join" not in text
    docs = files.table(spark, SF_DIR, "documents")
    assert plan(duplicates.all_copies(docs, ["text"])).count("FileScan") == 2


def test_bounds_are_worked_out_once_in_a_scorecard(spark):
    text = plan(catalog.QUERIES["scorecard_orders"](spark, SF_DIR))
    assert "repartition" not in text.lower() and text.count("o_orderkey") and len(re.findall("FileScan", text)) == 4


def test_trends_read_the_stored_history(spark):
    text = plan(catalog.QUERIES["trend_summary"](spark, SF_DIR))
    assert text.count("FileScan") <= 4 and "props" not in text
    text = plan(catalog.QUERIES["weighted_score"](spark, SF_DIR))
    assert text.count("FileScan") == 1 and "SortMergeJoin" not in text


def test_outlier_statistics_are_one_broadcast_row(spark):
    events = files.table(spark, SF_DIR, "events")
    text = plan(anomaly.detect(events, ["value"], "both"))
    assert "BroadcastNestedLoopJoin" in text and "SortMergeJoin" not in text
