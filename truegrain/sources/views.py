"""Views over the sample tables with known faults, for queries and tests to measure.

The sample tables are clean. Each view plants faults by integer arithmetic on the key,
so that any engine can define the same view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from truegrain.sources.files import table


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with missing cells, placeholders, blanks, outliers, bad texts and repeated ids."""
    base = table(spark, sf_dir, "orders").selectExpr(
        "*",
        "CASE WHEN o_orderkey % 71 = 0 THEN -5 WHEN o_orderkey % 73 = 0 THEN 999 "
        "WHEN o_orderkey % 59 = 0 THEN NULL ELSE o_orderkey % 19 + 1 END AS quantity",
        "IF(o_orderkey % 67 = 0, NULL, CAST(o_orderkey % 490 + 10 AS DOUBLE)) AS unit_price",
    )
    return base.selectExpr(
        "'ORD-' || IF(o_orderkey % 101 = 0 AND o_orderkey > 0, o_orderkey - 1, o_orderkey) AS order_id",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 'N/A' "
        "WHEN o_orderkey % 83 = 0 THEN ' - ' ELSE 'CUST-' || o_custkey END AS customer_id",
        "CASE WHEN o_orderkey % 103 = 0 THEN '  ' WHEN o_orderkey % 107 = 0 THEN chr(9) "
        "ELSE ' PROD-' || (o_orderkey % 20) END AS product_id",
        "quantity",
        "unit_price",
        "quantity * unit_price + IF(o_orderkey % 79 = 0, 1, 0) AS total_amount",
        "o_orderdate AS order_date",
        "CASE WHEN o_orderkey % 61 = 0 THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'completed' "
        "WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'cancelled' END AS status",
        "CASE WHEN o_orderkey % 43 = 0 THEN 'bad-email' WHEN o_orderkey % 47 = 0 THEN NULL "
        "ELSE 'user' || o_custkey || '@example.com' END AS customer_email",
        "IF(o_orderkey % 53 = 0, 'not_a_number', CAST(o_orderkey % 19 + 1 AS STRING)) AS quantity_text",
        "IF(o_orderkey % 41 = 0, 'not-a-date', date_format(o_orderdate, 'yyyy-MM-dd')) AS order_date_text",
    )


# The columns of an order as the contract names them.
ORDER_COLUMNS = (
    "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
    "order_date", "status", "customer_email",
)


def contract_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_orders(spark, sf_dir).select(*ORDER_COLUMNS)


def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the earlier layout: one price, delivery statuses, an order time."""
    return dirty_orders(spark, sf_dir).selectExpr(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        "unit_price AS price",
        "CASE status WHEN 'completed' THEN 'delivered' WHEN 'cancelled' THEN 'shipped' ELSE status END AS status",
        "order_date AS ordered_at",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with repeated ids, missing and huge amounts, impossible ages and minors."""
    aged = table(spark, sf_dir, "orders").selectExpr(
        "*", "IF(o_orderkey % 73 = 0, 200, o_orderkey % 80 + 10) AS age"
    )
    return aged.selectExpr(
        "'T' || IF(o_orderkey % 17 = 0 AND o_orderkey > 0, o_orderkey - 1, o_orderkey) AS transaction_id",
        "CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 999999999.0D "
        "ELSE o_totalprice END AS amount",
        "age",
        "IF(o_orderkey % 13 = 0, 'bad-email', 'user' || o_custkey || '@example.com') AS email",
        "age >= 18 OR o_orderkey % 37 = 0 AS is_adult",
        "o_orderdate AS updated_at",
    )


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their type as the pipeline and their day as the run."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_type AS pipeline_name",
        "CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) AS run_at",
        "ts",
        "user_id",
        "value",
        "props",
    )
