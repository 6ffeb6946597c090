"""Pipeline configurations: what is measured, how it is weighted, what is agreed."""

from __future__ import annotations

from truegrain.operators.measures import MeasureSpec
from truegrain.operators.score import Dimension, ScorerConfig
from truegrain.sources.contract import Contract, contract_from_dict

# Weights, hard blocks, bounds and measured columns of the transaction scorecard.
TRANSACTION_CONFIG = ScorerConfig(
    "transaction_pipeline",
    {
        "completeness": Dimension(0.20, 0.85),
        "validity": Dimension(0.15),
        "accuracy": Dimension(0.30, 0.70),
        "consistency": Dimension(0.15),
        "uniqueness": Dimension(0.10, 0.95),
        "timeliness": Dimension(0.10),
    },
)
TRANSACTION_SPEC = MeasureSpec(
    completeness=("transaction_id", "amount", "age", "email"),
    validity={"amount": "numeric", "email": "email"},
    ranges={"amount": {"min": 1, "max": 100_000_000}, "age": {"min": 0, "max": 120}},
    rules={"minor_not_adult": lambda row: ~((row["age"] < 18) & (row["is_adult"] == True))},  # noqa: E712
    unique=("transaction_id",),
    timestamp="updated_at",
    sla_hours=6.0,
)

# Statuses, weights, hard blocks, bounds and measured columns of the first orders scorecard.
SHOP_STATUSES = ("pending", "confirmed", "shipped", "delivered")
SHOP_CONFIG = ScorerConfig(
    "orders_pipeline",
    {
        "completeness": Dimension(0.30, 0.90),
        "validity": Dimension(0.10),
        "accuracy": Dimension(0.25, 0.75),
        "consistency": Dimension(0.10),
        "uniqueness": Dimension(0.15, 0.95),
        "timeliness": Dimension(0.10),
    },
)
SHOP_SPEC = MeasureSpec(
    completeness=("order_id", "customer_id", "product_id", "quantity", "price", "status"),
    validity={"quantity": "numeric", "price": "numeric", "status": "string"},
    ranges={"quantity": {"min": 1, "max": 100}, "price": {"min": 1, "max": 10_000_000}},
    sets={"status": SHOP_STATUSES},
    rules={
        "priced_if_ordered": lambda row: ~((row["quantity"] > 0) & (row["price"] <= 0)),
        "known_status": lambda row: row["status"].is_missing() | row["status"].isin(SHOP_STATUSES),
    },
    unique=("order_id",),
    timestamp="ordered_at",
    sla_hours=6.0,
)
SHOP_ANOMALY_COLUMNS = ("quantity", "price")

# The orders contract as agreed.
ORDERS_CONTRACT: Contract = contract_from_dict(
    {
        "name": "orders_pipeline",
        "version": "1.0.0",
        "owner": "data-platform-team",
        "schema": [
            {"name": "order_id", "type": "string", "nullable": False},
            {"name": "customer_id", "type": "string", "nullable": False},
            {"name": "product_id", "type": "string", "nullable": False},
            {"name": "quantity", "type": "integer", "nullable": False},
            {"name": "unit_price", "type": "float", "nullable": False},
            {"name": "total_amount", "type": "float", "nullable": False},
            {"name": "order_date", "type": "timestamp", "nullable": False},
            {"name": "status", "type": "string", "nullable": False},
            {"name": "customer_email", "type": "string", "nullable": True},
        ],
        "sla": {"freshness_hours": 24, "delivery_time": "07:00", "timezone": "Asia/Jakarta"},
        "quality": {
            "completeness_threshold": 0.95,
            "accuracy_threshold": 0.90,
            "uniqueness_columns": ["order_id"],
        },
    }
)
# Types, statuses, bounds, weights and hard blocks of the second orders scorecard, its limits and columns.
ORDERS_TYPES = {
    "quantity": "numeric",
    "unit_price": "numeric",
    "total_amount": "numeric",
    "order_id": "string",
    "status": "string",
}
ORDERS_STATUSES = ("completed", "pending", "cancelled")
ORDERS_RANGES = {
    "quantity": {"min": 1, "max": 100},
    "unit_price": {"min": 1, "max": 10_000},
    "total_amount": {"min": 1, "max": 1_000_000},
}
ORDERS_CONFIG = ScorerConfig(
    "orders_pipeline",
    {
        "completeness": Dimension(0.30, 0.80),
        "validity": Dimension(0.20),
        "accuracy": Dimension(0.20, 0.70),
        "consistency": Dimension(0.15),
        "uniqueness": Dimension(0.10, 0.95),
        "timeliness": Dimension(0.05),
    },
)
ORDERS_RULES = {
    "total_is_quantity_times_price": lambda row: (
        abs(row["total_amount"] - row["quantity"] * row["unit_price"]) < 0.01
    )
}
ORDERS_SPEC = MeasureSpec(
    completeness=tuple(ORDERS_CONTRACT.required_columns()),
    validity={**ORDERS_TYPES, "customer_email": "email"},
    ranges=ORDERS_RANGES,
    sets={"status": ORDERS_STATUSES},
    rules=ORDERS_RULES,
    unique=tuple(ORDERS_CONTRACT.uniqueness_columns),
    timestamp="order_date",
    sla_hours=float(ORDERS_CONTRACT.freshness_hours),
)
ORDERS_ANOMALY_COLUMNS = ("quantity", "unit_price", "total_amount")
ORDERS_QUARANTINE_LIMIT = 0.2
ORDERS_MALFORMED_LIMIT = 0.05  # share of lines that may have too few or too many cells
ORDERS_DATES = ("order_date",)

# Runs over the sample events: one scorecard per event type and day.
EVENT_CONFIG = ScorerConfig(
    "events",
    {
        "completeness": Dimension(0.30),
        "accuracy": Dimension(0.40),
        "consistency": Dimension(0.15),
        "uniqueness": Dimension(0.15),
    },
)
EVENT_SPEC = MeasureSpec(
    completeness=("user_id", "value", "props"),
    ranges={"value": {"min": 5}},
    rules={"small_if_new": lambda row: (row["user_id"] > 10) | (row["value"] < 100)},
    unique=("user_id",),
    measured=("completeness", "accuracy", "consistency", "uniqueness"),
)
