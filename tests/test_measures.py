from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from truegrain.functions import cells
from truegrain.functions.rules import holds
from truegrain.operators import measures, score
from truegrain.plans import settings

NOW = datetime(2026, 8, 4, 14, 0)


def value(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][0]


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        ("Andi", "a@b.com", 150000.0, "Jakarta"),
        ("Budi", "N/A", 200000.0, "Bandung"),
        (None, "c@d.com", 300000.0, "-"),
        ("Dina", "unknown", None, "Surabaya"),
        ("", "e@f.com", 175000.0, "null"),
    ]
    return spark.createDataFrame(rows, "name string, email string, amount double, city string")


def test_completeness(people):
    assert value(measures.completeness(people, ["name", "email", "amount", "city"])) == 0.65
    assert value(measures.completeness(people, ["name", "absent"])) == pytest.approx(0.3)
    counts = measures.violations(people, measures.completeness_checks(people, people.columns))
    assert {r["column_name"]: r["violations"] for r in counts.collect()} == {
        "name": 2, "email": 2, "amount": 1, "city": 2,
    }


@pytest.mark.parametrize("text", ["  N/A ", "\tnone\n", "\xa0-　", "\x1cNULL\x1f", " ", "", "Unknown"])
def test_missing_after_unicode_strip(spark, text):
    df = spark.createDataFrame([(text,), ("kept",)], "c string")
    assert value(measures.completeness(df, ["c"])) == 0.5


def test_nan_is_missing_and_no_number(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "c double")
    assert value(measures.completeness(df, ["c"])) == pytest.approx(1 / 3)
    assert value(measures.validity(df, {"c": "numeric"})) == pytest.approx(1 / 3)
    assert value(measures.accuracy(df, {"c": {"min": 0}})) == pytest.approx(1 / 3)


def test_validity(spark):
    rows = [
        ("150000", "Andi", "a@b.com"),
        ("tidak_valid", "", "bukan-email"),
        ("200000", "Budi", "c@d.com"),
        (None, None, None),
        ("abc", "  ", "@domain.com"),
        ("175000", "Dina", "e@f.com"),
    ]
    df = spark.createDataFrame(rows, "amount string, name string, email string")
    rules = {"amount": "numeric", "name": "string", "email": "email"}
    for name, kind in rules.items():
        assert value(measures.validity(df, {name: kind})) == 0.5
    assert value(measures.validity(df, rules)) == 0.5
    assert value(measures.validity(df, {"absent": "numeric"})) == 0.0
    assert value(measures.validity(df, {"amount": "numeric", "name": "shape"})) == 0.75


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("1", 1.0), (" 2.5 ", 2.5), ("-.5", -0.5), ("1e3", 1000.0), ("+7.", 7.0), ("inf", float("inf")),
        ("1d", None), ("1f", None), ("0x1p3", None), ("1_000", None), ("nan", None), ("", None), ("1,5", None),
    ],
)
def test_numbers_are_plain(spark, text, number):
    df = spark.createDataFrame([(text,)], "c string")
    assert value(df.select(cells.number("c", df.schema["c"].dataType))) == number


@pytest.mark.parametrize(
    ("text", "ok"),
    [
        ("a@b.co", True), ("a@b.c\n", True), ("a@b", False), ("a b@c.d", False), ("a@b@c.d", False),
        ("a\xa0b@c.d", False), ("a@b.c ", False), ("@b.c", False), ("a@.c", False), (None, False),
    ],
)
def test_email(spark, text, ok):
    df = spark.createDataFrame([(text,)], "c string")
    assert value(df.select(~cells.not_email("c", df.schema["c"].dataType))) is ok


def test_accuracy(spark):
    rows = [
        ("150000", 25, "Indonesia", "active"),
        ("200000", 200, "Malaysia", "inactive"),
        ("999999999", 28, "Atlantis", "suspended"),
        ("-500", 35, "Singapore", "aktif"),
        ("175000", -1, "Narnia", "active"),
        ("tidak_valid", 30, "Thailand", "unknown"),
    ]
    df = spark.createDataFrame(rows, "amount string, age long, country string, status string")
    ranges = {"amount": {"min": 1, "max": 100_000_000}, "age": {"min": 0, "max": 120}}
    sets = {
        "country": {"Indonesia", "Malaysia", "Singapore", "Thailand", "Vietnam", "Philippines"},
        "status": {"active", "inactive", "suspended"},
    }
    assert value(measures.accuracy(df, ranges)) == pytest.approx(7 / 12)
    assert value(measures.accuracy(df, sets=sets)) == pytest.approx(8 / 12)
    assert value(measures.accuracy(df, ranges, sets)) == pytest.approx(0.625)
    assert value(measures.accuracy(df, {"absent": {"min": 1}})) == 0.0
    assert value(measures.accuracy(df, sets={"status": [None, "active"]})) == pytest.approx(2 / 6)


@pytest.fixture(scope="module")
def shipments(spark):
    rows = [
        (25, True, "2026-01-10", "2026-01-12", "Indonesia", "IDR"),
        (15, True, "2026-01-15", "2026-01-14", "Malaysia", "MYR"),
        (30, True, "2026-01-20", "2026-01-25", "Indonesia", "USD"),
        (10, False, "2026-01-05", "2026-01-03", "Singapore", "SGD"),
        (35, True, "2026-01-08", "2026-01-10", "Thailand", "THB"),
        (28, True, "2026-01-12", "2026-01-15", "Indonesia", "IDR"),
    ]
    schema = "age long, is_adult boolean, order_date string, ship_date string, country string, currency string"
    return spark.createDataFrame(rows, schema)


def pair(row, country, currency):
    return (row["country"] == country) & (row["currency"] == currency)


SHIPMENT_RULES = {
    "adult": lambda row: ~((row["age"] < 18) & (row["is_adult"] == True)),  # noqa: E712
    "dates": lambda row: row["order_date"] <= row["ship_date"],
    "money": lambda row: pair(row, "Indonesia", "IDR")
    | pair(row, "Malaysia", "MYR")
    | pair(row, "Singapore", "SGD")
    | pair(row, "Thailand", "THB"),
}


def test_consistency(shipments):
    expected = {"adult": 5 / 6, "dates": 4 / 6, "money": 5 / 6}
    for name, share in expected.items():
        assert value(measures.consistency(shipments, {name: SHIPMENT_RULES[name]})) == pytest.approx(share)
    assert value(measures.consistency(shipments, SHIPMENT_RULES)) == 0.5
    assert value(measures.consistency(shipments, {})) == 1.0
    first = measures.first_broken_rule(shipments, SHIPMENT_RULES).select("age", "broken_rule").collect()
    assert {r["age"]: r["broken_rule"] for r in first} == {15: "adult", 30: "money", 10: "dates"}


def test_rules_follow_two_valued_logic(spark):
    df = spark.createDataFrame([(1.0, None, None)], "q double, p double, t string")
    answers = {
        "negated comparison with a missing number": (lambda r: ~((r["q"] > 0) & (r["p"] <= 0)), True),
        "arithmetic with a missing number": (lambda r: abs(r["q"] * r["p"] - 1) < 0.01, False),
        "ordering a missing text": (lambda r: r["t"] < "a", False),
        "negated ordering of a missing text": (lambda r: ~(r["t"] < "a"), False),
        "error behind a decided or": (lambda r: (r["q"] == 1) | (r["t"] < "a"), True),
        "error behind a decided and": (lambda r: ~((r["q"] == 2) & (r["t"] < "a")), True),
        "equality with a missing text": (lambda r: r["t"] == "a", False),
        "inequality with a missing text": (lambda r: r["t"] != "a", True),
        "absent column": (lambda r: ~(r["nope"] > 1), False),
        "division by zero": (lambda r: ~(r["q"] / 0 > 1), True),
        "sql with null": ("p > 0", False),
        "sql with an absent column": ("nope > 0", False),
        "column": (F.col("q") > 0, True),
    }
    got = df.select(*(holds(df, rule).alias(name) for name, (rule, _) in answers.items())).first().asDict()
    assert got == {name: truth for name, (_, truth) in answers.items()}
    with pytest.raises(TypeError):
        holds(df, lambda r: True)


def test_uniqueness(spark):
    rows = [
        ("T001", 150000, "C01", "a@b.com"), ("T002", 200000, "C02", "c@d.com"), ("T003", 300000, "C03", "e@f.com"),
        ("T002", 200000, "C02", "c@d.com"), ("T004", 175000, "C04", "g@h.com"), ("T001", 999999, "C01", "a@b.com"),
    ]
    df = spark.createDataFrame(rows, "transaction_id string, amount long, customer_id string, email string")
    assert value(measures.uniqueness(df, ["transaction_id"])) == pytest.approx(4 / 6)
    assert value(measures.uniqueness(df, ["customer_id"])) == pytest.approx(4 / 6)
    assert value(measures.uniqueness(df, ["transaction_id", "amount"])) == pytest.approx(5 / 6)
    assert value(measures.uniqueness(df, df.columns)) == pytest.approx(5 / 6)
    with pytest.raises(ValueError):
        measures.uniqueness(df, ["absent"])


def test_uniqueness_null_keys_are_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", None), ("a", None)], "a string, b int")
    assert value(measures.uniqueness(df, ["a", "b"])) == 0.5


@pytest.mark.parametrize(
    ("age", "sla", "score"),
    [(0, 6, 1), (3, 6, 0.5), (6, 6, 0), (9, 6, 0), (12, 6, 0), (3, 1, 0), (3, 3, 0), (3, 12, 0.75), (3, 24, 0.875), (-3, 6, 1.5)],
)
def test_timeliness(spark, age, sla, score):
    rows = [(NOW - timedelta(hours=age),), (NOW - timedelta(hours=age + 5),)]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(rows, "t timestamp_ntz").select(F.col("t").cast(kind))
        assert value(measures.timeliness(df, "t", sla, NOW)) == pytest.approx(score)


def test_timeliness_of_text_and_of_nothing(spark):
    df = spark.createDataFrame([("2026-08-04",), ("not a date",)], "t string")
    assert value(measures.timeliness(df, "t", 28.0, NOW)) == 0.5
    assert value(measures.timeliness(df.limit(0), "t", 28.0, NOW)) == 0.0


def test_empty_table_scores(spark):
    empty = spark.createDataFrame([], "a string, n double, t timestamp")
    spec = measures.MeasureSpec(
        ["a"], {"a": "string"}, {"n": {"min": 1}}, {}, {"r": "n > 1"}, ["a"], "t", 24.0
    )
    row = measures.dimension_scores(empty, spec, NOW).first()
    assert row["row_count"] == 0
    assert [row[f"score_{d}"] for d in measures.DIMENSIONS] == [0.0] * 6


def test_reference_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    known = spark.createDataFrame([(1,), (1,), (3,), (None,)], "id int")
    row = measures.reference_violations(df, "k", known, "id").first()
    assert (row["violations"], row["checked"], row["accuracy"]) == (2, 5, pytest.approx(0.6))


@pytest.fixture(scope="module")
def payments(spark):
    amounts = [150000.0, 200000.0, None, 999999999.0, 175000.0, 300000.0, 250000.0, 180000.0, 210000.0, 200000.0]
    ages = [25, 30, 28, 200, 35, 27, 31, 29, 26, 30]
    emails = ["a@b.com", "c@d.com", "bad-email", "e@f.com", "g@h.com", "i@j.com", "k@l.com", "m@n.com", "o@p.com", "c@d.com"]
    ids = [f"T{n:03d}" for n in [1, 2, 3, 4, 5, 6, 7, 8, 9, 2]]
    rows = [(i, a, g, e, True, datetime(2026, 7, 30, 10)) for i, a, g, e in zip(ids, amounts, ages, emails)]
    schema = (
        "transaction_id string, amount double, age long, email string, is_adult boolean, updated_at timestamp_ntz"
    )
    return spark.createDataFrame(rows, schema)


def test_golden_scorecard(payments):
    card = score.scorecard(payments, settings.TRANSACTION_SPEC, settings.TRANSACTION_CONFIG, NOW)
    row = card.first()
    got = [row[f"score_{d}"] for d in measures.DIMENSIONS]
    assert got == pytest.approx([0.975, 0.9, 0.85, 1.0, 0.9, 0.0])
    assert (row["total_score"], row["status"], row["row_count"]) == (82.5, "FAIL", 10)
    assert row["hard_block_triggered"] == "uniqueness score 0.90 below hard block 0.95"
    report = {r["dimension"]: r for r in score.score_report(card).collect()}
    assert report["validity"]["bar"] == "█" * 18 + "░" * 2
    assert report["completeness"]["percent"] == 97.5
    assert report["timeliness"]["bar"] == "░" * 20


def test_fused_scorecard_equals_single_measures(payments):
    spec = settings.TRANSACTION_SPEC
    row = measures.dimension_scores(payments, spec, NOW).first()
    assert row["score_completeness"] == value(measures.completeness(payments, spec.completeness))
    assert row["score_validity"] == value(measures.validity(payments, spec.validity))
    assert row["score_accuracy"] == value(measures.accuracy(payments, spec.ranges))
    assert row["score_consistency"] == value(measures.consistency(payments, spec.rules))
    assert row["score_uniqueness"] == value(measures.uniqueness(payments, spec.unique))


def test_grouped_scorecard_equals_one_per_group(payments):
    grouped = payments.withColumn("part", F.when(F.col("age") < 30, "young").when(F.col("age") < 100, "old"))
    cards = score.scorecard(
        grouped, settings.TRANSACTION_SPEC, settings.TRANSACTION_CONFIG, NOW, by=["part"]
    ).collect()
    assert {r["part"] for r in cards} == {"young", "old", None}
    for card in cards:
        own = grouped.where(F.col("part").eqNullSafe(F.lit(card["part"])))
        alone = score.scorecard(own, settings.TRANSACTION_SPEC, settings.TRANSACTION_CONFIG, NOW).first()
        assert {k: v for k, v in card.asDict().items() if k != "part"} == alone.asDict()
    with pytest.raises(ValueError):
        score.scorecard(
            payments.withColumn("status", F.lit(1)),
            settings.TRANSACTION_SPEC,
            settings.TRANSACTION_CONFIG,
            NOW,
            by=["status"],
        )


def test_weights_must_sum_to_one():
    with pytest.raises(ValueError):
        score.ScorerConfig("p", {"a": score.Dimension(0.5), "b": score.Dimension(0.4)})


def test_weighted_score_long_form(spark):
    configs = [
        score.ScorerConfig("p", {"a": score.Dimension(0.5, 0.5), "b": score.Dimension(0.5, 0.9)}),
        score.ScorerConfig("q", {"a": score.Dimension(1.0)}),
    ]
    rows = [
        ("p", 1, "a", 1.0), ("p", 1, "b", 0.95), ("p", 2, "a", 0.4), ("p", 2, "b", 0.1), ("p", 3, "a", 1.0),
        ("p", 3, "other", 9.0), ("q", 1, "a", 0.7), ("q", 2, "a", 0.3), ("new", 1, "a", 0.9),
    ]
    scores = spark.createDataFrame(rows, "pipeline_name string, run_id int, dimension string, score double")
    out = score.weighted_score(scores, score.config_frame(spark, configs)).collect()
    got = {(r["pipeline_name"], r["run_id"]): (r["total_score"], r["status"], r["hard_block_triggered"]) for r in out}
    assert got == {
        ("p", 1): (97.5, "PASS", None),
        ("p", 2): (25.0, "FAIL", "a score 0.40 below hard block 0.5"),
        ("p", 3): (50.0, "FAIL", "b score 0.00 below hard block 0.9"),
        ("q", 1): (70.0, "WARN", None),
        ("q", 2): (30.0, "FAIL", None),
        ("new", 1): (None, "UNCONFIGURED", None),
    }
