import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from truegrain.operators import anomaly, duplicates, quantiles, transform

SHAPES = {
    "one": [5.0],
    "two": [1.0, 2.0],
    "same": [3.0] * 50,
    "hot value": [7.0] * 400 + [float(i) for i in range(300)],
    "signs": [-1e300, -5.0, -1e-300, 0.0, -0.0, 1e-300, 4.0, 1e300],
    "infinite": [float("-inf"), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, float("inf")],
    "close": [1.0 + i * 1e-12 for i in range(997)],
    "tiny": [i * 1e-9 for i in range(500)],
    "heavy tail": [10.0 ** (i % 40) for i in range(1000)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_exact_quantiles(spark, shape):
    values = SHAPES[shape]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    p = (0.25, 0.75)
    expected = [2.0, 6.0] if shape == "infinite" else np.quantile(values, p)
    row = quantiles.exact_quantiles(df, ["v"], p).first()
    assert [row["q0"], row["q1"]] == pytest.approx(list(expected), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("p", [(0.0, 0.5, 1.0), (0.01, 0.1, 0.99)])
def test_other_quantiles(spark, p):
    values = SHAPES["heavy tail"]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = quantiles.exact_quantiles(df, ["v"], p).first()
    assert list(row)[1:] == pytest.approx(list(np.quantile(values, p)), rel=1e-12)


def test_exact_quantiles_random_and_grouped(spark):
    rng = random.Random(11)
    rows = [
        (None if i % 7 == 0 else ("hot" if i % 3 else f"g{i % 11}"), rng.choice([rng.gauss(0, 1e6), rng.random(), 0.0, 42.0]), str(rng.randint(-50, 50)))
        for i in range(5000)
    ]
    df = spark.createDataFrame(rows, "g string, v double, t string").repartition(13)
    out = quantiles.exact_quantiles(df, ["v", "t"], (0.25, 0.75), ["g"]).collect()
    assert len(out) == 2 * len({g for g, _, _ in rows})
    for r in out:
        own = [v if r["column_name"] == "v" else float(t) for g, v, t in rows if g == r["g"]]
        assert [r["q0"], r["q1"]] == pytest.approx(list(np.quantile(own, (0.25, 0.75))), rel=1e-12)


@pytest.mark.parametrize("values", [[1.7e18 + 1000 * (i // 3) for i in range(4000)], [float(i % 2) for i in range(999)]])
def test_many_probabilities_of_clustered_values(spark, values):
    """Forty probabilities at once, values packed together as times are, and ties."""
    p = tuple(i / 39 for i in range(40))
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    row = quantiles.exact_quantiles(df, ["v"], p).first()
    assert list(row)[1:] == pytest.approx(list(np.quantile(values, p)), rel=1e-12)


def test_sketched_quantiles_are_close(spark):
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    bounds = anomaly.iqr_bounds(df, ["v"], exact=False).first()
    assert abs(bounds["q1"] - 25_000) <= 20 and abs(bounds["q3"] - 75_000) <= 20


@pytest.fixture(scope="module")
def amounts(spark):
    rows = [(i, float(10 + i % 5), "x" if i % 9 == 0 else str(i % 4)) for i in range(60)]
    rows += [(100, 1000.0, "1"), (101, None, "900"), (102, float("nan"), None), (103, -500.0, "2")]
    return spark.createDataFrame(rows, "id int, a double, b string")


def test_detect_both(amounts):
    out = anomaly.detect(amounts, ["a", "b", "absent"], "both")
    flagged = {r["id"] for r in out.where("is_anomaly").collect()}
    assert flagged == {100, 101, 103}
    row = out.where("id = 102").first()
    assert row["is_anomaly_iqr_a"] is False and row["is_anomaly_zscore_b"] is False
    assert out.where("is_anomaly_iqr_a").count() == 2


def test_no_columns_and_unknown_method_flag_nothing(amounts):
    assert anomaly.detect(amounts, ["absent"], "iqr").where("is_anomaly").count() == 0
    assert anomaly.detect(amounts, ["a"], "magic").where("is_anomaly").count() == 0
    assert anomaly.detect(amounts.limit(0), ["a"], "both").count() == 0


def test_zero_spread_flags_nothing(spark):
    df = spark.createDataFrame([(1.0,)] * 5, "a double")
    row = anomaly.detect(df, ["a"], "both").where("is_anomaly").count()
    assert row == 0


def test_quarantine_split(amounts):
    flagged = anomaly.detect(amounts, ["a", "b"], "both")
    clean, out = anomaly.quarantine(flagged)
    assert clean.columns == [*amounts.columns, "is_anomaly"]
    assert out.columns == flagged.columns
    assert clean.count() + out.count() == amounts.count()
    rate = anomaly.quarantine_rate(flagged, 0.04).first()
    assert (rate["quarantine_records"], rate["quarantine_rate"], rate["passed"]) == (3, 0.0469, False)
    assert anomaly.quarantine_rate(flagged.limit(0)).first()["quarantine_rate"] == 0.0
    with pytest.raises(ValueError):
        anomaly.quarantine(amounts)


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randint(0, 900)}")
        rows.append((key, rng.randint(0, 2), rng.choice(["a", "b", None])))
    return spark.createDataFrame(rows, "k string, n int, s string").repartition(7), rows


def order(row):
    _, n, s = row
    return (n, (s is not None, s or ""))


def test_later_copies_and_dedup_against_brute_force(copies):
    df, rows = copies
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    first, later, every = Counter(), Counter(), Counter()
    for members in groups.values():
        members = sorted(members, key=order)
        first[members[0]] += 1
        later.update(members[1:])
        if len(members) > 1:
            every.update(members)

    def counted(frame):
        return Counter(tuple(r) for r in frame.collect())

    assert counted(duplicates.deduplicate(df, ["k"], ["n"])) == first
    for parts in (1, 3, 11):
        assert counted(duplicates.later_copies(df.repartition(parts), ["k"], ["n"])) == later
    assert counted(duplicates.all_copies(df, ["k"])) == every
    counts = duplicates.copy_counts(df, ["k"]).first()
    assert tuple(counts) == (len(rows), len(groups), sum(later.values()))


def test_whole_row_copies(copies):
    df, rows = copies
    for parts in (1, 3, 11):
        later = duplicates.later_copies(df.repartition(parts), df.columns)
        assert later.count() == len(rows) - len(set(rows))
    assert duplicates.deduplicate(df, df.columns).count() == len(set(rows))


def test_copies_keep_every_cell(spark):
    """A key of a third of the rows, signed zeros and NaN: cells come back as they went in."""
    rows = [(1, "hot", -0.0, float("nan"))] * 40 + [(i, f"k{i % 30}", [0.0, -0.0, 1.5][i % 3], float(i)) for i in range(80)]
    df = spark.createDataFrame(rows, "n int, k string, x double, y double").repartition(5)

    def texts(frame):
        return Counter(tuple(map(str, r)) for r in frame.collect())

    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    later = Counter(tuple(map(str, r)) for g in groups.values() for r in sorted(g, key=lambda r: r[0])[1:])
    assert texts(duplicates.later_copies(df, ["k"], ["n"])) == later
    assert texts(duplicates.all_copies(df, ["k"])) == Counter(tuple(map(str, r)) for g in groups.values() for r in g if len(g) > 1)


def test_transform(spark):
    rows = [(" a ", "2024-01-02", "1"), ("", "nope", "2"), (None, None, "3"), ("\t", "2024-01-02", "1")]
    df = spark.createDataFrame(rows, "s string, d string, k string")
    clean = transform.clean_strings(df)
    assert [r["s"] for r in clean.collect()] == ["a", None, None, "\t"]
    dated = transform.normalize_dates(clean, ["d", "absent"])
    assert dict(dated.dtypes)["d"] == "date"
    assert [str(r["d"]) for r in dated.collect()] == ["2024-01-02", "None", "None", "2024-01-02"]
    silver = transform.to_silver(df, ["k"], ["d"])
    assert silver.count() == 3
    assert tuple(transform.transform_counts(df, ["k"], ["d"]).first()) == (4, 3, 1)
