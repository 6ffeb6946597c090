"""Contract, expectations, gates, files, histories, trend and freshness."""

import gzip
import hashlib
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from truegrain.operators import expect, freshness, gates, score, trend
from truegrain.plans import medallion, settings
from truegrain.session import fresh_path, shared_dir
from truegrain.sources import files, landing, sinks, storage
from truegrain.sources.contract import contract_from_dict, load_contract

NOW = datetime(2026, 8, 4, 14, 0)

DOCUMENT = """
contract:
  name: test_pipeline
  version: 2.0.0
  previous_version: 1.0.0
  breaking_change: true
  owner: test-team
  schema:
  - {name: order_id, type: string, nullable: false}
  - {name: customer_id, type: string, nullable: false}
  - {name: quantity, type: integer, nullable: true}
  sla: {freshness_hours: 24, delivery_time: "07:00", timezone: "Asia/Jakarta"}
  quality:
    completeness_threshold: 0.95
    accuracy_threshold: 0.90
    uniqueness_columns: [order_id]
"""


def raw(**changes):
    base = {
        "name": "p",
        "version": "1.0.0",
        "owner": "o",
        "schema": [{"name": "order_id", "type": "string", "nullable": False}],
        "sla": {"freshness_hours": 24, "delivery_time": "07:00", "timezone": "UTC"},
        "quality": {"completeness_threshold": 0.9, "accuracy_threshold": 0.9, "uniqueness_columns": ["order_id"]},
    }
    return {**base, **changes}


def test_contract_file(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "c.yaml"
    path.write_text(DOCUMENT)
    contract = load_contract(str(path))
    assert contract.required_columns() == ["order_id", "customer_id", "quantity"]
    assert contract.non_nullable_columns() == ["order_id", "customer_id"]
    assert contract.freshness_hours == 24
    assert contract.quality_thresholds()["uniqueness_columns"] == ["order_id"]
    notice = contract.breaking_change_notice()
    assert "BREAKING CHANGE DETECTED" in notice and "1.0.0 -> 2.0.0" in notice
    assert [f.dataType.simpleString() for f in contract.struct_type()] == ["string", "string", "bigint"]
    with pytest.raises(FileNotFoundError):
        load_contract(str(tmp_path / "none.yaml"))


def test_contract_errors():
    broken = raw()
    del broken["version"]
    with pytest.raises(ValueError, match="version"):
        contract_from_dict(broken)
    with pytest.raises(ValueError, match="int"):
        contract_from_dict(raw(schema=[{"name": "a", "type": "int", "nullable": True}]))
    assert contract_from_dict(raw()).breaking_change_notice() is None


def test_contract_diff(spark):
    old = contract_from_dict(
        raw(schema=[{"name": n, "type": "string", "nullable": False} for n in ("a", "b", "c", "d")])
    )
    new = contract_from_dict(
        raw(
            schema=[
                {"name": "a", "type": "string", "nullable": False},
                {"name": "b", "type": "float", "nullable": False},
                {"name": "d", "type": "string", "nullable": True},
                {"name": "e", "type": "string", "nullable": True},
            ]
        )
    )
    got = {r["column_name"]: (r["change"], r["breaking"]) for r in expect.contract_diff(spark, old, new).collect()}
    assert got == {
        "b": ("type changed", True), "c": ("removed", True), "d": ("now nullable", True), "e": ("added", False),
    }


def test_expectations_and_gate(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", None, 2.0)], "s string, n int, x double")
    results = expect.expectations(
        df, ["s", "gone"], {"s": "string", "n": "string", "x": "numeric", "gone": "numeric"}, ["s", "n", "gone"]
    )
    got = {(r["check_kind"], r["column_name"]): (r["passed"], r["observed"]) for r in results.collect()}
    assert got == {
        ("schema", "s"): (True, 0), ("schema", "gone"): (False, 1), ("type", "s"): (True, 0),
        ("type", "n"): (False, 1), ("type", "x"): (True, 0), ("type", "gone"): (False, None),
        ("null", "s"): (True, 0), ("null", "n"): (False, 1), ("null", "gone"): (False, None),
    }
    summary = expect.expectation_summary(results).first()
    assert tuple(summary) == (False, 2, 5, False, False, False)
    rows = gates.expectation_gate(results, "g").collect()
    assert {r["severity"] for r in rows if r["check_kind"] == "null" and not r["passed"]} == {"WARN"}
    assert {r["severity"] for r in rows if r["check_kind"] != "null" and not r["passed"]} == {"STOP"}


def test_breaking_change_row(spark):
    contract = contract_from_dict(raw(breaking_change=True, previous_version="0.9.0"))
    row = gates.contract_gate(spark, contract).first()
    assert (row["severity"], row["column_name"]) == ("WARN", "0.9.0 -> 1.0.0")
    assert gates.contract_gate(spark, contract_from_dict(raw())).count() == 0


NASTY = [
    ("1", "  padded  ", "a,b", None),
    ("2", 'say "hi"', "\ttab", ""),
    ("3.0", "N/A", "x", "null"),
    (None, "é–ü", "-", "nan"),
]


def test_bronze_round_trip(spark):
    df = spark.createDataFrame(NASTY, "n string, a string, b string, c string")
    source, target = sinks.write_raw(df.repartition(3), fresh_path(spark, "t")), fresh_path(spark, "t")
    landing.land(spark, source, target)
    assert sorted(map(repr, landing.read_landed(spark, target).collect())) == sorted(map(repr, df.collect()))
    read = {r["a"]: r for r in files.read_bronze(spark, source).collect()}
    assert read["  padded  "]["n"] == 1.0 and read[None]["n"] == 3.0
    assert {r["c"] for r in read.values()} == {None}


RAW_FILES = {
    "a 1.csv": b"x,y\n1,\"quoted, \"\"twice\"\"\"\n2,  bare  \r\n\n3,\xff\xfe not utf-8\n",
    "b 100% +%20.csv": b"x,y\n4,no break at the end",
    "c_\u00e9.csv": "x,y\n5,\u00e9nds in \u00e9".encode(),
    "d.csv": b"\xef\xbb\xbfx,y\n6,marked\n",
    "e.csv": b"",
    "f.csv": b"x,y\n" + b"".join(b"%d,%s\n" % (i, b"z" * (i % 40)) for i in range(10, 3000)),
    "g.csv": b"\xef\xbb\xbfx,y\n7,marked, no break",
}


@pytest.mark.parametrize("multi_line", [False, True])
def test_landed_bytes_are_the_source_bytes(spark, tmp_path, multi_line):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for name, content in RAW_FILES.items():
        (source / name).write_bytes(content)
    (source / "_SUCCESS").write_bytes(b"")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        for _ in range(2):  # a second run replaces the first
            manifest = landing.land(spark, str(source), target, multi_line)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r["bytes"], r["source_file"].endswith(n)) for r, n in zip(manifest.collect(), RAW_FILES)] == [(len(c), True) for c in RAW_FILES.values()]
    parts = landing.parts_of(spark, target)
    for number, content in enumerate(RAW_FILES.values()):
        landed = b"".join(open(p.removeprefix("file:"), "rb").read() for p in parts.get(number, []))
        assert hashlib.sha256(landed).digest() == hashlib.sha256(content).digest()
    assert multi_line or len(parts[5]) > 3
    checked = landing.landing_check(spark, manifest, target).collect()
    assert all(r["same_lines"] for r in checked) and sum(r["lines"] for r in checked) == sum(len(c.split(b"\n")) - c.endswith(b"\n") for c in RAW_FILES.values() if c)
    rows = {r["x"]: r["y"] for r in landing.read_landed(spark, target, multi_line).collect()}
    assert len(rows) == 2997 and (rows["1"], rows["4"], rows["6"], rows["2"].rstrip("\r")) == ('quoted, "twice"', "no break at the end", "marked", "  bare  ")


def test_landing_refuses_what_it_cannot_keep(spark, tmp_path):
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(b"x,y\n1,2\n", mtime=0) + b"")
    with pytest.raises((RuntimeError, ValueError)):
        landing.land(spark, str(tmp_path / "z.csv.gz"), str(tmp_path / "out"))
    (tmp_path / "one.csv").write_text("x,y\n1,2\n")
    (tmp_path / "two.csv").write_text("y,x\n1,2\n")
    (tmp_path / "z.csv.gz").rename(tmp_path / "_z")
    landing.land(spark, str(tmp_path), str(tmp_path / "_out"))
    with pytest.raises(Exception, match="header"):
        landing.read_landed(spark, str(tmp_path / "_out")).collect()
    with pytest.raises(FileNotFoundError):
        landing.read_landed(spark, str(tmp_path / "none"))


def test_bronze_with_schema(spark):
    df = spark.createDataFrame([("3.0", "2.5", "x"), ("7", "1e2", "y"), ("2.5", "z", "NA")], "q string, p string, s string")
    path = sinks.write_raw(df, fresh_path(spark, "t"))
    schema = contract_from_dict(
        raw(schema=[{"name": "q", "type": "integer", "nullable": True}, {"name": "p", "type": "float", "nullable": True}])
    ).struct_type()
    rows = sorted((tuple(r) for r in files.read_bronze(spark, path, schema).collect()), key=repr)
    assert rows == sorted([(3, 2.5, "x"), (7, 100.0, "y"), (None, None, None)], key=repr)


def order_rows(n):
    start = datetime(2024, 1, 1)
    for i in range(n):
        q, p = i % 10 + 1, float(i % 40 + 10)
        day = (start + timedelta(days=i % 30)).strftime("%Y-%m-%d")
        yield (f"ORD-{i:04d}", f"CUST-{i % 9}", f"PROD-{i % 5}", str(q), str(p), str(q * p), day, "completed", "u@e.com")


COLUMNS = ", ".join(f"{c} string" for c in settings.ORDERS_CONTRACT.required_columns())


def land(spark, rows):
    return sinks.write_raw(spark.createDataFrame(rows, COLUMNS), fresh_path(spark, "incoming"))


def test_medallion_runs_to_the_end(spark):
    rows = list(order_rows(200))
    rows += [("ORD-9001", "CUST-1", "PROD-1", "999", "99999.99", "99899990.01", "2024-01-15", "completed", "a@e.com")]
    rows += [("ORD-8001", None, "PROD-5", "3", "25.0", "75.0", "2024-01-10", "completed", None)]
    rows += [rows[0]]
    run = medallion.run_orders(spark, land(spark, rows), fresh_path(spark, "run"), datetime(2024, 1, 30, 12))
    assert run.completed
    gold = sinks.read_gold(spark, run.gold)
    assert (gold.count(), dict(gold.dtypes)["order_date"]) == (201, "date")
    assert "is_anomaly" not in gold.columns
    assert spark.read.parquet(run.flagged).where("is_anomaly").count() == 1
    by_gate = {r["gate"]: r["severity"] for r in run.gate_rows.collect() if r["check_kind"] != "null"}
    assert by_gate == {**{f"gate_{i}": "OK" for i in range(1, 6)}, "transform": "OK", "gold": "OK"}
    seen = {r["check_kind"]: (r["observed"], r["threshold"]) for r in run.gate_rows.collect() if r["gate"] in ("transform", "gold")}
    assert seen == {
        "input_records": (202.0, None), "output_records": (201.0, None), "duplicates_removed": (1.0, None), "records_loaded": (201.0, 201.0),
    }
    history = sinks.read_scores(spark, run.history)
    assert history.select("dimension").distinct().count() == 6
    run.clear_layers(spark)
    assert not os.path.exists(run.flagged) and not os.path.exists(run.bronze) and os.path.exists(run.gold)


def test_medallion_with_line_breaks_in_cells(spark):
    rows = list(order_rows(60))
    rows[0] = (rows[0][0], "CUST\nwith a break", *rows[0][2:])
    source = land(spark, rows)
    run = medallion.run_orders(spark, source, fresh_path(spark, "run"), datetime(2024, 1, 30, 12), multi_line=True)
    assert run.completed
    assert sinks.read_gold(spark, run.gold).where(F.col("customer_id").contains("\n")).count() == 1


def test_medallion_with_malformed_lines(spark, tmp_path):
    """Lines of too few or too many cells are kept apart; too many of them stop the run."""
    rows = [",".join(r) for r in order_rows(200)]
    for broken, completed in ((["ORD-1,short", rows[0] + ",more"], True), (["x"] * 30, False)):
        source = tmp_path / f"{len(broken)}.csv"
        source.write_text("\n".join([",".join(settings.ORDERS_CONTRACT.required_columns()), *rows, *broken]) + "\n")
        run = medallion.run_orders(spark, str(source), fresh_path(spark, "run"), datetime(2024, 1, 30, 12))
        assert run.completed == completed
        kept = spark.read.parquet(run.malformed).collect()
        assert sorted(r["line"] for r in kept) == sorted(broken) and {r["cells_due"] for r in kept} == {9}
        row = run.gate_rows.where("check_kind = 'malformed_lines'").first()
        assert (row["severity"], row["observed"]) == ("WARN" if completed else "STOP", len(broken))
    assert spark.read.parquet(run.bronze.replace("/bronze", "/typed")).count() == 200


def test_medallion_stops_on_types_and_on_score(spark):
    rows = list(order_rows(50))
    wrong = [*rows[:-1], (*rows[-1][:3], "many", *rows[-1][4:])]
    run = medallion.run_orders(spark, land(spark, wrong), fresh_path(spark, "run"), datetime(2024, 1, 30))
    assert not run.completed and run.silver is None
    repeated = [*rows, *rows]
    run = medallion.run_orders(spark, land(spark, repeated), fresh_path(spark, "run"), datetime(2024, 1, 30))
    stop = [r for r in run.gate_rows.collect() if r["severity"] == "STOP"]
    assert not run.completed and [r["gate"] for r in stop] == ["gate_3"]


def test_gold_is_replaced(spark, monkeypatch):
    """A load that fails, or loses rows, leaves the gold before it in place; old versions go."""
    gold = fresh_path(spark, "gold")
    with pytest.raises(FileNotFoundError):
        sinks.read_gold(spark, gold)
    load = lambda n: sinks.load_gold(spark, sinks.write_parquet(spark.range(n), fresh_path(spark, "silver")), gold).first()
    for n in (5, 3, 4, 7):
        assert load(n)["records_loaded"] == n and sinks.read_gold(spark, gold).count() == n
    assert len(sinks.gold_versions(spark, gold)) == 2 and len([f for f in os.listdir(gold) if f[0] == "r"]) == 2
    broken = sinks.write_parquet(spark.range(9), fresh_path(spark, "silver"))
    for part in [f for f in os.listdir(broken) if f.endswith(".parquet")][:1]:
        with open(os.path.join(broken, part), "r+b") as f:
            f.truncate(20)
    with pytest.raises(Exception):
        sinks.load_gold(spark, broken, gold)
    assert sinks.read_gold(spark, gold).count() == 7
    monkeypatch.setattr(storage, "publish_text", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load(2)
    assert sinks.read_gold(spark, gold).count() == 7


def test_publishing_twice_is_an_error(spark, tmp_path):
    storage.publish_text(spark, str(tmp_path / "v" / "1"), "a")
    with pytest.raises(FileExistsError):
        storage.publish_text(spark, str(tmp_path / "v" / "1"), "b")
    assert (tmp_path / "v" / "1").read_text() == "a" and storage.child_names(spark, str(tmp_path / "none")) == []


def test_runs_written_again_are_there_once(spark):
    columns = "pipeline_name string, scored_at timestamp, total_score double, status string, hard_block_triggered string, score_a double, score_b double"
    first = [("p", NOW, 90.0, "PASS", None, 0.9, 0.8), ("q/r s", NOW, 70.0, "WARN", None, 0.7, 0.7), ("p", NOW + timedelta(microseconds=1), 1.0, "FAIL", "x", 0.1, 0.1)]
    again = [("p", NOW, 91.0, "PASS", None, 0.91, 0.8)]
    path, csv, name = fresh_path(spark, "history"), fresh_path(spark, "csv"), "again_" + fresh_path(spark, "x").rsplit("-", 1)[1]
    for rows in (first, again, first, again):
        card = spark.createDataFrame(rows, columns)
        sinks.append_scores(card, path, name)
        sinks.append_scores_csv(card, csv)
    wanted = {("p", 91.0), ("q/r s", 70.0), ("p", 1.0)}
    assert {(r["pipeline_name"], r["total_score"]) for r in sinks.read_scores(spark, path).collect()} == wanted
    assert sinks.read_scores(spark, path).count() == 6 == spark.table(name).count()
    assert sinks.history_runs(spark, path, spark.createDataFrame(first, columns)) == 3
    assert sinks.history_runs(spark, path, spark.createDataFrame([("p", NOW - timedelta(1), 1.0, "FAIL", None, 0.1, 0.1)], columns)) == 0
    read = files.read_history_csv(spark, csv, ["a", "b"])
    assert "run" not in read.columns and {(r["pipeline_name"], r["total_score"]) for r in read.collect()} == wanted and read.count() == 3


def test_history_gate(spark):
    assert gates.history_gate(spark, "gate_5", 1).first()["severity"] == "OK"
    row = gates.history_gate(spark, "gate_5", 0).first()
    assert (row["passed"], row["severity"], row["observed"], row["threshold"]) == (False, "WARN", 0.0, 1.0)


def test_gold_by_name(spark):
    silver = sinks.write_parquet(spark.range(4), fresh_path(spark, "silver"))
    gold = fresh_path(spark, "gold")
    name = "gold_" + gold.rsplit("-", 1)[1]
    row = sinks.load_gold(spark, silver, gold, name).first()
    assert (row["passed"], row["records_loaded"], row["records_due"], row["table"]) == (True, 4, 4, name)
    assert spark.table(name).count() == 4


def test_gold_that_lost_rows_stops(spark):
    for loaded, severity in ((4, "OK"), (3, "STOP")):
        row = spark.createDataFrame([(loaded == 4, loaded, 4, "gold")], "passed boolean, records_loaded long, records_due long, table string")
        assert gates.load_gate(row).first()["severity"] == severity


def test_history_under_a_name(spark):
    path = fresh_path(spark, "history")
    name = "history_" + path.rsplit("-", 1)[1]
    for day in (2, 1):
        card = spark.createDataFrame([("p", NOW + timedelta(days=day), 90.0 - day, "PASS", None, 0.9), ("q", NOW, 1.0, "FAIL", "x", 0.1)],
            "pipeline_name string, scored_at timestamp, total_score double, status string, hard_block_triggered string, score_a double")
        sinks.append_scores(card, path, name)
    rows = files.history_of(files.history_table(spark, name), "p").collect()
    assert [r["total_score"] for r in rows] == [89.0, 88.0]


def test_csv_history_keeps_quotes(spark):
    message = 'a "quoted" name, with \\ and a comma'
    card = spark.createDataFrame([(message, NOW, 90.0, "PASS", message, 0.9)],
        "pipeline_name string, scored_at timestamp, total_score double, status string, hard_block_triggered string, score_a double")
    path = sinks.append_scores_csv(card, fresh_path(spark, "csv"))
    row = files.read_history_csv(spark, path, ["a"]).first()
    assert (row["pipeline_name"], row["hard_block_triggered"]) == (message, message)


def history(spark, rows, name="p"):
    start = datetime(2026, 7, 25, 9)
    data = [(name, start + timedelta(days=i), float(v), v / 100) for i, v in enumerate(rows)]
    return spark.createDataFrame(data, "pipeline_name string, scored_at timestamp_ntz, total_score double, score_a double")


DECAY = [94.0, 95.0] * 7 + [96 - 3.5 * i for i in range(7)]


def test_rolling_average_over_block_borders(spark):
    df = history(spark, DECAY * 9)
    for block in (7, 10, 1000):
        rows = trend.rolling_average(df, 7, block_rows=block).orderBy("scored_at").collect()
        values = [r["total_score"] for r in rows]
        assert values == DECAY * 9
        for i, r in enumerate(rows):
            own = values[max(0, i - 6) : i + 1]
            assert r["rolling_avg"] == pytest.approx(sum(own) / len(own))


def test_same_instant_is_ordered_by_the_rest(spark):
    rows = [("p", NOW, float(v)) for v in (3, 1, 2)]
    df = spark.createDataFrame(rows, "pipeline_name string, scored_at timestamp_ntz, total_score double")
    got = {r["total_score"]: r["row_no"] for r in trend.numbered(df).collect()}
    assert got == {1.0: 1, 2.0: 2, 3.0: 3}


def test_trend_on_decaying_history(spark):
    df = history(spark, DECAY).unionByName(history(spark, [90.0] * 5, "short")).unionByName(history(spark, [80.0] * 9, "flat"))
    flagged = trend.score_anomalies(df)
    low = [r["total_score"] for r in flagged.where("is_anomaly").collect()]
    assert sorted(low) == sorted(v for v in DECAY[14:] if v <= 92.5)
    summary = {r["pipeline_name"]: r for r in trend.trend_summary(df).collect()}
    assert summary["p"]["first_rolling"] == pytest.approx(sum(DECAY[:7]) / 7)
    assert summary["p"]["last_rolling"] == pytest.approx(sum(DECAY[-7:]) / 7)
    assert summary["p"]["trend_direction"] == "degrading"
    rolled = trend.rolling_average(df).where("pipeline_name = 'p'").orderBy("scored_at").collect()
    assert summary["p"]["first_rolling"] == pytest.approx(rolled[6]["rolling_avg"])
    assert summary["p"]["last_rolling"] == pytest.approx(rolled[-1]["rolling_avg"])
    assert summary["short"]["trend_delta"] == 0
    alerts = {r["pipeline_name"]: (r["action"], r["trend_direction"]) for r in trend.trend_alert(trend.trend_summary(df)).collect()}
    assert alerts == {
        "p": ("alert", "degrading"),
        "short": ("skipped", "insufficient_data"),
        "flat": ("alert", "degrading"),  # no change counts as degrading
    }
    dims = {r["pipeline_name"]: r for r in trend.dimension_trend(df).collect()}
    assert (dims["p"]["arrow"], dims["p"]["is_alert"]) == ("↓", True)
    assert (dims["flat"]["arrow"], dims["flat"]["is_alert"]) == ("→", False)


def test_zero_deviation_baseline_flags_a_fall(spark):
    df = history(spark, [90.0] * 14 + [89.0, 90.0, 91.0])
    rows = trend.score_anomalies(df).where("is_anomaly").collect()
    assert [(r["total_score"], r["z_score"]) for r in rows] == [(89.0, float("-inf"))]


@pytest.mark.parametrize(
    ("table", "sla", "age_minutes", "severity"),
    [
        ("transactions", 1, 20, "OK"), ("transactions", 1, 75, "WARNING"), ("transactions", 1, 180, "CRITICAL"),
        ("daily_reports", 24, 1200, "OK"), ("daily_reports", 24, 1800, "WARNING"), ("user_events", 6, None, "CRITICAL"),
        ("edge", 2, 120, "WARNING"), ("edge", 2, 240, "CRITICAL"),
    ],
)
def test_freshness(spark, table, sla, age_minutes, severity):
    when = [] if age_minutes is None else [(table, NOW - timedelta(minutes=age_minutes))]
    seen = spark.createDataFrame(when, "t string, at timestamp_ntz")
    slas = freshness.sla_frame(spark, [freshness.FreshnessSLA(table, sla)])
    row = freshness.check(freshness.latest_by(seen, "at", "t"), slas, NOW).first()
    assert (row["severity"], row["is_breached"]) == (severity, severity != "OK")
    if age_minutes is None:
        assert row["age_hours"] == float("inf")
        assert row["message"] == "user_events: no data found — CRITICAL"
    else:
        assert row["age_hours"] == round(age_minutes / 60, 2)
        assert row["message"] == f"{table}: {age_minutes / 60:.1f}h old, SLA {float(sla)}h — {severity}".replace("1.2h", "1.3h")
    channels = [r["channel"] for r in freshness.alert_routes(freshness.check(freshness.latest_by(seen, "at", "t"), slas, NOW)).collect()]
    assert channels == {"OK": ["log"], "WARNING": ["chat"], "CRITICAL": ["chat", "page"]}[severity]


def test_file_times(spark):
    path = sinks.write_parquet(spark.range(10).repartition(3), fresh_path(spark, "f"))
    newest = max(os.stat(os.path.join(path, f)).st_mtime for f in os.listdir(path) if f.endswith(".parquet"))
    seen = files.file_times(spark, path, "t").select(F.unix_micros("latest_timestamp")).first()[0]
    assert abs(seen / 1e6 - newest) < 0.01
    absent = files.file_times(spark, path + "-absent", "t").first()
    assert (absent["table_name"], absent["latest_timestamp"]) == ("t", None)


def test_history_appends_with_other_dimensions(spark):
    path = fresh_path(spark, "history")
    columns = "pipeline_name string, scored_at timestamp, total_score double, status string, hard_block_triggered string"
    one = spark.createDataFrame([("2024", NOW, 90.0, "PASS", None, 0.9)], f"{columns}, score_a double")
    two = spark.createDataFrame([("2024", NOW + timedelta(days=1), 80.0, "PASS", "x", 0.8)], f"{columns}, score_b double")
    sinks.append_scores(one, path)
    sinks.append_scores(two, path)
    wide = sinks.wide_scores(sinks.read_scores(spark, path), ["a", "b"]).orderBy("scored_at").collect()
    assert [(r["pipeline_name"], r["score_a"], r["score_b"]) for r in wide] == [("2024", 0.9, None), ("2024", None, 0.8)]


class Conf(dict):
    set = dict.__setitem__


class Session:
    def __init__(self, **settings):
        self.conf = Conf({key.replace("_", "."): value for key, value in settings.items()})


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(Session(spark_checkpoint_dir="/shared/x/")) == "/shared/x"
    alone = Session(spark_master="local[4]")
    assert shared_dir(alone) == shared_dir(alone) == alone.conf["spark.checkpoint.dir"]
    with pytest.raises(RuntimeError):
        shared_dir(Session(spark_master="yarn"))
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_score_anomaly_of_a_missing_column_config():
    with pytest.raises(ValueError):
        score.ScorerConfig("p", {"a": score.Dimension(0.99)})


def test_age_of_a_date(spark):
    df = spark.createDataFrame([("2026-08-03",)], "d string").select(F.col("d").cast("date"))
    row = freshness.check(
        freshness.latest_of(df, "d", "t"), freshness.sla_frame(spark, [freshness.FreshnessSLA("t", 24)]), NOW
    ).first()
    assert row["age_hours"] == 38.0
