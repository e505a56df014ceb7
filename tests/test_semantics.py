"""Hand-made cases: pairing, sessions, hashes, percentiles in bulk, queues, fallbacks of the derived build."""

import datetime as dt
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import disclosure, lineage, logs, merge, normalize, percentile, quality, registry
from tidemark.plans import derived, specs
from tidemark.sources import binary_features
from tidemark.sources.tables import Lake

D = dt.date


def pairs_of(spark, kinds):
    rows = spark.createDataFrame([("k", k, i) for i, k in enumerate(kinds)], "k string, kind string, t long")
    return sorted((r["state"], r["nth"], r["started_at"], r["ended_at"], r["duplicate"]) for r in logs.event_pairs(rows, ["k"], "kind", "s", "e", "t", "t").collect())


def test_event_pairs(spark):
    assert pairs_of(spark, "esese") == [("paired", 1, 1, 2, False), ("paired", 2, 3, 4, False), ("unmatched_end", 1, None, 0, False)]
    assert pairs_of(spark, "sse") == [("paired", 1, 0, 2, False), ("unmatched_start", 2, 1, None, True)]
    assert pairs_of(spark, "seesse") == [("paired", 1, 0, 1, False), ("paired", 2, 3, 5, False), ("unmatched_end", 1, None, 2, False), ("unmatched_start", 3, 4, None, True)]
    assert pairs_of(spark, "") == []


def brute_pairs(kinds):
    waiting, done, out, begun, ended, lost = [], {}, [], 0, 0, 0
    for t, k in enumerate(kinds):
        if k == "s":
            begun += 1
            done[begun] = [t, None, bool(waiting)]
            waiting.append(begun)
        elif waiting:
            done[waiting.pop(0)][1] = t
        else:
            lost += 1
            out.append(("unmatched_end", lost, None, t, False))
    return sorted(out + [("unmatched_start" if e is None else "paired", n, s, e, d) for n, (s, e, d) in done.items()], key=str)


def test_event_pairs_against_a_queue(spark):
    rng = np.random.default_rng(4)
    for _ in range(4):
        kinds = "".join(rng.choice(list("se"), 40))
        assert sorted(pairs_of(spark, kinds), key=str) == brute_pairs(kinds)


def test_log_messages(spark):
    said = [
        "2026-05-20 18:19:12.652 | INFO | a:b:117 - Daily update started run_id=daily-a pid=1 thread=M dataset=all mode=partial force=False",
        "2026-05-20 18:19:14.000 | INFO | a:b:381 - Dataset Parquet stored run_id=daily-a pid=1 thread=M dataset=d rows=2 path=C:\\data.parquet",
        "2026-05-20 18:19:15.000 | INFO | a:b:76 - Pipeline metadata flush completed run_id=daily-a pid=1 thread=M elapsed=0.500s run_rows=200",
        "2026-05-20 18:19:16.000 | WARNING | a:b:425 - Daily lookback empty for sh.600000; refetching from 1990-01-01",
        "2026-05-20 18:20:16.000 | INFO | a:b:407 - Daily update completed run_id=daily-a pid=1 thread=M records=5 success=3 failed=1 skipped=1",
        "2026-05-20 18:20:17.000 | WARNING | a:b:425 - nothing is open; refetching from 1990-01-01",
    ]
    lines = spark.createDataFrame([(i, "f", s) for i, s in enumerate(said)], "n int, file string, value string")
    (run,) = logs.run_figures(logs.parsed(lines), "n", "file").collect()
    assert run.asDict() == {"run_id": "daily-a", "records": 5, "success": 3, "failed": 1, "skipped": 1, "stored": 1, "flushes": 1, "flush_seconds": 0.5, "refetches": 1}


def test_sessions_and_counters(spark):
    rows = [("u", "sh.600000", "success"), ("q", "sh.600000", "skipped_checkpoint"), ("u", "sz.000001", "skipped_existing"), ("h", "sz.000002", "failed_api"), ("f", "sz.000002", "failed"), ("f", "sh.600000", "success"), ("c", "*", "success"), (None, "sz.000003", "failed"), ("x", "sz.000004", None)]
    df = spark.createDataFrame(rows, "dataset string, code string, status string")
    got = {r["code"]: tuple(r)[1:] for r in registry.session_summary(df).collect()}
    assert got == {"sh.600000": ("f,u", "", "q", True, False, False), "sz.000001": ("", "", "u", False, False, True), "sz.000002": ("", "f,h", "", False, True, False)}
    assert tuple(registry.run_counters(df).first()) == (3, 2, 3, 2)


def test_row_text_tells_rows_apart(spark):
    rows = spark.createDataFrame([("a|=b", "c"), ("a", "b|=c"), ("a", None), ("a", "~"), ("a|1:b", "c"), ("a", "b|1:c")], "x string, y string")
    assert rows.select(lineage.row_text(["x", "y"]).alias("t")).distinct().count() == 6


def test_counts_below():
    rng = np.random.default_rng(1)
    ranks = rng.integers(0, 50, 300)
    lo = rng.integers(0, 300, 200)
    hi = np.minimum(300, lo + rng.integers(0, 200, 200))
    limit = rng.integers(0, 60, 200)
    assert percentile.counts_below(ranks, lo, hi, limit).tolist() == [int((ranks[a:b] < c).sum()) for a, b, c in zip(lo, hi, limit, strict=True)]
    days = np.array(["2020-02-29", "2021-02-28", "2024-03-31"], "M8[D]")
    assert percentile.years_before(days, 1).tolist() == [D(2019, 2, 28), D(2020, 2, 28), D(2023, 3, 31)]


def test_percentiles_of_many_keys(spark):
    """Keys that span Arrow batches, ties, repeats of a date, nulls and zeros: equal to counting by hand, appended rows too."""
    rng = np.random.default_rng(2)
    rows = []
    for key, n in (("a", 700), ("b", 3), (None, 40), ("c", 1), ("d", 900)):
        for i in range(n):
            v = [None, 0.0, float(rng.integers(-9, 9)), float(rng.normal())][int(rng.integers(0, 4))]
            rows.append((key, None if rng.random() < 0.02 else D(2000, 1, 1) + dt.timedelta(days=int(rng.integers(0, 6000))), v))
    df = spark.createDataFrame(rows, "code string, date date, v double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = percentile.percentiles(df, ["v"]).collect()
        cut = D(2014, 1, 1)
        appended = percentile.appended_percentiles(df, df.where(F.col("date") < F.lit(cut)), ["v"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    samples = {k: [(d, v) for c, d, v in rows if c == k and d and v] for k in ("a", "b", None, "c", "d")}
    assert len(got) == len(rows)
    for r in got[::7]:
        own = samples[r["code"]]
        for n, name in ((1, "v_percentile_1y"), (10, "v_percentile_10y"), (None, "v_percentile_all_history")):
            want = None
            if r["date"] and r["v"]:
                since = percentile.years_before(np.array([r["date"]], "M8[D]"), n).tolist()[0] if n else D(1, 1, 1)
                if n is None or min(d for d, _ in own) <= since:
                    frame = [v for d, v in own if since <= d <= r["date"]]
                    up = [v for v in frame if v > 0]
                    want = 100 * sum(v <= r["v"] for v in up) / len(up) if r["v"] > 0 else 100 * (len(up) + sum(0 > v >= r["v"] for v in frame)) / len(frame)
            assert r[name] == (None if want is None else pytest.approx(want)), (r, name)
    fresh = lambda r: r["code"] is None or (r["date"] and r["date"] >= cut) or not any(d and d < cut for c, d, _ in rows if c == r["code"])
    last = {k: max((d for c, d, _ in rows if c == k and d and d < cut), default=None) for k in samples}
    new = lambda r: last[r["code"]] is None or r["code"] is None or (r["date"] is not None and r["date"] > last[r["code"]])
    assert sorted(map(str, appended)) == sorted(str(r) for r in got if fresh(r) and new(r))


def test_queue_of_changes(spark):
    ddl = "code string, trigger_dataset string, trigger_reason string, triggered_at timestamp_ntz, status string, last_attempt_at timestamp_ntz, error_stack string"
    old = dt.datetime(2024, 1, 1)
    queue = spark.createDataFrame([("a", "d", "r", old, "failed_retryable", old, "boom"), ("b", "d", "r", old, "success", old, ""), ("c", "d", "r", old, "pending", None, "")], ddl)
    changed = spark.createDataFrame([("a",), ("b",), ("n",), (None,), ("a",)], "code string")
    got = sorted((r["code"], r["status"], r["trigger_reason"], r["last_attempt_at"], r["error_stack"]) for r in disclosure.enqueued(queue, changed, "f", "changed", "2024-02-01").collect())
    assert got == sorted([("a", "pending", "changed", None, ""), ("b", "success", "r", old, ""), ("b", "pending", "changed", None, ""), ("c", "pending", "r", None, ""), ("n", "pending", "changed", None, "")])
    assert disclosure.enqueued(queue, changed.limit(0), "f", "x", "2024-02-01").count() == 3


def test_tasks_that_need_no_fetch(spark):
    held = spark.createDataFrame([("a", D(2024, 1, 2), "x"), ("a", D(2024, 1, 3), "confirmed"), ("b", D(2024, 1, 3), "x"), ("c", D(2024, 1, 2), "confirmed"), ("z", None, "confirmed")], "code string, date date, source_endpoint string")
    tasks = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("z",)], "code string")
    days = spark.createDataFrame([(D(2024, 1, 3), "1"), (D(2024, 1, 4), "0")], "calendar_date date, is_trading_day string")
    assert [r["code"] for r in merge.skippable_tasks(tasks, held, days, "confirmed").collect()] == ["a"]
    assert merge.skippable_tasks(tasks, held, days.limit(0), "confirmed").count() == 0


def test_changed_keys_that_were_updated(spark):
    want = spark.createDataFrame([("a", "s", "m"), ("b", "s", "m"), ("c", "new", "m")], "k string, source_signature string, master_row_hash string")
    have = spark.createDataFrame([("a", "s", "m"), ("b", "s", "m"), ("c", "s", "m"), ("d", "s", "m")], "k string, source_signature string, master_row_hash string")
    late = spark.createDataFrame([("b",), ("b",)], "k string")
    got = {r["k"]: (r["action"], r["reason"]) for r in lineage.changed_keys(want, have, "k", late).collect()}
    assert got == {"b": ("rebuild", "updated"), "c": ("rebuild", "signature"), "d": ("delete", "no source")}
    assert "b" not in {r["k"] for r in lineage.changed_keys(want, have, "k").collect()}


def test_master_fallbacks(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    make = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    lake.write("akshare_cn_stock_spot_quote_sina", make([("2024-01-05", "000001", "PA Bank", 1.0)], "trade_date string, code string, name string, last_price double"))
    lake.write("qlib_cn_stock_features_day", make([("2024-01-05", "bj830000", "BJ", "830000", 1.0)], "date string, qlib_symbol string, exchange string, code string, close double"))
    got = {r["security_id"]: (r["listing_status"], r["qlib_symbol"]) for r in derived.build_master(lake).collect()}
    assert got == {"SZ.000001": ("active", "sz000001"), "BJ.830000": ("unknown", "bj830000")}


def test_every_stored_column_triggers_a_rebuild(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    ddl = "date string, code string, open double, high double, low double, close double, volume long, turnover_rate double"
    bar = lambda t: spark.createDataFrame([("2024-01-02", "sh.600000", 1.0, 2.0, 0.5, 1.5, 10, t)], ddl)
    lake.write("baostock_cn_stock_basic", spark.createDataFrame([("sh.600000", "B", "1", "1")], "code string, name string, security_type string, listing_status string"))
    lake.write("baostock_cn_stock_daily_bar_unadjusted", bar(0.1))
    assert derived.build(lake)["cn_stock_daily_bar"] == 1 and derived.build(lake)["cn_stock_daily_bar"] == 0
    lake.write("baostock_cn_stock_daily_bar_unadjusted", bar(0.2))
    assert derived.build(lake)["cn_stock_daily_bar"] == 1


def test_damaged_and_empty_sources(spark):
    files = spark.createDataFrame([("x/sh600000/close.day.bin", struct.pack("<2f", 0, 1) + b"x")], "path string, content binary")
    with pytest.raises(Exception, match="no whole number"):
        binary_features.decoded(files).collect()
    empty = spark.createDataFrame([], "x string")
    for shape in (lambda: normalize.spot_quotes_a(empty, "2024-01-02", "2024-01-02"), lambda: normalize.spot_quotes_b(empty, "2024-01-02", "r", "2024-01-02")):
        with pytest.raises(normalize.SchemaDriftError, match="no rows"):
            shape()


def test_quality_of_rules_that_no_bar_has(spark):
    columns = specs.columns("string: security_id exchange code baostock_code akshare_code qlib_symbol listing_status; boolean: is_active")
    spec = specs.TableSpec("m", columns, ("security_id",), None, rules=("canonical_id", "cross_codes", "active_status", "unique"))
    rows = [("SH.600000", "SH", "600000", "sh.600000", "600000", "sh600000", "active", True), ("SH.1", "SH", "600001", "sh.600002", None, None, "delisted", True), ("SH.1", "SH", "600001", None, None, None, None, None)]
    got = {r["rule"]: (r["violations"], r["sample"]) for r in quality.report(spark.createDataFrame(rows, columns), spec).collect()}
    assert got == {"canonical_id": (2, "SH.1"), "cross_codes": (1, "SH.1"), "active_status": (1, "SH.1"), "unique": (1, "SH.1")}


def test_periods_and_calendars(spark):
    from tidemark.functions import dates

    days = spark.createDataFrame([(D(2024, 3, 31),), (D(2024, 3, 30),), (D(2024, 1, 1),)], "d date")
    got = {r["d"]: r["p"] for r in days.select("d", dates.rolling_periods(F.col("d"), 3).alias("p")).collect()}
    assert got == {D(2024, 3, 31): [D(2024, 3, 31), D(2024, 6, 30), D(2024, 9, 30)], D(2024, 3, 30): [D(2023, 12, 31), D(2024, 3, 31), D(2024, 6, 30)], D(2024, 1, 1): [D(2023, 12, 31), D(2024, 3, 31), D(2024, 6, 30)]}
    around = dates.calendar_around(days, "d", 7)
    assert around.agg(F.min("calendar_date"), F.max("calendar_date")).first()[:] == (D(2023, 12, 25), D(2024, 4, 7))
    assert dates.latest_trading_day(around).first()[0] == D(2024, 4, 5) and dates.calendar_around(days.limit(0), "d").count() == 0


def test_partition_values_and_views(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    row = spark.createDataFrame([("2024-01-05", "000001", "PA Bank", 1.0)], "trade_date string, code string, name string, last_price double")
    name = "akshare_cn_stock_spot_quote_sina"
    with pytest.raises(quality.QualityError, match="another"):
        lake.prepared(name, row, "2024-01-06")
    with pytest.raises(quality.QualityError, match="without"):
        lake.prepared(name, row.withColumn("trade_date", F.lit(" ")))
    lake.write(name, row)
    row.createOrReplaceTempView("v_old_name")
    lake.create_views(legacy=("v_old_name", "v_never_there"))
    assert not spark.catalog.tableExists("v_old_name") and spark.table(f"v_{name}").count() == 1
    figures = lake.file_statistics(name).first()
    assert (figures["files"], figures["row_count"], figures["min_date"], figures["max_date"]) == (1, 1, D(2024, 1, 5), D(2024, 1, 5))
