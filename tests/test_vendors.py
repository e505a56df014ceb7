"""Vendor extracts that no query covers, small operators around the master, and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import lineage, master, normalize, quality, registry
from tidemark.streaming import pipelines

D = dt.date
AT = "2024-01-05 16:00:00"


def extract(spark, kind, *rows):
    """Rows of text under the vendor's own headers, spaces around them, and a column that nobody asked for."""
    names = [h[0] for h in normalize.HEADERS[kind].values()]
    columns = list(normalize.HEADERS[kind])
    table = [tuple(r.get(c) for c in columns) + ("x",) for r in rows]
    return spark.createDataFrame(table, ", ".join(f"`{' ' + n}` string" for n in names) + ", extra string")


def test_spot_quotes_of_the_fallback(spark):
    row = normalize.spot_quotes_b(extract(spark, "spot_b", {"source_symbol": "sh600000", "name": "A", "last_price": "1.5", "volume": "100", "bid": "1.4", "ask": "-"}), "2024-01-05", "no quotes", AT).first()
    assert (row["code"], row["last_price"], row["volume"], row["bid"], row["ask"]) == ("600000", 1.5, 100.0, 1.4, None)
    assert row["is_fallback"] is True and row["fallback_reason"] == "no quotes" and row["trade_date"] == D(2024, 1, 5)


def test_daily_bars(spark):
    rows = normalize.daily_bars(extract(spark, "bar", {"date": "2024-01-05", "source_symbol": " ", "open": "1", "close": "2", "high": "2", "low": "1", "volume": "12.005"}, {"date": "bad", "source_symbol": "000001", "volume": "-"}), "600000", "qfq", AT).orderBy("code").collect()
    assert [(r["code"], r["date"], r["volume"], r["adjustment"]) for r in rows] == [("000001", None, None, "qfq"), ("600000", D(2024, 1, 5), 1200, "qfq")]


def test_valuations_and_capital(spark):
    value = normalize.valuations(extract(spark, "valuation", {"date": "20240105", "pe_ttm": "7.5", "pb": "--"}), "600000").first()
    assert (value["code"], value["date"], value["pe_ttm"], value["pb"]) == ("600000", D(2024, 1, 5), 7.5, None)
    rows = normalize.capital_structure(extract(spark, "capital", {"change_date": "2024-01-05", "total_shares": "5"}, {"change_date": "2023-01-05", "change_reason": "split"}), "600000", AT).orderBy("change_date").collect()
    assert [(r["change_date"].year, r["change_reason"], r["source_symbol"]) for r in rows] == [(2023, "split", "600000.SH"), (2024, "", "600000.SH")]


def test_disclosures_and_forecasts(spark):
    raw = extract(spark, "disclosure", {"code": "600000", "name": "A", "first_scheduled_date": "2024-04-01", "actual_disclosure_date": "-"})
    row = normalize.disclosure_calendar(raw, "akshare_cn_stock_report_disclosure", "2023年报", "2023-12-31", AT, market="沪深京").first()
    assert (row["first_scheduled_date"], row["actual_disclosure_date"], row["market"], row["period_end_date"]) == (D(2024, 4, 1), None, "沪深京", D(2023, 12, 31))
    one = {"code": "600000", "forecast_value": "1e6", "announcement_date": "2024-01-05"}
    rows = normalize.earnings_forecasts(extract(spark, "forecast", one, one), "2023年报", "2023-12-31", AT).collect()
    assert len(rows) == 1 and rows[0]["forecast_value"] == 1e6


def test_statements_and_migrations(spark):
    wide = spark.createDataFrame([("20231231", "1.5", "n/a")], "`报告日` string, `货币资金` string, `备注` string")
    both = normalize.statements([normalize.report_items(wide, "600000", k, AT) for k in ("balance", "income")])
    assert {(r["report_type"], r["item_name"], r["item_value"], r["item_value_text"]) for r in both.collect()} == {(k, *v) for k in ("balance", "income") for v in (("货币资金", 1.5, "1.5"), ("备注", None, "n/a"))}
    old = spark.createDataFrame([("a", "x_hist"), ("b", "other")], "c string, endpoint string")
    new = normalize.migrated(old, {"c": "code"}, {"endpoint": {"x_hist": "x"}}, {"adjustment": "qfq"})
    assert [tuple(r) for r in new.orderBy("code").collect()] == [("a", "x", "qfq"), ("b", "other", "qfq")] and new.columns == ["code", "endpoint", "adjustment"]


def test_codes_around_the_master(spark):
    basic = spark.createDataFrame([("sh.600000", "1", "1"), ("sh.000001", "2", "1"), ("sz.000002", "1", "0"), ("sh.600000", "1", "1")], "code string, security_type string, listing_status string")
    assert sorted(r[0] for r in master.active_codes(basic).collect()) == ["sh.000001", "sh.600000"]
    assert [r[0] for r in master.active_codes(basic, "1").collect()] == ["sh.600000"]
    bars = spark.createDataFrame([("a", 1), ("b", 2)], "code string, v int")
    gone = spark.createDataFrame([("b",), ("b",)], "code string")
    assert [r["code"] for r in master.without_delisted(bars, gone).collect()] == ["a"]
    known = spark.createDataFrame([("S1", "sh.1", "1"), ("S2", "sh.2", "2"), ("S3", "sh.3", "3")], "security_id string, baostock_code string, akshare_code string")
    first, second = spark.createDataFrame([("sh.1",), ("sh.1",)], "code string"), spark.createDataFrame([("2",), ("1",)], "code string")
    assert sorted(r["security_id"] for r in master.with_any_source(known, first, second).collect()) == ["S1", "S2"]


def test_small_registries(spark):
    pairs = spark.createDataFrame([("d", "p1"), ("d", "p2")], "dataset string, partition_value string")
    assert [tuple(r) for r in lineage.missing_partitions(pairs, pairs.where("partition_value = 'p1'")).collect()] == [("d", "p2")]
    found = registry.discovery(spark.createDataFrame([("cn_security_master", 7)], "dataset string, row_count long"))
    assert {r["row_count"] for r in found.where("dataset = 'cn_security_master'").collect()} == {7} and found.where("row_count is null").count() == found.count() - 1
    rows = spark.createDataFrame([("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 3), 2), ("a", D(2024, 1, 2), 3), ("b", D(2024, 1, 1), 4), ("b", D(2024, 1, 1), 5)], "g string, d date, n int")
    assert [tuple(r) for r in quality.unordered_groups(rows, "g", "d", "n").collect()] == [("a", 1)]
    days = spark.createDataFrame([(D(2023, 1, 1), D(2024, 3, 31), D(2024, 3, 20))], "start date, today date, last date")
    got = days.select(dates.completed_quarters(F.col("start"), F.col("today")).alias("q"), dates.completed_quarters(F.col("start"), F.col("today"), 2).alias("l"), dates.incremental_start(F.col("today"), F.col("last")).alias("i")).first()
    assert len(got["q"]) == 4 and got["l"] == [D(2023, 9, 30), D(2023, 12, 31)] and got["i"] == D(2024, 3, 17)


def test_drains_and_late_duplicates(spark, tmp_path):
    stamp = dt.datetime(2024, 1, 1)
    path = f"file://{tmp_path}/results"
    spark.createDataFrame([("a", True, stamp), ("b", False, stamp)], "code string, ok boolean, at timestamp_ntz").write.parquet(path)
    held = {"queue": spark.createDataFrame([("a", "pending", None), ("b", "pending", None), ("c", "pending", None)], "code string, status string, updated_at timestamp_ntz")}

    def put(df):
        rows = df.collect()
        held["queue"] = spark.createDataFrame(rows, "code string, status string, updated_at timestamp_ntz")

    source = spark.readStream.schema("code string, ok boolean, at timestamp_ntz").parquet(path)
    pipelines.drains(source, lambda: held["queue"], put, f"{tmp_path}/checkpoint").awaitTermination()
    assert {r["code"]: r["status"] for r in held["queue"].collect()} == {"a": "success", "b": "failed_retryable", "c": "pending"}
    spark.createDataFrame([(1, stamp), (1, stamp + dt.timedelta(seconds=5)), (2, stamp)], "k long, ts timestamp").write.parquet(f"file://{tmp_path}/late")
    rows = pipelines.distinct_within(spark.readStream.schema("k long, ts timestamp").parquet(f"file://{tmp_path}/late"), ["k"], "ts", "1 minute")
    rows.writeStream.format("memory").queryName("late_rows").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/late_checkpoint").start().awaitTermination()
    assert sorted(r["k"] for r in spark.table("late_rows").collect()) == [1, 2]


def test_unknown_headers(spark):
    with pytest.raises(normalize.SchemaDriftError, match="lacks"):
        normalize.valuations(spark.createDataFrame([("x",)], "y string"), "600000")


def test_rules_of_keys_beyond_a_million(spark, tmp_path):
    """Six digits are not enough for the keys, so ids of one day came twice and counted as repeated."""
    import duckdb

    from tidemark.plans import bindings

    keys = "unnest([1, 5, 7, 11, 13, 26, 150000, 1000001, 1000005, 1234567, 2000001, 10000015, 12345678])::bigint"
    con = duckdb.connect()
    for name, columns in {"customer": f"{keys.replace('10000015, 12345678', '2999999')} as c_custkey, 'n' as c_name", "supplier": f"{keys} as s_suppkey", "orders": f"{keys} as o_orderkey, timestamp '1996-01-02' as o_orderdate, 250000.0::double as o_totalprice", "nation": "unnest(range(5))::bigint as n_nationkey, 'n' as n_name"}.items():
        con.execute(f"copy (select {columns}) to '{tmp_path}/{name}.parquet' (format parquet)")
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet'")
    got = bindings.queries()["rule_counts"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(bindings.oracle_sql()["rule_counts"]).fetchall())
