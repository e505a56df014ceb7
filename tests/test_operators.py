"""Hand vectors and edges for the market-data operators."""

import datetime as dt
import struct

import pytest
from pyspark.sql import functions as F

from tidemark.functions import codes, coerce, dates
from tidemark.operators import asof, disclosure, lineage, logs, master, merge, normalize, percentile, quality, query, registry
from tidemark.plans import specs
from tidemark.sources import binary_features
from tidemark.sources.tables import Lake, append_event, read_events

D = dt.date


def test_adjustment_vector(spark):
    bars = spark.createDataFrame(
        [("a", D(2017, 5, 24), 15.38, 15.47), ("a", D(2017, 5, 25), 11.75, 12.93), ("a", D(2017, 5, 26), 12.81, 12.84), ("b", D(2017, 5, 26), 2.0, 3.0), ("a", None, 5.0, 6.0)],
        "code string, date date, open double, close double",
    )
    factors = spark.createDataFrame(
        [("a", D(2016, 6, 23), 0.759535, 7.128788), ("a", D(2017, 5, 25), 1.0, 9.385732), ("a", D(2017, 5, 26), None, None), (None, D(2017, 1, 1), 3.0, 3.0)],
        "code string, dividend_operate_date date, forward_adjust_factor double, backward_adjust_factor double",
    )
    got = {(r["code"], r["date"]): (round(r["open"], 6), round(r["close"], 6), r["adjust_flag"]) for r in asof.adjusted_bars(bars, factors, "forward_adjust_factor", "2").collect()}
    assert got[("a", D(2017, 5, 24))] == (11.681648, 11.750006, "2")
    assert got[("a", D(2017, 5, 26))] == (12.81, 12.84, "2")
    assert got[("b", D(2017, 5, 26))] == (2.0, 3.0, "2") and got[("a", None)] == (5.0, 6.0, "2")
    back = {r["date"]: round(r["close"], 6) for r in asof.adjusted_bars(bars.where("code = 'a'"), factors, "backward_adjust_factor", "1").collect()}
    assert back[D(2017, 5, 24)] == 110.28235 and back[D(2017, 5, 26)] == 120.512799


@pytest.mark.parametrize(
    "values, want",
    [([10, 0, None, 20], [100, None, None, 100]), ([-5, 10, -4, 20], [100, 100, 66.667, 100]), ([10, 10, 20, 30], [100] * 4), ([-5, -5, -10, -4], [100, 100, 100, 25])],
)
def test_percentile_vectors(spark, values, want):
    rows = [("a", D(2019 + i, 1, 2), None if v is None else float(v)) for i, v in enumerate(values)]
    series = spark.createDataFrame(rows, "code string, date date, v double")
    for form in (percentile.percentiles(series, ["v"]), percentile.percentiles_by_window(series, "v")):
        got = [r["v_percentile_all_history"] for r in form.orderBy("date").collect()]
        assert [None if g is None else round(g, 3) for g in got] == want


def test_percentile_maturity_and_append(spark):
    series = spark.createDataFrame([("a", D(2018, 1, 2), 10.0), ("a", D(2024, 1, 2), 20.0)], "code string, date date, v double")
    last = percentile.percentiles(series, ["v"]).orderBy(F.desc("date")).first()
    assert (last["v_percentile_1y"], last["v_percentile_5y"], last["v_percentile_10y"]) == (100.0, 100.0, None)
    only = percentile.appended_percentiles(series, series.where("date < '2020-01-01'"), ["v"]).collect()
    assert len(only) == 1 and only[0]["v_percentile_3y"] == 100.0


def test_leap_years(spark):
    row = spark.sql("select date '2020-02-29' a, date '2021-02-28' b").select(dates.years_before(F.col("a"), 1), dates.years_before(F.col("b"), 1)).first()
    assert tuple(row) == (D(2019, 2, 28), D(2020, 2, 28))


def test_coercion(spark):
    df = spark.createDataFrame([(" 1.5 ", "2024/01/02", "YES", "7.0"), ("--", "20240103", "no", "x"), ("NaN", "2024-01-04 10:00", "?", "8"), (None, None, None, None)], "a string, b string, c string, d string")
    got = df.select(coerce.to_number(F.col("a")), coerce.to_date(F.col("b")), coerce.to_boolean(F.col("c")), coerce.to_long(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(1.5, D(2024, 1, 2), True, 7), (None, D(2024, 1, 3), False, None), (None, D(2024, 1, 4), None, 8), (None,) * 4]


def test_codes(spark):
    df = spark.createDataFrame([("sh.600000",), ("SZ_1",), ("123.0",), ("bj830000",), ("abc",)], "c string")
    assert [r[0] for r in df.select(codes.source_code(F.col("c"))).collect()] == ["600000", "000001", "000123", "830000", "abc"]
    with pytest.raises(Exception, match="six-digit"):
        df.select(codes.six_digits(F.col("c"))).collect()
    assert [r[0] for r in spark.createDataFrame([("",), ("QFQ",)], "c string").select(codes.adjustment(F.col("c"))).collect()] == ["unadjusted", "qfq"]


def test_periods(spark):
    df = spark.createDataFrame([("2024年报",), ("2024一季",), ("nothing",)], "p string")
    assert [r[0] for r in df.select(dates.period_end(F.col("p"))).collect()] == [D(2024, 12, 31), D(2024, 3, 31), None]


def test_master(spark):
    spot = spark.createDataFrame([("600000", "Spot", D(2024, 1, 2))], "code string, name string, trade_date date")
    gone = spark.createDataFrame([("SZSE", "000001", "Gone", D(2000, 1, 1), D(2020, 1, 1), D(2024, 1, 1))], "exchange string, code string, name string, list_date date, delist_date date, snapshot_date date")
    basic = spark.createDataFrame([("sh.600000", "B", D(1999, 1, 1), None, "1", "1"), ("sz.000001", "C", None, None, "1", "1")], "code string, name string, ipo_date date, delist_date date, security_type string, listing_status string")
    member = spark.createDataFrame([("sh600000", D(2024, 1, 1)), ("bj830000", D(2024, 1, 1))], "qlib_symbol string, end_date date")
    got = {r["security_id"]: r for r in master.security_master(spot, gone, basic, member).collect()}
    assert (got["SH.600000"]["listing_status"], got["SH.600000"]["name"], got["SH.600000"]["source_priority"]) == ("active", "Spot", "mixed")
    assert (got["SZ.000001"]["listing_status"], got["SZ.000001"]["name"]) == ("delisted", "Gone")
    assert (got["BJ.830000"]["listing_status"], got["BJ.830000"]["source_priority"], got["BJ.830000"]["baostock_code"]) == ("unknown", "qlib_only", None)


def test_schema_drift_and_quotes(spark):
    with pytest.raises(normalize.SchemaDriftError, match="last_price"):
        normalize.spot_quotes_a(spark.createDataFrame([("1",)], "`代码` string"), "2024-01-02", "2024-01-02 16:00:00")
    names = ["代码", "名称", "最新价", "涨跌额", "涨跌幅", "今开", "最高", "最低", "昨收", "成交量", "成交额", "换手率", "振幅", "市盈率-动态", "市净率", "总市值", "流通市值"]
    raw = spark.createDataFrame([tuple(["1", "N"] + ["2"] * 15)], [f" {n}" for n in names])
    row = normalize.spot_quotes_a(raw, "2024-01-02", "2024-01-02 16:00:00").first()
    assert row["code"] == "000001" and row["volume"] == 200.0 and row["trade_date"] == D(2024, 1, 2)
    bar = normalize.quotes_as_bars(normalize.spot_quotes_a(raw, "2024-01-02", "2024-01-02 16:00:00")).first()
    assert bar["close"] == 2.0 and bar["volume"] == 200 and bar["quality_status"] == "spot_quote_close"


def test_report_items(spark):
    raw = spark.createDataFrame([("20231231", "src", "1,5", None), ("20221231", "src", "2.5", "x")], "`报告日` string, `数据源` string, item1 string, item2 string")
    rows = normalize.report_items(raw, "600000", "income", "2024-01-01 00:00:00").orderBy("report_date", "item_name").collect()
    assert [(r["item_name"], r["item_value"], r["item_value_text"]) for r in rows] == [("item1", 2.5, "2.5"), ("item2", None, "x"), ("item1", None, "1,5"), ("item2", None, "")]
    assert rows[0]["report_date"] == D(2022, 12, 31) and rows[0]["source_symbol"] == "sh600000"


def test_keep_last_and_coverage(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, n int, v string")
    new = spark.createDataFrame([("a", 1, "z"), ("a", 1, "z"), ("c", 1, "w")], "k string, n int, v string")
    assert {(r["k"], r["v"]) for r in merge.keep_last(old, new, ["k", "n"]).collect()} == {("a", "z"), ("b", "y"), ("c", "w")}
    assert {(r["k"], r["covered"]) for r in merge.keys_covered(old, new, ["k", "n"], "k").collect()} == {("a", True), ("c", False)}
    assert merge.keep_last(old.limit(0), new.limit(0), ["k"]).count() == 0


def test_lake_modes(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    name = "akshare_cn_stock_spot_quote_sina"
    quote = lambda code, day, price: (code, day, price)
    frame = lambda rows: spark.createDataFrame(rows, "code string, trade_date string, latest_price string")
    lake.write(name, frame([quote("000001", "2024-01-02", "1"), quote("000002", "2024-01-03", "2")]))
    assert lake.latest(name).count() == 1 and [r[0] for r in lake.partitions(name).collect()] == ["2024-01-02", "2024-01-03"]
    lake.write(name, frame([quote("000001", "2024-01-02", "5"), quote("000003", "2024-01-02", "6")]), "upsert")
    assert {(r["code"], r["last_price"]) for r in lake.read(name).collect()} == {("000001", 5.0), ("000002", 2.0), ("000003", 6.0)}
    lake.write(name, frame([quote("000001", "2024-01-02", "9")]), "upsert", skip_existing=True)
    assert lake.read(name, "2024-01-02").where("code = '000001'").first()["last_price"] == 5.0
    with pytest.raises(quality.QualityError, match="six_digits"):
        lake.write(name, frame([quote("x", "2024-01-05", "1")]))
    with pytest.raises(quality.QualityError, match="without trade_date"):
        lake.write(name, frame([quote("000001", "", "1")]))
    lake.delete_partitions(name, ["2024-01-03"])
    assert lake.read(name).count() == 2
    lake.rebuild(name, frame([quote("000009", "2024-02-01", "1")]))
    assert [r["code"] for r in lake.read(name).collect()] == ["000009"] and lake.file_statistics(name).first()["row_count"] == 1
    assert lake.read("cn_security_master").count() == 0 and "v_cn_security_master" in lake.create_views()
    append_event(spark, f"file://{tmp_path}/events", name, lake.read(name), 7)
    assert read_events(spark, f"file://{tmp_path}/events", 6).first()["min_date"] == "2024-02-01"


def test_fixed_columns(spark):
    df = spark.createDataFrame([("",), ("qfq",)], "adjustment string")
    assert [r[0] for r in normalize.with_fixed(df, {"adjustment": "qfq"}).collect()] == ["qfq", "qfq"]
    with pytest.raises(Exception, match="must be hfq"):
        normalize.with_fixed(df, {"adjustment": "hfq"}).collect()


def test_ledger_ignores_order_and_operational_columns(spark):
    spec = specs.TableSpec("t", specs.columns("string: code; double: v; timestamp: updated_at"), ("code",), "code")
    a = spark.createDataFrame([("a", 1.0, dt.datetime(2024, 1, 1)), ("a", 2.0, None)], "code string, v double, updated_at timestamp_ntz")
    b = spark.createDataFrame([("a", 2.0, None), ("a", 1.0, dt.datetime(2025, 1, 1))], "code string, v double, updated_at timestamp_ntz")
    x, y = lineage.ledger(a, spec).first(), lineage.ledger(b, spec).first()
    assert x["semantic_hash"] == y["semantic_hash"] and x["content_hash"] != y["content_hash"] and x["row_count"] == 2


def test_structured_query_errors(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    for bad in ({"columns": ["x"]}, {"filters": [("n", "~", 1)]}, {"filters": [("n", "in", [])]}):
        with pytest.raises(query.QueryError):
            query.structured_query(df, **bad)
    assert query.structured_query(df, limit=-5).count() == 0


def test_logs(spark):
    lines = spark.createDataFrame([(1, "2024-01-02 10:00:00.123 INFO x - Daily update started run_id=r1 pid=1 dataset=d mode=full"), (2, "2024-01-02 10:00:01.000 INFO x - Daily bar API failed for sh.600000"), (3, "garbage")], "n int, value string")
    got = {r["n"]: (r["event"], r["run_id"], r["code"], r["dataset"]) for r in logs.parsed(lines).collect()}
    assert got == {1: ("run_started", "r1", None, "d"), 2: ("failed", None, "sh.600000", None)}


def test_disclosure_priority(spark):
    rows = spark.createDataFrame([("a", "2023年报", D(2023, 12, 31), D(2024, 4, 1), D(2024, 4, 5), None, None, None), ("a", "2023年报", D(2023, 12, 31), D(2024, 4, 1), None, None, None, D(2024, 4, 2))], "code string, report_period string, period_end_date date, first_scheduled_date date, first_changed_date date, second_changed_date date, third_changed_date date, actual_disclosure_date date")
    best = disclosure.reduced(disclosure.candidates(rows, "2024-04-30", "2024-04-01")).first()
    assert (best["trigger_priority"], best["trigger_date"]) == (3, D(2024, 4, 2))


def test_binary_features(spark, tmp_path):
    folder = tmp_path / "features" / "sh600000"
    folder.mkdir(parents=True)
    for field, values in {"open": [0, 1.1111114, float("nan")], "close": [0, 2.2222226, 3.3333334], "volume": [2, 100]}.items():
        (folder / f"{field}.day.bin").write_bytes(struct.pack(f"<{len(values)}f", *values))
    (tmp_path / "day.txt").write_text("2024-01-02\n\n2024-01-03\n2024-01-04\n")
    calendar = binary_features.read_calendar(spark, f"file://{tmp_path}/day.txt")
    rows = binary_features.read_features(spark, f"file://{tmp_path}/features", calendar).orderBy("date").collect()
    assert [(r["date"], r["open"], r["close"], r["volume"]) for r in rows] == [(D(2024, 1, 2), 1.111111, 2.222223, None), (D(2024, 1, 3), None, 3.333333, None), (D(2024, 1, 4), None, None, 100.0)]
    (tmp_path / "inst").mkdir()
    (tmp_path / "inst" / "csi300.txt").write_text("SH600000\t2020-01-01\t2021-01-01\nshort\n")
    assert [tuple(r)[:4] for r in binary_features.read_instruments(spark, f"file://{tmp_path}/inst").collect()] == [("csi300", "sh600000", "SH", "600000")]


def test_catalog_and_empty_inputs(spark):
    assert registry.catalog(spark).count() == len(specs.SPECS) == 31
    empty = spark.createDataFrame([], "code string, date date, v double")
    assert percentile.percentiles(empty, ["v"]).count() == 0
    with pytest.raises(ValueError):
        specs.spec("nothing")


def lake_with_sources(spark, root):
    lake = Lake(spark, root)
    make = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    lake.write("akshare_cn_stock_spot_quote_eastmoney", make([("2024-01-02", "600000", "Spot", 1.0)], "trade_date string, code string, name string, last_price double"))
    lake.write("baostock_cn_stock_basic", make([("sh.600000", "B", "1", "1"), ("sz.000001", "C", "1", "1")], "code string, name string, security_type string, listing_status string"))
    bar = "date string, code string, open double, high double, low double, close double, volume long, amount double"
    lake.write("baostock_cn_stock_daily_bar_unadjusted", make([("2024-01-02", "sh.600000", 1.0, 2.0, 0.5, 1.5, 10, 1.0)], bar))
    lake.write("akshare_cn_stock_daily_bar_unadjusted", make([("2024-01-02", "600000", 9.0, 9.0, 9.0, 9.0, 10, 1.0, "daily_bar_confirmed"), ("2024-01-03", "600000", 3.0, 3.0, 3.0, 3.0, 10, 1.0, "daily_bar_confirmed"), ("2024-01-02", "000001", 4.0, 4.0, 4.0, 4.0, 10, 1.0, "spot_quote_close")], bar + ", quality_status string"))
    lake.write("akshare_cn_stock_valuation_eastmoney", make([("2024-01-02", "600000", 5.0, None)], "date string, code string, close double, pe_ttm double"))
    lake.write("baostock_cn_stock_valuation_percentile", make([("2024-01-02", "sh.600000", 7.0, 50.0), ("2024-01-03", "sh.600000", 8.0, 60.0)], "date string, code string, pe_ttm double, pe_ttm_percentile_1y double"))
    return lake


def test_derived_build(spark, tmp_path):
    from tidemark.plans import derived

    lake = lake_with_sources(spark, f"file://{tmp_path}")
    assert derived.build(lake) == {"cn_stock_daily_bar": 2, "cn_stock_valuation": 1}
    bars = {(str(r["date"]), r["security_id"]): (r["close"], r["source_dataset"][:4]) for r in lake.read("cn_stock_daily_bar").collect()}
    assert bars == {("2024-01-02", "SH.600000"): (1.5, "baos"), ("2024-01-03", "SH.600000"): (3.0, "aksh"), ("2024-01-02", "SZ.000001"): (4.0, "aksh")}
    values = {str(r["date"]): (r["close"], r["pe_ttm"], r["pe_ttm_percentile_1y"], "+" in r["source_dataset"]) for r in lake.read("cn_stock_valuation").collect()}
    assert values == {"2024-01-02": (5.0, 7.0, 50.0, True), "2024-01-03": (None, 8.0, 60.0, False)}
    assert derived.build(lake) == {"cn_stock_daily_bar": 0, "cn_stock_valuation": 0}
    lake.write("akshare_cn_stock_daily_bar_unadjusted", spark.createDataFrame([("2024-01-02", "000001", 6.0, 6.0, 6.0, 6.0, 10, 1.0, "daily_bar_confirmed")], "date string, code string, open double, high double, low double, close double, volume long, amount double, quality_status string"))
    assert derived.build(lake)["cn_stock_daily_bar"] == 1
    assert lake.read("cn_stock_daily_bar", "SZ.000001").first()["close"] == 6.0 and lake.read("cn_stock_daily_bar").count() == 3
    assert lake.read("dataset_partition_manifest").where("dataset = 'cn_stock_daily_bar' and source_signature is not null").count() == 2


def spoil(tmp_path, name, partition):
    """Bytes that no reader takes for Parquet, in place of a partition's files."""
    for f in (tmp_path / name / partition).glob("*.parquet"):
        f.write_bytes(b"nothing")
    for f in (tmp_path / name / partition).glob(".*.crc"):
        f.unlink()


def test_unchanged_sources_are_not_opened(spark, tmp_path):
    """The plan comes from the ledger: a build passes over partitions that can't be read, unless they have to be."""
    from tidemark.plans import derived

    lake = lake_with_sources(spark, f"file://{tmp_path}")
    derived.build(lake)
    spoil(tmp_path, "baostock_cn_stock_daily_bar_unadjusted", "code=sh.600000")
    spoil(tmp_path, "baostock_cn_stock_valuation_percentile", "code=sh.600000")
    assert derived.build(lake) == {"cn_stock_daily_bar": 0, "cn_stock_valuation": 0}
    bars = "date string, code string, open double, high double, low double, close double, volume long, amount double, quality_status string"
    lake.write("akshare_cn_stock_daily_bar_unadjusted", spark.createDataFrame([("2024-01-02", "000001", 6.0, 6.0, 6.0, 6.0, 10, 1.0, "daily_bar_confirmed")], bars))
    assert derived.build(lake, ("cn_stock_daily_bar",)) == {"cn_stock_daily_bar": 1}
    assert lake.read("cn_stock_daily_bar", "SZ.000001").first()["close"] == 6.0


def test_written_since_and_missing_ledger_rows(spark, tmp_path):
    """Sources of both vendors count as changed by the ledger's time; absent rows are entered, empty partitions an error."""
    from tidemark.plans import derived
    from tidemark.sources.tables import LEDGER, LedgerError

    lake = lake_with_sources(spark, f"file://{tmp_path}")
    derived.build(lake)
    before = str(lake.read(LEDGER).agg(F.max("updated_at")).first()[0] + dt.timedelta(milliseconds=1))
    assert derived.build(lake, changed_since=before) == {"cn_stock_daily_bar": 0, "cn_stock_valuation": 0}
    percentile = lake.read("baostock_cn_stock_valuation_percentile")
    lake.write("baostock_cn_stock_valuation_percentile", percentile, "upsert")  # the same rows, written again: vendor 1 has no time of its own
    assert derived.build(lake, changed_since=before) == {"cn_stock_daily_bar": 0, "cn_stock_valuation": 1}
    # a ledger that forgot a vendor-2 partition finds the same again
    lake.write(LEDGER, lake.read(LEDGER).where("not (dataset = 'akshare_cn_stock_daily_bar_unadjusted' and partition_value = '000001')"), "replace")
    assert derived.build(lake, ("cn_stock_daily_bar",)) == {"cn_stock_daily_bar": 0}
    assert lake.read(LEDGER).where("dataset = 'akshare_cn_stock_daily_bar_unadjusted' and partition_value = '000001'").count() == 1
    # a partition whose rows are gone
    name = "baostock_cn_stock_daily_bar_unadjusted"
    lake.write(LEDGER, lake.read(LEDGER).where(F.col("dataset") != name), "replace")
    empty = lake.read(name).limit(0).drop("code")
    empty.write.mode("overwrite").parquet(f"{lake.path(name)}/code=sh.600000")
    with pytest.raises(LedgerError, match="baostock_cn_stock_daily_bar_unadjusted/sh.600000"):
        derived.build(lake, ("cn_stock_daily_bar",))


def test_a_security_without_sources_is_deleted(spark, tmp_path):
    from tidemark.plans import derived

    lake = lake_with_sources(spark, f"file://{tmp_path}")
    derived.build(lake)
    lake.delete_partitions("akshare_cn_stock_daily_bar_unadjusted", ["000001"])
    derived.build(lake, ("cn_stock_daily_bar",))
    assert [r[0] for r in lake.partitions("cn_stock_daily_bar").collect()] == ["SH.600000"]
    assert derived.build(lake, ("cn_stock_daily_bar",), securities=["SH.600000"]) == {"cn_stock_daily_bar": 1}


def test_last_to_arrive_stands(spark, tmp_path):
    """Rows of one key in files that landed one after the other, of two kinds, in any cut into tasks."""
    from tidemark.sources.tables import landed

    root = tmp_path / "in"
    for n in range(3):
        (root / f"batch={n}").mkdir(parents=True)
        lines = "".join(f"{c:06d},2024-01-02,{n * 100 + i}\n" for i in range(50) for c in (1, 2))
        (root / f"batch={n}" / "part.csv").write_text(lines + (f"000003,2024-01-02,{n}\n" if n < 2 else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    try:
        rows = landed(spark, f"file://{root}", "csv", "code string, trade_date string, last_price double")
        assert rows.rdd.getNumPartitions() > 10
        lake = Lake(spark, f"file://{tmp_path}/lake")
        lake.write("akshare_cn_stock_spot_quote_sina", rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r["code"], r["last_price"]) for r in lake.read("akshare_cn_stock_spot_quote_sina").collect()} == {("000001", 249.0), ("000002", 249.0), ("000003", 1.0)}
    more = spark.range(100).selectExpr("'000001' code", "'2024-01-02' trade_date", "double(1000 + id) last_price").repartition(1)
    more.write.parquet(f"file://{tmp_path}/more")
    lake.write("akshare_cn_stock_spot_quote_sina", landed(spark, f"file://{tmp_path}/more"), "upsert")
    assert lake.read("akshare_cn_stock_spot_quote_sina").where("code = '000001'").first()["last_price"] == 1099.0


def test_run_metadata(spark, tmp_path):
    a, b = Lake(spark, f"file://{tmp_path}/a"), Lake(spark, f"file://{tmp_path}/b")
    runs = registry.outcome_rows(spark.createDataFrame([("d", "c1", 3, None), ("d", "c2", 0, None), ("d", "c3", 0, "boom")], "dataset string, code string, rows long, error string"), "r1")
    status = spark.createDataFrame([("d", "c1", "failed", "2024-01-01 00:00:00"), ("d", "c1", "success", "2024-01-02 00:00:00")], "dataset string, code string, status string, updated_at string")
    a.record(runs, status)
    b.copy_metadata(a)
    b.copy_metadata(a)
    assert {r["status"] for r in b.read("pipeline_runs").collect()} == {"success", "skipped", "failed"} and b.read("pipeline_runs").count() == 3
    assert [r["status"] for r in b.read("dataset_update_status").collect()] == ["success"]
