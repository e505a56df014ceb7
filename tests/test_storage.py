"""Files that are not opened, figures from footers, rules counted with the write, event ids, adjusted prices after new factors."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, quality, registry, selection
from tidemark.sources import feature_source
from tidemark.sources.tables import Lake, append_event, read_events
from tidemark.streaming import pipelines

D = dt.date
BAR = "date date, code string, open double, high double, low double, close double, volume long, amount double"


def test_series_of_other_symbols_are_not_opened(spark, tmp_path):
    rows = [(s, f, i, float(i) + 0.5) for s in ("sh600000", "sz000001", "sz000002") for f in ("open", "close") for i in range(5, 25) if i != 9]
    path = f"file://{tmp_path}"
    assert feature_source.write_series(spark.createDataFrame(rows, feature_source.SCHEMA), path) == 6
    got = feature_source.read_series(spark, path, part_bytes=100)
    assert got.rdd.getNumPartitions() == 6
    assert sorted(map(tuple, got.where("value is not null").collect())) == sorted(rows) and got.count() == 6 * 20
    # files whose reading fails stand for files that are read
    for name in ("sh600000/open", "sz000002/open", "sz000002/close"):
        (tmp_path / f"{name}.day.bin").write_bytes(b"abcde")
    few = feature_source.read_series(spark, path).where("symbol in ('sh600000', 'sz000001') and field = 'close' and idx > 20")
    assert sorted({(r["symbol"], r["field"], r["idx"]) for r in few.collect()}) == [(s, "close", i) for s in ("sh600000", "sz000001") for i in range(21, 25)]
    assert feature_source.read_series(spark, path).where("symbol = 'none'").count() == 0
    with pytest.raises(Exception, match="no whole number of float32"):
        feature_source.read_series(spark, path).where("symbol = 'sz000002'").count()


def test_figures_from_footers(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}")
    name = "baostock_cn_stock_daily_bar_unadjusted"
    rows = [(D(2024, 1, 1 + n), f"sh.60000{c}", 1.0, 2.0, 0.5, 1.5, 10, 1.0) for c in range(3) for n in range(4 + c)]
    lake.write(name, spark.createDataFrame(rows, BAR))
    with lake._footers():
        plan = lake._pushed(name)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(date), MAX(date)]" in plan
    got = {r["partition_value"]: (r["row_count"], r["min_date"], r["max_date"], r["files"]) for r in lake.partition_statistics(name).collect()}
    assert got == {f"sh.60000{c}": (4 + c, D(2024, 1, 1), D(2024, 1, 4 + c), 1) for c in range(3)}
    row = lake.inventory([name, "cn_stock_valuation"]).where(F.col("dataset") == name).first()
    size = sum(f.stat().st_size for f in (tmp_path / name).rglob("*.parquet"))
    assert (row["partitions"], row["latest_partition"], row["row_count"], row["files"], row["file_size_bytes"]) == (3, "sh.600002", 15, 3, size) and row["file_mtime"] is not None
    assert lake.file_statistics(name).first()["row_count"] == 15
    assert [r["files"] for r in lake.inventory(["cn_stock_valuation"]).collect()] == [0]
    assert registry.discovery(lake.inventory([name])).where("row_count is not null").count() == 1


def test_rules_are_counted_by_the_write(spark, tmp_path):
    """Each row passes the check's counter once, as it is written; a hard rule still stops the table from changing."""
    lake = Lake(spark, f"file://{tmp_path}", keeps_ledger=False)
    name = "akshare_cn_stock_spot_quote_sina"
    lake.write(name, spark.createDataFrame([("000001", "2024-01-02", 1.0)], "code string, trade_date string, last_price double"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    good = spark.createDataFrame([(f"{n:06d}", "2024-01-03", 1.0) for n in range(50)], "code string, trade_date string, last_price double")
    from tidemark.plans.specs import spec

    df, observation = quality.observed(good.mapInArrow(count, good.schema), spec(name))
    df.write.parquet(f"file://{tmp_path}/out")
    assert seen.value == 50 and observation.get["six_digits"] == 0
    bad = spark.createDataFrame([("x1", "2024-01-02", 2.0), ("000009", "2024-01-02", 2.0)], "code string, trade_date string, last_price double")
    with pytest.raises(quality.QualityError, match=r"six_digits 1 \(2024-01-02\|x1\)"):
        lake.write(name, bad)
    with pytest.raises(quality.QualityError, match="unique"):
        lake.write(name, bad.where("code = '000009'").union(bad.where("code = '000009'")))
    assert [tuple(r) for r in lake.read(name).select("code", "last_price").collect()] == [("000001", 1.0)]


def test_events_are_logged_once(spark, tmp_path):
    path, source = f"file://{tmp_path}/log", f"file://{tmp_path}/in"
    ddl = "dataset string, row_count long, min_date string, max_date string"
    for run in range(2):
        spark.range(20).selectExpr(f"concat('d', {run}, '-', id) dataset", "id row_count", "'a' min_date", "'b' max_date").repartition(3).write.mode("append").parquet(source)
        pipelines.logged(spark.readStream.schema(ddl).parquet(source), path, f"file://{tmp_path}/checkpoint").awaitTermination()
    rows = read_events(spark, path, 0, 100).collect()
    ids = [r["event_id"] for r in rows]
    assert len(rows) == 40 and len(set(ids)) == 40 and ids == sorted(ids) and {r["dataset"][:2] for r in rows[:20]} == {"d0"}
    again = spark.createDataFrame([(r["dataset"], r["row_count"], r["min_date"], r["max_date"]) for r in rows[20:]], ddl)
    pipelines.write_batch(again, 1, path)  # the second batch once more
    assert read_events(spark, path, 0, 100).count() == 40
    lake = Lake(spark, f"file://{tmp_path}/lake")
    for _ in range(2):
        append_event(spark, f"file://{tmp_path}/own", "baostock_cn_stock_basic", lake.read("baostock_cn_stock_basic"))
    assert [r["event_id"] for r in read_events(spark, f"file://{tmp_path}/own").collect()] == [1, 2]


def test_new_factors_touch_their_days_only(spark, tmp_path):
    from tidemark.plans import derived

    lake = Lake(spark, f"file://{tmp_path}")
    days = [D(2024, 1, 1) + dt.timedelta(days=n) for n in range(60)]
    bars = spark.createDataFrame([(d, f"sh.60000{c}", 10.0, 20.0, 5.0, 15.0, 10, 1.0) for c in range(3) for d in days], BAR)
    lake.write(derived.UNADJUSTED, bars)
    ddl = "code string, dividend_operate_date date, forward_adjust_factor double, backward_adjust_factor double, adjustment_factor double"
    first = spark.createDataFrame([(f"sh.60000{c}", D(2024, 1, d), f, b, b) for c in range(3) for d, f, b in ((10, 0.5, 2.0), (20, 0.8, 3.0))], ddl)
    assert derived.refresh_adjusted(lake, first) == {"qfq": 180, "hfq": 180}
    other = tmp_path / derived.UNADJUSTED / "code=sh.600001"
    for f in [*other.glob("*.parquet"), *(tmp_path / "baostock_cn_stock_daily_bar_hfq" / "code=sh.600001").glob("*.parquet")]:
        f.write_bytes(b"nothing")
    for f in [*other.glob(".*.crc"), *(tmp_path / "baostock_cn_stock_daily_bar_hfq" / "code=sh.600001").glob(".*.crc")]:
        f.unlink()
    new = spark.createDataFrame([("sh.600000", D(2024, 1, 10), 0.5, 2.0, 2.0), ("sh.600000", D(2024, 1, 20), 0.8, 3.0, 3.0), ("sh.600000", D(2024, 2, 20), 0.9, 3.0, 3.0), ("sh.600002", D(2024, 1, 10), 0.5, 2.5, 2.0), ("sh.600002", D(2024, 1, 20), 0.8, 3.0, 3.0)], ddl)
    assert derived.refresh_adjusted(lake, new) == {"qfq": 10, "hfq": 10}
    for adjustment, (factor, flag) in derived.ADJUSTED.items():
        got = lake.read_partitions(f"baostock_cn_stock_daily_bar_{adjustment}", spark.createDataFrame([("sh.600000",), ("sh.600002",)], "partition_value string"))
        want = asof.adjusted_bars(bars.where("code <> 'sh.600001'"), new, factor, flag)
        columns = ["code", "date", "open", "close", "volume", "adjust_flag"]
        assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    assert derived.refresh_adjusted(lake, new) == {"qfq": 0, "hfq": 0}


def test_exact_percentiles_by_narrowing(spark, tmp_path):
    rng = random.Random(6)
    values = [None, float("nan"), 0.0, -0.0, 5e-324, -1e300, 1e300, float("inf"), *[rng.uniform(-3, 3) for _ in range(300)], *[1.25] * 60]
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), rng.choice(values)) for _ in range(900)] + [("one", 2.5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    n = iter(range(99))

    def keep(part, name):
        path = f"file://{tmp_path}/{name}-{next(n)}"
        part.write.parquet(path)
        return spark.read.schema(part.schema).parquet(path)

    got = selection.exact_percentiles(df, "g", "v", {"median": 0.5, "p95": 0.95, "least": 0.0}, keep)
    want = df.where("v is not null and not isnan(v)").groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("median"), F.percentile("v", F.lit(0.95)).alias("p95"), F.min("v").alias("least"))
    a, b = ({r["g"]: tuple(r)[1:] for r in x.collect()} for x in (got, want))
    assert a.keys() == b.keys() == {"hot", "b", None, "one"}
    assert all(math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-300) for g in a for x, y in zip(a[g], b[g], strict=True))


def test_migration_is_verified(spark, tmp_path):
    from tidemark.sources.tables import MigrationError

    old = spark.createDataFrame([("000001", "2024-01-02", 1.5, "old_endpoint"), ("000002", "2024-01-03", 2.5, "kept")], "symbol string, day string, latest double, source_endpoint string")
    old.write.partitionBy("day").parquet(f"file://{tmp_path}/old")
    lake = Lake(spark, f"file://{tmp_path}/lake")
    name, renamed = "akshare_cn_stock_spot_quote_sina", {"symbol": "code", "day": "trade_date", "latest": "last_price"}
    assert lake.migrate(name, f"file://{tmp_path}/old", renamed, {"source_endpoint": {"old_endpoint": "stock_zh_a_spot"}}, {"fallback_reason": "migrated"}) == 2
    rows = [(r["code"], r["trade_date"], r["last_price"], r["source_endpoint"], r["fallback_reason"]) for r in lake.read(name).orderBy("code").collect()]
    assert rows == [("000001", D(2024, 1, 2), 1.5, "stock_zh_a_spot", "migrated"), ("000002", D(2024, 1, 3), 2.5, "kept", "migrated")]
    assert lake.read("dataset_partition_manifest").count() == 2
    changing = lake._fresh
    lake._fresh = lambda table, df: changing(table, df.where("code <> '000002'"))  # a write that loses rows
    with pytest.raises(MigrationError, match="1 rows were written of 2"):
        lake.migrate(name, f"file://{tmp_path}/old", renamed)
    assert lake.read(name).count() == 2


def test_partitions_that_share_files(spark, tmp_path):
    """With ``groups`` many partitions take few files, and each is still replaced, read, deleted and entered by itself."""
    from tidemark.plans.specs import SPECS, TableSpec, columns, register

    if "shared_bars" not in SPECS:
        register(TableSpec("shared_bars", columns("string: code; date: date; double: close"), ("code", "date"), "code", rules=("unique",), date_column="date"))
    lake = Lake(spark, f"file://{tmp_path}/lake", groups=4)
    rows = spark.range(300).selectExpr("concat('c', id % 100) as code", "date_add(date '2024-01-01', cast(id div 100 as int)) as date", "cast(id as double) as close")
    lake.write("shared_bars", rows)
    assert len(list((tmp_path / "lake" / "shared_bars").rglob("*.parquet"))) <= 4
    assert lake.partition_names("shared_bars").count() == 100
    lake.write("shared_bars", rows.where("code = 'c7'").withColumn("close", F.lit(-1.0)).limit(1))
    lake.write("shared_bars", rows.where("code = 'c8'").limit(1).withColumn("close", F.lit(-2.0)), "upsert")
    got = {(r["code"], str(r["date"])): r["close"] for r in lake.read("shared_bars").collect()}
    assert len(got) == 298 and [v for (c, _), v in got.items() if c == "c7"] == [-1.0]
    assert sorted(v for (c, _), v in got.items() if c == "c8")[0] == -2.0 and sum(c == "c8" for c, _ in got) == 3
    lake.delete_partitions("shared_bars", ["c9"])
    assert lake.read("shared_bars").count() == 295
    assert lake.read_partitions("shared_bars", spark.createDataFrame([("c1",), ("c9",)], "partition_value string")).count() == 3
    held = lake.read("dataset_partition_manifest").where("dataset = 'shared_bars'")
    assert held.count() == 99 and held.where("partition_value = 'c7'").first()["row_count"] == 1
    told = lake.inventory(["shared_bars"]).first()
    assert (told["partitions"], told["row_count"]) == (99, 295) and told["files"] <= 4
    lake.delete_partitions("shared_bars", [f"c{i}" for i in range(100) if i != 9])
    assert lake.read("shared_bars").count() == 0
    lake.write("shared_bars", rows.where("code = 'c7'"))
    assert lake.read("shared_bars").count() == 3
