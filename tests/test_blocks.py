"""Blocks against the window forms, on tables with one key, with nulls and ties; bounded groups; deltas against the whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import asof, blocks, percentile

D = dt.date


def some_day(rng, years=3):
    return None if rng.random() < 0.03 else D(2020, 1, 1) + dt.timedelta(days=rng.randrange(365 * years))


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def test_asof_of_one_key(spark):
    rng = random.Random(1)
    left = [("k" if n % 20 else None, some_day(rng), n, "x") for n in range(800)]
    right = [(rng.choice(["k", "k", "other", None]), some_day(rng), rng.choice([None, float(n)]), n) for n in range(60)]
    a = spark.createDataFrame(left, "code string, date date, n long, _value string")
    b = spark.createDataFrame(right, "code string, day date, factor double, m long").dropDuplicates(["code", "day"])
    a = a.withColumnRenamed("_value", "tag")
    for days in (1, 7, 64, 5000):
        got = blocks.asof_in_blocks(a, b, "code", "date", "day", ["factor", "m"], days)
        want = asof.asof_backward(a, b, "code", "date", "day", ["factor", "m"]).withColumns({c: F.when(F.col("date").isNotNull(), F.col(c)) for c in ("factor", "m")})
        assert sorted_rows(got) == sorted_rows(want.select(*got.columns))


def test_carry_sends_one_row_a_block(spark):
    """No group of the plan holds more than a block, whatever the key holds."""
    rows = spark.range(20_000).select(F.lit("k").alias("k"), "id", F.when(F.col("id") % 997 == 5, F.col("id")).alias("v"))
    got = blocks.carried_in_blocks(rows, ["k"], F.floor(F.col("id") / 500), [F.col("id")], "v", "filled")
    want = rows.withColumn("filled", F.last("v", ignorenulls=True).over(Window.partitionBy("k").orderBy("id")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and plan.count("_block") > 0
    largest = rows.groupBy("k", F.floor(F.col("id") / 500)).count().agg(F.max("count")).first()[0]
    assert largest == 500


@pytest.mark.parametrize("range_samples", [7, 10**6])
def test_percentiles_of_one_key(spark, range_samples):
    """Many rows a day, ties, zeros and nulls, cut into many ranges or one: the same as the whole key in one task."""
    rng = random.Random(2)
    value = lambda: rng.choice([None, float("nan"), 0.0, *[round(rng.uniform(-5, 9), 1) for _ in range(20)]])
    rows = [(rng.choice(["k"] * 9 + [None, "small"]), some_day(rng, 12), value()) for _ in range(1500)]
    rows += [("k", D(2024, 2, 29), 3.0)] * 40
    df = spark.createDataFrame(rows, "code string, date date, v double")
    got, want = blocks.percentiles_in_blocks(df, "v", range_samples=range_samples), percentile.percentiles(df, ["v"])
    flat = lambda x: sorted(tuple("-" if v is None or v != v else f"{v:.9f}" if isinstance(v, float) else str(v) for v in r) for r in x.collect())
    assert flat(got) == flat(want)
    assert blocks.percentiles_in_blocks(df.limit(0), "v").count() == 0


def test_deltas_equal_the_whole(spark):
    rng = random.Random(4)
    bars = spark.createDataFrame([(f"c{n % 7}", D(2021, 1, 1) + dt.timedelta(days=n // 7), float(n), 1.0, 2.0, 3.0) for n in range(1400)], "code string, date date, open double, high double, low double, close double")
    steps = {(f"c{rng.randrange(8)}", D(2020, 12, 1) + dt.timedelta(days=rng.randrange(240))): rng.uniform(0.5, 2) for _ in range(40)}
    changed = {k: (v if rng.random() < 0.7 else v + 1) for k, v in steps.items() if rng.random() < 0.9} | {("c3", D(2021, 3, 3)): 7.0, ("c9", D(2021, 1, 1)): 2.0}
    ddl = "code string, dividend_operate_date date, backward_adjust_factor double"
    old, new = (spark.createDataFrame([(*k, v) for k, v in x.items()], ddl) for x in (steps, changed))
    of = lambda f: asof.adjusted_bars(bars, f, "backward_adjust_factor", "1")
    spans = blocks.changed_spans(old, new, "code", "dividend_operate_date", "backward_adjust_factor")
    fresh = blocks.readjusted(bars, new, spans, "backward_adjust_factor", "1")
    whole_old, whole_new = of(old), of(new)
    keys = ["code", "date"]
    merged = whole_old.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)
    assert sorted_rows(merged.select(*sorted(merged.columns))) == sorted_rows(whole_new.select(*sorted(merged.columns)))
    differ = whole_new.exceptAll(whole_old).count()
    assert differ <= fresh.count() < bars.count() * 0.6
    ranges = [(r["code"], r["start"], r["end"]) for r in spans.orderBy("code", "start").collect()]
    assert all(a[2] < b[1] for a, b in zip(ranges, ranges[1:], strict=False) if a[0] == b[0])
    assert blocks.changed_spans(new, new, "code", "dividend_operate_date", "backward_adjust_factor").count() == 0
