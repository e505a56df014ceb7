"""As-of joins and price adjustment without range joins: union both sides and carry the last value forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PRICES = ("open", "high", "low", "close", "prev_close")


def asof_backward(left: DataFrame, right: DataFrame, key: str, left_on: str, right_on: str, values: list[str]) -> DataFrame:
    """``left`` with the ``values`` of the latest ``right`` row of its key at or before its time; null if none.

    One exchange by key and one sort, whatever the time range. Right rows with a null key, time or value are ignored;
    left rows with a null time get nulls. All rows of a key meet in one task: keys are entities, whose series are
    bounded by time, not by the size of the data.
    """
    known = right.where(F.col(key).isNotNull() & F.col(right_on).isNotNull())
    held = F.struct(*[F.col(v) for v in values])
    some = known.where(F.greatest(*[F.col(v).isNotNull() for v in values])) if len(values) > 1 else known.where(F.col(values[0]).isNotNull())
    marks = some.select(F.col(key).alias("_key"), F.col(right_on).alias("_at"), F.lit(0).alias("_side"), held.alias("_value"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"))
    rows = left.select(F.col(key).alias("_key"), F.col(left_on).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(marks.schema["_value"].dataType).alias("_value"), F.struct("*").alias("_row"))
    upto = Window.partitionBy("_key").orderBy(F.col("_at").asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = marks.unionByName(rows).withColumn("_found", F.last("_value", ignorenulls=True).over(upto)).where("_side = 1")
    return found.select("_row.*", *[F.col(f"_found.{v}").alias(v) for v in values])


def adjusted_bars(bars: DataFrame, factors: DataFrame, factor: str, flag: str, factor_date: str = "dividend_operate_date") -> DataFrame:
    """Bars with prices times the factor in force (1 before the first), and ``adjust_flag`` set; volumes stay."""
    joined = asof_backward(bars, factors.select("code", F.col(factor_date).alias("_from"), F.col(factor).alias("_factor")), "code", "date", "_from", ["_factor"])
    times = F.coalesce("_factor", F.lit(1.0))
    prices = {p: F.col(p) * times for p in PRICES if p in bars.columns}
    return joined.withColumns(prices | {"adjust_flag": F.lit(flag)}).select(*dict.fromkeys([*bars.columns, "adjust_flag"]))


def members_on(bars: DataFrame, membership: DataFrame, symbol: str = "code", date: str = "date") -> DataFrame:
    """Bars with each universe whose closed membership interval holds their date; the symbol keeps it an equi-join."""
    spans = membership.select(F.col(symbol).alias("_symbol"), "universe", "start_date", "end_date")
    return bars.join(spans, (F.col(symbol) == F.col("_symbol")) & F.col(date).between(F.col("start_date"), F.col("end_date"))).drop("_symbol")
