"""Calendar years, quarters, report periods, trading days and business hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Report period suffixes and the quarter ends they mean.
PERIODS = {"一季": "03-31", "半年报": "06-30", "三季": "09-30", "年报": "12-31"}


def years_before(date: Column, years: int) -> Column:
    """The same day ``years`` calendar years earlier; 29 February becomes the 28th."""
    return F.add_months(date, -12 * years)


def period_end(period: Column) -> Column:
    """The quarter end of ``2024年报`` and the like; null if it is none."""
    year, suffix = F.substring(period, 1, 4), F.substring(period, 5, 10)
    day = F.coalesce(*[F.when(suffix == s, F.lit(d)) for s, d in PERIODS.items()])
    return F.try_to_date(F.concat(year, F.lit("-"), day), "yyyy-MM-dd")


def report_period(date: Column) -> Column:
    day = F.date_format(date, "MM-dd")
    return F.concat(F.date_format(date, "yyyy"), F.coalesce(*[F.when(day == d, F.lit(s)) for s, d in PERIODS.items()]))


def is_quarter_end(date: Column) -> Column:
    return (F.last_day(date) == date) & (F.month(date) % 3 == 0)


def quarter_end(date: Column) -> Column:
    """End of the quarter that holds ``date``."""
    return F.last_day(F.add_months(F.trunc(date, "quarter"), 2))


def next_quarter_end(date: Column) -> Column:
    return F.last_day(F.add_months(quarter_end(date), 3))


def previous_quarter_end(date: Column) -> Column:
    return F.last_day(F.add_months(quarter_end(date), -3))


def compact(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def quarter_sequence(start: Column, end: Column) -> Column:
    """Quarter ends from ``start`` to ``end``, both included, as an array."""
    ends = F.transform(F.sequence(F.trunc(start, "quarter"), F.trunc(end, "quarter"), F.expr("interval 3 months")), lambda d: F.last_day(F.add_months(d, 2)))
    return F.filter(F.when(start <= end, ends).otherwise(F.array().cast("array<date>")), lambda d: d.between(start, end))


def completed_quarters(start: Column, today: Column, last: int | None = None) -> Column:
    """Quarter ends before ``today`` from ``start`` on, or the ``last`` of them."""
    ends = quarter_sequence(start, F.date_sub(today, 1))
    return F.slice(ends, F.greatest(F.size(ends) - last + 1, F.lit(1)), last) if last else ends


def rolling_periods(today: Column, count: int = 5) -> Column:
    """``count`` quarter ends, from the last one on or before ``today`` onwards."""
    first = F.last_day(F.add_months(F.trunc(F.date_add(today, 1), "quarter"), -1))
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.last_day(F.add_months(first, i * 3)))


def effective_date(stamp: Column, cutoff: str = "18:00") -> Column:
    """The day itself, from the cutoff on the next one."""
    return F.date_add(stamp.cast("date"), F.when(F.date_format(stamp, "HH:mm") >= cutoff, 1).otherwise(0))


def candidate_market_date(stamp: Column, cutoff: str = "18:00") -> Column:
    """The day itself, before the cutoff the one before."""
    return F.date_sub(stamp.cast("date"), F.when(F.date_format(stamp, "HH:mm") < cutoff, 1).otherwise(0))


def incremental_start(effective: Column, last: Column, days: int = 14) -> Column:
    return F.least(F.date_sub(effective, days), last)


def market_session_due(natural: Column, candidate: Column, market: Column, overridden: Column | None = None) -> Column:
    """Friday to Sunday, or when the market's date isn't the candidate's, or when the caller says so."""
    return F.dayofweek(natural).isin(1, 6, 7) | (candidate != market) | (F.lit(False) if overridden is None else F.coalesce(overridden, F.lit(False)))


def quotes_are_final(stamp: Column, trading: Column, opens: str = "18:00", closes: str = "08:00") -> Column:
    """After hours, or at any hour of a day without trading."""
    hour = F.date_format(stamp, "HH:mm")
    return (hour >= opens) | (hour < closes) | ~F.coalesce(trading, F.lit(False))


def is_trading(flag: Column) -> Column:
    return F.coalesce(F.lower(F.trim(flag.cast("string"))).isin("1", "true", "t", "yes"), F.lit(False))


def trading_days(calendar: DataFrame, day: str = "calendar_date", flag: str = "is_trading_day", order: str | None = None) -> DataFrame:
    """``day`` of each date that trades; of repeated dates the last row (by ``order``) tells."""
    latest = calendar.groupBy(day).agg(F.max_by(flag, order or flag).alias(flag))
    return latest.where(is_trading(F.col(flag))).select(day)


def latest_trading_day(calendar: DataFrame, day: str = "calendar_date", flag: str = "is_trading_day") -> DataFrame:
    """One row ``latest``: the last day that trades, null if none does."""
    return trading_days(calendar, day, flag).agg(F.max(day).alias("latest"))


def trading_day_map(calendar: DataFrame, day: str = "calendar_date", flag: str = "is_trading_day") -> DataFrame:
    """For each date of a calendar: ``on_or_before`` and ``on_or_after``, the trading days around it.

    A calendar has one row a day, so one window over all of it holds a few ten thousand rows.
    """
    back = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.orderBy(day).rowsBetween(0, Window.unboundedFollowing)
    own = F.when(is_trading(F.col(flag)), F.col(day))
    return calendar.select(day, F.last(own, ignorenulls=True).over(back).alias("on_or_before"), F.first(own, ignorenulls=True).over(ahead).alias("on_or_after"))


def lookback_start(calendar: DataFrame, end: str | None, days: int, day: str = "calendar_date", flag: str = "is_trading_day") -> DataFrame:
    """One row ``start``: the ``days``-th trading day back from ``end`` (from the calendar's last day if None), or the first there is."""
    upto = trading_days(calendar, day, flag)
    if end is not None:
        upto = upto.where(F.col(day) <= F.lit(end).cast("date"))
    return upto.orderBy(F.desc(day)).limit(days).agg(F.min(day).alias("start"))


def calendar_around(rows: DataFrame, day: str, margin: int = 400) -> DataFrame:
    """A calendar like that of :func:`calendar_between` from ``margin`` days before the first to as many after the last date of ``rows``."""
    ends = rows.agg(F.date_sub(F.min(day), margin).alias("a"), F.date_add(F.max(day), margin).alias("b")).where("a is not null")
    return _weekdays(ends.select(F.explode(F.sequence("a", "b")).alias("calendar_date")))


def calendar_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """A calendar of all days with Monday to Friday trading, for data without one of its own."""
    return _weekdays(spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("calendar_date")))


def _weekdays(days: DataFrame) -> DataFrame:
    return days.withColumn("is_trading_day", F.when(F.dayofweek("calendar_date").between(2, 6), "1").otherwise("0"))
