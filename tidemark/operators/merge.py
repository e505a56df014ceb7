"""Keep-last and ranked merges, conflicts and coverage: everything that decides which of two rows stands."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONFIRMED, SPOT_CLOSE = "daily_bar_confirmed", "spot_quote_close"


def keep_last(existing: DataFrame, incoming: DataFrame, keys: list[str], order: Column | str | None = None) -> DataFrame:
    """The union with one row a key: the incoming one before the existing one, within each the last by ``order``.

    ``order`` may be a column that only the incoming rows have, such as that of their arrival. Without it rows of one
    side and key are told apart by their contents, so reruns agree.
    """
    columns = existing.columns

    def side(df: DataFrame, n: int) -> DataFrame:
        own = order if isinstance(order, Column) else F.col(order) if order in df.columns else F.lit(None)
        return df.select(*columns, F.lit(n).alias("_side"), own.alias("_order"))

    latest = Window.partitionBy(*keys).orderBy(F.desc("_side"), F.col("_order").desc_nulls_last(), F.xxhash64(*columns).desc())
    both = side(existing, 0).union(side(incoming, 1))
    return both.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").select(*columns)


def range_replaced(existing: DataFrame, fresh: DataFrame, keys: list[str], day: str, start: str, end: str) -> DataFrame:
    """``existing`` outside the closed range (a null date goes), plus ``fresh``, one row a key."""
    outside = existing.where(~F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return keep_last(outside, fresh, keys)


def replaced_from(existing: DataFrame, recomputed: DataFrame, day: str, start: str) -> DataFrame:
    """Rows before ``start`` as they are, from there on as recomputed."""
    since = F.lit(start).cast("date")
    return existing.where(F.col(day) < since).unionByName(recomputed.where(F.col(day) >= since).select(*existing.columns))


def source_rank(first_source: str) -> Column:
    """0 for the preferred source, 1 for confirmed bars, 2 for closes taken from quotes, 3 for the rest."""
    return (
        F.when(F.col("source_dataset").startswith(first_source), 0).when(F.col("quality_status") == CONFIRMED, 1)
        .when(F.col("quality_status") == SPOT_CLOSE, 2).otherwise(3)
    )


def best_ranked(rows: DataFrame, keys: list[str], rank: Column, tie: list[Column]) -> DataFrame:
    """One row a key: the least rank, ties by ``tie``."""
    best = Window.partitionBy(*keys).orderBy(rank, *tie)
    return rows.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def keys_covered(existing: DataFrame, incoming: DataFrame, keys: list[str], group: str) -> DataFrame:
    """``group``, ``covered`` for each group of ``incoming``: whether all its keys exist already (compared as text)."""
    as_text = [F.col(k).cast("string").alias(k) for k in keys]
    known = existing.select(*as_text).distinct().withColumn("_known", F.lit(True))
    asked = incoming.select(F.col(group).cast("string").alias("_group"), *as_text)
    return asked.join(known, keys, "left").groupBy(F.col("_group").alias(group)).agg(F.min(F.coalesce("_known", F.lit(False))).alias("covered"))


def new_partitions_only(existing: DataFrame, incoming: DataFrame, keys: list[str], group: str) -> DataFrame:
    """``incoming`` without the groups whose keys all exist already."""
    done = keys_covered(existing, incoming, keys, group).where("covered").select(F.col(group).alias("_done"))
    return incoming.join(done, F.col(group).cast("string") == F.col("_done"), "left_anti")


def overlap_conflicts(existing: DataFrame, fresh: DataFrame, key: str, day: str, compared: list[str], start: str, end: str) -> DataFrame:
    """``key``, ``conflict`` for keys with existing rows in the range.

    A conflict is an existing row that the fresh ones lack, or one that differs in a compared column (null equals null).
    """
    span = F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    mine = existing.where(span).select(key, day, *compared)
    theirs = fresh.where(span).select(key, day, F.lit(True).alias("_there"), *[F.col(c).alias(f"_{c}") for c in compared])
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in compared], F.col("_there").isNull())
    return mine.join(theirs, [key, day], "left").groupBy(key).agg(F.max(differs).alias("conflict"))


def changed_sets(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``key`` of each group whose rows differ between the two, whatever their order."""
    sign = lambda df, name: df.groupBy(key).agg(F.count("*").alias(f"{name}_n"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias(f"{name}_h"))
    both = sign(old, "old").join(sign(new, "new"), key, "full")
    return both.where(~(F.col("old_n").eqNullSafe(F.col("new_n")) & F.col("old_h").eqNullSafe(F.col("new_h")))).select(key)


def refetch_decisions(conflicts: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``key``, ``decision``: full where nothing existed in the lookback or it conflicts, else merge."""
    known = keys.select(key).distinct().join(conflicts, key, "left")
    return known.select(key, F.when(F.coalesce("conflict", F.lit(True)), "full").otherwise("merge").alias("decision"))


def stale_values(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Values of the target that no source row has: partitions to delete."""
    return target.select(column).distinct().join(source.select(column).distinct(), column, "left_anti")


def first_seen(rows: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values in the order of their first appearance."""
    return rows.groupBy(value).agg(F.min(order).alias(order)).orderBy(order)


def skippable_tasks(tasks: DataFrame, held: DataFrame, calendar: DataFrame, endpoint: str, by: list[str] | None = None) -> DataFrame:
    """Tasks (``code`` and ``by``) that need no fetch: the latest held row of the code came from the confirmed
    ``endpoint`` and isn't older than the latest trading day. Without a trading day none is skippable."""
    keys = ["code", *(by or [])]
    last = held.where("date is not null").groupBy(*keys).agg(F.max_by("source_endpoint", "date").alias("source_endpoint"), F.max("date").alias("date"))
    trading = calendar.where("is_trading_day = '1'").agg(F.max("calendar_date").alias("_day"))
    return tasks.join(last, keys).join(F.broadcast(trading)).where((F.col("source_endpoint") == endpoint) & (F.col("date") >= F.col("_day"))).select(*tasks.columns)
