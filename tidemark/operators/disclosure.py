"""Report disclosures: which statements are due, which wait, and which are done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETENTION_DAYS = 30


def trigger() -> tuple[Column, Column]:
    """Date and priority of a disclosure: the actual date (3), else the last change (2), else the first plan (1)."""
    changed = F.coalesce("third_changed_date", "second_changed_date", "first_changed_date")
    day = F.coalesce("actual_disclosure_date", changed, "first_scheduled_date")
    rank = F.when(F.col("actual_disclosure_date").isNotNull(), 3).when(changed.isNotNull(), 2).when(F.col("first_scheduled_date").isNotNull(), 1)
    return day, rank


def candidates(calendar: DataFrame, effective: str | Column, start: str | Column) -> DataFrame:
    """``code``, ``report_period``, ``period_end_date``, ``trigger_date``, ``trigger_priority`` due between the dates."""
    as_date = lambda d: F.lit(d).cast("date") if isinstance(d, str) else d
    day, rank = trigger()
    rows = calendar.select("code", "report_period", "period_end_date", day.alias("trigger_date"), rank.alias("trigger_priority"))
    return rows.where(F.col("trigger_date").between(as_date(start), as_date(effective)))


def reduced(rows: DataFrame) -> DataFrame:
    """One row a code and period: the highest priority, then the latest date."""
    best = F.max(F.struct("trigger_priority", "trigger_date", "period_end_date")).alias("b")
    return rows.groupBy("code", "report_period").agg(best).select("code", "report_period", "b.period_end_date", "b.trigger_date", "b.trigger_priority")


def uncovered(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows whose period the facts lack."""
    return rows.join(facts.select("code", "period_end_date").distinct(), ["code", "period_end_date"], "left_anti")


def still_waiting(pending: DataFrame, effective: str, days: int = RETENTION_DAYS) -> DataFrame:
    end = F.lit(effective).cast("date")
    return pending.where(F.col("trigger_date").between(F.date_sub(end, days), end))


def pending_after(calendar: DataFrame, pending: DataFrame, facts: DataFrame, effective: str, start: str) -> DataFrame:
    """What to fetch now, and keep until it shows up: new candidates and what still waits, without what is there."""
    columns = ["code", "report_period", "period_end_date", "trigger_date", "trigger_priority"]
    rows = candidates(calendar, effective, start).select(*columns).unionByName(still_waiting(pending, effective).select(*columns))
    return uncovered(reduced(rows), facts)


def queue_after(queue: DataFrame, results: DataFrame) -> DataFrame:
    """A queue keyed by code after a drain: fetched codes are done, failed ones stay to be tried again."""
    told = results.select("code", F.when(F.col("ok"), "success").otherwise("failed_retryable").alias("_status"), F.col("at").alias("_at"))
    latest = told.groupBy("code").agg(F.max_by("_status", "_at").alias("_status"), F.max("_at").alias("_at"))
    rows = queue.join(latest, "code", "left")
    return rows.withColumns({"status": F.coalesce("_status", "status"), "updated_at": F.coalesce("_at", "updated_at")}).drop("_status", "_at")


RETRYABLE = ("pending", "failed_retryable")


def enqueued(queue: DataFrame, changed: DataFrame, dataset: str, reason: str, now: str) -> DataFrame:
    """The queue with each changed ``code`` waiting: its open rows start anew, a code without one gets a row.

    ``queue``: ``code``, ``trigger_dataset``, ``trigger_reason``, ``triggered_at``, ``status``, ``last_attempt_at``,
    ``error_stack``. Rows that are done stay as they are; null codes are ignored.
    """
    at = F.lit(now).cast("timestamp_ntz")
    fresh = {"trigger_dataset": F.lit(dataset), "trigger_reason": F.lit(reason), "triggered_at": at, "status": F.lit("pending"), "last_attempt_at": F.lit(None).cast("timestamp_ntz"), "error_stack": F.lit("")}
    codes = changed.where("code is not null").select("code").distinct()
    rows = queue.join(codes.withColumn("_hit", F.lit(True)), "code", "left")
    hit = F.col("_hit") & F.col("status").isin(*RETRYABLE)
    # all new values are from the old row: status is among them
    kept = rows.select("code", *[F.when(hit, v).otherwise(F.col(c)).alias(c) for c, v in fresh.items()])
    new = codes.join(queue.where(F.col("status").isin(*RETRYABLE)).select("code"), "code", "left_anti")
    return kept.unionByName(new.select("code", *[v.alias(c) for c, v in fresh.items()]))
