"""Analytics over pipeline logs: parsing, pairing of starts and ends, overlaps, gaps, carried context."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The shape of a log line and of the messages that matter.
LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}) .+ - (.*)$"
MESSAGES = {
    "run_started": "Daily update started run_id=",
    "run_completed": "Daily update completed run_id=",
    "api_started": "API started run_id=",
    "api_completed": "API completed run_id=",
    "stored": "Parquet stored run_id=",
    "flushed": "Pipeline metadata flush completed run_id=",
    "refetched": "refetching from 1990-01-01",
    "failed": "API failed for ",
}
NUMBERS = ("records", "success", "failed", "skipped")


def parsed(lines: DataFrame, value: str = "value") -> DataFrame:
    """``ts``, ``message``, ``event``, ``run_id``, ``action``, ``code``, ``dataset``, the counters of a completed run
    (``records``, ``success``, ``failed``, ``skipped``) and ``elapsed`` seconds; lines of another shape fall away."""
    rows = lines.select(F.regexp_extract(value, LINE, 1).alias("t"), F.regexp_extract(value, LINE, 2).alias("message"), *[c for c in lines.columns if c != value]).where("t != ''")
    said = F.col("message")
    event = F.coalesce(*[F.when(said.contains(p), F.lit(e)) for e, p in MESSAGES.items()])
    field = lambda name: F.nullif(F.regexp_extract(said, rf"(?:^|\s){name}=(\S+)", 1), F.lit(""))
    failing = F.nullif(F.regexp_extract(said, r"API failed for (\S+)", 1), F.lit(""))
    out = rows.select(F.try_to_timestamp("t", F.lit("yyyy-MM-dd HH:mm:ss.SSS")).cast("timestamp_ntz").alias("ts"), "message", event.alias("event"), *[c for c in lines.columns if c != value])
    done = F.col("event") == "run_completed"
    return out.select(
        "ts", "message", "event", field("run_id").alias("run_id"), field("action").alias("action"), F.coalesce(field("code"), failing).alias("code"), field("dataset").alias("dataset"),
        *[F.when(done, field(n).try_cast("long")).alias(n) for n in NUMBERS], F.when(F.col("event") == "flushed", F.rtrim(field("elapsed"), F.lit("s")).try_cast("double")).alias("elapsed"),
        *[c for c in lines.columns if c != value],
    )


def run_figures(rows: DataFrame, order: str, within: str) -> DataFrame:
    """A row a run from parsed lines: its counters, stored tables, flushes with their seconds, and refetches.

    A refetch without a run_id belongs to the run that is open where it is logged, if any.
    """
    started, done = F.col("event") == "run_started", F.col("event") == "run_completed"
    upto = Window.partitionBy(within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    current = F.last(F.when(started, F.col("run_id")).when(done, F.lit("")), ignorenulls=True).over(upto)
    own = rows.withColumn("run_id", F.coalesce("run_id", F.when(F.col("event") == "refetched", F.nullif(current, F.lit("")))))
    n = lambda e: F.count_if(F.col("event") == e)
    return own.where("run_id is not null").groupBy("run_id").agg(
        *[F.max(c).alias(c) for c in NUMBERS], n("stored").alias("stored"), n("flushed").alias("flushes"), F.round(F.coalesce(F.sum("elapsed"), F.lit(0.0)), 3).alias("flush_seconds"), n("refetched").alias("refetches"),
    )


def carried(rows: DataFrame, value: str, order: str, within: str) -> DataFrame:
    """``value`` of the last row that had one, in the order of each file."""
    upto = Window.partitionBy(within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(value, F.last(value, ignorenulls=True).over(upto))


def event_pairs(events: DataFrame, keys: list[str], kind: str, start: str, end: str, ts: str, order: str) -> DataFrame:
    """Starts and ends of each key, first in, first out: ``nth``, ``started_at``, ``ended_at``, ``state``, ``duplicate``.

    An end takes the oldest start that is open then (``paired``); one that finds none open is ``unmatched_end`` and
    changes nothing after it. A start that none takes is ``unmatched_start``; one while another is open is a duplicate.
    """
    past = Window.partitionBy(*keys).orderBy(ts, order).rowsBetween(Window.unboundedPreceding, 0)
    first = F.col(kind) == start
    rows = events.where(F.col(kind).isin(start, end)).select(*keys, first.alias("_start"), ts, order)
    # starts less ends; how far that has ever been below zero is how many ends found nothing open
    rows = rows.withColumn("_sum", F.sum(F.when(F.col("_start"), 1).otherwise(-1)).over(past))
    rows = rows.withColumn("_lost", -F.least(F.lit(0), F.min("_sum").over(past)))
    before = Window.partitionBy(*keys).orderBy(ts, order)
    orphan = ~F.col("_start") & (F.col("_lost") > F.coalesce(F.lag("_lost").over(before), F.lit(0)))
    rows = rows.withColumn("_orphan", orphan).withColumn("_open", F.col("_sum") + F.col("_lost"))
    nth = F.when(F.col("_start"), F.sum(F.col("_start").cast("long")).over(past)).when(F.col("_orphan"), F.col("_lost")).otherwise(F.sum((~F.col("_start") & ~F.col("_orphan")).cast("long")).over(past))
    both = rows.withColumn("nth", nth.cast("long")).groupBy(*keys, "_orphan", "nth").agg(
        F.max(F.when(F.col("_start"), F.col(ts))).alias("started_at"), F.max(F.when(~F.col("_start"), F.col(ts))).alias("ended_at"), F.max(F.col("_start") & (F.col("_open") > 1)).alias("duplicate")
    )
    state = F.when(F.col("_orphan"), "unmatched_end").when(F.col("ended_at").isNull(), "unmatched_start").otherwise("paired")
    return both.select(*keys, "nth", "started_at", "ended_at", state.alias("state"), "duplicate")


def overlapping_runs(runs: DataFrame, group: str, start: str, end: str, run: str) -> DataFrame:
    """Runs that the next one of their group starts before: those without an end, too."""
    following = Window.partitionBy(group).orderBy(start, run)
    rows = runs.withColumns({"next_run": F.lead(run).over(following), "next_start": F.lead(start).over(following)})
    return rows.where(F.col("next_start").isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col("next_start"))))


def silent_runs(lines: DataFrame, run: str, ts: str, finished: DataFrame, now: str, seconds: int) -> DataFrame:
    """Unfinished runs whose last line is at least so long before ``now``."""
    last = lines.groupBy(run).agg(F.max(ts).alias("last_line")).join(finished.select(run).distinct(), run, "left_anti")
    gap = F.timestamp_diff("SECOND", F.col("last_line"), F.lit(now).cast("timestamp_ntz"))
    return last.withColumn("silent_seconds", gap).where(F.col("silent_seconds") >= seconds)
