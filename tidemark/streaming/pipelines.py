"""Structured Streaming forms: tailing an event log, upserting late rows, draining queues, sessions of activity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.disclosure import queue_after
from ..sources.tables import EVENT_SCHEMA, Lake


def event_tail(spark: SparkSession, path: str, since: int = 0) -> DataFrame:
    """New lines of an event log as they arrive."""
    return spark.readStream.schema(EVENT_SCHEMA).json(path).where(F.col("event_id") > since).select(*EVENT_SCHEMA.names)


#: Bits of an event id: the batch, the task within it, the place within the task's rows.
_TASK_BITS, _ROW_BITS = 12, 28


def numbered(batch: DataFrame, number: int) -> DataFrame:
    """``batch`` with ``event_id``, greater than all of earlier batches: from the batch's number, the task and the place in it."""
    own = F.monotonically_increasing_id()
    task, row = F.shiftright(own, 33), own.bitwiseAND((1 << 33) - 1)
    fits = (task < (1 << _TASK_BITS)) & (row + 1 < (1 << _ROW_BITS))
    at = F.lit(number << (_TASK_BITS + _ROW_BITS)) + F.call_function("shiftleft", task, F.lit(_ROW_BITS)) + row + 1
    return batch.withColumn("event_id", F.when(fits, at).otherwise(F.raise_error(F.lit("a batch of more rows than event ids hold"))))


def logged(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream of events to a log, each once: a batch that runs again replaces its own lines, under the same ids.

    ``events`` have the columns of the log but for the id, which nobody has to invent.
    """

    def put(batch: DataFrame, number: int) -> None:
        write_batch(batch, number, path)

    return events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_batch(batch: DataFrame, number: int, path: str) -> None:
    rows = numbered(batch, number).select("event_id", *[c for c in EVENT_SCHEMA.names if c != "event_id"])
    rows.write.mode("overwrite").json(f"{path}/batch={number:010d}")


def upserts(rows: DataFrame, lake: Lake, table: str, checkpoint: str, skip_existing: bool = False, order: list[str] | None = None) -> StreamingQuery:
    """Each micro-batch merged into a table: a later row replaces an earlier one of its key.

    A batch that runs again merges the same rows to the same end. Within a batch the last row by ``order`` stands.
    ``skip_existing`` ignores late duplicates, a partition at a time.
    """

    def merge(batch: DataFrame, _: int) -> None:
        from ..operators.merge import latest_per_key
        from ..plans.specs import spec

        own = latest_per_key(batch, list(spec(table).keys), order) if order else batch
        if own.take(1):
            lake.write(table, own, "upsert", skip_existing)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drains(results: DataFrame, read_queue: Callable[[], DataFrame], write_queue: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Fetch results applied to a queue table: done codes leave it, failed ones stay."""

    def apply(batch: DataFrame, _: int) -> None:
        write_queue(queue_after(read_queue(), batch))

    return results.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_within(rows: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Late duplicates dropped while the watermark remembers their first."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def activity_sessions(rows: DataFrame, key: str, ts: str, gap: str, delay: str | None = None) -> DataFrame:
    """``key``, ``started_at``, ``ended_at``, ``rows``: runs of activity that a gap ends; batch or stream."""
    source = rows.withWatermark(ts, delay) if delay else rows
    window = F.session_window(ts, gap)
    out = source.groupBy(key, window.alias("w")).agg(F.count("*").alias("rows"))
    return out.select(key, F.col("w.start").alias("started_at"), F.col("w.end").alias("ended_at"), "rows")
