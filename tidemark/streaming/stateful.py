"""Queues (by ``transformWithState``) and best rows (by aggregation) kept in the state of a stream: no table is read back in a batch.

Each operator gives a stream of changes in update mode, a row for what a batch changed. :func:`changes_to` writes them a
batch a folder, so a batch that runs twice leaves its rows once, and :func:`current` reads the latest of each key.
Times are kept in the state as UTC numbers (microseconds, days), whatever the session's time zone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.disclosure import RETENTION_DAYS

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DAY_MS = 86_400_000
#: Groups of codes that share a state value: some hundreds of codes each for millions of them.
GROUPS = 1 << 14
ENQUEUE, SUCCESS, FAILURE = "enqueue", "success", "failure"


def with_state_store(spark: SparkSession) -> None:
    """Named states and timers need the RocksDB store; a store of another kind that the session names is left alone."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, _ROCKSDB)


def utc_micros(ts: str | Column) -> Column:
    """A time without zone (or one with it, as the session shows it) as microseconds since 1970."""
    at = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at)


def from_micros(micros: str) -> Column:
    return F.timestamp_add("MICROSECOND", F.col(micros), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


class _RefreshQueue(StatefulProcessor):
    """The open row of a code, and how many it has had; one value a code, so a batch reads and writes each once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "nth long, version long, open boolean, dataset string, reason string, triggered long, status string, attempted long, error string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        nth, version, is_open, *last = self.held.get() or (0, 0, False)
        row = tuple(last) if is_open else None
        shown: dict[int, tuple] = {}
        for e in sorted(rows, key=lambda e: (e["at"], e["seq"])):
            if e["kind"] == ENQUEUE:
                if row is None:
                    nth += 1
                row = (e["dataset"], e["reason"], e["at"], "pending", None, "")
            elif row is not None and e["kind"] in (SUCCESS, FAILURE):
                done = e["kind"] == SUCCESS
                row = (*row[:3], "success" if done else "failed_retryable", e["at"], "" if done else e["error"] or "")
            else:
                continue  # a result that nothing asked for
            shown[nth] = row
            if row[3] == "success":
                row = None
        if not shown:
            return
        version += 1
        self.held.update((nth, version, row is not None, *(row or (None,) * 6)))
        for n, (dataset, reason, triggered, status, attempted, error) in shown.items():
            yield Row(code=key[0], nth=n, version=version, trigger_dataset=dataset, trigger_reason=reason, triggered=triggered, status=status, attempted=attempted, error_stack=error)

    def close(self) -> None:
        pass


def refresh_queue(events: DataFrame) -> DataFrame:
    """Changes of a queue of codes to fetch again, from a stream of ``code``, ``kind``, ``at``, ``seq``, ``dataset``, ``reason``, ``error``.

    ``enqueue`` starts the code's open row anew or opens one; ``success`` closes it, ``failure`` leaves it to be tried
    again; a result without an open row says nothing, nor do rows without a code. Events of a batch apply in the order
    of ``at`` (null first) and ``seq``, batches in theirs. Gives ``code``, ``nth`` (which row of the code), ``version``,
    ``trigger_dataset``, ``trigger_reason``, ``triggered_at``, ``status``, ``last_attempt_at``, ``error_stack``; the
    latest version of each (code, nth) is the queue.
    """
    rows = events.where("code is not null").select(
        F.col("code").cast("string"), "kind", F.coalesce(utc_micros("at"), F.lit(-(1 << 62))).alias("at"), F.coalesce(F.col("seq").cast("long"), F.lit(0).cast("long")).alias("seq"),
        *[F.col(c).cast("string") for c in ("dataset", "reason", "error")],
    )
    out = "code string, nth long, version long, trigger_dataset string, trigger_reason string, triggered long, status string, attempted long, error_stack string"
    changed = rows.groupBy("code").transformWithState(_RefreshQueue(), T.StructType.fromDDL(out), "Update", "None")
    return changed.select("code", "nth", "version", "trigger_dataset", "trigger_reason", from_micros("triggered").alias("triggered_at"), "status", from_micros("attempted").alias("last_attempt_at"), "error_stack")


class _Disclosures(StatefulProcessor):
    """What each code of a group has announced and what is there, with one timer for the next day on which that changes what is due.

    A group's codes are one value, so a batch reads and writes it once whatever the number of codes and announcements;
    only codes that have news or whose day has come are looked at. Announcements that are over stay so, as the watermark
    only advances: of a period's the first in order is kept, the others are forgotten.
    """

    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # JSON: the day of the timer, and by code: waiting [period, triggered, priority, ends], over {period: [priority,
        # triggered, ends]}, covered [ends], shown {period: [ends, triggered, priority, status, version]}, next day
        self.held = handle.getValueState("held", "told string")

    def _load(self) -> tuple[int | None, dict[str, list]]:
        got = self.held.get()
        return (None, {}) if got is None else tuple(json.loads(got[0]))

    def _changes(self, code: str, day: int, own: list) -> Iterator[Row]:
        """Changes of a code as of ``day``; ``own`` is brought up to that."""
        waiting, over, covered, shown, _ = own
        best: dict[str, tuple] = {}
        left = []
        for period, triggered, priority, ends in waiting:
            gone = triggered < day - self.days
            if not gone:
                left.append((period, triggered, priority, ends))
            if triggered <= day:
                kept = over if gone else best
                mine = (priority, triggered, ends)
                kept[period] = max(tuple(kept.get(period, mine)), mine)
        for period in over.keys() | best.keys():
            priority, triggered, ends = best.get(period) or over[period]
            status = "covered" if ends in covered else "pending" if period in best else "expired"
            held = shown.get(period)
            # what was over before it was ever due is no news
            if tuple(held or ())[:4] == (ends, triggered, priority, status) or (held is None and status == "expired"):
                continue
            version = (held[4] if held else 0) + 1
            shown[period] = (ends, triggered, priority, status, version)
            yield Row(code=code, report_period=period, ends=ends, triggered=triggered, trigger_priority=priority, status=status, version=version)
        # due from its day on, over after the days that it is kept
        ahead = min((w[1] if w[1] > day else w[1] + self.days + 1 for w in left), default=None)
        own[0], own[4] = left, ahead

    def _settle(self, now: int, timer: int | None, codes: dict[str, list], news: dict[str, tuple[set, set]]) -> Iterator[Row]:
        day = now // _DAY_MS
        for code, (announced, facts) in news.items():
            own = codes.setdefault(code, [[], {}, [], {}, None])
            own[0] = list(announced.union(map(tuple, own[0])))
            own[2] = list(facts.union(own[2]))
        for code, own in codes.items():
            if code in news or (own[4] is not None and own[4] <= day):
                yield from self._changes(code, day, own)
        ahead = min((own[4] for own in codes.values() if own[4] is not None), default=None)
        if ahead != timer:
            if timer is not None and timer > day:
                self.handle.deleteTimer(timer * _DAY_MS)
            if ahead is not None:
                self.handle.registerTimer(ahead * _DAY_MS)
        self.held.update((json.dumps((ahead, codes), separators=(",", ":")),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        news: dict[str, tuple[set, set]] = {}
        for r in rows:
            announced, facts = news.setdefault(r["code"], (set(), set()))
            if r["kind"] == "fact":
                facts.add(r["ends"])
            else:
                announced.add((r["period"], r["triggered"], r["priority"], r["ends"]))
        yield from self._settle(timerValues.getCurrentWatermarkInMs(), *self._load(), news)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        timer, codes = self._load()
        if timer is not None and timer * _DAY_MS <= timerValues.getCurrentWatermarkInMs():  # else the batch's own rows have brought it up to date
            yield from self._settle(timerValues.getCurrentWatermarkInMs(), timer, codes, {})

    def close(self) -> None:
        pass


def disclosures(events: DataFrame, delay: str = "0 seconds", days: int = RETENTION_DAYS, groups: int = GROUPS) -> DataFrame:
    """Changes of what waits to be fetched, from a stream of announcements and of what has shown up.

    ``events``: ``kind`` (``announced`` or ``fact``), ``code``, ``at`` (a time), and ``period_end_date``; announcements
    also have ``report_period``, ``trigger_date`` and ``trigger_priority``. The effective day is that of the watermark,
    ``delay`` behind the latest ``at``. An announcement is due from its trigger date on for ``days`` days; of those of a
    period that are due the highest priority, then the latest date counts; a fact covers every period that ends with it.
    Days pass by timers, so a row falls due or expires without further events of its code. The state is held by ``groups``
    groups of codes (by hash, fixed for the life of a checkpoint): each access to it is a call from Python to the store,
    so a state a code would cost some of them for each code and batch. Gives ``code``,
    ``report_period``, ``period_end_date``, ``trigger_date``, ``trigger_priority``, ``status`` (``pending``, ``covered``,
    ``expired``), ``version``. Rows without a code, or announcements without a date, period or end, are ignored.
    """
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    usable = F.col("code").isNotNull() & F.col("period_end_date").isNotNull() & ((F.col("kind") == "fact") | (F.col("report_period").isNotNull() & F.col("trigger_date").isNotNull()))
    rows = events.where(usable).select(
        F.col("code").cast("string"), "kind", F.timestamp_micros(utc_micros("at")).alias("at"), F.coalesce("report_period", F.lit("")).alias("period"),
        F.coalesce(day("trigger_date"), F.lit(0)).alias("triggered"), F.coalesce(F.col("trigger_priority").cast("int"), F.lit(0)).alias("priority"), day("period_end_date").alias("ends"),
    )
    out = "code string, report_period string, ends int, triggered int, trigger_priority int, status string, version long"
    changed = rows.withColumn("part", F.pmod(F.xxhash64("code"), F.lit(groups))).withWatermark("at", delay).groupBy("part").transformWithState(_Disclosures(days), T.StructType.fromDDL(out), "Update", "EventTime")
    as_date = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), F.col(c))
    return changed.select("code", "report_period", as_date("ends").alias("period_end_date"), as_date("triggered").alias("trigger_date"), "trigger_priority", "status", "version")


def kept_best(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Improvements of the best row a key: rows of the stream that come before all earlier ones of their key by ``order``.

    ``order`` are numbers, least first, of which none is null (a source rank, then the negative of a time to let later
    rows correct earlier ones); a row that is no better than the one held leaves nothing. They stay as ``_order_0``, ...,
    by which :func:`current` finds the best of what was written. The state is that of a streaming aggregation: the best
    row with the time of its batch, by which the output tells an improvement from a row held already.
    """
    names = [f"_order_{i}" for i in range(len(order))]
    rows = rows.withColumns({n: c.cast("long") for n, c in zip(names, order, strict=True)})
    # the same throughout a batch, and when a batch runs again
    batch = F.current_timestamp()
    first = F.min_by(F.struct(*rows.columns, F.col("_batch")), F.struct(*names, "_batch"))
    best = rows.withColumn("_batch", batch).groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(first.alias("_best"))
    return best.where(F.col("_best._batch") == batch).select(*[F.col("_best")[c].alias(c) for c in rows.columns])


def changes_to(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes a stream of changes below ``path``, a folder a batch: the batch that runs again replaces its own."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return changes.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, schema: T.StructType, path: str, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row a key by ``order`` of all that :func:`changes_to` wrote."""
    rows = spark.read.schema(schema).parquet(path)
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").select(*schema.names)
