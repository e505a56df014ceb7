"""Queues and best rows in the state of a stream, over several batches and restarts, against batch operators."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import disclosure, merge
from tidemark.streaming import stateful

T0 = dt.datetime(2024, 1, 1)
QUEUE = "code string, kind string, at timestamp_ntz, seq long, dataset string, reason string, error string"
CALENDAR = "kind string, code string, at timestamp_ntz, report_period string, period_end_date date, trigger_date date, trigger_priority int"


def fed(spark, tmp_path, batches, ddl, changes):
    """Each batch is a run of its own from the same checkpoint; gives the schema and where changes are."""
    stateful.with_state_store(spark)
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for rows in batches:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = changes(spark.readStream.schema(ddl).parquet(source))
        stateful.changes_to(stream, out, f"file://{tmp_path}/checkpoint").awaitTermination()
    return stream.schema, out


def replayed(events):
    """The queue by plain steps."""
    rows, open_row = {}, {}
    for code, kind, at, _, dataset, reason, error in events:
        if kind == "enqueue":
            if code not in open_row:
                open_row[code] = (code, 1 + sum(k[0] == code for k in rows))
            rows[open_row[code]] = (dataset, reason, at, "pending", None, "")
        elif code in open_row:
            rows[open_row[code]] = (*rows[open_row[code]][:3], "success" if kind == "success" else "failed_retryable", at, "" if kind == "success" else error)
            if kind == "success":
                del open_row[code]
    return rows


def test_refresh_queue_survives_restarts(spark, tmp_path):
    rng = random.Random(3)
    events = [(f"c{rng.randrange(6)}", rng.choice(["enqueue", "success", "failure"]), T0 + dt.timedelta(seconds=n), n, f"d{n}", "changed", "boom") for n in range(90)]
    batches = [rng.sample(events[a:b], b - a) for a, b in ((0, 20), (20, 21), (21, 60), (60, 90))]
    batches[0].append((None, "enqueue", T0, 0, "d", "r", ""))
    schema, out = fed(spark, tmp_path, batches, QUEUE, stateful.refresh_queue)
    got = stateful.current(spark, schema, out, ["code", "nth"], [F.col("version").desc()])
    assert {(r[0], r[1]): tuple(r)[3:] for r in got.collect()} == replayed(events)


def test_disclosures_fall_due_and_expire_by_timers(spark, tmp_path):
    """After every batch the pending rows are those of the batch operator on the watermark's day."""
    rng = random.Random(5)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    announced, facts, batches = [], [], []
    for b in range(4):
        rows = []
        for n in range(25):
            code, at = f"c{rng.randrange(12)}", T0 + dt.timedelta(days=b * 20 + rng.randrange(20), hours=n % 24)
            year = rng.choice([2021, 2022, 2023])
            if rng.random() < 0.2:
                rows.append(("fact", code, at, None, dt.date(year, 12, 31), None, None))
            else:
                rows.append(("announced", code, at, f"{year}年报", dt.date(year, 12, 31), day(b * 20 + rng.randrange(-15, 35)), rng.randrange(1, 4)))
        batches.append([*rows, ("announced", None, T0, "2023年报", dt.date(2023, 12, 31), day(1), 1)])
    stateful.with_state_store(spark)
    for b, rows in enumerate(batches):
        schema, out = fed(spark, tmp_path, [rows], CALENDAR, stateful.disclosures)
        announced += [r[1:] for r in rows if r[0] == "announced" and r[1]]
        facts += [(r[1], r[4]) for r in rows if r[0] == "fact"]
        effective = max(r[2] for batch in batches[: b + 1] for r in batch).date()
        calendar = spark.createDataFrame([(c, p, e, t, k) for c, _, p, e, t, k in announced], "code string, report_period string, period_end_date date, trigger_date date, trigger_priority int")
        waiting = disclosure.still_waiting(calendar, str(effective))
        want = disclosure.uncovered(disclosure.reduced(waiting), spark.createDataFrame(facts, "code string, period_end_date date"))
        got = stateful.current(spark, schema, out, ["code", "report_period"], [F.col("version").desc()])
        columns = ["code", "report_period", "period_end_date", "trigger_date", "trigger_priority"]
        assert sorted(map(tuple, got.where("status = 'pending'").select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert {r["status"] for r in got.collect()} == {"pending", "covered", "expired"}


def test_best_rows_leave_once(spark, tmp_path):
    rng = random.Random(7)
    ddl = "code string, source_dataset string, quality_status string, price double, seq long"
    rows = [(f"c{rng.randrange(8)}", rng.choice(["baostock_x", "akshare_x"]), rng.choice([merge.CONFIRMED, merge.SPOT_CLOSE, "other"]), float(n), n) for n in range(120)]
    order = [merge.source_rank("baostock"), -F.col("seq")]
    schema, out = fed(spark, tmp_path, [rows[:50], rows[50:51], rows[51:]], ddl, lambda s: stateful.kept_best(s, ["code"], order))
    written = spark.read.parquet(out)
    got = stateful.current(spark, schema, out, ["code"], [F.col("_order_0"), F.col("_order_1")])
    want = merge.best_ranked(spark.createDataFrame(rows, ddl), ["code"], merge.source_rank("baostock"), [F.col("seq").desc()])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    # at most one improvement a key and batch, and none that is not better
    assert written.count() <= 8 * 3 and written.groupBy("code", "batch").count().where("count > 1").count() == 0


def test_best_rows_need_no_call_a_key(spark):
    """The best row is found by Spark's own aggregation, not by a Python processor that asks the store for each key."""
    df = spark.createDataFrame([("c", 1.0, 1), ("c", 2.0, 2)], "code string, price double, seq long")
    best = stateful.kept_best(df, ["code"], [-F.col("seq")])
    assert "TransformWithState" not in best._jdf.queryExecution().logical().toString()
    assert [tuple(r) for r in best.collect()] == [("c", 2.0, 2, -2)]


def test_disclosures_call_the_store_once_a_group():
    """However many codes and announcements come, a batch reads and writes a group's state once and sets one timer."""

    class Store:
        def __init__(self):
            self.calls, self.value, self.timers = 0, None, set()

        def getValueState(self, *_):
            return self

        def getMapState(self, *_):
            raise AssertionError("an access for each entry")

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls, self.value = self.calls + 1, value

        def registerTimer(self, at):
            self.calls += 1
            self.timers.add(at)

        def deleteTimer(self, at):
            self.calls += 1
            self.timers.discard(at)

    class Now:
        def __init__(self, day):
            self.day = day

        def getCurrentWatermarkInMs(self):
            return self.day * 86_400_000

    store, told = Store(), stateful._Disclosures(30)
    told.init(store)
    rows = [dict(code=f"c{n % 50}", kind="announced", period="2023", triggered=100 + n // 50, priority=1, ends=90) for n in range(1000)]
    assert list(told.handleInputRows((0,), iter(rows), Now(10))) == [] and store.calls == 3 and store.timers == {100 * 86_400_000}
    due = list(told.handleExpiredTimer((0,), Now(101), None))
    assert store.calls == 6 and sorted((r["code"], r["triggered"], r["status"], r["version"]) for r in due) == sorted((f"c{n}", 101, "pending", 1) for n in range(50))
    over = list(told.handleExpiredTimer((0,), Now(200), None))
    assert {(r["triggered"], r["status"], r["version"]) for r in over} == {(119, "expired", 2)} and len(over) == 50
