"""Bindings of what keeps state: streams over several runs, tables written in steps, files that carry an order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import asof, blocks, disclosure, merge, registry, selection
from ..sources import feature_source
from ..sources.tables import EVENT_SCHEMA, Lake, landed
from ..streaming import pipelines, stateful
from . import derived
from .bindings import _DISCLOSED, BARS, FACTORS, _calendar, _scratch, bars, bound, factors, order_days, table
from .specs import SPECS, TableSpec, columns, register


def _in_two_runs(spark: SparkSession, rows: DataFrame, first: Column, changes: Callable[[DataFrame], DataFrame], keys: list[str], order: list[Column]) -> DataFrame:
    """Rows that arrive in two parts, each met by a run of the stream that starts from the checkpoint of the one before."""
    stateful.with_state_store(spark)
    root = _scratch(spark)
    schema = None
    for part in (first, ~first):
        rows.where(part).write.mode("append").parquet(f"{root}/in")
        stream = changes(spark.readStream.schema(rows.schema).parquet(f"{root}/in"))
        schema = stream.schema
        stateful.changes_to(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return stateful.current(spark, schema, f"{root}/out", keys, order)


@bound("""with e as (select user_id::varchar as code, case event_type when 'signup' then 'E' when 'purchase' then 'S' else 'F' end as kind, ts, event_id from events where event_type in ('signup', 'purchase', 'error')),
m as (select *, last_value(case when kind <> 'F' then kind end ignore nulls) over (partition by code order by ts, event_id rows between unbounded preceding and 1 preceding) as before from e),
d as (select *, kind = 'S' and coalesce(before = 'E', false) as done from m),
k as (select *, 1 + coalesce(sum(done::int) over (partition by code order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as nth from d),
l as (select code, nth, max(ts) filter (kind = 'E') as triggered_at, max(event_id) filter (kind = 'E') as event_id, bool_or(done) as done from k group by 1, 2 having count(*) filter (kind = 'E') > 0)
select l.code, l.nth::bigint as nth, 'd' || l.event_id::varchar as trigger_dataset, triggered_at, case when l.done then 'success' when count(k.ts) > 0 then 'failed_retryable' else 'pending' end as status, max(k.ts) as last_attempt_at
from l left join k on k.code = l.code and k.nth = l.nth and (k.kind = 'F' or k.done) and (k.ts, k.event_id) > (l.triggered_at, l.event_id) group by l.code, l.nth, l.event_id, triggered_at, l.done""")
def stream_refresh_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes to fetch again, their open rows in state; the second half of the events meets a restarted stream."""
    e = table(spark, sf_dir, "events").where("event_type in ('signup', 'purchase', 'error')")
    kind = F.when(F.col("event_type") == "signup", stateful.ENQUEUE).when(F.col("event_type") == "purchase", stateful.SUCCESS).otherwise(stateful.FAILURE)
    rows = e.select(F.col("user_id").cast("string").alias("code"), kind.alias("kind"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), F.concat(F.lit("d"), F.col("event_id").cast("string")).alias("dataset"), F.lit("changed").alias("reason"), F.lit("boom").alias("error"))
    got = _in_two_runs(spark, rows, F.col("at") < F.lit("2024-01-15").cast("timestamp_ntz"), stateful.refresh_queue, ["code", "nth"], [F.col("version").desc()])
    return got.select("code", "nth", "trigger_dataset", "triggered_at", "status", "last_attempt_at")


@bound(f"""with {_DISCLOSED}, day as (select max(o_orderdate)::date as d from orders), waiting as (select due.* from due, day where trigger_date between d - 30 and d),
best as (select *, row_number() over (partition by code, report_period order by trigger_priority desc, trigger_date desc) as r from waiting)
select code::varchar as code, report_period, period_end_date, trigger_date, trigger_priority from best where r = 1 and not exists (
  select 1 from orders o where o.o_custkey = best.code and make_date(year(o.o_orderdate), 12, 31) = best.period_end_date and o.o_totalprice > 300000)""")
def stream_disclosures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What waits on the day of the last order: announcements fall due and expire by timers, facts cover them."""
    trigger, rank = disclosure.trigger()
    code = F.col("code").cast("string").alias("code")
    told = _calendar(spark, sf_dir).select(F.lit("announced").alias("kind"), code, F.date_sub("first_scheduled_date", 10).cast("timestamp_ntz").alias("at"), "report_period", "period_end_date", trigger.alias("trigger_date"), rank.alias("trigger_priority"))
    facts = order_days(spark, sf_dir).where("price > 300000")
    facts = facts.select(F.lit("fact").alias("kind"), code, F.col("date").cast("timestamp_ntz").alias("at"), F.make_date(F.year("date"), F.lit(12), F.lit(31)).alias("period_end_date"))
    rows = told.unionByName(facts, allowMissingColumns=True)
    got = _in_two_runs(spark, rows, F.col("at") < F.lit("1998-07-01").cast("timestamp_ntz"), stateful.disclosures, ["code", "report_period"], [F.col("version").desc()])
    return got.where("status = 'pending'").select("code", "report_period", "period_end_date", "trigger_date", "trigger_priority")


@bound("""with src as (select user_id, ts::date as date, event_id, event_type, case event_type when 'signup' then 0 when 'purchase' then 1 when 'view' then 2 else 3 end as rank from events)
select user_id, date, event_id, event_type from (select *, row_number() over (partition by user_id, date order by rank, event_id desc) as r from src) where r = 1""")
def stream_keep_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best source of each user and day so far in state; only improvements leave the stream."""
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("date").alias("date"), "event_id", "event_type", F.when(kind == "signup", "baostock_bars").otherwise("akshare_bars").alias("source_dataset"),
        F.when(kind == "purchase", merge.CONFIRMED).when(kind == "view", merge.SPOT_CLOSE).otherwise("other").alias("quality_status"),
    )
    order = [merge.source_rank("baostock"), -F.col("event_id")]
    got = _in_two_runs(spark, rows, F.col("event_id") % 2 == 0, lambda s: stateful.kept_best(s, ["user_id", "date"], order), ["user_id", "date"], [F.col("_order_0"), F.col("_order_1")])
    return got.select("user_id", "date", "event_id", "event_type")


@bound("select event_type as dataset, event_id as row_count, ts::date::varchar as min_date, user_id::varchar as max_date, true as own_id from events")
def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a log by two runs of a stream, its second batch applied twice: every event is there once, under an id of its own."""
    root = _scratch(spark)
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_type").alias("dataset"), F.col("event_id").alias("row_count"), F.col("ts").cast("date").cast("string").alias("min_date"), F.col("user_id").cast("string").alias("max_date"))
    half = F.col("row_count") % 2 == 0
    for part in (half, ~half):
        rows.where(part).write.mode("append").parquet(f"{root}/in")
        pipelines.logged(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), f"{root}/log", f"{root}/checkpoint").awaitTermination()
    pipelines.write_batch(rows.where(~half), 1, f"{root}/log")
    log = spark.read.schema(EVENT_SCHEMA).json(f"{root}/log").select(*EVENT_SCHEMA.names)
    ids = log.groupBy("event_id").agg(F.count("*").alias("n"))
    return log.join(ids, "event_id").select("dataset", "row_count", "min_date", "max_date", (F.col("n") == 1).alias("own_id"))


# --- keys that no task can hold ---------------------------------------------------------------------------------------


@bound("""with s as (select ts, event_id, value, 'all' as code from events where event_type = 'signup'), v as (select event_id, ts, 'all' as code from events where event_type <> 'signup'),
l as (select ts, max(value) as value from s group by ts)
select v.event_id, l.value as latest from v asof left join l on v.ts >= l.ts""")
def asof_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events under one key, each with the latest sign-up's value, in blocks of a day."""
    e = table(spark, sf_dir, "events").withColumn("code", F.lit("all"))
    marks = e.where("event_type = 'signup'").groupBy("code", F.col("ts").alias("at")).agg(F.max("value").alias("latest"))
    return blocks.asof_in_blocks(e.where("event_type <> 'signup'").select("code", "event_id", "ts"), marks, "code", "ts", "at", ["latest"], 1).select("event_id", "latest")


@bound("""select event_id, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (order by ts, event_id rows between unbounded preceding and current row) as session from events""")
def carried_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series of all events: the session that each belongs to, carried from block to block."""
    e = table(spark, sf_dir, "events").select(F.lit("all").alias("code"), "event_id", "ts", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("begins"))
    block = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date"))
    return blocks.carried_in_blocks(e, ["code"], block, [F.col("ts"), F.col("event_id")], "begins", "session").select("event_id", "session")


def _blocks_sql() -> str:
    ranks = []
    for n in (1, 3, 5, 10, None):
        frame = f"b.date >= a.date - interval {n} year" if n else "true"
        mature = f"a.first_date <= a.date - interval {n} year" if n else "true"
        p, valid = f"sum(b.n) filter ({frame} and b.v > 0)", f"sum(b.n) filter ({frame})"
        up, down = f"coalesce(sum(b.n) filter ({frame} and b.v > 0 and b.v <= a.v), 0)", f"coalesce(sum(b.n) filter ({frame} and b.v < 0 and b.v >= a.v), 0)"
        share = f"case when not ({mature}) then null when a.v > 0 then 100.0 * {up} / {p} when a.v < 0 then 100.0 * (coalesce({p}, 0) + {down}) / {valid} end"
        ranks.append(f"round(({share})::double, 6) as v_percentile_{f'{n}y' if n else 'all_history'}")
    return f"""with series as (select o_orderpriority as code, o_orderdate::date as date, o_totalprice - 250000 as v, count(*) as n from orders group by 1, 2, 3),
valid as (select *, min(date) over (partition by code) as first_date from series where v <> 0)
select a.code, a.date, round(a.v, 2) as v, {", ".join(ranks)} from valid a join valid b on a.code = b.code and b.date <= a.date group by a.code, a.date, a.v, a.first_date"""


@bound(_blocks_sql())
def percentile_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys hold all orders; their samples are ranked range by range."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("code"), F.col("o_orderdate").cast("date").alias("date"), (F.col("o_totalprice") - 250000).alias("v"))
    out = blocks.percentiles_in_blocks(rows, "v", range_samples=1000).where("v <> 0").distinct()
    return out.select("code", "date", F.round("v", 2).alias("v"), *[F.round(c, 6).alias(c) for c in out.columns if "_percentile_" in c])


@bound("""select event_type, round(median(value), 6) as median, round(quantile_cont(value, 0.95), 6) as p95, round(quantile_cont(value, 0.01), 6) as p01 from events group by 1""")
def exact_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order statistics of large groups by narrowing, four rounds of counts."""
    root = _scratch(spark)
    rounds = iter(range(1 << 20))

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}-{next(rounds)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    out = selection.exact_percentiles(table(spark, sf_dir, "events"), "event_type", "value", {"median": 0.5, "p95": 0.95, "p01": 0.01}, keep)
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("median", "p95", "p01")])


@bound(f"""with {BARS}, {FACTORS}, fresh as (select code, day, case when code like '%7' and day >= date '2024-01-10' then factor + 1 else factor end as factor from factors where code not like '%3')
select b.code, b.date, round(open * coalesce(factor, 1), 6) as open, round(close * coalesce(factor, 1), 6) as close, volume, 'backward' as adjust_flag
from bars b asof left join fresh f on b.code = f.code and b.date >= f.day""")
def delta_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjusted bars brought up to date after factors changed or went: only the days that differ are adjusted again."""
    bar, old, day = bars(spark, sf_dir), factors(spark, sf_dir), F.col("dividend_operate_date")
    more = F.when(F.col("code").endswith("7") & (day >= F.lit("2024-01-10").cast("date")), 1.0).otherwise(0.0)
    new = old.where(~F.col("code").endswith("3")).withColumn("backward_adjust_factor", F.col("backward_adjust_factor") + more)
    stored = asof.adjusted_bars(bar, old, "backward_adjust_factor", "backward")
    spans = blocks.changed_spans(old, new, "code", "dividend_operate_date", "backward_adjust_factor")
    fresh = blocks.readjusted(bar, new, spans, "backward_adjust_factor", "backward")
    out = merge.keep_last(stored, fresh, ["code", "date"])
    return out.select("code", "date", F.round("open", 6).alias("open"), F.round("close", 6).alias("close"), "volume", "adjust_flag")


# --- storage ----------------------------------------------------------------------------------------------------------


@bound("""select o_custkey as code, o_orderkey as row_id, o_totalprice as price from (select *, row_number() over (partition by o_custkey order by o_orderkey % 2 desc, o_orderkey desc) as r from orders) where r = 1""")
def keep_last_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extracts that land one after the other, with many rows a key: the last to arrive stands, by file and place in it."""
    root = _scratch(spark)
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("code"), F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("price"))
    for n in range(2):
        rows.where(F.col("row_id") % 2 == n).repartitionByRange(4, "row_id").sortWithinPartitions("row_id").write.parquet(f"{root}/in/batch={n}")
    name = "arrivals"
    if name not in SPECS:
        register(TableSpec(name, columns("long: code row_id; double: price"), ("code",), None, "upsert", rules=("unique",)))
    lake = Lake(spark, f"{root}/lake")
    lake.write(name, landed(spark, f"{root}/in"))
    return lake.read(name)


@bound("""select 'sz' || lpad(user_id::varchar, 6, '0') as symbol, 'close' as field, date_diff('day', date '2024-01-01', ts::date)::bigint as idx, round(max(value)::float::double, 4) as value
from events where event_type in ('view', 'click') and user_id % 10 in (1, 2) and event_type = 'view' group by user_id, ts::date""")
def feature_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary series in files, read through their data source: symbol and field choose the files."""
    root = _scratch(spark)
    e = table(spark, sf_dir, "events").where("event_type in ('view', 'click')")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")
    field = F.when(F.col("event_type") == "view", "close").otherwise("open")
    rows = e.groupBy(F.concat(F.lit("sz"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("symbol"), field.alias("field"), day.alias("idx")).agg(F.max("value").alias("value"))
    feature_source.write_series(rows, f"{root}/features")
    wanted = [r[0] for r in rows.where(F.substring("symbol", -1, 1).isin("1", "2")).select("symbol").distinct().collect()]
    got = feature_source.read_series(spark, f"{root}/features").where(F.col("symbol").isin(wanted) & (F.col("field") == "close"))
    return got.where("value is not null").withColumn("value", F.round("value", 4))


@bound("""select 'stored_orders' as dataset, 'priority' as partition_column, 'priority,o_orderkey' as unique_columns, count(distinct o_orderpriority)::bigint as partitions, max(o_orderpriority) as latest_partition, count(*)::bigint as row_count,
  count(distinct o_orderpriority)::bigint as files, min(o_orderdate)::date::varchar as min_date, max(o_orderdate)::date::varchar as max_date, true as has_bytes from orders""")
def stored_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in storage as discovery shows it: rows and dates from footers, files from their listing."""
    name = "stored_orders"
    if name not in SPECS:
        register(TableSpec(name, columns("string: priority; long: o_orderkey; date: date; double: price"), ("priority", "o_orderkey"), "priority", rules=("unique", "dates"), date_column="date"))
    lake = Lake(spark, f"{_scratch(spark)}/lake", keeps_ledger=False)
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("price"))
    lake.write(name, rows)
    told = registry.discovery(lake.inventory([name])).where(F.col("dataset") == name)
    return told.select("dataset", "partition_column", "unique_columns", "partitions", "latest_partition", "row_count", "files", "min_date", "max_date", ((F.col("file_size_bytes") > 0) & F.col("file_mtime").isNotNull()).alias("has_bytes"))


@bound(f"""with {BARS}, ids as (select *, 'SZ.' || code as security_id, code[-1]::int as last from bars where code[1] in ('0', '2', '3'))
select security_id, date, case when last = 1 then close + 1 else close end as close, case when last % 3 = 0 then 'baostock_cn_stock_daily_bar_unadjusted' else 'akshare_cn_stock_daily_bar_unadjusted' end as source_dataset from ids
union all select 'built', null, count(distinct case when last = 1 then code end), 'again' from ids""")
def derived_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical bars of two vendors, built, then built again for what the ledger says has changed."""
    lake = Lake(spark, f"{_scratch(spark)}/lake", groups=64)  # a folder a security would be as many files as securities
    rows = bars(spark, sf_dir).withColumns({"last": F.substring("code", -1, 1).cast("int"), "amount": F.lit(1.0), "quality_status": F.lit(merge.CONFIRMED)})
    rows = rows.where(F.substring("code", 1, 1).isin("0", "2", "3"))
    dotted = F.concat(F.lit("sz."), F.col("code"))
    basic = rows.select(dotted.alias("code"), F.col("code").alias("name"), F.lit("1").alias("security_type"), F.lit("1").alias("listing_status")).distinct()
    lake.write("baostock_cn_stock_basic", basic)
    lake.write("baostock_cn_stock_daily_bar_unadjusted", rows.where("last % 3 = 0").withColumn("code", dotted))
    own = "akshare_cn_stock_daily_bar_unadjusted"
    lake.write(own, rows.where("last % 2 = 0 or last % 3 <> 0"))
    bar = derived.TARGETS[1]
    derived.build(lake, (bar,))
    lake.write(own, rows.where("last = 1").withColumn("close", F.col("close") + 1), "upsert")
    again = derived.build(lake, (bar,))[bar]
    out = lake.read(bar).select("security_id", "date", "close", "source_dataset")
    return out.unionByName(spark.range(1).select(F.lit("built").alias("security_id"), F.lit(None).cast("date").alias("date"), F.lit(float(again)).alias("close"), F.lit("again").alias("source_dataset")))
