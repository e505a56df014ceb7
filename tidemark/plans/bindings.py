"""The operators bound to the driver's tables: one query each, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, coerce, dates
from ..operators import asof, disclosure, lineage, logs, master, merge, normalize, percentile, quality, query, registry
from ..sources import binary_features
from ..streaming import pipelines
from .specs import SPECS, TableSpec, columns

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def bound(sql: str | None = None):
    def add(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable]:
    from . import bindings_state, bindings_vendors  # noqa: F401  (they register their own)

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import bindings_state, bindings_vendors  # noqa: F401

    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- adapter views: the driver's tables in the shapes that the operators take -----------------------------------------

BARS = """bars as (
  select lpad(user_id::varchar, 6, '0') as code, ts::date as date,
    (array_agg(value order by ts, event_id))[1] as open, max(value) as high, min(value) as low,
    (array_agg(value order by ts desc, event_id desc))[1] as close, count(*)::bigint as volume
  from events group by 1, 2)"""
FACTORS = """factors as (
  select lpad(user_id::varchar, 6, '0') as code, ts::date as day, (array_agg(1 + value / 100 order by ts desc, event_id desc))[1] as factor
  from events where event_type = 'signup' group by 1, 2)"""
SERIES = """series as (
  select o_custkey as code, o_orderdate::date as date, max(o_totalprice) - 250000 as v from orders group by 1, 2)"""


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.lpad(F.col("user_id").cast("string"), 6, "0").alias("code"), F.col("ts").cast("date").alias("date"), "value", F.struct("ts", "event_id").alias("at"))
    return rows.groupBy("code", "date").agg(F.min_by("value", "at").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "at").alias("close"), F.count("*").alias("volume"))


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_type = 'signup'")
    rows = rows.select(F.lpad(F.col("user_id").cast("string"), 6, "0").alias("code"), F.col("ts").cast("date").alias("dividend_operate_date"), (1 + F.col("value") / 100).alias("factor"), F.struct("ts", "event_id").alias("at"))
    return rows.groupBy("code", "dividend_operate_date").agg(F.max_by("factor", "at").alias("backward_adjust_factor"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("code"), F.col("o_orderdate").cast("date").alias("date"), "o_totalprice")
    return rows.groupBy("code", "date").agg((F.max("o_totalprice") - 250000).alias("v"))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("code"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))


ORDER_DAYS = "days as (select o_orderkey, o_custkey as code, o_orderdate::date as date, o_totalprice as price, o_orderstatus as status from orders)"


# --- as-of and interval joins -----------------------------------------------------------------------------------------


@bound(f"""with {BARS}, {FACTORS}
select b.code, b.date, round(open * coalesce(factor, 1), 6) as open, round(high * coalesce(factor, 1), 6) as high, round(low * coalesce(factor, 1), 6) as low,
  round(close * coalesce(factor, 1), 6) as close, volume, 'backward' as adjust_flag
from bars b asof left join factors f on b.code = f.code and b.date >= f.day""")
def asof_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = asof.adjusted_bars(bars(spark, sf_dir), factors(spark, sf_dir), "backward_adjust_factor", "backward")
    return out.withColumns({c: F.round(c, 6) for c in ("open", "high", "low", "close")})


@bound(f"""with {ORDER_DAYS}, spans as (
  select o_custkey as code, case when o_totalprice > 200000 then 'large' else 'small' end as universe, min(o_orderdate)::date as start_date, max(o_orderdate)::date - 30 as end_date
  from orders group by 1, 2)
select universe, count(*)::bigint as rows, count(distinct days.code)::bigint as codes from days join spans on days.code = spans.code and date between start_date and end_date group by 1""")
def membership_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_days(spark, sf_dir)
    spans = rows.groupBy("code", F.when(F.col("price") > 200000, "large").otherwise("small").alias("universe")).agg(F.min("date").alias("start_date"), F.date_sub(F.max("date"), 30).alias("end_date"))
    return asof.members_on(rows, spans).groupBy("universe").agg(F.count("*").alias("rows"), F.count_distinct("code").alias("codes"))


# --- percentiles ------------------------------------------------------------------------------------------------------


def _percentile_sql(where: str = "true") -> str:
    ranks = []
    for n in (1, 3, 5, 10, None):
        name = f"v_percentile_{n}y" if n else "v_percentile_all_history"
        frame = f"b.date >= a.date - interval {n} year" if n else "true"
        mature = f"a.first_date <= a.date - interval {n} year" if n else "true"
        p, valid = f"count(*) filter ({frame} and b.v > 0)", f"count(*) filter ({frame})"
        up = f"count(*) filter ({frame} and b.v > 0 and b.v <= a.v)"
        down = f"count(*) filter ({frame} and b.v < 0 and b.v >= a.v)"
        ranks.append(f"round(case when not ({mature}) then null when a.v > 0 then 100.0 * {up} / {p} when a.v < 0 then 100.0 * ({p} + {down}) / {valid} end, 6) as {name}")
    return f"""with {SERIES}, valid as (select *, min(date) over (partition by code) as first_date from series where v <> 0 and v is not null)
select a.code, a.date, round(a.v, 2) as v, {", ".join(ranks)}
from valid a join valid b on a.code = b.code and b.date <= a.date where {where} group by a.code, a.date, a.v, a.first_date"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("code", "date", F.round("v", 2).alias("v"), *[F.round(c, 6).alias(c) for c in percentile.column_names("v")])


@bound(_percentile_sql())
def percentile_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(percentile.percentiles(series(spark, sf_dir), ["v"]))


@bound(_percentile_sql())
def percentile_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(percentile.percentiles_by_window(series(spark, sf_dir), "v"))


@bound(_percentile_sql("a.date > coalesce((select max(date) from series s where s.code = a.code and s.date < date '2000-01-01'), date '1900-01-01')"))
def percentile_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series(spark, sf_dir)
    return _rounded(percentile.appended_percentiles(rows, rows.where("date < date '2000-01-01'"), ["v"]))


# --- merges -----------------------------------------------------------------------------------------------------------


@bound("""with src as (
  select l_shipdate::date as date, l_partkey as security_id, 'unadjusted' as adjustment, case l_returnflag when 'A' then 'baostock_bars' else 'akshare_bars' end as source_dataset,
    case l_returnflag when 'R' then 'daily_bar_confirmed' else 'spot_quote_close' end as quality_status, l_extendedprice as close, l_orderkey, l_linenumber from lineitem
), ranked as (
  select *, row_number() over (partition by date, security_id, adjustment order by case when source_dataset = 'baostock_bars' then 0 when quality_status = 'daily_bar_confirmed' then 1 else 2 end, l_orderkey, l_linenumber) as r from src
) select date, security_id, adjustment, source_dataset, quality_status, close from ranked where r = 1""")
def source_rank_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_partkey").alias("security_id"), F.lit("unadjusted").alias("adjustment"),
        F.when(flag == "A", "baostock_bars").otherwise("akshare_bars").alias("source_dataset"),
        F.when(flag == "R", merge.CONFIRMED).otherwise(merge.SPOT_CLOSE).alias("quality_status"), F.col("l_extendedprice").alias("close"), "l_orderkey", "l_linenumber",
    )
    return merge.best_ranked(rows, ["date", "security_id", "adjustment"], merge.source_rank("baostock"), [F.col("l_orderkey"), F.col("l_linenumber")]).drop("l_orderkey", "l_linenumber")


@bound("""with m as (select o_custkey as security_id, o_orderdate::date as date, max(o_totalprice) as pe_ttm, count(*)::bigint as pb from orders where o_orderstatus = 'O' group by 1, 2),
r as (select o_custkey as security_id, o_orderdate::date as date, min(o_totalprice) as pe_rank from orders where o_orderstatus <> 'O' or o_totalprice > 250000 group by 1, 2)
select coalesce(m.security_id, r.security_id) as security_id, coalesce(m.date, r.date) as date, coalesce(pe_ttm, pe_rank) as pe_ttm, pb,
  case when m.date is not null and r.date is not null then 'metrics+percentiles' when m.date is not null then 'metrics' else 'percentiles' end as source_dataset
from m full join r on m.security_id = r.security_id and m.date = r.date""")
def valuation_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_days(spark, sf_dir).withColumnRenamed("code", "security_id")
    metrics = rows.where("status = 'O'").groupBy("security_id", "date").agg(F.max("price").alias("pe_ttm"), F.count("*").alias("pb"))
    ranks = rows.where("status <> 'O' or price > 250000").groupBy("security_id", "date").agg(F.min("price").alias("pe_rank"))
    return master.merged_valuations(metrics, ranks, {"pe_ttm": "pe_rank"})


_OLD_NEW = f"""{ORDER_DAYS}, old as (select code, date, max(price) as price from days where date < date '1999-01-01' group by 1, 2),
new as (select code, date, max(price) + 1 as price from days where date >= date '1998-06-01' group by 1, 2)"""


def _old_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = order_days(spark, sf_dir)
    old = rows.where("date < date '1999-01-01'").groupBy("code", "date").agg(F.max("price").alias("price"))
    return old, rows.where("date >= date '1998-06-01'").groupBy("code", "date").agg((F.max("price") + 1).alias("price"))


@bound(f"with {_OLD_NEW} select code, date, price from new union all select code, date, price from old where not exists (select 1 from new where new.code = old.code and new.date = old.date)")
def upsert_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.keep_last(*_old_new(spark, sf_dir), ["code", "date"])


@bound(f"""with {_OLD_NEW}, fresh as (select * from new where date between date '1998-07-01' and date '1998-09-30')
select * from fresh union all select * from old where not date between date '1998-07-01' and date '1998-09-30'""")
def range_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_new(spark, sf_dir)
    return merge.range_replaced(old, new.where("date between date '1998-07-01' and date '1998-09-30'"), ["code", "date"], "date", "1998-07-01", "1998-09-30")


@bound(f"with {_OLD_NEW} select * from old where date < date '1998-08-01' union all select * from new where date >= date '1998-08-01'")
def start_date_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.replaced_from(*_old_new(spark, sf_dir), "date", "1998-08-01")


_MUTATED = f"""{_OLD_NEW}, fresh as (select code, date, case when code % 7 = 0 then price + 1 else price end as price from old where code % 11 <> 0)"""


def _fresh(old: DataFrame) -> DataFrame:
    return old.where("code % 11 <> 0").withColumn("price", F.when(F.col("code") % 7 == 0, F.col("price") + 1).otherwise(F.col("price")))


@bound(f"""with {_MUTATED} select a.code, bool_or(b.code is null or a.price is distinct from b.price) as conflict
from old a left join fresh b on a.code = b.code and a.date = b.date where a.date between date '1998-01-01' and date '1998-12-31' group by 1""")
def overlap_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, _ = _old_new(spark, sf_dir)
    return merge.overlap_conflicts(old, _fresh(old), "code", "date", ["price"], "1998-01-01", "1998-12-31")


@bound(f"with {_MUTATED} select distinct code from ((select * from old except select * from fresh) union all (select * from fresh except select * from old))")
def set_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, _ = _old_new(spark, sf_dir)
    return merge.changed_sets(old, _fresh(old), "code")


@bound(f"""with {_MUTATED}, c as (select a.code, bool_or(b.code is null or a.price is distinct from b.price) as conflict
from old a left join fresh b on a.code = b.code and a.date = b.date where a.date between date '1998-01-01' and date '1998-12-31' group by 1)
select k.code, case when coalesce(conflict, true) then 'full' else 'merge' end as decision from (select distinct code from days) k left join c on k.code = c.code""")
def refetch_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, _ = _old_new(spark, sf_dir)
    conflicts = merge.overlap_conflicts(old, _fresh(old), "code", "date", ["price"], "1998-01-01", "1998-12-31")
    return merge.refetch_decisions(conflicts, order_days(spark, sf_dir), "code")


@bound(f"with {_OLD_NEW} select code::varchar as code, bool_and(exists (select 1 from old where old.code = new.code and old.date = new.date)) as covered from new group by 1")
def skip_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_new(spark, sf_dir)
    return merge.keys_covered(old, new, ["code", "date"], "code")


@bound("select user_id, event_id, ts, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.latest_per_key(table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value"), ["user_id"], ["ts", "event_id"])


@bound("select o_custkey from orders where o_orderdate < timestamp '2000-06-01' except select o_custkey from orders where o_orderdate >= timestamp '2000-06-01'")
def stale_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    cut = F.lit("2000-06-01").cast("timestamp_ntz")
    return merge.stale_values(rows.where(F.col("o_orderdate") < cut), rows.where(F.col("o_orderdate") >= cut), "o_custkey")


@bound("select event_type, min(event_id)::bigint as event_id from events group by 1")
def first_seen_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.first_seen(table(spark, sf_dir, "events"), "event_type", "event_id")


# --- entities and universes -------------------------------------------------------------------------------------------

_CODE = "lpad(((c_custkey * 7919) % 1000000)::varchar, 6, '0')"
_EXCHANGE = "case when c[1] = '6' then 'SH' when c[1] in ('0', '2', '3') then 'SZ' when c[1] in ('4', '8', '9') then 'BJ' end"
_MASTER_SQL = f"""with base as (select *, {_CODE} as c from customer),
spot as (select {_EXCHANGE} || '.' || c as id, c_name as name from base where c_custkey % 3 = 0),
gone as (select case s_nationkey % 2 when 0 then 'SH' else 'SZ' end || '.' || lpad(((s_suppkey * 7919) % 1000000)::varchar, 6, '0') as id, s_name as name from supplier),
basic as (select {_EXCHANGE} || '.' || c as id, c_name || '*' as name, case when c_custkey % 4 = 0 then '0' else '1' end as listing, case when c_custkey % 8 = 0 then date '2020-01-01' end as delist_date from base where c_custkey % 2 = 0),
member as (select lower({_EXCHANGE}) || c as symbol, {_EXCHANGE} || '.' || c as id from base where c_custkey % 5 = 0),
ids as (select id from spot union select id from gone union select id from basic union select id from member),
joined as (
  select ids.id, spot.id is not null as s, gone.id is not null as d, basic.id is not null as b, member.id is not null as m, spot.name as sn, gone.name as dn, basic.name as bn, listing, basic.delist_date, symbol
  from ids left join spot using (id) left join gone using (id) left join basic using (id) left join member using (id) where ids.id is not null),
told as (select *, case when d then 'delisted' when s then 'active' when delist_date is not null then 'delisted' when b then case listing when '1' then 'active' else 'delisted' end else 'unknown' end as listing_status from joined)
select id as security_id, id[4:] as code, id[1:2] as exchange, coalesce(case when listing_status = 'active' then sn end, dn, bn, sn) as name,
  case when id[1:2] = 'SH' and id[4:6] = '688' then 'star' when id[1:2] = 'SH' and id[4:5] = '60' then 'main' when id[1:2] = 'SZ' and id[4:5] = '00' then 'main' when id[1:2] = 'SZ' and id[4:5] = '30' then 'chinext' when id[1:2] = 'BJ' then 'bse' else 'unknown' end as board,
  case when id[1:2] <> 'BJ' then lower(id[1:2]) || '.' || id[4:] end as baostock_code, coalesce(symbol, case when id[1:2] <> 'BJ' then lower(id[1:2]) || id[4:] end) as qlib_symbol,
  listing_status, case when listing_status <> 'unknown' then listing_status = 'active' end as is_active,
  case when s::int + d::int + b::int + m::int > 1 then 'mixed' when s then 'akshare_spot' when d then 'akshare_delist' when b then 'baostock_basic' else 'qlib_only' end as source_priority
from told"""


@bound(_MASTER_SQL)
def entity_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    to_code = lambda c: F.lpad(((F.col(c) * 7919) % 1000000).cast("string"), 6, "0")
    base = table(spark, sf_dir, "customer").withColumn("code", to_code("c_custkey"))
    exchange = codes.exchange_of(F.col("code"))
    no_date = F.lit(None).cast("date")
    spot = base.where("c_custkey % 3 = 0").select("code", F.col("c_name").alias("name"), no_date.alias("trade_date"))
    gone = table(spark, sf_dir, "supplier").select(F.when(F.col("s_nationkey") % 2 == 0, "SSE").otherwise("SZSE").alias("exchange"), to_code("s_suppkey").alias("code"), F.col("s_name").alias("name"), no_date.alias("list_date"), no_date.alias("delist_date"), no_date.alias("snapshot_date"))
    basic = base.where("c_custkey % 2 = 0").select(
        F.concat(F.lower(exchange), F.lit("."), "code").alias("code"), F.concat("c_name", F.lit("*")).alias("name"), no_date.alias("ipo_date"),
        F.when(F.col("c_custkey") % 8 == 0, F.lit("2020-01-01").cast("date")).alias("delist_date"), F.lit("1").alias("security_type"), F.when(F.col("c_custkey") % 4 == 0, "0").otherwise("1").alias("listing_status"),
    )
    member = base.where("c_custkey % 5 = 0").select(F.concat(F.lower(exchange), "code").alias("qlib_symbol"), no_date.alias("end_date"))
    out = master.security_master(spot, gone, basic, member)
    return out.select("security_id", "code", "exchange", "name", "board", "baostock_code", "qlib_symbol", "listing_status", "is_active", "source_priority")


def _spot_delisted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), F.concat("c_name", F.when(F.col("c_custkey") % 13 == 0, "退").when(F.col("c_custkey") % 17 == 0, "定转1").otherwise("")).alias("name"), F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("last_price"))
    gone = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("code"))
    return customer, gone


_GONE = "(select o_custkey from orders where o_totalprice > 400000)"


@bound(f"select c_custkey as code from customer where c_custkey not in {_GONE}")
def universe_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.universe(*_spot_delisted(spark, sf_dir))


@bound(f"select c_custkey as code from customer union {_GONE}")
def universe_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.universe(*_spot_delisted(spark, sf_dir), full=True)


@bound(f"select c_custkey as code from customer where c_custkey % 10 <> 0 and c_acctbal is not null and c_custkey % 13 <> 0 and c_custkey % 17 <> 0 and c_custkey not in {_GONE}")
def universe_valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.valuation_universe(*_spot_delisted(spark, sf_dir))


@bound(f"""with {BARS}, m as (select lpad(user_id::varchar, 6, '0') as code from events group by 1 having count(*) > 1),
r as (select 'SH.' || code as security_id, code, date, close, case when code like '%1' then '' else 'a' end as endpoint, 'first' as source, 0 as rank from bars where volume = 1
  union all select 'SH.' || code, code, date, close + 1, 'b', 'second', 1 from bars where code not like '%5'),
b as (select * from r qualify row_number() over (partition by security_id, date order by rank) = 1)
select b.security_id, b.date, b.close, b.source as source_dataset, coalesce(nullif(endpoint, ''), 'unknown') as source_endpoint, b.code, 'SH' as exchange from b join m using (code)""")
def canonical_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of two sources under one id: the preferred source where it has the day, with the master's attributes."""
    rows = bars(spark, sf_dir).withColumns({"security_id": F.concat(F.lit("SH."), "code"), "adjustment": F.lit("unadjusted"), "quality_status": F.lit("ok")})
    first = rows.where("volume = 1").withColumns({"source_dataset": F.lit("first"), "source_endpoint": F.when(F.col("code").endswith("1"), "").otherwise("a")})
    second = rows.where(~F.col("code").endswith("5")).withColumns({"close": F.col("close") + 1, "source_dataset": F.lit("second"), "source_endpoint": F.lit("b")})
    known = table(spark, sf_dir, "events").groupBy(F.lpad(F.col("user_id").cast("string"), 6, "0").alias("code")).agg(F.count("*").alias("n")).where("n > 1")
    known = known.select(F.concat(F.lit("SH."), "code").alias("security_id"), "code", F.lit("SH").alias("exchange"), F.lit("x").alias("name"), F.lit(True).alias("is_active"))
    return master.canonical_bars([first, second], known, "first").select("security_id", "date", "close", "source_dataset", "source_endpoint", "code", "exchange")


# --- reshaping and typing ---------------------------------------------------------------------------------------------


@bound("""select report_date, item_name, case when item_value_text is null then '' else item_value_text end as item_value_text, try_cast(item_value_text as double) as item_value, last_day(try_strptime(report_date, '%Y%m%d')::date) as period_end_date, '600000' as code, 'sh600000' as source_symbol from (
  select strftime(last_day(l_shipdate::date), '%Y%m%d') as report_date, unnest(['quantity', 'extendedprice', 'lines', 'flag']) as item_name,
    unnest([sum(l_quantity)::bigint::varchar, round(sum(l_extendedprice))::bigint::varchar, case when count(*) % 3 <> 0 then count(*)::varchar end, max(l_returnflag)]) as item_value_text from lineitem group by 1)""")
def unpivot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly figures as a vendor's wide statement, a column an item, by ``report_items``."""
    whole = lambda c: F.round(c).cast("bigint").cast("string")
    month = F.date_format(F.last_day(F.col("l_shipdate").cast("date")), "yyyyMMdd")
    wide = table(spark, sf_dir, "lineitem").groupBy(month.alias("报告日")).agg(
        whole(F.sum("l_quantity")).alias("quantity"), whole(F.sum("l_extendedprice")).alias("extendedprice"), F.when(F.count("*") % 3 != 0, F.count("*").cast("string")).alias("lines"), F.max("l_returnflag").alias("flag")
    )
    rows = normalize.report_items(wide, "600000", "balance", "2024-01-01 00:00:00")
    return rows.select(F.date_format("period_end_date", "yyyyMMdd").alias("report_date"), "item_name", "item_value_text", "item_value", "period_end_date", "code", "source_symbol")


@bound("""select user_id, max(value) filter (event_type = 'view') as view, max(value) filter (event_type = 'click') as click, max(value) filter (event_type = 'purchase') as purchase
from events where event_type in ('view', 'click', 'purchase') group by 1""")
def pivot_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("value"))
    return normalize.fields_as_columns(rows.where(F.col("event_type").isin("view", "click", "purchase")), ["user_id"], "event_type", "value", ["view", "click", "purchase"])


@bound("""select event_id, case event_id % 5 when 0 then null when 1 then event_id::double when 2 then null when 3 then event_id / 4.0 else null end as number,
  case event_id % 4 when 0 then ts::date when 1 then ts::date when 2 then ts::date else null end as day, case event_id % 3 when 0 then true when 1 then false else null end as flag from events""")
def coerce_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    raw = e.select(
        "event_id",
        F.when(i % 5 == 0, "--").when(i % 5 == 1, i.cast("string")).when(i % 5 == 2, "NaN").when(i % 5 == 3, F.concat(F.lit(" "), (i / 4).cast("decimal(18,2)").cast("string"))).otherwise("n/a").alias("number"),
        F.when(i % 4 == 0, F.date_format("ts", "yyyy-MM-dd")).when(i % 4 == 1, F.date_format("ts", "yyyyMMdd")).when(i % 4 == 2, F.date_format("ts", "yyyy/MM/dd")).otherwise("soon").alias("day"),
        F.when(i % 3 == 0, " Yes").when(i % 3 == 1, "F").otherwise("maybe").alias("flag"),
    )
    return normalize.conformed(raw, columns("long: event_id; double: number; date: day; boolean: flag"))


@bound("""with c as (select user_id, lpad(user_id::varchar, 6, '0') as code, case user_id % 4 when 0 then 'sh.' when 1 then 'SZ' when 2 then 'bj_' else '' end as p from (select distinct user_id from events))
select user_id, code, case when code[1] = '6' then 'SH' when code[1] in ('0', '2', '3') then 'SZ' when code[1] in ('4', '8', '9') then 'BJ' end as exchange,
  code || case when code[1] in ('5', '6', '9') then '.SH' else '.SZ' end as suffix_symbol,
  case when code[1] in ('4', '8') or code[1:3] = '920' then 'bj' when code[1] in ('5', '6', '9') then 'sh' else 'sz' end || code as prefix_symbol from c""")
def code_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "events").select("user_id").distinct()
    i = F.col("user_id")
    raw = F.when(i % 4 == 0, F.concat(F.lit("sh."), F.lpad(i.cast("string"), 6, "0"))).when(i % 4 == 1, F.concat(F.lit("SZ"), i.cast("string"))).when(i % 4 == 2, F.concat(F.lit("bj_"), i.cast("string"))).otherwise(F.concat(i.cast("string"), F.lit(".0")))
    u = u.withColumn("code", codes.source_code(raw))
    return u.select("user_id", "code", codes.exchange_of(F.col("code")).alias("exchange"), codes.suffix_symbol(F.col("code")).alias("suffix_symbol"), codes.prefix_symbol(F.col("code")).alias("prefix_symbol"))


@bound("""select min(try_cast(m as date)) as earliest from (
  select unnest(regexp_extract_all(v, '^\\d{4}-\\d{2}-\\d{2}')) as m from (select o_orderdate::varchar as v from orders union all select o_orderpriority from orders))
where try_cast(m as date) between date '1900-01-01' and date '2100-12-31'""")
def earliest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.earliest_date(table(spark, sf_dir, "orders").select("o_orderdate", "o_orderpriority"))


@bound("""select l_shipdate::date as date, lpad(l_partkey::varchar, 6, '0') as code, l_extendedprice as close, round_even(l_quantity, 0)::bigint as volume, 'spot_quote_close' as quality_status, null::double as amplitude from lineitem""")
def spot_to_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("trade_date"), F.lpad(F.col("l_partkey").cast("string"), 6, "0").alias("code"), F.col("l_extendedprice").alias("last_price"), F.col("l_quantity").alias("volume"))
    return normalize.quotes_as_bars(quotes).select("date", "code", "close", "volume", "quality_status", "amplitude")


# --- calendars and periods --------------------------------------------------------------------------------------------


_CALENDAR = "(select unnest(generate_series(min(o_orderdate)::date - 400, max(o_orderdate)::date + 400, interval 1 day)) as d from orders)"


@bound(f"""with c as (select d::date as d, dayofweek(d) between 1 and 5 as t from {_CALENDAR}),
m as (select d, max(case when t then d end) over (order by d rows between unbounded preceding and current row) as b, min(case when t then d end) over (order by d rows between current row and unbounded following) as a from c)
select o_orderdate::date as date, b as on_or_before, a as on_or_after, count(*)::bigint as orders from orders join m on o_orderdate::date = d group by 1, 2, 3""")
def trading_day_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = dates.trading_day_map(dates.calendar_around(order_days(spark, sf_dir), "date"))
    rows = order_days(spark, sf_dir).groupBy("date").agg(F.count("*").alias("orders"))
    return rows.join(known, F.col("date") == F.col("calendar_date")).select("date", "on_or_before", "on_or_after", "orders")


@bound(f"""with last as (select max(o_orderdate)::date as e from orders), c as (select d::date as d from {_CALENDAR} where dayofweek(d) between 1 and 5)
select min(d) as start from (select d from c, last where d <= e order by d desc limit 20)""")
def lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = dates.calendar_around(order_days(spark, sf_dir), "date")
    last = order_days(spark, sf_dir).agg(F.max("date").alias("e"))
    return dates.lookback_start(calendar.join(F.broadcast(last), F.col("calendar_date") <= F.col("e")), None, 20)


@bound("""with d as (select distinct o_orderdate::date as date from orders), f as (select date, date_trunc('quarter', date + 1)::date - 1 as first from d)
select date, unnest([first, last_day((first + interval 3 month)::date), last_day((first + interval 6 month)::date), last_day((first + interval 9 month)::date), last_day((first + interval 12 month)::date)]) as period_end from f""")
def rolling_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = order_days(spark, sf_dir).select("date").distinct()
    return days.select("date", F.explode(dates.rolling_periods(F.col("date"))).alias("period_end"))


@bound(f"select max(d)::date as latest from {_CALENDAR} where dayofweek(d) between 1 and 5")
def latest_trading_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.latest_trading_day(dates.calendar_around(order_days(spark, sf_dir), "date"))


@bound("""with d as (select distinct o_orderdate::date as date from orders), q as (select date, last_day((date_trunc('quarter', date) + interval 2 month)::date) as quarter_end from d)
select date, quarter_end, year(quarter_end)::varchar || case month(quarter_end) when 3 then '一季' when 6 then '半年报' when 9 then '三季' else '年报' end as period, quarter_end as period_end,
  last_day((quarter_end + interval 3 month)::date) as next_end, last_day((quarter_end - interval 3 month)::date) as previous_end, date = quarter_end as is_end, (date - interval 3 year)::date as three_years_before from q""")
def period_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_days(spark, sf_dir).select("date").distinct().withColumn("quarter_end", dates.quarter_end(F.col("date")))
    rows = rows.withColumn("period", dates.report_period(F.col("quarter_end")))
    return rows.select("date", "quarter_end", "period", dates.period_end(F.col("period")).alias("period_end"), dates.next_quarter_end(F.col("date")).alias("next_end"), dates.previous_quarter_end(F.col("date")).alias("previous_end"), dates.is_quarter_end(F.col("date")).alias("is_end"), dates.years_before(F.col("date"), 3).alias("three_years_before"))


@bound("""with s as (select o_custkey as code, min(o_orderdate)::date as a, max(o_orderdate)::date as b from orders group by 1), q as (
  select code, a, b, last_day((d + interval 2 month)::date) as e from s, unnest(generate_series(date_trunc('quarter', a)::timestamp, date_trunc('quarter', b)::timestamp, interval 3 month)) x(d))
select code, count(*)::bigint as quarters, min(e) as first_end, max(e) as last_end from q where e between a and b group by 1""")
def quarter_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = order_days(spark, sf_dir).groupBy("code").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    ends = spans.select("code", F.explode(dates.quarter_sequence(F.col("a"), F.col("b"))).alias("e"))
    return ends.groupBy("code").agg(F.count("*").alias("quarters"), F.min("e").alias("first_end"), F.max("e").alias("last_end"))


@bound("""select event_id, case when strftime(ts, '%H:%M') >= '18:00' then ts::date + 1 else ts::date end as effective, case when strftime(ts, '%H:%M') < '18:00' then ts::date - 1 else ts::date end as candidate,
  strftime(ts, '%H:%M') >= '18:00' or strftime(ts, '%H:%M') < '08:00' or dayofweek(ts) not between 1 and 5 as final, dayofweek(ts) in (0, 5, 6) or strftime(ts, '%H:%M') < '18:00' as session_due from events""")
def market_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, ts = table(spark, sf_dir, "events"), F.col("ts")
    candidate = dates.candidate_market_date(ts)
    return e.select("event_id", dates.effective_date(ts).alias("effective"), candidate.alias("candidate"), dates.quotes_are_final(ts, F.dayofweek(ts.cast("date")).between(2, 6)).alias("final"), dates.market_session_due(ts.cast("date"), candidate, ts.cast("date")).alias("session_due"))


# --- disclosures ------------------------------------------------------------------------------------------------------

_DISCLOSED = """cal as (select o_custkey as code, year(o_orderdate)::varchar || '年报' as report_period, make_date(year(o_orderdate), 12, 31) as period_end_date, o_orderdate::date + 10 as first_scheduled_date,
    case when o_orderkey % 3 = 0 then o_orderdate::date + 12 end as first_changed_date, case when o_orderkey % 6 = 0 then o_orderdate::date + 14 end as second_changed_date, null::date as third_changed_date,
    case when o_orderkey % 5 = 0 then o_orderdate::date + 20 end as actual_disclosure_date from orders),
due as (select code, report_period, period_end_date, coalesce(actual_disclosure_date, third_changed_date, second_changed_date, first_changed_date, first_scheduled_date) as trigger_date,
    case when actual_disclosure_date is not null then 3 when coalesce(third_changed_date, second_changed_date, first_changed_date) is not null then 2 else 1 end as trigger_priority from cal),
cand as (select * from due where trigger_date between date '1998-01-01' and date '1998-12-31')"""


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_days(spark, sf_dir)
    key, day = F.col("o_orderkey"), F.col("date")
    return rows.select(
        "code", F.concat(F.year(day).cast("string"), F.lit("年报")).alias("report_period"), F.make_date(F.year(day), F.lit(12), F.lit(31)).alias("period_end_date"), F.date_add(day, 10).alias("first_scheduled_date"),
        F.when(key % 3 == 0, F.date_add(day, 12)).alias("first_changed_date"), F.when(key % 6 == 0, F.date_add(day, 14)).alias("second_changed_date"),
        F.lit(None).cast("date").alias("third_changed_date"), F.when(key % 5 == 0, F.date_add(day, 20)).alias("actual_disclosure_date"),
    )


@bound(f"""with {_DISCLOSED} select code, report_period, period_end_date, trigger_date, trigger_priority from (
  select *, row_number() over (partition by code, report_period order by trigger_priority desc, trigger_date desc, period_end_date desc) as r from cand) where r = 1""")
def disclosure_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.reduced(disclosure.candidates(_calendar(spark, sf_dir), "1998-12-31", "1998-01-01"))


@bound(f"""with {_DISCLOSED}, waiting as (select * from due where trigger_date between date '1998-12-31' - 30 and date '1998-12-31'),
both_ as (select * from (select * from due where trigger_date between date '1998-12-20' and date '1998-12-31') union all select * from waiting),
best as (select *, row_number() over (partition by code, report_period order by trigger_priority desc, trigger_date desc, period_end_date desc) as r from both_)
select code, report_period, period_end_date, trigger_date, trigger_priority from best where r = 1 and not exists (
  select 1 from orders o where o.o_custkey = best.code and make_date(year(o.o_orderdate), 12, 31) = best.period_end_date and o.o_totalprice > 300000)""")
def pending_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, rank = disclosure.trigger()
    calendar = _calendar(spark, sf_dir)
    pending = calendar.select("code", "report_period", "period_end_date", day.alias("trigger_date"), rank.alias("trigger_priority"))
    facts = order_days(spark, sf_dir).where("price > 300000").select("code", F.make_date(F.year("date"), F.lit(12), F.lit(31)).alias("period_end_date"))
    return disclosure.pending_after(calendar, pending, facts, "1998-12-31", "1998-12-20")


@bound("""with q as (select user_id as code, max(ts) as at, arg_max(event_type <> 'error', ts) as ok from events where event_type in ('error', 'purchase') group by 1)
select distinct e.user_id as code, case when q.code is null then 'pending' when ok then 'success' else 'failed_retryable' end as status from events e left join q on q.code = e.user_id""")
def queue_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    queue = e.select(F.col("user_id").alias("code")).distinct().select("code", F.lit("pending").alias("status"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    results = e.where(F.col("event_type").isin("error", "purchase")).select(F.col("user_id").alias("code"), (F.col("event_type") != "error").alias("ok"), F.col("ts").alias("at"))
    return disclosure.queue_after(queue, results).select("code", "status")


@bound(f"""with {_MUTATED}, x as (select distinct code from ((select * from old except select * from fresh) union all (select * from fresh except select * from old))),
q as (select distinct o_custkey as code, ['pending', 'failed_retryable', 'success'][(o_custkey % 3 + 1)::int] as status from orders where o_custkey % 2 = 0)
select q.code, case when x.code is not null and status <> 'success' then 'pending' else status end as status, case when x.code is not null and status <> 'success' then 'factor_changed' else 'old' end as trigger_reason from q left join x using (code)
union all select code, 'pending', 'factor_changed' from x where code not in (select code from q where status <> 'success')""")
def change_enqueues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes whose series changed wait in the refresh queue."""
    old, _ = _old_new(spark, sf_dir)
    status = F.element_at(F.array(F.lit("pending"), F.lit("failed_retryable"), F.lit("success")), (F.col("code") % 3 + 1).cast("int"))
    none = F.lit(None).cast("timestamp_ntz")
    queue = table(spark, sf_dir, "orders").where("o_custkey % 2 = 0").select(F.col("o_custkey").alias("code")).distinct()
    queue = queue.select("code", F.lit("d").alias("trigger_dataset"), F.lit("old").alias("trigger_reason"), none.alias("triggered_at"), status.alias("status"), none.alias("last_attempt_at"), F.lit("").alias("error_stack"))
    return disclosure.enqueued(queue, merge.changed_sets(old, _fresh(old), "code"), "factors", "factor_changed", "2024-01-01 00:00:00").select("code", "status", "trigger_reason")


@bound("""with h as (select user_id as code, ts::date as date, arg_max(event_type, (ts, event_id)) as endpoint from events group by 1, 2), l as (select code, arg_max(endpoint, date) as endpoint, max(date) as date from h group by 1),
c as (select max(ts::date) as day from events where extract(dow from ts) in (1, 3)) select l.code from l, c where endpoint = 'view' and l.date >= c.day""")
def skippable_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("date", F.col("ts").cast("date"))
    held = e.groupBy(F.col("user_id").alias("code"), "date").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("source_endpoint"))
    calendar = e.select(F.col("date").alias("calendar_date"), F.when(F.dayofweek("date").isin(2, 4), "1").otherwise("0").alias("is_trading_day")).distinct()
    return merge.skippable_tasks(held.select("code").distinct(), held, calendar, "view")


# --- quality, lineage, registry ---------------------------------------------------------------------------------------

_BAR_SPEC = TableSpec("bars", columns("string: code; date: date; double: open high low close; long: volume"), ("code", "date"), "code", rules=("dates", "ohlc", "volume_not_negative", "six_digits", "unique"), date_column="date")


@bound(f"""with {BARS}, odd as (select case when code like '%7' then code[2:] else code end as code, date, open, case when code like '%3' then low - 1 else high end as high, low, close, case when volume > 2 then -1 else volume end as volume from bars),
keyed as (select *, coalesce(code, '') || '|' || coalesce(date::varchar, '') as key, date is null as bad_dates,
    coalesce((high + abs(high) * 1e-4 < greatest(open, close, low)) or (low - abs(high) * 1e-4 > least(open, close, high)), false) as bad_ohlc, volume is null or volume < 0 as bad_volume, not regexp_matches(code, '^[0-9]{{6}}$') as bad_code from odd),
m as (select unnest(['dates', 'ohlc', 'volume_not_negative', 'six_digits']) as rule, unnest(['hard', 'soft', 'soft', 'hard']) as severity, unnest([bad_dates, bad_ohlc, bad_volume, bad_code]) as bad, key from keyed),
r as (select rule, severity, count(*) filter (bad)::bigint as violations, coalesce(array_to_string(list_sort(list(distinct key) filter (bad))[1:5], ','), '') as sample from m group by 1, 2),
u as (select key from keyed group by 1 having count(*) > 1)
select 'bars' as dataset, rule, severity, violations, sample from r union all select 'bars', 'unique', 'hard', count(*)::bigint, coalesce(array_to_string(list_sort(list(key))[1:5], ','), '') from u""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bars(spark, sf_dir)
    rows = rows.withColumns({"high": F.when(F.col("code").endswith("3"), F.col("low") - 1).otherwise(F.col("high")), "volume": F.when(F.col("volume") > 2, F.lit(-1)).otherwise(F.col("volume")), "code": F.when(F.col("code").endswith("7"), F.substring("code", 2, 5)).otherwise(F.col("code"))})
    return quality.report(rows, _BAR_SPEC)


_ROW = "length(code::varchar)::varchar || ':' || code::varchar || '|' || length(date::varchar)::varchar || ':' || date::varchar || '|' || length(status)::varchar || ':' || status"
_LANES = ", ".join(f"':' || sum(('0x' || sha256({_ROW})[{1 + 15 * i}:{15 + 15 * i}])::bigint::hugeint)::varchar" for i in range(3)).replace(", ", " || ")


@bound(f"""with {ORDER_DAYS} select 'orders' as dataset, 'code' as partition_column, code::varchar as partition_value, count(*)::bigint as row_count, min(date)::varchar as min_date, max(date)::varchar as max_date,
  sha256(count(*)::varchar || {_LANES}) as content_hash from days group by code""")
def partition_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_days(spark, sf_dir).select("code", "date", "status")
    shape = TableSpec("orders", rows.schema, ("code", "date"), "code", date_column="date")
    return lineage.ledger(rows, shape).select("dataset", "partition_column", "partition_value", "row_count", "min_date", "max_date", "content_hash")


@bound(f"""with {_MUTATED}, a as (select code, string_agg(date::varchar || round(price, 2)::varchar, ',' order by date) as s from old where code % 13 <> 0 group by 1),
b as (select code, string_agg(date::varchar || round(price, 2)::varchar, ',' order by date) as s from fresh group by 1)
select coalesce(a.code, b.code) as code, case when b.code is null then 'build' when a.code is null then 'delete' else 'rebuild' end as action from a full join b on a.code = b.code where a.s is distinct from b.s""")
def changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, _ = _old_new(spark, sf_dir)
    fresh = _fresh(old)

    def signed(rows: DataFrame) -> DataFrame:
        parts = rows.groupBy("code").agg(lineage.content_hash(["date", "price"]).alias("content_hash"))
        parts = parts.select("code", F.lit("orders").alias("dataset"), F.col("code").cast("string").alias("partition_value"), "content_hash")
        return lineage.signatures(parts, rows.select("code").distinct(), "code", ["code"])

    return lineage.changed_keys(signed(old.where("code % 13 <> 0")), signed(fresh), "code").select("code", "action")


@bound(f"with {_MUTATED}, x as (select code from ((select * from old except select * from fresh) union all (select * from fresh except select * from old))) select distinct code from old where code not in (select code from x)")
def unchanged_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, _ = _old_new(spark, sf_dir)
    return lineage.unchanged_keys(old, _fresh(old), "code")


@bound("""with c as (select user_id as code, event_type as dataset, arg_max(value > 50, (ts, event_id)) as ok from events group by 1, 2)
select distinct user_id as code, event_type as dataset from events where (user_id, event_type) not in (select (code, dataset) from c where ok)""")
def checkpoint_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("code"), F.col("event_type").alias("dataset"), F.when(F.col("value") > 50, "success").otherwise("failed").alias("status"), F.struct("ts", "event_id").alias("updated_at"))
    return lineage.without_completed(e.select("code", "dataset").distinct(), e, ["code", "dataset"])


@bound("""with c as (select user_id as code, ts::date as end_date, arg_max(value > 50, (ts, event_id)) as ok from events group by 1, 2), o as (select distinct user_id as code, ts::date as end_date from events where event_type in ('view', 'click'))
select distinct user_id as code, ts::date as end_date from events where (user_id, ts::date) not in (select (code, end_date) from c where ok and (code, end_date) in (select (code, end_date) from o))""")
def checkpoint_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By end date, and only where the output is there."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("code"), F.col("ts").cast("date").alias("end_date"), "event_type", F.when(F.col("value") > 50, "success").otherwise("failed").alias("status"), F.struct("ts", "event_id").alias("updated_at"))
    outputs = e.where("event_type in ('view', 'click')").select("code", "end_date").distinct()
    return lineage.without_completed(e.select("code", "end_date").distinct(), e, ["code", "end_date"], outputs)


@bound(f"with {ORDER_DAYS}, last as (select code, max(date) as d from days where date < date '1999-01-01' group by 1) select days.* from days left join last on days.code = last.code where d is null or date > d")
def high_water_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_days(spark, sf_dir)
    return lineage.above_high_water(rows, rows.where("date < date '1999-01-01'"), "code", "date")


@bound("""select 'o' as dataset, count(*)::bigint as row_count, count(distinct o_orderpriority)::bigint as partitions, max(o_orderpriority) as latest_partition, min(o_orderdate)::date::varchar as min_date, max(o_orderdate)::date::varchar as max_date from orders
union all select 'l', count(*), count(distinct l_returnflag), max(l_returnflag), min(l_shipdate)::date::varchar, max(l_shipdate)::date::varchar from lineitem""")
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("p"), F.col("o_orderdate").cast("date").alias("date"))
    line = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("p"), F.col("l_shipdate").cast("date").alias("date"))
    shape = lambda n: TableSpec(n, columns("string: p; date: date"), ("p",), "p", date_column="date")
    return registry.inventory_row(o, shape("o")).unionByName(registry.inventory_row(line, shape("l")))


@bound("select o_orderpriority as partition_value, count(*)::bigint as row_count from orders group by 1")
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.partition_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


@bound("select o_custkey as code, min(o_orderdate)::date as min_date, max(o_orderdate)::date as max_date from orders group by 1")
def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.date_ranges(order_days(spark, sf_dir), "code", "date")


_STATUS = "case event_type when 'purchase' then 'success' when 'error' then (case when event_id % 2 = 0 then 'failed' else 'failed_api' end) when 'signup' then 'running' else ['skipped', 'skipped_checkpoint', 'skipped_existing'][(event_id % 3 + 1)::int] end"


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, n = F.col("event_type"), F.col("event_id")
    idle = F.element_at(F.array(F.lit("skipped"), F.lit("skipped_checkpoint"), F.lit("skipped_existing")), (n % 3 + 1).cast("int"))
    status = F.when(kind == "purchase", "success").when(kind == "error", F.when(n % 2 == 0, "failed").otherwise("failed_api")).when(kind == "signup", "running").otherwise(idle)
    return table(spark, sf_dir, "events").select(F.when(n % 11 != 0, F.col("user_id").cast("string")).otherwise("*").alias("code"), F.concat(F.lit("d"), (n % 3).cast("string")).alias("dataset"), status.alias("status"), "ts", "event_id")


@bound(f"""select 'd' || (event_id % 3)::varchar as dataset, max(ts::date) as last_success_date, arg_max({_STATUS}, (ts, event_id)) as status from events group by 1""")
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _outcomes(spark, sf_dir).select("dataset", F.col("ts").cast("date").alias("last_success_date"), "status", F.struct("ts", "event_id").alias("updated_at"))
    return registry.status_by_dataset(rows)


@bound(f"""with o as (select user_id::varchar as code, 'd' || (event_id % 3)::varchar as dataset, {_STATUS} as status from events where event_id % 11 <> 0),
k as (select code, dataset, case when status = 'success' then 's' when status = 'failed' or starts_with(status, 'failed_') then 'f' when starts_with(status, 'skipped') then 'k' end as kind from o),
d as (select distinct code, dataset, kind from k where kind is not null),
c as (select code, coalesce(string_agg(dataset, ',' order by dataset) filter (kind = 's'), '') as success, coalesce(string_agg(dataset, ',' order by dataset) filter (kind = 'f'), '') as failed, coalesce(string_agg(dataset, ',' order by dataset) filter (kind = 'k'), '') as skipped from d group by 1)
select *, success <> '' as succeeded, failed <> '' as any_failed, success = '' and failed = '' as only_skipped from c""")
def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.session_summary(_outcomes(spark, sf_dir))


@bound(f"select count(*) filter (s = 'success')::bigint as success, count(*) filter (s = 'failed')::bigint as failed, count(*) filter (s = 'failed' or starts_with(s, 'failed_'))::bigint as failed_any, count(*) filter (starts_with(s, 'skipped'))::bigint as skipped from (select {_STATUS} as s from events)")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.run_counters(_outcomes(spark, sf_dir))


@bound(f"select {_STATUS} as status, count(*)::bigint as rows from events group by 1")
def status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.status_totals(_outcomes(spark, sf_dir))


@bound("""select event_type, count(value)::bigint as count, round(sum(value), 3) as total, round(avg(value), 6) as mean, round(median(value), 6) as median, round(coalesce(stddev_samp(value), 0), 6) as stdev, min(value) as min, max(value) as max from events group by 1""")
def timing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = registry.timing_statistics(table(spark, sf_dir, "events"), "event_type", "value")
    return out.withColumns({"total": F.round("total", 3), **{c: F.round(c, 6) for c in ("mean", "median", "stdev")}})


@bound("select user_id, count(*)::bigint as calls, round(sum(value), 3) as total, round(avg(value), 6) as avg from events group by 1")
def call_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.call_profile(table(spark, sf_dir, "events"), "user_id", "value").withColumns({"total": F.round("total", 3), "avg": F.round("avg", 6)})


@bound("select user_id, count(*)::bigint as count, round(sum(value), 6) as total, round(avg(value), 6) as avg, round(quantile_cont(value, 0.95), 6) as p95, round(max(value), 6) as max from events group by 1")
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.latency_summary(table(spark, sf_dir, "events"), "user_id", "value", digits=6)


# --- logs -------------------------------------------------------------------------------------------------------------


def _log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, n = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    code = F.lpad(user, 6, "0")
    call = lambda what: F.concat(F.lit(f"API {what} run_id="), user, F.lit(" pid=1 action=fetch code="), code)
    kind = F.col("event_type")
    said = (
        F.when(kind == "purchase", call("started")).when(kind == "click", call("completed")).when(kind == "error", F.concat(F.lit("Daily bar API failed for "), code))
        .when(kind == "signup", F.concat(F.lit("Daily update completed run_id="), user, F.lit(" pid=1 records="), n, F.lit(" success="), user, F.lit(" failed=1 skipped=2")))
        .when(F.col("event_id") % 2 == 0, F.concat(F.lit("Pipeline metadata flush completed run_id="), user, F.lit(" rows=1 elapsed="), (F.col("event_id") % 50).cast("string"), F.lit(".5s")))
        .otherwise(F.concat(F.lit("refetching from 1990-01-01 run_id="), user))
    )
    return table(spark, sf_dir, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" INFO module - "), said).alias("value"))


_EVENT = "case event_type when 'purchase' then 'api_started' when 'click' then 'api_completed' when 'error' then 'failed' when 'signup' then 'run_completed' else (case when event_id % 2 = 0 then 'flushed' else 'refetched' end) end"


@bound(f"""select event_id, date_trunc('millisecond', ts) as ts, {_EVENT} as event,
  case when event_type <> 'error' then user_id::varchar end as run_id, case when event_type in ('purchase', 'click', 'error') then lpad(user_id::varchar, 6, '0') end as code,
  case when event_type = 'signup' then event_id end as records, case when event_type = 'view' and event_id % 2 = 0 then event_id % 50 + 0.5::double end as elapsed from events""")
def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parsed(_log_lines(spark, sf_dir)).select("event_id", "ts", "event", "run_id", "code", "records", "elapsed")


@bound("""select user_id::varchar as run_id, max(event_id) filter (event_type = 'signup') as records, max(user_id) filter (event_type = 'signup') as success, max(case when event_type = 'signup' then 1 end)::bigint as failed, max(case when event_type = 'signup' then 2 end)::bigint as skipped,
  0::bigint as stored, count(*) filter (event_type = 'view' and event_id % 2 = 0)::bigint as flushes, coalesce(sum(event_id % 50 + 0.5) filter (event_type = 'view' and event_id % 2 = 0), 0)::double as flush_seconds, count(*) filter (event_type = 'view' and event_id % 2 = 1)::bigint as refetches
from events where event_type <> 'error' group by 1""")
def log_run_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.run_figures(logs.parsed(_log_lines(spark, sf_dir).withColumn("file", F.col("event_id") % 8)), "event_id", "file")


@bound("""with recursive e as (select user_id, event_type = 'purchase' as is_start, ts, row_number() over (partition by user_id order by ts, event_id) as i from events where event_type in ('purchase', 'click')),
s as (
  select user_id, 0::bigint as i, null::boolean as is_start, null::timestamp as ts, 0 as queued, 0 as begun, 0 as ended, 0 as lost, false as duplicate from (select distinct user_id from e)
  union all
  select e.user_id, e.i, e.is_start, e.ts, case when e.is_start then queued + 1 when queued > 0 then queued - 1 else 0 end, begun + e.is_start::int, ended + (not e.is_start and queued > 0)::int, lost + (not e.is_start and queued = 0)::int, e.is_start and queued > 0
  from s join e on e.user_id = s.user_id and e.i = s.i + 1),
t as (select *, lag(lost) over (partition by user_id order by i) as lost_before from s),
a as (select user_id, begun as nth, ts, duplicate from t where is_start),
z as (select user_id, ended as nth, ts from t where not is_start and lost = lost_before)
select a.user_id, a.nth::bigint as nth, a.ts as started_at, z.ts as ended_at, case when z.ts is null then 'unmatched_start' else 'paired' end as state, a.duplicate from a left join z on a.user_id = z.user_id and a.nth = z.nth
union all select user_id, lost, null, ts, 'unmatched_end', false from t where not is_start and lost > lost_before""")
def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.event_pairs(table(spark, sf_dir, "events"), ["user_id"], "event_type", "purchase", "click", "ts", "event_id")


_RUNS = "runs as (select user_id, event_id as run, ts as started, case when event_type <> 'error' then ts + to_minutes(value::int * 20) end as ended from events where event_type in ('purchase', 'error'))"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "error"))
    minutes = F.make_dt_interval(mins=F.bround("value").cast("int") * 20)
    return e.select("user_id", F.col("event_id").alias("run"), F.col("ts").alias("started"), F.when(F.col("event_type") != "error", F.col("ts") + minutes).alias("ended"))


@bound(f"""with {_RUNS}, n as (select *, lead(run) over w as next_run, lead(started) over w as next_start from runs window w as (partition by user_id order by started, run))
select user_id, run, next_run from n where next_start is not null and (ended is null or ended > next_start)""")
def overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.overlapping_runs(_runs(spark, sf_dir), "user_id", "started", "ended", "run").select("user_id", "run", "next_run")


@bound("""select user_id, max(ts) as last_line, ((epoch_us(timestamp '2024-02-01') - epoch_us(max(ts))) // 1000000)::bigint as silent_seconds from events where user_id not in (select user_id from events where event_type = 'purchase' and value > 100)
group by 1 having (epoch_us(timestamp '2024-02-01') - epoch_us(max(ts))) // 1000000 >= 86400""")
def silent_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return logs.silent_runs(e, "user_id", "ts", e.where("event_type = 'purchase' and value > 100"), "2024-02-01", 86400)


@bound("""select event_id, user_id, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as session from events""")
def carried_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("session"), F.struct("ts", "event_id").alias("at"))
    return logs.carried(e, "session", "at", "user_id").drop("at")


# --- structured queries -----------------------------------------------------------------------------------------------


@bound("""select o_orderkey, o_custkey, o_totalprice from orders where o_totalprice >= 100000 and o_orderstatus in ('O', 'F') and o_orderpriority like '1%' order by o_totalprice desc, o_orderkey limit 500""")
def structured_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = [("o_totalprice", ">=", 100000), ("o_orderstatus", "in", ["O", "F"]), ("o_orderpriority", "like", "1%")]
    return query.structured_query(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"], filters, [("o_totalprice", "desc"), ("o_orderkey", "asc")], 500)


# --- streams and binary series ----------------------------------------------------------------------------------------


@bound("""with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hour then 0 else 1 end as n from events), s as (select user_id, ts, sum(n) over (partition by user_id order by ts rows between unbounded preceding and current row) as k from g)
select user_id, min(ts) as started_at, max(ts) + interval 6 hour as ended_at, count(*)::bigint as rows from s group by user_id, k""")
def activity_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return pipelines.activity_sessions(e, "user_id", "ts", "6 hours").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "ended_at")})


@bound("select event_id, event_type as dataset, user_id as row_count, ts::date::varchar as min_date, null::varchar as max_date from events where event_id > 100")
def stream_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a log of JSON lines, tailed by a stream and drained by one trigger into a table of the shared folder."""
    log = f"{_scratch(spark)}/log"
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("dataset"), F.col("user_id").alias("row_count"), F.col("ts").cast("date").cast("string").alias("min_date"))
    rows.write.json(log)
    return _drained(spark, pipelines.event_tail(spark, log, since=100))


@bound("select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each micro-batch upserts the latest row a user into a table."""
    from ..sources.tables import Lake
    from .specs import register

    name = "stream_latest"
    if name not in SPECS:
        register(TableSpec(name, columns("long: user_id event_id; timestamp: ts; string: event_type; double: value"), ("user_id",), None, "upsert", rules=("unique",)))
    path = f"{sf_dir}/events.parquet"
    rows = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", "1").parquet(f"{path}*").select("user_id", "event_id", "ts", "event_type", "value")
    root = _scratch(spark)
    lake = Lake(spark, f"{root}/lake")
    pipelines.upserts(rows, lake, name, f"{root}/checkpoint", order=["ts", "event_id"]).awaitTermination()
    return lake.read(name).select("user_id", "event_id", "event_type", "value")


def _scratch(spark: SparkSession) -> str:
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}" if base else f"file://{tempfile.mkdtemp(prefix='spark-')}"


def _drained(spark: SparkSession, rows: DataFrame) -> DataFrame:
    root = _scratch(spark)
    rows.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


@bound("""with v as (select user_id, date_diff('day', date '2024-01-01', ts::date) as idx, max(value) as value from events where event_type = 'view' group by 1, 2)
select 'sz' || lpad(user_id::varchar, 6, '0') as symbol, 'close' as field, idx::bigint as idx, round(value::float::double, 4) as value from v""")
def binary_features_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series packed as little-endian float32 (start index first), then read back."""
    import numpy as np
    import pyarrow as pa

    e = table(spark, sf_dir, "events").where("event_type = 'view'")
    days = e.groupBy("user_id", F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long").alias("idx")).agg(F.max("value").alias("value"))

    def pack(rows: pa.Table) -> pa.Table:
        idx, value = rows["idx"].to_numpy(), rows["value"].to_numpy()
        series = np.full(idx.max() - idx.min() + 2, np.nan, "<f4")
        series[0] = idx.min()
        series[1 + idx - idx.min()] = value
        name = f"features/sz{rows['user_id'][0].as_py():06d}/close.day.bin"
        return pa.table({"path": [name], "content": pa.array([series.tobytes()], pa.binary())})

    files = days.groupBy("user_id").applyInArrow(pack, "path string, content binary")
    return binary_features.decoded(files).where("value is not null").withColumn("value", F.round("value", 4))
