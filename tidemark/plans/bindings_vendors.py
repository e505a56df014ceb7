"""Bindings of vendor extracts: the given tables as strings under vendors' headers, and what becomes of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import normalize, quality
from ..operators.merge import CONFIRMED
from .bindings import bound, table
from .specs import spec

AT = "2024-01-02 16:00:00"


def _raw(rows: DataFrame, **columns) -> DataFrame:
    """All columns as text, as extracts come; names may have blanks around them."""
    return rows.select(*[(c if not isinstance(c, str) else F.lit(c)).cast("string").alias(n) for n, c in columns.items()])


def _quotes(spark: SparkSession, sf_dir: str, more: dict) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    own = {
        "代码": F.concat(F.lit("sz"), F.col("c_custkey").cast("string")), " 名称 ": F.col("c_name"), "最新价": F.col("c_acctbal"), "涨跌额": "--", "涨跌幅": F.when(F.col("c_custkey") % 2 == 0, "1.5").otherwise(""),
        "今开": F.col("c_acctbal") + 1, "最高": F.col("c_acctbal") + 2, "最低": F.col("c_acctbal") - 2, "昨收": "nan", "成交量": F.col("c_custkey"), "成交额": F.col("c_nationkey"),
    }
    return _raw(c, **own, **more)


@bound("""select lpad(c_custkey::varchar, 6, '0') as code, 'sz' || c_custkey::varchar as source_symbol, c_name as name, c_acctbal as last_price, null::double as price_change, case when c_custkey % 2 = 0 then 1.5 end::double as pct_change,
  c_acctbal + 1 as open, null::double as prev_close, c_custkey * 100.0::double as volume, date '2024-01-02' as trade_date, 'stock_zh_a_spot_em' as source_endpoint, timestamp '2024-01-02 16:00:00' as fetched_at from customer""")
def spot_quotes_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of the first vendor, whose volume counts lots."""
    raw = _quotes(spark, sf_dir, {"换手率": "0.5", "振幅": "1", "市盈率-动态": "None", "市净率": "2", "总市值": "3", "流通市值": "4"})
    rows = normalize.spot_quotes_a(raw, "2024-01-02", AT)
    return rows.select("code", "source_symbol", "name", "last_price", "price_change", "pct_change", "open", "prev_close", "volume", "trade_date", "source_endpoint", "fetched_at")


@bound("""select lpad(c_custkey::varchar, 6, '0') as code, c_acctbal as last_price, c_custkey::double as volume, c_nationkey::double as amount, true as is_fallback, 'first vendor is down' as fallback_reason, 1.25::double as bid, null::double as ask, '15:00:00' as source_timestamp from customer""")
def spot_quotes_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of the fallback, whose volume counts shares."""
    rows = normalize.spot_quotes_b(_quotes(spark, sf_dir, {"买入": "1.25", "卖出": "-", "时间戳": "15:00:00"}), "2024-01-02", "first vendor is down", AT)
    return rows.select("code", "last_price", "volume", "amount", "is_fallback", "fallback_reason", "bid", "ask", "source_timestamp")


@bound(f"""select o_orderdate::date as date, case when o_orderkey % 2 = 0 then '600000' else lpad(o_custkey::varchar, 6, '0') end as code, o_totalprice as close, round_even(round(o_totalprice / 7, 3) * 100, 0)::bigint as volume,
  'qfq' as adjustment, 'stock_zh_a_hist' as source_endpoint, '{CONFIRMED}' as quality_status from orders""")
def vendor_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vendor's bars: a blank code is the one asked for, volumes are lots and rounded half to even."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    raw = _raw(o, **{
        "日期": F.date_format("o_orderdate", "yyyy-MM-dd"), "股票代码": F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise(F.col("o_custkey").cast("string")), "开盘": price, "收盘": price, "最高": price, "最低": price,
        "成交量": F.round(price / 7, 3), "成交额": "1", "振幅": "1", "涨跌幅": "1", "涨跌额": "1", "换手率": "1",
    })
    return normalize.daily_bars(raw, "600000", "qfq", AT).select("date", "code", "close", "volume", "adjustment", "source_endpoint", "quality_status")


@bound("""select o_orderdate::date as date, '600000' as code, o_totalprice as close, o_orderkey::double as total_shares, null::double as pe_ttm, 1.5::double as pb, null::double as peg from orders""")
def vendor_valuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(table(spark, sf_dir, "orders"), **{
        "数据日期": F.date_format("o_orderdate", "yyyyMMdd"), "当日收盘价": F.col("o_totalprice"), "当日涨跌幅": "", "总市值": "1", "流通市值": "1", "总股本": F.col("o_orderkey"), "流通股本": "1",
        "PE(TTM)": "--", "PE(静)": "1", "市净率": "1.5", "PEG值": "nan", "市现率": "1", "市销率": "1",
    })
    return normalize.valuations(raw, "600000").select("date", "code", "close", "total_shares", "pe_ttm", "pb", "peg")


@bound("""select o_orderdate::date as change_date, '600000' as code, '600000.SH' as source_symbol, o_totalprice as total_shares, null::double as restricted_shares, o_orderkey::double as listed_a_shares,
  case when o_orderkey % 3 = 0 then o_orderpriority else '' end as change_reason, 'stock_zh_a_gbjg_em' as source_endpoint from orders""")
def capital_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share structures; a change without a reason has an empty one."""
    raw = _raw(table(spark, sf_dir, "orders"), **{
        "END_DATE": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "TOTAL_SHARES": F.col("o_totalprice"), "LIMITED_A_SHARES": "-", "LIMITED_OTHARS": "1", "LIMITED_DOMESTIC_NOSTATE": "1", "LIMITED_DOMESTIC_NATURAL": "1",
        "FREE_SHARES": "1", "LISTED_A_SHARES": F.col("o_orderkey"), "CHANGE_REASON": F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")),
    })
    return normalize.capital_structure(raw, "600000", AT).select("change_date", "code", "source_symbol", "total_shares", "restricted_shares", "listed_a_shares", "change_reason", "source_endpoint")


_CALENDAR_SQL = """select lpad(o_custkey::varchar, 6, '0') as code, o_orderpriority as name, '2024年报' as report_period, date '2024-12-31' as period_end_date, o_orderdate::date as first_scheduled_date,
  case when o_orderkey % 2 = 0 then o_orderdate::date + 3 end as first_changed_date, null::date as third_changed_date, o_orderdate::date + 9 as actual_disclosure_date, {0} from orders"""


def _reports(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> DataFrame:
    day = lambda n: F.date_format(F.date_add("o_orderdate", n), "yyyy-MM-dd")
    values = (day(0), F.when(F.col("o_orderkey") % 2 == 0, day(3)).otherwise(""), "", "", day(9))
    return _raw(table(spark, sf_dir, "orders"), **{"股票代码": F.col("o_custkey"), "股票简称": F.col("o_orderpriority"), **dict(zip(names, values, strict=True))})


@bound(_CALENDAR_SQL.format("'沪深京' as market"))
def report_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the exchanges: empty dates are none."""
    raw = _reports(spark, sf_dir, ("首次预约", "初次变更", "二次变更", "三次变更", "实际披露"))
    rows = normalize.disclosure_calendar(raw, "akshare_cn_stock_report_disclosure", "2024年报", "2024-12-31", AT, market="沪深京", source_endpoint="stock_report_disclosure")
    return rows.select("code", "name", "report_period", "period_end_date", "first_scheduled_date", "first_changed_date", "third_changed_date", "actual_disclosure_date", "market")


@bound(_CALENDAR_SQL.format("'沪深A股' as symbol"))
def report_calendar_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a vendor, under other headers."""
    raw = _reports(spark, sf_dir, ("首次预约时间", "一次变更日期", "二次变更日期", "三次变更日期", "实际披露时间"))
    rows = normalize.disclosure_calendar(raw, "akshare_cn_stock_yysj_em", "2024年报", "2024-12-31", AT, symbol="沪深A股", source_endpoint="stock_yysj_em")
    return rows.select("code", "name", "report_period", "period_end_date", "first_scheduled_date", "first_changed_date", "third_changed_date", "actual_disclosure_date", "symbol")


@bound("""select distinct lpad(o_custkey::varchar, 6, '0') as code, o_orderpriority as name, year(o_orderdate)::double as forecast_value, null::double as performance_change_pct, case when o_orderkey % 2 = 0 then '预增' else '预减' end as forecast_type, make_date(year(o_orderdate), 1, 31) as announcement_date from orders""")
def forecasts_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts, each distinct row once."""
    raw = _raw(table(spark, sf_dir, "orders"), **{
        "股票代码": F.col("o_custkey"), "股票简称": F.col("o_orderpriority"), "预测指标": "净利润", "业绩变动": "x", "预测数值(元)": F.year("o_orderdate"), "业绩变动幅度": "--", "业绩变动原因": "", "预告类型": F.when(F.col("o_orderkey") % 2 == 0, "预增").otherwise("预减"),
        "上年同期值": "1", "公告日期": F.concat(F.year("o_orderdate").cast("string"), F.lit("-01-31")),
    })
    return normalize.earnings_forecasts(raw, "2024年报", "2024-12-31", AT).select("code", "name", "forecast_value", "performance_change_pct", "forecast_type", "announcement_date")


@bound("""select lpad(s_suppkey::varchar, 6, '0') as code, s_name as name, 'sh' as exchange, '主板' as market, date '1999-01-01' as list_date, case when s_suppkey % 2 = 0 then date '2020-05-06' end as delist_date, date '2024-01-02' as snapshot_date from supplier
union all select lpad(s_suppkey::varchar, 6, '0'), s_name, 'sz', '终止上市', null, date '2021-05-06', date '2024-01-02' from supplier""")
def delist_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both exchanges' lists."""
    s = table(spark, sf_dir, "supplier")
    own = {"公司代码": F.col("s_suppkey"), "公司简称": F.col("s_name"), "上市日期": "1999-01-01", "暂停上市日期": F.when(F.col("s_suppkey") % 2 == 0, "2020/05/06")}
    sh = normalize.delisted(_raw(s, **own), "sh", "主板", "2024-01-02", AT)
    sz = normalize.delisted(_raw(s, **{"证券代码": F.col("s_suppkey"), "证券简称": F.col("s_name"), "上市日期": "", "终止上市日期": "20210506"}), "sz", "终止上市", "2024-01-02", AT)
    return sh.unionByName(sz).select("code", "name", "exchange", "market", "list_date", "delist_date", "snapshot_date")


@bound("""with m as (select c_custkey as k, case when c_custkey % 7 = 0 then 1 else 0 end as off_id, case when c_custkey % 11 = 0 then 1 else 0 end as off_code, case when c_custkey % 5 = 0 then 1 else 0 end as off_status, case when c_custkey % 13 = 0 then 1 else 0 end as blank from customer)
select 'cn_security_master' as dataset, unnest(['filled', 'canonical_id', 'cross_codes', 'active_status', 'unique']) as rule, unnest([sum(blank), sum(greatest(off_id, blank)), sum(off_code), sum(off_status), case when sum(blank) > 1 then 1 else 0 end])::bigint as violations from m
union all select 'cn_stock_valuation', unnest(['filled', 'canonical_id', 'percentiles', 'unique']), unnest([0, 0, count(*) filter (o_totalprice > 200000), 0])::bigint from orders
union all select 'akshare_cn_stock_delist_sh', unnest(['six_digits', 'delist_unique']), unnest([count(*) filter (s_suppkey % 4 = 0) + count(*) filter (s_suppkey % 12 = 0), count(*) filter (s_suppkey % 3 = 0)])::bigint from supplier
union all select 'akshare_cn_stock_financial_report_sina', unnest(['six_digits', 'item_named', 'unique']), unnest([0, count(*) filter (n_nationkey % 4 = 1), 0])::bigint from nation""")
def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of four tables on rows of which some are off.

    Six digits name a million keys, so a key's million is told beside its code: by the exchange for securities (three
    millions; keys beyond get longer codes, which aren't canonical), by the market for the list, by the day for
    valuations.
    """
    key = F.col("c_custkey")
    million = F.least(_million(key), F.lit(2))
    code = F.format_string("%06d", key - million * MILLION)
    exchange = F.when(million == 0, "SZ").when(million == 1, "SH").otherwise("BJ")
    master = table(spark, sf_dir, "customer").select(
        F.when(key % 13 == 0, F.lit(None)).when(key % 7 == 0, F.concat_ws(":", exchange, code)).otherwise(F.concat_ws(".", exchange, code)).alias("security_id"), code.alias("code"), exchange.alias("exchange"), F.col("c_name").alias("name"),
        F.concat_ws(".", F.when(key % 11 == 0, "off").otherwise(F.lower(exchange)), code).alias("baostock_code"), code.alias("akshare_code"), F.concat(F.lower(exchange), code).alias("qlib_symbol"),
        F.when(key % 5 == 0, "delisted").otherwise("active").alias("listing_status"), F.lit("true").alias("is_active"), F.lit(AT).alias("updated_at"),
    )
    parts = [("cn_security_master", master), ("cn_stock_valuation", _valued(spark, sf_dir))]
    supplier = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    lists = supplier.select(F.when(k % 4 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(F.format_string("%06d", k % MILLION)).alias("code"), F.lit("sh").alias("exchange"), F.concat(F.lit("m"), _million(k).cast("string")).alias("market"), F.lit("2024-01-02").alias("snapshot_date"), k.alias("k"))
    parts.append(("akshare_cn_stock_delist_sh", lists.unionByName(lists.where("k % 3 = 0"))))
    items = table(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("code"), F.lit("income").alias("report_type"), F.lit("2024-12-31").alias("report_date"), F.when(F.col("n_nationkey") % 4 == 1, " ").otherwise(F.col("n_name")).alias("item_name"))
    parts.append(("akshare_cn_stock_financial_report_sina", items))
    out = None
    for name, rows in parts:
        found = quality.report(normalize.conformed(rows, spec(name).schema), spec(name)).select("dataset", "rule", "violations")
        out = found if out is None else out.unionByName(found)
    return out


MILLION = 1_000_000


def _million(key: Column) -> Column:
    """Which million of keys a key is of, from 0."""
    return F.floor((key - key % MILLION) / MILLION)


def _valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A valuation an order, on its own day; orders beyond the first million, whose codes come again, a later day a million."""
    rank = F.when(F.col("o_totalprice") > 200000, 100.5).otherwise(50.0)
    million, code = _million(F.col("o_orderkey")), F.format_string("%06d", F.col("o_orderkey") % MILLION)
    day = F.when(million == 0, F.col("o_orderdate").cast("date")).otherwise(F.date_add(F.lit("2100-01-01").cast("date"), million.cast("int")))
    return table(spark, sf_dir, "orders").select(
        F.date_format(day, "yyyy-MM-dd").alias("date"), F.concat(F.lit("SH."), code).alias("security_id"), code.alias("code"),
        F.lit("SH").alias("exchange"), rank.alias("pe_ttm_percentile_1y"), F.lit("a").alias("source_dataset"), F.lit(AT).alias("updated_at"),
    )
