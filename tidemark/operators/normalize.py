"""Raw vendor extracts to declared tables: header aliases, lenient types, constants, and reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes
from ..functions.coerce import coerced, to_date, to_number
from ..plans.specs import spec
from .merge import CONFIRMED, SPOT_CLOSE


class SchemaDriftError(ValueError):
    """A vendor's table lacks columns that it should have."""


# Vendor headers, in the order in which they are tried.
_QUOTE = {
    "source_symbol": ("代码", "股票代码", "source_symbol"), "name": ("名称", "股票简称", "name"),
    "last_price": ("最新价", "最新价格", "last_price", "latest_price"), "price_change": ("涨跌额", "price_change", "change_amount"),
    "pct_change": ("涨跌幅", "pct_change", "pct_chg"), "open": ("今开", "开盘", "open"), "high": ("最高", "high"), "low": ("最低", "low"),
    "prev_close": ("昨收", "prev_close", "preclose"), "volume": ("成交量", "volume"), "amount": ("成交额", "amount"),
}
HEADERS: dict[str, dict[str, tuple[str, ...]]] = {
    "spot_a": _QUOTE | {
        "turnover_rate": ("换手率", "turnover_rate"), "amplitude": ("振幅", "amplitude"), "pe_dynamic": ("市盈率-动态", "动态市盈率", "pe_dynamic"),
        "pb": ("市净率", "pb"), "total_market_cap": ("总市值", "total_market_cap"), "float_market_cap": ("流通市值", "float_market_cap"),
    },
    "spot_b": _QUOTE | {"bid": ("买入", "竞买价", "bid"), "ask": ("卖出", "竞卖价", "ask"), "source_timestamp": ("时间戳", "时间", "source_timestamp")},
    "bar": {
        "date": ("日期", "date"), "source_symbol": ("股票代码", "代码", "source_symbol"), "open": ("开盘", "open"), "close": ("收盘", "close"),
        "high": ("最高", "high"), "low": ("最低", "low"), "volume": ("成交量", "volume"), "amount": ("成交额", "amount"), "amplitude": ("振幅", "amplitude"),
        "pct_change": ("涨跌幅", "pct_change", "pct_chg"), "price_change": ("涨跌额", "price_change", "change_amount"), "turnover_rate": ("换手率", "turnover_rate"),
    },
    "valuation": {
        "date": ("数据日期", "date"), "close": ("当日收盘价", "close"), "pct_change": ("当日涨跌幅", "pct_change", "pct_chg"), "total_market_cap": ("总市值", "total_market_cap"),
        "float_market_cap": ("流通市值", "float_market_cap"), "total_shares": ("总股本", "total_shares"), "float_shares": ("流通股本", "float_shares"),
        "pe_ttm": ("PE(TTM)", "pe_ttm"), "pe_static": ("PE(静)", "pe_static"), "pb": ("市净率", "pb"), "peg": ("PEG值", "peg"), "pcf": ("市现率", "pcf"), "ps": ("市销率", "ps"),
    },
    "capital": {
        "change_date": ("变更日期", "change_date", "END_DATE"), "total_shares": ("总股本", "total_shares", "TOTAL_SHARES"),
        "restricted_shares": ("流通受限股份", "restricted_shares", "LIMITED_A_SHARES"),
        "other_domestic_restricted_shares": ("其他内资持股(受限)", "other_domestic_restricted_shares", "LIMITED_OTHARS"),
        "domestic_legal_person_restricted_shares": ("境内法人持股(受限)", "domestic_legal_person_restricted_shares", "LIMITED_DOMESTIC_NOSTATE"),
        "domestic_natural_person_restricted_shares": ("境内自然人持股(受限)", "domestic_natural_person_restricted_shares", "LIMITED_DOMESTIC_NATURAL"),
        "circulated_shares": ("已流通股份", "circulated_shares", "FREE_SHARES"), "listed_a_shares": ("已上市流通A股", "listed_a_shares", "LISTED_A_SHARES"),
        "change_reason": ("变动原因", "change_reason", "CHANGE_REASON"),
    },
    "disclosure": {
        "code": ("股票代码", "code"), "name": ("股票简称", "name"), "first_scheduled_date": ("首次预约", "首次预约时间", "first_scheduled_date"),
        "first_changed_date": ("初次变更", "一次变更日期", "first_changed_date"), "second_changed_date": ("二次变更", "二次变更日期", "second_changed_date"),
        "third_changed_date": ("三次变更", "三次变更日期", "third_changed_date"), "actual_disclosure_date": ("实际披露", "实际披露时间", "actual_disclosure_date"),
    },
    "forecast": {
        "code": ("股票代码", "code"), "name": ("股票简称", "name"), "forecast_indicator": ("预测指标", "forecast_indicator"), "performance_change": ("业绩变动", "performance_change"),
        "forecast_value": ("预测数值", "预测数值(元)", "预测数值（元）", "forecast_value"), "performance_change_pct": ("业绩变动幅度", "业绩变动幅度(%)", "业绩变动幅度（%）", "performance_change_pct"),
        "performance_change_reason": ("业绩变动原因", "performance_change_reason"), "forecast_type": ("预告类型", "forecast_type"),
        "prior_period_value": ("上年同期值", "上年同期值(元)", "上年同期值（元）", "prior_period_value"), "announcement_date": ("公告日期", "announcement_date"),
    },
    "delist": {
        "source_symbol": ("公司代码", "证券代码", "代码", "source_symbol"), "name": ("公司简称", "证券简称", "名称", "name"), "list_date": ("上市日期", "list_date"),
        "delist_date": ("暂停上市日期", "终止上市日期", "退市日期", "delist_date"),
    },
}
#: Names that other extracts use for declared columns.
ALIASES = {
    "preclose": "prev_close", "adjustflag": "adjust_flag", "turn": "turnover_rate", "tradestatus": "trade_status", "pctChg": "pct_change", "pct_chg": "pct_change",
    "peTTM": "pe_ttm", "pbMRQ": "pb_mrq", "psTTM": "ps_ttm", "pcfNcfTTM": "pcf_ncf_ttm", "isST": "is_st", "code_name": "name", "ipoDate": "ipo_date", "outDate": "delist_date",
    "type": "security_type", "status": "listing_status", "dividOperateDate": "dividend_operate_date", "foreAdjustFactor": "forward_adjust_factor",
    "backAdjustFactor": "backward_adjust_factor", "adjustFactor": "adjustment_factor", "latest_price": "last_price", "change_amount": "price_change", "adjust": "adjustment",
}
#: Columns of a wide report that describe it, by what they become.
REPORT_COLUMNS = {"报告日": "report_date", "数据源": "data_source", "是否审计": "is_audit", "公告日期": "publish_date", "币种": "currency", "类型": "report_kind", "更新日期": "source_update_time"}


def conformed(df: DataFrame, schema: T.StructType, more: list[Column] | None = None) -> DataFrame:
    """The declared columns in order: aliases renamed where their target is missing, the rest null; others dropped, but for ``more``."""
    have = {f.name: f.dataType for f in df.schema}
    source = {f.name: f.name for f in schema if f.name in have}
    for alias, target in ALIASES.items():
        if alias in have and target in schema.names and target not in source:
            source[target] = alias
    lit = lambda f: F.lit(None).cast(f.dataType)
    return df.select(*[(coerced(F.col(f"`{source[f.name]}`"), f.dataType, have[source[f.name]]) if f.name in source else lit(f)).alias(f.name) for f in schema], *(more or []))


def required(df: DataFrame, headers: dict[str, tuple[str, ...]], endpoint: str) -> DataFrame:
    """The wanted columns under their names, each from the first header that is there (headers are trimmed)."""
    have = {c.strip(): c for c in df.columns}
    found = {target: next((have[h] for h in names if h in have), None) for target, names in headers.items()}
    missing = [t for t, c in found.items() if c is None]
    if missing:
        raise SchemaDriftError(f"{endpoint} lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df.select(*[F.col(f"`{c}`").alias(t) for t, c in found.items()])


def filled(df: DataFrame, endpoint: str) -> DataFrame:
    """``df``; a vendor's table without rows is an error, not a market without securities."""
    if not df.take(1):
        raise SchemaDriftError(f"{endpoint} has no rows")
    return df


def _shaped(df: DataFrame, table: str, **extra: Column) -> DataFrame:
    return conformed(df.withColumns(extra), spec(table).schema)


def spot_quotes_a(df: DataFrame, trade_date: str, fetched_at: str) -> DataFrame:
    """Quotes whose volume counts lots of 100."""
    rows = required(filled(df, "spot quotes a"), HEADERS["spot_a"], "spot quotes a")
    return _shaped(rows, "akshare_cn_stock_spot_quote_eastmoney", code=codes.source_code(F.col("source_symbol")), volume=to_number(F.col("volume")) * 100, trade_date=F.lit(trade_date), source_endpoint=F.lit("stock_zh_a_spot_em"), fetched_at=F.lit(fetched_at))


def spot_quotes_b(df: DataFrame, trade_date: str, reason: str, fetched_at: str) -> DataFrame:
    """Quotes of the fallback source: volume in shares, with bid and ask."""
    rows = required(filled(df, "spot quotes b"), HEADERS["spot_b"], "spot quotes b")
    return _shaped(rows, "akshare_cn_stock_spot_quote_sina", code=codes.source_code(F.col("source_symbol")), trade_date=F.lit(trade_date), source_endpoint=F.lit("stock_zh_a_spot"), is_fallback=F.lit("true"), fallback_reason=F.lit(reason), fetched_at=F.lit(fetched_at))


def daily_bars(df: DataFrame, code: str, adjustment: str, fetched_at: str) -> DataFrame:
    """A vendor's bars; a blank code is the one asked for, volumes become shares, rounded half to even."""
    rows = required(df, HEADERS["bar"], "daily bars")
    own = F.coalesce(F.nullif(F.trim("source_symbol"), F.lit("")), F.lit(code))
    return _shaped(rows, f"akshare_cn_stock_daily_bar_{adjustment}", source_symbol=own, code=codes.source_code(own), volume=F.bround(to_number(F.col("volume")) * 100).cast("string"), adjustment=F.lit(adjustment), source_endpoint=F.lit("stock_zh_a_hist"), quality_status=F.lit(CONFIRMED), fetched_at=F.lit(fetched_at))


def valuations(df: DataFrame, code: str) -> DataFrame:
    return _shaped(required(df, HEADERS["valuation"], "valuations"), "akshare_cn_stock_valuation_eastmoney", code=F.lit(code))


def capital_structure(df: DataFrame, code: str, fetched_at: str) -> DataFrame:
    rows = required(df, HEADERS["capital"], "capital structure")
    return _shaped(rows, "akshare_cn_stock_capital_structure_em", code=F.lit(code), source_symbol=codes.suffix_symbol(F.lit(code)), change_reason=F.coalesce("change_reason", F.lit("")), source_endpoint=F.lit("stock_zh_a_gbjg_em"), fetched_at=F.lit(fetched_at))


def disclosure_calendar(df: DataFrame, table: str, period: str, period_end: str, fetched_at: str, **constants: str) -> DataFrame:
    """Either vendor's calendar of report dates; ``constants`` gives ``market`` or ``symbol`` and the endpoint."""
    rows = required(df, HEADERS["disclosure"], table)
    return _shaped(rows, table, code=codes.source_code(F.col("code")), report_period=F.lit(period), period_end_date=F.lit(period_end), fetched_at=F.lit(fetched_at), **{k: F.lit(v) for k, v in constants.items()})


def earnings_forecasts(df: DataFrame, period: str, period_end: str, fetched_at: str) -> DataFrame:
    """Forecasts, each distinct row once."""
    rows = required(df, HEADERS["forecast"], "earnings forecasts")
    return _shaped(rows, "akshare_cn_stock_yjyg_em", code=codes.source_code(F.col("code")), report_period=F.lit(period), period_end_date=F.lit(period_end), source_endpoint=F.lit("stock_yjyg_em"), fetched_at=F.lit(fetched_at)).dropDuplicates()


def delisted(df: DataFrame, exchange: str, market: str, snapshot: str, fetched_at: str) -> DataFrame:
    rows = required(df, HEADERS["delist"], "delisted")
    return _shaped(rows, f"akshare_cn_stock_delist_{exchange}", code=codes.source_code(F.col("source_symbol")), exchange=F.lit(exchange), market=F.lit(market), snapshot_date=F.lit(snapshot), source_endpoint=F.lit(f"stock_info_{exchange}_delist"), fetched_at=F.lit(fetched_at))


def quotes_as_bars(quotes: DataFrame) -> DataFrame:
    """Quotes of either source as unadjusted bars of their day; what a source lacks is null."""
    lacking = {c: F.lit(None).cast("double") for c in ("amplitude", "turnover_rate") if c not in quotes.columns}
    rows = quotes.withColumns(lacking).withColumns({"date": F.col("trade_date"), "close": F.col("last_price"), "adjustment": F.lit("unadjusted"), "quality_status": F.lit(SPOT_CLOSE), "volume": F.bround("volume").cast("bigint")})
    return conformed(rows, spec("akshare_cn_stock_daily_bar_unadjusted").schema)


def with_fixed(df: DataFrame, fixed: dict[str, str]) -> DataFrame:
    """Blank values of fixed columns filled; any other value is an error."""
    for name, value in fixed.items():
        text = F.coalesce(F.nullif(F.trim(F.col(name)), F.lit("")), F.lit(value))
        df = df.withColumn(name, F.when(text == value, text).otherwise(F.raise_error(F.concat(F.lit(f"{name} must be {value}, not "), text))))
    return df


def report_items(df: DataFrame, code: str, kind: str, fetched_at: str, endpoint: str = "stock_financial_report_sina") -> DataFrame:
    """A wide statement as one row an item: the number where there is one, and the text ("" for none)."""
    own = {c.strip(): c for c in df.columns}
    held = [own[c] for c in REPORT_COLUMNS if c in own]
    items = [c for c in df.columns if c not in held]
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    long = text.unpivot([F.col(f"`{c}`") for c in held], [F.col(f"`{c}`") for c in items], "item_name", "item_value_text")
    long = long.withColumnsRenamed({own[c]: t for c, t in REPORT_COLUMNS.items() if c in own})
    extra = {"item_value": to_number(F.col("item_value_text")), "item_value_text": F.coalesce("item_value_text", F.lit("")), "code": F.lit(code), "source_symbol": codes.prefix_symbol(F.lit(code)), "report_type": F.lit(kind), "period_end_date": to_date(F.col("report_date")), "source_endpoint": F.lit(endpoint), "fetched_at": F.lit(fetched_at)}
    return conformed(long.withColumns(extra), spec("akshare_cn_stock_financial_report_sina").schema)


def statements(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fields_as_columns(rows: DataFrame, keys: list[str], field: str, value: str, fields: list[str]) -> DataFrame:
    """A column a field; the list is given, so no pass is spent on finding it."""
    return rows.groupBy(*keys).pivot(field, fields).agg(F.first(value, ignorenulls=True))


def migrated(df: DataFrame, renamed: dict[str, str], values: dict[str, dict[str, str]] | None = None, constants: dict[str, str] | None = None) -> DataFrame:
    """A stored table under new column names, with old values of some columns mapped and constants added."""
    df = df.withColumnsRenamed(renamed)
    for column, pairs in (values or {}).items():
        df = df.replace(pairs, subset=[column])
    return df.withColumns({c: F.lit(v) for c, v in (constants or {}).items() if c not in df.columns})


def earliest_date(df: DataFrame) -> DataFrame:
    """One row ``earliest``: the first date that any column's text holds (ISO, compact, quarter or Chinese), 1900 to 2100."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = text.select(F.explode(F.array(*text.columns)).alias("v")).select(F.trim("v").alias("v"))
    v = F.col("v")
    quarter = F.regexp_extract(v, r"^(\d{4})[qQ]([1-4])$", 2)
    parsed = (
        F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(v, 1, 10), "yyyy-MM-dd"))
        .when(v.rlike(r"^\d{8}$"), F.try_to_date(v, "yyyyMMdd"))
        .when(quarter != "", F.try_to_date(F.concat(F.substring(v, 1, 4), F.lpad(((quarter.try_cast("int") - 1) * 3 + 1).cast("string"), 2, "0"), F.lit("01")), "yyyyMMdd"))
        .when(v.rlike(r"^\d{4}年\d{1,2}月\d{1,2}日"), F.try_to_date(F.regexp_replace(F.regexp_extract(v, r"^(\d{4}年\d{1,2}月\d{1,2})日", 1), "[年月]", "-"), "yyyy-M-d"))
    )
    return rows.select(parsed.alias("d")).where(F.year("d").between(1900, 2100)).agg(F.min("d").alias("earliest"))
