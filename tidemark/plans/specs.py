"""Declared tables: schema, keys, partitioning, write mode and rules; the one place that storage rules come from."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "date": T.DateType(), "string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampNTZType(),
}


def columns(text: str) -> T.StructType:
    """A schema from ``type: name name; type: name`` in column order."""
    fields = []
    for part in text.split(";"):
        kind, _, names = part.partition(":")
        fields += [T.StructField(n, _TYPES[kind.strip()]) for n in names.split()]
    return T.StructType(fields)


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    partition: str | None = None
    mode: str = "replace"
    family: str = ""
    code_format: str = "none"
    rules: tuple[str, ...] = ()
    fixed: dict[str, str] = field(default_factory=dict)
    date_column: str | None = None

    @property
    def view(self) -> str:
        return f"v_{self.name}"

    @property
    def sort_columns(self) -> tuple[str, ...]:
        return (*((self.partition,) if self.partition and self.partition not in self.keys else ()), *self.keys)


_WINDOWS = ("1y", "3y", "5y", "10y", "all_history")
_percentiles = lambda *names: " ".join(f"{n}_percentile_{w}" for n in names for w in _WINDOWS)
_CALENDAR_REPORT = "string: report_period; date: period_end_date; string: {0} code name; date: first_scheduled_date first_changed_date second_changed_date third_changed_date actual_disclosure_date; string: source_endpoint; timestamp: fetched_at"

# Table names, columns, keys and partition columns that stored data already has.
_SCHEMAS = {
    "vendor_daily_bar": "date: date; string: code; double: open high low close prev_close; long: volume; double: amount; string: adjust_flag; double: turnover_rate; string: trade_status; double: pct_change pe_ttm pb_mrq ps_ttm pcf_ncf_ttm; string: is_st",
    "percentile": "date: date; string: code; double: pe_ttm pb_mrq ps_ttm pcf_ncf_ttm " + _percentiles("pe_ttm", "pb_mrq", "ps_ttm", "pcf_ncf_ttm"),
    "basic": "string: code name; date: ipo_date delist_date; string: security_type listing_status",
    "trading_calendar": "date: calendar_date; string: is_trading_day",
    "factor": "string: code; date: dividend_operate_date; double: forward_adjust_factor backward_adjust_factor adjustment_factor",
    "valuation": "date: date; string: code; double: close pct_change total_market_cap float_market_cap total_shares float_shares pe_ttm pe_static pb peg pcf ps",
    "capital": "date: change_date; string: code source_symbol; double: total_shares restricted_shares other_domestic_restricted_shares domestic_legal_person_restricted_shares domestic_natural_person_restricted_shares circulated_shares listed_a_shares; string: change_reason source_endpoint; timestamp: fetched_at",
    "delist": "date: snapshot_date; string: exchange market code source_symbol name; date: list_date delist_date; string: source_endpoint; timestamp: fetched_at",
    "spot_a": "date: trade_date; string: code source_symbol name; double: last_price price_change pct_change open high low prev_close volume amount turnover_rate amplitude pe_dynamic pb total_market_cap float_market_cap; string: source_endpoint; timestamp: fetched_at",
    "spot_b": "date: trade_date; string: code source_symbol name; double: last_price price_change pct_change bid ask prev_close open high low volume amount; string: source_timestamp source_endpoint; boolean: is_fallback; string: fallback_reason; timestamp: fetched_at",
    "disclosure_market": _CALENDAR_REPORT.format("market"),
    "disclosure_symbol": _CALENDAR_REPORT.format("symbol"),
    "forecast": "string: report_period; date: period_end_date; string: code name forecast_indicator performance_change; double: forecast_value performance_change_pct; string: performance_change_reason forecast_type; double: prior_period_value; date: announcement_date; string: source_endpoint; timestamp: fetched_at",
    "financial": "string: code source_symbol report_type; date: report_date period_end_date; string: item_name; double: item_value; string: item_value_text data_source is_audit; date: publish_date; string: currency report_kind; timestamp: source_update_time; string: source_endpoint; timestamp: fetched_at",
    "bar": "date: date; string: code source_symbol; double: open high low close; long: volume; double: amount amplitude pct_change price_change turnover_rate; string: adjustment source_endpoint quality_status; timestamp: fetched_at",
    "holding": "string: report_period; date: period_end_date; string: code name; long: institution_count institution_count_change; double: holding_ratio holding_ratio_change float_holding_ratio float_holding_ratio_change",
    "day": "date: calendar_date",
    "membership": "string: universe qlib_symbol exchange code; date: start_date end_date",
    "features": "date: date; string: qlib_symbol exchange code; double: open high low close volume amount factor change vwap adjclose",
    "master": "string: security_id code exchange name security_type board baostock_code akshare_code qlib_symbol; date: ipo_date delist_date; string: listing_status; boolean: is_active; string: source_priority; date: latest_source_date; timestamp: updated_at",
    "canonical_bar": "date: date; string: security_id code exchange name adjustment; double: open high low close prev_close volume amount turnover_rate pct_change; string: trade_status is_st; boolean: is_active; string: source_dataset source_endpoint quality_status; timestamp: updated_at",
    "canonical_valuation": "date: date; string: security_id code exchange name; double: close total_market_cap float_market_cap total_shares float_shares pe_ttm pe_static pb ps pcf " + _percentiles("pe_ttm", "pb", "ps", "pcf") + "; string: source_dataset; timestamp: updated_at",
    "runs": "string: task_id dataset code status; date: start_date end_date; timestamp: start_time end_time; long: row_count; string: error_stack",
    "status": "string: dataset code; date: last_success_date; long: row_count; string: status; timestamp: updated_at; string: error_stack",
    "checkpoints": "string: pipeline dataset code; date: start_date end_date; string: status; long: row_count; string: output_path; timestamp: updated_at; string: error_stack",
    "ledger": "string: dataset partition_column partition_value output_path; long: row_count; string: min_date max_date content_hash semantic_hash schema_hash source_signature master_row_hash; long: file_size_bytes; timestamp: file_mtime; string: run_id; long: writer_pid; string: writer_thread; timestamp: updated_at",
}

_FORECAST_KEYS = "report_period code name announcement_date forecast_indicator forecast_type performance_change forecast_value performance_change_pct performance_change_reason prior_period_value"
_BAR_RULES = ("unique", "dates", "ohlc", "volume_not_negative", "amount_not_negative")

#: name: schema, keys, partition column, write mode, rules.
_TABLES: dict[str, tuple[str, str, str | None, str, tuple[str, ...]]] = {
    **{f"baostock_cn_stock_daily_bar_{a}": ("vendor_daily_bar", "code date", "code", "replace", _BAR_RULES) for a in ("unadjusted", "qfq", "hfq")},
    "baostock_cn_stock_basic": ("basic", "code", None, "replace", ("unique",)),
    "baostock_cn_trading_calendar": ("trading_calendar", "calendar_date", None, "merge", ("unique",)),
    "baostock_cn_stock_adjustment_factor": ("factor", "code dividend_operate_date", "code", "replace", ("unique",)),
    "baostock_cn_stock_valuation_percentile": ("percentile", "code date", "code", "replace", ("unique", "dates", "percentiles")),
    "akshare_cn_stock_valuation_eastmoney": ("valuation", "code date", "code", "replace", ("unique", "dates", "six_digits")),
    "akshare_cn_stock_capital_structure_em": ("capital", "code change_date change_reason", "code", "replace", ("unique", "six_digits")),
    "akshare_cn_stock_delist_sh": ("delist", "snapshot_date exchange code", "snapshot_date", "replace", ("six_digits", "delist_unique")),
    "akshare_cn_stock_delist_sz": ("delist", "snapshot_date exchange code", "snapshot_date", "replace", ("six_digits", "delist_unique")),
    "akshare_cn_stock_spot_quote_eastmoney": ("spot_a", "trade_date code", "trade_date", "replace", ("unique", "six_digits")),
    "akshare_cn_stock_spot_quote_sina": ("spot_b", "trade_date code", "trade_date", "replace", ("unique", "six_digits")),
    "akshare_cn_stock_report_disclosure": ("disclosure_market", "report_period code", "report_period", "replace", ("unique", "six_digits")),
    "akshare_cn_stock_yysj_em": ("disclosure_symbol", "report_period symbol code", "report_period", "replace", ("unique", "six_digits")),
    "akshare_cn_stock_yjyg_em": ("forecast", _FORECAST_KEYS, "report_period", "replace", ("unique", "six_digits")),
    "akshare_cn_stock_financial_report_sina": ("financial", "code report_type report_date item_name", "code", "replace", ("unique", "six_digits", "item_named")),
    **{f"akshare_cn_stock_daily_bar_{a}": ("bar", "code date adjustment", "code", "replace", (*_BAR_RULES, "six_digits", "adjustment")) for a in ("unadjusted", "qfq", "hfq")},
    "akshare_cn_stock_institution_holding": ("holding", "report_period code", "report_period", "replace", ("unique", "six_digits")),
    "qlib_cn_calendar_day": ("day", "calendar_date", None, "replace", ("unique",)),
    "qlib_cn_instrument_membership": ("membership", "universe qlib_symbol start_date end_date", None, "replace", ("unique",)),
    "qlib_cn_stock_features_day": ("features", "qlib_symbol date", "qlib_symbol", "replace", ("unique", "dates")),
    "cn_security_master": ("master", "security_id", None, "replace", ("unique", "filled", "canonical_id", "cross_codes", "active_status")),
    "cn_stock_daily_bar": ("canonical_bar", "date security_id adjustment", "security_id", "upsert", ("unique", "filled", "canonical_id", "adjustment", "ohlc", "volume_not_negative", "amount_not_negative")),
    "cn_stock_valuation": ("canonical_valuation", "date security_id", "security_id", "upsert", ("unique", "filled", "canonical_id", "percentiles")),
    "pipeline_runs": ("runs", "task_id", None, "append", ()),
    "dataset_update_status": ("status", "dataset code", None, "upsert", ()),
    "pipeline_checkpoints": ("checkpoints", "pipeline dataset code start_date end_date", None, "upsert", ()),
    "dataset_partition_manifest": ("ledger", "dataset partition_column partition_value", None, "upsert", ()),
}

#: Columns that tell a table's dates, in the order in which they are looked for.
DATE_COLUMNS = ("date", "trade_date", "calendar_date", "snapshot_date", "change_date", "period_end_date", "report_date", "dividend_operate_date")


def _spec(name: str) -> TableSpec:
    schema, keys, partition, mode, rules = _TABLES[name]
    family = name.split("_")[0] if name.startswith(("baostock_", "akshare_", "qlib_")) else "derived" if name.startswith("cn_") else "metadata"
    kind = {"baostock": "prefixed_dot", "akshare": "six_digits", "qlib": "prefixed", "derived": "canonical"}.get(family, "none")
    fixed = {"adjustment": name.rsplit("_", 1)[1]} if schema == "bar" else {}
    shape = columns(_SCHEMAS[schema])
    dates = next((c for c in DATE_COLUMNS if c in shape.names), None)
    return TableSpec(name, shape, tuple(keys.split()), partition, mode, family, kind, rules, fixed, dates)


SPECS: dict[str, TableSpec] = {name: _spec(name) for name in _TABLES}


def spec(name: str) -> TableSpec:
    if name not in SPECS:
        raise ValueError(f"no table is declared as {name!r}")
    return SPECS[name]


def register(table: TableSpec) -> TableSpec:
    """Declare a table of one's own."""
    SPECS[table.name] = table
    return table
