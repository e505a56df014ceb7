"""Derived tables as one build: security master, then canonical bars, then valuations, in full or for what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocks, lineage, master
from ..operators.normalize import conformed
from ..sources.tables import LEDGER, Lake
from .specs import spec

TARGETS = ("cn_security_master", "cn_stock_daily_bar", "cn_stock_valuation")
#: Percentile columns of the first vendor by what they become.
PERCENTILES = {f"{a}_percentile_{w}": f"{b}_percentile_{w}" for a, b in (("pe_ttm", "pe_ttm"), ("pb_mrq", "pb"), ("ps_ttm", "ps"), ("pcf_ncf_ttm", "pcf")) for w in ("1y", "3y", "5y", "10y", "all_history")}
METRICS = {"pe_ttm": "pe_ttm", "pb": "pb_mrq", "ps": "ps_ttm", "pcf": "pcf_ncf_ttm"}
#: Attributes of the master whose change makes a security's rows stale.
DESCRIBED = ("security_id", "code", "exchange", "name", "security_type", "board", "baostock_code", "akshare_code", "qlib_symbol", "delist_date", "listing_status", "is_active")
ADJUSTMENTS = ("unadjusted", "qfq", "hfq")


#: Per child target the source tables and the master's column that names their partition.
SOURCES = {
    TARGETS[1]: [(f"{vendor}_cn_stock_daily_bar_{a}", f"{vendor}_code") for a in ADJUSTMENTS for vendor in ("baostock", "akshare")],
    TARGETS[2]: [("akshare_cn_stock_valuation_eastmoney", "akshare_code"), ("baostock_cn_stock_valuation_percentile", "baostock_code")],
}


def build_master(lake: Lake) -> DataFrame:
    """From the latest quotes, those of the second vendor where the first has none; where no index membership is stored,
    the symbols of the feature series stand for it."""
    spot = lake.latest("akshare_cn_stock_spot_quote_eastmoney")
    if not spot.take(1):
        spot = lake.latest("akshare_cn_stock_spot_quote_sina")
    membership = lake.read("qlib_cn_instrument_membership")
    if not membership.take(1):
        membership = lake.partitions("qlib_cn_stock_features_day").select(F.col("partition_value").alias("qlib_symbol"), F.lit(None).cast("date").alias("end_date"))
    gone = lake.latest("akshare_cn_stock_delist_sh").unionByName(lake.latest("akshare_cn_stock_delist_sz"))
    rows = master.security_master(spot, gone, lake.read("baostock_cn_stock_basic"), membership)
    return conformed(rows.withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz")), spec(TARGETS[0]).schema)


def source_partitions(lake: Lake, target: str, known: DataFrame) -> DataFrame:
    """``security_id``, ``dataset``, ``partition_value``: the source partitions in storage that a security's rows come from."""
    out = lake.spark.createDataFrame([], "security_id string, dataset string, partition_value string")
    for name, column in SOURCES[target]:
        if not lake.exists(name):
            continue
        own = known.select("security_id", F.lit(name).alias("dataset"), F.col(column).alias("partition_value")).join(lake.partition_names(name), "partition_value")
        out = out.unionByName(own)
    return out


def _rows_of(lake: Lake, name: str, pairs: DataFrame) -> DataFrame:
    """Rows of the named partitions of a source, with the security that each belongs to."""
    own = pairs.where(F.col("dataset") == name).select("security_id", "partition_value")
    return lake.read_partitions(name, own).join(own.withColumnRenamed("partition_value", spec(name).partition), spec(name).partition)


def bar_sources(lake: Lake, pairs: DataFrame) -> DataFrame:
    """Bars of both vendors under canonical ids, tagged with where they come from."""
    parts = []
    for a in ADJUSTMENTS:
        for vendor in ("baostock", "akshare"):
            name = f"{vendor}_cn_stock_daily_bar_{a}"
            rows = _rows_of(lake, name, pairs).withColumns({"adjustment": F.lit(a), "source_dataset": F.lit(name)})
            parts.append(rows if vendor == "akshare" else rows.withColumn("quality_status", F.lit("daily_bar_confirmed")).withColumn("source_endpoint", F.lit("query_history_k_data_plus")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def build_bars(lake: Lake, known: DataFrame, pairs: DataFrame) -> DataFrame:
    rows = master.canonical_bars([bar_sources(lake, pairs)], known, "baostock")
    return conformed(rows.withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz")), spec(TARGETS[1]).schema)


def build_valuations(lake: Lake, known: DataFrame, pairs: DataFrame) -> DataFrame:
    names = ("akshare_cn_stock_valuation_eastmoney", "baostock_cn_stock_valuation_percentile")
    metrics = _rows_of(lake, names[0], pairs).drop("code", "pct_change", "peg")
    ranks = _rows_of(lake, names[1], pairs).drop("code").withColumnsRenamed(PERCENTILES)
    rows = master.merged_valuations(metrics, ranks, METRICS, names=names)
    rows = rows.join(known.select("security_id", "code", "exchange", "name"), "security_id")
    return conformed(rows.withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz")), spec(TARGETS[2]).schema)


def planned(lake: Lake, target: str, known: DataFrame, pairs: DataFrame, changed_since: str | None = None) -> tuple[DataFrame, DataFrame]:
    """From the ledger alone: what each security's rows would be built from now, and what has to be done for that.

    Source partitions that the ledger lacks are read and entered first; others are not opened. With ``changed_since``,
    securities with a source partition that was written at that moment or later are rebuilt whatever they say.
    """
    entries = pairs.join(lake.entered(pairs), ["dataset", "partition_value"])
    parts = entries.select("security_id", "dataset", "partition_value", F.col("semantic_hash").alias("content_hash"))
    want = lineage.signatures(parts, known, "security_id", list(DESCRIBED))
    late = entries.where(F.col("updated_at") >= F.lit(changed_since).cast("timestamp_ntz")).select("security_id") if changed_since else None
    held = lake.read(LEDGER).where(F.col("dataset") == target).select(F.col("partition_value").alias("security_id"), "source_signature", "master_row_hash")
    return want, lineage.changed_keys(want, held, "security_id", late)


def build(lake: Lake, targets: tuple[str, ...] = TARGETS, securities: list[str] | None = None, full: bool = False, changed_since: str | None = None) -> dict[str, int]:
    """Build targets in order; the master always in full. Returns how many securities each child rebuilt.

    A child is built in full where it or its ledger is missing, or on request; else for the named securities, or for
    those whose sources or attributes changed by the ledger, or were written at or after ``changed_since``. Only the
    source partitions of what is built are read. Partitions without a source are deleted. The ledger keeps the signature
    that each partition was built from. Source partitions without rows are a :class:`LedgerError`.
    """
    lake.rebuild(TARGETS[0], build_master(lake))
    known = lake.read(TARGETS[0])
    built = {}
    for target, make in ((TARGETS[1], build_bars), (TARGETS[2], build_valuations)):
        if target not in targets:
            continue
        built[target] = _build_child(lake, target, make, known, securities, full, changed_since)
    return built


def _build_child(lake: Lake, target: str, make, known: DataFrame, securities: list[str] | None, full: bool, changed_since: str | None) -> int:
    with lake.held(source_partitions(lake, target, known)) as pairs:
        want, plan = planned(lake, target, known, pairs, changed_since)
        whole = full or (securities is None and (not lake.exists(target) or not lake.read(LEDGER).where(F.col("dataset") == target).take(1)))
        if whole:
            chosen, gone = want, []
        else:
            if securities is not None:
                plan = want.where(F.col("security_id").isin(securities)).select("security_id", F.lit("rebuild").alias("action"))
            chosen = want.join(plan.where("action <> 'delete'"), "security_id", "left_semi")
            gone = [r[0] for r in plan.where("action = 'delete'").select("security_id").collect()]
        # the plan is read from the ledger that the writes replace
        with lake.held(chosen) as chosen:
            signatures = chosen.withColumnRenamed("security_id", "partition_value")
            number = chosen.count()
            if whole:
                lake.rebuild(target, make(lake, known, pairs), signatures)
            elif number:
                lake.write(target, make(lake, known, pairs.join(chosen, "security_id", "left_semi")), "replace", signatures=signatures)
            lake.delete_partitions(target, gone)
    return number


#: Per adjustment the factor that it takes, and the flag of its bars.
ADJUSTED = {"qfq": ("forward_adjust_factor", "2"), "hfq": ("backward_adjust_factor", "1")}
FACTORS, UNADJUSTED = "baostock_cn_stock_adjustment_factor", "baostock_cn_stock_daily_bar_unadjusted"


def refresh_adjusted(lake: Lake, fetched: DataFrame) -> dict[str, int]:
    """Adjusted bars after new factors of some codes (``fetched`` has all of a code's); returns the bars put anew.

    The days on which a stored and a fetched factor differ are worked out first; only these days' bars of these codes are
    read, from their partitions, and replaced. A code without stored adjusted bars gets all of them. The factors are
    stored last, so a run that breaks off finds the same difference again.
    """
    put = {}
    with lake.held(conformed(fetched, spec(FACTORS).schema)) as fresh:
        codes = fresh.select("code").distinct()
        old = lake.read_partitions(FACTORS, codes.withColumnRenamed("code", "partition_value"))
        for adjustment, (factor, flag) in ADJUSTED.items():
            name = f"baostock_cn_stock_daily_bar_{adjustment}"
            stored = lake.partition_names(name).withColumnRenamed("partition_value", "code")
            spans = blocks.changed_spans(old, fresh, "code", "dividend_operate_date", factor).join(stored, "code", "left_semi")
            whole = codes.join(stored, "code", "left_anti").select("code", F.lit("0001-01-01").cast("date").alias("start"), F.lit("9999-12-31").cast("date").alias("end"))
            with lake.held(spans.unionByName(whole)) as spans:
                bars = lake.read_partitions(UNADJUSTED, spans.select(F.col("code").alias("partition_value")))
                with lake.held(blocks.readjusted(bars, fresh, spans, factor, flag)) as rows:
                    put[adjustment] = rows.count()
                    if put[adjustment]:
                        lake.write(name, rows, "upsert")
        lake.write(FACTORS, fresh, "replace")
    return put
