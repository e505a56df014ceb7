"""The canonical entities and what is built on them: security master, daily bars, valuations, universes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from .merge import best_ranked, source_rank

NOT_VALUED = ("定转", "转换")
DELISTED_ENDING = "退"


def security_master(spot: DataFrame, delisted: DataFrame, basic: DataFrame, membership: DataFrame) -> DataFrame:
    """One row a security from four sources.

    spot: ``code name trade_date``; delisted: ``exchange code name list_date delist_date snapshot_date``; basic:
    ``code name ipo_date delist_date security_type listing_status`` (dotted codes); membership: ``qlib_symbol end_date``.
    Status: on the delisting list, else quoted, else what the basic table says, else unknown.
    """
    none = lambda kind: F.lit(None).cast(kind)

    def tagged(df: DataFrame, source: str, ident: Column, **columns: Column) -> DataFrame:
        shape = {"name": "string", "ipo": "date", "delist": "date", "kind": "string", "status": "string", "seen": "date", "symbol": "string"}
        return df.select(ident.alias("security_id"), F.lit(source).alias("source"), *[columns.get(c, none(t)).cast(t).alias(c) for c, t in shape.items()]).where("security_id is not null")

    code = codes.source_code(F.col("code"))
    listed = F.coalesce(codes.exchange_alias(F.col("exchange")), codes.exchange_of(code))
    rows = (
        tagged(spot, "spot", codes.canonical_id(codes.exchange_of(code), code), name=F.col("name"), seen=F.col("trade_date"))
        .unionByName(tagged(delisted, "delist", codes.canonical_id(listed, code), name=F.col("name"), ipo=F.col("list_date"), delist=F.col("delist_date"), seen=F.col("snapshot_date")))
        .unionByName(tagged(basic, "basic", codes.canonical_from_dotted(F.col("code")), name=F.col("name"), ipo=F.col("ipo_date"), delist=F.col("delist_date"), kind=F.col("security_type"), status=codes.listing_status(F.col("listing_status")), seen=F.greatest("ipo_date", "delist_date")))
        .unionByName(tagged(membership, "membership", codes.canonical_from_prefixed(F.col("qlib_symbol")), seen=F.col("end_date"), symbol=F.lower(F.trim("qlib_symbol"))))
    )
    order = F.struct(F.coalesce("seen", F.lit("0001-01-01").cast("date")), F.coalesce("name", F.lit("")))
    of = lambda source, c: F.max_by(F.when(F.col("source") == source, F.col(c)), F.when(F.col("source") == source, order))
    has = lambda source: F.max(F.col("source") == source)
    grouped = rows.groupBy("security_id").agg(
        has("spot").alias("in_spot"), has("delist").alias("in_delist"), has("basic").alias("in_basic"), has("membership").alias("in_membership"),
        of("spot", "name").alias("spot_name"), of("delist", "name").alias("delist_name"), of("basic", "name").alias("basic_name"),
        of("basic", "kind").alias("security_type"), of("basic", "status").alias("basic_status"), of("membership", "symbol").alias("symbol"),
        F.coalesce(of("basic", "ipo"), of("delist", "ipo")).alias("ipo_date"), F.coalesce(of("delist", "delist"), of("basic", "delist")).alias("delist_date"),
        of("basic", "delist").alias("basic_delist"), F.max("seen").alias("latest_source_date"),
    )
    status = (
        F.when(F.col("in_delist"), "delisted").when(F.col("in_spot"), "active")
        .when(F.col("basic_delist").isNotNull(), "delisted").when(F.col("in_basic"), F.col("basic_status")).otherwise("unknown")
    )
    exchange, code = F.substring("security_id", 1, 2), F.substring("security_id", 4, 6)
    sources = sum(F.col(f"in_{s}").cast("int") for s in ("spot", "delist", "basic", "membership"))
    label = F.when(sources > 1, "mixed").when(F.col("in_spot"), "akshare_spot").when(F.col("in_delist"), "akshare_delist").when(F.col("in_basic"), "baostock_basic").otherwise("qlib_only")
    return grouped.select(
        "security_id", code.alias("code"), exchange.alias("exchange"),
        codes.picked_name(F.col("spot_name"), F.col("delist_name"), F.col("basic_name"), status == "active").alias("name"),
        "security_type", codes.board(exchange, code).alias("board"), codes.dotted(exchange, code).alias("baostock_code"), code.alias("akshare_code"),
        F.coalesce(F.col("symbol"), F.when(exchange != "BJ", codes.prefixed(exchange, code))).alias("qlib_symbol"),
        "ipo_date", "delist_date", status.alias("listing_status"), F.when(status != "unknown", status == "active").alias("is_active"),
        label.alias("source_priority"), "latest_source_date",
    )


def canonical_bars(sources: list[DataFrame], master: DataFrame, preferred: str) -> DataFrame:
    """Bars of several sources (same columns, with ``security_id``, ``adjustment``, ``source_dataset``,
    ``quality_status``), one row a date, security and adjustment by source rank, with the master's attributes."""
    rows = sources[0]
    for more in sources[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    blank = lambda c, default: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default)).alias(c)
    rows = rows.withColumns({"source_endpoint": blank("source_endpoint", "unknown"), "quality_status": blank("quality_status", "unknown")})
    best = best_ranked(rows, ["date", "security_id", "adjustment"], source_rank(preferred), [F.col("source_dataset"), F.xxhash64(*rows.columns)])
    known = master.select("security_id", "code", "exchange", "name", "is_active")
    return best.drop("code", "exchange", "name", "is_active").join(known, "security_id")


def merged_valuations(metrics: DataFrame, ranks: DataFrame, shared: dict[str, str], keys: tuple[str, str] = ("security_id", "date"), names: tuple[str, str] = ("metrics", "percentiles")) -> DataFrame:
    """All dates of either side. ``shared`` maps a metric to the other side's column for it: the first one known stands.

    ``source_dataset`` says which sides a row comes from.
    """
    a, b = metrics.withColumn("_a", F.lit(True)), ranks.withColumn("_b", F.lit(True))
    b = b.withColumnsRenamed({c: f"_b_{c}" for c in shared.values()})
    joined = a.join(b, list(keys), "full")
    source = F.when(F.col("_a") & F.col("_b"), "+".join(names)).when(F.col("_a"), names[0]).otherwise(names[1])
    filled = {m: F.coalesce(F.col(m), F.col(f"_b_{r}")) for m, r in shared.items()}
    return joined.withColumns(filled | {"source_dataset": source}).drop("_a", "_b", *[f"_b_{r}" for r in shared.values()])


def active_codes(basic: DataFrame, kind: str | None = None) -> DataFrame:
    """Codes with listing status 1, of one security type if named."""
    rows = basic.where("listing_status = '1'")
    return (rows.where(F.col("security_type") == kind) if kind else rows).select("code").distinct()


def universe(spot: DataFrame, delisted: DataFrame, full: bool = False) -> DataFrame:
    """Quoted codes that are on no delisting list, or with ``full`` all codes of either."""
    quoted, gone = spot.select("code").distinct(), delisted.select("code").distinct()
    return quoted.union(gone).distinct() if full else quoted.join(gone, "code", "left_anti")


def valuation_universe(spot: DataFrame, delisted: DataFrame) -> DataFrame:
    """Codes worth valuing: quoted with a price, not delisted, no converting or delisting name."""
    name = F.coalesce("name", F.lit(""))
    rows = spot.where(F.col("last_price").isNotNull() & ~name.rlike("|".join(NOT_VALUED)) & ~name.endswith(DELISTED_ENDING))
    return rows.select("code").distinct().join(delisted.select("code").distinct(), "code", "left_anti")


def without_delisted(bars: DataFrame, delisted: DataFrame) -> DataFrame:
    return bars.join(delisted.select("code").distinct(), "code", "left_anti")


def with_any_source(master: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Master rows whose code in either source has data; ``first`` holds dotted codes, ``second`` six digits."""
    a, b = first.select(F.col("code").alias("baostock_code")).distinct(), second.select(F.col("code").alias("akshare_code")).distinct()
    known = master.join(a, "baostock_code", "left_semi").select("security_id").union(master.join(b, "akshare_code", "left_semi").select("security_id")).distinct()
    return master.join(known, "security_id", "left_semi")
