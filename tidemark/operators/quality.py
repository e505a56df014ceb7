"""Data quality: every rule of a table counts its violations in one aggregation, and shows the least keys of bad rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.codes import CANONICAL, SIX_DIGITS
from ..plans.specs import TableSpec

HARD, SOFT = "hard", "soft"
SAMPLE = 5


class QualityError(ValueError):
    """A hard rule is violated; nothing is written."""


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def bad_ohlc() -> Column:
    """Low above or high below the others, by more than 1e-4 of the high; rows with a null price don't count."""
    slack = F.abs("high") * 1e-4
    wrong = (F.col("high") + slack < F.greatest("open", "close", "low")) | (F.col("low") - slack > F.least("open", "close", "high"))
    known = F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull()
    return F.coalesce(known & wrong, F.lit(False))


def not_negative(c: str) -> Column:
    value = F.col(c).cast("string").try_cast("double")
    return value.isNull() | (value < 0)


def bad_canonical_id() -> Column:
    return ~F.coalesce(F.col("security_id").rlike(CANONICAL) & (F.col("security_id") == F.concat_ws(".", "exchange", "code")), F.lit(False))


def bad_cross_codes() -> Column:
    expect = lambda column, value: F.col(column).isNotNull() & ~F.coalesce(F.col(column) == value, F.lit(False))
    low = F.lower("exchange")
    return expect("baostock_code", F.concat_ws(".", low, "code")) | expect("akshare_code", F.col("code")) | expect("qlib_symbol", F.concat(low, F.col("code")))


def percentile_columns(spec: TableSpec) -> list[str]:
    return [c for c in spec.schema.names if "_percentile_" in c]


#: Columns that no derived row may lack.
FILLED = ("date", "security_id", "code", "exchange", "adjustment", "source_dataset", "updated_at")


def lacking(spec: TableSpec) -> Column:
    out = F.lit(False)
    for c in FILLED:
        out = out | blank(c) if c in spec.schema.names else out
    return out


#: Rule: severity, and the condition that marks a bad row.
RULES: dict[str, tuple[str, Callable[[TableSpec], Column]]] = {
    "dates": (HARD, lambda s: F.col(s.date_column).isNull()),
    "six_digits": (HARD, lambda s: ~F.coalesce(F.col("code").rlike(SIX_DIGITS), F.lit(False))),
    "ohlc": (SOFT, lambda s: bad_ohlc()),
    "volume_not_negative": (SOFT, lambda s: not_negative("volume")),
    "amount_not_negative": (SOFT, lambda s: not_negative("amount")),
    "filled": (HARD, lacking),
    "item_named": (HARD, lambda s: blank("item_name")),
    "canonical_id": (HARD, lambda s: bad_canonical_id()),
    "cross_codes": (HARD, lambda s: bad_cross_codes()),
    "active_status": (HARD, lambda s: F.coalesce(F.col("is_active"), F.lit(False)) & ~F.coalesce(F.col("listing_status") == "active", F.lit(False))),
    "adjustment": (HARD, lambda s: ~F.coalesce(F.col("adjustment").isin("unadjusted", "qfq", "hfq"), F.lit(False))),
    "percentiles": (HARD, lambda s: F.greatest(*[F.coalesce(~F.col(c).between(0, 100), F.lit(False)) for c in percentile_columns(s)])),
}
#: Rules on keys: severity and columns (None: the table's own).
KEY_RULES: dict[str, tuple[str, tuple[str, ...] | None]] = {"unique": (HARD, None), "delist_unique": (SOFT, ("snapshot_date", "market", "code"))}


def schema_violations(df: DataFrame, spec: TableSpec) -> list[str]:
    """Columns that differ from the declared ones, in name, order or type."""
    want, have = [(f.name, f.dataType) for f in spec.schema], [(f.name, f.dataType) for f in df.schema]
    return [f"{a} instead of {b}" for a, b in zip(have, want, strict=False) if a != b] + [f"{len(have)} columns instead of {len(want)}"] * (len(have) != len(want))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows have, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def row_violations(df: DataFrame, rules: dict[str, tuple[str, Column]], keys: list[str], table: str) -> DataFrame:
    """``dataset``, ``rule``, ``severity``, ``violations``, ``sample`` (the least keys of bad rows) for each rule.

    All rules are counted in one aggregation without a shuffle of rows; only bad rows are looked at for samples. These
    are ranked in parts first, so a rule that most rows break hands on few keys.
    """
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    counted = df.agg(*[F.count_if(c).alias(r) for r, (_, c) in rules.items()])
    counts = counted.select(F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"), F.col(r).alias("violations")) for r, (s, _) in rules.items()])).alias("m")).select("m.*")
    broken = F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, (_, c) in rules.items()]))
    bad = df.select(key.alias("key"), F.explode(broken).alias("rule"))
    # ranks stop at SAMPLE within each part before the parts meet, so a rule that most rows break sends few keys on
    part = Window.partitionBy("rule", F.pmod(F.xxhash64("key"), F.lit(256))).orderBy("key")
    some = bad.distinct().withColumn("n", F.row_number().over(part)).where(F.col("n") <= SAMPLE)
    first = some.withColumn("n", F.row_number().over(Window.partitionBy("rule").orderBy("key"))).where(F.col("n") <= SAMPLE)
    sample = first.groupBy("rule").agg(F.concat_ws(",", F.sort_array(F.collect_list("key"))).alias("sample"))
    out = counts.join(sample, "rule", "left")
    return out.select(F.lit(table).alias("dataset"), "rule", "severity", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"), F.coalesce("sample", F.lit("")).alias("sample"))


def report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All rules of a declared table; keys that several rows share count once each."""
    rows = row_violations(df, {r: (RULES[r][0], RULES[r][1](spec)) for r in spec.rules if r in RULES}, list(spec.keys), spec.name) if any(r in RULES for r in spec.rules) else None
    for rule in (r for r in spec.rules if r in KEY_RULES):
        severity, keys = KEY_RULES[rule]
        repeated = duplicates(df, list(keys or spec.keys))
        text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in (keys or spec.keys)])
        named = repeated.select(text.alias("key"))
        least = named.orderBy("key").limit(SAMPLE).agg(F.concat_ws(",", F.sort_array(F.collect_list("key"))).alias("sample"))
        part = named.agg(F.count("*").alias("violations")).join(least)
        part = part.select(F.lit(spec.name).alias("dataset"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "violations", "sample")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def unordered_groups(df: DataFrame, group: str, day: str, order: str) -> DataFrame:
    """Groups whose dates fall at some row, in the order of arrival."""
    before = F.lag(day).over(Window.partitionBy(group).orderBy(order))
    return df.withColumn("_before", before).groupBy(group).agg(F.count_if(F.col("_before") > F.col(day)).alias("falls")).where("falls > 0")


def observed(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, Observation | None]:
    """``df`` with its row rules counted by whatever job reads it to the end, a write among them; no pass of its own."""
    rules = {r: RULES[r][1](spec) for r in spec.rules if r in RULES}
    if not rules:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.count_if(c).alias(r) for r, c in rules.items()]), seen


def observed_by_reading(df: DataFrame, spec: TableSpec) -> Observation | None:
    """The counts of a table that is there already, by one pass over the columns that the rules name."""
    rows, seen = observed(df, spec)
    if seen is not None:
        rows.write.format("noop").mode("overwrite").save()
    return seen


def _told(df: DataFrame, spec: TableSpec, seen: Observation) -> dict[str, int]:
    """What was observed; a plan that the optimiser knows to be empty is never run, tells nothing, and is counted instead."""
    try:
        return seen.get
    except Py4JJavaError:
        return df.agg(*[F.count_if(RULES[r][1](spec)).alias(r) for r in spec.rules if r in RULES]).first().asDict()


def judge(df: DataFrame, spec: TableSpec, seen: Observation | None) -> None:
    """Raises if the schema, a hard rule counted in ``seen``, or a key rule is off; only then are bad rows looked for."""
    wrong = schema_violations(df, spec)
    if wrong:
        raise QualityError(f"{spec.name}: {'; '.join(wrong)}")
    counts = _told(df, spec, seen) if seen is not None else {}
    hard = [r for r, n in counts.items() if n and RULES[r][0] == HARD]
    found = row_violations(df, {r: (HARD, RULES[r][1](spec)) for r in hard}, list(spec.keys), spec.name) if hard else None
    by_key = report(df, replace(spec, rules=tuple(r for r in spec.rules if r in KEY_RULES)))
    found = by_key if found is None else found if by_key is None else found.unionByName(by_key)
    bad = found.where("severity = 'hard' and violations > 0").collect() if found is not None else []  # a row a rule at most
    if bad:
        raise QualityError(f"{spec.name}: " + "; ".join(f"{r['rule']} {r['violations']} ({r['sample']})" for r in bad))


def checked(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df``; raises if its schema or a hard rule is off. Soft rules are the caller's to read from :func:`report`."""
    judge(df, spec, observed_by_reading(df, spec))
    return df
