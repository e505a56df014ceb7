"""The same results as window forms, for keys whose rows no task can hold: series are cut into blocks.

Carrying a value forward takes two levels: within each block by a window, and from block to block over one row a block.
Ranks within a growing window take a table of counts a day and range of values: what lies below a row's own range comes
from sums over days, and only what is in its range is looked at sample by sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .asof import PRICES
from .percentile import YEARS, column_names, years_before

#: Days of a block of a series, unless told otherwise.
BLOCK_DAYS = 64
#: Ranges of values that a key's samples are cut into, and samples (distinct in day and value) that a range should hold.
RANGES, RANGE_SAMPLES = 256, 100_000


def carried_in_blocks(rows: DataFrame, keys: list[str], block: Column, order: list[Column], value: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the last ``value`` that is not null among the rows of their key up to them, in ``order``.

    ``block`` must not fall along ``order``. Rows are exchanged once, by key and block; from block to block goes one row
    a block. Rows whose block is null see the rows of such blocks only; so do keys that are null.
    """
    own = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = rows.withColumn("_block", block)
    here = cut.withColumn("_here", F.last(value, ignorenulls=True).over(own))
    place = F.struct(*[F.struct(c.isNotNull(), c) for c in order])
    ends = cut.groupBy(*keys, "_block").agg(F.max_by(value, F.when(F.col(value).isNotNull(), place)).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(before)).where("_carry is not null and _block is not null")
    carry = carry.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], F.col("_block").alias("_of"), "_carry")
    met = [F.col(k) == F.col(f"_{i}") for i, k in enumerate(keys)]
    joined = here.join(carry, [*met, F.col("_block") == F.col("_of")], "left")
    return joined.select(*rows.columns, F.coalesce("_here", "_carry").alias(name))


def asof_in_blocks(left: DataFrame, right: DataFrame, key: str, left_on: str, right_on: str, values: list[str], days: int = BLOCK_DAYS) -> DataFrame:
    """As :func:`.asof.asof_backward`, in blocks of ``days`` days, for keys with a large part of all rows; the times are dates or timestamps."""
    known = right.where(F.col(key).isNotNull() & F.col(right_on).isNotNull())
    some = known.where(F.greatest(*[F.col(v).isNotNull() for v in values])) if len(values) > 1 else known.where(F.col(values[0]).isNotNull())
    row = left.select(F.struct("*").alias("r")).schema["r"].dataType
    marks = some.select(F.col(key).alias("_key"), F.col(right_on).alias("_at"), F.lit(0).alias("_side"), F.struct(*values).alias("_value"), F.lit(None).cast(row).alias("_row"))
    held = marks.schema["_value"].dataType
    rows = left.select(F.col(key).alias("_key"), F.col(left_on).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(held).alias("_value"), F.struct("*").alias("_row"))
    block = F.floor(F.datediff(F.col("_at").cast("date"), F.lit("1970-01-01").cast("date")) / F.lit(days)).cast("long")
    found = carried_in_blocks(marks.unionByName(rows), ["_key"], block, [F.col("_at"), F.col("_side")], "_value", "_found").where("_side = 1")
    return found.select("_row.*", *[F.when(F.col("_at").isNotNull(), F.col(f"_found.{v}")).alias(v) for v in values])


# --- adjusted prices, where factors changed ---------------------------------------------------------------------------


def changed_spans(old: DataFrame, new: DataFrame, key: str, day: str, factor: str) -> DataFrame:
    """``key``, ``start``, ``end``: closed ranges of days on which the factor in force is not the same (open ends: 9999-12-31).

    Both sides are steps that hold from their day to the next; before the first the factor is 1. Rows with a null key,
    day or factor don't count. Days that follow each other with a difference become one range.
    """
    side = lambda df, a: df.where(F.col(key).isNotNull() & F.col(day).isNotNull() & F.col(factor).isNotNull()).groupBy(key, F.col(day).alias("_day")).agg(F.max(factor).alias(a))
    steps = side(old, "_old").join(side(new, "_new"), [key, "_day"], "full").withColumns({"_had": F.col("_old"), "_has": F.col("_new")})
    upto = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = Window.partitionBy(key).orderBy("_day")
    was, now = (F.coalesce(F.last(c, ignorenulls=True).over(upto), F.lit(1.0)) for c in ("_had", "_has"))
    steps = steps.select(key, "_day", (~was.eqNullSafe(now)).alias("_off"))
    steps = steps.withColumns({"_before": F.lag("_off", 1, False).over(following), "_next": F.lead("_day").over(following)})
    runs = steps.withColumn("_run", F.sum((F.col("_off") != F.col("_before")).cast("long")).over(upto)).where("_off")
    end = F.coalesce(F.date_sub(F.max("_next"), 1), F.lit("9999-12-31").cast("date"))
    last = F.max_by("_next", "_day")
    return runs.groupBy(key, "_run").agg(F.min("_day").alias("start"), F.when(last.isNull(), F.lit("9999-12-31").cast("date")).otherwise(end).alias("end")).drop("_run")


def readjusted(bars: DataFrame, factors: DataFrame, spans: DataFrame, factor: str, flag: str, factor_date: str = "dividend_operate_date") -> DataFrame:
    """The bars within ``spans`` (``code``, ``start``, ``end``), adjusted by the factors in force; no others.

    Spans of a code don't overlap, so a bar is met once, by an equi-join on its code.
    """
    own = spans.select(F.col("code").alias("_code"), "start", "end")
    hit = bars.join(own, (F.col("code") == F.col("_code")) & F.col("date").between(F.col("start"), F.col("end")), "left_semi")
    mine = factors.join(spans.select("code").distinct(), "code", "left_semi")
    joined = asof_in_blocks(hit, mine.select("code", F.col(factor_date).alias("_from"), F.col(factor).alias("_factor")), "code", "date", "_from", ["_factor"])
    times = F.coalesce("_factor", F.lit(1.0))
    prices = {p: F.col(p) * times for p in PRICES if p in bars.columns}
    return joined.withColumns(prices | {"adjust_flag": F.lit(flag)}).select(*dict.fromkeys([*bars.columns, "adjust_flag"]))


# --- percentiles ------------------------------------------------------------------------------------------------------


def weights_below(ranks: np.ndarray, weights: np.ndarray, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Sums of ``weights[lo:hi]`` whose rank is below ``limit``, for arrays of ranges, bit by bit of the ranks."""
    out = np.zeros(len(lo), np.int64)
    for bit in reversed(range(int(max(len(ranks), 1) + 1).bit_length())):
        ones = (ranks >> bit) & 1
        zeros, sums = (np.r_[0, np.cumsum(x)] for x in (1 - ones, weights * (1 - ones)))
        wanted = ((limit >> bit) & 1).astype(bool)
        out += np.where(wanted, sums[hi] - sums[lo], 0)
        lo, hi = (np.where(wanted, zeros[-1] + at - zeros[at], zeros[at]) for at in (lo, hi))
        order = np.r_[np.flatnonzero(ones == 0), np.flatnonzero(ones)]
        ranks, weights = ranks[order], weights[order]
    return out


def _sums_by_day(table: pa.Table) -> pa.Table:
    """For each range of a key: samples in lower ranges, positive ones and all, up to each of the key's days."""
    days, at = np.unique(table["_day"].to_numpy(), return_inverse=True)
    ranges, of = np.unique(table["_range"].to_numpy(), return_inverse=True)
    counts = np.zeros((len(ranges), len(days)), np.int64)
    np.add.at(counts, (of, at), table["_n"].to_numpy())
    positive = np.zeros(len(days), np.int64)
    np.add.at(positive, at, table["_positive"].to_numpy())
    upto = np.cumsum(counts, axis=1)
    lower = np.cumsum(upto, axis=0) - upto
    pack = lambda x: x.astype("<i8").tobytes()
    n = len(ranges)
    return pa.table({
        "_key": pa.concat_arrays([table["_key"].combine_chunks().slice(0, 1)] * n), "_range": pa.array(ranges),
        "_days": [pack(days)] * n, "_lower": [pack(row) for row in lower], "_positives": [pack(np.cumsum(positive))] * n, "_all": [pack(upto.sum(axis=0))] * n,
    })


def _ranked_in_range(names: list[str], years: tuple[int, ...]):
    def run(samples: pa.Table, sums: pa.Table) -> pa.Table:
        order = np.lexsort((samples["_v"].to_numpy(), samples["_day"].to_numpy()))
        day, value, weight = (samples[c].to_numpy()[order] for c in ("_day", "_v", "_n"))
        days, lower, positives, everything = (np.frombuffer(sums[c][0].as_py(), "<i8") for c in ("_days", "_lower", "_positives", "_all"))
        rank = np.unique(value, return_inverse=True)[1]
        up = value > 0
        now = np.searchsorted(days, day, "right")
        hi = np.searchsorted(day, day, "right")
        out = {"_key": samples["_key"].take(pa.array(order)), "_day": pa.array(day), "_v": pa.array(value)}
        for name, n in zip(names, (*years, None), strict=True):
            since = np.full(len(day), np.iinfo(np.int64).min) if n is None else years_before(day.astype("M8[D]"), n).astype(np.int64)
            past, lo = np.searchsorted(days, since), np.searchsorted(day, since)
            between = lambda sums_to, past=past: np.r_[0, sums_to][now] - np.r_[0, sums_to][past]
            below = between(lower) + weights_below(rank, weight, lo, hi, rank + up)
            better, held = between(positives), between(everything)
            share = np.where(up, (below - (held - better)) / np.maximum(better, 1), (held - below) / np.maximum(held, 1))
            mature = np.ones(len(day), bool) if n is None else days[0] <= since
            out[name] = pa.array(np.where(mature, 100.0 * share, np.nan), pa.float64(), from_pandas=True)
        return pa.table(out)

    return run


def percentiles_in_blocks(series: DataFrame, value: str, key: str = "code", day: str = "date", years: tuple[int, ...] = YEARS, range_samples: int = RANGE_SAMPLES) -> DataFrame:
    """As :func:`.percentile.percentiles` for one value, for keys of any number of rows.

    Rows that say the same of a key and day are one sample with a weight. A key's samples are cut by value into at most
    ``RANGES`` ranges, at approximate quantiles (where they are doesn't change the result); a task ranks one range, with
    a sum a day of what lies below it. The day is a date, so these sums are as long as a calendar, not as the series.
    """
    names = column_names(value, years)
    v = F.col(value).cast("double")
    sound = v.isNotNull() & ~F.isnan(v) & (v != 0) & F.col(day).isNotNull()
    number = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long")
    samples = series.where(sound).groupBy(F.col(key).alias("_key"), number.alias("_day"), v.alias("_v")).agg(F.count("*").alias("_n"))
    samples = samples.withColumn("_null", F.col("_key").isNull())
    cuts = samples.groupBy("_key", "_null").agg(F.percentile_approx("_v", [i / RANGES for i in range(1, RANGES)], 4 * RANGES).alias("_cuts"), F.count("*").alias("_size"))
    # as many cuts as the key's samples ask for, evenly out of all of them
    wanted = F.least(F.ceil(F.col("_size") / F.lit(range_samples)), F.lit(RANGES)).cast("int")
    cuts = cuts.select(F.col("_key").alias("_of"), F.filter("_cuts", lambda c, i: F.floor((i + 1) * wanted / F.lit(RANGES)) > F.floor(i * wanted / F.lit(RANGES))).alias("_cuts"))
    ranged = samples.join(cuts, F.col("_key").eqNullSafe(F.col("_of"))).drop("_of", "_null")
    ranged = ranged.withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).cast("long")).drop("_cuts")
    counted = ranged.groupBy("_key", "_range", "_day").agg(F.sum("_n").alias("_n"), F.sum(F.when(F.col("_v") > 0, F.col("_n")).otherwise(0)).alias("_positive"))
    kind = series.schema[key].dataType.simpleString()
    sums = counted.groupBy("_key").applyInArrow(_sums_by_day, f"_key {kind}, _range long, _days binary, _lower binary, _positives binary, _all binary")
    schema = T.StructType([T.StructField("_key", series.schema[key].dataType), T.StructField("_day", T.LongType()), T.StructField("_v", T.DoubleType()), *[T.StructField(n, T.DoubleType()) for n in names]])
    ranks = ranged.groupBy("_key", "_range").cogroup(sums.groupBy("_key", "_range")).applyInArrow(_ranked_in_range(names, years), schema)
    met = F.col(key).eqNullSafe(F.col("_key")) & (number == F.col("_day")) & (v == F.col("_v"))
    return series.join(ranks, met, "left").select(*series.columns, *names)
