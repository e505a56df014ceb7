"""Valuation percentiles that respect signs, over all history and over calendar-year windows.

A sample is valid if it is neither null nor zero. A positive value is ranked among the positive ones; a negative value
counts every positive one as better, so its rank is the positives and the negatives that are at or above it, over all
valid samples. A window of N years is closed on both sides and matures once the key's first valid date lies N years back.

All windows of all values come from one exchange by key. Rows arrive sorted by key and day; whole keys are ranked
together, in numpy: the samples of a window are a range of the sorted ones, and how many of a range are below a value
comes from one pass a bit of the values' ranks, for all rows at once. ``percentiles_by_window`` gives the same through
window frames for short series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

YEARS = (1, 3, 5, 10)


def column_names(value: str, years: tuple[int, ...] = YEARS) -> list[str]:
    return [*[f"{value}_percentile_{n}y" for n in years], f"{value}_percentile_all_history"]


def years_before(days: np.ndarray, n: int) -> np.ndarray:
    """The same day ``n`` years earlier (datetime64[D]); 29 February becomes the 28th."""
    month = days.astype("M8[M]")
    earlier = month - 12 * n
    last = (earlier + 1).astype("M8[D]") - 1
    return np.minimum(earlier.astype("M8[D]") + (days - month.astype("M8[D]")), last)


def counts_below(ranks: np.ndarray, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many of ``ranks[lo:hi]`` are below ``limit``, for arrays of ranges: bit by bit, zeros before ones at each."""
    out = np.zeros(len(lo), np.int64)
    for bit in reversed(range(int(max(len(ranks), 1) + 1).bit_length())):
        ones = (ranks >> bit) & 1
        zeros = np.r_[0, np.cumsum(1 - ones)]
        wanted = ((limit >> bit) & 1).astype(bool)
        below_lo, below_hi = zeros[lo], zeros[hi]
        out += np.where(wanted, below_hi - below_lo, 0)
        lo = np.where(wanted, zeros[-1] + lo - below_lo, below_lo)
        hi = np.where(wanted, zeros[-1] + hi - below_hi, below_hi)
        ranks = np.r_[ranks[ones == 0], ranks[ones == 1]]
    return out


def ranked(group: np.ndarray, days: np.ndarray, values: np.ndarray, asked: np.ndarray, years: tuple[int, ...]) -> list[np.ndarray]:
    """Percentiles per window for the asked rows (NaN where there is none); rows sorted by group, then day (NaT anywhere)."""
    valid = np.flatnonzero(~np.isnat(days) & ~np.isnan(values) & (values != 0))
    at = np.flatnonzero(asked[valid])
    out = [np.full(len(days), np.nan) for _ in range(len(years) + 1)]
    if not len(at):
        return out
    # rows of a group and day in one number, in order
    number = days[valid].astype(np.int64)
    base, span = int(number.min()) - 366 * (max(years, default=0) + 1), int(np.ptp(number)) + 366 * (max(years, default=0) + 2)
    place = group[valid] * span + (number - base)
    rank = np.unique(values[valid], return_inverse=True)[1]
    positive = np.r_[0, np.cumsum(values[valid] > 0)]
    begin = np.searchsorted(group[valid], group[valid][at])
    hi = np.searchsorted(place, place[at], "right")
    own, up = rank[at], values[valid][at] > 0
    for slot, n in zip(out, (*years, None), strict=True):
        lo, mature = begin, np.ones(len(at), bool)
        if n is not None:
            since = years_before(days[valid][at], n)
            mature = days[valid][begin] <= since
            lo = np.maximum(begin, np.searchsorted(place, group[valid][at] * span + (since.astype(np.int64) - base)))
        held, better = hi - lo, positive[hi] - positive[lo]
        below = counts_below(rank, lo, hi, own + up)
        share = np.where(up, (below - (held - better)) / np.maximum(better, 1), (held - below) / held)
        slot[valid[at]] = np.where(mature, 100.0 * share, np.nan)
    return out


def _whole_keys(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole keys from batches sorted by key, each with its rows' key numbers."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        ends = batch[key]
        if held[0][key][0].as_py() == ends[-1].as_py():
            continue  # one key so far
        table = pa.Table.from_batches(held)
        number = _numbers(table[key])
        cut = int(np.searchsorted(number, number[-1]))
        yield table.slice(0, cut), number[:cut]
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, _numbers(table[key])


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    codes = column.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.cumsum(np.r_[0, codes[1:] != codes[:-1]]).astype(np.int64)


def percentiles(series: DataFrame, values: list[str], key: str = "code", day: str = "date", years: tuple[int, ...] = YEARS, after: str | None = None) -> DataFrame:
    """``series`` with five columns a value. Rows without a date get nulls; those without a key are one key.

    With ``after``, the name of a date column, only the rows later than it (or where it is null) are ranked and
    returned, without that column; the others are samples.
    """
    names = [n for v in values for n in column_names(v, years)]
    kept = [f for f in series.schema.fields if f.name != after]
    schema = T.StructType([*kept, *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in _whole_keys(batches, key):
            days = table[day].cast(pa.date32()).to_numpy().astype("M8[D]")
            asked = np.ones(len(number), bool)
            if after:
                last = table[after].cast(pa.date32()).to_numpy().astype("M8[D]")
                asked = np.isnat(last) | (days > last)
                table = table.drop_columns([after])
            for v in values:
                column = table[v].cast(pa.float64()).to_numpy()
                for name, got in zip(column_names(v, years), ranked(number, days, column, asked, years), strict=True):
                    table = table.append_column(name, pa.array(got, pa.float64(), from_pandas=True))
            yield from (table if asked.all() else table.filter(pa.array(asked))).to_batches()

    return series.repartition(key).sortWithinPartitions(key, day).mapInArrow(run, schema)


def percentiles_by_window(series: DataFrame, value: str, key: str = "code", day: str = "date", years: tuple[int, ...] = YEARS) -> DataFrame:
    """The same for one value in window frames alone; each row holds its frame, so only for short series."""
    v = F.when((F.col(value) != 0) & ~F.isnan(value) & F.col(day).isNotNull(), F.col(value).cast("double"))
    rows = series.withColumn("_v", v)
    first = F.min(F.when(F.col("_v").isNotNull(), F.col(day))).over(Window.partitionBy(key))

    def rank(frame) -> F.Column:
        positive = F.size(F.filter(frame, lambda x: x > 0))
        up = 100.0 * F.size(F.filter(frame, lambda x: (x > 0) & (x <= F.col("_v")))) / positive
        down = 100.0 * (positive + F.size(F.filter(frame, lambda x: (x < 0) & (x >= F.col("_v"))))) / F.size(frame)
        return F.when(F.col("_v") > 0, up).when(F.col("_v") < 0, down)

    frames = {}
    for n, name in zip((*years, None), column_names(value, years), strict=True):
        span = "unbounded preceding" if n is None else f"interval {n} year preceding"
        frames[name] = F.expr(f"collect_list(_v) over (partition by `{key}` order by `{day}` range between {span} and current row)")
    held = rows.withColumn("_first", first).withColumns({f"_{k}": f for k, f in frames.items()})
    out = {}
    for n, name in zip((*years, None), frames, strict=True):
        mature = F.lit(True) if n is None else F.col("_first") <= F.add_months(F.col(day), -12 * n)
        out[name] = F.when(F.col("_v").isNotNull() & mature, rank(F.col(f"_{name}")))
    return held.withColumns(out).drop("_v", "_first", *[f"_{k}" for k in frames])


def appended_percentiles(series: DataFrame, existing: DataFrame, values: list[str], key: str = "code", day: str = "date", years: tuple[int, ...] = YEARS) -> DataFrame:
    """Percentiles of the rows after each key's last existing date, ranked over the key's full history.

    Older rows are samples only: their own percentiles aren't computed.
    """
    last = existing.groupBy(key).agg(F.max(day).alias("_last"))
    return percentiles(series.join(last, key, "left").select(*series.columns, "_last"), values, key, day, years, after="_last")
