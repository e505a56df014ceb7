"""Exact percentiles of groups that no task can sort: the wanted values are found by narrowing where they can be.

A double is read as a 64-bit number in the order of its value, 16 bits at a time from the top. Each round counts a
group's values by the next 16 bits within the ranges that still matter (partial counts first, so a round's rows are at
most 65,536 a range, whatever the group's size), and each wanted rank moves into one of them. After four rounds a range
is one value. Nothing ever holds a group's values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGITS, DIGIT = 4, 16


def _ordered(values: np.ndarray) -> np.ndarray:
    """Doubles as signed integers of the same order; both zeros are one."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def _value(number: np.ndarray) -> np.ndarray:
    return np.where(number < 0, number ^ np.int64(0x7FFFFFFFFFFFFFFF), number).view(np.float64)


def exact_percentiles(rows: DataFrame, group: str, value: str, fractions: dict[str, float], keep) -> DataFrame:
    """``group`` and a column per name in ``fractions``: its percentile by linear interpolation, as ``percentile`` has it.

    Nulls and NaN don't count; a group without values isn't there; a null group is one of its own. ``keep`` cuts the
    lineage after each round: it takes a DataFrame and a name, and gives it back from where it was written.
    """
    kind = rows.schema[group].dataType.simpleString()

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["g"], pa.array(_ordered(batch["v"].to_numpy()))], ["g", "x"])

    v = F.col(value).cast("double")
    numbers = rows.where(v.isNotNull() & ~F.isnan(v)).select(F.col(group).alias("g"), v.alias("v")).mapInArrow(numbered, f"g {kind}, x long")
    sizes = numbers.groupBy("g").agg(F.count("*").alias("n"))
    place = [F.struct(F.lit(name).alias("name"), (F.lit(q) * (F.col("n") - 1)).alias("at")) for name, q in fractions.items()]
    ends = F.explode(F.array(F.floor("w.at").cast("long"), F.ceil("w.at").cast("long"))).alias("rank")
    # a row a group and wanted rank: the prefix so far, and the rank within it
    wanted = sizes.select("g", F.explode(F.array(*place)).alias("w")).select("g", ends).distinct()
    wanted = keep(wanted.select("g", "rank", F.lit(0).cast("long").alias("prefix"), F.col("rank").alias("left")), "selection")
    for level in range(DIGITS):
        low = 64 - DIGIT * (level + 1)
        at = F.shiftright("x", low)
        head = F.shiftright("x", low + DIGIT) if level else F.lit(0).cast("long")
        ranges = wanted.select(F.col("g").alias("of"), F.col("prefix").alias("p")).distinct()
        inside = numbers.select("g", at.alias("cut"), head.alias("head"))
        inside = inside.join(ranges, F.col("g").eqNullSafe(F.col("of")) & (F.col("head") == F.col("p")), "left_semi")
        counts = inside.groupBy("g", "head", "cut").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("g", "head").orderBy("cut"))
        counts = counts.select(F.col("g").alias("of"), F.col("head").alias("p"), "cut", (upto - F.col("n")).alias("lo"), upto.alias("hi"))
        met = wanted.join(counts, F.col("g").eqNullSafe(F.col("of")) & (F.col("prefix") == F.col("p")) & (F.col("left") >= F.col("lo")) & (F.col("left") < F.col("hi")))
        wanted = keep(met.select("g", "rank", F.col("cut").alias("prefix"), (F.col("left") - F.col("lo")).alias("left")), "selection")

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["g"], batch["rank"], pa.array(_value(batch["prefix"].to_numpy()))], ["g", "rank", "value"])

    found = wanted.select("g", "rank", "prefix").mapInArrow(valued, f"g {kind}, rank long, value double")
    asked = sizes.select("g", F.explode(F.array(*place)).alias("w")).select(F.col("g").alias("of"), "w.name", "w.at")
    ends = asked.join(found, F.col("of").eqNullSafe(F.col("g")) & F.col("rank").between(F.floor("at"), F.ceil("at")))
    part = F.col("at") - F.floor("at")
    lower, upper = F.max(F.when(F.col("rank") == F.floor("at"), F.col("value"))), F.max(F.when(F.col("rank") == F.ceil("at"), F.col("value")))
    out = ends.groupBy("of", "name").agg(F.when(F.max(part) == 0, lower).otherwise((1 - F.max(part)) * lower + F.max(part) * upper).alias("value"))
    return out.groupBy(F.col("of").alias(group)).pivot("name", list(fractions)).agg(F.first("value"))
