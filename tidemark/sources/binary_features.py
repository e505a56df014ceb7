"""Binary feature series and the text files around them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FIELDS = ("open", "high", "low", "close", "volume", "amount", "factor", "change", "vwap", "adjclose")
FILES = r"([^/]+)/([^/]+?)\.day\.bin$"


def decoded(files: DataFrame) -> DataFrame:
    """``symbol``, ``field``, ``idx``, ``value`` from ``path``, ``content``: little-endian float32, the first one the start index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for symbol, field, content in zip(*(batch[c].to_pylist() for c in ("symbol", "field", "content")), strict=True):
                if len(content) % 4:
                    raise ValueError(f"the {field} series of {symbol} has {len(content)} bytes, no whole number of float32 values")
                data = np.frombuffer(content, "<f4")
                if len(data) > 1:
                    value = data[1:].astype(np.float64)
                    n = len(value)
                    yield pa.RecordBatch.from_arrays([pa.array([symbol] * n), pa.array([field] * n), pa.array(int(data[0]) + np.arange(n)), pa.array(value, from_pandas=True)], ["symbol", "field", "idx", "value"])

    named = files.select(F.regexp_extract("path", FILES, 1).alias("symbol"), F.regexp_extract("path", FILES, 2).alias("field"), "content").where("symbol != ''")
    return named.mapInArrow(run, "symbol string, field string, idx long, value double")


def read_features(spark: SparkSession, folder: str, calendar: DataFrame) -> DataFrame:
    """A row a symbol and day of the calendar within the range of any of its fields; a field that lacks the day is null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.day.bin").load(folder).select("path", "content")
    values = decoded(files).withColumn("value", F.bround("value", 6)).where(F.col("idx") >= 0)
    span = values.groupBy("symbol").agg(F.min("idx").alias("a"), F.max("idx").alias("b"))
    days = span.select("symbol", F.explode(F.sequence("a", "b")).alias("idx"))
    wide = values.groupBy("symbol", "idx").pivot("field", list(FIELDS)).agg(F.first("value"))
    rows = days.join(wide, ["symbol", "idx"], "left").join(calendar.select("idx", F.col("calendar_date").alias("date")), "idx")
    return rows.select("date", F.col("symbol").alias("qlib_symbol"), F.upper(F.substring("symbol", 1, 2)).alias("exchange"), F.substring("symbol", 3, 6).alias("code"), *FIELDS)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """``idx``, ``calendar_date``: a date a line, blank lines skipped, numbered from 0 in date order."""
    days = spark.read.text(path).select(F.try_to_date(F.trim("value"), "yyyy-MM-dd").alias("calendar_date")).where("calendar_date is not null").distinct()
    return days.select((F.row_number().over(Window.orderBy("calendar_date")) - 1).cast("long").alias("idx"), "calendar_date")


def read_instruments(spark: SparkSession, folder: str) -> DataFrame:
    """``universe`` (the file's stem), ``qlib_symbol``, ``exchange``, ``code``, ``start_date``, ``end_date``; short lines skipped."""
    rows = spark.read.option("sep", "\t").schema("symbol string, start string, end string").csv(folder).select("*", F.regexp_extract("_metadata.file_path", r"([^/]+)\.txt$", 1).alias("universe"))
    rows = rows.where("symbol is not null and start is not null and end is not null")
    symbol = F.lower(F.trim("symbol"))
    return rows.select("universe", symbol.alias("qlib_symbol"), F.upper(F.substring(symbol, 1, 2)).alias("exchange"), F.substring(symbol, 3, 6).alias("code"), F.try_to_date("start", "yyyy-MM-dd").alias("start_date"), F.try_to_date("end", "yyyy-MM-dd").alias("end_date"))
