"""What is there and how it fares: inventories, status roll-ups, sessions, run counters and timings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.specs import SPECS, TableSpec



def is_failed(status: Column) -> Column:
    """``failed`` or any ``failed_...``."""
    return F.coalesce((status == "failed") | status.startswith("failed_"), F.lit(False))


def is_skipped(status: Column) -> Column:
    return F.coalesce(status.startswith("skipped"), F.lit(False))


def date_ranges(rows: DataFrame, key: str, day: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def partition_counts(rows: DataFrame, partition: str) -> DataFrame:
    return rows.groupBy(F.col(partition).cast("string").alias("partition_value")).agg(F.count("*").alias("row_count"))


def inventory_row(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One row of figures on a table; every figure comes from one aggregation."""
    day = F.col(spec.date_column) if spec.date_column else F.lit(None).cast("date")
    value = F.col(spec.partition).cast("string") if spec.partition else F.lit(None).cast("string")
    figures = rows.agg(F.count("*").alias("row_count"), F.count_distinct(value).alias("partitions"), F.max(value).alias("latest_partition"), F.min(day).cast("string").alias("min_date"), F.max(day).cast("string").alias("max_date"))
    return figures.select(F.lit(spec.name).alias("dataset"), "*")


def inventory(tables: dict[str, DataFrame], status: DataFrame | None = None) -> DataFrame:
    out = reduce(DataFrame.unionByName, [inventory_row(df, SPECS[name]) for name, df in tables.items()])
    return out if status is None else out.join(status_by_dataset(status), "dataset", "left")


def status_by_dataset(status: DataFrame) -> DataFrame:
    """Per dataset: the last success, and the status told last (one without a time counts as oldest)."""
    order = F.struct(F.col("updated_at").isNotNull(), "updated_at")
    return status.groupBy("dataset").agg(F.max("last_success_date").alias("last_success_date"), F.max_by("status", order).alias("status"))


def session_summary(outcomes: DataFrame) -> DataFrame:
    """Per code: its datasets by outcome, and whether it succeeded, failed, or was only skipped.

    The code ``*`` (or none) stands for no security and is left out, as are outcomes without a dataset.
    """
    rows = outcomes.where("coalesce(code, '') not in ('', '*') and coalesce(dataset, '') != ''")
    status = F.col("status")
    each = {"success": F.coalesce(status == "success", F.lit(False)), "failed": is_failed(status), "skipped": is_skipped(status)}
    told = rows.where(each["success"] | each["failed"] | each["skipped"])
    out = told.groupBy("code").agg(*[F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("dataset")))), ",").alias(n) for n, c in each.items()])
    return out.withColumns({"succeeded": F.col("success") != "", "any_failed": F.col("failed") != "", "only_skipped": (F.col("success") == "") & (F.col("failed") == "")})


def run_counters(records: DataFrame) -> DataFrame:
    """Outcomes of a run: ``failed`` has those that say just that, ``failed_any`` also ``failed_...``."""
    status = F.col("status")
    return records.agg(F.count_if(status == "success").alias("success"), F.count_if(status == "failed").alias("failed"), F.count_if(is_failed(status)).alias("failed_any"), F.count_if(is_skipped(status)).alias("skipped"))


def status_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("rows"))


def timing_statistics(rows: DataFrame, name: str, seconds: str) -> DataFrame:
    s = F.col(seconds)
    return rows.groupBy(name).agg(F.count(s).alias("count"), F.sum(s).alias("total"), F.avg(s).alias("mean"), F.median(s).alias("median"), F.coalesce(F.stddev_samp(s), F.lit(0.0)).alias("stdev"), F.min(s).alias("min"), F.max(s).alias("max"))


def call_profile(rows: DataFrame, function: str, seconds: str) -> DataFrame:
    return rows.groupBy(function).agg(F.count("*").alias("calls"), F.sum(seconds).alias("total"), F.avg(seconds).alias("avg"))


def latency_summary(rows: DataFrame, run: str, seconds: str, digits: int = 3) -> DataFrame:
    s = F.col(seconds)
    figures = {"total": F.sum(s), "avg": F.avg(s), "p95": F.percentile(s, F.lit(0.95)), "max": F.max(s)}
    return rows.groupBy(run).agg(F.count("*").alias("count"), *[F.round(v, digits).alias(k) for k, v in figures.items()])


def catalog(spark: SparkSession) -> DataFrame:
    """Declared tables as rows."""
    rows = [(s.name, s.family, s.code_format, s.partition or "", ",".join(s.keys), s.mode, ",".join(s.rules), s.schema.json()) for s in SPECS.values()]
    return spark.createDataFrame(rows, "dataset string, family string, code_format string, partition_column string, unique_columns string, write_mode string, rules string, schema string")


def discovery(figures: DataFrame) -> DataFrame:
    """Every declared table with its figures, where it has any."""
    return catalog(figures.sparkSession).join(figures, "dataset", "left")


def outcome_rows(results: DataFrame, run_id: str) -> DataFrame:
    """Run records from job results (``dataset``, ``code``, ``rows``, ``error``): failed, skipped without rows, or success."""
    status = F.when(F.col("error").isNotNull(), "failed").when(F.coalesce("rows", F.lit(0)) == 0, "skipped").otherwise("success")
    return results.select(F.concat_ws(":", F.lit(run_id), "dataset", "code").alias("task_id"), "dataset", "code", status.alias("status"), F.coalesce("rows", F.lit(0)).cast("long").alias("row_count"), F.col("error").alias("error_stack"))
