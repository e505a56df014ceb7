"""Ledgers of partitions, signatures of sources, and the plan of what has to be built again."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.specs import TableSpec

#: Columns that tell when or by whom a row was written, not what it says.
OPERATIONAL = ("fetched_at", "updated_at", "created_at", "ingested_at", "downloaded_at", "collected_at", "run_id", "writer_pid", "writer_thread")


def row_text(columns: list[str]) -> Column:
    """A row's values as one text, each after its length: null is told from empty, and no two rows read alike."""
    told = lambda c: F.concat(F.length(c).cast("string"), F.lit(":"), c)
    return F.concat_ws("|", *[F.coalesce(told(F.col(c).cast("string")), F.lit("~")) for c in columns])


def content_hash(columns: list[str]) -> Column:
    """An aggregate: a hash of a group's rows whatever their order.

    Rows are hashed one by one and added up in three 64-bit lanes, so groups of any size need no list of their rows.
    """
    digest = F.sha2(row_text(columns), 256)
    lanes = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(3)]
    return F.sha2(F.concat_ws(":", F.count("*").cast("string"), *[F.sum(x).cast("string") for x in lanes]), 256)


def schema_hash(schema: T.StructType) -> str:
    return hashlib.sha256("|".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema).encode()).hexdigest()


def ledger(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A row a partition: rows, least and greatest date, content and semantic hash, schema hash."""
    value = F.col(spec.partition).cast("string") if spec.partition else F.lit("")
    day = F.col(spec.date_column).cast("string") if spec.date_column else F.lit(None).cast("string")
    names = df.columns
    meaning = [c for c in names if c not in OPERATIONAL]
    return (
        df.groupBy(value.alias("partition_value"))
        .agg(F.count("*").alias("row_count"), F.min(day).alias("min_date"), F.max(day).alias("max_date"), content_hash(names).alias("content_hash"), content_hash(meaning).alias("semantic_hash"))
        .select(F.lit(spec.name).alias("dataset"), F.lit(spec.partition or "").alias("partition_column"), "*", F.lit(schema_hash(df.schema)).alias("schema_hash"))
    )


def unchanged_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose rows say the same in both: no need to write them again."""
    columns = [c for c in old.columns if c not in OPERATIONAL]
    sign = lambda df, name: df.groupBy(key).agg(content_hash(columns).alias(name))
    return sign(old, "a").join(sign(new, "b"), key).where("a = b").select(key)


def signatures(sources: DataFrame, master: DataFrame, key: str, described: list[str]) -> DataFrame:
    """``key``, ``source_signature``, ``master_row_hash``: what a target row was, or would be, built from.

    ``sources`` has a row a key and source partition: ``dataset``, ``partition_value``, ``content_hash``.
    """
    parts = F.sort_array(F.collect_list(F.concat_ws(":", "dataset", "partition_value", "content_hash")))
    known = master.select(key, F.sha2(row_text(described), 256).alias("master_row_hash"))
    own = sources.groupBy(key).agg(F.concat_ws(",", parts).alias("parts")).join(known, key)
    return own.select(key, F.sha2(F.concat_ws("#", "parts", "master_row_hash"), 256).alias("source_signature"), "master_row_hash")


def changed_keys(expected: DataFrame, stored: DataFrame, key: str, updated: DataFrame | None = None) -> DataFrame:
    """``key``, ``action`` (build, rebuild or delete), ``reason`` for keys that are not as their sources want them.

    Keys in ``updated``, whose sources were written again since some moment, are rebuilt whatever the signatures say.
    """
    a = expected.select(key, F.col("source_signature").alias("want"), F.col("master_row_hash").alias("want_master"), F.lit(True).alias("wanted"))
    b = stored.select(key, F.col("source_signature").alias("have"), F.col("master_row_hash").alias("have_master"), F.lit(True).alias("held"))
    both = a.join(b, key, "full")
    late = F.lit(False)
    if updated is not None:
        both = both.join(updated.select(key).distinct().withColumn("late", F.lit(True)), key, "left")
        late = F.coalesce("late", F.lit(False))
    action = (
        F.when(F.col("wanted").isNull(), "delete").when(F.col("held").isNull(), "build")
        .when(~F.col("want").eqNullSafe(F.col("have")) | ~F.col("want_master").eqNullSafe(F.col("have_master")) | late, "rebuild")
    )
    reason = (
        F.when(F.col("wanted").isNull(), "no source").when(F.col("held").isNull(), "no target")
        .when(~F.col("want_master").eqNullSafe(F.col("have_master")), "master").when(~F.col("want").eqNullSafe(F.col("have")), "signature").otherwise("updated")
    )
    return both.select(key, action.alias("action"), reason.alias("reason")).where("action is not null")


def missing_partitions(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(dataset, partition_value) pairs that the ledger lacks and that have to be read to fill it."""
    return pairs.join(known, ["dataset", "partition_value"], "left_anti")


def without_completed(tasks: DataFrame, checkpoints: DataFrame, keys: list[str], outputs: DataFrame | None = None) -> DataFrame:
    """Tasks whose latest checkpoint isn't a success, or whose output is gone where ``outputs`` (by ``keys``) tells.

    ``keys`` with a start and an end date ask for that very range, with the end alone for any that ends there;
    checkpoints without one of the keys count for nothing. A checkpoint without a time is older than any.
    """
    order = F.struct(F.col("updated_at").isNotNull(), "updated_at")
    known = checkpoints.dropna(subset=keys)
    done = known.groupBy(*keys).agg(F.max_by("status", order).alias("status")).where("status = 'success'").select(*keys)
    done = done if outputs is None else done.join(outputs.select(*keys), keys, "left_semi")
    return tasks.join(done, keys, "left_anti")


def above_high_water(rows: DataFrame, existing: DataFrame, key: str, day: str) -> DataFrame:
    """Rows after the last existing date of their key."""
    last = existing.groupBy(key).agg(F.max(day).alias("_last"))
    return rows.join(last, key, "left").where(F.col("_last").isNull() | (F.col(day) > F.col("_last"))).drop("_last")
