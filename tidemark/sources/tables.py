"""Declared tables on storage: reads with explicit schemas, views, and the write modes.

Tables are plain Parquet, partitioned by at most one column. A write never overwrites what it reads: merged rows are
staged beside the table first, and only the partitions that change are replaced (dynamic overwrite).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lineage import content_hash, ledger, missing_partitions
from ..operators.merge import keep_last, latest_per_key, new_partitions_only
from ..operators.normalize import conformed, migrated, with_fixed
from ..operators.quality import QualityError, checked, judge, observed, observed_by_reading
from ..plans.specs import SPECS, TableSpec, columns, spec

LEDGER = "dataset_partition_manifest"
#: Where a row stands in the order of arrival: the name of its file, then its place in it (:func:`landed`).
ARRIVAL = "_arrival"


class MigrationError(RuntimeError):
    """What a migration wrote is not what it read; nothing was swapped in."""


class LedgerError(RuntimeError):
    """Partitions that the ledger lacks and that storage has no rows for."""


#: Folder column of tables whose partitions share files (``groups`` of :class:`Lake`).
GROUP = "partition_group"

#: Partition values that are named one by one in a read (so that folders are chosen before anything is opened); more are joined.
NAMED_PARTITIONS = 10_000


class Lake:
    """Tables below one root, by name.

    Writes of partitioned tables enter what they wrote into the ledger of partitions, so that a build can tell from the
    ledger alone what changed; ``keeps_ledger`` turns that off for tables that nothing is built from.

    A partition is a folder of its own, or, with ``groups``, one of many in a folder: that many folders hold all
    partitions of a table, by a hash of their value. Writes then replace whole folders and carry the other partitions of
    these over. It suits tables of many small partitions; the number has to stay the same for a root.
    """

    def __init__(self, spark: SparkSession, root: str, keeps_ledger: bool = True, groups: int | None = None):
        self.spark, self.root, self.keeps_ledger, self.groups = spark, root.rstrip("/"), keeps_ledger, groups

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def exists(self, name: str) -> bool:
        fs, path = self._fs(self.path(name))
        return fs.exists(path)

    def _delete(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)

    def _rename(self, source: str, target: str) -> None:
        fs, a = self._fs(source)
        _, b = self._fs(target)
        if not fs.rename(a, b):
            raise OSError(f"{source} could not become {target}")

    # --- reading

    def read(self, name: str, partition: str | None = None) -> DataFrame:
        """The table, or one partition of it; typed and empty where nothing is stored."""
        table = spec(name)
        if not self.exists(name):
            return self.spark.createDataFrame([], table.schema)
        rows = self.spark.read.schema(table.schema).parquet(self.path(name)).select(*table.schema.names)
        return rows if partition is None else rows.where(F.col(table.partition) == F.lit(partition).cast(table.schema[table.partition].dataType))

    def _group(self, column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(self.groups)).cast("int")

    def _in_groups_of(self, name: str, values: DataFrame) -> DataFrame:
        """Stored rows of the folders that hold the partitions in ``values`` (the partition column); others are not opened."""
        table = spec(name)
        touched = [r[0] for r in values.select(self._group(table.partition)).distinct().collect()]  # as many as folders at most
        rows = self.spark.read.schema(table.schema).parquet(self.path(name))
        if GROUP not in rows.columns:  # no folder is left
            return rows
        return rows.where(F.col(GROUP).isin(touched) if touched else F.lit(False)).select(*table.schema.names)

    def latest(self, name: str) -> DataFrame:
        """The partition with the greatest value; its value is found without reading rows of others."""
        rows, column = self.read(name), spec(name).partition
        return rows.join(F.broadcast(rows.agg(F.max(column).alias(column))), column, "left_semi")

    def partitions(self, name: str) -> DataFrame:
        column = spec(name).partition
        return self.read(name).select(F.col(column).cast("string").alias("partition_value")).distinct().orderBy("partition_value")

    def partition_names(self, name: str) -> DataFrame:
        """``partition_value`` of each partition in storage, from the names of its files; no file is opened (with ``groups`` that one column is read)."""
        if not self.exists(name):
            return self.spark.createDataFrame([], "partition_value string")
        if self.groups:
            return self.read(name).select(F.col(spec(name).partition).cast("string").alias("partition_value")).where("partition_value <> ''").distinct()
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.path(name))
        escaped = F.regexp_extract("path", f"/{spec(name).partition}=([^/]+)/", 1)
        return files.select(F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B"))).alias("partition_value")).where("partition_value <> ''").distinct()

    def read_partitions(self, name: str, values: DataFrame) -> DataFrame:
        """Rows of the partitions in ``values`` (``partition_value``); other partitions' files are not opened."""
        column = spec(name).partition
        if not self.exists(name):
            return self.read(name)
        if self.groups:
            wanted = values.select(F.col("partition_value").cast(spec(name).schema[column].dataType).alias(column)).distinct()
            return self._in_groups_of(name, wanted).join(wanted, column, "left_semi").select(*spec(name).schema.names)
        some = [r[0] for r in values.select("partition_value").distinct().limit(NAMED_PARTITIONS + 1).collect()]
        rows = self.read(name)
        if len(some) <= NAMED_PARTITIONS:
            kind = spec(name).schema[column].dataType
            return rows.where(F.col(column).isin([F.lit(v).cast(kind) for v in some]) if some else F.lit(False))
        wanted = values.select(F.col("partition_value").cast(spec(name).schema[column].dataType).alias(column)).distinct()
        return rows.join(wanted, column, "left_semi")

    def create_views(self, legacy: tuple[str, ...] = ()) -> list[str]:
        """A temporary view for each declared table, empty ones included; views under ``legacy`` names are dropped."""
        for name in legacy:
            self.spark.catalog.dropTempView(name)
        for table in SPECS.values():
            self.read(table.name).createOrReplaceTempView(table.view)
        return [t.view for t in SPECS.values()]

    def partition_statistics(self, name: str) -> DataFrame:
        """``partition_value``, ``row_count``, ``min_date``, ``max_date``, ``files``, ``file_size_bytes``, ``file_mtime`` of each partition.

        Rows and dates come from the footers alone (the reader takes the aggregate over), files from their listing: no
        row is read. A row a partition, one in all for a table without; they are worked out when this is called.
        """
        table = spec(name)
        none = "partition_value string, row_count long, min_date date, max_date date, files long, file_size_bytes long, file_mtime timestamp"
        if not self.exists(name):
            return self.spark.createDataFrame([], none)
        value = f"CAST({table.partition} AS STRING)" if table.partition else "CAST(NULL AS STRING)"
        with self._footers():
            told = self._pushed(name)
            counted = told.select(F.expr(value).alias("partition_value"), "row_count", *[F.col(c) if table.date_column else F.lit(None).cast("date").alias(c) for c in ("min_date", "max_date")])
            # a row a partition, as many as files that the driver has listed anyway
            rows = [] if table.partition and self.groups else counted.collect()
        if table.partition and self.groups:
            return self._shared_statistics(name, counted)
        counted = self.spark.createDataFrame(rows, "partition_value string, row_count long, min_date date, max_date date")
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.path(name))
        escaped = F.regexp_extract("path", f"/{table.partition}=([^/]+)/", 1) if table.partition else F.lit(None).cast("string")
        listed = files.groupBy(F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B"))).alias("of")).agg(F.count("*").alias("files"), F.sum("length").alias("file_size_bytes"), F.max("modificationTime").alias("file_mtime"))
        return counted.join(listed, F.col("of").eqNullSafe(F.col("partition_value")), "left").drop("of")

    def _shared_statistics(self, name: str, counted: DataFrame) -> DataFrame:
        """Where partitions share files, a file counts for the least of its partitions, so that sums are right."""
        table = spec(name)
        rows = self.spark.read.schema(table.schema).parquet(self.path(name))
        told = rows.select(F.col(table.partition).cast("string").alias("of"), "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        files = told.groupBy("file_path").agg(F.min("of").alias("of"), F.max("file_size").alias("length"), F.max("file_modification_time").alias("at"))
        listed = files.groupBy("of").agg(F.count("*").alias("files"), F.sum("length").alias("file_size_bytes"), F.max("at").alias("file_mtime"))
        out = counted.join(listed, F.col("of").eqNullSafe(F.col("partition_value")), "left").drop("of")
        return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("files", "file_size_bytes")})

    def _pushed(self, name: str) -> DataFrame:
        """Counts and date bounds by partition in the form that the Parquet reader answers from footers."""
        table = spec(name)
        rows = self.spark.read.schema(table.schema).parquet(self.path(name))
        bounds = [F.min(table.date_column).alias("min_date"), F.max(table.date_column).alias("max_date")] if table.date_column and table.date_column != table.partition else []
        told = rows.groupBy(*([table.partition] if table.partition else [])).agg(F.count("*").alias("row_count"), *bounds)
        if table.date_column and not bounds:
            told = told.withColumns({c: F.col(table.partition) for c in ("min_date", "max_date")})
        return told

    @contextmanager
    def _footers(self) -> Iterator[None]:
        """Within the block Parquet is read by the reader that takes aggregates over."""
        names = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
        held = {k: self.spark.conf.get(k) for k in names}
        try:
            for k, v in names.items():
                self.spark.conf.set(k, v)
            yield
        finally:
            for k, v in held.items():
                self.spark.conf.set(k, v)

    def file_statistics(self, name: str) -> DataFrame:
        """One row: files, bytes, rows, first and last date and latest change, from footers and the listing of files."""
        parts = self.partition_statistics(name)
        return parts.agg(F.sum("files").alias("files"), F.sum("row_count").alias("row_count"), F.sum("file_size_bytes").alias("file_size_bytes"), F.max("file_mtime").alias("file_mtime"), F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))

    def inventory(self, names: list[str] | None = None) -> DataFrame:
        """A row a table: ``dataset``, ``partitions``, ``latest_partition`` and its file statistics; absent tables have zeros."""
        out = None
        for name in names or list(SPECS):
            parts = self.partition_statistics(name)
            row = parts.agg(
                F.count_distinct("partition_value").alias("partitions"), F.max("partition_value").alias("latest_partition"), F.coalesce(F.sum("row_count"), F.lit(0).cast("long")).alias("row_count"),
                F.coalesce(F.sum("files"), F.lit(0).cast("long")).alias("files"), F.coalesce(F.sum("file_size_bytes"), F.lit(0).cast("long")).alias("file_size_bytes"), F.max("file_mtime").alias("file_mtime"),
                F.min("min_date").cast("string").alias("min_date"), F.max("max_date").cast("string").alias("max_date"),
            ).select(F.lit(name).alias("dataset"), "*")
            out = row if out is None else out.unionByName(row)
        return out

    # --- writing

    def prepared(self, name: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        """``df`` in the declared shape; rows without a partition value, or of another than ``partition``, are an error."""
        table = spec(name)
        arrival = [F.col(ARRIVAL)] if ARRIVAL in df.columns else []
        df = with_fixed(conformed(df, table.schema, arrival), table.fixed)
        if table.partition:
            blank = F.col(table.partition).isNull() | (F.trim(F.col(table.partition).cast("string")) == "")
            if df.where(blank).take(1):
                raise QualityError(f"{name}: rows without {table.partition}")
            if partition is not None and df.where(F.col(table.partition).cast("string") != partition).take(1):
                raise QualityError(f"{name}: rows of another {table.partition} than {partition}")
        elif partition is not None:
            raise QualityError(f"{name} has no partition column")
        return df

    def _staged(self, df: DataFrame) -> tuple[DataFrame, str]:
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    @contextmanager
    def held(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` as it is now, in a staged table, for as long as the block lasts."""
        rows, path = self._staged(df)
        try:
            yield rows
        finally:
            self._delete(path)

    def _put(self, table: TableSpec, df: DataFrame) -> None:
        """Replace the partitions that ``df`` has rows of, or the whole table if it has no partition column."""
        if table.partition and self.groups:
            with ExitStack() as stack:
                if self.exists(table.name):
                    fresh = df.select(table.partition).distinct()
                    others = self._in_groups_of(table.name, fresh).join(fresh, table.partition, "left_anti").select(*df.columns)
                    df = df.unionByName(stack.enter_context(self.held(others)))
                self._grouped(table, df).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(table.name))
        elif table.partition:
            rows = df.repartition(F.col(table.partition)).sortWithinPartitions(table.partition, *table.keys)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(table.partition).parquet(self.path(table.name))
        else:
            df.sortWithinPartitions(*table.keys).write.mode("overwrite").parquet(self.path(table.name)) if table.keys else df.write.mode("overwrite").parquet(self.path(table.name))

    def _grouped(self, table: TableSpec, df: DataFrame) -> DataFrameWriter:
        """A folder is one task's, sorted by partition, so that a reader skips most of a file for a few of them."""
        rows = df.withColumn(GROUP, self._group(table.partition)).repartition(F.col(GROUP)).sortWithinPartitions(GROUP, table.partition, *table.keys)
        return rows.write.partitionBy(GROUP)

    def write(self, name: str, df: DataFrame, mode: str | None = None, skip_existing: bool = False, signatures: DataFrame | None = None) -> None:
        """``replace``, ``merge``, ``upsert`` or ``append``; the table's own mode if none is named.

        Hard rules are checked on what will be stored. ``skip_existing`` leaves partitions alone whose keys are all there.
        Rows of one key arrive in the order of :data:`ARRIVAL`, where ``df`` has it (see :func:`landed`): the last stands.
        ``signatures`` go into the ledger beside the partitions that were built from them.
        """
        table, mode = spec(name), mode or spec(name).mode
        arrival = ARRIVAL if ARRIVAL in df.columns else None
        df = self.prepared(name, df)
        if mode == "append":
            df = df.select(*table.schema.names)
            rows = checked(df, table)
            (self._grouped(table, rows) if table.partition and self.groups else rows.write).mode("append").parquet(self.path(name))
            if table.partition and self.keeps_ledger:
                self.enter_partitions(name, df.select(F.col(table.partition).cast("string").alias("partition_value")))
            return
        with ExitStack() as stack:
            if mode in ("merge", "upsert") and self.exists(name):
                if table.partition:
                    # what came is worked out once; of what is stored only its partitions are opened
                    df = stack.enter_context(self.held(df))
                    stored = self.read_partitions(name, df.select(F.col(table.partition).cast("string").alias("partition_value")))
                    if skip_existing:
                        df = new_partitions_only(stored, df, list(table.keys), table.partition)
                else:
                    stored = self.read(name)
                df = keep_last(stored, df, list(table.keys), arrival)
            elif arrival is not None and table.keys:
                df = keep_last(df.limit(0), df, list(table.keys), arrival)
            df, seen = observed(df.select(*table.schema.names), table)
            staged, path = self._staged(df)
        try:
            judge(staged, table, seen)
            self._put(table, staged)
            if table.partition and self.keeps_ledger:
                self._enter(name, staged, signatures)
        finally:
            self._delete(path)
            self.spark.catalog.refreshByPath(self.path(name))

    def delete_partitions(self, name: str, values: list[str]) -> None:
        """Partitions and their rows of the ledger."""
        column = spec(name).partition
        if self.groups and values and self.exists(name):
            gone = self.spark.createDataFrame([(v,) for v in values], "value string").select(F.col("value").cast(spec(name).schema[column].dataType).alias(column))
            with self.held(self._in_groups_of(name, gone).join(gone, column, "left_anti").select(*spec(name).schema.names)) as others:
                left = {r[0] for r in others.select(self._group(column)).distinct().collect()}
                self._grouped(spec(name), others).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(name))
                for (g,) in gone.select(self._group(column)).distinct().collect():
                    if g not in left:
                        self._delete(f"{self.path(name)}/{GROUP}={g}")
        elif not self.groups:
            for v in values:
                self._delete(f"{self.path(name)}/{column}={v}")
        if values and self.keeps_ledger:
            held = self.read(LEDGER)
            self.write(LEDGER, held.where(~((F.col("dataset") == name) & F.col("partition_value").isin(values))), "replace")
        self.spark.catalog.refreshByPath(self.path(name))

    def rebuild(self, name: str, df: DataFrame, signatures: DataFrame | None = None) -> None:
        """Write a whole new table aside, check it, and swap it in; the old one stays until the new one stands."""
        table = spec(name)
        df, seen = observed(self.prepared(name, df).select(*table.schema.names), table)
        fresh = self._fresh(table, df)
        judge(self.spark.read.schema(table.schema).parquet(fresh).select(*table.schema.names), table, seen)
        self._swap(fresh, name)
        if table.partition and self.keeps_ledger:
            self._enter(name, self.read(name), signatures, whole=True)

    def migrate(self, name: str, source: str, renamed: dict[str, str], values: dict[str, dict[str, str]] | None = None, constants: dict[str, str] | None = None) -> int:
        """A tree of an earlier naming, below ``source``, as this table; returns its rows.

        Columns are renamed, old values mapped and constants added, the whole is written aside, and what was written is
        read back: only if it has as many rows as the source, and says what the migrated rows say by their hashes, is it
        swapped in; otherwise :class:`MigrationError`, and nothing changes. The source is left alone.
        """
        table = spec(name)
        old = self.spark.read.parquet(source)
        rows = self.prepared(name, migrated(old, renamed, values, constants)).select(*table.schema.names)
        fresh = self._fresh(table, rows)
        stored = self.spark.read.schema(table.schema).parquet(fresh).select(*table.schema.names)
        told = [df.agg(F.count("*").alias("rows"), content_hash(table.schema.names).alias("hash")).first() for df in (rows, stored)]
        if told[0] != told[1] or told[0]["rows"] != old.count():
            self._delete(fresh)
            raise MigrationError(f"{name}: {told[1]['rows']} rows were written of {told[0]['rows']}, or they differ")
        judge(stored, table, observed_by_reading(stored, table))
        self._swap(fresh, name)
        if table.partition and self.keeps_ledger:
            self._enter(name, self.read(name), whole=True)
        return told[1]["rows"]

    def _fresh(self, table: TableSpec, rows: DataFrame) -> str:
        """``rows`` written aside, laid out as the table is: a partition is one task's, or tasks times partitions would be as many small files."""
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        if table.partition and self.groups:
            self._grouped(table, rows).parquet(path)
        elif table.partition:
            rows.repartition(F.col(table.partition)).sortWithinPartitions(table.partition, *table.keys).write.partitionBy(table.partition).parquet(path)
        else:
            (rows.sortWithinPartitions(*table.keys) if table.keys else rows).write.parquet(path)
        return path

    def _swap(self, fresh: str, name: str) -> None:
        old, held = f"{self.root}/_staging/{uuid.uuid4().hex}", self.exists(name)
        if held:
            self._rename(self.path(name), old)
        try:
            self._rename(fresh, self.path(name))
        except OSError:
            if held:
                self._rename(old, self.path(name))
            raise
        self._delete(old)
        self.spark.catalog.refreshByPath(self.path(name))

    # --- ledger and run metadata

    def _enter(self, name: str, rows: DataFrame, signatures: DataFrame | None = None, whole: bool = False) -> None:
        """Ledger rows for the partitions that ``rows`` are all of; with ``whole`` the table has no others."""
        manifest = spec(LEDGER)
        entries = ledger(rows, spec(name)).withColumn("output_path", F.lit(self.path(name)))
        if signatures is not None:
            entries = entries.join(signatures.select("partition_value", "source_signature", "master_row_hash"), "partition_value", "left")
        entries = conformed(entries.withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz")), manifest.schema)
        if not whole:
            self.write(LEDGER, entries, "upsert")
        else:
            self.write(LEDGER, self.read(LEDGER).where(F.col("dataset") != name).unionByName(entries), "replace")

    def enter_partitions(self, name: str, values: DataFrame) -> None:
        """Read the partitions in ``values`` and enter them into the ledger, without signatures."""
        self._enter(name, self.read_partitions(name, values))

    def entered(self, pairs: DataFrame) -> DataFrame:
        """Ledger rows of the (``dataset``, ``partition_value``) pairs; those that it lacks are read and entered first.

        A pair that storage has no rows of either is a :class:`LedgerError`.
        """
        asked = pairs.select("dataset", "partition_value").distinct()
        missing = missing_partitions(asked, self.read(LEDGER))
        lacking = sorted(missing.select("dataset").distinct().collect())  # a row a declared table
        for (name,) in lacking:
            self.enter_partitions(name, missing.where(F.col("dataset") == name))
        still = missing_partitions(asked, self.read(LEDGER)).orderBy("dataset", "partition_value").take(5) if lacking else []
        if still:
            raise LedgerError("not in the ledger and without rows: " + ", ".join(f"{r['dataset']}/{r['partition_value']}" for r in still))
        return self.read(LEDGER).join(asked, ["dataset", "partition_value"], "left_semi")

    def update_ledger(self, name: str, only_missing: bool = False) -> None:
        """Ledger rows of a table: all anew (what they were built from stays), or those that the ledger lacks.

        Partitions that are gone leave the ledger; with ``only_missing`` no others than the missing ones are read.
        """
        table = spec(name)
        held = self.read(LEDGER).where(F.col("dataset") == name)
        if not table.partition:
            self._enter(name, self.read(name), held.select("partition_value", "source_signature", "master_row_hash"), whole=True)
            return
        present = self.partition_names(name)
        gone = held.join(present, "partition_value", "left_anti").select("dataset", "partition_value")
        if gone.take(1):
            self.write(LEDGER, self.read(LEDGER).join(gone, ["dataset", "partition_value"], "left_anti"), "replace")
        if only_missing:
            self.enter_partitions(name, present.join(held.select("partition_value"), "partition_value", "left_anti"))
        else:
            self._enter(name, self.read(name), held.select("partition_value", "source_signature", "master_row_hash"), whole=True)

    def rebuild_ledger(self, names: list[str] | None = None, force: bool = False) -> None:
        for name in names or [n for n, s in SPECS.items() if s.family not in ("metadata",) and self.exists(n)]:
            self.update_ledger(name, only_missing=not force)

    def record(self, runs: DataFrame | None = None, status: DataFrame | None = None, checkpoints: DataFrame | None = None) -> None:
        """Run metadata of a batch: runs are appended, the last status and checkpoint of each key stand."""
        if runs is not None:
            self.write("pipeline_runs", runs, "append")
        for name, rows in (("dataset_update_status", status), ("pipeline_checkpoints", checkpoints)):
            if rows is not None:
                table = spec(name)
                latest = latest_per_key(conformed(rows, table.schema), list(table.keys), ["updated_at"])
                self.write(name, latest, "upsert")

    def copy_metadata(self, source: Lake) -> None:
        """Metadata of another lake: runs that are not here yet, the rest by key."""
        runs = source.read("pipeline_runs").join(self.read("pipeline_runs").select("task_id"), "task_id", "left_anti")
        self.record(runs, source.read("dataset_update_status"), source.read("pipeline_checkpoints"))
        self.write("dataset_partition_manifest", source.read("dataset_partition_manifest"), "upsert")

    def drop_legacy(self, name: str, prefixes: tuple[str, ...]) -> None:
        """Delete partition folders of an earlier layout."""
        fs, path = self._fs(self.path(name))
        if fs.exists(path):
            for status in fs.listStatus(path):
                if status.getPath().getName().startswith(prefixes):
                    fs.delete(status.getPath(), True)


def landed(spark: SparkSession, path: str, kind: str = "parquet", schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    """Extracts as they landed, with :data:`ARRIVAL`: files in the order of their paths, rows in that of their file.

    Files are named so that later ones sort later (a folder a day, or numbered). The order holds however files are cut
    into tasks: Parquet tells a row's place in its file; of other kinds it is the block's and the order within it.
    """
    reader = spark.read.format(kind).options(**options)
    rows = (reader.schema(schema) if schema is not None else reader).load(path)
    place = F.col("_metadata.row_index") if kind == "parquet" else F.monotonically_increasing_id()
    start = F.lit(0).cast("long") if kind == "parquet" else F.col("_metadata.file_block_start")
    return rows.select("*", F.struct(F.col("_metadata.file_path").alias("file"), start.alias("block"), place.alias("row")).alias(ARRIVAL))


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], spec(name).schema)


def append_event(spark: SparkSession, path: str, name: str, rows: DataFrame, event_id: int | None = None) -> None:
    """A line in the event log for a write: id (the next one, if none is given), table, rows, and the dates it spans."""
    table = spec(name)
    if event_id is None:
        try:
            last = spark.read.schema(EVENT_SCHEMA).json(path).agg(F.max("event_id")).first()[0]
        except AnalysisException:  # no log yet
            last = None
        event_id = (last or 0) + 1
    day = F.col(table.date_column).cast("string") if table.date_column else F.lit(None).cast("string")
    event = rows.agg(F.count("*").alias("row_count"), F.min(day).alias("min_date"), F.max(day).alias("max_date"))
    event.select(F.lit(event_id).cast("long").alias("event_id"), F.lit(name).alias("dataset"), "*").write.mode("append").json(path)


EVENT_SCHEMA = columns("long: event_id; string: dataset; long: row_count; string: min_date max_date")


def read_events(spark: SparkSession, path: str, since: int = 0, limit: int = 1000) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).json(path).where(F.col("event_id") > since).select(*EVENT_SCHEMA.names).orderBy("event_id").limit(limit)
