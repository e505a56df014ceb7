"""Intermediate tables in the folder that the driver and all executors share.

Lineage is cut by writing a table there and reading it back: an executor that is lost later takes nothing along.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where a local session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = spark.sparkContext.applicationId
    if key not in _local:
        _local[key] = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    return _local[key]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.tidemark_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table that :func:`written` made and that nothing reads any more."""
    remove(df.sparkSession, df.tidemark_path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_1``, ``name_2``, ... that no column of ``df`` has (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(1, len(taken) + 2))) if n.lower() not in taken)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)
