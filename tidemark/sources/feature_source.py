"""Binary feature series as a data source of their own: planned by file, with filters that choose files before any is opened.

``spark.read.format("feature_series").option("path", folder)`` gives ``symbol``, ``field``, ``idx``, ``value``, a row a
value. Files lie as ``<symbol>/<field>.day.bin`` below the folder, in any store that Arrow can list; equality and ``IN``
on symbol and field are taken over by the source. Registered and read by :func:`read_series`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from .binary_features import FILES

NAME = "feature_series"
SCHEMA = "symbol string, field string, idx long, value double"
#: Bytes of files that one task reads.
PART_BYTES = 64 << 20


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, str, str]]):
        self.files = files


class _Reader(DataSourceReader):
    def __init__(self, path: str, part_bytes: int):
        self.path, self.part_bytes = path, part_bytes
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or f.attribute not in (("symbol",), ("field",)):
                yield f  # Spark's own to apply
            else:
                name = f.attribute[0]
                self.wanted[name] = self.wanted.get(name, values) & values

    def _allows(self, name: str, value: str) -> bool:
        return name not in self.wanted or value in self.wanted[name]

    def partitions(self) -> list[InputPartition]:
        """Files that the filters leave, by name and size alone, packed to about ``part_bytes`` a task."""
        store, root = fs.FileSystem.from_uri(self.path)
        parts: list[InputPartition] = []
        files, held = [], 0
        for info in sorted(store.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            named = re.search(FILES, info.path)
            if info.type != fs.FileType.File or not named or not (self._allows("symbol", named[1]) and self._allows("field", named[2])):
                continue
            if files and held + info.size > self.part_bytes:
                parts.append(_Files(files))
                files, held = [], 0
            files.append((info.path, named[1], named[2]))
            held += info.size
        return [*parts, _Files(files)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        for path, symbol, field in partition.files:
            with store.open_input_stream(path) as stream:
                content = stream.read()
            if len(content) % 4:
                raise ValueError(f"the {field} series of {symbol} has {len(content)} bytes, no whole number of float32 values")
            data = np.frombuffer(content, "<f4")
            if len(data) > 1:
                value, n = data[1:].astype(np.float64), len(data) - 1
                yield pa.RecordBatch.from_arrays([pa.array([symbol] * n), pa.array([field] * n), pa.array(int(data[0]) + np.arange(n)), pa.array(value, from_pandas=True)], ["symbol", "field", "idx", "value"])


class FeatureSeries(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("part_bytes", PART_BYTES)))


def read_series(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """The series below ``path`` (a URI); filters on the result's symbol and field choose the files."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeatureSeries)
    return spark.read.format(NAME).option("path", path).option("part_bytes", str(part_bytes)).load()


def write_series(series: DataFrame, path: str) -> int:
    """Series (``symbol``, ``field``, ``idx``, ``value``) as files below ``path``; gives the number of files.

    A file is one group's values from its least index on, absent ones NaN; a task that runs again writes the same file.
    """

    def put(rows: pa.Table) -> pa.Table:
        idx, value = rows["idx"].to_numpy(), rows["value"].to_numpy()
        data = np.full(idx.max() - idx.min() + 2, np.nan, "<f4")
        data[0] = idx.min()
        data[1 + idx - idx.min()] = value
        store, root = fs.FileSystem.from_uri(path)
        folder = f"{root}/{rows['symbol'][0].as_py()}"
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/{rows['field'][0].as_py()}.day.bin") as out:
            out.write(data.tobytes())
        return pa.table({"files": pa.array([1], pa.int64())})

    return series.groupBy("symbol", "field").applyInArrow(put, "files long").count()
