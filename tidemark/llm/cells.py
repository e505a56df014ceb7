"""Pairs inside groups of rows, without emitting the pairs.

Rows are grouped by a key into cells of bounded size. A group of more than ``block`` rows is split into blocks, and
each pair of blocks is a cell of its own, so that no task ever holds more than two blocks of one group. What a cell
finds leaves it as a spanning forest: at most one edge a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_cells(df: DataFrame, size: Column, block: int, by: Column) -> DataFrame:
    """Add ``cell``: 0 for groups of at most ``block`` rows, else one row for each pair of blocks that holds it."""
    blocks = F.ceil(size / F.lit(block)).cast("long")
    own = F.pmod(F.xxhash64(by), blocks)
    other = F.explode(
        F.when(size <= block, F.array(F.lit(0).cast("long"))).otherwise(
            F.transform(
                F.filter(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: j != own),
                lambda j: F.least(own, j) * blocks + F.greatest(own, j),
            )
        )
    )
    return df.withColumn("cell", other)


def grouped_batches(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, for input sorted by ``keys`` (not null); with each row's group number."""

    def numbered(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            x = table[k].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.cumsum(new)

    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            group = numbered(table)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield table.slice(0, cut), group[:cut]
            held = table.slice(cut).combine_chunks().to_batches()
            n = table.num_rows - cut
    if n:
        table = pa.Table.from_batches(held)
        yield table, numbered(table)


def near_pairs(group: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of rows with the same number in the sorted array ``group``."""
    d = 1
    while True:
        i = np.flatnonzero(group[d:] == group[:-d]) if d < len(group) else np.zeros(0, np.int64)
        if not len(i):
            return
        for lo in range(0, len(i), most):
            yield i[lo : lo + most], i[lo : lo + most] + d
        d += 1


class Forest:
    """Labels of rows under links that come in batches; a label is the smallest row number linked."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while len(i):
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up

    def edges(self) -> np.ndarray:
        return np.flatnonzero(self.label != np.arange(len(self.label)))
