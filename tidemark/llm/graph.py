"""Connected components by contraction inside tasks, joins and exchanges, with lineage cut each round."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import tidy
from .cells import Forest, grouped_batches
from .storage import dropped, written

#: Edges that a task contracts at a time.
EDGES = 1 << 18
_EDGE = "u long, v long, moved boolean"


def _stars(u: np.ndarray, v: np.ndarray, moved: bool) -> pa.RecordBatch:
    """Each node of the edges linked with the smallest one that these edges reach; ``moved`` also where a node gets an edge that had none as ``u``."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    forest = Forest(len(nodes))
    forest.link(at[: len(u)], at[len(u) :])
    edges = forest.edges()
    moved = moved or len(edges) > len(np.unique(u))
    return pa.RecordBatch.from_arrays([pa.array(nodes[edges]), pa.array(nodes[forest.label[edges]]), pa.array(np.full(len(edges), moved))], ["u", "v", "moved"])


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= EDGES:
            yield _stars_of(pa.Table.from_batches(held))
            held, n = [], 0
    if n:
        yield _stars_of(pa.Table.from_batches(held))


def contracted(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``f``, whose batches are edges ``u``, ``v``, with these contracted in the same task; loops go.

    For ``connected_components(..., already=True)``: contracted by a second ``mapInArrow`` in the stage of ``f``, they would
    take a second Python worker for each of its tasks, and Spark keeps these as large as any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (pa.RecordBatch.from_arrays([b["u"], b["v"], pa.array(np.zeros(b.num_rows, bool))], ["u", "v", "moved"]) for b in f(batches))
        for stars in _contracted(edges):
            yield stars.select(["u", "v"])

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As :func:`_contracted`, for edges sorted by ``u``: all of a node's edges meet."""
    for table, _ in grouped_batches(batches, ["u"], EDGES):
        yield _stars_of(table)


def _stars_of(table: pa.Table) -> pa.RecordBatch:
    return _stars(table["u"].to_numpy(), table["v"].to_numpy(), bool(np.any(table["moved"].to_numpy())))


def _small_stars(edges: DataFrame, already: bool = False) -> DataFrame:
    """A node's smaller neighbours linked with the least of them. Before the exchange a task leaves a row a node (``already``: it has), so no node has more rows than there are tasks."""
    few = edges if already else edges.mapInArrow(tidy(_contracted), _EDGE)
    return few.repartition("u").sortWithinPartitions("u").mapInArrow(tidy(_met), _EDGE)


def connected_components(edges: DataFrame, label: str = "components", already: bool = False) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for each node in ``edges`` (``u``, ``v``, both long).

    Alternates large stars and small stars: a node links its larger neighbours, then its smaller ones, to the least
    it knows. A large star is a join with the least neighbours, a small star one exchange between two contractions
    inside tasks; only the edges of the round are kept, as a table in the shared folder. A hub that holds most rows is a
    skewed key of the join, which adaptive execution splits. Rounds grow as the logarithm of a component's diameter
    squared; the last is one that moves nothing. ``already``: each task that makes edges has :func:`contracted` them. Edges with a null end and loops are ignored; no edges give an empty table.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), F.lit(False).alias("moved"))
    edges = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    now = written(_small_stars(edges, already), label)
    while True:
        least = now.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = now.select("u", "v").join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moved"))
        after = written(_small_stars(large), label)
        dropped(now)
        now = after
        if not now.agg(F.max("moved")).first()[0]:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
