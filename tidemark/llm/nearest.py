"""Nearest neighbours by inner product through an inverted multi-index.

The halves of the vectors are quantised separately, so ``K`` centroids a half make ``K * K`` cells. A query walks the
pairs of centroids by their summed distance, nearest first, with a heap (a pair is pushed when the pair before it is
taken), until the cells hold enough rows; these rows are then ranked by their inner products on the original vectors.

Inner products aren't distances: each half gets one more component that brings all its rows to one length, and a query
has 0 there. The squared distance of query and row is then a constant less twice their inner product, half by half.

How many rows are enough is measured, not guessed: ``PROBES`` sampled vectors are compared with every row, and the walk
goes as far as finds ``RECALL`` of their nearest. Vectors without structure make that a large share of all rows; the
index then saves little, but it loses no more than planned.

Rows of the index lie in shelves, each a set of first-half centroids, or a part of one where it holds too many rows. A
query goes once to each shelf that its walk touches, with a bit for each (first, second) pair to be ranked there, so
what is sent grows with shelves, not with cells. Equal vectors are one row that carries its ``k + 1`` least ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cells import grouped_batches
from .embedding_dedup import _valid
from .storage import written

NEAREST = 20
#: Vectors that the centroids are fitted on, at most; all are indexed.
FIT_ROWS = 20_000
ITERATIONS = 12
#: Rows a cell should hold on average, and the bound on centroids a half (so that the table of cell sizes is bounded).
CELL_ROWS, MOST_CENTROIDS = 64, 256
#: Sampled queries that are compared with every row, and the share of their nearest that the walk has to reach.
PROBES, RECALL = 64, 0.96
#: Bytes of vectors a shelf may hold, and into how many shelves even a small index is dealt.
SHELF_BYTES, SHELVES = 16 << 20, 16
#: Queries that one task compares with a shelf; beyond that the shelf is sent again.
TASK_QUERIES = 1 << 16
#: Scores that are held at once.
SCORES = 1 << 22


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row; one that overflows both ways counts as the least."""
    with np.errstate(all="ignore"):
        s = np.einsum("nd,nd->n", q, x)
    return np.where(np.isnan(s), -np.inf, s)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


def _padded(x: np.ndarray, length: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(length**2 - np.einsum("nd,nd->n", x, x), 0))[:, None]], axis=1)


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances but for each row's own constant."""
    return np.einsum("kd,kd->k", centroids, centroids) - 2 * (x @ centroids.T)


class MultiIndex:
    """Centroids of both halves; the vectors are scaled by one factor, so that no square overflows."""

    def __init__(self, sample: np.ndarray, k: int, seed: int = 11):
        self.scale = 1 / max(np.abs(sample).max(initial=0.0), 1e-300)
        self.lengths, self.centroids = [], []
        for half in _halves(self._scaled(sample)):
            length = float(np.sqrt(np.einsum("nd,nd->n", half, half).max(initial=0.0)))
            self.lengths.append(length)
            self.centroids.append(_clustered(_padded(half, length), k, seed))

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x * self.scale, -1e100, 1e100)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the nearest centroids of either half."""
        both = zip(_halves(self._scaled(x)), self.lengths, self.centroids, strict=True)
        first, second = (_squares(_padded(h, length), c).argmin(axis=1) for h, length, c in both)
        return first, second

    def distances(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each query's halves to all centroids of that half."""
        both = zip(_halves(self._scaled(queries)), self.centroids, strict=True)
        first, second = (_squares(np.concatenate([h, np.zeros((len(h), 1))], axis=1), c) for h, c in both)
        return first, second


def _clustered(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct rows of the sample."""
    rows = np.unique(x, axis=0)
    centroids = rows[np.random.default_rng(seed).permutation(len(rows))[:k]].copy()
    for _ in range(ITERATIONS):
        nearest = _squares(x, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        n = np.bincount(nearest, minlength=len(centroids))
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return centroids


def walk(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of positions by their sum, least first (ties to the smaller positions)."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(x[0] + y[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


def reached(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> np.ndarray:
    """Which cells the walk of one query takes until they hold ``enough`` rows."""
    taken = np.zeros(sizes.shape, bool)
    rows = 0
    for i, j in walk(first, second):
        taken[i, j] = True
        rows += sizes[i, j]
        if rows >= enough:
            break
    return taken


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """``rep``, ``variant``, ``embedding``, ``ids``: each distinct vector with its ``k + 1`` least ids, sorted.

    ``rep`` is the least of them, and ``variant`` tells apart vectors that share it (0 where ids are unique). Ranks are cut per input partition before rows are exchanged, so a vector of any frequency sends few rows.
    """
    least = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("n", F.dense_rank().over(least)).where(F.col("n") <= k + 1)
    return few.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "embedding", "ids").withColumn("variant", F.row_number().over(Window.partitionBy("rep").orderBy("embedding")).cast("long") - 1)


def _measured(groups: DataFrame, index: MultiIndex, probes: np.ndarray, sizes: np.ndarray, k: int) -> int:
    """Rows that a walk has to see for ``RECALL`` of the probes' nearest, by comparing the probes with every row."""
    dim = probes.shape[1]
    shared = groups.sparkSession.sparkContext.broadcast((index, probes))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, probes = shared.value
        held = [np.zeros((len(probes), 0)), *(np.zeros((len(probes), 0), np.int64) for _ in range(3))]
        for batch in batches:
            x = _matrix(batch["embedding"], dim)
            with np.errstate(all="ignore"):
                scores = np.nan_to_num(probes @ x.T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            others = (np.broadcast_to(v, scores.shape) for v in (batch["rep"].to_numpy(), *index.cells(x)))
            held = [np.concatenate([a, b], axis=1) for a, b in zip(held, (scores, *others), strict=True)]
            # the probe itself is one of the rows: one more than k
            top = np.argsort(-held[0], axis=1, kind="stable")[:, : k + 1]
            held = [np.take_along_axis(a, top, axis=1) for a in held]
        probe = np.repeat(np.arange(len(probes)), held[0].shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(probe), *(pa.array(a.ravel()) for a in held)], ["probe", "score", "rep", "first", "second"])

    found = groups.select("rep", "embedding").mapInArrow(best, "probe long, score double, rep long, first long, second long")
    order = Window.partitionBy("probe").orderBy(F.col("score").desc(), "rep")
    near = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).select("probe", "first", "second").toArrow()
    probe, i, j = (near[c].to_numpy() for c in ("probe", "first", "second"))
    first, second = index.distances(probes)
    needed = []
    for p in range(len(probes)):
        order_of = np.zeros(sizes.shape, np.int64)
        seen = 0
        for a, b in walk(first[p], second[p]):
            seen += int(sizes[a, b])
            order_of[a, b] = seen
        needed.append(order_of[i[probe == p], j[probe == p]])
    needed = np.sort(np.concatenate(needed))
    return int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))])


def _shelved(sizes: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """For each first-half centroid the shelf that it begins on and the number of shelves that it is spread over."""
    rows = sizes.sum(axis=1)
    most = max(1, min(SHELF_BYTES // (8 * dim), -(-int(rows.sum()) // SHELVES)))
    start, spread, shelf, held = np.zeros(len(rows), np.int64), np.ones(len(rows), np.int64), 0, 0
    for c, n in enumerate(rows.tolist()):
        if held and held + n > most:
            shelf, held = shelf + 1, 0
        start[c] = shelf
        if n > most:
            spread[c] = -(-n // most)
            shelf, held = shelf + int(spread[c]), 0
        else:
            held += n
    return start, spread


def _ranked(dim: int, width: int, k: int):
    """Ranks the queries of each (shelf, part) against its rows; rows come first (``query`` false), sorted by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, ()
        for table, group in grouped_batches(batches, ["shelf", "part", "query"], 1):
            shelf, part, query = (table[c].to_numpy() for c in ("shelf", "part", "query"))
            for lo in np.unique(group, return_index=True)[1].tolist():
                hi = int(np.searchsorted(group, group[lo], "right"))
                here = (int(shelf[lo]), int(part[lo]))
                piece = table.slice(lo, hi - lo)
                if not query[lo]:
                    key, rows = here, (_matrix(piece["embedding"], dim), *(piece[c].to_numpy() for c in ("first", "second", "rep", "variant")))
                elif key == here:
                    yield from _compared(piece, *rows, dim, width, k)

    return run


def _compared(queries: pa.Table, x: np.ndarray, first: np.ndarray, second: np.ndarray, reps: np.ndarray, variants: np.ndarray, dim: int, width: int, k: int) -> Iterator[pa.RecordBatch]:
    edges = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]), True])
    longest = np.sqrt(np.einsum("nd,nd->n", np.clip(x, -1e150, 1e150), np.clip(x, -1e150, 1e150)).max(initial=0.0))
    step = max(1, SCORES // len(x))
    for at in range(0, queries.num_rows, step):
        piece = queries.slice(at, step).combine_chunks()
        q, who, which = _matrix(piece["embedding"], dim), piece["rep"].to_numpy(), piece["variant"].to_numpy()
        lowest = piece["lowest"][0].as_py()
        taken = np.frombuffer(b"".join(piece["taken"].to_pylist()), np.uint8).reshape(len(q), -1, width)
        scores = np.full((len(q), len(x)), -np.inf)
        seen = np.zeros((len(q), len(x)), bool)
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            bit = taken[:, first[lo] - lowest, second[lo] >> 3] >> (7 - (second[lo] & 7)) & 1
            some = np.flatnonzero(bit)
            if len(some):
                with np.errstate(all="ignore"):
                    scores[some, lo:hi] = q[some] @ x[lo:hi].T
                seen[some, lo:hi] = True
        scores[np.isnan(scores)] = -np.inf
        # the best by fast products, with room for their rounding; these are then multiplied one by one
        room = 4 * dim * np.finfo(float).eps * longest * np.sqrt(np.einsum("nd,nd->n", np.clip(q, -1e150, 1e150), np.clip(q, -1e150, 1e150)))
        least = np.partition(scores, max(0, len(x) - k - 1), axis=1)[:, max(0, len(x) - k - 1)] if len(x) > k + 1 else np.full(len(q), -np.inf)
        i, j = np.nonzero(seen & ((scores >= (least - np.nan_to_num(room, nan=np.inf))[:, None]) | (scores == np.inf)))
        exact = np.concatenate([_products(q[i[lo : lo + SCORES // dim]], x[j[lo : lo + SCORES // dim]]) for lo in range(0, len(i), SCORES // dim)]) if len(i) else np.zeros(0)
        order = np.lexsort((variants[j], reps[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        i, j, exact = (a[rank < k + 1] for a in (i, j, exact))
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (who[i], which[i], reps[j], variants[j], exact)], ["query", "query_variant", "rep", "variant", "score"])


def _of_dimension(groups: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """``query``, ``query_variant``, ``rep``, ``variant``, ``score``: for each distinct query vector at least its ``k + 1`` best distinct rows found."""
    spark = groups.sparkSession
    n = groups.count()
    fit = groups.select("embedding").orderBy(F.xxhash64("embedding")).limit(FIT_ROWS).toArrow()
    sample = _matrix(fit["embedding"], dim)
    index = MultiIndex(sample, int(min(MOST_CENTROIDS, max(4, (n / CELL_ROWS) ** 0.5))))
    centroids = max(len(c) for c in index.centroids)
    shared = spark.sparkContext.broadcast(index)
    kind = groups.schema["embedding"].dataType.simpleString()

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = shared.value.cells(_matrix(batch["embedding"], dim)) if batch.num_rows else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([batch["rep"], batch["variant"], batch["embedding"], pa.array(first), pa.array(second)], ["rep", "variant", "embedding", "first", "second"])

    rows = groups.select("rep", "variant", "embedding").mapInArrow(celled, f"rep long, variant long, embedding {kind}, first long, second long")
    # at most MOST_CENTROIDS ** 2 rows, whatever the input
    counted = rows.groupBy("first", "second").agg(F.count("*").alias("n")).toArrow()
    sizes = np.zeros((centroids, centroids), np.int64)
    sizes[counted["first"].to_numpy(), counted["second"].to_numpy()] = counted["n"].to_numpy()
    enough = max(_measured(groups, index, sample[:PROBES], sizes, k), k + 1)
    start, spread = _shelved(sizes, dim)
    plan = spark.sparkContext.broadcast((sizes, enough, start, spread))

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, enough, start, spread = plan.value
        # centroids of one shelf follow each other
        edges = np.flatnonzero(np.r_[True, start[1:] != start[:-1], True])
        for batch in (b.slice(lo, 512) for b in batches for lo in range(0, b.num_rows, 512)):
            first, second = shared.value.distances(_matrix(batch["embedding"], dim))
            who, where, lowest, bits = [], [], [], []
            for r in range(batch.num_rows):
                taken = reached(first[r], second[r], sizes, enough)
                packed = np.packbits(taken, axis=1)
                used = (taken & (sizes > 0)).any(axis=1)
                for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    if used[lo:hi].any():
                        for s in range(int(start[lo]), int(start[lo] + spread[lo])):
                            who.append(r)
                            where.append(s)
                            lowest.append(lo)
                            bits.append(packed[lo:hi].tobytes())
            row = pa.array(who, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int64()), pa.array(lowest, pa.int64()), *(batch[c].take(row) for c in ("rep", "variant", "embedding")), pa.array(bits, pa.binary())],
                ["shelf", "lowest", "rep", "variant", "embedding", "taken"],
            )

    posts = written(queries.mapInArrow(posted, f"shelf long, lowest long, rep long, variant long, embedding {kind}, taken binary"), "nearest-posts")
    # one row a shelf: shelves are at most centroids and what full shelves need
    parts = posts.groupBy("shelf").agg(F.ceil(F.count("*") / F.lit(TASK_QUERIES)).cast("long").alias("parts"))
    none = F.lit(None)
    begin = F.array(*[F.lit(int(s)) for s in start])[F.col("first").cast("int")]
    wide = F.array(*[F.lit(int(s)) for s in spread])[F.col("first").cast("int")]
    shelf = (begin + F.pmod(F.xxhash64("rep"), wide)).cast("long")
    stocked = rows.withColumn("shelf", shelf).join(parts, "shelf").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    stocked = stocked.select("shelf", "part", F.lit(False).alias("query"), "first", "second", "rep", "variant", "embedding", none.cast("long").alias("lowest"), none.cast("binary").alias("taken"))
    asked = posts.join(parts, "shelf").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
    asked = asked.select("shelf", "part", F.lit(True).alias("query"), none.cast("long").alias("first"), none.cast("long").alias("second"), "rep", "variant", "embedding", "lowest", "taken")
    both = stocked.unionByName(asked).repartition("shelf", "part").sortWithinPartitions("shelf", "part", "query", "first", "second", "rep")
    return both.mapInArrow(_ranked(dim, -(-centroids // 8), k), "query long, query_variant long, rep long, variant long, score double")


def _query_rows(rows: DataFrame, groups: DataFrame, is_query: Column) -> DataFrame:
    """``query_id``, ``rep`` and ``variant`` of each distinct (id, vector) asked for."""
    asked = rows.where(is_query).distinct().withColumnRenamed("vec_id", "query_id")
    return asked.join(groups.select("rep", "variant", "embedding"), "embedding").select("query_id", "rep", "variant")


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` rows with the largest inner products found for each query.

    ``vectors`` has ``vec_id`` (long) and ``embedding`` (array of numbers); ``is_query`` tells the queries by ``vec_id``.
    Scores are inner products in double precision of the original vectors; ties go to the smaller vec_id. Vectors that are
    null, empty, zero or hold null or non-finite components take no part, nor do rows without a vec_id; vectors of
    another length aren't compared. Rows that are equal in id and vector are one; a row is no candidate of a query with
    its id, and where an id has several vectors, each has a ranking, shorter by as many. A product that overflows is infinite. Queries with fewer candidates than ``k`` found have fewer rows; where
    there are at most ``k``, all are found. No vectors give no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    # float32 components are sent as such: every one of them is the same number in double precision
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("embedding")).where(_valid("embedding") & F.col("vec_id").isNotNull())
    rows = rows.select("vec_id", F.transform("embedding", lambda v: v + F.lit(0.0).cast(kind)).alias("embedding"))
    groups = written(_distinct(rows, k), "nearest-vectors")
    asked = written(_query_rows(rows, groups, is_query), "nearest-queries")
    wanted = groups.join(asked.select("rep", "variant").distinct(), ["rep", "variant"], "left_semi").select("rep", "variant", "embedding")
    found = None
    for (dim,) in sorted(groups.select(F.size("embedding")).distinct().collect()):
        here = F.size("embedding") == dim
        part = _of_dimension(groups.where(here), wanted.where(here), dim, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    of = ["query", "query_variant"]
    best = Window.partitionBy(*of).orderBy(F.col("score").desc(), "rep", "variant")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    found = found.join(groups.select("rep", "variant", "ids"), ["rep", "variant"]).select(F.col("query").alias("rep"), F.col("query_variant").alias("variant"), F.explode("ids").alias("vec_id"), "score")
    pairs = asked.join(found, ["rep", "variant"]).where("query_id <> vec_id")
    order = Window.partitionBy("query_id", "rep", "variant").orderBy(F.col("score").desc(), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_nearest(spark, sf_dir: str) -> DataFrame:
    """The 20 rows of ``embeddings`` nearest to each whose vec_id is divisible by 20."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
