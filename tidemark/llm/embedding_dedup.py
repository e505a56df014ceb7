"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation of the (centred) vectors is learned so that signs make balanced binary codes with little quantisation
error. The code is cut into disjoint substrings, one hash table each; vectors that share a substring are compared by the original vectors
in double precision (a cut by Hamming distance before that would drop links whose centred angle is wide). The substrings
are as long as the number of vectors asks for (buckets stay near one size), and as many rotations are learned as make
the chance of missing a pair at the threshold's angle small.

Centring widens angles where the vectors share a direction: two at distance ``r`` from the centre and of cosine ``c``
are at ``acos(1 - (1 - c) / r**2)`` as seen from it. Tables are planned for these angles; the mean is the centre only
where that costs less than the origin, from which angles stay as they are. Partners of the sampled vectors at the
threshold's cosine then measure the misses of the fitted tables, and rotations are added until these are few enough.

Equal vectors fall together before anything is posted. Buckets are cut into blocks (:mod:`.cells`); a pair counts in
the first table where it meets, so links are counted without emitting pairs: a cell returns a count a vector and a
spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import Forest, grouped_batches, near_pairs, with_cells
from .graph import connected_components
from .storage import written

THRESHOLD = 0.9
BITS = 64
#: Vectors that the rotation is fitted on, at most; all vectors are indexed.
FIT_ROWS = 20_000
ITERATIONS = 40
#: Vectors a bucket should hold on average.
BUCKET = 256
#: Chance of missing a pair at ``MISS_COSINE`` in all tables together.
MISS = 1e-3
MISS_COSINE = THRESHOLD
#: Sampled vectors whose angles to others tell how full the buckets are.
OTHERS = 2000
#: Bytes of postings that are made at once.
POST_BYTES = 64 << 20
BLOCK = 1024


def partner_angles(centred: np.ndarray, cosine: float = MISS_COSINE) -> np.ndarray:
    """Angle, seen from the centre, of each vector and one as far from the centre, at that cosine from the origin."""
    square = np.maximum(np.einsum("nd,nd->n", centred, centred), 1e-12)
    return np.arccos(np.clip(1 - (1 - cosine) / square, -1, 1))


def other_angles(centred: np.ndarray) -> np.ndarray:
    """Angles, seen from the centre, of pairs of any sampled vectors."""
    x = centred[:OTHERS] / np.maximum(np.linalg.norm(centred[:OTHERS], axis=1), 1e-12)[:, None]
    i, j = np.triu_indices(len(x), 1)
    return np.arccos(np.clip((x @ x.T)[i, j], -1, 1)) if len(i) else np.array([math.pi / 2])


def _planned(n: int, bits: int, wide: np.ndarray, others: np.ndarray) -> tuple[float, int, int]:
    """Cost in postings a vector, bits a substring and rotations of the cheapest plan that misses at most ``MISS``."""
    best = (math.inf, 1, 1)
    # angles as a histogram: a step is far less than what a bit tells
    at = (np.arange(512) + 0.5) * math.pi / 512
    steps = np.linspace(0, math.pi, 513)
    pairs = np.histogram(others, steps)[0] / len(others)
    wide, counts = np.unique(np.ceil(np.asarray(wide) * 512 / math.pi) * math.pi / 512, return_counts=True)
    for width in range(1, max(1, min(bits, max(8, math.ceil(math.log2(max(n, 2) / BUCKET))))) + 1):
        agree, per = np.maximum(1 - wide / math.pi, 0) ** width, bits // width
        bucket = n * float(((1 - at / math.pi) ** width) @ pairs)

        def missed(rotations: int, agree=agree, per=per) -> float:
            return float(((1 - agree) ** (rotations * per)) @ counts) / counts.sum()

        most = 1
        while missed(most) > MISS and most < 1 << 12:
            most *= 2
        if missed(most) > MISS:
            continue
        low = most // 2 + 1
        while low < most:
            half = (low + most) // 2
            low, most = (low, half) if missed(half) <= MISS else (half + 1, most)
        best = min(best, (most * per * (1 + bucket / BUCKET), width, most))
    return best


def plan_tables(n: int, bits: int) -> tuple[int, int]:
    """Bits a substring and number of rotations for ``n`` vectors without a common direction."""
    return _planned(n, bits, np.array([math.acos(MISS_COSINE)]), np.array([math.pi / 2]))[1:]


def _turned(v: np.ndarray, seed: int) -> np.ndarray:
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(v.shape[1],) * 2))
    for _ in range(ITERATIONS):
        codes = np.where(v @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(codes.T @ v)
        turn = right.T @ left.T
    return turn


def fit_tables(sample: np.ndarray, n: int, bits: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, int]:
    """Centre, projections of ``bits`` columns each (principal axes turned by iterative quantisation), bits a substring."""
    mean = sample.mean(axis=0)
    plans = []
    for centre in (mean, np.zeros_like(mean)):
        x = sample - centre
        cost, width, rotations = _planned(n, bits, partner_angles(x), other_angles(x))
        plans.append((cost, len(plans), centre, width, rotations))
    _, _, centre, width, rotations = min(plans, key=lambda p: p[:2])
    centred = sample - centre
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    # each vector's partner: as far from the centre, at the planned angle, in the direction of another vector
    away = np.roll(centred, 1, axis=0)
    length = np.linalg.norm(centred, axis=1)[:, None]
    unit = centred / np.maximum(length, 1e-12)
    away = away - np.einsum("nd,nd->n", away, unit)[:, None] * unit
    real = (length[:, 0] > 1e-9) & (np.linalg.norm(away, axis=1) > 1e-9)
    angle = partner_angles(centred)[:, None]
    partner = length * (np.cos(angle) * unit + np.sin(angle) * away / np.maximum(np.linalg.norm(away, axis=1), 1e-12)[:, None])
    v, w = centred @ axes, partner[real] @ axes
    per, turns, apart = bits // width, [], np.ones(int(real.sum()), bool)
    while len(turns) < rotations or (apart.mean() if len(apart) else 0) > MISS and len(turns) < 4 * rotations:
        turn = _turned(v, seed + len(turns))
        same = ((v[real] @ turn >= 0) == (w @ turn >= 0))[:, : per * width]
        apart &= ~same.reshape(-1, per, width).all(axis=2).any(axis=1)
        turns.append(axes @ turn)
    return centre, np.stack(turns), width


def _units(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of length one in double precision; the largest component goes first, so nothing overflows."""
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, initial=0.0)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _code_type(width: int) -> np.dtype:
    """The smallest type that holds a substring: postings carry the whole code."""
    return np.dtype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(t).itemsize * 8 >= width))


def _linked(dim: int, tables: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in grouped_batches(batches, ["table", "value", "cell"]):
            table = table.combine_chunks()
            ids, copies, own = table["rep"].to_numpy(), table["copies"].to_numpy(), table["table"].to_numpy()
            x = _units(table["embedding"].combine_chunks(), dim)
            # the whole codes: substrings of all tables, for the first table of a pair
            parts = np.frombuffer(b"".join(table["code"].to_pylist()), _code_type(width)).reshape(-1, tables)
            cell, blocks, me = table["cell"].to_numpy(), table["blocks"].to_numpy(), table["own"].to_numpy()
            forest, links = Forest(len(ids)), np.zeros(len(ids), np.int64)
            for i, j in near_pairs(group, max(1 << 10, min(1 << 16, (1 << 23) // (tables + dim)))):
                first = (parts[i] == parts[j]).argmax(axis=1) == own[i]
                # within one block a pair meets in every cell of the block: the first of them counts it
                home = (blocks[i] == 1) | (me[i] != me[j]) | (cell[i] == np.where(me[i] == 0, 1, me[i]))
                go = first & home
                i, j = i[go], j[go]
                near = np.einsum("nd,nd->n", x[i], x[j]) >= THRESHOLD
                i, j = i[near], j[near]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                forest.link(i, j)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[forest.label[some]]), pa.array(links[some])], ["u", "v", "links"])

    return run


def _valid(embedding: str):
    x = F.col(embedding)
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _of_dimension(vectors: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (``rep``, ``copies``, ``embedding``) and their links (``u``, ``v``, ``links``)."""
    spark = vectors.sparkSession
    n = vectors.count()
    bits = min(BITS, dim)
    fit = vectors.select("embedding").orderBy(F.xxhash64("embedding")).limit(FIT_ROWS).toArrow()
    centre, turns, width = fit_tables(_units(fit["embedding"].combine_chunks(), dim), n, bits)
    per, rotations = bits // width, len(turns)
    model = spark.sparkContext.broadcast((centre, turns))
    weights = np.uint64(1) << np.arange(width, dtype=np.uint64)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        centre, turns = model.value
        for batch in batches:
            if batch.num_rows:
                x = _units(batch["embedding"], dim)
                signs = np.concatenate([((x - centre) @ t >= 0)[:, : per * width] for t in turns], axis=1)
                parts = (signs.reshape(len(x), rotations * per, width) * weights).sum(axis=2, dtype=np.uint64)
                yield batch, parts

    many = rotations * per

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parts in coded(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(many), len(parts))), pa.array(parts.ravel().view(np.int64))], ["table", "value"])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # many tables make long codes: few vectors at a time
        step = max(1, POST_BYTES // (8 * many * (many + dim)))
        for batch, parts in coded(b.slice(lo, step) for b in batches for lo in range(0, b.num_rows, step)):
            row = pa.array(np.repeat(np.arange(len(parts)), many))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(many), len(parts))), pa.array(parts.ravel().view(np.int64)), pa.array([p.tobytes() for p in parts.astype(_code_type(width))], pa.binary()).take(row), *[batch[c].take(row) for c in ("rep", "copies", "embedding")]],
                ["table", "value", "code", "rep", "copies", "embedding"],
            )

    postings = vectors.select("rep", "copies", "embedding").mapInArrow(post, f"table long, value long, code binary, rep long, copies long, embedding {vectors.schema['embedding'].dataType.simpleString()}")
    lists = vectors.select("embedding").mapInArrow(keys, "table long, value long").groupBy("table", "value").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("long")
    shared = postings.join(lists, ["table", "value"])
    shared = shared.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep"), blocks))
    shared = with_cells(shared, F.col("n"), BLOCK, F.col("rep")).drop("n")
    shared = shared.repartition("table", "value", "cell").sortWithinPartitions("table", "value", "cell")
    return shared.mapInArrow(_linked(dim, many, width), "u long, v long, links long")


def near_duplicate_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for each row (``vec_id`` long, ``embedding`` array of numbers).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different length. Copies count one by one in ``n_links``. Rows that share a vec_id are judged by their own
    vectors; a row without a vec_id links with nothing (component_id null, kept). Other columns are ignored.
    """
    # float32 components are posted as such: every one of them is the same number in double precision
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    usable = _valid("embedding") & F.col("vec_id").isNotNull()
    good = rows.where(usable).select("vec_id", F.transform("embedding", lambda v: v + F.lit(0.0).cast(kind)).alias("embedding"))
    groups = good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    groups = written(groups, "vectors")
    members = good.join(groups, "embedding").select("vec_id", "rep", "copies")
    found = None
    for (dim,) in sorted(groups.select(F.size("embedding")).distinct().collect()):
        part = _of_dimension(groups.where(F.size("embedding") == dim), dim)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "u long, v long, links long")
    found = written(found.groupBy("u", "v").agg(F.sum("links").alias("links")), "vector-links")
    components = connected_components(found, "vector-components").withColumnRenamed("node", "rep")
    counts = found.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    members = members.join(counts, "rep", "left").join(components, "rep", "left")
    linked = members.select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op2_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """A row for each of ``embeddings``: its links, the least vec_id that links reach, and whether it is that one."""
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
