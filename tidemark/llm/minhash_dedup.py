"""Near-duplicate documents by a signature-coordinate inverted join.

1. Every text becomes its set of 5-word shingles and a MinHash signature. Documents with equal sets fall together
   (one grouping), so copies cost one signature however many there are.
2. A set is posted under (coordinate, value) pairs. Two sets that agree on ``matches`` of ``coordinates`` share at
   least one of the first ``coordinates - matches + 1`` of each, whatever total order both follow: that prefix alone
   is posted, and the order puts values that many sets share last. Their frequencies come from a count sketch of fixed
   size, so what is broadcast never grows.
3. Sets that meet under a value count their collisions over the whole signature; those above the threshold are
   candidates. Frequent values are skipped to the end of the order, and long lists are cut into blocks
   (:mod:`.cells`): no list is held whole, no pair leaves a cell, only a spanning forest.
4. Candidates that hang together form a class. Inside a class links are confirmed on full shingle sets: blocks against
   a few pivots first, then blocks against blocks of other components, and again only a spanning forest leaves.

At similarity 0.75 a pair falls below 35 of 64 collisions with probability 1e-4.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import mixed, shingle_sets, tidy
from .cells import Forest, grouped_batches, near_pairs, with_cells
from .graph import connected_components, contracted
from .storage import is_empty, written

WIDTH = 5
COORDINATES = 64
MATCHES = 35
#: Link where LINK * union <= 100 * intersection.
LINK = 75
SLOTS = 1 << 18
BLOCK = 1024
CLASS_BLOCK = 256
PIVOTS = 32

_rng = np.random.default_rng(711)
_A = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``COORDINATES`` minima as uint32; ``shingles`` are hashes, at least one."""
    least = np.full(COORDINATES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for lo in range(0, len(shingles), 4096):
        part = shingles[lo : lo + 4096]
        np.minimum(least, (part[:, None] * _A + _B).min(axis=0), out=least)
    return (mixed(least) >> np.uint64(32)).astype(np.uint32)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, signatures = [], [], []
        for _, s in shingle_sets(batch["text"], WIDTH):
            sizes.append(len(s))
            digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            signatures.append(signature(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "digest", "signature"])


def _keys(signatures: pa.Array) -> np.ndarray:
    """One row a signature: (coordinate, value) packed into an unsigned 64-bit number."""
    sig = np.frombuffer(b"".join(signatures.to_pylist()), np.uint32).reshape(-1, COORDINATES)
    return (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)) | sig


def _slots(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys) % np.uint64(SLOTS)).astype(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        counts += np.bincount(_slots(_keys(batch["signature"])).ravel(), minlength=SLOTS)
    rows = counts.reshape(-1, 1024)
    used = np.flatnonzero(rows.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([rows[i].tobytes() for i in used], pa.binary())], ["part", "counts"])


def _sketch_sum(group: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.int64) for x in group["counts"].to_pylist()], axis=0)
    return pa.table({"part": group["part"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def value_frequencies(sets: DataFrame) -> np.ndarray:
    """Counts of (coordinate, value) pairs by slot: ``SLOTS`` numbers, however many documents there are."""
    parts = sets.select("signature").mapInArrow(tidy(_sketch), "part long, counts binary").groupBy("part").applyInArrow(_sketch_sum, "part long, counts binary")
    out = np.zeros((SLOTS // 1024, 1024), np.int64)
    for row in parts.collect():  # at most SLOTS / 1024 rows
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def _collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, group in grouped_batches(batches, ["key", "cell"]):
        node = table["node"].to_numpy()
        sig = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, COORDINATES)
        forest = Forest(len(node))
        for i, j in near_pairs(group):
            near = np.zeros(len(i), np.uint8)
            for k in range(COORDINATES):
                near += sig[i, k] == sig[j, k]
            near = near >= MATCHES
            forest.link(i[near], j[near])
        at = forest.edges()
        yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[forest.label[at]])], ["u", "v"])


def candidate_edges(sets: DataFrame) -> DataFrame:
    """``u``, ``v``: a spanning forest of the candidate pairs, from ``node`` and ``signature``, contracted in each task."""
    spark = sets.sparkSession
    frequencies = spark.sparkContext.broadcast(value_frequencies(sets))
    prefix = COORDINATES - MATCHES + 1

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = _keys(batch["signature"])
                order = np.lexsort((mixed(keys), frequencies.value[_slots(keys)]), axis=1)[:, :prefix]
                first = np.take_along_axis(keys, order, 1).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(np.repeat(batch["node"].to_numpy(), prefix))], ["key", "node"])

    postings = sets.select("node", "signature").mapInArrow(tidy(post), "key long, node long")
    lists = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = with_cells(postings.join(lists, "key"), F.col("n"), BLOCK, F.col("node")).join(sets.select("node", "signature"), "node")
    shared = shared.select("key", "cell", "node", "signature").repartition("key", "cell").sortWithinPartitions("key", "cell")
    return shared.mapInArrow(tidy(contracted(_collisions)), "u long, v long")


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, group in grouped_batches(batches, ["component", "cell"], 2 * CLASS_BLOCK):
        node = table["node"].to_numpy()
        sets = [s for _, s in shingle_sets(table["text"], WIDTH)]
        sizes = np.array([len(s) for s in sets])
        forest = Forest(len(node))
        for lo, hi in zip(*_bounds(group), strict=True):
            n = hi - lo
            if n > 1:
                common = intersections(sets[lo:hi]).reshape(n, n)
                i, j = np.nonzero(common)
                near = 100 * common[i, j] >= LINK * (sizes[lo + i] + sizes[lo + j] - common[i, j])
                forest.link(lo + i[near], lo + j[near])
        at = forest.edges()
        yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[forest.label[at]])], ["u", "v"])


def _bounds(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    return starts, np.r_[starts[1:], len(group)]


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections i < j, flat (``i * n + j``), by counting pairs within each shingle's list."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shingle = np.concatenate(sets)
    order = np.lexsort((owner, shingle))
    owner, shingle = owner[order], shingle[order]
    same = np.r_[shingle[1:] == shingle[:-1], False]
    many = same | np.r_[False, same[:-1]]
    owner, shingle = owner[many], shingle[many]
    counts = np.zeros(n * n, np.int64)
    for i, j in near_pairs(shingle, 1 << 20):
        counts += np.bincount(owner[i] * n + owner[j], minlength=n * n) if len(i) > n * n // 8 else 0
        if len(i) <= n * n // 8:
            np.add.at(counts, owner[i] * n + owner[j], 1)
    return counts


def _in_cells(members: DataFrame) -> DataFrame:
    cells = members.select("component", "cell", "node", "text").repartition("component", "cell").sortWithinPartitions("component", "cell")
    return cells.mapInArrow(tidy(contracted(_confirmed)), "u long, v long")


def confirmed_edges(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``u``, ``v``: a spanning forest of the links, from candidates confirmed on full sets.

    A class of up to ``CLASS_BLOCK`` documents is one cell. In a larger one, blocks meet a few pivots of the class first:
    in a group of copies that ties nearly all of them together. After that only blocks that are not parts of one
    component meet, so a large group costs its stragglers times its size, not its square.
    """
    classes = connected_components(candidate_edges(sets), "minhash-candidates", already=True)
    sizes = written(classes.groupBy("component").agg(F.count("*").alias("n")), "minhash-sizes")  # written: the join's own exchange can split a hot class
    # a merge join at every size: the members grow with the corpus and are not for broadcasting
    members = classes.join(sizes, "component").hint("merge").join(docs.select(F.col("doc_id").alias("node"), "text"), "node")
    members = written(members, "minhash-members")
    blocks = F.ceil(F.col("n") / F.lit(CLASS_BLOCK)).cast("long")
    own = F.pmod(F.xxhash64("node"), blocks)
    is_pivot = (F.col("n") > CLASS_BLOCK) & (F.pmod(F.xxhash64(F.lit(1), F.col("node")), F.ceil(F.col("n") / F.lit(PIVOTS)).cast("long")) == 0)
    everywhere = F.sequence(F.lit(0).cast("long"), blocks - 1)
    links = written(_in_cells(members.withColumn("cell", F.explode(F.when(is_pivot, everywhere).otherwise(F.array(own))))), "minhash-first")
    large = members.where(F.col("n") > CLASS_BLOCK)
    if is_empty(large):
        return links
    parts = large.join(connected_components(links, "minhash-pivots", already=True).withColumnRenamed("component", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    counts = parts.groupBy("component", "part").agg(F.count("*").alias("held")).where(F.col("held") > CLASS_BLOCK)
    parts = parts.join(counts, ["component", "part"], "left")
    # a block is a slice of one large part, or of all that is in no large part
    settled = F.col("held").isNotNull()
    slice_ = F.when(settled, F.pmod(F.xxhash64("node"), F.ceil(F.col("held") / F.lit(CLASS_BLOCK)).cast("long"))).otherwise(own)
    part = F.when(settled, F.col("part"))
    name = F.concat_ws(":", F.coalesce(part.cast("string"), F.lit("-")), slice_.cast("string"))
    parts = written(parts.select("component", "node", "text", part.alias("part"), name.alias("block")), "minhash-parts")
    known = written(parts.groupBy("component", "part", "block").agg(F.count("*").alias("held")), "minhash-blocks")
    open_, others = known.where("part is null").alias("p"), known.alias("q")
    loose = open_.join(others, F.expr("p.component = q.component and p.block != q.block"), "left").selectExpr("p.component", "p.block as a", "coalesce(q.block, p.block) as b")
    apart = known.where("part is not null").alias("p").join(others, F.expr("p.component = q.component and p.part < q.part")).selectExpr("p.component", "p.block as a", "q.block as b")
    pairs = loose.union(apart).select("component", F.xxhash64(F.least("a", "b"), F.greatest("a", "b")).alias("cell"), F.explode(F.array("a", "b")).alias("block")).distinct()
    return links.unionByName(_in_cells(parts.join(pairs, ["component", "block"])))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for each row of ``docs`` (``doc_id`` long, ``text``).

    Null and empty texts have an empty set and link with nothing. Rows without a doc_id link with nothing either:
    their component_id is null and they are kept. Each row is judged by its own text, also where several share a
    doc_id. Other columns are ignored. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    sets = written(docs.mapInArrow(tidy(_sets), "doc_id long, n_shingles long, digest binary, signature binary"), "minhash-sets")
    distinct = sets.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    distinct = written(distinct.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")), "minhash-distinct")
    same_id = sets.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull()).join(distinct.select("digest", "node"), "digest")
    links = confirmed_edges(distinct, docs)
    components = connected_components(links, "minhash-links", already=True)
    nodes = same_id.select("doc_id", "digest", "node", "n_shingles").join(components, "node", "left")
    found = nodes.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    alone = sets.where(F.col("digest").isNull() | F.col("doc_id").isNull())
    out = found.unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` to keep: one of each component. Of rows that share a kept doc_id, one stays.

    Rows without a doc_id stay. Texts are shuffled by doc_id once, for the join and for repeated ids alike.
    """
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    with_id = docs.join(kept.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return with_id.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def op10_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    """A row for each of ``documents``: size of its shingle set, smallest doc_id of its component, and whether it is that one."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def miss_probability(similarity: float, coordinates: int = COORDINATES, matches: int = MATCHES) -> float:
    """Chance that a pair of that similarity collides in fewer than ``matches`` coordinates."""
    return sum(math.comb(coordinates, k) * similarity**k * (1 - similarity) ** (coordinates - k) for k in range(matches))
