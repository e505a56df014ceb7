"""Repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Consecutive windows whose least word-gram (of ``GRAM`` words, by hash) is the
same travel together as one packed string, a super-k-mer, to the bucket of that minimiser: every window sends its words
about three times instead of thirteen, and all copies of a window reach one bucket.

1. Equal super-k-mers of a chunk of documents are merged before the shuffle, so a passage that a third of all
   documents share arrives once a chunk. What a chunk sends to a bucket is one compressed row: the strings, and the
   smallest and largest doc_id of each. The number of buckets follows the size of the corpus.
2. In its bucket, windows are sorted and equal ones counted; each gets the smallest doc_id that starts it. Super-k-mers that hold a window with two doc_ids come back with those minima.
   A bucket of more than ``HOT_BYTES`` (a frequent minimiser in differing surroundings) is passed on as it is, and its
   windows are sent again by their own hashes, so equal ones still meet and no task holds the bucket.
3. Documents look up their super-k-mers among these: first in a Bloom filter of fixed size, so that few others are
   shuffled, then by a join on the hash of the packed string. What is covered leaves the document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import Words, buffers, mixed, range_hashes, word_chunks
from .storage import is_empty, written

WINDOW = 13
GRAM = 3
#: Windows in a super-k-mer at most; longer runs (one word repeated) are cut, which changes no window.
LONGEST = 64
#: Bytes of documents that are packed together, and of packed strings that a bucket should hold.
CHUNK = 6 << 20
BUCKET_BYTES = 8 << 20
#: Bytes of super-k-mers (three times the texts, at most) to a partition.
PARTITION_BYTES = 128 << 20
#: Bytes of packed strings that a bucket is joined with at most, and of those in one row.
HOT_BYTES = 24 << 20
ROW_BYTES = 1 << 20
#: The filter's size in bits; it stays the same for any input (a full one lets all through, which is right but slow).
FILTER_BITS = 1 << 25
_MULTIPLIER = np.uint64(0xA0761D6478BD642F)


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def super_kmers(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word, number of windows and minimiser of each run of windows that share their minimiser."""
    h = words.hashes()
    if len(h) < WINDOW:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    grams = h[: len(h) - GRAM + 1].copy()
    for j in range(1, GRAM):
        grams = grams * _MULTIPLIER + h[j : len(h) - GRAM + 1 + j]
    least = _sliding_minimum(mixed(grams), WINDOW - GRAM + 1)
    row = words.row_of()
    at = np.flatnonzero(row[: len(least)] == row[WINDOW - 1 :])
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    least = least[at]
    new = np.r_[True, (np.diff(at) != 1) | (least[1:] != least[:-1]) | (row[at[1:]] != row[at[:-1]])]
    run = np.cumsum(new) - 1
    start = np.flatnonzero(new)
    new |= (np.arange(len(at)) - start[run]) % LONGEST == 0
    start = np.flatnonzero(new)
    return row[at[start]], at[start], np.diff(np.r_[start, len(at)]), least[start]


class Packed:
    """Words of some rows joined by one space each, and byte ranges of word runs in it."""

    def __init__(self, words: Words):
        sizes = words.ends - words.starts
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        keep = np.zeros(len(words.data) + 1, np.int64)
        keep[words.starts] += 1
        keep[words.ends] -= 1
        inside = np.cumsum(keep[:-1]).astype(bool)
        self.data = np.full(int(self.ends[-1]) + 1 if len(sizes) else 0, 32, np.uint8)
        out = np.ones(len(self.data), bool)
        out[self.ends] = False
        self.data[out] = words.data[inside]


def _runs(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Packed, np.ndarray, np.ndarray]]:
    for lo, _, words in word_chunks(texts, size=size):
        row, first, windows, least = super_kmers(words)
        if len(row):
            packed = Packed(words)
            begin = packed.starts[first]
            stop = packed.ends[first + windows + WINDOW - 2]
            yield lo + row, first - words.first[row], windows, least, packed, begin, stop


def _string_keys(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return range_hashes(data, begin, stop, 0).view(np.int64), range_hashes(data, begin, stop, 1).view(np.int64)


def _sent(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=5)
        for batch in batches:
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for row, _, _, least, packed, begin, stop in _runs(batch["text"], CHUNK):
                k1, k2 = _string_keys(packed.data, begin, stop)
                bucket = (least % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((k2, k1, least, bucket))  # neighbours share their minimiser and compress well
                k1, k2, bucket, doc = k1[order], k2[order], bucket[order], ids[row[order]]
                starts = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (bucket[1:] != bucket[:-1])])
                low, high, bucket = np.minimum.reduceat(doc, starts), np.maximum.reduceat(doc, starts), bucket[starts]
                data, begin, stop = packed.data.tobytes(), begin[order[starts]].tolist(), stop[order[starts]].tolist()
                new = np.r_[True, bucket[1:] != bucket[:-1]]
                total = np.cumsum(np.subtract(stop, begin) + 1)
                piece = (total - total[np.flatnonzero(new)][np.cumsum(new) - 1]) // ROW_BYTES
                cuts = np.flatnonzero(np.r_[new | np.r_[False, piece[1:] != piece[:-1]], True])
                out = [
                    (int(bucket[a]), squeeze.compress(b"\n".join([data[x:y] for x, y in zip(begin[a:b], stop[a:b], strict=True)])), low[a:b].tobytes(), high[a:b].tobytes())
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                ]
                kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["bucket", "strings", "low", "high"])

    return run


FOUND = ["k1", "k2", "firsts", "strings", "low", "high"]


def _shared(limit: int):
    """Per bucket: the super-k-mers that hold a window of more than one doc_id, with each window's smallest doc_id.

    The rows of a bucket over ``limit`` come out as they came in (``strings``, ``low``, ``high``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, now = 0, None

        def passed(part: pa.RecordBatch) -> pa.RecordBatch:
            none = [pa.nulls(part.num_rows, k) for k in (pa.int64(), pa.int64(), pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([*none, *[part[c] for c in FOUND[3:]]], FOUND)

        def joined() -> Iterator[pa.RecordBatch]:
            found = _bucket(pa.Table.from_batches(held)) if held else None
            if found is not None:
                yield found

        for batch in batches:
            bucket = batch["bucket"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else np.zeros(1, np.int64)
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part = batch.slice(lo, hi - lo)
                if bucket[lo] != now:
                    yield from joined()
                    held, size, now = [], 0, bucket[lo]
                size += sum(zstandard.frame_content_size(x.as_buffer()) for x in part["strings"])
                held.append(part)
                if size > limit:
                    yield from map(passed, held)
                    held = []
        yield from joined()

    return run


def _string_windows(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the inflated strings, where each starts and ends, and the windows: their string and two hashes."""
    inflate = zstandard.ZstdDecompressor()
    data = np.frombuffer(b"".join([inflate.decompress(x) + b"\n" for x in strings]), np.uint8)
    ends = np.flatnonzero(data == 10)
    offsets = np.r_[0, ends + 1]
    words = Words(data, offsets)
    row = words.row_of()
    at = np.flatnonzero(row[: max(0, len(row) - WINDOW + 1)] == row[WINDOW - 1 :])
    begin, stop = words.starts[at], words.ends[at + WINDOW - 1]
    return data, offsets, ends, row[at], range_hashes(data, begin, stop, 0), range_hashes(data, begin, stop, 1)


def _hot_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of the strings: its hashes, its string's hashes and its place there, smallest and largest doc_id."""
    for batch in batches:
        for strings, low, high in zip(*[batch[c].to_pylist() for c in FOUND[3:]], strict=True):
            data, offsets, ends, owner, a, b = _string_windows([strings])
            k1, k2 = _string_keys(data, offsets[:-1], ends)
            at = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
            columns = [a.view(np.int64), b.view(np.int64), k1[owner], k2[owner], at, np.frombuffer(low, np.int64)[owner], np.frombuffer(high, np.int64)[owner]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "k1", "k2", "at", "low", "high"])


def _hot_shared(rows: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``firsts`` from the rows of buckets that no task may hold; a window of one doc_id has null."""
    windows = rows.mapInArrow(_hot_windows, "a long, b long, k1 long, k2 long, at long, low long, high long")
    several = windows.groupBy("a", "b").agg(F.min("low").alias("first"), F.max("high").alias("last")).where(F.col("first") != F.col("last"))
    places = windows.select("a", "b", "k1", "k2", "at").join(several.select("a", "b", "first"), ["a", "b"])
    found = places.groupBy("k1", "k2").agg(F.map_from_entries(F.collect_set(F.struct("at", "first"))).alias("by_place"), F.max("at").alias("last"))
    return found.select("k1", "k2", F.transform(F.sequence(F.lit(0).cast("long"), "last"), lambda i: F.try_element_at("by_place", i)).alias("firsts"))


def _bucket(table: pa.Table) -> pa.RecordBatch | None:
    low = np.concatenate([np.frombuffer(x, np.int64) for x in table["low"].to_pylist()])
    high = np.concatenate([np.frombuffer(x, np.int64) for x in table["high"].to_pylist()])
    data, offsets, ends, owner, a, b = _string_windows(table["strings"].to_pylist())
    order = np.lexsort((b, a))
    new = np.r_[True, (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])]
    number = np.cumsum(new) - 1
    lowest = np.minimum.reduceat(low[owner[order]], np.flatnonzero(new))
    highest = np.maximum.reduceat(high[owner[order]], np.flatnonzero(new))
    first, many = np.empty(len(order), np.int64), np.empty(len(order), bool)
    first[order] = lowest[number]
    many[order] = (lowest != highest)[number]
    hit = np.unique(owner[many])
    if not len(hit):
        return None
    k1, k2 = _string_keys(data, offsets[hit], ends[hit])
    once = np.lexsort((k2, k1))
    once = once[np.r_[True, (k1[once[1:]] != k1[once[:-1]]) | (k2[once[1:]] != k2[once[:-1]])]]
    hit, k1, k2 = hit[once], k1[once], k2[once]
    left, right = np.searchsorted(owner, hit, "left"), np.searchsorted(owner, hit, "right")
    sizes = right - left
    pick = np.repeat(left - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(first[pick]))
    none = pa.nulls(len(k1), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), lists, none, none, none], FOUND)


def _bits(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    a, b = k1.view(np.uint64), k2.view(np.uint64)
    return np.stack([(a + np.uint64(i) * b) % np.uint64(FILTER_BITS) for i in range(3)]).astype(np.int64)


def _filter_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros(FILTER_BITS, bool)
    for batch in batches:
        found[_bits(batch["k1"].to_numpy(), batch["k2"].to_numpy())] = True
    parts = np.packbits(found).reshape(-1, 1 << 14)
    used = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([parts[i].tobytes() for i in used], pa.binary())], ["part", "bits"])


def _filter_merge(group: pa.Table) -> pa.Table:
    merged = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in group["bits"].to_pylist()])
    return pa.table({"part": group["part"][:1], "bits": pa.array([merged.tobytes()], pa.binary())})


def key_filter(shared: DataFrame) -> np.ndarray:
    """A Bloom filter of the shared super-k-mers; its ``FILTER_BITS`` do not grow with the input."""
    parts = shared.select("k1", "k2").mapInArrow(_filter_parts, "part long, bits binary").groupBy("part").applyInArrow(_filter_merge, "part long, bits binary")
    out = np.zeros((FILTER_BITS // 8 >> 14, 1 << 14), np.uint8)
    for row in parts.collect():  # at most FILTER_BITS / 2**17 rows
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return np.unpackbits(out.ravel()).astype(bool)


def shared_super_kmers(docs: DataFrame) -> DataFrame:
    """``k1``, ``k2`` (hashes of the packed string), ``firsts``: super-k-mers with a window that several documents hold."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, math.ceil(3 * size / BUCKET_BYTES))
    sent = docs.mapInArrow(_sent(buckets), "bucket long, strings binary, low binary, high binary")
    kinds = "k1 long, k2 long, firsts array<long>, strings binary, low binary, high binary"
    # as many partitions as the bytes ask for, so that a task's share doesn't grow with the input
    parts = math.ceil(3 * size / PARTITION_BYTES)
    dealt = sent.repartition(parts, "bucket") if parts > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else sent.repartition("bucket")
    found = written(dealt.sortWithinPartitions("bucket").mapInArrow(_shared(HOT_BYTES), kinds), "super-kmers")
    shared, hot = found.where("strings is null").select("k1", "k2", "firsts"), found.where("strings is not null").select(*FOUND[3:])
    return shared if is_empty(hot) else shared.unionByName(written(_hot_shared(hot), "hot-super-kmers"))


def removals(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``spans``: for each document with something to remove, word runs (first, end) that are covered."""
    spark = docs.sparkSession
    shared = shared_super_kmers(docs)
    bits = spark.sparkContext.broadcast(np.packbits(key_filter(shared)).tobytes())

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool)
        for batch in batches:
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for row, first, _, _, packed, begin, stop in _runs(batch["text"]):
                k1, k2 = _string_keys(packed.data, begin, stop)
                may = known[_bits(k1, k2)].all(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(k1[may]), pa.array(k2[may]), pa.array(ids[row[may]], pa.int64()), pa.array(first[may], pa.int64())], ["k1", "k2", "doc_id", "first"])

    asked = docs.mapInArrow(look_up, "k1 long, k2 long, doc_id long, first long")
    hits = asked.join(shared, ["k1", "k2"])
    covered = F.transform(
        F.filter(F.transform("firsts", lambda d, i: F.struct(d.alias("d"), (F.col("first") + i).alias("at"))), lambda w: w["d"] < F.col("doc_id")),
        lambda w: w["at"],
    )
    # runs of neighbouring windows become one span before they are grouped
    hits = hits.select("doc_id", covered.alias("at")).where("size(at) > 0")
    spans = F.transform(F.filter("at", lambda w: ~F.array_contains(F.col("at"), w - 1)), lambda w: w)
    ends = F.transform(F.filter("at", lambda w: ~F.array_contains(F.col("at"), w + 1)), lambda w: w + F.lit(WINDOW))
    runs = F.arrays_zip(spans.alias("first"), ends.alias("end"))
    return hits.select("doc_id", runs.alias("spans")).groupBy("doc_id").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch["spans"].to_pylist()
        counts, removed, kept = [], [], []
        for lo, hi, words in word_chunks(batch["text"]):
            packed = Packed(words)
            for i in range(lo, hi):
                a, b = words.first[i - lo], words.first[i - lo + 1]
                live = np.ones(b - a, bool)
                for s in spans[i] or ():
                    live[s["first"] : s["end"]] = False
                counts.append(int(b - a))
                removed.append(int(b - a - live.sum()))
                if live.all():
                    kept.append(packed.data[packed.starts[a] : packed.ends[b - 1]].tobytes() if b > a else b"")
                else:
                    kept.append(b" ".join(packed.data[packed.starts[w] : packed.ends[w]].tobytes() for w in a + np.flatnonzero(live)))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "text"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``text`` (kept words joined by one space) for each row of ``docs``.

    A word goes if a window over it also starts in a document with a smaller doc_id; all windows are judged on the
    input. Repeats within one document stay, and so does a null text (no words). Rows without a doc_id keep all their
    words and take none from others. Rows that share a doc_id are judged together: what is covered in one at some
    place is removed at that place in each, so doc_ids should be unique. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    spans = written(removals(docs.where(F.col("doc_id").isNotNull())), "removals")
    return docs.join(spans, "doc_id", "left").mapInArrow(_kept, "doc_id long, n_words long, n_removed long, text string")


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """A row for each doc_id of ``documents``: words, words removed, digest of what is kept."""
    out = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def brute_force(texts: dict[int, str | None]) -> dict[int, tuple[int, int, str]]:
    """The same for a few documents in plain Python, for tests."""
    import re

    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    first: dict[tuple, int] = {}
    for i, w in words.items():
        for k in range(len(w) - WINDOW + 1):
            key = tuple(w[k : k + WINDOW])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in words.items():
        live = [True] * len(w)
        for k in range(len(w) - WINDOW + 1):
            if first[tuple(w[k : k + WINDOW])] < i:
                live[k : k + WINDOW] = [False] * WINDOW
        kept = " ".join(x for x, ok in zip(w, live, strict=True) if ok)
        out[i] = (len(w), len(w) - sum(live), hashlib.sha256(kept.encode()).hexdigest())
    return out
