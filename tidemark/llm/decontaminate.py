"""Benchmark decontamination by q-gram lemma filtering.

A passage of length L that is within k edits of a document region shares at least ``L - q + 1 - k * q`` of its
character q-grams with it, and those lie on diagonals (position in the document less position in the item) at most k
from one another. Shared q-grams are counted in overlapping diagonal bands; a band that meets the bound is a region,
and a banded alignment verifies it.

The benchmark is a stated query set: its q-gram index is broadcast in blocks of at most ``BLOCK_CHARS`` characters,
and each block is held against all documents in one narrow pass, without a shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import LOWER, buffers, tidy

Q = 8
#: Edits allowed, as a share of the item's length: q-gram bound above 0 needs less than 1 / Q.
EDITS = 0.08
BLOCK_CHARS = 2_000_000
#: Postings of the index that are held at once while texts are looked up.
POSTINGS = 1 << 20
#: ASCII characters other than letters and digits separate words and count as one space.
_SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_MULTIPLIER = np.uint64(0xA0761D6478BD642F)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A-Z lower-cased, each run of separators and punctuation one space: bytes, offsets, and each byte's place in ``data``."""
    solid = ~_SEPARATOR[data]
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    keep[starts] = solid[starts]
    at = np.flatnonzero(keep)
    out = LOWER[data[at]].copy()
    out[~solid[at]] = 32
    return out, np.searchsorted(at, offsets), at


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Each ``Q`` = 8 neighbouring bytes as one number, scattered (over the whole buffer, also across texts)."""
    n = max(0, len(data) - Q + 1)
    out = np.empty(n, np.uint64)
    for k in range(min(Q, n)):
        some = (n - k + Q - 1) // Q
        out[k::Q] = np.frombuffer(data, np.uint64, some, k)
    return out * _MULTIPLIER


class Index:
    """The q-grams of a block of items, sorted, with a bitmap in front of the search."""

    BITMAP = 22

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in items]
        self.texts = [np.frombuffer(t, np.uint8) for _, t in items]
        grams = [gram_hashes(np.ascontiguousarray(t)) for t in self.texts]
        sizes = [len(g) for g in grams]
        keys = np.concatenate([np.zeros(0, np.uint64), *grams])
        item = np.repeat(np.arange(len(items)), sizes)
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(n) for n in sizes]])
        order = np.argsort(keys, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.r_[first, len(keys)]
        self.known = np.zeros(1 << self.BITMAP, bool)
        self.known[(self.keys >> np.uint64(64 - self.BITMAP)).astype(np.int64)] = True
        # postings by q-gram, then item: those of some items only are a range in each
        self.composite = np.repeat(np.arange(len(self.keys)), np.diff(self.first)) * max(1, len(items)) + self.item
        # short items get the edits that leave the bound at 1 or more
        self.budget = np.array([min(int(len(t) * EDITS), max(0, (len(t) - Q) // Q)) for t in self.texts], np.int64)
        self.bound = np.array([len(t) - Q + 1 - k * Q for t, k in zip(self.texts, self.budget, strict=True)], np.int64)

    def regions(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Row, item, and the least and greatest diagonal of each band that meets the bound."""
        grams, n = gram_hashes(data), len(self.ids)
        at = np.flatnonzero(self.known[(grams >> np.uint64(64 - self.BITMAP)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        some = self.keys[number] == grams[at] if len(self.keys) else np.zeros(len(at), bool)
        at, number = at[some], number[some]
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[row + 1]
        at, number, row = at[inside], number[inside], row[inside]
        begin = np.searchsorted(row, np.arange(len(offsets)))
        for r, items in self._pairs(row, number, len(offsets) - 1):
            here = slice(begin[r], begin[r + 1])
            step = max(1, POSTINGS // max(1, begin[r + 1] - begin[r]))
            for i in range(0, len(items), step):
                yield from self._bands(r, at[here] - offsets[r], number[here], items[i : i + step], n)

    def _pairs(self, row: np.ndarray, number: np.ndarray, rows: int) -> Iterator[tuple[int, np.ndarray]]:
        """Rows with the items that may meet the bound in them: a band can't count more than the item's places whose q-grams the row has at all."""
        n, grams = len(self.ids), max(1, len(self.keys))
        each_row, number = np.divmod(np.unique(row * grams + number), grams)
        sizes = self.first[number + 1] - self.first[number]
        total = np.r_[0, np.cumsum(sizes)]
        begin = np.searchsorted(each_row, np.arange(rows + 1))
        least = np.maximum(1, self.bound)

        def postings(lo: int, hi: int) -> np.ndarray:
            first, each = self.first[number[lo:hi]], sizes[lo:hi]
            return self.item[np.repeat(first - (total[lo:hi] - total[lo]), each) + np.arange(total[hi] - total[lo])]

        r = 0
        while r < rows:  # a few rows at a time, or one row with a few q-grams at a time
            stop = max(r + 1, int(np.searchsorted(total[begin], total[begin[r]] + POSTINGS, "right")) - 1)
            lo, hi = int(begin[r]), int(begin[stop])
            if total[hi] - total[lo] <= POSTINGS:
                pair, shared = np.unique(np.repeat(each_row[lo:hi], sizes[lo:hi]) * n + postings(lo, hi), return_counts=True)
                pair = pair[shared >= least[pair % n]]
                for own in np.split(pair, np.flatnonzero(np.diff(pair // n)) + 1) if len(pair) else ():
                    yield int(own[0] // n), own % n
            else:
                shared = np.zeros(n, np.int64)
                while lo < hi:
                    to = max(lo + 1, int(np.searchsorted(total, total[lo] + POSTINGS, "right")) - 1)
                    to = min(to, hi)
                    shared += np.bincount(postings(lo, to), minlength=n)
                    lo = to
                if (shared >= least).any():
                    yield r, np.flatnonzero(shared >= least)
            r = stop

    def _bands(self, r: int, at: np.ndarray, number: np.ndarray, items: np.ndarray, n: int) -> Iterator[tuple[int, int, int, int]]:
        """Bands of one row (places and numbers of its q-grams) with some items."""
        wanted = (number[:, None] * n + items).ravel()
        low, high = np.searchsorted(self.composite, wanted), np.searchsorted(self.composite, wanted, "right")
        each = high - low
        pick = np.repeat(low - np.r_[0, np.cumsum(each)[:-1]], each) + np.arange(each.sum())
        if not len(pick):
            return
        item, place = self.item[pick], self.place[pick]
        # bands of width 2(k + 1) that overlap by half: any k + 1 neighbouring diagonals lie in one of them
        band = np.floor_divide(np.repeat(np.repeat(at, len(items)), each) - place, self.budget[item] + 1)
        item, band, place = np.r_[item, item], np.r_[band, band - 1], np.r_[place, place]
        # each q-gram of the item counts once a band, or a repeated one would stand for others
        order = np.lexsort((place, band, item))
        i, b, p = item[order], band[order], place[order]
        new = np.r_[True, (i[1:] != i[:-1]) | (b[1:] != b[:-1])]
        fresh = new | np.r_[True, p[1:] != p[:-1]]
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(fresh.astype(np.int64), starts)
        for s in starts[counts >= np.maximum(1, self.bound[i[starts]])]:
            yield r, int(i[s]), int(b[s] * (self.budget[i[s]] + 1)), int((b[s] + 2) * (self.budget[i[s]] + 1) - 1)


def banded_alignment(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """Fewest edits that turn ``item`` into a part of ``text`` along diagonals ``low`` to ``high``, with its start and end.

    None if that takes more than ``budget``. Rows are the item's characters; a row is the band, as an array.
    """
    same_text = text.tobytes().find(item.tobytes(), max(0, low), max(0, high) + len(item) + 1)
    if same_text >= 0:  # no edits: the alignment is the diagonal itself
        return 0, same_text, same_text + len(item)
    low, high = low - budget, high + budget
    width = high - low + 1
    places = np.arange(width)
    far = len(item) + budget + 1
    column = places + low
    cost = np.where((column >= 0) & (column <= len(text)), 0, far)
    origin = column.copy()
    for k in range(len(item)):
        column = places + low + k + 1
        here = (column >= 1) & (column <= len(text))
        same = np.zeros(width, bool)
        same[here] = text[column[here] - 1] == item[k]
        change = np.where(here, cost + ~same, far)
        drop, drop_origin = np.r_[cost[1:] + 1, far], np.r_[origin[1:], 0]
        drop = np.where((column >= 0) & (column <= len(text)), drop, far)
        best, source = np.where(change <= drop, change, drop), np.where(change <= drop, origin, drop_origin)
        # characters of the text that the item lacks: a running minimum along the row
        run = best - places
        least = np.minimum.accumulate(run)
        at = np.maximum.accumulate(np.where(run == least, places, 0))
        cost, origin = np.where(column <= len(text), least + places, far), source[at]
    end = int(cost.argmin())
    return (int(cost[end]), int(origin[end]), end + low + len(item)) if cost[end] <= budget else None


def blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """Items (normalised) in blocks of some ``BLOCK_CHARS`` characters, or of one longer item; empty ones have no match.

    Blocks are by hash of the item, so no task sees more of the benchmark than its part.
    """
    sized = benchmark.where("length(trim(text)) > 0").select("item_id", "text")
    size = sized.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = -(-size // BLOCK_CHARS)
    for block in range(blocks):
        table = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        data, offsets, _ = normalised(*buffers(table["text"]))
        ids = table["item_id"].to_pylist()
        items = [(i, bytes(data[a:b]).strip(b" ")) for i, a, b in zip(ids, offsets[:-1], offsets[1:], strict=True)]
        if items := [(i, t) for i, t in items if t]:
            yield items


def hits_of(texts: pa.Array, known: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """Row, item_id, start and end (bytes of the text) and edits of each passage in ``texts``."""
    raw, cuts = buffers(texts)
    lo = 0
    while lo < len(texts):  # a few texts at a time, one longer text alone
        hi = min(len(texts), max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + (1 << 20), "right")) - 1))
        data, offsets, at = normalised(raw[cuts[lo] : cuts[hi]], cuts[lo : hi + 1] - cuts[lo])
        best: dict[tuple[int, int, int], tuple[int, int, int]] = {}
        for row, item, low, high in known.regions(data, offsets):
            text, budget = data[offsets[row] : offsets[row + 1]], int(known.budget[item])
            # a piece of the text around the band keeps the alignment as short as the item
            left = max(0, low - budget)
            piece = text[left : high + len(known.texts[item]) + 2 * budget + 1]
            hit = banded_alignment(known.texts[item], piece, low - left, high - left, budget)
            if hit and hit[2] > hit[1]:
                key = (row, item, left + hit[2])
                best[key] = min(best.get(key, (1 << 30, 0, 0)), (hit[0], left + hit[1], left + hit[2]))
        taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for (row, item, _), (edits, s, e) in sorted(best.items(), key=lambda x: (x[0][0], x[0][1], x[1])):
            spans = taken.setdefault((row, item), [])
            if all(e <= a or b <= s for a, b in spans):
                spans.append((s, e))
                base, o = cuts[lo + row] - cuts[lo], offsets[row]
                yield lo + row, known.ids[item], int(at[o + s] - base), int(at[o + e - 1] + 1 - base), edits
        lo = hi


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``start``, ``end`` (bytes of the text), ``edits``: each passage found, best per place.

    Texts are compared with A-Z lower-cased and runs of ASCII separators and punctuation made one space. Null and
    empty texts, and items without characters, match nothing; items of fewer than ``Q`` characters can't be told from
    chance and match nothing either. An item without an item_id has no rows here (:func:`decontaminated` looks for it all the same). A document that holds an item several times has a row for each, and so has each
    of several equal rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    found = None
    for items in blocks_of(benchmark.where("item_id is not null")):
        index = spark.sparkContext.broadcast(items)

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            known = Index(index.value)
            for batch in batches:
                columns = list(zip(*hits_of(batch["text"], known), strict=True)) or [[]] * 5
                row = pa.array(columns[0], pa.int64())
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(row), *[pa.array(c, pa.int64()) for c in columns[1:]]], ["doc_id", "item_id", "start", "end", "edits"])

        part = rows.mapInArrow(tidy(scan), "doc_id long, item_id long, start long, end long, edits long")
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], "doc_id long, item_id long, start long, end long, edits long") if found is None else found


def _is_clean(index):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Index(index.value)
        for column in texts:
            clean = np.ones(len(column), bool)
            clean[[hit[0] for hit in hits_of(column, known)]] = False
            yield pa.array(clean)

    tidied = tidy(run)
    tidied.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(tidied, "boolean")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage, of an item with or without an item_id: a filter, so no text is moved."""
    for items in blocks_of(benchmark):
        docs = docs.where(_is_clean(docs.sparkSession.sparkContext.broadcast(items))("text"))
    return docs


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """A row for each passage of ``benchmark`` found in ``documents``: doc_id, item_id, place in bytes, edits."""
    return contaminations(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
