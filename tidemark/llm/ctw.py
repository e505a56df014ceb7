"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has its own context tree over the ``DEPTH`` bytes before it. A node's
Krichevsky-Trofimov estimate is mixed, half and half, with what its children say, at every depth.

Training gathers, over all training documents, how often each byte follows each ``DEPTH``-byte context; everything
else follows from that table by grouping, one level of the tree at a time: upwards the block probabilities, downwards
the weights of the mixture along each path. That gives each (context, byte) its code length. A text's score is a sum
over its bytes, so no tree is walked while scoring.

Both tables, of contexts and of words (for the unigram base), may outgrow memory. Their most frequent ``HEAD`` rows,
a fixed number, are broadcast; the rest of a document's entries are joined with the table by a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import LOWER, Words, buffers, tidy
from .storage import dropped, written
from .toxicity import held_out

DEPTH = 5
HEAD = 1 << 20
#: Entries that a task holds before it merges them; if over three quarters are distinct, it hands its counts on.
FLUSH = 1 << 20
#: Bytes of text, and rows of counts, that are worked on at a time.
PIECE = 1 << 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo:hi``, about ``PIECE`` bytes together (one longer text comes alone), their lower-cased bytes and offsets."""
    data, offsets = buffers(batch["text"])
    lo = 0
    while lo < batch.num_rows:
        hi = min(batch.num_rows, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, "right")) - 1))
        yield lo, hi, LOWER[data[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def context_grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each byte: the ``DEPTH`` bytes before it (zeros before a text's start) and itself, packed, itself lowest; with their place, ``PIECE`` at a time."""
    for lo in range(0, len(data), PIECE):
        hi = min(len(data), lo + PIECE)
        before = min(lo, DEPTH)
        padded = np.zeros(DEPTH + hi - lo, np.uint64)
        padded[DEPTH - before :] = data[lo - before : hi]
        out = padded[DEPTH:].copy()
        for k in range(1, DEPTH + 1):
            out |= padded[DEPTH - k : len(padded) - k] << np.uint64(8 * k)
        starts = offsets[np.searchsorted(offsets, lo - DEPTH) : np.searchsorted(offsets, hi)]
        for k in range(DEPTH):
            near = starts + k
            out[near[(near >= lo) & (near < hi)] - lo] &= np.uint64((1 << (8 * k + 8)) - 1)
        yield lo, out


def _counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(x)
    starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
    return x[starts], np.diff(np.r_[starts, len(x)])


class Counter:
    """Counts of 64-bit keys, merged as they come."""

    def __init__(self):
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> bool:
        """Whether the counts have to be handed on."""
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > FLUSH:
            self.merge()
            return self.held > FLUSH * 3 // 4
        return False

    def merge(self) -> None:
        keys = np.concatenate([np.zeros(0, np.uint64), *self.keys])
        self.keys = []
        order = np.argsort(keys)
        keys = keys[order]
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts])
        self.counts = []
        counts = counts[order]
        del order
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.counts = [np.add.reduceat(counts, starts) if len(starts) else counts]
        self.keys, self.held = [keys[starts]], len(starts)

    def taken(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All merged counts, ``PIECE`` at a time; the counter is empty then."""
        self.merge()
        (keys,), (counts,) = self.keys, self.counts
        self.__init__()
        for lo in range(0, len(keys), PIECE):
            yield keys[lo : lo + PIECE], counts[lo : lo + PIECE]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one partition: kind 0 contexts (all documents' contexts; training counts), kind 1 words, kind 2 totals."""
    grams, words = Counter(), Counter()
    tokens = texts = 0

    def out(kind: int, counter: Counter) -> Iterator[pa.RecordBatch]:
        for keys, counts in counter.taken():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(counts)], ["kind", "key", "n"])

    for batch in batches:
        held = batch["held_out"].to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, data, offsets in _chunks(batch):
            own = np.repeat(held[lo:hi], np.diff(offsets))
            for at, g in context_grams(data, offsets):
                mine = own[at : at + len(g)]
                for part, train in ((g[~mine], 1), (g[mine], 0)):
                    keys, counts = _counted(part)
                    if grams.add(keys, counts * train):
                        yield from out(0, grams)
            w = Words(data, offsets)
            train = ~held[lo:hi]
            h = w.hashes()[np.repeat(train, np.diff(w.first))]
            if words.add(*_counted(h)):
                yield from out(1, words)
            tokens += len(h) + int(train.sum())
            texts += int(train.sum())
    yield from out(0, grams)
    yield from out(1, words)
    yield pa.RecordBatch.from_arrays([pa.array([2, 2], pa.int32()), pa.array([0, 1], pa.int64()), pa.array([tokens, texts], pa.int64())], ["kind", "key", "n"])


def _log_gamma(x: Column) -> Column:
    """Stirling's series eight steps up, for x >= 0.5."""
    up = x + 8
    steps = x
    for k in range(1, 8):
        steps = steps * (x + k)
    series = 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5)
    return (up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def _block(n0: Column, n1: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of a sequence with that many zeros and ones."""
    half = 2 * math.lgamma(0.5)
    return F.when(n0 + n1 == 0, F.lit(0.0)).otherwise(_log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - half - _log_gamma(n0 + n1 + 1.0))


def code_lengths(grams: DataFrame) -> DataFrame:
    """``key``, ``n``, ``value``: log10 probability of the byte after its context, from ``key``, ``n``; a written table."""
    bit = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("j")
    byte = F.col("key").bitwiseAND(255)
    prefix = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("j")).bitwiseOR(F.call_function("shiftright", byte, 8 - F.col("j")))
    one = F.call_function("shiftright", byte, 7 - F.col("j")).bitwiseAND(1)
    node = F.shiftright("key", 8) * 256 + prefix
    bits = grams.select("key", "n", bit).select("key", "n", one.alias("one"), node.alias("node"))
    level = bits.groupBy("node").agg(F.sum(F.col("n") * (1 - F.col("one"))).alias("n0"), F.sum(F.col("n") * F.col("one")).alias("n1"))
    level = written(level.withColumn("block", _block(F.col("n0"), F.col("n1"))).withColumn("whole", F.col("block")), f"ctw-{DEPTH}")
    levels = [level]
    for depth in range(DEPTH - 1, -1, -1):
        up = level.groupBy(F.col("node").bitwiseAND((1 << (8 * depth + 8)) - 1).alias("node"))
        up = up.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("whole").alias("below"))
        up = up.withColumn("block", _block(F.col("n0"), F.col("n1")))
        top = F.greatest("block", "below")
        whole = math.log(0.5) + top + F.log(F.exp(F.col("block") - top) + F.exp(F.col("below") - top))
        level = written(up.withColumn("whole", whole).select("node", "n0", "n1", "block", "whole"), f"ctw-{depth}")
        levels.append(level)
    held = list(levels)
    said = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    stop = F.exp(math.log(0.5) + F.col("block") - F.col("whole"))
    path = levels.pop().select("node", (stop * said).alias("mixed"), (1 - stop).alias("left"))
    for depth in range(1, DEPTH + 1):
        own = levels.pop().withColumn("up", F.col("node").bitwiseAND((1 << (8 * depth)) - 1))
        own = own.join(path.withColumnRenamed("node", "up"), "up")
        share = stop if depth < DEPTH else F.lit(1.0)
        path = own.select("node", (F.col("mixed") + F.col("left") * share * said).alias("mixed"), (F.col("left") * (1 - share)).alias("left"))
    bits = bits.join(path, "node")
    chance = F.when(F.col("one") == 1, F.col("mixed")).otherwise(1 - F.col("mixed"))
    lengths = written(bits.groupBy("key").agg(F.first("n").alias("n"), F.sum(F.log10(chance)).alias("value")), "ctw-lengths")
    for level in held:
        dropped(level)
    return lengths


class Lookup:
    """Values of distinct 64-bit keys: an open hash table holds their places in the two arrays, which are not copied."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        home = ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)
        order = np.argsort(home)
        at = home[order] - np.arange(len(keys))
        at = np.maximum.accumulate(at) + np.arange(len(keys))  # its own slot, or the one after the key before it
        self.slots = np.full(max(1 << bits, int(at[-1]) + 1 if len(at) else 0) + 1, -1, np.int32)
        self.slots[at] = order

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where absent) and whether each key is there."""
        out, known = np.zeros(len(keys)), np.zeros(len(keys), bool)
        at = ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)
        slot = self.slots[at]
        todo = np.flatnonzero(slot >= 0)
        slot = slot[todo]
        while len(todo):
            hit = self.keys[slot] == keys[todo]
            out[todo[hit]], known[todo[hit]] = self.values[slot[hit]], True
            todo = todo[~hit]
            at[todo] += 1
            slot = self.slots[at[todo]]
            todo, slot = todo[slot >= 0], slot[slot >= 0]
        return out, known


def _summed(look: Lookup, pieces: Iterator[tuple[int, np.ndarray]], bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """Sums of the values of ``keys[bounds[i]:bounds[i + 1]]``, how many are known, and those that are not; keys come in pieces with their place."""
    rows = len(bounds) - 1
    total, found, absent = np.zeros(rows), np.zeros(rows, np.int64), [np.zeros(0, np.int64)]
    for at, keys in pieces:
        values, known = look(keys)
        first, last = np.searchsorted(bounds, at, "right") - 1, np.searchsorted(bounds, at + len(keys))
        own = np.clip(bounds[first : last + 1] - at, 0, len(keys))
        sums, hits = np.r_[0.0, np.cumsum(values)], np.r_[0, np.cumsum(known)]
        total[first:last] += sums[own[1:]] - sums[own[:-1]]
        found[first:last] += hits[own[1:]] - hits[own[:-1]]
        absent.append(keys[~known].view(np.int64))
    cut = np.r_[0, np.cumsum(np.diff(bounds) - found)]
    return total, found, pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(np.concatenate(absent)))


def _head(table: DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    """Keys and values of the most frequent rows, ``HEAD`` at most, and whether rows are left. Equal counts go together."""
    sizes = table.groupBy("n").agg(F.count("*").alias("rows")).orderBy(F.desc("n")).limit(HEAD).toArrow()  # as arrays, not as rows
    counts, rows = sizes["n"].to_numpy(), sizes["rows"].to_numpy()
    whole = int(np.searchsorted(np.cumsum(rows), HEAD, "right"))
    part = table.where(F.col("n") >= int(counts[whole - 1])) if whole else table.limit(0)
    part = part.select("key", "value").toArrow()
    return part["key"].to_numpy().view(np.uint64), part["value"].to_numpy(), whole < len(rows) or len(rows) == HEAD


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_gram, by_word = (Lookup(*pair) for pair in shared.value)
        context = TaskContext.get()
        serial = (context.partitionId() if context else 0) << 40
        for batch in batches:
            for lo, hi, data, offsets in _chunks(batch):
                w = Words(data, offsets)
                gram_sum, _, grams = _summed(by_gram, context_grams(data, offsets), offsets)
                word_sum, known, words = _summed(by_word, iter([(0, w.hashes())]), w.first)
                row = pa.array(serial + np.arange(hi - lo))
                serial += hi - lo
                arrays = [row, *(batch[k].slice(lo, hi - lo) for k in ("doc_id", "held_out")), *map(pa.array, (np.diff(w.first), known, word_sum, gram_sum)), words, grams]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "held_out", "n_words", "known", "word_sum", "gram_sum", "words", "grams"])

    return run


def model_scores(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """Scores of each row of ``docs`` (``doc_id``, ``text``): A-Z lower-cased, null as empty.

    Rows where ``held`` is true are scored without being learned from (by default those whose crc32 of the id leaves 1
    modulo 5; a row without an id is learned from). ``n_tokens`` counts words and one end; ``base_score`` is the sum of
    log10((c + 0.5) / (N + 0.5 (V + 1))) over tokens; ``score`` the model's log10 probability of the text's bytes (0
    for an empty text). Without training rows every bit counts as even. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", (held_out(F.col("doc_id"), 5, 1) if held is None else F.coalesce(held, F.lit(False))).alias("held_out"))
    counts = rows.select("text", "held_out").mapInArrow(tidy(_gather), "kind int, key long, n long")
    counts = written(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "ctw-counts")
    totals = {r["key"]: r["n"] for r in counts.where("kind = 2").collect()}
    tokens, ends = totals.get(0, 0), totals.get(1, 0)
    words = counts.where("kind = 1").select("key", "n", F.log10(F.col("n") + 0.5).alias("value"))
    distinct = words.count() + (1 if ends else 0)
    grams = code_lengths(counts.where("kind = 0").select("key", "n"))
    gram_keys, gram_values, more_grams = _head(grams)
    word_keys, word_values, _ = _head(words)
    shared = spark.sparkContext.broadcast(((gram_keys, gram_values), (word_keys, word_values)))
    schema = "row long, doc_id long, held_out boolean, n_words long, known long, word_sum double, gram_sum double, words array<long>, grams array<long>"
    out = written(rows.mapInArrow(tidy(_scored(shared)), schema), "ctw-scored")

    def rest(column: str, table: DataFrame, absent: float) -> DataFrame:
        """Sums over what the head lacks: entries counted per row, joined with the table, added up."""
        asked = out.select("row", F.explode(column).alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
        met = asked.join(table.select("key", "value"), "key", "left")
        total = F.sum(F.col("times") * F.coalesce("value", F.lit(absent))).alias(f"{column}_more")
        return met.groupBy("row").agg(total, F.sum(F.when(F.col("value").isNotNull(), F.col("times")).otherwise(0)).alias(f"{column}_known"))

    out_words = rest("words", words, math.log10(0.5))
    full = out.drop("words", "grams").join(out_words, "row", "left")
    if more_grams:
        full = full.join(rest("grams", grams, 8 * math.log10(0.5)), "row", "left")
    else:
        full = full.withColumn("grams_more", F.lit(0.0))
    whole = F.log10(F.lit(tokens + 0.5 * (distinct + 1)))
    n_tokens = F.col("n_words") + 1
    base = F.col("word_sum") + F.coalesce("words_more", F.lit(0.0)) + F.lit(math.log10(ends + 0.5)) - n_tokens * whole
    score = F.col("gram_sum") + F.coalesce("grams_more", F.lit(0.0))
    known = F.col("known") + F.coalesce("words_known", F.lit(0)) + F.lit(1 if ends else 0)
    return full.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), known.alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), score.alias("score"),
    )


def op8_ctw_score(spark, sf_dir: str) -> DataFrame:
    """A row for each of ``documents``: base and context-tree code lengths, null texts as empty, held-out ones by crc32 of the id."""
    return model_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
