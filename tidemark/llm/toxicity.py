"""Toxicity by compression distance with two zstandard dictionaries.

zstandard's trainer makes one dictionary from windows of ordinary text and another from toxic text: from the runs of
it that toxic texts hold significantly more often than ordinary ones, since most words of a toxic text are ordinary.
Each window of a text is compressed with the ordinary dictionary alone and with the toxic one before it, so that what
is ordinary in a window takes the same bytes both ways and the difference is what the toxic dictionary saves. A text's
features count its windows by how much they save, against several thresholds. A logistic model of these counts is
calibrated on texts that its dictionaries did not see (each third of the sample is scored by dictionaries of the rest),
and shifted so that ``THRESHOLD`` is the best cut of those that leave ``CLEAN`` of these ordinary texts alone.

The model is fitted on a bounded sample of labelled rows (``TOXIC_ROWS`` and ``ORDINARY_ROWS``, taken by hash of the
doc_id among those with a text, at most ``FIT_BYTES`` a class); scoring is one narrow pass over all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import LOWER, mixed, row_runs, tidy
from .storage import is_empty, unused

TOXIC_ROWS = 1500
ORDINARY_ROWS = 2500
#: Bytes of sampled texts of a class at most: texts of any length, in the order of the hash, that the rest of it holds.
FIT_BYTES = 6 << 20
#: Texts of a class without which there is no model.
LEAST = 6
#: Lengths of the byte pieces that are compared between the classes, and the least log-likelihood ratio of a toxic one.
PIECES = (6, 8)
SIGNIFICANT = 25.0
TOXIC_BYTES = 1000
ORDINARY_BYTES = 8192
WINDOW = 48
SAVINGS = (1, 2, 3, 4, 6)
THRESHOLD = 0.3
FOLDS = 3
#: Share of unseen ordinary texts of the sample below the threshold, at least.
CLEAN = 0.97
#: A text is a copy in the sample if it shares so many of its ``SKETCH`` least hashes of five-word runs with an earlier one.
SKETCH = 16
COPY = 0.5
_GAPS = re.compile(rb"[\x20\x09-\x0D]+")
_LOWER = bytes(LOWER)
_MULTIPLIER = np.uint64(0xA0761D6478BD642F)
#: The three repeat offsets that end the tables of every trained dictionary; its content follows.
_OFFSETS = b"\1\0\0\0\4\0\0\0\x08\0\0\0"


def held_out(doc_id: Column, modulus: int = 4, remainder: int = 2) -> Column:
    """Whether crc32 of the id as text leaves that remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def flattened(text: bytes) -> bytes:
    return b" " + _GAPS.sub(b" ", text.translate(_LOWER)).strip(b" ") + b" "


def windows(text: bytes) -> Iterator[bytes]:
    """Runs of whole words of ``WINDOW`` bytes or a little more, each with the blank before it; a longer word is a window of its own."""
    flat = flattened(text)
    at, end = 1, len(flat)
    while at < end:
        stop = flat.find(b" ", min(end - 1, at + WINDOW)) + 1
        yield flat[at - 1 : stop]
        at = stop


def distinct_texts(flat: list[bytes]) -> list[int]:
    """Places of the texts that are no near copies of earlier ones: copies would make chance pieces look significant."""
    holders: dict[int, list[int]] = {}
    out = []
    for i, t in enumerate(flat):
        words = t.split()
        least = sorted({zlib.crc32(b" ".join(words[k : k + 5])) for k in range(max(1, len(words) - 4))})[:SKETCH]
        met = Counter(j for h in least for j in holders.get(h, ()))
        if max(met.values(), default=0) < COPY * len(least):
            out.append(i)
            for h in least:
                holders.setdefault(h, []).append(i)
    return out


def _piece_hashes(flat: bytes, n: int) -> np.ndarray:
    data = np.frombuffer(flat, np.uint8)
    out = np.zeros(max(0, len(data) - n + 1), np.uint64)
    for k in range(n):
        out = out * _MULTIPLIER + data[k : k + len(out)]
    return mixed(out)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes.sort()
    return hashes[np.r_[True, hashes[1:] != hashes[:-1]]] if len(hashes) else hashes


class Pieces:
    """In which texts of the sample each piece occurs that at least three toxic ones hold."""

    def __init__(self, flat: list[bytes], toxic: np.ndarray):
        self.toxic, self.keys, self.held = toxic, {}, {}
        for n in PIECES:
            own = {i: _distinct(_piece_hashes(flat[i], n)) for i in np.flatnonzero(toxic).tolist()}
            keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *own.values()]), return_counts=True)
            self.keys[n] = keys = keys[counts >= 3]
            self.held[n] = [self._places(keys, own[i] if i in own else _distinct(_piece_hashes(t, n))) for i, t in enumerate(flat)]

    @staticmethod
    def _places(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
        return at[keys[at] == hashes].astype(np.int32) if len(keys) else np.zeros(0, np.int32)

    def significant(self, n: int, used: np.ndarray) -> np.ndarray:
        """Hashes of pieces that more of the used toxic than ordinary texts hold, by the log-likelihood ratio of the 2 x 2 table."""
        total = [int((used & (self.toxic == y)).sum()) for y in (1, 0)]
        none = np.zeros(0, np.int32)
        counts = [np.bincount(np.concatenate([none, *(self.held[n][i] for i in np.flatnonzero(used & (self.toxic == y)))]), minlength=len(self.keys[n])) for y in (1, 0)]
        both, ratio = counts[0] + counts[1], np.zeros(len(self.keys[n]))
        for seen, of in zip(counts, total, strict=True):
            for x, expected in ((seen, both * of / sum(total)), (of - seen, (sum(total) - both) * of / sum(total))):
                ratio += 2 * np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(expected, 1e-9)), 0)
        return self.keys[n][(ratio >= SIGNIFICANT) & (counts[0] * total[1] > counts[1] * total[0])]


def runs_of(flat: bytes, wanted: dict[int, np.ndarray]) -> list[bytes]:
    """The parts of a text that wanted pieces cover."""
    step = np.zeros(len(flat) + 1, np.int32)
    for n, keys in wanted.items():
        hashes = _piece_hashes(flat, n)
        if len(keys) and len(hashes):
            at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)] == hashes)
            np.add.at(step, at, 1)
            np.add.at(step, at + n, -1)
    covered = np.diff((np.cumsum(step) > 0).astype(np.int8), prepend=np.int8(0))
    return [flat[a:b] for a, b in zip(np.flatnonzero(covered == 1).tolist(), np.flatnonzero(covered == -1).tolist(), strict=True)]


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary by zstandard's trainer, in segments of that size; where samples are too few for it, the distinct samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6, f=20, level=1).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


def _content(dictionary: bytes) -> int:
    """Where the content of a dictionary begins, after the tables if it has any."""
    return dictionary.index(_OFFSETS) + len(_OFFSETS) if dictionary[:4] == b"\x37\xa4\x30\xec" else 0


def train_toxic(flat: list[bytes], pieces: Pieces, used: np.ndarray) -> bytes:
    """The toxic dictionary's content, from the distinct telling runs of the used toxic texts.

    A run counts once: a language that says few things often would else leave no room to one that inflects what it says.
    """
    wanted = {n: pieces.significant(n, used) for n in PIECES}
    runs = dict.fromkeys(r for i in np.flatnonzero(used & (pieces.toxic == 1)) for r in runs_of(flat[i], wanted))
    toxic = _trained(list(runs), TOXIC_BYTES, 12)  # about as long as a run
    return toxic[_content(toxic) :]


def train_ordinary(flat: list[bytes], toxic: np.ndarray, used: np.ndarray, size: int) -> bytes:
    """The ordinary dictionary, from all windows of the used ordinary texts."""
    return _trained([w for i in np.flatnonzero(used & (toxic == 0)) for w in windows(flat[i])], size, 32) or b" the and of to "


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        min_match=3, strategy=zstandard.STRATEGY_BTOPT, window_log=17, hash_log=14, chain_log=14, search_log=5, target_length=32,
        write_content_size=False, write_dict_id=False, write_checksum=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=parameters)


def features(text: bytes, pair: tuple) -> np.ndarray:
    with_toxic, ordinary = pair
    saved = np.array([len(ordinary.compress(w)) - len(with_toxic.compress(w)) for w in windows(text)] or [0])
    return np.array([saved.max(), saved.mean(), *[np.log1p((saved >= k).sum()) for k in SAVINGS], (saved >= 2).mean(), (saved >= 4).mean(), np.log1p(len(saved))])


class Model:
    """Dictionaries and, once calibrated, the weights of the logistic model."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        at = _content(ordinary)
        self.toxic, self.ordinary = ordinary[:at] + toxic + ordinary[at:], ordinary
        self.mean = self.spread = self.weights = np.zeros(0)

    def compressors(self) -> tuple:
        return _compressor(self.toxic), _compressor(self.ordinary)

    def calibrate(self, x: np.ndarray, labels: np.ndarray) -> None:
        """Fit the weights on features of unseen texts and put the cut at ``THRESHOLD``."""
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
        a = np.c_[np.ones(len(x)), (x - self.mean) / self.spread]
        w = np.zeros(a.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            hessian = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(w))
            w += np.linalg.solve(hessian, a.T @ (labels - p) - 0.1 * w)
        z = np.clip(a @ w, -30, 30)
        cuts = np.unique(z)
        cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
        clean = np.searchsorted(np.sort(z[labels == 0]), cuts) / (labels == 0).sum()
        caught = 1 - np.searchsorted(np.sort(z[labels == 1]), cuts) / (labels == 1).sum()
        right = np.where(clean >= CLEAN, caught + clean, clean - 1)
        w[0] += np.log(THRESHOLD / (1 - THRESHOLD)) - cuts[np.argmax(right)]
        self.weights = w

    def score(self, x: np.ndarray) -> np.ndarray:
        a = np.c_[np.ones(len(x)), (x - self.mean) / self.spread]
        chance = 1 / (1 + np.exp(-np.clip(a @ self.weights, -30, 30)))
        # without a window that saves a byte there is no evidence
        return np.where(x[:, 0] > 0, chance, np.minimum(chance, THRESHOLD / 2))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from a bounded sample of the labelled rows that are not held out; None if there are no labels or no documents.

    A doc_id with both labels is left out; of rows that share a doc_id the shortest text, then the first, is taken.
    Raises ValueError if labels exist but a class has under ``LEAST`` texts, rather than let every text pass.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("also")).where("toxic = also").drop("also")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts or is_empty(docs):
        return None
    by_hash = F.xxhash64("doc_id")
    texts = docs.where("text is not null").select("doc_id", "text", F.octet_length("text").alias("size"))
    usable = texts.select("doc_id", "size").join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.min("size").alias("size"))
    picked = []
    for label, most in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS)):
        left, n = FIT_BYTES, 0
        for r in usable.where(F.col("toxic") == label).orderBy(by_hash, "doc_id").limit(most).collect():  # ids and sizes only
            if r["size"] <= left:
                left, n = left - r["size"], n + 1
                picked.append((r["doc_id"], label, r["size"]))
        if n < LEAST:
            raise ValueError(f"labels exist, but only {n} texts of class {label} fit the sample; a model needs {LEAST}")
    # an Arrow table: rows would start Python workers of another kind in every executor
    ids, classes, sizes = zip(*picked, strict=True)
    sample = docs.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(ids, pa.int64()), "toxic": pa.array(classes, pa.int32()), "size": pa.array(sizes, pa.int32())}))
    rows = texts.join(F.broadcast(sample), ["doc_id", "size"]).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    table = rows.toArrow()
    order = np.argsort([zlib.crc32(f"fit{i}".encode()) for i in table["doc_id"].to_pylist()], kind="stable")
    flat = [flattened(t.encode()) for t in table["text"].take(order).to_pylist()]
    toxic = np.array(table["toxic"].take(order).to_pylist())
    first = distinct_texts(flat)
    if all((toxic[first] == y).sum() * 2 >= (toxic == y).sum() for y in (0, 1)):  # a sample that is mostly copies stays as it is
        flat, toxic = [flat[i] for i in first], toxic[first]
    fold = np.zeros(len(flat), np.int64)
    for y in (0, 1):
        fold[toxic == y] = np.arange((toxic == y).sum()) % FOLDS
    pieces = Pieces(flat, toxic)
    parts = [train_toxic(flat, pieces, fold != k) for k in range(FOLDS + 1)]  # the last from all texts
    x: list = [None] * len(flat)
    for k in range(FOLDS):
        pair = Model(parts[k], train_ordinary(flat, toxic, fold != k, ORDINARY_BYTES)).compressors()
        for i in np.flatnonzero(fold == k):
            x[i] = features(flat[i], pair)
    model = Model(parts[FOLDS], train_ordinary(flat, toxic, fold >= 0, ORDINARY_BYTES))
    model.calibrate(np.array(x), toxic)
    return model


def _scores(texts: Iterator[pa.Array], model: Model) -> Iterator[pa.Array]:
    """Scores of all texts, of about a megabyte of them at a time: a batch may hold many, and as Python strings they would be held twice."""
    pair = model.compressors()
    for column in texts:
        for lo, hi in row_runs(column):
            x = [features((t or "").encode(), pair) for t in column.slice(lo, hi - lo).to_pylist()]
            yield pa.array(model.score(np.array(x)), pa.float64())


def scored(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` in 0..1, in place of one that has this name. Null and empty texts, like any text without savings, score half of ``THRESHOLD`` at most; without a model all score 0.

    Only the text is read; rows are neither joined nor moved, and other columns pass through untouched.
    """
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run = tidy(lambda texts: _scores(texts, shared.value))
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(name, F.arrow_udf(run, "double")("text"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` but for the rows that score ``THRESHOLD`` or more, in the columns that it has, a ``score`` among them left as it is."""
    name = unused(docs, "score")
    return scored(docs, fit(docs, labels), name).where(F.col(name) < THRESHOLD).drop(name)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """A row for each of ``documents``: its score and whether it reaches ``THRESHOLD``; null and empty texts don't, repeated rows score alike, other columns are ignored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
