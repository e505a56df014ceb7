"""Audit of how sources diverge in their terms, with late materialisation of the strings.

Terms are hashed where their texts are read, and only fixed-width digests are counted, exchanged and joined. A digest may stand
for several terms: for those that are common enough to matter, the least and the greatest string are found in a second
pass over the texts; where they differ, the digest is split and its terms are counted by their strings. Text is joined
back to what is put out, and to nothing else.

Counts are sparse (a source has few of all terms), and the sum over all terms for a pair of sources is put together from
what is left of that: terms of one source against the other's value for an absent term (a histogram of counts a source),
a correction for terms that both have, and the same value for all that neither has. Everything is exact in integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import LOWER, Words, buffers
from .cells import grouped_batches, near_pairs
from .storage import is_empty, written

SCALE = 10**9
LEAST_DOCUMENTS = 10
TOP = 10
#: Digests (8 bytes each) that tasks look up, at most; beyond that all terms leave the tasks, once a task, and are joined.
LOOKED_UP = 1_000_000
#: Bytes of text that are taken at once, and entries that a task holds before it hands them on.
CHUNK, HELD = 4 << 20, 1 << 21

GROUP = ["lang", "source"]
KEY = ["digest", "split"]

#: Bytes of terms, A-Z lower-cased; what is no part of a term (ASCII but for letters) is a blank.
_TERM = LOWER.copy()
_TERM[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20


def term_chunks(texts: pa.Array, bits: int) -> Iterator[tuple[int, int, Words, np.ndarray]]:
    """Rows ``lo:hi`` at a time with their terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` and these terms' digests."""
    data, offsets = buffers(texts)
    lo = 0
    while lo < len(offsets) - 1:
        hi = min(len(offsets) - 1, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, "right")) - 1))
        terms = Words(_TERM[data[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo])
        yield lo, hi, terms, terms.hashes() & np.uint64((1 << bits) - 1)
        lo = hi


def _strings(terms: Words, at: np.ndarray) -> list[str]:
    raw = terms.data.tobytes()
    return [raw[a:b].decode() for a, b in zip(terms.starts[at].tolist(), terms.ends[at].tolist(), strict=True)]


def _same(terms: Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether terms i and j are the same bytes, pair by pair."""
    size = (terms.ends - terms.starts)[i]
    same = size == (terms.ends - terms.starts)[j]
    i, j, size = i[same], j[same], size[same]
    first = np.cumsum(size) - size
    step = np.arange(int(size.sum())) - np.repeat(first, size)
    equal = terms.data[np.repeat(terms.starts[i], size) + step] == terms.data[np.repeat(terms.starts[j], size) + step]
    same[same] = np.logical_and.reduceat(equal, first) if len(first) else np.zeros(0, bool)
    return same


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by the keys, and where in it each distinct combination starts."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(new)


def _counts(bits: int):
    """``lang``, ``source``, ``digest``, ``n`` (occurrences), ``docs`` (documents) of each partition's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        parts: list[tuple[np.ndarray, ...]] = []

        def merged() -> tuple[np.ndarray, ...]:
            group, digest, n, docs = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(4))
            order, starts = _runs(group, digest)
            if not len(order):
                return group, digest.astype(np.uint64), n, docs
            return group[order][starts], digest[order][starts], np.add.reduceat(n[order], starts), np.add.reduceat(docs[order], starts)

        def out() -> pa.RecordBatch:
            group, digest, n, docs = merged()
            langs, sources = (pa.array([k[c] for k in names], pa.string()).take(pa.array(group)) for c in (0, 1))
            names.clear()
            parts.clear()
            return pa.RecordBatch.from_arrays([langs, sources, pa.array(digest.view(np.int64)), pa.array(n), pa.array(docs)], [*GROUP, "digest", "n", "docs"])

        for batch in batches:
            for lo, hi, terms, digests in term_chunks(batch["text"], bits):
                pairs = zip(batch["lang"].slice(lo, hi - lo).to_pylist(), batch["source"].slice(lo, hi - lo).to_pylist(), strict=True)
                group_of = np.array([names.setdefault(p, len(names)) for p in pairs], np.int64)
                row = terms.row_of()
                order, starts = _runs(row, digests)
                times = np.diff(np.r_[starts, len(order)])
                row, digests = row[order][starts], digests[order][starts]
                parts.append((group_of[row], digests, times, np.ones(len(row), np.int64)))
                if sum(len(p[0]) for p in parts) > HELD:
                    parts[:] = [merged()]
                    if len(parts[0][0]) > HELD // 2:
                        yield out()
        if parts:
            yield out()

    return run


def _behind(bits: int, wanted: np.ndarray | None):
    """``digest``, ``term``: each string that a partition has for a wanted digest (all, if None), at least once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, str] = {}
        more: list[tuple[int, str]] = []

        def out() -> pa.RecordBatch:
            rows = [*known.items(), *more]
            known.clear()
            more.clear()
            return pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], ["digest", "term"])

        for batch in batches:
            for _, _, terms, digests in term_chunks(batch["text"], bits):
                digests = digests.view(np.int64)
                at = np.arange(len(digests)) if wanted is None else np.flatnonzero(_among(digests, wanted))
                if not len(at):
                    continue
                order, starts = _runs(digests[at])
                first = np.repeat(at[order][starts], np.diff(np.r_[starts, len(order)]))
                other = at[order][~_same(terms, at[order], first)]
                for d, t in zip(digests[at[order][starts]].tolist(), _strings(terms, at[order][starts]), strict=True):
                    if known.setdefault(d, t) != t:
                        more.append((d, t))
                more.extend(set(zip(digests[other].tolist(), _strings(terms, other), strict=True)))
                if len(known) + len(more) > HELD:
                    yield out()
        if known:
            yield out()

    return run


def _among(x: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted):
        return np.zeros(len(x), bool)
    return wanted[np.minimum(np.searchsorted(wanted, x), len(wanted) - 1)] == x


def _by_string(bits: int, wanted: np.ndarray | None):
    """``lang``, ``source``, ``digest``, ``split``, ``n``, ``docs`` for the terms of wanted digests, by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, sources = batch["lang"].to_pylist(), batch["source"].to_pylist()
            for lo, _, terms, digests in term_chunks(batch["text"], bits):
                digests = digests.view(np.int64)
                at = np.arange(len(digests)) if wanted is None else np.flatnonzero(_among(digests, wanted))
                held = Counter(zip((terms.row_of()[at] + lo).tolist(), digests[at].tolist(), _strings(terms, at), strict=True))
                n: Counter = Counter()
                docs: Counter = Counter()
                for (row, digest, term), times in held.items():
                    n[langs[row], sources[row], digest, term] += times
                    docs[langs[row], sources[row], digest, term] += 1
                columns = list(zip(*((*k, v, docs[k]) for k, v in n.items()), strict=True)) or [()] * 6
                kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*GROUP, *KEY, "n", "docs"])

    return run


def _filled(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*GROUP, "text")])


def _looked_up(digests: DataFrame) -> np.ndarray | None:
    """The digests, sorted, if they are few enough to be looked up in tasks."""
    if digests.limit(LOOKED_UP + 1).count() > LOOKED_UP:
        return None
    return np.sort(digests.toArrow()["digest"].to_numpy())


def _counted(docs: DataFrame, bits: int, least_documents: int) -> tuple[DataFrame, DataFrame]:
    """Counts of kept terms by group (``digest``, ``split``, ``n``, ``lang_n``), and the text of each (digest, split).

    ``split`` is the term itself where its digest stands for several, else empty; a term never is.
    """
    sums = (F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = docs.mapInArrow(_counts(bits), "lang string, source string, digest long, n long, docs long")
    counts = written(counts.groupBy(*GROUP, "digest").agg(*sums), "divergence-counts")
    enough = F.sum("docs") >= least_documents
    kept = counts.groupBy("lang", "digest").agg(F.sum("n").alias("lang_n"), enough.alias("kept")).where("kept").drop("kept")
    kept = written(kept.withColumn("split", F.lit("")), "divergence-kept")
    wanted = kept.select("digest").distinct()
    known = _looked_up(wanted)
    texts = docs.select("text").mapInArrow(_behind(bits, known), "digest long, term string")
    texts = texts.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("greatest"))
    texts = written(texts if known is not None else texts.join(wanted, "digest", "left_semi"), "divergence-texts")
    counts = counts.withColumn("split", F.lit(""))
    shared = texts.where("least <> greatest").select("digest")
    names = texts.select("digest", F.lit("").alias("split"), F.col("least").alias("term"))
    if not is_empty(shared):
        # rare: the terms of these digests are counted again, by their strings
        again = docs.mapInArrow(_by_string(bits, _looked_up(shared)), "lang string, source string, digest long, split string, n long, docs long")
        again = written(again.join(shared, "digest", "left_semi").groupBy(*GROUP, *KEY).agg(*sums), "divergence-split")
        counts = counts.join(shared, "digest", "left_anti").unionByName(again)
        split = again.groupBy("lang", *KEY).agg(F.sum("n").alias("lang_n"), enough.alias("kept")).where("kept").drop("kept")
        kept = kept.join(shared, "digest", "left_anti").unionByName(split)
        names = names.join(shared, "digest", "left_anti").unionByName(again.select(*KEY, F.col("split").alias("term")).distinct())
    return written(counts.drop("docs").join(kept, ["lang", *KEY]), "divergence-terms"), names


def _share(n: Column, total: Column, v: Column) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * v))``; null where there are no terms."""
    wide = lambda c: c.cast("decimal(38,0)")
    at = F.call_function("div", wide(wide(n + 2) * F.lit(SCALE)), wide(F.nullif(total + 2 * v, F.lit(0).cast("long"))))
    return at + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _apart_numbers(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For pairs of groups, what terms of both add to the sums that take the other's value as that of an absent term."""
    for table, group in grouped_batches(batches, ["lang_id", *KEY]):
        gid, p, absent = (table[c].to_numpy() for c in ("gid", "p", "absent"))
        ids, at = np.unique(gid, return_inverse=True)
        for i, j in near_pairs(group):
            more = _apart_numbers(p[i], p[j]) - _apart_numbers(p[i], absent[j]) - _apart_numbers(absent[i], p[j]) + _apart_numbers(absent[i], absent[j])
            pair, where = np.unique(at[i] * len(ids) + at[j], return_inverse=True)
            sums = np.zeros(len(pair), np.int64)
            np.add.at(sums, where, more)
            yield pa.RecordBatch.from_arrays([pa.array(ids[pair // len(ids)]), pa.array(ids[pair % len(ids)]), pa.array(sums)], ["a", "b", "value"])


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``gid``, ``item``, ``value``: each group against each other source of its language."""
    columns = "a long, b long, value long"
    both = terms.select("lang_id", *KEY, "gid", "p", "absent").repartition("lang_id", "digest").sortWithinPartitions("lang_id", *KEY, "gid")
    both = both.mapInArrow(_shared_terms, columns)
    of_count = terms.groupBy("gid", "p").agg(F.count("*").alias("n")).groupBy("gid").agg(F.collect_list(F.struct("p", "n")).alias("own"), F.sum("n").alias("own_terms"))
    own = groups.join(of_count, "gid", "left").select("lang_id", "gid", "v", "absent", F.coalesce("own", F.array().cast("array<struct<p:bigint,n:bigint>>")).alias("own"), F.coalesce("own_terms", F.lit(0).cast("long")).alias("own_terms"))
    other = own.select("lang_id", F.col("gid").alias("o_gid"), F.col("absent").alias("o_absent"), F.col("own_terms").alias("o_terms"))
    # sources against sources are the rows of the result
    met = own.join(other, "lang_id").where("gid <> o_gid")
    half = F.aggregate("own", F.lit(0).cast("long"), lambda acc, h: acc + _apart(h["p"], F.col("o_absent")) * h["n"])
    neither = F.when(F.col("gid") < F.col("o_gid"), (F.col("v") - F.col("own_terms") - F.col("o_terms")) * _apart(F.col("absent"), F.col("o_absent"))).otherwise(0)
    one_sided = met.select(F.least("gid", "o_gid").alias("a"), F.greatest("gid", "o_gid").alias("b"), F.coalesce(half + neither, F.lit(0)).cast("long").alias("value"))
    sums = one_sided.unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("gid"), F.col("b").alias("o_gid")), F.struct(F.col("b").alias("gid"), F.col("a").alias("o_gid")))).alias("w")
    return sums.select(ways, "value").select("w.*", "value").join(groups.select(F.col("gid").alias("o_gid"), F.col("source").alias("item")), "o_gid").select("gid", "item", "value")


def divergences(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP, bits: int = 64) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` from documents with ``text``, ``lang`` and ``source``.

    Nulls in the three columns are empty strings, and an empty language or source is one like any other. Terms are kept
    by language, in at least ``least_documents`` of its documents (rows; repeated ones count). Part ``pair`` compares each
    group (language, source) with each other source of its language over all kept terms, 0 where there are none; part
    ``term`` has the ``top`` terms more frequent in a group than in its language. ``bits`` is the width of digests; any gives the
    same rows. Equal values rank by UTF-8. A language
    with one source has no pairs; empty input has no rows. Other columns are ignored.
    """
    docs = _filled(docs)
    counts, names = _counted(docs, bits, least_documents)
    totals = counts.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    of_lang = counts.select("lang", *KEY, "lang_n").distinct().groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = docs.groupBy(*GROUP).agg(F.lit(0).alias("none")).drop("none").join(totals, GROUP, "left").join(of_lang, "lang", "left")
    groups = groups.select(*GROUP, *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "v", "lang_total")])
    groups = groups.withColumn("gid", F.monotonically_increasing_id()).withColumn("absent", _share(F.lit(0).cast("long"), F.col("total"), F.col("v")))
    groups = written(groups, "divergence-groups")
    groups = groups.join(groups.groupBy("lang").agg(F.min("gid").alias("lang_id")), "lang")
    terms = counts.join(groups, GROUP).withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
    pairs = _pairs(terms, groups).select("gid", F.lit("pair").alias("part"), "item", "value")
    above = terms.withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).where("p > q").select("gid", *KEY, _apart(F.col("p"), F.col("q")).alias("value"))
    # ranks with ties first, on digests; only what may be put out gets its text
    best = above.withColumn("r", F.rank().over(Window.partitionBy("gid").orderBy(F.col("value").desc()))).where(F.col("r") <= top)
    best = best.join(names, KEY).select("gid", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("gid", "part").orderBy(F.col("value").desc(), "item")
    ranked = pairs.unionByName(best).withColumn("rank", F.row_number().over(order).cast("int")).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.join(groups.select("gid", *GROUP), "gid").select(*GROUP, "part", "item", "value", "rank")


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    """How the sources of each language of ``documents`` diverge: in pairs, and by their most telling terms."""
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
with docs as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), occurrences as (
  select doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), kept as (
  select lang, term, count(*)::hugeint as lang_n from occurrences group by lang, term having count(distinct doc) >= 10
), groups as (
  select distinct lang, source from docs
), counts as (
  select lang, source, term, count(*)::hugeint as n from occurrences group by lang, source, term
), filled as (
  select g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0)::hugeint as n
  from groups g join kept k on g.lang = k.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), shares as (
  select lang, source, term, n,
    1 + 1000000000::hugeint * (n + 2) // (sum(n) over (partition by lang, source) + 2 * count(*) over (partition by lang, source))::hugeint as p,
    1 + 1000000000::hugeint * (lang_n + 2) // (sum(lang_n) over (partition by lang, source) + 2 * count(*) over (partition by lang, source))::hugeint as q
  from filled
), pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), terms as (
  select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from shares where n > 0 and p > q
), parts as (
  select g.lang, g.source, 'pair' as part, o.source as item, coalesce(value, 0) as value
  from groups g join groups o on g.lang = o.lang and g.source <> o.source
  left join pairs p on p.lang = g.lang and p.source = g.source and p.item = o.source
  union all select lang, source, 'term', item, value from terms
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from parts
)
select lang, source, part, item, value::bigint as value, rank from ranked where part = 'pair' or rank <= 10
"""
