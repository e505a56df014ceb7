"""Mixing sources to target weights, in DataFrame functions only.

Tokens are counted per source (partial sums first, so a source that holds a third of all rows costs nothing extra),
targets follow from the weights, and a document is emitted ``floor(rate)`` times plus one Bernoulli copy whose
probability is the fraction. The Bernoulli draw hashes the seed and the document's id: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import unused, written

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: Source tables of up to so many rows (about 60 bytes each) are broadcast; larger ones are joined by a shuffle, whose
#: hot keys adaptive execution splits.
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null.

    With separators alone kept, a word is a gap in them: each run of other characters becomes one letter.
    """
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), r"[^w]+", "")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows with ``source`` and ``size``.

    Sources by code point (null last) get the weights in turn. A target stops at ``most_repeats`` times its source's
    size and the excess goes to the others by weight until none is above. That end point is one level ``l`` with
    ``target = min(cap, l * weight)``: in the order of cap / weight the level at each source is what is left after
    all caps before it, shared among the weights from it on, and the first one that its source can't exceed holds.
    The windows run over the table of sources, one row each, not over documents.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most_repeats).cast("long"))
    ratio = F.col("cap") / F.col("weight")
    before = Window.orderBy(ratio.asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumn("ratio", ratio).withColumn("level", left / weights_left)
    level = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))).over(whole)
    target = F.least(F.col("cap").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return ranked.withColumn("target", target).select("source", "source_size", "target")


MIXED = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def _taken(docs: DataFrame, names: tuple[str, ...], weights: tuple[int, ...], most_repeats: int, seed: int) -> DataFrame:
    """``docs`` with size, source size, target and copies under ``names``, which ``docs`` has not."""
    size, source_size, target, copies = names
    sized = docs.withColumn(size, word_count(F.col("text")))
    plan = source_targets(sized.select("source", F.col(size).alias("size")), weights, most_repeats)
    key = unused(sized, "mix_source")
    plan = written(plan.select(F.col("source").alias(key), F.col("source_size").alias(source_size), F.col("target").alias(target)), "mix")
    if plan.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        plan = F.broadcast(plan)
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    n = F.floor(rate) + F.when(draw < rate - F.floor(rate), F.lit(1)).otherwise(F.lit(0))
    return sized.join(plan, F.col("source").eqNullSafe(F.col(key))).withColumn(copies, n.cast("long")).drop(key)


def with_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS, seed: int = 17) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``, in place of columns with these names.

    Null texts have size 0. A null source is a source of its own. Rows that share a doc_id (or have none) share the
    draw. Sources without words get rate 0. Empty input gives no rows. Other columns pass through untouched.
    """
    return _taken(docs.drop(*MIXED), MIXED, weights, most_repeats, seed)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS, seed: int = 17) -> DataFrame:
    """The mixture itself: each document as often as it is taken, with ``copy`` counting from 0.

    All columns of ``docs`` stay as they are; where it has a ``copy``, the count is ``copy_1`` (or the next free one).
    """
    names = tuple(unused(docs, n) for n in MIXED)
    count = unused(docs, "copy")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(names[3]) - 1)).alias(count)
    return _taken(docs, names, weights, most_repeats, seed).where(F.col(names[3]) > 0).select(*docs.columns, copies)


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    """A row for each of ``documents``: its size, its source's size and target, and the words that the mixture takes of it; repeated rows share a draw."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return with_copies(docs).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


OP5_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents
), totals as (
  select source, sum(size)::bigint as source_size from sized group by source
), ranked as (
  select *, [5, 2, 1][((row_number() over (order by source asc nulls last) - 1) % 3 + 1)::int]::bigint as weight, source_size * 3 as cap from totals
), levels as (
  select *, cap::double / weight as ratio,
    (sum(source_size) over () - coalesce(sum(cap) over (order by cap::double / weight, source asc nulls last rows between unbounded preceding and 1 preceding), 0))::double
      / (sum(weight) over () - coalesce(sum(weight) over (order by cap::double / weight, source asc nulls last rows between unbounded preceding and 1 preceding), 0))::double as level
  from ranked
), plan as (
  select source, source_size, least(cap::double, coalesce(min_by(level, ratio) filter (level <= ratio) over (), 0.0) * weight) as target from levels
), rates as (
  select doc_id, size, source_size, target, case when source_size > 0 then target / source_size else 0.0 end as rate,
    ('0x' || md5('17:' || coalesce(doc_id::varchar, ''))[1:12])::bigint::double / 281474976710656.0 as draw
  from sized join plan on sized.source is not distinct from plan.source
)
select doc_id, size, source_size, target, (size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end))::bigint as taken from rates
"""
