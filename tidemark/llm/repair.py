"""Repair of the structure of conversations at the least cost, as one stream a task.

Rows are repartitioned by conversation and sorted within, and ``mapInPandas``' Arrow form carries a state across batches,
so a conversation may be longer than any batch. They are sorted latest turn first: the state is then the least cost of
all that follows from each of four places in the grammar ``(s?(ua)+)?``, and a row adds to it one byte, the best edit
from each place, two bits each. Read back from the first turn on, these bytes give the cheapest edits, and of equal
costs the least string, edit by edit.

Conversations whose rows fit in a small buffer end there. Of a giant one only the bytes are kept, and they leave the
task as rows of a table in the shared folder, a chunk at a time; a second stream over the giant conversations alone, in
the order of turns, reads the bytes back (as many as its audit has letters) and applies the edits to the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import is_empty, written

BLANKS = " \t\n\v\f\r"
STOPS = ".!?"
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Rows and bytes of text of one conversation that are held; longer ones take the second stream.
HELD_ROWS, HELD_BYTES = 20_000, 8 << 20
#: Backpointers that leave the task at once.
CHUNK = 1 << 20

# places in the grammar: nothing yet, after the system's turn, after a user's, after an assistant's
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: What a place expects next, and where that leads.
EXPECTED = ("user", "user", "assistant", "user")
NEXT = (USER, USER, ASSISTANT, USER)
#: Edits in the order of their letters.
LETTERS = "DIKR"
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
STREAM = f"{RESULT}, chunk long, pointers binary"


class Costs:
    """The least cost from each place on, and the edit it begins with, as rows are put before those that follow."""

    def __init__(self) -> None:
        self.after = [0, 2 * INSERT, INSERT, 0]

    def put(self, initial: str, deleted: bool, truncated: bool) -> int:
        """Put a row before the others; gives the edits from each place, two bits each."""
        after, here, edits = self.after, [0, 0, 0, 0], [0, 0, 0, 0]
        stays = TRUNCATED if truncated else 0
        for place in range(4):
            best, edit = DELETE + after[place], 0
            if not deleted:
                kept = SYSTEM if initial == "s" and place == NONE else NEXT[place] if initial == EXPECTED[place][0] else None
                if kept is not None and stays + after[kept] < best:
                    best, edit = stays + after[kept], 2
                if REROLE + stays + after[NEXT[place]] < best:
                    best, edit = REROLE + stays + after[NEXT[place]], 3
            here[place], edits[place] = best, edit
        # an insertion leads to another place before the same row; its letter comes after Delete's only
        for place in (USER, ASSISTANT, NONE, SYSTEM):
            insert = INSERT + here[NEXT[place]]
            if insert < here[place] or (insert == here[place] and edits[place] > 1):
                here[place], edits[place] = insert, 1
        self.after = here
        return edits[0] | edits[1] << 2 | edits[2] << 4 | edits[3] << 6


def edits_of(pointers: Iterator[int]) -> Iterator[tuple[str, str]]:
    """The edits (letter, new role) from backpointers in the order of rows; Keep and Delete have no new role.

    Every row's edits end with its own Delete, Keep or Rerole; insertions before it come first. What is inserted after
    the last row comes at the end, so the caller reads edits until the stream is over.
    """
    place = NONE
    for byte in pointers:
        while True:
            edit = byte >> (2 * place) & 3
            if edit == 0:
                yield "D", ""
                break
            if edit == 1:
                yield "I", EXPECTED[place]
                place = NEXT[place]
                continue
            if edit == 3:
                yield "R", EXPECTED[place]
                place = NEXT[place]
                break
            # Keep: the row's own initial decides where it leads; the caller sends it
            initial = yield "K", ""
            place = SYSTEM if initial == "s" else NEXT[place]
            break
    while place in (SYSTEM, USER):
        yield "I", EXPECTED[place]
        place = NEXT[place]


class _Repaired:
    """Applies edits to rows in their order: the audit, and the digest of what comes out."""

    def __init__(self, pointers: Iterator[int]):
        self.edits = edits_of(pointers)
        self.audit: list[str] = []
        self.digest, self.lines, self.reply = hashlib.sha256(), 0, None

    def _line(self, role: str, text: str) -> None:
        self.digest.update((f"\n{role}:{text}" if self.lines else f"{role}:{text}").encode())
        self.lines += 1

    def _next(self) -> tuple[str, str] | None:
        try:
            return self.edits.send(self.reply) if self.audit else next(self.edits)
        except StopIteration:
            return None
        finally:
            self.reply = None

    def row(self, role: str, text: str) -> None:
        while True:
            letter, new = self._next()
            self.audit.append(letter)
            if letter == "I":
                self._line(new, "")
                continue
            if letter == "K":
                self.reply = role[:1]
                self._line(role, text)
            elif letter == "R":
                self._line(new, text)
            return

    def end(self) -> tuple[str, str]:
        while (edit := self._next()) is not None:
            self.audit.append(edit[0])
            self._line(edit[1], "")
        return "".join(self.audit), self.digest.hexdigest()


class _Conversation:
    """Figures and costs of one conversation, its rows coming latest first."""

    def __init__(self, conv_id: int | None, limits: tuple[int, int, int]):
        self.limits, self.conv_id, self.costs, self.rows = limits, conv_id, Costs(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.turn = None
        self.turns = 0
        self.later: str | None = None
        self.held: list[tuple[str, str]] | None = []
        self.bytes, self.pointers, self.chunk = 0, bytearray(), 0

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        bare = text.rstrip(BLANKS)
        blank = not bare
        duplicate = again and not blank
        truncated = not blank and not again and bare[-1] not in STOPS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        initial = role[:1]
        if self.later is not None and initial + self.later not in ("su", "ua", "au"):
            self.illegal += 1
        self.later = initial
        if turn is not None:
            self.turns += turn != self.turn
            self.turn = self.low = turn
            self.high = turn if self.high is None else self.high
        self.pointers.append(self.costs.put(initial, blank or duplicate, truncated))
        self.rows += 1
        if self.held is not None:
            self.held.append((role, text))
            self.bytes += len(text)
            if self.rows > self.limits[0] or self.bytes > self.limits[1]:
                self.held = None

    def spilled(self, all_of_it: bool = False) -> Iterator[tuple]:
        """Full chunks of backpointers, once the rows are no longer held."""
        size = self.limits[2]
        while self.held is None and (len(self.pointers) >= size or (all_of_it and self.pointers)):
            yield (*self.figures(), None, None, self.chunk, bytes(self.pointers[:size]))
            del self.pointers[:size]
            self.chunk += 1

    def figures(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.costs.after[NONE]

    def ended(self) -> Iterator[tuple]:
        if self.held is None:
            yield from self.spilled(True)
            # the last figures: chunk -1 tells that the audit is still to come
            yield (*self.figures(), None, None, -1, None)
            return
        done = _Repaired(reversed(self.pointers))
        for role, text in reversed(self.held):
            done.row(role, text)
        yield (*self.figures(), *done.end(), None, None)


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.int64(), pa.binary()]
    names = [c.split()[0] for c in STREAM.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _streamed(limits: tuple[int, int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Conversations from rows latest first; a row with ``gone`` only tells that its conversation exists."""
        now: _Conversation | None = None
        for batch in batches:
            out: list[tuple] = []
            for conv_id, turn, role, text, again, gone in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "again", "gone")), strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.extend(now.ended())
                    now = _Conversation(conv_id, limits)
                if not gone:
                    now.add(turn, role, text, again)
                    if now.held is None:
                        out.extend(now.spilled())
            yield _arrow(out)
        if now is not None:
            yield _arrow(list(now.ended()))

    return run


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of giant conversations: their backpointers come first (last chunk first), then their rows."""
    kinds = [pa.int64(), pa.string(), pa.string()]
    now: tuple | None = None
    pointers, done = bytearray(), None

    def ended() -> pa.RecordBatch:
        audit, digest = done.end()
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((now[0], audit, digest), kinds, strict=True)], ["conv_id", "audit", "repaired_sha256"])

    for batch in batches:
        for conv_id, role, text, piece in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text", "pointers")), strict=True):
            if now is None or (conv_id,) != now:
                if done is not None:
                    yield ended()
                now, pointers, done = (conv_id,), bytearray(), None
            if piece is not None:
                pointers.extend(reversed(piece))
                continue
            if done is None:
                done = _Repaired(iter(pointers))
            done.row(role, text)
    if done is not None:
        yield ended()


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``gone``: rows damaged by ``crc32('conv_id:turn') % 20``.

    0 drops a row (``gone``), 1 empties its text, 2 takes its stops away, 3 repeats it, 4 makes its role that of the
    user. Null roles and texts are one space, and so are null ids and turns where they are hashed.
    """
    space = F.lit(" ")
    of = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat_ws(":", of("conv_id"), of("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), of("role").alias("role"), of("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), times.alias("time")).drop("time")


def repaired(rows: DataFrame, gone: Column | None = None, limits: tuple[int, int, int] = (HELD_ROWS, HELD_BYTES, CHUNK)) -> DataFrame:
    """Figures, cheapest edits (``audit``) and the digest of what they give, for each conversation of ``rows``.

    ``rows`` has ``conv_id``, ``turn`` (long), ``role`` and ``text``; where ``gone`` holds, a row only tells that its
    conversation exists. Null roles and texts count as one space; a role that is empty has no initial, so its row can't be kept.
    Rows come by turn, nulls first, ties by role and text. A null conv_id is a conversation of its own. A conversation
    without rows has zeros, an empty audit and the digest of nothing. Repeated rows are duplicates; empty input has no
    rows; other columns are ignored. ``limits`` are the rows and bytes of a conversation that are held, and the bytes of a
    chunk of backpointers.
    """
    space = F.lit(" ")
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.lit(False) if gone is None else gone).alias("gone"))
    # one exchange: what was said before is found in an order by role and text, then the same partitions are sorted by turn
    same = Window.partitionBy("conv_id").orderBy("gone", "role", "text", F.col("turn").asc_nulls_first())
    said = F.struct("gone", "role", "text")
    rows = rows.withColumn("again", F.coalesce(F.lag(said).over(same) == said, F.lit(False)))
    latest = [F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc(), F.col("again").desc()]
    columns = ["conv_id", "turn", "role", "text", "again", "gone"]
    streamed = rows.sortWithinPartitions("conv_id", *latest).select(*columns).mapInArrow(_streamed(limits), STREAM)
    streamed = written(streamed, "conversations")
    names = [c.split()[0] for c in RESULT.split(", ")]
    ended = streamed.where("chunk is null").select(*names)
    giants = streamed.where("chunk = -1")
    if is_empty(giants):
        return ended
    pointers = streamed.where("chunk >= 0").select("conv_id", F.lit(0).alias("kind"), (-F.col("chunk")).alias("at"), F.lit("").alias("role"), F.lit("").alias("text"), "pointers")
    ids = giants.select(F.col("conv_id").alias("giant"))
    theirs = rows.where("not gone").join(ids, F.col("conv_id").eqNullSafe(F.col("giant")), "left_semi")
    theirs = theirs.select("conv_id", F.lit(1).alias("kind"), F.col("turn").alias("at"), "role", "text", F.lit(None).cast("binary").alias("pointers"))
    order = ["conv_id", "kind", F.col("at").asc_nulls_first(), "role", "text"]
    replayed = pointers.unionByName(theirs).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_replayed, "conv_id long, audit string, repaired_sha256 string")
    late = giants.drop("audit", "repaired_sha256").withColumnRenamed("conv_id", "giant").join(replayed, F.col("giant").eqNullSafe(F.col("conv_id"))).select(*names)
    return ended.unionByName(late)


def op11_repair(spark, sf_dir: str) -> DataFrame:
    """A row for each conversation of ``conversations``, damaged and then repaired."""
    rows = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repaired(rows, F.col("gone"))


def _step_sql() -> str:
    """Least (cost, audit, lines) from each place before row p, out of those after it; an insertion costs more than what it leads to."""
    places = (("e", "u", "user"), ("s", "u", "user"), ("u", "a", "assistant"), ("a", "u", "user"))
    own = []
    for at, to, role in places:
        options = [f"{{'c': {DELETE} + r.{at}.c, 'a': 'D' || r.{at}.a, 'l': r.{at}.l}}"]
        if at == "e":
            options.append(f"case when not x.gone and x.i = 's' then {{'c': x.stay + r.s.c, 'a': 'K' || r.s.a, 'l': list_prepend(x.role || ':' || x.text, r.s.l)}} end")
        options.append(f"case when not x.gone and x.i = '{to}' then {{'c': x.stay + r.{to}.c, 'a': 'K' || r.{to}.a, 'l': list_prepend(x.role || ':' || x.text, r.{to}.l)}} end")
        options.append(f"case when not x.gone then {{'c': {REROLE} + x.stay + r.{to}.c, 'a': 'R' || r.{to}.a, 'l': list_prepend('{role}:' || x.text, r.{to}.l)}} end")
        own.append(f"list_min(list_filter([{', '.join(options)}], lambda o: o is not null)) as h{at}")
    inserted = [f"list_min([h{at}, {{'c': {INSERT} + h{to}.c, 'a': 'I' || h{to}.a, 'l': list_prepend('{role}:', h{to}.l)}}]) as {at}{'' if at in 'ua' else '0'}" for at, to, role in places if at in "ua"]
    outer = [f"list_min([h{at}, {{'c': {INSERT} + u.c, 'a': 'I' || u.a, 'l': list_prepend('user:', u.l)}}]) as {at}" for at in "es"]
    return f"select conv_id, p, {', '.join(outer)}, u, a from (select conv_id, p, he, hs, {', '.join(inserted)} from (select x.conv_id, x.p, {', '.join(own)} from reach r join faults x on x.conv_id is not distinct from r.conv_id and x.p = r.p - 1))"


OP11_SQL = rf"""
with recursive bits as (
  select list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations
), hashed as (
  select *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i, 1))::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as kind from given, bits
), hurt as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case when kind = 3 then [0, 1] else [0] end) as time from hashed where kind <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, time) as p,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') as bare from hurt
), seen as (
  select *, row_number() over (partition by conv_id, role, text order by p) > 1 as again from placed
), faults as (
  select conv_id, turn, role, text, p, substr(role, 1, 1) as i, bare = '' as blank, bare <> '' and again as duplicate,
    bare <> '' and not again and right(bare, 1) not in ('.', '!', '?') as truncated,
    bare = '' or again as gone, case when bare <> '' and not again and right(bare, 1) not in ('.', '!', '?') then {TRUNCATED} else 0 end as stay,
    case when lead(p) over (partition by conv_id order by p) is not null then substr(role, 1, 1) || lead(substr(role, 1, 1)) over (partition by conv_id order by p) end as met from seen
), reach as (
  select conv_id, max(p) + 1 as p, {{'c': 0, 'a': '', 'l': []::varchar[]}} as e, {{'c': {2 * INSERT}, 'a': 'II', 'l': ['user:', 'assistant:']}} as s,
    {{'c': {INSERT}, 'a': 'I', 'l': ['assistant:']}} as u, {{'c': 0, 'a': '', 'l': []::varchar[]}} as a from faults group by conv_id
  union all {_step_sql()}
), figures as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (blank)::bigint as blank,
    count(*) filter (duplicate)::bigint as duplicate, count(*) filter (truncated)::bigint as truncated,
    count(*) filter (met not in ('su', 'ua', 'au'))::bigint as illegal from faults group by conv_id
)
select g.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(e.c, 0)::bigint as cost, coalesce(e.a, '') as audit, sha256(coalesce(array_to_string(e.l, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) g
left join figures f on f.conv_id is not distinct from g.conv_id left join reach r on r.conv_id is not distinct from g.conv_id and r.p = 1
"""
