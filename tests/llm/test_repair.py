"""Repair of conversations against SQL and against every way of editing them."""

import hashlib
import itertools
import random
import re

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tidemark.llm import repair

DDL = "conv_id long, turn long, role string, text string"
GIANT = (2, 1 << 20, 3)


def by_sql(rows):
    con = duckdb.connect()
    given = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("given", given)
    con.execute("create view conversations as select conv_id::bigint as conv_id, turn::bigint as turn, role, text from given")
    return sorted(con.execute(repair.OP11_SQL).fetchall(), key=str)


def collected(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def conversations(rng, n):
    rows = []
    texts = ["Yes.", "No!", "and so on", "", " \t", "Why?", "Yes. ", "Ünïcode."]
    for c in range(n):
        for t in range(rng.randrange(0, 9)):
            rows.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice([*texts, None])))
    return rows


def test_damage_and_repair_equal_sql(spark):
    rows = conversations(random.Random(1), 120) + [(None, 1, "user", "a"), (None, None, "assistant", "b."), (500, 7, "user", "x" * 100_000 + ".")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DDL + ", cost long, audit string")
    want = by_sql(rows)
    for limits in (repair.HELD_ROWS, repair.HELD_BYTES, repair.CHUNK), GIANT:
        hurt = repair.damaged(df)
        assert collected(repair.repaired(hurt, F.col("gone"), limits)) == want
    assert {r[0] for r in want} == {r[0] for r in rows}


def cheapest(rows):
    """By trying all edits, with up to two insertions at each place."""
    best = None
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for edits in itertools.product("DKua", repeat=len(rows)):
        for ins in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, lines = 0, "", []
            for k in range(len(rows) + 1):
                cost += 5 * len(ins[k])
                audit += "I" * len(ins[k])
                lines += [(r, "") for r in ins[k]]
                if k < len(rows):
                    role, text, must, stays = rows[k]
                    e = edits[k]
                    cost += 2 if e == "D" else stays + (e != "K")
                    if must and e != "D":
                        cost = 10**6
                    audit += "R" if e in "ua" else e
                    lines += [] if e == "D" else [(role, text)] if e == "K" else [({"u": "user", "a": "assistant"}[e], text)]
            if cost < 10**6 and re.fullmatch("(s?(ua)+)?", "".join(r[:1] if r else "?" for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return best


def test_cheapest_edits(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for c in range(60):
        said, plain = set(), []
        for t in range(rng.randrange(1, 4)):
            role, text = rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["Yes.", "and", "", "No."])
            rows.append((c, t, role, text))
            plain.append((role, text, not text or (role, text) in said, 5 if text == "and" and (role, text) not in said else 0))
            said.add((role, text))
        want[c] = cheapest(plain)
    df = spark.createDataFrame(rows, DDL)
    for limits in (repair.HELD_ROWS, repair.HELD_BYTES, repair.CHUNK), (1, 10, 1):
        assert {r["conv_id"]: (r["cost"], r["audit"], r["repaired_sha256"]) for r in repair.repaired(df, limits=limits).collect()} == want


def test_one_giant_conversation(spark):
    """Longer than a batch and than what is held: the same as held whole."""
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"{t % 4000}{rng.choice(['.', ''])}") for c in (1, 2) for t in range(25_000 if c == 1 else 30)]
    df = spark.createDataFrame(rows, DDL)
    whole, spilled = (collected(repair.repaired(df, limits=limits)) for limits in ((10**9, 10**9, 1 << 20), (100, 1 << 20, 1000)))
    assert whole == spilled and len(whole[0][7]) >= 25_000


def test_nothing_to_repair(spark):
    assert repair.repaired(spark.createDataFrame([], DDL)).count() == 0
    gone = spark.createDataFrame([(3, 1, "user", "a")], DDL).withColumn("gone", F.lit(True))
    assert repair.repaired(gone, F.col("gone")).first() == (3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
