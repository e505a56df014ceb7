"""Divergence of sources against SQL, with digests that collide and with edges."""

import random

import duckdb
import pandas as pd

from tidemark.llm import divergence

KEYS = ["lang", "source", "part", "rank"]


def by_sql(documents, least=10, top=10):
    con = duckdb.connect()
    con.register("given", documents)
    con.execute("create view documents as select * from given")
    sql = divergence.OP12_SQL.replace("(distinct doc) >= 10", f"(distinct doc) >= {least}").replace("rank <= 10", f"rank <= {top}")
    return [tuple(r) for r in con.execute(sql).df().sort_values(KEYS).itertuples(index=False)]


def found(df, **how):
    out = divergence.divergences(df, **how)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return [tuple(r) for r in out.toPandas().sort_values(KEYS).itertuples(index=False)]


def corpus():
    rng = random.Random(4)
    words = [f"{'abcdeé'[i % 6]}{'xyzßü'[i % 5]}{'klm'[i % 3] * (i % 7)}Ω{'QRS'[i % 3]}" for i in range(120)]
    rows = []
    for i in range(160):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "b", "ü", None, "b2"])
        low = 0 if source == "a" else 30
        rows.append((i, " ".join(rng.choice(words[low : low + 80]) + rng.choice([" ", "-", "7", "\n"]) for _ in range(rng.randrange(0, 60))), lang, source))
    rows += [(900, None, "en", "a"), (901, "", "en", "only empty"), (902, "rare rarer", "fr", "one"), (903, "x" * 50_000, "en", "a"), (904, "a " * 20_000, "en", "b")]
    rows += [rows[3]] * 12
    return rows


def test_divergence_equals_sql(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, lang string, source string, value long, digest string")
    given = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])
    for least, top in ((10, 10), (1, 3)):
        assert found(df, least_documents=least, top=top) == by_sql(given, least, top)


def test_colliding_digests_are_split(spark, monkeypatch):
    """Sixteen digests for all terms, and joins without a broadcast."""
    monkeypatch.setattr(divergence, "LOOKED_UP", 3)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    given = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])
    assert found(df, bits=4) == by_sql(given)
    monkeypatch.setattr(divergence, "LOOKED_UP", 1000)
    assert found(df, bits=4) == by_sql(given)


def test_no_documents_and_no_terms(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.divergences(df).count() == 0
    none = spark.createDataFrame([(1, None, None, None), (2, "a b", None, "s")], df.schema)
    assert sorted(map(tuple, divergence.divergences(none).collect())) == [("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)]
