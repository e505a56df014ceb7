"""Chat formatting and mixing: edges, ties, and the queries against their SQL."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, mixing
from tidemark.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name, table", [("op1_warc_normalise", "pages"), ("op3_chat_format", "conversations"), ("op5_mix_sources", "documents")])
def test_query_equals_sql(spark, name, table):
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.execute(oracle_sql()[name]).df()
    got = queries()[name](spark, SF).toPandas()[list(want.columns)]
    key = want.columns[0]
    a, b = (x.astype(object).where(x.notna(), None).sort_values(key, kind="stable").values.tolist() for x in (got, want))
    assert [[str(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r] for r in a] == [[str(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r] for r in b]


def test_chat_edges(spark):
    rows = [
        (1, 0, "user", "a<|im_end|>\n\\<|b\\|<"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, 2, "assistant", "|x\n<|im_start|>user\n"), (1, None, None, "first"),
        (None, 0, "assistant", "é" * 3), (2, 0, "role with\nbreak <|im_end|>", ""), (3, 0, "user", "y" * 200_000),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], CONV + ", formatted string")
    out = {r["conv_id"]: r for r in chat.format_chats(df).select("*", chat.read_back(F.col("formatted")).alias("back")).collect()}
    assert [(t["role"], t["text"]) for t in out[1]["back"]] == [("", "first"), ("user", rows[0][3]), ("assistant", ""), ("assistant", ""), ("assistant", rows[3][3])]
    assert [(t["role"], t["text"]) for t in out[2]["back"]] == [("role with\nbreak <|im_end|>", "")]
    assert len(out[3]["back"][0]["text"]) == 200_000 and out[3]["loss_spans"] == []
    text = out[1]["formatted"]
    assert [text[s["start"] : s["end"]] for s in out[1]["loss_spans"]] == ["", "", "|x\n<\\|im_start|>user\n"]
    assert [out[None]["formatted"][s["start"] : s["end"]] for s in out[None]["loss_spans"]] == ["ééé"]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_event_folding(spark):
    log = [
        (1, 0, "m1", "open", "user", "he"), (1, 1, "m1", "delta", None, "llo"), (1, 2, "m2", "open", "assistant", ""), (1, 3, "m2", "delta", None, "bad"),
        (1, 4, "m2", "regenerate", None, None), (1, 5, "m2", "delta", None, "go"), (1, 6, "m2", "delta", None, "od"), (1, 7, "m1", "edit", None, "hi"), (1, 8, "m1", "delta", None, "!"), (1, 9, "m3", "delta", None, "orphan"),
    ]
    df = spark.createDataFrame(log, "conv_id long, seq long, message_id string, kind string, role string, text string")
    got = {r["message_id"]: (r["role"], r["text"]) for r in chat.fold_events(df).collect()}
    assert got == {"m1": ("user", "hi!"), "m2": ("assistant", "good"), "m3": (None, "orphan")}


def test_mixing_edges(spark):
    rows = [(i, "a b c" if i % 2 else " x\t", "s1") for i in range(200)] + [(900 + i, "w " * 50, "s2") for i in range(3)] + [(1000, None, None), (None, "q", None), (1001, "", "zero"), (7, "dup dup", "s1")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, mix_size int").drop("mix_size").withColumn("extra", F.lit(1))
    out = mixing.with_copies(df).collect()
    assert len(out) == len(rows)
    target = {r["source"]: (r["mix_source_size"], r["mix_target"]) for r in out}
    assert abs(sum(t for _, t in target.values()) - sum(s for s, _ in target.values())) < 1e-6
    assert all(t <= 3 * s + 1e-9 for s, t in target.values()) and target["zero"] == (0, 0.0)
    assert all(r["mix_copies"] <= 3 for r in out) and {r["mix_copies"] for r in out if r["source"] == "zero"} == {0}
    again = mixing.with_copies(df.repartition(3)).select("doc_id", "mix_copies").collect()
    assert sorted(map(str, again)) == sorted(map(str, [(r) for r in mixing.with_copies(df).select("doc_id", "mix_copies").collect()]))
    mixed = mixing.mix(df)
    assert mixed.columns == [*df.columns, "copy"] and mixed.count() == sum(r["mix_copies"] for r in out)
    assert mixing.with_copies(df.limit(0)).count() == 0


def test_mixing_hits_targets(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("source"))
    out = mixing.with_copies(df).groupBy("source").agg(F.sum(F.col("mix_size") * F.col("mix_copies")).alias("t"), F.first("mix_target").alias("w")).collect()
    assert all(abs(r["t"] / r["w"] - 1) < 0.05 for r in out)


def test_digest_of_conversation(spark):
    row = queries()["op3_chat_format"](spark, SF).where("conv_id = -1").first()
    says = "<|im_end|><|im_start|>assistant ok"
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{says}\nassistant\n{says}\n".encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(says.encode()).hexdigest() and row["loss_chars"] == len(says)


def test_edited_logs_fold_to_their_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", ""), (1, 2, "assistant", None), (2, 0, None, "zwölf Zeichen"), (2, 1, "user", "x" * 1000), (3, None, "user", "ab"), (3, None, "user", "ab")]
    df = spark.createDataFrame(rows, CONV)
    events = chat.as_edited_events(df)
    assert {r["kind"] for r in events.select("kind").distinct().collect()} == {"open", "delta", "edit", "regenerate"}
    plain, edited = (sorted(map(str, chat.fold_events(log).select("conv_id", "message_id", "role", "text").collect())) for log in (chat.as_events(df), events))
    assert plain == edited
    assert chat.as_edited_events(df.limit(0)).count() == 0
