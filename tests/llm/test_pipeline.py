"""The pipeline's stages on a small corpus: each decision takes effect and clean documents stay."""

import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
from tidemark.llm import graph, minhash_dedup, toxicity
from tidemark.llm.storage import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    held = docs
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        held = stage(spark, held, SF)
        if i + 1 < len(corpus_pipeline.STAGES):
            assert held.columns == docs.columns
        seen.append((name, {r["doc_id"] for r in held.collect()}))
    assert [n for n, _ in seen] == ["toxicity", "near duplicates", "decontamination", "personal data", "mixing"]
    for (_, more), (_, less) in zip(seen, seen[1:], strict=False):
        assert less <= more
    toxic = toxicity.scored(docs, toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert seen[0][1] == {r["doc_id"] for r in toxic.collect() if r["score"] < toxicity.THRESHOLD}
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {i for i, r in before.items() if any(b in r["text"] for b in bench)}
    assert not leaks & seen[2][1] and seen[2][1] == seen[3][1]


def test_run_is_registered(spark):
    import __spark_entry__ as driver

    assert "pipeline" in driver.queries() and len([n for n in driver.queries() if n.startswith("op")]) == 13


def test_edges_of_stages(spark):
    """Nulls, empties, repeats, clashing names and an empty table pass every stage; columns keep their values."""
    columns = "doc_id long, text string, lang string, source string, n_chars long, copy int, score double, mix_size int, mix_source string, mix_copies long, spans string"
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "lang", "source", "n_chars", "7 copy", "0.77D score", "8 mix_size", "'m' mix_source", "9L mix_copies", "'s' spans")
    odd = [(None, None, None, None, None), (900001, "", "en", None, 0), (900002, None, "en", "zero", 0), (900003, "one word", "en", "src1", 8), (900003, "one word", "en", "src1", 8), (900004, "long words " * 30_000, "en", "src1", 330_000)]
    extra = spark.createDataFrame([(*r, 7, 0.77, 8, "m", 9, "s") for r in odd], columns)
    for held in (docs.unionByName(extra), docs.limit(0)):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before = held
            held = written(stage(spark, held, SF), f"edge-{i}")
            assert held.columns[: len(before.columns)] == before.columns, name
            kept = held.select("copy", "score", "mix_size", "mix_source", "mix_copies", "spans").distinct().collect()
            assert [tuple(r) for r in kept] in ([(7, 0.77, 8, "m", 9, "s")], []), name
        assert held.columns == [*docs.columns, "copy_1"]


def test_run_over_whole_tables(spark, tmp_path):
    """What is planted goes, clean documents stay, and text without personal data is left as it is."""
    clean = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert clean < {r["doc_id"] for r in docs}
    by_text = {}
    for r in docs:
        by_text.setdefault(r["text"], []).append(r["doc_id"])
    assert all(len(clean & set(ids)) <= 1 for ids in by_text.values())


def test_memory_of_python_workers(spark, monkeypatch):
    """A stage has one Python step, so a task one worker; the sample comes without Python rows; a batch's texts are not all held again as strings."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = docs.mapInArrow(minhash_dedup._sets, "doc_id long, n_shingles long, digest binary, signature binary")
    edges = minhash_dedup.candidate_edges(written(sets.selectExpr("doc_id node", "signature").where("signature is not null"), "worker-sets"))
    plans = []
    keep = lambda df, label: (plans.append(df._jdf.queryExecution().executedPlan().toString()), written(df, label))[1]
    monkeypatch.setattr(graph, "written", keep)
    graph.connected_components(edges, already=True)
    below = plans[0].split("+- Exchange", 1)[1].split("Exchange", 1)[0]
    assert below.count("MapInArrow") == 1, plans[0]

    rows_of, made = type(spark).createDataFrame, []
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: (made.append(type(data)), rows_of(self, data, *a, **b))[1])
    toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert made == [pa.Table]

    class Fitted:
        def compressors(self):
            return ()

        def score(self, x):
            return x[:, 0]

    monkeypatch.setattr(toxicity, "features", lambda text, pair: np.array([float(len(text))]))
    texts = pa.array(["x" * 4000, None, "", "é" * 2000] * 2500)
    tracemalloc.start()
    try:
        out = pa.concat_arrays(toxicity._scores(iter([texts, texts[:0]]), Fitted()))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert out.to_pylist() == [4000.0, 0.0, 0.0, 4000.0] * 2500
    assert most < 6 << 20, most
