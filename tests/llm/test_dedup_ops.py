"""Near duplicates (texts and vectors) and repeated passages against brute force, with edges."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import embedding_dedup, graph, minhash_dedup, substring_dedup

DOC = "doc_id long, text string, node long, key string, component string"
LONG = " ".join(f"w{i % 997}" for i in range(30_000))


def words(rng, n, vocabulary=400):
    return [f"v{rng.randrange(vocabulary)}" for _ in range(n)]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000), (None, 3)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == components({x for e in real for x in e}, real)
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_take_few_jobs(spark):
    """A component of any size that is a star or a short chain of stars is settled in two rounds of a write and a look."""
    rng = random.Random(2)
    edges = [(rng.randrange(40), 1000 + i) for i in range(400)] + [(7, i) for i in range(5000, 5600)] + [(9000 + i, 9001 + i) for i in range(60)]
    rng.shuffle(edges)
    spark.sparkContext.setJobGroup("components", "components")
    got = graph.connected_components(spark.createDataFrame(edges, "u long, v long").repartition(7))
    tracker = spark.sparkContext.statusTracker()
    stages = [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("components")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sum(stages) <= 60, stages
    assert {r["node"]: r["component"] for r in got.collect()} == components({x for e in edges for x in e}, edges)


def near_corpus():
    rng = random.Random(7)
    texts = {}
    for g in range(6):
        base = words(rng, 120)
        for c in range(8):
            copy = list(base)
            for _ in range(c // 2):
                copy[rng.randrange(len(copy))] = f"x{g}{c}"
            texts[g * 100 + c] = " ".join(copy)
    for i in range(60):
        texts[1000 + i] = " ".join(words(rng, rng.randrange(1, 200)))
    return texts | {2000: "A b C", 2001: "a B c", 2002: "a b d", 2003: "", 2004: None, 2005: " \t\n", 2006: LONG, 2007: LONG + " end"}


def test_minhash_against_brute_force(spark):
    texts = near_corpus()
    rows = [(i, t, 1, "k", "c") for i, t in texts.items()] + [(3, texts[3], 2, None, None), (None, texts[0], 3, None, None), (None, None, 3, None, None)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components(sets, links)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    kept = minhash_dedup.deduplicated(spark.createDataFrame(rows, DOC))
    assert kept.columns == ["doc_id", "text", "node", "key", "component"]
    assert kept.where("doc_id is not null").count() == sum(want[i] == i for i in want) and kept.where("doc_id is null").count() == 2
    assert minhash_dedup.near_duplicates(spark.createDataFrame([], DOC)).count() == 0


def test_minhash_blocks(spark, monkeypatch):
    """The same with lists and classes cut into many blocks."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 3)
    monkeypatch.setattr(minhash_dedup, "CLASS_BLOCK", 3)
    texts = near_corpus()
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert got == components(sets, links)


def test_minhash_misses():
    assert minhash_dedup.miss_probability(0.75) < 2e-4


def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    near = np.concatenate([base[i] + 0.25 * rng.normal(size=(12, 16)) for i in range(5)])
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near, base[:3], base[:3] * 1e200]))]
    bad = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, [float("inf")] * 16), (906, [1.0, 2.0]), (907, [-0.0] * 15 + [1.0]), (908, [0.0] * 15 + [1.0])]
    return [(i, v, "x") for i, v in [*rows, *bad, (None, base[0].tolist()), (2, base[2].tolist())]]


def check_vectors(spark):
    rows = vectors()
    got = embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep string")).collect()
    usable = [(i, np.array(v, float) / np.abs(np.array(v, float)).max()) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = [(i, v / np.linalg.norm(v)) for i, v in usable]
    links = [(a, b) for a, b in itertools.combinations(range(len(unit)), 2) if len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.9]
    degree = {k: sum(k in pair for pair in links) for k in range(len(unit))}
    root = components({i for i, _, _ in rows if i is not None}, [(unit[a][0], unit[b][0]) for a, b in links])
    want = sorted([(unit[k][0], degree[k], root[unit[k][0]]) for k in degree] + [(i, 0, i) for i, v, _ in rows if i is not None and i not in dict(unit)])
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None) == want
    assert len(got) == len(rows) and [r["kept"] for r in got if r["vec_id"] is None] == [True]


def test_vectors_against_brute_force(spark):
    check_vectors(spark)
    assert embedding_dedup.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 4)
    check_vectors(spark)


def test_vector_recall_at_scale_of_tables():
    for n in (10_000, 10_000_000):
        width, rotations = embedding_dedup.plan_tables(n, 64)
        agree = (1 - np.arccos(embedding_dedup.MISS_COSINE) / np.pi) ** width
        assert (1 - agree) ** (rotations * (64 // width)) <= embedding_dedup.MISS


def test_vectors_with_a_common_direction(spark):
    """Links of vectors whose mean is long, where centring widens angles."""
    rng = np.random.default_rng(8)
    for norm in (0.8, 0.9):
        far = rng.normal(size=(1200, 64))
        far[:, 0] = 0
        far /= np.linalg.norm(far, axis=1)[:, None]
        side = rng.normal(size=(600, 64))
        side[:, 0] = 0
        side -= np.einsum("nd,nd->n", side, far[:600])[:, None] * far[:600]
        side /= np.linalg.norm(side, axis=1)[:, None]
        turn = 1 - 0.085 / (1 - norm**2)  # partners at cosine 0.915
        x = np.sqrt(1 - norm**2) * np.concatenate([far, turn * far[:600] + np.sqrt(1 - turn**2) * side])
        x[:, 0] = norm
        links = (x @ x.T >= embedding_dedup.THRESHOLD).sum(axis=1) - 1
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicate_vectors(rows).collect()}
        assert all(got[i] <= n for i, n in enumerate(links))
        assert links.sum() >= 1200 and sum(got.values()) >= 0.995 * links.sum()


def test_passages_against_brute_force(spark):
    rng = random.Random(5)
    passage = words(rng, 60)
    texts = {}
    for i in range(40):
        body = words(rng, rng.randrange(0, 90))
        texts[i] = " ".join(body + (passage[rng.randrange(20) :] if i % 3 == 0 else []) + words(rng, 5))
    texts |= {50: None, 51: "", 52: "a " * 500, 53: "a\n" * 300, 54: " ".join(passage[:12]), 55: " ".join(passage[:13]), 56: "é" * 100 + " " + " ".join(passage), 57: LONG, 58: "x " + LONG}
    rows = [(i, t, 1, "k", "c") for i, t in texts.items()] + [(None, texts[0], 1, "k", "c")]
    got = substring_dedup.without_repeats(spark.createDataFrame(rows, DOC)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("h")).collect()
    want = substring_dedup.brute_force(texts)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert (r["n_words"], r["n_removed"], r["h"]) == want[r["doc_id"]]
    assert substring_dedup.without_repeats(spark.createDataFrame([], DOC)).count() == 0


def test_passages_of_a_hot_minimiser(spark, monkeypatch):
    """Three words in surroundings that differ, with some passages shared: no task joins their bucket whole."""
    joined = []
    bucket = substring_dedup._bucket
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 20_000, raising=False)
    monkeypatch.setattr(substring_dedup, "ROW_BYTES", 3_000, raising=False)
    rng = random.Random(6)
    shared = [" ".join(words(rng, 12) + ["0", ",", "0"] + words(rng, 12)) for _ in range(8)]
    texts = {}
    for i in range(60):
        parts = [" ".join(words(rng, 12) + ["0", ",", "0"] + words(rng, 12)) for _ in range(12)]
        texts[i] = " ".join(parts[:6] + [rng.choice(shared)] + parts[6:])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    # all windows in one bucket, as if all shared their minimiser
    sent = pa.Table.from_batches(substring_dedup._sent(1)(iter(docs.toArrow().to_batches())))
    monkeypatch.setattr(substring_dedup, "_bucket", lambda table: joined.append(table.num_rows) or bucket(table))
    parts = list(substring_dedup._shared(20_000)(iter(sent.to_batches(max_chunksize=5))))
    assert not joined and sum(p.num_rows for p in parts) == sent.num_rows > 10
    monkeypatch.setattr(substring_dedup, "_bucket", bucket)
    sent_by = substring_dedup._sent
    monkeypatch.setattr(substring_dedup, "_sent", lambda buckets: sent_by(1))
    taken = []
    hot_shared = substring_dedup._hot_shared
    monkeypatch.setattr(substring_dedup, "_hot_shared", lambda rows: taken.append(rows.count()) or hot_shared(rows))
    got = substring_dedup.without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("h")).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["h"]) for r in got} == substring_dedup.brute_force(texts)
    assert taken and taken[0] >= 1 and sum(r["n_removed"] for r in got) > 300
