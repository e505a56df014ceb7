"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import nearest

SF = "/root/testdata/sf0.01"


def brute(rows, is_query, k):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = {}
    for i, v in good:
        if is_query(i):
            scored = sorted((-float(np.dot(v, w)), j) for j, w in good if j != i and len(w) == len(v))
            out.setdefault(i, []).append([(j, -s) for s, j in scored[:k]])
    return out


def ranked(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_walk_goes_by_the_sum():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=7), rng.normal(size=5)
    sums = [a[i] + b[j] for i, j in nearest.walk(a, b)]
    assert len(sums) == 35 and sums == sorted(sums)


def test_recall_and_scores(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got, want = ranked(nearest.op13_nearest(spark, SF)), brute([(r["vec_id"], list(map(float, r["embedding"]))) for r in df.collect()], lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q][0]}) for q in got]
    assert sum(hits) >= 0.9 * 20 * len(hits)
    truth = {(r["vec_id"]): np.array(r["embedding"], float) for r in df.collect()}
    assert all(abs(s - truth[q] @ truth[i]) < 1e-12 for q, v in got.items() for i, s in v)
    assert all(v == sorted(v, key=lambda p: (-p[1], p[0])) for v in got.values())


def test_clusters_shelves_and_parts(spark, monkeypatch):
    """A clustered table in many small shelves with few queries a task: nearly all found, from few rows."""
    for name, value in (("CELL_ROWS", 8), ("SHELF_BYTES", 16 * 8 * 40), ("TASK_QUERIES", 5), ("SCORES", 500)):
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16)) * 3
    rows = [(i, (centres[i % 40] + rng.normal(size=16) * 0.3).tolist()) for i in range(2000)]
    longest = (np.array(rows[0][1]) * 5).tolist()
    rows += [(5000 + i, longest) for i in range(700)]
    got = ranked(nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 10))
    want = brute(rows, lambda i: i % 20 == 0, 10)
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q][0]}) for q in got]
    assert sum(hits) >= 0.9 * 10 * len(hits)
    # of equal vectors the least ids, in order, without the query itself
    assert [i for i, _ in got[5000]] == list(range(5001, 5011)) and [i for i, _ in got[5020]] == list(range(5000, 5010))


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(30)]
    rows += [(40, None), (60, []), (80, [0.0] * 4), (100, [float("nan")] + [1.0] * 3), (120, [None] + [1.0] * 3), (140, [float("inf")] * 4), (None, [1.0] * 4)]
    rows += [(160, [1.0, 2.0]), (161, [2.0, 1.0]), (180, [7.0]), (200, [1e200] * 4), (0, rows[0][1]), (20, [5.0] * 4)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, rep string, rank int")
    found = nearest.nearest(df, F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    rows_of = {}
    for r in found.collect():
        rows_of.setdefault(r["query_id"], []).append(r)
    want = brute([r for r in rows if r[0] != 200], lambda i: i % 20 == 0, 20)
    # 200 is nearest to or farthest from all others of its length
    assert set(rows_of) == {0, 20, 160, 200} and len(rows_of[160]) == 1 and rows_of[160][0]["vec_id"] == 161
    assert len(rows_of[0]) == 20 and len(rows_of[20]) >= 38 and len(rows_of[200]) == 20
    got = [r["vec_id"] for r in sorted(rows_of[0], key=lambda r: r["rank"]) if r["vec_id"] != 200]
    assert len(set(got) & {i for i, _ in want[0][0]}) >= 18
    assert nearest.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest.nearest(df.where("vec_id = 180"), F.col("vec_id") % 20 == 0).count() == 0
