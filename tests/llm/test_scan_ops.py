"""WARC archives, personal data, decontamination, toxicity, language-model scores: round trips, brute force, edges."""

import gzip
import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ctw, decontaminate, pii, toxicity, warc
from tidemark.llm.storage import new_path

SF = "/root/testdata/sf0.001"


def test_warc_round_trip(spark):
    body = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 60
    rows = [(1, "http://a", body, "x"), (2, "http://b", body, "x"), (3, "u\r\nv", "short", "x"), (4, None, None, "x"), (5, "http://e", "", "x"), (None, "http://n", body, "x"), (6, "http://s", "short", "x"), (7, "http://l", "z" * 3_000_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").drop("payload").withColumn("id", F.lit("clash"))
    raw, clean = new_path(spark, "raw"), new_path(spark, "clean")
    warc.write_monolithic(warc.page_records(pages).repartition(2), raw)
    assert warc.normalise(spark, raw, clean).agg(F.sum("records")).first()[0] == len(rows)
    got = {r["id"]: r for r in warc.read_records(spark, clean).collect()}
    assert got["<urn:page:1>"]["type"] == "revisit" and got["<urn:page:1>"]["refers_to"] == "<urn:page:2>" and got["<urn:page:1>"]["block"] == b""
    assert bytes(got["<urn:page:2>"]["block"]).decode() == body and got["<urn:page:2>"]["block_sha1"] == hashlib.sha1(body.encode()).hexdigest()
    assert got["<urn:page:1>"]["payload_length"] == len(body.encode()) and got["<urn:page:3>"]["type"] == got["<urn:page:6>"]["type"] == "response"
    assert bytes(got["<urn:page:4>"]["block"]) == b"" and len(got["<urn:page:7>"]["block"]) == 3_000_000 and got["<urn:page:>"]["type"] == "revisit"
    again = new_path(spark, "again")
    assert warc.normalise(spark, clean, again).agg(F.sum("records")).first()[0] == len(rows)  # members in, members out
    empty = new_path(spark, "empty")
    warc.write_monolithic(warc.page_records(pages.limit(0)), empty)
    assert (warc.normalise(spark, empty, new_path(spark, "none")).agg(F.sum("records")).first()[0] or 0) == 0


def test_warc_broken_streams():
    class Source:
        def __init__(self, data):
            self.data = data

        def read(self, n):
            out, self.data = self.data[:n], self.data[n:]
            return out

    whole = gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    assert [r for _, r in warc.records_of(warc._inflated(Source(whole)))] == [b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"]
    for bad in (whole[:-12], gzip.compress(b"nothing\r\n\r\n"), gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")):
        with pytest.raises(ValueError):
            list(warc.records_of(warc._inflated(Source(bad))))


PATTERNS = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if (k != 1 or all(int(x) <= 255 for x in m.group().split("."))) and (k != 2 or (14 <= len(digits) <= 19 and pii.luhn(digits))) and (k != 3 or 10 <= len(digits) <= 15):
                out.append((m.start(), m.end(), k))
    return sorted(out)


TRICKY = [
    "a@b.c@d.e x@y z@q.r-s..t .@a.b", "1.2.3.4.5.6.7.8 300.1.1.1 1.1.1.256 01.02.03.004", "4111 1111 1111 1111 4111-1111-1111-1112 411111111111111", "+1 (017) 555-7713 ) +1 2 +12345678901234567 ++49 30 1234567.",
    "é" * 5 + " mail é@x.de ü.9@mail.de", "", "@", "@@a.b", "9" * 5000, "1." * 3000, "a" * 5000 + "@", 'token = "abe29cfcdae4f03e1e339fcaa4c5bb6c83baff71" end', "+" * 3000, "1 " * 3000,
]


def test_base_patterns():
    for t in TRICKY:
        assert pii.base_spans(t) == plain_spans(t), t[:60]


def test_pii_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(TRICKY)] + [(None, None, "x"), (3, TRICKY[3], "x")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, spans string, n_chars long")
    out = pii.find(df).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[None]["spans"] == "" and "secret:9:49" in by_id[11]["spans"]
    assert all(set(r["base"].split(",")) <= set(r["spans"].split(",")) | {""} for r in out)
    red = pii.redacted(df)
    assert red.columns == df.columns
    text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in red.collect()}
    assert text[None] == (None, 9) and text[11] == ('token = "[SECRET]" end', 22) and "555-7713" not in text[3][0]
    assert pii.find(df.limit(0)).count() == 0


def test_field_on_held_out_rows():
    field = pii.train()
    x, starts, gold = pii._packed(pii.labelled_rows(200, 77))
    assert (field.decode(x, starts) == gold).mean() > 0.97


def brute_best(item, text):
    """Fewest edits of ``item`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination(spark):
    item = "The quick brown fox jumps over the lazy dog while seven wizards mix a potion, and nobody minds the noise at all tonight."
    other = "Completely different words about rivers and hills that nobody copied into any other document so far in time."
    edited = item.replace("quick", "quack").replace("seven", "sven").replace("noise", "noises")
    far = " ".join(w[::-1] for w in item.split())
    texts = {0: f"start {item} end", 1: f"é {item.upper()}\n", 2: f"a {edited} b", 3: far, 4: item.replace(" ", "%%% "), 5: None, 6: "", 7: "x " * 60_000 + item, 8: f"{item} {item}", 9: "nothing at all", 10: item[:60]}
    docs = spark.createDataFrame([(*r, "x") for r in texts.items()] + [(None, item, "x"), (9, item, "x")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (4, ""), (5, "abc"), (None, item)], "item_id long, text string")
    got = decontaminate.contaminations(docs, bench).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([0, 1, 2, 4, 7, 8, 8, None, 9])
    assert {r["item_id"] for r in got} == {1} and max(r["edits"] for r in got) == brute_best(decontaminated_text(item), decontaminated_text(edited))
    hit = next(r for r in got if r["doc_id"] == 0)
    assert texts[0].encode()[hit["start"] : hit["end"]].decode().rstrip(".") == item.rstrip(".")
    left = decontaminate.decontaminated(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 5, 6, 9, 10] and left.columns == docs.columns
    assert decontaminate.contaminations(docs, bench.limit(0)).count() == 0 and decontaminate.contaminations(docs.limit(0), bench).count() == 0


def decontaminated_text(text):
    data, _, _ = decontaminate.normalised(*decontaminate.buffers(pa.array([text])))
    return data.tobytes().decode().strip()


def test_benchmark_without_ids(spark):
    """An item whose item_id is null takes its documents out, though it has no row to name it by."""
    item = "a question without an id that asks for the height of the tallest mountain on earth"
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, "nothing of that kind here")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item)], "item_id long, text string")
    assert decontaminate.contaminations(docs, bench).count() == 0
    assert [r["doc_id"] for r in decontaminate.decontaminated(docs, bench).collect()] == [2]


def test_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)
    items = [f"passage number {i} has words of its own like alpha{i} beta{i} gamma{i} delta{i} and so on" for i in range(8)]
    docs = spark.createDataFrame([(i, f"text {t} text") for i, t in enumerate(items)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).where("edits = 0").collect()}
    assert got == {(i, i) for i in range(8)}


def test_toxicity(spark):
    rude = ["blorfing", "snargle", "grumpox"]
    rows, labels = [], []
    for i in range(700):
        words = [f"w{(i * 31 + k * 17) % 400}" for k in range(80)]
        bad = i % 4 == 0
        if bad:
            words[10], words[40], words[60] = rude
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad), "x"))
    docs = spark.createDataFrame([(*r, 0.5) for r in rows] + [(None, None, 0.1), (5000, "", 0.1), (5001, "long " * 100_000, 0.1)], "doc_id long, text string, extra double")
    marks = spark.createDataFrame([*labels, (5, 1, None, "x"), (None, 0, 1, "x")], "doc_id long, quality int, toxic int, text string")
    model = toxicity.fit(docs, marks)
    out = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    held = [i for i in range(700) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all((out[i] >= 0.3) == (i % 4 == 0) for i in held) and all(0 <= s <= 1 for s in out.values())
    kept = toxicity.without_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1
    assert toxicity.fit(docs, marks.limit(0)) is None and toxicity.scored(docs, None).agg(F.max("score")).first()[0] == 0.0
    assert toxicity.scored(docs.limit(0), model).count() == 0


def test_toxicity_of_long_texts(spark):
    """Labelled texts that are all long, and ids without a text, still give a model; too few texts are an error."""
    plain = [f"the report of day {i} tells of rain and wind over the hills near town {i % 7} " * 160 for i in range(60)]
    rows = [(i, t + ("you vile rotten scumbag " * 20 if i % 2 else "")) for i, t in enumerate(plain)]
    docs = spark.createDataFrame([*rows, (700, None)], "doc_id long, text string")
    marks = spark.createDataFrame([*[(i, i % 2) for i in range(60)], (700, 1), (701, 0)], "doc_id long, toxic int")
    assert min(len(t) for _, t in rows) > 10_000
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, toxicity.fit(docs, marks)).collect()}
    flagged = {i for i in range(60) if scores[i] >= toxicity.THRESHOLD}
    assert len([i for i in flagged if i % 2]) >= 27 and len([i for i in flagged if not i % 2]) <= 3
    with pytest.raises(ValueError, match="labels exist"):
        toxicity.fit(docs, marks.where("doc_id >= 700"))


def test_context_tree_against_brute_force(spark, monkeypatch):
    texts = {i: ("Abra cad " * (i % 5) + f"x{i} zé")[: 5 + i] for i in range(24)} | {30: None, 31: "", 32: "q" * 3000}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    assert any(held.values())
    rows = [(*r, "x") for r in texts.items()]
    want, base = brute_scores({i: (t or "").lower() for i, t in texts.items()}, held)
    for head in (1 << 20, 8):  # all in memory; nearly all by the join
        monkeypatch.setattr(ctw, "HEAD", head)
        got = ctw.model_scores(spark.createDataFrame(rows, "doc_id long, text string, score string")).collect()
        assert len(got) == len(rows)
        for r in got:
            assert math.isclose(r["score"], want[r["doc_id"]], rel_tol=1e-6, abs_tol=1e-6)
            assert math.isclose(r["base_score"], base[r["doc_id"]][0], rel_tol=1e-9) and (r["n_tokens"], r["n_known"]) == base[r["doc_id"]][1:]
    assert ctw.model_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_scores(texts, held):
    depth = ctw.DEPTH
    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    for i, t in texts.items():
        b = bytes(depth) + t.encode()
        for p in range(depth, len(b)):
            for j in range(8):
                prefix, bit = (1 << j) | (b[p] >> (8 - j)), (b[p] >> (7 - j)) & 1
                for d in range(depth + 1):
                    key = (b[p - d : p], prefix)
                    counts[key][bit] += not held[i]
                    if d:
                        children[(key[0][1:], prefix)].add(key)
    kt = {k: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1) for k, (a, b) in counts.items()}
    whole = {}
    for k in sorted(counts, key=lambda k: -len(k[0])):
        below = sum(whole[c] for c in children[k])
        top = max(below, kt[k])
        whole[k] = kt[k] if len(k[0]) == depth else math.log(0.5) + top + math.log(math.exp(below - top) + math.exp(kt[k] - top))
    scores = {}
    for i, t in texts.items():
        b, total = bytes(depth) + t.encode(), 0.0
        for p in range(depth, len(b)):
            for j in range(8):
                prefix, chance = (1 << j) | (b[p] >> (8 - j)), 0.0
                for d in range(depth, -1, -1):
                    k = (b[p - d : p], prefix)
                    own = (counts[k][1] + 0.5) / (sum(counts[k]) + 1)
                    stop = 1.0 if d == depth else math.exp(math.log(0.5) + kt[k] - whole[k])
                    chance = stop * own + (1 - stop) * chance
                total += math.log10(chance if (b[p] >> (7 - j)) & 1 else 1 - chance)
        scores[i] = total
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t), "\0end"] for i, t in texts.items()}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return scores, {i: (sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), len(ws), sum(c[w] > 0 for w in ws)) for i, ws in tokens.items()}


def test_decontamination_against_brute_force(spark):
    """Random texts, some with an edited item: each item within its budget of a text is found there, and no other."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    items = {i: " ".join(word() for _ in range(rng.randint(3, 14))) for i in range(30)}
    items = {i: t for i, t in items.items() if len(t) >= decontaminate.Q}
    texts = {}
    for d in range(60):
        t = [word() for _ in range(rng.randint(0, 30))]
        if d % 2:
            chosen = list(rng.choice(list(items.values())))
            for _ in range(rng.randint(0, max(1, len(chosen) // 10))):
                chosen[rng.randrange(len(chosen))] = rng.choice("xyz")
            t.insert(rng.randint(0, len(t)), "".join(chosen))
        texts[d] = " ".join(t)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    budget = lambda t: min(int(len(t) * decontaminate.EDITS), (len(t) - decontaminate.Q) // decontaminate.Q)
    want = {(d, i) for d, t in texts.items() for i, item in items.items() if brute_best(item, t) <= budget(item)}
    assert got == want and len(want) > 15


def test_memory_of_common_phrases():
    """Items and texts that share a phrase cost their distinct q-grams, not all pairs of occurrences."""
    rng = random.Random(1)
    words = [f"w{i}x" for i in range(4000)]
    items = [(i, ("the common opening phrase of it " + " ".join(rng.choice(words) for _ in range(20))).encode()) for i in range(2000)]
    known = decontaminate.Index(items)
    texts = [" ".join(rng.choice(words) for _ in range(7)) for _ in range(5000)] + ["the common opening phrase of it " * 1000, f"a {items[7][1].decode()} b"]
    tracemalloc.start()
    hits = list(decontaminate.hits_of(pa.array(texts), known))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r, i) for r, i, *_ in hits] == [(len(texts) - 1, 7)] and peak < 300 << 20


def test_memory_of_long_number_tables():
    """A long run of numbers beside many short ones: decoding holds segments of like length only."""
    field = pii.train()
    text = " ".join(str(i) for i in range(60_000)) + " " + " ".join("word word word word word word 12" for _ in range(4000))
    tracemalloc.start()
    pii.added_spans(pa.array([text]), field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20


def test_decoding_of_segments_is_exact():
    """Viterbi over segments of many lengths at once equals each one's best labelling by exhaustion."""
    field = pii.train()
    x, starts, _ = pii._packed([(["a1", "b@c.de"], ["O", "O"]), (["+1", "x", "9"], ["O"] * 3), (["=", '"ab12"', "7.7.7.7", "q"], ["O"] * 4), (["12"], ["O"])])
    got = field.decode(x, starts)
    score = pii.context(x, starts) @ field.emission
    for lo, hi in zip(starts, [*starts[1:], len(x)], strict=True):
        value = lambda y: field.first[y[0]] + sum(score[lo + k, y[k]] for k in range(len(y))) + sum(field.transition[a, b] for a, b in itertools.pairwise(y))  # noqa: B023, E731
        best = max(itertools.product(range(len(pii.LABELS)), repeat=int(hi - lo)), key=value)
        assert math.isclose(value(best), value(tuple(got[lo:hi].tolist())), rel_tol=1e-5)


def test_archives_are_dealt_to_tasks(spark):
    raw, clean = new_path(spark, "raw"), new_path(spark, "clean")
    warc.write_monolithic(warc.page_records(spark.range(64).selectExpr("id page_id", "concat('http://', id) url", "repeat('x', 50) html")).repartition(16), raw)
    done = warc.normalise(spark, raw, clean).withColumn("task", F.spark_partition_id())
    archives, tasks = done.agg(F.countDistinct("archive"), F.countDistinct("task")).first()
    assert archives == 16 and tasks >= 8
    head = next(warc.records_of(iter([gzip.decompress(open(done.first()["archive"], "rb").read())])))[0]
    assert head["warc-date"].endswith("Z") and head["content-type"].startswith("text/html")
    with pytest.raises(ValueError, match="archives can't be read"):
        warc._opened("nowhere://x/y")


def test_toxicity_of_unseen_documents(spark):
    """Held-out rows of a table with labels in four languages, of which the rarest has two dozen toxic texts to learn from."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.scored(docs.join(F.broadcast(labels.where(toxicity.held_out(F.col("doc_id")))), "doc_id"), model)
    shares = rows.groupBy("lang", "toxic").agg(F.avg((F.col("score") >= toxicity.THRESHOLD).cast("int")).alias("share"), F.count("*").alias("n")).collect()
    of = lambda toxic, langs: sum(r["share"] * r["n"] for r in shares if r["toxic"] == toxic and r["lang"] in langs) / sum(r["n"] for r in shares if r["toxic"] == toxic and r["lang"] in langs)
    print({(r["lang"], r["toxic"]): (round(r["share"], 2), r["n"]) for r in shares})
    assert of(1, ("en", "de", "fr", "es")) >= 0.75 and of(0, ("en", "de", "fr", "es")) <= 0.1
    assert all(of(1, (lang,)) >= 0.5 for lang in ("en", "de", "fr"))


def test_cut_chains_are_exact(spark):
    """Words that are outside in every best path may cut a chain: the labels of whole texts are the same without cuts."""
    field = pii.train()
    texts = pa.array([r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + TRICKY)
    for _, _, words in pii.word_chunks(texts):
        x, row = pii.shapes(words), words.row_of()
        starts = [i for i in range(len(row)) if i == 0 or row[i] != row[i - 1]]
        assert (field.decode(x, pa.array(starts).to_numpy()) == field.decode(x, pa.array(starts).to_numpy(), cut=False)).all()


def test_tree_levels_leave_the_disk(spark):
    """Levels of the context tree are read only until the code lengths are written; they filled the disk when they stayed."""
    import glob

    from tidemark.llm.storage import shared_dir

    root = shared_dir(spark).removeprefix("file://")
    level = f"{root}/ctw-[0-{ctw.DEPTH}]-*"
    before = set(glob.glob(level))
    docs = spark.createDataFrame([(n, "some words of a text " * (1 + n % 3)) for n in range(20)], "doc_id long, text string")
    assert ctw.model_scores(docs).where("score < 0").count() == 20
    assert set(glob.glob(level)) == before and glob.glob(f"{root}/ctw-lengths-*")


def test_context_tree_in_pieces(monkeypatch):
    """Counts and sums of texts that are cut into pieces, handed on early and looked up in crowded tables are those of whole texts."""
    monkeypatch.setattr(ctw, "PIECE", 7)
    monkeypatch.setattr(ctw, "FLUSH", 16)
    rng = np.random.default_rng(3)
    texts = ["", None, "A b", "abcd", "", "word " * 9, "é", "x" * 30, "a  b\tc", *["".join(rng.choice(list("aB c"), n)) for n in rng.integers(0, 40, 40)], ""]
    held = [i % 3 == 1 for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array(held)], ["doc_id", "text", "held_out"])
    grams = []
    for t in texts:
        b = bytes(ctw.DEPTH) + (t or "").lower().encode()
        grams.append([int.from_bytes(b[p - ctw.DEPTH : p + 1], "big") for p in range(ctw.DEPTH, len(b))])
    want, got, batches = defaultdict(int), defaultdict(int), 0
    for keys, out in zip(grams, held, strict=True):
        for k in keys:
            want[k] += not out
    words = 0
    for part in ctw._gather(iter([batch, batch.slice(0, 0)])):
        batches += 1
        assert 0 < part.num_rows <= 7
        for kind, key, n in zip(*part.to_pydict().values(), strict=True):
            if kind == 0:
                got[key] += n
            words += n * (kind == 1)
    assert got == want and batches > 10
    assert words == sum(len((t or "").split()) for t, out in zip(texts, held, strict=True) if not out)

    known = {k: -1.0 - k % 7 for i, k in enumerate(sorted(want)) if i % 3}
    arrays = np.array(list(known), np.uint64), np.array(list(known.values()))

    class Shared:
        value = (arrays, (np.zeros(0, np.uint64), np.zeros(0)))

    rows = [r for part in ctw._scored(Shared)(iter([batch])) for r in part.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(len(texts))) and len({r["row"] for r in rows}) == len(rows)
    for r, keys, t in zip(rows, grams, texts, strict=True):
        assert math.isclose(r["gram_sum"], sum(known.get(k, 0.0) for k in keys)) and r["grams"] == [k for k in keys if k not in known]
        assert r["known"] == 0 and r["n_words"] == len(r["words"]) == len((t or "").split())
    full = np.arange(1, 5000, dtype=np.uint64) * np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))  # all at home in the first slot
    values, hit = ctw.Lookup(full, np.arange(4999.0))(np.r_[full[::-1], np.array([0], np.uint64)])
    assert hit[:-1].all() and not hit[-1] and (values[:-1] == np.arange(4999.0)[::-1]).all()


@pytest.mark.parametrize("rows", [1000, 1])
def test_context_tree_memory_of_a_task(rows):
    """Counting and scoring hold the text, a bounded number of counts and a piece's numbers: short texts or a long one."""
    rng = np.random.default_rng(5)
    data = rng.integers(97, 123, (rows, (4 << 20) // rows), dtype=np.uint8)
    data[:, ::9] = 32
    texts = [r.tobytes().decode() for r in data]
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows)), pa.array(texts), pa.array([False] * rows)], ["doc_id", "text", "held_out"])
    keys = rng.integers(1, 1 << 48, 1 << 20, dtype=np.uint64)
    seen = np.unique(ctw.LOWER[data].ravel())

    class Shared:
        value = ((np.unique(keys), np.zeros(len(np.unique(keys)))), (seen.astype(np.uint64), np.zeros(len(seen))))

    for f, most in ((ctw._gather, 110), (ctw._scored(Shared), 120)):
        tracemalloc.start()
        try:
            assert sum(part.num_rows for part in f(iter([batch]))) >= rows
            peak = tracemalloc.get_traced_memory()[1] >> 20
        finally:
            tracemalloc.stop()
        assert peak < most, peak
