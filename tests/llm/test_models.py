"""Toxicity, packing, mixing and nearest neighbours."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from strata.llm.ann import nearest
from strata.llm.mixing import mixed_documents, plan_mix
from strata.llm.packing import best_fit, pack, tokenizer_path
from strata.llm.toxicity import drop_toxic, toxic_scores

SMALL = "/root/testdata/sf0.01"


def test_toxicity_finds_held_out_rows(spark, make_docs, words):
    rng = random.Random(3)
    bad = ["vile1", "vile2", "vile3", "vile4"]
    texts, labels = {}, []
    for k in range(400):
        toxic = k % 5 == 0
        text = [rng.choice(words) for _ in range(40)]
        if toxic:
            for w in rng.sample(bad, 3):
                text.insert(rng.randrange(40), w)
        texts[k] = " ".join(text)
        labels.append((k, 1, int(toxic)))
    texts |= {1000: None, 1001: "", 1002: "w " * 20_000}
    docs = make_docs(texts).withColumn("score", F.lit("mine"))
    label_rows = spark.createDataFrame([*labels, (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxic_scores(docs, label_rows).collect()}
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(rows[k].held_out == (k in set(held)) for k in range(400))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    assert np.mean([rows[k].predicted for k in held if k % 5 == 0]) > 0.9
    assert np.mean([rows[k].predicted for k in held if k % 5]) < 0.05
    assert rows[1000].score == rows[1001].score
    left = drop_toxic(docs, label_rows)
    assert left.columns == docs.columns and left.count() == sum(not r.predicted for r in rows.values())


def test_toxicity_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in toxic_scores(make_docs({1: "a b"}), none).collect()] == [0.5]
    assert toxic_scores(make_docs({1: "a b"}).limit(0), none).count() == 0


def test_best_fit_matches_a_plain_search():
    rng = np.random.RandomState(2)
    lengths = rng.randint(1, 101, 500)
    bins, offsets = best_fit(lengths, 100)
    room: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [r for r in room if r >= lengths[i]]
        best = min(fits) if fits else 100
        assert offsets[i] == 100 - best
        if fits:
            room.remove(best)
        room.append(best - lengths[i])
    assert len(set(bins.tolist())) == len(room)


def test_packed_pieces_are_the_tokens(spark, make_docs, words):
    from tokenizers import Tokenizer

    texts = {k: " ".join(words[k : k + 90]) + ". Ünïcode don't 123é — 漢字" for k in range(30)}
    texts |= {100: None, 101: "", 102: "word " * 6_000, 103: "<|endoftext|> İ Σ́ é \x85 a b"}
    rows = pack(make_docs([*texts.items(), (102, texts[102])]).withColumn("offset", F.lit(1)), pieces_per_shard=20).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    places = defaultdict(list)
    total = defaultdict(int)
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1]
        part = ids[r.start : r.start + r.length]
        assert len(part) == r.length and len(ids) == r.doc_tokens
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r.ids_crc32
        places[r.sequence_id].append((r.offset, r.length))
        total[r.doc_id] += r.length
        assert r.length == 2048 or r.start + r.length == len(ids)
    assert total[102] == 2 * (6_001) and total[100] == 1
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack(make_docs(texts).limit(0)).count() == 0


def test_mix_reaches_targets(spark, make_docs, words):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), rng.choice(["a", "a", "a", "b", "c", None, "d"])) for k in range(600)]
    rows += [(900, None, "e"), (901, "", "e"), (902, "x y z", "f"), (903, "w " * 9_000, "a"), (5, rows[5][1], rows[5][2])]
    docs = make_docs(rows).withColumn("size", F.lit("mine"))
    out = plan_mix(docs).collect()
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        assert r.taken == r.copies * r.size and r.copies <= 3 and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions)
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    weights = dict(zip(sorted(size, key=lambda s: (s is None, s)), [5, 2, 1] * 3))
    free, left, expected = dict(weights), sum(size.values()), {}
    while free:
        each = left / sum(free.values())
        full = [s for s in free if 3 * size[s] <= each * free[s]]
        for s in full or list(free):
            expected[s] = 3 * size[s] if full else each * free[s]
            left -= expected[s]
            del free[s]
    assert all(abs(target[s] - expected[s]) < 1e-6 * max(1, expected[s]) for s in size)
    assert all(abs(taken[s] - target[s]) <= 5 for s in size if s in ("a", "b", "c", "d", None))
    assert sorted(map(str, out)) == sorted(map(str, plan_mix(docs).collect()))
    assert mixed_documents(docs).columns == docs.columns
    assert mixed_documents(docs).count() == sum(r.copies for r in out)
    assert plan_mix(docs.limit(0)).count() == 0


def test_op6_reads_back_the_sorted_mix(spark, make_docs, words, monkeypatch):
    """What op6 returns comes from the copies in training order: without the sort,
    or with a copy lost from it, it changes."""
    from strata.llm import mixing, queries

    rng = random.Random(2)
    docs = make_docs([(k, " ".join(rng.choices(words, k=rng.randint(1, 60))), rng.choice("abbbcccc")) for k in range(300)] + [(9, "x y z", "a")] * 2)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    plan = [(r.doc_id, r.size, r.source_size, r.target, r.taken, r.positions) for r in plan_mix(docs).collect()]
    expected = sorted((*r[:5], round(r[5][0], 9) if r[5] else None) for r in plan)
    assert max(len(r[5]) for r in plan) > 1 and min(len(r[5]) for r in plan) == 0

    def found():
        return sorted(map(tuple, queries.op6_mixing(spark, "").collect()), key=str)

    assert found() == sorted(expected, key=str)
    sort, calls = mixing.in_training_order, []
    monkeypatch.setattr(mixing, "in_training_order", lambda *a: calls.append(1) or sort(*a).orderBy(F.desc("__position")).filter("doc_id <> 9"))
    changed = found()
    assert calls and [r for r in changed if r[0] == 9 and r[4] > 0] == []
    last = sorted((*r[:5], round(r[5][-1], 9) if r[5] else None) for r in plan if r[0] != 9)
    assert [r for r in changed if r[0] != 9] == sorted(last, key=str)


def test_nearest_recall_and_ties(spark):
    rng = np.random.RandomState(4)
    vectors = rng.normal(size=(1500, 16))
    vectors[300:700] = vectors[300]
    rows = [(k, v.tolist(), 0) for k, v in enumerate(vectors)]
    rows += [(2000, None, 0), (2050, [0.0] * 16, 0), (2100, [1.0, None] + [0.0] * 14, 0), (2150, [float("nan")] * 16, 0),
             (2200, [1.0, 2.0], 0), (None, [1.0] * 16, 0), (50, vectors[50].tolist(), 0), (2250, [], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    found = defaultdict(list)
    for r in nearest(frame).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = n = 0
    for q in range(0, 1500, 50):
        s = unit @ unit[q]
        expected = sorted((-round(s[i], 12), i) for i in range(1500) if i != q)[:5]
        got = sorted(found[q])
        assert [g[0] for g in got] == [1, 2, 3, 4, 5] and all(abs(g[2] - s[g[1]]) < 1e-9 for g in got)
        hits += len({g[1] for g in got} & {e[1] for e in expected})
        n += 5
    assert hits / n >= 0.9
    assert [g[1] for g in sorted(found[350])] == [300, 301, 302, 303, 304]
    assert set(found) == set(range(0, 1500, 50)) and nearest(frame.limit(0)).count() == 0


def test_nearest_with_few_candidates(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [3.0, 3.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id) for r in nearest(frame).orderBy("rank").collect()] == [(0, 1, 2), (0, 2, 1)]


def test_nearest_over_several_shards(spark):
    """Recall against brute force where every query asks four shards and more."""
    rng = np.random.RandomState(11)
    centres = rng.normal(size=(20, 24))
    vectors = centres[rng.randint(20, size=2000)] + rng.normal(size=(2000, 24)) * 0.6
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found: dict = defaultdict(list)
    for r in nearest(df, shard_rows=450).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(found) == list(range(0, 2000, 50))
    hits = 0
    for q, rows in found.items():
        scores = unit @ unit[q]
        want = [i for i in np.lexsort((np.arange(2000), -scores)) if i != q][:5]
        hits += len(set(want) & {i for _, i, _ in rows})
        assert all(abs(s - scores[i]) < 1e-12 for _, i, s in rows)
    assert hits >= 0.95 * 5 * len(found)


def test_ftrl_equals_a_plain_one(words):
    """Weights against the update rule written out coordinate by coordinate."""
    import math

    from strata.llm import toxicity as T

    rng = random.Random(12)
    texts, labels = [], []
    for k in range(120):
        y = k % 3 == 0
        texts.append(" ".join(rng.choice(words[:40] + ["foul", "rude"] * (12 * y)) for _ in range(15)))
        labels.append(int(y))
    found = [sorted(set(T.features(t).tolist())) for t in texts]
    fitted = [i for i in range(len(texts)) if i % T.CALIBRATE]
    docs = Counter(f for i in fitted for f in found[i])
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        l1 = 0 if i == "bias" else T.L1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((T.BETA + math.sqrt(n[i])) / T.ALPHA + T.L2)

    for _ in range(T.EPOCHS):
        for i in fitted:
            own = [f for f in found[i] if docs[f] >= T.MIN_DOCS] + ["bias"]
            w = {f: weight(f) for f in own}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[i]
            for f in own:
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / T.ALPHA * w[f]
                n[f] += g * g
    got = T.fit_ftrl(texts, labels)[:-1]
    want = {f: weight(f) for f in docs}
    assert {f for f, w in want.items() if w} == set(np.flatnonzero(got).tolist()) != set()
    assert all(abs(got[f] - w) < 1e-9 for f, w in want.items())
