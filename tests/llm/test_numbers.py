"""Top-k search, packing, mixing, running sums, and the pipeline."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from odd_tables import SF_SMALL, documents, none, odd, texts  # noqa: F401
from pyspark.sql import functions as F
from test_texts import crc, slow_ids

import corpus_pipeline
from quillframe.llm import mixing, packing, queries, rows, topk

ROOM = 2048


def test_bit_sliced_sums():
    rng = np.random.default_rng(1)
    ints = rng.integers(-40, 60, (130, 9))
    maps, drop = topk.slices_of(ints)
    assert drop == 0
    for _ in range(20):
        query = rng.integers(-30, 30, 9)
        total = topk.add_slices(maps, query)
        bits = [np.unpackbits(t.view(np.uint8), bitorder="little")[:130].astype(np.int64) for t in total]
        got = sum(b << i for i, b in enumerate(bits))
        want = ints @ query
        assert (got - got[0] == want - want[0]).all()
        among = np.full(maps.shape[2], 2**64 - 1, np.uint64)
        valid = np.zeros(maps.shape[2] * 64, np.uint8)
        valid[:130] = 1
        among = np.packbits(valid, bitorder="little").view("<u8")
        kth = topk.kth_largest(total, 7, among)
        assert kth == np.sort(got)[-7]
        over = np.unpackbits(topk.at_least(total, kth, among).view(np.uint8), bitorder="little")[:130]
        assert (over == (got >= kth)).all()
    assert topk.kth_largest(total, 131, among) is None


@pytest.mark.parametrize("scale", [0.05, 1.0, 90.0])
def test_top_k_against_all_scores(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 70)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "QUERY_BLOCKS", 1)  # many groups on both sides
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, scale, (400, 6)).round(2).astype(np.float32)
    vectors[50:60] = vectors[100]  # ties
    data = [(i, v.tolist()) for i, v in enumerate(vectors)]
    data += [(1000, None), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1050, [float("nan")] * 6)]
    data += [(1100, [float("inf")] * 6), (None, [0.0] * 6), (7, vectors[7].tolist())]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(3)
    frame = frame.withColumn("block", F.lit(1)).withColumn("rank", F.lit("x"))
    got = defaultdict(list)
    for r in topk.top_k(frame, F.col("vec_id") % 50 == 0, 5).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    ints = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    keys = np.append(np.arange(400), 7)
    ints = np.vstack([ints, ints[7]])
    for q in range(0, 400, 50):
        scores = ints @ ints[q]
        best = [i for i in np.lexsort((keys, -scores)) if keys[i] != q][:5]
        assert sorted(got[q]) == [(n + 1, keys[i], scores[i]) for n, i in enumerate(best)]
    assert set(got) == set(range(0, 400, 50))
    few = topk.top_k(frame.where("vec_id in (0, 3)"), F.col("vec_id") == 0, 5).collect()
    assert [(r["rank"], r.vec_id) for r in few] == [(1, 3)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") == 0, 5).count() == 0


def test_top_k_of_odd_vectors(spark, monkeypatch):
    """Empty and unequal vectors, and components and scores beyond the integers that slices hold."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 4)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    rng = random.Random(3)
    data = [(i, [rng.uniform(-2, 2) for _ in range(rng.choice([0, 1, 3, 3, 5]))]) for i in range(60)]
    data += [(100 + i, [rng.choice([1.0, -7e4, 1e12, -3.5]) for _ in range(3)]) for i in range(12)]
    data += [(200, [1e300, 1.0, 1.0]), (201, [-1e300, 0.5, 0.5]), (150, []), (250, [70_000.25])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for r in topk.top_k(frame, F.col("vec_id") % 50 == 0, 5).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    floor = lambda v: int(v * 256 // 1)
    for query, mine in data:
        if query % 50:
            continue
        scores = []
        for key, other in data:
            if key != query and len(other) == len(mine):
                score = sum(floor(a) * floor(b) for a, b in zip(mine, other))
                scores.append((-min(max(score, -(2**63)), 2**63 - 1), key))
        want = [(n + 1, key, -score) for n, (score, key) in enumerate(sorted(scores)[:5])]
        assert sorted(got.pop(query, [])) == want
    assert not got


def check_packing(found, texts):
    """Every piece once, no gaps, no sequence too long; returns the number of sequences."""
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= ROOM
    want = []
    for (doc, _), ids in zip(texts, slow_ids([t for _, t in texts], 0), strict=True):
        for i in range(0, len(ids), ROOM):
            part = ids[i : i + ROOM]
            want.append((doc is None, doc or 0, i // ROOM, i, len(part), crc(part)))
    got = [(r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got) == sorted(want)
    return len(by), sum(w[4] for w in want)


def test_packing_query(spark, texts):
    n, total = check_packing(queries.op5_packing(spark, SF_SMALL).collect(), texts)
    assert n <= 1.02 * total / ROOM + 2


def test_packing_odd_rows(odd, none):
    path = queries.tokenizer_file("word_bpe_49k.json")
    found = packing.pack_documents(odd, path).withColumnRenamed("key", "doc_id").collect()
    check_packing(found, [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert packing.pack_documents(none, path).count() == 0


def test_packing_over_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS", 150)
    rng = random.Random(4)
    lengths = [rng.choice([rng.randint(1, 2047), rng.randint(1, 300), 2048]) for _ in range(1500)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long").repartition(3)
    runs = [sorted(map(tuple, packing.pack(items.repartition(n), ROOM).collect())) for n in (2, 5)]
    rows_ = runs[0]
    assert [r[0] for r in rows_] == list(range(1500)) and rows_ == runs[1]
    fill = defaultdict(int)
    for item, bin_, _ in rows_:
        fill[bin_] += lengths[item]
    assert max(fill.values()) <= ROOM
    assert len(fill) <= 1.02 * sum(lengths) / ROOM + 2


@pytest.mark.parametrize(("n", "length"), [(3_000, 1), (100_000, 1), (4_500, 3)])
def test_packing_of_many_short_items_ends(spark, monkeypatch, n, length):
    levels = []
    level = packing._level

    def counted(*args):
        levels.append(args)
        assert len(levels) < 8, "levels do not shrink"
        return level(*args)

    monkeypatch.setattr(packing, "_level", counted)
    items = spark.range(n).select(F.col("id").alias("item"), F.lit(length).cast("long").alias("length"))
    bins = defaultdict(list)
    for r in packing.pack(items, ROOM).collect():
        bins[r.bin].append(r.offset)
    assert sum(map(len, bins.values())) == n
    assert len(bins) == -(-n // (ROOM // length))
    for offsets in bins.values():
        assert sorted(offsets) == list(range(0, length * len(offsets), length))


def test_packing_of_empty_texts(spark):
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    path = queries.tokenizer_file("word_bpe_49k.json")
    found = packing.pack_documents(docs, path, ROOM).withColumnRenamed("key", "doc_id").collect()
    n, _ = check_packing(found, [(i, "") for i in range(3_000)])
    assert n == 2


def test_shards_of_several_levels_shrink(spark, monkeypatch):
    """Short items in several shards of a few sequences each, and over several levels."""
    monkeypatch.setattr(packing, "ITEMS", 100)
    monkeypatch.setattr(packing, "SEQUENCES", 4)
    assert packing.shards_of(3_000, 3_000, 64) == 11
    items = spark.range(3_000).select(F.col("id").alias("item"), F.lit(1).cast("long").alias("length"))
    sizes = [r["count"] for r in packing.pack(items, 64).groupBy("bin").count().collect()]
    assert sum(sizes) == 3_000 and max(sizes) <= 64 and len(sizes) <= 50


def test_crossover_keeps_every_item():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 1500, 300)
    one = packing.best_fit([], list(range(300)), size, ROOM)
    other = packing.mutate(one, size, ROOM, rng)
    for _ in range(10):
        child = packing.mutate(packing.crossover(one, other, size, ROOM, rng), size, ROOM, rng)
        assert sorted(x for b in child for x in b) == list(range(300))
        assert max(size[b].sum() for b in child if b) <= ROOM
        one, other = other, child
    best = packing.evolve(size, ROOM, [], [1])
    assert packing.fitness(best, size, ROOM) >= packing.fitness(
        packing.best_fit([], list(range(300)), size, ROOM), size, ROOM
    )


def slow_targets(sizes):
    """Targets of {source: size}: share by weight, caps at twice the size, excess shared again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    order += [None] if None in sizes else []
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, open_, left = {}, list(order), 1.5 * sum(sizes.values())
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > 2 * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def check_mix(found, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, of = defaultdict(int), {}
    for doc, source, text in docs:
        sizes[source] += size(text)
        of[doc] = (source, size(text))
    goal = slow_targets(sizes)
    taken = defaultdict(int)
    for r in found:
        source, n = of[r.doc_id]
        assert (r["size"], r.source_size) == (n, sizes[source])
        assert r.target == pytest.approx(goal[source], abs=1e-6) and 0 <= r.taken <= 2 * n
        taken[source] += r.taken
    assert len(found) == len(docs)
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)


def test_mixing_query(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "source", "text").collect()]
    found = queries.op9_mixing(spark, SF_SMALL).collect()
    check_mix(found, docs)
    again = queries.op9_mixing(spark, SF_SMALL).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_mixing_odd_rows(odd, none):
    plan = mixing.mix(odd)
    found = mixing.taken_words(plan).withColumnRenamed("key", "doc_id").collect()
    docs = [tuple(r) for r in odd.select("doc_id", "source", "text").collect()]
    plain = [r for r in found if r.doc_id is not None]
    assert len(found) == len(docs) and all(0 <= r.taken <= 2 * r["size"] for r in plain)
    assert {r.taken for r in found if r["size"] == 0} == {0}
    places = [r.position for r in plan.where("words > 0").collect()]
    assert places == sorted(places) and 0 < places[0] and places[-1] <= 1 + 1e-9
    copies = mixing.mixed_documents(odd)
    assert copies.columns == odd.columns
    assert {r.text for r in copies.select("text").collect()} <= {t for _, _, t in docs}
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


@pytest.mark.parametrize(("start", "end"), [mixing.RAMP, mixing.RAMP[::-1], (1.0, 1.0), (2.0, 0.0)])
def test_schedule_is_inverted(spark, start, end):
    """The share spent by a time, as the integral of the weights tells it, leads back to the time."""
    times = np.linspace(0, 1, 11)
    spent = lambda t: start * t + (end - start) * t * t / 2
    frame = spark.createDataFrame([(float(t), float(spent(t) / spent(1.0))) for t in times], "t double, done double")
    found = frame.select("t", mixing._when(F.col("done"), F.lit(start), F.lit(end)).alias("when")).collect()
    assert np.allclose([r.when for r in found], [r.t for r in found], atol=1e-7)


@pytest.mark.parametrize("by", [None, "g"])
@pytest.mark.parametrize("parts", [1, 4])
def test_running_sums(spark, by, parts):
    rng = random.Random(parts)
    data = [(i, rng.choice(["hot", "hot", "a", None]), rng.randint(0, 9)) for i in range(500)]
    frame = spark.createDataFrame(data, "i long, g string, n long").repartition(parts)
    got = {r.i: r.before for r in rows.running_sums(frame, ["i"], "n", by).collect()}
    held = defaultdict(int)
    for i, g, n in data:
        k = g if by else 0
        assert got[i] == held[k]
        held[k] += n


def test_pipeline(spark, documents):
    sf = SF_SMALL
    docs = documents
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == documents.columns, name
        texts = {(r.doc_id, r.text) for r in docs.collect()}
        assert texts <= {(r.doc_id, r.text) for r in before.collect()}
        if name == "quality classifier":
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            good = [d for d, q in labels.items() if q == 1]
            bad = [d for d, q in labels.items() if q == 0]
            assert sum(d in kept for d in good) / len(good) > 0.95
            assert sum(d in kept for d in bad) / max(1, len(bad)) < 0.3
    found = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    check_packing(found, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert docs.count() > 0.5 * documents.count()


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_on_odd_rows(spark, odd, none, stage):
    name, run = corpus_pipeline.STAGES[stage]
    assert run(spark, none, SF_SMALL).count() == 0
    out = run(spark, odd, SF_SMALL)
    out.count()
    if stage < 4:
        assert out.columns == odd.columns
