"""SimHash groups, exact groups and connected components against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from odd_tables import SF_SMALL, documents, none, odd, texts  # noqa: F401
from pyspark.sql import functions as F

from quillframe.llm import exact, graph, mixing, ngrams, packing, queries, rows, simhash


def slow_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, bits):
    """Smallest position reachable from each, over links of at most ``bits`` bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("most", [0, 2, 5])
def test_rows_left_are_the_same_by_broadcast_and_by_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(rows, "DROPPED_ROWS", most)
    left = rows.without(spark.range(10).toDF("uid"), spark.range(3, 6).toDF("uid"))
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (most >= 3)
    assert sorted(r.uid for r in left.collect()) == [0, 1, 2, 6, 7, 8, 9]


def test_simhash_query(spark, texts):
    got = {r.doc_id: r for r in queries.op1_simhash(spark, SF_SMALL).collect()}
    texts = sorted(texts)
    prints = [slow_fingerprint(t) for _, t in texts]
    for (doc, _), fp, root in zip(texts, prints, slow_groups(prints, 4), strict=True):
        assert got[doc].fingerprint == f"{fp:016x}"
        assert got[doc].component_id == texts[root][0]
    assert len(got) == len(texts)


@pytest.mark.parametrize("blocks", [2, 3, 4])
@pytest.mark.parametrize("bits", [0, 3, 4])
def test_links_connect_all_that_is_near(spark, bits, blocks):
    rng = random.Random(bits)
    centres = [rng.getrandbits(64) for _ in range(60)]
    prints = set(centres)
    for c in centres:  # chains, and rings at every distance from 1 to 9
        at = c
        for step in range(1, 10):
            prints.add(c ^ sum(1 << b for b in rng.sample(range(64), step)))
            at ^= sum(1 << b for b in rng.sample(range(64), 4))
            prints.add(at)
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp long").repartition(3)
    found = simhash.links(frame, bits, blocks).collect()
    place = {p: i for i, p in enumerate(prints)}
    joined = [(place[r.a % 2**64], place[r.b % 2**64]) for r in found]
    assert all((prints[i] ^ prints[j]).bit_count() <= bits * 2 * len(prints) for i, j in joined)
    root = {i: i for i in range(len(prints))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in joined:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    assert [find(i) for i in range(len(prints))] == slow_groups(prints, bits)


def test_large_cell_is_whole():
    rng = np.random.default_rng(1)
    flips = np.array([[1 << int(b) for b in rng.choice(64, 3, replace=False)] for _ in range(3000)], np.uint64)
    fps = np.unique(np.bitwise_or.reduce(flips, axis=1))
    cell = np.zeros(2 * len(fps), np.int64)
    home = np.repeat([False, True], len(fps))
    a, _ = simhash._links_in(cell, np.concatenate([fps, fps]), home, 6)
    assert len(a) == len(fps) - 1  # all within 6 bits of each other: one tree


def test_simhash_odd_rows(odd, none):
    rows = simhash.near_groups(odd).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r.fp == 0]
    assert {r.component for r in empty} == {0} and any(r.key is None for r in empty)
    alone = [r for r in rows if r.key is None and r.fp != 0]
    assert [r.component for r in alone] == [None]
    assert {r.component for r in rows if r.key in (5, 6, 7)} == {5}
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    keys = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(k for k in keys if k is not None) == [0, 3, 4, 5, 8, 9, 10] and keys.count(None) == 1
    assert simhash.near_groups(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(200)]
    links += [(1000, 1000 + i) for i in range(1, 300)] + [(3000 - i, 3000) for i in range(1, 300)]
    links += [(5000 + i, 5000 + (i + 1) % 97) for i in range(97)] + [(9, 9), (7, 8), (8, 7)]
    random.Random(3).shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in graph.components(frame).collect()}
    want = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    want |= {3000 - i: 2701 for i in range(300)} | {5000 + i: 5000 for i in range(97)}
    assert got == want
    assert graph.components(frame.limit(0)).count() == 0


def test_exact_odd_rows(odd, none):
    rows = exact.exact_groups(odd).collect()
    assert len(rows) == odd.count() and sum(r.kept for r in rows) == len({r.digest for r in rows})
    by = {r.key: r for r in rows if r.key is not None}
    assert by[0].keep_id == 2 and by[0].group_size == 7  # white space counts as code points
    assert by[5].keep_id == 6 and by[5].group_size == 43
    assert by[10].keep_id == 10 and by[11].keep_id == 10 and by[10].group_size == 3
    assert bytes(by[3].digest).hex() == hashlib.sha256(b"one").hexdigest()
    kept = exact.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    keys = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(k for k in keys if k is not None) == [2, 3, 4, 6, 8, 9, 10] and keys.count(None) == 1
    assert exact.exact_groups(none).count() == 0


def test_index_outlives_its_batch(spark, odd, tmp_path):
    first = exact.DigestIndex(spark, str(tmp_path / "index"), 4)
    a = odd.where("doc_id in (3, 4, 5)")
    assert exact.deduplicate(a, first).where("kept").count() == 3
    first.close()
    again = exact.DigestIndex(spark, str(tmp_path / "index"), 4)
    rows = exact.deduplicate(odd.where("doc_id in (5, 6, 8)"), again).collect()
    assert {(r.key, r.keep_id, r.kept) for r in rows} == {(5, 5, False), (6, 5, False), (8, 8, True)}
    assert again.rows().count() == again.rows().distinct().count() == 4
    plan = again.rows().hint("merge").join(a.selectExpr("unhex(sha2(text, 256)) AS digest").hint("merge"), "digest")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1  # the index is read in its buckets
    again.close()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = duck.sql(queries.ORACLES[name]).to_arrow_table()
    got = queries.QUERIES[name](spark, SF_SMALL).toArrow().select(want.column_names)
    assert got.schema.types == want.schema.types
    rows = lambda t: sorted(zip(*[c.to_pylist() for c in t.columns], strict=True))
    assert rows(got) == rows(want)


@pytest.fixture
def scattered(spark, tmp_path):
    """Documents in twelve files, some of them equal or near; read in one split or in twelve."""
    base = "the quick brown fox jumps over the lazy dog again and again"
    texts = [f"{base} {i % 20}" if i % 3 else f"text {i} {base[i:]} {i * i}" for i in range(96)]
    data = [(i, t, f"s{i % 2}") for i, t in enumerate(texts)]
    path = str(tmp_path / "twelve files, 100%")
    spark.createDataFrame(data, "doc_id long, text string, source string").repartition(12).write.parquet(path)

    def splits(n):
        spark.conf.set("spark.sql.files.minPartitionNum", n)
        return spark.read.parquet(path)

    yield splits
    spark.conf.unset("spark.sql.files.minPartitionNum")


def test_numbered_rows_are_the_same_each_time(spark, scattered):
    docs = scattered(12)
    frames = [
        docs.union(docs),
        docs.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")),
        docs.where(F.rand() < 2).unionAll(docs),
        docs.repartition(5).union(docs),
        docs.join(docs.select("doc_id", F.lit(1).alias("uid")), "doc_id").union(docs.withColumn("uid", F.lit(2))),
    ]
    for frame in frames:
        written = rows.numbered(frame)
        spark.conf.set("spark.sql.files.minPartitionNum", 1)
        one = {r.uid: r.row.doc_id for r in written.collect()}
        spark.conf.set("spark.sql.files.minPartitionNum", 40)
        assert one == {r.uid: r.row.doc_id for r in written.collect()} and len(one) == 192


@pytest.mark.parametrize("files", [1, 200])
def test_dropped_and_mixed_rows_whatever_they_are_read_from(spark, tmp_path, files):
    """Tables of one file, of very many, and rows that come from no file."""
    base = "the quick brown fox jumps over the lazy dog again and again"
    texts = [f"{base} {i % 40}" for i in range(80)] + [f"{i} apart {base[i:]} {i * i} {i}" for i in range(20)]
    data = [(i, t, f"s{i % 2}") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    path = str(tmp_path / "table")
    frame.repartition(files).write.option("maxRecordsPerFile", 100 if files == 1 else 1).parquet(path)
    want = {min(i for i, u in enumerate(texts) if u == t) for t in texts}
    near = None
    scan = spark.read.parquet(path)
    for docs, still in ((scan, False), (scan, True), (frame, True), (scan.where(F.rand() < 2), False)):
        # Lines are drawn in other splits than they were numbered in.
        dropped = exact.drop_exact_duplicates(docs, at_rest=still)
        spark.conf.set("spark.sql.files.minPartitionNum", 3)
        assert {r.doc_id for r in dropped.collect()} == want
        spark.conf.unset("spark.sql.files.minPartitionNum")
        kept = {r.doc_id for r in simhash.drop_near_duplicates(docs, at_rest=still).collect()}
        groups = simhash.near_groups(docs).select("key", "component").distinct().collect()
        assert kept == {r.component for r in groups} <= want
        assert near in (None, kept)
        near = kept
        plan = mixing.mix(docs).where("words * 2 >= size AND words > 0").groupBy("key").count().collect()
        mixed = mixing.mixed_documents(docs, at_rest=still).groupBy("doc_id").count().collect()
        assert {(r[0], r[1]) for r in mixed} == {(r[0], r[1]) for r in plan} and mixed


def test_rows_at_rest_keep_their_numbers(spark, scattered):
    found = []
    for n in (1, 12):
        docs = rows.numbered(scattered(n).where("doc_id <> 5"), at_rest=True)
        found.append({tuple(r.uid): r.row.doc_id for r in docs.collect()})
    assert found[0] == found[1] and sorted(found[0].values()) == [i for i in range(96) if i != 5]


@pytest.mark.parametrize("name", ["exact", "mixed", "packed", "scored"])
def test_rows_meet_their_numbers_in_other_splits(scattered, spark, name):
    """The later scans of a query are planned in other splits than its first."""
    path = queries.tokenizer_file("word_bpe_49k.json")
    run = {
        "exact": exact.drop_exact_duplicates,
        "mixed": mixing.mixed_documents,
        "packed": lambda docs: packing.pack_documents(docs, path, 64).drop("sequence_id", "offset"),
        "scored": lambda docs: ngrams.score(docs, ngrams.train(docs), most=0).select(
            "doc_id", "n_tokens", "n_known"
        ),
    }[name]
    found = []
    for first, later in ((12, 12), (12, 1)):
        frame = run(scattered(first))
        scattered(later)
        found.append(sorted(map(tuple, frame.collect()), key=repr))
    assert found[0] == found[1] and found[0]
    if name == "packed":
        scattered(12)
        frame = packing.pack_documents(scattered(12), path, 64)
        scattered(1)
        sequences = {}
        for r in frame.collect():
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in sequences.values():
            ends = [o + n for o, n in sorted(parts)]
            assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 64
