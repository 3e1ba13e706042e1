"""Licence scans, token counts, token files, quality and language-model scores."""

from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import regex
from odd_tables import SF_SMALL, documents, none, odd, texts  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillframe.llm import licences, ngrams, quality, queries, token_files, tokens
from quillframe.sources import artifacts

BYTES, WORDS = (queries.tokenizer_file(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def slow_base(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = []
    for phrase, label in licences.BASE_PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    places = [i for i, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(places, default=None), max(places, default=None), labels


def test_licence_query(spark, texts):
    got = {r.doc_id: r for r in queries.op2_licences(spark, SF_SMALL).collect()}
    assert len(got) == len(texts)
    for doc, text in texts:
        r = got[doc]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow_base(text)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)


def test_licence_places_on_random_words():
    rng = random.Random(1)
    vocabulary = "gnu general public license apache cc by mit é x1 MIT License".split()
    scanner = licences.Scanner()
    for _ in range(500):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", "-", ", ", "\n"]) for _ in range(40))
        r = scanner.scan(text)
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
        assert got == slow_base(text)


@pytest.mark.parametrize(
    ("text", "names", "allowed"),
    [
        ("MIT", {"mit"}, True),
        ("GPL-2.0-only", {"gpl-2.0-only"}, False),
        ("GPL-2.0-only OR MIT", {"gpl-2.0-only", "mit"}, True),
        ("GPL-2.0-only AND MIT", {"gpl-2.0-only", "mit"}, False),
        ("MIT AND GPL-2.0-only OR Apache-2.0", {"mit", "gpl-2.0-only", "apache-2.0"}, True),
        ("MIT AND (GPL-2.0-only OR Apache-2.0)", {"mit", "gpl-2.0-only", "apache-2.0"}, True),
        ("Apache-2.0 WITH LLVM-exception AND ISC", {"apache-2.0", "isc"}, True),
        ("(MIT", None, None),
        ("MIT Apache-2.0", None, None),
        ("OR MIT", None, None),
        ("MIT AND", None, None),
        ("MIT)", None, None),
        ("()", None, None),
        ("", None, None),
    ],
)
def test_expressions(text, names, allowed):
    found = licences.evaluate(text)
    assert found.valid == (names is not None)
    assert found.identifiers == (names or set()) and found.allowed == bool(allowed)


@pytest.mark.parametrize(
    ("tail", "expression", "labels", "permissive"),
    [
        ("MIT This file is part of X", "mit", "mit", True),
        ("MIT OR (GPL-2.0 WITH x) the rest and more", "mit or (gpl-2.0 with x)", "gpl-2.0,mit", True),
        ("(GPL-2.0 AND MIT) (see below)", "(gpl-2.0 and mit)", "gpl-2.0,mit", False),
        ("Apache-2.0) in a comment", "apache-2.0", "apache-2.0", True),
        ("MIT AND", "mit", "mit", True),
        ("(MIT this is open) or", "", "", False),
        ("the tag is used", "", "", False),
        ("(MIT OR Apache-2.0) and more text", "(mit or apache-2.0)", "apache-2.0,mit", True),
        ("MIT/Apache-2.0", "mit/apache-2.0", "apache-2.0,mit", True),
        ("GPL-3.0-or-later AND LicenseRef-own.", "gpl-3.0-or-later and licenseref-own.", "gpl-3.0-or-later,licenseref-own", False),
    ],
)
def test_licence_expression_ends_where_prose_begins(tail, expression, labels, permissive):
    found = licences.Scanner().scan(f"/* SPDX-License-Identifier: {tail}")
    assert found["expressions"] == [expression]
    assert found["labels"] == labels and found["permissive"] is permissive
    assert found["score"] == pytest.approx(1 - 0.1 ** len(labels.split(",")) if labels else 0.0)


def plain_expression(tokens):
    """(names, allowed) by precedence climbing, or None where the tokens are no expression."""
    tokens = list(tokens)

    def operand():
        token = tokens.pop(0) if tokens else None
        if token == "(":
            inner = climb(1)
            if inner is None or not tokens or tokens.pop(0) != ")":
                return None
            return inner
        if token in (None, ")", "or", "and", "with"):
            return None
        return {token}, token in licences.PERMISSIVE

    def climb(least):
        left = operand()
        while left and tokens and licences.BINDING.get(tokens[0], 0) >= least:
            operator = tokens.pop(0)
            right = climb(licences.BINDING[operator] + 1)
            if right is None:
                return None
            if operator == "with":
                continue
            allowed = left[1] or right[1] if operator == "or" else left[1] and right[1]
            left = (left[0] | right[0], allowed)
        return left

    whole = climb(1)
    return whole if whole and not tokens else None


def test_licence_labels_and_score_on_random_texts():
    """Own labels and scores against a plain search of every prefix and every notice."""
    rng = random.Random(4)
    words = ["MIT", "GPL-2.0-only", "and", "or", "with", "(", ")", "Apache-2.0", "the", "LicenseRef-a", "isc"]
    notices = ["Mozilla Public License", "CC-BY-SA 4.0", "GNU General Public License, version 2", "x"]
    scanner = licences.Scanner()
    for _ in range(400):
        lines, labels, doubt = [], set(), 1.0
        permissive, found = None, set()
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.4:
                lines.append(rng.choice(notices))
                continue
            tokens = [rng.choice(words) for _ in range(rng.randint(0, 7))]
            lines.append("SPDX-License-Identifier: " + " ".join(tokens))
            lower = [t.lower() for t in tokens]
            best = None
            for n in range(len(lower), 0, -1):
                known = all(
                    t in "()" or t in licences.BINDING or licences.known(t) or (i and lower[i - 1] == "with")
                    for i, t in enumerate(lower[:n])
                )
                if known and (best := plain_expression(lower[:n])):
                    break
            names, allowed = best or (set(), False)
            permissive = allowed and permissive is not False
            found |= {("tag", name) for name in names}
            labels |= names
        text = "\n".join(lines)
        flat = " " + " ".join(re.findall("[0-9a-z]+", text.lower())) + " "
        for phrase, name in licences.NOTICES.items():
            if f" {phrase} " in flat:
                labels.add(name)
                found.add(("notice", name))
        for phrase, name in licences.BASE_PHRASES.items():
            if f" {phrase} " in flat:
                labels.add(name)
                found.add(("phrase", name))
        for kind, _ in found:
            doubt *= 1 - licences.WEIGHTS[kind]
        got = scanner.scan(text)
        assert got["labels"] == ",".join(sorted(labels)), text
        assert got["score"] == pytest.approx(1 - doubt) and got["permissive"] is permissive


def test_licence_work_is_linear_in_tags():
    started = time.perf_counter()
    found = licences.Scanner().scan("SPDX-License-Identifier: mit or " * 60_000)
    assert found["labels"] == "mit" and len(found["expressions"]) == 60_000
    licences.Scanner().scan("SPDX-License-Identifier: " * 80_000)
    assert time.perf_counter() - started < 30


def test_licence_odd_rows(odd, none):
    rows = licences.scan_licences(odd).collect()
    assert len(rows) == odd.count()
    tagged = next(r for r in rows if r.doc_id == 8)
    assert tagged.labels == "apache,apache-2.0,gpl-2.0,mit" and tagged.base_labels == "apache"
    assert tagged.permissive and tagged.expressions == ["mit or (gpl-2.0 with x)"]
    blank = next(r for r in rows if r.doc_id == 0)
    assert (blank.n_words, blank.n_base, blank.first_word, blank.labels, blank.score) == (0, 0, None, "", 0)
    assert licences.scan_licences(none).count() == 0


PARTS = [
    *("a b The é 12 ... 日本 Σ İ 's don't <|endoftext|> <|startoftext|> THE!! %%% ʼn K".split()),
    *[" ", " ", "  ", "   ", "\n", " \n", "\t", "\x1c", "　", "\x85", " ", " <|endoftext|>", "é"],
]


@pytest.mark.parametrize("slice_bytes", [64, 1 << 20])
def test_tokens_equal_the_library(monkeypatch, slice_bytes, texts):
    monkeypatch.setattr(tokens, "SLICE_BYTES", slice_bytes)
    rng = random.Random(slice_bytes)
    some = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    some += [None, "", " ", "".join(rng.choice(PARTS) for _ in range(3000)), *[t for _, t in texts[:60]]]
    whole = [t or "" for t in some]
    want = [len(e) for e in Tokenizer.from_file(BYTES).encode_batch(whole, add_special_tokens=False)]
    assert tokens.count_batch(BYTES, pa.array(some)).tolist() == want
    want = [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(whole, add_special_tokens=False)]
    lengths, ids = tokens.encode_batch(WORDS, pa.array(some))
    assert lengths.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 10)
    monkeypatch.setattr(tokens, "CACHED_PIECES", 10)
    own = tokens.Encodings(WORDS)
    for i in range(50):
        own.of(pa.array([f"word{chr(97 + i % 26)}{chr(97 + i // 26)}"]), True)
        assert len(own.words) <= 11


def test_token_count_query(spark, texts):
    got = {r.doc_id: r for r in queries.op3_token_counts(spark, SF_SMALL).collect()}
    encoded = Tokenizer.from_file(BYTES).encode_batch([t or "" for _, t in texts], add_special_tokens=False)
    for (doc, text), e in zip(texts, encoded, strict=True):
        want = (doc, len((text or "").encode()), len(e), len(e) > 512)
        assert tuple(got[doc]) == want
    assert len(got) == len(texts)


def test_token_counts_odd_rows(odd, none):
    rows = tokens.token_counts(odd, BYTES, 512).collect()
    assert len(rows) == odd.count()
    assert {(r.n_bytes, r.n_tokens) for r in rows if r.doc_id in (0, 1)} == {(0, 0)}
    assert tokens.token_counts(none, BYTES, 512).count() == 0


def slow_ids(texts, end):
    encoded = Tokenizer.from_file(WORDS).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, end] for e in encoded]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_file_query(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op8_token_files(spark, SF_SMALL).collect()}
    texts = sorted(texts)
    start = 0
    for (doc, _), ids in zip(texts, slow_ids([t for _, t in texts], 2), strict=True):
        assert got[doc] == (start, len(ids), crc(ids))
        start += len(ids)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, odd, tmp_path, encoding):
    path = str(tmp_path / "files")
    token_files.write_token_files(odd, path, WORDS, 2, encoding=encoding)
    files = token_files.TokenFiles(spark, path)
    rows = sorted(files.tokens().collect(), key=lambda r: r.start)
    keys = [r.key for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and len(rows) == odd.count()
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    texts = {r.doc_id: r.text for r in odd.where("doc_id is not null").select("doc_id", "text").collect()}
    known = [r for r in rows if r.key is not None]
    assert [r.ids for r in known] == slow_ids([texts[r.key] for r in known], 2)
    assert {r.n_tokens for r in rows if r.key == 1} == {1}
    names = [f for f in (tmp_path / "files/tokens").iterdir() if f.name.endswith(".parquet")]
    found = set()
    for f in names:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(4)
            assert column.has_offset_index
            found |= set(column.encodings)
    assert ("DELTA_BINARY_PACKED" in found) == (encoding == "delta")


def test_token_files_selective(spark, odd, none, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "files")
    token_files.write_token_files(odd, path, WORDS, 2)
    files = token_files.TokenFiles(spark, path)
    picked = files.tokens(F.col("key") == 8)
    assert [r.key for r in picked.collect()] == [8]
    assert "EqualTo(key,8)" in picked._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in files.metadata()._jdf.queryExecution().executedPlan().toString()
    token_files.write_token_files(none, path + "0", WORDS, 2)
    assert token_files.TokenFiles(spark, path + "0").checksums().count() == 0


def test_quality_query_on_held_out_rows(spark, documents):
    got = queries.op7_quality(spark, SF_SMALL.replace("0.001", "0.01"))
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    right = [r.predicted == r.quality for r in held]
    assert len(held) > 50 and sum(right) / len(right) > 0.95
    clean = [r.predicted for r in held if r.quality == 1]
    assert sum(clean) / len(clean) > 0.97


def test_quality_tokens_are_runs_of_one_kind():
    texts = ["", "Ab12 ab\t12!!", "  ", "\u00e9t\u00e9x,\x0b,A", "no", "", "xx" * 5000 + "9", "Ab12"]
    runs = regex.compile(rb"[a-z\x80-\xff]+|[A-Z]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0D]+")
    want = [(i, t) for i, x in enumerate(texts) for t in runs.findall(x.encode())]
    for part in (pa.array(texts), pa.array(["skipped", *texts]).slice(1)):
        rows, digests, kinds = quality.tokens_of(part)
        assert rows.tolist() == [i for i, _ in want]
        named = dict(zip((t for _, t in want), digests.tolist()))
        assert digests.tolist() == [named[t] for _, t in want]
        assert len(set(named.values())) == len(named)
        assert kinds[:4].tolist() == [1, 0, 2, 0]
    assert len(quality.tokens_of(pa.array(["", " "]))[0]) == 0


def test_quality_word_vectors_come_from_all_texts(spark):
    docs = [(0, "one two"), (1, "two three"), (2, "three four four"), (3, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    for n in (quality.BUCKETS, 1000, 70_000):
        model = quality.fit_quality(frame, labels, n_buckets=n)
        want = np.zeros((n, quality.DIM))
        for _, text in docs[:3]:
            _, digests, _ = quality.tokens_of(pa.array([text]))
            vectors, at = quality.index_vectors(digests), quality.buckets_of(digests, n)
            np.add.at(want, at[:-1], vectors[1:])
            np.add.at(want, at[1:], vectors[:-1])
        assert model.table.shape == want.shape and (model.table == want).all()


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(3, 1), (5, 1), (8, 0), (9, 0), (4, None), (6, 1), (6, 0), (None, 1), (10, 1)],
        "doc_id long, quality int",
    )
    model = quality.fit_quality(odd, labels)
    rows = quality.score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    kept = quality.keep_quality(odd, model, 0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert quality.score_quality(none, model).count() == 0
    untrained = quality.fit_quality(none, labels)
    assert quality.score_quality(odd.limit(3), untrained).count() == 3


def test_quality_does_not_depend_on_layout(spark, documents):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    scores = []
    for n in (1, 5):
        model = quality.fit_quality(documents.repartition(n), labels)
        rows = quality.score_quality(documents, model).collect()
        scores.append({r.doc_id: r.score for r in rows})
    assert scores[0] == pytest.approx(scores[1], abs=1e-9)


def slow_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


def slow_base_scores(train, texts):
    counts = Counter(w for t in train for w in slow_words(t))
    floor = sum(counts.values()) + len(counts) + 1
    out = []
    for t in texts:
        words = slow_words(t)
        out.append(
            (len(words), sum(w in counts for w in words), sum(math.log10((counts[w] + 1) / floor) for w in words))
        )
    return sum(counts.values()), out


def test_lm_query(spark, texts):
    got = {r.doc_id: r for r in queries.op10_lm_score(spark, SF_SMALL).collect()}
    held = {doc: zlib.crc32(str(doc).encode()) % 7 == 2 for doc, _ in texts}
    total, want = slow_base_scores([t for d, t in texts if not held[d]], [t for _, t in texts])
    for (doc, _), (n, known, base) in zip(texts, want, strict=True):
        r = got[doc]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[doc], n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    seen = [r for r in got.values() if not r.held_out]
    assert sum(r.score for r in seen) > sum(r.base_score for r in seen)


def slow_scores(train, texts):
    """The model's log10 probabilities, with exact counts in place of the filter."""
    words, pairs = Counter(), Counter()
    for t in train:
        run = slow_words(t)
        words.update(run)
        pairs.update(zip([run[-1], *run], run))  # a text begins after an end
    total, distinct = sum(words.values()), len(words)
    spare = distinct / 2**ngrams.PROBES
    spare += 5 * math.sqrt(spare) + 1
    out = []
    for t in texts:
        run, score = slow_words(t), 0.0
        for before, word in zip([run[-1], *run], run):
            p = (words[word] + 1) / (total + distinct + 1)
            if words[before]:
                n = pairs[before, word]
                share = 2 ** (n.bit_length() - 1) / (words[before] + spare) if n else 0.0
                p = ngrams.MIX * share + (1 - ngrams.MIX) * p
            score += math.log10(p)
        out.append(score)
    return out


def test_lm_scores_by_hand(spark, texts):
    held = [zlib.crc32(str(doc).encode()) % 7 == 2 for doc, _ in texts]
    want = slow_scores([t for (_, t), h in zip(texts, held) if not h], [t for _, t in texts])
    got = {r.doc_id: r.score for r in queries.op10_lm_score(spark, SF_SMALL).collect()}
    off = [got[doc] - w for (doc, _), w in zip(texts, want, strict=True)]
    assert min(off) > -1e-6  # a false answer can only raise a score
    assert np.mean(np.abs(off) < 1e-6) > 0.5 and sum(off) < 0.002 * abs(sum(want))


def test_lm_probabilities_add_up(spark):
    rng = np.random.default_rng(3)
    vocab = np.array([f"w{i}" for i in range(400)])
    lines = [" ".join(vocab[np.minimum(rng.zipf(1.3, 30) - 1, 399)]) for _ in range(300)]
    # One context with seven followers that differ, one that always has the same.
    lines += [f"seven f{i} always same" for i in range(7)]
    model = ngrams.train(spark.createDataFrame([(x,) for x in lines], "text string"))
    held = model.tables.collect()
    counts = ngrams.WordCounts([(r["keys"], r["counts"]) for r in held])
    grams = ngrams.Filter(model.segments, {r["segment"]: (r["filter"], r["bits"]) for r in held})
    known = counts.keys.astype(np.uint64)
    words = np.append(known, np.uint64(12345))  # an unknown one too
    assert len(known) == model.distinct
    for before in [*words[:200], words[-1], *ngrams.word_keys(pa.array(["seven always"]))[1]]:
        ahead = np.full(len(words), before, np.uint64)
        p = ngrams.probabilities(
            counts.of(words), counts.of(ahead), grams.probe(ngrams.pair_keys(ahead, words)),
            model.total, model.distinct,
        )
        assert p.min() > 0 and p.sum() <= 1 + 1e-12
    assert p.sum() > 0.3


def test_filter_holds_quantised_counts():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**64, 20_000, np.uint64)
    counts = np.minimum(rng.zipf(1.7, 20_000), 10**6)
    segments = 7
    parts = {}
    for s in range(segments):
        own = keys % np.uint64(segments) == s
        parts[s] = ngrams.build_segment(keys[own], counts[own])
    probed = ngrams.Filter(segments, parts).probe(keys)
    want = ngrams.quantised(counts)
    assert (probed >= want).all() and (probed > want).mean() < 0.001
    absent = ngrams.Filter(segments, parts).probe(rng.integers(0, 2**64, 200_000, np.uint64))
    assert (absent > 0).mean() < 1.5 * 2**-ngrams.PROBES
    some = {s: parts[s] for s in (2, 5)}  # a task that holds two segments knows theirs only
    home = keys % np.uint64(segments)
    assert (ngrams.Filter(segments, some).probe(keys) == np.where((home == 2) | (home == 5), probed, 0)).all()
    assert ngrams.quantised(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4]


@pytest.mark.parametrize("slice_bytes", [300, 1 << 20])
def test_lm_odd_rows_both_ways(odd, none, monkeypatch, slice_bytes):
    monkeypatch.setattr(ngrams, "SEGMENT_BYTES", 400_000)
    texts = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect() if r.doc_id not in (10, 11)]
    small = odd.where("doc_id is null or doc_id < 10")
    model = ngrams.train(small)
    assert ngrams.train(odd).segments > 3
    runs = []
    for most in (1 << 30, 0):
        rows = ngrams.score(small, model, most=most).collect()
        runs.append(sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score) for r in rows))
    assert np.allclose(np.array(runs[0], float), np.array(runs[1], float), rtol=1e-9)
    total, want = slow_base_scores([t for _, t in texts], [t for _, t in texts])
    assert model.total == total
    got = sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in ngrams.score(small, model).collect())
    assert got == sorted((n, k, round(b, 6)) for n, k, b in want)
    assert ngrams.score(none, model).count() == 0
    blank = ngrams.train(none)
    assert blank.total == 0 and ngrams.score(small, blank).where("n_known = 0").count() == len(texts)


def test_lm_in_parts_scores_as_in_one(odd, monkeypatch):
    monkeypatch.setattr(ngrams, "SEGMENT_BYTES", 400_000)
    model = ngrams.train(odd)
    runs = []
    for part_bytes in (1 << 30, 1):
        monkeypatch.setattr(ngrams, "PART_BYTES", part_bytes)
        rows = ngrams.score(odd, model)  # the one before has let go of its parts on executors
        runs.append(rows.orderBy("doc_id", "n_tokens", "score").collect())
    assert runs[0] == runs[1] and len(runs[0]) == odd.count()


@pytest.mark.parametrize("piece_bytes", [1_000, 1 << 20])
def test_lm_pieces_in_turns_score_as_by_broadcast(odd, monkeypatch, piece_bytes):
    monkeypatch.setattr(ngrams, "SEGMENT_BYTES", 4_000_000)
    few = odd.withColumn("text", F.substring("text", 1, 20_000)).repartition(3)
    model = ngrams.train(few)
    wanted = ngrams.score(few, model).collect()
    monkeypatch.setattr(ngrams, "PIECE_BYTES", piece_bytes)
    monkeypatch.setattr(ngrams, "TURN_BYTES", 5_000)  # long texts are cut, over several turns
    found = ngrams.score(few, model, most=0)
    assert found.schema == ngrams.score(few, model).schema
    in_order = lambda rows: sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    wanted, found = in_order(wanted), in_order(found.collect())
    assert [r[:3] for r in found] == [r[:3] for r in wanted]
    assert np.allclose([r[3:] for r in found], [r[3:] for r in wanted], rtol=1e-12)


def test_lm_by_shuffle_keeps_little_on_disk(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(11)
    vocab = np.array([f"word{i}" for i in range(20_000)])
    lines = [" ".join(vocab[rng.integers(0, 20_000, 400)]) for _ in range(600)]
    path = str(tmp_path / "texts")
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    model = ngrams.train(docs)

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        files = [files.apply(i) for i in range(files.size())]
        return sum(f.length() for f in files if f.getName().startswith("shuffle_"))

    written = []
    first, kept = shuffled(), artifacts.shared_path

    def noted(spark, name):
        written.append(kept(spark, name))
        return written[-1]

    monkeypatch.setattr(artifacts, "shared_path", noted)
    monkeypatch.setattr(ngrams, "shared_path", noted, raising=False)
    assert ngrams.score(docs, model, most=0).count() == 600
    on_disk = sum(f.stat().st_size for p in written for f in Path(p.removeprefix("file:")).rglob("*.parquet"))
    time.sleep(1)
    text = sum(map(len, lines))
    assert shuffled() - first + on_disk < text


def test_long_text_is_one_text(monkeypatch):
    text = "ab cd ef gh ij " * 50
    whole = list(ngrams.token_runs(pa.array(["x y", text, "z"])))
    monkeypatch.setattr(ngrams, "SLICE_BYTES", 20)
    cut = list(ngrams.token_runs(pa.array(["x y", text, "z"])))
    assert len(cut) > 10
    for i in range(3):
        assert np.concatenate([x[i] for x in cut]).tolist() == np.concatenate([x[i] for x in whole]).tolist()


def test_slices_of_many_lanes_add_up(spark, monkeypatch, documents):
    texts = documents.select("text").repartition(7)
    whole = quality.neighbour_sums(texts, 500)
    monkeypatch.setattr(quality, "LANE", 2)
    assert (quality.neighbour_sums(texts, 500) == whole).all() and whole.any()


def test_temperature_calibrates_rows_it_has_not_seen():
    """Noisy classes: an overconfident network is cooled, and probabilities are shares on new rows."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 30))
    chance = 1 / (1 + np.exp(-1.5 * x[:, 0] - x[:, 1]))
    y = (rng.random(3000) < chance).astype(int)
    seen, held = np.arange(3000) < 1200, np.arange(1200) % 4 == 0
    net = quality.fit_network(x[seen], y[seen], held)
    assert 1 <= net.temperature < np.exp(3)
    p, t = net.probabilities(x[~seen]), y[~seen]
    bins = np.minimum((p * 10).astype(int), 9)
    error = sum(abs(p[bins == b].mean() - t[bins == b].mean()) * (bins == b).mean() for b in set(bins))
    assert error < 0.08
    apart = quality.fit_network(x[seen], (x[seen][:, 0] > 0).astype(int), held)
    assert apart.temperature >= 1
    sure = apart.probabilities(x[~seen])
    assert 1e-9 < sure.min() < 0.02 and 0.98 < sure.max() < 1 - 1e-9


def test_network_probabilities_against_plain_sums():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 5))
    net = quality.fit_network(x, (x[:, 0] > 0).astype(int), np.arange(60) % 5 == 0)
    for row, got in zip(x, net.probabilities(x)):
        hidden = [
            np.tanh(sum((row[i] - net.mean[i]) / net.scale[i] * net.w1[i, h] for i in range(5)) + net.b1[h])
            for h in range(len(net.b1))
        ]
        z = sum(a * b for a, b in zip(hidden, net.w2)) + net.b2
        assert got == pytest.approx(1 / (1 + np.exp(-z / net.temperature)))
