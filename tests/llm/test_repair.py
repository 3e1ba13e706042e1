"""Conversation repair, embedding whitening and SentencePiece pieces, against plain versions."""

from __future__ import annotations

import random
import re
from functools import lru_cache
from hashlib import sha256
from itertools import product
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from odd_tables import LONG, SF_SMALL, documents, none, odd, texts  # noqa: F401

from quillframe.llm import dialogue, queries, sentencepieces, whitening

LEGAL = re.compile("(s?(ua)+)?")


# --- conversations ---------------------------------------------------------------------------


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = lambda v: " " if v is None else str(v)
        role, text = shown(role), shown(text)
        draw = crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def plain_faults(turns):
    seen, faults = set(), []
    for role, text in turns:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault = "b" if not last else "d" if (role, text) in seen else "t" if last[0] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    return faults


def plain_repair(turns):
    """(cost, audit, repaired) by trying everything: prefixes of the repaired roles as states."""
    faults = plain_faults(turns)

    @lru_cache(None)
    def best(at, said, inserted):
        """Least (cost, audit, lines) from a turn on, ``said`` the last initials that matter."""
        found = []
        if at == len(turns) and said in ("", "a"):
            found.append((0, "", ()))
        fits = lambda initial: (said, initial) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
        if inserted < 3:
            for role in ("user", "assistant"):
                if fits(role[0]):
                    cost, audit, lines = best(at, role[0], inserted + 1)
                    found.append((3 + cost, "I" + audit, (f"{role}:", *lines)))
        if at < len(turns):
            role, text = turns[at]
            cost, audit, lines = best(at + 1, said, 0)
            found.append((4 + cost, "D" + audit, lines))
            if faults[at] not in ("b", "d"):
                more = 3 if faults[at] == "t" else 0
                for edit, price, name in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                    if fits(name[:1]):
                        cost, audit, lines = best(at + 1, name[:1], 0)
                        found.append((price + more + cost, edit + audit, (f"{name}:{text}", *lines)))
        return min(found) if found else (10**9, "", ())

    return best(0, "", 0)


def plain_result(rows, hurt):
    after = harmed(rows) if hurt else [(c, t, r or " ", x or " ") for c, t, r, x in rows]
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(
            (r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
        )
        numbers = [r[1] for r in mine if r[1] is not None]
        turns = [r[2:] for r in mine]
        faults = plain_faults(turns)
        first = [r[:1] for r, _ in turns]
        cost, audit, lines = plain_repair(tuple(turns))
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(faults.count(f) for f in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])),
            cost,
            audit,
            sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def got(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def random_turns(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", ""]
    words = ["Yes.", "No!", "well", " ", "", "a b?", "so.\n", "x."]
    return [(rng.choice(roles), rng.choice(words)) for _ in range(n)]


def test_walk_is_cheapest_and_least():
    rng = random.Random(3)
    for _ in range(400):
        turns = random_turns(rng, rng.randint(0, 7))
        faults = plain_faults(turns)
        codes = [(r[:1] if r[:1] in "sua" and r else "-") + (f or "-") for (r, _), f in zip(turns, faults)]
        cost, audit, _ = plain_repair(tuple(turns))
        if not turns:
            continue
        whole = dialogue.walk("".join(codes), dialogue.ending(), True)[0]
        assert whole[:2] == (cost, audit)
        for size in (1, 2, 3):  # the same in blocks
            blocks = ["".join(codes[i : i + size]) for i in range(0, len(codes), size)]
            ends = dialogue.checkpoints([dialogue.fold(b) for b in blocks])
            state, pieces, first = 0, [], None
            for i, (b, after) in enumerate(zip(blocks, ends)):
                price, part, to = dialogue.walk(b, after, i + 1 == len(blocks))[state]
                first = price if first is None else first
                pieces.append(part)
                state = to
            assert (first, "".join(pieces)) == (cost, audit)


def test_repaired_roles_are_legal():
    for roles in product("sua-", repeat=4):
        for faults in product("-bt", repeat=4):
            codes = "".join(r + f for r, f in zip(roles, faults))
            _, audit, _ = dialogue.walk(codes, dialogue.ending(), True)[0]
            at, said = 0, ""
            for edit in audit:
                state = 0 if not said else {"s": 1, "u": 2, "a": 3}[said[-1]]
                if edit == "K":
                    said += roles[at]
                elif edit in "RI":
                    said += "--ua"[dialogue.NEXT[state]]
                at += edit != "I"
            assert at == 4 and LEGAL.fullmatch(said)


@pytest.mark.parametrize("least", [2, 256])
@pytest.mark.parametrize("hurt", [False, True])
def test_repair_against_plain(spark, least, hurt):
    rng = random.Random(5)
    rows = []
    for conv in [*range(40), None]:
        for turn, (role, text) in enumerate(random_turns(rng, rng.randint(1, 11))):
            number = None if rng.random() < 0.1 else turn + (turn > 4) * 3
            rows.append((conv, number, role if rng.random() < 0.95 else None, text if rng.random() < 0.95 else None))
    rows += [(77, i, ("user", "assistant")[i % 2], f"turn {i % 9}.") for i in range(60)]  # a long one
    rows += [(78, 0, "user", LONG), (78, 1, "assistant", LONG + " ."), (79, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    frame = frame.selectExpr("*", "1 AS conv", "2 AS pos", "3 AS block", "4 AS `_conv`")
    assert got(dialogue.repair(frame, hurt=hurt, least=least)) == plain_result(rows, hurt)


def test_repair_query_on_all_conversations(spark):
    path = f"{SF_SMALL}/conversations.parquet"
    rows = [tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    found = queries.op13_dialogue(spark, SF_SMALL)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    assert got(found) == plain_result(rows, True)


def test_repair_of_nothing(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dialogue.repair(frame).collect() == []


# --- whitening -------------------------------------------------------------------------------


def test_whitening_query_against_numpy(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    x = np.floor(64 * np.array(table["embedding"].tolist()).astype(float)).astype(np.int64) + 1_000_000
    once = np.unique(x, axis=0)
    n, sums = len(once), once.sum(axis=0)
    centred = once - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    want = (x - sums / n) @ axes[:, :16] / np.sqrt(values[:16])
    rows = queries.op12_whitening(spark, SF_SMALL).toPandas()
    assert len(rows) == 16 * len(table) and set(rows["n"]) == {n}
    wide = rows.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"]].to_numpy()
    assert list(rows["component"].sort_values().unique()) == list(range(1, 17))
    sign = np.sign((wide * want).sum(axis=0))
    assert np.allclose(wide * sign, want, atol=1e-8)
    shares = rows.drop_duplicates("component").sort_values("component")["explained"]
    assert np.allclose(shares, values[:16] / values.sum(), rtol=1e-9)
    exact = {i: int(v) for i, v in zip(table["vec_id"], ((n * x - sums) ** 2).sum(axis=1))}
    assert dict(zip(rows["vec_id"], rows["deviation"])) == exact
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"].iloc[0] < 1e-6


def test_whitening_counts_copies(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 1, (60, 5)).round(1)
    data = [(i, v.tolist()) for i, v in enumerate(vectors)]
    data += [(100 + i, vectors[0].tolist()) for i in range(40)]  # a hot vector
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(4)
    x = np.floor(64 * np.array([v for _, v in data])).astype(np.int64) + 1_000_000
    for counted, fit in ((True, x), (False, np.unique(x, axis=0))):
        found = {r["key"]: r for r in whitening.whiten(frame, components=3, counted=counted).collect()}
        mean = fit.mean(axis=0)
        values, axes = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
        want = (x - mean) @ axes[:, ::-1][:, :3] / np.sqrt(values[::-1][:3])
        have = np.array([found[i]["whitened"] for i, _ in data])
        assert np.allclose(np.abs(have), np.abs(want), atol=1e-8)
        assert found[0]["n"] == len(fit) and found[0]["copies"] == 41
        assert found[0]["identity_error"] < 1e-9


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [0.5, 1.0, 0.0]), (3, None), (6, [])]
    data += [(4, [1.0, None, 2.0]), (5, [nan] * 3), (8, [inf] * 3), (7, [1.0, 2.0]), (9, [1e30, 0.0, -1e30])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS x", "2 AS key", "3 AS d", "4 AS weight"
    )
    rows = whitening.whiten(frame).collect()
    assert sorted((r["key"] or 0, r["copies"], r["n"]) for r in rows) == [
        (0, 1, 3), (1, 2, 3), (1, 2, 3), (7, 1, 1), (9, 1, 3)
    ]
    alone = next(r for r in rows if r["key"] == 7)
    assert alone["whitened"] == [None, None] and alone["deviation"] == 0 and alone["explained"] == [0, 0]
    assert next(r for r in rows if r["key"] == 9)["deviation"] is None  # beyond 64 bits
    assert whitening.whitened_components(whitening.whiten(frame.limit(0))).collect() == []


# --- pieces ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return sentencepieces.piece_model(queries.tokenizer_file("piece_bpe_32k.model"))


def test_agenda_takes_best_pair_then_leftmost():
    rank = {p: n << sentencepieces.PLACE_BITS for p, n in {"ab": 1, "bc": 0, "aa": 2, "aaa": 2}.items()}
    assert sentencepieces.merge("abc", rank) == ["a", "bc"]
    assert sentencepieces.merge("abc", rank | {"abc": 3 << sentencepieces.PLACE_BITS}) == ["abc"]
    assert sentencepieces.merge("aaaaa", rank) == ["aaa", "aa"]
    assert sentencepieces.merge("", rank) == []


def test_texts_against_the_library(model):
    rng = random.Random(1)
    some = [*"ab e  ▁.\n\t日é🙂\x00s", "<0x41>", "the ", " in", "▁▁", "  ", "it's", "don't.\n", "Ünder,"]
    made = ["".join(rng.choices(some, k=rng.randint(0, 12))) for _ in range(4000)]
    made += ["", " ", "▁", "  ", "a ", " a", "x" * 3000, None]
    counts, ids = sentencepieces.encode_texts(model, pa.array(made, pa.string()))
    assert int(counts.sum()) == len(ids)
    for text, n, upto in zip(made, counts.tolist(), np.cumsum(counts).tolist()):
        want = model.library.encode(text or "")
        assert ids[upto - n : upto].tolist() == want
        assert sentencepieces.decode_ids(model, np.array(want, np.int64)).decode() == model.library.decode(want)


def test_decoding_any_ids(model):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([*range(300), *range(300, 32_000, 499)]) for _ in range(rng.randint(0, 9))]
        have = sentencepieces.decode_ids(model, np.array(ids, np.int64)).decode()
        assert have == model.library.decode(ids), ids


def test_a_wrong_unit_is_noticed(model):
    broken = sentencepieces.PieceModel(queries.tokenizer_file("piece_bpe_32k.model"))
    del broken.rank["▁the"]
    with pytest.raises(ValueError, match="differ"):
        broken.of(["▁the"])


def test_pieces_of_odd_and_long_texts(spark, odd, none, model, monkeypatch):  # noqa: F811
    path = queries.tokenizer_file("piece_bpe_32k.model")
    encoded = sentencepieces.encode_pieces(odd, path)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = sorted((str(k), model.library.encode(t or "") + [2]) for k, t in rows)
    assert sorted((str(r["key"]), list(r["ids"])) for r in encoded.collect()) == want
    back = sentencepieces.decode_pieces(encoded, path).collect()
    said = sorted((str(k), model.library.decode(model.library.encode(t or ""))) for k, t in rows)
    assert sorted((str(r["key"]), r["text"]) for r in back) == said
    assert sentencepieces.encode_pieces(none, path).collect() == []
    assert sentencepieces.piece_digests(none, path).collect() == []


def test_long_texts_in_parts(model):
    text = ("Über  the hills,\n" + "and far away " * 50 + "▁ x  ") * 40
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["a", text, "b c"])], names=["key", "text"])
    old, sentencepieces.SLICE_BYTES = sentencepieces.SLICE_BYTES, 1000
    try:
        found = [
            (k, n, ids.tolist())
            for keys, parts in sentencepieces._slices(batch)
            for k, (n, ids) in zip(keys.to_pylist(), sentencepieces._whole(model, parts))
        ]
    finally:
        sentencepieces.SLICE_BYTES = old
    want = [(k, model.library.encode(t)) for k, t in zip([1, 2, 3], ["a", text, "b c"])]
    assert found == [(k, len(ids), ids) for k, ids in want]


def test_pieces_query_against_the_library(spark, texts, model):  # noqa: F811
    want = set()
    for key, text in texts:
        ids = model.library.encode(text or "", add_eos=True)
        line = " ".join(map(str, ids)).encode()
        want.add((key, len(ids), sha256(line).hexdigest(), sha256(model.library.decode(ids).encode()).hexdigest()))
    assert {tuple(r) for r in queries.op11_pieces(spark, SF_SMALL).collect()} == want
