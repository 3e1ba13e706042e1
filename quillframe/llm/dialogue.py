"""Repair of conversations whose turns were lost, emptied, repeated, cut off or mislabelled.

A conversation is to become an optional system turn and pairs of user and assistant. Turns are
kept, given another role, deleted or inserted at least cost; of the cheapest edits those whose
initials come first in ASCII order are taken.

After a stretch of turns a repair is in one of four states (nothing said, system, user, assistant),
so what lies behind a turn matters through one vector: the least cost from there to the end, by
state. A conversation of n turns is cut into blocks of about the root of n. A first pass folds each
block into a table of costs from state to state; from those the vectors at block ends are found
backward and stored: the checkpoints. A second pass makes the vectors inside each block again from
its checkpoint and walks forward through them, from each state the block can be entered in; which
of the four walks is taken follows from the blocks before. So a task holds a block, or one row for
each block of a conversation, and a conversation with a third of all turns spreads over many.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.llm.rows import running_sums
from quillframe.sources.artifacts import materialize

LEAST_BLOCK = 256  # turns of a block, more in conversations of more than its square

# What edits cost, and what is added for a cut-off turn that is not deleted.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
# States: nothing said, system, user, assistant. What a kept role leads to, by its initial.
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = (2, 2, 3, 2)  # where the only role that may be given or inserted leads
ROLES = {2: "user", 3: "assistant"}
DONE = (0, 3)  # states a conversation may end in
FAR = 1 << 50
BLANK, DUPLICATE, TRUNCATED = "b", "d", "t"
GOOD_PAIRS = ("su", "ua", "au")


def close(costs: list[int]) -> list[int]:
    """Costs to the end when turns may be inserted first."""
    for _ in range(len(NEXT)):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return costs


def ending() -> list[int]:
    return close([0 if s in DONE else FAR for s in range(len(KEEP))])


def edits(code: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of what can be done to a turn; ``code``: its role's initial and
    its fault."""
    yield "D", DELETE, state
    if code[1] in (BLANK, DUPLICATE):
        return
    more = CUT_OFF if code[1] == TRUNCATED else 0
    if code[0] in KEEP[state]:
        yield "K", more, KEEP[state][code[0]]
    yield "R", REROLE + more, NEXT[state]


def before(code: str, after: Sequence[int]) -> list[int]:
    """Costs before a turn from those after it."""
    return close([min(c + after[to] for _, c, to in edits(code, s)) for s in range(len(KEEP))])


def split_codes(codes: str) -> list[str]:
    return [codes[i : i + 2] for i in range(0, len(codes), 2)]


def fold(codes: str) -> list[int]:
    """Least cost through a block from each state to each state, row by row."""
    columns = []
    for end in range(len(KEEP)):
        costs = [0 if s == end else FAR for s in range(len(KEEP))]
        for code in reversed(split_codes(codes)):
            costs = before(code, costs)
        columns.append(costs)
    return [min(FAR, columns[end][s]) for s in range(len(KEEP)) for end in range(len(KEEP))]


def checkpoints(tables: list[list[int]]) -> list[list[int]]:
    """The costs at the end of each block, from their tables."""
    costs, out = ending(), []
    n = len(KEEP)
    for table in reversed(tables):
        out.append(costs)
        costs = [min(table[s * n + e] + costs[e] for e in range(n)) for s in range(n)]
    return out[::-1]


def walk(codes: str, after: Sequence[int], last: bool) -> list[tuple[int, str, int]]:
    """(cost, audit, state at the end) of a block entered in each state.

    ``after`` has the costs behind it. The edit of least initial is taken among those that keep to
    the least cost; behind the last block turns are inserted until the conversation may end.
    """
    turns = split_codes(codes)
    costs = [list(after)]
    for code in reversed(turns):
        costs.append(before(code, costs[-1]))
    costs.reverse()
    out = []
    for entered in range(len(KEEP)):
        at, state, audit = 0, entered, []
        while at < len(turns) or (last and costs[at][state]):
            tight = costs[at][state]
            options = [("I", INSERT, NEXT[state], at)]
            if at < len(turns):
                options += [(e, c, to, at + 1) for e, c, to in edits(turns[at], state)]
            edit, _, state, at = min(o for o in options if o[1] + costs[o[3]][o[2]] == tight)
            audit.append(edit)
        out.append((costs[0][entered], "".join(audit), state))
    return out


def damage(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) with faults put in by ``crc32(conv:turn) % 20``; nulls count as one
    space, but for the order of turns and for gaps."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat_ws(":", shown("conv"), shown("turn")).cast("binary")) % 20
    text = (
        F.when(draw == 1, F.lit(""))
        .when(draw == 2, F.regexp_replace(shown("text"), "[.!?]", ""))
        .otherwise(shown("text"))
    )
    role = F.when(draw == 4, F.lit("user")).otherwise(shown("role"))
    times = F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    hurt = rows.where(draw != 0).select(
        "conv", "turn", role.alias("role"), text.alias("text"), times.alias("_times")
    )
    return hurt.withColumn("_time", F.explode("_times")).drop("_times", "_time")


def _codes(placed: DataFrame) -> DataFrame:
    """(conv, pos, code) of each turn: its role's initial (a dash for none of s, u and a) and fault."""
    digest = F.sha2(F.col("text").cast("binary"), 256)
    rows = placed.select(
        "conv",
        "pos",
        "role",
        digest.alias("digest"),
        F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1).alias("final"),
    )
    firsts = rows.groupBy("conv", "role", "digest").agg(F.min("pos").alias("_first")).select(
        F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"),
        "_first",
    )
    same = (
        F.col("conv").eqNullSafe(F.col("_conv"))
        & (F.col("role") == F.col("_role"))
        & (F.col("digest") == F.col("_digest"))
    )
    fault = (
        F.when(F.col("final") == "", BLANK)
        .when(F.col("pos") > F.col("_first"), DUPLICATE)
        .when(~F.col("final").isin(".", "!", "?"), TRUNCATED)
        .otherwise("-")
    )
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("-"))
    joined = rows.join(firsts, same, "left")
    return joined.select("conv", "pos", F.concat(known, fault).alias("code"))


def _blocks(codes: DataFrame, least: int) -> DataFrame:
    """(conv, block, start, codes) of blocks of about the root of a conversation's turns."""
    sizes = codes.groupBy("conv").agg(F.count("*").alias("_n")).select(
        F.col("conv").alias("_conv"),
        F.greatest(F.ceil(F.sqrt("_n")), F.lit(least)).cast("long").alias("_size"),
    )
    # The turns of one conversation are the hot side, which the adaptive join splits.
    sized = codes.join(sizes, F.col("conv").eqNullSafe(F.col("_conv")))
    dealt = sized.withColumn("block", F.expr("pos div _size"))
    turns = F.sort_array(F.collect_list(F.struct("pos", "code")))
    grouped = dealt.groupBy("conv", "block").agg(turns.alias("_turns"))
    return grouped.select(
        "conv",
        "block",
        F.get("_turns", 0)["pos"].alias("start"),
        F.array_join(F.transform("_turns", lambda t: t["code"]), "").alias("codes"),
    )


def _mapped(frame: DataFrame, column: str, schema: str, f) -> DataFrame:
    """``frame`` with the columns of ``schema`` that ``f`` makes of each row's ``column``."""
    names = [part.split(" ")[0] for part in re.split(r", (?=\w+ )", schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [f(v) for v in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            columns = list(zip(*made)) or [[] for _ in names]
            kinds = [_KINDS[part.split(" ")[1]] for part in re.split(r", (?=\w+ )", schema)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, columns, kinds)], names=[*batch.schema.names, *names]
            )

    own = ", ".join(f"`{n}` {t}" for n, t in frame.dtypes)
    return frame.mapInArrow(run, f"{own}, {schema}")


_KINDS = {
    "int": pa.int32(),
    "string": pa.string(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def _solved(blocks: DataFrame) -> DataFrame:
    """(conv, block, start, codes, cost, audit): the edits of each block, and the whole cost."""
    folded = _mapped(blocks, "codes", "costs array<long>", lambda codes: (fold(codes),))
    folded = materialize(folded, "folded")
    listed = F.sort_array(F.collect_list(F.struct("block", "costs")))
    by_conv = folded.groupBy("conv").agg(listed.alias("_blocks"))
    by_conv = by_conv.withColumn("tables", F.transform("_blocks", lambda b: b["costs"])).drop("_blocks")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [checkpoints(t) for t in batch.column(1).to_pylist()]
            row = [i for i, blocks in enumerate(found) for _ in blocks]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array([b for blocks in found for b in range(len(blocks))], pa.int64()),
                    pa.array([costs for blocks in found for costs in blocks], pa.list_(pa.int64())),
                    pa.array([b + 1 == len(x) for x in found for b in range(len(x))], pa.bool_()),
                ],
                names=["_conv", "_block", "after", "last"],
            )

    kind = blocks.schema["conv"].dataType.simpleString()
    behind = by_conv.select("conv", "tables").mapInArrow(
        ends, f"_conv {kind}, _block long, after array<long>, last boolean"
    )
    here = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    joined = folded.drop("costs").join(behind, here).withColumn("_in", F.struct("codes", "after", "last"))
    walked = _mapped(
        joined.select("conv", "block", "start", "_in"),
        "_in",
        "costs array<long>, audits array<string>, exits array<int>",
        lambda x: tuple(zip(*walk(x["codes"], x["after"], x["last"]))),
    )
    walked = materialize(
        walked.select("conv", "block", "start", F.col("_in")["codes"].alias("codes"), "costs", "audits", "exits"),
        "walked",
    )
    # Which state each block is entered in: the walks of the blocks before lead there.
    turns = F.sort_array(F.collect_list(F.struct("block", "exits")))
    lists = walked.groupBy("conv").agg(turns.alias("_walks"))

    def entries(exits: list[list[int]]) -> tuple[list[int]]:
        state, out = 0, []
        for to in exits:
            out.append(state)
            state = to[state]
        return (out,)

    lists = lists.select("conv", F.transform("_walks", lambda w: w["exits"]).alias("all_exits"))
    entered = _mapped(lists, "all_exits", "entries array<int>", entries).select(
        F.col("conv").alias("_conv"), F.posexplode("entries").alias("_block", "_state")
    )
    here = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    return walked.join(entered, here).select(
        "conv",
        "block",
        "start",
        "codes",
        F.get("costs", F.col("_state")).alias("cost"),
        F.get("audits", F.col("_state")).alias("audit"),
        F.col("_state").alias("entered"),
    )


def _repaired(placed: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): turns stream through their conversation's task in order, each block's
    edits ahead of them; nothing but the digest's state is held."""
    turns = placed.select(
        "conv", "pos", F.lit(1).alias("kind"), "role", "text", F.lit(None).cast("int").alias("entered")
    )
    plans = solved.select(
        "conv",
        F.col("start").alias("pos"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("role"),
        F.col("audit").alias("text"),
        "entered",
    )
    together = turns.unionByName(plans).repartition("conv").sortWithinPartitions("conv", "pos", "kind")
    kind = placed.schema["conv"].dataType.simpleString()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, digest, said = None, None, False
        state, plan = 0, iter("")
        held = ""  # an edit read ahead

        def say(line: str) -> None:
            nonlocal said
            digest.update(("\n" if said else "").encode() + line.encode())
            said = True

        def insert() -> str:
            """Say the insertions that come next; the edit behind them."""
            nonlocal state
            for edit in plan:
                if edit != "I":
                    return edit
                state = NEXT[state]
                say(f"{ROLES[state]}:")
            return ""

        for batch in batches:
            done, digests = [], []
            for at, (pos, of, role, text, entered) in enumerate(
                zip(*(batch.column(i).to_pylist() for i in range(1, 6)))
            ):
                conv = batch.column(0)[at]
                if open_ is None or conv.as_py() != open_[0]:
                    if open_ is not None:
                        done.append(open_[0])
                        digests.append(digest.hexdigest())
                    open_, digest, said = (conv.as_py(),), sha256(), False
                if of == 0:
                    state, plan = entered, iter(text)
                    held = insert()
                    continue
                if held != "D":
                    state = KEEP[state][role[0]] if held == "K" else NEXT[state]
                    say(f"{role if held == 'K' else ROLES[state]}:{text}")
                held = insert()
            yield _digests(done, digests, batch.column(0).type)
        if open_ is not None:
            yield _digests([open_[0]], [digest.hexdigest()], batch.column(0).type)

    def _digests(convs: list, digests: list[str], of: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(convs, of), pa.array(digests, pa.string())], names=["_conv", "repaired_sha256"]
        )

    return together.mapInArrow(digested, f"_conv {kind}, repaired_sha256 string")


def repair(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    hurt: bool = False,
    least: int = LEAST_BLOCK,
) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each
    conversation of ``rows``.

    ``hurt`` puts faults in first (``damage``). Turns are taken by number, nulls first, then by role
    and text, so that repeats of a turn stand together. A null role or text counts as one space, a
    null conversation is one of its own. Each turn's first fault counts: blank, duplicate of an
    earlier turn's role and text, truncated. ``gaps`` are the numbers missing between the least and
    the largest, ``illegal`` the neighbours whose roles' initials may not follow each other.
    ``audit`` has the initials of the cheapest edits, of least ASCII order; the digest is of the
    repaired turns, ``role:text``, with newlines between. A conversation all of whose turns are lost
    has zeros, an empty audit and the digest of nothing; an empty table gives an empty result. Very
    long texts are digested where they stand; the digest of a conversation is made in one task, as
    it is a chain, which holds none of its turns.
    """
    plain = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    shown = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    turns = damage(plain) if hurt else plain.select("conv", "turn", shown("role"), shown("text"))
    placed = running_sums(
        turns.withColumn("one", F.lit(1).cast("long")), ["turn", "role", "text"], "one", by="conv"
    ).withColumnRenamed("before", "pos")
    placed = materialize(placed.drop("one"), "placed")
    solved = materialize(_solved(_blocks(_codes(placed), least)), "solved")
    counts = _counted(solved)
    gaps = placed.groupBy("conv").agg(
        F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)
        ).cast("long").alias("gaps")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    named = lambda df: df.select(F.col("conv").alias("_conv"), *[c for c in df.columns if c != "conv"])
    same = lambda: F.col("conv").eqNullSafe(F.col("_conv"))
    out = plain.select("conv").distinct()
    for part in (named(gaps), named(counts), _repaired(placed, solved)):
        out = out.join(part, same(), "left").drop("_conv")
    return out.select(
        "conv",
        *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def _counted(solved: DataFrame) -> DataFrame:
    """(conv, blank, duplicate, truncated, illegal, cost, audit), put together from the blocks."""

    def seen(codes: str) -> tuple[int, int, int, int, str]:
        initials, faults = codes[::2], codes[1::2]
        bad = sum(a + b not in GOOD_PAIRS for a, b in zip(initials, initials[1:]))
        counts = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        return (*counts, bad, initials[0] + initials[-1])

    schema = "blank int, duplicate int, truncated int, bad int, ends string"
    blocks = _mapped(solved.select("conv", "block", "cost", "audit", "codes"), "codes", schema, seen)
    one = F.struct("block", "cost", "audit", "ends")
    grouped = blocks.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "bad")],
        F.sort_array(F.collect_list(one)).alias("_blocks"),
    )
    edges = F.transform(
        F.sequence(F.lit(1), F.size("_blocks") - 1),
        lambda i: F.concat(
            F.substring(F.get("_blocks", i - 1)["ends"], 2, 1), F.substring(F.get("_blocks", i)["ends"], 1, 1)
        ),
    )
    crossing = F.when(F.size("_blocks") > 1, F.size(F.filter(edges, lambda e: ~e.isin(*GOOD_PAIRS))))
    return grouped.select(
        "conv",
        "blank",
        "duplicate",
        "truncated",
        (F.col("bad") + F.coalesce(crossing, F.lit(0))).alias("illegal"),
        F.get("_blocks", 0)["cost"].alias("cost"),
        F.array_join(F.transform("_blocks", lambda b: b["audit"]), "").alias("audit"),
    )

