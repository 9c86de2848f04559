"""Conversation structure repair by Knuth's lightest derivation.

*Deductions.*  The item (i, q) says that the rows from i on can be edited so
that the roles, read from grammar state q, end in an accepting state.  A rule
derives it from a finished item and an edit of row i, or of the gap before it:

    edit(i, Delete), (i + 1, q)                 |-  (i, q)     4
    edit(i, Keep of initial x), (i + 1, q.x)    |-  (i, q)     0, truncated 3
    edit(i, Rerole to x), (i + 1, q.x)          |-  (i, q)     3, truncated 6
    gap(i, Insert x), (i, q.x)                  |-  (i, q)     3

A rule's weight is (cost, audit) -> (cost + its own, its initial before the
audit).  It keeps order, and with the number of rows covered between cost and
audit no result is below its premise, so the weight is superior: items are
popped from an agenda by (cost, rows covered), each is final when popped, and
the search ends when the goal (0, start) is.  From one item every edit initial
leads to one premise, so equal costs are told apart by the initial alone.
Audits are links from item to item and are spelt out once, from the goal.

*Long conversations* (over ``LONG`` rows or ``CHARS`` characters) are cut into
pieces of at most ``PIECE`` rows by their place in the order of all such rows.
Tasks derive for every piece its least cost between any two states; these small
tables are added up from the last piece to the first; then every piece is
derived again with what follows as the weight of its last items, which fixes
its edits for each state it may be entered in, and a last pass over the pieces
finds that state.  Only the final hash reads a conversation in one task, as a
stream, and the audit of a conversation is one value of the result.

Defined cases: null role or text is one space, a null turn comes first and is a
space in the key that chooses damage, and null conv_ids form one conversation;
ties in turn are ordered by the SHA-256 of role and text after damage; a role
without an initial fits nowhere; repeated rows are rows; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain, groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_rank, written

LONG, CHARS, PIECE = 10_000, 32 << 20, 4_096
MAX_BROADCAST = 200_000
_CHUNK = 4 << 20
_BLANKS = " \t\n\v\f\r"
#: Costs of the edits, and what an undeleted truncated row adds.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: Grammar of role initials (s?(ua)+)?: state -> initial -> state.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ACCEPTING = {START: 0, ASSISTANT: 0}
LEGAL = frozenset(("su", "ua", "au"))
#: state -> the (state before, initial) that lead to it
_INTO = {q: [(p, x) for p, m in MOVES.items() for x, to in m.items() if to == q] for q in MOVES}


def derive(rows: list[tuple[str, bool, bool]], ends: dict[int, int], goal: tuple[int, int] | None = (0, START)) -> dict:
    """Lightest derivations of items over rows (initial, must go, truncated):
    item -> (cost, edit, premise).  ``ends`` are the costs of the items after
    the last row; without a ``goal`` all items are derived."""
    n = len(rows)
    best, done, agenda = {}, {}, []

    def deduce(item, cost, edit, premise):
        old = best.get(item)
        if old is None or (cost, edit) < old[:2]:
            best[item] = (cost, edit, premise)
            if old is None or cost < old[0]:
                heappush(agenda, (cost, n - item[0], item[1]))

    for q, cost in ends.items():
        deduce((n, q), cost, "", None)
    while agenda:
        cost, covered, q = heappop(agenda)
        item = i, _ = (n - covered, q)
        if item in done or best[item][0] < cost:
            continue
        done[item] = best[item]
        if item == goal:
            break
        for p, x in _INTO[q]:
            if x != "s":
                deduce((i, p), cost + INSERT, "I", item)
        if i:
            initial, gone, cut = rows[i - 1]
            deduce((i - 1, q), cost + DELETE, "D", item)
            if not gone:
                extra = TRUNCATED if cut else 0
                for p, x in _INTO[q]:
                    if x == initial:
                        deduce((i - 1, p), cost + extra, "K", item)
                    if x != "s":
                        deduce((i - 1, p), cost + extra + REROLE, "R", item)
    return done


def spell(derived: dict, item: tuple[int, int]) -> tuple[str, int]:
    """Audit of an item, and the state in which its derivation ends."""
    out = []
    while True:
        _, edit, premise = derived[item]
        if premise is None:
            return "".join(out), item[1]
        out.append(edit)
        item = premise


def replay(rows: Iterator[tuple[str, str]], audit: str, state: int) -> Iterator[str]:
    """The repaired ``role:text`` of rows (role, text) by their audit."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == USER else "user"
        state = MOVES[state][role[0]]
        yield f"{role}:{text}"


def _faults(rows: list[tuple]) -> tuple[list[tuple[str, bool, bool]], list[int]]:
    """Rows as ``derive`` takes them, and [gaps, blank, duplicate, truncated,
    illegal], of rows (turn, role, text, digest)."""
    out, seen, turns = [], set(), set()
    gaps = blank = duplicate = truncated = illegal = 0
    for turn, role, text, digest in rows:
        last = text.rstrip(_BLANKS)[-1:]
        again = digest in seen
        seen.add(digest)
        if turn is not None:
            turns.add(turn)
        cut = bool(last) and not again and last not in ".!?"
        blank, duplicate, truncated = blank + (not last), duplicate + (bool(last) and again), truncated + cut
        if out:
            illegal += out[-1][0] + role[:1] not in LEGAL
        out.append((role[:1], not last or again, cut))
    if turns:
        gaps = max(turns) - min(turns) + 1 - len(turns)
    return out, [gaps, blank, duplicate, truncated, illegal]


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest, copies): every row once, damaged by
    the remainder of its key's crc32; dropped rows have no copies."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), one).alias("role"), F.coalesce(F.col("text").cast("string"), one).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fault"),
    )
    fault = F.col("fault")
    rows = rows.withColumns({
        "text": F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(fault == 4, F.lit("user")).otherwise(F.col("role")),
        "copies": F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1),
    })
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    return rows.select("conv_id", "turn", "role", "text", digest.alias("digest"), "copies")


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ARROW = pa.schema([(x, pa.int64()) for x in "conv_id gaps blank duplicate truncated illegal cost".split()] + [("audit", pa.string()), ("repaired_sha256", pa.string())])


def _groups(batches, width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows with equal first ``width`` columns, rows one by one."""
    rows = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
    return groupby(rows, key=lambda row: row[:width])


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _whole(rows: DataFrame) -> DataFrame:
    """Conversations of bounded size, each derived as it streams by."""

    def one(key, held):
        held = [r[1:5] for r in held for _ in range(r[5])]
        given, counts = _faults(held)
        derived = derive(given, ACCEPTING)
        audit = spell(derived, (0, START))[0]
        text = "\n".join(replay(((r[1], r[2]) for r in held), audit, START))
        return (*key, *counts, derived[0, START][0], audit, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())

    def run(batches):
        yield from _batched((one(k, h) for k, h in _groups(batches, 1)), _ARROW)

    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "turn", "role", "text", "digest", "copies").mapInArrow(run, _RESULT)


_NO_WAY = -1
_TABLE = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("costs", pa.list_(pa.int64())), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64())])
_EDITS = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("exits", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
_CHUNKS = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("seq", pa.int64()), ("lines", pa.binary())])


def _tables(batches) -> Iterator[pa.RecordBatch]:
    def one(key, rows):
        block, conv = key
        rows, costs = [r[3:6] for r in rows], []
        for end in MOVES:
            derived = derive(rows, {end: 0}, None)
            costs += [derived[0, q][0] if (0, q) in derived else _NO_WAY for q in MOVES]
        initials = [r[0] for r in rows]
        return conv, block, costs, initials[0], initials[-1], sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))

    yield from _batched((one(k, r) for k, r in _groups(batches, 2)), _TABLE)


def _backward(pieces: pd.DataFrame) -> pd.DataFrame:
    """What the items after every piece cost, from the last piece to the first."""
    pieces = pieces.sort_values("block", ascending=False)
    after, out, later = [ACCEPTING.get(q, _NO_WAY) for q in MOVES], [], None
    for conv, block, costs, first, last, illegal in pieces.itertuples(index=False):
        after = _with_inserts(after)
        boundary = int(later is not None and last + later not in LEGAL)
        before = []
        for q in MOVES:
            ways = [costs[e * len(MOVES) + q] + after[e] for e in MOVES if costs[e * len(MOVES) + q] >= 0 and after[e] >= 0]
            before.append(min(ways, default=_NO_WAY))
        out.append((conv, block, after, illegal + boundary))
        after, later = before, first
    total = _with_inserts(after)[START]
    return pd.DataFrame([(*x, total) for x in out], columns=["conv_id", "block", "ends", "illegal", "cost"])


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs of items at one gap, inserts there included."""
    derived = derive([], {q: c for q, c in enumerate(costs) if c >= 0}, None)
    return [derived[0, q][0] if (0, q) in derived else _NO_WAY for q in MOVES]


def _edits(batches) -> Iterator[pa.RecordBatch]:
    """Per piece the edits and the state it ends in, for each state before."""

    def one(key, rows):
        block, conv = key
        rows = list(rows)
        derived = derive([r[3:6] for r in rows], {q: c for q, c in enumerate(rows[0][6]) if c >= 0}, None)
        ways = [spell(derived, (0, q)) if (0, q) in derived else ("", _NO_WAY) for q in MOVES]
        return conv, block, [w[1] for w in ways], [w[0] for w in ways]

    yield from _batched((one(k, r) for k, r in _groups(batches, 2)), _EDITS, 16)


def _forward(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state in which every piece is entered."""
    state, out = START, []
    for conv, block, exits in pieces.sort_values("block")[["conv_id", "block", "exits"]].itertuples(index=False):
        out.append((conv, block, state))
        state = int(exits[state])
    return pd.DataFrame(out, columns=["conv_id", "block", "state"])


def _pieces(rows: DataFrame, piece: int) -> DataFrame:
    """Conversations of any size, derived by pieces of bounded size."""
    held = rows.where("copies > 0").select("conv_id", "turn", "role", "text", "digest", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    tied = held.withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    ranked = global_rank(tied, order, "rank", "repair-order").withColumn("block", F.floor(F.col("rank") / piece))
    last = F.substring(F.rtrim("text", F.lit(_BLANKS)), -1, 1)
    flagged = written(ranked.select("conv_id", "block", "rank", "turn", "digest", F.substring("role", 1, 1).alias("initial"), last.alias("last")), "repair-rows")
    firsts = flagged.groupBy("conv_id", "digest").agg(F.min("rank").alias("rank")).select("rank", F.lit(True).alias("new"))
    blank, again = F.col("last") == "", F.col("new").isNull()
    cut = ~blank & ~again & ~F.col("last").isin(".", "!", "?")
    judged = flagged.join(firsts, "rank", "left").withColumns({"blank": blank, "duplicate": ~blank & again, "truncated": cut})
    judged = written(judged.select("conv_id", "block", "rank", "turn", "initial", "blank", "duplicate", "truncated"), "repair-faults")
    gone = (F.col("blank") | F.col("duplicate")).alias("gone")
    cells = ["block", "conv_id", "rank", "initial", gone, "truncated"]
    in_order = ["block", "conv_id", "rank"]
    dealt = judged.repartition("block", "conv_id").sortWithinPartitions(*in_order).select(*cells)
    tables = dealt.mapInArrow(_tables, "conv_id long, block long, costs array<long>, first string, last string, illegal long")
    ends = written(tables.groupBy("conv_id").applyInPandas(_backward, "conv_id long, block long, ends array<long>, illegal long, cost long"), "repair-costs")

    def same(a, b):
        return (a["block"] == b["block"]) & a["conv_id"].eqNullSafe(b["conv_id"])

    weighted = judged.join(ends, same(judged, ends)).select(judged["block"], judged["conv_id"], "rank", "initial", gone, "truncated", "ends")
    weighted = weighted.repartition("block", "conv_id").sortWithinPartitions(*in_order)
    edits = written(weighted.mapInArrow(_edits, "conv_id long, block long, exits array<long>, audits array<string>"), "repair-edits")
    states = edits.select("conv_id", "block", "exits").groupBy("conv_id").applyInPandas(_forward, "conv_id long, block long, state long")
    chosen = edits.join(states, same(edits, states)).select(edits["conv_id"], edits["block"], "state", F.get("audits", F.col("state")).alias("audit"), F.get("exits", F.col("state")).alias("exit"))
    chosen = written(chosen, "repair-chosen")

    # inserts after the last row, from the state that the last piece ends in
    final = chosen.groupBy("conv_id").agg(F.max_by("exit", "block").alias("exit"))
    tail = F.element_at(F.array(*[F.lit(spell(derive([], ACCEPTING, (0, q)), (0, q))[0]) for q in MOVES]), (F.col("exit") + 1).cast("int"))
    final = final.select("conv_id", "exit", tail.alias("tail"))

    def lines(batches):
        def parts(key, rows):
            block, conv = key
            out, size, seq = [], 0, 0
            one = next(rows)
            for line in replay((r[3:5] for r in chain((one,), rows)), one[6], one[5]):
                out.append(line.encode("utf-8", "surrogatepass"))
                size += len(out[-1])
                if size > _CHUNK:
                    yield conv, block, seq, b"\n".join(out)
                    out, size, seq = [], 0, seq + 1
            if out:
                yield conv, block, seq, b"\n".join(out)

        yield from _batched((x for k, r in _groups(batches, 2) for x in parts(k, r)), _CHUNKS, 2)

    texts = ranked.join(chosen, same(ranked, chosen)).select(ranked["block"], ranked["conv_id"], "rank", "role", "text", "state", "audit")
    texts = texts.repartition("block", "conv_id").sortWithinPartitions(*in_order)
    chunks = texts.mapInArrow(lines, "conv_id long, block long, seq long, lines binary")
    added = final.where("tail != ''").select("conv_id", F.lit((1 << 62)).alias("block"), F.lit(0).cast("long").alias("seq"), _inserted().alias("lines"))

    def digest(batches):
        def one():
            conv, h = None, None
            for b in batches:
                for c, part in zip(b.column(0).to_pylist(), b.column(1)):
                    if h is None or c != conv:
                        if h:
                            yield conv, h.hexdigest()
                        conv, h = c, hashlib.sha256(part.as_py())
                    else:
                        h.update(b"\n" + part.as_py())
            if h:
                yield conv, h.hexdigest()

        yield from _batched(one(), pa.schema([("conv_id", pa.int64()), ("sha", pa.string())]))

    stream = chunks.unionByName(added).repartition("conv_id").sortWithinPartitions("conv_id", "block", "seq")
    hashes = stream.select("conv_id", "lines").mapInArrow(digest, "conv_id long, sha string")
    count = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = judged.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), count("blank"), count("duplicate"), count("truncated"))
    costs = ends.groupBy("conv_id").agg(count("illegal"), F.max("cost").alias("cost"))
    audits = chosen.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    # one small row per conversation on every side; null ids count as equal
    out = counts
    for side in (costs, audits, final.select("conv_id", "tail"), hashes):
        side = side.withColumnRenamed("conv_id", "other")
        out = out.join(side, F.col("conv_id").eqNullSafe(F.col("other")), "left").drop("other")
    return out.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.concat("audit", "tail").alias("audit"), F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    )


def _inserted():
    """The lines that the inserts in ``tail`` add after the state ``exit``."""
    lines = ["\n".join(replay(iter(()), spell(derive([], ACCEPTING, (0, q)), (0, q))[0], q)).encode() for q in MOVES]
    return F.element_at(F.array(*[F.lit(x) for x in lines]), (F.col("exit") + 1).cast("int"))


def repair(conversations: DataFrame, long: int = LONG, chars: int = CHARS, piece: int = PIECE) -> DataFrame:
    """Faults, least cost, edits and hash of every damaged conversation."""
    rows = damage(conversations)
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.length("text")).alias("chars"))
    large = written(sizes.where((F.col("n") > long) | (F.col("chars") > chars)).select(F.col("conv_id").alias("large")), "repair-large")
    n_large = large.count()
    if not n_large:
        return _whole(rows)
    large = F.broadcast(large) if n_large <= MAX_BROADCAST else large
    here = F.col("conv_id").eqNullSafe(F.col("large"))
    return _whole(rows.join(large, here, "left_anti")).unionByName(_pieces(rows.join(large, here, "left_semi"), piece))
