"""Repair against a plain recursion over whole audits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from eventlens.llm import conversation_repair as cr
from tests.llm.conftest import CLASHING, same_rows

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def damaged(rows):
    convs = {}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        out = convs.setdefault(c, [])
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        role = "user" if f == 4 else role
        out += [(turn is not None, turn or 0, digest(role, text), role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    return {c: sorted(v) for c, v in convs.items()}


def cheapest(rows):
    """(cost, audit, lines) by trying every edit of every row."""

    # more than three inserts at one gap repeat a state, so they never pay
    @lru_cache(None)
    def full(i, q, left):
        ways = [go_insert(i, q, left)] if left else []
        if i == len(rows):
            if q in "0a":
                ways.append((0, "", ()))
        else:
            role, text, gone, cut = rows[i]
            rest = full(i + 1, q, 3)
            if rest:
                ways.append((rest[0] + 4, "D" + rest[1], rest[2]))
            for cost, edit, name in [(0, "K", role), (3, "R", "user"), (3, "R", "assistant")] if not gone else []:
                if name and name[0] in {"0": "su", "s": "u", "u": "a", "a": "u"}[q] and (rest := full(i + 1, name[0], 3)):
                    ways.append((cost + 3 * cut + rest[0], edit + rest[1], (f"{name}:{text}", *rest[2])))
        return min([w for w in ways if w], default=None)

    def go_insert(i, q, left):
        name = "assistant" if q == "u" else "user"
        rest = full(i, name[0], left - 1)
        return rest and (rest[0] + 3, "I" + rest[1], (f"{name}:", *rest[2]))

    return full(0, "0", 3)


def brute(rows):
    out = []
    for c, held in damaged(rows).items():
        seen, given, blank, dup, cut, illegal = set(), [], 0, 0, 0, 0
        for *_, d, role, text in held:
            last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
            b, t = not last, False
            r = not b and d in seen
            seen.add(d)
            t = not b and not r and last not in ".!?"
            blank, dup, cut = blank + b, dup + r, cut + t
            if given:
                illegal += given[-1][0][:1] + role[:1] not in ("su", "ua", "au")
            given.append((role, text, b or r, t))
        turns = {x[1] for x in held if x[0]}
        cost, audit, lines = cheapest(tuple(given))
        assert GRAMMAR.fullmatch("".join(x[0] for x in lines))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((c, gaps, blank, dup, cut, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def some(seed=6, convs=260, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-100, 900), convs):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("system", "user", "assistant")[0 if turn == 0 and c % 3 == 0 else 1 + turn % 2]
            role = rng.choice([role] * 12 + [None, "", "tool", "User", "u"])
            text = rng.choice(["a.", "b!", "c? \n", "é.", "no end", " \t", "", None, "x.y", "w.\x1c", f"t{turn}.", f"t{turn}."])
            rows.append((c, rng.choice([turn, turn, turn, 3 * turn, turn // 2, None]), role, text))
    return rows


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in [*CLASHING, "digest", "fault", "large", "n", "chars", "block", "state", "audit"] if extra else []:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.mark.parametrize("long,piece", [(cr.LONG, cr.PIECE), (2, 3), (0, 1), (4, 100)])
def test_hard_rows(llm, long, piece):
    rows = some() + some(seed=7, convs=3, longest=60) + [(None, i % 7, "user", "hm.") for i in range(12)]
    same_rows(cr.repair(frame(llm, rows, extra=True), long=long, piece=piece).collect(), brute(rows))


def test_dropped_conversations_stay(llm):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:5]
    empty = hashlib.sha256().hexdigest()
    got = cr.repair(frame(llm, [(c, 0, "user", "x") for c in gone])).collect()
    same_rows(got, [(c, 0, 0, 0, 0, 0, 0, "", empty) for c in gone])


def test_empty_table(llm):
    assert cr.repair(frame(llm, [])).collect() == []


def test_no_item_is_popped_before_a_cheaper_one():
    rng = random.Random(3)
    for _ in range(300):
        rows = [(rng.choice("suat"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(12))]
        order = [(cost, len(rows) - item[0]) for item, (cost, _, _) in cr.derive(rows, cr.ACCEPTING, None).items()]
        assert order == sorted(order)
