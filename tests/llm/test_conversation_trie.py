"""The prefix trie against a dictionary of turn tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventlens.llm import conversation_trie as ct
from tests.llm.conftest import CLASHING, same_rows

SCHEMA = "conv_id long, turn long, role string, text string"


def tie(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, tie(role, text), (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        seq = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].add(c)
        ends[seq].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = defaultdict(int), defaultdict(int)
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(m) - 1) * len(s[-1][1]) if s else 0
    out = []
    for s, m in members.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(s, [])))).encode()).hexdigest()
        out.append((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids.get(s, [])), leaves[s], saved[s], sha))
    return out


def some(seed=4, convs=230, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 450), convs):
        for turn in range(rng.randrange(longest)):
            rows.append((c, rng.choice([turn, turn, turn, turn // 2, None]), rng.choice(["user", "assistant", None]), rng.choice(["", None, "é", "yes", "\U0001f600 no"])))
    return rows


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in [*CLASHING, "depth", "ka", "conv", "n_children", "line"] if extra else []:
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_hard_rows(llm):
    rows = some()
    rows += [r for r in rows[:40]] + [(None, 0, "user", "lost"), (7, None, None, None)] * 2
    same_rows(ct.prefix_trie(frame(llm, rows, extra=True)).collect(), brute(rows))


@pytest.mark.parametrize("height", [1, 3, None])
def test_long_conversations_and_bands(llm, height, monkeypatch):
    """One conversation holds half of the rows and lies over several tasks."""
    rng = random.Random(9)
    long = [(200, i, "user", f"t{i}") for i in range(70)] + [(201, i, "user", f"t{i if i < 60 else -i}") for i in range(70)]
    rows = some(seed=8, convs=30) + long + [(c, i, "user", "same") for c in range(300, 360) for i in range(7)]
    rng.shuffle(rows)
    monkeypatch.setattr(ct, "HOT", 2)
    monkeypatch.setattr(ct, "PIECE", 9)
    same_rows(ct.prefix_trie(frame(llm, rows), height=height).collect(), brute(rows))


def test_empty_table(llm):
    assert ct.prefix_trie(frame(llm, [])).collect() == []
    assert ct.prefix_trie(frame(llm, [(None, 1, "user", "x")])).collect() == []
