"""Exact de-duplication against a dictionary of normalised texts."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from eventlens.llm import exact_dedup as ed
from tests.llm.conftest import frame, same_rows


def brute(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda d: (d is None, d or 0))
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(d, ids[0], len(ids), i == 0, sha) for i, d in enumerate(ids)]
    return out


def some(extra=0):
    rng = random.Random(5)
    words = ["ab", "abc", "a b", "a  b", "a\tb", "", " ", None, "é", "aa" * 40, "aa" * 39 + "ab", "aa" * 39 + "b"]
    rows = [(rng.choice([None, i, i // 3]), rng.choice(words) if rng.random() < 0.5 else f"t{rng.randrange(40)} x", "en", "s", 1) for i in range(400 + extra)]
    return rows + [(1000 + i, "the same everywhere \n again", "en", "s", 1) for i in range(300)]


@pytest.mark.parametrize("fan,budget", [(ed.FAN, ed.BUDGET), (2, ed.BUDGET), (2, 3000), (64, 1)])
def test_brute(llm, fan, budget):
    rows = some()
    df = frame(llm, rows, extra=True).repartition(9)
    same_rows(ed.exact_groups(df, fan=fan, budget=budget).collect(), brute(rows))


def test_hard_rows(hard):
    rows, df = hard
    same_rows(ed.exact_groups(df).collect(), brute(rows))


def test_empty_table(nothing):
    assert ed.exact_groups(nothing).collect() == []


def test_normalise():
    rng = random.Random(1)
    for _ in range(500):
        t = "".join(rng.choice("ab \t\n\v\f\r\x1c  ") for _ in range(rng.randrange(40)))
        assert ed.normalise(t.encode()).decode() == re.sub(r"[\x20\x09-\x0D]+", " ", t)


def test_trie_spills_every_entry_once():
    rng = random.Random(2)
    trie, keys, out = ed.RadixTrie(), set(), []
    for _ in range(3000):
        k = bytes(rng.choice(b"ab") for _ in range(9))
        node = trie.find(k)
        if node.entry is None:
            node.entry = k
        assert node.entry == k
        keys.add(k)
    size = trie.size
    while trie.root.children:
        got = list(trie.spill())
        assert got and trie.size < size
        size, out = trie.size, out + got
    assert size == 0 and sorted(out) == sorted(keys)
