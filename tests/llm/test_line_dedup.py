import random
import re

import pytest
import xxhash

from eventlens.llm import line_dedup
from tests.llm.conftest import frame, prose, same_rows


def text_hash(t):
    h = xxhash.xxh64_intdigest((t or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def brute(rows, m=2):
    docs = sorted({(r[0] is not None, r[0] or 0, text_hash(r[1]), r[1] or "") for r in rows})
    words = {d: [i for i, x in enumerate(d[3].split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)] for d in docs}
    gone, deep = {d: set() for d in docs}, {d: 0 for d in docs}
    depth = 1
    while True:
        seen, again = set(), False
        for d in docs:
            lines, at = d[3].split("\n"), words[d]
            for p in range(len(at) - depth + 1):
                run = tuple(lines[i] for i in at[p : p + depth])
                if run in seen:
                    again = True
                    if depth >= m:
                        deep[d] = depth
                    if depth == m:
                        gone[d] |= set(range(p, p + m))
                seen.add(run)
        if not again:
            break
        depth *= 2
    out = []
    for r in rows:
        d = (r[0] is not None, r[0] or 0, text_hash(r[1]), r[1] or "")
        lines, cut = d[3].split("\n"), {words[d][p] for p in gone[d]}
        runs = sum(p - 1 not in gone[d] for p in gone[d])
        out.append((r[0], len(lines), len(cut), runs, deep[d], "\n".join(x for i, x in enumerate(lines) if i not in cut)))
    return out


def boilerplate(seed):
    rng = random.Random(seed)
    block = [prose(rng, 4) for _ in range(20)]
    rows = []
    for i in range(40):
        lines = [prose(rng, 3) for _ in range(rng.randrange(1, 6))]
        for _ in range(rng.randrange(0, 3)):
            a = rng.randrange(0, 18)
            lines += block[a : a + rng.randrange(1, 14)] + [rng.choice(["", " ", "x", "common line"])]
        rows.append((i, "\n".join(lines), "en", "a", 0))
    return rows + [(50, "\n".join(["same"] * 37), "en", "a", 0), (51, "a\nb\na\nb\na\nb", "en", "a", 0), (51, "a\nb\na\nb\na\nb", "en", "a", 0), (51, "other\nb\na", "en", "a", 0)]


@pytest.mark.parametrize("m", [1, 2, 4])
def test_shared_runs(llm, m):
    rows = boilerplate(m)
    same_rows(line_dedup.remove_runs(frame(llm, rows), m).collect(), brute(rows, m))


def test_hard_rows(hard):
    rows, df = hard
    same_rows(line_dedup.remove_runs(df).collect(), brute(rows))


def test_ranks_keep_the_order_of_suffixes(llm):
    """At every depth, ranks order the suffixes as their line ids do."""
    lines = line_dedup.line_sequence(frame(llm, boilerplate(7))).persist()
    ids = {r.pos: (r.h1, r.h2) for r in lines.collect()}
    for depth, suffixes in line_dedup.repeated_runs(lines):
        rows = suffixes.collect()
        runs = {r.pos: tuple(ids[r.pos + i] for i in range(depth)) for r in rows}
        order = {run: n for n, run in enumerate(sorted(set(runs.values())), 1)}
        assert all(order[runs[r.pos]] == r["rank"] for r in rows)
        assert all(runs[r.first] == runs[r.pos] for r in rows)


def test_nothing_and_bad_parameter(llm, nothing):
    assert line_dedup.remove_runs(nothing).collect() == []
    with pytest.raises(ValueError):
        line_dedup.remove_runs(nothing, 3)
