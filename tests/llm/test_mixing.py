import hashlib
import math
import re
from collections import Counter, defaultdict

from eventlens.llm import mixing
from tests.llm.conftest import frame, same_rows


def targets(sizes):
    """Water filling by the book: cap, share the excess again, repeat."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        shares = {s: weight[s] * left / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if shares[s] > 2 * sizes[s]}
        if not over:
            return capped | shares
        capped |= {s: 2.0 * sizes[s] for s in over}


def brute(rows):
    n = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    sizes = defaultdict(int)
    for r, k in zip(rows, n):
        sizes[r[3]] += k
    t = targets(sizes)
    u = lambda key: int(hashlib.md5(f"17:{key}".encode()).hexdigest()[:8], 16) / 2**32
    places, count = {}, Counter()
    for i in sorted(range(len(rows)), key=lambda i: (n[i], hashlib.md5(f"17:{'' if rows[i][0] is None else rows[i][0]}:{rows[i][1] or ''}".encode()).hexdigest())):
        places[i] = count[rows[i][3]]
        count[rows[i][3]] += 1
    out = []
    for i, (r, k) in enumerate(zip(rows, n)):
        rate = t[r[3]] / sizes[r[3]] if sizes[r[3]] else 0.0
        part, at = rate - math.floor(rate), u(r[3] or "")
        extra = math.floor(part * (places[i] + 1) + at) - math.floor(part * places[i] + at)
        out.append((r[0], r[3], k, sizes[r[3]], round(t[r[3]], 6), math.floor(rate) + extra))
    return out


def test_plan_and_mix(hard):
    rows, df = hard
    plan = [(r.doc_id, r.source, r["size"], r.source_size, round(r.target, 6), r.copies) for r in mixing.mix_plan(df).collect()]
    same_rows(plan, brute(rows))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    expected = Counter()
    for r, b in zip(rows, brute(rows)):
        expected[(r[0], r[1])] += b[-1]
    assert Counter((r.doc_id, r.text) for r in mixed.collect()) == +expected


def test_many_sources_hit_their_caps(llm):
    rows = [(i, "w " * (1 + (i * 37) % 91), "en", f"s{i % 40:02d}" if i % 41 else None, 0) for i in range(400)] + [(999, " ", "en", "empty", 0)]
    plan = mixing.mix_plan(frame(llm, rows))
    same_rows([(r.doc_id, r.source, r["size"], r.source_size, round(r.target, 6), r.copies) for r in plan.collect()], brute(rows))


def near(plan):
    """No source is further from its target than its largest document."""
    taken, most, target = Counter(), Counter(), {}
    for _, source, k, _, t, copies in plan:
        taken[source] += k * copies
        most[source] = max(most[source], k)
        target[source] = t
    return all(abs(taken[s] - target[s]) <= most[s] for s in target)


def test_sources_come_near_their_targets(llm):
    import random

    rng = random.Random(3)
    rows = [(i if i % 3 else None, "w " * int(rng.paretovariate(0.7)) + f"d{i}", "en", rng.choice(["a", "b", "b", "c"]) if i > 9 else f"few{i % 4}", 0) for i in range(900)]
    rows += [(None, "the same " * 9, "en", "b", 0)] * 300  # rows without id, all alike
    assert near(brute(rows))
    plan = mixing.mix_plan(frame(llm, rows))
    got = [(r.doc_id, r.source, r["size"], r.source_size, round(r.target, 6), r.copies) for r in plan.collect()]
    same_rows(got, brute(rows))
    expected = Counter()
    for r, b in zip(rows, brute(rows)):
        expected[(r[0], r[1])] += b[-1]
    assert Counter((r.doc_id, r.text) for r in mixing.mix(frame(llm, rows)).collect()) == +expected


def test_given_sources_come_near_their_targets(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert near([(r.doc_id, r.source, r["size"], r.source_size, r.target, r.copies) for r in mixing.mix_plan(docs).collect()])


def test_rows_that_share_id_and_text_share_their_copies(llm):
    rows = [(1, "one two three", lang, "a", n) for lang in "xyz" for n in range(40)] + [(i, f"other words {i}", "en", "b", 0) for i in range(2, 60)]
    plan = {r.doc_id: r for r in mixing.mix_plan(frame(llm, rows)).groupBy("doc_id").sum("copies").collect()}
    got = Counter((r.doc_id, r.lang, r.n_chars) for r in mixing.mix(frame(llm, rows)).collect())
    assert abs(sum(v for k, v in got.items() if k[0] == 1) - plan[1]["sum(copies)"]) <= 12 and max(got.values()) <= 2


def test_nothing(nothing):
    assert mixing.mix_plan(nothing).collect() == [] and mixing.mix(nothing).collect() == []
