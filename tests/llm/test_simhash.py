import random
import re

import numpy as np
import pytest
import xxhash

from eventlens.llm import simhash
from eventlens.llm.components import connected_components
from tests.llm.conftest import frame, prose, same_rows


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(rows, radius=3):
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    of = closure([(a, b) for a in set(fps) for b in set(fps) if a < b and (a ^ b).bit_count() <= radius], set(fps))
    least = {}
    for (doc_id, *_), f in zip(rows, fps):
        if doc_id is not None:
            least[of[f]] = min(doc_id, least.get(of[f], doc_id))
    return [(r[0], f - (1 << 64) if f >> 63 else f, least.get(of[f])) for r, f in zip(rows, fps)]


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair(radius):
    masks = simhash.covering_masks(list(range(64)), radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    for _ in range(3000):
        bits = rng.sample(range(64), radius)
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


def test_against_brute_force(hard):
    rows, df = hard
    same_rows(simhash.components(df).collect(), brute(rows))


@pytest.mark.parametrize("piece", [8, 64])
def test_long_texts_in_pieces(monkeypatch, piece):
    text = prose(random.Random(1), 500) + "  \n tail"
    monkeypatch.setattr(simhash, "PIECE", piece)
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_large_buckets_are_split_without_loss(llm, monkeypatch):
    """Chains of close fingerprints and one dense group."""
    rng = random.Random(5)
    fps = set()
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(40):
            fps.add(x)
            for b in rng.sample(range(64), rng.choice([1, 3, 3, 5])):
                x ^= 1 << b
    core = rng.getrandbits(64)
    fps |= {core ^ sum(1 << b for b in rng.sample(range(12), rng.randrange(1, 7))) for _ in range(300)}
    fps = sorted(fps)
    nodes = llm.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    monkeypatch.setattr(simhash, "BUCKET", 8)
    found = [(r.u % (1 << 64), r.v % (1 << 64)) for r in simhash.links(nodes).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    expected = closure([(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 3], fps)
    assert closure(found, fps) == expected


def test_components_of_long_chains_and_hubs(llm):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (2000, 2001), (2001, 2002)]
    got = {r.node: r.root for r in connected_components(llm.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)} | {2001: 2000, 2002: 2000}
    assert connected_components(llm.createDataFrame([], "u long, v long")).collect() == []


def test_one_document_of_each_group_stays(llm, hard):
    rows, df = hard
    kept = simhash.dedup(df).collect()
    named = [r for r in brute(rows)]
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for _, _, c in named if c is not None})
    assert kept[0].__fields__ == df.columns
    bare = simhash.dedup(frame(llm, [(None, "a b c d", None, None, 1), (None, "q r s t", None, None, 1), (7, "q r s t", None, None, 1)])).collect()
    assert sorted((r.doc_id is None, r.text) for r in bare) == [(False, "q r s t"), (True, "a b c d")]


def test_exactly_one_row_of_each_component_stays(llm):
    """Rows that share an id lie in different components; copies have no id."""
    rng = random.Random(6)
    a, b, c, d = (prose(rng, 40) for _ in range(4))
    rows = [(1, a), (1, b), (2, b), (3, a), *[(None, c)] * 50, (None, b), (4, d), (4, d), (None, d), (None, None), (None, "")]
    kept = simhash.dedup(frame(llm, [(*r, "en", "a", 0) for r in rows])).collect()
    same_rows([(r.doc_id, r.text or "") for r in kept], [(1, a), (1, b), (None, c), (4, d), (None, "")])


def test_nothing(nothing):
    assert simhash.components(nothing).collect() == [] and simhash.dedup(nothing).collect() == []
