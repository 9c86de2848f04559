import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from eventlens.llm import suffix_dedup as s
from tests.llm.conftest import frame, hard_rows, prose, same_rows


def brute(rows, length=200):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[: len(t)]])
        spans = int(np.sum(gone[:-1] & ~np.concatenate(([False], gone[:-2])))) if len(t) else 0
        out.append((r[0], len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed, n_docs=40, length=200):
    """Documents that share passages a little shorter and longer than the
    limit, at odd places, with common and differing surroundings."""
    rng = random.Random(seed)
    shared = [prose(rng, 60)[: length + d] for d in (-2, -1, 0, 1, 2, 40, 150)]
    docs = []
    for i in range(n_docs):
        parts = [prose(rng, rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(shared)
            cut = rng.choice([0, 0, 1, 17])
            parts += [p[cut:], rng.choice(["", "!", "same bridge of words ", prose(rng, 5)])]
        docs.append((i, "".join(parts) + prose(rng, rng.randrange(0, 9)), "en", "a", 0))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(llm, seed):
    rows = passages(seed)
    same_rows(s.remove_repeats(frame(llm, rows), keep_text=False).drop("kept").collect(), brute(rows))


def test_hard_rows(hard):
    rows, df = hard
    same_rows(s.remove_repeats(df).drop("kept").collect(), brute(rows))


def test_leads_too_large_for_a_task(llm, monkeypatch):
    rng = random.Random(9)
    common = prose(rng, 70)[:260]
    rows = [(i, prose(rng, 20) + common[: rng.randrange(190, 261)] + prose(rng, 20), "en", "a", 0) for i in range(60)]
    rows += passages(4, 20)
    monkeypatch.setattr(s, "HOT", 5)
    same_rows(s.remove_repeats(frame(llm, rows), keep_text=False).drop("kept").collect(), brute(rows))


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(2)
    text = (prose(rng, 900) + "ab" * 700 + prose(rng, 300)).encode()
    whole = s.text_anchors(text)
    monkeypatch.setattr(s, "PIECE", 777)
    assert (s.text_anchors(text) == whole).all()
    gaps = np.diff(np.concatenate(([-1], whole)))
    assert gaps.max() <= 200 - s.LEAD + 1  # every string holds an anchor


def test_anchors_do_not_depend_on_neighbours():
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(0, 200)).encode() for _ in range(30)]
    ends = np.cumsum([len(t) for t in texts])
    joint = s.anchors(np.frombuffer(b"".join(texts), np.uint8), ends)
    alone = [at + e - len(t) for t, e in zip(texts, ends) for at in s.text_anchors(t)]
    assert joint.tolist() == alone


def test_multikey_sort():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 3, (300, 24)).astype(np.uint8)
    rows[:100, :20] = rows[0, :20]
    order, shared = s.multikey_sort(s._symbols(rows))
    raw = [bytes(rows[i]) for i in order]
    assert raw == sorted(raw)
    for a, b, n in zip(raw, raw[1:], shared[1:]):
        assert n == next((i for i in range(24) if a[i] != b[i]), 24)


def test_kept_bytes_and_other_lengths(llm):
    rows = passages(6, 15, length=64)
    got = s.remove_repeats(frame(llm, rows), length=64).collect()
    same_rows([tuple(r)[:5] for r in got], brute(rows, 64))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    with pytest.raises(ValueError):
        s.remove_repeats(frame(llm, rows), length=20)


def test_nothing(nothing):
    assert s.remove_repeats(nothing).collect() == []
