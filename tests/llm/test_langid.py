import random
import string

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from eventlens.llm import langid
from tests.llm.conftest import frame


def plain_vector(text):
    """Bundle of bound grams, letter by letter."""
    seq, boundary = [0], True
    for c in (text or "").lower():
        x = ord(c) if c.isalpha() else 0
        if x or not boundary:
            seq.append(x)
        boundary = not x
    if not boundary:
        seq.append(0)
    v = np.zeros(langid.DIMENSIONS)
    for a, b, c in zip(seq, seq[1:], seq[2:]):
        la, lb, lc = (langid.letter_vector(x, langid.DIMENSIONS).astype(int) for x in (a, b, c))
        v += np.roll(la, 2) * np.roll(lb, 1) * lc
    return v


def test_vectors_against_letter_by_letter():
    texts = ["Hello, World! ", None, "", "a", "çà ÉTÉ 12 x", "漢字かな 漢字", "ab\n\ncd  ef", "İx"]
    counts, letters, n = langid.gram_counts(texts)
    got = counts @ langid.gram_vectors(letters, langid.DIMENSIONS)
    for row, t in zip(got, texts):
        assert np.allclose(row, plain_vector(t)), t
    assert n[1] == n[2] == 0 and n[0] == 10


def test_order_of_letters_matters():
    f = lambda t: plain_vector(t) / np.linalg.norm(plain_vector(t))
    assert abs(f("abcabcabc") @ f("cbacbacba")) < 0.3


def test_hard_rows(hard):
    rows, df = hard
    model = langid.train(langid.training_part(df))
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r["__lang"] != "und") == letters and 0 <= r["__score"] <= 1
        assert letters or r["__score"] == 0
    kept = langid.reject(df, model)
    assert kept.columns == df.columns and kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in rows)


def test_held_out_accuracy(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(langid.training_part(docs))
    judged = langid.predict(docs.select("doc_id", "text", "lang"), model).where(langid.held_out()).collect()
    assert len(judged) > 200
    assert sum(r.lang == r["__lang"] for r in judged) / len(judged) > 0.97


def test_pieces_and_groups(llm, monkeypatch):
    text = "the quick brown fox jumps " * 200
    whole = langid.gram_counts([text])[0].sum()
    monkeypatch.setattr(langid, "PIECE", 500)
    assert abs(langid.gram_counts([text])[0].sum() - whole) < 60  # grams across a cut only
    assert [s.stop - s.start for s in langid._groups(["x" * 400] * 9)] == [3, 3, 3]


def test_no_training_rows_and_nothing(llm, nothing):
    model = langid.train(nothing)
    assert model.languages == ()
    one = langid.predict(frame(llm, [(1, "abc", None, None, 1)]), model).first()
    assert (one["__lang"], one["__score"]) == ("und", 0.0)
    assert langid.predict(nothing, model).collect() == []


FOREIGN_AND_JUNK = [
    "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 6,
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván. ",
    "".join(random.Random(1).choice("0123456789abcdef") for _ in range(3000)),
    "".join(random.Random(2).choice(string.ascii_letters + string.digits + "+/") for _ in range(3000)),
    "z" * 3000,
]


def test_foreign_and_junk_texts_go(llm):
    """Planted texts leave the language stage whatever label they carry, also
    from the training rows; clean documents stay."""
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    planted = [(10**9 + i, t, "en", "web", len(t)) for i, t in enumerate(FOREIGN_AND_JUNK * 3)]
    kept = corpus_pipeline.language_id(llm, docs.unionByName(frame(llm, planted)), "")
    assert kept.columns == docs.columns
    assert kept.where(F.col("doc_id") >= 10**9).collect() == []
    assert kept.count() == docs.count()


def test_least_scores_by_length(llm, nothing):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    least = langid.least_scores(docs, model)
    rows = [(len(r.text).bit_length() - 1, r["__score"]) for r in langid.predict(docs.select("text"), model).collect()]
    for c in {c for c, _ in rows}:
        scores = sorted(s for k, s in rows if k == c)
        assert abs(least[c] - langid.SHARE * scores[(len(scores) - 1) // 2]) < 1e-3
    assert least[-1] == least[max(c for c, _ in rows)] and least[0] == 0
    assert set(langid.least_scores(nothing, langid.train(nothing))) == {0.0}


def test_profiles_are_the_tables_product():
    rng = random.Random(8)
    texts = ["Hello, World! ", None, "", "a", "çà ÉTÉ 12 x", "漢字かな 漢字", "İx"] + ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(2500)) for _ in range(20)]
    x, n = langid.profiles(texts, langid.DIMENSIONS)
    for row, t in zip(x[:8], texts):
        assert np.allclose(row, plain_vector(t)), t
    counts, letters, n_table = langid.gram_counts(texts)  # over 32,768 grams: counted sparsely above
    assert len(letters) > 8 * langid.GRAMS and (n == n_table).all()
    assert np.allclose(x, np.concatenate([counts[:, g : g + 2048] @ langid.gram_vectors(letters[g : g + 2048], langid.DIMENSIONS) for g in range(0, len(letters), 2048)], axis=0).reshape(-1, *x.shape).sum(axis=0))


def test_memory_of_large_alphabets_is_bounded():
    """512 texts of 4,000 characters, 3,000 different: 2,108 MB with a table of
    128 of them, before counts were sparse."""
    import tracemalloc

    rng = random.Random(1)
    texts = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(4000)) for _ in range(512)]
    tracemalloc.start()
    for g in langid._groups(texts):
        langid.profiles(texts[g], langid.DIMENSIONS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20, peak
