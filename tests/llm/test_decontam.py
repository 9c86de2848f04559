import random
import re

from pyspark.sql import functions as F

from eventlens.llm import decontam
from tests.llm.conftest import frame, hard_rows, prose, same_rows


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, items, t=0.8):
    docs, bench = {}, {}
    for store, pairs in ((docs, [(r[0], r[1]) for r in rows]), (bench, items)):
        for k, text in pairs:
            store[k] = store.get(k, set()) | shingles(text)
    return [(d, i, len(b), len(s & b)) for d, s in docs.items() for i, b in bench.items() if b and len(s & b) >= t * len(b) - 1e-9]


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("k", F.lit("x")).withColumn("n", F.lit(1))


def cases():
    rng = random.Random(8)
    items = [(i, prose(rng, rng.choice([2, 4, 5, 6, 9, 14, 30, 55]))) for i in range(40)] + [(50, None), (51, " .!"), (None, prose(rng, 20)), (52, "one two"), (52, prose(rng, 12)), (53, "z" * 3000)]
    rows = hard_rows() + [(200, "One, TWO!", "en", "a", 0)]
    for n, (_, t) in enumerate(items):
        w = (t or "").split()
        lost = w[: len(w) // 2] + ["changed"] + w[len(w) // 2 + 1 :]
        rows.append((300 + n, prose(rng, 300) + " " + " ".join(w).upper() + ". " + prose(rng, 700), "en", "a", 0))
        rows.append((400 + n, prose(rng, 20) + " " + " ".join(lost) + " " + prose(rng, 20), "en", "a", 0))
        rows.append((500 + n, " ".join(w[: int(len(w) * 0.85)]), "en", "a", 0))
    return rows, items


def test_against_brute_force(llm):
    rows, items = cases()
    got = decontam.contamination(frame(llm, rows, extra=True), bench(llm, items)).collect()
    assert len(got) > 40
    same_rows([(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in got], brute(rows, items))
    assert all(abs(r.containment - r.n_shared / r.n_item_shingles) < 1e-12 for r in got)


def test_documents_that_hold_items_go(llm):
    rows, items = cases()
    df = frame(llm, rows, extra=True)
    kept = decontam.decontaminate(df, bench(llm, items))
    leaks = {d for d, *_ in brute(rows, items)}
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted((r[0] is None, r[0] or 0, r[1] or "") for r in rows if r[0] not in leaks)


def test_rows_that_share_an_id_are_judged_by_their_texts(llm):
    """A leak takes its own row, not the rows without id or of the same id;
    halves of an item in two such rows are no leak."""
    rng = random.Random(4)
    items = [(1, prose(rng, 30)), (2, prose(rng, 40))]
    w = items[1][1].split()
    clean = [prose(rng, 60) for _ in range(6)]
    halves = [" ".join(w[:22]), " ".join(w[18:])]
    rows = [(i, t, "en", "a", 0) for i in (None, 7) for t in [*clean, *halves, prose(rng, 9) + " " + items[0][1], None]]
    got = decontam.contamination(frame(llm, rows), bench(llm, items)).collect()
    same_rows([(r.doc_id, r.item_id) for r in got], [(None, 1), (7, 1)])
    kept = decontam.decontaminate(frame(llm, rows), bench(llm, items)).collect()
    same_rows([(r.doc_id, r.text) for r in kept], [r[:2] for r in rows if items[0][1] not in (r[1] or "")])


def test_sketch_never_misses(llm):
    """The sketch of a partition holds more hashes than a match may miss."""
    df = llm.range(1, 3000).select(F.col("id").alias("n")).withColumn("s", decontam.sketch_size(F.col("n"), 0.8))
    assert df.where("s < floor(0.2 * n + 1e-9) + 1").count() == 0


def test_only_what_the_sketch_finds_is_counted(llm, monkeypatch):
    """With empty sketches nothing is found, and no join goes past them: the
    shingles of documents meet those of items only for found pairs."""
    rows, items = cases()
    docs = frame(llm, rows)
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    found = decontam.matches(docs, bench(llm, items), 0.8, 5)
    pairs = [x for x in plan(found).splitlines() if "Join" in x]
    # outermost: hits by document, text and shingle with the candidates' shingles
    assert pairs and pairs[0].count("<=>") == 1 and pairs[0].count(" = ") == 2, pairs
    monkeypatch.setattr(decontam, "sketch_size", lambda n, t: F.lit(0))
    assert decontam.contamination(docs, bench(llm, items)).collect() == []


def test_nothing(llm, nothing):
    rows, items = cases()
    assert decontam.contamination(nothing, bench(llm, items)).collect() == []
    assert decontam.contamination(frame(llm, rows), bench(llm, [])).collect() == []
    assert decontam.decontaminate(frame(llm, rows), bench(llm, [])).count() == len(rows)
