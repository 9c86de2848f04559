"""The five stages against plain Python over a small corpus."""



import corpus_pipeline
from eventlens.llm.common import written
from tests.llm import test_decontam, test_mixing, test_simhash
from tests.llm.conftest import same_rows
from tests.llm.test_token_ids import brute as brute_ids

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert len(corpus_pipeline.STAGES) == 5
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontaminate", "mix_sources", "token_ids"]


def test_run_against_brute_force(llm):
    docs = [tuple(r) for r in llm.read.parquet(f"{SMALL}/documents.parquet").select(COLUMNS).collect()]
    items = [tuple(r) for r in llm.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    now = [r for r in docs if any(c.isalpha() for c in r[1] or "")]
    keep = {c for _, _, c in test_simhash.brute(now)}
    now = [r for r in now if r[0] in keep]
    leaks = {d for d, *_ in test_decontam.brute(now, items)}
    assert leaks
    now = [r for r in now if r[0] not in leaks]
    now = [r for r, b in zip(now, test_mixing.brute(now)) for _ in range(b[-1])]
    got = corpus_pipeline.run(llm, SMALL).collect()
    same_rows(got, brute_ids(now))
    assert sum(r.n_tokens for r in got) == max(r.start + r.n_tokens for r in got)


def test_stages_take_hard_rows_and_nothing(llm, hard, nothing):
    _, df = hard
    for first in (df, nothing):
        docs = written(first, "t-pipeline")
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = written(stage(llm, docs, SMALL), "t-pipeline")
            assert name == "token-ID output" or docs.columns == columns
        if first is nothing:
            assert docs.count() == 0
        else:
            assert docs.count() > 10
