"""The queries' columns and, where SQL cannot say it, their rows."""

import pytest

from eventlens.llm.queries import QUERIES
from tests.llm import test_conversation_repair, test_simhash, test_suffix_dedup, test_token_ids, test_url_filter
from tests.llm.conftest import same_rows

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op2": "page_id bigint, host string, path string, rule string, verdict string",
    "op4": "doc_id bigint, fingerprint string, component_id bigint",
    "op6": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op13": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op7": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
}


@pytest.fixture(scope="module")
def docs(llm):
    rows = llm.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    return [tuple(r) for r in rows]


def run(llm, n):
    name = next(k for k in QUERIES if k.startswith(f"op{n}_"))
    df = QUERIES[name](llm, SMALL)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[f"op{n}"]
    return df.collect()


def test_op1(llm, docs):
    same_rows(run(llm, 1), test_token_ids.brute(docs))


def test_op2(llm):
    pages = {r.page_id: r.url for r in llm.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = run(llm, 2)
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = test_url_filter.expected(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_op4(llm, docs):
    same_rows(run(llm, 4), [(d, f"{f % (1 << 64):016x}", c) for d, f, c in test_simhash.brute(docs)])


def test_op6(llm, docs):
    import zlib

    got = {r.doc_id: r for r in run(llm, 6)}
    assert len(got) == len(docs)
    for d, text, lang, *_ in docs:
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= got[d].score <= 1
    held = [(got[d].lang_pred, lang) for d, _, lang, *_ in docs if got[d].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_op7(llm, docs):
    same_rows(run(llm, 7), test_suffix_dedup.brute(docs))


def test_op13(llm):
    rows = [tuple(r) for r in llm.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same_rows(run(llm, 13), test_conversation_repair.brute(rows))
