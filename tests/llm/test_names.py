"""Columns of the input that have the names operators give their own."""

import pytest
from pyspark.sql import functions as F

from eventlens.llm import decontam, langid, mixing, simhash, url_filter
from tests.llm.conftest import frame, hard_rows

PRIVATE = "__lang __score __keep __th __source __rate __copies __copy __leak __host __path __rule __ruled __verdict __s __suffix label kept_0".split()


@pytest.fixture(scope="module")
def both(llm):
    df = frame(llm, hard_rows())
    return df, df.withColumns({c: F.lit(f"mine {c}") for c in PRIVATE})


def stages(llm):
    items = llm.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    return {
        "language": lambda d: langid.reject(d, langid.train(langid.training_part(d))),
        "simhash": lambda d: simhash.dedup(d, k=3, radius=3),
        "decontaminate": lambda d: decontam.decontaminate(d, items),
        "mix": mixing.mix,
    }


@pytest.mark.parametrize("name", ["language", "simhash", "decontaminate", "mix"])
def test_they_stay_as_they_are(llm, both, name):
    plain, private = both
    stage = stages(llm)[name]
    a, b = stage(plain), stage(private)
    assert b.columns == private.columns
    rows = b.collect()
    assert all(r[c] == f"mine {c}" for r in rows for c in PRIVATE)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    assert sorted(map(key, rows)) == sorted(map(key, a.collect()))


def test_results_take_the_place_of_their_names(llm):
    pages = llm.createDataFrame([(1, "http://a.org/x", "k", 0.5), (2, None, "k", 0.5)], "page_id long, url string, __host string, __s double")
    got = url_filter.judge(pages, (url_filter.Rule("allow", "org"), url_filter.Rule("block", "com")))
    assert got.columns == ["page_id", "url", "__s", "__host", "__path", "__rule", "__verdict"]
    assert sorted((r["__host"], r["__s"]) for r in got.collect()) == [("", 0.5), ("a.org", 0.5)]


def test_items_without_id_are_items_of_their_own(llm):
    texts = ["alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine"]
    items = llm.createDataFrame([(None, t) for t in texts], "item_id long, text string")
    docs = frame(llm, [(1, "so " + texts[0] + " it goes", "en", "a", 1), (2, texts[1], "en", "a", 1), (3, texts[0][:20], "en", "a", 1)])
    got = decontam.contamination(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.containment) for r in got) == [(1, None, 1.0), (2, None, 1.0)]
    assert [r.doc_id for r in decontam.decontaminate(docs, items).collect()] == [3]
