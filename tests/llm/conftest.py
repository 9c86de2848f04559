import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: columns that a careless plan would mix up with its own
CLASHING = "k t w s fp size rank part label pos seq lines words u v id lead context digest salt refers_to copies rate".split()


@pytest.fixture(scope="session")
def llm(spark):
    from eventlens.llm.common import ship

    ship(spark)
    return spark


def prose(rng, n, vocabulary=400):
    return " ".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") + str(rng.randrange(vocabulary)) for _ in range(n))


def hard_rows(seed=3):
    """Nulls, empty and long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 30, 120, 400])) for _ in range(20)]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(base)]
    rows += [(100, None, None, None, None), (101, "", "en", "src0", 0), (102, " \t\n\r ", "de", None, 5), (None, base[0], "en", "src1", 1), (None, None, None, None, None)]
    rows += [(103, base[5], "en", "src9", 2), (103, base[5], "en", "src9", 2), (104, base[5] + " tail", "en", "src0", 2)]
    rows += [(105, "one", "en", "src0", 3), (106, "ONE", "en", "src0", 3), (107, "one two", "en", "src0", 3)]
    rows += [(108, "line a b\nline c d\n\nline a b\nline c d\nline c d\n" + base[6], "en", "src2", 3), (109, "x\n" * 40, "en", "src2", 3)]
    rows += [(110, "\n".join(prose(rng, 9) for _ in range(3000)), "en", "src2", 9), (111, "añejo\u00a0été ÀÉ Straße " * 60, "fr", "src2", 9)]
    rows += [(112, "z" * 3000, "en", "src2", 9), (113, "<|endoftext|> a  b\u2003c\u0085d \u001c e" * 30, None, "src2", 9)]
    return rows


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if extra:
        for c in CLASHING:
            df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def hard(llm):
    return hard_rows(), frame(llm, hard_rows(), extra=True)


@pytest.fixture(scope="session")
def nothing(llm):
    return frame(llm, [])


def same_rows(got, expected):
    key = lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in r)
    a, b = sorted(map(tuple, got), key=key), sorted(map(tuple, expected), key=key)
    assert a == b, ([x for x in a if x not in b][:3], [x for x in b if x not in a][:3], len(a), len(b))
