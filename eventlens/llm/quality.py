"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger stores the
measurements and one bit per failed rule; a policy is a named, versioned mask
over those bits, so verdicts under another policy, and what each rule alone
removes, need only bitwise operations on the ledger and never the texts.

Main path: built-in functions only.  Repeated three-word windows are found
inside the row: windows are hashed to 64 bits and sorted by hash and position,
so equal windows are neighbours, at any length of the text.

Defined cases: a null or blank text has no words and fails ``few_words``;
repeated rows are judged alike; texts of any length are read whole; an empty
table gives an empty ledger.  Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, text_or_empty

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Bit ``bit`` is set where ``fails`` holds on the measurements."""

    bit: int
    name: str
    fails: Callable[[], Column]


#: Bits never change their meaning; new rules take new bits.
RULES = (
    Rule(0, "few_words", lambda: F.col("n_words") < 50),
    Rule(1, "repeated_windows", lambda: F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words")),
    Rule(2, "symbols", lambda: F.lit(10) * F.col("n_symbols") > F.col("n_words")),
    Rule(3, "word_length", lambda: (F.col("word_chars") < F.lit(2) * F.col("n_words")) | (F.col("word_chars") > F.lit(20) * F.col("n_words"))),
    Rule(4, "duplicate_lines", lambda: F.lit(2) * F.col("n_dup_lines") > F.col("n_lines")),
    Rule(5, "many_words", lambda: F.col("n_words") > 100_000),
)
#: policy -> mask of the rules that drop a document
POLICIES = {"base_v1": 0b11, "strict_v1": 0b011111, "strict_v2": 0b111111}


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    words = F.regexp_extract_all(F.col("t"), F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(F.col("t"), "\n", -1), lambda x: x.rlike(WORD))
    first = docs.select("doc_id", text_or_empty().alias("t")).select(
        "doc_id",
        F.transform(words, lambda w: F.xxhash64(w)).alias("w"),
        F.length(F.regexp_replace("t", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", f"[{SYMBOLS}]+", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    counted = first.select(
        "doc_id", "w", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    return counted.withColumn("n_repeat_words", _repeat_words(F.col("w"), F.col("n_words"))).drop("w")


def _repeat_words(w: Column, n: Column) -> Column:
    """Words covered by three-word windows that occur twice or more."""
    starts = F.sequence(F.lit(0), (n - 3).cast("int"))
    window_hash = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    empty = F.array().cast("array<bigint>")
    # by hash, then place: equal windows are neighbours whatever their number
    pairs = F.sort_array(F.transform(starts, lambda i: F.struct(window_hash(i).alias("h"), i.cast("long").alias("i"))))

    def repeated(sorted_: Column) -> Column:
        same = lambda x, k: F.coalesce(x["h"] == F.get(sorted_, k)["h"], F.lit(False))
        return F.transform(F.filter(sorted_, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])

    let = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    found = F.when(n < 3, empty).otherwise(let(pairs, repeated))
    covered = lambda at: F.aggregate(F.transform(at, lambda i, k: F.least(F.lit(3).cast("long"), F.coalesce(F.get(at, k + 1) - i, F.lit(3).cast("long")))), F.lit(0).cast("long"), lambda a, b: a + b)
    return let(F.sort_array(found), covered)


def ledger(docs: DataFrame, rules=RULES) -> DataFrame:
    """Measurements and ``failed``, the bitmask of the rules a document fails."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measurements(docs).withColumn("failed", bits)


def verdicts(ledger_df: DataFrame, policy: str, policies=POLICIES) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return ledger_df.withColumn("kept", F.col("failed").bitwiseAND(F.lit(policies[policy]).cast("long")) == 0)


def ablations(ledger_df: DataFrame, policy: str, rules=RULES, policies=POLICIES) -> DataFrame:
    """Per rule of the policy: documents that fail it, documents that only it
    removes, and documents kept without it.  One aggregate over bit patterns
    (at most 2^rules groups), then one row per rule."""
    mask = policies[policy]
    patterns = ledger_df.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("p")).agg(F.count("*").alias("n"))
    active = [r for r in rules if mask >> r.bit & 1]
    names = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("b")) for r in active])
    x = patterns.select("p", "n", F.explode(names).alias("r")).select("p", "n", "r.rule", "r.b")
    hit = F.col("p").bitwiseAND(F.col("b")) != 0
    only = F.col("p") == F.col("b")
    return x.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(only, F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when((F.col("p") == 0) | only, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
