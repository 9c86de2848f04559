"""Mixing sources to target weights.

Words are summed per source; each source's target is its share, by weight, of
``budget`` times all words, stopped at ``max_repeat`` times the source's own
words, and what is over is shared again among the others by weight.  A
document is emitted floor(rate) times, rate = target / source words, plus one
hash-seeded Bernoulli copy with probability equal to the rate's fraction.

The Bernoulli copies of a source are drawn together, so that a source of few or
very unequal documents comes near its target as well.  Its documents stand in
order of size, then of a seeded hash; the fraction is added up along them from
an offset in [0, 1) that a hash of source and seed gives, and a document gets
its copy where the sum passes a whole number.  With the offset uniform, each
document's probability is the fraction exactly; and as neighbours are of like
size, the words taken miss the target by less than the largest document has.

Places within a source come from one range-partitioned sort of narrow rows
(``global_rank``), so a source that holds a third of all rows is no task's.

Defined cases: a null text is empty (size 0), an empty source has target 0 and
rate 0; a null source is a source of its own, last in order; rows of one id,
or without one, are told apart by their texts; repeated rows stand next to each
other and share what they get; an empty table gives an empty plan.  Other
columns of the input are kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, aside, global_rank, text_or_empty, written


def draw(seed: int, key: Column) -> Column:
    """A number in [0, 1) from a key and the seed."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def _tie(seed: int) -> Column:
    """The order of a source's documents of one size."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_or_empty()))


def source_targets(sizes: DataFrame, weights=(5, 2, 1), budget: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Weights repeat over the sources in code-point order, null last.  The
    water level rises until no uncapped source is over its cap; each round is
    one aggregate over the per-source table, and only two sums reach the
    driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(totals, [F.col("source").asc_nulls_last()], "rank", "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    table = written(
        ranked.select("source", "source_size", weight.alias("weight"), (F.lit(max_repeat) * F.col("source_size")).alias("cap")),
        "mix-weights",
    )
    total, shares = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    all_words = budget * total
    level = all_words / shares if shares else 0.0
    while shares:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        capped, open_shares = table.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))
        ).first()
        raised = (all_words - capped) / open_shares if open_shares else float("inf")
        if raised == level or not open_shares:
            level = raised
            break
        level = raised
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level)) if level != float("inf") else F.col("cap")
    return table.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, weights=(5, 2, 1), budget: float = 1.5, max_repeat: float = 2.0, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, source, size, tie, source_size, target, copies."""
    # the whole text is read once; all that follows uses the narrow table
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size")
    sizes = written(docs.select("doc_id", F.col("source").cast("string").alias("source"), size, _tie(seed).alias("tie")), "mix-sizes")
    targets = source_targets(sizes, weights, budget, max_repeat)
    # equal rows may be dealt apart: which of them comes first makes no difference
    apart = sizes.withColumn("row", F.monotonically_increasing_id())
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("tie"), F.col("row")]
    ranked = written(global_rank(apart, order, "rank", "mix-order").select("doc_id", "source", "size", "tie", "rank"), "mix-ranked")
    first = ranked.groupBy("source").agg(F.min("rank").alias("first"))
    same = lambda x, y: F.col(f"{x}.source").eqNullSafe(F.col(f"{y}.source"))
    per = targets.alias("t").join(first.alias("f"), same("t", "f")).select("t.source", "source_size", "target", "first").alias("t")
    rate = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    upto = lambda n: F.floor((rate - whole) * n + draw(seed, F.col("t.source")))
    place = F.col("s.rank") - F.col("t.first")
    copies = whole + upto(place + 1) - upto(place)
    return ranked.alias("s").join(per, same("s", "t")).select(
        "s.doc_id", "s.source", "s.size", "s.tie", "t.source_size", "t.target", copies.cast("long").alias("copies")
    )


def mix(docs: DataFrame, **params) -> DataFrame:
    """The documents of the mix, each as many times as its plan says.

    The plan's row of a document is found by id, source and seeded hash.
    Repeated rows are brought together first by a partial aggregate, which
    keeps rows that differ in any column apart, and share the copies that the
    plan gives their id and text."""
    seed = params.get("seed", 17)
    plan = mix_plan(docs, **params).groupBy("doc_id", "source", "tie").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    plan = written(plan.withColumnsRenamed({"doc_id": "__id", "source": "__source", "tie": "__tie"}), "mix-plan")
    docs, back = aside(docs)
    d = docs.withColumn("__hash", _tie(seed))
    same = (F.col("__hash") == F.col("__tie")) & F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").cast("string").eqNullSafe(F.col("__source"))
    d = d.join(plan, same)
    alone = d.where("__rows = 1").select(*docs.columns, "__copies")
    # rows that differ in nothing are one row n times; of the r rows of an id and
    # text that differ elsewhere, each kind gets its share of their copies
    once = d.where("__rows > 1").withColumn("__one", F.md5(F.to_json(F.struct(*docs.columns))))
    several = once.groupBy("__one").agg(*[F.first(c).alias(c) for c in docs.columns], F.first("__copies").alias("__sum"), F.first("__rows").alias("__rows"), F.count("*").alias("__n"))
    share = F.col("__sum") * F.col("__n") / F.col("__rows")
    copies = F.floor(share) + F.when(draw(seed, F.col("__one")) < share - F.floor(share), 1).otherwise(0)
    several = several.withColumn("__copies", copies.cast("long"))
    kept = alone.unionByName(several.select(*docs.columns, "__copies")).where("__copies > 0")
    return back(kept.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int")))).select(*docs.columns))
