"""Removal of repeated runs of lines by a suffix array over line ids.

The corpus is one sequence of line ids: documents in order of doc_id, lines
in order, and a gap between documents that no run crosses.  Lines without a
word are not part of the sequence and always stay.

Prefix doubling: at depth 2^k every suffix has the rank of its first 2^k
lines; ranks of twice the depth come from the pairs (rank at p, rank at
p + 2^k), whose distinct values are ranked by a range-partitioned global sort,
so ranks keep the order of the suffixes.  Suffixes whose prefix occurs once
have found their place and leave; the rounds end when all have.  The suffixes
that share a rank are an interval of the suffix array with a common prefix of
at least 2^k lines.  Every maximal repeated run of ``min_lines`` lines or more
is covered by the intervals of depth ``min_lines`` that its lines start, so
deleting all of them but the first in corpus order deletes exactly the later
copies of maximal runs; deeper intervals give the runs' lengths.

Line ids and pairs are counted by combining aggregates, so a line that fills a
third of the corpus is no hot group; joins on ranks may be split by Spark.

Defined cases: a null text has one empty line; rows that share doc_id (null
first) and text are one document and get the same result; runs that overlap
their own copy keep the first line of it; long texts are read whole; an empty
table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_rank, text_or_empty, written

MIN_LINES = 2


def line_sequence(docs: DataFrame) -> DataFrame:
    """One row per line with a word: pos (place in the corpus), doc_id, th
    (hash of the text), seq (place in the document), line_no, and the line's
    128-bit id (h1, h2)."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).withColumn("th", F.xxhash64("t"))
    ids = F.transform(
        F.split("t", "\n", -1),
        lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), F.struct(i.alias("line_no"), F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"))),
    )
    words = t.select("doc_id", "th", F.array_compact(ids).alias("ids"))
    lines = written(
        words.select("doc_id", "th", F.size("ids").alias("n"), F.posexplode("ids").alias("seq", "x"))
        .select("doc_id", "th", "n", "seq", "x.line_no", "x.h1", "x.h2").dropDuplicates(["doc_id", "th", "seq"]),
        "lines",
    )
    sizes = lines.where("seq = 0").select("doc_id", "th", "n")
    # a document takes one place more than it has lines
    ends = global_rank(sizes, [F.col("doc_id").asc_nulls_first(), F.col("th")], "end", "line-docs", F.col("n").cast("long") + 1)
    a, e = lines.alias("a"), ends.alias("e")
    same = (F.col("a.th") == F.col("e.th")) & F.col("a.doc_id").eqNullSafe(F.col("e.doc_id"))
    return a.join(e, same).select((F.col("end") - F.col("a.n") - 1 + F.col("seq")).alias("pos"), "a.doc_id", "a.th", "seq", "line_no", "h1", "h2")


def repeated_runs(lines: DataFrame):
    """Yields (depth, table) for depth 1, 2, 4, ...: pos, rank and first of
    every suffix whose first ``depth`` lines occur again; ``first`` is the
    first place where they do."""
    keyed, keys, depth = lines.select("pos", F.col("h1").alias("a"), F.col("h2").alias("b")), ["a", "b"], 1
    while True:
        again = keyed.groupBy(*keys).agg(F.min("pos").alias("first"), F.max("pos").alias("last")).where("first < last").drop("last")
        ranked = written(global_rank(again, [F.col(k) for k in keys], "rank", "line-ranks"), "line-classes")
        now = written(keyed.join(ranked, keys).select("pos", "rank", "first"), "line-suffixes")
        if now.isEmpty():
            return
        yield depth, now
        right = now.select((F.col("pos") - depth).alias("pos"), F.col("rank").alias("b"))
        keyed = written(now.select("pos", F.col("rank").alias("a")).join(right, "pos"), "line-pairs")
        depth *= 2


def remove_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, n_runs (maximal removed runs),
    longest_repeat (largest 2^k such that 2^k lines in a row, all in removed
    runs, occur earlier; 0 if none) and kept, the text that is left."""
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines is a power of two")
    lines = written(line_sequence(docs), "line-sequence")
    later = removed = None
    for depth, suffixes in repeated_runs(lines):
        if depth < min_lines:
            continue
        copies = suffixes.where("pos > first").select("pos", F.lit(depth).cast("long").alias("depth"))
        if removed is None:
            at = F.explode(F.sequence(F.col("pos"), F.col("pos") + F.lit(depth - 1)))
            removed = copies.select(at.alias("pos")).distinct()
        later = copies if later is None else later.unionByName(copies)
    if removed is None:
        removed = lines.select("pos").limit(0)
        later = removed.withColumn("depth", F.lit(0).cast("long"))
    deepest = later.groupBy("pos").agg(F.max("depth").alias("depth"))
    gone = lines.join(removed, "pos").join(deepest, "pos", "left")
    by_doc = written(
        gone.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list("seq")).alias("seqs"), F.collect_list("line_no").alias("gone"), F.max("depth").alias("depth")), "line-removed"
    )
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).withColumn("th", F.xxhash64("t")).alias("d")
    r = by_doc.alias("r")
    same = (F.col("d.th") == F.col("r.th")) & F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))
    # the removed lines grow with the corpus: merged at every size, never broadcast
    joined = d.join(r.hint("merge"), same, "left").select("d.doc_id", F.split("d.t", "\n", -1).alias("x"), "seqs", "gone", "depth")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("x") - 1), F.coalesce("gone", F.array().cast("array<int>"))), lambda i: F.get("x", i))
    breaks = F.filter(F.transform("seqs", lambda s, k: s - F.coalesce(F.get("seqs", k - 1), F.lit(-2))), lambda g: g != 1)
    return joined.select(
        "doc_id",
        F.size("x").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size(breaks)).cast("long").alias("n_runs"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("longest_repeat"),
        F.array_join(kept, "\n").alias("kept"),
    )
