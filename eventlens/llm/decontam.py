"""Benchmark decontamination: size-partitioned MinHash containment search.

Texts become sequences of words (runs of letters and digits, lower case); a
shingle is the hash of five words in a row, the whole sequence where a text
has fewer.  Items are partitioned by size, powers of two over their distinct
shingles.  An item's sketch is its ``s`` smallest hashes, where ``s`` is what
the upper size ``u`` of its partition needs: s = floor((1 - t) u) + 1.  A
document that holds a share ``t`` of an item's shingles misses at most
floor((1 - t) n) of them, so it always holds one of the ``s`` smallest: the
search loses no item at or above the threshold, however long the document.
Found pairs, and no others, are verified by counting the item's shingles in
the document.

Main path: built-in functions only.  A document's shingles leave the row only
when some item has them, so the shuffles carry hits and not texts.

Defined cases: null or wordless texts have no shingle and match nothing; rows
that share doc_id (null or not) and text are one document, rows that share an
id but not a text are documents of their own; rows that share an item_id are
one item, rows without one are one item per text; an empty table on either
side gives no rows.
Other columns are ignored by ``contamination`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import aside, text_or_empty, written

WORDS_PER_SHINGLE = 5
THRESHOLD = 0.8


def shingles(df: DataFrame, key: str, k: int = WORDS_PER_SHINGLE, by_text: bool = False) -> DataFrame:
    """(k, s): the key and the shingle hashes of every row's whole text,
    repeats included; ``by_text`` adds the text's hash, th."""
    keys = ["k", "th"] if by_text else ["k"]
    plain = F.trim(F.regexp_replace(F.lower(text_or_empty()), r"[^\p{L}\p{N}]+", " "))
    w = df.select(F.col(key).alias("k"), F.xxhash64(text_or_empty()).alias("th"), plain.alias("t")).select(*keys, F.when(F.length("t") > 0, F.transform(F.split("t", " "), lambda x: F.xxhash64(x))).alias("w"))
    windows: Column = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("w") - k, F.lit(0))),
        lambda i: F.xxhash64(*[F.coalesce(F.get("w", i + j), F.lit(0).cast("long")) for j in range(k)]),
    )
    return w.where("w is not null").select(*keys, F.explode(windows).alias("s"))


def item_shingles(items: DataFrame, k: int = WORDS_PER_SHINGLE) -> DataFrame:
    """(item_id, tag, s, n, place): an item's distinct shingles, their number,
    and each one's place in the item's hash order.  Items without id are told
    apart by ``tag``, the hash of their text."""
    from pyspark.sql import Window

    s = shingles(items, "item_id", k, by_text=True).select(F.col("k").alias("item_id"), F.when(F.col("k").isNull(), F.col("th")).otherwise(0).alias("tag"), "s").distinct()
    by_item = Window.partitionBy("item_id", "tag")  # one benchmark item's shingles
    order = F.row_number().over(by_item.orderBy("s"))
    return s.select("item_id", "tag", "s", F.count("*").over(by_item).alias("n"), order.alias("place"))


def sketch_size(n: Column, threshold: float) -> Column:
    """Hashes a sketch needs in the size partition (u/2, u] of ``n``."""
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double"))))
    return F.floor(upper * F.lit(1 - threshold) + F.lit(1e-9)) + 1


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = WORDS_PER_SHINGLE) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id,
    n_item_shingles, n_shared, containment (n_shared / n_item_shingles >= threshold)."""
    share = F.col("n_shared") / F.col("n")
    return matches(docs, items, threshold, k).select(F.col("k").alias("doc_id"), "item_id", F.col("n").alias("n_item_shingles"), "n_shared", share.alias("containment"))


def matches(docs: DataFrame, items: DataFrame, threshold: float, k: int) -> DataFrame:
    """(k, th, item_id, tag, n, n_shared): the documents, by doc_id and hash of the
    text, and the items they contain."""
    item_s = written(item_shingles(items, k), "bench-shingles")
    # Spark broadcasts this side only while its measured size is below
    # autoBroadcastJoinThreshold, and shuffles both sides beyond
    wanted = item_s.select("s").distinct()
    hits = written(shingles(docs, "doc_id", k, by_text=True).join(wanted, "s", "left_semi").distinct(), "bench-hits")
    sketch = item_s.where(F.col("place") <= sketch_size(F.col("n"), threshold)).select("item_id", "tag", "s")
    found = hits.join(sketch, "s").select("k", "th", "item_id", "tag").distinct()
    # only the candidates' shingles are counted
    h, c = hits.alias("h"), found.alias("f").join(item_s.alias("i"), F.col("f.item_id").eqNullSafe(F.col("i.item_id")) & (F.col("f.tag") == F.col("i.tag"))).select("k", "th", "f.item_id", "f.tag", "n", "s").alias("c")
    same = F.col("h.k").eqNullSafe(F.col("c.k")) & (F.col("h.th") == F.col("c.th")) & (F.col("h.s") == F.col("c.s"))
    verified = c.join(h, same).groupBy("c.k", "c.th", "item_id", "tag", "n").agg(F.count("*").alias("n_shared"))
    return verified.where(F.col("n_shared") >= F.lit(threshold) * F.col("n") - F.lit(1e-9))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = WORDS_PER_SHINGLE) -> DataFrame:
    """The documents that contain no item."""
    found = written(matches(docs, items, threshold, k).select(F.col("k").alias("__leak"), F.col("th").alias("__th")).distinct(), "bench-leaks")
    docs, back = aside(docs)
    leaks = F.col("doc_id").eqNullSafe(F.col("__leak")) & (F.xxhash64(text_or_empty()) == F.col("__th"))
    return back(docs.join(found, leaks, "left_anti").select(*docs.columns))
