"""Suffix-array removal of repeated byte strings.

A byte is removed when some ``length``-byte string that covers it starts
anywhere else in the corpus, the same document included; strings never cross
documents and are judged on the input.

Sparse suffix array.  Suffixes are sampled at anchors: positions whose
``LEAD``-byte hash is least in some window of length - LEAD + 1 positions.
Every ``length``-byte string holds an anchor at a place that only its bytes
decide, so equal strings hold the same anchor at the same offset, and it is
enough to compare suffixes that begin with the same LEAD bytes, with what
stands before and after them.  About one position in 90 is an anchor.

1. A pass over the texts emits anchors: hash of the lead and hash of the whole
   context, all bytes any string around the anchor could reach.
2. Anchors are counted by (lead, context), combined before the shuffle, so the
   anchors of a thousand copies become one class.  Classes with two members
   are repeated in whole; classes alone with their lead are not repeated.
3. What is left, one member per class, fetches its bytes.  Suffixes are range-
   partitioned by their leading bytes with sampled splitters; each bucket is
   sorted by multikey quicksort on eight-byte symbols, right contexts and
   reversed left contexts alike, and neighbours' common prefixes give, for
   every offset, the classes of equal strings.  Equal leads never straddle a
   bucket boundary, so no string is compared across one.
4. A lead with more than ``HOT`` distinct contexts is no group for one task:
   its strings are hashed one by one (128 bits) and counted by a combining
   aggregate, which is exact at any size.
5. Spans go back to their documents, are merged and cut out.

Defined cases: a null or empty text has no bytes; texts shorter than
``length`` keep all; long texts are scanned in overlapping pieces; rows are
told apart by doc_id (null included) and text, so repeated rows count as
copies of each other and get the same result; an empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, written

LENGTH = 200
#: Bytes that anchored suffixes must share.
LEAD = 24
#: Distinct contexts of a lead that one task compares.
HOT = 50_000
#: Bytes scanned at a time, and documents' bytes gathered for one scan.
PIECE, GROUP = 1 << 22, 1 << 18


# -- anchors ------------------------------------------------------------------

def _sliding(x: np.ndarray, n: int, best) -> np.ndarray:
    """best of every run of n values, by doubling."""
    have = 1
    while 2 * have <= n:
        x = best(x[: len(x) - have], x[have:])
        have *= 2
    return x if have == n else best(x[: len(x) - (n - have)], x[n - have :])


def _hashes(data: np.ndarray) -> np.ndarray:
    """Mixed polynomial hash (32 bits, odd) of the LEAD bytes at every position."""
    x, have, todo, out, out_n = data.astype(np.uint32), 1, LEAD, None, 0
    while True:  # hashes of 1, 2, 4, ... bytes; those that LEAD consists of are joined
        if todo & 1:
            n = len(data) - out_n - have + 1
            out, out_n = (x if out is None else out[:n] * _power(have) + x[out_n : out_n + n]), out_n + have
        todo >>= 1
        if not todo:
            break
        x = x[: len(x) - have] * _power(have) + x[have:]
        have *= 2
    out = out ^ (out >> np.uint32(15))
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(12)
    return out | np.uint32(1)


def _power(n: int) -> np.uint32:
    return np.uint32(pow(0x01000193, n, 1 << 32))


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Anchor positions in concatenated texts; ``ends`` are the texts' ends."""
    if len(data) < length:
        return np.zeros(0, np.int64)
    span = length - LEAD + 1
    h = _hashes(data)
    least = _sliding(h, span, np.minimum)  # one per string start
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    least = np.where(np.cumsum(inside[:-1])[: len(least)] > 0, least, 0)  # strings inside one text
    pad = np.zeros(span - 1, np.uint32)
    most = _sliding(np.concatenate((pad, least, pad)), span, np.maximum)
    return np.flatnonzero(h == most[: len(h)])


def text_anchors(text: bytes, length: int = LENGTH) -> np.ndarray:
    """Anchors of one text, scanned in overlapping pieces."""
    if len(text) <= PIECE:
        return anchors(np.frombuffer(text, np.uint8), np.array([len(text)]), length)
    found = []
    for at in range(0, len(text) - length + 1, PIECE):
        piece = np.frombuffer(text, np.uint8, min(PIECE + length - 1, len(text) - at), at)
        found.append(at + anchors(piece, np.array([len(piece)]), length))
    return np.unique(np.concatenate(found))


def _scan(length: int):
    """(doc_id, th, t) -> anchors with the hashes of lead and context."""
    left = length - LEAD

    def run(batches):
        import xxhash

        hash_of = xxhash.xxh64_intdigest
        for b in batches:
            ids, ths, texts = b.column(0), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_pylist()
            doc, at = [], []
            i = 0
            while i < len(texts):
                if len(texts[i]) > GROUP:
                    found = text_anchors(texts[i], length)
                    doc.append(np.full(len(found), i))
                    at.append(found)
                    i += 1
                    continue
                j, total = i, 0
                while j < len(texts) and len(texts[j]) <= GROUP and total < GROUP:
                    total += len(texts[j])
                    j += 1
                ends = np.cumsum([len(t) for t in texts[i:j]])
                found = anchors(np.frombuffer(b"".join(texts[i:j]), np.uint8), ends, length)
                of = np.searchsorted(ends, found, side="right")
                doc.append(i + of)
                at.append(found - (ends[of] - np.array([len(t) for t in texts[i:j]])[of]))
                i = j
            if not doc:
                continue
            doc, at = np.concatenate(doc).astype(np.int64), np.concatenate(at).astype(np.int64)
            lead, context = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
            for n, (d, p) in enumerate(zip(doc.tolist(), at.tolist())):
                t = texts[d]
                a = p - left if p > left else 0
                lead[n] = hash_of(t[p : p + LEAD])
                context[n] = hash_of(t[a : p + length], p - a)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(doc)), pa.array(ths[doc]), pa.array(at), pa.array(np.minimum(sizes[doc] - at, length).astype(np.int32)), pa.array(lead.view(np.int64)), pa.array(context.view(np.int64))],
                ["doc_id", "th", "pos", "right", "lead", "context"],
            )

    return run


# -- suffix buckets -----------------------------------------------------------

def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``words`` (big-endian eight-byte symbols), and the
    bytes each shares with the row before it.

    Multikey quicksort: rows are sorted on one symbol, and only runs that are
    equal so far go on to the next."""
    m, depth = words.shape
    order = np.argsort(words[:, 0], kind="quicksort")
    differ = np.full(m, depth, np.int64)  # symbol in which a row differs from the one before
    if m:
        differ[0] = 0
        differ[1:][words[order[1:], 0] != words[order[:-1], 0]] = 0
    for d in range(1, depth):
        run = np.cumsum(differ < d)
        tied = np.bincount(run)[run] > 1
        at = np.flatnonzero(tied)
        if not len(at):
            break
        rows, runs = order[at], run[at]
        key = words[rows, d]
        by = np.lexsort((key, runs))
        order[at] = rows[by]
        key = key[by]
        change = at[1:][(key[1:] != key[:-1]) & (runs[1:] == runs[:-1])]
        differ[change] = d
    shared = differ * 8
    if m > 1:
        part = np.flatnonzero(differ[1:] < depth) + 1
        x = words[order[part], differ[part]] ^ words[order[part - 1], differ[part]]
        for k in range(1, 8):
            shared[part] += (x >> np.uint64(64 - 8 * k)) == 0
        shared[0] = 0
    return order, shared


def _symbols(rows: np.ndarray) -> np.ndarray:
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return padded.view(">u8").astype(np.uint64)


def repeated_offsets(before: np.ndarray, after: np.ndarray, n_before: np.ndarray, n_after: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest x of every suffix such that the string of
    after.shape[1] bytes that starts x bytes before it occurs again among the
    suffixes (``copies`` of each); -1 if there is none.

    ``before`` holds left contexts reversed, ``after`` right contexts, both
    zero beyond their lengths."""
    m, length = after.shape
    low, high = np.full(m, -1, np.int64), np.full(m, -1, np.int64)
    right, shared_right = multikey_sort(_symbols(after))
    left, shared_left = multikey_sort(_symbols(before))
    class_right, class_left = np.empty(m, np.int64), np.empty(m, np.int64)
    for x in range(before.shape[1] + 1):
        rows = np.flatnonzero((n_before >= x) & (n_after >= length - x))
        if not len(rows):
            continue
        class_right[right] = np.cumsum(shared_right < length - x)
        class_left[left] = np.cumsum(shared_left < x) if x else 0
        key = class_right[rows] * (m + 1) + class_left[rows]
        by = np.argsort(key, kind="quicksort")
        key = key[by]
        edge = np.concatenate(([True], key[1:] != key[:-1]))
        group = np.cumsum(edge) - 1
        again = np.empty(len(rows), bool)
        again[by] = (np.bincount(group, weights=copies[rows[by]]) > 1)[group]
        found = rows[again]
        high[found] = x
        low[found[low[found] < 0]] = x
    return low, high


def _bucket(length: int):
    """(lead, context, n, before, after) -> low, high offsets; a whole bucket at a time."""

    def run(batches):
        t = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if t is None or not t.num_rows:
            return
        before, after = t["before"].to_pylist(), t["after"].to_pylist()
        pad = lambda rows, w: np.frombuffer(b"".join(r.ljust(w, b"\0") for r in rows), np.uint8).reshape(len(rows), w)
        low, high = repeated_offsets(
            pad([x[::-1] for x in before], length - LEAD), pad(after, length),
            np.fromiter(map(len, before), np.int64), np.fromiter(map(len, after), np.int64), t["n"].to_numpy(),
        )
        keep = np.flatnonzero((high >= 0) & (t["n"].to_numpy() == 1))  # classes with copies go in whole
        take = pa.array(keep)
        yield pa.RecordBatch.from_arrays(
            [t["lead"].take(take).combine_chunks(), t["context"].take(take).combine_chunks(), pa.array(low[keep].astype(np.int32)), pa.array(high[keep].astype(np.int32))], ["lead", "context", "low", "high"]
        )

    return run


_CLASS = "lead long, context long, n long, before binary, after binary"
_OFFSETS = "lead long, context long, low int, high int"


def _fetch(length: int):
    """(t, wanted positions) -> context bytes of each."""
    left = length - LEAD

    def run(batches):
        schema = pa.schema([("lead", pa.int64()), ("context", pa.int64()), ("n", pa.int64()), ("before", pa.binary()), ("after", pa.binary())])
        for b in batches:
            rows = []
            for t, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w in wanted:
                    p = w["pos"]
                    rows.append((w["lead"], w["context"], w["n"], t[max(0, p - left) : p], t[p : p + length]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _strings(length: int):
    """Every string around a hot suffix by its 128-bit hash."""

    def run(batches):
        import xxhash

        schema = pa.schema([("w", pa.binary()), ("lead", pa.int64()), ("context", pa.int64()), ("n", pa.int64()), ("x", pa.int32())])
        for b in batches:
            for lead, context, n, before, after in zip(*[b.column(i).to_pylist() for i in range(5)]):
                t, p = before + after, len(before)
                xs = [x for x in range(len(before) + 1) if length - x <= len(after)]
                w = [xxhash.xxh3_128_digest(t[p - x : p - x + length]) for x in xs]
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array([lead] * len(xs), pa.int64()), pa.array([context] * len(xs), pa.int64()), pa.array([n] * len(xs), pa.int64()), pa.array(xs, pa.int32())], schema=schema)

    return run


def _hot_offsets(suffixes: DataFrame, length: int) -> DataFrame:
    strings = written(suffixes.mapInArrow(_strings(length), "w binary, lead long, context long, n long, x int"), "suffix-hot")
    # one string may hold several anchors; with its offset it is counted once
    again = strings.groupBy("w", "x").agg(F.sum("n").alias("k")).where("k > 1").select("w", "x")
    found = strings.where("n = 1").join(again, ["w", "x"]).groupBy("lead", "context").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    return found.select("lead", "context", "low", "high")


# -- documents ----------------------------------------------------------------

def _keyed(docs: DataFrame) -> DataFrame:
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("th"), t.cast("binary").alias("t"))


def _same_doc(a: str, b: str):
    return (F.col(f"{a}.th") == F.col(f"{b}.th")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, th, spans): byte spans (start, end) to remove, not yet merged,
    for every document that has some; th is the hash of its text."""
    if length < LEAD + 8:
        raise ValueError(f"length below {LEAD + 8}")
    found = written(_keyed(docs).where(F.octet_length("t") >= length).mapInArrow(_scan(length), "doc_id long, th long, pos long, right int, lead long, context long"), "suffix-anchors")
    classes = written(
        found.groupBy("lead", "context").agg(F.count("*").alias("n"), F.min(F.struct("th", "pos", "doc_id")).alias("one")), "suffix-classes", release=True
    )
    shared = written(classes.groupBy("lead").agg(F.count("*").alias("k")).where("k > 1"), "suffix-leads")
    wanted = classes.join(shared, "lead").select("one.*", "lead", "context", "n")
    by_doc = written(wanted.groupBy("th", "doc_id").agg(F.collect_list(F.struct("pos", "lead", "context", "n")).alias("wanted")), "suffix-wanted", release=True)
    whole = written(classes.where("n > 1").select("lead", "context"), "suffix-whole")
    drop(classes)
    d, w = _keyed(docs).where(F.octet_length("t") >= length).alias("d"), by_doc.alias("w")
    # repeated rows fetch the same bytes more than once; one of each is kept
    suffixes = written(d.join(w, _same_doc("d", "w")).select("d.t", "w.wanted").mapInArrow(_fetch(length), _CLASS).dropDuplicates(["lead", "context"]), "suffix-contexts", release=True)
    hot = written(shared.where(F.col("k") > HOT).select("lead"), "suffix-hot-leads")
    cold = suffixes.join(hot, "lead", "left_anti")
    # sampled splitters over the leading bytes
    buckets = cold.repartitionByRange(F.substring("after", 1, LEAD)).select("lead", "context", "n", "before", "after")
    offsets = buckets.mapInArrow(_bucket(length), _OFFSETS)
    if not hot.isEmpty():
        offsets = offsets.unionByName(_hot_offsets(suffixes.join(hot, "lead", "left_semi").select("lead", "context", "n", "before", "after"), length))
    partial = written(offsets, "suffix-offsets", release=True)
    drop(suffixes, by_doc)
    # of a class with copies every string is repeated: null offsets stand for all
    marks = partial.unionByName(whole.select("lead", "context", F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high")))
    left = F.least(F.col("pos"), F.lit(length - LEAD))
    start = F.col("pos") - F.coalesce(F.col("high"), left)
    end = F.col("pos") + F.coalesce(F.lit(length) - F.col("low"), F.col("right"))
    spans = found.join(marks, ["lead", "context"]).select("doc_id", "th", F.struct(start.alias("a"), end.alias("b")).alias("span")).where(F.col("span.b") - F.col("span.a") >= length)
    out = written(spans.groupBy("doc_id", "th").agg(F.collect_set("span").alias("spans")), "suffix-spans", release=True)
    drop(found, whole, partial)
    return out


def _cut(keep_text: bool):
    def run(batches):
        for b in batches:
            cols = [[], [], [], [], []]
            for t, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                kept, at, removed, n = [], 0, 0, 0
                merged = []
                for a, z in sorted((s["a"], s["b"]) for s in spans or []):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], z)
                    else:
                        merged.append([a, z])
                for a, z in merged:
                    kept.append(t[at:a])
                    removed, n, at = removed + z - a, n + 1, z
                kept = b"".join(kept) + t[at:]
                for c, v in zip(cols, (len(t), removed, n, hashlib.sha256(kept).hexdigest(), kept if keep_text else None)):
                    c.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, x) for c, x in zip(cols, types)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked,
    the kept bytes (cuts may fall inside a character)."""
    d, s = _keyed(docs).alias("d"), repeated_spans(docs, length).alias("s")
    joined = d.join(s, _same_doc("d", "s"), "left").select("d.doc_id", "d.t", "s.spans")
    return joined.mapInArrow(_cut(keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
