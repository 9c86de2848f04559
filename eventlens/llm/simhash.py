"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit set where over half of the document's shingle hashes
have it.  For radius r every bit position i gets a nonzero vector phi(i) of
r + 1 bits, and each nonzero vector v names a table that compares the
positions with <phi(i), v> odd.  Up to r positions span at most r dimensions,
so some v is orthogonal to all of them: every pair within the radius agrees on
the whole mask of at least one table, without exception.

Copies collapse first: tables hold distinct fingerprints.  A bucket with more
than ``BUCKET`` of them is split by covering masks over its free positions,
about half of which each level fixes, which again loses no pair; when few
positions are left a bucket cannot hold more than 2^free fingerprints.  Pairs
inside a bucket are compared bit for bit, and only a spanning forest of the
true links is emitted, so output stays linear in the bucket.

Defined cases: null, empty and wordless texts have fingerprint zero and link
like any other; fewer words than the shingle length make one shingle; long
texts are read whole, in pieces; a null doc_id takes part, and a component
without any id has a null component_id; repeated rows get one row each;
an empty table gives an empty result.  Extra columns are ignored by
``components`` and kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, text_or_empty, written
from .components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Largest bucket compared in one piece; larger ones are split first.
BUCKET = 256
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20
_SPACE = frozenset(b" \t\n\v\f\r")


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; pieces end at white space."""
    if len(text) <= PIECE:
        yield text.split()
        return
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    import xxhash

    digest = xxhash.xxh64_digest
    ones, total, held = np.zeros(64, np.int64), 0, []
    for words in _word_lists((text or b"").lower()):
        words = held + words
        if len(words) >= k:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
            raw = b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())])
            bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
            whole = len(bits) // 255 * 255
            if whole:
                ones += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
            ones += bits[whole:].sum(axis=0, dtype=np.int64)
            total += len(bits)
            held = words[len(words) - k + 1 :]
        else:
            held = words
    if not total:
        if not held:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(held), SEED)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, th, fp): the hash of the text, and the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t, k) for t in b.column(2).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "th", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("th"), F.col("text").cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id long, th long, fp long")


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over ``positions`` such that any two words that differ in at most
    ``radius`` of them agree on at least one mask."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << p for j, p in enumerate(positions) if ((j % n + 1) & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _split(radius: int):
    """(mask, key, fp) -> one row per covering mask of the bucket's free positions."""

    def run(batches):
        for b in batches:
            mask, fp = (np.asarray(b.column(i)).view(np.uint64) for i in (0, 2))
            for m in np.unique(mask).tolist():
                own = fp[mask == m]
                free = [p for p in range(64) if not m >> p & 1]
                finer = sorted({m | x for x in covering_masks(free, radius)})
                for x in finer:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), x, np.uint64).view(np.int64)), pa.array((own & np.uint64(x)).view(np.int64)), pa.array(own.view(np.int64))], ["mask", "key", "fp"]
                    )

    return run


def _forest(radius: int):
    """Lists of fingerprints -> links (u, v) that connect what is within the radius."""

    def run(batches):
        for b in batches:
            us, vs = [], []
            for fps in b.column(0).to_pylist():
                x = np.unique(np.array(fps, np.int64)).view(np.uint64)
                left = np.arange(len(x))
                while len(left) > 1:  # breadth-first: each member is reached once
                    reached = left[:1]
                    left = left[1:]
                    while len(reached) and len(left):
                        near = np.bitwise_count(x[reached][:, None] ^ x[left][None, :]) <= radius
                        hit = near.any(axis=0)
                        us.append(x[left[hit]])
                        vs.append(x[reached[near[:, hit].argmax(axis=0)]])
                        reached, left = left[hit], left[~hit]
            u, v = (np.concatenate(c).view(np.int64) if c else np.zeros(0, np.int64) for c in (us, vs))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def links(nodes: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """(u, v): links between distinct fingerprints at most ``radius`` bits
    apart that connect whatever is connected."""
    masks = covering_masks(list(range(64)), radius)
    table = F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("mask")
    rows = nodes.select("fp", table).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    # free positions halve with each level, down to the radius' 2^(r + 1) - 1
    # or so; a bucket holds at most 2^free fingerprints
    free, found = 64 - min(m.bit_count() for m in masks), None
    while True:
        last = (1 << free) <= BUCKET or _most_free(free, radius) == free  # too few positions to split
        large = None
        if not last:
            large = written(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET).select("mask", "key"), "simhash-large")
            small = rows.join(large, ["mask", "key"], "left_anti")
        else:
            small = rows
        lists = small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")
        edges = written(lists.mapInArrow(_forest(radius), "u long, v long").distinct(), "simhash-links")
        found = edges if found is None else found.unionByName(edges)
        if last or large.isEmpty():
            return found
        rows = written(rows.join(large, ["mask", "key"], "left_semi").mapInArrow(_split(radius), "mask long, key long, fp long").distinct(), "simhash-split")
        free = _most_free(free, radius)


def _most_free(free: int, radius: int) -> int:
    """Free positions that the worst mask over ``free`` positions leaves."""
    return free - min(m.bit_count() for m in covering_masks(list(range(free)), radius))


def _roots(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, id, root) of every distinct fingerprint: its smallest doc_id, and
    the fingerprint that names its component."""
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-nodes")
    roots = connected_components(links(nodes, radius))
    return nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))


def components(docs: DataFrame, k: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed long), component_id (smallest doc_id reachable)."""
    prints = written(fingerprints(docs, k).drop("th"), "simhash-prints")
    named = _roots(prints, radius)
    ids = named.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = named.join(ids, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(fp) -> "F.Column":
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def dedup(docs: DataFrame, k: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """One row of each component: the one with the smallest doc_id (a row
    without id only where no row has one), then the smallest hash of the text."""
    prints = written(fingerprints(docs, k), "simhash-prints")
    by_fp = _roots(prints, radius).select("fp", "root")
    order = F.struct(F.col("doc_id").isNull().alias("bare"), F.col("doc_id").alias("id"), "th")
    kept = prints.join(by_fp, "fp").groupBy("root").agg(F.min(order).alias("x")).select(F.col("x.id").alias("__keep"), F.col("x.th").alias("__th"))
    one = written(kept, "simhash-kept")
    docs, back = aside(docs)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__keep")) & (F.xxhash64(text_or_empty()) == F.col("__th"))
    # rows that share id and text: any of them, chosen by a combining aggregate
    return back(docs.join(one, same).dropDuplicates(["__keep", "__th"]).select(*docs.columns))
