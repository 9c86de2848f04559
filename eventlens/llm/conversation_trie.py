"""Prefix trie of conversations with subtree totals by depth bands.

Conversations are rebuilt so that those of one hundred share their first
turns, and every distinct sequence of first d turns is a node.

*Keys.*  A node's key is a polynomial hash of its turns' SHA-256 numbers
modulo 2^61 - 1, to two bases.  Such a hash can be cut and joined, so prefixes
are found by one distributed scan: turns are range-partitioned in
conversation order, each task hashes its pieces, one row per partition (what
the piece at its end adds) is gathered, and pieces are moved by what came
before.  A conversation of any length may lie over any number of tasks.  The
same algebra exchanges the first turns of a rebuilt conversation without
reading its other turns again.

*Totals.*  Depths are cut into bands of fixed height.  A node explodes only to
its ancestors within its band, whose keys stand in the list of one of its
members, a group bounded by the band's height.  Bands are summed from the
deepest up; the completed totals of a band's roots are summed by parent and
enter the band above as values of that parent.  The height is the square root
of the greatest depth, 16 at least: rounds and explosion are both bounded by it.

*Hashes of members.*  Ids are range-partitioned by (node, id), written as
comma-joined pieces, and a node's pieces pass through one hash in order.

Hot nodes: counts, sums and minima are partially aggregated; the parent of a
child is looked up by a broadcast for parents of over ``HOT`` children while
there are few of them, and by a shuffled join otherwise.

Defined cases: turns are ordered by turn, null first, and ties by the SHA-256
of role and text; repeated rows are turns of their own; null role or text is
empty; rows without conv_id belong to no conversation; an empty table gives no
node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import folder, text_or_empty, written

PRIME = (1 << 61) - 1
BASES = (1_145_141_919_810_893_931, 2_071_723_908_114_514_643)
_INVERSE = tuple(pow(b, -1, PRIME) for b in BASES)
SHARED, HUNDRED = 6, 100  # heads have fewer turns than SHARED
MIN_BAND = 16
HOT, MAX_BROADCAST = 10_000, 200_000
#: Characters of a piece of joined ids.
PIECE = 1 << 20
KEY = ["depth", "ka", "kb"]


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = text_or_empty("role"), text_or_empty()
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    number = [F.conv(F.substring("digest", at, 15), 16, 10).cast("long") + 1 for at in (1, 16)]
    return (
        conversations.where("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
        .select("conv_id", "turn", number[0].alias("xa"), number[1].alias("xb"), "chars")
    )


_SCANNED = "part long, conv_id long, pos long, ka long, kb long, xa long, xb long, chars long, head long, last boolean"


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if n in ("last", "ends") else pa.int64()) for c, n in zip(columns, names)], names)


def _scan(turns: DataFrame) -> DataFrame:
    """Every turn with its place and prefix key within its conversation."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("xa"), F.col("xb"), F.col("tie")]
    tied = turns.withColumn("tie", F.monotonically_increasing_id())  # equal rows can be dealt apart
    parts = written(tied.repartitionByRange(*order).withColumn("part", F.spark_partition_id().cast("long")), "trie-turns")
    names = [x.split()[0] for x in _SCANNED.split(", ")]

    def scan(batches):
        part = conv = head = held = None
        pos = a = b = 0
        for batch in batches:
            rows = [c.to_pylist() for c in batch.columns]
            out = []
            for p, c, xa, xb, chars in zip(*rows):
                if p != part:
                    if held:
                        out.append((*held, True))
                    part, head, conv, held = p, c, None, None
                if c != conv:
                    conv, pos, a, b = c, 0, 0, 0
                pos, a, b = pos + 1, (a * BASES[0] + xa) % PRIME, (b * BASES[1] + xb) % PRIME
                if held:
                    out.append((*held, False))
                held = (p, c, pos, a, b, xa, xb, chars, head)
            if out:
                yield _batch(list(zip(*out)), names)
        if held:
            yield _batch([[x] for x in (*held, True)], names)

    dealt = parts.repartition("part").sortWithinPartitions("part", *order).select("part", "conv_id", "xa", "xb", "chars")
    scanned = written(dealt.mapInArrow(scan, _SCANNED), "trie-scan")
    before, carry = {}, None  # one row per partition: the piece at its end
    for r in scanned.where("last").orderBy("part").collect():
        into = carry if carry and carry[0] == r.head else None
        if into:
            before[r.part] = into
        carry = (r.conv_id, *_joined(into[1:], (r.pos, r.ka, r.kb))) if into and r.conv_id == r.head else (r.conv_id, r.pos, r.ka, r.kb)
    if not before:
        return scanned

    def move(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for i, (part, conv, head) in enumerate(zip(columns[0], columns[1], columns[8])):
                if conv == head and part in before:
                    for k, v in zip((2, 3, 4), _joined(before[part][1:], (columns[2][i], columns[3][i], columns[4][i]))):
                        columns[k][i] = v
            yield _batch(columns, names)

    return written(scanned.mapInArrow(move, _SCANNED), "trie-moved")


def _joined(x: tuple, y: tuple) -> tuple:
    """(turns, keys) of x followed by y."""
    return x[0] + y[0], *((u * pow(b, y[0], PRIME) + v) % PRIME for u, v, b in zip(x[1:], y[1:], BASES))


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (c, total) and their rebuilt turns (c, depth, key, parent's
    key, chars, ends)."""
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    heads = turns.where((F.col("conv_id") % HUNDRED == 0) & (F.col("pos") < SHARED)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "ka", "kb", "chars"))).alias("head")  # fewer than SHARED
    )
    own = turns.where(F.col("pos") == share).select("conv_id", F.col("ka").alias("oa"), F.col("kb").alias("ob"))
    zero = F.lit(0).cast("long")
    convs = (
        turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
        .withColumns({"share": share, "base": F.col("conv_id") - F.col("conv_id") % HUNDRED})
        .join(heads, "base", "left").join(own, "conv_id", "left")
        .withColumn("head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, F.col("share").cast("int")))
        .withColumns({"m": F.size("head").cast("long"), "top": F.get("head", F.size("head") - 1)})
        .select("conv_id", "share", "m", "head", F.coalesce("top.ka", zero).alias("ha"), F.coalesce("top.kb", zero).alias("hb"),
                F.coalesce("oa", zero).alias("oa"), F.coalesce("ob", zero).alias("ob"), (F.col("m") + F.greatest(F.col("n") - F.col("share"), zero)).alias("total"))
    )
    convs = written(convs, "trie-conversations")
    names = ["conv_id", *KEY, "pa", "pb", "chars", "ends"]

    def exchange(batches):
        for batch in batches:
            out = []
            for c, pos, ka, kb, xa, xb, chars, n_share, m, ha, hb, oa, ob, total in zip(*[x.to_pylist() for x in batch.columns]):
                k = pos - n_share
                if ha != oa:
                    ka = (ka + (ha - oa) * pow(BASES[0], k, PRIME)) % PRIME
                if hb != ob:
                    kb = (kb + (hb - ob) * pow(BASES[1], k, PRIME)) % PRIME
                out.append((c, m + k, ka, kb, (ka - xa) * _INVERSE[0] % PRIME, (kb - xb) * _INVERSE[1] % PRIME, chars, m + k == total))
            if out:
                yield _batch(list(zip(*out)), names)

    kept = turns.join(convs.drop("head"), "conv_id").where("pos > share").select("conv_id", "pos", "ka", "kb", "xa", "xb", "chars", "share", "m", "ha", "hb", "oa", "ob", "total")
    tails = kept.mapInArrow(exchange, "conv_id long, depth long, ka long, kb long, pa long, pb long, chars long, ends boolean")
    up = F.when(F.col("i") > 0, F.get("head", F.col("i") - 1))
    firsts = convs.select("conv_id", "total", "head", F.posexplode("head").alias("i", "t")).select(
        "conv_id", F.col("t.pos").alias("depth"), F.col("t.ka").alias("ka"), F.col("t.kb").alias("kb"),
        F.coalesce(up["ka"], zero).alias("pa"), F.coalesce(up["kb"], zero).alias("pb"), F.col("t.chars").alias("chars"), (F.col("t.pos") == F.col("total")).alias("ends"),
    )
    return convs.select("conv_id", "total"), written(tails.unionByName(firsts), "trie-rebuilt")


def _member_hashes(ends: DataFrame) -> DataFrame:
    """Per node (depth, ka, kb): hash of its members' decimal ids in order."""
    names = [*KEY, "first", "ids"]

    def join(batches) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, None, [], 0

        def piece():
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*key, first)] + [pa.array([",".join(ids)])], names)

        for batch in batches:
            for d, ka, kb, c in zip(*[x.to_pylist() for x in batch.columns]):
                if (d, ka, kb) != key or size > PIECE:
                    if ids:
                        yield piece()
                    key, first, ids, size = (d, ka, kb), c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def digest(batches):
        key, h = None, None
        for batch in batches:
            out = []
            for d, ka, kb, ids in zip(*[x.to_pylist() for x in batch.columns]):
                if (d, ka, kb) != key:
                    if h:
                        out.append((*key, h.hexdigest()))
                    key, h = (d, ka, kb), hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out)], [*KEY, "sha"])
        if h:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, h.hexdigest())], [*KEY, "sha"])

    order = [*KEY, "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "depth long, ka long, kb long, first long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids").mapInArrow(digest, "depth long, ka long, kb long, sha string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` and the conv_id of each node's parent."""
    side = nodes.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    on = ["depth", "pa", "pb"]
    hot = side.where((F.col("n_children") > HOT) | (F.col("depth") == 1)).drop("n_children")
    if hot.count() > MAX_BROADCAST:
        return nodes.join(side.drop("n_children"), on, "left")
    near = nodes.join(F.broadcast(hot), on)
    cold = side.where((F.col("n_children") <= HOT) & (F.col("depth") != 1)).drop("n_children")
    return near.unionByName(nodes.join(F.broadcast(hot), on, "left_anti").join(cold, on, "left"))


def _subtree_totals(nodes: DataFrame, rebuilt: DataFrame, deepest: int, height: int) -> DataFrame:
    """Per node: n_leaves and saved_tokens over its subtree."""
    spark = nodes.sparkSession
    band = F.floor(F.col("depth") / height).cast("int")
    root = F.array(F.struct(*[F.lit(0).cast("long").alias(x) for x in KEY]))
    lists = rebuilt.groupBy("conv_id", band.alias("band")).agg(F.sort_array(F.collect_list(F.struct(*KEY))).alias("line"))  # height rows at most
    leaf = (F.col("n_children") == 0).cast("long").alias("leaves")
    values = nodes.select(*KEY, "pa", "pb", "conv_id", band.alias("band"), leaf, ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    at = (F.col("depth") - F.col("band") * height).cast("int")
    line = F.when(F.col("band") == 0, F.concat(root, F.slice(F.coalesce("line", F.array().cast(lists.schema["line"].dataType)), 1, at))).otherwise(F.slice("line", 1, at + 1))
    paths = folder(spark, "trie-paths")
    lined = values.join(lists, ["conv_id", "band"], "left").withColumn("line", line).drop("conv_id")
    lined.write.partitionBy("band").parquet(paths)
    paths, totals, entering = spark.read.schema(lined.schema).parquet(paths), folder(spark, "trie-totals"), None
    for b in range(deepest // height, -1, -1):
        rows = paths.where(F.col("band") == b)
        given = rows.select("line", "leaves", "saved")
        if entering is not None:
            given = given.unionByName(rows.select(*KEY, "line").join(entering, KEY).select("line", "leaves", "saved"))
        summed = given.select(F.explode("line").alias("up"), "leaves", "saved").groupBy("up").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
        summed.select("up.*", "n_leaves", "saved_tokens").write.parquet(f"{totals}/band={b}")
        done = spark.read.schema("depth long, ka long, kb long, n_leaves long, saved_tokens long").parquet(f"{totals}/band={b}")
        tops = done.join(rows.where(F.col("depth") == b * height).select(*KEY, "pa", "pb"), KEY)
        entering = tops.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(
            F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
    return spark.read.schema("depth long, ka long, kb long, n_leaves long, saved_tokens long").parquet(totals)


def prefix_trie(conversations: DataFrame, height: int | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    convs, rebuilt = _rebuilt(_scan(_turns(conversations)))
    zero = F.lit(0).cast("long")
    inner = rebuilt.groupBy(*KEY).agg(*[F.min(x).alias(x) for x in ("pa", "pb", "conv_id", "chars")], F.count("*").alias("n_convs"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(*[zero.alias(x) for x in (*KEY, "pa", "pb")], "conv_id", zero.alias("chars"), "n_convs")
    plain = written(inner.unionByName(root), "trie-plain")
    kids = plain.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count("*").alias("n_children"))
    nodes = written(plain.join(kids, KEY, "left").fillna(0, ["n_children"]), "trie-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = _subtree_totals(nodes, rebuilt, deepest, height or max(MIN_BAND, isqrt(deepest)))
    ends = rebuilt.where("ends").select(*KEY, "conv_id").unionByName(convs.where("total = 0").select(*[zero.alias(x) for x in KEY], "conv_id"))
    known = written(_with_parents(nodes), "trie-parents")
    return (
        known.join(totals, KEY).join(_member_hashes(ends), KEY, "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    )
