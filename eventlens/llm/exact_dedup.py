"""Exact de-duplication with Patricia-trie owners.

Texts are equal when they are the same bytes after each run of white space
(space, tab, \\n, \\v, \\f, \\r) became one space.  Three steps:

1. *Combine.*  Every input task inserts its texts into compressed radix
   tries, one per byte length (strings of one length are no prefixes of each
   other).  A terminal node holds the smallest identifier and the number of
   rows.  When the tries of a task exceed ``BUDGET``, the heaviest subtree is
   spilled: its terminals leave the task as partial results and its nodes are
   freed.  Each row gets the number of its terminal.
2. *Own.*  Terminals are partitioned by (length, content hash) and arrive in
   that order, smallest identifier first.  The full byte strings go into
   radix tries again; the first string at a terminal is its owner.  Keys that
   the input has passed are complete, so their subtrees can be spilled, here
   to the output, whenever the budget is reached.
3. *Join.*  Rows get the owner and size of their terminal's group.  Terminals
   belong to one input task, so no join key holds more rows than a task read.

A text copied into a third of all rows leaves each task as one terminal.
Where over ``FAN`` tasks hold one key, its terminals are dealt over salted
partitions first and what remains goes through step 2 again.

Defined cases: a null text is empty; the smallest doc_id stays, a null one
only if the group has no other, and of rows with the same id one stays; texts
are whole, one row at a time; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bytes of trie that a task holds, and what a node costs besides its label.
BUDGET, NODE = 48 << 20, 400
#: Terminals of one (length, hash) that one task takes.
FAN = 64
#: Hot keys sent to every task; more are joined by a shuffle.
MAX_BROADCAST = 200_000
_SHIFT = 33  # number = partition << _SHIFT | place in the partition
_BLANKS = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def normalise(text: bytes | None) -> bytes:
    """Each run of white space as one space."""
    out = (text or b"").translate(_BLANKS)
    while b"  " in out:
        out = out.replace(b"  ", b" ")
    return out


class _Node:
    __slots__ = ("label", "children", "entry", "size")

    def __init__(self, label: bytes):
        self.label, self.children, self.entry, self.size = label, {}, None, 0


def _common(label: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``label`` continue ``key[at:]``; fewer than all."""
    low, high = 0, len(label)
    while high - low > 1:
        mid = (low + high) // 2
        if key.startswith(label[low:mid], at + low):
            low = mid
        else:
            high = mid
    return low


class RadixTrie:
    """Byte strings of one length; each terminal node carries an entry."""

    def __init__(self) -> None:
        self.root = _Node(b"")

    @property
    def size(self) -> int:
        return self.root.size

    def find(self, key: bytes) -> _Node:
        """The terminal node of ``key``, made if there is none."""
        node, at, path = self.root, 0, [self.root]
        cost = 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                cost += NODE + len(key) - at
                at = len(key)
            elif key.startswith(child.label, at):
                at += len(child.label)
            else:
                k = _common(child.label, key, at)
                fork = _Node(child.label[:k])
                child.label = child.label[k:]
                fork.children[child.label[0]] = child
                fork.size = child.size
                node.children[key[at]] = child = fork
                cost += NODE
                at += k
            node = child
            path.append(node)
        for n in path if cost else ():
            n.size += cost
        return node

    def spill(self) -> Iterator[object]:
        """Cuts the heaviest subtree off and yields its entries."""
        path, keys = [self.root], []
        while path[-1].children and (len(path) == 1 or path[-1].size * 2 >= self.root.size):
            key, child = max(path[-1].children.items(), key=lambda x: x[1].size)
            keys.append(key)
            path.append(child)
        while len(path) > 2 and len(path[-2].children) == 1 and path[-2].entry is None:
            path.pop()  # leave no node without a string below it
            keys.pop()
        if len(path) == 1:
            yield from self.drain()
            return
        cut = path.pop()
        del path[-1].children[keys.pop()]
        for n in path:
            n.size -= cut.size
        yield from self._entries(cut)

    def drain(self) -> Iterator[object]:
        yield from self._entries(self.root)
        self.root = _Node(b"")

    @staticmethod
    def _entries(top: _Node) -> Iterator[object]:
        stack = [top]
        while stack:
            node = stack.pop()
            if node.entry is not None:
                yield node.entry
            stack += node.children.values()


class _Rows:
    """Output rows, given out in batches of bounded size."""

    def __init__(self, schema: pa.Schema, most: int = 4 << 20):
        self.schema, self.most, self.rows, self.size = schema, most, [], 0

    def add(self, row: tuple, size: int = 0) -> None:
        self.rows.append(row)
        self.size += 100 + size

    def full(self) -> Iterator[pa.RecordBatch]:
        if self.size >= self.most:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*self.rows), self.schema)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


_COMBINED = "doc_id long, row long, term long, n long, length long, hash long, sha binary, text binary"
_COMBINED_ARROW = pa.schema([(x, pa.int64()) for x in "doc_id row term n length hash".split()] + [("sha", pa.binary()), ("text", pa.binary())])
_OWNED = "term long, rep long, keep_id long, keep_row long, n long, sha binary, length long, hash long, again boolean, text binary"
_OWNED_ARROW = pa.schema([(x, pa.int64()) for x in "term rep keep_id keep_row n".split()] + [("sha", pa.binary()), ("length", pa.int64()), ("hash", pa.int64()), ("again", pa.bool_()), ("text", pa.binary())])


def _combine(docs: DataFrame, budget: int) -> DataFrame:
    """Per row (doc_id, row, term), and per terminal its partial result with
    the text (rows whose ``n`` is set)."""

    def run(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << _SHIFT
        row, terms, tries, held = first, first, {}, 0
        out = _Rows(_COMBINED_ARROW)

        def give(entry):
            term, text, sha, doc_id, at, n = entry
            out.add((doc_id, at, term, n, len(text), int.from_bytes(sha[:8], "big", signed=True), sha, text), len(text))

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                key = normalise(text.as_py())
                trie = tries.get(len(key))
                if trie is None:
                    trie = tries[len(key)] = RadixTrie()
                before = trie.size
                node = trie.find(key)
                held += trie.size - before
                e = node.entry
                if e is None:  # term, text, sha, smallest id and its row, rows
                    e = node.entry = [terms, key, hashlib.sha256(key).digest(), doc_id, row, 1]
                    terms += 1
                    held += len(key)
                else:
                    e[5] += 1
                    if doc_id is not None and (e[3] is None or doc_id < e[3]):
                        e[3], e[4] = doc_id, row
                out.add((doc_id, row, e[0], None, None, None, None, None))
                row += 1
                while held > budget:
                    length, trie = max(tries.items(), key=lambda x: x[1].size)
                    before = trie.size
                    for e in trie.spill():
                        give(e)
                        held -= len(e[1])
                        yield from out.full()
                    held -= before - trie.size
                    if not trie.root.children:
                        del tries[length]
                yield from out.full()
        for length in list(tries):
            for e in tries.pop(length).drain():
                give(e)
                yield from out.full()
        yield from out.rest()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, _COMBINED)


def _own(terms: DataFrame, budget: int) -> DataFrame:
    """Per terminal the first of its equals (``rep``) with their id, row and
    number; the representative of a key that is not finished keeps the text."""

    def run(batches):
        out = _Rows(_OWNED_ARROW)
        deal, trie, last = None, RadixTrie(), None

        def give(entry):
            rep, keep_id, keep_row, sha, text, size, key, again, of, n = entry
            for term in of:
                out.add((term, rep, keep_id, keep_row, n, sha, size, key, again, text if again and term == rep else None), len(text) if again else 0)

        for b in batches:
            columns = [b.column(i) for i in range(b.num_columns)]
            small = [c.to_pylist() for c in columns[:-1]]
            for doc_id, row, term, n, size, salt, key, sha, again, text in zip(*small, columns[-1]):
                if (size, salt) != deal:
                    for e in trie.drain():
                        give(e)
                        yield from out.full()
                    deal = size, salt
                elif key != last:
                    while trie.size > budget:
                        for e in trie.spill():
                            give(e)
                            yield from out.full()
                last = key
                text = text.as_py()
                node = trie.find(text)
                if node.entry is None:
                    node.entry = [term, doc_id, row, sha, text if again else b"", size, key, again, [], 0]
                node.entry[8].append(term)
                node.entry[9] += n
        for e in trie.drain():
            give(e)
            yield from out.full()
        yield from out.rest()

    order = ["length", "salt", "hash", F.col("doc_id").asc_nulls_last(), "row"]
    dealt = terms.repartition("length", "hash", "salt").sortWithinPartitions(*order)
    return dealt.select("doc_id", "row", "term", "n", "length", "salt", "hash", "sha", "again", "text").mapInArrow(run, _OWNED)


def _owners(terms: DataFrame, fan: int, budget: int) -> DataFrame:
    """(term, keep_id, keep_row, n, sha) of every terminal."""
    hot = terms.groupBy("length", "hash").agg(F.count("*").alias("held")).where(F.col("held") > fan)
    hot = written(hot, "exact-hot")
    n_hot = hot.count()
    if not n_hot:
        done = _own(terms.withColumns({"salt": F.lit(0), "again": F.lit(False)}), budget)
        return written(done.select("term", "keep_id", "keep_row", "n", "sha"), "exact-owners")
    keys = F.broadcast(hot) if n_hot <= MAX_BROADCAST else hot
    shares = F.ceil(F.coalesce("held", F.lit(1)) / fan).cast("int")
    dealt = terms.join(keys, ["length", "hash"], "left").withColumns({"again": F.col("held").isNotNull(), "salt": F.pmod(F.xxhash64("term"), shares).cast("int")})
    owned = written(_own(dealt.drop("held"), budget), "exact-salted")
    left = owned.where("again and text is not null")
    left = left.select(F.col("keep_id").alias("doc_id"), F.col("keep_row").alias("row"), F.col("rep").alias("term"), "n", "length", "hash", "sha", "text")
    up = _owners(left, fan, budget).withColumnRenamed("term", "rep")
    through = owned.where("again").select("term", "rep").join(up, "rep").drop("rep")
    return owned.where("not again").select("term", "keep_id", "keep_row", "n", "sha").unionByName(through)


def exact_groups(docs: DataFrame, fan: int = FAN, budget: int = BUDGET) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    combined = written(_combine(docs, budget), "exact-combined")
    owners = _owners(combined.where("n is not null"), fan, budget)
    rows = combined.where("n is null").select("doc_id", "row", "term")
    return rows.join(owners, "term").select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )
