"""Token ids as compressed binary files, and back.

Texts are encoded with the ``tokenizers`` library; each document ends with an
end id.  Documents are range-partitioned and sorted by doc_id, and every
partition writes one file: blocks of the context-mixing range coder
(``range_coder``), then a table of its documents (id, number of ids), then a
footer.  A manifest table, committed by Spark, names the files in order; a
task that ran again leaves an unnamed file behind and nothing else.  Readers
walk a file block by block, so memory is bounded by a block and a document.

Files are per partition: their number follows the partitions, and one
manifest row each is what the running count of ids is taken over.

Defined cases: a null text is empty and holds the end id alone; null doc_ids
come first; rows that share a doc_id follow each other, ordered by a hash of
their text; long texts run over as many blocks as they need; an empty table
has no file and reads back empty.  Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import range_coder, word_cutter
from .common import child, open_fs, written

END_ID = 2
MAGIC = b"TOKIDS01"
_FOOTER = "<QQQ8s"  # offset of the document table, documents, ids, magic
#: Characters encoded at a time.
_CHARACTERS = 1 << 19


class _Encoder:
    """Texts to ids as little-endian unsigned 32-bit integers.

    A byte-level tokenizer encodes the words of its pre-tokenizer one by one.
    For such a tokenizer, texts in common characters are cut into these words
    here (``word_cutter``), and the tokenizer's model is asked for words that
    are new.  All other texts go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.words = word_cutter.Words(self.tokenizer.model.tokenize)
        self.by_word = (
            not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not any(c.isspace() for t in self.added for c in t)
        )

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        held, of, size = [], [], 0

        def flush() -> None:
            nonlocal held, of, size
            ids = self.words.encode(held) if held else []
            for d, x in zip(of, self._ids(held) if ids is None else ids):
                out[d].append(bytes(x.data) if isinstance(x, np.ndarray) else x)
            held, of, size = [], [], 0

        for d, t in enumerate(texts):
            if not self.by_word or not word_cutter.common(t) or any(x in t for x in self.added):
                out[d] += self._ids([t])
                continue
            for p in word_cutter.pieces(t):
                held.append(p)
                of.append(d)
                size += len(p)
                if size >= _CHARACTERS:
                    flush()
        flush()
        return [b"".join(x) for x in out]


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


_MANIFEST = "part int, file string, docs long, ids long, bytes long"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the ids of (doc_id, text) below ``path``; returns the manifest."""

    def run(batches):
        from pyspark import TaskContext

        encoder = _encoder(tokenizer)
        vocabulary = max(encoder.vocabulary, end_id + 1)
        end = np.array([end_id], "<u4").tobytes()
        fs = out = None
        name = f"ids-{uuid.uuid4().hex}.bin"
        held, n_held, n_ids, at = [], 0, 0, len(MAGIC)
        doc_ids, nulls, sizes = [], [], []

        def flush(whole: bool):
            nonlocal held, n_held, at
            flat = np.frombuffer(b"".join(held), "<u4")
            stop = len(flat) if whole else len(flat) // range_coder.BLOCK * range_coder.BLOCK
            for i in range(0, stop, range_coder.BLOCK):
                block = range_coder.encode_block(flat[i : min(i + range_coder.BLOCK, stop)], vocabulary)
                out.write(block)
                at += len(block)
            held, n_held = [flat[stop:].tobytes()], len(flat) - stop

        for b in batches:
            texts = b.column(1).to_pylist()
            for g in range(0, len(texts), 256):
                for doc_id, ids in zip(b.column(0)[g : g + 256].to_pylist(), encoder.encode([t or "" for t in texts[g : g + 256]])):
                    if fs is None:
                        fs, base = open_fs(path)
                        fs.create_dir(base, recursive=True)
                        out = fs.open_output_stream(child(base, name))
                        out.write(MAGIC)
                    held += (ids, end)
                    n = len(ids) // 4 + 1
                    n_held, n_ids = n_held + n, n_ids + n
                    doc_ids.append(doc_id or 0)
                    nulls.append(doc_id is None)
                    sizes.append(n)
                    if n_held >= range_coder.BLOCK:
                        flush(False)
        if fs is None:
            return
        if n_held:
            flush(True)
        table = zlib.compress(np.array(doc_ids, "<i8").tobytes() + np.array(nulls, "u1").tobytes() + np.array(sizes, "<i8").tobytes(), 1)
        out.write(table)
        out.write(struct.pack(_FOOTER, at, len(sizes), n_ids, MAGIC))
        out.close()
        row = {"part": [TaskContext.get().partitionId()], "file": [name], "docs": [len(sizes)], "ids": [n_ids], "bytes": [at + len(table) + struct.calcsize(_FOOTER)]}
        yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())]))

    # the hash parts equal ids, so the range partitioner can also split between them
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return written(ordered.mapInArrow(run, _MANIFEST), "ids-manifest")


def _blocks(f, end: int) -> Iterator[np.ndarray]:
    at = len(MAGIC)
    while at < end:
        f.seek(at)
        head = f.read(range_coder.HEADER.size)
        n = range_coder.block_length(head)
        if at + n > end:
            raise ValueError("cut block")
        yield range_coder.decode_block(head + f.read(n - len(head)))
        at += n


def read_file(f) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of every document of one file, in order."""
    size = f.seek(0, os.SEEK_END)
    if size < len(MAGIC) + struct.calcsize(_FOOTER):
        raise ValueError("not a file of token ids")
    f.seek(size - struct.calcsize(_FOOTER))
    offset, n, n_ids, magic = struct.unpack(_FOOTER, f.read(struct.calcsize(_FOOTER)))
    f.seek(0)
    if magic != MAGIC or f.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a file of token ids")
    f.seek(offset)
    table = zlib.decompress(f.read(size - struct.calcsize(_FOOTER) - offset))
    doc_ids, nulls, sizes = np.frombuffer(table, "<i8", n), np.frombuffer(table, "u1", n, 8 * n), np.frombuffer(table, "<i8", n, 9 * n)
    if sizes.sum() != n_ids:
        raise ValueError("broken document table")
    blocks, held = _blocks(f, offset), np.zeros(0, "<u4")
    for doc_id, null, k in zip(doc_ids.tolist(), nulls.tolist(), sizes.tolist()):
        if len(held) < k:
            parts, have = [held], len(held)
            while have < k:
                parts.append(next(blocks))
                have += len(parts[-1])
            held = np.concatenate(parts)
        yield (None if null else doc_id), held[:k]
        held = held[k:]


def read_ids(manifest: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids before it), n_tokens, ids_crc32 and,
    if asked, the ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    arrow = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches):
        fs, base = open_fs(path)
        for b in batches:
            for name, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows, held = [], 0
                with fs.open_input_file(child(base, name)) as f:
                    for doc_id, ids in read_file(f):
                        rows.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())) + ((ids.astype(np.int32),) if with_ids else ()))
                        at += len(ids)
                        held += len(ids)
                        if len(rows) >= 10_000 or with_ids and held >= 1 << 21:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)

    before = F.sum("ids").over(Window.orderBy("part")) - F.col("ids")  # one row per file
    files = manifest.select("file", before.alias("start"))
    return files.repartition(max(1, manifest.count())).mapInArrow(run, schema)
