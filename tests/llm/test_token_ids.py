import zlib

import numpy as np
import public_tokenizers
import pytest

from eventlens.llm import range_coder, token_binary
from eventlens.llm.common import folder

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 129, 5000, 70001])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), np.zeros(n, int), rng.integers(0, 3, n), np.full(n, 50256), np.minimum(rng.zipf(1.2, n), 50256)):
        assert (range_coder.decode_block(range_coder.encode_block(ids, 50257)) == ids).all()


def test_context_mixing_beats_order_0():
    rng = np.random.default_rng(1)
    phrase = rng.integers(0, 5000, (400, 8))
    ids = phrase[rng.integers(0, 400, 8000)].reshape(-1)
    share = np.bincount(ids)[ids] / len(ids)
    assert len(range_coder.encode_block(ids, 50257)) * 8 < 0.6 * -np.log2(share).sum()


def test_blocks_keep_their_bytes():
    """The files of earlier versions can be read, and the model is theirs."""
    i = np.arange(100_003)
    ids = np.where(i % 5 < 3, i * i % 7919 % 50, i * 31 % 50257)
    raw = range_coder.encode_block(ids, 50257)
    assert (len(raw), zlib.crc32(raw)) == (155694, 3557785166)
    assert (range_coder.decode_block(raw) == ids).all()


def test_few_ids_are_searched_for(monkeypatch):
    ids = np.random.default_rng(3).integers(0, 200, 1 << 18)
    raw, search, sought = range_coder.encode_block(ids, 50257), np.searchsorted, []

    def counted(a, v, **k):
        sought.append(np.size(v))
        return search(a, v, **k)

    monkeypatch.setattr(np, "searchsorted", counted)
    assert (range_coder.decode_block(raw) == ids).all()
    assert sum(sought) < len(ids) // 5


def test_broken_blocks_are_found():
    ids = np.random.default_rng(2).integers(0, 50257, 3000)
    raw = bytearray(range_coder.encode_block(ids, 50257))
    for at in (0, range_coder.HEADER.size + 60, len(raw) - 40):
        bad = bytes(raw[:at]) + bytes([raw[at] ^ 0x55]) + bytes(raw[at + 1 :])
        with pytest.raises(ValueError):
            range_coder.decode_block(bad)
    with pytest.raises(ValueError):
        range_coder.decode_block(bytes(raw[:-2]))


def brute(rows):
    """Whole texts with the tokenizer alone, in order of doc_id."""
    import xxhash
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    def tie(t):
        if t is None:
            return 42
        return int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64))
    out, at = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1]))):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_hold_what_the_tokenizer_gives(llm, hard):
    from tests.llm.conftest import same_rows

    rows, df = hard
    path = folder(llm, "t-ids")
    manifest = token_binary.write_ids(df, path, BPE)
    got = token_binary.read_ids(manifest, path, with_ids=True).collect()
    same_rows([r[:4] for r in got], brute(rows))
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)


def test_documents_longer_than_a_block(llm, monkeypatch, tmp_path):
    import io

    blocks = []
    docs = [np.random.default_rng(i).integers(0, 50257, n).astype("<u4") for i, n in enumerate((5, 1300, 1, 700))]
    flat = np.concatenate(docs)
    for i in range(0, len(flat), 512):
        blocks.append(range_coder.encode_block(flat[i : i + 512], 50257))
    import struct

    body = token_binary.MAGIC + b"".join(blocks)
    ids = np.arange(4, dtype="<i8")
    table = zlib.compress(ids.tobytes() + bytes([0, 1, 0, 0]) + np.array([len(d) for d in docs], "<i8").tobytes())
    raw = body + table + struct.pack(token_binary._FOOTER, len(body), 4, len(flat), token_binary.MAGIC)
    got = list(token_binary.read_file(io.BytesIO(raw)))
    assert [g[0] for g in got] == [0, None, 2, 3]
    assert all((g[1] == d).all() for g, d in zip(got, docs))


def test_words_apart_equal_whole_texts():
    import random

    e = token_binary._Encoder(BPE)
    assert e.by_word
    texts = ["", " ", "  two  gaps ", "a\n b", "a\n\n  b\n\nc\n", "don't 12 3.4 'tis we'll I'M x's", "x\u00a0 y", "tab\t z", " lead", "trail ", "<|endoftext|> q <|endoftext|>", "\u0085 a \u001c b"]
    texts += ["é ü 漢字 かな", "x² y³ ½ª º µ", "under_score __ a_b 1_2", "a--b ...c!? d\r\ne", "İstanbul ß ſ ŉ", "".join(map(chr, range(1, 0x250)))]
    rng = random.Random(1)
    chars = "ab é'sdt 12_-.,\n\r\t  ×÷¡"
    texts += ["".join(rng.choice(chars) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += [chr(a) + chr(b) + " " + chr(a) + "x" for a in range(0x20, 0x180) for b in (0x20, 0x27, 0x31, 0x61, 0xE9, 0x0A, 0x5F)]
    whole = [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    got = e.encode(texts)
    assert [t for t, a, b in zip(texts, got, whole) if a != b] == []


def test_nothing(llm, nothing):
    path = folder(llm, "t-none")
    assert token_binary.read_ids(token_binary.write_ids(nothing, path, BPE), path).collect() == []
