"""Words cut in arrays against the pre-tokenizer's expression, and their ids
against the tokenizer."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventlens.llm import token_binary, word_cutter

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def some_texts(n=4000, seed=1):
    rng = random.Random(seed)
    chars = "ab é'sdtlmrev 12_-.,\n\r\t  ×÷¡" + "' \n"
    out = ["".join(rng.choice(chars) for _ in range(rng.randrange(50))) for _ in range(n)]
    return out + ["", " ", "\n", "  ", "a", "'", "''s", "x's's", "don't've", "we'll 'tis I'M", "a" * 60 + " b", "-" * 25, " " * 30 + "x", "1" * 40, "é" * 22 + "'re", "x'l", "x'"]


def test_cuts():
    texts = some_texts()
    joined = "\0" + "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-16-le"), np.uint16)
    start = word_cutter.cut(codes).tolist() + [len(codes)]
    got = [joined[a:b] for a, b in zip(start, start[1:])]
    assert got == ["\0"] + [w for t in texts for w in [*WORDS.findall(t), "\0"]]


@pytest.mark.parametrize("most,recent,piece", [(word_cutter.MOST, word_cutter.RECENT, word_cutter.PIECE), (50, 20, 64)])
def test_ids(monkeypatch, most, recent, piece):
    monkeypatch.setattr(word_cutter, "MOST", most)
    monkeypatch.setattr(word_cutter, "RECENT", recent)
    monkeypatch.setattr(word_cutter, "PIECE", piece)
    e, tok = token_binary._Encoder(BPE), Tokenizer.from_file(BPE)
    texts = some_texts(1500, 2) + [" ".join(f"word{i} 'll x{i}y" for i in range(300)), "x" * 200 + " y"]
    for g in range(0, len(texts), 400):
        part = texts[g : g + 400]
        assert e.encode(part) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in part]


def test_equal_hashes_go_to_the_tokenizer(monkeypatch):
    monkeypatch.setattr(word_cutter, "_MIX", np.zeros(3, np.uint64))
    e, tok = token_binary._Encoder(BPE), Tokenizer.from_file(BPE)
    texts = ["one two three", "four"]
    assert e.encode(texts) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_known_words_are_neither_sorted_nor_asked_for(monkeypatch):
    e = token_binary._Encoder(BPE)
    texts = some_texts(300, 3)[:300]
    first = e.encode(texts)

    def refuse(*a, **k):
        raise AssertionError("words of the table")

    monkeypatch.setattr(np, "unique", refuse)
    monkeypatch.setattr(e.words, "tokenize", refuse)
    assert e.encode(texts[::-1]) == first[::-1]


def test_ids_of_long_words_are_bounded(monkeypatch):
    monkeypatch.setattr(word_cutter, "MOST", 50)
    e, tok = token_binary._Encoder(BPE), Tokenizer.from_file(BPE)
    for i in range(60):
        text = " ".join(f"{'q' * 40}{chr(97 + i % 26)}z{'x' * k}" for k in range(20))
        assert e.encode([text]) == [np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert e.words.filled < 2500
