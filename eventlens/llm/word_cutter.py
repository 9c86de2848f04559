"""Words of a byte-level pre-tokenizer and their ids, a batch of texts at a time.

Texts in common characters are laid end to end as code points and cut where a
word of the pre-tokenizer

    's 't 're 've 'm 'll 'd |  ?letters |  ?digits |  ?others | white space

begins.  Words of at most ``LONGEST`` characters are packed into three
integers, which tell them apart exactly.  Their ids come from a hash table in
arrays, kept between batches; the tokenizer's model is asked for the words that
are not in it.  When the table holds over ``MOST`` words, or ids in proportion,
those that no batch asked for again since the last time are dropped, or all if
that is not half of them.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np

#: How byte-level vocabularies spell bytes: printable ones as themselves, the
#: others by the characters from 256 on, in order.
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_SPELLING = {b: 256 + i for i, b in enumerate(_OTHERS)}
#: Anything but printable ASCII, tab, line ends and Latin letters and signs
#: whose classes are beyond doubt; superscripts and fractions are digits to some.
UNCOMMON = re.compile("[^\t\n\r -~¡-±´¶-¸º»¿-ſ]")
_CHARACTERS, _BITS, _PER = 0x180, 9, 7
#: Longest word and most words of the table, and by how many its arrays grow at least.
LONGEST, MOST, RECENT = 3 * _PER, 700_000, 40_000
_SLOTS = 1 << 21
#: Ids the table holds for each of MOST words; long words leave theirs as well.
_IDS = 10
_BREAK, _WHITE, _LETTER, _DIGIT, _SIGN = range(5)
#: How the vocabulary spells the bytes of words; zero stays and parts words.
_SPELT = np.array([0] + [_SPELLING.get(b, b) for b in range(1, 256)], np.uint16)
_CLASS = np.array(
    [_BREAK] + [_WHITE if chr(c).isspace() else _LETTER if re.match(r"[^\W\d_]", chr(c)) else _DIGIT if re.match(r"\d", chr(c)) else _SIGN for c in range(1, _CHARACTERS)], np.uint8
)
_CLASS_LATIN = bytes(_CLASS[:256])
_COMMON_LATIN = bytes(c for c in range(256) if not UNCOMMON.match(chr(c)))
#: The bits of a part's first characters, by their number.
_FIRST = np.array([(1 << _BITS * n) - 1 for n in range(_PER + 1)], np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Characters cut at a time.
PIECE = 1 << 19


def common(text: str) -> bool:
    """Whether the text is in common characters."""
    try:
        return not text.encode("latin-1").translate(None, _COMMON_LATIN)
    except UnicodeEncodeError:
        return not UNCOMMON.search(text)


def _kinds(joined: str, codes: np.ndarray) -> np.ndarray:
    """Classes of common characters; those beyond Latin-1 are looked up apart."""
    kind = np.frombuffer(bytearray(joined.encode("latin-1", "replace").translate(_CLASS_LATIN)), np.uint8)
    if not joined.isascii():
        beyond = np.flatnonzero(codes > 255)
        kind[beyond] = _CLASS[codes[beyond]]
    return kind


def cut(codes: np.ndarray, kind: np.ndarray | None = None) -> np.ndarray:
    """Where words begin in texts of common characters; every text is between
    zeros, and each zero is a word of its own."""
    kind = _CLASS[codes] if kind is None else kind
    white, start = kind == _WHITE, np.ones(len(codes), bool)
    after = np.zeros(len(codes), bool)  # a word follows
    after[:-1] = kind[1:] > _WHITE
    start[1:] = np.where(white[1:], ~white[:-1] | after[1:], (kind[1:] != kind[:-1]) & (codes[:-1] != 32) | (kind[1:] == _BREAK))
    quotes = np.flatnonzero((codes == 39) & start)
    if len(quotes):
        one, two = codes[quotes + 1], codes[np.minimum(quotes + 2, len(codes) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        longer = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        found, size = quotes[short | longer], np.where(short, 2, 3)[short | longer]
        start[found + 1] = False
        start[found + size] = True
    return np.flatnonzero(start)


def _pack(codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The words' first LONGEST characters in three parts."""
    seven = np.zeros(len(codes) + _PER, np.uint64)  # the characters from each place on
    seven[: len(codes)] = codes
    for step in (1, 2, 3):  # two characters, four, seven
        seven[:-step] |= seven[step:] << np.uint64(_BITS * step)
    parts = np.zeros((3, len(start)), np.uint64)
    parts[0] = seven.take(start) & _FIRST.take(np.minimum(length, _PER))
    for k in (1, 2):
        more = np.flatnonzero(length > k * _PER)
        parts[k, more] = seven[start[more] + k * _PER] & _FIRST[np.minimum(length[more] - k * _PER, _PER)]
    return parts


def _hash(parts: np.ndarray) -> np.ndarray:
    key = parts[0] * _MIX[0] + parts[1] * _MIX[1] + parts[2] * _MIX[2]
    key ^= key >> np.uint64(29)
    return key


def _home(key: np.ndarray) -> np.ndarray:
    """Where the table's search for a word begins."""
    return (key & np.uint64(_SLOTS - 1)).astype(np.int64)


class Words:
    """Ids of words, remembered between batches."""

    def __init__(self, tokenize: Callable):
        self.tokenize = tokenize
        self.clear()

    def clear(self) -> None:
        self.slots = np.zeros(_SLOTS, np.int32)  # row of the word whose hash leads here; row 0 is no word
        self.rows = 1
        # three parts, place and number of ids, asked for again
        self.table = [np.full(1, ~np.uint64(0)), *(np.zeros(1, np.uint64) for _ in range(2)), np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros(1, bool)]
        self.pool, self.filled = np.zeros(1 << 16, np.uint32), 0

    def _forget(self) -> None:
        kept = 1 + np.flatnonzero(self.table[5][1 : self.rows])
        if 2 * len(kept) > MOST:
            self.clear()
            return
        parts, place, size = np.stack([a[kept] for a in self.table[:3]]), self.table[3][kept], self.table[4][kept]
        at = np.cumsum(size) - size
        ids = self.pool[np.arange(size.sum()) + np.repeat(place - at, size)]
        self.clear()
        self._hold(ids)
        self._add(parts, _hash(parts), at, size)

    def _hold(self, ids: np.ndarray) -> None:
        need = self.filled + len(ids)
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.filled], np.zeros(max(need, len(self.pool)), np.uint32)])
        self.pool[self.filled : need] = ids
        self.filled = need

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = array("I"), []
        order = sorted(range(len(words)), key=words.__getitem__)  # neighbours share merges
        joined = "\0".join([words[i] for i in order]).encode()
        for w in _SPELT[np.frombuffer(joined, np.uint8)].tobytes().decode("utf-16-le").split("\0"):
            ids = [x.id for x in self.tokenize(w)]
            flat.extend(ids)
            sizes.append(len(ids))
        place, size = np.empty(len(words), np.int32), np.empty(len(words), np.int32)
        size[order] = sizes
        place[order] = self.filled + np.cumsum(sizes) - sizes
        self._hold(np.array(flat, np.uint32))
        return place, size

    def _add(self, parts: np.ndarray, key: np.ndarray, place: np.ndarray, size: np.ndarray) -> None:
        """Adds words that are not in the table."""
        first, self.rows = self.rows, self.rows + len(key)
        if self.rows > len(self.table[0]):
            more = max(self.rows - len(self.table[0]), len(self.table[0]) // 4, RECENT)
            self.table = [np.concatenate([a, np.zeros(more, a.dtype)]) for a in self.table]
        for a, new in zip(self.table, (*parts, place, size, False)):
            a[first : self.rows] = new
        row, at = np.arange(first, self.rows, dtype=np.int32), _home(key)
        while len(row):
            free = self.slots[at] == 0
            self.slots[at[free]] = row[free]
            left = self.slots[at] != row  # another word is there
            row, at = row[left], (at[left] + 1) & (_SLOTS - 1)

    def _find(self, parts: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The words' rows, 0 if they are not in the table."""
        at = _home(key)
        row = self.slots.take(at)
        one, two, three = self.table[:3]
        other = np.flatnonzero((one.take(row) != parts[0]) | (two.take(row) != parts[1]) | (three.take(row) != parts[2]))
        other = other[row[other] > 0]
        at = at[other]
        while len(other):
            at = (at + 1) & (_SLOTS - 1)
            row[other] = here = self.slots[at]
            left = (here > 0) & ((one[here] != parts[0, other]) | (two[here] != parts[1, other]) | (three[here] != parts[2, other]))
            other, at = other[left], at[left]
        return row

    def ids(self, joined: str, codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of all words in order and their number per word; None if two
        words of the batch have one hash."""
        if self.rows > MOST or self.filled > _IDS * MOST:
            self._forget()
        parts = _pack(codes, start, length)
        long, seen = np.flatnonzero(length > LONGEST), {}
        if len(long):  # by their place among the batch's long words; the last bit is no character's
            at = [seen.setdefault(joined[a : a + n], len(seen)) for a, n in zip(start[long].tolist(), length[long].tolist())]
            parts[:, long] = 0
            parts[0, long] = np.array(at, np.uint64) | np.uint64(1 << 63)
        key = _hash(parts)
        row = self._find(parts, key)
        self.table[5][row] = True
        new = np.flatnonzero(row == 0)
        if not len(new):
            return self._spread(self.table[3].take(row), self.table[4].take(row))
        distinct, first, which = np.unique(key[new], return_index=True, return_inverse=True)
        mine = parts[:, new[first]]
        if (parts[:, new] != mine[:, which]).any():
            return None
        words = [joined[a : a + n] for a, n in zip(start[new[first]].tolist(), length[new[first]].tolist())]
        places, sizes = self._learn(words)
        place, size = self.table[3].take(row), self.table[4].take(row)
        place[new], size[new] = places[which], sizes[which]
        keep = mine[0] >> np.uint64(63) == 0
        self._add(mine[:, keep], distinct[keep], places[keep], sizes[keep])
        return self._spread(place, size)

    def _spread(self, place: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.cumsum(number)
        flat = np.arange(total[-1] if len(total) else 0)
        flat += np.repeat(place - total + number, number)
        return self.pool.take(flat), number

    def encode(self, texts: list[str]) -> list[np.ndarray] | None:
        """Ids of texts in common characters."""
        joined = "\0" + "\0".join(texts) + "\0"
        codes = np.frombuffer(joined.encode("utf-16-le"), np.uint16)
        start = cut(codes, _kinds(joined, codes))
        length = np.diff(start, append=len(codes))
        apart = codes[start] == 0
        found = self.ids(joined, codes, start[~apart], length[~apart])
        if found is None:
            return None
        flat, number = found
        # ids before each text's closing zero
        words = np.flatnonzero(apart) - np.arange(apart.sum())
        ends = np.concatenate([[0], np.cumsum(number)])[words]
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def pieces(text: str) -> list[str]:
    """The text in pieces of about PIECE characters, each after the first
    beginning with white space that follows a word: no word lies in two."""
    out, at = [], 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and not (text[end] in " \n" and not text[end - 1].isspace()):
            end += 1
        out.append(text[at:end])
        at = end
    return [*out, text[at:]] if at < len(text) or not out else out
