"""Language identification with hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1; a three-letter gram binds
its letters as rot2(a) * rot1(b) * c, where rot cyclically permutes positions,
so the same letters in another order give an unrelated vector.  A text bundles
(adds) its grams, a language bundles its training texts, each scaled to the
same weight, and a text gets the language whose prototype has the largest
cosine.  Letters are Unicode letters in lower case; every run of other
characters is one boundary letter.

Training is one pass: tasks add up prototypes locally and the sums are added
as integers, so the result does not depend on the order of tasks.  The model
is (languages) x (dimensions) numbers; ``MAX_LANGUAGES`` bounds it.

A short text has few grams and a low cosine even in its own language, so the
least score of a known language is learned by length: texts of 2^c to
2^(c + 1) - 1 characters need ``SHARE`` of the median score of all labelled
training rows of that length.  A median holds while under half of the rows of
a length are junk, and a small share of it keeps clean texts.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
training ignores rows without text or language; with no training rows all are
``und``; ties go to the first language by name; long texts are read whole, in
pieces that end at white space; repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import aside, text_or_empty

DIMENSIONS = 512
MAX_LANGUAGES = 2000
SEED = 20240607
UNKNOWN = "und"
#: Characters handled at a time, documents at a time, cells of a table of
#: counts, and grams whose vectors are held as floats at a time.
PIECE, GROUP, CELLS, GRAMS = 1 << 18, 512, 1 << 20, 4096
_SCALE = float(1 << 24)
#: Share of the median training score that a text of a known language needs.
SHARE = 0.2
_CLASSES, _STEPS = 32, 1000  # length classes; steps of the score, for medians


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prototypes: np.ndarray  # float32, one unit row per language


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1 << 14)
def letter_vector(code_point: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([SEED, code_point]).integers(0, 2, dimensions, dtype=np.int8) * np.int8(2) - np.int8(1)


def _pieces(texts: list[str | None]) -> tuple[list[str], list[int]]:
    out, of = [], []
    for d, t in enumerate(texts):
        at, t = 0, t or ""
        while at < len(t):
            end = at + PIECE
            if end < len(t):
                cut = t.rfind(" ", at + 1, end)
                end = cut if cut > 0 else end
            out.append(t[at:end].lower())
            of.append(d)
            at = end
    return out, of


def _runs(pieces: list[str]):
    """Slices of pieces, about PIECE characters each."""
    start, chars = 0, 0
    for i, p in enumerate(pieces):
        chars += len(p)
        if chars >= PIECE:
            yield slice(start, i + 1)
            start, chars = i + 1, 0
    if start < len(pieces):
        yield slice(start, len(pieces))


def _grams(pieces: list[str], of: list[int], n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text and gram of every place, the grams' code points (grams x 3; 0 is
    the boundary), and letters per text."""
    lengths = np.fromiter((len(p) + 2 for p in pieces), np.int64, len(pieces))
    codes = np.frombuffer("".join(f"\0{p}\0" for p in pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
    codes = np.where(_letters()[codes], codes, 0)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (doc[1:] != doc[:-1])
    codes, doc = codes[keep], doc[keep]
    whole = doc[2:] == doc[:-2]
    doc = np.asarray(of, np.int32)[doc] if pieces else doc
    n_letters = np.bincount(doc[codes != 0], minlength=n_texts)
    if len(codes) < 3:
        return doc[:0], doc[:0], np.zeros((0, 3), np.uint32), n_letters
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen)
    rank = np.zeros(0x110000, np.int32)
    rank[alphabet] = np.arange(len(alphabet))
    c, size = rank[codes].astype(np.int64 if len(alphabet) > 1290 else np.int32), len(alphabet)
    gram = ((c[:-2] * size + c[1:-1]) * size + c[2:])[whole]
    if size**3 <= 1 << 22:
        here = np.zeros(size**3, bool)
        here[gram] = True
        grams = np.flatnonzero(here)
        place = np.zeros(size**3, np.int32)
        place[grams] = np.arange(len(grams))
        at = place[gram]
    else:
        grams, at = np.unique(gram, return_inverse=True)
    letters = alphabet[np.stack([grams // size // size, grams // size % size, grams % size], axis=1)]
    return doc[:-2][whole], at, letters, n_letters


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts (texts x grams, float32), the grams' code points, and letters
    per text, as one table; ``profiles`` does without it."""
    doc, at, letters, n_letters = _grams(*_pieces(texts), len(texts))
    counts = np.bincount(doc.astype(np.int64) * len(letters) + at, minlength=len(texts) * len(letters))
    return counts.reshape(len(texts), len(letters)).astype(np.float32), letters, n_letters


def _bound(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors (+1 and -1, int8) of grams given by code points."""
    used, at = np.unique(letters, return_inverse=True)
    base = np.stack([letter_vector(int(x), dimensions) for x in used]) if len(used) else np.zeros((0, dimensions), np.int8)
    at = at.reshape(letters.shape)
    out = np.roll(base, 2, axis=1)[at[:, 0]]
    out *= np.roll(base, 1, axis=1)[at[:, 1]]
    out *= base[at[:, 2]]
    return out


def gram_vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors as float32."""
    return _bound(letters, dimensions).astype(np.float32)


def _bundle(x: np.ndarray, doc: np.ndarray, at: np.ndarray, letters: np.ndarray) -> None:
    """Adds the vectors of grams ``at`` to the rows ``doc`` (ascending) of x.

    A small set of grams is counted into tables of at most CELLS cells and
    multiplied; a large one, as of thousands of different letters, is counted
    sparsely, and only the vectors of GRAMS pairs exist at a time.
    """
    n, dimensions = len(letters), x.shape[1]
    if n <= 8 * GRAMS:
        vectors, rows = _bound(letters, dimensions), max(1, CELLS // n)
        for low in range(int(doc[0]), int(doc[-1]) + 1, rows):
            high = min(low + rows, int(doc[-1]) + 1)
            here = slice(*np.searchsorted(doc, (low, high)))
            cells = (doc[here] - low).astype(np.int64) * n + at[here]
            counts = np.bincount(cells, minlength=(high - low) * n).reshape(high - low, n).astype(np.float32)
            for g in range(0, n, GRAMS):
                x[low:high] += counts[:, g : g + GRAMS] @ vectors[g : g + GRAMS].astype(np.float32)
        return
    pairs, counts = np.unique(doc.astype(np.int64) * n + at, return_counts=True)
    for p in range(0, len(pairs), GRAMS):
        row, gram = np.divmod(pairs[p : p + GRAMS], n)
        weighted = _bound(letters[gram], dimensions) * counts[p : p + GRAMS, None].astype(np.float32)
        first = np.flatnonzero(np.diff(row, prepend=-1))
        x[row[first]] += np.add.reduceat(weighted, first, axis=0)


def profiles(texts: list[str | None], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Bundled gram vectors (texts x dimensions) and letters per text.  Memory
    is bounded by PIECE, CELLS and GRAMS, whatever the texts and their letters."""
    x, n_letters = np.zeros((len(texts), dimensions)), np.zeros(len(texts), np.int64)
    pieces, of = _pieces(texts)
    for r in _runs(pieces):
        doc, at, letters, n = _grams(pieces[r], of[r], len(texts))
        n_letters += n
        if len(doc):
            _bundle(x, doc, at, letters)
    return x, n_letters


def _groups(texts: list[str | None]):
    """Slices of at most GROUP texts and about PIECE characters."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= 2 * PIECE or i + 1 - start >= GROUP:
            yield slice(start, i + 1)
            start, chars = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def train(docs: DataFrame, dimensions: int = DIMENSIONS) -> Model:
    """Prototypes from all rows of (text, lang) with both present."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for g in _groups(texts):
                x, n = profiles(texts[g], dimensions)
                x /= np.maximum(n, 1)[:, None]
                of = np.array(langs[g])
                for name in sorted(set(langs[g])):
                    sums[name] = sums.get(name, 0) + x[of == name].sum(axis=0)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x for x in names for _ in range(dimensions)], pa.string()),
                pa.array(list(range(dimensions)) * len(names), pa.int32()),
                pa.array(np.rint(np.concatenate([sums[x] for x in names]) * _SCALE).astype(np.int64) if names else np.zeros(0, np.int64)),
            ],
            ["lang", "d", "v"],
        )

    rows = docs.where("text is not null and lang is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    sums = rows.mapInArrow(run, "lang string, d int, v long").groupBy("lang", "d").agg(F.sum("v").alias("v"))
    cells = sums.limit(MAX_LANGUAGES * dimensions + 1).collect()  # the model: languages x dimensions numbers
    languages = tuple(sorted({r.lang for r in cells}))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    prototypes = np.zeros((len(languages), dimensions))
    for r in cells:
        prototypes[languages.index(r.lang), r.d] = r.v
    norm = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return Model(languages, (prototypes / np.where(norm > 0, norm, 1)).astype(np.float32))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The input's columns and __lang, __score, in place of any it has by these
    names; the text alone is looked at."""
    docs = docs.drop("__lang", "__score")
    schema = StructType([*docs.schema.fields, StructField("__lang", StringType()), StructField("__score", DoubleType())])
    kept = docs.columns
    at = kept.index("text")

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            langs, scores = [], []
            for g in _groups(texts):
                x, n = profiles(texts[g], model.prototypes.shape[1])
                best, top = np.zeros(len(n), np.int64), np.zeros(len(n))
                if n.any() and model.languages:
                    cos = (x @ model.prototypes.T) / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                    best = cos.argmax(axis=1)
                    top = np.clip(cos.max(axis=1), 0, 1).astype(float)
                known = (n > 0) & bool(model.languages)
                langs += [model.languages[i] if k else UNKNOWN for i, k in zip(best, known)]
                scores += np.where(known, top, 0.0).tolist()
            cols = [b.column(i) for i in range(b.num_columns)] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, kept + ["__lang", "__score"])

    return docs.mapInArrow(run, schema)


def training_part(docs: DataFrame) -> DataFrame:
    """Documents whose crc32(doc_id) mod 3 is not 1, and ``held_out`` the rest."""
    return docs.where(~held_out())


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _length_class():
    """c where the text has 2^c to 2^(c + 1) - 1 characters."""
    return F.floor(F.log2(F.greatest(F.length(text_or_empty()), F.lit(1)).cast("double"))).cast("int")


def least_scores(docs: DataFrame, model: Model, share: float = SHARE) -> tuple[float, ...]:
    """Per length class, ``share`` of the median score of all rows of (text,
    lang) with both present and a letter in the text.  Only counts by class
    and score step are gathered."""
    rows = docs.where("text is not null and lang is not null").select(F.col("text").cast("string").alias("text"))
    judged = predict(rows, model).where(F.col("__lang") != UNKNOWN)
    step = F.floor(F.col("__score") * _STEPS).cast("int")
    cells = judged.groupBy(_length_class().alias("c"), step.alias("s")).agg(F.count("*").alias("n")).collect()
    counts = np.zeros((_CLASSES, _STEPS + 1), np.int64)
    for r in cells:
        counts[r.c, r.s] = r.n
    out, least = [], 0.0
    for row in counts:
        if row.any():
            least = share * int(np.searchsorted(np.cumsum(row), (row.sum() + 1) // 2)) / _STEPS
        out.append(least)
    return tuple(out)


def reject(docs: DataFrame, model: Model, min_score: float = 0.0, least: tuple[float, ...] = (0.0,) * _CLASSES) -> DataFrame:
    """Documents in a known language; texts without letters go, and texts that
    score below ``min_score`` or below the ``least`` score of their length."""
    docs, back = aside(docs)
    judged = predict(docs, model)
    need = F.greatest(F.lit(min_score), F.get(F.array(*[F.lit(float(x)) for x in least]), _length_class()))
    return back(judged.where((F.col("__lang") != UNKNOWN) & (F.col("__score") >= need)).select(*docs.columns))
