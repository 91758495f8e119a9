"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ones and minus ones, drawn from its code point. A letter n-gram is
the product of its letters' vectors, each rotated by its place (binding); a document is the sum of its
n-grams (bundling); a language is the sum of the unit vectors of its documents. A document takes the
language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from starfold.llm.common import drawn, free_name, whole_text

DIMENSIONS = 1024
GRAM = 3
# Labelled documents the prototypes are learned from, about, and of each language at least, where it has them.
TRAINING_ROWS = 40_000
LANGUAGE_ROWS = 200
UNKNOWN = "und"
# Documents whose profile is bundled at once.
TOGETHER = 64


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low[0])
    return table


@lru_cache(maxsize=100_000)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    """The random vector of a letter (0: the gap between words), the same on every machine."""
    return np.random.default_rng([7919, code]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """Bind rows of code points: the product of the letters' vectors, each rotated by its place."""
    codes, index = np.unique(grams, return_inverse=True)
    letters = np.stack([letter_vector(int(c), dimensions) for c in codes])
    index = index.reshape(grams.shape)
    bound = letters[index[:, 0]]
    for place in range(1, grams.shape[1]):
        bound = bound * np.roll(letters, place, axis=1)[index[:, place]]
    return bound


def letter_stream(text: str) -> np.ndarray:
    """The text's lower-case letters, with one 0 around and between words; empty without letters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letters = letter_table()[codes]
    present = letters != 0
    if not present.any():
        return letters[:0]
    keep = present.copy()
    keep[1:] |= present[:-1]
    letters = letters[keep]
    letters = letters if letters[-1] == 0 else np.append(letters, np.uint32(0))
    return np.concatenate([np.zeros(1, np.uint32), letters])


class Profiler:
    """Bundles documents into unit profiles, keeping the n-gram vectors it has bound."""

    def __init__(self, dimensions: int = DIMENSIONS, gram: int = GRAM, remembered: int = 60_000):
        self.dimensions, self.gram, self.remembered = dimensions, gram, remembered
        self.forget()

    def forget(self) -> None:
        self.rows: dict[int, int] = {}
        self.vectors = np.zeros((1024, self.dimensions), np.int8)

    def _gram_keys(self, stream: np.ndarray) -> np.ndarray:
        """One integer of 21 bits a letter for each n-gram."""
        wide = stream.astype(np.int64)
        keys = wide[: len(wide) - self.gram + 1].copy()
        for place in range(1, self.gram):
            keys = (keys << 21) | wide[place : len(wide) - self.gram + 1 + place]
        return keys

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """The rows of the n-grams in the table of bound vectors, new ones added."""
        new = np.array([k for k in keys.tolist() if k not in self.rows], np.int64)
        if len(new):
            need = len(self.rows) + len(new)
            if need > len(self.vectors):
                grown = np.zeros((max(need, 2 * len(self.vectors)), self.dimensions), np.int8)
                grown[: len(self.rows)] = self.vectors[: len(self.rows)]
                self.vectors = grown
            letters = np.stack([(new >> (21 * (self.gram - 1 - p))) & 0x1FFFFF for p in range(self.gram)], axis=1)
            self.vectors[len(self.rows) : need] = gram_vectors(letters, self.dimensions)
            self.rows.update(zip(new.tolist(), range(len(self.rows), need), strict=True))
        return np.array([self.rows[k] for k in keys.tolist()], np.int64)

    def profiles(self, texts: list[str]) -> np.ndarray:
        """One unit vector per text; zeros without an n-gram."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        for at in range(0, len(texts), TOGETHER):
            if len(self.rows) > self.remembered:
                self.forget()
            found = []
            for text in texts[at : at + TOGETHER]:
                stream = letter_stream(text)
                # a word of one letter still makes one n-gram with its gaps
                keys = self._gram_keys(stream) if len(stream) >= self.gram else np.zeros(0, np.int64)
                found.append(np.unique(keys, return_counts=True))
            every = np.unique(np.concatenate([keys for keys, _ in found]))
            if not len(every):
                continue
            counts = np.zeros((len(found), len(every)), np.float32)
            for row, (keys, times) in enumerate(found):
                counts[row, np.searchsorted(every, keys)] = times
            places = self._places(every)
            out[at : at + len(found)] = counts @ self.vectors[places].astype(np.float32)
        norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return out / np.where(norms > 0, norms, 1)


def drawn_shares(counts: dict[str, int], most: int, least: int = LANGUAGE_ROWS) -> dict[str, float]:
    """The share of each language's rows to draw, so that about ``most`` are drawn in all.

    The rest of the bound is divided evenly among the languages that are left, the smallest first; what a small
    one does not use is left to the others. No language has fewer than ``least`` rows drawn of those it has.
    """
    shares, left = {}, float(most)
    for done, (lang, count) in enumerate(sorted(counts.items(), key=lambda item: (item[1], item[0]))):
        part = max(left / (len(counts) - done), float(least))
        shares[lang] = min(1.0, part / count)
        left -= min(part, count)
    return shares


def prototypes(
    labelled: DataFrame, dimensions: int = DIMENSIONS, gram: int = GRAM, training_rows: int = TRAINING_ROWS
) -> dict[str, np.ndarray]:
    """A unit vector per language from ``labelled`` (doc_id, text, lang).

    About ``training_rows`` rows with a language are used at most, or ``LANGUAGE_ROWS`` for each language if that
    is more, drawn by a hash of doc_id and text, so that the same rows are drawn wherever they lie. Languages share
    the bound evenly, and one with fewer rows than its part is used whole. What reaches the driver is a count and
    a vector per language.
    """
    rows = labelled.where("lang is not null").select("doc_id", whole_text().alias("text"), "lang")
    shares = drawn_shares(dict(rows.groupBy("lang").count().collect()), training_rows)
    if any(share < 1 for share in shares.values()):
        share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
        rows = rows.where((share >= 1) | drawn(share, "doc_id", "text"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(dimensions, gram), {}
        for batch in batches:
            profiles = profiler.profiles(batch.column("text").to_pylist())
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs.tolist()):
                sums[lang] = sums.get(lang, 0) + profiles[langs == lang].sum(axis=0, dtype=np.float64)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * dimensions, "at": range(dimensions), "value": vector})

    sums = rows.select("text", "lang").mapInArrow(bundle, "lang string, at long, value double")
    sums = sums.groupBy("lang", "at").agg(F.sum("value").alias("value"))
    vectors: dict[str, np.ndarray] = {}
    for lang, at, value in sums.collect():
        vectors.setdefault(lang, np.zeros(dimensions))[at] = value
    lengths = {lang: np.linalg.norm(vector) for lang, vector in vectors.items()}
    return {lang: vectors[lang] / lengths[lang] for lang in sorted(vectors) if lengths[lang] > 0}


def identify(
    docs: DataFrame, known: dict[str, np.ndarray], gram: int = GRAM, named: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with the language and its score, the cosine with that language's prototype (0 to 1).

    A text that is null or has no letter, and every text if no language is known, gets ``und`` and 0. Ties
    go to the first language by name. Columns of ``docs`` with the names of ``named`` are replaced.
    """
    langs, matrix = list(known), np.array(list(known.values()), np.float32)

    def judge(texts: list[str], profiler: Profiler) -> tuple[list[str], np.ndarray]:
        if not langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        profiles = profiler.profiles(texts)
        cosines = profiles @ matrix.T
        best = cosines.argmax(axis=1)
        some = (profiles != 0).any(axis=1)
        scores = np.where(some, np.clip(cosines[np.arange(len(texts)), best].astype(float), 0, 1), 0.0)
        return [langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), some.tolist(), strict=True)], scores

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler(matrix.shape[-1], gram)
        for batch in batches:
            found, scores = judge([text or "" for text in batch.column("text").to_pylist()], profiler)
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns |= {named[0]: pa.array(found, pa.string()), named[1]: pa.array(scores, pa.float64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    plain = docs.drop(*named)
    added = [StructField(named[0], StringType()), StructField(named[1], DoubleType())]
    return plain.mapInArrow(work, StructType([*plain.schema.fields, *added]))


def held_out(name: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(name).cast("string")) % 4 == 2, F.lit(False))


def language_table(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learned from the rows that are not held out.

    Repeated rows each have their result. A very long text is read whole. An empty table gives an empty result.
    """
    known = prototypes(documents.where(~held_out()))
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, known).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known: not ``und``, and scored ``least`` or more.

    Where no row has a language, none can be learned, and only texts that are null or have no letter are
    rejected. Repeated rows are judged alike and all stay. An empty table stays empty.
    """
    known = prototypes(docs.where(~held_out()))
    if not known:
        return docs.where(whole_text().rlike(r"\p{L}"))
    lang, score = free_name(docs, "found_lang"), free_name(docs, "found_score")
    judged = identify(docs, known, named=(lang, score))
    return judged.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
