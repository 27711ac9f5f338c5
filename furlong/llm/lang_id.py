"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent character n-grams (n = 1 to 3) of a
language, most frequent first.  A document is ranked the same way, and its
distance to a profile is the sum over its n-grams of how many places each is
out: the difference of the two ranks, or the profile length where the profile
has no such n-gram.  The nearest language is predicted.

Learning counts the n-grams of every labelled row: tasks count per language
and slice, Spark adds the counts, and a window keeps the first ``size``
n-grams of each language.  Only these profiles reach the driver (languages x
``size`` rows).  Prediction runs on the rows where they are, with the
profiles in the tasks' closure.

Text is lower-cased; every run of characters that are no letters is one word
boundary.  Ties of frequency are ordered by the n-gram's code points, ties of
distance by the language's name.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text when no row can be learned from.  The score is one minus the
distance over the largest possible one, 0 to 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .names import fresh

UNKNOWN = "und"
ORDERS = 3
CODE_BITS = 21  # of a Unicode code point
SLICE = 1 << 20  # bytes of text ranked at once


@lru_cache(1)
def _letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    out = np.zeros(0x110000, bool)
    for first, stop in ((0, 0xD800), (0xE000, 0x110000)):
        out[first:stop] = [chr(c).isalpha() for c in range(first, stop)]
    return out


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points with each non-letter run as one 0, and the index of each one's text; texts begin and end with 0."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    owner = np.concatenate([[0], np.repeat(np.arange(len(lowered)), sizes)])
    letter = _letter_table()[points]
    sym = np.where(letter, points, 0).astype(np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return sym[keep], owner[keep]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text index, n-gram, count)``, by text and n-gram; n-grams pack code points, 0 for none and word ends."""
    sym, owner = _symbols(texts)
    if not len(sym):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    alphabet, code = np.unique(sym, return_inverse=True)
    bits = max(1, int(len(alphabet) - 1).bit_length())
    if ORDERS * (bits + 1) + int(len(texts)).bit_length() > 62:  # a very wide alphabet: fewer texts at once
        if len(texts) > 1:
            half = len(texts) // 2
            a, b = gram_counts(texts[:half]), gram_counts(texts[half:])
            return np.concatenate([a[0], b[0] + half]), np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2]])
    # A text's word end stands after its last letter run; one before its first is added by the shifted views.
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    at = np.cumsum(first) + np.arange(len(code))  # room for a leading word end
    n = int(at[-1]) + 1
    line, own = np.zeros(n, np.int64), np.zeros(n, np.int64)
    end_code = int(np.searchsorted(alphabet, 0))
    line[:] = end_code if end_code < len(alphabet) and alphabet[end_code] == 0 else 0
    line[at], own[at] = code, owner
    lead = at[first] - 1
    own[lead] = owner[first]
    line += 1
    width = bits + 1
    keys = []
    for k in range(1, ORDERS + 1):
        gram = line[:n - k + 1].copy()
        for j in range(1, k):
            gram = (gram << width) | line[j:n - k + 1 + j]
        gram <<= width * (ORDERS - k)
        inside = own[:n - k + 1] == own[k - 1:]
        if k == 1:
            inside &= line != end_code + 1
        keys.append(((own[:n - k + 1] << (width * ORDERS)) | gram)[inside])
    keys = np.sort(np.concatenate(keys))
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    spell = np.concatenate([[0], alphabet])  # code + 1 -> code point; a word end is 1 in the packed n-gram
    spell[end_code + 1] = 1
    mask, packed = (1 << width) - 1, np.zeros(len(keys), np.int64)
    for j in range(ORDERS):
        packed |= spell[(keys >> (width * (ORDERS - 1 - j))) & mask] << (CODE_BITS * (ORDERS - 1 - j))
    return keys >> (width * ORDERS), packed, count


def ranked(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text index, n-gram, rank)`` of the ``size`` most frequent n-grams of each text."""
    owner, gram, count = gram_counts(texts)
    if not len(owner):
        return owner, gram, count
    # within a text by count, the rest of the order is the n-gram's
    order = np.lexsort((gram, -count, owner))
    owner, gram = owner[order], gram[order]
    begin = np.searchsorted(owner, owner, side="left")
    rank = np.arange(len(owner)) - begin
    keep = rank < size
    return owner[keep], gram[keep], rank[keep]


@dataclass
class Profiles:
    """The learned n-gram ranks of each language: ``ranks[l, g]`` of ``grams[g]``, ``size`` where it has none."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        owner, gram, rank = ranked(texts, self.size)
        total = np.bincount(owner, minlength=len(texts))
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        known = self.grams[at] == gram
        distance = np.empty((len(self.languages), len(texts)))
        for lang, ranks in enumerate(self.ranks):
            out_of_place = np.where(known, np.minimum(np.abs(ranks[at] - rank), self.size), self.size)
            out_of_place[known & (ranks[at] == self.size)] = self.size
            distance[lang] = np.bincount(owner, out_of_place, len(texts))
        best = distance.argmin(0)
        for i in np.flatnonzero(total).tolist():
            names[i] = self.languages[best[i]]
            scores[i] = float(1 - distance[best[i], i] / (total[i] * self.size))
        return names, scores


COUNTS = "lang string, gram long, n long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(1).dictionary_encode()
        names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
        at, sums = 0, {}
        for part in T.slices(T.filled(batch.column(0)), SLICE):
            owner, gram, count = gram_counts(part.to_pylist())
            which = lang[at:at + len(part)][owner]
            at += len(part)
            for k in np.unique(which).tolist():
                grams, inverse = np.unique(gram[which == k], return_inverse=True)
                sums.setdefault(k, []).append((grams, np.bincount(inverse, count[which == k])))
        for k, parts in sums.items():
            grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([c for _, c in parts]))
            yield pa.RecordBatch.from_arrays([pa.array([names[k]] * len(grams), pa.string()), pa.array(grams),
                                              pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def learn(labelled: DataFrame, size: int = 400, lang_col: str = "lang", text_col: str = "text") -> Profiles:
    """Profiles from all rows of ``labelled`` whose language and text are not null."""
    rows = (labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where("text is not null and lang is not null"))
    totals = rows.mapInArrow(_counted, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    kept = totals.withColumn("rank", place).where(F.col("rank") < size).select("lang", "gram", "rank").toPandas()
    languages = sorted(set(kept["lang"]))
    grams = np.unique(kept["gram"].to_numpy(np.int64))
    ranks = np.full((len(languages), len(grams)), size, np.int64)
    ranks[np.searchsorted(np.array(languages), kept["lang"].to_numpy(str)),
          np.searchsorted(grams, kept["gram"].to_numpy(np.int64))] = kept["rank"].to_numpy(np.int64)
    return Profiles(languages, grams, ranks, size)


def prediction(text: Column, profiles: Profiles) -> Column:
    """A struct of ``lang_pred`` and ``score`` for each text."""
    def predict(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for part in T.slices(T.filled(texts), SLICE):
            n, s = profiles.predict(part.to_pylist())
            names += n
            scores += s
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                          ["lang_pred", "score"])

    return F.arrow_udf(predict, "struct<lang_pred: string, score: double>")(text)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.select("doc_id", prediction(F.col("text"), profiles).alias("p")).select("doc_id", "p.*")


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row's id puts it into the fold that is not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def accepted(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language, with their own columns only.

    Where no language could be learned, the rows whose text has a letter.
    """
    if not profiles.languages:
        return docs.where(F.regexp(text_col, F.lit(r"\p{L}")))
    name = fresh(docs.columns, "_language")
    named = docs.withColumn(name, prediction(F.col(text_col), profiles))
    return named.where(F.col(name)["lang_pred"] != UNKNOWN).drop(name)
