"""Benchmark decontamination by latent semantic retrieval.

Passages are the benchmark's distinct items and every window of words of every
document; words are weighted by their document frequency over all documents.
The words of the items are known each; all other words share ``BUCKETS``
hashed ones, so no document, window or word is left out of what is learned and
what a task holds stays bounded.  One scan cuts the texts and writes the words'
codes, 2 or 4 bytes each, with a task's document counts; the later steps read
these.  The latent space is that of a one-pass randomised eigendecomposition
of the passages' Gram matrix (words x words, never built): tasks multiply each
passage with a random matrix and add up the products by word, Spark adds up the
tasks' sums, and the driver solves the bounded rest (words x rank).  Its rank is
well below the number of passages, so words of the same passages share directions.

Documents are searched as windows of words, half overlapping, in one scan.  A
window's vector is the sum of its words' vectors, and items whose cosine with
it reaches ``min_cosine`` are candidates, also where they share no rare word
with it.  So are those that share one near the window: what the space of low
rank blurs is not lost.  Of both, only those go on that the words around the
window, as many as the item has on either side, allow to pass: rare words are
summed over the words' lists of items, frequent ones by a product of who is
present and who has them, and both together must reach ``min_share`` of the
item's words.  This bound is exact, so it saves checks and no more.  What is
left is checked on these words: the longest common subsequence with the item must cover ``min_share`` of
the item, and the one with its answer (the last sentence, or the last quarter
if that is longer) ``min_answer`` of the answer.  So passages are found that
are reworded, interrupted or cut; frequent words alone are not enough.

The items are a stated query set; those of one text are one item until the
end.  Tasks hold up to about ``block_items`` of them (more are searched in
several scans) with the words' lists and vectors.  Documents stay where they
are: the search has no shuffle.  Words are lower-cased, without marks at their ends.

Edge cases: a null or empty document has no windows; an item without words is
never found; items that repeat are reported each; a null doc_id is reported
as null (and never makes ``clean`` drop other rows of null id); an empty table
on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import text as T
from .names import fresh

MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…–—¿¡"
SLICE = 4 << 20  # bytes of text searched at once
CELLS = 1 << 21  # products of windows and items held at once
OVERSAMPLE = 10
CODES = 1 << 18  # words of texts that one step of the sums by word holds
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS  # hashed words for all that are in no item
_FACTORS = np.random.default_rng(17).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _plain(words: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.utf8_lower(words), MARKS)


def plain_words(text: str | None) -> list[str]:
    """The words of a text as the search sees them."""
    return [w for w in _plain(pa.array((text or "").split(), pa.string())).to_pylist() if w]


def answer_start(text: str | None) -> int:
    """The index of the first plain word of a text's answer."""
    n = len(plain_words(text))
    head = re.split(r"(?<=[.!?])\s+|\n", (text or "").strip())[:-1]
    return min(sum(len(plain_words(h)) for h in head), n - -(-n // 4))


@dataclass
class Space:
    """What a block's search needs: the items' words, all words' weights and latent vectors, and the items."""

    vocabulary: list[str]                  # of the items; hashed words follow
    weights: np.ndarray                    # by word
    vectors: np.ndarray                    # by word: weight x latent direction
    keys: list[str]
    items: list[list[int]]                 # the words of each item
    answers: list[int]                     # where its answer starts


# ------------------------------------------------------------------ the codes

def _buckets(words: pa.Array) -> np.ndarray:
    """The hashed word of each word."""
    data, offs = T.string_buffers(words)
    place = np.arange(len(data)) - np.repeat(offs[:-1], np.diff(offs))
    terms = (data.astype(np.uint64) + np.uint64(1)) * (_FACTORS[place % 64] + (place // 64).astype(np.uint64) * np.uint64(2))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    h = total[offs[1:]] - total[offs[:-1]]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _word_codes(part: pa.Array, own: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, codes)`` of the words of each text: the items' words, then the hashed ones, then "no word"."""
    offs, codes, distinct = T.word_parts(part, marks=False)
    plain = _plain(distinct)
    ids = pc.fill_null(pc.index_in(plain, own), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    other = np.flatnonzero(ids < 0)
    ids[other] = len(own) + _buckets(plain.take(pa.array(other)))
    ids[pc.equal(plain, "").to_numpy(zero_copy_only=False)] = len(own) + BUCKETS
    return offs, ids[codes]


def _code_type(n_own: int) -> str:
    return "<u2" if n_own + BUCKETS < 1 << 16 else "<u4"


def coded(docs: DataFrame, vocabulary: list[str], folder: str) -> DataFrame:
    """doc_id and the codes of each text's words, from a table written to ``folder``; in rows without codes, a task's counts.

    The counts are, by word, in how many documents it occurs, and last the number of documents.
    """
    own, kind = pa.array(vocabulary, pa.string()), _code_type(len(vocabulary))
    width = len(vocabulary) + BUCKETS + 1

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(width, np.int64), 0
        for batch in batches:
            n, at = n + batch.num_rows, 0
            for part in T.slices(T.filled(batch.column(1)), SLICE):
                offs, ids = _word_codes(part, own)
                owner = np.repeat(np.arange(len(part)), np.diff(offs))
                met = np.sort(owner * width + ids)
                met = met[np.flatnonzero(np.diff(met, prepend=-1))]
                total += np.bincount(met % width, minlength=width)
                size = np.dtype(kind).itemsize
                words = pa.BinaryArray.from_buffers(pa.binary(), len(part), [
                    None, pa.py_buffer((offs * size).astype(np.int32)), pa.py_buffer(ids.astype(kind))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), words, pa.nulls(len(part), pa.binary())],
                                                 ["doc_id", "words", "counts"])
                at += len(part)
        if n:
            total[-1] = n
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.binary()),
                                              pa.array([total.tobytes()])], ["doc_id", "words", "counts"])

    schema = "doc_id long, words binary, counts binary"
    docs.select("doc_id", "text").mapInArrow(encode, schema).write.parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


def _codes(part: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, codes)`` of texts, from their codes as bytes."""
    data, offs = T.string_buffers(part)
    return offs // np.dtype(kind).itemsize, np.frombuffer(data.tobytes(), kind).astype(np.int64)


# ------------------------------------------------------------ the latent space

def document_frequency(table: DataFrame, n_words: int) -> tuple[np.ndarray, int]:
    """In how many documents each word occurs, and the number of documents; all rows count."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_words + 1, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                total += np.frombuffer(counts.as_py(), np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["word", "n"])

    rows = table.where("counts is not null").select("counts").mapInArrow(spread, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")).toPandas()
    out = np.zeros(n_words + 1, np.int64)
    out[rows["word"]] = rows["n"]
    return out[:-1], int(out[-1])


def _row_sums(vectors: np.ndarray, row: np.ndarray, place: np.ndarray, ids: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """The sums of the vectors of the words of each row, words at their places; the last vector is 0, that of no word."""
    table = np.full(shape, len(vectors) - 1)
    table[row, place] = ids
    ones, out = np.ones((1, shape[1]), vectors.dtype), np.zeros((shape[0], vectors.shape[1]), vectors.dtype)
    for a in range(0, len(table), 64):  # what fits the cache
        out[a:a + 64] = np.matmul(ones, np.take(vectors, table[a:a + 64], axis=0, mode="clip"))[:, 0]
    return out


def _with_none(vectors: np.ndarray) -> np.ndarray:
    return np.concatenate([vectors, np.zeros((1, vectors.shape[1]), vectors.dtype)])


def _gram_product(offs: np.ndarray, ids: np.ndarray, weights: np.ndarray, omega: np.ndarray, window: int,
                  out: np.ndarray) -> None:
    """Adds the Gram matrix of the texts' windows of ``window`` words, times a matrix, to ``out``.

    ``omega`` is that matrix by word, with the words' weights in it, then the squares of these, and a row of
    zeros; the rows of ``out`` lack their weights.  A window counts as a row of length 1, by the sum of its
    words' squared weights.
    """
    sizes = np.diff(offs)
    n_windows = -(-sizes // window)
    first = np.cumsum(n_windows) - n_windows
    at = np.arange(len(ids)) - np.repeat(offs[:-1], sizes)
    row = np.repeat(first, sizes) + at // window
    y = _row_sums(omega, row, at % window, ids, (int(n_windows.sum()), window))
    y = np.ascontiguousarray((y[:, :-1] / np.maximum(y[:, -1:], 1e-12)).T)
    has = np.flatnonzero(np.append(weights > 0, False)[ids])
    if not len(has):
        return
    ids, row = ids[has], row[has]
    order = np.argsort(ids.astype(np.uint16) if len(weights) < 1 << 16 else ids, kind="stable")
    ids = ids[order]
    cut = np.flatnonzero(np.diff(ids, prepend=-1))
    out[ids[cut]] += np.add.reduceat(np.take(y, row[order], axis=1), cut, axis=1).T


def latent_directions(table: DataFrame, items: list[list[int]], weights: np.ndarray, rank: int, window: int, kind: str,
                      seed: int = 7) -> np.ndarray:
    """The first ``rank`` eigenvectors (words x rank) of the Gram matrix of all windows of ``table`` and of ``items``.

    With G the matrix and R a random one, G is about (G R) (R' G R)^-1 (G R)', which needs one pass (Nystroem).
    """
    width = rank + OVERSAMPLE

    def random_rows() -> np.ndarray:
        return np.random.default_rng(seed).standard_normal((len(weights), width))

    def weighted() -> np.ndarray:
        return _with_none(np.concatenate([weights[:, None] * random_rows(), weights[:, None] ** 2], axis=1))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega, out = weighted().astype(np.float32), np.zeros((len(weights), width))
        for batch in batches:
            for part in T.slices(batch.column(0), CODES * np.dtype(kind).itemsize):
                _gram_product(*_codes(part, kind), weights, omega, window, out)
        at = np.flatnonzero(out.any(1))
        if len(at):
            b = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * width, pa.int32()), pa.array(out[at].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(at), b], ["word", "b"])

    added = F.aggregate(F.collect_list("b"), F.array_repeat(F.lit(0.0), width),
                        lambda total, x: F.zip_with(total, x, lambda p, q: p + q))  # a row per task
    summed = (table.where("words is not null").select("words").mapInArrow(products, "word long, b array<double>")
              .groupBy("word").agg(added.alias("b")).toPandas())
    omega, weighted_rows, total = random_rows(), weighted(), np.zeros((len(weights), width))
    if len(summed):
        total[summed["word"]] = np.array(summed["b"].tolist())
    for item in items:
        _gram_product(np.array([0, len(item)]), np.array(item, np.int64), weights, weighted_rows, max(1, len(item)), total)
    total *= weights[:, None]
    core = omega.T @ total
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > 1e-9 * max(values[-1], 1e-300)
    u, s, _ = np.linalg.svd(total @ vectors[:, keep] / np.sqrt(values[keep]), full_matrices=False)
    return u[:, :rank][:, s[:rank] > 1e-9 * max([*s[:1], 1e-300])]


def build_space(rows: list[tuple[str, str]], docs: DataFrame, folder: str, rank: int = 32, common: float = 0.1,
                window: int = 64) -> tuple[Space, DataFrame | None]:
    """The search space of a block of benchmark items, given as (key, text), and the coded documents.

    ``docs`` has doc_id and text; their codes are written to ``folder``.  A word
    in over ``common`` of all documents has no weight, unless an item has no
    other words.
    """
    words = [plain_words(text) for _, text in rows]
    vocabulary = sorted({w for ws in words for w in ws})
    if not vocabulary:
        return Space([], np.zeros(0), np.zeros((0, 1), np.float32), [k for k, _ in rows], words, [0] * len(rows)), None
    place = {w: i for i, w in enumerate(vocabulary)}
    ids = [[place[w] for w in ws] for ws in words]
    table = coded(docs, vocabulary, folder)
    df, n = document_frequency(table, len(vocabulary) + BUCKETS)
    weights = np.log((n + 1) / (df + 0.5))
    rare = df <= common * n
    for i in ids:
        if i and not rare[i].any():
            rare[i] = True
    weights = np.where(rare, np.maximum(weights, 0.05), 0.0)
    directions = latent_directions(table, ids, weights, rank, window, _code_type(len(vocabulary)))
    return Space(vocabulary, weights, (weights[:, None] * directions).astype(np.float32), [k for k, _ in rows], ids,
                 [answer_start(t) for _, t in rows]), table


# --------------------------------------------------------------------- search

def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def common_subsequence(masks: dict[int, int], n: int, words: list[int]) -> int:
    """The length of the longest common subsequence of ``words`` and the n words of ``masks``, a bit for each."""
    full = row = (1 << n) - 1
    for w in words:
        m = masks.get(w)
        if m is not None:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


class Searcher:
    """Searches documents for the items of a space."""

    def __init__(self, space: Space, window: int, min_cosine: float, min_share: float, min_answer: float):
        self.space, self.half = space, window // 2
        self.min_cosine, self.min_share, self.min_answer = min_cosine, min_share, min_answer
        n_items = len(space.items)
        self.vectors = _with_none(space.vectors)
        self.sizes = np.array([len(i) for i in space.items])
        self.masks = [_masks(i) for i in space.items]
        self.answer_masks = [_masks(i[a:]) for i, a in zip(space.items, space.answers)]
        self.members = [np.unique(np.array(i, np.int64), return_counts=True) for i in space.items]
        self.reach = np.maximum(self.half, self.sizes)  # words looked at on each side of a window
        vectors = [space.vectors[i].sum(0) if i else np.zeros(space.vectors.shape[1]) for i in space.items]
        vectors = np.array(vectors, np.float32).reshape(n_items, -1)
        self.item_vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        # How often each item has each word: a list by rare word, a column by frequent one.
        item = np.repeat(np.arange(n_items), self.sizes)
        word = np.array([w for i in space.items for w in i], np.int64)
        key, n = np.unique(word * n_items + item, return_counts=True)
        word, item = key // n_items, key % n_items
        rare = space.weights[word] > 0
        self.list_items, self.list_counts = item[rare], n[rare]
        self.list_sizes = np.bincount(word[rare], minlength=len(space.vocabulary))
        frequent = np.unique(word[~rare])
        self.column = np.full(len(space.vocabulary), -1)
        self.column[frequent] = np.arange(len(frequent))
        self.frequent = np.zeros((len(frequent), n_items), np.float32)
        self.frequent[self.column[word[~rare]], item[~rare]] = n[~rare]

    def _best(self, item: int, words: np.ndarray, near: np.ndarray) -> tuple[float, float] | None:
        """The best share and answer share of an item around the windows ``near``."""
        reach, n = int(self.reach[item]), int(self.sizes[item])
        lo = np.maximum(near * self.half - reach, 0)
        hi = np.minimum((near + 2) * self.half + reach, len(words))
        first, (member, times) = int(lo[0]), self.members[item]
        part = words[first:int(hi[-1])]
        code = np.minimum(np.searchsorted(member, part), len(member) - 1)
        known = np.flatnonzero(member[code] == part)
        code, known = code[known], known + first
        lo, hi = np.searchsorted(known, lo), np.searchsorted(known, hi)
        best, words = None, words[known]
        for a, b in sorted(set(zip(lo.tolist(), hi.tolist())), key=lambda s: s[0] - s[1]):
            if best == (1.0, 1.0):
                break
            # no subsequence can be longer than the words in common
            common = int(np.minimum(np.bincount(code[a:b], minlength=len(member)), times).sum())
            if common < self.min_share * n or (best and common / n < best[0]):
                continue
            span = words[a:b].tolist()
            share = common_subsequence(self.masks[item], n, span) / n
            if share < self.min_share or (best and share < best[0]):
                continue
            n_answer = n - self.space.answers[item]
            answer = common_subsequence(self.answer_masks[item], n_answer, span) / n_answer
            if answer >= self.min_answer:
                best = max(best or (share, answer), (share, answer))
        return best

    def _candidates(self, word: np.ndarray, block: np.ndarray, place: np.ndarray, lo: np.ndarray, hi: np.ndarray, a: int, b: int):
        """``(window, item, cosine)`` of blocks a to b, which begin windows; words by block and place, and each block's text's ends."""
        space, n_items, n = self.space, len(self.space.items), len(lo)
        width = len(space.vocabulary)
        own = word < width
        met = np.sort(block[own] * width + word[own])
        met = met[np.flatnonzero(np.diff(met, prepend=-1))]  # a word once a block
        row, once = met // width, met % width
        listed = T.ragged_take(self.list_sizes, once)
        cell = np.repeat(row * n_items, self.list_sizes[once]) + self.list_items[listed]
        rare = np.bincount(cell, self.list_counts[listed], n * n_items).reshape(n, n_items)
        rare = np.concatenate([np.zeros((1, n_items)), np.cumsum(rare, 0)])
        column = self.column[once]
        present = np.zeros((n + 1, len(self.frequent)), np.int32)
        present[row[column >= 0] + 1, column[column >= 0]] = 1
        present = np.cumsum(present, 0, dtype=np.int32)
        vec = _with_none(_row_sums(self.vectors, block, place, word, (n, self.half)))
        at = np.arange(a, b)
        own = vec[a:b] + np.where((at + 1 < hi[a:b])[:, None], vec[a + 1:b + 1], 0)
        cosine = own @ self.item_vectors.T / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)
        far = -(-self.reach // self.half)
        for f in np.unique(far[self.sizes > 0]).tolist():
            items = np.flatnonzero((far == f) & (self.sizes > 0))
            first, last = np.maximum(at - f, lo[a:b]), np.minimum(at + f + 2, hi[a:b])
            shared = rare[last][:, items] - rare[first][:, items]
            here = (present[last] > present[first]).astype(np.float32)
            possible = shared + here @ self.frequent[:, items] >= self.min_share * self.sizes[items] - 1e-6
            w, k = np.nonzero(possible & ((shared > 0) | (cosine[:, items] >= self.min_cosine)))
            yield at[w], items[k], cosine[w, items[k]]

    def search(self, offs: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        """(text index, item index, cosine, share, answer share): the best of each text and item, of texts' codes."""
        space, half = self.space, self.half
        n_blocks = -(-np.diff(offs) // half)
        first_block = np.cumsum(n_blocks) - n_blocks
        owner = np.repeat(np.arange(len(offs) - 1), n_blocks)
        known = np.flatnonzero(ids < len(space.weights))
        doc = np.searchsorted(offs, known, side="right") - 1
        block, place, word = first_block[doc] + (known - offs[doc]) // half, (known - offs[doc]) % half, ids[known]
        lo, hi = first_block[owner], first_block[owner] + n_blocks[owner]
        halo = int(-(-self.reach.max() // half)) + 2
        step = max(64, CELLS // max(len(space.items), len(self.frequent)))
        met = []
        for low in range(0, len(owner), step):
            high = min(len(owner), low + step)
            # a text's blocks before and after the step are at hand as far as an item can reach
            a, b = max(0, low - halo), min(len(owner), high + halo)
            p, q = np.searchsorted(block, [a, b])
            for w, k, c in self._candidates(word[p:q], block[p:q] - a, place[p:q], np.maximum(lo[a:b] - a, 0),
                                            np.minimum(hi[a:b] - a, b - a), low - a, high - a):
                met.append((owner[w + a], k, w + a, c))
        if not met:
            return
        doc, item, window, cosine = (np.concatenate(x) for x in zip(*met))
        order = np.lexsort((window, item, doc))
        doc, item, window, cosine = doc[order], item[order], window[order], cosine[order]
        edge = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(doc)]):
            d, k = int(doc[a]), int(item[a])
            best = self._best(k, ids[offs[d]:offs[d + 1]], window[a:b] - first_block[d])
            if best:
                yield d, k, float(cosine[a:b].max()), *best


FOUND = "doc_id long, _item string, cosine double, share double, answer_share double"


def _groups(items: DataFrame, block_items: int) -> Iterator[list[tuple[str, str]]]:
    """(key, text) of the distinct texts of ``items``, in groups of about ``block_items`` by a hash."""
    texts = items.select("_item", F.col("_text").alias("text")).distinct()
    groups = -(-texts.count() // block_items)
    for k in range(groups):
        some = texts.where(F.pmod(F.xxhash64("_item"), F.lit(groups)) == k).orderBy("_item").collect()
        if some:
            yield [(r["_item"], r["text"]) for r in some]


def find_leaks(docs: DataFrame, items: DataFrame, window: int = 64, min_cosine: float = 0.6, min_share: float = 0.6,
               min_answer: float = 0.5, rank: int = 32, block_items: int = 5000, sample: int = 2000, id_col: str = "doc_id",
               text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, cosine, share, answer_share: one row per document and item that is found in it.

    ``sample`` has no effect any more: every window of every document is learned from.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("_text"))
    named = named.withColumn("_item", F.sha2("_text", 256))
    out = docs.sparkSession.createDataFrame([], FOUND)
    folder = scratch_dir(docs.sparkSession, "leaks")
    for k, rows in enumerate(_groups(named, block_items)):
        space, table = build_space(rows, texts, f"{folder}/{k}", rank, window=window)
        if table is None:
            continue

        def search(batches: Iterator[pa.RecordBatch], space=space) -> Iterator[pa.RecordBatch]:
            searcher, kind = Searcher(space, window, min_cosine, min_share, min_answer), _code_type(len(space.vocabulary))
            for batch in batches:
                ids, at = batch.column(0).to_pylist(), 0
                for part in T.slices(batch.column(1), 2 * CODES * np.dtype(kind).itemsize):
                    rows = [(ids[at + d], space.keys[i], c, s, a) for d, i, c, s, a in searcher.search(*_codes(part, kind))]
                    at += len(part)
                    if rows:
                        columns = list(zip(*rows))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                             *[pa.array(c, pa.float64()) for c in columns[2:]]],
                            ["doc_id", "_item", "cosine", "share", "answer_share"])

        out = out.unionByName(table.where("words is not null").select("doc_id", "words").mapInArrow(search, FOUND))
    return (out.join(named.select("_item", "item_id"), "_item")
            .select("doc_id", F.col("item_id").cast("long").alias("item_id"), "cosine", "share", "answer_share"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    name = fresh(docs.columns, "_leaked")
    leaked = find_leaks(docs, items, id_col=id_col, **settings).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(leaked, F.col(id_col) == F.col(name), "left_anti")
