"""BPE encoding and decoding by a pair occurrence index.

All distinct words of a slice of a partition are laid out as one array of
symbols with links to their neighbours.  An index maps each mergeable pair to
all its positions in that array.  Ranks with occurrences wait in a heap; the
lowest is taken, all its live positions are merged at once, and the pairs that
arise with the neighbours enter the index lists of their own ranks.  Work is
per distinct word of the slice and linear in its symbols up to the heap;
nothing is kept between slices.

Edge cases: a null text is the empty text, with no tokens and the empty
decoded text; special tokens inside a text are one id each, as the library's
default; one very long word is merged like any other.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from . import text as T
from .vocab import Merges, byte_letters, load_merges, split_specials, word_pieces


def _ascending(at: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    at = np.sort(at)
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def _take_lowest(index: dict[int, list[np.ndarray]], heap: list[int]) -> tuple[int, np.ndarray]:
    rank = heapq.heappop(heap)
    lists = index.pop(rank)
    return rank, lists[0] if len(lists) == 1 else _ascending(np.concatenate(lists))


def _enter(index: dict[int, list[np.ndarray]], heap: list[int], ranks: np.ndarray, at: np.ndarray) -> None:
    """Add positions ``at`` to the lists of their ``ranks`` (those of -1 are no merges)."""
    known = ranks >= 0
    ranks, at = ranks[known], at[known]
    if not len(ranks):
        return
    order = np.argsort(ranks, kind="stable")
    ranks, at = ranks[order], at[order]
    cuts = np.flatnonzero(np.diff(ranks)) + 1
    for r, positions in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
        if r in index:
            index[r].append(positions)
        else:
            index[r] = [positions]
            heapq.heappush(heap, r)


def _alternate(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of positions of a pair of one symbol twice, those that leftmost merging takes."""
    chained = np.concatenate([[False], following[:-1] == at[1:]])
    start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
    return at[(np.arange(len(at)) - start) % 2 == 0]


def merge_words(symbols: np.ndarray, lengths: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Merge words, given as concatenated symbols; returns ``(ids, ids per word)``."""
    sym = np.asarray(symbols, np.int64).copy()
    n = len(sym)
    lengths = np.asarray(lengths, np.int64)
    word = np.repeat(np.arange(len(lengths)), lengths)
    if n == 0:
        return sym, np.zeros(len(lengths), np.int64)
    ends = np.cumsum(lengths)[lengths > 0] - 1
    begins = ends - lengths[lengths > 0] + 1
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    nxt[ends], prv[begins] = -1, -1
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []
    left = np.flatnonzero(nxt >= 0)
    _enter(index, heap, merges.ranks(sym[left], sym[left + 1]), left)
    while heap:
        rank, at = _take_lowest(index, heap)
        a, b = merges.left[rank], merges.right[rank]
        at = at[sym[at] == a]
        at = at[nxt[at] >= 0]
        at = at[sym[nxt[at]] == b]
        if not len(at):
            continue
        if a == b:
            at = _alternate(at, nxt[at])
        if merges.early[rank]:  # a merge of the new symbol may come first: one position a word, the rest wait
            _, first = np.unique(word[at], return_index=True)
            if len(first) < len(at):
                waits = np.ones(len(at), bool)
                waits[first] = False
                _enter(index, heap, np.full(int(waits.sum()), rank), at[waits])
                at = at[first]
        gone = nxt[at]
        after = nxt[gone]
        sym[at], sym[gone] = merges.merged[rank], -1
        nxt[at] = after
        prv[after[after >= 0]] = at[after >= 0]
        before = prv[at]
        touched = np.concatenate([before[before >= 0], at[after >= 0]])
        if not len(touched):
            continue
        touched = _ascending(touched)
        _enter(index, heap, merges.ranks(sym[touched], sym[nxt[touched]]), touched)
    live = sym >= 0
    return sym[live], np.bincount(word[live], minlength=len(lengths))


@lru_cache(4)
def _first_symbols(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of each byte inside a word and at its end."""
    m = load_merges(path)
    letters = byte_letters()
    return np.array([m.ids[c] for c in letters]), np.array([m.ids[c + m.suffix] for c in letters])


def encode_words(distinct: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, ids per word)`` of white-space separated words."""
    m = load_merges(path)
    known: dict[str, int] = {}
    pieces: list[bytes] = []
    owner, part = [], []  # of each piece or special token of a word: the word, the piece (or ~id)
    for w, word in enumerate(distinct):
        for plain, special in split_specials(word, m.specials):
            if special is not None:
                owner.append(w)
                part.append(~special)
                continue
            for p in word_pieces(path, plain):
                k = known.get(p)
                if k is None:
                    k = known[p] = len(pieces)
                    pieces.append(p.encode())
                owner.append(w)
                part.append(k)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    inside, at_end = _first_symbols(path)
    symbols = inside[data]
    last = np.cumsum(lengths) - 1
    symbols[last] = at_end[data[last]]
    ids, per_piece = merge_words(symbols, lengths, m)
    # rows of the gather: the pieces, then one row per special token
    special_ids = np.array(sorted(set(m.specials.values())), np.int64)
    rows = np.concatenate([ids, special_ids])
    row_len = np.concatenate([per_piece, np.ones(len(special_ids), np.int64)])
    part = np.array(part, np.int64)
    part = np.where(part >= 0, part, len(pieces) + np.searchsorted(special_ids, ~part))
    owner = np.array(owner, np.int64)
    out = rows[T.ragged_take(row_len, part)]
    return out, np.bincount(owner, row_len[part], minlength=len(distinct)).astype(np.int64)


@lru_cache(4)
def _own_words(path: str) -> T.EncodedWords:
    return T.EncodedWords(lambda distinct: encode_words(distinct, path))


def encode_batch(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, ids)`` of the ids of each text."""
    offs, codes, distinct = T.word_parts(texts)
    row, flat, lengths = _own_words(path).rows(distinct.to_pylist())
    codes = row[codes]
    starts = np.concatenate([[0], np.cumsum(T.per_text(offs, lengths[codes]))])
    return starts, flat[T.ragged_take(lengths, codes)]


def decode_ids(ids, path: str) -> str:
    """The text of ids: this vocabulary has no decoder, so its tokens stand as they are, a space between."""
    tokens = load_merges(path).tokens
    return " ".join([tokens[i] for i in ids])


DIGEST = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
DIGEST_DDL = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>"


ENCODE_SLICE = 1 << 20  # bytes of text that are encoded and given out at once


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Each text's id, n_tokens, ids and decoded text, a slice of a batch at a time."""
    for batch in batches:
        at = 0
        for part in T.slices(T.filled(batch.column(1)), ENCODE_SLICE):
            starts, ids = encode_batch(part, path)
            decoded = [decode_ids(ids[a:b].tolist(), path) for a, b in zip(starts[:-1], starts[1:])]
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(part)), pa.array(np.diff(starts), pa.int64()), lists,
                 pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])
            at += len(part)


@lru_cache(4)
def _spellings(path: str) -> tuple[list[str], list[str]]:
    """Each id in decimal, and its token, followed by a space."""
    tokens = load_merges(path).tokens
    return [f"{i} " for i in range(len(tokens))], [f"{t} " for t in tokens]


def _digests(texts: pa.Array, path: str) -> pa.Array:
    decimal, spaced = _spellings(path)
    n_tokens, by_ids, by_text = [], [], []
    for part in T.slices(T.filled(texts)):
        offs, codes, distinct = T.word_parts(part)
        row, flat, lengths = _own_words(path).rows(distinct.to_pylist())
        own_len = lengths[row]
        flat, ends, at = flat[T.ragged_take(lengths, row)].tolist(), np.cumsum(own_len).tolist(), 0
        # decimal ids and tokens of each distinct part, each followed by a space
        spell_ids, spell_text = [], []
        for end in ends:
            own = flat[at:end]
            spell_ids.append("".join([decimal[i] for i in own]))
            spell_text.append("".join([spaced[i] for i in own]))
            at = end
        n_tokens += T.per_text(offs, own_len[codes]).tolist()
        codes, offs = codes.tolist(), offs.tolist()
        for a, b in zip(offs[:-1], offs[1:]):
            own = codes[a:b]
            by_ids.append(hashlib.sha256("".join([spell_ids[c] for c in own])[:-1].encode()).hexdigest())
            by_text.append(hashlib.sha256("".join([spell_text[c] for c in own])[:-1].encode()).hexdigest())
    return pa.StructArray.from_arrays([pa.array(n_tokens, pa.int64()), pa.array(by_ids, pa.string()),
                                       pa.array(by_text, pa.string())], fields=list(DIGEST))


def digests(text: Column, tokenizer_path: str) -> Column:
    """A struct of ``n_tokens`` and the SHA-256 of the ids and of the decoded text."""
    return F.arrow_udf(lambda t: _digests(t, tokenizer_path), DIGEST_DDL)(text)


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids, decoded: one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T_.StructType([rows.schema["doc_id"], *[T_.StructField(n, t) for n, t in (
        ("n_tokens", T_.LongType()), ("ids", T_.ArrayType(T_.IntegerType())), ("decoded", T_.StringType()))]])
    return rows.mapInArrow(lambda batches: _encoded(batches, tokenizer_path), schema)


def digest_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.select("doc_id", digests(F.col("text"), tokenizer_path).alias("e")).select("doc_id", "e.*")
