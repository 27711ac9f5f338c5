"""Helpers that the text operators share: bounded slices of an Arrow batch, words, ragged gathers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one pass of a Python operator holds as NumPy arrays (one longer text is still taken whole).
SLICE_BYTES = 16 << 20

#: Code points with the Unicode property White_Space (fixed values).
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0           "
               "     　")


def filled(texts: pa.Array) -> pa.Array:
    """The texts as one plain string array; null reads as the empty text."""
    return pc.fill_null(texts.cast(pa.string()), "")


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``texts`` in runs of whole texts of about ``max_bytes`` bytes, in order."""
    n = len(texts)
    if n == 0:
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a non-null string array; offsets start at 0."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def _byte_set(members: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in members]] = True
    return out


_SPACE = _byte_set("\t\n\x0b\x0c\r ")
_UPPER = _byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_MARK = _byte_set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_ALNUM = _byte_set("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _letters(data: np.ndarray) -> np.ndarray:
    """Where an ASCII letter or digit ends, or a letter from U+00C0 to U+00FF (two of these are signs)."""
    letter = _ALNUM[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    return letter


def word_parts(texts: pa.Array, marks: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(offsets, codes, distinct)``: parts of the words of each text that a word vocabulary encodes on their own.

    Text i has the parts ``distinct[c] for c in codes[offsets[i]:offsets[i + 1]]``.
    A part ends at ASCII white space, which is left out, and where a letter or
    digit is followed by an ASCII mark, since no piece spans that.  A-Z become
    a-z unless a character that might combine with them follows.  A slice
    with ``<|`` is cut at white space only and keeps its case, as special
    tokens need.  Without ``marks`` every word is one part.
    """
    data, offs = string_buffers(texts)
    space = _SPACE[data]
    begins = np.zeros(len(data), bool)
    begins[offs[:-1][offs[1:] > offs[:-1]]] = True
    begins[1:] |= space[:-1]
    if b"<|" not in data.tobytes():
        if marks:
            begins[1:] |= _MARK[data[1:]] & _letters(data)[:-1]
        lower = _UPPER[data]
        lower[:-1] &= data[1:] < 0xCC
        data = np.where(lower, data | 0x20, data)
    keep = ~space
    kept = np.concatenate([[0], np.cumsum(keep)])
    starts = kept[:-1][begins & keep]
    flat = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, kept[-1]).astype(np.int32)),
        pa.py_buffer(data[keep])).dictionary_encode()
    return (np.searchsorted(starts, kept[offs]).astype(np.int64), flat.indices.to_numpy(zero_copy_only=False),
            flat.dictionary)


def space_led_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """``(offsets, codes, distinct)`` like ``words``, for chunks that together are the whole text.

    A chunk begins at an ASCII white-space byte that follows a character which
    is no white space, and at an ASCII mark that follows a letter or digit; a
    slice with ``<|`` is cut at white space only.
    """
    data, offs = string_buffers(texts)
    ascii_ws = _SPACE[data]
    ends_ws = ascii_ws.copy()  # at the last byte of any white-space character
    d, wide = data, np.zeros(len(data), bool)
    wide[1:] = (d[:-1] == 0xC2) & ((d[1:] == 0x85) | (d[1:] == 0xA0))
    a, b, c = d[:-2], d[1:-1], d[2:]
    wide[2:] |= ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) \
        | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) \
        | ((a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
    ends_ws |= wide
    begins = np.zeros(len(data), bool)
    begins[offs[:-1][offs[1:] > offs[:-1]]] = True
    begins[1:] |= ascii_ws[1:] & ~ends_ws[:-1]
    if b"<|" not in data.tobytes():
        begins[1:] |= _MARK[data[1:]] & _letters(data)[:-1]
    starts = np.flatnonzero(begins)
    bounds = np.append(starts, len(data)).astype(np.int32)
    flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
    flat = flat.dictionary_encode()
    return (np.searchsorted(starts, offs).astype(np.int64), flat.indices.to_numpy(zero_copy_only=False),
            flat.dictionary.to_pylist())


def ragged_take(lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Positions, in the concatenation of rows of ``lengths``, of the rows ``codes`` one after another."""
    lengths = np.asarray(lengths, np.int64)
    starts = np.cumsum(lengths) - lengths
    n = lengths[codes]
    shift = np.repeat(starts[codes] - (np.cumsum(n) - n), n)
    return shift + np.arange(len(shift))


def per_text(offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``offsets``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


class EncodedWords:
    """The ids of distinct words, with a bounded memory of words met before in this worker process.

    ``encode`` gives ``(ids, ids per word)`` of a list of words.  The first
    ``limit`` words are remembered, so those that return in later slices cost a
    look-up; all others are encoded again in each slice.  What is returned does
    not depend on what is remembered.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self.known: dict[str, int] = {}
        self.ids, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def rows(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row of each word, ids, ids per row)``; rows are into the last two together."""
        row = np.fromiter((self.known.get(w, -1) for w in distinct), np.int64, len(distinct))
        fresh = np.flatnonzero(row < 0)
        at, n_known = fresh.tolist(), len(self.lengths)
        ids, lengths = self.encode([distinct[i] for i in at])
        row[fresh] = np.arange(n_known, n_known + len(at))
        all_ids, all_lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        keep = min(len(at), self.limit - n_known)
        if keep > 0:
            self.known.update((distinct[i], n_known + k) for k, i in enumerate(at[:keep]))
            self.lengths = all_lengths[:n_known + keep]
            self.ids = all_ids[:int(self.lengths.sum())]
        return row, all_ids, all_lengths
