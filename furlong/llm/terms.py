"""Terms of many texts at once: maximal runs of a set of bytes, only A-Z lower-cased, as codes of distinct terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .text import string_buffers

LETTERS = np.zeros(256, bool)       # ASCII letters and every byte of a character beyond ASCII
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LETTERS_DIGITS = LETTERS.copy()
LETTERS_DIGITS[0x30:0x3A] = True


def term_codes(texts: pa.Array, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(text index, code, distinct terms)`` of every term of non-null ``texts``, in reading order."""
    data, offs = string_buffers(texts)
    keep = inside[data]
    begins, ends = keep.copy(), keep.copy()
    begins[1:] &= ~keep[:-1]
    ends[:-1] &= ~keep[1:]
    full = offs[1:] > offs[:-1]
    begins[offs[:-1][full]] = keep[offs[:-1][full]]
    ends[offs[1:][full] - 1] = keep[offs[1:][full] - 1]
    first = np.flatnonzero(begins)
    bounds = np.concatenate([[0], np.cumsum(np.flatnonzero(ends) + 1 - first)])
    lower = data[keep]
    lower[(lower >= 0x41) & (lower <= 0x5A)] |= 0x20
    flat = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int64)),
                                            pa.py_buffer(lower)).dictionary_encode()
    owner = np.searchsorted(offs, first, side="right") - 1
    return owner, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary
