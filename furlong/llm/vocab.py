"""Vocabularies of public BPE tokenizers as the tables that the BPE operators need."""

from __future__ import annotations

import json
import os
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import regex

from .text import WHITE_SPACE


def public_path(name: str) -> str:
    """Where the public tokenizer file ``name`` lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(4)
def library_tokenizer(path: str):
    """The tokenizers library's own object for a vocabulary file, one per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> list[str]:
    """The printable character that byte-level BPE writes for each byte.

    Printable Latin-1 bytes stand for themselves, the others for the
    characters from U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0x100
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


@dataclass
class Merges:
    """The merges of a BPE vocabulary in rank order, and what its parts are."""

    tokens: list[str]          # by id
    ids: dict[str, int]
    left: np.ndarray           # by rank
    right: np.ndarray
    merged: np.ndarray
    early: np.ndarray          # by rank: the merged token takes part in a merge of lower rank
    keys: np.ndarray           # left << 32 | right, ascending
    key_rank: np.ndarray       # rank by position in keys
    specials: dict[str, int]
    suffix: str

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it is none."""
        want = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.key_rank[at], -1)


@lru_cache(4)
def load_merges(path: str) -> Merges:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    ids = dict(model["vocab"])
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *specials.values()]) + 1)
    for t, i in [*ids.items(), *specials.items()]:
        tokens[i] = t
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    left = np.array([ids[a] for a, _ in pairs], np.int64)
    right = np.array([ids[b] for _, b in pairs], np.int64)
    merged = np.array([ids[a + b] for a, b in pairs], np.int64)
    rank = np.arange(len(pairs))
    first_use = np.full(len(tokens), len(pairs))
    np.minimum.at(first_use, left, rank)
    np.minimum.at(first_use, right, rank)
    keys = (left << 32) | right
    order = np.argsort(keys, kind="stable")
    return Merges(tokens, ids, left, right, merged, first_use[merged] < rank, keys[order], rank[order], specials,
                  model.get("end_of_word_suffix") or "")


@lru_cache(4)
def special_pattern(specials: tuple[str, ...]):
    return regex.compile("|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)))


def split_specials(text: str, specials: dict[str, int]) -> list[tuple[str, int | None]]:
    """``text`` as (piece, None) for plain text and (string, id) for the special tokens inside it."""
    if not specials or not any(s in text for s in specials):
        return [(text, None)] if text else []
    out, at = [], 0
    for m in special_pattern(tuple(sorted(specials))).finditer(text):
        if m.start() > at:
            out.append((text[at:m.start()], None))
        out.append((m.group(), specials[m.group()]))
        at = m.end()
    if at < len(text):
        out.append((text[at:], None))
    return out


# Fixed patterns of the two public vocabularies; \s is spelt out as White_Space.
_WS = "".join(f"\\u{ord(c):04x}" for c in WHITE_SPACE)
WORD_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WS}\p{{L}}\p{{N}}]+")
BYTE_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+"
                            rf"|[{_WS}]+(?![^{_WS}])|[{_WS}]+")

#: Below this code point all Unicode versions in use agree on classes and case; texts beyond it are normalised
#: and split by the tokenizers library itself, so that its Unicode tables decide.
SETTLED = "Ԁ"


def byte_pieces(path: str, text: str) -> list[str]:
    """The pieces inside which the byte-level vocabulary merges; together they are ``text``."""
    if text.isascii() or max(text) < SETTLED:
        return BYTE_PIECES.findall(text)
    return [text[a:b] for _, (a, b) in library_tokenizer(path).pre_tokenizer.pre_tokenize_str(text)]


def word_pieces(path: str, text: str) -> list[str]:
    """The normalised pieces inside which the word vocabulary merges; white space is dropped."""
    if text.isascii():
        return WORD_PIECES.findall(text.lower())
    if max(text) < SETTLED:
        # lower-casing by character: no rule looks at a character's neighbours
        return WORD_PIECES.findall("".join(map(str.lower, unicodedata.normalize("NFC", text))))
    lib = library_tokenizer(path)
    norm = lib.normalizer.normalize_str(text)
    return [norm[a:b] for _, (a, b) in lib.pre_tokenizer.pre_tokenize_str(norm)]
