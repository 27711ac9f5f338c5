"""Exact token counts at every prefix of a text, by dynamic programming.

Inside one piece of the byte-level vocabulary (pieces are what its pattern
cuts a text into) the encoding of every prefix is found from shorter ones: a
prefix of i bytes ends with token t exactly if t is a suffix of it, and the
last token of the prefix without t may stand before t, that is, the two encode
to themselves side by side.  Exactly one token fits, so one pass fills a table
of last tokens and of counts at every prefix.  A text's table is put together
from those of its pieces; the few places where a prefix is cut differently
from the whole text (white-space runs, contractions, special tokens) are taken
from the tables of what the prefix is cut into.

The table answers truncation and budget questions without encoding again:
``fits`` is one look-up, ``longest_prefix`` a search in the table.

Prefixes are counted in code points.  Edge cases: a null text is the empty
text (0 tokens, not over any limit); a special token inside a text counts as
one, as the library's default; work is linear in a piece's bytes, so one very
long word is no special case.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .vocab import byte_letters, byte_pieces, load_merges, split_specials

#: Entries that a worker process remembers of pieces, pairs and chunks before it starts afresh.
REMEMBERED = 400_000


class PrefixCounter:
    """Prefix tables for one vocabulary file."""

    def __init__(self, path: str):
        merges = load_merges(path)
        letters = {c: b for b, c in enumerate(byte_letters())}
        self.path, self.specials = path, merges.specials
        self.ids = {bytes(letters[c] for c in token): i for token, i in merges.ids.items()
                    if all(c in letters for c in token)}
        self.longest = max(map(len, self.ids))
        self.pair_rank = {(a, b): r for r, (a, b) in enumerate(zip(merges.left.tolist(), merges.right.tolist()))}
        self.merged = merges.merged.tolist()
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.beside: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, list[int]] = {}
        self.chunks: dict[str, int] = {}

    def merge(self, data: bytes) -> list[int]:
        """The tokens of a few bytes, merging the pair of lowest rank again and again."""
        parts = [self.ids[data[i:i + 1]] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.pair_rank.get(p, -1) for p in zip(parts, parts[1:])]
            best = min((r for r in ranks if r >= 0), default=-1)
            if best < 0:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [self.merged[best]]
        return parts

    def may_follow(self, before: int, token: int) -> bool:
        """Whether the bytes of the two tokens encode to just these two."""
        got = self.beside.get((before, token))
        if got is None:
            if len(self.beside) >= REMEMBERED:
                self.beside.clear()
            got = self.merge(self.bytes_of[before] + self.bytes_of[token]) == [before, token]
            self.beside[before, token] = got
        return got

    def piece(self, piece: str):
        """Token counts of the prefixes of one piece, by code points from 0 on."""
        table = self.pieces.get(piece)
        if table is None:
            table, = self.tables([piece])
        return table

    def tables(self, pieces: list[str]) -> list:
        """``piece`` of each; pieces in order share the entries of the prefix they have in common."""
        ids, longest, beside, may_follow = self.ids, self.longest, self.beside, self.may_follow
        data, last, count, out = b"", [-1], [0], []
        for piece in pieces:
            before, data = data, piece.encode()
            same, most = 0, min(len(before), len(data))
            while same < most and before[same] == data[same]:
                same += 1
            del last[same + 1:], count[same + 1:]
            for i in range(same + 1, len(data) + 1):
                for j in range(max(0, i - longest), i):  # the longest suffix first
                    t = ids.get(data[j:i])
                    if t is None:
                        continue
                    ok = j == 0
                    if not ok:
                        ok = beside.get((last[j], t))
                        if ok is None:
                            ok = may_follow(last[j], t)
                    if ok:
                        last.append(t)
                        count.append(count[j] + 1)
                        break
            table = count
            if len(data) != len(piece):  # keep the counts at ends of characters
                ends = [i for i in range(1, len(data)) if data[i] & 0xC0 != 0x80]
                table = [0, *[count[i] for i in ends], count[-1]]
            table = bytes(table) if table[-1] < 200 and max(table) < 256 else list(table)
            out.append(table)
            if len(piece) < 64 and len(self.pieces) < REMEMBERED:
                self.pieces[piece] = table
        return out

    def _plain(self, text: str) -> list[int]:
        """Counts at every prefix of a text without special tokens."""
        out, base, run, run_base = [0], 0, "", 0
        for p in byte_pieces(self.path, text):
            table = self.piece(p)
            if all(c in T.WHITE_SPACE for c in p):
                # a prefix that ends in white space has the run so far as one piece
                run_base = run_base if run else base
                run += p
                out += [run_base + c for c in self.piece(run)[len(run) - len(p) + 1:]]
                base += table[-1]
                continue
            if p in ("'re", "'ve", "'ll"):  # no contraction before its last letter is there
                quote = base + self.piece("'")[-1]
                out += [quote, quote + self.piece(p[1])[-1], base + table[-1]]
            elif p[0] == " ":
                out.append((run_base if run else base) + self.piece(run + " ")[-1])
                out += [base + c for c in table[2:]]
            else:
                out += [base + c for c in table[1:]]
            base += table[-1]
            run = ""
        return out

    def prefixes(self, text: str) -> list[int]:
        """Counts at every prefix of a text, in code points from 0 on."""
        out, open_text = [0], ""
        for part, special in split_specials(text, self.specials):
            if special is None:
                base = out[-1]
                out += [base + c for c in self._plain(part)[1:]]
                open_text = part
            else:
                # until its last character is there it is plain text that goes on from what stands before it
                base = out[-1] - (self._plain(open_text)[-1] if open_text else 0)
                unfinished = self._plain(open_text + part[:-1])[len(open_text) + 1:]
                out += [*[base + c for c in unfinished], out[-1] + 1]
                open_text = ""
        return out

    def total(self, text: str) -> int:
        """The count of the whole text, the last entry of ``prefixes``."""
        return sum(1 if special is not None else sum(self.piece(p)[-1] for p in byte_pieces(self.path, part))
                   for part, special in split_specials(text, self.specials))

    def totals(self, distinct: list[str]) -> np.ndarray:
        """``total`` of each text, remembering what it has met."""
        known, pieces, out = self.chunks, self.pieces, []
        cut = [None if c in known else byte_pieces(self.path, c) if "<|" not in c else () for c in distinct]
        fresh = sorted({p for parts in cut if parts for p in parts if p not in pieces})
        size = dict(zip(fresh, [table[-1] for table in self.tables(fresh)]))
        for chunk, parts in zip(distinct, cut):
            if parts is None:
                n = known[chunk]
            else:
                n = sum(size[p] if p in size else pieces[p][-1] for p in parts) if parts else self.total(chunk)
                if len(known) < REMEMBERED:
                    known[chunk] = n
            out.append(n)
        return np.array(out, np.int64)


@lru_cache(4)
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def longest_prefix(table: np.ndarray, budget: int) -> int:
    """The length in code points of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(np.asarray(table) <= budget)[-1])


def _totals(texts: pa.Array, path: str) -> pa.Array:
    out = []
    for part in T.slices(T.filled(texts)):
        offs, codes, distinct = T.space_led_chunks(part)
        out.append(T.per_text(offs, prefix_counter(path).totals(distinct)[codes]))
    return pa.array(np.concatenate(out) if out else [], pa.int64())


def _tables(texts: pa.Array, path: str) -> pa.Array:
    return pa.array([prefix_counter(path).prefixes(t) for t in T.filled(texts).to_pylist()], pa.list_(pa.int32()))


def _cut(texts: pa.Array, path: str, budget: int) -> pa.Array:
    out = [None if t is None else t[:longest_prefix(prefix_counter(path).prefixes(t), budget)]
           for t in texts.to_pylist()]
    return pa.array(out, pa.string())


def n_tokens(text: Column, tokenizer_path: str) -> Column:
    """The token count of each whole text."""
    return F.arrow_udf(lambda t: _totals(t, tokenizer_path), "bigint")(text)


def prefix_counts(text: Column, tokenizer_path: str) -> Column:
    """An array per text: the exact token count of each of its prefixes, from the empty one on."""
    return F.arrow_udf(lambda t: _tables(t, tokenizer_path), "array<int>")(text)


def truncate(text: Column, tokenizer_path: str, budget: int) -> Column:
    """The longest prefix of each text that has at most ``budget`` tokens; null stays null."""
    return F.arrow_udf(lambda t: _cut(t, tokenizer_path, budget), "string")(text)


def fits(table: Column, length: Column, budget: int) -> Column:
    """Whether the first ``length`` code points of a text with this prefix table have at most ``budget`` tokens."""
    return F.element_at(table, (F.least(length, F.size(table) - 1) + 1).cast("int")) <= budget


def count_documents(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("n_tokens", n_tokens(F.col("text"), tokenizer_path))
    return rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
