"""Source divergence audit: how the word use of each source departs from its language's and from other sources'.

1. One pass counts in how many documents of a language each term occurs; terms in at least ``min_docs`` are kept.
2. The kept terms are dealt into ranges of (language, term), of a size that
   does not depend on the cluster.  Each range is
   built, from its sorted terms, into a minimal acyclic transducer: equal
   endings share states, and the sum of the numbers on a term's edges is its
   lexicographic ordinal.  Its arrays are one row of a table.
3. A second pass streams every text: the terms of a slice go to the range that
   may hold them, packed, and are walked through its transducer, all of a
   slice together, one byte a step.  Terms that end in a final state are counted by
   source and ordinal.  A range's terms are dealt over several tasks, each of
   which gets the range's transducer.
4. Per range, a task lays out the counts of a language's sources and sums
   the divergences of each pair of them; terms that stand out are ranked with
   their ordinals deciding ties, and spelt by walking the transducer backwards.

All numbers are exact 64-bit integers.  A source with a share of all rows is
counted in slices, before the shuffle; no task holds more than a range of the vocabulary.

Edge cases: null text, lang and source read as ''; a language without kept
terms has value 0 for every pair and no term rows; an empty table gives no
rows; repeated rows count as documents; other columns are left out.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .terms import LETTERS, term_codes

SCALE = 1_000_000_000
PREFIX = 64          # bytes of a term by which ranges are cut
CELLS = 1 << 20      # counts laid out at once
SLICE = 8 << 20      # bytes of text whose terms are counted at once
GAP = b" "           # between the terms of a packed list; no term has it


# ---------------------------------------------------------------- the transducer

@dataclass
class Transducer:
    """Edges sorted by (state, byte), with the words that come before each; word counts and final states by state."""

    keys: np.ndarray      # state << 8 | byte
    target: np.ndarray
    skip: np.ndarray      # words of the state that precede the edge's
    final: np.ndarray
    root: int

    @classmethod
    def build(cls, terms: Sequence[bytes]) -> Transducer:
        """From distinct terms in ascending order."""
        register: dict[tuple, int] = {}
        final: list[bool] = []
        words: list[int] = []
        keys, target, skip = [], [], []

        def freeze(node) -> int:
            name = (node[0], tuple(node[1]))
            state = register.get(name)
            if state is None:
                state = register[name] = len(final)
                final.append(node[0])
                before = int(node[0])
                for byte, child in node[1]:
                    keys.append(state << 8 | byte)
                    target.append(child)
                    skip.append(before)
                    before += words[child]
                words.append(before)
            return state

        path = [[False, []]]  # the states of the last term: [final, edges to finished states]
        last = b""

        def fold(depth):
            while len(path) - 1 > depth:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], freeze(node)))

        for term in terms:
            shared = 0
            for a, b in zip(last, term):
                if a != b:
                    break
                shared += 1
            fold(shared)
            path.extend([False, []] for _ in range(len(term) - shared))
            path[-1][0] = True
            last = term
        fold(0)
        root = freeze(path[0])
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        return cls(np.array(keys, np.int64)[order], np.array(target, np.int64)[order],
                   np.array(skip, np.int64)[order], np.array(final, bool), root)

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.keys), len(self.final), self.root], np.int64)
        return b"".join(x.tobytes() for x in (sizes, self.keys, self.target, self.skip, self.final))

    @classmethod
    def from_bytes(cls, blob: bytes) -> Transducer:
        n, states, root = np.frombuffer(blob, np.int64, 3).tolist()
        a = np.frombuffer(blob, np.int64, 3 * n, 24)
        return cls(a[:n], a[n:2 * n], a[2 * n:], np.frombuffer(blob, bool, states, 24 + 24 * n), root)

    def ordinals(self, data: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The ordinal of each term ``data[at[i]:stop[i]]``, -1 where it is none; a byte of all terms a step."""
        out = np.full(len(at), -1, np.int64)
        at = at.copy()
        live = np.arange(len(at))
        state, number = np.full(len(at), self.root), np.zeros(len(at), np.int64)
        while len(live):
            ended = at[live] == stop[live]
            done = live[ended]
            out[done] = np.where(self.final[state[done]], number[done], -1)
            live = live[~ended]
            if not len(live) or not len(self.keys):
                break
            want = state[live] << 8 | data[at[live]]
            edge = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[edge] == want
            live, edge = live[hit], edge[hit]
            number[live] += self.skip[edge]
            state[live] = self.target[edge]
            at[live] += 1
        return out

    def spell(self, ordinal: int) -> bytes:
        out, state = bytearray(), self.root
        while True:
            if self.final[state] and ordinal == 0:
                return bytes(out)
            low, high = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            edge = low + int(np.searchsorted(self.skip[low:high], ordinal, side="right")) - 1
            ordinal -= int(self.skip[edge])
            out.append(int(self.keys[edge]) & 0xFF)
            state = int(self.target[edge])


# ---------------------------------------------------------------- counting in slices

def _string(column: pa.Array) -> pa.Array:
    return T.filled(column)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, term, documents of a slice that hold the term."""
    for batch in batches:
        langs, at = _string(batch.column(0)), 0
        for part in T.slices(_string(batch.column(1)), SLICE):
            own = langs.slice(at, len(part)).dictionary_encode()
            at += len(part)
            doc, code, terms = term_codes(part, LETTERS)
            n = max(1, len(terms))
            seen = np.unique(doc * n + code)
            lang = own.indices.to_numpy(zero_copy_only=False).astype(np.int64)[seen // n]
            key, count = np.unique(lang * n + seen % n, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [own.dictionary.take(pa.array(key // n)), terms.take(pa.array(key % n)).cast(pa.string()), pa.array(count)],
                ["lang", "term", "n"])


def kept_terms(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """lang, term of the terms that occur in at least ``min_docs`` documents of the language."""
    counted = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, n bigint")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a language and range: block, lang, first prefix, number of terms, transducer; terms come sorted."""
    lang, block, terms = None, None, []

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([lang]), pa.array([terms[0][:PREFIX]], pa.binary()),
             pa.array([len(terms)], pa.int64()), pa.array([Transducer.build(terms).to_bytes()], pa.binary())],
            ["block", "lang", "first", "n_terms", "fst"])

    for batch in batches:
        columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist())
        for b, l, t in zip(*columns):
            if (l, b) != (lang, block):
                if terms:
                    yield row()
                lang, block, terms = l, b, []
            terms.append(t)
    if terms:
        yield row()


def _range_bounds(kept: DataFrame, total: int, n: int) -> list[tuple[bytes, bytes]]:
    """Language and prefix at which the second to the n-th range begin, from about 20 terms a range chosen by hash."""
    some = kept.where(F.pmod(F.xxhash64("lang", "term"), F.lit(max(1, total // (20 * n)))) == 0)
    prefix = F.substring(F.col("term").cast("binary"), 1, PREFIX).alias("first")
    keys = sorted((r["lang"].encode(), bytes(r["first"])) for r in some.select("lang", prefix).collect())
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def build_vocabulary(kept: DataFrame, folder: str, range_terms: int = 50_000, max_ranges: int = 4096) -> DataFrame:
    """Writes and returns the ranges: block, lang, first, n_terms, fst.

    A range has about ``range_terms`` terms; in a vocabulary of over ``max_ranges`` such ranges they
    grow instead, so what tasks know of the ranges (a prefix of ``PREFIX`` bytes each) has a bound.
    """
    spark = kept.sparkSession
    kept.write.parquet(f"{folder}/kept")
    kept = spark.read.parquet(f"{folder}/kept")
    total = kept.count()
    n = min(max_ranges, max(1, math.ceil(total / range_terms)))
    bounds = _range_bounds(kept, total, n) if n > 1 else []

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, terms = (batch.column(i).cast(pa.binary()).to_pylist() for i in (0, 1))
            block = [bisect.bisect_right(bounds, (lang, t[:PREFIX])) for lang, t in zip(langs, terms)]
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), batch.column(0), batch.column(1)],
                                             ["block", "lang", "term"])

    dealt = (kept.mapInArrow(place, "block bigint, lang string, term string")
             .repartition("block").sortWithinPartitions("block", "lang", "term"))
    built = dealt.select("block", "lang", "term").mapInArrow(
        _built, "block bigint, lang string, first binary, n_terms bigint, fst binary")
    built.write.parquet(f"{folder}/ranges")
    return spark.read.parquet(f"{folder}/ranges")


def _packed(terms: list[bytes]) -> bytes:
    return GAP.join(terms)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, begins, ends)`` of a packed list's terms."""
    data = np.frombuffer(blob, np.uint8)
    gaps = np.flatnonzero(data == GAP[0])
    return data, np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])


def term_stream(docs: DataFrame, ranges: list[tuple[str, bytes, int]], n_salts: int) -> DataFrame:
    """lang, block, salt, source, terms, n: the terms of each slice, packed, for the range that may hold them."""
    starts: dict[str, tuple[list[bytes], np.ndarray]] = {}
    for lang, first, block in ranges:
        firsts, blocks = starts.setdefault(lang, ([], []))
        firsts.append(first)
        blocks.append(block)
    starts = {lang: (firsts, np.array([*blocks, -1], np.int64)) for lang, (firsts, blocks) in starts.items()}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            langs, sources, at = _string(batch.column(0)), _string(batch.column(1)), 0
            for part in T.slices(_string(batch.column(2)), SLICE):
                pairs: dict[tuple[str, str], int] = {}
                both = zip(langs.slice(at, len(part)).to_pylist(), sources.slice(at, len(part)).to_pylist())
                group = np.fromiter((pairs.setdefault(p, len(pairs)) for p in both), np.int64, len(part))
                at += len(part)
                doc, code, terms = term_codes(part, LETTERS)
                n = max(1, len(terms))
                key, count = np.unique(group[doc] * n + code, return_counts=True)
                spelt = terms.cast(pa.large_binary()).to_pylist()
                rows = []
                for (lang, source), g in pairs.items():
                    if lang not in starts:
                        continue
                    firsts, blocks = starts[lang]
                    mine = slice(*np.searchsorted(key, [g * n, (g + 1) * n]))
                    own, times = key[mine] - g * n, count[mine]
                    where = np.zeros(len(own), np.int64) if len(firsts) == 1 else np.fromiter(
                        (bisect.bisect_right(firsts, spelt[c][:PREFIX]) - 1 for c in own.tolist()), np.int64, len(own))
                    order = np.argsort(where, kind="stable")
                    where, own, times = where[order], own[order], times[order]
                    cuts = np.searchsorted(where, np.arange(len(firsts) + 1))
                    rows += [(lang, int(blocks[k]), turn % n_salts, source, _packed([spelt[c] for c in own[a:b].tolist()]),
                              times[a:b].astype(np.int64).tobytes())
                             for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                turn += 1
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.large_binary(), pa.large_binary())
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                    columns[4:] = [c.cast(pa.binary()) for c in columns[4:]]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "block", "salt", "source", "terms", "n"])

    return docs.select("lang", "source", "text").mapInArrow(
        route, "lang string, block bigint, salt bigint, source string, terms binary, n binary")


COUNTS = "lang string, block bigint, source string, ordinal bigint, n bigint"


def _recounted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by source and ordinal of streamed terms; a range's transducer comes before its terms."""
    fst, at = None, None
    sums: dict[str, list] = {}
    held = 0

    def flush():
        for source, parts in sums.items():
            number = np.concatenate([p[0] for p in parts])
            keys, where = np.unique(number, return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, where, np.concatenate([p[1] for p in parts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([at[0]] * len(keys), pa.string()), pa.array([at[1]] * len(keys), pa.int64()),
                 pa.array([source] * len(keys), pa.string()), pa.array(keys), pa.array(n)],
                ["lang", "block", "source", "ordinal", "n"])

    for batch in batches:
        # lang, block, fst, source, terms, n, in the order of lang, block and transducer first
        for i in range(batch.num_rows):
            lang, block, blob, source, terms, n = (batch.column(k)[i] for k in range(6))
            if blob.is_valid:
                yield from flush()
                sums, held = {}, 0
                fst, at = Transducer.from_bytes(blob.as_py()), (lang.as_py(), block.as_py())
                continue
            number = fst.ordinals(*_unpacked(terms.as_py()))
            known = number >= 0
            sums.setdefault(source.as_py(), []).append((number[known], np.frombuffer(n.as_py(), np.int64)[known]))
            held += len(number)
            if held > CELLS:
                yield from flush()
                sums, held = {}, 0
    if at is not None:
        yield from flush()


def recount(docs: DataFrame, vocabulary: DataFrame, folder: str) -> DataFrame:
    """Writes and returns lang, block, source, ordinal, n: the counts that are not 0."""
    spark = docs.sparkSession
    ranges = sorted((r["lang"], bytes(r["first"]), r["block"]) for r in vocabulary.select("lang", "first", "block").collect())
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_salts = max(1, math.ceil(parts / max(1, len(ranges))))
    terms = term_stream(docs, ranges, n_salts)
    salts = F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1)).cast("array<bigint>"))
    tables = vocabulary.select("lang", "block", salts.alias("salt"), "fst")
    both = tables.unionByName(terms, allowMissingColumns=True).repartition(parts, "lang", "block", "salt")
    both = both.sortWithinPartitions("lang", "block", "salt", F.col("fst").isNull())
    out = both.select("lang", "block", "fst", "source", "terms", "n").mapInArrow(_recounted, COUNTS)
    out = out.groupBy("lang", "block", "source", "ordinal").agg(F.sum("n").alias("n"))  # of the range's tasks
    out.write.parquet(f"{folder}/counts")
    return spark.read.parquet(f"{folder}/counts")


# ---------------------------------------------------------------- divergence

def _share(count: np.ndarray, total: int, v: int) -> np.ndarray:
    if count.max(initial=0) >= 9_000_000_000:  # SCALE times it would not fit into 64 bits
        return np.array([1 + SCALE * (c + 1) // (total + v) for c in count.tolist()], np.int64)
    return 1 + SCALE * (count + 1) // (total + v)


PARTS = "lang string, source string, part string, other string, block bigint, ordinal bigint, term string, value bigint"


def _diverged(top: int):
    """Sums of a range for each pair of sources, and the range's ``top`` terms of each source."""

    def one(lang, block, v, totals, fst, counts):
        names = sorted(totals)
        n_terms = counts["n_terms"]
        grid_sources = {s: i for i, s in enumerate(names)}
        pair = np.zeros((len(names), len(names)), np.int64)
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {i: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for i in range(len(names))}
        source = np.array([grid_sources[s] for s in counts["names"]], np.int64)[counts["code"]] if len(counts["code"]) else np.zeros(0, np.int64)
        order = np.argsort(counts["ordinal"], kind="stable")
        ordinal, source, n = counts["ordinal"][order], source[order], counts["n"][order]
        width = max(1, CELLS // max(1, len(names)))
        whole = sum(totals.values())
        for low in range(0, n_terms, width):
            high = min(n_terms, low + width)
            a, b = np.searchsorted(ordinal, [low, high])
            grid = np.zeros((len(names), high - low), np.int64)
            np.add.at(grid, (source[a:b], ordinal[a:b] - low), n[a:b])
            p = np.stack([_share(grid[i], totals[s], v) for i, s in enumerate(names)])
            q = _share(grid.sum(0), whole, v)
            for i in range(len(names)):
                d = p[i] - p
                pair[i] += (d * d // p).sum(1)
                up = np.flatnonzero((grid[i] > 0) & (p[i] > q))
                value = (p[i][up] - q[up]) ** 2 // q[up]
                value, number = np.concatenate([best[i][0], value]), np.concatenate([best[i][1], up + low])
                keep = np.lexsort((number, -value))[:top]
                best[i] = value[keep], number[keep]
        rows = [(lang, names[i], "pair", names[j], block, -1, None, int(pair[i, j]))
                for i in range(len(names)) for j in range(len(names)) if i != j]
        for i, (value, number) in best.items():
            rows += [(lang, names[i], "term", None, block, int(o), fst.spell(int(o)).decode(), int(x))
                     for x, o in zip(value, number)]
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, fst, v, n_terms, totals = None, None, 0, 0, {}
        names, codes, ordinals, ns = {}, [], [], []

        def finish():
            counts = {"n_terms": n_terms, "names": list(names),
                      "code": np.concatenate(codes) if codes else np.zeros(0, np.int64),
                      "ordinal": np.concatenate(ordinals) if ordinals else np.zeros(0, np.int64),
                      "n": np.concatenate(ns) if ns else np.zeros(0, np.int64)}
            rows = one(at[0], at[1], v, totals, fst, counts)
            kinds = (pa.string(),) * 4 + (pa.int64(), pa.int64(), pa.string(), pa.int64())
            heads = ["lang", "source", "part", "other", "block", "ordinal", "term", "value"]
            for low in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[low:low + 10_000]), kinds)], heads)

        for batch in batches:
            # lang, block, kind, fst, v, n_terms, source, ordinal, n; kind 0 the transducer, 1 totals, 2 counts
            kinds = batch.column(2).to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(kinds < 2).tolist()
            bounds = sorted({0, *heads, *[h + 1 for h in heads], batch.num_rows})
            for low, high in zip(bounds, bounds[1:]):
                if kinds[low] == 0:
                    if at is not None:
                        yield from finish()
                    at = (batch.column(0)[low].as_py(), batch.column(1)[low].as_py())
                    fst = Transducer.from_bytes(batch.column(3)[low].as_py())
                    v, n_terms = batch.column(4)[low].as_py(), batch.column(5)[low].as_py()
                    totals, names, codes, ordinals, ns = {}, {}, [], [], []
                elif kinds[low] == 1:
                    totals[batch.column(6)[low].as_py()] = batch.column(8)[low].as_py()
                else:
                    source = batch.column(6).slice(low, high - low).dictionary_encode()
                    local = [names.setdefault(s, len(names)) for s in source.dictionary.to_pylist()]
                    codes.append(np.array(local, np.int64)[source.indices.to_numpy(zero_copy_only=False)])
                    ordinals.append(batch.column(7).slice(low, high - low).to_numpy(zero_copy_only=False))
                    ns.append(batch.column(8).slice(low, high - low).to_numpy(zero_copy_only=False))
        if at is not None:
            yield from finish()

    return run


def divergence(docs: DataFrame, folder: str, min_docs: int = 3, top: int = 200,
               lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows against every other source, ``term`` rows to rank ``top``.

    ``folder`` is a fresh one that all machines share; the vocabulary and the counts are written there.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for n, c in (("lang", lang_col), ("source", source_col), ("text", text_col))])
    vocabulary = build_vocabulary(kept_terms(docs, min_docs), folder)
    counts = recount(docs, vocabulary, folder)
    groups = docs.select("lang", "source").distinct()
    totals = (groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
              .select("lang", "source", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))
    sizes = vocabulary.groupBy("lang").agg(F.sum("n_terms").alias("v"))
    ranges = vocabulary.join(sizes, "lang").withColumn("kind", F.lit(0))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = (ranges.select("lang", "block", "kind", "fst", "v", "n_terms")
            .unionByName(vocabulary.select("lang", "block").join(totals, "lang").withColumn("kind", F.lit(1)), allowMissingColumns=True)
            .unionByName(counts.withColumn("kind", F.lit(2)), allowMissingColumns=True)
            .repartition(parts, "lang", "block").sortWithinPartitions("lang", "block", "kind"))
    found = rows.select("lang", "block", "kind", "fst", "v", "n_terms", "source", "ordinal", "n").mapInArrow(_diverged(top), PARTS)
    found.write.parquet(f"{folder}/found")
    found = docs.sparkSession.read.parquet(f"{folder}/found")

    sums = found.where("part = 'pair'").groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    pairs = (groups.join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
             .join(sums, ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value")))
    by_value = Window.partitionBy("lang", "source")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value.orderBy(F.desc("value"), "item")))
    # The ranges of a language ascend, so (block, ordinal) is the term's place in the whole vocabulary.
    terms = (found.where("part = 'term'")
             .withColumn("rank", F.row_number().over(by_value.orderBy(F.desc("value"), "block", "ordinal")))
             .where(F.col("rank") <= top).select("lang", "source", "part", F.col("term").alias("item"), "value", "rank"))
    return pairs.unionByName(terms)


#: The same in DuckDB.
DIVERGENCE_SQL = r"""
with docs as (
  select row_number() over () as row_no, coalesce(lang, '') as lang, coalesce(source, '') as source,
         coalesce(text, '') as text
  from documents
),
occ as (
  select row_no, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from docs
),
kept as (select lang, term from occ group by lang, term having count(distinct row_no) >= 3),
sizes as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from docs),
counted as (select lang, source, term, count(*) as c from occ join kept using (lang, term) group by lang, source, term),
grid as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c
  from groups g join kept k using (lang) left join counted c using (lang, source, term)
),
totals as (select lang, source, sum(c) as n from grid group by lang, source),
p as (
  select lang, source, term, c, 1 + (1000000000 * (c + 1)::hugeint) // (n + v) as p
  from grid join totals using (lang, source) join sizes using (lang)
),
whole as (
  select lang, term, 1 + (1000000000 * (sum(c) + 1)::hugeint) // (sum(sum(c)) over (partition by lang) + v) as q
  from grid join sizes using (lang) group by lang, term, v
),
pair_sums as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pair_sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
),
terms as (
  select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value
  from p join whole using (lang, term) where c > 0 and p > q
),
ranked as (
  select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
  from (select * from pairs union all select * from terms)
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 200
"""
