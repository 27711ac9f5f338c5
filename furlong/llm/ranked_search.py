"""Ranked lexical search by the Best Position Algorithm.

Every query ranks all documents by the sum of its terms' impacts.  The first
pass counts documents, terms, and the documents that hold each query term.
In the second, a task indexes its documents in slices: for each query term a
list of documents by descending impact, and each document's place in it.
A query then reads its lists from the top.  Each document met is looked up
directly in all lists of the query, which gives its whole score and marks its
places there as seen.  The best position of a list is the end of the seen run
at its head; no document that was not met has more than the impact of the
first place after it.  As places seen through other lists count too, the sum
of these impacts falls faster than that of the last-read places, and reading
stops once it is strictly below the query's k-th score, so that ties are read.

Each task keeps its k best of every query across its slices, which is what the
sum is held against; the tasks' best are ranked together.  A document's score
needs the corpus counts and its own text only, so this loses nothing.

Queries of one text are searched once.  They are held by all tasks in groups of
about ``group_bytes`` of text, and by a task in blocks of ``BLOCK_TERMS``
distinct terms; each group is one scan.  Groups are chosen by a hash of the
text, and of one longer than that there is one.

Edge cases: null texts have no terms; documents that hold none of a query's
terms have no rank, nor has anything for a query without terms; repeated rows
are documents of their own; equal scores go by ascending id, a null id first,
then in no fixed order; empty tables give no rows; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .terms import LETTERS_DIGITS, term_codes

SLICE = 8 << 20       # bytes of text indexed at once
CELLS = 2 << 20       # impacts laid out at once
BLOCK_TERMS = 8192
LOWEST = -(1 << 63)


# ---------------------------------------------------------------- queries

@dataclass
class Queries:
    """Distinct query texts: for each, codes of its distinct terms and how often each is repeated."""

    keys: list[str]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocabulary: dict[str, int]

    @classmethod
    def of(cls, rows: list[tuple[str, str]]) -> Queries:
        keys = [k for k, _ in rows]
        owner, code, terms = term_codes(pa.array([t for _, t in rows], pa.string()), LETTERS_DIGITS)
        names = terms.to_pylist()
        out, times = [], []
        bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
        for i in range(len(rows)):
            distinct, n = np.unique(code[bounds[i]:bounds[i + 1]], return_counts=True)
            out.append(distinct)
            times.append(n)
        return cls(keys, out, times, {t: i for i, t in enumerate(names)})

    def blocks(self) -> Iterator[list[int]]:
        """Queries, in order, in runs of about BLOCK_TERMS distinct terms (one query with more is one run)."""
        held: set[int] = set()
        run: list[int] = []
        for q in range(len(self.keys)):
            if run and len(held) + len(self.terms[q]) > BLOCK_TERMS:
                yield run
                held, run = set(), []
            held.update(self.terms[q].tolist())
            run.append(q)
        if run:
            yield run


def query_groups(items: DataFrame, text_col: str, group_bytes: int) -> Iterator[Queries]:
    """The distinct texts of ``items`` in groups that tasks can hold."""
    texts = items.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    texts = texts.select(F.sha2("text", 256).alias("key"), "text")
    n = max(1, math.ceil((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / group_bytes))
    for g in range(n):
        rows = texts.where(F.pmod(F.xxhash64("key"), F.lit(n)) == g).orderBy("key").collect()
        if rows:
            yield Queries.of([(r["key"], r["text"]) for r in rows])


# ---------------------------------------------------------------- statistics

def _query_terms(part: pa.Array, vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms per text, and (text, query term, occurrences) of the query terms in the texts, by text."""
    doc, code, terms = term_codes(part, LETTERS_DIGITS)
    size = np.bincount(doc, minlength=len(part)).astype(np.int64)
    known = np.fromiter((vocabulary.get(t, -1) for t in terms.to_pylist()), np.int64, len(terms))
    term = known[code] if len(code) else code
    doc, term = doc[term >= 0], term[term >= 0]
    n = max(1, len(vocabulary))
    key, tf = np.unique(doc * n + term, return_counts=True)
    return size, key // n, key % n, tf


def _counts(vocabulary):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary) + 2, np.int64)  # the last two: documents with a term, terms
        for batch in batches:
            for part in T.slices(T.filled(batch.column(0)), SLICE):
                size, _, term, _ = _query_terms(part, vocabulary)
                df[:-2] += np.bincount(term, minlength=len(vocabulary))
                df[-2:] += [np.count_nonzero(size), size.sum()]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["code", "n"])

    return count


def corpus_counts(docs: DataFrame, vocabulary: dict[str, int]) -> np.ndarray:
    """For each query term the documents that hold it; then the documents with a term, and all terms."""
    found = docs.select("text").mapInArrow(_counts(vocabulary), "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    out = np.zeros(len(vocabulary) + 2, np.int64)
    for r in found.collect():  # at most one row a query term
        out[r["code"]] = r["n"]
    return out


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


# ---------------------------------------------------------------- lists and the search

class Lists:
    """Impact lists of the documents of a slice: impact and place of every (term, document), and each list's order."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int):
        self.terms, row = np.unique(term, return_inverse=True)
        self.impact = np.zeros((len(self.terms), n_docs), np.int64)
        self.place = np.full((len(self.terms), n_docs), -1, np.int32)
        order = np.lexsort((doc, -impact, row))
        row, self.docs = row[order], doc[order]
        self.first = np.searchsorted(row, np.arange(len(self.terms) + 1))
        self.impact[row, self.docs] = impact[order]
        self.place[row, self.docs] = np.arange(len(row)) - self.first[row]

    def search(self, terms: np.ndarray, repeats: np.ndarray, k: int, floor: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """``(documents met, their scores, places read)``: all documents that can be among the ``k`` best are met.

        ``floor`` is a score that k documents elsewhere reach, -1 for none.
        """
        row = np.searchsorted(self.terms, terms)
        here = row < len(self.terms)
        here[here] = self.terms[row[here]] == terms[here]
        row, times = row[here], repeats[here]
        size = self.first[row + 1] - self.first[row]
        heads = self.first[row]
        seen = [np.zeros(n + 1, bool) for n in size.tolist()]  # one more place, never seen, with impact 0
        best = np.zeros(len(row), np.int64)
        met = np.zeros(self.impact.shape[1], bool)
        docs, scores = [], []
        top = np.full(k, floor, np.int64)
        depth, step, read = 0, 4, 0
        while len(row) and depth < size.max():
            new = np.concatenate([self.docs[h + depth:h + min(n, depth + step)]
                                  for h, n in zip(heads.tolist(), size.tolist()) if n > depth])
            read += len(new)
            new = np.unique(new[~met[new]])
            depth, step = depth + step, step * 2
            if len(new):
                met[new] = True
                # Direct access: every list of the query says what the documents have and where.
                at = np.ix_(row, new)
                score = times @ self.impact[at]
                places = self.place[at]
                docs.append(new)
                scores.append(score)
                top = np.sort(np.concatenate([top, score]))[-k:]
                for i, p in enumerate(places):
                    seen[i][p[p >= 0]] = True
            for i, marks in enumerate(seen):
                best[i] += int(np.argmin(marks[best[i]:]))
            open_ = best < size
            after = self.docs[heads[open_] + best[open_]]
            limit = int((times[open_] * self.impact[row[open_], after]).sum())
            if limit < top[0]:
                break
        none = np.zeros(0, np.int64)
        return np.concatenate(docs) if docs else none, np.concatenate(scores) if scores else none, read


BEST = "key string, doc_id bigint, score bigint"


def _searched(queries: Queries, weight: np.ndarray, n_docs: int, n_terms: int, k: int):
    blocks = list(queries.blocks())
    block_terms = [np.unique(np.concatenate([queries.terms[q] for q in b])) for b in blocks]

    def best_first(score, known, doc_id):
        return np.lexsort((doc_id, known, -score))[:k]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        best = [(empty, np.zeros(0, bool), empty)] * len(queries.keys)  # score, id is known, id
        for batch in batches:
            ids, at = batch.column(0), 0
            for part in T.slices(T.filled(batch.column(1)), SLICE):
                own = ids.slice(at, len(part))
                known = own.is_valid().to_numpy(zero_copy_only=False)
                doc_id = own.fill_null(LOWEST).to_numpy(zero_copy_only=False)
                at += len(part)
                size, doc, term, tf = _query_terms(part, queries.vocabulary)
                if not len(doc):
                    continue
                m = 100 - 75 + (75 * size[doc] * n_docs) // n_terms
                impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                for block, wanted in zip(blocks, block_terms):
                    step = max(1, CELLS // len(wanted))
                    mine = np.isin(term, wanted)
                    d, t, x = doc[mine], term[mine], impact[mine]
                    for low in range(0, len(part), step):
                        a, b = np.searchsorted(d, [low, low + step])
                        if a == b:
                            continue
                        lists = Lists(d[a:b] - low, t[a:b], x[a:b], min(step, len(part) - low))
                        for q in block:
                            score, sure, name = best[q]
                            floor = int(score[-1]) if len(score) == k else -1
                            met, got, _ = lists.search(queries.terms[q], queries.repeats[q], k, floor)
                            good = (got > 0) & (got >= floor)
                            if good.any():
                                met = met[good] + low
                                every = (np.concatenate([score, got[good]]), np.concatenate([sure, known[met]]),
                                         np.concatenate([name, doc_id[met]]))
                                keep = best_first(*every)
                                best[q] = tuple(c[keep] for c in every)
        for low in range(0, len(best), 1000):
            rows = best[low:low + 1000]
            n = [len(r[0]) for r in rows]
            if sum(n):
                names = pa.array(queries.keys[low:low + 1000]).take(pa.array(np.repeat(np.arange(len(rows)), n)))
                sure = np.concatenate([r[1] for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(np.concatenate([r[2] for r in rows]), mask=~sure),
                     pa.array(np.concatenate([r[0] for r in rows]))], ["key", "doc_id", "score"])

    return search


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", group_bytes: int = 16 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for queries in query_groups(items, item_text_col, group_bytes):
        counts = corpus_counts(docs, queries.vocabulary)
        n_docs, n_terms = int(counts[-2]), int(counts[-1])
        if not n_terms:
            continue
        best = docs.mapInArrow(_searched(queries, weights(counts[:-2], n_docs), n_docs, n_terms, k), BEST)
        found = best if found is None else found.union(best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], BEST)
    order = Window.partitionBy("key").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    keys = items.select(F.col(item_col).alias("item_id"),
                        F.sha2(F.coalesce(F.col(item_text_col).cast("string"), F.lit("")), 256).alias("key"))
    return keys.join(ranked, "key").select("item_id", "rank", "doc_id", "score")


#: The same in DuckDB.
SEARCH_SQL = r"""
with docs as (select row_number() over () as row_no, doc_id, text from documents),
occ as (
  select row_no, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from docs
),
sizes as (select row_no, count(*)::bigint as n from occ group by row_no),
corpus as (select count(*)::bigint as big_n, sum(n)::bigint as big_l from sizes),
tf as (select row_no, term, count(*)::bigint as tf from occ group by row_no, term),
df as (select term, count(*)::bigint as df from tf group by term),
query as (
  select item_id, term, count(*)::bigint as times
  from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
  group by item_id, term
),
scored as (
  select item_id, row_no,
         sum(times * floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1)::double))::bigint
             * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::bigint as score
  from query join df using (term) join tf using (term) join sizes using (row_no), corpus
  group by item_id, row_no
),
ranked as (
  select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
  from scored join docs using (row_no) where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""
