"""SimHash near-duplicates over a byte-position index with count filtering.

A fingerprint has 64 bits, 8 bytes by position.  Fingerprints that differ in
at most d bits (d = 4 by default) agree in at least 8 - d byte positions, the
guaranteed minimum of matches.  The index therefore lists every distinct
fingerprint under each choice of that many positions with the bytes there
(70 entries for d = 4), and only fingerprints that reach the minimum meet in a
list.  Within a list the positions at which two agree are tallied; the pair is
retained by the list of its first matching positions only, so it is met once,
and then verified by its differing bits.  No posting list of a single byte is
ever paired with itself, whose length would be a 256th of the corpus.

A list of over ``list_limit`` fingerprints is not paired at all.  Its members
are linked through the bit patterns within d / 2 bits of each of them: two
fingerprints at distance d or less have such a pattern in common, and any two
that share one are at distance d or less.  Each pattern's members link to its
least one, so a dense group costs rows in proportion to its size, not its
square, and no link between different texts is lost.  For an odd d a pattern's
members are within (d + 1) / 2 bits and link to its least one within
(d - 1) / 2, which are at distance d or less as well.

Equal fingerprints are one node, so exact copies meet in an aggregate only.
Components come from star steps (``components``).

Edge cases: a text without words (null, empty, blank) has fingerprint 0 and is
linked like any other; one of fewer words than a shingle is one shingle; a
null id is never a component's id unless the component has no other; repeated
rows each keep a row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import text as T
from .components import connected_components
from .names import fresh

SEED = 42
BYTES = 8


def fingerprint(text: str, shingle: int = 4) -> int:
    """The SimHash of a text's word shingles (XXH64), repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    n = max(1, len(words) - shingle + 1)
    stops = ends[-n:].tolist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, -(-n // 65536)):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(texts: pa.Array, shingle: int) -> pa.Array:
    return pa.array(np.array([fingerprint(t, shingle) for t in T.filled(texts).to_pylist()], np.uint64).view(np.int64))


def fingerprints(text: Column, shingle: int = 4) -> Column:
    """The fingerprint of each text, as a signed long of the same bits."""
    return F.arrow_udf(lambda t: _fingerprints(t, shingle), "bigint")(text)


# ------------------------------------------------------------------ the index

def _positions(max_bits: int) -> list[tuple[int, ...]]:
    return list(combinations(range(BYTES), BYTES - max_bits))


def _index(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    choices = _positions(max_bits)
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 4096):
            part = np.ascontiguousarray(fps[at:at + 4096])
            byte = part.view(np.uint8).reshape(-1, BYTES)
            bits = np.zeros((len(choices), len(part)), np.int64)
            for k, c in enumerate(choices):
                for p in c:
                    bits[k] = (bits[k] << 8) | byte[:, p]
            choice = np.repeat(np.arange(len(choices), dtype=np.int16), len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(choice), pa.array(bits.ravel()), pa.array(np.tile(part, len(choices)))],
                ["choice", "bytes", "fp"])


def _retained(batches: Iterator[pa.RecordBatch], max_bits: int, list_limit: int) -> Iterator[pa.RecordBatch]:
    """Verified pairs of the sorted lists, and (member, null) for members of lists beyond the limit."""
    choices = np.array([sum(1 << p for p in c) for c in _positions(max_bits)], np.int64)
    weight = 1 << np.arange(BYTES, dtype=np.int64)

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a), b if b is not None else pa.nulls(len(a), pa.int64())], ["a", "b"])

    def pairs(choice, key, fp):
        size = np.diff(np.append(np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1])])), len(key)))
        beyond = np.repeat(size, size) > list_limit
        if beyond.any():
            yield out(fp[beyond], None)
            choice, key, fp = choice[~beyond], key[~beyond], fp[~beyond]
        found = []
        left = np.arange(len(key))
        step = 1
        while len(left):
            left = left[left + step < len(key)]
            left = left[key[left] == key[left + step]]
            differ = fp[left] ^ fp[left + step]
            equal = differ.view(np.uint8).reshape(-1, BYTES) == 0
            tally = equal.sum(1)
            first = equal & (np.cumsum(equal, 1) <= BYTES - max_bits)
            keep = (tally >= BYTES - max_bits) & (first @ weight == choices[choice[left]])
            keep &= np.bitwise_count(differ.view(np.uint64)) <= max_bits
            found.append((fp[left[keep]], fp[left[keep] + step]))
            step += 1
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            if len(a):
                yield out(a, pa.array(b))

    open_choice, open_key, open_fp = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64))
    beyond_key = None
    for batch in batches:
        choice, bits, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        key = (choice.astype(np.int64) << 32) | bits
        if beyond_key is not None:
            more = key == beyond_key
            if more.any():
                yield out(fp[more], None)
                choice, key, fp = choice[~more], key[~more], fp[~more]
            if len(key):
                beyond_key = None
        choice, key, fp = (np.concatenate(x) for x in ((open_choice, choice), (open_key, key), (open_fp, fp)))
        if not len(key):
            continue
        last = int(np.argmax(key == key[-1]))  # the list that may go on in the next batch
        yield from pairs(choice[:last], key[:last], fp[:last])
        open_choice, open_key, open_fp = choice[last:], key[last:], fp[last:]
        if len(open_key) > list_limit:
            yield out(open_fp, None)
            beyond_key = open_key[0]
            open_choice, open_key, open_fp = open_choice[:0], open_key[:0], open_fp[:0]
    if len(open_key):
        yield from pairs(open_choice, open_key, open_fp)


def _patterns(batches: Iterator[pa.RecordBatch], inner: int, outer: int) -> Iterator[pa.RecordBatch]:
    """The patterns within ``outer`` bits of each fingerprint; ``core`` is the fingerprint within ``inner`` bits, else null."""
    flips = np.array([sum(1 << p for p in c) for r in range(outer + 1) for c in combinations(range(64), r)], np.uint64)
    within = np.bitwise_count(flips) <= inner
    step = max(1, (1 << 17) // len(flips))
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fps), step):
            part = fps[at:at + step]
            around = (part[:, None] ^ flips[None, :]).ravel().view(np.int64)
            fp = np.repeat(part, len(flips)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(around), pa.array(fp), pa.array(fp, mask=np.tile(~within, len(part)))], ["pattern", "fp", "core"])


def links(fps: DataFrame, max_bits: int = 4, list_limit: int = 256) -> DataFrame:
    """(a, b): links of distinct fingerprints (one column, fp) whose components are those of all close pairs."""
    if not 4 <= max_bits < BYTES:
        raise ValueError("max_bits must be 4 to 7: the bytes of a list's positions are kept in 32 bits")
    spark = fps.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = fps.select("fp").mapInArrow(lambda it: _index(it, max_bits), "choice short, bytes long, fp long")
    lists = lists.repartition(n, "choice", "bytes").sortWithinPartitions("choice", "bytes", "fp")
    met = lists.mapInArrow(lambda it: _retained(it, max_bits, list_limit), "a long, b long").checkpoint()
    found = met.where("b is not null")
    dense = met.where("b is null").select(F.col("a").alias("fp"))
    if dense.isEmpty():
        return found
    inner, outer = max_bits // 2, -(-max_bits // 2)
    near = dense.distinct().mapInArrow(lambda it: _patterns(it, inner, outer), "pattern long, fp long, core long")
    near = near.checkpoint()
    least = (near.groupBy("pattern").agg(F.min("core").alias("m"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and m is not null"))
    through = near.join(least, "pattern").where("fp <> m").select(F.col("fp").alias("a"), F.col("m").alias("b"))
    return found.union(through.distinct())


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, list_limit: int = 256,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fp, root, component_id: one row per row of ``docs``.

    ``root`` is the least fingerprint of the component, ``component_id`` its least doc_id.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    marked = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                         fingerprints(F.col(text_col), shingle).alias("fp")).checkpoint()
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")).checkpoint()
    roots = connected_components(links(nodes, max_bits, list_limit))
    joined = roots.join(nodes, F.col("node") == F.col("fp")).select("node", "root", "first_id")
    least = joined.groupBy("root").agg(F.min("first_id").alias("least_id"))
    linked = joined.select("node", "root").join(least, "root").withColumn("linked", F.lit(True))
    named = nodes.join(linked, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("k"), F.coalesce("root", "fp").alias("root"),
        F.when(F.col("linked"), F.col("least_id")).otherwise(F.col("first_id")).alias("component_id"))
    return marked.join(named, F.col("fp") == F.col("k")).select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group does: the one of the least id.

    Of rows that share that id (or are all without one) one stays.
    """
    found = near_duplicates(docs, shingle, max_bits, id_col=id_col, text_col=text_col).checkpoint()
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("root", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    key, check = fresh(docs.columns, "_key"), fresh(docs.columns, "_check")
    named = chosen.select(F.col("doc_id").alias(key), F.col("text_hash").alias(check))
    kept = docs.join(named, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(check)), "left_semi")
    repeated = first.groupBy("doc_id", "text_hash").count().where("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates([id_col, text_col])
