"""Token-id files of directly addressable codes.

A shard file holds the token ids of a run of documents.  Every id is split
into 8-bit chunks, lowest first.  Level j stores the j-th chunk of the ids
that have one, and a bitmap that says for each of them whether another chunk
follows.  A rank directory holds the number of set bits before every block of
512 bitmap bits.  Token i is then read from level 0 at position i, continues
at the position ``rank(i)`` of level 1 if its bit is set, and so on: random
access costs one directory entry and at most eight bitmap words a level, and
no block is decoded.

File layout (little-endian): ``FDAC1\\0``, header length (uint32), JSON header
(counts and byte lengths), document ids (int64), a validity byte for each,
document starts (int64, one more than documents), then for each level the
chunk bytes, the bitmap and the directory (uint64).

Files are written by the tasks of a Spark job into a folder that all machines
share.  Each attempt of a task writes files of its own names; the manifest
(Parquet, one row per file, written by the same job) names those that count,
so a file that a lost executor has left behind is never read.

Edge cases: a null text is the empty text; an empty text is the end id alone;
rows of a null doc_id come first; rows that share a doc_id keep one entry
each, ordered by text; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as T
from .vocab import library_tokenizer

MAGIC = b"FDAC1\0"
CHUNK_BITS, BLOCK_BITS = 8, 512
END_ID = 1

MANIFEST = "file string, first_id long, n_docs long, n_tokens long"
DOCUMENTS = "file string, doc_id long, at long, local_start long, n_tokens long, ids_crc32 long"


# ------------------------------------------------------------------ the codes

def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(chunks, bitmap, directory)`` of each level of the ids."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-len(bitmap) // (BLOCK_BITS // 8)) * (BLOCK_BITS // 8), np.uint8)
        padded[:len(bitmap)] = bitmap
        ones = np.bitwise_count(padded.reshape(-1, BLOCK_BITS // 8)).sum(1, dtype=np.uint64)
        directory = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint64)
        levels.append(((rest & 0xFF).astype(np.uint8), padded, directory))
        if not goes_on.any():
            return levels
        rest = more[goes_on]


def encode_shard(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard file; ``starts`` has one entry more than ``doc_ids``."""
    levels = encode_levels(ids)
    head = json.dumps({"n_docs": len(doc_ids), "n_tokens": int(len(ids)),
                       "levels": [[len(c), len(b), len(d)] for c, b, d in levels]}).encode()
    keys = np.array([0 if x is None else x for x in doc_ids], "<i8")
    valid = np.array([x is not None for x in doc_ids], np.uint8)
    parts = [MAGIC, struct.pack("<I", len(head)), head, keys.tobytes(), valid.tobytes(),
             np.asarray(starts, "<i8").tobytes()]
    for chunks, bitmap, directory in levels:
        parts += [chunks.tobytes(), bitmap.tobytes(), directory.astype("<u8").tobytes()]
    return b"".join(parts)


class Shard:
    """Reads a shard file's bytes (or a memory map of it)."""

    def __init__(self, data):
        data = memoryview(data)
        if bytes(data[:6]) != MAGIC:
            raise ValueError("not a token-id shard")
        size, = struct.unpack("<I", data[6:10])
        head, at = json.loads(bytes(data[10:10 + size])), 10 + size
        self.n_docs, self.n_tokens = head["n_docs"], head["n_tokens"]

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, kind, n, at) if n else np.zeros(0, kind)
            at += out.nbytes
            return out

        keys, valid = take("<i8", self.n_docs), take(np.uint8, self.n_docs)
        self.doc_ids = [int(k) if v else None for k, v in zip(keys, valid)]
        self.starts = take("<i8", self.n_docs + 1)
        self.levels = [(take(np.uint8, c), take(np.uint8, b), take("<u8", d)) for c, b, d in head["levels"]]

    def token(self, i: int) -> int:
        """The i-th id of the shard, without decoding any other."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bitmap, directory in self.levels:
            value |= int(chunks[i]) << shift
            shift += CHUNK_BITS
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block, byte = i // BLOCK_BITS, i >> 3
            before = np.bitwise_count(bitmap[block * (BLOCK_BITS // 8):byte]).sum(dtype=np.int64)
            before += int(bitmap[byte] & ((1 << (i & 7)) - 1)).bit_count()
            i = int(directory[block]) + int(before)
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids of ``[start, stop)``, each from its own codes."""
        return np.array([self.token(i) for i in range(start, stop)], np.uint32)

    def all_tokens(self) -> np.ndarray:
        """All ids, level by level from the deepest."""
        rest = None
        for chunks, bitmap, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            if rest is not None:
                goes_on = np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)
                value[goes_on] |= rest << CHUNK_BITS
            rest = value
        return rest


# ------------------------------------------------------------------- encoding

@lru_cache(4)
def _library_words(path: str) -> T.EncodedWords:
    lib = library_tokenizer(path)

    def encode(distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [e.ids for e in lib.encode_batch_fast(distinct, add_special_tokens=False)]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter(chain.from_iterable(encoded), np.int64, int(lengths.sum())), lengths

    return T.EncodedWords(encode)


def encode_texts(texts: pa.Array, path: str, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, ids)`` of whole texts by the tokenizers library, each text followed by ``end_id``.

    White space and the marks after a word end the pieces of this vocabulary,
    so a text's ids are those of its word parts in order; the library encodes
    each distinct part of a slice once.
    """
    offs, codes, distinct = T.word_parts(texts)
    row, flat, lengths = _library_words(path).rows(distinct.to_pylist())
    codes = row[codes]
    ids = flat[T.ragged_take(lengths, codes)].astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(T.per_text(offs, lengths[codes]))])
    if end_id is None:
        return starts, ids
    ids = np.insert(ids, starts[1:], end_id)
    return starts + np.arange(len(starts)), ids


def _store(folder: str):
    """``(filesystem, path)`` of a folder that all machines share, by its URI or plain path."""
    from pyarrow import fs

    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder[5:])
    return fs.LocalFileSystem(), folder


def _write_shards(batches: Iterator[pa.RecordBatch], path: str, folder: str, end_id: int,
                  shard_tokens: int) -> Iterator[pa.RecordBatch]:
    store, root = _store(folder)
    task = uuid.uuid4().hex
    names = ["file", "first_id", "n_docs", "n_tokens"]
    doc_ids, parts, starts, total, n_files = [], [], [0], 0, 0

    def close():
        nonlocal doc_ids, parts, starts, total, n_files
        name = f"{task}-{n_files:05d}.dac"
        with store.open_output_stream(f"{root}/{name}") as out:
            out.write(encode_shard(doc_ids, np.array(starts), np.concatenate(parts)))
        row = [[name], [doc_ids[0]], [len(doc_ids)], [total]]
        doc_ids, parts, starts, total, n_files = [], [], [0], 0, n_files + 1
        return pa.RecordBatch.from_arrays([pa.array(row[0], pa.string()), *[pa.array(c, pa.int64()) for c in row[1:]]],
                                          names)

    for batch in batches:
        at = 0
        for part in T.slices(T.filled(batch.column(1))):
            begins, ids = encode_texts(part, path, end_id)
            keys = batch.column(0).slice(at, len(part)).to_pylist()
            at += len(part)
            first = 0
            while first < len(keys):  # whole documents, up to the shard's size
                room = np.searchsorted(begins, begins[first] + max(0, shard_tokens - total), side="right") - 1
                last = int(min(len(keys), max(room, first + (not doc_ids))))
                if last > first:
                    doc_ids += keys[first:last]
                    parts.append(ids[begins[first]:begins[last]])
                    starts += (begins[first + 1:last + 1] - begins[first] + total).tolist()
                    total += int(begins[last] - begins[first])
                    first = last
                if first < len(keys):
                    yield close()
    if doc_ids:
        yield close()


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID,
                      shard_tokens: int = 2 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode ``docs`` and write shard files below ``folder`` in ascending id order; returns the manifest.

    One range shuffle on the id; a shard holds whole documents of at least one
    and about ``shard_tokens`` ids at most, so a task's memory is bounded by a
    shard and its longest text.
    """
    spark = docs.sparkSession
    _store(folder)[0].create_dir(_store(folder)[1])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))
    manifest = rows.mapInArrow(lambda it: _write_shards(it, tokenizer_path, folder, end_id, shard_tokens), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


# -------------------------------------------------------------------- reading

def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = Shard(content.as_buffer())
            ids = shard.all_tokens().astype("<u4")
            begins = shard.starts
            crc = [zlib.crc32(ids[a:b].data) for a, b in zip(begins[:-1], begins[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * shard.n_docs, pa.string()), pa.array(shard.doc_ids, pa.int64()),
                 pa.array(range(shard.n_docs), pa.int64()), pa.array(begins[:-1], pa.int64()),
                 pa.array(np.diff(begins), pa.int64()), pa.array(crc, pa.int64())],
                ["file", "doc_id", "at", "local_start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files of ``folder``: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it.  The running total
    over files needs one row per file.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    name = F.element_at(F.split("path", "/"), -1)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder)
             .select(name.alias("file"), "content"))
    docs = files.mapInArrow(_read_shards, DOCUMENTS)
    # A document's files follow each other by first id; files of one id by name's counter.
    starts = manifest.selectExpr(
        "file as m_file",
        "coalesce(sum(n_tokens) over (order by first_id nulls first, file "
        "rows between unbounded preceding and 1 preceding), 0) as file_start")
    return (docs.join(starts, F.col("file") == F.col("m_file"))
            .select("doc_id", (F.col("file_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"))
