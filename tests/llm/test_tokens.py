"""Token operators against the tokenizers library: ids, counts at every prefix, files, decoding."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from furlong.llm import bpe, token_count, token_file
from furlong.llm import text as T
from furlong.llm import vocab as V

WORD, BYTE = V.public_path("word_bpe_49k.json"), V.public_path("byte_bpe_50k.json")
FIXED = ["", " ", "\n \t", "Don't they'LL we've !'re 1234 x", "<|endoftext|>a  <|endoftext|> <|startoftext|>",
         "İSTANBUL ΣΑΣ Ärger ñandú", "a    b c　d", "x\x1c\x1dy\x85z", "ẖH̱ éÉ",
         "漢字かな👍🏽 ١٢٣ ꟋՀ", "ababab" * 40, "a" * 2000, "of%%% the*** nd,&&&", "¿Qué?¡No! «ok» …"]


def fuzz(n, alphabet="ab c'sltdre \n\té́Σ1<|>!endofx 　漢%,."):
    rng = random.Random(n)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(n)]


@pytest.mark.parametrize("with_specials", [True, False])
def test_word_ids_equal_the_library(with_specials):
    texts = FIXED + fuzz(800)
    if not with_specials:
        texts = [t.replace("<|", "<") for t in texts]
    want = [e.ids for e in V.library_tokenizer(WORD).encode_batch(texts, add_special_tokens=False)]
    for encode in (bpe.encode_batch, lambda t, p: token_file.encode_texts(t, p, None)):
        starts, ids = encode(pa.array(texts), WORD)
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == want


def test_decoding_equals_the_library():
    lib = V.library_tokenizer(WORD)
    for t in FIXED + fuzz(100):
        ids = lib.encode(t, add_special_tokens=False).ids
        assert bpe.decode_ids(ids, WORD) == lib.decode(ids, skip_special_tokens=False)


def test_merging_waits_where_a_merge_of_the_new_symbol_is_earlier():
    """A vocabulary in which merging all positions of a pair at once would be wrong."""
    tokens = ["a", "b", "c", "bc", "abc", "ab", "abca"]
    ids = {t: i for i, t in enumerate(tokens)}
    pairs = [("b", "c"), ("abc", "a"), ("a", "bc")]
    left, right = (np.array([ids[p[k]] for p in pairs]) for k in (0, 1))
    merged = np.array([ids[a + b] for a, b in pairs])
    keys = (left << 32) | right
    order = np.argsort(keys)
    m = V.Merges(tokens, ids, left, right, merged, np.array([False, False, True]), keys[order], order, {}, "")
    word = [ids[c] for c in "abcabc"]
    got, lengths = bpe.merge_words(np.array(word), np.array([6]), m)
    assert [tokens[i] for i in got] == ["abca", "bc"] and lengths.tolist() == [2]


def test_prefix_counts_equal_the_library_at_every_prefix():
    lib, counter = V.library_tokenizer(BYTE), token_count.prefix_counter(BYTE)
    for t in [x[:60] for x in FIXED] + fuzz(120):
        want = [len(lib.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)]
        assert counter.prefixes(t) == want


def test_totals_equal_the_library():
    texts = FIXED + fuzz(800)
    want = [len(e.ids) for e in V.library_tokenizer(BYTE).encode_batch(texts, add_special_tokens=False)]
    assert token_count._totals(pa.array(texts), BYTE).to_pylist() == want
    plain = [t.replace("<|", "<") for t in texts]
    want = [len(e.ids) for e in V.library_tokenizer(BYTE).encode_batch(plain, add_special_tokens=False)]
    assert token_count._totals(pa.array(plain), BYTE).to_pylist() == want


def test_what_is_remembered_does_not_change_ids():
    words = T.EncodedWords(lambda ws: bpe.encode_words(ws, WORD), limit=3)
    for batch in (["aa", "bb"], ["bb", "cc", "dd"], ["dd", "aa", "ee"]):
        row, ids, lengths = words.rows(batch)
        got = ids[T.ragged_take(lengths, row)].tolist()
        assert got == bpe.encode_words(batch, WORD)[0].tolist()
    assert len(words.known) == 3


def docs_of(spark, texts):
    rows = [(i * 3, t, "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")


def test_documents_with_nulls_and_clashing_columns(spark):
    texts = [*FIXED, None]
    docs = docs_of(spark, texts).union(spark.createDataFrame([(None, "a b", None, None)], "a long, b string, c string, d int"))
    lib = V.library_tokenizer(WORD)
    got = {r["doc_id"]: r for r in bpe.digest_documents(docs, WORD).collect()}
    assert len(got) == len(texts) + 1 and got[None]["n_tokens"] == 2
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        row = got[i * 3]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    full = {r["doc_id"]: r for r in bpe.encode_documents(docs, WORD).collect()}
    assert all(full[i * 3]["ids"] == lib.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts))
    counts = {r["doc_id"]: r for r in token_count.count_documents(docs, BYTE, limit=3).collect()}
    byte = V.library_tokenizer(BYTE)
    for i, t in enumerate(texts):
        n = len(byte.encode(t or "", add_special_tokens=False).ids)
        assert tuple(counts[i * 3])[1:] == (len((t or "").encode()), n, n > 3)


def test_budget_columns(spark):
    df = docs_of(spark, ["one two three four five", None])
    table = token_count.prefix_counts(F.col("text"), BYTE)
    rows = df.select(token_count.truncate(F.col("text"), BYTE, 3).alias("cut"), table.alias("t")).withColumn(
        "ok", token_count.fits(F.col("t"), F.lit(13), 3)).collect()
    assert [r["cut"] for r in rows] == ["one two three", None]
    assert rows[0]["ok"] and rows[1]["t"] == [0]


def test_empty_tables(spark):
    empty = docs_of(spark, ["a"]).limit(0)
    assert bpe.digest_documents(empty, WORD).count() == 0
    assert token_count.count_documents(empty, BYTE).count() == 0


def test_shard_gives_any_token():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 1 << b, 700) for b in (3, 8, 9, 16, 24, 32)]).astype(np.uint32)
    rng.shuffle(ids)
    shard = token_file.Shard(token_file.encode_shard([5, None, 9], np.array([0, 10, 10, len(ids)]), ids))
    assert shard.doc_ids == [5, None, 9] and shard.all_tokens().tolist() == ids.tolist()
    assert [shard.token(i) for i in range(len(ids))] == ids.tolist()
    assert shard.tokens(10, 13).tolist() == ids[10:13].tolist()
    with pytest.raises(IndexError):
        shard.token(len(ids))
    small = token_file.Shard(token_file.encode_shard([], np.array([0]), np.zeros(0, np.uint32)))
    assert small.n_tokens == 0 and len(small.all_tokens()) == 0


@pytest.mark.parametrize("shard_tokens", [1, 40, 1 << 20])
def test_files_round_trip(spark, tmp_path, shard_tokens):
    texts = [*FIXED, None, "same", "same"]
    rows = [(97 - i, t) for i, t in enumerate(texts)] + [(50, "same"), (50, "more"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = f"file://{tmp_path}/tokens"
    token_file.write_token_files(docs, folder, WORD, shard_tokens=shard_tokens)
    got = token_file.read_token_files(spark, folder).orderBy("start").collect()
    lib = V.library_tokenizer(WORD)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want


def test_files_of_an_empty_table(spark, tmp_path):
    token_file.write_token_files(docs_of(spark, ["a"]).limit(0), f"{tmp_path}/none", WORD)
    assert token_file.read_token_files(spark, f"{tmp_path}/none").count() == 0
