"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs (lines).  Each paragraph is
hashed to two wide vectors, and a document's vectors are the sums over its
paragraphs, lane by lane, modulo a power of two:

* ``wide``: 8 lanes modulo 2^32, hashed from the whole paragraph.  It decides
  equality: the same paragraphs in any order give the same vector.
* ``near``: 126 lanes modulo 2^32, of which 16 bits are spelled.  A paragraph's vector is the sum of a 0/1
  vector hashed from each of its sentences, so a paragraph that is edited in
  part keeps part of its vector.  With ``n``, the number of sentences, twice a
  lane less ``n`` is a sum of random signs, and the mean product of two
  documents' lanes estimates the sentences that they share.

Sums can be taken apart: ``add`` and ``subtract`` insert or delete paragraphs
without the document's text.

The main path is DataFrame operations only.  Documents are dealt once, by
ranges of their ids, so that the next document is in the same partition; a
range also gets the first document of the next one.  Everything after that
(edited texts, exploded sentences, sums, the next document's vectors) stays
in that partition.  Sentence vectors are summed three lanes to a long, 21 bits
a lane, in blocks of 2^20 sentences, which cannot carry over; the upper and
the lower bits of the blocks' lanes are then summed apart.

Edge cases: a null text is the empty text, which has one empty paragraph; a
null id comes before all ids; rows of one id are ordered by text and each has
its own result; a table of one row is its own next document; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import with_next

WIDE_SEEDS = (11, 12, 13, 14)    # two lanes of 32 bits each
NEAR_SEEDS = (21, 22)            # 63 lanes of one bit each
NEAR_BITS, NEAR_FIELD = 32, 21
SPELLED_BITS = 16                # of a near lane
FIELDS = 63 // NEAR_FIELD        # lanes summed in one long
ONES = sum(1 << (NEAR_FIELD * f) for f in range(FIELDS))
LOW_BITS = 10                    # of a block's lane; its upper 11 and these leave room for 2^11 blocks
LOW = sum(((1 << LOW_BITS) - 1) << (NEAR_FIELD * f) for f in range(FIELDS))
HIGH = sum(((1 << (NEAR_FIELD - LOW_BITS)) - 1) << (NEAR_FIELD * f) for f in range(FIELDS))
BLOCK = 20                       # sentences in a block, as a power of two
SENTENCE_END = r"\n|(?<=[.!?]) "


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def sentences(text: Column) -> Column:
    return F.split(text, SENTENCE_END, -1)


def _hash(text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), text)


def _part_sums(part: Column, whole: Column, sentence: Column) -> list[Column]:
    """Sums of the lanes hashed from parts; ``whole`` and ``sentence`` say which lanes a part counts for."""
    out = []
    for s in WIDE_SEEDS:
        h = F.when(whole, _hash(part, s)).otherwise(F.lit(0).cast("long"))
        out += [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))]
    for s in NEAR_SEEDS:
        h = F.when(sentence, _hash(part, s)).otherwise(F.lit(0).cast("long"))
        out += [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(ONES))) for i in range(NEAR_FIELD)]
    return [c.alias(f"s{i}") for i, c in enumerate(out)]


N_WIDE, N_NEAR = 2 * len(WIDE_SEEDS), NEAR_FIELD * len(NEAR_SEEDS)
SUMS = [f"s{i}" for i in range(N_WIDE + N_NEAR)]


def _folded() -> list[Column]:
    """Sums of the block sums, wide lanes modulo 2^32 and near ones in two parts."""
    wide = [F.sum(F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))).alias(c) for c in SUMS[:N_WIDE]]
    low = [F.sum(F.col(c).bitwiseAND(F.lit(LOW))).alias(c) for c in SUMS[N_WIDE:]]
    high = [F.sum(F.shiftrightunsigned(c, LOW_BITS).bitwiseAND(F.lit(HIGH))).alias(f"{c}_high") for c in SUMS[N_WIDE:]]
    return wide + low + high


def _vectors() -> Column:
    """The struct (wide, near, n) of a row of sums."""
    wide = F.array(*[F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)) for c in SUMS[:N_WIDE]])
    field = F.lit((1 << NEAR_FIELD) - 1).cast("long")
    near = F.flatten(F.zip_with(F.array(*SUMS[N_WIDE:]), F.array(*[f"{c}_high" for c in SUMS[N_WIDE:]]), lambda x, y: F.array(
        *[F.shiftrightunsigned(x, NEAR_FIELD * f).bitwiseAND(field)
          + F.shiftleft(F.shiftrightunsigned(y, NEAR_FIELD * f).bitwiseAND(field), LOW_BITS) for f in range(FIELDS)])))
    return F.struct(wide.alias("wide"), near.alias("near"), F.col("n").alias("n"))


def vectors(docs: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """For each row of ``docs``, whose ``keys`` are unique, and each of ``texts``: keys, which, vector.

    The sums need no exchange where ``docs`` is already dealt by some of ``keys``.
    """
    lists = [f(F.coalesce(F.col(t), F.lit(""))) for t in texts for f in (paragraphs, sentences)]
    parts = (docs.select(*keys, F.posexplode(F.array(*lists)).alias("_list", "_parts"))
             .select(*keys, "_list", F.posexplode("_parts").alias("_at", "_part")))
    whole = F.col("_list") % 2 == 0
    block = F.shiftright("_at", BLOCK).alias("_block")
    which = (F.col("_list") / 2).cast("int").alias("which")
    sums = (parts.groupBy(*keys, which, block)
            .agg(F.sum(F.when(whole, 0).otherwise(1)).alias("n"), *_part_sums(F.col("_part"), whole, ~whole))
            .groupBy(*keys, "which").agg(F.sum("n").alias("n"), *_folded()))
    return sums.select(*keys, "which", _vectors().alias("vector"))


def text_vector(text: Column) -> Column:
    """The vector of one text as an expression, for inserting and deleting a few paragraphs."""
    def lanes(parts, seed, bits, lane):
        return F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: (
            acc + F.shiftrightunsigned(_hash(p, seed), lane * bits).bitwiseAND(F.lit((1 << bits) - 1))))

    lines, sents = paragraphs(F.coalesce(text, F.lit(""))), sentences(F.coalesce(text, F.lit("")))
    wide = [lanes(lines, s, 32, i) for s in WIDE_SEEDS for i in range(2)]
    near = [lanes(sents, s, 1, i + NEAR_FIELD * f) for s in NEAR_SEEDS for i in range(NEAR_FIELD) for f in range(FIELDS)]
    return F.struct(F.array(*[w.bitwiseAND(F.lit(0xFFFFFFFF)) for w in wide]).alias("wide"),
                    F.array(*[n.bitwiseAND(F.lit(0xFFFFFFFF)) for n in near]).alias("near"),
                    F.size(sents).cast("long").alias("n"))


def _lanewise(a: Column, b: Column, sign: int) -> Column:
    def lanes(name: str, bits: int) -> Column:
        return F.zip_with(a[name], b[name], lambda x, y: F.pmod(x + sign * y, F.lit(1 << bits))).alias(name)

    return F.struct(lanes("wide", 32), lanes("near", NEAR_BITS), (a["n"] + sign * b["n"]).alias("n"))


def add(a: Column, b: Column) -> Column:
    """The vector of the paragraphs of both."""
    return _lanewise(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    """The vector of a's paragraphs without b's, which must be among them."""
    return _lanewise(a, b, -1)


def spelled(vector: Column) -> Column:
    """A vector as text: its lanes in hex, near ones modulo 2^16."""
    def hexed(lanes, digits):
        return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), digits, "0")), "")

    near = F.transform(vector["near"], lambda x: x.bitwiseAND(F.lit((1 << SPELLED_BITS) - 1)))
    return F.concat(hexed(vector["wide"], 8), hexed(near, SPELLED_BITS // 4))


def _product(a: Column, b: Column) -> Column:
    lanes = F.zip_with(a["near"], b["near"], lambda x, y: (2 * x - a["n"]).cast("double") * (2 * y - b["n"]))
    return F.aggregate(lanes, F.lit(0.0), lambda acc, x: acc + x)


def likeness(a: Column, b: Column) -> Column:
    """The estimated share of sentences in common, 0 to 1; 1 for equal vectors."""
    size = _product(a, a) + _product(b, b)
    return F.when(size == 0, F.when(a == b, 1.0).otherwise(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * _product(a, b) / size)))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row.

    The edited text has its last half (rounded down) replaced by as many first
    characters of the next document in id order; the first follows the last.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", "text")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left(F.coalesce("next_text", F.lit("")), half))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["bucket", "place", "own", "doc_id", "n_chars", "edited_sha256"]
    both = vectors(rows, keys, ["text", "edited"])
    order = Window.partitionBy("bucket").orderBy("place", "which")
    v, e, after = F.col("vector"), F.col("edited_vector"), F.col("next_vector")
    return (both.withColumn("edited_vector", F.lead("vector", 1).over(order))
            .withColumn("next_vector", F.lead("vector", 2).over(order))
            .where((F.col("which") == 0) & F.col("own"))
            .select("doc_id", "n_chars", "edited_sha256", spelled(v).alias("fingerprint"),
                    spelled(e).alias("edited_fingerprint"), likeness(v, e).alias("near_edited"),
                    likeness(v, after).alias("near_next")))
