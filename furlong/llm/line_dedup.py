"""Near-duplicate lines by a deletion-neighbourhood join; the earliest line stays.

A line is a copy of another if both are the same string, or if both have at
least ``min_words`` words and one word inserted, deleted or replaced makes one
the other.  The bound is one word at every length, so it is a similarity of
0.8 at five words and of 0.99 at a hundred: long lines that differ in two
words both stay.  Of all occurrences of lines, in the order of document id and
line number, one is dropped if the same line or a line within the bound occurs
before it.  Blank lines (empty or spaces only) are layout and stay.

Deletion neighbourhood: a line of n words has n variants, one with each word
left out.  Lines that differ by a replaced word have the variant without that
word, at that place, in common; a line with a word more has a variant that is
the shorter line itself.  Variants are emitted as hashed keys, equal keys are
joined, and each line found this way is verified word by word against the
earliest line of its key.  Lines of one key for a replaced word are all within
the bound of each other, so a key gives each line its earliest partner, not
all pairs: a group of any size costs a partial aggregate.

Lines that cannot have a partner emit no variants: one edited word leaves the
first or the last third of a line as it is, so only lines that share such a
part with another (counted over all distinct lines) go on.  A part that two
lines share names that pair, which is verified as it is; only lines with a part
that three or more share are expanded.  A pair within the bound shares a part,
so it is either named or both its lines are expanded, and none is lost.  Variant
hashes are running sums of word hashes, linear in a line's words.

All steps are DataFrame operations on hashes (two of 64 bits for a line); text
is read again only for the lines that are verified, and at the end to write
the result.  Small sides are broadcast after their rows have been counted and
joined by a shuffle beyond that bound; of the texts only the lines that a
broadcast bitmap lets pass are shuffled then.

Edge cases: a null text stays null; a null id comes after all ids; rows of
one id are one document when order is concerned, so equal lines at one
position of it both stay; a document may keep no line (its text is then
empty); extra columns are carried along.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .names import fresh

LINE_BITS = 31                   # of a line's number within its document
NO_ID = Decimal(1 << 63)         # stands after every id
BROADCAST_ROWS = 500_000         # of about 100 bytes each at most
MAP_BITS = 27                    # of the map that picks lines beyond that bound: 16 MB
WORD_HASH_BITS = 40              # so that sums over 2^23 words stay within a long


def _bounded(side: DataFrame, stored: bool = False) -> DataFrame:
    """``side``, checkpointed if it is not ``stored``, and marked for broadcast if it has few enough rows."""
    side = side if stored else side.checkpoint()
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def _place() -> Column:
    """Where a line stands in the order of all, from ``doc_id`` and ``line_no``."""
    return (F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(NO_ID).cast("decimal(20,0)"))
            * F.lit(1 << LINE_BITS).cast("decimal(11,0)") + F.col("line_no")).cast("decimal(38,0)")


def _mapped(lines: DataFrame, some: DataFrame) -> DataFrame:
    """The rows of ``lines`` whose h1 may be in ``some``: all that are, and few others while a map has room for them.

    The map is ``2 ** MAP_BITS`` bits in pieces of 2^15, broadcast whatever the size of ``some``.
    """
    slot = F.pmod("h1", F.lit(1 << MAP_BITS))
    piece, bit = F.shiftright(slot, 15), slot.bitwiseAND((1 << 15) - 1).cast("int")
    maps = some.groupBy(piece.alias("_piece")).agg(F.bitmap_construct_agg(bit.cast("long")).alias("_map")).checkpoint()
    byte = F.conv(F.hex(F.substring("_map", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return (lines.join(F.broadcast(maps), piece == F.col("_piece"))
            .where(F.bit_get(byte, bit.bitwiseAND(7)) == 1).drop("_piece", "_map"))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no, line and the line's hashes and place, for lines that are not blank."""
    return (docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
            .where(F.trim("line") != "")
            .select("doc_id", "text_hash", "line_no", "line", F.xxhash64("line").alias("h1"),
                    F.xxhash64(F.lit(1), "line").alias("h2"), _place().alias("at")))


def _spaced(line: Column) -> Column:
    """``line`` with one space between its words; most lines have that already."""
    odd = line.startswith(" ") | line.endswith(" ")
    for gap in ("  ", "\t", "\r", "\f", "\x0b"):
        odd = odd | line.contains(gap)
    return F.when(odd, F.trim(F.regexp_replace(line, r"\s+", " "))).otherwise(line)


def _n_words(spaced: Column) -> Column:
    return F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1


def _part_length(n: Column) -> Column:
    """Words of the first and last part that are compared: 2^k or 1.5 * 2^k, below half of n - 1, at least a third."""
    half = F.greatest(F.lit(1), F.floor((n - 1) / 2))
    power = F.pow(F.lit(2.0), F.floor(F.log2(half)))
    return F.floor(F.when((power >= 2) & (half >= 1.5 * power), 1.5 * power).otherwise(power)).cast("int")


def _part_keys(min_words: int) -> list[Column]:
    """k0 to k3 from ``spaced`` and ``n``: the first and last part, for partners of n words or more, and of one less."""
    spaced, n = F.col("spaced"), F.col("n")
    own, less = _part_length(n), _part_length(n - 1)
    keys = []
    for k, (size, applies) in enumerate(((own, n >= min_words), (less, (n >= min_words) & (less != own)))):
        for side, count in enumerate((size, -size)):
            hashed = F.xxhash64(F.lit(side), size, F.call_function("substring_index", spaced, F.lit(" "), count))
            keys.append(F.when(applies, hashed).alias(f"k{2 * k + side}"))
    return keys


def _variants(lines: DataFrame) -> DataFrame:
    """n, i, v1, v2, h1, h2, at, whole: the variants of each line, by place for replaced words and without for others."""
    order = Window.partitionBy("h1", "h2").orderBy("i")
    lines = lines.select("h1", "h2", "at", "spaced").repartition("h1", "h2")  # whole lines, which the windows then take as they lie
    lines = lines.select("h1", "h2", "at", _words("spaced").alias("words"))
    rows = lines.select("h1", "h2", "at", F.size("words").alias("n"), F.posexplode("words").alias("i", "w"))
    for s in (1, 2):
        mask = F.lit((1 << WORD_HASH_BITS) - 1)
        here = F.xxhash64(F.lit(s), "w", F.col("i")).bitwiseAND(mask)
        shifted = F.xxhash64(F.lit(s), "w", F.col("i") - 1).bitwiseAND(mask)
        rows = rows.withColumn(f"_a{s}", here).withColumn(f"_b{s}", shifted)
    whole = Window.partitionBy("h1", "h2")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    for s in (1, 2):
        left = F.coalesce(F.sum(f"_a{s}").over(before), F.lit(0))
        right = F.sum(f"_b{s}").over(whole) - F.sum(f"_b{s}").over(upto)
        rows = rows.withColumn(f"v{s}", left + right).withColumn(f"_all{s}", F.sum(f"_a{s}").over(whole))
    own = ["h1", "h2", "at"]
    forms = F.array(
        F.struct(F.col("n").alias("n"), F.col("i").alias("i"), F.col("v1").alias("v1"), F.col("v2").alias("v2"),
                 F.lit(False).alias("whole")),
        F.struct((F.col("n") - 1).alias("n"), F.lit(-1).alias("i"), F.col("v1").alias("v1"), F.col("v2").alias("v2"),
                 F.lit(False).alias("whole")),
        F.when(F.col("i") == 0, F.struct(F.col("n").alias("n"), F.lit(-1).alias("i"), F.col("_all1").alias("v1"),
                                         F.col("_all2").alias("v2"), F.lit(True).alias("whole"))))
    return rows.select(*own, F.explode(forms).alias("f")).where("f is not null").select(*own, "f.*")


def _within_one_word(a: Column, b: Column) -> Column:
    """Whether one replaced, inserted or deleted word makes the words a the words b."""
    short, long = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)
    differs = F.zip_with(short, F.slice(long, 1, F.size(short)), lambda x, y: x != y)
    at = F.array_position(differs, True).cast("int")  # from 1; 0 for none
    n = F.size(short)
    rest = F.lit(1 << 30)
    replaced = (n == F.size(long)) & ((at == 0) | (
        F.slice(short, at + 1, rest) == F.slice(long, at + 1, rest)))
    inserted = (n + 1 == F.size(long)) & ((at == 0) | (
        F.slice(short, F.greatest(at, F.lit(1)), rest) == F.slice(long, at + 1, rest)))
    return replaced | inserted


def _words(spaced: str) -> Column:
    return F.split(F.col(spaced), " ")


def _shared_parts(distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines that share a part with another: pairs x, y by h1, where two do, and h1 of the lines to expand."""
    key_rows = distinct.select("h1", F.explode("keys").alias("key"))
    parts = key_rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("h1").alias("x"), F.max("h1").alias("y"))
    parts = parts.where("n > 1").checkpoint()
    pairs = parts.where("n = 2").select("x", "y").distinct().checkpoint()
    crowded = _bounded(parts.where("n > 2").select("key"))
    return pairs, key_rows.join(crowded, "key").select("h1").distinct().checkpoint()


def _pair_limits(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """h1, h2, limit: the later line of each pair within the bound, and where the earlier stands."""
    a = lines.select(F.col("h1").alias("x"), F.col("h2").alias("x2"), F.col("at").alias("x_at"), F.col("spaced").alias("x_spaced"))
    b = lines.select(F.col("h1").alias("y"), F.col("h2").alias("y2"), F.col("at").alias("y_at"), F.col("spaced").alias("y_spaced"))
    first = F.col("x_at") < F.col("y_at")
    later = [F.when(first, F.col(y)).otherwise(F.col(x)) for x, y in (("x", "y"), ("x2", "y2"))]
    return (a.join(_bounded(pairs, stored=True), "x").join(b, "y").where("x_at != y_at")
            .where(_within_one_word(_words("x_spaced"), _words("y_spaced")))
            .select(later[0].alias("h1"), later[1].alias("h2"), F.least("x_at", "y_at").alias("limit")))


def _variant_limits(lines: DataFrame) -> DataFrame:
    """h1, h2, limit: lines with an earlier one within the bound among ``lines``, and where partners found stand."""
    key = ["n", "i", "v1", "v2"]
    variants = _variants(lines)
    groups = variants.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"), F.min("at").alias("least"), F.max("at").alias("most"),
        F.min(F.when(F.col("whole"), F.col("at"))).alias("least_whole"),
        F.min(F.when(~F.col("whole"), F.col("at"))).alias("least_cut"),
        F.count_if("whole").alias("n_whole"))
    # A key of a deleted word links lines only if one of them is that variant as a whole.
    groups = groups.where("rows > 1 and (i >= 0 or (n_whole > 0 and n_whole < rows))").checkpoint()
    two = groups.where("rows = 2").select(F.col("most").alias("at"), F.col("least").alias("partner"))
    more = _bounded(groups.where("rows > 2").select(*key, "least", "least_whole", "least_cut"))
    partner = F.when(F.col("i") >= 0, F.col("least")).when(F.col("whole"), F.col("least_cut")).otherwise(
        F.col("least_whole"))
    met = two.union(variants.join(more, key).select("at", partner.alias("partner")).where("partner < at"))
    a = lines.select("h1", "h2", "at", "spaced")
    b = lines.select(F.col("at").alias("partner"), F.col("spaced").alias("partner_spaced"))
    return (met.distinct().join(a, "at").join(b, "partner")
            .where(_within_one_word(_words("spaced"), _words("partner_spaced")))
            .select("h1", "h2", F.col("partner").alias("limit")))


def _near_lines(docs: DataFrame, distinct: DataFrame, min_words: int) -> DataFrame:
    """h1, h2, limit: lines with an earlier line within the bound, and where the earliest such line found stands."""
    pairs, crowded = _shared_parts(distinct)
    some = pairs.select(F.col("x").alias("h1")).union(pairs.select("y")).union(crowded).distinct().checkpoint()
    lines = _lines(docs)
    if some.count() > BROADCAST_ROWS:
        lines = _mapped(lines, some)  # before their text is shuffled
    # an inner join with the distinct rows, as Spark would move a semi-join below the map's
    lines = (lines.join(_bounded(some, stored=True), "h1").groupBy("h1", "h2", "line").agg(F.min("at").alias("at"))
             .withColumn("spaced", _spaced(F.col("line"))).where(_n_words(F.col("spaced")) >= min_words)
             .select("h1", "h2", "at", "spaced").checkpoint())
    expanded = lines.join(_bounded(crowded, stored=True), "h1", "left_semi")
    found = _pair_limits(lines, pairs).union(_variant_limits(expanded))
    return found.groupBy("h1", "h2").agg(F.min("limit").alias("limit"))


def dropped_lines(docs: DataFrame, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, dropped: the sorted numbers, from 0, of the lines that go, for texts that lose any."""
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    lines = _lines(docs)
    keyed = lines.withColumn("spaced", _spaced(F.col("line"))).withColumn("n", _n_words(F.col("spaced")))
    distinct = (keyed.select("h1", "h2", "at", *_part_keys(min_words))
                .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("at"),
                                         *[F.max(f"k{k}").alias(f"k{k}") for k in range(4)])
                .select("h1", "h2", "rows", "at",
                        F.array_compact(F.array(*[f"k{k}" for k in range(4)])).alias("keys")).checkpoint())
    near = _near_lines(docs, distinct, min_words)
    copies = distinct.where("rows > 1").select("h1", "h2", F.col("at").alias("limit"))
    limits = copies.union(near).groupBy("h1", "h2").agg(F.min("limit").alias("limit"))
    return (lines.select("doc_id", "text_hash", "line_no", "h1", "h2").join(limits, ["h1", "h2"])
            .where(_place() > F.col("limit")).groupBy("doc_id", "text_hash")
            .agg(F.array_sort(F.collect_set("line_no")).alias("dropped")))


def drop_lines(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               out_col: str = "_dropped") -> DataFrame:
    """``docs`` with the dropped lines taken out of their texts, and their numbers as the array ``out_col``."""
    key, check = fresh(docs.columns, "_key"), fresh(docs.columns, "_check")
    gone = dropped.select(F.col("doc_id").alias(key), F.col("text_hash").alias(check), F.col("dropped").alias(out_col))
    joined = docs.join(gone, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(check)), "left")
    lines = F.split(text_col, "\n", -1)
    starts = F.concat(F.array(F.lit(-1)), out_col)
    stops = F.concat(out_col, F.array(F.size(lines)))
    kept = F.flatten(F.zip_with(starts, stops, lambda a, b: F.slice(lines, a + 2, b - a - 1)))
    text = F.when(F.col(out_col).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns], out_col)


def dedup_lines(docs: DataFrame, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, with the lines dropped that are copies of earlier ones."""
    out_col = fresh(docs.columns, "_dropped")
    dropped = dropped_lines(docs, min_words, id_col, text_col)
    return drop_lines(docs, dropped, id_col, text_col, out_col).drop(out_col)
