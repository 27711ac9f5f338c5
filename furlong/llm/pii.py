"""Personal identifiers: fixed patterns first, then bootstrapped contextual extraction.

Base spans are the leftmost, non-overlapping matches of four patterns (email,
ip, card, phone) that pass their checks.  They are the seeds.  Every seed
value and every looser candidate (text of a kind's shape that its pattern or
check leaves out) occurs in lexical contexts: the word before, the two words
before, the word after, the words on both sides.  A context has a letter: marks
and numbers alone are no lexical pattern.  Contexts are the patterns
of a bipartite pattern-instance graph, which Spark scores in rounds:

* a pattern's confidence for a kind is that kind's share of the scores of the
  distinct values met in it, so it is lowered by seeds and trusted values of
  other kinds.  What a value lacks of score 1 is no evidence against a kind and
  counts ``unseen`` of a value, which only matters where such values are many.
  A string counts once, whatever number of kinds it has the shape of.  The
  pattern needs ``min_seeds`` distinct seed values of that kind;
* a candidate's score is the noisy-or of the confidences of its patterns of
  at least ``trust``.

Seeds keep score 1.  After the last round, candidates of at least ``accept``
are added to the spans.  Base spans always stay.

Offsets are code points, found without positions from the regex engine: the
pieces between matches and the matches have lengths, and a running sum of both
is where a match starts.  The patterns are those of the contract with
possessive repeats, which match the same text without deep backtracking.

All steps are DataFrame operations.  Documents without a digit or @ are
passed over by plain searches; only contexts and offsets are shuffled, never
texts.  Edge cases: a null text is the empty text; rows that repeat an id and
a text all get the same result; a table without matches, or an empty one, has
no patterns and no added spans; text in any script may surround a match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 200                    # code points kept on each side of a match; a word that is cut there is none

# Fixed patterns: \G is where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser shapes of the same kinds, whose matches only count in a trusted context.
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\(at\)|\[at\])[A-Za-z0-9.-]*+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:[.:][0-9]++){2,7}+",
    "card": r"[0-9](?:[\x20.-]?+[0-9]){11,18}+",
    "phone": r"\(?[0-9][\x20().0-9-]{5,18}[0-9]",
}
# Plain searches that a text must pass before a pattern of the kind is tried.
HINT = {"email": r"@|\(at\)|\[at\]", "ip": r"[0-9][.:][0-9]", "card": r"[0-9][\x20.-]?[0-9]", "phone": r"[0-9][\x20().0-9-]"}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the checksum over the digits, every second from the right doubled, ends in 0."""
    def weight(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).when(twice > 9, twice - 9).otherwise(twice)

    parts = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), weight)
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    n = F.length(digits)
    small = F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) < 3) | (
        (F.length(F.ltrim(p, F.lit("0"))) == 3) & (F.ltrim(p, F.lit("0")) <= "255")))
    return (F.when(kind == "ip", small).when(kind == "card", n.between(14, 19) & _luhn(digits))
            .when(kind == "phone", n.between(10, 15)).otherwise(F.lit(True)))


def _matches(docs: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """doc_id, text_hash, kind, start, end, value, left, right: every match of each kind's pattern."""
    found = []
    for kind in KINDS:
        text, pattern = F.col("text"), F.lit(patterns[kind])
        pieces = F.split(text, pattern, -1)
        rows = F.zip_with(pieces, F.regexp_extract_all(text, pattern, 0), lambda p, m: F.struct(
            F.length(p).alias("gap"), F.right(p, F.lit(CONTEXT + 1)).alias("left"), m.alias("value")))
        after = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: F.left(p, F.lit(CONTEXT + 1)))
        rows = F.zip_with(rows, after, lambda r, a: F.struct(
            r["gap"].alias("gap"), r["left"].alias("left"), r["value"].alias("value"), a.alias("right")))
        found.append(F.struct(F.lit(kind).alias("kind"), F.when(F.regexp(text, F.lit(HINT[kind])), rows).alias("rows")))
    rows = (docs.select("doc_id", "text_hash", "row", F.explode(F.array(*found)).alias("f"))
            .select("doc_id", "text_hash", "row", "f.kind", F.posexplode("f.rows").alias("at", "r"))
            .select("doc_id", "text_hash", "row", "kind", "at", "r.*").where("value is not null"))
    order = Window.partitionBy("doc_id", "text_hash", "row", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.length("value")).over(order)
    # rows that repeat an id and a text have the same matches, which are one here
    return rows.withColumn("end", end).select(
        "doc_id", "text_hash", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", "left", "right").distinct()


def _contexts(rows: DataFrame) -> DataFrame:
    """kind, value, context: the lexical patterns in which each value was met."""
    # a piece longer than CONTEXT loses its outermost word, which may be cut
    left = F.when(F.length("left") > CONTEXT, F.regexp_replace("left", r"^\S*", "")).otherwise(F.col("left"))
    right = F.when(F.length("right") > CONTEXT, F.regexp_replace("right", r"\S*$", "")).otherwise(F.col("right"))
    left = F.filter(F.split(F.lower(left), r"\s+"), lambda w: w != "")
    right = F.filter(F.split(F.lower(right), r"\s+"), lambda w: w != "")
    before = F.coalesce(F.try_element_at(left, F.lit(-1)), F.lit("^"))
    before2 = F.coalesce(F.try_element_at(left, F.lit(-2)), F.lit("^"))
    after = F.coalesce(F.get(right, F.lit(0)), F.lit("$"))
    contexts = F.array(F.concat(before, F.lit(" _")), F.concat(F.lit("_ "), after),
                       F.concat(before2, F.lit(" "), before, F.lit(" _")), F.concat(before, F.lit(" _ "), after))
    lexical = F.filter(contexts, lambda c: F.regexp(c, F.lit(r"\p{L}")))
    return rows.select("kind", "value", "seed", F.explode(lexical).alias("context")).distinct()


def trusted_values(seeds: DataFrame, candidates: DataFrame, rounds: int = 3, min_seeds: int = 3, trust: float = 0.8,
                   accept: float = 0.9, unseen: float = 0.1) -> DataFrame:
    """kind, value: the candidate values that the scored graph accepts."""
    instances = seeds.withColumn("seed", F.lit(True)).unionByName(candidates.withColumn("seed", F.lit(False)))
    edges = _contexts(instances).checkpoint()
    met = edges.select("context", "value").distinct()
    score = edges.select("kind", "value", "seed").distinct().groupBy("kind", "value").agg(
        F.max(F.col("seed").cast("double")).alias("score"))
    pattern_edges = edges.where("not seed")
    for _ in range(rounds):
        known = score.groupBy("value").agg(F.max("score").alias("known"))
        weight = F.col("known") + F.lit(unseen) * (1 - F.col("known"))
        evidence = met.join(known, "value").groupBy("context").agg(F.round(F.sum(weight), 9).alias("evidence"))
        confidence = (edges.join(score, ["kind", "value"]).groupBy("context", "kind")
                      .agg(F.round(F.sum("score"), 9).alias("total"),
                           F.count_distinct(F.when(F.col("seed"), F.col("value"))).alias("n_seeds"))
                      .where(F.col("n_seeds") >= min_seeds).join(evidence, "context")
                      .select("context", "kind", (F.col("total") / F.col("evidence")).alias("confidence"))
                      .where(F.col("confidence") >= trust))
        miss = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-12))))
        found = (pattern_edges.join(confidence, ["context", "kind"]).groupBy("kind", "value")
                 .agg(F.round(1 - F.exp(miss), 9).alias("found")))
        score = (score.join(found, ["kind", "value"], "left")
                 .select("kind", "value", F.greatest("score", F.coalesce("found", F.lit(0.0))).alias("score"))
                 .checkpoint())
    return score.where(F.col("score") >= accept).join(
        candidates.select("kind", "value").distinct(), ["kind", "value"], "left_semi").select("kind", "value")


def _spelled(spans: Column) -> Column:
    order = {k: i for i, k in enumerate(KINDS)}
    place = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_identifiers(docs: DataFrame, rounds: int = 3, min_seeds: int = 3, trust: float = 0.8, accept: float = 0.9,
                     unseen: float = 0.1, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(base, added)``: doc_id, text_hash, kind, start, end, value of base spans and of discovered ones."""
    ensure_checkpoint_dir(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.where(F.regexp("text", F.lit("[0-9@]|\\(at\\)|\\[at\\]"))).withColumns(
        {"text_hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    base = _matches(texts, BASE).where(_valid(F.col("kind"), F.col("value"))).checkpoint()
    taken = base.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("taken"))
    loose = _matches(texts, LOOSE).join(taken.select(F.col("doc_id").alias("t_id"), F.col("text_hash").alias("t_hash"), "taken"),
                                        F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("text_hash") == F.col("t_hash")), "left")
    loose = loose.where(~F.coalesce(F.exists("taken", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start"))),
                                    F.lit(False))).select(base.columns).checkpoint()
    values = trusted_values(base, loose, rounds, min_seeds, trust, accept, unseen)
    return base, loose.join(values, ["kind", "value"], "left_semi").select(base.columns)


def identifier_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row per row of ``docs``."""
    base, added = find_identifiers(docs, id_col=id_col, text_col=text_col, **settings)
    spans = base.withColumn("base", F.lit(True)).unionByName(added.withColumn("base", F.lit(False)))
    span = F.struct("kind", "start", "end")
    per_doc = spans.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        _spelled(F.collect_list(F.when(F.col("base"), span))).alias("base_spans"),
        _spelled(F.collect_list(span)).alias("spans"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("_row_hash"))
    joined = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row_hash") == F.col("_hash")), "left")
    return joined.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
                         F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
                         F.coalesce("spans", F.lit("")).alias("spans"))
