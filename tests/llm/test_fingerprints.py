"""SimHash, document fingerprints and line dedup against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF01
from furlong.llm import fingerprint, line_dedup, queries, simhash
from furlong.llm.components import connected_components


def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, bits=4):
    fps, parent = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= bits).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        if x is not None and (least.get(r) is None or x < least[r]):
            least[r] = x
    return [least.get(find(i)) for i in range(len(fps))]


def test_simhash_of_all_documents_equals_brute_force(spark):
    got = queries.op5_simhash_near_duplicates(spark, SF01).orderBy("doc_id").collect()
    docs = queries.documents(spark, SF01).orderBy("doc_id").collect()
    fps = [brute_fingerprint(d["text"]) for d in docs]
    assert [r["fingerprint"] for r in got] == [f"{f:016x}" for f in fps]
    assert [r["component_id"] for r in got] == brute_components(fps, [d["doc_id"] for d in docs])


def test_simhash_edge_cases(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, base), (7, base + " tail"), (8, base),
            (8, base), (None, base), (None, "alone here"), (9, "É é x y z"), (10, "x" * 100000)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, fp int").repartition(4)
    got = simhash.near_duplicates(docs).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    want = brute_components(fps, [i for i, _ in rows])
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=key) == sorted(
        zip([i for i, _ in rows], fps, want), key=key)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 4, 6, 9, 10, None], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    tied = spark.createDataFrame([(1, base), (1, base + " tail"), (1, "other text"), (None, "n"), (None, "n")], "doc_id long, text string")
    assert simhash.keep_first(tied).count() == 3


@pytest.mark.parametrize("limit", [8, 64, 100000])
def test_dense_groups_lose_no_link(spark, limit):
    rng = np.random.default_rng(limit)
    fps = set()
    for centre in rng.integers(0, 1 << 62, 3).tolist():
        for _ in range(120):
            x = centre
            for b in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(np.array(sorted(fps), np.uint64).view(np.int64).tolist())
    df = spark.createDataFrame([(x,) for x in fps], "fp long").repartition(3)
    got = {r["node"]: r["root"] for r in connected_components(simhash.links(df, 4, limit)).collect()}
    want = brute_components(np.array(fps).view(np.uint64), fps)
    assert [got.get(x, x) for x in fps] == want


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (300, 200), (200, 300)]
    got = {r["node"]: r["root"] for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 150)}, 200: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def edited(text, after):
    m = len(text) // 2
    return text[:len(text) - m] + after[:m]


def test_edited_texts_and_likeness(spark):
    texts = ["a\nb. c d\ne", None, "", "p. q. r. s. t. u", "é漢😀x", "same", "same", "x" * 5000]
    rows = [(10 * (len(texts) - i), t) for i, t in enumerate(texts)] + [(None, "no id"), (20, "tie b"), (20, "tie a")]
    docs = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, n_chars int").repartition(3)
    got = fingerprint.fingerprint_documents(docs).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(order):
        e = edited(t, order[(k + 1) % len(order)][1])
        want.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    by_print = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["fingerprint"] == r["edited_fingerprint"]:
            assert r["near_edited"] == 1
        by_print.setdefault(r["fingerprint"], set()).add(r["n_chars"])
    assert all(len(v) == 1 for v in by_print.values())
    assert fingerprint.fingerprint_documents(docs.limit(0)).count() == 0
    one = fingerprint.fingerprint_documents(docs.where("doc_id = 80")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1


def test_order_does_not_matter_and_sums_come_apart(spark):
    v = fingerprint.text_vector
    row = spark.range(1).select(
        fingerprint.spelled(v(F.lit("a b. c\nd\ne"))).alias("x"), fingerprint.spelled(v(F.lit("e\nd\na b. c"))).alias("y"),
        fingerprint.spelled(v(F.lit("e\nd\na b. x"))).alias("z"),
        fingerprint.spelled(fingerprint.add(v(F.lit("e")), v(F.lit("a b. c\nd")))).alias("sum"),
        fingerprint.spelled(fingerprint.subtract(v(F.lit("q\na b. c\nd\ne")), v(F.lit("q")))).alias("less")).first()
    assert row["x"] == row["y"] == row["sum"] == row["less"] != row["z"]


def test_exploded_sums_equal_the_expression(spark):
    docs = spark.createDataFrame([(1, "a. b\nc"), (2, ""), (3, "x\n" * 300)], "k int, text string")
    got = {r["k"]: r["s"] for r in fingerprint.vectors(docs, ["k"], ["text"]).select(
        "k", fingerprint.spelled(F.col("vector")).alias("s")).collect()}
    want = {r["k"]: r["s"] for r in docs.select("k", fingerprint.spelled(
        fingerprint.text_vector(F.col("text"))).alias("s")).collect()}
    assert got == want


def test_likeness_follows_the_shared_half(spark):
    rows = queries.op7_document_fingerprints(spark, SF01).collect()
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, SF01).collect()}
    prints = {}
    for r in rows:
        assert prints.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    assert len(set(prints.values())) == len(prints)
    long = [r for r in rows if r["n_chars"] > 1000]
    assert sum(r["near_edited"] > r["near_next"] + 0.15 for r in long) > 0.9 * len(long)


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(rows, min_words=5):
    places = sorted(((i is None, i or 0, k), line, (i, t)) for i, t in rows if t is not None
                    for k, line in enumerate(t.split("\n")))
    first = {}
    for at, line, _ in places:
        first.setdefault(line, at)
    words = {line: line.split() for line in first}
    keep = {}
    for line, at in first.items():
        near = [first[x] for x in first if len(words[line]) >= min_words <= len(words[x]) and x.strip()
                and abs(len(words[x]) - len(words[line])) <= 1 and word_edits(words[x], words[line]) <= 1]
        keep[line] = min([at, *near])
    return [(i, None if t is None else "\n".join(
        line for k, line in enumerate(t.split("\n")) if not line.strip() or (i is None, i or 0, k) <= keep[line]))
        for i, t in rows]


def line_rows():
    rng = np.random.default_rng(4)
    base = [" ".join(rng.choice(["aa", "bb", "cc", "dd", "ee"], rng.integers(1, 14))) for _ in range(30)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.integers(1, 7)):
            w = base[rng.integers(len(base))].split()
            for _ in range(rng.integers(0, 3)):
                k = rng.integers(len(w) + 1)
                w[k:k + rng.integers(0, 2)] = rng.choice(["zz", "aa", "new"], rng.integers(0, 2)).tolist()
            lines.append(" ".join(w))
        rows.append((i, "\n".join(lines)))
    return rows + [(100, None), (101, ""), (102, "\n\n \n"), (None, base[0] + "\nonly here in this table now"),
                   (103, "item 1 of the long list\nitem 2 of the long list\nitem 3 of the long list"),
                   (104, "x " * 5000), (105, "x " * 5001), (106, "a\tb  c d e"), (107, "a b c d e")]


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    docs = spark.createDataFrame([(i, t, "h") for i, t in rows], "doc_id long, text string, h1 string").repartition(4)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(brute_lines(rows), key=str)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_rows_of_one_id_are_one_document(spark):
    docs = spark.createDataFrame([(1, "p\nq"), (1, "p\nq"), (1, "r\np"), (2, "q\nz")], "doc_id long, text string")
    got = sorted(r["text"] for r in line_dedup.dedup_lines(docs).collect())
    assert got == ["p\nq", "p\nq", "r", "z"]


def test_lines_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_lines(docs).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(brute_lines(rows), key=str)


@pytest.mark.parametrize("bound", [0, 500_000])
def test_only_lines_of_crowded_parts_are_expanded(spark, monkeypatch, bound):
    """Two lines of one part are verified as a pair; variants, most of the shuffle, are for parts of three or more."""
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", bound)
    rng = np.random.default_rng(12)
    expanded = []
    variants = line_dedup._variants

    def counted(lines):
        expanded.append(lines.count())
        return variants(lines)

    monkeypatch.setattr(line_dedup, "_variants", counted)

    def edited(words, k):
        at = int(rng.integers(len(words)))
        return words[:at] + [["new"], [], ["new", words[at]]][k % 3] + words[at + 1:]

    def line(k):
        return [f"w{k}x{j}" for j in range(int(rng.integers(8, 20)))]

    rows = []
    for k in range(40):  # groups of two: an edited word, or a second that makes them differ
        base = line(k)
        other = edited(base, k)
        rows += [base, other if k % 4 else edited(other, k + 1)]
    for k in range(40, 44):  # groups of six, from one base, that edits of different words tell apart
        base = line(k)
        rows += [base, *(edited(base, j) for j in range(5))]
    order = rng.permutation(len(rows)).tolist()
    rows = [(i, " ".join(rows[j])) for i, j in enumerate(order)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(brute_lines(rows))
    assert 0 < expanded[0] <= 24


def test_the_map_of_lines_loses_none_and_lets_few_others_pass(spark):
    lines = spark.range(200_000).select("id", F.xxhash64("id").alias("h1"))
    some = lines.where("id % 20 = 0").select("h1")
    got = line_dedup._mapped(lines, some)
    assert got.columns == ["id", "h1"]
    got = [r["id"] for r in got.collect()]
    assert len(got) == len({*got}) and {*range(0, 200_000, 20)} <= {*got} and len(got) < 10_100
    assert line_dedup._mapped(lines, some.limit(0)).count() == 0


def test_line_query_equals_its_sql(spark, duck):
    columns, rows, _ = duck(queries.oracle_sql()["op4_line_dedup"])
    got = queries.op4_line_dedup(spark, SF01).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(rows)


def test_likeness_of_very_long_texts(spark):
    """Beyond 2^17 sentences, and beyond a block of 2^20."""
    def text(name, n):
        return "\n".join(f"{name}{i}" for i in range(n))

    n = 210_000
    rows = [(1, text("a", n)), (2, text("b", n)), (3, text("a", n // 2) + "\n" + text("c", n // 2)), (4, text("d", 500)),
            (5, "\n" * n), (6, "\n" * (n // 2) + text("e", n // 2)), (7, "\n" * 2_200_000)]
    docs = spark.createDataFrame(rows, "k int, text string").repartition(7)
    got = fingerprint.vectors(docs, ["k"], ["text"]).select("k", "vector").cache()
    a, b = (got.select(F.col("k").alias(k), F.col("vector").alias(v)) for k, v in (("x", "v"), ("y", "w")))
    like = {(r["x"], r["y"]): r["z"] for r in a.join(b, F.col("x") <= F.col("y")).select(
        "x", "y", fingerprint.likeness(F.col("v"), F.col("w")).alias("z")).collect()}
    assert all(like[k, k] == 1 for k in range(1, 8))
    assert like[1, 2] < .35 and like[1, 4] < .35 and like[2, 3] < .35  # noise of 126 lanes
    assert .25 < like[1, 3] < .75
    assert .6 < like[5, 6] < .95  # 2 pq / (pp + qq) with half of the repeats
    v = {r["k"]: r["vector"] for r in got.where("k in (5, 7)").collect()}
    assert all(x in (0, 2_200_001) for x in v[7]["near"]) and [x > 0 for x in v[5]["near"]] == [x > 0 for x in v[7]["near"]]


@pytest.mark.parametrize("limit", [8, 100000])
def test_dense_groups_lose_no_link_of_an_odd_distance(spark, limit):
    rng = np.random.default_rng(1)
    fps = set()
    for centre in rng.integers(0, 1 << 62, 6).tolist():  # one is 5 bits from each of the eight, in long lists only
        group = [centre ^ (1 << k) for k in range(8)]
        fps |= {*group, centre ^ sum(1 << b for b in (40, 48, 56, 57)), centre ^ sum(1 << b for b in (20, 28, 33, 41, 50))}
    fps = sorted(np.array(sorted(fps), np.uint64).view(np.int64).tolist())
    df = spark.createDataFrame([(x,) for x in fps], "fp long").repartition(3)
    got = {r["node"]: r["root"] for r in connected_components(simhash.links(df, 5, limit)).collect()}
    assert [got.get(x, x) for x in fps] == brute_components(np.array(fps).view(np.uint64), fps, 5)
