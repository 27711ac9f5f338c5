"""Language identification and language-model scores: held-out quality, brute-force counts, edge cases."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from furlong.llm import lang_id, queries
from furlong.llm import recurrent_lm as R


def brute_ranks(text, size):
    """The n-grams of a text, most frequent first, by the definition."""
    line = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    line = " ".join(line.split())
    if not line:
        return []
    line = f" {line} "
    grams = collections.Counter()
    for n in (1, 2, 3):
        grams.update(g for g in (line[i:i + n] for i in range(len(line) - n + 1)) if g != " ")
    code = lambda g: [1 if c == " " else ord(c) for c in g] + [0] * (3 - len(g))
    return [code(g) for g, _ in sorted(grams.items(), key=lambda kv: (-kv[1], code(kv[0])))][:size]


def test_ranks_equal_the_definition():
    texts = ["The cat, the hat!", "", "  ", "123", "Ünïcode ñandú x", "a", "漢字 かな a", "İx", "aaa bbb aaa", "x " * 50]
    owner, gram, rank = lang_id.ranked(texts, 12)
    for i, t in enumerate(texts):
        got = [[int(g) >> 42, int(g) >> 21 & 0x1FFFFF, int(g) & 0x1FFFFF] for g in gram[owner == i]]
        assert got == brute_ranks(t, 12), t
        assert rank[owner == i].tolist() == list(range(len(got)))


def test_a_wide_alphabet_is_counted_in_parts():
    texts = ["".join(chr(0x4E00 + (7 * i + j * 131) % 20000) for j in range(3000)) for i in range(40)]
    owner, gram, _ = lang_id.ranked(texts, 10 ** 6)
    for i in (0, 17, 39):
        got = [[int(g) >> 42, int(g) >> 21 & 0x1FFFFF, int(g) & 0x1FFFFF] for g in gram[owner == i]]
        assert got == brute_ranks(texts[i], 10 ** 6)


def test_languages_of_held_out_documents(spark):
    got = queries.op1_language_id(spark, SF01)
    rows = got.join(queries.documents(spark, SF01).select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.99 * len(held)


def test_language_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the dog", "en", 0), (2, "le chat et le chien", "fr", 0), (3, None, "en", 0), (4, "12 34", None, 0),
         (5, "", "fr", 0), (6, "le chat", None, 0), (None, "the dog", None, 0), (6, "le chat", None, 0)],
        "doc_id int, text string, lang string, score int")
    profiles = lang_id.learn(docs)
    got = [tuple(r) for r in lang_id.identify(docs, profiles).select("doc_id", "lang_pred").collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (6, "fr"), (6, "fr"), (None, "en")], key=str)
    kept = lang_id.accepted(docs, profiles)
    assert kept.columns == docs.columns and kept.count() == 5
    none = lang_id.learn(docs.where("lang = 'xx'"))
    assert {r["lang_pred"] for r in lang_id.identify(docs, none).collect()} == {"und"}
    assert lang_id.accepted(docs, none).count() == 5
    assert lang_id.identify(docs.limit(0), profiles).count() == 0


def brute_base(rows):
    tokens = [(t or "").encode().lower().split() + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(count.values()), len(count)
    return [(i, h, len(t), sum(count[w] > 0 for w in t), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t))
            for (i, _), t, h in zip(rows, tokens, held)]


SMALL = R.Settings(shortlist=16, classes=4, hidden=4, streams=4, steps=4, warm_tokens=200)


def test_counts_and_base_scores_equal_brute_force(spark, tmp_path):
    rows = [(i, f"The w{i % 7} A ÀÉ w{i} <|x|> the") for i in range(60)] + [
        (60, None), (61, ""), (None, "the null id"), (63, "  \n"), (64, "the the " * 3000), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int").repartition(3)
    got = R.score_documents(docs, f"{tmp_path}/lm", SMALL).collect()
    want = sorted(brute_base(rows), key=lambda r: (str(r[0]), r[5]))
    got = sorted(got, key=lambda r: (str(r["doc_id"]), round(r["base_score"], 6)))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g)[:5] == w[:5]
        assert g["base_score"] == pytest.approx(w[5], abs=1e-6)
        assert g["score"] < 0 and math.isfinite(g["score"])


@pytest.mark.parametrize("listed", [0, 12, 1 << 17])
def test_only_words_beyond_the_listed_are_joined(spark, tmp_path, listed):
    """Counts that the tasks have need no join; which words these are changes no count and no score."""
    rows = [(i, f"The w{i % 7} A ÀÉ w{i} once{i} the w{i % 7}") for i in range(60)] + [(60, None), (61, "never never seen"), (None, "w1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    small = R.Settings(shortlist=6, classes=2, hidden=4, streams=4, steps=4, warm_tokens=200, listed=listed)
    got = sorted(R.score_documents(docs, f"{tmp_path}/lm", small).collect(), key=lambda r: str(r["doc_id"]))
    want = sorted(brute_base(rows), key=lambda r: str(r[0]))
    assert [tuple(g)[:5] for g in got] == [w[:5] for w in want]
    assert [g["base_score"] for g in got] == pytest.approx([w[5] for w in want], abs=1e-6)
    words = collections.Counter(w for (i, t), held in zip(rows, [r[1] for r in brute_base(rows)]) if not held
                                for w in (t or "").encode().lower().decode().split())
    joined = {r["w"] for r in spark.read.parquet(f"{tmp_path}/lm/encoded").selectExpr("explode(rare) as w").collect()}
    if listed == 1 << 17:
        assert joined and not joined & {*words}
    else:
        assert {w for w, c in words.items() if c == 1} <= joined
        assert bool(joined & {f"w{k}" for k in range(7)}) == (listed == 0)


def test_no_training_documents_and_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = R.score_documents(docs, f"{tmp_path}/none", SMALL, held=F.lit(True)).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in got] == [(0, 0), (0, 0)]
    assert all(r["base_score"] == 0 and math.isfinite(r["score"]) for r in got)
    assert R.score_documents(docs.limit(0), f"{tmp_path}/empty", SMALL).count() == 0


def test_probabilities_sum_to_one_and_windows_carry_the_state():
    rng = np.random.default_rng(0)
    net = R.Net(SMALL)
    net.start(rng.integers(1, 50, 16))
    net.weights += rng.standard_normal(len(net.weights)).astype(np.float32) * 0.3
    p = net.views(net.weights)
    h = rng.standard_normal((1, 4)).astype(np.float32)
    logp, _ = net.outputs(p, np.repeat(h, 16, 0), np.arange(16))
    assert np.exp(logp).sum() == pytest.approx(1, abs=1e-5)
    tokens, starts = rng.integers(0, 16, 200), np.array([0, 3, 3, 120, 200])
    whole = net.score(tokens, starts)
    assert net.score(tokens, starts, window=1) == pytest.approx(whole, abs=1e-4)
    for i in range(4):  # one document alone, one token at a time
        h, total = np.zeros((1, 4), np.float32), 0.0
        for t in tokens[starts[i]:starts[i + 1]]:
            total += net.outputs(p, h, np.array([t]))[0][0]
            h, _ = net.step(p, h, np.array([t]))
        assert whole[i] == pytest.approx(total, abs=1e-3)


def test_training_gradient_equals_differences():
    """One window's step direction against numerical differences of its loss."""
    s = R.Settings(shortlist=8, classes=2, hidden=3, streams=1, steps=8)
    tokens = np.array([2, 3, 1, 4, 5, 6, 7, 1])
    start = R.Net(s)
    start.start(np.arange(1, 9))
    base = start.weights.astype(np.float64).copy()

    def loss(w):
        net = R.Net(s, w)
        p, h, total = net.views(net.weights), np.zeros((1, 3), np.float32), 0.0
        for t in tokens:
            total -= net.outputs(p, h, np.array([t]))[0][0] / len(tokens)
            h, _ = net.step(p, h, np.array([t]))
            h = h * (t != R.END)
        return total

    net = R.Net(s, base)
    net.train(tokens, 1e-3)
    moved = net.weights - start.weights
    rng = np.random.default_rng(2)
    checked = 0
    for i in rng.permutation(len(base))[:60]:
        w = base.copy()
        w[i] += 0.02
        up = loss(w)
        w[i] -= 0.04
        slope = (up - loss(w)) / 0.04
        if abs(slope) > 2e-3:
            checked += 1
            assert np.sign(moved[i]) == -np.sign(slope)
    assert checked >= 10


def test_the_model_beats_the_counts_on_held_out_documents(spark):
    rows = queries.op8_language_model(spark, SF01).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_the_warm_start_scans_in_all_tasks(spark):
    rows = spark.range(0, 1000, 1, 8).withColumnRenamed("id", "row")
    warm = R.warm_rows(rows, 10)
    got = warm.mapInArrow(lambda batches: batches, "row long").collect()
    assert [r["row"] for r in got] == sorted(r["row"] for r in got) and 50 < len(got) < 200
    assert warm.rdd.getNumPartitions() == 1
    plan = warm._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Filter") and "Coalesce" not in plan  # the filter runs before the rows move


def test_distance_and_score_equal_the_definition(spark):
    """Prediction by summed out-of-place distance, ties by name, over profiles counted by hand."""
    size = 30
    rows = [("the cat sat on the mat and the dog", "en"), ("le chat et le chien sur le tapis", "fr"),
            ("der hund und die katze auf der matte", "de"), ("THE dog 12 the", "en"), ("aaa", "b-tie"), ("aaa", "a-tie")]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    profiles = {}
    for lang in {r[1] for r in rows}:
        counts = collections.Counter()
        for t, own in rows:
            if own == lang:
                for g in brute_grams(t):
                    counts[g] += 1
        ordered = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:size]
        profiles[lang] = {g: k for k, (g, _) in enumerate(ordered)}
    asked = ["the dog and the cat", "un chien", "die matte", "aaa", "", "zzz 99", "the chat katze", "a" * 200_000, "x y z " * 30_000]
    got = lang_id.identify(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"),
                           lang_id.learn(docs, size)).orderBy("doc_id").collect()
    for text, r in zip(asked, got):
        ranks = [tuple(g) for g in brute_ranks(text, size)]
        if not ranks:
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        distance = {lang: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(ranks)) for lang, p in profiles.items()}
        best = min(sorted(distance), key=distance.get)
        assert r["lang_pred"] == best
        assert r["score"] == pytest.approx(1 - distance[best] / (len(ranks) * size))


def brute_grams(text):
    """Every n-gram occurrence of a text, spelt like brute_ranks."""
    line = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    line = f" {line} "
    grams = [line[i:i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)]
    return [tuple([1 if c == " " else ord(c) for c in g] + [0] * (3 - len(g))) for g in grams if g != " "]


class Texts:
    """One batch of texts in place of a DataFrame: what a task does with it, in this process."""

    def __init__(self, texts):
        self.batch = pa.RecordBatch.from_arrays([texts], ["text"])

    def select(self, *_):
        return self

    def mapInArrow(self, f, schema):
        self.out = f(iter([self.batch]))
        return self

    def groupBy(self, *_):
        return self

    def agg(self, *_):
        return self.out


def test_cutting_a_slice_into_words_takes_bounded_memory(spark):
    """Two tasks of an executor cut texts at once, beside its heap."""
    import tracemalloc
    text = " ".join(f"w{i * 7919 % 200_000}" for i in range(5000))
    texts = pa.array([text] * ((40 << 20) // len(text)))
    counted = R.word_counts(Texts(texts))
    tracemalloc.start()
    assert sum(sum(b.column(1).to_pylist()) for b in counted) == 5000 * len(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
