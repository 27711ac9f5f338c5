"""Ranked search, source divergence and chat formatting: brute force, DuckDB, edge cases."""

import collections
import hashlib
import json
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF01
from furlong.llm import chat_format as C
from furlong.llm import divergence as D
from furlong.llm import queries
from furlong.llm import ranked_search as S
from furlong.llm.terms import LETTERS, LETTERS_DIGITS, term_codes
from furlong.session import scratch_dir

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TERM_OR_DIGIT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("query", ["op11_ranked_search", "op12_source_divergence", "op13_chat_format"])
def test_queries_equal_their_sql(spark, duck, query):
    got = queries.queries()[query](spark, SF01)
    columns, want, _ = duck(queries.oracle_sql()[query], SF01)
    order = [columns.index(c) for c in got.columns]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_terms_equal_the_pattern(texts):
    for inside, pattern in ((LETTERS, TERM), (LETTERS_DIGITS, TERM_OR_DIGIT)):
        owner, code, terms = term_codes(pa.array(texts, pa.string()), inside)
        names = terms.to_pylist()
        got = [(int(o), names[c]) for o, c in zip(owner, code)]
        assert got == [(i, t) for i, x in enumerate(texts) for t in pattern.findall(x.translate(LOWER))]


# ---------------------------------------------------------------- ranked search

def brute_search(docs, items, k=10):
    terms = [collections.Counter(TERM_OR_DIGIT.findall((t or "").translate(LOWER))) for _, t in docs]
    size = [sum(c.values()) for c in terms]
    n, total = sum(s > 0 for s in size), sum(size)
    df = collections.Counter(t for c in terms for t in c)
    out = []
    for item, text in items:
        query = collections.Counter(TERM_OR_DIGIT.findall((text or "").translate(LOWER)))
        scored = []
        for (doc, _), c, s in zip(docs, terms, size):
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * s * n // total)))
                        for t, times in query.items() if c[t])
            if score > 0:
                scored.append((score, doc))
        scored.sort(key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
        out += [(item, i + 1, d, s) for i, (s, d) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, **settings):
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as rank", "'x' as key")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in S.search(docs, items, **settings).collect()), key=repr)


def random_rows(seed, n, words, most):
    r = random.Random(seed)
    return [(i, " ".join(f"w{int(r.paretovariate(0.7)) % words}" for _ in range(r.randint(0, most)))) for i in range(n)]


@pytest.mark.parametrize("group_bytes,cells,block", [(16 << 20, 2 << 20, 8192), (300, 200, 20)])
def test_search_equals_brute_force(spark, monkeypatch, group_bytes, cells, block):
    monkeypatch.setattr(S, "CELLS", cells)
    monkeypatch.setattr(S, "BLOCK_TERMS", block)
    docs = random_rows(1, 400, 60, 40)
    docs += [(1000 + i, "Same WORDS ünï w1") for i in range(25)] + [(None, "w1 w2"), (5, "w3 w3"), (5, "w3 w3"), (7777, None)]
    items = random_rows(2, 30, 70, 12) + [(100, "same words ünï"), (101, None), (102, "..."), (100, "w1 w1 w2"), (None, "w3")]
    assert found(spark, docs, items, group_bytes=group_bytes) == brute_search(docs, items)


def test_search_edge_cases(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "--")], [(1, "a")]) == []
    long = " ".join(["alpha"] * 200_000 + ["beta"])
    docs = [(1, long), (2, "alpha beta")]
    assert found(spark, docs, [(1, "beta")]) == brute_search(docs, [(1, "beta")])


def test_search_reads_part_of_the_lists_and_stops_strictly_below():
    r = np.random.default_rng(3)
    n, m = 5000, 3
    impact = np.sort(r.pareto(0.6, (m, n)) * 1000, axis=1)[:, ::-1].astype(np.int64) + 1
    doc = np.stack([r.permutation(n) for _ in range(m)])
    doc[1:, :50] = doc[0, :50]  # the head is shared, so few places decide
    for i in (1, 2):
        rest = np.setdiff1d(np.arange(n), doc[0, :50])
        doc[i, 50:] = r.permutation(rest)
    lists = S.Lists(doc.ravel(), np.repeat(np.arange(m), n), impact.ravel(), n)
    met, score, read = lists.search(np.arange(m), np.ones(m, np.int64), 10)
    total = np.zeros(n, np.int64)
    np.add.at(total, doc.ravel(), impact.ravel())
    kth = np.sort(total)[-10]
    assert set(np.flatnonzero(total >= kth)) <= set(met.tolist()) and np.array_equal(total[met], score)
    assert read < n * m / 5
    # all scores equal: none may be left unread
    flat = S.Lists(np.arange(100), np.zeros(100, np.int64), np.full(100, 7), 100)
    assert len(flat.search(np.array([0]), np.array([1]), 10)[0]) == 100


# ---------------------------------------------------------------- source divergence

@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(alphabet="abcäß漢", min_size=1, max_size=7), min_size=1, max_size=60))
def test_transducer_numbers_its_words_in_order(words):
    words = sorted(w.encode() for w in words)
    fst = D.Transducer.from_bytes(D.Transducer.build(words).to_bytes())
    asked = [*words, b"zz", b"", words[0] + b"x"]
    got = fst.ordinals(*D._unpacked(D._packed(asked)))
    assert got.tolist() == [words.index(w) if w in words else -1 for w in asked]
    assert [fst.spell(i) for i in range(len(words))] == words


def test_transducer_is_minimal():
    fst = D.Transducer.build(sorted(f"{a}{b}ing".encode() for a in "abcdef" for b in "xyz"))
    assert len(fst.final) == 6 and len(fst.keys) == 6 + 3 + 3  # one state a depth


def brute_divergence(rows, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    docs = collections.defaultdict(collections.Counter)
    for lang, _, text in rows:
        docs[lang].update(set(TERM.findall(text.translate(LOWER))))
    out = []
    for lang in {r[0] for r in rows}:
        kept = sorted(t for t, n in docs[lang].items() if n >= 3)
        count = {s: collections.Counter() for l, s, _ in rows if l == lang}
        for l, s, text in rows:
            if l == lang:
                count[s].update(t for t in TERM.findall(text.translate(LOWER)) if docs[lang][t] >= 3)
        whole = sum(count.values(), collections.Counter())

        def share(c):
            n = sum(c.values())
            return [1 + 10 ** 9 * (c[t] + 1) // (n + len(kept)) for t in kept]

        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in count:
            pairs = [(o, sum((a - b) ** 2 // b for a, b in zip(p[s], p[o]))) for o in count if o != s]
            terms = [(t, (a - b) ** 2 // b) for t, a, b in zip(kept, p[s], q) if count[s][t] and a > b]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, t, v, i + 1) for i, (t, v) in enumerate(found) if part == "pair" or i < top]
    return sorted(out, key=repr)


DOCS = "doc_id long, lang string, source string, text string, term string, n int"


def audited(spark, rows, range_terms=None):
    docs = spark.createDataFrame([(i, *r, "x", 1) for i, r in enumerate(rows)], DOCS)
    folder = scratch_dir(spark, "test-divergence")
    if range_terms:
        build = D.build_vocabulary
        D.build_vocabulary = lambda kept, f: build(kept, f, range_terms)
    try:
        return sorted((tuple(r) for r in D.divergence(docs, folder, top=20).collect()), key=repr)
    finally:
        if range_terms:
            D.build_vocabulary = build


@pytest.mark.parametrize("range_terms", [None, 7])
def test_divergence_equals_brute_force(spark, range_terms):
    r = random.Random(4)
    words = [a + b for a in ("al", "be", "ga", "Ño", "漢") for b in ("x", "ya", "zz", "ß", "que")]
    rows = [(r.choice(["en", "de", None, "é"]), r.choice(["web", "books", "", None, "ü"]),
             " ".join(r.choices(words, k=r.randint(0, 25)))) for _ in range(150)]
    rows += [("fr", "a", "une deux"), ("fr", "b", "une"), ("en", "web", None), ("en", "news", "")] + [("en", "web", "Alx alx")] * 40
    assert audited(spark, rows, range_terms) == brute_divergence(rows, 20)


def test_divergence_edge_cases(spark):
    assert audited(spark, []) == []
    assert audited(spark, [(None, None, None)]) == []
    long = "a" * 100_000
    rows = [("en", s, f"{long}b {long} word") for s in "xyz"]
    assert audited(spark, rows) == brute_divergence(rows, 20)


def test_counts_beyond_64_bits_stay_exact():
    assert D._share(np.array([10 ** 12, 0]), 10 ** 13, 7).tolist() == [
        1 + 10 ** 9 * (10 ** 12 + 1) // (10 ** 13 + 7), 1 + 10 ** 9 // (10 ** 13 + 7)]


# ---------------------------------------------------------------- chat formatting

@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="<|\\im_startend>\n ax", max_size=12),
                          st.text(alphabet="<|\\im_startend>\n ax", max_size=30)), max_size=4))
def test_template_is_reversible(turns):
    text = "".join(f"{C.START}{C._role_out(r)}\n{C.escape(t)}{C.END}\n" for r, t in turns)
    assert [(r, t) for r, t, _, _ in C.parse(text)] == turns
    for _, t in turns:
        assert "<|" not in C.escape(t) and C.unescape(C.escape(t)) == t


def brute_chat(rows):
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn if turn is not None else -1, role or "", text or ""))
    out = []
    for conv, turns in by_conv.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [(1, 0, "user", "hi <|im_end|>\n"), (1, 1, "assistant", "<\\|im_start|>"), (1, 1, "assistant", "<\\|im_start|>"),
        (2, 0, None, None), (None, 0, "user", "x"), (None, 1, "assistant", "yé漢"), (3, None, "a\nb\\", "z" * 300_000),
        (4, 5, "assistant", ""), (4, 2, "user", "|<|")]


def test_rows_come_back(spark):
    table = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn int, role string, text string, formatted int")
    formatted = C.format_turns(C.canonical_turns(table))
    for got in (C.read_back(formatted, stored=False), C.read_back(formatted.repartition(5))):
        assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute_chat(ROWS)
    whole = "".join(r["formatted"] for r in formatted.where("conv_id = 1").orderBy("seq").collect())
    for r in formatted.where("conv_id = 1 and loss_begin is not null").collect():
        assert C.unescape(whole[r["loss_begin"]:r["loss_end"]]) == "<\\|im_start|>"
    assert C.read_back(C.format_turns(C.canonical_turns(table.limit(0))), stored=False).count() == 0


RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, [("user", "a"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}], "id": 3}, [("user", "q"), ("assistant", "r")]),
    ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"system": "", "prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "completion": "c", "score": 1.5}, [("user", "p"), ("assistant", "c")]),
    ({"unknown": "x"}, []), ([1], []), ("{", []), (None, [])]


def test_json_layouts_become_canonical_turns(spark):
    rows = [(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, (r, _) in enumerate(RECORDS)]
    records = spark.createDataFrame(rows, "conv_id long, record string")
    got = C.canonical_json(records).orderBy("conv_id", "turn").collect()
    for i, (_, want) in enumerate(RECORDS):
        assert [(r["role"], r["text"]) for r in got if r["conv_id"] == i] == want
    report = {r["layout"]: r["n_records"] for r in C.layout_report(records).groupBy("layout").sum("n_records")
              .withColumnRenamed("sum(n_records)", "n_records").collect()}
    assert report == {"messages": 1, "from and value": 1, "instruction": 2, "system prompt": 2, "prompt and completion": 1, None: 4}


@pytest.mark.parametrize("k", range(7))
def test_typed_layouts_equal_json_layouts(spark, k):
    record, want = RECORDS[k]
    table = spark.sql("select from_json(?, schema_of_json(?)) as r", args=[json.dumps(record).replace("null", '""')] * 2)
    table = table.selectExpr("9 as conv_id", "r.*")
    got = C.canonical_turns(table).orderBy("turn").collect()
    assert [(r["conv_id"], r["role"], r["text"]) for r in got] == [(9, r, t) for r, t in want]


def test_no_layout_is_an_error(spark):
    with pytest.raises(ValueError, match="no layout"):
        C.canonical_turns(spark.sql("select 1 as x"))
