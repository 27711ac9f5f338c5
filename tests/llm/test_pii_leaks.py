"""Personal identifiers, benchmark leaks and the pipeline against brute force."""

import hashlib
import random
import re

import pytest

import corpus_pipeline
from conftest import SF01, SF001
from furlong.llm import decontam, pii, queries

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [d * 2 if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute_spans(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text or "") if passes(kind, m.group())]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


def check_base(rows, texts):
    for r in rows:
        want = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k) for s in want) for k in PATTERNS]
        assert set(want) <= set(r["spans"].split(",")) | ({""} if not want else set())


def test_base_spans_of_all_documents(spark):
    rows = queries.op3_personal_data(spark, SF01).collect()
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, SF01).collect()}
    assert len(rows) == len(texts)
    check_base(rows, texts)


def test_base_spans_of_random_and_odd_texts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("0123456789012345..--  ()+@@ab%é😀\n") for _ in range(rng.randint(0, 80)))
             for _ in range(1500)]
    texts += [None, "", "a" * 50000, "1." * 30000, "a.b@c.d%e@f.g a@b a@b.c@d.e", "+1" * 3000,
              "4111 1111 1111 1111 x 4111-1111-1111-1112 +1 (499) 555-6503 1.2.3.4.5.6.7.8 256.1.1.1 007.1.1.1"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, n_ip int, kind string")
    check_base(pii.identifier_report(docs).collect(), dict(rows))


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a@b.c"), (1, "a@b.c"), (1, "1.2.3.4"), (None, "x a@b.cd"), (None, None)],
                                 "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["spans"]) for r in pii.identifier_report(docs).collect())
    assert got == [("1", "email:0:5"), ("1", "email:0:5"), ("1", "ip:0:7"), ("None", ""), ("None", "email:2:8")]
    assert pii.identifier_report(docs.limit(0)).count() == 0


def test_trusted_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please call hotline +1 (499) 555-{6000 + i} today thanks") for i in range(30)]
    rows += [(100, "please call hotline (499) 555-1234 today thanks"), (101, "something (499) 555-9999 else"),
             (102, "the port user@host now")]
    got = {r["doc_id"]: r["spans"] for r in pii.identifier_report(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == "phone:20:34" and got[101] == "" and got[102] == "" and got[1] == "phone:20:37"


def test_a_context_shared_by_kinds_is_not_trusted(spark):
    rows = [(i, f"at +1 (499) 555-{6000 + i} or") for i in range(9)] + [(20 + i, f"at user{i}@mail.com or") for i in range(9)]
    rows += [(100, "at (499) 555-1234 or")]
    got = {r["doc_id"]: r["spans"] for r in pii.identifier_report(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == ""


def plain(text):
    return " ".join(decontam.plain_words(text))


def test_every_planted_item_and_no_other_is_found(spark):
    got = {(r["doc_id"], r["item_id"]) for r in queries.op9_benchmark_leaks(spark, SF01).collect()}
    items = {r["item_id"]: plain(r["text"]) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: plain(r["text"]) for r in queries.documents(spark, SF01).collect()}
    assert got == {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in f" {t} "} and got


def filler(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.mark.parametrize("block_items", [1000, 3])
def test_rewordings_are_found_and_common_words_are_not(spark, block_items):
    rng = random.Random(1)
    items = [filler(rng, 12) + ". The answer is " + filler(rng, 6) + "." for _ in range(12)]
    docs = []
    for i, item in enumerate(items):
        words = item.split()
        around = filler(rng, 200).split()
        docs.append((i, " ".join(around[:90] + words + around[90:])))                               # as it is
        docs.append((100 + i, " ".join(around[:7] + [w for k, w in enumerate(words) if k % 7 != 3] + around[7:])))  # words left out
        changed = [w if k % 6 else filler(rng, 1) for k, w in enumerate(words)]
        docs.append((200 + i, " ".join(around[:133] + changed + around[133:]).upper()))              # words replaced
        docs.append((300 + i, " ".join(around) + " The answer is no."))                              # clean
        docs.append((400 + i, " ".join(around[:50] + words[:5] + around[50:])))                      # too little of it
    docs += [(900, None), (901, ""), (902, "x")]
    rows = spark.createDataFrame([(i, t, 0.5) for i, t in docs], "doc_id long, text string, cosine double")
    table = spark.createDataFrame([*enumerate(items), (50, None), (51, ""), (52, "..."), (60, items[0])],
                                  "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(rows, table, block_items=block_items).collect()}
    want = {(k + i, i) for i in range(12) for k in (0, 100, 200)} | {(k, 60) for k in (0, 100, 200)}
    assert got == want
    kept = decontam.clean(rows, table, block_items=block_items)
    assert kept.columns == rows.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        i for i, _ in docs if i not in {d for d, _ in want})


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.find_leaks(docs.limit(0), items).count() == 0
    assert decontam.find_leaks(docs, items.limit(0)).count() == 0
    assert decontam.find_leaks(docs, items.where("item_id = 1")).count() == 1


def test_candidate_search_finds_what_a_full_scan_finds(spark):
    """Recall of the latent search against the checks run on every window and item."""
    rng = random.Random(5)
    common = filler(rng, 20).split()
    items = [" ".join(rng.choice(common) if rng.random() < .4 else filler(rng, 1) for _ in range(25)) for _ in range(40)]
    docs = []
    for i in range(120):
        words = [rng.choice(common) if rng.random() < .4 else filler(rng, 1) for _ in range(150)]
        part = [w for w in items[i % 40].split() if rng.random() < rng.choice([.5, .7, .9, 1])]
        docs.append((i, " ".join(words[:70] + part + words[70:])))
    rows, table = (spark.createDataFrame(x, s) for x, s in ((docs, "doc_id long, text string"),
                                                            (list(enumerate(items)), "item_id long, text string")))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(rows, table, rank=24).collect()}
    full = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(rows, table, rank=24, min_cosine=-2).collect()}
    assert got <= full and len(got) >= 0.9 * len(full) > 50


def test_longest_common_subsequence():
    def brute(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(-1, 5) for _ in range(rng.randint(0, 90))] for _ in range(2))
        a = [max(x, 0) for x in a]
        assert decontam.common_subsequence(decontam._masks(a), len(a), b) == brute(a, b)


def test_pipeline_equals_brute_force(spark):
    """Each stage's decision by its definition, over the whole small table."""
    from test_fingerprints import brute_components, brute_fingerprint, brute_lines

    from furlong.llm import vocab as V

    docs = [(r["doc_id"], r["text"]) for r in queries.documents(spark, SF001).collect()]
    items = [plain(r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    docs = sorted((i, t) for i, t in docs if any(c.isalpha() for c in t))
    docs = brute_lines(docs)
    groups = brute_components([brute_fingerprint(t) for _, t in docs], [i for i, _ in docs])
    docs = [d for d, g in zip(docs, groups) if d[0] == g]
    docs = [(i, t) for i, t in docs if not any(f" {x} " in f" {plain(t)} " for x in items)]
    lib = V.library_tokenizer(V.public_path(queries.WORD_VOCABULARY))
    want = [(i, lib.encode(t, add_special_tokens=False).ids) for i, t in docs]
    rows = corpus_pipeline.run(spark, SF001).orderBy("doc_id").collect()
    got = [(r["doc_id"], list(r["ids"])) for r in rows]
    assert got == want and len(got) > 50
    for r in rows[:20]:
        assert r["decoded"] == lib.decode(list(r["ids"]), skip_special_tokens=False) and r["n_tokens"] == len(r["ids"])


def test_stages_take_odd_rows(spark):
    base = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "the of and", None, "s", 1), (7, "", "en", None, None),
                                 (7, "x " * 3000, None, None, 6000), (7, "x " * 3000, None, None, 6000)], base.schema)
    docs = base.union(odd)
    for docs in (docs, base.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF001)
            if name != "bpe_encoding":
                assert out.columns == base.columns and dict(out.dtypes) == dict(base.dtypes)
            assert out.count() >= 0


def scan_all_windows(docs, items, window=64, min_share=.6, min_answer=.5):
    """(doc, item) by the checks alone, on the words around every window."""
    found, half = set(), window // 2
    for i, item in items:
        words = decontam.plain_words(item)
        n, answer = len(words), words[decontam.answer_start(item):]
        masks, answer_masks, known, reach = decontam._masks(words), decontam._masks(answer), set(words), max(half, n)
        for d, text in docs:
            text = decontam.plain_words(text)
            for start in range(0, len(text), half):
                part = [w for w in text[max(0, start - reach):start + window + reach] if w in known]
                if (len(part) >= min_share * n and decontam.common_subsequence(masks, n, part) >= min_share * n
                        and decontam.common_subsequence(answer_masks, len(answer), part) >= min_answer * len(answer)):
                    found.add((d, i))
                    break
    return found


def leaks(spark, docs, items, **settings):
    rows, table = (spark.createDataFrame(x, s) for x, s in ((docs, "doc_id long, text string"), (items, "item_id long, text string")))
    return {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(rows, table, **settings).collect()}


def test_long_items_are_found_where_all_windows_have_them(spark):
    rng = random.Random(11)
    items = [(i, filler(rng, rng.randint(200, 500))) for i in range(10)]
    docs = []
    for i, item in items:
        words, around = item.split(), filler(rng, 300).split()
        broken = [x for k, w in enumerate(words) for x in ([w, filler(rng, 2)] if k % 5 == 0 else [w])]
        some = sorted(rng.sample(range(len(words)), int(.67 * len(words))))
        docs += [(k + i, " ".join(around[:130] + part + around[130:])) for k, part in (
            (0, words), (100, broken), (200, [words[k] for k in some]), (300, words[:len(words) // 3]))]
    want = scan_all_windows(docs, items)
    assert {(k + i, i) for i in range(10) for k in (0, 100, 200)} <= want
    assert leaks(spark, docs, items) == want
    assert leaks(spark, docs, [*items, (50, "a short item of few words")]) == want


def test_no_item_falls_out_of_the_space_of_many(spark):
    """More items than the rank, of mixed length, against the checks on all windows."""
    rng = random.Random(12)
    common = filler(rng, 300).split()
    items = [(i, " ".join(rng.choice(common) if rng.random() < .6 else filler(rng, 1) for _ in range(rng.randint(5, 60))))
             for i in range(520)]
    docs = []
    for d in range(260):
        words = [rng.choice(common) for _ in range(160)]
        for at, (_, item) in zip((20, 90), rng.sample(items, 2)):
            part = item.split()
            part = part if rng.random() < .5 else [part[k] for k in sorted(rng.sample(range(len(part)), -(-2 * len(part) // 3)))]
            words[at:at] = part
        docs.append((d, " ".join(words)))
    words = [{*decontam.plain_words(t)} for _, t in docs]
    often = {w for w in {*common} if sum(w in x for x in words) > .1 * len(docs)}  # these alone are not enough
    want = {(d, i) for d, i in scan_all_windows(docs, items) if words[d] & {*decontam.plain_words(items[i][1])} - often}
    assert len(want) > 400
    assert leaks(spark, docs, items) == want


def test_unseen_identifiers_do_not_take_trust_from_their_context(spark):
    """Half of a context's phones and a third of its cards are unseen; others are reached through these only."""
    def luhn(n):
        return next(f"{n}{c}" for c in range(10) if passes("card", f"{n}{c}"))

    def spaced(card):
        return " ".join(card[k:k + 4] for k in range(0, 16, 4))

    texts = {i: f"please call hotline +1 (499) 555-{6000 + i} today thanks" for i in range(30)}
    texts |= {100 + i: f"please call hotline 030 {1234000 + 7 * i} today thanks" for i in range(30)}
    cards = [spaced(luhn(411111111111000 + i)) for i in range(20)]
    texts |= {200 + i: f"paid with visa {c} on monday" for i, c in enumerate(cards)}
    wrong = [c[:-1] + str((int(c[-1]) + 1) % 10) for c in cards[:10]]
    texts |= {300 + i: f"paid with visa {c} on monday" for i, c in enumerate(wrong)}
    # the next round: a context of three seeds and many that only the round before tells to be phones
    texts |= {400 + i: f"ring desk +1 (499) 777-{6000 + i} for help" for i in range(3)}
    texts |= {500 + i: f"ring desk 030 {1234000 + 7 * i} for help" for i in range(30)}
    texts |= {600 + i: f"ring desk 040 {5234000 + 7 * i} for help" for i in range(10)}
    # numbers of which next to nothing is known
    texts |= {700 + i: f"in years +1 (499) 888-{6000 + i} of growth" for i in range(3)}
    texts |= {800 + i: f"in years 1990 {1000 + i} of growth" for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = [{r["doc_id"]: r["spans"] for r in pii.identifier_report(docs, rounds=n).collect()} for n in (1, 3)]
    for got in found:
        assert all(got[100 + i] == "phone:20:31" for i in range(30))
        assert all(got[300 + i] == "card:15:34" for i in range(10))
        assert not any(got[800 + i] for i in range(60))
    assert not any(found[0][600 + i] for i in range(10)) and all(found[1][600 + i] == "phone:10:21" for i in range(10))


@pytest.mark.parametrize("settings", [dict(rank=8), dict(rank=8, block_items=3), dict(rank=32, sample=5, min_cosine=2.0)])
def test_low_rank_and_groups_lose_nothing(spark, monkeypatch, settings):
    """A space of low rank blurs items; the exact products find what it misses, in one scan or several."""
    monkeypatch.setattr(decontam, "CELLS", 100)
    rng = random.Random(21)
    common = filler(rng, 40).split()
    items = [(i, " ".join(rng.choice(common) if rng.random() < .5 else filler(rng, 1) for _ in range(rng.randint(6, 90))))
             for i in range(40)]
    docs = []
    for d in range(80):
        words = [rng.choice(common) for _ in range(rng.randint(0, 200))]
        part = items[d % 40][1].split()
        part = part if d % 3 else [part[k] for k in sorted(rng.sample(range(len(part)), -(-2 * len(part) // 3)))]
        docs.append((d, " ".join(words[:90] + part + words[90:])))
    words = [{*decontam.plain_words(t)} for _, t in docs]
    often = {w for w in {*common} if sum(w in x for x in words) > .1 * len(docs)}
    want = {(d, i) for d, i in scan_all_windows(docs, items) if words[d] & {*decontam.plain_words(items[i][1])} - often}
    assert len(want) > 60
    copies = [*items, *[(100 + i, t) for i, t in items]]
    assert leaks(spark, docs, copies, **settings) == want | {(d, i + 100) for d, i in want}


def test_a_leak_deep_in_a_very_long_text(spark):
    rng = random.Random(22)
    item = filler(rng, 30)
    long = " ".join([filler(rng, 60)] * 3000)
    assert leaks(spark, [(1, f"{long} {item} {long}"), (2, long), (3, "x" * 2_000_000)], [(7, item), (8, "")]) == {(1, 7)}


def test_related_words_are_found_where_no_rare_word_is_shared(spark):
    """A rewording that keeps only frequent words: the sampled documents say which words go together."""
    rng = random.Random(31)
    frequent = filler(rng, 12).split()
    topics = [(filler(rng, 8).split(), filler(rng, 8).split()) for _ in range(6)]  # two sets of words of a topic
    docs = []
    for d in range(600):
        own = topics[d % 60][0] + topics[d % 60][1] if d % 60 < 6 else filler(rng, 16).split()
        words = [rng.choice(own) if rng.random() < .5 else rng.choice(frequent) for _ in range(64)]
        docs.append((d, " ".join(words)))
    items, planted = [], []
    for k, (one, other) in enumerate(topics):
        frame = [rng.choice(frequent) if j % 3 else None for j in range(24)]
        items.append((k, " ".join(w or one[j % 8] for j, w in enumerate(frame))))
        planted.append((1000 + k, " ".join(w or other[j % 8] for j, w in enumerate(frame))))
    want = {(1000 + k, k) for k in range(6)}
    got = leaks(spark, docs + planted, items)
    plainly = leaks(spark, docs + planted, items, min_cosine=2.0)  # TF-IDF alone
    assert len(want & got) >= 0.9 * len(want) and not want & plainly


def test_related_words_are_learned_from_all_windows(spark):
    """What goes together is said once, deep in a few long documents; no setting thins what is learned from."""
    rng = random.Random(32)
    frequent = filler(rng, 12).split()
    topics = [(filler(rng, 8).split(), filler(rng, 8).split()) for _ in range(3)]
    docs = []
    for d in range(200):
        windows = [[rng.choice(frequent) if rng.random() < .5 else filler(rng, 1) for _ in range(64)] for _ in range(6)]
        if d % 20 < 3:
            own = topics[d % 20][0] + topics[d % 20][1]
            windows[d % 5] = [rng.choice(own) if rng.random() < .5 else rng.choice(frequent) for _ in range(64)]
        docs.append((d, " ".join(w for x in windows for w in x)))
    items, planted = [], []
    for k, (one, other) in enumerate(topics):
        frame = [rng.choice(frequent) if j % 3 else None for j in range(24)]
        items.append((k, " ".join(w or one[j % 8] for j, w in enumerate(frame))))
        planted.append((1000 + k, " ".join(w or other[j % 8] for j, w in enumerate(frame))))
    assert leaks(spark, docs + planted, items, sample=2) >= {(1000 + k, k) for k in range(3)}
