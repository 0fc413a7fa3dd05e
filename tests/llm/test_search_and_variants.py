"""Ranked search, spelling variants and license notices against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import by_id
from tallyline.llm import lexical_search, notice_search, spelling_variants

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERMS.findall((text or "").translate(LOWER))


def brute_search(docs, items, most):
    """{item: [(rank, doc, score)]} by scoring every document."""
    terms = [(d, terms_of(t)) for d, t in docs]
    terms = [(d, t) for d, t in terms if t]
    n_docs, n_terms = len(terms), sum(len(t) for _, t in terms)
    df = Counter(term for _, t in terms for term in set(t))
    weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    found = {}
    for item, text in items:
        scored = []
        for d, t in terms:
            counts = Counter(t)
            m = 75 + 25 * len(t) * n_docs // n_terms
            score = sum(weights[q] * (10**9 * counts[q] // (1000 * counts[q] + 12 * m)) for q in terms_of(text) if q in counts)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        found[item] = [(i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:most])]
    return found


def random_docs(n, seed, vocabulary=60):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Élan", "ÉLAN", "naïve", "東京", "x86"]
    odds = [1 / (i + 1) for i in range(len(words))]
    return [(i, draw.choice([" ", ", ", "\n"]).join(draw.choices(words, odds, k=draw.randint(0, 40)))) for i in range(n)]


def run_search(spark, docs, items, most=5, **options):
    found = lexical_search.best_documents(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        most=most,
        **options,
    )
    rows = {}
    for r in sorted(found.collect(), key=lambda r: (r["item_id"], r["rank"])):
        rows.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return rows


@pytest.mark.parametrize("seeds, bucket", [(1, 4), (40, 16), (10_000, 1024)])
def test_search_equals_brute_force(spark, seeds, bucket):
    docs = random_docs(300, 1) + [(900, "w1 " * 5000), (901, None), (902, "..."), (5, "w3 w4 repeated key"), (None, "w9 w8")]
    docs += [(1000 + i, "same copies w5 w6 w7") for i in range(40)]
    items = [(1, "w5 w6 w7 w7"), (6, "same copies"), (2, "W0 w1 w2 élan"), (3, None), (4, "unheard of"), (5, "w40 w41 w42 w43 w44 w45 w46 w47 w48 w49 w50")]
    found = run_search(spark, docs, items, seed_rows=seeds, bucket_rows=bucket)
    expected = brute_search(docs, items, 5)
    assert found == {i: e for i, e in expected.items() if e}
    assert [d for _, d, _ in found[6]] == [1000, 1001, 1002, 1003, 1004]


def test_search_in_blocks_of_items(spark):
    docs, items = random_docs(80, 2), random_docs(12, 3)
    whole = run_search(spark, docs, items)
    assert run_search(spark, docs, items, block_terms=8) == whole


def test_search_of_empty_tables(spark):
    docs, items = random_docs(3, 4), [(1, "w0")]
    assert run_search(spark, [], items) == {}
    assert run_search(spark, docs, []) == {}
    assert run_search(spark, [(1, None), (2, "- -")], items) == {}


def test_search_keeps_other_keys_and_clashing_columns(spark):
    docs = spark.createDataFrame([("a", "one two", 1), ("b", "one", 2)], "id string, body string, rank int")
    items = spark.createDataFrame([("q", "one"), ("q", "two")], "id string, text string")
    found = lexical_search.best_documents(
        docs.withColumn("score", F.lit(0)),
        items.toDF("query", "words"),
        key="id",
        text="body",
        item_key="query",
        item_text="words",
    )
    assert found.columns == ["query", "rank", "id", "score"]
    assert sorted((r["query"], r["rank"], r["id"]) for r in found.collect()) == [("q", 1, "a"), ("q", 1, "b"), ("q", 2, "a")]


def test_bounds_hold_and_prune():
    draw = np.random.default_rng(5)
    weights = draw.integers(0, 9000, 50)
    sizes = draw.integers(1, 30, 200)
    terms = np.concatenate([draw.choice(50, n, replace=False) for n in sizes]).astype(np.int64)
    impacts = draw.integers(1, 900_000, len(terms))
    offsets = np.append(0, np.cumsum(sizes))
    owner = np.repeat(np.arange(200), sizes)
    norms = np.sqrt(np.bincount(owner, weights[terms] * impacts.astype(float) ** 2, 200))
    bucket = lexical_search.Bucket(None, offsets, terms, impacts, norms, np.sqrt(weights))
    item = lexical_search.Item(0, {int(t): 1 + int(t) % 2 for t in draw.choice(50, 14, replace=False)}, weights, 1, 3)
    exact = bucket.scores(item, np.arange(200), np.zeros(50, dtype=np.int64))
    gains = dict(zip(item.terms.tolist(), item.gains.tolist(), strict=True))
    brute = [sum(gains.get(int(t), 0) * int(i) for t, i in zip(terms[a:b], impacts[a:b], strict=True)) for a, b in zip(offsets, offsets[1:], strict=False)]
    bounds = bucket.bounds(item)
    assert exact.tolist() == brute
    assert (bounds >= exact).all() and (bounds <= item.norm * norms * 1.0001).all()
    assert (bounds < np.sort(exact)[-3]).sum() > 20
    edges = list(lexical_search.bucket_edges(np.array([9.0, 8.5, 8.0, 4.0, 4.0, 1.0])))
    assert edges == [(0, 2), (2, 3), (3, 5), (5, 6)]


# ---- spelling variants --------------------------------------------------------------

RUNS = re.compile(r"[A-Za-zÀ-ÿ]+")


def brute_counts(docs, least_chars=5):
    counts = Counter()
    for doc, text in docs:
        for run in RUNS.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_chars:
                counts[run] += 1
    return counts


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=2):
    forms, found = {}, {}
    for word, n in counts.items():
        others = [w for w in counts if near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best and counts[best] >= ratio * n else None
        found[word] = len(others)
    rows = {}
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        form = forms[word]
        rows[word] = (form, root, n, found[word], counts[form] if form else None)
    return rows


def variant_rows(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def noisy_docs(seed, n=60, words=25):
    """Documents of few words with many misprints of theirs."""
    draw = random.Random(seed)
    letters = "aabbcdé"
    base = ["".join(draw.choices(letters, k=draw.randint(4, 9))) for _ in range(words)]
    base += ["long" + "ab" * 40, "aaaaaa", "aaaaaaa", "Straße", "ÀÉÎÕÜ"]
    odds = [1 / (i + 1) for i in range(len(base))]
    docs = []
    for i in range(n):
        text = []
        for word in draw.choices(base, odds, k=80):
            if draw.random() < 0.4:
                at = draw.randrange(len(word))
                word = draw.choice([word[:at] + word[at + 1 :], word[:at] + draw.choice(letters) + word[at:], word[:at] + draw.choice(letters) + word[at + 1 :]])
            text.append(word)
        docs.append((i, draw.choice([" ", "-", "9"]).join(text)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    docs = noisy_docs(seed) + [(None, "nokey nokey nokey Nokey"), (7, "nokex nokex nokex"), (8, None), (9, "")]
    docs += [(70, "steppe " * 4 + "stxppe " * 9 + "stxqpe " * 20 + "stxqre " * 41)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counted = {r["word"]: r["n"] for r in spelling_variants.word_counts(df).collect()}
    assert counted == brute_counts(docs)
    expected = brute_variants({w: n for w, n in counted.items() if n >= 3})
    found = variant_rows(spelling_variants.spelling_variants(df))
    assert found == expected
    assert sum(v[3] for v in found.values()) > 100 and any(v[0] and v[1] != v[0] for v in found.values())


@pytest.mark.parametrize("chars", [1, 6, 40])
def test_digests_find_the_same_neighbours(spark, monkeypatch, chars):
    monkeypatch.setattr(spelling_variants, "KEY_CHARS", chars)
    words = sorted({w for n in (5, 6, 7) for w in {"".join(random.Random(i * n).choices("abé", k=n)) for i in range(60)}})
    for a in words:
        keys = Counter(k for k in spelling_variants.rotations(a))
        assert len(keys) == 2 * len(a) + 1
    table = {}
    for number, word in enumerate(words):
        for key, kind in spelling_variants.rotations(word):
            table.setdefault(key, []).append((number, 1, kind))
    counts = Counter()
    for members in table.values():
        for number, others, _, _ in spelling_variants.group_neighbours(members):
            counts[words[number]] += others
    assert {w: counts[w] for w in words} == {w: sum(near(w, v) for v in words) for w in words}


def test_very_long_words(spark):
    long_word = "ab" * 3000
    text = " ".join([long_word] * 9 + [long_word + "c"] * 3 + [long_word[:2000] + "x" + long_word[2001:]] * 4)
    counts = {w: n for w, n in brute_counts([(1, text)]).items() if n >= 3}
    found = variant_rows(spelling_variants.spelling_variants(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    assert found == brute_variants(counts) and len(found) == 3


def test_forms_lead_to_roots_over_long_chains(spark):
    pointers = [(i, i + 1) for i in range(37)] + [(100, 3), (101, 100)]
    found = spelling_variants.roots(spark.createDataFrame(pointers, "id long, form long"))
    assert {r["id"]: r["root"] for r in found.collect()} == {i: 37 for i, _ in pointers}


def test_variants_of_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants.spelling_variants(none).collect() == []
    docs = spark.createDataFrame([(1, "alpha Alpha alpha", "x", 2)], "doc_id long, text string, word string, n int")
    counts = {w: n for w, n in brute_counts([(1, "alpha Alpha alpha")]).items() if n >= 3}
    assert variant_rows(spelling_variants.spelling_variants(docs)) == brute_variants(counts)


# ---- notices ------------------------------------------------------------------------


def fewest_edits(text, wanted, start):
    """{end: edits} of the texts from start on, by the full table of edit distances."""
    row = list(range(len(wanted) + 1))
    found = {start: row[-1]}
    for end in range(start, min(len(text), start + 2 * len(wanted) + 4)):
        new = [row[0] + 1]
        for j, letter in enumerate(wanted):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (text[end] != letter)))
        row = new
        found[end + 1] = row[-1]
    return found


def brute_edits(padded, notice):
    """The fewest edits of the notice anywhere in the words, or None beyond its bound."""
    best = None
    at = padded.find(notice.lead)
    while at >= 0:
        for end, edits in fewest_edits(padded, notice.text, at + len(notice.lead)).items():
            if padded[end : end + 1] == " " and edits <= notice.edits and (best is None or edits < best):
                best = edits
        at = padded.find(notice.lead, at + 1)
    return best


def garbled(notice, edits, draw):
    text = list(notice)
    for _ in range(edits):
        at = draw.randrange(len(text))
        kind = draw.randrange(3)
        if kind == 0:
            del text[at]
        elif kind == 1:
            text.insert(at, draw.choice("aeilns"))
        else:
            text[at] = draw.choice("aeilns")
    return "".join(text)


def test_notices_equal_brute_force():
    draw = random.Random(8)
    scan = notice_search.Scanner(notice_search.NOTICES)
    caught = Counter()
    for i in range(250):
        notice = draw.choice(notice_search.NOTICES)
        line = notice.lead.strip() + " " + garbled(notice.text, draw.randint(0, notice.edits + 1), draw)
        raw = f"Some words, {draw.choice(['in', 'licensed under', ''])} {line}. {draw.choice(['Sense of', 'x', ''])}"
        _, padded = notice_search.words_between_blanks(raw.encode())
        found = {}
        for edits, _, _, number in scan.matches(padded):
            found[number] = min(edits, found.get(number, 99))
        expected = {k: e for k, n in enumerate(notice_search.NOTICES) if (e := brute_edits(padded, n)) is not None}
        assert found == expected, raw
        caught[bool(found)] += 1
    assert caught[True] > 150


def test_seeds_survive_all_edits():
    for notice in notice_search.NOTICES:
        pieces = list(notice.seeds())
        assert len(pieces) == notice.edits + 1 and "".join(p for p, _ in pieces) == notice.text
        assert all(notice.text[at : at + len(p)] == p and p for p, at in pieces)


def test_scan_of_documents(documents):
    rows = [
        None,
        "",
        "Licensed under CC BY-NC 4.0.",
        "Released under the MIT\nLicense. Again: mit license!",
        "This work is licensed under the GNU Generl Publik License, version 3.",
        "We permit license plates; an innocent sense of nonsense.",
        "cc by cc by cc",
        "Released under the MIT License.",
        "Released under the MIT License.",
        "é" * 50_000 + " license " * 2000,
    ]
    found = by_id(
        notice_search.with_notices(documents(*rows).withColumn("Labels", F.lit("old")).withColumn("x.y", F.lit(1))),
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
    )
    assert found[0] == found[1] == (0, 0, None, None, "", "", 0.0)
    assert found[2] == (7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc", 1.0)
    assert found[3] == (8, 2, 3, 6, "mit", "mit", 1.0)
    assert found[4][1:6] == (0, None, None, "", "gpl") and 0.9 < found[4][6] < 1
    assert found[5] == (9, 0, None, None, "", "", 0.0)
    assert found[6] == (5, 2, 0, 2, "cc-by", "cc-by", 1.0)
    assert found[7] == found[8] == (5, 1, 3, 3, "mit", "mit", 1.0)
    assert found[9] == (2001, 0, None, None, "", "", 0.0)


def test_spans_lie_in_the_text_itself(documents):
    text = "Ünïcode first — under the Apach  Licence, v2; then MIT\tLicense."
    row = notice_search.with_notices(documents(text)).first()
    spans = [(n["label"], text[n["start"] : n["end"]], n["edits"]) for n in row["notices"]]
    assert spans == [("apache", "Apach  Licence", 2), ("mit", "MIT\tLicense", 0)]
    assert notice_search.with_notices(documents("x").limit(0)).count() == 0
    assert notice_search.with_notices(documents("MIT license"), notices=(), phrases=()).first()["labels"] == ""
