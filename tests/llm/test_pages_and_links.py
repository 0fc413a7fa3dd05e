"""URL filters, HTML extraction, fingerprints, the n-gram join and the pipeline."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from llm_rows import by_id
from tallyline.llm import html_extraction, ngram_join, packing, queries, spot_signatures, url_filter

PAGES = "page_id long, url string, html string"


def test_rules_and_hosts(spark):
    cases = {
        "http://A.Example.ORG/es/x?q#f": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "ftp://notexample.org/en/1": ("notexample.org", "/en/1", "org/", "allow"),
        "http://x.com/fr/?a=/de/": ("x.com", "/fr/", "com/fr/", "allow"),
        "http://x.com?u=://y.com/de/": ("x.com", "", None, "allow"),
        "http://org": ("org", "", None, "allow"),
        "mailto:someone": ("", "", None, "allow"),
    }
    rows = [(i, u, None) for i, u in enumerate(cases)] + [(99, None, None), (99, None, "")]
    found = url_filter.judge(spark.createDataFrame(rows, PAGES), queries.RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        want = cases.get(r["url"], ("", "", None, "allow"))
        assert (r["host"], r["path"], r["rule"]) == want[:3]
        if r["rule"] or not r["host"] or r["url"] == "http://org":
            assert r["verdict"] == want[3]


def test_trust_is_personalised_pagerank(spark):
    edges = [("t", "a", "b", 0.5), ("t", "a", "c", 0.5), ("t", "b", "c", 1.0), ("t", "c", "a", 1.0), ("d", "c", "b", 1.0)]
    seeds = [("t", "a", 0.75), ("d", "c", 0.25)]
    got = url_filter.propagate(
        spark.createDataFrame(edges, "kind string, src string, dst string, share double"),
        spark.createDataFrame(seeds, "kind string, host string, share double"),
        rounds=12,
    ).collect()
    for kind in "td":
        flow = np.zeros((3, 3))
        for k, s, d, share in edges:
            if k == kind:
                flow["abc".index(d), "abc".index(s)] = share
        start = np.array([sum(v for k, h, v in seeds if (k, h) == (kind, x)) for x in "abc"])
        rank = start
        for _ in range(12):
            rank = 0.15 * start + 0.85 * flow @ rank
        found = {r["host"]: r["rank"] for r in got if r["kind"] == kind}
        assert np.allclose([found.get(h, 0.0) for h in "abc"], rank)


def test_links_carry_distrust(spark):
    rows = [
        (1, "http://bad.com/de/1", "<p>x</p>"),
        (2, "http://friend.net/en/1", "<a href='https://BAD.com:80/x'>x</a><a href=/own>y</a>"),
        (3, "http://good.org/en/1", '<a href="//fine.net/">x</a>'),
        (4, "http://fine.net/en/1", None),
    ]
    pages = spark.createDataFrame(rows, PAGES).withColumn("trust", F.lit("old"))
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, queries.RULES).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_only_hosts_that_occur_are_tied(spark):
    rows = [
        (1, "http://bad.com/de/1", None),
        (2, "http://a.co.uk/x", "<a href='http://bad.com/'>x</a>"),
        (3, "http://innocent.co.uk/x", None),
        # news.site.net is no host here: its name ties deep.news.site.net to site.net.
        (4, "http://site.net/x", "<a href='http://bad.com/'>x</a>"),
        (5, "http://deep.news.site.net/x", None),
    ]
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, PAGES), queries.RULES).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "block"}


def test_ports_belong_to_hosts(spark):
    rows = [
        (1, "http://bad.com:8080/de/1", "x"),
        (2, "http://own.net:8080/x", "<a href='//user@own.net:8080/y'>own</a> <a href='http://bad.com:8080/'>x</a>"),
        (3, "http://own.net/x", "x"),
        (4, "http://four.net/x", "<a href='https://own.net:8080'>x</a>"),
        (5, "http://five.net:80/x", "<a href='https://four.net:443/'>x</a>"),
        (6, "http://six.net/x", "<a href='https://bad.com/'>another port, which no rule blocks</a>"),
    ]
    rules = (url_filter.Rule(url_filter.BLOCK, "bad.com:8080/"),)
    judged = url_filter.judge(spark.createDataFrame(rows, PAGES), rules).collect()
    found = {r["page_id"]: (r["host"], r["verdict"]) for r in judged}
    assert found == {
        1: ("bad.com:8080", "block"), 2: ("own.net:8080", "block"), 3: ("own.net", "allow"), 4: ("four.net", "block"),
        5: ("five.net:80", "block"), 6: ("six.net", "allow"),
    }


def test_distrust_reaches_the_end_of_a_chain(spark):
    # Each host links to the one before it, the first to a blocked page.
    rows = [(0, "http://h0.com/de/1", None)]
    rows += [(i, f"http://h{i}.com/x", f"<a href='http://h{i - 1}.com/'>x</a>") for i in range(1, 31)]
    rows.append((99, "http://alone.net/x", None))
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, PAGES), queries.RULES).collect()}
    assert found == {i: "block" for i in range(31)} | {99: "allow"}


def test_ranks_settle(spark):
    edges = [("t", "a", "b", 1.0), ("t", "b", "a", 0.5), ("t", "b", "c", 0.5)]
    got = url_filter.propagate(
        spark.createDataFrame(edges, "kind string, src string, dst string, share double"),
        spark.createDataFrame([("t", "a", 1.0)], "kind string, host string, share double"),
    ).collect()
    flow = np.array([[0, 0.5, 0], [1, 0, 0], [0, 0.5, 0]])
    exact = np.linalg.solve(np.eye(3) - 0.85 * flow, [0.15, 0, 0])
    assert np.allclose([r["rank"] for r in sorted(got, key=lambda r: r["host"])], exact, rtol=1e-5)


def test_main_text(spark):
    body = "<p>The first   paragraph\n is here &amp; long enough.</p><p><b>Second one follows.<br><p>Third &eacute;nd."
    page = (
        "<html><head><title>No</title><style>p{}</style></head><body><nav><ul><li><a href='/a'>Menu</a></ul></nav>"
        f"<div class='ad'>Buy this now, it is a very good thing.</div><article><h1>Title</h1>{body}</article>"
        "<div class='comments'><p>I do not agree with any of this, said a reader.</p></div>"
        "<aside><p>Other things that we wrote about lately.</p></aside><script>var t='</p>';</script>"
        "<form><p>Subscribe to our letter today.</p></form><footer>&copy; us</footer></body></html>"
    )
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<div><p>" * 3000), (5, "u", page)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("N_chars", F.lit(1))
    found = html_extraction.with_main_text(pages, html_extraction.learn(pages))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in found.collect()}
    want = "Title\nThe first paragraph is here & long enough.\nSecond one follows.\nThird énd."
    assert got[1] == got[5] == (want, len(want)) and got[2] == got[3] == got[4] == ("", 0)
    none = pages.limit(0)
    assert html_extraction.with_main_text(none, html_extraction.learn(none)).count() == 0


def test_messages_give_exact_marginals():
    model = html_extraction.potentials(
        html_extraction.combined(html_extraction.count_observations(html_extraction.LABELLED, True), {})
    )
    tree = html_extraction.parse("<div class=ad><p>Some words.</p></div><article><h1>T</h1><p>More words here.</p></article>")
    size = len(tree.parent)
    bare = sum(model.without.values())
    weight = np.zeros((size, 2))
    for i in range(size):
        odds = sum(model.odds.get(f, 0.0) for f in tree.features[i])
        if tree.text[i] is None:
            odds += bare - sum(model.without.get(f, 0.0) for f in tree.features[i])
        weight[i] = 1 / (1 + np.exp(odds)), 1 / (1 + np.exp(-odds))
    total, on = 0.0, np.zeros(size)
    for bits in range(1 << (size - 1)):
        y = [1] + [bits >> i & 1 for i in range(size - 1)]
        p = 1.0
        for i in range(1, size):
            e = model.edge.get(tree.kind[i], model.unseen)[y[tree.parent[i]]]
            p *= (e if y[i] else 1 - e) * weight[i][y[i]]
        total += p
        on += p * np.array(y)
    assert np.allclose(html_extraction.marginals(tree, model), on / total)


def test_every_labelled_page_is_read_right():
    model = html_extraction.potentials(
        html_extraction.combined(html_extraction.count_observations(html_extraction.LABELLED, True, 25), {})
    )
    for page in html_extraction.LABELLED:
        tree = html_extraction.parse(page)
        labels = html_extraction.labels_of(tree, own_marks=True)
        want = "\n".join(t for t, y in zip(tree.text, labels, strict=True) if t is not None and y)
        assert html_extraction.main_text(page, model) == want


def test_successors_and_fingerprints(documents):
    draw = random.Random(3)
    words = "the of and river mill bread water stone house field".split()
    rows = [(i * 7 % 50, " ".join(draw.choices(words, k=draw.randint(0, 40)))) for i in range(50)] + [(3, "zz"), (60, None)]
    docs = documents(*rows)
    pairs = [(r["doc_id"], r["text"], r["next_text"]) for r in spot_signatures.with_next(docs).collect()]
    hashes = {r[0]: r[1] for r in docs.select(F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0], hashes[r[1]]))
    assert sorted(pairs) == sorted((i, t, n) for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True))
    signed = spot_signatures.with_signatures(docs)
    assert not re.search("Python|Arrow", signed._jdf.queryExecution().executedPlan().toString())
    got = by_id(signed.withColumn("f", spot_signatures.fingerprint(F.col("signatures"))), "f")
    assert got[60] == "" and all(len(f) % 8 == 0 for f in got.values())


def test_stretches_do_not_change_successors(documents, monkeypatch):
    docs = documents(*[(i * 13 % 101, f"t{i}") for i in range(101)])
    whole = sorted(map(tuple, spot_signatures.with_next(docs).collect()))
    monkeypatch.setattr(spot_signatures, "ROWS_PER_STRETCH", 10)
    assert sorted(map(tuple, spot_signatures.with_next(docs).collect())) == whole


def test_hot_keys_and_copies_are_cut(spark, monkeypatch):
    """A third of all rows under one key, a third without any, and many copies of one text:
    every stretch is small, and successors are those of the uncut order."""
    monkeypatch.setattr(spot_signatures, "ROWS_PER_STRETCH", 20)
    rows = [(7, f"hot {i}") for i in range(150)] + [(None, f"lost {i}") for i in range(100)] + [(None, None)] * 50
    rows += [(7, "copy")] * 150 + [(i, f"t{i}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    named = docs.select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    named = named.withColumns({"hash": F.xxhash64("text"), "salt": F.xxhash64(F.monotonically_increasing_id())})
    cuts = spot_signatures._cuts(named.select("key", "hash", "salt"))
    sizes = named.groupBy(spot_signatures._stretch(cuts, named.schema["key"].dataType)).count().collect()
    assert len(sizes) > 25 and max(r["count"] for r in sizes) <= 60
    got = sorted(((r["doc_id"], r["text"], r["next_text"]) for r in spot_signatures.with_next(docs).collect()), key=str)
    hashes = {r["text"]: r["hash"] for r in named.collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    assert got == sorted(((i, t, n) for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True)), key=str)


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_pruned_likeness_equals_brute_force(spark):
    draw = random.Random(4)
    sets = [sorted(draw.sample(range(300), draw.choice([0, 1, 3, 10, 29, 30, 31, 99, 100, 101]))) for _ in range(60)]
    pairs = [(draw.choice(sets), draw.choice(sets)) for _ in range(150)]
    pairs += [(s, sorted({*s[1:], 999})) for s in sets] + [([], []), ([1], list(range(1, 11))), ([1], list(range(1, 12)))]
    df = spark.createDataFrame(pairs, "a array<bigint>, b array<bigint>")
    for percent in (10, 50, 80):
        found = df.select("a", "b", spot_signatures.pruned_likeness(F.col("a"), F.col("b"), percent).alias("x")).collect()
        for r in found:
            exact = jaccard(set(r["a"]), set(r["b"]))
            assert r["x"] == (exact if exact * 100 >= percent else 0.0), (r, percent)


def test_near_copies_equal_brute_force(spark):
    draw = random.Random(6)
    words = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("ada", "elo", "imi", "uro")]

    def sentence(n):
        return [w for _ in range(n) for w in (draw.choice(["the", "of", "and"]), *draw.choices(words, k=draw.randint(1, 3)))]

    texts = [None, "", "the of", "one", "One!", "ONE", "12 34"]
    for _ in range(14):
        base = sentence(draw.choice([3, 8, 25, 60]))
        for _ in range(draw.randint(1, 6)):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts += [" ".join(copy)] * draw.randint(1, 2)
    rows = [(i * 17 % 503, t, "x") for i, t in enumerate(texts)] + [(None, texts[-1], "x"), (3, texts[-1], "x"), (3, texts[20], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    for percent in (60, 80):
        signed = spot_signatures.with_signatures(docs.select("doc_id", "text")).collect()
        sets = [(r["doc_id"], frozenset(r["signatures"])) for r in signed]
        able = [i for i, (k, s) in enumerate(sets) if s and k is not None]
        label = {i: i for i in able}
        for i in able:
            for j in able:
                if i < j and 100 * len(sets[i][1] & sets[j][1]) >= percent * len(sets[i][1] | sets[j][1]):
                    label = {k: label[i] if v == label[j] else v for k, v in label.items()}
        least = {}
        for i, v in label.items():
            least[v] = min(least.get(v, sets[i][0]), sets[i][0])
        want = sorted(((k, least[label[i]] if i in label else k) for i, (k, _) in enumerate(sets)), key=str)
        found = spot_signatures.near_copies(docs, percent=percent)
        assert sorted(map(tuple, found.collect()), key=str) == want
    assert spot_signatures.near_copies(docs.limit(0)).count() == 0


def brute_components(texts, size, percent):
    sets = {}
    for i, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        whole = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets[i] = whole
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = {k: a if v == b else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_similarity_components_equal_brute_force(documents):
    draw = random.Random(8)
    vocabulary = [f"w{k}" for k in range(300)]
    common = draw.choices(vocabulary, k=60)
    texts = [None, "", " \t ", "one", "ONE", "one two", "a b c d", "A b c D", "É b c d", "é b c d"]
    for _ in range(10):
        base = draw.choices(vocabulary, k=draw.randint(5, 90)) + (common if draw.random() < 0.4 else [])
        for _ in range(draw.randint(1, 9)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
    rows = [(i * 31 % 1009, t) for i, t in enumerate(texts)]
    found = ngram_join.similarity_components(documents(*rows), words=4, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(rows, 4, 85)


def test_one_of_each(documents):
    text = " ".join(f"w{k}" for k in range(40))
    docs = documents((5, text), (3, text + " x"), (9, "other words stand here now"), (9, "other words stand here now"), (7, None))
    kept = ngram_join.one_of_each(docs, words=5, percent=80)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 9] and kept.columns == docs.columns


def test_one_of_each_keeps_different_texts_of_a_key(documents):
    draw = random.Random(5)
    a, b, c, d = (" ".join(f"w{draw.randint(0, 9999)}" for _ in range(60)) for _ in range(4))
    # b stands under 1 and, nearly, under 2; c only beside a copy of a; None beside d.
    rows = [(1, a), (1, b), (1, b), (2, b + " x"), (4, a + " x"), (4, c), (6, d), (6, None), (6, "")]
    rows += [(7, f"{word} {word}s") for word in ("one", "two", "three")] + [(None, a), (None, a)]
    kept = ngram_join.one_of_each(documents(*rows), words=5, percent=80).collect()
    found = sorted(((r["doc_id"], r["text"] or None) for r in kept), key=str)
    want = [(1, a), (1, b), (4, c), (6, d), (6, None), *rows[9:]]
    assert found == sorted(want, key=str)


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    text = ("alpha  beta\tgamma " * 9 + "x" * 50 + " end").encode()
    raw = np.frombuffer(text, dtype=np.uint8)
    whole, _ = ngram_join.WordHasher().block(raw, np.array([0, len(raw)]))
    for size in (7, 16, 64):
        monkeypatch.setattr(ngram_join, "BLOCK", size)
        assert (ngram_join.WordHasher().long(raw) == whole).all()
    assert len(set(whole.tolist())) == 5


def test_pipeline(spark):
    small = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, small)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "language ID", "n-gram Jaccard join", "best-fit packing"
    ]
    docs = queries.table(spark, small, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        docs = kept
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    rows = packed.collect()
    assert {r["doc_id"] for r in rows} == ids
    assert sum(r["length"] for r in rows) == packing.pieces(docs).agg(F.sum("length")).first()[0]


def test_language_stage_rejects_what_no_profile_knows(spark, documents):
    small = "/root/testdata/sf0.001"
    docs = queries.table(spark, small, "documents").select(*corpus_pipeline.DOCUMENTS)
    odd = documents((-1, "東京 大阪 京都", None), (-2, "12 !! 34", None), (-3, "the house", None)).select(*docs.columns)
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    kept = corpus_pipeline.language(spark, docs.unionByName(odd), small)
    assert {r["doc_id"] for r in kept.collect()} == before | {-3}


def test_queries_are_registered():
    names = list(queries.registered())
    assert len(names) == 13 and all(n.startswith(f"op{i}_") for i, n in enumerate(names, 1))
