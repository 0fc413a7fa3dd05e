"""Every registered query and the pipeline against its contract, on given and on odd tables."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyline.llm import queries

SMALL = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_token_counts": "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    "op2_language_id": "doc_id long, held_out boolean, lang_pred string, score double",
    "op3_best_fit_packing": "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    "op4_quality_rules": "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean",
    "op5_url_filter": "page_id long, host string, path string, rule string, verdict string",
    "op6_byte_bpe": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    "op7_html_extraction": "page_id long, url string, text string, n_chars long",
    "op8_spot_signatures": "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double",
    "op9_ngram_join": "doc_id long, n_shingles long, component_id long",
    "op10_toxicity": "doc_id long, held_out boolean, score double, predicted int",
    "op11_lexical_search": "item_id long, rank int, doc_id long, score long",
    "op12_spelling_variants": "word string, form string, root string, n long, n_near long, form_n long",
    "op13_license_scan": "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double",
}
OF_PAGES = {"op5_url_filter", "op7_html_extraction"}
# Not a row for each row of their table.
OTHER_ROWS = {"op3_best_fit_packing", "op11_lexical_search", "op12_spelling_variants"}


def types(df):
    return {f.name: f.dataType.typeName().replace("integer", "int") for f in df.schema}


def wanted(name):
    return dict(c.split() for c in COLUMNS[name].split(", "))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables with nulls in every column, repeated rows and keys, and columns named like results."""
    folder = str(tmp_path_factory.mktemp("odd"))
    long_text = "The mill and the river of bread, the stone and the house. " * 400
    texts = [
        None, "", " \n\t ", "...", "a", "The river of bread.", "The river of bread.", long_text, long_text + "x",
        "x" * 3000, "Licensed under CC BY-NC 4.0.", "東京 大阪", "é" * 100, long_text,
    ]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, len(t or "") if i % 4 else None) for i, t in enumerate(texts)]
    rows += [(5, "other text of a key", "fr", "s", 1), (None, "no key here", "en", None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ("Score", "N_WORDS", "rank", "fingerprint", "key", "stretch", "hash", "component_id", "n", "word", "labels", "_row")
    docs = docs.withColumns({c: F.lit("old") for c in clashing})
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, (i + 1) % 2) for i in range(12)] + [(3, 0, 1), (None, 1, 1), (4, None, None), (99, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    pages = [
        (1, "http://a.com/fr/x", "<p>One sentence that is long enough to be read, it is.</p>"), (2, None, None),
        (None, "http://b.com/de/", "<a href='http://a.com'>x</a>"), (2, None, None), (4, "", ""), (5, "nonsense", "<" * 50),
    ]
    made = spark.createDataFrame(pages, "page_id long, url string, html string")
    made.withColumns({c: F.lit("old") for c in ("host", "Text", "trust", "verdict")}).write.parquet(f"{folder}/pages.parquet")
    items = [(1, "river of bread"), (1, "river of bread"), (2, None), (None, "stone"), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "pages", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_each_operator_has_a_query():
    assert list(queries.registered()) == list(COLUMNS)


@pytest.mark.parametrize("name", COLUMNS)
def test_contract_on_given_tables(spark, name):
    df = queries.registered()[name](spark, SMALL)
    have = types(df)
    assert {c: have.get(c) for c in wanted(name)} == wanted(name)
    rows = df.collect()
    source = queries.table(spark, SMALL, "pages" if name in OF_PAGES else "documents")
    key = "page_id" if name in OF_PAGES else "doc_id"
    if name not in OTHER_ROWS:
        assert sorted(r[key] for r in rows) == sorted(r[key] for r in source.select(key).collect())
    for column in ("score", "near_edited", "near_next"):
        if column in have and name != "op11_lexical_search":
            assert all(0 <= r[column] <= 1 for r in rows)
    if "held_out" in have:
        fold, of = (0, 5) if name.startswith("op2") else (2, 4)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % of == fold) for r in rows)
    texts = {r["doc_id"]: r["text"] or "" for r in queries.texts(spark, SMALL).collect()}
    if name == "op6_byte_bpe":
        assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in rows)
    if name == "op8_spot_signatures":
        ids = sorted(texts)
        following = dict(zip(ids, ids[1:] + ids[:1], strict=True))
        by_text = {}
        for r in rows:
            own, other = texts[r["doc_id"]], texts[following[r["doc_id"]]]
            edited = own[: len(own) - len(own) // 4] + other[: len(own) // 4]
            assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert by_text.setdefault(own, r["fingerprint"]) == r["fingerprint"]
    if name == "op10_toxicity":
        assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    if name == "op13_license_scan":
        assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in rows)
        assert all((r["n_base"] > 0) == (r["first_word"] is not None) == bool(r["base_labels"]) for r in rows)


@pytest.mark.parametrize("name", COLUMNS)
def test_odd_tables(spark, odd, name):
    df = queries.registered()[name](spark, odd)
    have = types(df)
    assert {c: have.get(c) for c in wanted(name)} == wanted(name)
    found = df.count()
    source = queries.table(spark, odd, "pages" if name in OF_PAGES else "documents")
    if name not in OTHER_ROWS:
        assert found == source.count()
        key = "page_id" if name in OF_PAGES else "doc_id"
        assert df.filter(F.col(key).isNull()).count() == source.filter(F.col(key).isNull()).count()


@pytest.mark.parametrize("name", COLUMNS)
def test_empty_tables(spark, empty, name):
    df = queries.registered()[name](spark, empty)
    have = types(df)
    assert {c: have.get(c) for c in wanted(name)} == wanted(name) and df.count() == 0


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty):
    docs = queries.table(spark, odd, "documents").select(*corpus_pipeline.DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, odd)
        rows = Counter(map(tuple, kept.collect()))
        assert kept.columns == list(corpus_pipeline.DOCUMENTS) and rows <= Counter(map(tuple, docs.collect()))
    assert corpus_pipeline.run(spark, empty).count() == 0
