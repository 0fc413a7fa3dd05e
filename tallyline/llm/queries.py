"""Registered queries of the operators, each over a whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    byte_bpe,
    html_extraction,
    language_id,
    lexical_search,
    ngram_join,
    notice_search,
    packing,
    quality_rules,
    spelling_variants,
    spot_signatures,
    token_counts,
    toxicity,
    url_filter,
)
from tallyline.session import materialize

Query = Callable[[SparkSession, str], DataFrame]

RULES = (
    url_filter.Rule(url_filter.ALLOW, "org/"),
    url_filter.Rule(url_filter.BLOCK, "example.org/es/"),
    url_filter.Rule(url_filter.BLOCK, "example.org/en/1"),
    url_filter.Rule(url_filter.ALLOW, "com/fr/"),
    url_filter.Rule(url_filter.BLOCK, "com/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds


def _held_out(folds: int, fold: int) -> Column:
    return F.coalesce(_fold(folds) == fold, F.lit(False))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.with_token_counts(texts(spark, sf_dir), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language_id.learn_profiles(docs.filter(_fold(5) != 0))
    predicted = language_id.with_language(docs.select("doc_id", "text"), profiles)
    return predicted.select("doc_id", _held_out(5, 0).alias("held_out"), "lang_pred", "score")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(texts(spark, sf_dir), sequence=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quality_rules.with_statistics(texts(spark, sf_dir)).drop("text")
    # Read twice, to learn and to judge; written once.
    counted = materialize(counted, "statistics")
    rules = quality_rules.fit(counted, table(spark, sf_dir, "labels"))
    judged = quality_rules.with_verdict(counted, rules)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "trust")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = byte_bpe.decode(byte_bpe.encode(texts(spark, sf_dir)))
    digests = (F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    return decoded.select("doc_id", "n_tokens", *digests)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    model = html_extraction.learn(pages)
    return html_extraction.with_main_text(pages, model).select("page_id", "url", "text", "n_chars")


def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spot_signatures.with_next(
        texts(spark, sf_dir), derive=spot_signatures.with_signatures, derived=["signatures"]
    )
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - cut), F.substring("next_text", F.lit(1), cut))
    pairs = pairs.withColumn("n_chars", size.cast("long")).withColumn("edited", edited)
    pairs = spot_signatures.with_signatures(pairs.drop("text", "next_text"), text="edited", name="edited_signatures")
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spot_signatures.fingerprint(F.col("signatures")).alias("fingerprint"),
        spot_signatures.fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        spot_signatures.pruned_likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        spot_signatures.pruned_likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
    )


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(texts(spark, sf_dir), words=4, percent=85)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "labels").filter(_fold(4) != 2)
    scored = toxicity.with_toxicity(texts(spark, sf_dir), known, threshold=0.3)
    return scored.select("doc_id", _held_out(4, 2).alias("held_out"), "score", "predicted")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return lexical_search.best_documents(texts(spark, sf_dir), items, most=20)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(texts(spark, sf_dir))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = notice_search.with_notices(texts(spark, sf_dir))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def registered() -> dict[str, Query]:
    queries = (
        op1_token_counts,
        op2_language_id,
        op3_best_fit_packing,
        op4_quality_rules,
        op5_url_filter,
        op6_byte_bpe,
        op7_html_extraction,
        op8_spot_signatures,
        op9_ngram_join,
        op10_toxicity,
        op11_lexical_search,
        op12_spelling_variants,
        op13_license_scan,
    )
    return {q.__name__: q for q in queries}


# The ranking of operator 11 in SQL. Documents and items count by row, as the operator has them.
RANKING = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
),
items AS (
    SELECT row_number() OVER () AS item, item_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark WHERE text IS NOT NULL
),
corpus AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
repeats AS (
    SELECT item, item_id, term, count(*) AS r
    FROM (SELECT item, item_id, unnest(terms) AS term FROM items) GROUP BY ALL
),
postings AS (
    SELECT row, doc_id, n, term, count(*) AS tf
    FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM repeats) GROUP BY ALL
),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus
),
scores AS (
    SELECT item, item_id, row, doc_id,
        sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM postings JOIN weights USING (term) JOIN repeats USING (term), corpus GROUP BY ALL
),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
        doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def statements() -> dict[str, str]:
    """SQL of the queries that SQL can state in full. The others rest on a vocabulary, on a
    learnt model, on hashes or misprints that SQL lacks, or on paths through links."""
    return {"op11_lexical_search": RANKING}
