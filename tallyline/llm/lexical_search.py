"""Ranked lexical search: each item's best documents, found by norm buckets.

A document is a vector of impacts, one coordinate for each term that some item uses; an
item is a vector of repeats; the weight of a term is shared between both as its square
root, so the inner product is the score. Every task takes its documents by decreasing
vector length and cuts them into buckets. By Cauchy-Schwarz an item skips a bucket whose
longest vector cannot reach the item's present k-th score. Inside a bucket the item's
heaviest coordinates are multiplied out and Cauchy-Schwarz bounds the rest, per document;
what survives is scored again in integers, exactly. The longest vectors of the corpus are
searched first, and their k-th scores are where all tasks start from.

Items go to the driver in blocks of at most ``BLOCK_TERMS`` distinct terms (or one item),
as only a block's terms, weights and k-th scores travel to the tasks. Of documents, only
vectors are written, and every task hands on at most k documents an item.

Defined cases: a null or empty text has no terms and is never found, such an item finds
nothing; texts of any length are read whole; repeated documents are documents of their
own; items that share a key get their results each, under that key; equal scores come by
ascending document key, a null key last; an empty table, or one without terms, gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyline.llm.arrow import SLICE_ROWS, column, rows_of
from tallyline.session import materialize

MOST = 20
BLOCK_TERMS = 100_000
# Vectors of a bucket: at most so many, none shorter than this share of the longest.
BUCKET_ROWS, BUCKET_SHARE = 1024, 0.9
# Coordinates multiplied out before the rest is bounded.
FOCUS = 8
# So many of the longest vectors, and those of their class of length, set the first bounds.
SEED_ROWS = 10_000
CLASSES_PER_DOUBLING = 4
# Bounds are doubles, scores are integers: a bound may lie this share too low.
SLACK = 1 + 1e-9

# Every byte of a term stays (A to Z lower-cased), any other becomes a blank. Bytes from
# 0x80 on only occur inside characters beyond ASCII, all of which are term characters.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return raw.translate(_LETTERS).split()


def raw_texts(values: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column as UTF-8, a missing one as the empty text."""
    for start in range(0, len(values), SLICE_ROWS):
        for raw in values.slice(start, SLICE_ROWS).cast(pa.binary()).to_pylist():
            yield raw or b""


@dataclass
class Block:
    """Items (number, repeats by term index) and the numbering of their terms."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    items: list[tuple[int, dict[int, int]]] = field(default_factory=list)

    def add(self, number: int, repeats: Mapping[bytes, int]) -> None:
        indices = {self.vocabulary.setdefault(t, len(self.vocabulary)): r for t, r in repeats.items()}
        self.items.append((number, indices))


def blocks(raw_items: Iterable[bytes], most_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    block = Block()
    for number, raw in enumerate(raw_items):
        repeats = Counter(terms_of(raw))
        if block.items and len(block.vocabulary.keys() | repeats.keys()) > most_terms:
            yield block
            block = Block()
        if repeats:
            block.add(number, repeats)
    if block.items:
        yield block


def weight(documents: int, having: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def term_vectors(docs: DataFrame, vocabulary: Mapping[bytes, int], *, key: str, text: str) -> DataFrame:
    """Rows (key, n, terms, tfs) of all documents that have terms: how many, and how often
    those of the vocabulary occur."""

    def prepare():
        look_up = vocabulary.get

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    rows, sizes, offsets, terms, tfs = [], [], [0], [], []
                    for row, raw in enumerate(raw_texts(part.column(1))):
                        words = terms_of(raw)
                        if not words:
                            continue
                        counts = Counter(map(look_up, words))
                        counts.pop(None, None)
                        rows.append(row)
                        sizes.append(len(words))
                        terms.extend(counts.keys())
                        tfs.extend(counts.values())
                        offsets.append(len(terms))
                    yield {
                        "key": part.column(0).take(pa.array(rows, type=pa.int64())),
                        "n": sizes,
                        "terms": _lists(offsets, np.array(terms, dtype=np.int32)),
                        "tfs": _lists(offsets, np.array(tfs, dtype=np.int32)),
                    }

        return work

    key_type = docs.select(column(key)).schema[0].dataType.simpleString()
    ddl = f"key {key_type}, n long, terms array<int>, tfs array<int>"
    return rows_of(docs.select(column(key), column(text)), prepare, ddl)


def _lists(offsets, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(values))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of a list column, whatever slice of a batch it is."""
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0], lists.flatten().to_numpy(zero_copy_only=False)


def impact_vectors(vectors: DataFrame, weights: np.ndarray, documents: int, all_terms: int) -> DataFrame:
    """Rows (key, terms, impacts, norm) of the documents that can score above 0."""

    def prepare():
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                lengths = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                offsets, terms = _flat(batch.column(2))
                tfs = _flat(batch.column(3))[1].astype(np.int64)
                owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
                m = 75 + (25 * lengths * documents) // all_terms
                impacts = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[owner])
                squares = np.bincount(owner, weights[terms] * impacts.astype(float) ** 2, batch.num_rows)
                able = pa.array(np.flatnonzero(squares > 0))
                yield {
                    "key": batch.column(0).take(able),
                    "terms": batch.column(2).take(able),
                    "impacts": _lists(offsets, impacts.astype(np.int32)).take(able),
                    "norm": pa.array(np.sqrt(squares)).take(able),
                }

        return work

    key_type = vectors.schema["key"].dataType.simpleString()
    ddl = f"key {key_type}, terms array<int>, impacts array<int>, norm double"
    return rows_of(vectors.select("key", "n", "terms", "tfs"), prepare, ddl)


class Item:
    """One item against buckets of documents: its vector, and its best so far."""

    def __init__(self, number: int, repeats: Mapping[int, int], weights: np.ndarray, least: int, most: int):
        self.number, self.most, self.least = number, most, least
        self.terms = np.fromiter(repeats.keys(), dtype=np.int64)
        counts = np.fromiter(repeats.values(), dtype=np.int64)
        self.gains = counts * weights[self.terms]
        coordinates = counts * np.sqrt(weights[self.terms])
        self.norm = math.sqrt(float((coordinates**2).sum()))
        heaviest = np.argsort(-coordinates, kind="stable")[:FOCUS]
        self.focus = list(zip(self.terms[heaviest].tolist(), coordinates[heaviest].tolist(), strict=True))
        rest = np.delete(coordinates, heaviest)
        self.rest = math.sqrt(float((rest**2).sum()))
        self.best: list[tuple[int, bool, object]] = []

    def offer(self, scores: list[int], keys: list) -> None:
        """Keep the best of what is kept and what is new."""
        new = [(-s, k is None, k) for s, k in zip(scores, keys, strict=True)]
        self.best = sorted(self.best + new, key=lambda b: b[:2] if b[1] else b)[: self.most]
        if len(self.best) == self.most:
            self.least = max(self.least, -self.best[-1][0])


class Bucket:
    """Vectors of similar length, by document and by term."""

    def __init__(self, keys: pa.Array, offsets, terms, impacts, norms, roots: np.ndarray):
        self.keys, self.offsets, self.terms, self.impacts, self.norms = keys, offsets, terms, impacts, norms
        owner = np.repeat(np.arange(len(norms)), np.diff(offsets))
        order = np.argsort(terms, kind="stable")
        self.known, starts = np.unique(terms[order], return_index=True)
        self.edges = np.append(starts, len(terms))
        self.owners = owner[order]
        self.coordinates = roots[terms[order]] * impacts[order]

    def bounds(self, item: Item) -> np.ndarray:
        """No document scores above its bound for the item."""
        product = np.zeros(len(self.norms))
        done = np.zeros(len(self.norms))
        for term, factor in item.focus:
            at = int(np.searchsorted(self.known, term))
            if at < len(self.known) and self.known[at] == term:
                span = slice(self.edges[at], self.edges[at + 1])
                values = self.coordinates[span]
                product[self.owners[span]] += factor * values
                done[self.owners[span]] += values**2
        left = np.maximum(self.norms**2 * SLACK - done, 0)
        return (product + item.rest * np.sqrt(left)) * SLACK

    def scores(self, item: Item, rows: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; ``gains`` is an array of zeros to work in."""
        sizes = self.offsets[rows + 1] - self.offsets[rows]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.offsets[rows] - (ends - sizes), sizes)
        gains[item.terms] = item.gains
        products = gains[self.terms[places]] * self.impacts[places]
        gains[item.terms] = 0
        return np.add.reduceat(products, ends - sizes)


def bucket_edges(norms: np.ndarray, most_rows: int = BUCKET_ROWS) -> Iterator[tuple[int, int]]:
    """Consecutive buckets of decreasing lengths."""
    start = 0
    while start < len(norms):
        shorter = np.searchsorted(-norms[start:], -norms[start] * BUCKET_SHARE, side="right")
        end = start + int(min(max(shorter, 1), most_rows))
        yield start, end
        start = end


def search(
    impacts: DataFrame,
    items: list[tuple[int, dict[int, int]]],
    weights: np.ndarray,
    least: Mapping[int, int],
    most: int,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Rows (item, key, score): of every task the best documents of each item that reach
    ``least``, its k-th score as far as known."""

    def prepare():
        own = [Item(number, repeats, weights, least.get(number, 1), most) for number, repeats in items]
        lengths = np.array([i.norm for i in own])
        roots = np.sqrt(weights)
        gains = np.zeros(len(weights), dtype=np.int64)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                norms = batch.column(3).to_numpy(zero_copy_only=False)
                for a, b in bucket_edges(norms, bucket_rows):
                    wanted = np.array([i.least for i in own], dtype=float)
                    able = np.flatnonzero(lengths * norms[a] * SLACK >= wanted)
                    if not len(able):
                        continue
                    part = batch.slice(a, b - a)
                    offsets, terms = _flat(part.column(1))
                    values = _flat(part.column(2))[1].astype(np.int64)
                    bucket = Bucket(part.column(0), offsets, terms, values, norms[a:b], roots)
                    for item in (own[i] for i in able):
                        rows = np.flatnonzero(bucket.bounds(item) >= item.least)
                        if not len(rows):
                            continue
                        scores = bucket.scores(item, rows, gains)
                        good = scores >= item.least
                        if good.sum() > most:
                            good &= scores >= np.partition(scores, -most)[-most]
                        if good.any():
                            item.offer(scores[good].tolist(), bucket.keys.take(pa.array(rows[good])).to_pylist())
            found = [(i.number, b[2], -b[0]) for i in own for b in i.best]
            if found:
                numbers, keys, scores = zip(*found, strict=True)
                yield {"item": list(numbers), "key": list(keys), "score": list(scores)}

        return work

    by_length = impacts.sortWithinPartitions(F.col("norm").desc())
    key_type = impacts.schema["key"].dataType.simpleString()
    return rows_of(by_length, prepare, f"item int, key {key_type}, score long")


def ranked(found: DataFrame, most: int) -> DataFrame:
    best_first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= most)


def search_block(
    docs: DataFrame, block: Block, *, key: str, text: str, most: int, seed_rows: int, bucket_rows: int
) -> DataFrame | None:
    """Rows (item, rank, key, score) of the items of one block."""
    vectors = materialize(term_vectors(docs, block.vocabulary, key=key, text=text), "vectors")
    documents, all_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    weights = np.zeros(len(block.vocabulary), dtype=np.int64)
    # At most one row for every term of the block.
    for term, having in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = weight(documents, having)
    impacts = materialize(impact_vectors(vectors, weights, documents, all_terms), "impacts")
    length = F.floor(CLASSES_PER_DOUBLING * F.log2("norm"))
    classes = impacts.groupBy(length.alias("class")).count().orderBy(F.col("class").desc()).collect()
    if not classes:
        return None
    longest = classes[0]["class"]
    seeds = 0
    for longest, rows in classes:
        seeds += rows
        if seeds >= seed_rows:
            break
    edge = 2.0 ** (longest / CLASSES_PER_DOUBLING)
    long_ones = search(impacts.filter(F.col("norm") >= edge), block.items, weights, {}, most, bucket_rows)
    first = materialize(ranked(long_ones, most), "first")
    reached = first.filter(F.col("rank") == most).select("item", "score").collect()  # a row an item at most
    known = {r["item"]: r["score"] for r in reached}
    others = search(impacts.filter(F.col("norm") < edge), block.items, weights, known, most, bucket_rows)
    return ranked(first.select("item", "key", "score").unionByName(others), most)


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    most: int = MOST,
    block_terms: int = BLOCK_TERMS,
    seed_rows: int = SEED_ROWS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Rows (item_key, rank, key, score): for each item the ``most`` documents of the
    highest scores above 0."""
    spark = docs.sparkSession
    queries = items.select(column(item_key).alias("id"), column(item_text).alias("raw"))
    keys: list = []

    def raw_items() -> Iterator[bytes]:
        for row in queries.toLocalIterator():
            keys.append(row["id"])
            yield (row["raw"] or "").encode()

    options = {"key": key, "text": text, "most": most, "seed_rows": seed_rows, "bucket_rows": bucket_rows}
    found = [search_block(docs, b, **options) for b in blocks(raw_items(), block_terms)]
    found = [f for f in found if f is not None]
    own = docs.select(column(key)).schema[0]
    if not found:
        empty = f"`{item_key}` {queries.schema['id'].dataType.simpleString()}, rank int"
        return spark.createDataFrame([], f"{empty}, `{key}` {own.dataType.simpleString()}, score long")
    numbering = StructType([StructField("item", IntegerType()), StructField("id", queries.schema["id"].dataType)])
    names = spark.createDataFrame(list(enumerate(keys)), numbering)
    whole = reduce(DataFrame.unionByName, found).join(names, "item")
    return whole.select(F.col("id").alias(item_key), "rank", F.col("key").alias(key), "score")
