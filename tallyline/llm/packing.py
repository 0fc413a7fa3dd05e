"""Best-fit packing of documents into sequences of a fixed length.

A document is its token ids and an end mark. One longer than a sequence is cut into whole
sequences; what is left over is its first piece. Pieces are dealt out to as many tasks as
their number asks for; each task packs its own by bounded-space online best fit: pieces
come in an order that has nothing to do with their length (by hash, so that it can be
repeated), the open bins are kept by free space, a bitset over the free spaces finds the
fullest bin that still takes a piece, and when all bins are open the fullest closes.

Defined cases: a null or empty text is the end mark alone; texts of any length are packed
whole; repeated rows are packed as often as they occur; an empty table gives no pieces;
input columns other than the id and the text are ignored. Ties in length, or in hash, are
broken by document, piece and content, so a repeated task packs alike.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrow import column, rows_of, texts
from tallyline.llm.token_counts import byte_symbols
from tallyline.session import materialize

SEQUENCE = 2048
# Pieces a task packs, and bins it keeps open at a time.
PIECES_PER_TASK = 100_000
OPEN_BINS = 256


class DocumentTokens:
    """Token ids of whole documents. The ids of a vocabulary file whose merges are in the
    order of its ids, as byte-level BPE files have them, are its merge ranks."""

    def __init__(self, vocabulary: str, pattern: str, end: int):
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
        }
        made = ("".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"])
        merged = [ranks[bytes(byte_of[c] for c in token)] for token in made]
        if merged != sorted(merged):
            raise ValueError("the merges of the vocabulary are not in the order of its ids")
        self.special, self.end = tuple(special), end
        self.encoding = tiktoken.Encoding("documents", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            found = self.encoding.encode(text, allowed_special="all")
        else:
            found = self.encoding.encode_ordinary(text)
        found.append(self.end)
        return np.array(found, dtype="<u4")


@lru_cache(maxsize=2)
def document_tokens(vocabulary: str, pattern: str, end: int) -> DocumentTokens:
    return DocumentTokens(vocabulary, pattern, end)


def pieces(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    end: int = 0,
    sequence: int = SEQUENCE,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents: key, piece, start, length, ids_crc32 and, if asked
    for, ids. Only documents longer than a sequence have more than one."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def prepare():
        tokens = document_tokens(vocabulary, pattern, end)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                rows: list[int] = []
                numbers, starts, lengths, sums, raws = [], [], [], [], []
                for row, text in enumerate(texts(batch.column(1))):
                    ids = tokens.ids(text)
                    first = len(ids) % sequence or sequence
                    edges = [0, *range(first, len(ids) + 1, sequence)]
                    for number, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        raw = ids[a:b].tobytes()
                        rows.append(row)
                        numbers.append(number)
                        starts.append(a)
                        lengths.append(b - a)
                        sums.append(zlib.crc32(raw))
                        if with_ids:
                            raws.append(raw)
                found = {
                    "key": batch.column(0).take(pa.array(rows, type=pa.int64())),
                    "piece": numbers,
                    "start": starts,
                    "length": lengths,
                    "ids_crc32": sums,
                }
                yield found | ({"ids": raws} if with_ids else {})

        return work

    key_type = docs.select(column(key)).schema[0].dataType.simpleString()
    ddl = f"key {key_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows_of(docs.select(column(key), column(text)), prepare, ddl).withColumnRenamed("key", key)


class OpenBins:
    """Open bins by free space. Bit f of the bitset says that a bin has f places free."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits, self.open, self.made, self.closed = 0, 0, 0, 0

    def _take(self, space: int) -> int:
        bins = self.free[space]
        found = bins.pop()
        if not bins:
            self.bits &= ~(1 << space)
        self.open -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        """The bin of the next piece and its offset there."""
        roomy = self.bits >> length
        if roomy:
            space = length + (roomy & -roomy).bit_length() - 1
            chosen = self._take(space)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.closed += 1
            space, chosen = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            self.free[left].append(chosen)
            self.bits |= 1 << left
            self.open += 1
        return chosen, self.capacity - space


def pack(
    items: DataFrame,
    *,
    length: str = "length",
    sequence: int = SEQUENCE,
    open_bins: int = OPEN_BINS,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """``items`` with sequence_id and offset. Every length must be between 1 and
    ``sequence``. The items are written once and counted, as the number of tasks follows
    from their number; ``items`` should be narrow."""
    names = [c for c in items.columns if c.lower() not in {"sequence_id", "offset"}]
    items = materialize(items.select(*[column(c) for c in names]), "pieces")
    tasks = max(1, -(-items.count() // pieces_per_task))
    by = [column(c) for c in names]
    dealt = items.repartition(tasks).sortWithinPartitions(F.xxhash64(*by), *by)
    numbered = dealt.withColumn("_task", F.spark_partition_id().cast("long"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)

    def prepare():
        bins = OpenBins(sequence, open_bins)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                columns = dict(zip(batch.schema.names, batch.columns, strict=True))
                placed = [bins.put(n) for n in columns[length].to_pylist()]
                first = columns.pop("_task")[0].as_py() << 40 if batch.num_rows else 0
                yield columns | {
                    "sequence_id": [first + chosen for chosen, _ in placed],
                    "offset": [offset for _, offset in placed],
                }

        return work

    return rows_of(numbered, prepare, f"{ddl}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Pieces of all documents with their places: key, piece, start, length, ids_crc32,
    sequence_id and offset. ``options`` are those of :func:`pieces`."""
    return pack(pieces(docs, **options), sequence=options.get("sequence", SEQUENCE))
