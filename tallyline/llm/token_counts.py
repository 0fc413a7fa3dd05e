"""Token counts of a byte-level BPE vocabulary, without building identifiers.

Texts are split by the vocabulary's pattern. The bytes of a piece form a linked list; a
heap holds the adjacent pairs that the vocabulary can merge, lowest rank first, leftmost
first among equals. Every merge removes one symbol, so the count of a piece is its number
of bytes less its number of merges. Pieces repeat, so a worker remembers their counts.

Defined cases: a null or empty text has no bytes and no tokens; the vocabulary's special
strings count as one token each wherever they occur, as the library does by default;
texts of any length are counted whole; repeated rows each get their row; input columns
other than the text pass through, those named like a result are replaced by it. Letters
and digits are those of the ``regex`` module's Unicode tables; a library with older
tables may split code points that Unicode assigned later differently.
"""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrow import add_columns, texts

# Pieces a worker remembers; beyond that it starts anew, which costs time, not rows.
REMEMBERED_PIECES = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class MergeCounter(dict):
    """Token counts by piece, worked out when a piece is first asked for."""

    def __init__(self, vocabulary: str, pattern: str):
        super().__init__()
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): r for r, m in enumerate(spec["model"]["merges"])}
        self.symbols = byte_symbols()
        self.pieces = regex.compile(pattern).findall
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED_PIECES:
            self.clear()
        symbols = [self.symbols[b] for b in piece.encode("utf-8")]
        self[piece] = found = len(symbols) - self.merges(symbols)
        return found

    def merges(self, symbols: list[str]) -> int:
        """How often the lowest-ranked adjacent pair can be merged. ``symbols`` is used up."""
        ranks = self.ranks
        size = len(symbols)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        heap = [
            (rank, left, pair)
            for left, pair in enumerate(zip(symbols, symbols[1:], strict=False))
            if (rank := ranks.get(pair)) is not None
        ]
        heapify(heap)
        done = 0
        while heap:
            _, left, (first, second) = heappop(heap)
            right = after[left]
            # An entry is stale once either of its symbols has been merged away or grown.
            if right >= size or symbols[left] != first or symbols[right] != second:
                continue
            done += 1
            symbols[left] = first + second
            symbols[right] = ""
            after[left] = following = after[right]
            if following < size:
                before[following] = left
                pair = (symbols[left], symbols[following])
                if (rank := ranks.get(pair)) is not None:
                    heappush(heap, (rank, left, pair))
            previous = before[left]
            if previous >= 0:
                pair = (symbols[previous], symbols[left])
                if (rank := ranks.get(pair)) is not None:
                    heappush(heap, (rank, previous, pair))
        return done

    def count(self, text: str) -> int:
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(part))) for part in parts)
        return sum(map(self.__getitem__, self.pieces(text)))


@lru_cache(maxsize=2)
def counter(vocabulary: str, pattern: str) -> MergeCounter:
    return MergeCounter(vocabulary, pattern)


def with_token_counts(
    docs: DataFrame,
    *,
    text: str = "text",
    vocabulary: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    limit: int = 512,
) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens)."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def prepare():
        count = counter(vocabulary, pattern).count

        def work(column: pa.Array) -> list:
            return [pc.fill_null(pc.binary_length(column), 0).cast(pa.int64()), [count(t) for t in texts(column)]]

        return work

    counted = add_columns(docs, [text], prepare, "n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
