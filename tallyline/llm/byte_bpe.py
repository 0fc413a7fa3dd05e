"""Byte-level BPE encoding and decoding with a rank file.

Long texts are cut into overlapping chunks that tasks pre-tokenise in parallel. A chunk
may begin inside a pre-token, so its first boundaries can be wrong; but a boundary that
two neighbours both found puts them in step from there on, since a pre-token depends only
on the text from its start. The texts are cut at such places and the pieces are encoded in
parallel; a text of one chunk is one piece from the start. Decoding concatenates the raw
bytes of the tokens.

Defined cases: a null or empty text has no ids and decodes to no bytes; strings of special
tokens are ordinary text; chunks without a common boundary in their overlap (one endless
word) stay together in one piece, so the result never depends on the chunk size; repeated
rows each get their row; input columns other than the text pass through, those named like
a result are replaced by it.
"""

from __future__ import annotations

import base64
import struct
from bisect import bisect_left
from functools import lru_cache
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrow import add_columns, column, texts

# Characters of a chunk and of what it reads beyond its end.
CHUNK, OVERLAP = 32_768, 512
REMEMBERED_PIECES = 250_000
# Bytes up to which looking through all pairs of a pre-token is faster than a heap of them.
SHORT = 32
NO_RANK = 1 << 60


class Encoder(dict):
    """The ids of a pre-token as little-endian 32-bit bytes, worked out on first use."""

    def __init__(self, vocabulary: str, pattern: str):
        super().__init__()
        with open(vocabulary, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        # The rank of every pair of bytes.
        self.first_ranks = [self.ranks.get(bytes(divmod(pair, 256)), NO_RANK) for pair in range(1 << 16)]
        self.pre_tokens = regex.compile(pattern).findall

    def __missing__(self, pre_token: str) -> bytes:
        if len(self) >= REMEMBERED_PIECES:
            self.clear()
        raw = pre_token.encode("utf-8")
        whole = self.ranks.get(raw)
        ids = [whole] if whole is not None else list(map(self.ranks.__getitem__, self.merged(raw)))
        self[pre_token] = packed = packer(len(ids))(*ids)
        return packed

    def merged(self, raw: bytes) -> list[bytes]:
        """The tokens left when no adjacent pair forms a token any more; the pair of the
        lowest rank merges first, the leftmost of equals."""
        return self.merged_short(raw) if len(raw) <= SHORT else self.merged_long(raw)

    def merged_short(self, raw: bytes) -> list[bytes]:
        rank_of = self.ranks.get
        # Token i is raw[starts[i] : starts[i + 1]], ranks[i] that of its pair with the next one.
        starts = list(range(len(raw) + 1))
        ranks = [self.first_ranks[a << 8 | b] for a, b in zip(raw, raw[1:])]
        while ranks and (lowest := min(ranks)) != NO_RANK:
            at = ranks.index(lowest)
            del starts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(raw[starts[at] : starts[at + 2]], NO_RANK)
            if at:
                ranks[at - 1] = rank_of(raw[starts[at - 1] : starts[at + 1]], NO_RANK)
        return [raw[a:b] for a, b in zip(starts, starts[1:])]

    def merged_long(self, raw: bytes) -> list[bytes]:
        rank_of = self.ranks.get
        starts = list(range(len(raw)))
        ends = [s + 1 for s in starts]
        heap = [(rank, s, s + 2) for s in starts[:-1] if (rank := rank_of(raw[s : s + 2])) is not None]
        heapify(heap)
        # ends[s] is the end of the token that starts at s; starts_before finds its neighbour.
        starts_before = [s - 1 for s in starts] + [len(raw) - 1]
        alive = [True] * len(raw)
        while heap:
            _, start, end = heappop(heap)
            middle = ends[start]
            if not alive[start] or middle >= end or ends[middle] != end:
                continue
            alive[middle] = False
            ends[start] = end
            starts_before[end] = start
            if end < len(raw) and (rank := rank_of(raw[start : ends[end]])) is not None:
                heappush(heap, (rank, start, ends[end]))
            if start and (rank := rank_of(raw[(left := starts_before[start]) : end])) is not None:
                heappush(heap, (rank, left, end))
        return [raw[s : ends[s]] for s in starts if alive[s]]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pre_tokens(text)))


@lru_cache(maxsize=SHORT)
def packer(ids: int):
    return struct.Struct(f"<{ids}I").pack


@lru_cache(maxsize=2)
def encoder(vocabulary: str, pattern: str) -> Encoder:
    return Encoder(vocabulary, pattern)


@lru_cache(maxsize=2)
def token_bytes(vocabulary: str) -> dict[int, bytes]:
    with open(vocabulary, "rb") as file:
        return {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in file if line.strip())}


@lru_cache(maxsize=2)
def splitter(pattern: str):
    return regex.compile(pattern)


def boundaries(text: str, pattern: str, base: int = 0) -> list[int]:
    """Where the pre-tokens of ``text`` begin."""
    return [base + m.start() for m in splitter(pattern).finditer(text)]


def cut_points(text: str, marks: list[list[int]], chunk: int, overlap: int, pattern: str) -> list[int]:
    """Places where the text may be cut so that its pieces pre-tokenise like the whole.

    ``marks`` holds the boundaries that each chunk found on its own where it overlaps its
    neighbours. A cut follows a
    character that is not white space, because white space may look ahead of the cut."""
    cuts = [0]
    known, read_to, width = marks[0], min(len(text), chunk + overlap), chunk
    for k in range(1, len(marks)):
        start, needed = k * chunk, min(len(text), (k + 1) * chunk + overlap)
        found = set(marks[k])
        # The last boundary before the end of what was read may move with more text.
        trusted = known if read_to == len(text) else known[:-1]
        at = next((b for b in trusted if b >= start and b > cuts[-1] and b in found and not text[b - 1].isspace()), None)
        if at is not None:
            cuts.append(at)
            known, read_to, width = marks[k], needed, chunk
        elif read_to < needed:
            # Out of step: go on from the last sure boundary, twice as far each time, so
            # that one endless word is read a few times and not once for each chunk.
            sure = known[-2] if len(known) > 1 else known[0]
            width *= 2
            read_to = min(len(text), max(needed, sure + width))
            known = [b for b in known if b < sure] + boundaries(text[sure:read_to], pattern, sure)
    return cuts


def _pieces_of_long_texts(long: DataFrame, chunk: int, overlap: int, pattern: str) -> DataFrame:
    """Rows (_row, _piece, _keep, _text) of the texts of more than one chunk. The carried
    columns travel with the first piece."""
    starts = F.sequence(F.lit(0), F.length("_text") - 1, F.lit(chunk))
    chunks = long.select("_row", "_keep", "_text", F.posexplode(starts).alias("_chunk", "_start")).select(
        "_row",
        "_chunk",
        F.when(F.col("_chunk") == 0, F.col("_keep")).alias("_keep"),
        F.expr(f"substring(_text, _start + 1, {chunk + overlap})").alias("_slice"),
    )

    def prepare():
        def at_edges(found: list[int]) -> list[int]:
            # Neighbours are compared in the overlap only; one boundary more on its left
            # is where to go on from if they are out of step.
            tail = max(0, bisect_left(found, chunk) - 1)
            return found[: min(tail, bisect_left(found, overlap + 1))] + found[tail:]

        def work(slices: pa.Array) -> list:
            return [[at_edges(boundaries(s, pattern)) for s in texts(slices)]]

        return work

    marked = add_columns(chunks.repartition("_row", "_chunk"), ["_slice"], prepare, "_marks array<int>")
    schema = chunks.selectExpr("_row", "cast(_chunk as long) as _piece", "_keep", "_slice as _text").schema

    def stitch(table: pa.Table) -> pa.Table:
        table = table.sort_by("_chunk")
        slices, found = table["_slice"].to_pylist(), table["_marks"].to_pylist()
        text = "".join(s[:chunk] for s in slices[:-1]) + slices[-1]
        marks = [[k * chunk + m for m in own] for k, own in enumerate(found)]
        cuts = cut_points(text, marks, chunk, overlap, pattern)
        pieces = [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]
        first = pa.array([0] + [None] * (len(pieces) - 1), type=pa.int64())
        return pa.table(
            {
                "_row": table["_row"].take([0] * len(pieces)),
                "_piece": pa.array(range(len(pieces)), type=pa.int64()),
                "_keep": table["_keep"].take(first),
                "_text": pieces,
            }
        )

    return marked.groupBy("_row").applyInArrow(stitch, schema)


def encode(
    docs: DataFrame,
    *,
    text: str = "text",
    vocabulary: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` without its text, with n_tokens and ids (little-endian unsigned 32-bit)."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    results = {"n_tokens", "ids", text.lower()}
    carried = [c for c in docs.columns if c.lower() not in results]
    keep = F.struct(*[column(c) for c in carried]) if carried else F.struct(F.lit(None).cast("string").alias("_none"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        keep.alias("_keep"),
        F.coalesce(column(text), F.lit("")).alias("_text"),
    )
    is_long = F.length("_text") > chunk

    def prepare():
        packed = encoder(vocabulary, pattern).encode

        def work(pieces: pa.Array) -> list:
            return [[packed(t) for t in texts(pieces)]]

        return work

    def encoded(pieces: DataFrame) -> DataFrame:
        return add_columns(pieces, ["_text"], prepare, "ids binary").drop("_text")

    # Encoding follows a shuffle by piece, so that one long text keeps many tasks busy.
    pieces = encoded(_pieces_of_long_texts(rows.filter(is_long), chunk, overlap, pattern).repartition("_row", "_piece"))

    def join_ids(table: pa.Table) -> pa.Table:
        table = table.sort_by("_piece")
        return pa.table({"_keep": table["_keep"].take([0]), "ids": [b"".join(table["ids"].to_pylist())]})

    long_ids = pieces.groupBy("_row").applyInArrow(join_ids, pieces.select("_keep", "ids").schema)
    short_ids = encoded(rows.filter(~is_long)).select("_keep", "ids")
    both = short_ids.unionByName(long_ids)
    named = [F.col("_keep")[c].alias(c) for c in carried]
    return both.select(*named, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def decode(df: DataFrame, *, ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``df`` with the column decoded: the raw bytes of its ids, one after the other. An id
    that the vocabulary lacks is an error."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def prepare():
        tokens = token_bytes(vocabulary)

        def work(packed: pa.Array) -> list:
            def one(raw: bytes | None) -> bytes:
                return b"".join(map(tokens.__getitem__, struct.unpack(f"<{len(raw) // 4}I", raw))) if raw else b""

            return [[one(raw) for raw in packed.to_pylist()]]

        return work

    return add_columns(df, [ids], prepare, "decoded binary")
