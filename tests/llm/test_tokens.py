"""Token counts, encoding, decoding and packing against the public libraries."""

import base64
import random
import struct
import zlib

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_rows import by_id
from tallyline.llm import byte_bpe, packing, token_counts

TEXTS = [
    "",
    None,
    "Hello world, it's 12 o'clock!!  \n\n x",
    "a<|endoftext|>b <|endoftext|>",
    "naïve Straße – 東京 🙂🙂 ½ ²",
    "   leading\t\ttabs\r\nand  trailing   ",
    "x" * 3000,
    " " * 700 + "\n" * 700,
    "aaaaabaaaaab" * 60,
    "Repeated row",
    "Repeated row",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def ranks():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})


def random_texts(n, seed=3):
    draw = random.Random(seed)
    alphabet = ["a", "B", "é", "the", " ", "  ", "\n", "'", "'s", "12", "!", "東", " ", "_", "…", "🙂"]
    return ["".join(draw.choices(alphabet, k=draw.randint(0, 120))) for _ in range(n)]


def test_counts_equal_the_library(documents, library):
    texts = TEXTS + random_texts(150)
    counted = token_counts.with_token_counts(documents(*texts).drop("n_chars"), limit=100)
    found = by_id(counted, "n_bytes", "n_tokens", "over_limit")
    for i, t in enumerate(texts):
        size = len(library.encode(t or "", add_special_tokens=False).ids)
        assert found[i] == (len((t or "").encode()), size, size > 100), repr(t)


def test_clashing_and_extra_columns(documents):
    docs = documents("one two").withColumn("N_Tokens", F.lit("old")).withColumn("odd name.x", F.lit(1))
    row = token_counts.with_token_counts(docs).first()
    assert row["n_tokens"] == 2 and row["odd name.x"] == 1


def test_empty_tables(documents):
    none = documents("x").limit(0)
    assert token_counts.with_token_counts(none).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(none)).count() == 0
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("chunk, overlap", [(10_000, 64), (50, 20), (7, 3), (64, 1)])
def test_encoding_equals_the_library_for_any_chunks(documents, ranks, chunk, overlap):
    texts = TEXTS + random_texts(40)
    found = by_id(byte_bpe.encode(documents(*texts), chunk=chunk, overlap=overlap), "ids", "n_tokens")
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        ids = ranks.encode_ordinary(t or "")
        assert bytes(found[i][0]) == struct.pack(f"<{len(ids)}I", *ids), repr(t)
        assert found[i][1] == len(ids)


def test_decoding_is_the_inverse(documents):
    texts = TEXTS + random_texts(40)
    found = by_id(byte_bpe.decode(byte_bpe.encode(documents(*texts), chunk=40, overlap=10)), "decoded")
    assert [bytes(found[i]).decode() for i in range(len(texts))] == [t or "" for t in texts]


def test_short_words_merge_without_a_heap(monkeypatch):
    """As many bytes as most words have; with the same tokens as the heap of long ones."""
    encoder = byte_bpe.Encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    draw = random.Random(3)
    alphabets = ["etaoinshrdlu ", "ab", "é語🙂a", "0=#\n"]
    words = ["".join(draw.choices(draw.choice(alphabets), k=draw.randrange(1, 12))).encode() for _ in range(400)]
    words += [b"", b"a", b"\xff\xfe", b"theatheathe" * 9, b"ab" * (byte_bpe.SHORT // 2), b"ab" * (byte_bpe.SHORT // 2) + b"a"]
    assert all(encoder.merged_short(w) == encoder.merged_long(w) for w in words)
    monkeypatch.setattr(byte_bpe, "heapify", None)
    assert b"".join(encoder.merged(b" theaatble")) == b" theaatble"


def test_cuts_need_agreement():
    # Two chunks that never agree stay together.
    word = "z" * 100
    marks = [byte_bpe.boundaries(word[k : k + 30], P.PATTERN, k) for k in range(0, 100, 20)]
    assert byte_bpe.cut_points(word, marks, 20, 10, P.PATTERN) == [0]


def test_an_endless_word_is_stitched_in_linear_time():
    pattern, chunk, overlap = P.PATTERN, byte_bpe.CHUNK, byte_bpe.OVERLAP
    read = []
    for size in (1 << 20, 1 << 23):
        word = "z" * size
        # What each chunk reports: its start, and nothing at its other edge.
        marks = [[at] for at in range(0, size, chunk)]
        asked = []
        original, byte_bpe.boundaries = byte_bpe.boundaries, lambda t, p, base=0: asked.append(len(t)) or original(t, p, base)
        try:
            assert byte_bpe.cut_points(word, marks, chunk, overlap, pattern) == [0]
        finally:
            byte_bpe.boundaries = original
        read.append(sum(asked))
    assert read[1] <= 4 << 23 and read[1] <= 12 * read[0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cuts_of_words_longer_than_chunks(documents, ranks, seed):
    draw = random.Random(seed)
    text = "".join(draw.choice(["z" * draw.randint(1, 400), " ", "\n\n", "12", "é" * 90, "it's "]) for _ in range(60))
    row = byte_bpe.encode(documents(text), chunk=32, overlap=8).first()
    ids = ranks.encode_ordinary(text)
    assert bytes(row["ids"]) == struct.pack(f"<{len(ids)}I", *ids)


def check_packing(packed, texts, library, sequence):
    whole = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    sequences = {}
    covered = dict.fromkeys(whole, 0)
    for r in sorted(packed.collect(), key=lambda r: (r["doc_id"], r["piece"])):
        ids = whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == covered[r["doc_id"]] and 1 <= len(ids) == r["length"] <= sequence
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        covered[r["doc_id"]] += r["length"]
        if len(whole[r["doc_id"]]) <= sequence:
            assert r["piece"] == 0
        elif r["piece"]:
            assert r["length"] == sequence
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert covered == {i: len(ids) for i, ids in whole.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence
    return len(sequences), -(-sum(map(len, whole.values())) // sequence)


def test_packing(documents, library):
    texts = TEXTS + random_texts(300)
    packed = packing.pack_documents(documents(*texts), sequence=128)
    used, least = check_packing(packed, texts, library, 128)
    # Few pieces in an order of their own: the last bins stay partly empty.
    assert used <= least * 1.05


def test_packing_over_many_tasks_and_few_bins(documents, library):
    texts = random_texts(300, seed=5)
    items = packing.pieces(documents(*texts), sequence=128)
    packed = packing.pack(items, sequence=128, open_bins=3, pieces_per_task=50)
    used, least = check_packing(packed, texts, library, 128)
    assert used <= least * 1.3 + 6


@pytest.mark.parametrize("low, high", [(600, 1400), (1, 2048)])
def test_more_bins_than_a_task_keeps_open(spark, low, high):
    draw = random.Random(6)
    lengths = [draw.randint(low, high) for _ in range(6000)]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length int")
    packed = packing.pack(df, pieces_per_task=6000)
    used = packed.select("sequence_id").distinct().count()
    assert packed.count() == 6000 and used <= 1.06 * sum(lengths) / packing.SEQUENCE
    # The same pieces in the order of the table close bins, too, and end as full.
    bins = packing.OpenBins(packing.SEQUENCE, packing.OPEN_BINS)
    for n in lengths:
        bins.put(n)
    assert bins.closed > 100 and bins.made <= 1.06 * sum(lengths) / packing.SEQUENCE


def test_pieces_come_in_an_order_of_their_own(spark):
    rows = [(i, 100 + i) for i in range(400)]
    placed = packing.pack(spark.createDataFrame(rows, "doc_id long, length int")).collect()
    first = [r["length"] for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"]))][:40]
    assert first != sorted(first) and first != sorted(first, reverse=True)


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert bins.put(7) == (0, 0)
    assert bins.put(5) == (1, 0)
    assert bins.put(6) == (2, 0)  # bin 0 has the least room and closes
    assert bins.put(4) == (2, 6)  # best fit: bin 2 has exactly 4 left
    assert bins.put(3) == (1, 5)
    assert bins.put(10) == (3, 0)


def test_ids_of_pieces(documents, library):
    row = packing.pieces(documents("one two three"), with_ids=True).first()
    ids = library.encode("one two three", add_special_tokens=False).ids
    assert bytes(row["ids"]) == struct.pack(f"<{len(ids) + 1}I", *ids, 0)
