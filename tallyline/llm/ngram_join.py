"""Similarity join on word n-grams: documents whose shingle sets have a Jaccard
similarity of ``percent``/100 or more are linked; linked documents form components.

Two sets that similar must share a token in their prefixes under *every* global order of
the tokens, so candidates are what passes under several orders, and only they are verified:

1. *By hash, upwards.* The lowest hashes of a set, a prefix lengthened by half its length,
   must share as many tokens with other sets as the prefix was lengthened by. This needs no
   statistics and leaves few sets besides true copies; only these go on.
2. *By rarity.* Tokens of the remaining sets are ranked by document frequency, the rarest
   first; sets meet at the tokens of their prefixes. Places of the meeting token and the
   numbers of tokens that no other set has bound the overlap before anything is compared.
3. *By hash, upwards and downwards.* Pairs must share prefix tokens under both orders
   before their whole sets are compared, exactly.

Equal sets are one class from the start. A group of sets that meet at a token is not
compared pair by pair: every set is first compared with the most typical set it meets, and
only sets still in different components after that meet again. No candidate is dropped:
each one is either in one component already or verified.

Defined cases: words are what lies between ASCII white space, with A-Z lower-cased; a
document of fewer words than a shingle has one shingle, all its words; null or empty texts,
or texts without words, have no shingles and link with nothing; texts of any length count
whole; repeated rows are copies and each get their row; a row without a key links with
nothing and has no component; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm import set_join
from tallyline.llm.arrow import add_columns, column, rows_of
from tallyline.llm.components import components
from tallyline.session import materialize

WORDS, PERCENT = 4, 85
# Bytes hashed at a time, and keys that may be sent to every executor.
BLOCK = 1 << 20
MOST_BROADCAST = 1_000_000

_random = np.random.default_rng(20_240_229)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_PLACES = _random.integers(1, 1 << 63, 64, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
# A-Z lower-cased, white space as 0.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_FOLD[[0x20, *range(0x09, 0x0E)]] = 0
_IS_WORD = _FOLD != 0
_IS_WORD[0] = True  # a zero byte is no white space
_BYTES = _BYTES[_FOLD]


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the input; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the words of many texts at once, from running sums over bytes."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def _reach(self, size: int) -> None:
        if size > len(self.powers):
            with np.errstate(over="ignore"):
                def series(factor: int) -> np.ndarray:
                    steps = np.full(size, factor, dtype=np.uint64)
                    steps[0] = 1
                    return np.multiply.accumulate(steps)

                self.powers, self.inverse = series(_STEP), series(pow(_STEP, -1, 1 << 64))

    def spans(self, raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words of the texts that begin at ``edges`` (the last edge
        is the end), and their sums: byte values times the powers of their places."""
        self._reach(len(raw) + 1)
        inside = _IS_WORD[raw]
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        finishes[:-1] &= ~inside[1:]
        inner = edges[(edges > 0) & (edges < len(raw))]
        begins[inner] = inside[inner]
        finishes[inner - 1] = inside[inner - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[raw] * self.powers[: len(raw)], out=sums[1:])
        return starts, ends, (sums[ends] - sums[starts]) * self.inverse[starts]

    def block(self, raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words of the texts, and the number of words before each edge."""
        starts, _, sums = self.spans(raw, edges)
        return mix(sums), np.searchsorted(starts, edges)

    def long(self, raw: np.ndarray) -> np.ndarray:
        """Word hashes of one text of any length, block by block; a word that crosses the
        end of a block goes on in the next."""
        found: list[np.ndarray] = []
        begun: tuple[int, int] | None = None
        for at in range(0, len(raw), BLOCK):
            part = raw[at : at + BLOCK]
            starts, ends, sums = self.spans(part, np.array([0, len(part)]))
            if begun:
                so_far, size = begun
                if len(starts) and starts[0] == 0:
                    sums[0] = np.uint64((so_far + int(sums[0]) * pow(_STEP, size, 1 << 64)) % (1 << 64))
                else:
                    found.append(np.array([so_far], dtype=np.uint64))
                    size = 0
            else:
                size = 0
            begun = None
            if len(ends) and ends[-1] == len(part):
                begun = (int(sums[-1]), int(ends[-1] - starts[-1]) + (size if len(starts) == 1 and starts[0] == 0 else 0))
                sums = sums[:-1]
            found.append(sums)
        if begun:
            found.append(np.array([begun[0]], dtype=np.uint64))
        return mix(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingle hashes of a text from its word hashes, in ascending order."""
    if not len(words):
        return words
    if len(words) < size:
        # Fewer words make one shingle that differs from any longer one.
        return mix((words * _PLACES[: len(words)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(size - len(words)))
    total = words[: len(words) - size + 1] * _PLACES[0]
    for i in range(1, size):
        total = total + words[i : len(words) - size + 1 + i] * _PLACES[i]
    return np.unique(mix(total))


def shingle_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each batch with the shingle sets of its last column."""
    hasher = WordHasher()
    for batch in batches:
        values = pc.fill_null(batch.column(batch.num_columns - 1), "").cast(pa.large_string())
        _, offsets, data = values.buffers()
        edges = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        sets: list[np.ndarray] = []
        at = 0
        while at < len(values):
            # As many texts as fit into a block, one at least.
            end = max(at + 1, int(np.searchsorted(edges, edges[at] + BLOCK, side="right")) - 1)
            part = raw[edges[at] : edges[end]]
            if end == at + 1 and len(part) > BLOCK:
                sets.append(shingles(hasher.long(part), size))
            elif not len(part):
                sets += [np.zeros(0, dtype=np.uint64)] * (end - at)
            else:
                hashes, places = hasher.block(part, edges[at : end + 1] - edges[at])
                sets += [shingles(hashes[a:b], size) for a, b in zip(places, places[1:], strict=False)]
            at = end
        yield batch, sets


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _signature(tokens: np.ndarray, salt: int) -> int:
    return int(mix(tokens ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64))


# ---- sizes of prefixes, for numbers and for columns --------------------------------


def least_overlap(n, percent: int):
    """The fewest tokens a set of n tokens shares with any set it is linked to."""
    return (n * percent + 99) // 100


def lengthened_by(n, percent: int):
    """By how much the first prefix is lengthened: half its length, 1 at least."""
    return (n - least_overlap(n, percent) + 2) // 2


def _lengthened_by(n: Column, percent: int) -> Column:
    return F.floor((n - set_join.least_overlap(n, percent) + 2) / 2)


# ---- the join ----------------------------------------------------------------------


def _signatures(sets: list[np.ndarray]) -> dict[str, list[int]]:
    return {
        "s1": [_signature(s, 0x5851F42D4C957F2D) for s in sets],
        "s2": [_signature(s, 0x14057B7EF767814F) for s in sets],
    }


def _measured(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows (row, key, n, s1, s2, sample): size and signature of every shingle set, and its
    lengthened prefix in the order of hashes."""

    def prepare():
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch, sets in shingle_sets(batches, size):
                ends = [n - least_overlap(n, percent) + lengthened_by(n, percent) for n in map(len, sets)]
                yield {
                    "row": batch.column(0),
                    "key": batch.column(1),
                    "n": [len(s) for s in sets],
                    **_signatures(sets),
                    "sample": _lists([s[:end] for s, end in zip(sets, ends, strict=True)]),
                }

        return work

    return rows_of(rows, prepare, "row long, key long, n long, s1 long, s2 long, sample array<long>")


def _promising(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Classes that share enough of their lengthened prefix with other classes."""
    found = sets.filter("key is not null and n > 0")
    postings = found.select("row", "s1", F.explode("sample").alias("token"))
    shared = postings.groupBy("token").agg(F.min("s1").alias("low"), F.max("s1").alias("high"))
    shared = materialize(shared.filter("low != high").select("token"), "tokens")
    counts = postings.select("token", "row").join(shared, "token").groupBy("row").agg(F.count(F.lit(1)).alias("shared"))
    least = set_join.least_overlap(F.col("n"), percent)
    enough = F.col("shared") >= _lengthened_by(least, percent)
    alive = found.select("row", "n", "s1", "s2").join(counts, "row").filter(enough).select("s1", "s2").distinct()
    return classes.join(alive, ["s1", "s2"], "left_semi")


def _whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Rows (cid, n, tokens) of the classes in ``wanted``, tokens in ascending order."""
    keys = wanted.select("key").distinct()
    # A checked size is sent to all; beyond it the texts are shuffled.
    keys = F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys
    rows = docs.join(keys, "key", "left_semi").select("key", "text")

    def prepare():
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch, sets in shingle_sets(batches, size):
                yield _signatures(sets) | {"tokens": _lists(sets)}

        return work

    # A key may stand on several rows with other texts; the signatures tell the classes.
    found = rows_of(rows, prepare, "s1 long, s2 long, tokens array<long>")
    mine = found.join(wanted.select("cid", "s1", "s2"), ["s1", "s2"])
    return mine.dropDuplicates(["cid"]).select("cid", F.size("tokens").cast("long").alias("n"), "tokens")


def _links(whole: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes that connect all components. Sets meet under the order
    of rarity; prefixes under the two orders by hash are compared next, whole sets last."""
    prefix = set_join.prefix_size(F.col("n"), percent).cast("int")
    sets = whole.select(
        "cid",
        "n",
        "tokens",
        F.slice("tokens", F.lit(1), prefix).alias("lowest"),
        F.slice("tokens", -prefix, prefix).alias("highest"),
    )
    meets = F.arrays_overlap("of_a.lowest", "of_b.lowest") & F.arrays_overlap("of_a.highest", "of_b.highest")
    linked = F.when(meets, set_join.similar(percent))
    members = set_join.prefixes(whole, percent).withColumnRenamed("token", "meet")
    return set_join.connecting_links(members, percent, lambda pairs: set_join.verified(pairs, sets, linked))


def _grouped(docs: DataFrame, *, key: str, text: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sets of all rows, and rows (s1, s2, key, component): the smallest key of every
    class and the component it is in."""
    narrow = docs.select(column(key).cast("long").alias("key"), column(text).alias("text"))
    numbered = narrow.select(F.monotonically_increasing_id().alias("row"), "key", "text")
    sets = materialize(_measured(numbered, words, percent), "sets")
    known = sets.filter("key is not null and n > 0")
    classes = known.groupBy("s1", "s2").agg(F.min("row").alias("cid"), F.min("key").alias("key"))
    classes = materialize(classes, "classes")
    wanted = materialize(_promising(sets, classes, percent), "wanted")
    whole = materialize(_whole_sets(narrow, wanted, words), "whole")
    linked = components(_links(whole, percent)).withColumnRenamed("node", "cid")
    grouped = classes.join(linked, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    return sets, materialize(grouped.select("s1", "s2", "key", "component"), "grouped")


def similarity_components(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: the key (a long), n_shingles and component_id, the smallest
    key that links lead to."""
    sets, grouped = _grouped(docs, key=key, text=text, words=words, percent=percent)
    least = materialize(grouped.groupBy("component").agg(F.min("key").alias("component_id")), "least")
    named = materialize(grouped.join(least, "component").select("s1", "s2", "component_id"), "named")
    placed = sets.select("key", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    component = F.when(F.col("n") == 0, F.col("key")).when(F.col("key").isNotNull(), F.col("component_id"))
    return placed.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row of ``docs`` for each component, of the smallest key and there of the smallest
    signature; a key whose rows have different texts may keep several. Of the rows of a key
    without words one stays; rows without a key all stay. The columns are those of ``docs``."""
    sets, grouped = _grouped(docs, key=key, text=text, words=words, percent=percent)
    first = grouped.groupBy("component").agg(F.min(F.struct("key", "s1", "s2")).alias("first")).select("first.*")
    empty = sets.filter("key is not null and n = 0").select("key", "s1", "s2").distinct()
    first = materialize(first.unionByName(empty), "first")
    # Only where a key has rows of several classes does the key not name the row.
    differ = (F.min("s1") != F.max("s1")) | (F.min("s2") != F.max("s2"))
    several = sets.filter("key is not null").groupBy("key").agg(differ.alias("differ")).filter("differ").select("key")
    several = materialize(several.join(first.select("key").distinct(), "key", "left_semi"), "several")
    plain = first.join(several, "key", "left_anti").select(F.col("key").alias("_kept"))
    by_key = docs.join(plain, column(key) == F.col("_kept"), "left_semi").dropDuplicates([key])
    kept = by_key.unionByName(docs.filter(column(key).isNull()))
    n = several.count()
    if not n:
        return kept
    # A checked size is sent to all, as in _whole_sets.
    names = several.withColumnRenamed("key", "_kept")
    names = F.broadcast(names) if n <= MOST_BROADCAST else names
    rows = docs.join(names, column(key) == F.col("_kept"), "left_semi")

    def prepare():
        def work(values: pa.Array) -> list:
            batch = pa.RecordBatch.from_arrays([values], ["text"])
            found = [s for _, sets in shingle_sets(iter([batch]), words) for s in sets]
            return list(_signatures(found).values())

        return work

    signed = add_columns(rows, [text], prepare, "_s1 long, _s2 long")
    wanted = first.select(F.col("key").alias("_kept"), F.col("s1").alias("_k1"), F.col("s2").alias("_k2"))
    same = (column(key) == F.col("_kept")) & (F.col("_s1") == F.col("_k1")) & (F.col("_s2") == F.col("_k2"))
    found = signed.join(wanted, same, "left_semi").dropDuplicates([key, "_s1", "_s2"])
    return kept.unionByName(found.select(*map(column, docs.columns)))
