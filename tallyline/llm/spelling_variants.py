"""Spelling variants: words one edit apart, found by sorted permuterm rotations.

A word with a terminator has one rotation for each of its places. The rotation that starts
after a letter ends with that letter, so words that differ in it agree in all but the last
character; and a word with one letter more agrees so with a whole rotation of the shorter
word. Each word therefore writes its whole rotations and its rotations without their last
letter; these prefixes are shuffled and sorted, and one scan over a group of equal ones
finds replacements (cut against cut) and indels (whole against cut). A group holds one
whole rotation at most and one cut one for each letter of the alphabet, so no group grows
with the table. Of letters that repeat side by side only the last one is left out against
a shorter word: each pair of words meets exactly once, and counts need no deduplication.

A group hands on one row a member (how many neighbours, the best of them), never its pairs.
Prefixes over ``KEY_CHARS`` are replaced by a 127-bit polynomial digest, which costs the
same for each rotation, so a word takes space in proportion to its length.

The form of a word is its most frequent neighbour if that is frequent enough; counts at
least double along forms, so the pointers have no cycle and are short; they are followed
by doubling.

Defined cases: a null or empty text has no words; texts and words of any length are taken
whole; repeated rows count as often as they occur; a null key is written as the empty
text where the key enters a hash; an empty table gives no words; input columns other than
the key and the text are ignored. Ties in frequency go to the smallest word by code points.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrow import SLICE_ROWS, column, rows_of
from tallyline.session import materialize

LEAST_CHARS, LEAST_COUNT = 5, 3
# A form is at least so many times as frequent as the word.
FORM_RATIO = 2
MISPRINT_EVERY = 97
TERMINATOR = "$"
KEY_CHARS = 64
# Distinct words a task holds before it hands them on.
WORDS_HELD = 300_000
ENTRIES_HELD = 50_000

WHOLE, CUT, CUT_LAST = 0, 1, 2

_MODULUS, _BASE = (1 << 127) - 1, 0x9E3779B97F4A7C15F39CC0605CEDC835


def misprinted(run: str, h: int) -> str:
    """The run, without one letter where its hash says so."""
    if h % MISPRINT_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """Rows (word, n) of all words of enough letters."""
    # A run that loses no letter needs so many to be a word, and no run fewer.
    runs = re.compile(r"[a-zÀ-ÿ]{%d,}" % max(least_chars, 1)).findall

    def prepare():
        def rows(counts: Counter) -> dict:
            return {"word": list(counts.keys()), "n": list(counts.values())}

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            counts: Counter = Counter()
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    raws = part.column(1).cast(pa.binary()).to_pylist()
                    for doc, raw in zip(part.column(0).to_pylist(), raws, strict=True):
                        if not raw:
                            continue
                        begun = zlib.crc32(f"{doc}:".encode())
                        # Bytes.lower changes A to Z alone.
                        for run, n in Counter(runs(raw.lower().decode())).items():
                            h = zlib.crc32(run.encode(), begun)
                            if h % MISPRINT_EVERY == 0:
                                run = misprinted(run, h)
                                if len(run) < least_chars:
                                    continue
                            counts[run] += n
                        if len(counts) > WORDS_HELD:
                            yield rows(counts)
                            counts = Counter()
            if counts:
                yield rows(counts)

        return work

    source = docs.select(F.coalesce(column(key).cast("string"), F.lit("")).alias("key"), column(text).alias("text"))
    counted = rows_of(source, prepare, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> DataFrame:
    """The words with ids in code-point order, written."""
    # The order of Spark's strings is that of their UTF-8, which is that of code points.
    ordered = words.orderBy("word").withColumn("id", F.monotonically_increasing_id())
    return materialize(ordered.select("id", "word", "n"), "words")


def prefix_keys(word: str) -> Callable[[int, int], str]:
    """The key of what is left of the terminated word when the rotation starts at place
    ``start`` and ends before place ``end``: word[start:] + terminator + word[:end]."""
    size = len(word)
    if size < KEY_CHARS:
        return lambda start, end: word[start:] + TERMINATOR + word[:end]
    sums, powers = [0], [1]
    for letter in word:
        sums.append((sums[-1] * _BASE + ord(letter)) % _MODULUS)
        powers.append(powers[-1] * _BASE % _MODULUS)
    powers.append(powers[-1] * _BASE % _MODULUS)

    def key(start: int, end: int) -> str:
        if size - start + 1 + end <= KEY_CHARS:
            return word[start:] + TERMINATOR + word[:end]
        tail = (sums[size] - sums[start] * powers[size - start]) % _MODULUS
        marked = tail * _BASE + ord(TERMINATOR)
        return f"#{(marked * powers[end] + sums[end]) % _MODULUS:032x}"

    return key


def rotations(word: str) -> Iterator[tuple[str, int]]:
    """(prefix, kind) of every whole rotation and of every one without its last letter."""
    size = len(word)
    key = prefix_keys(word)
    for i in range(size + 1):
        yield key(i, i), WHOLE
    for i in range(size):
        last = i + 1 == size or word[i] != word[i + 1]
        yield key(i + 1, i), CUT_LAST if last else CUT


def rotation_table(words: DataFrame) -> DataFrame:
    """Rows (prefix, id, n, kind) of all words."""

    def prepare():
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            out: tuple[list, ...] = ([], [], [], [])

            def rows() -> dict:
                return dict(zip(("prefix", "id", "n", "kind"), map(list, out), strict=True))

            for batch in batches:
                for number, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for prefix, kind in rotations(word):
                        for values, value in zip(out, (prefix, number, n, kind), strict=True):
                            values.append(value)
                        if len(out[0]) >= ENTRIES_HELD:
                            yield rows()
                            for values in out:
                                values.clear()
            if out[0]:
                yield rows()

        return work

    return rows_of(words.select("id", "word", "n"), prepare, "prefix string, id long, n long, kind byte")


def group_neighbours(members: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(id, neighbours, n and id of the best) of the members (id, n, kind) of one prefix."""
    whole = next((m for m in members if m[2] == WHOLE), None)
    cuts = sorted((m for m in members if m[2] != WHOLE), key=lambda m: (-m[1], m[0]))
    for place, (number, _, kind) in enumerate(cuts):
        others = len(cuts) - 1
        best = cuts[1 if place == 0 else 0] if others else None
        if whole and kind == CUT_LAST:
            others += 1
            if best is None or (-whole[1], whole[0]) < (-best[1], best[0]):
                best = whole
        if best:
            yield number, others, best[1], best[0]
    if whole:
        longer = [m for m in cuts if m[2] == CUT_LAST]
        if longer:
            yield whole[0], len(longer), longer[0][1], longer[0][0]


def neighbours(words: DataFrame) -> DataFrame:
    """Rows (id, n_near, best_n, best_id) of the words (id, word, n) with near words."""

    def prepare():
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            rest = None
            for batch in batches:
                table = pa.Table.from_batches([batch])
                if rest is not None:
                    table = pa.concat_tables([rest, table]).combine_chunks()
                yield from scanned(table, last=False)
                # The last group may go on in the next batch.
                rest = table.slice(group_starts(table)[-1]).combine_chunks() if table.num_rows else None
            if rest is not None and rest.num_rows:
                yield from scanned(rest, last=True)

        return work

    names = ("id", "near", "best_n", "best_id")

    def group_starts(table: pa.Table) -> np.ndarray:
        prefixes = table.column(0).combine_chunks()
        new = pc.not_equal(prefixes.slice(1), prefixes.slice(0, len(prefixes) - 1)).to_numpy(zero_copy_only=False)
        return np.concatenate(([0], np.flatnonzero(new) + 1))

    def scanned(table: pa.Table, last: bool) -> Iterator[dict]:
        if not table.num_rows:
            return
        starts = group_starts(table)
        ends = np.append(starts[1:], table.num_rows)
        if not last:
            starts, ends = starts[:-1], ends[:-1]
        several = ends - starts > 1
        ids, ns, kinds = (table.column(i).to_numpy() for i in (1, 2, 3))
        found = []
        for a, b in zip(starts[several].tolist(), ends[several].tolist(), strict=True):
            found.extend(group_neighbours(list(zip(ids[a:b].tolist(), ns[a:b].tolist(), kinds[a:b].tolist(), strict=True))))
        if found:
            yield dict(zip(names, map(list, zip(*found, strict=True)), strict=True))

    grouped = rotation_table(words).repartition("prefix").sortWithinPartitions("prefix")
    found = rows_of(grouped, prepare, "id long, near long, best_n long, best_id long")
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("below"))).alias("best")
    summed = found.groupBy("id").agg(F.sum("near").alias("n_near"), best)
    return summed.select("id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.below")).alias("best_id"))


def roots(forms: DataFrame) -> DataFrame:
    """Rows (id, root) from pointers (id, form): every pointer followed to its end. Each
    round doubles the steps taken and is written."""
    reached = materialize(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("id").alias("root"), F.col("root").alias("further"))
        stepped = reached.join(on, "root", "left")
        stepped = materialize(
            stepped.select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        reached = stepped.select("id", "root")
        if stepped.filter("moved").isEmpty():
            return reached


def spelling_variants(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    ratio: int = FORM_RATIO,
) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) of all words of the documents."""
    counts = word_counts(docs, key=key, text=text, least_chars=least_chars)
    words = numbered(counts.filter(F.col("n") >= least_count))
    near = materialize(neighbours(words), "near")
    forms = near.join(words.select("id", "n"), "id").filter(F.col("best_n") >= ratio * F.col("n"))
    forms = materialize(forms.select("id", F.col("best_id").alias("form"), F.col("best_n").alias("form_n")), "forms")
    form_word = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    root_word = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    named = forms.join(form_word, "form").join(roots(forms).join(root_word, "root"), "id")
    whole = words.join(near.select("id", "n_near"), "id", "left")
    whole = whole.join(named.select("id", "form_word", "root_word", "form_n"), "id", "left")
    return whole.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
