"""Language identification by rank-order profiles.

The n-grams of one to three letters of a language's training texts, words padded with
blanks, are ranked by frequency; its most frequent ones are its profile. A text is ranked
alike and compared to every profile by the out-of-place distance: for each of its n-grams
the difference of the two ranks, or the profile's size where the profile lacks it. The
nearest language wins. Profiles count every training row; they are learnt in Spark and
only their ``profile_size`` n-grams per language reach the driver.

Defined cases: a null text or one without letters is ``und`` with score 0; a text whose
n-grams occur in no profile, or that is equally near to several, gets the language with
most training texts among the nearest (then the first by name); without training rows
every text is ``und``; whole texts of any length count; n-grams of equal frequency rank by
code point; repeated rows count and are predicted as often as they occur; other input
columns pass through, those named like a result are replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.arrow import add_columns, column, rows_of, texts

UNKNOWN = "und"
PROFILE_SIZE = 400
# N-grams a worker counts before it passes them on.
GRAMS_HELD = 2_000_000
BLANK = np.uint64(ord(" "))

_words = re.compile(r"[^\W\d_]+").findall


def grams_of(text: str) -> np.ndarray | None:
    """All n-grams of a text as 64-bit codes, 21 bits for each letter, or None if it has no
    letters. Its words stand in one line with a blank between them, which pads both; no
    n-gram of three has that blank in the middle."""
    line = f" {' '.join(_words(text.lower()))} "
    if not any(map(str.isalpha, line)):
        return None
    points = np.frombuffer(line.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    letter = points[1:-1] != BLANK
    pairs = points[:-1] | points[1:] << np.uint64(21)
    triples = pairs[:-1] | points[2:] << np.uint64(42)
    return np.concatenate([points[1:-1][letter], pairs, triples[letter]])


class Tally:
    """Counts of the n-grams of one language. What is added waits until there is enough to
    sort at once, as sorting many is cheaper than many sorts."""

    def __init__(self):
        self.codes, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.waiting: list[np.ndarray] = []
        self.texts = self.size = 0

    def add(self, found: np.ndarray) -> None:
        self.waiting.append(found)
        self.texts += 1
        self.size += len(found)
        if self.size > GRAMS_HELD:
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        new = np.sort(np.concatenate(self.waiting))
        first = np.flatnonzero(np.concatenate([[True], new[1:] != new[:-1]])) if len(new) else np.zeros(0, dtype=int)
        codes = np.concatenate([self.codes, new[first]])
        counts = np.concatenate([self.counts, np.diff(np.append(first, len(new)))])
        self.codes, place = np.unique(codes, return_inverse=True)
        self.counts = np.bincount(place, weights=counts, minlength=len(self.codes)).astype(np.int64)
        self.waiting, self.size = [], 0


def gram_counts(docs: DataFrame, *, lang: str, text: str) -> DataFrame:
    """Rows (lang, gram, n) over all texts; tasks add up their own first. The gram 0 counts
    the texts themselves."""

    def prepare():
        def rows(tallies: dict[str, Tally]) -> Iterator[dict]:
            for language, tally in tallies.items():
                tally.settle()
                size = len(tally.codes) + 1
                yield {
                    "lang": [language] * size,
                    "gram": pa.array(np.append(tally.codes, np.uint64(0)).view(np.int64)),
                    "n": pa.array(np.append(tally.counts, tally.texts)),
                }

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            tallies: dict[str, Tally] = {}
            for batch in batches:
                for language, t in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                    if (found := grams_of(t)) is not None:
                        tallies.setdefault(language, Tally()).add(found)
                # Many languages or a large alphabet: pass on what there is and start anew.
                if sum(len(t.codes) + t.size for t in tallies.values()) > 4 * GRAMS_HELD:
                    yield from rows(tallies)
                    tallies = {}
            yield from rows(tallies)

        return work

    counted = rows_of(docs.select(column(lang), column(text)), prepare, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Profiles:
    """Ranks by n-gram (rows, in the order of ``codes``) and language (columns)."""

    languages: tuple[str, ...]
    codes: np.ndarray
    ranks: np.ndarray
    size: int


def learn_profiles(
    docs: DataFrame, *, lang: str = "lang", text: str = "text", profile_size: int = PROFILE_SIZE
) -> Profiles:
    """Profiles of the languages of ``docs``; rows without a language teach nothing."""
    counts = gram_counts(docs.filter(column(lang).isNotNull()), lang=lang, text=text)
    # One row more than the profile, as the count of texts is one of the first by rule.
    order = Window.partitionBy("lang").orderBy((F.col("gram") == 0).desc(), F.desc("n"), F.asc("gram"))
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= profile_size + 1).collect()
    sizes = {r["lang"]: r["n"] for r in top if r["gram"] == 0}
    languages = tuple(sorted(sizes, key=lambda name: (-sizes[name], name)))
    grams = [(r["gram"], languages.index(r["lang"]), r["rank"] - 2) for r in top if r["gram"]]
    codes = np.array(sorted({g for g, _, _ in grams}), dtype=np.uint64)
    ranks = np.full((len(codes) + 1, len(languages)), profile_size * 2, dtype=np.int64)
    for gram, place, rank in grams:
        ranks[np.searchsorted(codes, np.uint64(gram)), place] = rank
    return Profiles(languages, codes, ranks, profile_size)


def nearest(found: np.ndarray, profiles: Profiles) -> tuple[str, float]:
    """The language of a text with these n-grams, and how sure that is: the share of the
    second nearest in the sum of the two distances, scaled to 0..1."""
    codes, counts = np.unique(found, return_counts=True)
    # Codes are sorted, so a stable sort ranks n-grams of equal frequency by code.
    codes = codes[np.argsort(-counts, kind="stable")[: profiles.size]]
    place = np.searchsorted(profiles.codes, codes)
    known = place < len(profiles.codes)
    known[known] = profiles.codes[place[known]] == codes[known]
    place[~known] = len(profiles.codes)
    ranks = profiles.ranks[place]
    own = np.arange(len(codes))[:, None]
    apart = np.where(ranks >= profiles.size, profiles.size, np.abs(ranks - own)).sum(axis=0)
    best = int(np.argmin(apart))
    if len(apart) == 1:
        return profiles.languages[0], float(1 - apart[0] / (profiles.size * len(codes)))
    second = int(np.partition(apart, 1)[1])
    return profiles.languages[best], float((second - apart[best]) / second) if second else 0.0


def with_language(
    docs: DataFrame, profiles: Profiles, *, text: str = "text", in_profile: str | None = None
) -> DataFrame:
    """``docs`` with lang_pred and score (0: two languages are equally near, towards 1: one
    is far nearer than any other); if asked for, a column named ``in_profile`` says whether
    any n-gram of the text lies in a profile."""

    def prepare():
        def one(t: str) -> tuple[str, float, bool]:
            found = grams_of(t) if profiles.languages else None
            if found is None:
                return UNKNOWN, 0.0, False
            language, score = nearest(found, profiles)
            # A text that no profile knows is equally far from all.
            return language, score, score > 0 or bool(np.isin(found, profiles.codes).any())

        def work(values: pa.Array) -> list:
            predicted = [one(t) for t in texts(values)]
            return [[p[i] for p in predicted] for i in range(3 if in_profile else 2)]

        return work

    ddl = "lang_pred string, score double" + (f", {in_profile} boolean" if in_profile else "")
    return add_columns(docs, [text], prepare, ddl)


def fold_of(key: str, folds: int) -> Column:
    """The fold a row falls into by its key as text."""
    return F.crc32(column(key).cast("string")) % folds
