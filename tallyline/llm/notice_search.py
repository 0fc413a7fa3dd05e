"""License scans: short notices found though misspelt, with their spans.

Texts and notices are compared as words between single blanks. A notice that may hold k
edits is split into k + 1 pieces: k edits leave one of them whole, so an exact search for
all pieces of all notices at once finds every place where a notice can stand. Only the few
letters around such a seed are verified, by the regex library's bounded-error matching,
which counts the edits and gives the span. A notice may begin with fixed words, which are
too short for an edit to leave them recognizable.

Besides, base phrases are counted where their words stand consecutively, without edits.

Defined cases: a null or empty text has no words, no labels (the empty text) and the score
0; texts of any length are searched whole; repeated rows each get their row; of places of
one label that overlap, the one with the fewest edits is kept, then the leftmost, then the
longest; input columns other than the text pass through, those named like a result are
replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyline.llm.arrow import SLICE_ROWS, add_columns


@dataclass(frozen=True)
class Notice:
    """``fixed`` words stand as they are, ``text`` within so many ``edits`` after them."""

    label: str
    text: str
    edits: int
    fixed: str = ""

    @property
    def lead(self) -> str:
        return f" {self.fixed} " if self.fixed else " "

    def seeds(self) -> Iterator[tuple[str, int]]:
        """Pieces of the text and their places in it; one at least survives all edits."""
        size, parts = len(self.text), self.edits + 1
        cuts = [size * i // parts for i in range(parts + 1)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield self.text[a:b], a

    def pattern(self) -> regex.Pattern:
        fuzzy = f"(?:{regex.escape(self.text, literal_spaces=True)}){{e<={self.edits}}}"
        return regex.compile(f"(?b){regex.escape(self.lead, literal_spaces=True)}{fuzzy} ")


# Phrases that are counted as they stand.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Short notices of well-known licenses, as words in lower case.
NOTICES = (
    Notice("gpl", "general public license", 3, fixed="gnu"),
    Notice("lgpl", "lesser general public license", 3, fixed="gnu"),
    Notice("agpl", "affero general public license", 3, fixed="gnu"),
    Notice("gfdl", "free documentation license", 3, fixed="gnu"),
    Notice("apache", "apache license", 2),
    Notice("apache", "apache software license", 3),
    Notice("mit", "license", 1, fixed="mit"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("bsd", "license", 1, fixed="bsd"),
    Notice("bsd", "redistribution and use in source and binary forms", 5),
    Notice("mpl", "mozilla public license", 3),
    Notice("epl", "eclipse public license", 3),
    Notice("eupl", "european union public licence", 3),
    Notice("cc-by", "creative commons attribution", 3),
    Notice("cc-by", "licensed under cc by", 2),
    Notice("cc-by-nc", "cc by nc", 0),
    Notice("cc-by-nc", "attribution noncommercial", 3, fixed="creative commons"),
    Notice("cc-by-nd", "cc by nd", 0),
    Notice("cc-by-sa", "cc by sa", 0),
    Notice("cc-by-sa", "attribution sharealike", 3, fixed="creative commons"),
    Notice("cc0", "universal public domain dedication", 3),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 6),
    Notice("all-rights-reserved", "all rights reserved", 2),
)

RESULTS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "notices array<struct<label: string, start: long, end: long, edits: int>>"
)

# Every byte of a word stays (A to Z lower-cased), any other becomes a blank. Bytes from
# 0x80 on only occur inside characters beyond ASCII, all of which are word characters.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_words = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_between_blanks(raw: bytes) -> tuple[int, str]:
    """The number of words and the words, a blank before, between and after them."""
    words = raw.translate(_LETTERS).split()
    return len(words), f" {b' '.join(words).decode()} " if words else ""


def places(padded: str, phrase: str) -> Iterator[int]:
    """Where the phrase starts, as numbers of words; places may overlap."""
    wanted = f" {phrase} "
    at, word, counted = padded.find(wanted), 0, 0
    while at >= 0:
        word += padded.count(" ", counted, at)
        counted = at
        yield word
        at = padded.find(wanted, at + 1)


class Scanner:
    """Finds notices in words between blanks."""

    def __init__(self, notices: Sequence[Notice]):
        self.notices = notices
        self.patterns = [n.pattern() for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            for piece, place in notice.seeds():
                seeds.setdefault(piece, []).append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if seeds:
            self.automaton.make_automaton()

    def matches(self, padded: str) -> set[tuple[int, int, int, int]]:
        """(edits, start, end, notice) of all verified places around seeds."""
        found = set()
        if not len(self.automaton):
            return found
        for end, (size, uses) in self.automaton.iter(padded):
            for number, place in uses:
                notice = self.notices[number]
                begin = end - size + 1 - place
                a = max(0, begin - notice.edits - len(notice.lead))
                window = padded[a : begin + len(notice.text) + notice.edits + 1]
                if notice.lead in window and (match := self.patterns[number].search(window)):
                    edits = sum(match.fuzzy_counts)
                    found.add((edits, a + match.start() + 1, a + match.end() - 1, number))
        return found

    def notices_of(self, padded: str) -> list[tuple[str, int, int, int, int]]:
        """(label, start, end, edits, notice) by start; overlaps of a label are resolved."""
        kept: dict[str, list] = {}
        for edits, start, end, number in sorted(self.matches(padded), key=lambda m: (m[0], m[1], -m[2], m[3])):
            label = self.notices[number].label
            own = kept.setdefault(label, [])
            if all(end <= a or b <= start for _, a, b, _, _ in own):
                own.append((label, start, end, edits, number))
        return sorted((k for own in kept.values() for k in own), key=lambda k: (k[1], k[2], k[0]))

    def likeness(self, number: int, edits: int) -> float:
        notice = self.notices[number]
        return 1 - edits / (len(notice.lead) + len(notice.text))


@lru_cache(maxsize=4)
def scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


def spans_in_text(text: str, padded: str, found: list[tuple[str, int, int, int, int]]) -> list[tuple]:
    """(label, start, end, edits) with places in the text itself, in code points."""
    spans = [m.span() for m in _words.finditer(text)]
    out, word, counted = [], 0, 0
    for label, start, end, edits, _ in found:
        word += padded.count(" ", counted, start)
        counted = start
        last = word + padded.count(" ", start, end)
        out.append((label, spans[word - 1][0], spans[last - 1][1], edits))
    return out


def with_notices(
    docs: DataFrame,
    *,
    text: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    notices: Sequence[Notice] = NOTICES,
) -> DataFrame:
    """``docs`` with the columns of ``RESULTS``: the number of words; places, first and last
    place (in words) and labels of the phrases; all labels; the likeness of the best place
    to its notice (1 for a phrase, 0 for none); and the notices with their spans."""
    phrases, notices = tuple(phrases), tuple(notices)

    def prepare():
        scan = scanner(notices)

        def judge(raw: bytes) -> tuple:
            n_words, padded = words_between_blanks(raw)
            base: set[str] = set()
            starts: list[int] = []
            for phrase, label in phrases:
                of_phrase = list(places(padded, phrase))
                if of_phrase:
                    base.add(label)
                    starts += of_phrase
            found = scan.notices_of(padded)
            labels = sorted(base | {f[0] for f in found})
            score = 1.0 if base else max((scan.likeness(f[4], f[3]) for f in found), default=0.0)
            spans = spans_in_text(raw.decode(), padded, found) if found else []
            first, last = (min(starts), max(starts)) if starts else (None, None)
            return n_words, len(starts), first, last, ",".join(sorted(base)), ",".join(labels), score, spans

        def work(values: pa.Array) -> list:
            rows = []
            for at in range(0, len(values), SLICE_ROWS):
                rows += [judge(raw or b"") for raw in values.slice(at, SLICE_ROWS).cast(pa.binary()).to_pylist()]
            return list(zip(*rows, strict=True)) if rows else [[] for _ in range(8)]

        return work

    return add_columns(docs, [text], prepare, RESULTS)
