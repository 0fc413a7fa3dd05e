"""Quality rules: a learned decision list over statistics of a text.

Sequential covering in the manner of incremental reduced error pruning: a rule is a
conjunction of thresholds that marks texts as poor. It is grown greedily by information
gain on two thirds of the labelled rows, pruned from its end on the other third, and kept
if it is precise there; the rows it covers are set aside and the next rule is sought. The
ordered rules become one Spark conditional expression, which judges all rows.

The rules are fitted on a bounded sample of the labelled rows (``max_rows``, chosen by a
hash of the key); the statistics and the verdicts cover every row.

Defined cases: a null or empty text, or one without words, has statistics of 0, fails the
base rule and is not kept; texts of any length are read whole; without labels, or with
labels of one kind only, the list is empty and the base rule decides alone; repeated rows
each get their row; a label of null, or a labelled key without a text, teaches nothing;
other input columns pass through, those named like a result are replaced by it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrow import add_columns, column, texts

# Fixed values of the base rule and of its counts.
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

# Rows a list is fitted on at most.
MAX_ROWS = 20_000
TERMINAL = ".!?…\"')]»”"

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MORE_COUNTS = (
    "n_lines long, n_distinct_words long, n_letters long, n_upper long, n_digits long, n_marks long,"
    " n_unfinished_lines long, n_top_word long, max_word long"
)

_find_words = re.compile(WORD).findall
_digits = re.compile(r"[0-9]")
_not_letters = re.compile(r"[\W\d_]+")
_not_marks = re.compile(r"[\w\s]+")
_not_upper = re.compile(r"[^A-ZÀ-Þ]+")


def repeated_words(words: Sequence[str], window: int = 3) -> int:
    """Words that lie in a window of words found at least twice, each counted once."""
    if len(words) <= window:
        return 0
    ids: dict[str, int] = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    key = code[: len(code) - window + 1]
    for shift in range(1, window):
        # Renumbered after every step, so that the keys cannot overflow.
        key = np.unique(key, return_inverse=True)[1] * len(ids) + code[shift : len(code) - window + 1 + shift]
    _, place, times = np.unique(key, return_inverse=True, return_counts=True)
    again = times[place] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(window):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def statistics(text: str) -> tuple[int, ...]:
    """The counts named by COUNTS and MORE_COUNTS."""
    words = _find_words(text)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    times = Counter(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(times),
        len(_not_letters.sub("", text)),
        len(_not_upper.sub("", text)),
        len(_digits.findall(text)),
        len(_not_marks.sub("", text)),
        sum(line.rstrip()[-1:] not in TERMINAL for line in lines),
        max(times.values(), default=0),
        max(map(len, words), default=0),
    )


def with_statistics(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with the counts of every whole text and base_failed."""

    def prepare():
        def work(values: pa.Array) -> list:
            return list(zip(*map(statistics, texts(values)), strict=True)) or [[]] * 14

        return work

    counted = add_columns(docs, [text], prepare, f"{COUNTS}, {MORE_COUNTS}")
    words = F.col("n_words")
    failed = (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * words)
    return counted.withColumn("base_failed", failed)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


def measures() -> dict[str, Column]:
    """What the rules look at: shares, which do not grow with the length of a text."""
    return {
        "symbols_per_word": _share("n_symbols", "n_words"),
        "duplicate_lines": _share("n_dup_lines", "n_lines"),
        "repeated_words": _share("n_repeat_words", "n_words"),
        "distinct_words": _share("n_distinct_words", "n_words"),
        "word_length": _share("word_chars", "n_words"),
        "letters": _share("n_letters", "word_chars"),
        "upper_case": _share("n_upper", "n_letters"),
        "digits": _share("n_digits", "word_chars"),
        "marks": _share("n_marks", "word_chars"),
        "unfinished_lines": _share("n_unfinished_lines", "n_lines"),
        "words_per_line": _share("n_words", "n_lines"),
        "top_word": _share("n_top_word", "n_words"),
        "longest_word": F.col("max_word").cast("double"),
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:.6g}"

    def expression(self) -> Column:
        value = measures()[self.measure]
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Rule:
    """Texts that meet all conditions are poor."""

    conditions: tuple[Condition, ...]

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


def _meets(x: np.ndarray, names: Sequence[str], conditions: Sequence[Condition]) -> np.ndarray:
    hit = np.ones(len(x), dtype=bool)
    for c in conditions:
        values = x[:, names.index(c.measure)]
        hit &= values > c.threshold if c.above else values <= c.threshold
    return hit


def _grow(x: np.ndarray, poor: np.ndarray, names: Sequence[str], cuts: int, longest: int) -> list[Condition]:
    """Add the condition of the highest gain until only poor rows are left."""
    conditions: list[Condition] = []
    left = np.ones(len(x), dtype=bool)
    while len(conditions) < longest:
        p, n = poor[left].sum(), (~poor[left]).sum()
        if not p or not n:
            break
        before = np.log2(p / (p + n))
        best, gain = None, 1e-9
        for i, name in enumerate(names):
            values = x[left, i]
            order = np.argsort(values, kind="stable")
            ranked, hits = values[order], np.cumsum(poor[left][order])
            # Thresholds lie half-way between neighbours; ``cuts`` of them by rank.
            edges = np.flatnonzero(ranked[1:] > ranked[:-1])
            if not len(edges):
                continue
            edges = edges[np.unique(np.linspace(0, len(edges) - 1, cuts).astype(int))]
            for above in (False, True):
                got = p - hits[edges] if above else hits[edges]
                size = len(ranked) - edges - 1 if above else edges + 1
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(got > 0, got * (np.log2(got / size) - before), 0)
                k = int(np.argmax(gains))
                if gains[k] > gain:
                    low, high = ranked[edges[k]], ranked[edges[k] + 1]
                    best, gain = Condition(name, above, float((low + high) / 2)), gains[k]
        if best is None:
            break
        conditions.append(best)
        left &= _meets(x, names, [best])
    return conditions


def _prune(x, poor, names, conditions: list[Condition]) -> tuple[list[Condition], float]:
    """The shortest beginning of the rule that is most precise on rows it has not seen."""
    best, precise = conditions, -1.0
    for size in range(1, len(conditions) + 1):
        hit = _meets(x, names, conditions[:size])
        right = poor[hit].sum()
        precision = (right + 0.5) / (hit.sum() + 1)
        if precision > precise + 1e-9:
            best, precise = conditions[:size], float(precision)
    return best, precise


def learn_rules(
    x: np.ndarray,
    poor: np.ndarray,
    names: Sequence[str],
    *,
    seed: int = 7,
    min_precision: float = 0.9,
    min_covered: int = 3,
    max_rules: int = 24,
    cuts: int = 64,
    longest: int = 5,
) -> list[Rule]:
    """A decision list from measured rows: ordered rules, the most rewarding first."""
    draw = np.random.default_rng(seed).random(len(x))
    rules: list[Rule] = []
    open_rows = np.ones(len(x), dtype=bool)
    tries = 0
    while poor[open_rows].any() and len(rules) < max_rules and tries < 2 * max_rules:
        tries += 1
        # Another split for every rule, so that each third helps to grow some of them.
        growing = open_rows & ((draw * 3 + tries) % 3 >= 1)
        testing = open_rows & ~growing
        conditions = _grow(x[growing], poor[growing], names, cuts, longest)
        if not conditions:
            continue
        conditions, precision = _prune(x[testing], poor[testing], names, conditions)
        hit = _meets(x, names, conditions) & open_rows
        covered = int(poor[hit].sum())
        if precision >= min_precision and covered >= min_covered and covered >= min_precision * hit.sum():
            rules.append(Rule(tuple(conditions)))
            open_rows &= ~hit
        elif tries >= max_rules // 2 and not rules:
            break
    return rules


def fit(
    measured: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", max_rows: int = MAX_ROWS
) -> list[Rule]:
    """Learn from the rows of ``measured`` (see :func:`with_statistics`) that have a label,
    0 for poor. At most about ``max_rows`` of them, by a hash of the key, go to the driver."""
    named = measures()
    known = labels.select(column(key).alias("_key"), column(label).alias("_label")).filter("_label is not null")
    rows = measured.filter(~F.col("base_failed")).select(
        column(key).alias("_key"), *[v.alias(n) for n, v in named.items()]
    )
    joined = rows.join(known, "_key")
    total = known.count()
    if total > max_rows:
        joined = joined.filter(F.pmod(F.xxhash64("_key"), F.lit(1_000_000)) < int(1_000_000 * max_rows / total))
    # Sorted, as the split into growing and testing rows goes by place.
    found = sorted(map(tuple, joined.drop("_key").collect())) if total else []
    if not found:
        return []
    table = np.array(found, dtype=float)
    return learn_rules(table[:, :-1], table[:, -1] == 0, list(named))


def verdict(rules: Sequence[Rule]) -> Column:
    """The ordered conditional expression: false where the base rule or a learned rule
    finds a text poor, else true."""
    kept = F.when(F.col("base_failed"), F.lit(False))
    for rule in rules:
        meets = F.lit(True)
        for condition in rule.conditions:
            meets = meets & condition.expression()
        kept = kept.when(meets, F.lit(False))
    return kept.otherwise(F.lit(True))


def with_verdict(measured: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``measured`` with kept."""
    return measured.withColumn("kept", verdict(rules))
