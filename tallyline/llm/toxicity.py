"""Toxicity: misspelled lexicon terms found by automata, judged by their context.

The lexicon is learnt: words, and stems of words, that occur in significantly more toxic
training texts than chance allows. The terms form a trie. Each new word is turned into a
Levenshtein automaton (its states kept as bits), which walks down the trie and reports the
terms within its edits; one swap of neighbours counts as one edit. Hits are scored by the
words around them: one inside quotation marks or after a reporting verb is a quotation,
any other is abuse. Counts of hits by kind are weighed by a logistic regression.

Both models are fitted on a bounded sample of the labelled training rows (``max_labelled``,
by a hash of the key); hits are found in every whole text.

Defined cases: a null or empty text, or one without hits, has the score of no hits; texts
of any length are read whole; without labelled rows, or without toxic ones, the lexicon is
empty and every score is the rate of toxic rows (0 without rows); labels other than 0 and 1
teach nothing; a key labelled twice teaches twice; repeated rows each get their row; other
input columns pass through, those named like a result are replaced by it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrow import add_columns, column, rows_of, texts
from tallyline.session import materialize

# Bounds of what is learnt, parameters of :func:`with_toxicity`: labelled rows, terms, and for
# each term the candidates, the covered and the known words looked at. Beyond them it is the
# terms of least evidence and the rarest covered and known words that are not learnt.
MAX_LABELLED, MAX_TERMS, CANDIDATES_PER_TERM = 50_000, 2_000, 10
# Toxic texts a term needs.
LEAST_TOXIC = 4
# Lengths of stems, and from which length on a word may hold one or two misprints.
STEMS = (4, 5, 6, 7)
ONE_EDIT, TWO_EDITS = 4, 8
REMEMBERED_WORDS = 600_000
TERMS_HELD = 400_000
# Words before a hit among which a reporting verb makes it a quotation.
WINDOW = 6
# Hits of a kind that are told apart in a text; more of them say no more than these.
MOST_COUNTED = 4
# Word and term pairs compared at a time, which bounds the memory of the comparison.
PAIRS_AT_A_TIME = 8_000_000

# Verbs and nouns that report what somebody else said.
REPORTING = frozenset(
    "said says say wrote writes quote quoted quotes quoting called calls word term phrase"
    " dit disait écrit cite appelé mot terme sagte sagt schrieb zitiert nannte wort begriff"
    " dijo dice escribió cita llamó palabra término".split()
)
QUOTES = '"“”„«»'

# Letters and digits, with marks inside that stand for letters in disguise.
_tokens = re.compile(r"[^\W_](?:[\w@$*]*[^\W_])?")

FEATURES = ("plain", "quoted", "plain_misspelled", "quoted_misspelled")


def words_of(text: str) -> list[str]:
    return _tokens.findall(text.lower())


# ---- automata and trie -------------------------------------------------------------


class Trie:
    """Lexicon terms by letters; ``term`` ends a branch."""

    __slots__ = ("children", "term")

    def __init__(self):
        self.children: dict[str, Trie] = {}
        self.term: str | None = None

    def add(self, term: str) -> None:
        node = self
        for letter in term:
            node = node.children.setdefault(letter, Trie())
        node.term = term


class Automaton:
    """Accepts what is within ``edits`` of a word. State: for each number of edits, the
    places of the word reached with them as bits; and the places of begun swaps."""

    def __init__(self, word: str, edits: int):
        self.edits, self.accepting = edits, 1 << len(word)
        self.places: dict[str, int] = {}
        for i, letter in enumerate(word):
            self.places[letter] = self.places.get(letter, 0) | 1 << i
        self.start = (tuple((2 << e) - 1 for e in range(edits + 1)), (0,) * (edits + 1))

    def step(self, state: tuple, letter: str) -> tuple:
        reached, swaps = state
        here = self.places.get(letter, 0)
        new = [(reached[0] & here) << 1]
        begun = [0]
        for e in range(1, self.edits + 1):
            fewer = reached[e - 1]
            now = (reached[e] & here) << 1  # the letter fits
            now |= fewer | fewer << 1  # one letter too many, or another one
            now |= new[e - 1] << 1  # one letter left out
            now |= (swaps[e] & here) << 2  # the second letter of a swap
            new.append(now & (2 * self.accepting - 1))
            begun.append(fewer & here >> 1)
        return tuple(new), tuple(begun)

    def nearest(self, trie: Trie) -> tuple[int, str] | None:
        """The fewest edits and the first such term in the trie, if any is near enough."""
        best = None
        open_nodes = [(trie, self.start)]
        while open_nodes:
            node, state = open_nodes.pop()
            if node.term is not None:
                edits = next((e for e, r in enumerate(state[0]) if r & self.accepting), None)
                if edits is not None and (best is None or (edits, node.term) < best):
                    best = (edits, node.term)
            for letter, child in node.children.items():
                after = self.step(state, letter)
                if any(after[0]) or any(after[1]):
                    open_nodes.append((child, after))
        return best


def allowed_edits(word: str) -> int:
    return 0 if len(word) < ONE_EDIT else 1 if len(word) < TWO_EDITS else 2


def _letter_set(word: str) -> int:
    bits = 0
    for letter in word:
        bits |= 1 << ord(letter) % 61
    return bits


def shortened(word: str, letters: int) -> set[str]:
    """``word`` and what is left of it without up to so many letters."""
    found = {word}
    for _ in range(letters):
        found |= {w[:i] + w[i + 1 :] for w in found for i in range(len(w))}
    return found


@dataclass(frozen=True)
class Lexicon:
    """``words`` match whole, misspelled too, but for the ``known`` words near them;
    ``stems`` match the beginnings of words. Words that a stem covers are among ``words``
    for the sake of their misspellings."""

    words: tuple[str, ...] = ()
    stems: tuple[str, ...] = ()
    known: tuple[str, ...] = ()


class Matcher:
    """Which words are hits: 1 as they stand, 2 misspelled."""

    def __init__(self, lexicon: Lexicon):
        self.words, self.stems = frozenset(lexicon.words), frozenset(lexicon.stems)
        self.known = frozenset(lexicon.known)
        self.stem_lengths = sorted({len(s) for s in self.stems})
        # By allowed edits, so that a nearer term with fewer of them hides no other.
        self.tries: dict[int, Trie] = {}
        near = [w for w in lexicon.words if allowed_edits(w)]
        for word in near:
            self.tries.setdefault(allowed_edits(word), Trie()).add(word)
        self.sizes = np.array([len(w) for w in near], dtype=np.int64)
        self.sets = np.array([_letter_set(w) for w in near], dtype=np.uint64)
        self.shortened = set().union(*(shortened(w, allowed_edits(w)) for w in near))
        self.hits: dict[str, int] = {}
        self.seen: set[str] = set()

    def learn(self, words: Iterable[str]) -> None:
        """Judge words not seen before, many at a time."""
        if len(self.seen) > REMEMBERED_WORDS:
            self.seen.clear()
            self.hits.clear()
        unknown = [w for w in words if w not in self.seen]
        self.seen.update(unknown)
        doubtful = []
        for w in unknown:
            if w in self.words or any(w[:n] in self.stems for n in self.stem_lengths):
                self.hits[w] = 1
            elif len(w) >= ONE_EDIT - 1 and w not in self.known:
                doubtful.append(w)
        if not doubtful or not len(self.sizes):
            return
        # An edit changes the set of letters by one letter each way and the length by one,
        # and words an edit apart are alike without a letter: few words need an automaton.
        sizes = np.array([len(w) for w in doubtful], dtype=np.int64)
        sets = np.array([_letter_set(w) for w in doubtful], dtype=np.uint64)
        step = max(1, PAIRS_AT_A_TIME // len(self.sizes))
        for at in range(0, len(doubtful), step):
            size, letters = sizes[at : at + step, None], sets[at : at + step, None]
            edits = np.where(self.sizes >= TWO_EDITS, 2, 1)[None, :]
            near = np.abs(size - self.sizes) <= edits
            near &= np.bitwise_count(letters & ~self.sets) <= edits
            near &= np.bitwise_count(self.sets & ~letters) <= edits
            for i in np.flatnonzero(near.any(axis=1)):
                word = doubtful[at + i]
                if self.shortened.isdisjoint(shortened(word, 2 if len(word) >= TWO_EDITS - 2 else 1)):
                    continue
                if any(Automaton(word, edits).nearest(trie) for edits, trie in self.tries.items()):
                    self.hits[word] = 2

    def features(self, text: str) -> tuple[int, int, int, int]:
        """Hits by FEATURES, each counted up to MOST_COUNTED."""
        found = [0, 0, 0, 0]
        spans = [(m.start(), m.group()) for m in _tokens.finditer(text)]
        line_start, quotes = 0, 0
        for i, (start, word) in enumerate(spans):
            between = text[line_start:start]
            if "\n" in between:
                quotes, between = 0, between[between.rindex("\n") :]
            quotes += sum(map(between.count, QUOTES))
            line_start = start + len(word)
            kind = self.hits.get(word)
            if kind:
                reported = any(w in REPORTING for _, w in spans[max(0, i - WINDOW) : i])
                found[2 * (kind - 1) + (quotes % 2 == 1 or reported)] += 1
        return tuple(min(n, MOST_COUNTED) for n in found)


# ---- learning ----------------------------------------------------------------------


def term_counts(labelled: DataFrame, *, text: str, label: str) -> DataFrame:
    """Rows (term, toxic, clean): in how many texts a word, or a stem written with a
    trailing ``*``, occurs. The term '' counts the texts."""

    def prepare():
        def rows(toxic: Counter, clean: Counter) -> dict:
            terms = [*{**toxic, **clean}]
            return {"term": terms, "toxic": [toxic[t] for t in terms], "clean": [clean[t] for t in terms]}

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            toxic: Counter = Counter()
            clean: Counter = Counter()
            for batch in batches:
                for t, is_toxic in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                    words = set(words_of(t))
                    terms = {w[:n] + "*" for n in STEMS for w in words if len(w) > n}
                    (toxic if is_toxic else clean).update(words | terms | {""})
                    if len(toxic) + len(clean) > TERMS_HELD:
                        yield rows(toxic, clean)
                        toxic, clean = Counter(), Counter()
            if toxic or clean:
                yield rows(toxic, clean)

        return work

    counted = rows_of(labelled.select(column(text), column(label)), prepare, "term string, toxic long, clean long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def contexts(toxic_texts: DataFrame, terms: Iterable[str], *, text: str) -> DataFrame:
    """Rows (term, n): between how many different pairs of words a term stands. Copies of a
    text repeat their pairs, so they add nothing."""
    wanted = frozenset(terms)

    def prepare():
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                found = set()
                for t in texts(batch.column(0)):
                    words = ["", *words_of(t), ""]
                    for before, w, after in zip(words, words[1:], words[2:], strict=False):
                        for term in (w, *(w[:n] + "*" for n in STEMS if len(w) > n)):
                            if term in wanted:
                                found.add((term, f"{before} {after}"))
                if found:
                    yield {"term": [f[0] for f in found], "context": [f[1] for f in found]}

        return work

    found = rows_of(toxic_texts.select(column(text)), prepare, "term string, context string")
    return found.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def evidence(toxic: int, clean: int, rate: float) -> float:
    """How far the share of toxic texts lies above the rate of all: the number of texts
    times the divergence of the two, in nats; 0 where it lies below."""
    n = toxic + clean
    share = toxic / n
    if share <= rate:
        return 0.0
    rest = clean * math.log((1 - share) / (1 - rate)) if clean else 0.0
    return toxic * math.log(share / rate) + rest


def _evidence(toxic: Column, clean: Column, rate: float) -> Column:
    """:func:`evidence` of columns."""
    share = toxic / (toxic + clean)
    rest = F.when(clean > 0, clean * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    return F.when(share > rate, toxic * F.log(share / rate) + rest).otherwise(0.0)


def learn_lexicon(
    labelled: DataFrame,
    *,
    text: str = "text",
    label: str = "toxic",
    max_terms: int = MAX_TERMS,
    candidates_per_term: int = CANDIDATES_PER_TERM,
    min_precision: float = 0.5,
) -> Lexicon:
    """Terms that chance would not put into so many toxic texts even once among all terms
    tried, counting only different contexts. Of a stem and the words it covers, the one with
    more evidence is the term, the word if they are equal; a covered word stays beside its
    stem, to be found misspelled, if it has the evidence of a term itself: what is near a
    stem that chance has put together is near many words. Words near a term that clean texts
    use as often as toxic ones are known words, no misspellings."""
    counts = materialize(term_counts(labelled, text=text, label=label), "terms")
    whole = counts.filter("term = ''").first()
    if whole is None or not whole["toxic"] or not whole["clean"]:
        return Lexicon()
    rate = whole["toxic"] / (whole["toxic"] + whole["clean"])
    # Terms too rare to reach the bound whatever their texts are no trials.
    tried = counts.filter(f"toxic + clean >= {LEAST_TOXIC}").count()
    bound = math.log(max(tried, 1)) + 1
    strong = (
        counts.filter(f"term != '' and toxic >= {LEAST_TOXIC}")
        .withColumn("evidence", _evidence(F.col("toxic"), F.col("clean"), rate))
        .filter((F.col("evidence") > bound) & (F.col("toxic") >= min_precision * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.desc("evidence"), "term")
        .limit(max_terms * candidates_per_term)
        .collect()
    )
    if not strong:
        return Lexicon()
    toxic_texts = labelled.filter(column(label) == 1)
    differing = {r["term"]: r["n"] for r in contexts(toxic_texts, [r["term"] for r in strong], text=text).collect()}
    sure = []
    for row in strong:
        seen = min(row["toxic"], differing.get(row["term"], 0))
        weight = evidence(seen, row["clean"], rate) if seen >= LEAST_TOXIC else 0.0
        if weight > bound:
            sure.append((-round(weight, 6), row["term"].endswith("*"), -len(row["term"]), row["term"]))
    words: list[str] = []
    stems: list[str] = []
    covered_words: list[str] = []
    for _, is_stem, _, term in sorted(sure)[:max_terms]:
        bare = term.rstrip("*")
        covered = any(bare.startswith(s) for s in stems)
        # A stem that only repeats words already chosen says nothing new.
        if is_stem and not covered and not any(w.startswith(bare) for w in words + stems):
            stems.append(bare)
        elif not is_stem:
            (covered_words if covered else words).append(term)
    lexicon = Lexicon(tuple(dict.fromkeys([*words, *covered_words])), tuple(stems))
    return replace(lexicon, known=_known_words(counts, lexicon, max_terms * candidates_per_term))


def _known_words(counts: DataFrame, lexicon: Lexicon, most: int) -> tuple[str, ...]:
    """The most frequent words of clean texts that would pass for misspelled terms."""

    def prepare():
        matcher = Matcher(lexicon)

        def work(values: pa.Array) -> list:
            words = values.to_pylist()
            matcher.learn(words)
            return [[matcher.hits.get(w) == 2 for w in words]]

        return work

    clean = counts.filter("clean > 0 and clean >= toxic and term != '' and not endswith(term, '*')")
    near = add_columns(clean, ["term"], prepare, "near boolean").filter("near")
    return tuple(r["term"] for r in near.orderBy(F.desc("clean"), "term").limit(most).collect())


@dataclass(frozen=True)
class Weights:
    """Log-odds of a toxic text: bias and the weight of a hit by feature."""

    bias: float
    by_feature: Mapping[str, float] = field(default_factory=dict)

    def score(self) -> Column:
        odds = F.lit(self.bias)
        for name, weight in self.by_feature.items():
            odds = odds + F.col(name) * F.lit(weight)
        return 1 / (1 + F.exp(-odds))


def learn_weights(cells: list[tuple[tuple[int, ...], int, int]], ridge: float = 0.5, rounds: int = 50) -> Weights:
    """Logistic regression by Newton's method from cells (features, toxic rows, rows)."""
    total = sum(n for _, _, n in cells)
    toxic = sum(k for _, k, _ in cells)
    if not total:
        return Weights(-50.0)
    if toxic in (0, total) or not any(any(f) for f, _, _ in cells):
        rate = min(max(toxic / total, 1e-9), 1 - 1e-9)
        return Weights(float(np.log(rate / (1 - rate))))
    # A misspelled hit weighs like one spelled right, but for a deviation that must be seen.
    x = np.array([[1, f[0] + f[2], f[1] + f[3], f[2], f[3]] for f, _, _ in cells], dtype=float)
    k = np.array([k for _, k, _ in cells], dtype=float)
    n = np.array([n for _, _, n in cells], dtype=float)
    # Prior: a plain hit means abuse, a quoted one does not; the bias is free.
    prior = np.array([0.0, 1.0, 0.0, 0.0, 0.0])
    strength = np.array([1e-6] + [ridge] * 4)
    w = prior.copy()
    w[0] = np.log((toxic + 0.5) / (total - toxic + 0.5))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (k - n * p) - strength * (w - prior)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(strength)
        move = np.clip(np.linalg.solve(curve, slope), -2, 2)
        w += move
        if np.abs(move).max() < 1e-10:
            break
    by_feature = (w[1], w[2], w[1] + w[3], w[2] + w[4])
    return Weights(float(w[0]), dict(zip(FEATURES, map(float, by_feature), strict=True)))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, max_labelled: int
) -> DataFrame:
    """Training texts with labels 0 or 1, at most about ``max_labelled`` of them."""
    known = labels.select(column(key).alias("_key"), column(label).alias("_label")).filter("_label in (0, 1)")
    total = known.count()
    if total > max_labelled:
        known = known.filter(F.pmod(F.xxhash64("_key"), F.lit(1_000_000)) < int(1_000_000 * max_labelled / total))
    # At most about max_labelled narrow rows: small enough for every executor.
    return docs.select(column(key).alias("_key"), column(text).alias("_text")).join(F.broadcast(known), "_key")


def with_hits(docs: DataFrame, lexicon: Lexicon, *, text: str = "text") -> DataFrame:
    """``docs`` with the numbers of hits by FEATURES."""

    def prepare():
        matcher = Matcher(lexicon)

        def work(values: pa.Array) -> list:
            rows = []
            for t in texts(values):
                lower = t.lower()
                distinct = set(_tokens.findall(lower))
                matcher.learn(distinct)
                rows.append((0, 0, 0, 0) if matcher.hits.keys().isdisjoint(distinct) else matcher.features(lower))
            return list(zip(*rows, strict=True)) or [[]] * len(FEATURES)

        return work

    return add_columns(docs, [text], prepare, ", ".join(f"{name} int" for name in FEATURES))


def fit_weights(hits: DataFrame, labels: DataFrame, *, key: str, label: str = "toxic") -> Weights:
    """Weigh the hits of labelled rows; the cells number at most a few hundred."""
    known = labels.select(column(key).alias("_key"), column(label).alias("_label")).filter("_label in (0, 1)")
    cells = (
        hits.select(column(key).alias("_key"), *FEATURES)
        .join(known, "_key")
        .groupBy(*FEATURES)
        .agg(F.sum("_label").alias("k"), F.count(F.lit(1)).alias("n"))
        .orderBy(*FEATURES)
        .collect()
    )
    return learn_weights([(tuple(r[f] for f in FEATURES), r["k"], r["n"]) for r in cells])


def with_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = 0.3,
    max_labelled: int = MAX_LABELLED,
    max_terms: int = MAX_TERMS,
    candidates_per_term: int = CANDIDATES_PER_TERM,
) -> DataFrame:
    """``docs`` without its text, with hits by FEATURES, score and predicted. ``labels``
    holds the training labels only."""
    training = labelled_texts(docs, labels, key=key, text=text, label=label, max_labelled=max_labelled)
    lexicon = learn_lexicon(
        training, text="_text", label="_label", max_terms=max_terms, candidates_per_term=candidates_per_term
    )
    hits = materialize(with_hits(docs, lexicon, text=text).drop(column(text)), "hits")
    weights = fit_weights(hits, labels, key=key, label=label)
    scored = hits.withColumn("score", weights.score())
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
