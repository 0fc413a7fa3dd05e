"""Language, quality and toxicity: brute-force counts, planted cases, degenerate tables."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from llm_rows import by_id
from tallyline.llm import language_id, quality_rules, toxicity

WORDS = {
    "en": "the river ran past old mills while people were walking home with bread and water".split(),
    "de": "der fluss lief an alten muehlen vorbei waehrend leute mit brot nach hause gingen und schwiegen".split(),
}


def prose(lang, n, seed):
    return " ".join(random.Random(seed).choices(WORDS[lang], k=n))


def test_language(documents):
    train = [(i, prose(lang, 60, i), lang) for i, lang in enumerate(["en", "de"] * 8)]
    profiles = language_id.learn_profiles(documents(*train, (90, "no language", None)))
    assert profiles.languages == ("de", "en")
    tests = [(1, prose("en", 20, 99)), (2, prose("de", 20, 98)), (3, None), (4, "12 !! 34"), (5, ""), (6, "東京")]
    docs = documents(*tests, (1, prose("en", 20, 99))).withColumnRenamed("source", "Lang_Pred")
    found = language_id.with_language(docs, profiles)
    assert found.count() == 7 and "Lang_Pred" not in found.columns
    got = by_id(found, "lang_pred", "score")
    assert [got[i][0] for i in range(1, 7)] == ["en", "de", "und", "und", "und", "de"]
    assert all(0 <= s <= 1 for _, s in got.values()) and got[6][1] == 0


def test_language_without_training_rows(documents):
    profiles = language_id.learn_profiles(documents("text").limit(0))
    assert by_id(language_id.with_language(documents("text"), profiles), "lang_pred") == {0: "und"}


def test_gram_counts(documents):
    counts = {(r["lang"], r["gram"]): r["n"] for r in language_id.gram_counts(documents("ab ab"), lang="lang", text="text").collect()}
    assert counts["en", 0] == 1 and counts["en", ord("a")] == 2
    assert counts["en", ord(" ") | ord("a") << 21 | ord("b") << 42] == 2


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    repeats = sum(line in lines[:i] for i, line in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, repeats, len(inside), failed


def test_statistics(documents):
    draw = random.Random(1)
    texts = ["", None, " \n\t\x0b ", "a b c", "a b", "x y z x y z\nx y z x y z\n", "a " * 70, "#<|> é"]
    texts += [" ".join(draw.choices(["a", "b", "c*", "dd\n", "\n"], k=draw.randint(1, 90))) for _ in range(60)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = by_id(quality_rules.with_statistics(documents(*texts)), *names)
    assert [found[i] for i in range(len(texts))] == [brute_statistics(t) for t in texts]


def test_rules_find_planted_thresholds():
    draw = np.random.default_rng(0)
    x = draw.random((3000, 3))
    poor = (x[:, 0] > 0.9) | ((x[:, 1] > 0.7) & (x[:, 2] <= 0.2))
    rules = quality_rules.learn_rules(x, poor, ["marks", "digits", "letters"])
    names = ["marks", "digits", "letters"]
    hit = np.any([quality_rules._meets(x, names, r.conditions) for r in rules], axis=0)
    assert (hit == poor).mean() > 0.98 and len(rules) <= 6 and "marks > 0.9" in str(rules[0])
    assert quality_rules.learn_rules(x, np.zeros(3000, dtype=bool), names) == []


def test_quality_from_labels(spark, documents):
    clean = [(i, " ".join(f"w{i}x{k}" for k in range(80)) + ".") for i in range(60)]
    junk = [(100 + i, " ".join(f"w{i}y{k}***" for k in range(80))) for i in range(40)]
    docs = documents(*clean, *junk, (500, None))
    labels = spark.createDataFrame([(i, 1) for i, _ in clean] + [(i, 0) for i, _ in junk] + [(9, None)], "doc_id long, quality int")
    counted = quality_rules.with_statistics(docs)
    rules = quality_rules.fit(counted, labels)
    kept = by_id(quality_rules.with_verdict(counted, rules), "kept")
    assert all(kept[i] for i, _ in clean) and not any(kept[i] for i, _ in junk) and kept[500] is False
    assert quality_rules.fit(counted, labels.limit(0)) == []


def edit_distance(a, b):
    """Optimal string alignment."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_equals_edit_distance():
    draw = random.Random(4)
    terms = ["".join(draw.choices("abc", k=draw.randint(3, 7))) for _ in range(25)]
    trie = toxicity.Trie()
    for t in terms:
        trie.add(t)
    for _ in range(300):
        word = "".join(draw.choices("abc", k=draw.randint(1, 8)))
        least = min((edit_distance(word, t), t) for t in terms)
        assert toxicity.Automaton(word, 2).nearest(trie) == (least if least[0] <= 2 else None)


def test_matcher_finds_all_misspellings():
    matcher = toxicity.Matcher(toxicity.Lexicon(("numbskull", "oafish"), ("grumbl",), ("oafisk",)))
    words = ["numbskull", "nmubskull", "numskul", "oafsh", "ofaish", "oafisk", "grumbling", "harmless", "oa"]
    matcher.learn(words)
    assert [matcher.hits.get(w, 0) for w in words] == [1, 2, 2, 2, 2, 0, 1, 0, 0]
    matcher.learn(["oafish"])
    assert matcher.features('he is an oafish man\nthey said "numbskull" again') == (1, 1, 0, 0)


def test_toxicity_is_learnt(spark, documents):
    draw = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        words = [f"{draw.choice('bcdfg')}{draw.choice('aeiou')}{draw.randint(0, 400)}" for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            words[draw.randint(2, 20)] = "numbskull" if i % 8 else "grumbl" + draw.choice(["ing", "ed", "er", "s"])
            words[draw.randint(21, 29)] = "oafish"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    # Copies of one toxic text must not make terms of its other words.
    rows += [(1000 + i, "zebra lamp window oafish carpet") for i in range(30)]
    labels += [(1000 + i, 1) for i in range(30)]
    docs = documents(*rows, (2000, "what a numbskul you are"), (2001, None), (2002, "zebra lamp window carpet"))
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = by_id(toxicity.with_toxicity(docs, known), "predicted", "score")
    assert [found[i][0] for i, _ in labels] == [y for _, y in labels]
    assert found[2000][0] == 1 and found[2001][0] == 0 and found[2002][0] == 0
    none = by_id(toxicity.with_toxicity(docs, known.limit(0)), "predicted", "score")
    assert all(v[0] == 0 and 0 <= v[1] <= 1 for v in none.values())


def test_short_terms_are_found_misspelled():
    matcher = toxicity.Matcher(toxicity.Lexicon(("abcd", "oaf", "grumbling"), (), ("abcx",)))
    words = ["abcd", "bacd", "abd", "abcdd", "abce", "abcx", "xbcx", "ab", "oa", "grmbing"]
    matcher.learn(words)
    assert [matcher.hits.get(w, 0) for w in words] == [1, 2, 2, 2, 2, 0, 0, 0, 0, 2]
    # Two edits from either term, but only the longer one allows two.
    matcher = toxicity.Matcher(toxicity.Lexicon(("abcd", "abcdefgh")))
    matcher.learn(["abcdef"])
    assert matcher.hits == {"abcdef": 2}


def test_misspelled_inflections_and_short_terms_are_learnt(spark, documents):
    draw = random.Random(9)
    rows, labels = [], []
    for i in range(240):
        words = [f"{draw.choice('bcdfg')}{draw.choice('aeiou')}{draw.randint(0, 400)}" for _ in range(30)]
        if i % 4 == 0:
            words[draw.randint(2, 29)] = "scum" if i % 8 else "grumbl" + draw.choice(["ing", "ed", "er", "s"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    tests = ["you gurmbling man", "a grmubler she is", "you scmu there", "the scm of them", "calm water there"]
    docs = documents(*rows, *enumerate(tests, 1000))
    found = by_id(toxicity.with_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")), "predicted")
    assert [found[1000 + i] for i in range(len(tests))] == [1, 1, 1, 1, 0]
    assert [found[i] for i, _ in labels] == [y for _, y in labels]


@pytest.mark.parametrize("cells", [[], [((0, 0, 0, 0), 0, 5)], [((0, 0, 0, 0), 5, 5)]])
def test_weights_of_degenerate_labels(cells):
    assert np.isfinite(toxicity.learn_weights(cells).bias)


def brute_grams(text):
    """Codes of all n-grams of the padded words of a text."""
    found = []
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        found += list(word)
        found += [padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1)]
    return [sum(ord(c) << 21 * i for i, c in enumerate(g)) for g in found]


def brute_ranked(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:size]]


def test_distances_equal_brute_force(documents):
    draw = random.Random(12)
    alphabets = {"aa": "abcdefg", "bb": "efghijk", "cc": "abchij", "dd": "éèàb"}
    rows = [
        (i, " ".join("".join(draw.choices(letters, k=draw.randint(1, 5))) for _ in range(draw.randint(1, 25))), lang)
        for i, (lang, letters) in enumerate((k, v) for k, v in alphabets.items() for _ in range(draw.randint(4, 9)))
    ]
    size = 40
    learnt = language_id.learn_profiles(documents(*rows), profile_size=size)
    profiles, texts = {}, Counter(lang for _, _, lang in rows)
    for lang in texts:
        ranked = brute_ranked(Counter(g for _, t, own in rows if own == lang for g in brute_grams(t)), size)
        profiles[lang] = {g: rank for rank, g in enumerate(ranked)}
    order = sorted(texts, key=lambda name: (-texts[name], name))
    asked = ["abc abd hij", "éa bb", "zz zz", "x", "ABC hij hij hij efg"] + [
        " ".join("".join(draw.choices("abcdefghijkéz", k=4)) for _ in range(draw.randint(1, 30))) for _ in range(40)
    ]
    found = by_id(language_id.with_language(documents(*asked), learnt), "lang_pred", "score")
    for i, text in enumerate(asked):
        own = brute_ranked(Counter(brute_grams(text)), size)
        apart = [sum(abs(profiles[k][g] - r) if g in profiles[k] else size for r, g in enumerate(own)) for k in order]
        first, second = sorted(apart)[:2]
        assert found[i] == (order[apart.index(first)], pytest.approx((second - first) / second if second else 0.0)), text


def test_grams_of_odd_texts_equal_brute_force():
    for text in ("Straße a b", "²³ x", "日本語 のé\U00020000 a1b_c", " -- İstanbul\tﬁ\n"):
        assert sorted(language_id.grams_of(text).tolist()) == sorted(brute_grams(text)), text
    assert all(language_id.grams_of(text) is None for text in ("", "12 _ -", "² Ⅷ"))


def test_words_seen_once_cost_no_more_than_repeated_ones():
    def seconds(text):
        spent = []
        for _ in range(3):
            began = time.process_time()
            language_id.grams_of(text)
            spent.append(time.process_time() - began)
        return min(spent)

    letters = [chr(ord("a") + i) for i in range(26)]
    new = " ".join(a + b + c + d for a in letters for b in letters for c in letters for d in "xyz")
    assert seconds(new) < 8 * seconds(" ".join(["bead"] * len(new.split())))


def test_the_first_condition_has_the_highest_gain():
    draw = np.random.default_rng(3)
    x = draw.integers(0, 12, (150, 3)).astype(float)
    poor = (x[:, 1] > 7) & (draw.random(150) < 0.9) | (draw.random(150) < 0.1)
    best = quality_rules._grow(x, poor, ["a", "b", "c"], 1000, 1)[0]

    def gain(hit):
        p, n = poor[hit].sum(), (~poor[hit]).sum()
        return p * (np.log2(p / (p + n)) - np.log2(poor.mean())) if p else 0.0

    every = [
        gain(x[:, i] > t if above else x[:, i] <= t)
        for i in range(3)
        for t in np.unique(x[:, i])[:-1] + 0.5
        for above in (True, False)
    ]
    assert gain(quality_rules._meets(x, ["a", "b", "c"], [best])) == pytest.approx(max(every))


def test_verdicts_equal_brute_force(documents):
    """The ordered expression decides like the rules one after the other in Python."""
    rules = [
        quality_rules.Rule((quality_rules.Condition("digits", True, 0.2), quality_rules.Condition("words", False, 70))),
        quality_rules.Rule((quality_rules.Condition("top_word", True, 0.5),)),
    ]
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["ab", "cd", "12", "345"] if i % 2 else ["xy"]) + str(k % 7) * (i % 3) for k in range(draw.randint(40, 110))) for i in range(40)]
    measured = quality_rules.with_statistics(documents(*texts))
    rows = measured.select("*", *[v.alias(f"_{n}") for n, v in quality_rules.measures().items()]).collect()
    kept = by_id(quality_rules.with_verdict(measured, rules), "kept")
    for r in rows:
        poor = r["base_failed"] or any(
            all((r[f"_{c.measure}"] > c.threshold) == c.above for c in rule.conditions) for rule in rules
        )
        assert kept[r["doc_id"]] == (not poor)
    assert {True, False} == set(kept.values())
