"""Main text of web pages by a tree-structured graphical model.

A page is a tree: its block elements, and as leaves its runs of text. Every node is content
or not; an element is content if any text below it is. A potential on each edge says how
likely a child of its kind is content given its parent, a potential on each node how well
its features (hints in class names, length, links, punctuation) fit either answer.
Sum-product message passing, upward and then downward, gives the exact marginal of every
node; the runs of text that are more likely content than not are the main text.

The potentials are counts from labelled pages: those below, whose content is marked, and a
bounded sample of the given pages (``max_pages``, by a hash of the key) that mark their main
text themselves with an article or main element. Every page is judged, whole.

Defined cases: a null or empty html, or one without content, gives the empty text; broken
markup is read as browsers do (unclosed elements end with their parent, unknown end tags
are ignored); pages of any size and depth are read without recursion; repeated rows each
get their row; an empty table gives no rows; other input columns pass through, those named
like a result are replaced by it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrow import add_columns, column, rows_of, texts

MAX_PAGES = 2_000
# How often each page below counts, how many pages the sample counts as, and the smoothing.
WEIGHT, SAMPLE_WEIGHT, SMOOTHING = 25, 25, 0.5
# The most that a child of what is no content can be content, and the share of the evidence
# of a run's features that counts, as they and neighbouring runs say much the same.
ASTRAY, TEMPER = 0.002, 0.3

# Elements by the way they are read.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr nobr label".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HEAD = frozenset("meta link base title style script noscript template".split())
# An element on the left ends when one on the right begins inside it.
ENDED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
KNOWN = frozenset(
    "html head body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tfoot tr td th"
    " caption figure figcaption blockquote pre address details summary nav header footer aside form fieldset legend"
    " select option button input template noscript svg math object video audio canvas dialog menu hgroup center".split()
)
# Parts of class names, ids and roles, by what they hint at.
HINTS = {
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner adsense",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager tabs skip",
    "side": "sidebar side aside widget related recommended recommendations more popular trending rail teaser",
    "comment": "comment comments reply replies respond disqus discussion thread reader readers",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay warning privacy legal disclaimer",
    "foot": "footer foot copyright colophon bottom",
    "head": "masthead header top logo branding",
    "form": "form newsletter subscribe subscription signup login search contact register input",
    "share": "share sharing social follow tags meta byline author tools print",
    "hidden": "hidden invisible sr offscreen",
    "content": "content article post entry main story body text page maincontent",
}
PAGES = "pages"
_HINT_OF = {word: hint for hint, words in HINTS.items() for word in words.split()}

_markup = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?",
    re.DOTALL,
)
_hint_attributes = re.compile(
    r"\b(?:class|id|role|aria-label|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE
)
_name_parts = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_raw_end = {tag: re.compile(rf"</{tag}(?=[\s/>])|\Z", re.IGNORECASE) for tag in RAW}
_content_mark = re.compile(r"\bdata-content\b")


@dataclass
class Tree:
    """Nodes in page order; a parent comes before its children. ``text`` is None for
    elements; ``marked`` says that the element is labelled as content."""

    parent: list[int] = field(default_factory=list)
    kind: list[str] = field(default_factory=list)
    features: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    marked: list[bool] = field(default_factory=list)

    def add(self, parent: int, kind: str, features: tuple[str, ...], text: str | None, marked: bool = False) -> int:
        for values, value in zip(
            (self.parent, self.kind, self.features, self.text, self.marked),
            (parent, kind, features, text, marked),
            strict=True,
        ):
            values.append(value)
        return len(self.parent) - 1


def hints(attributes: str) -> tuple[str, ...]:
    """What the names in an element's attributes hint at."""
    if not attributes or attributes.isspace():
        return ()
    found = set()
    for m in _hint_attributes.finditer(attributes):
        if m.group().lower().startswith("hidden"):
            found.add("hidden")
        for part in _name_parts.findall(m[1] or m[2] or m[3] or ""):
            if hint := _HINT_OF.get(part.lower()):
                found.add(hint)
    return tuple(sorted(found))


def _text_features(text: str, linked: int, tag: str) -> tuple[str, ...]:
    size = len(text)
    length = 0 if size < 20 else 1 if size < 60 else 2 if size < 160 else 3
    share = 0 if linked * 4 < size else 1 if linked * 4 < 3 * size else 2
    return (f"length {length}", f"links {share}", f"ends {text[-1] in '.!?…:;' or tag in ('h1', 'h2', 'h3')}")


def parse(html: str) -> Tree:
    """The tree of block elements and runs of text of a page."""
    tree = Tree()
    stack: list[tuple[int, str]] = [(tree.add(-1, "page", (), None), "page")]
    # How often each tag is open, so that no question goes through the whole stack.
    is_open: Counter = Counter()
    run: list[str] = []
    linked = 0
    in_link = False

    def close() -> str:
        tag = stack.pop()[1]
        is_open[tag] -= 1
        return tag

    def end_run() -> None:
        nonlocal linked
        if run:
            text = " ".join(unescape("".join(run)).split())
            node, tag = stack[-1]
            if text and not is_open["head"]:
                kind = f"text in {tag if tag in KNOWN or tag == 'page' else 'other'}"
                tree.add(node, kind, _text_features(text, linked, tag), text)
            run.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            run.append(text)
            if in_link:
                linked += len(text.strip())

    at = 0
    while at < len(html):
        m = _markup.search(html, at)
        if not m:
            take(html[at:])
            break
        take(html[at : m.start()])
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag in INLINE:
                in_link = in_link and tag != "a"
            elif is_open[tag] > 0:
                end_run()
                while close() != tag:
                    pass
                in_link = False
            elif tag == "p":
                end_run()
            continue
        if tag in RAW:
            end = _raw_end[tag].search(html, at)
            at = len(html) if end.end() == len(html) else html.find(">", end.end()) + 1 or len(html)
            continue
        if tag in INLINE:
            if tag == "br":
                take(" ")
            elif tag == "a":
                in_link = True
            continue
        end_run()
        in_link = False
        if stack[-1][1] == "p":
            close()
        if tag not in HEAD and tag != "head" and is_open["head"]:
            while close() != "head":
                pass
        while stack[-1][1] in ENDED_BY and tag in ENDED_BY[stack[-1][1]]:
            close()
        if tag in ("html", "body") and is_open[tag]:
            continue
        kind = tag if tag in KNOWN else "other"
        marked = bool(_content_mark.search(m["rest"]))
        node = tree.add(stack[-1][0], kind, hints(m["rest"]), None, marked)
        if tag not in VOID and not m["rest"].endswith("/"):
            stack.append((node, tag))
            is_open[tag] += 1
    end_run()
    return tree


# ---- potentials --------------------------------------------------------------------


def labels_of(tree: Tree, own_marks: bool) -> list[bool] | None:
    """Content or not for every node of a labelled page, None if it has no label: marked
    elements with ``own_marks``, else an article or main element, less what is set apart
    inside it."""
    inside = [False] * len(tree.parent)
    any_mark = False
    for i, parent in enumerate(tree.parent):
        up = parent >= 0 and inside[parent]
        if own_marks:
            inside[i] = up or tree.marked[i]
            any_mark |= tree.marked[i]
        else:
            main = tree.kind[i] in ("article", "main")
            apart = tree.kind[i] in ("nav", "aside", "footer", "form", "menu") or bool(
                set(tree.features[i]) & {"advert", "comment", "side", "share", "menu", "notice", "form"}
            )
            inside[i] = (up or main) and not apart
            any_mark |= main
    if not any_mark:
        return None
    content = [t is not None and inside[i] for i, t in enumerate(tree.text)]
    for i in range(len(content) - 1, 0, -1):
        if content[i]:
            content[tree.parent[i]] = True
    return content


def observations(tree: Tree, labels: list[bool]) -> Iterator[str]:
    """What a labelled tree counts towards the potentials: an edge with its child's kind,
    and every feature."""
    for i, parent in enumerate(tree.parent):
        if parent >= 0:
            yield f"edge|{tree.kind[i]}|{int(labels[parent])}|{int(labels[i])}"
        text = tree.text[i] is not None
        yield f"{'texts' if text else 'elements'}||{int(labels[i])}"
        for feature in tree.features[i]:
            yield f"feature|{feature}|{int(labels[i])}"


@dataclass(frozen=True)
class Potentials:
    """``edge[kind][parent]`` is the chance that a child of a kind is content; ``odds`` the
    log-odds of content by feature, and by the absence of a hint."""

    edge: Mapping[str, tuple[float, float]]
    odds: Mapping[str, float]
    without: Mapping[str, float]
    unseen: tuple[float, float]


def potentials(counts: Mapping[str, float]) -> Potentials:
    totals: Counter = Counter()
    kinds = set()
    for key, n in counts.items():
        parts = key.split("|")
        if parts[0] == "edge":
            kinds.add(parts[1])
            totals["edge", "", int(parts[2]), int(parts[3])] += n

    def chance(kind: str, parent: int) -> float:
        yes, no = (counts.get(f"edge|{kind}|{parent}|{y}", 0) for y in (1, 0))
        return (yes + SMOOTHING) / (yes + no + 2 * SMOOTHING)

    # A child of what is no content is none either, but for the smoothing.
    edge = {k: (min(chance(k, 0), ASTRAY), chance(k, 1)) for k in kinds}
    unseen = tuple(
        (totals["edge", "", p, 1] + SMOOTHING) / (totals["edge", "", p, 0] + totals["edge", "", p, 1] + 2 * SMOOTHING)
        for p in (0, 1)
    )

    def log_odds(key: str, whole: str, present: bool) -> float:
        shares = []
        for y in (1, 0):
            n, of = counts.get(f"feature|{key}|{y}", 0), counts.get(f"{whole}||{y}", 0)
            share = (n + SMOOTHING) / (of + 2 * SMOOTHING)
            shares.append(share if present else 1 - share)
        return math.log(shares[0] / shares[1])

    features = {k.split("|")[1] for k in counts if k.startswith("feature|")}
    odds = {f: log_odds(f, "elements", True) if f in HINTS else TEMPER * log_odds(f, "texts", True) for f in features}
    without = {f: log_odds(f, "elements", False) for f in HINTS if f in features}
    return Potentials(edge, odds, without, (min(unseen[0], ASTRAY), unseen[1]))


def marginals(tree: Tree, model: Potentials) -> list[float]:
    """The probability of content for every node, by messages upward and downward."""
    size = len(tree.parent)
    bare = sum(model.without.values())
    edges = [model.edge.get(k, model.unseen) for k in tree.kind]
    own: list[tuple[float, float]] = []
    for i in range(size):
        odds = sum(model.odds.get(f, 0.0) for f in tree.features[i])
        if tree.text[i] is None:
            odds += bare - sum(model.without.get(f, 0.0) for f in tree.features[i])
        p = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
        own.append((1 - p, p))
    # Upward: below[i] is the evidence at a node and under it, up[i] its message.
    below = [list(o) for o in own]
    up: list[tuple[float, float]] = [(1.0, 1.0)] * size
    for i in range(size - 1, 0, -1):
        e0, e1 = edges[i]
        b0, b1 = below[i]
        m0, m1 = (1 - e0) * b0 + e0 * b1, (1 - e1) * b0 + e1 * b1
        scale = m0 + m1
        up[i] = (m0 / scale, m1 / scale)
        parent = below[tree.parent[i]]
        parent[0] *= up[i][0]
        parent[1] *= up[i][1]
        scale = parent[0] + parent[1]
        parent[0] /= scale
        parent[1] /= scale
    # Downward: what the rest of the tree says to a node, through its parent. Every page is
    # taken to hold some content, so the root is.
    belief: list[tuple[float, float]] = [(0.0, 1.0)] * size
    for i in range(1, size):
        p0, p1 = belief[tree.parent[i]]
        rest0, rest1 = p0 / max(up[i][0], 1e-300), p1 / max(up[i][1], 1e-300)
        e0, e1 = edges[i]
        b0, b1 = below[i]
        v0 = b0 * (rest0 * (1 - e0) + rest1 * (1 - e1))
        v1 = b1 * (rest0 * e0 + rest1 * e1)
        scale = v0 + v1
        belief[i] = (v0 / scale, v1 / scale) if scale else (1.0, 0.0)
    return [b[1] for b in belief]


def main_text(html: str, model: Potentials) -> str:
    tree = parse(html)
    chances = marginals(tree, model)
    return "\n".join(t for t, p in zip(tree.text, chances, strict=True) if t is not None and p > 0.5)


# ---- labelled pages ----------------------------------------------------------------

_SENTENCE = "The harbour was quiet that morning, and the boats came back one by one with little to show."
_LONGER = _SENTENCE + " Nobody on the quay spoke of it, though everyone had counted them twice before the bells rang."
_LINKS = "".join(f'<li><a href="/{n}">{n}</a></li>' for n in ("News", "Sport", "Weather", "Archive", "About us"))

# Invented pages; data-content marks their main text.
LABELLED = (
    f"""<html><head><title>x</title></head><body><header class="masthead"><a href="/">The Quay</a><p>Since 1901</p></header>
    <nav class="menu"><ul>{_LINKS}</ul></nav><main data-content><h1>Boats return</h1><p>{_LONGER}</p><h2>Later</h2>
    <p>{_SENTENCE}</p><ul><li>Eleven boats left before dawn.</li><li>Nine of them returned.</li></ul></main>
    <aside class="sidebar"><h3>Most read</h3><p>{_LONGER}</p><ul>{_LINKS}</ul></aside>
    <footer><p>All rights reserved. {_SENTENCE}</p></footer></body></html>""",
    f"""<html><body><div id="cookie-notice"><p>We use cookies to improve this site. {_SENTENCE}</p><button>Accept</button></div>
    <div class="header"><a href="/">Home</a></div><div class="content"><div class="article" data-content><h1>A quiet morning</h1>
    <p>{_LONGER}</p><blockquote>{_SENTENCE}</blockquote><p>{_SENTENCE}</p></div>
    <div class="comments"><h3>2 comments</h3><div class="comment"><p>{_LONGER}</p></div><div class="comment"><p>{_SENTENCE}</p>
    <a href="/reply">Reply</a></div></div></div><div class="footer">&copy; 2020 <a href="/legal">Legal</a></div></body></html>""",
    f"""<html><body><nav>{_LINKS}</nav><article><div data-content><h1>Nine of eleven</h1><p>{_LONGER}</p><p>Yes.</p>
    <table><tr><td>Boats out</td><td>11</td></tr><tr><td>Boats back</td><td>9</td></tr></table><p>{_SENTENCE}</p></div>
    <div class="ad">{_LONGER}</div><div class="share"><a href="/s">Share</a></div>
    <section class="comments"><h2>Readers say</h2><p>{_LONGER}</p><p>{_SENTENCE}</p></section></article>
    <form action="/subscribe"><p>{_SENTENCE}</p><input name="mail"><button>Subscribe</button>
    <select><option>Daily<option>Weekly</select></form>
    <footer><div>{_SENTENCE}</div><ul>{_LINKS}</ul></footer></body></html>""",
    f"""<html><body><div class="nav"><a href="/">Home</a> <a href="/news">News</a></div><section data-content><h1>Tide tables</h1>
    <p>{_SENTENCE}</p><pre>06:10 high 11:58 low</pre><dl><dt>Spring tide</dt><dd>{_SENTENCE}</dd></dl>
    <figure><figcaption>The quay at low tide.</figcaption></figure></section>
    <div class="related"><h3>Related</h3><ul>{_LINKS}</ul><p>{_LONGER}</p></div><aside><p>{_SENTENCE}</p></aside>
    <div class="newsletter"><form><p>{_LONGER}</p></form></div></body></html>""",
    f"""<html><body><header><nav><ul>{_LINKS}</ul></nav><div>{_SENTENCE}</div></header><div data-content><h1>Plain page</h1>
    <p>{_LONGER}</p><p>{_SENTENCE}</p><ol><li>{_SENTENCE}</li><li>{_LONGER}</li></ol></div>
    <div class="notice">{_LONGER}</div><div class="sidebar"><div>{_LONGER}</div></div><div id="comments"><ul><li><p>{_LONGER}</p></li>
    <li><p>{_SENTENCE}</p></li></ul></div><div class="promo"><p>{_LONGER}</p></div><footer>{_LONGER}</footer></body></html>""",
    f"""<html><body><div class="banner">{_SENTENCE}</div><h1 data-content>No container</h1><p data-content>{_LONGER}</p>
    <p data-content>{_SENTENCE}</p><p data-content>End.</p><div class="popup"><p>{_SENTENCE}</p></div>
    <footer class="site-footer"><p>{_LONGER}</p></footer></body></html>""",
    f"""<html><body><article class="post"><header><h1 data-content>With a header inside</h1></header><p data-content>{_LONGER}</p>
    <p data-content>{_SENTENCE}</p><aside><p>{_LONGER}</p></aside><p data-content>{_SENTENCE}</p><footer><p>{_SENTENCE}</p></footer>
    <nav><a href="/2">Next</a></nav></article><dialog><p>{_SENTENCE}</p></dialog><svg><desc>icon</desc></svg></body></html>""",
    # Laid out by a table.
    f"""<html><body><table><tr><td colspan=2><a href="/">The Quay</a></td></tr><tr><td><ul>{_LINKS}</ul></td><td data-content>
    <h1>Old page</h1><p>{_LONGER}</p><p>{_SENTENCE}</p><table><tr><th>Boat</th><td>Marta</td></tr></table></td></tr>
    <tr><td colspan=2><a href="/mail">Mail</a> <a href="/top">Top</a></td></tr></table></body></html>""",
    # Tables of data inside the text.
    f"""<html><body><nav>{_LINKS}</nav><div class="entry" data-content><h1>Catch by month</h1><p>{_LONGER}</p>
    <table><thead><tr><th>Month</th><th>Boxes</th></tr></thead><tbody><tr><td>May</td><td>310</td></tr><tr><td>June</td><td>295</td></tr>
    <tr><td>July</td><td>288</td></tr></tbody></table><p>{_SENTENCE}</p><table><tr><td>Total</td><td>893</td></tr></table></div>
    <div class="links"><ul>{_LINKS}</ul></div><footer>{_SENTENCE}</footer></body></html>""",
    # Answers inside answers.
    f"""<html><body><div id="page"><div class="story" data-content><h1>Bells</h1><p>{_SENTENCE}</p><p>{_LONGER}</p></div>
    <div class="thread"><div class="reply"><p>{_LONGER}</p><div class="reply"><p>{_SENTENCE}</p><div class="reply"><p>{_LONGER}</p></div>
    </div></div><div class="reply"><p>{_SENTENCE}</p></div></div></div><div class="legal"><p>{_SENTENCE}</p></div></body></html>""",
)


def count_observations(pages: Iterable[str], own_marks: bool, weight: int = 1) -> Counter:
    counts: Counter = Counter()
    for html in pages:
        tree = parse(html)
        labels = labels_of(tree, own_marks)
        if labels is not None and any(labels):
            counts[PAGES] += weight
            for key in observations(tree, labels):
                counts[key] += weight
    return counts


def combined(own: Counter, sample: Mapping[str, int]) -> dict[str, float]:
    """The counts of the labelled pages and of a sample, which counts as SAMPLE_WEIGHT
    pages however large it is."""
    scale = SAMPLE_WEIGHT / max(SAMPLE_WEIGHT, sample.get(PAGES, 0))
    return {k: own.get(k, 0) + scale * sample.get(k, 0) for k in {*own, *sample}}


def learn(pages: DataFrame, *, key: str = "page_id", html: str = "html", max_pages: int = MAX_PAGES) -> Potentials:
    """Potentials from the labelled pages and at most about ``max_pages`` of ``pages``."""
    total = pages.select(column(key)).count()
    chosen = pages
    if total > max_pages:
        place = F.pmod(F.xxhash64(column(key), column(html)), F.lit(1_000_000))
        chosen = pages.filter(place < int(1_000_000 * max_pages / total))

    def prepare():
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                counts = count_observations(texts(batch.column(0)), own_marks=False)
                if not counts:
                    continue
                yield {"seen": list(counts), "n": list(counts.values())}

        return work

    counted = rows_of(chosen.select(column(html)), prepare, "seen string, n long")
    # Kinds, hints and lengths are few, so the sums are a few hundred rows at any size.
    sample = {r["seen"]: r["n"] for r in counted.groupBy("seen").agg(F.sum("n").alias("n")).collect()}
    return potentials(combined(count_observations(LABELLED, own_marks=True, weight=WEIGHT), sample))


def with_main_text(pages: DataFrame, model: Potentials, *, html: str = "html") -> DataFrame:
    """``pages`` without html, with text and n_chars (code points)."""

    def prepare():
        def work(values: pa.Array) -> list:
            return [[main_text(t, model) for t in texts(values)]]

        return work

    found = add_columns(pages, [html], prepare, "text string")
    return found.drop(column(html)).withColumn("n_chars", F.length("text").cast("long"))
