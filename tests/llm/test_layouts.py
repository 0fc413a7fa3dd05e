"""Main text of pages laid out like none of the labelled ones, measured block by block."""

import time

import pytest

from tallyline.llm import html_extraction as extraction

_A = "Glass is made from sand, and sand is made of patience, as the old foreman used to say to us."
_B = "We kept the second furnace for bottles; the first one, smaller and hotter, was for lenses and for errors."
_C = "In the year of the flood both went cold, and for the first time one could hear the birds in the yard."
_MENU = "".join(f"<li><a href='/{n}'>{n}</a>" for n in ("Start", "Shop", "Courses", "Opening hours"))

# Each page with the blocks of its main text, in order.
PAGES = {
    "nested divs": (
        f"""<body><div class="wrap"><div class="navbar"><ul>{_MENU}</ul></div><div class="row"><div class="col">
        <div class="entry"><h1>Sand</h1><div><p>{_A}<p>{_B}</div><div><p>{_C}</div></div></div>
        <div class="sidebar"><h4>Latest</h4><p>{_B}</p></div></div><div class="site-footer"><p>{_A}</p></div></div>""",
        ["Sand", _A, _B, _C],
    ),
    "no names at all": (
        f"""<body><div><ul>{_MENU}</ul></div><div><h1>Sand</h1><p>{_A}</p><p>{_B}</p><p>{_C}</p></div>
        <div><a href="/imprint">Imprint</a> <a href="/mail">Mail</a></div>""",
        ["Sand", _A, _B, _C],
    ),
    "main with a cookie box": (
        f"""<body><div class="cookie-banner"><p>{_B}</p><button>Yes</button></div><header><h2>The Works</h2></header>
        <main><h1>Sand</h1><p>{_A}</p><ul><li>{_B}</li><li>{_C}</li></ul></main><footer><p>{_C}</p></footer>""",
        ["Sand", _A, _B, _C],
    ),
    "table layout": (
        f"""<body><table width=100%><tr><td><a href="/">Works</a></td></tr><tr><td><table><tr><td valign=top><ul>{_MENU}</ul></td>
        <td><h1>Sand</h1><p>{_A}</p><p>{_B}</p><p>{_C}</p></td></tr></table></td></tr><tr><td><a href="/x">Up</a></td></tr></table>""",
        ["Sand", _A, _B, _C],
    ),
    "nested comments": (
        f"""<body><article><h1>Sand</h1><p>{_A}</p><p>{_B}</p></article><section id="comments"><h3>3 replies</h3><ol>
        <li><p>{_C}</p><ol><li><p>{_A}</p><ol><li><p>{_B}</p></ol></ol></ol></section>
        <form class="comment-form"><p>{_C}</p><textarea>{_A}</textarea></form>""",
        ["Sand", _A, _B],
    ),
    "advert inside the text": (
        f"""<body><nav>{_MENU}</nav><div id="content"><h1>Sand</h1><p>{_A}</p><div class="ad-slot"><p>{_B}</p></div><p>{_C}</p>
        <aside class="pullquote"><p>{_B}</p></aside><p>{_B}</p></div><div class="newsletter-box"><p>{_A}</p><input></div>""",
        ["Sand", _A, _C, _B],
    ),
    "table of data": (
        f"""<body><div class="topbar"><a href="/">Works</a></div><section class="post"><h2>Sand</h2><p>{_A}</p>
        <table><tr><th>Year</th><th>Bottles</th></tr><tr><td>1921</td><td>40,000</td></tr></table><p>{_C}</p></section>
        <div class="related-posts"><ul>{_MENU}</ul><p>{_B}</p></div><div id="copyright"><p>{_C}</p></div>""",
        ["Sand", _A, "Year", "Bottles", "1921", "40,000", _C],
    ),
}


@pytest.fixture(scope="module")
def model():
    own = extraction.count_observations(extraction.LABELLED, own_marks=True, weight=extraction.WEIGHT)
    return extraction.potentials(extraction.combined(own, {}))


def test_held_out_layouts(model):
    right = found = wanted = 0
    missed = {}
    for name, (page, blocks) in PAGES.items():
        got = extraction.main_text(f"<html>{page}</body></html>", model).split("\n")
        left = list(blocks)
        hits = 0
        for block in got:
            if block in left:
                left.remove(block)
                hits += 1
        right, found, wanted = right + hits, found + len([g for g in got if g]), wanted + len(blocks)
        if left or hits < len(got):
            missed[name] = (left, len(got) - hits)
    print(f"blocks: precision {right}/{found}, recall {right}/{wanted}; {missed}")
    assert right >= 0.9 * found and right >= 0.9 * wanted, missed


def test_deep_pages_take_linear_time():
    def seconds(depth):
        page = "<div>" * depth + "<p>x" + "</b></i>" * depth
        began = time.perf_counter()
        extraction.parse(page)
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(40_000) < 60 * max(seconds(4_000), 1e-3)
