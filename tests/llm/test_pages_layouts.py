"""Pages of layouts that the trees weren't trained on: exact texts, and what the extractor gets wrong is said."""

import pytest
from test_corpus_ops import BY_HAND

from sigloom.llm import dom, pages

P1 = "The river rose over night and the lower town was under water by the morning, the council said."
P2 = "Schools stay closed until Monday, and trains do not run on the line along the valley."
P3 = "Helpers came from the villages around with boats, blankets and hot soup for everyone."

LAYOUTS = (
    (f"<article><header><h1>Flood in town</h1></header><p>{P1}</p><p>{P2}</p></article>", f"Flood in town {P1} {P2}"),
    (f"<main><article><header class=entry-header><h1>Flood in town</h1></header><p>{P1}</p></article></main><footer>Imprint</footer>", f"Flood in town {P1}"),
    (f"<body><p hidden>secret words that nobody sees here at all.</p><article><h1>News</h1><p>{P1}</p></article></body>", f"News {P1}"),
    (f"<article><h1>News</h1><p>{P1}</p><div style='color:red; display : none'><p>{P2}</p></div><p>{P3}</p></article>", f"News {P1} {P3}"),
    (f"<article><h1>News</h1><p class=hidden-gem>{P1}</p><p data-hidden=1>{P2}</p></article>", f"News {P1} {P2}"),
    (f"<article><h1>News</h1><section hidden><p>{P1}</p><p>{P3}</section><p>{P2}</p></article>", f"News {P2}"),
    (f"<nav><ul><li><a href=/>Start</a></li></ul></nav><div class=layout><div class=column><h1>Flood</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></div></div><footer><p>Imprint</p></footer>", f"Flood {P1} {P2} {P3}"),
    (f"<article><h1>Flood</h1><p>{P1}</p><h2>Schools</h2><p>{P2}</p><h2>Helpers</h2><p>{P3}</p></article><aside><h3>More</h3><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul></aside>", f"Flood {P1} Schools {P2} Helpers {P3}"),
    (f"<div id=main-content><h1>Flood</h1><p>{P1} <a href=/x>More about it</a>.</p><ol><li>{P2}</li><li>{P3}</li></ol></div><div id=footer>&copy; 2024</div>", f"Flood {P1} More about it. {P2} {P3}"),
    (f"<article><h1>Flood</h1><div><p>{P1}</p><div><p>{P2}</p></div></div><p>{P3}</p></article><section class=comments><p>So sad.</p></section>", f"Flood {P1} {P2} {P3}"),
    (f"<article><h1>Flood &amp; fire</h1><p>{P1}</p><pre>10 | 20\n30 | 40</pre><p>{P2}</p></article>", f"Flood & fire {P1} 10 | 20 30 | 40 {P2}"),
    (f"<header><h1>The Daily Paper</h1><p>News since 1880</p></header><article><h2>Flood</h2><p>{P1}</p><p>{P2}</p></article>", f"Flood {P1} {P2}"),
    (f"<div class=cc-window><p>We use cookies to improve the site.</p><button>OK</button></div><article><h1>News</h1><p>{P1}</p></article>", f"News {P1}"),
    (f"<article><h1>News</h1><dl><dt>When</dt><dd>{P1}</dd><dt>Where</dt><dd>{P2}</dd></dl></article><form><label>Mail</label><input><button>Go</button></form>", f"News When {P1} Where {P2}"),
)


@pytest.fixture(scope="module")
def model():
    return pages.trained()


def text(model, html):
    nodes = dom.parse(html)
    return pages.extract_text(nodes, model.margin(pages.features(nodes)))


#: what stays in the text: a notice right before the article whose class name says nothing to the extractor
WRONG = {12}


@pytest.mark.parametrize("number", [pytest.param(i, marks=pytest.mark.xfail(strict=True)) if i in WRONG else i for i in range(len(LAYOUTS))])
def test_layouts(model, number):
    html, want = LAYOUTS[number]
    assert text(model, html) == want


@pytest.mark.parametrize("number", range(len(BY_HAND)))
def test_pages_by_hand_are_exact(model, number):
    html, want = BY_HAND[number]
    assert text(model, html) == want
