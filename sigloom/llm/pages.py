"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Every block element and run of text is a node. Its features are its own and its
ancestors' attribute words by kind, its tag and its parent's, depth, place among its
siblings, and the amount and density of text, links and punctuation in its subtree. The
trees give the odds that the subtree holds main text, given that the parent's does.
Decoding goes down from the root: a node is kept if its odds are even or better and its
parent is kept, so an ancestor and a descendant cannot contradict each other. (The single
most likely labelling of the whole tree drops long articles: the small doubts about a thousand
paragraphs add up to more than the one about their parent.) The kept runs of text, white space collapsed, are joined by one space in page order.

No table holds labelled pages, so the trees are trained here on pages that ``training_page``
makes up from layouts of the common kinds, with invented words; their number is a parameter.

Defined results: null or empty html gives an empty text and 0 characters; repeated rows are
extracted as often as they occur; an empty table gives an empty result; other columns are
ignored; broken markup never fails.
"""

from __future__ import annotations

import functools
import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dom, stage, words
from .trees import Boosted

TRAINING_PAGES = 600

#: Words of class, id and role attributes, by what they usually mark.
KINDS = {
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs toc pagination pager tabs skip",
    "header": "header masthead banner topbar logo branding tagline hero",
    "footer": "footer foot copyright colophon legal bottom contentinfo",
    "side": "sidebar side aside widget rail complementary related recommended popular trending teaser",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay warning paywall subscribe newsletter dialog toast",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion dfp adsense outbrain taboola",
    "form": "form search login signup register contact input",
    "comment": "comment comments commentlist reply replies respond discussion disqus feedback responses",
    "social": "share sharing social follow twitter facebook tags tag meta byline author",
    "content": "article content main body entry post story text page prose markdown richtext",
    "hidden": "hidden",
}
_KIND_OF = {w: i for i, (_, ws) in enumerate(KINDS.items()) for w in ws.split()}
_N_KINDS = len(KINDS)
_TAGS = {t: i for i, t in enumerate(["#root", "#text", *dom.BLOCKS])}
_TAG_SETS = [{"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "button", "label", "fieldset", "legend"}, {"article", "main"}, {"p", "blockquote", "pre"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "li", "dl"}, {"table", "tr", "td", "th", "tbody"}, {"section", "div"}, {"#text"}, {"dialog"}, {"address"}]
_SETS_OF = {t: [i for i, s in enumerate(_TAG_SETS) if t in s] for t in _TAGS}


def features(nodes: list[dom.Node]) -> np.ndarray:
    """A row per node; page order puts parents before children, which both passes rely on."""
    n, s = len(nodes), len(_TAG_SETS)
    chars, links, tags, marks, runs, paragraphs, headings = ([0.0] * n for _ in range(7))
    for i in range(n - 1, -1, -1):
        node = nodes[i]
        if node.tag == "#text":
            chars[i] = len(node.text)
            links[i] = min(node.link_chars, len(node.text))
            marks[i] = sum(map(node.text.count, ".,;:!?"))
            runs[i] = 1
        tags[i] += 1 + node.tags
        paragraphs[i] += node.tag == "p"
        headings[i] += node.tag in ("h1", "h2")
        if node.parent >= 0:
            for x in (chars, links, tags, marks, runs, paragraphs, headings):
                x[node.parent] += x[i]
    own = np.zeros((n, _N_KINDS), np.float32)
    above = np.zeros((n, _N_KINDS), np.float32)
    tag = np.zeros((n, s), np.float32)
    tags_above = np.zeros((n, s), np.float32)
    rest = np.zeros((n, 17), np.float32)
    placed = [0] * n  # children met so far
    before = 0.0
    total = max(1.0, chars[0])
    for i, node in enumerate(nodes):
        for w in node.words:
            if w in _KIND_OF:
                own[i, _KIND_OF[w]] = 1
        for j in _SETS_OF.get(node.tag, ()):
            tag[i, j] = 1
        p = node.parent
        if p >= 0:
            np.maximum(own[p], above[p], out=above[i])
            np.maximum(tag[p], tags_above[p], out=tags_above[i])
        parent = nodes[p] if p >= 0 else None
        siblings = len(parent.children) if parent else 1
        c = chars[i]
        rest[i] = (
            headings[i],
            node.depth,
            siblings,
            placed[p] / siblings if parent else 0,
            math.log1p(c),
            c / tags[i],
            links[i] / max(1.0, c),
            marks[i] / max(1.0, c),
            runs[i],
            paragraphs[i],
            before / total,
            c / total,
            c / max(1.0, chars[p]) if p >= 0 else 1,
            math.log1p(chars[p]) if p >= 0 else 0,
            links[p] / max(1.0, chars[p]) if p >= 0 else 0,
            paragraphs[p] if p >= 0 else 0,
            len(node.children),
        )
        if parent:
            placed[p] += 1
        if node.tag == "#text":
            before += c
    return np.concatenate((own, above, tag, tags_above, rest), axis=1)


def decode(nodes: list[dom.Node], odds: np.ndarray) -> list[bool]:
    """Which nodes are kept: those with even odds or better whose parent is kept.

    ``odds`` are the log odds that a node is kept if its parent is. Every decision is made once, at the
    highest node it concerns, from the features of the whole subtree; what is below follows or is judged in turn.
    """
    kept = [True, *(odds[1:] >= 0).tolist()]
    for i in range(1, len(nodes)):
        kept[i] &= kept[nodes[i].parent]
    return kept


def extract_text(nodes: list[dom.Node], odds: np.ndarray) -> str:
    return " ".join(node.text for node, kept in zip(nodes, decode(nodes, odds), strict=True) if kept and node.tag == "#text")


def training_page(rng: random.Random) -> str:
    """A made-up page; main text carries the character U+0001 at the start of its runs."""
    letters = "aeiou", "bcdfghjklmnprstvw"

    def word() -> str:
        return "".join(rng.choice(letters[(k + 1) % 2]) for k in range(rng.randint(2, 9)))

    def sentence(lo: int = 4, hi: int = 16) -> str:
        return " ".join(word() for _ in range(rng.randint(lo, hi))).capitalize() + rng.choice([".", ".", ".", ",", "!", "?", ""])

    def prose(lo: int = 1, hi: int = 6) -> str:
        return sentence(1, 6) if rng.random() < 0.25 else " ".join(sentence(1, 16) for _ in range(rng.randint(lo, hi)))

    def links(tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{word()}">{" ".join(word() for _ in range(rng.randint(1, 3)))}</a></{tag}>' for _ in range(rng.randint(3, 8)))

    def named(tag: str, kind: str, always: bool = False) -> str:
        if not always and rng.random() < 0.25:
            return f"<{tag}>"
        w = rng.choice(KINDS[kind].split())
        extra = rng.choice(["", f"-{word()}", f" {word()}", f"__{word()}"])
        return f'<{tag} {rng.choice(["class", "class", "id"])}="{w}{extra}">'

    def boiler(kind: str) -> str:
        if kind == "menu":
            return f"{named('nav', kind)}<ul>{links()}</ul></nav>" if rng.random() < 0.6 else f"{named('div', kind, True)}<ul>{links()}</ul></div>"
        if kind == "header":
            name = rng.choice(["div", "div", "h1"])
            return f"{named('header', kind)}<{name}>{sentence(1, 4)}</{name}><p>{sentence(2, 6)}</p></header>" if rng.random() < 0.6 else f"{named('div', kind, True)}{sentence(1, 5)}</div>"
        if kind == "footer":
            tag = "footer" if rng.random() < 0.7 else "div"
            return f"{named(tag, kind, tag == 'div')}{rng.choice(['&copy; ', ''])}{prose(1, 3)}{rng.choice(['', f'<ul>{links()}</ul>'])}</{tag}>"
        if kind == "side":
            tag = rng.choice(["aside", "div", "section"])
            return f"{named(tag, kind, tag != 'aside')}<h3>{sentence(1, 3)}</h3>{rng.choice([f'<ul>{links()}</ul>', f'<p>{prose()}</p>', f'<p>{prose()}</p><p>{prose()}</p>'])}</{tag}>"
        if kind == "notice":
            tag = rng.choice(["div", "div", "section", "dialog"])
            return f"{named(tag, kind, True)}<p>{prose(1, 3)}</p>{rng.choice(['<button>', '<a href=#>'])}{word()}</div>" if tag == "div" else f"{named(tag, kind, True)}{prose(1, 3)}</{tag}>"
        if kind == "advert":
            tag = rng.choice(["div", "div", "aside", "section", "p"])
            return f"{named(tag, kind, True)}{rng.choice([prose(), f'<a href=/x>{sentence()}</a>'])}</{tag}>"
        if kind == "form":
            return f"{named('form', kind)}<label>{sentence(1, 4)}</label><input name=q><p>{prose(1, 2)}</p><button>{word()}</button></form>"
        if kind == "comment":
            tag = rng.choice(["div", "section", "ol"])
            inner = "li" if tag == "ol" else "div"
            return f"{named(tag, kind, True)}" + "".join(f'<{inner} class="{rng.choice(["comment", word()])}"><p>{prose()}</p></{inner}>' for _ in range(rng.randint(1, 6))) + f"</{tag}>"
        return f"{named('div', kind, True)}<a href=#>{word()}</a> <a href=#>{word()}</a></div>"

    mark = "\x01"

    def content() -> str:
        roll = rng.random()
        if roll < 0.03:
            return "<dl>" + "".join(f"<dt>{mark}{sentence(1, 3)}</dt><dd>{mark}{prose(1, 2)}</dd>" for _ in range(rng.randint(1, 4))) + "</dl>"
        if roll < 0.06:
            return f"<figure><img src=/{word()}.png><figcaption>{mark}{sentence(2, 10)}</figcaption></figure>"
        if roll < 0.1:
            return f"<div>{''.join(content() for _ in range(rng.randint(1, 3)))}</div>"
        if roll < 0.7:
            return f"<p>{rng.choice(['', '', '<b>'])}{mark}{prose(1, 7)}{rng.choice(['</p>', '</p>', '<br>', ''])}"
        if roll < 0.8:
            return f"<h{(h := rng.randint(2, 4))}>{mark}{sentence(1, 7)}</h{h}>"
        if roll < 0.88:
            return "<ul>" + "".join(f"<li>{mark}{sentence(1, 9)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if roll < 0.93:
            return f"<blockquote><p>{mark}{prose()}</p></blockquote>"
        if roll < 0.97:
            return "<table>" + "".join(f"<tr><td>{mark}{sentence(1, 3)}</td><td>{mark}{sentence(1, 5)}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>"
        return f"<pre>{mark}{prose()}</pre>"

    kinds = [k for k in KINDS if k not in ("content", "hidden", "header")]  # a header inside an article is its own
    inside = [content() for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 12, 20]))]
    for kind in kinds:
        if rng.random() < 0.12:
            inside.insert(rng.randint(0, len(inside)), boiler(kind))
    heading = f"<h1>{mark}{sentence(2, 10)}</h1>" if rng.random() < 0.85 else ""
    if heading and rng.random() < 0.45:  # an article may have a header of its own
        heading = f"{rng.choice(['<header>', f'<header class={word()}>', '<header class=entry-header>', '<header class=post-header>'])}{heading}{rng.choice(['', '', f'<p>{mark}{sentence(3, 12)}</p>'])}</header>"
    tag = rng.choice(["article", "article", "article", "main", "div", "div", "section"])
    article = f"{named(tag, 'content', tag in ('div', 'section'))}{heading}{''.join(inside)}</{tag}>"
    for _ in range(rng.randint(0, 2)):
        article = f"{rng.choice(['<div>', named('div', 'content'), '<main>', '<section>'])}{article}</div>"
    front = [boiler(k) for k in ("header", "menu", "notice", "advert", "form", "social") if rng.random() < 0.4]
    back = [boiler(k) for k in ("comment", "side", "advert", "social", "notice", "menu", "form") if rng.random() < 0.35]
    rng.shuffle(front)
    end = [boiler("footer")] if rng.random() < 0.85 else []
    return f"<!DOCTYPE html><html><head><title>{sentence()}</title></head><body>{''.join(front)}{article}{''.join(back)}{''.join(end)}</body></html>"


@functools.cache
def trained(n_pages: int = TRAINING_PAGES, seed: int = 11) -> Boosted:
    """The trees; the same for the same arguments.

    A node's label: its subtree holds main text. Nodes whose parent has label 1 are learned from.
    """
    rng = random.Random(seed)
    xs, ys = [], []
    for _ in range(n_pages):
        nodes = dom.parse(training_page(rng))
        label = [0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            if "\x01" in nodes[i].text:
                nodes[i].text = nodes[i].text.replace("\x01", "")
                label[i] = 1
            label[nodes[i].parent] |= label[i]
        given = [i for i, node in enumerate(nodes) if node.parent >= 0 and label[node.parent]]
        xs.append(features(nodes)[given])
        ys += [label[i] for i in given]
    return Boosted().fit(np.concatenate(xs), np.array(ys, float))


def extract(pages: DataFrame, n_pages: int = TRAINING_PAGES) -> DataFrame:
    """Per row: page_id, url, text (empty if none), n_chars."""
    taken = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    stage.small_batches(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(trained(n_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in words.slices(batch, "html"):
                parsed = [dom.parse(h or "") for h in part.column("html").to_pylist()]
                odds = model.margin(np.concatenate([features(nodes) for nodes in parsed]))
                texts, at = [], 0
                for nodes in parsed:
                    texts.append(extract_text(nodes, odds[at : at + len(nodes)]))
                    at += len(nodes)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    types = dict(taken.dtypes)
    return taken.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
