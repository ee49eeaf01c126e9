"""HTML extraction: a linear-chain CRF over DOM leaf blocks, decoded by Viterbi.

A page is its leaf blocks in order (``html_blocks``); each is tagged main text
or not. Features of a block: its own tag, which elements and which words of
class, id and role its ancestors have (in groups such as menu, advert, article),
its length, share of linked text, punctuation, a few telling words, its place
in the page, the groups of its neighbours' ancestors and whether the neighbours are links.

The CRF is trained on labelled pages made on the driver: the blocks of
``TRAIN_PAGES`` pages of the table whose markup names its parts (article, nav,
footer, ...) are labelled by it, and their texts are also set into other page
layouts, where each text's part is known. So it learns layouts that the table's
pages do not show. The sample is fixed by a hash of the rows, whatever the
table's size; an empty table trains on filler sentences. Of a training page at most
``TRAIN_BLOCKS`` blocks are learned from and ``TRAIN_TEXTS`` long and as many short texts are set into
other layouts; extraction reads whole pages.

Defined cases: null or blank html gives an empty text; a page whose every block
is tagged as not main gives an empty text; a very long page is read whole; of equally good taggings
Viterbi takes, from the last block back, the one that says not main; repeated rows are handled one by
one; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import crf
from strata.llm.html_blocks import Block, Node, blocks
from strata.llm.session import ship_code

# Bounds of the training sample.
TRAIN_PAGES, TRAIN_BLOCKS, TRAIN_TEXTS = 48, 200, 20
OTHER, MAIN = 0, 1

# Words of class, id and role, by what they name.
GROUPS: dict[str, frozenset[str]] = {
    k: frozenset(v.split())
    for k, v in {
        "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs toc pagination pager tabs skip sitemap toolbar",
        "header": "header masthead banner topbar hero branding logo",
        "footer": "footer foot bottom copyright colophon legal contentinfo",
        "side": "sidebar side aside rail widget widgets related recommended recommendations trending popular more complementary teaser",
        "advert": "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion adsense adbox commercial",
        "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall disclaimer notification toast warning message dialog",
        "form": "form login signin signup search searchbox register contact input field captcha",
        "comment": "comment comments reply replies discussion disqus respond commentlist feedback reviews thread responses",
        "share": "share sharing social follow tweet facebook byline meta tags tag author date",
        "article": "article content post entry main body story text prose page blog news paragraph description",
    }.items()
}
ELEMENTS = ("nav", "header", "footer", "aside", "form", "article", "main", "section", "ul", "table", "button", "dialog", "figure", "blockquote", "menu", "address", "fieldset", "body")
_ELEMENTS = frozenset(ELEMENTS)
INNERMOST = ("article", "main", "nav", "header", "footer", "aside", "form", "dialog", "menu", "fieldset")
TELLING = ("©", "copyright", "all rights reserved", "cookie", "subscribe", "sign in", "log in", "newsletter", "privacy", "menu", "share", "advertisement", "sponsored", "reply", "comments", "related", "read more", "terms")
OWN = ("p", "h1", "h2", "h3", "h4", "li", "td", "th", "div", "a", "span", "pre", "blockquote", "figcaption", "dt", "dd", "article", "main", "section", "body", "footer", "header", "nav", "aside", "form", "button", "summary", "legend", "address", "caption")

# Slots: own tag; a flag per group and per element; innermost element and innermost group; length; links; end; words; place; first; last; neighbours' ancestors; whether the neighbours are links.
SIZES = (len(OWN) + 1, *[2] * len(GROUPS), *[2] * len(ELEMENTS), len(INNERMOST) + 1, len(GROUPS) + 1, 8, 4, 3, 3, 6, 2, 2, len(GROUPS) + len(INNERMOST) + 1, len(GROUPS) + len(INNERMOST) + 1, 4)
OFFSETS = np.cumsum((0, *SIZES))


class View:
    """What the ancestors of a block say, kept at their innermost element and derived from its parent's."""

    __slots__ = ("element", "elements", "group", "groups")

    def __init__(self, node: Node, parent: View | None):
        mine = frozenset(k for k, v in enumerate(GROUPS.values()) if not v.isdisjoint(node.names)) if node.names else frozenset()
        self.groups = mine | parent.groups if parent else mine
        self.elements = (parent.elements if parent else frozenset()) | ({node.tag} & _ELEMENTS)
        self.element = INNERMOST.index(node.tag) + 1 if node.tag in INNERMOST else parent.element if parent else 0
        self.group = min(mine) + 1 if mine else parent.group if parent else 0


def view(node: Node | None) -> View | None:
    todo = []
    while node is not None and node.view is None:
        todo.append(node)
        node = node.parent
    last = node.view if node is not None else None
    for node in reversed(todo):
        node.view = last = View(node, last)
    return last


def features(page: list[Block]) -> np.ndarray:
    """(blocks, slots) ids into one weight table."""
    out = np.zeros((len(page), len(SIZES)), dtype=np.int64)
    inner = []
    for i, b in enumerate(page):
        v = view(b.node)
        own = b.node.tag if b.node else ""
        low = b.text.lower()
        telling = sum(low.count(w) for w in TELLING)
        row = [
            OWN.index(own) + 1 if own in OWN else 0,
            *((k in v.groups for k in range(len(GROUPS))) if v else [0] * len(GROUPS)),
            *((t in v.elements for t in ELEMENTS) if v else [0] * len(ELEMENTS)),
            v.element if v else 0,
            v.group if v else 0,
            int(np.searchsorted((10, 25, 50, 100, 200, 400, 1000), len(b.text))),
            min(3, int(4 * b.linked / max(1, len(b.text)))),
            2 if b.text[-1] in ".!?…。:;" else 1 if any(c in b.text for c in ".,") else 0,
            0 if not telling else 1 if 100 * telling < len(low) else 2,  # a word in a long text tells little
            min(5, int(6 * i / len(page))),
            i == 0,
            i == len(page) - 1,
        ]
        inner.append(v.group + len(INNERMOST) if v and v.group else v.element if v else 0)
        out[i, : len(row)] = row
    if page:
        out[1:, -3] = inner[:-1]
        out[:-1, -2] = inner[1:]
        link = np.array([b.linked >= len(b.text) for b in page], dtype=np.int64)
        out[1:, -1] = link[:-1]
        out[:-1, -1] += 2 * link[1:]
    return out + OFFSETS[:-1]


def named_label(b: Block) -> int | None:
    """Main or not by the innermost part that the markup names, if it names one."""
    for tag, names in reversed(b.path):
        if tag in ("nav", "footer", "aside", "form", "dialog", "menu") or any(
            not GROUPS[g].isdisjoint(names) for g in ("menu", "footer", "side", "advert", "notice", "form", "comment")
        ):
            return OTHER
        if tag in ("article", "main"):
            return MAIN
        if tag == "header" and not any(t in ("article", "main") for t, _ in b.path):
            return OTHER
    return None


FILLER = (
    "The river rose slowly in the night, and by the morning the lower fields were under water.",
    "Nobody had expected it so early in the year; the sluices had not been opened.",
    "It took three days, two pumps and most of the village to bring the road back.",
    "A short note.",
    "Read on",
    "Latest stories from the region",
)


def _layouts(rng: random.Random, texts: list[str], shorts: list[str]) -> Iterator[tuple[str, list[int]]]:
    """Pages of other layouts with these texts, and the label of each block."""
    for _ in range(14):
        label: list[int] = []
        e = lambda t: html.escape(t, quote=False)

        def put(tag: str, text: str, y: int, attr: str = "") -> str:
            label.append(y)
            return f"<{tag}{attr}>{e(text)}</{tag}>"

        def short() -> str:
            return rng.choice(shorts)

        def long() -> str:
            return rng.choice(texts)

        def name(group: str) -> str:
            extra = rng.choice(("", " box", " wide", "-1", " col", " item"))
            return f' {rng.choice(("class", "id", "class"))}="{rng.choice(sorted(GROUPS[group]))}{extra}"'

        def menu() -> str:
            items = "".join(put("li", short(), OTHER).replace("<li>", "<li><a href='/x'>").replace("</li>", "</a></li>") for _ in range(rng.randint(2, 7)))
            plain = (f"<ul>{items}</ul>", f"<div><ul>{items}</ul></div>")  # told by its links alone
            return rng.choice((f"<nav><ul>{items}</ul></nav>", f"<div{name('menu')}><ul>{items}</ul></div>", f"<ul{name('menu')}>{items}</ul>", *plain))

        def junk(group: str) -> str:
            body = "".join(put(rng.choice(("p", "div", "h2", "h3")), rng.choice((short(), long())), OTHER) for _ in range(rng.randint(1, 3)))
            plain = {"side": "aside", "footer": "footer", "header": "header", "form": "form", "notice": "dialog"}
            if group in plain and rng.random() < 0.5:
                return f"<{plain[group]}>{body}</{plain[group]}>"
            if group == "form":
                return f"<form{name('form')}>{body}<input name=q><button>"  + put("span", short(), OTHER) + "</button></form>"
            return f"<{(t := rng.choice(('div', 'section', 'div')))}{name(group)}>{body}</{t}>"

        def ad() -> str:
            label.append(OTHER)
            return f"<div{name('advert')}>{e(rng.choice((short(), long())))}</div>"

        def main_part() -> str:
            out = []
            if rng.random() < 0.8:
                h = put("h1", short(), MAIN)
                out.append(f"<header>{h}</header>" if rng.random() < 0.25 else h)
            for _ in range(rng.randint(1, 8)):
                kind = rng.random()
                if kind < 0.60:
                    out.append(put("p", long(), MAIN))
                elif kind < 0.70:
                    out.append(put(rng.choice(("h2", "h3")), short(), MAIN))
                elif kind < 0.80:
                    out.append("<ul>" + "".join(put("li", rng.choice((short(), long())), MAIN) for _ in range(rng.randint(1, 4))) + "</ul>")
                elif kind < 0.86:
                    out.append("<blockquote>" + put("p", long(), MAIN) + "</blockquote>")
                elif kind < 0.89:
                    out.append("<table><tr>" + put("td", short(), MAIN) + put("td", short(), MAIN) + "</tr></table>")
                elif kind < 0.92:
                    out.append(put("pre", long(), MAIN))
                else:
                    out.append(rng.choice((ad, lambda: junk("side"), lambda: junk("notice"), menu))())
            return "".join(out)

        shell = rng.choice(("article", "main", "div", "main-div", "body", "nested"))
        page = "<!DOCTYPE html><html><head><title>x</title></head><body>"
        for part in ("header", "menu", "notice", "advert", "side"):
            if rng.random() < 0.55:
                page += menu() if part == "menu" else ad() if part == "advert" else junk(part)
        if shell == "article":
            page += f"<article>{main_part()}{junk(rng.choice(('footer', 'comment'))) if rng.random() < 0.3 else ''}</article>"
        elif shell == "main":
            page += f"<main>{main_part()}{junk('comment') if rng.random() < 0.3 else ''}</main>"
        elif shell == "div":
            page += f"<div{name('article')}>{main_part()}</div>"
        elif shell == "main-div":
            page += f"<main><div{name('article')}>{main_part()}</div>{junk('side')}</main>"
        elif shell == "nested":
            page += f"<div id='wrap'><div class='row'><article><div{name('article')}>{main_part()}</div></article></div></div>"
        else:
            page += main_part()
        for part in ("comment", "share", "advert", "side", "form", "notice", "footer"):
            if rng.random() < 0.45:
                page += ad() if part == "advert" else junk(part)
        yield page + "</body></html>", label


def training_pages(sample: list[str], seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, labels) of the labelled pages made from a sample of pages."""
    rng = random.Random(seed)
    out, texts, shorts = [], [], []
    for page in sample:
        found = blocks(page)[:TRAIN_BLOCKS]
        marks = [named_label(b) for b in found]
        if found and None not in marks:
            out.append((features(found), np.array(marks)))
        texts += [b.text for b in found if len(b.text) >= 80][:TRAIN_TEXTS]
        shorts += [b.text for b in found if len(b.text) < 80][:TRAIN_TEXTS]
    texts, shorts = texts or list(FILLER[:3]), shorts or list(FILLER[3:])
    for _ in range(30):
        for page, label in _layouts(rng, texts, shorts):
            found = blocks(page)
            if len(found) == len(label):
                out.append((features(found), np.array(label)))
    return out


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> crf.Chain:
    # A few times as many by a hash of the rows, then the first of those: no task sends more than its share.
    share = min(1.0, 8 * train_pages / max(pages.count(), 1))
    h = F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 30))
    rows = (
        pages.select("html", h.alias("h"))
        .where(F.col("html").isNotNull() & (F.col("h") <= int(share * (1 << 30))))
        .orderBy("h", "html")
        .limit(train_pages)
        .collect()
    )
    made = training_pages([r["html"] for r in rows])
    longest = max(len(y) for _, y in made)
    ids = np.broadcast_to(OFFSETS[:-1], (len(made), longest, len(SIZES))).copy()
    tags, mask = np.zeros((len(made), longest), dtype=np.int64), np.zeros((len(made), longest), dtype=bool)
    for i, (x, y) in enumerate(made):
        ids[i, : len(y)], tags[i, : len(y)], mask[i, : len(y)] = x, y, True
    chain = crf.Chain(int(OFFSETS[-1]), 2)
    chain.train(ids, tags, mask, rounds=80)
    return chain


def main_text(pages: list[str | None], chain: crf.Chain) -> list[str]:
    """The main text of each page: its main blocks, joined by an empty line."""
    found = [blocks(p or "") for p in pages]
    counts = np.array([len(x) for x in found])
    if not counts.sum():
        return [""] * len(pages)
    e = chain.scores(np.concatenate([features(x) for x in found if x]))
    tags = crf.decode(chain, e, np.repeat(np.arange(len(pages)), counts), OTHER)
    ends = np.cumsum(counts)
    return ["\n\n".join(b.text for b, t in zip(x, tags[end - len(x) : end]) if t == MAIN) for x, end in zip(found, ends)]


def extract(pages: DataFrame, chain: crf.Chain) -> DataFrame:
    """page_id, url, text."""
    spark = pages.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(chain)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                text = main_text(part["html"].to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(text, pa.string())], ["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def op5_html_extract(pages: DataFrame) -> DataFrame:
    return extract(pages, train(pages)).withColumn("n_chars", F.char_length("text").cast("long"))
