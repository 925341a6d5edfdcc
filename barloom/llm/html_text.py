"""Main text of web pages by a tree-structured graphical model.

A page becomes its element tree. Every element is content or not; its potential comes from its tag, the words
of its class, id and role, the length, links and sentences of its text, and each parent and child have a joint
potential that depends on the kind of the child: control, side part, block, link or inline. Sum-product messages passed from the
leaves up and from the root down give each element's exact marginal probability of being content. The text of
elements with a marginal of at least one half is the main text.

Training: labelled pages (``labelled_pages``) are composed from the fixed lists below, with the label of every
element known; no page of the data is used. Potentials start from smoothed counts; the features' weights are then moved
along the gradient of the labels' likelihood, which the marginals give (label minus probability), for a few passes. It
is done once by the driver, which sends the weights to the tasks.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined by
one line feed in page order; an empty block leaves nothing. Head, title, scripts, styles, templates and comments of the markup are never text. Nothing
else is dropped before the marginals.

Defined cases: null html is an empty page and gives the empty text. Broken markup is mended: a block start closes an open
paragraph, an item closes the item before it, a tag that cannot stand in a head closes it, and an end tag without its start is passed over. Rows are read one by one,
so repeated rows and null ids change nothing. An empty table gives no rows. Extra columns are not read. Trees are walked
without recursion, so depth is no limit.
"""
from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their role in the markup.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTROLS = frozenset("button datalist fieldset form input label legend meter optgroup option output progress select textarea".split())
SIDE = frozenset("aside footer header menu nav".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("head script style template title".split())
HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}


class Element:
    __slots__ = ("tag", "words", "parent", "index", "chars", "linked", "stops", "label")

    def __init__(self, tag: str, words: list[str], parent: Element | None, index: int, label: int | None = None):
        self.tag, self.words, self.parent, self.index, self.label = tag, words, parent, index, label
        self.chars = self.linked = self.stops = 0


class TreeBuilder(HTMLParser):
    """Elements in document order and the page's text with the element it stands in; None marks a block's edge."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements = [Element("#page", [], None, 0)]
        self.stack = [self.elements[0]]
        self.flow: list[tuple[Element, str] | None] = []
        self.unread = 0

    def handle_starttag(self, tag, attrs):
        if self.unread and tag not in HEAD:
            self._close_head()
        if tag in BLOCKS:
            self._close_paragraph()
            self.flow.append(None)
        if tag in CLOSED_BY_SAME:
            self._close_item(tag)
        if tag in VOID:
            if tag == "br":
                self.flow.append((self.stack[-1], " "))
            return
        named = dict(attrs)
        words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(
            named.get(k) or "" for k in ("class", "id", "role"))).lower())
        label = named.get("data-label")
        parent = self.stack[-1]
        element = Element(tag, words, parent, len(self.elements), parent.label if label is None else int(label))
        self.elements.append(element)
        self.stack.append(element)
        self.unread += tag in UNREAD

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def _pop_to(self, depth: int) -> None:
        for element in self.stack[depth:]:
            self.unread -= element.tag in UNREAD
        del self.stack[depth:]

    def _close_head(self):
        """A start tag that cannot stand in a head ends it, unless it stands in a template."""
        if any(e.tag == "template" for e in self.stack):
            return
        for depth in range(1, len(self.stack)):
            if self.stack[depth].tag in ("head", "title"):
                self._pop_to(depth)
                return

    def _close_paragraph(self):
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth].tag
            if tag == "p":
                self._pop_to(depth)
            if tag in BLOCKS:
                return

    def _close_item(self, tag):
        same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in same:
                self._pop_to(depth)
                return
            if self.stack[depth].tag in CLOSED_BY_SAME[tag]:
                return

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flow.append(None)
        for depth in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[depth].tag
            if open_tag == tag:
                self._pop_to(depth)
                return
            if open_tag in BLOCKS and tag not in BLOCKS and tag not in UNREAD:
                return

    def handle_data(self, data):
        if self.stack[-1].tag == "head" and data.strip():
            self._close_head()
        if not self.unread:
            self.flow.append((self.stack[-1], data))


def parse(html: str) -> TreeBuilder:
    tree = TreeBuilder()
    tree.feed(html)
    tree.close()
    for piece in tree.flow:
        if piece is not None:
            element, text = piece
            element.chars += len(text.split()) and len(text.strip())
            element.stops += len(re.findall(r"[.!?;]", text))
    for element in reversed(tree.elements):  # children come after their parents
        if element.tag == "a":
            element.linked = element.chars
        if element.parent is not None:
            element.parent.chars += element.chars
            element.parent.linked += element.linked
            element.parent.stops += element.stops
    return tree


KINDS = ("control", "side", "block", "link", "inline")


def features(e: Element) -> list[str]:
    share = e.linked / e.chars if e.chars else 0.0
    found = [
        f"tag {e.tag}", f"length {min(e.chars, 4_000).bit_length()}", f"links {'none' if not e.linked else int(share * 3.99)}",
        f"stops {min(e.stops, 7).bit_length()}",
    ]
    for w in e.words:
        found += [f"word {w}", f"stem {w[:4]}"]
    return found


class Model:
    """Log odds of features and joint potentials of parent and child, learned from labelled pages."""

    def __init__(self, pages: list[str], passes: int = 10, rate: float = 0.1, weight: float = 0.6, smoothing: float = 0.5):
        seen = defaultdict(lambda: [0, 0])
        pairs = {kind: [[1.0, 1.0], [1.0, 1.0]] for kind in KINDS}
        totals = [0, 0]
        trees = [parse(page).elements for page in pages]
        for tree in trees:
            for e in tree[1:]:
                if e.label is None or e.tag in UNREAD:
                    continue
                totals[e.label] += 1
                for f in features(e):
                    seen[f][e.label] += 1
                if e.parent.label is not None:
                    pairs[self._kind(e)][e.parent.label][e.label] += 1
        self.odds = {
            f: weight * math.log((n1 + smoothing) / (totals[1] + 1) / ((n0 + smoothing) / (totals[0] + 1)))
            for f, (n0, n1) in seen.items()
        }
        self.pairs = {kind: [[x / sum(row) for x in row] for row in rows] for kind, rows in pairs.items()}
        for turn in range(passes):
            for tree in trees:
                for e, p in zip(tree[1:], self.marginals(tree)[1:]):
                    if e.label is not None and e.tag not in UNREAD:
                        step = rate / (1 + turn) * (e.label - p)
                        for f in features(e):
                            self.odds[f] += step

    @staticmethod
    def _kind(e: Element) -> str:
        if e.tag in CONTROLS:
            return "control"
        if e.tag in SIDE:
            return "side"
        return "block" if e.tag in BLOCKS else "link" if e.tag == "a" else "inline"

    def marginals(self, elements: list[Element]) -> list[float]:
        """Probability of being content for each element, by one pass up and one pass down the tree."""
        n = len(elements)
        own = [(1.0, 1.0)] * n
        for e in elements[1:]:
            odds = sum(self.odds.get(f, 0.0) for f in features(e))
            odds = max(-30.0, min(30.0, odds))
            own[e.index] = (1.0, math.exp(odds)) if odds < 0 else (math.exp(-odds), 1.0)
        up = [(1.0, 1.0)] * n  # message of each element to its parent
        inside = list(own)  # own potential times the messages of the children
        for e in reversed(elements[1:]):
            b0, b1 = inside[e.index]
            p = self.pairs[self._kind(e)]
            m0, m1 = p[0][0] * b0 + p[0][1] * b1, p[1][0] * b0 + p[1][1] * b1
            total = m0 + m1
            up[e.index] = m0 / total, m1 / total
            q0, q1 = inside[e.parent.index]
            q0, q1 = q0 * up[e.index][0], q1 * up[e.index][1]
            largest = max(q0, q1)
            inside[e.parent.index] = q0 / largest, q1 / largest
        belief = list(inside)
        for e in elements[1:]:
            q0, q1 = belief[e.parent.index]  # without what this element itself told its parent
            q0, q1 = q0 / max(up[e.index][0], 1e-300), q1 / max(up[e.index][1], 1e-300)
            p = self.pairs[self._kind(e)]
            d0, d1 = q0 * p[0][0] + q1 * p[1][0], q0 * p[0][1] + q1 * p[1][1]
            b0, b1 = inside[e.index][0] * d0, inside[e.index][1] * d1
            largest = max(b0, b1, 1e-300)
            belief[e.index] = b0 / largest, b1 / largest
        return [b1 / (b0 + b1) if b0 + b1 else 0.0 for b0, b1 in belief]


def main_text(html: str, model: Model) -> str:
    tree = parse(html)
    content = [p >= 0.5 for p in model.marginals(tree.elements)]
    blocks, words = [], []
    for piece in [*tree.flow, None]:
        if piece is None:
            block = " ".join("".join(words).split())
            if block:
                blocks.append(block)
            words = []
        elif content[piece[0].index]:
            words.append(piece[1])
    return "\n".join(blocks)


# Openings of content and of the parts that surround it, from which labelled pages are composed.
CONTENT = (
    "article", "article class=post", "main", "main id=content", "div class=content", "div class=article-body", "div class=post-content",
    "div id=main", "section class=story", "div class=body-copy", "div class=story-body", "div id=content", "div class=entry-content", "div class=text", "td class=main-text", "div itemprop=articleBody",
)
LINKS = (
    "nav", "nav class=navbar", "div class=menu", "ul class=nav-menu", "div class=breadcrumbs", "div class=topnav", "div id=navigation",
    "aside class=related", "div class=sidebar", "aside", "div id=sidebar", "section class=related-posts", "div class=tag-list", "div class=pagination",
    "div class=share-buttons", "div class=social", "header", "header class=site-header", "div id=header", "div class=widget", "div class=toc",
)
SHORT = (
    "footer", "footer class=site-footer", "div class=footer", "div id=footer", "div class=copyright", "div class=legal", "header class=masthead",
    "div class=ad", "div class=ads", "div class=advert", "div class=advertisement", "div class=banner", "div class=sponsored", "aside class=promo",
    "div class=ad-slot", "div class=ad-box", "div class=site-notice", "div class=cookie-notice", "div class=cookie-banner", "div class=notice", "div role=alert", "div class=alert",
    "div class=newsletter", "div class=subscribe", "div class=popup", "div class=consent", "div class=disclaimer", "div class=modal", "div class=byline-ad",
)
FORMS = ("form", "form class=search", "form class=login", "form class=newsletter", "div class=search-form", "form class=comment-form", "div class=signup")
INSIDE = ("aside", "aside class=related", "div class=related", "div class=read-more", "section class=related-posts", "div class=share-buttons", "div class=ad")
COMMENTS = (
    "div class=comments", "section id=comments", "ol class=comment-list", "div class=comment-thread", "div class=user-comments", "section class=responses",
    "div class=comment-section", "div id=comment-area", "div class=discussion", "div id=disqus_thread", "div class=replies", "div class=reviews",
)


OPENINGS = {"content": CONTENT, "links": LINKS, "short": SHORT, "forms": FORMS, "inside": INSIDE, "comments": COMMENTS}


def labelled_pages(n: int = 400, seed: int = 11, openings: Mapping[str, Sequence[str]] = OPENINGS) -> list[str]:
    """Pages of many layouts; ``data-label`` tells content (1) from the rest (0) and holds for what is inside.

    Content also holds lists and paragraphs of links, controls, asides and wrappers without a name, and some pages are laid
    out by a table.
    """
    draw = random.Random(seed)
    letters = "etaoinshrdlu"

    def words(low, high):
        return " ".join("".join(draw.choices(letters, k=draw.randint(1, 9))) for _ in range(draw.randint(low, high)))

    def sentence(low, high):
        return words(low, high).capitalize() + draw.choice([".", ".", ".", "", "!", "?"])

    def tagged(opening, label, inner):
        tag, *rest = opening.split(" ", 1)
        attribute = " " + re.sub(r"=(.*)", r'="\1"', rest[0]) if rest else ""
        return f'<{tag}{attribute} data-label="{label}">{inner}</{tag}>'

    def links():
        items = [f'<a href="/x">{words(1, 5)}</a>' for _ in range(draw.randint(2, 12))]
        if draw.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return draw.choice([" | ", "<br>"]).join(items) if draw.random() < 0.6 else "".join(f"<p>{i}</p>" for i in items)

    def short():
        text = " ".join(sentence(2, 12) for _ in range(draw.randint(1, 3)))
        return draw.choice([text, f"<p>{text}</p>", f"&copy; {text}", f'{text} <a href="/y">{words(1, 3)}</a>', f"<p>{text}</p><button>{words(1, 2)}</button>"])

    def form():
        return f'<label>{words(1, 3)}</label><input type="text"><select><option>{words(1, 2)}</option></select><button>{words(1, 2)}</button>'

    def comment():
        return f"<div class=\"{draw.choice(['comment', 'reply', 'review'])}\"><b>{words(1, 2)}</b><p>{' '.join(sentence(3, 25) for _ in range(draw.randint(1, 4)))}</p></div>"

    def control():
        few = words(1, 3)
        return draw.choice([
            f'<select data-label="0"><option>{few}</option><option>{words(1, 3)}</option></select>', f'<button data-label="0">{few}</button>',
            f'<label data-label="0">{few} <input type="text"></label>', f'<textarea data-label="0">{few}</textarea>',
            f'<label data-label="0">{few}</label><textarea data-label="0">{words(1, 9)}</textarea>', tagged("form", 0, form()),
        ])

    def inside():
        heading = f"<h3>{words(1, 4)}</h3>" * (draw.random() < 0.5)
        return tagged(draw.choice(openings["inside"]), 0, heading + draw.choice([links, short])())

    def linked():
        items = [f'<a href="/l">{words(1, 6)}</a>' for _ in range(draw.randint(1, 6))]
        if draw.random() < 0.5:
            return "".join(f"<p>{i}</p>" for i in items[:2])
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"

    def block():
        extra = draw.random()
        if extra < 0.06:
            return control()
        if extra < 0.09:
            return f"<p>{sentence(3, 20)} {control()}</p>"
        if extra < 0.13:
            return inside()
        if extra < 0.24:
            return linked()
        if extra < 0.28:
            return f"<div>{block()}{block()}</div>"
        kind = draw.random()
        text = " ".join(sentence(1, 25) for _ in range(draw.choice([1, 1, 2, 5, 9])))
        length = draw.random()
        if length < 0.03:
            text = words(200, 900)  # no sentence ends
        elif length < 0.06:
            text = " ".join(sentence(1, 25) for _ in range(60))
        if kind < 0.5:
            return f"<p>{text}</p>"
        if kind < 0.65:
            return f"<p><b>{text}<br>"
        if kind < 0.72:
            return f'<p>{text} <a href="/z">{words(1, 4)}</a> {sentence(3, 12)}</p>'
        if kind < 0.78:
            return f"<h2>{words(2, 8)}</h2><p>{text}</p>"
        if kind < 0.84:
            return "<ul>" + "".join(f"<li>{sentence(1, 14)}</li>" for _ in range(draw.randint(2, 6))) + "</ul>"
        if kind < 0.88:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.92:
            return f"<div>{text}</div>"
        if kind < 0.96:
            return "<table><tr><th>" + words(1, 2) + "</th></tr><tr><td>" + words(1, 5) + "</td><td>" + sentence(1, 9) + "</td></tr></table>"
        return f"<figure><figcaption>{sentence(3, 12)}</figcaption></figure><pre>{words(3, 30)}</pre>"

    def around():
        kind = draw.random()
        if kind < 0.45:
            return tagged(draw.choice(openings["links"]), 0, links())
        if kind < 0.85:
            return tagged(draw.choice(openings["short"]), 0, short())
        return tagged(draw.choice(openings["forms"]), 0, form())

    pages = []
    for _ in range(n):
        blocks = [f"<h1>{words(2, 12)}</h1>"] * (draw.random() < 0.8) + [block() for _ in range(draw.choice([1, 2, 5, 12, 30]))]
        if draw.random() < 0.06:
            blocks = [f"<h1>{words(2, 12)}</h1>", linked(), linked()]
        while draw.random() < 0.4:
            blocks.insert(draw.randint(0, len(blocks)), around())
        if draw.random() < 0.2:
            blocks.append(tagged(draw.choice(openings["comments"]), 0, "".join(comment() for _ in range(draw.randint(1, 5)))))
        if draw.random() < 0.12:
            cell = "<td" + draw.choice(["", ' width="80%"', ' valign="top"']) + f' data-label="1">{"".join(blocks)}</td>'
            beside = draw.choice([f'<td data-label="0">{links()}</td>', f'<td>{tagged(draw.choice(openings["links"]), 0, links())}</td>'])
            main = f'<table data-label="0"><tr>{beside}{cell}</tr></table>'
        else:
            main = tagged(draw.choice(openings["content"]), 1, "".join(blocks))
        parts = [around() for _ in range(draw.randint(1, 4))] + [main]
        if draw.random() < 0.4:
            parts.append(tagged(draw.choice(openings["comments"]), 0, "".join(comment() for _ in range(draw.randint(1, 5)))))
        parts += [around() for _ in range(draw.randint(0, 3))]
        body = "".join(parts)
        if draw.random() < 0.4:
            body = f'<div class="{draw.choice(["wrapper", "container", "page", "layout", "row"])}" data-label="0">{body}</div>'
        whole = draw.random() < 0.7  # others are fragments
        pages.append(f'<html data-label="0"><head><title>{words(2, 9)}</title></head><body>{body}</body></html>' if whole else body)
    return pages


@lru_cache(maxsize=1)
def trained() -> Model:
    return Model(labelled_pages())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    model = trained()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, model) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(extracted, rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long"))
