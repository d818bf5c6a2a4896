"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its elements.  Every element is content or not: a binary variable with a unary potential (a
linear function of its features: tag, words of class, id and role, text length, share of link text, punctuation, place)
and, with its parent, a pairwise potential by kind of element.  Sum-product messages go up the tree and then down, which
gives each element's exact marginal.  Weights are trained by gradient ascent on the likelihood of labelled pages, whose
gradient needs the same marginals; the labelled pages are generated (``labelled_pages``), in many layouts.

The text of a block (the text between two borders of block elements) belongs to the element around it and is kept if that
element's marginal is 0.5 or more.

Pages are scanned by the tokenising rules of the HTML standard, in linear time: quotes count at the start of an attribute's
value only, scripts and styles end at their own end tag, an unfinished tag or comment reaches to the page's end.

Defined results: a null or empty page, or one without content, has an empty text; end tags may be missing and tags
unbalanced; scripts, styles, comments, titles and form fields are no text, formulas and the text of drawings and objects
are; character references are decoded, white space (also of Unicode, such as no-break spaces) in a block becomes one
space, blocks are joined by a line feed; nothing is capped.  Every row is kept, with repeated or null
page_ids; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescan.llm.common import ship, texts

SPACES = "\t\n\f\r "
OPEN = re.compile(rf"<(/?)([a-zA-Z][^{SPACES}/>]*)")
ATTRIBUTE = re.compile(rf"[{SPACES}/]*([^{SPACES}/>][^{SPACES}/>=]*)?[{SPACES}]*")
BLANK = re.compile(rf"[{SPACES}]*")
UNQUOTED = re.compile(rf"[^{SPACES}>]*")
COMMENT_END = re.compile("--!?>")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("noscript template select option button".split())
UNPARSED = frozenset("script style textarea title iframe noembed noframes".split())
RAW_END = {tag: re.compile(rf"</{tag}[{SPACES}/>]", re.I | re.A) for tag in UNPARSED}
IN_HEAD = frozenset("base link meta title noscript noframes style script template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font g i img ins kbd label mark math mfrac mi mn mo mover mrow ms mspace msqrt mstyle msub msubsup msup mtext munder object q s samp semantics small span strike strong sub sup svg text time tspan tt u var wbr".split())
P = frozenset(["p"])
CLOSES = {"p": P, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDARY = {"p": frozenset("article aside body div section td th li main header footer nav form blockquote table ul ol dl figure html".split()), "li": frozenset(["ul", "ol", "body"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]), "td": frozenset(["tr", "table"]), "th": frozenset(["tr", "table"])}
PARAGRAPH_ENDERS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
# words of class, id and role names, by what they tell
NAMES = {
    "good": "article post entry content main body story text prose".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs topbar".split(),
    "edge": "header masthead footer foot copyright colophon bottom top".split(),
    "side": "sidebar side aside rail widget related recommended popular trending recent more also".split(),
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner affiliate".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall disclaimer privacy".split(),
    "comment": "comment comments reply replies respond discussion disqus reader".split(),
    "tool": "share sharing social login search form byline meta tags author rating print".split(),
}
NAME_KIND = {word: kind for kind, words in NAMES.items() for word in words}


@dataclass
class Element:
    tag: str
    parent: int
    names: tuple[str, ...] = ()
    text: int = 0  # characters of text inside
    linked: int = 0  # of these in links
    marks: int = 0  # sentence punctuation
    own: int = 0  # characters of the element's own blocks
    label: bool | None = None


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)  # (element, text), in page order


def comment_end(page: str, at: int) -> int:
    """The place after the comment, declaration or bogus comment that begins at ``at``; of an unfinished one the page's end."""
    if page.startswith("<!--", at):
        for short in (">", "->"):
            if page.startswith(short, at + 4):
                return at + 4 + len(short)
        m = COMMENT_END.search(page, at + 4)
        return m.end() if m else len(page)
    return page.find(">", at + 2) + 1 or len(page)


def tag_end(page: str, at: int) -> tuple[int, list[str]]:
    """The place after the tag whose attributes begin at ``at``, and the values of class, id and role.

    Quotes count at the start of a value only; a tag that the page does not finish reaches to its end.  Each character is
    looked at a bounded number of times.
    """
    kept: list[str] = []
    while True:
        m = ATTRIBUTE.match(page, at)
        at = m.end()
        if at >= len(page):
            return at, kept
        if m[1] is None:
            return at + 1, kept
        if page[at] != "=":
            continue
        at = BLANK.match(page, at + 1).end()
        quote = page[at : at + 1]
        if quote and quote in "\"'":
            end = page.find(quote, at + 1)
            if end < 0:
                return len(page), kept
            value, at = page[at + 1 : end], end + 1
        else:
            end = UNQUOTED.match(page, at).end()
            value, at = page[at:end], end
        if m[1].lower() in ("class", "id", "role"):
            kept.append(value)


def parse(page: str) -> Page:
    """The tree of the block elements of a page, and its blocks of text; in time linear in the page's length."""
    out = Page([Element("root", -1)])
    stack: list[tuple[str, int]] = [("root", 0)]  # open elements; inline ones have the number of the block around them
    places: dict[str, list[int]] = {}  # by tag, where it is in the stack
    run: list[str] = []
    links, linked, muted = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            run.clear()
            if text:
                e = out.elements[stack[-1][1]]
                out.blocks.append((stack[-1][1], text))
                e.own += len(text)
                e.linked += min(linked, len(text))
                e.marks += sum(map(text.count, ".,;!?"))
            linked = 0

    def push(tag: str, element: int) -> None:
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, element))

    def close(at: int) -> None:
        """Closes the open elements from place ``at`` of the stack on."""
        nonlocal links, muted
        if any(tag not in INLINE for tag, _ in stack[at:]):
            flush()
        for tag, _ in stack[at:]:
            places[tag].pop()
            links -= tag == "a"
            muted -= tag in RAW
        del stack[at:]

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def say(text: str) -> None:
        nonlocal linked
        if stack[-1][0] == "head" and text.strip():
            close(len(stack) - 1)
        if not muted:
            run.append(text)
            if links:
                linked += len(text)

    at, n = 0, len(page)
    while at < n:
        if page[at] != "<":
            end = page.find("<", at)
            end = n if end < 0 else end
            say(page[at:end])
            at = end
            continue
        m = OPEN.match(page, at)
        if m is None:
            if page[at + 1 : at + 2] in ("!", "?") or page[at + 1 : at + 2] == "/" and at + 2 < n:
                at = comment_end(page, at)
            else:
                say("<")
                at += 1
            continue
        tag = m[2].lower()
        at, named = tag_end(page, m.end())
        if m[1] and tag != "br":
            if places.get(tag):
                close(places[tag][-1])
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag == "br" or tag in VOID and tag != "hr":
            if tag == "br":
                say(" ")
            continue
        if tag in UNPARSED:
            # raw text: no markup but its own end tag
            end = RAW_END[tag].search(page, at)
            if not end:
                break
            at, _ = tag_end(page, end.end() - 1)
            continue
        if muted and tag in ("body", "article"):
            first = min(places[t][0] for t in RAW if places.get(t))  # never closed
            close(first)
        ends = CLOSES.get(tag, P if tag in PARAGRAPH_ENDERS else ())
        if ends:
            edge = last(BOUNDARY.get(tag, BOUNDARY["p"]))
            inner = [places[t][k] for t in ends if places.get(t) and (k := bisect(places[t], edge)) < len(places[t])]
            if inner:
                close(min(inner))
        if tag in INLINE:
            links += tag == "a"
            push(tag, stack[-1][1])
            continue
        flush()
        if tag == "hr":
            continue
        names = tuple(w for value in named for w in map(str.lower, NAME.findall(value)))
        out.elements.append(Element(tag, stack[-1][1], names))
        muted += tag in RAW
        push(tag, len(out.elements) - 1)
    flush()
    for e in out.elements:
        e.text = e.own
    for e in reversed(out.elements[1:]):  # parents come before their children
        up = out.elements[e.parent]
        up.text += e.text
        up.linked += e.linked
        up.marks += e.marks
    return out


TAGS = "root html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tr td th blockquote pre figure figcaption header footer nav aside form fieldset address details summary center".split()
TAG_AT = {t: k for k, t in enumerate(TAGS)}
KINDS = [*NAMES]
N_FEATURES = len(TAGS) + 1 + len(KINDS) + 1 + 8
#: kinds of edges between a child and its parent, by the child
EDGES = ("plain", "heading", "item", "edge", "named")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def features(e: Element, e_index: int, n: int) -> list[tuple[int, float]]:
    """Sparse features of an element."""
    out = [(TAG_AT.get(e.tag, len(TAGS)), 1.0)]
    base = len(TAGS) + 1
    kinds = {NAME_KIND[w] for w in e.names if w in NAME_KIND}
    out += [(base + KINDS.index(k), 1.0) for k in kinds]
    if e.names and not kinds:
        out.append((base + len(KINDS), 1.0))
    base += len(KINDS) + 1
    density = e.linked / e.text if e.text else 0.0
    out += [(base, 1.0), (base + 1, min(1.0, math.log1p(e.own) / 7)), (base + 2, density), (base + 3, min(1.0, 30 * e.marks / e.text) if e.text else 0.0)]
    if e.own and e.own < 40:
        out.append((base + 4, 1.0))
    if not e.text:
        out.append((base + 5, 1.0))
    if density > 0.5:
        out.append((base + 6, 1.0))
    out.append((base + 7, math.log1p(e.text) / 10))
    return out


def edge_kind(e: Element) -> int:
    if any(w in NAME_KIND and NAME_KIND[w] != "good" for w in e.names):
        return 4
    if e.tag in ("nav", "aside", "footer", "header", "form"):
        return 3
    return 1 if e.tag in HEADINGS else 2 if e.tag in ("li", "td", "tr", "th", "dd", "dt", "ul", "ol", "dl", "table", "tbody") else 0


@dataclass
class Model:
    unary: np.ndarray  # N_FEATURES
    pair: np.ndarray  # edges x parent x child, log potentials

    def marginals(self, page: Page) -> tuple[list[float], list[list[float]]]:
        """P(content) of each element, and of each element with its parent P(0,0), P(0,1), P(1,0), P(1,1)."""
        es = page.elements
        n = len(es)
        unary = self.unary.tolist()
        pots = [[[math.exp(v) for v in row] for row in table] for table in self.pair.tolist()]
        score = [math.exp(max(-30.0, min(30.0, sum(unary[k] * v for k, v in features(e, i, n))))) for i, e in enumerate(es)]
        # products of unary potential and the children's messages, normalised; elements come after their parents
        up0, up1 = [1.0] * n, score[:]
        to0, to1 = [1.0] * n, [1.0] * n
        kinds = [edge_kind(e) for e in es]
        for i in range(n - 1, 0, -1):
            t = pots[kinds[i]]
            a, b = up0[i], up1[i]
            m0, m1 = t[0][0] * a + t[0][1] * b, t[1][0] * a + t[1][1] * b
            s = m0 + m1
            to0[i], to1[i] = m0 / s, m1 / s
            p = es[i].parent
            x, y = up0[p] * to0[i], up1[p] * to1[i]
            s = x + y
            up0[p], up1[p] = x / s, y / s
        belief = [0.0] * n
        joint: list[list[float]] = [[0.0] * 4 for _ in range(n)]
        belief[0] = up1[0] / (up0[0] + up1[0])
        for i in range(1, n):
            p = es[i].parent
            # the parent's belief without this child's message
            c0, c1 = (1 - belief[p]) / max(to0[i], 1e-300), belief[p] / max(to1[i], 1e-300)
            t = pots[kinds[i]]
            j = [c0 * t[0][0] * up0[i], c0 * t[0][1] * up1[i], c1 * t[1][0] * up0[i], c1 * t[1][1] * up1[i]]
            s = sum(j)
            joint[i] = [v / s for v in j]
            belief[i] = joint[i][1] + joint[i][3]
        return belief, joint

    def text(self, page: str) -> str:
        tree = parse(page)
        if not tree.blocks:
            return ""
        belief, _ = self.marginals(tree)
        return "\n".join(text for at, text in tree.blocks if belief[at] >= 0.5)


def train(pages: list[Page], steps: int = 60, rate: float = 0.5, decay: float = 2e-3) -> Model:
    """Maximum likelihood of the labels with an L2 penalty, by AdaGrad on the whole set."""
    model = Model(np.zeros(N_FEATURES), np.zeros((len(EDGES), 2, 2)))
    seen_u, seen_p = np.full(N_FEATURES, 1e-6), np.full(model.pair.shape, 1e-6)
    total = sum(len(p.elements) for p in pages)
    for _ in range(steps):
        grad_u, grad_p = np.zeros(N_FEATURES), np.zeros(model.pair.shape)
        for page in pages:
            belief, joint = model.marginals(page)
            for i, e in enumerate(page.elements):
                for k, v in features(e, i, len(page.elements)):
                    grad_u[k] += v * (e.label - belief[i])
                if i:
                    g = grad_p[edge_kind(e)]
                    g[int(page.elements[e.parent].label)][int(e.label)] += 1
                    for s in range(4):
                        g[s >> 1][s & 1] -= joint[i][s]
        for w, g, seen in ((model.unary, grad_u, seen_u), (model.pair, grad_p, seen_p)):
            g /= total
            g -= decay * w / 100
            seen += g * g
            w += rate * g / np.sqrt(seen)
    return model


CONTENT_MARK = "⁠"


def labelled_pages(n: int = 240, seed: int = 11) -> list[Page]:
    """Generated pages with known content, in varied layouts.  Content text starts with a mark that the labels come from."""
    rng = random.Random(seed)
    letters = "aeioutnrslhdcmpg"

    def word() -> str:
        return "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))

    def sentence(lo: int = 5, hi: int = 22) -> str:
        ws = [word() for _ in range(rng.randint(lo, hi))]
        if rng.random() < 0.3 and len(ws) > 4:
            ws[2] += ","
        return " ".join(ws).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{word()}">{" ".join(word() for _ in range(rng.randint(1, 3)))}</a></li>' for _ in range(k))

    def content() -> str:
        c, parts = CONTENT_MARK, []
        odd = rng.random()
        if odd < 0.1:  # one-word paragraphs
            w = word().capitalize()
            return "".join(f"<p>{c}{rng.choice([w, w, word()])}.</p>" for _ in range(rng.randint(1, 40)))
        if odd < 0.2:  # paragraphs without a sentence
            return "".join(f"<p>{c}{' '.join([word()] * rng.randint(3, 80))}</p>" for _ in range(rng.randint(1, 6)))
        if odd < 0.27:
            return "".join(f"<p>{c}{' '.join(word().upper() + rng.choice(['!!', '%%%', ' |', '']) for _ in range(rng.randint(3, 60)))}</p>" for _ in range(rng.randint(1, 6)))
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            s = " ".join(sentence() for _ in range(rng.choice([1, 1, 2, 4, 8])))
            if rng.random() < 0.15:
                s = word().capitalize() + "."
            if rng.random() < 0.2:
                s = s.replace(" ", f' <a href="/{word()}">{word()}</a> ', 1)
            if kind < 0.6:
                parts.append(f"<p>{c}{s}</p>")
            elif kind < 0.68:
                parts.append(f"<p><b>{c}{s}<br>")
            elif kind < 0.76:
                parts.append(f"<h{(h := rng.randint(2, 4))}>{c}{sentence(2, 6)}</h{h}>")
            elif kind < 0.82:
                parts.append("<ul>" + "".join(f"<li>{c}{sentence(3, 12)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif kind < 0.87:
                parts.append(f"<blockquote>{c}{s}</blockquote>" if rng.random() < 0.5 else f"<blockquote><p>{c}{s}</p></blockquote>")
            elif kind < 0.91:
                parts.append(f"<pre>{c}{s}</pre>")
            elif kind < 0.95:
                parts.append("<table>" + "".join(f"<tr><td>{c}{word()}</td><td>{c}{sentence(2, 6)}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>")
            else:
                parts.append(f"<div>{c}{s}</div>")
        return "".join(parts)

    def wrap(kind: str, inner: str, tags: tuple[str, ...]) -> str:
        tag = rng.choice(tags)
        name = rng.choice(NAMES[kind])
        attr = rng.choice([f' class="{name}"', f' id="{name}"', f' class="{name}-box {word()}"', ""] if tag != "div" else [f' class="{name}"', f' id="{name}"', f' class="{name}-{word()}"'])
        return f"<{tag}{attr}>{inner}</{tag}>"

    def clutter() -> str:
        kind = rng.choice(["menu", "side", "advert", "advert", "notice", "comment", "tool", "edge"])
        s = " ".join(sentence() for _ in range(rng.randint(1, 3)))
        if kind == "menu":
            return wrap("menu", f"<ul>{links(rng.randint(3, 9))}</ul>", ("nav", "nav", "div"))
        if kind == "side":
            return wrap("side", rng.choice([f"<h3>{sentence(1, 3)}</h3><ul>{links(4)}</ul>", f"<p>{s}</p>", s]), ("aside", "aside", "div"))
        if kind == "comment":
            return wrap("comment", "".join(rng.choice([f"<p>{sentence()}</p>", f'<div class="comment"><p>{s}</p></div>', f"<li>{s}</li>"]) for _ in range(rng.randint(1, 5))), ("section", "div", "ul"))
        if kind == "tool":
            return rng.choice([f"<form><p>{sentence(2, 8)}</p><input type=text><button>{word()}</button></form>", f"<form><label>{word()}</label><input name=q></form>", wrap("tool", f"{sentence(1, 4)} <a href=x>{word()}</a>", ("div",))])
        return wrap(kind, rng.choice([s, f"<p>{s}</p>", f"{sentence(2, 8)} <a href=x>{word()}</a>"]), ("div", "div", "section"))

    pages = []
    for _ in range(n):
        c = CONTENT_MARK
        title = f"<h1>{c}{sentence(3, 9)}</h1>"
        body = title + content() if rng.random() < 0.85 else content()
        if rng.random() < 0.35:
            body += clutter()
        if rng.random() < 0.25:
            body = rng.choice([f"<header>{title}</header>", "", ""]) + body
        style = rng.random()
        if style < 0.55:
            body = f"<article{rng.choice(['', '', ' class=post', ' id=main'])}>{body}</article>"
        elif style < 0.75:
            body = f'<div {rng.choice(["class", "id"])}="{rng.choice(NAMES["good"])}">{body}</div>'
        elif style < 0.9:
            body = f"<main>{body}</main>"
        for _ in range(rng.choice([0, 0, 0, 1, 2, 5])):
            body = f"<div{rng.choice(['', ' class=' + word()])}>{body}</div>"
        if rng.random() < 0.3 and style < 0.75:
            body = f"<main>{body}</main>"
        before = (wrap("edge", rng.choice([f"<a href=/>{word()}</a>", f"<p>{sentence(1, 6)}</p>"]), ("header", "header", "div")) if rng.random() < 0.5 else "") + (f"<nav><ul>{links(rng.randint(3, 8))}</ul></nav>" if rng.random() < 0.7 else "")
        before += "".join(clutter() for _ in range(rng.choice([0, 1, 1, 2])))
        after = "".join(clutter() for _ in range(rng.choice([0, 0, 1, 2])))
        after += f"<footer>{rng.choice(['', '<p>'])}&copy; {sentence(1, 9)}</footer>" if rng.random() < 0.85 else wrap("edge", sentence(2, 9), ("div",))
        tree = parse(f"<html><head><title>{word()}</title></head><body>{before}{body}{after}</body></html>")
        good = {at for at, text in tree.blocks if c in text}
        for e in tree.elements:
            e.label = False
        for at in good:  # what leads to content is content
            while at >= 0:
                tree.elements[at].label = True
                at = tree.elements[at].parent
        bad = {at for at, text in tree.blocks if c not in text}
        for at in bad:  # unless it holds other text of its own
            tree.elements[at].label = False
        pages.append(tree)
    return pages


_trained: list[Model] = []


def default_model() -> Model:
    """The model trained on the generated pages, once a process; some seconds."""
    if not _trained:
        _trained.append(train(labelled_pages()))
    return _trained[0]


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    ship(spark)
    weights = spark.sparkContext.broadcast(model or default_model())  # a few hundred numbers

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                found = [own.text(x) for x in texts(batch, "html")]
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(walk, "page_id long, url string, text string, n_chars long")
