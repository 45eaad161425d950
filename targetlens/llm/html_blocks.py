"""Leaf blocks of a web page with their ancestors, and labelled pages rendered from templates."""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Elements whose content is never text of the page.
OPAQUE = set("script style noscript template svg math iframe object title textarea select canvas".split())
#: Of these, elements whose content is plain to the end of the page if their end tag is missing.
RAW = {"script", "style", "title", "textarea"}
#: An opening tag of the key ends an open element of the values.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
#: Words of class, id and role that hint at the part of the page.
HINTS = {
    "menu": ("nav", "menu", "breadcrumb", "crumb", "topbar", "toolbar", "pagination", "pager", "skip"),
    "head": ("header", "masthead", "banner", "logo", "branding", "hero"),
    "foot": ("footer", "foot", "copyright", "legal", "colophon", "imprint"),
    "side": ("side", "sidebar", "widget", "related", "recommended", "recommend", "trending", "popular", "rail", "more"),
    "advert": ("ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promoted", "promotion", "teaser"),
    "notice": ("cookie", "cookies", "consent", "notice", "gdpr", "alert", "popup", "modal", "overlay", "warning", "toast", "paywall"),
    "reader": ("comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "discussion", "feedback", "reviews"),
    "form": ("form", "login", "signup", "search", "newsletter", "subscribe", "subscription", "poll", "contact"),
    "social": ("share", "sharing", "social", "follow", "tags", "meta", "byline", "author"),
    "main": ("article", "content", "post", "entry", "story", "main", "body", "text", "page"),
}
HINT_OF = {word: group for group, words in HINTS.items() for word in words}
TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
SIMPLE_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>?")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+")


@dataclass
class Block:
    """Text between two block boundaries, and where it stands."""

    context: tuple[str, ...]
    text: str
    link_chars: int = 0


def hints(attributes: str) -> tuple[str, ...]:
    """Groups of HINTS named by class, id and role."""
    found = set()
    for values in NAMES.findall(attributes):
        for part in NAME_PART.findall("".join(values)):
            group = HINT_OF.get(part.lower())
            if group:
                found.add(group)
    return tuple(sorted(found))


@dataclass
class _Page:
    """Open elements and the text gathered since the last boundary."""

    stack: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    links: int = 0
    link_depth: int = 0

    def close_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            context = tuple(dict.fromkeys(
                label for name, groups in self.stack for label in (name, *(f"~{g}" for g in groups))
            ))
            parent = f">{self.stack[-1][0]}" if self.stack else ">"
            self.blocks.append(Block((*context, parent), text, self.links))
        self.pieces, self.links = [], 0

    def add(self, raw: str) -> None:
        text = html.unescape(raw)
        self.pieces.append(text)
        if self.link_depth:
            self.links += len(text.strip())

    def open(self, name: str, attributes: str) -> None:
        self.close_block()
        ends = ENDS.get(name, ())
        while self.stack and (self.stack[-1][0] in ends or self.stack[-1][0] == "p"):
            self.stack.pop()
        self.stack.append((name, hints(attributes)))

    def close(self, name: str) -> None:
        self.close_block()
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == name:
                del self.stack[depth:]
                return


def leaf_blocks(page: str | None) -> list[Block]:
    """Blocks of the page in order; a page without text has none. Markup may be broken or cut off."""
    page, state, at = page or "", _Page(), 0
    size = len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            state.add(page[at:])
            break
        if tag > at:
            state.add(page[at:tag])
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), tag):
            end = page.find(">", tag)
            at = size if end < 0 else end + 1
            continue
        match = TAG.match(page, tag) or SIMPLE_TAG.match(page, tag)
        if match is None:
            state.add("<")
            at = tag + 1
            continue
        at = match.end()
        closing, name, attributes = match[1], match[2].lower(), match[3]
        if name == "head":
            state.close_block()  # what a head may hold is opaque or void
        elif name in OPAQUE:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size if name in RAW else at
            if name not in ("svg", "math"):
                state.close_block()
        elif name in INLINE:
            if name == "a":
                state.link_depth = max(0, state.link_depth + (-1 if closing else 1))
            elif name == "br":
                state.pieces.append(" ")
        elif name in VOID:
            state.close_block()
        elif closing:
            state.link_depth = 0
            state.close(name)
        else:
            state.open(name, attributes)
    state.close_block()
    return state.blocks


class _Writer:
    """Random pages whose main blocks are known."""

    SYLLABLES = "ra to mi en der la con est ing ver al que ung ment por ti on le au sch".split()

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.main: list[str] = []

    def words(self, low: int, high: int) -> list[str]:
        rng = self.rng
        return ["".join(rng.choices(self.SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]

    def sentence(self, low: int = 3, high: int = 18) -> str:
        return " ".join(self.words(low, high)).capitalize() + self.rng.choice("...!?")

    def paragraph(self) -> str:
        if self.rng.random() < 0.2:
            return self.sentence(1, 4)
        return " ".join(self.sentence() for _ in range(self.rng.randint(1, 6)))

    def named(self, names: list[str]) -> str:
        name = self.rng.choice(names)
        extra = self.rng.choice(["", "", " col-8", " c12", " box"])
        return f'{self.rng.choice(["class", "class", "id"])}="{name}{extra}"'

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/x">{" ".join(self.words(1, 3))}</a></li>' for _ in range(self.rng.randint(low, high)))

    def menu(self) -> str:
        items = f"<ul>{self.links(3, 8)}</ul>"
        return self.rng.choice([
            f"<nav>{items}</nav>", f"<nav {self.named(['menu', 'main-nav'])}>{items}</nav>",
            f"<div {self.named(['menu', 'navbar', 'breadcrumbs', 'top-nav'])}>{items}</div>",
        ])

    def masthead(self) -> str:
        inner = f"<a href='/'>{' '.join(self.words(1, 3))}</a><p>{self.sentence(2, 7)}</p>"
        return self.rng.choice([f"<header>{inner}</header>", f"<div {self.named(['header', 'masthead', 'site-banner'])}>{inner}</div>"])

    def notice(self) -> str:
        return f"<div {self.named(['cookie-notice', 'consent', 'gdpr-popup', 'alert', 'notice'])}><p>{self.paragraph()}</p><button>{' '.join(self.words(1, 2))}</button></div>"

    def advert(self) -> str:
        text = self.sentence(2, 14)
        return self.rng.choice([
            f"<div {self.named(['ad', 'ads', 'advert', 'sponsored', 'promo-box'])}>{text}</div>",
            f"<aside {self.named(['ad', 'advertisement'])}><p>{text}</p></aside>",
        ])

    def aside(self) -> str:
        inner = f"<h3>{' '.join(self.words(1, 3))}</h3>" + self.rng.choice([f"<ul>{self.links(2, 6)}</ul>", f"<p>{self.paragraph()}</p>"])
        return self.rng.choice([f"<aside>{inner}</aside>", f"<div {self.named(['sidebar', 'widget', 'related-posts', 'right-rail'])}>{inner}</div>"])

    def form(self) -> str:
        inner = f"<label>{' '.join(self.words(1, 3))}</label><input type='text'><p>{self.sentence(3, 10)}</p><button>{' '.join(self.words(1, 2))}</button>"
        return self.rng.choice([f"<form>{inner}</form>", f"<form {self.named(['newsletter', 'search', 'contact-form'])}>{inner}</form>"])

    def comments(self) -> str:
        one = lambda: f"<div {self.named(['comment', 'comment-body', 'reply'])}><b>{' '.join(self.words(1, 2))}</b><p>{self.paragraph()}</p></div>"
        inner = f"<h3>{' '.join(self.words(1, 2))}</h3>" + "".join(one() for _ in range(self.rng.randint(1, 4)))
        return self.rng.choice([f"<section {self.named(['comments', 'reader-comments'])}>{inner}</section>", f"<div {self.named(['comments', 'discussion', 'disqus'])}>{inner}</div>"])

    def footer(self) -> str:
        inner = f"&copy; {' '.join(self.words(1, 3))} &middot; {self.paragraph()}"
        return self.rng.choice([f"<footer>{inner}</footer>", f"<footer><p>{inner}</p><ul>{self.links(1, 4)}</ul></footer>", f"<div {self.named(['footer', 'legal', 'copyright'])}><p>{inner}</p></div>"])

    def said(self, text: str) -> str:
        self.main.append(text)
        return text

    def inline(self, text: str) -> str:
        if self.rng.random() < 0.3:
            first, _, rest = text.partition(" ")
            return self.rng.choice([f'<a href="/y">{first}</a> {rest}', f"<em>{first}</em> {rest}", f"<b>{first} {rest}"])
        return text

    def body_block(self) -> str:
        kind, rng = self.rng.random(), self.rng
        if kind < 0.68:
            text = self.inline(self.said(self.paragraph()))
            return rng.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}<br>", f"<p>{text}", f"<div>{text}</div>"])
        if kind < 0.78:
            level = rng.choice([2, 2, 3, 4])
            return f"<h{level}>{self.said(' '.join(self.words(1, 6)))}</h{level}>"
        if kind < 0.88:
            items = "".join(f"<li>{self.said(self.sentence(1, 12))}</li>" for _ in range(rng.randint(2, 5)))
            return rng.choice([f"<ul>{items}</ul>", f"<ol>{items}</ol>"])
        if kind < 0.93:
            return f"<blockquote>{self.said(self.paragraph())}</blockquote>"
        if kind < 0.96:
            return f"<pre>{self.said(' '.join(self.words(3, 20)))}</pre>"
        if kind < 0.98:
            return f"<figure><img src='z'><figcaption>{self.said(self.sentence(2, 10))}</figcaption></figure>"
        cells = "".join(f"<td>{self.said(' '.join(self.words(1, 3)))}</td>" for _ in range(rng.randint(2, 4)))
        return f"<table><tr>{cells}</tr></table>"

    def article(self) -> str:
        rng, parts = self.rng, []
        if rng.random() < 0.9:
            title = f"<h1>{self.said(' '.join(self.words(2, 10)))}</h1>"
            parts.append(f"<header>{title}</header>" if rng.random() < 0.15 else title)
        for _ in range(rng.randint(1, 12)):
            parts.append(self.body_block())
            if rng.random() < 0.1:
                parts.append(rng.choice([self.advert, self.form, self.aside])())
        if rng.random() < 0.2:
            parts.append(self.comments())
        inner = "".join(parts)
        return rng.choice([
            f"<article>{inner}</article>", f"<article>{inner}</article>", f"<main>{inner}</main>",
            f"<main><article {self.named(['post', 'story'])}>{inner}</article></main>",
            f"<div {self.named(['content', 'entry-content', 'article-body', 'post', 'main', 'story-text'])}>{inner}</div>",
            f"<section {self.named(['article', 'content'])}>{inner}</section>",
        ])

    def page(self) -> tuple[str, list[str]]:
        rng, self.main = self.rng, []
        sometimes = lambda part, p: part() if rng.random() < p else ""
        before = [sometimes(self.notice, 0.3), sometimes(self.masthead, 0.4), sometimes(self.menu, 0.8), sometimes(self.advert, 0.5), sometimes(self.form, 0.15)]
        if rng.random() < 0.3:
            rng.shuffle(before)
        after = [sometimes(self.aside, 0.4), sometimes(self.advert, 0.3), sometimes(self.comments, 0.3), sometimes(self.form, 0.2), sometimes(self.notice, 0.1), sometimes(self.footer, 0.85)]
        body = "".join(before) + self.article() + "".join(after)
        if rng.random() < 0.3:
            body = f'<div {self.named(["wrapper", "container", "page"])}>{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{' '.join(self.words(2, 5))}</title></head><body>{body}</body></html>", self.main


def template_pages(count: int, seed: int = 7) -> list[tuple[str, list[str]]]:
    """``count`` labelled pages: the html and its main blocks in order."""
    writer = _Writer(seed)
    return [writer.page() for _ in range(count)]
