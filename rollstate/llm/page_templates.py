"""Labelled pages to train the extractor on: random layouts of an article among page furniture.

Every page is written from a tree whose blocks are known to be article, furniture or mere
wrapping, so the labels are exact.  Names, nesting, order and lengths vary at random, and some
furniture has no telling name, so that size and density must be learned too.
"""

from __future__ import annotations

import random

KEEP, DROP, PASS = "keep", "drop", "pass"

# Names that sites give to parts of a page.
ARTICLE_NAMES = (
    "article content main post entry story body text article-body post-content entry-content main-content story-body "
    "blog-post page-content prose markdown articlebody"
).split()
WRAPPER_NAMES = "container wrapper page row col layout site outer inner grid wrap column primary root app".split()
FURNITURE = {
    "menu": "nav menu navbar navigation topbar breadcrumb breadcrumbs pagination pager tabs toc skip links".split(),
    "header": "header masthead branding banner site-header logo top hero-bar".split(),
    "footer": "footer site-footer copyright colophon bottom legal foot credits".split(),
    "sidebar": "sidebar aside widget related recommended trending popular more secondary teaser rail archive tags".split(),
    "notice": "notice cookie consent alert banner popup modal gdpr message warning subscribe disclaimer".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adbox commercial dfp banner".split(),
    "form": "form search newsletter signup login subscribe contact".split(),
    "comments": "comments comment reply responses discussion disqus replies thread reader feedback".split(),
    "share": "share social follow toolbar buttons actions meta byline author-box".split(),
}
NATURAL = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}


class Writer:
    """Writes one page and notes the label of every block in order."""

    def __init__(self, rng: random.Random):
        self.rng, self.parts, self.labels = rng, [], []

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        count = rng.randint(low, high)
        out = []
        for _ in range(count):
            w = "".join(rng.choice("etaoinshrdlucmfwypvbg") for _ in range(rng.choice((1, 2, 2, 3, 3, 4, 5, 6, 7, 8, 9, 11))))
            out.append(w + (rng.choice(".,.,;") if rng.random() < 0.12 else ""))
        text = " ".join(out).capitalize()
        return text + ("." if rng.random() < 0.8 else "")

    def block(self, tag: str, label: str, name: str = "", inside=None) -> None:
        attribute = ""
        if name:
            more = f" {self.rng.choice('left right big mt js is x'.split())}-{self.rng.randint(1, 9)}" if self.rng.random() < 0.2 else ""
            attribute = f' {self.rng.choice(("class", "class", "class", "id"))}="{name}{more}"'
        self.parts.append(f"<{tag}{attribute}>")
        self.labels.append(label)
        if callable(inside):
            inside()
        elif inside:
            self.parts.append(inside)
        self.parts.append(f"</{tag}>")

    def link(self) -> str:
        return f'<a href="/x">{self.words(1, 4)}</a>'

    # ------------------------------------------------------------------------------ article

    def paragraph(self) -> None:
        text = self.words(*self.rng.choice(((1, 3), (3, 12), (10, 60), (20, 90), (60, 200))))
        if self.rng.random() < 0.2:
            text = f"<b>{text}</b>"
        if self.rng.random() < 0.15:
            text += " " + self.link() + " " + self.words(2, 8)
        self.block("p", KEEP, "", text)

    def article_part(self) -> None:
        rng, kind = self.rng, self.rng.random()
        if kind < 0.7:
            self.paragraph()
        elif kind < 0.8:
            self.block(rng.choice(("h2", "h3", "h4")), KEEP, "", self.words(2, 9))
        elif kind < 0.87:
            tag = rng.choice(("ul", "ol"))
            self.block(tag, KEEP, "", lambda: [self.block("li", KEEP, "", self.words(3, 25)) for _ in range(rng.randint(2, 6))])
        elif kind < 0.91:
            self.block("blockquote", KEEP, "", lambda: self.paragraph())
        elif kind < 0.94:
            self.block("pre", KEEP, "", self.words(5, 30))
        elif kind < 0.96:
            self.table()
        else:
            self.furniture(rng.choice(("advert", "sidebar", "share", "notice", "form")))

    def table(self) -> None:
        def row() -> None:
            for _ in range(3):
                self.block("td", KEEP, "", self.words(1, 6))

        self.block("table", KEEP, "", lambda: [self.block("tr", KEEP, "", row) for _ in range(self.rng.randint(2, 4))])

    def article(self) -> None:
        rng = self.rng
        tag = rng.choice(("article", "article", "article", "main", "div", "div", "section", "td"))
        name = "" if tag in ("article", "main") and rng.random() < 0.6 else rng.choice(ARTICLE_NAMES)
        if tag in ("div", "section", "td") and rng.random() < 0.12:
            name = ""

        def inside() -> None:
            if rng.random() < 0.85:
                title = lambda: self.block("h1", KEEP, rng.choice(("", "", "title", "headline")), self.words(2, 12))
                if rng.random() < 0.15:
                    self.block("header", KEEP, "", title)
                else:
                    title()
            for _ in range(rng.choice((0, 1, 1, 2, 3, 4, 6, 9, 14))):
                self.article_part()
            self.paragraph()

        self.block(tag, KEEP, name, inside)

    # ------------------------------------------------------------------------------ furniture

    def furniture(self, kind: str) -> None:
        rng = self.rng
        tag = NATURAL.get(kind, "div") if rng.random() < 0.7 else rng.choice(("div", "section", "aside", "ul") if kind != "comments" else ("div", "section", "ol"))
        name = rng.choice(FURNITURE[kind]) if tag not in NATURAL.values() or rng.random() < 0.5 else ""
        shape = {"menu": self.links, "sidebar": self.links, "comments": self.replies, "form": self.controls}.get(kind, self.sentence)
        if kind in ("header", "footer", "notice", "share") and rng.random() < 0.4:
            shape = self.links
        self.block(tag, DROP, name, shape)

    def links(self) -> None:
        rng = self.rng
        if rng.random() < 0.4:
            self.block(rng.choice(("h2", "h3", "h4", "div")), DROP, "", self.words(1, 4))
        if rng.random() < 0.75:
            self.block("ul", DROP, rng.choice(("", "", "menu", "list", "items")), lambda: [self.block("li", DROP, "", self.link()) for _ in range(rng.randint(2, 12))])
        else:
            for _ in range(rng.randint(2, 8)):
                self.parts.append(self.link() + rng.choice((" | ", " ", " &middot; ")))

    def sentence(self) -> None:
        rng = self.rng
        if rng.random() < 0.5:
            self.parts.append(rng.choice(("&copy; ", "", "", "")) + self.words(2, 30))
        else:
            for _ in range(rng.randint(1, 2)):
                self.block(rng.choice(("p", "div", "p")), DROP, "", self.words(3, 40) + (" " + self.link() if rng.random() < 0.4 else ""))

    def replies(self) -> None:
        rng = self.rng
        if rng.random() < 0.6:
            self.block(rng.choice(("h2", "h3")), DROP, "", self.words(1, 3))
        for _ in range(rng.randint(1, 6)):
            name = rng.choice(("comment", "reply", "comment-body", "response", ""))
            self.block(rng.choice(("div", "li", "article", "p")), DROP, name, self.said)

    def said(self) -> None:
        if self.rng.random() < 0.5:
            self.block(self.rng.choice(("div", "p")), DROP, self.rng.choice(("", "author", "user", "meta")), self.words(1, 3))
        self.block("p", DROP, "", self.words(3, 80))

    def controls(self) -> None:
        self.block("label", DROP, "", self.words(1, 4))
        self.parts.append('<input type="text">')
        self.block("button", DROP, "", self.words(1, 3))

    # ------------------------------------------------------------------------------ page

    def page(self) -> tuple[str, list[str]]:
        rng = self.rng

        def some(kinds: str, chance: float) -> None:
            for kind in kinds.split():
                if rng.random() < chance:
                    self.furniture(kind)

        def wrapped(levels: int) -> None:
            if levels:
                self.block(rng.choice(("div", "div", "main", "section")), PASS, rng.choice((*WRAPPER_NAMES, "")), lambda: wrapped(levels - 1))
                return
            some("menu advert notice", 0.15)
            if rng.random() < 0.97:
                self.article()
            some("share comments sidebar form advert", 0.2)

        def body() -> None:
            some("notice header menu advert", 0.5)
            wrapped(rng.choice((0, 0, 0, 1, 1, 2, 3)))
            some("comments sidebar form", 0.35)
            some("notice footer", 0.6)

        self.block("html", PASS, "", lambda: self.block("body", PASS, "", body))
        return "".join(self.parts), [PASS, *self.labels]


def pages(count: int, seed: int) -> list[tuple[str, list[str]]]:
    """Pages and the label of each of their blocks, the page itself first."""
    rng = random.Random(seed)
    return [Writer(rng).page() for _ in range(count)]
