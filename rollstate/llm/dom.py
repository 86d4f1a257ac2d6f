"""A small forgiving HTML reader: block elements, the text runs in them and features of each block."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

_TAG = re.compile(r"""<!--|<!\[CDATA\[|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""")
_ATTRIBUTE = re.compile(r"""\b(?:id|class|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(r"[a-z]+")
_STOPS = re.compile(r"[.,;:!?]")

# Element names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol optgroup option p pre search section select summary "
    "table caption tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset("script style noscript template head svg iframe math object canvas audio video textarea title".split())
#: Of these, the ones whose text has no markup in it.
RAW = frozenset(("script", "style", "textarea", "title"))
SPACING = frozenset(("br", "wbr", "img", "input"))
ENDED_BY = {
    "p": BLOCKS - {"button", "label", "option", "select"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "tr": {"tr", "tbody", "tfoot"},
}
#: Elements beyond which an implied or stray end does not reach.
WALLS = {"li": {"ul", "ol", "menu"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}}
CONTROLS = frozenset(("form", "button", "select", "label", "option", "fieldset"))


@dataclass
class Page:
    """Blocks in page order; block 0 is the page itself.  A run is text between block borders."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    tokens: list[list[str]] = field(default_factory=lambda: [[]])
    depths: list[int] = field(default_factory=lambda: [0])
    runs: list[tuple[int, str]] = field(default_factory=list)
    run_links: list[int] = field(default_factory=list)  # characters inside links, by run
    links: list[int] = field(default_factory=lambda: [0])


def parse(source: str) -> Page:
    """Reads a page.  Comments, scripts, styles and other silent elements leave nothing; ends may be missing or wrong."""
    page = Page()
    stack = [0]
    text: list[str] = []
    linked = 0
    link_at = -1  # depth of the stack at which a link is open, or -1

    def flush() -> None:
        nonlocal linked
        if text:
            shown = " ".join(html.unescape("".join(text)).split())
            if shown:
                page.runs.append((stack[-1], shown))
                page.run_links.append(min(linked, len(shown)))
            text.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal link_at
        flush()
        del stack[depth:]
        if link_at >= len(stack):
            link_at = -1

    at, end = 0, len(source)
    while at < end:
        m = _TAG.search(source, at)
        stop = m.start() if m else end
        if stop > at:
            text.append(source[at:stop])
            if link_at >= 0:
                linked += stop - at
        if not m:
            break
        at = m.end()
        if m[0] == "<!--" or m[0] == "<![CDATA[":
            mark = "-->" if m[0] == "<!--" else "]]>"
            found = source.find(mark, at)
            at = end if found < 0 else found + len(mark)
            continue
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = bool(m[1] or m[4])
        if name in SILENT:
            if not closing and not (m[3] or m[6] or "").endswith("/"):
                if name == "head":  # ends at its own end or where the body starts
                    found = re.compile(r"</head\s*>|(?=<body\b)", re.I).search(source, at)
                else:
                    found = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                # Without its end, raw text goes on to the end of the page; any other element hides nothing.
                at = found.end() if found else (end if name in RAW else at)
        elif name in BLOCKS:
            if closing:
                wall = WALLS.get(name, ())
                for depth in range(len(stack) - 1, 0, -1):
                    if page.tags[stack[depth]] == name:
                        close(depth)
                        break
                    if page.tags[stack[depth]] in wall:
                        break
                continue
            flush()
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = page.tags[stack[depth]]
                if name in ENDED_BY.get(open_tag, ()):
                    close(depth)
                elif open_tag in WALLS.get(name, ()) or open_tag not in ENDED_BY:
                    break
            attributes = m[3] or m[6] or ""
            node = len(page.tags)
            page.tags.append(name)
            page.parents.append(stack[-1])
            page.depths.append(len(stack))
            page.links.append(0)
            values = _ATTRIBUTE.findall(attributes) if attributes else ()
            page.tokens.append(_TOKEN.findall(" ".join(values).lower()) if values else [])
            if name != "hr":
                stack.append(node)
        elif name in SPACING:
            text.append(" ")
        elif name == "a":
            if not closing:
                link_at = len(stack) - 1
                page.links[stack[-1]] += 1
            else:
                link_at = -1
    flush()
    return page


FEATURES = (
    "text_log link_share own_log own_link_share text_per_block links_log depth place siblings_log share_of_parent share_of_page "
    "stop_density sibling_mean_log sibling_max_log same_tag_siblings paragraphs_log before_share after_share heading listed controls "
    "tag_odds parent_tag_odds token_least token_most token_least_above token_most_above tokens"
).split()


def features(page: Page, tag_odds: dict[str, float], token_odds: dict[str, float]) -> np.ndarray:
    """One row per block: its subtree's size and densities, depth, siblings, and what its tag and attribute tokens suggest."""
    n = len(page.tags)
    own = np.zeros(n)
    own_linked = np.zeros(n)
    stops = np.zeros(n)
    before = np.zeros(n)
    done = 0
    first_run = [-1] * n
    for (node, shown), linked in zip(page.runs, page.run_links, strict=True):
        if first_run[node] < 0:
            first_run[node] = done
        own[node] += len(shown)
        own_linked[node] += linked
        stops[node] += len(_STOPS.findall(shown))
        done += len(shown)
    parents = page.parents
    text, linked, stop = own.copy(), own_linked.copy(), stops.copy()
    links = np.array(page.links, dtype=float)
    blocks = np.ones(n)
    paragraphs = np.array([t == "p" for t in page.tags], dtype=float)
    controls = np.array([t in CONTROLS for t in page.tags], dtype=float)
    starts = [f if f >= 0 else done + 1 for f in first_run]
    for i in range(n - 1, 0, -1):
        p = parents[i]
        for a in (text, linked, stop, links, blocks, paragraphs, controls):
            a[p] += a[i]
        if starts[i] < starts[p]:
            starts[p] = starts[i]
    before = np.minimum(np.array(starts), done)
    up = np.array([max(p, 0) for p in parents])
    children = np.bincount(up[1:], minlength=n) if n > 1 else np.zeros(n)
    child_text = np.bincount(up[1:], weights=text[1:], minlength=n) if n > 1 else np.zeros(n)
    most = np.zeros(n)
    np.maximum.at(most, up[1:], text[1:])
    places, counts = np.zeros(n), [0] * n
    same: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p = parents[i]
        places[i] = counts[p]
        counts[p] += 1
        key = (p, page.tags[i])
        same[key] = same.get(key, 0) + 1
    alike = np.array([1.0] + [same[parents[i], page.tags[i]] for i in range(1, n)])
    odds = np.array([tag_odds.get(t, 0.0) for t in page.tags])
    known = [[token_odds[t] for t in tokens if t in token_odds] for tokens in page.tokens]
    least = np.array([min(k, default=0.0) for k in known])
    top = np.array([max(k, default=0.0) for k in known])
    least_above, top_above = np.zeros(n), np.zeros(n)
    for i in range(1, n):
        p = parents[i]
        least_above[i] = min(least_above[p], least[p])
        top_above[i] = max(top_above[p], top[p])
    total = max(1.0, float(done))
    size = np.maximum(text, 1)
    siblings = np.maximum(children[up], 1)
    return np.stack(
        [
            np.log1p(text), linked / size, np.log1p(own), own_linked / np.maximum(own, 1), np.log1p(text / blocks), np.log1p(links),
            np.array(page.depths, dtype=float), places / siblings, np.log1p(siblings), text / np.maximum(text[up], 1), text / total,
            stop / size, np.log1p(child_text[up] / siblings), np.log1p(most[up]), alike / siblings, np.log1p(paragraphs),
            before / total, (done - before - text) / total, np.array([t[0] == "h" and t[1:].isdigit() for t in page.tags], dtype=float),
            np.array([t in ("li", "ul", "ol", "menu") for t in page.tags], dtype=float), np.log1p(controls),
            odds, odds[up], least, top, least_above, top_above, np.array([len(t) for t in page.tokens], dtype=float),
        ],
        axis=1,
    ).astype(np.float32)
