"""Main text of a page by a minimum cut.

A page is read into blocks: runs of text between block elements. A logistic classifier of what a block looks like (length, links, stops, tag,
place, neighbours) gives each block a cost of being content and of being boilerplate; it learns from blocks whose elements say what they
are, which it doesn't see. What elements say is added to the costs at a fixed weight. These
are the capacities to the two terminals. Neighbours in reading order, and neighbours that share a parent or a
section, are tied by smoothness edges. The blocks on the source's side of the minimum cut are the main text.

Nulls and edge cases: a null, empty or text-free page has the text "" and no characters; a comment, script, style, title or text area that isn't closed lasts to
the end of the page; other elements that aren't closed end with the element that they are in, those that hold no blocks (buttons, options, drawings) where
a block starts; a quote in a tag that isn't closed is a character like others; elements may be nested to any depth; a character reference of any length is decoded
(one beyond all characters is U+FFFD); null ids and urls, repeated rows and empty tables work; extra columns pass through, and one
named like an output is replaced.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

#: Pages that the fit sees at most, in expectation: a share by hash; and blocks of them, exactly.
FIT_PAGES, FIT_BLOCKS = 400, 20_000
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is characters and no markup, and elements that hold no blocks.
RAW, PHRASING = frozenset("script style textarea title iframe".split()), ("button", "option", "optgroup", "select", "svg")
#: Elements and words of class or id that name what is not main text.
AWAY_TAGS = frozenset("nav footer aside form head dialog menu fieldset title button select option optgroup textarea noscript template iframe svg".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
AWAY_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side aside nav navbar navigation menu footer header masthead breadcrumb breadcrumbs comment comments reply replies respond discussion disqus notice notices alert cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget widgets toolbar pagination pager search form copyright".split())
_MAIN_WORDS = frozenset("article content main post entry story body text".split())
#: Parts of a class or id that say where or how large something is, not what.
LAYOUT_WORDS = frozenset("area bar block body bottom box btn button buttons col column container content count fixed form group head inner item items left link links list main mobile outer overlay page panel post posts right row section site sticky text title top widget widgets wrap wrapper".split())
#: Elements that are too large for their class to say anything about all that is in them.
_WHOLE = frozenset("html body main article".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS, _LONG = re.compile(r"[^a-z]+"), re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
FEATURES = ["bias", "heading", "paragraph", "item", "links", "words", "stops", "few", "symbols", "edge", "near_words", "near_links"]
#: Start and prior of the fit, in the order of FEATURES.
PRIOR = np.array([-0.5, 0.3, 0.8, -0.2, -2.5, 1.0, 0.6, -0.4, -0.2, -0.3, 0.5, -0.5])
#: Log odds that an element adds which says that it is boilerplate, beyond all looks, or main text.
SAYS_AWAY, SAYS_MAIN = -12.0, 6.0
#: Words that a page without any main text must have for a name around them to be doubted, and for bare text to be content.
LEAST_WORDS, BARE_WORDS = 60, 8


@dataclass(slots=True)
class Block:
    """A run of text, with its element's name and parent, the number of block elements it is in and how many of those
    the block before it is in too, what the elements say, the share of its text that is links, and the number of the outermost element around it that is boilerplate by its class or id alone (0: none; -1:
    there is one that is so by its name, role or style)."""

    text: str
    tag: str
    parent: int
    depth: int
    shared: int
    away: bool
    main: bool
    links: float
    named: int = 0


@dataclass(slots=True)
class _Open:
    """An open block element, with what it and those around it say, and the inline elements that are open in it."""

    tag: str
    number: int
    away: bool
    main: bool
    named: int = 0
    inline: list[tuple[str, bool, bool, int]] = field(default_factory=list)
    names: Counter = field(default_factory=Counter)


def _names_away(token: str) -> bool:
    """Whether one class or id names boilerplate: its last part does, or one does and all others tell a place (sidebar-left, but not social-science)."""
    parts = [w for w in _WORDS.split(token) if w]
    return bool(parts) and (parts[-1] in AWAY_WORDS or any(w in AWAY_WORDS for w in parts) and all(w in AWAY_WORDS or w in LAYOUT_WORDS or len(w) < 3 for w in parts))


def _says(tag: str, attrs: str) -> tuple[bool, bool, bool]:
    """Whether an element says that it is boilerplate, or main text, and whether the former is by its class or id alone."""
    away, main, named = tag in AWAY_TAGS, tag in ("article", "main"), False
    if attrs:
        for name, *values in _ATTR.findall(attrs):
            name, value = name.lower(), next((v for v in values if v), "").lower()
            if name in ("class", "id"):
                words = {w for w in _WORDS.split(value) if w}
                named |= tag not in _WHOLE and any(map(_names_away, value.split()))
                main |= not away and not named and tag not in _WHOLE and bool(words & _MAIN_WORDS)
            elif name == "role":
                away |= value in AWAY_ROLES
                main |= value in ("main", "article")
            elif name == "style":
                away |= "display:none" in value.replace(" ", "")
            else:
                away |= name == "hidden" or value == "true"
    return away or named, main, named and not away


def _short(m: re.Match) -> str:
    """A long character reference as one that can be decoded."""
    x = m[0].rstrip(";")[2:]
    digits = x.lstrip("xX0")
    return "\ufffd" if len(digits) > 7 else f"&#{'x' if x[0] in 'xX' else ''}{digits or '0'};"


def blocks_of(page: str | None) -> list[Block]:
    """The blocks of a page in reading order, with what their ancestors say."""
    out: list[Block] = []
    if not page:
        return out
    stack = [_Open("", 0, False, False)]
    parts: list[str] = []
    linked = total = number = at = marks = 0
    in_link, low = False, 1

    def said() -> tuple[bool, bool, int]:
        top = stack[-1]
        return top.inline[-1][1:] if top.inline else (top.away, top.main, top.named)

    def under(own: tuple[bool, bool, bool]) -> tuple[bool, bool, int]:
        """What all around say together with one element more."""
        nonlocal marks
        away, main, named = said()
        if own[0] and not own[2]:
            named = -1
        elif own[2] and not named:
            marks += 1
            named = marks
        return away or own[0], main or own[1], named

    def flush() -> None:
        nonlocal parts, linked, total, low
        if parts:
            text = "".join(parts)
            text = " ".join(_html.unescape(_LONG.sub(_short, text) if "&#" in text else text).split())
            if text:
                top = stack[-1]
                away, main, named = said()
                out.append(Block(text, top.tag, stack[-2].number if len(stack) > 1 else -1, len(stack), low, away, main, linked / max(1, total), named))
                low = len(stack)
            parts, linked, total = [], 0, 0

    def say(text: str) -> None:
        nonlocal linked, total
        if text:
            parts.append(text)
            total += len(text)
            linked += len(text) * in_link

    def shut() -> None:
        nonlocal low
        opened[stack.pop().tag] -= 1
        low = min(low, len(stack))

    opened: Counter = Counter()
    while at < len(page):
        m = _TOKEN.search(page, at)
        say(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in ("br", "wbr", "img", "hr", "input"):
            say(" ")
        top = stack[-1]
        if m[1]:
            if tag == "a":
                in_link = False
            if tag in BLOCK or tag in PHRASING:
                flush()
                if opened[tag] > 0:
                    while stack[-1].tag != tag:
                        shut()
                    shut()
            elif top.names[tag] > 0:
                while True:
                    name = top.inline.pop()[0]
                    top.names[name] -= 1
                    if name == tag:
                        break
            continue
        if tag in RAW:
            if not (m[3] or "").endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)  # its text is never main text
            if tag in BLOCK:
                flush()
            continue
        if tag in BLOCK or tag in PHRASING:
            flush()
            ends = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p")}.get(tag, ("p",))
            while stack[-1].tag in (ends if tag in PHRASING or tag == "p" else (*ends, *PHRASING)) and not (tag in PHRASING and stack[-1].tag == "p"):
                shut()
            if tag == "p":
                while stack[-1].tag in PHRASING:
                    shut()
                if stack[-1].tag == "p":
                    shut()
            in_link = False
            if tag not in VOID and not (tag in PHRASING and (m[3] or "").endswith("/")):
                number += 1
                stack.append(_Open(tag, number, *under(_says(tag, m[3]))))
                opened[tag] += 1
        elif tag not in VOID:
            in_link = in_link or tag == "a"
            top.inline.append((tag, *under(_says(tag, m[3]))))
            top.names[tag] += 1
    flush()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """What each block and its neighbours look like; nothing of what elements say."""
    n = len(blocks)
    out = np.zeros((n, len(FEATURES)))
    for i, b in enumerate(blocks):
        words = len(b.text.split())
        stops = b.text.count(".") + b.text.count(",") + b.text.count(";")
        odd = sum(b.text.count(c) for c in "|\u00bb\u00a9\u00b7\u203a")
        out[i, :9] = (1, b.tag in _HEADINGS, b.tag in ("p", "blockquote", "pre"), b.tag in ("li", "td", "th", "dd", "dt", "option"), b.links, min(np.log1p(words) / 3, 2), min(stops / max(1, words) * 8, 1.5), words < 4, min(odd, 3))
    if n:
        out[:, 9] = np.abs(np.arange(n) * 2 / max(1, n - 1) - 1) ** 3
        pad = np.zeros((n + 2, 2))
        pad[1:-1] = out[:, [5, 4]]
        out[:, 10:] = (pad[:-2] + pad[2:]) / 2
    return out


def fit(x: np.ndarray, y: np.ndarray, *, steps: int = 30, strength: float = 2.0) -> np.ndarray:
    """Logistic weights by Newton steps, drawn to the prior."""
    w = PRIOR.copy()
    for _ in range(steps if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - strength * (w - PRIOR)
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-6)) @ x + strength * np.eye(len(w)), g)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def minimum_cut(to_content: np.ndarray, to_away: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """True where a node is on the source's side. Node i costs ``to_away[i]`` as content and ``to_content[i]`` as boilerplate;
    an edge costs its weight where it is cut. Shortest augmenting paths in levels."""
    n = len(to_content)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def add(u: int, v: int, a: float, b: float) -> None:
        head[u].append(len(to))
        to.append(v)
        cap.append(a)
        head[v].append(len(to))
        to.append(u)
        cap.append(b)

    for i in range(n):
        # What both terminals can send through the node at once decides nothing.
        d = float(to_content[i] - to_away[i])
        if d > 0:
            add(s, i, d, 0.0)
        elif d < 0:
            add(i, t, -d, 0.0)
    for u, v, w in edges:
        add(u, v, w, w)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in head[u]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return np.array([level[i] >= 0 for i in range(n)], dtype=bool)
        nxt = [0] * (n + 2)
        while True:  # one path of the level graph after another
            path, u = [], s
            while u != t:
                while nxt[u] < len(head[u]) and not (cap[e := head[u][nxt[u]]] > 1e-9 and level[to[e]] == level[u] + 1):
                    nxt[u] += 1
                if nxt[u] < len(head[u]):
                    path.append(head[u][nxt[u]])
                    u = to[path[-1]]
                elif path:
                    level[u] = -1
                    u = to[path.pop() ^ 1]
                else:
                    break
            if u != t:
                break
            flow = min(cap[e] for e in path)
            for e in path:
                cap[e] -= flow
                cap[e ^ 1] += flow


def _edges(blocks: list[Block], near: float, kin: float) -> list[tuple[int, int, float]]:
    """Neighbours in reading order; more so the deeper the element that both are in. Blocks of one parent are tied over what lies between."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            out.append((i - 1, i, near * (b.shared / max(blocks[i - 1].depth, b.depth)) ** 2))
        if b.parent in last and last[b.parent] != i - 1:
            out.append((last[b.parent], i, kin))
        last[b.parent] = i
    return out


def odds(blocks: list[Block], weights: np.ndarray) -> np.ndarray:
    """Log odds of each block being main text: the classifier's, and what elements say."""
    looks = np.clip(features(blocks) @ weights, -7, 7)
    return looks + np.array([SAYS_AWAY if b.away else SAYS_MAIN if b.main else 0.0 for b in blocks])


def labels(blocks: list[Block], weights: np.ndarray, *, near: float = 1.2, kin: float = 0.3) -> np.ndarray:
    """Whether each block is on the content's side of the minimum cut."""
    x = odds(blocks, weights)
    return minimum_cut(np.logaddexp(0, x), np.logaddexp(0, -x), _edges(blocks, near, kin))


def _words(blocks: list[Block]) -> int:
    return sum(len(b.text.split()) for b in blocks)


def reconsidered(blocks: list[Block]) -> list[Block]:
    """The blocks with names that can't be right taken back: a class or id around most of a page's words, :data:`LEAST_WORDS` at least, names no boilerplate where nothing else is left."""
    inside: Counter = Counter()
    for b in blocks:
        if b.named > 0:
            inside[b.named] += len(b.text.split())
    wrong = {k for k, n in inside.items() if n >= LEAST_WORDS and 2 * n > _words(blocks)}
    return [replace(b, away=False, named=0) if b.named in wrong else b for b in blocks]


def main_text(page: str | None, weights: np.ndarray) -> str:
    """The blocks on the content's side. Where there are none, names around most of the page are taken back; and on a page without any other content, bare text of at least :data:`BARE_WORDS` words is content."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    kept = labels(blocks, weights)
    if not kept.any():
        blocks = reconsidered(blocks)
        kept = labels(blocks, weights)
    if not kept.any() and _words([b for b in blocks if not b.away and b.links < 0.5]) >= BARE_WORDS:
        kept = np.array([not b.away and b.links < 0.5 for b in blocks])
    return "\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for page in b.column(0).to_pylist():
            blocks = blocks_of(page)
            rows += [(float(not x.away), *f) for x, f in zip(blocks, features(blocks).tolist(), strict=True) if x.away or x.main]
        cols = [*zip(*rows, strict=True)] or [[]] * (1 + len(FEATURES))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in cols], ["y", *FEATURES])


def fit_pages(pages: DataFrame, html: str = "html", *, fit_pages: int = FIT_PAGES, fit_blocks: int = FIT_BLOCKS) -> np.ndarray:
    """Fit on blocks whose elements say what they are, of about ``fit_pages`` pages by hash, and at most ``fit_blocks`` different ones of them."""
    small_batches(pages.sparkSession)
    rows = pages.select(html).where(F.col(html).isNotNull())
    share = min(1.0, fit_pages / max(1, rows.count()))
    rows = rows.where(F.pmod(F.xxhash64(html), F.lit(1_000_003)) < int(share * 1_000_003))
    data = rows.mapInArrow(_labelled, ", ".join(f"{c} double" for c in ["y", *FEATURES]))
    # Equal rows count once, so a page that is copied many times doesn't take over.
    data = data.distinct().orderBy(F.xxhash64(*data.columns), *data.columns).limit(fit_blocks).toPandas().to_numpy(dtype=float)
    return fit(data[:, 1:], data[:, 0]) if len(data) else PRIOR.copy()


def extract(pages: DataFrame, weights: np.ndarray, *, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with text and n_chars."""
    small_batches(pages.sparkSession)
    names = [c for c in pages.columns if c.lower() not in ("text", "n_chars", html.lower())]
    pages = pages.select(*names, html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x, weights) for x in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(texts, pa.string()), pa.array([*map(len, texts)], pa.int64())], [*names, "text", "n_chars"])

    schema = T.StructType([*(pages.schema[c] for c in names), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.mapInArrow(run, schema)
