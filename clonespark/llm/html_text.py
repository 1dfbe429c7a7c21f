"""Main text of web pages by union-free regular expressions inferred for each host.

A page is a stream of tags and text slots. Streams of one host are aligned one after another with the wrapper so far: what both
have stays, a run of elements that repeats becomes a repeated group, and what only one side has becomes an optional group. A
wrapper has no unions. While pages are read, Spark sums for each slot of a host how much text it holds and how much of it in links,
and for each text on how many of the host's pages it stands. From the wrapper and these sums follows which slots hold content
(see content): the article element if the host has one, else the part of the wrapper that holds most of the text, without
menus (slots whose text lies in links), without template text (texts that most pages of the host repeat), and without
elements that are furniture by the HTML standard or by their names, unless the host's text lies in them.

All pages take part, not a sample. A page's stream is first reduced to its skeleton, in which adjacent repeats
collapse: pages of one template share few skeletons, and Spark counts them before anything meets in a task. Names in class, id
and role belong to an element's kind only if several pages of the host have them, so that names made for one page tell nothing.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonespark.llm.common import fits, map_batches, sized
from clonespark.scratch import Scratch

#: Skeletons that are folded in one task before the wrappers made of them are folded.
FOLD = 64
#: Elements nested deeper than this have no part of their own in the wrapper (their text is the last part's), furniture excepted.
MAX_DEPTH = 64
#: Of a repeated group, the elements that it may have at most.
PERIOD = 8
#: Two sequences are aligned by their longest common subsequence up to this product of lengths, beyond it by next occurrences.
TABLE_CELLS = 1_000_000
#: A text is of the template if so many pages of the host have it, and this share of them.
TEMPLATE_PAGES, TEMPLATE_SHARE = 5, 0.8
#: From this share of its characters in links on, an element is a menu.
LINK_SHARE = 0.6
#: The part of the wrapper that has this share of its parent's text goes on holding the content.
MOST = 0.7
#: Names that mark furniture count unless this share of the host's text or less is left without it.
LEAST_LEFT = 0.1
#: A name belongs to an element's kind if so many pages of the host have it, and this share of them.
NAME_PAGES, NAME_SHARE = 2, 0.02
#: Parts that a host's rule is sent in when many pages need it.
SALTS = 16

# Fixed values of the HTML standard: elements without content; elements inside a line of text; elements whose content isn't markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym area b base bdi bdo big cite code data del dfn em embed font i img input ins kbd label link mark meta nobr param q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Elements that are no part of an article.
FURNITURE = frozenset("head nav header footer aside form button select option dialog menu template svg math object audio video canvas datalist fieldset".split())
#: Names (or names of which every piece is here or in PLAIN) that mark a part which is no article text.
MARKED = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner footer colophon sidebar aside rail widget widgets "
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion notice notices cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe subscription signup login search form share sharing social related recommended recommendations trending popular "
    "comment comments commentlist respond reply replies discussion disqus complementary contentinfo skip pagination pager hidden toc".split()
)
PLAIN = frozenset("site main page post entry article content area container wrap wrapper box block list section item inner outer top bottom left right primary secondary global bar col column link links button buttons icon icons text slot unit zone panel side body 0".split())
ARTICLE = ("article", "main")
#: Elements that hold others, among which the part with most of the text is looked for.
CONTAINERS = frozenset("html body div section center table tbody tr td ul ol dl".split())
#: What an open element ends when it begins, as browsers do: an element of the first kind within the same parent.
CLOSES = {
    **dict.fromkeys("p div ul ol dl table section article aside header footer nav main form h1 h2 h3 h4 h5 h6 blockquote pre hr figure address details fieldset".split(), ("p",)),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"),
    "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th", "p"), "tfoot": ("tbody", "tr", "td", "th", "p"),
}
SCOPES = frozenset("html body table td th ul ol dl div article section main aside header footer nav form blockquote".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: An attribute, after white space and slashes: its name and value. A quote that nothing closes belongs to the value.
ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")
USED = frozenset(("id", "class", "role", "hidden", "aria-hidden", "style"))
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[a-z0-9_-]+")
DIGITS = re.compile(r"[0-9]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
CLOSE_RAW = {name: re.compile(f"</{name}(?=[\\s/>]|$)", re.I) for name in RAW}


def _kind(name: str, attrs: dict[str, str]) -> str:
    """An element as the wrapper sees it: its name, ! if it isn't shown, and the names in id, class and role (digits as 0), each after a dot."""
    if not attrs:
        return name
    unseen = "hidden" in attrs or attrs.get("aria-hidden") == "true" or UNSEEN.search(attrs.get("style", ""))
    words = sorted({DIGITS.sub("0", w) for key in ("id", "class", "role") if key in attrs for w in WORD.findall(attrs[key])})
    return ".".join([name + "!" * bool(unseen), *words])


@lru_cache(1 << 14)
def _marked(word: str) -> bool:
    pieces = [p for p in re.split(r"[-_]+", word) if p]
    return any(p in MARKED for p in pieces) and all(p in MARKED or p in PLAIN for p in pieces)


@lru_cache(1 << 14)
def _name(kind: str) -> str:
    return kind.partition(".")[0].rstrip("!")


@lru_cache(1 << 14)
def _furniture(kind: str) -> bool:
    """Whether an element may be furniture, by its own name or those that it has."""
    name, *words = kind.split(".")
    return name.endswith("!") or name in FURNITURE or any(map(_marked, words))


def _tags(page: str) -> Iterator[tuple[str, str, object]]:
    """('#', text, None), ('<', name, attributes) and ('>', name, None) in page order, in one pass over the page.

    Comments, declarations and RAW elements are left out. What is left open runs to the page's end.
    """
    at, n = 0, len(page)
    while at < n:
        i = page.find("<", at)
        if i < 0:
            yield "#", page[at:], None
            return
        if i > at:
            yield "#", page[at:i], None
        if page.startswith("<!--", i):
            end = page.find("-->", i + 2)
            at = n if end < 0 else end + 3
        elif page[i + 1 : i + 2] in ("!", "?"):
            end = page.find(">", i)
            at = n if end < 0 else end + 1
        elif page[i + 1 : i + 2] == "/":
            m = NAME.match(page, i + 2)
            end = page.find(">", i)
            if end < 0:
                return
            at = end + 1
            if m:
                yield ">", m[0].lower(), None
        elif m := NAME.match(page, i + 1):
            name, at, attrs, slash = m[0].lower(), m.end(), {}, False
            while at < n:
                a = ATTRIBUTE.match(page, at)
                if not a:
                    break
                if (key := a[1].lower()) in USED:
                    attrs.setdefault(key, (a[2] or "").strip("\"'").lower())
                at = a.end()
            end = page.find(">", at)
            if end < 0:
                return
            slash = page[end - 1] == "/"
            at = end + 1
            if slash and name not in INLINE and name not in CLOSES and name not in RAW:
                continue
            if name in RAW:
                close = CLOSE_RAW[name].search(page, at)
                end = page.find(">", close.end()) if close else -1
                at = n if end < 0 else end + 1
                continue
            yield "<", name, attrs
        else:
            yield "#", "<", None
            at = i + 1


def tokens(page: str) -> Iterator[tuple[str, str, int]]:
    """('<', kind, 0), ('>', kind, 0) and ('#', text, characters in links): a balanced stream without inline elements and comments.

    Elements that the page leaves open are closed where browsers do, at the latest with their parent. An element in one of its own kind
    is no level of its own, nor is one below MAX_DEPTH others unless it may be furniture.
    """
    open_: list[tuple[str, str | None]] = []  # name, and kind if it is in the stream
    names: Counter[str] = Counter()
    path: list[str] = []
    text: list[str] = []
    linked = links = 0
    muted: list = []  # an inline element that isn't shown: its name, how many of that name are open, elements open where it began

    def flush():
        nonlocal linked
        if text:
            joined = "".join(text)
            text.clear()
            if joined.strip():
                yield "#", joined, linked
        linked = 0

    def close(n: int):
        nonlocal links
        links = 0
        if muted and n < muted[2]:
            muted.clear()
        while len(open_) > n:
            name, kind = open_.pop()
            names[name] -= 1
            if kind is not None:
                path.pop()
                yield ">", kind, 0

    for op, name, attrs in _tags(page):
        if op == "#":
            if muted:
                continue
            text.append(name)
            linked += len(name.strip()) if links else 0
            continue
        if op == ">":
            if name == "a":
                links = max(0, links - 1)
            if muted and muted[0] == name:
                muted[1] -= 1
                if not muted[1]:
                    muted.clear()
            elif names[name]:
                depth = len(open_) - 1
                while open_[depth][0] != name:
                    depth -= 1
                yield from flush()
                yield from close(depth)
            continue
        if name == "br":
            text.append("\n")
            continue
        kind = _kind(name, attrs)
        if name in INLINE:
            links += name == "a"
            if muted:
                muted[1] += name == muted[0]
            elif name not in VOID and "!" in kind.partition(".")[0]:
                muted += [name, 1, len(open_)]
            continue
        yield from flush()
        if name in CLOSES and any(names[x] for x in CLOSES[name]):
            for k in range(len(open_) - 1, -1, -1):
                base = open_[k][0]
                if base in CLOSES[name]:
                    yield from close(k)
                elif base in SCOPES:
                    break
        if name in VOID:
            continue
        last = path[-1] if path else ""
        deep = len(path) >= MAX_DEPTH and (len(path) > MAX_DEPTH or not _furniture(kind))
        shown = None if kind == last or deep else kind
        open_.append((name, shown))
        names[name] += 1
        if shown is not None:
            path.append(kind)
            yield "<", kind, 0
    yield from flush()
    yield from close(0)


def block(value: str) -> str:
    """A block's text: references decoded, white space as one space."""
    return SPACE.sub(" ", html.unescape(value)).strip(" ")


def reduced(kind: str, known: frozenset[str] | None) -> str:
    """A kind without the names that few pages of the host have (known: 'element.name' of the others)."""
    if known is None or "." not in kind:
        return kind
    head, *words = kind.split(".")
    bare = head.rstrip("!")
    return ".".join([head, *(w for w in words if f"{bare}.{w}" in known)])


# Wrappers. A node is (op, kind, children): '#' a text slot, '<' an element, '?' an optional and '+' a repeated group. A repeated group of
# one element has its kind; one of several in a row has no kind.
Node = tuple

SLOT: Node = ("#", "", ())


def tree(stream) -> tuple[Node, ...]:
    """The elements of a stream, each with its children; text becomes slots."""
    stack: list[tuple[str, list]] = [("", [])]
    for op, value, *_ in stream:
        if op == "<":
            stack.append((value, []))
        elif op == ">":
            kind, children = stack.pop()
            stack[-1][1].append(("<", kind, collapse(children)))
        else:
            stack[-1][1].append(SLOT)
    return collapse(stack[0][1])


def _bare(node: Node) -> tuple[str, str]:
    """What nodes must have in common to be aligned: an optional or repeated element goes with a plain one."""
    inner = node[2][0] if node[0] == "?" else node
    return ("#" if inner[0] == "#" else "<", inner[1] or " ".join(_bare(c)[1] for c in inner[2]) if inner[0] == "+" else inner[1])


def _joined(a: Node, b: Node, repeated: bool = False) -> Node:
    """One node for two that can be aligned; repeated: they stand in a row."""
    optional = a[0] == "?" and b[0] == "?" if repeated else a[0] == "?" or b[0] == "?"
    a, b = (x[2][0] if x[0] == "?" else x for x in (a, b))
    op = "+" if a[0] != "#" and (repeated or "+" in (a[0], b[0])) else a[0]
    both = a if a == b and op == a[0] else (op, a[1], align(a[2], b[2]))
    return ("?", "", (both,)) if optional else both


def collapse(nodes) -> tuple[Node, ...]:
    """Adjacent nodes of one kind become one repeated group, whose content is the alignment of theirs; then so do rows of up to PERIOD."""
    out: list[Node] = []
    for node in nodes:
        if out and _bare(node) == _bare(out[-1]):
            out[-1] = _joined(out[-1], node, repeated=True)
        else:
            out.append(node)
    for period in range(2, PERIOD + 1):
        out = _rows(out, period)
    return tuple(out)


def _rows(nodes: list[Node], period: int) -> list[Node]:
    if len(nodes) < 2 * period:
        return nodes
    bare, out, i = [_bare(v) for v in nodes], [], 0
    while i < len(nodes):
        end = i + period
        while end + period <= len(nodes) and bare[end : end + period] == bare[i : i + period]:
            end += period
        if end == i + period:
            out.append(nodes[i])
            i += 1
            continue
        row = tuple(nodes[i : i + period])
        for k in range(i + period, end, period):
            row = tuple(_joined(a, b) for a, b in zip(row, nodes[k : k + period]))
        out.append(("+", "", row))
        i = end
    return out


def align(a: tuple[Node, ...], b: tuple[Node, ...]) -> tuple[Node, ...]:
    """The wrapper of two sequences: what both have in order is joined, what only one has becomes optional."""
    if a == b:
        return a
    x, y = [_bare(v) for v in a], [_bare(v) for v in b]
    out, i, j = [], 0, 0
    for p, q in [*_matches(x, y), (len(x), len(y))]:
        out += [v if v[0] == "?" else ("?", "", (v,)) for v in (*a[i:p], *b[j:q])]
        if p < len(x):
            out.append(_joined(a[p], b[q]))
        i, j = p + 1, q + 1
    return collapse(out)


def _matches(x: list, y: list) -> list[tuple[int, int]]:
    """Places of a common subsequence, the longest unless the sequences are very long."""
    m, n = len(x), len(y)
    if m * n > TABLE_CELLS:
        places: dict = {}
        for j, v in enumerate(y):
            places.setdefault(v, []).append(j)
        out, after = [], {v: iter(p) for v, p in places.items()}
        last = -1
        for i, v in enumerate(x):
            j = next((j for j in after.get(v, ()) if j > last), None)
            if j is not None:
                out.append((i, j))
                last = j
        return out
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m - 1, -1, -1):
        row, below, v = best[i], best[i + 1], x[i]
        for j in range(n - 1, -1, -1):
            row[j] = below[j + 1] + 1 if v == y[j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < m and j < n:
        if x[i] == y[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def write(nodes: tuple[Node, ...]) -> str:
    """A wrapper as text: # slots, kind(...) elements and (...) rows, with + and ? after what is repeated or optional."""
    out = []
    for op, kind, children in nodes:
        if op == "#":
            out.append("#")
        elif op == "?":
            out.append(write(children) + "?")
        else:
            out.append(f"{kind}({write(children)})" + "+" * (op == "+"))
    return " ".join(out)


_PART = re.compile(r"([^\s()?+#]*)\(|(\))(\+?)(\??)|(#)(\??)")


def read(text: str, known: frozenset[str] | None = None) -> tuple[Node, ...]:
    """The wrapper that write() made this text of, its kinds reduced."""
    stack: list[tuple[str, list]] = [("", [])]
    for m in _PART.finditer(text):
        if m[1] is not None:
            stack.append((reduced(m[1], known), []))
            continue
        if m[2]:
            kind, children = stack.pop()
            node, optional = ("+" if m[3] else "<", kind, collapse(children) if known is not None else tuple(children)), m[4]
        else:
            node, optional = SLOT, m[6]
        stack[-1][1].append(("?", "", (node,)) if optional else node)
    return collapse(stack[0][1]) if known is not None else tuple(stack[0][1])


def fold(texts: list[str]) -> str:
    """The wrapper of all skeletons or wrappers given, aligned one after another in a fixed order."""
    out: tuple[Node, ...] | None = None
    for t in sorted(set(texts), key=lambda s: (len(s), s)):
        out = read(t) if out is None else align(out, read(t))
    return write(out or ())


class Page:
    """What a page has: its skeleton, the texts of its slots in order (path, text, characters in links), and the names of its elements."""

    def __init__(self, page: str) -> None:
        path: list[str] = []
        self.slots: list[tuple[str, str, int]] = []
        self.articles: list[int] = []  # of each slot, the number of the outermost article that it is in
        stream, number, within = [], 0, 0
        for op, value, linked in tokens(page):
            if op == "<":
                path.append(value)
                if _name(value) == "article":
                    number, within = number + (not within), within + 1
            elif op == ">":
                within -= _name(path.pop()) == "article"
            else:
                value = block(value)
                if not value:
                    continue
                self.slots.append(("/".join(path), value, min(linked, len(value))))
                self.articles.append(number if within else 0)
            stream.append((op, value))
        self.skeleton = write(tree(stream))
        self.names = {f"{_name(v)}.{w}" for op, v in stream if op == "<" and "." in v for w in v.split(".")[1:]}

    def sums(self) -> dict[str, tuple[int, int]]:
        """Characters of each slot, and those in links."""
        out: dict[str, tuple[int, int]] = {}
        for path, text, linked in self.slots:
            a, b = out.get(path, (0, 0))
            out[path] = (a + len(text), b + linked)
        return out


def reduced_path(path: str, known: frozenset[str] | None) -> str:
    """A slot's path with its kinds reduced; an element in one of its own kind is no level."""
    if known is None or "." not in path:
        return path
    out: list[str] = []
    for kind in path.split("/"):
        kind = reduced(kind, known)
        if not out or out[-1] != kind:
            out.append(kind)
    return "/".join(out)


def outermost(path: tuple[str, ...], name: str) -> tuple[str, ...]:
    """The part of a path that leads to its first element of that name; empty if there is none."""
    return next((path[: k + 1] for k, kind in enumerate(path) if _name(kind) == name), ())


def in_articles(paths: list[tuple[str, ...]], slots: dict[tuple[str, ...], tuple[int, int]]) -> list[tuple[str, ...]]:
    """Of the paths in articles those that may hold content, those of the likeliest articles first.

    Articles in articles are what others say of them (as the HTML standard has it): they go, unless the outer one has no text of its own. Of articles in different places the one with a
    headline comes first, then the one with more text over all pages; a page keeps the first that it has.
    """
    plain = [p for p in paths if sum(_name(k) == "article" for k in p) == 1]
    own = {outermost(p, "article") for p in plain}
    kept = plain + [p for p in paths if p not in set(plain) and outermost(p, "article") not in own]
    text: dict[tuple[str, ...], list[int]] = {}
    for p in kept:
        n, linked = slots[p]
        held = text.setdefault(outermost(p, "article"), [0, 0, 0])
        held[0] |= n > 0 and any(_name(k) in ("h1", "h2") for k in p)
        held[1] += n
        held[2] += linked
    order = sorted(text, key=lambda g: (text[g][2] >= LINK_SHARE * max(text[g][1], 1), -text[g][0], -text[g][1], g))
    return sorted(kept, key=lambda p: (order.index(outermost(p, "article")), p))


def content(wrapper: str, sums: dict[str, tuple[int, int]]) -> tuple[list[str], bool]:
    """Paths of the wrapper's slots that hold content, and whether an article or main element does. In articles, the likeliest come first.

    sums: of each slot's path, characters over all pages of the host and those in links.
    """
    slots: dict[tuple[str, ...], tuple[int, int]] = {}

    def walk(nodes, path: tuple[str, ...]):
        for op, kind, children in nodes:
            if op == "#":
                slots[path] = sums.get("/".join(path), (0, 0))
            else:
                walk(children, (*path, kind) if kind and path[-1:] != (kind,) else path)

    walk(read(wrapper), ())
    slots = {p: v for p, v in slots.items() if not _standard(p)}
    total, held = sum(n for n, _ in slots.values()), _subtrees(slots)
    barred = {t for t in held if t and (any(map(_marked, t[-1].split(".")[1:])) or _name(t[-1]) == "form")}
    barred |= {t for t, (n, linked) in held.items() if t and linked >= LINK_SHARE * max(n, 1) and _name(t[-1]) != "p" and not any(_name(k) in ARTICLE for k in t)}
    while True:
        left = {p: v for p, v in slots.items() if not any(p[: k + 1] in barred for k in range(len(p)))}
        if not barred or not total or sum(n for n, _ in left.values()) > LEAST_LEFT * total:
            break
        outer = [t for t in barred if not any(t[:k] in barred for k in range(len(t)))]
        barred.remove(max(outer, key=lambda t: (held[t], t)))
    article, main = (sum(n for p, (n, _) in left.items() if any(_name(k) == x for k in p)) for x in ARTICLE)
    for name in ARTICLE if article >= main / 2 else ARTICLE[::-1]:
        inside = sorted(p for p in left if any(_name(k) == name for k in p))
        if inside:
            return ["/".join(p) for p in (in_articles(inside, left) if name == "article" else inside)], True
    held, root = _subtrees(left), ()
    headings: set[tuple[str, ...]] = set()
    while True:
        parts = [t for t in held if len(t) == len(root) + 1 and t[: len(root)] == root]
        best = max(parts, key=lambda t: (held[t], t), default=None)
        if best is None or _name(best[-1]) not in CONTAINERS or held[best][0] < MOST * held[root][0]:
            break
        headings |= {p for p in left if p[: len(root)] == root and p[: len(best)] != best and any(_name(k) == "h1" for k in p)}
        root = best
    return sorted("/".join(p) for p in left if p[: len(root)] == root or p in headings), False


def _subtrees(slots: dict) -> dict[tuple[str, ...], tuple[int, int]]:
    """Sums over the slots in each element."""
    out: dict[tuple[str, ...], tuple[int, int]] = {(): (0, 0)}
    for p, (n, linked) in slots.items():
        for k in range(len(p) + 1):
            a, b = out.get(p[:k], (0, 0))
            out[p[:k]] = (a + n, b + linked)
    return out


def _standard(path: tuple[str, ...]) -> bool:
    """Whether a slot lies in an element that isn't shown or is furniture by the standard; an article's own header isn't."""
    article = False
    for kind in path:
        name = _name(kind)
        if "!" in kind.partition(".")[0] or name in FURNITURE and name != "form" and not (article and name == "header"):
            return True
        article = article or name in ARTICLE
    return False


class Rule:
    """What makes up the main text on a host's pages."""

    def __init__(self, paths: list[str], in_article: bool, template: frozenset[int] = frozenset(), known: frozenset[str] | None = None) -> None:
        self.paths, self.in_article, self.template, self.known = paths, in_article, template, known
        places: dict[tuple[str, ...], int] = {}  # articles of one place, in the order of the paths
        self.place = {p: places.setdefault(outermost(tuple(p.split("/")), "article"), len(places)) for p in paths}

    @classmethod
    def of(cls, pages: list[Page]) -> Rule:
        """From all pages of a host, as infer_rules does it."""
        names = Counter(n for p in pages for n in p.names)
        known = frozenset(n for n, c in names.items() if c >= min(len(pages), NAME_PAGES) and c >= NAME_SHARE * len(pages))
        sums: dict[str, tuple[int, int]] = {}
        for p in pages:
            for path, (a, b) in p.sums().items():
                path = reduced_path(path, known)
                x, y = sums.get(path, (0, 0))
                sums[path] = (x + a, y + b)
        texts = Counter(mark for p in pages for mark in {xxhash.xxh64_intdigest(t) >> 1 for _, t, _ in p.slots})
        template = frozenset(m for m, c in texts.items() if c >= TEMPLATE_PAGES and c >= TEMPLATE_SHARE * len(pages))
        return cls(*content(fold([write(read(p.skeleton, known)) for p in pages]), sums), template, known)

    def blocks(self, page: Page) -> list[str]:
        """The page's texts in content slots. In articles, those of the likeliest place that the page has one in, and of several there those with a headline if some have
        one. What the host's template says is left out; in an article no more than half of it, so that pages much alike keep their text, and no headline."""
        found = [(place, text, n) for (path, text, _), n in zip(page.slots, page.articles) if (place := reduced_path(path, self.known)) in self.place]
        if not self.in_article:
            return [t for _, t, _ in found if not self._said_everywhere(t)]
        best = min((self.place[p] for p, _, _ in found), default=0)
        found = [f for f in found if self.place[f[0]] == best]
        titled = {n for p, _, n in found if _headline(p)}
        if titled:
            found = [f for f in found if f[2] in titled]
        said = [self._said_everywhere(t) and not _headline(p) for p, t, _ in found]
        if 2 * sum(len(t) for (_, t, _), x in zip(found, said) if x) > sum(len(t) for _, t, _ in found):
            said = [False] * len(found)
        return [t for (_, t, _), x in zip(found, said) if not x]

    def _said_everywhere(self, text: str) -> bool:
        return bool(self.template) and xxhash.xxh64_intdigest(text) >> 1 in self.template


def _headline(path: str) -> bool:
    return any(_name(k) in ("h1", "h2") for k in path.split("/"))


def main_text(page: str, rule: Rule | None = None) -> str:
    """Texts of the page in content slots of its host's wrapper, one block to a text slot.

    A page that has nothing in them, as where others of the host have an article element and it hasn't, goes by a wrapper of its own, but without the
    host's template texts; so does a page without a rule.
    """
    own = Page(page)
    blocks = rule.blocks(own) if rule else []
    if not blocks and own.slots:
        alone = Rule.of([own])
        blocks = Rule(alone.paths, alone.in_article, rule.template if rule else frozenset(), alone.known).blocks(own)
    return "\n\n".join(blocks)


def host(url: Column) -> Column:
    """The host of a URL in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


FACTS = "host string, what string, key string, mark bigint, page bigint, n bigint, chars bigint, linked bigint"


def _facts(batch: pa.RecordBatch):
    """Of pages: h the page itself, k names, s skeletons, p slots (each summed over the batch), t texts (a mark of each on each page)."""
    sums: dict[tuple, list[int]] = {}
    rows = []
    for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        page = Page(raw)
        digest = xxhash.xxh64_intdigest(raw) >> 1
        rows.append((name, "h", "", 0, digest, 1, 0, 0))
        rows += [(name, "t", "", mark, digest, 1, 0, 0) for mark in {xxhash.xxh64_intdigest(t) >> 1 for _, t, _ in page.slots}]
        own = [("k", k, 0, 0) for k in page.names] + [("s", page.skeleton, 0, 0)] + [("p", path, a, b) for path, (a, b) in page.sums().items()]
        for what, key, a, b in own:
            held = sums.setdefault((name, what, key), [0, 0, 0])
            held[0] += 1
            held[1] += a
            held[2] += b
    rows += [(name, what, key, 0, 0, *v) for (name, what, key), v in sums.items()]
    return list(zip(*rows))


def _folded(group: DataFrame, scratch: Scratch) -> DataFrame:
    """host and wrapper of all its skeletons (host, wrapper, distinct): FOLD at most meet in a task, until each host has one."""
    while True:
        counts = group.groupBy("host").agg(F.count("*").alias("_n"))
        most = counts.agg(F.max("_n")).first()[0] or 0
        if most <= FOLD:
            return scratch.save(group.groupBy("host").applyInPandas(_fold_group, "host string, wrapper string"))
        parts = group.join(sized(counts, scratch), "host").withColumn("_part", F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("_n") * 2 / FOLD)))
        group = scratch.save(parts.select("host", "_part", "wrapper").groupBy("host", "_part").applyInPandas(_fold_group, "host string, wrapper string").distinct())


def _fold_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": [key[0]], "wrapper": [fold(group["wrapper"].tolist())]})


def infer_rules(pages: DataFrame, scratch: Scratch, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, wrapper, paths, in_article, template and known (see Rule), from all pages."""
    rows = pages.select(host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    found = map_batches(rows, _facts, FACTS).groupBy("host", "what", "key", "mark")
    facts = found.agg(F.sum("n").alias("n"), F.count_distinct("page").alias("pages"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    # Texts of few pages and names of one are dropped here; whether they are many for the host follows below.
    facts = scratch.save(facts.filter((F.col("what") != "t") | (F.col("pages") >= TEMPLATE_PAGES)))
    hosts = scratch.save(facts.filter("what = 'h'").select("host", F.col("n").alias("all"), F.col("pages").alias("all_pages")))
    of_host = facts.join(sized(hosts, scratch), "host")
    names = of_host.filter("what = 'k'").filter((F.col("n") >= F.least(F.col("all"), F.lit(NAME_PAGES))) & (F.col("n") >= NAME_SHARE * F.col("all")))
    texts = of_host.filter("what = 't'").filter(F.col("pages") >= TEMPLATE_SHARE * F.col("all_pages"))
    known = hosts.select("host").join(names.groupBy("host").agg(F.sort_array(F.collect_set("key")).alias("known")), "host", "left")
    known = scratch.save(known.join(texts.groupBy("host").agg(F.collect_set("mark").alias("template")), "host", "left"))

    def reduce(batch: pa.RecordBatch):
        out, seen = [], {}
        for name, what, key, names in zip(*(c.to_pylist() for c in batch.columns[:4])):
            if name not in seen:
                seen[name] = frozenset(names or ())
            out.append(write(read(key, seen[name])) if what == "s" else reduced_path(key, seen[name]))
        return batch.column(0), batch.column(1), out, batch.column(4), batch.column(5)

    shapes = facts.filter("what IN ('s', 'p')").join(sized(known, scratch), "host").select("host", "what", "key", "known", "chars", "linked")
    shapes = map_batches(shapes, reduce, "host string, what string, key string, chars bigint, linked bigint")
    shapes = scratch.save(shapes.groupBy("host", "what", "key").agg(F.sum("chars").alias("chars"), F.sum("linked").alias("linked")))
    wrappers = _folded(shapes.filter("what = 's'").select("host", F.col("key").alias("wrapper")), scratch)
    sums = shapes.filter("what = 'p'").groupBy("host").agg(F.collect_list(F.struct("key", "chars", "linked")).alias("sums"))

    def decide(batch: pa.RecordBatch):
        paths, flags = [], []
        for wrapper, sums in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            found, flag = content(wrapper, {s["key"]: (s["chars"], s["linked"]) for s in sums or ()})
            paths.append(found)
            flags.append(flag)
        return batch.column(0), batch.column(1), paths, flags

    decided = map_batches(wrappers.join(sums, "host", "left").select("host", "wrapper", "sums"), decide, "host string, wrapper string, paths array<string>, in_article boolean")
    return decided.join(known, "host")


@lru_cache(256)
def _rule(text: str) -> Rule:
    said = json.loads(text)
    return Rule(said["paths"], said["in_article"], frozenset(said["template"]), frozenset(said["known"]))


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page.

    Returns id_col, url, text and n_chars (its code points). Blocks come in page order, joined by an empty line; character references
    are decoded, white space within a block is one space. A null or empty page has an empty text. Pages with a null
    url, or one without a host, share a wrapper. Null and repeated ids are extracted row by row; other columns are ignored; an
    empty table gives an empty result. A page is read in one pass, however long or broken.
    """
    scratch = Scratch(pages.sparkSession)
    rules = infer_rules(pages, scratch, url_col=url_col, html_col=html_col)
    none = F.array().cast("array<string>")
    said = F.to_json(F.struct("paths", "in_article", F.coalesce("template", F.array().cast("array<bigint>")).alias("template"), F.coalesce("known", none).alias("known")))
    rules = scratch.save(rules.select("host", said.alias("said")))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.coalesce(F.col(html_col), F.lit("")).alias("_html"), host(F.col(url_col)).alias("host"))
    if fits(rules):
        both = rows.join(F.broadcast(rules), "host")
    else:  # too many hosts to send to every task: the pages of one go to SALTS tasks
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_url", "_html"), F.lit(SALTS)))
        both = rows.join(rules.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))), ["host", "_salt"])
    both = both.select("_id", "_url", "_html", "said")

    def run(batch: pa.RecordBatch):
        texts = [main_text(p, _rule(s)) for p, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        return batch.column(0), batch.column(1), texts, [len(t) for t in texts]

    return map_batches(both, run, f"`{id_col}` {pages.schema[id_col].dataType.simpleString()}, url string, text string, n_chars bigint")
