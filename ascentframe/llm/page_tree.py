"""A small tolerant page parser: elements with keys, and the collapsed trees that wrapper induction aligns."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import xxhash

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr".split()
)
#: Elements that a start tag closes first, by tag; and those that an inline end tag does not reach through.
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("html body article section main div td th table ul ol dl footer header nav aside form blockquote".split())
#: Deeper elements are put beside each other, which bounds recursion on broken pages.
_DEPTH = 150


class Element:
    __slots__ = ("tag", "key", "items")

    def __init__(self, tag: str, key: str):
        self.tag, self.key, self.items = tag, key, []


def _key(tag: str, attributes: str) -> str:
    if not attributes or "=" not in attributes:
        return tag
    names = {w.lower() for m in _NAMES.finditer(attributes) for w in re.split(r"[^a-zA-Z]+", m[1] or m[2] or m[3] or "") if w}
    return ".".join([tag, *sorted(names)])


def parse(html: str | None) -> Element:
    """Element tree of a whole page; unclosed and stray tags do no harm. Texts are decoded, scripts and styles empty."""
    root = Element("#page", "#page")
    stack, place, html = [root], 0, html or ""
    while token := _TOKEN.search(html, place):
        if token.start() > place:
            stack[-1].items.append(unescape(html[place : token.start()]))
        place = token.end()
        if not (name := token[2]):
            continue
        tag = name.lower()
        if token[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if tag in INLINE and stack[depth].tag in _SCOPES:
                    break
            continue
        closed = _CLOSED_BY.get(tag) or (None if tag in INLINE or tag in _VOID else {"p"})
        if closed:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in closed:
                    del stack[depth:]
                    if tag != "tr":
                        break
                    continue
                if stack[depth].tag in _SCOPES and not (tag == "tr" and stack[depth].tag in ("td", "th")):
                    break
        element = Element(tag, _key(tag, token[3]))
        stack[-1].items.append(element)
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, place)
            inner = html[place : end.start() if end else len(html)]
            if tag in ("textarea", "title"):
                element.items.append(unescape(inner))
            place = end.end() if end else len(html)
        elif tag not in _VOID and not token[3].endswith("/") or tag not in _VOID and tag in _SCOPES:
            if len(stack) < _DEPTH:
                stack.append(element)
    if place < len(html):
        stack[-1].items.append(unescape(html[place:]))
    return root


class Shape:
    """Node of a page's tree. Structural siblings stay apart, whatever their keys; text blocks that follow each other are one
    node of flowing text. `varies` tells whether different pages have different text there."""

    __slots__ = ("key", "chars", "hash", "pages", "varies", "children", "into")

    def __init__(self, key: str, chars: int = 0, hash: int = 0, pages: int = 1, varies: bool = False):
        self.key, self.chars, self.hash, self.pages, self.varies = key, chars, hash, pages, varies
        self.children: list[Shape] = []
        self.into: Shape | None = None

    def kept(self) -> Shape:
        """The node that this one was added to, if it was one of a list."""
        node = self
        while node.into is not None:
            node = node.into
        return node

    def walk(self) -> Iterator[Shape]:
        yield self
        for child in self.children:
            yield from child.walk()


def matching(a: Shape, b: Shape, memory: dict) -> int:
    """Simple tree matching: nodes in the largest mapping that keeps order, ancestry and keys."""
    if a.key != b.key:
        return 0
    if (known := memory.get((id(a), id(b)))) is not None:
        return known
    if len(a.children) * len(b.children) > CELLS:
        for _, row, _ in _rows(a.children, b.children, _weights(a.children, b.children)):
            most = int(row[-1])
    else:
        most = _table(a.children, b.children, memory)[-1][-1]
    memory[id(a), id(b)] = result = 1 + most
    return result


def _table(left: list[Shape], right: list[Shape], memory: dict) -> list[list[int]]:
    table = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, x in enumerate(left, 1):
        for j, y in enumerate(right, 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + (matching(x, y, memory) if x.key == y.key else 0))
    return table


def _beside(left: list[Shape], right: list[Shape]) -> list[tuple[Shape | None, Shape | None]]:
    """Both lists of children in one order: matched ones in pairs, others alone, whatever their length."""
    if [x.key for x in left] == [x.key for x in right] and len({x.key for x in left}) == len(left):
        return list(zip(left, right))
    if len(left) * len(right) > CELLS:
        return _from_the_front(left, right)
    memory: dict = {}
    table = _table(left, right, memory)
    i, j, out = len(left), len(right), []
    while i or j:
        x, y = left[i - 1] if i else None, right[j - 1] if j else None
        if x and y and x.key == y.key and table[i][j] == table[i - 1][j - 1] + matching(x, y, memory):
            out.append((x, y))
            i, j = i - 1, j - 1
        elif y and (not x or table[i][j] == table[i][j - 1]):
            out.append((None, y))
            j -= 1
        else:
            out.append((x, None))
            i -= 1
    return out[::-1]


#: Child lists whose table would be larger are matched by rows of it; so many weights of theirs are remembered at most.
CELLS, WEIGHTS = 1 << 14, 1 << 22


def _weights(left: list[Shape], right: list[Shape]) -> Callable[[int], np.ndarray]:
    """What each of `right` is matched with the i-th of `left` by: equal trees count once, and no more than WEIGHTS are held."""
    kinds: dict[str, int] = {}
    lefts, rights = ([kinds.setdefault(written(x), len(kinds)) for x in side] for side in (left, right))
    firsts = {kind: y for kind, y in zip(reversed(rights), reversed(right))}
    place, distinct = {kind: k for k, kind in enumerate(firsts)}, list(firsts.values())
    at = np.array([place[kind] for kind in rights])
    known: dict[int, np.ndarray] = {}

    def row(i: int) -> np.ndarray:
        if (found := known.get(lefts[i])) is None:
            found = np.array([matching(left[i], y, {}) for y in distinct], np.int32)
            if (len(known) + 1) * len(distinct) <= WEIGHTS:
                known[lefts[i]] = found
        return found[at]

    return row


def _rows(left: list[Shape], right: list[Shape], weights: Callable[[int], np.ndarray], row: np.ndarray | None = None,
          first: int = 0, last: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """Rows `first` to `last` of the table, one after the other, from the row `first`; each with its number and weights."""
    row = np.zeros(len(right) + 1, np.int32) if row is None else row
    yield first, row, None
    for i in range(first, len(left) if last is None else last):
        weight = weights(i)
        row = np.concatenate([row[:1], np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weight))])
        yield i + 1, row, weight


def _from_the_front(left: list[Shape], right: list[Shape]) -> list[tuple[Shape | None, Shape | None]]:
    """The order that the whole table gives, for long lists: its rows are worked out from the front and every so many-th is
    kept; on the way back the rows between are worked out again. Memory grows with the root of a list times the other."""
    weights, step = _weights(left, right), math.isqrt(len(left)) + 1
    kept = {i: row for i, row, _ in _rows(left, right, weights) if i % step == 0}
    i, j, out = len(left), len(right), []
    while i:
        start = (i - 1) // step * step
        _, rows, marks = zip(*_rows(left, right, weights, kept[start], start, i))
        while i > start:
            x, y = left[i - 1], right[j - 1] if j else None
            here, above, weight = rows[i - start], rows[i - start - 1], marks[i - start]
            if y and x.key == y.key and here[j] == above[j - 1] + weight[j - 1]:
                out.append((x, y))
                i, j = i - 1, j - 1
            elif y and here[j] == here[j - 1]:
                out.append((None, y))
                j -= 1
            else:
                out.append((x, None))
                i -= 1
    return [(None, y) for y in right[:j]] + out[::-1]


def align(a: Shape, b: Shape) -> Shape:
    """Joins b into a (equal keys): matched children are joined, others stand between them in order."""
    a.chars += b.chars
    a.pages += b.pages
    a.varies = a.varies or b.varies or a.hash != b.hash
    a.children = [align(x, y) if x and y else x or y for x, y in _beside(a.children, b.children)]
    return a


def mapped(wrapper: Shape, page: Shape) -> dict[int, Shape]:
    """The wrapper's node for each node of the page (by id) that simple tree matching maps."""
    found, stack = {}, [(wrapper, page)] if wrapper.key == page.key else []
    while stack:
        x, y = stack.pop()
        found[id(y)] = x
        stack += [(u, v) for u, v in _beside(x.children, y.children) if u and v]
    return found


#: Blocks that make up flowing text; a run of them, with all that is in them, is one node.
FLOW_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl li dt dd blockquote pre hr figure figcaption address details summary".split())
FLOW = "#flow"
#: Tags with a meaning of their own.
TAGS = INLINE | FLOW_TAGS | _SCOPES | _VOID | _RAW | frozenset(
    "#page head tr thead tbody tfoot caption colgroup center font picture video audio canvas svg map form".split()
)
#: So many structural siblings of one shape that follow each other are a list, which is one node too.
RUN = 8


def text_in(element: Element, whole: bool = False) -> str:
    """Own text of an element, inline elements included; `whole`: of all elements inside."""
    parts: list[str] = []
    stack = element.items[::-1]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            parts.append(item)
        elif item.tag in INLINE:
            stack += item.items[::-1]
        else:
            parts.append(" ")
            if whole:
                stack += [" ", *item.items[::-1]]
    return " ".join("".join(parts).split())


def _blocks_in(element: Element) -> Iterator[Element]:
    """Elements below `element` with only inline elements between."""
    for item in element.items:
        if not isinstance(item, str):
            if item.tag in INLINE:
                yield from _blocks_in(item)
            else:
                yield item


def collapse(element: Element, of: dict[int, Shape] | None = None) -> Shape:
    """The tree of an element; each node knows its own text by length and hash. `of` is filled with the node of each
    structural or flowing element, by id."""
    own = text_in(element)
    shape = Shape(element.key, len(own), xxhash.xxh64_intdigest(own) >> 1 if own else 0)
    if of is not None:
        of[id(element)] = shape
    runs: list[list] = []
    for child in _blocks_in(element):
        if child.tag in FLOW_TAGS:
            if not (shape.children and shape.children[-1].key == FLOW):
                shape.children.append(Shape(FLOW))
            flow, text = shape.children[-1], text_in(child, True)
            flow.chars += len(text)
            flow.hash = xxhash.xxh64_intdigest(f"{flow.hash},{text}") >> 1 if text else flow.hash
            if of is not None:
                of[id(child)] = flow
            continue
        node = collapse(child, of)
        signature = written(node)
        if shape.children and runs and runs[-1][0] == signature and runs[-1][1][-1] is shape.children[-1]:
            runs[-1][1].append(node)
        else:
            runs.append([signature, [node]])
        shape.children.append(node)
    for _, nodes in runs:
        if len(nodes) >= RUN:
            first = nodes[0]
            for other in nodes[1:]:
                _one_page(first, other)
            gone = {id(x) for x in nodes[1:]}
            shape.children = [x for x in shape.children if id(x) not in gone]
    return shape


def _one_page(a: Shape, b: Shape) -> None:
    """Adds a node of the same shape that stands on the same page."""
    for x, y in list(zip(a.walk(), b.walk())):
        x.chars += y.chars
        x.hash = xxhash.xxh64_intdigest(f"{x.hash},{y.hash}") >> 1
        y.into = x


def written(shape: Shape) -> str:
    return f"{shape.key}({','.join(map(written, shape.children))})" if shape.children else shape.key


def rebuilt(text: str) -> Shape:
    """The tree that `written` gave, without its figures."""
    root = Shape("")
    stack = [root]
    for key, mark in re.findall(r"([^(),]*)([(),]|$)", text):
        if key:
            stack[-1].children.append(Shape(key))
        if mark == "(":
            stack.append(stack[-1].children[-1])
        elif mark == ")":
            stack.pop()
    return root.children[0]
