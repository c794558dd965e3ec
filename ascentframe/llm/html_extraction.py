"""HTML extraction by wrapper induction (operator 7).

Pages of one host are aligned: each page becomes an element tree whose structural siblings stay apart, and trees are joined
by simple tree matching. Every node of the joined tree knows whether its text is the same on all different pages or varies.
Constant nodes weigh nothing; the content slot is the node that holds the varying text of the host. A block in it is
template if the same text stands at the same path on a large share of the host's different pages. Every page is then
matched with the joined tree of its host, and what lies in its slot is read.

Lists of tags and names speak where alignment cannot: on hosts without two different pages, and against parts whose names
say nothing but menu, advert, form or comment.

Spark first adds up pages of equal shape, so a host sends a row for each shape and node, however many pages it has. Trees
of a host are joined in as many rounds as its number of shapes needs, a bounded number of trees in a task. A joined tree
keeps all nodes. Names that differ from page to page do not make it endless: an element goes by its common names only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from ascentframe.llm.common import cut, sized, small_batches
from ascentframe.llm.page_tree import FLOW, INLINE, TAGS, Element, Shape, align, collapse, mapped, parse, rebuilt, text_in, written
from ascentframe.llm.url_filters import host_of

#: Elements and class, id or role words that are never content (words only where no word of the content stands beside them).
SKIPPED_TAGS = frozenset(
    "head script style noscript template nav aside footer form button select option input textarea iframe object svg canvas"
    " dialog menu title".split()
)
SKIPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation"
    " breadcrumb breadcrumbs sidebar footer cookie cookies consent notice notices alert popup modal newsletter subscribe"
    " subscription signup login share sharing social related recommended comment comments commentlist disqus reply replies"
    " respond pagination pager toolbar masthead skip".split()
)
#: Words that name the content where a page has neither article nor main.
CONTENT_WORDS = frozenset("article content post entry story main body text".split())
#: A text is template if it stands on so many different pages, and on such a share of all different pages of the host.
CONSTANT_PAGES = 5
CONSTANT_SHARE = 0.5
#: A part named as content must hold so much of the varying text to be taken for the slot.
NAMED_SHARE = 0.1
#: Names with a meaning of their own; any other name (class, id or role word, or unknown tag) tells elements apart only if
#: it stands on such a share of the host's different pages.
KNOWN_NAMES = TAGS | SKIPPED_TAGS | SKIPPED_WORDS | CONTENT_WORDS
NAME_SHARE = 1 / 64
#: Trees that a task joins, shapes and keys that a worker remembers; wrappers are sent to every task up to so many bytes.
FOLD, REMEMBERED = 64, 20_000
BROADCAST_BYTES = 32_000_000
_SHAPES = "host string, shape string, slot int, hash long, chars long"
_BLOCKS = "host string, blocks array<long>, names array<string>"
_TREES = "host string, place long, tree string"
_WRAPPERS = "host string, tree string"


def skipped(key: str, inside: bool) -> bool:
    """Whether an element of this key is no content; page headers are skipped outside the article only."""
    tag, *words = key.split(".")
    if tag in SKIPPED_TAGS or (tag == "header" and not inside):
        return True
    return tag not in ("html", "body", "main") and not SKIPPED_WORDS.isdisjoint(words) and CONTENT_WORDS.isdisjoint(words)


def slot_of(tree: Shape, varying: bool) -> set[int]:
    """Ids of the nodes that hold the content: of all text, or of what varies between pages.

    An article, else main part, else part named as content that holds a fair share of the weight is taken, the heaviest of
    its kind. Without one the slot is reached from the top, always into the child that holds most of the weight.
    """

    def weight(node: Shape, inside: bool = False) -> int:
        if skipped(node.key, inside):
            return 0
        return (node.chars if node.varies or not varying else 0) + sum(weight(c, inside) for c in node.children)

    whole = weight(tree)
    named: list[tuple[int, int, int, Shape, Shape]] = []

    def look(node: Shape, parent: Shape, depth: int) -> None:
        if skipped(node.key, False):
            return
        tag, *words = node.key.split(".")
        rank = 3 if tag == "article" else 2 if tag == "main" or (tag == "div" and "main" in words) else 1 if tag in ("div", "section", "td") and not CONTENT_WORDS.isdisjoint(words) else 0
        if rank and (own := weight(node, True)) and own >= NAMED_SHARE * whole:
            named.append((rank, own, -depth, node, parent))
        for child in node.children:
            look(child, node, depth + 1)

    look(tree, tree, 0)
    if named:
        rank, _, _, node, parent = max(named, key=lambda x: x[:3])
        return {id(x) for x in parent.children if x.key == node.key and rank == 3} | {id(node)}
    node = tree
    while node.children:
        heaviest = max(node.children, key=weight)
        if 2 * weight(heaviest) <= whole or heaviest.key == FLOW:
            break
        node = heaviest
    return {id(node)}


def _block(element: Element, path: str) -> int | None:
    """Number of a block's own text (inline elements included) at its path; None without text."""
    text = text_in(element)
    return xxhash.xxh64_intdigest(f"{path}\n{text}") >> 1 if text else None


def blocks_of(root: Element) -> list[int]:
    """Numbers of all blocks of a page that may be content, each once, in ascending order; copies of a page have the same."""
    found = set()
    stack = [(root, "")]
    while stack:
        element, path = stack.pop()
        if skipped(element.key, True):
            continue
        path = f"{path}/{element.key}"
        if element.tag not in INLINE:
            found.add(_block(element, path))
        stack += [(x, path) for x in element.items if not isinstance(x, str)]
    return sorted(found - {None})


def prune(root: Element, fixed: frozenset) -> Element:
    """`root` without the texts of the blocks in `fixed`."""
    stack = [(root, "", True)] if fixed else []
    while stack:
        element, path, keep = stack.pop()
        path = f"{path}/{element.key}"
        if element.tag not in INLINE:
            keep = _block(element, path) not in fixed
        stack += [(x, path, keep) for x in element.items if not isinstance(x, str)]
        if not keep:
            element.items = [" " if isinstance(x, str) else x for x in element.items]
    return root


def names_of(root: Element) -> list[str]:
    """Names on a page that have no meaning of their own, each once, in ascending order."""
    keys, stack = set(), [root]
    while stack:
        element = stack.pop()
        keys.add(element.key)
        stack += [x for x in element.items if not isinstance(x, str)]
    return sorted({name for key in keys for name in key.split(".")} - KNOWN_NAMES)


class Names:
    """The common names of a host (JSON; None: all names are)."""

    def __init__(self, text: str | None):
        self.common = None if text is None else KNOWN_NAMES | set(json.loads(text))
        self.keys: dict[str, str] = {}

    def _plain(self, key: str) -> str:
        if (known := self.keys.get(key)) is None:
            if len(self.keys) >= REMEMBERED:
                self.keys.clear()
            tag, *words = key.split(".")
            self.keys[key] = known = ".".join([tag if tag in self.common else OTHER, *(w for w in words if w in self.common)])
        return known

    def plain(self, root: Element) -> Element:
        """`root` with all elements going by their common names."""
        stack = [root] if self.common is not None else []
        while stack:
            element = stack.pop()
            element.key = self._plain(element.key)
            stack += [x for x in element.items if not isinstance(x, str)]
        return root


OTHER = "#other"


class Wrapper:
    """A host's joined tree with its slot, the numbers of its template blocks, its common names, and what was matched with
    it before."""

    def __init__(self, text: str):
        data = json.loads(text)
        self.fixed = frozenset(data["fixed"])
        self.names = _names(data.get("names"))
        self.slot: set[int] = set()
        self.tree = self._loaded(data["tree"])
        self.known: dict[str, list[int]] = {}

    def _loaded(self, data: list) -> Shape:
        node = Shape(data[0])
        if data[1]:
            self.slot.add(id(node))
        node.children = [self._loaded(x) for x in data[2]]
        return node

    def slot_in(self, page: Shape) -> set[int]:
        """Ids of the page's nodes that simple tree matching maps to the slot."""
        shape, nodes = written(page), list(page.walk())
        if shape not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            of = mapped(self.tree, page)
            self.known[shape] = [k for k, x in enumerate(nodes) if id(x) in of and id(of[id(x)]) in self.slot]
        return {id(nodes[k]) for k in self.known[shape]}


@lru_cache(256)
def _names(text: str | None) -> Names:
    return Names(text)


@lru_cache(256)
def _wrapper(text: str) -> Wrapper:
    return Wrapper(text)


def text_of(html: str | None, wrapper: Wrapper | None) -> str:
    """Main text of one page through its host's wrapper; a page without that slot is read by its own shape."""
    root = prune(parse(html), wrapper.fixed if wrapper else frozenset())
    root = wrapper.names.plain(root) if wrapper else root
    of: dict[int, Shape] = {}
    tree = collapse(root, of)
    slot = wrapper.slot_in(tree) if wrapper else set()
    out: list[str] = []
    stack: list = [(root, False)]
    slot = slot or slot_of(tree, False)
    while stack:
        item, inside = stack.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        if not inside:
            inside = id(item) in of and id(of[id(item)].kept()) in slot
        elif skipped(item.key, True):
            out.append(" ")
            continue
        if inside and item.tag not in INLINE:
            out.append(" ")
            stack.append((" ", True))
        stack += [(x, inside) for x in reversed(item.items) if inside or not isinstance(x, str)]
    return " ".join("".join(out).split())


def _shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        known = {x: frozenset(json.loads(x)) for x in set(batch["fixed"].dropna())}
        for host, html, fixed, names in zip(batch["host"], batch["html"], batch["fixed"], batch["names"]):
            tree = collapse(_names(names).plain(prune(parse(html), known.get(fixed, frozenset()))))
            shape = written(tree)
            rows += [(host, shape, k, n.hash, n.chars) for k, n in enumerate(tree.walk())]
        yield pd.DataFrame(rows, columns=["host", "shape", "slot", "hash", "chars"])


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pages = [parse(x) for x in batch["html"]]
        yield pd.DataFrame({"host": batch["host"], "blocks": list(map(blocks_of, pages)), "names": list(map(names_of, pages))})


def _dumped(tree: Shape) -> list:
    return [tree.key, tree.chars, tree.hash, tree.pages, tree.varies, [_dumped(c) for c in tree.children]]


def _loaded(data: list) -> Shape:
    tree = Shape(*data[:5])
    tree.children = [_loaded(c) for c in data[5]]
    return tree


def thinned(tree: Shape, most: int) -> Shape:
    """`tree` without its rarest parts if it has more than `most` nodes, for looking at large trees. No text is extracted
    through such a tree."""
    share = 1 / 512
    while sum(1 for _ in tree.walk()) > most and share <= 0.5:
        for node in tree.walk():
            node.children = [c for c in node.children if c.pages >= share * tree.pages]
        share *= 2
    return tree


def _joined(trees: Iterator[Shape]) -> Shape:
    result = next(trees)
    for tree in trees:
        result = align(result, tree)
    return result


def _of_shape(shape: str, slots: list) -> Shape:
    tree = rebuilt(shape)
    for node, one in zip(tree.walk(), sorted(slots, key=lambda x: x["slot"])):
        node.chars, node.hash, node.pages, node.varies = one["chars"], one["low"], one["pages"], one["low"] != one["high"]
    return tree


def _folded(group: pd.DataFrame, trees: Iterator[Shape]) -> pd.DataFrame:
    tree = json.dumps(_dumped(_joined(trees)))
    return pd.DataFrame({"host": [group["host"].iloc[0]], "place": [xxhash.xxh64_intdigest(tree) >> 1], "tree": [tree]})


def _fold_shapes(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("shape")
    return _folded(group, (_of_shape(s, list(x)) for s, x in zip(group["shape"], group["slots"])))


def _fold_trees(group: pd.DataFrame) -> pd.DataFrame:
    return _folded(group, (_loaded(json.loads(x)) for x in sorted(group["tree"])))


def _dealt(rows: DataFrame) -> tuple[DataFrame, int]:
    """`rows` (host, place, ...) with a column that deals each host's rows into groups of FOLD on average; the most rows of
    a host."""
    counts = cut(rows.groupBy("host").agg(F.count(F.lit(1)).alias("rows")))
    hosts, most = counts.agg(F.count(F.lit(1)), F.max("rows")).first()
    joined = rows.join(sized(counts.withColumnRenamed("host", "same"), hosts), F.col("host").eqNullSafe(F.col("same")))
    deal = F.pmod("place", F.ceil(F.col("rows") / FOLD))
    return joined.withColumn("deal", deal).drop("same", "rows"), most or 0


def joined_trees(shapes: DataFrame) -> DataFrame:
    """(host, place, tree): one joined tree for each host, from its shapes (host, shape, slots)."""
    dealt, most = _dealt(cut(shapes.withColumn("place", F.xxhash64("shape"))))
    trees = dealt.groupBy("host", "deal").applyInPandas(_fold_shapes, _TREES)
    while most > 1:
        trees = cut(trees)
        dealt, most = _dealt(trees)
        if most > 1:
            trees = dealt.groupBy("host", "deal").applyInPandas(_fold_trees, _TREES)
    return trees


def _wrapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The joined trees with the slot marked in them, as JSON: key, whether it is the slot, children."""
    for batch in batches:
        out = []
        for text in batch["tree"]:
            tree = _loaded(json.loads(text))
            slot = slot_of(tree, any(n.varies and n.chars for n in tree.walk()))
            marked = lambda n: [n.key, id(n) in slot, [marked(c) for c in n.children]]
            out.append(json.dumps(marked(tree)))
        yield pd.DataFrame({"host": batch["host"], "tree": out})


def common(pages: DataFrame) -> DataFrame:
    """(host, fixed and names as JSON) of each host of `pages` (host, html): numbers of the blocks that are template there,
    and the names that are common there.

    Equal pages count once. A page has few blocks and names, so on average at most 1 / CONSTANT_SHARE times as many blocks
    can be template, and 1 / NAME_SHARE times as many names common.
    """
    own = cut(pages.mapInPandas(_blocks, _BLOCKS).distinct())

    def shared(column: str, share: float, least: int) -> DataFrame:
        different = own.select("host", column).distinct() if column == "blocks" else own
        counts = different.select("host", F.explode(column).alias("one")).groupBy("host", "one").agg(F.count(F.lit(1)).alias("on"))
        hosts = different.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
        often = counts.where(F.col("on") >= least).join(hosts, "host").where(F.col("on") >= share * F.col("pages"))
        return often.groupBy("host").agg(F.sort_array(F.collect_list("one")).alias(column))

    blocks, names = shared("blocks", CONSTANT_SHARE, CONSTANT_PAGES), shared("names", NAME_SHARE, 1)
    listed = own.select("host").distinct().join(blocks, "host", "left").join(names, "host", "left")
    return listed.select("host", F.to_json("blocks").alias("fixed"), F.coalesce(F.to_json("names"), F.lit("[]")).alias("names"))


def _side(frame: DataFrame) -> DataFrame:
    """A side of texts for each host, stored, with a broadcast hint if its counted size allows it."""
    frame = cut(frame)
    size = frame.agg(F.sum(F.length(F.concat_ws("", *frame.columns)) + 64)).first()[0] or 0
    return F.broadcast(frame) if size <= BROADCAST_BYTES else frame


def induce(pages: DataFrame, host: Column) -> DataFrame:
    """(host, wrapper as JSON) of every host of `pages` (html). Template and constant nodes weigh nothing where the content
    slot is chosen."""
    own = pages.select(host.alias("host"), "html")
    known = _side(common(own))
    nodes = own.join(known, "host", "left").mapInPandas(_shapes, _SHAPES)
    summed = nodes.groupBy("host", "shape", "slot").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("chars").alias("chars"),
        F.min("hash").alias("low"),
        F.max("hash").alias("high"),
    )
    shapes = summed.groupBy("host", "shape").agg(
        F.collect_list(F.struct("slot", "pages", "chars", "low", "high")).alias("slots"),
    )
    trees = joined_trees(shapes).select("host", "tree").mapInPandas(_wrapped, _WRAPPERS)
    names = F.to_json(F.struct(F.col("names").alias("names")))  # a text in the text
    wrapper = F.format_string('{"tree": %s, "fixed": %s, %s', "tree", F.coalesce("fixed", F.lit("[]")), F.substr(names, F.lit(2)))
    return trees.join(known, "host", "left").select("host", wrapper.alias("wrapper"))


def _reader(htmls: pd.Series, wrappers: pd.Series) -> pd.Series:
    known = {w: _wrapper(w) for w in set(wrappers.dropna())}
    return pd.Series([text_of(h, known.get(w)) for h, w in zip(htmls, wrappers)], dtype=object)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of `pages`.

    NULL and empty pages have an empty text. Pages without a host in their url form one group. Repeated rows come out
    repeatedly; copies of one page do not make its text a template, since equal pages count once.
    """
    small_batches(pages.sparkSession)  # each row carries its host's wrapper
    side = _side(induce(pages, host_of(F.col("url"))))
    joined = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(side, "host", "left")
    text = pandas_udf(_reader, StringType())("html", "wrapper")
    return joined.select("page_id", "url", text.alias("text")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
