"""Ranked lexical search with geometric blocks in every posting list (operator 13).

Documents are dealt out over tasks as narrow term vectors, a shard at a time. A shard's index has a posting list for each
term; the documents of a list are clustered by similarity (cosine of random projections, nearest of evenly picked
members), and each cluster is a block. A block's summary is the coordinatewise maximum of its documents' term values, over
the terms that are asked together with the list's term. A query bounds all blocks of its terms' lists by their summaries
and takes them in falling order; a block is skipped only if its exact bound is below the score of the last of the best
documents found so far, so results are exact. The best documents of a task are carried from shard to shard.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ascentframe.llm.common import cut, ragged

TOP = 20
#: Saturation, length share (both of 100 and 1000), and scale of a term's value in a document.
SCALE, PER_TF, PER_LENGTH, LENGTH_SHARE = 1_000_000_000, 1000, 12, 25
#: Items that are searched in one pass over the documents: so many characters and so many items at most.
BLOCK_CHARS, BLOCK_ITEMS = 1 << 22, 20_000
#: Terms of a group of items that share an index (an item with more is its own group), documents of a shard, table cells.
GROUP_TERMS, SHARD, CELLS = 1 << 13, 1 << 12, 1 << 24
#: Documents of a block on average, and numbers of a document's projection.
BLOCK, PROJECTED = 64, 32
#: Letters and digits and all that is beyond ASCII make terms; A-Z are lower-cased, the rest parts terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"
RESULT = "item_id long, rank int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, in UTF-8; NULL has none."""
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


@dataclass
class Group:
    """Items whose terms share an index: positions of their terms among `terms`, and what each term weighs in them."""

    terms: np.ndarray
    members: list[tuple[int, np.ndarray, np.ndarray]] = field(default_factory=list)
    #: for each term, the terms that any item asks together with it
    together: list[np.ndarray] = field(default_factory=list)


class Best:
    """The best documents so far for each item: scores, ids and whether the id is NULL, best first."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.held = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in range(items)]

    def least(self, item: int) -> int:
        """The score that a further document must reach."""
        scores = self.held[item][0]
        return int(scores[-1]) if len(scores) == self.top else 1

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        good = scores >= self.least(item)
        if good.any():
            columns = [np.concatenate([a, b[good]]) for a, b in zip(self.held[item], (scores, ids, unnamed))]
            order = np.lexsort((columns[1], columns[2], -columns[0]))[: self.top]
            self.held[item] = tuple(c[order] for c in columns)


class Index:
    """The blocks of one shard for one group of items."""

    def __init__(self, first: np.ndarray, terms: np.ndarray, values: np.ndarray, group: Group):
        """`first[d]` is where the terms and values of document d begin."""
        place = np.searchsorted(group.terms, terms)
        asked = np.zeros(len(terms), bool)
        inside = place < len(group.terms)
        asked[inside] = group.terms[place[inside]] == terms[inside]
        rows = np.repeat(np.arange(len(first) - 1), np.diff(first))[asked]
        place, values = place[asked], values[asked]
        present = np.unique(place)
        self.column = np.full(len(group.terms), -1)
        self.column[present] = np.arange(len(present))
        self.table = np.zeros((len(first) - 1, len(present)), np.int32)
        self.table[rows, self.column[place]] = values
        near = self._projected()
        order = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[order], present, "right")
        #: for each column: its documents by block, where blocks begin, the columns of the summaries, the summaries
        self.lists = [self._blocks(list_rows, near, self._asked_with(group, k)) for list_rows, k in zip(np.split(rows[order], ends[:-1]), present)]

    def _asked_with(self, group: Group, k: int) -> np.ndarray:
        columns = self.column[group.together[k]]
        return columns[columns >= 0]

    def _projected(self) -> np.ndarray:
        directions = np.random.default_rng(0).standard_normal((self.table.shape[1], PROJECTED)).astype(np.float32)
        out = np.empty((len(self.table), PROJECTED), np.float32)
        for k in range(0, len(out), 256):
            out[k : k + 256] = self.table[k : k + 256].astype(np.float32) @ directions
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def _blocks(self, rows: np.ndarray, near: np.ndarray, columns: np.ndarray):
        count = -(-len(rows) // BLOCK)
        starts = np.zeros(1, np.int64)
        if count > 1:
            picked = near[rows[np.arange(count) * len(rows) // count]]
            cluster = (near[rows] @ picked.T).argmax(axis=1)
            order = np.argsort(cluster, kind="stable")
            rows = rows[order]
            starts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
        summaries = np.maximum.reduceat(self.table[rows[:, None], columns], starts, axis=0)
        return rows, starts, columns, summaries

    def search(self, number: int, places: np.ndarray, weights: np.ndarray, best: Best, ids: np.ndarray, unnamed: np.ndarray) -> int:
        """Adds the shard's best documents for one item; gives the number of documents that were scored."""
        columns = self.column[places]
        weights, columns = weights[columns >= 0], columns[columns >= 0]
        if not len(columns):
            return 0
        bounds, lists = [], []
        for c in columns:
            rows, starts, beside, summaries = self.lists[c]
            bounds.append(summaries[:, np.searchsorted(beside, columns)].astype(np.int64) @ weights)
            lists.append((rows, np.append(starts, len(rows))))
        of_list = np.repeat(np.arange(len(lists)), list(map(len, bounds)))
        of_block = np.concatenate([np.arange(len(b)) for b in bounds])
        bounds = np.concatenate(bounds)
        order = np.argsort(-bounds, kind="stable")
        open_rows = np.ones(len(self.table), bool)
        scored = at = 0
        step = 2
        while at < len(order):
            taken = order[at : at + step]
            taken = taken[bounds[taken] >= best.least(number)]
            if not len(taken):
                break  # bounds fall, so none of the other blocks can hold a better document
            met = np.zeros(len(self.table), bool)
            for k in taken:
                rows, ends = lists[of_list[k]]
                met[rows[ends[of_block[k]] : ends[of_block[k] + 1]]] = True
            rows = np.flatnonzero(met & open_rows)
            open_rows[rows] = False
            if len(rows):
                best.add(number, self.table[rows[:, None], columns].astype(np.int64) @ weights, ids[rows], unnamed[rows])
                scored += len(rows)
            at, step = at + step, step * 2
        return scored


def grouped(items: list[tuple[np.ndarray, np.ndarray]]) -> list[Group]:
    """Groups of consecutive items (term numbers, weights) with a bounded number of terms in each."""
    groups: list[Group] = []
    held: list[int] = []
    terms: set[int] = set()

    def close() -> None:
        if held:
            group = Group(np.array(sorted(terms), np.int64))
            together: list[list[np.ndarray]] = [[] for _ in group.terms]
            for k in held:
                places = np.searchsorted(group.terms, items[k][0])
                group.members.append((k, places, items[k][1]))
                for p in places:
                    together[p].append(places)
            group.together = [np.unique(np.concatenate(x)) for x in together]
            groups.append(group)

    for k, (own, _) in enumerate(items):
        if held and len(terms | set(own.tolist())) > GROUP_TERMS:
            close()
            held, terms = [], set()
        held.append(k)
        terms |= set(own.tolist())
    close()
    return groups


def _lists(values: list, ends: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def vectors(docs: DataFrame, numbers) -> DataFrame:
    """doc_id, number n of terms with repeats, and the asked terms with their counts, for each document with a term.

    `numbers` is a broadcast dictionary from terms to numbers. Whole texts are read; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for batch in batches:
            rows, sizes, terms, counts, ends = [], [], [], [], [0]
            for k, text in enumerate(batch.column("text")):
                own = terms_of(text.as_py())
                if own:
                    found = Counter(map(number, own))
                    found.pop(None, None)
                    rows.append(k)
                    sizes.append(len(own))
                    terms += found.keys()
                    counts += found.values()
                    ends.append(len(terms))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), _lists(terms, ends), _lists(counts, ends)],
                names=["doc_id", "n", "terms", "counts"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, VECTORS)


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows of a task in tables of `size` rows."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            held.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == size:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _searcher(held, documents: int, length: int, top: int):
    """The task's work: the best documents of its rows for each item of the broadcast (item ids, groups)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, groups = held.value
        best = Best(len(item_ids), top)
        size = min(SHARD, max(256, CELLS // max(len(g.terms) for g in groups)))
        for shard in _shards(batches, size):
            first, terms = _flat(shard.column("terms"))
            counts = _flat(shard.column("counts"))[1]
            n = np.repeat(shard.column("n").to_numpy(), np.diff(first))
            m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // length
            values = SCALE * counts // (PER_TF * counts + PER_LENGTH * m)
            doc_ids = shard.column("doc_id")
            unnamed = doc_ids.is_null().to_numpy()
            ids = doc_ids.fill_null(0).to_numpy()
            for group in groups:
                index = Index(first, terms, values, group)
                for number, places, weights in group.members:
                    index.search(number, places, weights, best, ids, unnamed)
        sizes = [len(x[0]) for x in best.held]
        item = np.repeat(np.arange(len(item_ids)), sizes)
        scores, ids, unnamed = (np.concatenate([x[k] for x in best.held]) for k in range(3))
        named = pa.array([item_ids[k] for k in item.tolist()], pa.int64())
        columns = [pa.array(item.astype(np.int32)), named, pa.array(ids, mask=unnamed), pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "doc_id", "score"])

    return run


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """Different items with a term, in blocks of bounded size: id, terms and how often the item holds each."""
    rows = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    chars, count = rows.agg(F.sum(F.length("text")), F.count(F.lit(1))).first()
    blocks = max(-(-(chars or 0) // BLOCK_CHARS), -(-count // BLOCK_ITEMS))
    split = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    for block in range(blocks):
        held = sorted(((r.item_id, r.text) for r in split.where(F.col("block") == block).collect()), key=lambda r: (r[0] is None, r))
        yield [(i, found) for i, text in held if (found := Counter(terms_of(text)))]


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the `top` documents of highest score above 0 for each item, best first.

    Equal scores rank by doc_id, a NULL id behind the others. NULL and wordless texts and items match nothing. Item rows
    that are equal count once; rows of one id with different texts are items of their own. A document row that occurs twice
    is two documents. Texts of any length are taken whole; an empty table gives no rows. All items are searched in all
    documents, in blocks of items that fit a task; each block reads the documents once and stores their term vectors in the
    shared folder. Every task sends `top` rows for each item at most, which are ranked in two steps.
    """
    spark = docs.sparkSession
    result = None
    for block in _item_blocks(items):
        if not block:
            continue
        asked = sorted({t for _, found in block for t in found})
        numbers = spark.sparkContext.broadcast({t: k for k, t in enumerate(asked)})
        stored = cut(vectors(docs, numbers))
        documents, length = stored.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            continue
        holding = dict(stored.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # asked terms alone
        weights = [weight(documents, holding.get(k, 0)) for k in range(len(asked))]
        coded = []
        for _, found in block:
            own = sorted((numbers.value[t], times) for t, times in found.items())
            coded.append((np.array([k for k, _ in own], np.int64), np.array([weights[k] * times for k, times in own], np.int64)))
        held = spark.sparkContext.broadcast(([i for i, _ in block], grouped(coded)))
        found = stored.mapInArrow(_searcher(held, documents, length, top), "item int, item_id long, doc_id long, score long")
        best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        dealt = found.withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
        few = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("item", "deal").orderBy(*best))).where(F.col("rank") <= top)
        ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= top)
        part = ranked.select("item_id", "rank", "doc_id", "score")
        result = part if result is None else result.unionAll(part)
    return spark.createDataFrame([], RESULT) if result is None else result
