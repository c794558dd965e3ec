"""Benchmark decontamination: size-partitioned MinHash containment search (operator 4).

Test items are short and documents long, so similarity of whole texts says nothing; what counts is the share of an item's
word shingles that a document holds. Items are put into classes by size (powers of two). The sketch of an item is its
bottom-k MinHash sample: its k least shingle hashes, with k set by its class so that a document which holds the wanted
share of the item must hold one of the sample (at most the rest can be missing). Documents look up all their shingles
among the samples; what is met is verified by exact shingles. So the search loses nothing.

Items are worked off in blocks of bounded size, each against all documents; documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType

SHINGLE = 5
CONTAINMENT = 0.8
#: Characters of item texts that are held in one block (and sent to every task).
BLOCK_CHARS = 16_000_000
HITS = "doc_id long, item_id long, item_shingles int, shared int, containment double"
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_WORD = re.compile(r"[^\W_]+").findall
_BITS = 20


def words_in(text: str | None) -> list[str]:
    """Lower-case words of letters and digits."""
    return _WORD((text or "").lower())


class _Hashes(dict):
    """64-bit hash of a word, remembered; the memory starts anew when it is full."""

    LIMIT = 400_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[str], width: int, memory: _Hashes) -> np.ndarray:
    """One min-wise hash for each run of `width` words, in order."""
    count = len(words) - width + 1
    if count < 1:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
    mixed = codes[:count] * _MULTIPLIERS[0]
    for k in range(1, width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MULTIPLIERS[k] + codes[k : k + count]
    return (mixed ^ (mixed >> np.uint64(32))) * _MULTIPLIERS[0]


def sample_size(shingles: int, share: float) -> int:
    """Sample of an item of so many shingles: of its size class' upper end, as many as may be missing, and one."""
    upper = 1 << max(0, shingles - 1).bit_length()
    return min(shingles, int(upper - np.ceil(share * upper)) + 1)


class Items:
    """One block of items: their exact shingles, and an index from sampled hashes to items, by shingle width."""

    def __init__(self, rows: list[tuple[int, str]], share: float):
        self.share, self.memory = share, _Hashes()
        self.ids = [i for i, _ in rows]
        self.exact: list[set] = []
        self.widths: dict[int, dict] = {}
        found: dict[int, dict[int, list[int]]] = {}
        for k, (_, text) in enumerate(rows):
            words = words_in(text)
            width = min(SHINGLE, len(words))
            self.exact.append(set(zip(*(words[j:] for j in range(width)))) if width else set())
            if not width:
                continue
            hashes = np.unique(shingle_hashes(words, width, self.memory))
            for h in hashes[: sample_size(len(hashes), share)].tolist():
                found.setdefault(width, {}).setdefault(h, []).append(k)
        for width, index in found.items():
            keys = np.array(sorted(index), np.uint64)
            mask = np.zeros(1 << _BITS, bool)
            mask[keys >> np.uint64(64 - _BITS)] = True
            self.widths[width] = {"mask": mask, "keys": keys, "index": index}

    def met(self, text: str | None) -> Iterator[tuple[int, int, int, float]]:
        """(item_id, its shingles, how many of them the text holds, their share) where the share is large enough."""
        words = words_in(text)
        for width, held in self.widths.items():
            hashes = shingle_hashes(words, width, self.memory)
            hashes = hashes[held["mask"][hashes >> np.uint64(64 - _BITS)]]
            if not len(hashes):
                continue
            met = {k for h in set(hashes.tolist()) for k in held["index"].get(h, ())}
            if not met:
                continue
            own = set(zip(*(words[j:] for j in range(width))))
            for k in sorted(met):
                shared = len(self.exact[k] & own)
                if shared >= self.share * len(self.exact[k]):
                    yield self.ids[k], len(self.exact[k]), shared, shared / len(self.exact[k])


def blocks(items: DataFrame, share: float) -> Iterator:
    """Broadcast blocks of items (item_id, text), each of bounded size; items without a word are left out."""
    spark = items.sparkSession
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-chars // BLOCK_CHARS)
    split = items.where("text is not null").select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(count, 1))).alias("block"))
    for block in range(count):
        rows = [(r.item_id, r.text) for r in split.where(F.col("block") == block).collect()]
        yield spark.sparkContext.broadcast(sorted(rows, key=lambda r: (r[0] is None, r))), share


def _opened(held) -> Items:
    return Items(held[0].value, held[1])


def _searcher(held):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _opened(held)
        for batch in batches:
            out = [(d, *hit) for d, x in zip(batch["doc_id"].astype(object), batch["text"]) for hit in index.met(x)]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "item_shingles", "shared", "containment"])

    return search


def find(docs: DataFrame, items: DataFrame, share: float = CONTAINMENT) -> DataFrame:
    """Rows (doc_id, item_id, item_shingles, shared, containment): documents that hold the share of an item or more.

    Shingles are five words (all words of a shorter item), each counted once. NULL and wordless texts or items match
    nothing. A document or item row that occurs twice gives its rows twice. Texts of any length are searched whole. Without
    items or documents the result is empty.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    result = None
    for held in blocks(items, share):
        part = rows.mapInPandas(_searcher(held), HITS)
        result = part if result is None else result.unionAll(part)
    return spark.createDataFrame([], HITS) if result is None else result


def _cleaner(held):
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = _opened(held)
        for texts in batches:
            yield pd.Series([next(index.met(x), None) is None for x in texts], dtype=bool)

    return pandas_udf(clean, BooleanType())


def keep_clean(docs: DataFrame, items: DataFrame, share: float = CONTAINMENT) -> DataFrame:
    """Rows of `docs`, unchanged, that hold no item."""
    for held in blocks(items, share):
        docs = docs.where(_cleaner(held)("text"))
    return docs
