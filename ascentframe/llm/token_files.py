"""Token ids in Simple-8b files (operator 2).

Every 64-bit word holds a selector in its top four bits and as many ids as fit in the other 60: 240 or 120 zeros, 60 ids of
one bit, 30 of two, down to one of 60. Values that need more bits (or equal the mark) are escaped: the word holds a mark
and the value stands in a list. Ids are packed in blocks of whole documents; a block carries the offsets of its documents,
so it is decoded at once, and any block without the others.

A file is a Parquet folder with one row for each block, in ascending order of document ids over its parts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ascentframe.llm.common import groups_by_size, ragged

#: Ids in a word and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MARK = (1 << 60) - 1
#: The id that ends a document, ids in a block (a longer document is a block of its own), characters encoded at once.
END_ID = 1
BLOCK_IDS = 1 << 16
GROUP = 1 << 20
BLOCKS = "part int, block int, start long, doc_ids array<long>, lengths array<long>, words binary, escapes binary"


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escaped values of unsigned 64-bit values, in order.

    For every place the largest word that fits from there on is found at once; following the jumps from the first
    place, by doubling, gives the places where words begin.
    """
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    values = values.astype(np.uint64)
    large = values >= np.uint64(MARK)
    escapes = values[large]
    values = np.where(large, np.uint64(MARK), values)
    place = np.arange(n, dtype=np.int32)
    selector = np.full(n, len(COUNTS) - 1, np.int8)
    narrow = np.minimum(values, np.uint64(1 << 31)).astype(np.uint32)  # a type of half the size settles all widths but 60
    highest = int(values.max())
    for s in range(len(COUNTS) - 2, -1, -1):
        if highest < 1 << int(WIDTHS[s]):
            selector[:] = s  # every id is narrow enough
            continue
        misfit = np.where(narrow < (1 << int(WIDTHS[s])), np.int32(n + 240), place)
        end = np.minimum.accumulate(misfit[::-1])[::-1]  # the next id that is too wide; behind the last there are zeros
        held = end - place >= COUNTS[s]
        if not held.any():
            break  # narrower words need longer runs of smaller ids
        selector[held] = s
    jump = np.append(np.minimum(place + COUNTS[selector], n), n)
    begins = np.zeros(1, np.int64)
    while True:
        more = jump[begins]
        more = more[more < n]
        if not len(more):
            break
        begins = np.concatenate([begins, more])
        jump = jump[jump]
    chosen = selector[begins].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(240, np.uint64)])
    for s in np.unique(chosen):
        if WIDTHS[s]:
            rows = np.flatnonzero(chosen == s)
            parts = padded[begins[rows][:, None] + np.arange(COUNTS[s])]
            words[rows] |= np.bitwise_or.reduce(parts << (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64), axis=1)
    return words, escapes


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first `n` values; words of one selector are decoded together, into the places that the counts add up to."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    begins = np.cumsum(COUNTS[chosen]) - COUNTS[chosen]
    out = np.zeros(int(COUNTS[chosen].sum()) if len(words) else 0, np.uint64)
    for s in np.unique(chosen):
        if WIDTHS[s]:
            rows = np.flatnonzero(chosen == s)
            shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
            out[begins[rows][:, None] + np.arange(COUNTS[s])] = (words[rows][:, None] >> shifts) & np.uint64((1 << int(WIDTHS[s])) - 1)
    out = out[:n]
    out[np.flatnonzero(out == np.uint64(MARK))] = escapes
    return out


#: Lower-case Latin letters, which normalising leaves alone; the vocabulary writes their bytes as characters, those that
#: do not print as characters from 256 on.
_LATIN = "[a-z\u00df-\u00f6\u00f8-\u00ff]+"
_PLAIN = re.compile(_LATIN).fullmatch
#: Signs behind the letters of a word are a piece of their own.
_WITH_SIGNS = re.compile(rf"({_LATIN})([!-/:-@\[-^`{{-~\u00a1\u00ab\u00bb\u00bf\u2010-\u2027]+)").fullmatch
#: The same inside a text, where a blank in front makes two words of them: fewer words to remember. The search looks for
#: the sign first and then at the letter before it.
_SIGNS = re.compile(r"([!-/:-@\[-^`{-~\u2010-\u2027](?<=[a-z].)[^\w\s]*)(?=[ \n])").sub
#: First bytes of the combining marks that join Latin letters (U+0300 to U+036F); white space to Python alone; the end of
#: the strings that the vocabulary takes for special tokens.
_MARKS = (b"\xcc", b"\xcd")
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_SPECIAL = "|>"
_HIDDEN = [*range(33), *range(127, 161), 173]
_AS_CHARACTERS = {b: 256 + k for k, b in enumerate(_HIDDEN)}


class WordCoder(dict):
    """Ids of words between white space, remembered. The tokenizer never looks across white space but for its special
    tokens, so words are enough for all texts without one."""

    REMEMBERED, LONGEST = 800_000, 64

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.signs: dict[str, list[int]] = {}
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.signs.clear()
        self.new: list[str] = []
        self.first, self.count, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self.first) + len(self.new)
        self.new.append(word)
        return number

    def _plain(self, word: str) -> list[int]:
        """Ids of a word of plain letters: one piece, so the model may be asked directly."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_AS_CHARACTERS)
        return [x.id for x in self.tokenizer.model.tokenize(word)]

    def _learn(self) -> None:
        split = [(w, "") if _PLAIN(w) else m.groups() if (m := _WITH_SIGNS(w)) else None for w in self.new]
        ask = {s for x in split if x and (s := x[1]) and s not in self.signs} | {w for w, x in zip(self.new, split) if x is None}
        ask = sorted(ask)
        told = dict(zip(ask, (x.ids for x in self.tokenizer.encode_batch(ask, add_special_tokens=False))))
        self.signs |= {s: told[s] for x in split if x and (s := x[1]) in told}
        found = [told[w] if x is None else self._plain(x[0]) + (self.signs[x[1]] if x[1] else []) for w, x in zip(self.new, split)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum()))])
        for word in self.new:
            if len(word) > self.LONGEST:
                del self[word]
        self.new = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end id, and the number of ids of each."""
        if len(self) > self.REMEMBERED:
            self.forget()
        words: list[str] = []
        ends = []
        for text in texts:
            if _SPECIAL in text:
                words.append(text)  # the library looks for its special tokens in the whole text
            else:
                data = text.encode()
                if not any(mark in data for mark in _MARKS):
                    # then the tokenizer lowers A-Z alone, so this may be done before
                    text = _SIGNS(r" \1", data.lower().decode())
                if any(x in text for x in _SEPARATORS):
                    words += filter(None, text.replace("\n", " ").split(" "))
                else:
                    words += text.split()
            ends.append(len(words))
        codes = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            self._learn()
        count = self.count[codes]
        total = np.concatenate([[0], np.cumsum(count)])
        upto = total[np.array([0, *ends])]
        lengths = np.diff(upto) + 1
        out = np.full(int(lengths.sum()), END_ID, np.uint32)
        out[ragged(np.cumsum(lengths) - lengths, lengths - 1)] = self.flat[ragged(self.first[codes], count)]
        return out, lengths


@cache
def _coder(path: str) -> WordCoder:
    return WordCoder(path)


def write(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Writes the ids of all documents, in ascending order of doc_id (NULL first, then by text), as a file at `path`.

    NULL and empty texts give the end id alone. Texts are shuffled once, into ranges of doc_id; each task packs its
    range block by block and holds one block at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = _coder(tokenizer), TaskContext.get().partitionId()
        block = start = 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            texts = ["" if x is None else x for x in batch.column("text").to_pylist()]
            for a, b in groups_by_size(map(len, texts), GROUP):
                ids, lengths = coder.encode(texts[a:b])
                first = 0
                for c, d in groups_by_size(lengths.tolist(), BLOCK_IDS):
                    size = int(lengths[c:d].sum())
                    words, escapes = pack(ids[first : first + size])
                    first += size
                    row = {
                        "part": [part], "block": [block], "start": [start], "doc_ids": [doc_ids[a + c : a + d]],
                        "lengths": [lengths[c:d].tolist()], "words": [words.astype("<u8").tobytes()],
                        "escapes": [escapes.astype("<u8").tobytes()],
                    }
                    yield pa.RecordBatch.from_pydict(row, schema=_SCHEMA)
                    block, start = block + 1, start + size

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, BLOCKS).write.parquet(path)


_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("escapes", pa.binary()),
])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, ids as little-endian 32-bit binary) of a file; start counts the ids of all documents before.

    The ids of each part are added up from the lengths alone; that table has a row for each part of the file.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sizes = blocks.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    before, total = {}, 0
    for row in sorted(sizes.collect()):
        before[row.part], total = total, total + row.n

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                lengths = np.asarray(row.lengths, np.int64)
                ends = np.cumsum(lengths)
                ids = unpack(np.frombuffer(row.words, "<u8"), np.frombuffer(row.escapes, "<u8"), int(ends[-1])).astype("<u4")
                data, starts = ids.tobytes(), ends - lengths
                yield pd.DataFrame({
                    "doc_id": pd.array(row.doc_ids, dtype="Int64"),
                    "start": before[row.part] + row.start + starts,
                    "ids": [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())],
                })

    return blocks.mapInPandas(run, "doc_id long, start long, ids binary")


def digests(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of what `read` gives."""
    return stored.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
