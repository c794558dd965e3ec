"""Vector code compression with memoised grid cells (operator 12).

Vectors become integers and are cut into parts; every part of a vector is coded by the nearest entry of its codebook. Parts
fall into the cells of a grid. For a cell that is met first, the least and the greatest distance from any point of its box
to each entry are worked out; an entry whose least distance exceeds another's greatest one can be nearest to no point of
the box. The others are remembered under the cell, and only they are evaluated exactly, for all parts that fall into it.

Codebooks are fitted to all vectors: tasks send one row of sums for each entry, which Spark adds up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ascentframe.llm.common import cut, ragged, sized

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integers lie within this, so that squared distances of whole vectors fit 64 bits; larger components are set to it.
LIMIT = 1 << 20
#: Cells that are remembered for a part before it starts anew, and pairs of parts and entries evaluated at once.
REMEMBERED, PAIRS = 50_000, 1 << 17


@dataclass(frozen=True)
class Codebooks:
    """`entries[part, entry]` are integer vectors; `size` is the length of the vectors they were made from."""

    entries: np.ndarray
    size: int

    def sha256(self) -> str:
        """Digest of all components by part, entry and position, in decimal with commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Cells(dict):
    """The cells of one codebook that were met: a cell's bytes lead to its number, the number to its entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        self.width = _cell_width(self.entries)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.flat, self.first, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, cell: bytes) -> int:
        self[cell] = number = len(self)
        return number

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """For each cell (row of grid places) and entry: can the entry be nearest to a point of the cell's box?"""
        out = np.empty((len(cells), len(self.entries)), bool)
        for k in range(0, len(cells), 1024):
            low = cells[k : k + 1024].astype(np.int64) * self.width
            near = np.zeros((len(low), len(self.entries)), np.int64)
            far = np.zeros_like(near)
            for j in range(low.shape[1]):
                below = self.entries[:, j] - low[:, j, None]  # of the entry above the box's lower side
                above = self.width - 1 - below
                near += np.maximum(np.maximum(-below, -above), 0) ** 2
                far += np.maximum(np.abs(below), np.abs(above)) ** 2
            out[k : k + 1024] = near <= far.min(axis=1, keepdims=True)
        return out

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry (the lower one of a tie) and the squared distance to it, for each row."""
        if not len(parts) or not parts.shape[1]:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        if len(self) > REMEMBERED:
            self.forget()
        cells = np.ascontiguousarray(np.floor_divide(parts, self.width).astype(np.int32))
        known = len(self)
        numbers = np.fromiter(map(self.__getitem__, _row_bytes(cells)), np.int64, len(cells))
        new, rows = np.unique(numbers, return_index=True)
        rows = rows[new >= known]  # numbers are given in the order of first sight
        if len(rows):
            kept = self.undominated(cells[rows])
            count = kept.sum(axis=1)
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, np.nonzero(kept)[1].astype(np.int32)])
        best, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        counts = self.count[numbers]
        upto = np.cumsum(counts)
        a = 0
        while a < len(parts):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, "right")))
            own = counts[a:b]
            tried = self.flat[ragged(self.first[numbers[a:b]], own)]
            away = ((np.repeat(parts[a:b], own, axis=0) - self.entries[tried]) ** 2).sum(axis=1)
            starts = np.cumsum(own) - own
            distance[a:b] = np.minimum.reduceat(away, starts)
            hits = np.flatnonzero(away == np.repeat(distance[a:b], own))
            best[a:b] = tried[hits[np.searchsorted(hits, starts)]]  # entries of a cell ascend, so the first hit is the lowest
            a = b
        return best, distance


def _row_bytes(cells: np.ndarray) -> list[bytes]:
    return cells.view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel().tolist()


def _cell_width(entries: np.ndarray) -> int:
    """Boxes whose diagonal is half the usual distance of an entry to its neighbour: smaller ones are met too seldom, in
    larger ones too few entries are dominated. The result does not depend on it."""
    apart = np.zeros((len(entries), len(entries)), np.float64)
    for j in range(entries.shape[1]):
        apart += np.subtract.outer(entries[:, j], entries[:, j]).astype(np.float64) ** 2
    np.fill_diagonal(apart, np.inf)
    closest = np.sqrt(apart.min(axis=1)) if len(entries) > 1 else np.empty(0)
    closest = closest[closest > 0]
    return max(1, int(np.median(closest) / (2 * np.sqrt(entries.shape[1])))) if len(closest) else LIMIT


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label and the integer vector x of all rows whose vector and all its components are there and finite."""
    scaled = lambda v: F.floor(F.greatest(F.least(v.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    given = F.col("embedding")
    return vectors.where(given.isNotNull() & F.forall(given, finite)).select("vec_id", "label", F.transform(given, scaled).alias("x"))


def _first_vectors(rows: DataFrame) -> list[list[int]]:
    """Vectors of the least ids, one for each id (the least of its rows), as long as the first of them; NULL is the last id."""
    found: dict = {}
    left, size = rows.where("vec_id is not null"), None
    while len(found) < ENTRIES:
        part = left if size is None else left.where(F.size("x") == size)
        more = part.orderBy("vec_id", "x").limit(ENTRIES).collect()
        if not more:
            break
        size = len(more[0].x) if size is None else size
        for row in more:
            if len(row.x) == size:
                found.setdefault(row.vec_id, row.x)
        left = left.where(F.col("vec_id") > more[-1].vec_id)
        if len(more) < ENTRIES:
            break
    if len(found) < ENTRIES:
        unnamed = rows.where("vec_id is null") if size is None else rows.where(F.col("vec_id").isNull() & (F.size("x") == size))
        found |= {None: row.x for row in unnamed.orderBy("x").limit(1).collect()}
    return list(found.values())[:ENTRIES]


def _parts(flat: np.ndarray, size: int) -> np.ndarray:
    """(part, vector, position) of whole vectors; a length that four does not divide is filled up with zeros."""
    length = -(-size // PARTS)
    vectors = flat.reshape(-1, size).astype(np.int64) if size else np.zeros((0, 0), np.int64)
    filled = np.pad(vectors, ((0, 0), (0, length * PARTS - size)))
    return filled.reshape(-1, PARTS, length).transpose(1, 0, 2)


def _assigned(books: Codebooks):
    """A function of a batch: which rows have the codebooks' length, their parts, entries and squared distances."""
    cells = [Cells(entries) for entries in books.entries]

    def assign(lists: pa.ListArray):
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        fits = lengths == books.size
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        if not fits.all():
            flat = flat[np.repeat(fits, lengths)]
        parts = _parts(flat, books.size) if books.size else np.zeros((PARTS, int(fits.sum()), 0), np.int64)
        found = [cell.nearest(np.ascontiguousarray(x)) for cell, x in zip(cells, parts)]
        return fits, parts, np.array([f[0] for f in found]), np.array([f[1] for f in found])

    return assign


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Codebooks whose entries are the mean (rounded down) of the parts they are nearest to; unused ones stay."""
    count, length = books.entries.shape[1:]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigned(books)
        used, totals = np.zeros(PARTS * count, np.int64), np.zeros((PARTS * count, length), np.int64)
        for batch in batches:
            _, parts, best, _ = assign(batch.column("x"))
            key = (best + count * np.arange(PARTS)[:, None]).ravel()
            used += np.bincount(key, minlength=len(used))
            values, order = parts.reshape(-1, length), np.argsort(key, kind="stable")
            if len(order):
                keys, first = np.unique(key[order], return_index=True)
                totals[keys] += np.add.reduceat(values[order], first, axis=0)
        held = np.flatnonzero(used)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1, dtype=np.int32) * length), pa.array(totals[held].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(used[held]), sums], names=["entry", "used", "sums"])

    part = rows.select("x").mapInArrow(add_up, "entry long, used long, sums array<long>")
    sums = [F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(length)]
    entries = books.entries.reshape(PARTS * count, length).copy()
    for row in part.groupBy("entry").agg(F.sum("used").alias("used"), *sums).collect():  # a row for each entry at most
        entries[row.entry] = [s // row.used for s in row[2:]]
    return Codebooks(entries.reshape(PARTS, count, length), books.size)


def fit(rows: DataFrame, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of integer vectors (vec_id, x), from all of them; the rows are read once for each round.

    The entries start as the vectors of the 256 least ids (all, if there are fewer). Every other vector must have the length
    of the first one to count. Without rows the codebooks are empty.
    """
    start = _first_vectors(rows)
    if not start:
        return Codebooks(np.empty((PARTS, 0, 0), np.int64), 0)
    size = len(start[0])
    parts = _parts(np.array(start, np.int64).ravel(), size) if size else np.zeros((PARTS, len(start), 0), np.int64)
    books = Codebooks(np.ascontiguousarray(parts), size)
    for _ in range(rounds if size else 0):
        books = _moved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits for each part) and error (squared distance, all parts together) of
    integer vectors. A vector of another length than the codebooks' has NULL as code and error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigned(books)
        for batch in batches:
            fits, _, best, distance = assign(batch.column("x"))
            codes = np.full(len(fits), None, object)
            codes[fits] = [x.tobytes().hex() for x in np.ascontiguousarray(best.T.astype(np.uint8))]
            errors = np.zeros(len(fits), np.int64)
            errors[fits] = distance.sum(axis=0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, mask=~fits)],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = dict(rows.dtypes)
    return rows.select("vec_id", "label", "x").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decode(coded: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id and the vector (array of doubles) that each code stands for; a NULL code gives NULL."""
    entries, size = books.entries / SCALE, books.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [x and bytes.fromhex(x) for x in batch.column("code").to_pylist()]
            values = [None if x is None else np.concatenate([book[k] for book, k in zip(entries, x)])[:size] for x in codes]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(values, pa.list_(pa.float64()))], names=["vec_id", "vector"])

    return coded.select("vec_id", "code").mapInArrow(run, f"vec_id {dict(coded.dtypes)['vec_id']}, vector array<double>")


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each row of `vectors` (vec_id, embedding, label).

    Rows without a vector, or with a NULL or non-finite component, are dropped. label_error adds up the errors of equal
    labels, NULL labels together. Repeated rows are coded alike and count repeatedly; an id starts one entry at most. A
    vector of another length than that of the least id has NULL in code and error and adds nothing. Other columns are
    ignored; an empty table gives no rows. Codes are stored once in the shared folder before labels are added up.
    """
    rows = integers(vectors)
    books = fit(rows)
    coded = cut(encode(rows, books))
    totals = cut(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "same"))
    joined = coded.join(sized(totals, totals.count()), F.col("label").eqNullSafe(F.col("same")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
