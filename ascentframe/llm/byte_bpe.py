"""Byte-level BPE encoding and decoding (operator 6).

Pre-tokenisation runs no regular expression. Code points become symbols by a class array (letter, number, blank, other
white space, rest) with one code point of look-ahead. Each symbol is a transition function on nine states; functions
compose associatively, so a scan over blocks (all start states of all blocks at once, then the blocks in order) gives the
state before every code point, and with it the boundaries. Slices between boundaries are merged by rank once and
remembered; the offsets of the tokens say where decoding writes their bytes.

The split is the one of the pattern 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ .
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from ascentframe.llm.common import groups_by_size, ragged

#: Code points that are worked on at once; a longer text is a group of its own.
GROUP = 1 << 20
#: Slices that a worker remembers before it starts anew; longer ones are not remembered.
REMEMBERED, LONGEST = 300_000, 64
_BLOCK = 64

# classes of code points
_LETTER, _NUMBER, _OTHER, _BLANK, _SPACE = range(5)
# symbols: letter, number, rest; an apostrophe with one or two contraction letters behind it; a blank before something
# else than white space, other white space before it, and white space before white space or the end
L, N, P, A1, A2, B, W, S = range(8)
# states: what the current slice is made of; C1 and C2 wait for one or two letters of a contraction, D has had them
START, IN_L, IN_N, IN_P, IN_S, LEAD, C1, C2, D = range(9)
STATES, SYMBOLS = 9, 8


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and boundary flag for each (state, symbol), flattened; symbols from 8 on begin a text."""
    to, cut = np.zeros((STATES, 2 * SYMBOLS), np.uint8), np.zeros((STATES, 2 * SYMBOLS), bool)
    for state in range(STATES):
        for symbol in range(2 * SYMBOLS):
            now, kind = (START, symbol - SYMBOLS) if symbol >= SYMBOLS else (state, symbol)
            if kind == L and now in (C1, C2):
                result, new = (D if now == C1 else C1), False
            elif kind in (L, N):
                own = IN_L if kind == L else IN_N
                result, new = own, now not in (own, LEAD)
            elif kind == P or (kind in (A1, A2) and now in (IN_P, LEAD)):
                result, new = IN_P, now not in (IN_P, LEAD)
            elif kind in (A1, A2):
                result, new = (C1 if kind == A1 else C2), True
            elif kind == B:
                result, new = LEAD, True
            elif kind == W:
                result, new = START, True
            else:
                result, new = IN_S, now != IN_S
            to[state, symbol], cut[state, symbol] = result, new or symbol >= SYMBOLS
    return to.ravel(), cut.ravel()


_TO, _CUT = _machine()


@cache
def _classes() -> np.ndarray:
    """Class of every code point, asked once of the library whose split is wanted."""
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    ranks = {bytes([b]): b for b in range(256)}
    table = np.full(0x110000, _OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _SPACE)):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        found = bytes(probe.encode_ordinary(points)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    table[32] = _BLANK
    return table


def states_before(symbols: np.ndarray) -> np.ndarray:
    """State before each symbol, by a scan of composed transition functions."""
    size = -(-len(symbols) // _BLOCK) * _BLOCK
    padded = np.zeros(size, np.uint8)
    padded[: len(symbols)] = symbols
    columns = np.ascontiguousarray(padded.reshape(-1, _BLOCK).T)
    width = 2 * SYMBOLS
    # a block's function: the state it ends in, from each of the states
    ends = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], columns.shape[1], axis=1)
    for row in columns:
        ends = _TO[ends.astype(np.intp) * width + row]
    # inclusive scan of the functions by doubling; constant functions stay what they are
    step = 1
    while step < ends.shape[1] and (ends[0, 1:] != ends[1:, 1:]).any():
        later = _compose(ends, step)
        ends = np.concatenate([ends[:, :step], later], axis=1)
        step *= 2
    state = np.empty(columns.shape[1], np.uint8)
    state[0], state[1:] = START, ends[START, :-1]
    before = np.empty_like(columns)
    for k, row in enumerate(columns):
        before[k] = state
        state = _TO[state.astype(np.intp) * width + row]
    return before.T.ravel()[: len(symbols)]


def _compose(functions: np.ndarray, step: int) -> np.ndarray:
    """For each block from `step` on: its function after that of the block `step` earlier."""
    blocks = np.arange(step, functions.shape[1])
    return functions[functions[:, :-step].astype(np.intp), blocks]


def boundaries(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Places where slices begin in joined texts; `firsts` are the places where (non-empty) texts begin."""
    kinds = _classes()[points]
    after = np.empty_like(kinds)
    after[:-1], after[-1] = kinds[1:], _SPACE
    after[firsts[1:] - 1] = _SPACE
    symbols = kinds.copy()
    white = kinds >= _BLANK
    followed = after < _BLANK
    symbols[white] = S
    symbols[(kinds == _BLANK) & followed] = B
    symbols[(kinds == _SPACE) & followed] = W
    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        ends = np.append(firsts[1:], len(points))
        left = ends[np.searchsorted(firsts, quotes, "right") - 1] - quotes  # code points up to the end of the text
        safe = np.minimum(quotes[:, None] + np.arange(3), len(points) - 1)
        a, b = points[safe[:, 1]], points[safe[:, 2]]
        one = (left > 1) & np.isin(a, [ord(c) for c in "stmd"])
        two = (left > 2) & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        symbols[quotes[one]], symbols[quotes[two]] = A1, A2
    symbols[firsts] += SYMBOLS
    return np.flatnonzero(_CUT[states_before(symbols).astype(np.intp) * (2 * SYMBOLS) + symbols])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the neighbours of least rank (leftmost first) are joined until none has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > LONGEST:
        return _merge_long(piece, ranks)
    none = 1 << 31
    rank = ranks.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs and (least := min(pairs)) < none:
        i = pairs.index(least)
        joined = parts[i] + parts[i + 1]
        parts[i : i + 2] = [joined]
        del pairs[i]
        if i:
            pairs[i - 1] = rank(parts[i - 1] + joined, none)
        if i < len(pairs):
            pairs[i] = rank(joined + parts[i + 1], none)
    return [ranks[x] for x in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a long slice in n log n steps: neighbours wait in a heap, the parts are linked."""
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := after[i]) >= n or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, end[j], after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if (k := before[i]) >= 0 and (r := ranks.get(piece[k : end[i]])) is not None:
            heapq.heappush(heap, (r, k, end[i]))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class Coder(dict):
    """Rank table with remembered slices: a slice's number leads to its ids."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        tokens = sorted(self.ranks.items(), key=lambda x: x[1])
        self.numbers = np.array([i for _, i in tokens], np.int32)
        size = int(self.numbers[-1]) + 1
        self.lengths = np.zeros(size, np.int32)
        self.lengths[self.numbers] = [len(t) for t, _ in tokens]
        self.starts = np.zeros(size, np.int64)
        self.starts[self.numbers] = np.cumsum([0, *(len(t) for t, _ in tokens)])[:-1]
        self.bytes = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.flat, self.first, self.count = array("i"), array("q"), array("i")

    def __missing__(self, piece: bytes) -> int:
        ids = merge(piece, self.ranks)
        number = len(self.first)
        self.first.append(len(self.flat))
        self.count.append(len(ids))
        self.flat.extend(ids)
        if len(piece) <= LONGEST:
            self[piece] = number
        return number

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte each token starts at in its text, and the number of ids of each text."""
        if len(self.first) > REMEMBERED:
            self.forget()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        counts = np.zeros(len(texts), np.int64)
        full = sizes > 0
        if not full.any():
            return np.empty(0, np.int32), np.empty(0, np.int32), counts
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        firsts = (np.cumsum(sizes) - sizes)[full]
        begin = boundaries(points, firsts)
        width = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)
        place = np.cumsum(width) - width
        data = joined.encode("utf-8", "surrogatepass")
        starts = place[begin]
        cuts = starts.tolist()
        pieces = [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]
        codes = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))
        first, count = _copied(self.first)[codes], _copied(self.count)[codes]
        ids = _copied(self.flat)[ragged(first, count)]
        total = np.cumsum(count)
        upto = np.searchsorted(begin, firsts)
        ends = np.append(total[upto[1:] - 1], total[-1])
        counts[full] = np.diff(ends, prepend=0)
        lengths = self.lengths[ids].astype(np.int64)
        offsets = np.cumsum(lengths) - lengths - np.repeat(place[firsts], counts[full])
        return ids, offsets.astype(np.int32), counts

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """Bytes of one text: every token writes its own bytes at its offset."""
        lengths = self.lengths[ids].astype(np.int64)
        out = np.empty(int(lengths.sum()), np.uint8)
        if len(ids):
            out[ragged(offsets, lengths)] = self.bytes[ragged(self.starts[ids], lengths)]
        return out.tobytes()


def _copied(numbers: array) -> np.ndarray:
    return np.frombuffer(numbers, numbers.typecode).copy()


@cache
def coder(path: str) -> Coder:
    return Coder(path)


def _texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _added(docs: DataFrame, *names: str) -> tuple[list[str], StructType]:
    """Columns of `docs` that stay, and the schema with columns of these names behind them."""
    kinds = {"ids": ArrayType(IntegerType()), "offsets": ArrayType(IntegerType()), "decoded": BinaryType()}
    kept = [c for c in docs.columns if c not in names]
    return kept, StructType([docs.schema[c] for c in kept] + [StructField(n, kinds[n]) for n in names])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """`docs` with the token ids of each whole text in `ids` and the byte each token starts at in `offsets`.

    NULL and empty texts have no ids. `path` is a rank file that exists on every machine. Columns of those names are
    replaced. Rows are independent of each other: nothing is shuffled, and rows that occur twice come out twice. Results
    leave a task in small batches, however many rows come in at once.
    """
    kept, schema = _added(docs, "ids", "offsets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            texts = _texts(batch.column("text"))
            for a, b in groups_by_size(map(len, texts), GROUP):
                ids, offsets, counts = own.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in kept), _lists(ids, counts), _lists(offsets, counts)],
                    names=[*kept, "ids", "offsets"],
                )

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str) -> DataFrame:
    """`docs` (ids, offsets, ...) with the bytes that the ids stand for in `decoded`."""
    kept, schema = _added(docs, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            ids, offsets = batch.column("ids"), batch.column("offsets")
            for a, b in groups_by_size((len(x) for x in ids), GROUP):
                out = [own.decode(np.asarray(i.values), np.asarray(o.values)) for i, o in zip(ids[a:b], offsets[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in kept), pa.array(out, pa.binary())], names=[*kept, "decoded"]
                )

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, the ids of the whole text, and the bytes decoded from them, in one pass over the texts."""
    schema = StructType([docs.schema["doc_id"], StructField("ids", ArrayType(IntegerType())), StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            texts = _texts(batch.column("text"))
            for a, b in groups_by_size(map(len, texts), GROUP):
                ids, offsets, counts = own.encode(texts[a:b])
                ends = np.cumsum(counts)[:-1]
                out = [own.decode(i, o) for i, o in zip(np.split(ids, ends), np.split(offsets, ends))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), _lists(ids, counts), pa.array(out, pa.binary())],
                    names=["doc_id", "ids", "decoded"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of `docs`."""
    ids = F.col("ids")
    return round_trip(docs, path).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
