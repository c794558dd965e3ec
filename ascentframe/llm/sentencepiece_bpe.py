"""SentencePiece encoding and decoding for merge-type vocabularies (operator 11).

A text becomes one symbol for each code point, with a blank in front and blanks written as the vocabulary's sign. All
adjacent pairs that the vocabulary knows wait in an agenda, ordered by score (higher first) and place (left first); the
first pair is joined, its new neighbours enter the agenda, until it is empty. Symbols without a piece become their bytes.

No piece holds a blank sign behind another character, or a line end, so nothing is ever joined across these places: a text
is cut there, and each slice goes through its agenda once in a worker and is remembered. Every slice that an agenda has
worked out is checked against the sentencepiece library, all new slices of an Arrow batch in one call.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, chain
from operator import ne

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ascentframe.llm.common import groups_by_size, ragged

#: Code points that are worked on at once; a longer text is a group of its own.
GROUP = 1 << 20
#: Slices that a worker remembers before it starts anew; longer ones are not remembered.
REMEMBERED, LONGEST = 500_000, 64
#: The sign that stands for a blank, and what the library decodes the unknown id to.
BLANK, UNKNOWN = "▁", " ⁇ "


def agenda(text: str, ranks: dict[str, int]) -> list[str]:
    """Pieces of `text`: adjacent pairs are joined by rank (that of the highest score is 0), the leftmost first, until none
    is known. The agenda of a short text is a plain list by place, that of a long one a heap."""
    if len(text) > LONGEST:
        return _long_agenda(text, ranks)
    none, rank = len(ranks), ranks.get
    parts = list(text)
    waiting = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
    while waiting and (least := min(waiting)) < none:
        i = waiting.index(least)
        parts[i : i + 2] = [joined := parts[i] + parts[i + 1]]
        del waiting[i]
        if i:
            waiting[i - 1] = rank(parts[i - 1] + joined, none)
        if i < len(waiting):
            waiting[i] = rank(joined + parts[i + 1], none)
    return parts


def _long_agenda(text: str, ranks: dict[str, int]) -> list[str]:
    n = len(text)
    after, before, end, alive = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    waiting = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(text[i : i + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, i, stop = heapq.heappop(waiting)
        if not alive[i] or (j := after[i]) >= n or end[j] != stop:
            continue  # one of the two was joined with another symbol meanwhile
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(text[i : end[after[i]]])) is not None:
                heapq.heappush(waiting, (r, i, end[after[i]]))
        if (k := before[i]) >= 0 and (r := ranks.get(text[k:stop])) is not None:
            heapq.heappush(waiting, (r, k, stop))
    return [text[i : end[i]] for i in range(n) if alive[i]]


class Coder(dict):
    """The vocabulary with remembered slices: a slice leads to its number, the number to its ids."""

    def __init__(self, path: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        if lib.normalize("a  éＡ ") != f"{BLANK}a{BLANK}{BLANK}éＡ{BLANK}":
            raise ValueError("the vocabulary rewrites texts; only those that leave texts as they are, with a blank in front, are supported")
        pieces = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        joined = [i for i in range(len(pieces)) if not (lib.is_unknown(i) or lib.is_control(i) or lib.is_byte(i))]
        self.numbers = {pieces[i]: i for i in joined}
        levels = {s: k for k, s in enumerate(sorted({lib.get_score(i) for i in joined}, reverse=True))}
        self.ranks = {pieces[i]: levels[lib.get_score(i)] for i in joined}
        self.of_byte = {int(pieces[i][3:5], 16): i for i in range(len(pieces)) if lib.is_byte(i)}
        self.unknown = lib.unk_id()
        plain = not any(re.search(f"[^{BLANK}]{BLANK}|\n", p) for p in self.numbers)
        self.cut = re.compile(f"(?:{BLANK}+|\n)[^{BLANK}\n]*" if plain else "(?s).+").findall
        # bytes that each id stands for when it is decoded
        self.bytes = [
            b"" if lib.is_control(i) else UNKNOWN.encode() if lib.is_unknown(i) else bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.leads = np.array([p.startswith(BLANK) for p in pieces])
        self.single = np.array([lib.is_byte(i) for i in range(len(pieces))])
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, len(pieces))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.mute = self.lengths == 0
        self.flat_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.flat, self.first, self.count, self.mended = array("i"), array("q"), array("i"), array("b")
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self.first) + len(self.new)
        self.new.append(piece)
        return number

    def ids_of(self, piece: str) -> list[int]:
        symbols = agenda(piece, self.ranks)
        try:
            return [self.numbers[x] for x in symbols]
        except KeyError:  # a code point that the vocabulary lacks
            spelt = lambda x: [self.of_byte[b] for b in x.encode()] if self.of_byte else [self.unknown]
            return [i for x in symbols for i in ([self.numbers[x]] if x in self.numbers else spelt(x))]

    def _learn(self) -> None:
        """Ids of the new slices by their agendas, checked against the library; where it differs, its ids are taken."""
        own = list(map(self.ids_of, self.new))
        # the library puts a blank in front: it stands for the slice's own first blank, or is left out before a line end
        led = [x[0] == BLANK for x in self.new]
        ids = self.library.encode([x[1:] if a else x for x, a in zip(self.new, led)], num_threads=1)
        for k, piece in enumerate(self.new):
            if not led[k]:
                ids[k] = ids[k][1:]
            elif piece == BLANK:  # the library gives nothing for an empty text
                ids[k] = own[k]
            if len(piece) > LONGEST:
                del self[piece]
        counts = list(map(len, ids))
        self.first.extend(accumulate(counts[:-1], initial=len(self.flat)))
        self.count.extend(counts)
        self.flat.extend(chain.from_iterable(ids))
        self.mended.extend(map(ne, own, ids))
        self.new = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the number of ids of each, and how many slices of each the library had otherwise."""
        if len(self.first) > REMEMBERED:
            self.forget()
        numbers: list[int] = []
        ends = [0]
        lookup = self.__getitem__
        for text in texts:
            if text:
                numbers.extend(map(lookup, self.cut(BLANK + text.replace(" ", BLANK))))
            ends.append(len(numbers))
        if self.new:
            self._learn()
        codes = np.array(numbers, np.int64)
        first, count, mended = (np.frombuffer(x, x.typecode).copy() if len(x) else np.empty(0, np.int64) for x in (self.first, self.count, self.mended))
        count = count[codes]
        ids = (np.frombuffer(self.flat, "i").copy() if len(self.flat) else np.empty(0, np.int32))[ragged(first[codes], count)]
        total, faults = (np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[ends] for x in (count, mended[codes]))
        return ids.astype(np.int32), np.diff(total), np.diff(faults)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of consecutive runs of ids, as the library's decode gives them."""
        if not len(ids):
            return [""] * len(counts)
        lengths = self.lengths[ids]
        data = self.flat_bytes[ragged(self.starts[ids], lengths)].tobytes()
        upto = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        out, mute = [], self.mute[ids].any()
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            c, d = int(upto[a]), int(upto[b])
            while a < b and self.mute[ids[a]]:
                a += 1
            if a < b and self.leads[ids[a]]:
                c += 1  # the blank that encoding put in front
            try:
                if mute and self.mute[ids[a:b]].any():
                    raise UnicodeError  # a control id parts the bytes around it
                out.append(data[c:d].decode())
            except UnicodeError:
                out.append(self._decode_slowly(ids[a:b].tolist()))
        return out

    def _decode_slowly(self, ids: list[int]) -> str:
        """For byte ids that form no code point: each such byte is a replacement character."""
        text, run = [], b""
        for number in [*ids, -1]:
            if number >= 0 and self.single[number]:
                run += self.bytes[number]
                continue
            while run:
                size = next((k for k in range(1, 5) if _is_code_point(run[:k])), 0)
                text.append(run[:size].decode() if size else "�")
                run = run[size or 1 :]
            if number >= 0:
                text.append(self.bytes[number].decode())
        return "".join(text)[1 if ids and self.leads[ids[0]] else 0 :]


def _is_code_point(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


@cache
def coder(path: str) -> Coder:
    return Coder(path)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


_IDS, _DECODED = StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())
_MENDED = StructField("n_mended", IntegerType())


def _mapped(docs: DataFrame, kept: list[str], added: list[StructField], work) -> DataFrame:
    """The columns `kept` of `docs` with those that `work(batch, coder)` yields for slices (a, b) of a batch."""
    schema = StructType([docs.schema[c] for c in kept] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, columns in work(batch):
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in kept), *columns], names=schema.names)

    return docs.mapInArrow(run, schema)


def _encoded(batch: pa.RecordBatch, path: str):
    texts = ["" if x is None else x for x in batch.column("text").to_pylist()]
    for a, b in groups_by_size(map(len, texts), GROUP):
        yield a, b, coder(path).encode(texts[a:b])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """`docs` with the ids of each whole text in `ids` and the number of slices in which the library's ids were taken
    instead of the agenda's in `n_mended` (0 wherever both agree).

    NULL and empty texts have no ids. `path` is a model file that exists on every machine. Columns of those names are
    replaced. Rows are independent of each other: nothing is shuffled, rows that occur twice come out twice, and an empty
    table gives no rows. Texts of any length are taken whole; results leave a task in batches of bounded size.
    """

    def work(batch):
        for a, b, (ids, counts, mended) in _encoded(batch, path):
            yield a, b, [_lists(ids, counts), pa.array(mended.astype(np.int32))]

    return _mapped(docs, [c for c in docs.columns if c not in ("ids", "n_mended")], [_IDS, _MENDED], work)


def decode(coded: DataFrame, path: str) -> DataFrame:
    """`coded` (ids, ...) with the text that the ids stand for in `decoded`; NULL ids give NULL."""

    def work(batch):
        lists = batch.column("ids")
        for a, b in groups_by_size((len(x) if x.is_valid else 0 for x in lists), GROUP):
            own = [np.asarray(x.values, np.int64) if x.is_valid else np.empty(0, np.int64) for x in lists[a:b]]
            texts = coder(path).decode(np.concatenate(own), np.array(list(map(len, own))))
            yield a, b, [pa.array([t if x.is_valid else None for t, x in zip(texts, lists[a:b])], pa.string())]

    return _mapped(coded, [c for c in coded.columns if c != "decoded"], [_DECODED], work)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_mended, and the text decoded from the ids, in one pass over the texts."""

    def work(batch):
        for a, b, (ids, counts, mended) in _encoded(batch, path):
            yield a, b, [_lists(ids, counts), pa.array(mended.astype(np.int32)), pa.array(coder(path).decode(ids, counts), pa.string())]

    return _mapped(docs.select("doc_id", "text"), ["doc_id"], [_IDS, _MENDED, _DECODED], work)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_mended of each row of `docs`."""
    return round_trip(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "n_mended",
    )
