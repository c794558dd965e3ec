"""Cross-entropy difference of matched n-gram models (operator 10).

Two interpolated bigram models, one of the trusted documents and one of the whole corpus, share their vocabulary, their
list of bigrams and their smoothing. A document's score is the mean over its tokens of target loss minus background loss
(nats); below zero, it is more like the target.

Counts cover every document, every word and every pair of neighbouring words; nothing is too rare. So the model grows with
the corpus and is never gathered in one place. Documents are read once, into blocks of some million numbered words. Each
block sends its distinct pairs, with its own counts, to buckets of pairs; a bucket adds up what all blocks sent and answers
each block with the totals. Words go the same way. Buckets are asked in a few rounds, and what was sent is deleted once a
round's answers are stored; blocks are scored in as many. At last a block's documents meet the answers to that block. However common a pair, a block asks
for it once, and the number of buckets grows with the input; the bucket of the most common pair has one row of each block
more than its fair share, that of the most common word one of each block and bucket of pairs.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ascentframe.llm.common import deleted, groups_by_size, shuffles_dropped, with_trust
from ascentframe.session import shared_dir

DISCOUNT = 0.75
#: Words that a block gathers before it is closed; characters worked on at once; characters of the corpus for each bucket.
GATHERED = 1 << 19
GROUP = 1 << 20
BUCKET_CHARS = 1 << 22
#: Buckets are asked in so many rounds, every bucket in one of them: only the requests of one round are on disk at a time. Blocks
#: meet their answers in as many.
ROUNDS = 3
SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, ce_diff double"
#: Arrays are stored as their bytes, all but ids and checks compressed: lengths and places of words are int32, ids uint64
#: and checks uint32.
_BLOCKS = "block long, doc_ids array<long>, trusted array<boolean>, lengths binary, places binary, ids binary, checks binary, n long"
#: Ids of words (and their checks), or of pairs: each first word once with the number of its second words (runs, int32), and
#: the second words; counts of the block (int32), or in all (int64).
_REQUESTS = "bucket int, block long, one binary, two binary, target binary, background binary, runs binary"
#: kind: word or pair (totals for a block), used (what the listed pairs of some words take, for a bucket of words), or sum.
_ANSWERS = "kind string, bucket int, block long, one binary, two binary, target binary, background binary, known array<long>"
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Places(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def tokens_of(text: str | None) -> list[str]:
    """Words of a text between blanks and the codes 9 to 13, A-Z lowered."""
    return (text or "").encode("utf-8", "replace").lower().decode().translate(_GAPS).split(" ")


_GAPS = dict.fromkeys((9, 10, 11, 12, 13), " ")


def _array(parts, kind) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def _packed(values: np.ndarray, kind: str) -> bytes:
    return zlib.compress(values.astype(kind).tobytes(), 1)


def _unpacked(parts, kind: str) -> np.ndarray:
    return _array(map(zlib.decompress, parts), kind)


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return ((ids * _MIX) >> np.uint64(33)).astype(np.int64) % buckets


def _cuts(sorted_buckets: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of each run."""
    found, begins = np.unique(sorted_buckets, return_index=True)
    return list(zip(found.tolist(), begins.tolist(), [*begins[1:].tolist(), len(sorted_buckets)]))


def _block_writer(buckets: int, seed: int):
    """Blocks of whole documents; the words of a block stand in the order of their buckets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        places, doc_ids, trusted, lengths, found = _Places(), [], [], [], []

        def closed() -> pd.DataFrame:
            hashes = _array((xxhash.xxh3_128_digest(w.encode(), seed) for w in places), "<u8").reshape(-1, 2)
            order = np.argsort(_bucket(hashes[:, 0], buckets), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            own = rank[np.concatenate(found)] if len(order) else np.empty(0, np.int32)
            return pd.DataFrame({
                "block": [part << 32 | number], "doc_ids": [doc_ids], "trusted": [trusted],
                "lengths": [_packed(np.array(lengths), "<i4")], "places": [_packed(own, "<i4")],
                "ids": [hashes[order, 0].tobytes()], "checks": [hashes[order, 1].astype("<u4").tobytes()], "n": [len(own)],
            })

        held = 0
        for batch in batches:
            texts = batch["text"].tolist()
            ids = [None if pd.isna(x) else int(x) for x in batch["own_id"]]
            marks = batch["trusted"].tolist()
            for a, b in groups_by_size([len(x or "") for x in texts], GROUP):
                words: list[str] = []
                for text in texts[a:b]:
                    before = len(words)
                    words += [w for w in tokens_of(text) if w]
                    lengths.append(len(words) - before)
                found.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
                doc_ids += ids[a:b]
                trusted += marks[a:b]
                held += len(words)
                if held >= GATHERED:
                    yield closed()
                    places, doc_ids, trusted, lengths, found, held, number = _Places(), [], [], [], [], 0, number + 1
        if doc_ids:
            yield closed()

    return run


def _pairs(places: np.ndarray, lengths: np.ndarray, ids: np.ndarray, buckets: int):
    """Distinct pairs of a block in the order of their buckets, then of their places (first and second place, bucket), where
    a pair ends (not at a document's first word), and which pair that is."""
    inner = np.ones(len(places), bool)
    starts = np.cumsum(lengths) - lengths
    inner[starts[lengths > 0]] = False
    at = np.flatnonzero(inner)
    size = max(len(ids), 1)
    keys, which = np.unique(places[at - 1].astype(np.int64) * size + places[at], return_inverse=True)
    first, second = keys // size, keys % size
    bucket = _bucket(ids[first] * _MIX + (ids[second] ^ (ids[second] >> np.uint64(31))), buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return first[order], second[order], bucket[order], inner, rank[which]


def _opened(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _unpacked([row.lengths], "<i4").astype(np.int64), _unpacked([row.places], "<i4"), np.frombuffer(row.ids, "<u8")


def _requests(buckets: int, of_pairs: bool, turn: int):
    """What each block asks the buckets of a round for: its words, or its pairs, with its own counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                lengths, places, ids = _opened(row)
                flags = np.repeat(np.array(row.trusted, bool), lengths)
                if of_pairs:
                    first, second, bucket, inner, which = _pairs(places, lengths, ids, buckets)
                    one, two, flags = ids[first], ids[second], flags[inner]
                else:
                    one, two, bucket, which = ids, np.frombuffer(row.checks, "<u4"), _bucket(ids, buckets), places
                counts = [np.bincount(which[flags], minlength=len(one)), np.bincount(which, minlength=len(one))]
                rows = []
                for k, a, b in _cuts(bucket):
                    if k % ROUNDS != turn:
                        continue
                    own, runs = one[a:b], None
                    if of_pairs:  # second words of a first word stand together
                        heads = _runs(own)
                        own, runs = own[heads], _packed(np.diff(np.append(heads, b - a)), "<i4")
                    rows.append((k, row.block, own.tobytes(), two[a:b].tobytes(), *(_packed(x[a:b], "<i4") for x in counts), runs))
                yield pd.DataFrame(rows, columns=["bucket", "block", "one", "two", "target", "background", "runs"])

    return run


def _runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new key begins."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.flatnonzero(new)


def _answers(rows: list) -> pd.DataFrame:
    names = ["kind", "bucket", "block", "one", "two", "target", "background"]
    return pd.DataFrame([(*r[:7], r[7] if len(r) > 7 else None) for r in rows], columns=[*names, "known"])


def _pair_totals(buckets: int):
    """Adds up one bucket of pairs, answers its blocks, and tells the buckets of words what the pairs of a word take."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        first, second = np.repeat(_array(group["one"], "<u8"), _unpacked(group["runs"], "<i4")), _array(group["two"], "<u8")
        order = np.lexsort((second, first))
        begins = _runs(first[order], second[order])
        sizes = np.diff(np.append(begins, len(order)))
        sums, back = [], []
        for name in ("target", "background"):
            counts = _unpacked(group[name], "<i4").astype(np.int64)
            sums.append(np.add.reduceat(counts[order], begins))
            whole = np.empty(len(order), np.int64)
            whole[order] = np.repeat(sums[-1], sizes)
            back.append(whole)
        ends = np.cumsum([len(x) // 8 for x in group["two"]])
        bucket = int(group["bucket"].iloc[0])
        rows = [
            ("pair", bucket, block, None, None, _packed(back[0][a:b], "<i8"), _packed(back[1][a:b], "<i8"))
            for block, a, b in zip(group["block"].tolist(), [0, *ends[:-1].tolist()], ends.tolist())
        ]
        words = first[order][begins]
        heads = _runs(words)
        used = [np.add.reduceat(np.maximum(x - DISCOUNT, 0), heads) for x in sums]
        words = words[heads]
        to = _bucket(words, buckets)
        order = np.argsort(to, kind="stable")
        for k, a, b in _cuts(to[order]):
            some = order[a:b]
            rows.append(("used", k, None, words[some].tobytes(), None, _packed(used[0][some], "<f8"), _packed(used[1][some], "<f8")))
        return _answers(rows)

    return run


def _merged_used(group: pd.DataFrame) -> pd.DataFrame:
    """What the pairs of a round take of the words of one bucket, each word once."""
    ids, where = np.unique(_array(group["one"], "<u8"), return_inverse=True)
    sums = [_packed(np.bincount(where, _unpacked(group[name], "<f8"), len(ids)), "<f8") for name in ("target", "background")]
    return _answers([("used", int(group["bucket"].iloc[0]), None, ids.tobytes(), None, *sums)])


def _word_totals(group: pd.DataFrame) -> pd.DataFrame:
    """Adds up one bucket of words and answers its blocks; its sum row has in `known` the number of words, their counts, and
    how many words share the id of another."""
    asked, taken = group[group["kind"] == "word"], group[group["kind"] == "used"]
    ids, begins, where = np.unique(_array(asked["one"], "<u8"), return_index=True, return_inverse=True)
    checks = _array(asked["two"], "<u4")
    sums = []
    for name in ("target", "background"):
        counts = _unpacked(asked[name], "<i4")
        sums.append(np.bincount(where, counts, len(ids)).astype(np.int64))
    at = np.searchsorted(ids, _array(taken["one"], "<u8"))
    used = [np.bincount(at, _unpacked(taken[name], "<f8"), len(ids)) for name in ("target", "background")]
    ends = np.cumsum([len(x) // 8 for x in asked["one"]])
    bucket = int(group["bucket"].iloc[0])
    rows = []
    for block, a, b in zip(asked["block"].tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
        some = where[a:b]
        rows.append(("word", bucket, int(block), *(_packed(x[some], "<f8") for x in used), *(_packed(x[some], "<i8") for x in sums)))
    known = [len(ids), sums[0].sum(), sums[1].sum(), (checks != checks[begins][where]).sum()]
    rows.append(("sum", bucket, None, None, None, None, None, [int(x) for x in known]))
    return _answers(rows)


def _scorer(buckets: int, size: int, totals: list[int]):
    """Scores of the documents of one block from the answers to it; `size` words and one more share what is smoothed."""

    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = next(blocks.itertuples())
        lengths, places, ids = _opened(row)
        first, second, _, inner, which = _pairs(places, lengths, ids, buckets)
        answers = answers.sort_values("bucket")
        words, pairs = answers[answers["kind"] == "word"], answers[answers["kind"] == "pair"]
        losses = []
        for k, (name, taken) in enumerate((("target", "one"), ("background", "two"))):
            counts = _unpacked(words[name], "<i8")
            share = (counts + 1.0) / (totals[k] + size)
            seen = np.maximum(counts, 1)
            left = np.maximum(1 - _unpacked(words[taken], "<f8") / seen, 1e-12)  # what the pairs of a word leave
            held = np.maximum(_unpacked(pairs[name], "<i8") - DISCOUNT, 0)
            loss = -np.log(share)[places]
            loss[inner] = -np.log(held / seen[first] + left[first] * share[second])[which]
            losses.append(loss)
        sums = np.concatenate([np.zeros((1, 2)), np.cumsum(np.stack(losses, axis=1), axis=0)])
        ends = np.cumsum(lengths)
        mean = (sums[ends] - sums[ends - lengths]) / np.maximum(lengths, 1)[:, None]
        return pd.DataFrame({
            "doc_id": pd.array(list(row.doc_ids), "Int64"), "n_tokens": lengths,
            "target_loss": mean[:, 0], "background_loss": mean[:, 1], "ce_diff": mean[:, 0] - mean[:, 1],
        })

    return run


def difference(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and ce_diff (means over the tokens) of each row of `docs`.

    Both models are made of all rows of `docs` (doc_id, text); trusted rows are those that `labels` call good. NULL and
    wordless texts have no tokens and zeros; repeated rows come out repeatedly.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/bigrams-{uuid.uuid4().hex}"

    def stored(frame: DataFrame, name: str) -> DataFrame:
        with shuffles_dropped(spark):
            frame.write.mode("append").parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 + chars // BUCKET_CHARS
    rows = docs.select("doc_id", F.col("doc_id").cast("long").alias("own_id"), "text")
    marked = with_trust(rows, labels, "trusted", "own_id", "text")
    for seed in count():
        blocks = stored(marked.mapInPandas(_block_writer(buckets, seed), _BLOCKS), f"blocks-{seed}")
        turns = range(min(ROUNDS, buckets))
        for turn in turns:
            asked = blocks.mapInPandas(_requests(buckets, True, turn), _REQUESTS)
            both = stored(asked.groupBy("bucket").applyInPandas(_pair_totals(buckets), _ANSWERS), f"both-{seed}-{turn}")
            pairs = stored(both.where("kind = 'pair'"), f"pairs-{seed}")
            used = stored(both.where("kind = 'used'").groupBy("bucket").applyInPandas(_merged_used, _ANSWERS), f"used-{seed}")
            deleted(spark, f"{folder}/both-{seed}-{turn}")
        for turn in turns:
            asked = blocks.mapInPandas(_requests(buckets, False, turn), _REQUESTS).withColumn("kind", F.lit("word")).drop("runs")
            asked = asked.unionByName(used.where(F.col("bucket") % ROUNDS == turn), allowMissingColumns=True)
            words = stored(asked.groupBy("bucket").applyInPandas(_word_totals, _ANSWERS), f"words-{seed}")
        deleted(spark, f"{folder}/used-{seed}")
        known = words.where("kind = 'sum'").agg(*[F.coalesce(F.sum(F.get("known", F.lit(k))), F.lit(0)).alias(f"k{k}") for k in range(4)]).first()
        if not known.k3:  # else two words share an id, and other hashes are taken
            break
    answers = words.where("kind = 'word'").unionByName(pairs)
    own = blocks.select("block", "doc_ids", "lengths", "places", "ids")
    score = _scorer(buckets, known.k0 + 1, [known.k1, known.k2])
    for turn in range(ROUNDS):
        mine = F.pmod(F.hash("block"), F.lit(ROUNDS)) == turn
        met = own.where(mine).groupBy("block").cogroup(answers.where(mine).groupBy("block"))
        scores = stored(met.applyInPandas(score, SCORES), "scores")
    return scores
