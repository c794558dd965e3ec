import math
import random
import re
from collections import Counter

import numpy as np
from messy import LONG, TEXTS, clashing, docs, rows_of

from ascentframe.llm import lexical_search as L
from ascentframe.llm.common import table

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in PATTERN.findall(text or "")]


def plain(rows, items, top=20):
    """Every document scored for every item; rows (doc_id, text), items (item_id, text)."""
    own = [(i, Counter(t), len(t)) for i, t in ((i, terms(x)) for i, x in rows) if t]
    number, length = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for doc, counts, n in own:
            m = 100 - 25 + (25 * n * number) // length
            score = 0
            for t in terms(text):
                if tf := counts[t]:
                    score += math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top])]
    return sorted(out, key=repr)


def result(frame, items, **kw):
    return rows_of(L.search(frame, items, **kw), "item_id", "rank", "doc_id", "score")


def test_messy_rows(spark):
    items = [(1, "The QUICK brown fox"), (1, "The QUICK brown fox"), (1, "dog"), (2, None), (3, " ,;"), (None, "words on, words on"), (4, "é漢字 x nowhere"), (5, LONG)]
    frame = spark.createDataFrame(items, ITEMS)
    asked = [(i, t) for i, t in items]
    assert result(docs(spark), frame) == plain(TEXTS, asked)
    assert result(clashing(docs(spark)), clashing(frame)) == plain(TEXTS, asked)
    assert result(docs(spark), frame, top=2) == plain(TEXTS, asked, 2)
    assert L.search(docs(spark, []), frame).count() == 0
    assert L.search(docs(spark), spark.createDataFrame([], ITEMS)).count() == 0
    assert L.search(docs(spark), spark.createDataFrame([(1, " "), (2, None)], ITEMS)).count() == 0


def test_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    frame, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    expected = plain([(r.doc_id, r.text) for r in frame.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert result(frame, items) == expected


def test_small_shards_groups_and_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(L, "GROUP_TERMS", 12)
    monkeypatch.setattr(L, "BLOCK_CHARS", 300)
    rng = random.Random(2)
    some = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(some) for _ in range(rng.randrange(0, 40)))) for i in range(700)]
    items = [(i, " ".join(rng.choice(some) for _ in range(rng.randrange(1, 9)))) for i in range(40)]
    assert result(docs(spark, rows).repartition(3), spark.createDataFrame(items, ITEMS)) == plain(rows, items)


def shard(rows, items):
    """Index and coded items of rows (doc_id, text) in one shard, with every term's value 1000 times its count."""
    asked = {t: k for k, t in enumerate(sorted({t for x in items for t in L.terms_of(x)}))}
    found = [Counter(t for t in L.terms_of(text) if t in asked) for _, text in rows]
    first = np.cumsum([0, *map(len, found)])
    numbers = np.array([asked[t] for f in found for t in f], np.int64)
    values = np.array([1000 * c for f in found for c in f.values()], np.int64)
    coded = [tuple(np.array(x, np.int64) for x in zip(*sorted((asked[t], 3 * c) for t, c in Counter(L.terms_of(x)).items()))) for x in items]
    (group,) = L.grouped(coded)
    return L.Index(first, numbers, values, group), group


def test_blocks_are_skipped_and_bounds_are_bounds():
    rng = random.Random(1)
    topics = [[f"t{k}w{j}" for j in range(20)] for k in range(20)]
    rows = [(i, "common " + " ".join(rng.choices(topics[i % 20], k=12))) for i in range(4000)]
    items = ["common " + " ".join(t[:6]) for t in topics]
    index, group = shard(rows, items)
    ids, unnamed = np.arange(len(rows)), np.zeros(len(rows), bool)
    scored = 0
    for number, places, weights in group.members:
        best = L.Best(len(items), 20)
        scored += index.search(number, places, weights, best, ids, unnamed)
        columns = index.column[places]
        scores = index.table[:, columns].astype(np.int64) @ weights
        order = np.lexsort((ids, -scores))[:20]
        assert best.held[number][1].tolist() == order.tolist() and best.held[number][0].tolist() == scores[order].tolist()
    assert scored < 0.25 * len(items) * len(rows)  # the list of the common word holds all documents
    for rows_in, starts, columns, summaries in index.lists:
        for a, b, summary in zip(starts, [*starts[1:], len(rows_in)], summaries):
            assert (index.table[rows_in[a:b]][:, columns].max(axis=0) == summary).all()


def test_large_groups_of_copies_rank_by_id(spark):
    rows = [(i, "same words in all of them") for i in range(3000, 0, -1)] + [(9000, "same words")]
    items = [(1, "same words"), (2, "in of")]
    assert result(docs(spark, rows).repartition(4), spark.createDataFrame(items, ITEMS)) == plain(rows, items)
