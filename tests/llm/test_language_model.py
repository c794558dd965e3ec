import glob
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from messy import clashing, docs, labels

from ascentframe.llm import language_model as M
from ascentframe.llm.common import DROP_SHUFFLES, shuffles_dropped, table


def tokens(text):
    return [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]


def brute(rows, good, share):
    """(tokens, target loss, background loss) of each row, by plain dictionaries."""
    texts, flags = [tokens(t) for _, t in rows], [i in good for i, _ in rows]
    corpus = Counter(w for t in texts for w in t)
    total = sum(corpus.values())
    known = {w for w, c in corpus.items() if c >= share * total}
    pairs = lambda keep: Counter((a, b) for t, g in zip(texts, flags) if keep or g for a, b in zip(t, t[1:]) if a in known and b in known)
    both, only = pairs(True), pairs(False)
    listed = {k for k, c in both.items() if c >= share * total}

    def model(singles, doubles):
        count = Counter()
        for w, c in singles.items():
            count[w if w in known else None] += c
        size, n = len(known) + 1, sum(count.values())
        single = lambda w: (count[w] + 1) / (n + size)
        used = Counter()
        for a, b in listed:
            used[a] += max(doubles[a, b] - M.DISCOUNT, 0)

        def loss(text):
            result, last = 0.0, None
            for k, w in enumerate(w if w in known else None for w in text):
                p = single(w)
                if k:
                    seen = max(count[last], 1)
                    p *= max(1 - used[last] / seen, 1e-12)
                    if (last, w) in listed:
                        p += max(doubles[last, w] - M.DISCOUNT, 0) / seen
                result -= math.log(p)
                last = w
            return result / max(1, len(text))

        return loss

    target = model(Counter(w for t, g in zip(texts, flags) if g for w in t), only)
    background = model(corpus, both)
    return [(len(t), target(t), background(t)) for t in texts]


def same(got, rows, wanted):
    by_row = sorted(zip(rows, wanted), key=lambda x: (repr(x[0][0]), x[1]))
    mine = sorted(got, key=lambda r: (repr(r.doc_id), r.n_tokens, r.target_loss))
    assert len(mine) == len(by_row)
    for r, ((i, _), (n, t, b)) in zip(mine, by_row):
        assert (r.doc_id, r.n_tokens) == (i, n)
        assert (r.target_loss, r.background_loss, r.ce_diff) == pytest.approx((t, b, t - b), abs=1e-9)


def shuffles_of(spark):
    """Names of the shuffle files of the session, wherever it keeps them."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for k in range(len(folders)) for f in glob.glob(f"{folders[k].getPath()}/**/shuffle_*", recursive=True)}


def test_messy_rows(spark):
    frame = docs(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    same(M.difference(clashing(frame), labels(spark)).collect(), rows, brute(rows, {1, 99}, 0))
    same(M.difference(frame, labels(spark, [])).collect(), rows, brute(rows, set(), 0))
    assert M.difference(docs(spark, []), labels(spark)).count() == 0


def test_given_table(spark, monkeypatch):
    monkeypatch.setattr(M, "GATHERED", 1000)
    d = "/root/testdata/sf0.001"
    frame, marks = table(spark, d, "documents"), table(spark, d, "labels")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    good = {r.doc_id for r in marks.collect() if r.quality == 1}
    same(M.difference(frame, marks).collect(), rows, brute(rows, good, 0))


def test_no_word_or_pair_is_too_rare(spark, monkeypatch):
    """Words and pairs that stand once among 600,000 words, below the share that was once needed (2e-6)."""
    monkeypatch.setattr(M, "GATHERED", 100_000)
    monkeypatch.setattr(M, "BUCKET_CHARS", 1_000_000)
    rows = [(k, "common words fill most of it " * 1000) for k in range(100)] + [(k, f"common rare{k} twin{k} words rare{k} twin{k}") for k in range(100, 104)]
    rows += [(200, "rare100 twin100 words"), (201, None), (None, "twin100 rare100")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = labels(spark, [(k, 1, 0) for k in (1, 100, 101)])
    same(M.difference(frame, marks).collect(), rows, brute(rows, {1, 100, 101}, 0))


def test_a_first_word_is_sent_once_and_shuffles_go_with_their_write(spark, monkeypatch, tmp_path):
    """First words of a bucket once each, and no shuffle files left by what was stored."""
    ids = M._array((M.xxhash.xxh3_128_digest(w.encode(), 0) for w in "ab"), "<u8").reshape(-1, 2)
    block = pd.DataFrame({
        "block": [7], "trusted": [[True]], "lengths": [M._packed(np.array([6]), "<i4")],
        "places": [M._packed(np.array([0, 0, 1, 0, 1, 1]), "<i4")], "ids": [ids[:, 0].tobytes()], "checks": [ids[:, 1].astype("<u4").tobytes()],
    })
    (sent,) = M._requests(1, True, 0)(iter([block]))
    assert [len(x) for x in (sent["one"][0], sent["two"][0])] == [16, 32]
    assert M._unpacked(sent["runs"], "<i4").tolist() == [2, 2]
    assert M._unpacked(sent["background"], "<i4").tolist() == [1, 2, 1, 1]

    asked = [next(M._requests(50, False, k)(iter([block])))["bucket"].tolist() for k in range(M.ROUNDS)]  # each bucket in one round
    assert sorted(sum(asked, [])) == sorted(set(M._bucket(ids[:, 0], 50).tolist()))

    before = spark.conf.get(DROP_SHUFFLES, None)
    rows = spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()
    with shuffles_dropped(spark):
        known = shuffles_of(spark)
        rows.write.parquet(str(tmp_path / "rows"))
    assert shuffles_of(spark) <= known
    assert spark.conf.get(DROP_SHUFFLES, None) == before


def test_what_pairs_take_is_sent_once_for_each_word():
    ids = [np.array(x, "<u8").tobytes() for x in ([3, 5], [5, 9])]
    taken = [M._packed(np.array(x), "<f8") for x in ([0.25, 1.25], [2.25, 0.25])]
    merged = M._merged_used(pd.DataFrame({"bucket": [4, 4], "one": ids, "target": taken, "background": taken}))
    assert (merged["kind"].tolist(), merged["bucket"].tolist()) == (["used"], [4])
    assert M._array(merged["one"], "<u8").tolist() == [3, 5, 9]
    assert M._unpacked(merged["background"], "<f8").tolist() == [0.25, 3.5, 0.25]
