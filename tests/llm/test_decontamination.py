import re

from messy import LONG, TEXTS, clashing, docs, rows_of

from ascentframe.llm import decontamination as D
from ascentframe.llm.common import table

ITEMS = "item_id long, text string"


def shingles(text, width):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if width else set()


def brute(rows, items, share=0.8):
    out = []
    for k, item in items:
        width = min(5, len(re.findall(r"[^\W_]+", (item or "").lower())))
        own = shingles(item, width)
        for i, text in rows:
            shared = len(own & shingles(text, width))
            if own and shared >= share * len(own):
                out.append((i, k, len(own), shared, shared / len(own)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "item_id", "item_shingles", "shared", "containment"]


def test_messy_rows_items_and_blocks(spark, monkeypatch):
    words = [f"w{k}" for k in range(40)]
    item = " ".join(words)
    rows = [*TEXTS, (20, "before " + item + " after"), (21, " ".join(words[:33])), (22, " ".join(words[:30])), (23, LONG + item.upper())]
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "x"), (5, "quick brown"), (None, "lazy dog while"), (6, "... !!")]
    frame, tests = docs(spark, rows), spark.createDataFrame(items, ITEMS)
    expected = brute(rows, items)
    assert {r[0] for r in expected if r[1] == 1} == {20, 21, 23}
    assert rows_of(D.find(frame, tests), *COLUMNS) == expected
    monkeypatch.setattr(D, "BLOCK_CHARS", 60)
    assert rows_of(D.find(frame, tests), *COLUMNS) == expected
    left = D.keep_clean(clashing(frame), tests)
    assert left.columns == clashing(frame).columns
    dirty = {r[0] for r in expected}
    assert rows_of(left, "doc_id") == sorted([(i,) for i, t in rows if not brute([(i, t)], items)], key=repr)
    assert dirty


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert D.find(docs(spark), none).count() == 0
    assert D.keep_clean(docs(spark), none).count() == len(TEXTS)
    assert D.find(docs(spark, []), spark.createDataFrame([(1, "a b c")], ITEMS)).count() == 0


def test_sample_always_meets():
    for n in range(1, 400):
        missing = n - -(-8 * n // 10)  # at most so many shingles are missing at a share of 0.8
        assert D.sample_size(n, 0.8) > missing or D.sample_size(n, 0.8) == n


def test_given_tables(spark):
    d = "/root/testdata/sf0.001"
    frame, tests = table(spark, d, "documents"), table(spark, d, "benchmark")
    expected = brute([(r.doc_id, r.text) for r in frame.collect()], [(r.item_id, r.text) for r in tests.collect()])
    assert expected and rows_of(D.find(frame, tests), *COLUMNS) == expected
