import math
import re
from collections import Counter

import pytest
import xxhash
from messy import LONG, clashing, docs, labels, rows_of

from ascentframe.llm import quality_rules as Q
from ascentframe.llm.common import table

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    text = text or ""
    w = words_of(text)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i : i + 5]), []).append(i)
    repeated = {k for v in places.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def buckets(text):
    w = [x.encode() for x in words_of(text)]
    one = [xxhash.xxh64_intdigest(x, 42) for x in w]
    two = [xxhash.xxh64_intdigest(b, h) for h, b in zip(one, w[1:])]
    return [h % Q.BUCKETS for h in one + two]


def brute(rows, good):
    """(doc_id, counts..., base_failed, kept) of each row, by plain loops."""
    corpus, target = Counter(), Counter()
    for i, t in rows:
        corpus.update(buckets(t))
        if i in good:
            target.update(buckets(t))
    share = sum(target.values()) / max(1, sum(corpus.values()))
    out = []
    for i, t in rows:
        counts, grams = base(t), buckets(t)
        ratio = [math.log((target[b] + Q.SMOOTHING * share) / ((corpus[b] + Q.SMOOTHING) * share)) if share else 0.0 for b in grams]
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        out.append((i, *counts, failed, not failed and sum(ratio) / max(1, len(ratio)) >= Q.THRESHOLD))
    return sorted(out, key=repr)


def test_messy_rows_and_clashing_columns(spark):
    frame = docs(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = rows_of(Q.judge(frame, labels(spark)).select("doc_id", "judged.*"), *COLUMNS)
    assert got == brute(rows, {1, 99})
    kept = Q.keep(clashing(frame), labels(spark))
    assert kept.columns == clashing(frame).columns
    assert rows_of(kept, "doc_id") == sorted([(r[0],) for r in brute(rows, {1, 99}) if r[-1]], key=repr)
    assert any(len(t or "") == len(LONG) for _, t in rows)


def test_empty_tables(spark):
    none = docs(spark, [])
    assert Q.judge(none, labels(spark)).count() == 0
    without = Q.judge(docs(spark), labels(spark, [])).select("judged.*")
    assert {r.llr for r in without.select("llr").collect()} == {0.0}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_given_table_against_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    frame, marks = table(spark, d, "documents"), table(spark, d, "labels")
    good = {r.doc_id for r in marks.collect() if r.quality == 1}
    got = rows_of(Q.judge(frame, marks).select("doc_id", "judged.*"), *COLUMNS)
    assert got == brute([(r.doc_id, r.text) for r in frame.collect()], good)


def test_good_documents_stay_and_junk_goes(spark):
    d = "/root/testdata/sf0.01"
    judged = Q.judge(table(spark, d, "documents"), table(spark, d, "labels").where("doc_id % 2 = 0")).select("doc_id", "judged.*")
    rest = judged.where("not base_failed").join(table(spark, d, "labels").where("doc_id % 2 = 1"), "doc_id").collect()
    wrong = [r for r in rest if r.kept != (r.quality == 1)]
    assert len(rest) > 150 and len(wrong) <= 0.02 * len(rest)
