import re

import xxhash
from messy import clashing, docs, rows_of

from ascentframe.llm import simhash as S
from ascentframe.llm.common import table


def print_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [print_of(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return [(i, f"{p:016x}", least.get(find(p))) for (i, _), p in zip(rows, prints)]


def test_messy_rows(spark):
    frame = docs(spark)
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert rows_of(S.components(frame), "doc_id", "fingerprint", "component_id") == sorted(brute(rows), key=repr)
    one = S.keep_one(clashing(frame))
    assert one.columns == clashing(frame).columns
    groups = {c if c is not None else ("none", p) for _, p, c in brute(rows)}
    assert one.count() == len(groups)
    assert {r.doc_id for r in one.collect() if r.doc_id} == {c for _, _, c in brute(rows) if c}


def test_empty_table(spark):
    assert S.components(docs(spark, [])).count() == 0
    assert S.keep_one(docs(spark, [])).count() == 0


def test_given_table_against_brute_force(spark):
    frame = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert rows_of(S.components(frame), "doc_id", "fingerprint", "component_id") == sorted(brute(rows), key=repr)


def test_links_of_all_distances(spark):
    base = 0x0123456789ABCDEF
    prints = [base, base ^ 1, base ^ 3, base ^ 7, base ^ 15, base ^ 31 << 40, (base ^ 1 << 63) - (1 << 64), -1, 0]
    frame = spark.createDataFrame([(k, p if p < 1 << 63 else p - (1 << 64)) for k, p in enumerate(prints)], "doc_id long, fp long")
    found = {r.fp: r.component_id for r in S.label(frame).collect()}
    by_id = {k: found[p if p < 1 << 63 else p - (1 << 64)] for k, p in enumerate(prints)}
    assert by_id == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 5, 6: 0, 7: 7, 8: 8}


def test_long_chains_and_hubs(spark):
    chain = [(k, k + 1) for k in range(60)]
    hub = [(1000, 1000 + k) for k in range(1, 300)]
    frame = spark.createDataFrame(chain + hub, "a long, b long")
    found = {r.node: r.root for r in S.roots(frame).collect()}
    assert found == {**{k: 0 for k in range(1, 61)}, **{1000 + k: 1000 for k in range(1, 300)}}
