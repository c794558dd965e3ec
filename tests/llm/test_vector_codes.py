import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ascentframe.llm import vector_codes as V
from ascentframe.llm.common import table

COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """The same by full distance tables: rows (vec_id, vector, label) of one length."""
    kept = [(i, np.floor(np.array(v, np.float32).astype(float) * 1024).astype(np.int64), label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: r[0])
    data = np.array([v for _, v, _ in kept])
    parts = np.split(data, V.PARTS, axis=1)
    books = [p[: V.ENTRIES].copy() for p in parts]

    def assign():
        tables = [((p[:, None] - b) ** 2).sum(axis=2) for p, b in zip(parts, books)]
        return [t.argmin(axis=1) for t in tables], sum(t.min(axis=1) for t in tables)

    for _ in range(V.ROUNDS):
        for book, part, own in zip(books, parts, assign()[0]):
            for k in range(len(book)):
                if (own == k).any():
                    book[k] = part[own == k].sum(axis=0) // (own == k).sum()
    codes, errors = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e.tolist()).encode()).hexdigest()
    totals: dict = {}
    for (_, _, label), e in zip(kept, errors.tolist()):
        totals[label] = totals.get(label, 0) + e
    return [(i, "".join(f"{c[k]:02x}" for c in codes), int(errors[k]), totals[label], digest) for k, (i, _, label) in enumerate(kept)]


def result(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in V.compress(frame).collect()), key=repr)


def test_given_table(spark):
    frame = table(spark, "/root/testdata/sf0.01", "embeddings")
    assert result(frame) == sorted(plain([tuple(r) for r in frame.collect()]), key=repr)


def test_clustered_vectors_with_gaps_in_the_rows(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(0, 0.3, (12, 8))
    rows = [(i, (middles[i % 12] + rng.normal(0, 0.02, 8)).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in range(900)]
    rows += [(1000 + i, rows[5][1], 7) for i in range(300)]  # copies
    bad = [(-3, None, 1), (-2, [None] + [0.0] * 7, 1), (-1, [float("nan")] * 8, 1), (2000, [float("inf")] + [0.0] * 7, None)]
    frame = spark.createDataFrame(rows + bad, SCHEMA).withColumn("code", F.lit("clash")).withColumn("x", F.lit(1)).repartition(5)
    assert result(frame) == sorted(plain(rows + bad), key=repr)


def test_few_vectors_repeated_rows_and_nulls(spark):
    rows = [(1, [0.5, -0.5, 0.25, 0.0], None), (1, [0.5, -0.5, 0.25, 0.0], None), (2, [0.5, -0.5, 0.25, 0.0], 3), (None, [1.0, 1.0, 1.0, -1.0], 3)]
    got = V.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 4 and {r.vec_id for r in got} == {1, 2, None}
    assert all(r.error == 0 and r.label_error == 0 for r in got)
    assert {r.vec_id: r.code for r in got} == {1: "00000000", 2: "00000000", None: "02020202"}
    assert V.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert V.compress(spark.createDataFrame([(1, None, 2)], SCHEMA)).count() == 0


def test_lengths(spark):
    rows = [(1, [0.5, 0.25, 0.125, 1.0, 2.0], 1), (2, [0.25] * 5, 1), (3, [0.5], 1), (4, [], 1), (5, [1e30, -1e30, 0.0, 0.0, 0.0], 1)]
    got = {r.vec_id: r for r in V.compress(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[3].code is None and got[3].error is None and got[4].code is None and got[3].label_error == 0
    assert [got[i].code for i in (1, 2, 5)] == ["00000000", "01010100", "02020200"] and got[5].error == 0
    only_empty = V.compress(spark.createDataFrame([(1, [], 1)], SCHEMA)).collect()
    assert [(r.code, r.error) for r in only_empty] == [("00000000", 0)]


@pytest.mark.parametrize("spread", [0.01, 0.2, 5.0])
def test_cells_drop_only_what_can_be_nearest_to_no_point(spread):
    rng = np.random.default_rng(3)
    entries = np.floor(rng.normal(0, 200, (256, 4))).astype(np.int64)
    entries[7] = entries[200]  # a tie goes to the lower number
    parts = np.concatenate([entries, np.floor(rng.normal(0, 200 * spread, (5000, 4))).astype(np.int64), entries[[200] * 9]])
    cells = V.Cells(entries)
    away = ((parts[:, None] - entries) ** 2).sum(axis=2)
    for run in (slice(0, 3000), slice(1000, None)):  # the second meets cells of the first
        best, distance = cells.nearest(parts[run])
        assert (best == away[run].argmin(axis=1)).all() and (distance == away[run].min(axis=1)).all()
    assert 0 < cells.count.mean() < 200 and len(cells) == len(cells.count) < len(parts)


def test_memory_of_cells_is_bounded(monkeypatch):
    monkeypatch.setattr(V, "REMEMBERED", 50)
    rng = np.random.default_rng(4)
    entries = np.floor(rng.normal(0, 100, (64, 3))).astype(np.int64)
    cells = V.Cells(entries)
    for _ in range(5):
        parts = np.floor(rng.normal(0, 100, (200, 3))).astype(np.int64)
        assert (cells.nearest(parts)[0] == ((parts[:, None] - entries) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert len(cells) <= 250


def test_codes_give_vectors_back(spark):
    frame = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = V.integers(frame)
    books = V.fit(rows)
    back = {r.vec_id: np.array(r.vector) for r in V.decode(V.encode(rows, books), books).collect()}
    errors = {r.vec_id: r.error for r in V.encode(rows, books).collect()}
    for r in rows.collect():
        assert round(((back[r.vec_id] * V.SCALE - np.array(r.x)) ** 2).sum()) == errors[r.vec_id]
