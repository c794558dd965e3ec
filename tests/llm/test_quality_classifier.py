import math
import re
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
from messy import clashing, docs, labels, rows_of

from ascentframe.llm import quality_classifier as C
from ascentframe.llm.common import table


def test_messy_rows_and_few_labels(spark):
    for marks in (labels(spark), labels(spark, [])):
        got = C.score(docs(spark), marks).collect()
        assert len(got) == docs(spark).count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert {r.predicted for r in C.score(docs(spark), labels(spark, [])).collect()} == {1}
    assert C.keep_good(docs(spark), labels(spark, [])).count() == docs(spark).count()
    assert C.score(docs(spark, []), labels(spark)).count() == 0
    kept = C.keep_good(clashing(docs(spark)), labels(spark))
    assert kept.columns == clashing(docs(spark)).columns
    kept.collect()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    marks = table(spark, d, "labels")
    rows = C.score(table(spark, d, "documents"), marks).join(marks, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.98
    good = sorted(r.score for r in rows if r.quality == 1)
    bad = [r.score for r in rows if r.quality == 0]
    below = np.mean([np.searchsorted(good, b, "left") + np.searchsorted(good, b, "right") for b in bad]) / 2 / len(good)
    assert 1 - below > 0.99


def test_held_out_labels_are_never_used(spark):
    d = "/root/testdata/sf0.001"
    frame, marks = table(spark, d, "documents"), table(spark, d, "labels")
    turned = marks.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality", "toxic")
    assert rows_of(C.score(frame, marks), "doc_id", "score") == rows_of(C.score(frame, turned), "doc_id", "score")


def test_sums_and_isotonic_against_plain_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, len(C.STATISTICS)))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(int)
    frame = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "stats array<double>, quality int").repartition(5)
    mean, scale = C._moments(frame)
    assert np.allclose(mean, x.mean(0)) and np.allclose(scale, x.std(0))
    z = C._lift(x, mean, scale)
    penalty = np.diag([C.RIDGE * 400] * C.FEATURES + [1e-9 * 400])
    assert np.allclose(z @ C._weights(frame, mean, scale)[0], z @ np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)
    centres, values = C.pool_adjacent(np.array([0.0, 1, 2, 3]), np.array([0.5, 0.1, 0.9, 0.8]), np.ones(4))
    assert centres.tolist() == [0.5, 2.5] and np.allclose(values, [0.3, 0.85])


def plain_statistics(text):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return [0.0] * 16
    n, size = len(words), len(data)
    lines = [x for x in data.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", x)]
    share = lambda signs: sum(c in signs for c in data) / size
    return [
        math.log1p(n), math.log1p(size), min(size / n, 100.0), len(set(words)) / n, max(Counter(words).values()) / n,
        1 - len({(a, b) for a, b in zip(words, words[1:])}) / (n - 1) if n > 1 else 0.0, math.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines), share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share(b"0123456789"), share(b"#*$%&|<>{}[]\\^~_=+@"),
        share(b".,;:!?'\"()-"), sum(c > 127 for c in data) / size, sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / len(lines),
        -sum(c / size * math.log2(c / size) for c in Counter(data).values()), max(len(list(g)) for _, g in groupby(words)) / n,
    ]


def plain_scores(rows, marks):
    """Every score by plain loops and whole matrices: rows (doc_id, text), marks {doc_id: quality}."""
    part = lambda i: zlib.crc32(str(i).encode()) % 4
    stats = np.array([plain_statistics(t) for _, t in rows])
    known = [k for k, (i, _) in enumerate(rows) if i in marks and part(i) != 2]
    fit = [k for k in known if part(rows[k][0]) in (0, 1)]
    check = [k for k in known if part(rows[k][0]) == 3]
    label = lambda some: np.array([marks[rows[k][0]] for k in some], float)
    mean, scale = stats[fit].mean(axis=0), stats[fit].std(axis=0)
    scale[scale <= 1e-9] = 1.0
    directions, phases = C._projection()
    lifted = np.hstack([np.sqrt(2 / C.FEATURES) * np.cos((stats - mean) / scale @ directions + phases), np.ones((len(rows), 1))])
    penalty = np.diag([C.RIDGE * len(fit)] * C.FEATURES + [1e-9 * len(fit)])
    raw = lifted @ np.linalg.solve(lifted[fit].T @ lifted[fit] + penalty, lifted[fit].T @ label(fit))
    bins = {}
    for k, y in zip(check, label(check)):
        bins.setdefault(math.floor(min(max(raw[k], -1), 2) * C.BINS + 0.5), []).append((raw[k], y))
    cells = sorted((np.mean([s for s, _ in x]), np.mean([y for _, y in x]), len(x)) for x in bins.values())
    average = lambda a, b: sum(y * w for _, y, w in cells[a : b + 1]) / sum(w for *_, w in cells[a : b + 1])
    rising = [max(min(average(a, b) for b in range(k, len(cells))) for a in range(k + 1)) for k in range(len(cells))]
    knots, values = [], []
    for value, group in groupby(range(len(cells)), key=lambda k: round(rising[k], 12)):
        group = list(group)
        knots.append(sum(cells[k][0] * cells[k][2] for k in group) / sum(cells[k][2] for k in group))
        values.append(value)
    return np.clip(0.999 * np.interp(raw, knots, values) + 0.001 * np.clip(raw, 0, 1), 0, 1)


def test_every_score_against_a_plain_version(spark):
    d = "/root/testdata/sf0.001"
    frame, marks = table(spark, d, "documents"), table(spark, d, "labels")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    quality = {r.doc_id: r.quality for r in marks.collect()}
    wanted = plain_scores(rows, quality)
    got = {r.doc_id: r for r in C.score(frame, marks).collect()}
    assert len(got) == len(rows)
    for (i, _), score in zip(rows, wanted):
        assert abs(got[i].score - score) < 1e-6
        assert got[i].predicted == int(got[i].score >= C.POSITIVE) and got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    kept = {r.doc_id for r in C.keep_good(frame, marks).select("doc_id").collect()}
    assert kept == {i for i, r in got.items() if r.predicted}
