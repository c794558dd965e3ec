"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration (operator 9).

Statistics of each text are standardised and mapped to cosines of random projections, whose inner products approximate a
Gaussian kernel. Every partition sums its part of the normal equations; Spark adds the parts, the driver solves one system
of fixed size. Rows that took no part in the system calibrate the scores by isotonic regression over binned scores.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from ascentframe.llm.common import cut, sized

STATISTICS = (
    "log_words", "log_chars", "word_length", "distinct_share", "top_word_share", "repeated_pair_share", "line_words",
    "repeated_line_share", "upper_share", "digit_share", "symbol_share", "mark_share", "other_byte_share", "end_share",
    "byte_entropy", "longest_run_share",
)
#: Number of random features, kernel width in standard deviations, ridge weight for each training row, and the seed.
FEATURES = 192
WIDTH = 4.0
RIDGE = 1e-4
SEED = 20
#: Scores are binned this fine before calibration.
BINS = 1000
POSITIVE = 0.7

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SYMBOL = np.isin(_BYTES, np.frombuffer(b"#*$%&|<>{}[]\\^~_=+@", np.uint8))
_MARK = np.isin(_BYTES, np.frombuffer(b".,;:!?'\"()-", np.uint8))
_OTHER = _BYTES >= 128


def statistics_of(text: str | None) -> list[float]:
    """Statistics of one whole text, all finite; an empty text has zeros."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = len(data)
    tally = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in data.split(b"\n") if x.strip()]
    shares = counts[counts > 0] / size
    run = longest = 1
    if len(tally) < n:
        for a, b in zip(words, words[1:]):
            run = run + 1 if a == b else 1
            longest = run if run > longest else longest
    ends = sum(1 for x in lines if x.rstrip()[-1:] in (b".", b"!", b"?"))
    return [
        float(np.log1p(n)), float(np.log1p(size)), min(size / n, 100.0), len(tally) / n, max(tally.values()) / n,
        1 - pairs / (n - 1) if n > 1 else 0.0, float(np.log1p(n / len(lines))), 1 - len(set(lines)) / len(lines),
        counts[_UPPER].sum() / size, counts[_DIGIT].sum() / size, counts[_SYMBOL].sum() / size, counts[_MARK].sum() / size,
        counts[_OTHER].sum() / size, ends / len(lines), float(-(shares * np.log2(shares)).sum()), longest / n,
    ]


@pandas_udf(ArrayType(DoubleType()))
def document_statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics_of(x) for x in texts])


@dataclass(frozen=True)
class Model:
    """Everything that scoring needs; its size depends on the parameters alone."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the random features and the intercept
    knots: np.ndarray
    values: np.ndarray


def _projection() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.normal(size=(len(STATISTICS), FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES)


def _lift(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    directions, phases = _projection()
    waves = np.sqrt(2 / FEATURES) * np.cos(((rows - mean) / scale) @ directions + phases)
    return np.hstack([waves, np.ones((len(rows), 1))])


def _as_rows(statistics: pd.Series) -> np.ndarray:
    return np.array(list(statistics), dtype=np.float64).reshape(-1, len(STATISTICS))


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    exprs = [f(F.col("stats")[k]).alias(f"{name}{k}") for k in range(len(STATISTICS)) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    one = rows.agg(*exprs).first()
    mean = np.array([one[f"m{k}"] or 0.0 for k in range(len(STATISTICS))])
    scale = np.array([one[f"s{k}"] or 0.0 for k in range(len(STATISTICS))])
    return mean, np.where(scale > 1e-9, scale, 1.0)


def _weights(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, int]:
    """Ridge weights, and from how many rows: each task sends its summed products (a triangle of fixed size), Spark adds them by cell."""
    n = FEATURES + 2  # features, intercept, label

    def parts(batches):
        total = np.zeros((n, n))
        for batch in batches:
            lifted = _lift(_as_rows(batch["stats"]), mean, scale)
            both = np.hstack([lifted, batch["quality"].to_numpy(float)[:, None]])
            total += both.T @ both
        i, j = np.triu_indices(n)
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "v": total[i, j]})

    cells = rows.select("stats", "quality").mapInPandas(parts, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros((n, n))
    total[cells["i"], cells["j"]] = cells["v"]
    total = total + np.triu(total, 1).T
    count = max(total[n - 2, n - 2], 1.0)
    penalty = np.full(n - 1, RIDGE * count)
    penalty[-1] = 1e-9 * count  # the intercept is hardly held back
    return np.linalg.solve(total[: n - 1, : n - 1] + np.diag(penalty), total[: n - 1, n - 1]), int(total[n - 2, n - 2])


def pool_adjacent(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of sorted scores: centres and values of the pooled blocks."""
    blocks: list[list[float]] = []
    for s, y, w in zip(scores, labels, weights):
        blocks.append([s * w, y * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    done = np.array(blocks).reshape(-1, 3)
    return done[:, 0] / done[:, 2], done[:, 1] / done[:, 2]


def fit(train: DataFrame, calibrate: DataFrame) -> Model:
    """Model from rows (stats, quality). Without a row to learn from, nothing speaks against a text: its score is near 1.
    Without rows to calibrate with, raw scores are cut to [0, 1]."""
    mean, scale = _moments(train)
    weights, count = _weights(train, mean, scale)
    if not count:
        return Model(mean, scale, weights, np.array([0.0, 1.0]), np.array([1.0, 1.0]))
    raw = pandas_udf(lambda s: pd.Series(_lift(_as_rows(s), mean, scale) @ weights), DoubleType())
    binned = (
        calibrate.select(raw("stats").alias("raw"), F.col("quality").cast("double").alias("y"))
        .groupBy(F.round(F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) * BINS).alias("bin"))
        .agg(F.avg("raw").alias("s"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("w"))
        .toPandas()
        .sort_values("s")
    )
    if binned.empty:
        return Model(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    knots, values = pool_adjacent(*(binned[c].to_numpy(float) for c in ("s", "y", "w")))
    return Model(mean, scale, weights, knots, values)


def scorer(model: Model):
    """A column function: calibrated score of a statistics column, between 0 and 1."""

    def scores(stats: pd.Series) -> pd.Series:
        raw = _lift(_as_rows(stats), model.mean, model.scale) @ model.weights
        # straight lines between block centres; a trace of the raw score keeps the order inside flat blocks
        level = np.interp(raw, model.knots, model.values)
        return pd.Series(np.clip(0.999 * level + 0.001 * np.clip(raw, 0, 1), 0, 1))

    return pandas_udf(scores, DoubleType())


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, ...) that a model may learn from, with their label and remainder (never 2)."""
    marks = cut(labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality")))
    usable = rows.withColumn("part", remainder(F.col("doc_id"))).where("part != 2")
    return usable.join(sized(marks, marks.count()), "doc_id")


def learn(stats: DataFrame, labels: DataFrame) -> Model:
    """Model from labelled rows of (doc_id, stats): remainders 0 and 1 fit, 3 calibrates, 2 is never looked at."""
    known = cut(_labelled(stats.select("doc_id", "stats"), labels))
    return fit(known.where("part in (0, 1)"), known.where("part = 3"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of `docs`.

    NULL and empty texts have zero statistics and are scored like any row; a NULL id is not held out and not learned
    from; repeated rows are scored alike; without usable labels every score is near 1. Statistics come from the whole
    text and nothing else.
    """
    stats = cut(docs.select("doc_id", document_statistics("text").alias("stats")))
    scores = scorer(learn(stats, labels))
    return stats.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), scores("stats").alias("score")
    ).withColumn("predicted", F.when(F.col("score") >= POSITIVE, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs`, unchanged, whose score reaches the limit.

    Statistics are worked out once for every row that is scored, and before that for the labelled rows alone.
    """
    known = _labelled(docs.select("doc_id", "text"), labels).select("doc_id", "quality", "part", document_statistics("text").alias("stats"))
    known = cut(known)
    scores = scorer(fit(known.where("part in (0, 1)"), known.where("part = 3")))
    return docs.where(scores(document_statistics("text")) >= POSITIVE)
