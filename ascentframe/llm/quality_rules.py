"""Quality rules: base counts of a text, and a hashed n-gram log-likelihood ratio (operator 1).

Words and neighbouring word pairs of every document are hashed into a fixed number of buckets. Two multinomials over the
buckets, one of all documents and one of the trusted ones, give each bucket a log ratio. The mean of the ratios of a
document's n-grams is its score, and one threshold decides for every document. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ascentframe.llm.common import let, with_trust, words_of

#: Buckets of the hashed n-grams; also bounds the model (two numbers a bucket).
BUCKETS = 1 << 16
#: Pseudo-count of each bucket, in corpus units: the trusted share of a bucket is drawn to its corpus share by so much,
#: so what occurs a few times says little, whether or not a trusted document happens to have it.
SMOOTHING = 50.0
#: A document stays if its mean log ratio (nats for each n-gram) is at least this.
THRESHOLD = -0.15
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"


def _bucket(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def ngram_buckets(words: Column) -> Column:
    """Buckets of all words, then of all pairs of neighbours."""
    singles = F.transform(words, lambda x: _bucket(x))
    pairs = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda x, i: _bucket(x, F.get(words, i + 1))
    )
    return F.concat(singles, pairs)


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more.

    Sorted hashes show which ones repeat. A 4096-bit set of those leaves few windows that do not repeat; what passes is
    sorted with its places, equal hashes meet, and the lengths of the joined intervals are summed.
    """
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    bit = lambda h: F.pmod(F.shiftright(h, 6), F.lit(64)).cast("int")
    row = lambda h: F.pmod(h, F.lit(64)).cast("int")
    repeated = let(
        F.sort_array(hashes),
        lambda s: F.filter(s, lambda h, k: same(h, F.get(s, k + 1)) & ~same(h, F.get(s, k - 1))),
    )
    bits = let(
        repeated,
        lambda r: F.transform(
            F.sequence(F.lit(0), F.lit(63)),
            lambda j: F.aggregate(
                F.filter(r, lambda h: row(h) == j),
                F.lit(0).cast("long"),
                lambda a, h: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit(h))),
            ),
        ),
    )
    candidates = let(
        bits,
        lambda b: F.filter(
            F.transform(hashes, lambda h, i: F.when(F.getbit(F.get(b, row(h)), bit(h)) == 1, F.struct(h.alias("h"), i.alias("at")))),
            lambda x: x.isNotNull(),
        ),
    )
    places = let(
        F.sort_array(candidates),
        lambda s: F.sort_array(
            F.transform(
                F.filter(s, lambda x, k: same(x["h"], F.get(s, k + 1)["h"]) | same(x["h"], F.get(s, k - 1)["h"])),
                lambda x: x["at"],
            )
        ),
    )
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")),
        lambda a, p: F.struct(
            (a["words"] + p + WINDOW - F.greatest(p, a["end"])).alias("words"), (p + WINDOW).alias("end")
        ),
        lambda a: a["words"],
    )


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of five words which the text holds twice or more."""
    hashes = let(
        F.transform(words, lambda x: F.xxhash64(x)),
        lambda w: F.transform(
            F.slice(w, 1, F.size(w) - (WINDOW - 1)),
            lambda h, i: F.xxhash64(h, *[F.get(w, i + k) for k in range(1, WINDOW)]),
        ),
    )
    counted = let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h))
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(counted)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def symbols_in(text: Column) -> Column:
    rest = F.coalesce(text, F.lit(""))
    for sign in SYMBOLS:
        rest = F.replace(rest, F.lit(sign), F.lit(""))
    return F.octet_length(F.coalesce(text, F.lit(""))) - F.octet_length(rest)


def base_counts(text: Column, words: Column) -> dict[str, Column]:
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": symbols_in(text).cast("long"),
        "n_dup_lines": duplicate_lines(text).cast("long"),
        "n_repeat_words": repeated_words(words).cast("long"),
    }


def log_ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row, one array `ratios`: ln(trusted share / corpus share) of each bucket, smoothed towards 0.

    Counts are summed before the shuffle, so each task sends a row for each bucket at most. Without a trusted document
    there is nothing to compare with and all ratios are 0.
    """
    spark = docs.sparkSession
    counts = (
        with_trust(docs, labels, "trusted", "text")
        .select("trusted", let(words_of(F.col("text")), ngram_buckets).alias("buckets"))
        .select("trusted", F.explode_outer("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("corpus"), F.count_if(F.col("trusted")).alias("target"))
    )
    dense = (
        spark.range(BUCKETS)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(counts, "bucket", "left")
        .select("bucket", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in ("corpus", "target")])
    )
    gathered = dense.agg(
        F.sum("corpus").alias("all_corpus"),
        F.sum("target").alias("all_target"),
        F.sort_array(F.collect_list(F.struct("bucket", "corpus", "target"))).alias("rows"),
    )
    share = F.col("all_target") / F.col("all_corpus")
    ratio = lambda r: F.when(
        F.col("all_target") > 0, F.log((r["target"] + SMOOTHING * share) / ((r["corpus"] + SMOOTHING) * share))
    ).otherwise(F.lit(0.0))
    return gathered.select(F.transform("rows", ratio).alias("ratios"))


def mean_ratio(words: Column, ratios: Column) -> Column:
    """Mean log ratio of the n-grams of a document, 0 for a text without a word."""
    total = F.aggregate(ngram_buckets(words), F.lit(0.0), lambda a, b: a + F.get(ratios, b))
    return F.when(F.size(words) == 0, F.lit(0.0)).otherwise(total / (2 * F.size(words) - 1))


def judge(docs: DataFrame, labels: DataFrame, into: str = "judged") -> DataFrame:
    """`docs` with a struct column `into`: the base counts, base_failed, llr and kept. Every row is kept or marked.

    NULL texts count as empty: all counts 0, base_failed true. Rows that occur twice are judged twice, alike. All
    columns of `docs` stay; one named like `into` is replaced. An empty table gives an empty result.
    """
    model = "__ratios_of_buckets"
    ratios, text = F.col(model), F.col("text")

    def body(words: Column) -> Column:
        counts = base_counts(text, words)
        return F.struct(
            *[c.alias(name) for name, c in counts.items()], mean_ratio(words, ratios).alias("llr")
        )

    # the optimiser puts the scalar subquery in place of the column, so the array is never written into a row
    counted = docs.withColumn(model, log_ratios(docs, labels).scalar()).withColumn(into, let(words_of(text), body)).drop(model)

    def verdict(j: Column) -> Column:
        failed = (j["n_words"] < MIN_WORDS) | (100 * j["n_repeat_words"] > MAX_REPEAT_PERCENT * j["n_words"])
        return j.withField("base_failed", failed).withField("kept", ~failed & (j["llr"] >= THRESHOLD))

    # one reference, so that the counts are not worked out again where a filter is pushed through
    return counted.withColumn(into, let(F.col(into), verdict))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs`, unchanged, that are kept."""
    judged = "__judged"
    return judge(docs, labels, judged).where(F.col(f"{judged}.kept")).drop(judged)
