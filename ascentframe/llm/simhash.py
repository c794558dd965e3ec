"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 8).

Two fingerprints that differ in at most two bits share a value that differs from either in at most one bit. So every
distinct fingerprint emits the 65 values of its ball of radius one, the shuffle brings equal values together, and what
meets is verified. A value lies in the balls of at most 65 fingerprints, which bounds every group. Links join into
components over distinct fingerprints; copies are folded into their fingerprint first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from ascentframe.llm.common import cut

SHINGLE = 3
SEED = 42
BITS = 64
#: Fingerprints link at so many differing bits; each emits its ball of half that radius.
DISTANCE = 2
_CHUNK = 1 << 15


def fingerprint_of(text: str | None) -> int:
    """Majority bits of the hashes of all word shingles; 0 without a word. Signed, as Spark keeps 64-bit numbers."""
    words = b" ".join((text or "").encode("utf-8", "replace").lower().split())  # lowers A-Z, splits at blank and codes 9 to 13
    if not words:
        return 0
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(words)]
    digest, count = xxhash.xxh64_intdigest, max(1, len(starts) - SHINGLE + 1)
    ends = ends[SHINGLE - 1 :] or ends[-1:]
    totals = np.zeros(BITS, np.int64)
    for k in range(0, count, _CHUNK):
        hashes = np.array([digest(words[a:b], SEED) for a, b in zip(starts[k : k + _CHUNK], ends[k : k + _CHUNK])], np.uint64)
        totals += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * totals > count, bitorder="little").view(np.int64)[0])


@pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(x) for x in texts], dtype="int64")


def hexadecimal(fingerprint):
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def links(distinct: DataFrame) -> DataFrame:
    """Verified links (a, b) among distinct fingerprints `fp`, a < b.

    All that share a value are within two bits of each other, so the smallest one linked to each of the others joins the
    same components as all pairs would.
    """
    one = F.lit(1).cast("long")
    ball = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, F.lit(k))) for k in range(BITS)])
    met = distinct.select("fp", F.explode(ball).alias("value")).groupBy("value").agg(F.collect_set("fp").alias("met"))
    return (
        met.where(F.size("met") > 1)
        .select(F.array_min("met").alias("a"), F.explode("met").alias("b"))
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))
        .distinct()
    )


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b): root is the least node that can be reached.

    Rounds of large-star and small-star contraction: each node's larger neighbours, then its smaller ones, are tied to
    the least of its neighbourhood, until every edge ends at a root. Rounds grow with the logarithm of the longest
    chain. Every round is stored in the shared folder, so a lost executor costs one round at most. A hub's edges are
    reduced by a map-side minimum and joined back, never gathered into a list.
    """
    edges = cut(edges.select("a", "b"))
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        lowest = large.groupBy("b").agg(F.min("a").alias("m"))
        tied = large.join(lowest, "b")
        small = tied.select(F.col("m").alias("a"), F.col("a").alias("b")).unionAll(tied.select(F.col("m").alias("a"), "b"))
        edges = cut(small.where("a < b").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        seen = state


def label(prints: DataFrame) -> DataFrame:
    """(fp, least, root, component_id) for each distinct fingerprint of `prints` (doc_id, fp): its least doc_id, the
    least fingerprint of its component, and the least doc_id of its component."""
    # few bytes, but each row emits its whole ball: a stated number of parts, which are not joined for being small
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")).repartition(parts, "fp"))
    tree = roots(links(distinct))
    placed = distinct.join(tree.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(ids, "root").select("fp", "least", "root", "component_id")


def components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for each row of `docs`.

    NULL and empty texts have fingerprint 0 and link like any other. component_id is the least doc_id that is not NULL
    in the component, NULL if there is none. Repeated rows come out repeatedly; an empty table gives no rows.
    """
    prints = cut(docs.select("doc_id", fingerprints("text").alias("fp")))
    named = label(prints).select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: the one with the least doc_id.

    NULL ids come last; of rows with that id the least fingerprint stays, then the least row number (a hash of all columns),
    and of rows that agree in every column one stays. Fingerprints are worked out once, on narrow rows; whole rows meet the
    chosen ones by id and number.
    """
    number = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    prints = cut(docs.select("doc_id", number.alias("row"), fingerprints("text").alias("fp")))
    named = label(prints.select("doc_id", "fp")).select("fp", "root")
    ranked = prints.join(named, "fp").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), "fp", "row")).alias("first")
    )
    keys = ["__none", "__id", "__row"]
    stay = ranked.select(F.col("first.none").alias("__none"), F.col("first.id").alias("__id"), F.col("first.row").alias("__row"))
    keyed = docs.select(
        "*", F.col("doc_id").isNull().alias("__none"), F.coalesce(F.col("doc_id"), F.lit(0).cast("long")).alias("__id"), number.alias("__row")
    )
    same = Window.partitionBy(*keys).orderBy(F.lit(0))
    one = keyed.join(stay, keys, "left_semi").withColumn("__turn", F.row_number().over(same))
    return one.where("__turn = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
