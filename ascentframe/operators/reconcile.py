"""Stored tables against re-processed sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe.functions.text import leading_number
from ascentframe.operators.ordered import BROADCAST_BYTES, CELL_BYTES, Group, join_same, per_group
from ascentframe.session import ensure_checkpoint_dir

# fixed values: tolerances
LEVEL_ABS, HEADER_ABS, RELATIVE = 1e-2, 1e-4, 1e-5
OK, ERR = "OK", "ERR"
TIME_WORDS = "time|timestamp|datetime"


def positioned(levels: DataFrame, key: str, order: str) -> DataFrame:
    """Adds ``pos``: position inside the sounding by the observation id."""
    return per_group(levels, [key], [F.asc(order)], lambda group: group.number("pos").df)


def _finite(col: Column) -> Column:
    col = col.try_cast("double")
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)


def close(expected: Column, actual: Column, absolute: float) -> Column:
    return F.abs(expected - actual) <= F.lit(absolute) + F.lit(RELATIVE) * F.abs(actual)


def _side(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], mine: int) -> DataFrame:
    """Finite values v_0.. of one side (0 expected, 1 actual)."""
    return rows.select(*keys, F.lit(mine).alias("side"), *[_finite(F.col(c)).alias(f"v_{i}") for i, c in enumerate(columns)])


def _by_column(stacked: DataFrame, keys: Sequence[str], columns: Sequence[str], key: str, absolute: float,
               both_sides_only: bool) -> DataFrame:
    """Both sides' levels (_side) combined by ``keys``, then counted per (sounding, column)."""
    both = stacked.groupBy(*keys).agg(
        *[F.max((F.col("side") == k).cast("int")).alias(s) for k, s in enumerate("ea")],
        *[F.max(F.when(F.col("side") == k, F.col(f"v_{i}"))).alias(f"{s}_{i}") for k, s in enumerate("ea") for i, _ in enumerate(columns)],
    )
    missing, extra = F.count_if(F.col("a") == 0), F.count_if(F.col("e") == 0)
    aggs = [missing.alias("missing"), extra.alias("extra")]
    for i, _ in enumerate(columns):
        e, a = F.col(f"e_{i}"), F.col(f"a_{i}")
        aggs += [
            F.count(e - a).alias(f"n_{i}"),
            F.count_if(~close(e, a, absolute)).alias(f"x_{i}"),
            F.count_if(e.isNull() != a.isNull()).alias(f"o_{i}"),
            F.max(F.abs(e - a)).alias(f"d_{i}"),
        ]
    per = both.groupBy(key).agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("compared"), F.col(f"x_{i}").alias("off"),
                 F.col(f"o_{i}").alias("one_sided"), F.col(f"d_{i}").alias("max_diff"))
        for i, c in enumerate(columns)
    ])
    out = per.select(key, "missing", "extra", F.explode(rows).alias("r")).select(key, "r.*", "missing", "extra")
    lost = F.col("missing") + F.col("extra")
    if not both_sides_only:
        lost = lost + F.col("one_sided")
    out = out.where((F.col("compared") > 0) | (lost > 0))
    return out.withColumn("status", F.when((F.col("off") == 0) & (lost == 0), OK).otherwise(ERR))


def compare_profiles(expected: DataFrame, actual: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     key: str, absolute: float = LEVEL_ABS, both_sides_only: bool = False) -> DataFrame:
    """Per (sounding, column): levels compared, levels off, values that only one
    side has, levels that only one side has, largest difference, status.

    Levels on one side alone are errors of every column, so a lost tail, a lost
    middle and a lost profile all show; a value that is finite on one side alone
    is an error of its column, so a lost column shows too (``both_sides_only``
    counts such values without holding them against the column).  A column is
    left out only if nothing is finite on either side and no level is lost.

    The two sides are stacked and combined by level, which needs no join, so a
    sounding with very many levels is spread like any other.
    """
    stacked = _side(expected, keys, columns, 0).unionByName(_side(actual, keys, columns, 1))
    return _by_column(stacked, keys, columns, key, absolute, both_sides_only)


#: Digests are sums of 31-bit remainders, so that sums and products fit 64 bits.
PRIME = (1 << 31) - 1
#: Soundings with fewer levels than that are compared by their levels where there are very many.
DIGEST_LEVELS = 16


def digested(levels: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """One row per sounding: levels, values per column, and a digest that does not depend on the order of the rows nor on
    the number its observation ids begin with.

    Two hashes g and h of a level's values are summed, plain and times the level's distance from the least id.  The
    distance sums follow from sums over the ids themselves (the least one is known only afterwards), so one map-side
    combined pass is enough.  A level that differs, is lost or stands elsewhere changes sums of 31 bits in both hashes.
    """
    values = [_finite(F.col(c)) + F.lit(0.0) for c in columns]  # one zero
    rows = levels.select(key, F.col(order).cast("long").alias("_id"), *[v.alias(f"v_{i}") for i, v in enumerate(values)])
    names = [f"v_{i}" for i, _ in enumerate(columns)]
    rows = rows.withColumns({
        # a missing value leaves xxhash64 as it is, so each is told apart by its flag
        h: F.pmod(F.xxhash64(F.lit(seed), *[x for n in names for x in (F.col(n).isNull(), F.col(n))]), F.lit(PRIME))
        for seed, h in enumerate("gh")
    })
    at = F.pmod(F.col("_id"), F.lit(PRIME))
    sums = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("levels"), F.count("_id").alias("ids"), F.min("_id").alias("least"),
        *[F.sum(h).alias(f"s_{h}") for h in "gh"], *[F.sum(F.pmod(F.col(h) * at, F.lit(PRIME))).alias(f"t_{h}") for h in "gh"],
        *[F.count(n).alias(n.replace("v_", "n_")) for n in names],
    )
    least = F.pmod(F.col("least"), F.lit(PRIME))
    plain = {h: F.pmod(F.col(f"s_{h}"), F.lit(PRIME)) for h in "gh"}
    moved = {h: F.pmod(F.col(f"t_{h}") - F.pmod(plain[h] * least, F.lit(PRIME)), F.lit(PRIME)) for h in "gh"}
    digest = F.struct(*[plain[h].alias(f"sum_{h}") for h in "gh"], *[moved[h].alias(f"moved_{h}") for h in "gh"])
    counts = F.array(*[F.col(n.replace("v_", "n_")) for n in names])
    # without all ids there is no position to compare by
    return sums.select(key, "levels", F.when(F.col("ids") == F.col("levels"), digest).alias("digest"), counts.alias("counts"))


def compare_levels(expected: DataFrame, actual: DataFrame, key: str, order: str, columns: Sequence[str],
                   absolute: float = LEVEL_ABS, both_sides_only: bool = False, pairs: DataFrame | None = None) -> DataFrame:
    """``compare_profiles`` by position (rank of ``order`` inside the sounding), for tables that mostly agree.

    Both sides are reduced to one digest row per sounding first; soundings with equal digests agree in every level.  Only
    the levels of the others are shuffled, once: both sides are stacked, numbered and combined on one exchange.  Very many
    short soundings have no digests, which would be half as large as their levels, and where too many soundings differ to
    tell every task which, a look-up would exchange all levels before those are exchanged again: in both cases all levels
    are stacked at once.  ``pairs`` (key, _stored) tells which stored sounding belongs to which of ``expected`` where
    their numbers differ; one that occurs twice is compared with all of its rows.
    """
    spark = expected.sparkSession

    def by_levels(mine: DataFrame, theirs: DataFrame) -> DataFrame:
        stacked = _side(mine, [key, order], columns, 0).unionByName(_side(theirs, [key, order], columns, 1))

        def work(group: Group) -> DataFrame:
            # dealt out by sounding alone: the windows and both combinations below need no further exchange
            return (group if group.parts else group.on(group.df.repartition(key))).number("pos").df

        placed = per_group(stacked, [key, "side"], [F.asc(order)], work)
        return _by_column(placed, [key, "pos"], columns, key, absolute, both_sides_only)

    def all_levels() -> DataFrame:
        if pairs is None:
            return by_levels(expected, actual)
        return by_levels(expected, actual.withColumnRenamed(key, "_stored").join(pairs, "_stored").drop("_stored"))

    size = expected.agg(F.count(F.lit(1)).alias("levels"), F.approx_count_distinct(key).alias("soundings")).first()
    if size["soundings"] * CELL_BYTES > BROADCAST_BYTES and size["levels"] < DIGEST_LEVELS * size["soundings"]:
        return all_levels()

    ours = digested(expected, key, order, columns).select(key, F.struct("levels", "digest", "counts").alias("e"))
    theirs = digested(actual, key, order, columns).select(F.col(key).alias("_stored"), F.struct("levels", "digest", "counts").alias("a"))
    if pairs is not None:
        theirs = theirs.join(pairs, "_stored").groupBy(key).agg(
            F.any_value("a").alias("a"), F.count(F.lit(1)).alias("times")).withColumnRenamed(key, "_stored")
    else:
        theirs = theirs.withColumn("times", F.lit(1))
    met = ours.join(theirs, F.col(key).eqNullSafe(F.col("_stored")), "full")
    alike = F.coalesce((F.col("e.levels") == F.col("a.levels")) & (F.col("e.digest") == F.col("a.digest")) & (F.col("times") == 1), F.lit(False))
    ensure_checkpoint_dir(spark)
    folded = met.select(F.coalesce(key, "_stored").alias(key), alike.alias("alike"), F.col("e.counts").alias("counts")).checkpoint(eager=True)

    same = folded.where("alike").select(key, F.posexplode("counts").alias("place", "compared")).where("compared > 0")
    names = F.array(*[F.lit(c) for c in columns])
    nothing = F.lit(0).cast("long")
    agreed = same.select(
        key, F.get(names, F.col("place")).alias("column_name"), "compared", nothing.alias("off"), nothing.alias("one_sided"),
        F.lit(0.0).alias("max_diff"), nothing.alias("missing"), nothing.alias("extra"), F.lit(OK).alias("status"))

    apart = folded.where("NOT alike").select(key)
    count = apart.count()
    if not count:
        return agreed
    if count * CELL_BYTES > BROADCAST_BYTES:
        return all_levels()
    apart = F.broadcast(apart)
    if pairs is None:
        found = join_same(actual, apart, [key], "left_semi")
    else:
        found = actual.withColumnRenamed(key, "_stored").join(F.broadcast(pairs.join(apart, key)), "_stored").drop("_stored")
    return agreed.unionByName(by_levels(join_same(expected, apart, [key], "left_semi"), found))


_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"


def number_and_unit(value: Column) -> tuple[Column, Column]:
    """The number a text consists of, apart from a unit without digits behind it, and that unit; NULL for other texts."""
    is_number = value.rlike(_NUMBER + r"[^\d]*$")
    return F.when(is_number, leading_number(value)), F.when(is_number, F.trim(F.regexp_replace(value, _NUMBER, "")))


def header_match(name: Column, expected: Column, actual: Column, numeric: Column | None = None) -> Column:
    """Trimmed texts that are equal match (two missing values agree).  Else, in a ``numeric`` column, two numbers of the
    same unit (or both without one): tolerance; in a time column: within one second.  Any other text differs: serial
    ``007`` is not ``7``, version ``1.10`` not ``1.1``, ``5`` not ``5 km``."""
    (e, e_unit), (a, a_unit) = number_and_unit(expected), number_and_unit(actual)
    te, ta = expected.try_cast("timestamp"), actual.try_cast("timestamp")
    same_text = F.trim(expected).eqNullSafe(F.trim(actual))
    near = F.abs(F.unix_micros(te) - F.unix_micros(ta)) < 1_000_000
    timed = F.lower(name).rlike(TIME_WORDS) & te.isNotNull() & ta.isNotNull()
    numbers = (F.lit(False) if numeric is None else numeric) & e.isNotNull() & a.isNotNull() & (e_unit == a_unit)
    # equal texts match by every rule, so most rows need no parsing
    return F.when(same_text, True).when(numbers, close(e, a, HEADER_ABS)).when(timed, near).otherwise(False)


def compare_headers(expected: DataFrame, actual: DataFrame, key: str, columns: Sequence[str],
                    numeric: Sequence[str] | None = None) -> DataFrame:
    """Per (sounding, column): expected, actual and status.  Soundings stored on
    both sides only; see ``missing_soundings`` for the others.  ``numeric`` names the
    columns that hold numbers by the contract; by default those that are numbers on
    either side."""
    if numeric is None:
        kinds = [df.schema[c].dataType for c in columns for df in (expected, actual)]
        numeric = [c for c, e, a in zip(columns, kinds[::2], kinds[1::2]) if isinstance(e, T.NumericType) or isinstance(a, T.NumericType)]
    exp = expected.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias("e"))
    act = actual.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias("a"))
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(c in numeric).alias("numeric"), F.col(f"e.{c}").alias("expected"),
                 F.col(f"a.{c}").alias("actual"))
        for c in columns
    ])
    out = exp.join(act, key).select(key, F.explode(rows).alias("r")).select(key, "r.*")
    match = header_match(F.col("column_name"), F.col("expected"), F.col("actual"), F.col("numeric"))
    return out.withColumn("status", F.when(match, OK).otherwise(ERR)).drop("numeric")


def missing_soundings(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    return expected.select(key).distinct().join(actual.select(key), key, "left_anti")


def verdicts(expected: DataFrame, actual: DataFrame, key: str, profile_rows: DataFrame,
             header_rows: DataFrame | None = None) -> DataFrame:
    """One row per expected sounding: OK/ERR counts, ``found`` and ``passed``.  A
    sounding of which no level was compared does not pass."""

    def counts(rows: DataFrame, side: str) -> DataFrame:
        return rows.groupBy(key).agg(
            F.count_if(F.col("status") == OK).alias(f"{side}_ok"),
            F.count_if(F.col("status") == ERR).alias(f"{side}_err"),
        )

    out = expected.select(key).distinct()
    stored = actual.select(key).distinct().withColumn("found", F.lit(True))
    out = out.join(stored, key, "left").join(counts(profile_rows, "profile"), key, "left")
    names = ["profile_ok", "profile_err"]
    if header_rows is not None:
        out = out.join(counts(header_rows, "header"), key, "left")
        names += ["header_ok", "header_err"]
    out = out.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in names})
    out = out.withColumn("found", F.coalesce("found", F.lit(False)))
    clean = F.col("found") & (F.col("profile_ok") + F.col("profile_err") > 0)
    for name in names:
        if name.endswith("_err"):
            clean = clean & (F.col(name) == 0)
    return out.withColumn("passed", clean)


def global_verdict(verdict_rows: DataFrame) -> DataFrame:
    return verdict_rows.agg(
        F.count(F.lit(1)).alias("soundings"),
        F.count_if("passed").alias("passed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
    )
