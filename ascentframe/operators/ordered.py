"""Ordered work inside groups that survives a hot group.

A sounding is normally a few thousand levels, so a plain window over its key is
the right plan: one exchange, one sort, shared by every step.  A group may
however hold a large share of all rows.  ``per_group`` measures the groups
first (one narrow, map-side combined count).  Groups over a fixed number of rows
are cut into parts along their order, by ranges that Spark takes from a sample
of the rows themselves, so outliers and missing values cut no worse than any
others; each step then works inside the parts and is completed from a *seam
table* with one row per part.  Both ways give the same rows (sums of fractions
may differ in their last digits, as their order does).

The side of a join is broadcast only while its counted rows, times its width,
stay below ``BROADCAST_BYTES``; beyond that Spark joins by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ascentframe.session import ensure_checkpoint_dir

HOT_ROWS = 1_000_000
OVERSPLIT = 4
HOT_ROWS_CONF = "ascentframe.hotGroupRows"
BROADCAST_BYTES, CELL_BYTES = 32_000_000, 32

PART = "_part"
CELLS = "_parts"


def hot_limit(spark) -> int:
    """Rows that one task may work through; does not grow with the data."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


def join_same(rows: DataFrame, side: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Joins on equal values of ``names``, where two missing values are equal."""
    renamed = side.withColumnsRenamed({name: f"_s_{name}" for name in names})
    same = [F.col(f"`{name}`").eqNullSafe(F.col(f"`_s_{name}`")) for name in names]
    return rows.join(renamed, same, how).drop(*[f"_s_{name}" for name in names])


class Group:
    """Rows of one or many groups with a total order inside each group.

    ``parts`` is 0 for whole groups; else the rows carry ``_part``, rising in group
    order, and there are at most so many (group, part) pairs.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[Column], parts: int = 0):
        self.df = df
        self.keys = list(keys)
        self.order = list(order)
        self.parts = parts
        self._place = self.keys + ([PART] if parts else [])

    # -- windows -------------------------------------------------------------
    @property
    def ordered(self):
        return Window.partitionBy(*self._place).orderBy(*self.order)

    @property
    def whole(self):
        return Window.partitionBy(*self._place)

    def on(self, df: DataFrame) -> Group:
        return Group(df, self.keys, self.order, self.parts)

    def with_columns(self, cols: dict[str, Column]) -> Group:
        return self.on(self.df.withColumns(cols))

    def where(self, condition) -> Group:
        return self.on(self.df.where(condition))

    def _cut(self) -> DataFrame:
        """The rows, with lineage cut: a seam table reads them a second time."""
        ensure_checkpoint_dir(self.df.sparkSession)
        return self.df.checkpoint(eager=True)

    def _beside(self, side: DataFrame, cells: int) -> DataFrame:
        """A side of one row for each part and so many values; broadcast if that is small."""
        return F.broadcast(side) if self.parts * cells * CELL_BYTES <= BROADCAST_BYTES else side

    # -- steps ---------------------------------------------------------------
    def attach(self, aggs: dict[str, Column]) -> Group:
        """Whole-group aggregates on every row of the group."""
        if not self.parts:
            return self.with_columns({name: agg.over(self.whole) for name, agg in aggs.items()})
        rows = self._cut()
        totals = rows.groupBy(*self.keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
        return self.on(join_same(rows, self._beside(totals, len(aggs)), self.keys))

    def running(self, sums: dict[str, Column]) -> Group:
        """Running totals in group order, the current row included."""
        frame = self.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = {name: F.sum(value).over(frame) for name, value in sums.items()}
        if not self.parts:
            return self.with_columns(local)
        rows = self._cut()
        seam = rows.groupBy(*self._place).agg(
            *[F.sum(value).alias(f"_t_{name}") for name, value in sums.items()]
        )
        before = Window.partitionBy(*self.keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        seam = seam.select(
            *self._place,
            *[F.sum(f"_t_{name}").over(before).alias(f"_o_{name}") for name in sums],
        )
        joined = join_same(rows, self._beside(seam, len(sums)), self._place)
        # a total is missing only as long as no value has come, as in one window
        joined = joined.withColumns(
            {name: F.coalesce(col + F.col(f"_o_{name}"), col, F.col(f"_o_{name}")) for name, col in local.items()}
        )
        return self.on(joined.drop(*[f"_o_{name}" for name in sums]))

    def number(self, name: str) -> Group:
        """1-based position in the group."""
        if not self.parts:
            return self.with_columns({name: F.row_number().over(self.ordered).cast("long")})
        return self.running({name: F.lit(1).cast("long")})

    def neighbours(self, cols: Sequence[str], back: int = 0, ahead: int = 0) -> Group:
        """Structs ``prev1..`` / ``next1..`` of ``cols`` from the rows around."""
        pack = F.struct(*cols)
        spans = [("prev", k, F.lag(pack, k)) for k in range(1, back + 1)]
        spans += [("next", k, F.lead(pack, k)) for k in range(1, ahead + 1)]
        if not self.parts:
            return self.with_columns({f"{side}{k}": fn.over(self.ordered) for side, k, fn in spans})
        reach = max(back, ahead)
        rows = self._cut()
        marked = rows.withColumns(
            {
                "_rn": F.row_number().over(self.ordered),
                "_size": F.count(F.lit(1)).over(self.whole),
                "_pack": pack,
            }
        )
        from_end = F.col("_size") - F.col("_rn") + 1
        # at most 2*reach rows of every part reach the seam table
        edges = marked.where((F.col("_rn") <= reach) | (from_end <= reach)).select(
            *self._place, "_pack", "_rn", from_end.alias("_re")
        )
        seam = edges.groupBy(*self._place).agg(
            F.sort_array(F.collect_list(F.when(F.col("_rn") <= reach, F.struct("_rn", "_pack")))).alias("_head"),
            F.sort_array(F.collect_list(F.when(F.col("_re") <= reach, F.struct("_re", "_pack")))).alias("_tail"),
        )
        by_part = Window.partitionBy(*self.keys).orderBy(PART)
        # nearest part first; `reach` non-empty parts always hold enough rows
        earlier = F.concat(*[F.coalesce(F.lag("_tail", k).over(by_part), F.array().cast(_type(seam, "_tail")))
                             for k in range(1, reach + 1)])
        later = F.concat(*[F.coalesce(F.lead("_head", k).over(by_part), F.array().cast(_type(seam, "_head")))
                           for k in range(1, reach + 1)])
        seam = seam.select(*self._place, earlier.alias("_earlier"), later.alias("_later"))
        joined = join_same(marked, self._beside(seam, 2 * reach * reach * len(cols)), self._place)
        out = {}
        for side, k, fn in spans:
            if side == "prev":
                spill = F.get("_earlier", F.lit(k) - F.col("_rn")).getField("_pack")
                inside = F.col("_rn") > k
            else:
                spill = F.get("_later", F.lit(k) - from_end).getField("_pack")
                inside = from_end > k
            out[f"{side}{k}"] = F.when(inside, fn.over(self.ordered)).otherwise(spill)
        joined = joined.withColumns(out)
        return self.on(joined.drop("_rn", "_size", "_pack", "_earlier", "_later"))

    def reach_ahead(self, at: str, delta: float, payload: Sequence[str], name: str, asking: Column,
                    position: str) -> DataFrame:
        """For every row where ``asking`` holds: the first row of its group whose
        ``at`` is at least ``at + delta``, as struct ``name`` (NULL if none).  A row
        without ``at`` gets NULL and is never an answer.

        ``at`` must not fall along the group order, ``position`` is the row's number
        in the group (it settles ties).  Rows and look-ups are put on
        one axis and swept once from the far end, so the cost is that of a sort;
        a frame with an unbounded end would be quadratic in the group.
        """
        look = F.struct(F.lit(True).alias("_ask"), (F.col(at) + F.lit(delta)).alias("_x"))
        stay = F.struct(F.lit(False).alias("_ask"), F.col(at).alias("_x"))
        rows = self._cut() if self.parts else self.df
        both = rows.withColumn("_on", F.explode(F.when(asking, F.array(stay, look)).otherwise(F.array(stay))))
        both = both.select("*", "_on.*").drop("_on")
        place = list(self.keys)
        if self.parts:
            both, place = self._dealt_on_axis(both, position), [*place, "_range"]
        seen = F.when(~F.col("_ask") & F.col("_x").isNotNull(), F.struct(*payload))
        # far end first; at equal x the rows come before the look-ups, and among
        # equal rows the earliest in group order comes last
        sweep = (
            Window.partitionBy(*place)
            .orderBy(F.desc("_x"), F.asc("_ask"), F.desc(position))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        answered = both.withColumn(name, F.last(seen, ignorenulls=True).over(sweep)).where("_ask")
        if self.parts:
            # nothing further on in the own range: the first row of the next range that has one
            beyond = self._first_beyond(both, payload, position)
            answered = join_same(answered, self._beside(beyond, len(payload)), place, "left")
            answered = answered.withColumn(name, F.coalesce(name, "_beyond")).drop("_beyond", "_range")
        answered = answered.withColumn(name, F.when(F.col("_x").isNotNull(), F.col(name)))
        return answered.drop("_ask", "_x")

    def _dealt_on_axis(self, both: DataFrame, position: str) -> DataFrame:
        """Rows and look-ups on their axis in ranges of about equal size (``_range``), cut by what Spark samples; rows at
        one place of the axis are cut by their position.  Written down, since a range is where a row came to lie."""
        ranges = both.repartitionByRange(2 * self.parts, *self.keys, F.asc("_x"), F.desc("_ask"), F.asc(position))
        return ranges.withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)

    def _first_beyond(self, both: DataFrame, payload: Sequence[str], position: str) -> DataFrame:
        """(group, range) -> the lowest row of the nearest later range that has rows: one row for each range."""
        row = ~F.col("_ask") & F.col("_x").isNotNull()
        low = both.groupBy(*self.keys, "_range").agg(
            F.min_by(F.struct(*payload), F.when(row, F.struct("_x", position))).alias("_low")
        )
        later = Window.partitionBy(*self.keys).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
        return low.select(*self.keys, "_range", F.last("_low", ignorenulls=True).over(later).alias("_beyond"))


def _type(df: DataFrame, name: str):
    return df.schema[name].dataType


_known: ContextVar[DataFrame | None] = ContextVar("sizes of groups", default=None)


@contextmanager
def sizes_known(sizes: DataFrame) -> Iterator[None]:
    """``per_group`` over the keys of ``sizes`` (keys, _n) takes them, instead of counting groups again."""
    before = _known.set(sizes)
    try:
        yield
    finally:
        _known.reset(before)


def per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
              work: Callable[[Group], DataFrame], sizes: DataFrame | None = None) -> DataFrame:
    """Run ``work`` over ordered groups, with hot groups cut into parts.

    Rows that are equal in the whole ``order`` stay together.  ``sizes`` (keys, _n) are the rows of each group where they
    are known already (or ``sizes_known``); else they are counted, which works ``df`` out once more.
    """
    spark = df.sparkSession
    limit = hot_limit(spark)
    if sizes is None and (known := _known.get()) is not None and set(known.columns) == {*keys, "_n"}:
        sizes = known
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.where(F.col("_n") > limit).withColumn(CELLS, (F.ceil(F.col("_n") / F.lit(limit)) * OVERSPLIT).cast("int"))
    tally = hot.agg(F.count(F.lit(1)).alias("groups"), F.sum(CELLS).alias("parts")).first()
    if not tally["groups"]:
        return work(Group(df, keys, order))

    seams = tally["parts"] + tally["groups"]
    hot = hot.drop("_n")
    if tally["groups"] * (len(keys) + 1) * CELL_BYTES <= BROADCAST_BYTES:
        hot = F.broadcast(hot)
    cold_rows = join_same(df, hot, keys, "left_anti")
    # ranges of (group, order) of about equal size; written down, since a part is where a row came to lie
    ensure_checkpoint_dir(spark)
    hot_rows = join_same(df, hot, keys).repartitionByRange(tally["parts"], *keys, *order)
    hot_split = hot_rows.withColumn(PART, F.spark_partition_id()).checkpoint(eager=True)
    warm = work(Group(hot_split, keys, order, seams)).drop(PART, CELLS)
    return work(Group(cold_rows, keys, order)).unionByName(warm)
