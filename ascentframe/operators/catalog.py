"""Launch catalogue of a long table, and single-profile serving.

A launch is a run of equal (station, timestamp) in file order.  Runs are found
per file (any key that names an ordered piece: a month, a variable), so no
window spans the whole table, and a hot file is cut by ``per_group``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ascentframe import contracts as C
from ascentframe.functions import text, times
from ascentframe.operators import cdm
from ascentframe.operators.ordered import Group, per_group
from ascentframe.session import shuffles_dropped


def marked_blocks(df: DataFrame, file_keys: Sequence[str], order: Sequence[Column],
                  run_of: Sequence[str]) -> DataFrame:
    """Adds ``idx`` (0-based position in the file) and ``block_id`` (0-based
    number of the run of equal ``run_of`` values)."""

    def work(group: Group) -> DataFrame:
        group = group.number("idx").neighbours(list(run_of), back=1)
        changed = F.lit(False)
        for name in run_of:
            changed = changed | ~F.col(name).eqNullSafe(F.col(f"prev1.{name}"))
        group = group.with_columns({"_new": F.when(F.col("idx") == 1, 0).otherwise(changed.cast("int"))})
        group = group.running({"block_id": F.col("_new").cast("long")})
        return group.df.withColumn("idx", F.col("idx") - 1).drop("_new", "prev1")

    return per_group(df, file_keys, order, work)


def launches(blocks: DataFrame, file_keys: Sequence[str], station: str, epoch: str, code: str,
             max_launches: int | None = None) -> DataFrame:
    """One row per block: [start_idx, end_idx), station and time of its first
    row, sorted distinct codes.  The code set is bounded by the dictionary."""
    if max_launches is not None:
        blocks = blocks.where(F.col("block_id") < max_launches)
    first = F.min_by(F.struct(F.col(f"`{station}`").alias("s"), F.col(f"`{epoch}`").alias("t")), "idx")
    return blocks.groupBy(*file_keys, "block_id").agg(
        F.min("idx").alias("start_idx"),
        (F.max("idx") + 1).alias("end_idx"),
        first.alias("_first"),
        F.sort_array(F.collect_set(F.col(f"`{code}`"))).alias("codes"),
    ).select(
        *file_keys, "block_id", "start_idx", "end_idx", "codes",
        text.without_nul(F.col("_first.s")).alias("station_name"),
        times.epoch_text(F.col("_first.t")).alias("launch_date"),
    )


def launch_labels(launch_rows: DataFrame, dim: DataFrame, file_keys: Sequence[str]) -> DataFrame:
    """One row per (launch, code) with its label, ``Code n`` if unknown."""
    rows = launch_rows.withColumn("code", F.explode("codes"))
    joined = rows.join(dim.select("code", "label"), "code", "left")
    return joined.select(
        *file_keys, "block_id", "station_name", "launch_date", "start_idx", "end_idx", "code",
        text.label_or_code(F.col("label"), F.col("code")).alias("label"),
    )


def catalogue(launch_rows: DataFrame, dim: DataFrame, file_keys: Sequence[str]) -> DataFrame:
    """Launches with ``variable_labels``: map code -> label."""
    names = dim.agg(F.map_from_entries(F.collect_list(F.struct("code", "label")))).scalar()
    rows = launch_rows.withColumn("_names", names)
    label = F.map_from_arrays(
        F.col("codes"),
        F.transform("codes", lambda c: text.label_or_code(F.col("_names")[c], c)),
    )
    return rows.select(*file_keys, "block_id", "station_name", "launch_date", "start_idx", "end_idx",
                       label.alias("variable_labels"))


def dataset_variables(labels: DataFrame) -> DataFrame:
    return labels.select("code", "label").distinct().orderBy("code", "label")


def station_dates(launch_rows: DataFrame) -> DataFrame:
    """Distinct (station, launch date), in order."""
    return launch_rows.select("station_name", "launch_date").distinct().orderBy("station_name", "launch_date")


def launch_choices(labels: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per (station, date, display label) the block that serves it: the last one."""
    shown = labels.withColumn("display", text.label_with_code(F.col("label"), F.col("code")))
    return shown.groupBy("station_name", "launch_date", "display").agg(
        F.max_by(F.struct(*order, "code", "start_idx", "end_idx"), F.struct(*order)).alias("serves"),
        F.count(F.lit(1)).alias("blocks"),
    ).select("station_name", "launch_date", "display", "blocks", "serves.*")


#: Beside the months of an export; the underscore keeps readers of the months from taking it for one.
LAUNCHES = "_launches"
_STATION = "`station_name|station_configuration`"


def write_launch_index(spark: SparkSession, path: str) -> None:
    """Writes the launch index of a stored export beside its months: for each launch and variable the files that hold it,
    and in each file the first row and the one behind the last.

    One pass over three columns, in rounds of whole months as the export was written; a row for each (file, launch) is summed
    before the shuffle.  A round is laid out by ranges of (station, time), so a look-up opens the files whose least and
    greatest values hold its launch.  The new index takes the old one's place when it is whole.
    """
    stored = spark.read.parquet(path)
    sizes = {(r["year"], r["month"]): r["levels"] for r in cdm.levels_by_month(stored).collect()}  # at most 12 per year
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    for some in cdm.month_rounds(sizes, len(C.VARIABLES)) or [[]]:
        rows = cdm.of_months(stored, some).select(
            F.col("year"), F.col("month"), F.col("observed_variable").cast("int").alias("code"), F.col(_STATION).alias("station_name"),
            F.col("report_timestamp").alias("epoch"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        slices = rows.groupBy("station_name", "epoch", "code", "year", "month", "file").agg(
            F.min("row").alias("start_idx"), (F.max("row") + 1).alias("end_idx"), F.count(F.lit(1)).alias("rows"))
        placed = slices.repartitionByRange("station_name", "epoch").sortWithinPartitions("station_name", "epoch", "code")
        with shuffles_dropped(spark):
            placed.write.mode("append").option("compression", "zstd").parquet(draft)
    place, final = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (draft, f"{path}/{LAUNCHES}"))
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(final, True)
    if not files.rename(place, final):
        raise RuntimeError(f"the launch index of {path} could not be put in place")


def launch_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{LAUNCHES}")


def launch_slice(spark: SparkSession, path: str, station: str, epoch: int, code: int) -> DataFrame:
    """One variable of one launch by height, with its uncertainties, from a stored export and its launch index.

    Only the files that the index names are opened; of these the rows between start and end are taken, and the launch's
    time and station are tested in the scan too, so other row groups and pages are left out.
    """
    hit = (F.col("station_name") == station) & (F.col("epoch") == epoch) & (F.col("code") == code)
    slices = launch_index(spark, path).where(hit).select("file", "start_idx", "end_idx").collect()  # a launch lies in few files
    wanted = ["z_coordinate", "observation_value", "uncertainty_value1", "uncertainty_value2", "uncertainty_value5"]
    if not slices:
        return spark.read.parquet(path).select(*wanted).limit(0)
    rows = spark.read.option("basePath", path).parquet(*sorted(s["file"] for s in slices))
    inside = F.lit(False)
    for s in slices:
        inside = inside | ((F.col("_metadata.file_path") == s["file"]) & F.col("_metadata.row_index").between(s["start_idx"], s["end_idx"] - 1))
    own = (F.col(_STATION) == station) & (F.col("report_timestamp") == epoch)
    return rows.where(own & inside).select(*wanted).orderBy("z_coordinate")


def station_index(launch_rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Every block of every (station, launch date), numbered in order, with how many
    the date has: all blocks, not only the one that serves."""
    place = Window.partitionBy("station_name", "launch_date")
    return launch_rows.select(
        "station_name", "launch_date", *order, "start_idx", "end_idx",
        F.row_number().over(place.orderBy(*order)).alias("nth"), F.count(F.lit(1)).over(place).alias("blocks"))


def profile(long: DataFrame, station: str, epoch: int, code: int) -> DataFrame:
    """One variable of one launch by height, with its uncertainties.  All three
    filters reach the scan."""
    hit = (
        (F.col("`station_name|station_configuration`") == station)
        & (F.col("report_timestamp") == epoch)
        & (F.col("observed_variable") == code)
    )
    return long.where(hit).select(
        "z_coordinate", "observation_value", "uncertainty_value1", "uncertainty_value2", "uncertainty_value5"
    ).orderBy("z_coordinate")
