"""Where results go: partitioned tables, text loads, dumps, quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe import contracts as C
from ascentframe.functions.text import attributes_json
from ascentframe.operators import cdm
from ascentframe.sources.archives import exists

MONTH = ("year", "month")
TILE = ("lat_tile", "lon_tile")
#: The underscore keeps readers of the months from taking it for one.
DICTIONARY = "_observed_variables"


def by_month(rows: DataFrame) -> DataFrame:
    """Rows gathered by month for a partitioned write.  The rebalance lets AQE cut
    a large month into many tasks of the advisory size and join small ones."""
    return rows.hint("rebalance", *[F.col(name) for name in MONTH])


#: Order of the rows of one variable.
IN_TIME = ("report_timestamp", "observation_id")
WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"
#: Files a task may write side by side, one for each month of its range.
WRITERS = 24
#: Pages that hold the rows of several variables: what a level tells again for each of them is packed once.
STORED = {"compression": "zstd", "parquet.page.size": 4 << 20, "parquet.dictionary.page.size": 4 << 20, "parquet.page.row.count.limit": 1 << 20}
#: Bits of a row's number inside its partition, as Spark gives them, and room for the code of a variable.
_ROW_BITS, _CODES = 33, 1024


def levels_in_time(base: DataFrame, parts: int | None = None) -> DataFrame:
    """Levels dealt out by ranges of (time, observation), which Spark cuts from a sample, and sorted inside them.

    Done before the levels are made long, so a fifteenth of the rows is shuffled and sorted; what is made of them keeps
    their order.  A range holds few months, a large month many ranges.  A number of ``parts`` is kept as it is; without
    it Spark joins small ranges.
    """
    ranges = base.repartitionByRange(parts, *IN_TIME) if parts else base.repartitionByRange(*IN_TIME)
    return ranges.sortWithinPartitions(*IN_TIME)


def append_levels(levels: DataFrame, path: str) -> None:
    """Appends typed level rows, partitioned by the month of their report."""
    rows = levels.withColumns({"year": F.year("report_timestamp"), "month": F.month("report_timestamp")})
    by_month(rows).write.mode("append").partitionBy(*MONTH).parquet(path)


def write_run(rows: DataFrame, path: str, monthly: bool = False) -> T.StructType:
    """Rows of one run in a new folder, by month of their report if asked; gives the schema they are read with."""
    if monthly:
        rows = rows.withColumns({"year": F.year("report_timestamp"), "month": F.month("report_timestamp")})
        by_month(rows).write.partitionBy(*MONTH).parquet(path)
    else:
        rows.write.parquet(path)
    return rows.schema


def write_tab_text(df: DataFrame, path: str) -> None:
    """Text load form: tab separated, ``\\N`` for missing, no header."""
    df.write.mode("append").csv(path, sep="\t", nullValue="\\N", emptyValue="", header=False)


def levels_by_day(base: DataFrame, parts: list[tuple[int, int]]) -> DataFrame:
    """Levels dealt out by whole days to the given parts (day, part), numbered in the order of time, and sorted inside them
    by (time, observation).  No sample is taken, so the levels are worked out once."""
    spark = base.sparkSession
    days = F.broadcast(spark.createDataFrame(parts, "_day int, _part int"))  # at most 366 per year
    dealt = base.join(days, cdm.day(F.col("report_timestamp")) == F.col("_day"))
    number = max((part for _, part in parts), default=0) + 1
    return dealt.repartitionById(number, F.col("_part")).drop("_day", "_part").sortWithinPartitions(*IN_TIME)


def write_long_table(long: DataFrame, path: str) -> None:
    """Encoded long table by month, with its dictionary beside the months.  Months
    that are written are replaced, the others stay (dynamic overwrite), so a re-run is safe.

    The rows are written where they are: order the levels before they are made long (``levels_by_day`` or
    ``levels_in_time``).  Then each file of a month holds a range of time, by (variable, time, observation), and the files' names follow the ranges.  Rows come
    in the order of their levels, so only (month, variable) is left to arrange: one number that ends with the row's place
    is enough, which Spark arranges by its digits without comparing rows."""
    spark = long.sparkSession
    write_variable_dim(spark, f"{path}/{DICTIONARY}")
    rows = cdm.with_month(cdm.encoded_long_table(long))
    group = (F.col("year") * 12 + F.col("month")).cast("long") * _CODES + F.col("observed_variable")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rows = rows.withColumn("_place", F.shiftleft(F.coalesce(group, F.lit(0)), _ROW_BITS).bitwiseOR(place))
    before = spark.conf.get(WRITERS_CONF)
    spark.conf.set(WRITERS_CONF, str(WRITERS))  # a task's files stay open side by side, else Spark would sort by month again
    try:
        rows.sortWithinPartitions("_place").drop("_place").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").options(**STORED).partitionBy(*MONTH).parquet(path)
    finally:
        spark.conf.set(WRITERS_CONF, before)


def written_months(spark: SparkSession, path: str) -> DataFrame:
    """(year, month) partitions present below ``path``, by the names of its folders;
    none if it is absent.  No file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or []
    names = [str(f.getPath().toString()).rstrip("/").split("/")[-2:] for f in found]
    months = sorted({(int(y.split("=")[1]), int(m.split("=")[1])) for y, m in names if "__" not in y + m})
    return spark.createDataFrame(months, "year int, month int")  # at most 12 per year


def write_tiles(rows: DataFrame, path: str, degrees: float = C.TILE_DEGREES) -> None:
    """Rows with a station position, laid out by latitude and longitude tile; tiles that are written are replaced, the
    others stay.  A large tile is cut into many files, small ones are joined into one task.  Rows without a position lie
    in the tile of missing values."""
    tiled = cdm.with_tiles(rows, degrees)
    (
        tiled.hint("rebalance", *[F.col(name) for name in TILE])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*TILE).parquet(path)
    )


def write_variable_dim(spark: SparkSession, path: str) -> None:
    cdm.variable_dim(spark).coalesce(1).write.mode("overwrite").parquet(path)


def sonde_folder(sonde: Column) -> Column:
    """Output folder of a sonde type (its own name if it has none)."""
    names = F.create_map(*[F.lit(x) for pair in C.SONDE_FOLDERS.items() for x in pair])
    return F.coalesce(names[sonde], sonde)


@dataclass
class Written:
    expected: int
    found: int

    @property
    def complete(self) -> bool:
        return self.expected == self.found


def export_soundings(levels: DataFrame, attrs: DataFrame, path: str) -> Written:
    """Raw levels and attributes per sonde type, with a row count taken on the
    way out and checked against the files."""
    seen = Observation("levels written")
    rows = levels.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows = rows.withColumn("sonde_type", sonde_folder(F.col("sonde")))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("sonde_type").parquet(
        f"{path}/levels")
    tagged = attrs.withColumns(
        {"sonde_type": sonde_folder(F.col("sonde")), "attributes": attributes_json(F.col("attrs"))}
    )
    tagged.drop("attrs").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "sonde_type").parquet(f"{path}/attrs")
    found = levels.sparkSession.read.parquet(f"{path}/levels").count()
    return Written(seen.get["rows"], found)


def dump_csv(levels: DataFrame, headers: DataFrame, path: str, start_year: int, end_year: int,
             header_only: bool = False, compress: bool = True) -> None:
    """CSV dump with header lines: the header table, and the levels of the years
    [start_year, end_year] by year."""
    codec = "bzip2" if compress else "none"
    headers.write.mode("overwrite").csv(f"{path}/header", header=True, compression=codec)
    if header_only:
        return
    rows = levels.withColumn("year", F.year("report_timestamp"))
    rows = rows.where(F.col("year").between(start_year, end_year))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year").csv(
        f"{path}/data", header=True, compression=codec)


def dump_summary(levels: DataFrame, path: str, start_year: int, end_year: int) -> DataFrame:
    """Per outcome the number of requested years: exported (the dump holds every row
    of the year), skipped (there is none) or error (rows are missing from the dump).
    The dump is read back and counted, not only listed."""
    spark = levels.sparkSession
    years = spark.range(start_year, end_year + 1).select(F.col("id").cast("int").alias("year"))
    have = levels.groupBy(F.year("report_timestamp").alias("year")).agg(F.count(F.lit(1)).alias("rows"))
    folder = f"{path}/data"
    if exists(spark, folder) and spark.read.text(folder).limit(1).count():
        dumped = spark.read.csv(folder, header=True, mode="PERMISSIVE").groupBy(F.col("year").cast("int").alias("year")).agg(
            F.count(F.lit(1)).alias("dumped"))
    else:
        dumped = spark.createDataFrame([], "year int, dumped long")
    joined = years.join(have, "year", "left").join(dumped, "year", "left")
    rows, found = F.coalesce("rows", F.lit(0)), F.coalesce("dumped", F.lit(0))
    outcome = F.when(rows != found, F.lit("error")).when(rows == 0, F.lit("skipped")).otherwise(F.lit("exported"))
    return joined.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("tables"))


def quarantine(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def truncate(spark: SparkSession, path: str, contract: T.StructType) -> None:
    """Leaves an empty table with the contract's schema."""
    empty = spark.createDataFrame([], contract)
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
