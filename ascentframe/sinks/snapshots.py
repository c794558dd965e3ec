"""Tables that are loaded batch by batch, several tables as one unit.

A run of a batch writes each of its tables into a folder of its own, which nothing changes afterwards::

    root/<table>/batch=<batch>/run=<run>[/year=../month=..]/part-...parquet
    root/_lists/0000000007.json

The newest list names the run that counts for every batch, and the schema of every table.  Publishing a run writes the
next list and gives it its name in one rename: before it readers see the old run of the batch in all tables, after it the
new one in all tables.  Readers take only the folders of the runs in the list, so what a broken run left, or what a run
that was replaced holds, is never read.  A batch that is loaded again is thereby replaced whole, also where it has fewer
rows, other months, or none at all.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LISTS = "_lists"
BATCH, RUN = "batch", "run"
_LIST_NAME = re.compile(r"(\d{10})\.json")


@dataclass(frozen=True)
class Snapshot:
    """One list: the run that counts for each batch, the schema of each table (with its partition columns)."""

    number: int = 0
    runs: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, T.StructType] = field(default_factory=dict)


def folder(root: str, table: str, batch: str, run: str) -> str:
    return f"{root}/{table}/{BATCH}={quote(batch, safe='')}/{RUN}={run}"


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    files, place = _files(spark, pattern)
    return [f.getPath().toString() for f in files.globStatus(place) or []]


def current(spark: SparkSession, root: str) -> Snapshot:
    """The newest list; an empty one if nothing was published yet."""
    names = [(int(m[1]), path) for path in _glob(spark, f"{root}/{LISTS}/*.json") if (m := _LIST_NAME.fullmatch(path.rsplit("/", 1)[1]))]
    if not names:
        return Snapshot()
    number, path = max(names)
    held = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return Snapshot(number, held["runs"], {name: T.StructType.fromJson(s) for name, s in held["schemas"].items()})


def publish(spark: SparkSession, root: str, batch: str, run: str, schemas: dict[str, T.StructType]) -> Snapshot:
    """Makes ``run`` the one that counts for ``batch`` in all tables, by one rename.

    Batches are loaded one after the other: a list that someone else has published meanwhile is an error, and the run
    does not count.
    """
    last = current(spark, root)
    new = Snapshot(last.number + 1, {**last.runs, batch: run}, {**last.schemas, **schemas})
    text = json.dumps({"runs": new.runs, "schemas": {name: s.jsonValue() for name, s in new.schemas.items()}})
    files, draft = _files(spark, f"{root}/{LISTS}/_draft-{run}")
    _, final = _files(spark, f"{root}/{LISTS}/{new.number:010d}.json")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(final) or not files.rename(draft, final):
        raise RuntimeError(f"list {new.number} of {root} was published by another load")
    return new


def read(spark: SparkSession, root: str, table: str, batch: str | None = None) -> DataFrame:
    """Rows of the runs that count, of all batches or one, with the columns ``batch`` and ``run``.

    An unknown table is an error; one that no batch wrote a row for is empty.
    """
    snapshot = current(spark, root)
    if table not in snapshot.schemas:
        raise ValueError(f"no table {table} was published below {root}")
    schema = T.StructType([*snapshot.schemas[table].fields, T.StructField(BATCH, T.StringType()), T.StructField(RUN, T.StringType())])
    wanted = {b: r for b, r in snapshot.runs.items() if batch is None or b == batch}
    paths = [folder(root, table, b, r) for b, r in sorted(wanted.items())]
    files, _ = _files(spark, root)
    paths = [p for p in paths if files.exists(_files(spark, p)[1])]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths)


def months(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(year, month) that the runs that count have rows in, by the names of their folders; no file is opened."""
    snapshot, found = current(spark, root), set()
    counted = {f"{BATCH}={quote(b, safe='')}/{RUN}={r}" for b, r in snapshot.runs.items()}
    for path in _glob(spark, f"{root}/{table}/{BATCH}=*/{RUN}=*/year=*/month=*"):
        *_, batch, run, year, month = path.rstrip("/").split("/")
        if f"{batch}/{run}" in counted and "__" not in year + month:
            found.add((int(year.split("=")[1]), int(month.split("=")[1])))
    return spark.createDataFrame(sorted(found), "year int, month int")  # at most 12 per year


def clear(spark: SparkSession, root: str) -> int:
    """Deletes runs that no longer count and lists but the newest; gives the number of deleted runs.

    Nobody may be loading or reading an older list meanwhile.
    """
    snapshot, gone = current(spark, root), set()
    counted = {f"{BATCH}={quote(b, safe='')}/{RUN}={r}" for b, r in snapshot.runs.items()}
    files, _ = _files(spark, root)
    for path in _glob(spark, f"{root}/*/{BATCH}=*/{RUN}=*"):
        if (run := "/".join(path.rstrip("/").split("/")[-2:])) not in counted:
            files.delete(_files(spark, path)[1], True)
            gone.add(run)
    for path in _glob(spark, f"{root}/{LISTS}/*"):
        if path.rsplit("/", 1)[1] != f"{snapshot.number:010d}.json":
            files.delete(_files(spark, path)[1], False)
    return len(gone)
