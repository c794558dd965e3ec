"""Archive and member names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the pattern of an archive name, and the names of its groups ---
ARCHIVE_PATTERN = r"([A-Z]{3})-RS-\d+_(\d+_)?(RS[0-9A-Z\-]+|IMS-\d+-GDP)_(\d{3})_(\d{8}T\d{6})_(\d-\d{3}-\d{3})_([A-Z0-9]+)(?:_rev(\d{3}))?\.jar$"
ARCHIVE_FIELDS = ["station", "extra", "product", "version", "datetime", "group", "id", "rev"]

# --- fixed value: files below this folder are preferred ---------------------------
PREFERRED_FOLDER = "-RS-02"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_extract(base_name(path), r"^(.+?)(\.[^.]*)?$", 1)


def without_revision(member: Column) -> Column:
    return F.regexp_extract(member, r"(.+?)(?:_rev\d{3})?\.nc$", 1)


_SPLIT = "\x01"
_ALL_FIELDS = _SPLIT.join(f"${place}" for place in range(1, len(ARCHIVE_FIELDS) + 1))


def parse_archive_names(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``filename``, ``matches`` and the parsed fields; ``group_no`` and
    ``rev_no`` as numbers (no revision counts as 0).  A name that does not match
    has NULL fields.  The pattern is evaluated once per name."""
    df = files.withColumn("filename", base_name(F.col(path)))
    df = df.withColumn("_parts", F.split(F.regexp_replace("filename", f"^.*?{ARCHIVE_PATTERN}", _ALL_FIELDS), _SPLIT))
    df = df.withColumn("matches", F.size("_parts") == len(ARCHIVE_FIELDS))
    fields = {
        name: F.when(F.col("matches"), F.nullif(F.get("_parts", F.lit(place)), F.lit("")))
        for place, name in enumerate(ARCHIVE_FIELDS)
    }
    df = df.withColumns(fields).drop("_parts")
    return df.withColumns(
        {
            "group_no": F.split_part("group", F.lit("-"), F.lit(3)).try_cast("int"),
            "rev_no": F.when(F.col("matches"), F.coalesce(F.col("rev").try_cast("int"), F.lit(0))),
        }
    )


def folder_priority(path: Column) -> Column:
    """1 below the preferred station folder, else 2."""
    folders = F.split(path, "/")
    return F.when(F.exists(folders, lambda part: part.endswith(PREFERRED_FOLDER)), 1).otherwise(2)
