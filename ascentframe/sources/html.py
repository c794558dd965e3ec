"""Table and list rows of HTML pages held in a string column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: character references decoded in cell text
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&deg;", "°"),
            ("&amp;", "&"))


def plain_text(fragment: Column) -> Column:
    """Tags removed, common character references decoded, ends trimmed."""
    text = F.regexp_replace(fragment, r"<[^>]*>", "")
    for code, char in ENTITIES:
        text = F.replace(text, F.lit(code), F.lit(char))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def element_bodies(html: Column, tag: str) -> Column:
    """Inner HTML of every non-nested ``tag`` element, in page order."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), F.lit(1))


#: Pages that a task takes apart; a small file of pages would else be the work of one task.
PART_PAGES = 10_000


def table_rows(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """One row per body row of the first table of each page, header row left
    out: ``row_no`` (from 1) and ``cells`` (array of text)."""
    parts = -(-pages.count() // PART_PAGES)
    if parts > 1:
        pages = pages.repartition(parts, *keep)
    first_table = F.get(element_bodies(F.col(html), "table"), 0)
    rows = pages.select(*keep, F.posexplode(element_bodies(first_table, "tr")).alias("row_no", "_row"))
    cells = F.transform(element_bodies(F.col("_row"), "td"), plain_text)
    return rows.where("row_no > 0").select(*keep, "row_no", cells.alias("cells"))


def elements(pages: DataFrame, html: str, tag: str, keep: list[str]) -> DataFrame:
    """One row per ``tag`` element: ``pos`` (from 0) and its plain ``text``."""
    rows = pages.select(*keep, F.posexplode(element_bodies(F.col(html), tag)).alias("pos", "_body"))
    return rows.select(*keep, "pos", plain_text(F.col("_body")).alias("text"))
