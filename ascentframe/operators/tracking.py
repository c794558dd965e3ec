"""Import state of every file, without updates in place.

State changes are appended as events; the state of a file is its latest event.
"Latest" is a map-side combined ``max_by``, so repeated events of one file never
gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ascentframe.functions.text import note

KEYS = ["sonde", "filename"]
REGISTERED, SKIPPED, IMPORTED, FAILED = "registered", "skipped", "imported", "failed"


def register(known: DataFrame, found: DataFrame) -> DataFrame:
    """New rows for files not yet known: insert if absent."""
    new = found.select(*KEYS).dropDuplicates(KEYS).join(known.select(*KEYS), KEYS, "left_anti")
    return new.withColumns(
        {"date_of_import": F.lit(None).cast("timestamp"), "note": F.lit(None).cast("string")}
    )


def with_registered(known: DataFrame, found: DataFrame) -> DataFrame:
    return known.unionByName(register(known, found), allowMissingColumns=True)


def event(files: DataFrame, kind: str | Column, seq: Column, at: Column | None = None, text: Column | None = None,
          also: Sequence[str] = ()) -> DataFrame:
    """Event rows (sonde, filename, kind, seq, at, text) for ``files``, with the columns ``also`` of theirs."""
    return files.select(
        *KEYS,
        F.lit(kind).alias("kind"),
        seq.cast("long").alias("seq"),
        (at if at is not None else F.lit(None)).cast("timestamp").alias("at"),
        (text if text is not None else F.lit(None)).cast("string").alias("text"),
        *also,
    )


def current_state(events: DataFrame) -> DataFrame:
    """One row per file.  A registration never changes a known state; a skip
    of an imported file does not un-import it; a success keeps its message in
    ``detail`` and leaves ``note`` empty."""
    moved = F.col("kind") != REGISTERED
    latest = events.groupBy(*KEYS).agg(
        F.max_by(F.struct("kind", "at", "text"), F.when(moved, F.struct("seq", "kind"))).alias("last"),
        F.max_by(F.struct("at", "text"), F.when(F.col("kind") == IMPORTED, F.col("seq"))).alias("done"),
        F.max(F.when(F.col("kind") == IMPORTED, F.col("seq"))).alias("imported_seq"),
        F.max(F.when(F.col("kind") == FAILED, F.col("seq"))).alias("failed_seq"),
    )
    kind = F.col("last.kind")
    stands = F.col("imported_seq").isNotNull() & (
        F.col("failed_seq").isNull() | (F.col("failed_seq") < F.col("imported_seq"))
    )
    return latest.select(
        *KEYS,
        F.when(stands, F.col("done.at")).alias("date_of_import"),
        F.when(~stands & kind.isin(SKIPPED, FAILED), note(F.col("last.text"))).alias("note"),
        F.when(stands, F.col("done.text")).alias("detail"),
    )


def standing_events(events: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The events that ``current_state`` looks at, at most four for each file: its latest move, import and failure, and a
    registration.  Reduced events give the same state, also together with later ones."""
    fields = ["kind", "seq", "at", "text"]
    whole = F.struct(*fields)
    # the order in which current_state takes them
    picks = {
        "moved": F.max_by(whole, F.when(F.col("kind") != REGISTERED, F.struct("seq", "kind"))),
        "done": F.max_by(whole, F.when(F.col("kind") == IMPORTED, F.col("seq"))),
        "bad": F.max_by(whole, F.when(F.col("kind") == FAILED, F.col("seq"))),
        "known": F.max_by(whole, F.when(F.col("kind") == REGISTERED, F.col("seq"))),
    }
    kept = events.groupBy(*KEYS, *also).agg(*[pick.alias(name) for name, pick in picks.items()])
    rows = F.array_distinct(F.filter(F.array(*[F.col(name) for name in picks]), lambda e: e.isNotNull()))
    return kept.select(*KEYS, F.explode(rows).alias("e"), *also).select(*KEYS, *[f"e.{name}" for name in fields], *also)


def imported(state: DataFrame, sonde: str | None = None) -> DataFrame:
    done = state.where("date_of_import IS NOT NULL")
    return done.where(F.col("sonde") == sonde) if sonde else done


def already_imported(candidates: DataFrame, state: DataFrame) -> DataFrame:
    return candidates.join(imported(state).select(*KEYS), KEYS, "left_semi")


def still_to_import(candidates: DataFrame, state: DataFrame) -> DataFrame:
    return candidates.join(imported(state).select(*KEYS), KEYS, "left_anti")


def monitor(state: DataFrame) -> DataFrame:
    """Counts per sonde type."""
    waiting = F.col("date_of_import").isNull() & F.col("note").isNull()
    return (
        state.groupBy("sonde")
        .agg(
            F.count_if(waiting).alias("to_import"),
            F.count_if(F.col("date_of_import").isNotNull()).alias("imported"),
            F.count_if(F.col("note").isNotNull()).alias("excluded"),
            F.count(F.lit(1)).alias("total"),
        )
        .orderBy("sonde")
    )


def import_rates(state: DataFrame) -> DataFrame:
    """Files per second between the first and the last import of a sonde type."""
    span = F.unix_micros(F.max("date_of_import")) - F.unix_micros(F.min("date_of_import"))
    seconds = span / 1e6
    return imported(state).groupBy("sonde").agg(
        F.count(F.lit(1)).alias("files"),
        seconds.alias("seconds"),
        F.when(seconds > 0, F.count(F.lit(1)) / seconds).alias("files_per_second"),
    )
