"""From discovered files to stored soundings."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe import contracts as C
from ascentframe.functions import naming, text
from ascentframe.operators import diagnostics, gates, schema, survivorship, tracking
from ascentframe.operators.ordered import per_group, sizes_known
from ascentframe.session import ensure_checkpoint_dir
from ascentframe.sinks import snapshots, writers

IMPORT, SKIP = "import", "skip"
#: Tables of a store.
LEVELS, HEADERS, REJECTS = "levels", "headers", "rejects"


def plan_import(files: DataFrame, state: DataFrame, sonde: str, pattern_name: str = "archive") -> DataFrame:
    """Every discovered file with ``outcome`` (import or skip) and ``reason``.

    Discover, parse, choose survivors, drop the imported ones: one lazy plan.
    """
    judged = survivorship.select_survivors(files, pattern_name).withColumn("sonde", F.lit(sonde))
    done = tracking.imported(state, sonde).select(*tracking.KEYS, F.lit(True).alias("_done"))
    joined = judged.join(done, tracking.KEYS, "left")
    kept = F.col("outcome") == survivorship.KEEP
    reason = F.when(kept & F.col("_done"), F.lit("File already imported")).otherwise(F.col("reason"))
    return joined.withColumns(
        {"reason": reason, "outcome": F.when(reason.isNull(), IMPORT).otherwise(SKIP)}
    ).drop("_done")


def plan_events(plan: DataFrame, seq: int, also: Sequence[str] = ()) -> DataFrame:
    """Tracking events of a plan: registrations and skips, in one pass; the columns ``also`` of the plan stay."""
    skipped = F.col("outcome") == SKIP
    kind = F.when(skipped, tracking.SKIPPED).otherwise(tracking.REGISTERED)
    return tracking.event(plan, kind, F.lit(seq), text=F.when(skipped, F.col("reason")), also=also)


def outcome_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("outcome").count().orderBy("outcome")


@dataclass
class Loaded:
    accepted: int
    rejected: int


# columns that every stored header has; the attributes follow by the contract
HEADER_KEYS = ("g_product_id", "idstation_pk", "report_timestamp", "conventions", "first_observation_id", "n_levels")
#: Contract of a store that is made for the export; a stored table's own contract may be given instead.
HEADER_CONTRACT = T.StructType(
    [T.StructField(name, T.StringType()) for pair in C.HEADER_TEXT.values() for name in pair]
    + [T.StructField(name, T.DoubleType()) for pair in C.HEADER_NUMBERS.values() for name in pair]
    + [T.StructField("g_general_sitewmoid", T.StringType())]
)


def header_of(good: DataFrame, contract: T.StructType) -> DataFrame:
    """Accepted soundings (attrs, station_key, ...) as header rows: every contract column is looked up among the
    attributes by its cleaned name, old dialects fill the site number, and types follow the contract."""
    clean = F.transform_keys(text.lower_keys(F.col("attrs")), lambda k, _: F.translate(k, ".- ", "___"))
    folded = good.withColumn("_attrs", clean)
    wanted = [f.name for f in contract.fields if f.name not in HEADER_KEYS]
    values = {name: F.col("_attrs")[name] for name in wanted}
    if "g_general_sitewmoid" in values:
        old = F.when(F.col("conventions").isin(*C.OLD_DIALECTS), F.col("station_key"))
        values["g_general_sitewmoid"] = F.coalesce(values["g_general_sitewmoid"], old)
    texts = folded.select(*HEADER_KEYS, *[value.alias(name) for name, value in values.items()])
    typed = T.StructType([texts.schema[name] for name in HEADER_KEYS] + [f for f in contract.fields if f.name not in HEADER_KEYS])
    return schema.align_to_contract(texts, typed).df


def first_ids(good: DataFrame, start: int) -> DataFrame:
    """``good`` (g_product_id, n_levels, ...) with the number of each sounding's first level: soundings follow each other
    in the order of their ids.  One row per sounding is summed; the sum is cut into parts where there are many."""
    def work(group):
        return group.running({"_upto": F.col("n_levels")}).df

    rows = per_group(good.withColumn("_all", F.lit(1)), ["_all"], [F.asc("g_product_id")], work)
    first = F.lit(start) + F.col("_upto") - F.col("n_levels") + 1
    return rows.withColumn("first_observation_id", first).drop("_all", "_upto")


def _start_id(good: DataFrame, root: str, batch: str) -> int:
    """The observation id before the batch's first: what it had, if it is loaded again with as many levels; else the
    greatest of the other batches.  Read from the header table."""
    spark = good.sparkSession
    if not snapshots.current(spark, root).runs:
        return 0
    headers = snapshots.read(spark, root, HEADERS).withColumn("_own", F.col(snapshots.BATCH) == batch)
    seen = headers.agg(
        F.min(F.when(F.col("_own"), F.col("first_observation_id"))).alias("first"),
        F.sum(F.when(F.col("_own"), F.col("n_levels"))).alias("levels"),
        F.max(F.when(~F.col("_own"), F.col("first_observation_id") + F.col("n_levels") - 1)).alias("last"),
    ).first()
    if seen["first"] is not None and seen["levels"] == good.agg(F.sum("n_levels")).first()[0]:
        return seen["first"] - 1
    return seen["last"] or 0


def load_soundings(levels: DataFrame, attrs: DataFrame, stations: DataFrame, network: str, root: str, sonde: str = "",
                   batch: str = "0", header_contract: T.StructType = HEADER_CONTRACT,
                   level_contract: T.StructType | None = None, order: str = "level_idx") -> Loaded:
    """Validates, numbers, diagnoses and stores one batch of soundings below ``root`` (tables levels, headers, rejects).

    A run writes into folders of its own and is published in one step when all three tables are there
    (``sinks.snapshots``).  Until then readers see what the batch held before, afterwards only the new rows, also where
    soundings are no longer rejected, lie in another month, or none is accepted.  A broken run is never read.  Load
    batches one after the other.  Verdicts are settled (checkpoint) before anything is written.  Levels are derived and
    written once; the scalars of the headers are computed from what is stored.
    """
    spark = levels.sparkSession
    ensure_checkpoint_dir(spark)
    run = uuid.uuid4().hex
    place = {name: snapshots.folder(root, name, batch, run) for name in (LEVELS, HEADERS, REJECTS)}
    has_time = F.count("time") if "time" in levels.columns else F.count(F.lit(1))
    counts = levels.groupBy("g_product_id").agg(F.count(F.lit(1)).alias("n_levels"), has_time.alias("n_times"))
    judged = gates.judge_soundings(attrs, counts, stations, network, sonde).checkpoint(eager=True)
    good = gates.accepted(judged)
    good = first_ids(good, _start_id(good, root, batch)).checkpoint(eager=True)

    keys = good.select("g_product_id", "conventions", "station_key", "idstation_pk", "report_timestamp", "first_observation_id")
    # counted above: neither the numbering nor the diagnostics work the levels out again to find hot soundings
    sizes = good.groupBy("g_product_id").agg(F.sum("n_levels").alias("_n"))
    numbered = per_group(levels.join(keys, "g_product_id"), ["g_product_id"], [F.asc(order)], lambda g: g.number("_nth").df, sizes)
    kept = numbered.withColumns({
        "observation_id": F.col("first_observation_id") + F.col("_nth") - 1,
        "g_general_sitewmoid": F.when(F.col("conventions").isin(*C.OLD_DIALECTS), F.col("station_key")),
    }).drop("_nth", "first_observation_id", "station_key")
    with sizes_known(sizes):
        out_levels = diagnostics.diagnosed_levels(kept).drop("valid", "n_valid", "conventions")
    if level_contract is not None:
        out_levels = schema.align_to_contract(out_levels, level_contract).df
    schemas = {LEVELS: writers.write_run(out_levels, place[LEVELS], monthly=True)}

    stored = spark.read.schema(schemas[LEVELS]).parquet(place[LEVELS])
    scalars = diagnostics.sounding_scalars(stored)  # stored humidity is in percent already
    schemas[HEADERS] = writers.write_run(header_of(good, header_contract).join(scalars, "g_product_id", "left"), place[HEADERS])
    schemas[REJECTS] = writers.write_run(gates.rejected(judged).select("g_product_id", "reason"), place[REJECTS])
    snapshots.publish(spark, root, batch, run, schemas)
    tally = judged.agg(F.count_if(F.col("reason").isNull()).alias("a"), F.count("reason").alias("r")).first()
    return Loaded(tally["a"], tally["r"])


def process_archives(members: DataFrame, verdicts: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Outcome of every archive: members -> revision choice -> verdict of each chosen member -> note.

    ``members``: archive, member, ord.  ``verdicts``: archive, member, reason (NULL: loaded), and optionally ``loaded``
    (false without a reason: never finished) and ``attempt``: the last attempt settles a member that has several, a reason
    wins among equal ones.  ``errors``: archive, error of archives that could not be opened.  An archive with nothing to
    load, or damaged, fails with its reason.  A chosen member without a verdict has failed.

    Three exchanges in all: members and verdicts are stacked and meet by member, member states are summed by (archive,
    revision) before they are sent, and the few states of an archive meet.
    """
    listed = members.where(F.col("member").isNotNull()).select("archive", "member", F.struct("ord").alias("place"))
    attempt = F.col("attempt") if "attempt" in verdicts.columns else F.lit(0)
    loaded = F.col("loaded") if "loaded" in verdicts.columns else F.col("reason").isNull()
    tried = verdicts.select("archive", "member", F.struct(
        attempt.alias("attempt"), F.col("reason").isNotNull().alias("told"), "reason", loaded.alias("loaded")).alias("last"))
    met = listed.unionByName(tried, allowMissingColumns=True).groupBy("archive", "member").agg(
        F.min("place").alias("place"), F.max("last").alias("last")).where(F.col("place").isNotNull())
    rows = met.select("archive", "member", "place.ord", F.coalesce("last.loaded", F.lit(False)).alias("loaded"), "last.reason")
    return survivorship.fold_archives(survivorship.archive_states(rows, errors))


def archive_events(outcomes: DataFrame, sonde: str, seq: int, at: Column | None = None) -> DataFrame:
    """Tracking events of processed archives: imported with the summary, or failed with the reason."""
    files = outcomes.where(F.col("success").isNotNull()).withColumns(
        {"sonde": F.lit(sonde), "filename": naming.base_name(F.col("archive"))})
    when = at if at is not None else F.current_timestamp()
    kind = F.when(F.col("success"), tracking.IMPORTED).otherwise(tracking.FAILED)
    return tracking.event(files, kind, F.lit(seq), F.when(F.col("success"), when), F.col("note"))
