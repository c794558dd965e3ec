"""Which file of a sounding, and which members of an archive, are kept.

The survivor of a launch is found by a window over its few files; launches over a
fixed number of files are aggregates, combined before their shuffle and joined
back.  The outcome of an archive is folded from one state per (archive, revision),
so no archive's members ever gather in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ascentframe.functions import naming as N
from ascentframe.functions.text import short_error
from ascentframe.operators.ordered import hot_limit, join_same

KEEP, SKIP = "keep", "skip"


def select_survivors(files: DataFrame, pattern_name: str = "archive") -> DataFrame:
    """Every file with ``outcome`` and ``reason``.  Per (station, datetime) the
    best is kept: preferred folder, then highest group number, then highest
    revision, then path."""
    parsed = N.parse_archive_names(files)
    parsed = parsed.withColumn("priority", N.folder_priority(F.col("path")))
    # a name that does not match is a group of its own
    parsed = parsed.withColumns(
        {"_site": F.coalesce("station", F.lit("")), "_launch": F.coalesce("datetime", "path")}
    )
    rank = F.struct(F.col("priority"), (-F.col("group_no")).alias("g"), (-F.col("rev_no")).alias("r"), F.col("path"))
    best = F.min_by(F.struct("path", "filename", "priority", "group_no", "rev_no"), rank)
    launch = ["_site", "_launch"]
    hot = parsed.where("matches").groupBy(*launch).count().where(F.col("count") > hot_limit(files.sparkSession)).drop("count")
    cold = parsed
    if held := hot.collect():  # launches shared by a million files and more
        hot = files.sparkSession.createDataFrame(held, hot.schema)
        cold = join_same(parsed, hot, launch, "left_anti")
    judged = cold.withColumn("best", best.over(Window.partitionBy(*launch)))
    if held:
        crowded = join_same(parsed, hot, launch, "left_semi")
        bests = crowded.groupBy(*launch).agg(best.alias("best"))
        judged = judged.unionByName(crowded.join(bests, launch))
    # fixed values: the reason texts, here and below
    reason = (
        F.when(~F.col("matches"), F.lit(f"Filename does not match {pattern_name} pattern"))
        .when(F.col("path") == F.col("best.path"), F.lit(None))
        .when(
            F.col("priority") > F.col("best.priority"),
            F.format_string("Superseded by file from higher priority folder (RS-0%d): %s",
                            F.col("best.priority"), F.col("best.filename")),
        )
        .otherwise(
            F.format_string("Superseded by newer version: %s (group %d, rev %d vs group %d, rev %d)",
                            F.col("best.filename"), F.col("best.group_no"), F.col("best.rev_no"),
                            F.col("group_no"), F.col("rev_no"))
        )
    )
    judged = judged.withColumn("reason", reason)
    outcome = F.when(F.col("reason").isNull(), F.lit(KEEP)).otherwise(F.lit(SKIP))
    return judged.withColumn("outcome", outcome).drop("best", "_site", "_launch")


def _marked(members: DataFrame) -> DataFrame:
    """What a member's name says: data or not, in the root or not, revisions of its folder and of its name, and the one
    it counts under."""
    member = F.col("member")
    is_data, in_root = member.endswith(".nc"), ~member.contains("/")
    folder_rev = F.regexp_extract(member, r"rev(\d{3})/", 1).try_cast("int")
    name_rev = F.regexp_extract(member, r"_rev(\d{3})\.nc$", 1).try_cast("int")
    return members.withColumns(
        {
            "is_data": is_data,
            "in_root": in_root,
            "folder_rev": folder_rev,
            "name_rev": name_rev,
            "rev": F.coalesce(folder_rev, F.when(is_data & in_root, name_rev)),
        }
    )


def select_members(members: DataFrame) -> DataFrame:
    """Every ``(archive, member)`` with ``outcome``, ``reason`` and ``latest_rev``.

    Archives with revisions (a ``revNNN/`` folder or a ``_revNNN.nc`` name) keep
    the data members of the highest one.  Archives without keep their root data
    members.
    """
    marked = _marked(members.dropDuplicates(["archive", "member"]))
    member, is_data, in_root = F.col("member"), F.col("is_data"), F.col("in_root")
    latest = marked.groupBy("archive").agg(F.max("rev").alias("latest_rev"))
    marked = marked.join(latest, "archive", "left")
    top = F.format_string("rev%03d/", F.col("latest_rev"))
    chosen = (
        F.when(
            F.col("latest_rev").isNotNull(),
            is_data & (F.startswith(member, top) | F.coalesce(F.col("name_rev") == F.col("latest_rev"), F.lit(False))),
        ).otherwise(is_data & in_root)
    )
    older = F.format_string("Older revision (rev%03d) - using latest revision rev%03d", F.col("rev"), F.col("latest_rev"))
    reason = (
        F.when(chosen, F.lit(None))
        .when(~is_data, F.lit("Not a data member"))
        .when(F.col("rev") < F.col("latest_rev"), older)
        .when(F.col("latest_rev").isNotNull(), F.lit("No revision, archive has revisions"))
        .otherwise(F.lit("Not in the archive root"))
    )
    return marked.select(
        "archive", "member", "latest_rev", "rev",
        F.when(chosen, F.lit(KEEP)).otherwise(F.lit(SKIP)).alias("outcome"),
        reason.alias("reason"),
    )


def latest_per_base_name(members: DataFrame) -> DataFrame:
    """Root data members grouped by name without ``_revNNN``: the highest
    revision is kept, the others carry a reason."""
    roots = members.dropDuplicates(["archive", "member"]).where(
        F.col("member").endswith(".nc") & ~F.col("member").contains("/")
    )
    roots = roots.withColumns(
        {
            "base": N.without_revision(F.col("member")),
            "rev": F.coalesce(F.regexp_extract("member", r"_rev(\d{3})\.nc$", 1).try_cast("int"), F.lit(0)),
        }
    )
    best = roots.groupBy("archive", "base").agg(
        F.min_by(F.struct("member", "rev"), F.struct((-F.col("rev")).alias("r"), F.col("member"))).alias("best")
    )
    judged = roots.join(best, ["archive", "base"])
    reason = F.format_string(
        "Older revision in filename (rev%03d) - using rev%03d", F.col("rev"), F.col("best.rev")
    )
    kept = F.col("member") == F.col("best.member")
    return judged.select(
        "archive", "member", "base", "rev",
        F.when(kept, F.lit(KEEP)).otherwise(F.lit(SKIP)).alias("outcome"),
        F.when(~kept, reason).alias("reason"),
    )


def archives_without_members(archives: DataFrame, judged: DataFrame) -> DataFrame:
    """Archives that have nothing to load, with the reason."""
    found = judged.groupBy("archive").agg(
        F.count_if(F.col("member").endswith(".nc")).alias("data_members"),
        F.count_if(F.col("outcome") == KEEP).alias("kept"),
    )
    joined = archives.select("archive").distinct().join(found, "archive", "left")
    none_found = F.coalesce(F.col("data_members"), F.lit(0)) == 0
    reason = F.when(none_found, F.concat(F.lit("No data files found in "), F.col("archive"))).otherwise(
        F.concat(F.lit("No valid data files to process after revision filtering in "), F.col("archive"))
    )
    return joined.where(F.coalesce(F.col("kept"), F.lit(0)) == 0).select("archive", reason.alias("reason"))


#: Entries of an archive: its members by revision, its choice for each revision that could be the latest, damage.
_MEMBERS, _CHOICE, _DAMAGE = "members", "choice", "damage"
#: The revision of members without one; their choice counts where the archive has no revisions.
_NONE = -1


def archive_states(members: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """(archive, kind, k, ...) states: how many members revision k has, and what its choice would come to.

    ``members``: archive, member, ord, loaded, reason; one row per member.  ``errors``: archive, error.  A member adds to
    the revision it counts under and to those it would be chosen for; which one is the latest is seen only when an
    archive's states meet.  Names carry three digits, so an archive has a bounded number of states.
    """
    marked = _marked(members)
    chosen_for = F.array(
        F.when(F.col("is_data") & F.col("in_root"), F.lit(_NONE)),
        F.when(F.col("is_data"), F.regexp_extract("member", r"^rev(\d{3})/", 1).try_cast("int")),
        F.when(F.col("is_data"), F.col("name_rev")),
    )
    choices = F.transform(F.array_distinct(F.filter(chosen_for, lambda k: k.isNotNull())),
                          lambda k: F.struct(F.lit(_CHOICE).alias("kind"), k.alias("k")))
    own = F.array(F.struct(F.lit(_MEMBERS).alias("kind"), F.coalesce("rev", F.lit(_NONE)).alias("k")))
    failed = ~F.col("loaded") & F.col("reason").isNotNull()
    entries = marked.select(
        "archive", F.explode(F.concat(own, choices)).alias("at"), "is_data", "loaded", failed.alias("failed"), "rev",
        F.when(failed, F.struct("ord", short_error(F.col("reason")).alias("text"))).alias("error"),
    ).select("archive", "at.*", "is_data", "loaded", "failed", "rev", "error")
    if errors is not None:
        broken = errors.where(F.col("error").isNotNull()).select(
            "archive", F.lit(_DAMAGE).alias("kind"), F.lit(_NONE).alias("k"),
            F.struct(F.lit(None).cast(entries.schema["error"].dataType["ord"].dataType).alias("ord"), F.col("error").alias("text")).alias("error"))
        entries = entries.unionByName(broken, allowMissingColumns=True)
    return entries.groupBy("archive", "kind", "k").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_data").alias("data"),
        F.count_if("loaded").alias("loaded"),
        F.count_if("failed").alias("failed"),
        F.count_if(F.col("rev") < F.col("k")).alias("older"),
        F.min("error").alias("error"),
    )


def fold_archives(states: DataFrame) -> DataFrame:
    """One verdict per archive from its states (archive, success, note): the choice of its latest revision counts."""
    per = states.groupBy("archive").agg(F.collect_list(F.struct("kind", "k", "n", "data", "loaded", "failed", "older", "error")).alias("states"))

    def of(kind: str):
        return F.filter("states", lambda s: s["kind"] == kind)

    latest = F.nullif(F.array_max(F.transform(of(_MEMBERS), lambda s: s["k"])), F.lit(_NONE))
    per = per.withColumn("latest_rev", latest).withColumns(
        {
            "choice": F.get(F.filter(of(_CHOICE), lambda s: s["k"] == F.coalesce("latest_rev", F.lit(_NONE))), F.lit(0)),
            "data": F.aggregate(of(_MEMBERS), F.lit(0).cast("long"), lambda sum_, s: sum_ + s["data"]),
            "below": F.aggregate(of(_MEMBERS), F.lit(0).cast("long"), lambda sum_, s: sum_ + F.when(
                (s["k"] > _NONE) & (s["k"] < F.col("latest_rev")), s["data"]).otherwise(0)),
            "damage": F.get(of(_DAMAGE), F.lit(0))["error"]["text"],
        }
    )
    zero = F.lit(0).cast("long")
    per = per.select(
        "archive", "latest_rev", "data", "damage",
        F.coalesce("choice.n", zero).alias("total"),
        F.coalesce("choice.loaded", zero).alias("processed"),
        F.coalesce("choice.failed", zero).alias("errors"),
        F.col("choice.error.text").alias("first_error"),
        (F.col("below") - F.coalesce("choice.older", zero)).cast("int").alias("skipped"),
    )
    ok, told = _verdict()
    nothing = (
        F.when(F.col("data") == 0, F.concat(F.lit("No data files found in "), F.col("archive")))
        .when(F.col("total") == 0, F.concat(F.lit("No valid data files to process after revision filtering in "), F.col("archive")))
    )
    whole = F.col("damage").isNull()
    return per.select("archive", (ok & whole).alias("success"), F.coalesce("damage", nothing, told).alias("note"))


def _verdict():
    """Success and note of an archive from total, processed, errors, first_error, skipped and latest_rev."""
    ok = (F.col("processed") == F.col("total")) & (F.col("processed") > 0)
    older = F.format_string("Skipped %d files from older revisions", F.col("skipped"))
    good = F.concat(
        F.concat_ws(
            ". ",
            F.format_string("Successfully processed %d data files", F.col("processed")),
            F.when(F.col("latest_rev").isNotNull(), F.format_string("from revision rev%03d", F.col("latest_rev"))),
            F.when(F.col("skipped") > 0, older),
        ),
        F.lit("."),
    )
    main = short_error(F.col("first_error"))
    bad = (
        F.when(F.col("errors") > 1, F.format_string("%s (+ %d other errors)", main, F.col("errors") - 1))
        .when(F.col("errors") == 1, main)
        .when(F.col("processed") == 0, F.format_string("Failed to process all %d data files", F.col("total")))
        .otherwise(F.format_string("Partially processed %d/%d files", F.col("processed"), F.col("total")))
    )
    bad = F.concat(bad, F.when(F.col("skipped") > 0, F.concat(F.lit(". "), older)).otherwise(F.lit("")))
    return ok, F.when(ok, good).otherwise(bad)


def archive_outcomes(members: DataFrame) -> DataFrame:
    """One verdict per archive from its processed members.

    Input: ``archive, member, ord, ok, error, skipped, latest_rev`` (one row per
    chosen member; ``skipped`` is the archive's count of older members).
    """
    per = members.groupBy("archive").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("ok")).alias("processed"),
        F.count(F.when(~F.col("ok"), F.col("error"))).alias("errors"),
        F.min_by("error", F.when(~F.col("ok") & F.col("error").isNotNull(), F.col("ord"))).alias("first_error"),
        F.max("skipped").alias("skipped"),
        F.max("latest_rev").alias("latest_rev"),
    )
    ok, told = _verdict()
    return per.select("archive", "total", "processed", "errors", ok.alias("success"), told.alias("note"))
