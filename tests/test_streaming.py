"""Tracking state that does not reread its history."""

import pytest
from pyspark.sql import functions as F

from ascentframe.operators import tracking
from ascentframe.plans import importing
from ascentframe.streaming import incremental as I


def name(station, group, day, number):
    return f"/a/{station}-RS-01/{station}-RS-01_2_RS41-GDP_001_202401{day:02d}T000000_1-000-{group:03d}_AI{number}.jar"


def lot(spark, k):
    """Ten files of a lot: five new launches each, and a better file of launches that came two lots before."""
    new = [name("LIN", 1, d, 100 * k + d) for d in range(3 * k % 25 + 1, 3 * k % 25 + 4)] + [name("SYO", 2, k % 28 + 1, 1000 + k), f"/b/odd{k}.jar"]
    later = [name("LIN", 5 + k, 3 * (k - 2) % 25 + 1, 5000 + k)] if k > 1 else []
    return spark.createDataFrame([(p,) for p in new + later], "path string")


def state(spark, root):
    return sorted(map(tuple, tracking.current_state(I.read_events(spark, root)).collect()), key=repr)


def whole(spark, lots):
    """(file, note) as one plan over all files gives them."""
    seen = lot(spark, 0)
    for k in range(1, lots):
        seen = seen.unionByName(lot(spark, k))
    nothing = spark.createDataFrame([], "sonde string, filename string, date_of_import timestamp, note string")
    events = importing.plan_events(importing.plan_import(seen, nothing, "RS41"), lots)
    return {(r["filename"], r["note"]) for r in tracking.current_state(events).collect()}


def test_state_over_many_batches_with_snapshots_and_replays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "SNAPSHOT_EVERY", 2)
    monkeypatch.setattr(I, "BUCKETS", 4)
    root = str(tmp_path / "plan")
    opened = []
    for k in range(5):
        I.plan_batch(lot(spark, k), k, root, "RS41")
        opened.append(len(I.folders(spark, root, I.EVENTS, k + 1)))
        if k in (2, 3):  # a replay, with and without a snapshot, replaces its own output
            before = state(spark, root)
            I.plan_batch(lot(spark, k), k, root, "RS41")
            assert state(spark, root) == before
    assert {(f, note) for _, f, _, note, _ in state(spark, root)} == whole(spark, 5)
    assert max(opened) <= 2 and opened[1] == opened[3] == 1
    assert I.read_files(spark, root).count() == sum(lot(spark, k).count() for k in range(5))


def test_files_opened_by_a_batch_do_not_grow_with_earlier_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "SNAPSHOT_EVERY", 2)
    monkeypatch.setattr(I, "BUCKETS", 8)
    root = str(tmp_path / "plan")
    opened = []
    for k in range(6):
        for table in (I.EVENTS, I.FILES):
            rows = I._read(spark, root, table, k, buckets=[3, 7])
            opened.append((k, len(rows.select(F.input_file_name()).where("input_file_name() <> ''").distinct().collect()) if k else 0))
        batch = spark.createDataFrame([(name("LIN", 1, d % 28 + 1, 1000 * k + d),) for d in range(40)], "path string")
        I.plan_batch(batch, k, root, "RS41")
    # two buckets of one snapshot and of one delta at most
    assert max(n for _, n in opened) <= 2 * 2 and max(n for k, n in opened if k > 3) <= max(n for k, n in opened if k <= 3)
    rows = I._read(spark, root, I.EVENTS, 6, buckets=[3, 7])
    assert "PartitionFilters: [bucket" in rows._jdf.queryExecution().executedPlan().toString()


def test_an_unfinished_snapshot_is_not_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "SNAPSHOT_EVERY", 2)
    root = tmp_path / "plan"
    monkeypatch.setattr(I, "BUCKETS", 2)
    for k in range(4):
        I.plan_batch(lot(spark, k), k, str(root), "RS41")
    before = state(spark, str(root))
    (root / I.EVENTS / "upto=3" / "_SUCCESS").unlink()
    assert [p.rsplit("/", 1)[1] for p in I.folders(spark, str(root), I.EVENTS)] == ["upto=1", "batch=2", "batch=3"]
    assert state(spark, str(root)) == before


def test_a_plan_becomes_events_in_one_pass(spark):
    """The plan is worked out once for its registrations and skips together."""
    nothing = spark.createDataFrame([], "sonde string, filename string, date_of_import timestamp, note string")
    plan = importing.plan_import(lot(spark, 2), nothing, "RS41")
    events = importing.plan_events(plan, 7)
    assert events._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    expected = {(r["filename"], "registered" if r["outcome"] == "import" else "skipped", 7, r["reason"]) for r in plan.collect()}
    assert {(r["filename"], r["kind"], r["seq"], r["text"]) for r in events.collect()} == expected


@pytest.mark.parametrize("cut", [2, 4, 6])
def test_standing_events_give_the_same_state(spark, cut):
    rows = [("RS41", f"f{i % 5}", kind, seq, None if kind != "imported" else f"2024-01-0{seq % 9 + 1}", f"t{seq}")
            for seq, (i, kind) in enumerate([(0, "registered"), (1, "imported"), (0, "failed"), (2, "skipped"), (1, "failed"), (3, "registered"), (0, "imported"),
                                             (2, "imported"), (1, "imported"), (2, "skipped"), (3, "registered"), (4, "failed")])]
    events = spark.createDataFrame(rows, "sonde string, filename string, kind string, seq long, at string, text string").withColumn("at", F.to_timestamp("at"))
    early, late = events.where(F.col("seq") < cut), events.where(F.col("seq") >= cut)
    expected = sorted(map(tuple, tracking.current_state(events).collect()), key=repr)
    reduced = tracking.standing_events(early).unionByName(late)
    assert sorted(map(tuple, tracking.current_state(reduced).collect()), key=repr) == expected
    twice = tracking.standing_events(reduced)
    assert sorted(map(tuple, tracking.current_state(twice).collect()), key=repr) == expected
    assert twice.groupBy("filename").count().where("count > 4").count() == 0
