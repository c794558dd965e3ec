"""Batches that replace themselves whole, in all tables of a store."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ascentframe.plans import exporting, importing
from ascentframe.sinks import snapshots, writers


@pytest.fixture(autouse=True)
def few_diagnostics(monkeypatch):
    """What is derived from a sounding does not matter here; the queries over loaded stores derive all of it."""
    monkeypatch.setattr(importing.diagnostics, "diagnosed_levels", lambda levels: levels)
    monkeypatch.setattr(importing.diagnostics, "sounding_scalars", lambda levels: levels.groupBy("g_product_id").agg(F.max("temp").alias("diag_warmest")))


def sources(spark, launches, levels=12):
    """Levels and attributes of soundings {id: (station, time)}."""
    rows = [(sid, k, 1000.0 * math.exp(-k / 25), 100.0 + 320 * k, 285.0 - 2 * k, 50.0, 5.0, 1.0) for sid in launches for k in range(levels)]
    attrs = [(sid, {"Conventions": "CF-1.7", "g.Product.ID": str(sid), "g.Site.Key": s, "g.Measurement.StandardTime": t}) for sid, (s, t) in launches.items()]
    return (
        spark.createDataFrame(rows, "g_product_id long, level_idx int, press double, alt double, temp double, rh double, u double, v double"),
        spark.createDataFrame(attrs, "g_product_id long, attrs map<string,string>"),
        spark.createDataFrame([(7, "LIN", "NET")], "id int, idstation string, network string"),
    )


def load(spark, root, launches, batch="a", **kw):
    return importing.load_soundings(*sources(spark, launches, **kw), "NET", root, sonde="RS41", batch=batch)


def held(spark, root):
    """What readers see: levels by sounding and month, headers with their time, rejected soundings."""
    levels = snapshots.read(spark, root, importing.LEVELS).groupBy("g_product_id", "year", "month").count().collect()
    headers = snapshots.read(spark, root, importing.HEADERS).select("g_product_id", F.date_format("report_timestamp", "yyyy-MM")).collect()
    rejects = snapshots.read(spark, root, importing.REJECTS).select("g_product_id").collect()
    return sorted(map(tuple, levels)), sorted(map(tuple, headers)), sorted(r[0] for r in rejects)


MARCH, APRIL = "2024-03-05 06:00:00", "2024-04-05 06:00:00"


def test_a_batch_that_is_loaded_again_leaves_only_its_new_rows(spark, tmp_path):
    root = str(tmp_path / "store")
    load(spark, root, {1: ("LIN", MARCH), 2: ("LIN", MARCH), 3: ("XXX", MARCH), 4: ("XXX", MARCH)})
    load(spark, root, {9: ("LIN", MARCH)}, batch="b/odd %")
    assert held(spark, root)[2] == [3, 4]
    # a moved month, fewer rejects, a sounding that is gone
    load(spark, root, {1: ("LIN", APRIL), 3: ("LIN", MARCH), 4: ("XXX", MARCH)})
    assert held(spark, root) == ([(1, 2024, 4, 12), (3, 2024, 3, 12), (9, 2024, 3, 12)], [(1, "2024-04"), (3, "2024-03"), (9, "2024-03")], [4])
    assert sorted(map(tuple, snapshots.months(spark, root, "levels").collect())) == [(2024, 3), (2024, 4)]
    # nothing accepted
    load(spark, root, {1: ("XXX", APRIL)})
    assert held(spark, root) == ([(9, 2024, 3, 12)], [(9, "2024-03")], [1])
    assert sorted(map(tuple, snapshots.months(spark, root, "levels").collect())) == [(2024, 3)]
    # nothing rejected either
    load(spark, root, {})
    assert held(spark, root) == ([(9, 2024, 3, 12)], [(9, "2024-03")], [])


def test_a_broken_run_shows_the_old_batch_or_the_new_one(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    load(spark, root, {9: ("LIN", MARCH)}, batch="other")
    load(spark, root, {1: ("LIN", MARCH), 2: ("XXX", MARCH)})
    before, after = held(spark, root), {1: ("XXX", MARCH), 2: ("LIN", APRIL)}
    write, rename = writers.write_run, snapshots.publish
    for kill_at in (1, 2, 3):  # before the second and third table, and before the list is renamed
        done = []

        def dying(*args, **kw):
            if len(done) == kill_at:
                raise KeyboardInterrupt
            done.append(1)
            return write(*args, **kw)

        monkeypatch.setattr(writers, "write_run", dying)
        if kill_at == 3:
            monkeypatch.setattr(snapshots, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            load(spark, root, after)
        assert held(spark, root) == before
    monkeypatch.setattr(writers, "write_run", write)
    monkeypatch.setattr(snapshots, "publish", rename)
    load(spark, root, after)
    assert held(spark, root) == ([(2, 2024, 4, 12), (9, 2024, 3, 12)], [(2, "2024-04"), (9, "2024-03")], [1])
    assert snapshots.clear(spark, root) == 4  # three broken runs, and the one that was replaced
    assert held(spark, root) == ([(2, 2024, 4, 12), (9, 2024, 3, 12)], [(2, "2024-04"), (9, "2024-03")], [1])


def test_observation_ids_stay_when_the_same_batch_comes_again(spark, tmp_path):
    root = str(tmp_path / "store")
    ids = lambda: {r[0]: (r[1], r[2]) for r in snapshots.read(spark, root, "levels").groupBy("g_product_id").agg(F.min("observation_id"), F.max("observation_id")).collect()}
    load(spark, root, {1: ("LIN", MARCH)}, batch="a")
    load(spark, root, {2: ("LIN", MARCH)}, batch="b")
    assert ids() == {1: (1, 12), 2: (13, 24)}
    load(spark, root, {1: ("LIN", APRIL)}, batch="a")
    assert ids() == {1: (1, 12), 2: (13, 24)}
    load(spark, root, {1: ("LIN", APRIL)}, batch="a", levels=15)  # needs other ids, behind those of the others
    assert ids() == {1: (25, 39), 2: (13, 24)}


def test_export_sees_only_what_counts(spark, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "long")
    load(spark, root, {1: ("LIN", MARCH), 2: ("LIN", MARCH)})
    load(spark, root, {1: ("LIN", APRIL)})
    stations = sources(spark, {})[2]
    assert [tuple(r) for r in exporting.export_store(spark, root, stations, out).collect()] == [(2024, 4)]
    assert spark.read.parquet(out).count() == 15 * 12
    plan = snapshots.read(spark, root, "levels").where("year = 2024 AND month = 4").select("temp")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<temp:double>" in plan


def test_lists(spark, tmp_path):
    root = str(tmp_path / "store")
    assert snapshots.current(spark, root) == snapshots.Snapshot()
    with pytest.raises(ValueError):
        snapshots.read(spark, root, "levels")
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1))], "g_product_id long, report_timestamp timestamp")
    for batch, run in (("a", "1"), ("b", "2"), ("a", "3")):
        schema = writers.write_run(rows, snapshots.folder(root, "t", batch, run), monthly=True)
        snapshots.publish(spark, root, batch, run, {"t": schema})
    assert snapshots.current(spark, root).runs == {"a": "3", "b": "2"}
    assert sorted(r["run"] for r in snapshots.read(spark, root, "t").collect()) == ["2", "3"]
    assert snapshots.read(spark, root, "t", batch="b").count() == 1 and snapshots.read(spark, root, "t", batch="zz").count() == 0
    # a draft that a killed publisher left is no list
    (tmp_path / "store" / snapshots.LISTS / "_draft-9").write_text("{")
    assert snapshots.current(spark, root).number == 3
    assert snapshots.clear(spark, root) == 1 and snapshots.current(spark, root).number == 3
