import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ascentframe.operators import gates, survivorship, tracking
from ascentframe.plans import importing
from ascentframe.queries import files as Q
from ascentframe.sources import archives


def name(folder, group, rev, number, station="LIN", when="20240101T000000"):
    suffix = f"_rev{rev:03d}" if rev else ""
    return f"/a/{station}-{folder}/{station}-{folder}_2_RS41-GDP_001_{when}_1-000-{group:03d}_AI{number}{suffix}.jar"


def files(spark, paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_folder_beats_group_beats_revision(spark):
    a, b, c = name("RS-01", 3, 2, 1), name("RS-02", 1, 0, 2), name("RS-02", 1, 1, 3)
    got = {r["path"]: (r["outcome"], r["reason"])
           for r in survivorship.select_survivors(files(spark, [a, b, c, "/a/x.jar"])).collect()}
    assert got[c] == ("keep", None)
    # the text carries the priority number, as the reports always did
    assert got[a][1] == f"Superseded by file from higher priority folder (RS-01): {c.split('/')[-1]}"
    assert got[b][1] == f"Superseded by newer version: {c.split('/')[-1]} (group 1, rev 1 vs group 1, rev 0)"
    assert got["/a/x.jar"] == ("skip", "Filename does not match archive pattern")


def test_one_survivor_per_launch_with_a_hot_launch(spark, hot_groups):
    hot_groups(5)
    paths = [name("RS-01", i % 7, i % 5, i) for i in range(100)] + [name("RS-01", 1, 0, 500, "SYO")]
    out = survivorship.select_survivors(files(spark, paths)).where("outcome = 'keep'").collect()
    assert sorted((r["station"], r["group_no"], r["rev_no"]) for r in out) == [("LIN", 6, 4), ("SYO", 1, 0)]
    assert len(out) == 2


def members(spark, names):
    return spark.createDataFrame([("x.jar", n) for n in names], "archive string, member string")


def test_latest_revision_folder(spark):
    judged = survivorship.select_members(members(spark, ["rev001/a.nc", "rev003/a.nc", "rev003/readme"]))
    got = {r["member"]: (r["outcome"], r["reason"]) for r in judged.collect()}
    assert got["rev003/a.nc"] == ("keep", None)
    assert got["rev001/a.nc"] == ("skip", "Older revision (rev001) - using latest revision rev003")
    assert got["rev003/readme"][0] == "skip"


def test_root_members_without_revision(spark):
    judged = survivorship.select_members(members(spark, ["a.nc", "b.nc", "sub/c.nc"]))
    assert {r["member"] for r in judged.collect() if r["outcome"] == "keep"} == {"a.nc", "b.nc"}


def test_root_file_next_to_revisions_is_reported(spark):
    judged = survivorship.select_members(members(spark, ["a.nc", "rev002/a.nc"]))
    got = {r["member"]: r["reason"] for r in judged.collect()}
    assert got == {"a.nc": "No revision, archive has revisions", "rev002/a.nc": None}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_survivors_parse_every_name_once(spark):
    plan = _plan(survivorship.select_survivors(files(spark, [name("RS-01", 1, 0, 1)])))
    assert plan.count("regexp_replace(") == 1 and plan.count("Exchange") == 1 and "Join" not in plan


def test_a_launch_of_very_many_files_takes_the_aggregate_way(spark, hot_groups):
    paths = [name("RS-0%d" % (i % 2 + 1), i % 7, i % 5, i) for i in range(60)] + [name("RS-01", 1, 0, 500 + i, "SYO", "2024010%dT000000" % (i % 9 + 1)) for i in range(20)]
    rows = files(spark, [*paths, "/a/x.jar", "/b/x.jar"])
    usual = sorted(map(tuple, survivorship.select_survivors(rows).collect()), key=repr)
    hot_groups(10)
    assert sorted(map(tuple, survivorship.select_survivors(rows).collect()), key=repr) == usual


def test_outcome_of_archives_folds_states(spark):
    listed = spark.createDataFrame(
        [("a", "rev001/x.nc", 0), ("a", "rev003/x.nc", 1), ("a", "rev003/y.nc", 2), ("a", "rev001/z_rev003.nc", 3), ("a", "rev004x/q.nc", 4),
         ("b", "rev002/only.txt", 0), ("b", "rev001/x.nc", 1), ("c", "s.nc", 0), ("c", "t.nc", 1), ("c", "t.nc", 5), ("c", "u/v_rev009.nc", 2),
         ("d", "read.me", 0), ("e", None, None), ("f", "n_rev002.nc", 0), ("f", "n_rev001.nc", 1), ("f", "n.nc", 2)],
        "archive string, member string, ord int")
    tried = spark.createDataFrame(
        [("a", "rev003/x.nc", 1, True, None), ("a", "rev003/y.nc", 1, False, "bad y"), ("a", "rev003/y.nc", 2, True, None),
         ("a", "rev001/z_rev003.nc", 1, True, None), ("c", "s.nc", 1, False, "bad s"), ("c", "t.nc", 1, False, None), ("f", "n_rev002.nc", 3, True, None),
         ("f", "n_rev002.nc", 3, False, "late"), ("zz", "not listed.nc", 1, True, None)],
        "archive string, member string, attempt int, loaded boolean, reason string")
    broken = spark.createDataFrame([("g", "Corrupted"), ("c2", None)], "archive string, error string")
    got = {r["archive"]: (r["success"], r["note"]) for r in importing.process_archives(listed, tried, broken).collect()}
    assert got == {
        "a": (True, "Successfully processed 3 data files. from revision rev003. Skipped 1 files from older revisions."),
        "b": (False, "No valid data files to process after revision filtering in b"),
        "c": (False, "bad s"), "d": (False, "No data files found in d"),
        "f": (False, "late. Skipped 1 files from older revisions"), "g": (False, "Corrupted"),
    }
    plain = tried.where("attempt = 1 AND loaded").select("archive", "member", "reason")
    assert {r["archive"]: r["success"] for r in importing.process_archives(listed, plain).collect()}["a"] is False


def test_outcome_plan_has_two_scans_and_three_exchanges(spark):
    from ascentframe.queries import QUERIES

    plan = _plan(QUERIES["archive_outcomes"](spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan") <= 2 and plan.count("Exchange hashpartitioning") <= 3 and "Join" not in plan


def test_outcomes_become_events_in_one_pass(spark):
    from ascentframe.queries import QUERIES

    outcomes = spark.createDataFrame([("x/a", True, "good"), ("x/b", False, "bad"), ("x/c", None, None)], "archive string, success boolean, note string")
    rows = importing.archive_events(outcomes, "RS41", 7).collect()
    assert sorted((r["filename"], r["kind"], r["seq"], r["at"] is None, r["text"]) for r in rows) == [
        ("a", tracking.IMPORTED, 7, False, "good"), ("b", tracking.FAILED, 7, True, "bad")]
    assert _plan(QUERIES["archive_import_state"](spark, "/root/testdata/sf0.001")).count("FileScan") <= 2


def test_archives_are_handed_on_in_small_batches(monkeypatch):
    monkeypatch.setattr(Q, "ZIPPED", 3000)
    docs = pd.DataFrame({"doc_id": range(1, 60), "text": ["x" * 100] * 58 + [None]})
    out = list(Q._zipped(iter([docs[:40], docs[40:]])))
    assert len(out) > 5 and all(sum(map(len, x["content"][:-1])) < 3000 for x in out)
    assert [a for x in out for a in x["archive"]] == [f"doc{k}.jar" for k in range(1, 60)]
    assert [len(c) for x in out for c in x["content"]] == [len(Q._archive_of(k, t)) for k, t in zip(docs["doc_id"], docs["text"])]


def test_archives_on_disk(spark, tmp_path):
    folder = tmp_path / "LIN-RS-01" / "2024"
    folder.mkdir(parents=True)
    with zipfile.ZipFile(folder / "good.jar", "w") as z:
        z.writestr("rev001/a.nc", b"12345")
        z.writestr("rev002/a.nc", b"123")
    with zipfile.ZipFile(folder / "empty.jar", "w") as z:
        z.writestr("readme.txt", b"")
    (folder / "bad.jar").write_bytes(b"no zip")
    (folder / "other.txt").write_text("x")
    found = archives.discover(spark, str(tmp_path))
    assert found.count() == 3 and found.columns == ["path", "length", "modificationTime"]
    listed = archives.list_members(archives.read_archives(spark, str(tmp_path)))
    rows = listed.withColumn("archive", F.substring_index("archive", "/", -1)).cache()
    assert rows.where("error IS NOT NULL").select("archive").collect()[0]["archive"] == "bad.jar"
    good = rows.where("error IS NULL")
    judged = survivorship.select_members(good)
    assert [r["member"] for r in judged.where("outcome = 'keep'").collect()] == ["rev002/a.nc"]
    none = survivorship.archives_without_members(good, judged).collect()
    assert [(r["archive"], r["reason"]) for r in none] == [("empty.jar", "No data files found in empty.jar")]


def test_members_are_listed_from_the_tail(spark, tmp_path):
    folder = tmp_path / "LIN-RS-01" / "20 24"
    folder.mkdir(parents=True)
    for k in range(5):
        with zipfile.ZipFile(folder / f"big{k}.jar", "w") as z:
            z.writestr("rev001/a.nc", b"x" * 300_000)
            z.writestr("rev002/é.nc", b"123")
    with zipfile.ZipFile(folder / "empty.jar", "w"):
        pass
    with zipfile.ZipFile(folder / "commented.jar", "w") as z:
        z.writestr("a.nc", b"y" * 300_000)
        z.comment = b"c" * 500
    (folder / "bad.jar").write_bytes(b"PK no zip" * 50_000)
    (folder / "none.jar").write_bytes(b"")
    (folder / "other.txt").write_text("x")
    rows = archives.read_members(spark, str(tmp_path)).withColumn("archive", F.substring_index("archive", "/", -1)).collect()
    got = {(r["archive"], r["member"]): (r["ord"], r["size"]) for r in rows if r["member"]}
    assert got == {("commented.jar", "a.nc"): (0, 300_000)} | {
        (f"big{k}.jar", m): x for k in range(5) for m, x in (("rev001/a.nc", (0, 300_000)), ("rev002/é.nc", (1, 3)))}
    assert all(r["bytes_read"] < 400 for r in rows if r["archive"].startswith("big"))
    assert all(r["bytes_read"] < 70_000 for r in rows)
    assert sorted(r["archive"] for r in rows if r["error"]) == ["bad.jar", "none.jar"]
    assert [(r["member"], r["error"]) for r in rows if r["archive"] == "empty.jar"] == [(None, None)]
    spread = spark.read.format("archive_members").option("filesPerPartition", "2").load(str(tmp_path))
    assert spread.rdd.getNumPartitions() == 5 and spread.count() == len(rows)
    both = archives.list_members(archives.read_archives(spark, str(tmp_path))).where("member IS NOT NULL")
    assert {(r["archive"].split("/")[-1], r["member"]): (r["ord"], r["size"]) for r in both.collect()} == got


def test_missing_root_is_empty(spark, tmp_path):
    assert archives.discover(spark, str(tmp_path / "nowhere")).count() == 0
    assert archives.read_members(spark, str(tmp_path / "nowhere")).count() == 0


def state(spark, rows):
    return spark.createDataFrame(rows, "sonde string, filename string, date_of_import timestamp, note string")


def test_monitor(spark):
    rows = spark.sql("""SELECT * FROM VALUES ('RS41','a',CAST(NULL AS timestamp),CAST(NULL AS string)),
      ('RS41','b',timestamp'2024-01-01',NULL), ('RS41','c',NULL,'x') AS t(sonde,filename,date_of_import,note)""")
    assert tuple(tracking.monitor(rows).first()) == ("RS41", 1, 1, 1, 3)


def test_second_run_imports_nothing_and_changes_nothing(spark):
    found = files(spark, [name("RS-01", 1, 0, 1), name("RS-01", 2, 0, 2), name("RS-01", 1, 0, 3, "SYO"), "/a/x.jar"])
    events = tracking.event(state(spark, []), tracking.REGISTERED, F.lit(0))

    def run(events, seq):
        plan = importing.plan_import(found, tracking.current_state(events), "RS41")
        events = events.unionByName(importing.plan_events(plan, seq))
        chosen = plan.where("outcome = 'import'")
        done = tracking.event(chosen, tracking.IMPORTED, F.lit(seq + 1),
                              F.to_timestamp(F.lit("2024-05-05 00:00:00")), F.lit("loaded"))
        return chosen.count(), events.unionByName(done)

    first, events = run(events, 1)
    before = {tuple(r) for r in tracking.current_state(events).collect()}
    second, events = run(events, 3)
    after = {tuple(r) for r in tracking.current_state(events).collect()}
    assert (first, second) == (2, 0)
    assert before == after and len(after) == 4
    assert sum(1 for r in after if r[2] is not None) == 2


def test_failure_after_import_clears_the_date(spark):
    base = spark.createDataFrame([("RS41", "f")], "sonde string, filename string")
    at = F.to_timestamp(F.lit("2024-01-01"))
    events = tracking.event(base, tracking.IMPORTED, F.lit(1), at).unionByName(
        tracking.event(base, tracking.FAILED, F.lit(2), text=F.lit("n" * 300)))
    row = tracking.current_state(events).first()
    assert row["date_of_import"] is None and len(row["note"]) == 255


def test_first_reason_wins_and_nothing_is_lost(spark):
    rows = [
        (1, {"Conventions": "CF-1.7", "g.Product.ID": "1", "g.Site.Key": "LIN", "g.Measurement.StandardTime": "2024-01-01T00:00:00"}),
        (2, {"Conventions": "CF-9", "g.Product.ID": "2"}),
        (3, {"Conventions": "CF-1.4", "g.Product.ID": "3", "g.General.SiteCode": "XXX", "g.Ascent.StandardTime": "bad"}),
        (4, {"Conventions": "RS-11G", "g.Product.ID": "4", "g.General.SiteCode": "LIN", "g.Ascent.StandardTime": "bad"}),
        (5, {"Conventions": "CF-1.4", "g.Product.ID": "5"}),
        (6, {"Conventions": "CF-1.7", "g.Site.Key": "LIN", "g.Measurement.StandardTime": "2024-01-01"}),
        (7, {"g.Product.ID": "7"}),
        (8, {"Conventions": "CF-1.7"}),
    ]
    attrs = spark.createDataFrame(rows, "g_product_id long, attrs map<string,string>")
    counts = spark.createDataFrame([(i, 5, 5) for i in range(1, 8)], "g_product_id long, n_levels long, n_times long")
    dim = spark.createDataFrame([(9, "LIN", "NET"), (8, "XXX", "OTHER")], "id int, idstation string, network string")
    judged = gates.judge_soundings(attrs, counts, dim, "NET", "RS41").cache()
    got = {r["g_product_id"]: r["reason"] for r in judged.collect()}
    assert got == {
        1: None,
        2: "Unsupported file conventions: CF-9",
        3: "Station 'XXX' not found in NET station database",
        4: "Invalid timestamp format for RS41: 'bad'",
        5: "Missing station identifier (g.General.SiteCode) in metadata",
        6: "Error converting: missing attribute g.Product.ID",
        7: "Error converting: missing attribute Conventions",
        8: "No measurement data provided",
    }
    assert gates.accepted(judged).count() + gates.rejected(judged).count() == 8
    assert judged.where("reason IS NULL").first()["idstation_pk"] == 9


def test_trees_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """The driver held every file of a tree, for Spark's index and for the member source; the rows are the same."""
    root = tmp_path / "a b%20"
    for k in range(60):
        folder = root / ["", "x", "x/y z", "x/y z/deep/er", "_kept=1", "_hidden", ".dot"][k % 7]
        folder.mkdir(parents=True, exist_ok=True)
        with zipfile.ZipFile(folder / f"é{k}.jar", "w") as z:
            z.writestr("a.nc", b"x" * k)
        (folder / f"{k}.txt").write_text("x")
        (folder / f"_{k}.jar").write_bytes(b"no zip")
    (root / "x" / "gone.jar").symlink_to(root / "nothing")
    columns = ["path", "length", "modificationTime"]
    for pattern in ("*.jar", "é{1,3}*.jar", "é[0-3]?.j*"):
        spark_s = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(str(root))
        was = sorted(map(tuple, spark_s.select(*columns).collect()))
        with monkeypatch.context() as m:
            m.setattr(type(spark), "read", property(lambda _: pytest.fail("the driver lists")))
            found = archives.discover(spark, str(root), pattern)
        assert found.columns == columns and sorted(map(tuple, found.collect())) == was and was
        assert found.schema == spark_s.select(*columns).schema
    monkeypatch.setattr(archives, "LISTED", 3)
    one = str(root / "x" / "é1.jar")
    assert [r["path"] for r in archives.discover(spark, one).collect()] == [f"file:{one}"]
    plain = tmp_path / "plain"
    root.rename(plain)
    rows = archives.read_members(spark, f"file://{plain}").collect()
    assert sorted(map(str, rows)) == sorted(map(str, spark.read.format("archive_members").load(str(plain)).collect()))
    assert sum(r["error"] is None for r in rows) == 60 and sum(r["error"] is not None for r in rows) == 60
