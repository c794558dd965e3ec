"""Long table, catalogue, reconciliation, stations, sinks."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe import contracts as C
from ascentframe.operators import catalog, cdm, reconcile, schema, stations
from ascentframe.plans import exporting, verifying
from ascentframe.session import DROP_SHUFFLES
from ascentframe.sinks import snapshots, writers
from ascentframe.sources import html, tables


@pytest.fixture(scope="module")
def store(spark):
    levels = spark.createDataFrame(
        [(1, 10, datetime(2020, 12, 31, 23), 280.0, 1000.0, 5.0, None, None),
         (1, 11, datetime(2020, 12, 31, 23), None, 900.0, 9.0, None, 3.0),
         (2, 12, datetime(2021, 1, 1), 270.0, None, 1.0, 2.0, 4.0),
         (9, 13, datetime(2021, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0)],
        "g_product_id long, observation_id long, report_timestamp timestamp, temp double, press double, alt double, u double, wzon double",
    )
    headers = spark.createDataFrame(
        [(1, datetime(2020, 12, 31, 23), None, "LIN", "Lindenberg", None, 52.2), (2, datetime(2021, 1, 1), "SYO", None, None, "K", -69.0)],
        "g_product_id long, report_timestamp timestamp, g_general_sitecode string, g_site_key string, g_site_name string, "
        "g_product_code string, g_measurementsystem_latitude double",
    )
    dim = spark.createDataFrame([(7, "LIN")], "id int, idstation string")
    return levels, headers, dim


def test_dictionary_is_complete():
    assert len(C.VARIABLES) == 15 and len({v.code for v in C.VARIABLES}) == 15
    assert len(C.export_level_columns()) == 54 and len(C.export_header_columns()) == 13


def test_long_table_has_every_variable_of_every_level(spark, store):
    long = exporting.build_long_table(*store)
    assert long.schema == C.CDM_SCHEMA or [f.name for f in long.schema] == [f.name for f in C.CDM_SCHEMA]
    rows = {(r["observation_id"], r["observed_variable"]): r for r in long.collect()}
    assert len(rows) == 3 * 15
    assert rows[10, 142]["observation_value"] == 100000.0
    assert rows[11, 126]["observation_value"] is None
    assert rows[11, 104]["observation_value"] == 3.0 and rows[12, 104]["observation_value"] == 2.0
    assert rows[10, 126]["primary_station_id"] == "LIN" and rows[10, 126]["record_number"] == 7
    assert rows[12, 126]["record_number"] is None and rows[12, 126]["sensor_id"] == "K"
    assert rows[10, 126]["station_name|station_configuration"] == "Lindenberg"
    assert rows[12, 126]["station_name|station_configuration"] == ""
    raw = exporting.build_long_table(*store, transform_units=False)
    assert raw.where("observed_variable = 142 AND observation_id = 10").first()["observation_value"] == 1000.0


def test_export_is_incremental_and_safe_to_repeat(spark, store, tmp_path):
    path = str(tmp_path / "long")
    first = exporting.export_months(*store, path, end_year=2020)
    assert [(r["year"], r["month"]) for r in first.collect()] == [(2020, 12)]
    second = exporting.export_months(*store, path)
    assert [(r["year"], r["month"]) for r in second.collect()] == [(2021, 1)]
    assert exporting.export_months(*store, path).count() == 0
    back = spark.read.parquet(path)
    assert back.count() == 45
    assert dict(back.dtypes)["observation_value"] == "float"
    assert back.where("observation_id = 12").select("record_number").distinct().first()[0] == C.INT32_MISSING
    writers.write_variable_dim(spark, str(tmp_path / "dim"))
    assert spark.read.parquet(str(tmp_path / "dim")).count() == 15


def test_levels_scan_is_pruned(spark, store, tmp_path):
    path = str(tmp_path / "levels")
    writers.append_levels(store[0], path)
    df = tables.read_levels(spark, path, ["temp"], year=2021, month=1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<temp:double>" in plan
    assert df.count() == 2
    ranged = tables.read_headers(spark, path, ["g_product_id"], datetime(2020, 1, 1), datetime(2021, 1, 1))
    assert "PushedFilters: [IsNotNull(report_timestamp)" in ranged._jdf.queryExecution().executedPlan().toString()
    assert ranged.count() == 2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_export_reads_only_its_months_and_deals_out_before_the_explode(spark, store, tmp_path):
    levels, headers, dim = store
    writers.append_levels(levels, str(tmp_path / "levels"))
    stored = spark.read.parquet(str(tmp_path / "levels"))
    long = exporting.build_long_table(exporting.in_months(stored, [(2021, 1)]), exporting.in_months(headers, [(2021, 1)]), dim,
                                      arrange=writers.levels_in_time)
    plan = _plan(long)
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "month" in plan.split("PartitionFilters: [")[1][:80]
    assert plan.index("Generate") < plan.index("Exchange") and "Exchange" not in plan[: plan.index("Generate")]
    assert "Sort" not in plan[: plan.index("Generate")] and plan.index("Sort") < plan.index("rangepartitioning")
    assert {r["report_id"] for r in long.collect()} == {2}
    assert exporting.month_runs([(2020, 12), (2021, 1), (2021, 3)]) == [
        ("2020-12-01 00:00:00", "2021-02-01 00:00:00"), ("2021-03-01 00:00:00", "2021-04-01 00:00:00")]


def test_export_of_a_store_writes_the_dictionary(spark, store, tmp_path):
    levels, headers, dim = store
    root, out = str(tmp_path / "store"), str(tmp_path / "long")
    schemas = {
        name: writers.write_run(rows, snapshots.folder(root, name, "a", "1"), monthly=name == "levels")
        for name, rows in (("levels", levels), ("headers", headers))
    }
    snapshots.publish(spark, root, "a", "1", schemas)
    done = exporting.export_store(spark, root, dim, out)
    assert sorted(map(tuple, done.collect())) == [(2020, 12), (2021, 1)]
    assert exporting.export_store(spark, root, dim, out).count() == 0
    assert spark.read.parquet(f"{out}/{writers.DICTIONARY}").count() == len(C.VARIABLES)
    assert spark.read.parquet(out).count() == 3 * 15


def test_tab_text_and_truncate(spark, tmp_path):
    path = str(tmp_path / "text")
    df = spark.createDataFrame([(1, 54.0, "ALC", None, None, "Alice Springs", "NET", None)], C.STATION_SCHEMA)
    writers.write_tab_text(df, path)
    assert "\\N" in spark.read.text(path).first()[0]
    assert tables.read_stations(spark, path).collect() == df.collect()
    table = str(tmp_path / "table")
    df.write.parquet(table)
    writers.truncate(spark, table, C.STATION_SCHEMA)
    assert spark.read.parquet(table).count() == 0
    writers.quarantine(df, str(tmp_path / "bad"))
    writers.quarantine(df, str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_dump_header_only(spark, store, tmp_path):
    levels, headers, _ = store
    writers.dump_csv(levels, headers, str(tmp_path / "a"), 2020, 2020, header_only=True, compress=False)
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["header"]
    writers.dump_csv(levels, headers, str(tmp_path / "b"), 2020, 2020)
    assert spark.read.csv(str(tmp_path / "b" / "data"), header=True).count() == 2
    assert list((tmp_path / "b" / "data" / "year=2020").glob("*.csv.bz2"))
    summary = {r["outcome"]: r["tables"] for r in writers.dump_summary(levels, str(tmp_path / "b"), 2018, 2021).collect()}
    assert summary == {"exported": 1, "error": 1, "skipped": 2}
    nothing = writers.dump_summary(levels, str(tmp_path / "a"), 2018, 2021).collect()
    assert {r["outcome"]: r["tables"] for r in nothing} == {"error": 2, "skipped": 2}


def test_change_points(spark):
    ts = [1, 1, 2, 2, 2, 1]
    df = spark.createDataFrame([("f", i, t, "LIN\x00", i % 2) for i, t in enumerate(ts)],
                               "file string, pos int, ts long, station string, code int")
    blocks = catalog.marked_blocks(df, ["file"], [F.asc("pos")], ["ts"])
    rows = catalog.launches(blocks, ["file"], "station", "ts", "code").orderBy("block_id").collect()
    assert [(r["start_idx"], r["end_idx"]) for r in rows] == [(0, 2), (2, 5), (5, 6)]
    assert rows[0]["station_name"] == "LIN" and rows[0]["launch_date"] == "1970-01-01 00:00:01"
    assert rows[0]["codes"] == [0, 1] and rows[2]["codes"] == [1]


def test_adjacent_stations_with_one_time_are_two_launches(spark):
    df = spark.createDataFrame([("f", 0, 5, "A"), ("f", 1, 5, "B")], "file string, pos int, ts long, s string")

    def blocks(run_of):
        marked = catalog.marked_blocks(df, ["file"], [F.asc("pos")], run_of)
        return marked.select("block_id").distinct().count()

    assert blocks(["s", "ts"]) == 2 and blocks(["ts"]) == 1


def test_profile_filters_reach_the_scan(spark, store, tmp_path):
    path = str(tmp_path / "long")
    exporting.export_months(*store, path)
    df = catalog.profile(spark.read.parquet(path), "Lindenberg", 1609455600, 126)
    assert [r["z_coordinate"] for r in df.collect()] == [5.0, 9.0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert pushed.startswith("IsNotNull(") and "DataFilters: [isnotnull(" in plan


@pytest.mark.parametrize("actual, status, lax", [(10.005, "OK", "OK"), (10.02, "ERR", "ERR"), (float("nan"), "ERR", None), (None, "ERR", None)])
def test_profile_tolerance(spark, actual, status, lax):
    exp = spark.createDataFrame([(1, 1, 10.0)], "k int, pos int, t double")
    act = spark.createDataFrame([(1, 1, actual)], "k int, pos int, t double")
    rows = reconcile.compare_profiles(exp, act, ["k", "pos"], ["t"], "k").collect()
    assert [r["status"] for r in rows] == [status]
    if lax == "ERR":
        assert rows[0]["max_diff"] == pytest.approx(0.02)
    rows = reconcile.compare_profiles(exp, act, ["k", "pos"], ["t"], "k", both_sides_only=True).collect()
    assert [r["status"] for r in rows] == ([lax] if lax else [])
    assert reconcile.compare_profiles(act.withColumn("t", F.lit(float("nan"))), act.withColumn("t", F.lit(None).cast("double")), ["k", "pos"], ["t"], "k").count() == 0


def _levels(spark, rows):
    return spark.createDataFrame(rows, "k long, id long, t double, p double")


@pytest.mark.parametrize("limit", [None, 3])
def test_digests_leave_the_comparison_as_it_is(spark, hot_groups, limit):
    if limit:
        hot_groups(limit)
    base = [(k, 100 * k + i, float(i), None if i == 2 else -0.0) for k in range(1, 13) for i in range(5)]
    change = {
        2: lambda r: (*r[:2], r[2] + 0.005, r[3]), 3: lambda r: (*r[:2], None, r[3]), 4: lambda r: None,
        5: lambda r: r if r[1] % 100 != 2 else None, 6: lambda r: (r[0], 507 + 100 * 5 - r[1], r[2], r[3]),  # reversed
        7: lambda r: (r[0], r[1] + 77, r[2], r[3]), 8: lambda r: (r[0], 3 * r[1], r[2], r[3]), 9: lambda r: (*r[:3], 0.0 if r[3] == 0 else float("nan")),
        10: lambda r: (*r[:2], 9.0, r[3]) if r[1] % 100 == 4 else r,
    }
    stored = [x for r in base if (x := change.get(r[0], lambda r: r)(r))] + [(99, 1, 1.0, 1.0), (None, 1, 1.0, 1.0)]
    e, a = _levels(spark, base + [(None, 1, 1.0, 2.0)]), _levels(spark, stored)
    plain = reconcile.compare_profiles(reconcile.positioned(e, "k", "id"), reconcile.positioned(a, "k", "id"), ["k", "pos"], ["t", "p"], "k")
    columns = sorted(plain.columns)
    fast = reconcile.compare_levels(e, a, "k", "id", ["t", "p"])
    rows = lambda df: sorted((tuple(r) for r in df.select(columns).collect()), key=repr)
    assert rows(fast) == rows(plain)
    apart = {1: False, 2: True, 3: True, 4: True, 5: True, 6: True, 7: False, 8: True, 9: False, 10: True, 11: False, 12: False}
    mine, theirs = (reconcile.digested(x, "k", "id", ["t", "p"]).where("k < 13") for x in (e, a))
    met = mine.join(theirs.select("k", F.col("digest").alias("other")), "k", "left").select("k", ~F.coalesce(F.col("digest") == F.col("other"), F.lit(False)))
    assert dict(map(tuple, met.collect())) == apart


def test_equal_tables_exchange_one_row_a_sounding(spark):
    rows = spark.range(4000).selectExpr("id % 10 AS k", "id", "CAST(id * 0.5 AS DOUBLE) AS t", "1D AS p").repartition(2)
    out = reconcile.compare_levels(rows, rows, "k", "id", ["t", "p"])
    assert "Window" not in _plan(out) and out.count() == 20 and out.where("status <> 'OK' OR compared <> 400").count() == 0


def test_levels_that_differ_are_shuffled_once(spark):
    rows = spark.range(4000).selectExpr("id % 10 AS k", "id", "CAST(id * 0.5 AS DOUBLE) AS t")
    out = reconcile.compare_levels(rows, rows.withColumn("t", F.col("t") + 1), "k", "id", ["t"])
    assert _plan(out).count("Exchange hashpartitioning") == 1 and out.where("off = 400").count() == 10


@pytest.mark.parametrize("digests", [True, False])
@pytest.mark.parametrize("paired", [True, False])
def test_levels_of_very_many_soundings_are_exchanged_once(spark, monkeypatch, digests, paired):
    """No look-up of those that differ, which exchanged all levels before; the same rows as by digests."""
    rows = spark.range(4000).selectExpr("id % 1000 AS k", "id", "CAST(id * 0.5 AS DOUBLE) AS t")
    other = rows.where("k % 7 > 0 AND id % 1000 < 990").withColumn("t", F.when(F.col("k") % 3 > 0, F.col("t") + 1).otherwise(F.col("t")))
    pairs = None
    if paired:
        other, pairs = other.withColumn("k", F.col("k") + 5000), spark.range(1000).selectExpr("id AS k", "id + 5000 AS _stored")
    got = lambda: reconcile.compare_levels(rows, other, "k", "id", ["t"], pairs=pairs)
    want = sorted(map(tuple, got().collect()))
    monkeypatch.setattr(reconcile, "BROADCAST_BYTES", 1000)
    monkeypatch.setattr(reconcile, "DIGEST_LEVELS", 1 if digests else 16)
    out = got()
    plan = _plan(out)
    assert sorted(map(tuple, out.collect())) == want
    assert "LeftSemi" not in plan and plan.count("REPARTITION_BY_COL") == 1


@pytest.mark.parametrize(
    "name, expected, actual, match",
    [("a", "12.5 hPa", "12.50001 hPa", True), ("a", "12.5", "12.50001", True), ("a", "12.5 hPa", "12.50001", False), ("a", "12.5", "12.6", False),
     ("a", "x ", " x", True), ("a", "x", "y", False), ("a", "5", "5 km", False),
     ("starttime", "2024-01-01 00:00:00", "2024-01-01 00:00:00.5", True),
     ("starttime", "2024-01-01 00:00:00", "2024-01-01 00:00:02", False), ("a", None, None, True), ("a", "1", None, False)],
)
def test_header_ladder(spark, name, expected, actual, match):
    df = spark.createDataFrame([(name, expected, actual)], "n string, e string, a string")
    assert df.select(reconcile.header_match(F.col("n"), F.col("e"), F.col("a"), F.lit(True)).alias("m")).first()["m"] is match


def test_header_texts_that_only_share_digits_differ(spark):
    pairs = [("N3 x", "S3"), ("RS41", "IMS41"), ("12 m", "12 km"), ("12 m", "12"), ("1e2", "100 K"), ("007", "7"), ("1.10", "1.1"), ("7", " 7 ")]
    df = spark.createDataFrame(pairs, "e string, a string")
    rows = df.select(reconcile.header_match(F.lit("serial"), F.col("e"), F.col("a")).alias("m")).collect()
    assert [r.m for r in rows] == [False] * 7 + [True]
    rows = df.select(reconcile.header_match(F.lit("height"), F.col("e"), F.col("a"), F.lit(True)).alias("m")).collect()
    assert [r.m for r in rows] == [False] * 5 + [True] * 3


def test_numeric_header_columns_are_known_by_their_type(spark):
    e = spark.createDataFrame([(1, "1.10", "7")], "k int, version string, height string")
    a = spark.createDataFrame([(1, "1.1", 7.0)], "k int, version string, height double")
    got = {r["column_name"]: r["status"] for r in reconcile.compare_headers(e, a, "k", ["version", "height"]).collect()}
    assert got == {"version": "ERR", "height": "OK"}
    got = {r["column_name"]: r["status"] for r in reconcile.compare_headers(e, a, "k", ["version", "height"], ["version"]).collect()}
    assert got == {"version": "OK", "height": "ERR"}


def test_verify_reports_missing_and_differing(spark):
    """Stored numbers differ from the source's; soundings are found by station and time."""
    lv = spark.createDataFrame([(s, i, float(i)) for s in range(1, 9) for i in range(5)],
                               "g_product_id long, observation_id long, t double")
    keep = ("g_product_id <> 3 AND NOT (g_product_id = 4 AND observation_id > 1) AND NOT (g_product_id = 5 AND observation_id = 2) "
            "AND g_product_id <> 6")
    stored = lv.where(keep).withColumn("t", F.expr("IF(g_product_id = 2 AND observation_id = 1, 5D, t)"))
    extra = spark.createDataFrame([(7, 9, 9.0)], lv.schema)
    heads = spark.createDataFrame([(k, f"s{k}", k, "x") for k in range(1, 10)],
                                  "g_product_id long, station string, report_timestamp int, site string")
    others = heads.where("g_product_id NOT IN (3, 8)").unionByName(
        heads.where("g_product_id = 8").withColumn("station", F.lit("unknown")))

    def renamed(df):
        return df.withColumn("g_product_id", 100 - F.col("g_product_id"))

    out = verifying.verify(lv, renamed(stored.unionByName(extra)), heads, renamed(others), ["t"], ["site"])
    got = {r["g_product_id"]: (r["found"], r["passed"]) for r in out.collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (False, False), 4: (True, False), 5: (True, False), 6: (True, False),
                   7: (True, False), 8: (False, False), 9: (True, False)}
    assert tuple(reconcile.global_verdict(out).first()) == (9, 1, False)


def test_upsert_gives_ids_in_code_order(spark):
    cols = "id int, idstation string, name string, latitude double, longitude double, elevation double, wmoid int, network string"
    now = spark.createDataFrame([(1, "ALC", "old", 1.0, 1.0, 1.0, 1, "X"), (5, "BAR", "keep", 2.0, 2.0, 2.0, 2, "X")], cols)
    new = spark.createDataFrame([("NYA", "n", 3.0, None, None, None), ("ALC", "new", 9.0, None, None, None), ("CAB", "c", 4.0, None, None, None)],
                                "idstation string, name string, latitude double, longitude double, elevation double, wmoid int")
    got = {r["idstation"]: (r["id"], r["name"], r["longitude"], r["network"])
           for r in stations.upsert_stations(now, new, "NET").collect()}
    assert got == {"ALC": (1, "new", None, "NET"), "BAR": (5, "keep", 2.0, "X"), "CAB": (6, "c", None, "NET"), "NYA": (7, "n", None, "NET")}


def test_site_table(spark):
    page = ("<table><tr><th>Code</th></tr><tr><td>LAU</td><td>Lauder, NZ</td><td>-45.05°</td><td>169.68°</td>"
            "<td>98 m / 112 m</td><td>0-20000-0-10393</td></tr><tr><td></td><td>a</td><td>1</td><td>1</td><td>1</td><td>1</td></tr>"
            "<tr><td>few</td></tr></table>")
    rows = html.table_rows(spark.createDataFrame([(1, page)], "id int, html string"), "html", ["id"])
    got = stations.stations_from_cells(rows).collect()
    assert [tuple(r) for r in got] == [("LAU", "Lauder", -45.05, 169.68, 112.0, None)]


def test_pages_are_dealt_out_and_taken_apart_once(spark, monkeypatch):
    from ascentframe.queries import QUERIES

    monkeypatch.setattr(html, "PART_PAGES", 10)
    pages = spark.range(95).selectExpr("id", "concat('<table><tr><th>x</th></tr><tr><td>', id, '</td></tr></table>') AS page").coalesce(1)
    rows = html.table_rows(pages, "page", ["id"])
    assert rows.rdd.getNumPartitions() == 10 and {(r["id"], r["cells"][0]) for r in rows.collect()} == {(k, str(k)) for k in range(95)}
    plan = QUERIES["station_refresh"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_mandatory_and_required(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    got = {r["column_name"]: r["missing"] for r in schema.mandatory_violations(df, ("a", "b")).collect()}
    assert got == {"a": 1, "b": 2}
    contract = schema.contract_of(df.withColumn("report_id", F.lit(1)))
    assert contract == T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])


def test_a_launch_is_read_by_its_slice(spark, tmp_path):
    levels = spark.range(6000).select(
        (F.col("id") % 30).alias("g_product_id"), ((F.col("id") % 30) * 1000 + F.floor(F.col("id") / 30)).alias("observation_id"),
        F.expr("timestamp'2020-12-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 30 AS INT))").alias("report_timestamp"),
        (F.col("id") * 1.0).alias("temp"), (6000.0 - F.col("id")).alias("alt"))
    headers = spark.range(30).select(F.col("id").alias("g_product_id"), F.concat(F.lit("S"), F.col("id") % 3).alias("g_site_name"))
    path = str(tmp_path / "long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        exporting.export_months(levels, headers, spark.createDataFrame([], "id int, idstation string"), path, months_of=levels)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    catalog.write_launch_index(spark, path)
    index = catalog.launch_index(spark, path)
    assert index.where("rows <> end_idx - start_idx").count() == 0  # no row of another launch between
    assert index.groupBy("epoch", "code").agg(F.sum("rows").alias("n")).where("n = 200").count() == 30 * 15
    seven = int(datetime(2020, 12, 8, tzinfo=timezone.utc).timestamp())
    out = catalog.launch_slice(spark, path, "S1", seven, 126)
    assert len(spark.read.parquet(path).inputFiles()) >= 8 and len(out.inputFiles()) <= 2
    rows = out.collect()
    assert [r["z_coordinate"] for r in rows] == sorted(5993.0 - 30 * k for k in range(200))
    assert rows[0]["observation_value"] == 5977.0
    plan = _plan(out)
    assert "row_index" in plan and "PushedFilters: [IsNotNull(" in plan
    assert catalog.launch_slice(spark, path, "S2", seven, 126).count() == 0 and catalog.launch_slice(spark, path, "S1", seven, 9).count() == 0


@pytest.mark.parametrize("limit, timed", [("24", False), ("1", False), ("24", True)])
def test_rows_of_a_month_are_in_order_over_its_files(spark, store, tmp_path, monkeypatch, limit, timed):
    """Also where a task has more files than it may keep open, which makes Spark sort the rest."""
    monkeypatch.setattr(writers, "WRITERS", int(limit))
    levels, headers, dim = store
    many = spark.range(3000).select(
        (F.col("id") % 2 + 1).alias("g_product_id"), ((F.col("id") * 7919) % 3000).alias("observation_id"),
        F.expr("timestamp'2020-12-31 00:00:00' + make_interval(0, 0, 0, 0, CAST((id * 7919) % 3000 DIV 40 AS INT))").alias("report_timestamp"),
        (F.col("id") * 1.0).alias("temp"), F.lit(1.0).alias("alt")).repartition(5)
    path = str(tmp_path / "long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        exporting.export_months(many, headers, dim, path, months_of=many, levels_timed=timed)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = spark.read.parquet(path).select("year", "month", "observed_variable", "report_timestamp", "observation_id",
                                           "_metadata.file_name", "_metadata.row_index").collect()
    assert len(rows) == 15 * 3000 and len({(r.year, r.month) for r in rows}) == 2 and len({(r.month, r.file_name) for r in rows}) == 2 or not timed
    place = lambda r: (r.observed_variable, r.report_timestamp, r.observation_id)
    for month in (1, 12):
        own = sorted((r for r in rows if r.month == month), key=lambda r: (r.file_name, r.row_index))
        for name in {r.file_name for r in own}:
            inside = [place(r) for r in own if r.file_name == name]
            assert inside == sorted(inside)
        by_variable = sorted(own, key=lambda r: (r.observed_variable, r.file_name, r.row_index))
        assert [place(r) for r in by_variable] == sorted(map(place, own))
    assert spark.conf.get(writers.WRITERS_CONF) == "0"


@pytest.mark.parametrize("most, timed", [(700, True), (200, True), (200, False)])
def test_a_large_month_is_the_work_of_many_tasks(spark, store, tmp_path, monkeypatch, most, timed):
    """Whole days of up to PART_LEVELS levels in a part, sampled ranges where a day has more; before, a month was one task's."""
    monkeypatch.setattr(exporting, "PART_LEVELS", most)
    many = spark.range(3000).select(
        F.lit(1).alias("g_product_id"), ((F.col("id") * 7919) % 3000).alias("observation_id"),
        F.expr("timestamp'2020-12-01 00:00:00' + make_interval(0, 0, 0, CAST((id * 7919) % 3000 DIV 300 AS INT))").alias("report_timestamp"),
        (F.col("id") * 1.0).alias("temp"), F.lit(1.0).alias("alt"))
    path = str(tmp_path / "long")
    exporting.export_months(many, store[1], store[2], path, months_of=many, levels_timed=timed)
    rows = spark.read.parquet(path).select("observed_variable", "report_timestamp", "observation_id", "_metadata.file_name", "_metadata.row_index").collect()
    files = {name: sum(r.file_name == name for r in rows) for name in {r.file_name for r in rows}}
    assert sum(files.values()) == 15 * 3000 and len(files) >= 5 and max(files.values()) <= 15 * 2 * most
    place = lambda r: (r.observed_variable, r.report_timestamp, r.observation_id)
    own = sorted(rows, key=lambda r: (r.observed_variable, r.file_name, r.row_index))
    assert [place(r) for r in own] == sorted(map(place, own))


def test_days_fill_parts_in_their_order(monkeypatch):
    monkeypatch.setattr(exporting, "PART_LEVELS", 10)
    assert exporting.day_parts([(3, 5), (1, 4), (2, 6), (9, 10)]) == [(1, 0), (2, 0), (3, 1), (9, 2)]
    assert exporting.day_parts([(1, 11)]) is None and exporting.day_parts([]) == []


def test_code_of_the_long_table_is_small_enough_to_be_compiled(spark):
    """Java's compiler leaves methods over 8000 bytes of code to the interpreter."""
    from ascentframe.queries import longtable

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = longtable.long_table(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
        stages = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenStringSeq(plan)
        sizes = [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) <= 8000


def test_reports_of_a_month_are_counted_without_a_group_for_each(spark):
    """A distinct count would keep all sums for each report and variable; before, it took four aggregates."""
    from ascentframe.queries import longtable

    plan = _plan(longtable.long_table_by_month(spark, "/root/testdata/sf0.001"))
    assert plan.split("Initial Plan")[-1].count("HashAggregate") == 2


def test_boxes_open_only_their_tiles(spark, tmp_path):
    path = str(tmp_path / "tiles")
    names = "`latitude|station_configuration` double, `longitude|station_configuration` double, id int"
    places = [(52.2, 14.1, 1), (47.0, 179.5, 2), (47.0, -179.5, 3), (-45.0, 169.7, 4), (None, 10.0, 5), (50.0, 20.0, 6), (49.99, 20.0, 7)]
    writers.write_tiles(spark.createDataFrame(places, names), path)
    box = lambda *edges: tables.read_box(spark, path, *edges)
    ids = lambda *edges: sorted(r["id"] for r in box(*edges).collect())
    assert ids(45, 55, 10, 20) == [1, 6, 7] and ids(50, 55, 10, 20) == [1, 6] and ids(-90, 90, -180, 180) == [1, 2, 3, 4, 6, 7]
    assert ids(40, 48, 175, -175) == [2, 3] and ids(-50, -45, 160, 170) == [4]
    plan = _plan(box(45, 55, 10, 20))
    assert "PartitionFilters: [isnotnull(lat_tile" in plan and len(box(45, 55, 10, 20).inputFiles()) >= 3
    writers.write_tiles(spark.createDataFrame([(52.0, 14.0, 9)], names), path)  # its tile is replaced, the others stay
    assert ids(-90, 90, -180, 180) == [2, 3, 4, 6, 7, 9]


def test_tiles(spark):
    df = spark.sql("SELECT 52.2D AS `latitude|station_configuration`, -3.1D AS `longitude|station_configuration`")
    row = cdm.with_tiles(df).first()
    assert (row["lat_tile"], row["lon_tile"]) == (50, -10)


def test_many_levels_are_exported_and_indexed_in_rounds_of_whole_months(spark, store, tmp_path, monkeypatch):
    """What a round shuffles is deleted before the next; before, all months were shuffled at once and stored three times as large."""
    assert cdm.month_rounds({(2020, 12): 5, (2021, 1): 3}) == [[(2020, 12), (2021, 1)]] and cdm.month_rounds({}) == []
    monkeypatch.setattr(cdm, "ROUND_LEVELS", 100)
    assert cdm.month_rounds({(2020, m): 100 for m in (3, 1, 2)} | {(2019, 4): 50, (None, None): 1}) == [
        [(2019, 4)], [(2020, 1)], [(2020, 2)], [(2020, 3)], [(None, None)]]
    many = spark.range(900).select(
        (F.col("id") % 2 + 1).alias("g_product_id"), F.col("id").alias("observation_id"),
        F.expr("timestamp'2020-11-01 12:00:00' + make_interval(0, CAST(id % 3 AS INT), 0, CAST(id % 5 AS INT))").alias("report_timestamp"),
        (F.col("id") * 1.0).alias("temp"), (900.0 - F.col("id")).alias("alt"))
    seen, write = [], writers.write_long_table

    def watched(long, path):
        seen.append((long.select("report_timestamp").distinct().count(), spark.conf.get(DROP_SHUFFLES)))
        write(long, path)

    monkeypatch.setattr(writers, "write_long_table", watched)
    found = {}
    for timed in (True, False):
        path = str(tmp_path / f"long-{timed}")
        assert exporting.export_months(many, store[1].drop("report_timestamp"), store[2], path, months_of=many, levels_timed=timed).count() == 3
        assert seen == [(5, "true")] * 3 and spark.conf.get(DROP_SHUFFLES, None) != "true"
        seen.clear()
        back = spark.read.parquet(path)
        assert sorted(map(tuple, back.groupBy("year", "month").count().collect())) == [(2020, 11, 4500), (2020, 12, 4500), (2021, 1, 4500)]
        found[timed] = sorted(map(str, back.collect()))
        for _ in range(2):  # a new index takes the old one's place
            catalog.write_launch_index(spark, path)
        index = catalog.launch_index(spark, path)
        assert index.agg(F.sum("rows")).first()[0] == 13500 and spark.read.parquet(path).count() == 13500
        assert not [p for p in (tmp_path / f"long-{timed}").iterdir() if p.name.startswith("_draft")]
        part = next((tmp_path / f"long-{timed}" / "year=2020" / "month=12").glob("*.parquet"))
        assert ".zstd." in part.name
    assert found[True] == found[False]


def test_encoded_numbers_travel_as_they_are_stored(spark, store, monkeypatch):
    """The exchange of the levels held doubles, which are stored as floats."""
    from ascentframe.queries import longtable

    wide = store[0].withColumns({"temp": F.col("temp") / 3, "press": F.when(F.col("press") == 1, F.lit(1e300)).otherwise(F.col("press") / 7)})
    both = [cdm.encoded_long_table(exporting.build_long_table(wide, *store[1:], kind=kind)) for kind in ("double", "float")]
    assert both[0].schema == both[1].schema and sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))
    seen, made = [], cdm.level_measures
    monkeypatch.setattr(cdm, "level_measures", lambda *args: seen.append(made(*args)) or seen[-1])
    longtable.encoded_long_table(spark, "/root/testdata/sf0.001")
    assert dict(seen[0].dtypes)["_value"] == "array<float>"
