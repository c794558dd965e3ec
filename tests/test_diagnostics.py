import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ascentframe.functions import thermo as th
from ascentframe.operators import diagnostics as D
from ascentframe.operators import profile as P
from ascentframe.operators.ordered import Group

SCHEMA = "g_product_id long, level_idx int, press double, temp double, rh double, alt double, u double, v double"


def sounding(sid, n=40, seed=1, wind=True, shuffle=False):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        z = 50 + 500.0 * k
        t = max(295 - 0.0065 * z + rng.uniform(-0.4, 0.4), 212 + rng.uniform(-0.2, 0.2))
        out.append([sid, k, 1005 * math.exp(-z / 7800), t, rng.uniform(15, 98), z,
                    4 + 0.3 * k + rng.uniform(-1, 1) if wind else None, 1 - 0.1 * k if wind else None])
    if shuffle:
        rng.shuffle(out)
        for i, row in enumerate(out):
            row[1] = i
    return [tuple(row) for row in out]


def levels(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def scalars(spark, rows, **kw):
    return {r["g_product_id"]: r for r in D.sounding_scalars(levels(spark, rows), **kw).collect()}


def test_standard_levels_give_the_worked_indices(spark):
    """T850 10, T700 0, T500 -20, Td850 5, Td700 -5: K 30, Total Totals 55."""

    def rh(t, td):
        es = lambda c: math.exp(17.67 * c / (c + 243.5))
        return 100 * es(td) / es(t)

    points = [(1000, 20, 15), (925, 15, 10), (850, 10, 5), (700, 0, -5), (600, -10, -15), (500, -20, -25), (400, -32, -40),
              (300, -45, -55), (250, -52, -60), (200, -56, -65)]
    rows = [(1, i, float(p), t + 273.15, rh(t, td), 100.0 + 900 * i, 1.0, 1.0) for i, (p, t, td) in enumerate(points)]
    got = scalars(spark, rows)[1]
    assert got["diag_k_index"] == pytest.approx(30, abs=1e-9)
    assert got["diag_total_totals"] == pytest.approx(55, abs=1e-9)
    assert got["diag_freezing_level_index"] == 3
    assert got["diag_lcl_p"] < 1000 and got["diag_lcl_t"] < 15


def test_nine_valid_levels_are_kept_but_not_diagnosed(spark):
    rows = sounding(1, 9) + [(1, 9, 100.0, None, 50.0, 20000.0, 1.0, 1.0)] + sounding(2, 12)
    assert set(scalars(spark, rows)) == {2}
    out = D.diagnosed_levels(levels(spark, rows)).collect()
    assert len(out) == 22
    assert all(r["theta"] is None for r in out if r["g_product_id"] == 1)
    assert all(r["theta"] is not None for r in out if r["g_product_id"] == 2)


def test_missing_wind_leaves_the_rest(spark):
    got = scalars(spark, sounding(1, wind=False))[1]
    assert got["diag_shear_0_1km_u"] is None and got["diag_srh_0_3km_tot"] is None
    assert got["diag_pwat"] > 0 and got["diag_cape"] is not None


def test_level_order_in_the_file_does_not_matter(spark):
    a = scalars(spark, sounding(1, seed=3))[1].asDict()
    b = scalars(spark, sounding(1, seed=3, shuffle=True))[1].asDict()
    assert a == b


def test_split_path_gives_the_same(spark, hot_groups):
    rows = sounding(1, 60, 4) + sounding(2, 15, 5)
    plain = {k: r.asDict() for k, r in scalars(spark, rows).items()}
    hot_groups(20)
    split = {k: r.asDict() for k, r in scalars(spark, rows).items()}
    for sid, row in plain.items():
        for name, value in row.items():
            assert split[sid][name] == (pytest.approx(value, rel=1e-12) if isinstance(value, float) else value), name


def brute_tropopause(p, t):
    z = [0.0]
    for i in range(1, len(p)):
        z.append(z[-1] + 29.27 * 0.5 * (t[i - 1] + t[i]) * math.log(p[i - 1] / p[i]) / 1000)
    for i in range(1, len(p) - 1):
        dz = z[i] - z[i - 1]
        if p[i] > 500 or dz <= 0 or -(t[i] - t[i - 1]) / dz > 2:
            continue
        j = next((j for j in range(i, len(p)) if z[j] >= z[i] + 2), len(p) - 1)
        if z[j] - z[i] > 0 and -(t[j] - t[i]) / (z[j] - z[i]) <= 2:
            return p[i], t[i] - 273.15
    return None


def test_tropopause_against_brute_force(spark):
    rows = [r for sid in range(1, 9) for r in sounding(sid, 45, seed=sid)]
    got = {r["g_product_id"]: (r["diag_tropopause_p"], r["diag_tropopause_t"])
           for r in D.tropopauses(levels(spark, rows)).collect()}
    for sid in range(1, 9):
        mine = sorted((r for r in rows if r[0] == sid), key=lambda r: -r[2])
        want = brute_tropopause([r[2] for r in mine], [r[3] for r in mine])
        assert (got.get(sid) is None) == (want is None)
        if want:
            assert got[sid] == pytest.approx(want)


def test_saturated_temperature_inverts_theta_e(spark):
    df = spark.range(200).select(
        (F.lit(150.0) + F.col("id") * 4).alias("p"), (F.lit(230.0) + F.col("id") * 0.3).alias("t"))
    df = df.withColumn("e", th.equivalent_potential_temperature(F.col("p"), F.col("t"), F.col("t")))
    df = df.withColumn("back", th.saturated_temperature("p", "e", F.col("t") + 3))
    worst = df.agg(F.max(F.abs(F.col("back") - F.col("t"))).alias("d"), F.count("back").alias("n")).first()
    assert worst["n"] == 200 and worst["d"] < 1e-9


def test_ascent_without_a_start_or_a_solution_is_missing(spark):
    rows = [(1000.0, 330.0, None), (1000.0, None, 290.0), (None, 330.0, 290.0), (-5.0, 330.0, 290.0), (500.0, 330.0, 290.0), (500.0, -1.0, 290.0)]
    df = spark.createDataFrame(rows, "p double, e double, l double").select("p", th.saturated_temperature("p", "e", "l").alias("t"))
    assert [r["t"] is None for r in df.collect()] == [True, True, True, True, False, True]


def test_all_diagnostics_run_without_python_and_reuse_their_exchange(spark):
    from ascentframe.queries import QUERIES

    plan = QUERIES["sounding_diagnostics"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    # one deals out the events that the fixture numbers, one the soundings
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") <= 2


def test_smoothing_repeats_the_edges(spark):
    df = spark.createDataFrame([(1, i, float(i + 1)) for i in range(5)], "k int, i int, x double")
    group = Group(df, ["k"], [F.asc("i")]).neighbours(["x"], 2, 2)
    got = [r["s"] for r in group.df.select("i", P.smoothed("x").alias("s")).orderBy("i").collect()]
    assert got == pytest.approx([1.6, 2.2, 3.0, 3.8, 4.4])


def test_interpolation_is_clamped(spark):
    df = spark.createDataFrame([(1, 1000.0, 10.0, 1), (1, 800.0, 0.0, 2)], "k int, p double, t double, rn int")
    at = {level: P.interpolated(["t"], level)["t"] for level in (900.0, 700.0, 1050.0, 800.0)}
    row = df.groupBy("k").agg(*[c.alias(f"t{int(x)}") for x, c in at.items()]).first()
    assert (row["t900"], row["t700"], row["t1050"], row["t800"]) == (5.0, 0.0, 10.0, 0.0)


@pytest.mark.parametrize("dialect, top, scaled", [("CF-1.4", 0.98, True), ("CF-1.4", 55.0, False), ("CF-1.7", 0.98, False)])
def test_humidity_scaling(spark, dialect, top, scaled):
    df = spark.createDataFrame([(dialect, top)], "c string, m double")
    got = df.select(P.humidity_percent(F.col("m"), F.col("c"), F.col("m")).alias("x")).first()["x"]
    assert got == pytest.approx(top * 100 if scaled else top)


def test_clouds(spark):
    rows = sounding(1, 30, 2)
    dry = [r[:4] + (20.0,) + r[5:] for r in rows]
    assert scalars(spark, dry)[1]["diag_cloud_base_type"] == "clear"
    assert scalars(spark, dry)[1]["diag_cloud_base_height"] is None
    wet = [r[:4] + (96.0 if r[5] == 550.0 else 20.0,) + r[5:] for r in rows]
    got = scalars(spark, wet)[1]
    assert (got["diag_cloud_base_height"], got["diag_cloud_base_type"]) == (550.0, "low cloud (RH)")
    high = [r[:4] + (90.0 - abs(r[5] - 8050) / 100,) + r[5:] for r in rows]
    got = scalars(spark, high)[1]
    assert (got["diag_cloud_base_height"], got["diag_cloud_base_type"]) == (8050.0, "high cloud (Zhang)")


def test_altitude_and_wind_preference(spark):
    rows = sounding(1, 12)
    df = levels(spark, rows).withColumn("alt_amsl", F.col("alt") + 10).withColumn("wzon", F.col("u") * 2)
    df = df.withColumn("u", F.lit(None).cast("double")).withColumn("wmeri", F.lit(0.0))
    out = P.over_soundings(df, lambda g: g.df.select("alt", "z", "wzon", "u_wind", "v", "v_wind", "has_wind"))
    for r in out.collect():
        assert r["z"] == r["alt"] + 10 and r["u_wind"] == r["wzon"] and r["v_wind"] == r["v"] and r["has_wind"]


def test_nan_is_missing(spark):
    rows = sounding(1, 12) + [(1, 12, float("nan"), 250.0, 50.0, 9000.0, 1.0, 1.0), (1, 13, 90.0, float("inf"), 5.0, 9000.0, 1.0, 1.0)]
    out = P.over_soundings(levels(spark, rows), lambda g: g.df.select("level_idx", "valid", "n_valid")).collect()
    assert {r["level_idx"] for r in out if not r["valid"]} == {12, 13}
    assert {r["n_valid"] for r in out} == {12}


def test_nested_form(spark):
    row = D.full_sounding_diagnostics(levels(spark, sounding(1, 20))).first()
    assert row["Parcel"]["LCL_p"] > 0 and row["Misc"]["PWAT"] > 0 and row["CloudBase"]["Type"]


def test_enrich_keeps_all_rows(spark):
    lv = levels(spark, sounding(1, 15) + sounding(2, 4))
    heads = spark.createDataFrame([(1, "CF-1.7"), (2, "CF-1.4")], "g_product_id long, conventions string")
    out_levels, out_heads = D.enrich(lv, heads)
    assert out_levels.count() == 19
    got = {r["g_product_id"]: r["diag_pwat"] for r in out_heads.collect()}
    assert got[1] > 0 and got[2] is None


def test_helicity_of_a_straight_hodograph_is_zero(spark):
    rows = [r[:6] + (r[5] / 500, 0.0) for r in sounding(1, 20)]
    got = scalars(spark, rows)[1]
    assert got["diag_srh_0_3km_tot"] == pytest.approx(0.0)
    assert got["diag_shear_0_3km_u"] == pytest.approx(6.0)
    assert np.isclose(got["diag_shear_0_1km_u"], 2.0)
