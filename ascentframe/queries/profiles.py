"""Sounding diagnostics over the whole events table, with SQL twins.

The twins repeat the formulas in plain SQL; the saturated ascent is found by
bisection there instead of Newton steps.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ascentframe import contracts as C
from ascentframe.functions import thermo as th
from ascentframe.operators import diagnostics as D
from ascentframe.operators import profile as P
from ascentframe.operators.ordered import Group, per_group
from ascentframe.queries import views as V
from ascentframe.queries.registry import query

K = th.KAPPA
EPS = th.EPSILON


def _es(t):
    return f"(6.112e0*exp(17.67e0*({t}-273.15e0)/({t}-29.65e0)))"


def _lcl_t(t, d):
    return f"(1e0/(1e0/({d}-56e0)+ln({t}/{d})/800e0)+56e0)"


def _mix(p, e):
    return f"({EPS}e0*{e}/({p}-{e}))"


def _theta_e(p, t, d):
    e, r, tl = _es(d), _mix(p, _es(d)), _lcl_t(t, d)
    return (f"({t}*pow(1000e0/({p}-{e}),{K!r}e0)*pow({t}/{tl},0.28e0*{r})"
            f"*exp({r}*(1e0+0.448e0*{r})*(3036e0/{tl}-1.78e0)))")


def _ln_theta_es(t, p):
    e, r = _es(t), _mix(p, _es(t))
    return f"(ln({t})+{K!r}e0*ln(1000e0/({p}-{e}))+{r}*(1e0+0.448e0*{r})*(3036e0/{t}-1.78e0))"


NUMBERED = """
ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events)"""

LEVELS = NUMBERED + """,
lv AS (
  SELECT user_id AS g_product_id, CAST(k AS INTEGER) AS level_idx, 1000e0*exp(-k/25e0) AS press,
    100e0+320e0*k AS alt, value,
    CASE WHEN event_type <> 'error' THEN
      greatest(288.15e0 + user_id%20 - 0.0065e0*(320e0*k), 210e0 + user_id%5) + ((value%1e0)-0.5e0)*0.2e0 END AS temp,
    CASE WHEN user_id%2=0 THEN (20e0+(value*7e0)%80e0)/100e0 ELSE 20e0+(value*7e0)%80e0 END AS rh,
    CASE WHEN user_id%7<>0 THEN 5e0+0.4e0*k+value%3e0 END AS u,
    CASE WHEN user_id%7<>0 THEN -2e0+0.1e0*k END AS v,
    CASE WHEN user_id%2=0 THEN 'CF-1.4' ELSE 'CF-1.7' END AS conventions
  FROM ev)"""

VALID = LEVELS + f""",
sc AS (
  SELECT *, CASE WHEN conventions IN ('CF-1.4','RS-11G') AND max(rh) OVER w <= 1.1e0 THEN rh*100e0 ELSE rh END AS rhp,
    count(u) OVER w > 0 AND count(v) OVER w > 0 AS has_wind
  FROM lv WINDOW w AS (PARTITION BY g_product_id)),
mk AS (
  SELECT *, coalesce(press>0 AND temp IS NOT NULL AND rhp IS NOT NULL AND alt IS NOT NULL
    AND (NOT has_wind OR (u IS NOT NULL AND v IS NOT NULL)), false) AS valid FROM sc),
vc AS (SELECT *, count(*) FILTER (valid) OVER (PARTITION BY g_product_id) AS n_valid FROM mk),
good AS (
  SELECT g_product_id AS sid, level_idx, press AS p, temp AS tk, rhp, alt AS z, u, v,
    row_number() OVER (PARTITION BY g_product_id ORDER BY press DESC, level_idx DESC) AS rn,
    243.5e0*ln(rhp/100e0*{_es('temp')}/6.112e0)/(17.67e0-ln(rhp/100e0*{_es('temp')}/6.112e0))+273.15e0 AS dk
  FROM vc WHERE valid AND n_valid >= {C.MIN_VALID_LEVELS})"""

THERMO = VALID + f""",
thm AS (
  SELECT *, tk*pow(1000e0/p,{K!r}e0) AS theta, {_theta_e('p', 'tk', 'dk')} AS theta_e FROM good)"""

SURFACE = THERMO + f""",
sfc AS (SELECT sid, p AS p0, tk AS t0, dk AS d0, z AS z0, u AS u0, v AS v0, theta_e AS e0 FROM thm WHERE rn=1),
lcl AS (SELECT *, {_lcl_t('t0', 'd0')} AS lcl_t FROM sfc),
lcl2 AS (SELECT *, p0*pow(lcl_t/t0,{1.0 / K!r}e0) AS lcl_p FROM lcl),
lw AS (SELECT thm.*, p0,t0,d0,z0,u0,v0,e0,lcl_t,lcl_p FROM thm JOIN lcl2 USING (sid))"""

ASCENT = SURFACE + f""",
bis(sid,rn,p,e0,step,lo,hi) AS (
  SELECT sid,rn,p,e0,0,100e0,CAST(least(lcl_t+0.5e0, e0*pow(p/1000e0,{K!r}e0)+0.5e0) AS DOUBLE) FROM lw WHERE p<lcl_p
  UNION ALL
  SELECT sid,rn,p,e0,step+1,
    CASE WHEN {_ln_theta_es('((lo+hi)/2e0)', 'p')} > ln(e0) THEN lo ELSE (lo+hi)/2e0 END,
    CASE WHEN {_ln_theta_es('((lo+hi)/2e0)', 'p')} > ln(e0) THEN (lo+hi)/2e0 ELSE hi END
  FROM bis WHERE step<48),
asc_ AS (
  SELECT lw.*, CASE WHEN lw.p>=lcl_p THEN t0*pow(lw.p/p0,{K!r}e0) ELSE (lo+hi)/2e0 END AS tp, ln(lw.p) AS x
  FROM lw LEFT JOIN (SELECT * FROM bis WHERE step=48) b ON b.sid=lw.sid AND b.rn=lw.rn),
prf AS (
  SELECT *, tp-tk AS b, lag(tp-tk) OVER w AS b1, lag(x) OVER w AS x1, lag(tp) OVER w AS tp1,
    lag(p) OVER w AS p1, lag(tk) OVER w AS tk1 FROM asc_ WINDOW w AS (PARTITION BY sid ORDER BY rn))"""

POINTS = ASCENT + """,
crs AS (
  SELECT *, x1+b1/(b1-b)*(x-x1) AS cx, tp1+b1/(b1-b)*(tp-tp1) AS ct FROM prf WHERE b1 IS NOT NULL AND b1<>b),
lfc_rows AS (
  SELECT prf.sid, prf.rn, prf.lcl_p, prf.lcl_t, prf.b1, crs.cx, crs.ct,
    row_number() OVER (PARTITION BY prf.sid ORDER BY prf.rn) AS nth
  FROM prf LEFT JOIN crs ON crs.sid=prf.sid AND crs.rn=prf.rn WHERE prf.p<prf.lcl_p AND prf.b>0),
lfc AS (
  SELECT sid, CASE WHEN b1<=0 AND exp(cx)<=lcl_p THEN exp(cx) ELSE lcl_p END AS lfc_p,
    CASE WHEN b1<=0 AND exp(cx)<=lcl_p THEN ct ELSE lcl_t END AS lfc_t FROM lfc_rows WHERE nth=1),
el_rows AS (
  SELECT sid, exp(cx) AS el_p, ct AS el_t, row_number() OVER (PARTITION BY sid ORDER BY rn DESC) AS nth
  FROM crs WHERE b1>0 AND b<=0),
pts AS (
  SELECT l.sid, l.lcl_p, l.lcl_t, lfc_p, lfc_t, CASE WHEN el_p<lfc_p THEN el_p END AS el_p,
    CASE WHEN el_p<lfc_p THEN el_t END AS el_t
  FROM lcl2 l LEFT JOIN lfc ON lfc.sid=l.sid LEFT JOIN el_rows e ON e.sid=l.sid AND e.nth=1),
seg AS (
  SELECT prf.sid, x, x1, b, b1, ln(lfc_p) AS lx, coalesce(ln(el_p),-1e9) AS ex
  FROM prf JOIN pts ON pts.sid=prf.sid WHERE lfc_p IS NOT NULL AND x1>x),
cut AS (
  SELECT *, least(x1,lx) AS ca, greatest(x,ex) AS cb, x1 AS na, greatest(x,lx) AS nb FROM seg),
area AS (
  SELECT sid,
    sum(CASE WHEN ca>cb THEN ((b1+(b-b1)*(x1-ca)/(x1-x))+(b1+(b-b1)*(x1-cb)/(x1-x)))/2e0*(ca-cb) END) AS ac,
    sum(CASE WHEN na>nb THEN ((b1+(b-b1)*(x1-na)/(x1-x))+(b1+(b-b1)*(x1-nb)/(x1-x)))/2e0*(na-nb) END) AS an
  FROM cut GROUP BY sid),
par AS (
  SELECT pts.*, coalesce(ac*""" + f"{th.R_DRY}e0" + """,0) AS cape,
    least(coalesce(an*""" + f"{th.R_DRY}e0" + """,0),0) AS cin
  FROM pts LEFT JOIN area ON area.sid=pts.sid)"""


def _at(level, name, table="prf"):
    return (
        f"(SELECT CASE WHEN hi.p IS NULL THEN lo.{name} WHEN lo.p IS NULL THEN hi.{name} "
        f"WHEN hi.p=lo.p THEN lo.{name} "
        f"ELSE lo.{name}+({level}e0-lo.p)/(hi.p-lo.p)*(hi.{name}-lo.{name}) END)"
    )


def _bracket(level):
    return f"""
b{level} AS (
  SELECT i.sid, {', '.join(f"{_at(level, n)} AS {n}{level}" for n in ('tk', 'dk', 'tp'))}
  FROM (SELECT DISTINCT sid FROM prf) i
  LEFT JOIN (SELECT sid,p,tk,dk,tp FROM prf WHERE p>={level} QUALIFY row_number() OVER (PARTITION BY sid ORDER BY p, rn)=1) hi
    ON hi.sid=i.sid
  LEFT JOIN (SELECT sid,p,tk,dk,tp FROM prf WHERE p<={level} QUALIFY row_number() OVER (PARTITION BY sid ORDER BY p DESC, rn DESC)=1) lo
    ON lo.sid=i.sid)"""


INDICES = ASCENT + "," + ",".join(_bracket(level) for level in (850, 700, 500)) + f""",
ix AS (
  SELECT sid, tk850-273.15e0 AS a, dk850-273.15e0 AS ad, tk700-273.15e0 AS c, dk700-273.15e0 AS cd,
    tk500-273.15e0 AS f, tp500-273.15e0 AS fp, {_lcl_t('tk850', 'dk850')} AS lt, tk850, dk850
  FROM b850 JOIN b700 USING (sid) JOIN b500 USING (sid)),
ix2 AS (
  SELECT *, 850e0*pow(lt/tk850,{1.0 / K!r}e0) AS lp, {_theta_e('850e0', 'tk850', 'dk850')} AS te FROM ix),
sbis(sid,te,step,lo,hi) AS (
  SELECT sid,te,0,100e0,CAST(least(lt+0.5e0, te*pow(500e0/1000e0,{K!r}e0)+0.5e0) AS DOUBLE) FROM ix2
  UNION ALL
  SELECT sid,te,step+1,
    CASE WHEN {_ln_theta_es('((lo+hi)/2e0)', '500e0')} > ln(te) THEN lo ELSE (lo+hi)/2e0 END,
    CASE WHEN {_ln_theta_es('((lo+hi)/2e0)', '500e0')} > ln(te) THEN (lo+hi)/2e0 ELSE hi END
  FROM sbis WHERE step<48),
idx AS (
  SELECT ix2.sid, (a-f)+ad-(c-cd) AS k_index, a+ad-2e0*f AS total_totals, f-fp AS lifted_index,
    f-(CASE WHEN lp<=500 THEN tk850*pow(500e0/850e0,{K!r}e0) ELSE (lo+hi)/2e0 END-273.15e0) AS showalter
  FROM ix2 JOIN sbis ON sbis.sid=ix2.sid AND step=48)"""

TROPOPAUSE = """,
hy AS (
  SELECT sid, rn, p, tk, lag(tk) OVER w AS tk1,
    coalesce(29.27e0*(lag(tk) OVER w + tk)*0.5e0*ln(lag(p) OVER w / p)/1000e0,0e0) AS dz
  FROM good WINDOW w AS (PARTITION BY sid ORDER BY rn)),
hz AS (SELECT *, sum(dz) OVER (PARTITION BY sid ORDER BY rn) AS zkm, max(rn) OVER (PARTITION BY sid) AS top FROM hy),
hl AS (
  SELECT *, CASE WHEN dz>0 THEN (tk1-tk)/dz END AS lapse,
    first_value(zkm) OVER f AS za, first_value(tk) OVER f AS ta
  FROM hz WINDOW f AS (PARTITION BY sid ORDER BY zkm RANGE BETWEEN 2e0 FOLLOWING AND UNBOUNDED FOLLOWING)),
ha AS (
  SELECT hl.*, coalesce(za, l.zkm) AS z2, coalesce(ta, l.tk) AS t2
  FROM hl JOIN (SELECT sid, zkm, tk FROM hz WHERE rn=top) l USING (sid)),
trp AS (
  SELECT sid, p AS trop_p, tk-273.15e0 AS trop_t FROM ha
  WHERE rn>1 AND rn<top AND p<=500 AND lapse<=2 AND z2>zkm AND (tk-t2)/(z2-zkm)<=2
  QUALIFY row_number() OVER (PARTITION BY sid ORDER BY rn)=1)"""


def _wind(depth):
    def part(axis):
        return (f"CASE WHEN hi.z=lo.z THEN lo.{axis} ELSE lo.{axis}+(z0+{depth}-lo.z)/(hi.z-lo.z)*(hi.{axis}-lo.{axis}) END"
                f"-{axis}0 AS s{axis}{depth}")
    return f"""
w{depth} AS (
  SELECT s.sid, {part('u')}, {part('v')} FROM sfc s
  LEFT JOIN (SELECT g.sid,z,u,v FROM good g JOIN sfc USING (sid) WHERE z<=z0+{depth}
    QUALIFY row_number() OVER (PARTITION BY g.sid ORDER BY z DESC, rn DESC)=1) lo ON lo.sid=s.sid
  LEFT JOIN (SELECT g.sid,z,u,v FROM good g JOIN sfc USING (sid) WHERE z>=z0+{depth}
    QUALIFY row_number() OVER (PARTITION BY g.sid ORDER BY z, rn)=1) hi ON hi.sid=s.sid)"""


WIND = "," + ",".join(_wind(depth) for depth in (1000, 3000, 6000)) + """,
hw AS (
  SELECT g.sid, z, u, v, z0+3000 AS top, lead(z) OVER w AS zn, lead(u) OVER w AS un, lead(v) OVER w AS vn
  FROM good g JOIN sfc USING (sid) WINDOW w AS (PARTITION BY g.sid ORDER BY rn)),
hc AS (
  SELECT *, CASE WHEN zn>top THEN (top-z)/(zn-z) ELSE 1e0 END AS s FROM hw),
ht AS (
  SELECT sid, z, top, CASE WHEN z<top THEN (u+s*(un-u))*v-u*(v+s*(vn-v)) END AS t FROM hc),
srh AS (
  SELECT sid, CASE WHEN max(z)>=max(top) AND count(t)>0 THEN coalesce(sum(t) FILTER (t>0),0) END AS pos,
    CASE WHEN max(z)>=max(top) AND count(t)>0 THEN coalesce(sum(t) FILTER (t<0),0) END AS neg,
    CASE WHEN max(z)>=max(top) AND count(t)>0 THEN sum(t) END AS tot
  FROM ht GROUP BY sid)"""


def _sm(shift):
    def at(offset):
        if offset == 0:
            return "rhp"
        fn, n = ("lag", -offset) if offset < 0 else ("lead", offset)
        edge = "first_value" if offset < 0 else "last_value"
        return f"coalesce({fn}(rhp,{n}) OVER w,{edge}(rhp) OVER f)"
    return "(" + "+".join(at(o) for o in range(shift - 2, shift + 3)) + ")/5e0"


CLOUDS = f""",
sm AS (
  SELECT sid, rn, z, rhp, {_sm(0)} AS s0
  FROM good WINDOW w AS (PARTITION BY sid ORDER BY rn),
    f AS (PARTITION BY sid ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
pk AS (
  SELECT *, lag(s0) OVER w AS sb, lead(s0) OVER w AS sa FROM sm WINDOW w AS (PARTITION BY sid ORDER BY rn)),
cl AS (
  SELECT sid, min_by(z, rn) FILTER (z<=3000 AND rhp>=95) AS low,
    min_by(z, rn) FILTER (z>4000 AND s0>sb AND s0>sa AND s0>=75) AS high
  FROM pk GROUP BY sid),
cld AS (
  SELECT sid, coalesce(low, high) AS base,
    CASE WHEN low IS NOT NULL THEN 'low cloud (RH)' WHEN high IS NOT NULL THEN 'high cloud (Zhang)' ELSE 'clear' END AS kind
  FROM cl)"""

MISC = f""",
wt AS (
  SELECT sid, rn, p, tk, {_mix('p', _es('dk'))} AS w FROM good),
wl AS (SELECT *, lag(w) OVER x AS w1, lag(p) OVER x AS p1 FROM wt WINDOW x AS (PARTITION BY sid ORDER BY rn)),
msc AS (
  SELECT sid, sum((w+w1)/2e0*(p1-p))*100e0/{th.GRAVITY}e0 AS pwat, min(rn) FILTER (tk<=273.15e0)-1 AS frz
  FROM wl GROUP BY sid)"""


def _with(body: str, select: str) -> str:
    return "WITH RECURSIVE " + body + "\n" + select


def _r(name: str, digits: int = 4):
    return F.round(F.col(name), digits).alias(name)


@query("level_thermodynamics", _with(THERMO, """
SELECT sid AS g_product_id, level_idx, round(dk-273.15e0,6) AS td, round(theta,6) AS theta, round(theta_e,6) AS theta_e
FROM thm"""))
def level_thermodynamics(spark, sf_dir):
    rows = D.diagnosed_levels(V.sounding_levels(spark, sf_dir))
    rows = rows.where((F.col("n_valid") >= C.MIN_VALID_LEVELS) & F.col("valid"))
    return rows.select("g_product_id", "level_idx", _r("td", 6), _r("theta", 6), _r("theta_e", 6))


@query("parcel_ascent", _with(ASCENT, """
SELECT sid AS g_product_id, level_idx, round(tp-273.15e0,4) AS parcel_profile FROM asc_"""))
def parcel_ascent(spark, sf_dir):
    rows = D.diagnosed_levels(V.sounding_levels(spark, sf_dir)).where("parcel_profile IS NOT NULL")
    return rows.select("g_product_id", "level_idx", _r("parcel_profile"))


@query("enriched_levels", _with(ASCENT, """
SELECT l.g_product_id, l.level_idx, round(l.press,6) AS press, round(l.temp,6) AS temp,
  round(dk-273.15e0,4) AS td, round(theta,4) AS theta, round(theta_e,4) AS theta_e,
  round(tp-273.15e0,4) AS parcel_profile
FROM lv l LEFT JOIN asc_ a ON a.sid=l.g_product_id AND a.level_idx=l.level_idx"""))
def enriched_levels(spark, sf_dir):
    rows = D.diagnosed_levels(V.sounding_levels(spark, sf_dir))
    return rows.select("g_product_id", "level_idx", _r("press", 6), _r("temp", 6),
                       *[_r(name) for name in C.PROFILE_DIAGNOSTICS])


def _scalar_query(spark, sf_dir, digits):
    rows = D.sounding_scalars(V.sounding_levels(spark, sf_dir))
    return rows.select("g_product_id", *[
        F.col(name) if C.scalar_type(name) != "double" else _r(name, d) for name, d in digits.items()
    ])


PARCEL_COLS = {"diag_lcl_p": 4, "diag_lcl_t": 4, "diag_lfc_p": 4, "diag_lfc_t": 4, "diag_el_p": 4,
               "diag_el_t": 4, "diag_cape": 3, "diag_cin": 3}
_PARCEL_SQL = """round(lcl_p,4) AS diag_lcl_p, round(lcl_t-273.15e0,4) AS diag_lcl_t, round(lfc_p,4) AS diag_lfc_p,
  round(lfc_t-273.15e0,4) AS diag_lfc_t, round(el_p,4) AS diag_el_p, round(el_t-273.15e0,4) AS diag_el_t,
  round(cape,3) AS diag_cape, round(cin,3) AS diag_cin"""


@query("parcel_levels_energy", _with(POINTS, f"SELECT sid AS g_product_id, {_PARCEL_SQL} FROM par"))
def parcel_levels_energy(spark, sf_dir):
    return _scalar_query(spark, sf_dir, PARCEL_COLS)


INDEX_COLS = {"diag_lifted_index": 4, "diag_k_index": 4, "diag_total_totals": 4, "diag_showalter": 4}
_INDEX_SQL = """round(lifted_index,4) AS diag_lifted_index, round(k_index,4) AS diag_k_index,
  round(total_totals,4) AS diag_total_totals, round(showalter,4) AS diag_showalter"""


@query("stability_indices", _with(INDICES, f"SELECT sid AS g_product_id, {_INDEX_SQL} FROM idx"))
def stability_indices(spark, sf_dir):
    return _scalar_query(spark, sf_dir, INDEX_COLS)


@query("thermal_tropopause", _with(VALID + TROPOPAUSE, """
SELECT sid AS g_product_id, round(trop_p,4) AS diag_tropopause_p, round(trop_t,4) AS diag_tropopause_t FROM trp"""))
def thermal_tropopause(spark, sf_dir):
    rows = D.tropopauses(V.sounding_levels(spark, sf_dir))
    return rows.select("g_product_id", _r("diag_tropopause_p"), _r("diag_tropopause_t"))


WIND_COLS = {name: 9 for name in C.SCALAR_DIAGNOSTICS if "shear" in name or "srh" in name}
_WIND_SQL = ", ".join(
    [f"round(s{a}{km}000,9) AS diag_shear_0_{km}km_{a}" for km in (1, 3, 6) for a in "uv"]
    + [f"round({p},9) AS diag_srh_0_3km_{p}" for p in ("pos", "neg", "tot")]
)
_WIND_JOIN = "FROM w1000 JOIN w3000 USING (sid) JOIN w6000 USING (sid) JOIN srh USING (sid)"


@query("wind_shear_helicity", _with(SURFACE + WIND, f"SELECT sid AS g_product_id, {_WIND_SQL} {_WIND_JOIN}"))
def wind_shear_helicity(spark, sf_dir):
    return _scalar_query(spark, sf_dir, WIND_COLS)


@query("cloud_base", _with(VALID + CLOUDS, """
SELECT sid AS g_product_id, base AS diag_cloud_base_height, kind AS diag_cloud_base_type FROM cld"""))
def cloud_base(spark, sf_dir):
    return _scalar_query(spark, sf_dir, {"diag_cloud_base_height": 4, "diag_cloud_base_type": 0})


@query("water_and_freezing", _with(VALID + MISC, """
SELECT sid AS g_product_id, round(pwat,4) AS diag_pwat, CAST(frz AS INTEGER) AS diag_freezing_level_index FROM msc"""))
def water_and_freezing(spark, sf_dir):
    return _scalar_query(spark, sf_dir, {"diag_pwat": 4, "diag_freezing_level_index": 0})


_ALL = POINTS + INDICES[len(ASCENT):] + TROPOPAUSE + WIND + CLOUDS + MISC


@query("sounding_diagnostics", _with(_ALL, f"""
SELECT sid AS g_product_id, {_PARCEL_SQL}, {_INDEX_SQL},
  round(trop_p,4) AS diag_tropopause_p, round(trop_t,4) AS diag_tropopause_t,
  round(pwat,4) AS diag_pwat, CAST(frz AS INTEGER) AS diag_freezing_level_index,
  base AS diag_cloud_base_height, kind AS diag_cloud_base_type, {_WIND_SQL}
FROM par JOIN idx USING (sid) LEFT JOIN trp USING (sid) JOIN w1000 USING (sid) JOIN w3000 USING (sid)
  JOIN w6000 USING (sid) JOIN srh USING (sid) JOIN cld USING (sid) JOIN msc USING (sid)"""))
def sounding_diagnostics(spark, sf_dir):
    digits = {name: {**PARCEL_COLS, **WIND_COLS}.get(name, 4) for name in C.SCALAR_DIAGNOSTICS}
    return _scalar_query(spark, sf_dir, digits)


@query("level_validity", _with(VALID, """
SELECT g_product_id, level_idx, round(rhp,6) AS rh, has_wind, valid, n_valid FROM vc"""))
def level_validity(spark, sf_dir):
    def work(group):
        return group.df.select("g_product_id", "level_idx", _r("rh", 6), "has_wind", "valid", "n_valid")

    return P.over_soundings(V.sounding_levels(spark, sf_dir), work)


ODD = LEVELS + """,
od AS (
  SELECT g_product_id, level_idx, press, alt, rh, conventions, CASE WHEN g_product_id%5<>0 THEN temp END AS temp,
    CASE WHEN g_product_id%3=0 THEN alt+1e0 ELSE alt END AS z, coalesce(u, 5e0+0.4e0*level_idx) AS uw, coalesce(v, -2e0+0.1e0*level_idx) AS vw
  FROM lv WHERE g_product_id%4<>1 OR level_idx<9),
os AS (SELECT *, CASE WHEN conventions='CF-1.4' AND max(rh) OVER w <= 1.1e0 THEN rh*100e0 ELSE rh END AS rhp FROM od
  WINDOW w AS (PARTITION BY g_product_id)),
ov AS (SELECT *, press>0 AND temp IS NOT NULL AND rhp IS NOT NULL AS valid FROM os),
oc AS (SELECT *, count(*) FILTER (valid) OVER (PARTITION BY g_product_id) AS n_valid FROM ov)"""


def odd_soundings(spark, sf_dir):
    """Soundings with other names for height and wind, without temperature, or with nine levels only."""
    sid, k = F.col("g_product_id"), F.col("level_idx")
    return V.sounding_levels(spark, sf_dir).withColumns({
        "alt_amsl": F.when(sid % 3 == 0, F.col("alt") + 1.0),
        "wzon": F.when(sid % 7 == 0, 5.0 + 0.4 * k),
        "wmeri": F.when(sid % 7 == 0, -2.0 + 0.1 * k),
        "temp": F.when(sid % 5 != 0, F.col("temp")),
    }).where((sid % 4 != 1) | (k < 9))


@query("odd_sounding_preferences", _with(ODD, """
SELECT g_product_id, level_idx, round(z,6) AS z, round(uw,6) AS u_wind, round(vw,6) AS v_wind, valid, n_valid FROM oc"""))
def odd_sounding_preferences(spark, sf_dir):
    def work(group):
        return group.df.select("g_product_id", "level_idx", _r("z", 6), _r("u_wind", 6), _r("v_wind", 6), "valid", "n_valid")

    return P.over_soundings(odd_soundings(spark, sf_dir), work)


@query("odd_sounding_diagnostics", _with(ODD, f"""
SELECT g_product_id, level_idx, valid AND n_valid>={C.MIN_VALID_LEVELS} AS diagnosed, count(*) OVER (PARTITION BY g_product_id) AS levels
FROM oc"""))
def odd_sounding_diagnostics(spark, sf_dir):
    """No level is lost where a sounding is too short or lacks a variable; its diagnostics are NULL."""
    rows = D.diagnosed_levels(odd_soundings(spark, sf_dir))
    sizes = rows.groupBy("g_product_id").agg(F.count(F.lit(1)).alias("levels"))
    return rows.select("g_product_id", "level_idx", F.col("theta").isNotNull().alias("diagnosed")).join(sizes, "g_product_id")


@query("nested_diagnostics", _with(_ALL, """
SELECT sid AS g_product_id, round(trop_p,4) AS tropopause_p, round(pwat,4) AS pwat, CAST(frz AS INTEGER) AS freezing, base AS cloud_height,
  kind AS cloud_type FROM cld JOIN msc USING (sid) LEFT JOIN trp USING (sid)"""))
def nested_diagnostics(spark, sf_dir):
    rows = D.full_sounding_diagnostics(V.sounding_levels(spark, sf_dir), C.MIN_VALID_LEVELS)
    return rows.select(
        "g_product_id", F.round("Tropopause.p", 4).alias("tropopause_p"), F.round("Misc.PWAT", 4).alias("pwat"),
        F.col("Misc.FreezingLevelIndex").alias("freezing"), F.round("CloudBase.Height", 4).alias("cloud_height"),
        F.col("CloudBase.Type").alias("cloud_type"))


# -- ordered-profile building blocks on the raw event values -----------------------
def _users(spark, sf_dir, work):
    return per_group(V.table(spark, sf_dir, "events"), ["user_id"], [F.asc("ts"), F.asc("event_id")], work)


@query("boxcar_smoothing", """
WITH e AS (SELECT *, first_value(value) OVER f AS a, last_value(value) OVER f AS z FROM events
  WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT event_id, user_id, round((coalesce(lag(value,2) OVER w,a)+coalesce(lag(value,1) OVER w,a)+value
  +coalesce(lead(value,1) OVER w,z)+coalesce(lead(value,2) OVER w,z))/5e0,6) AS smoothed
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def boxcar_smoothing(spark, sf_dir):
    def work(group: Group):
        group = group.neighbours(["value"], back=2, ahead=2)
        return group.df.select("event_id", "user_id", F.round(P.smoothed("value"), 6).alias("smoothed"))

    return _users(spark, sf_dir, work)


@query("local_maxima", """
SELECT event_id, user_id, value FROM (
  SELECT *, lag(value) OVER w AS b, lead(value) OVER w AS a FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE value>b AND value>a""")
def local_maxima(spark, sf_dir):
    from ascentframe.operators.clouds import local_maximum

    def work(group: Group):
        df = group.neighbours(["value"], back=1, ahead=1).df
        peak = local_maximum(F.col("value"), F.col("prev1.value"), F.col("next1.value"))
        return df.where(peak).select("event_id", "user_id", "value")

    return _users(spark, sf_dir, work)


@query("profile_integral", """
SELECT user_id, count(*) AS levels, round(sum((value+pv)/2e0*(t-pt)),3) AS integral FROM (
  SELECT user_id, value, epoch_us(ts)/1e6 AS t, lag(value) OVER w AS pv, lag(epoch_us(ts)/1e6) OVER w AS pt
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY user_id""")
def profile_integral(spark, sf_dir):
    def work(group: Group):
        group = group.with_columns({"t": V.seconds(F.col("ts"))}).neighbours(["value", "t"], back=1)
        piece = (F.col("value") + F.col("prev1.value")) / 2.0 * (F.col("t") - F.col("prev1.t"))
        return group.df.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("levels"), F.round(F.sum(piece), 3).alias("integral"))

    return _users(spark, sf_dir, work)


@query("rates_between_levels", """
SELECT event_id, user_id, round(1000e0*(value-pv)/(t-pt),4) AS rate, round(sum(abs(value-coalesce(pv,value))) OVER w,4) AS travelled
FROM (SELECT *, epoch_us(ts)/1e6 AS t, lag(value) OVER w AS pv, lag(epoch_us(ts)/1e6) OVER w AS pt
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def rates_between_levels(spark, sf_dir):
    def work(group: Group):
        group = group.with_columns({"t": V.seconds(F.col("ts"))}).neighbours(["value", "t"], back=1)
        step = F.col("t") - F.col("prev1.t")
        rate = F.when(step != 0, 1000.0 * (F.col("value") - F.col("prev1.value")) / step)
        move = F.coalesce(F.abs(F.col("value") - F.col("prev1.value")), F.lit(0.0))
        group = group.with_columns({"rate": rate}).running({"travelled": move})
        return group.df.select("event_id", "user_id", _r("rate"), _r("travelled"))

    return _users(spark, sf_dir, work)


@query("value_two_days_on", """
SELECT e.event_id, e.user_id, coalesce(a.next_event, l.event_id) AS next_event, coalesce(a.next_value, l.value) AS next_value
FROM events e JOIN (
  SELECT event_id, first_value(event_id) OVER f AS next_event, first_value(value) OVER f AS next_value
  FROM events WINDOW f AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 2 DAY FOLLOWING AND UNBOUNDED FOLLOWING)) a
  ON a.event_id=e.event_id
JOIN (SELECT user_id, event_id, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)=1) l ON l.user_id=e.user_id""")
def value_two_days_on(spark, sf_dir):
    def work(group: Group):
        # whole micro-seconds are exact in a double, so the two-day step is too
        group = group.with_columns({"t": F.unix_micros(F.col("ts").cast("timestamp")).cast("double")})
        group = group.number("rn").attach({"last": F.max_by(F.struct("event_id", "value"), "rn")})
        found = group.reach_ahead("t", 2 * 86400e6, ["event_id", "value"], "ahead", F.lit(True), "rn")
        return found.select(
            "event_id", "user_id",
            F.coalesce("ahead.event_id", "last.event_id").alias("next_event"),
            F.coalesce("ahead.value", "last.value").alias("next_value"),
        )

    return _users(spark, sf_dir, work)


@query("standard_level_interpolation", _with(INDICES, """
SELECT sid AS g_product_id, round(tk850-273.15e0,6) AS t850, round(tk700-273.15e0,6) AS t700, round(tk500-273.15e0,6) AS t500
FROM b850 JOIN b700 USING (sid) JOIN b500 USING (sid)"""))
def standard_level_interpolation(spark, sf_dir):
    def work(group: Group):
        group = P.valid_levels(group).number("rn")
        group = group.with_columns({"tc": th.celsius(F.col("tk"))})
        return group.df.groupBy("g_product_id").agg(*[
            F.round(P.interpolated(["tc"], float(level))["tc"], 6).alias(f"t{level}") for level in (850, 700, 500)
        ])

    return P.over_soundings(V.sounding_levels(spark, sf_dir), work)
