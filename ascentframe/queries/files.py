"""Archive names, survivorship, members, tracking and sounding verdicts."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ascentframe.functions import naming as N
from ascentframe.operators import gates, survivorship, tracking
from ascentframe.plans import importing
from ascentframe.queries import views as V
from ascentframe.queries.registry import query
from ascentframe.session import ensure_checkpoint_dir, shared_dir, small_batches
from ascentframe.sources import archives

_RE = N.ARCHIVE_PATTERN

PARSED = V.ARCHIVE_SQL + f""",
pn AS (
  SELECT path, split_part(path,'/',3) AS filename, regexp_matches(path, '{_RE}') AS matches,
    {', '.join(f"nullif(regexp_extract(split_part(path,'/',3), '{_RE}', {i}),'') AS {n}"
               for i, n in enumerate(N.ARCHIVE_FIELDS, 1) if n != 'group')},
    nullif(regexp_extract(split_part(path,'/',3), '{_RE}', 6),'') AS grp,
    CASE WHEN path LIKE '%-RS-02/%' THEN 1 ELSE 2 END AS priority
  FROM files),
pf AS (
  SELECT *, TRY_CAST(split_part(grp,'-',3) AS INTEGER) AS group_no,
    CASE WHEN matches THEN coalesce(TRY_CAST(rev AS INTEGER),0) END AS rev_no FROM pn)"""


@query("archive_name_parsing", f"""WITH {PARSED}
SELECT path, filename, matches, station, extra, product, version, datetime, grp AS group_text, id, rev, priority, group_no, rev_no
FROM pf""")
def archive_name_parsing(spark, sf_dir):
    parsed = N.parse_archive_names(V.archive_files(spark, sf_dir))
    return parsed.select(
        "path", "filename", "matches", "station", "extra", "product", "version", "datetime",
        F.col("group").alias("group_text"), "id", "rev", N.folder_priority(F.col("path")).alias("priority"),
        "group_no", "rev_no",
    )


SURVIVORS = PARSED + """,
bw AS (
  SELECT *, CASE WHEN matches THEN row_number() OVER w END AS nth, first_value(filename) OVER w AS b_name,
    first_value(priority) OVER w AS b_pri, first_value(group_no) OVER w AS b_grp, first_value(rev_no) OVER w AS b_rev
  FROM pf WINDOW w AS (PARTITION BY matches, station, datetime ORDER BY priority, group_no DESC, rev_no DESC, path)),
sv AS (
  SELECT *, CASE WHEN NOT matches THEN 'Filename does not match archive pattern' WHEN nth=1 THEN NULL
    WHEN priority>b_pri THEN 'Superseded by file from higher priority folder (RS-0' || b_pri || '): ' || b_name
    ELSE 'Superseded by newer version: ' || b_name || ' (group ' || b_grp || ', rev ' || b_rev || ' vs group ' || group_no
      || ', rev ' || rev_no || ')' END AS reason FROM bw)"""


@query("survivor_selection", f"""WITH {SURVIVORS}
SELECT path, station, datetime, reason, CASE WHEN reason IS NULL THEN 'keep' ELSE 'skip' END AS outcome FROM sv""")
def survivor_selection(spark, sf_dir):
    judged = survivorship.select_survivors(V.archive_files(spark, sf_dir))
    return judged.select("path", "station", "datetime", "reason", "outcome")


@query("latest_line_per_part_supplier", """
SELECT l_partkey, l_suppkey, l_returnflag, l_orderkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey
  ORDER BY l_returnflag, l_orderkey DESC, l_linenumber DESC)=1""")
def latest_line_per_part_supplier(spark, sf_dir):
    lines = V.table(spark, sf_dir, "lineitem")
    rank = F.struct(F.col("l_returnflag"), (-F.col("l_orderkey")).alias("o"), (-F.col("l_linenumber")).alias("n"))
    best = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.min_by(F.struct("l_returnflag", "l_orderkey", "l_linenumber"), rank).alias("b"))
    return best.select("l_partkey", "l_suppkey", "b.*")


# -- members ---------------------------------------------------------------------
# Every order is one member of its customer's archive.  Customers with a key
# divisible by three have no revisions; the others hold revision folders, plus
# some members that are not data.
_MEMBER = {
    "kind": "CASE WHEN o_custkey % 3 = 0 THEN 'root' WHEN o_orderkey % 7 = 0 THEN 'readme' "
            "WHEN o_orderkey % 5 = 0 THEN 'named' WHEN o_orderkey % 11 = 0 THEN 'plain' ELSE 'folder' END",
    "rv": "CAST(month(o_orderdate) AS INT)",
}
_MEMBER_TEXT = (
    "CASE kind WHEN 'root' THEN concat('s', CAST(o_orderkey % 4 AS STRING), "
    "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('_rev', lpad(CAST(rv AS STRING), 3, '0')) END, '.nc') "
    "WHEN 'readme' THEN concat('rev', lpad(CAST(rv AS STRING), 3, '0'), '/readme', CAST(o_orderkey AS STRING), '.txt') "
    "WHEN 'named' THEN concat('a', CAST(o_orderkey AS STRING), '_rev', lpad(CAST(rv AS STRING), 3, '0'), '.nc') "
    "WHEN 'plain' THEN concat('p', CAST(o_orderkey AS STRING), '.nc') "
    "ELSE concat('rev', lpad(CAST(rv AS STRING), 3, '0'), '/m', CAST(o_orderkey AS STRING), '.nc') END"
)


def order_members(spark, sf_dir):
    rows = V.table(spark, sf_dir, "orders")
    rows = rows.withColumns({name: F.expr(text) for name, text in _MEMBER.items()})
    return rows.select(
        F.concat(F.lit("archive-"), F.col("o_custkey").cast("string"), F.lit(".jar")).alias("archive"),
        F.expr(_MEMBER_TEXT).alias("member"), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
    )


MEMBERS = f"""om AS (SELECT *, {', '.join(f'{t} AS {n}' for n, t in _MEMBER.items())} FROM orders),
mb AS (SELECT 'archive-' || o_custkey || '.jar' AS archive, {_MEMBER_TEXT.replace('STRING', 'VARCHAR')} AS member,
  o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM om),
dm AS (SELECT DISTINCT archive, member FROM mb),
mr AS (
  SELECT *, member LIKE '%.nc' AS is_data, NOT contains(member,'/') AS in_root,
    TRY_CAST(nullif(regexp_extract(member,'rev(\\d{{3}})/',1),'') AS INTEGER) AS frev,
    TRY_CAST(nullif(regexp_extract(member,'_rev(\\d{{3}})\\.nc$',1),'') AS INTEGER) AS nrev FROM dm),
mv AS (SELECT *, coalesce(frev, CASE WHEN is_data AND in_root THEN nrev END) AS rev FROM mr),
ml AS (SELECT *, max(rev) OVER (PARTITION BY archive) AS latest_rev FROM mv),
mc AS (
  SELECT *, CASE WHEN latest_rev IS NOT NULL THEN is_data AND (starts_with(member, 'rev' || lpad(latest_rev::VARCHAR,3,'0') || '/')
      OR coalesce(nrev=latest_rev,false)) ELSE is_data AND in_root END AS chosen FROM ml),
mj AS (
  SELECT archive, member, latest_rev, rev, CASE WHEN chosen THEN 'keep' ELSE 'skip' END AS outcome,
    CASE WHEN chosen THEN NULL WHEN NOT is_data THEN 'Not a data member'
      WHEN rev<latest_rev THEN 'Older revision (rev' || lpad(rev::VARCHAR,3,'0') || ') - using latest revision rev'
        || lpad(latest_rev::VARCHAR,3,'0')
      WHEN latest_rev IS NOT NULL THEN 'No revision, archive has revisions' ELSE 'Not in the archive root' END AS reason
  FROM mc)"""


@query("archive_member_revisions", f"WITH {MEMBERS} SELECT * FROM mj")
def archive_member_revisions(spark, sf_dir):
    return survivorship.select_members(order_members(spark, sf_dir))


@query("latest_member_per_base_name", f"""WITH {MEMBERS},
bb AS (
  SELECT archive, member, regexp_extract(member,'(.+?)(?:_rev\\d{{3}})?\\.nc$',1) AS base, coalesce(nrev,0) AS rev
  FROM mr WHERE is_data AND in_root),
bn AS (SELECT *, row_number() OVER w AS nth, first_value(rev) OVER w AS top FROM bb
  WINDOW w AS (PARTITION BY archive, base ORDER BY rev DESC, member))
SELECT archive, member, base, rev, CASE WHEN nth=1 THEN 'keep' ELSE 'skip' END AS outcome,
  CASE WHEN nth>1 THEN 'Older revision in filename (rev' || lpad(rev::VARCHAR,3,'0') || ') - using rev'
    || lpad(top::VARCHAR,3,'0') END AS reason FROM bn""")
def latest_member_per_base_name(spark, sf_dir):
    return survivorship.latest_per_base_name(order_members(spark, sf_dir))


@query("archives_without_members", f"""WITH {MEMBERS}
SELECT archive, CASE WHEN count(*) FILTER (member LIKE '%.nc')=0 THEN 'No data files found in ' || archive
  ELSE 'No valid data files to process after revision filtering in ' || archive END AS reason
FROM mj GROUP BY archive HAVING count(*) FILTER (outcome='keep')=0""")
def archives_without_members(spark, sf_dir):
    members = order_members(spark, sf_dir)
    return survivorship.archives_without_members(members, survivorship.select_members(members))


def _member_verdicts(spark, sf_dir):
    """Every order is an attempt at its member; the last one settles it: loaded, rejected with a reason, or not finished."""
    bad, text = F.col("o_orderstatus") == "P", F.concat(F.repeat("o_orderpriority", 30), F.lit(" in "), "member")
    return order_members(spark, sf_dir).select(
        "archive", "member", F.col("o_orderkey").alias("attempt"), (~bad).alias("loaded"),
        F.when(bad & ~F.col("o_orderpriority").startswith("5"), text).alias("reason"))


OUTCOMES = MEMBERS + """,
mo AS (SELECT archive, member, arg_max(o_orderstatus, o_orderkey) AS st, arg_max(o_orderpriority, o_orderkey) AS pr,
  min(o_orderkey) AS ord FROM mb GROUP BY ALL),
ck AS (SELECT mj.*, st, pr, ord, outcome='keep' AS k, outcome='keep' AND st='P' AND pr NOT LIKE '5%' AS e FROM mj JOIN mo USING (archive, member)),
pa AS (
  SELECT archive, count(*) FILTER (k) AS total, count(*) FILTER (k AND st<>'P') AS processed, count(*) FILTER (e) AS errors,
    min_by(repeat(pr,30) || ' in ' || member, ord) FILTER (e) AS fe, count(*) FILTER (reason LIKE 'Older revision%') AS skipped,
    max(latest_rev) AS lr, count(*) FILTER (member LIKE '%.nc') AS nc
  FROM ck GROUP BY archive),
pb AS (SELECT *, processed=total AND processed>0 AS success,
  CASE WHEN length(fe)>200 THEN left(fe,197) || '...' ELSE fe END AS main FROM pa),
ao AS (SELECT archive, success, CASE WHEN success THEN
  concat_ws('. ', 'Successfully processed ' || processed || ' data files',
    CASE WHEN lr IS NOT NULL THEN 'from revision rev' || lpad(lr::VARCHAR,3,'0') END,
    CASE WHEN skipped>0 THEN 'Skipped ' || skipped || ' files from older revisions' END) || '.'
  WHEN nc=0 THEN 'No data files found in ' || archive
  WHEN total=0 THEN 'No valid data files to process after revision filtering in ' || archive
  ELSE CASE WHEN errors>1 THEN main || ' (+ ' || (errors-1) || ' other errors)' WHEN errors=1 THEN main
    WHEN processed=0 THEN 'Failed to process all ' || total || ' data files'
    ELSE 'Partially processed ' || processed || '/' || total || ' files' END
    || CASE WHEN skipped>0 THEN '. Skipped ' || skipped || ' files from older revisions' ELSE '' END END AS note
FROM pb)"""


def _outcomes(spark, sf_dir):
    members = order_members(spark, sf_dir).select("archive", "member", F.col("o_orderkey").alias("ord"))
    return importing.process_archives(members, _member_verdicts(spark, sf_dir))


@query("archive_outcomes", f"WITH {OUTCOMES} SELECT * FROM ao")
def archive_outcomes(spark, sf_dir):
    """Members -> revision choice -> verdicts of the chosen members -> outcome of the archive."""
    return _outcomes(spark, sf_dir)


@query("archive_import_state", f"""WITH {OUTCOMES}
SELECT archive AS filename, success AS imported, CASE WHEN NOT success THEN left(note,255) END AS note,
  CASE WHEN success THEN note END AS detail FROM ao""")
def archive_import_state(spark, sf_dir):
    """Tracking state after the outcomes have become events."""
    events = importing.archive_events(_outcomes(spark, sf_dir), "RS41", 1)
    return tracking.current_state(events).select(
        "filename", F.col("date_of_import").isNotNull().alias("imported"), "note", "detail")


def _archive_of(doc_id: int, text: str | None, packing: int = zipfile.ZIP_STORED) -> bytes:
    """A small archive of a document, its text in one to three members by the document's number; every tenth archive is
    cut short (damaged)."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", packing, compresslevel=1) as z:
        for rev in range(1, doc_id % 3 + 2):
            z.writestr(f"rev{rev:03d}/doc{doc_id}.nc", text or "")
        z.writestr("readme.txt", "about")
    return buffer.getvalue()[:20] if doc_id % 10 == 0 else buffer.getvalue()


#: Bytes of archives that are handed on at once.
ZIPPED = 4 << 20


def _zipped(batches):
    """The archives of all documents, handed on a few megabytes at a time."""
    names, contents, held = [], [], 0
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            names.append(f"doc{doc_id}.jar")
            contents.append(_archive_of(int(doc_id), text))
            held += len(contents[-1])
            if held >= ZIPPED:
                yield pd.DataFrame({"archive": names, "content": contents})
                names, contents, held = [], [], 0
    if names:
        yield pd.DataFrame({"archive": names, "content": contents})


@query("archive_member_listing", """
WITH d AS (SELECT doc_id, strlen(text) AS n, unnest(range(1, CAST(doc_id%3+2 AS BIGINT))) AS rev FROM documents WHERE doc_id%10<>0)
SELECT 'doc' || doc_id || '.jar' AS archive, 'rev' || lpad(rev::VARCHAR,3,'0') || '/doc' || doc_id || '.nc' AS member,
  CAST(rev-1 AS INTEGER) AS ord, CAST(n AS BIGINT) AS size, false AS damaged FROM d
UNION ALL SELECT 'doc' || doc_id || '.jar', 'readme.txt', CAST(doc_id%3+1 AS INTEGER), 5, false FROM documents WHERE doc_id%10<>0
UNION ALL SELECT 'doc' || doc_id || '.jar', NULL, NULL, NULL, true FROM documents WHERE doc_id%10=0""")
def archive_member_listing(spark, sf_dir):
    small_batches(spark)  # both workers of a task hold whole texts
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    zips = docs.mapInPandas(_zipped, "archive string, content binary")
    return archives.list_members(zips).select(
        "archive", "member", "ord", "size", F.col("error").isNotNull().alias("damaged"))


def _archives_in(folder: str):
    """Writes the archive of every document below ``folder``, in a hundred folders; yields their names and sizes."""

    def write(batches):
        store, place = archives.open_store(folder)
        for pdf in batches:
            sizes = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                data = _archive_of(int(doc_id), text, zipfile.ZIP_DEFLATED)
                store.create_dir(f"{place}/{doc_id % 100}", recursive=True)
                with store.open_output_stream(f"{place}/{doc_id % 100}/doc{doc_id}.jar") as file:
                    file.write(data)
                sizes.append(len(data))
            yield pd.DataFrame({"archive": [f"doc{i}.jar" for i in pdf["doc_id"]], "length": sizes})

    return write


@query("archive_discovery", """
WITH d AS (SELECT doc_id, 'doc' || doc_id || '.jar' AS archive, strlen(text) AS n FROM documents),
m AS (SELECT archive, doc_id, n, unnest(range(1, CAST(doc_id%3+2 AS BIGINT))) AS rev FROM d WHERE doc_id%10<>0)
SELECT 'file' AS kind, archive, NULL AS member, NULL AS ord, NULL AS size, true AS fits FROM d
UNION ALL SELECT 'absent root', 'files', NULL, NULL, 0, true
UNION ALL SELECT 'absent root', 'members', NULL, NULL, 0, true
UNION ALL SELECT 'member', archive, 'rev' || lpad(rev::VARCHAR,3,'0') || '/doc' || doc_id || '.nc', CAST(rev-1 AS INTEGER), CAST(n AS BIGINT), true FROM m
UNION ALL SELECT 'member', archive, 'readme.txt', CAST(doc_id%3+1 AS INTEGER), 5, true FROM d WHERE doc_id%10<>0
UNION ALL SELECT 'damaged', archive, NULL, NULL, NULL, true FROM d WHERE doc_id%10=0""")
def archive_discovery(spark, sf_dir):
    """Archives of all documents on disk: found with the length they were written with (``fits``), members listed from
    their tails (``fits``: less than a kilobyte was read of each, however long), damaged ones, and a root that is absent."""
    small_batches(spark)
    root = f"{shared_dir(spark)}/archives-{uuid.uuid4().hex[:12]}"
    written = V.table(spark, sf_dir, "documents").select("doc_id", "text").mapInPandas(_archives_in(root), "archive string, length long")
    ensure_checkpoint_dir(spark)
    written = written.checkpoint(eager=True)
    name = F.substring_index("path", "/", -1)
    files = archives.discover(spark, root).select(name.alias("archive"), F.col("length").alias("found")).join(written, "archive", "left").select(
        F.lit("file").alias("kind"), "archive", F.coalesce(F.col("found") == F.col("length"), F.lit(False)).alias("fits"))
    listed = archives.read_members(spark, root).select(
        F.when(F.col("error").isNull(), "member").otherwise("damaged").alias("kind"), F.substring_index("archive", "/", -1).alias("archive"),
        "member", "ord", "size", (F.col("bytes_read") < 1000).alias("fits"))
    absent = [rows.agg(F.count(F.lit(1)).alias("size")).select(F.lit("absent root").alias("kind"), F.lit(what).alias("archive"), "size", F.lit(True).alias("fits"))
              for what, rows in (("files", archives.discover(spark, f"{root}/nowhere")), ("members", archives.read_members(spark, f"{root}/nowhere")))]
    for part in (files, *absent):
        listed = listed.unionByName(part, allowMissingColumns=True)
    return listed


# -- tracking ---------------------------------------------------------------------
@query("import_monitor", f"""WITH {V.STATE_SQL}
SELECT sonde, count(*) FILTER (date_of_import IS NULL AND note IS NULL) AS to_import,
  count(date_of_import) AS imported, count(note) AS excluded, count(*) AS total FROM st GROUP BY sonde""")
def import_monitor(spark, sf_dir):
    return tracking.monitor(V.tracking_state(spark, sf_dir))


@query("import_rates", f"""WITH {V.STATE_SQL}
SELECT sonde, count(*) AS files, (epoch_us(max(date_of_import))-epoch_us(min(date_of_import)))/1e6 AS seconds,
  round(count(*)/((epoch_us(max(date_of_import))-epoch_us(min(date_of_import)))/1e6),9) AS files_per_second
FROM st WHERE date_of_import IS NOT NULL GROUP BY sonde""")
def import_rates(spark, sf_dir):
    rows = tracking.import_rates(V.tracking_state(spark, sf_dir))
    return rows.withColumn("files_per_second", F.round("files_per_second", 9))


def _candidates(spark, sf_dir):
    """Files found by a new scan: every line's order, under its sonde type."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    lines = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return rows.select(
        F.substring("o_orderpriority", 3, 20).alias("sonde"),
        F.concat(F.lit("file-"), F.col("l_orderkey").cast("string"),
                 F.when(F.col("l_linenumber") > 3, F.lit("")).otherwise(F.lit("b"))).alias("filename"),
    ).distinct()


CANDIDATES = V.STATE_SQL + """,
cd AS (
  SELECT DISTINCT substring(o_orderpriority,3,20) AS sonde, 'file-' || l_orderkey
    || CASE WHEN l_linenumber>3 THEN '' ELSE 'b' END AS filename
  FROM lineitem JOIN orders ON l_orderkey=o_orderkey),
im AS (SELECT sonde, filename FROM st WHERE date_of_import IS NOT NULL)"""


@query("still_to_import", f"WITH {CANDIDATES} SELECT * FROM cd EXCEPT SELECT * FROM im")
def still_to_import(spark, sf_dir):
    return tracking.still_to_import(_candidates(spark, sf_dir), V.tracking_state(spark, sf_dir))


@query("already_imported", f"WITH {CANDIDATES} SELECT * FROM cd INTERSECT SELECT * FROM im")
def already_imported(spark, sf_dir):
    return tracking.already_imported(_candidates(spark, sf_dir), V.tracking_state(spark, sf_dir))


@query("register_new_files", f"""WITH {CANDIDATES}
SELECT sonde, filename, date_of_import, note FROM st
UNION ALL SELECT sonde, filename, NULL, NULL FROM cd WHERE NOT EXISTS (
  SELECT 1 FROM st WHERE st.sonde=cd.sonde AND st.filename=cd.filename)""")
def register_new_files(spark, sf_dir):
    known = V.tracking_state(spark, sf_dir)
    return tracking.with_registered(known, _candidates(spark, sf_dir)).select(
        "sonde", "filename", "date_of_import", "note")


def _events(spark, sf_dir):
    """Tracking events from lineitem: one file per (part, supplier); line number,
    flag and ship date give order and kind of event."""
    kind = (
        F.when(F.col("l_linenumber") == 1, tracking.REGISTERED)
        .when(F.col("l_returnflag") == "A", tracking.IMPORTED)
        .when(F.col("l_returnflag") == "N", tracking.SKIPPED)
        .otherwise(tracking.FAILED)
    )
    return V.table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("sonde"),
        F.concat_ws("-", F.lit("f"), F.col("l_partkey").cast("string")).alias("filename"),
        kind.alias("kind"),
        (F.col("l_orderkey") * F.lit(10_000_000_000) + F.col("l_linenumber").cast("long") * F.lit(1_000_000_000)
         + F.col("l_suppkey")).alias("seq"),
        F.when(kind == tracking.IMPORTED, F.col("l_shipdate").cast("timestamp")).alias("at"),
        F.concat(F.repeat(F.lit("note "), 60), F.col("l_orderkey").cast("string")).alias("text"),
    )


@query("tracking_state", """
WITH e AS (
  SELECT l_linestatus AS sonde, 'f-' || l_partkey AS filename,
    CASE WHEN l_linenumber=1 THEN 'registered' WHEN l_returnflag='A' THEN 'imported' WHEN l_returnflag='N' THEN 'skipped'
      ELSE 'failed' END AS kind,
    l_orderkey*10000000000 + CAST(l_linenumber AS BIGINT)*1000000000 + l_suppkey AS seq, l_shipdate AS done_at,
    repeat('note ',60) || l_orderkey AS text FROM lineitem),
g AS (
  SELECT sonde, filename, max_by(kind, seq) FILTER (kind<>'registered') AS lk, max_by(text, seq) FILTER (kind<>'registered') AS lt,
    max_by(done_at, seq) FILTER (kind='imported') AS iat, max_by(text, seq) FILTER (kind='imported') AS itx,
    max(seq) FILTER (kind='imported') AS i, max(seq) FILTER (kind='failed') AS f FROM e GROUP BY ALL)
SELECT sonde, filename, CASE WHEN i IS NOT NULL AND (f IS NULL OR f<i) THEN iat END AS date_of_import,
  CASE WHEN NOT (i IS NOT NULL AND (f IS NULL OR f<i)) AND lk IN ('skipped','failed') THEN left(lt,255) END AS note,
  CASE WHEN i IS NOT NULL AND (f IS NULL OR f<i) THEN itx END AS detail FROM g""")
def tracking_state(spark, sf_dir):
    return tracking.current_state(_events(spark, sf_dir))


def _survivor_state(spark, sf_dir):
    """A state in which every fourth archive was imported before."""
    parsed = N.parse_archive_names(V.archive_files(spark, sf_dir))
    number = F.regexp_extract("path", r"AI(\d+)", 1).cast("long")
    return parsed.select(
        F.lit("RS41").alias("sonde"), "filename",
        F.when(number % 4 == 0, F.col("modificationTime").cast("timestamp")).alias("date_of_import"),
        F.lit(None).cast("string").alias("note"),
    )


@query("import_plan", f"""WITH {SURVIVORS}
SELECT path, CASE WHEN reason IS NULL AND CAST(regexp_extract(path,'AI(\\d+)',1) AS BIGINT)%4=0 THEN 'File already imported'
  ELSE reason END AS reason,
  CASE WHEN reason IS NULL AND CAST(regexp_extract(path,'AI(\\d+)',1) AS BIGINT)%4<>0 THEN 'import' ELSE 'skip' END AS outcome
FROM sv""")
def import_plan(spark, sf_dir):
    plan = importing.plan_import(V.archive_files(spark, sf_dir), _survivor_state(spark, sf_dir), "RS41")
    return plan.select("path", "reason", "outcome")


@query("import_outcome_counts", f"""WITH {SURVIVORS}
SELECT CASE WHEN reason IS NULL AND CAST(regexp_extract(path,'AI(\\d+)',1) AS BIGINT)%4<>0 THEN 'import' ELSE 'skip' END AS outcome,
  count(*) AS count FROM sv GROUP BY ALL""")
def import_outcome_counts(spark, sf_dir):
    plan = importing.plan_import(V.archive_files(spark, sf_dir), _survivor_state(spark, sf_dir), "RS41")
    return importing.outcome_counts(plan)


# -- sounding verdicts --------------------------------------------------------------
def sounding_attributes(spark, sf_dir):
    """Attributes of one sounding per order, in mixed dialects, some incomplete."""
    rows = V.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    dialect = (
        F.when(k % 13 == 0, F.lit("CF-1.1")).when(k % 3 == 0, F.lit("CF-1.4")).when(k % 3 == 1, F.lit("CF-1.7"))
        .otherwise(F.lit("RS-11G"))
    )
    station = F.when(k % 17 != 0, F.concat(F.lit("NATION_"), (F.col("o_custkey") % 28).cast("string"))).otherwise("")
    stamp = F.when(k % 19 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    old = F.create_map(F.lit("g.General.SiteCode"), station, F.lit("g.Ascent.StandardTime"), stamp)
    new = F.create_map(F.lit("g.Site.Key"), station, F.lit("g.Measurement.StandardTime"), stamp)
    attrs = F.when(k % 3 == 1, new).otherwise(old)
    with_dialect = F.when(k % 23 != 0, F.map_concat(attrs, F.create_map(F.lit("Conventions"), dialect))).otherwise(attrs)
    product = F.create_map(F.lit("g.Product.ID"), k.cast("string"))
    attrs = F.when(k % 29 != 0, F.map_concat(with_dialect, product)).otherwise(with_dialect)
    return rows.select(k.alias("g_product_id"), attrs.alias("attrs"))


def nation_stations(spark, sf_dir):
    return V.table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).alias("id"), F.col("n_name").alias("idstation"), F.lit("NET").alias("network"))


@query("sounding_verdicts", """
WITH c AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_linenumber<>2) AS t FROM lineitem GROUP BY ALL),
a AS (
  SELECT o_orderkey AS g_product_id,
    CASE WHEN o_orderkey%23<>0 THEN CASE WHEN o_orderkey%13=0 THEN 'CF-1.1' WHEN o_orderkey%3=0 THEN 'CF-1.4'
      WHEN o_orderkey%3=1 THEN 'CF-1.7' ELSE 'RS-11G' END END AS conventions,
    CASE WHEN o_orderkey%3=1 THEN 'g.Site.Key' ELSE 'g.General.SiteCode' END AS kn,
    CASE WHEN o_orderkey%17<>0 THEN 'NATION_' || (o_custkey%28) END AS st,
    CASE WHEN o_orderkey%19=0 THEN NULL ELSE o_orderdate END AS ts, o_orderkey%29<>0 AS has_id,
    coalesce(c.n,0) AS n, coalesce(c.t,0) AS t
  FROM orders LEFT JOIN c ON l_orderkey=o_orderkey),
b AS (SELECT a.*, n_nationkey+1 AS pk FROM a LEFT JOIN nation ON n_name=st)
SELECT g_product_id, CASE WHEN n=0 THEN 'No measurement data provided' WHEN t=0 THEN 'No time data found in measurements'
  WHEN conventions IS NULL THEN 'Error converting: missing attribute Conventions'
  WHEN conventions='CF-1.1' THEN 'Unsupported file conventions: CF-1.1'
  WHEN st IS NULL THEN 'Missing station identifier (' || kn || ') in metadata'
  WHEN pk IS NULL THEN 'Station ''' || st || ''' not found in NET station database'
  WHEN ts IS NULL THEN 'Invalid timestamp format for RS41: ''n/a'''
  WHEN NOT has_id THEN 'Error converting: missing attribute g.Product.ID' END AS reason,
  CASE WHEN conventions<>'CF-1.1' THEN pk END AS idstation_pk,
  CASE WHEN conventions<>'CF-1.1' THEN ts END AS report_timestamp
FROM b""")
def sounding_verdicts(spark, sf_dir):
    counts = V.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("g_product_id")).agg(
        F.count(F.lit(1)).alias("n_levels"), F.count_if(F.col("l_linenumber") != 2).alias("n_times"))
    judged = gates.judge_soundings(sounding_attributes(spark, sf_dir), counts, nation_stations(spark, sf_dir),
                                   "NET", "RS41")
    return judged.select("g_product_id", "reason", "idstation_pk", "report_timestamp")


@query("orders_without_lines", """
SELECT o_orderkey AS g_product_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey=o_orderkey)""")
def orders_without_lines(spark, sf_dir):
    headers = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("g_product_id"))
    levels = V.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("g_product_id"))
    return gates.soundings_without_levels(headers, levels)
