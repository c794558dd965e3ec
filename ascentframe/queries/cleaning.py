"""Text, number, time, map and name clean-up over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe.functions import naming, numeric, text, times
from ascentframe.operators import schema
from ascentframe.queries import views as V
from ascentframe.queries.registry import query


@query("one_line_texts", """
SELECT doc_id, replace(text, chr(10), ' ') AS text, length(replace(text, chr(10), ' ')) AS n FROM documents""")
def one_line_texts(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.one_line(F.col("text")).alias("text"),
                       F.length(text.one_line(F.col("text"))).alias("n"))


@query("decoded_texts", """
SELECT conv_id, turn, trim(text) AS text FROM conversations""")
def decoded_texts(spark, sf_dir):
    """Texts framed with NUL characters as bytes, and back."""
    rows = V.table(spark, sf_dir, "conversations")
    raw = F.encode(F.concat(F.lit("\x00 "), "text", F.lit(" \x00\x00")), "UTF-8")
    return rows.select("conv_id", "turn", text.decoded(raw).alias("text"))


_NUM = text.LEADING_NUMBER


def _lead(expr):
    return f"coalesce(TRY_CAST(trim({expr}) AS DOUBLE), TRY_CAST(nullif(regexp_extract(trim({expr}), '{_NUM}', 1),'') AS DOUBLE))"


@query("numbers_in_part_text", f"""
WITH t AS (SELECT p_partkey, p_size || '.75 mm' AS sized, p_brand, ' -' || p_size || 'e2x' AS odd, '' AS blank,
  CAST(p_retailprice AS VARCHAR) AS price FROM part)
SELECT p_partkey, {_lead('sized')} AS sized, CAST(trunc({_lead('sized')}) AS BIGINT) AS sized_int,
  {_lead('p_brand')} AS brand, {_lead('odd')} AS odd, {_lead('blank')} AS blank, {_lead('price')} AS price,
  TRY_CAST(regexp_replace(split_part(p_brand,' ',1),'[^0-9.\\-]','','g') AS DOUBLE) AS annotated,
  TRY_CAST(regexp_replace(split_part(sized,' ',1),'[^0-9.\\-]','','g') AS DOUBLE) AS annotated_size FROM t""")
def numbers_in_part_text(spark, sf_dir):
    part = V.table(spark, sf_dir, "part")
    sized = F.concat(F.col("p_size").cast("string"), F.lit(".75 mm"))
    odd = F.concat(F.lit(" -"), F.col("p_size").cast("string"), F.lit("e2x"))
    return part.select(
        "p_partkey",
        text.numeric_from_text(sized, "real").alias("sized"),
        text.numeric_from_text(sized, "integer").alias("sized_int"),
        text.numeric_from_text(F.col("p_brand"), "real").alias("brand"),
        text.numeric_from_text(odd, "real").alias("odd"),
        text.numeric_from_text(F.lit(""), "real").alias("blank"),
        text.numeric_from_text(F.col("p_retailprice").cast("string"), "real").alias("price"),
        text.annotated_number(F.col("p_brand")).alias("annotated"),
        text.annotated_number(sized).alias("annotated_size"),
    )


@query("numbers_in_event_props", f"""
WITH t AS (SELECT event_id, regexp_extract(props, ': *(.*)}}', 1) AS k FROM events)
SELECT event_id, CAST(trunc({_lead('k')}) AS BIGINT) AS k FROM t""")
def numbers_in_event_props(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    return events.select("event_id", text.numeric_from_text(F.regexp_extract("props", ": *(.*)}", 1), "integer").alias("k"))


@query("first_array_element", """
SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(trunc(embedding[2]*1000) AS BIGINT) AS second_cut FROM embeddings""")
def first_array_element(spark, sf_dir):
    rows = V.table(spark, sf_dir, "embeddings")
    second = F.get("embedding", 1) * F.lit(1000.0).cast("float")
    return rows.select("vec_id", text.first_of(F.col("embedding")).cast("double").alias("first"),
                       text.numeric_from_number(second, "integer").alias("second_cut"))


@query("missing_and_tiny_values", """
SELECT event_id, CASE WHEN event_type='error' THEN NULL WHEN round(value)=value THEN NULL ELSE value END AS filled,
  CASE WHEN abs(value*1e-40)<1.175494351e-38 THEN 0 ELSE value*1e-40 END AS tiny,
  CAST(CAST(value AS FLOAT) AS DOUBLE) AS as_float FROM events""")
def missing_and_tiny_values(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    masked = F.when(F.col("event_type") == "error", F.lit(float("nan"))).when(
        F.round("value") == F.col("value"), F.lit(-999.0)).otherwise(F.col("value"))
    return events.select(
        "event_id",
        numeric.missing_to_null(masked, -999.0).alias("filled"),
        numeric.flush_tiny(F.col("value") * 1e-40).alias("tiny"),
        F.col("value").cast("float").cast("double").alias("as_float"),
    )


@query("timestamps_and_months", """
SELECT o_orderkey, o_orderdate AS parsed, CASE WHEN o_orderkey%3=0 THEN NULL ELSE o_orderdate END AS lenient,
  CAST(epoch(o_orderdate) AS BIGINT) AS epoch, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS shown,
  date_trunc('month', o_orderdate)::TIMESTAMP AS month_from,
  (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::TIMESTAMP AS month_to FROM orders""")
def timestamps_and_months(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    compact = F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss")
    odd = F.when(F.col("o_orderkey") % 3 == 0, F.lit("31/12/1999 noon")).otherwise(F.col("o_orderdate").cast("string"))
    epoch = times.epoch_seconds(F.col("o_orderdate"))
    return orders.select(
        "o_orderkey",
        times.lenient_timestamp(compact).alias("parsed"),
        times.lenient_timestamp(odd).alias("lenient"),
        epoch.alias("epoch"),
        times.epoch_text(epoch).alias("shown"),
        times.month_start(F.col("o_orderdate")).cast("timestamp_ntz").alias("month_from"),
        times.month_end(F.col("o_orderdate")).cast("timestamp_ntz").alias("month_to"),
    )


@query("notes_and_errors", """
SELECT doc_id, left(text,255) AS note, CASE WHEN length(text)>200 THEN left(text,197) || '...' ELSE text END AS error
FROM documents""")
def notes_and_errors(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.note(F.col("text")).alias("note"), text.short_error(F.col("text")).alias("error"))


@query("clean_column_names", """
WITH t AS (SELECT p_partkey, CASE p_partkey%8 WHEN 0 THEN 'Comment' WHEN 1 THEN 'References' WHEN 2 THEN 'group'
  WHEN 3 THEN 'User' WHEN 4 THEN 'DEFAULT' ELSE p_brand || '.' || p_type || '-' || p_name END AS raw FROM part),
c AS (SELECT p_partkey, raw, replace(replace(replace(lower(raw),'.','_'),'-','_'),' ','_') AS plain FROM t)
SELECT p_partkey, raw, CASE plain WHEN 'comment' THEN 'cmt' WHEN 'references' THEN 'refs' WHEN 'group' THEN 'grp'
  WHEN 'user' THEN 'usr' WHEN 'default' THEN 'def' ELSE plain END AS clean FROM c""")
def clean_column_names(spark, sf_dir):
    part = V.table(spark, sf_dir, "part")
    words = F.array(*[F.lit(w) for w in ("Comment", "References", "group", "User", "DEFAULT")])
    built = F.concat("p_brand", F.lit("."), "p_type", F.lit("-"), "p_name")
    raw = F.coalesce(F.get(words, (F.col("p_partkey") % 8).cast("int")), built)
    return part.select("p_partkey", raw.alias("raw"), text.clean_name(raw).alias("clean"))


@query("attribute_maps", """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS product, o_orderstatus AS status, 3 AS keys,
  '{"g.product.id":"' || o_orderkey || '","title":"' || o_orderstatus || '","conventions":"CF-1.7"}' AS json FROM orders""")
def attribute_maps(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    attrs = F.create_map(F.lit("g.Product.ID"), F.col("o_orderkey").cast("string"), F.lit("Title"), F.lit("old"),
                         F.lit("TITLE"), F.col("o_orderstatus"), F.lit("Conventions"), F.lit("CF-1.7"))
    folded = orders.select("o_orderkey", text.lower_keys(attrs).alias("m"))
    return folded.select("o_orderkey", F.col("m")["g.product.id"].alias("product"), F.col("m")["title"].alias("status"),
                         F.size("m").alias("keys"), text.attributes_json(F.col("m")).alias("json"))


@query("typed_attributes", """
SELECT o_orderkey, '{"key":' || o_orderkey || ',"time":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN o_orderkey%3=0 THEN '.000250' ELSE '' END || '","code":"' || o_orderstatus || '"}' AS json FROM orders""")
def typed_attributes(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderkey").alias("key"),
        (F.col("o_orderdate") + F.expr("CASE WHEN o_orderkey % 3 = 0 THEN INTERVAL 0.00025 SECOND ELSE INTERVAL 0 SECOND END"))
        .alias("time"), F.encode("o_orderstatus", "UTF-8").alias("code"))
    return orders.select("o_orderkey", text.typed_attributes_json(orders, ["key", "time", "code"]).alias("json"))


@query("labels_of_codes", """
WITH t AS (SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS code FROM events),
l AS (SELECT event_id, code, CASE code WHEN 73 THEN 'shortwave_radiation' ELSE 'Code ' || code END AS label FROM t)
SELECT event_id, code, label, label || ' (code ' || code || ')' AS display, label AS back FROM l""")
def labels_of_codes(spark, sf_dir):
    from ascentframe.operators.cdm import variable_dim

    code = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    rows = V.table(spark, sf_dir, "events").select("event_id", code.alias("code"))
    rows = rows.join(variable_dim(spark).select("code", "label"), "code", "left")
    label = text.label_or_code(F.col("label"), F.col("code"))
    rows = rows.select("event_id", "code", label.alias("label"))
    shown = rows.withColumn("display", text.label_with_code(F.col("label"), F.col("code")))
    return shown.withColumn("back", text.label_of(F.col("display")))


@query("page_names", r"""
SELECT page_id, split_part(url,'/',-1) AS base, regexp_extract(split_part(url,'/',-1), '^(.+?)(\.[^.]*)?$', 1) AS stem FROM pages""")
def page_names(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    return pages.select("page_id", naming.base_name(F.col("url")).alias("base"), naming.stem(F.col("url")).alias("stem"))


CONTRACT = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("comment", T.StringType()),
        T.StructField("segment_code", T.StringType()),
        T.StructField("balance", T.FloatType()),
        T.StructField("nation_no", T.IntegerType()),
        T.StructField("never_there", T.DoubleType()),
    ]
)


@query("aligned_customers", """
SELECT c_custkey, c_name AS comment, c_mktsegment AS segment_code, CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE) AS balance,
  c_nationkey AS nation_no, CAST(NULL AS DOUBLE) AS never_there FROM customer""")
def aligned_customers(spark, sf_dir):
    """Customers under source spellings, brought to a storage contract."""
    rows = V.table(spark, sf_dir, "customer").select(
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".4 units")).alias("Nation-No"),
        F.col("c_acctbal").cast("string").alias("Balance"),
        F.col("c_mktsegment").alias("Segment.Code"),
        F.col("c_name").alias("Comment"),
        F.col("c_custkey").alias("C_CustKey"),
        F.lit("x").alias("not in the contract"),
    )
    aligned = schema.align_to_contract(rows, CONTRACT).df
    return aligned.withColumn("balance", F.col("balance").cast("double"))


@query("missing_required_variables", """
WITH p AS (SELECT user_id, bool_or(event_type='view') AS v, bool_or(event_type='click' AND value>99) AS c,
  bool_or(event_type='error' AND value>99.5) AS e FROM events GROUP BY user_id)
SELECT user_id, concat_ws(',', CASE WHEN NOT v THEN 'view' END, CASE WHEN NOT c THEN 'click' END,
  CASE WHEN NOT e THEN 'error' END) AS missing FROM p""")
def missing_required_variables(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    counted = (
        F.when(kind == "view", kind)
        .when((kind == "click") & (F.col("value") > 99), kind)
        .when((kind == "error") & (F.col("value") > 99.5), kind)
    )
    present = events.groupBy("user_id").agg(F.collect_set(counted).alias("present"))  # at most three names
    required = F.array(F.lit("view"), F.lit("click"), F.lit("error"))
    missing = schema.missing_required(F.col("present"), required)
    return present.select("user_id", F.array_join(missing, ",").alias("missing"))


_CONTRACTED = {
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                 "c_mktsegment": "string"},
}


@query("header_contract", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{dtype}' AS data_type, count({name}) AS filled FROM {table}"
    for table, fields in _CONTRACTED.items() for name, dtype in fields.items()))
def header_contract(spark, sf_dir):
    """Contract of two stored tables, read from the tables, with the number of
    rows that fill each column."""
    parts = []
    for name in _CONTRACTED:
        rows = V.table(spark, sf_dir, name)
        fields = schema.contract_of(rows).fields
        filled = rows.agg(*[F.count(f.name).alias(f.name) for f in fields])
        entries = F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f.name).alias("filled"))
            for f in fields
        ])
        parts.append(filled.select(F.explode(entries).alias("e")).select("e.*"))
    return parts[0].unionByName(parts[1])
