"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ascentframe.llm import byte_bpe, chat, decontamination, html_extraction, language_model, lexical_search, quality_classifier, quality_rules, sentencepiece_bpe, simhash, token_files, url_filters, vector_codes
from ascentframe.llm.common import table
from ascentframe.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, twin: str | None = None):
    def register(function):
        QUERIES[name] = function
        if twin:
            TWINS[name] = twin
        return function

    return register


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, table(spark, sf_dir, "labels")).select("doc_id", "judged.*")


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
_SHINGLES_SQL = "list_distinct(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' ')))"

OP4_SQL = f"""
with b as (select item_id, width, {_SHINGLES_SQL} as s from (
  select item_id, w, least(5, len(w)) as width from (select item_id, {_WORDS_SQL} as w from benchmark)) where width > 0),
d as (select doc_id, width, {_SHINGLES_SQL} as s from (select doc_id, {_WORDS_SQL} as w from documents), (select distinct width from b)
  where len(w) >= width),
n as (select doc_id, item_id, count(*) as shared from (select doc_id, width, unnest(s) as x from d)
  join (select item_id, width, unnest(s) as x from b) using (width, x) group by 1, 2)
select doc_id, item_id, len(s)::int as item_shingles, shared::int as shared, shared / len(s)::double as containment
from n join b using (item_id) where shared >= 0.8 * len(s)
"""


@query("op4_decontamination", OP4_SQL)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(table(spark, sf_dir, "documents"), path)


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_files.digests(token_files.read(spark, path))


OP3_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (select *, '<|turn|>' || regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') || '<|body|>'
             || regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') || '<|end|>' as segment from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, segment)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, segment) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(segment))::bigint as formatted_chars, 0 as n_attachments, 0::bigint as expanded_tokens
from e group by conv_id
"""

_SAYS = "'</s>[INST] ok [/INST]'"


@query("op3_chat_formatting", OP3_SQL)
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"select * from values (-7, 0, 'user', {_SAYS}), (-7, 1, 'assistant', {_SAYS}) as t(conv_id, turn, role, text)")
    messages = rows.unionAll(extra).select("conv_id", "turn", "role", F.array(chat.text_part(F.col("text"))).alias("parts"))
    return chat.digests(chat.format_conversations(messages), also=("n_attachments", "expanded_tokens"))


_ESCAPED = r"regexp_replace({}, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')"

CHAT_PARTS_SQL = f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as t, length(coalesce(text, '')) as n from conversations),
e as (select *, left(t, n // 2) as a, substring(t, n // 2 + 1) as b,
    ceil((n % 500 + 1) / 28) * ceil((conv_id % 300) / 28) + 2 as image, ceil(n * 13 / 40) as audio, conv_id % 7 * 256 as pages,
    case when turn % 2 = 1 then '<|audio|>' else '' end || case when turn % 3 = 2 then '<|document|>' else '' end as tail from c),
s as (select *, a || '<|image|>' || b || tail as body, '<|turn|>' || {_ESCAPED.format("role")} || '<|body|>' || {_ESCAPED.format("a")}
    || '<|image|>' || {_ESCAPED.format("b")} || tail || '<|end|>' as segment from e),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, segment) - 1 as place from s),
r as (select conv_id, place, 'image:img-' || turn || ':' || image::bigint || ':' || place
    || case when turn % 2 = 1 then ',audio::' || audio::bigint || ':' || place else '' end
    || case when turn % 3 = 2 then ',document:doc.pdf:' || pages || ':' || place else '' end as refs,
    1 + (turn % 2 = 1)::int + (turn % 3 = 2)::int as n_refs,
    (image + case when turn % 2 = 1 then audio else 0 end + case when turn % 3 = 2 then pages else 0 end)::bigint as tokens from o)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' order by place)) as turns_sha256,
  sum(case when role = 'assistant' then length(body) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(body, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(segment))::bigint as formatted_chars, sum(n_refs)::int as n_attachments, sum(tokens)::bigint as expanded_tokens,
  sha256(string_agg(refs, ',' order by place)) as attachments_sha256
from o join r using (conv_id, place) group by conv_id
"""


@query("chat_typed_parts", CHAT_PARTS_SQL)
def chat_typed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, every message with an image in the middle of its text, some with audio and documents behind."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("t"))
    conv, turn, size = F.col("conv_id"), F.col("turn"), F.length("t")
    half = F.floor(size / 2).cast("int")

    def part(kind: str, ref=None, **sizes):
        kinds = {"width": "int", "height": "int", "millis": "long", "pages": "int"}
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("text"), (F.lit(None) if ref is None else ref).cast("string").alias("ref"),
            *[sizes.get(name, F.lit(None)).cast(k).alias(name) for name, k in kinds.items()])

    parts = F.array(
        chat.text_part(F.substring("t", F.lit(1), half)),
        part("image", F.concat(F.lit("img-"), turn.cast("string")), width=size % 500 + 1, height=conv % 300),
        chat.text_part(F.substring("t", half + 1, size)),
        F.when(turn % 2 == 1, part("audio", millis=size * 13)),
        F.when(turn % 3 == 2, part("document", F.lit("doc.pdf"), pages=conv % 7)),
    )
    messages = rows.select("conv_id", "turn", "role", F.filter(parts, lambda p: p.isNotNull()).alias("parts"))
    return chat.digests(chat.format_conversations(messages), also=("n_attachments", "expanded_tokens", "attachments_sha256"))


OP5_SQL = r"""
with p as (select page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
r as (select * from (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) as t(h, s, v)),
m as (select page_id, host, path, max_by(struct_pack(rule := h || s, v := v), length(h || s)) as best
    from p join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, s) group by all)
select p.page_id, p.host, p.path, m.best.rule as rule,
  coalesce(m.best.v, case when '.' || p.host like '%spam%' or '.' || p.host like '%casino%' or '.' || p.host like '%cheap-pills%'
    or '.' || p.host like '%doubleclick%' or '.' || p.host like '%.ads-%' or '.' || p.host like '%.ads.%'
    or '.' || p.host like '%-ads.%' or p.path like '%/porn/%' or p.path like '%.exe' or p.path like '%wp-login%'
    then 'block' else 'allow' end) as verdict
from p left join (select distinct page_id, host, path, best from m) m on p.page_id = m.page_id and p.host = m.host and p.path = m.path
"""


@query("op5_url_filters", OP5_SQL)
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


@query("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


@query("op11_sentencepiece")
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def _op12_sql(rounds: int = 4) -> str:
    """Codebooks and assignments round by round, over all distances."""
    steps = ["""
kept as materialized (select vec_id, label, list_transform(embedding, lambda v: floor(v::double * 1024)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
parts as materialized (select vec_id, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] as x from kept, range(4) t(p)),
c0 as materialized (select p, row_number() over (partition by p order by vec_id) - 1 as e, x from parts
  where vec_id in (select vec_id from kept order by vec_id limit 256))"""]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} as materialized (select vec_id, p, min(struct_pack(d := d, e := e)) as near from (
  select vec_id, p, e, list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - c.x[i]) * (a.x[i] - c.x[i])))::bigint as d
  from parts a join c{k} c using (p)) group by vec_id, p)""")
        if k < rounds:
            steps.append(f"""
m{k} as materialized (select p, e, list((s - ((s % n) + n) % n) // n order by i) as x from (
  select p, near.e as e, i, sum(x[i])::bigint as s, count(*) as n from a{k} join parts using (vec_id, p), range(1, 1025) t(i)
  where i <= len(x) group by all) group by p, e),
c{k + 1} as materialized (select p, e, coalesce(m.x, c.x) as x from c{k} c left join m{k} m using (p, e))""")
    return f"""with {",".join(steps)},
digest as (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as codebooks_sha256 from c{rounds}),
coded as (select vec_id, string_agg(format('{{:02x}}', near.e), '' order by p) as code, sum(near.d)::bigint as error from a{rounds} group by vec_id)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from coded join kept using (vec_id), digest"""


@query("op12_vector_codes", _op12_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


_TERMS_SQL = r"""select {id}, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from {table}"""

OP13_SQL = f"""
with t as ({_TERMS_SQL.format(id="doc_id", table="documents")}),
q as (select item_id, term, count(*) as times from ({_TERMS_SQL.format(id="item_id", table="benchmark")}) group by all),
n as (select doc_id, count(*) as n from t group by doc_id),
c as (select count(*) as documents, sum(n)::bigint as length from n),
tf as (select doc_id, term, count(*) as tf from t where term in (select term from q) group by all),
w as (select term, floor(1000 * ln((2 * documents + 2)::double / (2 * count(*) + 1)))::bigint as w from tf, c group by term, documents),
s as (select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // length))))::bigint as score
      from q join tf using (term) join w using (term) join n using (doc_id), c group by item_id, doc_id)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from s where score > 0 qualify rank <= 20
"""


@query("op13_lexical_search", OP13_SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
