"""Registered queries of the text operators, over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    chat, crosstok, decontaminate, findings, htmltext, linededup, mixing, neardup, pii, quality, suffixdedup, vectorcodes, warc)

# The shingle width that the query's contract fixes.
CONTRACT_SHINGLE = 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.filter("_spans", _of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.digest("_base"), 256).alias("base_sha256"), pii.digest("_spans").alias("spans"))


def _of_kind(k: int):
    return lambda x: x["k"] == k


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.find_secrets(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive(warc.responses(_table(spark, sf_dir, "pages")))
    return records.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest",
                          "payload_digest", "content_length", F.to_json("headers").alias("headers"), F.decode("block", "UTF-8").alias("content"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=CONTRACT_SHINGLE)


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_deleted").alias("n_deleted"), "text")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, _table(spark, sf_dir, "labels")).select(
        "doc_id", *(F.col("_q")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"), F.col("_rule").alias("rule"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(_table(spark, sf_dir, "conversations"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages"))


def op11_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup(_table(spark, sf_dir, "documents"), digest=True)


def op12_vectorcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vectorcodes.encode(_table(spark, sf_dir, "embeddings"))
    return vectorcodes.with_label_errors(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(coded.books_sha256()).alias("codebooks_sha256"))


def op13_crosstok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.align(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_secrets, op3_warc, op4_decontamination, op5_mixing, op6_neardup, op7_linededup,
                                   op8_quality, op9_chat, op10_html, op11_suffixdedup, op12_vectorcodes, op13_crosstok)}

_OP6 = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w
  from documents),
s as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) end as s
  from w),
x as (select doc_id, len(s) as n, unnest(s) as h from s),
links as (
  select a.doc_id as a, b.doc_id as b from x a join x b on a.h = b.h and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways as (select a, b from links union all select b, a from links),
reach(doc_id, other) as (
  select doc_id, doc_id from s union select r.doc_id, l.b from reach r join both_ways l on r.other = l.a)
select s.doc_id, len(s.s)::bigint as n_shingles, min(r.other) as component_id, s.doc_id = min(r.other) as kept
from s join reach r on s.doc_id = r.doc_id group by s.doc_id, s.s
"""

_OP7 = """
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
w as (
  select doc_id, line, i, row_number() over (partition by doc_id order by i) as pos,
         lead(line) over (partition by doc_id order by i) as next
  from l where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
later as (
  select doc_id, pos, row_number() over (partition by line, next order by doc_id, pos) as copy from w where next is not null),
passages as (
  select doc_id, pos, row_number() over (partition by line order by doc_id, pos) as copy
  from w where len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 5),
gone as (
  select doc_id, pos from later where copy > 1 union select doc_id, pos + 1 from later where copy > 1
  union select doc_id, pos from passages where copy > 1),
marked as (
  select l.doc_id, l.line, l.i, w.pos, g.pos as gone
  from l left join w on l.doc_id = w.doc_id and l.i = w.i left join gone g on w.doc_id = g.doc_id and w.pos = g.pos)
select doc_id, count(pos)::bigint as n_lines, count(gone)::bigint as n_deleted,
       coalesce(string_agg(line, chr(10) order by i) filter (where gone is null), '') as text
from marked group by doc_id
"""

def _op12(rounds: int = vectorcodes.ROUNDS, parts: int = vectorcodes.PARTS, entries: int = vectorcodes.ENTRIES) -> str:
    """One codebook (part, entry, place, x) per round; every part goes to its nearest entry of each."""
    sql = f"""
with k as (
  select vec_id, label, list_transform(embedding, lambda x: floor(x::double * {vectorcodes.SCALE})::bigint) as q,
         row_number() over (order by vec_id, embedding) as r
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
  select vec_id, label, r, u.part, len(q) // {parts} as width, q[u.part * (len(q) // {parts}) + 1:(u.part + 1) * (len(q) // {parts})] as v
  from k, (select unnest(range({parts})) as part) u),
b0 as (select part, r - 1 as entry, v as e from p where r <= {entries})"""
    for i in range(rounds + 1):
        sql += f""",
d{i} as (
  select p.vec_id, p.label, p.r, p.part, p.width, p.v, b.entry,
         list_sum(list_transform(range(1, p.width + 1), lambda j: (p.v[j] - b.e[j]) * (p.v[j] - b.e[j])))::bigint as d
  from p join b{i} b on p.part = b.part),
a{i} as materialized (
  select r, part, any_value(vec_id) as vec_id, any_value(label) as label, any_value(v) as v, any_value(width) as width,
         min(struct_pack(d := d, entry := entry)) as best
  from d{i} group by r, part)"""
        if i < rounds:
            sql += f""",
s{i} as (
  select part, entry, j, sum(x)::bigint as s, count(*)::bigint as c
  from (select part, best.entry as entry, unnest(range(1, width + 1)) as j, unnest(v) as x from a{i}) group by part, entry, j),
m{i} as (
  select part, entry, list((s - ((s % c) + c) % c) // c order by j) as e from s{i} group by part, entry),
b{i + 1} as materialized (
  select b.part, b.entry, coalesce(m.e, b.e) as e from b{i} b left join m{i} m on b.part = m.part and b.entry = m.entry)"""
    return sql + f""",
c as (
  select r, any_value(vec_id) as vec_id, any_value(label) as label, string_agg(lower(printf('%02x', best.entry)), '' order by part) as code,
         sum(best.d)::bigint as error
  from a{rounds} group by r),
h as (select sha256(string_agg(array_to_string(e, ','), ',' order by part, entry)) as h from b{rounds})
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, h as codebooks_sha256 from c, h
"""


SQL = {"op5_mixing": mixing.SQL, "op6_neardup": _OP6, "op7_linededup": _OP7, "op12_vectorcodes": _op12()}
