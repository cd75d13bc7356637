"""Registered queries of the operators, over the whole tables, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_path
from . import archive, decontaminate, lines, minhash, mtree, packing, quality, ranking, runs, secrets, substring, tokencount, warc
from .tokenizer_files import BYTE_LEVEL, PIECES, WORD_LEVEL

WORD_END, BYTE_END = 2, 1  # ids that the contracts put behind each document


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_table(spark, sf_dir, "documents"), PIECES)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents")).drop("removed", "host", "text_key")


def op5_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.shared_passages(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    index = warc.capture_index(warc.read_archives(spark, path))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(_table(spark, sf_dir, "documents"), PIECES)


def op9_token_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "tokens")
    archive.write_token_files(_table(spark, sf_dir, "documents"), path, WORD_LEVEL, WORD_END)
    return archive.token_documents(spark, path)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), BYTE_LEVEL, BYTE_END)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(runs.repeat_tails(_table(spark, sf_dir, "documents")))
    # the longest run, of equal ones the first, then that of the smaller period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    text = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"), F.floor(1000 * F.col("best.n") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.nearest(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_near_duplicates, op2_token_counts, op3_decontamination, op4_quality_rules, op5_shared_passages, op6_line_dedup,
        op7_warc, op8_secret_scan, op9_token_archive, op10_packing, op11_ranked_search, op12_periodic_runs,
        op13_nearest_vectors,
    )}


OP4 = f"""
with d as (
  select doc_id, source, coalesce(text, '') as text from documents
), w as (
  select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as ws from d
), grams as (
  select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from (
    select doc_id, i, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w))
), repeated as (
  select doc_id, count(distinct i + k) as n_repeat_words from grams, (select unnest([0, 1, 2]) as k) where n > 1 group by doc_id
), all_lines as (
  select doc_id, source, text, line, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') as ws
  from (select *, unnest(string_split(text, chr(10))) as line from d)
), lines as (
  select *, translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from all_lines where len(ws) > 0
), dups as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines from lines group by doc_id
), common as (
  select source, norm from lines group by source, norm having count(distinct doc_id) > {quality.MAX_DOCS}
), lost as (
  select l.doc_id, sum(len(l.ws)) as n_lost from lines l
  join common c on c.source is not distinct from l.source and c.norm = l.norm group by l.doc_id
), m as (
  select w.doc_id, cast(len(ws) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
    cast(coalesce(n_lost, 0) as bigint) as n_removed_words
  from w left join repeated using (doc_id) left join dups using (doc_id) left join lost using (doc_id)
), v as (
  select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words as base_failed,
    100 * (n_words - n_removed_words) < {quality.MIN_LEFT} * n_words as depleted from m
)
select *, not base_failed and not depleted as kept from v
"""


UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1 = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[^\\x20\\x09-\\x0D]+') as ws from documents
), s as (
  select distinct doc_id, case when len(ws) < 5 then len(ws) || array_to_string(ws, ' ') else '5' || array_to_string(ws[i:i + 4], ' ') end as g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from w where len(ws) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), links as (
  select p.a, p.b from (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2) p
  join n na on na.doc_id = p.a join n nb on nb.doc_id = p.b where 100 * c >= 75 * (na.n + nb.n - c)
), reach(a, b) as (
  select doc_id, doc_id from documents
  union
  select r.a, l.b from reach r join (select a, b from links union all select b, a from links) l on l.a = r.b
)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, m.component_id, d.doc_id = m.component_id as kept
from documents d left join n on n.doc_id = d.doc_id join (select a, min(b) as component_id from reach group by a) m on m.a = d.doc_id
"""

OP3 = f"""
with iw as (
  select item_id, regexp_extract_all(translate(text, {UPPER_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from benchmark where text is not null
), win as (
  select distinct item_id, width, array_to_string(ws[i:i + width - 1], ' ') as g
  from (select item_id, ws, least(len(ws), 10) as width, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) as i from iw where len(ws) > 0)
), dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents
), probes as (
  select doc_id, width, i, array_to_string(ws[i:i + width - 1], ' ') as g
  from (select doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) as i from dw, (select distinct width from win) where len(ws) >= width)
), hits as (
  select p.doc_id, p.i, p.width, win.item_id from probes p join win on win.width = p.width and win.g = p.g
), covered as (
  select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + width)) as k from hits) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw d left join covered using (doc_id) left join items using (doc_id)
"""

OP7 = f"""
with p as (
  select page_id, url, coalesce(html, '') as payload, sha1(coalesce(html, '')) as sha, lower(coalesce(url, '')) as u,
    {warc.EPOCH} + coalesce(page_id, 0) % 1000000000 as captured from pages
), b as (
  select *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (cast('0x' || substr(sha, 1 + 5 * (k // 4), 5) as bigint) >> (15 - 5 * (k % 4))) % 32, 1)
    for k in range(32)], '') as digest, min(page_id) over (partition by sha) as least_id,
    regexp_extract(u, '(?s)^(?:[a-z][a-z0-9+.-]*:)?(?://(?:[^/?#]*@)?(?:www[0-9]*\\.)?([^/?#:@]*)(?::[0-9]*)?)?([^#]*)', 1) as host,
    regexp_extract(u, '(?s)^(?:[a-z][a-z0-9+.-]*:)?(?://(?:[^/?#]*@)?(?:www[0-9]*\\.)?([^/?#:@]*)(?::[0-9]*)?)?([^#]*)', 2) as rest from p
), k as (
  select *, case when u = '' then '' else array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || case when rest = '' then '/' else rest end end as url_key from b
)
select page_id, cast(octet_length(encode(payload)) as bigint) as payload_bytes, digest as payload_digest,
  case when page_id = least_id then 'response' else 'revisit' end as record_type, case when page_id <> least_id then least_id end as refers_to,
  url_key, cast(captured as bigint) as captured, row_number() over (order by url_key, captured, page_id) - 1 as position
from k
"""


OP11 = f"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ws from documents
), iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ws from benchmark
), q as (
  select item_id, t, count(*) as qf from (select item_id, unnest(ws) as t from iw) group by item_id, t
), c as (
  select count(*) as nn, cast(sum(len(ws)) as bigint) as ll from dw where len(ws) > 0
), tf as (
  select doc_id, t, count(*) as tf from (select doc_id, unnest(ws) as t from dw) group by doc_id, t
), df as (
  select t, count(*) as df from tf group by t
), w as (
  select t, cast(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) as bigint) as w from df, c
), m as (
  select doc_id, 25 + (75 * len(ws) * nn) // ll as m from dw, c where len(ws) > 0
), s as (
  select q.item_id, tf.doc_id, cast(sum(qf * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from q join w using (t) join tf using (t) join m using (doc_id) group by q.item_id, tf.doc_id
)
select item_id, cast(rank as int) as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0
) where rank <= 10
"""


OP13 = f"""
with v as (
  select vec_id, [cast(floor({mtree.SCALE} * cast(x as double)) as bigint) for x in embedding] as v from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum([z[1] * z[2] for z in list_zip(q.v, c.v)]) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % {mtree.EVERY} = 0
)
select query_id, cast(rank as int) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
) where rank <= {mtree.K}
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_near_duplicates": OP1, "op3_decontamination": OP3, "op4_quality_rules": OP4, "op7_warc": OP7, "op11_ranked_search": OP11,
            "op13_nearest_vectors": OP13}
