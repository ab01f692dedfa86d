"""One query per operator, over its whole table with the operator's own parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.llm.decontam import contaminated
from editflow.llm.embeddings import near_vectors
from editflow.llm.licences import licences, licences_sql
from editflow.llm.merkle import trial
from editflow.llm.minhash import near_copies
from editflow.llm.mixing import mixed
from editflow.llm.perplexity import quality
from editflow.llm.pieces import encoded, load
from editflow.llm.suffix import without_repeats
from editflow.llm.tables import table
from editflow.llm.toolcalls import as_messages, linked_calls
from editflow.llm.toxicity import toxicity
from editflow.llm.warc import archived
from editflow.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archived(table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = linked_calls(as_messages(table(spark, sf_dir, "conversations")))
    return calls.withColumn("result_chars", F.length("result").cast("long")).drop("result")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality(docs, table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trial(table(spark, sf_dir, "documents"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = load(public_tokenizers.path("piece_bpe_32k.model"))
    found = encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    found = (
        op1_near_copies,
        op2_warc,
        op3_tool_calls,
        op4_mixing,
        op5_suffix_dedup,
        op6_licences,
        op7_decontamination,
        op8_quality,
        op9_toxicity,
        op10_near_vectors,
        op11_manifest,
        op12_pieces,
        op13_whitening,
    )
    return {f.__name__: f for f in found}


# Equal payloads of at least 100 bytes: the smallest page_id is the response.
_WARC = """
with p as (
  select page_id, coalesce(html, '') as payload from pages
), d as (
  select page_id, octet_length(encode(payload)) as n, sha256(payload) as digest from p
), f as (
  select digest, min(page_id) as first from d where n >= 100 group by digest
)
select page_id, n as payload_bytes, d.digest as payload_digest,
       case when first is not null and page_id <> first then 'revisit' else 'response' end as record_type,
       case when first is not null and page_id <> first then first end as refers_to
from d left join f on d.digest = f.digest
"""


# Turns of others than the assistant are calls, each after the last one before it; an answer
# belongs to the last call before it, and the first answer of a call is its result.
_TOOL_CALLS = """
with recursive asks as (
  select conv_id, turn, min(coalesce(role, '')) as role, min(coalesce(text, '')) as text
  from conversations
  where conv_id is not null and turn is not null and role is distinct from 'assistant'
  group by conv_id, turn
), before as (
  select * from (select conv_id, turn, lag(turn) over (partition by conv_id order by turn) as named from asks)
  where named is not null
), chain as (
  select conv_id, turn, 0::bigint as level from asks
  where (conv_id, turn) not in (select (conv_id, turn) from before)
  union all
  select b.conv_id, b.turn, c.level + 1 from before b join chain c on b.conv_id = c.conv_id and b.named = c.turn
), answers as (
  select a.conv_id, k.turn as named, min((a.turn, a.text)) as first
  from (select conv_id, turn, min(text) as text from conversations where role = 'assistant' group by conv_id, turn) a
  asof join asks k on a.conv_id = k.conv_id and a.turn > k.turn group by a.conv_id, k.turn
), told as (
  select *, length(text)::bigint as chars,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::bigint as words
  from asks
)
select t.conv_id, t.turn, t.turn::varchar as call_id,
       case when t.role = 'system' then 'configure' else 'reply' end as name,
       c.level,
       '{"chars":' || chars || ',"role":"' || t.role || '","words":' || words || '}' as arguments,
       chars >= 1 and words >= 1 and t.role in ('user', 'system') as valid,
       r.first[1] as result_turn, length(r.first[2])::bigint as result_chars
from told t join chain c using (conv_id, turn)
left join answers r on r.conv_id = t.conv_id and r.named = t.turn
"""


# A tree of runs of 16 per source, one over the sources, and the folds of all paths, level by
# level. CRC-32 comes from its table of 256 remainders, built by eight shifts.
_MANIFEST = """
with recursive crc_steps(i, k, c) as (
  select i, 0, i::bigint from range(256) r(i)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc_steps where k < 8
), crc as (
  select list(c order by i) as t from crc_steps where k = 8
), docs as (
  select doc_id, source, doc_id::varchar as id, lang, n_chars::varchar as n_chars, text,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low
  from documents
), heads as (
  select *, coalesce(strlen(id) || ':' || id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars) || ':' || n_chars, '-') as head,
         coalesce(xor(list_reduce(
           list_prepend(4294967295::bigint, [ascii(x)::bigint for x in string_split(id, '')]),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0, false) as chosen
  from docs, crc
), hashed as (
  select doc_id, coalesce('=' || source, '') as tree, chosen,
         sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
         sha256(head || coalesce(strlen(low) || ':' || low, '-')) as found
  from heads
), leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as lo from hashed
), sizes as (
  select tree, count(*) as n from leaves group by tree
), grown(tree, level, place, n, digest) as (
  select tree, 0, lo, n, leaf from leaves join sizes using (tree)
  union all
  select tree, level + 1, place // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by place))
  from grown where n > 1 group by tree, level, place // 16, n
), subroots as (
  select tree, digest, row_number() over (order by tree) - 1 as lo, count(*) over () as n from grown where n = 1
), top(level, place, n, digest) as (
  select 0, lo, n, digest from subroots
  union all
  select level + 1, place // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by place))
  from top where n > 1 group by level, place // 16, n
), root as (
  select digest from top where n = 1
), inner_sides as (
  select a.tree, a.level, a.place, coalesce(string_agg(b.digest, '' order by b.place) filter (b.place < a.place), '') as l,
         coalesce(string_agg(b.digest, '' order by b.place) filter (b.place > a.place), '') as r
  from grown a join grown b on a.tree = b.tree and a.level = b.level and a.place // 16 = b.place // 16
  where a.n > 1 group by a.tree, a.level, a.place
), outer_sides as (
  select a.level, a.place, coalesce(string_agg(b.digest, '' order by b.place) filter (b.place < a.place), '') as l,
         coalesce(string_agg(b.digest, '' order by b.place) filter (b.place > a.place), '') as r
  from top a join top b on a.level = b.level and a.place // 16 = b.place // 16
  where a.n > 1 group by a.level, a.place
), paths as (
  select d.tree, d.lo, s.level, s.l, s.r from leaves d
  join inner_sides s on s.tree = d.tree and s.place = d.lo >> (4 * s.level)
  union all
  select d.tree, d.lo, 100 + s.level, s.l, s.r from leaves d join subroots t using (tree)
  join outer_sides s on s.place = t.lo >> (4 * s.level)
), joined as (
  select tree, lo, list({'l': l, 'r': r} order by level) as path from paths group by tree, lo
), proven as (
  select d.doc_id, d.leaf, t.digest as subroot, root.digest as root,
         sha256(coalesce(array_to_string([s.l || s.r for s in path], ''), '')) as proof_sha256,
         list_reduce(list_prepend({'l': case when chosen then found else leaf end, 'r': ''}, coalesce(path, [])),
           lambda a, s: {'l': sha256(s.l || a.l || s.r), 'r': ''}).l as folded_root
  from leaves d join subroots t using (tree) cross join root left join joined j on j.tree = d.tree and j.lo = d.lo
)
select *, folded_root = root as verified from proven
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": _WARC,
        "op3_tool_calls": _TOOL_CALLS,
        "op6_licences": licences_sql(),
        "op11_manifest": _MANIFEST,
    }
