"""The subpackage's queries: each applies one operator to its whole table and derives digest columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, grammar, langid, lm, neardup, packing, pii, quality, toxicity
from .store import materialize, read_table, shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read_table(spark, sf_dir, "documents"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii.BASE_KINDS]
    further = [count(kind) for kind in pii.KINDS if kind not in pii.BASE_KINDS]
    private = F.size(F.filter("spans", lambda s: s["kind"] != "url")).cast("long").alias("n_private")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), *further, private)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link_documents(read_table(spark, sf_dir, "documents"), words=3, percent=85)


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/inkwell/ids-{uuid.uuid4().hex}"
    grammar.write_ids(read_table(spark, sf_dir, "documents"), folder)
    return grammar.read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    back = chat.parse_chats(materialize(chat.format_chats(rows.unionByName(extra)), "chats"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars")
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step_id")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256)
    return marked.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), "contaminated")


def queries() -> dict[str, Query]:
    own = (op1_quality_rules, op2_pii, op3_near_duplicates, op4_token_ids, op5_language, op6_chat_format, op7_packing, op8_language_model, op9_toxicity, op10_decontamination)
    return {f.__name__: f for f in own}


_OP3 = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (
  select doc_id, unnest(list_distinct(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as g from d),
n as (select doc_id, count(*) as n_shingles from s group by doc_id),
p as (select x.doc_id as a, y.doc_id as b, count(*) as n_both from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * n_both >= 85 * (x.n_shingles + y.n_shingles - n_both)),
u as (select a, b from e union all select b, a from e),
r(a, b) as (select a, b from u union select r.a, u.b from r join u on r.b = u.a)
select d.doc_id, coalesce(n.n_shingles, 0) as n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) as component_id, d.doc_id = least(d.doc_id, coalesce(m.b, d.doc_id)) as kept
from d left join n using (doc_id) left join (select a as doc_id, min(b) as b from r group by a) m using (doc_id)
"""

_OP6 = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
x as (
  select *, length(t) + len(regexp_extract_all(t, '\\|</?turn>|<\||\[/?INST\]')) + coalesce(list_sum(list_transform(regexp_extract_all(t, '#{3,}'), lambda r: length(r) - 2)), 0) as size
  from (select *, unnest([role, text]) as t, unnest([1, 2]) as k from c)),
f as (select conv_id, sum(size)::bigint + 15 * count(*) // 2 as formatted_chars from x group by conv_id)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  length(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256, any_value(formatted_chars) as formatted_chars
from c join f using (conv_id) group by conv_id
"""

_OP10 = r"""
with w as (
  select 'd' as kind, doc_id as id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents
  union all select 'i', item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') from benchmark),
v as (
  select distinct item_id, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') as g
  from (select id as item_id, w, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as pos from w where kind = 'i' and len(w) > 0)),
t as (select doc_id, pos, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') as g
  from (select id as doc_id, w, n, unnest(range(1, greatest(1, len(w) - n + 2))) as pos from w, (select distinct n from v) where kind = 'd')),
o as (select doc_id, pos, v.n, item_id from t join v on t.g = v.g and t.n = v.n),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(pos, pos + n)) as p from o) group by doc_id),
i as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items from (select distinct doc_id, item_id from o) group by doc_id)
select w.id as doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from w left join h on h.doc_id = id left join i on i.doc_id = id where kind = 'd'
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_near_duplicates": _OP3, "op6_chat_format": _OP6, "op10_decontamination": _OP10}
