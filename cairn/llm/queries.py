"""The operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import (
    chat,
    decontaminate,
    embeddings,
    jaccard,
    language,
    line_dedup,
    packing,
    personal,
    quality,
    resample,
    sharding,
    suffixes,
    turn_trie,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CONTROL = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # conversation -1 as two literal rows
    said = F.array(*(F.struct(F.lit(-1).alias("conv_id"), F.lit(k).alias("turn"), F.lit(role).alias("role"), F.lit(CONTROL).alias("text"))
                     for k, role in enumerate(("user", "assistant"))))
    own = spark.range(1).select(F.inline(said)).select(*(F.col(f.name).cast(f.dataType) for f in rows.schema.fields))
    turns = rows.unionByName(own).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    read = chat.format_chats(turns).withColumn("_turns", chat.parse_chat(F.col("formatted"))).withColumn(
        "_loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    lines = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return read.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), digest(lines).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"), digest(F.col("_loss")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_dedup(table(spark, sf_dir, "embeddings"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), RANKS)


def op5_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents")).withColumn("grown_shard", F.lit(None).cast("int"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), held_out_fold=2)
    held_out = F.coalesce(quality.crc_fold(F.col("doc_id")) == 2, F.lit(False))
    return quality.score_quality(docs, model, "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.coalesce(quality.crc_fold(F.col("doc_id")), F.lit(0))
    model = language.fit_languages(docs.where(fold != 2))
    return language.predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "ambiguous")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = F.array_sort("_items")
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return decontaminate.mark_documents(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", F.col("_words").alias("n_words"), hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(items, ","), "UTF-8"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    counts = (F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in personal.BASE_KINDS)  # noqa: B023
    return personal.tag_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(F.encode(personal.span_text(base), "UTF-8"), 256).alias("base_sha256"), personal.span_text(F.col("spans")).alias("spans"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.prefix_nodes(turn_trie.rebuilt_sequences(table(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_chat_format, op3_embedding_near_dedup, op4_best_fit_packing, op5_ring_sharding, op6_quality, op7_language,
    op8_decontamination, op9_suffix_dedup, op10_jaccard_join, op11_personal_data, op12_resample, op13_prefix_trie, pipeline)}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
REACH = """
reach as (
  select {node} as node, {node} as low from {nodes}
  union
  select e.b, r.low from reach r join edges e on e.a = r.node where r.low < e.b)
"""

# the CRC-32 of a text: a table of 256 entries from its rule, then a step per byte
CRC_TABLE = """
crc_table as (select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k:
                case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as t)"""


def crc_sql(text: str) -> str:
    """CRC-32 of ``text``, where ``t`` of ``crc_table`` is in scope."""
    byte = f"('0x' || substr(hex(encode({text})), (2 * i + 1)::int, 2))::bigint"
    return (f"xor(list_reduce(list_transform(range(octet_length(encode({text}))), lambda i: {byte}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)")


ORACLE = {
    "op1_line_dedup": """
with parts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (select doc_id, unnest(ls) as line, unnest(range(len(ls))) as pos from parts),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
common as (select k, max(doc_id) as keeper from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
marked as (select keyed.*, coalesce(doc_id <> keeper, false) as gone from keyed left join common using (k))
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id""",
    "op2_chat_format": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, 23 + length(role) + length(text)
    + 1 * (length(role || text) - length(replace(role || text, '\', '')))
    + (select sum(((length(role) - length(replace(role, c, ''))) + (length(text) - length(replace(text, c, '')))) // length(c))
       from (values ('<|'), ('</s>'), ('<s>'), ('[INST]'), ('[/INST]')) as v(c)) as written
  from turns)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(written)::bigint as formatted_chars
from sized group by conv_id""",
    "op3_embedding_near_dedup": """
with recursive good as (
  select vec_id, embedding::double[] as v from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
edges as (select p.vec_id as a, q.vec_id as b from good p join good q on p.vec_id <> q.vec_id
          where list_cosine_similarity(p.v, q.v) >= 0.9),"""
    + REACH.format(node="vec_id", nodes="embeddings") + """,
least as (select node, min(low) as component_id from reach group by node),
links as (select a, count(*) as n from edges group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings join least on node = vec_id left join links on a = vec_id""",
    "op8_decontamination": f"""
with docs as (select doc_id, {WORDS} as ws from documents),
items as (select item_id, ws, least(10, len(ws)) as n from (select item_id, {WORDS} as ws from benchmark) where len(ws) > 0),
windows as (select item_id, n, array_to_string(list_slice(ws, i + 1, i + n), ' ') as w
            from (select *, unnest(range(len(ws) - n + 1)) as i from items)),
sizes as (select distinct n from windows),
places as (select doc_id, n, i, array_to_string(list_slice(ws, i + 1, i + n), ' ') as w
           from (select doc_id, ws, n, unnest(range(len(ws) - n + 1)) as i from docs, sizes where len(ws) >= n)),
found as (select distinct doc_id, i, p.n, item_id from places p join windows v on p.w = v.w and p.n = v.n),
hits as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from found) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
          from (select distinct doc_id, item_id from found) group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (doc_id) left join named using (doc_id)""",
    "op9_suffix_dedup": f"""
with docs as (select doc_id, {WORDS} as ws from documents),
windows as (select doc_id, i, md5(array_to_string(list_slice(ws, i + 1, i + 50), ' ')) as h
            from (select doc_id, ws, unnest(range(len(ws) - 49)) as i from docs where len(ws) >= 50)),
repeated as (select doc_id, i from windows join (select h from windows group by h having count(*) > 1) using (h)),
breaks as (select *, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as fresh from repeated),
runs as (select *, sum(fresh) over (partition by doc_id order by i) as run from breaks)
select doc_id, min(i)::bigint as start, (max(i) + 50 - min(i))::bigint as n_words from runs group by doc_id, run""",
    "op10_jaccard_join": f"""
with recursive docs as (select doc_id, {WORDS} as ws from documents),
runs as (select distinct doc_id, array_to_string(list_slice(ws, i + 1, i + 5), ' ') as s
         from (select doc_id, ws, unnest(range(greatest(len(ws) - 4, 1))) as i from docs where len(ws) > 0)),
sizes as (select doc_id, count(*) as n from runs group by doc_id),
shared as (select p.doc_id as a, q.doc_id as b, count(*) as c from runs p join runs q on p.s = q.s and p.doc_id <> q.doc_id group by all),
edges as (select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where c >= 0.8 * (x.n + y.n - c)),"""
    + REACH.format(node="doc_id", nodes="documents") + """,
least as (select node, min(low) as class_id from reach group by node),
links as (select a, count(*) as n from edges group by a)
select doc_id, class_id, coalesce(n, 0)::bigint as n_links, doc_id = class_id as kept
from documents join least on node = doc_id left join links on a = doc_id""",
    "op12_resample": f"""
with {CRC_TABLE.strip()},
docs as (select doc_id, {WORDS} as ws from documents),
items as (select {WORDS} as ws from benchmark),
vocabulary as (select w, {crc_sql('w')} % 10000 as k
               from (select distinct unnest(ws) as w from docs union select distinct unnest(ws) from items), crc_table),
have as (select k, count(*) as s from (select unnest(ws) as w from docs) join vocabulary using (w) group by k),
want as (select k, count(*) as t from (select unnest(ws) as w from items) join vocabulary using (w) group by k),
totals as (select (select coalesce(sum(s), 0) from have)::double as S_, (select coalesce(sum(t), 0) from want)::double as T_),
gains as (select k, floor(1000 * ln((coalesce(t, 0)::double + 1) * (S_ + 10000) / ((s::double + 1) * (T_ + 10000)))) as gain
          from have left join want using (k), totals),
weighed as (select doc_id, sum(gain)::bigint as total, count(*) as n
            from (select doc_id, unnest(ws) as w from docs) join vocabulary using (w) join gains using (k) group by doc_id),
scored as (select doc_id, len(ws)::bigint as n_features,
                  -- floor division of whole numbers, downwards
                  coalesce((total - ((total % n + n) % n)) // n, 0)::bigint as weight, ('0x' || left(sha256('2024:' || doc_id), 8))::bigint as h
           from docs left join weighed using (doc_id)),
noisy as (select doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))))::bigint as score from scored),
placed as (select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
                  count(*) filter (where n_features >= 20) over () as able from noisy)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= 10 * able // 100 then place end as rank from placed""",
    "op13_prefix_trie": rf"""
with {CRC_TABLE.strip()},
said as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
named as (select conv_id, turn, md5(length(role) || ':' || role || text) as id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::bigint as w from said),
own as (select conv_id, list({{'id': id, 'w': w}} order by turn nulls first, id) as ts from named group by conv_id),
heads as (select own.*, ({crc_sql('conv_id::varchar')} % 4)::int as h from own, crc_table),
rebuilt as (select c.conv_id, case when b.ts is null then [] else b.ts[1:h] end || c.ts[h + 1:] as ts
            from heads c left join own b on b.conv_id = c.conv_id - c.conv_id % 20),
paths as (select conv_id, d, array_to_string(list_transform(ts[1:d], lambda x: x.id), '') as p,
                 case when d > 0 then array_to_string(list_transform(ts[1:d - 1], lambda x: x.id), '') end as above,
                 case when d > 0 then ts[d].w else 0 end as w, d = len(ts) as ending
          from (select *, unnest(range(len(ts) + 1)) as d from rebuilt)),
nodes as (select d, p, any_value(above) as above, min(conv_id) as conv_id, count(*) as n_convs, any_value(w) as w,
                 sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ending), '')) as ends_sha256
          from paths group by d, p),
families as (select above as p, count(*) as n_children from nodes where d > 0 group by above),
below as (select paths.d, paths.p, count(*) filter (where n_children is null) as n_leaves, sum((n.n_convs - 1) * n.w)::bigint as saved_tokens
          from nodes n left join families on families.p = n.p join paths on paths.conv_id = n.conv_id and paths.d <= n.d
          group by paths.d, paths.p)
select n.conv_id, n.d::bigint as depth, parent.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0)::bigint as n_children, n_leaves, saved_tokens, n.ends_sha256
from nodes n join below using (d, p) left join families on families.p = n.p left join nodes parent on parent.d = n.d - 1 and parent.p = n.above""",
}
