"""Registered queries of the corpus operators, each over its whole table, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import align, bpe, fingerprint, html, language, neardup, neighbours, packing, tools, topk, toxicity, urls, variants
from riskmart.llm.shared import table

RULES = [urls.Rule.read(*r) for r in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))]
SCHEMAS = {
    "search": {"query": "string", "turn": "integer"},
    "lookup": {"query": "string", "turn": "?integer"},
    "summarise": {"query": "string", "turn": "integer", "limit": "?integer"},
}

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


@query("op1_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query("op2_language")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op3_topk", """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
)
select query_id, cast(n as int) as "rank", vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as n from scored) where n <= 10
""")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations read as tool use: a user turn calls a tool, the turn after it from the assistant is its result.

    Every call needs the result of the call before it; in each fifth conversation it needs the next one's instead, in each
    thirty-fifth both, which makes cycles. In the conversations five after those, calls come in groups of eight and need the next two of their
    group: a graph without cycles, of eight stages however long the conversation is. Some arguments are left out, of the wrong type, unknown or no JSON at all.
    """
    conv, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
    mark = conv * 7 + turn
    key = lambda n: F.concat(conv.cast("string"), F.lit(":"), n.cast("string"))
    query_, turn_ = text.alias("query"), turn.alias("turn")
    arguments = (
        F.when(mark % 23 == 0, text).when(mark % 11 == 0, F.to_json(F.struct(query_)))
        .when(mark % 13 == 0, F.to_json(F.struct(turn.cast("string").alias("turn"), query_)))
        .when(mark % 19 == 0, F.to_json(F.struct(F.lit(1).alias("zeal"), query_, turn_))).otherwise(F.to_json(F.struct(turn_, query_)))
    )
    kind = conv + turn
    name = F.when(kind % 17 == 0, "browse").when(kind % 3 == 0, "search").when(kind % 3 == 1, "lookup").otherwise("summarise")
    place = F.floor(turn / 2) % 8
    ahead = F.array_compact(F.array(F.when(place < 7, key(turn + 2)), F.when(place < 6, key(turn + 4))))
    needs = F.when(conv % 35 == 0, F.array(key(turn - 2), key(turn + 2))).when(conv % 35 == 5, ahead).when(conv % 5 == 0, F.array(key(turn + 2))).otherwise(F.array(key(turn - 2)))
    calls = conversations.where("role = 'user'").select(
        conv, key(turn).alias("call_id"), turn.alias("position"), name.alias("name"), arguments.alias("arguments"), needs.alias("needs"))
    results = conversations.where("role = 'assistant'").select(conv, key(turn - 1).alias("call_id"), turn.alias("position"), text.alias("content"))
    return calls, results


@query("op4_tool_calls", """
with recursive c as (
  select conv_id, conv_id || ':' || turn as call_id, turn, conv_id * 7 + turn as mark, cast(to_json("text") as varchar) as quoted,
         case when (conv_id + turn) % 17 = 0 then 'browse' when (conv_id + turn) % 3 = 0 then 'search' when (conv_id + turn) % 3 = 1 then 'lookup' else 'summarise' end as name
  from conversations where role = 'user'
), r as (
  select conv_id, conv_id || ':' || (turn - 1) as call_id, turn, cast(to_json("text") as varchar) as quoted from conversations where role = 'assistant'
), edge as (
  select c.conv_id, c.turn, n.turn as needed from c join c n on c.conv_id = n.conv_id
  where (n.turn = c.turn + 2 and c.conv_id % 5 = 0 and (c.conv_id % 35 <> 5 or c.turn // 2 % 8 < 7))
    or (n.turn = c.turn + 4 and c.conv_id % 35 = 5 and c.turn // 2 % 8 < 6) or (n.turn = c.turn - 2 and (c.conv_id % 5 <> 0 or c.conv_id % 35 = 0))
), moved as (select distinct conv_id from edge where needed > turn),
chain as (
  select c.conv_id, c.turn, 0 as stage from c join moved using (conv_id) where not exists (select 1 from edge e where e.conv_id = c.conv_id and e.turn = c.turn)
  union all select e.conv_id, e.turn, chain.stage + 1 from edge e join chain on e.conv_id = chain.conv_id and e.needed = chain.turn
), staged as (select conv_id, turn, max(stage) as stage from chain group by conv_id, turn)
select coalesce(c.conv_id, r.conv_id) as conv_id, coalesce(c.call_id, r.call_id) as call_id, coalesce(c.turn, r.turn) as "position",
  cast(case when m.conv_id is not null and c.call_id is not null then s.stage else 0 end as int) as stage, c.name,
  case when c.call_id is null then 'orphan' when r.call_id is null then 'pending' else 'linked' end as state, cast(0 as bigint) as repeats,
  case when c.call_id is null then null when mark % 23 = 0 then 'malformed' when c.name = 'browse' then 'unknown tool'
       when mark % 11 = 0 then (case when c.name = 'lookup' then (case when m.conv_id is not null and s.stage is null then 'cycle' end) else 'missing turn' end)
       when mark % 13 = 0 then 'type turn' when mark % 19 = 0 then 'extra zeal' when m.conv_id is not null and s.stage is null then 'cycle' end as problem,
  '{"arguments":' || case when c.call_id is null then 'null' when mark % 23 = 0 then c.quoted when mark % 11 = 0 then '{"query":' || c.quoted || '}'
       when mark % 13 = 0 then '{"query":' || c.quoted || ',"turn":"' || c.turn || '"}' when mark % 19 = 0 then '{"query":' || c.quoted || ',"turn":' || c.turn || ',"zeal":1}'
       else '{"query":' || c.quoted || ',"turn":' || c.turn || '}' end
    || ',"id":"' || coalesce(c.call_id, r.call_id) || '","name":' || coalesce('"' || c.name || '"', 'null') || ',"result":' || coalesce(r.quoted, 'null') || '}' as line
from c full join r on c.conv_id = r.conv_id and c.call_id = r.call_id
left join moved m on m.conv_id = c.conv_id left join staged s on s.conv_id = c.conv_id and s.turn = c.turn
""")
def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.link(*calls_and_results(table(spark, sf_dir, "conversations")), SCHEMAS)


@query("op5_urls", r"""
with p as (
  select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from pages
), h as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path from p
), rules as (
  select * from (values ('net', '/', 'block', 1), ('example.net', '/en/', 'allow', 2), ('example.com', '/de/', 'block', 2), ('org', '/fr/', 'allow', 1)) t(place, starts, verdict, labels)
), won as (
  select page_id, max_by(place || starts, labels * 1000 + len(starts)) as rule, max_by(verdict, labels * 1000 + len(starts)) as verdict
  from h join rules on ('.' || host) like ('%.' || place) and starts_with(path, starts) group by page_id
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from h left join won using (page_id)
""")
def judged_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES, default="allow")


@query("op6_near_duplicates", r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents
), s as (
  select doc_id, unnest(list_distinct(case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) end)) as shingle from w
), n as (select doc_id, count(*) as n from s group by doc_id),
both_ as (
  select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), links as (
  select a, b from both_ join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 85 * (x.n + y.n - common)
), near as (select a, b from links union select b, a from links),
reach as (select doc_id as id, doc_id as seen from w union select reach.id, near.b from reach join near on reach.seen = near.a),
least as (select id, min(seen) as component_id from reach group by id)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least.component_id, w.doc_id = least.component_id as kept
from w left join n using (doc_id) join least on least.id = w.doc_id
""")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(table(spark, sf_dir, "documents"), neardup.Rule(words=3, percent=85))


@query("op7_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op8_bpe")
def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op9_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query("op11_alignment")
def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align(table(spark, sf_dir, "documents"), left, right, digest=True).withColumnRenamed("groups", "groups_sha256")


@query("op12_variants", r"""
with recursive checks as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i)) as t
), runs as (
  select doc_id, run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{6,}')) as run from documents)
  group by doc_id, run
), marked as (
  select run, n, xor(list_reduce(
    flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [192 + unicode(c)::bigint // 64, 128 + unicode(c)::bigint % 64] end)),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295) as h
  from runs, checks
), words as (
  select word, cast(sum(n) as bigint) as n
  from (select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from marked)
  where length(word) >= 6 group by word having sum(n) >= 5
), cut as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
), near as (
  select c.word, w.word as other, w.n from cut c join words w on c.rest = w.word
  union select w.word, c.word, c.n from cut c join words w on c.rest = w.word
  union select a.word, b.word, b.n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
), best as (
  select word, count(*) as n_near, min(struct_pack(n := -n, other := other)) as top from near group by word
), judged as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when -top.n >= 5 * w.n then top.other end as form, case when -top.n >= 5 * w.n then -top.n end as form_n
  from words w left join best using (word)
), path as (
  select word, word as at, 0 as steps from judged
  union all select path.word, judged.form, steps + 1 from path join judged on judged.word = path.at where judged.form is not null
)
select word, form, root, n, n_near, form_n
from judged join (select word, max_by("at", steps) as root from path group by word) using (word)
""")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"), letters=6, least=5, factor=5, every=199)


@query("op13_neighbours")
def approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), k=5, every=50)
