"""Queries of the numbered operators over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import (
    byte_bpe,
    filter_audit,
    html_text,
    language_id,
    packing,
    quality,
    repeated_passages,
    resampling,
    sharding,
    url_filter,
)
from quarryline.llm.embedding_dedup import near_duplicates
from quarryline.llm.simhash import simhash_components
from quarryline.llm.topk_search import top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register the decorated function under a name."""

    def decorate(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return decorate


@query("op1_embedding_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.9 or more between all embeddings, counted, with components."""
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes decoded from them, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


# The rules of the url filter.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

# Links of a page's markup to itself under other urls, then everything reachable by them.
URL_SQL = r"""
with recursive parts as (
    select page_id, url, html,
      case when contains(url, '://') then regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) else '' end as raw_host,
      case when contains(url, '://') then regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) else '' end as path
    from pages
),
named as (
    select page_id, html, url, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path
    from parts
),
rules(rule_host, rule_path, ruled) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
tags as (
    select url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\s[^>]*>')) as tag from pages
),
links as (
    select distinct regexp_replace(url, '(?s)#.*$', '') as a,
      regexp_replace(case when regexp_matches(tag, '(?is)\srel\s*=\s*["'']?canonical') then regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1)
           else regexp_extract(tag, '(?is)\scontent\s*=\s*["'']?\s*[0-9.]*\s*[;,]\s*(?:url\s*=\s*)?["'']?([^"''\s>]+)', 1) end, '(?s)#.*$', '') as b
    from tags
    where regexp_matches(tag, '(?is)\srel\s*=\s*["'']?canonical') or regexp_matches(tag, '(?is)\shttp-equiv\s*=\s*["'']?refresh')
),
both_ways as (select a, b from links union select b, a from links),
reach(a, b) as (select a, b from both_ways union select r.a, w.b from reach r join both_ways w on r.b = w.a),
places as (
    select n as node, regexp_extract(n, '(?s)^.*?://([^/?#]*)', 1) as host, regexp_extract(n, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
    from (select distinct b as n from reach)
),
place_rules as (
    select node, arg_max(ruled, length(rule_host || rule_path)) as ruled
    from places join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by node
),
inherited as (
    select a as node, bool_or(ruled = 'block') and not bool_or(ruled = 'allow') as blocks
    from reach join place_rules on b = node group by a
),
best as (
    select n.page_id, n.url, n.host, n.path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
      arg_max(ruled, length(rule_host || rule_path)) as ruled
    from named n left join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by all
)
select page_id, host, path, rule, coalesce(ruled, case when blocks then 'block' end, 'allow') as verdict
from best left join inherited on node = regexp_replace(url, '(?s)#.*$', '')
"""


@query("op3_url_filters", URL_SQL.replace(r"\\", "\\"))
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page url, by rule or by its aliases."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.url_verdicts(_table(spark, sf_dir, "pages"), rules)


TOP_K_SQL = """
with sized as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id as vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
    from sized q join sized c on q.vec_id != c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0
),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query("op4_exact_top_k", TOP_K_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best matches of every fiftieth vector by integer inner product."""
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    documents = _table(spark, sf_dir, "documents")
    return language_id.predict(documents, language_id.train(documents))


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins for all documents; equal texts and equal sources never share one."""
    return packing.best_fit(_table(spark, sf_dir, "documents"))


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels that are not held out."""
    documents = _table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, _table(spark, sf_dir, "labels")))


SHARD_SQL = """
with addressed as (
    select doc_id, coalesce(strlen(text), 0) as bytes, ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 11))::bigint as address
    from documents
),
nodes as (
    select depth, address >> (44 - depth)::bigint as prefix, sum(bytes) as bytes, count(*) as n
    from addressed, (select unnest(range(0, 45)) as depth) group by all
),
shards as (
    select c.* from nodes c left join nodes p on p.depth = c.depth - 1 and p.prefix = c.prefix >> 1
    where (c.bytes <= 1048576 or c.n <= 1) and (p.depth is null or not (p.bytes <= 1048576 or p.n <= 1))
)
select doc_id, case when depth = 0 then '' else lpad(bin(prefix), depth::int, '0') end as shard, depth::int as depth,
  s.bytes::bigint as shard_bytes, s.n::bigint as shard_rows
from addressed a join shards s on s.prefix = a.address >> (44 - s.depth)::bigint
"""


@query("op8_extendible_sharding", SHARD_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    return sharding.assign(_table(spark, sf_dir, "documents"))


@query("op9_html_extraction")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash_components(_table(spark, sf_dir, "documents"))


# The CRC-32 of distinct words is folded bit by bit over their bytes.
RESAMPLING_SQL = r"""
with words as (
    select 'd' as side, doc_id as id, rowid_ as r, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
    from (select doc_id, text, row_number() over () as rowid_ from documents)
    union all
    select 't', null, null, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
    from benchmark
),
tallied as (select side, id, r, word, count(*) as n from words group by all),
coded as (
    select word, list_reduce(
        list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::bigint, 2))::bigint),
        lambda c, b: list_reduce(range(0, 8),
            lambda s, k: case when s & 1 = 1 then xor(s >> 1, 3988292384) else s >> 1 end, xor(c, b)),
        4294967295::bigint) as state
    from (select distinct word from tallied)
),
bucketed as (select side, id, r, xor(state, 4294967295) % 10000 as bucket, n from tallied join coded using (word)),
sizes as (
    select bucket, coalesce(sum(n) filter (side = 'd'), 0)::double as s, coalesce(sum(n) filter (side = 't'), 0)::double as t
    from bucketed group by bucket
),
totals as (select sum(s) as s_all, sum(t) as t_all from sizes),
gained as (
    select bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::bigint as gain from sizes, totals
),
weighed as (
    select r, sum(n)::bigint as n, floor(sum(n * gain)::double / sum(n))::bigint as weight
    from bucketed join gained using (bucket) where side = 'd' group by r
),
scored as (
    select doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
      coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint
        + 0.5::double) / 4294967296::double)))::bigint as score
    from (select doc_id, row_number() over () as r from documents) left join weighed using (r)
),
placed as (
    select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last)::bigint as place,
      count(*) filter (n_features >= 20) over () as able
    from scored
)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= able * 10 // 100 then place end as rank from placed
"""


@query("op11_importance_resampling", RESAMPLING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn for their likeness to the benchmark texts."""
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# Every order is played out step by step; the Shapley counts are summed over the orders.
AUDIT_SQL = r"""
with worded as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
),
flags as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
failing as (
    select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
      (case when len(words) < 200 then 'A' else '' end)
      || (case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end)
      || (case when 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(text) then 'C' else '' end)
      || (case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end)
      || (case when doc_id > min(doc_id) over (partition by text)
               or doc_id is null and min(doc_id) over (partition by text) is not null then 'E' else '' end) as fails
    from worded left join flags using (doc_id)
),
kinds as (select part, fails, good, toxic, count(*) as n from failing group by all),
letters(letter) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
    select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order
    from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
),
steps as (
    select part, filter_order, step::int as step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as earlier
    from (select distinct part from kinds), orders, (select unnest(range(1, 6)) as step)
),
judged as (
    select s.part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) as hit,
      translate(fails, earlier, '') != fails as gone
    from steps s join kinds k on k.part = s.part
),
counted as (
    select part, filter_order, step, own,
      coalesce(sum(n) filter (not gone and not hit), 0)::bigint as kept,
      coalesce(sum(n) filter (not gone and hit), 0)::bigint as removed,
      coalesce(sum(n) filter (gone and hit), 0)::bigint as redundant,
      coalesce(sum(n) filter (fails = own), 0)::bigint as unique_fails,
      coalesce(sum(n) filter (not gone and hit and good), 0)::bigint as good_lost,
      coalesce(sum(n) filter (not gone and hit and toxic), 0)::bigint as toxic_lost
    from judged group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley
from counted
"""


@query("op12_filter_interaction_audit", AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove alone and together, by source and order."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


PASSAGES_SQL = r"""
with worded as (
    select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
),
windows as (
    select r, spot, sha256(array_to_string(list_slice(words, spot, spot + 34), ' ')) as code
    from (select r, words, unnest(range(1, len(words) - 33)) as spot from worded)
),
again as (select r, spot from windows where code in (select code from windows group by code having count(*) > 1)),
placed as (select r, doc_id, unnest(words) as word, generate_subscripts(words, 1) as spot from worded),
covered as (select distinct r, unnest(range(spot, spot + 35)) as spot from again),
rest as (
    select p.r, count(c.r)::bigint as n_removed, coalesce(string_agg(word, ' ' order by p.spot) filter (c.r is null), '') as kept
    from placed p left join covered c on c.r = p.r and c.spot = p.spot group by p.r
)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from worded left join rest using (r)
"""


@query("op13_substring_dedup", PASSAGES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words and more that occur again."""
    done = repeated_passages.without_repeats(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
