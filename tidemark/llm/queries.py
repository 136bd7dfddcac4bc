"""Registered queries of the training-data operators, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    curve_packing,
    filter_audit,
    hnsw,
    host_reputation,
    kneser_ney,
    piece_codec,
    quality_rules,
    record_files,
    rendezvous,
    simhash,
    spelling_groups,
    warc,
)
from tidemark.llm.common import ship_package
from tidemark.llm.host_reputation import UrlRule


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(_table(spark, sf_dir, "embeddings"), least=0.95)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rendezvous.assign_shards(_table(spark, sf_dir, "documents"), weights=[1.0] * 8, grown=[1.0] * 9)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archive(_table(spark, sf_dir, "pages"))
    return rows.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kneser_ney.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "lang", "n", "perplexity", "threshold", "kept")


#: Rules of the contract.
URL_RULES = [
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document of its number: good if it is of quality and not toxic."""
    good = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).when(F.col("quality").isNotNull(), 0)
    outcomes = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), good.alias("good"))
    return host_reputation.judge_urls(_table(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded and decoded again: token count and checksum of the ids, and checksum of the decoded text."""
    rows = piece_codec.decode(piece_codec.encode(_table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.crc32("text").alias("text_crc32"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_components(_table(spark, sf_dir, "documents"), width=3, distance=3)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curve_packing.pack(_table(spark, sf_dir, "documents"), length=2048, end_id=1)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = record_files.write_and_read(_table(spark, sf_dir, "documents"), end_id=1)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_groups(_table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded and decoded again: token count, digest of the ids and digest of the decoded bytes."""
    rows = byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_sharding": op3_sharding,
    "op4_warc": op4_warc,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_url_filter": op6_url_filter,
    "op7_pieces": op7_pieces,
    "op8_simhash": op8_simhash,
    "op9_packing": op9_packing,
    "op10_records": op10_records,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_byte_bpe": op13_byte_bpe,
}

#: DuckDB SQL for the rows of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": """
        with d as (
            select row_number() over () as k, doc_id, coalesce(text, '') as t,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws
            from documents
        ), windows as (
            select k, i, array_to_string(list_slice(ws, i, i + 4), ' ') as w
            from (select k, ws, unnest(range(1, len(ws) - 3)) as i from d where len(ws) >= 5)
        ), many as (select k, w from windows group by k, w having count(*) > 1),
        covered as (select k, count(distinct i + o) as n from windows join many using (k, w), range(5) r(o) group by k),
        lines as (select k, unnest(string_split(t, chr(10))) as line from d),
        l as (select k, count(*) as n_lines, count(*) - count(distinct line) as n_dup from lines where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by k),
        f as (
            select k, doc_id, t, len(ws)::bigint as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
                (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
                coalesce(n_dup, 0)::bigint as n_dup_lines, coalesce(n_lines, 0) as n_lines, coalesce(covered.n, 0)::bigint as n_repeat_words,
                length(regexp_replace(t, '[^A-Za-z\\x{80}-\\x{10FFFF}]', '', 'g')) as letters,
                length(regexp_replace(t, '[^A-Z]', '', 'g')) as upper, length(regexp_replace(t, '[^a-z]', '', 'g')) as lower,
                len(regexp_extract_all(t, '[!?.]{2,}')) as shouts
            from d left join l using (k) left join covered using (k)
        ), b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from f)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            not base_failed and word_chars between 2 * n_words and 20 * n_words and 100 * n_symbols <= 30 * n_words
            and 100 * n_dup_lines <= 70 * n_lines and 100 * letters >= 40 * word_chars
            and not (upper + lower >= 50 and 10 * upper > 6 * (upper + lower)) and 100 * shouts <= 15 * n_words as kept
        from b
    """,
    "op11_filter_audit": """
        with t as (
            select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
                regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents
        ), l as (
            select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id
        ), d as (
            select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
                case when len(ws) < 50 then 'A' else '' end || case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 'B' else '' end
                || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end
                || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
                || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as f
            from t left join l using (doc_id)
        ), c as (select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from d group by part, f),
        x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
        o as (
            select a.x || b.x || c.x || d.x || e.x as filter_order from x a, x b, x c, x d, x e
            where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), s as (
            select c.*, filter_order, step, contains(f, filter_order[step]) as hit,
                len(list_filter(string_split(left(filter_order, step - 1), ''), lambda y: y <> '' and contains(f, y))) = 0 as here
            from c, o, (select unnest([1, 2, 3, 4, 5])::int as step)
        )
        select part, filter_order, step, sum(case when here and not hit then n else 0 end)::bigint as kept,
            sum(case when here and hit then n else 0 end)::bigint as removed, sum(case when hit and not here then n else 0 end)::bigint as redundant,
            sum(case when hit and length(f) = 1 then n else 0 end)::bigint as unique_fails,
            sum(case when here and hit then good else 0 end)::bigint as good_lost, sum(case when here and hit then toxic else 0 end)::bigint as toxic_lost,
            sum(sum(case when here and hit then n else 0 end)) over (partition by part, filter_order[step])::bigint as shapley
        from s group by part, filter_order, step
    """,
    "op4_warc": """
        with p as (
            select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as k, sha1(coalesce(html, '')) as digest from pages
        ), w as (select k, n, max(page_id) as w from p where n >= 1000 group by k, n)
        select page_id, n::bigint as payload_bytes, digest as payload_digest,
            case when w is null or w = page_id then 'response' else 'revisit' end as record_type,
            case when w <> page_id then w end as refers_to
        from p left join w using (k, n)
    """,
    "op6_url_filter": """
        with p as (
            select page_id,
                coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
                coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
            from pages
        ), l as (
            select doc_id, min(case when quality = 1 and coalesce(toxic, 0) = 0 then 1 when quality is not null then 0 end) as good
            from labels where doc_id is not null group by doc_id
        ), h as (
            select host, count(good) as n, coalesce(sum(good), 0) as good,
                array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain, string_split(host, '.')[-1] as suffix
            from p left join l on doc_id = page_id group by host
        ), d as (select domain, suffix, sum(n) as n, sum(good) as good from h group by all),
        s as (select suffix, sum(n) as n, sum(good) as good from d group by all),
        g as (select (sum(good) + 1.0) / (sum(n) + 2.0) as prior from s),
        m as (
            select unit, count(*)::double as m, sum(n)::double as pages, sum(good)::double as good, sum(n::double * n) as nn, sum(good::double * good / n) as gg
            from (select 's' as unit, n, good from s union all select 'd', n, good from d union all select 'h', n, good from h)
            where n > 0 group by unit
        ), r as (
            select *, good / pages * (1 - good / pages) as within, pages - nn / pages - (m - 1) as spare, gg - good * good / pages as spread from m
        ), k0 as (
            select unit, case when m > 1 and good > 0 and good < pages and spare > 0 and spread > within * (m - 1)
                then (spread - within * (m - 1)) / (within * spare) end as rho from r
        ), k as (
            select u.unit, case when rho > 0 then greatest(1.0, least(10000.0, (1 - rho) / rho)) else 10000.0 end as k
            from (values ('s'), ('d'), ('h')) u(unit) left join k0 using (unit)
        ), sm as (select suffix, (good + k * prior) / (n + k) as mean from s, g, k where unit = 's'),
        dm as (select domain, (good + k * mean) / (n + k) as mean from d join sm using (suffix), k where unit = 'd'),
        ab as (select host, good + k * mean as a, n - good + k * (1 - mean) as b from h join dm using (domain), k where unit = 'h'),
        bounds as (select host, a / (a + b) + 1.645 * sqrt(a * b / (a + b) / (a + b) / (a + b + 1)) as bound from ab),
        j as (
            select page_id, host, path, bound, case
                when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
                when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
                when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
                when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
                when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
            from p join bounds using (host)
        )
        select page_id, host, path, rule, case
            when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
            when bound < 0.5 then 'block' else 'allow' end as verdict
        from j
    """,
}
