"""Registered queries of the subpackage: ``QUERIES`` and, where SQL can express them, ``ORACLE``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, chat_format, conversation_repair, decontamination, html_extract, jaccard_join, lm_scoring, prefix_trie, quality_rules, sharding, suffix_dedup, toxicity, url_filters
from .common import table
from .oracle import ORACLE as MORE_ORACLE


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], conversations.schema)
    return chat_format.digests(chat_format.examples(conversations.unionByName(extra)))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_digests(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns)).drop("node")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(conversations), conversations)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sharding": op5_sharding,
    "op6_decontamination": op6_decontamination,
    "op7_chat_format": op7_chat_format,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_html_extract": op10_html_extract,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_toxicity": op12_toxicity,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    **MORE_ORACLE,
    "op1_url_filters": r"""
        with u as (
          select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest from pages
        ), h as (
          select page_id,
            translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
          from u
        ), r as (
          select page_id, host, path, case
            when ('.' || host) like '%.www.example.com' and starts_with(path, '/en/') then 'www.example.com/en/'
            when ('.' || host) like '%.example.com' and starts_with(path, '/en/') then 'example.com/en/'
            when ('.' || host) like '%.net' and starts_with(path, '/es/') then 'net/es/'
            when ('.' || host) like '%.net' and starts_with(path, '/fr/') then 'net/fr/'
            when ('.' || host) like '%.com' and starts_with(path, '/') then 'com/' end as rule
          from h
        )
        select page_id, host, path, rule, case
          when rule in ('www.example.com/en/', 'com/') then 'allow'
          when rule is not null then 'block'
          when ('.' || host) like '%.spam-%' or (host || path) like '%casino%' or ('.' || host) like '%-pills.%' then 'block'
          else 'allow' end as verdict
        from r
    """,
    "op7_chat_format": r"""
        with raw as (
          select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
          union all select -7, 0, 'user', '\### Assistant: </turn> ok'
          union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), t as (
          select *, row_number() over w as pos, count(*) over (partition by conv_id) as n,
            -- <|turn|> role <|text|> text <|end|>, with \ and < escaped as two characters each
            length(role) + length(text) + 8 + 8 + 7
              + 2 * (length(role || text)) - length(replace(role || text, '\', '')) - length(replace(role || text, '<', '')) as chars
          from raw window w as (partition by conv_id order by turn nulls first, role, text)
        ), c as (
          select *, sum(chars) over (partition by conv_id order by pos) as upto from t
        )
        select conv_id, count(*) as n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
          cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
          sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) as loss_sha256,
          cast(sum(upto) filter (role = 'assistant' or pos = n) as bigint) as formatted_chars
        from c group by conv_id
    """,
}
