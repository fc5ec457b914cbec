"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_chunks, decontam, language, licenses, mixing, oracles, prefix_trie, quality, sharding, simhash, token_counts, toxicity, turn_repair, warc
from .common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_chunks.encode_corpus(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")) \
        .withColumnRenamed("id", "doc_id")


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.find_notices(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op2_oracle() -> str:
    """The same votes, spans and labels in DuckDB, with all templates as rows."""
    rows = ", ".join(f"({t}, {p}, {k}, '{g}', {n}, {str(b).lower()}, '{label}')" for k, g, t, p, n, b, label in licenses.template_rows())
    return f"""
with t(tmpl, place, k, gram, len, base, label) as (values {rows}),
d as (select row_number() over () as row, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from documents),
p as (select row, w, unnest(generate_series(1, len(w)::bigint)) as i from d),
g as (select row, i - 1 as pos, unnest([2, 3]) as k, unnest([w[i] || ' ' || w[i + 1], w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]]) as gram from p),
hits as (select row, pos, t.* from g join t using (k, gram)),
diagonals as (select row, tmpl, len, base, label, k, pos - place as diagonal, count(*) as votes, flatten(list(generate_series(place, place + k - 1))) as places
    from hits group by row, tmpl, len, base, label, k, pos - place),
opened as (select *, base and votes = len - k + 1 as whole,
    case when diagonal - lag(diagonal) over (partition by row, tmpl order by diagonal) <= {licenses.DRIFT} then 0 else 1 end as opens from diagonals),
numbered as (select *, sum(opens) over (partition by row, tmpl order by diagonal) as span from opened),
spans as (select row, tmpl, label, count(*) filter (whole) as n, min(diagonal) filter (whole) as lo, max(diagonal) filter (whole) as hi,
    len(list_distinct(flatten(list(places)))) / len as share from numbered group by row, tmpl, label, len, span),
found as (select row, sum(n) as n, min(lo) as lo, max(hi) as hi, list_sort(list_distinct(list(label) filter (n > 0))) as base_labels,
    list_sort(list_distinct(list(label) filter (share >= {licenses.LEAST_COVER}))) as labels, max(share) as score from spans group by row)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_base, lo::bigint as first_word, hi::bigint as last_word,
    coalesce(array_to_string(base_labels, ','), '') as base_labels, coalesce(array_to_string(labels, ','), '') as labels, coalesce(score, 0)::double as score
from d left join found using (row)"""


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"), lambda i: ~held_out(i, 5, 0))
    return toxicity.score_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("toxicity").alias("score"), "predicted", "nearest_ids", "nearest_cosines")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs, lambda i: ~held_out(i, 3, 1))
    return language.identify_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (document, benchmark item found in it)."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontam.find_items(docs, table(spark, folder, "benchmark")) \
        .select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "key")


SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard of every document, and its bytes."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return sharding.place(docs, "doc_id", SHARDS)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.damaged_and_repaired(table(spark, folder, "conversations"))


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, folder)


def llm_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_bpe_chunks, op2_licenses, op3_simhash, op4_quality, op5_toxicity, op6_language, op7_decontamination,
                                    op8_token_counts, op9_warc, op10_sharding, op11_prefix_trie, op12_turn_repair, op13_mixing, pipeline)}


def llm_oracles() -> dict[str, str]:
    return {"op2_licenses": op2_oracle(), "op11_prefix_trie": oracles.trie(), "op12_turn_repair": oracles.repair(), "op13_mixing": oracles.mix()}
