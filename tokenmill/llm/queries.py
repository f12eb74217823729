"""Registered queries of the corpus operators, with production parameters on whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, cover_tree, decontaminate, hard_negatives, html_text, language_id, lm_scoring, mixing, sharding, simhash, spelling, url_rules, warc
from .common import ascii_lower, table


def op1_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, d, "documents"))


def op2_sharding(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    placed = sharding.assign_shards(docs, sharding.document_key(F.col("doc_id"), F.col("text")))
    return placed.select("doc_id", "slot", "shard")


def op3_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return language_id.identify_languages(docs).select("doc_id", "held_out", "lang_pred", "score")


def op4_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op6_warc_revisits(spark: SparkSession, d: str) -> DataFrame:
    records = warc.captures_of_pages(table(spark, d, "pages"))
    out = warc.resolve_revisits(records, payload=("digest", "n_chars"))
    listed = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return out.select("record_id", warc.canonical_url(F.col("url")).alias("canonical"), "status", "refers_to", "outcome",
                      "digest", F.col("n_chars").cast("long").alias("n_chars"), listed.alias("headers"))


def op7_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages, labels = table(spark, d, "pages"), table(spark, d, "labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labelled = pages.select("page_id", "url").join(
        labels.select("doc_id", bad.alias("bad")), F.col("page_id") == F.col("doc_id")).select("url", "bad")
    return url_rules.judge_urls(pages.select("page_id", "url"), labelled).select(
        "page_id", "host", "path", "rule", "verdict", "confidence")


def op8_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"))


def op9_html_text(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extract_text(table(spark, d, "pages"))


def op10_top_k(spark: SparkSession, d: str) -> DataFrame:
    return cover_tree.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    runs = F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(r"[a-z\u00C0-\u00FF]+"), F.lit(0)))
    found = table(spark, d, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    missed = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return spelling.group_variants(found.select(F.when(h % 97 == 0, missed).otherwise(F.col("run")).alias("word")))


def op12_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers  # the vocabulary files; only this query needs them

    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode(table(spark, d, "documents"), ranks, public_tokenizers.PATTERN)
    digests = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), digests.alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine_negatives(table(spark, d, "embeddings"), vec_id % 100 == 0, moved)


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_sharding": op2_sharding,
    "op3_language_id": op3_language_id,
    "op4_mixing": op4_mixing,
    "op5_decontamination": op5_decontamination,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_url_filter": op7_url_filter,
    "op8_simhash": op8_simhash,
    "op9_html_text": op9_html_text,
    "op10_top_k": op10_top_k,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_hard_negatives": op13_hard_negatives,
}
