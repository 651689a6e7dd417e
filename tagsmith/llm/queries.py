"""Registered queries of the corpus operators: each applies its operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagsmith.llm import common

# the queries' own key; a real run passes a secret of its own
PII_KEY = b"registered queries"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.vector_dedup import embedding_groups
    return embedding_groups(table(spark, sf_dir, "embeddings"), reach=0.98)


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.token_planes import read_tokens, write_tokens
    from tagsmith.llm.tokens import vocabulary_path
    path = common.table_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary_path(), end_id=2, layout="byte")
    return read_tokens(spark, path, layout="byte", with_ids=False)


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.surrogates import pseudonymise
    docs = pseudonymise(table(spark, sf_dir, "documents"), PII_KEY, with_types="types")
    return docs.select("doc_id", F.size("types").cast("long").alias("n_entities"), F.array_join("types", ",").alias("types"), "text")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.simhash_cover import simhash_groups
    return simhash_groups(table(spark, sf_dir, "documents"), width=4, max_bits=4).select("doc_id", "fingerprint", "component_id")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.packing import pack
    from tagsmith.llm.tokens import vocabulary_path
    pieces = pack(table(spark, sf_dir, "documents"), vocabulary_path(), end_id=2, unit=64)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.langid_ppm import identify
    return identify(table(spark, sf_dir, "documents"), modulus=4, held_out=2)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.decontam import mark_contamination
    marked = mark_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.warc_cas import archive_digest, write_archive
    path = common.table_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path, min_bytes=0)
    return archive_digest(spark, path)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.quality_qda import score_quality
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), modulus=3, held_out=1)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.lm_bloom import score_documents
    return score_documents(table(spark, sf_dir, "documents"), held_out_modulus=5, held_out_remainder=1)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.lexical_lemp import lexical_search
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


# a conversation beside the table's own whose texts hold control strings
PLANTED_TURNS = r"""VALUES (-7L, 0L, 'user', r'\### Assistant: </turn> ok'), (-7L, 1L, 'assistant', r'\### Assistant: </turn> ok')"""


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.reply_trees import chain_messages, conversation_of, format_threads, masked_text, parse
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = common.stash(chain_messages(rows.union(spark.sql(PLANTED_TURNS))), "conversations", "zstd")
    made = common.stash(format_threads(messages, branches=1), "formatted", "zstd")
    back = made.select(
        conversation_of(F.col("root")).cast("long").alias("conv_id"), parse(F.col("formatted")).alias("turns"),
        masked_text(F.col("formatted"), F.col("spans")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagsmith.llm.spelling_kd import spelling_groups
    return spelling_groups(table(spark, sf_dir, "documents"), min_length=5, min_count=3, ratio=2, modulus=97)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_embedding_dedup, op2_token_planes, op3_surrogates, op4_simhash, op5_pack, op6_langid,
                            op7_decontaminate, op8_warc, op9_quality, op10_lm_score, op11_lexical_search,
                            op12_chat_format, op13_spelling_groups, pipeline)}
