"""The named queries of this subpackage, and SQL of the same result where SQL can express it."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from tidegate.llm import (
    chat_format, conversation_repair, decontamination, exact_dedup, filter_audit, hash_search, mixing, passage_dedup, segment_sampling, simhash, token_counts, toxicity, url_filter,
)
from tidegate.llm.store import table


def op1_mix_sources(spark, sf_dir):
    mix = mixing.mixed(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"))


def op3_repeated_passages(spark, sf_dir):
    return passage_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op4_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    doc_id = F.regexp_extract(url_filter.host_and_path(F.col("url"))[1], r"^/[^/]+/(\d{1,18})", 1).try_cast("long")
    marks = table(spark, sf_dir, "labels").select("doc_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    labels = pages.select("url", doc_id.alias("doc_id")).join(marks, "doc_id").select("url", "bad")
    return url_filter.judged(pages, labels)


def op5_nearest_vectors(spark, sf_dir):
    return hash_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_simhash_near_dedup(spark, sf_dir):
    return simhash.near_classes(table(spark, sf_dir, "documents"))


def op7_chat_format(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(given.unionByName(more))


def op8_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op9_sampled_segmentations(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return segment_sampling.sampled(table(spark, sf_dir, "documents"), model, k=2)


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_repair(spark, sf_dir):
    return conversation_repair.repairs(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_decontamination(spark, sf_dir):
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES = {
    q.__name__: q
    for q in (
        op1_mix_sources, op2_exact_dedup, op3_repeated_passages, op4_url_filter, op5_nearest_vectors, op6_simhash_near_dedup, op7_chat_format, op8_token_counts,
        op9_sampled_segmentations, op10_toxicity, op11_filter_audit, op12_conversation_repair, op13_decontamination,
    )
}
LLM_QUERIES["pipeline"] = corpus_pipeline.run
LLM_ORACLES = {
    "op2_exact_dedup": exact_dedup.ORACLE_SQL,
    "op7_chat_format": chat_format.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op12_conversation_repair": conversation_repair.ORACLE_SQL,
    "op13_decontamination": decontamination.ORACLE_SQL,
}
