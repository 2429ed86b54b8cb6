"""One query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.llm import (
    alignment,
    bpe,
    lexical,
    metric_join,
    mixing,
    ngram_model,
    packing,
    secrets,
    simhash,
    sql,
    toolcalls,
    topk_search,
    toxicity,
    warc,
)
from starsift.llm.common import table


# Schemas of the tools that the conversations' derived calls name.
TOOLS = {
    "measure": {
        "unit": {"type": "string", "required": True, "enum": ["chars", "words"]},
        "value": {"type": "integer", "required": True},
    },
    "note": {"tags": {"type": "array"}, "text": {"type": "string", "required": True}},
    "search": {
        "limit": {"type": "integer"}, "query": {"type": "string", "required": True},
    },
}


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.record_table(warc.page_responses(table(spark, sf_dir, "pages")))


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each assistant turn as a call, each later user turn as the result of the turn before.

    The table has no calls of its own, so tool and arguments follow from the text; some
    arguments break their schema on purpose. Every sixth length of a text makes a call that
    builds on the assistant's next one, and so moves behind it; others build on none.
    """
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", "text", F.coalesce(F.length("text"), F.lit(0)).alias("n"),
        F.coalesce(F.regexp_extract("text", "[A-Za-z]+", 0), F.lit("")).alias("word"),
    )
    kind, n = F.col("n") % 3, F.col("n").cast("string")
    value = F.when(F.col("n") % 5 == 0, F.concat(F.lit('"'), n, F.lit('"'))).otherwise(n)
    unit = F.when(F.col("n") % 4 == 0, "bytes").otherwise("chars")
    search = F.concat(F.lit('{ "query" : "'), "word", F.lit('", "limit" : '), n, F.lit(" }"))
    measure = F.concat(F.lit('{"value":'), value, F.lit(', "unit":"'), unit, F.lit('"}'))
    note = F.concat(
        F.when(F.col("n") % 7 == 0, '{"mood": null, ').otherwise("{"), F.lit('"text": "'), "word",
        F.lit('", "tags": ["b", "a"]'), F.when(F.col("n") % 11 == 0, "").otherwise("}"),
    )
    called = F.concat(F.lit("c"), F.col("turn").cast("string"))
    calls = turns.filter("role = 'assistant'").select(
        "conv_id", "turn", called.alias("call_id"),
        F.when(kind == 0, "search").when(kind == 1, "measure").otherwise("note").alias("name"),
        F.when(kind == 0, search).when(kind == 1, measure).otherwise(note).alias("arguments"),
        F.when(F.col("n") % 6 == 0, F.array(
            F.concat(F.lit("c"), (F.col("turn") + 2).cast("string"))
        )).alias("after"),
    )
    results = turns.filter("role = 'user' AND turn > 0").select(
        "conv_id", "turn", F.concat(F.lit("c"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        F.col("text").alias("content"),
    )
    return toolcalls.link_tool_calls(calls, results, TOOLS)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_documents(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), (5, 2, 1), 1.5, 2.0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), fold=0, sample=20_000)
    return toxicity.score_toxicity(docs, model, fold=0)


def op7_ngram_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_model.score_documents(
        table(spark, sf_dir, "documents"), fold=1, order=2, weight=0.4
    )


def op8_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k_search(
        table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20
    )


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        capacity=4096, closing=1,
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )[0]


QUERIES = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_tool_calls": op2_tool_calls,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_mix_sources": op5_mix_sources,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_automaton": op7_ngram_automaton,
    "op8_bpe_chunk_reuse": op8_bpe_chunk_reuse,
    "op9_secret_scan": op9_secret_scan,
    "op10_top_k_search": op10_top_k_search,
    "op11_lexical_search": op11_lexical_search,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE = {
    "op2_tool_calls": sql.OP2,
    "op5_mix_sources": sql.OP5,
    "op10_top_k_search": sql.OP10,
    "op11_lexical_search": sql.OP11,
}
