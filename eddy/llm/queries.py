"""The training-data queries, one per operator, with their DuckDB SQL where
SQL can express the result. Every query reads its whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline

from . import (conversations, exact_dedup, langid, lm_score, merkle, mixing, ngram_jaccard, packing, secrets, suffix_dedup,
               topk, toxicity, url_filter)

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op3_exact_dedup", exact_dedup.ORACLE)
def op3(spark, d):
    return exact_dedup.exact_dedup(table(spark, d, "documents"))


@register("op9_fair_mix", mixing.ORACLE)
def op9(spark, d):
    return mixing.mix_sizes(table(spark, d, "documents"))


@register("op10_best_fit_packing")
def op10(spark, d):
    return packing.best_fit_pack(table(spark, d, "documents"), packing.contract_tokenizer())


@register("op2_language_id")
def op2(spark, d):
    return langid.predict_language(table(spark, d, "documents"))


@register("op7_url_filter")
def op7(spark, d):
    return url_filter.judge_urls(table(spark, d, "pages"))


@register("op5_secret_scan")
def op5(spark, d):
    return secrets.scan_secrets(table(spark, d, "documents"))


@register("op1_ngram_jaccard")
def op1(spark, d):
    return ngram_jaccard.jaccard_components(table(spark, d, "documents"), counts=True)


@register("op4_exact_topk", topk.ORACLE)
def op4(spark, d):
    return topk.top_inner_products(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op6_suffix_dedup")
def op6(spark, d):
    return suffix_dedup.remove_repeats(table(spark, d, "documents"))


@register("op8_stupid_backoff", lm_score.ORACLE)
def op8(spark, d):
    s = lm_score.stupid_backoff(table(spark, d, "documents"))
    return s.withColumn("score", F.round("score", 6))


@register("op11_merkle_manifest", merkle.ORACLE)
def op11(spark, d):
    return merkle.contract_manifest(table(spark, d, "documents"))


@register("op12_conversation_repair", conversations.ORACLE)
def op12(spark, d):
    return conversations.audit_conversations(table(spark, d, "conversations"))


@register("op13_toxicity")
def op13(spark, d):
    return toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@register("pipeline")
def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)
