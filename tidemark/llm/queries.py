"""The operators over the given tables, under the contracts of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chosen_path, html_text, langid, merkle, mixing, nce_lm, negatives, packing, quality_crf, rules, secrets, spotsigs, toxicity
from tidemark.llm.common import id_remainder, prepared, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str):
    def keep(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(prepared(spark), sf_dir)
        return build

    return keep


@register("op1_mix_sources")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), whole=False)


@register("op3_pack_sequences")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


SQL["op7_quality_rules"] = rules.SQL


@register("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.split_off(docs), table(spark, sf_dir, "labels"))
    held_out = (id_remainder("doc_id", 5) == 0).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted")


@register("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.split_off(docs))
    held_out = (id_remainder("doc_id", 3) == 1).alias("held_out")
    return langid.predict(docs, model).select("doc_id", held_out, "lang_pred", "score", "accepted")


@register("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_crf.fit(quality_crf.split_off(docs), table(spark, sf_dir, "labels"))
    held_out = (id_remainder("doc_id", 4) == 2).alias("held_out")
    return quality_crf.score(docs, model).select("doc_id", held_out, "score", "predicted")


@register("op5_extract_main_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@register("op8_ngram_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similar(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = lambda spark, sf_dir: corpus_pipeline.run(prepared(spark), sf_dir)
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


@register("op6_document_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited(table(spark, sf_dir, "documents"))


@register("op2_language_model")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts, total, distinct, model = nce_lm.fit(nce_lm.split_off(docs))
    held_out = (id_remainder("doc_id", 7) == 2).alias("held_out")
    return nce_lm.score(docs, counts, total, distinct, model).select(
        "doc_id", held_out, "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


@register("op11_merkle_manifest")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_digests(table(spark, sf_dir, "documents"))


SQL["op11_merkle_manifest"] = merkle.SQL


@register("op12_hard_negatives")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), label=label, anchor=F.col("vec_id") % 50 == 0)


SQL["op12_hard_negatives"] = negatives.SQL


@register("op13_secret_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digests(docs, secrets.fit(docs))
