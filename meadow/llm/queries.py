"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meadow.llm import (hard_negatives, hash_tree, line_dedup, mixing, pieces, pii, simhash, sketch, sql, token_store, toxicity, vector_codes,
                        vector_graph, warc)
from meadow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(table(spark, sf_dir, "documents"))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), width=3, radius=2)


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprint_report(table(spark, sf_dir, "documents"))


@query
def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read(token_store.write(table(spark, sf_dir, "documents")))


@query
def op5_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_groups(table(spark, sf_dir, "embeddings"), radius=0.9)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), pieces.load())


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), epochs=3.0, share=1.0)
    return plan.select("doc_id", "size", "source_size", "target", "taken", F.col("source"), "whole", "part")


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0).drop("url")


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_groups(table(spark, sf_dir, "documents"), threshold=0.8)


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, positives=5, negatives=3, lowest=50, highest=95)


@query
def op13_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.assignment(table(spark, sf_dir, "documents"), hash_tree.EIGHT)


ORACLE |= {"op11_vector_codes": sql.vector_codes(), "op12_hard_negatives": sql.HARD_NEGATIVES, "op13_hash_tree": sql.hash_tree(hash_tree.EIGHT)}
