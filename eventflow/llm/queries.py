"""The registered query of each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventflow.llm import (
    bpe_codec, conversation_trie, decontamination, hard_negatives, lm_scoring, merkle, nn_descent, oracles, packing, secrets,
    sharding, simhash, token_counts, toxicity,
)
from eventflow.llm.common import read, remainder, text_or_empty

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe_codec(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe_codec.encode(read(spark, sf, "documents").select("doc_id", "text"), path)
    decoded = bpe_codec.decode(encoded.select("doc_id", "ids"), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query
def op2_token_counts(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        token_counts.over_limit("n_tokens", 4096).alias("over_limit"),
    )


@query
def op5_packing(spark, sf):
    pieces = packing.pack(read(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


@query
def op8_simhash_near_dedup(spark, sf):
    found = simhash.near_duplicates(read(spark, sf, "documents"), words=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_sharding(spark, sf):
    placed = sharding.shard(read(spark, sf, "documents"), shards=8)
    return placed.select(
        "doc_id",
        (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty()).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_document_fingerprints(spark, sf):
    pairs = merkle.edited_pairs(read(spark, sf, "documents"))
    return pairs.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    )


@query
def op9_secret_scans(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.learn(docs)).select("doc_id", "spans")
    return found.select(
        "doc_id",
        *[secrets.count("spans", kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.listing("spans", secrets.KINDS), 256).alias("base_sha256"),
        secrets.listing("spans").alias("spans"),
    )


@query
def op3_toxicity(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    labels = read(spark, sf, "labels").where(remainder("doc_id", 3) != 1)
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op6_lm_scoring(spark, sf):
    training, tuning = lm_scoring.folds("doc_id")
    return lm_scoring.score(read(spark, sf, "documents"), training, tuning)


@query
def op7_embedding_near_dedup(spark, sf):
    return nn_descent.near_duplicates(read(spark, sf, "embeddings"), threshold=0.93)


@query
def op13_decontamination(spark, sf):
    found = decontamination.decontaminate(read(spark, sf, "documents"), read(spark, sf, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op13_decontamination"] = oracles.DECONTAMINATION


@query
def op12_hard_negatives(spark, sf):
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = read(spark, sf, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.hard_negatives(rows, vec_id % 50 == 0)


ORACLES["op12_hard_negatives"] = oracles.HARD_NEGATIVES


@query
def op11_conversation_trie(spark, sf):
    found = conversation_trie.conversation_trie(read(spark, sf, "conversations"), every=20, most=3)
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


ORACLES["op11_conversation_trie"] = oracles.CONVERSATION_TRIE
