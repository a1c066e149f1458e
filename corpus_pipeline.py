"""The corpus pipeline: toxicity, SimHash near-dedup, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventflow.llm import packing, secrets, simhash, toxicity
from eventflow.llm.common import read, remainder, text_or_empty, written

#: From this score on a document is rejected as toxic.
TOXIC = 0.7
#: What stands for a secret.
MARK = "[SECRET]"


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not toxic. Learned from the labelled documents outside the held-out third."""
    labels = read(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    # a column of the documents may be named like one that the operator adds
    aside = {c: f"__{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    scored = toxicity.score(docs.withColumnsRenamed(aside), model)
    return scored.where(F.col("score") < TOXIC).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document: that with the smallest id, one without id only if no other
    has one, and of those with the same id that whose text has the smallest hash. Of repeated rows one.

    Groups hold ids and hashes. The texts pass through one join, and only those of repeated rows through another.
    """
    digest = F.sha2(text_or_empty("text"), 256).alias("__digest")
    prints = simhash.fingerprints(docs.select("doc_id", text_or_empty("text").alias("text"), digest), words=4)
    marked = written(prints.groupBy("doc_id", "__digest", "fp").agg(F.count("*").alias("rows")), "marked", slim=True)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__digest", "rows")
    groups = simhash.components(marked.select("doc_id", "fp"), radius=4)
    stay = written(marked.join(groups, "fp").groupBy("component").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("__stay"), F.col("first.__digest").alias("__text"), F.col("first.rows").alias("__rows")), "stay", slim=True)
    first = F.col("doc_id").eqNullSafe(F.col("__stay")) & (F.col("__digest") == F.col("__text"))

    def kept(some: DataFrame) -> DataFrame:
        # the side without texts is the one that is held
        return docs.select("*", digest).join(some.hint("shuffle_hash"), first, "left_semi")

    again = stay.where("__rows > 1")
    once = kept(stay.where("__rows = 1"))
    if not again.isEmpty():
        once = once.unionByName(kept(again).dropDuplicates(["doc_id", "__digest"]))
    return once.select(*[f"`{c}`" for c in docs.columns])


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found in their texts replaced by a mark."""
    clean = secrets.scan(docs, secrets.learn(docs), spans="__spans", mark=MARK)
    length = F.when(F.size("__spans") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("simhash near-dedup", without_near_copies),
    ("secret scans", without_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Classifiers, fingerprints and tokenizers have no SQL.
ORACLE_SQL = None
