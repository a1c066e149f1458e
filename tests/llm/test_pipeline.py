from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventflow.llm import secrets, simhash
from eventflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_registered(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
        if name == "toxicity":
            gone = before.join(docs, "doc_id", "left_anti").join(labels, "doc_id", "left").groupBy("toxic").count().collect()
            by = {r.toxic: r["count"] for r in gone}
            assert by.get(0, 0) <= 3 and by[1] >= 0.6 * before.join(labels.where("toxic = 1"), "doc_id").count()
        if name == "simhash near-dedup":
            groups = simhash.near_duplicates(before).groupBy("component_id").count()
            assert {r.doc_id for r in docs.collect()} == {r.component_id for r in groups.collect()}
            assert docs.count() == groups.count() < before.count()
        if name == "secret scans":
            assert docs.count() == before.count()
            assert all(not secrets.base_spans(r.text) for r in docs.select("text").collect())
            changed = before.join(docs.withColumnsRenamed({"text": "after"}), "doc_id").where("text != after")
            assert all(secrets.base_spans(r.text) for r in changed.collect())
            assert docs.where(F.col("n_chars") != F.length("text")).count() == before.where(F.col("n_chars") != F.length("text")).count()
        if name == "packing":
            packed = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
            assert len(packed) == before.count() and all(r.n == r.m for r in packed)
        seen.append(docs.count())
    assert corpus_pipeline.run(spark, SF).count() == seen[-1]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows_and_no_rows(spark, odd, odd_rows, nothing, tmp_path, name, stage):
    sf = str(tmp_path)
    rng = random.Random(1)
    spark.createDataFrame([(i, rng.randint(0, 1), i % 2) for i in range(0, 20)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{sf}/labels.parquet")
    got = stage(spark, odd, sf)
    assert stage(spark, nothing, sf).collect() == []
    rows = got.collect()
    if name == "packing":
        assert {r.doc_id for r in rows} == {i for i, *_ in odd_rows}
        return
    assert got.columns == odd.columns
    if name == "secret scans":
        assert len(rows) == len(odd_rows)
    if name == "simhash near-dedup":
        assert len(rows) == len({r.doc_id for r in rows})
        assert {r.doc_id for r in rows} == {r.component_id for r in simhash.near_duplicates(odd).collect()}


def test_each_group_leaves_one_document(spark):
    rng = random.Random(8)

    def text():
        return " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(60))

    one, two, three, four = (text() for _ in range(4))
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(None, one), (None, one), (None, two), (7, three), (7, four), (9, three), (None, four)]
    docs = spark.createDataFrame([tuple({"doc_id": i, "text": t}.get(f.name) for f in schema) for i, t in rows], schema)
    kept = corpus_pipeline.without_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(0, one), (0, two), (7, three), (7, four)])


def test_columns_named_like_results_keep_their_values(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).selectExpr(
        "*", "'mine' AS score", "7 AS passages", "doc_id % 2 AS y", "'f' AS fp", "1 AS component", "doc_id + 1 AS fold")
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows
        for r in rows:
            old = before[r.doc_id].asDict()
            assert {c: v for c, v in r.asDict().items() if c not in ("text", "n_chars")} == {c: v for c, v in old.items() if c not in ("text", "n_chars")}
