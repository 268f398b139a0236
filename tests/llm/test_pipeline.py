"""The pipeline's stages on the smallest tables."""

from __future__ import annotations

import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from timeloom.llm import mixing

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "private_data", "mixing", "packing"]
    clean = stages["toxicity"](spark, docs, SF).cache()
    assert 0 < clean.count() < docs.count() and clean.columns == docs.columns
    single = stages["near_copies"](spark, clean, SF).cache()
    assert 0 < single.count() < clean.count() and single.count() == single.select("doc_id").distinct().count()
    private = stages["private_data"](spark, single, SF).cache()
    assert private.count() == single.count() and private.filter("text like '%[EMAIL]%'").count()
    mixed = stages["mixing"](spark, private, SF).cache()
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() <= private.count()
    packed = stages["packing"](spark, mixed, SF)
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()


@pytest.fixture
def folder(spark, docs, tmp_path):
    """The tables that a run reads, from texts with nulls, blanks, long ones, ties, repeated rows and clashing columns."""
    wide = docs.withColumn("n_chars", F.length("text").cast("long")).select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    wide.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)] + [(None, 1), (3, None), (999, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


CLASHES = ("score", "predicted", "_text", "_row", "_id", "component_id", "_print", "pii_spans", "_epoch", "epochs", "part", "taken", "piece", "length", "_length", "sequence_id", "offset", "ids")


@pytest.mark.parametrize("rows", [None, 0])
def test_stages_on_odd_texts(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs if rows is None else docs.limit(rows)
    total = docs.count()
    words = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in df.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, folder)
        assert made.columns == list(corpus_pipeline.COLUMNS)
        again = made.collect()
        assert sorted(map(str, again)) == sorted(map(str, stage(spark, docs, folder).collect()))
        if name == "near_copies" and rows is None:
            found, before = (Counter(r.doc_id for r in x.select("doc_id").collect()) for x in (made, docs))
            assert found[None] == before[None] > 0 and max(n for d, n in found.items() if d is not None) == 1
            assert {d for d in (400, 401, 406, 407) if d in before} <= set(found) <= set(before)
        if name == "private_data":
            assert len(again) == docs.count()
        if name == "mixing" and rows is None:
            assert words(made) == sum(r.taken for r in mixing.mix_sources(docs).collect())
        docs = made
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(packed.columns)
    assert packed.filter("piece = 0").count() == docs.count() and (total > 0) == (packed.count() > 0)


def test_toxic_rows_go_and_others_stay(spark, tmp_path):
    data = [(i, ("grobian " if i % 3 == 0 else "stone ") + " ".join(f"w{i * j % 17}" for j in range(30)), "en", "a", 9) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    left = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()}
    assert left == {i for i in range(400) if i % 3}


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(rows.columns) and rows.count()
