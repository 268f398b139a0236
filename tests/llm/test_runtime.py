"""Scratch tables: where they go and that they go away."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from timeloom.llm import jaccard, repeats, runtime


def folder(spark) -> str:
    return runtime.shared_dir(spark).removeprefix("file://")


def test_nothing_is_left_of_a_call(spark, docs):
    before = set(os.listdir(folder(spark)))
    with runtime.closing_scratch():
        assert repeats.remove_repeats(docs, runtime.Scratch(spark, "closing")).count() == docs.count()
        assert jaccard.jaccard_components(docs.limit(20), runtime.Scratch(spark, "closing")).count() == 20
        assert len(set(os.listdir(folder(spark))) - before) == 2
    assert set(os.listdir(folder(spark))) == before


def test_shuffle_files_go_with_the_write(spark, scratch):
    before = spark.conf.get(runtime.CLEANUP)
    rows = scratch.save(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert rows.count() == 7 and spark.conf.get(runtime.CLEANUP) == before


def test_a_cluster_needs_a_shared_folder():
    def session(master, found=None):
        conf = SimpleNamespace(get=lambda *_: found, set=lambda *_: None)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runtime.shared_dir(session("spark://host:7077"))
    assert runtime.shared_dir(session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    assert runtime.shared_dir(session("local[2]")).startswith("file://")


def test_batches_are_bounded_in_bytes_and_whole(spark):
    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    before = spark.conf.get(runtime.BATCH)
    try:
        spark.conf.unset(runtime.BATCH)
        runtime.Scratch(spark, "batches")
        texts = spark.range(0, 8000, 1, 1).select(F.repeat(F.lit("0123456789"), 300).alias("text"))
        found = texts.mapInArrow(runtime.returning(sizes), "n long, size long").collect()
        assert sum(r["n"] for r in found) == 8000 and max(r["size"] for r in found) <= 1.1 * runtime.BATCH_BYTES
        spark.conf.set(runtime.BATCH, "1m")  # less than that stays
        runtime.Scratch(spark, "batches")
        assert spark.conf.get(runtime.BATCH) in ("1m", "1048576b")
    finally:
        spark.conf.set(runtime.BATCH, before)
