"""Removing passages that repeat across documents (operator 2): seed and extend.

Seeds: the smallest hash of the short word runs inside each window of WINDOW
words (winnowing), so that two equal windows always have the same seed. Seeds
found in one document only are dropped by a group count and a join.

Extension: around a seed that is left, the windows that share it form a run.
A run is extended to the words left and right that its windows can reach, and
runs that agree over all of it form a class: every run of a class repeats the
class's first document. Only one run of each class is compared window by window
with the other classes of its seed, so no pairs of documents are made, however
many share a passage. Overlapping repeated windows join into maximal passages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm import textops
from timeloom.llm.runtime import Scratch

WINDOW = 50
SEED_WORDS = 12
#: Windows of a run, so that a run's answer fits the bits of a long. One seed lies in at most
#: WINDOW - SEED_WORDS + 1 = 39 windows, so only a text that repeats a seed within itself has
#: longer runs; these are cut, and every part is a run of its own with its own class and answer.
RUN_WINDOWS = 60


def _seeds(block: textops.WordBlock, window: int, seed_words: int) -> np.ndarray:
    """The seed of each window, those that cross a text's border included."""
    grams = textops.window_hashes(block.hashes, seed_words)
    return textops.sliding(grams, window - seed_words + 1)


def seed_table(docs: DataFrame, window: int, seed_words: int) -> DataFrame:
    """Rows with seed for each change of seed in a text, and one row without for each text: n_words, sha256 of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints, texts = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False), batch.column(1)
            number = ids.to_numpy(zero_copy_only=False) if not ids.null_count else ids.fill_null(-1).to_numpy(zero_copy_only=False)
            known = np.asarray(ids.is_valid())
            for block in textops.word_blocks(texts):
                here = slice(block.first_row, block.first_row + block.n_rows)
                shas = [hashlib.sha256(b" ".join(t.as_py().encode().split()) if t.is_valid else b"").hexdigest() for t in texts[here]]
                n = block.n_rows
                yield pa.record_batch([ids[here], pa.array(prints[here]), pa.nulls(n, pa.int64()), pa.array(np.diff(block.bounds)), pa.array(shas)], names=["doc_id", "print", "seed", "n_words", "sha"])
                whole = textops.whole_windows(block.bounds, window, len(block.hashes))
                if not whole.any():
                    continue
                at = np.flatnonzero(whole)
                rows = block.row_of_word()[at]
                seeds = _seeds(block, window, seed_words)[at]
                new = np.ones(len(at), bool)
                new[1:] = (seeds[1:] != seeds[:-1]) | (rows[1:] != rows[:-1])
                new &= known[here][rows]
                rows, seeds = rows[new] + block.first_row, seeds[new]
                m = len(rows)
                yield pa.record_batch([pa.array(number[rows], pa.int64()), pa.array(prints[rows]), pa.array(textops.signed(seeds)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.string())], names=["doc_id", "print", "seed", "n_words", "sha"])

    return docs.mapInArrow(run, "doc_id long, print long, seed long, n_words long, sha string")


def run_table(hit: DataFrame, window: int, seed_words: int) -> DataFrame:
    """(doc_id, print, seed, context, n, first, windows) for each run of windows with a seed among the document's seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            wanted = batch.column(3)
            for block in textops.word_blocks(batch.column(1)):
                seeds = _seeds(block, window, seed_words)
                whole = textops.window_hashes(block.hashes, window)
                begins, counts, rows = [], [], []
                for i in range(block.n_rows):
                    lo, hi = int(block.bounds[i]), int(block.bounds[i + 1]) - window + 1
                    if hi <= lo:
                        continue
                    own = textops.signed(seeds[lo:hi])
                    at = np.flatnonzero(np.isin(own, wanted[block.first_row + i].values.to_numpy()))
                    if not len(at):
                        continue
                    new = np.ones(len(at), bool)
                    new[1:] = (at[1:] != at[:-1] + 1) | (own[at[1:]] != own[at[:-1]])
                    head = np.flatnonzero(new)
                    size = np.diff(np.append(head, len(at)))
                    for _ in range(int((size.max() - 1) // RUN_WINDOWS) + 1):  # long runs, in parts
                        begins.append(at[head] + lo)
                        counts.append(np.minimum(size, RUN_WINDOWS))
                        rows.append(np.full(len(head), i))
                        more = size > RUN_WINDOWS
                        head, size = head[more] + RUN_WINDOWS, size[more] - RUN_WINDOWS
                if not begins:
                    continue
                begin, count, row = (np.concatenate(x) for x in (begins, counts, rows))
                context = textops.range_hashes(block.hashes, begin, begin + count - 1 + window)
                offsets = np.concatenate(([0], np.cumsum(count)))
                each = np.repeat(begin - offsets[:-1], count) + np.arange(offsets[-1])
                row_at = row + block.first_row
                yield pa.record_batch(
                    [
                        pa.array(ids[row_at], pa.int64()), pa.array(prints[row_at], pa.int64()), pa.array(textops.signed(seeds[begin])), pa.array(textops.signed(context)), pa.array(count.astype(np.int32)),
                        pa.array((begin - block.bounds[row]).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(textops.signed(whole[each]))),
                    ],
                    names=["doc_id", "print", "seed", "context", "n", "first", "windows"],
                )

    return hit.mapInArrow(run, "doc_id long, print long, seed long, context long, n int, first long, windows array<long>")


def _removed(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, print, n_removed, text, passages) from texts with runs (first, n, mask); text: the words that stay, joined by one space; passages: (first word, words) of each maximal repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [])
            for text, runs in zip(batch.column(1), batch.column(3), strict=True):
                words = text.as_py().encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                for r in runs.as_py():
                    hit = np.flatnonzero(np.array([r["mask"] >> i & 1 for i in range(r["n"])])) + r["first"]
                    np.add.at(change, hit, 1)
                    np.add.at(change, hit + window, -1)
                stay = np.cumsum(change[:-1]) == 0
                out[0].append(len(words) - int(stay.sum()))
                out[1].append(b" ".join(compress(words, stay)).decode())
                ends = np.flatnonzero(np.diff(np.concatenate(([True], stay, [True])).astype(np.int8)))
                out[2].append([{"first": int(lo), "words": int(hi - lo)} for lo, hi in ends.reshape(-1, 2)])
            passages = pa.array(out[2], pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())])))
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), passages], names=["doc_id", "print", "n_removed", "text", "passages"])

    return texts.mapInArrow(run, "doc_id long, print long, n_removed long, text string, passages array<struct<first:long,words:long>>")


def repeated_runs(docs: DataFrame, scratch: Scratch, window: int = WINDOW, seed_words: int = SEED_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(seed table, texts with a seed found elsewhere, runs per such text that an earlier document has)."""
    seeds = scratch.save(seed_table(docs, window, seed_words), "seeds")
    own = seeds.filter(F.col("seed").isNotNull()).select("seed", "doc_id", "print")
    shared = own.groupBy("seed").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("seed")
    shared = scratch.save(shared, "shared")
    mine = own.join(shared, "seed", "left_semi").groupBy("doc_id", "print").agg(F.collect_set("seed").alias("seeds"))
    hit = scratch.save(docs.join(mine, ["doc_id", "print"]).select("doc_id", "text", "print", "seeds"), "hit")
    scratch.drop("shared")

    runs = run_table(hit, window, seed_words)
    slim = scratch.save(runs.drop("windows"), "runs")
    classes = scratch.save(slim.groupBy("seed", "context", "n").agg(F.min("doc_id").alias("leader")), "classes")
    several = classes.groupBy("seed").agg(F.min("context").alias("lo"), F.max("context").alias("hi"), F.min("n").alias("n_lo"), F.max("n").alias("n_hi")).filter("lo < hi or n_lo < n_hi").select("seed")
    rivals = classes.join(scratch.save(several, "several"), "seed", "left_semi")
    led = runs.withColumnRenamed("doc_id", "leader").join(rivals, ["seed", "context", "n", "leader"]).select("seed", "context", "n", "leader", F.posexplode("windows").alias("at", "window"))
    led = scratch.save(led, "led")
    first = led.groupBy("seed", "window").agg(F.min("leader").alias("earliest"), F.max("leader").alias("latest")).filter("earliest < latest").drop("latest")
    first = scratch.save(first, "first")
    bits = led.join(first, ["seed", "window"]).filter("earliest < leader").groupBy("seed", "context", "n").agg(F.expr("bit_or(shiftleft(1L, at))").alias("bits"))
    classes = scratch.save(classes.join(bits, ["seed", "context", "n"], "left"), "answers")
    scratch.drop("led", "first", "several")

    mask = F.when(F.col("doc_id") > F.col("leader"), F.expr("shiftleft(1L, n) - 1")).otherwise(F.coalesce(F.col("bits"), F.lit(0)))
    found = slim.join(classes, ["seed", "context", "n"]).withColumn("mask", mask).filter("mask != 0")
    found = found.groupBy("doc_id", "print").agg(F.collect_set(F.struct("first", "n", "mask")).alias("runs"))
    return seeds, hit, found


def remove_repeats(docs: DataFrame, scratch: Scratch, window: int = WINDOW, seed_words: int = SEED_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, text, passages for each row of docs.

    A word goes if a window of ``window`` words that covers it also starts in a
    document with a smaller doc_id. text: the words that stay, joined by one
    space, or null where all stay. passages: the maximal repeats that go, as (first
    word, words), or null where there are none; two that touch are one. Equal rows get equal results and don't remove
    each other; a row without doc_id loses nothing and removes nothing; null and
    empty texts have no words. Windows are equal when two 64-bit hashes are.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("print", F.xxhash64("text")).select("doc_id", "text", "print")
    seeds, hit, found = repeated_runs(docs, scratch, window, seed_words)
    texts = hit.join(found, ["doc_id", "print"]).select("doc_id", "text", "print", "runs")
    cut = _removed(texts, window).withColumn("kept_sha256", F.sha2("text", 256)).dropDuplicates(["doc_id", "print"])
    whole = seeds.filter(F.col("seed").isNull()).select("doc_id", "print", "n_words", "sha")
    out = whole.join(cut, ["doc_id", "print"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "text", "passages")
