"""Mixing sources to target weights (operator 3).

Documents of a source stand in the order of a hash of their id. That order is
dealt into key ranges, as many as the number of rows asks for, whose token sums give each range its starting
point (a distributed prefix sum); within a range a running sum gives each
document's. A source's budget then cuts that order at an exact word: whole
epochs first, and the rest from the front of the order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.llm.runtime import Scratch

#: Rows of a source that share a key range.
RANGE_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(spark, sizes: DataFrame, weights: tuple[int, ...], most_epochs: int, scratch: Scratch) -> DataFrame:
    """(_source, _source_size, _target) from one row per source; any number of sources.

    Weights repeat over the sources in code point order, null last. Each source
    gets its share of all words by weight, but most_epochs times its size at
    most; what is cut off is shared out again until none is above.
    """
    # The rank of a source: its place in its sorted partition, after all earlier partitions.
    order = sizes.orderBy(F.col("_source").asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id())
    order = scratch.save(order.withColumn("_part", F.shiftright("_at", 33)), "sources")
    parts = order.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition of a sort, so a number that the session sets.
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_skip"))
    rank = F.col("_skip") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    order = order.join(parts, "_part").select("_source", "_source_size", weight.alias("_weight"))
    order = scratch.save(order, "weighted")

    cap = F.lit(most_epochs) * F.col("_source_size")
    total = order.agg(F.sum("_source_size")).first()[0] or 0
    level, seen = 0.0, None
    while True:  # the level rises each time; it stays when no source is above its cap: a few steps over one row per source
        above = cap.cast("double") < F.lit(level) * F.col("_weight")
        now = order.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("_weight")))).first()
        now = (now[0] or 0, now[1] or 0)
        if now == seen or not now[1]:
            break
        level, seen = (total - now[0]) / now[1], now
    target = F.when(cap.cast("double") < F.lit(level) * F.col("_weight"), cap.cast("double")).otherwise(F.lit(level) * F.col("_weight"))
    return order.select("_source", "_source_size", target.alias("_target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_epochs: int = 3, seed: str = "mix-1", keep: tuple[str, ...] = ("doc_id",), range_rows: int = RANGE_ROWS) -> DataFrame:
    """The columns in keep, and size, source_size, target, taken, epochs, part for each row of docs.

    taken = epochs * size + part, the words that the mix takes of a document;
    part is less than size only for the one document in which its source's
    budget ends. Null and empty texts have no words, null source is a source, rows
    with null ids stand in the order by their texts; rows that are equal are
    interchangeable; an empty table gives an empty result. Columns of docs with
    such names as the results don't matter unless kept. range_rows: about so many
    rows share a key range, and so a task, however large a source is.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    ident = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.xxhash64("text", "source").cast("string")))
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("_row"), F.struct(F.col("source").isNull().alias("missing"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name")).alias("_from"),
        F.col("doc_id").alias("_id"), word_count(F.col("text")).alias("_size"), F.md5(F.concat(F.lit(seed + ":"), ident).cast("binary")).alias("_key"),
    )
    rows = scratch.save(rows, "rows")  # texts are read, and their words counted, once
    digits = max(1, math.ceil(math.log(max(rows.count() / range_rows, 1), 16)))
    rows = rows.withColumn("_range", F.substring("_key", 1, digits))
    ranges = scratch.save(rows.groupBy("_from", "_range").agg(F.sum("_size").alias("_words")), "ranges")
    name = F.when(~F.col("_from.missing"), F.col("_from.name")).alias("_source")
    sizes = ranges.groupBy("_from").agg(F.sum("_words").alias("_source_size")).select(name, "_source_size")
    targets = source_targets(spark, sizes, weights, most_epochs, scratch)
    targets = targets.select(F.struct(F.col("_source").isNull().alias("missing"), F.coalesce("_source", F.lit("")).alias("name")).alias("_from"), "_source_size", "_target")
    earlier = Window.partitionBy("_from").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("_from", "_range", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start")).join(targets, "_from")

    # The running sum and the join have the same keys: rows are shuffled once.
    ahead = Window.partitionBy("_from", "_range").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_ahead", F.coalesce(F.sum("_size").over(ahead), F.lit(0))).join(starts, ["_from", "_range"])
    budget = F.floor("_target").cast("long")
    epochs = F.when(F.col("_source_size") > 0, F.expr("cast(floor(_target) as long) div _source_size")).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("_source_size")
    part = F.greatest(F.lit(0), F.least(F.col("_size"), rest - F.col("_start") - F.col("_ahead"))).cast("long")
    return rows.select(
        "_row.*", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (epochs * F.col("_size") + part).alias("taken"), epochs.alias("epochs"), part.alias("part"),
    )


def mixed_documents(docs: DataFrame, columns: tuple[str, ...], **options) -> DataFrame:
    """The mix itself: each document as often as its source's epochs say, and the cut one's first words."""
    mixed = mix_sources(docs, keep=columns, **options)
    whole = mixed.select(*columns, F.explode(F.sequence(F.lit(0), (F.col("epochs") + (F.col("part") > 0).cast("long")).cast("int"))).alias("_epoch"), "epochs", "part", "size")
    whole = whole.filter((F.col("_epoch") < F.col("epochs")) | ((F.col("_epoch") == F.col("epochs")) & (F.col("part") > 0)))
    partial = (F.col("_epoch") == F.col("epochs")) & (F.col("part") < F.col("size"))
    cut = F.expr(r"array_join(slice(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), 1, cast(part as int)), ' ')")
    return whole.withColumn("text", F.when(partial, cut).otherwise(F.col("text"))).select(*columns)
