"""Near-duplicate vectors by p-stable hashing and exact cosines (operator 9).

Vectors of length 1 are projected on Gaussian directions, shifted and cut into
cells; `per_table` cells make a bucket of one table, and near vectors share a
bucket in some table with known probability (public work: Datar et al., 2004).
The number of cells and tables follows from the number of vectors and the
recall asked for. Vectors that share a bucket are compared exactly.

Equal vectors are one class and never compared with one another. Large buckets
are dealt in blocks, so that no bucket is one task; a block compares its vectors
by matrix products and returns counts and a spanning forest, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.components import connected_components
from timeloom.llm.runtime import Scratch
from timeloom.llm.textops import mix, signed, whole_groups

COSINE = 0.98
CELL = 1.5
MISSED = 1e-4
BLOCK = 512
SEED = 20240611
BLOCK_KEY = ["label", "dim", "tbl", "bucket", "lo", "hi"]


def collision(distance: float, cell: float) -> float:
    """Probability that two points at a distance share a cell of one projection."""
    t = cell / distance
    return math.erf(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def tables_for(n: int, cosine: float = COSINE, cell: float = CELL, missed: float = MISSED) -> tuple[int, int]:
    """(cells per table, tables): about one unrelated vector in a bucket, and at most `missed` of the pairs at the threshold lost."""
    near = collision(math.sqrt(2 - 2 * cosine), cell)
    far = collision(math.sqrt(2), cell)
    per_table = max(6, math.ceil(math.log(max(n, 2)) / -math.log(far)))
    return per_table, math.ceil(math.log(missed) / math.log1p(-(near**per_table)))


def unit_rows(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    scale = np.max(np.abs(rows), axis=1, keepdims=True)  # against overflow and underflow of squares
    rows = rows / scale
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _signatures(unit: np.ndarray, per_table: int, tables: int, cell: float) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(SEED))
    directions = rng.standard_normal((unit.shape[1], tables * per_table))
    shifts = rng.uniform(0, cell, tables * per_table)
    odd = rng.integers(1, 2**62, tables * per_table, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    cells = np.floor((unit @ directions + shifts) / cell).astype(np.int64).view(np.uint64) * odd
    return mix(cells.reshape(len(unit), tables, per_table).sum(axis=2, dtype=np.uint64))


def signature_table(classes: DataFrame, per_table: int, tables: int, cell: float = CELL) -> DataFrame:
    """classes (class_id, label, dim, m, embedding) with signatures: one 64-bit bucket name per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                for lo in range(0, part.num_rows, 2048):
                    piece = part.slice(lo, 2048)
                    marks = signed(_signatures(unit_rows(piece.column(4)), per_table, tables, cell))
                    offsets = pa.array(np.arange(len(marks) + 1, dtype=np.int32) * tables)
                    yield pa.record_batch([*piece.columns, pa.ListArray.from_arrays(offsets, pa.array(marks.ravel()))], names=[*piece.schema.names, "signatures"])

    return classes.select("class_id", "label", "dim", "m", "embedding").mapInArrow(run, "class_id long, label int, dim int, m long, embedding array<float>, signatures array<long>")


def _forest(ids: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The smallest id that each row reaches over the links in a symmetric matrix."""
    reach, low = near | np.eye(len(ids), dtype=bool), ids
    while True:
        new = np.where(reach, low[None, :], np.iinfo(np.int64).max).min(axis=1)
        if np.array_equal(new, low):
            return low
        low = new


def compare_block(ids: np.ndarray, sides: np.ndarray, copies: np.ndarray, unit: np.ndarray, marks: np.ndarray, table: int, within: bool, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links that this table is first to see, as copies, smallest id in reach) for each row."""
    near = unit @ unit.T >= cosine
    if not within:
        near &= sides[:, None] != sides[None, :]
    np.fill_diagonal(near, False)
    low = _forest(ids, near)
    a, b = np.nonzero(near)
    if table:
        fresh = np.ones(len(a), bool)
        for lo in range(0, len(a), 1 << 16):
            s = slice(lo, lo + (1 << 16))
            fresh[s] = ~(marks[a[s], :table] == marks[b[s], :table]).any(axis=1)
        a, b = a[fresh], b[fresh]
    return np.bincount(a, weights=copies[b], minlength=len(ids)).astype(np.int64), low


def compared(blocks: DataFrame, cosine: float) -> DataFrame:
    """(class_id, links, low) from rows sorted by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, heads in whole_groups(batches, BLOCK_KEY):
            ids, copies, sides, table, lo_part, hi_part = (rows.column(c).to_numpy() for c in ("class_id", "m", "side", "tbl", "lo", "hi"))
            vectors, signatures = (rows.column(c).combine_chunks() for c in ("embedding", "signatures"))
            out = []
            for lo, hi in zip(heads[:-1], heads[1:], strict=True):
                n = int(hi - lo)
                if n < 2:
                    continue
                unit = unit_rows(vectors.slice(lo, n))
                marks = signatures.slice(lo, n).flatten().to_numpy().reshape(n, -1)
                own = ids[lo:hi]
                links, low = compare_block(own, sides[lo:hi], copies[lo:hi], unit, marks, int(table[lo]), lo_part[lo] == hi_part[lo], cosine)
                some = (links > 0) | (low < own)
                if some.any():
                    out.append((own[some], links[some], low[some]))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["class_id", "links", "low"])

    return blocks.mapInArrow(run, "class_id long, links long, low long")


def link_vectors(embeddings: DataFrame, scratch: Scratch, cosine: float = COSINE) -> DataFrame:
    """vec_id, label, n_links, component_id, kept for each row of embeddings (vec_id, embedding, label).

    Rows link when their labels are equal and their cosine, in double precision,
    is at least ``cosine``. A row without vec_id, label or vector, or whose
    vector is empty, zero or holds null or non-finite components, links with
    nothing; its component is itself. Vectors of different lengths don't link.
    Equal rows count as different vectors that link with each other.
    """
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>").alias("embedding"), F.col("label").cast("int"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(usable & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)

    classes = rows.filter("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("m"))
    classes = scratch.save(classes.withColumn("dim", F.size("embedding")), "classes")
    per_table, tables = tables_for(classes.count(), cosine)
    marked = scratch.save(signature_table(classes, per_table, tables), "marked")

    slim = marked.select("class_id", "label", "dim", F.posexplode("signatures").alias("tbl", "bucket"))
    # Buckets of the same vectors in several tables give the same links: the first such table's bucket is searched.
    members = [F.bit_xor(F.xxhash64("class_id", F.lit(i))).alias(f"h{i}") for i in (1, 2)]
    full = slim.groupBy("label", "dim", "tbl", "bucket").agg(F.count("*").alias("n"), *members).filter("n > 1")
    full = full.groupBy("label", "dim", "n", "h1", "h2").agg(F.min(F.struct("tbl", "bucket")).alias("at")).select("label", "dim", "at.*", "n")
    full = scratch.save(full, "full")
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = slim.join(full, ["label", "dim", "tbl", "bucket"]).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("class_id", "label", "dim", "tbl", "bucket", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), (F.col("part") > F.col("other")).cast("int").alias("side"))
    blocks = dealt.join(marked.select("class_id", "m", "embedding", "signatures"), "class_id")
    parts_now = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = scratch.save(compared(blocks.repartition(parts_now, *BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY), cosine), "found")

    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    roots = connected_components(found.filter("low < class_id").select(F.col("class_id").alias("a"), F.col("low").alias("b")).distinct(), scratch)
    answers = classes.join(links, "class_id", "left").join(roots, F.col("class_id") == F.col("node"), "left")
    answers = answers.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    answers = scratch.save(answers, "answers")
    linked = rows.filter("usable").join(answers, ["label", "embedding"]).select("vec_id", "label", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", "label", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
