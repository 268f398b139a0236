"""Toxicity scores from a character n-gram linear classifier (operator 8).

Features are the character n-grams that occur in a text (presence, not counts),
named by 64-bit hashes. Each is scaled by its naive Bayes log-count ratio, and a
logistic regression learns a weight for every scaled feature. A feature is kept
for its evidence alone: it occurs in LEAST_TEXTS texts or more, and its share of
texts differs between the labels by more standard errors than a further
parameter costs by Schwarz's criterion, the root of the logarithm of the number of texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.runtime import returning
from timeloom.llm.textops import mix, signed

SIZES = (3, 4, 5)
#: Texts that a feature must occur in.
LEAST_TEXTS = 3
#: Labelled documents that it learns from: those with the smallest hash of doc_id.
MOST_LABELLED = 20_000
THRESHOLD = 0.7
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xB564EF22EC7AECE5, 0xF7C2EBC08F67F2B5], np.uint64)
_GROUP = 1 << 18
#: Pairs of text and n-gram that are counted at a time, which bounds a worker's memory.
_PAIRS = 1 << 21
_SIEVE = 20
#: Entries of the regression's matrix that are multiplied at a time.
_ENTRIES = 1 << 19


def text_grams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each n-gram, n-gram): those of some texts or of a part of a long one, repeated ones as well.

    Lower case; white space counts as one blank; a blank stands before and after each text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.utf8_lower(pc.fill_null(column, ""))
    sizes = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    ends = np.cumsum(sizes)
    row, n = 0, len(column)
    while row < n:
        done = ends[row - 1] if row else 0
        last = max(int(np.searchsorted(ends, done + _GROUP, "right")), row + 1)
        text = "".join(f" {t} " for t in column.slice(row, last - row).to_pylist())
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        of = np.repeat(np.arange(last - row), sizes[row:last])
        # Long texts go piece by piece; pieces overlap by the longest n-gram.
        for lo in range(0, len(points), _GROUP):
            part = points[lo : lo + _GROUP + max(SIZES) - 1].astype(np.uint64)
            part[(part >= 9) & (part <= 13)] = 32
            rows = of[lo : lo + len(part)]
            total, found = np.zeros(len(part), np.uint64), []
            for k in range(min(max(SIZES), len(part))):
                total = total[: len(part) - k] + part[k:] * _FACTORS[k]
                if k + 1 in SIZES:
                    inside = rows[: len(total)] == rows[k:]
                    found.append((rows[: len(total)][inside], mix(total[inside] + np.uint64(k))))
            if found:
                yield row, last - row, *(np.concatenate(x) for x in zip(*found, strict=True))
        row = last


class Lookup:
    """Places of n-grams in a sorted array; a sieve of their first bits turns most others away."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        self.sieve = np.zeros(1 << _SIEVE, bool)
        self.sieve[(grams >> np.uint64(64 - _SIEVE)).astype(np.int64)] = True

    def pairs(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, rows, row, place): each wanted n-gram of a text once; rows of one text come in one item or, if it is long, in several."""
        for first, n, rows, grams in text_grams(column):
            near = self.sieve[(grams >> np.uint64(64 - _SIEVE)).astype(np.int64)]
            rows, grams = rows[near], grams[near]
            place = np.searchsorted(self.grams, grams)
            hit = place < len(self.grams)
            hit[hit] = self.grams[place[hit]] == grams[hit]
            both = np.unique(rows[hit] << 32 | place[hit])
            yield first, n, both >> 32, both & 0xFFFFFFFF

    def of_texts(self, column: pa.Array) -> list[np.ndarray]:
        """The places of each text's n-grams, sorted and each once."""
        out: list[list[np.ndarray]] = [[] for _ in range(len(column))]
        for first, _, rows, places in self.pairs(column):
            cuts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else rows
            for r, part in zip(rows[cuts], np.split(places, cuts[1:]) if len(rows) else [], strict=True):
                out[first + r].append(part)
        return [np.unique(np.concatenate(x)) if x else np.empty(0, np.int64) for x in out]


@dataclass(frozen=True)
class ToxicityModel:
    """grams: kept n-grams, sorted; weights: of each, its ratio times its learned weight."""

    grams: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        sums = np.array([self.weights[x].sum() for x in Lookup(self.grams).of_texts(column)])
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -30, 30)))


def least_spread(n: int) -> float:
    """Standard errors by which a feature's share must differ between the labels of n texts."""
    return math.sqrt(math.log(max(n, 3)))


def fit_logistic(sizes: np.ndarray, columns: np.ndarray, scale: np.ndarray, y: np.ndarray, ridge: float = 2.0, close: float = 1e-3) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps, each solved by conjugate gradients, on a matrix whose rows hold scale[c] at sizes[i] of columns each.

    Only the columns (4 bytes each) are kept; products are made some rows at a time.
    """
    n, n_columns = len(y), len(scale)
    ends = np.cumsum(sizes)
    cuts = np.unique([0, *np.searchsorted(ends, np.arange(_ENTRIES, ends[-1], _ENTRIES)), n])

    def blocks() -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield slice(lo, hi), np.repeat(np.arange(hi - lo), sizes[lo:hi]), columns[ends[lo] - sizes[lo] : ends[hi - 1]]

    def times(v: np.ndarray) -> np.ndarray:
        v = v * scale
        return np.concatenate([np.bincount(r, weights=v[c], minlength=at.stop - at.start) for at, r, c in blocks()])

    def transposed(z: np.ndarray) -> np.ndarray:
        return scale * sum(np.bincount(c, weights=z[at][r], minlength=n_columns) for at, r, c in blocks())

    # The last entry of every vector is the bias, which the ridge spares.
    penalty = np.append(np.full(n_columns, ridge), 0.0)

    def both(v: np.ndarray) -> np.ndarray:
        return times(v[:-1]) + v[-1]

    def back(z: np.ndarray) -> np.ndarray:
        return np.append(transposed(z), z.sum())

    def loss(z: np.ndarray, w: np.ndarray) -> float:
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * penalty @ (w * w))

    w = np.append(np.zeros(n_columns), np.log((y.sum() + 1) / (n - y.sum() + 1)))
    z, first = both(w), None
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        g = back(p - y) + penalty * w
        size = float(np.linalg.norm(g))
        first = first or size
        if size <= close * first:
            break
        d = np.maximum(p * (1 - p), 1e-10)
        curve = np.append(scale * transposed(d), d.sum()) + penalty
        step, r = np.zeros_like(w), -g
        q = r / curve
        dot = float(r @ q)
        for _ in range(100):
            h = back(d * both(q)) + penalty * q
            a = dot / float(q @ h)
            step += a * q
            r -= a * h
            if np.linalg.norm(r) <= min(0.25, math.sqrt(size / first)) * size:
                break
            fresh = float(r @ (r / curve))
            q, dot = r / curve + fresh / dot * q, fresh
        along, now, t = both(step), loss(z, w), 1.0
        while t > 1e-6 and loss(z + t * along, w + t * step) > now + 1e-4 * t * float(g @ step):
            t /= 2
        w, z = w + t * step, z + t * along
    return w[:-1], float(w[-1])


def training_rows(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> DataFrame:
    """(text, toxic) of the labelled documents to learn from: crc32 of the id as text modulo 3 is not 1."""
    given = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).dropna()
    given = given.filter(F.crc32(F.col("_id").cast("string").cast("binary")) % 3 != 1)
    given = given.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    chosen = given.orderBy(F.xxhash64("_id"), "_id").limit(most_labelled)
    # At most most_labelled rows of two numbers: a proven bound.
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text")).join(F.broadcast(chosen), "_id").select("_text", "_toxic")


def gram_counts(rows: DataFrame) -> DataFrame:
    """(gram, clean, toxic, holders): how many texts of either label hold an n-gram, and a 64-bit name of the set of these texts, from (text, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.uint64(TaskContext.get().partitionId() << 40)
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False) > 0
            held, size = [], 0
            for i, of_text in enumerate(distinct_grams(batch.column(0))):
                number += np.uint64(1)
                held.append((of_text, toxic[i], mix(np.array([number]))[0]))
                size += len(of_text)
                if size >= _PAIRS:
                    yield counted(held)
                    held, size = [], 0
            if size:
                yield counted(held)

    def counted(held: list) -> pa.RecordBatch:
        grams, sizes = np.concatenate([g for g, _, _ in held]), [len(g) for g, _, _ in held]
        order = np.argsort(grams, kind="stable")
        grams = grams[order]
        heads = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
        every = np.diff(np.append(heads, len(grams)))
        of_toxic = np.add.reduceat(np.repeat([int(y) for _, y, _ in held], sizes)[order], heads)
        names = np.bitwise_xor.reduceat(np.repeat(np.array([n for _, _, n in held], np.uint64), sizes)[order], heads)
        return pa.record_batch([pa.array(signed(grams[heads])), pa.array(every - of_toxic), pa.array(of_toxic), pa.array(signed(names))], names=["gram", "clean", "toxic", "holders"])

    parts = rows.mapInArrow(returning(run), "gram long, clean long, toxic long, holders long")
    return parts.groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.bit_xor("holders").alias("holders"))


def distinct_grams(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text."""
    for text in column:
        parts = [grams for _, _, _, grams in text_grams(pa.array([text.as_py()], pa.string()))]
        yield np.unique(np.concatenate([np.unique(x) for x in parts])) if parts else np.empty(0, np.uint64)


def train(rows: DataFrame, scratch, smoothing: float = 1.0, parts: int = 8) -> ToxicityModel:
    """A model from (text, toxic); without both labels, one that gives every text the same score."""
    rows = scratch.save(rows.repartition(parts), "training")
    found = rows.agg(F.count_if(F.col("_toxic") > 0).alias("toxic"), F.count_if(F.col("_toxic") <= 0).alias("clean")).first()
    toxic, clean = found["toxic"], found["clean"]
    if not clean or not toxic:
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), float(np.log((toxic + 1) / (clean + 1))))
    p, q = F.col("toxic") / toxic, F.col("clean") / clean
    spread = F.abs(p - q) / F.sqrt((p * (1 - p) + 1 / toxic) / toxic + (q * (1 - q) + 1 / clean) / clean)
    kept = gram_counts(rows).filter((F.col("clean") + F.col("toxic") >= LEAST_TEXTS) & (spread > least_spread(toxic + clean)))
    # n-grams of at most most_labelled texts that tell the labels apart: some thousands, whatever the corpus.
    kept = kept.toPandas().sort_values(["clean", "toxic", "holders", "gram"], ignore_index=True)
    grams = kept["gram"].to_numpy(np.int64).view(np.uint64)
    in_toxic, in_clean = (kept[c].to_numpy(np.float64) for c in ("toxic", "clean"))
    ratio = np.log((in_toxic + smoothing) / (toxic + 2 * smoothing)) - np.log((in_clean + smoothing) / (clean + 2 * smoothing))
    # m n-grams of the same texts have the same ratio, and under a ridge the same weight: one column, scaled by the root of m, gives just that.
    new = (kept[["clean", "toxic", "holders"]].diff() != 0).any(axis=1).to_numpy()
    first, m = np.flatnonzero(new), np.bincount(np.cumsum(new) - 1) if len(new) else np.empty(0, np.int64)
    by_gram = np.argsort(grams[first])
    wanted, scale = grams[first][by_gram], (ratio[first] * np.sqrt(m))[by_gram]

    def hits(batches):
        lookup = Lookup(wanted)
        for batch in batches:
            places = [x.astype(np.uint32).tobytes() for x in lookup.of_texts(batch.column(0))]
            yield pa.record_batch([pa.array(places, pa.binary()), batch.column(1)], names=["hits", "toxic"])

    # At most most_labelled rows of the columns that they hold; they are found by all tasks at once and only then read one part after the other.
    held = scratch.save(rows.mapInArrow(returning(hits), "hits binary, toxic int"), "hits")
    entries = held.agg(F.sum(F.length("hits"))).first()[0] // 4
    columns, sizes, y, end = np.empty(entries, np.uint32), [], [], 0
    for r in held.toLocalIterator():
        of_text = np.frombuffer(r["hits"], np.uint32)
        columns[end : end + len(of_text)] = of_text
        end += len(of_text)
        sizes.append(len(of_text))
        y.append(r["toxic"] > 0)
    scratch.drop("hits", "training")
    sizes = np.array(sizes)
    w, b = fit_logistic(sizes, columns, scale, np.asarray(y, float))
    weights = np.empty(len(first))
    weights[by_gram] = w * scale
    order = np.argsort(grams)
    return ToxicityModel(grams[order], np.repeat(weights / m, m)[order], b)


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in keep, and score (double, 0 to 1), for each row of docs; null text counts as empty."""
    sent = docs.sparkSession.sparkContext.broadcast((model.grams, model.weights, model.bias))  # two numbers for each kept n-gram
    rows = docs.select(F.col("text").cast("string").alias("_text"), F.struct(*[F.col(c) for c in keep]).alias("_row"))
    schema = rows.select("_row").schema.add("_score", "double")

    def run(batches):
        known = ToxicityModel(*sent.value)
        for batch in batches:
            yield pa.record_batch([batch.column(1), pa.array(known.scores(batch.column(0)))], names=["_row", "_score"])

    return rows.mapInArrow(returning(run), schema).select("_row.*", F.col("_score").alias("score"))


def classify_toxicity(docs: DataFrame, labels: DataFrame, scratch, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Trains on labels and scores every row of docs: the columns in keep, score, predicted (1 from THRESHOLD on)."""
    model = train(training_rows(docs, labels), scratch)
    scored = score_toxicity(docs, model, keep)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
