"""Text statistics and learned decision lists (operator 5).

Statistics of every whole text come from one Arrow pass. From labelled rows,
sequential covering learns an ordered list of rules for the low label: each
rule grows by the threshold that gains most information, is pruned on rows held
back from growing, and takes the rows that it covers out of the next round. The
list is emitted as one Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.llm import textops

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_punct", "n_distinct_words", "n_long_words", "n_unspaced")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in ".,;:!?\"'()-"]] = True
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False
WINDOW = 3


def _per_row(flags: np.ndarray, lo: int, offs: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return np.diff(sums[offs - lo])


def _repeats(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(positions that have an equal key in the same row, those among them that aren't the first)."""
    order = np.lexsort((np.arange(len(keys)), keys, rows))
    k, r = keys[order], rows[order]
    same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    later, first = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    first[order[:-1][same]] = True
    return later | first, later


def text_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """STATISTICS of each text; null and empty texts have zeros."""
    data, offs = textops.string_parts(column)
    n = len(offs) - 1
    out = {name: np.zeros(n, np.int64) for name in STATISTICS}
    for block in textops.word_blocks(column):
        at = slice(block.first_row, block.first_row + block.n_rows)
        rows, sizes = block.row_of_word(), np.diff(block.bounds)
        offsets = offs[block.first_row : block.first_row + block.n_rows + 1]
        lo, hi = int(offsets[0]), int(offsets[-1])
        part = data[lo:hi]
        out["n_words"][at] = sizes
        space = textops._IS_SPACE[part]
        out["word_chars"][at] = _per_row(_LEAD[part] & ~space, lo, offsets)
        for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_digits", _DIGIT), ("n_punct", _PUNCT)):
            out[name][at] = _per_row(table[part], lo, offsets)
        out["n_long_words"][at] = np.bincount(rows[(block.ends - block.begins) > 15], minlength=block.n_rows)
        any_repeat, later = _repeats(block.hashes, rows)
        out["n_distinct_words"][at] = sizes - np.bincount(rows[later], minlength=block.n_rows)
        out["n_unspaced"][at] = np.bincount(rows, weights=(block.ends - block.begins) > 40, minlength=block.n_rows).astype(np.int64)

        windows = textops.window_hashes(block.hashes, WINDOW)
        if len(windows):
            whole = np.flatnonzero(textops.whole_windows(block.bounds, WINDOW, len(block.hashes)))
            twice, _ = _repeats(windows[whole], rows[whole])
            covered = np.zeros(len(block.hashes) + 1, np.int64)
            begin = whole[twice]
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + WINDOW, -1)
            out["n_repeat_words"][at] = np.bincount(rows[np.cumsum(covered[:-1]) > 0], minlength=block.n_rows)

        # Lines with a word, as [begin, end) in the data; a row's end also ends its last line.
        if hi > lo and len(block.hashes):
            breaks = np.flatnonzero(part == 10) + lo
            starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
            starts = starts[starts < hi]
            ends = np.minimum(np.searchsorted(breaks, starts, "left"), len(breaks))
            ends = np.where(ends < len(breaks), breaks[np.minimum(ends, len(breaks) - 1)] if len(breaks) else hi, hi)
            line_row = np.searchsorted(offsets, starts, "right") - 1
            ends = np.minimum(ends, offsets[line_row + 1])
            has_word = np.searchsorted(block.begins, ends, "left") > np.searchsorted(block.begins, starts, "left")
            starts, ends, line_row = starts[has_word], ends[has_word], line_row[has_word]
            out["n_lines"][at] = np.bincount(line_row, minlength=block.n_rows)
            power, inverse = textops._power_tables(textops._WORD_BASE_2, len(part) + 1)
            sums = textops._prefix(textops._BYTE_VALUES[part] * power[: len(part)])
            keys = textops.mix((sums[ends - lo] - sums[starts - lo]) * inverse[starts - lo])
            _, again = _repeats(keys, line_row)
            out["n_dup_lines"][at] = np.bincount(line_row[again], minlength=block.n_rows)
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and STATISTICS (long) for each row of docs, over its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = text_statistics(batch.column(1))
            yield pa.record_batch([batch.column(0), *[pa.array(stats[s]) for s in STATISTICS]], names=["doc_id", *STATISTICS])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, " + ", ".join(f"{s} long" for s in STATISTICS))


def ratios() -> dict[str, Column]:
    """The learner's features, from the statistics; 0 where there is nothing to divide by."""

    def over(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))

    return {
        "n_words": F.col("n_words").cast("double"), "mean_word": over("word_chars", "n_words"), "symbols": over("n_symbols", "word_chars"), "dup_lines": over("n_dup_lines", "n_lines"),
        "repeat_words": over("n_repeat_words", "n_words"), "upper": over("n_upper", "word_chars"), "digits": over("n_digits", "word_chars"), "punct": over("n_punct", "n_words"),
        "distinct": over("n_distinct_words", "n_words"), "long_words": over("n_long_words", "n_words"), "unspaced": over("n_unspaced", "n_words"), "line_words": over("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Rule:
    """All of (feature, is_at_least, threshold) hold."""

    terms: tuple[tuple[str, bool, float], ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, at_least, t in self.terms:
            out &= (x[name] >= t) if at_least else (x[name] < t)
        return out

    def column(self, features: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, at_least, t in self.terms:
            out = out & ((features[name] >= F.lit(t)) if at_least else (features[name] < F.lit(t)))
        return out


def _grow(x: dict[str, np.ndarray], y: np.ndarray) -> Rule:
    """Terms are added while one gains information; every threshold between two values of a feature is tried."""
    terms: list = []
    covered = np.ones(len(y), bool)
    while True:
        p0, n0 = y[covered].sum(), (~y[covered]).sum()
        if not p0 or not n0:
            break
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for name in sorted(x):
            v, t = x[name][covered], y[covered]
            order = np.argsort(v, kind="stable")
            v, t = v[order], t[order]
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1
            if not len(cut):
                continue
            below_p = np.concatenate(([0], np.cumsum(t)))[cut]
            below_n = cut - below_p
            for at_least in (False, True):
                p, n = (p0 - below_p, n0 - below_n) if at_least else (below_p, below_n)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), 0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (name, at_least, float((v[cut[k] - 1] + v[cut[k]]) / 2)))
        if best[1] is None:
            break
        terms.append(best[1])
        covered = Rule(tuple(terms)).covers(x)
    return Rule(tuple(terms))


def _worth(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray) -> float:
    hit = rule.covers(x)
    p, n = int(y[hit].sum()), int((~y[hit]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(x: dict[str, np.ndarray], low: np.ndarray, least_precision: float = 0.8, least_rows: int = 3) -> list[Rule]:
    """Rules for rows with low True, best first, until the next one is not precise enough or covers too few rows. Every third row is kept for pruning."""
    y = np.asarray(low, bool)
    hold = np.arange(len(y)) % 3 == 2
    rules: list[Rule] = []
    open_rows = np.ones(len(y), bool)
    while True:
        grow, prune = open_rows & ~hold, open_rows & hold
        if y[grow].sum() < least_rows:
            return rules
        gx, px = ({k: v[m] for k, v in x.items()} for m in (grow, prune))
        rule = _grow(gx, y[grow])
        options = [Rule(rule.terms[:k]) for k in range(1, len(rule.terms) + 1)]
        if not options:
            return rules
        rule = max(options, key=lambda r: (_worth(r, px, y[prune]), -len(r.terms)))
        hit = rule.covers(x) & open_rows
        if hit.sum() < least_rows or y[hit].mean() < least_precision:
            return rules
        rules.append(rule)
        open_rows &= ~hit


def verdict(rules: list[Rule], features: dict[str, Column]) -> Column:
    """The list as one conditional expression: False by the first rule that holds, else True."""
    out = None
    for rule in rules:
        out = F.when(rule.column(features), F.lit(False)) if out is None else out.when(rule.column(features), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge_quality(docs: DataFrame, labels: DataFrame, scratch, most_labelled: int = 20_000, least_words: int = 50) -> tuple[DataFrame, list[Rule]]:
    """(doc_id, STATISTICS, base_failed, kept) for each row of docs, and the learned rules.

    most_labelled: rows that the rules are learned from, those with the smallest
    hash of doc_id; labels and statistics of no more rows come to the driver.
    Without labels there are no rules. A null label or doc_id is no label; of
    several labels of a document the lowest counts. Empty texts fail the base.
    """
    stats = scratch.save(document_statistics(docs), "statistics")
    features = ratios()
    given = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_quality")).dropna()
    given = given.groupBy("_id").agg(F.min("_quality").alias("_quality"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    pool = given.join(stats.filter(~failed), F.col("_id") == F.col("doc_id"))
    chosen = pool.orderBy(F.xxhash64("_id"), "_id").limit(most_labelled).select("_quality", *[c.alias(f"f_{k}") for k, c in features.items()])
    rows = chosen.toPandas()
    x = {k: rows[f"f_{k}"].to_numpy(np.float64) for k in features}
    rules = learn_rules(x, rows["_quality"].to_numpy() == 0) if len(rows) else []
    kept = F.when(failed, F.lit(False)).otherwise(verdict(rules, features))
    return stats.select("doc_id", *STATISTICS, failed.alias("base_failed"), kept.alias("kept")), rules
