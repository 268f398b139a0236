"""Column and window builders that the operators share.

An observation row is (series_id, observation_date, value, …). Windows partition
by series and order by date: a series is one task's work, its length is bounded
by its calendar, and many series spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

YEAR_DAYS, TOLERANCE_DAYS = 365, 40
FLAT = 1e-12


def ordered(*keys: str, by: str = "observation_date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(by)


def expanding(*keys: str, by: str = "observation_date") -> WindowSpec:
    return ordered(*keys, by=by).rowsBetween(Window.unboundedPreceding, 0)


def trailing(w: int, *keys: str, by: str = "observation_date") -> WindowSpec:
    return ordered(*keys, by=by).rowsBetween(1 - w, 0)


def parse_value(raw: Column) -> Column:
    """A number from text; blank, '.' and other text give null, thousands separators go."""
    return F.replace(F.trim(raw), F.lit(","), F.lit("")).try_cast("double")


def row_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def pct_change(now: Column, base: Column) -> Column:
    return F.try_divide(now - base, base)


def present(obs: DataFrame) -> DataFrame:
    """Rows that have a series, a date and a value."""
    kept = obs.filter("series_id is not null and observation_date is not null and value is not null")
    return kept.filter("not coalesce(is_missing, false)") if "is_missing" in obs.columns else kept


def year_ago(value: str, *keys: str) -> Column:
    """The last value between 405 and 365 days before."""
    days = F.datediff("observation_date", F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy(*keys).orderBy(days).rangeBetween(-YEAR_DAYS - TOLERANCE_DAYS, -YEAR_DAYS)
    return F.last(value).over(frame)


def zscore(value: str, w: WindowSpec, floor: float = 0.0) -> Column:
    """Distance from the window's mean in population standard deviations; null where those don't exceed floor."""
    std = F.stddev_pop(value).over(w)
    return F.when(std > floor, (F.col(value) - F.avg(value).over(w)) / std)


def with_expanding_rank(df: DataFrame, value: str, keys: Sequence[str], below: str, at_most: str, by: str = "observation_date") -> DataFrame:
    """Adds, for each row, how many earlier-or-same rows of its series lie below it and at most at it, and their number.

    One sorted list per series and a binary search per row: n log n, where a
    window over collected lists would cost the square of a series' length.
    """
    schema = ", ".join([f"`{n}` {t}" for n, t in df.dtypes] + [f"{below} long", f"{at_most} long", "seen long"])

    def rank(rows: pd.DataFrame) -> pd.DataFrame:
        from bisect import bisect_left, bisect_right, insort

        rows = rows.sort_values(by, kind="stable")
        past: list[float] = []
        low, high = [], []
        for v in rows[value]:
            insort(past, v)
            low.append(bisect_left(past, v))
            high.append(bisect_right(past, v))
        return rows.assign(**{below: low, at_most: high, "seen": range(1, len(rows) + 1)})

    return df.groupBy(*keys).applyInPandas(rank, schema)


def period_start(date: Column, freq: str) -> Column:
    unit = {"w": "week", "m": "month", "q": "quarter", "a": "year"}.get(freq)
    return F.trunc(date, unit) if unit else date


def downsampled(obs: DataFrame, freq: str) -> DataFrame:
    """The last value of each period, at the period's first day."""
    return present(obs).groupBy("series_id", period_start(F.col("observation_date"), freq).alias("period")).agg(F.max_by("value", "observation_date").alias("value"))


def rolling(df: DataFrame, keys: Sequence[str], windows: Sequence[int], percentile: bool = False) -> DataFrame:
    """keys, observation_date, window_size, value, change, pct_change, zscore: rows from the w-th change on, one per window."""
    order, out = ordered(*keys), []
    for w in windows:
        base = F.lag("value", w).over(order)
        frame = trailing(w, *keys)
        parts = [F.lit(w).alias("window_size"), (F.col("value") - base).alias("change"), pct_change(F.col("value"), base).alias("pct_change"), zscore("value", frame, FLAT).alias("zscore")]
        if percentile:
            parts.append((F.size(F.filter(F.collect_list("value").over(frame), _at_most(F.col("value")))) / F.lit(w) * 100).alias("percentile"))
        out.append(F.when(F.row_number().over(order) > w, F.struct(*parts)))
    rows = df.select(*keys, "observation_date", "value", F.array_compact(F.array(*out)).alias("rs")).select(*keys, "observation_date", "value", F.explode("rs").alias("r"))
    return rows.select(*keys, "observation_date", "value", "r.*")


def _at_most(limit: Column) -> Callable[[Column], Column]:
    return lambda x: x <= limit


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], date: str, value: str, within_days: int | None = None) -> DataFrame:
    """left with the last value of right on or before its date; null when older than within_days.

    A union and a window, so each side is shuffled once and nothing is paired.
    """
    marked = left.withColumn("_row", F.struct(*left.columns)).select(*keys, date, "_row", F.lit(None).cast(f"struct<d:date,v:{dict(right.dtypes)[value]}>").alias("_seen"))
    seen = right.filter(F.col(value).isNotNull()).select(*keys, date, F.lit(None).cast(marked.schema["_row"].dataType).alias("_row"), F.struct(F.col(date).alias("d"), F.col(value).alias("v")).alias("_seen"))
    frame = Window.partitionBy(*keys).orderBy(date, F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = marked.unionByName(seen).withColumn("_last", F.last("_seen", ignorenulls=True).over(frame)).filter("_row is not null")
    found = F.col("_last.v")
    if within_days is not None:
        found = F.when(F.datediff(F.col(date), F.col("_last.d")) <= within_days, found)
    return both.select("_row.*", found.alias(value))


def guarded_corr(x: str, y: str, w: WindowSpec | None = None) -> Column:
    """Correlation from sums, null for a flat side, held in -1..1."""
    def s(c: Column) -> Column:
        return F.sum(c).over(w) if w is not None else F.sum(c)

    a, b, n = F.col(x), F.col(y), (F.count("*").over(w) if w is not None else F.count("*"))
    va, vb = s(a * a) - s(a) * s(a) / n, s(b * b) - s(b) * s(b) / n
    r = (s(a * b) - s(a) * s(b) / n) / F.sqrt(va * vb)
    return F.when((va > FLAT) & (vb > FLAT), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
