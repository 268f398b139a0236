"""Vintages: which value of a date was known when."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ("series_id", "observation_date")
OPEN_END = "9999-12-31"
STALE_DAYS = {"d": 10, "w": 21, "m": 75, "q": 200, "a": 550}


def revision_numbers(silver: DataFrame) -> DataFrame:
    """revision_number: the rank of a vintage among those of its date; no realtime_start comes first."""
    order = Window.partitionBy(*KEY).orderBy(F.col("realtime_start").asc_nulls_first())
    return silver.withColumn("revision_number", F.row_number().over(order))


def latest_observation(silver: DataFrame) -> DataFrame:
    """The newest vintage of each date, by one hash aggregate."""
    rest = [c for c in silver.columns if c not in KEY]
    newest = F.max_by(F.struct(*rest), F.coalesce("realtime_start", F.lit("0001-01-01").cast("date")))
    return silver.groupBy(*KEY).agg(newest.alias("r")).select(*KEY, "r.*")


def point_in_time(silver: DataFrame) -> DataFrame:
    """Every vintage with the span in which it was the known one."""
    return silver.select(*KEY, "realtime_start", "realtime_end", "value")


def known_on(silver: DataFrame, as_of: str) -> DataFrame:
    day = F.lit(as_of).cast("date")
    started = F.col("realtime_start").isNull() | (F.col("realtime_start") <= day)
    still = F.col("realtime_end").isNull() | (F.col("realtime_end") == F.lit(OPEN_END).cast("date")) | (F.col("realtime_end") > day)
    return silver.filter(started & still)


def snapshot(silver: DataFrame, as_of: str) -> DataFrame:
    """Per series the last date that was known on as_of, and its value then."""
    order = F.struct("observation_date", F.coalesce("realtime_start", F.lit("0001-01-01").cast("date")))
    rest = [c for c in silver.columns if c != "series_id"]
    return known_on(silver, as_of).groupBy("series_id").agg(F.max_by(F.struct(*rest), order).alias("r")).select("series_id", "r.*")


def select_vintage(silver: DataFrame, as_of: str | None = None) -> DataFrame:
    """The first report of each date, or its newest vintage on as_of."""
    start = F.coalesce("realtime_start", F.lit("0001-01-01").cast("date"))
    if as_of is None:
        picked = F.min_by("value", start)
        rows = silver
    else:
        picked, rows = F.max_by("value", start), silver.filter(start <= F.lit(as_of).cast("date"))
    return rows.groupBy(*KEY).agg(picked.alias("value"))


def revision_stats(silver: DataFrame) -> DataFrame:
    """Per date: vintages, first and latest value, and the change between them. One aggregate, no self-join."""
    start = F.coalesce("realtime_start", F.lit("0001-01-01").cast("date"))
    out = silver.groupBy(*KEY).agg(
        F.count("*").alias("revision_count"), F.min_by("value", start).alias("first_value"), F.max_by("value", start).alias("latest_value"),
        F.min("realtime_start").alias("first_realtime"), F.max("realtime_start").alias("latest_realtime"),
    )
    delta = F.col("latest_value") - F.col("first_value")
    return out.withColumn("revision_delta", delta).withColumn("revision_pct", F.try_divide(delta, F.col("first_value")))


def revision_summary(silver: DataFrame) -> DataFrame:
    stats = revision_stats(silver)
    return stats.groupBy("series_id").agg(
        F.count("*").alias("n_dates"), F.avg("revision_count").alias("avg_revisions"), F.max("revision_count").alias("max_revisions"),
        F.avg(F.abs("revision_pct")).alias("avg_abs_pct"), F.max(F.abs("revision_pct")).alias("max_abs_pct"),
    )


def series_latest_value(latest: DataFrame) -> DataFrame:
    return latest.filter("value is not null").groupBy("series_id").agg(F.max("observation_date").alias("observation_date"), F.max_by("value", "observation_date").alias("value"))


def restate_start(silver: DataFrame, n: int) -> DataFrame:
    """The earliest of each series' n most recent dates, for all series at once."""
    order = Window.partitionBy("series_id").orderBy(F.col("observation_date").desc())
    dates = silver.select(*KEY).distinct().withColumn("k", F.row_number().over(order))
    return dates.filter(F.col("k") <= n).groupBy("series_id").agg(F.min("observation_date").alias("restate_from"), F.count("*").alias("n_dates"))


def latest_dates(silver: DataFrame) -> DataFrame:
    return silver.filter("value is not null").groupBy("series_id").agg(F.max("observation_date").alias("latest_date"))


def snapshots(silver: DataFrame, dates: DataFrame) -> DataFrame:
    """The newest vintage of each date on each of dates (as_of_date): one plan for a whole backfill.

    dates is a calendar of a bounded length; the range join broadcasts it.
    """
    start = F.coalesce("realtime_start", F.lit("0001-01-01").cast("date"))
    rows = silver.withColumn("_start", start).join(F.broadcast(dates), F.col("_start") <= F.col("as_of_date"))
    return rows.groupBy("as_of_date", *KEY).agg(F.max_by("value", "_start").alias("value"))


def source_coverage(silver: DataFrame, frequencies: DataFrame, today: str) -> DataFrame:
    """Per series: last date, dates, age, and whether it is older than its cadence allows."""
    seen = silver.groupBy("series_id").agg(F.max("observation_date").alias("latest_date"), F.countDistinct("observation_date").alias("n_dates"))
    age = F.datediff(F.lit(today).cast("date"), F.col("latest_date"))
    allowed = F.coalesce(*[F.when(F.col("frequency") == f, F.lit(d)) for f, d in STALE_DAYS.items()], F.lit(380))
    return seen.join(frequencies, "series_id", "left").withColumn("age_days", age).withColumn("is_stale", age > allowed)


def pricing_plan(constituents: DataFrame, priced: DataFrame, today: str, stale_days: int, limit: int) -> DataFrame:
    """Which tickers to price next: those without prices first, then stale ones, by their best rank. limit is the batch."""
    names = constituents.filter(F.col("ticker").rlike(r"^[A-Z][A-Z.\-]*$")).groupBy("ticker").agg(F.min("rank").alias("rank"))
    rows = names.join(priced, "ticker", "left")
    age = F.datediff(F.lit(today).cast("date"), F.col("latest_date"))
    rows = rows.withColumn("missing", F.col("latest_date").isNull()).filter(F.col("missing") | (age > stale_days))
    return rows.orderBy(F.col("missing").desc(), "rank", "ticker").limit(limit).select("ticker", "rank", "missing", "latest_date")
