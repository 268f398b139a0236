"""Checks, gates, reconciliation and licences: one aggregate per question, for all series at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEVERITY = {"non_empty": "ERROR", "no_duplicate_keys": "ERROR", "dates_parseable": "ERROR", "values_numeric": "ERROR", "missing_ratio": "WARN", "no_future_dates": "WARN", "value_bounds": "ERROR", "freshness": "WARN"}


def run_checks(raw: DataFrame, bounds: DataFrame, today: str, max_missing: float = 0.5, stale_days: int = 90) -> DataFrame:
    """(series_id, check_name, severity, passed, metric). raw: (series_id, observation_date string, realtime_start, raw_value); bounds: (series_id, min_value, max_value)."""
    date, value = F.expr("try_cast(observation_date as date)"), F.expr("try_cast(replace(trim(raw_value), ',', '') as double)")
    blank = F.trim(F.coalesce("raw_value", F.lit(""))).isin("", ".")
    now = F.to_date(F.lit(today))
    rows = raw.join(bounds, "series_id", "left").withColumn("d", date).withColumn("v", value).withColumn("blank", blank)
    # Duplicates are counted by grouping on the key first: rows of a key meet map-side.
    keyed = rows.groupBy("series_id", "observation_date", "realtime_start").agg(
        F.count("*").alias("n"), F.count_if(F.col("d").isNull()).alias("bad_date"), F.count_if(F.col("v").isNull() & ~F.col("blank")).alias("bad_value"), F.count_if(F.col("blank")).alias("missing"),
        F.count_if(F.col("d") > now).alias("future"), F.count_if((F.col("v") < F.col("min_value")) | (F.col("v") > F.col("max_value"))).alias("outside"), F.max("d").alias("last"),
    )
    per = keyed.groupBy("series_id").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("dup"), *[F.sum(c).alias(c) for c in ("bad_date", "bad_value", "missing", "future", "outside")], F.max("last").alias("last"))
    ratio, age = F.col("missing") / F.col("n"), F.datediff(now, F.col("last"))
    checks = {
        "non_empty": (F.col("n") > 0, F.col("n")), "no_duplicate_keys": (F.col("dup") == 0, F.col("dup")), "dates_parseable": (F.col("bad_date") == 0, F.col("bad_date")), "values_numeric": (F.col("bad_value") == 0, F.col("bad_value")),
        "missing_ratio": (ratio <= max_missing, ratio), "no_future_dates": (F.col("future") == 0, F.col("future")), "value_bounds": (F.col("outside") == 0, F.col("outside")), "freshness": (F.coalesce(age <= stale_days, F.lit(False)), age),
    }
    out = F.array(*[F.struct(F.lit(c).alias("check_name"), F.lit(SEVERITY[c]).alias("severity"), ok.alias("passed"), m.cast("double").alias("metric")) for c, (ok, m) in checks.items()])
    return per.select("series_id", F.explode(out).alias("c")).select("series_id", "c.*")


def gate(checks: DataFrame, profiles: DataFrame) -> DataFrame:
    """(series_id, profile, passed): strict needs all, standard the errors, lenient nothing. profiles: (series_id, profile)."""
    rows = checks.join(profiles, "series_id", "left").withColumn("profile", F.coalesce("profile", F.lit("standard")))
    blocks = ~F.col("passed") & ((F.col("profile") == "strict") | ((F.col("profile") == "standard") & (F.col("severity") == "ERROR")))
    return rows.groupBy("series_id", "profile").agg((~F.bool_or(blocks)).alias("passed"))


def drift(spec: DataFrame, seen: DataFrame) -> DataFrame:
    """(series_id, field, expected, found) where the metadata seen differs from what the manifest says."""
    fields = [c for c in spec.columns if c != "series_id"]
    both = spec.alias("a").join(seen.alias("b"), "series_id")
    parts = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"a.{c}").cast("string").alias("expected"), F.col(f"b.{c}").cast("string").alias("found")) for c in fields])
    return both.select("series_id", F.explode(parts).alias("x")).select("series_id", "x.*").filter("not expected <=> found")


def manifest_duplicates(specs: DataFrame) -> DataFrame:
    return specs.groupBy("series_id").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("manifest")), ",").alias("manifests")).filter("n > 1")


def licence_gate(usage: DataFrame, register: DataFrame, today: str, review_days: int = 365) -> DataFrame:
    """(source, n_series, commercial_ok, review_due): a source without an entry is neither. register: (source, commercial, reviewed)."""
    per = usage.groupBy("source").agg(F.countDistinct("series_id").alias("n_series"))
    due = F.datediff(F.to_date(F.lit(today)), F.col("reviewed")) > review_days
    return per.join(F.broadcast(register), "source", "left").select("source", "n_series", F.coalesce("commercial", F.lit(False)).alias("commercial_ok"), F.coalesce(due, F.lit(True)).alias("review_due"))


def discover(catalogue: DataFrame, min_popularity: int, frequencies: list[str]) -> DataFrame:
    """Catalogue entries worth a series, with a priority by popularity."""
    rows = catalogue.filter((F.col("popularity") >= min_popularity) & F.col("frequency").isin(frequencies))
    p = F.col("popularity")
    return rows.withColumn("priority", F.when(p >= 80, 1).when(p >= 60, 2).when(p >= 40, 3).when(p >= 20, 4).otherwise(5))
