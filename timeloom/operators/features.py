"""Feature transforms, dense matrices, spreads and cross-series features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import bitemporal
from timeloom.operators import kernels as k

HEATMAP_WINDOWS = (12, 36, 60, 120)


def feature_transforms(latest: DataFrame) -> DataFrame:
    """value, mom, diff, yoy, zscore per series and date; all windows share one shuffle."""
    obs = k.present(latest).select("series_id", "observation_date", "value")
    before = F.lag("value").over(k.ordered("series_id"))
    return obs.select(
        "series_id", "observation_date", "value", k.pct_change(F.col("value"), before).alias("mom"), (F.col("value") - before).alias("diff"),
        k.pct_change(F.col("value"), k.year_ago("value", "series_id")).alias("yoy"), k.zscore("value", k.expanding("series_id")).alias("zscore"),
    )


def daily_matrix(latest: DataFrame) -> DataFrame:
    """A row per series and day from its first date to the last date of all; value and the value carried forward.

    A day stands once per gap instead of being joined: each row is spread over
    the days up to the next one, so no calendar join and no fill window is needed.
    """
    obs = k.present(latest).select("series_id", "observation_date", "value")
    last = obs.agg(F.max("observation_date").alias("last_date"))
    obs = obs.withColumn("next_date", F.lead("observation_date").over(k.ordered("series_id")))
    upto = F.coalesce(F.date_sub("next_date", 1), F.col("last_date"))  # last: one row
    days = obs.crossJoin(F.broadcast(last)).select("series_id", "observation_date", "value", F.explode(F.sequence("observation_date", upto)).alias("day"))
    return days.select("series_id", F.col("day").alias("observation_date"), F.when(F.col("day") == F.col("observation_date"), F.col("value")).alias("value"), F.col("value").alias("filled"))


def curve_spreads(latest: DataFrame, pairs: DataFrame) -> DataFrame:
    """name, op, observation_date, value: long minus or over short, on dates that both have. pairs: (name, op, long_leg, short_leg), configuration."""
    obs = k.present(latest).select("series_id", "observation_date", "value")
    legs = pairs.select("name", "op", F.explode(F.array(F.struct(F.col("long_leg").alias("series_id"), F.lit(1).alias("side")), F.struct(F.col("short_leg").alias("series_id"), F.lit(2).alias("side")))).alias("leg")).select("name", "op", "leg.*")
    rows = obs.join(F.broadcast(legs), "series_id").groupBy("name", "op", "observation_date").agg(F.max(F.when(F.col("side") == 1, F.col("value"))).alias("a"), F.max(F.when(F.col("side") == 2, F.col("value"))).alias("b"))
    value = F.when(F.col("op") == "ratio", F.try_divide("a", "b")).otherwise(F.col("a") - F.col("b"))
    return rows.filter("a is not null and b is not null").select("name", "op", "observation_date", value.alias("value")).filter("value is not null")


def cross_series(values: DataFrame, legs: DataFrame, basis: str | None = None) -> DataFrame:
    """Features of several legs on a common period. legs: (feature_name, op, freq, leg, series_id, weight), configuration."""
    obs = k.present(values).join(F.broadcast(legs), "series_id")
    start = F.coalesce(*[F.when(F.col("freq") == f, k.period_start(F.col("observation_date"), f)) for f in "wmqa"], F.col("observation_date"))
    each = obs.groupBy("feature_name", "op", "leg", "weight", start.alias("period")).agg(F.max_by("value", "observation_date").alias("value"))
    wanted = legs.groupBy("feature_name").agg(F.count("*").alias("n_legs"))
    rows = each.groupBy("feature_name", "op", "period").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("leg") == 0, F.col("value"))).alias("a"), F.max(F.when(F.col("leg") == 1, F.col("value"))).alias("b"), F.sum(F.col("weight") * F.col("value")).alias("s"),
    ).join(F.broadcast(wanted), "feature_name").filter("n = n_legs")
    value = F.when(F.col("op") == "spread", F.col("a") - F.col("b")).when(F.col("op") == "ratio", F.try_divide("a", "b")).otherwise(F.col("s"))
    out = rows.select("feature_name", "op", F.col("period").alias("observation_date"), value.alias("value")).filter("value is not null")
    return out.withColumn("basis", F.lit(basis)) if basis else out


def cross_series_pit(silver: DataFrame, legs: DataFrame, as_of: str | None = None) -> DataFrame:
    return cross_series(bitemporal.select_vintage(silver, as_of), legs, "as_of" if as_of else "first_report")


def reconciliation(latest: DataFrame, pairs: DataFrame, freq: str) -> DataFrame:
    """Two sources of one quantity, period by period. pairs: (name, series_a, series_b, tolerance_pct), configuration."""
    obs = k.downsampled(latest, freq)
    a = obs.join(F.broadcast(pairs), F.col("series_id") == F.col("series_a")).select("name", "period", F.col("value").alias("value_a"), "tolerance_pct")
    b = obs.join(F.broadcast(pairs), F.col("series_id") == F.col("series_b")).select("name", "period", F.col("value").alias("value_b"))
    diff = F.col("value_a") - F.col("value_b")
    pct = F.try_divide(diff, F.col("value_b"))
    return a.join(b, ["name", "period"]).select("name", F.col("period").alias("observation_date"), "value_a", "value_b", F.abs(diff).alias("abs_diff"), pct.alias("pct_diff"), F.coalesce(F.abs(pct) * 100 > F.col("tolerance_pct"), F.lit(False)).alias("diverged"))


def company_fundamentals(facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """The value of each concept per company and date: the tag of best priority, then the newest filing. concepts: (concept, tag, priority)."""
    order = Window.partitionBy("cik", "concept", "observation_date").orderBy("priority", F.col("realtime_start").desc(), "value")
    rows = facts.join(F.broadcast(concepts), "tag").withColumn("k", F.row_number().over(order))
    return rows.filter("k = 1").select("cik", "concept", "observation_date", "value", "tag")


def company_ratios(fundamentals: DataFrame, ratios: DataFrame) -> DataFrame:
    """ratios: (ratio, numerator, denominator); a zero denominator gives no row."""
    roles = ratios.select("ratio", F.explode(F.array(F.struct(F.col("numerator").alias("concept"), F.lit(1).alias("side")), F.struct(F.col("denominator").alias("concept"), F.lit(2).alias("side")))).alias("r")).select("ratio", "r.*")
    rows = fundamentals.join(F.broadcast(roles), "concept").groupBy("cik", "ratio", "observation_date").agg(F.max(F.when(F.col("side") == 1, F.col("value"))).alias("a"), F.max(F.when(F.col("side") == 2, F.col("value"))).alias("b"))
    return rows.select("cik", "ratio", "observation_date", F.try_divide("a", "b").alias("value")).filter("value is not null")


def ratio_ranks(ratios: DataFrame) -> DataFrame:
    w = Window.partitionBy("ratio", "observation_date")
    return ratios.select("cik", "ratio", "observation_date", "value", F.percent_rank().over(w.orderBy("value")).alias("pct_rank"), F.row_number().over(w.orderBy(F.col("value").desc(), "cik")).alias("position"))


def zscore_rolling(latest: DataFrame, windows: Sequence[int] = HEATMAP_WINDOWS) -> DataFrame:
    return k.rolling(k.present(latest).select("series_id", "observation_date", "value"), ["series_id"], windows, percentile=True)


def zscore_heatmap(latest: DataFrame, windows: Sequence[int] = HEATMAP_WINDOWS) -> DataFrame:
    """Expanding and rolling z-scores and percentiles side by side; null until a window is full."""
    obs = k.present(latest).select("series_id", "observation_date", "value").withColumn("z_full", k.zscore("value", k.expanding("series_id")))
    full = F.row_number().over(k.ordered("series_id"))
    for w in windows:
        frame = k.trailing(w, "series_id")
        pct = F.size(F.filter(F.collect_list("value").over(frame), k._at_most(F.col("value")))) / F.lit(w) * 100
        obs = obs.withColumn(f"z_{w}", F.when(full >= w, k.zscore("value", frame, k.FLAT))).withColumn(f"pct_{w}", F.when(full >= w, pct))
    ranked = k.with_expanding_rank(obs, "value", ["series_id"], "below", "at_most")
    return ranked.withColumn("pct_full", F.col("at_most") / F.col("seen") * 100).drop("below", "at_most", "seen")
