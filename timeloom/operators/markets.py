"""Curves, spreads, boards, funding, credit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import kernels as k

RECESSION_DAYS = 62
BOARD_TREND, BOARD_FLAT = 5, 0.01


def recession_flags(dates: DataFrame, flags: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """dates with is_recession: the last flag within 62 days, null where unknown. flags: (observation_date, flag), a short series."""
    known = flags.filter("flag is not null")
    order = Window.orderBy("observation_date")
    spans = known.select(F.col("observation_date").alias("_from"), F.col("flag").alias("is_recession"), F.lead("observation_date").over(order).alias("_next"))
    last = F.date_add("_from", RECESSION_DAYS + 1)
    spans = spans.withColumn("_to", F.least(last, F.coalesce("_next", last)))
    days = spans.select("is_recession", F.explode(F.sequence("_from", F.date_sub("_to", 1))).alias("_day"))
    # A row per calendar day of a flag series: some ten thousand at most.
    return dates.join(F.broadcast(days), F.col("observation_date") == F.col("_day"), "left").drop("_day")


def treasury_curve(obs: DataFrame, tenors: DataFrame) -> DataFrame:
    """tenors: (series_id, tenor_label, tenor_months), configuration."""
    return k.present(obs).join(F.broadcast(tenors), "series_id").select(F.col("observation_date").alias("as_of_date"), "tenor_label", "tenor_months", F.col("value").alias("yield_pct"))


def curve_metrics(curve: DataFrame) -> DataFrame:
    """Level, slopes, curvature, butterfly, inversions and the kind of move of each day's curve.

    The move compares with the level of the day before and the last slope that
    was known; that is the market's one curve, so its days are one window.
    """
    def y(m: int) -> Column:
        return F.max(F.when(F.col("tenor_months") == m, F.col("yield_pct")))

    days = curve.groupBy("as_of_date").agg(F.avg("yield_pct").alias("level"), *[y(m).alias(f"y{m}") for m in (3, 24, 60, 120, 360)])
    days = days.select(
        "as_of_date", "level", (F.col("y120") - F.col("y24")).alias("slope_10y2y"), (F.col("y120") - F.col("y3")).alias("slope_10y3m"),
        (2 * F.col("y60") - F.col("y24") - F.col("y120")).alias("curvature"), (2 * F.col("y120") - F.col("y24") - F.col("y360")).alias("butterfly"),
    )
    order = Window.orderBy("as_of_date")
    d_level = F.col("level") - F.lag("level").over(order)
    d_slope = F.col("slope_10y2y") - F.last("slope_10y2y", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    days = days.withColumn("dl", d_level).withColumn("ds", d_slope)
    rally, shape = F.when(F.col("dl") < 0, "bull").otherwise("bear"), F.when(F.col("ds") > 0, "steepener").otherwise("flattener")
    move = F.when((F.col("dl") != 0) & (F.col("ds") != 0), F.concat_ws("-", rally, shape)).when((F.col("dl") != 0) & (F.col("ds") == 0), F.concat(F.lit("parallel-"), rally)).when((F.col("dl") == 0) & (F.col("ds") != 0), F.concat(F.lit("twist-"), shape))
    return days.withColumn("curve_move", move).withColumn("inverted_10y2y", F.col("slope_10y2y") < 0).withColumn("inverted_10y3m", F.col("slope_10y3m") < 0).drop("dl", "ds")


def spread_daily(spreads: DataFrame) -> DataFrame:
    """z-score, percentile, basis points and the length of the run of inverted days so far. spreads: (name, observation_date, value)."""
    w = k.expanding("name")
    rows = spreads.withColumn("zscore", k.zscore("value", w)).withColumn("inverted", F.col("value") < 0)
    rows = rows.withColumn("grp", F.sum(F.when(F.col("inverted"), 0).otherwise(1)).over(w))
    rows = rows.withColumn("inversion_run", F.sum(F.col("inverted").cast("long")).over(Window.partitionBy("name", "grp").orderBy("observation_date").rowsBetween(Window.unboundedPreceding, 0)))
    ranked = k.with_expanding_rank(rows.drop("grp"), "value", ["name"], "below", "at_most")
    return ranked.withColumn("percentile", F.try_divide(F.col("below").cast("double"), F.col("seen") - 1)).withColumn("bps", F.col("value") * 100).drop("below", "at_most", "seen")


def inversion_episodes(spreads: DataFrame) -> DataFrame:
    """Runs of negative values: from the first negative date to the first date that isn't, which is null while it goes on."""
    w = k.expanding("name")
    rows = spreads.withColumn("inverted", F.col("value") < 0).withColumn("next_date", F.lead("observation_date").over(k.ordered("name")))
    rows = rows.withColumn("grp", F.sum(F.when(F.col("inverted"), 0).otherwise(1)).over(w)).filter("inverted")
    out = rows.groupBy("name", "grp").agg(
        F.min("observation_date").alias("start_date"), F.max_by("next_date", "observation_date").alias("end_date"), F.max("observation_date").alias("last_inverted"), F.count("*").alias("n_obs"),
        F.min(F.struct("value", "observation_date")).alias("trough"),
    )
    number = F.row_number().over(Window.partitionBy("name").orderBy("start_date"))
    return out.select("name", number.alias("episode"), "start_date", "end_date", "last_inverted", "n_obs", F.datediff(F.coalesce("end_date", "last_inverted"), "start_date").alias("calendar_days"), F.col("trough.value").alias("trough_value"), F.col("trough.observation_date").alias("trough_date"), F.col("end_date").isNull().alias("is_ongoing"))


def rate_board(latest: DataFrame, rates: DataFrame) -> DataFrame:
    """One row per rate at its latest date. rates: (series_id, label, benchmark), configuration."""
    obs = k.present(latest).select("series_id", "observation_date", "value")
    rows = obs.join(F.broadcast(rates), "series_id")
    order = k.ordered("series_id")
    rows = rows.withColumn("prior_value", F.lag("value").over(order)).withColumn("back", F.lag("value", BOARD_TREND).over(order)).withColumn("zscore", k.zscore("value", k.expanding("series_id")))
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("series_id").orderBy(F.col("observation_date").desc()))).filter("k = 1")
    bench = obs.select(F.col("series_id").alias("benchmark"), "observation_date", F.col("value").alias("bench_value"))
    rows = k.as_of(rows.select("series_id", "label", "benchmark", "observation_date", "value", "prior_value", "back", "zscore"), bench, ["benchmark"], "observation_date", "bench_value")
    delta = F.col("value") - F.col("back")
    trend = F.when(F.abs(delta) <= BOARD_FLAT, "flat").when(delta > 0, "rising").when(delta < 0, "falling")
    last = rows.agg(F.max("observation_date").alias("as_of_date"))
    rows = rows.crossJoin(F.broadcast(last)).withColumn("trend", trend)  # last: one row
    regime = F.when(F.col("trend") == "flat", "stable").when(F.col("trend") == "rising", "tightening").when(F.col("trend") == "falling", "easing")
    return rows.select(
        "series_id", "label", "benchmark", F.col("observation_date").alias("latest_date"), "value", "prior_value", ((F.col("value") - F.col("prior_value")) * 100).alias("change_bps"), "trend", regime.alias("regime"),
        ((F.col("value") - F.col("bench_value")) * 100).alias("spread_bps"), "zscore", F.datediff("as_of_date", "observation_date").alias("staleness_days"),
    )


def funding_tape(metrics: DataFrame) -> DataFrame:
    """metrics: (metric, kind, observation_date, value), levels and spreads alike, with expanding z-score and percentile."""
    rows = metrics.withColumn("zscore", k.zscore("value", k.expanding("metric")))
    ranked = k.with_expanding_rank(rows, "value", ["metric"], "below", "at_most")
    return ranked.withColumn("percentile", F.try_divide(F.col("below").cast("double"), F.col("seen") - 1)).drop("below", "at_most", "seen")


def funding_stress(tape: DataFrame, weights: DataFrame) -> DataFrame:
    """A score of 0 to 100 on dates that have all components. weights: (metric, weight), configuration; a z-score that isn't known yet counts as 0."""
    totals = weights.agg(F.count("*").alias("n_all"), F.sum("weight").alias("w_all"))
    days = tape.join(F.broadcast(weights), "metric").groupBy("observation_date").agg(F.count("*").alias("n"), F.sum(F.col("weight") * F.coalesce("zscore", F.lit(0.0))).alias("s"))
    days = days.crossJoin(F.broadcast(totals)).filter("n = n_all")  # totals: one row
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), 50 + 20 * F.col("composite_z")))
    days = days.withColumn("composite_z", F.col("s") / F.col("w_all")).withColumn("score", score)
    bucket = F.when(F.col("score") < 40, "calm").when(F.col("score") < 60, "normal").when(F.col("score") < 80, "elevated").otherwise("stressed")
    return days.select("observation_date", "composite_z", "score", bucket.alias("bucket"), F.col("n").alias("n_components"))


def credit_daily(obs: DataFrame, flags: DataFrame, stress: float = 0.9) -> DataFrame:
    """Option-adjusted spreads in basis points, with stress episodes and the recession flag. obs: (instrument, observation_date, value)."""
    rows = obs.withColumn("zscore", k.zscore("value", k.expanding("instrument"))).withColumn("change_bps", (F.col("value") - F.lag("value").over(k.ordered("instrument"))) * 100)
    ranked = k.with_expanding_rank(rows, "value", ["instrument"], "below", "at_most")
    rows = ranked.withColumn("percentile", F.try_divide(F.col("below").cast("double"), F.col("seen") - 1)).drop("below", "at_most", "seen")
    return recession_flags(rows.withColumn("oas_bps", F.col("value") * 100).withColumn("is_stress", F.col("percentile") >= stress), flags)
