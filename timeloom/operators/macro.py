"""Dashboards, inflation and policy rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import kernels as k

SPARK_POINTS, SURPRISE_WINDOW = 36, 12
INFLATION_FLAT, POLICY_FLAT, REAL_RATE_DAYS = 0.05, 1.0, 550


def dashboard(latest: DataFrame, catalog: DataFrame, surprise_window: int = SURPRISE_WINDOW) -> DataFrame:
    """One row per catalogued series at its latest date. catalog: (series_id, category, polarity), configuration."""
    obs = k.present(latest).select("series_id", "observation_date", "value").join(F.broadcast(catalog), "series_id")
    order, w = k.ordered("series_id"), k.expanding("series_id")
    before = order.rowsBetween(-surprise_window, -1)
    rows = obs.select(
        "*", F.lag("observation_date").over(order).alias("prior_date"), F.lag("value").over(order).alias("prior_value"), k.year_ago("value", "series_id").alias("ago"), k.zscore("value", w).alias("zscore"),
        F.count("value").over(before).alias("n_before"), F.avg("value").over(before).alias("mean_before"), F.stddev_pop("value").over(before).alias("std_before"),
        F.min("value").over(k.trailing(SPARK_POINTS, "series_id")).alias("spark_min"), F.max("value").over(k.trailing(SPARK_POINTS, "series_id")).alias("spark_max"),
    )
    rows = k.with_expanding_rank(rows, "value", ["series_id"], "below", "at_most").withColumn("n_obs", F.count("*").over(Window.partitionBy("series_id"))).filter("seen = n_obs")
    last = obs.agg(F.max("observation_date").alias("as_of_date"))
    rows = rows.crossJoin(F.broadcast(last))  # one row
    change = F.col("value") - F.col("prior_value")
    surprise = F.when(F.col("n_before") >= 2, F.col("value") - F.col("mean_before"))
    return rows.select(
        "series_id", "category", "polarity", F.col("observation_date").alias("latest_date"), "value", "prior_date", "prior_value", change.alias("change_abs"), k.pct_change(F.col("value"), F.col("prior_value")).alias("change_pct"),
        k.pct_change(F.col("value"), F.col("ago")).alias("yoy_pct"), "zscore", F.try_divide(F.col("below").cast("double"), F.col("seen") - 1).alias("percentile"), surprise.alias("surprise"), F.try_divide(surprise, F.col("std_before")).alias("surprise_z"),
        F.when((F.col("polarity") != 0) & (change != 0), F.col("polarity") * change > 0).alias("direction_is_good"), "spark_min", "spark_max", F.datediff("as_of_date", "observation_date").alias("staleness_days"),
    )


def sparkline(latest: DataFrame, points: int = SPARK_POINTS) -> DataFrame:
    """The last points of each series, numbered from 0."""
    rows = k.present(latest).withColumn("back", F.row_number().over(Window.partitionBy("series_id").orderBy(F.col("observation_date").desc()))).filter(F.col("back") <= points)
    return rows.select("series_id", (F.row_number().over(k.ordered("series_id")) - 1).alias("point_index"), "observation_date", "value")


def category_summary(board: DataFrame) -> DataFrame:
    n = F.count("direction_is_good")
    good = F.count_if(F.col("direction_is_good"))
    return board.groupBy("category").agg(F.count("*").alias("n_series"), good.alias("n_improving"), (n - good).alias("n_deteriorating"), F.try_divide(good.cast("double"), n).alias("breadth"), F.avg("zscore").alias("avg_zscore"), F.avg("surprise_z").alias("surprise_index"))


def inflation_explorer(latest: DataFrame, items: DataFrame) -> DataFrame:
    """Monthly rates by month number, so a gap gives null and never the wrong month. items: (series_id, label, basket, level, weight, waterfall), configuration."""
    obs = k.present(latest).join(F.broadcast(items), "series_id")
    month = F.year("observation_date") * 12 + F.month("observation_date") - 1
    months = obs.groupBy("series_id", "label", "basket", "level", "weight", "waterfall", month.alias("m")).agg(F.max("observation_date").alias("observation_date"), F.max_by("value", "observation_date").alias("value"))
    # The value n months before stands in a range frame of exactly that month number: no self-join.
    order = Window.partitionBy("series_id").orderBy("m")
    v = {n: F.max("value").over(order.rangeBetween(-n, -n)) for n in (1, 3, 12, 13, 2)}
    rows = months.select("*", *[c.alias(f"v{n}") for n, c in v.items()])
    mom, yoy = k.pct_change(F.col("value"), F.col("v1")), k.pct_change(F.col("value"), F.col("v12"))
    rows = rows.withColumn("mom_pct", mom).withColumn("yoy_pct", yoy)
    return rows.select(
        "series_id", "label", "basket", "level", "weight", "waterfall", "m", "observation_date", F.col("value").alias("index_value"), "mom_pct", "yoy_pct", (F.col("mom_pct") - k.pct_change(F.col("v1"), F.col("v2"))).alias("mom_accel"),
        (F.col("yoy_pct") - k.pct_change(F.col("v1"), F.col("v13"))).alias("yoy_accel"), F.when((F.col("v3") > 0) & (F.col("value") > 0), F.pow(F.col("value") / F.col("v3"), 4) - 1).alias("annualized_3m"), (F.col("weight") * F.col("mom_pct")).alias("contribution_pp"),
    )


def inflation_contribution(explorer: DataFrame) -> DataFrame:
    """Where the headline (level 0) printed: the waterfall items, largest first, and the headline's own rate in points."""
    head = explorer.filter("level = 0 and mom_pct is not null").select("basket", "m", F.col("series_id").alias("head"), (F.col("mom_pct") * 100).alias("total"))
    parts = explorer.filter("waterfall and contribution_pp is not null").join(head.select("basket", "m"), ["basket", "m"])
    rank = F.row_number().over(Window.partitionBy("basket", "m").orderBy(F.col("contribution_pp").desc(), "series_id"))
    parts = parts.select("basket", "m", "series_id", "contribution_pp", rank.alias("rank_in_month"), F.lit(False).alias("is_headline"))
    return parts.unionByName(head.select("basket", "m", F.col("head").alias("series_id"), F.col("total").alias("contribution_pp"), F.lit(None).cast("int").alias("rank_in_month"), F.lit(True).alias("is_headline")))


def yoy_percent(latest: DataFrame, countries: DataFrame) -> DataFrame:
    """Inflation in percent: given as such, or from an index against the value a year before. countries: (series_id, country, transform, target)."""
    rows = k.present(latest).select("series_id", "observation_date", "value").join(F.broadcast(countries), "series_id").withColumn("ago", k.year_ago("value", "series_id"))
    yoy = F.when(F.col("transform") == "level", F.col("value")).otherwise(k.pct_change(F.col("value"), F.col("ago")) * 100)
    return rows.select("series_id", "country", "target", "observation_date", yoy.alias("yoy")).filter("yoy is not null")


def global_inflation(latest: DataFrame, countries: DataFrame) -> DataFrame:
    """Change, trend and signed streak of each country's inflation; a flat print ends a streak."""
    rows = yoy_percent(latest, countries)
    order = k.ordered("series_id")
    rows = rows.withColumn("change", F.col("yoy") - F.lag("yoy").over(order))
    sign = F.when(F.col("change").isNull() | (F.abs("change") <= INFLATION_FLAT), 0).when(F.col("change") > 0, 1).otherwise(-1)
    rows = rows.withColumn("sgn", sign).withColumn("new", (F.col("sgn") != F.coalesce(F.lag("sgn").over(order), F.lit(9))).cast("int"))
    rows = rows.withColumn("grp", F.sum("new").over(k.expanding("series_id")))
    run = F.row_number().over(Window.partitionBy("series_id", "grp").orderBy("observation_date"))
    trend = F.when(F.col("change").isNull(), F.lit(None)).when(F.col("sgn") == 0, "flat").when(F.col("sgn") > 0, "accelerating").otherwise("cooling")
    return rows.select("series_id", "country", "observation_date", F.col("yoy").alias("yoy_pct"), F.col("change").alias("change_pp"), trend.alias("trend"), (F.col("sgn") * run).alias("streak"), (F.col("yoy") - F.col("target")).alias("vs_target"))


def policy_rates(rates: DataFrame, inflation: DataFrame) -> DataFrame:
    """rates: (country, observation_date, value); inflation: (country, observation_date, yoy), as of within 550 days."""
    rows = k.as_of(rates.select("country", "observation_date", "value"), inflation.select("country", "observation_date", "yoy"), ["country"], "observation_date", "yoy", REAL_RATE_DAYS)
    rows = rows.withColumn("change_bps", (F.col("value") - F.lag("value").over(k.ordered("country"))) * 100)
    rows = rows.withColumn("last_move_bps", F.last(F.when(F.abs("change_bps") > POLICY_FLAT, F.col("change_bps")), ignorenulls=True).over(k.expanding("country")))
    stance = F.when(F.col("last_move_bps") > 0, "hiking").when(F.col("last_move_bps") < 0, "cutting").when(F.abs("change_bps") <= POLICY_FLAT, "on-hold")
    return rows.select("country", "observation_date", F.col("value").alias("rate"), "change_bps", "last_move_bps", stance.alias("stance"), (F.col("value") - F.col("yoy")).alias("real_rate"))
