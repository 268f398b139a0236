"""Prices, returns, constituents."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import kernels as k

VOL_WINDOWS = (21, 63, 126, 252)


def canonical_prices(first: DataFrame, second: DataFrame) -> DataFrame:
    """first (ticker, observation_date, close) for every ticker that it has, else second."""
    return first.unionByName(second.join(first.select("ticker").distinct(), "ticker", "left_anti"))


def returns(prices: DataFrame) -> DataFrame:
    """Daily change and return, and an index of 100 times the product of 1 + return."""
    rows = prices.withColumn("prev", F.lag("close").over(k.ordered("ticker")))
    rows = rows.withColumn("price_return", k.pct_change(F.col("close"), F.col("prev")))
    index = 100 * F.product(1 + F.coalesce("price_return", F.lit(0.0))).over(k.expanding("ticker"))
    return rows.select("ticker", "observation_date", "close", (F.col("close") - F.col("prev")).alias("price_change"), "price_return", index.alias("return_index"))


def constituents(holdings: DataFrame) -> DataFrame:
    """Rank by weight of each fund and date, the largest first, and whether the date is the fund's latest."""
    rank = F.row_number().over(Window.partitionBy("etf", "observation_date").orderBy(F.col("weight").desc(), "constituent"))
    last = F.max("observation_date").over(Window.partitionBy("etf"))
    return holdings.select("etf", "constituent", "observation_date", "weight", rank.alias("rank"), (F.col("observation_date") == last).alias("is_latest"))


def total_return(rows: DataFrame) -> DataFrame:
    """Price and total return chained to indexes, trailing 365-day dividends and yield. rows: (ticker, observation_date, close, dividend, split)."""
    days = F.datediff("observation_date", F.lit("1970-01-01").cast("date"))
    year = Window.partitionBy("ticker").orderBy(days).rangeBetween(-365, 0)
    w = k.expanding("ticker")
    rows = rows.withColumn("prev", F.lag("close").over(k.ordered("ticker")))
    rows = rows.withColumn("pr", F.try_divide(F.col("close") * F.col("split"), F.col("prev")) - 1).withColumn("tr", F.try_divide((F.col("close") + F.col("dividend")) * F.col("split"), F.col("prev")) - 1)
    rows = rows.withColumn("ttm_dividend", F.sum("dividend").over(year))
    return rows.select(
        "ticker", "observation_date", "close", F.col("pr").alias("price_return"), F.col("tr").alias("total_return"), (100 * F.product(1 + F.coalesce("pr", F.lit(0.0))).over(w)).alias("price_index"),
        (100 * F.product(1 + F.coalesce("tr", F.lit(0.0))).over(w)).alias("total_index"), "ttm_dividend", (F.try_divide("ttm_dividend", "close") * 100).alias("yield_pct"),
    )


def price_reconciliation(a: DataFrame, b: DataFrame, tolerance_pct: float = 2.0) -> DataFrame:
    both = a.select("ticker", "observation_date", F.col("close").alias("close_a")).join(b.select("ticker", "observation_date", F.col("close").alias("close_b")), ["ticker", "observation_date"])
    pct = k.pct_change(F.col("close_a"), F.col("close_b"))
    return both.withColumn("pct_diff", pct).withColumn("diverged", F.coalesce(F.abs(pct) * 100 > tolerance_pct, F.lit(False)))


def realized_volatility(prices: DataFrame, windows: tuple[int, ...] = VOL_WINDOWS) -> DataFrame:
    """Annualised population deviation of log returns over full windows, in percent.

    Windows of any width are differences of two running sums: one pass over a ticker.
    """
    prev = F.lag("close").over(k.ordered("ticker"))
    rows = prices.withColumn("r", F.when((F.col("close") > 0) & (prev > 0), F.ln(F.col("close") / prev))).filter("r is not null")
    order, so_far = k.ordered("ticker"), k.expanding("ticker")
    rows = rows.select("ticker", "observation_date", F.row_number().over(order).alias("n"), F.sum("r").over(so_far).alias("s1"), F.sum(F.col("r") * F.col("r")).over(so_far).alias("s2"))
    out = []
    for w in windows:
        mean, square = ((F.col(c) - F.coalesce(F.lag(c, w).over(order), F.lit(0.0))) / w for c in ("s1", "s2"))
        deviation = F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))
        out.append(F.when(F.col("n") >= w, F.struct(F.lit(w).alias("window_size"), (deviation * math.sqrt(252) * 100).alias("volatility_pct"))))
    rows = rows.select("ticker", "observation_date", F.array_compact(F.array(*out)).alias("vs"))
    return rows.select("ticker", "observation_date", F.explode("vs").alias("v")).select("ticker", "observation_date", "v.*")
