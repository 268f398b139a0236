"""Correlations, lead and lag, structural breaks, regimes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions import special
from timeloom.operators import kernels as k

REGIME_DAYS = 200


def transformed(obs: DataFrame, kind: str) -> DataFrame:
    """level, diff, mom or yoy of each series; rows without a result go."""
    rows = k.present(obs).select("series_id", "observation_date", "value")
    before = F.lag("value").over(k.ordered("series_id"))
    value = {"level": F.col("value"), "diff": F.col("value") - before, "mom": k.pct_change(F.col("value"), before), "yoy": k.pct_change(F.col("value"), k.year_ago("value", "series_id"))}[kind]
    return rows.select("series_id", "observation_date", value.alias("value")).filter("value is not null")


def aligned(obs: DataFrame, pairs: DataFrame, kind: str = "diff") -> DataFrame:
    """(pair, observation_date, a, b) on common dates. pairs: (pair, series_a, series_b), configuration."""
    rows = transformed(obs, kind)
    a = rows.join(F.broadcast(pairs), F.col("series_id") == F.col("series_a")).select("pair", "observation_date", F.col("value").alias("a"))
    b = rows.join(F.broadcast(pairs), F.col("series_id") == F.col("series_b")).select("pair", "observation_date", F.col("value").alias("b"))
    return a.join(b, ["pair", "observation_date"])


def correlation(both: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Rolling correlation over full windows; window 0 expands from three rows on."""
    n, out = F.row_number().over(k.ordered("pair")), []
    for w in windows:
        r = k.guarded_corr("a", "b", k.trailing(w, "pair") if w else k.expanding("pair"))
        out.append(F.when(n >= (w or 3), F.struct(F.lit(w).alias("window_size"), r.alias("correlation"))))
    rows = both.select("pair", "observation_date", F.array_compact(F.array(*out)).alias("cs"))
    return rows.select("pair", "observation_date", F.explode("cs").alias("c")).select("pair", "observation_date", "c.*")


def lead_lag(both: DataFrame, max_lag: int = 12) -> DataFrame:
    """(pair, lag, n, correlation, is_best): of a shifted against b; positive lags mean that a leads.

    Rows are numbered and joined at shifted numbers: one equi-join, a row per lag.
    """
    n = F.row_number().over(k.ordered("pair"))
    rows = both.withColumn("rn", n)
    shifted = rows.select("pair", "a", F.explode(F.sequence(F.lit(-max_lag), F.lit(max_lag))).alias("lag"), "rn").select("pair", "a", "lag", (F.col("rn") + F.col("lag")).alias("rn"))
    out = shifted.join(rows.select("pair", "rn", "b"), ["pair", "rn"]).groupBy("pair", "lag").agg(F.count("*").alias("n"), k.guarded_corr("a", "b").alias("correlation")).filter("n >= 3")
    best = F.first("lag").over(Window.partitionBy("pair").orderBy(F.round(F.abs("correlation"), 9).desc_nulls_last(), "lag"))
    return out.withColumn("is_best", F.col("lag") == best)


def granger(both: DataFrame, lags: int = 4) -> DataFrame:
    """F test, both ways, of adding the other series' lags to an autoregression: (pair, direction, f, p, n)."""

    def test(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("observation_date")
        out = []
        for direction, y, x in (("a_to_b", rows["b"], rows["a"]), ("b_to_a", rows["a"], rows["b"])):
            y, x = y.to_numpy(float), x.to_numpy(float)
            n = len(y) - lags
            f = p = None
            if n > 2 * lags + 1:
                own = np.column_stack([np.ones(n)] + [y[lags - i : len(y) - i] for i in range(1, lags + 1)])
                full = np.column_stack([own] + [x[lags - i : len(x) - i] for i in range(1, lags + 1)])
                rss = [float(((y[lags:] - m @ np.linalg.lstsq(m, y[lags:], rcond=None)[0]) ** 2).sum()) for m in (own, full)]
                d2 = n - 2 * lags - 1
                if rss[0] > 1e-12 and d2 > 0:
                    f = max(0.0, (rss[0] - rss[1]) / lags / (max(rss[1], 1e-12) / d2))
                    p = special.f_survival(f, lags, d2)
            out.append((rows["pair"].iloc[0], direction, f, p, len(y)))
        return pd.DataFrame(out, columns=["pair", "direction", "f", "p", "n"])

    return both.groupBy("pair").applyInPandas(test, "pair string, direction string, f double, p double, n long")


def _rss(n: Column, sx: Column, sy: Column, sxx: Column, sxy: Column, syy: Column) -> Column:
    vx, vy, cov = sxx - sx * sx / n, syy - sy * sy / n, sxy - sx * sy / n
    return vy - F.when(vx > k.FLAT, cov * cov / vx).otherwise(0.0)


def chow_scan(obs: DataFrame, keys: str = "series_id") -> DataFrame:
    """The break date with the largest Chow F of a linear trend, at least max(20, 15 %) rows from either end.

    Sums before and after every candidate are windows, so all candidates of a series cost one pass.
    """
    rows = obs.withColumn("x", F.row_number().over(k.ordered(keys)).cast("double")).withColumn("n", F.count("*").over(Window.partitionBy(keys)))
    parts = {"sx": F.col("x"), "sy": F.col("value"), "sxx": F.col("x") * F.col("x"), "sxy": F.col("x") * F.col("value"), "syy": F.col("value") * F.col("value")}
    w = k.expanding(keys)
    rows = rows.select("*", *[F.sum(c).over(w).alias(s) for s, c in parts.items()], *[F.sum(c).over(Window.partitionBy(keys)).alias(f"t{s}") for s, c in parts.items()])
    first = _rss(F.col("x"), *[F.col(s) for s in parts])
    second = _rss(F.col("n") - F.col("x"), *[F.col(f"t{s}") - F.col(s) for s in parts])
    whole = _rss(F.col("n"), *[F.col(f"t{s}") for s in parts])
    trim = F.greatest(F.lit(20), F.floor(F.col("n") * 0.15))
    apart = first + second
    f = F.when(apart > k.FLAT, ((whole - apart) / 2) / (apart / (F.col("n") - 4)))
    rows = rows.filter((F.col("x") >= trim) & (F.col("n") - F.col("x") >= trim)).withColumn("f", f).filter("f is not null")
    out = rows.groupBy(keys).agg(F.max(F.struct(F.round("f", 9).alias("f"), (-F.col("x")).alias("neg"), "observation_date", "n")).alias("b"))
    return out.select(keys, F.col("b.observation_date").alias("break_date"), F.col("b.f").alias("f_stat"), F.col("b.n").alias("n_obs"))


def cusum(obs: DataFrame, keys: str = "series_id") -> DataFrame:
    """Cumulated residuals of a linear trend: the first date beyond 1.358 sqrt(n), else the peak; and its bound on p."""
    rows = obs.withColumn("x", F.row_number().over(k.ordered(keys)).cast("double"))
    whole = Window.partitionBy(keys)
    n = F.count("*").over(whole)
    rows = rows.withColumn("n", n).withColumn("mx", F.avg("x").over(whole)).withColumn("my", F.avg("value").over(whole))
    cx, cy = F.col("x") - F.col("mx"), F.col("value") - F.col("my")
    slope = F.sum(cx * cy).over(whole) / F.sum(cx * cx).over(whole)
    rows = rows.filter("n > 2").withColumn("slope", slope).withColumn("e", cy - F.col("slope") * cx)
    rows = rows.withColumn("sigma", F.sqrt(F.sum(F.col("e") * F.col("e")).over(whole) / (F.col("n") - 2))).filter("sigma > 1e-12")
    rows = rows.withColumn("s", F.sum("e").over(k.expanding(keys)) / F.col("sigma") / F.sqrt("n"))
    crossed = F.min(F.when(F.abs("s") > 1.358, F.col("observation_date")))
    out = rows.groupBy(keys).agg(crossed.alias("crossed"), F.max_by("observation_date", F.struct(F.round(F.abs("s"), 9), -F.col("x"))).alias("peak"), F.max(F.abs("s")).alias("stat"), F.max("n").alias("n_obs"))
    return out.select(keys, F.coalesce("crossed", "peak").alias("break_date"), "stat", F.least(F.lit(1.0), 2 * F.exp(-2 * F.col("stat") * F.col("stat"))).alias("p_value"), F.col("crossed").isNotNull().alias("is_break"), "n_obs")


def structural_breaks(obs: DataFrame, keys: str = "series_id") -> DataFrame:
    """Both tests as rows, with p and the means before and after."""
    chow, cus = chow_scan(obs, keys), cusum(obs, keys)

    @F.pandas_udf("double")
    def p_of(f: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([special.f_survival(x, 2, m - 4) for x, m in zip(f, n, strict=True)])

    both = chow.select(keys, F.lit("chow").alias("test"), "break_date", F.col("f_stat").alias("stat"), p_of("f_stat", "n_obs").alias("p_value"), "n_obs").unionByName(cus.select(keys, F.lit("cusum").alias("test"), "break_date", "stat", "p_value", "n_obs"))
    sides = both.join(obs.select(keys, "observation_date", "value"), keys).groupBy(keys, "test").agg(F.avg(F.when(F.col("observation_date") < F.col("break_date"), F.col("value"))).alias("mean_before"), F.avg(F.when(F.col("observation_date") >= F.col("break_date"), F.col("value"))).alias("mean_after"))
    return both.join(sides, [keys, "test"])


def regime(obs: DataFrame, inputs: DataFrame, pillars: dict[str, float], rules: Sequence[tuple[str, Sequence[tuple[str, str, float]]]], default: str) -> DataFrame:
    """Pillar scores and the first rule that holds, on dates where every pillar has an input not older than 200 days.

    inputs: (pillar, series_id, direction, weight), configuration; pillars: composite weights; a rule is (name, [(pillar, '>' or '<', threshold)]).
    """
    rows = obs.join(F.broadcast(inputs), "series_id").withColumn("z", k.zscore("value", k.expanding("pillar", "series_id"))).filter("z is not null")
    rows = rows.select("pillar", "series_id", "weight", "observation_date", (F.col("z") * F.col("direction")).alias("z"))
    dates = rows.select("observation_date").distinct()
    spine = dates.join(F.broadcast(inputs.select("pillar", "series_id", "weight")))  # configuration: a few rows
    live = k.as_of(spine, rows.select("pillar", "series_id", "observation_date", "z"), ["pillar", "series_id"], "observation_date", "z", REGIME_DAYS).filter("z is not null")
    scores = live.groupBy("observation_date", "pillar").agg((F.sum(F.col("weight") * F.col("z")) / F.sum("weight")).alias("score"))
    wide = scores.groupBy("observation_date").agg(F.count("*").alias("n"), *[F.max(F.when(F.col("pillar") == p, F.col("score"))).alias(p) for p in pillars]).filter(F.col("n") == len(pillars))
    name, margin = F.lit(default), F.lit(None).cast("double")
    for rule, conditions in reversed(list(rules)):
        holds, gap = F.lit(True), None
        for p, op, t in conditions:
            holds = holds & ((F.col(p) > t) if op == ">" else (F.col(p) < t))
            one = F.abs(F.col(p) - t)
            gap = one if gap is None else F.least(gap, one)
        name, margin = F.when(holds, rule).otherwise(name), F.when(holds, gap).otherwise(margin)
    total = sum(abs(w) for w in pillars.values()) or 1.0
    composite = sum((F.col(p) * w for p, w in pillars.items()), F.lit(0.0)) / total
    return wide.select("observation_date", *pillars, composite.alias("composite"), name.alias("regime"), margin.alias("confidence"))
