"""Factor, anomaly, recession, curve and forecast models.

What reduces to windows and joins is native; the fits are small dense problems,
one group each, solved with numpy inside grouped Arrow functions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions import special
from timeloom.operators import kernels as k


def feature_matrix(transforms: DataFrame, features: DataFrame) -> DataFrame:
    """features: (feature_name, series_id, transform), configuration; nulls go."""
    value = F.coalesce(*[F.when(F.col("transform") == c, F.col(c)) for c in ("value", "mom", "diff", "yoy", "zscore")])
    rows = transforms.join(F.broadcast(features), "series_id").select("observation_date", "feature_name", "series_id", "transform", value.alias("_v"))
    return rows.filter("_v is not null").withColumnRenamed("_v", "value")


def month_ends(matrix: DataFrame) -> DataFrame:
    """(feature_name, month, value): what is there on the last date of each month that has any feature; others of that month are missing."""
    last = matrix.groupBy(F.last_day("observation_date").alias("month")).agg(F.max("observation_date").alias("observation_date"))
    return matrix.join(last, "observation_date").groupBy("feature_name", "month").agg(F.max("value").alias("value"))


def pca_factors(months: DataFrame, n_factors: int = 5, min_obs: int = 30) -> DataFrame:
    """(month, kind, factor, feature, value): expanding principal components of the features' sample covariance; scores, shares and loadings.

    A month with fewer than half of the features (two at least) is left out. A
    missing feature counts as the mean of the months before. The score is that of
    the month less the mean; the largest loading is positive. Every month sees its
    past only, so the months of one matrix are one sequential group. It holds a
    row per month: natively reduced, a few hundred.
    """

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        wide = rows.pivot(index="month", columns="feature_name", values="value").sort_index()
        names, out, past = list(wide.columns), [], []
        if len(names) < 2:
            return pd.DataFrame(columns=["month", "kind", "factor", "feature", "value"])
        for month, row in zip(wide.index, wide.to_numpy(float), strict=True):
            here = ~np.isnan(row)
            if here.sum() < max(2, len(names) // 2):
                continue
            past.append(np.where(here, row, np.mean(past, axis=0) if past else 0.0))
            if len(past) < max(min_obs, 2):
                continue
            centred = np.array(past) - np.mean(past, axis=0)
            covariance = centred.T @ centred / (len(past) - 1)
            trace = float(np.trace(covariance))
            if trace <= 0:
                continue
            values, vectors = np.linalg.eigh(covariance)
            for f in range(min(n_factors, len(names))):
                ev, v = values[-1 - f], vectors[:, -1 - f]
                if ev <= 1e-12 * trace:
                    break
                v = v * np.sign(v[np.argmax(np.abs(v))])
                out.append((month, "score", f + 1, "", float(centred[-1] @ v)))
                out.append((month, "share", f + 1, "", float(ev / trace)))
                out += [(month, "loading", f + 1, n, float(x)) for n, x in zip(names, v, strict=True)]
        return pd.DataFrame(out, columns=["month", "kind", "factor", "feature", "value"])

    return months.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(fit, "month date, kind string, factor int, feature string, value double")


def anomaly_distance(scores: DataFrame, min_obs: int = 20) -> DataFrame:
    """Squared distance of a date's factors from their past, in expanding sample variances; dates where all have min_obs rows.

    scores: (observation_date, factor, score). k, the degrees of freedom, counts the factors that have varied; a date without one has no row.
    """
    w = k.expanding("factor")
    rows = scores.withColumn("n", F.count("*").over(w)).withColumn("m", F.avg("score").over(w)).withColumn("v", F.var_samp("score").over(w))
    d2 = F.sum(F.when(F.col("v") > k.FLAT, (F.col("score") - F.col("m")) * (F.col("score") - F.col("m")) / F.col("v")).otherwise(0.0))
    days = rows.groupBy("observation_date").agg(F.min("n").alias("n"), d2.alias("d2"), F.count_if(F.col("v") > k.FLAT).alias("k"))
    return days.filter((F.col("n") >= min_obs) & (F.col("k") > 0)).select("observation_date", "d2", "k")


def anomaly_scores(scores: DataFrame, alpha: float = 0.01) -> DataFrame:
    @F.pandas_udf("double")
    def p_of(d2: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([special.chi2_survival(x, m) for x, m in zip(d2, n, strict=True)])

    return anomaly_distance(scores).withColumn("p_value", p_of("d2", "k")).withColumn("is_anomaly", F.col("p_value") < alpha)


def recession_labels(dates: DataFrame, flags: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """(observation_date, horizon, label): is there a flag in the months after the date? Only where they are all observed. flags: monthly (observation_date, flag)."""
    last = flags.agg(F.max("observation_date").alias("last"))
    rows = dates.select("observation_date", F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon"))
    rows = rows.crossJoin(F.broadcast(last)).filter(F.expr("add_months(observation_date, horizon) <= last"))  # one row
    ahead = rows.select("observation_date", "horizon", F.explode(F.expr("sequence(1, horizon)")).alias("i"))
    ahead = ahead.withColumn("month", F.expr("trunc(add_months(observation_date, i), 'month')"))
    marks = flags.select(F.trunc("observation_date", "month").alias("month"), F.col("flag").cast("int").alias("flag"))
    return ahead.join(marks, "month", "left").groupBy("observation_date", "horizon").agg((F.coalesce(F.max("flag"), F.lit(0)) == 1).alias("label"))


def ridge_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, steps: int = 25, close: float = 1e-7) -> np.ndarray:
    """Newton steps on a ridge logistic regression, the intercept penalised as well."""
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * b)
        b = b + step
        if np.abs(step).max() < close:
            break
    return b


def recession_probability(features: DataFrame, labels: DataFrame, names: Sequence[str], min_obs: int = 60) -> DataFrame:
    """(observation_date, horizon, probability, n_train): at each date a fit on labels whose window had ended by then.

    features: (observation_date, names…). A fit per month and horizon, so the
    horizons are groups of their own and a group holds a row per month.
    """
    rows = features.join(labels, "observation_date", "left")
    every = features.select("observation_date", *names).crossJoin(F.broadcast(labels.select("horizon").distinct()))  # horizons: a few
    rows = every.join(labels, ["observation_date", "horizon"], "left")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("observation_date").reset_index(drop=True)
        h = int(group["horizon"].iloc[0])
        x = np.column_stack([np.ones(len(group)), group[list(names)].fillna(0).to_numpy(float)])
        days = pd.to_datetime(group["observation_date"])
        out = []
        for i in range(len(group)):
            known = ((days + pd.DateOffset(months=h)) <= days[i]).to_numpy() & group["label"].notna().to_numpy()
            if known.sum() < min_obs:
                continue
            b = ridge_logistic(x[known], group["label"].to_numpy()[known].astype(float))
            out.append((group["observation_date"][i], h, float(1 / (1 + np.exp(-np.clip(x[i] @ b, -30, 30)))), int(known.sum())))
        return pd.DataFrame(out, columns=["observation_date", "horizon", "probability", "n_train"])

    return rows.groupBy("horizon").applyInPandas(fit, "observation_date date, horizon int, probability double, n_train long")


def monthly_returns(prices: DataFrame) -> DataFrame:
    """Compounded daily returns of each ticker and month."""
    rows = prices.withColumn("r", k.pct_change(F.col("close"), F.lag("close").over(k.ordered("ticker")))).filter("r is not null")
    return rows.groupBy("ticker", F.trunc("observation_date", "month").alias("month")).agg((F.product(1 + F.col("r")) - 1).alias("ret"), F.count("*").alias("n_days"))


def factor_attribution(returns: DataFrame, factors: DataFrame, names: Sequence[str], windows: Sequence[int] = (12, 36, 60), min_obs: int = 12) -> DataFrame:
    """(ticker, month, window_size, factor, beta, t_stat, r2, n): regressions over the last factor months. factors: (month, names…).

    A ticker is a group, and solves all its windows: tickers are independent.
    """
    order = Window.orderBy("month")
    numbered = factors.withColumn("idx", F.row_number().over(order))  # one row per month of the factor model
    rows = returns.join(F.broadcast(numbered), "month")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("month").reset_index(drop=True)
        x_all, y_all, idx, out = group[list(names)].to_numpy(float), group["ret"].to_numpy(float), group["idx"].to_numpy(), []
        for i in range(len(group)):
            for w in windows:
                if i + 1 < w or idx[i] - idx[i - w + 1] != w - 1 or w < min_obs:
                    continue
                x, y = np.column_stack([np.ones(w), x_all[i - w + 1 : i + 1]]), y_all[i - w + 1 : i + 1]
                free = w - x.shape[1]
                if free < 1:
                    continue
                gram = x.T @ x
                inverse = np.linalg.pinv(gram, hermitian=True)
                b = inverse @ x.T @ y
                e = y - x @ b
                s2, tss = float(e @ e) / free, float(((y - y.mean()) ** 2).sum())
                se = np.sqrt(np.maximum(np.diag(inverse) * s2, 0))
                r2 = 1 - float(e @ e) / tss if tss > 1e-15 else None
                for j, name in enumerate(["alpha", *names]):
                    out.append((group["ticker"][0], group["month"][i], w, name, float(b[j]), float(b[j] / se[j]) if se[j] > 0 else None, r2, w))
        return pd.DataFrame(out, columns=["ticker", "month", "window_size", "factor", "beta", "t_stat", "r2", "n"])

    return rows.groupBy("ticker").applyInPandas(fit, "ticker string, month date, window_size int, factor string, beta double, t_stat double, r2 double, n long")


def implied_returns(returns: DataFrame, betas: DataFrame, factors: DataFrame) -> DataFrame:
    """Alpha plus betas, as of the month, times factors; and what is left of the return. betas: (ticker, month, factor, beta); factors: (month, factor, score) with alpha as 1."""
    months = returns.select("ticker", "month", "ret")
    names = betas.select("factor").distinct()
    spine = months.crossJoin(F.broadcast(names)).withColumnRenamed("month", "observation_date")  # factors: a few
    held = k.as_of(spine, betas.withColumnRenamed("month", "observation_date"), ["ticker", "factor"], "observation_date", "beta").withColumnRenamed("observation_date", "month")
    parts = held.filter("beta is not null").join(factors, ["month", "factor"])
    out = parts.groupBy("ticker", "month").agg(F.sum(F.col("beta") * F.col("score")).alias("implied"), F.max("ret").alias("ret"))
    return out.withColumn("residual", F.col("ret") - F.col("implied"))


def nelson_siegel(curve: DataFrame, decay: float = 1.7, worst: float = 0.10) -> DataFrame:
    """(as_of_date, level, slope, curvature, lambda, rmse, n_tenors): least squares per day, a grid of decays where the fit is poor."""

    def loadings(years: np.ndarray, lam: float) -> np.ndarray:
        t = years / lam
        g = (1 - np.exp(-t)) / t
        return np.column_stack([np.ones(len(t)), g, g - np.exp(-t)])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for day, rows in group.groupby("as_of_date"):
            years, y = rows["tenor_months"].to_numpy(float) / 12, rows["yield_pct"].to_numpy(float)
            if len(y) < 4:
                continue
            best = None
            for lam in [decay, *np.arange(0.5, 5.01, 0.1)]:
                x = loadings(years, lam)
                b = np.linalg.lstsq(x, y, rcond=None)[0]
                rmse = float(np.sqrt(((y - x @ b) ** 2).mean()))
                if best is None or rmse < best[1] - 1e-12:
                    best = (b, rmse, float(lam))
                if lam == decay and rmse <= worst:
                    break
            out.append((day, *map(float, best[0]), best[2], best[1], len(y)))
        return pd.DataFrame(out, columns=["as_of_date", "level", "slope", "curvature", "lambda", "rmse", "n_tenors"])

    # Days are independent: many of them share one call, and months spread over the cluster.
    rows = curve.withColumn("_month", F.trunc("as_of_date", "month"))
    return rows.groupBy("_month").applyInPandas(lambda g: fit(g), "as_of_date date, level double, slope double, curvature double, lambda double, rmse double, n_tenors long")


def monthly_change(index: DataFrame) -> DataFrame:
    """Change against the row 25 to 40 days before, where that was positive."""
    order = k.ordered("series_id")
    prev, gap = F.lag("value").over(order), F.datediff("observation_date", F.lag("observation_date").over(order))
    rows = index.withColumn("prev", prev).withColumn("gap", gap).filter("gap between 25 and 40 and prev > 0")
    return rows.select("series_id", "observation_date", ((F.col("value") / F.col("prev") - 1) * 100).alias("mom"))


def forecasts(changes: DataFrame, horizons: Sequence[int] = (1, 3, 6, 12), draws: int = 500, seed: int = 42) -> DataFrame:
    """(series_id, horizon, mean, p10, p90, order): an autoregression chosen by BIC, run forward, with resampled residuals.

    Each series and horizon draws from a generator of its own, so results don't depend on how series are dealt.
    """

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        y = group.sort_values("observation_date")["mom"].to_numpy(float)
        name, out, best = group["series_id"].iloc[0], [], None
        for p in range(1, min(12, len(y) // 4) + 1):
            x = np.column_stack([np.ones(len(y) - p)] + [y[p - i : len(y) - i] for i in range(1, p + 1)])
            b = np.linalg.lstsq(x, y[p:], rcond=None)[0]
            e = y[p:] - x @ b
            bic = len(e) * np.log(max(float(e @ e) / len(e), 1e-12)) + (p + 1) * np.log(len(e))
            if best is None or bic < best[0]:
                best = (bic, p, b, e)
        if best is None:
            return pd.DataFrame(columns=["series_id", "horizon", "mean", "p10", "p90", "ar_order"])
        _, p, b, e = best
        for h in horizons:
            rng = np.random.default_rng([seed, h, *name.encode()])
            paths = np.tile(y[-p:], (draws + 1, 1))
            shocks = np.vstack([np.zeros(h), rng.choice(e - e.mean(), (draws, h))])
            for t in range(h):
                step = b[0] + paths[:, ::-1][:, :p] @ b[1:] + shocks[:, t]
                paths = np.column_stack([paths, step])
            ends = np.sort(paths[1:, -1])
            out.append((name, h, float(paths[0, -1]), float(ends[draws // 10]), float(ends[draws * 9 // 10]), p))
        return pd.DataFrame(out, columns=["series_id", "horizon", "mean", "p10", "p90", "ar_order"])

    return changes.groupBy("series_id").applyInPandas(fit, "series_id string, horizon int, mean double, p10 double, p90 double, ar_order int")


def pair_forecasts(changes: DataFrame, pairs: DataFrame, horizons: Sequence[int] = (1, 3, 6, 12), draws: int = 500, seed: int = 42) -> DataFrame:
    """(series_id, horizon, mean, p10, p90, order): a vector autoregression of two series over their common dates, as in forecasts().

    pairs: (first, second), configuration. Residuals of both series are drawn together. Where equations can't be solved, a number of lags is left out.
    """

    def design(y: np.ndarray, p: int) -> np.ndarray:
        return np.column_stack([np.ones(len(y) - p), *[y[p - i : len(y) - i] for i in range(1, p + 1)]])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        y = group.sort_values("observation_date")[["x", "y"]].to_numpy(float)
        names, out, best = group[["first", "second"]].iloc[0].tolist(), [], None
        for p in range(1, max(1, min(4, len(y) // 8)) + 1):
            if len(y) - p <= 1 + 2 * p:
                break
            x = design(y, p)
            b, _, rank, _ = np.linalg.lstsq(x, y[p:], rcond=None)
            if rank < x.shape[1]:
                continue
            e = y[p:] - x @ b
            det = float(np.linalg.det(e.T @ e / len(e)))
            bic = len(e) * np.log(det) + 2 * (1 + 2 * p) * np.log(len(e)) if det > 0 else np.inf
            if best is None or bic < best[0]:
                best = (bic, p, b, e)
        if best is None:
            return pd.DataFrame(columns=["series_id", "horizon", "mean", "p10", "p90", "ar_order"])
        _, p, b, e = best
        for h in horizons:
            rng = np.random.default_rng([seed, h, *"|".join(names).encode()])
            paths = np.tile(y[-p:], (draws + 1, 1, 1))
            picks = rng.integers(0, len(e), (draws, h))
            for t in range(h):
                shocks = np.vstack([np.zeros((1, 2)), e[picks[:, t]]])
                lags = paths[:, ::-1][:, :p].reshape(draws + 1, 2 * p)
                paths = np.concatenate([paths, (b[0] + lags @ b[1:] + shocks)[:, None]], axis=1)
            for j, name in enumerate(names):
                ends = np.sort(paths[1:, -1, j])
                out.append((name, h, float(paths[0, -1, j]), float(ends[draws // 10]), float(ends[draws * 9 // 10]), p))
        return pd.DataFrame(out, columns=["series_id", "horizon", "mean", "p10", "p90", "ar_order"])

    x = changes.select(F.col("series_id").alias("first"), "observation_date", F.col("mom").alias("x"))
    y = changes.select(F.col("series_id").alias("second"), "observation_date", F.col("mom").alias("y"))
    rows = x.join(F.broadcast(pairs), "first").join(y, ["second", "observation_date"])
    return rows.groupBy("first", "second").applyInPandas(fit, "series_id string, horizon int, mean double, p10 double, p90 double, ar_order int")


def meeting_path(rates: Sequence[tuple[int, float]], meetings: Sequence[int], step: float = 0.25, rungs: int = 7) -> list[tuple]:
    """Rates implied between meetings by a zero curve, and a ladder of outcomes: (day, before, after, outcome_bps, probability).

    rates: (days, percent) points of the curve, flat beyond its ends; meetings: days from today. A dozen rows: driver arithmetic.
    """
    days, zero = (np.array(x, float) for x in zip(*sorted(rates), strict=True))
    bounds = [0, *meetings, meetings[-1] + 45]
    forward = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        a, b = (float(np.interp(t, days, zero)) for t in (lo, hi))
        forward.append((b * hi - a * lo) / (hi - lo))
    out = []
    for i, day in enumerate(meetings):
        before, after = forward[i], forward[i + 1]
        moves = (after - before) / step
        low = int(np.clip(np.floor(moves), -(rungs // 2), rungs // 2 - 1))
        up = float(np.clip(moves - low, 0, 1))
        for rung in range(-(rungs // 2), rungs // 2 + 1):
            out.append((day, before, after, rung * step * 100, (1 - up) if rung == low else up if rung == low + 1 else 0.0))
    return out


def meeting_paths(curve: DataFrame, meetings: Sequence[int], days_a_month: float = 30.4375) -> DataFrame:
    """(as_of_date, day, before, after, outcome_bps, probability): the meeting path of each day's curve of two tenors or more; meetings: days from that day."""

    def paths(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for day, rows in group.groupby("as_of_date"):
            if len(rows) > 1:
                rates = list(zip(rows["tenor_months"].to_numpy(float) * days_a_month, rows["yield_pct"].to_numpy(float), strict=True))
                out += [(day, *x) for x in meeting_path(rates, meetings)]
        return pd.DataFrame(out, columns=["as_of_date", "day", "before", "after", "outcome_bps", "probability"])

    # As in nelson_siegel: days are independent, and a month of them shares one call.
    rows = curve.filter("yield_pct is not null").withColumn("_month", F.trunc("as_of_date", "month"))
    return rows.groupBy("_month").applyInPandas(paths, "as_of_date date, day int, before double, after double, outcome_bps double, probability double")
