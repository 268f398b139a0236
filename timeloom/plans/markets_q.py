"""Market, macro and equity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeloom.operators import equity, features, macro, markets
from timeloom.operators import kernels as k
from timeloom.plans import adapters as a
from timeloom.plans.core import YOY, pct, rolling_sql
from timeloom.plans.registry import config, register, values

TENORS = [(f"T{n}", f"{m}M", m) for n, m in a.TENORS.items()]
CURVE = "SELECT observation_date AS as_of_date, months || 'M' AS tenor_label, months AS tenor_months, value AS yield_pct FROM curve"


def _curve(s, d):
    return markets.treasury_curve(a.curve(s, d), config(s, TENORS, "series_id string, tenor_label string, tenor_months int"))


register("treasury_curve", "as_of_date d, tenor_label s, tenor_months i, yield_pct f", _curve, CURVE, "curve")
_Y = ", ".join(f"max(CASE WHEN tenor_months = {m} THEN yield_pct END) AS y{m}" for m in (3, 24, 60, 120, 360))
register("curve_metrics", "as_of_date d, level f, slope_10y2y f, slope_10y3m f, curvature f, butterfly f, inverted_10y2y b, inverted_10y3m b", lambda s, d: markets.curve_metrics(_curve(s, d)), f"SELECT *, slope_10y2y < 0 AS inverted_10y2y, slope_10y3m < 0 AS inverted_10y3m FROM (SELECT as_of_date, level, y120 - y24 AS slope_10y2y, y120 - y3 AS slope_10y3m, 2 * y60 - y24 - y120 AS curvature, 2 * y120 - y24 - y360 AS butterfly FROM (SELECT as_of_date, avg(yield_pct) AS level, {_Y} FROM ({CURVE}) GROUP BY 1)) AS t", "curve")
# The kind of move depends on the signs of tiny differences, so it is compared on rounded curves.
_MOVE = "SELECT as_of_date, CASE WHEN dl <> 0 AND ds <> 0 THEN CASE WHEN dl < 0 THEN 'bull' ELSE 'bear' END || '-' || CASE WHEN ds > 0 THEN 'steepener' ELSE 'flattener' END WHEN dl <> 0 AND ds = 0 THEN 'parallel-' || CASE WHEN dl < 0 THEN 'bull' ELSE 'bear' END WHEN dl = 0 AND ds <> 0 THEN 'twist-' || CASE WHEN ds > 0 THEN 'steepener' ELSE 'flattener' END END AS curve_move FROM (SELECT as_of_date, level - lag(level) OVER (ORDER BY as_of_date) AS dl, slope - last_value(slope IGNORE NULLS) OVER (ORDER BY as_of_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ds FROM (SELECT as_of_date, avg(y) AS level, max(CASE WHEN tenor_months = 120 THEN y END) - max(CASE WHEN tenor_months = 24 THEN y END) AS slope FROM (SELECT *, round(yield_pct) AS y FROM (" + CURVE + ")) GROUP BY 1)) AS t"
register("curve_move", "as_of_date d, curve_move s", lambda s, d: markets.curve_metrics(_curve(s, d).withColumn("yield_pct", F.round("yield_pct"))), _MOVE, "curve")

SPREADS = [("t6_t3", "spread", "T6", "T3"), ("t7_t2", "spread", "T7", "T2")]
SPREAD_SQL = f"SELECT name, x.observation_date, round(x.value - y.value, 9) AS value FROM {values(SPREADS, 'p', 'name, op, long_leg, short_leg')} JOIN curve x ON x.series_id = long_leg JOIN curve y ON y.series_id = short_leg AND y.observation_date = x.observation_date"


def _spreads(s, d):
    return features.curve_spreads(a.curve(s, d), config(s, SPREADS, "name string, op string, long_leg string, short_leg string")).select("name", "observation_date", F.round("value", 9).alias("value"))


def expanding_sql(source: str, key: str, extra: str = "") -> str:
    return f"SELECT *, CASE WHEN std > 0 THEN (value - mean) / std END AS zscore, CASE WHEN k > 1 THEN len(list_filter(past, lambda x: x < value)) / (k - 1.0) END AS percentile FROM (SELECT *{extra}, avg(value) OVER o AS mean, stddev_pop(value) OVER o AS std, list(value) OVER o AS past, row_number() OVER (PARTITION BY {key} ORDER BY observation_date) AS k FROM ({source}) WINDOW o AS (PARTITION BY {key} ORDER BY observation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS e"


GRP = f"SELECT *, value < 0 AS inverted, sum(CASE WHEN value < 0 THEN 0 ELSE 1 END) OVER (PARTITION BY name ORDER BY observation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp, lead(observation_date) OVER (PARTITION BY name ORDER BY observation_date) AS next_date FROM ({SPREAD_SQL})"
register("spread_daily", "name s, observation_date d, value f, bps f, zscore f, percentile f, inverted b, inversion_run i", lambda s, d: markets.spread_daily(_spreads(s, d)), f"SELECT *, value * 100 AS bps, sum(CAST(inverted AS INT)) OVER (PARTITION BY name, grp ORDER BY observation_date) AS inversion_run FROM ({expanding_sql(GRP, 'name')}) AS t", "curve")
register("inversion_episode", "name s, episode i, start_date d, end_date d, last_inverted d, n_obs i, calendar_days i, trough_value f, trough_date d, is_ongoing b", lambda s, d: markets.inversion_episodes(_spreads(s, d)), f"SELECT name, row_number() OVER (PARTITION BY name ORDER BY start_date) AS episode, start_date, end_date, last_inverted, n_obs, coalesce(end_date, last_inverted) - start_date AS calendar_days, trough.v AS trough_value, trough.d AS trough_date, end_date IS NULL AS is_ongoing FROM (SELECT name, grp, min(observation_date) AS start_date, arg_max_null(next_date, observation_date) AS end_date, max(observation_date) AS last_inverted, count(*) AS n_obs, min({{'v': value, 'd': observation_date}}) AS trough FROM ({GRP}) WHERE inverted GROUP BY 1, 2) AS t", "curve")
register("spread_rolling", "name s, observation_date d, window_size i, value f, change f, zscore f", lambda s, d: k.rolling(_spreads(s, d), ["name"], (21, 252)), rolling_sql(f"({SPREAD_SQL})", "name", [21, 252]), "curve")
BOARD = [("PRI:1-URGENT", "urgent", "PRI:2-HIGH"), ("PRI:3-MEDIUM", "medium", None), ("PRI:5-LOW", "low", "PRI:4-NOT SPECIFIED")]
register("rate_board", "series_id s, label s, benchmark s, latest_date d, value f, prior_value f, change_bps f, trend s, regime s, spread_bps f, zscore f, staleness_days i", lambda s, d: markets.rate_board(a.daily(s, d), config(s, BOARD, "series_id string, label string, benchmark string")), f"""SELECT t.*, label, benchmark, observation_date AS latest_date, (value - prior_value) * 100 AS change_bps, trend, CASE trend WHEN 'flat' THEN 'stable' WHEN 'rising' THEN 'tightening' WHEN 'falling' THEN 'easing' END AS regime,
(value - (SELECT max_by(b.value, b.observation_date) FROM daily b WHERE b.series_id = r.benchmark AND b.observation_date <= t.observation_date)) * 100 AS spread_bps, CASE WHEN std > 0 THEN (value - mean) / std END AS zscore, max(observation_date) OVER () - observation_date AS staleness_days
FROM (SELECT *, CASE WHEN abs(value - back) <= 0.01 THEN 'flat' WHEN value > back THEN 'rising' WHEN value < back THEN 'falling' END AS trend FROM (SELECT *, lag(value) OVER w AS prior_value, lag(value, 5) OVER w AS back, avg(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mean, stddev_pop(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS std, lead(observation_date) OVER w AS nxt FROM daily WINDOW w AS (PARTITION BY series_id ORDER BY observation_date)) WHERE nxt IS NULL) t JOIN {values(BOARD, 'r', 'series_id, label, benchmark')} ON r.series_id = t.series_id""", "daily")
register("funding_tape", "metric s, kind s, observation_date d, value f, zscore f, percentile f", lambda s, d: markets.funding_tape(_tape(s, d)), expanding_sql("SELECT series_id AS metric, 'level' AS kind, observation_date, value FROM monthly UNION ALL SELECT name, 'spread', observation_date, value FROM (" + SPREAD_SQL.replace("curve x", "monthly x").replace("curve y", "monthly y").replace("'T6'", "'SEG:AUTOMOBILE'").replace("'T3'", "'SEG:BUILDING'").replace("'T7'", "'SEG:MACHINERY'").replace("'T2'", "'SEG:FURNITURE'") + ")", "metric"), "monthly")
FUND = [("t6_t3", "spread", "SEG:AUTOMOBILE", "SEG:BUILDING"), ("t7_t2", "spread", "SEG:MACHINERY", "SEG:FURNITURE")]
WEIGHTS = [("t6_t3", 1.0), ("t7_t2", 0.5)]


def _tape(s, d):
    levels = a.monthly(s, d).select(F.col("series_id").alias("metric"), F.lit("level").alias("kind"), "observation_date", "value")
    spreads = features.curve_spreads(a.monthly(s, d), config(s, FUND, "name string, op string, long_leg string, short_leg string"))
    return levels.unionByName(spreads.select(F.col("name").alias("metric"), F.lit("spread").alias("kind"), "observation_date", F.round("value", 9).alias("value")))


_FUND_SQL = f"SELECT name AS metric, x.observation_date, round(x.value - y.value, 9) AS value FROM {values(FUND, 'p', 'name, op, long_leg, short_leg')} JOIN monthly x ON x.series_id = long_leg JOIN monthly y ON y.series_id = short_leg AND y.observation_date = x.observation_date"
register("funding_stress", "observation_date d, composite_z f, score f, bucket s, n_components i", lambda s, d: markets.funding_stress(markets.funding_tape(_tape(s, d)), config(s, WEIGHTS, "metric string, weight double")), f"SELECT *, CASE WHEN score < 40 THEN 'calm' WHEN score < 60 THEN 'normal' WHEN score < 80 THEN 'elevated' ELSE 'stressed' END AS bucket FROM (SELECT *, greatest(0.0, least(100.0, 50 + 20 * composite_z)) AS score FROM (SELECT observation_date, sum(weight * coalesce(zscore, 0)) / 1.5 AS composite_z, count(*) AS n_components FROM ({expanding_sql(_FUND_SQL, 'metric')}) JOIN {values(WEIGHTS, 'w', 'metric, weight')} USING (metric) GROUP BY 1 HAVING count(*) = 2)) AS t", "monthly")


def _flags(s, d):
    months = a.monthly(s, d).groupBy("observation_date").agg(F.sum("value").alias("v"))
    return months.select("observation_date", F.when(F.month("observation_date") % 5 != 0, F.month("observation_date") % 3 == 0).alias("flag"))


FLAGS = "SELECT observation_date, CASE WHEN month(observation_date) % 5 <> 0 THEN month(observation_date) % 3 = 0 END AS flag FROM monthly GROUP BY 1"
register("credit_daily", "instrument s, observation_date d, oas_bps f, change_bps f, zscore f, percentile f, is_stress b, is_recession b", lambda s, d: markets.credit_daily(a.daily(s, d).select(F.col("series_id").alias("instrument"), "observation_date", (F.col("value") / 1e6).alias("value")), _flags(s, d)), f"SELECT *, value * 100 AS oas_bps, (value - prev) * 100 AS change_bps, percentile >= 0.9 AS is_stress, CASE WHEN observation_date - flag_date <= 62 THEN flag END AS is_recession FROM ({expanding_sql('SELECT series_id AS instrument, observation_date, value / 1e6 AS value FROM daily', 'instrument', ', lag(value) OVER (PARTITION BY instrument ORDER BY observation_date) AS prev')}) t ASOF LEFT JOIN (SELECT observation_date AS flag_date, flag FROM ({FLAGS}) WHERE flag IS NOT NULL) f ON t.observation_date >= f.flag_date", "daily monthly")

CATALOG = [("SEG:AUTOMOBILE", "Durables", 1), ("SEG:BUILDING", "Housing", 1), ("SEG:FURNITURE", "Housing", -1), ("SEG:HOUSEHOLD", "Durables", 0), ("SEG:MACHINERY", "Capital", -1)]


def _board(s, d):
    return macro.dashboard(a.monthly(s, d), config(s, CATALOG, "series_id string, category string, polarity int"))


_DASH = f"""SELECT *, observation_date AS latest_date, value - prior_value AS change_abs, {pct('value', 'prior_value')} AS change_pct, {pct('value', 'ago')} AS yoy_pct, CASE WHEN nb >= 2 THEN value - mb END AS surprise, CASE WHEN nb >= 2 AND sb > 0 THEN (value - mb) / sb END AS surprise_z,
CASE WHEN polarity <> 0 AND value <> prior_value THEN polarity * (value - prior_value) > 0 END AS direction_is_good, max(observation_date) OVER () - observation_date AS staleness_days
FROM ({expanding_sql('SELECT * FROM monthly JOIN ' + values(CATALOG, 'c', 'series_id, category, polarity') + ' USING (series_id)', 'series_id', ', lag(value) OVER w AS prior_value, lag(observation_date) OVER w AS prior_date, lead(observation_date) OVER w AS nxt, ' + YOY + ' AS ago, count(value) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS nb, avg(value) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS mb, stddev_pop(value) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS sb, min(value) OVER (w ROWS BETWEEN 35 PRECEDING AND CURRENT ROW) AS spark_min, max(value) OVER (w ROWS BETWEEN 35 PRECEDING AND CURRENT ROW) AS spark_max').replace('WINDOW o AS', 'WINDOW w AS (PARTITION BY series_id ORDER BY observation_date), o AS')}) WHERE nxt IS NULL"""
register("dashboard", "series_id s, category s, polarity i, latest_date d, value f, prior_date d, prior_value f, change_abs f, change_pct f, yoy_pct f, zscore f, percentile f, surprise f, surprise_z f, direction_is_good b, spark_min f, spark_max f, staleness_days i", _board, _DASH, "monthly")
register("sparkline", "series_id s, point_index i, observation_date d, value f", lambda s, d: macro.sparkline(a.monthly(s, d)), "SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY observation_date) - 1 AS point_index FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY observation_date DESC) AS back FROM monthly) AS t WHERE back <= 36", "monthly")
register("category_summary", "category s, n_series i, n_improving i, n_deteriorating i, breadth f, avg_zscore f, surprise_index f", lambda s, d: macro.category_summary(_board(s, d)), f"SELECT category, count(*) AS n_series, count(*) FILTER (direction_is_good) AS n_improving, count(direction_is_good) - count(*) FILTER (direction_is_good) AS n_deteriorating, count(*) FILTER (direction_is_good) / nullif(count(direction_is_good), 0) AS breadth, avg(zscore) AS avg_zscore, avg(surprise_z) AS surprise_index FROM ({_DASH}) GROUP BY 1", "monthly")
ITEMS = [("SEG:AUTOMOBILE", "All", "CPI", 0, 100.0, False), ("SEG:BUILDING", "Food", "CPI", 1, 14.0, True), ("SEG:FURNITURE", "Energy", "CPI", 1, 7.0, True), ("SEG:MACHINERY", "Core", "CPI", 1, 79.0, True)]


def _explorer(s, d):
    return macro.inflation_explorer(a.monthly(s, d), config(s, ITEMS, "series_id string, label string, basket string, level int, weight double, waterfall boolean"))


_MONTHS = f"SELECT series_id, label, basket, level, weight, waterfall, year(observation_date) * 12 + month(observation_date) - 1 AS m, max(observation_date) AS observation_date, max_by(value, observation_date) AS value FROM monthly JOIN {values(ITEMS, 'i', 'series_id, label, basket, level, weight, waterfall')} USING (series_id) GROUP BY ALL"
_BACK = " ".join(f"LEFT JOIN months b{n} ON b{n}.series_id = t.series_id AND b{n}.m = t.m - {n}" for n in (1, 2, 3, 12, 13))
_EXPLORER = f"WITH months AS ({_MONTHS}) SELECT t.*, t.value AS index_value, {pct('t.value', 'b1.value')} AS mom_pct, {pct('t.value', 'b12.value')} AS yoy_pct, {pct('t.value', 'b1.value')} - {pct('b1.value', 'b2.value')} AS mom_accel, {pct('t.value', 'b12.value')} - {pct('b1.value', 'b13.value')} AS yoy_accel, CASE WHEN b3.value > 0 AND t.value > 0 THEN pow(t.value / b3.value, 4) - 1 END AS annualized_3m, t.weight * {pct('t.value', 'b1.value')} AS contribution_pp FROM months t {_BACK}"
register("inflation_explorer", "series_id s, label s, observation_date d, index_value f, mom_pct f, yoy_pct f, mom_accel f, yoy_accel f, annualized_3m f, contribution_pp f", _explorer, _EXPLORER, "monthly")
register("inflation_contribution", "basket s, m i, series_id s, contribution_pp f, rank_in_month i, is_headline b", lambda s, d: macro.inflation_contribution(_explorer(s, d)), f"SELECT e.basket, e.m, e.series_id, e.contribution_pp, row_number() OVER (PARTITION BY e.basket, e.m ORDER BY e.contribution_pp DESC, e.series_id) AS rank_in_month, false AS is_headline FROM ({_EXPLORER}) e JOIN ({_EXPLORER}) h ON h.basket = e.basket AND h.m = e.m AND h.level = 0 AND h.mom_pct IS NOT NULL WHERE e.waterfall AND e.contribution_pp IS NOT NULL UNION ALL SELECT basket, m, series_id, mom_pct * 100, NULL, true FROM ({_EXPLORER}) WHERE level = 0 AND mom_pct IS NOT NULL", "monthly")
COUNTRIES = [("SEG:AUTOMOBILE", "Aland", "yoy_from_index", 2.0), ("SEG:BUILDING", "Boria", "yoy_from_index", None), ("SEG:MACHINERY", "Cyria", "level", 3.0)]


def _countries(s):
    return config(s, COUNTRIES, "series_id string, country string, transform string, target double")


_YOY_SQL = f"SELECT * FROM (SELECT series_id, country, CAST(target AS DOUBLE) AS target, observation_date, CASE WHEN transform = 'level' THEN value ELSE ({pct('value', 'ago')}) * 100 END AS yoy FROM (SELECT *, {YOY} AS ago FROM monthly) JOIN {values(COUNTRIES, 'c', 'series_id, country, transform, target')} USING (series_id)) AS t WHERE yoy IS NOT NULL"
register("global_inflation", "series_id s, country s, observation_date d, yoy_pct f, change_pp f, trend s, streak i, vs_target f", lambda s, d: macro.global_inflation(a.monthly(s, d), _countries(s)), f"SELECT *, yoy AS yoy_pct, change AS change_pp, CASE WHEN change IS NULL THEN NULL WHEN sgn = 0 THEN 'flat' WHEN sgn > 0 THEN 'accelerating' ELSE 'cooling' END AS trend, sgn * row_number() OVER (PARTITION BY series_id, grp ORDER BY observation_date) AS streak, yoy - target AS vs_target FROM (SELECT *, sum(CASE WHEN sgn <> coalesce(prev, 9) THEN 1 ELSE 0 END) OVER (PARTITION BY series_id ORDER BY observation_date) AS grp FROM (SELECT *, lag(sgn) OVER (PARTITION BY series_id ORDER BY observation_date) AS prev FROM (SELECT *, CASE WHEN change IS NULL OR abs(change) <= 0.05 THEN 0 WHEN change > 0 THEN 1 ELSE -1 END AS sgn FROM (SELECT *, yoy - lag(yoy) OVER (PARTITION BY series_id ORDER BY observation_date) AS change FROM ({_YOY_SQL}))))) AS g", "monthly")
POLICY = [("T1", "Aland"), ("T2", "Boria"), ("T3", "Cyria")]


def _policy(s, d):
    rates = a.curve(s, d).join(config(s, POLICY, "series_id string, country string"), "series_id").select("country", "observation_date", "value")
    return macro.policy_rates(rates, macro.yoy_percent(a.monthly(s, d), _countries(s)))


register("policy_rates", "country s, observation_date d, rate f, change_bps f, last_move_bps f, stance s, real_rate f", _policy, f"SELECT r.*, value AS rate, CASE WHEN last_move_bps > 0 THEN 'hiking' WHEN last_move_bps < 0 THEN 'cutting' WHEN abs(change_bps) <= 1 THEN 'on-hold' END AS stance, CASE WHEN r.observation_date - y.d <= 550 THEN value - yoy END AS real_rate FROM (SELECT *, last_value(CASE WHEN abs(change_bps) > 1 THEN change_bps END IGNORE NULLS) OVER (PARTITION BY country ORDER BY observation_date) AS last_move_bps FROM (SELECT country, observation_date, value, (value - lag(value) OVER (PARTITION BY country ORDER BY observation_date)) * 100 AS change_bps FROM curve JOIN {values(POLICY, 'p', 'series_id, country')} USING (series_id))) r ASOF LEFT JOIN (SELECT country, observation_date AS d, yoy FROM ({_YOY_SQL})) y ON y.country = r.country AND r.observation_date >= y.d", "curve monthly")

register("equity_return", "ticker s, observation_date d, close p, price_change q, price_return f, return_index f", lambda s, d: equity.returns(a.prices(s, d)), "SELECT ticker, observation_date, close, close - prev AS price_change, close / prev - 1 AS price_return, 100 * product(CASE WHEN prev IS NULL THEN 1 ELSE close / prev END) OVER (PARTITION BY ticker ORDER BY observation_date) AS return_index FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY observation_date) AS prev FROM prices) AS t", "prices")
register("canonical_prices", "ticker s, observation_date d, close p", lambda s, d: equity.canonical_prices(a.prices(s, d).filter("ticker like '%3'").select("ticker", "observation_date", "close"), a.prices(s, d).select("ticker", "observation_date", (F.col("close") * 2).alias("close"))), "SELECT ticker, observation_date, CASE WHEN ticker LIKE '%3' THEN close ELSE close * 2 END AS close FROM prices", "prices")
register("index_constituents", "etf s, constituent s, observation_date d, weight f, rank i, is_latest b", lambda s, d: equity.constituents(a.holdings(s, d)), "SELECT *, row_number() OVER (PARTITION BY etf, observation_date ORDER BY weight DESC, constituent) AS rank, observation_date = max(observation_date) OVER (PARTITION BY etf) AS is_latest FROM holdings", "holdings")
register("total_return", "ticker s, observation_date d, price_return f, total_return f, price_index f, total_index f, ttm_dividend f, yield_pct f", lambda s, d: equity.total_return(a.prices(s, d).withColumn("split", F.lit(1.0))), "SELECT ticker, observation_date, close / prev - 1 AS price_return, (close + dividend) / prev - 1 AS total_return, 100 * product(coalesce(close / prev, 1)) OVER w AS price_index, 100 * product(coalesce((close + dividend) / prev, 1)) OVER w AS total_index, sum(dividend) OVER (PARTITION BY ticker ORDER BY observation_date RANGE BETWEEN INTERVAL '365' DAY PRECEDING AND CURRENT ROW) AS ttm_dividend, sum(dividend) OVER (PARTITION BY ticker ORDER BY observation_date RANGE BETWEEN INTERVAL '365' DAY PRECEDING AND CURRENT ROW) / close * 100 AS yield_pct FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY observation_date) AS prev FROM prices) WINDOW w AS (PARTITION BY ticker ORDER BY observation_date)", "prices")
register("price_reconciliation", "ticker s, observation_date d, close_a p, close_b p, pct_diff f, diverged b", lambda s, d: equity.price_reconciliation(a.prices(s, d), a.prices(s, d).withColumn("close", F.col("close") + F.col("dividend") * 100).filter("day(observation_date) % 2 = 0")), "SELECT ticker, observation_date, close AS close_a, close + dividend * 100 AS close_b, -(dividend * 100) / (close + dividend * 100) AS pct_diff, abs((dividend * 100) / (close + dividend * 100)) * 100 > 2 AS diverged FROM prices WHERE day(observation_date) % 2 = 0", "prices")
_VOL = " UNION ALL ".join(f"SELECT ticker, observation_date, {w} AS window_size, stddev_pop(r) OVER (PARTITION BY ticker ORDER BY observation_date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) * sqrt(252) * 100 AS volatility_pct FROM logs QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY observation_date) >= {w}" for w in equity.VOL_WINDOWS)
register("realized_vol", "ticker s, observation_date d, window_size i, volatility_pct f", lambda s, d: equity.realized_volatility(a.prices(s, d)), f"WITH logs AS (SELECT * FROM (SELECT ticker, observation_date, ln(close / lag(close) OVER (PARTITION BY ticker ORDER BY observation_date)) AS r FROM prices) WHERE r IS NOT NULL) {_VOL}", "prices")
register("credit_rolling", "instrument s, observation_date d, window_size i, value p, change p, zscore f", lambda s, d: k.rolling(a.daily(s, d).select(F.col("series_id").alias("instrument"), "observation_date", (F.col("value") / 1e6).alias("value")), ["instrument"], (5, 63)), rolling_sql("(SELECT series_id AS instrument, observation_date, value / 1e6 AS value FROM daily)", "instrument", [5, 63]), "daily")
register("curve_rolling", "tenor_label s, observation_date d, window_size i, value f, change f, zscore f", lambda s, d: k.rolling(_curve(s, d).select("tenor_label", F.col("as_of_date").alias("observation_date"), F.col("yield_pct").alias("value")), ["tenor_label"], (21,)), rolling_sql(f"(SELECT tenor_label, as_of_date AS observation_date, yield_pct AS value FROM ({CURVE}))", "tenor_label", [21]), "curve")
