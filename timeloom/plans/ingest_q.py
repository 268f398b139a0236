"""Model, ingest and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeloom.operators import features, models, quality
from timeloom.plans import adapters as a
from timeloom.plans.core import TODAY, transforms_sql
from timeloom.plans.markets_q import TENORS, _curve, _flags
from timeloom.plans.registry import config, register, values
from timeloom.sources import payloads

KEYS = "series_id s, observation_date d"
FEATURES = [("auto_yoy", "SEG:AUTOMOBILE", "yoy"), ("auto_z", "SEG:AUTOMOBILE", "zscore"), ("build_mom", "SEG:BUILDING", "mom"), ("furn_diff", "SEG:FURNITURE", "diff"), ("mach_level", "SEG:MACHINERY", "value"), ("house_z", "SEG:HOUSEHOLD", "zscore")]


def _matrix(s, d):
    return models.feature_matrix(features.feature_transforms(a.monthly(s, d)), config(s, FEATURES, "feature_name string, series_id string, transform string"))


_MATRIX = f"SELECT observation_date, feature_name, series_id, transform, v AS value FROM (SELECT *, CASE transform WHEN 'value' THEN value WHEN 'mom' THEN mom WHEN 'diff' THEN diff WHEN 'yoy' THEN yoy ELSE zscore END AS v FROM ({transforms_sql('monthly')}) JOIN {values(FEATURES, 'f', 'feature_name, series_id, transform')} USING (series_id)) AS t WHERE v IS NOT NULL"
register("ml_features", "observation_date d, feature_name s, series_id s, transform s, value f", _matrix, _MATRIX, "monthly")
register("pca_factors", "month d, kind s, factor i, feature s, value f", lambda s, d: models.pca_factors(models.month_ends(_matrix(s, d))))


def _scores(s, d):
    rows = _matrix(s, d).filter("feature_name in ('auto_z', 'house_z', 'build_mom')").select("observation_date", F.col("feature_name").alias("factor"), F.col("value").alias("score"))
    return rows.unionByName(rows.filter("factor = 'auto_z'").select("observation_date", F.lit("flat").alias("factor"), F.lit(2.5).alias("score")))  # a factor that never varies


register("anomaly_d2", "observation_date d, d2 f, k i", lambda s, d: models.anomaly_distance(_scores(s, d)), f"SELECT observation_date, min(n) AS n, sum(CASE WHEN v > 1e-12 THEN (score - m) ^ 2 / v ELSE 0 END) AS d2, count(*) FILTER (v > 1e-12) AS k FROM (SELECT *, count(*) OVER o AS n, avg(score) OVER o AS m, var_samp(score) OVER o AS v FROM (SELECT observation_date, feature_name AS factor, value AS score FROM ({_MATRIX}) WHERE feature_name IN ('auto_z', 'house_z', 'build_mom') UNION ALL SELECT observation_date, 'flat', 2.5 FROM ({_MATRIX}) WHERE feature_name = 'auto_z') WINDOW o AS (PARTITION BY factor ORDER BY observation_date)) AS t GROUP BY 1 HAVING min(n) >= 20 AND count(*) FILTER (v > 1e-12) > 0", "monthly")
register("anomaly_scores", "observation_date d, d2 f, p_value f, is_anomaly b", lambda s, d: models.anomaly_scores(_scores(s, d)))


def _labels(s, d):
    months = a.monthly(s, d).select("observation_date").distinct()
    return models.recession_labels(months, _flags(s, d).withColumn("flag", F.coalesce("flag", F.lit(False))), (3, 6, 12))


register("recession_labels", "observation_date d, horizon i, label b", _labels, "SELECT m.observation_date, h.horizon, coalesce(bool_or(f.flag), false) AS label FROM (SELECT DISTINCT observation_date FROM monthly) m, (VALUES (3), (6), (12)) AS h(horizon) LEFT JOIN (SELECT DISTINCT observation_date AS d, CASE WHEN month(observation_date) % 5 <> 0 THEN month(observation_date) % 3 = 0 ELSE false END AS flag FROM monthly) f ON f.d > m.observation_date AND f.d <= m.observation_date + to_months(h.horizon) WHERE m.observation_date + to_months(h.horizon) <= (SELECT max(observation_date) FROM monthly) GROUP BY 1, 2", "monthly")


def _recession(s, d):
    names = ["auto_z", "house_z"]
    wide = _matrix(s, d).filter(F.col("feature_name").isin(names)).groupBy("observation_date").agg(*[F.max(F.when(F.col("feature_name") == n, F.col("value"))).alias(n) for n in names])
    return models.recession_probability(wide, _labels(s, d), names, 24)


register("recession_prob", "observation_date d, horizon i, probability f, n_train i", _recession)
_RETURNS = "SELECT ticker, CAST(date_trunc('month', observation_date) AS DATE) AS month, product(1 + r) - 1 AS ret, count(*) AS n_days FROM (SELECT ticker, observation_date, close / lag(close) OVER (PARTITION BY ticker ORDER BY observation_date) - 1 AS r FROM prices) WHERE r IS NOT NULL GROUP BY 1, 2"
register("monthly_returns", "ticker s, month d, ret f, n_days i", lambda s, d: models.monthly_returns(a.prices(s, d)), _RETURNS, "prices")


def _factors(s, d):
    rows = a.monthly(s, d).groupBy(F.col("observation_date").alias("month"))
    return rows.agg((F.max(F.when(F.col("series_id") == "SEG:AUTOMOBILE", F.col("value"))) / 1e7).alias("f1"), (F.max(F.when(F.col("series_id") == "SEG:BUILDING", F.col("value"))) / 1e7).alias("f2")).filter("f1 is not null and f2 is not null")


register("factor_ols", "ticker s, month d, window_size i, factor s, beta f, t_stat f, r2 f, n i", lambda s, d: models.factor_attribution(models.monthly_returns(a.prices(s, d)), _factors(s, d), ["f1", "f2"]))


def _implied(s, d):
    returns = models.monthly_returns(a.prices(s, d))
    betas = returns.filter("month(month) % 4 = 0").select("ticker", "month", F.lit("f1").alias("factor"), F.col("n_days").cast("double").alias("beta"))
    return models.implied_returns(returns, betas, _factors(s, d).select("month", F.lit("f1").alias("factor"), F.col("f1").alias("score")))


register("implied_return", "ticker s, month d, implied f, ret f, residual f", _implied, f"WITH r AS ({_RETURNS}) SELECT r.ticker, r.month, b.n_days * f.score AS implied, r.ret, r.ret - b.n_days * f.score AS residual FROM r ASOF JOIN (SELECT ticker, month, n_days FROM r WHERE month(month) % 4 = 0) b ON b.ticker = r.ticker AND r.month >= b.month JOIN (SELECT observation_date AS month, max(value) FILTER (series_id = 'SEG:AUTOMOBILE') / 1e7 AS score, max(value) FILTER (series_id = 'SEG:BUILDING') AS other FROM monthly GROUP BY 1) f ON f.month = r.month WHERE f.score IS NOT NULL AND f.other IS NOT NULL", "prices monthly")
register("ns_factors", "as_of_date d, level f, slope f, curvature f, rmse f, n_tenors i", lambda s, d: models.nelson_siegel(_curve(s, d)))
register("monthly_change", f"{KEYS}, mom f", lambda s, d: models.monthly_change(a.monthly(s, d)), "SELECT series_id, observation_date, (value / prev - 1) * 100 AS mom FROM (SELECT *, lag(value) OVER w AS prev, observation_date - lag(observation_date) OVER w AS gap FROM monthly WINDOW w AS (PARTITION BY series_id ORDER BY observation_date)) AS t WHERE gap BETWEEN 25 AND 40 AND prev > 0", "monthly")
FORECAST_PAIRS = [("SEG:AUTOMOBILE", "SEG:BUILDING"), ("SEG:MACHINERY", "SEG:HOUSEHOLD")]


def _forecasts(s, d):
    changes = models.monthly_change(a.monthly(s, d))
    joint = models.pair_forecasts(changes, config(s, FORECAST_PAIRS, "first string, second string"))
    return models.forecasts(changes).withColumn("model", F.lit("ar")).unionByName(joint.withColumn("model", F.lit("var")))


register("inflation_forecast", "series_id s, horizon i, mean f, p10 f, p90 f, ar_order i, model s", _forecasts)
MEETINGS = [20, 62, 104, 153]
register("fomc_path", "as_of_date d, day i, before f, after f, outcome_bps f, probability f", lambda s, d: models.meeting_paths(_curve(s, d), MEETINGS))


def _fred_payloads(s, d):
    rows = a.vintages(s, d).groupBy("series_id").agg(F.collect_list(F.struct(F.col("observation_date").cast("string").alias("date"), F.when(F.month("observation_date") == 7, ".").otherwise(F.format_string("%.2f", "value")).alias("value"), F.col("realtime_start").cast("string").alias("realtime_start"), F.col("realtime_end").cast("string").alias("realtime_end"))).alias("observations"))
    return rows.select("series_id", F.to_json(F.struct("observations")).alias("payload"))


register("fred_payloads", f"{KEYS}, realtime_start d, realtime_end d, value f, is_missing b", lambda s, d: payloads.fred(_fred_payloads(s, d)), "SELECT series_id, observation_date, realtime_start, realtime_end, CASE WHEN month(observation_date) <> 7 THEN value END AS value, month(observation_date) = 7 AS is_missing FROM vintages", "vintages")


def _bls_payloads(s, d):
    rows = a.monthly(s, d).groupBy("series_id").agg(F.collect_list(F.struct(F.year("observation_date").cast("string").alias("year"), F.format_string("M%02d", F.month("observation_date")).alias("period"), F.format_string("%.2f", "value").alias("value"))).alias("data"))
    rows = rows.select(F.struct(F.array(F.struct(F.col("series_id").alias("seriesID"), F.concat("data", F.array(F.struct(F.lit("1999").alias("year"), F.lit("M13").alias("period"), F.lit("1").alias("value")))).alias("data"))).alias("series")).alias("Results"))
    return rows.select(F.lit("x").alias("series_id"), F.to_json(F.struct("Results")).alias("payload"))


register("bls_payloads", f"{KEYS}, value f", lambda s, d: payloads.bls(_bls_payloads(s, d)), "SELECT * FROM monthly", "monthly")


def _lines(s, d, header, *fields):
    rows = a.daily(s, d).groupBy("series_id").agg(F.concat_ws("\n", F.lit(header), F.array_join(F.collect_list(F.concat_ws(",", *fields)), "\n")).alias("payload"))
    return rows


register("sdmx_payloads", f"{KEYS}, value f", lambda s, d: payloads.sdmx_csv(_lines(s, d, "KEY,TIME_PERIOD,OBS_VALUE,ACTION", F.lit('"a,b"'), F.col("observation_date").cast("string"), F.format_string("%.2f", "value"), F.when(F.dayofmonth("observation_date") == 3, "Delete").otherwise("Replace"))), "SELECT * FROM daily WHERE day(observation_date) <> 3", "daily")
register("stooq_payloads", f"{KEYS}, value f", lambda s, d: payloads.stooq(_lines(s, d, "Date,Open,Close", F.col("observation_date").cast("string"), F.lit("1"), F.format_string("%.2f", "value")).withColumn("series_id", F.concat("series_id", F.lit(":close")))), "SELECT series_id || ':close' AS series_id, observation_date, value FROM daily", "daily")


def _tiingo(prices):
    rows = prices.groupBy(F.col("ticker").alias("series_id")).agg(F.collect_list(F.struct(F.concat(F.col("observation_date").cast("string"), F.lit("T00:00:00Z")).alias("date"), F.col("close").alias("close"), F.col("dividend").alias("divCash"))).alias("o"))
    return payloads.tiingo(rows.select("series_id", F.to_json("o").alias("payload")))


register("unpivot_prices", f"{KEYS}, value p", lambda s, d: _tiingo(a.prices(s, d)), "SELECT ticker || ':close' AS series_id, observation_date, close AS value FROM prices UNION ALL SELECT ticker || ':divCash', observation_date, dividend FROM prices", "prices")
register("vintage_coalesce", f"{KEYS}, realtime_start d, realtime_end d, value f", lambda s, d: payloads.coalesced_vintages(a.vintages(s, d).withColumn("value", F.floor(F.col("value") / 1e6).cast("double"))), "SELECT series_id, observation_date, min(realtime_start) AS realtime_start, max_by(realtime_end_, realtime_start) AS realtime_end, any_value(v) AS value FROM (SELECT *, sum(CASE WHEN v IS DISTINCT FROM pv OR pr IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY series_id, observation_date ORDER BY realtime_start) AS grp FROM (SELECT *, coalesce(realtime_end, DATE '9999-12-31') AS realtime_end_, lag(v) OVER w AS pv, lag(realtime_start) OVER w AS pr FROM (SELECT *, floor(value / 1e6) AS v FROM vintages) WINDOW w AS (PARTITION BY series_id, observation_date ORDER BY realtime_start))) AS t GROUP BY series_id, observation_date, grp".replace("max_by(realtime_end_, realtime_start) AS realtime_end", "nullif(max_by(realtime_end_, realtime_start), DATE '9999-12-31') AS realtime_end"), "vintages")


def _upsert(s, d):
    rows = a.daily(s, d)
    fresh = rows.filter("month(observation_date) = 6").withColumn("value", F.col("value") * 2).unionByName(rows.filter("day(observation_date) = 9").select("series_id", F.date_add("observation_date", 10000).alias("observation_date"), "value"))
    return payloads.upserted(rows, fresh, ["series_id", "observation_date"])


register("upsert_merge", f"{KEYS}, value f", _upsert, "SELECT series_id, observation_date, CASE WHEN month(observation_date) = 6 THEN value * 2 ELSE value END AS value FROM daily UNION ALL SELECT series_id, observation_date + 10000, value FROM daily WHERE day(observation_date) = 9", "daily")


def _cumulative(s, d):
    """Three, six, nine and twelve months of a year, and now and then a fourth quarter that is reported by itself."""
    rows = a.table(s, d, "orders").select(F.col("o_custkey").cast("string").alias("series_id"), F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("s"), F.quarter("o_orderdate").alias("q"), F.col("o_totalprice").alias("v"), F.col("o_orderdate").cast("date").alias("filed"), "o_orderkey")
    end = F.last_day(F.make_date(F.year("s"), F.col("q") * 3, F.lit(1)))
    alone = (F.col("q") == 4) & (F.col("o_orderkey") % 5 == 0)
    return payloads.decumulated(rows.select("series_id", F.when(alone, F.add_months("s", 9)).otherwise(F.col("s")).alias("s"), end.alias("e"), "v", "filed"))


_CUM = "SELECT CAST(o_custkey AS VARCHAR) AS series_id, CASE WHEN quarter(o_orderdate) = 4 AND o_orderkey % 5 = 0 THEN make_date(year(o_orderdate), 10, 1) ELSE make_date(year(o_orderdate), 1, 1) END AS s, last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) AS e, o_totalprice AS v, CAST(o_orderdate AS DATE) AS filed FROM orders"
register("q4_decumulate", f"{KEYS}, realtime_start d, value f", _cumulative, f"WITH c AS ({_CUM}), y AS (SELECT DISTINCT * FROM c WHERE e - s BETWEEN 350 AND 380 AND NOT EXISTS (SELECT 1 FROM c q WHERE q.series_id = c.series_id AND q.e = c.e AND q.e - q.s BETWEEN 80 AND 100)), pairs AS (SELECT y.*, n.v AS nine, row_number() OVER (PARTITION BY y.series_id, y.s, y.e, y.v, y.filed ORDER BY n.filed <= y.filed DESC, n.filed DESC, n.v DESC) AS k FROM y JOIN c n ON n.series_id = y.series_id AND n.s = y.s AND n.e - n.s BETWEEN 260 AND 290) SELECT series_id, e AS observation_date, filed AS realtime_start, v AS value FROM c WHERE e - s BETWEEN 80 AND 100 UNION ALL SELECT series_id, e, filed, v - nine FROM pairs WHERE k = 1")


def _raw(s, d):
    day = F.dayofmonth("observation_date")
    rows = a.daily(s, d).select("series_id", F.when(day == 13, F.lit("n/a")).otherwise(F.col("observation_date").cast("string")).alias("observation_date"), F.lit(None).cast("date").alias("realtime_start"), F.when(day % 4 == 0, ".").when((day == 5) & (F.col("series_id") == "PRI:5-LOW"), "x").otherwise(F.format_string("%.2f", "value")).alias("raw_value"))
    return rows


BOUNDS = [("PRI:1-URGENT", 0.0, 1e12), ("PRI:2-HIGH", 5e6, 1e12)]
_RAW = "SELECT series_id, CASE WHEN day(observation_date) <> 13 THEN observation_date END AS d, day(observation_date) % 4 = 0 AND day(observation_date) <> 13 OR day(observation_date) % 4 = 0 AS blank, day(observation_date) = 5 AND series_id = 'PRI:5-LOW' AS bad, value FROM daily"
_PER = f"SELECT series_id, count(*) AS n, sum(CASE WHEN d IS NULL THEN 1 ELSE 0 END) AS bad_date, sum(CASE WHEN bad THEN 1 ELSE 0 END) AS bad_value, sum(CASE WHEN blank THEN 1 ELSE 0 END) AS missing, sum(CASE WHEN NOT blank AND NOT bad AND (value < min_value OR value > max_value) THEN 1 ELSE 0 END) AS outside, max(d) AS last, greatest(0, sum(CASE WHEN d IS NULL THEN 1 ELSE 0 END) - 1) AS dup FROM ({_RAW}) LEFT JOIN {values(BOUNDS, 'b', 'series_id, min_value, max_value')} USING (series_id) GROUP BY 1"
_CHECKS = " UNION ALL ".join(f"SELECT series_id, '{c}' AS check_name, '{quality.SEVERITY[c]}' AS severity, {ok} AS passed, CAST({m} AS DOUBLE) AS metric FROM per" for c, ok, m in [("non_empty", "n > 0", "n"), ("no_duplicate_keys", "dup = 0", "dup"), ("dates_parseable", "bad_date = 0", "bad_date"), ("values_numeric", "bad_value = 0", "bad_value"), ("missing_ratio", "missing / n <= 0.5", "missing / n"), ("no_future_dates", "true", "0"), ("value_bounds", "outside = 0", "outside"), ("freshness", f"DATE '{TODAY}' - last <= 90", f"DATE '{TODAY}' - last")])


def _checks(s, d):
    return quality.run_checks(_raw(s, d), config(s, BOUNDS, "series_id string, min_value double, max_value double"), TODAY)


PROFILES = [("PRI:1-URGENT", "strict"), ("PRI:2-HIGH", "lenient")]
register("dq_checks", "series_id s, check_name s, severity s, passed b, metric f", _checks, f"WITH per AS ({_PER}) {_CHECKS}", "daily")
register("dq_gate", "series_id s, profile s, passed b", lambda s, d: quality.gate(_checks(s, d), config(s, PROFILES, "series_id string, profile string")), f"WITH per AS ({_PER}), c AS ({_CHECKS}) SELECT series_id, coalesce(profile, 'standard') AS profile, NOT bool_or(NOT passed AND (coalesce(profile, 'standard') = 'strict' OR (coalesce(profile, 'standard') = 'standard' AND severity = 'ERROR'))) AS passed FROM c LEFT JOIN {values(PROFILES, 'p', 'series_id, profile')} USING (series_id) GROUP BY 1, 2", "daily")
register("metadata_drift", "series_id s, field s, expected s, found s", lambda s, d: quality.drift(a.table(s, d, "supplier").select(F.col("s_suppkey").cast("string").alias("series_id"), F.col("s_nationkey").alias("nation"), F.lit("A").alias("grade")), a.table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("series_id"), F.col("c_nationkey").alias("nation"), F.when(F.col("c_custkey") % 3 > 0, "A").alias("grade"))), "SELECT CAST(s_suppkey AS VARCHAR) AS series_id, 'nation' AS field, CAST(s_nationkey AS VARCHAR) AS expected, CAST(c_nationkey AS VARCHAR) AS found FROM supplier JOIN customer ON c_custkey = s_suppkey WHERE s_nationkey <> c_nationkey UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'grade', 'A', NULL FROM supplier JOIN customer ON c_custkey = s_suppkey WHERE c_custkey % 3 = 0")
register("manifest_duplicates", "series_id s, n i, manifests s", lambda s, d: quality.manifest_duplicates(a.table(s, d, "orders").select(F.col("o_custkey").alias("series_id"), F.col("o_orderstatus").alias("manifest"))), "SELECT o_custkey AS series_id, count(*) AS n, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS manifests FROM orders GROUP BY 1 HAVING count(*) > 1")
REGISTER = [("src1", True, "2001-01-01"), ("src2", False, "1999-01-01")]
register("licence_gate", "source s, n_series i, commercial_ok b, review_due b", lambda s, d: quality.licence_gate(a.table(s, d, "documents").select("source", F.col("lang").alias("series_id")), config(s, REGISTER, "source string, commercial boolean, reviewed string").withColumn("reviewed", F.to_date("reviewed")), TODAY), f"SELECT source, count(DISTINCT lang) AS n_series, coalesce(commercial, false) AS commercial_ok, coalesce(DATE '{TODAY}' - CAST(any_value(reviewed) AS DATE) > 365, true) AS review_due FROM documents LEFT JOIN {values(REGISTER, 'r', 'source, commercial, reviewed')} USING (source) GROUP BY source, commercial")
register("discovery", "series_id s, popularity i, priority i", lambda s, d: quality.discover(a.table(s, d, "part").select(F.col("p_partkey").cast("string").alias("series_id"), (F.col("p_size") * 2).alias("popularity"), F.col("p_brand").alias("frequency")), 30, ["Brand#11", "Brand#12", "Brand#23"]), "SELECT CAST(p_partkey AS VARCHAR) AS series_id, p_size * 2 AS popularity, CASE WHEN p_size * 2 >= 80 THEN 1 WHEN p_size * 2 >= 60 THEN 2 WHEN p_size * 2 >= 40 THEN 3 WHEN p_size * 2 >= 20 THEN 4 ELSE 5 END AS priority FROM part WHERE p_size * 2 >= 30 AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#23')")
