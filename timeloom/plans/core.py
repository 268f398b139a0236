"""Bitemporal and feature queries."""

from __future__ import annotations

from timeloom.operators import bitemporal, features
from timeloom.plans import adapters as a
from timeloom.plans.registry import config, register, values

AS_OF, TODAY = "1998-06-15", "2001-09-01"
PAIRS = [("auto_minus_build", "spread", "SEG:AUTOMOBILE", "SEG:BUILDING"), ("machine_over_home", "ratio", "SEG:MACHINERY", "SEG:HOUSEHOLD")]
LEGS = [("gap_q", "spread", "q", 0, "SEG:AUTOMOBILE", 1.0), ("gap_q", "spread", "q", 1, "SEG:FURNITURE", 1.0), ("rel_m", "ratio", "m", 0, "SEG:BUILDING", 1.0), ("rel_m", "ratio", "m", 1, "SEG:MACHINERY", 1.0)]
LEGS += [("mix_a", "composite", "a", i, s, w) for i, (s, w) in enumerate([("SEG:AUTOMOBILE", 0.5), ("SEG:BUILDING", 0.3), ("SEG:MACHINERY", 0.2)])]
PIT_LEGS = [("pit_gap", "spread", "m", 0, "PRI:1-URGENT", 1.0), ("pit_gap", "spread", "m", 1, "PRI:5-LOW", 1.0), ("pit_mix", "composite", "w", 0, "PRI:2-HIGH", 0.7), ("pit_mix", "composite", "w", 1, "PRI:3-MEDIUM", 0.3)]
RECON = [("urgent_high", "PRI:1-URGENT", "PRI:2-HIGH", 10.0), ("medium_low", "PRI:3-MEDIUM", "PRI:5-LOW", 25.0)]
CONCEPTS = [("Revenue", "TAG_O", 1), ("Revenue", "TAG_F", 2), ("Assets", "TAG_F", 1), ("Assets", "TAG_P", 2)]
RATIOS = [("turnover", "Revenue", "Assets"), ("inverse", "Assets", "Revenue")]
FREQUENCIES = [("PRI:1-URGENT", "m"), ("PRI:2-HIGH", "d"), ("PRI:3-MEDIUM", "q")]
SNAPSHOT_DATES = [f"{y}-{m:02d}-28" for y in range(1996, 2000) for m in (3, 6, 9, 12)]

LATEST = "SELECT series_id, observation_date, max_by(value, realtime_start) AS value, max(realtime_start) AS realtime_start FROM vintages GROUP BY 1, 2"
KNOWN = f"SELECT * FROM vintages WHERE realtime_start <= DATE '{AS_OF}' AND (realtime_end IS NULL OR realtime_end > DATE '{AS_OF}')"
YOY = "last_value(value) OVER (PARTITION BY series_id ORDER BY observation_date RANGE BETWEEN INTERVAL '405' DAY PRECEDING AND INTERVAL '365' DAY PRECEDING)"


def pct(now: str, base: str) -> str:
    return f"CASE WHEN {base} <> 0 THEN ({now} - {base}) / {base} END"


def transforms_sql(source: str) -> str:
    return f"""SELECT series_id, observation_date, value, {pct('value', 'prev')} AS mom, value - prev AS diff, {pct('value', 'ago')} AS yoy, CASE WHEN std > 0 THEN (value - mean) / std END AS zscore
FROM (SELECT *, lag(value) OVER w AS prev, {YOY} AS ago, avg(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mean, stddev_pop(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS std
  FROM {source} WINDOW w AS (PARTITION BY series_id ORDER BY observation_date)) AS t"""


def rolling_sql(source: str, keys: str, windows: list[int], percentile: bool = False) -> str:
    parts = []
    for w in windows:
        rank = f", len(list_filter(list(value) OVER (o ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), lambda x: x <= value)) / {w}.0 * 100 AS percentile" if percentile else ""
        parts.append(f"""SELECT {keys}, observation_date, {w} AS window_size, value, value - base AS change, {pct('value', 'base')} AS pct_change, CASE WHEN std > 1e-12 THEN (value - mean) / std END AS zscore{', percentile' if percentile else ''}
FROM (SELECT *, lag(value, {w}) OVER o AS base, row_number() OVER o AS k, avg(value) OVER (o ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS mean, stddev_pop(value) OVER (o ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS std{rank}
  FROM {source} WINDOW o AS (PARTITION BY {keys} ORDER BY observation_date)) AS t WHERE k > {w}""")
    return " UNION ALL ".join(parts)


KEYS = "series_id s, observation_date d"
register("latest_observation", f"{KEYS}, realtime_start d, value f", lambda s, d: bitemporal.latest_observation(a.vintages(s, d)), LATEST, "vintages")
register("revision_numbers", f"{KEYS}, realtime_start d, value f, revision_number i", lambda s, d: bitemporal.revision_numbers(a.vintages(s, d)), "SELECT *, row_number() OVER (PARTITION BY series_id, observation_date ORDER BY realtime_start NULLS FIRST) AS revision_number FROM vintages", "vintages")
register("point_in_time", f"{KEYS}, realtime_start d, realtime_end d, value f", lambda s, d: bitemporal.point_in_time(a.vintages(s, d)), "SELECT * FROM vintages", "vintages")
register("point_in_time_snapshot", f"{KEYS}, realtime_start d, value f", lambda s, d: bitemporal.snapshot(a.vintages(s, d), AS_OF), f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY observation_date DESC, realtime_start DESC) AS k FROM ({KNOWN})) AS t WHERE k = 1", "vintages")
register("first_report", f"{KEYS}, value f", lambda s, d: bitemporal.select_vintage(a.vintages(s, d)), "SELECT series_id, observation_date, min_by(value, realtime_start) AS value FROM vintages GROUP BY 1, 2", "vintages")
register("vintage_as_of", f"{KEYS}, value f", lambda s, d: bitemporal.select_vintage(a.vintages(s, d), AS_OF), f"SELECT series_id, observation_date, max_by(value, realtime_start) AS value FROM vintages WHERE realtime_start <= DATE '{AS_OF}' GROUP BY 1, 2", "vintages")
STATS = "SELECT *, latest_value - first_value AS revision_delta, CASE WHEN first_value <> 0 THEN (latest_value - first_value) / first_value END AS revision_pct FROM (SELECT series_id, observation_date, count(*) AS revision_count, min_by(value, realtime_start) AS first_value, max_by(value, realtime_start) AS latest_value, min(realtime_start) AS first_realtime, max(realtime_start) AS latest_realtime FROM vintages GROUP BY 1, 2) AS t"
register("revision_stats", f"{KEYS}, revision_count i, first_value f, latest_value f, first_realtime d, latest_realtime d, revision_delta f, revision_pct f", lambda s, d: bitemporal.revision_stats(a.vintages(s, d)), STATS, "vintages")
register("revision_summary", "series_id s, n_dates i, avg_revisions f, max_revisions i, avg_abs_pct f, max_abs_pct f", lambda s, d: bitemporal.revision_summary(a.vintages(s, d)), f"SELECT series_id, count(*) AS n_dates, avg(revision_count) AS avg_revisions, max(revision_count) AS max_revisions, avg(abs(revision_pct)) AS avg_abs_pct, max(abs(revision_pct)) AS max_abs_pct FROM ({STATS}) GROUP BY 1", "vintages")
register("series_latest_value", f"{KEYS}, value f", lambda s, d: bitemporal.series_latest_value(a.daily(s, d)), "SELECT series_id, max(observation_date) AS observation_date, max_by(value, observation_date) AS value FROM daily GROUP BY 1", "daily")
register("restate_start", "series_id s, restate_from d, n_dates i", lambda s, d: bitemporal.restate_start(a.vintages(s, d), 12), "SELECT series_id, min(observation_date) AS restate_from, count(*) AS n_dates FROM (SELECT series_id, observation_date, row_number() OVER (PARTITION BY series_id ORDER BY observation_date DESC) AS k FROM (SELECT DISTINCT series_id, observation_date FROM vintages)) AS t WHERE k <= 12 GROUP BY 1", "vintages")
register("latest_dates", "series_id s, latest_date d", lambda s, d: bitemporal.latest_dates(a.daily(s, d)), "SELECT series_id, max(observation_date) AS latest_date FROM daily GROUP BY 1", "daily")
register(
    "backfill_transforms", f"as_of_date d, {KEYS}, value f, mom f, diff f, yoy f, zscore f",
    lambda s, d: _backfill(s, d),
    transforms_sql("(SELECT CAST(as_of_date AS VARCHAR) || '|' || series_id AS series_id, observation_date, max_by(value, realtime_start) AS value FROM vintages JOIN (SELECT CAST(unnest(" + str(SNAPSHOT_DATES) + ") AS DATE) AS as_of_date) ON realtime_start <= as_of_date GROUP BY 1, 2)").replace("SELECT series_id,", "SELECT CAST(split_part(series_id, '|', 1) AS DATE) AS as_of_date, split_part(series_id, '|', 2) AS series_id,", 1),
    "vintages",
)


def _backfill(spark, sf_dir):
    from pyspark.sql import functions as F

    dates = spark.createDataFrame([(x,) for x in SNAPSHOT_DATES], "d string").select(F.col("d").cast("date").alias("as_of_date"))
    rows = bitemporal.snapshots(a.vintages(spark, sf_dir), dates).withColumn("series_id", F.struct("as_of_date", "series_id"))
    out = features.feature_transforms(rows)
    return out.withColumn("as_of_date", F.col("series_id.as_of_date")).withColumn("series_id", F.col("series_id.series_id"))


ALLOWED = "CASE frequency WHEN 'd' THEN 10 WHEN 'w' THEN 21 WHEN 'm' THEN 75 WHEN 'q' THEN 200 WHEN 'a' THEN 550 ELSE 380 END"
register("source_coverage", "series_id s, latest_date d, n_dates i, frequency s, age_days i, is_stale b", lambda s, d: bitemporal.source_coverage(a.vintages(s, d), config(s, FREQUENCIES, "series_id string, frequency string"), TODAY), f"SELECT *, age_days > {ALLOWED} AS is_stale FROM (SELECT v.*, frequency, DATE '{TODAY}' - latest_date AS age_days FROM (SELECT series_id, max(observation_date) AS latest_date, count(DISTINCT observation_date) AS n_dates FROM vintages GROUP BY 1) v LEFT JOIN {values(FREQUENCIES, 'f', 'series_id, frequency')} USING (series_id)) AS t", "vintages")


def _pricing(spark, sf_dir):
    from pyspark.sql import functions as F

    names = a.holdings(spark, sf_dir).select(F.translate("constituent", "0123456789", "ABCDEFGHIJ").alias("ticker"), (F.floor(F.col("weight") / 1000) + 1).alias("rank"))
    priced = a.prices(spark, sf_dir).filter("ticker like '%1' or ticker like '%2'").groupBy(F.translate("ticker", "0123456789", "ABCDEFGHIJ").alias("ticker")).agg(F.max("observation_date").alias("latest_date"))
    return bitemporal.pricing_plan(names, priced, TODAY, 10, 40)


register("pricing_plan", "ticker s, rank i, missing b, latest_date d", _pricing, f"SELECT ticker, rank, latest_date IS NULL AS missing, latest_date FROM (SELECT translate(constituent, '0123456789', 'ABCDEFGHIJ') AS ticker, min(floor(weight / 1000) + 1) AS rank FROM holdings GROUP BY 1) LEFT JOIN (SELECT translate(ticker, '0123456789', 'ABCDEFGHIJ') AS ticker, max(observation_date) AS latest_date FROM prices WHERE ticker LIKE '%1' OR ticker LIKE '%2' GROUP BY 1) USING (ticker) WHERE regexp_matches(ticker, '^[A-Z][A-Z.\\-]*$') AND (latest_date IS NULL OR DATE '{TODAY}' - latest_date > 10) ORDER BY missing DESC, rank, ticker LIMIT 40", "holdings prices")

register("feature_transforms", f"{KEYS}, value f, mom f, diff f, yoy f, zscore f", lambda s, d: features.feature_transforms(a.monthly(s, d)), transforms_sql("monthly"), "monthly")
register("daily_matrix", f"{KEYS}, value f, filled f", lambda s, d: features.daily_matrix(a.daily(s, d)), "SELECT g.series_id, g.day AS observation_date, d.value, last_value(d.value IGNORE NULLS) OVER (PARTITION BY g.series_id ORDER BY g.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM (SELECT series_id, CAST(unnest(generate_series(CAST(min(observation_date) AS TIMESTAMP), CAST((SELECT max(observation_date) FROM daily) AS TIMESTAMP), INTERVAL '1' DAY)) AS DATE) AS day FROM daily GROUP BY series_id) g LEFT JOIN daily d ON d.series_id = g.series_id AND d.observation_date = g.day", "daily")
PAIR_SQL = f"SELECT name, op, x.observation_date, CASE WHEN op = 'ratio' THEN CASE WHEN y.value <> 0 THEN x.value / y.value END ELSE x.value - y.value END AS value FROM {values(PAIRS, 'p', 'name, op, long_leg, short_leg')} JOIN monthly x ON x.series_id = long_leg JOIN monthly y ON y.series_id = short_leg AND y.observation_date = x.observation_date"
register("curve_spread", "name s, op s, observation_date d, value f", lambda s, d: features.curve_spreads(a.monthly(s, d), config(s, PAIRS, "name string, op string, long_leg string, short_leg string")), f"SELECT * FROM ({PAIR_SQL}) AS t WHERE value IS NOT NULL", "monthly")
LEG_SCHEMA = "feature_name string, op string, freq string, leg int, series_id string, weight double"


def cross_sql(source: str, legs: list) -> str:
    starts = " ".join(f"WHEN '{f}' THEN CAST(date_trunc('{u}', observation_date) AS DATE)" for f, u in (("w", "week"), ("m", "month"), ("q", "quarter"), ("a", "year")))
    return f"""SELECT feature_name, op, period AS observation_date, CASE op WHEN 'spread' THEN x - y WHEN 'ratio' THEN CASE WHEN y <> 0 THEN x / y END ELSE s END AS value FROM (
SELECT feature_name, op, period, max(CASE WHEN leg = 0 THEN value END) AS x, max(CASE WHEN leg = 1 THEN value END) AS y, sum(weight * value) AS s, count(*) AS n FROM (
SELECT feature_name, op, leg, weight, CASE freq {starts} ELSE observation_date END AS period, max_by(value, observation_date) AS value FROM {source} JOIN {values(legs, 'l', 'feature_name, op, freq, leg, series_id, weight')} USING (series_id) GROUP BY 1, 2, 3, 4, 5) AS e GROUP BY 1, 2, 3) AS t
JOIN (SELECT feature_name, count(*) AS n_legs FROM {values(legs, 'l', 'feature_name, op, freq, leg, series_id, weight')} GROUP BY 1) USING (feature_name) WHERE n = n_legs AND (op <> 'ratio' OR y <> 0)"""


register("cross_series", "feature_name s, op s, observation_date d, value f", lambda s, d: features.cross_series(a.monthly(s, d), config(s, LEGS, LEG_SCHEMA)), cross_sql("monthly", LEGS), "monthly")
register("cross_series_pit", "feature_name s, op s, observation_date d, value f, basis s", lambda s, d: features.cross_series_pit(a.vintages(s, d), config(s, PIT_LEGS, LEG_SCHEMA)), "SELECT *, 'first_report' AS basis FROM (" + cross_sql("(SELECT series_id, observation_date, min_by(value, realtime_start) AS value FROM vintages GROUP BY 1, 2)", PIT_LEGS) + ") AS c", "vintages")
register("reconciliation", "name s, observation_date d, value_a f, value_b f, abs_diff f, pct_diff f, diverged b", lambda s, d: features.reconciliation(a.daily(s, d), config(s, RECON, "name string, series_a string, series_b string, tolerance_pct double"), "w"), f"""SELECT name, x.period AS observation_date, x.value AS value_a, y.value AS value_b, abs(x.value - y.value) AS abs_diff, {pct('x.value', 'y.value')} AS pct_diff, coalesce(abs({pct('x.value', 'y.value')}) * 100 > tolerance_pct, false) AS diverged
FROM {values(RECON, 'p', 'name, series_a, series_b, tolerance_pct')} JOIN week x ON x.series_id = series_a JOIN week y ON y.series_id = series_b AND y.period = x.period""".replace("week x", "(SELECT series_id, CAST(date_trunc('week', observation_date) AS DATE) AS period, max_by(value, observation_date) AS value FROM daily GROUP BY 1, 2) x").replace("week y", "(SELECT series_id, CAST(date_trunc('week', observation_date) AS DATE) AS period, max_by(value, observation_date) AS value FROM daily GROUP BY 1, 2) y"), "daily")
FUND_SQL = f"SELECT cik, concept, observation_date, value, tag FROM (SELECT *, row_number() OVER (PARTITION BY cik, concept, observation_date ORDER BY priority, realtime_start DESC, value) AS k FROM facts JOIN {values(CONCEPTS, 'c', 'concept, tag, priority')} USING (tag)) AS t WHERE k = 1"
RATIO_SQL = f"SELECT n.cik, ratio, n.observation_date, n.value / d.value AS value FROM {values(RATIOS, 'r', 'ratio, numerator, denominator')} JOIN ({FUND_SQL}) n ON n.concept = numerator JOIN ({FUND_SQL}) d ON d.concept = denominator AND d.cik = n.cik AND d.observation_date = n.observation_date WHERE d.value <> 0"


def _fundamentals(s, d):
    return features.company_fundamentals(a.facts(s, d), config(s, CONCEPTS, "concept string, tag string, priority int"))


def _ratios(s, d):
    return features.company_ratios(_fundamentals(s, d), config(s, RATIOS, "ratio string, numerator string, denominator string"))


register("company_fundamentals", "cik s, concept s, observation_date d, value f, tag s", _fundamentals, FUND_SQL, "facts")
register("company_ratios", "cik s, ratio s, observation_date d, value f", _ratios, RATIO_SQL, "facts")
register("ratio_ranks", "cik s, ratio s, observation_date d, value f, pct_rank f, position i", lambda s, d: features.ratio_ranks(_ratios(s, d)), f"SELECT *, percent_rank() OVER (PARTITION BY ratio, observation_date ORDER BY value) AS pct_rank, row_number() OVER (PARTITION BY ratio, observation_date ORDER BY value DESC, cik) AS position FROM ({RATIO_SQL}) AS t", "facts")
register("zscore_rolling", f"{KEYS}, window_size i, value f, change f, pct_change f, zscore f, percentile f", lambda s, d: features.zscore_rolling(a.monthly(s, d)), rolling_sql("monthly", "series_id", [12, 36, 60, 120], True), "monthly")
_HEAT = ", ".join(f"CASE WHEN k >= {w} AND s{w} > 1e-12 THEN (value - m{w}) / s{w} END AS z_{w}, CASE WHEN k >= {w} THEN len(list_filter(l{w}, lambda x: x <= value)) / {w}.0 * 100 END AS pct_{w}" for w in features.HEATMAP_WINDOWS)
_HEAT_IN = ", ".join(f"avg(value) OVER (o ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS m{w}, stddev_pop(value) OVER (o ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS s{w}, list(value) OVER (o ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS l{w}" for w in features.HEATMAP_WINDOWS)
register("zscore_heatmap", f"{KEYS}, value f, z_full f, pct_full f, " + ", ".join(f"z_{w} f, pct_{w} f" for w in features.HEATMAP_WINDOWS), lambda s, d: features.zscore_heatmap(a.monthly(s, d)), f"SELECT series_id, observation_date, value, CASE WHEN sf > 0 THEN (value - mf) / sf END AS z_full, len(list_filter(lf, lambda x: x <= value)) / k * 100 AS pct_full, {_HEAT} FROM (SELECT *, CAST(row_number() OVER o AS DOUBLE) AS k, avg(value) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mf, stddev_pop(value) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sf, list(value) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lf, {_HEAT_IN} FROM monthly WINDOW o AS (PARTITION BY series_id ORDER BY observation_date)) AS t", "monthly")
