"""Calendar and statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeloom.operators import calendars, lab
from timeloom.operators import kernels as k
from timeloom.plans import adapters as a
from timeloom.plans.core import YOY
from timeloom.plans.registry import SPECS, config, register, values

START, END = "1995-01-01", "2025-12-31"
_DAY = "CAST(unnest(generate_series(TIMESTAMP '{0}', TIMESTAMP '{1}', INTERVAL '1' DAY)) AS DATE)"
register(
    "dim_date",
    "date_key d, date_int i, year i, quarter i, month i, day_of_month i, day_of_year i, dow_sunday_first i, dow_iso i, iso_week i, iso_year i, month_name s, day_name s, week_start d, week_end d, month_start d, month_end d, quarter_start d, quarter_end d, year_start d, year_end d, "
    "fiscal_year i, fiscal_quarter i, fiscal_month i, is_weekend b, is_month_end b, is_quarter_end b, is_year_end b, is_month_start b, year_month s, year_quarter s, days_in_month i, is_imm_date b, is_option_expiry b, is_triple_witching b",
    lambda s, d: calendars.dim_date(s, START, END),
    f"""SELECT d AS date_key, year(d) * 10000 + month(d) * 100 + day(d) AS date_int, year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day_of_month, dayofyear(d) AS day_of_year, dayofweek(d) + 1 AS dow_sunday_first, isodow(d) AS dow_iso, weekofyear(d) AS iso_week, isoyear(d) AS iso_year, monthname(d) AS month_name, dayname(d) AS day_name,
date_trunc('week', d) AS week_start, date_trunc('week', d) + INTERVAL 6 DAY AS week_end, date_trunc('month', d) AS month_start, last_day(d) AS month_end, date_trunc('quarter', d) AS quarter_start, last_day(CAST(date_trunc('quarter', d) + INTERVAL 2 MONTH AS DATE)) AS quarter_end, date_trunc('year', d) AS year_start, make_date(year(d), 12, 31) AS year_end,
year(d + INTERVAL 3 MONTH) AS fiscal_year, quarter(d + INTERVAL 3 MONTH) AS fiscal_quarter, month(d + INTERVAL 3 MONTH) AS fiscal_month, dayofweek(d) IN (0, 6) AS is_weekend, d = last_day(d) AS is_month_end, d = last_day(CAST(date_trunc('quarter', d) + INTERVAL 2 MONTH AS DATE)) AS is_quarter_end, month(d) = 12 AND day(d) = 31 AS is_year_end, day(d) = 1 AS is_month_start, strftime(d, '%Y-%m') AS year_month, year(d) || '-Q' || quarter(d) AS year_quarter, day(last_day(d)) AS days_in_month,
month(d) % 3 = 0 AND dayofweek(d) = 3 AND day(d) BETWEEN 15 AND 21 AS is_imm_date, dayofweek(d) = 5 AND day(d) BETWEEN 15 AND 21 AS is_option_expiry, month(d) % 3 = 0 AND dayofweek(d) = 5 AND day(d) BETWEEN 15 AND 21 AS is_triple_witching FROM (SELECT {_DAY.format(START, END)} AS d) AS days""",
)


def _nth(month: int, weekday: int, n: int) -> str:
    if n < 0:
        return f"(SELECT max(x) FROM (SELECT CAST(unnest(generate_series(make_date(y, {month}, 1), last_day(make_date(y, {month}, 1)), INTERVAL '1' DAY)) AS DATE) AS x) WHERE dayofweek(x) = {weekday - 1})"
    return f"(make_date(y, {month}, 1) + CAST(({weekday - 1} - dayofweek(make_date(y, {month}, 1)) + 7) % 7 + {7 * (n - 1)} AS INTEGER))"


def _holiday_sql() -> str:
    rows = []
    for name, rule, markets, since in calendars.HOLIDAYS:
        day = f"make_date(y, {rule[1]}, {rule[2]})" if rule[0] == "fixed" else _nth(*rule[1:]) if rule[0] == "nth" else f"(easter + ({rule[1]}))"
        for m in markets.split():
            saturday = "CAST(d AS DATE) - 1" if m == "NYSE" and not name.startswith("New Year") else "NULL"
            rows.append(f"SELECT '{m}' AS market, '{name.replace(chr(39), chr(39) * 2)}' AS holiday, CASE dayofweek(d) WHEN 0 THEN CAST(d AS DATE) + 1 WHEN 6 THEN {saturday} ELSE CAST(d AS DATE) END AS day FROM (SELECT {day} AS d FROM years WHERE y >= {since}) AS t")
    return " UNION ALL ".join(rows)


# Easter here by the Meeus form, as a check on the Gauss form of the operator.
_EASTER = """SELECT y, make_date(CAST(y AS BIGINT), CAST((h + l - 7 * m + 114) // 31 AS BIGINT), CAST((h + l - 7 * m + 114) % 31 + 1 AS BIGINT)) AS easter FROM (SELECT *, (aa + 11 * h + 22 * l) // 451 AS m FROM (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM (
SELECT *, (19 * aa + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM (SELECT y, y % 19 AS aa, y // 100 AS b, y % 100 AS c FROM range(1994, 2028) r(y)))))"""
_EDGES = ", ".join(f"f.is_business_day AND p.day < date_trunc('{u}', f.day) AS is_first_of_{u}, f.is_business_day AND date_trunc('{u}', x.day) > date_trunc('{u}', f.day) AS is_last_of_{u}" for u in calendars.PERIODS)
register(
    "market_calendar", "market s, day d, is_business_day b, holiday s, prior_business_day d, next_business_day d, t_plus_2 d, business_day_of_month i, " + ", ".join(f"is_{x}_of_{u} b" for u in calendars.PERIODS for x in ("first", "last")),
    lambda s, d: calendars.market_calendar(s, START, END),
    f"""WITH years AS ({_EASTER}), off AS (SELECT market, day, min(holiday) AS holiday FROM ({_holiday_sql()}) WHERE day IS NOT NULL GROUP BY 1, 2),
days AS (SELECT day, market FROM (SELECT {_DAY.format('1994-11-01', '2026-02-15')} AS day), (VALUES ('NYSE'), ('SIFMA'), ('FEDWIRE')) AS m(market)),
marked AS (SELECT d.market, d.day, off.holiday, dayofweek(d.day) NOT IN (0, 6) AND off.holiday IS NULL AS is_business_day FROM days d LEFT JOIN off ON off.market = d.market AND off.day = d.day),
numbered AS (SELECT *, row_number() OVER (PARTITION BY market ORDER BY day) AS n FROM marked WHERE is_business_day),
found AS (SELECT m.*, (SELECT max(n.n) FROM numbered n WHERE n.market = m.market AND n.day <= m.day) AS upto FROM marked m)
SELECT f.market, f.day, f.is_business_day, f.holiday, p.day AS prior_business_day, x.day AS next_business_day, t.day AS t_plus_2, CASE WHEN f.is_business_day THEN count(*) FILTER (f.is_business_day) OVER (PARTITION BY f.market, date_trunc('month', f.day) ORDER BY f.day) END AS business_day_of_month,
{_EDGES}
FROM found f JOIN numbered p ON p.market = f.market AND p.n = f.upto - CAST(f.is_business_day AS INT) JOIN numbered x ON x.market = f.market AND x.n = f.upto + 1 JOIN numbered t ON t.market = f.market AND t.n = f.upto + 2 WHERE f.day BETWEEN DATE '{START}' AND DATE '{END}'""",
)


def _catalog(s, d):
    rows = a.table(s, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("series_id"), F.col("n_regionkey").alias("polarity"))
    meta = a.table(s, d, "nation").filter("n_nationkey < 15").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("series_id"), F.col("n_name").alias("title"), F.lit("Monthly").alias("frequency"), F.lit(None).cast("string").alias("units"))
    return calendars.dim_series(rows, meta)


register("dim_series", "series_id s, polarity i, title s, frequency s, units s", _catalog, "SELECT 'N' || n_nationkey AS series_id, n_regionkey AS polarity, CASE WHEN n_nationkey < 15 THEN n_name ELSE '' END AS title, CASE WHEN n_nationkey < 15 THEN 'Monthly' ELSE '' END AS frequency, '' AS units FROM nation")
register("release_calendar", "release_id i, release_date d, is_future b", lambda s, d: calendars.release_calendar(a.table(s, d, "events").select((F.col("user_id") % 20).alias("release_id"), F.col("ts").cast("date").alias("release_date")), config(s, [(1,), (5,), (9,), (13,)], "release_id bigint"), "2024-01-15"), "SELECT DISTINCT user_id % 20 AS release_id, CAST(ts AS DATE) AS release_date, CAST(ts AS DATE) > DATE '2024-01-15' AS is_future FROM events WHERE user_id % 20 IN (1, 5, 9, 13)")
register("powerbi_catalog", "table_name s, column_name s, type s", lambda s, d: calendars.table_catalog(s, {n: x for n, x in SPECS.items() if n != "powerbi_catalog"}))

PAIRS = [("urgent_low", "PRI:1-URGENT", "PRI:5-LOW"), ("high_medium", "PRI:2-HIGH", "PRI:3-MEDIUM")]


def _both(s, d, obs=None):
    return lab.aligned(obs or a.daily(s, d), config(s, PAIRS, "pair string, series_a string, series_b string"))


_DIFF = "SELECT * FROM (SELECT series_id, observation_date, value - lag(value) OVER (PARTITION BY series_id ORDER BY observation_date) AS value FROM daily) WHERE value IS NOT NULL"
_BOTH = f"SELECT pair, x.observation_date, x.value AS a, y.value AS b FROM {values(PAIRS, 'p', 'pair, series_a, series_b')} JOIN ({_DIFF}) x ON x.series_id = series_a JOIN ({_DIFF}) y ON y.series_id = series_b AND y.observation_date = x.observation_date"
_CORR = " UNION ALL ".join(f"SELECT pair, observation_date, {w} AS window_size, corr(a, b) OVER (PARTITION BY pair ORDER BY observation_date ROWS BETWEEN {w - 1 if w else 'UNBOUNDED'} PRECEDING AND CURRENT ROW) AS correlation FROM ({_BOTH}) QUALIFY row_number() OVER (PARTITION BY pair ORDER BY observation_date) >= {w or 3}" for w in (63, 252, 0))
register("correlation", "pair s, observation_date d, window_size i, correlation f", lambda s, d: lab.correlation(_both(s, d), (63, 252, 0)), _CORR, "daily")
register("lead_lag", "pair s, lag i, n i, correlation f, is_best b", lambda s, d: lab.lead_lag(_both(s, d)), f"SELECT *, lag = first_value(lag) OVER (PARTITION BY pair ORDER BY round(abs(correlation), 9) DESC NULLS LAST, lag) AS is_best FROM (SELECT x.pair, l.lag, count(*) AS n, corr(x.a, y.b) AS correlation FROM (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY observation_date) AS rn FROM ({_BOTH})) x, (SELECT unnest(range(-12, 13)) AS lag) l, (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY observation_date) AS rn FROM ({_BOTH})) y WHERE y.pair = x.pair AND y.rn = x.rn + l.lag GROUP BY 1, 2 HAVING count(*) >= 3) AS t", "daily")
register("granger", "pair s, direction s, f f, p f, n i", lambda s, d: lab.granger(_both(s, d)))


def _scaled(s, d):
    return a.monthly(s, d).withColumn("value", F.col("value") / 1e6)


_X = "SELECT series_id, observation_date, value / 1e6 AS value, CAST(row_number() OVER (PARTITION BY series_id ORDER BY observation_date) AS DOUBLE) AS x, count(*) OVER (PARTITION BY series_id) AS n FROM monthly"


def _rss(lo: str) -> str:
    return f"(SELECT regr_syy(t.value, t.x) - CASE WHEN regr_sxx(t.value, t.x) > 1e-12 THEN regr_sxy(t.value, t.x) ^ 2 / regr_sxx(t.value, t.x) ELSE 0 END FROM xs t WHERE t.series_id = c.series_id {lo})"


register("chow_scan", "series_id s, break_date d, f_stat f, n_obs i", lambda s, d: lab.chow_scan(_scaled(s, d)), f"WITH xs AS ({_X}), scan AS (SELECT c.series_id, c.observation_date, c.x, c.n, {_rss('AND t.x <= c.x')} + {_rss('AND t.x > c.x')} AS apart, {_rss('')} AS whole FROM xs c WHERE c.x >= greatest(20, floor(c.n * 0.15)) AND c.n - c.x >= greatest(20, floor(c.n * 0.15))) SELECT series_id, observation_date AS break_date, f AS f_stat, n AS n_obs FROM (SELECT *, round(((whole - apart) / 2) / (apart / (n - 4)), 9) AS f FROM scan) QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY f DESC, x) = 1", "monthly")
_CUSUM = f"WITH xs AS ({_X}), fit AS (SELECT series_id, regr_slope(value, x) AS b, regr_intercept(value, x) AS a0 FROM xs GROUP BY 1), res AS (SELECT xs.*, value - a0 - b * x AS e FROM xs JOIN fit USING (series_id)), cum AS (SELECT *, sum(e) OVER (PARTITION BY series_id ORDER BY x) / sqrt(sum(e * e) OVER (PARTITION BY series_id) / (n - 2)) / sqrt(n) AS s FROM res) SELECT series_id, coalesce(min(observation_date) FILTER (abs(s) > 1.358), max_by(observation_date, abs(s))) AS break_date, max(abs(s)) AS stat, least(1.0, 2 * exp(-2 * max(abs(s)) ^ 2)) AS p_value, bool_or(abs(s) > 1.358) AS is_break, max(n) AS n_obs FROM cum GROUP BY 1"
register("cusum", "series_id s, break_date d, stat f, p_value f, is_break b, n_obs i", lambda s, d: lab.cusum(_scaled(s, d)), _CUSUM, "monthly")
register("structural_breaks", "series_id s, test s, break_date d, stat f, p_value f, mean_before f, mean_after f, n_obs i", lambda s, d: lab.structural_breaks(_scaled(s, d)))

INPUTS = [("growth", "SEG:AUTOMOBILE", 1, 1.0), ("growth", "SEG:BUILDING", 1, 0.5), ("inflation", "SEG:FURNITURE", 1, 1.0), ("credit", "SEG:MACHINERY", -1, 1.0)]
PILLARS = {"growth": 1.0, "inflation": -0.5, "credit": 0.5}
RULES = [("boom", [("growth", ">", 0.5), ("credit", ">", 0.0)]), ("stagflation", [("growth", "<", 0.0), ("inflation", ">", 0.5)]), ("slump", [("growth", "<", -0.5)])]
_Z = f"SELECT pillar, series_id, weight, observation_date, direction * (value - m) / sd AS z FROM (SELECT *, avg(value) OVER o AS m, stddev_pop(value) OVER o AS sd FROM monthly JOIN {values(INPUTS, 'i', 'pillar, series_id, direction, weight')} USING (series_id) WINDOW o AS (PARTITION BY pillar, series_id ORDER BY observation_date)) AS t WHERE sd > 0"
_CASES = " ".join("WHEN " + " AND ".join(f"{p} {op} {t}" for p, op, t in c) + f" THEN '{n}'" for n, c in RULES)
_MARGINS = " ".join("WHEN " + " AND ".join(f"{p} {op} {t}" for p, op, t in c) + " THEN least(" + ", ".join(f"abs({p} - {t})" for p, _, t in c) + ")" for n, c in RULES)
register("regime", "observation_date d, growth f, inflation f, credit f, composite f, regime s, confidence f", lambda s, d: lab.regime(a.monthly(s, d), config(s, INPUTS, "pillar string, series_id string, direction int, weight double"), PILLARS, RULES, "neutral"), f"WITH z AS ({_Z}), live AS (SELECT sp.observation_date, sp.pillar, sp.weight, z.z FROM (SELECT d.observation_date, i.pillar, i.series_id, i.weight FROM (SELECT DISTINCT observation_date FROM z) d, (SELECT DISTINCT pillar, series_id, weight FROM z) i) sp ASOF JOIN z ON z.pillar = sp.pillar AND z.series_id = sp.series_id AND sp.observation_date >= z.observation_date WHERE sp.observation_date - z.observation_date <= 200), wide AS (SELECT observation_date, " + ", ".join(f"max(CASE WHEN pillar = '{p}' THEN s END) AS {p}" for p in PILLARS) + f" FROM (SELECT observation_date, pillar, sum(weight * z) / sum(weight) AS s FROM live GROUP BY 1, 2) GROUP BY 1 HAVING count(*) = 3) SELECT *, (growth - 0.5 * inflation + 0.5 * credit) / 2.0 AS composite, CASE {_CASES} ELSE 'neutral' END AS regime, CASE {_MARGINS} END AS confidence FROM wide", "monthly")
_YOY_OBS = f"SELECT * FROM (SELECT series_id, observation_date, CASE WHEN ago <> 0 THEN (value - ago) / ago END AS value FROM (SELECT *, {YOY} AS ago FROM monthly)) AS t WHERE value IS NOT NULL"
register("transform_yoy", "series_id s, observation_date d, value f", lambda s, d: lab.transformed(a.monthly(s, d), "yoy"), _YOY_OBS, "monthly")
register("downsample_weekly", "series_id s, period d, value f", lambda s, d: k.downsampled(a.daily(s, d), "w"), "SELECT series_id, CAST(date_trunc('week', observation_date) AS DATE) AS period, max_by(value, observation_date) AS value FROM daily GROUP BY 1, 2", "daily")
