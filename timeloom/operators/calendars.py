"""Dates, market calendars and release calendars, from column arithmetic alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Holidays as (name, rule, markets, first year). A rule is a fixed
# month-day, the n-th (or -1: last) weekday of a month with Sunday as 1, or days from Easter.
HOLIDAYS = [
    ("New Year's Day", ("fixed", 1, 1), "NYSE SIFMA FEDWIRE", 0),
    ("Martin Luther King Jr. Day", ("nth", 1, 2, 3), "NYSE SIFMA FEDWIRE", 0),
    ("Washington's Birthday", ("nth", 2, 2, 3), "NYSE SIFMA FEDWIRE", 0),
    ("Good Friday", ("easter", -2), "NYSE SIFMA", 0),
    ("Memorial Day", ("nth", 5, 2, -1), "NYSE SIFMA FEDWIRE", 0),
    ("Juneteenth National Independence Day", ("fixed", 6, 19), "NYSE SIFMA FEDWIRE", 2022),
    ("Independence Day", ("fixed", 7, 4), "NYSE SIFMA FEDWIRE", 0),
    ("Labor Day", ("nth", 9, 2, 1), "NYSE SIFMA FEDWIRE", 0),
    ("Columbus Day", ("nth", 10, 2, 2), "SIFMA FEDWIRE", 0),
    ("Veterans Day", ("fixed", 11, 11), "SIFMA FEDWIRE", 0),
    ("Thanksgiving Day", ("nth", 11, 5, 4), "NYSE SIFMA FEDWIRE", 0),
    ("Christmas Day", ("fixed", 12, 25), "NYSE SIFMA FEDWIRE", 0),
]
PERIODS = ("month", "quarter", "year")
MARKETS = ("NYSE", "SIFMA", "FEDWIRE")


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """The n-th weekday (Sunday: 1) of a month, or its last with n = -1."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n > 0:
        return F.date_add(first, F.pmod(F.lit(weekday) - F.dayofweek(first), F.lit(7)) + 7 * (n - 1))
    last = F.last_day(first)
    return F.date_sub(last, F.pmod(F.dayofweek(last) - weekday, F.lit(7)))


def easter(year: Column) -> Column:
    """Easter Sunday in the Gregorian calendar, by Gauss's rule with the usual corrections."""
    golden, century = year % 19, F.floor(year / 100)
    epact = F.pmod(century - F.floor(century / 4) - F.floor((8 * century + 13) / 25) + 19 * golden + 15, F.lit(30))
    moon = epact - F.floor(epact / 28) * (1 - F.floor(F.lit(29) / (epact + 1)) * F.floor((21 - golden) / 11))
    weekday = F.pmod(year + F.floor(year / 4) + moon + 2 - century + F.floor(century / 4), F.lit(7))
    shift = moon - weekday
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), shift.cast("int"))


def _rule(rule: tuple, year: Column) -> Column:
    if rule[0] == "fixed":
        return F.make_date(year, F.lit(rule[1]), F.lit(rule[2]))
    if rule[0] == "nth":
        return nth_weekday(year, *rule[1:])
    return F.date_add(easter(year), rule[1])


def holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """(market, holiday, observed): Sunday moves to Monday; Saturday to Friday at NYSE except New Year's Day, and is dropped elsewhere."""
    year = F.col("id").cast("int")
    rules = [F.struct(F.lit(name).alias("holiday"), F.when(year >= since, _rule(rule, year)).alias("day"), F.array(*[F.lit(m) for m in markets.split()]).alias("markets")) for name, rule, markets, since in HOLIDAYS]
    rows = spark.range(first_year, last_year + 2).select(F.explode(F.array(*rules)).alias("h")).select("h.*").filter("day is not null")
    rows = rows.select("holiday", "day", F.explode("markets").alias("market"))
    kept = F.when((F.col("market") == "NYSE") & (F.col("holiday") != "New Year's Day"), F.date_sub("day", 1))
    observed = F.when(F.dayofweek("day") == 1, F.date_add("day", 1)).when(F.dayofweek("day") == 7, kept).otherwise(F.col("day"))
    return rows.select("market", "holiday", observed.alias("observed")).filter("observed is not null")


def market_calendar(spark: SparkSession, start: str, end: str, closures: DataFrame | None = None) -> DataFrame:
    """A row per market and day: is it a business day, the ones before and after, T+2, its place in the month, and is it the first or last of its month, quarter or year.

    closures: (market, observed, holiday), further closed days. The calendar is padded, so that the ends have neighbours.
    """
    lo, hi = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    off = holidays(spark, int(start[:4]) - 1, int(end[:4]) + 2)
    off = off.unionByName(closures) if closures is not None else off
    off = off.groupBy("market", F.col("observed").alias("day")).agg(F.min("holiday").alias("holiday"))
    days = spark.range(1).select(F.explode(F.sequence(F.date_sub(F.trunc(lo, "year"), 40), F.date_add(hi, 406))).alias("day"), F.array(*[F.lit(m) for m in MARKETS]).alias("ms")).select("day", F.explode("ms").alias("market"))
    rows = days.join(F.broadcast(off), ["market", "day"], "left")  # some dozen days per year
    rows = rows.withColumn("is_business_day", ~F.dayofweek("day").isin(1, 7) & F.col("holiday").isNull())
    open_day = F.when(F.col("is_business_day"), F.col("day"))
    # Backwards as well as forwards, so that both neighbours come from running frames.
    order, back = Window.partitionBy("market").orderBy("day"), Window.partitionBy("market").orderBy(F.col("day").desc())
    month = Window.partitionBy("market", F.trunc("day", "month"))
    rows = rows.withColumn("prior_business_day", F.last(open_day, True).over(order.rowsBetween(Window.unboundedPreceding, -1))).withColumn("next_business_day", F.last(open_day, True).over(back.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("business_day_of_month", F.when(F.col("is_business_day"), F.sum(F.col("is_business_day").cast("int")).over(month.orderBy("day"))))
    for unit in PERIODS:
        period = Window.partitionBy("market", F.trunc("day", unit))
        for name, pick in (("first", F.min), ("last", F.max)):
            rows = rows.withColumn(f"is_{name}_of_{unit}", F.coalesce(F.col("day") == pick(open_day).over(period), F.lit(False)))
    after = rows.select("market", F.col("day").alias("next_business_day"), F.col("next_business_day").alias("t_plus_2"))
    rows = rows.join(after, ["market", "next_business_day"], "left")
    return rows.filter(F.col("day").between(lo, hi)).select("market", "day", "is_business_day", "holiday", "prior_business_day", "next_business_day", "t_plus_2", "business_day_of_month", *[f"is_{x}_of_{unit}" for unit in PERIODS for x in ("first", "last")])


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Attributes of each day: calendar and fiscal (October) periods, ISO weeks, month and quarter ends, IMM, option expiry."""
    d = F.col("day")
    y, m = F.year(d), F.month(d)
    third_wed = F.date_add(F.trunc(d, "month"), F.pmod(4 - F.dayofweek(F.trunc(d, "month")), F.lit(7)) + 14)
    third_fri = F.date_add(F.trunc(d, "month"), F.pmod(6 - F.dayofweek(F.trunc(d, "month")), F.lit(7)) + 14)
    fiscal = F.add_months(d, 3)
    quarter_end = F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day")).select(
        d.alias("date_key"), (y * 10000 + m * 100 + F.dayofmonth(d)).alias("date_int"), y.alias("year"), F.quarter(d).alias("quarter"), m.alias("month"), F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"),
        F.dayofweek(d).alias("dow_sunday_first"), (F.weekday(d) + 1).alias("dow_iso"), F.weekofyear(d).alias("iso_week"), F.year(F.date_add(F.trunc(d, "week"), 3)).alias("iso_year"), F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("day_name"),
        F.trunc(d, "week").alias("week_start"), F.date_add(F.trunc(d, "week"), 6).alias("week_end"), F.trunc(d, "month").alias("month_start"), F.last_day(d).alias("month_end"), F.trunc(d, "quarter").alias("quarter_start"), quarter_end.alias("quarter_end"),
        F.trunc(d, "year").alias("year_start"), F.make_date(y, F.lit(12), F.lit(31)).alias("year_end"), F.year(fiscal).alias("fiscal_year"), F.quarter(fiscal).alias("fiscal_quarter"), F.month(fiscal).alias("fiscal_month"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"), (d == F.last_day(d)).alias("is_month_end"), (d == quarter_end).alias("is_quarter_end"), ((m == 12) & (F.dayofmonth(d) == 31)).alias("is_year_end"), (F.dayofmonth(d) == 1).alias("is_month_start"),
        F.date_format(d, "yyyy-MM").alias("year_month"), F.concat(y.cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"), (F.dayofmonth(F.last_day(d))).alias("days_in_month"),
        ((m % 3 == 0) & (d == third_wed)).alias("is_imm_date"), (d == third_fri).alias("is_option_expiry"), ((m % 3 == 0) & (d == third_fri)).alias("is_triple_witching"),
    )


def dim_series(catalog: DataFrame, meta: DataFrame) -> DataFrame:
    """Catalogued series with title, frequency and units, blank where unknown."""
    rest = [F.coalesce(c, F.lit("")).alias(c) for c in ("title", "frequency", "units")]
    return catalog.join(meta.dropDuplicates(["series_id"]), "series_id", "left").select(*catalog.columns, *rest)


def release_calendar(releases: DataFrame, curated: DataFrame, as_of: str) -> DataFrame:
    """(release_id, release_date, is_future) of curated releases, each once."""
    rows = releases.join(F.broadcast(curated.select("release_id").distinct()), "release_id", "left_semi").select("release_id", "release_date").distinct()
    return rows.withColumn("is_future", F.col("release_date") > F.to_date(F.lit(as_of)))


def table_catalog(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table_name, column_name, type) of every registered table, from the specs of its query."""
    rows = [(name, *part.split()) for name, spec in tables.items() for part in spec.split(",")]
    return spark.createDataFrame(rows, "table_name string, column_name string, type string")
