"""Raw payloads to observation rows, with column functions only.

Each parser takes (series_id, payload) and gives (series_id, observation_date,
realtime_start, realtime_end, raw_value, value, is_missing). Payloads of one
request are one row, so parsing spreads over as many tasks as there are payloads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators.kernels import parse_value

COLUMNS = ("series_id", "observation_date", "realtime_start", "realtime_end", "raw_value", "value", "is_missing")


def period_date(period: Column) -> Column:
    """The first day of a period in any of the forms that providers write; null for others, M13 included."""
    p = F.upper(F.trim(period))
    year = F.substr(p, F.lit(1), F.lit(4)).try_cast("int")

    def part(pattern: str) -> Column:
        return F.regexp_extract(p, pattern, 1).try_cast("int")

    def first(month: Column) -> Column:
        return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))

    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    week = F.date_add(F.trunc(jan4, "week"), 7 * (part(r"W(\d{1,2})$") - 1))
    return (
        F.when(p.rlike(r"^\d{4}$"), F.make_date(year, F.lit(1), F.lit(1)))
        .when(p.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substr(p, F.lit(1), F.lit(10)).try_cast("date"))
        .when(p.rlike(r"^\d{8}$"), F.concat_ws("-", F.substr(p, F.lit(1), F.lit(4)), F.substr(p, F.lit(5), F.lit(2)), F.substr(p, F.lit(7), F.lit(2))).try_cast("date"))
        .when(p.rlike(r"^\d{4}-?M\d{1,2}$"), first(part(r"M(\d{1,2})$")))
        .when(p.rlike(r"^\d{4}-?\d{2}$"), first(part(r"(\d{2})$")))
        .when(p.rlike(r"^\d{4}-?Q0?[1-4]$"), first(part(r"([1-4])$") * 3 - 2))
        .when(p.rlike(r"^\d{4}-?S0?[12]$"), first(part(r"([12])$") * 6 - 5))
        .when(p.rlike(r"^\d{4}-?W\d{1,2}$"), week)
        .when(p.rlike(r"^\d{4}-?A\d*$"), F.make_date(year, F.lit(1), F.lit(1)))
    )


def _rows(df: DataFrame, date: Column, raw: Column, start: Column | None = None, end: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("date")
    value = parse_value(raw)
    out = df.select("series_id", date.alias("observation_date"), (start if start is not None else none).alias("realtime_start"), (end if end is not None else none).alias("realtime_end"), raw.alias("raw_value"), value.alias("value"), value.isNull().alias("is_missing"))
    return out.filter("observation_date is not null")


def _each(df: DataFrame, schema: str, path: Callable[[Column], Column]) -> DataFrame:
    return df.select("series_id", F.explode(path(F.from_json("payload", schema))).alias("o"))


def fred(df: DataFrame, vintages: bool = True) -> DataFrame:
    rows = _each(df, "observations array<struct<date:string,value:string,realtime_start:string,realtime_end:string>>", lambda p: p["observations"])
    span = [F.col(f"o.realtime_{x}").try_cast("date") if vintages else None for x in ("start", "end")]
    return _rows(rows, F.col("o.date").try_cast("date"), F.col("o.value"), *span)


def bls(df: DataFrame) -> DataFrame:
    rows = df.select(F.explode(F.from_json("payload", "Results struct<series:array<struct<seriesID:string,data:array<struct<year:string,period:string,value:string>>>>>")["Results"]["series"]).alias("s"))
    rows = rows.select(F.col("s.seriesID").alias("series_id"), F.explode("s.data").alias("o")).filter("o.period != 'M13'")
    return _rows(rows, period_date(F.concat(F.col("o.year"), F.lit("-"), F.col("o.period"))), F.col("o.value"))


def eia(df: DataFrame) -> DataFrame:
    return _rows(o := _each(df, "response struct<data:array<struct<period:string,value:string>>>", lambda p: p["response"]["data"]), period_date(o["o.period"]), o["o.value"])


def bea(df: DataFrame) -> DataFrame:
    """series_id ends in :line:frequency; the payload holds all lines of the table."""
    rows = _each(df, "BEAAPI struct<Results:struct<Data:array<struct<TimePeriod:string,LineNumber:string,DataValue:string>>>>", lambda p: p["BEAAPI"]["Results"]["Data"])
    rows = rows.filter(F.element_at(F.split("series_id", ":"), -2) == F.col("o.LineNumber"))
    return _rows(rows, period_date(F.col("o.TimePeriod")), F.col("o.DataValue"))


def census(df: DataFrame, value_name: str = "cell_value", time_name: str = "time") -> DataFrame:
    """A table of strings whose first row names the columns."""
    rows = df.select("series_id", F.from_json("payload", "array<array<string>>").alias("t"))
    rows = rows.select("series_id", F.col("t")[0].alias("h"), F.explode(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(1)))).alias("o"))
    return _rows(rows, period_date(F.try_element_at("o", F.array_position("h", time_name).cast("int"))), F.try_element_at("o", F.array_position("h", value_name).cast("int")))


def treasury(df: DataFrame) -> DataFrame:
    """series_id is dataset:field."""
    rows = _each(df, "data array<map<string,string>>", lambda p: p["data"])
    return _rows(rows, F.col("o")["record_date"].try_cast("date"), F.try_element_at("o", F.substring_index("series_id", ":", -1)))


def worldbank(df: DataFrame) -> DataFrame:
    rows = df.select("series_id", F.explode(F.from_json(F.get_json_object("payload", "$[1]"), "array<struct<date:string,value:string>>")).alias("o"))
    return _rows(rows, period_date(F.col("o.date")), F.col("o.value"))


def _csv(df: DataFrame) -> DataFrame:
    """(series_id, h, o): header and fields of each line; quoted fields may hold commas."""
    comma = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    lines = F.filter(F.split(F.regexp_replace("payload", "\r", ""), "\n"), lambda x: F.trim(x) != "")
    rows = df.select("series_id", lines.alias("ls")).filter("size(ls) > 1")
    rows = rows.select("series_id", F.split(F.col("ls")[0], comma).alias("h"), F.explode(F.slice("ls", 2, F.size("ls") - 1)).alias("l"))
    bare = F.transform(F.split("l", comma), lambda x: F.regexp_replace(x, '^"|"$', ""))
    return rows.select("series_id", F.transform("h", lambda x: F.regexp_replace(F.trim(x), '^"|"$', "")).alias("h"), bare.alias("o"))


def _field(name: str) -> Column:
    at = F.array_position("h", name).cast("int")
    return F.when(at > 0, F.try_element_at("o", F.when(at > 0, at).otherwise(1)))


def sdmx_csv(df: DataFrame) -> DataFrame:
    """ECB and BIS: TIME_PERIOD and OBS_VALUE; deleted rows go; VALID_FROM and VALID_TO span a vintage."""
    rows = _csv(df).filter(F.lower(F.coalesce(_field("ACTION"), F.lit(""))) != "delete")
    return _rows(rows, period_date(_field("TIME_PERIOD")), _field("OBS_VALUE"), _field("VALID_FROM").try_cast("date"), _field("VALID_TO").try_cast("date"))


def stooq(df: DataFrame) -> DataFrame:
    """series_id is ticker:field, of Date,Open,High,Low,Close,Volume."""
    rows = _csv(df).withColumn("f", F.initcap(F.substring_index("series_id", ":", -1)))
    return _rows(rows, _field("Date").try_cast("date"), F.try_element_at("o", F.expr("cast(array_position(h, f) as int)")))


PRICE_FIELDS = ("close", "divCash", "splitFactor", "adjClose")


def tiingo(df: DataFrame) -> DataFrame:
    """One payload per ticker (series_id) to a series per field; absent fields give no rows."""
    rows = df.select("series_id", F.explode(F.from_json("payload", "array<struct<date:string," + ",".join(f"{f}:string" for f in PRICE_FIELDS) + ">>")).alias("o"))
    rows = rows.select(F.col("series_id").alias("t"), F.col("o.date").alias("d"), F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"o.{f}").alias("v")) for f in PRICE_FIELDS])).alias("x")).filter("x.v is not null")
    return _rows(rows.withColumn("series_id", F.concat_ws(":", "t", "x.f")), F.substr(F.col("d"), F.lit(1), F.lit(10)).try_cast("date"), F.col("x.v"))


def holdings_csv(df: DataFrame) -> DataFrame:
    """A fund's holdings file: lines before the header (it names Ticker) are skipped, other symbols than shares go, the first of a ticker wins."""
    lines = F.split(F.regexp_replace("payload", "\r", ""), "\n")
    rows = df.select("series_id", "as_of_date", lines.alias("ls"))
    head = F.expr("array_position(transform(ls, x -> x like '%Ticker%' and x like '%Weight%'), true)")
    rows = rows.withColumn("at", head.cast("int")).filter("at > 0")
    rows = _csv(rows.select(F.struct("series_id", "as_of_date").alias("series_id"), F.expr("array_join(slice(ls, at, size(ls)), '\n')").alias("payload")))
    rows = rows.withColumn("ticker", _field("Ticker")).withColumn("raw", F.coalesce(_field("Weight (%)"), _field("Weight"))).withColumn("pos", F.monotonically_increasing_id())
    rows = rows.filter(F.col("ticker").rlike(r"^[A-Z][A-Z.\-]*$"))
    first = rows.groupBy("series_id", "ticker").agg(F.min_by("raw", "pos").alias("raw"))
    out = first.select(F.concat_ws(":", "series_id.series_id", "ticker").alias("series_id"), F.col("series_id.as_of_date").alias("d"), "raw")
    return _rows(out, F.col("d"), F.col("raw"))


def sec_facts(df: DataFrame) -> DataFrame:
    """XBRL concept: instants and quarters (80 to 100 days), dated by filing; a fourth quarter that isn't reported is derived from its year."""
    rows = df.select("series_id", F.explode(F.from_json("payload", "units map<string,array<struct<start:string,end:string,val:double,filed:string>>>")["units"]).alias("unit", "os"))
    rows = rows.select("series_id", "unit", F.explode("os").alias("o")).select("series_id", "unit", F.col("o.start").try_cast("date").alias("s"), F.col("o.end").try_cast("date").alias("e"), F.col("o.val").alias("v"), F.col("o.filed").try_cast("date").alias("filed"))
    rows = rows.withColumn("series_id", F.concat_ws(":", "series_id", "unit"))
    return decumulated(rows)


def decumulated(rows: DataFrame, period: str = "quarterly") -> DataFrame:
    """(series_id, observation_date, realtime_start, value) from (series_id, s, e, v, filed): instants and the facts of one period, quarterly or annual.

    A fourth quarter that is reported stands as it is. Otherwise it is the year
    less the newest nine months filed by then, or, if none was, the newest of all.
    """
    days = F.datediff("e", "s")
    span = days.between(350, 380) if period == "annual" else days.between(80, 100)
    plain = rows.filter(F.col("s").isNull() | span).select("series_id", F.col("e").alias("observation_date"), F.col("filed").alias("realtime_start"), F.col("v").alias("value"))
    if period == "annual":
        return plain
    reported = rows.filter(days.between(80, 100)).select("series_id", F.col("e").alias("y_end")).distinct()
    year = rows.filter(days.between(350, 380)).select("series_id", "s", F.col("e").alias("y_end"), F.col("v").alias("year_v"), F.col("filed").alias("y_filed")).join(reported, ["series_id", "y_end"], "left_anti")
    nine = rows.filter(days.between(260, 290)).select("series_id", "s", F.col("v").alias("nine_v"), F.col("filed").alias("n_filed"))
    newest = F.max_by("nine_v", F.struct((F.col("n_filed") <= F.col("y_filed")).alias("known"), "n_filed", "nine_v"))
    last = year.join(nine, ["series_id", "s"]).groupBy("series_id", "s", "y_end", "year_v", "y_filed").agg(newest.alias("nine_v"))
    fourth = last.select("series_id", F.col("y_end").alias("observation_date"), F.col("y_filed").alias("realtime_start"), (F.col("year_v") - F.col("nine_v")).alias("value"))
    return plain.unionByName(fourth)


#: The parser of each source.
PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fred": fred, "bls": bls, "eia": eia, "ecb": sdmx_csv, "bis": sdmx_csv, "bea": bea, "census": census, "treasury": treasury, "worldbank": worldbank, "stooq": stooq, "tiingo": tiingo, "ishares": holdings_csv, "sec": sec_facts,
}


def coalesced_vintages(silver: DataFrame) -> DataFrame:
    """Adjacent vintages of one date with the same value as one, from the first's start to the last's end."""
    order = Window.partitionBy("series_id", "observation_date").orderBy("realtime_start")
    new = F.coalesce(~F.col("value").eqNullSafe(F.lag("value").over(order)) | F.lag("realtime_start").over(order).isNull(), F.lit(True))
    rows = silver.withColumn("new", new.cast("int")).withColumn("grp", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.max_by("realtime_end", "realtime_start")
    return rows.groupBy("series_id", "observation_date", "grp").agg(F.min("realtime_start").alias("realtime_start"), last.alias("realtime_end"), F.first("value").alias("value")).drop("grp")


def upserted(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target with source's rows in place of those with the same keys (null equals null), as one aggregate; of several source rows with one key the largest counts."""
    cols = [c for c in target.columns if c not in keys]
    both = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1)))
    return both.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct("_new", *cols)).alias("r")).select(*keys, "r.*")
