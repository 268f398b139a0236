"""Observation-shaped DataFrames from the test tables, and the same as SQL.

Sums run over decimals, so they don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series per market segment: order value by month."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy(F.concat(F.lit("SEG:"), "c_mktsegment").alias("series_id"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("observation_date")).agg(F.sum(_exact("o_totalprice")).cast("double").alias("value"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series per order priority: order value by day."""
    rows = table(spark, sf_dir, "orders")
    return rows.groupBy(F.concat(F.lit("PRI:"), "o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("date").alias("observation_date")).agg(F.sum(_exact("o_totalprice")).cast("double").alias("value"))


TENORS = {1: 1, 2: 3, 3: 24, 4: 60, 5: 84, 6: 120, 7: 360}


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A yield curve: mean discount in percent by day and line number, which stands for a tenor."""
    rows = table(spark, sf_dir, "lineitem").filter("l_linenumber between 1 and 7")
    months = F.create_map(*[F.lit(x) for pair in TENORS.items() for x in pair])
    out = rows.groupBy(F.col("l_shipdate").cast("date").alias("observation_date"), "l_linenumber").agg((F.sum(_exact("l_discount")).cast("double") / F.count("*") * 100).alias("value"))
    return out.select(F.concat(F.lit("T"), F.col("l_linenumber").cast("string")).alias("series_id"), "observation_date", "value", months[F.col("l_linenumber")].alias("months"))


def vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order months that become known shipment month by shipment month, as cumulative value."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).filter("l_shipdate >= o_orderdate")
    rows = rows.groupBy(
        F.concat(F.lit("PRI:"), "o_orderpriority").alias("series_id"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("observation_date"), F.trunc(F.col("l_shipdate").cast("date"), "month").alias("realtime_start"),
    ).agg(F.sum(_exact("l_extendedprice")).alias("v"))
    w = Window.partitionBy("series_id", "observation_date").orderBy("realtime_start")
    return rows.select("series_id", "observation_date", "realtime_start", F.lead("realtime_start").over(w).alias("realtime_end"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("double").alias("value"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A close per supplier and day: mean price per unit."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"), F.col("l_shipdate").cast("date").alias("observation_date")).agg((F.sum(_exact("l_extendedprice")).cast("double") / F.sum(_exact("l_quantity")).cast("double")).alias("close"), F.sum(_exact("l_tax")).cast("double").alias("dividend"))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of suppliers in nations, by ship year."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.col("n_name").alias("etf"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("constituent"), F.trunc(F.col("l_shipdate").cast("date"), "year").alias("observation_date")).agg(F.sum(_exact("l_extendedprice")).cast("double").alias("weight"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings: a company per customer, a tag per order status, a fact per quarter, filed on the order date."""
    rows = table(spark, sf_dir, "orders")
    return rows.select(F.col("o_custkey").cast("string").alias("cik"), F.concat(F.lit("TAG_"), "o_orderstatus").alias("tag"), F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("observation_date"), F.col("o_orderdate").cast("date").alias("realtime_start"), F.col("o_totalprice").alias("value"))


#: Each adapter as a common table expression.
SQL = {
    "monthly": "monthly AS (SELECT 'SEG:' || c_mktsegment AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)",
    "daily": "daily AS (SELECT 'PRI:' || o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS observation_date, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2)",
    "curve": "curve AS (SELECT 'T' || l_linenumber AS series_id, CAST(l_shipdate AS DATE) AS observation_date, CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 100 AS value, "
    + "CASE l_linenumber " + " ".join(f"WHEN {a} THEN {b}" for a, b in TENORS.items()) + " END AS months FROM lineitem WHERE l_linenumber BETWEEN 1 AND 7 GROUP BY l_linenumber, 2)",
    "vintages": """vintage_sums AS (SELECT 'PRI:' || o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date, CAST(date_trunc('month', l_shipdate) AS DATE) AS realtime_start, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_shipdate >= o_orderdate GROUP BY 1, 2, 3),
vintages AS (SELECT series_id, observation_date, realtime_start, lead(realtime_start) OVER w AS realtime_end, CAST(sum(v) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value FROM vintage_sums WINDOW w AS (PARTITION BY series_id, observation_date ORDER BY realtime_start))""",
    "prices": "prices AS (SELECT 'S' || l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS observation_date, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS close, CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS dividend FROM lineitem GROUP BY 1, 2)",
    "holdings": "holdings AS (SELECT n_name AS etf, 'S' || s_suppkey AS constituent, CAST(date_trunc('year', l_shipdate) AS DATE) AS observation_date, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS weight FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3)",
    "facts": "facts AS (SELECT CAST(o_custkey AS VARCHAR) AS cik, 'TAG_' || o_orderstatus AS tag, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS observation_date, CAST(o_orderdate AS DATE) AS realtime_start, o_totalprice AS value FROM orders)",
}
