"""Where tables live: Parquet below one root, read and written by name."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.sources.payloads import PARSERS, upserted

SILVER_KEY = ["source", "series_id", "observation_date", "realtime_start"]


class Warehouse:
    """Bronze is appended, Silver upserted, Gold overwritten. An upsert writes a new version beside the old one and then switches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, table: str) -> bool:
        return self._fs().exists(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table)))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path(table))

    def overwrite(self, table: str, rows: DataFrame) -> None:
        """Written beside the table first, so that rows may read it."""
        jpath, fs = self.spark._jvm.org.apache.hadoop.fs.Path, self._fs()
        new = self.path(table) + "__new"
        rows.write.mode("overwrite").parquet(new)
        fs.delete(jpath(self.path(table)), True)
        fs.rename(jpath(new), jpath(self.path(table)))

    def upsert(self, table: str, rows: DataFrame, keys: list[str]) -> None:
        self.overwrite(table, upserted(self.read(table), rows, keys) if self.exists(table) else rows)

    def query(self, sql: str, caller: str = "") -> DataFrame:
        """Runs SQL over the session's views and logs who asked what (as a hash)."""
        log = [(hashlib.sha256(sql.encode()).hexdigest(), caller)]
        self.append("audit.query_log", self.spark.createDataFrame(log, "query_hash string, caller string").withColumn("queried_at", F.current_timestamp()))
        return self.spark.sql(sql)

    def export_csv(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").option("header", True).csv(path)


def normalise(bronze: DataFrame) -> DataFrame:
    """Silver rows of all payloads (source, series_id, payload, …), each source by its parser."""
    if "as_of_date" not in bronze.columns:  # only holdings files have it
        bronze = bronze.withColumn("as_of_date", F.lit(None).cast("date"))
    out = None
    for source, parse in PARSERS.items():
        rows = parse(bronze.filter(F.col("source") == source))
        for name, kind in (("realtime_start", "date"), ("realtime_end", "date"), ("raw_value", "string"), ("is_missing", "boolean")):
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(None).cast(kind) if name != "is_missing" else F.col("value").isNull())
        rows = rows.select(F.lit(source).alias("source"), "series_id", "observation_date", "realtime_start", "realtime_end", "raw_value", "value", "is_missing")
        out = rows if out is None else out.unionByName(rows)
    return out


def replay(warehouse: Warehouse) -> None:
    """Silver again from all of Bronze."""
    rows = normalise(warehouse.read("bronze.payloads")).dropDuplicates(SILVER_KEY)
    warehouse.upsert("silver.observations", rows, SILVER_KEY)
