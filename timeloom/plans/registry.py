"""Every registered query, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.plans import adapters

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLE_SQL: dict[str, str] = {}
SPECS: dict[str, str] = {}

#: Letter of a column in a spec: (Spark expression, SQL expression). Doubles are rounded, since sums differ in their last digits.
_AS = {
    "s": ("cast({c} as string)", "CAST({c} AS VARCHAR)"),
    "d": ("cast(cast({c} as date) as string)", "CAST(CAST({c} AS DATE) AS VARCHAR)"),
    "f": ("round(cast({c} as double), 6) + 0.0D", "round(CAST({c} AS DOUBLE), 6) + CAST(0.0 AS DOUBLE)"),
    "p": ("round(cast({c} as double), 10) + 0.0D", "round(CAST({c} AS DOUBLE), 10) + CAST(0.0 AS DOUBLE)"),
    "q": ("round(cast({c} as double), 8) + 0.0D", "round(CAST({c} AS DOUBLE), 8) + CAST(0.0 AS DOUBLE)"),
    "i": ("cast({c} as bigint)", "CAST({c} AS BIGINT)"),
    "b": ("cast({c} as boolean)", "CAST({c} AS BOOLEAN)"),
}


def _columns(spec: str, dialect: int) -> list[str]:
    pairs = [part.split() for part in spec.split(",")]
    return [f"{_AS[kind][dialect].format(c=name)} AS {name}" for name, kind in pairs]


def register(name: str, spec: str, build: Build, sql: str | None = None, uses: str = "") -> None:
    """spec: 'column letter, …', the result's columns; uses: adapters that the SQL names."""
    SPECS[name] = spec
    QUERIES[name] = lambda spark, sf_dir: build(spark, sf_dir).select(*[F.expr(c) for c in _columns(spec, 0)])
    if sql is not None:
        ctes = ",\n".join(adapters.SQL[u] for u in uses.split())
        ORACLE_SQL[name] = f"WITH RECURSIVE {ctes}\n" * bool(ctes) + f"SELECT {', '.join(_columns(spec, 1))} FROM ({sql}) AS body"


def config(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A configuration table: its rows stand in the code."""
    return spark.createDataFrame(rows, schema)


def values(rows: list[tuple], name: str, columns: str) -> str:
    """The same as a SQL table expression."""

    def lit(x: object) -> str:
        return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)

    return f"(VALUES {', '.join('(' + ', '.join(lit(x) for x in r) + ')' for r in rows)}) AS {name}({columns})"


from timeloom.plans import core, events_q, ingest_q, lab_q, markets_q  # noqa: E402, F401  each module registers its queries
