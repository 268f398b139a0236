"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest

from helpers import SF, rows_of
from timeloom.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    ours = registry.QUERIES[name](spark, SF).toPandas()
    theirs = duck.execute(registry.ORACLE_SQL[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    rows = registry.QUERIES[name](spark, SF).toPandas()
    assert list(rows.columns) == [part.split()[0] for part in registry.SPECS[name].split(",")]


def test_forecasts_of_both_models(spark):
    rows = registry.QUERIES["inflation_forecast"](spark, SF).groupBy("model").count().collect()
    assert {r.model: r["count"] for r in rows} == {"ar": 20, "var": 16}


def test_meeting_paths_follow_each_days_curve(spark):
    rows = registry.QUERIES["fomc_path"](spark, SF).collect()
    curves = {}
    for r in registry.QUERIES["treasury_curve"](spark, SF).collect():
        curves.setdefault(r.as_of_date, []).append((r.tenor_months, r.yield_pct))
    days = [day for day, points in curves.items() if len(points) > 1]
    assert days and len(rows) == 4 * 7 * len(days) and {r.as_of_date for r in rows} == set(days)

    def zero(points, day):
        points = sorted((m * 30.4375, y) for m, y in points)
        if day <= points[0][0] or day >= points[-1][0]:
            return points[0][1] if day <= points[0][0] else points[-1][1]
        (m, y), (n, z) = next((p, q) for p, q in zip(points, points[1:]) if p[0] <= day <= q[0])
        return y + (z - y) * (day - m) / (n - m)

    for r in rows:
        if r.day == 62:
            points = curves[r.as_of_date]
            assert abs(r.before - (zero(points, 62) * 62 - zero(points, 20) * 20) / 42) < 1e-4
            assert abs(r.after - (zero(points, 104) * 104 - zero(points, 62) * 62) / 42) < 1e-4


def test_entry_reads_every_query():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
