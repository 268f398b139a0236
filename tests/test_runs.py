"""Runs over a warehouse: replay, Gold, streams."""

from __future__ import annotations

import json

from timeloom.plans import gold
from timeloom.sources import store
from timeloom.streaming import events


def bronze(spark):
    rows = [("fred", "A", json.dumps({"observations": [{"date": f"2020-{m:02d}-01", "value": str(m)} for m in range(1, 13)]})), ("tiingo", "T", json.dumps([{"date": f"2020-01-{d:02d}", "close": 10 + d} for d in range(1, 6)]))]
    return spark.createDataFrame(rows, events.BRONZE)


def test_replay_then_gold(spark, tmp_path):
    house = store.Warehouse(spark, str(tmp_path))
    house.append("bronze.payloads", bronze(spark))
    store.replay(house)
    run = gold.build_gold(spark, house)
    assert run.verdict == "ok", run.failed
    assert house.read("gold.feature_transforms").filter("series_id = 'A'").count() == 12
    assert house.read("gold.equity_return_daily").count() == 5


def test_a_circle_is_refused():
    import pytest

    with pytest.raises(ValueError):
        gold.waves({"a": (("b",), None), "b": (("a",), None)})


def test_failed_input_fails_what_needs_it(spark, tmp_path):
    run = gold.build_gold(spark, store.Warehouse(spark, str(tmp_path)))
    assert run.verdict == "failed" and set(run.failed) == set(gold.GOLD)


def test_stream_upserts_files(spark, tmp_path):
    house = store.Warehouse(spark, str(tmp_path / "house"))
    for _ in range(2):  # the same payloads twice
        bronze(spark).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        events.bronze_to_silver(spark, str(tmp_path / "in"), house, str(tmp_path / "check")).awaitTermination()
    assert house.read("silver.observations").count() == 17


def test_sessions_end_at_exactly_the_gap(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:30:00", 2.0), (1, "2024-01-01 00:59:59.999999", 4.0), (2, "2024-01-01 00:10:00", 8.0), (2, "2024-01-01 00:10:00", 16.0)]
    rows = spark.createDataFrame(rows, "user_id long, ts string, value double").selectExpr("user_id", "cast(ts as timestamp) as ts", "value")
    texts = ["user_id", "cast(session_start as string)", "cast(session_end as string)", "n", "total"]
    expected = [(1, "2024-01-01 00:00:00", "2024-01-01 00:30:00", 1, 1.0), (1, "2024-01-01 00:30:00", "2024-01-01 01:29:59.999999", 2, 6.0), (2, "2024-01-01 00:10:00", "2024-01-01 00:40:00", 2, 24.0)]
    assert sorted(map(tuple, events.user_sessions(rows).selectExpr(*texts).collect())) == expected

    rows.write.parquet(str(tmp_path / "in"))
    stream = events.user_sessions(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))).selectExpr(*texts)
    stream.writeStream.format("memory").queryName("sessions").outputMode("complete").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table("sessions").collect())) == expected
