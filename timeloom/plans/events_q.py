"""Event window queries."""

from __future__ import annotations

from timeloom.plans import adapters as a
from timeloom.plans.registry import register
from timeloom.streaming import events

register("event_windows", "window_start s, event_type s, n i, total f", lambda s, d: events.event_windows(a.table(s, d, "events")), "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2")
register(
    "user_sessions", "user_id i, session_start s, n i, total f", lambda s, d: events.user_sessions(a.table(s, d, "events").withColumn("ts", _seconds("ts"))),
    "SELECT user_id, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n, sum(value) AS total FROM (SELECT *, sum(CASE WHEN prev IS NULL OR t >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM (SELECT *, lag(t) OVER (PARTITION BY user_id ORDER BY t) AS prev FROM (SELECT *, date_trunc('second', ts) AS t FROM events))) AS g GROUP BY user_id, grp",
)


def _seconds(name: str):
    from pyspark.sql import functions as F

    return F.date_trunc("second", F.col(name))
