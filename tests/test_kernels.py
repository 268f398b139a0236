"""Kernels and models on small inputs with known answers."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.functions import special
from timeloom.operators import bitemporal, calendars, features, lab, markets, models
from timeloom.operators import kernels as k
from timeloom.sources import live, payloads, store

D = dt.date


def series(spark, rows):
    return spark.createDataFrame([(s, D.fromisoformat(d), v) for s, d, v in rows], "series_id string, observation_date date, value double")


def test_parse_value(spark):
    rows = spark.createDataFrame([(x,) for x in ("1,234.5", ".", "", " 7 ", "abc", None, "-0.5")], "r string")
    assert [r[0] for r in rows.select(k.parse_value(F.col("r"))).collect()] == [1234.5, None, None, 7.0, None, None, -0.5]


def test_transforms_edges(spark):
    obs = series(spark, [("A", "2020-01-01", 0.0), ("A", "2020-02-01", 5.0), ("A", "2021-03-20", 10.0), ("B", "2020-01-01", 3.0), ("B", "2020-02-01", 3.0), ("C", "2020-01-01", None)])
    rows = {(r.series_id, str(r.observation_date)): r for r in features.feature_transforms(obs).collect()}
    assert rows["A", "2020-02-01"].mom is None and rows["A", "2020-02-01"]["diff"] == 5.0  # zero base
    assert rows["A", "2021-03-20"].yoy is None  # 413 days before: too old
    assert rows["B", "2020-02-01"].zscore is None  # constant
    assert ("C", "2020-01-01") not in rows


def test_daily_matrix_fills_gaps(spark):
    obs = series(spark, [("A", "2020-01-01", 1.0), ("A", "2020-01-03", 2.0), ("B", "2020-01-02", 9.0), ("B", "2020-01-05", 8.0)])
    rows = {(r.series_id, r.observation_date.day): (r.value, r.filled) for r in features.daily_matrix(obs).collect()}
    assert rows["A", 2] == (None, 1.0) and rows["A", 5] == (None, 2.0) and ("B", 1) not in rows and len(rows) == 9


def test_snapshot_keeps_rows_without_start(spark):
    rows = [("A", D(2020, 1, 1), None, None, 1.0), ("A", D(2020, 2, 1), D(2020, 3, 1), D(2020, 4, 1), 2.0), ("A", D(2020, 2, 1), D(2020, 4, 1), D(9999, 12, 31), 3.0)]
    silver = spark.createDataFrame(rows, "series_id string, observation_date date, realtime_start date, realtime_end date, value double")
    assert bitemporal.snapshot(silver, "2020-02-15").collect()[0].value == 1.0
    assert bitemporal.snapshot(silver, "2020-03-15").collect()[0].value == 2.0
    assert bitemporal.snapshot(silver, "2020-04-01").collect()[0].value == 3.0  # the end is exclusive


def test_as_of_with_staleness(spark):
    left = spark.createDataFrame([("x", D(2020, 1, 5)), ("x", D(2020, 6, 1)), ("x", D(2019, 1, 1))], "key string, d date")
    right = spark.createDataFrame([("x", D(2020, 1, 1), 4.0)], "key string, d date, v double")
    assert {str(r.d): r.v for r in k.as_of(left, right, ["key"], "d", "v", 30).collect()} == {"2020-01-05": 4.0, "2020-06-01": None, "2019-01-01": None}


def test_expanding_rank(spark):
    obs = series(spark, [("A", f"2020-01-0{i + 1}", v) for i, v in enumerate([2.0, 1.0, 2.0, 3.0])])
    rows = k.with_expanding_rank(obs, "value", ["series_id"], "below", "at_most").orderBy("observation_date").collect()
    assert [(r.below, r.at_most, r.seen) for r in rows] == [(0, 1, 1), (0, 1, 2), (1, 3, 3), (3, 4, 4)]


@pytest.mark.parametrize("year, month, day", [(1961, 4, 2), (2000, 4, 23), (2019, 4, 21), (2024, 3, 31), (2025, 4, 20), (2038, 4, 25)])
def test_easter(spark, year, month, day):
    assert spark.range(1).select(calendars.easter(F.lit(year))).collect()[0][0] == D(year, month, day)


def test_unknown_recession_is_null(spark):
    dates = spark.createDataFrame([(D(2020, 1, 15),), (D(2020, 8, 1),), (D(2019, 1, 1),)], "observation_date date")
    flags = spark.createDataFrame([(D(2020, 1, 1), True), (D(2020, 2, 1), False)], "observation_date date, flag boolean")
    assert {str(r[0]): r[1] for r in markets.recession_flags(dates, flags).collect()} == {"2020-01-15": True, "2020-08-01": None, "2019-01-01": None}


def test_survival_functions():
    assert special.f_survival(4.0, 2, 10) == pytest.approx(0.0529221494, abs=1e-9)
    assert special.chi2_survival(18.307038, 10) == pytest.approx(0.05, abs=1e-7)
    assert special.f_survival(0, 3, 3) == 1 and special.chi2_survival(0, 3) == 1


def test_granger_finds_the_leader(spark):
    rng = np.random.default_rng(1)
    a = rng.standard_normal(200)
    b = np.concatenate(([0.0], 0.9 * a[:-1])) + 0.1 * rng.standard_normal(200)
    rows = [("p", D(2000, 1, 1) + dt.timedelta(days=i), float(a[i]), float(b[i])) for i in range(200)]
    both = spark.createDataFrame(rows, "pair string, observation_date date, a double, b double")
    p = {r.direction: r.p for r in lab.granger(both).collect()}
    assert p["a_to_b"] < 1e-6 < p["b_to_a"]
    best = lab.lead_lag(both).filter("is_best").collect()[0]
    assert best.lag == 1 and best.correlation > 0.9


def test_nelson_siegel_recovers_factors(spark):
    months = [3, 12, 24, 60, 120, 360]
    t = np.array(months) / 12 / 1.7
    g = (1 - np.exp(-t)) / t
    y = 4 - 2 * g + 1 * (g - np.exp(-t))
    rows = [(D(2020, 1, 1), m, float(v)) for m, v in zip(months, y)] + [(D(2020, 1, 2), 3, 1.0)]
    out = models.nelson_siegel(spark.createDataFrame(rows, "as_of_date date, tenor_months int, yield_pct double")).collect()
    assert len(out) == 1 and out[0].level == pytest.approx(4, abs=1e-6) and out[0].rmse < 1e-9


def test_pca_loadings_are_unit_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(f, D(2000 + i // 12, i % 12 + 1, 1), float(rng.standard_normal())) for i in range(48) for f in "abc"]
    out = models.pca_factors(spark.createDataFrame(rows, "feature_name string, month date, value double")).toPandas()
    norm = out[out.kind == "loading"].groupby(["month", "factor"])["value"].apply(lambda v: float((v**2).sum()))
    share = out[out.kind == "share"].groupby("month")["value"].sum()
    assert np.allclose(norm, 1) and (share <= 1 + 1e-9).all()


def test_pca_equals_a_plain_version(spark):
    """The covariance of raw features, month by month; a gap counts as the mean so far, a thin month is left out, only the month's last date counts."""
    rng, rows, months = np.random.default_rng(5), [], []
    for i in range(45):
        last, month = D(2000 + i // 12, i % 12 + 1, 20), []
        for j, f in enumerate("abcd"):
            rows.append((D(2000 + i // 12, i % 12 + 1, 5), f, 1e6))  # not the month's last date
            v = float(rng.standard_normal() * 10**j)
            gone = (i % 9 == 4 and f in "bcd") or (i % 5 == 2 and f == "c")
            month.append(None if gone else v)
            if not gone:
                rows.append((last, f, v))
        months.append((last.replace(day=1), month))
    got = models.pca_factors(models.month_ends(spark.createDataFrame(rows, "observation_date date, feature_name string, value double"))).toPandas()
    score = {(m.year, m.month, f): v for m, kind, f, _, v in got.itertuples(index=False) if kind == "score"}
    past, seen = [], 0
    for day, month in months:
        if sum(v is not None for v in month) < 2:
            assert (day.year, day.month, 1) not in score
            continue
        past.append([(sum(p[j] for p in past) / len(past) if past else 0.0) if v is None else v for j, v in enumerate(month)])
        if len(past) < 30:
            continue
        values, vectors = np.linalg.eig(np.cov(np.array(past), rowvar=False))
        for f, at in enumerate(np.argsort(-values)):
            v = vectors[:, at] * np.sign(vectors[np.argmax(np.abs(vectors[:, at])), at])
            want = sum((x - sum(p[j] for p in past) / len(past)) * v[j] for j, x in enumerate(past[-1]))
            assert score[day.year, day.month, f + 1] == pytest.approx(want, rel=1e-6, abs=1e-6)
            seen += 1
    assert seen > 30


def test_meeting_ladder_sums_to_one():
    rows = models.meeting_path([(1, 4.3), (90, 4.1), (365, 3.6)], [20, 62])
    for day in (20, 62):
        assert sum(r[4] for r in rows if r[0] == day) == pytest.approx(1)


def test_factor_attribution_recovers_betas(spark):
    rng = np.random.default_rng(3)
    f = rng.standard_normal((40, 2))
    months = [D(2000 + i // 12, i % 12 + 1, 1) for i in range(40)]
    returns = spark.createDataFrame([("T", m, float(0.1 + 2 * x - y)) for m, (x, y) in zip(months, f)], "ticker string, month date, ret double")
    factors = spark.createDataFrame([(m, float(x), float(y)) for m, (x, y) in zip(months, f)], "month date, f1 double, f2 double")
    out = models.factor_attribution(returns, factors, ["f1", "f2"], (12,)).toPandas()
    assert np.allclose(out[out.factor == "f1"].beta, 2) and np.allclose(out[out.factor == "alpha"].beta, 0.1)


@pytest.mark.parametrize("text, day", [("2020", "2020-01-01"), ("2020-03", "2020-03-01"), ("202003", "2020-03-01"), ("2020-Q2", "2020-04-01"), ("2020Q4", "2020-10-01"), ("2020M05", "2020-05-01"), ("2020-S2", "2020-07-01"), ("2020-W53", "2020-12-28"), ("2020-01-07", "2020-01-07"), ("20200107", "2020-01-07"), ("2020-M13", None), ("2020-13", None), ("soon", None), ("", None)])
def test_period_date(spark, text, day):
    found = spark.createDataFrame([(text,)], "p string").select(payloads.period_date(F.col("p"))).collect()[0][0]
    assert (str(found) if found else None) == day


def test_parsers(spark):
    def parsed(parse, series_id, payload, extra=()):
        rows = spark.createDataFrame([(series_id, payload, *extra)], "series_id string, payload string" + ", as_of_date date" * len(extra))
        return sorted((r.series_id, str(r.observation_date), r.value) for r in parse(rows).collect())

    assert ("c", "2020-02-01", 5.0) in parsed(payloads.census, "c", '[["cell_value","time"],["5","2020-02"]]')
    assert parsed(payloads.treasury, "debt:total", '{"data":[{"record_date":"2020-01-31","total":"12.5"}]}') == [("debt:total", "2020-01-31", 12.5)]
    assert parsed(payloads.worldbank, "w", '[{"page":1},[{"date":"2019","value":1.5},{"date":"2020Q2","value":"2"}]]') == [("w", "2019-01-01", 1.5), ("w", "2020-04-01", 2.0)]
    assert parsed(payloads.eia, "e", '{"response":{"data":[{"period":"2020-05","value":3}]}}') == [("e", "2020-05-01", 3.0)]
    bea = '{"BEAAPI":{"Results":{"Data":[{"TimePeriod":"2020Q1","LineNumber":"7","DataValue":"1,000"},{"TimePeriod":"2020Q1","LineNumber":"8","DataValue":"2"}]}}}'
    assert parsed(payloads.bea, "NIPA:T1:7:Q", bea) == [("NIPA:T1:7:Q", "2020-01-01", 1000.0)]
    held = 'Fund\n\nTicker,Name,Weight (%)\nAAA,"A, Inc",5.5\n-,Cash,1\nAAA,again,9\nB.B,B,2\n'
    assert parsed(payloads.holdings_csv, "ETF", held, (D(2020, 1, 1),)) == [("ETF:AAA", "2020-01-01", 5.5), ("ETF:B.B", "2020-01-01", 2.0)]


def test_fourth_quarter_uses_what_was_known(spark):
    rows = [("c", D(2020, 1, 1), D(2020, 9, 30), 30.0, D(2020, 11, 1)), ("c", D(2020, 1, 1), D(2020, 9, 30), 33.0, D(2021, 6, 1)), ("c", D(2020, 1, 1), D(2020, 12, 31), 50.0, D(2021, 2, 1)), ("c", None, D(2020, 12, 31), 7.0, D(2021, 2, 1))]
    out = payloads.decumulated(spark.createDataFrame(rows, "series_id string, s date, e date, v double, filed date")).collect()
    assert sorted(r.value for r in out) == [7.0, 20.0]


def test_fourth_quarter_reported_or_known_late(spark):
    """A reported quarter stands alone; nine months filed after the year count where nothing else does; years by themselves."""
    rows = [("r", D(2020, 1, 1), D(2020, 9, 30), 30.0, D(2020, 11, 1)), ("r", D(2020, 1, 1), D(2020, 12, 31), 60.0, D(2021, 2, 1)), ("r", D(2020, 10, 1), D(2020, 12, 31), 31.0, D(2021, 2, 1)), ("l", D(2020, 1, 1), D(2020, 9, 30), 40.0, D(2021, 6, 1)), ("l", D(2020, 1, 1), D(2020, 12, 31), 50.0, D(2021, 2, 1))]
    facts = spark.createDataFrame(rows, "series_id string, s date, e date, v double, filed date")
    assert sorted((r.series_id, r.value) for r in payloads.decumulated(facts).collect()) == [("l", 10.0), ("r", 31.0)]
    assert sorted((r.series_id, r.value) for r in payloads.decumulated(facts, "annual").collect()) == [("l", 50.0), ("r", 60.0)]


def test_upsert_of_repeated_keys_is_stable(spark):
    old, new = (spark.createDataFrame(r, "k string, v double") for r in ([("a", 9.0), ("b", 1.0)], [("a", 2.0), ("a", 3.0)]))
    assert sorted(map(tuple, payloads.upserted(old, new, ["k"]).collect())) == [("a", 3.0), ("b", 1.0)]


def test_flat_factors_are_no_degrees_of_freedom(spark):
    rows = [(D(2020, 1, 1) + dt.timedelta(i), f, float(i % 7) if f == "x" else 4.0) for i in range(30) for f in "xy"]
    out = models.anomaly_distance(spark.createDataFrame(rows, "observation_date date, factor string, score double")).collect()
    assert len(out) == 11 and {r.k for r in out} == {1}


def test_warehouse_upsert_is_idempotent(spark, tmp_path):
    house = store.Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([("fred", "A", '{"observations":[{"date":"2020-01-01","value":"1"},{"date":"2020-02-01","value":"."}]}')], "source string, series_id string, payload string")
    house.append("bronze.payloads", rows)
    for _ in range(2):
        store.replay(house)
        assert sorted((r.value, r.is_missing) for r in house.read("silver.observations").collect() if r.value is not None) == [(1.0, False)]
        assert house.read("silver.observations").count() == 2


def test_fetch_waits_as_asked():
    import io
    import urllib.error

    calls, waits = [], []

    def opener(url, timeout):
        calls.append(url)
        if len(calls) == 1:
            raise urllib.error.HTTPError(url, 429, "slow down", {"Retry-After": "7"}, None)
        return io.BytesIO(b"ok")

    assert live.fetch("http://x", opener=opener, sleep=waits.append) == "ok" and 7.0 in waits


def test_inversion_episode_bounds(spark):
    days = ["2020-01-01", "2020-01-02", "2020-01-03", "2020-01-06", "2020-01-07"]
    rows = spark.createDataFrame([("s", D.fromisoformat(d), v) for d, v in zip(days, [1.0, -1.0, -2.0, 0.5, -0.1])], "name string, observation_date date, value double")
    out = markets.inversion_episodes(rows).orderBy("episode").collect()
    assert [(str(r.start_date), str(r.end_date), r.n_obs, r.calendar_days, r.is_ongoing) for r in out] == [("2020-01-02", "2020-01-06", 2, 4, False), ("2020-01-07", "None", 1, 0, True)]
    assert math.isclose(out[0].trough_value, -2.0)


def test_calendar_page():
    from timeloom.sources import calendar_page as page

    html = "<style>x</style><h4>2031 FOMC Meetings</h4><div><b>January</b></div><div>28-29</div><b>Apr/May</b><p>30-1*</p><b>Note</b><p>5</p><h4>2032 Meetings</h4><b>March</b> <i>16 - 17*</i>"
    found = page.meetings(html)
    assert found == [(D(2031, 1, 29), False), (D(2031, 5, 1), True), (D(2032, 3, 17), True)]
    assert page.changes([D(2031, 1, 29)], [d for d, _ in found])["added"] == [D(2031, 5, 1), D(2032, 3, 17)]


def test_pair_forecasts_follow_both_series(spark):
    rng, start = np.random.default_rng(1), D(2000, 1, 1)
    y = np.zeros((120, 2))
    for t in range(1, len(y)):
        y[t] = [1 + 0.5 * y[t - 1, 0] - 0.8 * y[t - 1, 1], 0.6 * y[t - 1, 0] + 0.1 * y[t - 1, 1]] + rng.normal(0, 0.01, 2)
    rows = [(name, start + dt.timedelta(days=t), float(y[t, j])) for t in range(len(y)) for j, name in enumerate("ab")]
    changes = spark.createDataFrame(rows, "series_id string, observation_date date, mom double")
    found = {(r.series_id, r.horizon): r for r in models.pair_forecasts(changes, spark.createDataFrame([("a", "b"), ("a", "none")], "first string, second string")).collect()}
    assert len(found) == 8
    at = y[-1]
    for h in range(1, 13):
        at = np.array([1 + 0.5 * at[0] - 0.8 * at[1], 0.6 * at[0] + 0.1 * at[1]])
        for j, name in enumerate("ab"):
            if (name, h) in found:
                r = found[name, h]
                assert abs(r["mean"] - at[j]) < 0.05 and r.p10 < r["mean"] < r.p90 and r.ar_order <= 4


@pytest.mark.parametrize("kind", ["count", "no count", "pages", "one"])
def test_live_reads_every_page(monkeypatch, kind):
    import json
    import re

    rows = [{"record_date": f"2020-01-{d:02d}"} for d in range(1, 8)]

    def answer(url, pause):
        if kind == "one":
            return "plain text"
        at = int(re.search(r"at=(\d+)", url)[1])
        start = 3 * (at - 1) if kind == "pages" else at
        more = {"count": {"count": 7}, "pages": {"meta": {"total-pages": 3}}}.get(kind, {})
        return json.dumps({"data": rows[start : start + 3], **more})

    calls = []
    monkeypatch.setattr(live, "fetch", lambda url, pause: calls.append(url) or answer(url, pause))
    url = {"one": "http://x/{series}", "pages": "http://x/{series}?at={page}"}.get(kind, "http://x/{series}?at={offset}")
    reader = live.SeriesReader({"source": "s", "url": url, "series": "A"})
    out = list(reader.read(reader.partitions()[0]))
    if kind == "one":
        assert out == [("s", "A", "plain text")]
    else:
        assert [x for _, _, body in out for x in json.loads(body)["data"]] == rows
        assert len(calls) == 3 + (kind == "no count")


def test_live_ends_where_pages_repeat(monkeypatch):
    monkeypatch.setattr(live, "fetch", lambda url, pause: '{"data": [1]}')
    assert list(live.pages("http://x?at={offset}", "A", "data")) == ['{"data": [1]}']
