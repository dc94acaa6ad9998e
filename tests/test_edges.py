"""Prices that are 0 or no number, quiet keys, how often plans compute their events, and what the engine does at its edges."""

import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from seiche.functions.indicators import create_registry
from seiche.functions.quality import check
from seiche.operators import converge, state
from seiche.operators.engine import DAY, Engine, reconcile_months
from seiche.operators.kernel import Detector, Ticks, detect
from seiche.operators.segment import end_state, segment
from seiche.plans import analysis
from seiche.sources import silver

SCHEMA = "ticker string, seq bigint, time bigint, price double, quantity double, direction tinyint"
START = 20_000


def T(p, t=None):
    p = np.array(p, float)
    return Ticks(p, np.array(t if t is not None else range(len(p)), np.int64), np.ones(len(p)), np.ones(len(p), np.int8))


def frame(spark, prices, ticker="A", step=3_600_000_000_000):
    return spark.createDataFrame([(ticker, i, START * DAY + i * step, float(p), 1.0, 1) for i, p in enumerate(prices)], SCHEMA)


def kinds(events):
    return [(e.kind, e.reference_price, e.confirm_price, e.extreme_price, e.change.price.tolist(), e.overshoot.price.tolist()) for e in events]


NAN = float("nan")


@pytest.mark.parametrize("p", [[100, 101, NAN, 103, 99, 97, 104, 99], [NAN, 100, 103, NAN, NAN, 99, 104], [NAN], [NAN, NAN, 5], [0, 5, 0, 0, 7, NAN, 0, 1]])
def test_no_number_is_no_tick_in_any_blocks(spark, p):
    clean = [x for x in p if x == x]
    want = kinds(detect(T(clean, [i for i, x in enumerate(p) if x == x]), 0.02)[0])
    for size in (1, 2, 3, len(p)):
        d = Detector(0.02)
        got = [e for a in range(0, len(p), size) for e in d.feed(T(p[a : a + size], range(a, min(a + size, len(p)))))] + d.finish()
        assert kinds(got) == want
    out = segment(frame(spark, [float(x) for x in p]), 0.02).orderBy("event_seq").collect()
    assert [(r["event_type"], r["reference_price"], r["confirm_price"], r["extreme_price"], r["price_dc"], r["price_os"]) for r in out] == want
    assert end_state(frame(spark, [float(x) for x in p]), 0.02).agg(F.sum("n_ticks")).first()[0] in (len(clean), None)


def test_prices_of_zero(spark):
    e = segment(frame(spark, [5.0, 0.0, 4.0, 8.0, 0.0, 0.0, 3.0, 9.0]), 0.5)
    got = create_registry(0.5).compute(e).orderBy("event_seq").collect()
    zero = [r for r in got if r["reference_price"] == 0]
    assert zero and all(r["dc_return"] is None and r["tmv"] is None for r in zero) and any(r["confirm_price"] == 0 and r["os_return"] is None for r in got)
    day = analysis.with_day(e)
    assert analysis.coastline(e, ["ticker"]).first()["coastline"] > 0 and analysis.scale_profile(day).count() and check(day, 0.5).count()
    assert analysis.histogram(e, analysis.change(), 4).agg(F.sum("n")).first()[0] == len(got) - len(zero)


def test_quiet_key():
    """Four times the ticks take about four times as long, and memory is the ticks since the extremes."""

    def took(n):
        p = 100 + 0.01 * np.sin(np.arange(n) / 7)
        p[1000], p[1001] = 100.5, 99.5
        d, began = Detector(0.05, with_orphans=False), time.process_time()
        for a in range(0, n, 10_000):
            assert not d.feed(T(p[a : a + 10_000], np.arange(a, min(a + 10_000, n))))
        return time.process_time() - began

    took(100_000)
    assert took(4_000_000) < 12 * took(1_000_000) + 0.2
    d = Detector(0.05, with_orphans=False)
    for a in range(0, 1_000_000, 10_000):  # both extremes move on
        d.feed(T(100 + np.arange(a, a + 10_000) * 1e-7 * np.where(np.arange(10_000) % 2, 1, -1), np.arange(a, a + 10_000)))
    assert len(d.kept) < 50_000


def test_tail_keeps_what_it_gave_out():
    p = 100 * np.exp(np.cumsum(np.random.default_rng(5).normal(0, 0.01, 5000)))
    whole = kinds(detect(T(p), 0.02)[0])
    d = Detector(0.02)
    got = [e for a in range(0, len(p), 7) for e in d.feed(T(p[a : a + 7], np.arange(a, min(a + 7, len(p)))))] + d.finish()
    assert kinds(got) == whole


def maps(df):
    df.count()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("MapInArrow")


def test_events_are_computed_once(spark):
    e = segment(frame(spark, [100.0, 103, 99, 104, 100, 105] * 5), 0.02)
    assert maps(create_registry(0.02).compute(e)) == 1 and maps(analysis.every_nth(e)) == 1
    other = segment(frame(spark, [100.0, 104, 99, 104, 100, 105] * 5), 0.02)
    assert maps(converge.summary(converge.compare(analysis.with_day(e), analysis.with_day(other)))) == 2


def test_limits_given_are_one_pass(spark):
    e = segment(frame(spark, [100.0, 103, 99, 104, 100, 105] * 5), 0.02)
    lim = e.agg(F.min(F.col("confirm_time").cast("double")), F.max(F.col("confirm_time").cast("double")), F.min("confirm_price"), F.max("confirm_price")).first()
    args = ("confirm_time", "confirm_price", "event_type", 8, 4)
    assert analysis.raster(e, *args).exceptAll(analysis.raster(e, *args, limits=tuple(lim))).count() == 0 and maps(analysis.raster(e, *args, limits=tuple(lim))) == 1


def test_months_end_where_the_next_begins(spark):
    rows = [("A", 0.1, 0, dt.date(2025, 1, 1), 5.0, 10, -1.0, -1), ("A", 0.1, 1, dt.date(2025, 2, 1), 7.0, 20, 8.0, 30), ("A", 0.1, 2, dt.date(2025, 2, 1), 8.0, 30, -1.0, -1), ("A", 0.1, 3, dt.date(2025, 4, 1), 9.0, 40, -1.0, -1)]
    e = spark.createDataFrame(rows, "ticker string, theta double, event_seq bigint, period date, reference_price double, reference_time bigint, extreme_price double, extreme_time bigint")
    got = [(r["extreme_price"], r["extreme_time"]) for r in reconcile_months(e).orderBy("event_seq").collect()]
    assert got == [(7.0, 20), (8.0, 30), (-1.0, -1), (-1.0, -1)]


def test_early_stop(spark):
    ticks = frame(spark, [100.0, 103, 99, 104, 100, 105] * 40)
    before = Engine(0.02).events(ticks).withColumnRenamed("period", "day")
    with pytest.warns(RuntimeWarning, match="incomplete"):
        e, report = Engine(0.02).process_date_range(ticks, previous=before, stop_on_convergence=True)
    assert e.select("period").distinct().count() == 1 and e.count() < before.count()
    whole, _ = Engine(0.02).process_date_range(ticks, previous=before)
    assert whole.count() == before.count()


def test_layouts(spark, tmp_path):
    ticks = frame(spark, [100.0, 103, 99, 104, 100, 105] * 40)
    day, month = str(tmp_path / "day"), str(tmp_path / "month")
    silver.write(Engine(0.02).events(ticks), day)
    silver.write(Engine(0.02).events(ticks, monthly=True), month, monthly=True)
    assert not silver.is_monthly(spark, day) and silver.is_monthly(spark, month)
    assert silver.read(spark, month).count() == silver.read(spark, day).count() > 0
    with pytest.raises(ValueError, match="no days"):
        silver.read(spark, month, day_start=1)


def test_states_at_the_edges(spark, tmp_path):
    s = state.empty_state(spark, "A", 0.02, dt.date(2025, 6, 1)).withColumn("current_trend", F.lit(1))
    path = str(tmp_path / "s")
    state.save(s.drop("n_ticks", "high_price"), path)
    got = state.load(spark, path).first()
    assert (got["n_ticks"], got["high_price"], got["period"], got["current_trend"]) == (0, 0.0, dt.date(2025, 6, 1), 1)
    assert state.state_path(path, 0.02, dt.date(2025, 6, 1)) == f"{path}/theta_text=0.02/period_text=2025-06-01" and (tmp_path / "s/theta_text=0.02/period_text=2025-06-01").exists()
    s.drop("orphan_price").write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="orphan_price"):
        state.load(spark, str(tmp_path / "bad"))
    (tmp_path / "s").rename(tmp_path / "s.backup")  # as if a clean-up had ended half-way
    assert state.load(spark, path).count() == 1 and not (tmp_path / "s.backup").exists()
    state.save(s.withColumn("period", F.lit(dt.date(2025, 6, 2))), path)
    assert len(state.cleanup(spark, path, 1, dry_run=False)) == 1 and state.load(spark, path).count() == 1
    assert not list(tmp_path.glob("*.staged")) and not list(tmp_path.glob("*.backup"))


def test_texts_and_frames(spark):
    e = segment(frame(spark, [100.0, 103, 99, 104, 100, 105] * 10), 0.02)
    r = converge.summary(converge.compare(analysis.with_day(e), analysis.with_day(e))).first()
    assert "perfect: 3 of 3 (100.0%)" in converge.summary_text(r.asDict())
    d = analysis.durations(e, 5).collect()
    assert sum(x["n"] for x in d) == e.count() and d[0]["low"] <= d[0]["mean"] <= d[0]["high"]
    p = {x["event_type"]: x["positions"] for x in analysis.positions(e).collect()}
    assert sorted(p[1] + p[-1]) == list(range(e.count()))
    y = analysis.y_limits(e, frame(spark, [1.0, 500.0])).first()
    assert y["y0"] < 1 and y["y1"] > 500
