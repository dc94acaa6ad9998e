"""Segmentation in Spark, periods, state, reconciliation, convergence, the event table and streams."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from seiche.operators import converge, reconcile, state
from seiche.operators.engine import DAY, Engine, broken, day_counts, split_days
from seiche.operators.kernel import Ticks, detect
from seiche.operators.segment import end_state, segment
from seiche.schema import EVENT_COLUMNS, SCALARS, format_theta
from seiche.sources import bronze, silver
from seiche.streaming.detector import settled_events

START = 20_000  # days since 1970


def series(seed, n, days):
    r = np.random.default_rng(seed)
    p = np.round(100 * np.exp(np.cumsum(r.normal(0, 0.01, n))), 2)
    t = START * DAY + np.sort(r.integers(0, days * DAY // 1000, n)) * 1000
    t[5:8] = t[5]
    return p, t


@pytest.fixture(scope="module")
def data():
    return {k: series(i, 300, 4) for i, k in enumerate(["A", "B", "C"])}


@pytest.fixture(scope="module")
def ticks(spark, data):
    rows = [(k, i, int(t[i]), float(p[i]), 1.0, 1) for k, (p, t) in data.items() for i in range(len(p))]
    return spark.createDataFrame(rows, "ticker string, seq bigint, time bigint, price double, quantity double, direction tinyint").repartition(3).cache()


def as_ticks(p, t):
    return Ticks(np.asarray(p, float), np.asarray(t, np.int64), np.ones(len(p)), np.ones(len(p), np.int8))


def rows_of(events, first=0):
    return [(first + i, e.kind, e.reference_price, e.reference_time, e.extreme_price, e.extreme_time, e.confirm_price, e.confirm_time) for i, e in enumerate(events)]


def test_segment(ticks, data):
    out = segment(ticks, [0.02, 0.05])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    got = out.collect()
    for k, (p, t) in data.items():
        for theta in (0.02, 0.05):
            mine = sorted((r for r in got if r["ticker"] == k and r["theta"] == theta), key=lambda r: r["event_seq"])
            want = detect(as_ticks(p, t), theta)[0]
            assert [tuple(r[c] for c in ["event_seq", *SCALARS]) for r in mine] == rows_of(want)
            assert [r["price_os"] for r in mine] == [e.overshoot.price.tolist() for e in want] and [r["time_dc"] for r in mine] == [e.change.time.tolist() for e in want]
    assert set(EVENT_COLUMNS) <= set(out.columns) and broken(out).count() == 0


def test_errors(spark, ticks):
    with pytest.raises(ValueError, match="theta"):
        segment(ticks, 1.0)
    with pytest.raises(ValueError, match="missing: price"):
        segment(ticks.drop("price"), 0.1)
    with pytest.raises(ValueError, match="mode"):
        Engine(0.1, mode="other")
    assert segment(ticks.limit(0), 0.1).count() == 0
    assert [format_theta(x) for x in (0.005, 0.01, 0.1)] == ["0.005", "0.01", "0.1"]


def chain(p, t, theta):
    """Days from the orphans of the day before, with the open event reconciled by the next day's first tick."""
    out, states, before, n = [], [], None, 0
    for day in sorted(set(t // DAY)):
        own = t // DAY == day
        trend, o = (before[1], before[2]) if before and day - before[0] <= 7 else (0, Ticks.none())
        hi, lo = (o.price.max(), o.price.min()) if len(o) else (0.0, 0.0)
        new = None
        if len(o):
            first = p[own][0]
            if trend == 1 and first <= hi * (1 - theta) or trend == -1 and first >= lo * (1 + theta):
                new = (hi if trend == 1 else lo, int(o.time[-1]))
            elif trend == 1 and first > hi or trend == -1 and first < lo:
                new = (first, int(t[own][0]))
        if new and out and out[-1][0] == before[0]:
            out[-1] = (out[-1][0], out[-1][1][:4] + new + out[-1][1][6:])
        whole = o.then(as_ticks(p[own], t[own]))
        events, d = detect(whole, theta, trend, float(hi), float(lo))
        out += [(day, r) for r in rows_of(events, n)]
        n += len(events)
        before = (day, d.trend, d.orphans())
        states.append((day, d.trend, len(d.orphans()), len(whole)))
    return out, states


def test_carried_days(ticks, data):
    e, _ = Engine(0.03, mode="carry_orphans").process_date_range(ticks)
    got, s = e.collect(), Engine(0.03, mode="carry_orphans").states(ticks).collect()
    for k, (p, t) in data.items():
        want, states = chain(p, t, 0.03)
        mine = sorted((r for r in got if r["ticker"] == k), key=lambda r: r["event_seq"])
        assert [(START * 0 + (r["period"] - dt.date(1970, 1, 1)).days, tuple(r[c] for c in ["event_seq", *SCALARS])) for r in mine] == want
        assert sorted(((r["period"] - dt.date(1970, 1, 1)).days, r["current_trend"], len(r["orphan_price"]), r["n_ticks"]) for r in s if r["ticker"] == k) == states


def test_process_day_and_month(ticks, data):
    engine = Engine(0.03)
    one = dt.date(1970, 1, 1) + dt.timedelta(days=START)
    first, s = engine.process_day(ticks, one)
    second, s2 = engine.process_day(ticks, one + dt.timedelta(days=1), s)
    for k, (p, t) in data.items():
        want = [r for day, r in chain(p, t, 0.03)[0] if day == START + 1]
        got = sorted((r for r in second.collect() if r["ticker"] == k), key=lambda r: r["event_seq"])
        assert [tuple(r[c] for c in ["event_type", "confirm_price", "confirm_time"]) for r in got] == [(w[1], w[6], w[7]) for w in want]
    month, _ = engine.process_month(ticks, one.year, one.month)
    in_month = split_days(ticks).filter(F.trunc("day", "month") == F.lit(one.replace(day=1))).drop("day")
    assert month.drop("period").exceptAll(segment(in_month, 0.03)).count() == 0
    assert day_counts(ticks).agg(F.sum("n_ticks")).first()[0] == 900


def test_continuous_equals_one_pass(ticks):
    e, report = Engine(0.03).process_date_range(ticks, previous=Engine(0.03).events(ticks).withColumnRenamed("period", "day"))
    assert e.drop("period").exceptAll(segment(ticks, 0.03)).count() == 0
    assert report.filter("NOT is_perfect_match").count() == 0 and report.count() > 0


def test_event_table(spark, ticks, tmp_path):
    base = str(tmp_path / "silver")
    engine = Engine(0.03, base=base)
    out, _ = engine.process_date_range(ticks)
    n = segment(ticks, 0.03).count()
    assert out.count() == n == engine.stats.n_events and engine.stats.n_ticks == 900 and engine.stats.ticks_per_second > 0
    day = dt.date(1970, 1, 1) + dt.timedelta(days=START)
    got, theta = silver.read_dc_events(spark, base, "A", day.year, day.month, day.day, day.day)
    assert theta == 0.03 and {r["period"] for r in got.collect()} == {day}
    plan = got.select("confirm_price")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "price_dc" not in plan.split("ReadSchema")[1]
    assert silver.available_days(spark, base, "A", 0.03, day.year, day.month)[0] == day
    assert silver.load_month(spark, base, "A", 0.03, day.year, day.month).columns[-1] == "day"
    with pytest.raises(FileNotFoundError):
        silver.read_dc_month(spark, base, "Z", day.year, day.month)
    Engine(0.05, base=base).process_date_range(ticks)
    with pytest.raises(ValueError, match="several"):
        silver.read_dc_month(spark, base, "A", day.year, day.month)
    assert silver.path("/b", "A", 0.03, 2025, 1, 2) == "/b/ticker_key=A/theta_text=0.03/year=2025/month=01/day=02"


def make_state(spark, **k):
    base = {"ticker": "A", "theta": 0.02, "period": dt.date(2025, 6, 15), "current_trend": 1, "orphan_price": [105.0, 106.0, 107.0], "orphan_time": [1, 2, 3]} | k
    n = len(base["orphan_price"])
    return state.empty_state(spark, "A", 0.02, base["period"]).select("ticker", "theta", F.lit(base["period"]).alias("period"), "n_ticks", "n_events", "orphan_start", F.lit(base["current_trend"]).alias("current_trend"), *(["last_os_ref", "high_price", "high_time", "low_price", "low_time", "reference_extreme_price", "reference_extreme_time"]), F.expr(f"CAST(array({','.join(map(str, base['orphan_price']))}) AS array<double>)").alias("orphan_price"), F.expr(f"CAST(array({','.join(map(str, base['orphan_time']))}) AS array<bigint>)").alias("orphan_time"), F.expr(f"CAST(array_repeat(1, {n}) AS array<double>)").alias("orphan_qty"), F.expr(f"CAST(array_repeat(1, {n}) AS array<tinyint>)").alias("orphan_dir"))


@pytest.mark.parametrize(("trend", "orphans", "price", "want"), [(1, [105.0, 106, 107], 107 * 0.97, "confirm_reversal"), (1, [105.0, 106, 107], 108, "extend_os"), (-1, [95.0, 94, 93], 93 * 1.03, "confirm_reversal"), (-1, [95.0, 94, 93], 92, "extend_os"), (1, [], 90, "none"), (1, [105.0], 104.9, "none")])
def test_reconciliation(spark, trend, orphans, price, want):
    s = make_state(spark, current_trend=trend, orphan_price=orphans, orphan_time=list(range(1, len(orphans) + 1)))
    r = reconcile.decide(s, spark.createDataFrame([("A", 0.02, float(price), 9)], "ticker string, theta double, first_price double, first_time bigint")).first()
    assert r["decision"] == want
    assert (r["new_extreme_price"], r["new_extreme_time"]) == {"none": (None, None), "extend_os": (price, 9)}.get(want, ((max if trend == 1 else min)(orphans or [0]), len(orphans)))


def test_state(spark, tmp_path):
    days = [make_state(spark, period=dt.date(2025, 6, d)) for d in (1, 10, 14)]
    s = days[0].union(days[1]).union(days[2])
    path = str(tmp_path / "states")
    state.save(s, path)
    back = state.load(spark, path, "A", 0.02)
    assert back.count() == 3 and sorted(back.columns) == sorted(s.columns)
    asked = spark.createDataFrame([("A", 0.02, dt.date(2025, 6, 13)), ("A", 0.02, dt.date(2025, 6, 9))], "ticker string, theta double, period date")
    assert {(r["wanted"].day, r["period"].day) for r in state.previous(back, asked).collect()} == {(13, 10)}.union({(9, 1)} if 9 - 1 <= 7 else set())
    assert state.previous_month(back, 2025, 7).count() == 3 and state.stats(back).first()["n_states"] == 3
    assert state.cleanup(spark, path, 1) == [("A", 0.02, dt.date(2025, 6, 1)), ("A", 0.02, dt.date(2025, 6, 10))] and state.load(spark, path).count() == 3
    state.cleanup(spark, path, 1, dry_run=False)
    assert [r["period"].day for r in state.load(spark, path).collect()] == [14]
    with pytest.raises(ValueError, match="not valid"):
        state.save(make_state(spark, orphan_time=[3, 2, 1]), path)
    assert state.extremes(make_state(spark)).first()["ext_high"] == 107.0


def test_convergence(spark, tmp_path):
    def run(times, kinds):
        return spark.createDataFrame([("A", 0.02, "d1", i, [t], k) for i, (t, k) in enumerate(zip(times, kinds))], "ticker string, theta double, day string, event_seq bigint, time_dc array<bigint>, event_type int")

    r = converge.compare(run([1, 5, 9, 12], [1, -1, 1, -1]), run([2, 6, 9], [1, -1, 1])).first()
    assert (r["n_discrepancies"], r["first_discrepancy"], r["converged"], r["convergence_idx"]) == (2, 0, True, 2) and r["discrepancy_rate"] == 0.5
    r = converge.compare(run([1, 5], [1, -1]), run([2, 6], [1, -1]), strict=False, tolerance_ns=1).first()
    assert r["is_perfect_match"]
    r = converge.compare(run([1, 5], [1, -1]), run([], [])).first()
    assert (r["n_discrepancies"], r["converged"]) == (2, False)
    r = converge.compare(run([], []), run([1], [1]))
    assert (r.first()["converged"], r.first()["convergence_idx"]) == (True, 0)
    doc = converge.save_report(r, str(tmp_path / "r.json"), "A", 0.02)
    assert converge.load_report(str(tmp_path / "r.json"))["results"][0]["n_new"] == 1 and "A d1" in converge.text(doc["results"][0])
    assert converge.worst_days(r).count() == 1 and converge.summary(r).first()["n_days"] == 1
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(ValueError, match="ticker"):
        converge.load_report(str(tmp_path / "bad.json"))


def test_stream(spark, ticks, data, tmp_path):
    src, cut = str(tmp_path / "in"), START * DAY + 2 * DAY
    one = ticks.filter("ticker = 'A'")
    one.filter(F.col("time") < cut).coalesce(1).write.mode("append").parquet(src)
    stream = settled_events(spark.readStream.schema(one.schema).parquet(src), 0.03)
    q = stream.writeStream.format("memory").queryName("settled").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    one.filter(F.col("time") >= cut).coalesce(1).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    got = sorted(spark.sql("SELECT * FROM settled").collect(), key=lambda r: r["event_seq"])
    want = rows_of(detect(as_ticks(*data["A"]), 0.03)[0])
    assert [tuple(r[c] for c in ["event_seq", *SCALARS]) for r in got] == want[: len(got)] and len(got) >= len(want) - 2


def test_end_state_and_adapters(spark, ticks, data):
    r = {x["ticker"]: x for x in end_state(ticks, 0.03).collect()}
    for k, (p, t) in data.items():
        d = detect(as_ticks(p, t), 0.03)[1]
        assert (r[k]["current_trend"], r[k]["high_price"], r[k]["orphan_start"], r[k]["orphan_price"]) == (d.trend, d.high, d.orphan_start(), d.orphans().price.tolist())
    df = spark.createDataFrame([(1, dt.datetime(2025, 1, 1), 5.0), (2, dt.datetime(2025, 1, 1), 4.0)], "id bigint, ts timestamp_ntz, v double")
    got = bronze.ticks(df, None, "ts", "v", ["id"], name="X").orderBy("seq").collect()
    assert [(x["ticker"], x["seq"], x["time"], x["direction"]) for x in got] == [("X", 0, 1735689600 * 10**9, 1), ("X", 1, 1735689600 * 10**9, -1)]
    assert bronze.random_walk(spark, 100).count() == 100
