"""Registry, exact values on five events, summaries, extras."""

import pytest
from pyspark.sql import functions as F

from seiche.functions import indicators as ind

ROWS = [(0, 1, 100.0, 1000, 102.0, 1200, 101.0, 1100), (1, -1, 102.0, 2000, 99.0, 2200, 100.0, 2100), (2, 1, 99.0, 3000, 103.0, 3200, 101.5, 3100), (3, -1, 103.0, 4000, 98.0, 4200, 99.5, 4100), (4, 1, 98.0, 5000, 105.0, 5200, 103.0, 5100)]
DDL = "event_seq bigint, event_type int, reference_price double, reference_time bigint, extreme_price double, extreme_time bigint, confirm_price double, confirm_time bigint"


@pytest.fixture(scope="module")
def events(spark):
    df = spark.createDataFrame(ROWS, DDL).withColumn("ticker", F.lit("A")).withColumn("theta", F.lit(0.005))
    lists = {"price_dc": "array(100.5D, confirm_price)", "time_dc": "array(reference_time + 1, confirm_time)", "price_os": "array(101.0D, 101.5D, 102.0D)"}
    return df.withColumns({k: F.expr(v) for k, v in lists.items()})


def test_values(events):
    r = ind.create_registry(0.005).compute(events).orderBy("event_seq").collect()
    a, b = r[0], r[1]
    assert (a["dc_magnitude"], a["os_magnitude"], a["dc_return"], a["dc_time"], a["os_time"], a["event_time"]) == (1, 1, 0.01, 100, 100, 200)
    assert a["dc_velocity"] == a["os_velocity"] == a["event_velocity"] == pytest.approx(1e7)
    assert (b["dc_magnitude"], b["os_magnitude"], b["dc_return"]) == (-2, -1, -2 / 102)
    assert a["tmv"] == pytest.approx(4) and a["dc_slippage"] == pytest.approx(0.5) and a["dc_slippage_real"] == pytest.approx(0.5)
    assert [x["a5_prev_os_flag"] for x in r] == [0, 1, 1, 1, 1] and [x["a4_prev_dcc_price"] for x in r] == [None, 101, 100, 101.5, 99.5] and not any(x["a6_flash_event"] for x in r)
    assert a["runs_count"] == 1 and b["runs_count"] == 0
    assert all((x["ndc"], x["avg_dc_time"], x["accumulated_time"]) == (5, 100, 100) for x in r)
    assert len(ind.create_registry().list_indicators()) == 29


def test_plan_has_no_python(events):
    plan = ind.create_registry(0.005).compute(events)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_registry():
    r = ind.create_registry(0.01)
    assert r.layers(["tmv"]) == [["dc_magnitude", "os_magnitude"], ["event_magnitude"], ["total_move"], ["tmv"]]
    with pytest.raises(KeyError):
        r.get_indicator("none")
    with pytest.raises(ValueError, match="already"):
        r.register(ind.Indicator("tmv", lambda: F.lit(1)))
    r.register(ind.Indicator("x", lambda: F.lit(1), ("y",)))
    r.register(ind.Indicator("y", lambda: F.lit(1), ("x",)))
    with pytest.raises(ValueError, match="each other"):
        r.layers(["x"])
    with pytest.raises(ValueError, match="needs"):
        r.get_indicator("x").validate_dependencies([])
    with pytest.warns(DeprecationWarning):
        ind.register_all(ind.IndicatorRegistry())


def test_own_indicator_and_dependencies(events):
    r = ind.create_registry(0.005)
    r.register(ind.Indicator("twice", lambda: F.col("dc_magnitude") * 2, ("dc_magnitude",)))
    out = r.compute(events, ["twice"])
    assert {"twice", "dc_magnitude"} <= set(out.columns) and "tmv" not in out.columns
    assert out.filter("event_seq = 0").first()["twice"] == 2


def test_empty_and_single(events):
    r = ind.create_registry(0.005)
    assert r.compute(events.limit(0)).count() == 0
    one = r.compute(events.filter("event_seq = 0")).first()
    assert one["volatility_dc"] is None and one["ndc"] == 1
    assert r.summarise(events.limit(0), by=[]).first()["tmv_aggregated"] == 0


def test_extras(spark, events):
    assert events.agg(ind.upturn_ratio()).first()[0] == 0.6
    assert events.filter("event_seq = 1").select(ind.smq()).first()[0] == 0.5
    assert ind.windowed_counts(events, 2000, 4100).first()["ndc"] == 3
    assert ind.relative_volatility(events, "A", "A", 0.005).first()["mrv"] == 1
    x = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], [1, 1, -1, 1])], "price_os array<double>, dir_os array<int>")
    assert x.select(ind.lag1_autocorrelation()).first()[0] == pytest.approx(0.25)
    assert x.select(ind.shannon_entropy()).first()[0] == pytest.approx(0.8112781)
    assert x.select(ind.haar_energy()).first()[0] == pytest.approx(1.0)
    assert x.select(ind.spectrum()).first()[0][1] == pytest.approx(8.0)
    ticks = spark.createDataFrame([("A", 1050, 0, 101.0), ("A", 2100, 1, 100.0), ("A", 500, 2, 9.0)], "ticker string, time bigint, seq bigint, price double")
    got = {r["time"]: r["atmv"] for r in ind.tick_tmv(ticks, events).collect()}
    assert got == {1050: pytest.approx(1 / (100 * 0.005)), 2100: pytest.approx(2 / (102 * 0.005))}
