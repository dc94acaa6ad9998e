"""Each check passes on sound events and finds the one row that breaks it; charts' frames; every query runs."""

import json

import pytest
from pyspark.sql import functions as F

from seiche.functions import quality
from seiche.operators.segment import segment
from seiche.plans import analysis
from seiche.plans.queries import ORACLE, QUERIES

H = 3_600_000_000_000
BASE = {
    "ticker": "A", "theta": 0.02, "event_seq": 0, "event_type": 1, "reference_price": 100.0, "reference_time": 1 * H, "extreme_price": 104.0, "extreme_time": 4 * H, "confirm_price": 102.0, "confirm_time": 2 * H,
    "price_dc": [101.0, 102.0], "price_os": [103.0, 104.0], "time_dc": [H + 5, 2 * H], "time_os": [3 * H, 4 * H], "qty_dc": [1.0, 1.0], "qty_os": [1.0, 1.0], "dir_dc": [1, 1], "dir_os": [1, 1],
}
NEXT = BASE | {"event_seq": 1, "event_type": -1, "reference_price": 104.0, "reference_time": 4 * H, "extreme_price": -1.0, "extreme_time": -1, "confirm_price": 101.0, "confirm_time": 5 * H, "price_dc": [101.0], "time_dc": [5 * H], "qty_dc": [1.0], "dir_dc": [-1], "price_os": [], "time_os": [], "qty_os": [], "dir_os": []}
DDL = "ticker string, theta double, event_seq bigint, event_type tinyint, reference_price double, reference_time bigint, extreme_price double, extreme_time bigint, confirm_price double, confirm_time bigint, price_dc array<double>, price_os array<double>, time_dc array<bigint>, time_os array<bigint>, qty_dc array<double>, qty_os array<double>, dir_dc array<tinyint>, dir_os array<tinyint>"
BREAKS = {
    "no_null_scalars": {"reference_price": None}, "dc_list_lengths_consistent": {"qty_dc": [1.0]}, "os_list_lengths_consistent": {"dir_os": [1]}, "event_type_valid_values": {"event_type": 2}, "dc_not_empty": {"price_dc": []},
    "directions_valid_values": {"dir_os": [1, 0]}, "quantities_positive": {"qty_dc": [0.0, 1.0]}, "dc_timestamps_monotonic": {"time_dc": [2 * H, H + 5]}, "os_timestamps_monotonic": {"time_os": [4 * H, 3 * H]}, "dc_before_os": {"time_os": [H, 4 * H]},
    "reference_before_confirm": {"reference_time": 3 * H}, "confirm_before_extreme": {"extreme_time": H}, "confirm_time_equals_last_dc_time": {"time_dc": [H + 5, 2 * H - 1]}, "timestamps_positive": {"time_os": [0, 4 * H]}, "prices_positive": {"price_os": [0.0, 104.0]},
    "prices_finite": {"price_os": [float("nan"), 104.0]}, "confirm_price_in_dc_range": {"price_dc": [101.0, 101.5]}, "confirm_price_matches_dc": {"price_dc": [101.0, 103.0]}, "extreme_price_in_os_range": {"price_os": [103.0, 105.0]}, "dc_magnitude_meets_theta": {"reference_price": 101.0},
    "slippage_bounded": {"confirm_price": 107.0, "price_dc": [101.0, 107.0]}, "direction_matches_event_type": {"event_type": -1}, "no_os_ticks_at_confirm_time": {"time_os": [2 * H, 4 * H]}, "all_confirm_instant_in_dc": {"time_os": [2 * H, 4 * H]}, "dc_os_no_timestamp_overlap": {"time_os": [2 * H, 4 * H]},
    "conservative_price_selection": {"time_dc": [2 * H, 2 * H], "price_dc": [102.0, 103.0], "confirm_price": 103.0},
}


def frame(spark, *rows):
    names = [x.split()[0] for x in DDL.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], DDL).withColumn("day", F.lit("2025-01-01"))


def failed(results):
    return {(r["test"], tuple(r["affected"])) for r in results.filter("NOT passed").collect()}


def test_sound_events(spark):
    assert failed(quality.row_results(frame(spark, BASE, NEXT), 0.02)) == set()


def test_every_check_finds_its_break(spark):
    days = []
    for name, change in BREAKS.items():
        days.append(frame(spark, BASE | change, NEXT).withColumn("day", F.lit(name)))
    days.append(frame(spark, BASE, NEXT | {"reference_price": 103.5}).withColumn("day", F.lit("reference_price_chain")))
    all_ = days[0]
    for d in days[1:]:
        all_ = all_.union(d)
    found = {(r["day"], r["test"]): r for r in quality.row_results(all_, 0.02).filter("NOT passed").collect()}
    for name in [*BREAKS, "reference_price_chain"]:
        assert (name, name) in found, name
        assert found[name, name]["affected"] == [1 if name == "reference_price_chain" else 0] and found[name, name]["n_affected"] == 1
    never = {"zero_os_rate", "flash_event_rate"}
    assert {k.name for k in quality.ROW_CHECKS} - never == set(BREAKS) | {"reference_price_chain"}


def test_forty_checks_and_report(spark, tmp_path):
    two = frame(spark, BASE, NEXT).union(frame(spark, BASE | {"event_seq": 2, "reference_price": 90.0}).withColumn("day", F.lit("2025-01-02")))
    r = quality.check(two, 0.02)
    assert r.select("test").distinct().count() == 40
    cross = {(x["day"], x["test"]): x for x in r.filter("level = 7").collect()}
    assert not cross["2025-01-02", "reference_chain_across_days"]["passed"] and cross["2025-01-01", "reference_chain_across_days"]["passed"]
    rolled = quality.rollup(r).first().asDict()
    assert rolled["n_failed"] > 0 and 0 < rolled["score"] < 1
    assert [quality.exit_code(rolled, p) for p in ("permissive", "strict")] == [0, 1]
    doc = quality.report(r, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())["summary"]["n_failed"] == rolled["n_failed"] and "failed" in quality.table_of(doc)
    bad = quality.check(frame(spark, BASE).drop("dir_os"), 0.02)
    assert bad.filter("test = 'required_columns' AND NOT passed").count() == 1
    empty = quality.check(frame(spark, BASE).limit(0), 0.02)
    assert empty.filter("test = 'non_empty_dataframe' AND NOT passed").count() == 1


def test_determinism(spark):
    t = spark.createDataFrame([("A", i, i, p, 1.0, 1) for i, p in enumerate([100.0, 103.0, 99.0, 104.0, 98.0])], "ticker string, seq bigint, time bigint, price double, quantity double, direction tinyint")
    e = segment(t, 0.02)
    assert quality.determinism_results(t, e, 0.02).first()["passed"]
    assert quality.determinism_results(t, e.filter("event_seq > 0"), 0.02).first()["n_affected"] == 1


def test_frames(spark):
    e = frame(spark, BASE, NEXT)
    assert analysis.late_confirmations(frame(spark, BASE | {"extreme_time": H})).first()["reason"] == "out_of_order"
    assert [r["label"] for r in analysis.boxes(e).orderBy("phase").collect()] == ["1.00 h", "2.00 h"]
    assert analysis.segments(e).count() == 1 and analysis.trend_runs(e).count() == 2
    assert analysis.time_window(e, 2 * H, time="confirm_time").count() == 2 and analysis.time_window(e, 2 * H, 2 * H, "confirm_time").count() == 1
    r = analysis.event_range(e, 0, 0).first()
    assert (r["start"], r["end"]) == (4 * H, 5 * H)
    assert analysis.y_limits(e).first()["y0"] == 100 - 35
    assert {x["status"] for x in analysis.tick_phases(e, e).select(analysis.status(F.col("dc_interval_type")).alias("status")).collect()} == {"Upturn", "Upward", "Downturn"}
    assert analysis.rounded_range(1.2, 5.8) == (2, 5)
    assert [r["marker"] for r in analysis.day_markers(frame(spark, BASE, NEXT | {"confirm_time": 30 * H})).orderBy("time").collect()] == ["noon", "midnight"]
    assert analysis.event_projection(e).filter("event_idx = 0").first()["overshoot"] == 2.0


def test_query_names():
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) >= 50


@pytest.mark.parametrize("name", ["engine_carry_days", "engine_carry_states", "dq_rollup"])
def test_queries_without_sql(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
