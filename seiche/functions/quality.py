"""Forty checks of event tables, as boolean columns over one row, a neighbour, a day or two days."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seiche.schema import EVENT_COLUMNS, EVENT_DDL, SCALARS

THETA_TOLERANCE, PRICE_TOLERANCE, REPORTED = 1e-9, 1e-12, 100
SEVERITIES = ("critical", "high", "medium", "low", "info")
ZERO_OS_BOUND = 0.30
#: The order in which validators run.
LEVELS = {1: "structural", 2: "intra_event", 3: "temporal", 4: "price", 6: "collision", 5: "threshold", 7: "cross_day", 8: "scale_laws", 9: "determinism"}
RESULT_DDL = "level int, test string, day string, passed boolean, severity string, n_affected bigint, affected array<bigint>, value double, value2 double, message string"

c = F.col


@dataclass(frozen=True)
class RowCheck:
    """A check that each event passes or not. value: of all events of the day, a figure to report."""

    level: int
    name: str
    severity: str
    bad: Callable[[float], Column]
    value: Callable[[float], Column] | None = None
    value2: Callable[[float], Column] | None = None


def _provisional() -> Column:
    return c("extreme_price") == -1.0


def _falls(times: str) -> Column:
    a = c(times)
    pairs = F.zip_with(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), lambda x, y: x > y)
    return F.exists(pairs, lambda x: x)


def _lengths_differ(phase: str) -> Column:
    n = F.size(f"price_{phase}")
    return (F.size(f"time_{phase}") != n) | (F.size(f"qty_{phase}") != n) | (F.size(f"dir_{phase}") != n)


def _any(test: Callable[[Column], Column], *lists: str) -> Column:
    out = F.lit(False)
    for a in lists:
        out = out | F.exists(a, lambda x: F.coalesce(test(x), F.lit(False)))
    return out


def _not_finite(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) == float("inf"))


def _change() -> Column:
    """Null where the reference is 0."""
    return F.try_divide(F.abs(c("confirm_price") - c("reference_price")), c("reference_price"))


def _theoretical(theta: float) -> Column:
    return c("reference_price") * (F.lit(1.0) + c("event_type").cast("double") * F.lit(theta))


def _at_confirmation(phase: str) -> Column:
    return F.size(F.filter(f"time_{phase}", lambda t: t == c("confirm_time")))


def _wrong_choice(theta: float) -> Column:
    """Of several ticks at the confirmation, the least favourable price beyond the threshold isn't the one confirmed."""
    at = F.transform(F.filter(F.arrays_zip("price_dc", "time_dc"), lambda x: x["time_dc"] == c("confirm_time")), lambda x: x["price_dc"])
    up = F.array_min(F.filter(at, lambda p: p >= c("reference_price") * F.lit(1.0 + theta) - F.lit(PRICE_TOLERANCE)))
    down = F.array_max(F.filter(at, lambda p: p <= c("reference_price") * F.lit(1.0 - theta) + F.lit(PRICE_TOLERANCE)))
    expected = F.when(c("event_type") == 1, up).otherwise(down)
    return (F.size(at) >= 2) & expected.isNotNull() & (F.abs(expected - c("confirm_price")) > PRICE_TOLERANCE)


def _share(test: Callable[[], Column], among: Callable[[], Column] | None = None) -> Callable[[float], Column]:
    return lambda _: F.avg(F.when(among(), test().cast("double")) if among else test().cast("double"))


_never = lambda _: F.lit(False)
_dc = lambda: F.size("price_dc") > 0
_os = lambda: F.size("price_os") > 0

ROW_CHECKS = [
    RowCheck(1, "no_null_scalars", "critical", lambda t: F.exists(F.array(*(c(x).isNull() for x in SCALARS)), lambda x: x)),
    RowCheck(2, "dc_list_lengths_consistent", "critical", lambda t: _lengths_differ("dc")),
    RowCheck(2, "os_list_lengths_consistent", "critical", lambda t: _lengths_differ("os")),
    RowCheck(2, "event_type_valid_values", "critical", lambda t: ~c("event_type").isin(1, -1)),
    RowCheck(2, "dc_not_empty", "critical", lambda t: F.size("price_dc") == 0),
    RowCheck(2, "directions_valid_values", "critical", lambda t: _any(lambda x: ~x.isin(1, -1), "dir_dc", "dir_os")),
    RowCheck(2, "quantities_positive", "high", lambda t: _any(lambda x: x <= 0, "qty_dc", "qty_os")),
    RowCheck(3, "dc_timestamps_monotonic", "critical", lambda t: _falls("time_dc")),
    RowCheck(3, "os_timestamps_monotonic", "critical", lambda t: _falls("time_os")),
    RowCheck(3, "dc_before_os", "critical", lambda t: F.array_max("time_dc") > F.array_min("time_os")),
    RowCheck(3, "reference_before_confirm", "critical", lambda t: (c("reference_time") > c("confirm_time")) | (c("reference_time") == c("confirm_time")) & ~(_dc() & F.forall("time_dc", lambda x: x == F.get(c("time_dc"), F.lit(0))))),
    RowCheck(3, "confirm_before_extreme", "critical", lambda t: ~_provisional() & ((c("confirm_time") > c("extreme_time")) | (c("confirm_time") == c("extreme_time")) & _os())),
    RowCheck(3, "zero_os_rate", "info", _never, _share(lambda: c("extreme_time") == c("confirm_time"), lambda: ~_provisional())),
    RowCheck(3, "flash_event_rate", "info", _never, _share(lambda: c("reference_time") == c("confirm_time"))),
    RowCheck(3, "confirm_time_equals_last_dc_time", "critical", lambda t: F.try_element_at(c("time_dc"), F.lit(-1)) != c("confirm_time")),
    RowCheck(3, "timestamps_positive", "critical", lambda t: (c("reference_time") <= 0) | (c("confirm_time") <= 0) | _any(lambda x: x <= 0, "time_dc", "time_os")),
    RowCheck(4, "prices_positive", "critical", lambda t: (c("reference_price") <= 0) | (c("confirm_price") <= 0) | _any(lambda x: x <= 0, "price_dc", "price_os")),
    RowCheck(4, "prices_finite", "critical", lambda t: F.exists(F.array("reference_price", "confirm_price", "extreme_price"), _not_finite) | _any(_not_finite, "price_dc", "price_os")),
    RowCheck(4, "confirm_price_in_dc_range", "high", lambda t: ~c("confirm_price").between(F.array_min("price_dc"), F.array_max("price_dc"))),
    RowCheck(4, "confirm_price_matches_dc", "critical", lambda t: _dc() & ~F.exists("price_dc", lambda p: F.abs(p - c("confirm_price")) < PRICE_TOLERANCE)),
    RowCheck(4, "reference_price_chain", "high", lambda t: (c("_prev_extreme") != -1.0) & (F.abs(c("reference_price") - c("_prev_extreme")) > PRICE_TOLERANCE)),
    RowCheck(4, "extreme_price_in_os_range", "high", lambda t: ~_provisional() & _os() & (c("extreme_price") != F.when(c("event_type") == 1, F.array_max("price_os")).otherwise(F.array_min("price_os")))),
    RowCheck(5, "dc_magnitude_meets_theta", "high", lambda t: _change() < F.lit(t - THETA_TOLERANCE), lambda t: F.min(_change()), lambda t: F.avg(_change())),
    RowCheck(5, "slippage_bounded", "medium", lambda t: F.abs(c("confirm_price") - _theoretical(t)) > F.lit(2 * t) * c("reference_price"), lambda t: F.max(F.abs(c("confirm_price") - _theoretical(t))), lambda t: F.avg(F.abs(c("confirm_price") - _theoretical(t)))),
    RowCheck(5, "direction_matches_event_type", "critical", lambda t: (c("event_type") == 1) & (c("confirm_price") - c("reference_price") < -PRICE_TOLERANCE) | (c("event_type") == -1) & (c("confirm_price") - c("reference_price") > PRICE_TOLERANCE)),
    RowCheck(6, "no_os_ticks_at_confirm_time", "critical", lambda t: F.array_contains("time_os", c("confirm_time"))),
    RowCheck(6, "all_confirm_instant_in_dc", "critical", lambda t: _at_confirmation("os") > 0),
    RowCheck(6, "dc_os_no_timestamp_overlap", "high", lambda t: F.array_max("time_dc") >= F.array_min("time_os")),
    RowCheck(6, "conservative_price_selection", "high", _wrong_choice),
]


def _scale_value(name: str, theta: float) -> tuple[Column, Column | None]:
    live = ~_provisional()
    change = _change()
    over = F.try_divide(F.abs(c("extreme_price") - c("confirm_price")), c("confirm_price"))
    seconds = (c("confirm_time") - c("reference_time")) / 1e9
    return {
        "avg_os_magnitude_near_theta": (F.avg(F.when(live & _os(), over)), None),
        "avg_tmv_near_2theta": (F.avg(F.when(live, change + over)), None),
        "zero_os_rate_bounded": (F.avg((F.size("price_os") == 0).cast("double")), None),
        "dc_duration_distribution": (F.avg(seconds), F.median(seconds)),
    }[name]


def _scale_passed(name: str, theta: float, value: Column) -> Column:
    return {
        "avg_os_magnitude_near_theta": (value > 0.5 * theta) & (value < 2 * theta),
        "avg_tmv_near_2theta": (value > 1.5 * theta) & (value < 3 * theta),
        "zero_os_rate_bounded": value < ZERO_OS_BOUND,
        "dc_duration_distribution": F.lit(True),
    }[name]


SCALE_CHECKS = [("avg_os_magnitude_near_theta", "info"), ("avg_tmv_near_2theta", "info"), ("zero_os_rate_bounded", "medium"), ("dc_duration_distribution", "info")]


def structure(events: DataFrame) -> list[tuple]:
    """Checks of the schema alone: (test, passed, severity, message)."""
    have = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(EVENT_DDL).fields}
    missing = [x for x in EVENT_COLUMNS if x not in have]
    wrong = [f"{x}: {have[x]}, not {want[x]}" for x in EVENT_COLUMNS if x in have and have[x] != want[x]]
    return [("required_columns", not missing, "critical", ", ".join(missing) or "all columns are there"), ("column_types", not wrong, "critical", "; ".join(wrong) or "all types are right")]


def row_results(events: DataFrame, theta: float, by: str = "day", order: str = "event_seq", checks: list[RowCheck] | None = None, seq_keys: tuple[str, ...] = ("ticker", "theta")) -> DataFrame:
    """One row a day and check. All checks take one pass and one aggregation; the places of the first REPORTED bad events
    come from a window over bad events only."""
    checks = checks if checks is not None else ROW_CHECKS
    keys = [by, *(k for k in seq_keys if k in events.columns)]
    rows = events.withColumn("_prev_extreme", F.lag("extreme_price").over(Window.partitionBy(*keys).orderBy(order)))
    bad = lambda k: F.coalesce(k.bad(theta), F.lit(False))
    aggs = []
    for i, k in enumerate(checks):
        aggs.append(F.struct(F.lit(i).alias("i"), F.count_if(bad(k)).alias("n_affected"), (k.value(theta) if k.value else F.lit(None).cast("double")).alias("value"), (k.value2(theta) if k.value2 else F.lit(None).cast("double")).alias("value2")))
    totals = rows.groupBy(by).agg(F.array(*aggs).alias("_r")).select(by, F.explode("_r").alias("x")).select(by, "x.*")
    # a bit for each check, so that only bad events go further
    flags = F.filter(F.array(*(F.when(bad(k), F.lit(i)) for i, k in enumerate(checks))), lambda x: x.isNotNull())
    places = rows.select(by, c(order).cast("bigint").alias("_o"), F.explode(flags).alias("i"))
    first = places.withColumn("_n", F.row_number().over(Window.partitionBy(by, "i").orderBy("_o"))).filter(c("_n") <= REPORTED).groupBy(by, "i").agg(F.sort_array(F.collect_list("_o")).alias("affected"))
    meta = F.create_map(*(x for i, k in enumerate(checks) for x in (F.lit(i), F.struct(F.lit(k.level).alias("level"), F.lit(k.name).alias("test"), F.lit(k.severity).alias("severity")))))
    out = totals.join(first, [by, "i"], "left").withColumn("m", meta[c("i")])
    return out.select(c("m.level").alias("level"), c("m.test").alias("test"), c(by).cast("string").alias("day"), (c("n_affected") == 0).alias("passed"), c("m.severity").alias("severity"), "n_affected", F.coalesce("affected", F.expr("CAST(array() AS array<bigint>)")).alias("affected"), "value", "value2", F.format_string("%d events", "n_affected").alias("message"))


def scale_results(events: DataFrame, theta: float, by: str = "day") -> DataFrame:
    aggs = []
    for name, severity in SCALE_CHECKS:
        v, w = _scale_value(name, theta)
        aggs.append(F.struct(F.lit(name).alias("test"), F.lit(severity).alias("severity"), v.alias("value"), (w if w is not None else F.lit(None).cast("double")).alias("value2"), F.coalesce(_scale_passed(name, theta, v), F.lit(True)).alias("passed")))
    rows = events.groupBy(by).agg(F.array(*aggs).alias("_r")).select(by, F.explode("_r").alias("x"))
    return rows.select(F.lit(8).alias("level"), "x.test", c(by).cast("string").alias("day"), "x.passed", "x.severity", F.lit(0).cast("bigint").alias("n_affected"), F.expr("CAST(array() AS array<bigint>)").alias("affected"), "x.value", "x.value2", F.lit("").alias("message"))


def day_edges(events: DataFrame, by: str = "day", order: str = "event_seq") -> DataFrame:
    """First and last event of each day and key, with the day before it that has events."""
    keys = [k for k in ("ticker", "theta") if k in events.columns]
    last_live = F.max_by("extreme_price", F.when(~_provisional(), c(order)))
    e = events.groupBy(*keys, by).agg(F.min_by("reference_price", order).alias("first_reference"), F.min_by("event_type", order).alias("first_type"), F.max_by("event_type", order).alias("last_type"), F.max_by("extreme_price", order).alias("last_extreme"), last_live.alias("last_live_extreme"))
    w = Window.partitionBy(*keys).orderBy(by)
    return e.withColumn("prev_day", F.lag(by).over(w)).withColumn("prev_extreme", F.lag("last_live_extreme").over(w)).withColumn("prev_type", F.lag("last_type").over(w))


def cross_day_results(events: DataFrame, by: str = "day", order: str = "event_seq") -> DataFrame:
    """Per day, over all keys: references that don't start where the day before ended, trends that repeat across the
    boundary, last events that are provisional. A day without one before it is passed over."""
    e = day_edges(events, by, order)
    chain = c("prev_extreme").isNotNull() & (F.abs(c("first_reference") - c("prev_extreme")) > PRICE_TOLERANCE)
    same = c("prev_type").isNotNull() & (c("prev_type") == c("first_type"))
    live = c("last_extreme") != -1.0
    item = lambda name, severity, n, passed: F.struct(F.lit(name).alias("test"), F.lit(severity).alias("severity"), n.alias("n_affected"), passed.alias("passed"))
    aggs = F.array(item("reference_chain_across_days", "medium", F.count_if(chain), F.count_if(chain) == 0), item("trend_continuity", "info", F.count_if(same), F.lit(True)), item("last_event_extreme_provisional", "info", F.count_if(live), F.lit(True)))
    rows = e.groupBy(by).agg(aggs.alias("_r")).select(by, F.explode("_r").alias("x"))
    none = F.lit(None).cast("double")
    return rows.select(F.lit(7).alias("level"), "x.test", c(by).cast("string").alias("day"), "x.passed", "x.severity", "x.n_affected", F.expr("CAST(array() AS array<bigint>)").alias("affected"), none.alias("value"), none.alias("value2"), F.lit("").alias("message"))


def determinism_results(ticks: DataFrame, events: DataFrame, theta: float) -> DataFrame:
    """Segment the ticks again and compare the scalars both ways; bad are events of either side that the other lacks."""
    from seiche.operators.segment import segment

    cols = ["ticker", "theta", "event_seq", *SCALARS]
    again, was = segment(ticks, theta).select(*cols), events.select(*cols)
    n = again.exceptAll(was).union(was.exceptAll(again)).agg(F.count("*").alias("n_affected"))
    none = F.lit(None).cast("double")
    return n.select(F.lit(9).alias("level"), F.lit("reprocess_identical").alias("test"), F.lit("").alias("day"), (c("n_affected") == 0).alias("passed"), F.lit("critical").alias("severity"), "n_affected", F.expr("CAST(array() AS array<bigint>)").alias("affected"), none.alias("value"), none.alias("value2"), F.lit("").alias("message"))


def check(events: DataFrame, theta: float, by: str = "day", order: str = "event_seq", ticks: DataFrame | None = None, levels: list[int] | None = None) -> DataFrame:
    """All checks as one tidy frame (RESULT_DDL). ticks: also check that segmenting them again gives the same events."""
    spark = events.sparkSession
    todo = levels or list(LEVELS)
    schema_rows = [(1, t, "", ok, s, 0 if ok else 1, [], None, None, m) for t, ok, s, m in structure(events)]
    out = spark.createDataFrame(schema_rows if 1 in todo else [], RESULT_DDL)
    if not all(x in events.columns for x in EVENT_COLUMNS):
        return out
    if 1 in todo:
        none, empty = F.lit(None).cast("double"), F.expr("CAST(array() AS array<bigint>)")
        out = out.union(events.limit(1).agg(F.count("*").alias("n")).select(F.lit(1), F.lit("non_empty_dataframe"), F.lit(""), c("n") > 0, F.lit("high"), F.when(c("n") > 0, 0).otherwise(1).cast("bigint"), empty, none, none, F.lit("")))
    if rows := [k for k in ROW_CHECKS if k.level in todo]:
        out = out.union(row_results(events, theta, by, order, rows))
    if 7 in todo:
        out = out.union(cross_day_results(events, by, order))
    if 8 in todo:
        out = out.union(scale_results(events, theta, by))
    if 9 in todo:
        out = out.union(determinism_results(ticks, events, theta) if ticks is not None else spark.createDataFrame([(9, "reprocess_identical", "", True, "info", 0, [], None, None, "skipped: no ticks given")], RESULT_DDL))
    return out


def rollup(results: DataFrame) -> DataFrame:
    """Passed and failed assertions (all but info), the score, failures by severity: one row."""
    real = c("severity") != "info"
    fails = [F.count_if(~c("passed") & (c("severity") == s)).alias(f"failed_{s}") for s in SEVERITIES if s != "info"]
    r = results.agg(F.count("*").alias("n_results"), F.count_if(real & c("passed")).alias("n_passed"), F.count_if(real & ~c("passed")).alias("n_failed"), *fails)
    return r.withColumn("score", F.when(c("n_passed") + c("n_failed") > 0, c("n_passed") / (c("n_passed") + c("n_failed"))).otherwise(1.0))


def exit_code(rolled: dict, policy: str = "normal") -> int:
    """0 or 1. permissive: never fails; strict: any failed assertion; normal: a critical or high one."""
    if policy not in ("permissive", "normal", "strict"):
        raise ValueError(f"unknown policy {policy!r}")
    if policy == "permissive":
        return 0
    if policy == "strict":
        return int(rolled["n_failed"] > 0)
    return int(rolled["failed_critical"] + rolled["failed_high"] > 0)


def report(results: DataFrame, path: str | None = None) -> dict:
    """Totals, failures and figures as a document of a few rows a day; written as JSON if a path is given."""
    out = {"summary": rollup(results).first().asDict(), "failures": [r.asDict() for r in results.filter("NOT passed").orderBy("day", "level", "test").collect()], "figures": [r.asDict() for r in results.filter("value IS NOT NULL").groupBy("test").agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")).orderBy("test").collect()]}
    if path:
        with open(path, "w") as f:
            json.dump(out, f, indent=1, default=str)
    return out


def table_of(report_: dict) -> str:
    s = report_["summary"]
    lines = [f"{s['n_passed']} passed, {s['n_failed']} failed, score {s['score']:.4f}"]
    lines += [f"{x['severity']:8} {x['day']:10} {x['test']}: {x['n_affected']} events" for x in report_["failures"]]
    return "\n".join(lines)


