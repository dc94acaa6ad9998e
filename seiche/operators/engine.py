"""Periods: days and months of ticks, with the state carried from one to the next.

mode "continuous" is one pass over all ticks; periods are only a column of the result. mode "carry_orphans" restarts each
period from the orphans of the one before, with their greatest and least price as extremes; its results depend on where
periods are cut, and it exists for compatibility.
"""

from __future__ import annotations

import datetime as dt
import time
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seiche.operators import converge, reconcile
from seiche.operators import state as states_
from seiche.operators.kernel import FIELDS, Detector, Ticks
from seiche.operators.segment import STATE_SCHEMA, USABLE, _ticks, event_batch, ordered, segment, state_row, with_thetas
from seiche.schema import SEGMENT_DDL, STATE_DDL, check_theta
from seiche.sources import silver
from seiche.sources.bronze import require

DAY = 86_400_000_000_000
MODES = ("continuous", "carry_orphans")
c = F.col


def day_of(column: str):
    return F.date_from_unix_date(F.floor(c(column) / F.lit(DAY)).cast("int"))


def split_days(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("day", day_of("time"))


def day_counts(ticks: DataFrame) -> DataFrame:
    return split_days(ticks).groupBy("ticker", "day").agg(F.count("*").alias("n_ticks"))


def _period_starts(time_: np.ndarray, monthly: bool) -> np.ndarray:
    days = time_ // DAY
    if not monthly:
        return days
    return days.astype("datetime64[D]").astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)


class Chain:
    """A group's periods in order, each from the orphans of the one before (at most lookback days back; months: the one
    month before). want: "events" or "states"."""

    def __init__(self, want: str, monthly: bool, lookback: int = states_.MAX_LOOKBACK):
        self.want, self.monthly, self.lookback = want, monthly, lookback

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, period, self.key, self.before, self.n = [], None, None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if self.key is None:
                self.key = (b.column(b.schema.get_field_index("ticker"))[0].as_py(), b.column(b.schema.get_field_index("theta"))[0].as_py())
            t = _ticks(b)
            starts = _period_starts(t.time, self.monthly)
            cuts = [0, *(np.flatnonzero(np.diff(starts)) + 1).tolist(), len(t)]
            for a, z in zip(cuts, cuts[1:]):
                if period is not None and starts[a] != period:
                    yield from self._close(pending, period)
                    pending = []
                period = int(starts[a])
                pending.append(t[a:z])
        if period is not None:
            yield from self._close(pending, period)

    def _carried(self, period: int):
        if self.before is None:
            return None
        then = self.before[0]
        if self.monthly:
            one = np.datetime64(period, "D").astype("datetime64[M]") - 1
            return self.before if np.datetime64(then, "D").astype("datetime64[M]") == one else None
        return self.before if period - then <= self.lookback else None

    def _close(self, parts: list[Ticks], period: int) -> Iterator[pa.RecordBatch]:
        ticker, theta = self.key
        ticks = Ticks(*(np.concatenate([getattr(x, k) for x in parts]) for k in FIELDS))
        carried = self._carried(period)
        trend, orphans, ref = (carried[1], carried[2], carried[3]) if carried else (0, Ticks.none(), 0.0)
        high, low = (float(orphans.price.max()), float(orphans.price.min())) if len(orphans) else (0.0, 0.0)
        d = Detector(theta, trend, high, low, ref)
        whole = orphans.then(ticks)
        events = d.feed(whole) + d.finish()
        self.before = (period, d.trend, d.orphans(), d.os_ref)
        if self.want == "states":
            yield pa.RecordBatch.from_pylist([state_row(d, ticker, theta, dt.date(1970, 1, 1) + dt.timedelta(days=period), len(whole))], STATE_SCHEMA)
        elif events:
            out = event_batch(events, ticker, theta, self.n)
            self.n += len(events)
            yield out.append_column("period", pa.array([period] * out.num_rows, pa.int32()).cast(pa.date32()))


def _chain(ticks: DataFrame, theta: float, want: str, monthly: bool) -> DataFrame:
    require(ticks, ["ticker", "seq", "time", "price", "quantity", "direction"])
    rows = with_thetas(ticks.filter(USABLE), [theta]).select("ticker", "theta", "time", "seq", "price", "quantity", "direction")
    run = Chain(want, monthly)

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batches)

    return ordered(rows, ["ticker", "theta"]).groupBy("ticker", "theta").applyInArrow(call, STATE_DDL if want == "states" else f"{SEGMENT_DDL}, period date")


def broken(events: DataFrame) -> DataFrame:
    """Events that must never be written: no change ticks, lists of unequal length, extremes that precede their reference."""
    n = F.size("price_dc")
    return events.filter((n == 0) | (F.size("time_dc") != n) | (F.size("time_os") != F.size("price_os")) | (c("confirm_time") < c("reference_time")))


@dataclass
class EngineStats:
    n_days: int = 0
    n_ticks: int = 0
    n_events: int = 0
    seconds: float = 0.0

    @property
    def ticks_per_second(self) -> float:
        return self.n_ticks / self.seconds if self.seconds else 0.0

    @property
    def ms_per_day(self) -> float:
        return 1000 * self.seconds / self.n_days if self.n_days else 0.0

    @property
    def events_per_day(self) -> float:
        return self.n_events / self.n_days if self.n_days else 0.0


@dataclass
class Engine:
    """theta; base: the event table's folder (None: nothing is written); keep_state_files: keep the states of all
    periods, not only the last one's."""

    theta: float
    base: str | None = None
    keep_state_files: bool = True
    mode: str = "continuous"
    stats: EngineStats = field(default_factory=EngineStats)

    def __post_init__(self) -> None:
        check_theta(self.theta)
        if self.mode not in MODES:
            raise ValueError(f"mode is one of {', '.join(MODES)}")

    def events(self, ticks: DataFrame, monthly: bool = False) -> DataFrame:
        """All events with their period: the day or the first of the month in which they were confirmed, or detected."""
        if self.mode == "continuous":
            day = day_of("confirm_time")
            return segment(ticks, self.theta).withColumn("period", F.trunc(day, "month") if monthly else day)
        return _chain(ticks, self.theta, "events", monthly)

    def states(self, ticks: DataFrame, monthly: bool = False) -> DataFrame:
        return _chain(ticks, self.theta, "states", monthly)

    def process_date_range(self, ticks: DataFrame, monthly: bool = False, previous: DataFrame | None = None, reconciled: bool = True, stop_on_convergence: bool = False) -> tuple[DataFrame, DataFrame | None]:
        """Events of all days (or months), written if there is a base; previous: an earlier run's events (with day), to
        compare with. In carry mode each period's open event gets the extreme that the next period's first tick decides;
        in months the first new event's reference. stop_on_convergence: leave out what follows the first day on which
        every key has converged, with a warning that says which days are missing."""
        began = time.time()
        out = self.events(ticks, monthly)
        if self.mode == "carry_orphans" and reconciled:
            out = reconcile_months(out) if monthly else reconcile_periods(out, self.states(ticks), ticks)
        if stop_on_convergence and previous is not None:
            out = self._until_converged(out, previous)
        if self.base:
            if broken(out).limit(1).count():
                raise ValueError("events are broken; nothing was written")
            silver.write(out, self.base, monthly)
            if self.mode == "carry_orphans":
                s = self.states(ticks, monthly)
                states_.save(s if self.keep_state_files else s.join(states_.retired(s).select("ticker", "theta", "period"), ["ticker", "theta", "period"], "left_anti"), f"{self.base.rstrip('/')}/_states")
            out = silver.read(out.sparkSession, self.base, theta=self.theta, monthly=monthly)
            days = day_counts(ticks).agg(F.countDistinct("day"), F.sum("n_ticks")).first()
            self.stats = EngineStats(self.stats.n_days + days[0], self.stats.n_ticks + (days[1] or 0), self.stats.n_events + out.count(), self.stats.seconds + time.time() - began)
        report = converge.compare(previous, out.withColumnRenamed("period", "day")) if previous is not None else None
        return out, report

    def _until_converged(self, events: DataFrame, previous: DataFrame) -> DataFrame:
        days = converge.compare(previous, events.withColumnRenamed("period", "day")).groupBy("day").agg(F.bool_and("converged").alias("all"), F.sum("n_discrepancies").alias("bad"))
        stop = days.agg(F.min(F.when(c("all"), c("day"))).alias("day"), F.max("day").alias("last"), F.count_distinct("day").alias("n")).first()
        if stop["day"] is None or stop["day"] == stop["last"]:
            return events
        warnings.warn(f"converged on {stop['day']}: days after it, up to {stop['last']}, were not processed; the result is incomplete", RuntimeWarning, stacklevel=3)
        return events.filter(c("period") <= F.lit(stop["day"]))

    def process_day(self, ticks: DataFrame, date: dt.date, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """One day from the states given (period up to 7 days before): its events and its states."""
        day = split_days(ticks).filter(c("day") == F.lit(date)).drop("day")
        if state is not None:
            day = stitched(day, states_.previous(state, day.select("ticker").distinct().select("ticker", F.lit(self.theta).alias("theta"), F.lit(date).alias("period"))))
        return _from_state(day, self.theta, "events", date), _from_state(day, self.theta, "states", date)

    def process_month(self, ticks: DataFrame, year: int, month: int, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """One month in one pass, from the states of exactly the month before."""
        first = dt.date(year, month, 1)
        rows = split_days(ticks).filter(F.trunc("day", "month") == F.lit(first)).drop("day")
        if state is not None:
            rows = stitched(rows, states_.previous_month(state, year, month))
        return _from_state(rows, self.theta, "events", first), _from_state(rows, self.theta, "states", first)

    def diagnose(self, spark: SparkSession) -> dict:
        get = spark.conf.get
        return {"theta": self.theta, "mode": self.mode, "base": self.base, "shuffle_partitions": get("spark.sql.shuffle.partitions"), "adaptive": get("spark.sql.adaptive.enabled"), "time_zone": get("spark.sql.session.timeZone"), "spark": spark.version}

    def reset_stats(self) -> None:
        self.stats = EngineStats()


def stitched(ticks: DataFrame, carried: DataFrame) -> DataFrame:
    """Ticks after their key's orphans, which get negative seq, with the trend and the orphans' extremes as columns."""
    o = F.explode(F.arrays_zip(*states_.ORPHANS, F.sequence(-F.size("orphan_price"), F.lit(-1)).alias("n")))
    e = states_.extremes(carried)
    old = e.filter(F.size("orphan_price") > 0).select("ticker", o.alias("x")).select("ticker", c("x.n").cast("bigint").alias("seq"), c("x.orphan_time").alias("time"), c("x.orphan_price").alias("price"), c("x.orphan_qty").alias("quantity"), c("x.orphan_dir").alias("direction"))
    both = ticks.select(*old.columns).unionByName(old)
    return both.join(e.select("ticker", c("current_trend").alias("_trend"), c("ext_high").alias("_high"), c("ext_low").alias("_low")), "ticker", "left")


class _Carried:
    def __init__(self, want: str, period: dt.date):
        self.want, self.period = want, period

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, key, n, seen = None, None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            first = {k: b.column(b.schema.get_field_index(k))[0].as_py() for k in ("ticker", "theta", "_trend", "_high", "_low")}
            if d is None:
                key = first["ticker"], first["theta"]
                d = Detector(first["theta"], first["_trend"] or 0, first["_high"] or 0.0, first["_low"] or 0.0)
            seen += b.num_rows
            found = d.feed(_ticks(b))
            if found and self.want == "events":
                yield event_batch(found, *key, n)
            n += len(found)
        if d is not None:
            found = d.finish()
            if self.want == "states":
                yield pa.RecordBatch.from_pylist([state_row(d, *key, self.period, seen)], STATE_SCHEMA)
            elif found:
                yield event_batch(found, *key, n)


def _from_state(ticks: DataFrame, theta: float, want: str, period: dt.date) -> DataFrame:
    if "_trend" not in ticks.columns:
        ticks = ticks.withColumns({"_trend": F.lit(0), "_high": F.lit(0.0), "_low": F.lit(0.0)})
    run = _Carried(want, period)

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batches)

    rows = with_thetas(ticks.filter(USABLE), [theta])
    # orphans come first whatever their time
    by = rows.withColumn("_new", c("seq") >= 0).repartition("ticker", "theta").sortWithinPartitions("ticker", "theta", "_new", "time", "seq")
    out = by.groupBy("ticker", "theta").applyInArrow(call, STATE_DDL if want == "states" else SEGMENT_DDL)
    return out if want == "states" else out.withColumn("period", F.lit(period))


def reconcile_periods(events: DataFrame, states: DataFrame, ticks: DataFrame) -> DataFrame:
    """The open event of each day with the extreme that the first tick of the key's next day (7 days on at most) decides."""
    first = ticks.filter(USABLE).withColumn("next_period", day_of("time")).groupBy("ticker", "next_period").agg(F.min_by("price", F.struct("time", "seq")).alias("first_price"), F.min("time").alias("first_time"))
    s = states.withColumn("next_period", F.lead("period").over(Window.partitionBy("ticker", "theta").orderBy("period")))
    s = s.filter(F.datediff("next_period", "period") <= states_.MAX_LOOKBACK).join(first, ["ticker", "next_period"])
    d = reconcile.decide(s.drop("first_price", "first_time"), s.select("ticker", "theta", "period", "first_price", "first_time").withColumnRenamed("period", "_p")).filter("period = _p")
    changes = d.select("ticker", "theta", "period", "new_extreme_price", "new_extreme_time")
    last = F.row_number().over(Window.partitionBy("ticker", "theta", "period").orderBy(F.desc("event_seq"))) == 1
    rows = events.withColumn("_last", last).join(changes, ["ticker", "theta", "period"], "left")
    hit = c("_last") & c("new_extreme_price").isNotNull()
    return rows.withColumns({"extreme_price": F.when(hit, c("new_extreme_price")).otherwise(c("extreme_price")), "extreme_time": F.when(hit, c("new_extreme_time")).otherwise(c("extreme_time"))}).select(*events.columns)


def reconcile_months(events: DataFrame) -> DataFrame:
    """A month's last event, if it has no extreme yet, ends where the next month's first event of the key begins: at its
    reference. A month without events before the next one that has some leaves it as it is."""
    w = Window.partitionBy("ticker", "theta").orderBy("event_seq")
    nxt = lambda x: F.lead(x).over(w)
    hit = (F.months_between(nxt("period"), c("period")) == 1) & (c("extreme_price") <= 0)
    return events.withColumns({"extreme_price": F.when(hit, nxt("reference_price")).otherwise(c("extreme_price")), "extreme_time": F.when(hit, nxt("reference_time")).otherwise(c("extreme_time"))})
