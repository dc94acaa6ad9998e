"""Analyses of events: scale laws, percentiles, threshold sweeps, and the frames that charts are drawn from."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col
LIVE = "extreme_price <> -1.0"


def with_day(events: DataFrame, column: str = "confirm_time") -> DataFrame:
    """day: the UTC date of a time in ns."""
    return events.withColumn("day", F.date_from_unix_date(F.floor(c(column) / F.lit(86_400_000_000_000)).cast("int")))


def change() -> Column:
    """Null where the reference is 0."""
    return F.try_divide(F.abs(c("confirm_price") - c("reference_price")), c("reference_price"))


def overshoot() -> Column:
    """Null where the confirmation is at 0."""
    return F.try_divide(F.abs(c("extreme_price") - c("confirm_price")), c("confirm_price"))


def _zero() -> Column:
    return c("extreme_time") == c("confirm_time")


def scale_profile(events: DataFrame, by: str = "day") -> DataFrame:
    """Per day, of settled events: counts, share without overshoot, means of change, overshoot and total move, and the
    spread of overshoots (population deviation). An event without overshoot counts its change only."""
    os = F.when(~_zero(), overshoot())
    move = change() + F.coalesce(os, F.lit(0.0))
    return events.filter(LIVE).groupBy(by).agg(F.count("*").alias("n_events"), F.count_if(_zero()).alias("n_zero_os"), F.avg(_zero().cast("double")).alias("zero_os_rate"), F.avg(change()).alias("mean_dc"), F.avg(os).alias("mean_os"), F.avg(move).alias("mean_tmv"), F.stddev_pop(os).alias("std_os"), F.median(os).alias("median_os"), F.min(os).alias("min_os"), F.max(os).alias("max_os"))


def os_percentiles(events: DataFrame, by: list[str], shares: tuple[float, ...] = tuple(i / 20 for i in range(1, 20))) -> DataFrame:
    rows = events.filter(LIVE).filter(~_zero()).groupBy(*by).agg(F.percentile(overshoot(), list(shares)).alias("p"))
    return rows.select(*by, F.posexplode("p").alias("i", "value")).select(*by, F.element_at(F.array(*map(F.lit, shares)), c("i") + 1).alias("share"), "value")


def os_below_theta(events: DataFrame, theta: float, by: list[str]) -> DataFrame:
    live = events.filter(LIVE).filter(~_zero())
    return live.groupBy(*by).agg(F.avg((overshoot() < theta / 2).cast("double")).alias("below_half_theta"), F.avg((overshoot() < theta).cast("double")).alias("below_theta"))


def month_summary(profile: DataFrame, theta: float) -> DataFrame:
    """Of the days' mean overshoots: mean, median, min, max, population deviation, days below half of theta, deviation from theta."""
    return profile.agg(F.count("*").alias("n_days"), F.avg("mean_os").alias("mean"), F.median("mean_os").alias("median"), F.min("mean_os").alias("min"), F.max("mean_os").alias("max"), F.stddev_pop("mean_os").alias("std"), F.count_if(c("mean_os") < 0.5 * theta).alias("days_below"), ((F.avg("mean_os") - theta) / theta).alias("deviation"))


def late_confirmations(events: DataFrame) -> DataFrame:
    """Settled events confirmed at or after their extreme, and why."""
    same = F.abs(c("extreme_price") - c("confirm_price")) < 1e-6
    return events.filter(LIVE).filter("confirm_time >= extreme_time").withColumn("reason", F.when(same, "zero_overshoot").when(c("confirm_time") == c("extreme_time"), "same_instant").otherwise("out_of_order"))


# -- thresholds


def coastline(events: DataFrame, by: list[str]) -> DataFrame:
    """Per threshold: events and the length of the coastline, the sum of relative changes and overshoots. What is
    relative to a price of 0 adds nothing."""
    settled = F.when(c("extreme_price") != -1.0, overshoot())
    none = F.lit(0.0)
    return events.groupBy(*by, "theta").agg(F.count("*").alias("n_events"), F.sum(F.coalesce(change(), none) + F.coalesce(settled, none)).alias("coastline"))


def coastline_fit(lengths: DataFrame, by: list[str]) -> DataFrame:
    """Least squares of ln(coastline) on ln(theta); more than two thresholds are needed."""
    x, y = F.ln("theta"), F.ln("coastline")
    rows = lengths.filter("coastline > 0").groupBy(*by).agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    return rows.filter("n > 2")


# -- frames for charts


def tick_phases(ticks: DataFrame, events: DataFrame) -> DataFrame:
    """Each tick of a phase with the phase's name: (ticker, theta, event_seq, time, price, dc_interval_type)."""
    name = lambda up, down: F.when(c("event_type") == 1, up).otherwise(down)
    part = lambda phase, up, down: events.select("ticker", "theta", "event_seq", F.explode(F.arrays_zip(c(f"time_{phase}").alias("time"), c(f"price_{phase}").alias("price"))).alias("x"), name(up, down).alias("dc_interval_type")).select("ticker", "theta", "event_seq", "x.time", "x.price", "dc_interval_type")
    return part("dc", "Upturn Event", "Downturn Event").union(part("os", "Upward Overshoot", "Downward Overshoot"))


def status(kind: Column) -> Column:
    """A phase's name as one of five categories."""
    return F.when(kind.contains("Upward"), "Upward").when(kind.contains("Downward"), "Downward").when(kind.contains("Upturn"), "Upturn").when(kind.contains("Downturn"), "Downturn").otherwise("Neutral")


def event_projection(events: DataFrame) -> DataFrame:
    return events.select("ticker", "theta", c("event_seq").alias("event_idx"), c("confirm_time").alias("time"), c("confirm_price").alias("price"), c("extreme_time").alias("ext_time"), c("extreme_price").alias("ext_price"), F.when(c("event_type") == 1, "Upturn").otherwise("Downturn").alias("type_desc"), (c("extreme_price") - c("confirm_price")).alias("overshoot"))


def day_markers(events: DataFrame, time: str = "confirm_time") -> DataFrame:
    """Midnights and noons (UTC, ns) within the range of the data."""
    half = F.lit(43_200_000_000_000)
    r = events.agg(F.min(time).alias("a"), F.max(time).alias("b"))
    k = F.explode(F.sequence(F.ceil(c("a") / half).cast("bigint"), F.floor(c("b") / half).cast("bigint")))
    return r.filter("ceil(a / 43200000000000) <= floor(b / 43200000000000)").select(k.alias("k")).select((c("k") * half).alias("time"), F.when(c("k") % 2 == 0, "midnight").otherwise("noon").alias("marker"))


def segments(events: DataFrame) -> DataFrame:
    """From each confirmation over its extreme to the next one: the last event of a key has no segment."""
    w = Window.partitionBy("ticker", "theta").orderBy("event_idx")
    e = event_projection(events).withColumn("next_ext_price", F.lead("ext_price").over(w)).withColumn("next_ext_time", F.lead("ext_time").over(w))
    return e.filter(c("next_ext_time").isNotNull())


def boxes(events: DataFrame) -> DataFrame:
    """Change and overshoot of each event as boxes with heights, hours and labels."""
    hours = lambda a, b: (c(b) - c(a)) / 3.6e12
    box = lambda p0, p1, t0, t1, what: F.struct(F.lit(what).alias("phase"), F.least(p0, p1).alias("y0"), F.greatest(p0, p1).alias("y1"), F.abs(c(p1) - c(p0)).alias("dp"), hours(t0, t1).alias("hours"), F.format_string("%.2f h", hours(t0, t1)).alias("label"))
    live = events.filter(LIVE)
    return live.select("ticker", "theta", "event_seq", F.explode(F.array(box("reference_price", "confirm_price", "reference_time", "confirm_time", "change"), box("confirm_price", "extreme_price", "confirm_time", "extreme_time", "overshoot"))).alias("b")).select("ticker", "theta", "event_seq", "b.*")


MOST_HOURS, DEFAULT_HOURS = 168, 24


def time_window(df: DataFrame, start: int, end: int | None = None, time: str = "time", most_hours: int = MOST_HOURS) -> DataFrame:
    """Rows from start to end (ns, both inclusive), a day by default, most_hours at most."""
    hour = 3_600_000_000_000
    end = start + DEFAULT_HOURS * hour if end is None else min(end, start + most_hours * hour)
    return df.filter(c(time).between(start, end))


def event_range(events: DataFrame, first: int, last: int) -> DataFrame:
    """Per key: the time from the first event's extreme to the extreme of the event after the last one, an hour at least,
    168 around the middle at most. A provisional event's extreme isn't known; its confirmation stands for it."""
    hour = 3_600_000_000_000
    w = Window.partitionBy("ticker", "theta").orderBy("event_seq")
    own = F.when(c("extreme_price") != -1.0, c("extreme_time")).otherwise(c("confirm_time"))
    e = events.withColumn("own_time", own).withColumn("next_time", F.coalesce(F.lead("own_time").over(w), "own_time")).filter(c("event_seq").between(first, last))
    r = e.groupBy("ticker", "theta").agg(F.min("own_time").alias("a"), F.max("next_time").alias("b"))
    span = F.least(F.greatest(c("b") - c("a"), F.lit(hour)), F.lit(MOST_HOURS * hour))
    middle = c("a") + F.floor((c("b") - c("a")) / 2)
    wide = ((c("b") - c("a")) < hour) | ((c("b") - c("a")) > MOST_HOURS * hour)
    return r.select("ticker", "theta", F.when(wide, middle - F.floor(span / 2)).otherwise(c("a")).cast("bigint").alias("start"), F.when(wide, middle - F.floor(span / 2) + span).otherwise(c("b")).cast("bigint").alias("end"))


def y_limits(events: DataFrame, ticks: DataFrame | None = None) -> DataFrame:
    """Shared limits of a chart: the least and greatest price of events, and of the window's ticks if given, padded by 8 %
    of the span or 35."""
    ext = F.when(c("extreme_price") != -1.0, c("extreme_price"))
    r = events.groupBy("ticker", "theta").agg(F.min(F.least("reference_price", "confirm_price", ext)).alias("low"), F.max(F.greatest("reference_price", "confirm_price", ext)).alias("high"))
    if ticks is not None:
        t = ticks.groupBy("ticker").agg(F.min("price").alias("_low"), F.max("price").alias("_high"))
        r = r.join(t, "ticker", "left").select("ticker", "theta", F.least("low", "_low").alias("low"), F.greatest("high", "_high").alias("high"))
    pad = F.greatest((c("high") - c("low")) * 0.08, F.lit(35.0))
    return r.select("ticker", "theta", (c("low") - pad).alias("y0"), (c("high") + pad).alias("y1"))


def _bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """0 .. bins - 1, the upper edge in the last bin."""
    at = F.floor((x - low) / F.when(high > low, high - low).otherwise(1.0) * bins)
    return F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)).cast("int")


def raster(df: DataFrame, x: str, y: str, category: str, width: int, height: int, limits: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Counts by cell and category. limits (x from, to, y from, to): one pass; without them the input is read twice, first
    for one aggregated row of limits, so it should be a written table."""
    if limits is not None:
        x0, x1, y0, y1 = map(F.lit, limits)
        return df.groupBy(_bin(c(x).cast("double"), x0, x1, width).alias("px"), _bin(c(y), y0, y1, height).alias("py"), category).agg(F.count("*").alias("n"))
    lim = df.agg(F.min(x).cast("double").alias("x0"), F.max(x).cast("double").alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    return df.crossJoin(F.broadcast(lim)).groupBy(_bin(c(x).cast("double"), c("x0"), c("x1"), width).alias("px"), _bin(c(y), c("y0"), c("y1"), height).alias("py"), category).agg(F.count("*").alias("n"))


def every_nth(events: DataFrame, markers: int = 30) -> DataFrame:
    """Every ceil(n / markers)-th event of each key, the first included."""
    return events.withColumn("_n", F.count("*").over(Window.partitionBy("ticker", "theta"))).filter(c("event_seq") % F.ceil(c("_n") / markers) == 0).drop("_n")


def trend_runs(events: DataFrame) -> DataFrame:
    """Runs of events of one type: (run, event_type, first, last, n)."""
    w = Window.partitionBy("ticker", "theta").orderBy("event_seq")
    e = events.withColumn("_new", F.coalesce((F.lag("event_type").over(w) != c("event_type")).cast("int"), F.lit(0))).withColumn("run", F.sum("_new").over(w))
    return e.groupBy("ticker", "theta", "run", "event_type").agg(F.min("event_seq").alias("first"), F.max("event_seq").alias("last"), F.count("*").alias("n"))


def histogram(df: DataFrame, value: Column, bins: int, *by: str, limits: tuple[float, float] | None = None) -> DataFrame:
    """Counts in equal bins between the least and the greatest value, or the limits given (see raster)."""
    rows = df.select(*by, value.cast("double").alias("v")).filter("v IS NOT NULL")
    if limits is not None:
        low, high = map(F.lit, limits)
        return rows.groupBy(*by, _bin(c("v"), low, high, bins).alias("bin")).agg(F.count("*").alias("n"), low.alias("low"), high.alias("high"))
    lim = rows.agg(F.min("v").alias("v0"), F.max("v").alias("v1"))
    return rows.crossJoin(F.broadcast(lim)).groupBy(*by, _bin(c("v"), c("v0"), c("v1"), bins).alias("bin")).agg(F.count("*").alias("n"), F.min("v0").alias("low"), F.max("v1").alias("high"))


def durations(events: DataFrame, bins: int = 30, phase: str = "dc") -> DataFrame:
    """Histogram of the seconds of changes (dc) or of settled overshoots (os), with the mean of all."""
    seconds = (c("confirm_time") - c("reference_time") if phase == "dc" else F.when(c("extreme_price") != -1.0, c("extreme_time") - c("confirm_time"))) / 1e9
    rows = events.select(seconds.alias("v")).filter("v IS NOT NULL")
    lim = rows.agg(F.min("v").alias("v0"), F.max("v").alias("v1"), F.avg("v").alias("mean"))
    return rows.crossJoin(F.broadcast(lim)).groupBy(_bin(c("v"), c("v0"), c("v1"), bins).alias("bin")).agg(F.count("*").alias("n"), F.min("v0").alias("low"), F.max("v1").alias("high"), F.min("mean").alias("mean"))


def directions(events: DataFrame) -> DataFrame:
    return events.groupBy("ticker", "theta").agg(F.count_if(c("event_type") == 1).alias("n_up"), F.count_if(c("event_type") == -1).alias("n_down"))


def positions(events: DataFrame) -> DataFrame:
    """Where upturns and downturns are: (ticker, theta, event_type, positions: event numbers in order), for a chart's
    window of events; of a whole table use trend_runs."""
    return events.groupBy("ticker", "theta", "event_type").agg(F.sort_array(F.collect_list("event_seq")).alias("positions"))


def rounded_range(first: float, last: float) -> tuple[int, int]:
    """A selected range of event numbers: the first rounded up, the last down."""
    return math.ceil(first), math.floor(last)
