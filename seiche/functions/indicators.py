"""Indicators of events: a registry that resolves dependencies, 21 indicators of single events, 8 summaries, some extras."""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seiche.schema import check_theta

KEYS = ("ticker", "theta")
ORDER = "event_seq"


@dataclass(frozen=True)
class Metadata:
    description: str = ""
    category: str = ""
    is_event_level: bool = True


@dataclass(frozen=True)
class Indicator:
    """A named column. An event-level one gives an expression of a row (a window over `memory()` included), a summary one
    an aggregate. Dependencies are names of other indicators, present as columns when it is evaluated. windowed: a
    summary's expression with each of its aggregates passed through the function given, which lays it over a window; a
    summary without it is aggregated by key and joined back."""

    name: str
    expression: Callable[[], Column]
    dependencies: tuple[str, ...] = ()
    metadata: Metadata = field(default_factory=Metadata)
    windowed: Callable[[Callable[[Column], Column]], Column] | None = None

    def get_expression(self) -> Column:
        return self.expression()

    def validate_dependencies(self, available: Iterable[str]) -> None:
        if missing := sorted(set(self.dependencies) - set(available)):
            raise ValueError(f"{self.name} needs {', '.join(missing)}")


def memory(keys: tuple[str, ...] = KEYS, order: str = ORDER):
    return Window.partitionBy(*keys).orderBy(order)


class IndicatorRegistry:
    def __init__(self, keys: tuple[str, ...] = KEYS):
        self.keys = keys
        self._known: dict[str, Indicator] = {}

    def register(self, indicator: Indicator) -> None:
        if indicator.name in self._known:
            raise ValueError(f"{indicator.name} is registered already")
        self._known[indicator.name] = indicator

    def get_indicator(self, name: str) -> Indicator:
        if name not in self._known:
            raise KeyError(f"no indicator {name!r}; there are {', '.join(sorted(self._known))}")
        return self._known[name]

    def list_indicators(self) -> list[str]:
        return list(self._known)

    def layers(self, names: Iterable[str]) -> list[list[str]]:
        """The names and all they depend on, in layers that depend on earlier layers only; names sorted inside a layer."""
        need: dict[str, set[str]] = {}
        todo = list(names)
        while todo:
            name = todo.pop()
            if name not in need:
                need[name] = set(self.get_indicator(name).dependencies)
                todo += need[name]
        out = []
        while need:
            ready = sorted(n for n, d in need.items() if not d)
            if not ready:
                raise ValueError(f"indicators depend on each other: {', '.join(sorted(need))}")
            out.append(ready)
            need = {n: d - set(ready) for n, d in need.items() if n not in ready}
        return out

    def compute(self, df: DataFrame, indicators: list[str] | str = "all") -> DataFrame:
        """df with the indicators and all they depend on. Summaries are windows over a key's rows, all of a kind at once, so
        the events are computed once and dealt by their key once, as the indicators that look at the event before need it
        anyway. Without key columns the one row of summaries is broadcast."""
        names = self.list_indicators() if indicators == "all" else [indicators] if isinstance(indicators, str) else indicators
        by = [k for k in self.keys if k in df.columns]
        waiting: list[Indicator] = []

        def summed(df: DataFrame) -> DataFrame:
            w = Window.partitionBy(*by)
            if by:
                df = df.withColumns({i.name: i.windowed(lambda a: a.over(w)) for i in waiting if i.windowed})
            if joined := [i.get_expression().alias(i.name) for i in waiting if not by or not i.windowed]:
                df = df.join(df.groupBy(*by).agg(*joined), by) if by else df.crossJoin(F.broadcast(df.agg(*joined)))
            waiting.clear()
            return df

        for layer in self.layers(names):
            found = [self.get_indicator(n) for n in layer]
            if {d for i in found for d in i.dependencies} & {i.name for i in waiting}:
                df = summed(df)
            if rows := {i.name: i.get_expression() for i in found if i.metadata.is_event_level}:
                df = df.withColumns(rows)
            waiting += [i for i in found if not i.metadata.is_event_level]
        return summed(df)

    def summarise(self, df: DataFrame, indicators: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
        """One row a key (or other columns) with summaries only."""
        names = indicators or [n for n in self._known if not self._known[n].metadata.is_event_level]
        needed = sorted({d for n in names for d in self.get_indicator(n).dependencies})
        rows = self.compute(df, needed) if needed else df
        return rows.groupBy(*(by if by is not None else [k for k in self.keys if k in df.columns])).agg(*(self.get_indicator(n).get_expression().alias(n) for n in names))


def _when_positive(duration: str, value: str) -> Column:
    return F.when(F.col(duration) > 0, F.col(value) / (F.col(duration) / 1e9)).otherwise(0.0)


def _theoretical(theta: float) -> Column:
    return F.col("reference_price") * (F.lit(1.0) + F.col("event_type").cast("double") * F.lit(theta))


def _worst_at_confirmation() -> Column:
    """The worst price of the confirmation instant: the highest of an upturn, the lowest otherwise; null without a tick there."""
    at = F.transform(F.filter(F.arrays_zip("price_dc", "time_dc"), lambda x: x["time_dc"] == F.col("confirm_time")), lambda x: x["price_dc"])
    return F.when(F.col("event_type") == 1, F.array_max(at)).otherwise(F.array_min(at))


def _runs(theta: float) -> Column:
    """Steps of at least theta in the trend's direction along the overshoot, each from the last."""
    kind, p = F.col("event_type"), F.col("price_os")

    def step(a: Column, x: Column) -> Column:
        hit = ((kind == 1) & (x >= a["ref"] * F.lit(1.0 + theta))) | ((kind == -1) & (x <= a["ref"] * F.lit(1.0 - theta)))
        return F.struct(F.when(hit, x).otherwise(a["ref"]).alias("ref"), (a["n"] + F.when(hit, 1).otherwise(0)).alias("n"))

    start = F.struct(F.get(p, F.lit(0)).alias("ref"), F.lit(0).cast("bigint").alias("n"))
    rest = F.aggregate(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), start, lambda a, x: step(a, x).cast("struct<ref:double,n:bigint>"), lambda a: a["n"])
    return F.when(F.size(p) >= 2, rest).otherwise(F.lit(0).cast("bigint"))


def create_registry(theta: float = 0.005, keys: tuple[str, ...] = KEYS, order: str = ORDER) -> IndicatorRegistry:
    """All 29 indicators, those that need a threshold at theta."""
    theta = check_theta(theta)
    r = IndicatorRegistry(keys)
    c = F.col

    def event(name: str, expression: Callable[[], Column], *needs: str, category: str = "price", text: str = "") -> None:
        r.register(Indicator(name, expression, needs, Metadata(text, category, True)))

    def summary(name: str, build: Callable[[Callable[[Column], Column]], Column], *needs: str, text: str = "") -> None:
        r.register(Indicator(name, lambda: build(lambda a: a), needs, Metadata(text, "summary", False), build))

    event("dc_magnitude", lambda: c("confirm_price") - c("reference_price"), text="price change from the reference to the confirmation")
    event("os_magnitude", lambda: c("extreme_price") - c("confirm_price"), text="price change of the overshoot; of a provisional event -1 less the confirmation")
    event("dc_return", lambda: F.try_divide(c("dc_magnitude"), c("reference_price")), "dc_magnitude", text="null where the reference is 0")
    event("os_return", lambda: F.try_divide(c("os_magnitude"), c("confirm_price")), "os_magnitude", text="null where the confirmation is at 0")
    event("event_magnitude", lambda: c("dc_magnitude") + c("os_magnitude"), "dc_magnitude", "os_magnitude")
    event("dc_slippage", lambda: c("confirm_price") - _theoretical(theta), text="confirmation less the price at exactly theta, signed")
    event("dc_slippage_real", lambda: _worst_at_confirmation() - _theoretical(theta), text="worst price of the confirmation instant less the price at exactly theta")
    event("total_move", lambda: F.abs("event_magnitude"), "event_magnitude")
    event("tmv", lambda: F.try_divide(c("total_move"), c("reference_price") * F.lit(theta)), "total_move", text="total move in units of theta; null where the reference is 0")
    event("osv_event", lambda: F.abs("os_return") / F.lit(theta), "os_return", text="overshoot in units of theta")
    event("a1_dc_price_abs", lambda: F.abs("dc_magnitude"), "dc_magnitude")
    event("dc_time", lambda: c("confirm_time") - c("reference_time"), category="time", text="ns")
    event("os_time", lambda: c("extreme_time") - c("confirm_time"), category="time", text="ns; negative while provisional")
    event("event_time", lambda: c("dc_time") + c("os_time"), "dc_time", "os_time", category="time")
    event("dc_velocity", lambda: _when_positive("dc_time", "dc_magnitude"), "dc_time", "dc_magnitude", category="time", text="a second")
    event("os_velocity", lambda: _when_positive("os_time", "os_magnitude"), "os_time", "os_magnitude", category="time")
    event("event_velocity", lambda: _when_positive("event_time", "event_magnitude"), "event_time", "event_magnitude", category="time")
    event("runs_count", lambda: _runs(theta), category="tick")
    event("a4_prev_dcc_price", lambda: F.lag("confirm_price").over(memory(keys, order)), category="memory")
    event("a5_prev_os_flag", lambda: F.when(F.abs(F.lag("os_magnitude").over(memory(keys, order))) > 0, 1).otherwise(0), "os_magnitude", category="memory", text="0 for the first event")
    event("a6_flash_event", lambda: F.when(c("dc_time") == 0, 1).otherwise(0), "dc_time", category="memory")
    absolute = lambda over: F.coalesce(over(F.sum(F.abs("tmv"))), F.lit(0.0))
    summary("tmv_aggregated", absolute, "tmv")
    summary("avg_dc_time", lambda over: over(F.avg("dc_time")), "dc_time")
    summary("avg_return", lambda over: over(F.avg("dc_return")), "dc_return")
    summary("avg_os_magnitude", lambda over: over(F.avg("os_magnitude")), "os_magnitude", text="provisional events included")
    summary("volatility_dc", lambda over: over(F.stddev_samp("dc_return")), "dc_return")
    summary("ndc", lambda over: over(F.count("*")))
    summary("cdc", absolute, "tmv")
    signed = lambda over, k: F.coalesce(over(F.sum(F.when(c("event_type") == k, c("dc_time")).otherwise(0))), F.lit(0).cast("bigint"))
    summary("accumulated_time", lambda over: signed(over, 1) - signed(over, -1), "dc_time", text="time of upturns less time of downturns")
    return r


def register_all(registry: IndicatorRegistry) -> None:
    """Deprecated: all indicators at theta 0.005. Use create_registry."""
    warnings.warn("register_all is deprecated; use create_registry(theta)", DeprecationWarning, stacklevel=2)
    made = create_registry(0.005, registry.keys)
    for name in made.list_indicators():
        registry.register(made.get_indicator(name))


def compute(df: DataFrame, indicators: list[str] | str = "all", theta: float = 0.005) -> DataFrame:
    return create_registry(theta).compute(df, indicators)


# -- beyond the registry


def upturn_ratio() -> Column:
    return F.avg((F.col("event_type") == 1).cast("double"))


def smq() -> Column:
    """Overshoot over change, in absolute price: null where the change is zero."""
    return F.try_divide(F.abs(F.col("extreme_price") - F.col("confirm_price")), F.abs(F.col("confirm_price") - F.col("reference_price")))


def relative_volatility(df: DataFrame, a: str, b: str, theta: float) -> DataFrame:
    """mRV: the sum of |tmv| of ticker a over that of ticker b, for each threshold."""
    s = create_registry(theta).summarise(df.filter(F.col("ticker").isin(a, b)), ["cdc"])
    own = lambda t: F.sum(F.when(F.col("ticker") == t, F.col("cdc")))
    return s.groupBy("theta").agg(F.try_divide(own(a), own(b)).alias("mrv"))


def windowed_counts(df: DataFrame, start: int, end: int) -> DataFrame:
    """NDC and accumulated time of events confirmed from start to end (ns, inclusive)."""
    return create_registry(0.5).summarise(df.filter(F.col("confirm_time").between(start, end)), ["ndc", "accumulated_time"])


def tick_tmv(ticks: DataFrame, events: DataFrame) -> DataFrame:
    """aTMV of each tick after a reference and up to the next: |price - reference| / (reference theta). An as-of join by
    one window over ticks and references, without a range join."""
    refs = events.select("ticker", "theta", F.col("reference_time").alias("time"), F.lit(-1).cast("bigint").alias("seq"), F.lit(None).cast("double").alias("price"), F.col("reference_price").alias("ref"))
    rows = ticks.join(F.broadcast(events.select("theta").distinct())) if "theta" not in ticks.columns else ticks
    both = rows.select("ticker", "theta", "time", "seq", "price", F.lit(None).cast("double").alias("ref")).union(refs)
    w = Window.partitionBy("ticker", "theta").orderBy("time", F.col("ref").isNull(), "seq").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("last_ref", F.last("ref", ignorenulls=True).over(w)).filter("ref IS NULL AND last_ref IS NOT NULL").select("ticker", "theta", "time", "seq", "price", F.try_divide(F.abs(F.col("price") - F.col("last_ref")), F.col("last_ref") * F.col("theta")).alias("atmv"))


def lag1_autocorrelation(prices: str = "price_os") -> Column:
    """Of the prices of a list; null for fewer than three or without variance."""
    p = F.col(prices)
    mean = F.aggregate(p, F.lit(0.0), lambda a, x: a + x) / F.size(p)
    centred = F.transform(p, lambda x: x - mean)
    total = F.aggregate(centred, F.lit(0.0), lambda a, x: a + x * x)
    pairs = F.zip_with(F.slice(centred, 1, F.size(p) - 1), F.slice(centred, 2, F.size(p) - 1), lambda x, y: x * y)
    return F.when(F.size(p) >= 3, F.try_divide(F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x), total))


def shannon_entropy(directions: str = "dir_os") -> Column:
    """Bits, of the share of upward ticks of a list; null for an empty one."""
    d = F.col(directions)
    up = F.size(F.filter(d, lambda x: x == 1)) / F.size(d)
    part = lambda s: F.when((s > 0) & (s < 1), -s * F.log2(s)).otherwise(0.0)
    return F.when(F.size(d) > 0, part(up) + part(1 - up))


def spectrum(prices: str = "price_os"):
    """Power of the discrete Fourier transform of a list, mean removed (a vectorised Python function)."""

    @F.pandas_udf("array<double>")
    def power(lists: pd.Series) -> pd.Series:
        return lists.map(lambda x: (np.abs(np.fft.rfft(np.asarray(x, float) - np.mean(x))) ** 2).tolist() if x is not None and len(x) else [])

    return power(F.col(prices))


def haar_energy(prices: str = "price_os") -> Column:
    """Energy of the finest Haar wavelet details of a list: half the squared differences of consecutive pairs."""
    p = F.col(prices)
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size(p) / 2).cast("int") - 1), lambda i: F.pow(F.get(p, i * 2) - F.get(p, i * 2 + 1), 2) / math.sqrt(2) ** 2)
    return F.when(F.size(p) >= 2, F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)
