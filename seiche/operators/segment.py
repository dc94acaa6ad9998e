"""Segmentation of ticks into directional-change events, for every ticker and threshold at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seiche.operators.kernel import Detector, Event, Ticks
from seiche.schema import SEGMENT_DDL, STATE_DDL, check_theta
from seiche.sources.bronze import require


#: Rows that are ticks.
USABLE = "price IS NOT NULL AND NOT isnan(price) AND time IS NOT NULL"


def with_thetas(ticks: DataFrame, thetas: Sequence[float]) -> DataFrame:
    return ticks.withColumn("theta", F.explode(F.array(*(F.lit(check_theta(t)) for t in thetas))))


def ordered(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One exchange by the keys and one sort, which the grouped map after it needs no more of."""
    return ticks.repartition(*keys).sortWithinPartitions(*keys, "time", "seq")


def _ticks(batch: pa.RecordBatch) -> Ticks:
    col = lambda n, t: batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False).astype(t, copy=False)
    return Ticks(col("price", np.float64), col("time", np.int64), col("quantity", np.float64), col("direction", np.int8))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else [], kind))


def event_batch(events: list[Event], ticker: str | None, theta: float, first: int) -> pa.RecordBatch:
    return events_batch([(ticker, theta, first + i, e) for i, e in enumerate(events)])


def events_batch(rows: list[tuple[str | None, float, int, Event]]) -> pa.RecordBatch:
    events = [r[3] for r in rows]
    scalar = lambda name, kind: pa.array([getattr(e, name) for e in events], kind)
    f, i, b = pa.float64(), pa.int64(), pa.int8()
    cols = {
        "ticker": pa.array([r[0] for r in rows], pa.string()), "theta": pa.array([r[1] for r in rows], f), "event_seq": pa.array([r[2] for r in rows], i),
        "event_type": scalar("kind", b), "reference_price": scalar("reference_price", f), "reference_time": scalar("reference_time", i),
        "extreme_price": scalar("extreme_price", f), "extreme_time": scalar("extreme_time", i), "confirm_price": scalar("confirm_price", f), "confirm_time": scalar("confirm_time", i),
    }
    for name, source, kind in (("price", "price", f), ("time", "time", i), ("qty", "quantity", f), ("dir", "direction", b)):
        cols[f"{name}_dc"] = _lists([getattr(e.change, source) for e in events], kind)
        cols[f"{name}_os"] = _lists([getattr(e.overshoot, source) for e in events], kind)
    cols |= {"dc_start": pa.array([e.reference + 1 for e in events], i), "dc_end": scalar("confirm", i), "os_end": scalar("end", i)}
    order = [x.split()[0] for x in SEGMENT_DDL.split(", ")]
    return pa.record_batch([cols[c] for c in order], order)


def key_runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str | None, float], int, int]]:
    """Stretches of a batch with one (ticker, theta): the key, the first row, the row after the last."""
    ticker, theta = batch.column(batch.schema.get_field_index("ticker")), batch.column(batch.schema.get_field_index("theta")).to_numpy()
    code = ticker.dictionary_encode(null_encoding="encode").indices.to_numpy()
    cuts = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (theta[1:] != theta[:-1])) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield (ticker[a].as_py(), float(theta[a])), a, b


#: Events and list elements that an output batch holds at most, about.
MOST_EVENTS, MOST_ELEMENTS = 5_000, 500_000


def _segment_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and order: one detector at a time, whatever the number of keys."""
    key, detector, n = None, None, 0
    out: list[tuple[str | None, float, int, Event]] = []
    held = 0

    def settled(events: list[Event]) -> None:
        nonlocal n, held
        out.extend((*key, n + i, e) for i, e in enumerate(events))
        n += len(events)
        held += sum(len(e.change) + len(e.overshoot) for e in events)

    for batch in batches:
        ticks = _ticks(batch)
        for own, a, b in key_runs(batch):
            if own != key:
                if detector is not None:
                    settled(detector.finish())
                key, detector, n = own, Detector(own[1], with_orphans=False), 0
            settled(detector.feed(ticks[a:b]))
            if len(out) >= MOST_EVENTS or held >= MOST_ELEMENTS:
                yield events_batch(out)
                out.clear()
                held = 0
    if detector is not None:
        settled(detector.finish())
    if out:
        yield events_batch(out)


def segment(ticks: DataFrame, thetas: float | Sequence[float]) -> DataFrame:
    """Events of every (ticker, theta), the last of each provisional (extreme -1). Rows without a price or time, or with a price that isn't a number, are left
    out. One exchange and one sort; then each task streams through its keys one after another, so many small keys cost no
    more than a large one, and what a task holds is a batch and the ticks of one open event."""
    require(ticks, ["ticker", "seq", "time", "price", "quantity", "direction"])
    many = thetas if isinstance(thetas, Sequence) else [thetas]
    rows = with_thetas(ticks.filter(USABLE), many).select("ticker", "theta", "time", "seq", "price", "quantity", "direction")
    return ordered(rows, ["ticker", "theta"]).mapInArrow(_segment_sorted, SEGMENT_DDL)


def state_row(d: Detector, ticker: str, theta: float, period, n_ticks: int) -> dict:
    o = d.orphans()
    return {
        "ticker": ticker, "theta": theta, "period": period, "n_ticks": n_ticks, "n_events": d.n_events, "orphan_start": d.orphan_start(), "current_trend": d.trend, "last_os_ref": d.os_ref,
        "high_price": d.high, "high_time": d.high_time, "low_price": d.low, "low_time": d.low_time, "reference_extreme_price": 0.0, "reference_extreme_time": 0,
        "orphan_price": o.price.tolist(), "orphan_time": o.time.tolist(), "orphan_qty": o.quantity.tolist(), "orphan_dir": o.direction.tolist(),
    }


STATE_SCHEMA = pa.schema([
    ("ticker", pa.string()), ("theta", pa.float64()), ("period", pa.date32()), ("n_ticks", pa.int64()), ("n_events", pa.int64()), ("orphan_start", pa.int64()), ("current_trend", pa.int32()), ("last_os_ref", pa.float64()),
    ("high_price", pa.float64()), ("high_time", pa.int64()), ("low_price", pa.float64()), ("low_time", pa.int64()), ("reference_extreme_price", pa.float64()), ("reference_extreme_time", pa.int64()),
    ("orphan_price", pa.list_(pa.float64())), ("orphan_time", pa.list_(pa.int64())), ("orphan_qty", pa.list_(pa.float64())), ("orphan_dir", pa.list_(pa.int8())),
])


def _end_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    detector, n, ticker, theta, period = None, 0, None, 0.0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if detector is None:
            ticker, theta = batch.column(batch.schema.get_field_index("ticker"))[0].as_py(), batch.column(batch.schema.get_field_index("theta"))[0].as_py()
            detector = Detector(theta)
        detector.feed(_ticks(batch))
        n += batch.num_rows
    if detector is not None:
        detector.finish()
        yield pa.RecordBatch.from_pylist([state_row(detector, ticker, theta, period, n)], STATE_SCHEMA)


def end_state(ticks: DataFrame, thetas: float | Sequence[float]) -> DataFrame:
    """How each (ticker, theta) ends: trend, extremes, and the orphans, the ticks after the open trend's running extreme."""
    many = thetas if isinstance(thetas, Sequence) else [thetas]
    rows = with_thetas(ticks.filter(USABLE), many).select("ticker", "theta", "time", "seq", "price", "quantity", "direction")
    return ordered(rows, ["ticker", "theta"]).groupBy("ticker", "theta").applyInArrow(_end_group, STATE_DDL)
