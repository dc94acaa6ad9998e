"""Directional changes of one series of ticks.

A Detector is fed ticks in order, in blocks of any size, and gives the events that are settled: the same events for any
cut into blocks. It goes from confirmation to confirmation: within a trend only its own extreme and the opposite test
matter, so the next confirmation is the first price beyond the running extreme's threshold, found on whole blocks at
once. What it keeps is the ticks since the last event's reference, not the series. A tick whose price isn't a number is no
tick.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

FIRST_REACH = 64
FIELDS = ("price", "time", "quantity", "direction")


@dataclass
class Ticks:
    price: np.ndarray
    time: np.ndarray
    quantity: np.ndarray
    direction: np.ndarray

    @classmethod
    def none(cls) -> "Ticks":
        return cls(np.empty(0), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int8))

    def __len__(self) -> int:
        return len(self.price)

    def __getitem__(self, s: slice) -> "Ticks":
        return Ticks(self.price[s], self.time[s], self.quantity[s], self.direction[s])

    def then(self, other: "Ticks") -> "Ticks":
        if not len(self):
            return other
        return Ticks(*(np.concatenate((getattr(self, k), getattr(other, k))) for k in FIELDS))

    def numbers(self) -> "Ticks":
        """Without the ticks whose price isn't a number."""
        ok = self.price == self.price
        return self if ok.all() else Ticks(*(getattr(self, k)[ok] for k in FIELDS))


class Tail:
    """The last of the ticks that were added, in arrays with room to grow: adding costs what is added, not what is there.
    What was handed out stays as it is, since rows are written once."""

    def __init__(self) -> None:
        self.rows, self.start, self.end = Ticks.none(), 0, 0

    def add(self, block: Ticks) -> None:
        n = self.end - self.start
        if self.end + len(block) > len(self.rows):
            grown = []
            for k in FIELDS:
                a = np.empty(2 * (n + len(block)), getattr(block, k).dtype)
                a[:n] = getattr(self.rows, k)[self.start : self.end]
                grown.append(a)
            self.rows, self.start, self.end = Ticks(*grown), 0, n
        for k in FIELDS:
            getattr(self.rows, k)[self.end : self.end + len(block)] = getattr(block, k)
        self.end += len(block)

    def view(self) -> Ticks:
        return self.rows[self.start : self.end]

    def forget(self, n: int) -> None:
        self.start += n


@dataclass
class Event:
    """Places count from the first tick ever fed. The change is the ticks from reference + 1 to confirm, the overshoot
    those from confirm + 1 to end."""

    kind: int
    reference: int
    confirm: int
    reference_price: float
    reference_time: int
    confirm_price: float
    confirm_time: int
    change: Ticks = field(default_factory=Ticks.none)
    end: int = -1
    extreme_price: float = -1.0
    extreme_time: int = -1
    overshoot: Ticks = field(default_factory=Ticks.none)


class Detector:
    """theta: the relative reversal. trend, high, low: carried in from before, 0 if there is nothing; a carried extreme has
    the place of the first tick until a tick exceeds it. with_orphans: orphans() is wanted, so all ticks are kept as long as
    there is no event; else only those since the earlier of the two extremes."""

    def __init__(self, theta: float, trend: int = 0, high: float = 0.0, low: float = 0.0, os_ref: float = 0.0, with_orphans: bool = True):
        self.with_orphans, self.tail = with_orphans, Tail()
        self.up, self.down = 1.0 + theta, 1.0 - theta
        self.trend, self.high, self.low, self.os_ref = trend, high, low, os_ref
        self.high_at = self.low_at = 0
        self.high_time = self.low_time = -1
        self.kept = Ticks.none()
        self.base = 0  # place of the first kept tick
        self.at = 0  # place of the next tick to look at
        self.ready = 0  # places below this belong to whole instants
        self.opposite_from = 0  # ticks from here on haven't moved the extreme that the trend doesn't test
        self.open: Event | None = None
        self.n_events = 0

    # -- feeding

    def feed(self, block: Ticks) -> list[Event]:
        """Take ticks; the last instant waits until a later one shows that it is over."""
        block = block.numbers()
        if not len(block):
            return []
        if not self.base and not len(self.kept):
            self.high = self.high if self.high > 0 else float(block.price[0])
            self.low = self.low if self.low > 0 else float(block.price[0])
        self.tail.add(block)
        self.kept = self.tail.view()
        self.ready = self.base + self._last_instant()
        out = self._look()
        self._forget()
        return out

    def _last_instant(self) -> int:
        """Where among the kept ticks the last instant begins."""
        time, end, reach = self.kept.time, len(self.kept), FIRST_REACH
        while end:
            start = max(0, end - reach)
            other = np.flatnonzero(time[start:end] != time[-1])
            if len(other):
                return start + int(other[-1]) + 1
            end, reach = start, reach * 4
        return 0

    def finish(self) -> list[Event]:
        """No more ticks: look at the last instant; the last event gets all that is left and stays provisional."""
        self.ready = self.base + len(self.kept)
        out = self._look()
        self._track_opposite()
        if self.open is not None:
            e = self.open
            e.end = self.base + len(self.kept) - 1
            e.overshoot = self._slice(e.confirm + 1, e.end)
            out.append(e)
        return out

    def orphans(self) -> Ticks:
        """After finish: the ticks after the running extreme of the open trend; all that are kept when there was no event."""
        return self._slice(self.orphan_start(), self.base + len(self.kept) - 1)

    def orphan_start(self) -> int:
        if not self.n_events:
            return 0
        return (self.high_at if self.trend == 1 else self.low_at) + 1

    # -- looking

    def _slice(self, first: int, last: int) -> Ticks:
        return self.kept[max(0, first - self.base) : max(0, last + 1 - self.base)]

    def _forget(self) -> None:
        """Ticks before the last event's reference are settled; without an event, those before both extremes, unless they are orphans."""
        if self.n_events:
            least = min(self.open.reference, self.at)
        elif self.with_orphans:
            return
        else:
            least = min(self.high_at, self.low_at, self.at)
        if least - self.base > 4096:
            self.tail.forget(least - self.base)
            self.kept, self.base = self.tail.view(), least

    def _look(self) -> list[Event]:
        out: list[Event] = []
        while (hit := self._next()) is not None:
            if (e := self._confirm(*hit)) is not None:
                out.append(e)
        return out

    def _next(self) -> tuple[int, int] | None:
        """The place of the next reversal and the new trend; extremes are moved up to and including that place."""
        reach = FIRST_REACH
        while self.at < self.ready:
            a = self.at - self.base
            p = self.kept.price[a : min(a + reach, self.ready - self.base)]
            high = low = None
            if self.trend >= 0:
                high = np.maximum(np.maximum.accumulate(p), self.high)
            if self.trend <= 0:
                low = np.minimum(np.minimum.accumulate(p), self.low)
            ups = p >= low * self.up if low is not None else None
            downs = p <= high * self.down if high is not None else None
            any_ = ups if downs is None else downs if ups is None else ups | downs
            k = int(any_.argmax())
            found = bool(any_[k])
            n = k + 1 if found else len(p)
            if high is not None and high[n - 1] > self.high:
                self.high_at, self.high = self.at + int(p[:n].argmax()), float(high[n - 1])
            if low is not None and low[n - 1] < self.low:
                self.low_at, self.low = self.at + int(p[:n].argmin()), float(low[n - 1])
            self.at += n
            if found:
                return self.at - 1, 1 if ups is not None and ups[k] else -1
            reach *= 4
        return None

    def _confirm(self, at: int, trend: int) -> Event | None:
        times = self.kept.time
        a = at - self.base
        last = a
        while last + 1 < len(times) and times[last + 1] == times[a]:
            last += 1
        p = self.kept.price[a : last + 1]
        if trend == 1:
            extreme, price = self.low_at, float(p[p >= self.low * self.up].min())
        else:
            extreme, price = self.high_at, float(p[p <= self.high * self.down].max())
        confirm = self.base + last
        self.trend, self.os_ref = trend, price
        if trend == 1:
            self.high, self.high_at = price, confirm
        else:
            self.low, self.low_at = price, confirm
        self.opposite_from = at + 1
        if extreme >= confirm:
            return None  # the instant turned on itself: no event
        x = extreme - self.base
        closed = self.open
        if closed is not None:
            closed.extreme_price, closed.extreme_time, closed.end = float(self.kept.price[x]), int(times[x]), max(extreme, closed.confirm)
            closed.overshoot = self._slice(closed.confirm + 1, extreme)
        self.open = Event(trend, extreme, confirm, float(self.kept.price[x]), int(times[x]), price, int(times[last]), self._slice(extreme + 1, confirm))
        self.n_events += 1
        return closed

    def _track_opposite(self) -> None:
        """The extreme that the trend doesn't test, moved over the ticks since the trend began; then both extremes' times."""
        p = self.kept.price[max(0, self.opposite_from - self.base) : self.at - self.base]
        first = max(self.opposite_from, self.base)
        if len(p) and self.trend == 1 and p.min() < self.low:
            self.low, self.low_at = float(p.min()), first + int(p.argmin())
        if len(p) and self.trend == -1 and p.max() > self.high:
            self.high, self.high_at = float(p.max()), first + int(p.argmax())
        time = lambda at: int(self.kept.time[at - self.base]) if len(self.kept) and at >= self.base else -1
        self.high_time, self.low_time = time(self.high_at), time(self.low_at)


def detect(ticks: Ticks, theta: float, trend: int = 0, high: float = 0.0, low: float = 0.0) -> tuple[list[Event], Detector]:
    """All events of a whole series, the last one provisional, and the detector as it ended."""
    d = Detector(theta, trend, high, low)
    out = d.feed(ticks)
    return out + d.finish(), d


def estimate_memory(n_ticks: int, theta: float) -> dict[str, float]:
    """Bytes that a series of ticks and its events take: 25 for a tick in, the same out for each phase it is in."""
    events = max(n_ticks // 1000, 64) * 3
    return {"n_ticks": n_ticks, "theta": theta, "events": events, "input_mb": n_ticks * 25 / 1e6, "lists_mb": n_ticks * 25 / 1e6, "events_mb": events * 49 / 1e6}
