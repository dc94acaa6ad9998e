"""Charts of events as SVG, a page of them, and a server of pages.

Spark reduces what is drawn to a bounded number of marks (windows, cells, bins, runs); only those come to the driver. A
frame that holds more marks than a chart takes is an error that says so: nothing is left out of a chart in silence.
"""

from __future__ import annotations

import html
import math
from datetime import UTC, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from seiche.plans import analysis

#: Marks in a chart at most; cells of a rasterised panel; labelled events in a panel.
MOST_MARKS, CELLS, MARKERS = 20_000, (300, 80), 30
COLOURS = {"Upward": "#8fd19e", "Downward": "#f1a9a0", "Upturn": "#1e8449", "Downturn": "#b03a2e", "Neutral": "#95a5a6"}
UP, DOWN, INK, FAINT = COLOURS["Upturn"], COLOURS["Downturn"], "#2c3e50", "#dfe4ea"


def bounded(df: DataFrame, most: int = MOST_MARKS) -> list[Row]:
    """All rows of a frame of at most `most` rows; an error if there are more."""
    got = df.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"a chart takes {most} marks at most: choose a smaller window or reduce the frame")
    return got


def steps(low: float, high: float, n: int = 6) -> list[float]:
    """About n round values from low to high."""
    if not high > low:
        return [low]
    raw = (high - low) / n
    base = 10.0 ** math.floor(math.log10(raw))
    step = base * next(k for k in (1, 2, 5, 10) if k * base >= raw * 0.999)
    return [k * step for k in range(math.ceil(low / step - 1e-9), math.floor(high / step + 1e-9) + 1)]


def _clock(ns: float) -> str:
    return datetime.fromtimestamp(ns / 1e9, UTC).strftime("%m-%d %H:%M")


class Panel:
    """A plot area. x and y: from, to. log: both axes are logarithmic; time: x is in ns."""

    def __init__(self, title: str, x: tuple[float, float], y: tuple[float, float], width: int = 860, height: int = 300, log: bool = False, time: bool = False):
        self.title, self.width, self.height, self.log, self.time = title, width, height, log, time
        self.x, self.y = (self._wide(*r) for r in (x, y))
        self.marks: list[str] = []

    def _wide(self, a: float, b: float) -> tuple[float, float]:
        a, b = (math.log10(a), math.log10(b)) if self.log else (float(a), float(b))
        return (a, b) if b > a else (a - 0.5, b + 0.5)

    def at(self, x: float, y: float) -> tuple[float, float]:
        if self.log:
            x, y = math.log10(x), math.log10(y)
        left, top, w, h = 70, 30, self.width - 90, self.height - 65
        return left + w * (x - self.x[0]) / (self.x[1] - self.x[0]), top + h * (1 - (y - self.y[0]) / (self.y[1] - self.y[0]))

    def _text(self, x: float, y: float, text: str, anchor: str = "middle", size: int = 11) -> str:
        return f'<text x="{x:.1f}" y="{y:.1f}" font-size="{size}" text-anchor="{anchor}" fill="{INK}">{html.escape(text)}</text>'

    def line(self, points: list[tuple[float, float]], colour: str = INK, width: float = 1.2, dash: str = "") -> None:
        at = " ".join(f"{a:.1f},{b:.1f}" for a, b in (self.at(*p) for p in points))
        self.marks.append(f'<polyline points="{at}" fill="none" stroke="{colour}" stroke-width="{width}" stroke-dasharray="{dash}"/>')

    def dot(self, x: float, y: float, colour: str, label: str = "", radius: float = 3.0) -> None:
        a, b = self.at(x, y)
        self.marks.append(f'<circle cx="{a:.1f}" cy="{b:.1f}" r="{radius}" fill="{colour}"><title>{html.escape(label)}</title></circle>')

    def box(self, x0: float, y0: float, x1: float, y1: float, colour: str, opacity: float = 1.0, label: str = "") -> None:
        (a0, b1), (a1, b0) = self.at(x0, y0), self.at(x1, y1)
        self.marks.append(f'<rect x="{a0:.1f}" y="{b0:.1f}" width="{max(a1 - a0, 0.8):.1f}" height="{max(b1 - b0, 0.8):.1f}" fill="{colour}" fill-opacity="{opacity:.2f}"><title>{html.escape(label)}</title></rect>')

    def rule(self, x: float, label: str, dash: str = "4 3") -> None:
        low, high = ((10**v for v in self.y) if self.log else self.y)
        self.line([(x, low), (x, high)], INK, 0.8, dash)
        a, b = self.at(x, high)
        self.marks.append(self._text(a + 3, b + 10, label, "start", 10))

    def svg(self) -> str:
        back = lambda v: 10**v if self.log else v
        grid = []
        for v in steps(*self.x):
            a, b = self.at(back(v), back(self.y[0]))
            grid.append(f'<line x1="{a:.1f}" y1="30" x2="{a:.1f}" y2="{b:.1f}" stroke="{FAINT}"/>' + self._text(a, b + 16, _clock(v) if self.time else f"{back(v):.6g}"))
        for v in steps(*self.y, 5):
            a, b = self.at(back(self.x[0]), back(v))
            grid.append(f'<line x1="{a:.1f}" y1="{b:.1f}" x2="{self.width - 20}" y2="{b:.1f}" stroke="{FAINT}"/>' + self._text(a - 6, b + 4, f"{back(v):.6g}", "end"))
        return f'<svg xmlns="http://www.w3.org/2000/svg" width="{self.width}" height="{self.height}" font-family="sans-serif">{self._text(self.width / 2, 18, self.title, size=14)}{"".join(grid)}{"".join(self.marks)}</svg>'


def _empty(title: str) -> Panel:
    p = Panel(title, (0, 1), (0, 1))
    p.marks.append(p._text(p.width / 2, p.height / 2, "no data"))
    return p


def _bars(title: str, rows: list[Row], bins: int, colour) -> Panel:
    """Histogram rows (bin, n, low, high), side by side where a bin has several."""
    if not rows:
        return _empty(title)
    low, high = rows[0]["low"], rows[0]["high"]
    step = (high - low) / bins or 1.0
    p = Panel(title, (low, low + step * bins), (0, max(r["n"] for r in rows)))
    kinds = sorted({colour(r) for r in rows})
    for r in rows:
        k = kinds.index(colour(r))
        at = low + step * (r["bin"] + k / len(kinds))
        p.box(at, 0, at + step / len(kinds) * 0.92, r["n"], colour(r), 0.85, f"{r['n']}")
    return p


def returns_chart(events: DataFrame, bins: int = 24) -> Panel:
    """Histogram of the changes' returns, upturns beside downturns."""
    value = F.try_divide(F.col("confirm_price") - F.col("reference_price"), F.col("reference_price"))
    return _bars("Returns of directional changes", bounded(analysis.histogram(events, value, bins, "event_type")), bins, lambda r: UP if r["event_type"] == 1 else DOWN)


def durations_chart(events: DataFrame, bins: int = 30, phase: str = "dc") -> Panel:
    """Histogram of the seconds of a phase, with their mean."""
    rows = bounded(analysis.durations(events, bins, phase))
    p = _bars(f"Seconds of {'changes' if phase == 'dc' else 'overshoots'}", rows, bins, lambda r: INK)
    if rows:
        p.rule(rows[0]["mean"], f"mean {rows[0]['mean']:.4g}")
    return p


def coastline_chart(events: DataFrame) -> Panel:
    """The coastline of each threshold of one ticker on logarithmic axes, with the line fitted to more than two."""
    lengths = analysis.coastline(events, ["ticker"])
    rows = sorted((r["theta"], r["coastline"]) for r in bounded(lengths) if r["coastline"] and r["coastline"] > 0)
    if not rows:
        return _empty("Coastline")
    p = Panel("Coastline", (rows[0][0], rows[-1][0]), (min(v for _, v in rows), max(v for _, v in rows)), log=True)
    for fit in bounded(analysis.coastline_fit(lengths, ["ticker"]), 1):
        p.title += f", slope {fit['slope']:.3f}"
        p.line([(t, math.exp(fit["intercept"] + fit["slope"] * math.log(t))) for t, _ in rows], DOWN, dash="5 4")
    for t, v in rows:
        p.dot(t, v, INK, f"{t:g}: {v:.6g}")
    return p


def trend_chart(events: DataFrame) -> Panel:
    """Runs of events of one type over the event numbers of one key."""
    rows = bounded(analysis.trend_runs(events))
    if not rows:
        return _empty("Trend runs")
    p = Panel("Trend runs", (min(r["first"] for r in rows), max(r["last"] for r in rows) + 1), (-1, 1), height=140)
    for r in rows:
        p.box(r["first"], min(0, r["event_type"]), r["last"] + 1, max(0, r["event_type"]), UP if r["event_type"] == 1 else DOWN, 0.8, f"{r['n']} events from {r['first']}")
    return p


def dual_axis(events: DataFrame, start: int, end: int) -> tuple[Panel, Panel]:
    """One key's events that are confirmed from start to end (ns), on physical time (cells of its ticks by phase, boxes of
    change and overshoot, midnights and noons) and on intrinsic time (event numbers). Both share their prices' limits."""
    own = analysis.time_window(events, start, end, "confirm_time", most_hours=max(1, -(-(end - start) // 3_600_000_000_000)))
    limits = bounded(analysis.y_limits(own), 1)
    if not limits:
        return _empty("Physical time"), _empty("Intrinsic time")
    y = limits[0]["y0"], limits[0]["y1"]
    top = Panel("Physical time", (start, end), y, time=True)
    phases = analysis.tick_phases(own, own)
    inside = phases.filter(F.col("time").between(start, end) & F.col("price").between(*y)).withColumn("status", analysis.status(F.col("dc_interval_type")))
    w, h = CELLS
    # the number of cells bounds what comes back, whatever the number of ticks
    cells = bounded(analysis.raster(inside, "time", "price", "status", w, h, (float(start), float(end), *y)), w * h * len(COLOURS))
    most = max((r["n"] for r in cells), default=1)
    dx, dy = (end - start) / w, (y[1] - y[0]) / h
    for r in cells:
        top.box(start + r["px"] * dx, y[0] + r["py"] * dy, start + (r["px"] + 1) * dx, y[0] + (r["py"] + 1) * dy, COLOURS[r["status"]], 0.3 + 0.7 * r["n"] / most, f"{r['n']} ticks, {r['status']}")
    times = own.select("event_seq", "reference_time", "confirm_time", "extreme_time")
    for b in bounded(analysis.boxes(own).join(times, "event_seq")):
        a, z = (b["reference_time"], b["confirm_time"]) if b["phase"] == "change" else (b["confirm_time"], b["extreme_time"])
        top.box(max(a, start), b["y0"], min(z, end), b["y1"], INK if b["phase"] == "change" else COLOURS["Neutral"], 0.15, f"{b['phase']} {b['event_seq']}: {b['dp']:.6g} in {b['label']}")
    for m in bounded(analysis.day_markers(own)):
        top.rule(m["time"], m["marker"])
    rows = sorted(bounded(analysis.event_projection(own)), key=lambda r: r["event_idx"])
    low = Panel("Intrinsic time", (rows[0]["event_idx"], rows[-1]["event_idx"] + 1), y)
    known = [r for r in rows if r["ext_price"] != -1.0]
    low.line([(r["event_idx"] + 0.5, r["ext_price"]) for r in known], COLOURS["Neutral"])
    every = math.ceil(len(rows) / MARKERS)
    for k, r in enumerate(rows):
        low.dot(r["event_idx"], r["price"], UP if r["type_desc"] == "Upturn" else DOWN, f"{r['type_desc']} {r['event_idx']} at {_clock(r['time'])}: {r['price']:.6g}", 4.0 if k % every == 0 else 2.0)
    return top, low


def page(title: str, panels: list[Panel]) -> str:
    """Panels one below the other, as a page that needs no other file."""
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title></head><body style="font-family:sans-serif"><h1 style="font-size:18px">{html.escape(title)}</h1>{"".join(f"<div>{p.svg()}</div>" for p in panels)}</body></html>'


def dashboard(events: DataFrame, ticker: str, theta: float, first: float | None = None, last: float | None = None) -> str:
    """The page of one key: both axes over the events numbered first to last (by default a day from the first
    confirmation), trend runs there, and histograms of all its events; the coastline over all thresholds of the ticker."""
    mine = events.filter(F.col("ticker") == ticker)
    own = mine.filter(F.col("theta") == theta)
    title = f"{ticker}, theta {theta:g}"
    if first is None or last is None:
        start = own.agg(F.min("confirm_time")).first()[0]
        end = None if start is None else start + analysis.DEFAULT_HOURS * 3_600_000_000_000
    else:
        chosen = bounded(analysis.event_range(own, *analysis.rounded_range(first, last)), 1)
        start, end = (chosen[0]["start"], chosen[0]["end"]) if chosen else (None, None)
    if start is None:
        return page(title, [_empty("No events")])
    shown = own.filter(F.col("confirm_time").between(start, end))
    return page(title, [*dual_axis(own, start, end), trend_chart(shown), returns_chart(own), durations_chart(own), durations_chart(own, phase="os"), coastline_chart(mine)])


def server(events: DataFrame, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """Serves /?ticker=...&theta=...&first=...&last=... as dashboards (call serve_forever). events should be a written
    table. A request without a key gets the list of keys."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            code = 200
            try:
                if "ticker" in q and "theta" in q:
                    body = dashboard(events, q["ticker"], float(q["theta"]), *(float(q[k]) if k in q else None for k in ("first", "last")))
                else:
                    body = "<br>".join(html.escape(f"{r['ticker']} {r['theta']:g}") for r in bounded(events.select("ticker", "theta").distinct().orderBy("ticker", "theta")))
            except ValueError as e:
                code, body = 400, html.escape(str(e))
            raw = body.encode()
            self.send_response(code)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *args) -> None:
            return

    return ThreadingHTTPServer((host, port), Handler)
