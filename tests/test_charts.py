import threading
import urllib.error
import urllib.request
import xml.etree.ElementTree as ET

import pytest

from seiche.operators.segment import segment
from seiche.plans import analysis, charts

DAY = 86_400_000_000_000


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    prices = [100 + 6 * ((k * 7919) % 23) / 23 + (k % 5) for k in range(400)]
    rows = [(t, k, 20_000 * DAY + k * DAY // 200, p * (1 + (t == "b") * 0.01)) for t in ("a", "b") for k, p in enumerate(prices)]
    ticks = spark.createDataFrame(rows, "ticker string, seq bigint, time bigint, price double").selectExpr("ticker", "seq", "time", "price", "1.0D AS quantity", "1Y AS direction")
    path = str(tmp_path_factory.mktemp("events") / "e")
    segment(ticks, [0.01, 0.02, 0.03]).write.parquet(path)
    return spark.read.parquet(path)


def drawn(page: str) -> list[ET.Element]:
    return [ET.fromstring("<svg" + x.split("</svg>")[0] + "</svg>") for x in page.split("<svg")[1:]]


def marks(svg: ET.Element, tag: str) -> list[ET.Element]:
    return [x for x in svg if x.tag.endswith(tag)]


def test_dashboard(events):
    own = events.filter("ticker = 'a' AND theta = 0.02")
    n = own.count()
    physical, intrinsic, trend, returns, dc, os_, coast = drawn(charts.dashboard(events, "a", 0.02, 0, n))
    # the range begins at the first event's extreme
    start, end = analysis.event_range(own, 0, n).select("start", "end").first()
    shown = own.filter(f"confirm_time BETWEEN {start} AND {end}")
    seen = shown.count()
    assert 0 < seen < n
    assert len(marks(intrinsic, "circle")) == seen
    assert sum(int(x[0].text.split()[0]) for x in marks(trend, "rect")) == seen
    assert sum(int(x[0].text) for x in marks(returns, "rect")) == n
    assert sum(int(x[0].text) for x in marks(dc, "rect")) == n
    assert len(marks(coast, "circle")) == 3 and "slope" in coast[0].text
    cells = [x for x in marks(physical, "rect") if "ticks" in x[0].text]
    inside = analysis.tick_phases(shown, shown).filter(f"time BETWEEN {start} AND {end}").count()
    assert sum(int(x[0].text.split()[0]) for x in cells) == inside
    assert any(x.text in ("noon", "midnight") for x in marks(physical, "text"))
    for svg in (physical, intrinsic, trend, returns, dc, os_, coast):
        w, h = float(svg.get("width")), float(svg.get("height"))
        assert all(0 <= float(x.get("x")) <= w and 0 <= float(x.get("y")) <= h for x in marks(svg, "rect"))


def test_default_is_a_day(events):
    start = events.filter("ticker = 'b' AND theta = 0.01").agg({"confirm_time": "min"}).first()[0]
    n = events.filter(f"ticker = 'b' AND theta = 0.01 AND confirm_time BETWEEN {start} AND {start + DAY}").count()
    assert 0 < n < events.filter("ticker = 'b' AND theta = 0.01").count()
    assert len(marks(drawn(charts.dashboard(events, "b", 0.01))[1], "circle")) == n


def test_no_events_and_names(events):
    page = charts.dashboard(events, "<none>", 0.02)
    assert "&lt;none&gt;" in page and "<none>" not in page and "no data" in page
    assert "no data" in charts.dashboard(events, "a", 0.02, 10**6, 10**6 + 1)


def test_too_many_marks(events):
    with pytest.raises(ValueError, match="5 marks"):
        charts.bounded(events, 5)
    assert len(charts.bounded(events.limit(5), 5)) == 5


def test_steps():
    assert charts.steps(0, 10, 5) == [0, 2, 4, 6, 8, 10]
    assert charts.steps(3, 3) == [3]


def test_server(events):
    s = charts.server(events)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{s.server_address[1]}/"
    try:
        assert urllib.request.urlopen(at).read().decode().count("<br>") == 5
        assert urllib.request.urlopen(at + "?ticker=a&theta=0.02&first=0.2&last=3.8").read().decode().count("<svg") == 7
        with pytest.raises(urllib.error.HTTPError):
            urllib.request.urlopen(at + "?ticker=a&theta=x")
    finally:
        s.shutdown()
        s.server_close()
