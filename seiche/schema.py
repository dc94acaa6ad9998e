"""Schemas of ticks, events and carried state, and how a threshold is written."""

from __future__ import annotations


TICK_COLUMNS = ["ticker", "seq", "time", "price", "quantity", "direction"]

SCALARS = ["event_type", "reference_price", "reference_time", "extreme_price", "extreme_time", "confirm_price", "confirm_time"]
LISTS = ["price_dc", "price_os", "time_dc", "time_os", "qty_dc", "qty_os", "dir_dc", "dir_os"]
EVENT_COLUMNS = SCALARS + LISTS
EVENT_DDL = (
    "event_type tinyint, reference_price double, reference_time bigint, extreme_price double, extreme_time bigint, confirm_price double, confirm_time bigint, "
    "price_dc array<double>, price_os array<double>, time_dc array<bigint>, time_os array<bigint>, qty_dc array<double>, qty_os array<double>, dir_dc array<tinyint>, dir_os array<tinyint>"
)
#: An event with its key, its number within the key, and where its ticks lie in the key's order of ticks.
SEGMENT_DDL = f"ticker string, theta double, event_seq bigint, {EVENT_DDL}, dc_start bigint, dc_end bigint, os_end bigint"
STATE_DDL = (
    "ticker string, theta double, period date, n_ticks bigint, n_events bigint, orphan_start bigint, current_trend int, last_os_ref double, "
    "high_price double, high_time bigint, low_price double, low_time bigint, reference_extreme_price double, reference_extreme_time bigint, "
    "orphan_price array<double>, orphan_time array<bigint>, orphan_qty array<double>, orphan_dir array<tinyint>"
)
#: Extreme price and time of an event whose extreme isn't known yet.
PROVISIONAL = -1


def format_theta(theta: float) -> str:
    """A threshold as partitions name it: six decimals at most, no trailing zeros."""
    return f"{theta:.6f}".rstrip("0").rstrip(".")


def check_theta(theta: float) -> float:
    if not 0 < theta < 1:
        raise ValueError(f"theta must lie between 0 and 1, not {theta}")
    return float(theta)
