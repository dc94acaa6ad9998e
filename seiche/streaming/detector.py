"""Directional changes of a stream of ticks, as a stateful operator.

A key's open instant and open event are its state. Events come out when they are settled, that is when the next one is
confirmed; ticks older than the key's last finished instant are dropped and counted.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seiche.operators.kernel import Detector, Ticks
from seiche.schema import check_theta

OUT = "ticker string, event_seq bigint, event_type int, reference_price double, reference_time bigint, extreme_price double, extreme_time bigint, confirm_price double, confirm_time bigint, n_dc int, n_os int, late_ticks bigint"


def settled_events(ticks: DataFrame, theta: float) -> DataFrame:
    """A streaming frame of ticks (ticker, seq, time, price, quantity, direction) to its settled events. Within a
    micro-batch ticks are put in order; across batches a key's ticks must not go back in time."""
    check_theta(theta)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        detector, n, late = pickle.loads(state.get[0]) if state.exists else (Detector(theta), 0, 0)
        rows = pd.concat(list(frames)).sort_values(["time", "seq"], kind="stable")
        if len(detector.kept):
            fresh = rows["time"] >= detector.kept.time[-1]
            late += int((~fresh).sum())
            rows = rows[fresh]
        t = Ticks(rows["price"].to_numpy(float), rows["time"].to_numpy(np.int64), rows["quantity"].to_numpy(float), rows["direction"].to_numpy(np.int8))
        found = detector.feed(t)
        state.update((pickle.dumps((detector, n + len(found), late)),))
        yield pd.DataFrame([(key[0], n + i, e.kind, e.reference_price, e.reference_time, e.extreme_price, e.extreme_time, e.confirm_price, e.confirm_time, len(e.change), len(e.overshoot), late) for i, e in enumerate(found)], columns=[x.split()[0] for x in OUT.split(", ")])

    rows = ticks.select("ticker", "seq", "time", "price", "quantity", F.col("direction").cast("int").alias("direction"))
    return rows.groupBy("ticker").applyInPandasWithState(step, OUT, "detector binary", "append", GroupStateTimeout.NoTimeout)
