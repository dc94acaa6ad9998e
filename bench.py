"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from seiche.functions.indicators import create_registry
from seiche.functions.quality import check
from seiche.operators.kernel import Ticks, detect
from seiche.operators.segment import segment
from seiche.plans import analysis
from seiche.sources import bronze

THETAS = [0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    tmp = tempfile.mkdtemp()
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"{tmp}/checkpoints").config("spark.sql.warehouse.dir", f"{tmp}/warehouse").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    out: dict[str, float] = {}

    def timed(name: str, run, repeat: int = 3) -> None:
        run(), run()
        took = []
        for _ in range(repeat):
            began = time.time()
            run()
            took.append(time.time() - began)
        out[name] = round(statistics.median(took), 3)

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    users, orders = bronze.events_by_user(spark, sf).cache(), bronze.orders_by_priority(spark, sf).cache()
    n_users, n_orders = users.count(), orders.count()
    walk, walks = bronze.random_walk(spark, 1_000_000).cache(), bronze.random_walk(spark, 1_000_000, tickers=8).cache()
    walk.count(), walks.count()
    # the detector alone, on one core: the protocol of the published kernel figure
    r = np.random.default_rng(42)
    price = 100.0 * np.exp(np.cumsum(r.normal(0, 1e-4, 1_000_000)))
    series = Ticks(price, np.arange(1, len(price) + 1) * 1_000_000, np.ones(len(price)), np.ones(len(price), np.int8))
    timed("kernel_walk_1m", lambda: detect(series, 0.005), repeat=5)
    timed("segment_events", lambda: noop(segment(users, 0.5)))
    timed("segment_orders", lambda: noop(segment(orders, 0.5)))
    timed("segment_walk_1m", lambda: noop(segment(walk, 0.005)))
    timed("segment_walk_8x1m", lambda: noop(segment(walks, 0.005)))
    timed("theta_sweep_10", lambda: noop(analysis.coastline(segment(users, THETAS), ["ticker"])))
    events = segment(users, 0.5).cache()
    events.count()
    timed("gold_29_indicators", lambda: noop(create_registry(0.5).compute(events)))
    timed("quality_40_checks", lambda: check(analysis.with_day(events), 0.5).agg(F.count("*")).collect())
    timed("scale_profile", lambda: noop(analysis.scale_profile(analysis.with_day(events))))
    rates = {"segment_events": n_users, "segment_orders": n_orders, "segment_walk_1m": 1_000_000, "segment_walk_8x1m": 8_000_000, "kernel_walk_1m": 1_000_000}
    print(json.dumps({"metric": "total of medians", "value": round(sum(out.values()), 3), "unit": "sec", "queries": out, "ticks_per_second": {k: round(n / out[k]) for k, n in rates.items()}, "sf": sf}))


if __name__ == "__main__":
    main()
