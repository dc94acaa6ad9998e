"""Tables as ticks: (ticker, seq, time in ns, price, quantity, direction). Order is data: seq breaks ties of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seiche.schema import TICK_COLUMNS


def require(df: DataFrame, columns: list[str]) -> None:
    """At analysis time: a column that isn't there is a ValueError."""
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"columns are missing: {', '.join(missing)}")


def nanoseconds(df: DataFrame, column: str) -> Column:
    """A time column in nanoseconds; whole numbers are taken as nanoseconds already."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp")) * F.lit(1000).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column) * F.lit(1000).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint") * F.lit(86_400_000_000_000).cast("bigint")
    return F.col(column).cast("bigint")


def sign_of_change(partition: list[str], order: list[str], price: str = "price") -> Column:
    """+1 where the price rose or stayed or has no predecessor, -1 where it fell."""
    before = F.lag(price).over(Window.partitionBy(*partition).orderBy(*order))
    return F.when(F.col(price) < before, -1).otherwise(1).cast("tinyint")


def ticks(df: DataFrame, ticker: str | None, time: str, price: str, seq: list[str], quantity: str | None = None, direction: str | None = None, name: str = "") -> DataFrame:
    """df's rows as ticks. seq: columns that order rows of equal time; their rank among all rows of the ticker becomes
    seq. Without a ticker column all rows are of one, `name`. Without quantity 1; without direction the sign of change."""
    require(df, [c for c in (ticker, time, price, quantity, direction, *seq) if c])
    key = F.col(ticker).cast("string") if ticker else F.lit(name)
    out = df.select(key.alias("ticker"), nanoseconds(df, time).alias("time"), F.col(price).cast("double").alias("price"), (F.col(quantity).cast("double") if quantity else F.lit(1.0)).alias("quantity"), *([F.col(direction).cast("tinyint").alias("direction")] if direction else []), *(F.col(c).alias(f"_o{i}") for i, c in enumerate(seq)))
    order = ["time", *(f"_o{i}" for i in range(len(seq)))]
    out = out.withColumn("seq", F.row_number().over(Window.partitionBy("ticker").orderBy(*order)).cast("bigint") - 1)
    if not direction:
        out = out.withColumn("direction", sign_of_change(["ticker"], order))
    return out.select(*TICK_COLUMNS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(table(spark, sf_dir, "events"), "user_id", "ts", "value", ["event_id"])


def events_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(table(spark, sf_dir, "events"), "event_type", "ts", "value", ["event_id"])


def orders_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice", ["o_orderkey"])


def lineitem_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("unit_price", F.col("l_extendedprice") / F.col("l_quantity"))
    return ticks(li, "l_suppkey", "l_shipdate", "unit_price", ["l_orderkey", "l_linenumber"], quantity="l_quantity")


def random_walk(spark: SparkSession, n: int = 1_000_000, sigma: float = 1e-4, start: float = 100.0, step_ns: int = 1_000_000, seed: int = 42, tickers: int = 1) -> DataFrame:
    """A geometric random walk for benchmarks: n ticks for each ticker, made where they are used."""
    import numpy as np
    import pandas as pd

    def walk(it):
        for frame in it:
            for k in frame["id"]:
                r = np.random.default_rng(seed + int(k))
                p = start * np.exp(np.cumsum(r.normal(0, sigma, n)))
                yield pd.DataFrame({"ticker": str(k), "seq": np.arange(n), "time": np.arange(1, n + 1) * step_ns, "price": p, "quantity": 1.0, "direction": np.where(np.diff(p, prepend=p[0]) < 0, -1, 1).astype("int8")})

    return spark.range(0, tickers, 1, tickers).mapInPandas(walk, "ticker string, seq bigint, time bigint, price double, quantity double, direction tinyint")
