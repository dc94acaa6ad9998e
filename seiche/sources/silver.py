"""The event table on disk: {base}/ticker=../theta=../year=../month=..[/day=..], zstd, statistics on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seiche.schema import SEGMENT_DDL, format_theta

c = F.col
DAILY, MONTHLY = ["ticker_key", "theta_text", "year", "month", "day"], ["ticker_key", "theta_text", "year", "month"]


def path(base: str, ticker: str, theta: float, year: int, month: int, day: int | None = None) -> str:
    out = f"{base.rstrip('/')}/ticker_key={ticker}/theta_text={format_theta(theta)}/year={year}/month={month:02d}"
    return out if day is None else f"{out}/day={day:02d}"


def write(events: DataFrame, base: str, monthly: bool = False, level: int = 3) -> None:
    """Events with a period, one file for each partition and task; partitions of the data are replaced, others stay."""
    keys = MONTHLY if monthly else DAILY
    text = F.regexp_replace(F.format_string("%.6f", "theta"), r"\.?0+$", "")
    out = events.withColumn("ticker_key", c("ticker")).withColumn("theta_text", text).withColumn("year", F.date_format("period", "yyyy")).withColumn("month", F.date_format("period", "MM"))
    if not monthly:
        out = out.withColumn("day", F.date_format("period", "dd"))
    w = out.repartition(*keys).sortWithinPartitions(*keys, "event_seq").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).partitionBy(*keys).parquet(base)


def is_monthly(spark: SparkSession, base: str) -> bool:
    """Does the table have months without days? Looks at folders only."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/ticker_key=*/theta_text=*/year=*/month=*/*")
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(root)
    names = {x.getPath().getName() for x in found or ()}
    return any(x.endswith(".parquet") for x in names) and not any(x.startswith("day=") for x in names)


def read(spark: SparkSession, base: str, ticker: str | None = None, theta: float | None = None, year: int | None = None, month: int | None = None, day_start: int | None = None, day_end: int | None = None, monthly: bool | None = None) -> DataFrame:
    """Events; what the partitions say is pruned before files are opened, and columns that aren't asked for aren't read.
    monthly: the layout, found by looking at the folders unless it is given. Bounds of days need days."""
    monthly = is_monthly(spark, base) if monthly is None else monthly
    if monthly and (day_start is not None or day_end is not None):
        raise ValueError(f"{base} has months, no days")
    parts = ", ".join(f"{k} string" for k in (MONTHLY if monthly else DAILY))
    df = spark.read.schema(f"{SEGMENT_DDL}, period date, {parts}").parquet(base)
    if ticker is not None:
        df = df.filter(c("ticker_key") == ticker)
    if theta is not None:
        df = df.filter(c("theta_text") == format_theta(theta))
    if year is not None:
        df = df.filter(c("year") == f"{year}")
    if month is not None:
        df = df.filter(c("month") == f"{month:02d}")
    if not monthly and (day_start is not None or day_end is not None):
        df = df.filter(c("day").between(f"{day_start or 1:02d}", f"{day_end or 31:02d}"))
    return df.drop(*(MONTHLY if monthly else DAILY))


def read_dc_events(spark: SparkSession, base: str, ticker: str, year: int, month: int, day_start: int | None = None, day_end: int | None = None, monthly: bool | None = None) -> tuple[DataFrame, float]:
    """Events of a ticker's month or of days of it, and their threshold. None there: FileNotFoundError; several
    thresholds: ValueError."""
    df = read(spark, base, ticker, None, year, month, day_start, day_end, monthly)
    thetas = [r[0] for r in df.select("theta").distinct().limit(2).collect()]
    if not thetas:
        raise FileNotFoundError(f"no events of {ticker} in {year}-{month:02d} at {base}")
    if len(thetas) > 1:
        raise ValueError(f"events of several thresholds: {thetas}")
    return df, thetas[0]


def read_dc_month(spark: SparkSession, base: str, ticker: str, year: int, month: int, monthly: bool | None = None) -> tuple[DataFrame, float]:
    return read_dc_events(spark, base, ticker, year, month, monthly=monthly)


def available_days(spark: SparkSession, base: str, ticker: str, theta: float, year: int, month: int) -> list[dt.date]:
    return [r[0] for r in read(spark, base, ticker, theta, year, month).select("period").distinct().orderBy("period").collect()]


def load_day(spark: SparkSession, base: str, ticker: str, theta: float, day: dt.date) -> DataFrame:
    return read(spark, base, ticker, theta, day.year, day.month, day.day, day.day)


def load_month(spark: SparkSession, base: str, ticker: str, theta: float, year: int, month: int) -> DataFrame:
    """A month with its day, as the checks take it."""
    return read(spark, base, ticker, theta, year, month).withColumn("day", c("period"))
