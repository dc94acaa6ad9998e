"""Carried state: one row for each (ticker, theta, period) with the orphans, the ticks after the open trend's extreme."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seiche.schema import STATE_DDL, format_theta
from seiche.sources.bronze import require

MAX_LOOKBACK = 7
ORPHANS = ("orphan_price", "orphan_time", "orphan_qty", "orphan_dir")
c = F.col


def empty_state(spark: SparkSession, ticker: str, theta: float, period: dt.date) -> DataFrame:
    return spark.createDataFrame([(ticker, theta, period, 0, 0, 0, 0, 0.0, 0.0, 0, 0.0, 0, 0.0, 0, [], [], [], [])], STATE_DDL)


def extremes(states: DataFrame) -> DataFrame:
    """ext_high and ext_low: the greatest and the least orphan price, 0 without orphans."""
    return states.withColumn("ext_high", F.coalesce(F.array_max("orphan_price"), F.lit(0.0))).withColumn("ext_low", F.coalesce(F.array_min("orphan_price"), F.lit(0.0)))


def memory_bytes() -> Column:
    """Of a state's arrays and scalars: 8 bytes a price, time and quantity, 1 a direction, 48 of scalars."""
    return F.size("orphan_price") * 25 + F.lit(48)


def valid() -> Column:
    """Arrays of one length, a trend of -1, 0 or 1, times that don't fall."""
    n, t = F.size("orphan_price"), c("orphan_time")
    pairs = F.zip_with(F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))), F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda x, y: x <= y)
    return (F.size("orphan_time") == n) & (F.size("orphan_qty") == n) & (F.size("orphan_dir") == n) & c("current_trend").isin(-1, 0, 1) & F.forall(pairs, lambda x: x)


def validate(states: DataFrame) -> DataFrame:
    """The rows that aren't valid."""
    return states.filter(~valid())


def previous(states: DataFrame, wanted: DataFrame, max_lookback: int = MAX_LOOKBACK) -> DataFrame:
    """For each row of wanted (ticker, theta, period) the latest state one to max_lookback days before it: an equi-join on
    the key, bounded in days, and the greatest date. Rows without one are left out."""
    w = wanted.select("ticker", "theta", c("period").alias("wanted"))
    near = states.join(w, ["ticker", "theta"]).filter(c("period").between(F.date_sub("wanted", max_lookback), F.date_sub("wanted", 1)))
    names = [x for x in states.columns if x not in ("ticker", "theta")]
    return near.groupBy("ticker", "theta", "wanted").agg(F.max_by(F.struct(*names), "period").alias("s")).select("ticker", "theta", "wanted", "s.*")


def previous_month(states: DataFrame, year: int, month: int) -> DataFrame:
    """States of exactly the month before."""
    first = dt.date(year, month, 1)
    before = (first - dt.timedelta(days=1)).replace(day=1)
    return states.filter(F.trunc("period", "month") == F.lit(before))


def catalogue(states: DataFrame) -> DataFrame:
    return states.select("ticker", "theta", "period", F.size("orphan_price").alias("n_orphans"), memory_bytes().alias("bytes")).orderBy("ticker", "theta", F.desc("period"))


def stats(states: DataFrame) -> DataFrame:
    return states.groupBy("ticker", "theta").agg(F.count("*").alias("n_states"), F.sum(memory_bytes()).alias("bytes"), F.min("period").alias("first"), F.max("period").alias("last"))


def retired(states: DataFrame, keep_last: int = 1) -> DataFrame:
    """States beyond the keep_last latest of their key: what a clean-up deletes."""
    w = Window.partitionBy("ticker", "theta").orderBy(F.desc("period"))
    return states.withColumn("_n", F.row_number().over(w)).filter(c("_n") > keep_last).drop("_n")


def _dealt(states: DataFrame) -> DataFrame:
    return states.withColumn("theta_text", F.regexp_replace(F.format_string("%.6f", "theta"), r"\.?0+$", "")).withColumn("period_text", c("period").cast("string"))


def save(states: DataFrame, path: str) -> None:
    """Checked, then written by key and period; a period that is written again is replaced."""
    if bad := validate(states).limit(1).collect():
        raise ValueError(f"state of {bad[0]['ticker']} at {bad[0]['period']} is not valid")
    _dealt(states).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("theta_text", "period_text").parquet(path)


#: What a stored state must have; anything else is 0, and the period today's date, where it isn't there.
NEEDED = ("ticker", "theta", "current_trend", *ORPHANS)


def state_path(base: str, theta: float, period: dt.date) -> str:
    return f"{base.rstrip('/')}/theta_text={format_theta(theta)}/period_text={period.isoformat()}"


def load(spark: SparkSession, path: str, ticker: str | None = None, theta: float | None = None) -> DataFrame:
    """Stored states. Columns that must be there and aren't: ValueError; others get 0 (the period: today)."""
    restore(spark, path)
    there = spark.read.option("mergeSchema", "true").parquet(path).columns
    require(spark.createDataFrame([], ", ".join(f"`{x}` int" for x in there)), list(NEEDED))
    df = spark.read.schema(f"{STATE_DDL}, theta_text string, period_text string").parquet(path)
    today = {f.name: (F.current_date() if f.name == "period" else F.lit(0).cast(f.dataType)) for f in T.StructType.fromDDL(STATE_DDL).fields if f.name not in NEEDED}
    df = df.withColumns({k: F.coalesce(F.col(k), v) for k, v in today.items()})
    if ticker is not None:
        df = df.filter(c("ticker") == ticker)
    if theta is not None:
        df = df.filter(c("theta_text") == format_theta(theta))
    return df.drop("theta_text", "period_text")


def cleanup(spark: SparkSession, path: str, keep_last: int = 1, dry_run: bool = True) -> list[tuple]:
    """The states that go (ticker, theta, period), at most as many as there are states; unless dry_run, the table is left
    with the others. What stays is written beside the table first and takes its place by renaming; the table before is kept
    as a backup until then, and restore() brings it back if a run ends between the two."""
    states = load(spark, path)
    gone = [tuple(r) for r in retired(states, keep_last).select("ticker", "theta", "period").orderBy("ticker", "theta", "period").collect()]
    if gone and not dry_run:
        kept = states.join(retired(states, keep_last).select("ticker", "theta", "period"), ["ticker", "theta", "period"], "left_anti")
        staged = f"{path.rstrip('/')}.staged"
        _dealt(kept).write.mode("overwrite").partitionBy("theta_text", "period_text").parquet(staged)
        fs, of = _files(spark, path)
        fs.delete(of(f"{path.rstrip('/')}.backup"), True)
        if not (fs.rename(of(path), of(f"{path.rstrip('/')}.backup")) and fs.rename(of(staged), of(path))):
            restore(spark, path)
            raise OSError(f"{path} could not be replaced")
        fs.delete(of(f"{path.rstrip('/')}.backup"), True)
    return gone


def _files(spark: SparkSession, path: str):
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def restore(spark: SparkSession, path: str) -> bool:
    """Put the backup in the table's place if a clean-up ended before it had replaced it. True if that was so."""
    fs, of = _files(spark, path)
    backup = f"{path.rstrip('/')}.backup"
    if fs.exists(of(backup)) and not fs.exists(of(path)):
        return bool(fs.rename(of(backup), of(path)))
    return False
