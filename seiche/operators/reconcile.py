"""What the first tick of a period says about the open event of the period before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seiche.operators.state import extremes

NONE, CONFIRM_REVERSAL, EXTEND_OS = "none", "confirm_reversal", "extend_os"
c = F.col


def decide(states: DataFrame, first_ticks: DataFrame) -> DataFrame:
    """states joined with first_ticks (ticker, theta, first_price, first_time): decision, and the new extreme. A reversal
    takes the orphans' extreme price at the time of the last orphan; an extension the first tick."""
    rows = extremes(states).join(first_ticks, ["ticker", "theta"])
    up, down = c("current_trend") == 1, c("current_trend") == -1
    reversal = (up & (c("first_price") <= c("ext_high") * (F.lit(1.0) - c("theta")))) | (down & (c("first_price") >= c("ext_low") * (F.lit(1.0) + c("theta"))))
    further = (up & (c("first_price") > c("ext_high"))) | (down & (c("first_price") < c("ext_low")))
    rows = rows.withColumn("decision", F.when(F.size("orphan_price") == 0, NONE).when(reversal, CONFIRM_REVERSAL).when(further, EXTEND_OS).otherwise(NONE))
    price = F.when(c("decision") == CONFIRM_REVERSAL, F.when(up, c("ext_high")).otherwise(c("ext_low"))).when(c("decision") == EXTEND_OS, c("first_price"))
    time = F.when(c("decision") == CONFIRM_REVERSAL, F.try_element_at("orphan_time", F.lit(-1))).when(c("decision") == EXTEND_OS, c("first_time"))
    return rows.withColumn("new_extreme_price", price).withColumn("new_extreme_time", time)


def apply(events: DataFrame, changes: DataFrame, only_provisional: bool = False) -> DataFrame:
    """events with the extreme of each key's last row replaced by changes (ticker, theta, new_extreme_price,
    new_extreme_time; null: left as it is). only_provisional: not if that row has an extreme already (months)."""
    last = F.row_number().over(Window.partitionBy("ticker", "theta").orderBy(F.desc("event_seq"))) == 1
    rows = events.withColumn("_last", last).join(changes.select("ticker", "theta", "new_extreme_price", "new_extreme_time"), ["ticker", "theta"], "left")
    hit = c("_last") & c("new_extreme_price").isNotNull() & ((c("extreme_price") <= 0) if only_provisional else F.lit(True))
    new = {"extreme_price": F.when(hit, c("new_extreme_price")).otherwise(c("extreme_price")), "extreme_time": F.when(hit, c("new_extreme_time")).otherwise(c("extreme_time"))}
    return rows.withColumns(new).select(*events.columns)


def rewrite(events: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace only the partitions that events holds: staged first, so that a table can be rewritten from itself, and
    committed by the job as a whole."""
    staged = f"{path.rstrip('/')}.staged"
    spark = events.sparkSession
    events.write.mode("overwrite").parquet(staged)
    spark.read.schema(events.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
