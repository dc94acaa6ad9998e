"""Do the events of a second run settle on those of the first? Events are compared by place: first tick's time and type."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

c = F.col
DETAILS = 10
REQUIRED = ("ticker", "theta", "results")


def compare(previous: DataFrame, new: DataFrame, strict: bool = True, tolerance_ns: int = 0) -> DataFrame:
    """One row for each (ticker, theta, day) of either run. Places are numbered within the day, 0 first.

    No previous events: converged at once. No new ones: all previous are discrepant, not converged. No discrepancy in the
    places both have: converged at 0, first -1, even if one run has more. Else it converges at the first place after the
    first discrepancy that agrees again."""
    keys = ["ticker", "theta", "day"]

    def placed(df: DataFrame, tag: str) -> DataFrame:
        n = F.row_number().over(Window.partitionBy(*keys).orderBy("event_seq")) - 1
        return df.select(*keys, n.alias("place"), F.get("time_dc", F.lit(0)).alias(f"{tag}_time"), c("event_type").alias(f"{tag}_type"))

    both = placed(previous, "p").join(placed(new, "n"), [*keys, "place"], "full_outer")
    tolerance = 0 if strict else tolerance_ns
    shared = c("p_type").isNotNull() & c("n_type").isNotNull()
    equal = shared & (c("p_type") == c("n_type")) & (F.abs(c("p_time") - c("n_time")) <= tolerance)
    both = both.withColumn("shared", shared).withColumn("equal", F.coalesce(equal, F.lit(False)))
    # the first discrepancy as a window over the places compared, so that the runs are computed once
    rows = both.withColumn("_first", F.min(F.when(c("shared") & ~c("equal"), c("place"))).over(Window.partitionBy(*keys)))
    r = rows.groupBy(*keys).agg(
        F.count_if(c("p_type").isNotNull()).alias("n_prev"), F.count_if(c("n_type").isNotNull()).alias("n_new"), F.count_if(c("shared") & ~c("equal")).alias("_bad"),
        F.max("_first").alias("_first"), F.min(F.when(c("equal") & (c("place") > c("_first")), c("place"))).alias("_again"),
        F.slice(F.sort_array(F.collect_list(F.when(c("shared") & ~c("equal") & (c("place") < c("_first") + 1000), F.struct("place", "p_time", "n_time")))), 1, DETAILS).alias("details"),
    )
    none_new = (c("n_prev") > 0) & (c("n_new") == 0)
    r = r.withColumn("n_discrepancies", F.when(none_new, c("n_prev")).otherwise(c("_bad")))
    r = r.withColumn("first_discrepancy", F.when(none_new, 0).otherwise(F.coalesce("_first", F.lit(-1))).cast("int"))
    r = r.withColumn("converged", ~none_new & (c("_first").isNull() | c("_again").isNotNull()))
    r = r.withColumn("convergence_idx", F.when(none_new, -1).when(c("_first").isNull(), 0).otherwise(F.coalesce("_again", F.lit(-1))).cast("int"))
    most = F.greatest("n_prev", "n_new")
    r = r.withColumn("n_events_diff", c("n_new") - c("n_prev")).withColumn("discrepancy_rate", F.when(most > 0, c("n_discrepancies") / most).otherwise(0.0))
    r = r.withColumn("is_perfect_match", (c("n_discrepancies") == 0) & (c("n_prev") == c("n_new")))
    return r.select(*keys, "n_prev", "n_new", "n_events_diff", "n_discrepancies", "first_discrepancy", "converged", "convergence_idx", "discrepancy_rate", "is_perfect_match", "details")


def summary(results: DataFrame) -> DataFrame:
    """Per (ticker, theta): days, those converged, perfect ones, the mean rate, the first day from which every later one is perfect."""
    r = results.withColumn("_bad", F.max(F.when(~c("is_perfect_match"), c("day"))).over(Window.partitionBy("ticker", "theta")))
    return r.groupBy("ticker", "theta").agg(F.count("*").alias("n_days"), F.count_if("converged").alias("n_converged"), F.count_if("is_perfect_match").alias("n_perfect_matches"), F.avg("discrepancy_rate").alias("avg_discrepancy_rate"), F.min(F.when(c("_bad").isNull() | (c("day") > c("_bad")), c("day"))).alias("global_convergence_date"))


def worst_days(results: DataFrame, n: int = 5) -> DataFrame:
    return results.orderBy(F.desc("discrepancy_rate"), "day").limit(n)


def compare_reports(a: DataFrame, b: DataFrame) -> DataFrame:
    """Days of both, of one only, and how much the mean rates of the shared days differ: one row."""
    x = a.select("ticker", "theta", "day", c("discrepancy_rate").alias("ra"), F.lit(True).alias("in_a"))
    y = b.select("ticker", "theta", "day", c("discrepancy_rate").alias("rb"), F.lit(True).alias("in_b"))
    j = x.join(y, ["ticker", "theta", "day"], "full_outer")
    shared = c("in_a").isNotNull() & c("in_b").isNotNull()
    return j.agg(F.count_if(shared).alias("n_shared"), F.count_if(c("in_b").isNull()).alias("only_a"), F.count_if(c("in_a").isNull()).alias("only_b"), (F.avg(F.when(shared, c("rb"))) - F.avg(F.when(shared, c("ra")))).alias("mean_difference"))


def save_report(results: DataFrame, path: str, ticker: str, theta: float) -> dict:
    """One (ticker, theta)'s days as a JSON document."""
    rows = [r.asDict(recursive=True) for r in results.filter((c("ticker") == ticker) & (c("theta") == theta)).orderBy("day").collect()]
    doc = {"ticker": ticker, "theta": theta, "results": rows}
    with open(path, "w") as f:
        json.dump(doc, f, indent=1, default=str)
    return doc


def load_report(path: str) -> dict:
    with open(path) as f:
        doc = json.load(f)
    if missing := [k for k in REQUIRED if k not in doc]:
        raise ValueError(f"{path} has no {', '.join(missing)}")
    return doc


def summary_text(row: dict) -> str:
    """One (ticker, theta)'s row of summary() in a few lines."""
    n = row["n_days"]
    share = lambda k: f"{k} of {n} ({k / n if n else 0.0:.1%})"
    since = row["global_convergence_date"]
    return "\n".join([
        f"{row['ticker']} at {row['theta']}: {n} days compared",
        f"  converged: {share(row['n_converged'])}",
        f"  perfect: {share(row['n_perfect_matches'])}",
        f"  mean discrepancy rate: {row['avg_discrepancy_rate'] or 0.0:.4%}",
        f"  all perfect from: {since if since is not None else 'no day on'}",
    ])


def text(row: dict) -> str:
    """One day's result in a line."""
    how = "perfect" if row["is_perfect_match"] else f"converged at {row['convergence_idx']}" if row["converged"] else "not converged"
    return f"{row['ticker']} {row['day']}: {row['n_prev']} -> {row['n_new']} events, {row['n_discrepancies']} discrepancies ({row['discrepancy_rate']:.2%}), {how}"
