"""One query for each operator over the driver tables, with the same result in SQL where SQL can say it."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seiche.functions import indicators as ind
from seiche.functions import quality
from seiche.operators import converge, reconcile, state
from seiche.operators.engine import Engine, day_counts
from seiche.operators.segment import end_state, segment
from seiche.plans import analysis, oracle
from seiche.sources import bronze, silver

THETA = 0.5
SWEEP = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)
c = F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return keep


def users(spark: SparkSession, d: str, theta=THETA) -> DataFrame:
    return segment(bronze.events_by_user(spark, d), theta)


def priorities(spark: SparkSession, d: str, theta=THETA) -> DataFrame:
    return segment(bronze.orders_by_priority(spark, d), theta)


U, O = oracle.silver("events_by_user", (THETA,)), oracle.silver("orders_by_priority", (THETA,))  # noqa: E741
UI = U + oracle.events(THETA)
UL, OL = U + oracle.LISTS, O + oracle.LISTS
#: Scalars with types that both sides have.
def ev() -> list:
    return [c("ticker"), c("theta"), c("event_seq"), c("event_type").cast("bigint").alias("event_type"), *(c(x) for x in ("reference_price", "reference_time", "extreme_price", "extreme_time", "confirm_price", "confirm_time"))]
EV_SQL = "ticker, theta, event_seq, CAST(event_type AS BIGINT) AS event_type, reference_price, reference_time, extreme_price, extreme_time, confirm_price, confirm_time"
KEY = ["ticker", "event_seq"]


@query(f"{U} SELECT {EV_SQL} FROM silver")
def dc_segment_events(spark, d):
    return users(spark, d).select(*ev())


@query(f"{O} SELECT {EV_SQL} FROM silver")
def dc_segment_ties_orders(spark, d):
    return priorities(spark, d).select(*ev())


@query(f"{oracle.silver('lineitem_by_supplier', (0.2,))} SELECT ticker, count(*) AS n_events, sum(CASE WHEN event_type = 1 THEN 1 ELSE 0 END)::BIGINT AS n_up, round(sum(confirm_price), 4) AS sum_confirm, CAST(sum(confirm_time // 86400000000000) AS BIGINT) AS sum_confirm_day FROM silver GROUP BY ticker")
def dc_segment_lineitem(spark, d):
    e = segment(bronze.lineitem_by_supplier(spark, d), 0.2)
    return e.groupBy("ticker").agg(F.count("*").alias("n_events"), F.count_if(c("event_type") == 1).alias("n_up"), F.round(F.sum("confirm_price"), 4).alias("sum_confirm"), F.sum(F.floor(c("confirm_time") / F.lit(86_400_000_000_000))).alias("sum_confirm_day"))


@query(f"{OL} SELECT ticker, event_seq, len(price_dc)::BIGINT AS n_dc, len(price_os)::BIGINT AS n_os, price_dc[1] AS first_dc, price_dc[-1] AS last_dc, round(list_sum(price_dc), 6) AS sum_dc, time_dc[1] AS t_first_dc, round(coalesce(list_sum(price_os), 0), 6) AS sum_os, list_sum(dir_dc)::BIGINT AS dir_dc, dc_start, dc_end, os_end FROM full_ev")
def dc_phase_lists(spark, d):
    total = lambda a: F.round(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), 6)
    return priorities(spark, d).select(*KEY, F.size("price_dc").cast("bigint").alias("n_dc"), F.size("price_os").cast("bigint").alias("n_os"), F.get("price_dc", F.lit(0)).alias("first_dc"), F.try_element_at("price_dc", F.lit(-1)).alias("last_dc"), total("price_dc").alias("sum_dc"), F.get("time_dc", F.lit(0)).alias("t_first_dc"), total("price_os").alias("sum_os"), F.aggregate("dir_dc", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("dir_dc"), "dc_start", "dc_end", "os_end")


@query(f"{O} SELECT ticker, theta, n_ticks, CAST(current_trend AS BIGINT) AS current_trend, high_price, low_price, orphan_start, n_ticks - orphan_start AS n_orphans FROM fin")
def dc_orphans(spark, d):
    return end_state(bronze.orders_by_priority(spark, d), THETA).select("ticker", "theta", "n_ticks", c("current_trend").cast("bigint").alias("current_trend"), "high_price", "low_price", "orphan_start", F.size("orphan_price").cast("bigint").alias("n_orphans"))


SWEPT = oracle.silver("events_by_type", SWEEP)
LENGTH_SQL = "sum(coalesce(abs(confirm_price - reference_price) / nullif(reference_price, 0), 0) + coalesce(CASE WHEN extreme_price <> -1.0 THEN abs(extreme_price - confirm_price) / nullif(confirm_price, 0) END, 0))"


@query(f"{SWEPT} SELECT ticker, theta, count(*) AS n_events, round({LENGTH_SQL}, 6) AS coastline FROM silver GROUP BY ticker, theta")
def dc_theta_sweep(spark, d):
    e = segment(bronze.events_by_type(spark, d), list(SWEEP))
    return analysis.coastline(e, ["ticker"]).withColumn("coastline", F.round("coastline", 6))


@query(f"{SWEPT}, l AS (SELECT ticker, theta, {LENGTH_SQL} AS coastline FROM silver GROUP BY ticker, theta) SELECT ticker, count(*) AS n, round(regr_slope(ln(coastline), ln(theta)), 6) AS slope, round(regr_intercept(ln(coastline), ln(theta)), 6) AS intercept FROM l GROUP BY ticker HAVING count(*) > 2")
def dc_coastline_fit(spark, d):
    e = segment(bronze.events_by_type(spark, d), list(SWEEP))
    return analysis.coastline_fit(analysis.coastline(e, ["ticker"]), ["ticker"]).select("ticker", "n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


def _indicators(names: list[str], decimals: int = 9):
    def run(spark, d):
        out = ind.create_registry(THETA).compute(users(spark, d), names)
        kinds = dict(out.dtypes)
        cols = [F.round(n, decimals).alias(n) if kinds[n] == "double" else c(n).cast("bigint").alias(n) for n in names]
        return out.select(*KEY, *cols)

    return run


def _indicator_query(name: str, doubles: list[str], longs: list[str] = ()) -> None:
    QUERIES[name] = _indicators([*doubles, *longs])
    cols = ", ".join([*(f"round({n}, 9) AS {n}" for n in doubles), *(f"CAST({n} AS BIGINT) AS {n}" for n in longs)])
    ORACLE[name] = f"{UI} SELECT ticker, event_seq, {cols} FROM ind"


_indicator_query("ind_price", ["dc_magnitude", "os_magnitude", "dc_return", "os_return", "event_magnitude", "total_move", "a1_dc_price_abs"])
_indicator_query("ind_theta", ["dc_slippage", "tmv", "osv_event"])
_indicator_query("ind_time", [], ["dc_time", "os_time", "event_time"])
_indicator_query("ind_velocity", ["dc_velocity", "os_velocity", "event_velocity"])
_indicator_query("ind_memory", ["a4_prev_dcc_price"], ["a5_prev_os_flag", "a6_flash_event"])

AT = "list_filter(list_zip(price_dc, time_dc), lambda x: x[2] = confirm_time)"


@query(f"{OL} SELECT ticker, event_seq, round(CASE WHEN event_type = 1 THEN list_max(list_transform({AT}, lambda x: x[1])) ELSE list_min(list_transform({AT}, lambda x: x[1])) END - reference_price * (1.0::DOUBLE + event_type * {THETA}::DOUBLE), 6) AS dc_slippage_real FROM full_ev")
def ind_slippage_real(spark, d):
    return ind.create_registry(THETA).compute(priorities(spark, d), ["dc_slippage_real"]).select(*KEY, F.round("dc_slippage_real", 6).alias("dc_slippage_real"))


RUNS = 0.05


@query(f"""{UL}, w AS (SELECT e.ticker, e.event_seq, e.event_type, e.price_os, 1::BIGINT AS k, e.price_os[1] AS ref, 0::BIGINT AS n FROM full_ev e
UNION ALL SELECT ticker, event_seq, event_type, price_os, k + 1, CASE WHEN hit THEN price_os[k + 1] ELSE ref END, n + CASE WHEN hit THEN 1 ELSE 0 END FROM (SELECT *, (event_type = 1 AND price_os[k + 1] >= ref * (1.0::DOUBLE + {RUNS}::DOUBLE)) OR (event_type = -1 AND price_os[k + 1] <= ref * (1.0::DOUBLE - {RUNS}::DOUBLE)) AS hit FROM w WHERE k < len(price_os)) x)
SELECT ticker, event_seq, max(n) AS runs_count FROM w GROUP BY ticker, event_seq""")
def ind_runs(spark, d):
    return ind.create_registry(RUNS).compute(users(spark, d), ["runs_count"]).select(*KEY, "runs_count")


SUMMARY = {"tmv_aggregated": 6, "avg_dc_time": -3, "avg_return": 9, "avg_os_magnitude": 9, "volatility_dc": 9, "ndc": None, "cdc": 6, "accumulated_time": None}


def _rounded_summary() -> list:
    return [F.round(n, k).alias(n) if k is not None else c(n) for n, k in SUMMARY.items()]


@query(f"{UI} SELECT ticker, {oracle.SUMMARY} FROM ind GROUP BY ticker")
def sum_by_ticker(spark, d):
    return ind.create_registry(THETA).summarise(users(spark, d), by=["ticker"]).select("ticker", *_rounded_summary())


@query(f"{UI}, t AS (SELECT ticker, {oracle.SUMMARY} FROM ind GROUP BY ticker) SELECT ind.event_seq, t.* FROM ind JOIN t USING (ticker)")
def sum_broadcast(spark, d):
    return ind.create_registry(THETA).compute(users(spark, d), list(SUMMARY)).select("event_seq", "ticker", *_rounded_summary())


@query(f"{UI} SELECT ticker, round(avg(CASE WHEN event_type = 1 THEN 1.0 ELSE 0.0 END), 9) AS upturn_ratio, round(sum(CASE WHEN dc_magnitude <> 0 THEN abs(os_magnitude) / abs(dc_magnitude) END), 4) AS sum_smq FROM ind GROUP BY ticker")
def ind_extras(spark, d):
    return users(spark, d).groupBy("ticker").agg(F.round(ind.upturn_ratio(), 9).alias("upturn_ratio"), F.round(F.sum(ind.smq()), 4).alias("sum_smq"))


@query(f"{SWEPT}, s AS (SELECT ticker, theta, sum(abs(confirm_price - reference_price + (extreme_price - confirm_price)) / nullif(reference_price * 0.5::DOUBLE, 0)) AS cdc FROM silver GROUP BY ticker, theta) SELECT theta, round(sum(CASE WHEN ticker = 'click' THEN cdc END) / sum(CASE WHEN ticker = 'view' THEN cdc END), 9) AS mrv FROM s WHERE ticker IN ('click', 'view') GROUP BY theta")
def ind_relative_volatility(spark, d):
    return ind.relative_volatility(segment(bronze.events_by_type(spark, d), list(SWEEP)), "click", "view", 0.5).select("theta", F.round("mrv", 9).alias("mrv"))


DAYS = "SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_ticks FROM events GROUP BY ALL"


@query(DAYS)
def day_split_counts(spark, d):
    return day_counts(bronze.events_by_user(spark, d)).withColumn("day", c("day").cast("string"))


FIN_O = f"{O}, orp AS (SELECT f.ticker, list(t.price ORDER BY t.i) AS p FROM fin f JOIN tk t ON t.ticker = f.ticker AND t.i >= f.orphan_start GROUP BY f.ticker)"


@query(f"{FIN_O} SELECT f.ticker, coalesce(list_max(p), 0.0) AS ext_high, coalesce(list_min(p), 0.0) AS ext_low, CAST(coalesce(len(p), 0) * 25 + 48 AS BIGINT) AS bytes FROM fin f LEFT JOIN orp USING (ticker)")
def state_extremes(spark, d):
    s = state.extremes(end_state(bronze.orders_by_priority(spark, d), THETA))
    return s.select("ticker", "ext_high", "ext_low", state.memory_bytes().cast("bigint").alias("bytes"))


def _daily_states(spark, d) -> DataFrame:
    """A state of each user's days with events: here the day's last tick as the one orphan."""
    t = bronze.events_by_user(spark, d).withColumn("period", F.date_from_unix_date(F.floor(c("time") / F.lit(86_400_000_000_000)).cast("int")))
    s = t.groupBy("ticker", "period").agg(F.array(F.max_by("price", "seq")).alias("orphan_price"), F.array(F.max("time")).alias("orphan_time"))
    return s.withColumn("theta", F.lit(THETA)).withColumn("orphan_qty", F.array(F.lit(1.0))).withColumn("orphan_dir", F.array(F.lit(1).cast("tinyint"))).withColumn("current_trend", F.when(F.dayofmonth("period") % 2 == 0, 1).otherwise(-1))


DS = "WITH ds AS (SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS period, arg_max(CAST(value AS DOUBLE), (ts, event_id)) AS price, max(epoch_us(ts) * 1000) AS time FROM events GROUP BY ALL)"


@query(f"{DS} SELECT a.ticker, CAST(a.period AS VARCHAR) AS wanted, CAST(max(b.period) AS VARCHAR) AS found, arg_max(b.price, b.period) AS price FROM ds a JOIN ds b ON a.ticker = b.ticker AND b.period BETWEEN a.period - 7 AND a.period - 1 GROUP BY a.ticker, a.period")
def state_asof(spark, d):
    s = _daily_states(spark, d)
    return state.previous(s, s.select("ticker", "theta", "period")).select("ticker", c("wanted").cast("string").alias("wanted"), c("period").cast("string").alias("found"), F.get("orphan_price", F.lit(0)).alias("price"))


@query(f"{DS} SELECT ticker, CAST(period AS VARCHAR) AS period FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY period DESC) AS n FROM ds) x WHERE n > 2")
def state_topk(spark, d):
    return state.retired(_daily_states(spark, d), 2).select("ticker", c("period").cast("string").alias("period"))


REVERSAL = "(day(n.period) % 2 = 0 AND first_price <= price * (1.0::DOUBLE - 0.5::DOUBLE) OR day(n.period) % 2 <> 0 AND first_price >= price * (1.0::DOUBLE + 0.5::DOUBLE))"
FURTHER = "(day(n.period) % 2 = 0 AND first_price > price OR day(n.period) % 2 <> 0 AND first_price < price)"
DECIDE = f"""{DS}, n AS (SELECT *, lead(period) OVER (PARTITION BY ticker ORDER BY period) AS next_period FROM ds),
ft AS (SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS period, arg_min(CAST(value AS DOUBLE), (ts, event_id)) AS first_price, min(epoch_us(ts) * 1000) AS first_time FROM events GROUP BY ALL)
SELECT n.ticker, CAST(n.period AS VARCHAR) AS period, CASE WHEN {REVERSAL} THEN 'confirm_reversal' WHEN {FURTHER} THEN 'extend_os' ELSE 'none' END AS decision,
 CASE WHEN {REVERSAL} THEN price WHEN {FURTHER} THEN first_price END AS new_extreme_price,
 CASE WHEN {REVERSAL} THEN time WHEN {FURTHER} THEN first_time END AS new_extreme_time
FROM n JOIN ft ON ft.ticker = n.ticker AND ft.period = n.next_period"""


@query(DECIDE)
def recon_decision(spark, d):
    t = bronze.events_by_user(spark, d).withColumn("next_period", F.date_from_unix_date(F.floor(c("time") / F.lit(86_400_000_000_000)).cast("int")))
    first = t.groupBy("ticker", "next_period").agg(F.min_by("price", "seq").alias("first_price"), F.min("time").alias("first_time"))
    s = _daily_states(spark, d).withColumn("next_period", F.lead("period").over(Window.partitionBy("ticker").orderBy("period")))
    # the state's own period stands for the key here, so that each state meets its next day's first tick
    keyed = s.withColumn("owner", c("ticker")).withColumn("ticker", F.concat_ws("/", "ticker", c("period").cast("string")))
    ticks = s.join(first, ["ticker", "next_period"]).select(F.concat_ws("/", "ticker", c("period").cast("string")).alias("ticker"), "theta", "first_price", "first_time")
    return reconcile.decide(keyed, ticks).select(c("owner").alias("ticker"), c("period").cast("string").alias("period"), "decision", "new_extreme_price", "new_extreme_time")


@query(f"{O}, l AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY event_seq DESC) = 1 AS last FROM silver) SELECT ticker, event_seq, CASE WHEN last AND extreme_price <= 0 THEN confirm_price * 2 ELSE extreme_price END AS extreme_price, CASE WHEN last AND extreme_price <= 0 THEN confirm_time + 1 ELSE extreme_time END AS extreme_time FROM l")
def recon_apply(spark, d):
    e = priorities(spark, d)
    new = e.groupBy("ticker", "theta").agg(F.max_by(c("confirm_price") * 2, "event_seq").alias("new_extreme_price"), F.max_by(c("confirm_time") + 1, "event_seq").alias("new_extreme_time"))
    return reconcile.apply(e, new, only_provisional=True).select(*KEY, "extreme_price", "extreme_time")


#: The second run leaves out the first tick of each key, so that its first events differ and later ones agree.
SECOND = U.replace("FROM events)", "FROM events WHERE (user_id, ts, event_id) NOT IN (SELECT user_id, min(ts), arg_min(event_id, ts) FROM events GROUP BY user_id))")
COMPARE = """p AS (SELECT ticker, CAST(make_timestamp(confirm_time // 1000) AS DATE) AS day, first_dc, event_type, row_number() OVER (PARTITION BY ticker, CAST(make_timestamp(confirm_time // 1000) AS DATE) ORDER BY event_seq) - 1 AS place FROM {a}),
q AS (SELECT ticker, CAST(make_timestamp(confirm_time // 1000) AS DATE) AS day, first_dc, event_type, row_number() OVER (PARTITION BY ticker, CAST(make_timestamp(confirm_time // 1000) AS DATE) ORDER BY event_seq) - 1 AS place FROM {b}),
j AS (SELECT coalesce(p.ticker, q.ticker) AS ticker, coalesce(p.day, q.day) AS day, coalesce(p.place, q.place) AS place, p.place IS NOT NULL AS inp, q.place IS NOT NULL AS inq, p.place IS NOT NULL AND q.place IS NOT NULL AS shared, coalesce(p.first_dc = q.first_dc AND p.event_type = q.event_type, false) AS eq FROM p FULL JOIN q ON p.ticker = q.ticker AND p.day = q.day AND p.place = q.place),
f AS (SELECT *, min(CASE WHEN shared AND NOT eq THEN place END) OVER (PARTITION BY ticker, day) AS ff FROM j),
g AS (SELECT ticker, day, count(*) FILTER (WHERE inp) AS n_prev, count(*) FILTER (WHERE inq) AS n_new, count(*) FILTER (WHERE shared AND NOT eq) AS bad, max(ff) AS ff, min(CASE WHEN eq AND place > ff THEN place END) AS again FROM f GROUP BY ticker, day),
cmp AS (SELECT ticker, day, n_prev, n_new, CASE WHEN n_prev > 0 AND n_new = 0 THEN n_prev ELSE bad END AS n_discrepancies, CASE WHEN n_prev > 0 AND n_new = 0 THEN 0 ELSE coalesce(ff, -1) END AS first_discrepancy,
 NOT (n_prev > 0 AND n_new = 0) AND (ff IS NULL OR again IS NOT NULL) AS converged, CASE WHEN n_prev > 0 AND n_new = 0 THEN -1 WHEN ff IS NULL THEN 0 ELSE coalesce(again, -1) END AS convergence_idx,
 CASE WHEN greatest(n_prev, n_new) > 0 THEN CAST(CASE WHEN n_prev > 0 AND n_new = 0 THEN n_prev ELSE bad END AS DOUBLE) / greatest(n_prev, n_new) ELSE 0.0 END AS discrepancy_rate FROM g)"""


def _first_dc(sql: str, name: str) -> str:
    """A run's events with the time of the first tick of the change, under a name of its own."""
    return f"{name} AS ({sql} SELECT e.*, t.time AS first_dc FROM silver e JOIN tk t ON t.ticker = e.ticker AND t.i = e.dc_start)"


COMPARED = "WITH " + _first_dc(U, "ra") + ", " + _first_dc(SECOND, "rb") + ", " + COMPARE.format(a="ra", b="rb")


def _two_runs(spark, d) -> DataFrame:
    t = bronze.table(spark, d, "events")
    first = t.groupBy("user_id").agg(F.min(F.struct("ts", "event_id")).alias("f")).select("user_id", "f.ts", "f.event_id")
    again = bronze.ticks(t.join(first, ["user_id", "ts", "event_id"], "left_anti"), "user_id", "ts", "value", ["event_id"])
    day = lambda e: analysis.with_day(e)
    return converge.compare(day(users(spark, d)), day(segment(again, THETA)))


@query(f"{COMPARED} SELECT ticker, CAST(day AS VARCHAR) AS day, n_prev, n_new, n_discrepancies, CAST(first_discrepancy AS BIGINT) AS first_discrepancy, converged, CAST(convergence_idx AS BIGINT) AS convergence_idx, round(discrepancy_rate, 9) AS discrepancy_rate FROM cmp")
def converge_compare(spark, d):
    return _two_runs(spark, d).select("ticker", c("day").cast("string").alias("day"), "n_prev", "n_new", "n_discrepancies", c("first_discrepancy").cast("bigint").alias("first_discrepancy"), "converged", c("convergence_idx").cast("bigint").alias("convergence_idx"), F.round("discrepancy_rate", 9).alias("discrepancy_rate"))


@query(f"{COMPARED}, lb AS (SELECT ticker, max(CASE WHEN n_discrepancies > 0 OR n_prev <> n_new THEN day END) AS bad FROM cmp GROUP BY ticker) SELECT ticker, count(*) AS n_days, count(*) FILTER (WHERE converged) AS n_converged, count(*) FILTER (WHERE n_discrepancies = 0 AND n_prev = n_new) AS n_perfect_matches, round(avg(discrepancy_rate), 9) AS avg_discrepancy_rate, CAST(min(CASE WHEN bad IS NULL OR day > bad THEN day END) AS VARCHAR) AS global_convergence_date FROM cmp JOIN lb USING (ticker) GROUP BY ticker")
def converge_report(spark, d):
    return converge.summary(_two_runs(spark, d)).select("ticker", "n_days", "n_converged", "n_perfect_matches", F.round("avg_discrepancy_rate", 9).alias("avg_discrepancy_rate"), c("global_convergence_date").cast("string").alias("global_convergence_date"))


@query(f"{COMPARED} SELECT count(*) FILTER (WHERE day(day) % 2 = 0 AND day(day) % 3 = 0) AS n_shared, count(*) FILTER (WHERE day(day) % 2 = 0 AND day(day) % 3 <> 0) AS only_a, count(*) FILTER (WHERE day(day) % 2 <> 0 AND day(day) % 3 = 0) AS only_b, round(0.0, 9) AS mean_difference FROM cmp")
def report_compare(spark, d):
    r = _two_runs(spark, d)
    return converge.compare_reports(r.filter("day(day) % 2 = 0"), r.filter("day(day) % 3 = 0")).withColumn("mean_difference", F.round("mean_difference", 9) + 0.0)


# -- quality: bad events a check, over events of orders (ties) by day

BAD = {
    "dq_structural": {"no_null_scalars": "reference_price IS NULL OR confirm_price IS NULL"},
    "dq_intra_event": {"dc_list_lengths_consistent": "len(time_dc) <> len(price_dc)", "os_list_lengths_consistent": "len(time_os) <> len(price_os)", "event_type_valid_values": "event_type NOT IN (1, -1)", "dc_not_empty": "len(price_dc) = 0", "directions_valid_values": "len(list_filter(list_concat(dir_dc, dir_os), lambda x: x NOT IN (1, -1))) > 0", "quantities_positive": "len(list_filter(list_concat(qty_dc, qty_os), lambda x: x <= 0)) > 0"},
    "dq_temporal": {"dc_timestamps_monotonic": "list_sort(time_dc) <> time_dc", "os_timestamps_monotonic": "list_sort(time_os) <> time_os", "dc_before_os": "list_max(time_dc) > list_min(time_os)", "reference_before_confirm": "reference_time > confirm_time OR (reference_time = confirm_time AND NOT (len(price_dc) > 0 AND list_min(time_dc) = list_max(time_dc)))", "confirm_before_extreme": "extreme_price <> -1 AND (confirm_time > extreme_time OR (confirm_time = extreme_time AND len(price_os) > 0))", "zero_os_rate": "false", "flash_event_rate": "false", "confirm_time_equals_last_dc_time": "time_dc[-1] <> confirm_time", "timestamps_positive": "reference_time <= 0 OR confirm_time <= 0 OR len(list_filter(list_concat(time_dc, time_os), lambda x: x <= 0)) > 0"},
    "dq_price": {"prices_positive": "reference_price <= 0 OR confirm_price <= 0 OR len(list_filter(list_concat(price_dc, price_os), lambda x: x <= 0)) > 0", "prices_finite": "NOT isfinite(reference_price) OR NOT isfinite(confirm_price) OR NOT isfinite(extreme_price) OR len(list_filter(list_concat(price_dc, price_os), lambda x: NOT isfinite(x))) > 0", "confirm_price_in_dc_range": "confirm_price NOT BETWEEN list_min(price_dc) AND list_max(price_dc)", "confirm_price_matches_dc": "len(price_dc) > 0 AND len(list_filter(price_dc, lambda x: abs(x - confirm_price) < 1e-12)) = 0", "reference_price_chain": "prev_extreme <> -1 AND abs(reference_price - prev_extreme) > 1e-12", "extreme_price_in_os_range": "extreme_price <> -1 AND len(price_os) > 0 AND extreme_price <> CASE WHEN event_type = 1 THEN list_max(price_os) ELSE list_min(price_os) END"},
    "dq_threshold": {"dc_magnitude_meets_theta": f"abs(confirm_price - reference_price) / nullif(reference_price, 0) < {THETA - 1e-9!r}::DOUBLE", "slippage_bounded": f"abs(confirm_price - reference_price * (1.0::DOUBLE + event_type * {THETA}::DOUBLE)) > {2 * THETA}::DOUBLE * reference_price", "direction_matches_event_type": "(event_type = 1 AND confirm_price - reference_price < -1e-12) OR (event_type = -1 AND confirm_price - reference_price > 1e-12)"},
    "dq_choice": {"conservative_price_selection": f"len({AT}) >= 2 AND abs(CASE WHEN event_type = 1 THEN list_min(list_filter(list_transform({AT}, lambda x: x[1]), lambda p: p >= reference_price * {1.0 + THETA!r}::DOUBLE - 1e-12::DOUBLE)) ELSE list_max(list_filter(list_transform({AT}, lambda x: x[1]), lambda p: p <= reference_price * {1.0 - THETA!r}::DOUBLE + 1e-12::DOUBLE)) END - confirm_price) > 1e-12::DOUBLE"},
    "dq_collision": {"no_os_ticks_at_confirm_time": "list_contains(time_os, confirm_time)", "all_confirm_instant_in_dc": "len(list_filter(time_os, lambda x: x = confirm_time)) > 0", "dc_os_no_timestamp_overlap": "list_max(time_dc) >= list_min(time_os)"},
}
CHECKED = f"{OL}, q AS (SELECT *, CAST(make_timestamp(confirm_time // 1000) AS DATE) AS day FROM full_ev), z AS (SELECT *, lag(extreme_price) OVER (PARTITION BY ticker, day ORDER BY event_seq) AS prev_extreme FROM q)"


def _quality_query(name: str, bad: dict[str, str]) -> None:
    checks = [k for k in quality.ROW_CHECKS if k.name in bad]

    def run(spark, d):
        r = quality.row_results(analysis.with_day(priorities(spark, d)), THETA, checks=checks)
        return r.groupBy("test").agg(F.count("*").alias("n_days"), F.count_if("passed").alias("n_passed"), F.sum("n_affected").alias("n_affected"))

    QUERIES[name] = run
    ORACLE[name] = CHECKED + " " + " UNION ALL ".join(f"SELECT '{t}' AS test, count(*) AS n_days, count(*) FILTER (WHERE n = 0) AS n_passed, CAST(sum(n) AS BIGINT) AS n_affected FROM (SELECT day, count(*) FILTER (WHERE {sql}) AS n FROM z GROUP BY day) x" for t, sql in bad.items())


for _name, _bad in BAD.items():
    _quality_query(_name, _bad)


#: What is done to some events, by their number, so that each check has something to find: column, condition, new value
#: in Spark's SQL and in DuckDB's.
DAMAGE = [
    ("reference_price", "event_seq % 29 = 3", "CAST(NULL AS DOUBLE)", "NULL"), ("confirm_price", "event_seq % 23 = 5", "-confirm_price", "-confirm_price"), ("confirm_price", "event_seq % 31 = 7", "double('NaN')", "'NaN'::DOUBLE"),
    ("event_type", "event_seq % 37 = 2", "CAST(0 AS TINYINT)", "0"), ("event_type", "event_seq % 41 = 1", "CAST(-event_type AS TINYINT)", "-event_type"), ("extreme_price", "event_seq % 19 = 4", "extreme_price * 2", "extreme_price * 2"),
    ("extreme_time", "event_seq % 43 = 6", "confirm_time - 1", "confirm_time - 1"), ("reference_time", "event_seq % 47 = 8", "CAST(0 AS BIGINT)", "0"), ("reference_time", "event_seq % 53 = 9", "confirm_time + 1", "confirm_time + 1"),
    ("qty_dc", "event_seq % 17 = 2", "transform(qty_dc, x -> -x)", "list_transform(qty_dc, lambda x: -x)"), ("dir_dc", "event_seq % 59 = 10", "transform(dir_dc, x -> CAST(0 AS TINYINT))", "list_transform(dir_dc, lambda x: 0)"),
    ("time_dc", "event_seq % 13 = 3", "reverse(time_dc)", "list_reverse(time_dc)"), ("time_os", "event_seq % 11 = 5", "reverse(time_os)", "list_reverse(time_os)"), ("time_os", "event_seq % 61 = 11", "transform(time_os, x -> confirm_time)", "list_transform(time_os, lambda x: confirm_time)"),
    ("price_dc", "event_seq % 67 = 12", "transform(price_dc, x -> -x)", "list_transform(price_dc, lambda x: -x)"), ("price_os", "event_seq % 71 = 13", "slice(price_os, 1, 1)", "price_os[1:1]"), ("price_dc", "event_seq % 73 = 14", "slice(price_dc, 1, 0)", "price_dc[1:0]"),
]


def damaged(events: DataFrame) -> DataFrame:
    """Each column as it was, changed where its condition holds; the first condition of a column counts."""
    new = {}
    for col in dict.fromkeys(x[0] for x in DAMAGE):
        whens = " ".join(f"WHEN {cond} THEN {spark}" for name, cond, spark, _ in DAMAGE if name == col)
        new[col] = F.expr(f"CASE {whens} ELSE {col} END")
    return events.withColumns(new)


DAMAGED = f"{OL}, dm AS (SELECT * REPLACE (" + ", ".join(f"CASE {' '.join(f'WHEN {cond} THEN {duck}' for name, cond, _, duck in DAMAGE if name == col)} ELSE {col} END AS {col}" for col in dict.fromkeys(x[0] for x in DAMAGE)) + ") FROM full_ev), q AS (SELECT *, CAST(make_timestamp(confirm_time // 1000) AS DATE) AS day FROM dm), z AS (SELECT *, lag(extreme_price) OVER (PARTITION BY ticker, day ORDER BY event_seq) AS prev_extreme FROM q)"


def _damaged_query(name: str, bad: dict[str, str]) -> None:
    checks = [k for k in quality.ROW_CHECKS if k.name in bad]

    def run(spark, d):
        r = quality.row_results(analysis.with_day(damaged(priorities(spark, d))), THETA, checks=checks)
        return r.groupBy("test").agg(F.count("*").alias("n_days"), F.count_if("passed").alias("n_passed"), F.sum("n_affected").alias("n_affected"))

    QUERIES[name] = run
    ORACLE[name] = DAMAGED + " " + " UNION ALL ".join(f"SELECT '{t}' AS test, count(*) AS n_days, count(*) FILTER (WHERE n = 0) AS n_passed, CAST(sum(n) AS BIGINT) AS n_affected FROM (SELECT day, count(*) FILTER (WHERE {sql}) AS n FROM z GROUP BY day) x" for t, sql in bad.items())


for _name, _bad in BAD.items():
    _damaged_query(f"{_name}_damaged", _bad)


RATES = f"{CHECKED} SELECT CAST(day AS VARCHAR) AS day, 'zero_os_rate' AS test, round(avg(CASE WHEN extreme_price <> -1 THEN CASE WHEN extreme_time = confirm_time THEN 1.0 ELSE 0.0 END END), 9) AS value FROM z GROUP BY day UNION ALL SELECT CAST(day AS VARCHAR), 'flash_event_rate', round(avg(CASE WHEN reference_time = confirm_time THEN 1.0 ELSE 0.0 END), 9) FROM z GROUP BY day"


@query(RATES)
def dq_rates(spark, d):
    checks = [k for k in quality.ROW_CHECKS if k.name in ("zero_os_rate", "flash_event_rate")]
    return quality.row_results(analysis.with_day(priorities(spark, d)), THETA, checks=checks).select("day", "test", F.round("value", 9).alias("value"))


STRUCTURE_SQL = "SELECT * FROM (VALUES ('required_columns', true), ('column_types', false), ('non_empty_dataframe', true)) x(test, passed)"


@query(STRUCTURE_SQL)
def dq_structure(spark, d):
    """A table with a column of a wrong type, by the checks of structure."""
    e = analysis.with_day(priorities(spark, d)).withColumn("event_type", c("event_type").cast("int"))
    return quality.check(e, THETA, levels=[1]).filter(c("test").isin("required_columns", "column_types", "non_empty_dataframe")).select("test", "passed")


EDGES = f"{O}, q AS (SELECT *, CAST(make_timestamp(confirm_time // 1000) AS DATE) AS day FROM silver), e AS (SELECT ticker, day, arg_min(reference_price, event_seq) AS fr, arg_min(event_type, event_seq) AS ft, arg_max(event_type, event_seq) AS lt, arg_max(extreme_price, event_seq) AS le, arg_max(extreme_price, event_seq) FILTER (WHERE extreme_price <> -1) AS lx FROM q GROUP BY ticker, day), w AS (SELECT *, lag(lx) OVER x AS px, lag(lt) OVER x AS pt FROM e WINDOW x AS (PARTITION BY ticker ORDER BY day))"


@query(f"{EDGES} SELECT 'reference_chain_across_days' AS test, count(DISTINCT day) AS n_days, count(*) FILTER (WHERE px IS NOT NULL AND abs(fr - px) > 1e-12) AS n_affected FROM w UNION ALL SELECT 'trend_continuity', count(DISTINCT day), count(*) FILTER (WHERE pt IS NOT NULL AND pt = ft) FROM w UNION ALL SELECT 'last_event_extreme_provisional', count(DISTINCT day), count(*) FILTER (WHERE le <> -1) FROM w")
def dq_cross_day(spark, d):
    return quality.cross_day_results(analysis.with_day(priorities(spark, d))).groupBy("test").agg(F.count("*").alias("n_days"), F.sum("n_affected").alias("n_affected"))


OVER = "abs(extreme_price - confirm_price) / nullif(confirm_price, 0)"
MOVE = "abs(confirm_price - reference_price) / nullif(reference_price, 0)"


@query(f"{CHECKED}, r AS (SELECT day, avg(CASE WHEN extreme_price <> -1 AND len(price_os) > 0 THEN {OVER} END) AS a, avg(CASE WHEN extreme_price <> -1 THEN {MOVE} + {OVER} END) AS b, avg(CASE WHEN len(price_os) = 0 THEN 1.0 ELSE 0.0 END) AS z, avg((confirm_time - reference_time) / 1e9) AS s FROM z GROUP BY day) SELECT CAST(day AS VARCHAR) AS day, 'avg_os_magnitude_near_theta' AS test, round(a, 8) AS value FROM r UNION ALL SELECT CAST(day AS VARCHAR), 'avg_tmv_near_2theta', round(b, 8) FROM r UNION ALL SELECT CAST(day AS VARCHAR), 'zero_os_rate_bounded', round(z, 8) FROM r UNION ALL SELECT CAST(day AS VARCHAR), 'dc_duration_distribution', round(s, 3) FROM r")
def dq_scale_laws(spark, d):
    r = quality.scale_results(analysis.with_day(priorities(spark, d)), THETA)
    return r.select("day", "test", F.when(c("test") == "dc_duration_distribution", F.round("value", 3)).otherwise(F.round("value", 8)).alias("value"))


@query(f"{O} SELECT CAST(2 * count(*) FILTER (WHERE event_seq % 5 = 2) + count(*) FILTER (WHERE event_seq % 5 = 3) AS BIGINT) AS n_affected, count(*) FILTER (WHERE event_seq % 5 IN (2, 3)) = 0 AS passed FROM silver")
def dq_determinism(spark, d):
    """Events that segmenting again must not give back: some with another price (counted on both sides), some left out."""
    t = bronze.orders_by_priority(spark, d)
    was = segment(t, THETA).filter("event_seq % 5 <> 3").withColumn("confirm_price", F.when(c("event_seq") % 5 == 2, c("confirm_price") + 1).otherwise(c("confirm_price")))
    return quality.determinism_results(t, was, THETA).select("n_affected", "passed")


#: Of the checks of prices and thresholds over damaged events: how many days pass, by severity.
ROLLED = {k.name: k.severity for k in quality.ROW_CHECKS if k.name in (*BAD["dq_price"], *BAD["dq_threshold"])}
_EACH = " UNION ALL ".join(f"SELECT '{ROLLED[t]}' AS severity, day, count(*) FILTER (WHERE {sql}) = 0 AS passed FROM z GROUP BY day" for t, sql in (BAD["dq_price"] | BAD["dq_threshold"]).items())


@query(f"{DAMAGED}, r AS ({_EACH}) SELECT count(*) AS n_results, count(*) FILTER (WHERE severity <> 'info' AND passed) AS n_passed, count(*) FILTER (WHERE severity <> 'info' AND NOT passed) AS n_failed, count(*) FILTER (WHERE severity = 'critical' AND NOT passed) AS failed_critical, count(*) FILTER (WHERE severity = 'high' AND NOT passed) AS failed_high, count(*) FILTER (WHERE severity = 'medium' AND NOT passed) AS failed_medium, round(count(*) FILTER (WHERE severity <> 'info' AND passed)::DOUBLE / count(*) FILTER (WHERE severity <> 'info'), 9) AS score FROM r")
def dq_rollup(spark, d):
    checks = [k for k in quality.ROW_CHECKS if k.name in ROLLED]
    r = quality.rollup(quality.row_results(analysis.with_day(damaged(priorities(spark, d))), THETA, checks=checks))
    return r.select("n_results", "n_passed", "n_failed", "failed_critical", "failed_high", "failed_medium", F.round("score", 9).alias("score"))


# -- analyses

LIVE = f"{O}, q AS (SELECT *, CAST(make_timestamp(confirm_time // 1000) AS DATE) AS day, extreme_time = confirm_time AS zero, {MOVE} AS chg, CASE WHEN extreme_time <> confirm_time THEN {OVER} END AS os FROM silver WHERE extreme_price <> -1)"
PROFILE = "SELECT day, count(*) AS n_events, count(*) FILTER (WHERE zero) AS n_zero_os, avg(CASE WHEN zero THEN 1.0 ELSE 0.0 END) AS zero_os_rate, avg(chg) AS mean_dc, avg(os) AS mean_os, avg(chg + coalesce(os, 0)) AS mean_tmv, stddev_pop(os) AS std_os, median(os) AS median_os, min(os) AS min_os, max(os) AS max_os FROM q GROUP BY day"
PROFILE_COLS = ["zero_os_rate", "mean_dc", "mean_os", "mean_tmv", "std_os", "median_os", "min_os", "max_os"]


@query(f"{LIVE} SELECT CAST(day AS VARCHAR) AS day, n_events, n_zero_os, {', '.join(f'round({x}, 8) AS {x}' for x in PROFILE_COLS)} FROM ({PROFILE}) x")
def scale_profile(spark, d):
    p = analysis.scale_profile(analysis.with_day(priorities(spark, d)))
    return p.select(c("day").cast("string").alias("day"), "n_events", "n_zero_os", *(F.round(x, 8).alias(x) for x in PROFILE_COLS))


@query(f"{LIVE}, p AS (SELECT ticker, unnest([0.05::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.95::DOUBLE]) AS share, unnest(quantile_cont(os, [0.05, 0.25, 0.5, 0.75, 0.95])) AS value FROM q GROUP BY ticker) SELECT ticker, share, round(value, 8) AS value FROM p")
def os_percentiles(spark, d):
    return analysis.os_percentiles(priorities(spark, d), ["ticker"], (0.05, 0.25, 0.5, 0.75, 0.95)).withColumn("value", F.round("value", 8))


@query(f"{LIVE} SELECT ticker, round(avg(CASE WHEN os < 0.25 THEN 1.0 ELSE 0.0 END), 9) AS below_half_theta, round(avg(CASE WHEN os < 0.5 THEN 1.0 ELSE 0.0 END), 9) AS below_theta FROM q WHERE NOT zero GROUP BY ticker")
def os_below_theta(spark, d):
    return analysis.os_below_theta(priorities(spark, d), THETA, ["ticker"]).select("ticker", F.round("below_half_theta", 9).alias("below_half_theta"), F.round("below_theta", 9).alias("below_theta"))


@query(f"{LIVE}, pr AS ({PROFILE}) SELECT count(*) AS n_days, round(avg(mean_os), 8) AS mean, round(median(mean_os), 8) AS median, round(min(mean_os), 8) AS min, round(max(mean_os), 8) AS max, round(stddev_pop(mean_os), 8) AS std, count(*) FILTER (WHERE mean_os < 0.25) AS days_below, round((avg(mean_os) - 0.5) / 0.5, 8) AS deviation FROM pr")
def month_summary(spark, d):
    m = analysis.month_summary(analysis.scale_profile(analysis.with_day(priorities(spark, d))), THETA)
    return m.select("n_days", *(F.round(x, 8).alias(x) for x in ("mean", "median", "min", "max", "std", "deviation")), "days_below")


@query(f"{O} SELECT ticker, event_seq, CASE WHEN abs(extreme_price - confirm_price) < 1e-6 THEN 'zero_overshoot' WHEN confirm_time = extreme_time THEN 'same_instant' ELSE 'out_of_order' END AS reason FROM silver WHERE extreme_price <> -1 AND confirm_time >= extreme_time")
def bad_order_events(spark, d):
    return analysis.late_confirmations(priorities(spark, d)).select(*KEY, "reason")


# -- frames for charts


@query(f"{U}, ph AS (SELECT e.ticker, CASE WHEN e.event_type = 1 THEN 'Upturn' ELSE 'Downturn' END AS status_cat, t.price FROM silver e JOIN tk t ON t.ticker = e.ticker AND t.i BETWEEN e.dc_start AND e.dc_end UNION ALL SELECT e.ticker, CASE WHEN e.event_type = 1 THEN 'Upward' ELSE 'Downward' END, t.price FROM silver e JOIN tk t ON t.ticker = e.ticker AND t.i > e.dc_end AND t.i <= e.os_end) SELECT ticker, status_cat, count(*) AS n, round(sum(price), 4) AS total FROM ph GROUP BY ticker, status_cat")
def viz_status(spark, d):
    bt = bronze.events_by_user(spark, d)
    p = analysis.tick_phases(bt, segment(bt, THETA)).withColumn("status_cat", analysis.status(c("dc_interval_type")))
    return p.groupBy("ticker", "status_cat").agg(F.count("*").alias("n"), F.round(F.sum("price"), 4).alias("total"))


@query(f"{U}, r AS (SELECT min(confirm_time) AS a, max(confirm_time) AS b FROM silver) SELECT k * 43200000000000 AS time, CASE WHEN k % 2 = 0 THEN 'midnight' ELSE 'noon' END AS marker FROM (SELECT unnest(generate_series((a + 43199999999999) // 43200000000000, b // 43200000000000)) AS k FROM r) x")
def viz_markers(spark, d):
    return analysis.day_markers(users(spark, d))


@query(f"{U} SELECT ticker, event_idx, ext_price, ext_time, next_ext_price, next_ext_time, type_desc FROM (SELECT ticker, event_seq AS event_idx, extreme_price AS ext_price, extreme_time AS ext_time, lead(extreme_price) OVER w AS next_ext_price, lead(extreme_time) OVER w AS next_ext_time, CASE WHEN event_type = 1 THEN 'Upturn' ELSE 'Downturn' END AS type_desc FROM silver WINDOW w AS (PARTITION BY ticker ORDER BY event_seq)) x WHERE next_ext_time IS NOT NULL")
def viz_segments(spark, d):
    return analysis.segments(users(spark, d)).select("ticker", "event_idx", "ext_price", "ext_time", "next_ext_price", "next_ext_time", "type_desc")


@query(f"{U} SELECT ticker, event_seq, 'change' AS phase, least(reference_price, confirm_price) AS y0, greatest(reference_price, confirm_price) AS y1, round((confirm_time - reference_time) / 3.6e12, 6) AS hours FROM silver WHERE extreme_price <> -1 UNION ALL SELECT ticker, event_seq, 'overshoot', least(confirm_price, extreme_price), greatest(confirm_price, extreme_price), round((extreme_time - confirm_time) / 3.6e12, 6) FROM silver WHERE extreme_price <> -1")
def viz_boxes(spark, d):
    return analysis.boxes(users(spark, d)).select(*KEY, "phase", "y0", "y1", F.round("hours", 6).alias("hours"))


@query(f"{U}, e0 AS (SELECT *, CASE WHEN extreme_price <> -1 THEN extreme_time ELSE confirm_time END AS xt FROM silver), e AS (SELECT *, coalesce(lead(xt) OVER (PARTITION BY ticker ORDER BY event_seq), xt) AS nt FROM e0), r AS (SELECT ticker, min(xt) AS a, max(nt) AS b FROM e WHERE event_seq BETWEEN 2 AND 5 GROUP BY ticker), s AS (SELECT *, least(greatest(b - a, 3600000000000), 604800000000000) AS span, a + (b - a) // 2 AS m, (b - a < 3600000000000 OR b - a > 604800000000000) AS wide FROM r) SELECT ticker, CASE WHEN wide THEN m - span // 2 ELSE a END AS start, CASE WHEN wide THEN m - span // 2 + span ELSE b END AS \"end\" FROM s")
def viz_window(spark, d):
    return analysis.event_range(users(spark, d), 2, 5).select("ticker", "start", "end")


@query(f"{U}, l AS (SELECT ticker, min(least(reference_price, confirm_price, CASE WHEN extreme_price <> -1 THEN extreme_price END)) AS lo, max(greatest(reference_price, confirm_price, CASE WHEN extreme_price <> -1 THEN extreme_price END)) AS hi FROM silver GROUP BY ticker), t0 AS (SELECT ticker, min(price) AS tl, max(price) AS th FROM tk GROUP BY ticker), l2 AS (SELECT ticker, least(lo, tl) AS lo, greatest(hi, th) AS hi FROM l JOIN t0 USING (ticker)) SELECT ticker, round(lo - greatest((hi - lo) * 0.08, 35.0), 6) AS y0, round(hi + greatest((hi - lo) * 0.08, 35.0), 6) AS y1 FROM l2")
def viz_ylim(spark, d):
    return analysis.y_limits(users(spark, d), bronze.events_by_user(spark, d)).select("ticker", F.round("y0", 6).alias("y0"), F.round("y1", 6).alias("y1"))


@query(f"{U}, r AS (SELECT min(confirm_time)::DOUBLE AS x0, max(confirm_time)::DOUBLE AS x1, min(confirm_price) AS y0, max(confirm_price) AS y1 FROM silver) SELECT least(floor((confirm_time::DOUBLE - x0) / (x1 - x0) * 40), 39)::BIGINT AS px, least(floor((confirm_price - y0) / (y1 - y0) * 20), 19)::BIGINT AS py, event_type::BIGINT AS event_type, count(*) AS n FROM silver, r GROUP BY ALL")
def viz_raster(spark, d):
    r = analysis.raster(users(spark, d), "confirm_time", "confirm_price", "event_type", 40, 20)
    return r.select(c("px").cast("bigint").alias("px"), c("py").cast("bigint").alias("py"), c("event_type").cast("bigint").alias("event_type"), "n")


@query(f"{O}, n AS (SELECT ticker, count(*) AS m FROM silver GROUP BY ticker) SELECT ticker, event_seq FROM silver JOIN n USING (ticker) WHERE event_seq % CAST(ceil(m / 30.0) AS BIGINT) = 0")
def viz_sample(spark, d):
    return analysis.every_nth(priorities(spark, d)).select(*KEY)


@query(f"{O}, g AS (SELECT *, coalesce(CASE WHEN lag(event_type) OVER w <> event_type THEN 1 ELSE 0 END, 0) AS n FROM silver WINDOW w AS (PARTITION BY ticker ORDER BY event_seq)), h AS (SELECT *, sum(n) OVER (PARTITION BY ticker ORDER BY event_seq) AS run FROM g) SELECT ticker, run::BIGINT AS run, event_type::BIGINT AS event_type, min(event_seq) AS first, max(event_seq) AS last, count(*) AS n FROM h GROUP BY ticker, run, event_type")
def trend_runs(spark, d):
    return analysis.trend_runs(priorities(spark, d)).select("ticker", c("run").cast("bigint").alias("run"), c("event_type").cast("bigint").alias("event_type"), "first", "last", "n")


@query(f"{U}, v AS (SELECT event_type, (confirm_price - reference_price) / nullif(reference_price, 0) AS v FROM silver), r AS (SELECT min(v) AS a, max(v) AS b FROM v) SELECT event_type::BIGINT AS event_type, least(floor((v - a) / (b - a) * 24), 23)::BIGINT AS bin, count(*) AS n FROM v, r WHERE v IS NOT NULL GROUP BY ALL")
def hist_returns(spark, d):
    h = analysis.histogram(users(spark, d), F.try_divide(c("confirm_price") - c("reference_price"), c("reference_price")), 24, "event_type")
    return h.select(c("event_type").cast("bigint").alias("event_type"), c("bin").cast("bigint").alias("bin"), "n")


@query(f"{U} SELECT ticker, count(*) FILTER (WHERE event_type = 1) AS n_up, count(*) FILTER (WHERE event_type = -1) AS n_down FROM silver GROUP BY ticker")
def viz_directions(spark, d):
    return analysis.directions(users(spark, d)).select("ticker", "n_up", "n_down")


@query()
def engine_carry_days(spark, d):
    """Days chained through orphans, reconciled: this mode's chain can't be said in SQL; tests compare it with a loop."""
    e, _ = Engine(THETA, mode="carry_orphans").process_date_range(bronze.events_by_type(spark, d))
    return e.select(*ev(), c("period").cast("string").alias("period"))


@query()
def engine_carry_states(spark, d):
    s = Engine(THETA, mode="carry_orphans").states(bronze.events_by_type(spark, d))
    return s.select("ticker", c("period").cast("string").alias("period"), "n_ticks", "n_events", "current_trend", F.size("orphan_price").alias("n_orphans"))


@query(f"{oracle.silver('events_by_type', (THETA,))} SELECT strftime(date_trunc('month', make_timestamp(confirm_time // 1000)), '%Y-%m-%d') AS period, count(*) AS n_events FROM silver GROUP BY 1")
def engine_months(spark, d):
    e, _ = Engine(THETA).process_date_range(bronze.events_by_type(spark, d), monthly=True)
    return e.groupBy(c("period").cast("string").alias("period")).agg(F.count("*").alias("n_events"))


# -- tables on disk, states, periods


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the place that executors share, for a query that writes a table and reads it back."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{top.rstrip('/')}/seiche-{name}-{uuid.uuid4().hex}"


@query(f"{oracle.silver('events_by_type', (THETA,))} SELECT {EV_SQL}, strftime(make_timestamp(confirm_time // 1000), '%Y-%m-%d') AS period FROM silver WHERE strftime(make_timestamp(confirm_time // 1000), '%Y-%m') = '2024-01' AND day(make_timestamp(confirm_time // 1000)) BETWEEN 5 AND 20")
def table_roundtrip(spark, d):
    """Events written by day, and those of some days read back."""
    base = _folder(spark, "silver")
    silver.write(Engine(THETA).events(bronze.events_by_type(spark, d)), base)
    return silver.read(spark, base, theta=THETA, year=2024, month=1, day_start=5, day_end=20).select(*ev(), c("period").cast("string").alias("period"))


@query(f"{O} SELECT ticker, event_seq, confirm_price FROM silver WHERE ticker = '1-URGENT' AND strftime(make_timestamp(confirm_time // 1000), '%Y-%m') = (SELECT min(strftime(make_timestamp(confirm_time // 1000), '%Y-%m')) FROM silver WHERE ticker = '1-URGENT')")
def table_month(spark, d):
    """The first month of a key, from a table of months whose layout is found, with its one threshold."""
    base = _folder(spark, "months")
    silver.write(Engine(THETA).events(bronze.orders_by_priority(spark, d), monthly=True), base, monthly=True)
    first = silver.read(spark, base, "1-URGENT").agg(F.min("period")).first()[0]
    e, theta = silver.read_dc_month(spark, base, "1-URGENT", first.year, first.month)
    return e.filter(c("theta") == theta).select("ticker", "event_seq", "confirm_price")


@query(f"{DS} SELECT ticker, CAST(period AS VARCHAR) AS period, CASE WHEN day(period) % 2 = 0 THEN 1 ELSE -1 END::BIGINT AS current_trend, price AS orphan, 0::BIGINT AS n_ticks FROM ds")
def state_roundtrip(spark, d):
    """States saved without the columns that may be missing, and loaded."""
    path = _folder(spark, "states")
    state.save(_daily_states(spark, d), path)
    return state.load(spark, path, theta=THETA).select("ticker", c("period").cast("string").alias("period"), c("current_trend").cast("bigint").alias("current_trend"), F.get("orphan_price", F.lit(0)).alias("orphan"), "n_ticks")


@query(f"{DS}, m AS (SELECT date_trunc('month', max(period)) AS first FROM ds) SELECT ticker, CAST(period AS VARCHAR) AS period FROM ds, m WHERE date_trunc('month', period) = first")
def state_previous_month(spark, d):
    """What the month after the last one is carried on from."""
    s = _daily_states(spark, d)
    last = s.agg(F.max("period")).first()[0]
    after = (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return state.previous_month(s, after.year, after.month).select("ticker", c("period").cast("string").alias("period"))


@query(f"{DS} SELECT ticker, CAST(period AS VARCHAR) AS period, 1::BIGINT AS n_orphans, 73::BIGINT AS bytes FROM ds")
def state_catalogue(spark, d):
    return state.catalogue(_daily_states(spark, d)).select("ticker", c("period").cast("string").alias("period"), c("n_orphans").cast("bigint").alias("n_orphans"), c("bytes").cast("bigint").alias("bytes"))


@query(f"{DS} SELECT ticker, count(*) AS n_states, CAST(73 * count(*) AS BIGINT) AS bytes, CAST(min(period) AS VARCHAR) AS first, CAST(max(period) AS VARCHAR) AS last FROM ds GROUP BY ticker")
def state_stats(spark, d):
    return state.stats(_daily_states(spark, d)).select("ticker", "n_states", "bytes", c("first").cast("string").alias("first"), c("last").cast("string").alias("last"))


@query(f"{DS} SELECT ticker, CAST(period AS VARCHAR) AS period FROM ds WHERE day(period) % 3 = 0 OR day(period) % 5 = 0 AND day(period) % 3 <> 0")
def state_invalid(spark, d):
    """States with a trend that is none, or times that fall."""
    s = _daily_states(spark, d)
    third, fifth = F.dayofmonth("period") % 3 == 0, F.dayofmonth("period") % 5 == 0
    bad = s.withColumn("current_trend", F.when(third, 7).otherwise(c("current_trend")))
    twice = lambda x: F.when(fifth, F.concat(x, x)).otherwise(c(x))
    bad = bad.withColumns({x: twice(x) for x in ("orphan_price", "orphan_qty", "orphan_dir")}).withColumn("orphan_time", F.when(fifth, F.concat("orphan_time", F.transform("orphan_time", lambda t: t - 1))).otherwise(c("orphan_time")))
    return state.validate(bad).select("ticker", c("period").cast("string").alias("period"))


MONTH = oracle.silver("events_by_type", (THETA,)).replace("FROM events)", "FROM events WHERE date_trunc('month', ts) = (SELECT date_trunc('month', min(ts)) FROM events))")
FIRST_DAY = oracle.silver("events_by_type", (THETA,)).replace("FROM events)", "FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(min(ts) AS DATE) FROM events))")


def _first_time(t: DataFrame):
    return dt.date(1970, 1, 1) + dt.timedelta(days=t.agg(F.min("time")).first()[0] // 86_400_000_000_000)


@query(f"{MONTH} SELECT {EV_SQL} FROM silver")
def engine_month(spark, d):
    t = bronze.events_by_type(spark, d)
    first = _first_time(t)
    return Engine(THETA).process_month(t, first.year, first.month)[0].select(*ev())


@query(f"{FIRST_DAY} SELECT {EV_SQL} FROM silver")
def engine_day(spark, d):
    t = bronze.events_by_type(spark, d)
    return Engine(THETA).process_day(t, _first_time(t))[0].select(*ev())


@query(f"{COMPARED} SELECT ticker, CAST(day AS VARCHAR) AS day, round(discrepancy_rate, 9) AS discrepancy_rate FROM cmp WHERE ticker = (SELECT min(ticker) FROM cmp) ORDER BY discrepancy_rate DESC, day LIMIT 5")
def converge_worst_days(spark, d):
    """A top-5 report of one key, ties by day."""
    r = _two_runs(spark, d)
    least = r.agg(F.min("ticker")).first()[0]
    return converge.worst_days(r.filter(c("ticker") == least), 5).select("ticker", c("day").cast("string").alias("day"), F.round("discrepancy_rate", 9).alias("discrepancy_rate"))


@query(f"{U}, r AS (SELECT ticker, reference_time AS time, reference_price AS ref, lead(reference_time) OVER (PARTITION BY ticker ORDER BY event_seq) AS until FROM silver) SELECT tk.ticker, count(*) AS n, round(sum(abs(price - ref) / nullif(ref * {THETA}::DOUBLE, 0)), 4) AS total FROM tk ASOF JOIN r ON tk.ticker = r.ticker AND tk.time >= r.time GROUP BY tk.ticker")
def tick_tmv(spark, d):
    t = bronze.events_by_user(spark, d)
    return ind.tick_tmv(t, segment(t, THETA)).groupBy("ticker").agg(F.count("*").alias("n"), F.round(F.sum("atmv"), 4).alias("total"))


@query(f"{U}, w AS (SELECT min(confirm_time) AS a, max(confirm_time) AS b FROM silver) SELECT ticker, count(*) AS ndc, CAST(sum(event_type * (confirm_time - reference_time)) AS BIGINT) AS accumulated_time FROM silver, w WHERE confirm_time BETWEEN a + (b - a) // 4 AND a + (b - a) // 2 GROUP BY ticker")
def ind_windowed(spark, d):
    e = users(spark, d)
    a, b = e.agg(F.min("confirm_time"), F.max("confirm_time")).first()
    return ind.windowed_counts(e, a + (b - a) // 4, a + (b - a) // 2).select("ticker", "ndc", "accumulated_time")


@query(f"{U}, v AS (SELECT (confirm_time - reference_time) / 1e9 AS v FROM silver), r AS (SELECT min(v) AS a, max(v) AS b, avg(v) AS m FROM v) SELECT least(floor((v - a) / (b - a) * 30), 29)::BIGINT AS bin, count(*) AS n, round(min(m), 3) AS mean FROM v, r GROUP BY 1")
def hist_durations(spark, d):
    return analysis.durations(users(spark, d)).select(c("bin").cast("bigint").alias("bin"), "n", F.round("mean", 3).alias("mean"))


@query(f"{O} SELECT ticker, event_type::BIGINT AS event_type, count(*) AS n, CAST(min(event_seq) AS BIGINT) AS first, CAST(sum(event_seq * event_seq) AS BIGINT) AS squares FROM silver GROUP BY ALL")
def viz_positions(spark, d):
    p = analysis.positions(priorities(spark, d))
    squares = F.aggregate("positions", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    return p.select("ticker", c("event_type").cast("bigint").alias("event_type"), F.size("positions").cast("bigint").alias("n"), F.get("positions", F.lit(0)).alias("first"), squares.alias("squares"))
