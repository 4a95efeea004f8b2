"""Run, feed, error and delivery metrics as aggregates over the log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .ordinal import with_ordinal


def events_per_feed(run_log: DataFrame) -> DataFrame:
    return run_log.groupBy("feed").agg(F.count(F.lit(1)).alias("runs"),
                                       F.sum("event_count").cast("bigint").alias("events"))


def events_rollup(run_log: DataFrame) -> DataFrame:
    """Feed -> group -> run totals in one pass (ROLLUP + grouping_id)."""
    return run_log.rollup("feed_group", "feed").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count(F.lit(1)).alias("runs"),
        F.sum("event_count").cast("bigint").alias("events"))


def run_summary(run_log: DataFrame, error_log: DataFrame, elapsed_s: float | None = None) -> DataFrame:
    """Feeds, events, errors, elapsed and rate in one aggregate over both logs.

    ``elapsed_s`` is the run's wall time; without it the feeds' durations are summed.
    The rate divides by the exact elapsed time; only the shown column is in whole seconds.
    """
    runs = run_log.select("feed", "event_count", F.col("duration_s").cast("double").alias("duration_s"),
                          F.lit(0).alias("_err"))
    errs = error_log.select(F.lit(None).cast("string").alias("feed"), F.lit(None).cast("bigint").alias("event_count"),
                            F.lit(None).cast("double").alias("duration_s"), F.lit(1).alias("_err"))
    elapsed = F.coalesce(F.sum("duration_s"), F.lit(0.0)) if elapsed_s is None else F.lit(float(elapsed_s))
    agg = runs.unionByName(errs).agg(
        F.countDistinct("feed").alias("feeds"),
        F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint").alias("total_events"),
        F.sum("_err").cast("bigint").alias("total_errors"), elapsed.alias("_elapsed"))
    return agg.select("feeds", "total_events", "total_errors", F.col("_elapsed").cast("bigint").alias("elapsed_s"),
                      X.floored_rate("total_events", "_elapsed", 2).alias("events_per_sec"))


def errors_per_feed(error_log: DataFrame, feed_col: str = "feed_no") -> DataFrame:
    return error_log.groupBy(feed_col).agg(F.count(F.lit(1)).alias("errors"))


def errors_recent(error_log: DataFrame, n: int = 10, id_col: str = "error_id") -> DataFrame:
    """The ``n`` most recent errors (plans to TakeOrderedAndProject: top-k per task, then merge)."""
    return error_log.orderBy(F.col("ts").desc(), F.col(id_col).desc()).limit(n)


def delivery_metrics(delivery_log: DataFrame) -> DataFrame:
    s = F.col("status_code")
    outcome = X.delivery_outcome(s)
    return delivery_log.agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum(F.when(s == 200, F.col("event_count")).otherwise(0)).cast("bigint").alias("events_sent"),
        F.sum(F.when(outcome == "retryable", 1).otherwise(0)).cast("bigint").alias("retries"),
        F.sum(F.when(s.isNull() | (s != 200), 1).otherwise(0)).cast("bigint").alias("errors"),
        F.sum(F.when(X.is_throttle(s), 1).otherwise(0)).cast("bigint").alias("throttles"))


def throughput_profile(delivery_log: DataFrame) -> DataFrame:
    st = X.throughput_status("delay_ms")
    return delivery_log.groupBy(st.alias("status")).agg(
        F.count(F.lit(1)).alias("batches"), F.round(F.avg("delay_ms"), 3).alias("avg_delay_ms"))


def progress_rows(run_log: DataFrame, interval: int, order_cols=("ts", "run_id"),
                  count_col: str = "n", ts_col: str = "ts") -> DataFrame:
    """A progress row every ``interval`` events with the running rate.

    The running count is the exact distributed ordinal; elapsed time is measured
    from the first event (a global ``min``, one tiny aggregate).
    """
    ranked = with_ordinal(run_log, list(order_cols), name=count_col)
    t0 = run_log.agg(X.epoch_micros(F.min(ts_col))).first()[0]   # one-row scalar
    marks = ranked.filter(F.col(count_col) % F.lit(int(interval)) == 0)
    elapsed = (X.epoch_micros(ts_col) - F.lit(t0 if t0 is not None else 0)).cast("double") / F.lit(1e6)
    return marks.select(count_col, F.round(elapsed, 3).alias("elapsed_s"),
                        X.guarded_rate(F.col(count_col), elapsed, 2).alias("rate"))


def delivery_progress(delivery_log: DataFrame, tick_s: int, by=("scope",), ts_col: str = "ts") -> DataFrame:
    """Running totals of a delivery, a row per ``tick_s`` seconds in which a batch was answered.

    Every batch is added to its tick (combined in the tasks); only ticks, whose number is bounded by the run's length,
    are put in order. Elapsed time runs from the first answer of the scope to the last one of the tick.
    """
    by, us = list(by), X.epoch_micros(ts_col)
    ok = F.col("status_code") == 200
    ticks = delivery_log.filter(F.col(ts_col).isNotNull()).groupBy(
        *by, F.floor(us / F.lit(int(tick_s) * 1_000_000)).cast("bigint").alias("tick")).agg(
        F.coalesce(F.sum(F.when(ok, F.col("event_count"))), F.lit(0)).cast("bigint").alias("events"),
        F.sum(F.when(ok, 0).otherwise(1)).cast("bigint").alias("errors"), F.min(us).alias("_first"), F.max(us).alias("_last"))
    upto = Window.partitionBy(*by).orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    elapsed = (F.col("_last") - F.min("_first").over(upto)).cast("double") / F.lit(1e6)
    total = F.sum("events").over(upto).cast("bigint")
    return ticks.select(*by, "tick", "events", "errors", total.alias("total"), elapsed.alias("_elapsed")).select(
        *by, "tick", "events", "errors", "total", F.round("_elapsed", 3).alias("elapsed_s"),
        X.guarded_rate("total", "_elapsed", 2).alias("rate"))


def feed_completion(run_log: DataFrame, duration_col: str = "duration", digits: int = 0) -> DataFrame:
    """Per feed: processed vs sent (they differ when batches fail), minutes, events/s (whole, or ``digits``)."""
    agg = run_log.groupBy("feed").agg(F.sum("event_count").cast("bigint").alias("processed"),
                                      F.sum("sent").cast("bigint").alias("sent"),
                                      F.sum(duration_col).alias("_dur"))
    return agg.select("feed", "processed", "sent", F.round(F.col("_dur").cast("double") / 60.0, 1).alias("minutes"),
                      X.guarded_rate("processed", "_dur", digits).alias("rate"))
