"""Run metrics, job states, logs and feedback."""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def history(metrics: DataFrame, run_id: int, metric: str) -> DataFrame:
    return metrics.filter((F.col("run_id") == run_id) & (F.col("metric") == metric)).orderBy("step")


def run_summary(metrics: DataFrame, names: list[str], runs: DataFrame | None = None) -> DataFrame:
    """Seconds and last value of every metric, one row a run; with runs (run_id, finished_at, success) its status too.

    A run is RUNNING until it is finished, then FINISHED or FAILED; UNKNOWN where runs lacks it.
    """
    last = metrics.groupBy("run_id").pivot("metric", names).agg(F.max_by("value", "step"))
    span = metrics.groupBy("run_id").agg(((F.unix_micros(F.max(F.to_timestamp("ts"))) - F.unix_micros(F.min(F.to_timestamp("ts")))) / 1e6).alias("seconds"))
    out = span.join(last, "run_id")
    if runs is None:
        return out
    status = F.when(F.col("finished_at").isNull(), "RUNNING").when(F.col("success"), "FINISHED").otherwise("FAILED")
    return out.join(runs.select("run_id", status.alias("status")), "run_id", "left").fillna("UNKNOWN", ["status"])


def every_nth(metrics: DataFrame, n: int = 10, from_first: bool = False) -> DataFrame:
    """Steps that n divides; from_first: the first step of a series and every n after it."""
    if not from_first:
        return metrics.filter(F.col("step") % n == 0)
    low = F.min("step").over(Window.partitionBy("run_id", "metric"))
    return metrics.withColumn("_low", low).filter((F.col("step") - F.col("_low")) % n == 0).drop("_low")


def state_counts(jobs: DataFrame, states: list[str]) -> DataFrame:
    """One row with a count for each state."""
    return jobs.agg(*(F.count_if(F.col("state") == s).alias(s) for s in states))


def latency_histogram(jobs: DataFrame, low: float, high: float, n: int) -> DataFrame:
    """bucket (0 below, n + 1 above) and its rows."""
    return jobs.groupBy(F.width_bucket("latency", F.lit(low), F.lit(high), F.lit(n)).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def tail(log: DataFrame, n: int) -> DataFrame:
    """The last n lines of every job."""
    w = Window.partitionBy("job").orderBy(F.desc("line_no"))
    return log.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


#: Parts into which a group's values are cut before any of them is ordered.
PARTS = 100


def exact_percentiles(df: DataFrame, key: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """For every group the smallest value that covers each share of its rows, null values aside; no task orders a whole group.

    Approximate percentiles cut a group into PARTS; the parts are counted, and only the one in which a share is reached is
    ordered.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*key, value)
    cuts = rows.groupBy(*key).agg(F.percentile_approx(value, [i / PARTS for i in range(1, PARTS)], 1000).alias("_cuts"), F.count(F.lit(1)).alias("_all"))
    each = rows.groupBy(*key, value).agg(F.count(F.lit(1)).alias("_k")).join(cuts, key)
    each = each.withColumn("_part", F.size(F.filter("_cuts", lambda x: x < F.col(value)))).drop("_cuts")
    sizes = each.groupBy(*key, "_all", "_part").agg(F.sum("_k").alias("_own"))
    upto = F.sum("_own").over(Window.partitionBy(*key).orderBy("_part"))
    places = [F.ceil(F.col("_all") * p) for p in shares.values()]
    sizes = sizes.withColumns({"_end": upto, "_begin": upto - F.col("_own")})
    holds = functools.reduce(Column.__or__, [(F.col("_begin") < x) & (x <= F.col("_end")) for x in places])
    near = each.join(sizes.filter(holds).select(*key, "_part", "_begin"), [*key, "_part"])
    near = near.withColumn("_upto", F.col("_begin") + F.sum("_k").over(Window.partitionBy(*key, "_part").orderBy(value)))
    reached = lambda x: F.min(F.when((F.col("_begin") < x) & (F.col("_upto") >= x), F.col(value)))
    return near.groupBy(*key).agg(*(reached(x).alias(n) for n, x in zip(shares, places)))


#: Size of a sketch: its quantiles are within RANK_ERROR of all rows of the true place (99 % of sketches).
SKETCH, RANK_ERROR = 400, 0.0085


def daily_sketches(df: DataFrame, key: list[str], value: str, ts: str) -> DataFrame:
    """key, day, sketch (KLL) of the values of a day; a new day is a new row, and older ones needn't be read again."""
    return df.groupBy(*key, F.to_date(ts).alias("day")).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH)).alias("sketch"))


def merged_percentiles(sketches: DataFrame, key: list[str], shares: dict[str, float]) -> DataFrame:
    """Values near each share over all days, and how many rows they stand for; within RANK_ERROR."""
    whole = sketches.groupBy(*key).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH)).alias("_s"))
    return whole.select(*key, F.kll_sketch_get_n_double("_s").alias("n"), *(F.kll_sketch_get_quantile_double("_s", F.lit(p)).alias(n) for n, p in shares.items()))


def feedback_summary(feedback: DataFrame) -> DataFrame:
    """Ratings, latency percentiles and tokens of each model and version.

    Percentiles are exact; for running ones over days see daily_sketches.
    """
    key = ["model_name", "version"]
    sums = feedback.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("rating"), 6).alias("mean_rating"), F.max("latency").alias("max_latency"),
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
    )
    marks = exact_percentiles(feedback, key, "latency", {"median_latency": 0.5, "p95_latency": 0.95})
    return sums.join(marks, key, "left")
