"""Score changes that grow by shards, without the snapshots of the shards before.

A series is kept as moments: how many points, the means of time and score, the sums of squared and of
multiplied deviations from them, and the extremes. Two such rows of one series give the row of
both: deviations are about each part's own means, and the difference of the means comes in
once, so large times (epoch seconds) cost no digits. A shard is reduced to its moments with map-side
partials, merged with the stored row of each series, and the result is the state after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..state import State
from .movies import score_points

KEY = ["name", "kind"]
MOMENTS = ["points", "ts_mean", "score_mean", "ts_squares", "products", "lowest", "highest"]
_SCHEMA = "name string, kind string, points bigint, " + ", ".join(f"{c} double" for c in MOMENTS[1:])


def series_moments(scores: DataFrame, kinds=("critics", "audience")) -> DataFrame:
    """``name, kind`` and the moments of every series of some snapshots."""
    n = F.count("*")
    return score_points(scores, kinds).groupBy(*KEY).agg(
        n.alias("points"), F.avg("ts").alias("ts_mean"), F.avg("score").alias("score_mean"),
        (F.var_pop("ts") * n).alias("ts_squares"), (F.covar_pop("ts", "score") * n).alias("products"),
        F.min("score").alias("lowest"), F.max("score").alias("highest"),
    )


def merged(left: DataFrame, right: DataFrame) -> DataFrame:
    """The moments of both; each has at most one row a series."""
    a, b = left.alias("a"), right.alias("b")
    both = a.join(b, KEY, "full")

    def l(name: str) -> Column:  # noqa: E743
        return F.coalesce(F.col(f"a.{name}"), F.lit(0))

    def r(name: str) -> Column:
        return F.coalesce(F.col(f"b.{name}"), F.lit(0))

    n = l("points") + r("points")
    # The lesser part's share moves the mean of the other, and vice versa.
    part = r("points") / n
    d_ts = F.when(l("points") * r("points") > 0, r("ts_mean") - l("ts_mean")).otherwise(0.0)
    d_score = F.when(l("points") * r("points") > 0, r("score_mean") - l("score_mean")).otherwise(0.0)
    cross = l("points") * part

    def mean(name: str, d: Column) -> Column:
        return F.coalesce(F.col(f"a.{name}") + d * part, F.col(f"b.{name}"))

    return both.select(
        *KEY, n.alias("points"), mean("ts_mean", d_ts).alias("ts_mean"), mean("score_mean", d_score).alias("score_mean"),
        (l("ts_squares") + r("ts_squares") + d_ts * d_ts * cross).alias("ts_squares"),
        (l("products") + r("products") + d_ts * d_score * cross).alias("products"),
        F.least(F.col("a.lowest"), F.col("b.lowest")).alias("lowest"),
        F.greatest(F.col("a.highest"), F.col("b.highest")).alias("highest"),
    )


def add_shard(spark: SparkSession, path: str, scores: DataFrame, shard: int) -> bool:
    """Take a shard of snapshots into the state below ``path``; False if it has been taken."""
    state = State(spark, path)
    commits = state.commits()
    if shard in commits:
        return False
    moments = series_moments(scores)
    if commits:
        moments = merged(state.read("moments", [list(commits)[-1]], _SCHEMA), moments)
    state.write(shard, "moments", moments)
    state.commit(shard)
    return True


def moments_now(spark: SparkSession, path: str) -> DataFrame:
    """The moments of all shards so far: the table that the last one has left."""
    state = State(spark, path)
    return state.read("moments", list(state.commits())[-1:], _SCHEMA)


def changes(moments: DataFrame) -> DataFrame:
    """``name, kind, points, minmax, slope, intercept``, as ``movies.score_changes`` gives them."""
    slope = F.when(F.col("ts_squares") > 0, F.col("products") / F.col("ts_squares"))
    return moments.select(
        *KEY, "points", (F.col("highest") - F.col("lowest")).alias("minmax"), slope.alias("slope"),
        (F.col("score_mean") - slope * F.col("ts_mean")).alias("intercept"),
    )
