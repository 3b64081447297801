"""Connected components as alternating star contractions.

Two DataFrame steps are repeated (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014): every link is moved to the smallest neighbour of
its lower end, then every node's lower neighbours are linked to the smallest of
them. Links only shrink, so the number of rows stays within the input's, and
the number of rounds grows with the logarithm of the diameter.

Both steps are one job, unless a node has so many lower neighbours that its rows
have to be salted. Stars that a round left as they were are put aside, so later
rounds only see groups that are still being joined up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_scratch, scratch_path
from .skew import ROWS_PER_TASK, hot_keys, lookup


def _relinked_high(links: DataFrame, salted: bool, rows_per_task: int) -> DataFrame:
    """Each link's low end replaced by that node's own smallest neighbour."""
    least = links.groupBy("hi").agg(F.min("lo").alias("least"))
    hot = None
    if salted:
        weights = links.groupBy(F.col("lo").alias("key")).agg(F.count("*").alias("n"))
        hot = hot_keys(weights, rows_per_task)
    return lookup(links, "lo", least.withColumnRenamed("hi", "lo"), hot, "hi").select(
        "hi", F.coalesce("least", "lo").alias("lo"), F.col("least").isNotNull().alias("moved")
    )


def _relinked_low(links: DataFrame, salted: bool, rows_per_task: int) -> DataFrame:
    """Each node and its low neighbours linked to the smallest of these."""
    least = links.groupBy("hi").agg(F.min("lo").alias("least"), F.count("*").alias("n"))
    hot = None
    if salted:
        hot = hot_keys(least.select(F.col("hi").alias("key"), "n"), rows_per_task)
    found = lookup(links, "hi", least.drop("n"), hot, "lo")
    moved = F.col("lo") != F.col("least")
    pair = F.struct(F.col("hi").alias("hi"), F.col("least").alias("lo"))
    step = F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return found.select(
        F.explode(F.when(moved, F.array(pair, step)).otherwise(F.array(pair))).alias("link"),
        moved.alias("moved"),
    ).select("link.hi", "link.lo", "moved")


def _relinked(links: DataFrame) -> DataFrame:
    """Both steps at once. ``moved`` is false where neither of them changed any link of ``hi``."""
    least = links.groupBy("hi").agg(F.min("lo").alias("least"))
    high = links.join(least.withColumnRenamed("hi", "lo"), "lo", "left").select(
        "hi", F.coalesce("least", "lo").alias("lo"), F.col("least").isNotNull().alias("moved")
    )
    node = Window.partitionBy("hi")
    found = high.select(
        "hi", "lo", F.min("lo").over(node).alias("least"),
        (F.max("moved").over(node) | (F.min("lo").over(node) != F.max("lo").over(node))).alias("moved"),
    )
    pair = F.struct(F.col("hi").alias("hi"), F.col("least").alias("lo"))
    step = F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return found.select(
        F.explode(F.when(F.col("lo") != F.col("least"), F.array(pair, step)).otherwise(F.array(pair))).alias("link"),
        "moved",
    ).select("link.hi", "link.lo", "moved")


def _relinked_in_steps(links: DataFrame, place: str, rows_per_task: int) -> DataFrame:
    """The same for a table with hot nodes, one salted step after the other."""
    high, moved, _ = _stored(_relinked_high(links, True, rows_per_task), place)
    low = _relinked_low(high, True, rows_per_task)
    # A star is known to be whole only if the first step has left all links as they were.
    return low.withColumn("moved", F.lit(True)) if moved else low


def _is_hot(links: DataFrame, rows: int, rows_per_task: int) -> bool:
    if rows <= rows_per_task:
        return False
    return links.groupBy("hi").count().agg(F.max("count")).first()[0] > rows_per_task


def _parted(links: DataFrame, place: str) -> tuple[DataFrame, DataFrame]:
    """Links that may still move, and those of whole stars.

    The star around a node is whole if no moved link begins or ends there: then its other nodes have
    no link but the one to it, and the first step would have moved any link to one of these there.
    """
    moved = links.filter("moved")
    touched = moved.select(F.explode(F.array("hi", "lo")).alias("lo")).distinct().withColumn("open", F.lit(True))
    marked = links.join(touched, "lo", "left").select(
        "hi", "lo", "moved", (F.col("moved") | F.coalesce("open", F.lit(False))).alias("open")
    )
    marked.write.partitionBy("open").parquet(place)
    every = links.sparkSession.read.schema(marked.schema).parquet(place)
    return tuple(every.filter(F.col("open") == o).select("hi", "lo") for o in (True, False))


def components(
    links: DataFrame, rows_per_task: int = ROWS_PER_TASK, max_rounds: int = 100
) -> DataFrame:
    """``node, root`` for every linked node except the roots themselves.

    ``links`` has two columns of one comparable type. The root is the smallest
    node of its component. Each round is written to the shared scratch
    folder, and the one before is dropped: this cuts the lineage, outlives
    lost executors, and keeps the disk use at two copies of the links.
    """
    spark = links.sparkSession
    place = scratch_path(spark, "components")
    a, b = [F.col(f"`{c}`") for c in links.columns]
    before = f"{place}/links"
    current, _, rows = _stored(
        links.filter(a != b)
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .withColumn("moved", F.lit(False)),
        before,
    )
    whole, bound = [], rows
    for step in range(max_rounds):
        after = f"{place}/{step}"
        current = current.select("hi", "lo")
        if _is_hot(current, rows, rows_per_task):
            relinked = _relinked_in_steps(current, f"{after}-high", rows_per_task)
        else:
            relinked = _relinked(current)
        current, moved, rows = _stored(relinked, after)
        drop_scratch(spark, before)
        drop_scratch(spark, f"{after}-high")
        before = after
        if not moved:
            for part in whole:
                current = part.unionByName(current.select("hi", "lo"))
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        # Parting costs less than a round. The bound keeps it from being tried in vain time and again.
        if 4 * moved < bound:
            bound = moved
            current, rest = _parted(current, f"{after}-parted")
            whole.append(rest)
            before = f"{after}-parted/open=true"
            drop_scratch(spark, after)
            rows = current.count()
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _stored(links: DataFrame, path: str) -> tuple[DataFrame, int, int]:
    """Distinct links written and read back, with the counts of moves and of rows.

    The counts come from the written table, so a task that ran twice cannot
    falsify them; Parquet reads only the flag for it.
    """
    spark = links.sparkSession
    distinct = links.groupBy("hi", "lo").agg(F.max("moved").alias("moved"))
    distinct.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(distinct.schema).parquet(path)
    moved, rows = stored.agg(F.count_if("moved"), F.count("*")).first()
    return stored, moved, rows
