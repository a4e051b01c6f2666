"""Connected components of links by alternating large-star and small-star rounds.

Each round is two grouped minima and two joins; its result is written to the shared folder, so
the lineage stays short and lost executors cost one round at most.  Only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def _stars(pairs: DataFrame, large: bool) -> DataFrame:
    """``pairs`` (u, v): to each v of u the least of u and its neighbours; large: only v > u."""
    both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:
        return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
    moved = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u != v").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> tuple[DataFrame, int]:
    """(node, component) for every node of the links, component being its least node, and the
    number of rounds.  Links with a null end and loops are ignored; none give an empty table."""
    spark = links.sparkSession
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and {a} != {b}").distinct()
    pairs, path = staged(pairs, "links")
    seen = None
    for rounds in range(1, most_rounds + 1):
        pairs, new_path = staged(_stars(_stars(pairs, True), False), "stars")
        discard(spark, path)
        path = new_path
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), rounds
