"""Reprocessing chains: each record names the one it follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def chain_conflicts(records: DataFrame) -> DataFrame:
    """(record, error): records with several followers (fork) or whose parent is unknown (orphan)."""
    fork = records.where("parent is not null").groupBy(F.col("parent").alias("record")).agg(F.count("*").alias("n")).where("n > 1").select("record", F.lit("fork").alias("error"))
    known = records.select(F.col("record").alias("parent"))
    orphan = records.where("parent is not null").join(known, "parent", "left_anti").select("record", F.lit("orphan").alias("error"))
    return fork.unionByName(orphan)


def chain_depths(records: DataFrame, most_doublings: int = 40) -> DataFrame:
    """(record, root, depth) of linear chains.  Self-joins that double their reach take the logarithm
    of the longest chain; records in a circle have no root and are left out with a null root.

    A round in which no record reaches an end leaves only records whose reach stays among themselves: circles
    and what follows them, which no further round would settle."""
    from tessera.sources.commit import staged

    step, _ = staged(records.select("record", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("depth"), F.when(F.col("parent").isNull(), F.col("record")).alias("root")), "chains")
    before = -1
    for _ in range(most_doublings):
        still = step.where("up is not null")
        left = still.count()
        if left in (0, before):
            break
        before = left
        above = step.select(F.col("record").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("root").alias("above_root"))
        moved = still.join(above, "up", "left").select("record", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("above_root", F.when(F.col("more").isNull(), F.col("up"))).alias("root"))
        step, _ = staged(step.where("up is null").unionByName(moved), "chains")
    return step.select("record", "root", "depth")


def chain_circles(records: DataFrame) -> DataFrame:
    """(record, error): records that follow each other in a circle, or follow one that does."""
    return chain_depths(records).where("root is null").select("record", F.lit("circle").alias("error"))


def latest_record(depths: DataFrame) -> DataFrame:
    """(root, latest, length): the tail of each chain."""
    return depths.where("root is not null").groupBy("root").agg(F.max_by("record", F.struct("depth", "record")).alias("latest"), (F.max("depth") + 1).alias("length"))


def linear_chains(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Records (record, parent) of rows that follow each other within a key."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.select(F.col(order[-1]).alias("record"), F.lag(order[-1]).over(w).alias("parent"))
