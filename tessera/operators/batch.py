"""Status ladders and accounts of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAGES = ("input", "extraction", "usage", "l3a", "l3b")
#: precedence of product states, the strongest first
PRECEDENCE = ("pending", "blocked", "failed", "passed")


def item_status(stages: tuple[str, ...] = STAGES) -> Column:
    """pending if a stage is; then blocked over failed over passed.  A stage that a block keeps from
    running counts as not_run and does not hold the item back."""
    cols = [F.col(s) for s in stages]
    any_of = lambda v: F.array_contains(F.array(*cols), v)
    return F.when(any_of("pending"), "pending").when(any_of("blocked"), "blocked").when(any_of("failed"), "failed").otherwise("passed")


def item_reason(stages: tuple[str, ...] = STAGES) -> Column:
    """The first blocked stage, or all failed ones."""
    first = F.coalesce(*(F.when(F.col(s) == "blocked", F.lit(s)) for s in stages))
    failed = F.array_join(F.array_compact(F.array(*(F.when(F.col(s) == "failed", F.lit(s)) for s in stages))), ",")
    return F.coalesce(first, failed)


def product_status(items: DataFrame, key: str = "product_key", status: str = "status") -> DataFrame:
    rank = F.array_position(F.array(*map(F.lit, PRECEDENCE)), F.col(status))
    return items.groupBy(key).agg(F.element_at(F.array(*map(F.lit, PRECEDENCE)), F.min(rank).cast("int")).alias("status"), F.count("*").alias("items"))


def stage_status(items: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """(stage, status, n): stages after the input look only at rows whose input passed."""
    long = items.select("input", F.explode(F.map_from_arrays(F.array(*map(F.lit, stages)), F.array(*stages))).alias("stage", "state"))
    seen = long.where((F.col("stage") == "input") | (F.col("input") == "passed"))
    agg = seen.groupBy("stage").agg(F.count("*").alias("n"), F.count_if(F.col("state") == "pending").alias("waiting"), F.count_if(F.col("state") == "passed").alias("passed"))
    status = F.when(F.col("waiting") > 0, "in_progress").when(F.col("passed") == F.col("n"), "passed").otherwise("completed_with_issues")
    return agg.select("stage", status.alias("status"), "n")


def batch_summary(items: DataFrame, key: str = "product_key") -> DataFrame:
    """Counts by state at two grains, items and products, and the final word of each."""
    count = lambda df, grain: df.agg(F.lit(grain).alias("grain"), F.count("*").alias("planned"), *(F.count_if(F.col("status") == s).alias(s) for s in PRECEDENCE))
    both = count(items, "items").unionByName(count(product_status(items, key), "products"))
    return both.withColumn("final", F.when(F.col("passed") == F.col("planned"), "passed").otherwise("completed_with_issues"))


def batch_report(items: DataFrame, key: str, group: str) -> DataFrame:
    """(group, status, n, reasons): distinct reasons in order of the key.

    Items are counted by reason first, so what is collected for a group is its distinct reasons."""
    by_reason = items.groupBy(group, "status", "reason").agg(F.count("*").alias("_n"), F.min(F.struct(key)).alias("_first"))
    reasons = F.transform(F.array_sort(F.collect_list(F.struct("_first", "reason"))), lambda x: x["reason"])
    return by_reason.groupBy(group, "status").agg(F.sum("_n").alias("n"), F.array_join(reasons, ",").alias("reasons"))


def resume_pending(planned: DataFrame, finished: DataFrame, keys: list[str], fixed: list[str]) -> DataFrame:
    """(keys, action): redo what is not finished; a finished item whose fixed fields changed blocks."""
    done = finished.select(*keys, F.struct(*fixed).alias("was"), F.lit(True).alias("done"))
    joined = planned.select(*keys, F.struct(*fixed).alias("now")).join(done, keys, "left")
    return joined.select(*keys, F.when(F.col("done").isNull(), "run").when(~F.col("was").eqNullSafe(F.col("now")), "blocked").otherwise("reuse").alias("action"))
