"""Freezing of sources: all languages of a product are taken over together or none, and a new version of the frozen
table becomes the current one by a single rename."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.commit import freeze_actions, seal, staged
from tessera.sources.stages import StageError, written


def versions(spark: SparkSession, root: str) -> list[int]:
    """Sealed versions, oldest first; what a killed writer left has no such name."""
    fs = spark._jvm.org.apache.hadoop.fs
    found = fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(fs.Path(f"{root}/v=*/_SUCCESS"))
    return sorted(int(f.getPath().getParent().getName().removeprefix("v=")) for f in found or [])


def current(spark: SparkSession, root: str, schema: str, version: int | None = None) -> DataFrame:
    """The frozen table of the newest version, or of the one asked for; empty before the first."""
    known = versions(spark, root)
    version = version if version is not None else known[-1] if known else None
    return spark.read.schema(schema).parquet(f"{root}/v={version}") if version is not None else spark.createDataFrame([], schema)


def _plan_errors(items: DataFrame, product: str, language: str, languages: list[str] | None) -> DataFrame:
    """(product, error) of products whose plan has not each language once."""
    told = items.groupBy(product).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(language)).alias("have"))
    wrong: Column = F.size("have") != F.col("n")
    if languages is not None:
        wrong = wrong | (F.col("have") != F.array_sort(F.array(*map(F.lit, languages))))
    return told.where(wrong).select(product, F.concat(F.lit("languages of the plan: "), F.array_join("have", ", ")).alias("error"))


def freeze(spark: SparkSession, root: str, items: DataFrame, sources: Callable[[], DataFrame], product: str = "product_key", language: str = "language", content: str = "content", languages: list[str] | None = None) -> DataFrame:
    """Take the sources of ``items`` (product, language) over and return (product, language, action, n_bytes, error).

    ``sources`` reads (product, language, content) anew at each call; it is called before the copy and after it, and a product
    of which a source is missing, empty or not the same both times is blocked, and so is one whose
    plan lacks one of the ``languages`` or names one twice: of a blocked product the frozen
    rows of all languages stay as they were.  Products outside the plan stay too.

    The new version holds every row.  It is written, read back, compared and only then renamed to
    the next number, and a rename never replaces; so a failure at any point before leaves the
    old version the current one, and of two writers the later gets a ``StageError``.
    """
    keys = [product, language]
    upstream = sources()
    kind = {name: upstream.schema[name].dataType.simpleString() for name in (*keys, content)}
    schema = ", ".join(f"`{name}` {k}" for name, k in kind.items())
    known = versions(spark, root)
    old = current(spark, root, schema)
    copy, _ = staged(upstream.select(*keys, content), "sources")
    plan_errors = _plan_errors(items, product, language, languages)
    planned = items.select(*keys).distinct()
    actions, _ = staged(freeze_actions(planned, copy, old, keys, product, content).join(plan_errors, product, "left"), "actions")
    later = sources().select(*keys, F.col(content).alias("later"))
    moved = copy.join(planned, keys, "left_semi").join(later, keys, "full_outer").join(planned, keys, "left_semi")
    moved, _ = staged(moved.where(~F.col(content).eqNullSafe(F.col("later"))).select(product).distinct().withColumn("moved", F.lit(True)), "moved")
    blocked = (F.col("action") == "blocked") | F.col("error").isNotNull() | F.col("moved").isNotNull()
    judged, _ = staged(actions.join(moved, product, "left").withColumn("blocked", blocked), "judged")
    taken = copy.join(judged.where("not blocked").select(*keys), keys, "left_semi")
    kept = old.join(taken.select(*keys), keys, "left_anti")
    building = f"{root}/building-{uuid.uuid4().hex}"
    written(taken.unionByName(kept), building)
    if not seal(spark, building, f"{root}/v={known[-1] + 1 if known else 0}"):
        raise StageError("another freeze came first")
    why = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("moved").isNotNull(), "source changed while it was copied").when(F.col("blocked"), "source missing or empty")
    size = F.when(~F.col("blocked"), F.octet_length(content).cast("bigint"))
    return judged.join(copy, keys, "left").select(*keys, F.when(F.col("blocked"), "blocked").otherwise(F.col("action")).alias("action"), size.alias("n_bytes"), why.alias("error"))
