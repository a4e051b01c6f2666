"""Change detection: snapshots, exclusion mappings, definitions, and the plan made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOURCES = ("html", "config", "definition")


def snapshot_changes(items: DataFrame, new: DataFrame, old: DataFrame, key: str, content: str) -> DataFrame:
    """(key, change): added, removed, modified, missing_in_both or unchanged for every item in scope.
    Contents are compared as they are; a digest only decides where both sides' lengths agree."""
    n = new.select(key, F.col(content).alias("new"), F.lit(True).alias("has_new"))
    o = old.select(key, F.col(content).alias("old"), F.lit(True).alias("has_old"))
    both = items.select(key).join(n, key, "left").join(o, key, "left")
    change = F.when(F.col("has_new").isNull() & F.col("has_old").isNull(), "missing_in_both").when(F.col("has_old").isNull(), "added").when(F.col("has_new").isNull(), "removed").when(~F.col("new").eqNullSafe(F.col("old")), "modified").otherwise("unchanged")
    return both.select(key, change.alias("change"))


def mapping_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(os, region, change) of exclusion rows that came, went or have other ids as a set; a new row
    with no ids is a change too."""
    ids = lambda df, name: df.select("os", "region", F.array_sort(F.array_distinct("table_ids")).alias(name))
    both = ids(old, "was").join(ids(new, "now"), ["os", "region"], "full_outer")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "table_ids_changed")
    return both.select("os", "region", change.alias("change")).where("change is not null")


def affected_by_usage(changed: DataFrame, recorded: DataFrame, products: DataFrame, languages: int) -> DataFrame:
    """(product_key, reason): products whose recorded lookups meet a changed key, and all consumers
    whose evidence lacks a language, since nothing rules them out."""
    hit = recorded.join(changed.select("os", "region").distinct(), ["os", "region"], "left_semi").select("product_key").distinct().withColumn("hit", F.lit(True))
    whole = recorded.groupBy("product_key").agg(F.countDistinct("language").alias("n")).where(F.col("n") >= languages).select("product_key", F.lit(True).alias("whole"))
    joined = products.select("product_key").join(hit, "product_key", "left").join(whole, "product_key", "left")
    reason = F.when(F.col("hit"), "lookup changed").when(F.col("whole").isNull(), "incomplete evidence")
    return joined.select("product_key", reason.alias("reason")).where("reason is not null")


def definition_changes(old: DataFrame, new: DataFrame, fields: list[str]) -> DataFrame:
    """(product_key, fields): which of the compared fields differ; keys on one side only give
    ``missing`` or ``extra``."""
    both = old.select("product_key", F.struct(*fields).alias("was")).join(new.select("product_key", F.struct(*fields).alias("now")), "product_key", "full_outer")
    differs: list[Column] = [F.when(~F.col(f"was.{f}").eqNullSafe(F.col(f"now.{f}")), F.lit(f)) for f in fields]
    named = F.when(F.col("now").isNull(), "missing").when(F.col("was").isNull(), "extra").otherwise(F.array_join(F.array_compact(F.array(*differs)), ","))
    return both.select("product_key", named.alias("fields")).where("fields != ''")


def change_plan(sources: dict[str, DataFrame]) -> DataFrame:
    """(product_key, sources, n): affected products with the sources that name them, in order."""
    parts = None
    for rank, (name, df) in enumerate(sources.items()):
        part = df.select("product_key").distinct().select("product_key", F.struct(F.lit(rank).alias("rank"), F.lit(name).alias("name")).alias("s"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("product_key").agg(F.array_join(F.transform(F.array_sort(F.collect_set("s")), lambda s: s["name"]), ",").alias("sources"), F.countDistinct("s.name").alias("n"))


def merge_evidence(old: DataFrame, new: DataFrame, keys: list[str], consumers: DataFrame) -> DataFrame:
    """Evidence with each item's records replaced by its new ones; items that are no consumers go."""
    fresh = new.select(*keys).distinct()
    kept = old.join(fresh, keys, "left_anti").unionByName(new.select(*old.columns))
    return kept.join(consumers, keys, "left_semi")
