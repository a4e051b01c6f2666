"""Scope selection: definitions, overrides, languages, and the gates that guard them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("zh-cn", "en-us")


def language_table(spark, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    return spark.createDataFrame([(name, i) for i, name in enumerate(languages)], "language string, l_ord int")


def plan_items(products: DataFrame, languages: DataFrame) -> DataFrame:
    """Every product in every language, product-major; ``products`` has product_key and p_ord.  The
    language side is a fixed short list, so it is broadcast."""
    return products.crossJoin(F.broadcast(languages)).withColumn("item_id", F.concat_ws("/", "product_key", "language"))


def select_list(products: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted products in the order of ``wanted`` (product_key, p_ord); see ``unknown_keys``."""
    return products.join(wanted, "product_key").select(*products.columns, "p_ord")


def available_categories(products: DataFrame, key: str, category: str) -> DataFrame:
    """Sorted distinct categories and the number of products in each."""
    return products.groupBy(F.lower(F.trim(category)).alias("category")).agg(F.countDistinct(key).alias("products"))


def apply_overrides(products: DataFrame, overrides: DataFrame) -> DataFrame:
    """Strategies after overrides; an override without a reason, for or to a support page counts not.

    ``overrides`` has product_key, strategy and reason; ``overridden`` says where one took effect.
    """
    good = overrides.where("trim(reason) != '' and strategy != 'support_article'").select("product_key", F.col("strategy").alias("new"))
    joined = products.join(good, "product_key", "left")
    takes = F.col("new").isNotNull() & (F.col("strategy") != "support_article")
    return joined.withColumn("overridden", takes).withColumn("strategy", F.when(takes, F.col("new")).otherwise(F.col("strategy"))).drop("new")


def dispatch(rows: DataFrame, strategy: str, branches: dict[str, Column], out: str) -> DataFrame:
    """Each row through the branch of its strategy; an unknown strategy gives an error."""
    value = F.lit(None)
    for name, made in branches.items():
        value = F.when(F.col(strategy) == name, made).otherwise(value)
    return rows.withColumn(out, value).withColumn("error", F.when(~F.col(strategy).isin(*branches), F.concat(F.lit("unknown strategy: "), F.col(strategy))))


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def unknown_keys(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(known.select(key), key, "left_anti")


def complete_groups(items: DataFrame, group: str, member: str, all_members: DataFrame) -> DataFrame:
    """Groups that have every member (relational division)."""
    needed = all_members.select(member).distinct()
    have = items.select(group, member).distinct().join(needed, member).groupBy(group).agg(F.count("*").alias("n"))
    return have.join(F.broadcast(needed.agg(F.count("*").alias("needed"))), F.col("n") == F.col("needed")).select(group)
