"""JSON sources: product definitions, the processing scope, exclusion lists.

Files are read with fixed schemas; what breaks a rule is a row (file or key, error), never an exception.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import is_readable_id, is_safe_path
from tessera.operators.exclusions import load_exclusions
from tessera.operators.selection import LANGUAGES

# fixed values: the definition's page models, strategies and article types
STRATEGIES = {"pricing": ("simple_static", "region_filter", "complex"), "support": ("support_article",)}
PAGE_MODELS = {"pricing": "FlexibleContentPage", "support": "SupportArticlePage"}
ARTICLE_TYPES = ("SLA", "LEGAL", "ICP", "PSR")
_SOURCE = "struct<availability:string,snapshot_path:string,url:string>"
DEFINITION = (
    "schema_version string, product_key string, display_name string, slug string, page_model string, capability_status string, "
    f"catalog_categories array<string>, support_article_type string, sources struct<`zh-cn`:{_SOURCE},`en-us`:{_SOURCE}>, "
    "extraction struct<semantic_strategy:string,page_global_content:struct<source_boundary:string>>, _corrupt string"
)
SCOPE = "schema_version string, languages array<string>, product_keys array<string>, strategy_overrides map<string,struct<strategy:string,reason:string>>, _corrupt string"
EXCLUSIONS = "os string, region string, tableIDs array<string>, _corrupt string"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("encoding", "UTF-8").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_definitions(spark: SparkSession, folders: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(definitions, errors) of ``{"pricing": folder, "support": folder}``; the folder sets the family.

    A key is an error if it is not readable, differs from its file's name, comes twice, or if its
    page model, strategy, categories, article type, languages or paths don't fit its family.
    """
    rows = None
    for family, folder in folders.items():
        part = _json(spark, f"{folder}/*.json", DEFINITION).withColumn("family", F.lit(family)).withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))
        rows = part if rows is None else rows.unionByName(part)
    twice = rows.groupBy("product_key").agg(F.count("*").alias("n")).where("n > 1").select("product_key", F.lit(True).alias("twice"))
    joined = rows.join(twice, "product_key", "left")
    fits = lambda table, column: F.coalesce(*(F.when(F.col("family") == k, F.col(column).isin(*v) if isinstance(v, tuple) else F.col(column) == v) for k, v in table.items()), F.lit(False))
    paths = [F.col("sources").getField(lang).getField("snapshot_path") for lang in LANGUAGES]
    categories = F.col("catalog_categories")
    checks = {
        "unreadable": F.col("_corrupt").isNotNull(),
        "key": ~is_readable_id(F.col("product_key")),
        "file name": F.col("file") != F.col("product_key"),
        "duplicate key": F.col("twice"),
        "page model": ~fits(PAGE_MODELS, "page_model"),
        "strategy": ~fits(STRATEGIES, "extraction.semantic_strategy"),
        "categories": (F.col("family") == "pricing") & (F.coalesce(F.size(categories), F.lit(0)) < 1),
        "article type": (F.col("family") == "support") & ~F.col("support_article_type").isin(*ARTICLE_TYPES),
        "languages": F.exists(F.array(*paths), lambda p: p.isNull()),
        "path": F.exists(F.array(*paths), lambda p: p.isNotNull() & ~is_safe_path(p)),
    }
    broken = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(name in ("page model", "strategy", "article type"))), F.lit(name)) for name, c in checks.items())))
    judged = joined.withColumn("broken", broken)
    good = judged.where(F.size("broken") == 0).select("product_key", "display_name", "slug", "family", "page_model", F.col("extraction.semantic_strategy").alias("strategy"), F.transform(categories, lambda c: F.lower(F.trim(c))).alias("categories"), "support_article_type", F.col("extraction.page_global_content.source_boundary").alias("boundary"), "sources")
    return good, judged.select(F.coalesce("product_key", "file").alias("product_key"), F.explode("broken").alias("error"))


def definition_sources(definitions: DataFrame) -> DataFrame:
    """(product_key, language, snapshot_path, url, frozen_path), a row for each language."""
    each = F.explode(F.array(*(F.struct(F.lit(lang).alias("language"), F.col("sources").getField(lang).alias("s")) for lang in LANGUAGES))).alias("x")
    long = definitions.select("product_key", "family", "support_article_type", each).select("product_key", "family", "support_article_type", "x.language", "x.s.snapshot_path", "x.s.url")
    folder = F.when(F.col("family") == "support", F.concat_ws("/", F.lit("support"), F.lower("support_article_type"))).otherwise(F.lit("pricing"))
    return long.select("product_key", "language", "snapshot_path", "url", F.concat_ws("/", "language", folder, F.concat("product_key", F.lit(".html"))).alias("frozen_path"))


def read_scope(spark: SparkSession, path: str, definitions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scope, overrides, errors): product keys with ordinals, overrides by key, broken rules."""
    raw = _json(spark, path, SCOPE)
    keys = raw.select(F.posexplode("product_keys").alias("p_ord", "product_key"))
    overrides = raw.select(F.explode("strategy_overrides").alias("product_key", "o")).select("product_key", "o.strategy", "o.reason")
    order = raw.select(F.explode(F.array_compact(F.array(
        F.when(F.col("_corrupt").isNotNull(), F.lit("unreadable")),
        F.when(~F.col("languages").eqNullSafe(F.array(*map(F.lit, LANGUAGES))), F.lit("languages")),
        F.when(~F.col("product_keys").eqNullSafe(F.array_sort(F.array_distinct("product_keys"))), F.lit("keys not sorted and unique")),
    ))).alias("error")).select(F.lit("scope").alias("product_key"), "error")
    unknown = keys.join(definitions.select("product_key"), "product_key", "left_anti").select("product_key", F.lit("unknown key").alias("error"))
    joined = overrides.join(keys.select("product_key", F.lit(True).alias("inside")), "product_key", "left").join(definitions.select("product_key", "family"), "product_key", "left")
    bad = F.when(F.col("inside").isNull(), "override out of scope").when(F.trim("reason") == "", "override without reason").when((F.col("strategy") == "support_article") | (F.col("family") == "support"), "override of a support page").when(~F.col("strategy").isin(*STRATEGIES["pricing"]), "override strategy")
    wrong = joined.select("product_key", bad.alias("error")).where("error is not null")
    return keys, overrides.join(wrong.select("product_key"), "product_key", "left_anti"), order.unionByName(unknown).unionByName(wrong)


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """(os, region, table_ids, error) of an exclusion list; see ``load_exclusions``."""
    return load_exclusions(_json(spark, path, EXCLUSIONS).where("_corrupt is null").select("os", "region", F.col("tableIDs").alias("ids")))


def definition_baseline(definitions: DataFrame) -> DataFrame:
    """The projection that change detection compares: status, names, slugs and categories are left out."""
    urls = [F.col("sources").getField(lang).getField("url").alias(f"url_{lang[:2]}") for lang in LANGUAGES]
    return definitions.select("product_key", "page_model", "strategy", "boundary", *urls)
