"""Gates and cuts of pages: declared language, kinds of sections, controls that are no content, and
what stands before a nested body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import has_phrase
from tessera.operators import tree

# fixed values: phrases of service levels, and what of a page is control rather than content
SERVICE_PHRASES = ("支持和服务级别协议", "support & sla", "support and sla", "service level agreement")
UI_CLASSES = ("content-feedback", "select", "left-navigation-select", "bookmark", "loader", "tags")
UI_TAGS = ("select", "script", "style", "tags")
UI_IDS = ("content_feedback",)


def declared_language(nodes: DataFrame, items: DataFrame, exempt: Column | None = None) -> DataFrame:
    """(item_id, error): an item's language must stand among the classes of its page's first body;
    ``exempt`` items (filtered pages) are let through.  A page without a body declares nothing."""
    bodies = nodes.where("tag = 'body'").groupBy("item_id").agg(F.min_by("classes", "pre").alias("marks"))
    joined = items.select("item_id", "language", (exempt if exempt is not None else F.lit(False)).alias("exempt")).join(bodies, "item_id", "left")
    declared = F.coalesce(F.array_contains("marks", F.col("language")), F.lit(False))
    return joined.select("item_id", F.when(~F.col("exempt") & ~declared, "language not declared").alias("error"))


def section_classes(sections: DataFrame, nodes: DataFrame) -> DataFrame:
    """(item_id, pre, class): faq with a ``more-detail``, sla by its phrases, else content."""
    details = tree.within(sections, nodes.where(tree.has_class("more-detail")).select("item_id", "pre"), self_too=True)
    more = details.select("item_id", F.col("outer").alias("pre"), F.lit(True).alias("more")).distinct()
    texts = tree.subtree_text(sections, nodes).withColumnRenamed("outer", "pre")
    joined = sections.select("item_id", "pre").join(more, ["item_id", "pre"], "left").join(texts, ["item_id", "pre"], "left")
    return joined.select("item_id", "pre", F.when(F.col("more"), "faq").when(has_phrase(F.col("text"), SERVICE_PHRASES), "sla").otherwise("content").alias("class"))


def of_classes(sections: DataFrame, nodes: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of the sections whose class is wanted."""
    chosen = section_classes(sections, nodes).where(F.col("class").isin(wanted)).select("item_id", "pre")
    return sections.join(chosen, ["item_id", "pre"], "left_semi")


def is_control() -> Column:
    return F.col("tag").isin(*UI_TAGS) | F.col("id").isin(*UI_IDS) | F.arrays_overlap("classes", F.array(*map(F.lit, UI_CLASSES)))


def controls(nodes: DataFrame) -> DataFrame:
    """(item_id, pre, last) of elements that are controls."""
    return nodes.where("kind = 'element'").where(is_control()).select("item_id", "pre", "last")


def without_controls(nodes: DataFrame) -> DataFrame:
    """The node table without the subtrees of controls."""
    return tree.in_any(controls(nodes), nodes, self_too=True, inside=False)


def prefix_before(nodes: DataFrame, wrappers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefixes, errors): the markup of each wrapper (item_id, pre, last) up to the selector in it, without
    the selector and what follows it beside it.  Anything but one outermost selector is an error."""
    inside = tree.within(wrappers, nodes.where((F.col("tag") == "div") & tree.has_class("technical-azure-selector")).select("item_id", "pre", "last", "parent"))
    outer = tree.outermost(inside.select("item_id", "pre", "last").distinct())
    found = inside.join(outer.select("item_id", "pre"), ["item_id", "pre"], "left_semi").groupBy("item_id", F.col("outer").alias("wrapper")).agg(F.count("*").alias("n"), F.min(F.struct("pre", "parent")).alias("a"))
    judged = wrappers.select("item_id", F.col("pre").alias("wrapper"), F.col("last").alias("wrapper_last")).join(found, ["item_id", "wrapper"], "left")
    one = judged.where("n = 1").select("item_id", "wrapper", "wrapper_last", F.col("a.pre").alias("anchor"), F.col("a.parent").alias("level"))
    cut = nodes.select("item_id", F.col("pre").alias("at"), F.col("last").alias("at_last"), F.col("parent").alias("level")).join(one, ["item_id", "level"]).where("at >= anchor").select("item_id", F.col("at").alias("pre"), F.col("at_last").alias("last"))
    html = tree.subtree_html(one.select("item_id", F.col("wrapper").alias("pre"), F.col("wrapper_last").alias("last")), nodes, cut)
    errors = judged.where("coalesce(n, 0) != 1").select("item_id", F.concat(F.lit("nested selectors: "), F.coalesce("n", F.lit(0)).cast("string")).alias("error"))
    return html.select("item_id", F.col("outer").alias("wrapper"), "html"), errors
