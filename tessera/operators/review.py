"""Review queues, decisions and releases: gated semi- and anti-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATERIALS = ("source", "payload", "l3a", "l3b")


def review_queue(items: DataFrame, languages: int) -> DataFrame:
    """(product_key, queued, reasons): a product is queued if its passed items cover all languages with
    one page model and one strategy."""
    agg = items.groupBy("product_key").agg(
        F.countDistinct(F.when(F.col("status") == "passed", F.col("language"))).alias("covered"),
        F.countDistinct("page_model").alias("models"),
        F.countDistinct("strategy").alias("strategies"),
    )
    reasons = F.array_join(F.array_compact(F.array(
        F.when(F.col("covered") < languages, F.lit("language missing")),
        F.when(F.col("models") > 1, F.lit("page models differ")),
        F.when(F.col("strategies") > 1, F.lit("strategies differ")),
    )), "；")
    return agg.select("product_key", (reasons == "").alias("queued"), reasons.alias("reasons"))


def queue_items(items: DataFrame, materials: DataFrame, reports: DataFrame) -> DataFrame:
    """(item_id, product_key, language, reasons): why an item may not be reviewed, in order; empty if it may.

    ``items`` has run, item_id, product_key, language, status, error, input, extraction, l3a, l3b, content
    (identity of its payload) and broken (a broken rule of its payload, or null); ``materials`` (run, item_id,
    material) what is there, ``reports`` (run, item_id, check, product_key, language, status, content) the checks' own
    words.  An item that did not pass tells all its stages; only of others materials are looked for, and only
    where none is missing are payload and reports judged.  A report must be of the item's run, check, product and language, passed, and
    about the very payload that lies there.
    """
    key = ["run", "item_id"]
    there = materials.groupBy(*key).agg(F.collect_set("material").alias("there"))
    own = [reports.where(F.col("check") == name).groupBy(*key).agg(F.min(F.struct("product_key", "language", "status", "content")).alias(f"r_{name}"), F.count("*").alias(f"n_{name}")) for name in ("l3a", "l3b")]
    joined = items.join(there, key, "left")
    for table in own:
        joined = joined.join(table, key, "left")
    missing = F.filter(F.array(*map(F.lit, MATERIALS)), lambda m: ~F.array_contains(F.coalesce("there", F.array().cast("array<string>")), m))

    def report(name: str) -> Column:
        r, wrong = F.col(f"r_{name}"), lambda text: F.lit(f"{name} report: {text}")
        return (
            F.when(r.isNull(), wrong("not of this run"))
            .when(F.col(f"n_{name}") > 1, wrong("several"))
            .when(~r["product_key"].eqNullSafe(F.col("product_key")) | ~r["language"].eqNullSafe(F.col("language")), wrong("of another item"))
            .when(~r["status"].eqNullSafe("passed"), wrong("not passed"))
            .when(~r["content"].eqNullSafe(F.col("content")), wrong("of another payload"))
        )

    def reasons(*found: Column) -> Column:
        return F.array_compact(F.array(*found))

    stage = lambda name, text: F.when(~F.col(name).eqNullSafe("passed"), F.lit(text))
    stages = reasons(
        F.when(~F.col("status").eqNullSafe("passed"), F.coalesce("error", F.concat(F.lit("result is "), F.coalesce("status", F.lit("unknown"))))),
        stage("input", "source not fixed"), stage("extraction", "extraction not passed"), stage("l3a", "l3a not passed"), stage("l3b", "l3b not passed"),
    )
    lacks = reasons(F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))))
    judged = reasons(F.when(F.col("broken").isNotNull(), F.concat(F.lit("payload: "), F.col("broken"))), report("l3a"), report("l3b"))
    told = joined.withColumns({"_stages": stages, "_lacks": lacks, "_judged": judged})
    return told.select("item_id", "product_key", "language", F.when(F.size("_stages") > 0, F.col("_stages")).when(F.size("_lacks") > 0, F.col("_lacks")).otherwise(F.col("_judged")).alias("reasons"))


def queue_products(queued: DataFrame, languages: list[str]) -> DataFrame:
    """(product_key, ready, reasons) of ``queue_items``: ready if each of the languages has its one item and no item a reason; reasons in the order of
    the languages, a missing or repeated language among them."""
    order = F.array(*map(F.lit, languages))
    rows = queued.groupBy("product_key").agg(F.collect_list(F.struct("language", "reasons")).alias("all"))

    def of(language: Column) -> Column:
        own = F.filter("all", lambda x: x["language"] == language)
        told = F.flatten(F.transform(own, lambda x: F.transform(x["reasons"], lambda r: F.concat(language, F.lit(": "), r))))
        return F.when(F.size(own) == 0, F.array(F.concat(language, F.lit(": no item")))).when(F.size(own) > 1, F.array(F.concat(language, F.lit(": several items")))).otherwise(told)

    reasons = F.flatten(F.transform(order, of))
    return rows.select("product_key", (F.size(reasons) == 0).alias("ready"), reasons.alias("reasons"))


def decision_errors(requests: DataFrame, products: DataFrame, queued: DataFrame, now: DataFrame, decided: DataFrame, languages: list[str]) -> DataFrame:
    """(product_key, error) of decisions (product_key, reviewer, decision, languages, materials, notes) that somebody wants to record.

    Who and why must be told; an approval must have looked at all languages and materials; the product
    must be ready in the queue; what the queue names (``queued``: product_key, item_id, material, content) must still be what lies
    there (``now``, the same columns); and a decision that is there is never replaced."""
    key = ["product_key", "item_id", "material"]
    a, b = queued.select(*key, F.col("content").alias("was")), now.select(*key, F.col("content").alias("is"))
    moved = a.join(b, key, "left").where(~F.col("was").eqNullSafe(F.col("is"))).select("product_key").distinct().withColumn("moved", F.lit(True))
    joined = requests.join(products.select("product_key", "ready"), "product_key", "left").join(moved, "product_key", "left").join(decided.select("product_key").distinct().withColumn("decided", F.lit(True)), "product_key", "left")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    subset = lambda c, allowed: F.size(F.array_except(c, F.array(*map(F.lit, allowed)))) > 0
    partial = lambda c, whole: F.size(F.array_intersect(F.array(*map(F.lit, whole)), c)) < len(whole)
    approved = F.col("decision") == "approved"
    cases = (
        (blank("reviewer"), "no reviewer"),
        (blank("notes"), "no notes"),
        (~F.coalesce(F.col("decision").isin("approved", "rejected"), F.lit(False)), "unknown decision"),
        (subset("languages", languages) | subset("materials", MATERIALS) | (F.size("languages") == 0) | (F.size("materials") == 0), "unknown scope"),
        (approved & partial("languages", languages), "not all languages inspected"),
        (approved & partial("materials", MATERIALS), "not all materials inspected"),
        (F.col("ready").isNull(), "not queued"),
        (~F.col("ready"), "not ready"),
        (F.col("moved"), "materials changed since"),
        (F.col("decided"), "decided already"),
    )
    return joined.select("product_key", F.coalesce(*(F.when(case, F.lit(text)) for case, text in cases)).alias("error"))


def review_status(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """(product_key, status): the decision, or pending."""
    return queue.where("queued").select("product_key").join(decisions.select("product_key", "decision"), "product_key", "left").select("product_key", F.coalesce("decision", F.lit("pending")).alias("status"))


def decision_binding(decisions: DataFrame, queue: DataFrame, bound: list[str]) -> DataFrame:
    """(product_key, error): decisions must be about the queue's very run, kind and items."""
    q = queue.select("product_key", F.struct(*bound).alias("there"), F.lit(True).alias("known"))
    joined = decisions.select("product_key", F.struct(*bound).alias("here")).join(q, "product_key", "left")
    return joined.select("product_key", F.when(F.col("known").isNull(), "not queued").when(~F.col("here").eqNullSafe(F.col("there")), "binding differs").alias("error"))


def unresolved(affected: DataFrame, delivered: DataFrame, closed: DataFrame) -> DataFrame:
    """Affected products that are neither delivered nor closed."""
    return affected.select("product_key").join(delivered.select("product_key"), "product_key", "left_anti").join(closed.select("product_key"), "product_key", "left_anti")


def release_rows(status: DataFrame, latest: DataFrame | None = None, delivered: DataFrame | None = None, open_products: DataFrame | None = None, queue: DataFrame | None = None, ended: DataFrame | None = None) -> DataFrame:
    """(product_key, reason): what a release does with each product; ``included`` goes out.

    Given ``delivered``, ``open_products`` and ``latest`` it is a delta: only the latest record of
    a product that is still open and not delivered yet.
    """
    rows = status.select("product_key", "status")
    if queue is not None:
        rows = rows.join(queue.select("product_key"), "product_key", "full_outer")
    reason = F.when(F.col("status") == "rejected", "rejected").when(F.col("status") == "pending", "pending").when(F.col("status").isNull(), "not_queued")
    for table, label, keep in ((delivered, "delivered", False), (ended, "ended", False), (open_products, "not_open", True), (latest, "stale", True)):
        if table is not None:
            rows = rows.join(table.select("product_key", F.lit(True).alias(f"_{label}")).distinct(), "product_key", "left")
            there = F.col(f"_{label}").isNotNull()
            reason = reason.when(~there if keep else there, label)
    return rows.select("product_key", reason.otherwise("included").alias("reason"))


def verify_listing(listed: DataFrame, found: DataFrame, key: str, content: str) -> DataFrame:
    """(key, error): files that are missing, extra or differ from the manifest."""
    both = listed.select(key, F.col(content).alias("a"), F.lit(1).alias("x")).join(found.select(key, F.col(content).alias("b"), F.lit(1).alias("y")), key, "full_outer")
    return both.select(key, F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").when(~F.col("a").eqNullSafe(F.col("b")), "differs").alias("error")).where("error is not null")


def delivery_overlap(deliveries: DataFrame) -> DataFrame:
    """Products that more than one delivery of a run carries."""
    return deliveries.groupBy("run", "product_key").agg(F.countDistinct("release").alias("releases")).where("releases > 1")


def forbidden_keys(rows: DataFrame, id_col: str, json_col: str, words: tuple[str, ...] = ("hash", "digest", "fingerprint", "checksum")) -> DataFrame:
    """(id, key): JSON keys of any depth that hold a forbidden word."""
    keys = F.regexp_extract_all(F.col(json_col), F.lit(r'"((?:[^"\\]|\\.)*)"\s*:'), F.lit(1))
    return rows.select(id_col, F.explode(keys).alias("key")).where(F.lower("key").rlike("|".join(words)))


def submit_gate(forms: DataFrame, all_items: str = "all_items", inspected: str = "inspected") -> DataFrame:
    """(..., can_submit): reviewer, notes and a scope; an approval needs every item inspected."""
    filled = (F.trim("reviewer") != "") & (F.trim("notes") != "") & (F.size(inspected) > 0)
    whole = F.size(F.array_except(all_items, inspected)) == 0
    return forms.withColumn("can_submit", F.coalesce(filled & ((F.col("decision") != "approved") | whole), F.lit(False)))


def product_filter(products: DataFrame, status: str | None = None, strategy: str | None = None, text: str = "") -> DataFrame:
    """The list's filter: status, strategy and a part of key or name, whatever its case."""
    out = products
    if status:
        out = out.where(F.col("status") == status)
    if strategy:
        out = out.where(F.col("strategy") == strategy)
    return out.where(F.contains(F.lower(F.concat_ws(" ", "product_key", "name")), F.lower(F.lit(text.strip())))) if text.strip() else out
