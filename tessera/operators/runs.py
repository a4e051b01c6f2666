"""Runs: what a batch is opened with, what a later record or a resumed run may take over, and what
closes it.  A gate gives one row for each thing it looks at, with a null error where it lets it pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUILDING = ".building"
PLAN_FIELDS = ("product_key", "language", "page_model", "strategy", "boundary", "source_path", "frozen_path")
MATERIALS = ("frozen_html", "payload", "l3a", "l3b")


def _first(*cases: tuple[Column, str]) -> Column:
    """The message of the first case that holds; a case that can't be told holds not."""
    return F.coalesce(*(F.when(case, F.lit(text)) for case, text in cases))


def frozen_path(language: str = "language", family: str = "family", article_type: str = "article_type", key: str = "product_key") -> Column:
    """language/pricing/key.html, or language/support-articles/type/key.html; null where the type is missing."""
    return F.when(F.col(family) == "pricing", F.concat_ws("/", F.col(language), F.lit("pricing"), F.concat(F.col(key), F.lit(".html")))).when(
        F.col(article_type).isNotNull(), F.concat_ws("/", F.col(language), F.lit("support-articles"), F.col(article_type), F.concat(F.col(key), F.lit(".html")))
    )


def strategy_config(products: DataFrame, config_path: str, strategy: str | None = None) -> DataFrame:
    """``products`` with (effective_strategy, has_boundary, soft_category_path); only strategies that look
    tables up get the path.  ``strategy`` overrides the products' own."""
    own = F.lit(strategy) if strategy else F.col("strategy")
    return products.withColumns({"effective_strategy": own, "has_boundary": F.col("boundary").isNotNull(), "soft_category_path": F.when(own.isin("region_filter", "complex"), F.lit(config_path))})


def manifest_items(plan: DataFrame, run: Column) -> DataFrame:
    """Skeleton rows of a new run: the plan in order, every stage pending, and where its artifacts go."""
    folder = F.concat_ws("/", F.lit("runs"), run.cast("string"), F.lit("{}"), F.regexp_replace("frozen_path", r"\.html$", ".json"))
    stages = {stage: F.lit("pending") for stage in ("input", "extraction", "usage", "l3a", "l3b")}
    paths = {f"{kind}_path": F.replace(folder, F.lit("{}"), F.lit(kind)) for kind in ("payload", "usage", "l3a", "l3b")}
    return plan.withColumns(stages | paths | {"status": F.lit("pending")})


def selection_description(forms: DataFrame) -> DataFrame:
    """(..., kind, value, error): what a run was asked for; the first of product, products, category, all."""
    kind = _first((F.col("product_key").isNotNull(), "product"), (F.col("product_keys").isNotNull(), "products"), (F.col("category").isNotNull(), "category"), (F.col("all_products"), "all"))
    value = F.when(kind == "product", F.col("product_key")).when(kind == "category", F.lower(F.trim("category")))
    return forms.withColumns({"kind": kind, "value": value, "error": F.when(kind.isNull(), "nothing selected")})


def copy_or_confirm(new: DataFrame, there: DataFrame, key: str, content: str) -> DataFrame:
    """(key, action): ``copy`` what is not there yet, ``confirm`` what is equal, ``blocked`` what differs."""
    t = there.select(key, F.col(content).alias("had"), F.lit(True).alias("has"))
    return new.select(key, content).join(t, key, "left").select(key, F.when(F.col("has").isNull(), "copy").when(F.col(content).eqNullSafe(F.col("had")), "confirm").otherwise("blocked").alias("action"))


def file_differences(previous: DataFrame, current: DataFrame, key: str, content: str, identity: str) -> DataFrame:
    """(key, differs, error): equality of contents; a file whose identity moved between the two readings
    (``identity`` and ``identity`` + "_after") is an error, since nothing is known of it then."""
    was, now = (df.select(key, F.col(content).alias(f"{side}_c"), F.col(identity).eqNullSafe(F.col(f"{identity}_after")).alias(f"{side}_s")) for df, side in ((previous, "a"), (current, "b")))
    both = was.join(now, key, "full_outer")
    error = _first((F.col("a_s").isNull() | F.col("b_s").isNull(), "missing"), (~F.col("a_s"), "previous changed while read"), (~F.col("b_s"), "current changed while read"))
    return both.select(key, F.when(error.isNull(), ~F.col("a_c").eqNullSafe(F.col("b_c"))).alias("differs"), error.alias("error"))


def sealed_runs(runs: DataFrame) -> DataFrame:
    """(run, error): only runs that are sealed, bear their manifest's name and have nothing pending
    may be reviewed.  ``runs`` has run, directory and pending."""
    bare = F.regexp_replace("directory", r"\.building$", "")
    return runs.select("run", _first((F.endswith("directory", F.lit(BUILDING)), "not sealed"), (bare != F.col("run"), "name differs"), (~F.col("pending").eqNullSafe(0), "items pending")).alias("error"))


def passed_checks(reports: DataFrame, items: DataFrame, check: str) -> DataFrame:
    """(item_id, error): each item's report must be of this check, this product and language, and passed."""
    r = reports.select("item_id", F.col("check").alias("r_check"), F.col("product_key").alias("r_product"), F.col("language").alias("r_language"), F.col("status").alias("r_status"), F.lit(True).alias("there"))
    error = _first((F.col("there").isNull(), "missing"), (~F.col("r_check").eqNullSafe(check), "check differs"), (~F.col("r_product").eqNullSafe(F.col("product_key")), "product differs"), (~F.col("r_language").eqNullSafe(F.col("language")), "language differs"), (~F.col("r_status").eqNullSafe("passed"), "not passed"))
    return items.join(r, "item_id", "left").select("item_id", error.alias("error"))


def closed_products(decisions: DataFrame) -> DataFrame:
    """(run, product_key, error): decisions to end a product; the file's stem must be its key."""
    stem = F.regexp_extract("path", r"([^/]*)\.json$", 1)
    return decisions.select("run", "product_key", _first((F.col("decision").isNull() | (F.col("decision") != "ended_without_delivery"), "no decision"), (~stem.eqNullSafe(F.col("product_key").cast("string")), "name differs")).alias("error"))


def open_batches(affected: DataFrame, delivered: DataFrame, closed: DataFrame) -> DataFrame:
    """(run, affected, delivered, closed, unresolved, error) of each run, all by (run, product_key).

    A product that is delivered counts so even if it was closed too.  Ends of products outside the
    run's scope are an error, and so is every open run if there is more than one."""
    key = ["run", "product_key"]
    marked = lambda df, name: df.select(*key).distinct().withColumn(name, F.lit(True))
    rows = marked(affected, "a").join(marked(delivered, "d"), key, "full_outer").join(marked(closed, "c"), key, "full_outer")
    there, done, ended = F.col("a").isNotNull(), F.col("d").isNotNull(), F.col("c").isNotNull()
    runs = rows.groupBy("run").agg(
        F.count_if(there).alias("affected"), F.count_if(there & done).alias("delivered"), F.count_if(there & ~done & ended).alias("closed"), F.count_if(there & ~done & ~ended).alias("unresolved"), F.count_if(~there).alias("unknown")
    )
    several = runs.where("unresolved > 0").agg((F.count("*") > 1).alias("several"))
    error = _first((F.col("unknown") > 0, "ends outside the scope"), ((F.col("unresolved") > 0) & F.col("several"), "several open batches"))
    return runs.crossJoin(F.broadcast(several)).select("run", "affected", "delivered", "closed", "unresolved", error.alias("error"))  # one row


def end_without_delivery(requests: DataFrame, runs: DataFrame, unresolved: DataFrame) -> DataFrame:
    """(run, product_key, error): a product may be ended if its run is open and sealed, it is unresolved there,
    and who ended it and why is written down.  ``runs`` has run, sealed and unresolved."""
    open_runs = runs.where("unresolved > 0").select("run", "sealed")
    left = unresolved.select("run", "product_key").distinct().withColumn("left", F.lit(True))
    error = _first((F.trim("reviewer") == "", "no reviewer"), (F.trim("reason") == "", "no reason"), (F.col("sealed").isNull(), "no open batch"), (~F.col("sealed"), "not sealed"), (F.col("left").isNull(), "not unresolved"))
    return requests.join(open_runs, "run", "left").join(left, ["run", "product_key"], "left").select("run", "product_key", error.alias("error"))


def fixed_inputs(inputs: DataFrame, run: Column) -> DataFrame:
    """The inputs as the run keeps them, whatever becomes of the common ones: (run, ...)."""
    return inputs.withColumn("run", run)


def inherited_inputs(records: DataFrame, inputs: DataFrame) -> DataFrame:
    """(record, name, content, error): a record reads the inputs that its chain's root has fixed.
    ``records`` has record and root; a root without inputs is an error."""
    own = inputs.select(F.col("run").alias("root"), "name", "content")
    return records.select("record", "root").join(own, "root", "left").select("record", "name", "content", _first((F.col("root").isNull(), "no root"), (F.col("name").isNull(), "no fixed inputs")).alias("error"))


def parent_runs(records: DataFrame, runs: DataFrame) -> DataFrame:
    """(record, run, error): the run that a record names, itself or by its chain's root."""
    known = runs.select(F.col("run").alias("root"), F.lit(True).alias("known"))
    return records.select("record", "root").join(known, "root", "left").select("record", F.when(F.col("known"), F.col("root")).alias("run"), _first((F.col("root").isNull(), "no root"), (F.col("known").isNull(), "unknown run")).alias("error"))


def plan_differences(latest: DataFrame, items: DataFrame, fields: tuple[str, ...] = PLAN_FIELDS) -> DataFrame:
    """(item_id, error): items whose plan is not that of the latest record, field by field, in the same
    order (``ordinal``), with none missing and none added."""
    was = latest.select("item_id", F.col("ordinal").alias("o"), F.struct(*fields).alias("was"))
    both = was.join(items.select("item_id", "ordinal", F.struct(*fields).alias("now")), "item_id", "full_outer")
    changed = F.array_join(F.array_compact(F.array(*(F.when(~F.col(f"was.{f}").eqNullSafe(F.col(f"now.{f}")), F.lit(f)) for f in fields))), ",")
    error = F.coalesce(_first((F.col("was").isNull(), "added"), (F.col("now").isNull(), "missing")), F.when(changed != "", changed), F.when(F.col("o") != F.col("ordinal"), F.lit("order differs")))
    return both.select("item_id", error.alias("error"))


def acknowledge(baseline: DataFrame, current: DataFrame, affected: DataFrame, key: str = "product_key") -> DataFrame:
    """The next baseline: what the current definitions say, but of affected products what it said before,
    since they are a batch's to advance."""
    touched = affected.select(key).distinct()
    return current.join(touched, key, "left_anti").unionByName(baseline.join(touched, key, "left_semi"))


def resume_inputs(items: DataFrame, source: DataFrame, frozen: DataFrame, fixed: bool = False) -> DataFrame:
    """(item_id, error): inputs of finished items must be there (``fixed``: frozen for the batch), or else
    equal to what is upstream now.  Items whose input has not passed are not looked at."""
    s = source.select("item_id", F.col("content").alias("s"))
    f = frozen.select("item_id", F.col("content").alias("f"))
    done = items.where("input = 'passed'").select("item_id")
    if fixed:
        return done.join(f, "item_id", "left").select("item_id", F.when(F.col("f").isNull(), "fixed input missing").alias("error"))
    both = done.join(s, "item_id", "left").join(f, "item_id", "left")
    return both.select("item_id", F.when(~F.coalesce(F.col("s") == F.col("f"), F.lit(False)), "input changed").alias("error"))


def resume_results(items: DataFrame, stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """(item_id, action): a stored result is reused if a fresh one equals it, blocked if not; items
    without a stored one run."""
    s = stored.select("item_id", F.col("content").alias("s"), F.lit(True).alias("has"))
    n = fresh.select("item_id", F.col("content").alias("n"))
    action = F.when(F.col("has").isNull(), "run").when(F.col("s").eqNullSafe(F.col("n")), "reuse").otherwise("blocked")
    return items.select("item_id").join(s, "item_id", "left").join(n, "item_id", "left").select("item_id", action.alias("action"))


def usage_report_errors(reports: DataFrame) -> DataFrame:
    """(item_id, error): reports of looked-up tables must name their item, list each (os, region) once, and
    say ids only of rows that are there.  ``reports`` has item_id, product_key, language, uses and lookups."""
    keys = F.transform("lookups", lambda x: F.concat_ws("\x1f", x["os"], x["region"]))
    absent = F.exists("lookups", lambda x: ~x["row_present"] & (F.size(x["table_ids"]) > 0))
    error = _first(
        (F.col("item_id") != F.concat_ws("/", "product_key", "language"), "identity differs"),
        (~F.col("uses") & (F.size("lookups") > 0), "lookups of no consumer"),
        (F.size(keys) != F.size(F.array_distinct(keys)), "lookup repeated"),
        (absent, "ids without a row"),
    )
    return reports.select("item_id", error.alias("error"))


def baseline_from_manifest(items: DataFrame, fields: tuple[str, ...], languages: int) -> DataFrame:
    """(product_key, fields, error): definitions as a run's items tell them; a product whose languages are not
    all there, or tell differently, is an error."""
    same = F.struct(*fields)
    rows = items.groupBy("product_key").agg(F.countDistinct("language").alias("n"), F.min(same).alias("low"), F.max(same).alias("high"))
    error = _first((F.col("n") != languages, "language missing"), (~F.col("low").eqNullSafe(F.col("high")), "items differ"))
    return rows.select("product_key", *(F.when(error.isNull(), F.col(f"low.{f}")).alias(f) for f in fields), error.alias("error"))


def freeze_summary(actions: DataFrame) -> DataFrame:
    """(selected, passed, blocked, copied, updated, unchanged) of a freeze."""
    n = lambda *names: F.count_if(F.col("action").isin(*names))
    return actions.agg(F.count("*").alias("selected"), n("copied", "updated", "unchanged").alias("passed"), (F.count("*") - n("copied", "updated", "unchanged")).alias("blocked"), n("copied").alias("copied"), n("updated").alias("updated"), n("unchanged").alias("unchanged"))


def interactive_total(options: DataFrame, categories: DataFrame) -> DataFrame:
    """(item_id, total): options of filters and category tabs of a page together."""
    both = options.select("item_id").unionByName(categories.select("item_id"))
    return both.groupBy("item_id").agg(F.count("*").alias("total"))


def material_markdown(items: DataFrame, languages: list[str]) -> DataFrame:
    """(product_key, markdown): one table row for each language, in order, with links to what a reviewer
    opens.  ``items`` has product_key, name, page_model, strategy, language and a path for each of MATERIALS."""
    link = lambda kind: F.concat(F.lit("[open](<../"), F.col(f"{kind}_path"), F.lit(">)"))
    row = F.concat(F.lit("| "), F.concat_ws(" | ", "language", *map(link, MATERIALS)), F.lit(" |"))
    order = F.array_position(F.array(*map(F.lit, languages)), F.col("language"))
    rows = items.groupBy("product_key", "name", "page_model", "strategy").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), row.alias("row")))).alias("rows"))
    head = [F.concat(F.lit("# "), "name", F.lit(" ("), "product_key", F.lit(")")), F.lit(""), F.concat(F.lit("- page model: "), "page_model"), F.concat(F.lit("- strategy: "), "strategy"), F.concat(F.lit("- languages: "), F.size("rows").cast("string"), F.lit(f" of {len(languages)}")), F.lit(""), F.lit("| language | " + " | ".join(MATERIALS) + " |"), F.lit("|---" * (1 + len(MATERIALS)) + "|")]
    return rows.select("product_key", F.concat_ws("\n", *head, F.transform("rows", lambda r: r["row"])).alias("markdown"))
