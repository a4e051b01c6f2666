"""Batch accounts: every order is a product, every line an item with five stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import batch, chains

from .register import registrar

QUERIES, ORACLES, query = registrar()

_STAGES = {
    "input": "CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 'blocked' ELSE 'passed' END",
    "extraction": "CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 'not_run' WHEN l_discount = 0 AND l_tax > 0.06 THEN 'blocked' WHEN l_linestatus = 'O' AND l_quantity > 48 THEN 'pending' ELSE 'passed' END",
    "usage": "CASE WHEN l_tax = 0 AND l_quantity < 3 THEN 'failed' ELSE 'passed' END",
    "l3a": "CASE WHEN l_discount > 0.09 AND l_tax > 0.07 THEN 'failed' ELSE 'passed' END",
    "l3b": "CASE WHEN l_discount > 0.09 AND l_quantity > 45 THEN 'failed' ELSE 'passed' END",
}
_COLS = ", ".join(f"{sql} AS {name}" for name, sql in _STAGES.items())
_ALL = "[" + ", ".join(_STAGES) + "]"
_STATUS = f"CASE WHEN list_contains({_ALL}, 'pending') THEN 'pending' WHEN list_contains({_ALL}, 'blocked') THEN 'blocked' WHEN list_contains({_ALL}, 'failed') THEN 'failed' ELSE 'passed' END"
_FIRST = "coalesce(" + ", ".join(f"CASE WHEN {s} = 'blocked' THEN '{s}' END" for s in _STAGES) + ", concat_ws(',', " + ", ".join(f"CASE WHEN {s} = 'failed' THEN '{s}' END" for s in _STAGES) + "))"
_ITEMS = f"(SELECT product_key, item, supp, {', '.join(_STAGES)}, {_STATUS} AS status, {_FIRST} AS reason FROM (SELECT l_orderkey AS product_key, CAST(l_linenumber AS BIGINT) AS item, l_suppkey AS supp, {_COLS} FROM lineitem))"
_PRODUCTS = f"(SELECT product_key, CASE WHEN bool_or(status = 'pending') THEN 'pending' WHEN bool_or(status = 'blocked') THEN 'blocked' WHEN bool_or(status = 'failed') THEN 'failed' ELSE 'passed' END AS status, count(*) AS items FROM {_ITEMS} GROUP BY 1)"


def _items(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    staged = lines.select(F.col("l_orderkey").alias("product_key"), F.col("l_linenumber").cast("bigint").alias("item"), F.col("l_suppkey").alias("supp"), *(F.expr(sql).alias(name) for name, sql in _STAGES.items()))
    return staged.withColumn("status", batch.item_status()).withColumn("reason", batch.item_reason())


@query(f"SELECT product_key, item, status, reason FROM {_ITEMS}")
def item_status(spark, d):
    return _items(spark, d).select("product_key", "item", "status", "reason")


@query(f"SELECT * FROM {_PRODUCTS}")
def product_status(spark, d):
    return batch.product_status(_items(spark, d))


@query(" UNION ALL ".join(f"SELECT '{s}' AS stage, CASE WHEN bool_or({s} = 'pending') THEN 'in_progress' WHEN bool_and({s} = 'passed') THEN 'passed' ELSE 'completed_with_issues' END AS status, count(*) AS n FROM {_ITEMS}" + (" WHERE input = 'passed'" if s != "input" else "") for s in _STAGES))
def stage_status(spark, d):
    return batch.stage_status(_items(spark, d))


@query(" UNION ALL ".join(f"SELECT '{g}' AS grain, count(*) AS planned, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'blocked') AS blocked, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'passed') AS passed, CASE WHEN bool_and(status = 'passed') THEN 'passed' ELSE 'completed_with_issues' END AS final FROM {t}" for g, t in (("items", _ITEMS), ("products", _PRODUCTS))))
def batch_summary(spark, d):
    return batch.batch_summary(_items(spark, d))


@query(f"""SELECT supp, status, sum(c)::BIGINT AS n, string_agg(reason, ',' ORDER BY k) AS reasons FROM (SELECT supp, status, reason, count(*) AS c, min(product_key * 100 + item) AS k FROM {_ITEMS} GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def batch_report(spark, d):
    rows = _items(spark, d).withColumn("k", F.col("product_key") * 100 + F.col("item"))
    return batch.batch_report(rows, "k", "supp")


@query(f"""SELECT product_key, item, CASE WHEN max(status) != 'passed' OR min(status) != 'passed' THEN 'run' WHEN item > 5 THEN 'blocked' ELSE 'reuse' END AS action FROM {_ITEMS} GROUP BY 1, 2""")
def resume_pending(spark, d):
    items = _items(spark, d).groupBy("product_key", "item").agg(F.min("input").alias("input"), F.max("supp").alias("supp"), F.bool_and(F.col("status") == "passed").alias("whole"))
    finished = items.where("whole").withColumn("supp", F.when(F.col("item") > 5, -F.col("supp") - 1).otherwise(F.col("supp")))
    return batch.resume_pending(items, finished, ["product_key", "item"], ["input", "supp"])


@query("SELECT o_orderkey AS record, first_value(o_orderkey) OVER w AS root, row_number() OVER w - 1 AS depth FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def reprocess_chain(spark, d):
    return chains.chain_depths(chains.linear_chains(spark.read.parquet(f"{d}/orders.parquet"), "o_custkey", "o_orderdate", "o_orderkey"))


@query("SELECT arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS root, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest, count(*) AS length FROM orders GROUP BY o_custkey")
def latest_record(spark, d):
    return chains.latest_record(chains.chain_depths(chains.linear_chains(spark.read.parquet(f"{d}/orders.parquet"), "o_custkey", "o_orderdate", "o_orderkey")))


@query("""WITH r AS (SELECT o_orderkey AS record, CASE WHEN o_totalprice > 300000 THEN -o_orderkey ELSE min(o_orderkey) OVER (PARTITION BY o_custkey) END AS parent FROM orders), s AS (SELECT record, CASE WHEN parent != record THEN parent END AS parent FROM r)
SELECT parent AS record, 'fork' AS error FROM s WHERE parent IS NOT NULL GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT record, 'orphan' FROM s WHERE parent IS NOT NULL AND parent NOT IN (SELECT record FROM s)""")
def chain_conflicts(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"))
    records = orders.join(first, "o_custkey").select(F.col("o_orderkey").alias("record"), F.when(F.col("o_totalprice") > 300000, -F.col("o_orderkey")).when(F.col("first") != F.col("o_orderkey"), F.col("first")).alias("parent"))
    return chains.chain_conflicts(records)
