"""Review and release: customers are products, their orders' states the languages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import canonical
from tessera.operators import review
from tessera.sources import commit, freeze

from .register import registrar

QUERIES, ORACLES, query = registrar()


def _items(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.select(F.col("o_custkey").alias("product_key"), F.col("o_orderstatus").alias("language"), F.when(F.col("o_totalprice") > 30000, "passed").otherwise("failed").alias("status"), F.when(F.col("o_orderpriority").startswith("5"), "support").otherwise("flexible").alias("page_model"), F.when(F.col("o_totalprice") > 400000, "complex").otherwise("simple").alias("strategy"))


_QUEUE = """(SELECT product_key, reasons = '' AS queued, reasons FROM (SELECT o_custkey AS product_key, concat_ws('；', CASE WHEN count(DISTINCT o_orderstatus) FILTER (o_totalprice > 30000) < 2 THEN 'language missing' END,
 CASE WHEN count(DISTINCT o_orderpriority LIKE '5%') > 1 THEN 'page models differ' END, CASE WHEN count(DISTINCT o_totalprice > 400000) > 1 THEN 'strategies differ' END) AS reasons FROM orders GROUP BY 1))"""
_DECIDED = "(SELECT c_custkey AS product_key, CASE WHEN c_acctbal < 0 THEN 'rejected' ELSE 'approved' END AS decision FROM customer WHERE c_acctbal < 7000)"
_STATUS = f"(SELECT q.product_key, coalesce(decision, 'pending') AS status FROM {_QUEUE} q LEFT JOIN {_DECIDED} USING (product_key) WHERE queued)"


def _queue(spark, d):
    return review.review_queue(_items(spark, d), 2)


def _decisions(spark, d):
    return spark.read.parquet(f"{d}/customer.parquet").where("c_acctbal < 7000").select(F.col("c_custkey").alias("product_key"), F.when(F.col("c_acctbal") < 0, "rejected").otherwise("approved").alias("decision"))


def _status(spark, d):
    return review.review_status(_queue(spark, d), _decisions(spark, d))


@query(f"SELECT * FROM {_QUEUE}")
def review_queue(spark, d):
    return _queue(spark, d)


@query(f"SELECT status, count(*) AS n FROM {_STATUS} GROUP BY 1")
def review_status(spark, d):
    return _status(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query(f"SELECT c_custkey AS product_key, CASE WHEN q.product_key IS NULL THEN 'not queued' WHEN o.run != c.run THEN 'binding differs' END AS error FROM (SELECT c_custkey, c_nationkey AS run FROM customer WHERE c_acctbal < 7000) c LEFT JOIN (SELECT product_key FROM {_QUEUE} WHERE queued) q ON q.product_key = c_custkey LEFT JOIN (SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey + 1 ELSE c_nationkey END AS run FROM customer) o ON o.k = c_custkey")
def decision_binding(spark, d):
    customers = spark.read.parquet(f"{d}/customer.parquet")
    decisions = customers.where("c_acctbal < 7000").select(F.col("c_custkey").alias("product_key"), F.col("c_nationkey").alias("run"))
    queue = _queue(spark, d).where("queued").join(customers.select(F.col("c_custkey").alias("product_key"), F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")).alias("run")), "product_key")
    return review.decision_binding(decisions, queue, ["run"])


_DELIVERED = "(SELECT DISTINCT o_custkey AS product_key FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 350000)"
_ENDED = "(SELECT DISTINCT o_custkey AS product_key FROM orders WHERE o_totalprice < 2000)"
_OPEN = "(SELECT DISTINCT o_custkey AS product_key FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')"


def _sets(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").withColumnRenamed("o_custkey", "product_key")
    pick = lambda c: orders.where(c).select("product_key").distinct()
    return pick("o_orderstatus = 'F' and o_totalprice > 350000"), pick("o_totalprice < 2000"), pick("o_orderdate >= timestamp '1996-01-01'")


@query(f"SELECT product_key FROM {_OPEN} WHERE product_key NOT IN (SELECT product_key FROM {_DELIVERED}) AND product_key NOT IN (SELECT product_key FROM {_ENDED})")
def unresolved_products(spark, d):
    delivered, ended, affected = _sets(spark, d)
    return review.unresolved(affected, delivered, ended)


@query(f"SELECT product_key, CASE status WHEN 'rejected' THEN 'rejected' WHEN 'pending' THEN 'pending' ELSE 'included' END AS reason FROM {_STATUS}")
def release_full(spark, d):
    return review.release_rows(_status(spark, d))


@query(f"""SELECT coalesce(q.product_key, s.product_key) AS product_key, CASE WHEN status = 'rejected' THEN 'rejected' WHEN status = 'pending' THEN 'pending' WHEN status IS NULL THEN 'not_queued' WHEN q.product_key IN (SELECT product_key FROM {_DELIVERED}) THEN 'delivered' WHEN q.product_key IN (SELECT product_key FROM {_ENDED}) THEN 'ended' WHEN q.product_key NOT IN (SELECT product_key FROM {_OPEN}) THEN 'not_open' ELSE 'included' END AS reason
FROM {_QUEUE} q FULL JOIN {_STATUS} s ON s.product_key = q.product_key""")
def release_delta(spark, d):
    delivered, ended, affected = _sets(spark, d)
    return review.release_rows(_status(spark, d), delivered=delivered, ended=ended, open_products=affected, queue=_queue(spark, d))


@query("""SELECT p_partkey AS path, CASE WHEN p_size = 50 THEN 'missing' WHEN p_size < 3 THEN 'differs' END AS error FROM part WHERE p_size = 50 OR p_size < 3 UNION ALL SELECT -p_partkey, 'extra' FROM part WHERE p_retailprice > 1800""")
def release_verify(spark, d):
    parts = spark.read.parquet(f"{d}/part.parquet")
    listed = parts.select(F.col("p_partkey").alias("path"), F.col("p_name").alias("content"))
    found = parts.where("p_size != 50").select(F.col("p_partkey").alias("path"), F.when(F.col("p_size") < 3, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name")).alias("content"))
    extra = parts.where("p_retailprice > 1800").select((-F.col("p_partkey")).alias("path"), F.col("p_name").alias("content"))
    return review.verify_listing(listed, found.unionByName(extra), "path", "content")


@query("SELECT l_orderkey AS run, l_partkey AS product_key, count(DISTINCT l_linenumber) AS releases FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_linenumber) > 1")
def delivery_overlap(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    return review.delivery_overlap(lines.select(F.col("l_orderkey").alias("run"), F.col("l_partkey").alias("product_key"), F.col("l_linenumber").alias("release")))


@query("SELECT event_id, k AS key FROM (SELECT event_id, unnest(['k', event_type || '_hash', 'inner']) AS k FROM events) WHERE k LIKE '%hash%'")
def forbidden_keys(spark, d):
    rows = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.concat(F.lit('{"'), "event_type", F.lit('_hash": {"inner": '), "props", F.lit("}}")).alias("json"))
    return review.forbidden_keys(rows, "event_id", "json")


@query("""SELECT o_custkey AS product_key, CASE WHEN a.n = coalesce(i.n, 0) THEN a.n > 0 ELSE coalesce(i.n, 0) > 0 AND c_acctbal < 0 END AS can_submit FROM (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY 1) a
LEFT JOIN (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n FROM orders WHERE o_orderstatus != 'O' GROUP BY 1) i USING (o_custkey) JOIN customer ON c_custkey = o_custkey""")
def submit_gate(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    forms = orders.groupBy(F.col("o_custkey").alias("product_key")).agg(F.collect_set("o_orderpriority").alias("all_items"), F.collect_set(F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority"))).alias("inspected"))
    people = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("product_key"), F.col("c_name").alias("reviewer"), F.col("c_mktsegment").alias("notes"), F.when(F.col("c_acctbal") < 0, "rejected").otherwise("approved").alias("decision"))
    return review.submit_gate(forms.join(people, "product_key")).select("product_key", "can_submit")


@query("SELECT c_custkey AS product_key FROM customer WHERE c_acctbal >= 0 AND lower(c_mktsegment || ' ' || c_name) LIKE '%ui%'")
def product_filter(spark, d):
    customers = spark.read.parquet(f"{d}/customer.parquet")
    listed = customers.select(F.col("c_mktsegment").alias("product_key"), "c_custkey", F.col("c_name").alias("name"), F.when(F.col("c_acctbal") < 0, "rejected").otherwise("approved").alias("status"))
    return review.product_filter(listed, status="approved", text="UI").select(F.col("c_custkey").alias("product_key"))


@query("""SELECT o_custkey AS product_key, o_orderkey AS language, CASE WHEN bool_and(o_totalprice >= 1500) OVER (PARTITION BY o_custkey) THEN CASE WHEN o_orderstatus = 'P' THEN 'copied' WHEN o_totalprice > 100000 THEN 'unchanged' ELSE 'updated' END ELSE 'blocked' END AS action FROM orders""")
def freeze_action(spark, d):
    """All orders of a customer are frozen together, or none."""
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("product_key"), F.col("o_orderkey").alias("language"), "o_orderstatus", "o_totalprice", F.col("o_orderpriority").alias("content"))
    upstream = orders.where("o_totalprice >= 1500")
    frozen = orders.where("o_orderstatus != 'P'").withColumn("content", F.when(F.col("o_totalprice") > 100000, F.col("content")).otherwise(F.lit("old")))
    return commit.freeze_actions(orders, upstream, frozen, ["product_key", "language"], "product_key", "content")


@query("""WITH o AS (SELECT o_custkey AS product_key, o_orderkey AS language, o_orderpriority AS old, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority || '*' ELSE o_orderpriority END AS new, min(o_totalprice) OVER (PARTITION BY o_custkey) < 5000 AS blocked FROM orders)
SELECT product_key, language, CASE WHEN blocked THEN 'blocked' WHEN old = new THEN 'unchanged' ELSE 'updated' END AS action, CASE WHEN blocked THEN old ELSE new END AS content, CASE WHEN blocked THEN 'source missing or empty' END AS error FROM o""")
def frozen_versions(spark, d):
    """Two freezes of all orders, the second after some have changed and some are gone: what the current version then holds."""
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("product_key"), F.col("o_orderkey").alias("language"), F.col("o_orderpriority").alias("content"), "o_orderstatus", "o_totalprice")
    root, keys = commit.shared_path(spark, "frozen"), ["product_key", "language"]
    freeze.freeze(spark, root, orders, lambda: orders.select(*keys, "content"))
    changed = F.when(F.col("o_orderstatus") == "F", F.concat("content", F.lit("*"))).otherwise(F.col("content"))
    report = freeze.freeze(spark, root, orders, lambda: orders.where("o_totalprice >= 5000").select(*keys, changed.alias("content")))
    held = freeze.current(spark, root, "product_key bigint, language bigint, content string")
    return report.drop("n_bytes").join(held, keys)


_FLAWS = """SELECT o_custkey AS product_key, o_orderkey AS item_id, o_orderstatus AS language, o_orderkey AS k FROM orders"""
_STAGES = """list_filter([CASE WHEN k % 10 = 0 THEN 'why' WHEN k % 5 = 0 THEN 'result is failed' END, CASE WHEN k % 7 = 0 THEN 'source not fixed' END, CASE WHEN k % 11 = 0 THEN 'extraction not passed' END, CASE WHEN k % 13 = 0 THEN 'l3a not passed' END, CASE WHEN k % 17 = 0 THEN 'l3b not passed' END], lambda x: x IS NOT NULL)"""
_LACKS = """CASE WHEN k % 19 = 0 AND k % 23 = 0 THEN ['missing: payload, l3b'] WHEN k % 19 = 0 THEN ['missing: payload'] WHEN k % 23 = 0 THEN ['missing: l3b'] ELSE [] END"""
_JUDGED = """list_filter([CASE WHEN k % 29 = 0 THEN 'payload: R05 slug' END, CASE WHEN k % 31 = 0 THEN 'l3a report: not of this run' WHEN k % 37 = 0 THEN 'l3a report: of another item' WHEN k % 3 = 0 THEN 'l3a report: of another payload' END, CASE WHEN k % 43 = 0 THEN 'l3b report: several' WHEN k % 41 = 0 THEN 'l3b report: not passed' END], lambda x: x IS NOT NULL)"""
_REASONS = f"(SELECT product_key, item_id, language, CASE WHEN len({_STAGES}) > 0 THEN {_STAGES} WHEN len({_LACKS}) > 0 THEN {_LACKS} ELSE {_JUDGED} END AS reasons FROM ({_FLAWS}))"


def _queued(spark, d):
    """Orders as items of a run, with faults in stages, materials, payloads and reports, alone and together."""
    k, bad = F.col("o_orderkey"), lambda n: F.col("o_orderkey") % n == 0
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", k.alias("item_id"), F.col("o_custkey").alias("product_key"), F.col("o_orderstatus").alias("language"), F.lit("run-1").alias("run"), F.sha2(k.cast("string"), 256).alias("content"))
    state = lambda n: F.when(bad(n), "failed").otherwise("passed")
    items = orders.select("*", state(5).alias("status"), F.when(bad(10), "why").alias("error"), state(7).alias("input"), state(11).alias("extraction"), state(13).alias("l3a"), state(17).alias("l3b"), F.when(bad(29), "R05 slug").alias("broken"))
    present = F.array_compact(F.array(F.lit("source"), F.when(~bad(19), "payload"), F.lit("l3a"), F.when(~bad(23), "l3b")))
    materials = orders.select("run", "item_id", F.explode(present).alias("material"))
    first = orders.select(F.when(bad(31), "run-0").otherwise(F.col("run")).alias("run"), "item_id", F.lit("l3a").alias("check"), F.when(bad(37), -1).otherwise(F.col("product_key")).alias("product_key"), "language", F.lit("passed").alias("status"), F.when(bad(3), "other").otherwise(F.col("content")).alias("content"))
    times = F.explode(F.when(bad(43), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    second = orders.select("run", "item_id", F.lit("l3b").alias("check"), "product_key", "language", F.when(bad(41), "failed").otherwise("passed").alias("status"), "content", times.alias("n")).drop("n")
    return review.queue_items(items, materials, first.unionByName(second))


@query(f"SELECT item_id, product_key, language, array_to_string(reasons, ' | ') AS reasons FROM {_REASONS}")
def queue_item_reasons(spark, d):
    return _queued(spark, d).withColumn("reasons", F.array_join("reasons", " | "))


@query(f"""WITH r AS (SELECT * FROM {_REASONS}), c AS (SELECT DISTINCT product_key, l FROM r, (VALUES ('F'), ('O')) v(l)),
t AS (SELECT c.product_key, c.l, CASE WHEN count(r.item_id) = 0 THEN c.l || ': no item' WHEN count(r.item_id) > 1 THEN c.l || ': several items' WHEN len(any_value(r.reasons)) = 0 THEN NULL ELSE array_to_string(list_transform(any_value(r.reasons), lambda x: c.l || ': ' || x), ' | ') END AS told
 FROM c LEFT JOIN r ON r.product_key = c.product_key AND r.language = c.l GROUP BY c.product_key, c.l)
SELECT product_key, count(told) = 0 AS ready, coalesce(string_agg(told, ' | ' ORDER BY l), '') AS reasons FROM t GROUP BY product_key""")
def queue_product_gate(spark, d):
    return review.queue_products(_queued(spark, d), ["F", "O"]).withColumn("reasons", F.array_join("reasons", " | "))


@query(r"""SELECT c_custkey AS product_key, sha256('{' || chr(10) || '  "title": "' || c_name || '\t\"价\\' || c_mktsegment || '\u0001",' || chr(10) || '  "n": ' || c_nationkey || ',' || chr(10) || '  "flag": ' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || ',' || chr(10)
|| '  "tags": ' || CASE WHEN c_nationkey % 3 = 0 THEN '[]' ELSE '[' || chr(10) || '    "' || c_mktsegment || '",' || chr(10) || '    "' || c_name || '"' || chr(10) || '  ]' END || ',' || chr(10)
|| '  "options": [' || chr(10) || '    {' || chr(10) || '      "label": "a",' || chr(10) || '      "isDefault": true' || chr(10) || '    },' || chr(10) || '    {' || chr(10) || '      "label": "b"' || chr(10) || '    }' || chr(10) || '  ]'
|| CASE WHEN c_nationkey > 12 THEN ',' || chr(10) || '  "shared": "<p>/' || c_mktsegment || '</p>"' ELSE '' END || chr(10) || '}' || chr(10)) AS bytes_sha256 FROM customer""")
def canonical_payload_bytes(spark, d):
    """The one text of payloads made of customers: escapes, empty and full arrays, and a field that some lack."""
    c = spark.read.parquet(f"{d}/customer.parquet")
    option = lambda label, default: F.struct(F.lit(label).alias("label"), default.alias("isDefault"))
    payload = F.struct(
        F.concat("c_name", F.lit('\t"价\\'), "c_mktsegment", F.lit("\x01")).alias("title"),
        F.col("c_nationkey").alias("n"),
        (F.col("c_acctbal") > 0).alias("flag"),
        F.when(F.col("c_nationkey") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("c_mktsegment", "c_name")).alias("tags"),
        F.array(option("a", F.lit(True)), option("b", F.lit(None).cast("boolean"))).alias("options"),
        F.when(F.col("c_nationkey") > 12, F.concat(F.lit("<p>/"), "c_mktsegment", F.lit("</p>"))).alias("shared"),
    )
    made = c.select(F.col("c_custkey").alias("product_key"), payload.alias("payload"))
    return made.select("product_key", F.sha2(canonical.payload_bytes(F.col("payload"), made.schema["payload"].dataType), 256).alias("bytes_sha256"))
