"""Change detection over pages, orders, events and supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import changes, exclusions
from tessera.sources.commit import shared_path
from tessera.streaming.snapshots import watch

from .register import registrar

QUERIES, ORACLES, query = registrar()


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


@query("""SELECT page_id, CASE WHEN n IS NULL AND o IS NULL THEN 'missing_in_both' WHEN o IS NULL THEN 'added' WHEN n IS NULL THEN 'removed' WHEN n IS DISTINCT FROM o THEN 'modified' ELSE 'unchanged' END AS change
FROM (SELECT page_id, CASE WHEN url NOT LIKE '%/de/%' THEN html END AS n, CASE WHEN url NOT LIKE '%/fr/%' AND length(html) < 9000 THEN replace(html, '<ul><li>', '<ul> <li>') WHEN url NOT LIKE '%/fr/%' THEN html END AS o FROM pages WHERE html IS NOT NULL)""")
def page_snapshot_changes(spark, d):
    pages = _t(spark, d, "pages").where("html is not null")
    new = pages.where("url not like '%/de/%'")
    old = pages.where("url not like '%/fr/%'").withColumn("html", F.when(F.length("html") < 9000, F.replace("html", F.lit("<ul><li>"), F.lit("<ul> <li>"))).otherwise(F.col("html")))
    return changes.snapshot_changes(pages, new, old, "page_id", "html")


_MAP = "SELECT c_mktsegment AS os, n_name AS region, o_orderpriority AS id, o_orderstatus AS s FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


@query(f"""WITH m AS ({_MAP}), a AS (SELECT os, region, list_sort(list(DISTINCT id)) AS ids FROM m WHERE s = 'F' GROUP BY 1, 2), b AS (SELECT os, region, list_sort(list(DISTINCT id)) AS ids FROM m WHERE s = 'P' GROUP BY 1, 2)
SELECT * FROM (SELECT coalesce(a.os, b.os) AS os, coalesce(a.region, b.region) AS region, CASE WHEN a.ids IS NULL THEN 'added' WHEN b.ids IS NULL THEN 'removed' WHEN a.ids != b.ids THEN 'table_ids_changed' END AS change
FROM a FULL JOIN b ON a.os = b.os AND a.region = b.region) WHERE change IS NOT NULL""")
def mapping_changes(spark, d):
    rows = _t(spark, d, "orders").join(_t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(_t(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    of = lambda s: exclusions.load_exclusions(rows.where(F.col("o_orderstatus") == s).groupBy(F.col("c_mktsegment").alias("os"), F.col("n_name").alias("region")).agg(F.collect_set(F.concat(F.lit(" #"), "o_orderpriority")).alias("ids")))
    return changes.mapping_changes(of("F"), of("P"))


@query("""WITH st AS (SELECT n_name, r_name, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey, region),
e AS (SELECT n_name AS os, r_name AS region, list(DISTINCT c_mktsegment) AS ids FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal < 0 GROUP BY 1, 2)
SELECT st.n_name AS os, st.r_name AS region, e.ids IS NOT NULL AS row_present, CAST(coalesce(len(any_value(e.ids)), 0) AS BIGINT) AS n_ids, count(*) AS states FROM st LEFT JOIN e ON st.n_name = e.os AND st.r_name = e.region GROUP BY 1, 2, 3""")
def region_lookup_with_misses(spark, d):
    """Every (nation, region) state looked up in a sparse table; misses are recorded too."""
    both = _t(spark, d, "customer").join(F.broadcast(_t(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    regions = F.broadcast(_t(spark, d, "region"))
    raw = both.where("c_acctbal < 0").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("n_name").alias("os"), F.col("r_name").alias("region")).agg(F.collect_set("c_mktsegment").alias("ids"))
    states = both.select(F.col("n_name").alias("os")).crossJoin(regions.select(F.col("r_name").alias("region")))
    return exclusions.usage(exclusions.lookup(states, exclusions.load_exclusions(raw))).join(exclusions.load_exclusions(raw).select("os", "region", F.size("table_ids").alias("n")), ["os", "region"], "left").select("os", "region", "row_present", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n_ids"), "states")


_REC = "SELECT user_id, CASE WHEN extract(hour FROM ts) < 12 THEN 'zh-cn' ELSE 'en-us' END AS language, event_type AS os, json_extract_string(props, '$.k') AS region, value FROM events"


@query(f"""WITH r AS ({_REC}), c AS (SELECT os, region FROM r GROUP BY 1, 2 HAVING max(value) > 400), h AS (SELECT DISTINCT user_id FROM r JOIN c USING (os, region)),
w AS (SELECT user_id FROM r GROUP BY 1 HAVING count(DISTINCT language) >= 2), p AS (SELECT DISTINCT user_id FROM r)
SELECT * FROM (SELECT p.user_id AS product_key, CASE WHEN h.user_id IS NOT NULL THEN 'lookup changed' WHEN w.user_id IS NULL THEN 'incomplete evidence' END AS reason FROM p LEFT JOIN h USING (user_id) LEFT JOIN w USING (user_id)) WHERE reason IS NOT NULL""")
def affected_by_usage(spark, d):
    recorded = _t(spark, d, "events").select(F.col("user_id").alias("product_key"), F.when(F.hour("ts") < 12, "zh-cn").otherwise("en-us").alias("language"), F.col("event_type").alias("os"), F.get_json_object("props", "$.k").alias("region"), "value")
    changed = recorded.groupBy("os", "region").agg(F.max("value").alias("most")).where("most > 400")
    return changes.affected_by_usage(changed, recorded, recorded.select("product_key").distinct(), 2)


@query("""SELECT product_key, fields FROM (SELECT s_suppkey AS product_key, concat_ws(',', CASE WHEN s_acctbal < 0 THEN 's_acctbal' END, CASE WHEN s_nationkey > 20 THEN 's_nationkey' END) AS fields FROM supplier) WHERE fields != ''""")
def definition_changes(spark, d):
    old = _t(spark, d, "supplier").withColumnRenamed("s_suppkey", "product_key")
    new = old.withColumn("s_acctbal", F.greatest("s_acctbal", F.lit(0.0))).withColumn("s_nationkey", F.least("s_nationkey", F.lit(20)))
    return changes.definition_changes(old, new, ["s_acctbal", "s_nationkey", "s_name"])


@query("""SELECT p_partkey AS product_key, concat_ws(',', CASE WHEN h THEN 'html' END, CASE WHEN c THEN 'config' END, CASE WHEN f THEN 'definition' END) AS sources, CAST(h AS BIGINT) + CAST(c AS BIGINT) + CAST(f AS BIGINT) AS n
FROM (SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) AS h, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09) AS c, p_size > 45 AS f FROM part) WHERE h OR c OR f""")
def change_plan(spark, d):
    lines, parts = _t(spark, d, "lineitem"), _t(spark, d, "part")
    known = parts.select(F.col("p_partkey").alias("product_key"))
    key = F.col("l_partkey").alias("product_key")
    sources = {"html": lines.where("l_returnflag = 'R' and l_quantity > 45").select(key), "config": lines.where("l_discount > 0.09").select(key), "definition": parts.where("p_size > 45").select(F.col("p_partkey").alias("product_key"))}
    plan = changes.change_plan(sources)
    return plan.join(known, "product_key", "left_semi")


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) AND p_size <= 45")
def unchanged_keys(spark, d):
    gone = _t(spark, d, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return _t(spark, d, "part").where("p_size <= 45").select("p_partkey").join(gone, "p_partkey", "left_anti")


@query("SELECT o_orderkey, concat_ws('；', CASE WHEN o_totalprice > 300000 THEN '页面 page' END, CASE WHEN o_orderstatus = 'F' THEN '配置 config' END, CASE WHEN o_orderpriority LIKE '1%' THEN '定义 definition' END) AS reason FROM orders")
def bilingual_reason(spark, d):
    from tessera.functions.scalars import reason_sentence

    reason = reason_sentence((F.col("o_totalprice") > 300000, "页面 page"), (F.col("o_orderstatus") == "F", "配置 config"), (F.col("o_orderpriority").startswith("1"), "定义 definition"))
    return _t(spark, d, "orders").select("o_orderkey", reason.alias("reason"))


@query("""WITH lim AS (SELECT min(ts) + (max(ts) - min(ts)) * 0.8 AS t FROM events), e AS (SELECT user_id, event_type, event_id, value, ts >= t AS fresh FROM events, lim), f AS (SELECT DISTINCT user_id, event_type, true AS again FROM e WHERE fresh), c AS (SELECT user_id, event_type FROM e GROUP BY 1, 2 HAVING max(value) > 10)
SELECT e.user_id, e.event_type, e.event_id FROM e LEFT JOIN f ON f.user_id = e.user_id AND f.event_type = e.event_type JOIN c ON c.user_id = e.user_id AND c.event_type = e.event_type WHERE e.fresh OR f.again IS NULL""")
def evidence_merge(spark, d):
    events = _t(spark, d, "events")
    limit = events.agg((F.min("ts") + (F.max("ts") - F.min("ts")) * 0.8).alias("t"))
    seen = events.crossJoin(F.broadcast(limit)).withColumn("fresh", F.col("ts") >= F.col("t")).select("user_id", "event_type", "event_id", "value", "fresh")
    consumers = events.groupBy("user_id", "event_type").agg(F.max("value").alias("v")).where("v > 10")
    return changes.merge_evidence(seen.where("not fresh"), seen.where("fresh"), ["user_id", "event_type"], consumers).select("user_id", "event_type", "event_id")


@query("""SELECT c_custkey, concat_ws(' - ', n_name, r_name, c_mktsegment) AS group_name, '[{"filterKey":"software","matchValues":"' || n_name || '"},{"filterKey":"region","matchValues":"' || r_name || '"}' || CASE WHEN c_acctbal > 0 THEN ',{"filterKey":"category","matchValues":"' || c_mktsegment || '"}' ELSE '' END || ']' AS criteria
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def criteria_json(spark, d):
    from tessera.functions import scalars

    rows = _t(spark, d, "customer").join(F.broadcast(_t(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(_t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    criteria = scalars.criteria_json([("software", F.col("n_name")), ("region", F.col("r_name")), ("category", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")))])
    return rows.select("c_custkey", scalars.group_name(F.array("n_name", "r_name", "c_mktsegment")).alias("group_name"), criteria.alias("criteria"))


@query("""SELECT control, '[' || string_agg('{"value":"' || c_custkey || '","label":"' || c_name || '","href":"#' || c_custkey || '","isActive":true' || CASE WHEN rn = 1 THEN ',"isDefault":true' ELSE '' END || '}', ',' ORDER BY rn) || ']' AS options
FROM (SELECT *, c_custkey // 20 AS control, row_number() OVER (PARTITION BY c_custkey // 20 ORDER BY c_custkey) AS rn FROM customer) GROUP BY 1""")
def filter_options_json(spark, d):
    """Controls of twenty customers at most, as the keys run, so that no row grows with the table."""
    from tessera.functions.scalars import options_json

    option = F.struct("c_custkey", F.col("c_custkey").cast("string").alias("value"), F.col("c_name").alias("label"), F.concat(F.lit("#"), F.col("c_custkey").cast("string")).alias("href"))
    controls = _t(spark, d, "customer").groupBy(F.expr("c_custkey div 20").alias("control")).agg(F.array_sort(F.collect_list(option)).alias("o"))
    return controls.select("control", options_json(F.col("o")).alias("options"))


@query("""WITH cat AS (SELECT DISTINCT c_nationkey AS software, c_mktsegment AS category FROM customer WHERE c_acctbal > 5000)
SELECT n_nationkey AS software, r_name AS region, category, row_number() OVER (PARTITION BY n_nationkey ORDER BY r_regionkey, category) AS state FROM nation CROSS JOIN region LEFT JOIN cat ON software = n_nationkey""")
def complex_states(spark, d):
    from tessera.operators import controls

    software = _t(spark, d, "nation").select(F.col("n_nationkey").alias("software"))
    regions = _t(spark, d, "region").select(F.col("r_name").alias("region"), F.col("r_regionkey").alias("r_ord"))
    categories = _t(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_nationkey").alias("software"), F.col("c_mktsegment").alias("category")).distinct().withColumn("c_ord", F.col("category"))
    return controls.complex_states(software, regions, categories).select("software", "region", "category", "state")


@query("SELECT lower(p_brand) AS target, min(p_partkey) AS ord, arg_min(p_type, p_partkey) AS label, CASE WHEN count(DISTINCT p_type) > 1 THEN 'two labels' END AS error FROM part GROUP BY 1")
def category_catalog(spark, d):
    from tessera.operators import controls

    return controls.category_catalog(_t(spark, d, "part").select(F.lower("p_brand").alias("target"), F.col("p_partkey").alias("ord"), F.col("p_type").alias("label")))


@query("""WITH u AS (SELECT DISTINCT p_brand AS grp, p_type AS table_id, p_partkey AS unit FROM part), x AS (SELECT DISTINCT p_brand AS grp, 'os' AS os, n_name AS region, p_type AS table_id FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_discount > 0.09),
m AS (SELECT x.*, n FROM x LEFT JOIN (SELECT grp, table_id, count(DISTINCT unit) AS n FROM u WHERE table_id < 'M' GROUP BY 1, 2) USING (grp, table_id))
SELECT grp, region, count(n) AS hits, CASE WHEN count(n) = 0 THEN 'no unit' WHEN max(coalesce(n, 0)) > 1 THEN 'several units' END AS error FROM m GROUP BY 1, 2""")
def applicable_exclusions(spark, d):
    parts = _t(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    units = parts.where("p_type < 'M'").select(F.col("p_brand").alias("grp"), F.col("p_type").alias("table_id"), F.col("p_partkey").alias("unit"))
    lines = _t(spark, d, "lineitem").where("l_discount > 0.09").select("l_partkey", "l_suppkey")
    places = _t(spark, d, "supplier").join(F.broadcast(_t(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    lookups = rows.groupBy(F.col("p_brand").alias("grp"), F.lit("os").alias("os"), F.col("n_name").alias("region")).agg(F.collect_set("p_type").alias("table_ids"))
    return exclusions.applicability(lookups, units, "grp", many=False).select("grp", "region", "hits", "error")


@query("""SELECT v.version, CAST(page_id AS BIGINT) AS page_id, v.change FROM pages, (VALUES (CAST(0 AS BIGINT), 1, 'added'), (1, 3, 'modified'), (2, 5, 'removed'), (3, 10, 'added')) v(version, every, change) WHERE page_id % v.every = 0""")
def page_stream_changes(spark, d):
    """All pages arrive as a stream of four snapshots: all of them, a third changed and a third as it was, a fifth deleted, and a tenth back
    again while the rest of the fifth is deleted once more."""
    pages = spark.read.parquet(f"{d}/pages.parquet").select(F.col("page_id").cast("bigint").alias("page_id"), "html")
    root, key = shared_path(spark, "stream"), F.col("page_id")
    none = F.lit(None).cast("string")
    arrivals = (
        pages,
        pages.where(key % 3 < 2).withColumn("html", F.when(key % 3 == 0, F.concat("html", F.lit("!"))).otherwise(F.col("html"))),
        pages.where(key % 5 == 0).withColumn("html", none),
        pages.where(key % 5 == 0).withColumn("html", F.when(key % 10 == 0, F.col("html"))),
    )
    for arrival in arrivals:
        arrival.write.mode("append").parquet(f"{root}/in")
        watch(spark, f"{root}/in", None, f"{root}/changes", f"{root}/checkpoint", files=None).awaitTermination()
    return spark.read.schema("page_id bigint, change string, version bigint").parquet(f"{root}/changes").select("version", "page_id", "change")
