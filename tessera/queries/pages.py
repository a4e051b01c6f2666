"""Document-tree queries over pages, and value functions over documents."""

from __future__ import annotations

from html import unescape
from html.entities import html5

from pyspark.sql import functions as F

from tessera.functions import scalars
from tessera.operators import controls, exclusions, tree
from tessera.sources.html import shred

from .register import registrar


QUERIES, ORACLES, query = registrar()


def _pages(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet")


def _nodes(spark, d):
    """The node table, made once and read by the joins that follow."""
    from tessera.sources.commit import staged

    return staged(shred(_pages(spark, d)), "nodes")[0]


_CLEAN = r"(SELECT page_id, url, html, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<(script|style)>.*?</(script|style)>', '<\1></\1>', 'g') AS h FROM pages)"
_LINKS = rf"""(SELECT page_id, CAST(i AS BIGINT) AS ord, regexp_extract(a, 'href="([^"]*)"', 1) AS href, replace(regexp_extract(a, '<a href="[^"]*">([^<]*)<', 1), '&amp;', '&') AS label, a AS html
  FROM (SELECT page_id, unnest(l) AS a, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(h, '<li><a href="[^"]*">[^<]*</a></li>') AS l FROM {_CLEAN})))"""


@query(rf"SELECT tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(h, '<([a-z][a-z0-9]*)', 1)) AS tag FROM {_CLEAN}) GROUP BY 1")
def page_nodes_by_tag(spark, d):
    return shred(_pages(spark, d), columns=("kind", "tag")).where("kind = 'element'").groupBy("tag").agg(F.count("*").alias("n"))


def _values(rows) -> str:
    return ", ".join("({}, '{}')".format(key, value.replace("'", "''")) for key, value in rows)


# character references as HTML has them: of names the longest known one, with or without its semicolon; some numbers stand for other characters, or for none
_NAMES = _values((f"'{name}'", value) for name, value in sorted(html5.items()))
_SPECIAL = (n for n in (*range(0xA0), *range(0xFDD0, 0xFDF0), *(plane + end for plane in range(0, 0x110000, 0x10000) for end in (0xFFFE, 0xFFFF))))
_NUMBERS = _values((n, unescape(f"&#{n};")) for n in _SPECIAL if unescape(f"&#{n};") != chr(n))


@query(rf"""WITH names(n, c) AS (VALUES {_NAMES}), numbers(k, c) AS (VALUES {_NUMBERS}),
found AS (SELECT page_id, regexp_extract(h, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(h, '(?s)<h1>(.*?)</h1>', 1) AS heading, regexp_extract(h, '<html lang="([^"]*)"', 1) AS language FROM {_CLEAN}),
texts AS (SELECT page_id, 'title' AS w, string_split(title, '&') AS l FROM found UNION ALL SELECT page_id, 'heading', string_split(heading, '&') FROM found),
pieces AS (SELECT page_id, w, i, p, CASE WHEN i > 0 THEN regexp_extract(p, '^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^	
 <&#;]{{1,32}};?)') ELSE '' END AS r FROM (SELECT page_id, w, unnest(l) AS p, unnest(range(len(l))) AS i FROM texts)),
named AS (SELECT page_id, w, i, max(x) AS x, max_by(c, x) AS c FROM (SELECT page_id, w, i, r, unnest(range(2, length(r) + 1)) AS x FROM pieces WHERE r NOT LIKE '#%') JOIN names ON n = left(r, x) GROUP BY ALL),
coded AS (SELECT *, TRY_CAST(CASE WHEN lower(r[2]) = 'x' THEN '0x' || rtrim(r[3:], ';') ELSE rtrim(r[2:], ';') END AS BIGINT) AS k FROM pieces WHERE r LIKE '#%'),
numbered AS (SELECT page_id, w, i, CASE WHEN c IS NOT NULL THEN c WHEN coded.k IS NULL OR coded.k BETWEEN 55296 AND 57343 OR coded.k > 1114111 THEN chr(65533) ELSE chr(CAST(coded.k AS INTEGER)) END AS c FROM coded LEFT JOIN numbers ON numbers.k = coded.k),
decoded AS (SELECT page_id, w, string_agg(CASE WHEN m.c IS NOT NULL THEN m.c || p[length(r) + 1:] WHEN a.c IS NOT NULL THEN a.c || p[a.x + 1:] WHEN i > 0 THEN '&' || p ELSE p END, '' ORDER BY i) AS t FROM pieces LEFT JOIN named a USING (page_id, w, i) LEFT JOIN numbered m USING (page_id, w, i) GROUP BY 1, 2),
stripped AS (SELECT page_id, w, nullif(regexp_replace(t, '^{scalars.SPACE}+|{scalars.SPACE}+$', '', 'g'), '') AS t FROM decoded)
SELECT page_id, a.t AS title, b.t AS heading, language FROM found JOIN (FROM stripped WHERE w = 'title') a USING (page_id) JOIN (FROM stripped WHERE w = 'heading') b USING (page_id)""")
def page_metadata(spark, d):
    nodes = _nodes(spark, d)
    lang = nodes.where("tag = 'html'").select("item_id", F.col("attrs")["lang"].alias("language"))
    named = tree.subtree_text(nodes.where("tag in ('title', 'h1')"), nodes).join(nodes.where("tag in ('title', 'h1')").select("item_id", F.col("pre").alias("outer"), "tag"), ["item_id", "outer"])
    wide = named.groupBy("item_id").pivot("tag", ["title", "h1"]).agg(F.min_by("text", "outer"))
    return lang.join(wide, "item_id", "left").select(F.col("item_id").alias("page_id"), "title", F.col("h1").alias("heading"), "language")


@query(r"SELECT page_id, array_to_string(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '/index\.html$', ''), '/'), lambda x: x != ''), '_') AS slug FROM pages")
def page_slug(spark, d):
    return _pages(spark, d).select("page_id", scalars.slug(F.concat(F.lit("https://host/details"), F.regexp_replace("url", "^[a-z]+://[^/]*", ""))).alias("slug"))


@query(rf"""SELECT page_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(html, '{scalars.SPACE}+', ' ', 'g'), '<div>{scalars.SPACE}*</div>', '', 'g'), '>{scalars.SPACE}+<', '><', 'g'), ' ')) AS normalized FROM pages""")
def page_normalize(spark, d):
    return _pages(spark, d).select("page_id", F.sha2(scalars.normalize_html(F.col("html")), 256).alias("normalized"))


_MARKUP = (
    ("<li>", '<li><i class="icon icon-tick"> </i>'),
    ("<p>", "<p><img SRC = '/Images/p.png'>"),
    ("<b>", '<b src="//host/x" data-config="/Images/b">'),
    ("<h1>", '<h1><img src="{base_url}/Images/h.png"/><i class="icon-ticked"></i>'),
    ("<script>", '<!-- <i class="icon-tick"></i> --><script>'),
)


def _set_in(html: str, quote) -> str:
    for old, new in _MARKUP:
        html = quote(html, old, new)
    return html


_SET_IN = _set_in("html", lambda html, old, new: "replace({}, '{}', '{}')".format(html, old.replace("'", "''"), new.replace("'", "''")))


@query(rf"""SELECT page_id, ticks, sha256(replace(replace(replace(h, '<i class="icon icon-tick"></i>', '✓'), 'SRC = ''/Images/p', 'SRC = ''{{base_url}}/Images/p'), 'data-config="/Images/b"', 'data-config="{{base_url}}/Images/b"')) AS html FROM (SELECT page_id, (length(html) - length(replace(html, '<li>', ''))) // 4 AS ticks,
 trim(regexp_replace(regexp_replace(regexp_replace({_SET_IN}, '{scalars.SPACE}+', ' ', 'g'), '<div>{scalars.SPACE}*</div>', '', 'g'), '>{scalars.SPACE}+<', '><', 'g'), ' ') AS h FROM pages)""")
def page_base_url(spark, d):
    """Tick, source and image rules over whole pages, whose list items, paragraphs, headings and scripts get icons and images."""
    html = F.col("html")
    for old, new in _MARKUP:
        html = F.replace(html, F.lit(old), F.lit(new))
    made = _pages(spark, d).select("page_id", scalars.normalize_html(html).alias("html"))
    return made.select("page_id", (F.length("html") - F.length(F.replace("html", F.lit("✓"), F.lit("")))).cast("bigint").alias("ticks"), F.sha2("html", 256).alias("html"))


@query(rf"""SELECT page_id, sha256(array_to_string(list_filter(list_transform(regexp_split_to_array(a, '<[^>]*>'), lambda x: trim(replace(replace(replace(x, '&amp;', '&'), '&copy;', '©'), '&middot;', '·'), ' ' || chr(10))), lambda x: x != ''), ' ')) AS text FROM (SELECT page_id, regexp_extract(h, '(?s)<footer>(.*?)</footer>', 1) AS a FROM {_CLEAN})""")
def page_text(spark, d):
    nodes = _nodes(spark, d)
    text = tree.subtree_text(nodes.where("tag = 'footer'"), nodes)
    roots = nodes.where("tag = 'footer'").select("item_id", F.col("pre").alias("outer"))
    return roots.join(text, ["item_id", "outer"], "left").select(F.col("item_id").alias("page_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text"))


def _options(spark, d):
    """Navigation links as options: (page, ord, href, label)."""
    nodes = _nodes(spark, d)
    links = nodes.where("tag = 'a'")
    listed = tree.within(nodes.where("tag = 'li'"), links).select("item_id", "pre", "href").distinct()
    text = tree.subtree_text(links, nodes).select("item_id", F.col("outer").alias("pre"), "text")
    from pyspark.sql.window import Window

    order = Window.partitionBy("item_id").orderBy("pre")
    return listed.join(text, ["item_id", "pre"], "left").select(F.col("item_id").alias("page_id"), F.row_number().over(order).cast("bigint").alias("ord"), "href", F.coalesce("text", F.lit("")).alias("label"))


@query(f"SELECT page_id, label, href, row_number() OVER (PARTITION BY page_id ORDER BY d DESC, ord) AS sort_order FROM (SELECT *, ord = max(ord) OVER (PARTITION BY page_id) AS d FROM {_LINKS})")
def page_options_default_first(spark, d):
    from pyspark.sql.window import Window

    options = _options(spark, d).withColumn("is_default", F.col("ord") == F.max("ord").over(Window.partitionBy("page_id")))
    return controls.default_first(options, "page_id").select("page_id", "label", "href", "sort_order")


@query(f"""WITH o AS (SELECT page_id, href AS value, label, length(label) > 9 AS marked FROM {_LINKS}), s AS (SELECT page_id, max(label) AS summary FROM o GROUP BY 1),
g AS (SELECT o.page_id, list(DISTINCT value) FILTER (marked) AS marks, count(DISTINCT value) AS n, min(value) AS one, list(value) FILTER (label = summary) AS fits FROM o JOIN s USING (page_id) GROUP BY 1),
r AS (SELECT page_id, CASE WHEN coalesce(len(marks), 0) = 1 THEN marks[1] WHEN coalesce(len(marks), 0) = 0 AND n = 1 THEN one WHEN len(fits) = 1 AND (coalesce(len(marks), 0) = 0 OR list_contains(marks, fits[1])) THEN fits[1] END AS value FROM g)
SELECT page_id, value, CASE WHEN value IS NULL THEN 'no single default' END AS error FROM r""")
def default_resolution(spark, d):
    from tessera.sources.commit import staged

    options, _ = staged(_options(spark, d).select("page_id", F.col("href").alias("value"), "label", (F.length("label") > 9).alias("marked")), "options")
    return controls.resolve_default(options, options.groupBy("page_id").agg(F.max("label").alias("summary")), "page_id")


@query(rf"SELECT page_id, CAST(len(regexp_extract_all(h, '<ul>')) AS BIGINT) AS outermost, CAST(len(regexp_extract_all(h, '<(ul|li|a)[ >]')) AS BIGINT) AS candidates FROM {_CLEAN}")
def page_outermost(spark, d):
    nodes = _nodes(spark, d)
    listed = nodes.where("tag in ('ul', 'li', 'a')")
    roots = tree.outermost(listed).groupBy("item_id").agg(F.count("*").alias("outermost"))
    return listed.groupBy("item_id").agg(F.count("*").alias("candidates")).join(roots, "item_id", "left").select(F.col("item_id").alias("page_id"), "outermost", "candidates")


@query(rf"SELECT page_id, CASE WHEN n = 1 THEN 'one' END AS found, n, CASE WHEN n != 1 THEN 'ad: ' || n END AS error FROM (SELECT page_id, CAST(len(regexp_extract_all(h, '<div class=.ad.>')) AS BIGINT) AS n FROM {_CLEAN})")
def exactly_one_gate(spark, d):
    nodes = _nodes(spark, d)
    gate = tree.exactly_one(nodes.where((F.col("tag") == "div") & tree.has_class("ad")), nodes.select("item_id").distinct(), "ad")
    return gate.select(F.col("item_id").alias("page_id"), F.when(F.col("pre").isNotNull(), "one").alias("found"), "n", "error")


@query(rf"""SELECT page_id, CASE WHEN links = 0 THEN 'Simple' WHEN ads = 0 AND lists = 1 THEN 'Simple' WHEN links < 6 THEN 'RegionFilter' ELSE 'ComplexFilter' END AS page_type, links + ads AS interactive
FROM (SELECT page_id, CAST(len(regexp_extract_all(h, '<li><a ')) AS BIGINT) AS links, CAST(len(regexp_extract_all(h, '<div class=.ad.>')) AS BIGINT) AS ads, CAST(len(regexp_extract_all(h, '<ul>')) AS BIGINT) AS lists FROM {_CLEAN})""")
def page_type_decision(spark, d):
    nodes = shred(_pages(spark, d))
    count = lambda c: F.count_if(c)  # noqa: E731
    seen = nodes.groupBy("item_id").agg(count(F.col("tag") == "li").alias("links"), count((F.col("tag") == "div") & tree.has_class("ad")).alias("ads"), count(F.col("tag") == "ul").alias("lists"))
    kind = F.when(F.col("links") == 0, "Simple").when((F.col("ads") == 0) & (F.col("lists") == 1), "Simple").when(F.col("links") < 6, "RegionFilter").otherwise("ComplexFilter")
    return seen.select(F.col("item_id").alias("page_id"), kind.alias("page_type"), (F.col("links") + F.col("ads")).alias("interactive"))


@query(rf"SELECT page_id, s.t AS section, row_number() OVER (PARTITION BY page_id ORDER BY s.o) AS sort_order FROM {_CLEAN}, (VALUES (1, 'Banner', '<nav>'), (2, 'ProductDescription', '<div class=.ad.>'), (3, 'Qa', '<footer>')) s(o, t, p) WHERE regexp_matches(h, s.p)")
def page_sections(spark, d):
    """Common sections that are there, numbered in their fixed order."""
    from pyspark.sql.window import Window

    role = F.when(F.col("tag") == "nav", 1).when((F.col("tag") == "div") & tree.has_class("ad"), 2).when(F.col("tag") == "footer", 3)
    found = shred(_pages(spark, d)).withColumn("role", role).where("role is not null").select("item_id", "role").distinct()
    names = F.element_at(F.array(*map(F.lit, ("Banner", "ProductDescription", "Qa"))), F.col("role"))
    return found.select(F.col("item_id").alias("page_id"), names.alias("section"), F.row_number().over(Window.partitionBy("item_id").orderBy("role")).cast("bigint").alias("sort_order"))


@query(rf"SELECT page_id, CAST(len(regexp_extract_all(h, '<div class=.ad.>|<article>')) AS BIGINT) AS parts FROM {_CLEAN}")
def page_boundary(spark, d):
    """Material children of the body behind the navigation and before the footer."""
    nodes = _nodes(spark, d)
    body = nodes.where("tag = 'body'").select("item_id", F.col("pre").alias("parent"))
    children = nodes.where("kind = 'element'").join(body, ["item_id", "parent"])
    edges = children.groupBy("item_id").agg(F.max(F.when(F.col("tag") == "nav", F.col("pre"))).alias("lo"), F.min(F.when(F.col("tag") == "footer", F.col("pre"))).alias("hi"))
    inner = children.join(edges, "item_id").where("pre > coalesce(lo, -1) and pre < coalesce(hi, 2147483647)")
    filled = tree.within(inner, nodes.where("kind = 'text' and trim(text) != ''").select("item_id", "pre")).select("item_id", F.col("outer").alias("pre")).distinct()
    return inner.join(filled, ["item_id", "pre"], "left_semi").groupBy("item_id").agg(F.count("*").alias("parts")).withColumnRenamed("item_id", "page_id")


@query(f"""WITH l AS (SELECT page_id, ord, label, html FROM {_LINKS}),
s AS (SELECT DISTINCT page_id, r_name AS region, r_regionkey FROM l, region)
SELECT s.page_id, s.region, sha256(coalesce(string_agg(l.html, '' ORDER BY l.ord), '')) AS content, count(l.html) AS units
FROM s LEFT JOIN l ON l.page_id = s.page_id AND NOT (length(l.label) % 5 = s.r_regionkey) GROUP BY 1, 2""")
def region_projection(spark, d):
    """Each page's list items for each region, without those that the region's row excludes."""
    from tessera.sources.commit import staged

    nodes = _nodes(spark, d)
    items = nodes.where("tag = 'li'")
    html = tree.subtree_html(items, nodes)
    label = tree.subtree_text(items, nodes)
    units = html.join(label, ["item_id", "outer"], "left").select(F.col("item_id").alias("page_id"), F.coalesce("text", F.lit("")).alias("table_id"), F.col("outer").alias("ord"), "html")
    units, _ = staged(units, "units")
    regions = spark.read.parquet(f"{d}/region.parquet")
    raw = units.select("table_id").distinct().join(F.broadcast(regions), F.length("table_id") % 5 == F.col("r_regionkey")).groupBy(F.lit("nav").alias("os"), F.col("r_name").alias("region")).agg(F.collect_list("table_id").alias("ids"))
    states = units.select("page_id").distinct().crossJoin(F.broadcast(regions.select(F.lit("nav").alias("os"), F.col("r_name").alias("region"))))
    made = exclusions.project(states, units, exclusions.load_exclusions(raw), "page_id")
    return made.select("page_id", "region", F.sha2("content", 256).alias("content"), "units")


@query(rf"""SELECT page_id, sha256(regexp_extract(h, '(?s)<nav>(.*?)</nav>', 0)) AS nav, sha256(regexp_replace(regexp_extract(h, '(?s)<nav>(.*?)</nav>', 0), '<a [^>]*>[^<]*</a>', '', 'g')) AS bare FROM {_CLEAN}""")
def page_fragments(spark, d):
    """A fragment serialised from nodes, whole and with a kind of subtree removed."""
    nodes = _nodes(spark, d)
    nav = nodes.where("tag = 'nav'")
    whole = tree.subtree_html(nav, nodes).select("item_id", F.sha2("html", 256).alias("nav"))
    bare = tree.subtree_html(nav, nodes, nodes.where("tag = 'a'")).select("item_id", F.sha2("html", 256).alias("bare"))
    return whole.join(bare, "item_id").withColumnRenamed("item_id", "page_id")


@query("""SELECT doc_id, CASE WHEN a != b THEN p END AS place FROM (SELECT doc_id, text AS a, lower(text) AS b FROM documents),
LATERAL (SELECT CAST(min(i) AS BIGINT) AS p FROM (SELECT unnest(range(1, length(a) + 1)) AS i) WHERE substr(a, i, 1) != substr(b, i, 1))""")
def text_first_difference(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", scalars.first_difference(F.col("text"), F.lower("text")).alias("place"))


@query("SELECT doc_id, CASE WHEN length(text) <= 240 THEN text ELSE 'len=' || length(text) || ' ' || left(text, 120) || ' ... ' || right(text, 120) END AS value FROM documents")
def readable_value(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", scalars.readable_value(F.col("text")).alias("value"))
