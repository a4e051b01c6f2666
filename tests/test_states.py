import json

from tessera.plans import extract, states
from tessera.sources.html import shred


def control(kind, options, summary, hidden=False):
    links = "".join(f'<li class="{"active" if on else ""}"><a data-href="#{target}">{label}</a></li>' for target, label, on in options)
    mobile = "".join(f'<option data-href="#{t}" value="{t}-value">x</option>' for t, _, _ in options)
    select = f'<select id="software-box" class="hidden-lg hidden-md">{mobile}</select>' if kind == "software-kind" else ""
    style = ' style="display : NONE"' if hidden else ""
    return f'<div class="dropdown-container {kind}-container"{style}><label>{kind}：</label><div class="dropdown-box os-tab-nav hidden-xs hidden-sm"><span class="selected-item">{summary}</span><ol class="tab-items">{links}</ol></div>{select}</div>'


PANELS = """<div class="tab-content">
<div class="tab-panel" id="tabContent1"><ul class="os-tab-nav category-tabs hidden-xs hidden-sm"><li><a data-href="#all">All</a></li><li><a data-href="#c1">One</a></li><li><a data-href="#c2">Two</a></li></ul>
<div><p>shared <b>x</b></p><div class="tab-panel" id="c1"><div class="scroll-table"><table id="t1"></table></div><table id="t2"></table></div><div class="tab-panel" id="c2"><!-- c --></div></div></div>
<div class="tab-panel" id="tabContent2"><div class="tab-content"><table id="t1"></table><p>k</p></div></div></div>"""


def page(software, region, panels=PANELS, hidden=False):
    return f'<html><body><div class="pure-content"><div class="technical-azure-selector pricing-detail-tab tab-dropdown">{control("software-kind", software, software[0][1], hidden)}{control("region", region, "East")}{panels}</div></div></body></html>'


def nodes(spark, *html):
    return shred(spark.createDataFrame(list(enumerate(html)), "page_id long, html string")).cache()


SOFTWARE = [("tabContent1", "Linux", False), ("tabContent2", "Windows", True)]
REGIONS = [("north", "North", False), ("east", "East", False)]


def test_states_in_order_with_exclusions(spark):
    rules = spark.createDataFrame([("tabContent1-value", "east", ["t1", "unknown"]), ("tabContent2-value", "north", ["t1"])], "os string, region string, table_ids array<string>")
    found, errors = states.complex_states(nodes(spark, page(SOFTWARE, REGIONS)), rules)
    assert errors.collect() == []
    rows = found.orderBy("ord").collect()
    # the marked software and the region of the summary come first; "All" has no panel and is dropped
    assert [" - ".join(r["labels"]) for r in rows] == ["Windows - East", "Windows - North", "Linux - East - One", "Linux - East - Two", "Linux - North - One", "Linux - North - Two"]
    assert [r["content"] for r in rows] == ['<table id="t1"></table><p>k</p>', "<p>k</p>", '<table id="t2"></table>', "<!-- c -->", '<div class="scroll-table"><table id="t1"></table></div><table id="t2"></table>', "<!-- c -->"]
    assert {r["shared"] for r in rows[2:]} == {"<p>shared <b>x</b></p>"} and {r["shared"] for r in rows[:2]} == {""}
    assert [(c["filterKey"], c["matchValues"]) for c in rows[2]["criteria"]] == [("software", "tabContent1-value"), ("region", "east"), ("category", "c1")]
    groups = extract.content_groups(found).first()["groups"]
    assert [g["sortOrder"] for g in groups] == [1, 2, 3, 4, 5, 6] and groups[0]["sharedContent"] is None


def test_a_hidden_software_is_no_criterion(spark):
    rules = spark.createDataFrame([], "os string, region string, table_ids array<string>")
    found, _ = states.complex_states(nodes(spark, page(SOFTWARE[1:], REGIONS, hidden=True)), rules)
    assert [r["labels"] for r in found.orderBy("ord").collect()] == [["East"], ["North"]]


def test_errors(spark):
    rules = spark.createDataFrame([], "os string, region string, table_ids array<string>")
    two_values = page(SOFTWARE, REGIONS).replace("</select>", '<option data-href="#tabContent1" value="other">x</option></select>')
    no_panel = page(SOFTWARE, REGIONS).replace('id="c2"', 'id="c9"')
    no_default = page(SOFTWARE, REGIONS).replace(">East</span>", ">West</span>")
    found, errors = states.complex_states(nodes(spark, two_values, no_panel, no_default, page(SOFTWARE, REGIONS)), rules)
    told = {(r["item_id"], r["error"]) for r in errors.collect()}
    assert told == {(0, "matches: 2"), (1, "category panel c2 found 0"), (2, "no single default")}
    assert {r["item_id"] for r in found.collect()} == {3}


def test_filter_definitions(spark):
    table = nodes(spark, page(SOFTWARE, REGIONS))
    options = {k: states.filter_options(table, k) for k in ("software", "region")}
    panels = states.software_panels(table)
    got = json.loads(states.filters_json(options, states.category_tabs(table, panels)).first()["filters"])["filterDefinitions"]
    assert [(d["filterKey"], d["displayName"], [o["label"] for o in d["options"]]) for d in got] == [("software", "software-kind", ["Windows", "Linux"]), ("region", "region", ["East", "North"]), ("category", "Category", ["All", "One", "Two"])]
    assert [o.get("isDefault") for o in got[0]["options"]] == [True, None]


def test_second_reading_equals_the_states(spark):
    """Nested units, shared fragments before and behind (one panel only), text beside leaves, a unit around a leaf's own table,
    and empty leaves: contents and shared contents of both readings are the same."""
    from pyspark.sql import functions as F

    from tessera.functions.scalars import normalize_joined
    from tessera.plans import independent

    rich = PANELS.replace('<p>shared <b>x</b></p>', 'loose <p>shared <b>x</b></p><script>s()</script><p> </p><div class="hide-info">h</div><div class="scroll-table"><table id="t5"><tr><td id="t6">c</td></tr></table></div><img id="t7" src="/a.png"/>')
    one = '<div class="tab-content"><div class="tab-panel" id="tabContent1"><ul class="os-tab-nav category-tabs hidden-xs hidden-sm"><li><a data-href="#c1">One</a></li><li><a data-href="#c2">Two</a></li></ul><div><p>before</p><div id="c1">a<div class="scroll-table"><table id="t1"></table><table id="t2"></table></div></div><p>between</p><div id="c2"><table data-table-id="t1"></table>b</div><p>behind <table id="t3"></table></p>tail</div></div></div>'
    pages = nodes(spark, page(SOFTWARE, REGIONS), page(SOFTWARE, REGIONS, rich), page(SOFTWARE[:1], REGIONS, one), page(SOFTWARE[:1], REGIONS, one, hidden=True))
    rules = spark.createDataFrame([("tabContent1-value", "east", ["t1", "t5", "unknown"]), ("tabContent1-value", "north", ["t6", "t3", "t7"]), ("tabContent2-value", "north", ["t1"])], "os string, region string, table_ids array<string>")
    found, errors = states.complex_states(pages, rules)
    assert errors.collect() == []
    lookups = pages.select("item_id").distinct().join(rules.unionByName(spark.createDataFrame([("tabContent2-value", "east", [])], rules.schema)), F.lit(True))
    second, wrong = independent.second_complex(pages, lookups)
    assert wrong.collect() == []
    value = lambda key: F.get(F.filter("criteria", lambda c: c["filterKey"] == key), F.lit(0))["matchValues"]
    first = found.select("item_id", F.coalesce(value("software"), F.lit("tabContent1-value")).alias("os"), value("region").alias("region"), value("category").alias("target"), normalize_joined(F.col("content")).alias("content"), normalize_joined(F.col("shared")).alias("shared"))
    names = ["item_id", "os", "region", "target", "content", "shared"]
    a, b = (sorted(map(str, map(tuple, df.select(*names).collect()))) for df in (first, second))
    assert a == b and len(a) == 6 + 6 + 4 + 4
    shared = {(r["item_id"], r["region"]): r["shared"] for r in second.where("os = 'tabContent1-value'").collect()}
    assert shared[2, "east"] == "<p>before</p><p>behind <table id=\"t3\"></table></p>" and shared[2, "north"] == "<p>before</p><p>behind </p>"
    assert shared[1, "east"] == "<p>shared <b>x</b></p>"


def test_second_reading_of_a_target_that_two_elements_have(spark):
    from tessera.plans import independent

    twice = PANELS.replace('<table id="t2"></table></div>', '<p id="c2">again</p></div>')
    pages = nodes(spark, page(SOFTWARE, REGIONS, twice))
    lookups = spark.createDataFrame([(0, "tabContent1-value", "east", [])], "item_id long, os string, region string, table_ids array<string>")
    assert [r["item_id"] for r in independent.second_complex(pages, lookups)[1].collect()] == [0]
