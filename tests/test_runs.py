from pyspark.sql import functions as F

from tessera.operators import chains, runs, sections
from tessera.sources.html import shred


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def errors(df, key):
    return {r[key]: r["error"] for r in df.collect()}


def test_one_open_batch_is_let_through_and_unknown_ends_are_not(spark):
    pairs = "run string, product_key string"
    affected = table(spark, [("a", "p"), ("a", "q"), ("b", "p"), ("c", "p")], pairs)
    delivered, closed = table(spark, [("b", "p"), ("c", "x")], pairs), table(spark, [("a", "p"), ("b", "p")], pairs)
    got = {r["run"]: (r["affected"], r["delivered"], r["closed"], r["unresolved"], r["error"]) for r in runs.open_batches(affected, delivered, closed).collect()}
    # two are open, and one ends what it has not
    assert got == {"a": (2, 0, 1, 1, "several open batches"), "b": (1, 1, 0, 0, None), "c": (1, 0, 0, 1, "ends outside the scope")}
    alone = {r["run"]: r["error"] for r in runs.open_batches(affected.where("run != 'c'"), delivered.where("run = 'b'"), closed).collect()}
    assert alone == {"a": None, "b": None}
    assert runs.open_batches(affected.limit(0), delivered.limit(0), closed.limit(0)).collect() == []


def test_ending_without_delivery(spark):
    open_runs = table(spark, [("a", True, 1), ("b", False, 1), ("c", True, 0)], "run string, sealed boolean, unresolved long")
    left = table(spark, [("a", "p"), ("b", "p")], "run string, product_key string")
    asked = table(spark, [("a", "p", "r", "why"), ("a", "q", "r", "why"), ("b", "p", "r", "why"), ("c", "p", "r", "why"), ("a", "p2", " ", "why"), ("a", "p3", "r", " ")], "run string, product_key string, reviewer string, reason string")
    got = {(r["run"], r["product_key"]): r["error"] for r in runs.end_without_delivery(asked, open_runs, left).collect()}
    assert got == {("a", "p"): None, ("a", "q"): "not unresolved", ("b", "p"): "not sealed", ("c", "p"): "no open batch", ("a", "p2"): "no reviewer", ("a", "p3"): "no reason"}


def test_sealed_runs_and_passed_checks(spark):
    rows = [("a", "a", 0), ("b", "b.building", 0), ("c", "d", 0), ("e", "e", 2), ("f", "f", None)]
    assert errors(runs.sealed_runs(table(spark, rows, "run string, directory string, pending long")), "run") == {"a": None, "b": "not sealed", "c": "name differs", "e": "items pending", "f": "items pending"}
    items = table(spark, [(str(i), "p", "en") for i in range(6)], "item_id string, product_key string, language string")
    reports = [("0", "l3a", "p", "en", "passed"), ("1", "l3b", "p", "en", "passed"), ("2", "l3a", "q", "en", "passed"), ("3", "l3a", "p", None, "passed"), ("4", "l3a", "p", "en", "blocked")]
    got = errors(runs.passed_checks(table(spark, reports, "item_id string, check string, product_key string, language string, status string"), items, "l3a"), "item_id")
    assert got == {"0": None, "1": "check differs", "2": "product differs", "3": "language differs", "4": "not passed", "5": "missing"}


def test_plans_of_later_records(spark):
    schema = "item_id string, ordinal int, strategy string, boundary string"
    latest = table(spark, [("a", 0, "s", None), ("b", 1, "s", "x"), ("c", 2, "s", None), ("d", 3, "s", None)], schema)
    now = table(spark, [("a", 0, "s", None), ("b", 1, "t", None), ("c", 5, "s", None), ("e", 4, "s", None)], schema)
    assert errors(runs.plan_differences(latest, now, ("strategy", "boundary")), "item_id") == {"a": None, "b": "strategy,boundary", "c": "order differs", "d": "missing", "e": "added"}


def test_inputs_follow_the_chain_and_circles_have_none(spark):
    records = table(spark, [("r1", None), ("r2", "r1"), ("r3", "r2"), ("x", "y"), ("y", "x"), ("z", "x")], "record string, parent string")
    depths = chains.chain_depths(records)
    inputs = table(spark, [("r1", "html", "old"), ("r3", "html", "new")], "run string, name string, content string")
    got = {r["record"]: (r["content"], r["error"]) for r in runs.inherited_inputs(depths, inputs).collect()}
    assert got == {"r1": ("old", None), "r2": ("old", None), "r3": ("old", None), "x": (None, "no root"), "y": (None, "no root"), "z": (None, "no root")}
    assert {r["record"] for r in chains.chain_circles(records).collect()} == {"x", "y", "z"}


def test_circles_end_the_doubling_when_nothing_more_is_settled(spark, monkeypatch):
    from tessera.sources import commit

    rounds, real = [], commit.staged
    monkeypatch.setattr(commit, "staged", lambda df, name: rounds.append(name) or real(df, name))
    records = table(spark, [(i, i - 1 if i % 4 else None) for i in range(1000)] + [(2000, 2002), (2001, 2000), (2002, 2001), (2003, 2000)], "record long, parent long")
    assert {r["record"] for r in chains.chain_circles(records).collect()} == {2000, 2001, 2002, 2003}
    assert len(rounds) <= 5


def test_resume_and_files(spark):
    items = table(spark, [(1, "passed"), (2, "passed"), (3, "blocked"), (4, "passed")], "item_id long, input string")
    now, frozen = table(spark, [(1, b"x"), (2, b"y"), (4, b"z")], "item_id long, content binary"), table(spark, [(1, b"x"), (2, b"n")], "item_id long, content binary")
    assert errors(runs.resume_inputs(items, now, frozen), "item_id") == {1: None, 2: "input changed", 4: "input changed"}
    assert errors(runs.resume_inputs(items, now, frozen, fixed=True), "item_id") == {1: None, 2: None, 4: "fixed input missing"}
    states = "path string, content string, state long, state_after long"
    was, is_now = table(spark, [("a", "x", 1, 1), ("b", "x", 1, 1), ("c", "x", 1, 2), ("d", "x", 1, 1)], states), table(spark, [("a", "x", 9, 9), ("b", "y", 1, 1), ("c", "x", 1, 1)], states)
    got = {r["path"]: (r["differs"], r["error"]) for r in runs.file_differences(was, is_now, "path", "content", "state").collect()}
    assert got == {"a": (False, None), "b": (True, None), "c": (None, "previous changed while read"), "d": (None, "missing")}


def test_usage_reports(spark):
    lookup = "array<struct<os:string,region:string,row_present:boolean,table_ids:array<string>>>"
    rows = [("p/en", True, [("o", "r", True, ["t"])]), ("x", True, []), ("p/en", False, [("o", "r", True, [])]), ("p/en", True, [("o", "r", True, []), ("o", "r", True, [])]), ("p/en", True, [("o", "r", False, ["t"])])]
    df = table(spark, rows, f"item_id string, uses boolean, lookups {lookup}").withColumns({"product_key": F.lit("p"), "language": F.lit("en")})
    assert [r["error"] for r in runs.usage_report_errors(df).collect()] == [None, "identity differs", "lookups of no consumer", "lookup repeated", "ids without a row"]


PAGE = """<html><body class="page zh-cn"><div class="pricing-page-section" id="w"><p>before</p><div><i>in</i><div class="technical-azure-selector"><div class="technical-azure-selector">x</div></div><b>behind</b></div><p>after</p></div>
<div class="pricing-page-section"><p>Service Level <b>Agreement</b></p></div><div class="pricing-page-section more-detail">q</div><select><option>o</option></select><div id="content_feedback"><p>f</p></div></body></html>"""


def test_sections_of_a_page(spark):
    nodes = shred(spark.createDataFrame([(1, PAGE), (2, "<html><body><p>x</p></body></html>")], "page_id long, html string")).cache()
    items = table(spark, [(1, "zh-cn", False), (1, "en-us", False), (2, "zh-cn", True), (2, "zh-cn", False), (3, "zh-cn", False)], "item_id long, language string, filtered boolean")
    told = sorted(map(str, [(r["item_id"], r["error"]) for r in sections.declared_language(nodes, items, F.col("filtered")).collect()]))
    assert told == sorted(map(str, [(1, None), (1, "language not declared"), (2, None), (2, "language not declared"), (3, "language not declared")]))
    parts = nodes.where((F.col("tag") == "div") & F.array_contains("classes", "pricing-page-section"))
    assert [r["class"] for r in sections.section_classes(parts, nodes).orderBy("pre").collect()] == ["content", "sla", "faq"]
    assert sections.of_classes(parts, nodes, ["faq", "sla"]).count() == 2
    left = {r["tag"] for r in sections.without_controls(nodes).where("item_id = 1 and kind = 'element'").collect()}
    assert "select" not in left and "option" not in left and sections.without_controls(nodes).where("text = 'f'").count() == 0
    whole = nodes.where("id = 'w'").select("item_id", "pre", "last")
    html, wrong = sections.prefix_before(nodes, whole)
    # what follows the selector goes at its own level only
    assert html.first()["html"] == '<div class="pricing-page-section" id="w"><p>before</p><div><i>in</i></div><p>after</p></div>'
    assert wrong.collect() == []
    _, wrong = sections.prefix_before(nodes, nodes.where("item_id = 2 and tag = 'body'").select("item_id", "pre", "last"))
    assert wrong.first()["error"] == "nested selectors: 0"
