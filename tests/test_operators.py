import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import batch, chains, changes, controls, exclusions, review, selection, tree
from tessera.sources import commit
from tessera.sources.html import shred
from tessera.streaming.snapshots import watch


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_exclusions(spark):
    raw = table(spark, [(" a ", "r", [" #x", "x", "##y"]), ("b", "r", [" "]), ("c", "r", ["z"]), ("c", "r", ["z"])], "os string, region string, ids array<string>")
    got = {r["os"]: (r["table_ids"], r["error"]) for r in exclusions.load_exclusions(raw).collect()}
    assert got["a"] == (["x", "#y"], None) and got["b"][1] == "empty id" and got["c"][1] == "duplicate key"
    found = exclusions.lookup(table(spark, [("a", "r"), ("q", "r")], "os string, region string"), exclusions.load_exclusions(raw)).collect()
    assert {r["os"]: (r["row_present"], r["table_ids"]) for r in found} == {"a": (True, ["x", "#y"]), "q": (False, [])}


@pytest.mark.parametrize(("many", "error"), [(False, "several units"), (True, None)])
def test_an_id_in_two_units(spark, many, error):
    lookups = table(spark, [("g", "o", "r", ["x"]), ("g", "o", "s", ["nope"])], "grp string, os string, region string, table_ids array<string>")
    units = table(spark, [("g", "x", 1), ("g", "x", 2)], "grp string, table_id string, unit long")
    got = {r["region"]: r["error"] for r in exclusions.applicability(lookups, units, "grp", many).collect()}
    assert got == {"r": error, "s": "no unit"}


def test_projection_keeps_empty_states(spark):
    units = table(spark, [("g", "x", 1, "<x>"), ("g", "y", 2, "<y>")], "grp string, table_id string, ord long, html string")
    rules = exclusions.load_exclusions(table(spark, [("o", "all", ["x", "y"]), ("o", "one", ["x"])], "os string, region string, ids array<string>"))
    states = table(spark, [("g", "o", "all"), ("g", "o", "one"), ("g", "o", "none")], "grp string, os string, region string")
    got = {r["region"]: (r["content"], r["units"]) for r in exclusions.project(states, units, rules, "grp").collect()}
    assert got == {"all": ("", 0), "one": ("<y>", 1), "none": ("<x><y>", 2)}


@pytest.mark.parametrize(
    ("marks", "summary", "expected"),
    [([True, False], "South", "north"), ([False, False], "East", "east"), ([True, True], "East", "east"), ([False, False], "None", None)],
)
def test_default(spark, marks, summary, expected):
    options = table(spark, [("c", "north", "North", marks[0]), ("c", "east", "East", marks[1])], "control string, value string, label string, marked boolean")
    row = controls.resolve_default(options, table(spark, [("c", summary)], "control string, summary string"), "control").first()
    assert row["value"] == expected and (row["error"] is None) == (expected is not None)


def test_strict_match(spark):
    left = table(spark, [("a",), ("b",), ("c",)], "k string")
    right = table(spark, [("a", "1"), ("b", "1"), ("b", "2"), ("z", "9")], "k string, v string")
    got = {r["k"]: (r["v"], r["error"]) for r in controls.strict_match(left, right, ["k"], "v").collect()}
    assert got == {"a": ("1", None), "b": (None, "matches: 2"), "c": (None, "matches: 0")}


def test_snapshot_changes(spark):
    items = table(spark, [(i,) for i in range(5)], "k long")
    new = table(spark, [(0, "a"), (1, "b"), (2, "c")], "k long, html string")
    old = table(spark, [(0, "a"), (1, "B"), (3, "d")], "k long, html string")
    got = {r["k"]: r["change"] for r in changes.snapshot_changes(items, new, old, "k", "html").collect()}
    assert got == {0: "unchanged", 1: "modified", 2: "added", 3: "removed", 4: "missing_in_both"}


def test_mapping_changes_compare_sets(spark):
    kind = "os string, region string, table_ids array<string>"
    old = table(spark, [("a", "r", ["x", "y"]), ("b", "r", ["x"]), ("c", "r", ["x"])], kind)
    new = table(spark, [("a", "r", ["y", "x", "x"]), ("b", "r", ["z"]), ("d", "r", [])], kind)
    got = {r["os"]: r["change"] for r in changes.mapping_changes(old, new).collect()}
    assert got == {"b": "table_ids_changed", "c": "removed", "d": "added"}


def test_incomplete_evidence_counts_as_affected(spark):
    recorded = table(spark, [("p", "zh", "a", "r"), ("p", "en", "a", "r"), ("q", "zh", "b", "r"), ("s", "zh", "b", "r"), ("s", "en", "b", "r")], "product_key string, language string, os string, region string")
    got = changes.affected_by_usage(table(spark, [("a", "r")], "os string, region string"), recorded, table(spark, [("p",), ("q",), ("s",), ("t",)], "product_key string"), 2)
    assert {r["product_key"]: r["reason"] for r in got.collect()} == {"p": "lookup changed", "q": "incomplete evidence", "t": "incomplete evidence"}


def test_batch_report_collects_distinct_reasons_only(spark):
    raw = [(k, "s", "failed", "b" if k % 3 else "a") for k in range(1, 301)] + [(None, "s", "failed", "z"), (1, "s", "failed", "0"), (9, "s", "passed", None), (8, "s", "passed", "q"), (5, None, "passed", None)]
    report = batch.batch_report(table(spark, raw, "k long, supp string, status string, reason string"), "k", "supp")
    assert {(r["supp"], r["status"]): (r["n"], r["reasons"]) for r in report.collect()} == {("s", "failed"): (302, "z,0,b,a"), ("s", "passed"): (2, "q"), (None, "passed"): (1, "")}
    collects, counts = [line for line in report._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line]
    assert "collect_list" in collects and "Aggregate [supp" in counts and "reason" in counts.split("]")[0]


def test_batch_accounts(spark):
    stages = "input string, extraction string, usage string, l3a string, l3b string"
    items = table(spark, [("p", 1, *["passed"] * 5), ("p", 2, "passed", "blocked", "not_run", "blocked", "failed"), ("q", 1, *["passed"] * 4, "failed"), ("r", 1, *["passed"] * 4, "pending")], f"product_key string, item int, {stages}")
    items = items.withColumn("status", batch.item_status()).withColumn("reason", batch.item_reason())
    assert {(r["product_key"], r["item"]): (r["status"], r["reason"]) for r in items.collect()} == {("p", 1): ("passed", ""), ("p", 2): ("blocked", "extraction"), ("q", 1): ("failed", "l3b"), ("r", 1): ("pending", "")}
    summary = {r["grain"]: (r["planned"], r["passed"], r["blocked"], r["failed"], r["pending"], r["final"]) for r in batch.batch_summary(items).collect()}
    assert summary == {"items": (4, 1, 1, 1, 1, "completed_with_issues"), "products": (3, 0, 1, 1, 1, "completed_with_issues")}


def test_freeze_is_all_or_nothing(spark):
    items = table(spark, [("p", "zh"), ("p", "en"), ("q", "zh"), ("q", "en")], "product string, language string")
    up = table(spark, [("p", "zh", "1"), ("p", "en", "2"), ("q", "zh", "3")], "product string, language string, html string")
    old = table(spark, [("p", "zh", "1")], "product string, language string, html string")
    got = {(r["product"], r["language"]): r["action"] for r in commit.freeze_actions(items, up, old, ["product", "language"], "product", "html").collect()}
    assert got == {("p", "zh"): "unchanged", ("p", "en"): "copied", ("q", "zh"): "blocked", ("q", "en"): "blocked"}


def test_write_once_and_seal(spark, tmp_path):
    df = table(spark, [(1,)], "a long")
    commit.write_once(df, f"{tmp_path}/x.building")
    with pytest.raises(Exception, match="(?i)exist"):
        commit.write_once(df, f"{tmp_path}/x.building")
    assert commit.seal(spark, f"{tmp_path}/x.building", f"{tmp_path}/x")
    commit.write_once(df, f"{tmp_path}/x.building")
    assert not commit.seal(spark, f"{tmp_path}/x.building", f"{tmp_path}/x")


def test_chains(spark):
    rows = table(spark, [(1, None), (2, 1), (3, 2), (4, 3), (9, None), (20, 21), (21, 20)], "record long, parent long")
    depths = chains.chain_depths(rows)
    got = {r["record"]: (r["root"], r["depth"]) for r in depths.collect()}
    assert {k: got[k] for k in (1, 2, 3, 4, 9)} == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (1, 3), 9: (9, 0)}
    assert got[20][0] is None and got[21][0] is None
    assert {r["root"]: (r["latest"], r["length"]) for r in chains.latest_record(depths).collect()} == {1: (4, 4), 9: (9, 1)}
    conflicts = chains.chain_conflicts(table(spark, [(1, None), (2, 1), (3, 1), (4, 7)], "record long, parent long"))
    assert {(r["record"], r["error"]) for r in conflicts.collect()} == {(1, "fork"), (4, "orphan")}


def test_review_and_release(spark):
    items = table(spark, [("p", "zh", "passed", "m", "s"), ("p", "en", "passed", "m", "s"), ("q", "zh", "passed", "m", "s"), ("q", "en", "failed", "m", "t")], "product_key string, language string, status string, page_model string, strategy string")
    queue = review.review_queue(items, 2)
    assert {r["product_key"]: (r["queued"], r["reasons"]) for r in queue.collect()} == {"p": (True, ""), "q": (False, "language missing；strategies differ")}
    status = review.review_status(queue, table(spark, [("p", "approved")], "product_key string, decision string"))
    full = review.release_rows(status, queue=queue)
    assert {r["product_key"]: r["reason"] for r in full.collect()} == {"p": "included", "q": "not_queued"}
    delta = review.release_rows(status, delivered=table(spark, [("p",)], "product_key string"))
    assert [r["reason"] for r in delta.collect()] == ["delivered"]
    forms = table(spark, [("r", "n", "approved", ["a", "b"], ["a"]), ("r", "n", "rejected", ["a", "b"], ["a"]), (" ", "n", "rejected", ["a"], ["a"])], "reviewer string, notes string, decision string, all_items array<string>, inspected array<string>")
    assert [r["can_submit"] for r in review.submit_gate(forms).collect()] == [False, True, False]
    keys = review.forbidden_keys(table(spark, [(1, '{"a": {"MyHash": 1}, "b": "hash"}')], "id long, json string"), "id", "json")
    assert [r["key"] for r in keys.collect()] == ["MyHash"]


def test_selection(spark):
    products = table(spark, [("a", 0), ("b", 1)], "product_key string, p_ord int")
    items = selection.plan_items(products, selection.language_table(spark)).orderBy("p_ord", "l_ord")
    assert [r["item_id"] for r in items.collect()] == ["a/zh-cn", "a/en-us", "b/zh-cn", "b/en-us"]
    strategies = table(spark, [("a", "simple_static"), ("b", "support_article"), ("c", "complex")], "product_key string, strategy string")
    overrides = table(spark, [("a", "complex", "why"), ("b", "complex", "why"), ("c", "simple_static", " ")], "product_key string, strategy string, reason string")
    assert {r["product_key"]: r["strategy"] for r in selection.apply_overrides(strategies, overrides).collect()} == {"a": "complex", "b": "support_article", "c": "complex"}


def test_stream_of_snapshots(spark, tmp_path):
    arrivals = f"{tmp_path}/in"
    schema = "page_id long, html string"
    table(spark, [(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(arrivals)
    watch(spark, arrivals, f"{tmp_path}/base", f"{tmp_path}/changes", f"{tmp_path}/check").awaitTermination()
    table(spark, [(1, "a"), (2, "c"), (3, "d")], schema).coalesce(1).write.mode("append").parquet(arrivals)
    watch(spark, arrivals, f"{tmp_path}/base", f"{tmp_path}/changes", f"{tmp_path}/check").awaitTermination()
    got = {(r["version"], r["page_id"], r["change"]) for r in spark.read.parquet(f"{tmp_path}/changes").collect()}
    assert got == {(0, 1, "added"), (0, 2, "added"), (1, 2, "modified"), (1, 3, "added")}
    assert spark.read.parquet(f"{tmp_path}/changes").where(F.col("version") == 1).count() == 2


def test_stream_state_costs_the_arrival_alone(spark, tmp_path):
    """A thousand known pages, then arrivals of a few: only their keys are written; a deletion is told once, a page that comes back is new."""
    arrivals, schema = f"{tmp_path}/in", "page_id long, html string"

    def arrive(rows):
        rows.write.mode("append").parquet(arrivals)
        query = watch(spark, arrivals, None, f"{tmp_path}/changes", f"{tmp_path}/check", files=None)
        query.awaitTermination()
        return [p for p in query.recentProgress if p["numInputRows"]][-1]["stateOperators"][0]

    arrive(spark.range(1000).selectExpr("id as page_id", "concat('page ', id) as html"))
    for given in ([(1, "page 1"), (2, "new"), (2, None), (3, None)], [(3, None), (4, None), (5, "page 5")], [(3, "back"), (4, None)]):
        state = arrive(table(spark, given, schema))
        assert state["numRowsUpdated"] <= 3 and state["numRowsTotal"] >= 900
    got = {(r["version"], r["page_id"], r["change"]) for r in spark.read.parquet(f"{tmp_path}/changes").where("version > 0").collect()}
    assert got == {(1, 2, "modified"), (1, 3, "removed"), (2, 4, "removed"), (3, 3, "added")}


def test_stream_begins_with_a_baseline(spark, tmp_path):
    schema = "page_id long, html string"
    table(spark, [(1, "a"), (2, "b")], schema).write.parquet(f"{tmp_path}/base/batch=0")
    table(spark, [(1, "a"), (2, "c"), (3, "d")], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    watch(spark, f"{tmp_path}/in", f"{tmp_path}/base", f"{tmp_path}/changes", f"{tmp_path}/check").awaitTermination()
    assert {(r["page_id"], r["change"]) for r in spark.read.parquet(f"{tmp_path}/changes").collect()} == {(2, "modified"), (3, "added")}


def _trees(seed=3, items=6):
    """Random trees as (item_id, pre, last) with repeated shapes: deep chains, wide rows, single nodes."""
    rng = random.Random(seed)
    out = []
    for item in range(items):
        last, open_ = [], []
        for pre in range(rng.choice([1, 5, 60])):
            while open_ and rng.random() < 0.4:
                last[open_.pop()] = pre - 1
            last.append(None)
            open_.append(pre)
        for pre in open_:
            last[pre] = len(last) - 1
        out += [(item, pre, end) for pre, end in enumerate(last)]
    return out


@pytest.mark.parametrize("self_too", [False, True])
def test_sweeps_equal_comparing_all_pairs(spark, self_too):
    rng = random.Random(8)
    rows = _trees()
    outer = [r for r in rows if rng.random() < 0.4]
    inner = [r for r in rows if rng.random() < 0.7]
    inside = lambda o, i: o[0] == i[0] and (o[1] <= i[1] if self_too else o[1] < i[1]) and i[1] <= o[2]
    o, i = (spark.createDataFrame(x, "item_id long, pre int, last int") for x in (outer, inner))
    pairs = sorted((b[0], b[1], a[1]) for a in outer for b in inner if inside(a, b))
    named = i.withColumn("payload", F.concat_ws("-", "item_id", "pre"))
    found = tree.within(o, named, self_too).collect()
    assert sorted((r["item_id"], r["pre"], r["outer"]) for r in found) == pairs and all(r["payload"] == f"{r['item_id']}-{r['pre']}" for r in found)
    some = {p[:2] for p in pairs}
    assert sorted((r["item_id"], r["pre"]) for r in tree.in_any(o, i, self_too).collect()) == sorted(some)
    assert {(r["item_id"], r["pre"]) for r in tree.in_any(o, i, self_too, inside=False).collect()} == {x[:2] for x in inner} - some
    if self_too:
        near = {}
        for item, pre, at in pairs:
            near[item, pre] = max(near.get((item, pre), -1), at)
        assert {(r["item_id"], r["pre"]): r["ancestor"] for r in tree.nearest_ancestor(i, o).collect()} == near
    else:
        top = sorted(b for b in outer if not any(inside(a, b) for a in outer))
        assert sorted(map(tuple, tree.outermost(o).collect())) == top


def test_sweep_makes_no_more_rows_than_the_answer(spark):
    """No join stands in the plan; a wide page with a thousand roots gives a row for each contained node."""
    roots = [(1, 3 * k, 3 * k + 2) for k in range(1000)]
    o = spark.createDataFrame(roots, "item_id long, pre int, last int")
    i = spark.range(3000).selectExpr("1L as item_id", "cast(id as int) as pre")
    found = tree.within(o, i)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 2000


def test_one_pass_tells_what_is_open_and_what_holds_something(spark):
    """Nested roots, several of which end at one node, against all pairs."""
    rng = random.Random(9)
    rows = _trees()
    outer = [(*r, rng.random() < 0.5) for r in rows if rng.random() < 0.4]
    inside = lambda o, i: o[0] == i[0] and o[1] <= i[1] <= o[2]
    o = spark.createDataFrame(outer, "item_id long, pre int, last int, own boolean")
    found = tree._standing(o.unionByName(o.limit(3)), spark.createDataFrame(rows, "item_id long, pre int, last int"), o)
    wanted = {i[:2]: [(a[1], a[3]) for a in outer if inside(a, i)] for i in rows}
    assert {(r["item_id"], r["pre"]): [tuple(x) for x in r["_open"]] for r in found.collect()} == {k: v for k, v in wanted.items() if v}
    assert {(r["item_id"], r["pre"]) for r in found.where("_cut = pre").collect()} == {a[:2] for a in outer}
    some = [r for r in rows if rng.random() < 0.2]
    held = tree.holding(o, spark.createDataFrame(some, "item_id long, pre int, last int")).select(*o.columns).collect()
    assert sorted(map(tuple, held)) == sorted(a for a in outer if any(inside(a, i) and a[1] < i[1] for i in some))


def test_markup_sweeps_nodes_not_tokens(spark):
    """Subtrees are found before their tokens are made, in one sort of the nodes: a plan that sorts tokens three times took twice as long."""
    nodes = shred(spark.createDataFrame([(1, "<html><body><p>a<b>c</b></p></body></html>")], "page_id long, html string")).cache()
    html = tree.subtree_html(nodes.where("tag in ('p', 'b')").select("item_id", "pre", "last"), nodes)
    plan = html._jdf.queryExecution().optimizedPlan().toString()
    assert "_opening" in plan[plan.index("Window") :] and "explode" in plan[: plan.index("Window")]
    assert {r["html"] for r in html.collect()} == {"<p>a<b>c</b></p>", "<b>c</b>"}


def test_fragments_put_together_are_the_page(spark):
    """Cut at units, nested and void ones too: all fragments give the body, without a unit the rest."""
    html = '<html><body><div id="b">a<div id="u1">b<table id="u2"><tr><td>c</td></tr></table>d<img id="v"/>e</div>f<p id="u3"></p>g</div>h</body></html>'
    nodes = shred(spark.createDataFrame([(1, html)], "page_id long, html string")).cache()
    at = {r["id"]: r for r in nodes.where("id is not null").collect()}
    units = nodes.where("id in ('u1', 'u2', 'u3', 'v')").select("item_id", "pre", "last")
    body = nodes.where("id = 'b'").select("item_id", "pre", "last")
    for around, head, tail in ((True, '<div id="b">', "</div>"), (False, "", "")):
        pieces = sorted(tree.fragments(body.withColumn("around", F.lit(around)), units, nodes).collect(), key=lambda r: r["at"])
        without = lambda *ids: "".join(r["html"] for r in pieces if not {at[i]["pre"] for i in ids} & set(r["units"]))
        whole = 'a<div id="u1">b<table id="u2"><tr><td>c</td></tr></table>d<img id="v"/>e</div>f<p id="u3"></p>g'
        assert without() == head + whole + tail
        assert without("u2") == head + 'a<div id="u1">bd<img id="v"/>e</div>f<p id="u3"></p>g' + tail
        assert without("v", "u3") == head + 'a<div id="u1">b<table id="u2"><tr><td>c</td></tr></table>de</div>fg' + tail
        assert without("u1") == head + 'af<p id="u3"></p>g' + tail


def test_shredder_holds_few_pages_at_once(monkeypatch):
    """Incoming batches are taken in slices, and record batches of nodes stay small however many pages come at once."""
    import pyarrow as pa

    from tessera.sources import html

    class Pages:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(html.F, "col", lambda name: type("C", (), {"cast": lambda self, kind: self, "alias": lambda self, name: self})())
    page = "<html><body>" + "<p>x</p>" * 100 + "</body></html>"
    given = pa.RecordBatch.from_pydict({"item_id": list(range(500)), "html": [page] * 500})
    sizes = [part.num_rows for part in html.shred(Pages())(iter([given]))]
    assert sum(sizes) == 500 * 202
    assert max(sizes) <= html._ROWS + 202 <= 10_000
