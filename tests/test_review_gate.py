import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import canonical
from tessera.functions.contract import PRICING_SCHEMA
from tessera.operators import review
from tessera.operators.runs import open_batches
from tessera.sources import listing

LANGUAGES = ["zh-cn", "en-us"]


def texts(rng):
    return "".join(rng.choice(['"', "\\", "\n", "\r", "\t", "\b", "\f", "\x00", "\x01", "\x1b", "\x7f", "/", "a", " ", "é", "价", "\U0001f600", " ", "<", "&"]) for _ in range(rng.randint(0, 12)))


def bare(value):
    """A value without the fields that are null."""
    if isinstance(value, dict):
        return {k: bare(v) for k, v in value.items() if v is not None}
    return [bare(v) for v in value] if isinstance(value, list) else value


def test_canonical_bytes(spark):
    """As the JSON module writes them: nested, empty, control characters, non-ASCII."""
    rng = random.Random(6)
    group = lambda: {"groupName": texts(rng), "filterCriteriaJson": '[{"k":"v"}]', "content": texts(rng), "sortOrder": rng.randint(-5, 99), "isActive": rng.random() < 0.5, "sharedContent": rng.choice([None, "", texts(rng)])}
    section = lambda: {"sectionType": "Qa", "sectionTitle": texts(rng), "content": texts(rng), "sortOrder": 1, "isActive": True}
    payloads = []
    for _ in range(40):
        plain = {name: texts(rng) for name in ("title", "metaTitle", "metaDescription", "metaKeywords", "slug", "language", "baseContent")}
        config = rng.choice([None, {"displayTitle": texts(rng), "pageIcon": "x", "leftNavigationIdentifier": None, "pageType": "Simple", "enableFilters": False, "filtersJsonConfig": "{}"}, dict.fromkeys(("displayTitle", "pageIcon", "leftNavigationIdentifier", "pageType", "enableFilters", "filtersJsonConfig"))])
        payloads.append(plain | {"contentGroups": [group() for _ in range(rng.randint(0, 3))], "commonSections": [section() for _ in range(rng.randint(0, 2))], "pageConfig": config})
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("p", T._parse_datatype_string(PRICING_SCHEMA))])
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], schema)
    got = {r["n"]: bytes(r["b"]) for r in df.select("n", canonical.payload_bytes(F.col("p"), schema["p"].dataType).alias("b")).collect()}
    for i, p in enumerate(payloads):
        assert got[i] == (json.dumps(bare(p), ensure_ascii=False, indent=2) + "\n").encode()


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))


def test_runs_releases_and_closures_are_read_from_folders(spark, tmp_path):
    runs, releases, closures = tmp_path / "runs", tmp_path / "releases", tmp_path / "closures"
    assert listing.runs_in(spark, str(runs)).collect() == []
    run = lambda name, keys=("a", "b", "c"), kind="incremental": {"run_name": name, "batch_kind": kind, "scope": {"product_keys": list(keys)}, "items": [{"status": "passed"}, {"status": "pending"}]}
    put(runs / "r1" / "run.json", run("r1"))
    put(runs / "r2.building" / "run.json", run("r2", ["x"]))
    put(runs / "r3" / "run.json", run("other"))
    put(runs / "r4" / "run.json", "{no json")
    put(runs / "r5" / "run.json", run("r5", ["x", "x"]))
    put(runs / "r6" / "run.json", run("r6", kind="standard"))
    put(runs / "r7" / "run.json", {"run_name": "r7", "batch_kind": "incremental"})
    (runs / "empty").mkdir()
    found = listing.runs_in(spark, str(runs))
    assert {r["directory"]: (r["sealed"], r["error"]) for r in found.collect()} == {"r1": (True, None), "r2.building": (False, None), "r3": (True, "name differs"), "r4": (True, "unreadable manifest"), "r5": (True, "product named twice"), "r6": (True, None), "r7": (True, "no product scope")}
    assert found.where("run = 'r1'").first()["pending"] == 1

    items = lambda *paths: [{"language": x, "release_payload_path": p} for x, p in zip(LANGUAGES, paths)]
    release = lambda *products, kind="delta", run="r1": {"release_kind": kind, "source_review": {"run_name": run}, "products": [{"product_key": k, "items": i} for k, i in products]}
    put(releases / "d1" / "release-manifest.json", release(("a", items("zh/a.json", "en/a.json")), ("b", items("zh/b.json", "en/b.json")), ("u", items("../d1/zh/a.json", "en/a.json")), ("v", items("zh/a.json")[:1])))
    for name in ("zh/a.json", "en/a.json", "zh/b.json"):
        put(releases / "d1" / name, "{}")
    put(releases / "d2" / "release-manifest.json", release(("x", items("p", "q")), kind="full"))
    put(releases / "d3.building" / "release-manifest.json", release(("c", items("p", "q"))))
    told = {r["product_key"]: r["error"] for r in listing.deliveries_in(spark, str(releases), LANGUAGES).collect()}
    assert told == {"a": None, "b": "payload missing", "u": "payload path outside", "v": "languages differ"}

    closed = lambda key, **more: {"schema_version": "1.0", "run_name": "r1", "product_key": key, "decision": "ended_without_delivery", "reviewer": "r", "reason": "w"} | more
    put(closures / "r1" / "b.json", closed("b"))
    put(closures / "r1" / "c.json", closed("c", reason=" "))
    put(closures / "r1" / "d.json", closed("e"))
    put(closures / "r9" / "f.json", closed("f"))
    ended = listing.closures_in(spark, str(closures))
    assert {(r["run"], r["product_key"]): r["error"] for r in ended.collect()} == {("r1", "b"): None, ("r1", "c"): "no valid decision", ("r1", "e"): "name differs", ("r9", "f"): "no valid decision"}

    good = lambda df: df.where("error is null").select("run", "product_key")
    left = open_batches(listing.listed_scope(found), good(listing.deliveries_in(spark, str(releases), LANGUAGES)), good(ended))
    assert {(r["run"], r["delivered"], r["closed"], r["unresolved"]) for r in left.collect()} == {("r1", 1, 1, 1), ("r2", 0, 0, 1)}


def test_manifests_are_written_in_their_place(spark, tmp_path):
    """A file for each row and nothing else; hidden folders count, deeper files don't."""
    rows = [(f"r{i}", f'{{"run_name": "r{i}", "batch_kind": "incremental", "scope": {{"product_keys": ["p"]}}}}') for i in range(50)] + [("_own", "{broken")]
    listing.write_manifests(spark.createDataFrame(rows, "directory string, content string"), str(tmp_path / "runs"))
    assert sorted(p.name for p in (tmp_path / "runs").rglob("*") if p.is_file()) == ["run.json"] * 51
    (tmp_path / "runs" / "r1" / "deep").mkdir()
    (tmp_path / "runs" / "r1" / "deep" / "run.json").write_text("{}")
    found = {r["directory"]: r["error"] for r in listing.runs_in(spark, str(tmp_path / "runs")).collect()}
    assert found == {f"r{i}": None for i in range(50)} | {"_own": "unreadable manifest"}


def test_decisions(spark):
    schema = "product_key string, reviewer string, decision string, languages array<string>, materials array<string>, notes string"
    whole, every = LANGUAGES, list(review.MATERIALS)
    asked = [("ok", "r", "approved", whole, every, "n"), ("who", " ", "approved", whole, every, "n"), ("why", "r", "approved", whole, every, ""), ("what", "r", "maybe", whole, every, "n"), ("half", "r", "approved", whole[:1], every, "n"), ("part", "r", "approved", whole, every[:3], "n"), ("no", "r", "rejected", whole[:1], every[:1], "n"), ("odd", "r", "rejected", ["fr"], every, "n"), ("gone", "r", "approved", whole, every, "n"), ("raw", "r", "rejected", whole, every, "n"), ("moved", "r", "approved", whole, every, "n"), ("twice", "r", "rejected", whole, every, "n")]
    products = spark.createDataFrame([(a[0], a[0] != "raw") for a in asked if a[0] != "gone"], "product_key string, ready boolean")
    held = [(a[0], "i", m, "d") for a in asked for m in every]
    queued = spark.createDataFrame(held, "product_key string, item_id string, material string, content string")
    now = spark.createDataFrame([(p, i, m, "e" if p == "moved" and m == "payload" else c) for p, i, m, c in held if (p, m) != ("no", "nothing")], queued.schema)
    decided = spark.createDataFrame([("twice",)], "product_key string")
    got = {r["product_key"]: r["error"] for r in review.decision_errors(spark.createDataFrame(asked, schema), products, queued, now, decided, whole).collect()}
    assert got == {"ok": None, "no": None, "who": "no reviewer", "why": "no notes", "what": "unknown decision", "half": "not all languages inspected", "part": "not all materials inspected", "odd": "unknown scope", "gone": "not queued", "raw": "not ready", "moved": "materials changed since", "twice": "decided already"}


def test_products_of_the_queue(spark):
    rows = [("a", "en-us", []), ("a", "zh-cn", []), ("b", "en-us", ["x", "y"]), ("b", "zh-cn", ["z"]), ("c", "zh-cn", []), ("d", "en-us", []), ("d", "en-us", []), ("d", "zh-cn", [])]
    queued = spark.createDataFrame(rows, "product_key string, language string, reasons array<string>")
    got = {r["product_key"]: (r["ready"], r["reasons"]) for r in review.queue_products(queued, LANGUAGES).collect()}
    assert got == {"a": (True, []), "b": (False, ["zh-cn: z", "en-us: x", "en-us: y"]), "c": (False, ["en-us: no item"]), "d": (False, ["en-us: several items"])}
