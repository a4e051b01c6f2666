import glob
import os

import pytest
from pyspark.sql import functions as F

from tessera.plans import run
from tessera.sources import stages

from .test_batch_run import items
from .test_tree_and_plans import PAGE


class Killed(Exception):
    pass


def killed_after(name):
    def after(done):
        if done == name:
            raise Killed(done)

    return after


def test_a_killed_run_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    """Killed behind a stage, then in the middle of a write: nothing sealed is computed again, the result is that of a run in one go."""
    pages = spark.createDataFrame([(0, PAGE), (1, PAGE.replace("technical-azure-selector", "x")), (2, None)], "item_id long, html string")
    scope, path = items(spark, 4), f"{tmp_path}/run-1"
    with pytest.raises(Killed):
        run.run_or_resume(path, scope, pages, "simple_static", after=killed_after("extraction"))
    whole = stages.written

    def torn(df, where):
        whole(df, where)
        if "/violations." in where:
            raise Killed(where)
        return whole(df, where)

    monkeypatch.setattr(stages, "written", torn)
    with pytest.raises(Killed):
        run.run_or_resume(path, scope, pages, "simple_static")
    monkeypatch.undo()
    assert not os.path.exists(path) and glob.glob(f"{path}.building/violations.building-*")
    result, log = run.run_or_resume(path, scope, pages, "simple_static")
    assert log.reused == ["nodes", "extraction", "nodes_again", "extraction_again"] and log.computed == ["violations", "l3a", "l3b", "items", "summary"]
    assert {r["item_id"]: (r["status"], r["reason"]) for r in result.items.collect()} == {0: ("passed", ""), 1: ("blocked", "extraction"), 2: ("blocked", "input"), 3: ("blocked", "input")}
    assert [r["item_id"] for r in result.payloads.collect()] == [0] and os.path.exists(path)
    again, log = run.run_or_resume(path, scope, pages, "simple_static")
    assert log.computed == [] and again.payloads.count() == 1
    with pytest.raises(stages.StageError, match="other inputs"):
        run.run_or_resume(path, scope, pages.where("item_id > 0"), "simple_static")


def test_a_stage_that_is_cut_short_is_told(spark, tmp_path):
    table = spark.range(1000).repartition(4).withColumn("m", F.create_map(F.lit("k"), "id"))
    log = stages.Stages(spark, str(tmp_path), "i")
    assert log.stage("a", lambda: table).count() == 1000
    os.remove(glob.glob(f"{tmp_path}/a/table/part-*")[0])
    with pytest.raises(stages.StageError, match="record"):
        stages.Stages(spark, str(tmp_path), "i").stage("a", lambda: table)
    with pytest.raises(stages.StageError, match="missing"):
        stages.Stages(spark, str(tmp_path), "i", may_compute=False).stage("b", lambda: table)


def test_what_is_written_must_be_what_went_out(spark, tmp_path, monkeypatch):
    """The reread is compared with what was observed on the way out."""
    from pyspark.sql import DataFrameReader

    real = DataFrameReader.parquet

    def short(self, *paths, **options):
        os.remove(sorted(glob.glob(f"{paths[0]}/part-*"))[-1])
        return real(self, *paths, **options)

    monkeypatch.setattr(DataFrameReader, "parquet", short)
    with pytest.raises(stages.StageError, match="went out"):
        stages.written(spark.range(100).repartition(3), f"{tmp_path}/t")


def test_facts_do_not_hang_on_order(spark):
    a = spark.createDataFrame([(1, None, {"x": 1}), (2, "b", None), (2, "b", None)], "a long, b string, m map<string,int>")
    assert stages.facts(a) == stages.facts(a.orderBy(F.desc("a")).repartition(3)) != stages.facts(a.limit(2))
    assert stages.facts(a.limit(0)) == (0, "0")


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    from types import SimpleNamespace

    from tessera.sources import commit

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="local-cluster[2,1,1024]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        commit.shared_path(fake, "x")
