"""Stages of a run as sealed tables: each is written, read again, recorded and sealed by one rename, so a run that was killed goes
on behind its last sealed stage and computes none of them twice."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from tessera.sources.commit import seal, staged


class StageError(RuntimeError):
    """A stage is not what its record says, or belongs to other inputs."""


def _measures(df: DataFrame) -> list[Column]:
    """Number of rows and an order-free digest; hashes take no maps, so these count as their JSON."""
    columns = [F.to_json(f"`{f.name}`") if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    own = F.xxhash64(*columns).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(own), F.lit(0)).cast("string").alias("digest")]


def facts(df: DataFrame) -> tuple[int, str]:
    """(rows, digest) of a table."""
    found = df.agg(*_measures(df)).first()
    return found["rows"], found["digest"]


def written(df: DataFrame, path: str) -> tuple[DataFrame, tuple[int, str]]:
    """Write a table, read it back and compare the two; what was observed on the way out must be there.
    Returns the table that was read and its facts."""
    seen = Observation()
    df.observe(seen, *_measures(df)).write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    there, out = facts(back), (seen.get["rows"], seen.get["digest"])
    if there != out:
        raise StageError(f"{path}: {out[0]} rows went out, {there[0]} are there, or their contents differ")
    return back, there


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _fs(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


class Scratch:
    """Stages of a run that nobody resumes: tables in the shared working folder."""

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return staged(make(), name)[0]


class Stages:
    """Sealed stages in one folder that every executor reaches.

    ``identity`` says what the run's inputs are; a stage of other inputs is refused.  A sealed
    stage is read, held against its record and used again; any other one is computed, whatever a
    killed writer left of it.  Of two writers one alone can seal, the other takes the sealed one.
    ``after`` is told the name of each stage when it is there.
    """

    def __init__(self, spark: SparkSession, folder: str, identity: str, after: Callable[[str], None] | None = None, may_compute: bool = True):
        self.spark, self.folder, self.identity, self.after, self.may_compute = spark, folder.rstrip("/"), identity, after, may_compute
        self.computed: list[str] = []
        self.reused: list[str] = []

    def _sealed(self, name: str) -> DataFrame | None:
        path = f"{self.folder}/{name}"
        if not exists(self.spark, f"{path}/record.json"):
            return None
        record = json.loads(read_text(self.spark, f"{path}/record.json"))
        if record["identity"] != self.identity:
            raise StageError(f"{name} was made of other inputs")
        table = self.spark.read.schema(StructType.fromJson(record["schema"])).parquet(f"{path}/table")
        if list(facts(table)) != [record["rows"], record["digest"]]:
            raise StageError(f"{name} is not what its record says")
        return table

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        table = self._sealed(name)
        if table is not None:
            self.reused.append(name)
        else:
            if not self.may_compute:
                raise StageError(f"{name} is missing from a sealed run")
            building = f"{self.folder}/{name}.building-{uuid.uuid4().hex}"
            made = make()
            _, (rows, digest) = written(made, f"{building}/table")
            write_text(self.spark, f"{building}/record.json", json.dumps({"stage": name, "identity": self.identity, "rows": rows, "digest": digest, "schema": made.schema.jsonValue()}))
            seal(self.spark, building, f"{self.folder}/{name}")
            table = self._sealed(name)
            if table is None:
                raise StageError(f"{name} could not be sealed")
            self.computed.append(name)
        if self.after:
            self.after(name)
        return table
