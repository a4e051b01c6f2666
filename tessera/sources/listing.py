"""Runs, releases and closures as tables, read from the folders that hold their manifests.

A manifest that can't be read or contradicts its place is a row with an error, never an exception."""

from __future__ import annotations

from collections.abc import Iterator

from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

BUILDING = ".building"
_RUN = "run_name string, batch_kind string, scope struct<product_keys: array<string>>, items array<struct<status: string>>, _broken string"
_RELEASE = "release_kind string, source_review struct<run_name: string, incremental_run_name: string>, products array<struct<product_key: string, items: array<struct<language: string, release_payload_path: string>>>>, _broken string"
_CLOSURE = "schema_version string, run_name string, product_key string, decision string, reviewer string, reason string, _broken string"


def _first(*cases: tuple[Column, str]) -> Column:
    return F.coalesce(*(F.when(case, F.lit(text)) for case, text in cases))


def _files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path, content) of the files of a name, which may be a glob, that stand in the folders of ``root``; none if there is no such folder.

    The root is listed once and its folders are listed by tasks: a glob would list one after the other on the driver."""
    fs = spark._jvm.org.apache.hadoop.fs
    top, conf = fs.Path(root), spark._jsc.hadoopConfiguration()
    system = top.getFileSystem(conf)
    if not system.globStatus(top):
        return spark.createDataFrame([], "path string, content string")
    read = spark.read.format("binaryFile")
    found = read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root)
    depth = len(system.makeQualified(top).toString().split("/")) + 2
    found = found.where(F.size(F.split("path", "/")) == depth)
    # Spark passes over folders whose names begin like those of its own
    hidden = f"{root}/[_.]*/{name}"
    if system.globStatus(fs.Path(hidden)):
        own = spark.read.format("binaryFile").load(hidden)
        found = found.join(own.select("path"), "path", "left_anti").unionByName(own)
    return found.select("path", F.decode("content", "UTF-8").alias("content"))


def _manifests(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """(path, directory, m) of the manifest of each folder below ``root``; of a folder ``key=x`` the directory is x."""
    parts = F.split("path", "/")
    directory = F.regexp_replace(F.element_at(parts, -2), "^[A-Za-z_]+=", "")
    return _files(spark, root, name).select("path", directory.alias("directory"), F.from_json("content", schema, {"columnNameOfCorruptRecord": "_broken"}).alias("m"))


def write_manifests(rows: DataFrame, root: str, name: str = "run.json") -> None:
    """Write the file of each row (directory, content) below ``root``.

    Tasks write them side by side, each in its place at once, so that a folder costs no commit on the driver; a task that
    is repeated writes the same files again.  The folder must be one that Arrow opens by its address (local, HDFS, S3, GCS, Azure)."""
    spark = rows.sparkSession
    spread = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "directory")
    system, top = FileSystem.from_uri(root)
    system.create_dir(top)

    def write(part: Iterator[Row]) -> None:
        system, top = FileSystem.from_uri(root)
        for row in part:
            system.create_dir(f"{top}/{row.directory}")
            with system.open_output_stream(f"{top}/{row.directory}/{name}") as out:
                out.write(row.content.encode())

    spread.foreachPartition(write)


def runs_in(spark: SparkSession, root: str, name: str = "run.json") -> DataFrame:
    """(run, directory, kind, sealed, product_keys, pending, error) of the runs below a folder.

    A run that is being written stands in ``X.building``; folders without a manifest are no runs."""
    keys, run = F.col("m.scope.product_keys"), F.col("m.run_name")
    sealed = ~F.endswith("directory", F.lit(BUILDING))
    error = _first(
        (F.col("m").isNull() | F.col("m._broken").isNotNull(), "unreadable manifest"),
        (run.isNull(), "no run name"),
        (F.col("directory") != F.when(sealed, run).otherwise(F.concat(run, F.lit(BUILDING))), "name differs"),
        (keys.isNull() | F.exists(keys, lambda k: k.isNull()), "no product scope"),
        (F.size(F.array_distinct(keys)) < F.size(keys), "product named twice"),
    )
    pending = F.size(F.filter(F.coalesce("m.items.status", F.array().cast("array<string>")), lambda s: s.isNull() | (s == "pending"))).cast("bigint")
    return _manifests(spark, root, name, _RUN).select(run.alias("run"), "directory", F.col("m.batch_kind").alias("kind"), sealed.alias("sealed"), keys.alias("product_keys"), pending.alias("pending"), error.alias("error"))


def deliveries_in(spark: SparkSession, root: str, languages: list[str], name: str = "release-manifest.json") -> DataFrame:
    """(run, product_key, release, error): what sealed delta releases delivered of which run.

    A product must come in exactly the ``languages``, in that order, each with a payload that lies in the release's own folder; one that two
    releases of a run deliver is an error in both."""
    found = _manifests(spark, root, name, _RELEASE).where(~F.endswith("directory", F.lit(BUILDING)))
    broken = F.col("m").isNull() | F.col("m._broken").isNotNull()
    rows = found.where(broken | (F.col("m.release_kind") == "delta"))
    rows = rows.select(F.coalesce("m.source_review.incremental_run_name", "m.source_review.run_name").alias("run"), F.col("directory").alias("release"), F.regexp_replace("path", "/[^/]*$", "").alias("folder"), broken.alias("broken"), F.posexplode_outer("m.products").alias("n", "p")).withColumn("n", F.coalesce("n", F.lit(-1)))
    place = ["folder", "n"]
    items = rows.select(*place, F.explode_outer("p.items").alias("i")).select(*place, F.col("i.release_payload_path").alias("rel"), F.concat_ws("/", "folder", "i.release_payload_path").alias("at"))
    items = items.join(_paths(spark, root).select(F.col("path").alias("at"), F.lit(True).alias("there")), "at", "left")
    outside = F.col("rel").startswith("/") | F.array_contains(F.split("rel", "/"), "..")
    told = items.groupBy(*place).agg(F.max(F.col("rel").isNull()).alias("no_path"), F.max(F.coalesce(outside, F.lit(False))).alias("outside"), F.max(F.col("there").isNull()).alias("gone"))
    error = _first(
        (F.col("broken"), "unreadable manifest"),
        (F.col("run").isNull(), "no source run"),
        (F.col("p.product_key").isNull(), "no product"),
        (~F.col("p.items.language").eqNullSafe(F.array(*map(F.lit, languages))), "languages differ"),
        (F.col("no_path"), "no payload path"),
        (F.col("outside"), "payload path outside"),
        (F.col("gone"), "payload missing"),
    )
    judged = rows.join(told, place).select("run", F.col("p.product_key").alias("product_key"), "release", error.alias("error"))
    often = judged.where("product_key is not null").groupBy("run", "product_key").agg(F.count("*").alias("often"))
    joined = judged.join(often, ["run", "product_key"], "left")
    return joined.select("run", "product_key", "release", F.coalesce("error", F.when(F.col("often") > 1, F.lit("delivered twice"))).alias("error"))


def _paths(spark: SparkSession, root: str) -> DataFrame:
    """(path) of every file below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")


def closures_in(spark: SparkSession, root: str) -> DataFrame:
    """(run, product_key, error) of decisions to end a product without delivery, one file ``run/product.json`` each."""
    found = _files(spark, root, "*.json").select("path", F.from_json("content", _CLOSURE, {"columnNameOfCorruptRecord": "_broken"}).alias("m"))
    parts = F.split("path", "/")
    run, stem = F.element_at(parts, -2), F.regexp_replace(F.element_at(parts, -1), r"\.json$", "")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    error = _first(
        (F.col("m").isNull() | F.col("m._broken").isNotNull(), "unreadable decision"),
        (~F.col("m.schema_version").eqNullSafe("1.0") | ~F.col("m.decision").eqNullSafe("ended_without_delivery") | ~F.col("m.run_name").eqNullSafe(run) | F.col("m.product_key").isNull() | blank("m.reviewer") | blank("m.reason"), "no valid decision"),
        (stem != F.col("m.product_key"), "name differs"),
    )
    return found.select(run.alias("run"), F.coalesce("m.product_key", stem).alias("product_key"), error.alias("error"))


def listed_scope(runs: DataFrame, kind: str = "incremental") -> DataFrame:
    """(run, product_key) of the faultless runs of a kind, for ``operators.runs.open_batches``."""
    return runs.where((F.col("kind") == kind) & F.col("error").isNull()).select("run", F.explode("product_keys").alias("product_key"))
