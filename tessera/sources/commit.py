"""Sinks: staged tables, write-once output, all-or-nothing freezes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares (``spark.checkpoint.dir``).

    Where it is not set a temporary folder is used, but only in local mode: on a cluster each
    executor would write to its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="tessera-"))
        base = _local[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write to the folder that the cluster shares and read back; ends the lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


#: bytes of rows, as a shuffle has counted them, up to which a side of a join may go through the driver
MEASURED_BYTES = 1 << 20
_STATIC, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def measured_joins(plan: Callable) -> Callable:
    """A plan all of whose jobs, in the session of its first session or table, broadcast a side of a join by its measured size only, if
    no hint asks for it.

    A staged table of repeated values has files of a fraction of what its rows take, so what Spark tells by the size of files
    grows in the driver with the input.  Both settings are put back behind the plan; what it returns is not covered unless it is staged."""

    @functools.wraps(plan)
    def run(*args, **kwargs):
        first = next(x for x in (*args, *kwargs.values()) if isinstance(x, SparkSession | DataFrame))
        spark = first if isinstance(first, SparkSession) else first.sparkSession
        before = {name: spark.conf.get(name, None) for name in (_STATIC, _MEASURED)}
        most = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        if most >= 0:
            spark.conf.set(_MEASURED, str(min(most, MEASURED_BYTES)))
            spark.conf.set(_STATIC, "-1")
        try:
            return plan(*args, **kwargs)
        finally:
            for name, value in before.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)

    return run


def write_once(df: DataFrame, path: str) -> None:
    """Write a sealed table; one that is there already is never replaced."""
    df.write.mode("errorifexists").parquet(path)


def seal(spark: SparkSession, building: str, sealed: str) -> bool:
    """Rename ``X.building`` to ``X``; False if a sealed one is there.

    One rename that refuses to replace decides, so of two writers one alone can pass."""
    fs = spark._jvm.org.apache.hadoop.fs
    kind = getattr(fs, "Options$Rename")
    options = spark._sc._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    source, target = fs.Path(building), fs.Path(sealed)
    try:
        fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def freeze_actions(items: DataFrame, upstream: DataFrame, frozen: DataFrame, keys: list[str], product: str, content: str) -> DataFrame:
    """(keys, action): unchanged, copied or updated; if one item of a product lacks its source, all
    of its items are blocked."""
    up = upstream.select(*keys, F.col(content).alias("new"))
    old = frozen.select(*keys, F.col(content).alias("old"))
    joined = items.select(product, *(k for k in keys if k != product)).join(up, keys, "left").join(old, keys, "left")
    gate = joined.groupBy(product).agg(F.bool_and(F.coalesce(F.length("new") > 0, F.lit(False))).alias("whole"))
    action = F.when(~F.col("whole"), "blocked").when(F.col("old").isNull(), "copied").when(F.col("old") == F.col("new"), "unchanged").otherwise("updated")
    return joined.join(gate, product).select(*keys, action.alias("action"))
