"""Checks of payloads: repeated extraction and field comparison, as full-outer joins of value trees.

Nothing here is imported from the extraction plans, so a mistake there can't hide itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _walk(value, path: str) -> Iterator[tuple[str, str, str]]:
    kind = "null" if value is None else {bool: "boolean", int: "number", float: "number", str: "string", list: "list", dict: "object"}[type(value)]
    yield path, kind, str(len(value)) if isinstance(value, list) else json.dumps(list(value)) if isinstance(value, dict) else json.dumps(value, ensure_ascii=False)
    for key, child in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
        yield from _walk(child, f"{path}[{key}]" if isinstance(value, list) else f"{path}.{key}")


def json_paths(rows: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, path, kind, value): every node of a JSON text; lists and objects carry their size."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for item, text in zip(part["item"], part["text"], strict=True):
                try:
                    out += [(item, *node) for node in _walk(json.loads(text), "$")]
                except (TypeError, ValueError) as error:
                    out.append((item, "$", "unreadable", str(error)))
            yield pd.DataFrame(out, columns=["item", "path", "kind", "value"])

    kind = dict(rows.dtypes)[id_col]
    return rows.select(F.col(id_col).alias("item"), F.col(json_col).alias("text")).mapInPandas(run, f"item {kind}, path string, kind string, value string").withColumnRenamed("item", id_col)


def tree_difference(old: DataFrame, new: DataFrame, id_col: str) -> DataFrame:
    """(id, path, difference) of two tables of paths: missing, extra, type, length or value."""
    a, b = (df.select(id_col, "path", F.struct("kind", "value").alias(name)) for df, name in ((old, "was"), (new, "now")))
    both = a.join(b, [id_col, "path"], "full_outer")
    difference = F.when(F.col("now").isNull(), "missing").when(F.col("was").isNull(), "extra").when(F.col("was.kind") != F.col("now.kind"), "type").when(F.col("was.value") != F.col("now.value"), F.when(F.col("was.kind") == "list", "length").otherwise("value"))
    return both.select(id_col, "path", difference.alias("difference")).where("difference is not null")


def _tree(text: str | None) -> dict[str, tuple[str, str]]:
    try:
        return {path: (kind, value) for path, kind, value in _walk(json.loads(text), "$")}
    except (TypeError, ValueError) as error:
        return {"$": ("unreadable", str(error))}


def _difference(was: tuple[str, str] | None, now: tuple[str, str] | None) -> str | None:
    if was is None or now is None:
        return "missing" if now is None else "extra"
    if was[0] != now[0]:
        return "type"
    return None if was[1] == now[1] else "length" if was[0] == "list" else "value"


def _compared(old: DataFrame, new: DataFrame, id_col: str, json_col: str, equal_too: bool) -> DataFrame:
    """(id, path, difference): the rows of ``tree_difference`` for texts of which an id has one on each side at most, and a row
    ``unreadable`` for each text that is none.  Texts meet in one join and their trees in a task; of equal texts, which are looked at
    where ``equal_too`` says so, only whether they can be read is told."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (whole.slice(at, 1000) for whole in parts for at in range(0, whole.num_rows, 1000)):
            at, paths, found = [], [], []
            for i, (was, now, is_old, is_new) in enumerate(zip(*(part.column(c).to_pylist() for c in ("was", "now", "is_old", "is_new")), strict=True)):
                if is_old and is_new and was == now:
                    try:
                        json.loads(was)
                    except (TypeError, ValueError):
                        rows = [("$", "unreadable")]
                    else:
                        continue
                else:
                    a, b = _tree(was) if is_old else {}, _tree(now) if is_new else {}
                    rows = [("$", "unreadable") for tree in (a, b) if tree.get("$", ("",))[0] == "unreadable"]
                    rows += [(path, told) for path in a | b if (told := _difference(a.get(path), b.get(path)))]
                for path, told in rows:
                    at.append(i)
                    paths.append(path)
                    found.append(told)
            yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(at, pa.int64())), pa.array(paths, pa.string()), pa.array(found, pa.string())], names=["item", "path", "difference"])

    a, b = (df.select(F.col(id_col).alias("item"), F.col(json_col).alias(text), F.lit(True).alias(there)) for df, text, there in ((old, "was", "is_old"), (new, "now", "is_new")))
    both = a.join(b, "item", "full_outer")
    if not equal_too:
        both = both.where("not (is_old <=> is_new and was <=> now)")
    return both.mapInArrow(run, f"item {dict(both.dtypes)['item']}, path string, difference string").withColumnRenamed("item", id_col)


def text_difference(old: DataFrame, new: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """``tree_difference`` of JSON texts, of which an id has one on each side at most; paths that agree are never shuffled."""
    return _compared(old, new, id_col, json_col, False).where("difference != 'unreadable'")


def check_status(items: DataFrame, differences: DataFrame, errors: DataFrame, id_col: str) -> DataFrame:
    """(id, status, fields): blocked on an error, failed on a difference, else passed."""
    counted = differences.groupBy(id_col).agg(F.count("*").alias("fields"))
    stopped = errors.select(id_col, F.lit(True).alias("stopped")).distinct()
    joined = items.select(id_col).join(counted, id_col, "left").join(stopped, id_col, "left")
    return joined.select(id_col, F.when(F.col("stopped"), "blocked").when(F.col("fields") > 0, "failed").otherwise("passed").alias("status"), F.coalesce("fields", F.lit(0)).alias("fields"))


def repeat_check(first: DataFrame, second: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Two extractions of the same inputs must give the same values."""
    found = _compared(first, second, id_col, json_col, True)
    told = found.groupBy(id_col).agg(F.count_if(F.col("difference") != "unreadable").alias("fields"), F.bool_or(F.col("difference") == "unreadable").alias("stopped"))
    joined = first.select(id_col).unionByName(second.select(id_col)).distinct().join(told, id_col, "left")
    return joined.select(id_col, F.when(F.col("stopped"), "blocked").when(F.col("fields") > 0, "failed").otherwise("passed").alias("status"), F.coalesce("fields", F.lit(0)).alias("fields"))


def field_comparison(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, field, status): matched, mismatched, missing or extra for each field, by ordinal keys."""
    long = lambda df, name: df.select(*keys, F.explode(F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields)))).alias("field", name))
    both = long(expected, "was").join(long(actual, "now"), [*keys, "field"], "full_outer")
    return both.select(*keys, "field", F.when(F.col("now").isNull(), "missing").when(F.col("was").isNull(), "extra").when(F.col("was") == F.col("now"), "matched").otherwise("mismatched").alias("status"))


def comparison_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("field").agg(F.count_if(F.col("status") == "matched").alias("matched"), F.count_if(F.col("status") != "matched").alias("mismatched"))
