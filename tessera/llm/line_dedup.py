"""Line dedup: lines that several documents hold go, except in the smallest document that holds them.

Normalised lines are exploded and hashed, the documents of each hash are counted with a
map-side combine, and the lines of the hashes over the threshold come back to their documents
as places, from which each text is put together again.  A document's row is told by its id
and the digest of its text, so nothing hangs on the order of rows or on a rerun after a lost executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged

LEAST_LENGTH = 10
LEAST_DOCUMENTS = 2
_BLANKS = " \t\n\x0b\x0c\r"


def _digest(text: Column) -> Column:
    """The first 128 bits of SHA-256; empty for a null.  Never null, or else each join would
    compute it once more to filter nulls."""
    return F.coalesce(F.substring(F.unhex(F.sha2(text, 256)), 1, 16), F.lit(b""))


def lower_ascii(text: Column) -> Column:
    """The text with only A-Z in lower case."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """(id, own: digest of the text, at: place of the line, h: hash of its key) of every line
    whose key has ``least_length`` code points or more."""
    lowered = docs.select(F.col(id_col).alias("id"), _digest(F.col(text_col)).alias("own"), lower_ascii(F.col(text_col)).alias("text"))
    lines = lowered.select("id", "own", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    keyed = lines.select("id", "own", "at", F.btrim("line", F.lit(_BLANKS)).alias("key")).where(F.length("key") >= least_length)
    return keyed.select("id", "own", "at", _digest(F.col("key")).alias("h"))


def repeated_hashes(lines: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(h, keeper, n_documents) of the hashes that ``least_documents`` documents or more hold; the
    keeper is the smallest id.  All rows without an id are one document, behind every other.

    Distinct documents are counted in two aggregations, each combined before its shuffle."""
    held = lines.select("h", "id").distinct()
    counted = held.groupBy("h").agg(F.min("id").alias("keeper"), F.count("*").alias("n_documents"))
    return counted.where(F.col("n_documents") >= least_documents)


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Appends n_lines, n_dropped and the kept text, and drops the two helpers before them."""
    for batch in batches:
        texts, drops = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
        n_lines, n_dropped, kept = [], [], []
        for text, gone in zip(texts, drops, strict=True):
            lines = (text or "").split("\n")
            if gone:
                out = set(gone)
                text = "\n".join(line for at, line in enumerate(lines) if at not in out)
            n_lines.append(len(lines))
            n_dropped.append(len(gone or ()))
            kept.append(text)
        more = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *more], [*batch.schema.names[:-2], "_n_lines", "_n_dropped", "_kept"])


def _judged(docs: DataFrame, columns: dict[str, Column], id_col: str, text_col: str, least_length: int, least_documents: int) -> DataFrame:
    """The given columns of every row, then n_lines, n_dropped and the kept text."""
    small_batches(docs.sparkSession)
    lines = line_hashes(docs, id_col, text_col, least_length)
    repeated, _ = staged(repeated_hashes(lines, least_documents).select("h", "keeper"), "repeated-lines")
    gone = lines.join(repeated, "h").where(~F.col("id").eqNullSafe(F.col("keeper")))
    places, _ = staged(gone.groupBy("id", "own").agg(F.collect_set("at").alias("gone")), "dropped-lines")
    rows = docs.select(F.col(id_col).alias("id"), _digest(F.col(text_col)).alias("own"), F.struct(*[c.alias(name) for name, c in columns.items()]).alias("row"), F.col(text_col).alias("text"))
    p = places.select(F.col("id").alias("p_id"), F.col("own").alias("p_own"), "gone")
    both = rows.join(p, (rows["own"] == p["p_own"]) & rows["id"].eqNullSafe(p["p_id"]), "left").select("row", "text", "gone")
    kind = both.schema["row"].dataType.simpleString()
    built = both.mapInArrow(_rebuilt, f"row {kind}, _n_lines bigint, _n_dropped bigint, _kept string")
    return built.select(*[F.col("row").getField(name).alias(name) for name in columns], F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.col("_kept").alias("kept"))


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """One row per document row: id, n_lines before dropping, n_dropped, kept text.

    A null or empty text is one empty line and stays as it is.  Rows of the same id are one
    document: a line that stands only in them, or several times in one text, stays.  Rows with
    a null id are one document behind every other.  Equal rows give equal rows.  Other columns are ignored, an empty
    table gives an empty table.
    """
    return _judged(docs, {"id": F.col(id_col)}, id_col, text_col, least_length, least_documents).withColumnRenamed("id", id_col)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` with the kept lines as text, all other columns as they were (see ``line_counts``)."""
    columns = {f"c{i}": F.col(f"`{name}`") for i, name in enumerate(docs.columns) if name != text_col}
    found = _judged(docs, columns, id_col, text_col, least_length, least_documents)
    return found.select(*[F.col("kept" if name == text_col else f"c{i}").alias(name) for i, name in enumerate(docs.columns)])


def line_report(docs: DataFrame) -> DataFrame:
    """The query's columns: the counts and the digest of the kept text."""
    return line_counts(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
l AS (SELECT doc_id, unnest(w) AS line, unnest(range(1, len(w) + 1)) AS pos FROM t),
k AS (SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (r.key IS NOT NULL AND k.doc_id != r.keeper) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (r.key IS NULL OR k.doc_id = r.keeper), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY k.doc_id
"""
