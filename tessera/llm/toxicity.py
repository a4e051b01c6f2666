"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer rewrites the words of a clause to tags; its insult arcs, whole words or
word beginnings with weights, are learned from labelled documents.  Four small transducers read
the tags: target, negation, reported speech and threat.  Their composition is one automaton
that says, for each insult or threat, in what kind of clause it stands.  A document's score is a
logistic function of the weights of its matched clauses by kind.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged
from .labelled import fit_logistic, fold, sample

FOLDS, HELD_OUT = 5, 0
#: most labelled documents, by label, that the grammar is fitted on
SAMPLE = {1: 4000, 0: 12000}
#: an arc's least weight (log odds) and least surprise (log likelihood ratio of its counts)
LEAST_WEIGHT, LEAST_SURPRISE, LEAST_TOXIC = 3.4, 13.0, 3
_PREFIXES = (4, 5, 6)
_CACHED = 100_000

OTHER, INSULT, TARGET, NEGATION, SPEECH, MODAL, HARM = range(7)
WORDS = {
    TARGET: "you your yours yourself u du dich dir dein deine ihr euch sie tu toi te vous votre ton ta tú ti usted ustedes vosotros os su",
    NEGATION: "not no never neither nor without isn't aren't wasn't don't doesn't nicht kein keine keinen nie niemals ne pas jamais aucun nunca jamás tampoco ningún sin",
    SPEECH: "said says say wrote writes called calls quote quoted according sagte sagt schrieb nannte laut dit disait écrit appelé selon dijo dice escribió llamó según",
    MODAL: "will shall gonna going must should werde wirst wird muss vais va vont voy vas ir",
    HARM: "kill killed hurt beat burn destroy shoot stab die dead töten umbringen sterben verbrennen tuer mourir brûler frapper matar morir quemar golpear",
}
_WORD = re.compile(r"[^\W\d_]+(?:'[a-z]+)?")
_CLAUSE = re.compile(r"[.!?;:,\n()\[\]\"“”«»]+")


@dataclass(frozen=True)
class Transducer:
    """Reads tags; ``step[state, tag]`` is the next state, any other tag leads to ``rest[state]``.
    ``marks[state]`` is what it says of a match that is read in that state."""

    step: dict[tuple[int, int], int]
    rest: dict[int, int]
    marks: dict[int, frozenset[str]]


def _counting(tag: int, reach: int, mark: str) -> Transducer:
    """Says ``mark`` for ``reach`` tags after ``tag``."""
    return Transducer({(s, tag): reach for s in range(reach + 1)}, {s: max(s - 1, 0) for s in range(reach + 1)}, {s: frozenset([mark]) for s in range(1, reach + 1)})


def _lasting(tag: int, mark: str) -> Transducer:
    """Says ``mark`` from ``tag`` to the clause's end."""
    return Transducer({(0, tag): 1, (1, tag): 1}, {0: 0, 1: 1}, {1: frozenset([mark])})


#: a modal, then harm within four words: what is read after that stands in a threat
_THREAT = Transducer({(s, MODAL): 4 for s in range(5)} | {(s, HARM): 5 for s in range(1, 5)}, {0: 0, 1: 0, 2: 1, 3: 2, 4: 3, 5: 5}, {5: frozenset(["threat"])})
PARTS = (_lasting(TARGET, "target"), _counting(NEGATION, 3, "negated"), _lasting(SPEECH, "reported"), _THREAT)


def compose(parts: tuple[Transducer, ...]) -> tuple[list[list[int]], list[frozenset[str]]]:
    """One automaton that reads as all the parts do: (next state by state and tag, marks by state)."""
    first = (0,) * len(parts)
    number, todo, table = {first: 0}, [first], []
    while todo:
        state = todo.pop(0)
        row = []
        for tag in range(7):
            after = tuple(p.step.get((s, tag), p.rest[s]) for p, s in zip(parts, state, strict=True))
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
        table.append(row)
    return table, [frozenset().union(*(p.marks.get(s, frozenset()) for p, s in zip(parts, state, strict=True))) for state in number]


FEATURES = ("plain", "aimed", "negated", "reported", "threat", "strongest")


@dataclass
class Grammar:
    """Insult arcs with weights, and the weights of the clause kinds."""

    words: dict[str, float]
    beginnings: dict[str, float]
    weights: list[float] = field(default_factory=lambda: [0.0] * (len(FEATURES) + 1))

    def __post_init__(self):
        self.table, self.marks = compose(PARTS)
        self.fixed = {w: tag for tag, listed in WORDS.items() for w in listed.split()}
        self.seen: dict[str, tuple[int, float]] = {}

    def tag(self, word: str) -> tuple[int, float]:
        if (known := self.seen.get(word)) is None:
            weight = max([self.words.get(word, 0.0), *(self.beginnings.get(word[:n], 0.0) for n in _PREFIXES if len(word) >= n)])
            known = (INSULT, weight) if weight > 0 else (self.fixed.get(word, OTHER), 0.0)
            if len(self.seen) >= _CACHED:
                self.seen.clear()
            self.seen[word] = known
        return known

    def features(self, text: str) -> list[float]:
        """Summed weights of matched clauses by kind, and the strongest insult of a clause that is neither
        negated nor reported; log1p keeps long texts comparable."""
        total = dict.fromkeys(FEATURES, 0.0)
        lowered, tag = text.lower(), self.tag
        kinds = {w: tag(w)[0] for w in set(_WORD.findall(lowered))}
        if INSULT in (found := set(kinds.values())) or HARM in found:
            for clause in _CLAUSE.split(lowered):
                self._clause(clause, total)
        return [math.log1p(total[k]) for k in FEATURES[:-1]] + [total["strongest"]]

    def _clause(self, clause: str, total: dict[str, float]) -> None:
        state, insults, strongest, negated, threat = 0, 0.0, 0.0, False, False
        for word in _WORD.findall(clause):
            kind, weight = self.tag(word)
            if kind == INSULT:
                insults += weight
                strongest = max(strongest, weight)
                negated |= "negated" in self.marks[state]
            state = self.table[state][kind]
            threat |= "threat" in self.marks[state]
        marks = self.marks[state]
        total["threat"] += threat
        if insults:
            kind = "reported" if "reported" in marks else "negated" if negated else "aimed" if "target" in marks else "plain"
            total[kind] += insults
            if kind in ("aimed", "plain"):
                total["strongest"] = max(total["strongest"], strongest)

    def score(self, text: str) -> float:
        z = sum(w * x for w, x in zip(self.weights, [*self.features(text), 1.0], strict=True))
        return round(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), 6)


def _shapes(text: str) -> set[str]:
    """Words of a text and their beginnings; a beginning ends with ``*``."""
    words = set(_WORD.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in _PREFIXES if len(w) > n}


_MINIMA = 8


def _arcs(rows: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Shapes that stand in far more toxic documents than chance lets them.

    Copies would count one text many times, so of documents with the same ``_MINIMA`` least word hashes one
    stands for all; texts that differ by more than a few words all count.  Counts are made in the tasks, summed and judged by a grouped aggregation;
    every shape that passes is an arc.  Each stands in three toxic documents at least, so the
    bound on the labelled documents bounds the arcs too.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            least = [heapq.nsmallest(_MINIMA, {xxhash.xxh64_intdigest(w) for w in _WORD.findall(t.lower())}) for t in batch.column("text").to_pylist()]
            sketch = [xxhash.xxh64_intdigest(repr(x)) >> 1 for x in least]
            yield pa.RecordBatch.from_arrays([pa.array(sketch, pa.int64()), *batch.columns], ["sketch", *batch.schema.names])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                by[y].update(_shapes(text))
                by[y][""] += 1
        shapes = list(by[0].keys() | by[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(shapes, pa.string()), pa.array([by[1][s] for s in shapes], pa.int64()), pa.array([by[0][s] for s in shapes], pa.int64())], ["shape", "toxic", "clean"])

    id_kind = dict(rows.dtypes)["id"]
    apart = rows.mapInArrow(keyed, f"sketch bigint, id {id_kind}, text string, y int").groupBy("sketch", "y").agg(F.min_by("text", "id").alias("text")).select("text", "y")
    counts = apart.mapInArrow(counted, "shape string, toxic bigint, clean bigint").groupBy("shape").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts, _ = staged(counts, "shapes")
    whole = counts.where("shape = ''").first()
    words: dict[str, float] = {}
    beginnings: dict[str, float] = {}
    if whole is None or not whole["toxic"] or not whole["clean"]:
        return words, beginnings
    rate = whole["toxic"] / (whole["toxic"] + whole["clean"])
    share, clean_share = F.col("toxic") / F.col("n"), F.col("clean") / F.col("n")
    surprise = F.col("n") * (share * F.log(share / rate) + F.when(F.col("clean") > 0, clean_share * F.log(clean_share / (1 - rate))).otherwise(0.0))
    weight = F.log((F.col("toxic") + 0.5) / (whole["toxic"] + 1)) - F.log((F.col("clean") + 0.5) / (whole["clean"] + 1))
    judged = counts.where(f"shape != '' and toxic >= {LEAST_TOXIC}").withColumn("n", F.col("toxic") + F.col("clean")).select("shape", share.alias("share"), surprise.alias("surprise"), F.round(weight, 4).alias("weight"))
    for row in judged.where((F.col("share") > rate) & (F.col("weight") >= LEAST_WEIGHT) & (F.col("surprise") >= LEAST_SURPRISE)).collect():
        (beginnings if row["shape"].endswith("*") else words)[row["shape"].rstrip("*")] = row["weight"]
    return words, beginnings


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", rows: dict[int, int] | None = None) -> Grammar:
    """The grammar fitted on at most ``rows`` labelled documents of the training folds.

    Without labels of both kinds there are no arcs, and every text gets the same score."""
    small_batches(docs.sparkSession)
    held = sample(docs, labels, label, fold(id_col, FOLDS) != HELD_OUT, rows or SAMPLE, id_col, text_col)
    grammar = Grammar(*_arcs(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [grammar.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("y")], ["x", "y"])

    fitted = held.mapInArrow(run, "x array<double>, y int").toPandas()
    if len(fitted):
        grammar.weights = fit_logistic(np.array(fitted["x"].tolist()), fitted["y"].to_numpy(float)).round(9).tolist()
    return grammar


def _column(texts: pa.Array, grammar: Grammar) -> pa.Array:
    return pa.array([grammar.score(t or "") for t in texts.to_pylist()], pa.float64())


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, from the text alone; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), _column(batch.column("text"), grammar)], ["id", "score"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, score double").withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, grammar: Grammar, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose texts score below the threshold, all columns as they were."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.compute.less(_column(batch.column(at), grammar), threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns; the labels of held-out documents are never used."""
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
