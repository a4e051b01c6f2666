"""Near-duplicate embeddings by a robust-pruned flat graph.

Equal vectors are one vertex with a weight.  Vertices go to the shards of their nearest centres,
so shards overlap; a large shard is cut into blocks whose pairs are units of their own, which
bounds what one task holds whatever the skew.  Each unit builds a pruned graph, the adjacency
lists of all units are united by vertex, and a greedy search that starts at the unit's medoid and
at the query's own vertex expands through everything in range.  A pair is counted in one unit
alone, the first that holds both, so counts add up without listing pairs; a unit gives a count per
vertex and a spanning forest of its links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import connected_components
from .labelled import lowest_hashes

LEAST_COSINE = 0.9
#: vectors that centres are fitted on, at most; vertices of a unit, about; centres a vector goes to
SAMPLE, UNIT, OVERLAP = 8192, 1200, 4
#: of the rows whose id is divisible by EVERY, at most AUDIT are compared with all rows to audit recall
EVERY, AUDIT = 100, 2000
#: pruned degree, its slack, candidates per vertex, width of the search, slack of the range
DEGREE, ALPHA, CANDIDATES, BEAM, SLACK = 20, 1.2, 48, 16, 0.05
#: most (query, neighbour) pairs that a step of the expansion may hold
_PAIRS = 1_500_000


def _usable(column: str) -> object:
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(column).isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda x: x != 0)


def _unit_rows(values) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in values])
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _centres(sample: np.ndarray, k: int, rounds: int = 4) -> np.ndarray:
    """Spherical k-means on the sample, from its first rows."""
    centres = sample[:k].copy()
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, own, sample)
        size = np.sqrt((total * total).sum(1))
        centres[size > 1e-12] = total[size > 1e-12] / size[size > 1e-12, None]
    return centres


def _pruned(x: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each row: robust pruning of its nearest candidates, and the reverse edges."""
    n = len(x)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    c = min(CANDIDATES, n - 1)
    if c < 1:
        return [np.zeros(0, np.int64)] * n
    near = np.argpartition(-s, c - 1, 1)[:, :c]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), 1, kind="stable"), 1)
    far = 1 - np.take_along_axis(s, near, 1)
    alive, rows, edges = np.ones(near.shape, bool), np.arange(n), []
    for _ in range(DEGREE):
        at = alive.argmax(1)
        some = alive[rows, at]
        picked = near[rows, at]
        edges.append(np.stack([rows[some], picked[some]], 1))
        alive[rows, at] = False
        alive &= ~((ALPHA * (1 - s[picked[:, None], near]) <= far) & some[:, None])
    pairs = np.concatenate(edges)
    pairs = np.unique(np.concatenate([pairs, pairs[:, ::-1]]), axis=0)
    return np.split(pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(1, n)))


def _in_range(x: np.ndarray, neighbours: list[np.ndarray], least: float, queries: np.ndarray, medoid: int):
    """Yields (queries, vertices) arrays of the pairs in range that the search finds."""
    n, width = len(x), max([1, *map(len, neighbours)])
    table = np.full((n, width), -1, np.int64)
    for i, own in enumerate(neighbours):
        table[i, : len(own)] = own
    size = max(1, min(256, _PAIRS // (n * width)))
    for lo in range(0, len(queries), size):
        block = queries[lo : lo + size]
        q, rows = x[block], np.arange(len(block))
        seen = np.zeros((len(block), n), bool)
        beam = np.stack([np.full(len(block), medoid), block], 1)
        sims = np.einsum("qd,qbd->qb", q, x[beam])
        sims[beam[:, 0] == beam[:, 1], 0] = -np.inf
        done = np.zeros(beam.shape, bool)
        seen[rows[:, None], beam] = True
        for _ in range(4 * BEAM):
            open_sims = np.where(done, -np.inf, sims)
            at = open_sims.argmax(1)
            going = np.isfinite(open_sims[rows, at])
            if not going.any():
                break
            done[rows, at] = True
            new = np.where(going[:, None], table[beam[rows, at]], -1)
            fresh = (new >= 0) & ~seen[rows[:, None], new]
            seen[rows[:, None].repeat(width, 1)[fresh], new[fresh]] = True
            found = np.full(new.shape, -np.inf)
            a, b = np.nonzero(fresh)
            found[a, b] = np.einsum("pd,pd->p", q[a], x[new[a, b]])
            beam, sims, done = np.hstack([beam, new]), np.hstack([sims, found]), np.hstack([done, np.zeros(new.shape, bool)])
            top = np.argsort(-sims, 1, kind="stable")[:, :BEAM]
            beam, sims, done = (np.take_along_axis(m, top, 1) for m in (beam, sims, done))
        # all that was seen and is near starts the expansion
        a, b = np.nonzero(seen)
        s = np.einsum("pd,pd->p", q[a], x[b])
        a, b, s = a[s >= least - SLACK], b[s >= least - SLACK], s[s >= least - SLACK]
        yield block[a[s >= least]], b[s >= least]
        while len(a):
            next_a, next_b = a.repeat(width), table[b].ravel()
            fresh = next_b >= 0
            next_a, next_b = next_a[fresh], next_b[fresh]
            fresh = ~seen[next_a, next_b]
            both = np.unique(next_a[fresh] * n + next_b[fresh])
            a, b = both // n, both % n
            seen[a, b] = True
            s = np.einsum("pd,pd->p", q[a], x[b])
            a, b, s = a[s >= least - SLACK], b[s >= least - SLACK], s[s >= least - SLACK]
            yield block[a[s >= least]], b[s >= least]


def _forest_roots(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least vertex that each vertex reaches by the links."""
    root = np.arange(n)
    a = np.concatenate([p for p, _ in links]) if links else np.zeros(0, np.int64)
    b = np.concatenate([p for _, p in links]) if links else np.zeros(0, np.int64)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def shard_members(vertices: DataFrame, unit: int = UNIT, overlap: int = OVERLAP, sample: int = SAMPLE) -> DataFrame:
    """(unit, id, embedding, weight, homes): a row for each unit that a vertex is in, made where it is read.

    ``homes`` lists the vertex's (shard, block) pairs.  Centres are fitted on at most ``sample``
    vertices, chosen by a hash of their ids; every vertex is assigned."""
    count = vertices.count()
    drawn = lowest_hashes(vertices, "id", sample, count).select("embedding").toPandas()["embedding"]
    k = max(1, min(len(drawn), -(-count * overlap // (unit // 2))))
    centres = vertices.sparkSession.sparkContext.broadcast(_centres(_unit_rows(drawn), k))
    most = min(overlap, k)

    def assign(parts):
        for part in parts:
            if len(part):
                near = np.argpartition(-(_unit_rows(part["embedding"]) @ centres.value.T), most - 1, 1)[:, :most]
                yield part[["id", "embedding", "weight"]].assign(shards=list(np.sort(near, 1).astype(np.int32)))

    kind = dict(vertices.dtypes)["embedding"]
    placed, _ = staged(vertices.mapInPandas(assign, f"id bigint, embedding {kind}, weight bigint, shards array<int>"), "shards")
    # as many rows as there are centres
    counts = placed.select(F.explode("shards").alias("shard")).groupBy("shard").count().collect()
    # a shard of up to two blocks is one unit
    blocks = vertices.sparkSession.sparkContext.broadcast({r["shard"]: n if (n := -(-r["count"] // (unit // 2))) > 2 else 1 for r in counts})

    def spread(parts):
        for part in parts:
            out = []
            for i, vector, weight, shards in part.itertuples(index=False):
                homes = [{"shard": int(h), "block": _block(i, int(h), blocks.value[h]), "blocks": blocks.value[h]} for h in shards]
                for h in homes:
                    for other in range(h["blocks"]):
                        if h["blocks"] == 1 or other != h["block"]:
                            out.append((_unit(h["shard"], h["block"], other), i, vector, weight, homes))
                            if len(out) == 5000:
                                yield pd.DataFrame(out, columns=_MEMBER)
                                out = []
            if out:
                yield pd.DataFrame(out, columns=_MEMBER)

    return placed.mapInPandas(spread, f"unit string, id bigint, embedding {kind}, weight bigint, homes array<struct<shard:int,block:int,blocks:int>>")


_MEMBER = ["unit", "id", "embedding", "weight", "homes"]


def _block(i: int, shard: int, blocks: int) -> int:
    """The block of a vertex in a shard, by a mix of both numbers."""
    x = (i * 0x9E3779B97F4A7C15 ^ shard * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ x >> 29) * 0xBF58476D1CE4E5B9 >> 32 & 0xFFFFFFFF) % blocks


def _unit(shard: int, a: int, b: int) -> str:
    return f"{shard}/{min(a, b)}/{max(a, b)}"


def _owner(homes: list[dict[int, tuple[int, int]]], a: np.ndarray, b: np.ndarray) -> list[str]:
    """The unit in which each pair counts: in the least shard that both are in, the unit of their blocks."""
    out = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        shard = min(homes[i].keys() & homes[j].keys())
        x, blocks = homes[i][shard]
        y = homes[j][shard][0]
        if x == y and blocks > 1:
            y = (x + 1) % blocks
        out.append(_unit(shard, x, y))
    return out


def search_units(members: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(id, links, root): links counted in one unit, weighted, and a vertex that they reach."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        lists = _pruned(_unit_rows(part["embedding"]))
        ids = part["id"].to_numpy()
        return pd.DataFrame({"id": ids, "unit": part["unit"].iloc[0], "near": [ids[own] for own in lists]})

    graph, _ = staged(members.groupBy("unit").applyInPandas(build, "id bigint, unit string, near array<bigint>"), "graph")
    # lists are united by vertex and go back to each of its units; vectors stay where they are
    united = graph.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.collect_list("unit").alias("units"))
    lists = united.select("id", "near", F.explode("units").alias("unit"))

    def search(part: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", ignore_index=True)
        ids, unit = part["id"].to_numpy(), part["unit"].iloc[0]
        x, weight = _unit_rows(part["embedding"]), part["weight"].to_numpy()
        homes = [{h["shard"]: (h["block"], h["blocks"]) for h in own} for own in part["homes"]]
        neighbours = []
        for near in own.sort_values("id")["near"]:
            at = np.searchsorted(ids, near)
            at = at[at < len(ids)]
            neighbours.append(at[np.isin(ids[at], near)] if len(at) else at)
        medoid = int((x @ x.sum(0)).argmax())
        links, count = [], np.zeros(len(ids), np.int64)
        single = [len(h) == 1 and next(iter(h.values()))[1] == 1 for h in homes]
        for a, b in _in_range(x, neighbours, least, np.arange(len(ids)), medoid):
            a, b = a[a != b], b[a != b]
            if not len(a):
                continue
            mine = np.ones(len(a), bool) if all(single) else np.array([u == unit for u in _owner(homes, a, b)], bool)
            np.add.at(count, a[mine], weight[b[mine]])
            links.append((a, b))
        return pd.DataFrame({"id": ids, "links": count, "root": ids[_forest_roots(len(ids), links)]})

    return members.groupBy("unit").cogroup(lists.groupBy("unit")).applyInPandas(search, "id bigint, links bigint, root bigint")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST_COSINE, unit: int = UNIT, overlap: int = OVERLAP) -> DataFrame:
    """One row per row: id, links (other rows within the cosine), component (least id reachable).

    Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing, and
    so do rows with a null id (their component is null) and, with each other, vectors of
    different lengths.  Repeated rows are vectors of their own and link.  Other columns are ignored.
    The graph is searched, so links may be missed (see ``recall``); none below ``least`` is made.
    """
    # numbers stay as they come, and are computed with in double precision
    kind = dict(vectors.dtypes)[vector_col]
    numbers = F.col(vector_col) if kind in ("array<float>", "array<double>") else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), numbers.alias("embedding"))
    good = rows.where(F.col("id").isNotNull() & _usable("embedding")).withColumns({"k1": F.xxhash64("embedding"), "k2": F.xxhash64(F.lit(1), "embedding")})
    grouped, _ = staged(good.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("weight"), F.first("embedding").alias("embedding")), "vertices")
    results = []
    for (length,) in grouped.select(F.size("embedding")).distinct().collect():
        vertices = grouped.where(F.size("embedding") == length).select("id", "embedding", "weight")
        results.append(search_units(shard_members(vertices, unit, overlap), least))
    empty = rows.sparkSession.createDataFrame([], "id bigint, links bigint, root bigint")
    found = empty
    for part in results:
        found = found.unionByName(part)
    found, _ = staged(found, "found")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked, _ = connected_components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    by_class = grouped.select("k1", "k2", "id", "weight").join(counts, "id", "left").join(linked.withColumnRenamed("node", "id"), "id", "left")
    answer, _ = staged(by_class.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "id").alias("component")), "answer")
    with_keys = good.select("id", "k1", "k2").unionByName(rows.where(~F.coalesce(F.col("id").isNotNull() & _usable("embedding"), F.lit(False))).select("id", F.lit(None).cast("bigint").alias("k1"), F.lit(None).cast("bigint").alias("k2")))
    return with_keys.join(answer, ["k1", "k2"], "left").select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"), F.coalesce("component", "id").alias("component"))


def vector_report(vectors: DataFrame) -> DataFrame:
    """The query's columns, and the audited recall of the whole result in each row."""
    found, _ = staged(near_vectors(vectors), "near")
    return found.select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"), (F.col("vec_id") == F.col("component")).alias("kept"), F.lit(recall(vectors, found)).alias("recall"))


def recall(vectors: DataFrame, found: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST_COSINE, every: int = EVERY, most: int = AUDIT) -> float:
    """Audit: links found over links there, of the rows whose id is divisible by ``every``; if those are
    more than ``most``, of the ones with the least id hashes.

    The queries, bounded by ``most``, go to the tasks that hold the rows and are compared with all
    rows of their length by brute force.  Without a link to find it is 1.0."""
    rows = vectors.where(F.col(id_col).isNotNull() & _usable(vector_col)).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    queries = rows.where(F.col("id") % every == 0)
    own = lowest_hashes(queries, "id", most, queries.count()).toPandas()
    known = rows.sparkSession.sparkContext.broadcast([(n, _unit_rows(part["v"]), part["id"].to_numpy()) for n, part in own.groupby(own["v"].map(len))] if len(own) else [])

    def count(parts):
        for part in parts:
            size = part["v"].map(len)
            for n, q, ids in known.value:
                rest = part[size == n]
                for lo in range(0, len(rest), 2000):
                    some = rest.iloc[lo : lo + 2000]
                    near = _unit_rows(some["v"]) @ q.T >= least
                    yield pd.DataFrame({"id": ids, "n": near.sum(0)})

    there = rows.mapInPandas(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    # a query's own row is no link, and repeated ids are queries of their own
    pairs = there.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] - len(own)
    asked = rows.sparkSession.createDataFrame([(int(i),) for i in dict.fromkeys(own["id"].tolist())], "id bigint")
    got = found.select(F.col(id_col).alias("id"), "links").join(F.broadcast(asked), "id").agg(F.coalesce(F.sum("links"), F.lit(0))).first()[0]
    return got / pairs if pairs else 1.0
