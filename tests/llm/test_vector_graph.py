import numpy as np
from pyspark.sql import functions as F

from tessera.llm import vector_graph as V


def brute(rows):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {}
    for i, (a, x) in enumerate(good):
        for j, (b, y) in enumerate(good):
            if i != j and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                links.setdefault(i, []).append(j)
    root = list(range(len(good)))
    for _ in good:
        for i, js in links.items():
            for j in js:
                root[i] = root[j] = min(root[i], root[j], key=lambda k: (good[k][0], k))
    return sorted((good[i][0], len(links.get(i, [])), good[root[i]][0]) for i in range(len(good)))


def vectors(n, seed, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dims))
    rows = [(i, (centres[rng.integers(len(centres))] + 0.12 * rng.normal(size=dims) * (i % 3)).astype(np.float32).tolist()) for i in range(n)]
    return rows + [(n + i, (centres[0] + 0.05 * rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(n // 3)]


def test_links_and_components(spark):
    rows = vectors(400, 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("weight", F.lit("x"))
    # small units: many shards, and a hot one that is cut into blocks
    got = sorted(map(tuple, V.near_vectors(df, unit=60, overlap=8).collect()))
    expected = brute(rows)
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in expected)
    assert all(g[1] <= e[1] for g, e in zip(got, expected, strict=True))
    assert np.mean([g[2] == e[2] for g, e in zip(got, expected, strict=True)]) >= 0.95
    assert V.recall(df, V.near_vectors(df, unit=60), every=10) >= 0.9


def test_one_unit_misses_nothing(spark):
    rows = vectors(300, 2)
    got = sorted(map(tuple, V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()))
    assert got == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (10, [0.0, 1.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (11, [1e30, 0.0])]
    got = sorted(map(tuple, V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=str)
    assert got == sorted([(1, 3, 1), (1, 3, 1), (2, 3, 1), (11, 3, 1), *((i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10)), (None, 0, None)], key=str)


def test_empty(spark):
    assert V.vector_report(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_pruned_graph_reaches_every_vertex():
    x = np.random.default_rng(3).normal(size=(300, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = V._pruned(x)
    seen, todo = {0}, [0]
    while todo:
        for j in lists[todo.pop()].tolist():
            if j not in seen:
                seen.add(j)
                todo.append(j)
    assert len(seen) == 300
