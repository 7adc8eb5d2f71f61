import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscan.llm import nn_descent as nn
from shelfscan.llm.op12_query import QUERIES

SCHEMA = "vec_id long, embedding array<double>, node string, query int, vector string, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None, "n", 1, "v", 0) for i, v in rows], SCHEMA)


def exact(rows, k, asked=lambda i: True):
    """The k nearest of every query, ties to the smaller id."""
    ids = np.array([i for i, _ in rows])
    units = np.array([v for _, v in rows], dtype=float)
    units /= np.linalg.norm(units, axis=1)[:, None]
    out = {}
    for i, v in zip(ids.tolist(), units, strict=True):
        if asked(i):
            score = np.round(units @ v, 12)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = ids[order].tolist()
    return out


def answers(df):
    out = {}
    for r in df.sort("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    for found in out.values():
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert all(a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in zip(found, found[1:]))  # noqa: B905
    return {q: [f[1] for f in found] for q, found in out.items()}


def recall(got, wanted):
    return np.mean([len(set(got[q]) & set(w)) / len(w) for q, w in wanted.items()])


def test_recall_on_random_and_clustered_vectors(spark):
    rng = np.random.default_rng(5)
    loose = rng.standard_normal((2000, 24))
    centres = rng.standard_normal((10, 24))
    tight = centres[rng.integers(0, 10, 1500)] + 0.05 * rng.standard_normal((1500, 24))
    rows = list(enumerate(np.concatenate([loose, tight])))
    asked = lambda i: i % 50 == 0
    got = answers(nn.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0))
    wanted = exact(rows, 5, asked)
    assert set(got) == set(wanted) and recall(got, wanted) >= 0.95


def test_copies_cost_nothing_and_ties_go_to_small_ids(spark):
    rng = np.random.default_rng(6)
    common = rng.standard_normal(8)
    rows = [(i, common if i % 3 == 0 else rng.standard_normal(8)) for i in range(900)]
    df = frame(spark, rows)
    kept = nn.usable(df, "vec_id", "embedding")
    assert nn.nodes_of(kept).count() == 601
    got = answers(nn.nearest(df, F.col("vec_id") % 50 == 0, k=7))
    wanted = exact(rows, 7, lambda i: i % 50 == 0)
    assert got[150] == [0, 3, 6, 9, 12, 15, 18] and got[0] == [3, 6, 9, 12, 15, 18, 21]
    assert recall(got, wanted) >= 0.95


def test_rows_that_take_no_part(spark):
    rows = [
        (1, [1, 0]), (2, [0.9, 0.1]), (3, [0, 1]), (4, [0, 0]), (5, None), (6, [math.nan, 1]), (7, [math.inf, 1]), (None, [1, 0]),
        (8, [1, 2, 3]), (9, []), (1, [1, 0]), (10, [-1, 0]), (11, [1e-200, 1e-200]), (12, [1e200, 1e199]),
    ]
    df = frame(spark, rows).unionByName(
        spark.createDataFrame([(13, [None, 1.0], "n", 1, "v", 0)], SCHEMA)
    )
    got = answers(nn.nearest(df))
    assert set(got) == {1, 2, 3, 10, 11, 12}
    assert got[1] == [12, 2, 11, 3, 10] and got[3] == [11, 2, 12, 1, 10]
    scores = {r["id"]: r["score"] for r in nn.nearest(df, F.col("vec_id") == 1).collect()}
    assert scores == {2: pytest.approx(0.9 / math.hypot(0.9, 0.1)), 3: 0.0, 10: -1.0, 11: pytest.approx(math.sqrt(0.5)), 12: pytest.approx(1 / math.hypot(1, 0.1))}


def test_few_rows_and_none(spark, folder):
    assert answers(nn.nearest(frame(spark, [(5, [1, 2])]))) == {}
    twice = nn.nearest(frame(spark, [(5, [1, 2]), (6, [1, 2]), (6, [2, 1])])).collect()
    assert sorted((r["query_id"], r["rank"], r["id"]) for r in twice) == [(5, 1, 6), (5, 2, 6), (6, 1, 5), (6, 1, 5)]
    assert answers(nn.nearest(frame(spark, [(5, [1, 2]), (7, [1, 3])]))) == {5: [7], 7: [5]}
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    got = QUERIES["op12_approximate_neighbours"](spark, folder)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0


def test_graph_links_are_symmetric_scores_of_the_best(spark):
    rng = np.random.default_rng(7)
    rows = list(enumerate(rng.standard_normal((600, 6))))
    nodes = nn.nodes_of(nn.usable(frame(spark, rows), "vec_id", "embedding"))
    graph = nn.neighbour_graph(nodes, k=10, forests=2, block=64)
    of = {r["node"]: r["id"] for r in nodes.collect()}
    wanted = exact(rows, 10)
    found = {of[r["node"]]: [of[w] for w in r["ws"]] for r in graph.collect()}
    assert all(len(set(ws)) == 10 and i not in ws for i, ws in found.items())
    assert recall(found, wanted) >= 0.9


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = answers(QUERIES["op12_approximate_neighbours"](spark, folder).withColumnRenamed("vec_id", "id"))
    wanted = exact(rows, 5, lambda i: i % 50 == 0)
    assert set(got) == set(wanted) and recall(got, wanted) >= 0.97
