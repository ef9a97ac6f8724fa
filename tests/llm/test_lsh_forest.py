import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import lsh_forest as A


def brute(rows, asked, k=10):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], float)
    out = {}
    for q in asked:
        away = np.sqrt(((points - points[ids == q][0]) ** 2).sum(axis=1))
        other = ids != q
        order = np.lexsort((ids[other], away[other]))[:k]
        out[q] = list(zip(ids[other][order].tolist(), away[other][order].tolist()))
    return out


def test_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    got = {}
    for r in A.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(want)
    points = dict(rows)
    hits = 0
    for q, ranks in got.items():
        assert sorted(ranks) == list(range(1, 11))
        hits += len({v for v, _ in ranks.values()} & {v for v, _ in want[q]})
        scores = [(ranks[i][1], ranks[i][0]) for i in range(1, 11)]
        assert scores == sorted(scores)
        for s, v in scores:
            assert s == pytest.approx(float(np.linalg.norm(np.array(points[v], float) - np.array(points[q], float))), abs=1e-12)
    assert hits >= 0.9 * 10 * len(want)


def test_clustered_vectors_need_few_candidates(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 32))
    points = centres[rng.integers(0, 40, 2000)] + 0.05 * rng.standard_normal((2000, 32))
    rows = [(i, points[i].tolist()) for i in range(2000)]
    want = brute(rows, range(0, 2000, 100))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = A.search(df, F.col("vec_id") % 100 == 0, share=0.03, shard_rows=700, block_queries=8).collect()
    assert sum(r["vec_id"] in {v for v, _ in want[r["query_id"]]} for r in got) >= 0.9 * 200


def test_prefix_ranges_and_ascent():
    rng = np.random.default_rng(0)
    forest = A.Forest(rng.standard_normal((300, 8)), 5, 1)
    queries = rng.standard_normal((20, 8))
    codes, own = forest.codes(queries), forest.codes(forest.rows)
    for q, rows in forest.candidates(queries, 60):
        same = 64 - np.array([[int(x).bit_length() for x in r] for r in codes[q] ^ own])
        best = max(d for d in range(65) if (same >= d).any(axis=1).sum() >= 60)
        assert set(rows.tolist()) == set(np.flatnonzero((same >= best).any(axis=1)).tolist())


def test_one_vector_held_by_a_third_of_all_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, ([1.0, 0.0, 0.0] if i % 3 == 0 else rng.standard_normal(3).tolist())) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in A.search(df, F.col("vec_id") == 300, share=0.1).collect())
    assert got == [(i + 1, 3 * i, 0.0) for i in range(10)]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [0.0, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (200, [0.0, 0.0]), (7, [0.0, 1.0]), (300, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("label", F.lit(2))
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in A.search(df, F.col("vec_id") % 100 == 0).collect())
    assert got == [(0, 1, 100), (0, 2, 7), (0, 3, 7), (100, 1, 0), (100, 2, 7), (100, 3, 7)]
    assert A.search(df.where("false"), F.col("vec_id") == 0).count() == 0
