import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import pivot_codes as P
from palimpsest.llm.queries import QUERIES


def plain_codes(rows, parts=4, size=256, rounds=4):
    """From the contract, with Python's integers: rows (vec_id, vector, label) -> rows and digest."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: r[0])
    width = len(kept[0][1]) // parts
    whole = np.array([[math.floor(1024 * float(x)) for x in r[1]] for r in kept]).reshape(len(kept), parts, width)
    books = [whole[:size, p].copy() for p in range(parts)]

    def assign(p):
        away = np.array([((books[p] - x) ** 2).sum(axis=1) for x in whole[:, p]])
        code = away.argmin(axis=1)
        return code, away[np.arange(len(code)), code]

    for _ in range(rounds):
        for p in range(parts):
            code, _ = assign(p)
            for e in range(len(books[p])):
                of = whole[code == e, p]
                if len(of):
                    books[p][e] = of.sum(axis=0) // len(of)
    found = [assign(p) for p in range(parts)]
    errors = sum(x[1] for x in found)
    labels = {}
    for r, e in zip(kept, errors):
        labels[r[2]] = labels.get(r[2], 0) + int(e)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e.tolist()).encode()).hexdigest()
    return sorted((r[0], "".join(f"{found[p][0][i]:02x}" for p in range(parts)), int(errors[i]), labels[r[2]], digest) for i, r in enumerate(kept))


def coded(spark, rows, **given):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int") if isinstance(rows, list) else rows
    out, books = P.encode(df, **given)
    out = P.with_label_error(out.cache())
    return sorted((r["vec_id"], "".join(f"{c:02x}" for c in r["codes"]), r["error"], r["label_error"], books.digest()) for r in out.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_equals_brute_force(spark, sf):
    got = QUERIES["op12_pivot_codes"][0](spark, f"/root/testdata/{sf}")
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    assert sorted(map(tuple, got.collect())) == plain_codes([(r["vec_id"], r["embedding"], r["label"]) for r in table])


def test_ties_repeats_and_clusters(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(-4, 5, (12, 8)) / 4
    rows = [(i, (centres[i % 12] + rng.integers(-1, 2, 8) / 1024).tolist(), None if i % 3 == 0 else i % 2) for i in range(900)]
    rows += [(1000 + i, [0.5] * 8, 7) for i in range(500)]  # one vector on a third of all rows
    assert coded(spark, rows, entries=16) == plain_codes(rows, size=16)
    assert coded(spark, rows[:10], entries=16) == plain_codes(rows[:10], size=16)


def test_nearest_is_exact_and_prefers_lower_numbers():
    rng = np.random.default_rng(1)
    for scale in (3, 1000, 130_000_000):
        entries = rng.integers(-scale, scale + 1, (256, 4))
        entries[100] = entries[7]
        points = np.concatenate([rng.integers(-scale, scale + 1, (500, 4)), entries])
        pivots = P.choose_pivots(entries, 8)
        code, away = P.nearest(points, P.distances(points, pivots).astype(np.float32), entries, P.distances(entries, pivots))
        every = np.array([((entries - x) ** 2).sum(axis=1) for x in points])
        assert (code == every.argmin(axis=1)).all() and (away == every.min(axis=1)).all()


def test_pruning_leaves_most_entries_of_clusters_out(monkeypatch):
    """What is computed exactly is a small share where the vectors have structure."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-100_000, 100_000, (256, 16))
    points = np.repeat(centres, 8, axis=0) + rng.integers(-50, 50, (2048, 16))
    pivots = P.choose_pivots(centres, 8)
    met = []
    real = np.einsum
    monkeypatch.setattr(P.np, "einsum", lambda s, a, b: met.append(len(a)) or real(s, a, b))
    P.nearest(points, P.distances(points, pivots).astype(np.float32), centres, P.distances(centres, pivots))
    assert sum(met) < 0.05 * len(points) * 256


def test_odd_rows(spark):
    rows = [(None, [1.0] * 8, 1), (1, None, 1), (2, [float("nan")] + [0.0] * 7, 1), (3, [float("inf")] * 8, 1), (4, [1.0, None] * 4, 1), (5, [0.0] * 8, None),
            (6, [], 1), (7, [1.0] * 7, 1), (8, [-0.0001] * 8, None), (8, [-0.0001] * 8, None), (9, [1e30] * 8, 2), (10, [-1e30] * 8, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("codes", F.lit("x")).withColumn("n", F.lit(1)).withColumn("of", F.lit(2))
    got, books = P.encode(df)
    ids = sorted(str(r["vec_id"]) for r in got.collect())
    assert ids == sorted(["None", "5", "8", "8", "9", "10"])
    assert books.entries.max() == P.LARGEST * 1024 and (books.entries[:, 1] == [-1, -1]).all()
    sums = {(r["label"], r["label_error"]) for r in P.with_label_error(got).collect()}
    assert len(sums) == 3
    nothing, none = P.encode(spark.createDataFrame([], "vec_id long, embedding array<double>, label int"))
    assert nothing.count() == 0 and none is None and P.with_label_error(nothing).count() == 0
    # a length that the parts do not divide: zeros fill it up
    assert len(coded(spark, [(i, [0.1 * i] * 7, 1) for i in range(5)], entries=3)) == 5
