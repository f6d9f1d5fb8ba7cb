import hashlib
import math
import random
from fractions import Fraction

import numpy as np

from schoolyard.llm.centroids import LONGEST, Lists, clusters, limbs, moved, scaled

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows: list[tuple], k: int, rounds: int, dims: int, seed: int = 3) -> list[tuple]:
    """Lloyd's rounds with Python integers; every distance is made."""
    own = [
        (i, [math.floor(Fraction(x) * 1024) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    hashed = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "~"
    centroids = [v for _, v in sorted(own, key=lambda r: (hashed(r[0]), r[1]))[:k]]

    def assign() -> list[tuple[int, int]]:
        found = []
        for _, v in own:
            away = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            found.append((min(away), away.index(min(away))))
        return found

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), (_, at) in zip(own, found, strict=True) if at == c]
            if members:
                centroids[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = assign()
    total = sum(d for d, _ in found)
    return sorted(
        (
            (
                i, c, min(d, LONGEST), min(sum(min(e, LONGEST) for e, at in found if at == c), LONGEST),
                min(total, LONGEST), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(),
            )
            for (i, _), (d, c) in zip(own, found, strict=True)
        ),
        key=repr,
    )


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def cloud(n: int, dims: int, seed: int) -> list[tuple]:
    draw = random.Random(seed)
    homes = [[draw.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    return [(i, [x + draw.gauss(0, 0.2) for x in draw.choice(homes)]) for i in range(n)]


def test_the_walk_finds_the_nearest_and_may_stop_early():
    draw = np.random.default_rng(1)
    centroids = draw.integers(-40_000, 40_000, (64, 4))
    vectors = centroids[draw.integers(0, 64, 500)] + draw.integers(-50, 50, (500, 4))
    winner, best, made = Lists(centroids).nearest(vectors)
    every = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (winner == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert made < every.size / 4


def test_ties_go_to_the_smaller_number():
    centroids = np.array([[2, 0], [-2, 0], [0, 2], [0, -2], [2, 0]])
    winner, best, _ = Lists(centroids).nearest(np.array([[0, 0], [2, 0], [0, 3]]))
    assert winner.tolist() == [0, 0, 2] and best.tolist() == [4, 0, 1]


def test_clusters_agree_with_the_plain_version(spark):
    rows = cloud(400, 16, 2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(clusters(df, k=8, rounds=10, dims=16)) == plain(rows, 8, 10, 16)


def test_nulls_other_lengths_and_repeats(spark):
    rows = cloud(30, 3, 4)
    rows += [rows[0], rows[0], (rows[1][0], [0.5, 0.5, 0.5]), (None, [9.0, 9.0, 9.0])]
    odd = [(90, None), (91, []), (92, [1.0]), (93, [1.0, None, 2.0]), (94, [float("nan"), 0.0, 0.0]),
           (95, [float("inf"), 0.0, 0.0]), (96, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "'x' AS cluster", "1 AS v", "2 AS distance")
    assert got(clusters(df, k=4, rounds=3, dims=3)) == plain(rows, 4, 3, 3)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.0, 1.0]), (2, [3.0, 4.0]), (2, [3.0, 4.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(clusters(df, k=8, rounds=2, dims=2)) == plain(rows, 8, 2, 2)
    assert clusters(df.limit(0), k=8, rounds=2, dims=2).collect() == []


def test_very_large_components_stay_exact(spark):
    rows = [(i, [1.7e308 * (-1) ** i, 2.0**60 + i, 0.1]) for i in range(6)] + [(9, [0.0, 5.0, 1e-300])]
    df = spark.createDataFrame(rows, SCHEMA)
    result = got(clusters(df, k=3, rounds=2, dims=3))
    assert result == plain(rows, 3, 2, 3)


def test_limbs_give_the_sum_back():
    for total in (0, 5, -5, 1 << 30, -(1 << 31) - 7, scaled(1.7e308), -scaled(1.7e308)):
        rows = [(0, 0, i, part) for i, part in enumerate(limbs(total))] + [(0, -1, 0, 1)]
        assert moved([[99]], rows) == [[total]]


def test_one_cluster_with_nearly_all_vectors(spark):
    rows = [(i, [0.001 * (i % 3), 0.0]) for i in range(500)] + [(1000, [5.0, 5.0])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert got(clusters(df, k=2, rounds=5, dims=2)) == plain(rows, 2, 5, 2)
