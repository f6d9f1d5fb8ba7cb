from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from schoolyard.llm import topk
from schoolyard.llm.topk import Tree, search, top_k

SCHEMA = "vec_id long, embedding array<float>, rank int, v string"


def brute(rows, k=10, every=100):
    usable = [
        (i, n, [math.floor(1024 * Fraction(x)) for x in v])
        for n, (i, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for qid, qn, q in usable:
        if qid is None or qid % every:
            continue
        scored = [
            (max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v, strict=True)))), i)
            for i, n, v in usable
            if n != qn and len(v) == len(q)
        ]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(qid, r, i, s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(map(str, out))


def f32(x):
    return float(np.float32(x))


def run(spark, rows, k=10, **more):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(str, (tuple(r) for r in top_k(df, k, **more).collect())))


def test_matches_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [f32(rng.gauss(0, 0.2)) for _ in range(8)]) for i in range(700)]
    rows += [(5000, rows[0][1]), (5001, rows[0][1])] * 3  # repeated rows, one of them a query
    rows += [(5100, [0.5, 0.25]), (5102, [f32(0.1), 1.0]), (5200, [])]  # other lengths
    rows += [(6000, None), (6001, [None] * 8), (6100, [float("nan")] * 8), (6101, [float("inf")] * 8)]
    rows += [(None, rows[3][1]), (None, rows[0][1]), (-100, rows[9][1])]
    assert run(spark, rows, shard=100) == brute(rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 600, 7)] + [(i, [0.0, 0.0]) for i in range(1, 600, 7)]
    assert run(spark, rows, k=5, shard=30) == brute(rows, 5)


def test_large_components_are_exact(spark):
    rows = [(i, [f32(3e18 * (i % 3 - 1)), f32(i), f32(1e12)]) for i in range(0, 300, 10)]
    assert run(spark, rows, k=4) == brute(rows, 4)


def test_the_largest_doubles(spark):
    top = 1.7976931348623157e308
    rows = [(i, [top * (i % 3 - 1), -top, 0.25 * i]) for i in range(0, 400, 25)]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    assert sorted(map(str, (tuple(r) for r in top_k(df, 3, shard=2, cell_sample=2).collect()))) == brute(rows, 3)


def test_queries_go_where_their_kth_score_is_in_reach(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (12, 16))
    near = centres[np.arange(2400) % 12] + rng.normal(0, 0.02, (2400, 16))
    rows = [(i, [f32(x) for x in v]) for i, v in enumerate(near.tolist())]
    sent = []
    route = topk._sent_on

    def counted(queries, kth, sizes, boxes):
        routed = route(queries, kth, sizes, boxes)
        shards = sizes.agg({"shards": "sum"}).first()[0]
        sent.append((routed.count(), queries.count() * (shards - 1), sum(len(b[0]) for b in boxes.values())))
        return routed

    monkeypatch.setattr(topk, "_sent_on", counted)
    assert run(spark, rows, shard=100, every=20) == brute(rows, every=20)
    pairs, all_pairs, cells = sent[0]
    assert cells >= 8 and pairs < all_pairs / 4


def test_cells_hold_every_point():
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(0, 1, (600, 4)), 1)
    points[:300] = points[0]  # ties up to the middle and beyond
    planes = topk.fitted(points[::3], 16)
    cells = topk.cells_of(planes, points)
    assert len(set(cells.tolist())) >= 4 and len(set(cells[:300].tolist())) == 1
    for c in set(cells.tolist()):
        own = points[cells == c]
        scores = np.floor(points * 1024) @ np.floor(own * 1024).T
        most = topk.reach(own.min(axis=0)[None], own.max(axis=0)[None], points)
        assert (scores.max(axis=1) <= most[:, 0]).all()


def test_empty_table_and_no_query(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0]), (2, [2.0])]) == []


@pytest.mark.parametrize("leaf", [1, 7, 256])
def test_boxes_never_hide_a_result(monkeypatch, leaf):
    monkeypatch.setattr(topk, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    points = np.floor(rng.normal(0, 200, (500, 3)))
    tree, ids = Tree(points), np.arange(500) * 3
    for q in range(0, 500, 50):
        scores = points @ points[q]
        order = [i for i in np.lexsort((ids, -scores)).tolist() if i != q][:10]
        found = search(tree, ids, points[q], 10, q, -np.inf)
        assert sorted(found) == sorted((int(scores[i]), i) for i in order)
        kth = int(scores[order[-1]])
        assert sorted(search(tree, ids, points[q], 10, q, kth)) == sorted(found)
