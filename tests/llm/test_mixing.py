from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from schoolyard.llm.mixing import copies, mix


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Reshares the excess round by round."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = [s for s in rest if share[s] > most * sizes[s]]
        if not above:
            return full | share
        full |= {s: most * sizes[s] for s in above}


def corpus(seed=1, n=1500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "B", "é", None, "z"])
        rows.append((i, " ".join(["w"] * int(rng.lognormvariate(3, 1.2))), source))
    rows += [(n, None, "a"), (n + 1, " \t\x0b", "empty"), (None, "no id here", "a")]
    rows += [(7_000_000, "the same row again", "B")] * 40 + [(n + 2, "long " * 3000, "a")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_mix_comes_near_its_targets(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = copies(docs, chunk=20).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    expected = plain_targets(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert 0 <= r.copies <= 3
        each = expected[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert int(each) <= r.copies <= int(each) + (each != int(each))
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for source in sizes:  # all but the rounding of one document is settled exactly
        assert abs(taken[source] - expected[source]) < largest[source] + 1e-6
    for source in ("hot", "a", "B", "é", None, "z"):  # and it is not a large one
        assert abs(taken[source] - expected[source]) < 0.03 * expected[source]


def test_reruns_agree_however_partitioned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = sorted(map(str, copies(docs, chunk=30).collect()))
    assert sorted(map(str, copies(docs.repartition(7), chunk=30).collect())) == one
    assert sorted(map(str, copies(docs.orderBy("text"), chunk=30, seed=8).collect())) != one


def test_expected_copies_are_kept(spark):
    """A document of any size is taken as often as it is due, on average over like sources."""
    sizes = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89]
    rows = [
        (100 * source + i, "w " * n, f"{source:03}") for source in range(180) for i, n in enumerate(sizes)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    total, due = Counter(), {}
    for r in copies(docs, chunk=5).collect():
        group = int(r.source) % 3  # sources of one weight
        total[group, r.size] += r.copies
        due[group] = r.target / r.source_size
    for (group, _), n in total.items():
        assert n / 60 == pytest.approx(due[group], abs=0.25)


def test_mixed_documents_keep_their_columns(spark, rows):
    docs = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "doc_id long, text string, source string, size int, mix_size string")
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    by_id = Counter()
    for r in copies(docs).collect():
        by_id[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: v for k, v in by_id.items() if v})
    assert mix(docs.limit(0)).count() == 0


def test_sources_that_hold_nothing(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.copies) for r in copies(docs).collect()] == [(0, 0.0, 0)] * 2
