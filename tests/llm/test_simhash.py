from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from schoolyard.llm import simhash
from schoolyard.llm.components import components
from schoolyard.llm.simhash import fingerprint, fingerprint_groups, fingerprint_links, forest, near_duplicates


def plain_fingerprint(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) > 0)


def roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def close(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1") <= 4


def planted(rng, bases=12, per_base=25, steps=3):
    """Chains of fingerprints, some steps just within and some just beyond four bits."""
    found = set()
    for _ in range(bases):
        at = rng.getrandbits(64)
        for _ in range(per_base):
            found.add(at)
            for bit in rng.sample(range(64), rng.randint(1, steps + 3)):
                at ^= 1 << bit
    return found


@pytest.mark.parametrize("text", [None, "", " \n", "One", "A b C", "a b c d e", "É x y\tz\x0bw q " * 40])
def test_fingerprint_matches_the_definition(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_long_text_is_counted_in_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    text = " ".join(str(i * i % 97) for i in range(500))
    assert fingerprint(text) == plain_fingerprint(text)


def test_forest_connects_as_all_links_do():
    rng = random.Random(3)
    fps = sorted(planted(rng, 3, 60))
    found = forest(np.array(fps, np.uint64), 4)
    assert len(found) < len(fps)
    pairs = {(fps[i], fps[j]) for i, j in found}
    assert all(close(a, b) for a, b in pairs)
    assert roots(fps, lambda a, b: (a, b) in pairs or (b, a) in pairs) == roots(fps, close)


@pytest.mark.parametrize("dense", [20_000, 3])
def test_links_reach_what_brute_force_reaches(spark, dense):
    fps = planted(random.Random(5))
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    rows = fingerprint_links(spark.createDataFrame(signed, "fp long"), 4, dense).collect()
    pairs = {(r.a % 2**64, r.b % 2**64) for r in rows}
    assert all(close(a, b) for a, b in pairs)
    expected = roots(sorted(fps), close)
    assert roots(sorted(fps), lambda a, b: (a, b) in pairs or (b, a) in pairs) == expected


def test_components_of_a_path_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    links += [(200, 201), (201, 202), (202, 200), (300, 300), (None, 7), (8, None)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == (
        {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in (200, 201, 202)}
    )
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w17 ", "v17 ")
    texts = [(5, base), (3, near), (9, base), (9, base), (4, None), (7, ""), (8, " "), (None, base), (6, "other words")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, FP string, component_id int")
    rows = near_duplicates(docs).collect()
    prints = {t: plain_fingerprint(t) for _, t in texts}
    ids = {}
    groups = roots(sorted(set(prints.values())), close)
    for i, t in texts:
        if i is not None:
            ids[groups[prints[t]]] = min(i, ids.get(groups[prints[t]], i))
    expected = sorted((str(i), f"{prints[t]:016x}", ids[groups[prints[t]]]) for i, t in texts)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == expected
    assert near_duplicates(docs.filter(F.lit(False))).count() == 0


def test_groups_write_few_files(spark, monkeypatch):
    """What comes out of shuffles is written by two tasks a core, however many partitions it has."""
    prints = spark.createDataFrame([(i, 1 << i % 40) for i in range(80)], "doc_id long, fp long")
    written, checkpoint = [], type(prints).checkpoint

    def counted(df):
        written.append(df.rdd.getNumPartitions())
        return checkpoint(df)

    monkeypatch.setattr(type(prints), "checkpoint", counted)
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        rows = fingerprint_groups(prints).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r.print, r.root, r.least) for r in rows} == {(1 << i, 1, i) for i in range(40)}
    assert len(written) > 3
    assert max(written) <= 2 * spark.sparkContext.defaultParallelism < 64
