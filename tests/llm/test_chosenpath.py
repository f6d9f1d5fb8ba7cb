import itertools
import random

import numpy as np
import pytest

from schoolyard.llm import chosenpath
from schoolyard.llm.chosenpath import Sets, near_duplicates, set_links, shingle_hashes

SCHEMA = "doc_id long, text string"


def shingles(text: str | None, width: int = 2) -> frozenset:
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = words.replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    width = min(width, len(words)) if words else width
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else frozenset()


def plain(rows: list[tuple], width: int = 2, percent: int = 80) -> list[tuple]:
    """All pairs of distinct sets, and components by repeated merging."""
    sets = [shingles(t, width) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=sorted)
    group = {s: i for i, s in enumerate(distinct)}
    for a, b in itertools.combinations(distinct, 2):
        if group[a] != group[b] and 100 * len(a & b) >= percent * len(a | b):
            old, new = group[a], group[b]
            group = {s: new if g == old else g for s, g in group.items()}
    least: dict = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[group[s]] = min(i, least.get(group[s], i))
    out = []
    for (i, _), s in zip(rows, sets, strict=True):
        component = least.get(group[s]) if s else i
        out.append((i, len(s), component, i is not None and i == component))
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def edited(words: list[str], edits: int, draw: random.Random) -> list[str]:
    out = list(words)
    for at in draw.sample(range(len(out)), edits):
        out[at] = f"z{draw.randrange(10**6)}"
    return out


def family(n: int, length: int, edits: int, seed: int) -> list[str]:
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**4)}" for _ in range(length)]
    return [" ".join(edited(base, edits, draw)) for _ in range(n)]


def test_shingles_are_those_of_the_whole_text():
    for text in ("a b c a b", "One", "AÄ b\x0bc\td\r\n e", "", None, " \n", "x y " * 5000):
        assert len(shingle_hashes(text)) == len(shingles(text))
    assert (shingle_hashes("A b C") == shingle_hashes("a B  c")).all()


def test_components_agree_with_all_pairs(spark):
    texts = [t for s in range(12) for t in family(8, 60, s % 6, s)]
    draw = random.Random(7)
    texts += [" ".join(f"q{draw.randrange(300)}" for _ in range(50)) for _ in range(60)]
    rows = list(enumerate(texts, start=5))
    assert got(near_duplicates(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


@pytest.mark.parametrize("leaf", [2, 6])
def test_large_nodes_are_settled_by_pivots(spark, leaf):
    """With leaves this small nearly everything goes through pivots and further levels."""
    texts = family(60, 80, 1, 1) + family(40, 80, 4, 2) + family(12, 40, 2, 3)
    sets = Sets(spark.createDataFrame(list(enumerate(texts)), SCHEMA), 2, "doc_id", "text")
    from schoolyard.llm.components import components

    roots = {r["node"]: r["root"] for r in components(set_links(sets, leaf=leaf)).collect()}
    of_doc = {r["owner"]["doc_id"]: roots.get(r["id"], r["id"]) for r in sets.distinct.collect()}
    expected = {r[0]: r[2] for r in plain(list(enumerate(texts)))}
    kept = {r[0]: r[2] for r in plain(list(enumerate(texts)))}
    assert len(set(of_doc.values())) == len({kept[i] for i in of_doc})
    for a, b in itertools.combinations(sorted(of_doc), 2):
        assert (of_doc[a] == of_doc[b]) == (expected[a] == expected[b])


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs of similarity 0.80 to 0.84, each in a component of its own."""
    draw, rows, pairs = random.Random(9), [], 0
    while pairs < 200:
        base = [f"v{draw.randrange(10**6)}" for _ in range(70)]
        other = edited(base, 4, draw)
        a, b = shingles(" ".join(base)), shingles(" ".join(other))
        if 0.80 <= len(a & b) / len(a | b) < 0.84:
            rows += [(2 * pairs, " ".join(base)), (2 * pairs + 1, " ".join(other))]
            pairs += 1
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).filter("not kept").count()
    assert found >= 0.97 * pairs


def test_exactly_at_and_just_below_the_threshold(spark):
    a = " ".join(f"a{i}" for i in range(10))  # 9 shingles
    b = a + " x"  # 10 shingles, 9 shared: 90%
    c = " ".join(f"c{i}" for i in range(9))  # 8 shingles
    d = c + " y z"  # 10 shingles, 8 shared: 80%
    e = " ".join(f"e{i}" for i in range(8))  # 7 shingles
    f = e + " y z"  # 9 shingles, 7 shared: 77%
    rows = list(enumerate([a, b, c, d, e, f]))
    assert got(near_duplicates(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_nulls_empty_repeats_and_clashing_columns(spark):
    long = " ".join(f"k{i}" for i in range(60_000))
    rows = [(3, "a b c"), (3, "a b c"), (1, "A  B\nc"), (None, "a b c"), (None, "only me"), (4, None), (5, ""),
            (6, " \t"), (7, "word"), (8, "WORD"), (9, None), (3, "another text"), (10, long), (11, long + " end")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "'x' AS set_key", "2 AS n", "3 AS node")
    assert got(near_duplicates(df)) == plain(rows)
    assert near_duplicates(df.limit(0)).count() == 0


def test_copies_of_one_text_are_one_set(spark):
    rows = [(i, "the same text in all rows") for i in range(3000)] + [(5000, "the same text in all rows now")]
    result = got(near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(8)))
    assert {r[2] for r in result} == {0} and sum(r[3] for r in result) == 1


def test_paths_follow_from_tokens_alone():
    draw = np.random.default_rng(2)
    tokens = draw.integers(0, 1 << 16, (1000, chosenpath.TOKENS))
    tokens[1] = tokens[0]
    row, node = chosenpath._children(np.full(1000, 3, np.uint64), tokens, 3)
    assert sorted(node[row == 0]) == sorted(node[row == 1])
    # an alike set keeps a shared node with even odds or better
    assert 1 <= len(node[row == 0]) <= 8


def test_only_texts_asked_for_are_shuffled(spark, monkeypatch):
    rows = [(i, f"{i} a b c d {i % 7}") for i in range(2000)]
    sets = Sets(spark.createDataFrame(rows, SCHEMA), 2, "doc_id", "text")
    few = sets.distinct.filter("owner.doc_id < 20")
    owners = few.selectExpr("id", "owner.doc_id AS of", "owner.text_key AS key")
    read = {r["doc_id"] for r in sets.asked(owners).collect()}
    assert set(range(20)) <= read and len(read) < 30
    # more keys than bits: more texts pass, and the sets are the same
    pairs = few.selectExpr("id AS a", "id AS b")
    right = sorted(tuple(r) for r in sets.full(pairs).selectExpr("id", "size(shingles)").collect())
    monkeypatch.setattr(chosenpath, "FILTER", 1)
    assert len({r["doc_id"] for r in sets.asked(owners).collect()}) > 100
    assert sorted(tuple(r) for r in sets.full(pairs).selectExpr("id", "size(shingles)").collect()) == right
    assert len(right) == 20


def test_a_large_leaf_is_compared_in_parts(spark, monkeypatch):
    """Every two members of a leaf meet, in nodes of a few."""
    monkeypatch.setattr(chosenpath, "ABREAST", 8)
    members = spark.range(40).selectExpr("7L AS node", "id", "5 AS n", "id AS s1", "id AS s2", "10L AS parts")
    dealt: dict = {}
    for r in chosenpath._in_parts(members.union(members.selectExpr("8L", "id", "n", "s1", "s2", "2L"))).collect():
        dealt.setdefault(r["node"], set()).add(r["id"])
    assert dealt.pop(8) == set(range(40)) and 7 not in dealt
    assert len(dealt) == 45 and max(map(len, dealt.values())) < 25
    met = {p for group in dealt.values() for p in itertools.combinations(sorted(group), 2)}
    assert met == set(itertools.combinations(range(40), 2))
    texts = family(60, 80, 1, 1) + family(40, 80, 4, 2) + family(12, 40, 2, 3)
    rows = list(enumerate(texts))
    assert got(near_duplicates(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
