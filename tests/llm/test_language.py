from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from schoolyard.llm import language
from schoolyard.llm.language import accepted, estimate, identify, learn, letters
from schoolyard.llm.queries import op10_language_id

SYLLABLES = {
    "xx": ["ka", "to", "mi", "ru", "ne"],
    "yy": ["schl", "ein", "ung", "ach", "ü"],
    "zz": ["ost", "ia", "re", "ção", "lh"],
}


def text(rng, lang, n=60):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n)) + "."


def corpus(n=300, seed=2):
    rng = random.Random(seed)
    return [(i, text(rng, lang), lang) for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]


SCHEMA = "doc_id long, text string, lang string, score int, found string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def learned(spark):
    return learn(frame(spark, corpus()))


def plain_kneser_ney(texts):
    """Interpolated Kneser-Ney, written as the textbook recursion."""
    order, d = language.ORDER, language.DISCOUNT
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        s = tuple(t)
        for k in range(1, order + 1):
            for i in range(1 if k == 1 else 0, len(s) - k + 1):
                grams[k][s[i : i + k]] += 1
    counts = [None] * (order + 1)
    counts[order] = grams[order]
    for k in range(order - 1, 0, -1):
        seen = Counter(g[1:] for g in grams[k + 1])
        counts[k] = {g: seen.get(g, 1) for g in grams[k]}
    follow = [defaultdict(dict) for _ in range(order + 1)]
    for k in range(1, order + 1):
        for g, n in counts[k].items():
            follow[k][g[:-1]][g[-1]] = n
    alphabet = len(grams[1]) + 1

    def p(history, c):
        k = len(history) + 1
        lower = p(history[1:], c) if history else 1 / alphabet
        group = follow[k].get(history)
        if not group:
            return lower
        total = sum(group.values())
        return max(group.get(c, 0) - d, 0) / total + d * len(group) / total * lower

    return p


def test_probabilities_match_the_recursion(spark):
    texts = [t for _, t, lang in corpus(40) if lang == "xx"]
    docs = spark.createDataFrame([("xx", t) for t in texts], "lang string, text string")
    counts = (
        docs.mapInArrow(language._counts, "lang string, len int, seq long, history long, ending long, n long")
        .groupBy("lang", "len", "seq", "history", "ending")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    models = estimate(counts)
    p = plain_kneser_ney([letters(t).tolist() for t in texts])
    codes = letters("kato mirune tomika rukane kat miru xq kak")
    got = models.log_probabilities(codes)[:, 0]
    plain = codes.tolist()
    known = set(letters(" ".join(texts)).tolist())
    for i in range(1, len(plain)):
        history = tuple(plain[max(0, i - language.ORDER + 1) : i])
        if set(history) | {plain[i]} <= known:
            assert math.exp(got[i - 1]) == pytest.approx(p(history, plain[i]), rel=1e-4)


def test_letters():
    assert letters(None).tolist() == letters("").tolist() == letters("12 !?\n").tolist() == []
    assert "".join(map(chr, letters("Ab, 1c\n\nÉ"))) == " ab c é "


def test_blocks_give_the_same(learned, monkeypatch):
    t = text(random.Random(4), "yy", 400)
    whole = learned.cross_entropies(t)
    monkeypatch.setattr(language, "BLOCK", 13)
    np.testing.assert_allclose(learned.cross_entropies(t)[0], whole[0], rtol=1e-5)


def test_held_out_accuracy_and_rejection(spark, learned):
    rows = corpus(200, 77)
    rng = random.Random(0)
    noise = " ".join("".join(rng.choices("qwxzjvkfpbg", k=7)) for _ in range(60))
    odd = [(9001, None, "xx"), (9002, "", "xx"), (9003, "123 --- 456", None), (9004, noise, "xx")]
    odd += [(None, rows[0][1], None), (7, rows[0][1], rows[0][2]), (7, rows[0][1], rows[0][2])]
    odd += [(9005, "ka " * 200_000, None)]
    got = identify(frame(spark, rows + odd), learned).collect()
    assert len(got) == len(rows) + len(odd)
    pred = {r.doc_id: r for r in got}
    right = sum(pred[i].lang_pred == lang for i, _, lang in rows if i != 7)
    assert right / (len(rows) - 1) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    for i in (9001, 9002, 9003):
        assert (pred[i].lang_pred, pred[i].score, pred[i].accepted) == ("und", 0.0, False)
    assert pred[9004].lang_pred in SYLLABLES and not pred[9004].accepted
    assert pred[9005].lang_pred == "xx"
    kept = accepted(frame(spark, rows + odd), learned)
    assert kept.columns == ["doc_id", "text", "lang", "score", "found"]
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i, _, _ in rows} <= ids and not ids & {9001, 9002, 9003, 9004}


def test_held_out_labels_are_not_learned(spark):
    rows = corpus(200)
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    changed = [(i, t, "never" if i in held else lang) for i, t, lang in rows]
    one, two = (learn(frame(spark, r)) for r in (rows, changed))
    assert one.languages == two.languages == sorted(SYLLABLES)
    assert all((a == b).all() for a, b in zip(one.logs, two.logs, strict=True))


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "some text", None), (2, None, "xx")])
    models = learn(docs)
    assert [(r.lang_pred, r.accepted) for r in identify(docs, models).collect()] == [("und", False)] * 2
    assert identify(docs.limit(0), models).count() == 0


def test_query_predicts_the_test_tables(spark):
    folder = "/root/testdata/sf0.001"
    got = op10_language_id(spark, folder).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
