from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from schoolyard.llm.quality import LineRules, judged

SCHEMA = "doc_id long, text string, lines int, n_words string"


def plain(text):
    """The base counts, written out."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def run(spark, texts, rules=LineRules()):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], SCHEMA).repartition(3)
    return judged(docs, rules).collect()


def test_base_counts(spark):
    rng = random.Random(7)
    spaces = [" ", "  ", "\n", "\t", "\x0b", "\x0c", "\r\n", " ", " ", "\x1c"]
    texts = [(0, None), (1, ""), (2, " \n\t"), (3, "a b c d e " * 3), (4, "x"), (4, "x"), (None, "y z")]
    texts += [(5, "w " * 50_000), (6, "é𝄞 #*$%&|<>\né𝄞 #*$%&|<>\n\n \n"), (7, "a b c d e f a b c d e")]
    for i in range(10, 90):
        n = rng.randrange(1, 60)
        texts.append((i, "".join(rng.choice("abc<|") + rng.choice(spaces) for _ in range(n))))
    got = run(spark, texts)
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(str((r.doc_id, *(r[f] for f in fields))) for r in got) == sorted(
        str((i, *plain(t))) for i, t in texts
    )
    assert not any(r.kept for r in got if r.base_failed)
    assert run(spark, []) == []


PROSE = "The river runs past the old mill and under a bridge that nobody uses any more."


@pytest.mark.parametrize(
    "line,fails",
    [
        ("Nobody has crossed it for a very long time, as far as anyone knows.", False),
        ("Short one.", False),
        ("Home", True),
        ("Home | About | Contact | Imprint", True),
        ("one » two » three » four", True),
        ("All rights reserved.", True),
        ("Please enable JavaScript to see this page.", True),
        ("foo### bar$$$ baz%%% qux&&& and*** more", True),
        ("READ THIS!! NOW!! OR!! NEVER!!", True),
        ("", False),
    ],
)
def test_lines(spark, line, fails):
    (r,) = run(spark, [(1, f"{PROSE}\n{line}")])
    assert r.clean_text == (PROSE if fails else f"{PROSE}\n{line}")
    assert r.lost_words == (len(line.split()) if fails else 0)
    assert r.kept


def test_documents_that_lose_too_much(spark):
    menu = "Home | About | Contact | Imprint"  # 7 of 23 words
    long_menu = "\n".join(f"x{i} | y{i} | z{i}" for i in range(9))
    rows = run(spark, [(1, f"{PROSE}\n{menu}"), (2, f"{PROSE}\n{long_menu}")])
    assert {r.doc_id: (r.kept, r.base_failed) for r in rows} == {1: (True, False), 2: (False, False)}
    (strict,) = run(spark, [(1, f"{PROSE}\n{menu}")], LineRules(lost_percent=30))
    assert not strict.kept


def test_plan_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "x", 1, "x")], SCHEMA)
    plan = judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("PythonUDF", "ArrowEval", "MapInArrow", "MapInPandas"))
