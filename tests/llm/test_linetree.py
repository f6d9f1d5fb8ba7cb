from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from schoolyard.llm.linetree import TreeRules, drop_recurring_lines, parsed

SCHEMA = "doc_id long, text string, lines_cut string, text_key int"
WORDS = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("an", "el", "ir", "os", "um", "ay")]


def prose(rng, n=12):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def corpus():
    """Texts of their own, some with boilerplate; one text with copies; one with near copies."""
    rng = random.Random(11)
    rows, boilerplate = [], {}
    for i in range(120):
        lines = [prose(rng) for _ in range(6)]
        if i % 4 == 0:
            lines.insert(rng.randrange(7), f"Posted here today by {rng.choice(WORDS)} on day {i} at the usual place")
            boilerplate[i] = 1
        if i % 3 == 0:
            lines += ["All rights reserved.", "Contact us"]
            boilerplate[i] = boilerplate.get(i, 0) + 2
        rows.append((i, "\n".join(lines)))
    base = [prose(rng) for _ in range(8)]
    rows += [(1000 + i, "\n".join(base)) for i in range(40)]
    for i in range(40):
        near = list(base)
        words = near[i % 8].split()
        words[5] = rng.choice(WORDS)
        near[i % 8] = " ".join(words)
        rows.append((2000 + i, "\n".join(near)))
    return rows, boilerplate


def cleaned(spark, rows, rules=TreeRules()):
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], SCHEMA).repartition(5)
    out, cut = drop_recurring_lines(docs, rules)
    assert out.columns[:4] == docs.columns and cut not in docs.columns
    return [(r.doc_id, r.text, r[cut]) for r in out.collect()]


def test_paths_generalise_tokens_with_digits():
    assert parsed(b"  ", 3) is None
    a, b = parsed(b"Page 3 of 10", 3), parsed(b"Page  77 of 9x", 3)
    assert a == b and a[1] == [b"Page", b"<*>", b"of", b"<*>"]
    assert parsed(b"Page 3 of 10 here", 3)[0] != a[0]
    assert parsed(b"one two three four", 3)[0] == parsed(b"one two three five", 3)[0]
    assert parsed(b"one two three four", 4)[0] != parsed(b"one two three five", 4)[0]


def test_boilerplate_goes_and_copies_stay(spark):
    rows, boilerplate = corpus()
    texts = dict(rows)
    for doc_id, text, cut in cleaned(spark, rows):
        assert cut == boilerplate.get(doc_id, 0)
        assert "Contact us" not in text and "rights" not in text and "Posted here" not in text
        kept = text.split("\n")
        assert [x for x in texts[doc_id].split("\n") if x in kept] == kept


def test_results_do_not_depend_on_the_filter_or_partitions(spark):
    rows, _ = corpus()
    one = sorted(cleaned(spark, rows))
    assert sorted(cleaned(spark, rows[::-1], TreeRules(filter_bits=8))) == one


def test_odd_rows(spark):
    rows, _ = corpus()
    odd = [(None, "Contact us"), (5000, None), (5001, ""), (5002, "\n \n"), (None, None)]
    odd += [(5003, "Contact us\n\nAll rights reserved.")] * 3 + [(5004, "Contact us\n" + "far " * 60_000 + "\nend")]
    got = cleaned(spark, rows + odd)
    assert len(got) == len(rows) + len(odd)
    by_id = {i: (t, n) for i, t, n in got if i is not None and i >= 5000}
    assert by_id[5000] == (None, 0) and by_id[5001] == ("", 0) and by_id[5002] == ("\n \n", 0)
    assert by_id[5003] == ("", 2)
    assert by_id[5004] == ("far " * 60_000 + "\nend", 1)
    assert sorted(map(str, [(t, n) for i, t, n in got if i is None])) == ["('', 1)", "(None, 0)"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert drop_recurring_lines(docs)[0].count() == 0


@pytest.mark.parametrize("share,cut", [(0, True), (900_000, False)])
def test_share_of_all_documents(spark, share, cut):
    rows, _ = corpus()
    got = cleaned(spark, rows, TreeRules(min_texts_per_million=share))
    assert any(n for _, _, n in got) == cut


def test_pages_that_are_mostly_template_lose_it(spark):
    rng = random.Random(21)
    shared = [prose(rng) for _ in range(10)]
    rows = [(i, "\n".join([*shared[:5], prose(rng), prose(rng), *shared[5:]])) for i in range(200)]
    rows += [(1000 + i, f"Your order {i} has shipped") for i in range(60)]
    rows += [(2000 + i, "Only one text in copies") for i in range(60)]
    for doc_id, text, cut in cleaned(spark, rows):
        assert cut == (10 if doc_id < 1000 else 1 if doc_id < 2000 else 0)
        assert doc_id >= 1000 or not set(shared) & set(text.split("\n"))


def test_near_copies_do_not_keep_a_line_in_other_texts(spark):
    rng = random.Random(22)
    line = "All of this is served by our partners"
    rows = [(i, "\n".join([*(prose(rng) for _ in range(4)), line])) for i in range(30)]
    base = [prose(rng) for _ in range(8)]
    for i in range(90):
        near = [*base, line]
        near[i % 8] = " ".join([*near[i % 8].split()[:5], rng.choice(WORDS), rng.choice(WORDS), *near[i % 8].split()[7:]])
        rows.append((1000 + i, "\n".join(near)))
    for doc_id, text, cut in cleaned(spark, rows):
        assert cut == 1 and line not in text


def test_unrelated_rows_do_not_keep_a_line(spark):
    rng = random.Random(23)
    rows = [(i, f"{prose(rng)}\nSent from the school office\n{prose(rng)}") for i in range(12)]
    other = [(1000 + i, f"text {i}") for i in range(30_000)]
    cut = {i: n for i, _, n in cleaned(spark, rows + other) if i < 1000}
    assert cut == dict.fromkeys(range(12), 1)


def test_short_lines_with_numbers_go(spark):
    rng = random.Random(24)
    rows = []
    for i in range(40):
        short = [f"Page {i} of {i + 60}", f"Comments ({i})", f"Copyright {1990 + i}", f"{i} comments"]
        numbers = [f"{i} {i * i}"]  # nothing constant
        opening = [f"There is a {' '.join(rng.choice(WORDS) for _ in range(9))}"]  # 3 of 12 words
        rows.append((i, "\n".join([prose(rng), *short, *numbers, *opening, prose(rng)])))
    texts = dict(rows)
    for doc_id, text, cut in cleaned(spark, rows):
        lines = texts[doc_id].split("\n")
        assert cut == 4 and text.split("\n") == [lines[0], *lines[5:]]
