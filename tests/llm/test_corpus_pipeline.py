"""Every stage of the pipeline against a plain version, each on its own input."""

from __future__ import annotations

from collections import Counter, defaultdict

import public_tokenizers
import pytest
from conftest import TESTDATA
from test_simhash import close, plain_fingerprint, roots
from tokenizers import Tokenizer

import corpus_pipeline
from schoolyard.llm.common import free_name, stored
from schoolyard.llm.language import letters
from schoolyard.llm.linetree import parsed
from schoolyard.llm.mixing import copies


@pytest.fixture(scope="module")
def stages(spark):
    """The rows of documents and what each stage makes of them."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    # a text without letters, no text, a repeated row and one without an id or a source
    odd = spark.createDataFrame(
        [(900_001, "12 34 !", "en", "src0", 7), (900_002, None, None, "src1", 0), (None, "no id " * 30, "en", None, 180)]
        + [(900_003, "the same row " * 20, "en", "src2", 260)] * 2,
        docs.schema,
    )
    frames = [stored(docs.unionByName(odd), "documents")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], TESTDATA), name))
    return frames


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "near_dedup", "mix_sources", "packing"
    ]
    for frame in stages[1:-1]:
        assert frame.columns == stages[0].columns
        assert [t for _, t in frame.dtypes] == [t for _, t in stages[0].dtypes]


def test_language_stage_drops_what_has_no_language(stages):
    before, after = rows(stages[0]), rows(stages[1])
    gone = Counter(map(str, before)) - Counter(map(str, after))
    assert not Counter(map(str, after)) - Counter(map(str, before))
    without = [str(r) for r in before if not len(letters(r["text"]))]
    assert set(without) <= set(gone)
    assert sum(gone.values()) <= len(without) + 0.02 * len(before)


def test_line_stage_cuts_lines_that_recur(stages):
    before, after = rows(stages[1]), rows(stages[2])
    assert Counter(r["doc_id"] for r in before) == Counter(r["doc_id"] for r in after)
    kept = {r["doc_id"]: r for r in after}
    texts, cut = defaultdict(set), set()
    for r in before:
        left = kept[r["doc_id"]]["text"].split("\n")
        lines = r["text"].split("\n")
        assert [x for x in lines if x in left] == [x for x in left if x in lines]
        assert kept[r["doc_id"]]["n_chars"] == len(kept[r["doc_id"]]["text"])
        for line in lines:
            at = parsed(line.encode(), 3)
            if at:
                texts[at[0]].add(r["text"])
                if line not in left:
                    cut.add(at[0])
    assert all(len(texts[leaf]) >= 10 for leaf in cut)


def test_one_of_each_group_stays(stages):
    before, after = rows(stages[2]), rows(stages[3])
    prints = {r["text"]: plain_fingerprint(r["text"]) for r in before}
    group = roots(sorted(set(prints.values())), close)
    first = {}
    for r in before:
        g, key = group[prints[r["text"]]], (r["doc_id"] is None, r["doc_id"] or 0)
        first[g] = min(first.get(g, key), key)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == sorted(first.values())
    texts = {(str(r["doc_id"]), r["text"]) for r in before}
    assert all((str(r["doc_id"]), r["text"]) in texts for r in after)


def test_mixed_rows_are_the_copies_taken(stages):
    taken = Counter()
    for r in copies(stages[3]).collect():
        taken[r.doc_id] += r.copies
    assert Counter(r["doc_id"] for r in rows(stages[4])) == Counter({k: n for k, n in taken.items() if n})


def test_packed_pieces_are_the_mixed_documents(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for r in rows(stages[4]):
        expected[r["doc_id"]] += len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    got, filled = Counter(), Counter()
    for r in rows(stages[5]):
        got[r["doc_id"]] += r["length"]
        filled[r["sequence_id"]] += r["length"]
    assert got == expected
    assert max(filled.values()) <= 1024


def test_run_gives_the_rows_of_the_last_stage(spark):
    got = corpus_pipeline.run(spark, TESTDATA)
    assert {"doc_id", "sequence_id", "offset"} <= set(got.columns)
    assert corpus_pipeline.ORACLE_SQL is None
    assert got.count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, TESTDATA), name)
        assert docs.count() == 0


def test_free_names_do_not_clash(spark):
    df = spark.createDataFrame([(1, 2)], "Found int, _found int")
    assert free_name(df, "found") == "__found"
    assert free_name(df, "other") == "other"
