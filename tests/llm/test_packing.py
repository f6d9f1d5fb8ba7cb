from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from schoolyard.llm.packing import cuts, difference, encoder, pack, token_ids, windows_of
from schoolyard.llm.tokens import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"
TEXTS = [
    None,
    "",
    " ",
    "Hello world",
    "a" * 3000,
    "don't we'll I'M  x\t\n\n  y\r\n",
    f"{SPECIAL}a{SPECIAL}{SPECIAL} b <|endoftext",
    "日本語のテキスト 한국어 العربية हिन्दी",
    "é   \u0085​ 𝄞👩‍👩‍👧 ١٢٣ ½ ²",
    "#*$%&|<>" * 40,
    "\x00\x01\x1c\x1d \x7f﻿",
    "lorem ipsum dolor 12345 " * 2000,
]
SCHEMA = "doc_id long, text string, n_tokens string, start int"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def corpus():
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, TEXTS[3]), (3, TEXTS[3])]
    return rows + [(100 + i, "ab cd efg " * int(rng.lognormvariate(4, 1.5))) for i in range(250)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(parts)


def test_counts_match_the_library(spark, library):
    rows = corpus()
    got = token_counts(frame(spark, rows), PATH, limit=50).collect()
    expected = sorted(
        (str(i), len((t or "").encode()), len(library(t)), len(library(t)) > 50) for i, t in rows
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == expected
    assert token_counts(frame(spark, [], 1), PATH).count() == 0


def test_ids_match_the_library_on_every_character(library):
    encoding, _ = encoder(PATH)
    rng = random.Random(1)
    codes = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(codes), 4000):
        some = "".join(f"a{c} {c}{c} {c}1" for c in map(chr, rng.sample(codes, 400)))
        assert encoding.encode_ordinary(some) == library(some)


@pytest.mark.parametrize("char", [" ", "\n", "a", "!", "\u3000"])
def test_long_runs_of_a_character(library, char):
    for text in (char * 300_000, f"a{char * 120_000} b", f"{char * 60_000}{SPECIAL}"):
        assert token_ids(PATH, text) == library(text)


def test_pieces_put_together_are_the_documents(spark, library):
    rows = corpus()
    got = pack(frame(spark, rows), PATH, capacity=256).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 256
    expected = defaultdict(list)
    for i, t in rows:
        expected[i].append(np.array(library(t) + [0], "<u4"))
    assert set(pieces) == set(expected)
    for i, found in pieces.items():
        ids, copies = expected[i][0], len(expected[i])
        assert {r.doc_tokens for r in found} == {len(ids)}
        spans = sorted((r.start, r.length) for r in found)
        assert spans == sorted(list(dict.fromkeys(spans)) * copies)
        at = 0
        for start, length in dict.fromkeys(spans):
            assert start == at
            at += length
        assert at == len(ids)
        for r in found:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_little_padding(spark):
    rows = [(i, t) for i, t in corpus() if i is not None and i >= 100] * 4
    got = pack(frame(spark, rows, 1), PATH, capacity=1024).collect()
    used = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) * 1024 < 1.03 * used


def test_one_document_and_none(spark):
    (row,) = pack(frame(spark, [(1, None)], 1), PATH).collect()
    assert (row.start, row.length, row.doc_tokens, row.offset) == (0, 1, 1, 0)
    assert pack(frame(spark, [], 1), PATH).count() == 0


@pytest.mark.parametrize("length", [1, 127, 128, 255, 1023, 1024, 1025, 5000])
def test_cuts_add_up(length):
    found = cuts(length, 1024)
    assert sum(found) == length and all(0 < x <= 1024 for x in found) and len(found) <= length // 1024 + 4


def test_differencing_balances():
    # the textbook example: 8 7 6 5 4 in two sets differ by 2
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in difference([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]
    rng = random.Random(3)
    sizes = [rng.randrange(1, 200) for _ in range(400)]
    found = difference(sizes, 30)
    assert sorted(i for w in found for i in w) == list(range(400))
    sums = [sum(sizes[i] for i in w) for w in found]
    assert len(sums) == 30 and max(sums) - min(sums) <= 3


def test_windows_rise_until_they_fit():
    assert sorted(map(len, windows_of([600, 600, 600], 1024))) == [1, 1, 1]
    assert sorted(map(len, windows_of([512, 512, 512], 1024))) == [1, 2]
    assert windows_of([7], 1024) == [[0]]
