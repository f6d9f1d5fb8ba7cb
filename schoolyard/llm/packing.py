"""Packing of documents into fixed-length sequences by multiway number differencing.

Documents are tokenised and cut where they lie: full windows stand alone, the tail of a
document becomes at most four pieces (512, 256, 128 and the rest, for windows of 1,024). The tails
of a partition are gathered in groups of a bounded number of tokens. In each group the
Karmarkar-Karp differencing method starts with one partial partition per piece, merges the two
partial partitions of the largest spread so that large sums of one meet small sums of the
other, and ends with near-equal windows. If one exceeds the capacity, the group is split into
one window more.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from schoolyard.llm.tokens import SPLIT, byte_symbols

#: Windows of a group; a task holds the tails of one group at a time.
GROUP_WINDOWS = 128
#: Share of a group's room that is filled on purpose, so that near-equal windows fit.
FILLED = 0.996

#: White-space characters in a row from which a text is left to the slower library.
LONG_RUN = 50_000
_RUN = re.compile(r"\s{%d}" % LONG_RUN)

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[tiktoken.Encoding, frozenset[str]]:
    """The vocabulary of a byte-level BPE file (.json) as a fast encoder; one per worker.

    The tests compare its ids with the ones that the file's own library gives.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {symbol: byte for byte, symbol in byte_symbols().items()}
    specials = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in spec["model"]["vocab"].items()
        if token not in specials
    }
    encoding = tiktoken.Encoding(
        path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=specials
    )
    return encoding, frozenset(specials)


@lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def token_ids(path: str, text: str) -> list[int]:
    """Ids of a whole text, without added tokens; a special string inside it is its token."""
    if len(text) > LONG_RUN and _RUN.search(text):
        # more white space in a row than the fast encoder's splitting can look back over
        return library(path).encode(text, add_special_tokens=False).ids
    encoding, specials = encoder(path)
    if any(s in text for s in specials):
        return encoding.encode(text, allowed_special="all")
    return encoding.encode_ordinary(text)


def cuts(length: int, capacity: int) -> list[int]:
    """Piece lengths: full windows, then a half, a quarter and an eighth of one, then the rest."""
    full, tail = divmod(length, capacity)
    pieces = [capacity] * full
    for part in (capacity // 2, capacity // 4, capacity // 8):
        if tail >= part > 0:
            pieces.append(part)
            tail -= part
    return pieces + [tail] * (tail > 0)


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: positions of `sizes` in so many windows with near-equal sums."""
    # A partial partition: sums (descending; empty windows are left out) and their node ids.
    # A node is a piece (id below len(sizes)) or the union of two nodes.
    union: list[tuple[int, int]] = []
    heap = []
    for i, size in enumerate(sizes):
        spread = size if windows > 1 else 0
        heap.append((-spread, i, np.array([size]), np.array([i])))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, s, a = heapq.heappop(heap)
        _, _, t, b = heapq.heappop(heap)
        shared = len(s) + len(t) - windows
        if shared > 0:
            # large sums keep a window to themselves, the rest meet from opposite ends
            i, j = len(s) - shared, len(t) - shared
            first = len(sizes) + len(union)
            union += zip(a[i:].tolist(), b[j:][::-1].tolist(), strict=True)
            sums = np.concatenate([s[:i], s[i:] + t[j:][::-1], t[:j]])
            nodes = np.concatenate([a[:i], np.arange(first, first + shared), b[:j]])
        else:
            sums, nodes = np.concatenate([s, t]), np.concatenate([a, b])
        by_sum = np.argsort(-sums, kind="stable")
        sums, nodes = sums[by_sum], nodes[by_sum]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == windows else 0)
        heapq.heappush(heap, (-spread, order, sums, nodes))
        order += 1
    found = []
    for node in heap[0][3].tolist() if heap else ():
        members, todo = [], [node]
        while todo:
            x = todo.pop()
            if x < len(sizes):
                members.append(x)
            else:
                todo += union[x - len(sizes)]
        found.append(sorted(members))
    return found


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows, as few as differencing can keep within the capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, windows)
        if all(sum(sizes[i] for i in window) <= capacity for window in found):
            return found
        windows += 1


def _cut(vocabulary: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(vocabulary, text.as_py() or "")
                ids.append(0)
                raw = np.array(ids, dtype="<u4").tobytes()
                start = 0
                for length in cuts(len(ids), capacity):
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    for column, x in zip(columns, (doc_id, start, length, crc, len(ids)), strict=True):
                        column.append(x)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return run


def _pack(capacity: int, group_windows: int):
    room = max(capacity, int(capacity * group_windows * FILLED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        tokens = 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in PACKED.split(", ")]
            )

        def packed() -> list[tuple]:
            nonlocal sequence, tokens
            rows = []
            for window in windows_of([row[2] for row in waiting], capacity):
                offset = 0
                for i in window:
                    rows.append((*waiting[i], sequence, offset))
                    offset += waiting[i][2]
                sequence += 1
            waiting.clear()
            tokens = 0
            return rows

        for batch in batches:
            rows: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[2] == capacity:
                    rows.append((*row, sequence, 0))
                    sequence += 1
                    continue
                if tokens + row[2] > room:
                    rows += packed()
                waiting.append(row)
                tokens += row[2]
            if rows:
                yield batch_of(rows)
        if waiting:
            yield batch_of(packed())

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 1024,
    group_windows: int = GROUP_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and a final id 0. Pieces of a sequence lie one after the other
    from offset 0 and hold at most `capacity` ids. Nothing is shuffled: a task packs what it
    reads, one bounded group of tails at a time, so copies, hot sources and long texts weigh
    no more than their length; what is lost is computed again from its partition alone. A
    partition's last group may leave up to one window unfilled. sequence_id has the
    partition's number in its upper bits. A null text counts as empty (the id 0 alone);
    repeated rows and null ids are packed like others; other columns are not read.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = plain.mapInArrow(_cut(vocabulary, capacity), PIECES)
    return pieces.mapInArrow(_pack(capacity, group_windows), PACKED)
