"""Token counts by heap-and-linked-list byte-pair merging.

A text is split into pieces by the vocabulary's pattern, each piece into bytes. All adjacent
pairs that the vocabulary can merge wait in a heap by rank; the lowest is popped, its two
symbols become one in a doubly linked list, and the two pairs that arise beside it are pushed.
The count is the number of bytes minus the number of merges; no identifiers are made.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The split pattern of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces whose count a worker remembers; beyond it the memory is emptied.
REMEMBERED = 400_000
#: Longer pieces are counted anew each time, so that the memory stays small.
LONGEST_REMEMBERED = 64


def byte_symbols() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class PieceCounter(dict):
    """Tokens of a piece, remembered by piece. Built from a byte-level BPE file (.json)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or split.get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        specials = [t["content"] for t in spec.get("added_tokens", ())]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", ())):
            raise ValueError(f"{path}: added tokens that take in their surroundings")
        vocab = model["vocab"]
        self.first = [vocab[symbol] for _, symbol in sorted(byte_symbols().items())]
        # (left id, right id) -> (rank, merged id)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[left], vocab[right]
            self.merges.setdefault(pair, (rank, vocab[left + right]))
        self.pieces = regex.compile(SPLIT)
        self.special = (
            regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True))))
            if specials
            else None
        )

    def __missing__(self, piece: str) -> int:
        count = self.merged(piece.encode("utf-8"))
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = count
        return count

    def merged(self, piece: bytes) -> int:
        """Symbols left of a piece when no adjacent pair can be merged any more."""
        n = len(piece)
        merges = self.merges
        symbol = [self.first[b] for b in piece]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        # one integer per waiting pair: rank first, then position, then the merged id
        waiting = []
        for i in range(n - 1):
            found = merges.get((symbol[i], symbol[i + 1]))
            if found:
                waiting.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapq.heapify(waiting)
        left = n
        while waiting:
            _, i, a, b, made = heapq.heappop(waiting)
            j = after[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue  # one of the two has been merged meanwhile
            symbol[i], symbol[j] = made, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((made, symbol[k]))
                if found:
                    heapq.heappush(waiting, (found[0], i, made, symbol[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbol[h], made))
                if found:
                    heapq.heappush(waiting, (found[0], h, symbol[h], made, found[1]))
        return left

    def count(self, text: str) -> int:
        """Tokens of a whole text; a special string inside it is one token."""
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def _plain(self, text: str) -> int:
        if len(text) < 1 << 20:
            return sum(map(self.__getitem__, self.pieces.findall(text)))
        return sum(self[match.group()] for match in self.pieces.finditer(text))


@lru_cache(maxsize=2)
def piece_counter(path: str) -> PieceCounter:
    """One counter per worker process and vocabulary; tasks that follow use it again."""
    return PieceCounter(path)


def _counter_of(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(path)
        for batch in batches:
            texts = batch.column(2)
            counts = pa.array([counter.count(t.as_py() or "") for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), counts], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return count


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Rows keep their partitions; nothing is shuffled. A null text counts as empty: 0 bytes, 0
    tokens, not over the limit. Repeated rows and null ids give a row each. Other columns of
    `docs` are not read. The vocabulary file must be at the same path on all executors.
    """
    text = F.col(text_col)
    plain = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    counted = plain.mapInArrow(_counter_of(vocabulary), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
