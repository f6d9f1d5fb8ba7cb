"""SimHash near-duplicates through a segment-popcount embedding and a grid range-join.

A 64-bit fingerprint is cut into 32 segments of two bits. The number of bits set in each
segment is a point in a 32-dimensional space, in which the Manhattan distance of two points is
a lower bound of the Hamming distance of their fingerprints. Points are written in unary code
(the bits of each segment sorted), so that the Manhattan distance is a bit count.

If two fingerprints differ in at most 4 bits, their points are at most 2 apart in the first or
in the second 16 segments, and then some point of that half is at most 1 from both. Every
distinct fingerprint is therefore put in the grid cells of its two halves and of their
neighbours at distance 1; the cells join the pairs within range. Pairs in a cell pass the lower
bound over all 32 segments and then the exact bit count. A cell gives a spanning forest of its
links instead of all of them, as only reachability matters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard.llm.common import durable, free_name, gathered
from schoolyard.llm.components import components

SEED = 42
LOW_BITS = 0x5555555555555555
#: A half is cut in quarters where a cell holds more distinct fingerprints than this.
DENSE_CELL = 20_000
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text; 0 if it has no word."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    hash_of = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, n, BLOCK):
        upto = min(n, at + BLOCK)
        spans = zip(starts[at:upto].tolist(), ends[at + width - 1 : upto + width - 1].tolist(), strict=True)
        hashes = np.array([hash_of(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                names=["doc_id", "text_key", "fp"],
            )

    return run


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp): xxhash64 and fingerprint, a signed long, of every row's text."""
    plain = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
        F.col(text_col).alias("text"),
    )
    return plain.mapInArrow(_fingerprints(shingle), "doc_id long, text_key long, fp long")


def _unary(fp: Column) -> Column:
    """The bits of each two-bit segment sorted: 00, 01 or 11."""
    low, high = F.lit(LOW_BITS), F.shiftrightunsigned(fp, 1)
    some, both = fp.bitwiseOR(high).bitwiseAND(low), fp.bitwiseAND(high).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _cells(point: Column, first: int, segments: int, tag: int) -> Column:
    """Cells of a point in so many segments from `first` on: its own and those at distance 1.

    In unary code a step changes one bit: the lower one may change while the upper one is
    clear, the upper one while the lower one is set.
    """
    mask = (1 << 2 * segments) - 1
    part = F.shiftrightunsigned(point, 2 * first).bitwiseAND(F.lit(mask))
    marked = F.lit(tag << 2 * segments)
    steps = [part]
    for i in range(segments):
        low, high = F.lit(1 << 2 * i), F.lit(2 << 2 * i)
        has_low, has_high = part.bitwiseAND(low) != 0, part.bitwiseAND(high) != 0
        steps.append(F.when(~has_high, part.bitwiseXOR(low)))
        steps.append(F.when(has_low, part.bitwiseXOR(high)))
    return F.transform(F.array_compact(F.array(*steps)), lambda cell: cell.bitwiseOR(marked))


def _unary_of(fp: np.ndarray) -> np.ndarray:
    low, one = np.uint64(LOW_BITS), np.uint64(1)
    high = fp >> one
    return ((fp | high) & low) | ((fp & high & low) << one)


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Positions of links that connect what links of at most `max_bits` connect, at most n - 1.

    Around a pivot, everything within half the distance is a clique and is settled with it.
    What lies farther, up to one and a half times the distance, is compared with the clique.
    """
    n = len(fps)
    root = np.arange(n)
    links: list[tuple[int, int]] = []
    points = _unary_of(fps)
    left = np.arange(n)

    def connect(i: int, others: np.ndarray) -> None:
        for r in np.unique(root[others]).tolist():
            if r != root[i]:
                member = int(others[root[others] == r][0])
                links.append((i, member))
                root[root == r] = root[i]

    while len(left) > 1:
        pivot = int(left[0])
        distance = np.bitwise_count(fps[left] ^ fps[pivot])
        near = left[distance <= max_bits]
        connect(pivot, near[near != pivot])
        in_clique = distance <= max_bits // 2
        clique = left[in_clique]
        fringe = left[(distance > max_bits) & (distance <= max_bits + max_bits // 2)]
        fringe = fringe[root[fringe] != root[pivot]]
        for x in clique[clique != pivot].tolist() if len(fringe) else ():
            bound = fringe[np.bitwise_count(points[fringe] ^ points[x]) <= max_bits]
            linked = bound[np.bitwise_count(fps[bound] ^ fps[x]) <= max_bits]
            if len(linked):
                connect(x, linked)
                fringe = fringe[root[fringe] != root[pivot]]
        left = left[~in_clique]
    return links


def _links(max_bits: int, dense: int | None):
    """Links of the cells of a partition sorted by cell; of a dense cell a row (cell, null)."""

    def small_cells(cell: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points, left, right = _unary_of(fp), [], []
        for step in range(1, len(cell)):
            pairs = np.flatnonzero(cell[step:] == cell[:-step])
            if not len(pairs):
                break
            pairs = pairs[np.bitwise_count(points[pairs] ^ points[pairs + step]) <= max_bits]
            pairs = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + step]) <= max_bits]
            left.append(fp[pairs])
            right.append(fp[pairs + step])
        empty = [np.array([], np.uint64)]
        return np.concatenate(left or empty), np.concatenate(right or empty)

    def batch_of(a: np.ndarray, b: np.ndarray, skipped: list[int]) -> pa.RecordBatch:
        a = np.concatenate([a.view(np.int64), np.array(skipped, np.int64)])
        b = pa.concat_arrays([pa.array(b.view(np.int64)), pa.nulls(len(skipped), pa.int64())])
        return pa.RecordBatch.from_arrays([pa.array(a), b], names=["a", "b"])

    def settle(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        """Links of whole cells."""
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(cell)]]))
        large = sizes > 16
        in_small = np.repeat(~large, sizes)
        a, b = small_cells(cell[in_small], fp[in_small])
        for start, size in zip(starts[large].tolist(), sizes[large].tolist(), strict=True):
            own = fp[start : start + size]
            found = np.array(forest(own, max_bits), np.int64).reshape(-1, 2)
            a, b = np.concatenate([a, own[found[:, 0]]]), np.concatenate([b, own[found[:, 1]]])
        return batch_of(a, b, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp, skipping = np.array([], np.int64), np.array([], np.uint64), None
        for batch in batches:
            more = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if skipping is not None:
                keep = more[0] != skipping
                more = more[0][keep], more[1][keep]
            if not len(more[0]):
                continue
            skipping = None
            cell, fp = np.concatenate([cell, more[0]]), np.concatenate([fp, more[1]])
            last = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            if last:
                yield settle(cell[:last], fp[:last])
                cell, fp = cell[last:], fp[last:]
            if dense is not None and len(cell) > dense:
                skipping = int(cell[0])
                yield batch_of(np.array([], np.uint64), np.array([], np.uint64), [skipping])
                cell, fp = cell[:0], fp[:0]
        if len(cell):
            yield settle(cell, fp)

    return run


def _settled(cells: DataFrame, max_bits: int, dense: int | None) -> DataFrame:
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(parts, "cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInArrow(_links(max_bits, dense), "a long, b long")


def fingerprint_links(fps: DataFrame, max_bits: int = 4, dense_cell: int = DENSE_CELL) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints `fp` as all links of at most
    `max_bits` differing bits do. `max_bits` is at most 5, as two halves then suffice."""
    if not 0 <= max_bits <= 5:
        raise ValueError("the grid has cells for at most 5 differing bits")
    point = _unary(F.col("fp"))
    halves = fps.select("fp", F.explode(F.concat(*[_cells(point, 16 * h, 16, h) for h in (0, 1)])).alias("cell"))
    found = gathered(_settled(halves.select("cell", "fp"), max_bits, dense_cell))
    links = found.filter("b is not null")
    crowded = found.filter("b is null").select(F.col("a").alias("cell")).distinct()
    if not crowded.isEmpty():
        # Two of a cell are within max_bits in the other half too, so within 2 in one of its
        # quarters: the same grid once more, for the members of dense cells alone.
        members = halves.join(crowded, "cell")
        other = F.when(F.shiftright("cell", 32) == 0, 1).otherwise(0)
        quarters = F.when(other == 0, F.concat(*[_cells(point, 8 * q, 8, q) for q in (0, 1)])).otherwise(
            F.concat(*[_cells(point, 8 * q, 8, q) for q in (2, 3)])
        )
        finer = members.select(F.col("cell").alias("half_cell"), "fp", F.explode(quarters).alias("quarter"))
        finer = finer.select(F.xxhash64("half_cell", "quarter").alias("cell"), "fp")
        links = links.union(_settled(finer, max_bits, None))
    return links


def fingerprint_groups(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """(print, root, least): for every distinct fingerprint its group and its smallest doc_id."""
    distinct = gathered(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = components(fingerprint_links(distinct.select("fp"), max_bits))
    return gathered(
        distinct.join(linked, F.col("fp") == F.col("node"), "left").select(
            F.col("fp").alias("print"), F.coalesce("root", "fp").alias("root"), "least"
        )
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, fp (signed long), fingerprint (16 hex digits) and
    component_id, the smallest doc_id reachable over links of at most `max_bits` bits.

    Equal fingerprints are linked, whatever the texts; all texts without a word (null, empty,
    white space) have fingerprint 0 and are linked like others. Copies are reduced to their
    distinct fingerprint before any pair is looked at. Repeated rows keep a row each; a row
    with a null id takes the component of the others, or null if they all have none. Other
    columns are not read.
    """
    prints = durable(fingerprints(docs, shingle, id_col, text_col))
    member = fingerprint_groups(prints, max_bits)
    lowest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(lowest, "root").select("print", "component_id")
    return prints.join(named, F.col("fp") == F.col("print")).select(
        "doc_id",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`docs` with one row of each group of near-duplicates, all columns kept.

    The row with the smallest id stays (null last); of rows that repeat its id, one does. Texts
    without a word are a group like others.
    """
    prints = durable(fingerprints(docs, shingle, id_col, text_col))
    member = fingerprint_groups(prints, max_bits)
    # by fingerprint first: a group of very many copies is a row per task
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    firsts = prints.groupBy("fp").agg(F.min(name).alias("name"))
    staying = (
        firsts.join(member, F.col("fp") == F.col("print")).groupBy("root").agg(F.min("name").alias("name"))
    )
    owner, other, key = (free_name(docs, x) for x in ("staying_id", "staying_key", "text_key"))
    staying = staying.select(F.col("name.doc_id").alias(owner), F.col("name.text_key").alias(other))
    keyed = docs.withColumn(key, F.xxhash64(F.col(text_col)))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(owner)) & (F.col(key) == F.col(other))
    return keyed.join(staying, same).dropDuplicates([owner, other]).select(*docs.columns)
