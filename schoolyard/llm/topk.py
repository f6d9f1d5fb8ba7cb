"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are dealt to cells by the split planes of one KD-tree, fitted on a bounded sample, and
within a cell evenly to shards. A shard's KD-tree halves its vectors at the median of the widest
dimension and keeps a tight bounding box for every node. A query visits nodes best first: the
largest inner product that a node's box allows bounds what is in it, and a node below the query's
kth score so far is not opened. Queries search their own shard first; the kth score found there
goes with them to the shards of those cells only whose boxes, taken over all of their vectors,
can reach it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schoolyard.llm.common import durable

#: Vectors of a shard and queries of a block; a task holds one of each.
SHARD = 8192
QUERY_BLOCK = 8192
LEAF = 256
#: Vectors that the cells are fitted on, and those of them in a cell at least. They decide how
#: vectors are dealt, never what is found.
SAMPLE = 4096
CELL_SAMPLE = 32
#: Sums beyond this are not exact in doubles; they are made with Python's integers.
EXACT = float(1 << 53)
LONGEST = (1 << 63) - 1

FOUND = "query_row long, query_id long, vec_row long, vec_id long, score long"
NAMES = [x.split()[0] for x in FOUND.split(", ")]


def _held(scores: np.ndarray) -> np.ndarray:
    """Python integers held within the range of a long; doubles here are far below it."""
    return np.clip(scores, -LONGEST - 1, LONGEST) if scores.dtype == object else scores


class Tree:
    """KD-tree over the rows of a matrix: nodes in arrays, each with its bounding box."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        low, high = [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            first, last, parent, side = todo.pop()
            node = len(self.spans)
            own = points[self.order[first:last]]
            box = own.min(axis=0), own.max(axis=0)
            low.append(box[0])
            high.append(box[1])
            self.spans.append((first, last))
            self.children.append(None)
            if parent >= 0:
                sibling = self.children[parent] or (0, 0)
                self.children[parent] = (node, sibling[1]) if side == 0 else (sibling[0], node)
            spread = box[1] - box[0]
            if last - first <= LEAF or not len(spread) or not spread.max() > 0:
                continue
            middle = (last - first) // 2
            by_widest = np.argpartition(own[:, int(np.argmax(spread))], middle)
            self.order[first:last] = self.order[first:last][by_widest]
            todo += [(first, first + middle, node, 0), (first + middle, last, node, 1)]
        self.low, self.high = np.array(low), np.array(high)
        self.points = points[self.order]

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """For every node, the largest inner product that its box allows."""
        positive, negative = np.maximum(query, 0), np.minimum(query, 0)
        return _held(self.high @ positive + self.low @ negative)


def search(
    tree: Tree, ids: np.ndarray, query: np.ndarray, k: int, own: int, least: float
) -> list[tuple[int, int]]:
    """(score, position in the shard) of the k best by (score, smaller id) with at least `least`,
    without position `own`. `ids` are by position."""
    bounds = tree.bounds(query)
    best: list[tuple] = []  # the worst on top
    todo = [(-bounds[0], 0)]
    while todo:
        bound, node = heapq.heappop(todo)
        if -bound < least:
            break  # no box left reaches the kth score
        children = tree.children[node]
        if children:
            for child in children:
                if bounds[child] >= least:
                    heapq.heappush(todo, (-bounds[child], child))
            continue
        first, last = tree.spans[node]
        scores = _held(tree.points[first:last] @ query)
        for i in np.flatnonzero(scores >= least).tolist():
            position = int(tree.order[first + i])
            if position == own:
                continue
            entry = (int(scores[i]), -int(ids[position]), -position)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
            if len(best) == k:
                least = max(least, best[0][0])
    return [(score, -position) for score, _, position in best]


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """Components as floor(1024 x): doubles where all sums are exact, else Python integers."""
    chunk = column.combine_chunks()
    values = chunk.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * 1024.0)
    largest = float(np.abs(scaled).max()) if scaled.size else 0.0
    if largest < EXACT and largest * largest * max(1, scaled.shape[1]) < EXACT:
        return scaled
    # from 2^53 on doubles are whole, and 1024 of the largest ones are beyond a double
    whole = [[int(x) * 1024 if abs(x) >= EXACT else int(y) for x, y in zip(*rows, strict=True)]
             for rows in zip(values.tolist(), scaled.tolist(), strict=True)]
    return np.array(whole, dtype=object).reshape(scaled.shape)


def _searcher(k: int):
    def run(shard: pa.Table, queries: pa.Table) -> pa.Table:
        rows = {name: [] for name in NAMES}
        if shard.num_rows and queries.num_rows:
            points = _matrix(shard["v"], shard.num_rows)
            wanted = _matrix(queries["query_v"], queries.num_rows)
            if points.dtype != wanted.dtype or (
                points.dtype != object
                and np.abs(points).max(initial=0) * np.abs(wanted).max(initial=0) * points.shape[1] >= EXACT
            ):
                points = np.array([[int(x) for x in r] for r in points.tolist()], dtype=object).reshape(points.shape)
                wanted = np.array([[int(x) for x in r] for r in wanted.tolist()], dtype=object).reshape(wanted.shape)
            vec_row = shard["row"].to_numpy()
            vec_id = shard["vec_id"].to_pylist()
            ids = np.array([LONGEST if x is None else x for x in vec_id])  # null ids come last
            place = {row: i for i, row in enumerate(vec_row.tolist())}
            tree = Tree(points)
            for i, (row, qid, least) in enumerate(
                zip(*(queries[f"query_{c}"].to_pylist() for c in ("row", "vec_id", "least")), strict=True)
            ):
                floor = -np.inf if least is None else least
                for score, position in search(tree, ids, wanted[i], k, place.get(row, -1), floor):
                    found = (row, qid, int(vec_row[position]), vec_id[position])
                    for name, x in zip(NAMES, (*found, score), strict=True):
                        rows[name].append(x)
        return pa.table({name: pa.array(rows[name], pa.int64()) for name in NAMES})

    return run


def fitted(points: np.ndarray, least: int) -> tuple | int:
    """Split planes (dimension, value, below, from) over the points, with numbered cells for leaves."""
    cells = iter(range(len(points) + 1))

    def split(own: np.ndarray) -> tuple | int:
        with np.errstate(over="ignore"):
            spread = np.ptp(own, axis=0) if own.size else np.zeros(0)
        if len(own) < 2 * least or not len(spread) or not spread.max() > 0:
            return next(cells)
        widest = int(np.argmax(spread))
        values = np.sort(own[:, widest])
        at = values[len(values) // 2]
        if at == values[0]:  # ties up to the middle
            at = values[np.searchsorted(values, at, "right")]
        below = own[:, widest] < at
        return widest, float(at), split(own[below]), split(own[~below])

    return split(points)


def cells_of(planes: tuple | int, points: np.ndarray) -> np.ndarray:
    """The cell of every point."""
    found = np.zeros(len(points), np.int64)
    todo = [(planes, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if isinstance(node, int):
            found[at] = node
        else:
            below = points[at, node[0]] < node[1]
            todo += [(node[2], at[below]), (node[3], at[~below])]
    return found


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, vectors) for every length of vectors in a batch."""
    dims = batch.column("dims").to_numpy(zero_copy_only=False)
    for length in np.unique(dims).tolist():
        at = np.flatnonzero(dims == length)
        flat = batch.column("v").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield length, at, flat.reshape(len(at), length)


def _to_cells(planes: dict[int, tuple | int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int64)
            for length, at, points in _by_length(batch):
                if length in planes:
                    cell[at] = cells_of(planes[length], points)
            yield batch.append_column("cell", pa.array(cell))

    return run


BOX = "dims int, cell long, low array<double>, high array<double>"


def _boxes(planes: dict[int, tuple | int]):
    """The box of each cell over a partition; a row per cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            for length, at, points in _by_length(batch):
                for c in np.unique(cell[at]).tolist() if length in planes else ():
                    own = points[cell[at] == c]
                    low, high = own.min(axis=0), own.max(axis=0)
                    if known := boxes.get((length, c)):
                        low, high = np.minimum(low, known[0]), np.maximum(high, known[1])
                    boxes[length, c] = low, high
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in boxes], pa.int32()),
                pa.array([k[1] for k in boxes], pa.int64()),
                pa.array([x[0] for x in boxes.values()], pa.list_(pa.float64())),
                pa.array([x[1] for x in boxes.values()], pa.list_(pa.float64())),
            ],
            names=["dims", "cell", "low", "high"],
        )

    return run


def reach(low: np.ndarray, high: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """At least the largest score of each query (row) in each box (column), as a double."""
    with np.errstate(over="ignore", invalid="ignore"):
        # floor(1024 x) is within one of 1024 x, and rounding is far below a 2^-40th
        low, high, queries = (np.floor(x * 1024.0) for x in (low, high, queries))
        above, under = np.maximum(queries, 0), np.minimum(queries, 0)
        most = above @ high.T + under @ low.T
        slack = np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T * 2.0**-40 + 1
        most = np.minimum(most + slack, 2.0**63)
    return np.where(np.isnan(most), np.inf, most)


ROUTED = "row long, vec_id long, v array<double>, dims int, least long, home_cell long, home_shard long, cell long"


def _reached(boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Queries with each cell that can hold one of their k best; cell 0 where there is only one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("least").is_valid().to_numpy(zero_copy_only=False)
            least = batch.column("least").fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            for length, at, points in _by_length(batch):
                cells, low, high = boxes.get(length, (np.zeros(1, np.int64), None, None))
                if low is None:
                    wanted = np.ones((len(at), 1), bool)
                else:
                    wanted = ~known[at, None] | (reach(low, high, points) >= least[at, None])
                for i, cell in enumerate(cells.tolist()):
                    if len(own := at[wanted[:, i]]):
                        sent = batch.take(pa.array(own))
                        yield sent.append_column("cell", pa.array(np.full(len(own), cell)))

    return run


def _planes(vectors: DataFrame, n: int, shard: int, sample: int, least: int) -> dict[int, tuple | int]:
    """Split planes by length of vectors, fitted on about `sample` of all `n`, drawn by hash.

    A cell is made for no less than a shard, as every cell in reach costs a query one copy.
    """
    least = max(least, -(-shard * min(sample, n) // max(1, n)))
    share = int(min(1.0, sample / max(1, n)) * (1 << 40))
    draw = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 40))
    drawn = vectors.filter(draw < share).select("dims", "v").limit(2 * sample).collect()
    points: dict[int, list[list[float]]] = {}
    for r in drawn:
        points.setdefault(r["dims"], []).append(r["v"])
    planes = {length: fitted(np.array(own), least) for length, own in sorted(points.items())}
    return {length: tree for length, tree in planes.items() if not isinstance(tree, int)}


def _boxes_of(rows: DataFrame, planes: dict) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(cells, low, high) by length: at most `SAMPLE` / `CELL_SAMPLE` boxes come to the driver."""
    if not planes:
        return {}
    parts = rows.select("dims", "cell", "v").mapInArrow(_boxes(planes), BOX)
    ends = parts.select("dims", "cell", F.posexplode(F.arrays_zip("low", "high")).alias("at", "x"))
    ends = ends.groupBy("dims", "cell", "at").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    found = ends.toPandas().sort_values(["dims", "cell", "at"])
    boxes = {}
    for length, own in found.groupby("dims"):
        cells = own["cell"].to_numpy()[:: int(length)]
        low, high = (own[c].to_numpy().reshape(-1, int(length)) for c in ("low", "high"))
        boxes[int(length)] = cells, low, high
    return boxes


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row"
    )
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard: int = SHARD,
    sample: int = SAMPLE,
    cell_sample: int = CELL_SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id is divisible by
    `every`, by the inner product of floor(1024 x), ties to the smaller id.

    All rows but the query's own are candidates: a repeated id is another row, and each of its
    rows that is a query has a ranking of its own. Fewer candidates give fewer rows. Vectors
    that are null or hold a null or non-finite component take no part; vectors of different
    lengths are not compared. A null id is no query and comes after other ids in a tie. Scores
    are exact, held within the range of a long, and ranked as such. Other columns are not read. A shard meets
    the queries that can reach its cell, in blocks; nothing is dropped, as the kth score only
    skips boxes that cannot reach it. The cells are fitted on about `sample` vectors, with
    `cell_sample` of them in each at least; all vectors are in cells, and results never depend on it.
    """
    usable = F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    read = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    read = read.filter(usable).withColumn("dims", F.size("v"))
    planes = _planes(read, vectors.count(), shard, sample, cell_sample)
    in_cells = "row long, vec_id long, v array<double>, dims int, cell long"
    rows = durable(read.mapInArrow(_to_cells(planes), in_cells))
    boxes = _boxes_of(rows, planes)
    sizes = rows.groupBy("dims", "cell").agg(F.ceil(F.count(F.lit(1)) / shard).alias("shards"))
    dealt = rows.join(sizes, ["dims", "cell"]).withColumn("shard", F.pmod(F.xxhash64("row"), "shards"))
    queries = dealt.filter(F.col("vec_id") % every == 0).drop("shards")
    key = ["dims", "cell", "shard"]

    def searched(wanted: DataFrame) -> DataFrame:
        """What the queries find in the shards they are sent to, in blocks of queries."""
        blocks = wanted.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks"))
        sent = wanted.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), "blocks"))
        sent = sent.select(*[F.col(c).alias(f"query_{c}") for c in (*key, "block", "row", "vec_id", "v", "least")])
        numbers = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
        stored = dealt.join(blocks, key).select(*key, F.explode(numbers).alias("block"), "row", "vec_id", "v")
        stored = stored.groupBy(*key, "block")
        theirs = sent.groupBy(*[f"query_{c}" for c in (*key, "block")])
        return stored.cogroup(theirs).applyInArrow(_searcher(k), FOUND)

    home = durable(searched(queries.withColumn("least", F.lit(None).cast("long"))))
    kth = home.groupBy("query_row").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("least"))
    away = searched(_sent_on(queries, kth, sizes, boxes))
    return _best(home.union(away), k).select("query_id", "rank", "vec_id", "score")


def _sent_on(queries: DataFrame, kth: DataFrame, sizes: DataFrame, boxes: dict) -> DataFrame:
    """Queries with every shard but their own that can hold one of their k best."""
    onward = queries.join(kth, F.col("row") == F.col("query_row"), "left").select(
        "row", "vec_id", "v", "dims", "least", F.col("cell").alias("home_cell"), F.col("shard").alias("home_shard")
    )
    reached = onward.mapInArrow(_reached(boxes), ROUTED).join(sizes, ["dims", "cell"])
    every_shard = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
    routed = reached.withColumn("shard", every_shard)
    return routed.filter((F.col("cell") != F.col("home_cell")) | (F.col("shard") != F.col("home_shard")))
