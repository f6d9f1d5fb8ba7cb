"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

A document is the set of its word shingles. In each of several independent trees it walks from
the root to leaves: a node chooses one or two of the minwise tokens (5/4 on average, the inverse
of the similarity asked for), and documents that agree on a chosen token go on together. The
choice follows from the node's path alone, so a document finds its nodes without the others.

A node with few documents is a leaf: all its documents are compared by 128-bit sketches, and
what passes is verified on the full sets; more than a task takes are compared part by part. In a larger node everything is compared with one
pivot, exactly. Distance (one minus similarity) is a metric: a document linked with the pivot
can only have partners outside the pivot's links if one lies within its own distance plus the
threshold; where none does, it is settled and leaves the node. The pivot itself always leaves.
The others branch on. A group of any number of near copies so costs one comparison each, and
never meets in one task.

Each document is first verified with the one of a smaller number that it resembles most in any
leaf; components follow. Members that resemble one of another component then bring their full
sets to the leaf, where all intersections are counted at once; pairs never leave it, only a
forest of its links does. Every link reported is exact; the trees decide the recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard.llm.common import durable, stored
from schoolyard.llm.components import components

SEED = 12
#: Minwise tokens of a set, and as many bits of its sketch.
TOKENS = 128
TREES = 10
#: Levels made at once: first for all sets, then for those in large nodes.
FIRST_LEVELS, MORE_LEVELS = 3, 2
#: A node with at most so many sets (and shingles, below) is a leaf; sets that a task compares
#: with each other, about. A larger leaf is compared in parts, every two of them in a task.
LEAF, ABREAST = 4096, 1024
#: Bits of two sketches that agree: 90% are expected at similarity 0.8 (115 of 128, deviation
#: 3.4). Pivots look farther, to see what lies beyond their links.
ALIKE, IN_SIGHT = 102, 96
#: Documents at least this far from the pivot may escape its sight.
HORIZON = 0.32
#: Shingles whose minwise values are made at once; tasks that share a pivot's set.
BLOCK, SALTS = 4096, 256
#: Words of 64 bits that tell which texts are asked for (2 MB, 6 MB as rows).
FILTER = 1 << 18
#: Shingles that the sets of a leaf have at most, as a task holds them all (32 MB), and how many
#: different ones are counted at once.
TOGETHER, COLUMNS = 1 << 22, 4096

_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(1, 1 << 32, TOKENS, np.uint32) | np.uint32(1)

MEMBER = "node long, id long, n int, s1 long, s2 long"
MEMBERS = [x.split()[0] for x in MEMBER.split(", ")]


def shingle_hashes(text: str | None, width: int = 2) -> np.ndarray:
    """XXH64 of every distinct shingle, sorted: runs of `width` words with A-Z in lower case, or
    all words where there are fewer; empty without a word."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.array([], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    hash_of = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((hash_of(joined[a:b], SEED) for a, b in spans), np.uint64))


def minwise(hashes: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set that is not empty."""
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), BLOCK):
        values = low[at : at + BLOCK, None] * _FACTORS + high[at : at + BLOCK, None]
        np.minimum(least, values.min(axis=0), out=least)
    return least


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer with good avalanche, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, tokens = [], [], []
            for text in batch.column(2):
                own = shingle_hashes(text.as_py(), width)
                sizes.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                values = minwise(own) if len(own) else np.array([], np.uint32)
                tokens.append((values ^ (values >> np.uint32(16))).astype("<u2").tobytes())
            columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], names=["doc_id", "text_key", "n", "set_key", "tokens"]
            )

    return run


def _token_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, TOKENS)


def _children(node: np.ndarray, tokens: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) of all nodes that rows in `node` reach so many levels on."""
    row = np.arange(len(node))
    for _ in range(levels):
        draw = _mixed(node + np.uint64(0x9E3779B97F4A7C15))
        twice = np.flatnonzero((draw >> np.uint64(32)) < np.uint64(1 << 30))  # one node in four
        second = _mixed(draw[twice])
        chosen = np.concatenate([draw, second]) % np.uint64(TOKENS)
        row = np.concatenate([row, row[twice]])
        value = tokens[row, chosen.astype(np.int64)].astype(np.uint64)
        node = _mixed(np.concatenate([draw, second]) ^ _mixed((chosen << np.uint64(16)) + value))
    return row, node


def _batch(node: np.ndarray, columns: list[pa.Array], row: np.ndarray) -> pa.RecordBatch:
    at = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [pa.array(node.view(np.int64)), *[c.take(at) for c in columns]], names=MEMBERS
    )


def _planted(trees: int):
    """From sets (id, n, tokens) to their nodes after the first levels of all trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = _token_matrix(batch.column(2))
            bits = (tokens.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(31)
            sketch = np.packbits(bits.astype(bool), axis=1).view("<i8")
            columns = [batch.column(0), batch.column(1), pa.array(sketch[:, 0]), pa.array(sketch[:, 1])]
            for tree in range(trees):
                root = np.full(len(tokens), tree + 1, np.uint64)
                row, node = _children(root, tokens, FIRST_LEVELS)
                yield _batch(node, columns, row)

    return run


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From members of large nodes with their tokens to the nodes some levels on."""
    for batch in batches:
        node = batch.column(0).to_numpy().view(np.uint64)
        row, node = _children(node, _token_matrix(batch.column(5)), MORE_LEVELS)
        yield _batch(node, batch.columns[1:5], row)


def _alike_in_leaves(percent: int, by_component: bool):
    """Sketch comparison of everything in the nodes of a partition sorted by node and id.

    A row (node, id, n, s1, s2, differing, closest) for every member that resembles another;
    `closest` is the one with the fewest differing bits among those of smaller id, null if there
    is none. By component, only members of different components count.
    """

    def pairs_of(node, n, s1, s2, label) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        left, right, bits = [], [], []
        at = np.arange(len(node))
        for step in range(1, len(node)):
            # whose node still goes on so many rows later; they only get fewer
            at = at[: np.searchsorted(at, len(node) - step)]
            at = at[node[at + step] == node[at]]
            if not len(at):
                break
            to = at + step
            near = np.bitwise_count(s1[at] ^ s1[to]).astype(np.int64) + np.bitwise_count(s2[at] ^ s2[to])
            fits = (near <= TOKENS - ALIKE) & (100 * np.minimum(n[at], n[to]) >= percent * np.maximum(n[at], n[to]))
            if label is not None:
                fits &= label[at] != label[to]
            left.append(at[fits])
            right.append(to[fits])
            bits.append(near[fits])
        none = [np.array([], np.int64)]
        return tuple(np.concatenate(x or none) for x in (left, right, bits))

    def settled(rows: list[np.ndarray]) -> pa.RecordBatch:
        node, ident, n, s1, s2 = rows[:5]
        a, b, near = pairs_of(node, n.astype(np.int64), s1.view(np.uint64), s2.view(np.uint64), rows[5] if by_component else None)
        order = np.lexsort((a, near, b))
        has, at = np.unique(b[order], return_index=True)
        closest, differing = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        closest[has], differing[has] = ident[a[order][at]], near[order][at]
        keep = np.union1d(a, b)
        alone = ~np.isin(keep, has)
        found = [pa.array(differing[keep], mask=alone), pa.array(closest[keep], mask=alone)]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c[keep]) for c in rows[:5]], *found], names=[*MEMBERS, "differing", "closest"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            more = [c.to_numpy() for c in batch.columns]
            held = more if held is None else [np.concatenate(x) for x in zip(held, more, strict=True)]
            if not len(held[0]):
                continue
            last = int(np.searchsorted(held[0], held[0][-1]))  # the last node may go on
            if last:
                yield settled([c[:last] for c in held])
                held = [c[last:] for c in held]
        if held is not None and len(held[0]):
            yield settled(held)

    return run


def _shingled(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.sort(shingle_hashes(t.as_py(), width).view(np.int64)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.list_(pa.int64()))], names=["id", "shingles"]
            )

    return run


class Sets:
    """The distinct sets of a table of texts, and the full sets of those asked for."""

    def __init__(self, docs: DataFrame, width: int, id_col: str, text_col: str):
        self.width = width
        self.texts = docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.xxhash64(F.col(text_col)).alias("text_key"),
            F.col(text_col).alias("text"),
        )
        self.prints = durable(
            self.texts.mapInArrow(_prints(width), "doc_id long, text_key long, n long, set_key binary, tokens binary")
        )
        owner = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
        distinct = self.prints.filter("n > 0").groupBy("set_key").agg(
            F.first("n").cast("int").alias("n"), F.first("tokens").alias("tokens"), F.min(owner).alias("owner")
        )
        # numbers are drawn once, as the frame is written
        self.distinct = durable(distinct.withColumn("id", F.monotonically_increasing_id()))

    def asked(self, owners: DataFrame) -> DataFrame:
        """The texts whose keys `owners` has, and some by chance, picked where they are read.

        One bit stands for a key. Where there are more keys than bits most texts pass; the join
        with the owners decides.
        """
        word, bit = F.pmod("text_key", F.lit(FILTER)), F.pmod(F.shiftright("text_key", 40), F.lit(64)).cast("int")
        of = owners.select(F.col("key").alias("text_key")).select(word.alias("word"), bit.alias("bit"))
        bits = of.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        return self.texts.join(F.broadcast(bits), word == F.col("word")).filter(F.getbit("bits", bit) == 1).select(
            "doc_id", "text_key", "text"
        )

    def full(self, pairs: DataFrame) -> DataFrame:
        """(id, shingles) of all sets in pairs (a, b)."""
        wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        # written as a table, so that its size is known when the join is planned
        owners = stored(
            self.distinct.join(wanted, "id").select(
                "id", F.col("owner.doc_id").alias("of"), F.col("owner.text_key").alias("key")
            ),
            "owners",
        )
        own = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("key"))
        texts = self.asked(owners).join(owners, own).select("id", "text").dropDuplicates(["id"])
        return durable(texts.mapInArrow(_shingled(self.width), "id long, shingles array<long>"))

    def compared(self, pairs: DataFrame) -> DataFrame:
        """(a, b, common, total): intersection and union of the full sets of pairs (a, b).

        A set with very many partners goes to as many tasks as `SALTS`, never more than it has
        partners.
        """
        full = self.full(pairs)
        salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
        left = salted.select("a", "salt").distinct().join(
            full.select(F.col("id").alias("a"), F.col("shingles").alias("own")), "a"
        )
        right = salted.join(full.select(F.col("id").alias("b"), "shingles"), "b")
        common = F.size(F.array_intersect("own", "shingles")).cast("long")
        joined = right.join(left, ["a", "salt"]).select(
            "a", "b", common.alias("common"), (F.size("own") + F.size("shingles")).cast("long").alias("both")
        )
        return durable(joined.select("a", "b", "common", (F.col("both") - F.col("common")).alias("total")))


def _links_in_leaves(percent: int):
    """From (node, id, shingles) sorted by node: a forest (a, b) of the exact links of each."""

    def settled(ids: list[int], own: list[np.ndarray]) -> list[tuple[int, int]]:
        common = np.zeros((len(own), len(own)), np.int64)
        row = np.repeat(np.arange(len(own)), [len(x) for x in own])
        every = np.concatenate(own)
        order = np.argsort(every, kind="stable")
        every, row = every[order], row[order]
        column = np.cumsum(np.concatenate([[0], (every[1:] != every[:-1]).astype(np.int64)]))
        for first in range(0, int(column[-1]) + 1, COLUMNS):
            part = slice(*np.searchsorted(column, [first, first + COLUMNS]))
            held = np.zeros((len(own), COLUMNS), np.float32)
            held[row[part], column[part] - first] = 1
            common += (held @ held.T).astype(np.int64)  # at most COLUMNS, exact in 32 bits
        sizes = common.diagonal()
        linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        root, links = np.arange(len(own)), []
        for i in range(1, len(own)):
            for group in np.unique(root[:i][linked[i, :i]]).tolist():
                if group != root[i]:
                    beside = np.flatnonzero(linked[i, :i] & (root[:i] == group))[0]
                    links.append((ids[int(beside)], ids[i]))
                    root[root == root[i]] = group
        return links

    def batch_of(links: list[tuple[int, int]]) -> pa.RecordBatch:
        columns = [pa.array([x[i] for x in links], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, own = None, [], []
        for batch in batches:
            shingles = (x.values.to_numpy() for x in batch.column(2))
            for at, ident, mine in zip(*(batch.column(i).to_pylist() for i in range(2)), shingles, strict=True):
                if at != node and len(ids) > 1:
                    yield batch_of(settled(ids, own))
                if at != node:
                    node, ids, own = at, [], []
                ids.append(ident)
                own.append(mine)
        if len(ids) > 1:
            yield batch_of(settled(ids, own))

    return run


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    return compared.filter(100 * F.col("common") >= percent * F.col("total")).select("a", "b")


def _agreeing(s1: str, s2: str) -> Column:
    differing = F.bit_count(F.col("s1").bitwiseXOR(F.col(s1))) + F.bit_count(F.col("s2").bitwiseXOR(F.col(s2)))
    return F.lit(TOKENS) - differing


def _in_parts(placed: DataFrame) -> DataFrame:
    """Members of leaves, with a node for every two parts of a leaf in place of a large one."""
    own = F.pmod(F.xxhash64("id"), F.col("parts"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda part: part != own)
    both = F.transform(others, lambda part: F.xxhash64("node", F.least(part, own), F.greatest(part, own)))
    nodes = F.when(F.col("parts") > 2, both).otherwise(F.array("node"))
    return placed.withColumn("node", F.explode(nodes)).select(*MEMBERS)


def _leaves(members: DataFrame) -> DataFrame:
    return members.repartition("node").sortWithinPartitions("node", "id")


def set_links(sets: Sets, percent: int = 80, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) between ids of `sets` that connect what links of at least `percent` do."""
    tokens = sets.distinct.select(F.col("id").alias("of"), "tokens")
    links, alike, level = None, None, 0
    members = durable(sets.distinct.select("id", "n", "tokens").mapInArrow(_planted(trees), MEMBER))
    farthest = 1 - percent / 100
    while True:
        drawn = F.xxhash64("id", F.lit(level))
        nodes = members.groupBy("node").agg(
            F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.min(F.struct(drawn.alias("d"), "id", "s1", "s2")).alias("pivot")
        ).filter("size > 1")
        nodes = durable(
            nodes.select(
                F.col("node").alias("at"), ((F.col("size") <= leaf) & (F.col("weight") <= TOGETHER)).alias("is_leaf"), F.col("pivot.id").alias("p"),
                F.col("pivot.s1").alias("p1"), F.col("pivot.s2").alias("p2"), F.ceil(F.col("size") * 2 / ABREAST).alias("parts"),
            )
        )
        placed = members.join(nodes, F.col("node") == F.col("at")).drop("at")
        found = durable(
            _leaves(_in_parts(placed.filter("is_leaf"))).mapInArrow(
                _alike_in_leaves(percent, False), MEMBER + ", differing long, closest long"
            )
        )
        alike = found if alike is None else alike.union(found)
        if nodes.filter("not is_leaf").isEmpty():
            break
        large = durable(placed.filter("not is_leaf").drop("parts").withColumn("seen", _agreeing("p1", "p2") >= IN_SIGHT))
        seen = large.filter("seen and id <> p")
        compared = sets.compared(seen.select(F.col("p").alias("a"), F.col("id").alias("b")).distinct())
        own = _linked(compared, percent)
        links = own if links is None else links.union(own)
        # what a pivot sees beyond its links, in each of its nodes
        away = compared.select(
            F.col("a").alias("from"), F.col("b").alias("to"), (1 - F.col("common") / F.col("total")).alias("distance"),
            (100 * F.col("common") >= percent * F.col("total")).alias("linked"),
        )
        ranged = durable(
            seen.join(away, (F.col("p") == F.col("from")) & (F.col("id") == F.col("to"))).select(
                "node", "id", "distance", "linked"
            )
        )
        nearest = durable(
            ranged.filter("not linked").groupBy("node").agg(F.min("distance").alias("edge"))
        ).withColumnRenamed("node", "beside")
        edge = F.least(F.coalesce("edge", F.lit(HORIZON)), F.lit(HORIZON))
        settled = ranged.filter("linked").join(nearest, F.col("node") == F.col("beside"), "left").filter(
            F.col("distance") + farthest < edge
        )
        settled = settled.select(F.col("node").alias("in"), F.col("id").alias("gone"))
        left = large.filter("id <> p").join(
            durable(settled), (F.col("node") == F.col("in")) & (F.col("id") == F.col("gone")), "left_anti"
        )
        grown = left.select(*MEMBERS).join(tokens, F.col("id") == F.col("of")).select(*MEMBERS, "tokens")
        members = durable(grown.mapInArrow(_grown, MEMBER))
        level += 1
    closest = alike.filter("closest is not null").groupBy("id").agg(
        F.min(F.struct("differing", "closest")).alias("best")
    )
    own = _linked(sets.compared(closest.select(F.col("best.closest").alias("a"), F.col("id").alias("b"))), percent)
    links = durable(own if links is None else links.union(own))
    roots = components(links)
    labelled = alike.join(roots.select(F.col("node").alias("of"), "root"), F.col("id") == F.col("of"), "left")
    label = F.coalesce("root", "id").alias("label")
    apart = durable(
        _leaves(labelled.select(*MEMBERS, label))
        .mapInArrow(_alike_in_leaves(percent, True), MEMBER + ", differing long, closest long")
        .select("node", "id")
    )
    if apart.isEmpty():
        return links
    full = sets.full(apart.select(F.col("id").alias("a"), F.col("id").alias("b")))
    brought = _leaves(apart.join(full, "id").select("node", "id", "shingles"))
    return links.union(brought.mapInArrow(_links_in_leaves(percent), "a long, b long"))


def near_duplicates(
    docs: DataFrame,
    width: int = 2,
    percent: int = 80,
    trees: int = TREES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs`.

    Documents are linked where their sets of `width`-word shingles share at least `percent` of
    their union; component_id is the smallest doc_id reachable, and kept tells whether it is the
    row's own. Equal sets are one set throughout and always linked. Texts without a word (null,
    empty, white space) have an empty set and are linked with nothing. Repeated rows keep a row
    each, and rows that repeat an id are told apart by their sets. A null id comes after all
    others; it takes the component of rows that have ids, or null, and is never kept. An empty
    table gives no rows; other columns are not read.
    """
    sets = Sets(docs, width, id_col, text_col)
    roots = components(set_links(sets, percent, trees))
    member = durable(
        sets.distinct.select("id", "set_key", F.col("owner.doc_id").alias("least")).join(
            roots, F.col("id") == F.col("node"), "left"
        ).select("set_key", "least", F.coalesce("root", "id").alias("group"))
    )
    lowest = durable(member.groupBy("group").agg(F.min("least").alias("component_id"))).withColumnRenamed("group", "of")
    named = durable(
        member.join(lowest, F.col("group") == F.col("of")).select(F.col("set_key").alias("key"), "component_id")
    )
    with_words = sets.prints.filter("n > 0").join(named, F.col("set_key") == F.col("key"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    alone = sets.prints.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return with_words.select(*columns).union(alone.select(*columns)).withColumn("kept", kept)
