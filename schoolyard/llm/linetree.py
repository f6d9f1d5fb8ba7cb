"""Line deduplication with a log-template tree.

Every line goes down a tree of fixed depth: first by its number of tokens, then by its leading
tokens, where tokens with a digit count as variable. In a leaf, a token that few documents have
at its place is a variable field; what remains, constants and `<*>`, is the line's template. A
template that recurs in many documents is boilerplate, and its lines are dropped.

Copies of one document repeat all their lines and are not boilerplate; other operators look for
them. Exact copies therefore count once, and a template must recur in documents that differ
otherwise: each text has a signature for a leaf, the smallest and the largest of its other
leaves, and texts with the same signature count once. A text that has no other leaf counts by
its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolyard.llm.common import durable, free_name, gathered

VARIABLE = b"<*>"
_DIGIT = re.compile(rb"[0-9]")


@dataclass(frozen=True)
class TreeRules:
    #: Leading tokens on the path to a leaf, after the number of tokens.
    depth: int = 3
    #: Different texts in which a template recurs, and a constant token stands at its place: at
    #: least so many, whatever the size of the table. A share of the table can be asked for
    #: beside it, but then rows that have nothing to do with a line decide whether it stays.
    min_texts: int = 10
    min_texts_per_million: int = 0
    #: Percent of a template's words, the tokens without a digit, that are constant. Fields with
    #: a digit are variable anyway and do not count; a template has at least one constant.
    constant_percent: int = 60
    #: Bits of the filter that spares lines of leaves which nothing recurs in; bounds its size.
    #: When more leaves recur than it has bits, it lets all lines pass, and results are the same.
    filter_bits: int = 1 << 20


def parsed(line: bytes, depth: int) -> tuple[int, list[bytes]] | None:
    """The leaf of a line (signed 64-bit hash of its path) and its tokens; None if it has none."""
    tokens = line.split()
    if not tokens:
        return None
    if _DIGIT.search(line):
        tokens = [VARIABLE if _DIGIT.search(t) else t for t in tokens]
    path = b"%d %s" % (len(tokens), b" ".join(tokens[:depth]))
    return _signed(xxhash.xxh64_intdigest(path)), tokens


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _lines_of(text: str | None, depth: int) -> list[tuple[int, int, list[bytes]]]:
    """(line number, leaf, tokens) of the lines with a token."""
    found = []
    for number, line in enumerate((text or "").encode("utf-8").split(b"\n")):
        if at := parsed(line, depth):
            found.append((number, *at))
    return found


def _signatures(lines: list[tuple[int, int, list[bytes]]], key: int) -> dict[int, int]:
    """For each leaf of a text, a hash of the smallest and the largest of the others."""
    leaves = sorted({leaf for _, leaf, _ in lines})
    if len(leaves) == 1:
        return {leaves[0]: key}
    found = {}
    for leaf in leaves:
        low, high = leaves[leaf == leaves[0]], leaves[-2 if leaf == leaves[-1] else -1]
        found[leaf] = (low, high)
    hashed = {ends: _signed(xxhash.xxh64_intdigest(b"%d %d" % ends)) for ends in set(found.values())}
    return {leaf: hashed[ends] for leaf, ends in found.items()}


def _leaves(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[int]] = [[], []]
            for key, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if lines := _lines_of(text.as_py(), depth):
                    signatures = _signatures(lines, key)
                    columns[0] += signatures.keys()
                    columns[1] += signatures.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["leaf", "signature"]
            )

    return run


def _recurring(seen: DataFrame, by: str, enough: int) -> DataFrame:
    """The values of `by` that recur in enough texts, those with the same signature counted once.

    `seen` has rows of a value and a signature.
    """
    counted = seen.select(by, "signature").distinct().groupBy(by).agg(F.count(F.lit(1)).alias("own"))
    return counted.filter(F.col("own") >= enough).select(by)


LINE = "doc_id long, text_key long, number int, leaf long, line long, signature long, tokens array<int>"


def _lines(rules: TreeRules, wanted):
    """Lines whose leaf has its bit set in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8), bitorder="little")
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            hashes: list[int] = []
            ends = [0]
            rows = zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2), strict=True)
            for doc_id, key, text in rows:
                lines = _lines_of(text.as_py(), rules.depth)
                picked = [x for x in lines if bits[x[1] % rules.filter_bits]]
                signatures = _signatures(lines, key) if picked else {}
                for number, leaf, tokens in picked:
                    line = _signed(xxhash.xxh64_intdigest(b" ".join(tokens)))
                    for column, x in zip(columns, (doc_id, key, number, leaf, line, signatures[leaf]), strict=True):
                        column.append(x)
                    hashes += [0 if t == VARIABLE else xxhash.xxh32_intdigest(t) | 1 for t in tokens]
                    ends.append(len(hashes))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            tokens = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.array(hashes, np.uint32).view(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(columns, kinds, strict=True)), tokens],
                names=[c.split()[0] for c in LINE.split(", ")],
            )

    return run


def _filter_of(leaves: DataFrame, bits: int) -> bytes:
    """One bit for each leaf, by its hash; at most `bits` numbers come to the driver."""
    places = leaves.select(F.pmod("leaf", F.lit(bits)).cast("int").alias("bit")).distinct()
    table = np.zeros(bits, np.uint8)
    table[places.toPandas()["bit"].to_numpy(np.int64)] = 1
    return np.packbits(table, bitorder="little").tobytes()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
        F.col(text_col).alias("text"),
    )


def recurring_lines(
    docs: DataFrame, rules: TreeRules = TreeRules(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_key, numbers): for each text with such lines, the places (from 0) of its
    lines whose template recurs. text_key is xxhash64 of the text."""
    enough = rules.min_texts
    if rules.min_texts_per_million:
        enough = max(enough, -(-docs.count() * rules.min_texts_per_million // 1_000_000))
    keyed = _keyed(docs, id_col, text_col)
    leaves = keyed.mapInArrow(_leaves(rules.depth), "leaf long, signature long")
    hot = _recurring(leaves, "leaf", enough)
    wanted = docs.sparkSession.sparkContext.broadcast(_filter_of(hot, rules.filter_bits))
    lines = durable(keyed.mapInArrow(_lines(rules, wanted), LINE))

    # Distinct lines of a leaf, with the texts they are in; their tokens place by place.
    texts = lines.select("leaf", "line", "text_key").distinct()
    texts = texts.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("texts"))
    token_lists = lines.groupBy("leaf", "line").agg(F.min("tokens").alias("tokens"))
    distinct = texts.join(token_lists, ["leaf", "line"])
    placed = distinct.select("leaf", "line", "texts", F.posexplode("tokens").alias("place", "token"))
    constants = placed.filter("token <> 0").groupBy("leaf", "place", "token").agg(F.sum("texts").alias("n"))
    constants = constants.filter(F.col("n") >= enough).select(
        F.col("leaf").alias("of"), F.col("place").alias("at"), F.col("token").alias("constant")
    )
    marked = placed.join(
        constants,
        (F.col("leaf") == F.col("of")) & (F.col("place") == F.col("at")) & (F.col("token") == F.col("constant")),
        "left",
    )
    templates = marked.groupBy("leaf", "line").agg(
        F.sort_array(
            F.collect_list(F.when(F.col("constant").isNotNull(), F.struct("place", "token")))
        ).alias("constants"),
        F.count_if(F.col("token") != 0).alias("words"),
    )
    constant = F.size("constants")
    templates = templates.filter((constant > 0) & (constant * 100 >= F.col("words") * rules.constant_percent))
    # written, so that the join shuffles both sides and adaptive execution can split a line that
    # very many texts have; the grouping's own partitions it could not
    templates = gathered(templates.select("leaf", "line", F.xxhash64("leaf", "constants").alias("template")))

    found = lines.select("doc_id", "text_key", "number", "leaf", "line", "signature").join(
        templates, ["leaf", "line"]
    )
    found = gathered(found.select("doc_id", "text_key", "number", "template", "signature"))
    drop = _recurring(found, "template", enough)
    return (
        found.join(drop, "template")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("number").alias("numbers"))
    )


def drop_recurring_lines(
    docs: DataFrame, rules: TreeRules = TreeRules(), id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, str]:
    """`docs` with the same rows and columns, recurring lines cut out of the texts, and one more
    column with the number of lines cut, whose name is returned beside the frame.

    Lines are split at \\n; lines without a token stay. A null text stays null, an empty one
    empty, and a text that loses all its lines becomes empty; no row is dropped. Repeated rows
    are treated alike, also with a null id. Long texts are read whole, a line at a time.
    """
    found = recurring_lines(docs, rules, id_col, text_col)
    key, numbers, owner, other, cut = (
        free_name(docs, x) for x in ("text_key", "cut_numbers", "cut_id", "cut_key", "lines_cut")
    )
    found = found.toDF(owner, other, numbers)
    joined = docs.withColumn(key, F.xxhash64(F.col(text_col))).join(
        found,
        F.col(id_col).cast("long").eqNullSafe(F.col(owner)) & (F.col(key) == F.col(other)),
        "left",
    )
    left = F.array_join(
        F.filter(
            F.split(F.col(text_col), "\n"), lambda _, i: ~F.array_contains(F.col(numbers), i)
        ),
        "\n",
    )
    text = F.when(F.col(numbers).isNull(), F.col(text_col)).otherwise(left)
    columns = [text.alias(text_col) if c == text_col else F.col(c) for c in docs.columns]
    return joined.select(*columns, F.coalesce(F.size(numbers), F.lit(0)).alias(cut)), cut
