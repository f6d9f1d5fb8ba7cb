"""Repair of conversation structure at least cost, by depth-first branch and bound.

A repaired conversation is an optional system turn followed by user and assistant turns in
alternation, ending with the assistant. Rows are kept, given another role or deleted, and
empty turns are inserted. The search keeps an explicit stack of partial repairs, a lower bound
of what every suffix still costs, the best whole repair so far (cost and audit string), and for
every (row, state) the best prefix that reached it; a prefix that is worse than one seen at its
node, or cannot beat the incumbent any more, is dropped. When the stack is empty the incumbent
is optimal.

Where a conversation holds a large part of all rows, its rows are coded piece by piece over many
tasks, a character a row; its answer has a letter a row as well, so the codes that meet for the
search are no larger than the answer itself. Texts stream through a hash and are never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard.llm.common import SPACES, durable

RETYPE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3

#: States: what the repaired turns so far end with.
START, SYSTEM, USER, ASSISTANT = range(4)

#: Row codes: the initial of the role (`o` if it fits no turn), upper case if the text breaks
#: off, and `X` where the row has to go.
GONE = "X"


@dataclass(eq=False, slots=True)
class Edits:
    """A partial repair: the last edit and those before it."""

    before: "Edits | None"
    letter: str
    length: int

    def audit(self) -> str:
        letters, node = [], self
        while node.before is not None:
            letters.append(node.letter)
            node = node.before
        return "".join(reversed(letters))


def _sooner(a: Edits, b: Edits) -> bool:
    """Whether the audit of a comes before that of b; what both share is not looked at."""
    of_a, of_b = [], []
    while a is not b:
        if a.length >= b.length:
            of_a.append(a.letter)
            a = a.before
        else:
            of_b.append(b.letter)
            b = b.before
    return of_a[::-1] < of_b[::-1]


def _next_turn(state: int) -> int:
    return ASSISTANT if state == USER else USER


def suffix_bounds(codes: str) -> list[tuple[int, int]]:
    """For every row, what the rows from there on cost at least: (if a user turn comes next, if
    an assistant turn does). A relaxation: system turns may stand anywhere."""
    ahead = (0, INSERT)
    bounds = [ahead]
    for code in reversed(codes):
        costs = []
        for waiting in (0, 1):  # for user, for assistant
            kept, other = ahead[waiting], ahead[1 - waiting]
            options = [DELETE + kept]
            if code != GONE:
                role, late = code.lower(), UNFINISHED if code.isupper() else 0
                options.append(late + RETYPE + other)
                if role == "s":
                    options.append(late + kept)
                elif role == "ua"[waiting]:
                    options.append(late + other)
            costs.append(min(options))
        ahead = (min(costs[0], INSERT + costs[1]), min(costs[1], INSERT + costs[0]))
        bounds.append(ahead)
    return bounds[::-1]


def cheapest_repair(codes: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a row of codes, ties to the ASCII-least audit."""
    n = len(codes)
    bounds = suffix_bounds(codes)
    reached: list[list[tuple[int, Edits] | None]] = [[None] * 4 for _ in range(n + 1)]
    best: tuple[int, Edits] | None = None
    root = Edits(None, "", 0)
    stack = [(0, START, 0, root)]
    while stack:
        row, state, cost, edits = stack.pop()
        if best is not None and cost + bounds[row][state == USER] > best[0]:
            continue
        held = reached[row][state]
        if held is not None and (held[0] < cost or (held[0] == cost and not _sooner(edits, held[1]))):
            continue
        reached[row][state] = (cost, edits)
        if row == n and state in (START, ASSISTANT):
            if best is None or cost < best[0] or (cost == best[0] and _sooner(edits, best[1])):
                best = (cost, edits)
        branches = [(row, _next_turn(state), cost + INSERT, "I")]
        if row < n:
            code = codes[row]
            branches.append((row + 1, state, cost + DELETE, "D"))
            if code != GONE:
                role, late = code.lower(), UNFINISHED if code.isupper() else 0
                turn = _next_turn(state)
                branches.append((row + 1, turn, cost + late + RETYPE, "R"))
                if role == "ua"[turn == ASSISTANT]:
                    branches.append((row + 1, turn, cost + late, "K"))
                elif role == "s" and state == START:
                    branches.append((row + 1, SYSTEM, cost + late, "K"))
        # the most promising on top; the smaller letter first among equals
        branches.sort(key=lambda b: (-(b[2] + bounds[b[0]][b[1] == USER]), -ord(b[3])))
        stack += [(at, to, price, Edits(edits, letter, edits.length + 1)) for at, to, price, letter in branches]
    return best[0], best[1].audit()


def repaired_turns(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of the repaired conversation; rows are read as needed."""
    state = START
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        else:
            state = _next_turn(state)
            role = "user" if state == USER else "assistant"
        yield role, text


def damaged(turns: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, dropped) after damage that follows from crc32 of
    `conv_id:turn`; nulls are written as one space. Dropped rows stay, marked, so that their
    conversation is known."""
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    kind = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def coded(rows: DataFrame) -> DataFrame:
    """The rows with `digest` (of conversation, role and text), the role's `initial`, the last
    character `ending` of the text before white space, and whether they `repeat` an earlier turn.

    The first turn of a digest is a minimum made map-side; it is written before it is joined, so
    that adaptive execution can split a text that fills a conversation.
    """
    conversation = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws("\n", F.col("dropped").cast("string"), conversation, F.length("role"), "role", "text"))
    known = rows.withColumn("digest", digest)
    first = durable(
        known.groupBy("digest").agg(F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unplaced"))
    ).select(F.col("digest").alias("of"), "first", "unplaced")
    later = F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("first")))
    return known.join(first, F.col("digest") == F.col("of")).select(
        "conv_id", "turn", "role", "text", "dropped", "digest",
        F.substring("role", 1, 1).alias("initial"),
        F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1).alias("ending"),
        later.alias("repeats"),
    )


PIECE = (
    "conv_id long, part int, codes string, blank long, duplicate long, truncated long, illegal long, "
    "turns long, first_turn long, last_turn long, first_initial string, last_initial string"
)
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 7, pa.string(), pa.string()]
_PIECE_NAMES = [x.split()[0] for x in PIECE.split(", ")]
LEGAL = ("su", "ua", "au")


GOING = ("blank", "duplicate")


def fault_of(ending: str, repeats: bool) -> str | None:
    """The first fault of a row, from the last character of its text that is no white space."""
    if not ending:
        return "blank"
    if repeats:
        return "duplicate"
    return None if ending in ".!?" else "truncated"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation in a sorted partition: its codes and counts there."""

    def row_of(conv, part: int, codes: list, counts: dict, turns: list, initials: list) -> tuple:
        return (
            conv, part, "".join(codes), counts["blank"], counts["duplicate"], counts["truncated"],
            counts["illegal"], turns[0], turns[1], turns[2], initials[0], initials[1],
        )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_PIECE_TYPES)]
        return pa.RecordBatch.from_arrays(columns, names=_PIECE_NAMES)

    open_piece, before, done = None, None, []
    for batch in batches:
        for conv, turn, initial, ending, repeats, dropped, digest, part in zip(
            *(batch.column(i).to_pylist() for i in range(8)), strict=True
        ):
            if open_piece is None or open_piece[0] != conv:
                if open_piece is not None:
                    done.append(row_of(*open_piece))
                counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
                open_piece = (conv, part, [], counts, [0, None, None], [None, None])
            _, _, codes, counts, turns, initials = open_piece
            if dropped:
                continue
            # a row and its repeats in the same turn are neighbours
            fault = fault_of(ending, repeats or digest == before)
            before = digest
            known = initial if initial in ("s", "u", "a") else "o"
            codes.append(GONE if fault in GOING else known.upper() if fault else known)
            if fault:
                counts[fault] += 1
            if initials[0] is None:
                initials[0] = initial
            elif initials[1] + initial not in LEGAL:
                counts["illegal"] += 1
            initials[1] = initial
            if turn is not None and turn != turns[2]:
                turns[:] = turns[0] + 1, turn if turns[1] is None else turns[1], turn
        if len(done) >= 4096:
            yield batch_of(done)
            done = []
    if open_piece is not None:
        done.append(row_of(*open_piece))
    if done:
        yield batch_of(done)


SOLVED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and cheapest repair of conversations given as lists of pieces in order."""
    names = [x.split()[0] for x in SOLVED.split(", ")]
    for batch in batches:
        out = {name: [] for name in names}
        for conv, pieces in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            counts = {c: sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated", "illegal")}
            distinct, first, last, ended = 0, None, None, None
            for p in pieces:
                if p["turns"]:
                    distinct += p["turns"] - (last is not None and p["first_turn"] == last)
                    first, last = p["first_turn"] if first is None else first, p["last_turn"]
                if p["codes"]:
                    if ended is not None and ended + p["first_initial"] not in LEGAL:
                        counts["illegal"] += 1
                    ended = p["last_initial"]
            cost, audit = cheapest_repair("".join(p["codes"] for p in pieces))
            gaps = 0 if first is None else last - first + 1 - distinct
            found = {"conv_id": conv, "gaps": gaps, **counts, "cost": cost, "audit": audit}
            for name in names:
                out[name].append(found[name])
        types = [*[pa.int64()] * 7, pa.string()]
        columns = [pa.array(out[c], t) for c, t in zip(names, types, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


REPAIRED = SOLVED + ", repaired_sha256 string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The conversations of a sorted partition, each one's answer before its rows."""
    names = [x.split()[0] for x in REPAIRED.split(", ")]
    types = [*[pa.int64()] * 7, pa.string(), pa.string()]

    def entries() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)

    stream = entries()
    entry = next(stream, None)
    done: list[tuple] = []
    while entry is not None:
        answer = entry[:8]

        def rows() -> Iterator[tuple[str, str]]:
            nonlocal entry
            while (entry := next(stream, None)) is not None and entry[8]:
                yield entry[9], entry[10]

        own, digest, between = rows(), hashlib.sha256(), ""
        for role, text in repaired_turns(answer[7], own):
            digest.update(f"{between}{role}:{text}".encode())
            between = "\n"
        for _ in own:  # up to the next conversation's answer
            pass
        done.append((*answer, digest.hexdigest()))
        if len(done) >= 4096 or entry is None:
            columns = [pa.array([r[i] for r in done], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            done = []


def _flag(value: bool) -> Column:
    return F.lit(value).alias("is_row")


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every
    conversation of `rows` (conv_id, turn, role, text, dropped), where no value but conv_id and
    turn is null.

    Rows are taken by turn, nulls first, then by role and by the md5 of conversation, role and
    text; identical rows are repeats of one another. A null conv_id is a conversation like
    others. A conversation whose rows are all dropped has zeros, an empty audit and the hash of
    the empty string. An empty table gives no rows; other columns are not read.
    """
    known = durable(coded(rows))
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "digest")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by range, so that a long conversation is cut in consecutive pieces
    dealt = known.select("conv_id", "turn", "initial", "ending", "repeats", "dropped", "role", "digest")
    ranged = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = ranged.select(
        "conv_id", "turn", "initial", "ending", "repeats", "dropped", "digest", F.spark_partition_id().alias("part")
    )
    pieces = ranged.mapInArrow(_pieces, PIECE)
    # a number of its own: the search takes time that the size of the codes does not show
    whole = pieces.repartition(parts, "conv_id").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("part", *[c for c in _PIECE_NAMES if c not in ("conv_id", "part")])))
    )
    answers = durable(whole.mapInArrow(_solved, SOLVED))
    lines = known.filter(~F.col("dropped")).select(
        "conv_id", *[F.lit(None).cast("long").alias(c) for c in SOLVED_COUNTS], F.lit(None).cast("string").alias("audit"),
        _flag(True), "role", "text", "turn", "digest",
    )
    heads = answers.select(
        "*", _flag(False), *[F.lit(None).cast(t).alias(c) for c, t in
                             (("role", "string"), ("text", "string"), ("turn", "long"), ("digest", "string"))],
    )
    stream = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), "is_row", *order[1:]
    )
    return stream.select(
        "conv_id", *SOLVED_COUNTS, "audit", "is_row", "role", "text"
    ).mapInArrow(_hashed, REPAIRED)


SOLVED_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """`repaired` of the rows of a table of conversations after `damaged`."""
    return repaired(damaged(turns))
