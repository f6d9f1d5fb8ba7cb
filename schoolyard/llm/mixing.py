"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source's target divided by its size is the number of copies that each of its documents is
due. The whole part is certain. The fractional parts are rounded in dependence of each other:
two documents are paired and words are moved from the fraction of one to that of the other, in
a random direction whose chances keep both expectations, until one fraction is 0 or 1. The
words of the pair stay the same, so in the end only the last fraction of a source is rounded by
itself, and the source misses its target by less than that one document.

The largest documents of a source come first, each paired with all smaller ones as a pool: it
becomes whole, and the pool's common fraction takes what it gave or got. So no single document
is left over that outweighs its source. The others are paired within chunks of a bounded number
of units. What a chunk leaves is one
unit with a fraction; these residuals are chunked and paired again, level by level, until a
source has one residual left. Larger documents go first, so that the last ones are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schoolyard.llm.common import SPACES, free_name, gathered

#: Units that a chunk is expected to hold; a fold copies its list of settled units.
CHUNK = 200
#: Largest units of a source that are settled against the pool of its smaller ones.
LARGEST = 64
#: Repetitions of equal rows that one row unfolds into.
REPEATS = 10_000
#: A source gets at most this multiple of its size.
MOST = 3.0
WEIGHTS = (1, 2, 3)


def words(text: Column) -> Column:
    """Number of words (runs of anything but ASCII white space); 0 for null."""
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    return F.coalesce(F.size(F.array_remove(F.split(spaced, " "), "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Adds `target` to (source, source_size): the sum of all sizes by weight, up to `most` times.

    The excess over a source's limit goes to the others by weight until none is above, which is
    the level at which the sum of min(weight x level, limit) is the sum of sizes. Sources take
    the weights in turn by code point, null last. There is a row per source here, no more; one
    task numbers them.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.select(
        "source",
        F.col("source_size"),
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")).alias("weight"),
    )
    limit = F.col("source_size") * F.lit(float(most))
    # those whose limit per weight is lowest are full first
    by_limit = Window.orderBy("limit_each", F.col("source").isNull(), "source")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = weighed.withColumn("limit_each", limit / F.col("weight"))
    ranked = ranked.withColumn("total", F.sum("source_size").over(everything))
    level = (F.col("total") - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    ranked = ranked.withColumn("level", level)
    # the first that is not full tells the level for all from it on
    not_full = F.when(F.col("level") <= F.col("limit_each"), F.col("level"))
    reached = F.first(not_full, ignorenulls=True).over(everything)
    target = F.when(reached.isNull(), limit).otherwise(F.least(limit, F.col("weight") * reached))
    return ranked.select("source", "source_size", target.alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) drawn from a hash, the same in every run."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _chunks(units: DataFrame, level: int, seed: int, chunk: int) -> DataFrame:
    """Rows of one chunk each: its units settled to a whole number of copies, and its residual.

    `units` has source, doc_id, size, rep, whole (certain copies) and part (fraction due).
    """
    key = F.xxhash64(F.lit(seed), F.lit(level), "doc_id", "size", "rep")
    counted = units.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.select(F.col("source").alias("of"), F.ceil(F.col("n") / chunk).alias("chunks"))
    dealt = units.join(counted, F.col("source").eqNullSafe(F.col("of")))
    dealt = dealt.withColumn("chunk", F.pmod(key, F.col("chunks")))
    unit = F.struct(
        (-F.col("size")).alias("order"), "doc_id", "rep", "size", "whole", "part"
    )
    listed = dealt.groupBy("source", "chunk").agg(
        F.sort_array(F.collect_list(unit)).alias("units"), F.first("chunks").alias("chunks")
    )
    nothing = F.slice("units", 1, 0)
    first = F.element_at("units", 1)

    def settled(u: Column, extra: Column) -> Column:
        return F.array(u.withField("whole", u["whole"] + extra).withField("part", F.lit(0.0)))

    def pair(state: Column, u: Column) -> Column:
        """Moves words between the open unit `o` and the next unit `u`."""
        o = state["open"]
        up = F.least(o["size"] * (1 - o["part"]), u["size"] * u["part"])  # words that o can gain
        down = F.least(o["size"] * o["part"], u["size"] * (1 - u["part"]))  # and lose
        gains = _uniform(F.lit(seed + 1), o["doc_id"], o["rep"], u["doc_id"], u["rep"], F.lit(level)) * (
            up + down
        ) < down
        # which of the two is whole afterwards; the exact bound decides, not the rounded sum
        o_full = gains & (o["size"] * (1 - o["part"]) <= u["size"] * u["part"])
        o_none = ~gains & (o["size"] * o["part"] <= u["size"] * (1 - u["part"]))
        moved = F.when(gains, up).otherwise(-down)
        new_o = o.withField("part", F.least(F.lit(1.0), F.greatest(F.lit(0.0), o["part"] + moved / o["size"])))
        new_u = u.withField("part", F.least(F.lit(1.0), F.greatest(F.lit(0.0), u["part"] - moved / u["size"])))
        o_ends = o_full | o_none
        return F.struct(
            F.when(o_ends, new_u).otherwise(new_o).alias("open"),
            F.concat(
                state["done"],
                F.when(o_ends, settled(o, o_full.cast("int"))).otherwise(settled(u, (~gains).cast("int"))),
            ).alias("done"),
        )

    start = F.struct(first.alias("open"), nothing.alias("done"))
    folded = F.aggregate(F.slice("units", 2, F.greatest(F.lit(1), F.size("units"))), start, pair)
    return listed.select("source", "chunks", folded.alias("fold"))


def _against_pool(units: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(settled, open): the largest units of each source made whole, and the others with the
    fraction that this leaves them.

    All open units of a source start with one fraction p of their words R. Taking a unit of s
    words with chance p leaves the others (p R - s) / (R - s) of theirs, not taking it
    p R / (R - s): on average p again. A unit for which one of these is no fraction, and all
    smaller ones, stay open.
    """
    ranked = Window.partitionBy("source").orderBy(F.desc("size"), "doc_id", "rep")
    top = units.withColumn("nth", F.row_number().over(ranked)).filter(F.col("nth") <= LARGEST)
    unit = F.struct("nth", "doc_id", "rep", "size", "whole")
    listed = top.groupBy("source").agg(F.sort_array(F.collect_list(unit)).alias("top"))
    pools = units.groupBy("source").agg(
        F.sum("size").cast("double").alias("pool"), F.first("part").alias("share")
    )
    pools = pools.select(F.col("source").alias("of"), "pool", "share")
    sources = listed.join(pools, F.col("source").eqNullSafe(F.col("of"))).drop("of")

    def settle(state: Column, u: Column) -> Column:
        p, rest = state["share"], state["pool"] - u["size"]
        words = p * state["pool"]
        fits = state["going"] & (rest > 0) & (u["size"] <= words) & (words <= rest)
        takes = _uniform(F.lit(seed + 3), u["doc_id"], u["rep"], u["nth"]) < p
        left = (words - F.when(takes, u["size"]).otherwise(0)) / rest
        made = F.array(u.withField("whole", u["whole"] + takes.cast("int")))
        return F.struct(
            F.when(fits, F.least(F.lit(1.0), F.greatest(F.lit(0.0), left))).otherwise(p).alias("share"),
            F.when(fits, rest).otherwise(state["pool"]).alias("pool"),
            fits.alias("going"),
            F.when(fits, F.concat(state["done"], made)).otherwise(state["done"]).alias("done"),
        )

    start = F.struct("share", "pool", F.lit(True).alias("going"), F.slice("top", 1, 0).alias("done"))
    folded = gathered(sources.select("source", F.aggregate("top", start, settle).alias("fold")))
    settled = folded.select("source", F.inline("fold.done")).withColumn("part", F.lit(0.0)).drop("nth")
    gone = settled.select(*[F.col(c).alias(f"gone_{c}") for c in ("source", "doc_id", "size", "rep")])
    same = [F.col(c).eqNullSafe(F.col(f"gone_{c}")) for c in ("source", "doc_id", "size", "rep")]
    shares = folded.select(F.col("source").alias("of"), F.col("fold.share").alias("share"))
    rest = units.join(gone, same, "left_anti").join(shares, F.col("source").eqNullSafe(F.col("of")))
    return settled, rest.withColumn("part", F.col("share")).drop("of", "share")


def copies(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
    seed: int = 7,
    chunk: int = CHUNK,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source, rep, source_size, target, copies.

    size is the number of words (null text: 0), copies how often the mix takes the document,
    and `copies * size` the words it takes; it is at most `most` rounded up, and a source that
    is due no more than `most` times its size never takes more. Rows that agree in id, source
    and size are numbered by `rep` from 1, as nothing else tells them apart; they are counted
    before they are moved. Documents without words take the whole copies they are due. Draws
    come from hashes of ids and `seed`, so reruns agree however the table is partitioned. A
    null source is a source of its own, the last. An empty table gives no rows. Other columns
    are not read.
    """
    light = docs.select(
        F.col(source_col).cast("string").alias("source"),
        F.col(id_col).cast("long").alias("doc_id"),
        words(F.col(text_col)).alias("size"),
    )
    # equal rows once, with their number: a hot id costs a row
    counted = gathered(light.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")))
    by_source = counted.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    wanted = gathered(targets(by_source, weights, most))
    due = wanted.select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)).alias("each"),
    )
    steps = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / REPEATS))
    blocks = counted.withColumn("block", F.explode(steps))
    last = F.least(F.col("n"), (F.col("block") + 1) * REPEATS)
    units = blocks.withColumn("rep", F.explode(F.sequence(F.col("block") * REPEATS + 1, last)))
    units = units.join(due, F.col("source").eqNullSafe(F.col("of"))).select(
        "source",
        "doc_id",
        "size",
        "rep",
        F.floor("each").cast("int").alias("whole"),
        (F.col("each") - F.floor("each")).alias("part"),
    )
    settled, rest = _against_pool(units.filter("part > 0 and size > 0"), seed)
    rest = gathered(rest)
    open_units = rest.filter("part > 0 and part < 1")
    # a pool that is used up or wholly taken needs no draw
    whole = rest.filter("part <= 0 or part >= 1").withColumn("whole", F.col("whole") + F.col("part").cast("int"))
    done = [units.filter("part = 0 or size = 0"), settled, whole]
    level = 0
    while True:
        folds = gathered(_chunks(open_units, level, seed, chunk))
        done.append(folds.select("source", F.inline("fold.done")).drop("order"))
        rest = folds.select("source", "chunks", "fold.open.*").drop("order")
        # the last residual of a source: one draw by itself, or none if it has become whole
        alone = rest.filter("chunks = 1 or part <= 0 or part >= 1").drop("chunks")
        draw = F.when(_uniform(F.lit(seed + 2), F.col("doc_id"), F.col("rep")) < F.col("part"), 1).otherwise(0)
        done.append(alone.withColumn("whole", F.col("whole") + draw))
        open_units = rest.filter("chunks > 1 and part > 0 and part < 1").drop("chunks")
        if folds.filter("chunks > 1").isEmpty():
            break
        level += 1
    columns = ["source", "doc_id", "size", "rep", "whole"]
    settled = done[0].select(columns)
    for more in done[1:]:
        settled = settled.unionByName(more.select(columns))
    return settled.join(due.drop("each"), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id",
        "size",
        "source",
        "rep",
        "source_size",
        "target",
        F.col("whole").alias("copies"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mixed documents: each row of `docs`, with all its columns, as often as it is taken.

    Of rows that agree in id, source and size, which share one set of copies, each takes an
    equal number and the first ones by content one more.
    """
    taken = copies(docs, weights, most, seed, id_col=id_col, text_col=text_col, source_col=source_col)
    shares = gathered(
        taken.groupBy("source", "doc_id", "size").agg(
            F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")
        )
    )
    size, n, m, nth = (free_name(docs, x) for x in ("mix_size", "mix_copies", "mix_rows", "mix_nth"))
    keys = [free_name(docs, x) for x in ("mix_source", "mix_id", "mix_words")]
    shares = shares.toDF(*keys, n, m)
    sized = docs.withColumn(size, words(F.col(text_col)))
    joined = sized.join(
        shares,
        F.col(source_col).cast("string").eqNullSafe(F.col(keys[0]))
        & F.col(id_col).cast("long").eqNullSafe(F.col(keys[1]))
        & (F.col(size) == F.col(keys[2])),
    )
    single = joined.filter(F.col(m) == 1)
    content = [F.col(c).cast("string") for c, t in docs.dtypes if not t.startswith("map")]
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(*content))
    repeated = joined.filter(F.col(m) > 1).withColumn(nth, F.row_number().over(order))
    whole = F.floor(F.col(n) / F.col(m))
    repeated = repeated.withColumn(n, whole + (F.col(nth) <= F.col(n) - whole * F.col(m)).cast("int"))
    every = single.select(*docs.columns, F.col(n).cast("int").alias(n)).unionByName(
        repeated.select(*docs.columns, F.col(n).cast("int").alias(n))
    )
    return every.withColumn(nth, F.explode(F.array_repeat(F.lit(0), F.col(n)))).select(*docs.columns)
