"""Sums of doubles that are exact, and so do not depend on the order of the rows.

Adding doubles rounds at every step, and on a cluster the order of the steps changes with
every shuffle, retry and partition count.  Here a double is taken apart into 24-bit limbs of a
fixed-point number with 62 bits before the point and 72 behind it.  Limbs are added up as
longs, in any order and over any number of groupings, and the total is rounded to a double once,
at the end: it is the double nearest to the true sum.

* Values between 2^-20 and 2^62 in magnitude (1e-6 to 4e18) count with all their bits; smaller
  ones are cut at 2^-72 (2e-22).
* NaN and infinities make the total what IEEE addition makes of them: NaN beside anything is NaN,
  infinity of one sign is that infinity, of both NaN.  Finite values from 2^62 on are added as
  plain doubles beside the limbs.
* No value at all gives NULL.
* A total may hold 2^38 values; beyond that the sum fails rather than wraps.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 24
_MASK = (1 << BITS) - 1
#: Limbs from the highest, which carries the sign, to the lowest; units are 2^48 to 2^-72.
LIMBS = ("w2", "w1", "w0", "p1", "p2", "p3")
#: The type of a total that is still to be added to.
TOTAL = "struct<" + ",".join(f"{n}:bigint" for n in LIMBS) + ",beyond:double>"
_INSIDE = float(1 << 62)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _limbs_of(c: Column) -> list[Column]:
    """The limbs of a double; every step is exact, as it cuts bits off or scales by two's powers."""
    value = F.when(F.abs(c) < _INSIDE, c)
    whole = value.cast("bigint")
    scaled = (value - whole.cast("double")) * F.lit(float(1 << 48))
    upper = scaled.cast("bigint")
    lower = (scaled - upper.cast("double")) * F.lit(float(1 << BITS))

    def low(part: Column) -> Column:
        return part.bitwiseAND(F.lit(_MASK))

    return [
        F.shiftright(whole, 2 * BITS),
        low(F.shiftright(whole, BITS)),
        low(whole),
        F.shiftright(upper, BITS),
        low(upper),
        lower.cast("bigint"),
    ]


def _beyond(c: Column) -> Column:
    return F.when(F.abs(c) >= _INSIDE, c)  # NaN is larger than any number


def _packed(limbs: list[Column], beyond: Column) -> Column:
    none = F.lit(0).cast("bigint")
    named = [F.coalesce(c, none).alias(n) for c, n in zip(limbs, LIMBS, strict=True)]
    return F.struct(*named, beyond.cast("double").alias("beyond"))


def _fields(total: Column) -> list[Column]:
    return [total[n] for n in LIMBS]


def exact(c: Column | str) -> Column:
    """One double as a total."""
    c = _column(c).cast("double")
    return F.when(c.isNotNull(), _packed(_limbs_of(c), _beyond(c)))


def exact_total(c: Column | str) -> Column:
    """Aggregate: the total of doubles, to be added to or rounded."""
    c = _column(c).cast("double")
    limbs = [F.sum(limb) for limb in _limbs_of(c)]
    return F.when(F.count(c) > 0, _packed(limbs, F.sum(_beyond(c))))


def merged(total: Column | str) -> Column:
    """Aggregate: totals added up."""
    total = _column(total)
    limbs = [F.sum(limb) for limb in _fields(total)]
    return F.when(F.count(total) > 0, _packed(limbs, F.sum(total["beyond"])))


def running_difference(enters: Column, leaves: Column, so_far, inside) -> Column:
    """Total of what entered so far and has not left, over windows; nothing gives 0.

    Limbs are whole numbers, so what left can be taken off a running sum and each row costs the
    same. Values beyond the limbs are doubles; those are added up over the window ``inside``.
    """
    none = F.lit(0).cast("bigint")
    limbs = [
        F.sum(F.coalesce(x, none) - F.coalesce(y, none)).over(so_far)
        for x, y in zip(_fields(enters), _fields(leaves), strict=True)
    ]
    return _packed(limbs, F.sum(enters["beyond"]).over(inside))


def difference(a: Column, b: Column) -> Column:
    """a - b, where a missing b counts as nothing."""
    limbs = [x - F.coalesce(y, F.lit(0).cast("bigint")) for x, y in zip(_fields(a), _fields(b), strict=True)]
    none = F.lit(0.0)
    beyond = F.coalesce(a["beyond"], none) - F.coalesce(b["beyond"], none)
    any_beyond = a["beyond"].isNotNull() | b["beyond"].isNotNull()
    return F.when(a.isNotNull(), _packed(limbs, F.when(any_beyond, beyond)))


def rounded(total: Column | str) -> Column:
    """The double nearest to a total, ties to even; NULL stays.

    For results of few rows: its code is too long for the JVM to compile. ``with_rounded`` does
    the same for many.
    """
    total = _column(total)
    wide = "decimal(38,0)"

    def joined(parts: list[Column]) -> Column:
        number = parts[0].cast(wide)
        for part in parts[1:]:
            number = (number * F.lit(Decimal(1 << BITS)) + part).cast(wide)
        return number

    def times(number: Column, bits: int) -> Column:
        return (number * F.lit(Decimal(1 << bits))).cast(wide)

    # A decimal of whole numbers becomes the nearest double.  Up to 2^53 all bits fit in one; of
    # larger totals 20 bits behind the point do, and one more that tells whether any is left.
    whole, part = joined(_fields(total)[:3]), joined(_fields(total)[3:])
    cut = F.lit(Decimal(1 << 52))
    below = part % cut
    upper = ((part - below) / cut).cast(wide)
    left = F.when(below > 0, 1).when(below < 0, -1).otherwise(0)
    number = F.when(
        F.abs(whole) < F.lit(Decimal(1 << 53)),
        (times(whole, 72) + part).cast(wide).cast("double") * F.lit(2.0**-72),
    ).otherwise((times(whole, 21) + times(upper, 1) + left).cast(wide).cast("double") * F.lit(2.0**-21))
    return F.when(total["beyond"].isNull(), number).otherwise(number + total["beyond"])


def with_rounded(df: DataFrame, *names: str) -> DataFrame:
    """Totals in columns replaced by the doubles nearest to them, ties to even; NULL stays.

    Carries leave digits of 24 bits, five of them, under a leading number that has the sign. Every
    total is then two doubles that are both exact, and the processor's one addition of them is
    rounded as the total must be. Up to 2^28 the second double holds the last two digits. For
    larger totals it ends with a bit that tells whether anything is left: up to 2^53 behind 48 bits
    of the fraction, from there behind the point. Each carry is a column that later ones refer to,
    as one expression would repeat it for every use.
    """
    mask, none = F.lit(_MASK), F.lit(0).cast("bigint")

    def carry(c: str) -> Column:
        return F.shiftright(c, BITS)

    def pair(high: str, low: str) -> Column:
        return F.shiftleft(F.col(high).bitwiseAND(mask), BITS).bitwiseOR(F.col(low).bitwiseAND(mask))

    def marked(c: Column, rest: Column) -> Column:
        return F.shiftleft(c, 1).bitwiseOR(F.when(rest != 0, F.lit(1).cast("bigint")).otherwise(none))

    def double(c: Column, bits: int) -> Column:
        return c.cast("double") * F.lit(2.0**bits)

    def steps(name: str) -> list[dict[str, Column]]:
        total = F.col(name)
        limb = {n: F.coalesce(total[n], none) for n in LIMBS}

        def of(part: str) -> str:
            return f"_{name}_{part}"

        s3, s2, s1, s0, t1, lead, units, whole = map(
            of, ("s3", "s2", "s1", "s0", "t1", "lead", "units", "whole")
        )
        # only whether this is 0 matters, so the digits may overlap
        rest = F.col(s1).bitwiseOR(F.col(s2)).bitwiseOR(F.col(s3)).bitwiseAND(mask)
        small = double(
            F.shiftleft(whole, BITS).bitwiseOR(F.col(s1).bitwiseAND(mask)), -BITS
        ) + double(pair(s2, s3), -3 * BITS)
        middle = double(F.col(whole), 0) + double(
            marked(pair(s1, s2), F.col(s3).bitwiseAND(mask)), -2 * BITS - 1
        )
        large = double(F.col(lead), 2 * BITS) + double(marked(F.col(units), rest), -1)
        number = F.when(
            F.col(lead).between(-32, 31),
            F.when(F.col(whole).between(-(1 << 28), (1 << 28) - 1), small).otherwise(middle),
        ).otherwise(large)
        beyond = F.coalesce(total["beyond"], F.lit(0.0))
        return [
            {s3: limb["p3"]},
            {s2: limb["p2"] + carry(s3)},
            {s1: limb["p1"] + carry(s2)},
            {s0: limb["w0"] + carry(s1)},
            {t1: limb["w1"] + carry(s0)},
            {lead: limb["w2"] + carry(t1), units: pair(t1, s0)},
            {whole: F.shiftleft(lead, 2 * BITS).bitwiseOR(F.col(units))},
            {name: F.when(total.isNotNull(), number + beyond)},
        ]

    out = df
    for step in zip(*map(steps, names), strict=True):
        out = out.withColumns({c: value for columns in step for c, value in columns.items()})
    return out.select(*df.columns)


def exact_sum(c: Column | str) -> Column:
    """Aggregate: the double nearest to the sum of doubles."""
    return rounded(exact_total(c))


def summed(df: DataFrame, column: str, where: Column | None = None) -> Column:
    """Aggregate: the sum of a column that holds totals or plain numbers."""
    c = F.col(column) if where is None else F.when(where, F.col(column))
    return merged(c) if isinstance(df.schema[column].dataType, T.StructType) else F.sum(c)


def as_double(df: DataFrame, column: str) -> Column:
    """A column that holds totals or plain numbers, as doubles."""
    is_total = isinstance(df.schema[column].dataType, T.StructType)
    return rounded(column) if is_total else F.col(column).cast("double")
