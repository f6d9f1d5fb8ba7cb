"""Key normalisation and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: what a NULL part contributes to a surrogate key.
NULL_PART = "_dbt_utils_surrogate_key_null_"

TAX_ID_DIGITS = 14


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits(c: Column | str) -> Column:
    """Digits only; NULL stays NULL."""
    return F.regexp_replace(_col(c), "[^0-9]", "")


def valid_digits(c: Column | str, n: int = TAX_ID_DIGITS) -> Column:
    """Digits only, or NULL unless exactly ``n`` remain."""
    d = digits(c)
    return F.when(F.length(d) == n, d)


def norm_code(c: Column | str) -> Column:
    """Upper case without surrounding whitespace of any kind.

    ``trim`` alone strips spaces only; a tab or a no-break space would survive
    and break the join on the code.
    """
    return F.upper(F.btrim(_col(c), F.lit(WHITESPACE)))


def scoped(system: Column | str, key: Column | str) -> Column:
    """An id together with the system it belongs to, as one join key."""
    return F.concat(_col(system), F.lit(":"), _col(key))


def surrogate_key(*cols: Column | str) -> Column:
    """md5 hex over the parts as text, joined by ``-``; stable across runs."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
