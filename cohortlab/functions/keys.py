"""Small scalar helpers shared by operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def valid_number(c: Column | str, dtype: T.DataType) -> Column:
    """The value as double, or null when it is null or NaN (a median ignores both).

    A long or decimal beyond 2^53 rounds to the nearest double, as the
    original's double result does."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return c.cast("double")


def hash_mod(c: Column | str, multiplier: int, modulus: int) -> Column:
    """``(c * multiplier) mod modulus`` in ``0 .. modulus - 1`` for integer keys,
    computed in 64 bits as ``pmod(pmod(c, modulus) * multiplier, modulus)``: it
    never overflows and a negative key is never negative. Null for a null key."""
    c = (F.col(c) if isinstance(c, str) else c).cast("long")   # an int key would overflow
    return F.pmod(F.pmod(c, F.lit(modulus)) * F.lit(multiplier), F.lit(modulus))


def category_text(c: Column | str) -> Column:
    """A key value as chart category text (an int prints as ``45``, a double as ``75.0``)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")
