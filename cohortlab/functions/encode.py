"""Encoding of the two categorical fields and their display labels.

The comparison is exact and case-sensitive, and anything else -- including
null -- encodes to 0 (so ``Yes`` is 0 and a missing sex becomes 0).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlab.schema import SEX_LABELS, SEX_POSITIVE, SMOKING_LABELS, SMOKING_POSITIVE


def _flag(c: Column | str, positive: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    # coalesce keeps null -> 0 explicit: `null = 'M'` is null, not false.
    return F.when(F.coalesce(c == F.lit(positive), F.lit(False)), F.lit(1)).otherwise(F.lit(0))


def encode_sex(c: Column | str = "sex") -> Column:
    return _flag(c, SEX_POSITIVE)


def encode_smoking(c: Column | str = "is_smoking") -> Column:
    return _flag(c, SMOKING_POSITIVE)


def _label(c: Column | str, yes: str, no: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.coalesce(c == F.lit(1), F.lit(False)), F.lit(yes)).otherwise(F.lit(no))


def sex_label(c: Column | str = "sex") -> Column:
    """Encoded sex back to text: 1 -> M, anything else -> F."""
    return _label(c, *SEX_LABELS)


def smoking_label(c: Column | str = "is_smoking") -> Column:
    """Encoded smoking flag back to text: 1 -> YES, anything else -> NO."""
    return _label(c, *SMOKING_LABELS)
