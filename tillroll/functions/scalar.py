"""Scalar functions of the staging and mart layers.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions`` so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Warehouse NUMERIC: 38 digits, 9 after the point.
NUMERIC = "decimal(38,9)"
# Money as it arrives in a feed (two decimals).
MONEY_IN = "decimal(18,2)"
# Operands of a NUMERIC division: Spark's quotient of two such numbers is decimal(38,9), rounded half
# up once, and the operands reach 1e20.
_DIVIDE_OPERAND = "decimal(29,9)"
# Operands of a NUMERIC sum or difference: of these Spark keeps all nine fraction digits (of two
# decimal(38,9) it keeps eight).
_ADD_OPERAND = "decimal(37,9)"

# Whitespace as the warehouse trim sees it: every character with the Unicode White_Space property.
_BLANKS = ("\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
           + "\u2028\u2029\u202f\u205f\u3000")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c) -> Column:
    """trim(x): strip Unicode whitespace at both ends (X2); null stays null."""
    return F.btrim(_c(c), F.lit(_BLANKS))


def clean_lower(c) -> Column:
    return F.lower(clean(c))


def clean_upper(c) -> Column:
    return F.upper(clean(c))


def numeric(c) -> Column:
    """cast(x as numeric)."""
    return _c(c).cast(NUMERIC)


def numeric_add(a, b) -> Column:
    """a + b on NUMERIC operands, exact in all nine fraction digits."""
    return (_c(a).cast(_ADD_OPERAND) + _c(b).cast(_ADD_OPERAND)).cast(NUMERIC)


def numeric_subtract(a, b) -> Column:
    """a - b on NUMERIC operands, exact in all nine fraction digits."""
    return (_c(a).cast(_ADD_OPERAND) - _c(b).cast(_ADD_OPERAND)).cast(NUMERIC)


def nullif_zero(c) -> Column:
    """nullif(x, 0)."""
    return F.nullif(_c(c), F.lit(0))


def numeric_ratio(num, den, scale: int = 9) -> Column:
    """safe_divide on NUMERIC operands (X6): null on a zero or null divisor.

    The quotient is rounded half away from zero, to nine digits and then to ``scale``, as NUMERIC.
    """
    q = F.try_divide(_c(num).cast(_DIVIDE_OPERAND), _c(den).cast(_DIVIDE_OPERAND))
    return F.round(q, scale).cast(NUMERIC)


def float_ratio(num, den) -> Column:
    """safe_divide on integer operands: FLOAT64 result, null on a zero divisor."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def day_of_week(c) -> Column:
    """extract(dayofweek): Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(_c(c))
