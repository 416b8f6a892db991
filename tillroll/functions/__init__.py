"""Scalar column helpers (JVM-side built-ins only, no Python UDFs)."""

from tillroll.functions.scalar import (  # noqa: F401
    NUMERIC,
    MONEY_IN,
    clean,
    clean_lower,
    clean_upper,
    day_of_week,
    numeric,
    numeric_add,
    numeric_subtract,
    numeric_ratio,
    float_ratio,
    nullif_zero,
)
