"""Column-level building blocks (pure ``pyspark.sql.functions`` expressions)."""

from tablelearn.functions.columns import (
    all_not_null,
    as_key_string,
    gaussian_density,
    gaussian_log_density,
    gaussian_log_density_compat,
    hash32,
    normalized_zero,
    ratio,
    trunc_int,
    xlogx,
)

__all__ = [
    "all_not_null",
    "as_key_string",
    "gaussian_density",
    "gaussian_log_density",
    "gaussian_log_density_compat",
    "hash32",
    "normalized_zero",
    "ratio",
    "trunc_int",
    "xlogx",
]
