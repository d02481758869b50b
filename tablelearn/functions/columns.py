"""Scalar column expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen.  ANSI mode is on by default in Spark 4, so divisions use
``try_divide`` and parses use ``try_cast``: a zero denominator or a bad field
gives null instead of failing the job.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
)

LN2 = math.log(2.0)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """num / den as double, null when den is 0 or null."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def xlogx(n) -> Column:
    """n * ln(n) for counts; 0 for n <= 0 (ln(0) is null in Spark)."""
    c = col_(n).cast("double")
    return F.when(c > 0, c * F.ln(c)).otherwise(F.lit(0.0))


def trunc_int(c) -> Column:
    """JVM ``toInt`` on a double: truncate toward zero (null, instead of a
    failed job, for values that are not numbers or do not fit an int)."""
    return col_(c).try_cast("double").try_cast("int")


def all_not_null(cols) -> Column:
    """Conjunction of ``isNotNull`` (keeps NaN, unlike ``na.drop``)."""
    preds = [col_(c).isNotNull() for c in cols]
    if not preds:
        return F.lit(True)
    return reduce(lambda a, b: a & b, preds)


def normalized_zero(c, dtype: DataType | None = None) -> Column:
    """Map -0.0 to 0.0 for floating columns, as Spark's own grouping does."""
    c = col_(c)
    if dtype is None or isinstance(dtype, (DoubleType, FloatType)):
        return F.when(c == 0, F.lit(0.0).cast(dtype or DoubleType())).otherwise(c)
    return c


def as_key_string(c, dtype: DataType | None = None) -> Column:
    """Feature value as a string grouping key (unpivot needs one type)."""
    if dtype is not None and isinstance(dtype, (DoubleType, FloatType)):
        return normalized_zero(c, dtype).cast("string")
    return col_(c).cast("string")


def typed_key(c, dtype: DataType) -> Column:
    """Grouping key ``struct(d double, l long, s string)`` with one field
    set: floating values in ``d`` (-0.0 folded), integral values in ``l``,
    anything else as a string in ``s``.  Avoids formatting numbers as text
    on the hot path; equal keys <=> equal values (as with string keys)."""
    c = col_(c)
    nd, nl, ns = F.lit(None).cast("double"), F.lit(None).cast("long"), F.lit(None).cast("string")
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.struct(normalized_zero(c, dtype).cast("double").alias("d"), nl.alias("l"), ns.alias("s"))
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return F.struct(nd.alias("d"), c.cast("long").alias("l"), ns.alias("s"))
    return F.struct(nd.alias("d"), nl.alias("l"), c.cast("string").alias("s"))


def hash32(key_cols, seed: int) -> Column:
    """Deterministic number in [0, 2**32) from md5(seed ':' key...).

    Depends only on the row's key, never on partitioning, so a split made
    with it is the same on every cluster size and after any re-execution.
    """
    parts = [F.lit(str(seed))] + [col_(k).cast("string") for k in key_cols]
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def gaussian_density(x, mean, var) -> Column:
    """exp(-(x-m)^2 / 2v) / sqrt(2 pi v); null when v <= 0."""
    x, mean, var = col_(x), col_(mean), col_(var)
    num = F.exp(F.negative(F.try_divide(F.pow(x - mean, 2), var * 2.0)))
    den = F.sqrt(var * (2.0 * math.pi))
    return F.when(var > 0, F.try_divide(num, den))


def gaussian_log_density(x, mean, var) -> Column:
    """Analytic log density -ln(2 pi v)/2 - (x-m)^2/(2v); does not underflow."""
    x, mean, var = col_(x), col_(mean), col_(var)
    return F.when(
        var > 0,
        F.ln(var * (2.0 * math.pi)) * -0.5 - F.try_divide(F.pow(x - mean, 2), var * 2.0),
    )


def gaussian_log_density_compat(x, mean, spread) -> Column:
    """ln of the density as the JVM computes it, with ``spread`` in the
    variance slot: underflow to 0 gives -inf; a zero spread gives NaN
    (0/0 and x/0 both end in NaN after exp/sqrt/divide)."""
    x, mean, spread = col_(x), col_(mean), col_(spread)
    pdf = gaussian_density(x, mean, spread)
    return (
        F.when(spread == 0, F.lit(float("nan")))
        .when(pdf == 0, F.lit(float("-inf")))
        .otherwise(F.ln(pdf))
    )
