"""Score normalisation: logistic curve and Gaussian distribution function as column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.operators.joins import null_safe_join

# The five-term polynomial approximation of erf (Abramowitz and Stegun 7.1.26), lowest power first.
ERF_SLOPE = 0.3275911
ERF_TERMS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
INV_SQRT_2 = 0.707106781


#: Shares into which the rows of each group are dealt.
SHARES = 64


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def erf(x: Column) -> Column:
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_SLOPE) * F.abs(x))
    poly = F.lit(0.0)
    for term in reversed(ERF_TERMS):
        poly = t * (F.lit(term) + poly)
    size = F.lit(1.0) - poly * F.exp(-x * x)
    return F.when(x >= 0, size).otherwise(-size)


def gaussian_cdf(x: Column, mean: Column | float = 0.0, std: Column | float = 1.0) -> Column:
    mean = F.lit(mean) if isinstance(mean, float) else mean
    std = F.lit(std) if isinstance(std, float) else std
    return F.lit(0.5) + F.lit(0.5) * erf(F.lit(INV_SQRT_2) * (x - mean) / std)


def normalize_scores(df: DataFrame, score: str, groups: Sequence[str], method: str = "cdf") -> DataFrame:
    """Append `<score>_norm`: each score against mean and deviation of its group.

    The statistics are aggregated first (map-side combine) and joined back. Rows of a group are dealt to shares by their
    values and its statistics, one row, are copied into each, so that a few large groups do not make a few large tasks.
    Null groups are a group; a group without spread gets 0.5.
    """
    stats = df.groupBy(*groups).agg(F.avg(score).alias("_mean"), F.stddev_samp(score).alias("_std"))
    values = [c for c, kind in df.dtypes if not kind.startswith("map") and "map<" not in kind]
    dealt = df.withColumn("_share", F.pmod(F.xxhash64(*values), F.lit(SHARES)).cast("int"))
    copied = stats.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    joined = null_safe_join(dealt, copied, [*groups, "_share"], "left")
    z = (F.col(score) - F.col("_mean")) / F.col("_std")
    if method == "cdf":
        value = gaussian_cdf(F.col(score), F.col("_mean"), F.col("_std"))
    elif method == "sigmoid":
        value = sigmoid(z)
    else:
        raise ValueError(f"unknown method {method!r}")
    spread = F.col("_std").isNotNull() & (F.col("_std") > 0)
    return joined.select(*df.columns, F.when(spread, value).otherwise(F.lit(0.5)).alias(f"{score}_norm"))
