"""Rollups and distributions of run telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup(calls: DataFrame, group: list[str], measures: list[str]) -> DataFrame:
    """Calls and sums by group; negative values mean unknown and count as zero."""
    return calls.groupBy(*group).agg(F.count("*").alias("calls"), *[F.round(F.sum(F.greatest(F.coalesce(F.col(m), F.lit(0)), F.lit(0))), 4).alias(f"total_{m}") for m in measures])


def distribution(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """Minimum, median, mean, 95th percentile by rank, and maximum."""
    v = F.col(value)
    return rows.groupBy(*group).agg(F.min(v).alias("min"), F.round(F.percentile(v, 0.5), 4).alias("median"), F.round(F.avg(v), 4).alias("mean"), F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY {value})").alias("p95"), F.max(v).alias("max"), F.count("*").alias("n"))


def compared(a: DataFrame, b: DataFrame, measures: list[str]) -> DataFrame:
    """Ratios of two one-row summaries; null where the second is zero."""
    left, right = a.select(*[F.col(m).alias(f"a_{m}") for m in measures]), b.select(*[F.col(m).alias(f"b_{m}") for m in measures])
    return left.crossJoin(right).select("*", *[F.when(F.col(f"b_{m}") != 0, F.round(F.col(f"a_{m}") / F.col(f"b_{m}"), 4)).alias(f"ratio_{m}") for m in measures])


def rate(df: DataFrame, group: list[str], amount: str, seconds: str) -> DataFrame:
    """``per_second`` and ``seconds_per_1000`` of an amount; null where there is no time or no amount. Negative amounts count as none."""
    total, time = F.sum(F.greatest(F.coalesce(F.col(amount), F.lit(0)), F.lit(0))), F.sum(F.coalesce(F.col(seconds), F.lit(0)))
    out = df.groupBy(*group).agg(total.alias("a"), time.alias("s"))
    return out.select(*group, F.round(F.when(F.col("s") > 0, F.col("a") / F.col("s")), 4).alias("per_second"), F.round(F.when(F.col("a") > 0, 1000 * F.col("s") / F.col("a")), 4).alias("seconds_per_1000"))
