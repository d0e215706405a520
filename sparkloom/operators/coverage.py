"""Set coverage: flags, ratios, status ladders, composites and matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(covered: Column, total: Column, empty: float) -> Column:
    """covered / total; ``empty`` where there is nothing to measure (it differs by metric)."""
    return F.when(total == 0, F.lit(empty)).otherwise(covered / total)


def status(value: Column, good: float = 0.85, fair: float = 0.25, names=("pass", "warn", "fail")) -> Column:
    return F.when(value >= good, names[0]).when(value >= fair, names[1]).otherwise(names[2])


def flag(items: DataFrame, covered: DataFrame, key: list[str], name: str = "covered") -> DataFrame:
    """Items with a flag that tells whether their key is among the covered."""
    known = covered.select(*key).distinct().withColumn("__hit", F.lit(True))
    return items.join(known, key, "left").withColumn(name, F.coalesce("__hit", F.lit(False))).drop("__hit")


def coverage(items: DataFrame, group: list[str], key: str, flag_col: str = "covered", empty: float = 1.0, missing: int = 30, good: float = 0.85, fair: float = 0.5) -> DataFrame:
    """covered, total, pct, status and the first missing keys of each group.

    The missing list holds ``missing`` keys at most, smallest first: it is a report.
    """
    m = F.when(~F.col(flag_col), F.col(key).cast("string"))
    grouped = items.groupBy(*group).agg(F.count_if(flag_col).alias("covered"), F.count("*").alias("total"))
    lost = items.where(~F.col(flag_col)).select(*group, m.alias("m"), F.row_number().over(Window.partitionBy(*group).orderBy(key)).alias("n")).where(F.col("n") <= missing)
    listed = lost.groupBy(*group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "m"))), lambda x: x["m"]), ",").alias("missing"))
    pct = ratio(F.col("covered"), F.col("total"), empty)
    return grouped.withColumn("pct", F.round(pct, 4)).withColumn("status", status(pct, good, fair)).join(listed, group, "left").withColumn("missing", F.coalesce("missing", F.lit("")))


def spread_hits(items: DataFrame, group: list[str], flag_col: str = "covered") -> DataFrame:
    """One hit in a group covers all its siblings."""
    hit = items.groupBy(*group).agg(F.max(flag_col).alias("expanded"))
    return items.join(hit, group)


def distinct_coverage(items: DataFrame, key: list[str], flag_col: str, order: str) -> DataFrame:
    """One flag a key: that of the first row in order decides."""
    return items.groupBy(*key).agg(F.min_by(flag_col, order).alias(flag_col))


def micro(parts: DataFrame, empty: float = 1.0) -> DataFrame:
    """Sum of covered over sum of totals."""
    return parts.agg(F.round(ratio(F.sum("covered"), F.sum("total"), empty), 4).alias("micro"))


def macro(parts: DataFrame, names=(("pass", 1.0), ("warn", 0.5))) -> DataFrame:
    """Mean of percentages, of status scores, and of both."""
    points = F.lit(0.0)
    for name, value in names:
        points = F.when(F.col("status") == name, F.lit(value)).otherwise(points)
    return parts.agg(F.round(F.avg("pct"), 4).alias("avg_pct"), F.round(F.avg(points), 4).alias("avg_status"), F.round((F.avg("pct") + F.avg(points)) / 2, 4).alias("composite"))


def weighted(validation: Column, cover: Column, share: float = 0.6) -> Column:
    """0.6 of validation and 0.4 of coverage; one alone where the other is null; null without both."""
    return F.when(validation.isNotNull() & cover.isNotNull(), share * validation + (1 - share) * cover).otherwise(F.coalesce(validation, cover))


def matrix(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Full outer of ratios by key with the average of those there are, worst first by ``average, key``."""
    out = None
    for name, df in parts.items():
        one = df.select(key, F.col("pct").alias(name))
        out = one if out is None else out.join(one, key, "full_outer")
    have = F.filter(F.array(*map(F.col, parts)), lambda x: x.isNotNull())
    return out.withColumn("average", F.round(F.aggregate(have, F.lit(0.0), lambda a, x: a + x) / F.size(have), 4))


def signal_score(df: DataFrame, signals: dict[str, tuple[Column, float]], bands: list[tuple[float, str]], last: str) -> DataFrame:
    """Sum of the weights of true signals and its band (best first)."""
    score = sum((F.when(c, F.lit(w)).otherwise(0.0) for c, w in signals.values()), F.lit(0.0))
    band = None
    for least, name in bands:
        band = F.when(F.col("score") >= least, name) if band is None else band.when(F.col("score") >= least, name)
    return df.withColumn("score", F.round(score, 4)).withColumn("band", band.otherwise(last))


def evidence_confidence(evidence: DataFrame, key: str, category: str, each: float = 0.2) -> DataFrame:
    """0.2 for each category with evidence, and its grade."""
    out = evidence.groupBy(key).agg(F.round(F.least(F.lit(1.0), F.count_distinct(category) * F.lit(each)), 4).alias("confidence"))
    return out.withColumn("grade", status(F.col("confidence"), 0.8, 0.4, ("high", "medium", "low")))


def consensus(parts: DataFrame, least: float = 0.8) -> DataFrame:
    """The gate of the weakest: minimum of all coverages against a threshold."""
    return parts.agg(F.round(F.min("pct"), 4).alias("weakest"), (F.min("pct") >= least).alias("agreed"))
