"""Validation checks: each returns findings, and a status from their number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fuzzy_contains
from .merge import in_blocks


def missing(expected: DataFrame, present: list[tuple[DataFrame, str]], key: str, severity: Column, most: int | None = None) -> DataFrame:
    """Expected rows that none of several sets of keys holds (an OR of semi joins, each an equi-join)."""
    out = expected
    for df, col in present:
        out = out.join(df.select(F.col(col).alias(key)).distinct(), key, "left_anti")
    out = out.withColumn("severity", severity)
    return out.orderBy(key).limit(most) if most else out


def unknown(references: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """References to keys that are not known; none where nothing is known."""
    any_known = known.select(F.lit(True).alias("__any")).limit(1)
    return references.join(known.select(key).distinct(), key, "left_anti").join(F.broadcast(any_known))


def unknown_items(rows: DataFrame, items: str, known: DataFrame, key: str) -> DataFrame:
    """Arrays without items that are not known, in order; untouched where nothing is known.

    Items are looked up by an equi-join, and rows told apart by their digest, so known sets of any size will do.
    """
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])), 256)
    named = rows.withColumn("__row", digest)
    each = named.select("__row", items).distinct().select("__row", F.posexplode(items).alias("at", "item"))
    left = each.join(known.select(F.col(key).alias("item")).distinct(), "item", "left_semi").groupBy("__row").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias("__left"))
    any_known = known.select(F.lit(True).alias("__any")).limit(1)
    out = named.join(left, "__row", "left").join(F.broadcast(any_known), F.lit(True), "left")  # one row or none
    kept = F.when(F.col("__any").isNull(), F.col(items)).otherwise(F.coalesce("__left", F.slice(items, 1, 0)))
    return out.withColumn(items, kept).select(*[F.col(f"`{c}`") for c in rows.columns])


def several_targets(edges: DataFrame, source: str, target: str, least: int = 2) -> DataFrame:
    """Sources with at least ``least`` distinct targets."""
    return edges.groupBy(source).agg(F.count_distinct(target).alias("targets")).where(F.col("targets") >= least)


def step_confidence(steps: DataFrame, key: str, backed: Column, evidence: Column, share: float = 0.6) -> DataFrame:
    """0.6 of the share of backed steps and 0.4 of the share with evidence, and a grade."""
    value = F.round(share * F.avg(backed.cast("double")) + (1 - share) * F.avg(evidence.cast("double")), 4)
    out = steps.groupBy(key).agg(value.alias("confidence"), F.count("*").alias("steps"))
    return out.withColumn("grade", F.when(F.col("confidence") >= 0.7, "pass").when(F.col("confidence") >= 0.4, "warn").otherwise("fail"))


def verdict(findings: DataFrame, warn: int, fail: int) -> DataFrame:
    """Status of a check by its weighty findings."""
    return findings.agg(F.count_if(F.col("severity").isin("critical", "major")).alias("weighty"), F.count("*").alias("findings")).withColumn("status", F.when(F.col("weighty") >= fail, "fail").when(F.col("weighty") >= warn, "warn").otherwise("pass"))


def qa(findings: DataFrame, coverage: float, least: float = 0.8) -> DataFrame:
    """Passes without critical and major findings and with coverage enough."""
    out = findings.agg(F.count_if(F.col("severity") == "critical").alias("critical"), F.count_if(F.col("severity") == "major").alias("major"))
    return out.withColumn("passed", (F.col("critical") == 0) & (F.col("major") == 0) & (F.lit(coverage) >= least))


def not_mentioned(names: DataFrame, texts: DataFrame, name: str, text: str, ratio: float = 0.75) -> DataFrame:
    """Names that no text holds, wholly or by ``ratio`` of their words. Names meet the texts in blocks."""
    hit = in_blocks(names, lambda some: texts.join(F.broadcast(some), fuzzy_contains(F.col(name), F.col(text), ratio)).select(name).distinct())
    return names.join(hit, name, "left_anti")


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def required(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Rows that lack a required value, with what they lack."""
    lacks = F.filter(F.array(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in cols]), lambda c: c.isNotNull())
    return rows.withColumn("lacks", F.array_join(lacks, ",")).where(F.col("lacks") != "")


def capped(findings: DataFrame, group: list[str], order: list, most: int = 50) -> DataFrame:
    """At most ``most`` findings a group: a report's limit, kept apart from counting."""
    return findings.withColumn("__n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__n") <= most).drop("__n")


def scorecard(checks: dict[str, DataFrame]) -> DataFrame:
    """One row a check from one-row results with a ``status``, FAIL if any fails, else WARN or PASS."""
    rows = None
    for name, df in checks.items():
        one = df.select(F.lit(name).alias("check"), "status")
        rows = one if rows is None else rows.unionByName(one)
    worst = F.max(F.when(F.col("status") == "fail", 2).when(F.col("status") == "warn", 1).otherwise(0)).over(Window.partitionBy())
    return rows.withColumn("grade", F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")), worst + 1))
