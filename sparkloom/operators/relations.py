"""Entities and relationships from schemas: names, keys, joins in SQL text, pivot tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import plural, snake
from .merge import first_of, strongest

#: Confidence of each kind of signal.
SIGNALS = {"fk_explicit": 0.95, "pivot": 0.90, "orm": 0.85, "sql_join": 0.80, "column_name": 0.75}


def candidates(column: Column) -> Column:
    """Tables that a column ``x_id`` may name, best first."""
    stem = F.regexp_extract(F.lower(column), r"^(.+)_id$", 1)
    return F.when(stem != "", F.array_distinct(F.array(stem, F.concat(stem, F.lit("s")), F.concat(stem, F.lit("es")), plural(stem))))


def by_column_name(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """``from_table, to_table, via, signal, confidence`` where a column is named after a table."""
    named = columns.select(F.col("table").alias("from_table"), F.col("column").alias("via"), F.posexplode(candidates(F.col("column"))).alias("priority", "to_table"))
    hit = named.join(tables.select(F.lower("table").alias("to_table")).distinct(), "to_table").where("from_table <> to_table")
    return first_of(hit, ["from_table", "via"], ["priority"]).select("from_table", "to_table", "via", F.lit("column_name").alias("signal"), F.lit(SIGNALS["column_name"]).alias("confidence"))


def by_shared_values(left: DataFrame, right: DataFrame, least: float = 0.95) -> DataFrame:
    """Containment of distinct keys: the share of ``left(k)`` that is in ``right(k)``."""
    a, b = left.select("k").where("k is not null").distinct(), right.select("k").distinct().withColumn("hit", F.lit(1))
    return a.join(b, "k", "left").agg(F.round(F.count("hit") / F.count("*"), 4).alias("containment")).withColumn("holds", F.col("containment") >= least)


def merged(signals: DataFrame) -> DataFrame:
    """One row a relationship: strongest signal, all signals listed, sequential ids not given."""
    rows = signals.withColumn("signals", F.array("signal")).withColumn("ord", F.hash("signal", "via").cast("long"))
    return strongest(rows, ["from_table", "to_table"], "confidence", "ord", ["via"], ["signals"])


def pivots(columns: DataFrame, meta=("id", "created_at", "updated_at", "deleted_at")) -> DataFrame:
    """Tables of two or more key-like columns and at most one other that is not bookkeeping."""
    key = F.lower("column").rlike(r"_id$|_key$")
    other = ~key & ~F.lower("column").isin(*meta)
    return columns.groupBy("table").agg(F.count_if(key).alias("keys"), F.count_if(other).alias("others")).withColumn("is_pivot", (F.col("keys") >= 2) & (F.col("others") <= 1))


def sql_joins(sql: DataFrame, text: str = "sql") -> DataFrame:
    """``left_table, right_table`` of JOINs with ON or USING in SQL text, in lower case."""
    low = F.lower(text)
    base = F.regexp_extract(low, r"(?s)\bfrom\s+[`\"]?([a-z0-9_]+)", 1)
    joined = F.regexp_extract_all(low, F.lit(r"\bjoin\s+[`\"]?([a-z0-9_]+)[`\"]?\s+(?:as\s+)?(?:[a-z0-9_]+\s+)?(?:on|using)\b"), F.lit(1))
    return sql.select(base.alias("left_table"), F.explode(joined).alias("right_table")).where("left_table <> '' and left_table <> right_table").distinct()


def entity_of(table: Column) -> Column:
    """Singular snake-case name of a table."""
    s = snake(table)
    return F.when(s.rlike("ies$"), F.regexp_replace(s, "ies$", "y")).when(s.rlike("(ses|xes|zes|ches|shes)$"), F.regexp_replace(s, "es$", "")).when(s.rlike("[^s]s$"), F.regexp_replace(s, "s$", "")).otherwise(s)


def mermaid_er(relations: DataFrame) -> DataFrame:
    line = F.concat(F.lit("  "), F.upper("from_table"), F.lit(" }o--|| "), F.upper("to_table"), F.lit(" : "), F.col("via"))
    rows = relations.select(F.struct("from_table", "to_table", line.alias("line")).alias("x"))
    return rows.agg(F.concat(F.lit("erDiagram\n"), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda r: r["line"]), "\n")).alias("diagram"))
