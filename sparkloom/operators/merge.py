"""Order-aware merges. Every choice is made over an explicit total order, never over the order of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_blocks(rows: DataFrame, f, most: int = 2000) -> DataFrame:
    """``f`` of each block of about ``most`` rows, united.

    A set of rows that has to meet a whole table, and of which nothing says that
    it is small, is counted and then broadcast one block at a time.
    """
    n = max(1, -(-rows.count() // most))
    if n == 1:
        return f(rows)
    block = F.pmod(F.xxhash64(*rows.columns), F.lit(n))
    return reduce(DataFrame.unionByName, [f(rows.where(block == i)) for i in range(n)])


def in_lists(df: DataFrame, key: str, by: str, item: Column, most: int) -> DataFrame:
    """``key, list, items``: the items of a key in lists of about ``most``, dealt by the hash of ``by``; a key of more rows has several."""
    large = df.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > most)
    n = F.coalesce(F.ceil(F.col("__n") / most), F.lit(1))
    return df.join(large, key, "left").groupBy(key, F.pmod(F.xxhash64(by), n).alias("list")).agg(F.collect_list(item).alias("items"))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of which each makes many more, dealt over all shuffle partitions; adaptive execution would join them by their own small size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def first_of(df: DataFrame, key: list, order: list) -> DataFrame:
    """One row a key: the first in the given order (first writer wins)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def last_of(df: DataFrame, key: list, order_col: str, *ties: str) -> DataFrame:
    """One row a key: the last in order (last writer wins)."""
    return first_of(df, key, [F.col(order_col).desc(), *[F.col(t).desc() for t in ties]])


def strongest(df: DataFrame, key: list[str], confidence: str, order: str, keep: list[str], union: list[str] = ()) -> DataFrame:
    """One row a key: the row of highest confidence, ties to the first in order; lists are united.

    A partial aggregation, so a hot key is reduced before it moves. Null lists count as empty.
    """
    best = F.max_by(F.struct(confidence, *keep), F.struct(F.col(confidence), (-F.col(order)).alias("o")))
    lists = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce(F.col(c), F.array().cast("array<string>")))))).alias(c) for c in union]
    return df.groupBy(*key).agg(best.alias("__b"), *lists).select(*key, "__b.*", *union)


def by_priority(df: DataFrame, key: list[str], confidence: str, priority: str, order: str) -> DataFrame:
    """Highest confidence, then highest priority, then first in order."""
    return first_of(df, key, [F.col(confidence).desc(), F.col(priority).desc(), F.col(order)])


def plurality(items: DataFrame, key: str, group: str) -> DataFrame:
    """Each key's most common group, ties to the smallest."""
    counted = items.groupBy(key, group).agg(F.count("*").alias("votes"))
    return counted.groupBy(key).agg(F.min_by(group, F.struct(-F.col("votes"), F.col(group))).alias(group), F.max("votes").alias("votes"))


def fullest(df: DataFrame, position: str, fields: list[str], order: str) -> DataFrame:
    """For each position the candidate with most non-empty fields."""
    filled = sum(((F.col(c).isNotNull() & (F.col(c).cast("string") != "")).cast("int") for c in fields), F.lit(0))
    return first_of(df.withColumn("__filled", filled), [position], [F.col("__filled").desc(), F.col(order)]).drop("__filled")


def base_and_rest(df: DataFrame, run: str, key: str) -> DataFrame:
    """The run with most entities is the base; entities of other runs come after, alike but for case once."""
    size = F.count("*").over(Window.partitionBy(run))
    return first_of(df.withColumn("__size", size), [F.lower(key)], [F.col("__size").desc(), run, key]).drop("__size")


def budget_cut(df: DataFrame, size: str, order: list, budget: int, within: list[str] = ()) -> DataFrame:
    """Rows in order while their running size stays in the budget; the first that overflows ends it."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running", F.sum(size).over(w)).where(F.col("running") <= budget)


def top_per(df: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long")).where(F.col("rank") <= k)


def batches(df: DataFrame, n: int, order: list, within: list[str] = ()) -> DataFrame:
    """Fixed-size batches in order."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*within).orderBy(*order)) - 1) / n))


def tiers(facts: DataFrame, lookups: list[tuple[Column, DataFrame, str]], value: str) -> DataFrame:
    """Resolve by the first lookup that knows the key: (key of a fact, lookup of one row a key, its key column)."""
    out, found = facts, []
    for i, (key, lookup, col) in enumerate(lookups):
        right = lookup.select(F.col(col).alias(f"__k{i}"), F.col(value).alias(f"__v{i}"))
        out = out.join(right, key == F.col(f"__k{i}"), "left")
        found.append(F.col(f"__v{i}"))
    return out.select(*facts.columns, F.coalesce(*found).alias(value))
