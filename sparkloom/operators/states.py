"""State sets, transitions and state machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import reachable


#: Texts that are never states.
NOISE = tuple("null none true false yes no n/a asc desc limit offset where set and or save edit create view list search delete detail update index show new get post put patch head options upload download module action subpanel return export import".split())
#: Words of XML schemas that are never states.
XML_NOISE = tuple("binding body envelope header message porttype schema service operation fault part type element attribute extension restriction sequence choice complextype simpletype annotation documentation import".split())


def noise(value: Column) -> Column:
    """Values that are no states: listed words, whole numbers, UUIDs and those of two characters or fewer."""
    v = F.lower(F.trim(value))
    return v.isin(*NOISE, *XML_NOISE) | v.rlike(r"^[0-9]+$") | v.rlike(r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$") | (F.length(v) <= 2)


def inventory(facts: DataFrame, group: list[str], value: str, least: int = 2) -> DataFrame:
    """Distinct states of each group with at least ``least`` of them."""
    return facts.where(~noise(F.col(value))).groupBy(*group).agg(F.array_sort(F.collect_set(value)).alias("states")).where(F.size("states") >= least)


def consecutive(facts: DataFrame, partition: list[str], order: list[str], value: str, at: str | None = None, gap: float | None = None) -> DataFrame:
    """Pairs of values that follow each other, within ``gap`` of ``at`` where given."""
    w = Window.partitionBy(*partition).orderBy(*order)
    out = facts.withColumn("from_state", F.lag(value).over(w))
    if gap is not None:
        out = out.withColumn("__gap", F.col(at) - F.lag(at).over(w)).where(F.col("__gap") <= gap).drop("__gap")
    return out.withColumnRenamed(value, "to_state").where(F.col("from_state").isNotNull())


def machine(states: DataFrame, transitions: DataFrame) -> DataFrame:
    """``state, initial, terminal, dead`` from ``states(state)`` and ``transitions(from_state, to_state)``.

    Initial: nothing enters from another state; terminal: nothing leaves to
    another; dead: not reachable from an initial state (so a pure cycle is dead,
    and a state without transitions is both initial and terminal).
    """
    moves = transitions.where("from_state <> to_state").select(F.col("from_state").alias("source"), F.col("to_state").alias("target")).distinct()
    entered = moves.select(F.col("target").alias("state")).distinct().withColumn("e", F.lit(True))
    left = moves.select(F.col("source").alias("state")).distinct().withColumn("l", F.lit(True))
    flags = states.select("state").distinct().join(entered, "state", "left").join(left, "state", "left").select("state", F.col("e").isNull().alias("initial"), F.col("l").isNull().alias("terminal"))
    live = reachable(moves, flags.where("initial").select(F.col("state").alias("id"))).select(F.col("id").alias("state"), F.lit(True).alias("live"))
    return flags.join(live, "state", "left").select("state", "initial", "terminal", F.col("live").isNull().alias("dead"))


def mermaid_states(transitions: DataFrame) -> DataFrame:
    line = F.concat(F.lit("  "), F.col("from_state"), F.lit(" --> "), F.col("to_state"))
    rows = transitions.select("from_state", "to_state").distinct().select(F.struct("from_state", "to_state", line.alias("line")).alias("x"))
    return rows.agg(F.concat(F.lit("stateDiagram-v2\n"), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda r: r["line"]), "\n")).alias("diagram"))
