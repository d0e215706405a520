"""Chunks of text for retrieval: one builder for each kind of artefact, with an anchor line before each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns of a table in one chunk, and edges of a node in one.
COLUMNS, EDGES = 12, 14


def anchor(kind: Column, name: Column, place: Column) -> Column:
    """The line that tells what a chunk is about, by its kind."""
    out = None
    for k, pattern in (("schema", "[TABLE] %s"), ("function", "[FUNCTION] %s in %s"), ("route", "[ROUTE] %s in %s"), ("form", "[FORM] %s in %s"), ("node", "[NODE] %s"), ("flow", "[FLOW] %s")):
        text = F.format_string(pattern, name, place) if pattern.count("%s") == 2 else F.format_string(pattern, name)
        out = F.when(kind == k, text) if out is None else out.when(kind == k, text)
    return out.otherwise(F.format_string("[%s] %s", F.upper(kind), name))


def _joined(df: DataFrame, keys: list[str], order: list, line: Column, sep: str) -> DataFrame:
    """Lines of bounded groups in order."""
    return df.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("line")))), lambda x: x["line"]), sep).alias("text"))


def of_schema(columns: DataFrame, each: int = COLUMNS) -> DataFrame:
    """``kind, name, place, part, text`` of tables (``table, ord, column, type``), ``each`` columns a part."""
    place = F.row_number().over(Window.partitionBy("table").orderBy("ord", "column")) - 1
    rows = columns.withColumn("n", place).withColumn("part", F.floor(F.col("n") / each))
    out = _joined(rows, ["table", "part"], ["n"], F.concat("column", F.lit(" "), "type"), ", ")
    return out.select(F.lit("schema").alias("kind"), F.col("table").alias("name"), F.lit("").alias("place"), F.col("part").cast("long").alias("part"), "text")


def of_functions(functions: DataFrame, calls: DataFrame, most: int = 8) -> DataFrame:
    """Functions (``name, file, params``) with what they call (``caller, file, callee``)."""
    ranked = calls.select(F.col("caller").alias("name"), "file", "callee").distinct().withColumn("n", F.row_number().over(Window.partitionBy("name", "file").orderBy("callee"))).where(F.col("n") <= most)
    called = _joined(ranked, ["name", "file"], ["n"], F.col("callee"), ", ").withColumnRenamed("text", "called")
    out = functions.join(called, ["name", "file"], "left")
    text = F.concat(F.lit("("), "params", F.lit(")"), F.when(F.col("called").isNotNull(), F.concat(F.lit(" calls "), "called")).otherwise(""))
    return out.select(F.lit("function").alias("kind"), "name", F.col("file").alias("place"), F.lit(0).cast("long").alias("part"), text.alias("text"))


def of_routes(routes: DataFrame) -> DataFrame:
    """Routes (``method, route, file, handler``)."""
    text = F.concat_ws(" ", F.upper("method"), "route", F.lit("->"), F.coalesce(F.nullif("handler", F.lit("")), F.col("file")))
    return routes.select(F.lit("route").alias("kind"), F.col("route").alias("name"), F.col("file").alias("place"), F.lit(0).cast("long").alias("part"), text.alias("text"))


def of_forms(fields: DataFrame, purpose) -> DataFrame:
    """Forms (``file, form, field, type``) with their fields, and a purpose by ``purpose`` (a function of the array of names)."""
    rows = fields.groupBy("file", "form").agg(F.array_sort(F.collect_set("field")).alias("names"))
    said = purpose(F.col("names"))
    text = F.concat(F.lit("fields: "), F.array_join("names", ", "), F.when(said != "", F.concat(F.lit("; "), said)).otherwise(""))
    return rows.select(F.lit("form").alias("kind"), F.col("form").cast("string").alias("name"), F.col("file").alias("place"), F.lit(0).cast("long").alias("part"), text.alias("text"))


def of_nodes(nodes: DataFrame, edges: DataFrame, least: int = 2, split: int = EDGES) -> DataFrame:
    """Nodes of ``least`` edges or more: one chunk, or a summary, one of incoming and one of outgoing edges where there are more than ``split``."""
    ends = edges.select(F.col("source").alias("id"), F.lit("out").alias("way"), "type", F.col("target").alias("other")).unionByName(edges.select(F.col("target").alias("id"), F.lit("in").alias("way"), "type", F.col("source").alias("other")))
    counted = ends.groupBy("id").agg(F.count("*").alias("degree"), F.count_if(F.col("way") == "in").alias("ins")).where(F.col("degree") >= least)
    big = F.col("degree") > split
    part = F.when(big, F.when(F.col("way") == "in", 1).otherwise(2)).otherwise(0)
    lines = _joined(ends.join(counted, "id").withColumn("part", part), ["id", "part"], ["way", "type", "other"], F.concat_ws(" ", "way", "type", "other"), "; ")
    summary = counted.where(big).select("id", F.lit(0).alias("part"), F.format_string("%d edges, %d in, %d out", F.col("degree"), F.col("ins"), F.col("degree") - F.col("ins")).alias("text"))
    return lines.unionByName(summary).join(nodes.select("id", "label"), "id").select(F.lit("node").alias("kind"), F.col("label").alias("name"), F.lit("").alias("place"), F.col("part").cast("long").alias("part"), "text")


def of_flows(steps: DataFrame) -> DataFrame:
    """Flows (``flow, step, page, action``), one line a step."""
    out = _joined(steps, ["flow"], ["step", "page"], F.format_string("%d. %s: %s", "step", "page", "action"), "\n")
    return out.select(F.lit("flow").alias("kind"), F.col("flow").cast("string").alias("name"), F.lit("").alias("place"), F.lit(0).cast("long").alias("part"), "text")


def chunks(parts: list[DataFrame], most: int = 1000) -> DataFrame:
    """``id, kind, text``: all chunks with their anchor, cut at ``most`` characters, each text once, named by its hash."""
    every = reduce(DataFrame.unionByName, parts)
    text = F.substring(F.concat(anchor(F.col("kind"), F.col("name"), F.col("place")), F.lit("\n"), "text"), 1, most)
    return every.select("kind", text.alias("text")).groupBy("text").agg(F.min("kind").alias("kind")).select(F.substring(F.sha2("text", 256), 1, 16).alias("id"), "kind", "text")
