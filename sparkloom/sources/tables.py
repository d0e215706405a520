"""Readers: driver tables, source trees, JSON lines, incremental scans; writers of artefacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: folders that a walk of sources leaves out.
SKIPPED = ("vendor", "node_modules", ".git", "storage", "cache", "dist", "build", "tests")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_files(spark: SparkSession, root: str, extensions: list[str], skipped=SKIPPED) -> DataFrame:
    """``path, text`` of every file below ``root`` with one of the extensions, one row a file."""
    glob = "*.{" + ",".join(e.lstrip(".") for e in extensions) + "}"
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root, wholetext=True)
    rows = found.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return rows.where(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, skipped))))


def changed(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Files whose path and sha1 are not in ``seen(path, sha1)``."""
    return files.withColumn("sha1", F.sha1(F.col("text").cast("binary"))).join(seen.select("path", "sha1"), ["path", "sha1"], "left_anti")


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """JSON lines; bad ones are dropped, or raise where ``strict``."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def write_artefact(df: DataFrame, path: str, kind: str = "json") -> None:
    """One artefact of a stage: ``json``, ``parquet``, ``csv`` or ``text``."""
    df.write.mode("overwrite").format(kind).save(path)


def mermaid(edges: DataFrame, order: list[str]) -> DataFrame:
    """One row with a Mermaid graph of ``source, label, target``, lines in the given order."""
    line = F.concat(F.lit("  "), F.col("source"), F.lit(" -->|"), F.col("label"), F.lit("| "), F.col("target"))
    lines = edges.select(F.struct(*order, line.alias("line")).alias("x")).agg(F.array_sort(F.collect_list("x")).alias("x"))
    return lines.select(F.concat(F.lit("graph LR\n"), F.array_join(F.col("x.line"), "\n")).alias("diagram"))
