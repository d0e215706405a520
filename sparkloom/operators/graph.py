"""Typed property graphs as ``nodes(id, type, label)`` and ``edges(source, target, type)``."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .merge import first_of


def settled(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared folder; one of our own only where none is set."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(found or "file://" + tempfile.mkdtemp(prefix="sparkloom-"))
    return df.checkpoint()


def upsert_nodes(nodes: DataFrame, order: str = "ord") -> DataFrame:
    """First writer of an id wins."""
    return first_of(nodes, ["id"], [order, "type", "label"])


def upsert_edges(edges: DataFrame, order: str = "ord", one_type: bool = False) -> DataFrame:
    """One edge for (source, target, type); with ``one_type`` one for (source, target), the last writer's."""
    if one_type:
        return first_of(edges, ["source", "target"], [F.col(order).desc(), F.col("type").desc()])
    return first_of(edges, ["source", "target", "type"], [order])


def seeds(nodes: DataFrame, kind: str | None = None, label: str | None = None) -> DataFrame:
    """Nodes by exact type and part of the label, both without regard to case."""
    out = nodes
    if kind:
        out = out.where(F.lower("type") == kind.lower())
    if label:
        out = out.where(F.contains(F.lower("label"), F.lit(label.lower())))
    return out


def typed_hops(nodes: DataFrame, edges: DataFrame, start: DataFrame, hops: list[tuple[str, str]], return_type: str | None = None, limit: int | None = None) -> DataFrame:
    """Follow ordered hops ``(edge type, 'out' | 'in')`` from ``start``; distinct after each hop.

    The type of an edge is compared with its case; an unknown type gives
    nothing; without hops the seeds come back.
    """
    at = start.select("id")
    for kind, way in hops:
        here, there = ("source", "target") if way == "out" else ("target", "source")
        step = edges.where(F.col("type") == kind).select(F.col(here).alias("id"), F.col(there).alias("__to"))
        at = at.join(step, "id").select(F.col("__to").alias("id")).distinct()
    out = nodes.join(at, "id", "left_semi")
    if return_type:
        out = out.where(F.lower("type") == return_type.lower())
    return out.orderBy("id").limit(limit) if limit else out


def reachable(edges: DataFrame, start: DataFrame, depth: int | None = None) -> DataFrame:
    """``id, depth``: nodes within ``depth`` steps along edges, or any number, and their least number of steps.

    A level is joined once and loses what was seen before; levels are settled so
    that the plan stays short. Cycles end by themselves.
    """
    step = edges.select(F.col("source").alias("id"), F.col("target").alias("__to")).distinct()
    seen = settled(start.select("id").distinct().withColumn("depth", F.lit(0)))
    front = seen
    level = 0
    while depth is None or level < depth:
        level += 1
        front = settled(front.join(step, "id").select(F.col("__to").alias("id")).distinct().join(seen, "id", "left_anti").withColumn("depth", F.lit(level)))
        seen = seen.unionByName(front)
        if front.isEmpty():
            break
    return seen


def unreachable(nodes: DataFrame, edges: DataFrame, start: DataFrame, depth: int | None = None) -> DataFrame:
    return nodes.join(reachable(edges, start, depth), "id", "left_anti")


def shortest_paths(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """``start, id, path``: one path of fewest steps from each start to each node within ``depth``.

    Of paths of equal length the smallest by its nodes is kept, so the result has one answer.
    """
    step = edges.select(F.col("source").alias("id"), F.col("target").alias("__to")).where("source <> target").distinct()
    seen = settled(start.select(F.col("id").alias("start"), "id", F.array("id").alias("path")))
    front = seen
    for _ in range(depth):
        grown = front.join(step, "id").select("start", F.col("__to").alias("id"), F.concat("path", F.array("__to")).alias("path"))
        front = settled(grown.groupBy("start", "id").agg(F.min("path").alias("path")).join(seen, ["start", "id"], "left_anti"))
        seen = seen.unionByName(front)
        if front.isEmpty():
            break
    return seen


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("source").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("target").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return ends.groupBy("id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.sum(F.col("o") + F.col("i")).alias("degree"))


def min_labels(edges: DataFrame, rounds: int) -> DataFrame:
    """``id, community``: each node takes the smallest label around it, a fixed number of times.

    With rounds enough this gives connected components; with few it gives small
    communities around low ids. It is deterministic, unlike randomised clustering.
    """
    both = settled(edges.select("source", "target").unionByName(edges.select(F.col("target").alias("source"), F.col("source").alias("target"))).distinct())
    labels = both.select(F.col("source").alias("id")).distinct().withColumn("community", F.col("id"))
    for _ in range(rounds):
        offered = both.join(labels, F.col("target") == F.col("id")).select(F.col("source").alias("id"), "community")
        labels = settled(labels.unionByName(offered).groupBy("id").agg(F.min("community").alias("community")))
    return labels


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Modularity of a labelling of an undirected graph, from sums alone."""
    a, b = labels.select(F.col("id").alias("source"), F.col("community").alias("ca")), labels.select(F.col("id").alias("target"), F.col("community").alias("cb"))
    ends = edges.join(a, "source").join(b, "target")
    inner = ends.groupBy("ca").agg(F.count_if(F.col("ca") == F.col("cb")).alias("inside"))
    degree = ends.select(F.col("ca").alias("c")).unionByName(ends.select(F.col("cb").alias("c"))).groupBy("c").agg(F.count("*").alias("d"))
    m = edges.agg(F.count("*").alias("m"))
    return degree.join(inner, F.col("c") == F.col("ca"), "left").crossJoin(m).agg(F.round(F.sum(F.coalesce("inside", F.lit(0)) / F.col("m") - F.pow(F.col("d") / (2 * F.col("m")), 2)), 6).alias("modularity"))


def introspect(nodes: DataFrame, edges: DataFrame, each: int = 2, most: int = 12) -> DataFrame:
    """Node types with counts and a few examples; edge types with counts."""
    w = Window.partitionBy("type").orderBy("label", "id")
    examples = nodes.withColumn("n", F.row_number().over(w)).where(F.col("n") <= each).orderBy("type", "n").limit(most)
    shown = examples.groupBy("type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "label"))), lambda x: x["label"]), "; ").alias("examples"))
    kinds = nodes.groupBy("type").agg(F.count("*").alias("count")).join(shown, "type", "left").select(F.lit("node").alias("kind"), "type", "count", F.coalesce("examples", F.lit("")).alias("examples"))
    links = edges.groupBy("type").agg(F.count("*").alias("count")).select(F.lit("edge").alias("kind"), "type", "count", F.lit("").alias("examples"))
    return kinds.unionByName(links)


def of_type(nodes: DataFrame, edges: DataFrame, kinds: list[str]) -> tuple[DataFrame, DataFrame]:
    """The part of a graph between nodes of some types."""
    some = nodes.where(F.col("type").isin(kinds))
    ids = some.select("id")
    inner = edges.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")
    return some, inner


def two_hops(start: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, hop``: seeds (0), neighbours either way (1) and theirs (2), least hop kept."""
    both = edges.select("source", "target").unionByName(edges.select(F.col("target").alias("source"), F.col("source").alias("target"))).distinct()
    return reachable(both, start, 2).withColumnRenamed("depth", "hop")


def clustering(quality: DataFrame, low: float = 0.1, mid: float = 0.3) -> DataFrame:
    """``modularity, use``: if communities are worth using, or directories are better."""
    q = F.col("modularity")
    return quality.select("modularity", F.when(q >= mid, "communities").when(q >= low, "weak communities").otherwise("directories").alias("use"))


def by_directory(files: DataFrame, least: int = 2, rest: str = "Misc") -> DataFrame:
    """``file, community``: the folder of each file; folders of fewer than ``least`` files go to ``rest``."""
    folder = F.regexp_extract("file", r"^(.*)/[^/]+$", 1)
    rows = files.select("file", folder.alias("folder"))
    size = rows.groupBy("folder").agg(F.count("*").alias("n"))
    return rows.join(size, "folder").select("file", F.when((F.col("n") >= least) & (F.col("folder") != ""), F.col("folder")).otherwise(rest).alias("community"))


def without_redirects(edges: DataFrame, through: DataFrame) -> DataFrame:
    """``source, target``: edges of a graph from which the nodes ``through(id)`` are taken out, what enters them tied to what leaves them.

    One redirect after the other is followed until none is left between.
    """
    marked = through.select(F.col("id").alias("target"), F.lit(True).alias("pass")).distinct()
    step = settled(edges.select("source", "target").distinct().join(marked, "target", "left"))
    onward = step.select(F.col("source").alias("target"), F.col("target").alias("next"), F.col("pass").alias("again"))
    kept = step.join(through.select(F.col("id").alias("source")).distinct(), "source", "left_anti")
    done, front, seen = kept.where("pass is null").select("source", "target"), settled(kept.where("pass").select("source", "target")), None
    seen = front
    while not front.isEmpty():
        grown = front.join(onward, "target").select("source", F.col("next").alias("target"), "again")
        done = done.unionByName(grown.where("again is null").select("source", "target"))
        front = settled(grown.where("again").select("source", "target").distinct().join(seen, ["source", "target"], "left_anti"))
        seen = seen.unionByName(front)
    return done.distinct()
