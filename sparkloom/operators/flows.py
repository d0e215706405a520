"""Checks of business flows against the code they are said to describe.

A flow has steps ``flow, step, page, action, is_branch`` and evidence files. A
page is a file (``x.php``) or a route (``/x``). Every check gives findings; the
reader decides how many to show.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import basename, normal_route
from ..functions.text import fuzzy_contains
from .merge import in_blocks

#: Methods and kinds of routes that are no handlers, tables that are none, verbs of a database operation.
PSEUDO_METHODS = ("", "GROUP", "MIDDLEWARE", "PREFIX")
UI_KINDS = ("nextjs_page", "nextjs_app_router", "nextjs_pages_router")
NO_TABLES = ("", "unknown", "temp", "tmp", "dual")
VERBS = ("select", "insert", "update", "delete", "replace", "create", "alter", "drop", "truncate")


def real_routes(routes: DataFrame) -> DataFrame:
    """Routes that handle requests: no grouping entries and no pages of a user interface."""
    return routes.where(~F.upper(F.coalesce("method", F.lit(""))).isin(*PSEUDO_METHODS) & ~F.coalesce("kind", F.lit("")).isin(*UI_KINDS))


def real_table(name: Column) -> Column:
    return ~F.lower(F.coalesce(name, F.lit(""))).isin(*NO_TABLES)


def clean_route(page: Column) -> Column:
    """A route without query string and trailing slash, in lower case."""
    path = F.regexp_replace(F.lower(F.element_at(F.split(page, r"\?"), 1)), "/+$", "")
    return F.when(path == "", "/").otherwise(path)


def prefixes(path: Column) -> Column:
    """The path and all paths above it: ``/a/b`` gives ``/a`` and ``/a/b``."""
    parts = F.split(path, "/")
    return F.filter(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")), lambda p: p != "")


def known_paths(paths: DataFrame, routes: DataFrame) -> DataFrame:
    """Those of ``paths(path)`` that are a route, are one in normal form, lie below one or above one.

    Prefix tests are equi-joins on exploded prefixes, so no pair is tried that does not meet.
    """
    routes = routes.select(F.regexp_replace("route", "/+$", "").alias("route")).where("route <> ''").distinct()
    same = paths.join(routes, F.col("path") == F.col("route"), "left_semi")
    alike = paths.join(routes.select(normal_route(F.col("route")).alias("norm")).distinct(), normal_route(F.col("path")) == F.col("norm"), "left_semi")
    below = paths.withColumn("up", F.explode(prefixes(F.col("path")))).join(routes, F.col("up") == F.col("route"), "left_semi").select("path")
    above = paths.join(routes.select(F.explode(prefixes(F.col("route"))).alias("up")).distinct(), F.col("path") == F.col("up"), "left_semi")
    return reduce(DataFrame.unionByName, [same, alike, below, above]).distinct()


def hallucinated(steps: DataFrame, files: DataFrame, routes: DataFrame, tables: DataFrame) -> DataFrame:
    """``flow, step, kind, value``: files, routes and tables named by steps (``db_ops`` an array) that do not exist.

    Redirect steps and branches are not looked at.
    """
    own = steps.where(~F.startswith(F.coalesce("action", F.lit("")), F.lit("Redirect →")) & ~F.coalesce("is_branch", F.lit(False)))
    page = F.trim(F.coalesce("page", F.lit("")))
    php = own.where(F.endswith(page, F.lit(".php"))).select("flow", "step", F.lit("file").alias("kind"), basename(page).alias("value"))
    php = php.join(files.select(basename("file").alias("value")).distinct(), "value", "left_anti")
    paths = own.where(F.startswith(page, F.lit("/")) & ~F.endswith(page, F.lit(".php"))).select("flow", "step", F.lit("route").alias("kind"), clean_route(page).alias("value"))
    paths = paths.join(known_paths(paths.select(F.col("value").alias("path")).distinct(), routes).withColumnRenamed("path", "value"), "value", "left_anti")
    words = F.split(F.trim("op"), r"\s+")
    ops = own.select("flow", "step", F.explode("db_ops").alias("op")).where((F.size(words) >= 2) & F.lower(words[0]).isin(*VERBS))
    ops = ops.select("flow", "step", F.lit("table").alias("kind"), F.regexp_replace(F.lower(words[1]), r"^[`\"'();,]+|[`\"'();,]+$", "").alias("value"))
    ops = ops.where(real_table(F.col("value")) & (F.length("value") > 2) & ~F.contains("value", F.lit(":"))).join(tables.select(F.lower("table").alias("value")).distinct(), "value", "left_anti")
    return reduce(DataFrame.unionByName, [x.select("flow", "step", "kind", "value") for x in (php, paths, ops)])


def broken(flows: DataFrame, steps: DataFrame, files: DataFrame) -> DataFrame:
    """``flow, issues, severity`` of flows (``flow, evidence``, an array) without a chain that code backs.

    Fewer than two steps: minor, major without evidence. No evidence: critical.
    No evidence file known, or no file page known: at least major.
    """
    known = files.select(basename("file").alias("file")).distinct().withColumn("known", F.lit(True))
    per_flow = steps.groupBy("flow").agg(F.count("*").alias("steps"))
    backed = flows.select("flow", F.explode("evidence").alias("e")).select("flow", basename("e").alias("file")).join(known, "file", "left").groupBy("flow").agg(F.count("known").alias("backed"))
    pages = steps.where(F.endswith("page", F.lit(".php"))).select("flow", basename("page").alias("file")).join(known, "file", "left").groupBy("flow").agg(F.count("*").alias("pages"), F.count("known").alias("found"))
    rows = flows.join(per_flow, "flow", "left").join(backed, "flow", "left").join(pages, "flow", "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    none, short = F.size(F.coalesce("evidence", F.array().cast("array<string>"))) == 0, n("steps") < 2
    foreign, invented = ~none & (n("backed") == 0), (n("pages") > 0) & (n("found") == 0)
    issues = F.when(short, 1).otherwise(0) + F.when(none | foreign, 1).otherwise(0) + F.when(invented, 1).otherwise(0)
    severity = F.when(none, "critical").when(foreign | invented, "major").otherwise("minor")
    return rows.select("flow", issues.cast("long").alias("issues"), severity.alias("severity")).where("issues > 0")


def broken_status(findings: DataFrame, warn: int = 2, fail: int = 4, critical: int = 2) -> DataFrame:
    """``status, findings, critical, major`` of broken flows: minor ones alone only warn."""
    n = lambda s: F.count_if(F.col("severity") == s)
    out = findings.agg(F.count("*").alias("findings"), n("critical").alias("critical"), n("major").alias("major"))
    weighty = F.col("critical") + F.col("major")
    return out.withColumn("status", F.when((weighty > fail) | (F.col("critical") > critical), "fail").when(F.col("findings") > 0, "warn").otherwise("pass"))


def unguarded(guards: DataFrame, signals: DataFrame, seen: DataFrame, aware: DataFrame) -> DataFrame:
    """``file, guard, severity``: guarded files (``file, guard, ord``) that no flow aware of authorisation covers.

    ``seen(file)`` are files of any flow, ``aware(file)`` those of aware ones. The
    first guard of a file counts; signals count only for files of a flow without a guard of their own.
    """
    def first(df):
        named = df.select(basename("file").alias("file"), "guard", "ord").where("file <> ''")
        return named.groupBy("file").agg(F.min_by("guard", F.struct("ord", "guard")).alias("guard"))

    seen = seen.select(basename("file").alias("file")).distinct()
    aware = aware.select(basename("file").alias("file")).distinct()
    guarded = first(guards)
    one = guarded.join(aware, "file", "left_anti").join(seen.withColumn("in_flow", F.lit(True)), "file", "left").select("file", "guard", F.when(F.col("in_flow"), "major").otherwise("minor").alias("severity"))
    two = first(signals).join(guarded.select("file"), "file", "left_anti").join(aware, "file", "left_anti").join(seen, "file", "left_semi").select("file", "guard", F.lit("major").alias("severity"))
    return one.unionByName(two)


def traced(flow_pages: DataFrame, contexts: DataFrame, feature_pages: DataFrame, features: DataFrame) -> DataFrame:
    """``flow, feature``: the feature of each flow, by a shared page, else by a name that resembles its context.

    Features meet the contexts in blocks; the first by name wins.
    """
    shared = flow_pages.select("flow", basename("page").alias("page")).join(feature_pages.select("feature", basename("page").alias("page")), "page").groupBy("flow").agg(F.min("feature").alias("feature"))
    left = contexts.where(F.coalesce("context", F.lit("")) != "").join(shared, "flow", "left_anti")
    alike = fuzzy_contains(F.col("context"), F.col("feature")) | fuzzy_contains(F.col("feature"), F.col("context"))
    named = in_blocks(features.select("feature").distinct(), lambda some: left.join(F.broadcast(some), alike).select("flow", "feature")).groupBy("flow").agg(F.min("feature").alias("feature"))
    return shared.unionByName(named)


def without_heading(features: DataFrame, headings: DataFrame) -> DataFrame:
    """``artefact, feature``: features that no heading of an artefact (``artefact, heading``) names."""
    names = features.select("feature").distinct()
    every = names.crossJoin(F.broadcast(headings.select("artefact").distinct()))  # artefacts are a handful
    found = in_blocks(names, lambda some: headings.join(F.broadcast(some), fuzzy_contains(F.col("feature"), F.col("heading"))).select("artefact", "feature").distinct())
    return every.join(found, ["artefact", "feature"], "left_anti")


def routes_outside(routes: DataFrame, pages: DataFrame) -> DataFrame:
    """``method, route, file``: the first registration of each route whose file no flow step names."""
    some = real_routes(routes).select(F.upper("method").alias("method"), "route", "file", "ord").join(pages.select(basename("page").alias("b")).distinct(), basename("file") == F.col("b"), "left_anti")
    return some.groupBy("method", "route").agg(F.min_by("file", F.struct("ord", "file")).alias("file"))


def writes_outside(writes: DataFrame, pages: DataFrame) -> DataFrame:
    """``operation, table, file, severity`` of database writes in files that no flow step names, the first file of each."""
    op = F.upper(F.trim("operation"))
    some = writes.where(op.isin("INSERT", "UPDATE", "DELETE", "REPLACE") & ~F.upper(F.coalesce("table", F.lit(""))).isin("", "UNKNOWN") & (basename("file") != ""))
    left = some.join(pages.select(basename("page").alias("b")).distinct(), basename("file") == F.col("b"), "left_anti")
    out = left.groupBy(op.alias("operation"), F.lower("table").alias("table")).agg(F.min_by("file", F.struct("ord", "file")).alias("file"))
    return out.withColumn("severity", F.when(F.col("operation").isin("DELETE", "REPLACE"), "critical").when(F.col("operation") == "UPDATE", "major").otherwise("minor"))


def low_confidence(report: DataFrame, least: float = 0.4) -> DataFrame:
    """``feature, score, severity`` of features below ``least``; without any evidence it is critical."""
    return report.where(F.col("score") <= least - 1e-9).select("feature", "score", F.when(F.col("score") <= 1e-9, "critical").otherwise("major").alias("severity"))


def orphans(texts: DataFrame, pattern: str, names: DataFrame, name: str, ratio: float = 0.7, skip: str | None = None, text: str = "text") -> DataFrame:
    """``item``: what a pattern finds in texts (headings, actors) that resembles none of ``names``, which meet it in blocks.

    The names may hold the item, or the item a name, wholly or by ``ratio`` of its words. Items that match ``skip`` are meant to be alone.
    """
    found = texts.select(F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).alias("item")).select(F.trim("item").alias("item")).where("item <> ''").distinct()
    if skip:
        found = found.where(~F.col("item").rlike(skip))
    n = F.col(name)
    alike = fuzzy_contains(F.col("item"), n, ratio) | F.contains(F.lower("item"), F.lower(n))
    met = in_blocks(names.select(name).distinct(), lambda some: found.join(F.broadcast(some), alike).select("item").distinct())
    return found.join(met, "item", "left_anti")


#: Signals of readiness with their weights.
READINESS = {"has_sql": 20, "has_tables": 15, "has_forms": 10, "has_auth": 10, "has_functions": 10, "has_graph": 5, "has_embeddings": 5, "has_graphrag": 10, "has_entities": 5, "has_relationships": 5, "has_statemachines": 5}


def preflight(counts: DataFrame, blockers: dict[str, Column], warnings: dict[str, Column], signals: dict[str, Column], weights: dict[str, int] | None = None) -> DataFrame:
    """One row ``passed, blockers, warnings, score`` from one row of counts.

    ``blockers`` and ``warnings`` are conditions by name; their names are listed
    in order. Warnings count only where nothing blocks. ``score`` adds the weights of the signals that hold.
    """
    weights = weights or READINESS
    listed = lambda some: F.array_join(F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in some.items()], F.lit(None).cast("string")), lambda x: x.isNotNull()), ",")
    score = sum((F.when(F.coalesce(c, F.lit(False)), weights[n]).otherwise(0) for n, c in signals.items()), F.lit(0))
    out = counts.select(listed(blockers).alias("blockers"), listed(warnings).alias("warnings"), score.cast("long").alias("score"))
    return out.select((F.col("blockers") == "").alias("passed"), "blockers", F.when(F.col("blockers") == "", F.col("warnings")).otherwise("").alias("warnings"), "score")
