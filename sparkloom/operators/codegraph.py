"""The graph of a code base: who handles, calls and is reached from what.

Node ids are ``file::name`` for functions, ``Class::method`` for methods,
``ROUTE:verb path`` for routes, ``SQL:operation table`` for queries and
``EXTCALL:name`` for calls that leave the code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import reachable
from .merge import first_of

#: Signs of an interface for programs.
API_PREFIXES = ("/api/", "/api", "/v1/", "/v2/", "/v3/", "/rest/", "/graphql", "/webhook", "/webhooks")
API_MIDDLEWARE = ("api", "auth:api", "auth:sanctum", "throttle", "jwt", "jwt.auth", "passport")
API_FILES = ("api.php", "api_routes.php", "routes_api.php")
API_METHODS = ("api", "json", "ajax", "xhr", "store", "destroy", "index", "show", "create", "update")
JSON_CALLS = ("json_encode", "json_decode")
#: Relations whose inverse has another name.
INVERSE = {"has_many": "belongs_to", "has_one": "belongs_to", "belongs_to": "has_many"}


def inverse(kind: Column) -> Column:
    """The name of a relation seen from its other end; most keep their name."""
    out = kind
    for name, other in INVERSE.items():
        out = F.when(kind == name, other).otherwise(out)
    return out


def bare_class(name: Column) -> Column:
    """A class name without its namespace."""
    return F.element_at(F.split(name, r"\\"), -1)


def resolved_handlers(routes: DataFrame, methods: DataFrame) -> DataFrame:
    """Routes with ``node``, the method that ``Class@m`` or ``Class::m`` names; null where none does.

    ``methods``: ``parent, method, node, ord``. The exact class wins, then the first
    whose qualified name ends with it. Closures have no handler.
    """
    handler = F.coalesce("handler", F.lit(""))
    parts = F.split(handler, "@|::")
    named = routes.withColumn("__class", F.when(~F.startswith(handler, F.lit("(closure)")) & (F.size(parts) >= 2), bare_class(F.element_at(parts, -2)))).withColumn("__method", F.element_at(parts, -1))
    exact = first_of(methods.where(~F.contains("parent", F.lit("\\"))), ["parent", "method"], ["ord"]).select(F.col("parent").alias("__class"), F.col("method").alias("__method"), F.col("node").alias("__exact"))
    within = first_of(methods.withColumn("__class", bare_class(F.col("parent"))), ["__class", "method"], ["ord"]).select("__class", F.col("method").alias("__method"), F.col("node").alias("__within"))
    out = named.join(exact, ["__class", "__method"], "left").join(within, ["__class", "__method"], "left")
    return out.select(*routes.columns, F.coalesce("__exact", "__within").alias("node"))


def resolved_calls(calls: DataFrame, functions: DataFrame, methods: DataFrame, noise: DataFrame) -> DataFrame:
    """``caller, callee`` nodes of ``caller, callee, file`` calls, each pair once.

    A callee is a function of the same file, else the first function of this name,
    else a method (of the same file if there is one, or the first), else an
    ``EXTCALL`` unless it is a noisy builtin. A caller is a function of the file, else any of this name, else the file.
    ``functions``: ``name, file, ord``; ``methods``: ``method, node, file, ord``.
    """
    node = F.concat_ws("::", "file", "name")
    same = functions.select(F.col("name").alias("__n"), F.col("file").alias("__f"), node.alias("__node")).distinct()
    anywhere = first_of(functions, ["name"], ["ord"]).select(F.col("name").alias("__n"), node.alias("__node"))
    own = first_of(methods, ["method", "file"], ["ord"]).select(F.col("method").alias("__n"), F.col("file").alias("__f"), F.col("node").alias("__node"))
    other = first_of(methods, ["method"], ["ord"]).select(F.col("method").alias("__n"), F.col("node").alias("__node"))
    tiers = [(same, True), (anywhere, False), (own, True), (other, False)]

    def find(rows: DataFrame, key: str, name: str, tiers) -> DataFrame:
        found = []
        for i, (lookup, by_file) in enumerate(tiers):
            one = lookup.withColumnRenamed("__node", f"__{name}{i}").withColumnRenamed("__n", f"__k{i}")
            on = F.col(key) == F.col(f"__k{i}")
            if by_file:
                one = one.withColumnRenamed("__f", f"__g{i}")
                on = on & (F.col("file") == F.col(f"__g{i}"))
            rows = rows.join(one, on, "left").drop(f"__k{i}", f"__g{i}")
            found.append(F.col(f"__{name}{i}"))
        return rows.withColumn(name, F.coalesce(*found)).drop(*[f"__{name}{i}" for i in range(len(tiers))])

    rows = find(calls.where(F.coalesce("callee", F.lit("")) != ""), "callee", "to", tiers)
    rows = find(rows, "caller", "from", tiers[:2]).join(F.broadcast(noise.select(F.col("name").alias("callee")).distinct().withColumn("__noise", F.lit(True))), "callee", "left")
    rows = rows.where(F.col("to").isNotNull() | F.col("__noise").isNull())
    return rows.select(F.coalesce("from", "file").alias("caller"), F.coalesce("to", F.concat(F.lit("EXTCALL:"), "callee")).alias("callee")).distinct()


def code_graph(files: DataFrame, classes: DataFrame, methods: DataFrame, functions: DataFrame, routes: DataFrame, includes: DataFrame, sql: DataFrame, redirects: DataFrame, calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``nodes(id, type, label)`` and ``edges(source, target, type)`` of a code map, one select for each kind.

    ``files(file)``, ``classes(name, file)``, ``methods(parent, method, node, file, ord)``,
    ``functions(name, file, ord)``, ``routes(method, route, file, node)`` with
    resolved handlers, ``includes(file, target)``, ``sql(file, operation, table)``,
    ``redirects(file, target)`` and resolved ``calls(caller, callee)``. The first kind in this order names a node; ends without a node become ``unknown``.
    """
    n = lambda df, i, id_, kind, label: df.select(F.lit(i).alias("ord"), id_.alias("id"), F.lit(kind).alias("type"), label.alias("label"))
    e = lambda df, a, b, kind: df.select(a.alias("source"), b.alias("target"), F.lit(kind).alias("type"))
    c = F.col
    route, query = F.concat(F.lit("ROUTE:"), F.upper("method"), F.lit(" "), "route"), F.concat(F.lit("SQL:"), F.upper("operation"), F.lit(" "), F.lower("table"))
    table, function = F.concat(F.lit("TABLE:"), F.lower("table")), F.concat_ws("::", "file", "name")
    edges = [
        e(classes, c("file"), c("name"), "defines"), e(methods, c("parent"), c("node"), "has_member"), e(functions, c("file"), function, "defines"),
        e(routes, c("file"), route, "registers"), e(routes.where("node is not null"), route, c("node"), "handles"), e(includes, c("file"), c("target"), "includes"),
        e(sql, c("file"), query, "executes"), e(sql, query, table, "queries"), e(redirects, c("file"), c("target"), "redirects_to"), e(calls, c("caller"), c("callee"), "calls"),
    ]
    edges = reduce(DataFrame.unionByName, edges).distinct()
    nodes = [
        n(files, 0, c("file"), "file", c("file")), n(classes, 1, c("name"), "class", c("name")), n(methods, 2, c("node"), "method", c("method")), n(functions, 3, function, "function", c("name")),
        n(routes, 4, route, "route", c("route")), n(sql, 5, query, "sql_query", c("operation")), n(sql, 6, table, "db_table", F.lower("table")),
        n(calls.where(F.startswith("callee", F.lit("EXTCALL:"))), 7, c("callee"), "external_function", F.substr("callee", F.lit(9))),
    ]
    ends = edges.select(c("source").alias("id")).unionByName(edges.select(c("target").alias("id"))).distinct()
    named = reduce(DataFrame.unionByName, [*nodes, n(ends, 99, c("id"), "unknown", c("id"))])
    return named.groupBy("id").agg(F.min(F.struct("ord", "type", "label")).alias("m")).select("id", "m.type", "m.label"), edges


def route_chains(routes: DataFrame, services: DataFrame, sql: DataFrame, redirects: DataFrame, depth: int = 3, most_sql: int = 6) -> DataFrame:
    """``route, controller, services, operations, redirects, confidence``: what a route leads to.

    ``routes(route, controller, guarded)``; ``services(source, target)`` are
    dependencies of classes, followed up to ``depth`` steps from a controller;
    ``sql(class, operation)`` and ``redirects(class, target)`` are collected over the
    controller and its services, operations up to ``most_sql`` in order. Confidence is 0.25 and 0.10 for each of services,
    operations, redirects and a guard, 0.85 at the most.
    """
    starts = routes.select(F.col("controller").alias("id")).distinct()
    step, seen = services.select(F.col("source").alias("at"), F.col("target").alias("to")).distinct(), starts.select("id", F.col("id").alias("at"))
    for _ in range(depth):
        seen = seen.unionByName(seen.join(step, "at").select("id", F.col("to").alias("at"))).distinct()
    joined = lambda df, col, name, most: seen.join(df.select(F.col("class").alias("at"), F.col(col).alias("v")), "at").groupBy("id").agg(F.array_join(F.slice(F.array_sort(F.collect_set("v")), 1, most), ",").alias(name))
    used = seen.where("at <> id").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("at")), ",").alias("services"))
    out = routes.withColumnRenamed("controller", "id").join(used, "id", "left").join(joined(sql, "operation", "operations", most_sql), "id", "left").join(joined(redirects, "target", "redirects", most_sql), "id", "left")
    parts = [F.col("services").isNotNull(), F.col("operations").isNotNull(), F.col("redirects").isNotNull(), F.col("guarded")]
    from .rules import path_confidence

    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return out.select("route", F.col("id").alias("controller"), empty("services"), empty("operations"), empty("redirects"), F.round(path_confidence(*parts), 4).alias("confidence"))


def api_routes(routes: DataFrame, calls: DataFrame, depth: int = 4) -> DataFrame:
    """``id, signals, is_api`` of ``routes(id, route, middleware, file, handler, node)``.

    Strong signals (each enough): the path, the middleware (an array), the file,
    and a JSON call within ``depth`` calls of the handler's node. The handler's name is weak, and two weak ones are needed.
    """
    low = F.lower("route")
    path = reduce(lambda a, b: a | b, [F.contains(low, F.lit("/" + p.strip("/"))) for p in API_PREFIXES])
    ware = F.arrays_overlap(F.transform("middleware", lambda m: F.lower(F.trim(m))), F.array(*map(F.lit, API_MIDDLEWARE)))
    file = F.element_at(F.split("file", "/"), -1).isin(*API_FILES)
    name = F.lower(F.element_at(F.split("handler", "@|::"), -1)).rlike("|".join(API_METHODS))
    back = calls.select(F.col("callee").alias("source"), F.col("caller").alias("target"))
    ends = calls.where(F.col("callee").isin(*[f"EXTCALL:{c}" for c in JSON_CALLS])).select(F.col("callee").alias("id")).distinct()
    json = reachable(back, ends, depth).where("depth > 0").select(F.col("id").alias("node"), F.lit(True).alias("json"))
    rows = routes.join(json, "node", "left")
    signals = [("path_prefix", path), ("middleware", ware), ("api_route_file", file), ("handler_name", name), ("reachable_json", F.coalesce("json", F.lit(False)))]
    listed = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in signals]), lambda x: x.isNotNull())
    out = rows.select("id", listed.alias("s"))
    weak = F.size(F.array_intersect("s", F.array(F.lit("handler_name"))))
    return out.select("id", F.array_join("s", ",").alias("signals"), ((F.size("s") > weak) | (weak >= 2)).alias("is_api"))


def context_index(files: DataFrame, calls: DataFrame, rules: DataFrame, columns: DataFrame, tables: DataFrame, most_rules: int = 10, most_calls: int = 8, most_columns: int = 8) -> DataFrame:
    """``kind, id, facts``: what is known of each file and entity, in capped sorted lists.

    ``files(file)``, ``calls(file, callee)``, ``rules(file, rule)``, ``columns(table, column)``, ``tables(file, table)``.
    """
    def listed(df, key, value, name, most):
        ranked = df.select(key, value).distinct().withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(value))).where(F.col("n") <= most)
        return ranked.groupBy(key).agg(F.concat(F.lit(f"{name}="), F.array_join(F.array_sort(F.collect_list(value)), ",")).alias(name))

    of_file = files.select("file").distinct().join(listed(calls, "file", "callee", "calls", most_calls), "file", "left").join(listed(rules, "file", "rule", "rules", most_rules), "file", "left").join(listed(tables, "file", "table", "tables", most_columns), "file", "left")
    of_table = listed(columns, "table", "column", "columns", most_columns)
    one = of_file.select(F.lit("file").alias("kind"), F.col("file").alias("id"), F.concat_ws(";", "calls", "rules", "tables").alias("facts"))
    return one.unionByName(of_table.select(F.lit("entity").alias("kind"), F.col("table").alias("id"), F.col("columns").alias("facts")))
