"""Roles, flow patterns, transitions, relationships, gates and the graph of a system, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import domain
from ..sources.tables import table
from .registry import query


def _f(pattern, *cols):
    return F.format_string(pattern, *[F.col(c) if isinstance(c, str) else c for c in cols])


def _pick(values, index):
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


@query("""WITH a AS (SELECT p_partkey, ['Item', 'StripeGateway', 'AuditLog', 'Thing'][p_partkey % 4 + 1] || p_partkey AS symbol, ['app/Http/', 'app/Jobs/', 'src/'][p_partkey % 3 + 1] || 'f' || p_partkey || '.php' AS file, CASE WHEN p_size % 2 = 0 THEN 'POST' ELSE 'GET' END AS method, ['/shop/p' || p_partkey, '/login', '/health/x', ''][p_size % 4 + 1] AS path, CASE WHEN p_size % 5 = 0 THEN 1 WHEN p_size % 5 = 1 THEN 2 ELSE 0 END AS w, p_size > 25 AS guarded FROM part),
s AS (SELECT *, (CASE WHEN contains(file, '/Jobs/') THEN -2 ELSE 0 END) + (CASE WHEN contains(lower(symbol), 'audit') THEN -1 ELSE 0 END) + (CASE WHEN path = '/health/x' THEN -1 ELSE 0 END) + (CASE WHEN guarded THEN 2 ELSE 0 END) + (CASE w WHEN 1 THEN 2 WHEN 2 THEN -2 ELSE 0 END) + (CASE WHEN path <> '' AND path <> '/health/x' THEN 1 ELSE 0 END) + (CASE WHEN method = 'POST' THEN 1 ELSE 0 END) AS score FROM a),
r AS (SELECT *, CASE WHEN path = '/login' THEN 'AUTH_ACTION' WHEN contains(symbol, 'Stripe') THEN 'INTEGRATION' WHEN score >= 3 THEN 'BUSINESS_ACTION' WHEN score >= 1 THEN 'CRUD_ACTION' ELSE 'INFRASTRUCTURE' END AS role FROM s)
SELECT symbol, role, score, round(CASE role WHEN 'AUTH_ACTION' THEN 0.9 WHEN 'INTEGRATION' THEN 0.85 WHEN 'BUSINESS_ACTION' THEN least(0.95, 0.7 + score * 0.05) WHEN 'CRUD_ACTION' THEN 0.7 ELSE least(0.9, 0.6 + abs(score) * 0.05) END, 2)::DOUBLE AS confidence FROM r""")
def q30b_action_roles(spark, sf_dir):
    k, z = F.col("p_partkey"), F.col("p_size")
    symbol = F.concat(_pick(("Item", "StripeGateway", "AuditLog", "Thing"), k), k.cast("string"))
    path = F.when(z % 4 == 0, _f("/shop/p%d", k)).when(z % 4 == 1, "/login").when(z % 4 == 2, "/health/x").otherwise("")
    writes = F.when(z % 5 == 0, F.array(F.lit("orders"), F.lit("cache"))).when(z % 5 == 1, F.array(F.lit("audit_x"))).otherwise(F.array().cast("array<string>"))
    rows = table(spark, sf_dir, "part").select(symbol.alias("symbol"), F.concat(_pick(("app/Http/", "app/Jobs/", "src/"), k), _f("f%d.php", k)).alias("file"), F.when(z % 2 == 0, "POST").otherwise("GET").alias("method"), path.alias("path"), writes.alias("writes"), (z > 25).alias("guarded"))
    return domain.action_roles(rows)


def _words(name, col, words):
    return f"len(list_filter({col}, lambda x: {' OR '.join(f'''contains(lower(x), '{w.lower()}')''' for w in words)})) > 0"


def _rule_sql(kind, value):
    if kind in ("steps", "input_steps", "auth_steps"):
        return f"{kind} >= {value}"
    if kind in ("input_count", "output_count"):
        return f"len({kind.removesuffix('_count')}s) >= {value}"
    if kind == "methods":
        return f"list_contains(methods, '{value}')"
    if kind == "methods_all":
        return " AND ".join(f"list_contains(methods, '{v}')" for v in value.split())
    if kind == "reads_only":
        return "NOT (" + _words(kind, "db_ops", ["insert", "update", "delete"]) + ")"
    return _words(kind, kind, [value] if value == "→ " else value.split())


_SCORES = ", ".join("(" + " + ".join(f"({_rule_sql(*r)})::INT" for r in rules) + f") AS s{i}" for i, (_, _, rules) in enumerate(domain.PATTERNS))
_LISTED = ", ".join(f"{{'name': '{name}', 'score': CASE WHEN s{i} >= {least} THEN s{i} ELSE 0 END, 'i': {i}}}" for i, (name, least, _) in enumerate(domain.PATTERNS))


@query(f"""WITH f AS (SELECT o_orderkey AS flow, [['login.php'], ['cart.php', 'step2.php'], ['list.php', 'search.php'], ['reset_x.php'], ['report.php'], ['logout.php'], ['upload.php'], ['misc.php']][o_orderkey % 8 + 1] AS files, [['email', 'password'], ['total', 'card'], ['q'], ['file'], [], ['status']][o_custkey % 6 + 1] AS inputs, [['GET'], ['POST'], ['GET', 'POST']][o_orderkey % 3 + 1] AS methods, [['user'], []][o_custkey % 2 + 1] AS sessions, [['→ home'], ['session destroyed', 'a', 'b'], []][o_custkey % 3 + 1] AS outputs, [['INSERT a'], ['SELECT b'], ['UPDATE c', 'SELECT d'], []][o_orderkey % 4 + 1] AS db_ops, o_orderkey % 5 AS steps, o_custkey % 4 AS input_steps, o_orderkey % 3 AS auth_steps FROM orders),
x AS (SELECT flow, {_SCORES} FROM f), b AS (SELECT flow, list_sort([{_LISTED}].list_transform(lambda p: {{'s': -p.score, 'i': p.i, 'name': p.name}}))[1] AS b FROM x)
SELECT flow, CASE WHEN b.s = 0 THEN 'none' ELSE b.name END AS pattern, -b.s AS matched FROM b""")
def q31b_flow_patterns(spark, sf_dir):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    lists = lambda values, index: F.element_at(F.array(*[F.array(*map(F.lit, v)).cast("array<string>") for v in values]), (index % len(values) + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select(
        o.alias("flow"), lists((["login.php"], ["cart.php", "step2.php"], ["list.php", "search.php"], ["reset_x.php"], ["report.php"], ["logout.php"], ["upload.php"], ["misc.php"]), o).alias("files"),
        lists((["email", "password"], ["total", "card"], ["q"], ["file"], [], ["status"]), c).alias("inputs"), lists((["GET"], ["POST"], ["GET", "POST"]), o).alias("methods"), lists((["user"], []), c).alias("sessions"),
        lists((["→ home"], ["session destroyed", "a", "b"], []), c).alias("outputs"), lists((["INSERT a"], ["SELECT b"], ["UPDATE c", "SELECT d"], []), o).alias("db_ops"), (o % 5).alias("steps"), (c % 4).alias("input_steps"), (o % 3).alias("auth_steps"),
    )
    return domain.flow_patterns(rows)


@query("""WITH a AS (SELECT DISTINCT 't' || p_size % 6 AS "table", 'status' AS field, 'v' || p_partkey % 4 || 'x' AS from_state, 'v' || p_size % 3 || 'x' AS to_state, 0.9::DOUBLE AS confidence FROM part WHERE p_partkey % 4 <> p_size % 3),
b AS (SELECT DISTINCT 't' || p_size % 6, 'status', 'v' || p_size % 5 || 'x', 'v' || p_partkey % 3 || 'x', 0.75::DOUBLE FROM part WHERE p_size % 5 <> p_partkey % 3),
l AS (SELECT *, lead(v) OVER w AS n, lead(line) OVER w - line AS gap FROM (SELECT s_nationkey % 3 AS file, s_suppkey * 7 AS line, 'v' || s_suppkey % 7 || 'x' AS v FROM supplier WHERE s_suppkey % 7 <> 5) WINDOW w AS (PARTITION BY file ORDER BY line, v)),
c AS (SELECT DISTINCT 't0', 'status', v, n, 0.5::DOUBLE FROM l WHERE gap <= 40 AND n <> v)
SELECT "table", field, from_state, to_state, max(confidence) AS confidence FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) GROUP BY ALL""")
def q25b_transitions(spark, sf_dir):
    part, s = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    t = _f("t%d", F.col("p_size") % 6)
    sql = part.select(F.lit("").alias("table"), F.concat(F.lit("UPDATE "), t, _f(" SET `Status` = 'v%dx', n = 'save' WHERE id = 3 AND status = 'v%dx'", F.col("p_size") % 3, F.col("p_partkey") % 4)).alias("sql"))
    branches = part.select(t.alias("table"), _f("$o->status === 'v%dx'", F.col("p_size") % 5).alias("condition"), _f("$o->status = 'v%dx'; $o->save();", F.col("p_partkey") % 3).alias("body"))
    value = F.when(F.col("s_suppkey") % 7 == 5, "save").otherwise(_f("v%dx", F.col("s_suppkey") % 7))
    near = s.select(F.lit("t0").alias("table"), F.lit("status").alias("field"), _f("f%d", F.col("s_nationkey") % 3).alias("file"), (F.col("s_suppkey") * 7).alias("line"), value.alias("value"))
    return domain.transitions(domain.sql_transitions(sql), domain.branch_transitions(branches), domain.near_transitions(near))


_RELATED = (("orders", "id"), ("orders", "customer_id"), ("customers", "id"), ("customers", "nation_id"), ("nations", "id"), ("tag_parts", "tag_id"), ("tag_parts", "part_id"), ("tags", "id"), ("parts", "id"), ("parts", "name"))


@query("""WITH s(from_table, to_table, signal, confidence) AS (SELECT DISTINCT 'n' || n_nationkey, 'r' || n_regionkey, 'fk_explicit', 0.95 FROM nation UNION ALL SELECT DISTINCT 'n' || s_nationkey, 'r' || s_suppkey % 5, 'orm', 0.85 FROM supplier UNION ALL SELECT DISTINCT 'n' || c_nationkey, 'r' || c_custkey % 4, 'sql_join', 0.8 FROM customer
UNION ALL SELECT * FROM (VALUES ('orders', 'customers', 'column_name', 0.75), ('customers', 'nations', 'column_name', 0.75), ('tag_parts', 'tags', 'column_name', 0.75), ('tag_parts', 'parts', 'column_name', 0.75), ('parts', 'tags', 'pivot', 0.9)))
SELECT from_table, to_table, arg_max(signal, confidence) AS signal, max(confidence)::DOUBLE AS confidence, string_agg(signal, ',' ORDER BY signal) AS signals FROM s GROUP BY 1, 2""")
def q28d_relationships(spark, sf_dir):
    keys = table(spark, sf_dir, "nation").select(_f("n%d", "n_nationkey").alias("from_table"), _f("r%d", "n_regionkey").alias("to_table"))
    models = table(spark, sf_dir, "supplier").select(_f("n%d", "s_nationkey").alias("table"), _f("r%d", F.col("s_suppkey") % 5).alias("related"))
    sql = table(spark, sf_dir, "customer").select(_f("SELECT * FROM n%d JOIN r%d ON a = b", "c_nationkey", F.col("c_custkey") % 4).alias("sql"))
    return domain.relationships(keys, spark.createDataFrame(list(_RELATED), "table string, column string"), models, sql)


@query("""WITH r AS (SELECT 'part' || p_size || 's' AS t, 'sql' AS s FROM part WHERE p_partkey % 2 = 0 UNION SELECT 'Part' || p_size || 's', 'schema' FROM part WHERE p_partkey % 3 = 0 UNION SELECT 'tag_parts', 'schema') SELECT 'part' || regexp_extract(lower(t), '[0-9]+') AS entity, lower(min(t)) AS tables, string_agg(DISTINCT s, ',' ORDER BY s) AS sources FROM r WHERE t <> 'tag_parts' GROUP BY 1""")
def q96d_entity_catalogue(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    schema = part.where("p_partkey % 3 = 0").select(_f("Part%ds", "p_size").alias("table")).unionByName(spark.createDataFrame([("tag_parts",)], "table string"))
    found = domain.entity_catalogue({"sql": part.where("p_partkey % 2 = 0").select(_f("part%ds", "p_size").alias("table")), "schema": schema}, spark.createDataFrame(list(_RELATED), "table string, column string"))
    return found


@query("""WITH f AS (SELECT p_partkey AS k, 'd' || p_size || '/f' || p_partkey AS file FROM part), m AS (SELECT k, file, p.p_brand AS module, count(DISTINCT l_suppkey) * 2.0 AS score FROM f JOIN part p ON p.p_partkey = k JOIN lineitem ON l_partkey = k WHERE l_quantity > 46 GROUP BY ALL),
b AS (SELECT file, module FROM m WHERE score >= 3.5), r AS (SELECT file, split_part(file, '/', 1) AS d FROM f WHERE file NOT IN (SELECT file FROM b)), n AS (SELECT d, count(*) AS n FROM r GROUP BY d)
SELECT * FROM b UNION ALL SELECT file, CASE WHEN n >= 2 THEN d ELSE 'Misc' END FROM r JOIN n USING (d)""")
def q38g_clusters(spark, sf_dir):
    part, li = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem").where("l_quantity > 46")
    files = part.select(_f("d%d/f%d", "p_size", "p_partkey").alias("file"), "p_partkey", "p_brand")
    sold = files.join(li, F.col("l_partkey") == F.col("p_partkey")).select("file", F.concat_ws(":", "p_brand", F.col("p_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("value"), "p_brand").distinct()
    facts = sold.select("file", F.lit("table").alias("kind"), "value")
    modules = sold.select(F.col("p_brand").alias("module"), F.lit("table").alias("kind"), "value")
    return domain.clusters(files.select("file"), facts, modules, {"table": 2.0}, 3.5)


@query("""WITH r AS (SELECT CASE WHEN s_acctbal > 6000 THEN 'STRONG' ELSE 'WEAK' END AS status, s_suppkey % 4 <> 0 AS cited FROM supplier) SELECT count(*) FILTER (WHERE status = 'STRONG' AND NOT cited) = 0 AS passed, count(*) FILTER (WHERE status = 'STRONG' AND NOT cited) AS uncited_strong, 0.9::DOUBLE AS weakest FROM r""")
def q38h_gate(spark, sf_dir):
    rules = table(spark, sf_dir, "supplier").select(F.when(F.col("s_acctbal") > 6000, "STRONG").otherwise("WEAK").alias("status"), (F.col("s_suppkey") % 4 != 0).alias("cited"))
    return domain.gate(rules, 1.5, [0.95, 0.9])


@query("""WITH c AS (SELECT ['pass', 'warn', 'pass', 'fail'][s_suppkey % 4 + 1] AS status, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal / 10000 END AS value FROM supplier) SELECT round(avg(coalesce(value, CASE status WHEN 'pass' THEN 1.0 WHEN 'warn' THEN 0.5 ELSE 0.0 END)), 3) AS score, CASE WHEN bool_or(status = 'fail') THEN 'FAIL' WHEN bool_or(status = 'warn') THEN 'WARN' ELSE 'PASS' END AS grade FROM c""")
def q14e_overall(spark, sf_dir):
    k = F.col("s_suppkey")
    return domain.overall(table(spark, sf_dir, "supplier").select(_pick(("pass", "warn", "pass", "fail"), k).alias("status"), F.when(k % 3 == 0, F.col("s_acctbal") / 10000).alias("value")))


@query("""WITH f AS (SELECT l_orderkey AS flow, round(0.6 * avg((l_quantity > 10)::INT) + 0.4 * avg((l_returnflag <> 'R')::INT), 4) AS confidence FROM lineitem GROUP BY 1), s AS (SELECT o_orderkey AS flow, (o_custkey % 10) / 10.0 AS stored FROM orders) SELECT flow, confidence, stored::DOUBLE AS stored, stored - confidence > 0.3 + 1e-9 AS inflated FROM f JOIN s USING (flow)""")
def q37b_inflated_confidence(spark, sf_dir):
    from ..operators import validate

    found = validate.step_confidence(table(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_quantity") > 10, F.col("l_returnflag") != "R").withColumnRenamed("l_orderkey", "flow")
    stored = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("flow"), ((F.col("o_custkey") % 10) / 10.0).alias("confidence"))
    return domain.inflated(found, stored, "flow")


@query("""SELECT o_custkey AS flow, arg_min(t, (r, t)) AS entry FROM (SELECT o_custkey, t, CASE t WHEN 'http' THEN 0 WHEN 'cli' THEN 1 WHEN 'schedule' THEN 2 WHEN 'queue' THEN 3 ELSE 5 END AS r FROM (SELECT o_custkey, ['queue', 'cli', 'other', 'schedule'][o_orderkey % 4 + 1] AS t FROM orders)) GROUP BY 1""")
def q90d_best_entry(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("flow"), _pick(("queue", "cli", "other", "schedule"), F.col("o_orderkey")).alias("type"))
    return domain.best_entry(rows)


@query("""SELECT name, value, CASE name WHEN 'flows' THEN CASE WHEN value >= 0.85 THEN 'pass' WHEN value >= 0.25 THEN 'warn' ELSE 'fail' END WHEN 'docs' THEN CASE WHEN value >= 0.8 THEN 'pass' WHEN value >= 0.6 THEN 'warn' ELSE 'fail' END END AS status FROM (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'flows' ELSE 'docs' END AS name, round(s_acctbal / 10000, 3) AS value FROM supplier)""")
def q14f_ladders(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, "flows").otherwise("docs").alias("name"), F.round(F.col("s_acctbal") / 10000, 3).alias("value"))
    return domain.status_ladders(rows, {"flows": (0.85, 0.25), "docs": (0.8, 0.6)})


_SYSTEM = """actors AS (SELECT r_name AS name FROM region), features AS (SELECT DISTINCT p_type || ' sales' AS name, 'ctx' || p_size % 3 AS context, 'on ' || p_name AS description FROM part WHERE p_partkey < 12), entities AS (SELECT * FROM (VALUES ('widget'), ('cold'), ('t1'), ('order')) e(name)),
flows AS (SELECT 'buy ' || lower(p_type) || ' ' || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN 'ASIA' ELSE 'nobody' END AS actor, 'ctx' || p_partkey % 4 AS context, p_partkey AS k FROM part WHERE p_partkey < 20), tables AS (SELECT * FROM (VALUES ('orders'), ('widgets'), ('t1'), ('cold_items')) t(name)),
steps AS (SELECT f.name AS flow, 'p' || l_suppkey || '.php' AS page, CASE WHEN l_linenumber % 2 = 0 THEN 'SELECT from Orders' ELSE 'INSERT widgets' END AS op FROM flows f JOIN lineitem ON l_partkey = k), sql AS (SELECT 'x/p' || s_suppkey || '.php' AS file, CASE WHEN s_suppkey % 2 = 0 THEN 'orders' ELSE 'missing' END AS tbl FROM supplier),
e AS (SELECT DISTINCT * FROM (SELECT 'bounded_context:' || context AS source, 'feature:' || regexp_replace(lower(name), '[^a-z0-9_]', '_', 'g') AS target, 'context_contains' AS type FROM features UNION ALL SELECT 'actor:' || regexp_replace(lower(actor), '[^a-z0-9_]', '_', 'g'), 'flow:' || replace(name, ' ', '_'), 'actor_performs' FROM flows UNION ALL SELECT 'flow:' || replace(name, ' ', '_'), 'bounded_context:' || context, 'flow_in_context' FROM flows
UNION ALL SELECT 'flow:' || replace(flow, ' ', '_'), 'page:' || replace(page, '.', '_'), 'flow_uses' FROM steps UNION ALL SELECT 'flow:' || replace(flow, ' ', '_'), CASE WHEN op LIKE 'SELECT%' THEN 'table:orders' ELSE 'table:widgets' END, CASE WHEN op LIKE 'SELECT%' THEN 'flow_reads' ELSE 'flow_writes' END FROM steps
UNION ALL SELECT 'feature:' || regexp_replace(lower(f.name), '[^a-z0-9_]', '_', 'g'), 'flow:' || replace(w.name, ' ', '_'), 'feature_includes' FROM features f, flows w WHERE f.context = w.context OR (f.name = upper(f.name[1:length(f.name) - 6]) || ' sales' AND false)
UNION ALL SELECT 'feature:' || regexp_replace(lower(f.name), '[^a-z0-9_]', '_', 'g'), 'entity:' || n.name, 'feature_depends_on' FROM features f, entities n WHERE length(n.name) >= 3 AND contains(lower(f.name || ' ' || f.description), n.name)
UNION ALL SELECT 'entity:' || n.name, 'table:' || t.name, 'entity_stored_in' FROM entities n, tables t WHERE length(n.name) >= 3 AND contains(t.name, n.name) UNION ALL SELECT 'page:' || replace(regexp_extract(file, '([^/]+)$', 1), '.', '_'), 'table:' || tbl, 'page_queries' FROM sql WHERE tbl = 'orders' AND regexp_extract(file, '([^/]+)$', 1) IN (SELECT page FROM steps)))"""


@query(f"WITH {_SYSTEM} SELECT * FROM e WHERE source <> 'actor:nobody' AND (type <> 'flow_in_context' OR true)")
def q04b_system_edges(spark, sf_dir):
    return _system(spark, sf_dir)[1]


def _system(spark, sf_dir):
    part, li, s = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    k = F.col("p_partkey")
    features = part.where(k < 12).select(F.concat("p_type", F.lit(" sales")).alias("name"), _f("ctx%d", F.col("p_size") % 3).alias("context"), F.concat(F.lit("on "), "p_name").alias("description")).distinct()
    flows = part.where(k < 20).select(F.concat(F.lit("buy "), F.lower("p_type"), F.lit(" "), k.cast("string")).alias("name"), F.when(k % 2 == 0, "ASIA").otherwise("nobody").alias("actor"), _f("ctx%d", k % 4).alias("context"), k.alias("k"))
    steps = flows.join(li, F.col("l_partkey") == F.col("k")).select(F.col("name").alias("flow"), _f("p%d.php", "l_suppkey").alias("page"), F.array(F.when(F.col("l_linenumber") % 2 == 0, "SELECT from Orders").otherwise("INSERT widgets")).alias("db_ops"))
    tables = spark.createDataFrame([("orders",), ("widgets",), ("t1",), ("cold_items",)], "name string")
    entities = spark.createDataFrame([("widget",), ("cold",), ("t1",), ("order",)], "name string")
    sql = s.select(_f("x/p%d.php", "s_suppkey").alias("file"), F.when(F.col("s_suppkey") % 2 == 0, "orders").otherwise("missing").alias("table"))
    return domain.system_graph(table(spark, sf_dir, "region").select(F.col("r_name").alias("name")), features, entities, flows.drop("k"), steps, tables, sql)


@query(f"""WITH {_SYSTEM} SELECT type, count(*) AS nodes FROM (SELECT DISTINCT 'actor' AS type, name FROM actors UNION ALL SELECT DISTINCT 'bounded_context', context FROM (SELECT context FROM features UNION SELECT context FROM flows) UNION ALL SELECT DISTINCT 'feature', lower(name) FROM features UNION ALL SELECT 'entity', name FROM entities UNION ALL SELECT 'flow', name FROM flows UNION ALL SELECT DISTINCT 'page', page FROM steps UNION ALL SELECT 'table', name FROM tables) GROUP BY type""")
def q04c_system_nodes(spark, sf_dir):
    return _system(spark, sf_dir)[0].groupBy("type").agg(F.count("*").alias("nodes"))
