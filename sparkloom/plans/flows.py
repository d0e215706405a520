"""Checks of flows: orders are flows, their lines are steps, parts and suppliers the code."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import flows
from ..sources.tables import table
from .registry import query

_STEPS = """steps AS (SELECT l_orderkey AS flow, l_linenumber AS step, l_discount >= 0.08 AS aware,
CASE l_linenumber % 4 WHEN 0 THEN '/pages/part_' || l_partkey || '.php' WHEN 1 THEN '/part/P' || l_partkey || '/?tab=1' WHEN 2 THEN '/supplier/s' || l_suppkey || '/lines' ELSE CASE WHEN l_quantity < 25 THEN '/order/' ELSE '/invoice/' END || l_orderkey || '/edit' END AS page,
CASE WHEN l_returnflag = 'R' THEN 'Redirect → list' ELSE 'open' END AS action, l_linestatus = 'F' AND l_linenumber = 2 AS is_branch,
['INSERT part' || l_partkey % 7, CASE WHEN l_tax > 0.05 THEN 'Eloquent create:Model' ELSE 'UPDATE `tmp`' END] AS db_ops FROM lineitem),
files AS (SELECT 'src/Part_' || p_partkey || '.php' AS file FROM part WHERE p_size <= 25),
routes AS (SELECT '/part/p' || p_partkey AS route FROM part WHERE p_size BETWEEN 10 AND 30 UNION ALL SELECT '/supplier/s' || s_suppkey || '/' FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT '/part/p' || p_partkey || '/edit' FROM part WHERE p_partkey % 11 = 0 UNION ALL SELECT '/order/:id/edit'),
known AS (SELECT DISTINCT lower(regexp_extract(file, '([^/]+)$', 1)) AS file FROM files)"""


def _steps(spark, sf_dir):
    line = F.col("l_linenumber") % 4
    text = lambda a, c, b="": F.concat(F.lit(a), F.col(c).cast("string"), F.lit(b))
    page = F.when(line == 0, text("/pages/part_", "l_partkey", ".php")).when(line == 1, text("/part/P", "l_partkey", "/?tab=1")).when(line == 2, text("/supplier/s", "l_suppkey", "/lines")).when(F.col("l_quantity") < 25, text("/order/", "l_orderkey", "/edit")).otherwise(text("/invoice/", "l_orderkey", "/edit"))
    ops = F.array(F.concat(F.lit("INSERT part"), (F.col("l_partkey") % 7).cast("string")), F.when(F.col("l_tax") > 0.05, "Eloquent create:Model").otherwise("UPDATE `tmp`"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("flow"), F.col("l_linenumber").alias("step"), (F.col("l_discount") >= 0.08).alias("aware"), page.alias("page"), F.when(F.col("l_returnflag") == "R", "Redirect → list").otherwise("open").alias("action"), ((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 2)).alias("is_branch"), ops.alias("db_ops"))


def _files(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_size <= 25").select(F.format_string("src/Part_%d.php", "p_partkey").alias("file"))


def _routes(spark, sf_dir):
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    one = part.where("p_size between 10 and 30").select(F.format_string("/part/p%d", "p_partkey").alias("route"))
    two = supplier.where("s_suppkey % 2 = 0").select(F.format_string("/supplier/s%d/", "s_suppkey").alias("route"))
    three = part.where("p_partkey % 11 = 0").select(F.format_string("/part/p%d/edit", "p_partkey").alias("route"))
    return one.unionByName(two).unionByName(three).unionByName(spark.createDataFrame([("/order/:id/edit",)], "route string"))


_OWN = "own AS (SELECT * FROM steps WHERE action <> 'Redirect → list' AND NOT is_branch)"


@query(f"""WITH {_STEPS}, {_OWN}, p AS (SELECT flow, step, regexp_replace(lower(string_split(page, '?')[1]), '/+$', '') AS path FROM own WHERE page NOT LIKE '%.php'),
r AS (SELECT DISTINCT regexp_replace(route, '/+$', '') AS route FROM routes), d AS (SELECT DISTINCT path FROM p),
good AS (SELECT path FROM d WHERE path IN (SELECT route FROM r) OR regexp_matches(path, '^/order/[0-9]+/edit$') OR EXISTS (SELECT 1 FROM r WHERE starts_with(r.route, d.path || '/') OR starts_with(d.path, r.route || '/')))
SELECT flow, step, 'file' AS kind, lower(regexp_extract(page, '([^/]+)$', 1)) AS value FROM own WHERE page LIKE '%.php' AND lower(regexp_extract(page, '([^/]+)$', 1)) NOT IN (SELECT file FROM known)
UNION ALL SELECT flow, step, 'route', path FROM p WHERE path NOT IN (SELECT path FROM good)
UNION ALL SELECT flow, step, 'table', regexp_extract(o, ' (.*)$', 1) FROM (SELECT flow, step, unnest(db_ops) AS o FROM own) WHERE o LIKE 'INSERT %' AND regexp_extract(o, ' (.*)$', 1) NOT IN ('part0', 'part1', 'part2')""")
def q50_hallucinated_steps(spark, sf_dir):
    """Steps that name files, routes (also by prefix and in normal form) or tables that do not exist."""
    tables = spark.createDataFrame([("PART0",), ("part1",), ("part2",)], "table string")
    return flows.hallucinated(_steps(spark, sf_dir), _files(spark, sf_dir), _routes(spark, sf_dir), tables)


_EVIDENCE = "fl AS (SELECT o_orderkey AS flow, CASE WHEN o_custkey % 5 = 0 THEN [] ELSE ['app/part_' || o_custkey || '.php', 'part_' || o_orderkey % 300 || '.PHP'] END AS evidence FROM orders)"


def _flows(spark, sf_dir):
    files = F.array(F.format_string("app/part_%d.php", "o_custkey"), F.format_string("part_%d.PHP", F.col("o_orderkey") % 300))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("flow"), F.when(F.col("o_custkey") % 5 == 0, F.array().cast("array<string>")).otherwise(files).alias("evidence"))


_BROKEN = f"""WITH {_STEPS}, {_EVIDENCE}, backed AS (SELECT DISTINCT flow FROM (SELECT flow, unnest(evidence) AS e FROM fl) WHERE lower(regexp_extract(e, '([^/]+)$', 1)) IN (SELECT file FROM known)), s AS (SELECT flow, count(*) AS n, count(*) FILTER (WHERE page LIKE '%.php') AS pages, count(*) FILTER (WHERE page LIKE '%.php' AND lower(regexp_extract(page, '([^/]+)$', 1)) IN (SELECT file FROM known)) AS found FROM steps GROUP BY flow),
x AS (SELECT fl.flow, len(evidence) = 0 AS none, coalesce(n, 0) < 2 AS short, len(evidence) > 0 AND fl.flow NOT IN (SELECT flow FROM backed) AS foreign_only, coalesce(pages, 0) > 0 AND found = 0 AS invented FROM fl LEFT JOIN s USING (flow)),
b AS (SELECT flow, (short::BIGINT + (none OR foreign_only)::BIGINT + invented::BIGINT)::BIGINT AS issues, CASE WHEN none THEN 'critical' WHEN foreign_only OR invented THEN 'major' ELSE 'minor' END AS severity FROM x WHERE short OR none OR foreign_only OR invented)"""


@query(_BROKEN + " SELECT * FROM b")
def q51_broken_flows(spark, sf_dir):
    return flows.broken(_flows(spark, sf_dir), _steps(spark, sf_dir), _files(spark, sf_dir))


@query(_BROKEN + """ SELECT count(*) AS findings, count(*) FILTER (WHERE severity = 'critical') AS critical, count(*) FILTER (WHERE severity = 'major') AS major, CASE WHEN count(*) FILTER (WHERE severity <> 'minor') > 4 OR count(*) FILTER (WHERE severity = 'critical') > 2 THEN 'fail' WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END AS status FROM b""")
def q51b_broken_status(spark, sf_dir):
    return flows.broken_status(q51_broken_flows(spark, sf_dir))


@query(f"""WITH {_STEPS}, g AS (SELECT 'part_' || p_partkey || '.php' AS file, CASE WHEN p_brand < 'Brand#3' THEN 'role' ELSE 'session' END AS guard FROM part WHERE p_retailprice > 950),
s AS (SELECT 'part_' || p_partkey || '.php' AS file, 'signal' || p_size % 3 AS guard FROM part WHERE p_size > 30),
seen AS (SELECT DISTINCT lower(regexp_extract(page, '([^/]+)$', 1)) AS file FROM steps WHERE page LIKE '%.php'), a AS (SELECT DISTINCT lower(regexp_extract(page, '([^/]+)$', 1)) AS file FROM steps WHERE page LIKE '%.php' AND aware)
SELECT file, guard, CASE WHEN file IN (SELECT file FROM seen) THEN 'major' ELSE 'minor' END AS severity FROM g WHERE file NOT IN (SELECT file FROM a)
UNION ALL SELECT file, guard, 'major' FROM s WHERE file NOT IN (SELECT file FROM g) AND file NOT IN (SELECT file FROM a) AND file IN (SELECT file FROM seen)""")
def q52_unguarded_files(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = lambda a: F.format_string(a + "part_%d.php", "p_partkey").alias("file")
    guards = part.where("p_retailprice > 950").select(name("src/"), F.when(F.col("p_brand") < "Brand#3", "role").otherwise("session").alias("guard"), F.col("p_partkey").alias("ord"))
    late = guards.withColumn("guard", F.lit("late")).withColumn("ord", F.col("ord") + 1_000_000)
    signals = part.where("p_size > 30").select(name("lib/"), F.concat(F.lit("signal"), (F.col("p_size") % 3).cast("string")).alias("guard"), F.col("p_partkey").alias("ord"))
    pages = _steps(spark, sf_dir).where("page like '%.php'")
    return flows.unguarded(guards.unionByName(late), signals, pages.select(F.col("page").alias("file")), pages.where("aware").select(F.col("page").alias("file")))


#: Names of features, and the words of contexts that flows carry.
_FEATURES = ("urgent orders desk", "medium business", "low lane", "building yard", "auto shop")
_FUZZY = "(contains({h}, {n}) OR (len(list_filter(string_split_regex({n}, '[^a-z0-9_]+'), lambda w: length(w) > 2)) > 0 AND len(list_filter(string_split_regex({n}, '[^a-z0-9_]+'), lambda w: length(w) > 2 AND contains({h}, w))) >= {r} * len(list_filter(string_split_regex({n}, '[^a-z0-9_]+'), lambda w: length(w) > 2))))"
_TRACED = f"""WITH f(feature) AS (VALUES {", ".join(f"('{x}')" for x in _FEATURES)}), p AS (SELECT l_orderkey AS flow, 'part_' || l_partkey || '.php' AS page FROM lineitem),
fp AS (SELECT CASE WHEN p_size < 5 THEN 'auto shop' ELSE 'building yard' END AS feature, 'part_' || p_partkey || '.php' AS page FROM part WHERE p_size < 10),
a AS (SELECT flow, min(feature) AS feature FROM p JOIN fp USING (page) GROUP BY flow), c AS (SELECT o_orderkey AS flow, lower(replace(o_orderpriority, '-', ' ')) AS context FROM orders),
b AS (SELECT c.flow, min(f.feature) AS feature FROM c, f WHERE c.flow NOT IN (SELECT flow FROM a) AND ({_FUZZY.format(h="f.feature", n="c.context", r="0.75")} OR {_FUZZY.format(h="c.context", n="f.feature", r="0.75")}) GROUP BY c.flow), t AS (SELECT * FROM a UNION ALL SELECT * FROM b)"""


def _traced(spark, sf_dir):
    pages = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("flow"), F.format_string("/x/Part_%d.php", "l_partkey").alias("page"))
    own = table(spark, sf_dir, "part").where("p_size < 10").select(F.when(F.col("p_size") < 5, "auto shop").otherwise("building yard").alias("feature"), F.format_string("part_%d.php", "p_partkey").alias("page"))
    contexts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("flow"), F.lower(F.replace("o_orderpriority", F.lit("-"), F.lit(" "))).alias("context"))
    return flows.traced(pages, contexts, own, _features(spark)), contexts


def _features(spark):
    return spark.createDataFrame([(x,) for x in _FEATURES], "feature string")


@query(_TRACED + " SELECT flow, feature FROM t")
def q53_flow_features(spark, sf_dir):
    return _traced(spark, sf_dir)[0]


@query(_TRACED + " SELECT flow FROM c WHERE flow NOT IN (SELECT flow FROM t)")
def q53b_untraced_flows(spark, sf_dir):
    found, contexts = _traced(spark, sf_dir)
    return contexts.select("flow").join(found.select("flow"), "flow", "left_anti")


_DOCS = "a AS (SELECT 'doc' || doc_id % 5 AS artefact, unnest(string_split(text, chr(10))) AS heading FROM documents)"
_WORDS = ("chen", "ation", "the state of things", "that hes enthi", "eschon wirde geht", "zzz none")


@query(f"""WITH f(feature) AS (VALUES {", ".join(f"('{x}')" for x in _WORDS)}), {_DOCS}, x AS (SELECT DISTINCT artefact FROM a), h AS (SELECT DISTINCT a.artefact, f.feature FROM a, f WHERE {_FUZZY.format(h="lower(a.heading)", n="f.feature", r="0.75")})
SELECT artefact, feature FROM x, f WHERE (artefact, feature) NOT IN (SELECT artefact, feature FROM h)""")
def q54_features_without_heading(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), (F.col("doc_id") % 5).cast("string")).alias("artefact"), F.explode(F.split("text", "\n")).alias("heading"))
    return flows.without_heading(spark.createDataFrame([(x,) for x in _WORDS], "feature string"), lines)


@query("""WITH r AS (SELECT CASE s_suppkey % 5 WHEN 0 THEN 'GROUP' WHEN 1 THEN 'get' WHEN 2 THEN 'GET' WHEN 3 THEN 'POST' ELSE 'PUT' END AS method, '/n/' || s_nationkey AS route, 'ctl/S' || s_suppkey || '.php' AS file, CASE WHEN s_suppkey % 7 = 0 THEN 'nextjs_page' ELSE 'api' END AS kind, s_suppkey AS ord FROM supplier),
p AS (SELECT DISTINCT 's' || l_suppkey || '.php' AS b FROM lineitem WHERE l_partkey % 40 = 3 AND l_quantity >= 45)
SELECT upper(method) AS method, route, arg_min(file, ord) AS file FROM r WHERE upper(method) <> 'GROUP' AND kind <> 'nextjs_page' AND lower(regexp_extract(file, '([^/]+)$', 1)) NOT IN (SELECT b FROM p) GROUP BY 1, 2""")
def q55_routes_outside_flows(spark, sf_dir):
    verb = F.element_at(F.array(*map(F.lit, ("GROUP", "get", "GET", "POST", "PUT"))), (F.col("s_suppkey") % 5 + 1).cast("int"))
    routes = table(spark, sf_dir, "supplier").select(verb.alias("method"), F.concat(F.lit("/n/"), F.col("s_nationkey").cast("string")).alias("route"), F.format_string("ctl/S%d.php", "s_suppkey").alias("file"), F.when(F.col("s_suppkey") % 7 == 0, "nextjs_page").otherwise("api").alias("kind"), F.col("s_suppkey").alias("ord"))
    pages = table(spark, sf_dir, "lineitem").where("l_partkey % 40 = 3 and l_quantity >= 45").select(F.format_string("/a/s%d.php", "l_suppkey").alias("page"))
    return flows.routes_outside(routes, pages)


@query("""WITH w AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'delete' WHEN 'O' THEN 'UPDATE' WHEN 'P' THEN 'INSERT' ELSE 'SELECT' END AS operation, CASE WHEN o_custkey % 9 = 0 THEN 'UNKNOWN' ELSE 'T' || o_custkey % 50 END AS tbl, 'c' || o_custkey || '.php' AS file, o_orderkey AS ord FROM orders),
p AS (SELECT DISTINCT 'c' || c_custkey || '.php' AS b FROM customer WHERE c_acctbal > 0),
x AS (SELECT upper(operation) AS operation, lower(tbl) AS "table", arg_min(file, ord) AS file FROM w WHERE operation <> 'SELECT' AND tbl <> 'UNKNOWN' AND file NOT IN (SELECT b FROM p) GROUP BY 1, 2)
SELECT *, CASE operation WHEN 'DELETE' THEN 'critical' WHEN 'UPDATE' THEN 'major' ELSE 'minor' END AS severity FROM x""")
def q56_writes_outside_flows(spark, sf_dir):
    status = F.col("o_orderstatus")
    writes = table(spark, sf_dir, "orders").select(F.when(status == "F", "delete").when(status == "O", "UPDATE").when(status == "P", "INSERT").otherwise("SELECT").alias("operation"), F.when(F.col("o_custkey") % 9 == 0, "UNKNOWN").otherwise(F.concat(F.lit("T"), (F.col("o_custkey") % 50).cast("string"))).alias("table"), F.format_string("c%d.php", "o_custkey").alias("file"), F.col("o_orderkey").alias("ord"))
    pages = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.format_string("x/C%d.php", "c_custkey").alias("page"))
    return flows.writes_outside(writes, pages)


@query("""WITH r AS (SELECT p_partkey AS feature, round(least(1.0, 0.2 * ((p_size > 10)::INT + (p_size > 30)::INT + (p_retailprice > 1000)::INT + (p_brand > 'Brand#3')::INT)), 4) AS score FROM part)
SELECT feature, score::DOUBLE AS score, CASE WHEN score = 0 THEN 'critical' ELSE 'major' END AS severity FROM r WHERE score < 0.4""")
def q57_low_confidence(spark, sf_dir):
    signs = sum((c.cast("int") for c in (F.col("p_size") > 10, F.col("p_size") > 30, F.col("p_retailprice") > 1000, F.col("p_brand") > "Brand#3")), F.lit(0))
    report = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("feature"), F.round(F.least(F.lit(1.0), 0.2 * signs), 4).alias("score"))
    return flows.low_confidence(report)


def _orphan_sql(pattern: str, names: str, skip: str = "") -> str:
    return f"""WITH t AS (SELECT '## Epic: ' || p_name || CASE WHEN p_size % 10 = 0 THEN ' (Flow)' ELSE '' END || chr(10) || 'As a ' || p_brand || ' buyer, I want it' || chr(10) || '## AC-' || p_partkey || ': ' || p_type AS text FROM part),
i AS (SELECT DISTINCT trim(unnest(regexp_extract_all(text, '{pattern}', 1))) AS item FROM t), n AS ({names})
SELECT item FROM i WHERE item <> '' {skip} AND NOT EXISTS (SELECT 1 FROM n WHERE contains(lower(item), lower(n.name)) OR {_FUZZY.format(h="lower(n.name)", n="lower(item)", r="0.7")})"""


def _stories(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.concat(F.lit("## Epic: "), "p_name", F.when(F.col("p_size") % 10 == 0, " (Flow)").otherwise(""), F.lit("\nAs a "), "p_brand", F.lit(" buyer, I want it\n## AC-"), F.col("p_partkey").cast("string"), F.lit(": "), "p_type").alias("text"))


@query(_orphan_sql(r"(?m)^##\s+Epic:\s+(.+)$", "SELECT DISTINCT p_name || ' store' AS name FROM part WHERE p_size < 3", "AND NOT regexp_matches(item, '[(](Flow|Path)[)]$')"))
def q58_orphan_epics(spark, sf_dir):
    names = table(spark, sf_dir, "part").where("p_size < 3").select(F.concat("p_name", F.lit(" store")).alias("name"))
    return flows.orphans(_stories(spark, sf_dir), r"(?m)^##\s+Epic:\s+(.+)$", names, "name", skip=r"[(](Flow|Path)[)]$")


@query(_orphan_sql(r"(?m)^##\s+AC-[0-9]+:\s+(.+)$", "SELECT DISTINCT lower(p_type) AS name FROM part WHERE p_type LIKE '%O%'"))
def q58b_orphan_criteria(spark, sf_dir):
    names = table(spark, sf_dir, "part").where("p_type like '%O%'").select(F.lower("p_type").alias("name"))
    return flows.orphans(_stories(spark, sf_dir), r"(?m)^##\s+AC-[0-9]+:\s+(.+)$", names, "name")


@query(_orphan_sql(r"[Aa]s (?:a|an)\s+([A-Za-z][A-Za-z0-9 _#\-]{1,40}?)(?:[,\.]|\s+I\s+want)", "SELECT DISTINCT p_brand AS name FROM part WHERE p_brand < 'Brand#3'"))
def q58c_undefined_actors(spark, sf_dir):
    names = table(spark, sf_dir, "part").where("p_brand < 'Brand#3'").select(F.col("p_brand").alias("name"))
    return flows.orphans(_stories(spark, sf_dir), r"[Aa]s (?:a|an)\s+([A-Za-z][A-Za-z0-9 _#\-]{1,40}?)(?:[,\.]|\s+I\s+want)", names, "name")


@query("""WITH n AS (SELECT (SELECT count(*) FROM orders) AS queries, (SELECT count(DISTINCT p_type) FROM part) AS tables, (SELECT count(*) FROM documents) AS chunks, (SELECT count(*) FROM supplier WHERE s_acctbal > 99999) AS forms, (SELECT count(*) FROM events WHERE event_type = 'error') AS errors)
SELECT queries > 0 AND chunks >= 5 AS passed, CASE WHEN queries = 0 AND tables = 0 THEN 'no_data' ELSE '' END AS blockers, concat_ws(',', CASE WHEN tables < 3 THEN 'few_tables' END, CASE WHEN forms = 0 THEN 'no_forms' END, CASE WHEN errors > 0 THEN 'parse_errors' END) AS warnings, ((queries > 0)::INT * 20 + (tables > 0)::INT * 15 + (forms > 0)::INT * 10 + (chunks >= 5)::INT * 5)::BIGINT AS score FROM n""")
def q59_preflight(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    one = t("orders").agg(F.count("*").alias("queries")).crossJoin(t("part").agg(F.count_distinct("p_type").alias("tables"))).crossJoin(t("documents").agg(F.count("*").alias("chunks")))
    counts = one.crossJoin(t("supplier").agg(F.count_if(F.col("s_acctbal") > 99999).alias("forms"))).crossJoin(t("events").agg(F.count_if(F.col("event_type") == "error").alias("errors")))
    c = F.col
    return flows.preflight(counts, {"no_data": (c("queries") == 0) & (c("tables") == 0), "few_chunks": c("chunks") < 5}, {"few_tables": c("tables") < 3, "no_forms": c("forms") == 0, "parse_errors": c("errors") > 0}, {"has_sql": c("queries") > 0, "has_tables": c("tables") > 0, "has_forms": c("forms") > 0, "has_embeddings": c("chunks") >= 5})


@query("""SELECT doc_id, len(list_filter(['chen', 'ation of', 'that hes'], lambda t: contains(lower(text), t) OR len(list_filter(string_split(t, ' '), lambda w: length(w) >= 4 AND contains(lower(text), w))) > 0))::BIGINT AS covered FROM documents""")
def q60_term_coverage(spark, sf_dir):
    terms = [tx.term_covered(F.lit(t), F.col("text")).cast("long") for t in ("chen", "ation of", "that hes")]
    return table(spark, sf_dir, "documents").select("doc_id", sum(terms, F.lit(0).cast("long")).alias("covered"))
