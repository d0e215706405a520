"""Graph queries: the dimensions as a knowledge graph, orders and parts as a bipartite graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph
from ..operators.merge import plurality
from ..sources.tables import table
from .registry import query

_KG = """
kg_nodes AS (
  SELECT 'region:' || r_regionkey AS id, 'region' AS type, r_name AS label FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, 'nation', n_name FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, 'customer', c_name FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, 'supplier', s_name FROM supplier
  UNION ALL SELECT 'order:' || o_orderkey, 'order', o_orderpriority FROM orders),
kg_edges AS (
  SELECT 'region:' || n_regionkey AS source, 'nation:' || n_nationkey AS target, 'has_nation' AS type FROM nation
  UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey, 'has_customer' FROM customer
  UNION ALL SELECT 'nation:' || s_nationkey, 'supplier:' || s_suppkey, 'has_supplier' FROM supplier
  UNION ALL SELECT 'customer:' || o_custkey, 'order:' || o_orderkey, 'placed' FROM orders)
"""


def knowledge_graph(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    node = lambda df, kind, key, label: df.select(F.concat(F.lit(kind + ":"), F.col(key).cast("string")).alias("id"), F.lit(kind).alias("type"), F.col(label).alias("label"))
    edge = lambda df, a, ka, b, kb, kind: df.select(F.concat(F.lit(a + ":"), F.col(ka).cast("string")).alias("source"), F.concat(F.lit(b + ":"), F.col(kb).cast("string")).alias("target"), F.lit(kind).alias("type"))
    nodes = node(t("region"), "region", "r_regionkey", "r_name").unionByName(node(t("nation"), "nation", "n_nationkey", "n_name")).unionByName(node(t("customer"), "customer", "c_custkey", "c_name")).unionByName(node(t("supplier"), "supplier", "s_suppkey", "s_name")).unionByName(node(t("orders"), "order", "o_orderkey", "o_orderpriority"))
    edges = edge(t("nation"), "region", "n_regionkey", "nation", "n_nationkey", "has_nation").unionByName(edge(t("customer"), "nation", "c_nationkey", "customer", "c_custkey", "has_customer")).unionByName(edge(t("supplier"), "nation", "s_nationkey", "supplier", "s_suppkey", "has_supplier")).unionByName(edge(t("orders"), "customer", "o_custkey", "order", "o_orderkey", "placed"))
    return nodes, edges


@query(f"""WITH {_KG}
SELECT DISTINCT n.id, n.type, n.label FROM kg_nodes s
JOIN kg_edges a ON a.source = s.id AND a.type = 'has_nation'
JOIN kg_edges b ON b.source = a.target AND b.type = 'has_customer'
JOIN kg_edges c ON c.source = b.target AND c.type = 'placed'
JOIN kg_nodes n ON n.id = c.target
WHERE s.type = 'region' AND contains(lower(s.label), 'asia') AND n.type = 'order'""")
def q01_typed_hops(spark, sf_dir):
    nodes, edges = knowledge_graph(spark, sf_dir)
    start = graph.seeds(nodes, "Region", "asia")
    return graph.typed_hops(nodes, edges, start, [("has_nation", "out"), ("has_customer", "out"), ("placed", "out")], "order")


@query(f"""WITH {_KG}
SELECT n.id, n.type, n.label FROM kg_nodes n WHERE n.id IN (
  SELECT a.source FROM kg_edges b JOIN kg_edges a ON a.target = b.source AND a.type = 'has_nation'
  WHERE b.type = 'has_customer') AND n.type = 'region' ORDER BY n.id LIMIT 30""")
def q01b_inward_hops(spark, sf_dir):
    nodes, edges = knowledge_graph(spark, sf_dir)
    return graph.typed_hops(nodes, edges, graph.seeds(nodes, "customer"), [("has_customer", "in"), ("has_nation", "in")], "region", 30)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'p' || l_partkey AS a, 's' || l_suppkey AS b FROM lineitem),
both_ways AS (SELECT a AS source, b AS target FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT 'p1' AS id, 0 AS depth UNION SELECT t.target, r.depth + 1 FROM r JOIN both_ways t ON t.source = r.id WHERE r.depth < 2)
SELECT id, min(depth) AS depth FROM r GROUP BY id""")
def q02_reachable(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("a"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("b")).distinct()
    edges = e.select(F.col("a").alias("source"), F.col("b").alias("target")).unionByName(e.select(F.col("b").alias("source"), F.col("a").alias("target")))
    return graph.reachable(edges, spark.createDataFrame([("p1",)], "id string"), 2)


@query("""WITH e AS (SELECT 'p' || l_partkey AS a, 's' || l_suppkey AS b FROM lineitem)
SELECT id, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o + i) AS BIGINT) AS degree
FROM (SELECT a AS id, 1 AS o, 0 AS i FROM e UNION ALL SELECT b, 0, 1 FROM e) GROUP BY id""")
def q03_degrees(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("source"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("target"))
    return graph.degrees(edges)


@query(f"""WITH {_KG}
SELECT 'node' AS kind, type, count(*) AS count FROM kg_nodes GROUP BY type UNION ALL SELECT 'edge', type, count(*) FROM kg_edges GROUP BY type""")
def q04_graph_counts(spark, sf_dir):
    nodes, edges = knowledge_graph(spark, sf_dir)
    return graph.introspect(graph.upsert_nodes(nodes.withColumn("ord", F.lit(0))), graph.upsert_edges(edges.withColumn("ord", F.lit(0)))).select("kind", "type", "count")


@query(f"""WITH {_KG},
x AS (SELECT type, label, id, row_number() OVER (PARTITION BY type ORDER BY label, id) AS n FROM kg_nodes),
y AS (SELECT * FROM x WHERE n <= 2 ORDER BY type, n LIMIT 12),
z AS (SELECT type, string_agg(label, '; ' ORDER BY n) AS examples FROM y GROUP BY type)
SELECT 'node' AS kind, c.type, c.count, coalesce(z.examples, '') AS examples FROM (SELECT type, count(*) AS count FROM kg_nodes GROUP BY type) c LEFT JOIN z USING (type)
UNION ALL SELECT 'edge', type, count(*), '' FROM kg_edges GROUP BY type""")
def q05_introspection(spark, sf_dir):
    return graph.introspect(*knowledge_graph(spark, sf_dir))


@query(f"""WITH {_KG}, b AS (SELECT source, target FROM kg_edges UNION ALL SELECT target, source FROM kg_edges),
h1 AS (SELECT DISTINCT target AS id FROM b WHERE source = 'customer:1'),
h2 AS (SELECT DISTINCT b.target AS id FROM b JOIN h1 ON b.source = h1.id)
SELECT id, min(hop) AS hop FROM (SELECT 'customer:1' AS id, 0 AS hop UNION ALL SELECT id, 1 FROM h1 UNION ALL SELECT id, 2 FROM h2) GROUP BY id""")
def q06_context_two_hops(spark, sf_dir):
    nodes, edges = knowledge_graph(spark, sf_dir)
    return graph.two_hops(nodes.where("id = 'customer:1'"), edges)


_LABELS = """WITH e AS (SELECT DISTINCT 'n' || s_nationkey AS a, 's' || s_suppkey AS b FROM supplier),
bw AS (SELECT a AS source, b AS target FROM e UNION ALL SELECT b, a FROM e),
l0 AS (SELECT DISTINCT source AS id, source AS community FROM bw),
l1 AS (SELECT id, min(community) AS community FROM (SELECT * FROM l0 UNION ALL SELECT bw.source, l0.community FROM bw JOIN l0 ON bw.target = l0.id) GROUP BY id),
l2 AS (SELECT id, min(community) AS community FROM (SELECT * FROM l1 UNION ALL SELECT bw.source, l1.community FROM bw JOIN l1 ON bw.target = l1.id) GROUP BY id)"""


def _nation_edges(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("source"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("target")).distinct()


@query(_LABELS + " SELECT id, community FROM l2")
def q07_communities(spark, sf_dir):
    return graph.min_labels(_nation_edges(spark, sf_dir), 2)


@query(_LABELS + """, m AS (SELECT count(*) AS m FROM e), x AS (SELECT p.community AS ca, q.community AS cb FROM e JOIN l2 p ON p.id = e.a JOIN l2 q ON q.id = e.b),
i AS (SELECT ca, count(*) FILTER (WHERE ca = cb) AS inside FROM x GROUP BY ca),
d AS (SELECT c, count(*) AS d FROM (SELECT ca AS c FROM x UNION ALL SELECT cb FROM x) GROUP BY c)
SELECT round(sum(coalesce(inside, 0) / m.m - pow(d.d / (2.0 * m.m), 2)), 6) AS modularity FROM d LEFT JOIN i ON d.c = i.ca CROSS JOIN m""")
def q07b_modularity(spark, sf_dir):
    edges = _nation_edges(spark, sf_dir)
    return graph.modularity(edges, graph.min_labels(edges, 2))


@query("""SELECT o.o_orderkey AS order_key, c.c_nationkey AS nation FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q07c_plurality(spark, sf_dir):
    """Each order's most common nation over its (one) customer's rows."""
    items = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("order_key"), F.col("c_nationkey").alias("nation"))
    return plurality(items, "order_key", "nation").select("order_key", "nation")


@query("""SELECT DISTINCT 'p' || l_partkey AS start, 's' || l_suppkey AS id, 1 AS steps FROM lineitem UNION ALL SELECT DISTINCT 'p' || l_partkey, 'p' || l_partkey, 0 FROM lineitem""")
def q07d_path_enumeration(spark, sf_dir):
    """Shortest paths from entry nodes along directed edges; the number of steps of each."""
    edges = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("source"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("target"))
    found = graph.shortest_paths(edges, edges.select(F.col("source").alias("id")).distinct(), 8)
    return found.select("start", "id", (F.size("path") - 1).alias("steps"))


_BOUGHT = "e AS (SELECT DISTINCT 'c' || o_custkey AS a, 'p' || l_partkey AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity >= 40)"
_CO_LABELS = f"""WITH {_BOUGHT}, bw AS (SELECT a AS source, b AS target FROM e UNION ALL SELECT b, a FROM e), l0 AS (SELECT DISTINCT source AS id, source AS community FROM bw),
l1 AS (SELECT id, min(community) AS community FROM (SELECT * FROM l0 UNION ALL SELECT bw.source, l0.community FROM bw JOIN l0 ON bw.target = l0.id) GROUP BY id)"""


def _bought(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    rows = li.where("l_quantity >= 40").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.format_string("c%d", "o_custkey").alias("source"), F.format_string("p%d", "l_partkey").alias("target")).distinct()


@query(_CO_LABELS + " SELECT id, community FROM l1")
def q07e_bought_together(spark, sf_dir):
    """One label round over customers and the parts they bought."""
    return graph.min_labels(_bought(spark, sf_dir), 1)


@query(_CO_LABELS + """, m AS (SELECT count(*) AS m FROM e), x AS (SELECT p.community AS ca, q.community AS cb FROM e JOIN l1 p ON p.id = e.a JOIN l1 q ON q.id = e.b),
i AS (SELECT ca, count(*) FILTER (WHERE ca = cb) AS inside FROM x GROUP BY ca), d AS (SELECT c, count(*) AS d FROM (SELECT ca AS c FROM x UNION ALL SELECT cb FROM x) GROUP BY c),
q AS (SELECT round(sum(coalesce(inside, 0) / m.m - pow(d.d / (2.0 * m.m), 2)), 6) AS modularity FROM d LEFT JOIN i ON d.c = i.ca CROSS JOIN m)
SELECT modularity, CASE WHEN modularity >= 0.3 THEN 'communities' WHEN modularity >= 0.1 THEN 'weak communities' ELSE 'directories' END AS use FROM q""")
def q07f_modularity_ladder(spark, sf_dir):
    edges = _bought(spark, sf_dir)
    return graph.clustering(graph.modularity(edges, graph.min_labels(edges, 1)))


@query(f"""WITH {_KG}, p0 AS (SELECT id AS start, id, 0 AS steps FROM kg_nodes WHERE type = 'region'), p1 AS (SELECT start, e.target AS id, 1 AS steps FROM p0 JOIN kg_edges e ON e.source = p0.id), p2 AS (SELECT start, e.target AS id, 2 AS steps FROM p1 JOIN kg_edges e ON e.source = p1.id), p3 AS (SELECT start, e.target AS id, 3 AS steps FROM p2 JOIN kg_edges e ON e.source = p2.id)
SELECT * FROM p0 UNION ALL SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3""")
def q07g_paths_of_several_steps(spark, sf_dir):
    nodes, edges = knowledge_graph(spark, sf_dir)
    return graph.shortest_paths(edges, nodes.where("type = 'region'"), 8).select("start", "id", (F.size("path") - 1).alias("steps"))


@query("""WITH s AS (SELECT l_orderkey AS o, l_linenumber AS n, CASE WHEN l_returnflag = 'R' THEN 'go' || l_suppkey ELSE 'p' || l_partkey END AS node, l_returnflag = 'R' AS r FROM lineitem), d AS (SELECT DISTINCT * FROM s)
SELECT 'p' || a.l_partkey AS start, count(DISTINCT 'p' || c.l_partkey) AS ends FROM lineitem a JOIN lineitem b ON b.l_suppkey = a.l_suppkey JOIN lineitem c ON c.l_suppkey = b.l_suppkey AND c.l_partkey > a.l_partkey WHERE a.l_partkey % 50 = 0 AND b.l_linenumber = 1 AND c.l_linenumber = 1 GROUP BY 1""")
def q07h_paths_through_redirects(spark, sf_dir):
    """Suppliers are redirects, which take no place in a path: parts reach later parts of the same supplier in one step."""
    li = table(spark, sf_dir, "lineitem")
    into = li.select(F.format_string("p%d", "l_partkey").alias("source"), F.format_string("s%d", "l_suppkey").alias("target"))
    out = li.where("l_linenumber = 1").select(F.format_string("s%d", "l_suppkey").alias("source"), F.format_string("p%d", "l_partkey").alias("target"))
    edges = graph.without_redirects(into.unionByName(out).distinct(), into.select(F.col("target").alias("id")).distinct())
    number = lambda c: F.substr(c, F.lit(2)).cast("long")
    later = edges.where((number("target") > number("source")) & (number("source") % 50 == 0))
    return later.groupBy(F.col("source").alias("start")).agg(F.count_distinct("target").alias("ends"))
