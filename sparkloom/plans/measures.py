"""Rollups, distributions and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage, merge, telemetry
from ..sources.tables import table
from .registry import query


@query("""SELECT event_type, CAST(ts AS DATE)::VARCHAR AS day, count(*) AS calls, round(sum(greatest(coalesce(value, 0), 0)), 4) AS total_value FROM events GROUP BY 1, 2""")
def q08_event_rollup(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return telemetry.rollup(events, ["event_type", "day"], ["value"])


@query("""SELECT l_returnflag, min(l_extendedprice) AS min, round(median(l_extendedprice), 4) AS median, round(avg(l_extendedprice), 4) AS mean,
quantile_disc(l_extendedprice, 0.95) AS p95, max(l_extendedprice) AS max, count(*) AS n FROM lineitem GROUP BY l_returnflag""")
def q09_distribution(spark, sf_dir):
    return telemetry.distribution(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")


@query("""WITH a AS (SELECT count(*) AS calls, round(avg(value), 4) AS mean FROM events WHERE event_type = 'click'),
b AS (SELECT count(*) AS calls, round(avg(value), 4) AS mean FROM events WHERE event_type = 'view')
SELECT a.calls AS a_calls, a.mean AS a_mean, b.calls AS b_calls, b.mean AS b_mean, round(a.calls / b.calls, 4) AS ratio_calls, round(a.mean / b.mean, 4) AS ratio_mean FROM a, b""")
def q10_run_comparison(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    run = lambda kind: events.where(F.col("event_type") == kind).agg(F.count("*").alias("calls"), F.round(F.avg("value"), 4).alias("mean"))
    return telemetry.compared(run("click"), run("view"), ["calls", "mean"])


_FLAGGED = "f AS (SELECT d.doc_id, d.lang, d.source, l.doc_id IS NOT NULL AS covered FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id))"


def _labelled(spark, sf_dir):
    return coverage.flag(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), table(spark, sf_dir, "labels"), ["doc_id"])


@query(f"""WITH {_FLAGGED}, m AS (SELECT lang, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS missing FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM f WHERE NOT covered) WHERE n <= 30 GROUP BY lang),
g AS (SELECT lang, count(*) FILTER (WHERE covered) AS covered, count(*) AS total FROM f GROUP BY lang)
SELECT lang, covered, total, round(covered / total, 4) AS pct, CASE WHEN covered / total >= 0.85 THEN 'pass' WHEN covered / total >= 0.5 THEN 'warn' ELSE 'fail' END AS status, coalesce(missing, '') AS missing FROM g LEFT JOIN m USING (lang)""")
def q11_coverage(spark, sf_dir):
    out = coverage.coverage(_labelled(spark, sf_dir), ["lang"], "doc_id")
    return out.withColumn("status", coverage.status(F.col("covered") / F.col("total"), 0.85, 0.5))


@query(f"WITH {_FLAGGED} SELECT doc_id, covered, bool_or(covered) OVER (PARTITION BY source, lang) AS expanded FROM f")
def q12_sibling_expansion(spark, sf_dir):
    return coverage.spread_hits(_labelled(spark, sf_dir), ["source", "lang"]).select("doc_id", "covered", "expanded")


@query("""WITH c AS (SELECT c_nationkey AS nation, avg(CASE WHEN o.k IS NOT NULL THEN 1.0 ELSE 0.0 END) AS pct FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON o.k = c_custkey GROUP BY 1),
s AS (SELECT s_nationkey AS nation, avg(CASE WHEN s_acctbal > 0 THEN 1.0 ELSE 0.0 END) AS pct FROM supplier GROUP BY 1)
SELECT coalesce(c.nation, s.nation) AS nation, round(c.pct, 4) AS customers, round(s.pct, 4) AS suppliers,
round((coalesce(round(c.pct, 4), 0) + coalesce(round(s.pct, 4), 0)) / ((c.pct IS NOT NULL)::INT + (s.pct IS NOT NULL)::INT), 4) AS average FROM c FULL OUTER JOIN s ON c.nation = s.nation""")
def q13_module_matrix(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    pct = lambda df, c: df.groupBy("nation").agg(F.round(F.avg(c.cast("double")), 4).alias("pct"))
    a = pct(coverage.flag(customers, orders, ["c_custkey"]), F.col("covered"))
    b = pct(table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nation"), F.col("s_acctbal") > 0)
    return coverage.matrix({"customers": a, "suppliers": b}, "nation")


_PARTS = """parts AS (SELECT 'orders' AS name, count(DISTINCT o_custkey) AS covered, (SELECT count(*) FROM customer) AS total FROM orders
UNION ALL SELECT 'lines', count(DISTINCT l_orderkey), (SELECT count(*) FROM orders) FROM lineitem
UNION ALL SELECT 'parts', count(DISTINCT l_partkey), (SELECT count(*) FROM part) FROM lineitem
UNION ALL SELECT 'labels', count(DISTINCT doc_id), (SELECT count(*) FROM documents) FROM labels),
p AS (SELECT *, covered / total AS raw, round(covered / total, 4) AS pct, CASE WHEN covered / total >= 0.85 THEN 'pass' WHEN covered / total >= 0.5 THEN 'warn' ELSE 'fail' END AS status FROM parts)"""


def _parts(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    one = lambda name, a, key, b: a.agg(F.count_distinct(key).alias("covered")).crossJoin(b.agg(F.count("*").alias("total"))).withColumn("name", F.lit(name))
    rows = one("orders", t("orders"), "o_custkey", t("customer")).unionByName(one("lines", t("lineitem"), "l_orderkey", t("orders"))).unionByName(one("parts", t("lineitem"), "l_partkey", t("part"))).unionByName(one("labels", t("labels"), "doc_id", t("documents")))
    raw = coverage.ratio(F.col("covered"), F.col("total"), 1.0)
    return rows.withColumn("pct", F.round(raw, 4)).withColumn("status", coverage.status(raw, 0.85, 0.5))


@query(f"WITH {_PARTS} SELECT round(avg(pct), 4) AS avg_pct, round(avg(CASE status WHEN 'pass' THEN 1.0 WHEN 'warn' THEN 0.5 ELSE 0.0 END), 4) AS avg_status, round((avg(pct) + avg(CASE status WHEN 'pass' THEN 1.0 WHEN 'warn' THEN 0.5 ELSE 0.0 END)) / 2, 4) AS composite FROM p")
def q14_composite(spark, sf_dir):
    return coverage.macro(_parts(spark, sf_dir))


@query(f"WITH {_PARTS} SELECT round(sum(covered) / sum(total), 4) AS micro FROM p")
def q14b_micro_average(spark, sf_dir):
    return coverage.micro(_parts(spark, sf_dir))


@query("""SELECT n_name AS nation, round(0.6 * v + 0.4 * c, 4) AS accuracy FROM nation JOIN (SELECT c_nationkey AS k, avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END) AS v, avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END) AS c FROM customer GROUP BY 1) ON k = n_nationkey""")
def q14c_weighted_composite(spark, sf_dir):
    parts = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.avg((F.col("c_acctbal") > 0).cast("double")).alias("v"), F.avg((F.col("c_mktsegment") == "BUILDING").cast("double")).alias("c"))
    return table(spark, sf_dir, "nation").join(parts, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("nation"), F.round(coverage.weighted(F.col("v"), F.col("c")), 4).alias("accuracy"))


@query("""SELECT user_id, arg_min(event_type = 'purchase', (ts, event_id)) AS covered FROM events GROUP BY user_id""")
def q14d_first_row_decides(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ord", F.struct("ts", "event_id")).withColumn("covered", F.col("event_type") == "purchase")
    return coverage.distinct_coverage(events, ["user_id"], "covered", "ord")


@query("""SELECT source, lang, doc_id, n_chars, running FROM (SELECT *, CAST(sum(n_chars) OVER (PARTITION BY lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM documents) WHERE running <= 20000""")
def q20_budget_cut(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars")
    return merge.budget_cut(docs, "n_chars", ["doc_id"], 20_000, ["lang"])


@query("""SELECT event_type, CAST(floor((row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) / 64) AS BIGINT) AS batch, event_id FROM events""")
def q20b_batches(spark, sf_dir):
    return merge.batches(table(spark, sf_dir, "events"), 64, ["ts", "event_id"], ["event_type"]).select("event_type", "batch", "event_id")


@query("""WITH x AS (SELECT n_nationkey AS nation, CASE WHEN n_nationkey % 3 <> 0 THEN n_regionkey / 5.0 END AS v, CASE WHEN n_nationkey % 4 <> 0 THEN n_nationkey / 25.0 END AS c FROM nation)
SELECT nation, round(CASE WHEN v IS NOT NULL AND c IS NOT NULL THEN 0.6 * v + 0.4 * c ELSE coalesce(v, c) END, 4) AS accuracy FROM x""")
def q14g_weighted_with_fallbacks(spark, sf_dir):
    k = F.col("n_nationkey")
    v, c = F.when(k % 3 != 0, F.col("n_regionkey") / 5.0), F.when(k % 4 != 0, k / 25.0)
    return table(spark, sf_dir, "nation").select(k.alias("nation"), F.round(coverage.weighted(v, c), 4).alias("accuracy"))


@query("""WITH x AS (SELECT event_type, sum(greatest(coalesce(CASE WHEN event_id % 9 = 0 THEN -1 ELSE event_id % 50 END, 0), 0)) AS a, sum(CASE WHEN event_type = 'click' THEN 0 ELSE coalesce(value, 0) END) AS s FROM events GROUP BY 1)
SELECT event_type, round(CASE WHEN s > 0 THEN a / s END, 4) AS per_second, round(CASE WHEN a > 0 THEN 1000 * s / a END, 4) AS seconds_per_1000 FROM x""")
def q09b_rates(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("tokens", F.when(F.col("event_id") % 9 == 0, -1).otherwise(F.col("event_id") % 50)).withColumn("seconds", F.when(F.col("event_type") == "click", 0.0).otherwise(F.col("value")))
    return telemetry.rate(events, ["event_type"], "tokens", "seconds")
