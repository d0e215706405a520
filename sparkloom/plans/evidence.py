"""Classification, mining, triangulation and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coverage, rules, validate
from ..sources.tables import table
from .measures import _PARTS, _parts
from .registry import query


@query("""WITH o AS (SELECT o_custkey AS k, count(*) AS n, sum(o_totalprice) AS total, bool_or(o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1),
x AS (SELECT c_custkey, round((CASE WHEN coalesce(n, 0) >= 10 THEN 2.0 ELSE 0 END + CASE WHEN coalesce(urgent, false) THEN 1.0 ELSE 0 END + CASE WHEN c_acctbal < 0 THEN -1.0 ELSE 0 END + CASE WHEN c_mktsegment = 'BUILDING' THEN 0.5 ELSE 0 END)::DOUBLE, 4) AS score FROM customer LEFT JOIN o ON k = c_custkey)
SELECT c_custkey, score, CASE WHEN score >= 3 THEN 'business' WHEN score >= 1 THEN 'crud' ELSE 'infrastructure' END AS band FROM x""")
def q30_role_scoring(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    rows = table(spark, sf_dir, "customer").join(o, "c_custkey", "left")
    signals = {"many": (F.coalesce("n", F.lit(0)) >= 10, 2.0), "urgent": (F.coalesce("urgent", F.lit(False)), 1.0), "debt": (F.col("c_acctbal") < 0, -1.0), "building": (F.col("c_mktsegment") == "BUILDING", 0.5)}
    return coverage.signal_score(rows, signals, [(3, "business"), (1, "crud")], "infrastructure").select("c_custkey", "score", "band")


@query("""WITH c AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'signup') AS signups, count(*) FILTER (WHERE event_type = 'purchase') AS purchases, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE event_type = 'view') AS views, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT user_id, (signups > 0)::INT + (views > 0)::INT + (n <= 8)::INT AS a, (purchases > 1)::INT + (views > 1)::INT + (n >= 8)::INT AS b, (errors > 1)::INT + (errors > purchases)::INT AS c FROM c)
SELECT user_id, CASE WHEN greatest(CASE WHEN a >= 2 THEN a ELSE 0 END, CASE WHEN b >= 3 THEN b ELSE 0 END, CASE WHEN c >= 2 THEN c ELSE 0 END) = 0 THEN 'none'
WHEN a >= 2 AND a >= (CASE WHEN b >= 3 THEN b ELSE 0 END) AND a >= (CASE WHEN c >= 2 THEN c ELSE 0 END) THEN 'registration' WHEN b >= 3 AND b >= (CASE WHEN c >= 2 THEN c ELSE 0 END) THEN 'checkout' ELSE 'trouble' END AS pattern,
greatest(CASE WHEN a >= 2 THEN a ELSE 0 END, CASE WHEN b >= 3 THEN b ELSE 0 END, CASE WHEN c >= 2 THEN c ELSE 0 END) AS matched FROM s""")
def q31_pattern_mining(spark, sf_dir):
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    c = table(spark, sf_dir, "events").groupBy("user_id").agg(n("signup").alias("signups"), n("purchase").alias("purchases"), n("error").alias("errors"), n("view").alias("views"), F.count("*").alias("n"))
    col = F.col
    patterns = [
        ("registration", 2, [col("signups") > 0, col("views") > 0, col("n") <= 8]),
        ("checkout", 3, [col("purchases") > 1, col("views") > 1, col("n") >= 8]),
        ("trouble", 2, [col("errors") > 1, col("errors") > col("purchases")]),
    ]
    return rules.best_pattern(c, ["user_id"], patterns)


@query("""WITH r AS (SELECT doc_id, lang AS category, 0.7::DOUBLE AS confidence FROM documents), dup AS (SELECT md5(text) AS h FROM documents GROUP BY 1 HAVING count(*) = 1),
e AS (SELECT doc_id, 'label' AS stream FROM labels UNION SELECT doc_id, 'long' FROM documents WHERE n_chars >= 1000 UNION SELECT doc_id, 'single' FROM documents WHERE md5(text) IN (SELECT h FROM dup)),
a(category, stream) AS (VALUES ('en', 'label'), ('en', 'long'), ('en', 'single'), ('fr', 'label'), ('fr', 'long'), ('de', 'label'), ('de', 'single')),
x AS (SELECT r.doc_id, r.category, r.confidence, CASE r.category WHEN 'en' THEN 3 WHEN 'fr' THEN 2 WHEN 'de' THEN 2 ELSE 0 END AS applicable, count(DISTINCT a.stream) AS corroborating FROM r LEFT JOIN e ON e.doc_id = r.doc_id LEFT JOIN a ON a.category = r.category AND a.stream = e.stream GROUP BY ALL),
s AS (SELECT *, CASE WHEN applicable = 0 THEN 0 ELSE corroborating / applicable END AS raw FROM x),
t AS (SELECT *, CASE WHEN raw >= 0.6 THEN 'STRONG' WHEN raw >= 0.33 THEN 'MODERATE' ELSE 'WEAK' END AS status FROM s)
SELECT doc_id, applicable, corroborating, round(raw, 4)::DOUBLE AS score, status, round(CASE status WHEN 'STRONG' THEN least(0.97, confidence + 0.05) WHEN 'WEAK' THEN greatest(0.1, confidence - 0.1) ELSE confidence END, 4) AS confidence FROM t""")
def q32_triangulation(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    single = docs.groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n = 1")
    e = table(spark, sf_dir, "labels").select("doc_id", F.lit("label").alias("stream")).unionByName(docs.where("n_chars >= 1000").select("doc_id", F.lit("long").alias("stream"))).unionByName(single.select("doc_id", F.lit("single").alias("stream")))
    r = docs.select("doc_id", F.col("lang").alias("category"), F.lit(0.7).alias("confidence"))
    return rules.triangulated(r, e, "doc_id", {"en": ["label", "long", "single"], "fr": ["label", "long"], "de": ["label", "single"]}).select("doc_id", "applicable", "corroborating", "score", "status", "confidence")


@query("""WITH m AS (SELECT n_regionkey, max(s_acctbal) / 10000 AS best FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1)
SELECT s_suppkey, round(least(0.97, 0.6 + CASE WHEN best >= 0.75 THEN 0.08 WHEN best >= 0.5 THEN 0.04 ELSE 0 END + 0.3 * (s_acctbal > 5000)::INT), 4)::DOUBLE AS confidence FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN m USING (n_regionkey)""")
def q33_boost(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    best = s.groupBy("n_regionkey").agg((F.max("s_acctbal") / 10000).alias("best"))
    own = F.lit(0.6) + F.when(F.col("s_acctbal") > 5000, 0.3).otherwise(0.0)
    return s.join(best, "n_regionkey").select("s_suppkey", F.round(rules.boosted(own, F.col("best")), 4).alias("confidence"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'critical' WHEN c_acctbal > 9000 THEN 'major' ELSE 'minor' END AS severity FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def q34_missing(spark, sf_dir):
    severity = F.when(F.col("c_acctbal") < 0, "critical").when(F.col("c_acctbal") > 9000, "major").otherwise("minor")
    return validate.missing(table(spark, sf_dir, "customer"), [(table(spark, sf_dir, "orders"), "o_custkey")], "c_custkey", severity).select("c_custkey", "severity")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""")
def q35_unknown_references(spark, sf_dir):
    known = table(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    return validate.unknown(table(spark, sf_dir, "lineitem"), known, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT l_orderkey, count(DISTINCT l_suppkey) AS targets FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) >= 2""")
def q36_several_targets(spark, sf_dir):
    return validate.several_targets(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query("""WITH x AS (SELECT l_orderkey, round(0.6 * avg((l_quantity > 10)::INT) + 0.4 * avg((l_returnflag <> 'R')::INT), 4) AS confidence, count(*) AS steps FROM lineitem GROUP BY 1)
SELECT *, CASE WHEN confidence >= 0.7 THEN 'pass' WHEN confidence >= 0.4 THEN 'warn' ELSE 'fail' END AS grade FROM x""")
def q37_step_confidence(spark, sf_dir):
    return validate.step_confidence(table(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_quantity") > 10, F.col("l_returnflag") != "R")


@query(f"WITH {_PARTS} SELECT round(min(pct), 4) AS weakest, min(pct) >= 0.8 AS agreed FROM p")
def q38_consensus(spark, sf_dir):
    return coverage.consensus(_parts(spark, sf_dir))


@query("""WITH f AS (SELECT CASE WHEN c_acctbal < 0 THEN 'critical' WHEN c_acctbal > 9000 THEN 'major' ELSE 'minor' END AS severity FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))
SELECT count(*) FILTER (WHERE severity IN ('critical', 'major')) AS weighty, count(*) AS findings, CASE WHEN count(*) FILTER (WHERE severity IN ('critical', 'major')) >= 10 THEN 'fail' WHEN count(*) FILTER (WHERE severity IN ('critical', 'major')) >= 5 THEN 'warn' ELSE 'pass' END AS status FROM f""")
def q38b_verdict(spark, sf_dir):
    return validate.verdict(q34_missing(spark, sf_dir), 5, 10)


@query("""WITH c AS (SELECT o_custkey AS k, 'order' AS category FROM orders UNION SELECT o_custkey, 'line' FROM orders JOIN lineitem ON l_orderkey = o_orderkey UNION SELECT c_custkey, 'balance' FROM customer WHERE c_acctbal > 0 UNION SELECT c_custkey, 'segment' FROM customer WHERE c_mktsegment IS NOT NULL)
SELECT k, round(least(1.0, count(DISTINCT category) * 0.2), 4)::DOUBLE AS confidence, CASE WHEN count(DISTINCT category) * 0.2 >= 0.8 THEN 'high' WHEN count(DISTINCT category) * 0.2 >= 0.4 THEN 'medium' ELSE 'low' END AS grade FROM c GROUP BY k""")
def q38c_evidence_confidence(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    tag = lambda df, k, c: df.select(F.col(k).alias("k"), F.lit(c).alias("category"))
    lines = orders.join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_semi")
    e = tag(orders, "o_custkey", "order").unionByName(tag(lines, "o_custkey", "line")).unionByName(tag(customer.where("c_acctbal > 0"), "c_custkey", "balance")).unionByName(tag(customer.where("c_mktsegment is not null"), "c_custkey", "segment"))
    return coverage.evidence_confidence(e, "k", "category")


@query("""WITH f AS (SELECT o_orderkey AS file, o_custkey AS c, o_orderpriority AS p FROM orders), m AS (SELECT DISTINCT c_mktsegment AS module, c_custkey AS c FROM customer),
s AS (SELECT file, module, sum(w) AS score FROM (SELECT file, module, 2.0 AS w FROM f JOIN m USING (c) UNION ALL SELECT file, 'BUILDING', 1.0 FROM f WHERE p = '1-URGENT') GROUP BY ALL)
SELECT file, arg_min(module, (-score, module)) AS module, max(score)::DOUBLE AS score FROM s WHERE score >= 1.5 GROUP BY file""")
def q38d_module_assignment(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    files = orders.select(F.col("o_orderkey").alias("file"), F.lit("customer").alias("kind"), F.col("o_custkey").cast("string").alias("value")).unionByName(orders.select(F.col("o_orderkey").alias("file"), F.lit("priority").alias("kind"), F.col("o_orderpriority").alias("value")))
    modules = customer.select(F.col("c_mktsegment").alias("module"), F.lit("customer").alias("kind"), F.col("c_custkey").cast("string").alias("value")).unionByName(spark.createDataFrame([("BUILDING", "priority", "1-URGENT")], "module string, kind string, value string"))
    return rules.assigned(files, modules, {"customer": 2.0, "priority": 1.0})


@query("""SELECT n_nationkey AS k, count(*) AS items FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1 HAVING NOT bool_or(c_acctbal > 9900)""")
def q38e_gaps(spark, sf_dir):
    items = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), (F.col("c_acctbal") > 9900).alias("hit"))
    return rules.gaps(items, "k", "hit")


@query("""SELECT source, count(*) AS "rows" FROM documents GROUP BY source HAVING count(*) > 1""")
def q38f_repeated_keys(spark, sf_dir):
    return validate.repeated_keys(table(spark, sf_dir, "documents"), ["source"])


@query("""SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda w: w IN ('cold', 'widget', 'small')), ',') AS words FROM part""")
def q35b_unknown_items(spark, sf_dir):
    known = spark.createDataFrame([("cold",), ("widget",), ("small",)], "w string")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return validate.unknown_items(rows, "words", known, "w").select("p_partkey", F.array_join("words", ",").alias("words"))
