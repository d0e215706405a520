"""Merges, rankings, evidence, chunks, documents and diagrams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.keys import cache_key, human, normal_route, numbered, plural, snake
from ..operators import chunks, evidence, extract, graph, merge, mining, relations, retrieve, rules, states, validate
from ..sources import tables as sources
from ..sources.tables import table
from .graphs import knowledge_graph
from .registry import query


@query("""SELECT o_custkey AS k, arg_min(o_orderkey, (-conf, -pri, o_orderkey)) AS o_orderkey FROM (SELECT *, (o_orderkey % 4) / 4.0 AS conf, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END AS pri FROM orders) GROUP BY 1""")
def q90_by_priority(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", ((F.col("o_orderkey") % 4) / 4.0).alias("conf"), F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 2).otherwise(1).alias("pri"))
    return merge.by_priority(rows, ["k"], "conf", "pri", "o_orderkey").select("k", "o_orderkey")


@query("""WITH p AS (SELECT p_partkey, p_brand AS run, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name FROM part), s AS (SELECT *, count(*) OVER (PARTITION BY run) AS n FROM p)
SELECT run, name FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY n DESC, run, name) AS k FROM s) WHERE k = 1""")
def q90b_base_and_rest(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("run"), F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"))
    return merge.base_and_rest(rows, "run", "name").select("run", "name")


@query("""WITH c AS (SELECT l_orderkey AS pos, l_linenumber AS run, l_partkey, CASE WHEN l_quantity > 20 THEN 'x' ELSE '' END AS a, CASE WHEN l_tax > 0.04 THEN 'y' END AS b, CASE WHEN l_discount > 0.05 THEN 1 END AS c, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord FROM lineitem)
SELECT pos, ord FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY (a <> '')::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT DESC, ord) AS k FROM c) WHERE k = 1""")
def q90c_fullest(spark, sf_dir):
    from pyspark.sql import Window

    ord_ = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")).cast("long")
    rows = table(spark, sf_dir, "lineitem").withColumn("ord", ord_).select(F.col("l_orderkey").alias("pos"), "ord", F.when(F.col("l_quantity") > 20, "x").otherwise("").alias("a"), F.when(F.col("l_tax") > 0.04, "y").alias("b"), F.when(F.col("l_discount") > 0.05, 1).alias("c"))
    return merge.fullest(rows, "pos", ["a", "b", "c"], "ord").select("pos", "ord")


@query("""SELECT c_custkey, round(least(0.85, 0.25 + 0.1 * ((c_acctbal > 0)::INT + (c_acctbal > 5000)::INT + (c_mktsegment = 'BUILDING')::INT)), 4)::DOUBLE AS confidence FROM customer""")
def q91_path_confidence(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(rules.path_confidence(c("c_acctbal") > 0, c("c_acctbal") > 5000, c("c_mktsegment") == "BUILDING"), 4).alias("confidence"))


@query("""SELECT s_suppkey, round(s_acctbal / 10000 + 0.5 * least(s_suppkey % 13, 8) + 1.5 * least(s_nationkey % 5, 3) + 3 * (s_suppkey % 2 = 0)::INT + 3 * (s_suppkey % 3 = 0)::INT + 4 * (s_suppkey % 5 = 0)::INT, 6) AS score FROM supplier""")
def q91b_relevance(spark, sf_dir):
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(retrieve.relevance(F.col("s_acctbal") / 10000, k % 13, F.col("s_nationkey") % 5, k % 2 == 0, k % 3 == 0, k % 5 == 0), 6).alias("score"))


@query("""WITH r AS (SELECT s_suppkey AS id, (s_suppkey % 4)::DOUBLE AS score, s_acctbal AS confidence FROM supplier) SELECT id, row_number() OVER (ORDER BY score DESC, confidence DESC, id DESC)::INT AS rank FROM r WHERE score > 0""")
def q91c_ranked_rules(spark, sf_dir):
    r = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 4).cast("double").alias("score"), F.col("s_acctbal").alias("confidence"))
    return rules.rank_rules(r, [F.desc("score"), F.desc("confidence"), F.desc("id")]).select("id", "rank")


@query("""SELECT id, row_number() OVER (ORDER BY confidence DESC, id DESC)::INT AS rank FROM (SELECT s_suppkey AS id, s_acctbal AS confidence FROM supplier)""")
def q91d_ranked_without_scores(spark, sf_dir):
    r = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.lit(0.0).alias("score"), F.col("s_acctbal").alias("confidence"))
    return rules.rank_rules(r, [F.desc("score"), F.desc("confidence"), F.desc("id")]).select("id", "rank")


@query("""WITH f AS (SELECT CASE WHEN c_acctbal < 0 THEN 'critical' WHEN c_acctbal > 9000 THEN 'major' ELSE 'minor' END AS severity FROM customer WHERE c_custkey % 7 = 0)
SELECT count(*) FILTER (WHERE severity = 'critical') AS critical, count(*) FILTER (WHERE severity = 'major') AS major, count(*) FILTER (WHERE severity <> 'minor') = 0 AS passed FROM f""")
def q92_qa(spark, sf_dir):
    b = F.col("c_acctbal")
    return validate.qa(table(spark, sf_dir, "customer").where("c_custkey % 7 = 0").select(F.when(b < 0, "critical").when(b > 9000, "major").otherwise("minor").alias("severity")), 0.9)


@query("""WITH f AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'minor' WHEN 1 THEN 'critical' WHEN 2 THEN 'other' ELSE 'major' END AS severity FROM supplier) SELECT s_suppkey, row_number() OVER (ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'major' THEN 1 WHEN 'minor' THEN 2 ELSE 3 END, s_suppkey) AS place FROM f""")
def q92b_by_severity(spark, sf_dir):
    name = F.element_at(F.array(*map(F.lit, ("minor", "critical", "other", "major"))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return mining.by_severity(table(spark, sf_dir, "supplier").select("s_suppkey", name.alias("severity")), order=("s_suppkey",)).select("s_suppkey", "place")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(o_totalprice > 100000, false) DESC, o_orderkey) AS place FROM orders""")
def q92c_relevant_first(spark, sf_dir):
    return mining.relevant_first(table(spark, sf_dir, "orders"), F.col("o_totalprice") > 100000, ["o_custkey"], "o_orderkey").select("o_orderkey", "place")


@query("""WITH RECURSIVE o AS (SELECT lang, doc_id, n_chars AS size, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos FROM documents),
b(lang, batch, lo, hi) AS (SELECT lang, '', 0::BIGINT, count(*)::BIGINT FROM o GROUP BY lang UNION ALL
SELECT b.lang, b.batch || h.h, CASE h.h WHEN '0' THEN lo ELSE lo + (hi - lo) // 2 END, CASE h.h WHEN '0' THEN lo + (hi - lo) // 2 ELSE hi END FROM b, (VALUES ('0'), ('1')) h(h) WHERE hi - lo > 1 AND (SELECT sum(size) FROM o WHERE o.lang = b.lang AND pos >= lo AND pos < hi) > 50000)
SELECT o.doc_id, max_by(b.batch, length(b.batch)) AS batch FROM o JOIN b ON b.lang = o.lang AND o.pos >= b.lo AND o.pos < b.hi GROUP BY o.doc_id""")
def q92d_halved_batches(spark, sf_dir):
    return mining.halved(table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars"), "n_chars", "doc_id", 50_000, ["lang"]).select("doc_id", "batch")


@query("""WITH t AS (SELECT DISTINCT p_partkey, unnest(string_split(lower(p_name), ' ')) AS word FROM part) SELECT word, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS ids FROM t GROUP BY word""")
def q92e_inverted_index(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.split(F.lower("p_name"), " ").alias("words"))
    return mining.inverted(rows, "word", "p_partkey", "words").select("word", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query("""SELECT 'order:' || o_orderkey AS source, count(*) AS n FROM orders WHERE false GROUP BY 1 UNION ALL SELECT 'nation:' || n_nationkey, count(*) FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""")
def q93_subgraph_by_type(spark, sf_dir):
    nodes, edges = knowledge_graph(spark, sf_dir)
    return graph.of_type(nodes, edges, ["nation", "customer"])[1].groupBy("source").agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT DISTINCT o_custkey % 20 AS k, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'SAVE' ELSE '12' END AS v FROM orders) SELECT k, string_agg(v, ',' ORDER BY v) AS states FROM x WHERE v NOT IN ('SAVE', '12') GROUP BY k HAVING count(*) >= 2""")
def q27c_states_without_noise(spark, sf_dir):
    s = F.col("o_orderstatus")
    value = F.when(s == "F", "Finished").when(s == "O", "open").when(s == "P", "SAVE").otherwise("12")
    found = states.inventory(table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("k"), value.alias("v")), ["k"], "v")
    return found.select("k", F.array_join("states", ",").alias("states"))


@query("""SELECT DISTINCT p_type AS name FROM part WHERE NOT EXISTS (SELECT 1 FROM (SELECT lower(p_brand || ' economy of part') AS hay FROM part) h WHERE contains(h.hay, lower(p_type)))""")
def q94_not_mentioned(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return validate.not_mentioned(part.select(F.col("p_type").alias("name")).distinct(), part.select(F.concat("p_brand", F.lit(" economy of part")).alias("hay")), "name", "hay")


@query("""SELECT s_suppkey, concat_ws(',', CASE WHEN s_suppkey % 3 = 0 THEN 'name' END, CASE WHEN s_suppkey % 4 = 0 THEN 'nation' END) AS lacks FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey % 4 = 0""")
def q94b_required(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 3 == 0, "").otherwise(F.col("s_name")).alias("name"), F.when(k % 4 != 0, F.col("s_nationkey")).alias("nation"))
    return validate.required(rows, ["name", "nation"]).select("s_suppkey", "lacks")


@query("""WITH s AS (SELECT 'balance' AS "check", CASE WHEN count(*) FILTER (WHERE c_acctbal < 0) >= 10 THEN 'fail' WHEN count(*) FILTER (WHERE c_acctbal < 0) >= 5 THEN 'warn' ELSE 'pass' END AS status FROM customer UNION ALL SELECT 'none', 'pass')
SELECT *, CASE (SELECT max(CASE status WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END) FROM s) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS grade FROM s""")
def q94c_scorecard(spark, sf_dir):
    bad = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.lit("major").alias("severity"))
    return validate.scorecard({"balance": validate.verdict(bad, 5, 10), "none": validate.verdict(bad.limit(0), 5, 10)})


@query("""SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS n FROM lineitem) WHERE n <= 3""")
def q94d_capped_report(spark, sf_dir):
    return validate.capped(table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], 3).select("l_suppkey", "l_orderkey", "l_linenumber")


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)""")
def q34b_missing_by_two_keys(spark, sf_dir):
    """Neither ordered nor near a rich supplier: an OR of semi joins on different keys."""
    near = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "supplier").where("s_acctbal > 8000").select(F.col("s_nationkey").alias("c_nationkey")).distinct(), "c_nationkey")
    ordered = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return validate.missing(table(spark, sf_dir, "customer"), [(ordered, "o_custkey"), (near, "c_custkey")], "c_custkey", F.lit("minor")).select("c_custkey")


@query(r"""WITH d AS (SELECT doc_id, '# Doc' || chr(10) || '## Actors' || chr(10) || '- reader ' || doc_id || chr(10) || 'plain' || chr(10) || '## Rules of ' || lang || chr(10) || '1. be ' || source || chr(10) || '### Other' || chr(10) || '- lost [BR-' || doc_id % 30 || '] and [tr-br-7]' AS text FROM documents)
SELECT doc_id, 'actors' AS kind, 'reader ' || doc_id AS item FROM d UNION ALL SELECT doc_id, 'rules', 'be ' || source FROM documents""")
def q95_section_items(spark, sf_dir):
    return tx.section_lines(_written(spark, sf_dir), ["doc_id"], {"actors": "actor|role", "rules": "rule"}).select("doc_id", "kind", "item")


def _written(spark, sf_dir):
    text = F.concat(F.lit("# Doc\n## Actors\n- reader "), F.col("doc_id").cast("string"), F.lit("\nplain\n## Rules of "), "lang", F.lit("\n1. be "), "source", F.lit("\n### Other\n- lost [BR-"), (F.col("doc_id") % 30).cast("string"), F.lit("] and [tr-br-7]"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


@query("""SELECT doc_id, 'BR-' || doc_id % 30 || ',TR-BR-7' AS cited, 'Actors,Rules of ' || lang || ',Other' AS headings, 3::BIGINT AS sections FROM documents""")
def q95b_citations_and_headings(spark, sf_dir):
    t = F.col("text")
    return _written(spark, sf_dir).select("doc_id", F.array_join(tx.citations(t), ",").alias("cited"), F.array_join(tx.headings(t), ",").alias("headings"), F.size(tx.sections(t)).cast("long").alias("sections"))


@query("""SELECT 'doc' || d.doc_id AS doc, count(DISTINCT r.rule) AS cited, round(count(DISTINCT r.rule) / 40, 4) AS fraction FROM documents d LEFT JOIN (SELECT 'BR-' || range AS rule FROM range(40)) r ON r.rule = 'BR-' || d.doc_id % 30 GROUP BY 1""")
def q95c_traceability(spark, sf_dir):
    cited = _written(spark, sf_dir).select(F.format_string("doc%d", "doc_id").alias("doc"), F.explode(tx.citations(F.col("text"))).alias("rule"))
    known = spark.range(40).select(F.format_string("BR-%d", "id").alias("rule"))
    return evidence.traceability(cited, known, cited.select("doc"))[0]


@query("""SELECT 'BR-' || r.range AS rule, count(d.doc_id) AS links FROM range(40) r LEFT JOIN documents d ON d.doc_id % 30 = r.range GROUP BY 1""")
def q95d_rule_links(spark, sf_dir):
    cited = _written(spark, sf_dir).select(F.format_string("doc%d", "doc_id").alias("doc"), F.explode(tx.citations(F.col("text"))).alias("rule"))
    known = spark.range(40).select(F.format_string("BR-%d", "id").alias("rule"))
    return evidence.traceability(cited, known, cited.select("doc"))[1]


@query("""SELECT doc_id, CASE WHEN strpos(text, 'that') > 0 THEN substr(text, greatest(1, strpos(text, 'that') - 10)::BIGINT, 24) END AS snippet FROM documents""")
def q95e_snippets(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.snippet(F.col("text"), F.lit("that"), 10).alias("snippet"))


@query("""SELECT doc_id, unnest(['heading', 'heading', 'list', 'paragraph', 'heading', 'list', 'heading', 'list']) AS kind, unnest(range(8))::INT AS ord FROM documents""")
def q95f_markdown_blocks(spark, sf_dir):
    return extract.markdown_blocks(_written(spark, sf_dir), ["doc_id"]).select("doc_id", "kind", "ord")


@query("""SELECT doc_id, sum(ceil(length(s) / 9.0))::BIGINT AS parts FROM (SELECT doc_id, unnest(['# Doc' || chr(10), '## Actors' || chr(10) || '- reader ' || doc_id || chr(10) || 'plain' || chr(10), '## Rules of ' || lang || chr(10) || '1. be ' || source || chr(10), '### Other' || chr(10) || '- lost [BR-' || doc_id % 30 || '] and [tr-br-7]']) AS s FROM documents) GROUP BY 1""")
def q95g_bounded_sections(spark, sf_dir):
    return _written(spark, sf_dir).select("doc_id", F.size(tx.bounded_sections(F.col("text"), 9)).cast("long").alias("parts"))


@query("""SELECT event_id, '{"k": {"v": ' || event_id || ', "s": "a"}}' AS whole, event_id AS v FROM events""")
def q95h_json_recovery(spark, sf_dir):
    text = F.format_string('```json\n{"k": {"v": %d, "s": "a', "event_id")
    whole = extract.closed_json(table(spark, sf_dir, "events").select("event_id", F.regexp_replace(text, r"^```json\n", "").alias("text")))
    fenced = whole.select("event_id", F.concat(F.lit("Here it is:\n```json\n"), "whole", F.lit("\n```")).alias("t"))
    found = tx.json_object(F.regexp_replace("t", r"(?s)^.*?```json", "```json"))
    return fenced.select("event_id", found.alias("whole"), F.get_json_object(found, "$.k.v").cast("long").alias("v"))


@query("""SELECT p_partkey, upper(p_brand[1]) || lower(p_brand[2:]) || ' Size' AS human, CASE WHEN p_partkey % 3 = 0 THEN 'cities' WHEN p_partkey % 3 = 1 THEN 'boxes' ELSE 'days' END AS plural, 'big_part_' || p_size AS snake, 'a' || chr(10) || 'b' AS feeds FROM part""")
def q96_names(spark, sf_dir):
    noun = F.when(F.col("p_partkey") % 3 == 0, "city").when(F.col("p_partkey") % 3 == 1, "box").otherwise("day")
    return table(spark, sf_dir, "part").select("p_partkey", human(F.concat(F.lower("p_brand"), F.lit("_size"))).alias("human"), plural(noun).alias("plural"), snake(F.format_string("bigPart %d", "p_size")).alias("snake"), tx.real_line_feeds(F.lit("a\\nb")).alias("feeds"))


@query("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'category' WHEN 1 THEN 'box' WHEN 2 THEN 'order' ELSE 'address' END AS entity FROM supplier""")
def q96b_entities(spark, sf_dir):
    name = F.element_at(F.array(*map(F.lit, ("Categories", "boxes", "orders", "address"))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", relations.entity_of(name).alias("entity"))


@query("""SELECT n_nationkey, sha256(n_name || chr(0) || n_regionkey) AS key, 'N-' || lpad((row_number() OVER (ORDER BY n_regionkey, n_nationkey))::VARCHAR, 3, '0') AS id FROM nation""")
def q96c_keys_and_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").withColumn("key", cache_key(F.col("n_name"), F.col("n_regionkey").cast("string")))
    return numbered(rows, "N-%03d", ["n_regionkey", "n_nationkey"]).select("n_nationkey", "key", "id")


@query(r"""SELECT page_id, regexp_replace('/u/' || page_id || '/:name/x:y/{a}/7b/0a1b2c3d-0000-1111-2222-33334444555' || page_id % 10 || '/', '.*', '/u/{*}/{*}/x:y/{*}/7b/{*}') AS route FROM pages""")
def q40b_normal_routes(spark, sf_dir):
    path = F.format_string("/u/%d/:name/x:y/{a}/7b/0a1b2c3d-0000-1111-2222-33334444555%d/", F.col("page_id"), F.col("page_id") % 10)
    return table(spark, sf_dir, "pages").select("page_id", normal_route(path).alias("route"))


@query("""SELECT 'stateDiagram-v2' || chr(10) || string_agg('  ' || a || ' --> ' || b, chr(10) ORDER BY a, b) AS diagram FROM (SELECT DISTINCT o_orderstatus AS a, o_orderpriority AS b FROM orders)""")
def q97_state_diagram(spark, sf_dir):
    return states.mermaid_states(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("from_state"), F.col("o_orderpriority").alias("to_state")))


@query("""SELECT 'erDiagram' || chr(10) || string_agg('  ' || upper(n_name) || ' }o--|| ' || upper(r_name) || ' : ' || 'k' || n_nationkey, chr(10) ORDER BY n_name, r_name) AS diagram FROM nation JOIN region ON r_regionkey = n_regionkey""")
def q97b_er_diagram(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return relations.mermaid_er(n.select(F.col("n_name").alias("from_table"), F.col("r_name").alias("to_table"), F.format_string("k%d", "n_nationkey").alias("via")))


@query("""SELECT 'graph LR' || chr(10) || string_agg('  ' || r_name || ' -->|has| ' || n_name, chr(10) ORDER BY r_name, n_name) AS diagram FROM nation JOIN region ON r_regionkey = n_regionkey""")
def q97c_graph_diagram(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return sources.mermaid(n.select(F.col("r_name").alias("source"), F.lit("has").alias("label"), F.col("n_name").alias("target")), ["source", "target"])


_PAGES = "p AS (SELECT DISTINCT p_brand AS feature, 's' || p_size || '.php' AS file FROM part)"


@query(f"""WITH {_PAGES}, f AS (SELECT 'routes' AS kind, 's' || c_nationkey || '.php' AS file, c_mktsegment || c_custkey % 9 AS item, c_custkey AS ord FROM customer UNION ALL SELECT 'sql', 's' || s_nationkey || '.php', 'q' || s_suppkey, s_suppkey FROM supplier),
m AS (SELECT feature, kind, item, min(ord) AS ord FROM f JOIN p USING (file) GROUP BY ALL) SELECT feature, kind, item, place FROM (SELECT *, row_number() OVER (PARTITION BY feature, kind ORDER BY ord, item) AS place FROM m) WHERE place <= CASE kind WHEN 'routes' THEN 5 ELSE 6 END""")
def q98_evidence_by_files(spark, sf_dir):
    pages = table(spark, sf_dir, "part").select(F.col("p_brand").alias("feature"), F.format_string("/x/S%d.php", "p_size").alias("page"))
    routes = table(spark, sf_dir, "customer").select(F.format_string("a/s%d.php", "c_nationkey").alias("file"), F.concat("c_mktsegment", (F.col("c_custkey") % 9).cast("string")).alias("item"), F.col("c_custkey").alias("ord"))
    sql = table(spark, sf_dir, "supplier").select(F.format_string("b/s%d.php", "s_nationkey").alias("file"), F.format_string("q%d", "s_suppkey").alias("item"), F.col("s_suppkey").alias("ord"))
    return evidence.by_files(pages, {"routes": routes, "sql": sql})


@query(f"""WITH {_PAGES}, t AS (SELECT DISTINCT p_brand AS feature, CASE WHEN p_partkey % 5 = 0 THEN 'unknown' ELSE 't' || p_partkey END AS tbl FROM part WHERE p_brand < 'Brand#3'), s AS (SELECT 't' || s_suppkey * 3 AS tbl, 's' || s_nationkey || '.php' AS file, 'q' || s_suppkey AS item FROM supplier),
a AS (SELECT DISTINCT feature, item, 'table' AS how FROM t JOIN s USING (tbl)) SELECT * FROM a UNION ALL SELECT DISTINCT feature, item, 'file' FROM p JOIN s USING (file) WHERE feature NOT IN (SELECT feature FROM a)""")
def q98b_tables_else_files(spark, sf_dir):
    part, s = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    pages = part.select(F.col("p_brand").alias("feature"), F.format_string("/x/S%d.php", "p_size").alias("page"))
    owned = part.where("p_brand < 'Brand#3'").select(F.col("p_brand").alias("feature"), F.when(F.col("p_partkey") % 5 == 0, "UNKNOWN").otherwise(F.format_string("T%d", "p_partkey")).alias("table"))
    sql = s.select(F.format_string("t%d", F.col("s_suppkey") * 3).alias("table"), F.format_string("b/s%d.php", "s_nationkey").alias("file"), F.format_string("q%d", "s_suppkey").alias("item"))
    return evidence.by_tables_else_files(owned, pages, sql)


@query("""SELECT 'parts' AS dimension, count(DISTINCT p_partkey) FILTER (WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)) AS covered, count(DISTINCT p_partkey) AS total, round(count(DISTINCT p_partkey) FILTER (WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)) / count(DISTINCT p_partkey), 4) AS pct FROM part UNION ALL SELECT 'none', 0, 0, 1.0""")
def q98c_domain_coverage(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"))
    hit = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("item"))
    return evidence.domain_coverage({"parts": parts, "none": parts.limit(0)}, {"parts": hit, "none": hit})


@query("""SELECT 'coverage' AS family, c_mktsegment AS item, round(avg((c_acctbal > 1000)::INT), 4) AS value, CASE WHEN round(avg((c_acctbal > 1000)::INT), 4) >= 0.85 THEN 'pass' WHEN round(avg((c_acctbal > 1000)::INT), 4) >= 0.5 THEN 'warn' ELSE 'fail' END AS status FROM customer GROUP BY c_mktsegment
UNION ALL SELECT 'issues', n_nationkey::VARCHAR, count(c_custkey)::DOUBLE, CASE WHEN count(c_custkey) <= 0 THEN 'pass' WHEN count(c_custkey) <= 1 THEN 'warn' ELSE 'fail' END FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal < -500 GROUP BY n_nationkey""")
def q98d_checklist(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    cover = c.groupBy(F.col("c_mktsegment").alias("item")).agg(F.round(F.avg((F.col("c_acctbal") > 1000).cast("double")), 4).alias("value"))
    bad = c.where("c_acctbal < -500").groupBy("c_nationkey").agg(F.count("*").alias("v"))
    issues = n.join(bad, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(F.col("n_nationkey").alias("item"), F.coalesce("v", F.lit(0)).alias("value"))
    return evidence.checklist({"coverage": cover, "issues": issues}, {"coverage": (0.85, 0.5, True), "issues": (0, 1, False)})


@query("""WITH s AS (SELECT o_orderkey AS flow, o_custkey % 40 AS a, o_custkey % 37 AS b FROM orders WHERE o_orderkey % 5 = 0), r AS (SELECT DISTINCT s_nationkey AS f, s_suppkey % 40 AS t FROM supplier) SELECT DISTINCT x.flow, y.flow AS next FROM s x JOIN r ON r.f = x.b JOIN s y ON y.a = r.t WHERE x.flow <> y.flow""")
def q99_stitched_flows(spark, sf_dir):
    name = lambda c, a: F.format_string("p%d", c).alias(a)
    segments = table(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("flow"), name(F.col("o_custkey") % 40, "first"), name(F.col("o_custkey") % 37, "last"))
    redirects = table(spark, sf_dir, "supplier").select(name(F.col("s_nationkey"), "file"), name(F.col("s_suppkey") % 40, "target"))
    return evidence.stitched(segments, redirects)


@query("""WITH v AS (SELECT l_orderkey AS flow, p_brand AS context, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 25 GROUP BY ALL), b AS (SELECT flow, arg_min(context, (-n, context)) AS context FROM v GROUP BY flow) SELECT DISTINCT l_orderkey AS flow, coalesce(context, 'Misc') AS context FROM lineitem LEFT JOIN b ON b.flow = l_orderkey""")
def q99b_flow_contexts(spark, sf_dir):
    steps = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("flow"), F.format_string("a/p%d.php", "l_partkey").alias("page"))
    contexts = table(spark, sf_dir, "part").where("p_size > 25").select(F.format_string("P%d.php", "p_partkey").alias("file"), F.col("p_brand").alias("context"))
    return evidence.grouped_by_context(steps, contexts)


@query("""WITH s AS (SELECT DISTINCT l_orderkey AS flow, l_linenumber AS step, l_partkey AS f FROM lineitem), b AS (SELECT p_partkey AS f, (p_partkey * 7) % 150 AS t FROM part WHERE p_size > 20), m AS (SELECT flow, t, min(step) AS step FROM s JOIN b USING (f) GROUP BY ALL)
SELECT flow, step, 'p' || t || '.php' AS target FROM m WHERE (flow, t) NOT IN (SELECT flow, f FROM s)""")
def q99c_back_filled_branches(spark, sf_dir):
    steps = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("flow"), F.col("l_linenumber").alias("step"), F.format_string("a/p%d.php", "l_partkey").alias("page"))
    branches = table(spark, sf_dir, "part").where("p_size > 20").select(F.format_string("b/p%d.php", "p_partkey").alias("file"), F.format_string("p%d.php", (F.col("p_partkey") * 7) % 150).alias("target"))
    return evidence.back_filled(steps, branches)


@query("""WITH f AS (SELECT DISTINCT l_suppkey AS feature, l_partkey AS page FROM lineitem WHERE l_quantity > 49), m AS (SELECT p_size AS module, p_partkey AS page FROM part WHERE p_size > 40), e AS (SELECT feature, page FROM f UNION SELECT f.feature, n.page FROM f JOIN m USING (page) JOIN m n ON n.module = m.module)
SELECT feature, count(*) AS pages, string_agg(page::VARCHAR, ',' ORDER BY page) AS listed FROM e GROUP BY feature""")
def q99d_enriched_features(spark, sf_dir):
    features = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("feature"), F.col("l_partkey").alias("page"))
    modules = table(spark, sf_dir, "part").where("p_size > 40").select(F.col("p_size").alias("module"), F.col("p_partkey").alias("page"))
    return evidence.enriched(features, modules).select("feature", F.size("pages").cast("long").alias("pages"), F.array_join(F.col("pages").cast("array<string>"), ",").alias("listed"))


@query("""SELECT 'failed flow' AS kind, o_orderkey::VARCHAR AS item, 'high' AS priority FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0 UNION ALL SELECT 'weak feature', p_partkey::VARCHAR, 'high' FROM part WHERE p_size / 50.0 < 0.4 UNION ALL SELECT 'thin evidence', p_partkey::VARCHAR, 'medium' FROM part WHERE p_size / 50.0 >= 0.4 AND p_partkey % 4 < 2
UNION ALL SELECT 'weak rule', s_suppkey::VARCHAR, 'medium' FROM supplier WHERE s_acctbal / 10000 < 0.4 UNION ALL SELECT 'route without flow', n_name, 'low' FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)""")
def q99e_review_items(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    features = t("part").select(F.col("p_partkey").alias("feature"), (F.col("p_size") / 50.0).alias("confidence"), (F.col("p_partkey") % 4).alias("evidence"))
    found = t("supplier").select(F.col("s_suppkey").alias("rule"), (F.col("s_acctbal") / 10000).alias("confidence"))
    hit = t("supplier").select(F.col("s_nationkey").alias("n_nationkey")).distinct().withColumn("hit", F.lit(True))
    routes = t("nation").join(hit, "n_nationkey", "left").select(F.col("n_name").alias("route"), F.coalesce("hit", F.lit(False)).alias("covered"))
    flow = t("orders").select(F.col("o_orderkey").alias("flow"), F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0), "fail").otherwise("pass").alias("status"))
    return mining.review_items(features, found, routes, flow)


@query("""SELECT 'invariant' AS source, 'p' || p_partkey AS subject, 'size ' || p_size AS description, p_size / 50.0 AS confidence FROM part WHERE p_size / 50.0 >= 0.6 UNION ALL SELECT 'flow', c_name, c_name || ' needs a login', 0.75 FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'auth', s_name, s_name || ' is guarded by ' || k, CASE k WHEN 'session_check' THEN 0.85 WHEN 'redirect_guard' THEN 0.8 ELSE 0.72 END FROM (SELECT s_name, ['session_check', 'redirect_guard', 'check'][s_suppkey % 3 + 1] AS k FROM supplier)
UNION ALL SELECT DISTINCT 'state', 'order', 'order may go from ' || o_orderstatus || ' to ' || o_orderpriority, 0.7 FROM orders UNION ALL SELECT 'relation', n_name, n_name || ' refers to ' || r_name, 0.7 FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT 'form', 'f' || p_partkey, p_name || ' of f' || p_partkey || ' is required', 0.65 FROM part WHERE p_size > 30""")
def q99f_spec_rules(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    inv = t("part").select(F.format_string("p%d", "p_partkey").alias("subject"), F.format_string("size %d", "p_size").alias("description"), (F.col("p_size") / 50.0).alias("confidence"))
    flow = t("customer").select(F.col("c_name").alias("name"), (F.col("c_acctbal") > 0).alias("guarded"))
    auth = t("supplier").select(F.col("s_name").alias("file"), F.element_at(F.array(*map(F.lit, ("session_check", "redirect_guard", "check"))), (F.col("s_suppkey") % 3 + 1).cast("int")).alias("kind"))
    moves = t("orders").select(F.lit("order").alias("entity"), F.col("o_orderstatus").alias("from_state"), F.col("o_orderpriority").alias("to_state"))
    rel = t("nation").join(t("region"), F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_name").alias("from_table"), F.col("r_name").alias("to_table"))
    fields = t("part").select(F.format_string("f%d", "p_partkey").alias("form"), F.col("p_name").alias("field"), (F.col("p_size") > 30).alias("required"))
    return mining.spec_rules(inv, flow, auth, moves, rel, fields)


@query("""SELECT 'q' || p_partkey AS path, 'STATE_FILTER' AS category, 'Only t' || p_size || ' with status open are read' AS description, 0.7::DOUBLE AS confidence FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 'q' || p_partkey, 'SOFT_DELETE', 't' || p_size || ' are marked as deleted, not removed', 0.7 FROM part WHERE p_partkey % 3 = 1""")
def q99g_sql_rules(spark, sf_dir):
    k = F.col("p_partkey") % 3
    sql = F.when(k == 0, "SELECT * FROM t WHERE a = 1 AND Status = 'open'").when(k == 1, "UPDATE t SET x = 2, deleted = 1").otherwise("SELECT * FROM t WHERE id = 3")
    rows = table(spark, sf_dir, "part").select(F.format_string("q%d", "p_partkey").alias("path"), F.when(k == 1, "update").otherwise("select").alias("operation"), F.format_string("t%d", "p_size").alias("table"), sql.alias("sql"))
    return mining.sql_rules(rows)


def _hash(text):
    return f"substr(sha256({text}), 1, 16)"


_SCHEMA = "SELECT 'schema' AS kind, substr('[TABLE] t' || n_regionkey || chr(10) || string_agg('c' || n_nationkey || ' int', ', ' ORDER BY n), 1, 1000) AS text FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS n FROM nation) GROUP BY n_regionkey, n // 3"
_ROUTE = "SELECT 'route', '[ROUTE] /p/' || p_partkey || ' in w.php' || chr(10) || 'GET /p/' || p_partkey || ' -> ' || CASE WHEN p_size > 25 THEN 'P@run' ELSE 'w.php' END FROM part"
_FLOW = "SELECT 'flow', substr('[FLOW] ' || l_orderkey || chr(10) || string_agg(l_linenumber || '. p' || l_partkey || ': open', chr(10) ORDER BY l_linenumber, 'p' || l_partkey), 1, 1000) FROM lineitem GROUP BY l_orderkey"
_CALLED = "SELECT 'function', '[FUNCTION] f' || s_suppkey || ' in s' || s_nationkey || '.php' || chr(10) || '($a)' || coalesce(' calls ' || c, '') FROM supplier LEFT JOIN (SELECT l_suppkey, array_to_string(list_sort(list_distinct(list('g' || l_partkey % 30)))[1:8], ', ') AS c FROM lineitem WHERE l_quantity > 47 GROUP BY 1) ON l_suppkey = s_suppkey"
_FORM = "SELECT 'form', '[FORM] 0 in c' || c_custkey || '.php' || chr(10) || 'fields: ' || CASE WHEN c_custkey % 2 = 0 THEN 'page, q; Search form' ELSE 'a, b' END FROM customer"


@query(f"""WITH x(kind, text) AS ({_SCHEMA} UNION ALL {_ROUTE} UNION ALL {_FLOW} UNION ALL {_CALLED} UNION ALL {_FORM}) SELECT {_hash("text")} AS id, min(kind) AS kind, text FROM x GROUP BY text""")
def q100_chunks(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    f = F.format_string
    columns = t("nation").select(f("t%d", "n_regionkey").alias("table"), F.col("n_nationkey").alias("ord"), f("c%d", "n_nationkey").alias("column"), F.lit("int").alias("type"))
    routes = t("part").select(F.lit("get").alias("method"), f("/p/%d", "p_partkey").alias("route"), F.lit("w.php").alias("file"), F.when(F.col("p_size") > 25, "P@run").otherwise("").alias("handler"))
    steps = t("lineitem").select(F.col("l_orderkey").alias("flow"), F.col("l_linenumber").alias("step"), f("p%d", "l_partkey").alias("page"), F.lit("open").alias("action"))
    functions = t("supplier").select(f("f%d", "s_suppkey").alias("name"), f("s%d.php", "s_nationkey").alias("file"), F.lit("$a").alias("params"))
    calls = t("lineitem").where("l_quantity > 47").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(f("f%d", "l_suppkey").alias("caller"), f("s%d.php", "s_nationkey").alias("file"), f("g%d", F.col("l_partkey") % 30).alias("callee"))
    fields = t("customer").select(f("c%d.php", "c_custkey").alias("file"), F.lit(0).alias("form"), F.explode(F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("q"), F.lit("page"))).otherwise(F.array(F.lit("b"), F.lit("a")))).alias("field"))
    return chunks.chunks([chunks.of_schema(columns, 3), chunks.of_routes(routes), chunks.of_flows(steps), chunks.of_functions(functions, calls), chunks.of_forms(fields, extract.form_purpose)])


@query("""WITH e AS (SELECT 'n' || n_nationkey AS a, 'c' || c_custkey AS b FROM nation JOIN customer ON c_nationkey = n_nationkey), x AS (SELECT a AS id, 'out' AS way, b AS other FROM e UNION ALL SELECT b, 'in', a FROM e), d AS (SELECT id, count(*) AS n, count(*) FILTER (WHERE way = 'in') AS i FROM x GROUP BY id HAVING count(*) >= 2),
p AS (SELECT id, CASE WHEN n > 5 THEN CASE way WHEN 'in' THEN 1 ELSE 2 END ELSE 0 END AS part, string_agg(way || ' has ' || other, '; ' ORDER BY way, other) AS text FROM x JOIN d USING (id) GROUP BY 1, 2)
SELECT 'L' || id AS name, part::BIGINT AS part, text FROM p UNION ALL SELECT 'L' || id, 0, n || ' edges, ' || i || ' in, ' || (n - i) || ' out' FROM d WHERE n > 5""")
def q100b_node_chunks(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    edges = c.select(F.format_string("n%d", "c_nationkey").alias("source"), F.format_string("c%d", "c_custkey").alias("target"), F.lit("has").alias("type"))
    ids = edges.select(F.col("source").alias("id")).unionByName(edges.select(F.col("target").alias("id"))).distinct()
    return chunks.of_nodes(ids.withColumn("label", F.concat(F.lit("L"), "id")), edges, 2, 5).select("name", "part", "text")
