"""Transitions, state machines, keys and relationships."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge, relations, states
from ..sources.tables import table
from .registry import query

_MOVES = "moves AS (SELECT user_id, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_state, event_type AS to_state FROM events)"


@query(f"WITH {_MOVES} SELECT from_state, to_state, count(*) AS times FROM moves WHERE from_state IS NOT NULL GROUP BY ALL")
def q25_transitions(spark, sf_dir):
    moves = states.consecutive(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type")
    return moves.groupBy("from_state", "to_state").agg(F.count("*").alias("times"))


@query(f"""WITH RECURSIVE {_MOVES}, m AS (SELECT DISTINCT from_state, to_state FROM moves WHERE from_state < to_state), s AS (SELECT DISTINCT event_type AS state FROM events),
f AS (SELECT state, state NOT IN (SELECT to_state FROM m) AS initial, state NOT IN (SELECT from_state FROM m) AS terminal FROM s),
r AS (SELECT state FROM f WHERE initial UNION SELECT m.to_state FROM r JOIN m ON m.from_state = r.state)
SELECT state, initial, terminal, state NOT IN (SELECT state FROM r) AS dead FROM f""")
def q26_state_machine(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    moves = states.consecutive(events, ["user_id"], ["ts", "event_id"], "event_type").where("from_state < to_state")
    return states.machine(events.select(F.col("event_type").alias("state")), moves)


@query("""SELECT conv_id, turn, from_state, role AS to_state FROM (SELECT *, lag(role) OVER w AS from_state, turn - lag(turn) OVER w AS gap FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE gap <= 1""")
def q27_consecutive_within_gap(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return states.consecutive(turns, ["conv_id"], ["turn"], "role", "turn", 1).select("conv_id", "turn", "from_state", "to_state")


@query("""SELECT source, count(*) AS n, string_agg(lang, ',' ORDER BY lang) AS states FROM (SELECT DISTINCT source, lang FROM documents WHERE length(lang) >= 2) GROUP BY source HAVING count(*) >= 2""")
def q27b_state_inventory(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "lang").distinct().where(F.length("lang") >= 2)
    return docs.groupBy("source").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("lang")), ",").alias("states")).where("n >= 2")


#: A catalogue of columns as a web schema would name them: table, column.
_COLUMNS = (("orders", "id"), ("orders", "customer_id"), ("orders", "status"), ("customers", "id"), ("customers", "nation_id"), ("nations", "id"), ("nations", "region_id"), ("regions", "id"), ("part_supplier", "part_id"), ("part_supplier", "supplier_id"), ("part_supplier", "created_at"), ("parts", "id"), ("suppliers", "id"), ("boxes", "id"), ("items", "box_id"), ("items", "parent_id"))
_VALUES = ", ".join(f"('{t}', '{c}')" for t, c in _COLUMNS)


@query(f"""WITH c(tbl, col) AS (VALUES {_VALUES}), t AS (SELECT DISTINCT tbl FROM c), s AS (SELECT tbl, col, regexp_extract(col, '^(.+)_id$', 1) AS stem FROM c),
k AS (SELECT tbl, col, unnest([stem, stem || 's', stem || 'es']) AS cand, unnest([0, 1, 2]) AS pri FROM s WHERE stem <> ''),
h AS (SELECT k.*, row_number() OVER (PARTITION BY k.tbl, k.col ORDER BY pri) AS n FROM k JOIN t ON t.tbl = k.cand WHERE k.cand <> k.tbl)
SELECT tbl AS from_table, cand AS to_table, col AS via, 'column_name' AS signal, 0.75::DOUBLE AS confidence FROM h WHERE n = 1""")
def q28_keys_by_name(spark, sf_dir):
    cols = spark.createDataFrame(list(_COLUMNS), "table string, column string")
    return relations.by_column_name(cols, cols)


@query(f"""WITH c(tbl, col) AS (VALUES {_VALUES}) SELECT tbl AS "table", count(*) FILTER (WHERE col LIKE '%\\_id' ESCAPE '\\' OR col LIKE '%\\_key' ESCAPE '\\') AS keys,
count(*) FILTER (WHERE NOT (col LIKE '%\\_id' ESCAPE '\\' OR col LIKE '%\\_key' ESCAPE '\\') AND col NOT IN ('id', 'created_at', 'updated_at', 'deleted_at')) AS others,
count(*) FILTER (WHERE col LIKE '%\\_id' ESCAPE '\\' OR col LIKE '%\\_key' ESCAPE '\\') >= 2 AND count(*) FILTER (WHERE NOT (col LIKE '%\\_id' ESCAPE '\\' OR col LIKE '%\\_key' ESCAPE '\\') AND col NOT IN ('id', 'created_at', 'updated_at', 'deleted_at')) <= 1 AS is_pivot FROM c GROUP BY tbl""")
def q28b_pivots(spark, sf_dir):
    return relations.pivots(spark.createDataFrame(list(_COLUMNS), "table string, column string"))


@query("""SELECT round(count(o.k) / count(*), 4) AS containment, round(count(o.k) / count(*), 4) >= 0.95 AS holds FROM (SELECT DISTINCT o_custkey AS k FROM orders) a LEFT JOIN (SELECT DISTINCT c_custkey AS k FROM customer) o USING (k)""")
def q28c_shared_values(spark, sf_dir):
    return relations.by_shared_values(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")))


@query("""WITH s AS (SELECT o_custkey AS k, o_orderstatus AS signal, CASE o_orderstatus WHEN 'F' THEN 0.9 WHEN 'O' THEN 0.8 ELSE 0.7 END AS confidence, o_orderkey AS ord FROM orders)
SELECT k, arg_max(confidence, (confidence, -ord))::DOUBLE AS confidence, arg_max(ord, (confidence, -ord)) AS ord, string_agg(DISTINCT signal, ',' ORDER BY signal) AS signals FROM s GROUP BY k""")
def q29_strongest_signal(spark, sf_dir):
    status = F.col("o_orderstatus")
    confidence = F.when(status == "F", 0.9).when(status == "O", 0.8).otherwise(0.7)
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.array(status).alias("signals"), confidence.alias("confidence"), F.col("o_orderkey").alias("ord"), F.col("o_orderkey").alias("ord2"))
    out = merge.strongest(rows, ["k"], "confidence", "ord", ["ord2"], ["signals"])
    return out.select("k", "confidence", F.col("ord2").alias("ord"), F.array_join("signals", ",").alias("signals"))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def q29b_last_writer(spark, sf_dir):
    return merge.last_of(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def q29c_first_writer(spark, sf_dir):
    return merge.first_of(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")
