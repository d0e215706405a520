"""Facts out of pages, urls, JSON and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import basename, slug
from ..functions.text import or_query
from ..operators import extract
from ..sources.tables import table
from .registry import query


@query("""SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages""")
def q39_anchors(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    return extract.each(pages, r'<a href="([^"]*)"', {"href": 1}, ["page_id"]).select("page_id", "href")


@query("""SELECT lower(t) AS tag, count(*) AS uses, count(DISTINCT page_id) AS pages FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS t FROM pages) GROUP BY 1""")
def q39b_tags(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    return extract.each(pages, r"<([a-zA-Z][a-zA-Z0-9]*)", {"t": 1}, ["page_id"]).groupBy(F.lower("t").alias("tag")).agg(F.count("*").alias("uses"), F.count_distinct("page_id").alias("pages"))


@query("""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/[0-9]+', '/{*}', 'g'), '/+$', '') AS route, lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS host FROM pages""")
def q40_url_normal_form(spark, sf_dir):
    url = F.regexp_replace("url", r"[?#].*$", "")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(F.regexp_replace(url, r"/[0-9]+", "/{*}"), r"/+$", "").alias("route"), F.lower(F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)).alias("host"))


@query("""SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL""")
def q41_nested_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k")).groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query()
def q42_repetition(spark, sf_dir):
    """Documents in which a passage repeats, and where they are cut (no SQL; tested against a plain search)."""
    return extract.without_loops(table(spark, sf_dir, "documents").select("doc_id", "text")).where("cut_at is not null").select("doc_id", "cut_at", F.length("text").alias("kept"))


@query("""SELECT p_partkey, 'part:' || trim(regexp_replace(lower(trim(p_name)), '[^a-z0-9_]', '_', 'g'), '_') AS id FROM part""")
def q43_slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", slug(F.lit("part"), F.col("p_name")).alias("id"))


@query("""SELECT page_id, lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]+)/*$', 1)) AS name FROM pages""")
def q44_basenames(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", basename(F.regexp_replace("url", r"[?#].*$", "")).alias("name"))


@query("""SELECT item_id, array_to_string(list_transform(list_distinct_ordered, lambda t: '"' || t || '"'), ' OR ') AS q FROM (SELECT item_id, list_filter(x, lambda t, i: list_position(x, t) = i)[1:30] AS list_distinct_ordered FROM (SELECT item_id, regexp_extract_all(lower(regexp_replace(text, '([a-z])([A-Z])', '\\1 \\2', 'g')), '([a-z0-9_]{2,})', 1) AS x FROM benchmark))""")
def q45_search_query(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", or_query(F.col("text")).alias("q"))


@query("""SELECT doc_id, len(string_split(text, chr(10))) AS lines, len(list_distinct(string_split(text, chr(10)))) AS distinct_lines FROM documents""")
def q46_line_counts(spark, sf_dir):
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(lines).cast("long").alias("lines"), F.size(F.array_distinct(lines)).cast("long").alias("distinct_lines"))
