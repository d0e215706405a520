"""The domain: roles of actions, flow patterns, transitions, relationships, gates and the knowledge graph of a system."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import basename, slug
from ..functions.text import name_tokens
from .coverage import status as status_of
from .graph import by_directory
from .merge import first_of, in_blocks, strongest
from .relations import SIGNALS, by_column_name, entity_of, pivots, sql_joins
from .rules import assigned, best_pattern, ladder
from .states import noise

#: What tells infrastructure, logins, noise and integrations by names and places.
INFRA_NAME = r"(?i)log|logger|audit|cache|queue|job|event|listener|notification|mail(?!box)|export|import|helper|util|command|console|cron|scheduler|broadcast|observer|seeder|migration|middleware|exception|error|monitor|health|ping|metric|telemetry|backup|cleanup|garbage|fixture|factory|fake"
INFRA_PATH = r"(?i)[/\\](Jobs|Events|Listeners|Notifications|Console|Middleware|Exceptions|Mail|Exports|Imports|Commands|Observers|Seeders|Migrations|Factories|Tests|test)[/\\]"
INFRA_TABLE = r"(?i)^(log_|audit_|cache|jobs|failed_jobs|queue|sessions|password_resets?|telescope_|pulse_|personal_access_tokens?|oauth_|migrations?|nova_|horizon_|sugar_|upgrade_|activity_log|action_events)"
AUTH_PATH = r"(?i)(login|logout|register|signup|sign.?in|sign.?up|forgot.?pass|reset.?pass|password|verify|oauth|token|refresh|auth|sso|saml|ldap)"
NOISE_PATH = r"(?i)^/(health|ping|status|metrics?|monitor|config|version|info|debug|test|_|api-docs?|swagger|telescope|horizon|nova|livewire|sanctum|broadcasting|storage|assets?|css|js|images?|fonts?)"
INTEGRATION = r"(?i)(gateway|client|adapter|connector|provider|driver|webhook|sdk)|(stripe|paypal|braintree|twilio|vonage|nexmo|mailgun|sendgrid|postmark|sparkpost|aws|s3bucket|cloudinary|pusher|firebase|sentry|bugsnag|salesforce|hubspot|zoho|quickbooks|xero|guzzle|httpclient|restclient|soapclient|grpc)"

#: Flow patterns in order of priority: (name, threshold, rules). A rule is a kind and the words of
#: which one must be part of an item; "steps", "input_steps", "auth_steps", "input_count" and "output_count" have a least number; "reads_only" has none.
PATTERNS = (
    ("Login Flow", 3, (("files", "login signin sign_in auth"), ("inputs", "password passwd"), ("inputs", "username email user"), ("methods", "POST"), ("sessions", "user id role logged"), ("outputs", "→ "))),
    ("Registration Flow", 3, (("files", "register signup sign_up create_account newuser new_user"), ("inputs", "email"), ("inputs", "password passwd"), ("db_ops", "insert"), ("methods", "POST"))),
    ("Password Reset Flow", 2, (("files", "reset forgot recover change_password changepass"), ("inputs", "email token code"), ("inputs", "password passwd newpass"), ("db_ops", "update"))),
    ("Checkout Flow", 3, (("files", "cart checkout payment order purchase pay"), ("steps", 3), ("db_ops", "insert"), ("inputs", "total amount price payment card"), ("methods", "POST"))),
    ("Approval Flow", 3, (("files", "approv review reject confirm authoris authorize"), ("inputs", "status decision action"), ("db_ops", "update"), ("auth_steps", 2), ("methods", "POST"))),
    ("CRUD Flow", 3, (("files", "list add edit delete manage index view"), ("db_ops", "insert update delete"), ("db_ops", "select"), ("input_count", 2), ("methods_all", "GET POST"))),
    ("Multi-step Wizard", 3, (("files", "step wizard form page stage"), ("steps", 4), ("input_steps", 3), ("methods", "POST"), ("output_count", 3))),
    ("Search / Filter Flow", 3, (("files", "search filter find list browse results"), ("db_ops", "select"), ("methods", "GET"), ("inputs", "search query q keyword filter"), ("reads_only", ""))),
    ("File Upload Flow", 2, (("files", "upload import attach file document"), ("inputs", "file attachment upload document image"), ("methods", "POST"), ("db_ops", "insert"))),
    ("Report / Export Flow", 2, (("files", "report export download print generate summary"), ("db_ops", "select"), ("methods", "GET"), ("reads_only", ""))),
    ("Logout Flow", 1, (("files", "logout signout sign_out logoff log_out"), ("outputs", "session destroy"))),
)


def action_roles(actions: DataFrame) -> DataFrame:
    """``symbol, role, score, confidence`` of ``symbol, file, method, path, writes, guarded``.

    Signals add and take: infrastructure by folder (-2) and name (-1), noise
    routes (-1), a guard (+2), writes of domain tables (+2) or of infrastructure alone (-2), a
    route of its own (+1), a changing method (+1). A login path and an
    integration decide before the score does; 3 is business, 1 is CRUD.
    """
    path, writes = F.coalesce("path", F.lit("")), F.coalesce("writes", F.array().cast("array<string>"))
    domain = F.size(F.filter(writes, lambda t: ~t.rlike(INFRA_TABLE))) > 0
    name = F.lower(F.concat_ws(" ", "symbol", F.regexp_extract("file", r"([^/\\]+)$", 1)))
    noisy = (path != "") & path.rlike(NOISE_PATH)
    add = lambda c, w: F.when(c, w).otherwise(0)
    score = add(F.col("file").rlike(INFRA_PATH), -2) + add(name.rlike(INFRA_NAME), -1) + add(noisy, -1) + add(F.col("guarded"), 2) + add(domain, 2) + add((F.size(writes) > 0) & ~domain, -2) + add(~noisy & ~path.isin("", "(group)"), 1) + add(F.col("method").rlike("POST|PUT|PATCH|DELETE"), 1)
    rows = actions.where("symbol <> ''").withColumn("score", score)
    login, outside = (path != "") & path.rlike(AUTH_PATH), F.lower(F.concat_ws(" ", "symbol", "file")).rlike(INTEGRATION)
    s = F.col("score")
    role = ladder([(login, "AUTH_ACTION"), (outside, "INTEGRATION"), (s >= 3, "BUSINESS_ACTION"), (s >= 1, "CRUD_ACTION")], "INFRASTRUCTURE")
    sure = ladder([(login, F.lit(0.9)), (outside, F.lit(0.85)), (s >= 3, F.least(F.lit(0.95), 0.7 + s * 0.05)), (s >= 1, F.lit(0.7))], F.least(F.lit(0.9), 0.6 + F.abs(s) * 0.05))
    return rows.select("symbol", role.alias("role"), "score", F.round(sure, 2).alias("confidence"))


def flow_patterns(flows: DataFrame, key: str = "flow") -> DataFrame:
    """``key, pattern, matched``: the pattern with most true rules, of equal ones the first; ``none`` below every threshold.

    ``flows``: arrays ``files, inputs, methods, sessions, outputs, db_ops`` and numbers ``steps, input_steps, auth_steps``.
    """
    def some(col: str, words: str) -> Column:
        parts = [words] if col == "outputs" and words == "→ " else words.split()
        return F.exists(col, lambda x: reduce(lambda a, b: a | b, [F.contains(F.lower(x), F.lit(w.lower())) for w in parts]))

    def rule(kind: str, value) -> Column:
        if kind in ("steps", "input_steps", "auth_steps"):
            return F.col(kind) >= value
        if kind in ("input_count", "output_count"):
            return F.size(kind.removesuffix("_count") + "s") >= value
        if kind == "methods":
            return F.array_contains("methods", value)
        if kind == "methods_all":
            return F.size(F.array_intersect("methods", F.array(*map(F.lit, value.split())))) == len(value.split())
        if kind == "reads_only":
            return ~some("db_ops", "insert update delete")
        return some(kind, value)

    return best_pattern(flows, [key], [(name, least, [rule(*r) for r in some_rules]) for name, least, some_rules in PATTERNS])


def sql_transitions(sql: DataFrame, confidence: float = 0.9) -> DataFrame:
    """``table, field, from_state, to_state, confidence`` of UPDATEs that set a field whose old value their WHERE names."""
    text = F.col("sql")
    pairs = lambda p: F.arrays_zip(F.regexp_extract_all(text, F.lit(p), F.lit(1)).alias("f"), F.regexp_extract_all(text, F.lit(p), F.lit(2)).alias("v"))
    put = r"(?i)SET\s+[`'\"]?(\w+)[`'\"]?\s*=\s*['\"]([^'\"]{2,50})['\"]"
    old = r"(?i)WHERE\s.*?[`'\"]?(\w+)[`'\"]?\s*=\s*['\"]([^'\"]{2,50})['\"]"
    table = F.coalesce(F.nullif(F.lower("table"), F.lit("")), F.lower(F.regexp_extract(text, r"(?i)UPDATE\s+[`'\"]?(\w+)", 1)))
    rows = sql.where(F.contains(F.upper(text), F.lit("UPDATE"))).select(table.alias("table"), F.explode(pairs(put)).alias("a"), pairs(old).alias("w")).select("table", "a", F.explode("w").alias("b"))
    good = (F.lower("a.f") == F.lower("b.f")) & (F.col("a.v") != F.col("b.v")) & ~noise(F.col("a.v")) & ~noise(F.col("b.v"))
    return rows.where(good).select("table", F.lower("a.f").alias("field"), F.col("b.v").alias("from_state"), F.col("a.v").alias("to_state"), F.lit(confidence).alias("confidence")).distinct()


def branch_transitions(branches: DataFrame, confidence: float = 0.75) -> DataFrame:
    """The same of branches (``table, condition, body``): the condition tests a field and the body sets it."""
    test, put = r"->(\w+)\s*===?\s*['\"]([^'\"]{2,50})['\"]", r"->(\w+)\s*=\s*['\"]([^'\"]{2,50})['\"]"
    each = lambda c, p: F.arrays_zip(F.regexp_extract_all(c, F.lit(p), F.lit(1)).alias("f"), F.regexp_extract_all(c, F.lit(p), F.lit(2)).alias("v"))
    rows = branches.select("table", F.explode(each(F.col("condition"), test)).alias("b"), each(F.col("body"), put).alias("s")).select("table", "b", F.explode("s").alias("a"))
    good = (F.lower("a.f") == F.lower("b.f")) & (F.col("a.v") != F.col("b.v")) & ~noise(F.col("a.v")) & ~noise(F.col("b.v"))
    return rows.where(good).select("table", F.lower("a.f").alias("field"), F.col("b.v").alias("from_state"), F.col("a.v").alias("to_state"), F.lit(confidence).alias("confidence")).distinct()


def near_transitions(assignments: DataFrame, lines: int = 40, confidence: float = 0.5) -> DataFrame:
    """The same of assignments (``table, field, file, line, value``) that follow each other within ``lines`` of a file."""
    w = Window.partitionBy("file", "table", "field").orderBy("line", "value")
    rows = assignments.where(~noise(F.col("value"))).withColumn("to_state", F.lead("value").over(w)).withColumn("gap", F.lead("line").over(w) - F.col("line"))
    return rows.where((F.col("gap") <= lines) & (F.col("to_state") != F.col("value"))).select("table", "field", F.col("value").alias("from_state"), "to_state", F.lit(confidence).alias("confidence")).distinct()


def transitions(*parts: DataFrame) -> DataFrame:
    """All transitions, each once with its highest confidence."""
    return reduce(DataFrame.unionByName, parts).groupBy("table", "field", "from_state", "to_state").agg(F.max("confidence").alias("confidence"))


def relationships(keys: DataFrame, columns: DataFrame, models: DataFrame, sql: DataFrame) -> DataFrame:
    """``from_table, to_table, signal, confidence, signals``: five signals, the strongest of each pair of tables with all of them listed.

    ``keys(from_table, to_table)`` are declared; ``columns(table, column)`` tell by name and make pivot tables tie
    their two ends; ``models(table, related)`` are ORM methods; ``sql(sql)`` joins.
    """
    one = lambda df, name: df.select("from_table", "to_table", F.lit(name).alias("signal"), F.lit(SIGNALS[name]).alias("confidence"))
    named = by_column_name(columns, columns).select("from_table", "to_table")
    pivot = pivots(columns).where("is_pivot").select(F.col("table").alias("from_table"))
    through = named.join(pivot, "from_table")
    ends = through.select("from_table", F.col("to_table").alias("a")).join(through.select("from_table", F.col("to_table").alias("b")), "from_table").where("a < b")  # two or three keys a pivot
    parts = [one(keys, "fk_explicit"), one(ends.select(F.col("a").alias("from_table"), F.col("b").alias("to_table")), "pivot"), one(models.select(F.col("table").alias("from_table"), F.col("related").alias("to_table")), "orm"), one(sql_joins(sql).select(F.col("left_table").alias("from_table"), F.col("right_table").alias("to_table")), "sql_join"), one(named, "column_name")]
    rows = reduce(DataFrame.unionByName, parts).distinct().withColumn("signals", F.array("signal")).withColumn("o", F.xxhash64("signal"))
    best = strongest(rows, ["from_table", "to_table"], "confidence", "o", ["signal"], ["signals"])
    return best.select("from_table", "to_table", "signal", "confidence", F.array_join("signals", ",").alias("signals"))


def entity_catalogue(sources: dict[str, DataFrame], columns: DataFrame) -> DataFrame:
    """``entity, tables, sources``: entities of tables that any source (a frame with ``table``) names, pivot tables left out."""
    rows = reduce(DataFrame.unionByName, [df.select(F.lower("table").alias("table"), F.lit(n).alias("source")) for n, df in sources.items()]).distinct()
    left = rows.join(pivots(columns).where("is_pivot").select(F.lower("table").alias("table")), "table", "left_anti")
    return left.groupBy(entity_of(F.col("table")).alias("entity")).agg(F.array_join(F.array_sort(F.collect_set("table")), ",").alias("tables"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


def clusters(files: DataFrame, facts: DataFrame, modules: DataFrame, weights: dict[str, float], threshold: float = 1.5) -> DataFrame:
    """``file, module``: the best module at the threshold, else the folder, of two files or more, else ``Misc``."""
    best = assigned(facts, modules, weights, threshold).select("file", "module")
    rest = by_directory(files.join(best, "file", "left_anti")).select("file", F.col("community").alias("module"))
    return best.unionByName(rest)


def gate(rules: DataFrame, links: Column | float, coverages: list[float], least: float = 0.8) -> DataFrame:
    """``passed, uncited_strong, weakest``: no uncited STRONG rule (``status, cited``), ``links`` 1 or more, and the least coverage at ``least``."""
    weakest = min(coverages)
    out = rules.agg(F.count_if((F.col("status") == "STRONG") & ~F.col("cited")).alias("uncited_strong"), F.avg(links if isinstance(links, Column) else F.lit(links)).alias("links"))
    return out.select(((F.col("uncited_strong") == 0) & (F.col("links") >= 1) & F.lit(weakest >= least)).alias("passed"), "uncited_strong", F.round(F.lit(float(weakest)), 3).alias("weakest"))


def overall(checks: DataFrame) -> DataFrame:
    """``score, grade`` from ``check, status, value``: the mean of values, where there is none of 1, 0.5 and 0 for pass, warn and fail."""
    points = F.coalesce("value", F.when(F.col("status") == "pass", 1.0).when(F.col("status") == "warn", 0.5).otherwise(0.0))
    return checks.agg(F.round(F.avg(points), 3).alias("score"), F.when(F.max((F.col("status") == "fail").cast("int")) == 1, "FAIL").when(F.max((F.col("status") == "warn").cast("int")) == 1, "WARN").otherwise("PASS").alias("grade"))


def inflated(found: DataFrame, stored: DataFrame, key: str, more: float = 0.3) -> DataFrame:
    """``key, confidence, stored, inflated``: if what was stored is above what was found by more than ``more``."""
    return found.select(key, "confidence").join(stored.select(key, F.col("confidence").alias("stored")), key).withColumn("inflated", F.col("stored") - F.col("confidence") > more + 1e-9)


def best_entry(entries: DataFrame, order: tuple = ("http", "cli", "schedule", "queue", "webhook"), key: str = "flow") -> DataFrame:
    """``flow, entry``: the entry type of each flow that comes first in ``order``."""
    rank = ladder([(F.col("type") == t, F.lit(i)) for i, t in enumerate(order)], F.lit(len(order)))
    return entries.groupBy(key).agg(F.min_by("type", F.struct(rank, "type")).alias("entry"))


def status_ladders(values: DataFrame, ladders: dict[str, tuple[float, float]]) -> DataFrame:
    """``name, value, status``: each value by the ladder of its name."""
    out = F.lit(None).cast("string")
    for name, (good, fair) in ladders.items():
        out = F.when(F.col("name") == name, status_of(F.col("value"), good, fair)).otherwise(out)
    return values.select("name", "value", out.alias("status"))


def system_graph(actors: DataFrame, features: DataFrame, entities: DataFrame, flows: DataFrame, steps: DataFrame, tables: DataFrame, sql: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``nodes(id, type, label)`` and ``edges(source, target, type)``: seven kinds of nodes and ten of edges.

    ``actors(name)``, ``features(name, context, description)``, ``entities(name)``, ``flows(name, actor, context)``,
    ``steps(flow, page, db_ops)``, ``tables(name)``, ``sql(file, table)``. Ids are ``kind:label`` in lower case; edges need
    both nodes. Entities and tables are matched by substrings of three characters or more, in blocks.
    """
    c, low = F.col, F.lower
    node = lambda df, kind, col: df.select(slug(F.lit(kind), c(col)).alias("id"), F.lit(kind).alias("type"), c(col).alias("label")).where("label <> ''")
    page = basename("page")
    pages = steps.where("page <> ''").select("flow", page.alias("page")).distinct()
    contexts = features.select("context").unionByName(flows.select("context")).distinct()
    kinds = [node(actors, "actor", "name"), node(contexts, "bounded_context", "context"), node(features, "feature", "name"), node(entities, "entity", "name"), node(flows, "flow", "name"), node(pages.select("page").distinct(), "page", "page"), node(tables, "table", "name")]
    nodes = first_of(reduce(DataFrame.unionByName, [k.withColumn("ord", F.lit(i)) for i, k in enumerate(kinds)]), ["id"], ["ord", "label"]).drop("ord")
    edge = lambda df, a, ca, b, cb, kind: df.select(slug(F.lit(a), ca).alias("source"), slug(F.lit(b), cb).alias("target"), kind.alias("type") if isinstance(kind, Column) else F.lit(kind).alias("type"))
    ops = steps.select("flow", F.explode("db_ops").alias("op")).select("flow", low("op").alias("op")).distinct()
    reads = F.when(F.contains(c("op"), F.lit("select")), "flow_reads").otherwise("flow_writes")
    long = tables.where(F.length("name") >= 3).select(c("name").alias("t")).distinct()
    used = in_blocks(long, lambda some: ops.join(F.broadcast(some), F.contains(c("op"), low("t"))))
    words = lambda df, name: df.select(c("name").alias(name), F.explode(name_tokens(c("name"))).alias("w")).distinct()
    shared = words(features, "feature").join(words(flows, "flow"), "w").select("feature", "flow").distinct()
    same = features.where("context <> ''").select(c("name").alias("feature"), "context").join(flows.select(c("name").alias("flow"), "context"), "context").select("feature", "flow")
    said = features.select(c("name").alias("feature"), low(F.concat_ws(" ", "name", "description")).alias("text"))
    names = entities.where(F.length("name") >= 3).select(c("name").alias("e")).distinct()
    depends = in_blocks(names, lambda some: said.join(F.broadcast(some), F.contains(c("text"), low("e"))))
    stored = in_blocks(names, lambda some: tables.select(c("name").alias("t")).join(F.broadcast(some), F.contains(low("t"), low("e")) | (F.regexp_replace(low("t"), "s+$", "") == low("e"))))
    edges = [
        edge(features.where("context <> ''"), "bounded_context", c("context"), "feature", c("name"), "context_contains"), edge(flows, "actor", c("actor"), "flow", c("name"), "actor_performs"),
        edge(flows, "flow", c("name"), "bounded_context", c("context"), "flow_in_context"), edge(pages, "flow", c("flow"), "page", c("page"), "flow_uses"), edge(used, "flow", c("flow"), "table", c("t"), reads),
        edge(shared.unionByName(same).distinct(), "feature", c("feature"), "flow", c("flow"), "feature_includes"), edge(depends, "feature", c("feature"), "entity", c("e"), "feature_depends_on"),
        edge(stored, "entity", c("e"), "table", c("t"), "entity_stored_in"), edge(sql, "page", basename("file"), "table", c("table"), "page_queries"),
    ]
    ids = nodes.select("id")
    every = reduce(DataFrame.unionByName, edges).distinct()
    return nodes, every.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi").select("source", "target", "type")
