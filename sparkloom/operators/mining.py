"""Business rules out of conditions, branches, authorisation and SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import human
from .rules import ladder

#: Variables that are counters, and values that only route a request.
COUNTERS = r"(?i)^(i|j|k|n|x|y|idx|index|count|cnt|len|length|size|offset|limit|page|row|rows|col|num|total_rows)$"
ROUTING = ("save", "edit", "create", "view", "list", "search", "delete", "detail", "update", "index", "show", "new", "get", "post", "put", "patch", "head", "options", "upload", "download", "module", "action", "subpanel", "return", "export", "import")


def _number(cond: Column, sign: str) -> Column:
    """The number that a variable, no counter, is compared with; null without one."""
    pattern = rf"\$(\w+)\s*{sign}\s*(\d+(?:\.\d+)?)\b"
    number = F.nullif(F.regexp_extract(cond, pattern, 2), F.lit(""))
    return F.when(~F.regexp_extract(cond, pattern, 1).rlike(COUNTERS), number)


def _length(cond: Column, sign: str) -> Column:
    return F.nullif(F.regexp_extract(cond, rf"strlen\s*\(\s*\$\w+\s*\)\s*{sign}\s*(\d+)", 1), F.lit("")).cast("long")


def _value(cond: Column, sign: str, never: tuple) -> Column:
    value = F.regexp_extract(cond, rf"\$\w+(?:->\w+)?\s*{sign}\s*['\"](\w+)['\"]", 1)
    return F.when((F.length(value) >= 3) & ~value.rlike(r"^\d+$") & ~F.lower(value).isin(*never, *ROUTING), value)


def sentence(cond: Column, entity: Column) -> Column:
    """A condition of the source as a sentence on an entity, by the first rule that meets; null if none does.

    A guard ends a request where its condition holds, so ``strlen($x) < 8`` says that eight characters are needed.
    """
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in (entity, *parts)])
    less, less_eq, more, more_eq = (_length(cond, s) for s in ("<(?!=)", "<=", ">(?!=)", ">="))
    n_more, n_more_eq, n_less, n_less_eq = (_number(cond, s) for s in (">(?!=)", ">=", "<(?!=)", "<="))
    text = lambda c: c.cast("string")
    whole = lambda c: F.format_string("%.0f", c.cast("double"))
    filtered = F.nullif(F.regexp_extract(cond, r"(?i)filter_var\s*\([^,]+,\s*FILTER_VALIDATE_(\w+)", 1), F.lit(""))
    pattern = F.nullif(F.regexp_extract(cond, r"preg_match\s*\(\s*['\"]([^'\"]{3,})['\"]", 1), F.lit(""))
    listed = F.slice(F.regexp_extract_all(F.regexp_extract(cond, r"in_array\s*\(\s*\$\w+\s*,\s*(?:array\s*\(|\[)([^\])]+)", 1), F.lit(r"['\"](\w+)['\"]"), F.lit(1)), 1, 6)
    state, other = _value(cond, "===?", ("null", "true", "false")), _value(cond, "!==?", ("null", "true", "false", "deleted"))
    letters = F.regexp_replace(pattern, "^/+|/+$", "").rlike(r"^\^?[\^a-zA-Z\-]+\$?$")
    role = F.nullif(F.regexp_extract(cond, r"\$\w+->(is_admin|is_superuser|admin|type)\b", 1), F.lit(""))
    dated = cond.rlike(r"(?i)strtotime|date\s*\(|mktime|time\s*\(\s*\)") & cond.rlike("[<>]")
    return ladder([
        (less.isNotNull(), say(" must be at least ", text(less), " characters")),
        (less_eq.isNotNull(), F.when(less_eq > 0, say(" must be at least ", text(less_eq + 1), " characters")).otherwise(say(" must not be empty"))),
        (more.isNotNull(), F.when(more == 0, say(" must not be empty")).otherwise(say(" must not exceed ", text(more), " characters"))),
        (more_eq.isNotNull(), F.when(more_eq > 1, say(" must not exceed ", text(more_eq - 1), " characters")).otherwise(say(" must not be empty"))),
        (filtered.isNotNull(), say(" must be a valid ", F.replace(F.lower(filtered), F.lit("_"), F.lit(" ")))),
        (pattern.isNotNull(), F.when(letters, say(" must contain only letters")).when(pattern.rlike(r"\\d|\[0-9\]"), say(" must be numeric")).when(pattern.rlike(r"@.*\\."), say(" must be a valid email address")).otherwise(say(" must match required format"))),
        (F.size(listed) > 0, say(" must be one of: ", F.array_join(F.transform(listed, lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "))),
        (n_more.isNotNull(), say(" must not exceed ", n_more)),
        (n_more_eq.isNotNull(), F.when(n_more_eq.cast("double") > 0, say(" must not exceed ", whole(n_more_eq.cast("double") - 1))).otherwise(say(" must not be negative"))),
        (n_less.isNotNull(), say(" must be at least ", whole(n_less))),
        (n_less_eq.isNotNull(), say(" must be at least ", n_less_eq)),
        (state.isNotNull(), say(" must be in '", state, "' state")),
        (other.isNotNull(), say(" must not be in '", other, "' state")),
        (cond.rlike(r"(?i)\bis_admin\b"), "Only administrators can perform this action"),
        (cond.rlike(r"(?i)\bis_superuser\b"), "Only superusers can perform this action"),
        (cond.rlike(r"(?i)\bhas_permission\b|\bcheck_permission\b|\bACLController\b"), F.concat(F.lit("User must have permission to access "), entity)),
        (role.isNotNull(), F.concat(F.lit("Only users with "), human(role), F.lit(" can perform this action"))),
        (dated, F.when(F.contains(cond, F.lit(">")), say(" must be in the future")).otherwise(say(" must be in the past"))),
    ])


def category(cond: Column) -> Column:
    """What kind of rule a condition is."""
    return ladder([
        (cond.rlike(r"(?i)strlen|filter_var|preg_match|in_array|empty\s*\(|isset\s*\("), "VALIDATION"),
        (cond.rlike(r"(?i)is_admin|is_superuser|permission|ACLController|role"), "AUTHORIZATION"),
        (cond.rlike(r"(?i)strtotime|date\s*\(|mktime|time\s*\("), "TEMPORAL"),
        (cond.rlike(r"[<>]"), "BUSINESS_LIMIT"),
        (cond.rlike(r"[!=]=="), "STATE_TRANSITION"),
    ], "BUSINESS_RULE")


def entity_of_file(path: Column) -> Column:
    """The entity that a file is about, by its name."""
    return human(F.regexp_extract(path, r"([^/]+?)(?:\.\w+)?$", 1))


def guard_branch(body: Column) -> Column:
    """If what a branch does ends the request, sends it elsewhere or reports an error."""
    return F.lower(body).rlike(r"terminate|redirect|\bdie\b|\bexit\b|error")


def branch_rules(branches: DataFrame, confidence: float = 0.8) -> DataFrame:
    """``path, category, description, confidence`` of the guard branches (``path, condition, body``) that make a sentence, each once."""
    cond = F.col("condition")
    rows = branches.where(guard_branch(F.col("body"))).select("path", category(cond).alias("category"), sentence(cond, entity_of_file(F.col("path"))).alias("description"))
    return rows.where("description is not null").distinct().withColumn("confidence", F.lit(confidence))


def sql_rules(sql: DataFrame, confidence: float = 0.7) -> DataFrame:
    """``path, category, description, confidence``: what the WHERE of a statement (``path, operation, table, sql``) and soft deletes say."""
    low = F.lower("sql")
    active = F.regexp_extract(low, r"\bwhere\b.*?\b(status|state|active|enabled|deleted)\s*=\s*['\"]?(\w+)", 1)
    value = F.regexp_extract(low, r"\bwhere\b.*?\b(status|state|active|enabled|deleted)\s*=\s*['\"]?(\w+)", 2)
    soft = (F.upper("operation") == "UPDATE") & low.rlike(r"\bset\b[^;]*\b(deleted|is_deleted)\s*=\s*['\"]?1")
    one = sql.where((F.upper("operation") == "SELECT") & (active != "")).select("path", F.lit("STATE_FILTER").alias("category"), F.concat(F.lit("Only "), "table", F.lit(" with "), active, F.lit(" "), value, F.lit(" are read")).alias("description"))
    two = sql.where(soft).select("path", F.lit("SOFT_DELETE").alias("category"), F.concat(F.col("table"), F.lit(" are marked as deleted, not removed")).alias("description"))
    return one.unionByName(two).distinct().withColumn("confidence", F.lit(confidence))


def spec_rules(invariants: DataFrame, flows: DataFrame, auths: DataFrame, machines: DataFrame, relations: DataFrame, fields: DataFrame, least: float = 0.6) -> DataFrame:
    """``source, subject, description, confidence``: six passes over what is known, one row a rule.

    1 ``invariants(subject, description, confidence)`` at ``least`` or above; 2 ``flows(name, guarded)`` that need
    a login; 3 ``auths(file, kind)``; 4 ``machines(entity, from_state, to_state)``; 5 ``relations(from_table, to_table)``; 6 ``fields(form, field, required)``.
    """
    row = lambda df, source, subject, text, confidence: df.select(F.lit(source).alias("source"), subject.alias("subject"), text.alias("description"), confidence.cast("double").alias("confidence"))
    c, lit = F.col, F.lit
    kind = ladder([(c("kind") == "session_check", lit(0.85)), (c("kind") == "redirect_guard", lit(0.8))], lit(0.72))
    parts = [
        row(invariants.where(c("confidence") >= least), "invariant", c("subject"), c("description"), c("confidence")),
        row(flows.where("guarded"), "flow", c("name"), F.concat(c("name"), lit(" needs a login")), lit(0.75)),
        row(auths, "auth", c("file"), F.concat(c("file"), lit(" is guarded by "), c("kind")), kind),
        row(machines, "state", c("entity"), F.concat(c("entity"), lit(" may go from "), c("from_state"), lit(" to "), c("to_state")), lit(0.7)),
        row(relations, "relation", c("from_table"), F.concat(c("from_table"), lit(" refers to "), c("to_table")), lit(0.7)),
        row(fields.where("required"), "form", c("form"), F.concat(c("field"), lit(" of "), c("form"), lit(" is required")), lit(0.65)),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def review_items(features: DataFrame, rules: DataFrame, routes: DataFrame, flows: DataFrame, low: float = 0.4, evidence: int = 2) -> DataFrame:
    """``kind, item, priority``: what a person should look at, most urgent first.

    Features and rules below ``low``, features with less than ``evidence`` pieces, routes without a flow, and flows whose check failed.
    """
    row = lambda df, kind, item, priority: df.select(F.lit(kind).alias("kind"), item.cast("string").alias("item"), F.lit(priority).alias("priority"))
    parts = [
        row(flows.where("status = 'fail'"), "failed flow", F.col("flow"), "high"),
        row(features.where(F.col("confidence") < low), "weak feature", F.col("feature"), "high"),
        row(features.where((F.col("confidence") >= low) & (F.col("evidence") < evidence)), "thin evidence", F.col("feature"), "medium"),
        row(rules.where(F.col("confidence") < low), "weak rule", F.col("rule"), "medium"),
        row(routes.where("not covered"), "route without flow", F.col("route"), "low"),
    ]
    return reduce(DataFrame.unionByName, parts)


def by_severity(findings: DataFrame, names: tuple = ("critical", "major", "minor"), col: str = "severity", order: tuple = ()) -> DataFrame:
    """Findings with ``place``, their place from the weightiest to the lightest; other names come last."""
    rank = ladder([(F.col(col) == n, F.lit(i)) for i, n in enumerate(names)], F.lit(len(names)))
    return findings.withColumn("place", F.row_number().over(Window.orderBy(rank, *order)).cast("long"))


def relevant_first(items: DataFrame, relevant: Column, within: list[str], order: str) -> DataFrame:
    """Items with ``place`` in their group: the relevant ones first, each part in its old order."""
    return items.withColumn("place", F.row_number().over(Window.partitionBy(*within).orderBy(F.coalesce(relevant, F.lit(False)).desc(), order)).cast("long"))


def inverted(items: DataFrame, key: str, id_: str, values: str) -> DataFrame:
    """Inverted index: ``value, ids`` (sorted, each once) from rows with an array of values."""
    each = items.select(F.col(id_).alias("id"), F.explode(values).alias(key)).distinct()
    return each.groupBy(key).agg(F.array_sort(F.collect_list("id")).alias("ids"))


def halved(items: DataFrame, size: str, order: str, budget: int, within: list[str]) -> DataFrame:
    """``batch`` of each item: a group is cut in the middle, by number of items, until each part's size fits the budget or is one item.

    A part is named by the way to it, so parts of a group sort in their order. Levels are passes over all groups at once.
    """
    place = F.row_number().over(Window.partitionBy(*within).orderBy(order)) - 1
    rows = items.withColumn("__at", place).withColumn("batch", F.lit("")).withColumn("__open", F.lit(True))
    most = items.groupBy(*within).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    own = Window.partitionBy(*within, "batch")
    for _ in range(max(0, most - 1).bit_length()):
        n, first = F.count("*").over(own), F.min("__at").over(own)
        rows = rows.withColumn("__open", (F.sum(size).over(own) > budget) & (n > 1)).withColumn("__half", F.when(F.col("__at") - first < F.floor(n / 2), "0").otherwise("1"))
        rows = rows.withColumn("batch", F.when(F.col("__open"), F.concat("batch", "__half")).otherwise(F.col("batch"))).drop("__half")
    return rows.drop("__at", "__open")
