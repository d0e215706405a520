"""Facts from source text: one row a file in, one row a fact out.

Patterns are data: a table of (kind, expression) is applied with built-in
expression functions. What regular expressions cannot say (balanced braces,
sequence similarity, repeated windows) is in pandas functions below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Extensions by language, with the most files that count for it.
LANGUAGES = (("php", ("php",), 20), ("typescript", ("ts", "tsx"), 20), ("javascript", ("js", "jsx"), 10), ("java", ("java",), 20), ("kotlin", ("kt",), 20))
#: Files at the root that each add three votes, and folders that are not counted.
MANIFESTS = (
    ("php", ("composer.json", "artisan", "bin/console", "wp-config.php", "system/core/CodeIgniter.php")),
    ("typescript", ("tsconfig.json", "tsconfig.base.json", "tsconfig.app.json")),
    ("java", ("pom.xml", "build.gradle", "build.gradle.kts", "gradlew")),
)
SKIPPED = ("vendor", "node_modules", ".git", "dist", "build", "target")
#: Signs of a framework by family of languages, in order; after the colon what the file must hold.
FRAMEWORKS = (
    ("php", (("artisan", "laravel"), ("composer.json:laravel/framework", "laravel"), ("bin/console", "symfony"), ("composer.json:symfony/framework-bundle", "symfony"), ("wp-config.php", "wordpress"), ("wp-config-sample.php", "wordpress"), ("system/core/CodeIgniter.php", "codeigniter"), ("application/config/config.php", "codeigniter"))),
    ("typescript", (("next.config.js", "nextjs"), ("next.config.mjs", "nextjs"), ("next.config.ts", "nextjs"), ("nuxt.config.ts", "nuxtjs"), ("nuxt.config.js", "nuxtjs"), ("vite.config.ts", "vue"), ("vue.config.js", "vue"), ("package.json:nuxt", "nuxtjs"), ("package.json:next", "nextjs"), ("package.json:@nestjs/core", "nestjs"), ("package.json:fastify", "fastify"), ("package.json:express", "express"), ("package.json:vue", "vue"), ("package.json:react", "react"))),
    ("java", (("pom.xml:spring-boot", "spring-boot"), ("build.gradle:spring-boot", "spring-boot"), ("pom.xml:quarkus", "quarkus"), ("build.gradle:quarkus", "quarkus"), ("pom.xml:micronaut", "micronaut"), ("build.gradle:micronaut", "micronaut"))),
)
#: Verbs of a resource route; an API resource has no create and edit.
RESOURCE = (("index", "GET", ""), ("store", "POST", ""), ("create", "GET", "/create"), ("show", "GET", "/{id}"), ("update", "PUT", "/{id}"), ("update", "PATCH", "/{id}"), ("destroy", "DELETE", "/{id}"), ("edit", "GET", "/{id}/edit"))


def each(files: DataFrame, pattern: str, groups: dict[str, int], keep: list[str] = ("path",)) -> DataFrame:
    """One row for each match of a pattern, with its groups as columns."""
    found = {n: F.regexp_extract_all("text", F.lit(pattern), F.lit(g)) for n, g in groups.items()}
    rows = files.where(F.col("text").rlike(pattern)).select(*keep, F.posexplode(F.arrays_zip(*[c.alias(n) for n, c in found.items()])).alias("ord", "m"))
    return rows.select(*keep, "ord", *[F.col(f"m.{n}").alias(n) for n in groups])


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def language(files: DataFrame) -> DataFrame:
    """One row ``language, votes``: the language with most votes, ``unknown`` without any.

    A manifest at the root gives three votes (package.json two for JavaScript, none
    where there is a TypeScript manifest), files by extension up to a most for each language, Vue files
    up to ten for TypeScript, or JavaScript if it has more. Ties go to the first listed.
    """
    some = files.where(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, SKIPPED)))).select("path", extension(F.col("path")).alias("ext"))
    files = files.select("path", F.lit("").alias("ext"))
    n = {name: F.least(F.count_if(F.col("kind").eqNullSafe("file") & F.col("ext").isin(*exts)), F.lit(most)) for name, exts, most in LANGUAGES}
    for name, signs in MANIFESTS:
        n[name] = n[name] + 3 * F.count_distinct(F.when((F.col("kind") == "root") & F.col("path").isin(*signs), F.col("path")))
    node = 2 * F.max(F.when((F.col("kind") == "root") & (F.col("path") == "package.json"), 1).otherwise(0))
    typed = F.max(F.when((F.col("kind") == "root") & F.col("path").isin(*dict(MANIFESTS)["typescript"]), 1).otherwise(0))
    n["javascript"] = n["javascript"] + F.when(typed > 0, 0).otherwise(node)
    vue = F.least(F.count_if((F.col("kind") == "file") & (F.col("ext") == "vue")), F.lit(10))
    counted = files.withColumn("kind", F.lit("root")).unionByName(some.withColumn("kind", F.lit("file"))).agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(k) for k, c in n.items()], F.coalesce(vue, F.lit(0)).cast("long").alias("vue"))
    ts = F.col("typescript") >= F.col("javascript")
    votes = {name: F.col(name) for name, _, _ in LANGUAGES} | {"typescript": F.col("typescript") + F.when(ts, F.col("vue")).otherwise(0), "javascript": F.col("javascript") + F.when(~ts, F.col("vue")).otherwise(0)}
    best = F.greatest(*votes.values())
    out = F.lit("unknown")
    for name in reversed(list(votes)):
        out = F.when((votes[name] == best) & (best > 0), name).otherwise(out)
    return counted.select(out.alias("language"), best.alias("votes"))


def framework(files: DataFrame, language: str = "php") -> DataFrame:
    """One row ``framework``: the first sign in order, a file that is there or one that holds a text; PHP without a sign is ``raw_php``, others ``unknown``."""
    family = {"javascript": "typescript", "kotlin": "java"}.get(language, language)
    signs = dict(FRAMEWORKS).get(family, ())
    rules = files.sparkSession.createDataFrame([(i, *f"{sign}:".split(":")[:2], name) for i, (sign, name) in enumerate(signs)], "priority int, path string, holds string, framework string")
    hit = files.select("path", "text").join(F.broadcast(rules), "path").where(F.contains(F.lower("text"), F.lower("holds")))
    return hit.agg(F.coalesce(F.min_by("framework", "priority"), F.lit("raw_php" if family == "php" else "unknown")).alias("framework"))


def by_adapter(files: DataFrame) -> DataFrame:
    """``path, adapter``: which family of extractors reads a file; none for others."""
    ext = extension(F.col("path"))
    out = None
    for name, exts, _ in LANGUAGES:
        out = F.when(ext.isin(*exts), name) if out is None else out.when(ext.isin(*exts), name)
    return files.select("path", out.alias("adapter")).where("adapter is not null")


def classes(files: DataFrame) -> DataFrame:
    return each(files, r"(?m)^\s*(?:export\s+)?(?:default\s+)?(?:public\s+)?(?:abstract\s+|final\s+)*(class|interface|trait|enum)\s+([A-Za-z_]\w*)(?:\s+extends\s+([\w\\]+))?", {"kind": 1, "name": 2, "parent": 3})


def class_role(name: Column, parent: Column) -> Column:
    """Role of a class by its suffix, then by what it extends."""
    out = None
    for role in ("Controller", "Middleware", "Request", "Resource", "Repository", "Service", "Job", "Event", "Listener", "Policy", "Observer", "Command", "Mail", "Notification", "Seeder", "Factory"):
        out = F.when(name.endswith(role), role.lower()) if out is None else out.when(name.endswith(role), role.lower())
    return out.when(parent.rlike("Model$"), "model").when(parent.rlike("Controller$"), "controller").otherwise("class")


def functions(files: DataFrame) -> DataFrame:
    return each(files, r"\bfunction\s+&?([A-Za-z_]\w*)\s*\(([^)]*)\)(?:\s*:\s*\??([\w\\|]+))?", {"name": 1, "params": 2, "return_type": 3})


def imports(files: DataFrame) -> DataFrame:
    php = each(files, r"\b(?:require|include)(?:_once)?\s*\(?\s*['\"]([^'\"]+)['\"]", {"target": 1})
    js = each(files, r"\bimport\s+(?:[^'\";]*?\s+from\s+)?['\"]([^'\"]+)['\"]", {"target": 1})
    return php.unionByName(js).distinct()


def env_vars(files: DataFrame) -> DataFrame:
    a = each(files, r"\b(?:env|getenv)\(\s*['\"]([A-Z_][A-Z0-9_]*)['\"]", {"name": 1})
    return a.unionByName(each(files, r"process\.env\.([A-Z_][A-Z0-9_]*)", {"name": 1})).select("path", "name").distinct()


def routes(files: DataFrame) -> DataFrame:
    """``path, method, route, handler`` of verb calls (``Route::get``, ``app.get``) and annotations (``@GetMapping``, ``@Get``)."""
    calls = each(files, r"(?:Route::|\b(?:app|router)\.)(get|post|put|patch|delete|any)\(\s*['\"]([^'\"]*)['\"]\s*,?\s*(?:\[?\s*([\w\\]+)::class\s*,\s*['\"](\w+)['\"]|['\"]([^'\"]+)['\"])?", {"verb": 1, "route": 2, "cls": 3, "fn": 4, "text_handler": 5})
    named = F.when(F.col("cls") != "", F.concat_ws("@", "cls", "fn")).otherwise(F.col("text_handler"))
    notes = each(files, r"@(Get|Post|Put|Patch|Delete)(?:Mapping)?\(\s*(?:value\s*=\s*|path\s*=\s*)?['\"]?([^'\")]*)['\"]?\s*\)", {"verb": 1, "route": 2})
    out = calls.select("path", F.upper("verb").alias("method"), "route", named.alias("handler"))
    return out.unionByName(notes.select("path", F.upper("verb").alias("method"), "route", F.lit("").alias("handler")))


def resource_routes(files: DataFrame) -> DataFrame:
    """Resource routes expanded into their verbs (7, or 5 without forms for an API), less ``except`` and others than ``only``."""
    found = each(files, r"Route::(resource|apiResource)\(\s*['\"]([^'\"]+)['\"]\s*,\s*\\?([\w\\]+)::class\s*\)((?:->\w+\([^)]*\))*)", {"kind": 1, "name": 2, "controller": 3, "tail": 4})
    verbs = F.array(*[F.struct(F.lit(a).alias("action"), F.lit(m).alias("method"), F.lit(s).alias("suffix")) for a, m, s in RESOURCE])
    rows = found.withColumn("v", F.explode(verbs))
    only, less = F.regexp_extract("tail", r"->only\(([^)]*)\)", 1), F.regexp_extract("tail", r"->except\(([^)]*)\)", 1)
    quoted = F.concat(F.lit("'"), F.col("v.action"), F.lit("'"))
    kept = ((only == "") | F.contains(F.replace(only, F.lit('"'), F.lit("'")), quoted)) & ~F.contains(F.replace(less, F.lit('"'), F.lit("'")), quoted) & ((F.col("kind") == "resource") | ~F.col("v.action").isin("create", "edit"))
    return rows.where(kept).select("path", F.col("v.method").alias("method"), F.concat(F.lit("/"), "name", "v.suffix").alias("route"), F.concat("controller", F.lit("@"), "v.action").alias("handler"))


def file_routes(files: DataFrame) -> DataFrame:
    """Routes that a file's place tells: ``app/**/page.tsx`` is a page, ``route.ts`` one route for each exported verb (ANY without one), ``[id]`` is ``:id``."""
    part = F.regexp_extract("path", r"(?:^|/)(?:app|pages)/(.*)$", 1)
    name = F.regexp_extract("path", r"([^/]+)\.(?:tsx|ts|jsx|js)$", 1)
    folder = F.regexp_replace(F.regexp_replace(part, r"(^|/)[^/]+$", ""), r"(^|/)\([^)]*\)", "")
    route = F.concat(F.lit("/"), F.regexp_replace(folder, r"\[(?:\.\.\.)?([^\]]+)\]", ":$1"))
    verbs = F.regexp_extract_all("text", F.lit(r"export\s+(?:async\s+)?(?:function|const)\s+(GET|POST|PUT|PATCH|DELETE)\b"), F.lit(1))
    methods = F.when(name == "page", F.array(F.lit("GET"))).when(name == "route", F.when(F.size(verbs) > 0, verbs).otherwise(F.array(F.lit("ANY"))))
    return files.where((part != "") & name.isin("page", "route")).select("path", F.explode(methods).alias("method"), route.alias("route"), F.when(name == "page", "page").otherwise("api").alias("kind"))


def sql_operation(sql: Column) -> Column:
    return F.coalesce(F.nullif(F.upper(F.regexp_extract(sql, r"(?i)\b(SELECT|INSERT|UPDATE|DELETE|REPLACE|CREATE|ALTER|DROP|TRUNCATE)\b", 1)), F.lit("")), F.lit("UNKNOWN"))


def sql_table(sql: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(sql, r"(?i)\b(?:FROM|INTO|UPDATE|JOIN|TABLE(?:\s+IF\s+(?:NOT\s+)?EXISTS)?)\s+[`\"\[]?([A-Za-z_]\w*)", 1), F.lit("")), F.lit("UNKNOWN"))


def sql_facts(files: DataFrame, preview: int = 200) -> DataFrame:
    """``path, operation, table, sql`` of quoted strings that read like SQL (a second keyword is wanted)."""
    found = each(files, r"(?is)[\"'`]\s*((?:SELECT\b[^\"'`]*?\bFROM\b|INSERT\s+INTO\b|UPDATE\b[^\"'`]*?\bSET\b|DELETE\s+FROM\b|CREATE\s+TABLE\b)[^\"'`]*)[\"'`]", {"sql": 1})
    return found.select("path", sql_operation(F.col("sql")).alias("operation"), F.lower(sql_table(F.col("sql"))).alias("table"), F.substring("sql", 1, preview).alias("sql"))


def migration_columns(files: DataFrame) -> DataFrame:
    """``path, table, column, type, nullable, unique, default, refers`` of schema builder calls; ``refers`` is the table of a foreign key."""
    tables = each(files, r"(?s)Schema::(?:create|table)\(\s*['\"](\w+)['\"](.*?)\}\s*\)\s*;", {"table": 1, "text": 2})
    cols = each(tables, r"\$table->(\w+)\(\s*['\"](\w+)['\"][^)]*\)((?:->\w+\([^)]*\))*)", {"type": 1, "column": 2, "tail": 3}, ["path", "table"])
    return cols.select("path", "table", "column", "type", F.contains("tail", F.lit("nullable")).alias("nullable"), F.contains("tail", F.lit("unique")).alias("unique"), F.regexp_extract("tail", r"->default\(\s*['\"]?([^'\")]*)", 1).alias("default"), F.regexp_extract("tail", r"->(?:constrained|on)\(\s*['\"](\w+)", 1).alias("refers"))


def create_table_columns(sql: DataFrame, text: str = "sql") -> DataFrame:
    """Columns of CREATE TABLE statements; commas within parentheses do not part them."""
    body = F.regexp_extract(text, r"(?is)CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?[`\"]?(\w+)[`\"]?\s*\((.*)\)", 2)
    name = F.lower(F.regexp_extract(text, r"(?is)CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?[`\"]?(\w+)", 1))
    parts = F.split(body, r",(?![^()]*\))")
    rows = sql.where(body != "").select(name.alias("table"), F.posexplode(parts).alias("ord", "part"))
    first = F.lower(F.regexp_extract("part", r"^\s*[`\"]?(\w+)", 1))
    return rows.where((first != "") & ~first.isin("primary", "foreign", "unique", "key", "constraint", "index", "check")).select("table", "ord", first.alias("column"), F.lower(F.regexp_extract("part", r"^\s*[`\"]?\w+[`\"]?\s+(\w+(?:\([^)]*\))?)", 1)).alias("type"), (~F.col("part").rlike(r"(?i)NOT\s+NULL|PRIMARY\s+KEY")).alias("nullable"), F.regexp_extract("part", r"(?i)DEFAULT\s+('[^']*'|\S+)", 1).alias("default"))


def prisma_columns(files: DataFrame) -> DataFrame:
    models = each(files, r"(?s)model\s+(\w+)\s*\{(.*?)\}", {"table": 1, "text": 2})
    return each(models, r"(?m)^\s*(\w+)\s+(\w+)(\[\]|\?)?(.*)$", {"column": 1, "type": 2, "mark": 3, "rest": 4}, ["path", "table"]).select("path", "table", "column", "type", (F.col("mark") == "?").alias("nullable"), F.col("rest").rlike("@(unique|id)").alias("unique"))


def form_fields(files: DataFrame) -> DataFrame:
    """``path, form, action, method, field, type`` of inputs in ``<form>`` blocks, equal forms of a file once."""
    forms = each(files, r"(?is)(<form\b[^>]*>)(.*?)</form>", {"open": 1, "text": 2}).dropDuplicates(["path", "open", "text"])
    named = forms.select("path", F.col("ord").alias("form"), F.regexp_extract("open", r"(?i)action\s*=\s*[\"']([^\"']*)", 1).alias("action"), F.upper(F.coalesce(F.nullif(F.regexp_extract("open", r"(?i)method\s*=\s*[\"']([^\"']*)", 1), F.lit("")), F.lit("GET"))).alias("method"), "text")
    tags = each(named, r"(?is)<((?:input|select|textarea)\b[^>]*)>", {"tag": 1}, ["path", "form", "action", "method"])
    return tags.select("path", "form", "action", "method", F.regexp_extract("tag", r"(?i)\bname\s*=\s*[\"']([^\"']*)", 1).alias("field"), F.coalesce(F.nullif(F.lower(F.regexp_extract("tag", r"(?i)\btype\s*=\s*[\"']([^\"']*)", 1)), F.lit("")), F.lower(F.regexp_extract("tag", r"^(\w+)", 1))).alias("type")).where("field <> ''")


#: Purposes of a form by its field names, in order.
LOGIN, PERSONAL = ("uname", "username", "email", "password", "pwd", "passwd"), ("fname", "lname", "phone", "dob", "gender")
PURPOSES = (
    (("cc", "dc", "doi", "dor", "carid", "distance"), "Car rental booking form — collects booking dates, car selection, and charges"),
    (("card", "cvv", "expiry", "payment", "amount"), "Payment form — processes financial transaction"),
    (("search", "query", "keyword", "q"), "Search form"),
    (("address", "city", "state", "country", "zip", "postal"), "Address / shipping details form"),
)


def form_purpose(fields: Column) -> Column:
    """Purpose of a form by its field names, the first rule that meets; empty if none does."""
    low = F.transform(fields, lambda f: F.lower(f))
    meets = lambda names: F.arrays_overlap(low, F.array(*map(F.lit, names)))
    out = F.when(meets(LOGIN) & meets(PERSONAL), "User registration form — collects personal details and creates an account").when(meets(LOGIN), "User login form — authenticates an existing user")
    for names, purpose in PURPOSES:
        out = out.when(meets(names), purpose)
    return out.otherwise("")


def endpoint_kind(signals: Column) -> Column:
    """Kind of an endpoint by its signals."""
    has = lambda *names: F.arrays_overlap(signals, F.array(*map(F.lit, names)))
    return F.when(has("json_encode", "json_response"), "api").when(has("file_download", "readfile"), "download").when(has("redirect"), "action").when(has("form", "render"), "page").otherwise("script")


def calls(files: DataFrame, builtins: DataFrame) -> DataFrame:
    """``path, callee`` of calls that are no builtins, each once."""
    found = each(files, r"(?<![>:\w$])([A-Za-z_]\w*)\s*\(", {"callee": 1}).select("path", "callee").distinct()
    return found.join(F.broadcast(builtins.select(F.col("name").alias("callee"))), "callee", "left_anti")


def call_graph(files: DataFrame, builtins: DataFrame, top: str = "GLOBAL_SCRIPT") -> DataFrame:
    """``path, caller, callee`` of calls that are no builtins, each once; the caller is the last function that began before, ``top`` without one."""
    from pyspark.sql import Window

    found = each(files, r"\bfunction\s+&?([A-Za-z_]\w*)\s*\(|(?<![>:\w$])([A-Za-z_]\w*)\s*\(", {"name": 1, "callee": 2})
    before = Window.partitionBy("path").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    rows = found.withColumn("caller", F.coalesce(F.last(F.nullif("name", F.lit("")), True).over(before), F.lit(top))).where("callee <> ''").select("path", "caller", "callee").distinct()
    return rows.join(F.broadcast(builtins.select(F.col("name").alias("callee"))), "callee", "left_anti").select("path", "caller", "callee")


def cron_lines(files: DataFrame) -> DataFrame:
    """``path, schedule, command`` of the lines of cron files, comments and settings left out."""
    some = files.where(F.col("path").rlike(r"(^|/)(crontab|cron\.d/[^/]+|[^/]+\.cron)$"))
    return each(some, r"(?m)^\s*((?:@\w+|(?:[-\d*,/]+\s+){4}[-\d*,/]+))\s+(\S.*?)\s*$", {"schedule": 1, "command": 2}).select("path", "schedule", "command")


#: Patterns that tell an entry point: (type, expression of the trigger, confidence).
ENTRY_POINTS = (
    ("schedule", r"->(?:command|job|call)\(([^)]*)\)\s*->\s*(?:daily|hourly|weekly|monthly|cron|every\w+)", 1.0),
    ("cli", r"protected\s+\$signature\s*=\s*['\"]([^'\"]+)['\"]", 1.0),
    ("webhook", r"['\"]([^'\"]*webhook[^'\"]*)['\"]", 0.8),
    ("queue", r"implements\s+(ShouldQueue)", 0.8),
    ("schedule", r"@Scheduled\(([^)]*)\)", 1.0),
    ("queue", r"@(?:KafkaListener|RabbitListener)\(([^)]*)\)", 1.0),
)


def entry_points(files: DataFrame) -> DataFrame:
    out = None
    for kind, pattern, confidence in ENTRY_POINTS:
        one = each(files, pattern, {"trigger": 1}).select("path", F.lit(kind).alias("kind"), "trigger", F.lit(confidence).alias("confidence"))
        out = one if out is None else out.unionByName(one)
    return out


def components(files: DataFrame) -> DataFrame:
    """``path, name, children, hooks, is_page`` of Vue and React files."""
    some = files.where(extension(F.col("path")).isin("vue", "tsx", "jsx"))
    children = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(r"<([A-Z]\w+)"), F.lit(1))))
    hooks = F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\b(use[A-Z]\w*)\("), F.lit(1))))
    return some.select("path", F.regexp_extract("path", r"([^/]+)\.\w+$", 1).alias("name"), children.alias("children"), hooks.alias("hooks"), F.col("path").rlike(r"(^|/)(pages|views|app)/").alias("is_page"))


def resolved_children(found: DataFrame) -> DataFrame:
    """``path, child, files``: where each child component is defined; several files of one name stay."""
    uses = found.select("path", F.explode("children").alias("child"))
    return uses.join(found.select(F.col("name").alias("child"), F.col("path").alias("file")), "child").groupBy("path", "child").agg(F.array_sort(F.collect_set("file")).alias("files"))


def markdown_blocks(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep, ord, kind, text``: heading, list, table, code, paragraph lines; what is between fences is code."""
    lines = docs.select(*keep, F.posexplode(F.split("text", "\n")).alias("ord", "line"))
    from pyspark.sql import Window

    w = Window.partitionBy(*keep).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    fence = F.col("line").rlike(r"^\s*```")
    inside = (F.sum(fence.cast("int")).over(w) % 2 == 1) | fence
    kind = F.when(inside, "code").when(F.col("line").rlike(r"^#{1,6}\s"), "heading").when(F.col("line").rlike(r"^\s*\|.*\|\s*$"), "table").when(F.col("line").rlike(r"^\s*([-*+]|[0-9]+\.)\s"), "list").when(F.trim("line") == "", "blank").otherwise("paragraph")
    return lines.select(*keep, "ord", kind.alias("kind"), F.col("line").alias("text"))


def _loops(text: str, json_like: bool, widths=(150, 200, 300, 400), least: int = 3) -> int:
    """Where a passage that occurs ``least`` times begins again; -1 if none does.

    Passages begin at every half width. A passage counts if it occurs ``least`` times from its place on
    without overlaps; the cut is where it begins next, even if that overlaps it. All places of
    a width are hashed at once, so that the work grows with the text.
    """
    import numpy as np

    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(points)
    if n < least * min(w for w in widths if w >= 300 or not json_like):
        return -1
    base = 0x9E3779B97F4A7C13
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
        inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F) * power[:n])])
        for width in widths:
            if json_like and width < 300 or n < width * least:
                continue
            here = (sums[width:] - sums[:-width]) * inverse[: n - width + 1]
            grid = here[:: width // 2]
            place = np.flatnonzero(np.isin(here, grid))
            order = np.argsort(here[place], kind="stable")
            place, value = place[order], here[place][order]
            for i, h in enumerate(grid.tolist()):
                at = i * (width // 2)
                lo, hi = np.searchsorted(value, np.uint64(h), "left"), np.searchsorted(value, np.uint64(h), "right")
                later = place[lo:hi][np.searchsorted(place[lo:hi], at) :]
                if len(later) < least:
                    continue
                count, free = 0, at
                while count < least and (k := int(np.searchsorted(later, free))) < len(later):
                    count, free = count + 1, int(later[k]) + width
                if count == least and text[at : at + width] == text[(cut := int(later[1])) : cut + width]:
                    return cut
    return -1


def without_loops(docs: DataFrame, text: str = "text") -> DataFrame:
    """Texts cut where a passage begins to repeat, without white space at their end; ``cut_at`` is null where none does."""

    @F.pandas_udf("int")
    def cut(texts):
        import pandas as pd

        return pd.Series([(_loops(t, t.lstrip()[:1] in ("{", "[")) if t else -1) for t in texts], dtype="int32")

    at = cut(F.col(text))
    cut_text = F.regexp_replace(F.substr(F.col(text), F.lit(1), F.col("cut_at")), r"\s+\z", "")
    return docs.withColumn("cut_at", F.when(at >= 0, at)).withColumn(text, F.when(F.col("cut_at").isNotNull(), cut_text).otherwise(F.col(text)))


def sequence_ratio(a: Column, b: Column) -> Column:
    """Share of matching blocks of two texts, 0 to 1."""

    @F.pandas_udf("double")
    def ratio(x, y):
        import difflib

        import pandas as pd

        return pd.Series([difflib.SequenceMatcher(None, p or "", q or "").ratio() for p, q in zip(x, y)])

    return ratio(a, b)


def execution_paths(files: DataFrame) -> DataFrame:
    """``path, ord, condition, body, guard``: if-blocks with balanced braces; a guard ends or redirects."""

    def scan(batches):
        import re

        import pandas as pd

        # Signs that open or close, and quoted strings, in which they mean nothing.
        sign = re.compile(r"""[(){}]|"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'""", re.S)
        ends = re.compile(r"\b(die|exit|redirect|abort|throw)\b|header\s*\(\s*['\"]Location")

        def close(text, at, left, right):
            """Where the bracket that is open before ``at`` is closed; the end of the text if it is not."""
            depth = 1
            for m in sign.finditer(text, at):
                depth += (m[0] == left) - (m[0] == right)
                if not depth:
                    return m.start()
            return len(text)

        for pdf in batches:
            rows = []
            for path, text in zip(pdf["path"], pdf["text"]):
                for n, m in enumerate(re.finditer(r"\bif\s*\(", text or "")):
                    end = close(text, m.end(), "(", ")")
                    brace = re.compile(r"\s*\{").match(text, end + 1)
                    body = text[brace.end() : close(text, brace.end(), "{", "}")].strip() if brace else ""
                    rows.append((path, n, text[m.end() : end].strip(), body, bool(ends.search(body))))
            yield pd.DataFrame(rows, columns=["path", "ord", "condition", "body", "guard"])

    return files.select("path", "text").mapInPandas(scan, "path string, ord int, condition string, body string, guard boolean")


def closed_json(texts: DataFrame, text: str = "text") -> DataFrame:
    """Truncated JSON made whole: open strings, brackets and braces are closed in their order."""

    @F.pandas_udf("string")
    def close(some):
        import pandas as pd

        out = []
        for t in some:
            stack, quoted, escaped = [], False, False
            for c in t or "":
                if quoted:
                    quoted, escaped = not (c == '"' and not escaped), c == "\\" and not escaped
                elif c == '"':
                    quoted = True
                elif c in "{[":
                    stack.append("}" if c == "{" else "]")
                elif c in "}]" and stack:
                    stack.pop()
            whole = (t or "") + ('"' if quoted else "")
            out.append(whole.rstrip().rstrip(",") + "".join(reversed(stack)))
        return pd.Series(out)

    return texts.withColumn("whole", close(F.col(text)))
