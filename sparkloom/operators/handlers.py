"""What handlers do: bodies of methods and routes in PHP, TypeScript and Java, with their inputs, guards, effects and results.

The patterns are tables of data. Only the cut of a body, which needs balanced
braces, is done in pandas.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .extract import each, extension

#: Where a handler begins, by language: (expression, group of the verb, group of the route, group of the name).
HEADS = {
    "php": (r"public\s+function\s+(\w+)\s*\([^)]*\)(?:\s*:\s*[\w\\?|]+)?\s*(?=\{)", 0, 0, 1),
    "typescript": (r"\b(?:app|router)\.(get|post|put|patch|delete)\(\s*['\"]([^'\"]+)['\"]\s*,\s*(?:[\w.]+\s*,\s*)*(?:async\s*)?(?:function\s*(\w*)\s*)?\([^)]*\)\s*(?:=>\s*)?(?=\{)", 1, 2, 3),
    "java": (r"@(Get|Post|Put|Patch|Delete|Request)Mapping\s*(?:\(\s*(?:value\s*=\s*|path\s*=\s*)?\"?([^\")]*)\"?[^)]*\))?\s*(?:@[^\n]+\n\s*)*(?:public|protected)?\s+[\w<>\[\], ?]+\s+(\w+)\s*\((?:[^()]|\([^()]*\))*\)\s*(?:throws\s+[\w, ]+)?(?=\{)", 1, 2, 3),
}
#: Signs of authorisation: (kind, expression).
AUTH = {
    "typescript": (
        ("passport", r"passport\.authenticate\s*\("), ("jwt", r"jwt\.verify\s*\("), ("nestjs_guard", r"@(?:UseGuards|AuthGuard)"),
        ("auth_middleware", r"verifyToken|verifyJwt|checkAuth|isAuthenticated|requireAuth"), ("session_user", r"\.session\s*\.\s*user|req\.user\b"), ("bearer", r"bearerAuth|Bearer\s+token"),
        ("firebase_email_signin", r"signInWithEmailAndPassword\s*\("), ("firebase_email_signup", r"createUserWithEmailAndPassword\s*\("), ("firebase_oauth_popup", r"signInWithPopup\s*\("),
        ("firebase_oauth_redirect", r"signInWithRedirect\s*\("), ("firebase_signout", r"signOut\s*\(\s*auth"), ("firebase_auth_state", r"onAuthStateChanged\s*\("),
        ("firebase_oauth_provider", r"GoogleAuthProvider|GithubAuthProvider|FacebookAuthProvider"), ("supabase_auth", r"supabase\.auth\.signIn|supabase\.auth\.signUp"),
        ("supabase_signout", r"supabase\.auth\.signOut"), ("clerk_auth", r"useAuth\s*\(\)|SignIn|SignUp|useUser\s*\(\)"), ("nextauth", r"signIn\s*\(\s*['\"]|useSession\s*\(\)|getServerSession\s*\("),
    ),
    "java": (("pre_authorize", r"@PreAuthorize"), ("secured", r"@Secured"), ("security_context", r"SecurityContextHolder"), ("jwt", r"JwtToken|JWTVerifier|parseClaimsJws"), ("role_check", r"hasRole|hasAuthority"), ("test_auth", r"@WithMockUser")),
    "php": (("session_check", r"\$_SESSION\s*\["), ("guard", r"Auth::(?:check|guard|user)\s*\("), ("middleware", r"->middleware\s*\(\s*['\"]auth"), ("policy", r"->authorize\s*\(|Gate::")),
}
#: Annotations of Java classes by role, and types that are no services.
JAVA_ROLES = (("controller", "@RestController|@Controller"), ("model", "@Entity|@Table|@Document"), ("service", "@Service|@Component|@Repository"))
PLAIN_TYPES = ("String", "int", "long", "boolean", "void", "List", "Map", "Optional")
#: Names of middleware that ask for a login.
LOGIN = ("auth", "auth:sanctum", "auth:api", "verified")


def bodies(files: DataFrame, language: str) -> DataFrame:
    """``path, ord, verb, route, name, body`` of every handler; a body ends where its brace is closed, signs in quotes aside."""
    head, verb, route, name = HEADS[language]

    def cut(batches):
        import re

        import pandas as pd

        start = re.compile(head)
        sign = re.compile(r"""[{}]|"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|`(?:[^`\\]|\\.)*`""", re.S)
        for pdf in batches:
            rows = []
            for path, text in zip(pdf["path"], pdf["text"]):
                for n, m in enumerate(start.finditer(text or "")):
                    depth, end = 0, len(text)
                    for s in sign.finditer(text, m.end()):
                        depth += (s[0] == "{") - (s[0] == "}")
                        if depth == 0 and s[0] == "}":
                            end = s.start()
                            break
                    part = lambda g: (m[g] or "") if g else ""  # noqa: B023, E731
                    rows.append((path, n, part(verb), part(route), part(name), text[m.end() + 1 : end].strip()))
            yield pd.DataFrame(rows, columns=["path", "ord", "verb", "route", "name", "body"])

    found = files.select("path", "text").mapInPandas(cut, "path string, ord int, verb string, route string, name string, body string")
    kind = F.when(F.upper("verb") == "REQUEST", "ANY").otherwise(F.upper("verb"))
    return found.withColumn("verb", kind)


def _all(text: str, pattern: str, group: int = 1) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))


def paths(found: DataFrame, language: str) -> DataFrame:
    """``path, ord, verb, route, name, inputs, guards, effects, results`` of handler bodies, lists in order, each item once."""
    inputs = {"php": r"\$request->(?:input|get|post|query)\(\s*['\"](\w+)|\$_(?:POST|GET|REQUEST)\[\s*['\"](\w+)", "typescript": r"req\.(?:body|query|params)\.(\w+)", "java": r"@(?:RequestParam|PathVariable|RequestBody)\s+\w+\s+(\w+)"}[language]
    effects = {"php": r"\b([A-Z]\w+::(?:create|update|insert|delete|destroy|find|where|all))\b|->(save|delete|update)\(", "typescript": r"\b((?:prisma|db|\w+Repository|\w+Service)\.\w+(?:\.\w+)?)\(", "java": r"\b(\w+(?:Service|Repository|Dao)\.\w+)\("}[language]
    results = {"php": r"return\s+(view|redirect|response|back|abort|json_encode)\b", "typescript": r"\bres(?:\.status\(\d+\))?\.(json|send|redirect|render|end)\(", "java": r"return\s+(\w+)"}[language]
    named = lambda p: F.filter(F.array_distinct(F.concat(*[F.regexp_extract_all("body", F.lit(p), F.lit(g)) for g in range(1, p.count("(") - p.count("(?") - p.count(r"\(") + 1)])), lambda x: x != "")
    guard = F.filter(F.array(*[F.when(F.col("body").rlike(p), F.lit(k)) for k, p in AUTH[language]]), lambda x: x.isNotNull())
    return found.select("path", "ord", "verb", "route", "name", named(inputs).alias("inputs"), guard.alias("guards"), named(effects).alias("effects"), named(results).alias("results"))


def happy_path(paths: DataFrame) -> DataFrame:
    """``path, ord, steps``: what happens when nothing fails, one line a step in order: guards, inputs, effects, results."""
    say = lambda word, c: F.transform(c, lambda x: F.concat(F.lit(word + " "), x))
    return paths.select("path", "ord", F.array_join(F.concat(say("guard", "guards"), say("read", "inputs"), say("do", "effects"), say("give", "results")), "; ").alias("steps"))


def auth_signals(files: DataFrame, language: str) -> DataFrame:
    """``path, kind``: signs of authorisation in files, each kind once a file."""
    kinds = F.array(*[F.when(F.col("text").rlike(("(?i)" if language == "typescript" else "") + p), F.lit(k)) for k, p in AUTH[language]])
    return files.select("path", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("kind"))


def injected(files: DataFrame, language: str) -> DataFrame:
    """``path, depends_on``: services that constructors take, each once a file."""
    if language == "java":
        heads = each(files, r"(?:public|protected)\s+\w+\s*\(([^)]{0,500})\)\s*\{", {"params": 1})
        types = F.regexp_extract_all("params", F.lit(r"(\w+)(?:<[^>]+>)?\s+\w+\s*(?:,|$)"), F.lit(1))
    else:
        heads = each(files, r"(?:constructor|__construct)\s*\(([^)]*)\)", {"params": 1})
        types = F.regexp_extract_all("params", F.lit(r"(?:private|protected|readonly|public)\s+(?:readonly\s+)?\w+\s*:\s*(\w+)" if language == "typescript" else r"(?:^|,)\s*(?:(?:private|protected|public|readonly)\s+)*\\?(?:\w+\\)*([A-Z]\w*)\s+\$"), F.lit(1))
    return heads.select("path", F.explode(types).alias("depends_on")).where(~F.col("depends_on").isin(*PLAIN_TYPES)).distinct()


def inputs(files: DataFrame, language: str) -> DataFrame:
    """``path, source, key``: what requests bring, also by destructuring, each once a file."""
    if language == "java":
        parts = [each(files, rf"@{a}\s*(?:\([^)]*\))?\s*\w+\s+(\w+)", {"key": 1}).select("path", F.lit(s).alias("source"), "key") for a, s in (("RequestBody", "body"), ("RequestParam", "query"), ("PathVariable", "path"))]
        return reduce(DataFrame.unionByName, parts).distinct()
    direct = each(files, r"req\.(body|query|params)\.(\w+)", {"source": 1, "key": 2}).select("path", "source", "key")
    taken = each(files, r"const\s*\{([^}]+)\}\s*=\s*req\.(body|query|params)", {"names": 1, "source": 2})
    return direct.unionByName(taken.select("path", "source", F.explode(F.regexp_extract_all("names", F.lit(r"\b(\w+)\b"), F.lit(1))).alias("key"))).distinct()


def java_classes(files: DataFrame) -> DataFrame:
    """``path, name, role`` of Java classes by the annotations before them."""
    found = each(files, r"((?:@\w+(?:\([^)]*\))?\s*\n?){0,6})(?:public\s+|protected\s+|private\s+|abstract\s+|final\s+)*(?:class|interface|enum)\s+(\w+)", {"notes": 1, "name": 2})
    role = None
    for name, signs in JAVA_ROLES:
        hit = F.col("notes").rlike(rf"(?:{signs})\b")
        role = F.when(hit, name) if role is None else role.when(hit, name)
    return found.select("path", "name", role.otherwise("class").alias("role"))


def route_file(files: DataFrame) -> DataFrame:
    """``path, verb, uri, controller, action, middleware, login`` of the routes of a Laravel file, ``line`` in order.

    A handler is ``'Ctrl@method'``, an array with a class and a method, or a class alone, which is invoked.
    """
    pattern = r"(?i)Route\s*::\s*(get|post|put|patch|delete|any|match)\s*\(\s*['\"]([^'\"]+)['\"](?:\s*,\s*['\"]([^'\"@]+)@(\w+)['\"]|\s*,\s*\[\s*\\?([\w\\]+)::class\s*,\s*['\"](\w+)['\"]\s*\]|\s*,\s*\\?([A-Z][A-Za-z\\]+)::class)?([^;]*)"
    found = each(files, pattern, {"verb": 1, "uri": 2, "c1": 3, "a1": 4, "c2": 5, "a2": 6, "c3": 7, "tail": 8})
    first = lambda *c: F.coalesce(*[F.nullif(x, F.lit("")) for x in c], F.lit(""))
    controller = F.element_at(F.split(first("c1", "c2", "c3"), r"\\"), -1)
    ware = F.regexp_extract_all("tail", F.lit(r"->middleware\s*\(\s*['\"]([^'\"]+)['\"]"), F.lit(1))
    return found.select("path", F.col("ord").alias("line"), F.upper("verb").alias("verb"), "uri", controller.alias("controller"), F.when(first("a1", "a2") != "", first("a1", "a2")).otherwise("__invoke").alias("action"), F.array_join(ware, ",").alias("middleware"), F.arrays_overlap(ware, F.array(*map(F.lit, LOGIN))).alias("login"))


def group_prefixes(files: DataFrame) -> DataFrame:
    """``path, verb, uri``: routes of ``Route::prefix('x')->group(function () {...})`` blocks, the prefix before each; blocks within blocks add up at one level."""
    groups = each(files, r"(?s)Route::(?:middleware\([^)]*\)->)?prefix\(\s*['\"]([^'\"]+)['\"]\s*\)(?:->middleware\([^)]*\))?->group\(\s*function\s*\(\)\s*\{(.*?)\}\s*\)\s*;", {"prefix": 1, "text": 2})
    inner = each(groups, r"Route::(get|post|put|patch|delete)\(\s*['\"]([^'\"]*)['\"]", {"verb": 1, "uri": 2}, ["path", "prefix"])
    clean = lambda c: F.regexp_replace(c, "^/+|/+$", "")
    return inner.select("path", F.upper("verb").alias("verb"), F.concat(F.lit("/"), F.concat_ws("/", clean("prefix"), F.nullif(clean("uri"), F.lit("")))).alias("uri"))


def attribute_routes(files: DataFrame) -> DataFrame:
    """``path, verb, uri, name``: Symfony's ``#[Route('/x', methods: ['GET'])]`` on methods, one row a method (ANY without one)."""
    found = each(files, r"#\[Route\(\s*['\"]([^'\"]+)['\"]([^\]]*(?:\[[^\]]*\])?[^\]]*)\)\]\s*(?:public\s+)?function\s+(\w+)", {"uri": 1, "rest": 2, "name": 3})
    verbs = F.regexp_extract_all(F.regexp_extract("rest", r"methods\s*:\s*\[([^\]]*)\]", 1), F.lit(r"['\"](\w+)['\"]"), F.lit(1))
    return found.select("path", F.explode(F.when(F.size(verbs) > 0, verbs).otherwise(F.array(F.lit("ANY")))).alias("verb"), "uri", "name")


def hooks(files: DataFrame) -> DataFrame:
    """``path, kind, hook, callback`` of WordPress actions, filters, shortcodes and REST routes."""
    plain = each(files, r"\badd_(action|filter|shortcode)\(\s*['\"]([^'\"]+)['\"]\s*,\s*['\"]?(\w+)", {"kind": 1, "hook": 2, "callback": 3}).select("path", "kind", "hook", "callback")
    rest = each(files, r"register_rest_route\(\s*['\"]([^'\"]+)['\"]\s*,\s*['\"]([^'\"]+)['\"]", {"space": 1, "route": 2})
    return plain.unionByName(rest.select("path", F.lit("rest").alias("kind"), F.concat(F.lit("/"), "space", "route").alias("hook"), F.lit("").alias("callback")))


def vue_routes(files: DataFrame) -> DataFrame:
    """``path, uri, component`` of Vue router tables."""
    return each(files, r"path\s*:\s*['\"]([^'\"]+)['\"][^{}]*?component\s*:\s*(?:\(\)\s*=>\s*import\(\s*['\"]([^'\"]+)['\"]\s*\)|(\w+))", {"uri": 1, "lazy": 2, "named": 3}).select("path", "uri", F.when(F.col("lazy") != "", F.col("lazy")).otherwise(F.col("named")).alias("component"))


def component_facts(files: DataFrame) -> DataFrame:
    """``path, props, emits`` of Vue and React files."""
    some = files.where(extension(F.col("path")).isin("vue", "tsx", "jsx"))
    props = F.regexp_extract_all(F.regexp_extract("text", r"defineProps(?:<\{([^}]*)\}>)?", 1), F.lit(r"(\w+)\??\s*:"), F.lit(1))
    react = F.regexp_extract_all(F.regexp_extract("text", r"function\s+[A-Z]\w*\(\s*\{([^}]*)\}", 1), F.lit(r"(\w+)"), F.lit(1))
    emits = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?:\$emit|\bemit)\(\s*['\"]([\w:-]+)['\"]"), F.lit(1)))
    return some.select("path", F.array_join(F.array_distinct(F.concat(props, react)), ",").alias("props"), F.array_join(emits, ",").alias("emits"))


def superglobals(files: DataFrame) -> DataFrame:
    """``path, var, key`` of reads of PHP's request and session variables, each once a file."""
    return each(files, r"\$_(POST|GET|REQUEST|SESSION|COOKIE|FILES|SERVER)\[\s*['\"](\w+)['\"]\s*\]", {"var": 1, "key": 2}).select("path", F.concat(F.lit("$_"), "var").alias("var"), "key").distinct()


def redirects(files: DataFrame) -> DataFrame:
    """``path, target`` of header redirects and redirect calls, without query strings."""
    found = each(files, r"(?i)(?:header\s*\(\s*['\"]Location:\s*|redirect\(\s*['\"]|location\.href\s*=\s*['\"])([^'\"?]+)", {"target": 1})
    return found.select("path", F.trim("target").alias("target")).distinct()


def methods(files: DataFrame) -> DataFrame:
    """``path, class, name, visibility, doc`` of PHP methods, each of the last class before it, with the first line of the comment above."""
    from pyspark.sql import Window

    found = each(files, r"(?s)(?:/\*\*\s*\*?\s*([^\n*]*)[^/]*?\*/\s*)?(?:(?:abstract|final)\s+)*(?:(class|interface|trait)\s+(\w+)|(public|protected|private)\s+(?:static\s+)?function\s+(\w+))", {"doc": 1, "kind": 2, "class": 3, "visibility": 4, "name": 5})
    last = Window.partitionBy("path").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    own = found.withColumn("class", F.last(F.when(F.col("kind") != "", F.col("class")), True).over(last))
    return own.where("name <> ''").select("path", "class", "name", "visibility", F.trim("doc").alias("doc"))


def schema_fields(files: DataFrame) -> DataFrame:
    """``path, schema, field, type`` of validation schemas (``const x = z.object({ a: z.string() })``)."""
    found = each(files, r"(?s)(?:const|let|var)\s+(\w+)\s*=\s*z\.object\(\s*\{(.*?)\}\s*\)", {"schema": 1, "text": 2})
    return each(found, r"(\w+)\s*:\s*z\.(\w+)\(", {"field": 1, "type": 2}, ["path", "schema"]).select("path", "schema", "field", "type")


#: Calls of object mappers: (mapper, expression of the entity and the operation).
MAPPERS = (("prisma", r"\bprisma\.(\w+)\.(findMany|findUnique|findFirst|create|update|upsert|delete|deleteMany|updateMany|count)\("), ("typeorm", r"\b(\w+)Repository\.(find|findOne|findBy|save|insert|update|delete|remove)\("))


def mapper_calls(files: DataFrame) -> DataFrame:
    """``path, mapper, entity, operation`` of calls of object mappers, each once a file."""
    parts = []
    for mapper, pattern in MAPPERS:
        parts.append(each(files, pattern, {"entity": 1, "operation": 2}).select("path", F.lit(mapper).alias("mapper"), "entity", "operation"))
    store = each(files, r"\b(getDocs|getDoc|addDoc|setDoc|updateDoc|deleteDoc)\(\s*(?:collection|doc|query)\([^'\"]*['\"](\w+)", {"operation": 1, "entity": 2})
    parts.append(store.select("path", F.lit("firestore").alias("mapper"), "entity", "operation"))
    return reduce(DataFrame.unionByName, parts).distinct()
