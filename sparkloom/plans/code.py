"""Facts of code and its graph. Source files are made of the tables' rows, so that SQL over the rows tells what must be found in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.keys import human, normal_route
from ..operators import codegraph, extract, handlers, merge, mining, relations, retrieve, rules, states, validate
from ..sources.tables import table
from .registry import query


def _file(df, path, text, *keep):
    return df.select(path.alias("path"), text.alias("text"), *keep)


def _f(pattern, *cols):
    return F.format_string(pattern, *[F.col(c) if isinstance(c, str) else c for c in cols])


@query("""WITH v(i, action, method, suffix) AS (VALUES (0, 'index', 'GET', ''), (1, 'store', 'POST', ''), (2, 'create', 'GET', '/create'), (3, 'show', 'GET', '/{id}'), (4, 'update', 'PUT', '/{id}'), (5, 'update', 'PATCH', '/{id}'), (6, 'destroy', 'DELETE', '/{id}'), (7, 'edit', 'GET', '/{id}/edit'))
SELECT 'routes/n' || n_nationkey || '.php' AS path, method, '/n' || n_nationkey || suffix AS route, 'N' || n_nationkey || 'Controller@' || action AS handler FROM nation, v
WHERE CASE n_nationkey % 4 WHEN 0 THEN true WHEN 1 THEN action NOT IN ('create', 'edit') WHEN 2 THEN action IN ('index', 'update') ELSE action <> 'destroy' END""")
def q70_resource_routes(spark, sf_dir):
    k = F.col("n_nationkey")
    tail = F.when(k % 4 == 2, "->only(['index', 'update'])").when(k % 4 == 3, '->except(["destroy"])').otherwise("")
    text = F.concat(F.lit("<?php\nRoute::"), F.when(k % 4 == 1, "apiResource").otherwise("resource"), _f("('n%d', N%dController::class)", "n_nationkey", "n_nationkey"), tail, F.lit(";\n"))
    return extract.resource_routes(_file(table(spark, sf_dir, "nation"), _f("routes/n%d.php", "n_nationkey"), text))


@query("""SELECT 'routes/p' || p_partkey || '.php' AS path, upper(CASE p_size % 3 WHEN 0 THEN 'get' WHEN 1 THEN 'post' ELSE 'delete' END) AS method, '/p/' || p_partkey AS route, 'P' || p_size || '@run' AS handler FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'routes/p' || p_partkey || '.ts', 'GET', '/q/' || p_partkey, '' FROM part WHERE p_partkey % 3 = 1""")
def q70b_verb_routes(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    verb = F.when(F.col("p_size") % 3 == 0, "get").when(F.col("p_size") % 3 == 1, "post").otherwise("delete")
    php = _file(part.where("p_partkey % 3 = 0"), _f("routes/p%d.php", "p_partkey"), F.concat(F.lit("Route::"), verb, _f("('/p/%d', [P%d::class, 'run']);", "p_partkey", "p_size")))
    spring = _file(part.where("p_partkey % 3 = 1"), _f("routes/p%d.ts", "p_partkey"), _f("@GetMapping(\"/q/%d\")\npublic String run() {}", "p_partkey"))
    return extract.routes(php.unionByName(spring))


@query("""SELECT 'app/n' || n_nationkey || '/[id]/' || CASE WHEN n_regionkey % 2 = 0 THEN 'page.tsx' ELSE 'route.ts' END AS path, m AS method, '/n' || n_nationkey || '/:id' AS route, CASE WHEN n_regionkey % 2 = 0 THEN 'page' ELSE 'api' END AS kind
FROM nation, LATERAL (SELECT unnest(CASE WHEN n_regionkey % 2 = 0 THEN ['GET'] WHEN n_regionkey = 1 THEN ['GET', 'POST'] ELSE ['ANY'] END) AS m)""")
def q70c_file_routes(spark, sf_dir):
    name = F.when(F.col("n_regionkey") % 2 == 0, "page.tsx").otherwise("route.ts")
    text = F.when(F.col("n_regionkey") == 1, "export async function GET() {}\nexport const POST = 1").otherwise("export default 1")
    return extract.file_routes(_file(table(spark, sf_dir, "nation"), F.concat(_f("app/n%d/[id]/", "n_nationkey"), name), text))


@query("""WITH c AS (SELECT least((SELECT count(*) FROM nation), 20) + 3 AS php, least((SELECT count(*) FROM supplier), 20) + 3 AS ts, least((SELECT count(*) FROM part), 10) AS js, least((SELECT count(*) FROM region), 10) AS vue)
SELECT CASE WHEN php >= ts + CASE WHEN ts >= js THEN vue ELSE 0 END AND php >= js + CASE WHEN ts < js THEN vue ELSE 0 END THEN 'php' WHEN ts + CASE WHEN ts >= js THEN vue ELSE 0 END >= js + CASE WHEN ts < js THEN vue ELSE 0 END THEN 'typescript' ELSE 'javascript' END AS language, greatest(php, ts + CASE WHEN ts >= js THEN vue ELSE 0 END, js + CASE WHEN ts < js THEN vue ELSE 0 END)::BIGINT AS votes FROM c""")
def q71_language(spark, sf_dir):
    return extract.language(_tree(spark, sf_dir))


def _tree(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    none = F.lit("")
    files = _file(t("nation"), _f("src/n%d.php", "n_nationkey"), none).unionByName(_file(t("supplier"), _f("web/s%d.ts", "s_suppkey"), none)).unionByName(_file(t("part"), _f("web/p%d.js", "p_partkey"), none)).unionByName(_file(t("customer"), _f("vendor/c%d.java", "c_custkey"), none)).unionByName(_file(t("region"), _f("web/r%d.vue", "r_regionkey"), none))
    return files.unionByName(spark.createDataFrame([("composer.json", '{"require": {"Symfony/framework-bundle": "6"}}'), ("package.json", "{}"), ("tsconfig.json", "{}")], "path string, text string"))


@query("SELECT 'symfony' AS framework, 'unknown' AS other")
def q71b_framework(spark, sf_dir):
    tree = _tree(spark, sf_dir)
    return extract.framework(tree, "php").crossJoin(extract.framework(tree, "typescript").withColumnRenamed("framework", "other"))


@query("""SELECT adapter, count(*) AS files FROM (SELECT CASE WHEN p_partkey % 5 = 0 THEN 'php' WHEN p_partkey % 5 = 1 THEN 'typescript' WHEN p_partkey % 5 = 2 THEN 'javascript' WHEN p_partkey % 5 = 3 THEN 'kotlin' END AS adapter FROM part) WHERE adapter IS NOT NULL GROUP BY adapter""")
def q71c_adapters(spark, sf_dir):
    ends = F.element_at(F.array(*map(F.lit, ("PHP", "tsx", "jsx", "kt", "md"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return extract.by_adapter(_file(table(spark, sf_dir, "part"), F.concat(_f("a/%d.", "p_partkey"), ends), F.lit(""))).groupBy("adapter").agg(F.count("*").alias("files"))


_ROLES = ("Controller", "Service", "Listener", "Thing")


@query("""SELECT 'c' || p_partkey || '.php' AS path, CASE WHEN p_size % 2 = 0 THEN 'interface' ELSE 'class' END AS kind, 'P' || p_partkey || ['Controller', 'Service', 'Listener', 'Thing'][p_partkey % 4 + 1] AS name, CASE WHEN p_partkey % 3 = 0 THEN 'App\\Model' ELSE '' END AS parent,
CASE WHEN p_partkey % 4 < 3 THEN ['controller', 'service', 'listener'][p_partkey % 4 + 1] WHEN p_partkey % 3 = 0 THEN 'model' ELSE 'class' END AS role FROM part""")
def q72_classes(spark, sf_dir):
    role = F.element_at(F.array(*map(F.lit, _ROLES)), (F.col("p_partkey") % 4 + 1).cast("int"))
    text = F.concat(F.lit("<?php\nfinal "), F.when(F.col("p_size") % 2 == 0, "interface").otherwise("class"), _f(" P%d", "p_partkey"), role, F.when(F.col("p_partkey") % 3 == 0, F.lit(" extends App\\Model")).otherwise(""), F.lit("\n{ }"))
    found = extract.classes(_file(table(spark, sf_dir, "part"), _f("c%d.php", "p_partkey"), text))
    return found.select("path", "kind", "name", "parent", extract.class_role(F.col("name"), F.col("parent")).alias("role"))


def _functions(spark, sf_dir):
    text = F.concat(_f("<?php function f%d(int $a, ", "p_partkey"), F.lit("$b): ?array {\n  $x = "), _f("g%d($a) . strlen($b);\n  getenv('KEY_%d'); require_once 'lib/%d.php';\n}", F.col("p_partkey") % 7, F.col("p_size"), F.col("p_size")))
    return _file(table(spark, sf_dir, "part"), _f("f%d.php", "p_partkey"), text)


@query("""SELECT 'f' || p_partkey || '.php' AS path, 'f' || p_partkey AS name, 'int $a, $b' AS params, 'array' AS return_type FROM part""")
def q72b_functions(spark, sf_dir):
    return extract.functions(_functions(spark, sf_dir)).select("path", "name", "params", "return_type")


@query("""SELECT path, callee FROM (SELECT 'f' || p_partkey || '.php' AS path, unnest(['f' || p_partkey, 'g' || p_partkey % 7]) AS callee FROM part)""")
def q72c_calls(spark, sf_dir):
    return extract.calls(_functions(spark, sf_dir), spark.createDataFrame([("strlen",), ("getenv",)], "name string"))


@query("""SELECT 'env' AS kind, 'f' || p_partkey || '.php' AS path, 'KEY_' || p_size AS name FROM part UNION ALL SELECT 'import', 'f' || p_partkey || '.php', 'lib/' || p_size || '.php' FROM part""")
def q72d_env_and_imports(spark, sf_dir):
    files = _functions(spark, sf_dir)
    return extract.env_vars(files).select(F.lit("env").alias("kind"), "path", "name").unionByName(extract.imports(files).select(F.lit("import").alias("kind"), "path", F.col("target").alias("name")))


_SQL = "CASE p_partkey % 4 WHEN 0 THEN 'SELECT a, b FROM t' || p_size || ' JOIN u' || p_size || ' ON x = y' WHEN 1 THEN 'INSERT INTO T' || p_size || ' (c, d) VALUES (1)' WHEN 2 THEN 'UPDATE t' || p_size || ' SET z = 1' ELSE 'delete from t' || p_size END"


def _sql(spark, sf_dir):
    k = F.col("p_partkey") % 4
    sql = F.when(k == 0, _f("SELECT a, b FROM t%d JOIN u%d ON x = y", "p_size", "p_size")).when(k == 1, _f("INSERT INTO T%d (c, d) VALUES (1)", "p_size")).when(k == 2, _f("UPDATE t%d SET z = 1", "p_size")).otherwise(_f("delete from t%d", "p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", _f("s%d.php", "p_partkey").alias("path"), sql.alias("sql"))


@query(f"""SELECT 's' || p_partkey || '.php' AS path, upper(regexp_extract(s, '^[A-Za-z]+')) AS operation, 't' || p_size AS "table", s AS sql FROM (SELECT *, {_SQL} AS s FROM part)""")
def q73_sql_in_strings(spark, sf_dir):
    rows = _sql(spark, sf_dir)
    return extract.sql_facts(rows.select("path", F.concat(F.lit("$q = \""), "sql", F.lit("\"; $other = 'no sql here';")).alias("text")))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'a,b' WHEN 1 THEN 'c,d' END AS fields FROM part""")
def q73b_sql_fields(spark, sf_dir):
    fields = tx.sql_fields(F.col("sql"))
    return _sql(spark, sf_dir).select("p_partkey", F.when(F.size(fields) > 0, F.array_join(fields, ",")).alias("fields"))


@query("""SELECT DISTINCT 't' || p_size AS left_table, 'u' || p_size AS right_table FROM part WHERE p_partkey % 4 = 0""")
def q73c_sql_joins(spark, sf_dir):
    return relations.sql_joins(_sql(spark, sf_dir))


_COLS = "LATERAL (SELECT unnest([{'n': 'id', 't': 'bigint', 'x': false, 'd': ''}, {'n': 'name', 't': 'varchar(' || p_size || ')', 'x': true, 'd': ''}, {'n': 'price', 't': 'decimal(10,2)', 'x': false, 'd': '0'}]) AS c)"


@query(f"""SELECT 'tab' || p_partkey AS "table", c.n AS "column", c.t AS type, c.x AS nullable, c.d AS "default" FROM part, {_COLS}""")
def q74_create_table(spark, sf_dir):
    sql = table(spark, sf_dir, "part").select(_f("CREATE TABLE IF NOT EXISTS Tab%d (id BIGINT PRIMARY KEY, `name` VARCHAR(%d), price DECIMAL(10,2) NOT NULL DEFAULT 0, UNIQUE (name), KEY k (price))", "p_partkey", "p_size").alias("sql"))
    return extract.create_table_columns(sql).select("table", "column", "type", "nullable", "default")


@query("""SELECT 'm' || p_partkey || '.php' AS path, 'tab' || p_size AS "table", c.n AS "column", c.t AS type, c.x AS nullable, c.u AS "unique", c.d AS "default", c.r AS refers FROM part, LATERAL (SELECT unnest([{'n': 'name', 't': 'string', 'x': false, 'u': true, 'd': '', 'r': ''}, {'n': 'size', 't': 'integer', 'x': true, 'u': false, 'd': p_size::VARCHAR, 'r': ''}, {'n': 'brand_id', 't': 'foreignId', 'x': false, 'u': false, 'd': '', 'r': 'brands'}]) AS c)""")
def q74b_migrations(spark, sf_dir):
    text = _f("Schema::create('tab%d', function (Blueprint $table) {\n $table->string('name', 40)->unique();\n $table->integer('size')->nullable()->default('%d');\n $table->foreignId('brand_id')->constrained('brands');\n});", "p_size", "p_size")
    return extract.migration_columns(_file(table(spark, sf_dir, "part"), _f("m%d.php", "p_partkey"), text))


@query("""SELECT 'p' || p_partkey || '.prisma' AS path, 'M' || p_partkey AS "table", c.n AS "column", c.t AS type, c.x AS nullable, c.u AS "unique" FROM part, LATERAL (SELECT unnest([{'n': 'id', 't': 'Int', 'x': false, 'u': true}, {'n': 'note', 't': 'String', 'x': true, 'u': false}]) AS c)""")
def q74c_prisma(spark, sf_dir):
    return extract.prisma_columns(_file(table(spark, sf_dir, "part"), _f("p%d.prisma", "p_partkey"), _f("model M%d {\n  id Int @id\n  note String?\n}", "p_partkey")))


_PURPOSE = """CASE p_partkey % 6 WHEN 0 THEN 'User login form — authenticates an existing user' WHEN 1 THEN 'User registration form — collects personal details and creates an account' WHEN 2 THEN 'Payment form — processes financial transaction' WHEN 3 THEN 'Search form' WHEN 4 THEN 'Address / shipping details form' ELSE '' END"""
_FIELDS = (("Password", "x"), ("email", "phone"), ("amount", "cvv"), ("q", "page"), ("city", "zip"), ("a", "b"))


def _forms(spark, sf_dir):
    k = F.col("p_partkey") % 6
    field = lambda i: F.element_at(F.array(*[F.lit(f[i]) for f in _FIELDS]), (k + 1).cast("int"))
    form = F.concat(_f("<form action=\"/p/%d\" METHOD='post'>", "p_partkey"), F.lit("<input type=\"Text\" name=\""), field(0), F.lit("\"><select name='"), field(1), F.lit("'></select><input type=submit></form>"))
    return _file(table(spark, sf_dir, "part"), _f("f%d.html", "p_partkey"), F.concat(form, F.lit("\n"), form))


@query("""SELECT 'f' || p_partkey || '.html' AS path, '/p/' || p_partkey AS action, 'POST' AS method, f.n AS field, f.t AS type FROM part, LATERAL (SELECT unnest([{'n': ['Password', 'email', 'amount', 'q', 'city', 'a'][p_partkey % 6 + 1], 't': 'text'}, {'n': ['x', 'phone', 'cvv', 'page', 'zip', 'b'][p_partkey % 6 + 1], 't': 'select'}]) AS f)""")
def q75_form_fields(spark, sf_dir):
    return extract.form_fields(_forms(spark, sf_dir)).select("path", "action", "method", "field", "type")


@query(f"""SELECT 'f' || p_partkey || '.html' AS path, {_PURPOSE} AS purpose FROM part""")
def q75b_form_purpose(spark, sf_dir):
    fields = extract.form_fields(_forms(spark, sf_dir)).groupBy("path").agg(F.collect_list("field").alias("fields"))
    return fields.select("path", extract.form_purpose(F.col("fields")).alias("purpose"))


@query("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'api' WHEN 1 THEN 'download' WHEN 2 THEN 'action' WHEN 3 THEN 'page' ELSE 'script' END AS kind FROM part""")
def q75c_endpoint_kind(spark, sf_dir):
    signs = F.element_at(F.array(*[F.array(*map(F.lit, x)) for x in (("form", "json_encode"), ("readfile", "redirect"), ("redirect", "render"), ("form", "x"), ("x", "y"))]), (F.col("p_size") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", extract.endpoint_kind(signs).alias("kind"))


@query("""SELECT 'e' || s_suppkey || '.php' AS path, ['cli', 'webhook', 'queue', 'schedule'][s_suppkey % 4 + 1] AS kind, ['mail:' || s_nationkey, '/pay/webhook', 'ShouldQueue', '''backup'''][s_suppkey % 4 + 1] AS trigger, [1.0, 0.8, 0.8, 1.0][s_suppkey % 4 + 1]::DOUBLE AS confidence FROM supplier""")
def q76_entry_points(spark, sf_dir):
    k = F.col("s_suppkey") % 4
    text = F.when(k == 0, _f("protected $signature = 'mail:%d';", "s_nationkey")).when(k == 1, F.lit("Route::post('/pay/webhook', X);")).when(k == 2, F.lit("class A implements ShouldQueue {}")).otherwise(F.lit("$schedule->command('backup')->daily();"))
    return extract.entry_points(_file(table(spark, sf_dir, "supplier"), _f("e%d.php", "s_suppkey"), text))


def _components(spark, sf_dir):
    text = _f("const a = useState(); useB%d(); return <div><S%d/><Missing/></div>", F.col("s_suppkey") % 3, F.col("s_suppkey") + 1)
    return extract.components(_file(table(spark, sf_dir, "supplier"), F.concat(F.when(F.col("s_suppkey") % 2 == 0, "pages/").otherwise("ui/"), _f("S%d.tsx", "s_suppkey")), text))


@query("""SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'pages/' ELSE 'ui/' END || 'S' || s_suppkey || '.tsx' AS path, 'S' || s_suppkey AS name, array_to_string(list_sort(['Missing', 'S' || s_suppkey + 1]), ',') AS children, 'useB' || s_suppkey % 3 || ',useState' AS hooks, s_suppkey % 2 = 0 AS is_page FROM supplier""")
def q76b_components(spark, sf_dir):
    return _components(spark, sf_dir).select("path", "name", F.array_join("children", ",").alias("children"), F.array_join("hooks", ",").alias("hooks"), "is_page")


@query("""SELECT CASE WHEN a.s_suppkey % 2 = 0 THEN 'pages/' ELSE 'ui/' END || 'S' || a.s_suppkey || '.tsx' AS path, 'S' || b.s_suppkey AS child, CASE WHEN b.s_suppkey % 2 = 0 THEN 'pages/' ELSE 'ui/' END || 'S' || b.s_suppkey || '.tsx' AS files FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1""")
def q76c_resolved_children(spark, sf_dir):
    return extract.resolved_children(_components(spark, sf_dir)).select("path", "child", F.array_join("files", ",").alias("files"))


@query("""SELECT 'x' || p_partkey || '.php' AS path, ord, condition, body, guard FROM part, LATERAL (SELECT unnest([{'ord': 0, 'condition': '$a > ' || p_size, 'body': 'if ($b) { die(1); }', 'guard': true}, {'ord': 1, 'condition': '$b', 'body': 'die(1);', 'guard': true}, {'ord': 2, 'condition': 'f($c)', 'body': '$x = "}";', 'guard': false}], recursive := true))""")
def q77_execution_paths(spark, sf_dir):
    text = _f("if ($a > %d) { if ($b) { die(1); } } if (f($c)) {$x = \"}\";}", "p_size")
    return extract.execution_paths(_file(table(spark, sf_dir, "part"), _f("x%d.php", "p_partkey"), text))


@query("""WITH r AS (SELECT p_partkey, p_size, p_partkey % 5 AS k FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN 'Part must be at least ' || p_size || ' characters' WHEN 1 THEN 'Part must not exceed ' || p_size WHEN 2 THEN 'Part must be in ''shipped'' state' WHEN 3 THEN 'Only administrators can perform this action' END AS sentence FROM r""")
def q77b_condition_sentences(spark, sf_dir):
    k = F.col("p_partkey") % 5
    cond = F.when(k == 0, _f("strlen($name) < %d", "p_size")).when(k == 1, _f("$qty > %d", "p_size")).when(k == 2, F.lit("$o->status === 'shipped'")).when(k == 3, F.lit("$user->is_admin")).otherwise("$unclear")
    return table(spark, sf_dir, "part").select("p_partkey", mining.sentence(cond, F.lit("Part")).alias("sentence"))


@query("""SELECT 'r' || p_partkey || '.php' AS path, CASE p_partkey % 3 WHEN 0 THEN 'AUTHORIZATION' WHEN 1 THEN 'BUSINESS_LIMIT' ELSE 'VALIDATION' END AS category, CASE p_partkey % 3 WHEN 0 THEN 'Only administrators can perform this action' WHEN 1 THEN 'R' || p_partkey || ' must not exceed ' || p_size ELSE 'R' || p_partkey || ' must be at least ' || p_size || ' characters' END AS description, 0.8::DOUBLE AS confidence FROM part""")
def q77c_branch_rules(spark, sf_dir):
    k = F.col("p_partkey") % 3
    cond = F.when(k == 0, F.lit("$u->is_admin")).when(k == 1, _f("$qty > %d", "p_size")).otherwise(_f("strlen($n) < %d", "p_size"))
    branches = table(spark, sf_dir, "part").select(_f("r%d.php", "p_partkey").alias("path"), cond.alias("condition"), F.lit("die").alias("body"))
    plain = branches.withColumn("body", F.lit("$x = 1"))
    return mining.branch_rules(branches.unionByName(plain).unionByName(branches.withColumn("condition", F.lit("$unclear"))))


@query("""SELECT 'tab' || p_partkey AS "table", 'name' AS "column", 'uniqueness' AS category, 'name of tab' || p_partkey || ' is unique' AS description FROM part UNION ALL SELECT 'tab' || p_partkey, 'name', 'validation', 'name of tab' || p_partkey || ' is required' FROM part WHERE p_size > 9""")
def q77d_schema_rules(spark, sf_dir):
    cols = table(spark, sf_dir, "part").select(_f("tab%d", "p_partkey").alias("table"), F.lit("name").alias("column"), (F.col("p_size") <= 9).alias("nullable"), F.lit(True).alias("unique"))
    return rules.schema_rules(cols)


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Admin' WHEN 1 THEN 'API Client' WHEN 2 THEN 'Authenticated User' ELSE 'Guest' END AS actor FROM part""")
def q78_actors(spark, sf_dir):
    k = F.col("p_partkey") % 4
    auths = F.when(k == 1, F.array(F.lit("jwt"))).when(k == 2, F.array(F.lit("jwt"), F.lit("get_user"))).otherwise(F.array().cast("array<string>"))
    path = F.when(k == 0, _f("/Admin/p%d", "p_partkey")).otherwise(_f("/shop/p%d", "p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", rules.actor(path, F.lit("P@run"), auths).alias("actor"))


@query("""SELECT 'PAYMENT' AS category, 'class_name,env_var,service_dep' AS channels, (SELECT count(*) FROM part WHERE p_partkey % 3 = 0) * 2 + (SELECT count(*) FROM supplier) AS hits UNION ALL SELECT 'INFRA', 'class_name,service_dep', (SELECT count(*) FROM part WHERE p_partkey % 3 = 1) * 2""")
def q78b_external_systems(spark, sf_dir):
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    name = F.when(F.col("p_partkey") % 3 == 0, _f("My%dStripeGateway", "p_partkey")).when(F.col("p_partkey") % 3 == 1, _f("Redis%dStore", "p_partkey")).otherwise(_f("REDIS_%d", "p_partkey").substr(1, 5))
    facts = part.select(F.lit("class_name").alias("channel"), name.alias("value")).unionByName(part.select(F.lit("service_dep").alias("channel"), name.alias("value"))).where(~F.startswith("value", F.lit("REDIS")))
    return rules.external_systems(facts.unionByName(supplier.select(F.lit("env_var").alias("channel"), _f("stripe_key_%d", "s_suppkey").alias("value"))).unionByName(supplier.select(F.lit("env_var").alias("channel"), _f("x_stripe_%d", "s_suppkey").alias("value"))))


# --- the graph of the code: customers are classes, orders their methods, lines calls ---


def _methods(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    parent = F.when(F.col("o_custkey") % 2 == 0, _f("App\\C%d", F.col("o_custkey") % 40)).otherwise(_f("C%d", F.col("o_custkey") % 40))
    method = _f("m%d", F.col("o_orderkey") % 12)
    return o.select(parent.alias("parent"), method.alias("method"), F.concat_ws("::", parent, method).alias("node"), _f("c%d.php", F.col("o_custkey") % 40).alias("file"), F.col("o_orderkey").alias("ord"))


_METHODS = "m AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'App\\C' ELSE 'C' END || o_custkey % 40 AS parent, 'm' || o_orderkey % 12 AS method, 'c' || o_custkey % 40 || '.php' AS file, o_orderkey AS ord FROM orders), mm AS (SELECT *, parent || '::' || method AS node, regexp_extract(parent, '([^\\\\]+)$', 1) AS bare FROM m)"


@query(f"""WITH {_METHODS}, r AS (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN '(closure)@m1' WHEN 1 THEN 'no separator' ELSE 'X\\C' || p_size || CASE WHEN p_partkey % 2 = 0 THEN '@' ELSE '::' END || 'm' || p_partkey % 15 END AS handler FROM part),
h AS (SELECT id, handler, CASE WHEN starts_with(handler, '(closure)') OR NOT regexp_matches(handler, '@|::') THEN NULL ELSE regexp_extract(handler, '([^\\\\@:]+)(@|::)[^@:]+$', 1) END AS c, regexp_extract(handler, '(@|::)([^@:]+)$', 2) AS f FROM r),
a AS (SELECT parent AS c, method AS f, arg_min(node, ord) AS node FROM mm WHERE NOT contains(parent, '\\') GROUP BY ALL), b AS (SELECT bare AS c, method AS f, arg_min(node, ord) AS node FROM mm GROUP BY ALL)
SELECT h.id, h.handler, coalesce(a.node, b.node) AS node FROM h LEFT JOIN a USING (c, f) LEFT JOIN b USING (c, f)""")
def q80_handlers(spark, sf_dir):
    return codegraph.resolved_handlers(_handlers(spark, sf_dir), _methods(spark, sf_dir))


def _handlers(spark, sf_dir):
    k = F.col("p_partkey")
    handler = F.when(k % 5 == 0, "(closure)@m1").when(k % 5 == 1, "no separator").otherwise(F.concat(_f("X\\C%d", "p_size"), F.when(k % 2 == 0, "@").otherwise("::"), _f("m%d", k % 15)))
    return table(spark, sf_dir, "part").select(k.alias("id"), handler.alias("handler"))


def _called(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    callee = F.when(F.col("l_partkey") % 4 == 0, _f("f%d", F.col("l_partkey") % 30)).when(F.col("l_partkey") % 4 == 1, _f("m%d", F.col("l_partkey") % 12)).when(F.col("l_partkey") % 4 == 2, "strlen").otherwise(_f("ext%d", F.col("l_suppkey") % 9))
    calls = li.select(F.when(F.col("l_linenumber") == 1, "GLOBAL_SCRIPT").otherwise(_f("f%d", F.col("l_linenumber"))).alias("caller"), callee.alias("callee"), _f("c%d.php", F.col("l_orderkey") % 40).alias("file"))
    functions = table(spark, sf_dir, "part").select(_f("f%d", F.col("p_partkey") % 20).alias("name"), _f("c%d.php", F.col("p_size")).alias("file"), F.col("p_partkey").alias("ord"))
    return calls, functions


_CALLS = """c AS (SELECT DISTINCT CASE WHEN l_linenumber = 1 THEN 'GLOBAL_SCRIPT' ELSE 'f' || l_linenumber END AS caller, CASE l_partkey % 4 WHEN 0 THEN 'f' || l_partkey % 30 WHEN 1 THEN 'm' || l_partkey % 12 WHEN 2 THEN 'strlen' ELSE 'ext' || l_suppkey % 9 END AS callee, 'c' || l_orderkey % 40 || '.php' AS file FROM lineitem),
f AS (SELECT 'f' || p_partkey % 20 AS name, 'c' || p_size || '.php' AS file, p_partkey AS ord FROM part), fs AS (SELECT DISTINCT name, file, file || '::' || name AS node FROM f), fa AS (SELECT name, arg_min(file, ord) || '::' || name AS node FROM f GROUP BY name),
ms AS (SELECT method, file, arg_min(node, ord) AS node FROM mm GROUP BY ALL), ma AS (SELECT method, arg_min(node, ord) AS node FROM mm GROUP BY ALL),
calls AS (SELECT DISTINCT coalesce(k.node, ka.node, c.file) AS caller, coalesce(fs.node, fa.node, ms.node, ma.node, 'EXTCALL:' || c.callee) AS callee FROM c LEFT JOIN fs ON fs.name = c.callee AND fs.file = c.file LEFT JOIN fa ON fa.name = c.callee LEFT JOIN ms ON ms.method = c.callee AND ms.file = c.file LEFT JOIN ma ON ma.method = c.callee LEFT JOIN fs k ON k.name = c.caller AND k.file = c.file LEFT JOIN fa ka ON ka.name = c.caller WHERE NOT (c.callee = 'strlen'))"""


@query(f"WITH {_METHODS}, {_CALLS} SELECT * FROM calls")
def q81_calls(spark, sf_dir):
    return _resolved(spark, sf_dir)


def _resolved(spark, sf_dir):
    calls, functions = _called(spark, sf_dir)
    return codegraph.resolved_calls(calls, functions, _methods(spark, sf_dir), spark.createDataFrame([("strlen",), ("count",)], "name string"))


def _graph(spark, sf_dir):
    methods, (_, functions) = _methods(spark, sf_dir), _called(spark, sf_dir)
    files = functions.select("file").distinct()
    classes = methods.select(F.col("parent").alias("name"), "file").distinct()
    routes = codegraph.resolved_handlers(_handlers(spark, sf_dir), methods).select(F.lit("get").alias("method"), _f("/p/%d", "id").alias("route"), F.lit("web.php").alias("file"), "node")
    s = table(spark, sf_dir, "supplier")
    sql = s.select(_f("c%d.php", F.col("s_suppkey") % 40).alias("file"), F.lit("Select").alias("operation"), _f("T%d", "s_nationkey").alias("table"))
    includes = s.select(_f("c%d.php", F.col("s_suppkey") % 40).alias("file"), _f("c%d.php", "s_nationkey").alias("target"))
    redirects = s.select(_f("c%d.php", F.col("s_suppkey") % 40).alias("file"), _f("r%d.php", "s_nationkey").alias("target"))
    return codegraph.code_graph(files, classes, methods, functions, routes, includes, sql, redirects, _resolved(spark, sf_dir))


_GRAPH = f"""{_METHODS}, {_CALLS}, h AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 5 > 1 THEN 'C' || p_size END AS c, 'm' || p_partkey % 15 AS f FROM part),
a AS (SELECT parent AS c, method AS f, arg_min(node, ord) AS node FROM mm WHERE NOT contains(parent, '\\') GROUP BY ALL), b AS (SELECT bare AS c, method AS f, arg_min(node, ord) AS node FROM mm GROUP BY ALL),
rt AS (SELECT 'ROUTE:GET /p/' || h.id AS id, coalesce(a.node, b.node) AS node FROM h LEFT JOIN a USING (c, f) LEFT JOIN b USING (c, f)), s AS (SELECT 'c' || s_suppkey % 40 || '.php' AS file, s_nationkey AS n FROM supplier),
e AS (SELECT DISTINCT * FROM (SELECT file AS source, parent AS target, 'defines' AS type FROM mm UNION ALL SELECT parent, node, 'has_member' FROM mm UNION ALL SELECT file, file || '::' || name, 'defines' FROM f UNION ALL SELECT 'web.php', id, 'registers' FROM rt UNION ALL SELECT id, node, 'handles' FROM rt WHERE node IS NOT NULL
UNION ALL SELECT file, 'c' || n || '.php', 'includes' FROM s UNION ALL SELECT file, 'SQL:SELECT t' || n, 'executes' FROM s UNION ALL SELECT 'SQL:SELECT t' || n, 'TABLE:t' || n, 'queries' FROM s UNION ALL SELECT file, 'r' || n || '.php', 'redirects_to' FROM s UNION ALL SELECT caller, callee, 'calls' FROM calls)),
nn AS (SELECT 0 AS ord, file AS id, 'file' AS type FROM f UNION ALL SELECT 1, parent, 'class' FROM mm UNION ALL SELECT 2, node, 'method' FROM mm UNION ALL SELECT 3, file || '::' || name, 'function' FROM f UNION ALL SELECT 4, id, 'route' FROM rt UNION ALL SELECT 5, 'SQL:SELECT t' || n, 'sql_query' FROM s UNION ALL SELECT 6, 'TABLE:t' || n, 'db_table' FROM s UNION ALL SELECT 7, callee, 'external_function' FROM calls WHERE starts_with(callee, 'EXTCALL:') UNION ALL SELECT 99, source, 'unknown' FROM e UNION ALL SELECT 99, target, 'unknown' FROM e)"""


@query(f"WITH {_GRAPH} SELECT source, target, type FROM e")
def q82_code_edges(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


@query(f"WITH {_GRAPH} SELECT id, arg_min(type, ord) AS type FROM nn GROUP BY id")
def q82b_code_nodes(spark, sf_dir):
    return _graph(spark, sf_dir)[0].select("id", "type")


@query("""SELECT CASE type WHEN 'has_many' THEN 'belongs_to' WHEN 'has_one' THEN 'belongs_to' WHEN 'belongs_to' THEN 'has_many' ELSE type END AS inverse, count(*) AS n FROM (SELECT ['has_many', 'has_one', 'belongs_to', 'many_to_many'][p_size % 4 + 1] AS type FROM part) GROUP BY 1""")
def q82c_inverse_names(spark, sf_dir):
    kind = F.element_at(F.array(*map(F.lit, ("has_many", "has_one", "belongs_to", "many_to_many"))), (F.col("p_size") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "part").groupBy(codegraph.inverse(kind).alias("inverse")).agg(F.count("*").alias("n"))


_CHAIN = """d AS (SELECT DISTINCT 'k' || l_partkey % 60 AS source, 'k' || (l_partkey % 60 + l_suppkey % 3 + 1) AS target FROM lineitem WHERE l_quantity > 48), r AS (SELECT '/p/' || p_partkey AS route, 'k' || p_partkey % 60 AS controller, p_size > 25 AS guarded FROM part),
s0 AS (SELECT DISTINCT controller AS id, controller AS w FROM r), s1 AS (SELECT id, w FROM s0 UNION SELECT s0.id, d.target FROM s0 JOIN d ON d.source = s0.w), s2 AS (SELECT id, w FROM s1 UNION SELECT s1.id, d.target FROM s1 JOIN d ON d.source = s1.w), s3 AS (SELECT id, w FROM s2 UNION SELECT s2.id, d.target FROM s2 JOIN d ON d.source = s2.w),
q AS (SELECT DISTINCT 'k' || c_custkey % 70 AS class, 'SELECT ' || lower(c_mktsegment) AS v FROM customer WHERE c_custkey % 3 = 0), t AS (SELECT DISTINCT 'k' || s_suppkey % 70 AS class, 'r' || s_nationkey || '.php' AS v FROM supplier)"""


@query(f"""WITH {_CHAIN}, us AS (SELECT id, string_agg(w, ',' ORDER BY w) AS v FROM s3 WHERE w <> id GROUP BY id), qs AS (SELECT id, array_to_string(list_sort(list_distinct(list(v)))[1:6], ',') AS v FROM s3 JOIN q ON q.class = s3.w GROUP BY id), ts AS (SELECT id, array_to_string(list_sort(list_distinct(list(v)))[1:6], ',') AS v FROM s3 JOIN t ON t.class = s3.w GROUP BY id)
SELECT route, controller, coalesce(us.v, '') AS services, coalesce(qs.v, '') AS operations, coalesce(ts.v, '') AS redirects, round(least(0.85, 0.25 + 0.1 * ((us.v IS NOT NULL)::INT + (qs.v IS NOT NULL)::INT + (ts.v IS NOT NULL)::INT + guarded::INT)), 4)::DOUBLE AS confidence FROM r LEFT JOIN us ON us.id = controller LEFT JOIN qs ON qs.id = controller LEFT JOIN ts ON ts.id = controller""")
def q83_route_chains(spark, sf_dir):
    li, c, s, p = (table(spark, sf_dir, n) for n in ("lineitem", "customer", "supplier", "part"))
    routes = p.select(_f("/p/%d", "p_partkey").alias("route"), _f("k%d", F.col("p_partkey") % 60).alias("controller"), (F.col("p_size") > 25).alias("guarded"))
    services = li.where("l_quantity > 48").select(_f("k%d", F.col("l_partkey") % 60).alias("source"), _f("k%d", F.col("l_partkey") % 60 + F.col("l_suppkey") % 3 + 1).alias("target"))
    sql = c.where("c_custkey % 3 = 0").select(_f("k%d", F.col("c_custkey") % 70).alias("class"), F.concat(F.lit("SELECT "), F.lower("c_mktsegment")).alias("operation"))
    redirects = s.select(_f("k%d", F.col("s_suppkey") % 70).alias("class"), _f("r%d.php", "s_nationkey").alias("target"))
    return codegraph.route_chains(routes, services, sql, redirects)


_API = """d AS (SELECT DISTINCT 'h' || l_partkey % 50 AS caller, CASE WHEN l_partkey % 50 > 45 AND l_suppkey % 2 = 0 THEN 'EXTCALL:json_encode' ELSE 'h' || (l_partkey % 50 + 7) END AS callee FROM lineitem),
r AS (SELECT p_partkey AS id, CASE WHEN p_size % 7 = 0 THEN '/API/p' ELSE '/p' END AS route, CASE WHEN p_size % 5 = 0 THEN [' JWT '] ELSE ['web'] END AS mw, CASE WHEN p_size % 11 = 0 THEN 'routes/api.php' ELSE 'routes/web.php' END AS file, CASE WHEN p_size % 2 = 0 THEN 'A@getJson' ELSE 'A@run' END AS handler, 'h' || p_partkey % 60 AS node FROM part),
j1 AS (SELECT DISTINCT caller AS n FROM d WHERE callee = 'EXTCALL:json_encode'), j2 AS (SELECT n FROM j1 UNION SELECT caller FROM d JOIN j1 ON callee = n), j3 AS (SELECT n FROM j2 UNION SELECT caller FROM d JOIN j2 ON callee = n), j4 AS (SELECT n FROM j3 UNION SELECT caller FROM d JOIN j3 ON callee = n)"""


@query(f"""WITH {_API}, x AS (SELECT id, contains(lower(route), '/api') AS a, len(list_filter(mw, lambda m: lower(trim(m)) = 'jwt')) > 0 AS b, file = 'routes/api.php' AS c, handler = 'A@getJson' AS h, node IN (SELECT n FROM j4) AS j FROM r)
SELECT id, concat_ws(',', CASE WHEN a THEN 'path_prefix' END, CASE WHEN b THEN 'middleware' END, CASE WHEN c THEN 'api_route_file' END, CASE WHEN h THEN 'handler_name' END, CASE WHEN j THEN 'reachable_json' END) AS signals, a OR b OR c OR j AS is_api FROM x""")
def q84_api_routes(spark, sf_dir):
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    k, z = F.col("l_partkey") % 50, F.col("p_size")
    calls = li.select(_f("h%d", k).alias("caller"), F.when((k > 45) & (F.col("l_suppkey") % 2 == 0), "EXTCALL:json_encode").otherwise(_f("h%d", k + 7)).alias("callee")).distinct()
    routes = p.select(F.col("p_partkey").alias("id"), F.when(z % 7 == 0, "/API/p").otherwise("/p").alias("route"), F.when(z % 5 == 0, F.array(F.lit(" JWT "))).otherwise(F.array(F.lit("web"))).alias("middleware"), F.when(z % 11 == 0, "routes/api.php").otherwise("routes/web.php").alias("file"), F.when(z % 2 == 0, "A@getJson").otherwise("A@run").alias("handler"), _f("h%d", F.col("p_partkey") % 60).alias("node"))
    return codegraph.api_routes(routes, calls)


@query("""WITH f AS (SELECT DISTINCT 's' || s_suppkey AS id FROM supplier), c AS (SELECT 's' || l_suppkey AS id, list_sort(list_distinct(list('o' || l_orderkey)))[1:8] AS v FROM lineitem WHERE l_quantity > 45 GROUP BY 1), r AS (SELECT 's' || l_suppkey AS id, list_sort(list_distinct(list('p' || l_partkey)))[1:10] AS v FROM lineitem WHERE l_discount > 0.08 GROUP BY 1), t AS (SELECT 's' || s_suppkey AS id, list_sort(list_distinct(list('n' || s_nationkey)))[1:8] AS v FROM supplier GROUP BY 1)
SELECT 'file' AS kind, f.id, concat_ws(';', 'calls=' || array_to_string(c.v, ','), 'rules=' || array_to_string(r.v, ','), 'tables=' || array_to_string(t.v, ',')) AS facts FROM f LEFT JOIN c USING (id) LEFT JOIN r USING (id) LEFT JOIN t USING (id)
UNION ALL SELECT 'entity', p_brand, 'columns=' || array_to_string(list_sort(list_distinct(list(p_type)))[1:8], ',') FROM part GROUP BY p_brand""")
def q85_context_index(spark, sf_dir):
    li, s, p = (table(spark, sf_dir, n) for n in ("lineitem", "supplier", "part"))
    file = lambda c: _f("s%d", c).alias("file")
    calls = li.where("l_quantity > 45").select(file("l_suppkey"), _f("o%d", "l_orderkey").alias("callee"))
    rule = li.where("l_discount > 0.08").select(file("l_suppkey"), _f("p%d", "l_partkey").alias("rule"))
    return codegraph.context_index(s.select(file("s_suppkey")), calls, rule, p.select(F.col("p_brand").alias("table"), F.col("p_type").alias("column")), s.select(file("s_suppkey"), _f("n%d", "s_nationkey").alias("table")))


# --- handlers ---


def _laravel(spark, sf_dir):
    text = F.concat(_f("class P%dController {\n  /** Store it.\n   * more */\n  public function store(Request $request) {\n", "p_partkey"), F.lit("    $n = $request->input('name'); if (Auth::check()) { Item::create(['n' => '}']); }\n    return redirect('/x');\n  }\n"), _f("  public function show($id): View {\n    $p = Part%d::find($id); return view('p');\n  }\n}", "p_size"))
    return _file(table(spark, sf_dir, "part"), _f("P%d.php", "p_partkey"), text)


@query("""SELECT 'P' || p_partkey || '.php' AS path, h.o AS ord, h.n AS name, CASE h.o WHEN 0 THEN 'guard guard; read name; do Item::create; give redirect' ELSE 'do Part' || p_size || '::find; give view' END AS steps FROM part, LATERAL (SELECT unnest([{'o': 0, 'n': 'store'}, {'o': 1, 'n': 'show'}]) AS h)""")
def q110_laravel_paths(spark, sf_dir):
    found = handlers.paths(handlers.bodies(_laravel(spark, sf_dir), "php"), "php")
    return handlers.happy_path(found).join(found.select("path", "ord", "name"), ["path", "ord"]).select("path", "ord", "name", "steps")


@query("""SELECT 'r' || p_partkey || '.ts' AS path, upper(CASE WHEN p_size % 2 = 0 THEN 'post' ELSE 'get' END) AS verb, '/p/' || p_partkey AS route, 'guard session_user; read qty; do prisma.part.create; give json' AS steps FROM part""")
def q110b_express_paths(spark, sf_dir):
    text = F.concat(F.lit("router."), F.when(F.col("p_size") % 2 == 0, "post").otherwise("get"), _f("('/p/%d', requireAuth, async (req, res) => {\n", "p_partkey"), F.lit("  if (!req.user) { return; }\n  const q = req.body.qty;\n  await prisma.part.create({ data: { q } });\n  res.status(201).json({ a: '}' });\n});\nfunction other() {}"))
    found = handlers.paths(handlers.bodies(_file(table(spark, sf_dir, "part"), _f("r%d.ts", "p_partkey"), text), "typescript"), "typescript")
    return found.select("path", "ord", "verb", "route").join(handlers.happy_path(found), ["path", "ord"]).drop("ord")


@query("""SELECT 'C' || p_partkey || '.java' AS path, v.v AS verb, v.r AS route, v.n AS name, v.e AS effects FROM part, LATERAL (SELECT unnest([{'v': 'GET', 'r': '/p/' || p_partkey, 'n': 'one', 'e': 'partService.find'}, {'v': 'ANY', 'r': '/all', 'n': 'all', 'e': ''}]) AS v)""")
def q110c_spring_paths(spark, sf_dir):
    text = F.concat(_f("@RestController\npublic class C%d {\n  @GetMapping(\"/p/%d\")\n", "p_partkey", "p_partkey"), F.lit("  @ResponseBody\n  public Part one(@PathVariable String id) {\n    return partService.find(id);\n  }\n  @RequestMapping(\"/all\")\n  public String all() { return \"}\"; }\n}"))
    found = handlers.paths(handlers.bodies(_file(table(spark, sf_dir, "part"), _f("C%d.java", "p_partkey"), text), "java"), "java")
    return found.select("path", "verb", "route", "name", F.array_join("effects", ",").alias("effects"))


@query("""SELECT 'a' || s_suppkey || '.ts' AS path, unnest([['passport'], ['jwt', 'bearer'], ['nestjs_guard'], ['supabase_auth', 'clerk_auth']][s_suppkey % 4 + 1]) AS kind FROM supplier UNION ALL SELECT 'a' || s_suppkey || '.java', unnest([['pre_authorize', 'role_check'], ['secured'], [], ['jwt']][s_suppkey % 4 + 1]) FROM supplier""")
def q111_auth_signals(spark, sf_dir):
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), (F.col("s_suppkey") % 4 + 1).cast("int"))
    s = table(spark, sf_dir, "supplier")
    ts = _file(s, _f("a%d.ts", "s_suppkey"), pick("passport.authenticate('x')", "jwt.verify(t) // Bearer  token", "@UseGuards(X)", "supabase.auth.signInWithOtp()"))
    java = _file(s, _f("a%d.java", "s_suppkey"), pick("@PreAuthorize(\"hasRole('A')\")", "@Secured(\"x\")", "nothing", "parseClaimsJws(t)"))
    return handlers.auth_signals(ts, "typescript").unionByName(handlers.auth_signals(java, "java"))


@query("""SELECT 'd' || s_suppkey || '.ts' AS path, unnest(['S' || s_nationkey || 'Service', 'Mailer']) AS depends_on FROM supplier UNION ALL SELECT 'd' || s_suppkey || '.java', unnest(['N' || s_nationkey || 'Repository', 'Clock']) FROM supplier UNION ALL SELECT 'd' || s_suppkey || '.php', 'Repo' || s_nationkey FROM supplier""")
def q111b_injected_services(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    ts = _file(s, _f("d%d.ts", "s_suppkey"), _f("constructor(private readonly a: S%dService, public m: Mailer, plain: string) {}", "s_nationkey"))
    java = _file(s, _f("d%d.java", "s_suppkey"), _f("public D(N%dRepository r, String s, Clock c) {}", "s_nationkey"))
    php = _file(s, _f("d%d.php", "s_suppkey"), _f("public function __construct(private App\\Repo%d $r, int $n) {}", "s_nationkey"))
    return handlers.injected(ts, "typescript").unionByName(handlers.injected(java, "java")).unionByName(handlers.injected(php, "php"))


@query("""SELECT 'i' || s_suppkey || '.ts' AS path, i.s AS source, i.k AS key FROM supplier, LATERAL (SELECT unnest([{'s': 'body', 'k': 'f' || s_nationkey}, {'s': 'query', 'k': 'page'}, {'s': 'body', 'k': 'email'}, {'s': 'body', 'k': 'pass'}]) AS i) UNION ALL SELECT 'i' || s_suppkey || '.java', i.s, i.k FROM supplier, LATERAL (SELECT unnest([{'s': 'body', 'k': 'dto'}, {'s': 'query', 'k': 'q' || s_nationkey}, {'s': 'path', 'k': 'id'}]) AS i)""")
def q111c_inputs(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    ts = _file(s, _f("i%d.ts", "s_suppkey"), _f("const a = req.body.f%d + req.query.page + req.query.page; const { email, pass } = req.body;", "s_nationkey"))
    java = _file(s, _f("i%d.java", "s_suppkey"), _f("f(@RequestBody Dto dto, @RequestParam(\"q\") String q%d, @PathVariable Long id)", "s_nationkey"))
    return handlers.inputs(ts, "typescript").unionByName(handlers.inputs(java, "java"))


@query("""SELECT 'J' || s_suppkey || '.java' AS path, 'K' || s_suppkey AS name, ['controller', 'model', 'service', 'class'][s_suppkey % 4 + 1] AS role FROM supplier""")
def q111d_java_classes(spark, sf_dir):
    note = F.element_at(F.array(*map(F.lit, ("@RestController\n@RequestMapping(\"/x\")\n", "@Entity\n@Table(name = \"t\")\n", "@Service\n", "")), ), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return handlers.java_classes(_file(table(spark, sf_dir, "supplier"), _f("J%d.java", "s_suppkey"), F.concat(F.lit("import a.b;\n"), note, _f("public final class K%d {}", "s_suppkey"))))


@query("""SELECT 'web' || n_nationkey || '.php' AS path, l.o AS line, l.v AS verb, l.u AS uri, l.c AS controller, l.a AS action, l.m AS middleware, l.m IN ('auth', 'auth:api') AS login FROM nation, LATERAL (SELECT unnest([{'o': 0, 'v': 'GET', 'u': '/n/' || n_nationkey, 'c': 'HomeController', 'a': 'index', 'm': 'auth'}, {'o': 1, 'v': 'POST', 'u': '/s', 'c': 'SController', 'a': 'store', 'm': ''}, {'o': 2, 'v': 'DELETE', 'u': '/i', 'c': 'Invoked', 'a': '__invoke', 'm': 'auth:api'}, {'o': 3, 'v': 'ANY', 'u': '/z', 'c': '', 'a': '__invoke', 'm': 'log'}]) AS l)""")
def q112_route_files(spark, sf_dir):
    text = F.concat(_f("Route::get('/n/%d', 'HomeController@index')->middleware('auth');\n", "n_nationkey"), F.lit("Route::post('/s', [App\\SController::class, 'store']);\nRoute::delete('/i', \\App\\Invoked::class)->middleware('auth:api');\nRoute::any('/z', function () { })->middleware('log');"))
    return handlers.route_file(_file(table(spark, sf_dir, "nation"), _f("web%d.php", "n_nationkey"), text))


@query("""SELECT 'g' || n_nationkey || '.php' AS path, g.v AS verb, g.u AS uri FROM nation, LATERAL (SELECT unnest([{'v': 'GET', 'u': '/r' || n_regionkey || '/list'}, {'v': 'POST', 'u': '/r' || n_regionkey}]) AS g)""")
def q112b_group_prefixes(spark, sf_dir):
    text = _f("Route::get('/out', 'A@b');\nRoute::middleware('auth')->prefix('/r%d/')->group(function () {\n  Route::get('list', 'A@l');\n  Route::post('/', 'A@s');\n});", "n_regionkey")
    return handlers.group_prefixes(_file(table(spark, sf_dir, "nation"), _f("g%d.php", "n_nationkey"), text))


@query("""SELECT 'y' || n_nationkey || '.php' AS path, g.v AS verb, g.u AS uri, g.n AS name FROM nation, LATERAL (SELECT unnest([{'v': 'GET', 'u': '/s/' || n_nationkey, 'n': 'show'}, {'v': 'POST', 'u': '/s/' || n_nationkey, 'n': 'show'}, {'v': 'ANY', 'u': '/t', 'n': 'every'}]) AS g)""")
def q112c_attribute_routes(spark, sf_dir):
    text = _f("#[Route('/s/%d', name: 's', methods: ['GET', 'POST'])]\npublic function show() {}\n#[Route('/t')]\npublic function every() {}", "n_nationkey")
    return handlers.attribute_routes(_file(table(spark, sf_dir, "nation"), _f("y%d.php", "n_nationkey"), text))


@query("""SELECT 'w' || n_nationkey || '.php' AS path, h.k AS kind, h.h AS hook, h.c AS callback FROM nation, LATERAL (SELECT unnest([{'k': 'action', 'h': 'init', 'c': 'run' || n_nationkey}, {'k': 'filter', 'h': 'the_title', 'c': 'f'}, {'k': 'rest', 'h': '/shop/v1/n' || n_nationkey, 'c': ''}]) AS h)""")
def q112d_hooks(spark, sf_dir):
    text = _f("add_action('init', 'run%d'); add_filter( 'the_title', 'f', 10 ); register_rest_route('shop/v1', '/n%d', []);", "n_nationkey", "n_nationkey")
    return handlers.hooks(_file(table(spark, sf_dir, "nation"), _f("w%d.php", "n_nationkey"), text))


@query("""SELECT 'v' || n_nationkey || '.ts' AS path, v.u AS uri, v.c AS component FROM nation, LATERAL (SELECT unnest([{'u': '/n/' || n_nationkey, 'c': 'N' || n_nationkey}, {'u': '/lazy', 'c': './views/L.vue'}]) AS v)""")
def q112e_vue_routes(spark, sf_dir):
    text = _f("const routes = [{ path: '/n/%d', name: 'n', component: N%d }, { path: '/lazy', component: () => import('./views/L.vue') }]", "n_nationkey", "n_nationkey")
    return handlers.vue_routes(_file(table(spark, sf_dir, "nation"), _f("v%d.ts", "n_nationkey"), text))


@query("""SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'c' || n_nationkey || '.vue' ELSE 'c' || n_nationkey || '.tsx' END AS path, CASE WHEN n_nationkey % 2 = 0 THEN 'title,n' || n_nationkey ELSE 'a,b' END AS props, CASE WHEN n_nationkey % 2 = 0 THEN 'save,close' ELSE '' END AS emits FROM nation""")
def q112f_component_facts(spark, sf_dir):
    vue = _f("defineProps<{ title: string; n%d?: number }>(); emit('save', 1); $emit('close'); emit('save')", "n_nationkey")
    even = F.col("n_nationkey") % 2 == 0
    return handlers.component_facts(_file(table(spark, sf_dir, "nation"), F.when(even, _f("c%d.vue", "n_nationkey")).otherwise(_f("c%d.tsx", "n_nationkey")), F.when(even, vue).otherwise("export function Card({ a, b }) { return null }")))


@query("""SELECT 'g' || s_suppkey || '.php' AS path, '$_' || v.v AS var, v.k AS key, 'list' || s_nationkey || '.php' AS target FROM supplier, LATERAL (SELECT unnest([{'v': 'POST', 'k': 'name'}, {'v': 'SESSION', 'k': 'u' || s_nationkey}]) AS v)""")
def q113_superglobals_and_redirects(spark, sf_dir):
    text = _f("if ($_POST['name'] && $_POST[\"name\"] && $_SESSION['u%d']) { header('Location: list%d.php?x=1'); }", "s_nationkey", "s_nationkey")
    files = _file(table(spark, sf_dir, "supplier"), _f("g%d.php", "s_suppkey"), text)
    return handlers.superglobals(files).join(handlers.redirects(files), "path")


@query("""SELECT 'P' || p_partkey || '.php' AS path, 'P' || p_partkey || 'Controller' AS class, m.n AS name, 'public' AS visibility, m.d AS doc FROM part, LATERAL (SELECT unnest([{'n': 'store', 'd': 'Store it.'}, {'n': 'show', 'd': ''}]) AS m)""")
def q113b_methods(spark, sf_dir):
    return handlers.methods(_laravel(spark, sf_dir))


@query("""SELECT 'f' || p_partkey || '.php' AS path, 'f' || p_partkey AS caller, 'g' || p_partkey % 7 AS callee FROM part UNION ALL SELECT 'f' || p_partkey || '.php', 'GLOBAL_SCRIPT', 'boot' FROM part""")
def q72e_call_graph(spark, sf_dir):
    files = _functions(spark, sf_dir).withColumn("text", F.concat(F.lit("boot(); "), "text"))
    return extract.call_graph(files, spark.createDataFrame([("strlen",), ("getenv",)], "name string"))


@query("""SELECT 'etc/cron.d/n' || n_nationkey AS path, l.s AS schedule, l.c AS command FROM nation, LATERAL (SELECT unnest([{'s': '*/' || n_regionkey + 1 || ' * * * *', 'c': 'php run.php ' || n_nationkey}, {'s': '@daily', 'c': 'backup'}]) AS l)""")
def q76d_cron_lines(spark, sf_dir):
    text = _f("# comment\nPATH=/bin\n*/%d * * * * php run.php %d\n@daily backup\n", F.col("n_regionkey") + 1, "n_nationkey")
    files = _file(table(spark, sf_dir, "nation"), _f("etc/cron.d/n%d", "n_nationkey"), text)
    return extract.cron_lines(files.unionByName(files.select(F.concat("path", F.lit("/no.txt")).alias("path"), "text")))


@query("""SELECT 'z' || n_nationkey || '.ts' AS path, 'schema' AS kind, 'S' || n_nationkey AS owner, f.f AS item, f.t AS type FROM nation, LATERAL (SELECT unnest([{'f': 'email', 't': 'string'}, {'f': 'age', 't': 'number'}]) AS f) UNION ALL SELECT 'z' || n_nationkey || '.ts', m.m, m.e, m.o, '' FROM nation, LATERAL (SELECT unnest([{'m': 'prisma', 'e': 'user' || n_regionkey, 'o': 'findMany'}, {'m': 'typeorm', 'e': 'order', 'o': 'save'}, {'m': 'firestore', 'e': 'carts', 'o': 'getDocs'}]) AS m)""")
def q73d_schemas_and_mappers(spark, sf_dir):
    text = _f("const S%d = z.object({ email: z.string().email(), age: z.number() });\nprisma.user%d.findMany({}); orderRepository.save(o); await getDocs(collection(db, 'carts'));", "n_nationkey", "n_regionkey")
    files = _file(table(spark, sf_dir, "nation"), _f("z%d.ts", "n_nationkey"), text)
    one = handlers.schema_fields(files).select("path", F.lit("schema").alias("kind"), F.col("schema").alias("owner"), F.col("field").alias("item"), "type")
    return one.unionByName(handlers.mapper_calls(files).select("path", F.col("mapper").alias("kind"), F.col("entity").alias("owner"), F.col("operation").alias("item"), F.lit("").alias("type")))
