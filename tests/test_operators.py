"""Operators on small frames: ties, nulls, cycles, empty sets."""

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import keys, text
from sparkloom.operators import coverage, extract, graph, merge, relations, retrieve, rules, states, telemetry, validate
from sparkloom.sources import tables
from sparkloom.streaming import events


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_keys(spark):
    df = spark.createDataFrame([("/a/B.php", "", "UserRole", "category")], "p string, q string, n string, w string")
    r = df.select(keys.basename("p"), keys.present("q", "p"), keys.snake("n"), keys.human("n"), keys.plural(F.col("w")), keys.slug(F.lit("t"), F.lit(" A-b! "))).first()
    assert tuple(r) == ("b.php", "/a/B.php", "user_role", "User Role", "categories", "t:a_b")
    routes = {"/u/{id}": "/u/{*}", "/u/:id/x/": "/u/{*}/x", "/u/12": "/u/{*}", "/o/123e4567-e89b-12d3-a456-426614174000": "/o/{*}", "/": "/", "": "/"}
    got = spark.createDataFrame([(k,) for k in routes], "r string").select("r", keys.normal_route("r")).collect()
    assert {a: b for a, b in got} == routes
    assert [r.id for r in keys.numbered(spark.range(2).withColumnRenamed("id", "x"), "BR-%03d", ["x"]).collect()] == ["BR-001", "BR-002"]


def test_text(spark):
    one = lambda c, t: spark.createDataFrame([(t,)], "t string").select(c(F.col("t"))).first()[0]
    assert one(text.citations, "see [BR-001] and [tr-br-002]") == ["BR-001", "TR-BR-002"]
    assert one(text.paragraphs, "a\n\n\n b \n\n\n") == ["a", "b"]
    assert one(text.headings, "# no\n## One\ntext\n### Two") == ["One", "Two"]
    assert len(one(text.sections, "x\n## A\n1\n## B\n2")) == 3
    assert one(text.name_tokens, "getHTTPUserName") == ["get", "user", "name"]
    assert one(text.sql_fields, "SELECT a, b FROM t") == ["a", "b"]
    assert one(text.json_object, '```json\n{"a": 1}\n```') == '{"a": 1}'
    assert one(text.real_line_feeds, "a\\nb") == "a\nb"
    df = spark.createDataFrame([("user login page", "The login page of a user"), ("one two three four", "one two")], "n string, h string")
    assert [r[0] for r in df.select(text.fuzzy_contains(F.col("n"), F.col("h"))).collect()] == [True, False]


def test_merges(spark):
    df = spark.createDataFrame([("k", 0.5, 1, ["a"]), ("k", 0.9, 3, ["b", "a"]), ("k", 0.9, 2, None), ("z", 0.1, 4, [])], "k string, c double, ord int, s array<string>")
    got = {r.k: r for r in merge.strongest(df.withColumn("who", F.col("ord")), ["k"], "c", "ord", ["who"], ["s"]).collect()}
    assert got["k"].who == 2 and got["k"].s == ["a", "b"] and got["z"].s == []
    assert merge.first_of(df, ["k"], ["ord"]).where("k = 'k'").first().ord == 1
    assert merge.last_of(df, ["k"], "ord").where("k = 'k'").first().ord == 3
    cut = merge.budget_cut(spark.createDataFrame([(1, 5), (2, 6), (3, 1)], "o int, s int"), "s", ["o"], 6)
    assert [r.o for r in cut.collect()] == [1]
    votes = merge.plurality(spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (2, "c"), (2, "a")], "i int, g string"), "i", "g")
    assert rows(votes.select("i", "g")) == [(1, "a"), (2, "c")]
    tiers = merge.tiers(spark.createDataFrame([("x", "X"), ("q", "Y")], "a string, b string"), [(F.col("a"), spark.createDataFrame([("x", 1)], "k string, v int"), "k"), (F.col("b"), spark.createDataFrame([("X", 2), ("Y", 3)], "k string, v int"), "k")], "v")
    assert rows(tiers) == [("q", "Y", 3), ("x", "X", 1)]


def test_graph(spark):
    e = spark.createDataFrame([("a", "b", "x"), ("b", "c", "x"), ("c", "a", "x"), ("c", "d", "y"), ("a", "b", "y")], "source string, target string, type string")
    start = spark.createDataFrame([("a",)], "id string")
    assert rows(graph.reachable(e, start, 9)) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]
    assert rows(graph.reachable(e, start, 1)) == [("a", 0), ("b", 1)]
    n = spark.createDataFrame([(i, "t", i.upper()) for i in "abcde"], "id string, type string, label string")
    assert rows(graph.typed_hops(n, e, graph.seeds(n, "T", "A"), [("x", "out"), ("x", "out")]).select("id")) == [("c",)]
    assert graph.typed_hops(n, e, start, [("none", "out")]).count() == 0
    assert rows(graph.typed_hops(n, e, start, []).select("id")) == [("a",)]
    assert rows(graph.unreachable(n, e, start).select("id")) == [("e",)]
    assert {r.id: len(r.path) for r in graph.shortest_paths(e, start, 8).collect()} == {"a": 1, "b": 2, "c": 3, "d": 4}
    assert graph.upsert_edges(e.withColumn("ord", F.monotonically_increasing_id()), one_type=True).count() == 4
    assert {r.community for r in graph.min_labels(e, 5).collect()} == {"a"}


def test_states(spark):
    s = spark.createDataFrame([(x,) for x in "abcpqz"], "state string")
    m = spark.createDataFrame([("a", "b"), ("b", "c"), ("p", "q"), ("q", "p")], "from_state string, to_state string")
    got = {r.state: (r.initial, r.terminal, r.dead) for r in states.machine(s, m).collect()}
    assert got == {"a": (True, False, False), "b": (False, False, False), "c": (False, True, False), "p": (False, False, True), "q": (False, False, True), "z": (True, True, False)}
    f = spark.createDataFrame([("f", 1, "new"), ("f", 30, "paid"), ("f", 90, "sent")], "file string, line int, v string")
    assert rows(states.consecutive(f, ["file"], ["line"], "v", "line", 40).select("from_state", "to_state")) == [("new", "paid")]


def test_coverage(spark):
    df = spark.createDataFrame([("g", 1, True), ("g", 2, False), ("h", 3, False)], "g string, k int, covered boolean")
    got = {r.g: r for r in coverage.coverage(df, ["g"], "k").collect()}
    assert (got["g"].pct, got["g"].status, got["g"].missing) == (0.5, "warn", "2") and got["h"].status == "fail"
    empty = spark.createDataFrame([], "covered int, total int")
    assert coverage.micro(empty).first().micro is None or coverage.micro(empty).first().micro == 1.0
    assert spark.range(1).select(coverage.ratio(F.lit(0), F.lit(0), 1.0)).first()[0] == 1.0


def test_rules_and_checks(spark):
    r = spark.createDataFrame([(1, "a", 0.95), (2, "b", 0.15)], "id int, category string, confidence double")
    e = spark.createDataFrame([(1, "x"), (1, "y"), (1, "other")], "id int, stream string")
    got = {t.id: (t.status, t.confidence) for t in rules.triangulated(r, e, "id", {"a": ["x", "y"], "b": ["x"]}).collect()}
    assert got == {1: ("STRONG", 0.97), 2: ("WEAK", 0.1)}
    refs, known = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1,)], "k int")
    assert rows(validate.unknown(refs, known, "k").select("k")) == [(2,)]
    assert validate.unknown(refs, known.limit(0), "k").count() == 0
    lists = spark.createDataFrame([(["a", "b"],)], "x array<string>")
    assert validate.unknown_items(lists, "x", spark.createDataFrame([("a",)], "k string"), "k").first().x == ["a"]
    assert validate.unknown_items(lists, "x", spark.createDataFrame([], "k string"), "k").first().x == ["a", "b"]
    v = validate.verdict(spark.createDataFrame([("major",)] * 3, "severity string"), 2, 5).first()
    assert v.status == "warn"


def test_retrieval(spark):
    d = spark.createDataFrame([(1, ["cat", "dog"]), (2, ["cat", "cat"]), (3, ["fish"])], "id int, terms array<string>")
    q = spark.createDataFrame([(0, ["cat", "none"])], "query int, terms array<string>")
    got = {r.id: r.score for r in retrieve.bm25(d, q).collect()}
    assert set(got) == {1, 2} and got[2] > got[1] > 0
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, [1.0, 0.0])], "id int, embedding array<double>")
    near = retrieve.cosine_neighbours(v, v.where("id = 1").select(F.col("id").alias("query"), "embedding"), 2)
    assert rows(near.select("id", "distance")) == [(1, 0.0), (4, 0.0)]


@pytest.fixture(scope="module")
def sources(spark):
    php = """<?php
class UserController extends Controller {
  public function index($a, $b): array { if (!auth()) { header('Location: /login'); exit; } $q = "SELECT id, name FROM users WHERE x = 1"; return helper($q); }
}
Route::get('/users', [UserController::class, 'index']);
Route::resource('/posts', PostController::class)->except(['destroy']);
Schema::create('users', function ($table) { $table->string('email')->unique(); $table->text('bio')->nullable(); });
$x = env('APP_KEY'); require 'lib/a.php';
"""
    ts = "export async function GET() {}\nexport const POST = 1;\nimport { z } from 'zod';\nprocess.env.API_URL"
    page = "export default function Page() { const [a] = useState(0); return <Card/>; }"
    html = "<form action='/login' method='post'><input name='email'><input name='password' type='password'></form>"
    return spark.createDataFrame([("app/Http/UserController.php", php), ("src/app/users/[id]/route.ts", ts), ("src/app/(main)/page.tsx", page), ("views/login.html", html), ("artisan", "x")], "path string, text string")


def test_extraction(spark, sources):
    assert extract.language(sources).first().language in ("php", "typescript") and extract.framework(sources).first().framework == "laravel"
    assert ("UserController", "Controller") in rows(extract.classes(sources).select("name", "parent"))
    assert ("GET", "/users", "UserController@index") in rows(extract.routes(sources).select("method", "route", "handler"))
    assert {r.handler.split("@")[1] for r in extract.resource_routes(sources).collect()} == {"index", "create", "store", "show", "edit", "update"}
    assert rows(extract.file_routes(sources).select("method", "route", "kind")) == [("GET", "/", "page"), ("GET", "/users/:id", "api"), ("POST", "/users/:id", "api")]
    assert rows(extract.sql_facts(sources).select("operation", "table")) == [("SELECT", "users")]
    assert rows(extract.migration_columns(sources).select("column", "nullable", "unique")) == [("bio", True, False), ("email", False, True)]
    assert rows(extract.env_vars(sources).select("name")) == [("API_URL",), ("APP_KEY",)]
    assert rows(extract.form_fields(sources).select("method", "field", "type")) == [("POST", "email", "input"), ("POST", "password", "password")]
    guard = [r for r in extract.execution_paths(sources).collect() if r.condition == "!auth()"]
    assert guard and guard[0].guard and "exit" in guard[0].body
    assert {r.target for r in extract.imports(sources).collect()} == {"lib/a.php", "zod"}
    assert "Card" in {c for r in extract.components(sources).collect() for c in r.children}
    ddl = spark.createDataFrame([("CREATE TABLE t (id INT NOT NULL, price DECIMAL(10,2) DEFAULT 0, PRIMARY KEY (id))",)], "sql string")
    assert rows(extract.create_table_columns(ddl).select("column", "type", "nullable")) == [("id", "int", False), ("price", "decimal(10,2)", True)]


def test_blocks_loops_and_json(spark):
    d = spark.createDataFrame([(1, "# H\n\ntext\n```\n# code\n```\n- item\n| a |")], "id int, text string")
    assert [r.kind for r in extract.markdown_blocks(d, ["id"]).orderBy("ord").collect()] == ["heading", "blank", "paragraph", "code", "code", "code", "list", "table"]
    loop = "".join(chr(97 + i % 26) + str(i) for i in range(60))[:150] * 4
    got = {r.id: (r.cut_at, len(r.text)) for r in extract.without_loops(spark.createDataFrame([(1, loop), (2, "short"), (3, None)], "id int, text string").na.fill("")).collect()}
    assert got[1] == (150, 150) and got[2] == (None, 5)
    whole = extract.closed_json(spark.createDataFrame([('{"a": [1, {"b": "x',)], "text string")).first().whole
    assert whole == '{"a": [1, {"b": "x"}]}'
    assert spark.range(1).select(extract.sequence_ratio(F.lit("abcd"), F.lit("bcde"))).first()[0] == 0.75


def test_relations_and_telemetry(spark):
    sql = spark.createDataFrame([("select * from orders o join users u on u.id = o.user_id join `items` using (id)",)], "sql string")
    assert rows(relations.sql_joins(sql)) == [("orders", "items"), ("orders", "users")]
    s = spark.createDataFrame([("a", "b", "x_id", "orm", 0.85), ("a", "b", "x_id", "fk_explicit", 0.95)], "from_table string, to_table string, via string, signal string, confidence double")
    r = relations.merged(s).first()
    assert r.confidence == 0.95 and r.signals == ["fk_explicit", "orm"]
    t = spark.createDataFrame([("s", -1, 2.0), ("s", 5, 4.0)], "stage string, tokens int, seconds double")
    assert telemetry.rollup(t, ["stage"], ["tokens"]).first().total_tokens == 5


def test_sources_and_streams(spark, tmp_path):
    (tmp_path / "src" / "vendor").mkdir(parents=True)
    (tmp_path / "src" / "a.php").write_text("one")
    (tmp_path / "src" / "vendor" / "b.php").write_text("two")
    files = tables.source_files(spark, str(tmp_path / "src"), ["php"])
    assert files.count() == 1
    assert tables.changed(files, files.withColumn("sha1", F.sha1(F.col("text").cast("binary")))).count() == 0
    (tmp_path / "l.jsonl").write_text('{"a": 1}\nbad\n{"a": 2}\n')
    assert tables.json_lines(spark, str(tmp_path / "l.jsonl"), "a int").count() == 2
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    (tmp_path / "ev").mkdir()
    src.repartition(2).write.mode("overwrite").parquet(str(tmp_path / "ev"))
    stream = events.windowed_rollup(events.event_stream(spark, str(tmp_path / "ev"), src.schema))
    out = events.drain(stream, "rollup", str(tmp_path / "ck"))
    assert out.agg(F.sum("calls")).first()[0] == src.count()


def test_long_chain_is_live(spark):
    """A state that is reached in more steps than a fixed depth would allow."""
    n = 70
    moves = spark.createDataFrame([(f"s{i}", f"s{i + 1}") for i in range(n)], "from_state string, to_state string")
    got = {r.state: (r.initial, r.terminal, r.dead) for r in states.machine(spark.createDataFrame([(f"s{i}",) for i in range(n + 1)], "state string"), moves).collect()}
    assert not any(dead for _, _, dead in got.values()) and got["s0"][0] and got[f"s{n}"][1]


def test_blocks_give_what_one_would(spark):
    from sparkloom.operators import merge

    left, right = spark.range(40).withColumnRenamed("id", "a"), spark.range(100).withColumnRenamed("id", "b")
    near = lambda some: right.join(F.broadcast(some), F.col("b") % 40 == F.col("a"))
    assert rows(merge.in_blocks(left, near, 7).select("a", "b")) == rows(merge.in_blocks(left, near).select("a", "b"))


def test_redirect_loops_end(spark):
    from sparkloom.operators import graph

    edges = spark.createDataFrame([("a", "r1"), ("r1", "r2"), ("r2", "r1"), ("r2", "b"), ("b", "c")], "source string, target string")
    through = spark.createDataFrame([("r1",), ("r2",)], "id string")
    assert rows(graph.without_redirects(edges, through).select("source", "target")) == [("a", "b"), ("b", "c")]
    files = spark.createDataFrame([("x/a",), ("x/b",), ("y/c",), ("d",)], "file string")
    assert rows(graph.by_directory(files).select("file", "community")) == [("d", "Misc"), ("x/a", "x"), ("x/b", "x"), ("y/c", "Misc")]


def test_paths_and_sentences(spark):
    from sparkloom.operators import flows, mining

    paths = spark.createDataFrame([(p,) for p in ("/a/b/c", "/a", "/x/7", "/ab", "/q")], "path string")
    routes = spark.createDataFrame([("/a/b/",), ("/x/{id}",), ("/q/r",)], "route string")
    assert rows(flows.known_paths(paths, routes).select("path")) == [("/a",), ("/a/b/c",), ("/q",), ("/x/7",)]
    said = {
        "strlen($p) <= 7": "E must be at least 8 characters", "strlen($p) > 0": "E must not be empty", "strlen($p) >= 9": "E must not exceed 8 characters",
        "!filter_var($x, FILTER_VALIDATE_EMAIL)": "E must be a valid email", "!preg_match('/^[0-9]+$/', $x)": "E must be numeric", "in_array($s, ['a', 'b'])": "E must be one of: 'a', 'b'",
        "$total >= 10": "E must not exceed 9", "$age < 18": "E must be at least 18", "$i > 5": None, "$o->state !== 'closed'": "E must not be in 'closed' state", "$m == 'edit'": None,
        "strtotime($d) < time()": "E must be in the past", "!has_permission('x')": "User must have permission to access E",
    }
    got = {r.c: r.s for r in spark.createDataFrame([(c,) for c in said], "c string").select("c", mining.sentence(F.col("c"), F.lit("E")).alias("s")).collect()}
    assert got == said


def test_artefacts_sessions_and_first_seen(spark, tmp_path):
    rows_ = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    for kind in ("json", "parquet", "csv"):
        tables.write_artefact(rows_, str(tmp_path / kind), kind)
        read = spark.read.format(kind).schema(rows_.schema).load(str(tmp_path / kind))
        assert rows(read.select("i", "s")) == [(1, "a"), (2, "b")]
    made = spark.sql("select * from values (timestamp'2024-01-01 00:00:00', 1, 'x'), (timestamp'2024-01-01 00:10:00', 1, 'x'), (timestamp'2024-01-01 05:00:00', 1, 'x'), (timestamp'2024-01-01 00:05:00', 2, 'y') as t(ts, user_id, k)")
    (tmp_path / "ev").mkdir()
    made.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "ev"))
    stream = lambda: events.event_stream(spark, str(tmp_path / "ev"), made.schema)
    found = events.drain(events.sessions(stream()), "sessions", str(tmp_path / "c1"), "append")
    assert [r.events for r in found.orderBy("user_id", "start").collect()][:1] == [2]
    assert events.drain(events.first_seen(stream(), ["user_id", "k"]), "seen", str(tmp_path / "c2"), "append").count() == 2


def test_stitched_flows_are_made_once(spark):
    """Flows of several ends, redirects given twice, hubs of more flows than a list holds; pairs are made last and not compared."""
    from sparkloom.operators import evidence

    segments = [(i, "home", f"p{i % 3}") for i in range(20)] + [(20, "a", "p0"), (20, "b", "p1"), (21, "a", "x"), (21, None, "p2"), (None, "home", "p0"), (22, "c", None)]
    redirects = [("p0", "home"), ("p0", "home"), ("p1", "a"), ("p1", "home"), ("p2", "b"), ("p0", None), (None, "a"), ("x", "c")]
    want = sorted({(f, g) for f, _, last in segments for file, target in redirects for g, first, _ in segments if None not in (f, g, last, target) and last == file and target == first and f != g})
    given = spark.createDataFrame(segments, "flow int, first string, last string"), spark.createDataFrame(redirects, "file string, target string")
    for most in (1, 3, 256):
        assert sorted(map(tuple, evidence.stitched(*given, most).collect())) == want
    plan = evidence.stitched(*given)._jdf.queryExecution().optimizedPlan().toString()
    assert not {"Aggregate", "Join"} & set(plan[: plan.index("RepartitionByExpression")].replace("[", " ").split())


def test_enriched_features_share_modules(spark):
    """Pages in two modules, features without modules or pages, rows given twice; pages of modules are not moved for each feature."""
    from sparkloom.operators import evidence

    features = [(f, p) for f in range(9) for p in (f, f % 2 + 100, 200 + f % 3)] + [(0, 0), (9, None), (None, 101), (None, 7), (10, 500)]
    modules = [(1, 100), (1, 150), (1, 1), (2, 101), (2, 150), (2, 3), (3, 200), (3, 200), (3, None), (None, 7), (4, 900)]
    of = lambda p: {n for m, q in modules for k, n in modules if None not in (m, p, n) and q == p and k == m}
    want = {f: sorted(set().union(*({p} | of(p) for g, p in features if g == f)) - {None}) for f, _ in features}
    given = spark.createDataFrame(features, "feature int, page int"), spark.createDataFrame(modules, "module int, page int")
    for most in (1, 2, 16):
        got = evidence.enriched(*given, most).collect()
        assert {r.feature: r.pages for r in got} == want and len(got) == len(want)
    plan = evidence.enriched(*given)._jdf.queryExecution().optimizedPlan().toString()
    assert not {"Aggregate", "Join"} & set(plan[: plan.index("RepartitionByExpression")].replace("[", " ").split())
