"""Every query of the engine against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

from sparkloom.plans.catalog import ORACLE_SQL, QUERIES
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return repr(round(float(v), 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    a = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    rows = cursor.fetchall()
    assert sorted(a.columns) == sorted(names)
    order = sorted(names)
    got = sorted(tuple(plain(r[c]) for c in order) for r in a.collect())
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in rows)
    assert got == want


def plain_cut(t):
    """Where the next occurrence of the first passage begins that occurs three times from its place on."""
    for w in (150, 200, 300, 400):
        if t.lstrip()[:1] in ("{", "[") and w < 300 or len(t) < 3 * w:
            continue
        for at in range(0, len(t) - w + 1, w // 2):
            p = t[at : at + w]
            if t[at:].count(p) >= 3:
                return t.index(p, at + 1)
    return None


def test_repetition_is_cut_where_a_plain_search_says(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    cut = {r.doc_id: r.cut_at for r in QUERIES["q42_repetition"](spark, SF).collect()}
    for i, t in texts.items():
        assert cut.get(i) == plain_cut(t)


def test_repetition_that_overlaps_or_stands_in_json(spark):
    from sparkloom.operators import extract

    texts = ["ab" * 400, "x" * 3000, '{"a": ' + "y" * 700, "[" + "z" * 1300, "word " * 200 + "end", "é𝒳 " * 300, "no loop here " + " ".join(f"w{i}" for i in range(300)), "", " \n" * 400]
    rows = extract.without_loops(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()
    for r in rows:
        want = plain_cut(texts[r.i])
        assert (r.cut_at, r.text) == (want, texts[r.i] if want is None else texts[r.i][:want].rstrip())


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["id", "type", "label"]
    assert set(e.oracle_sql()) <= set(e.queries())
