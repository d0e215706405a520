import zlib

import numpy as np
import pytest

from sparkloom.llm import quality as q
from tests.conftest import SF

SCHEMA = "doc_id long, text string, x string, score int, __label2 int"


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=200), rng.integers(0, 2, 200).astype(float)
    steps, values = q.isotonic(x, y)
    fit = np.interp(x, steps, values)
    assert (np.diff(fit[np.argsort(x)]) >= -1e-12).all()
    # min-max formula of isotonic regression
    o = np.argsort(x)
    ys = y[o]
    want = [max(min(ys[i : j + 1].mean() for j in range(k, 200)) for i in range(k + 1)) for k in range(200)]
    assert np.allclose(fit[o], want)
    assert q.isotonic(np.array([1.0, 1.0, 2.0]), np.array([1.0, 0.0, 0.0]))[1].tolist() == pytest.approx([1 / 3, 1 / 3])


def test_held_out_accuracy_and_split(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in q.quality(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    out = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in out) / len(out) > 0.95


def test_learns_nothing_from_held_out_labels(spark):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(q.quality(docs, x).select("doc_id", "score").collect()) for x in (labels, turned))
    assert a == b


def test_odd_rows(spark):
    rows = [(i, ["good words in a row here", "BAD!! BAD!! BAD!!"][i % 2], "x", 1, 2) for i in range(40)] + [(100, None, "", 0, 0), (101, "", "", 0, 0), (None, "no id", "", 0, 0), (0, "good words in a row here", "", 0, 0), (102, "z" * 300_000, "", 0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)] + [(999, 1), (None, 0), (3, None)], "doc_id long, quality int")
    got = q.quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 40)
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {i for i in range(0, 40, 2)}
    assert q.quality(spark.createDataFrame([], SCHEMA), labels).count() == 0
    none = q.quality(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_normal_equations_and_scores_against_plain_numpy(spark):
    """Weights, calibration and scores from all rows at once, in memory; columns with the names that are used inside."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["alpha", "beta!", "G7", "x", "||", "low"], rng.integers(1, 60))) for _ in range(120)]
    rows = [(i, t, "m", i, -1.0, "h", 5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__label` string, `key` long, label double, hash string, fold int").repartition(5)
    labels = spark.createDataFrame([(i, int("!" in t)) for i, t in enumerate(texts)], "doc_id long, quality int")
    model = q.fit(docs, labels, features=32)
    x = np.array([q.statistics(t.encode()) for t in texts])
    y = np.array(["!" in t for t in texts], float)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale[x.std(0) > 1e-9], x.std(0)[x.std(0) > 1e-9])
    z = model.features(x)
    ridge = 1e-3 * len(x) * np.eye(33) / 32
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + ridge, z.T @ y), atol=1e-8)
    folds = {r.id: r.f for r in spark.range(120).selectExpr("id", "pmod(xxhash64('fold', id), 4) f").collect()}
    part = np.array([folds[i] for i in range(120)])
    out = np.zeros(120)
    for k in range(4):
        zk, yk = z[part != k], y[part != k]
        out[part == k] = z[part == k] @ np.linalg.solve(zk.T @ zk + 1e-3 * len(zk) * np.eye(33) / 32, zk.T @ yk)
    steps, values = q.isotonic(out, y)
    got = {r.doc_id: r.score for r in q.score(docs, model).collect()}
    assert np.allclose([got[i] for i in range(120)], np.interp(z @ model.weights, steps, values), atol=1e-6)
    kept = q.keep_good(docs, labels.where("doc_id % 3 != 5"))
    assert kept.columns == docs.columns and all((r["__label"], r["key"], r.label, r.hash, r.fold) == ("m", r.doc_id, -1.0, "h", 5) for r in kept.collect())


def test_repeated_ids_do_not_widen_the_training_rows(spark):
    rows = [(i % 10, f"text {i} " * (1 + i % 3)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] * 3, "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = q.fit(docs, labels, features=8)
    assert model is not None and len(model.steps) <= 2 * 10
