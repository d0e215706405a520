import re
import zlib

import numpy as np

import corpus_pipeline as cp
from sparkloom.llm import decontaminate, quality
from tests.conftest import SF
from tests.llm.test_encoding import plain
from tests.llm.test_jaccard import brute


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    stage = dict(cp.STAGES)
    key = lambda df: sorted((r.doc_id, r.text) for r in df.collect())

    good = stage["quality classifier"](spark, docs, SF)
    scores = {r.doc_id: r.score for r in quality.quality(docs, labels).collect()}
    assert good.columns == docs.columns and key(good) == key(docs.where(docs.doc_id.isin([i for i, s in scores.items() if s >= 0.5])))

    alone = stage["n-gram Jaccard join"](spark, good, SF)
    rows = key(good)
    assert alone.columns == docs.columns and [r[0] for r in key(alone)] == sorted({c for _, _, c in brute(rows, 5, 4, 5)})

    clean = stage["benchmark decontamination"](spark, alone, SF)
    items = [decontaminate.normal(r.text) for r in bench.collect()]
    left = key(clean)
    assert clean.columns == docs.columns and left and not any(i in decontaminate.normal(t) for _, t in left for i in items)
    near = {r.doc_id for r in decontaminate.leaks(alone, bench).collect()}
    assert left == [r for r in key(alone) if r[0] not in near]

    mixed = stage["mixing sources to target weights"](spark, clean, SF)
    rows = key(mixed)
    assert mixed.columns == docs.columns and set(rows) <= set(left) and max(rows.count(r) for r in set(rows)) <= 3
    words = lambda x: sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for _, t in x)
    assert abs(words(rows) - words(left)) / words(left) < 0.2

    tokens = sorted(stage["token-ID / binary output"](spark, mixed, SF).collect(), key=lambda r: r.start)
    at = 0
    for r, (i, t) in zip(tokens, rows, strict=True):
        ids = [*plain([t])[0], 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    run = sorted(cp.run(spark, SF).collect(), key=lambda r: r.start)
    assert run == tokens


def test_empty_table_through_all_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in cp.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0
