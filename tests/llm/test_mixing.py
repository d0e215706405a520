import re
from collections import defaultdict

import pytest

from sparkloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, copies int, p double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes):
    """Water filling, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = [s for s in names if s not in capped]
        w = sum(weight[s] for s in free)
        target = {s: rest * weight[s] / w for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: 3.0 * sizes[s] for s in over}


def documents(n=400):
    rows = []
    for i in range(n):
        source = [None, "hot", "hot", "hot", "é", "b", "tiny"][i % 7] if i < n - 3 else "solo"
        words = 1 if source == "tiny" else i * 37 % 90
        rows.append((i, " ".join(["w"] * words) if words else [None, "", " \n\t"][i % 3], source, "x", 1, 0.5))
    return rows


def test_targets_and_taken(spark):
    rows = documents()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len(WORD.findall(r[1] or ""))
    want = shares(sizes)
    got = mixing.copies(spark.createDataFrame(rows, SCHEMA), group=16).collect()
    again = mixing.copies(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), group=16).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r["size"]
        largest[r.source] = max(largest[r.source], r["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s]


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 0}, {"a": 1, "b": 100, "c": 100, None: 3}, {"a": 1, "b": 1, "c": 1000, "d": 2, "e": 0}])
def test_source_targets(spark, sizes):
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = shares(sizes)
    assert {r.source: pytest.approx(r.target) for r in got} == want


def test_chances_are_kept(spark):
    """Over many groups each document is taken about as often as its chance says."""
    import numpy as np
    import pandas as pd

    hits = np.zeros(20)
    for seed in range(800):
        rows = pd.DataFrame({"p": np.full(20, 0.3), "size": np.arange(1, 21)})
        out = mixing._round(rows.copy(), (seed,))["p"].to_numpy()
        assert ((out > 0) & (out < 1)).sum() <= 1
        assert out @ rows["size"] == pytest.approx(0.3 * rows["size"].sum())
        hits += out
    assert np.allclose(hits / 800, 0.3, atol=0.07)


def test_repeats_empty_and_the_mix_itself(spark):
    rows = [(1, "a b c", "s", "x", 1, 0.1)] * 3 + [(None, "d e", "s", "y", 2, 0.2), (2, "f " * 50, "t", "z", 3, 0.3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.copies(df).collect()
    assert len(got) == 5
    out = mixing.mixed(df)
    assert out.columns == df.columns
    counts = defaultdict(int)
    for r in got:
        counts[r.doc_id] += r.copies
    have = defaultdict(int)
    for r in out.collect():
        have[r.doc_id] += 1
    assert {k: v for k, v in counts.items() if v} == have
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_names_of_columns_and_rows_that_differ_elsewhere(spark):
    rows = [(1, "a b c", "s", "x", 1, 0.1), (1, "a b c", "s", "y", 7, 0.1), (2, "d " * 30, "t", "z", 3, 0.3), (3, "long " * 60_000, "t", "z", 3, 0.3)]
    names = "doc_id long, text string, source string, `__k1` string, `__copies` int, `__n` double"
    a, b = (sorted(mixing.mixed(spark.createDataFrame(r, names).repartition(n)).collect()) for r, n in ((rows, 1), (rows[::-1], 3)))
    assert a == b and all(tuple(r) in rows for r in a)


def test_no_copies_without_words(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, " \n", None), (None, "w " * 9, None), (5, "w", "s")]
    out = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id for r in out} <= {None, 5}


def test_targets_of_many_sources(spark):
    sizes = {f"s{i * 7919 % 1000:03d}": (i * i) % 97 for i in range(600)}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: pytest.approx(r.target) for r in got} == shares(sizes)
