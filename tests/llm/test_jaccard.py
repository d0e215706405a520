import random
import re

import pytest

from sparkloom.llm import jaccard
from sparkloom.llm.components import components

SCHEMA = "doc_id long, text string, n_shingles string, key int, tile int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text, n):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def brute(rows, n, num, den):
    """Every pair compared; union and find."""
    sets = [(i, sets_of(t, n)) for i, t, *_ in rows]
    up = {i: i for i, _ in sets if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for p, (i, a) in enumerate(sets):
        for j, b in sets[:p]:
            if i is None or j is None or not a or not b:
                continue
            c = len(a & b)
            if den * c >= num * (len(a) + len(b) - c):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return sorted(((i, len(a), None if i is None else root(i)) for i, a in sets), key=str)


def corpus(seed, n_docs=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    hot = [rng.choice(vocabulary) for _ in range(60)]
    rows, texts = [], []
    for _ in range(n_docs):
        kind = rng.random()
        if kind < 0.5 and texts:
            words = rng.choice(texts).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
                if words:
                    k = rng.randrange(len(words))
                    words[k : k + rng.randint(0, 1)] = [rng.choice(vocabulary)]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 12, 30, 80, 125, 140, 300]))]
            if kind > 0.8:
                words = hot + words[:20]
        texts.append(" ".join(words))
        rows.append(texts[-1])
    return [(i, t if rng.random() < 0.5 else t.upper().replace(" ", " \n"), "x", 1, 2) for i, t in enumerate(rows)]


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 4, 5), (2, 1, 2)])
def test_against_every_pair(spark, n, num, den, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 4)
    rows = corpus(n)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3), n, num, den).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, n, num, den)


def test_exact_threshold(spark):
    """17 of 20 common shingles are linked at 85 of 100, 16 of 20 are not."""
    a = [f"a{i}" for i in range(21)]
    rows = [(5, " ".join(a[:20]), "", 0, 0), (9, " ".join(a[:17]), "", 0, 0), (7, " ".join(a[:16]), "", 0, 0)]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA), 1).collect()}
    assert got == {5: 5, 9: 5, 7: 5}  # 16 of 17 ties the third to the second
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark.createDataFrame([rows[0], rows[2]], SCHEMA), 1).collect()}
    assert got == {5: 5, 7: 7}


def test_odd_rows(spark):
    long = " ".join(f"x{i % 4999}" for i in range(60_000))
    rows = [(1, None, "", 0, 0), (2, "", "", 0, 0), (3, " \t", "", 0, 0), (4, "one", "", 0, 0), (5, "ONE", "", 0, 0), (5, "ONE", "", 0, 0), (None, "one", "", 0, 0), (7, long, "", 0, 0), (8, long + " y", "", 0, 0), (9, "a b c d e", "", 0, 0), (9, "one", "", 0, 0), (10, "\x1cone", "", 0, 0)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 4, 85, 100)
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_of_each(spark):
    """A text that only shares its id with another is a document of its own here."""
    rows = corpus(7, 120) + [(None, "free", "x", 1, 2), (3, "another text of id three", "x", 1, 2), (5, "twice", "x", 1, 2), (5, "twice", "x", 1, 2)]
    clashing = "doc_id long, text string, __0_0 string, c int, `__1_0` int"
    df = spark.createDataFrame([(*r[:2], f"mark {r[0]}", *r[3:]) for r in rows], clashing)
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    named = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    stays = {c for _, _, c in brute([(k, r[1]) for k, r in enumerate(named)], 5, 4, 5)}
    got = out.collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id is not None) == sorted(named[k][:2] for k in stays)
    assert out.where("doc_id is null").count() == 1
    assert all(r["__0_0"] == f"mark {r.doc_id}" and (r.c, r["__1_0"]) == (1, 2) for r in got)


def counted(rows, n, num, den):
    sets = [(i, sets_of(t, n)) for i, t, *_ in rows]
    linked = lambda a, b: a and b and den * len(a & b) >= num * (len(a) + len(b) - len(a & b))
    return sorted(((i, sum(1 for q, (j, b) in enumerate(sets) if q != p and j is not None and linked(a, b)) if i is not None else 0) for p, (i, a) in enumerate(sets)), key=str)


def test_number_of_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 4)
    rows = corpus(11) + [(None, "w1 w2 w3 w4", "x", 1, 2), (7, "w1 w2 w3 w4", "x", 1, 2), (700, "w1 w2 w3 w4", "x", 1, 2)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3), links=True).collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == brute(rows, 4, 85, 100)
    assert sorted(((r.doc_id, r.n_links) for r in got), key=str) == counted(rows, 4, 85, 100)


def test_common_line_copies_and_near_copies(spark, monkeypatch):
    """A line that all texts hold, a large group of copies and one of near copies that are not all linked."""
    monkeypatch.setattr(jaccard, "TILE", 8)
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(4000)}"
    line, base = [word() for _ in range(14)], [word() for _ in range(120)]
    texts = [line + [word() for _ in range(rng.choice([3, 20, 60]))] for _ in range(150)] + [base] * 80
    for _ in range(120):
        t = list(base)
        for _ in range(rng.choice([1, 2, 4, 5])):
            t[rng.randrange(len(t))] = word()
        texts.append(line + t)
    rng.shuffle(texts)
    rows = [(i, " ".join(t), "", 0, 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = jaccard.jaccard_components(df, links=True).collect()
    want = brute(rows, 4, 85, 100)
    assert sorted((tuple(r)[:3] for r in got), key=str) == want
    assert sorted(((r.doc_id, r.n_links) for r in got), key=str) == counted(rows, 4, 85, 100)
    assert sorted(map(tuple, jaccard.jaccard_components(df).collect()), key=str) == want


@pytest.mark.parametrize("num,den", [(85, 100), (4, 5), (1, 2), (99, 100)])
def test_linked_sets_keep_a_common_key_whatever_is_left_out(num, den):
    """Pairs just at the threshold; of each side the keys that it may leave out go, by the same random order."""
    import numpy as np

    need, rng = jaccard._Need(num, den), np.random.default_rng(num)
    tried = 0
    for _ in range(3000):
        a = int(np.exp(rng.uniform(0, 7)))
        s = rng.integers(0, 1 << 64, a, dtype=np.uint64)
        b = int(rng.integers(a, need.largest(a) + 1))
        common = -(-num * (a + b) // (num + den))
        if common > a or b == a == common:
            continue
        tried += 1
        x, y = np.unique(s), np.unique(np.concatenate([s[:common], rng.integers(0, 1 << 64, b - common, dtype=np.uint64)]))
        seed, kept = np.uint64(rng.integers(1 << 62) * 2 + 1), []
        for z in (x, y):
            keys, drops = need.keys(z, jaccard._sums(z))
            own = set()
            for i in range(3):
                slot = drops >> 21 * i & (1 << 21) - 1
                mine = [k for k in keys.tolist() if k % 8 == slot % 8]
                mine.sort(key=lambda k: k * int(seed) % (1 << 64))
                own |= set(mine[: len(mine) - (slot >> 3)])
            kept.append(own)
        assert kept[0] & kept[1], (a, b, common)
    assert tried > 500


def test_shingles_of_long_words_and_segments(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from sparkloom.llm import shingling

    texts = ["A b\tc  D", "", None, "x" * 9000 + " y " + "z " * 5000 + "w" * 5000, "\x1cone é É", "a b c d"]
    whole = [s.tolist() for s in shingling.shingle_sets(pa.array(texts), 2)]
    assert [len(s) for s in whole] == [len(sets_of(t, 2)) for t in texts]
    monkeypatch.setattr(shingling, "SEGMENT", 64)
    assert [s.tolist() for s in shingling.shingle_sets(pa.array(["skip", *texts])[1:], 2, 100)] == whole
    assert whole[0] == whole[5][: len(whole[0])] or set(whole[0]) == set(whole[5])
    assert shingling.overlap(np.array(whole[0], np.uint64), np.array(whole[5], np.uint64)) == 3


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 200) if i % 40 != 39] + [(1000, i) for i in range(500, 560)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: root(x) for x in linked}
