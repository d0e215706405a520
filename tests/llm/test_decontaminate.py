import random

from sparkloom.llm import decontaminate as d

SCHEMA = "doc_id long, text string, item_id string, edits int, start int"


def nearest(item, text):
    """Least edits of an item against any part of a text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, k):
    chars = list(text)
    for _ in range(k):
        at = rng.randrange(len(chars))
        chars[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "é", "xz"[:1]])
    return "".join(chars)


def sample(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 14)))) for i in range(12)] + [(50, "ab"), (51, None), (52, "  ")]
    docs = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 25)))]
        if rng.random() < 0.6:
            _, t = rng.choice(items[:12])
            parts += [edited(rng, t, rng.choice([0, 0, 1, 2, 3, 5, 8])).upper(), " ".join(word() for _ in range(rng.randint(0, 9)))]
        docs.append((i, "  \n".join(parts), "x", 1, 2))
    return items, docs


def test_against_the_plain_table(spark):
    items, docs = sample(3)
    got = {(r.doc_id, r.item_id): r.edits for r in d.leaks(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for i, text, *_ in docs:
        for j, item in items:
            item = d.normal(item or "")
            if item:
                k = nearest(item, d.normal(text))
                if k <= (d.budget(len(item)) if len(item) >= d.Q else 0):
                    want[i, j] = k
    assert got == want and len(want) > 30


def test_blocks_give_the_same(spark):
    items, docs = sample(4, 40)
    a, b = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(d.leaks(a, b, block_chars=c).collect()) for c in (10**6, 50))
    assert one == many and one
    for r in one:
        text, item = d.normal(docs[r.doc_id][1]), d.normal(dict(items)[r.item_id])
        assert nearest(item, text[r.start : r.end]) == r.edits


def test_odd_rows_and_clean(spark):
    item = "a benchmark question of some length, with an answer"
    rows = [(1, None, "", 0, 0), (2, "", "", 0, 0), (3, item.upper(), "", 0, 0), (3, item.upper(), "", 0, 0), (None, "x " + item, "", 0, 0), (4, "clean text " * 60_000, "", 0, 0), (5, "words " * 60_000 + item + " words" * 1000, "", 0, 0)]
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(7, item), (7, item), (8, None)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id, r.edits) for r in d.leaks(docs, bench).collect()) == [(0, 7, 0), (3, 7, 0), (3, 7, 0), (5, 7, 0)]
    left = d.clean(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 4]
    assert d.leaks(docs, bench.limit(0)).count() == 0 and d.clean(docs, bench.limit(0)).count() == len(rows)
    assert d.leaks(docs.limit(0), bench).count() == 0


def test_a_very_long_item_is_found_where_it_stands():
    import numpy as np

    letters = np.random.default_rng(1).integers(97, 123, 4_300_000, dtype=np.uint8).tobytes().decode()
    items = d.Items([(7, letters), (8, "a short item that is not there at all")])
    assert [x[:3] for x in d.found_in(["z" * 50 + letters, "nothing"], items)] == [(0, 7, 0)]
