import hashlib
from collections import Counter

import pytest

from sparkloom.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, n_chars string, fingerprint int, k int, n int"


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = {}
    for i, r in enumerate(order):
        t, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(t) // 3
        out[r[0], t] = (len(t), hashlib.sha256((t[: len(t) - cut] + nxt[:cut]).encode()).hexdigest(), nxt)
    return out


def rows_of(n=60):
    return [(i * 13 % 97, " ".join(f"w{(i * 31 + j * j) % 211}é" for j in range(i % 50)), "x", 1, 2, 3) for i in range(n)]


def test_edited_texts_and_equal_prints(spark):
    rows = rows_of() + [(200, None, "", 0, 0, 0), (201, "", "", 0, 0, 0), (202, "𝒳 one", "", 0, 0, 0), (None, "no id here", "", 0, 0, 0), (300, "same text again", "", 0, 0, 0), (301, "same text again", "", 0, 0, 0), (302, "long " * 30_000, "", 0, 0, 0)]
    want = expected(rows)
    got = fp.fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    texts = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows)
    prints = {}
    for r in got:
        n, sha, nxt = want[r.doc_id, texts[r.doc_id]]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        if nxt == texts[r.doc_id]:
            assert r.near_next == 1
    assert prints[""] == ""


def test_repeats_single_and_empty(spark):
    rows = [(1, "a b c d e f", "", 0, 0, 0)] * 2 + [(1, "z y x", "", 0, 0, 0)]
    got = sorted(fp.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect())
    assert len(got) == 3 and got[0].near_next + got[1].near_next + got[2].near_next >= 1
    (one,) = fp.fingerprints(spark.createDataFrame([(5, "just one document", "", 0, 0, 0)], SCHEMA)).collect()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"just one docjust ").hexdigest()
    assert fp.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0


def test_collision_rate_is_generalised_jaccard(spark):
    """Two weighted sets of known similarity, over many samples."""
    from pyspark.sql import functions as F

    a = {i: 1 + i % 5 for i in range(60)}
    b = {i: 1 + (i * 2) % 5 for i in range(20, 80)}
    true = sum(min(a.get(i, 0), b.get(i, 0)) for i in range(80)) / sum(max(a.get(i, 0), b.get(i, 0)) for i in range(80))
    rows = [("a", t * 7919, float(w)) for t, w in a.items()] + [("b", t * 7919, float(w)) for t, w in b.items()]
    df = spark.createDataFrame(rows, "s string, term long, w double").withColumn("lw", F.ln("w"))
    samples = [df.groupBy("s").agg(*[F.min(fp._sample(F.col("term"), F.col("lw"), k)).bitwiseAND(F.lit(0xFFFFFFFF)).alias(f"s{k}") for k in range(q, q + 64)]).orderBy("s").collect() for q in range(0, 512, 64)]
    same = sum(x == y for one in samples for x, y in zip(one[0][1:], one[1][1:]))
    assert same / 512 == pytest.approx(true, abs=0.07)


def test_likeness_follows_the_edit(spark):
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(400)), "", 0, 0, 0) for i in range(30)]
    got = fp.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.near_edited for r in got) / len(got) == pytest.approx(0.5, abs=0.06)
    assert max(r.near_next for r in got) < 0.05


def test_terms_are_overlapping_shingles_by_occurrences(spark):
    from pyspark.sql import functions as F

    def counted(text):
        words = text.split()
        return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()

    texts = [(0, "a b c d e f g", "a b c d e f z"), (1, " a\tb ", "a b"), (2, "", "a b c d e"), (3, "x " * 9 + "y", "x " * 12), (4, " \n ", ""), (5, "p q r s t " * 3, "p q r s t " * 3 + "p q")]
    got = fp.weighted(spark.createDataFrame(texts, "k int, text string, edited string"), ["k"]).groupBy("k").agg(F.sort_array(F.collect_list(F.struct("which", "w"))).alias("rows")).collect()
    want = {}
    for k, text, edited in texts:
        own, other = counted(text), counted(edited)
        rows = [(2, own[t]) if own[t] == other[t] else (i, c[t]) for i, c in enumerate((own, other)) for t in c if not (i and own[t] == other[t])]
        if rows:
            want[k] = sorted(rows)
    assert {r.k: [tuple(x) for x in r.rows] for r in got} == want


def test_text_without_a_cut_word_is_like_its_edit(spark):
    """Words of which no hash is divisible by eight: as chunks, a text of them was one term."""
    from pyspark.sql import functions as F

    words = [r.w for r in spark.range(4000).select(F.format_string("u%d", "id").alias("w")).where("pmod(xxhash64(w), 8) != 0").orderBy("w").collect()]
    rows = [(i, " ".join(words[i * 400 : i * 400 + 400]), "", 0, 0, 0) for i in range(8)]
    got = fp.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    assert min(r.near_edited for r in got) > 0.25


def brute_signature(text, samples):
    """Every term's a = c / (y e^r) for each sample, from the same hashes, as the sampling is defined."""
    import math

    import xxhash

    of_long = lambda x, seed=42: xxhash.xxh64_intdigest((x & (1 << 64) - 1).to_bytes(8, "little"), seed & (1 << 64) - 1)
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in text.split()]
    terms = Counter()
    for i in range(max(1, len(words) - 4) if words else 0):
        h = words[i]
        for j in range(i + 1, i + 5):  # where there is no further word, the hash is hashed once more
            h = of_long(words[j], of_long(h)) if j < len(words) else of_long(h)
        terms[h << 1 & (1 << 64) - 1] += 1
    terms = {t >> 1: n for t, n in terms.items()}
    draw = lambda t, n: of_long(t ^ 0x9E3779B97F4A7C15 * (n + 1) & (1 << 63) - 1) >> 1
    exponential = lambda d: -math.log1p(-(d + 0.5) / 2.0**63)
    out = []
    for k in range(samples):
        best = None
        for t, w in terms.items():
            e, f, first = (exponential(draw(t, 3 * k + i)) for i in range(3))
            second = e / (e + f)
            r, c = first - math.log(second), e + f
            beta = first / r
            n = math.floor(math.log(w) / r + beta)
            y = math.exp(r * (n - beta))
            a = c / (y * math.exp(r))
            who = draw(t, 3 * k) if n == 0 else of_long(n, of_long(t))
            if best is None or a < best[0]:
                best = (a, who & 0xFFFFFFFF)
        out.append(best[1])
    return "".join(f"{x:08x}" for x in out)


def test_against_the_definition_of_the_samples(spark):
    """Signatures of small texts, with shingles that occur once and many times."""
    texts = ["a b c d e f g h", "one two", "r s t u v " * 30 + "tail of it all and more", "x " * 200 + "y z", " ".join(f"w{i % 37}" for i in range(300))]
    rows = [(i, t, "", 0, 0, 0) for i, t in enumerate(texts)]
    got = {r.doc_id: r.fingerprint for r in fp.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    same = total = 0
    for i, t in enumerate(texts):
        want = brute_signature(t, fp.SAMPLES)
        for k in range(fp.SAMPLES):
            same += got[i][8 * k : 8 * k + 8] == want[8 * k : 8 * k + 8]
            total += 1
    assert same == total


def test_no_python_in_the_plan(spark, capsys):
    fp.fingerprints(spark.createDataFrame(rows_of(3), SCHEMA)).explain("extended")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
