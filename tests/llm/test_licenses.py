import re

from sparkloom.llm import licenses

SCHEMA = "doc_id long, text string, template string, position int, w int"


def shingle_list(text):
    words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
    return list(zip(words, words[1:]))


def brute(rows, containment=0.8):
    """A template matches where a window that its class lays holds enough of its shingles."""
    import math

    known = [(i, set(shingle_list(t))) for i, (_, t) in enumerate(licenses.TEMPLATES)]
    classes = {}
    for i, s in known:
        classes.setdefault(max(2, math.ceil(math.log2(len(s)))), []).append((i, s))
    out = {}
    for doc, text, *_ in rows:
        s = shingle_list(text or "")
        for some in classes.values():
            longest = max(len(t) for _, t in some)
            for at in range(0, max(1, len(s)), longest):
                window = set(s[at : at + 3 * longest])
                for i, t in some:
                    share = len(window & t) / len(t)
                    if share >= containment:
                        first, best = out.get((doc, i), (at + 1, 0))
                        out[doc, i] = (first, max(best, share))
    return out


def test_against_every_window(spark):
    filler = [f"word{i}" for i in range(500)]
    rows = []
    for i, (_, t) in enumerate(licenses.TEMPLATES):
        words = t.split()
        rows.append((i, " ".join(filler[: i * 13] + words + filler[100:150]), "x", 1, 2))
        rows.append((100 + i, " ".join(filler[: i * 7] + words[: len(words) // 2] + ["and", "so"] + words[len(words) // 2 :]), "x", 1, 2))
        rows.append((200 + i, " ".join(filler[:40] + words[: len(words) // 2]), "x", 1, 2))
    rows += [(300, None, "", 0, 0), (301, "", "", 0, 0), (302, "one", "", 0, 0), (303, "LICENSED   under\nthe Apache-License; version 2.0", "", 0, 0), (304, " ".join(filler * 200 + ["Released under the MIT License."]), "", 0, 0)]
    got = {(r.doc_id, r.template): (r.position, r.containment) for r in licenses.license_matches(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)
    assert all((i, i) in got for i in range(len(licenses.TEMPLATES)))
    assert (304, 2) in got and (303, 0) in got


def test_repeats_nulls_empty_and_bands(spark):
    rows = [(1, "Released under the MIT License.", "", 0, 0)] * 3 + [(None, "Released under the MIT License.", "", 0, 0)]
    got = licenses.license_matches(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.license) for r in got) == [(0, "MIT"), (1, "MIT")]
    two = [(None, "Released under the MIT License.", "", 0, 0), (None, "so it is Released under the MIT License. and more", "", 0, 0), (4, "Released under the MIT License.", "", 0, 0), (4, "Distributed under the Boost Software License, Version 1.0.", "", 0, 0)]
    got = licenses.license_matches(spark.createDataFrame(two, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.license) for r in got) == [(0, "MIT"), (0, "MIT"), (4, "BSL-1.0"), (4, "MIT")]
    assert licenses.license_matches(spark.createDataFrame([], SCHEMA)).count() == 0
    assert licenses.license_matches(spark.createDataFrame(rows, SCHEMA), templates=()).count() == 0
    n = licenses.bands(4, 20)
    assert (1 - 4 / 20) ** n <= licenses.MISS


def test_no_python_in_the_plan(spark, capsys):
    licenses.license_matches(spark.createDataFrame([(1, "x", "", 0, 0)], SCHEMA)).explain("extended")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_templates_are_told_apart(spark):
    filler = " ".join(f"word{i}" for i in range(60))
    texts = [t for _, t in licenses.TEMPLATES]
    rows = [(i * 100 + n, " ".join(filler.split()[:n]) + " " + t + " " + filler, "", 0, 0) for i, t in enumerate(texts) for n in (0, 11, 20, 31)]
    rows += [(5000, texts[4] + " " + texts[5], "", 0, 0), (5001, "This work is licensed under the GNU General Public License.", "", 0, 0)]
    got = {}
    for r in licenses.license_matches(spark.createDataFrame(rows, SCHEMA), resolve=True).collect():
        got.setdefault(r.doc_id, set()).add(r.template)
    assert got.pop(5000) == {4, 5}
    assert got.pop(5001) >= {4, 5}
    assert got == {i * 100 + n: {i} for i in range(len(texts)) for n in (0, 11, 20, 31)}
