"""Nearest neighbours, license scan and the shingle join, against brute force."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import common, licenses, neighbours, shingle_join
from tessera.llm.shingle_join import Piece, jaccard_components, meet, one_of_each

# --- nearest neighbours


def brute(rows, query, k):
    """For every query row its k nearest other rows of the same length, in 80-bit arithmetic."""
    good = [(i, np.array(v, np.longdouble)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(good):
        if query(i):
            scored = sorted((-(v @ w) / np.sqrt(v @ v) / np.sqrt(w @ w), j) for b, (j, w) in enumerate(good) if b != a and len(w) == len(v))
            out.append((i, [(j, -s) for s, j in scored[:k]]))
    return out


def test_recall_and_order(spark, sf):
    v = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in v.collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([e for _, e in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in neighbours.nearest(v, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for at in np.flatnonzero(ids % 10 == 0):
        s = x @ x[at]
        s[at] = -9
        true = set(ids[np.argsort(-s)[:5]].tolist())
        found = got[ids[at]]
        assert len(found) == 5
        assert [f[1] for f in found] == sorted((f[1] for f in found), reverse=True)
        hits += len(true & {f[0] for f in found})
        total += 5
    assert hits / total >= 0.9


def test_cases_small_table_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(8)]) for i in range(12)]
    same = rows[4][1]
    rows += [(i, same) for i in range(20, 34)] + [(40, None), (41, [0.0] * 8), (42, [float("nan")] + [1.0] * 7), (43, [float("inf")] + [1.0] * 7), (44, [1.0, 2.0]), (45, [None] + [1.0] * 7), (None, same), (5, rows[5][1])]
    rows += [(60, rows[8][1]), (60, rows[8][1]), (44, [2.0, 1.0]), (48, [3.0, 4.0])]  # repeated rows and ids, and another length
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, q string")
    compare(df, rows)
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def compare(df, rows, **how):
    want = brute(rows, lambda i: i % 4 == 0, 5)
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 4 == 0, **how).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    expected = defaultdict(list)
    for i, found in want:
        expected[i] += [(n + 1, j, float(s)) for n, (j, s) in enumerate(found)]
    assert set(got) == {i for i, x in expected.items() if x}
    for i, x in got.items():
        a, b = sorted(x), sorted(expected[i])
        assert [r[0] for r in a] == [r[0] for r in b]
        assert [r[2] for r in a] == pytest.approx([r[2] for r in b], abs=1e-12)
        if len({round(r[2], 9) for r in b}) == len(b):
            assert [r[1] for r in a] == [r[1] for r in b]


def test_large_and_tiny_doubles(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(4) * 10.0 ** float(e)).tolist()) for i, e in enumerate([200, -200, 300, 0, 150, -150, 5, 307, -300, 1])]
    compare(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), rows)


def test_queries_without_a_limit_are_ranked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(8)]) for i in range(150)]
    compare(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), rows, most=0)


# --- licenses


def words(text):
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum() or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_finds_what_is_there(spark):
    gpl = licenses.TEMPLATES["gpl-header"]
    changed = gpl.replace("redistribute", "share").replace("either version 3", "version 3")
    rows = spark.createDataFrame([(1, "Intro. " + gpl + " End."), (2, "É\n" + changed), (3, "a general public text about the license of version"), (4, None), (5, ""), (6, licenses.TEMPLATES["mit-notice"].upper() + "\n" + licenses.TEMPLATES["mit-notice"])], "doc_id long, text string")
    got = defaultdict(list)
    for r in licenses.scan(rows).collect():
        got[r["doc_id"], r["license"]].append(r)
    assert set(got) == {(1, "gpl-header"), (2, "gpl-header"), (6, "mit-notice")}
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    for (i, name), found in got.items():
        for r in found:
            part = texts[i][r["start_char"] : r["end_char"]]
            assert r["matched_words"] == lcs(words(licenses.TEMPLATES[name]), words(part))
            assert r["coverage"] == pytest.approx(r["matched_words"] / max(r["template_words"], len(words(part))))
    assert len(got[6, "mit-notice"]) == 2
    assert got[1, "gpl-header"][0]["coverage"] == 1.0


def test_documents_against_plain_search(docs):
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(docs).collect()}
    for name, text in licenses.TEMPLATES.items():
        plain = {r["doc_id"] for r in docs.where(F.contains("text", F.lit(text))).collect()}
        longer = {n for n, x in licenses.TEMPLATES.items() if text.rstrip(".") in x or n == name}
        assert plain <= {i for i, n in got if n in longer}


def found(text):
    index = licenses.Index(licenses.TEMPLATES)
    return [index.names[m[1]] for m in index.matches(common.Words([text.encode()], "plain"))]


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_each_template_gets_its_own_name(name):
    assert found(f"Some words before. {licenses.TEMPLATES[name]} And some after.") == [name]


@pytest.mark.parametrize("text", [
    "This work is licensed under the GNU General Public License, version 1.", "Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-NC 2.5.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 2.0 International License.", licenses.TEMPLATES["gpl-header"].replace("version 3", "version 4"),
    "This work is licensed under the GNU Library General Public License, version 3.", licenses.TEMPLATES["mpl-2.0-header"].replace("2.0", "3.0"),
    "Released under the terms and many other conditions of the MIT and the old License.", "Creative Commons Attribution", "",
])
def test_near_misses_get_no_name(text):
    assert found(text) == []


def test_scan_against_alignment_everywhere():
    """Every template aligned at every place of mutated texts, by plain longest common subsequence: nothing more is named, and nothing less where
    a run of words long enough for a sure fingerprint is shared."""
    rng = np.random.default_rng(4)
    index = licenses.Index(licenses.TEMPLATES)
    decisive = {*licenses.DECISIVE, *map(str, range(1000))}
    for name in sorted(licenses.TEMPLATES):
        text = words(licenses.TEMPLATES[name])
        if len(text) > 60:
            continue
        for at in rng.choice(len(text), 2, replace=False).tolist():
            changed = text[:at] + (["changed"] if at % 2 else []) + text[at + 1 :]
            want = []
            for other, template in licenses.TEMPLATES.items():
                t = words(template)
                both = lcs(t, changed)
                marks = [[w for w in x if w in decisive] for x in (t, changed)]
                run = max(k for k in range(len(t) + 1) if k == 0 or any(t[i : i + k] == changed[j : j + k] for i in range(len(t) - k + 1) for j in range(len(changed) - k + 1)))
                if run >= licenses.GRAM + licenses.WINDOW - 1 and both >= 0.8 * len(t) and marks[0] == marks[1] and len(changed) <= 1.25 * both:
                    want.append((both, both / max(len(t), len(changed)), other))
            got = [index.names[m[1]] for m in index.matches(common.Words([" ".join(changed).encode()], "plain"))]
            best = {n for b, s, n in want if (b, s) == max(want)[:2]}
            assert (set(got) <= best and len(got) == 1) if want else (set(got) <= {name}), (name, changed, got, want)


def test_many_matches_in_one_text(spark):
    text = " ".join(f"{licenses.TEMPLATES['mit-notice']} é{i}" for i in range(3000))
    rows = licenses.scan(spark.createDataFrame([(None, text)], "doc_id long, text string")).collect()
    assert len(rows) == 3000
    assert all(text[r["start_char"] : r["end_char"]] == licenses.TEMPLATES["mit-notice"].rstrip(".") and r["doc_id"] is None for r in rows)


def test_license_cases(edge, empty):
    assert licenses.scan(edge).count() == 0
    assert licenses.scan(empty).count() == 0
    with pytest.raises(ValueError, match="fewer than"):
        licenses.Index({"short": "two words"})


# --- shingle join


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def reached(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    top = {i: i for i, _ in sets if i is not None}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and i is not None and j is not None:
                both = len(s & t)
                if 100 * both >= percent * (len(s) + len(t) - both):
                    x, y = find(i), find(j)
                    top[max(x, y)] = min(x, y)
    return {i: find(i) for i in top}


def test_documents_exactly(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for k, percent in ((4, 85), (5, 80), (2, 50)):
        want = reached(rows, k, percent)
        got = {r["doc_id"]: r for r in jaccard_components(docs, k, percent).collect()}
        assert {i: r["component_id"] for i, r in got.items()} == want
        assert all(r["n_shingles"] == len(shingles(t, k)) for i, t in rows for r in [got[i]])


def test_near_copies_that_are_no_copies_of_each_other(spark):
    """A chain of texts, each close to the next, and a family around one text with members that do not reach each other."""
    rng = np.random.default_rng(1)
    base = [f"w{x}" for x in rng.integers(0, 400, 120)]
    chain_ = [list(base)]
    for i in range(12):
        chain_.append(list(chain_[-1]))
        chain_[-1][i * 9] = f"new{i}"
    family = []
    for i in range(40):
        t = [f"f{x}" for x in range(100)]
        for j in rng.choice(100, 3, replace=False):
            t[j] = f"edit{i}_{j}"
        family.append(t)
    rows = [(1000 - i, " ".join(t)) for i, t in enumerate(chain_ + family)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_components(df, 4, 85).collect()} == reached(rows, 4, 85)


def test_join_cases(edge, edge_rows, empty):
    rows = jaccard_components(edge, 4, 85).collect()
    assert len(rows) == len(edge_rows)
    got = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert got[2] == got[1] == 1
    assert got[8] == got[7] == 7
    assert got[6] == 6
    assert all(got[i] == i for i in (3, 4, 5, 9, 10))
    assert {(r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is None} == {(0, None), (1, 6)}
    assert jaccard_components(empty, 4, 85).count() == 0


def test_links_are_all_counted(spark):
    """Inside a family every pair that is similar counts, equal rows on both sides too."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(150):
        t = [f"f{x}" for x in range(100)]
        for j in rng.choice(100, 1 + i % 3, replace=False):
            t[j] = f"edit{i}_{j}"
        rows.append((i, " ".join(t)))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (300, "alone with some words here"), (301, ""), (None, rows[0][1])]
    sets = [shingles(t, 4) for _, t in rows]
    want = sorted((i or 0, sum(100 * len(s & t) >= 85 * len(s | t) for k, t in enumerate(sets) if k != a and s and t)) for a, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 4, 85).collect()
    assert sorted((r["doc_id"] or 0, r["n_links"]) for r in got) == want
    again = spark.createDataFrame([(6, rows[0][1]), (6, rows[0][1]), (7, rows[3][1])], "doc_id long, text string")
    near = 100 * len(sets[0] & sets[3]) >= 85 * len(sets[0] | sets[3])
    assert sorted((r["doc_id"], r["n_links"]) for r in jaccard_components(again, 4, 85).collect()) == [(6, 1 + near), (6, 1 + near), (7, 2 * near)]
    assert "n_links" not in jaccard_components(again, 4, 85, links=False).columns


def test_many_blank_texts_and_a_hot_shingle(spark):
    """A tenth of the rows blank, and one passage that is nearly all of the rest: many pieces meet under its shingles."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, None if i % 10 == 0 else f"{passage} a{i} b{i} c{i}" if i % 3 else f"{passage} " + " ".join(f"x{i}_{j}" for j in range(i % 40))) for i in range(700)]
    got = {r["doc_id"]: r for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 4, 85).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == reached(rows, 4, 85)
    sets = [shingles(t, 4) for _, t in rows]
    for i in (1, 3, 6, 111):
        assert got[i]["n_links"] == sum(100 * len(sets[i] & t) >= 85 * len(sets[i] | t) for k, t in enumerate(sets) if k != i and t)


def test_pieces_of_the_matrix():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64) * np.uint64(2**58 + 1)) for _ in range(40)]
    a, b = ([(i, i, 1, sets[i]) for i in x] for x in (range(25), range(15, 40)))
    hits = meet(Piece(*Piece.of(a)), Piece(*Piece.of(b)), 50)
    for i, *_, x in a:
        for j, *_, y in b:
            assert hits[i, j - 15] == (i != j and 2 * len(np.intersect1d(x, y)) >= len(np.union1d(x, y)))


@pytest.mark.parametrize("shape", ["chain", "hills", "star", "pairs"])
def test_components(spark, shape):
    n = 400
    edges = {"chain": [(i, i + 1) for i in range(n)], "hills": [(min(i, n - i) * 2 + (2 * i > n), min(i + 1, n - i - 1) * 2 + (2 * i + 2 > n)) for i in range(n)], "star": [(7, i) for i in range(n)], "pairs": [(2 * i, 2 * i + 1) for i in range(n)]}[shape]
    cuts = []
    real = common.cut
    common.cut = lambda df: (cuts.append(1), real(df))[1]
    try:
        got = {r["node"]: r["label"] for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    finally:
        common.cut = real
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for u, v in edges:
        x, y = find(u), find(v)
        top[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(top) if x in got}
    assert set(got) == {x for e in edges for x in e if e[0] != e[1]}
    assert (len(cuts) - 2) / 2 <= 9  # rounds


def test_one_of_each_goes_by_rows(spark):
    """Repeated and null ids: an unrelated text stays, whatever its id, and a near copy goes even without one."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text + " more"), (2, "an unrelated text that has some words of its own"), (None, text + " other"), (None, None), (None, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, uid string")
    kept = one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == sorted((str(i), str(t)) for i, t in (rows[0], rows[2], rows[4], rows[5]))


def test_rows_are_chosen_by_bitmaps_as_by_a_join(spark, monkeypatch):
    rows = spark.range(0, 70_000, 1, 3).select(F.monotonically_increasing_id().alias("uid"))
    reps = rows.where("uid % 7 = 0 or uid % 32768 in (0, 1, 32767)").select(F.col("uid").alias("rep"))
    got = shingle_join._chosen(rows, reps)
    monkeypatch.setattr(shingle_join, "BITMAPS", -1)
    want = shingle_join._chosen(rows, reps)
    assert got.count() == want.count() > 10_000 and not got.exceptAll(want).count()
    assert not shingle_join._chosen(rows, reps.where("false")).count()


def test_stars_connect_what_pairs_connect():
    a, b = np.array([5, 9, 9, 2, 40]), np.array([9, 7, 3, 2, 41])
    assert sorted(shingle_join.stars(a, b)) == [(3, 5), (3, 7), (3, 9), (40, 41)]
