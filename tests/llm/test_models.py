"""Quality, language and the language model: held-out results, and the defined cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language, pitman_yor, quality
from tessera.llm.common import crc_mod
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_crc(spark):
    rows = spark.createDataFrame([(5,), (123,), (None,)], "doc_id long").select("doc_id", crc_mod("doc_id", 7).alias("m")).collect()
    assert [r["m"] for r in rows] == [zlib.crc32(b"5") % 7, zlib.crc32(b"123") % 7, zlib.crc32(b"") % 7]


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op8_quality"](spark, SF).join(labels, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.95


def test_quality_cases(edge, empty):
    labels = edge.select("doc_id", F.lit(1).alias("quality"))
    weights = quality.train(edge, labels, F.lit(True))
    rows = quality.score(edge, weights).collect()
    assert len(rows) == edge.count()
    assert all(0 <= r["score"] <= 1 and r["row"]["score"] == "x" for r in rows)
    none = quality.train(edge, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score(edge, none).collect()} == {0.5}
    assert quality.score(empty, none).count() == 0


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op3_language_id"](spark, SF).join(docs, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.97


def test_language_filter_returns_all_languages():
    a, b = np.arange(500, dtype=np.uint64), np.arange(300, 900, dtype=np.uint64)
    f = language.Filter({"a": a, "b": b}, {})
    masks = f.having(np.arange(900, dtype=np.uint64))[0]
    assert np.all(masks[:300] & 1)
    assert np.all(masks[300:500] == 3)
    assert np.mean(masks[500:] == 2) > 0.99


def test_more_languages_than_bits():
    profiles = {f"l{i:03}": np.arange(i * 50, i * 50 + 60, dtype=np.uint64) for i in range(150)}
    f = language.Filter(profiles, {})
    for i in (0, 63, 64, 149):
        found = f.having(np.arange(i * 50 + 10, i * 50 + 50, dtype=np.uint64))
        assert all(f.of(found, i))
        assert np.mean(sum(f.of(found, j).astype(int) for j in range(150))) < 1.2


def test_language_by_hand(spark):
    """The prediction of every text, from profiles and Bloom slots computed one by one."""
    texts = {"aa": ["the cat and the dog are in the house"] * 4 + ["the " * 300_000], "bb": ["le chat et le chien sont dans la maison"] * 4}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((k, t) for k, v in texts.items() for t in v)] + [(90, "the chien", None), (91, "zzqqxx", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, F.lit(True))
    got = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}

    def grams(text):
        t = f" {text} "
        return [t[i : i + k] for k in language.ORDERS for i in range(len(t) - k + 1) if " " not in t[i + 1 : i + k - 1] and t[i : i + k].strip(" ") and not (t[i] == " " == t[i + k - 1])]

    profiles = {k: {g for g, n in Counter(g for t in v for g in grams(t)).items() if n > 1} for k, v in texts.items()}
    for i, text, _ in rows:
        g = grams(text)
        share = {k: sum(x in p for x in g) / len(g) for k, p in profiles.items()}
        total = sum(share.values())
        best = max(share, key=share.get) if total else max(texts, key=lambda k: (len(texts[k]), k))
        assert got[i][0] == best
        assert got[i][1] == pytest.approx(share[best] / total if total else 0.5, abs=0.02)


def test_language_cases(edge, empty):
    rows = {r["row"]["doc_id"]: r for r in language.identify(edge, language.train(edge, F.lit(True))).collect()}
    for i in (3, 4, 5, 10):
        assert (rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0)
    assert rows[1]["lang_pred"] in {"de", "en", "fr"}
    assert {r["lang_pred"] for r in language.identify(edge, language.train(empty, F.lit(True))).collect()} == {"und"}
    assert language.identify(empty, language.train(edge, F.lit(True))).count() == 0


def test_lm_base_and_known(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op7_pitman_yor"](spark, "/root/testdata/sf0.001").collect()}
    texts = [(r["doc_id"], [*(r["text"] or "").encode().lower().split(), None]) for r in docs.collect()]
    c = Counter(w for i, t in texts if zlib.crc32(str(i).encode()) % 10 for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in texts:
        r = rows[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))


def test_lm_beats_its_base(spark):
    got = QUERIES["op7_pitman_yor"](spark, SF).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > got["b"]


def test_lm_probabilities_sum_to_one(spark):
    """Scores of all one-word texts and of the empty text after the same context, and of an unknown word, make up the whole."""
    train = [(i, t) for i, t in enumerate(["a b a c", "a b d", "b a", "c c a b", "a"] * 8)]
    words = [(100 + i, w) for i, w in enumerate(["a", "b", "c", "d", "never", ""])]
    rows = spark.createDataFrame([(i, t, False) for i, t in train] + [(i, w, True) for i, w in words], "doc_id long, text string, held boolean")
    got = {r["doc_id"]: r for r in pitman_yor.score(rows, "held", contexts=3).collect()}
    end = 10 ** got[105]["score"]  # P(end | start)
    first = {}
    for i, w in words[:5]:  # P(w | start) P(end | w)
        first[w] = 10 ** got[i]["score"]
    assert 0 < end < 1
    assert sum(first.values()) + end <= 1 + 1e-6


def test_lm_cases(edge, empty):
    held = edge.withColumn("held", F.lit(False))
    rows = pitman_yor.score(held, "held").collect()
    assert len(rows) == edge.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 5)} == {1}
    assert pitman_yor.score(empty.withColumn("held", F.lit(False)), "held").count() == 0
    untrained = pitman_yor.score(edge.withColumn("held", F.lit(True)), "held").collect()
    assert {(r["score"], r["base_score"], r["train_tokens"]) for r in untrained} == {(0.0, 0.0, 0)}


def test_stirling_and_tables():
    d = 0.5
    log_s = pitman_yor.stirling(d, 6)
    s = {(0, 0): 1.0}
    for c in range(1, 7):
        for t in range(1, c + 1):
            s[c, t] = s.get((c - 1, t - 1), 0) + (c - 1 - d * t) * s.get((c - 1, t), 0)
    assert all(math.isclose(math.exp(log_s[c, t]), s[c, t]) for c, t in s if c)
    rng = np.random.default_rng(0)
    got = pitman_yor.tables(rng, np.full(40_000, 3.0), np.full(40_000, 0.7), d, pitman_yor.stirling(d))
    weights = np.array([s[3, t] * 0.7**t for t in (1, 2, 3)])
    assert np.allclose(np.bincount(got.astype(int), minlength=4)[1:] / 40_000, weights / weights.sum(), atol=0.01)
    large = pitman_yor.tables(rng, np.full(100, 5000.0), np.full(100, 2.0), d, pitman_yor.stirling(d))
    assert np.all((large >= 1) & (large <= 5000))


def test_lm_every_context_has_its_restaurant(spark):
    """Words far below the most frequent ones keep what follows them, wherever their counts are kept."""
    train = [(i, f"x{i % 40} y{i % 40} z the") for i in range(400)] + [(1000 + i, "the the the") for i in range(50)]
    asked = [(10_000, "x5 y5"), (10_001, "x5 y6"), (10_002, "x5 z y5"), (10_003, "x5 the")]
    rows = spark.createDataFrame([(i, t, False) for i, t in train] + [(i, t, True) for i, t in asked], "doc_id long, text string, held boolean")
    for contexts in (2, 512):
        got = {r["doc_id"]: r["score"] for r in pitman_yor.score(rows, "held", contexts=contexts).collect()}
        assert got[10_000] - got[10_001] > 1.5  # y5 has always followed x5, y6 never
        assert got[10_000] == pytest.approx(-4.7, abs=0.5)  # the mean over seeds with all contexts on the driver
