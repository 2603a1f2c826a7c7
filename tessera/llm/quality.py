"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

Features are single words and pairs of words (runs of letters and runs of signs, case kept) hashed to 2**BITS buckets, each
occurrence counting 1/sqrt(occurrences in the text); all pairs of a word with itself share one bucket,
and so do all words that return after one other. Training takes a bounded sample of labelled rows, SAMPLE at most in
expectation, chosen by a hash of the id; one task walks through it in hash order. Scoring is a sparse dot product where the
text lies, over whole texts.

Defined cases: a null or empty text scores by the intercept alone; a null label is no label; an id labelled several
times takes the mean of its labels (0.5 counts as 1); a null id is scored like any other and joins no label; without any training row the
score is 0.5; an empty table gives no rows; other columns are carried only where the caller asks for it."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, chain, chunks, lean, tidy

BITS = 20
#: Labelled rows that training takes, about, however many there are.
SAMPLE = 12_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1


def buckets(texts: list[bytes | None], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets, the text that each belongs to, and the occurrences in each text."""
    words = Words(texts, "apart")
    owner = words.text_of()
    if len(owner) > 1:
        inside = owner[1:] == owner[:-1]
        pairs = np.where(words.hash[1:] == words.hash[:-1], np.uint64(0), chain(words.hash, 2))[inside]
        back = np.flatnonzero((owner[2:] == owner[:-2]) & (words.hash[2:] == words.hash[:-2])) + 2
        hashes = np.concatenate([words.hash, pairs, np.full(len(back), 1 << 63, np.uint64)])
        owner = np.concatenate([owner, owner[1:][inside], owner[back]])
    else:
        hashes = words.hash
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), owner, np.bincount(owner, minlength=len(texts))


def follow(texts: list[bytes | None], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal over the rows in the given order; the last one is the intercept's."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def rows():
        for i in range(0, len(texts), 64):
            found, owner, count = buckets(texts[i : i + 64], bits)
            order = np.argsort(owner, kind="stable")
            ends = np.cumsum(count)
            for k, part in enumerate(np.split(found[order], ends[:-1])):
                at, times = np.unique(part, return_counts=True)
                yield np.append(at, size), np.append(times / max(1, count[k]) ** 0.5, 1.0), labels[i + k]

    def weight(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for at, x, y in rows():
            w = weight(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weight(z, n).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, allowed, label_col: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> np.ndarray:
    """Weights learned from ``labels`` rows whose id passes ``allowed`` (a condition on the column doc_id)."""
    marks = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("y")).where(allowed & F.col("y").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    share = min(1.0, sample / max(1, marks.count()))
    picked = marks.withColumn("h", F.xxhash64("doc_id")).where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    chosen = texts.join(F.broadcast(picked), "doc_id")  # ``sample`` rows, about

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "text"])
        weights = follow([t.encode() if isinstance(t, str) else None for t in rows["text"]], rows["y"].to_numpy(), bits)
        return pd.DataFrame({"weights": [weights.tobytes()]})

    found = chosen.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "weights binary").collect()
    return np.frombuffer(found[0]["weights"], np.float32) if found else np.zeros((1 << bits) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", bits: int = BITS, keep: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` (of its columns ``keep``, if given) as the struct ``row`` with its score, from 0 to 1."""
    kept = docs.select(*keep) if keep else docs
    lean(docs.sparkSession)
    whole = text_col in kept.columns  # the text travels once
    place = kept.columns.index(text_col) if whole else None
    weights = docs.sparkSession.sparkContext.broadcast(weights)  # 4 MB at 20 bits
    schema = T.StructType([T.StructField("row", kept.schema), T.StructField("score", T.DoubleType())])

    def run(batches):
        w = weights.value
        for batch in batches:
            for part, texts in chunks(batch, place):
                found, owner, count = buckets(texts, bits)
                total = np.bincount(owner, weights=w[found], minlength=len(texts)) / np.sqrt(np.maximum(count, 1)) + w[-1]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-total)))], names=["row", "score"])

    return docs.select(F.struct(*(docs[c] for c in kept.columns)).alias("row"), *([] if whole else [docs[text_col].alias("text")])).mapInArrow(tidy(run), schema)
