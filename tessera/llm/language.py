"""Language identification with language-bitmask n-gram filters.

Every language's profile is its most frequent byte n-grams (inside words and at their edges). All profiles go into one
bit-sliced Bloom filter: each slot holds a bit for every language, so that the slots of an n-gram, and-ed, give at once the set
of languages that have it. A text counts hits for each language, the hits expected from false positives are taken off, and
the language with the highest corrected share of the text's n-grams wins.

Profiles are learned from a bounded sample of rows, SAMPLE for each language in expectation, chosen by a hash of the id. Their
n-grams are counted where the rows lie, by the chunk, so that no task holds more than a chunk of text and a language's distinct n-grams.

Defined cases: a null text, or one without letters, is ``und`` with score 0, as is every text when no language could be
learned; there may be any number of languages (a plane of 8 MB for each 64); a tie goes to the language that comes first in order of name; a text whose n-grams no profile has takes the most frequent
language; rows without a language train nothing; an empty table gives no rows; other columns are carried."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, lean, mix, tidy

#: Bytes in an n-gram.
ORDERS = (3, 5)
#: N-grams in a language's profile, for each order.
PROFILE = 12_000
#: Rows of each language that training takes, about.
SAMPLE = 1500
#: Slots of the filter, as a power of two, and slots of an n-gram.
SLOTS, HASHES = 20, 3
_LETTER = np.full(256, 32, dtype=np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def grams(texts: list[bytes | None], orders=ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes and the text of each. All but letters counts as a space; accented capitals of Latin-1 are folded too."""
    texts = [t or b"" for t in texts]
    data = _LETTER[np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)]
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
    data[capital] += 32
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    codes, owners = [], []
    for k in orders:
        if len(data) < k:
            continue
        code = np.zeros(len(data) - k + 1, dtype=np.uint64)
        blank = np.zeros(len(code), dtype=bool)
        for i in range(k):
            piece = data[i : i + len(code)]
            code = code << np.uint64(8) | piece.astype(np.uint64)
            if 0 < i < k - 1:
                blank |= piece == 32  # inside one word: spaces only at the edges
        at = np.flatnonzero(~blank & (data[: len(code)] + data[k - 1 : k - 1 + len(code)].astype(np.uint16) > 64))
        codes.append(code[at])
        owners.append(np.searchsorted(ends, at, side="right"))
    return np.concatenate(codes), np.concatenate(owners)


def _slots(codes: np.ndarray, which: int, slots: int = SLOTS) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(codes + np.uint64((which + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(64 - slots)).astype(np.int64)


class Filter:
    """The bit-sliced Bloom filter of all profiles."""

    def __init__(self, profiles: dict[str, np.ndarray], prior: dict[str, int]):
        self.languages = sorted(profiles)
        self.usual = max(self.languages, key=lambda x: (prior.get(x, 0), x), default=None)
        kind = np.uint8 if len(self.languages) <= 8 else np.uint64
        self.bits = 8 * np.dtype(kind).itemsize
        self.masks = np.zeros((max(1, -(-len(self.languages) // self.bits)), 1 << SLOTS), dtype=kind)
        for i, name in enumerate(self.languages):
            for h in range(HASHES):
                self.masks[i // self.bits, _slots(profiles[name], h)] |= kind(1 << i % self.bits)
        self.false = np.array([float(np.mean(self.of(self.masks, i))) ** HASHES for i in range(len(self.languages))])

    def of(self, masks: np.ndarray, i: int) -> np.ndarray:
        """Whether masks have language i."""
        kind = masks.dtype.type
        return masks[i // self.bits] >> kind(i % self.bits) & kind(1)

    def having(self, codes: np.ndarray) -> np.ndarray:
        """For each n-gram, the masks of the languages that contain it, a row for each plane."""
        out = self.masks[:, _slots(codes, 0)]
        for h in range(1, HASHES):
            out &= self.masks[:, _slots(codes, h)]
        return out

    def shares(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text and language the corrected share of n-grams; n-grams of each text."""
        codes, owner = grams(texts)
        masks, total = self.having(codes), np.bincount(owner, minlength=len(texts))
        hits = np.stack([np.bincount(owner, weights=self.of(masks, i), minlength=len(texts)) for i in range(len(self.languages))], axis=1)
        return np.clip((hits / np.maximum(total, 1)[:, None] - self.false) / (1 - self.false), 0, 1), total

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        share, _ = self.shares(texts)
        best, total = share.argmax(axis=1), share.sum(axis=1)
        names, scores = [], np.zeros(len(texts))
        for i, t in enumerate(texts):
            if not t or not any(c.isalpha() for c in t.decode("utf-8", "replace")):
                names.append("und")
            elif total[i] == 0:
                names.append(self.usual)
                scores[i] = 1 / len(self.languages)
            else:
                names.append(self.languages[best[i]])
                scores[i] = share[i, best[i]] / total[i]
        return names, scores


def train(docs: DataFrame, allowed, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Filter:
    """Profiles from rows with text and language whose id passes ``allowed`` (a condition on the column doc_id)."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"), docs[text_col].alias("text"))
    usable = rows.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("lang") != "und"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    if not counts:
        return Filter({}, {})
    shares = docs.sparkSession.createDataFrame([(k, min(1.0, sample / n)) for k, n in counts.items()], "lang string, share double")
    picked = usable.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("lang", "text")

    def count(batches):
        for batch in batches:
            for part, texts in chunks(batch):
                langs = np.array(part.column(0).to_pylist(), dtype=object)
                for lang in dict.fromkeys(langs.tolist()):
                    mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                    loads = [np.unique(grams(mine, (k,))[0], return_counts=True) for k in ORDERS]
                    packed = [[x.astype("<u8").tobytes() for x in load] for load in loads]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ORDERS)), pa.array([len(mine)] * len(ORDERS), pa.int64()), pa.array(range(len(ORDERS)), pa.int32()), pa.array([x[0] for x in packed], pa.binary()), pa.array([x[1] for x in packed], pa.binary())], names=["lang", "texts", "k", "codes", "times"])

    def profile(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        best = []
        for k in range(len(ORDERS)):
            codes, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for more, n in part.loc[part["k"] == k, ["codes", "times"]].itertuples(index=False):
                codes, at = np.unique(np.concatenate([codes, np.frombuffer(more, "<u8")]), return_inverse=True)
                times = np.bincount(at, weights=np.concatenate([times, np.frombuffer(n, "<u8").astype(np.int64)]), minlength=len(codes)).astype(np.int64)
            top = np.lexsort((codes, -times))[:PROFILE]
            best.append(codes[top][times[top] > 1] if part.loc[part["k"] == k, "texts"].sum() > 1 else codes[top])
        return pd.DataFrame({"lang": [key[0]], "grams": [np.concatenate(best).tobytes()]})

    picked = picked.mapInArrow(tidy(count), "lang string, texts long, k int, codes binary, times binary")
    found = picked.groupBy("lang").applyInPandas(profile, "lang string, grams binary").collect()  # a row for each language
    return Filter({r["lang"]: np.frombuffer(r["grams"], np.uint64) for r in found}, counts)


def identify(docs: DataFrame, model: Filter, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` (of its columns ``keep``, if given) as the struct ``row``, with lang_pred and score."""
    kept = docs.select(*keep) if keep else docs
    lean(docs.sparkSession)
    whole = text_col in kept.columns  # the text travels once
    place = kept.columns.index(text_col) if whole else None
    model = docs.sparkSession.sparkContext.broadcast(model)  # the filter: 1 MB, or 8 MB with more than 8 languages
    schema = T.StructType([T.StructField("row", kept.schema), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, place):
                names, scores = model.value.predict(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores)], names=["row", "lang_pred", "score"])

    return docs.select(F.struct(*(docs[c] for c in kept.columns)).alias("row"), *([] if whole else [docs[text_col].alias("text")])).mapInArrow(tidy(run), schema)
