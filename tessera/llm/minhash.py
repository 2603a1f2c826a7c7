"""MinHash near-duplicates by a multi-index Hamming join.

A set of word shingles becomes a signature of CHUNKS * WIDTH MinHash values of 16 bits each; two signatures' distance is the number of
values in which they differ, and a value differs with the probability 1 - similarity. The signature is split into CHUNKS chunks. By
the pigeonhole principle, of two signatures with a distance of at most (ERRORS + 1) * CHUNKS - 1 one chunk has at most ERRORS errors. The
allowed errors are enumerated: for each chunk and each choice of WIDTH - ERRORS of its values there is a key, and two chunks with so few
errors have one in common. So every pair within that distance meets, without exception; with the values here, 31 of 80. A pair with
a similarity of just 0.8 has 16 errors on average, and meets nowhere with a probability of 5e-10; of pairs with a similarity
of 0.1 one in 125 meets.

Equal sets count as one. Sets that share a key are handed to the token-group matrix of the Jaccard join, whose tokens the keys
are: each first meets its best hub, then pieces of sets meet as wholes and only those whose unions overlap enough are
opened. There every link is confirmed on the full sets, no group is held in one task, and no pair is emitted within one. Components come
from the confirmed links.

Rows are numbered when they are first read. Defined cases: a null or blank text has no shingles and links with nothing; a text with fewer
words than a shingle is one shingle; ids may be null or repeated, component_id is the smallest id of the component, null if it has
none, and one row of each component is kept (of those with that id, any one); an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lean, mix, tidy
from .shingle_join import PERCENT, WORDS, jaccard_marks, shingle_lists

#: Chunks of a signature, values in a chunk, and errors that a chunk may have.
CHUNKS, WIDTH, ERRORS = 16, 5, 1
#: Signatures that differ in at most so many values meet for certain.
DISTANCE = (ERRORS + 1) * CHUNKS - 1
_SEEDS = mix(np.arange(1, 1 + CHUNKS * WIDTH, dtype=np.uint64))
_FACTORS = mix(_SEEDS) | np.uint64(1)
_LAST = np.uint64(0x9FB21C651E98DF25)
_CHOICES = list(itertools.combinations(range(WIDTH), WIDTH - ERRORS))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit MinHash values for each set; none is empty."""
    out = np.empty((len(sets), len(_SEEDS)), np.uint16)
    if not sets:
        return out
    members, first = np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets[:-1]])
    h, t = np.empty_like(members), np.empty_like(members)
    with np.errstate(over="ignore"):
        for i, (seed, factor) in enumerate(zip(_SEEDS, _FACTORS, strict=True)):
            np.bitwise_xor(members, seed, out=h)
            np.multiply(h, factor, out=h)
            np.right_shift(h, np.uint64(32), out=t)
            np.bitwise_xor(h, t, out=h)
            np.multiply(h, _LAST, out=h)
            out[:, i] = mix(np.minimum.reduceat(h, first)).astype(np.uint16)
    return out


def keys(signature: np.ndarray) -> np.ndarray:
    """The keys of each signature: one for each chunk and each choice of the values that agree."""
    out = []
    with np.errstate(over="ignore"):
        for c in range(CHUNKS):
            for k, choice in enumerate(_CHOICES):
                h = np.full(len(signature), c * len(_CHOICES) + k + 1, np.uint64)
                for at in choice:
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + signature[:, c * WIDTH + at])
                out.append(h)
    return np.stack(out, axis=1)


class MultiIndex:
    """Postings by the keys of the signature."""

    def of(self, sets: list[np.ndarray]) -> list[np.ndarray]:
        return [np.unique(x) for x in keys(signatures(sets))]

    def expected(self, n):
        return F.lit(CHUNKS * len(_CHOICES))

    def shared(self, n):
        return F.lit(1)


def signature_table(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, signature (16-bit values, little-endian; null without shingles) for every row."""
    lean(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch):
                found = [np.unique(x) for x in shingle_lists(texts, words)]
                each = iter(signatures([x for x in found if len(x)]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([next(each).astype("<u2").tobytes() if len(x) else None for x in found], pa.binary())], names=["doc_id", "signature"])

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, signature binary"
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(run), schema)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links), kept (whether the row stands for its component)."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    marks = jaccard_marks(rows, words, percent, links=False, posting=MultiIndex())
    return marks.select("doc_id", "n_shingles", "component_id", F.col("first").alias("kept"))
