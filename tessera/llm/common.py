"""Shared pieces of the training-data operators: the cluster's shared folder, size-checked broadcasts, the word kernel."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of at most 16 bytes that may be broadcast; more go through a shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of text that the word kernel takes at a time.
CHUNK_BYTES = 1_000_000
#: Texts that the word kernel takes at a time.
CHUNK_TEXTS = 20_000
#: Bytes of a batch that goes to a Python worker, about, unless the session says otherwise.
BATCH_BYTES = 8 << 20


def shared(spark: SparkSession) -> None:
    """Make checkpoint() usable: the cluster's ``spark.checkpoint.dir``, or a folder of our own where that is unset."""
    if spark.sparkContext.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(given or tempfile.mkdtemp(prefix="checkpoint-"))  # one machine: a local folder is shared


def lean(spark: SparkSession) -> None:
    """Smaller batches for Python workers; a value that the session has set itself stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == str(64 << 20) + "b":
        spark.conf.set(name, f"{BATCH_BYTES}b")


def tidy(run: Callable) -> Callable:
    """``run`` for mapInArrow, giving back to the system at a task's end the memory that a reused Python worker would keep."""

    def clean(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return clean


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder, of which later steps read only the columns they need.

    Rows numbered with monotonically_increasing_id keep their numbers, since they are read and not made again."""
    shared(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(removed, df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours, if the session is still there."""
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001 - the session has ended; whoever owns the shared folder clears it
        return


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if its counted ``rows`` stay within ``limit``; else leave the join to a shuffle."""
    return F.broadcast(df) if rows <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(col):
    """Lower-case A-Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(col, F.lit("")), UPPER, LOWER)


_B = 0x9E3779B97F4A7C15 | 1
_BINV = pow(_B, -1, 1 << 64)
_POW = {}
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes up to which a word's hash may be a polynomial; modulo 2**64 words of 512 bytes and more can be made, or happen, to agree.
_SHORT = 32
#: 0 white space, 1 ASCII letters and digits and all that is not ASCII, 2 other signs.
_CLASS = np.full(256, 2, dtype=np.uint8)
_CLASS[_SPACE] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if _POW.get("n", 0) < n:
        n = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            _POW.update(n=n, up=np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _B, np.uint64)]), dtype=np.uint64), down=np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BINV, np.uint64)]), dtype=np.uint64))
    return _POW["up"], _POW["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits depend on all bits."""
    h = h.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


class Words:
    """The words of some texts: 64-bit hashes in order, each text's slice, byte places in the joined buffer.

    A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; ``first[i]:first[i + 1]`` are the words of text i.
    kind "apart": case is kept, and runs of signs are words of their own. kind "plain": signs separate words."""

    def __init__(self, texts: list[bytes | None], kind: str = "words"):
        texts = [t or b"" for t in texts]
        data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.base = np.concatenate([[0], np.cumsum(size)])
        if kind != "words":
            sort = np.concatenate([[0], _CLASS[data]])
            if kind == "plain":
                sort[sort == 2] = 0
            edge = np.flatnonzero(np.diff(sort))
            inside = sort[edge + 1] > 0
            self.start, self.end = edge[inside], edge[np.flatnonzero(inside) + 1]
        else:
            edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data]]).view(np.int8)))
            self.start, self.end = edge[0::2], edge[1::2]
        up, down = _powers(len(data))
        with np.errstate(over="ignore"):
            folded = data if kind == "apart" else _FOLD[data]
            part = (folded.astype(np.uint64) + np.uint64(1)) * up[: len(data)]
            total = np.concatenate([[np.uint64(0)], np.cumsum(part, dtype=np.uint64)])
            self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        for i in np.flatnonzero(self.end - self.start > _SHORT).tolist():
            self.hash[i] = xxhash.xxh3_64_intdigest(folded[self.start[i] : self.end[i]].tobytes(), seed=_B)
        self.first = np.searchsorted(self.start, self.base)
        self.data = data

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text's number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def word_hash(word: str) -> int:
    """The hash that Words gives a single word."""
    return int(Words([word.encode()]).hash[0])


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n consecutive hashes."""
    out = hashes[: len(hashes) - n + 1].copy()
    with np.errstate(over="ignore"):
        for i in range(1, n):
            out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : len(hashes) - n + 1 + i]
    return mix(out)


def chunks(batch: pa.RecordBatch, inside: int | None = None) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of a batch of about CHUNK_BYTES of text each; a longer text stands alone.

    The text is the column ``text``, or the field ``inside`` of the struct that comes first."""
    col = batch.column(batch.schema.get_field_index("text")) if inside is None else pc.struct_field(batch.column(0), [inside])
    col = col.cast(pa.large_binary())
    sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0).cast(pa.int64()))
    begin, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if (total and total + n > CHUNK_BYTES) or i - begin >= CHUNK_TEXTS:
            yield batch.slice(begin, i - begin), col.slice(begin, i - begin).to_pylist()
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield batch.slice(begin), col.slice(begin).to_pylist()


def crc_mod(col: str, n: int):
    """crc32 of the id written as text, modulo n; a null id counts as the text ``''``."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)`` as ``(node, label)``, label the smallest node reached.

    Randomised contraction: in every round each node points at the neighbour that comes first in an order drawn anew for the
    round; of two that point at each other the first stays where it is. Pointers are followed, and the edges renamed to where
    they lead. A star is gone after one round, and of any graph at most half the nodes point nowhere else, so about log n rounds
    are needed: 100,000 nodes in a chain take 10 or so.
    A hub's edges are pre-aggregated before each shuffle. Rounds are cut with checkpoint(); nothing but a count comes to the driver."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct()
    both, steps = cut(both), []
    while both.limit(1).count():
        first = lambda x, n=len(steps): F.struct(F.xxhash64(F.col(x), F.lit(n)).alias("h"), F.col(x).alias("to"))
        step = both.groupBy(F.col("u").alias("node")).agg(F.min(first("v"))["to"].alias("to"))
        for k in range(3):
            after = step.select(F.col("node").alias("to"), F.col("to").alias("then"))
            mutual = F.when(F.col("then") == F.col("node"), F.least(first("node"), first("to"))["to"]).otherwise(F.col("to"))
            step = step.join(after, "to").select("node", (F.col("then") if k else mutual).alias("to"))
        steps.append(cut(step))
        for x in ("v", "u"):
            both = both.join(steps[-1].withColumnRenamed("node", x), x).select(*(F.col("to").alias(c) if c == x else c for c in ("u", "v"))).distinct()
        both = cut(both.where("u <> v"))
    if not steps:
        return both.select(F.col("u").alias("node"), F.col("v").alias("label"))
    found = steps.pop()
    while steps:  # backwards, so that the joins grow with the rounds' nodes
        later = found.select(F.col("node").alias("to"), F.col("to").alias("then"))
        found = steps.pop().join(later, "to", "left").select("node", F.coalesce("then", "to").alias("to"))
    found = cut(found)
    label = found.groupBy("to").agg(F.min("node").alias("label"))
    return found.join(label, "to").select("node", "label")
