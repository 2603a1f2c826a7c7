"""N-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles (64-bit hashes). Equal sets count as one. Then

1. partition: every set's prefix (the rarest shingles, so many that two similar sets must share several) is posted; where
   sets meet under a shingle, the smallest number is the hub, first inside a block of sets, then among blocks. A set joins the
   group of the hub that it shares most shingles with if the whole sets prove similar. That is one comparison for each
   set, and it collapses families of near copies however large they are;
2. token-group matrix: sets that share a hub, linked or not, are stored in pieces of about GROUP sets and CELLS shingles: the
   sorted union of their shingles, and for each set its columns in that union. Shingles that several pieces post say which pieces
   must look at each other. Of such a pair first the unions alone meet: their overlap bounds every overlap of their sets, and only
   pairs that reach the least need are opened. There the overlap of each set with the other union is its bound, and the sets that
   reach their need are compared all at once, as a product of the two matrices over the common columns.

Pieces are compared inside a group too, so every link between different sets is found once and counted for both ends, weighted by the
rows of the other end's set; a row's equals are its links as well. A group of m near copies has about m^2 links, and counting them costs as
much; a caller that needs the components only leaves out pairs of pieces inside one group (links=False), and only then the comparison
of step 1 is worth its exchange: where all links are counted every set is a group of its own until the pieces are opened. The order of shingles comes from a sketch of
their frequencies over all documents; any order gives the same result.

Rows are numbered when they are first read, and all steps go by that number, so ids may be repeated or null. Defined cases: a null or
blank text has no shingles and links with nothing; a text with fewer words than a shingle is one shingle; component_id is the smallest
id of the component, null if it has none; repeated rows and ids are rows of their own; an empty table gives no rows; other columns are
ignored, or carried inside ``row``."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, chain, chunks, components, cut, lean, mix, small, tidy, written

#: Words in a shingle and the least similarity, in per cent, unless a caller sets them.
WORDS, PERCENT = 5, 80
#: Sets in a piece of a group, and shingles in it, about.
GROUP, CELLS = 1024, 1 << 19
#: Members of a hub that one task compares at a time, and pieces that meet one piece, or under one shingle, in a task.
LANE, WIDE = 256, 64
#: Cells of the matrices that are multiplied at a time.
DENSE = 1 << 22
#: Sets share one shingle more in their prefixes for each so many shingles.
STEP = 100
#: Postings that a block or a bucket holds, about.
BLOCK = 1_500_000
#: Bitmaps of 4 KB, for 32,768 row numbers each, that may be broadcast.
BITMAPS = 8192
#: The sketch's counters, as a power of two, and its parts.
SKETCH, PARTS = 21, 32


def shingle_lists(texts: list[bytes | None], k: int):
    """For each text its shingles' hashes, with repeats."""
    words = Words(texts)
    runs = chain(words.hash, k) if len(words.hash) >= k else np.zeros(0, np.uint64)
    for i, count in enumerate(words.count.tolist()):
        begin = words.first[i]
        if count >= k:
            yield runs[begin : begin + count - k + 1]
        elif count:
            yield mix(chain(words.hash[begin : begin + count], count) + np.uint64(count))
        else:
            yield runs[:0]


def sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Log-scaled counts of shingles by the first bits of their hash, over all documents."""
    width = (1 << SKETCH) // PARTS

    def count(batches):
        total, waiting, held = np.zeros(1 << SKETCH, np.int64), [], 0

        def flush():
            return np.bincount((np.concatenate(waiting) >> np.uint64(64 - SKETCH)).astype(np.int64), minlength=1 << SKETCH) if waiting else 0

        for batch in batches:
            for _, texts in chunks(batch):
                waiting += [x.copy() for x in shingle_lists(texts, k)]
                held += sum(map(len, waiting[-len(texts) :]))
                if held > 4_000_000:
                    total += flush()
                    waiting, held = [], 0
        total += flush()
        lane = TaskContext.get().partitionId() % 16
        blocks = [zlib.compress(np.minimum(total[i * width : (i + 1) * width], 65535).astype(np.uint16).tobytes(), 1) for i in range(PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([lane] * PARTS, pa.int32()), pa.array(blocks, pa.binary())], names=["part", "lane", "counts"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.int64)
        for x in rows["counts"]:
            raw = zlib.decompress(x)
            total += np.frombuffer(raw, np.uint16 if len(raw) == 2 * width else np.int64)
        return pd.DataFrame({"part": [key[0]], "lane": [0], "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = "part int, lane int, counts binary"
    by_lane = docs.mapInArrow(tidy(count), schema).groupBy("part", "lane").applyInPandas(add, schema)
    found = {r["part"]: np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in by_lane.groupBy("part").applyInPandas(add, schema).collect()}  # PARTS rows
    total = np.concatenate([found.get(i, np.zeros(width, np.int64)) for i in range(PARTS)])
    return np.minimum(np.log2(total + 1.0) * 1500, 65535).astype(np.uint16)


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def need(n, percent: int):
    """The least overlap that a set of n shingles has with a similar one."""
    return -(-n * percent // 100)


def least_shared(n):
    """Shingles that the prefixes of two similar sets share at least, if the smaller has n."""
    return 1 + n // STEP


def prefix(n: int, percent: int) -> int:
    """How many of a set's n shingles are posted."""
    return min(n, n - need(n, percent) + least_shared(n))


def dump(*arrays: np.ndarray) -> bytes:
    """Integer arrays as compressed byte planes, the first one sorted and kept as differences."""
    first = np.diff(arrays[0].astype(np.uint64), prepend=np.uint64(0))
    planes = b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes() for x in (first, *arrays[1:]))
    return zstandard.ZstdCompressor(level=1).compress(planes)


def load(raw: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(widths), 0, []
    for k, w in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * w, at).reshape(w, n).T).view(k).ravel())
        at += n * w
    with np.errstate(over="ignore"):
        out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    small_, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small_) < percent * len(large):
        return False
    common = overlap(small_, large)
    return 100 * common >= percent * (len(a) + len(b) - common)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted sets."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def bundle(*arrays: np.ndarray) -> bytes:
    """Arrays of any lengths as compressed byte planes."""
    head = np.array([n for x in arrays for n in (len(x), x.dtype.itemsize)], dtype="<i8").tobytes()
    planes = b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes() for x in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + planes)


def unbundle(raw: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    at, out = 16 * len(kinds), []
    for kind, (n, width) in zip(kinds, np.frombuffer(raw, "<i8", 2 * len(kinds)).reshape(-1, 2).tolist(), strict=True):
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


class Rarest:
    """Postings by prefix: a set's rarest shingles, so many that two similar sets share as many of them as ``shared`` says."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.percent = percent
        self.order = docs.sparkSession.sparkContext.broadcast(sketch(docs.select("text"), words))  # 4 MB

    def of(self, sets: list[np.ndarray]) -> list[np.ndarray]:
        """Sorted tokens of each of some sets, none of them empty."""
        out = []
        for found in sets:
            rare = self.order.value[(found >> np.uint64(64 - SKETCH)).astype(np.int64)]
            out.append(np.sort(found[np.lexsort((found, rare))[: prefix(len(found), self.percent)]]))
        return out

    def expected(self, n):
        """About how many tokens a set of n shingles posts, as a column."""
        return n * (100 - self.percent + 100 // STEP) / 100

    def shared(self, n):
        """How many tokens a set of n shingles shares with a similar one at least, as a column."""
        return 1 + F.floor(F.ceil(n * self.percent / 100) / STEP)  # the smallest similar set has need(n) shingles


class Piece:
    """A piece of the token-group matrix: the union of its sets' shingles, and each set's columns in it."""

    def __init__(self, union: bytes, matrix: bytes):
        self.union = load(union, "<u8")[0]
        self.reps, self.groups, self.many, sizes, self.column = unbundle(matrix, "<i8", "<i8", "<i8", "<u4", "<u4")
        self.sizes = sizes.astype(np.int64)
        self.owner = np.repeat(np.arange(len(sizes)), self.sizes)

    @staticmethod
    def of(members: list[tuple[int, int, int, np.ndarray]]) -> tuple[bytes, bytes]:
        """The stored form of (number, group, rows, shingles)."""
        union, column = np.unique(np.concatenate([x for *_, x in members]), return_inverse=True)
        ints = (np.array([m[i] for m in members], dtype="<i8") for i in range(3))
        return dump(union), bundle(*ints, np.array([len(x) for *_, x in members], dtype="<u4"), column.astype("<u4"))

    def inside(self, at: np.ndarray, percent: int):
        """The sets whose overlap with the columns ``at`` reaches their need: numbers, and (set, place in ``at``) of their shingles, by place."""
        place = np.full(len(self.union), -1, np.int64)
        place[at] = np.arange(len(at))
        column = place[self.column]
        own, column = self.owner[column >= 0], column[column >= 0]
        fine = np.bincount(own, minlength=len(self.sizes)) >= need(self.sizes, percent)
        rank = np.where(fine, np.cumsum(fine) - 1, -1)[own]
        own, column = rank[rank >= 0], column[rank >= 0]
        order = np.argsort(column, kind="stable")
        return np.flatnonzero(fine), own[order], column[order]


def meet(p: Piece, q: Piece, percent: int) -> np.ndarray:
    """Which sets of p are similar to which of q; no set is similar to itself."""
    hits = np.zeros((len(p.sizes), len(q.sizes)), bool)
    common, at_p, at_q = np.intersect1d(p.union, q.union, assume_unique=True, return_indices=True)
    rows, own_p, column_p = p.inside(at_p, percent)
    columns, own_q, column_q = q.inside(at_q, percent)
    if not len(rows) or not len(columns):
        return hits
    width = max(1, DENSE // (len(rows) + len(columns)))
    total = np.zeros((len(rows), len(columns)), np.int64)
    for first in range(0, len(common), width):
        sides = []
        for n, own, column in ((len(rows), own_p, column_p), (len(columns), own_q, column_q)):
            part = slice(*np.searchsorted(column, (first, first + width)))
            dense = np.zeros((n, min(width, len(common) - first)), np.float32)
            dense[own[part], column[part] - first] = 1
            sides.append(dense)
        total += (sides[0] @ sides[1].T).astype(np.int64)
    hits[np.ix_(rows, columns)] = 100 * total >= percent * (p.sizes[rows, None] + q.sizes[columns] - total)
    return hits & (p.reps[:, None] != q.reps)


def stars(a: np.ndarray, b: np.ndarray):
    """Pairs that connect what the pairs (a, b) connect: the smallest of each component with every other."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = np.split(at, 2)
    label, every = np.arange(len(names)), np.arange(len(names))
    while True:
        low, least = label.copy(), np.minimum(label[u], label[v])
        np.minimum.at(low, u, least)
        np.minimum.at(low, v, least)
        low = low[low]
        if np.array_equal(low, label):
            break
        label = low
    at = every[label != every]
    return zip(names[label[at]].tolist(), names[at].tolist(), strict=True)


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links) and, unless ``links`` is False, n_links (the other rows that are similar) for every row."""
    return jaccard_marks(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), words, percent, links).drop("uid", "first")


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, of each component only one: that with the smallest id, nulls last."""
    table = written(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct("*").alias("row")))
    marks = jaccard_marks(table.select("uid", F.col("row")[id_col].cast("long").alias("doc_id"), F.col("row")[text_col].alias("text")), words, percent, links=False)
    gone = cut(marks.where("not first").select("uid"))
    return table.join(small(gone, gone.count()), "uid", "left_anti").select("row.*")


def jaccard_marks(docs: DataFrame, words: int, percent: int, links: bool = True, posting: Rarest | None = None) -> DataFrame:
    """uid, doc_id, n_shingles, component_id, first (whether the row stands for its component), n_links for rows of doc_id and text, and uid if
    they are numbered already. ``posting`` gives the tokens under which sets meet; by default those of Rarest."""
    lean(docs.sparkSession)
    spark = docs.sparkSession
    numbered = "uid" in docs.columns
    posting = posting or Rarest(docs, words, percent)

    def describe(batches):
        for batch in batches:
            for part, texts in chunks(batch):
                found = [np.unique(x) for x in shingle_lists(texts, words)]
                sizes, digests = [len(x) for x in found], [digest(x) if len(x) else None for x in found]
                tokens = iter(posting.of([x for x in found if len(x)]))
                fronts = [dump(next(tokens)) if n else None for n in sizes]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(fronts, pa.binary()), *part.columns[2:]], names=names)

    names = ["doc_id", "n_shingles", "digest", "front", *(["uid"] if numbered else [])]
    kinds = "doc_id long, n_shingles long, digest binary, front binary" + ", uid long" * numbered
    rows = docs.select("doc_id", "text", *names[4:]).mapInArrow(tidy(describe), kinds)
    rows = written(rows if numbered else rows.withColumn("uid", F.monotonically_increasing_id()))
    some = rows.where("n_shingles > 0")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "uid"))
    reps = some.groupBy("digest").agg(best.alias("best"), F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("many"))
    reps = written(reps.withColumn("rep", F.col("best")["uid"]))
    posted = some.agg(F.coalesce(F.sum(posting.expected(F.col("n_shingles"))), F.lit(0))).first()[0]
    buckets = max(6, int(posted // BLOCK))

    def post(batches):
        """Postings in blocks: those that meet inside a block (bucket -1), and the first of each shingle for its bucket."""
        fronts, names, sizes, held = [], [], [], 0

        def flush():
            token = np.concatenate(fronts)
            count = [len(x) for x in fronts]
            rep, n = np.repeat(np.array(names, np.int64), count), np.repeat(np.array(sizes, np.uint32), count)
            by = np.lexsort((rep, token))
            token, rep, n = token[by], rep[by], n[by]
            first = np.concatenate([[True], token[1:] != token[:-1]])
            start = np.flatnonzero(first)
            times = np.diff(np.concatenate([start, [len(token)]]))
            meet = np.repeat(times > 1, times)
            hub = np.repeat(rep[start], times)
            loads = [(-1, dump(token[meet], rep[meet], n[meet], hub[meet]))] if meet.any() else []
            token, rep, n = token[start], rep[start], n[start]
            bucket = ((token >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            loads += [(i, dump(token[a:z], rep[a:z], n[a:z])) for i, (a, z) in enumerate(zip(edges, edges[1:], strict=False)) if z > a]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in loads], pa.int64()), pa.array([x[1] for x in loads], pa.binary())], names=["bucket", "load"])

        for batch in batches:
            for rep, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fronts.append(load(raw, "<u8")[0])
                names.append(rep)
                sizes.append(n)
                held += len(fronts[-1])
                if held > BLOCK:
                    yield flush()
                    fronts, names, sizes, held = [], [], [], 0
        if held:
            yield flush()

    def gather(batches):
        """Postings of shingles that several sets have: (token, rep, n, hub)."""

        def out(token, rep, n, hub):
            return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(rep), pa.array(n.astype(np.int32)), pa.array(hub)], names=["token", "rep", "n", "hub"])

        def together(loads):
            token, rep, n = (np.concatenate(x) for x in zip(*loads, strict=True))
            by = np.lexsort((rep, token))
            token, rep, n = token[by], rep[by], n[by]
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            times = np.diff(np.concatenate([start, [len(token)]]))
            several = np.repeat(times > 1, times)
            return out(token[several], rep[several], n[several], np.repeat(rep[start], times)[several])

        number, loads = None, []
        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket < 0:
                    yield out(*load(raw, "<u8", "<i8", "<u4", "<i8"))
                    continue
                if bucket != number and loads:
                    yield together(loads)
                    loads = []
                number = bucket
                loads.append(load(raw, "<u8", "<i8", "<u4"))
        if loads:
            yield together(loads)

    fronts = _chosen(some, reps.select("rep")).select("uid", F.col("n_shingles"), "front")
    dealt = fronts.mapInArrow(tidy(post), "bucket long, load binary")
    dealt = dealt.withColumn("at", F.when(F.col("bucket") < 0, F.xxhash64("load")).otherwise(F.col("bucket")))
    dealt = dealt.repartition(buckets, "at").sortWithinPartitions("bucket").select("bucket", "load")
    posts = written(dealt.mapInArrow(tidy(gather), "token long, rep long, n int, hub long"))
    pairs = posts.groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("shared"), F.max("n").alias("n"))
    other = F.when(F.col("rep") != F.col("hub"), F.struct("shared", "hub"))
    met = pairs.groupBy("rep").agg(F.max("n").alias("n"), F.sum("shared").alias("shared"), F.max(other).alias("best"))
    wanted = posting.shared(F.col("n"))
    met = cut(met.where(F.col("shared") >= wanted).select("rep", "n", F.col("best.hub").alias("hub")))
    n_met = met.count()
    if not n_met:
        return _marks(rows, reps, None, None, links)

    def sets_of(batches):
        """The sets of those texts that have the digest wanted, or of all where none is given; (text, digest or null, …)."""
        for batch in batches:
            for part, texts in chunks(batch):
                wanted, found = part.column(1).to_pylist(), list(shingle_lists(texts, words))
                sets_ = [np.unique(x) for x in found]
                digests = [digest(x) for x in sets_]
                at = pa.array([i for i, (a, d) in enumerate(zip(wanted, digests, strict=True)) if a is None or a == d], pa.int64())
                loads = [dump(sets_[i]) for i in at.to_pylist()]
                yield pa.RecordBatch.from_arrays([*(c.take(at) for c in part.columns[2:]), pa.array(digests, pa.binary()).take(at), pa.array(loads, pa.binary())], names=[*part.schema.names[2:], "digest", "shingles"])

    no = F.lit(None).cast("binary")
    if numbered:
        texts = docs.join(small(met, n_met), F.col("uid") == F.col("rep")).select("text", no.alias("digest"), "rep", "hub")
        sets = texts.mapInArrow(tidy(sets_of), "rep long, hub long, digest binary, shingles binary")
    else:  # by the id where just one set has it, else by the digest; rows that are equal in both give a set more than once
        asked_for = met.join(reps.select("rep", "digest", F.col("best")["doc_id"].alias("id")), "rep").select("rep", "hub", "digest", "id")
        times = asked_for.groupBy(F.col("id").alias("same")).agg(F.count(F.lit(1)).alias("sets"))
        asked_for = cut(asked_for.join(times, F.col("id").eqNullSafe(F.col("same"))).select("rep", "hub", "digest", "id", (F.col("sets") == 1).alias("alone")))
        alone, shared = asked_for.where("alone and id is not null"), asked_for.where("not alone or id is null")
        texts = docs.join(small(alone, n_met), F.col("doc_id") == F.col("id")).select("text", "digest", "rep", "hub")
        sets = texts.mapInArrow(tidy(sets_of), "rep long, hub long, digest binary, shingles binary")
        if n_shared := shared.count():
            ids = shared.select("id").distinct()
            texts = docs.join(small(ids, n_shared), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text", no.alias("digest"))
            more = texts.mapInArrow(tidy(sets_of), "digest binary, shingles binary").join(small(shared, n_shared), "digest")
            sets = sets.unionByName(more.select("rep", "hub", "digest", "shingles"))
    sets = sets.drop("digest")

    def compare(batches):
        hub = None
        for batch in batches:
            us, vs = [], []
            for key, rep, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                found = load(raw.as_py(), "<u8")[0]
                if rep is None:
                    hub = (key, found)
                elif hub and hub[0] == key and similar(found, hub[1], percent):
                    us.append(rep)
                    vs.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    if not links:  # 1: each set against its hub, in lanes of the hub's members
        sets = written(sets)
        lanes = met.where("hub is not null").groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / LANE).cast("int").alias("lanes"))
        lanes = cut(lanes)
        lanes = small(lanes, lanes.count())
        members = sets.where("hub is not null").join(lanes, "hub").select("hub", F.pmod(F.xxhash64("rep"), F.col("lanes")).cast("int").alias("lane"), "rep", "shingles")
        heads = sets.drop("hub").join(lanes, F.col("rep") == F.col("hub")).select("hub", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"), F.lit(None).cast("long").alias("rep"), "shingles")
        met_hubs = members.unionByName(heads).repartition("hub", "lane").sortWithinPartitions("hub", "lane", F.col("rep").asc_nulls_first())
        groups = components(met_hubs.mapInArrow(tidy(compare), "u long, v long"))
        groups = groups.select(F.col("node").alias("rep"), F.col("label").alias("grp"))

    # 2: pieces of sets with a common hub (two steps up): which of them must look at each other
    up = met.select(F.col("rep").alias("hub"), F.col("hub").alias("above"))
    own = met.join(up, "hub", "left").select("rep", "n", F.coalesce("above", "hub", "rep").alias("c"))
    split = cut(own.groupBy("c").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP), F.ceil(F.sum("n") / CELLS)).alias("chunks")))
    home = own.join(small(split, split.count()), "c").join(reps.select("rep", "many"), "rep")
    home = home.withColumn("grp", F.col("rep")) if links else home.join(groups, "rep", "left")
    piece = F.xxhash64("c", F.pmod(F.xxhash64("rep"), "chunks"))
    home = cut(home.select("rep", "n", piece.alias("piece"), F.coalesce("grp", "rep").alias("grp"), "many"))
    seen = posts.select("token", "rep").join(home, "rep").groupBy("token", "piece")
    seen = seen.agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("grp").alias("a"), F.max("grp").alias("b"))
    per = seen.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.min("a").alias("least"), F.max("b").alias("most"))
    per = per.where("k > 1" if links else "k > 1 and least <> most").select("token", F.ceil(F.col("k") / WIDE).cast("long").alias("lanes"))
    seen = written(seen.join(per, "token"))
    one = seen.withColumn("lane", F.pmod(F.xxhash64("piece"), "lanes")).drop("lanes")
    other = seen.select("token", *(F.col(x).alias(f"{x}2") for x in ("piece", "low", "high", "a", "b")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1)).alias("lane"))
    apart = F.least("a", "a2") != F.greatest("b", "b2")
    fits = (F.col("high2") * 100 >= F.col("low") * percent) & (F.col("high") * 100 >= F.col("low2") * percent)
    asked = one.join(other, ["token", "lane"]).where((F.col("piece") > F.col("piece2")) & (fits if links else fits & apart))
    asked = asked.groupBy("piece", "piece2").agg(F.count(F.lit(1)).alias("shared"), F.min("low").alias("n"))
    asked = cut(asked.where(F.col("shared") >= wanted).select("piece", "piece2"))

    def store(batches):
        """One row for each piece; rows of a piece come together."""
        number, members = None, []

        def out():
            sizes, groups_ = [len(x) for *_, x in members], [g for _, g, *_ in members]
            union, matrix = Piece.of(members)
            row = [number, len(members), min(sizes), min(groups_) != max(groups_), union, matrix]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()), strict=True)], names=["piece", "members", "low", "mixed", "union", "matrix"])

        for batch in batches:
            for p, rep, grp, many, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True):
                if p != number and members:
                    yield out()
                    members = []
                number = p
                if members and members[-1][0] == rep:  # an equal row
                    continue
                members.append((rep, grp, many, load(raw.as_py(), "<u8")[0]))
        if members:
            yield out()

    filled = sets.select("rep", "shingles").join(small(home, n_met), "rep").select("piece", "rep", "grp", "many", "shingles")
    pieces = written(filled.repartition("piece").sortWithinPartitions("piece", "rep").mapInArrow(tidy(store), "piece long, members long, low long, mixed boolean, union binary, matrix binary"))

    def beside(pairs: DataFrame, key: str, partner: str, columns: list[str]) -> DataFrame:
        """Columns of a piece beside each pair, WIDE pairs of a piece in a task."""
        lanes = cut(pairs.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / WIDE).cast("long").alias("lanes")))
        lanes = small(lanes, lanes.count())
        left = pairs.join(lanes, key).withColumn("lane", F.pmod(F.xxhash64(partner), "lanes")).drop("lanes")
        right = pieces.select(F.col("piece").alias(key), *(F.col(x).alias(x + key[5:]) for x in columns)).join(lanes, key)
        return left.join(right.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1))).drop("lanes"), [key, "lane"]).drop("lane")

    def bound(batches):
        """The pairs whose unions share as much as their smallest sets need."""
        for batch in batches:
            p, q, union, low, union2, low2 = (batch.column(i) for i in range(6))
            fine = [overlap(*(load(x.as_py(), "<u8")[0] for x in (a, b))) >= need(max(m, n), percent) for a, m, b, n in zip(union, low.to_pylist(), union2, low2.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([p, q, pa.array(fine, pa.bool_())], names=["piece", "piece2", "fine"])

    unions = beside(beside(asked, "piece", "piece2", ["union", "low"]), "piece2", "piece", ["union", "low"])
    ready = unions.select("piece", "piece2", "union", "low", "union2", "low2").mapInArrow(tidy(bound), "piece long, piece2 long, fine boolean")
    ready = cut(ready.where("fine").drop("fine"))
    parts = ["union", "matrix"]
    pairs = beside(beside(ready, "piece", "piece2", parts), "piece2", "piece", parts).select("piece", *parts, "piece2", "union2", "matrix2")
    alone = pieces.where("members > 1" if links else "members > 1 and mixed")
    nothing = F.lit(None).cast("binary")
    pairs = pairs.unionByName(alone.select("piece", *parts, F.col("piece").alias("piece2"), nothing.alias("union2"), nothing.alias("matrix2")))

    def open_pieces(batches):
        """Pairs of groups that belong together (n null), and for a set the linked rows that a pair of pieces adds (v null)."""
        kept: dict[int, Piece] = {}
        for batch in batches:
            joined, reps_, counts = set(), [], []
            for i in range(len(batch)):
                both = []
                for at in (0, 3):
                    name = batch.column(at)[i].as_py()
                    if name not in kept:
                        while len(kept) > 1:
                            kept.pop(next(iter(kept)))
                        kept[name] = Piece(batch.column(at + 1)[i].as_py(), batch.column(at + 2)[i].as_py())
                    both.append(kept[name])
                p, q = both
                hits = meet(p, q, percent)
                if not hits.any():
                    continue
                if links:
                    reps_.append(p.reps)
                    counts.append(hits @ q.many)
                    if p is not q:
                        reps_.append(q.reps)
                        counts.append(p.many @ hits)
                a, b = np.nonzero(hits)
                joined |= set(stars(p.groups[a], q.groups[b]))
            rep, at = np.unique(np.concatenate([np.zeros(0, np.int64), *reps_]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([np.zeros(0), *counts]), minlength=len(rep)).astype(np.int64)
            us, vs, ns = [x for x, _ in joined] + rep.tolist(), [x for _, x in joined] + [None] * len(rep), [None] * len(joined) + n.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (us, vs, ns)], names=["u", "v", "n"])

    opened = cut(pairs.mapInArrow(tidy(open_pieces), "u long, v long, n long"))
    joined = components(opened.where("n is null").select("u", "v"))
    linked = opened.where("n is not null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("linked")) if links else None
    labels = home.join(joined, F.col("grp") == F.col("node"), "left").select("rep", F.coalesce("label", "grp").alias("grp"))
    return _marks(rows, reps, labels, linked, links)


def _chosen(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """The rows whose uid is a rep, by bitmaps of the reps, so that rows need no exchange; beyond BITMAPS of them by a shuffle."""
    block = F.bitmap_bucket_number("rep").alias("block")
    maps = reps.select("rep", block).repartition("block").groupBy("block").agg(F.bitmap_construct_agg(F.bitmap_bit_position("rep")).alias("bits"))
    maps = cut(maps)
    if maps.count() > BITMAPS:
        return rows.join(reps, F.col("uid") == F.col("rep"), "left_semi")
    place = "cast(bitmap_bit_position(uid) AS int)"
    byte = f"cast(conv(hex(substring(bits, cast({place} div 8 AS int) + 1, 1)), 16, 10) AS int)"
    found = rows.join(F.broadcast(maps), F.bitmap_bucket_number("uid") == F.col("block"))
    return found.where(f"shiftright({byte}, {place} % 8) & 1 = 1").drop("block", "bits")


def _marks(rows: DataFrame, reps: DataFrame, labels: DataFrame | None, linked: DataFrame | None, links: bool) -> DataFrame:
    """Every row with the component and the links of its set; labels: (rep, grp), linked: (rep, linked) of the sets that have company.

    Rows find their set by its digest; sets that many rows have are broadcast, and rows without shingles take no part."""
    classes = reps.select("digest", "rep", "best", "many")
    if labels is not None:
        each = labels.join(classes.select("rep", "best"), "rep")
        heads = each.groupBy("grp").agg(F.min("best").alias("head"))
        known = each.join(heads, "grp").select("rep", "head")
        known = known.join(linked, "rep", "left") if linked is not None else known.withColumn("linked", F.lit(0))
        classes = classes.join(known, "rep", "left")
    else:
        classes = classes.withColumns({"head": F.col("best"), "linked": F.lit(0)})
    n_links = (F.col("many") - 1 + F.coalesce("linked", F.lit(0))).cast("long")
    head = F.coalesce("head", "best")
    classes = cut(classes.select("digest", "many", head["doc_id"].alias("component_id"), head["uid"].alias("head"), n_links.alias("n_links")))
    often = max(1000, rows.count() // 10_000)
    hot = F.broadcast(classes.where(F.col("many") > often))  # 10,000 sets at most
    some = rows.where("n_shingles > 0").select("uid", "doc_id", "n_shingles", "digest")
    found = some.join(hot, "digest").unionByName(some.join(hot.select("digest"), "digest", "left_anti").join(classes.where(F.col("many") <= often), "digest"))
    out = ["uid", "doc_id", "n_shingles", "component_id", (F.col("uid") == F.col("head")).alias("first"), *(["n_links"] if links else [])]
    none = rows.where("n_shingles = 0").select("uid", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"), *([F.lit(0).cast("long").alias("n_links")] if links else []))
    return found.select(*out).unionByName(none)
