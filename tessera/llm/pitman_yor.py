"""Language-model scoring with a hierarchical Pitman-Yor model.

Every word is a customer in the restaurant of the word before it; every table there sends one customer to the shared parent
restaurant, whose base is uniform over the training words and one unknown word. Every training word has its restaurant (and the
text's end, which opens a text); after a word never seen in training the parent alone decides.

Seating is sampled by Gibbs on the numbers of tables: given everything else, the tables t of c customers of one word in one
restaurant have probability proportional to S(c, t) a^t, with the generalised Stirling number S and a = (strength +
discount T) P_parent(word); drawn exactly up to EXACT customers, and further customers are seated in growing blocks. The
predictive probabilities of SAMPLES seatings are averaged.

Everything about a word lies in the bucket of its hash: its counts after every context, its tables, and where it
stands in which texts. The CONTEXTS most frequent words would overfill a bucket: what they count after each other is a bounded
table, sampled on the driver and broadcast, and where they follow a rarer word they lie in the bucket of that context instead.
Buckets are coupled by the restaurants' totals: those of the frequent contexts are summed on the driver, those of a rarer context in its
bucket, which gets them from the words' buckets in packed notes and sends the sums back. CONTEXTS decides where a count is kept, not whether.

Defined cases: a null or empty text is one token, the end; a null id is carried; repeated rows are scored and counted each
on their own; without any training text every probability is 1; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, chunks, cut, lean, mix, tidy

CONTEXTS = 512
STRENGTH = 1.0
#: Customers whose tables are drawn from the exact distribution.
EXACT = 64
#: Gibbs sweeps before each exchange of totals, before the first sample, and samples.
SWEEPS, BURN_IN, SAMPLES = 3, 2, 4
#: Tokens in a bucket, and tokens in a block of texts, about.
BUCKET, BLOCK = 3_000_000, 2_500_000
#: A rarer context is named by the first 48 bits of its hash: two of ten million words share a name with a chance of one in six.
NAME = np.uint64(2**64 - 2**16)
#: Logarithms of a text's tokens in a bucket are sent as multiples of this.
UNIT = 2.0**-32
END = int(mix(np.array([2**63 + 5], dtype=np.uint64))[0])


def _dump(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, by byte planes."""
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes() for x in arrays]
    head = np.array([n for x in arrays for n in (len(x), x.dtype.itemsize)], dtype="<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(bytes([len(arrays)]) + head + b"".join(planes))


def _load(raw: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = raw[0]
    head = np.frombuffer(raw, "<i8", 2 * n, 1)
    at, out = 1 + 16 * n, []
    for k, width in head.reshape(-1, 2).tolist():
        planes = np.frombuffer(raw, np.uint8, k * width, at).reshape(width, k)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel())
        at += k * width
    return out


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of some texts, the ends included: hashes, the hash before each (the end opens a text), and the text of each."""
    words = Words(texts)
    count = words.count
    places = np.arange(len(words.hash)) + words.text_of()
    hashes = np.full(len(words.hash) + len(texts), END, np.uint64)
    hashes[places] = words.hash
    before = np.concatenate([[np.uint64(END)], hashes[:-1]]) if len(hashes) else hashes
    return hashes, before, np.repeat(np.arange(len(texts)), count + 1)


class Ranks:
    """Number of a hash among the context words, or -1."""

    def __init__(self, hashes: list[int]):
        found = np.array(hashes, dtype=np.uint64)
        order = np.argsort(found)
        self.keys, self.rank, self.size = found[order], order.astype(np.int64), len(found)
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(found >> np.uint64(48)).astype(np.int64)] = True

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        if len(at) and self.size:
            place = np.minimum(np.searchsorted(self.keys, hashes[at]), self.size - 1)
            out[at] = np.where(self.keys[place] == hashes[at], self.rank[place], -1)
        return out


def stirling(d: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers, [c, t]."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(1, most + 1):
        t = np.arange(1, c + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(t < c, out[c - 1, 1 : c + 1] + np.log(np.maximum(c - 1 - d * t, 1e-300)), -np.inf)
            out[c, 1 : c + 1] = np.logaddexp(out[c - 1, :c], stay)
    return out


def tables(rng: np.random.Generator, c: np.ndarray, a: np.ndarray, d: float, log_s: np.ndarray) -> np.ndarray:
    """Sampled numbers of tables for c customers each, a: the weight of a new table."""
    t = np.minimum(c, 1).astype(np.float64)
    log_a = np.log(a)
    sat = np.minimum(c, EXACT).astype(np.int64)
    order = np.argsort(sat, kind="stable")
    bounds = np.searchsorted(sat[order], np.arange(2, EXACT + 2))
    for n in range(2, EXACT + 1):
        for at in range(bounds[n - 2], bounds[n - 1], 200_000):
            part = order[at : min(at + 200_000, bounds[n - 1])]
            logits = log_s[n, 1 : n + 1] + np.arange(1, n + 1) * log_a[part, None]
            logits -= logits.max(axis=1, keepdims=True)
            total = np.exp(logits).cumsum(axis=1)
            t[part] = 1 + (total < (rng.random(len(part)) * total[:, -1])[:, None]).sum(axis=1)
    many = np.flatnonzero(c > EXACT)
    seated = np.full(len(many), float(EXACT))
    while len(many):
        step = np.minimum(np.maximum(1, seated // 8), c[many] - seated)
        odds = a[many] / (a[many] + np.maximum(seated - d * t[many], 1e-9))
        t[many] = np.minimum(t[many] + rng.binomial(step.astype(np.int64), odds), c[many])
        seated += step
        on = seated < c[many]
        many, seated = many[on], seated[on]
    return t


class Seating:
    """The customers of some words in all restaurants: pairs (word, context), context 0 the parent itself."""

    def __init__(self, word: np.ndarray, context: np.ndarray, count: np.ndarray, n_words: int, contexts: int, seed: int, discounts: tuple[float, float], uniform: float):
        self.word, self.context, self.c = word, context, count.astype(np.float64)
        self.n, self.contexts, self.uniform = n_words, contexts, uniform
        self.d1, self.d2 = discounts
        self.rng = np.random.default_rng(seed)
        self.sent = context > 0
        self.t = np.minimum(self.c, 1.0)
        self.direct = np.bincount(word[~self.sent], weights=self.c[~self.sent], minlength=n_words)
        self.log1, self.log2 = stirling(self.d1), stirling(self.d2)
        self._up()
        self.t1 = np.minimum(self.c1, 1.0)

    def _up(self):
        self.c1 = self.direct + np.bincount(self.word[self.sent], weights=self.t[self.sent], minlength=self.n)

    def totals(self) -> np.ndarray:
        """[customers, tables] of the parent (row 0) and of each context."""
        out = np.zeros((self.contexts + 1, 2))
        out[:, 0] = np.bincount(self.context[self.sent], weights=self.c[self.sent], minlength=self.contexts + 1)
        out[:, 1] = np.bincount(self.context[self.sent], weights=self.t[self.sent], minlength=self.contexts + 1)
        out[0] = self.c1.sum(), self.t1.sum()
        return out

    def parent(self, totals: np.ndarray) -> np.ndarray:
        """The parent's probability of each word, and of one never seen at the end."""
        c1, t1 = np.append(self.c1, 0.0), np.append(self.t1, 0.0)
        return (c1 - self.d1 * t1 + (STRENGTH + self.d1 * totals[0, 1]) * self.uniform) / (STRENGTH + totals[0, 0])

    def sweep(self, totals: np.ndarray) -> None:
        p = self.parent(totals)
        k = self.context[self.sent]
        self.t[self.sent] = tables(self.rng, self.c[self.sent], (STRENGTH + self.d2 * totals[k, 1]) * p[self.word[self.sent]], self.d2, self.log2)
        self._up()
        self.t1 = tables(self.rng, self.c1, np.full(self.n, (STRENGTH + self.d1 * totals[0, 1]) * self.uniform), self.d1, self.log1)

    def averaged(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Averaged over samples: what a seated pair's own customers add, and the parent's probabilities (never seen last)."""
        own, base = np.zeros(len(self.c)), np.zeros(self.n + 1)
        for i in range(BURN_IN + SAMPLES):
            self.sweep(totals)
            if i >= BURN_IN:
                own += np.where(self.sent, (self.c - self.d2 * self.t) / (STRENGTH + totals[self.context, 0]), 0.0)
                base += self.parent(totals)
        return own / SAMPLES, base / SAMPLES


def parent_share(totals: np.ndarray, d2: float) -> np.ndarray:
    """What each context leaves to the parent; 1 for context 0."""
    out = (STRENGTH + d2 * totals[:, 1]) / (STRENGTH + totals[:, 0])
    out[0] = 1.0
    return out


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash; it grows with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _placed(df: DataFrame) -> DataFrame:
    """A checkpoint that still knows by what its rows are partitioned; one made under adaptive execution does not."""
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return cut(df)
    finally:
        conf.set(name, before)


def _ascending(steps: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(steps, dtype=np.uint64)


class Followers:
    """A bucket of rarer contexts: where the frequent words follow them, and how those are seated."""

    def __init__(self, number: int, blocks: list[tuple[int, bytes]], size: int, seed: int, d2: float):
        self.chunks, loads = [c for c, _ in blocks], [_load(raw) for _, raw in blocks]
        contexts = [np.repeat(_ascending(x[0]), x[1]) for x in loads]
        self.lengths, self.size, self.d2 = [len(x) for x in contexts], size, d2
        self.names, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *contexts]), return_inverse=True)
        self.rank = np.concatenate([np.zeros(0, np.int64), *(x[2].astype(np.int64) for x in loads)])
        self.owner = [x[3].astype(np.int64) for x in loads]
        learn = np.concatenate([np.zeros(0, bool), *(np.unpackbits(x[4])[x[3]] == 0 for x in loads)])
        self.token = at * size + self.rank
        self.key, c = np.unique(self.token[learn], return_counts=True)
        self.context, self.word = self.key // max(size, 1), self.key % max(size, 1)
        self.c, self.t = c.astype(np.float64), np.ones(len(c))
        self.rng, self.log = np.random.default_rng(seed + 1 + number), stirling(d2)

    def totals(self) -> np.ndarray:
        """[customers, tables] that the frequent words have in each restaurant."""
        return np.stack([np.bincount(self.context, weights=x, minlength=len(self.names)) for x in (self.c, self.t)], axis=1)

    def sweep(self, tables_of: np.ndarray, parent: np.ndarray) -> None:
        self.t = tables(self.rng, self.c, (STRENGTH + self.d2 * tables_of[self.context]) * parent[self.word], self.d2, self.log)

    def probabilities(self, totals: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """The averaged probability of each token, given the restaurants' totals."""
        own = np.zeros(len(self.c))
        for i in range(BURN_IN + SAMPLES):
            self.sweep(totals[:, 1], parent)
            if i >= BURN_IN:
                own += (self.c - self.d2 * self.t) / (STRENGTH + totals[self.context, 0])
        share = (STRENGTH + self.d2 * totals[:, 1]) / (STRENGTH + totals[:, 0])
        prob = share[self.token // max(self.size, 1)] * parent[self.rank]
        return prob + _found(self.key, own / SAMPLES, self.token)


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted keys, 0 for others."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def _by_text(owners: list[np.ndarray], lengths: list[int], log: np.ndarray, plain: np.ndarray, known: np.ndarray):
    """For each block its texts, and sums over their tokens: known ones, and both logarithms in whole parts of UNIT."""
    first = 0
    for owner, n in zip(owners, lengths, strict=True):
        part = slice(first, first + n)
        first += n
        texts = np.flatnonzero(np.bincount(owner))
        logs = (np.rint(-np.bincount(owner, weights=x[part])[texts] / UNIT).astype(np.uint64) for x in (log, plain))
        yield _dump(texts.astype(np.uint16), np.bincount(owner, weights=known[part])[texts].astype(np.uint32), *logs)


def _pairs(word: np.ndarray, context: np.ndarray, count: np.ndarray | None, contexts: int) -> tuple[np.ndarray, ...]:
    key = word * (contexts + 1) + context
    if count is None:
        key, count = np.unique(key, return_counts=True)
    return key // (contexts + 1), key % (contexts + 1), count, key


def score(docs: DataFrame, held: str, contexts: int = CONTEXTS, id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row; ``held``: the boolean column of rows not learned from."""
    lean(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    rows = docs.select(docs[id_col].alias("doc_id"), docs[held].alias("held"), docs[text_col].alias("text"))

    def count(batches):
        waiting, size = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

        for batch in batches:
            for _, texts in chunks(batch):
                waiting.append(_tokens(texts)[0])
                size += len(waiting[-1])
                if size > 3 * BLOCK:
                    yield flush()
                    waiting, size = [], 0
        if waiting:
            yield flush()

    counts = cut(rows.where(~F.col("held")).select("text").mapInArrow(tidy(count), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    n, v, one, two = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    top = counts.orderBy(F.desc("n"), "h").limit(contexts).collect()  # CONTEXTS rows
    ranks, often = Ranks([r["h"] & (1 << 64) - 1 for r in top]), np.array([r["n"] for r in top], dtype=np.float64)
    size = ranks.size
    buckets = max(6, -(-n // BUCKET))
    d1 = min(0.95, max(0.1, one / (one + 2 * two))) if one + two else 0.5
    discounts, uniform, floor = (d1, 0.8), 1 / (v + 1), math.log10(n + 0.1 * (v + 1))

    def spread(batches):
        """A row of ids and frequent pairs for each block of texts, a row of rarer words for each of its buckets, and one of rarer
        contexts of frequent words for each bucket of contexts (numbered on from ``buckets``)."""
        number, task = 0, TaskContext.get().partitionId()
        ids, helds, hashes, befores, owners, tokens = [], [], [], [], [], 0

        def flush():
            nonlocal number
            h, b, owner = np.concatenate(hashes), np.concatenate(befores), np.concatenate(owners)
            flags = np.concatenate(helds).astype(np.uint8)
            context, rank = (ranks.of(b) + 1).astype(np.uint16), ranks.of(h)
            b = b & NAME
            per_text = np.bincount(owner, minlength=len(flags)).astype(np.uint32)
            usual, tail, owner = rank >= 0, context == 0, owner.astype(np.uint16)
            near, far = usual & ~tail, usual & tail
            places = np.bincount(owner[near], minlength=len(flags)).astype(np.uint32)
            chunk = task << 24 | number
            number += 1
            all_ids, packed_flags = pa.concat_arrays(ids), np.packbits(flags)
            found = [(-1, chunk, _dump(flags, per_text, places, context[near], rank[near].astype(np.uint16)))]

            def parts(bucket):
                edges = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
                return [(i, a, z) for i, (a, z) in enumerate(zip(edges, edges[1:], strict=False)) if z > a]

            order = np.flatnonzero(far)
            order = order[np.lexsort((owner[order], rank[order], b[order]))]
            u, o, r = b[order], owner[order], rank[order].astype(np.uint16)
            for i, a, z in parts(_bucket(u, buckets)):
                name, times = np.unique(u[a:z], return_counts=True)
                found.append((buckets + i, chunk, _dump(np.diff(name, prepend=np.uint64(0)), times.astype(np.uint32), r[a:z], o[a:z], packed_flags)))
            order = np.flatnonzero(~usual)
            order = order[np.lexsort((owner[order], b[order], context[order], h[order]))]
            h, u, o, k = h[order], b[order], owner[order], context[order]
            for i, a, z in parts(_bucket(h, buckets)):
                word, times = np.unique(h[a:z], return_counts=True)
                name, at = np.unique(u[a:z][k[a:z] == 0], return_inverse=True)
                found.append((i, chunk, _dump(np.diff(word, prepend=np.uint64(0)), times.astype(np.uint32), k[a:z], o[a:z], packed_flags, np.diff(name, prepend=np.uint64(0)), at.astype(np.uint32))))
            lists = pa.ListArray.from_arrays(pa.array([0] + [len(all_ids)] * len(found), pa.int32()), all_ids)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), lists, pa.array([x[2] for x in found], pa.binary())], names=["bucket", "chunk", "ids", "load"])

        for batch in batches:
            for part, texts in chunks(batch):
                h, b, owner = _tokens(texts)
                if tokens and (tokens + len(h) > BLOCK or sum(map(len, ids)) + len(texts) > 60_000):
                    yield flush()
                    ids, helds, hashes, befores, owners, tokens = [], [], [], [], [], 0
                owners.append(owner + sum(map(len, ids)))
                ids.append(part.column(0))
                helds.append(np.asarray(part.column(1).fill_null(False), dtype=bool))
                hashes.append(h)
                befores.append(b)
                tokens += len(h)
        if tokens:
            yield flush()

    packed = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("load", T.BinaryType())])
    dealt = rows.mapInArrow(tidy(spread), packed).withColumn("at", F.when(F.col("bucket") < 0, F.xxhash64("chunk")).otherwise(F.col("bucket")))
    dealt = _placed(dealt.repartition(2 * buckets, "at").sortWithinPartitions("bucket", "chunk"))

    def by_bucket(batches):
        """(number, blocks) of each bucket; rows: bucket, part, load."""
        number, blocks = None, []
        for batch in batches:
            for b, c, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if b != number and blocks:
                    yield number, blocks
                    blocks = []
                number = b
                blocks.append((c, raw.as_py()))
        if blocks:
            yield number, blocks

    def usual_counts(batches):
        """Counts of (context, frequent word) in the training texts of a task; for context 0, how many rarer contexts the word has."""
        total = np.zeros((size + 1) * size, np.int64)
        for b, blocks in by_bucket(batches):
            if b >= 0:
                total[:size] += np.bincount(Followers(b, blocks, size, seed, discounts[1]).word, minlength=size)
                continue
            for _, raw in blocks:
                flags, _, places, context, rank = _load(raw)
                learn = np.repeat(flags == 0, places)
                total += np.bincount(context[learn].astype(np.int64) * size + rank[learn], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    blocks = dealt.select("bucket", F.col("chunk").alias("part"), "load")
    placed = dealt.select("at", "bucket", F.col("chunk").alias("part"), "load")
    if size:
        found = blocks.where((F.col("bucket") < 0) | (F.col("bucket") >= buckets)).mapInArrow(tidy(usual_counts), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # (CONTEXTS + 1) CONTEXTS rows at most
        pair, times = (found.column(x).to_numpy() for x in ("pair", "n"))
    else:
        pair = times = np.zeros(0, np.int64)
    order = np.argsort(pair)
    pair, times = pair[order], times[order]
    usual = Seating(pair % max(size, 1), pair // max(size, 1), times, size, size, seed, discounts, uniform)

    class Bucket:
        """The blocks of one bucket: its words, its pairs and their seating. Rarer contexts are numbered on from the frequent ones."""

        def __init__(self, number: int, blocks: list[tuple[int, bytes]]):
            self.chunks, loads = [c for c, _ in blocks], [_load(raw) for _, raw in blocks]
            words = [np.repeat(_ascending(x[0]), x[1]) for x in loads]
            self.lengths = [len(x) for x in words]
            self.context = np.concatenate([x[2] for x in loads]).astype(np.int64)
            self.owner = [x[3].astype(np.int64) for x in loads]
            learn = np.concatenate([np.unpackbits(x[4])[x[3]] == 0 for x in loads])
            self.tails, place = np.unique(np.concatenate([_ascending(x[5]) for x in loads]), return_inverse=True)
            first = np.cumsum([0] + [len(x[5]) for x in loads])
            self.context[self.context == 0] = size + 1 + place[np.concatenate([x[6].astype(np.int64) + f for x, f in zip(loads, first, strict=False)])]
            names, self.word = np.unique(np.concatenate(words), return_inverse=True)
            del words, loads, place
            self.contexts = size + len(self.tails)
            word, context, times, self.key = _pairs(self.word[learn], self.context[learn], None, self.contexts)
            self.known = np.bincount(self.word[learn], minlength=len(names))
            self.seating = Seating(word, context, times, len(names), self.contexts, seed + 1 + number, discounts, uniform)

    start = usual.totals()
    note = "bucket long, part long, load binary"

    def notes_of(rows_):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows_], pa.int64()), pa.array([x[1] for x in rows_], pa.int64()), pa.array([x[2] for x in rows_], pa.binary())], names=["bucket", "part", "load"])

    def gather(batches):
        """Seats the rarer words; notes to the buckets of the rarer contexts, and the frequent contexts' totals (bucket -1)."""
        for number, own in by_bucket(batches):
            b = Bucket(number, own)
            for _ in range(SWEEPS):
                guess = buckets * b.seating.totals()  # a bucket is a fair sample of the rarer words
                guess[: size + 1] += start
                b.seating.sweep(guess)
            total = b.seating.totals()
            out = [(-1, number, total[: size + 1].astype("<f8").tobytes())]
            edges = np.searchsorted(_bucket(b.tails, buckets), np.arange(buckets + 1)).tolist()
            for i, (a, z) in enumerate(zip(edges, edges[1:], strict=False)):
                if z > a:
                    c, t = total[size + 1 + a : size + 1 + z].T
                    out.append((buckets + i, number, _dump(np.diff(b.tails[a:z], prepend=np.uint64(0)), c.astype(np.uint32), t.astype(np.uint32))))
            yield notes_of(out)

    def summed(notes, width):
        """The sum of the numbers that notes to the driver hold."""

        def add(batches):
            total = np.zeros(width)
            for batch in batches:
                for raw in batch.column(0).to_pylist():
                    total += np.frombuffer(raw, "<f8")
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["k", "x"])

        out = np.zeros(width)
        for r in notes.where("bucket = -1").select("load").mapInArrow(tidy(add), "k long, x double").groupBy("k").agg(F.sum("x").alias("x")).collect():  # 2 CONTEXTS + 2 rows
            out[r["k"]] = r["x"]
        return out

    def told(own, notes, run, schema):
        """``run`` over number, blocks and notes of each bucket. Blocks stay in the partitions that the checkpoint keeps; only notes move."""
        notes = notes.where("bucket >= 0").select(F.col("bucket").alias("at"), "part", "load").repartition(2 * buckets, "at")

        def together(key, left, right):
            rows_ = [sorted(zip(x.column("part").to_pylist(), x.column("load").to_pylist(), strict=True)) for x in (left, right)]
            return pa.Table.from_batches(tidy(lambda sides_: run(key[0].as_py(), *sides_))(rows_))

        return own.groupBy("at").cogroup(notes.groupBy("at")).applyInArrow(together, schema)

    sent = cut(blocks.where(F.col("bucket").between(0, buckets - 1)).mapInArrow(tidy(gather), note))
    rarer = summed(sent, 2 * (size + 1)).reshape(size + 1, 2)
    for _ in range(SWEEPS):
        usual.sweep(rarer + usual.totals())
    guess = usual.parent(rarer + usual.totals())[:size]

    def seat(number, own, notes):
        """Seats the frequent words in the rarer contexts; the contexts' totals to all who have them, and each word's tables (bucket -1)."""
        b, told_ = Followers(number, own, size, seed, discounts[1]), [(i, _load(raw)) for i, raw in notes]
        told_ = [(i, _ascending(x[0]), x[1], x[2]) for i, x in told_]
        names, at = np.unique(np.concatenate([b.names, *(x[1] for x in told_)]), return_inverse=True)
        at = np.split(at, np.cumsum([len(b.names)] + [len(x[1]) for x in told_])[:-1])
        others = np.zeros((len(names), 2))
        for place, (_, _, c, t) in zip(at[1:], told_, strict=True):
            others[place, 0] += c
            others[place, 1] += t
        for _ in range(SWEEPS):
            b.sweep(others[at[0], 1] + b.totals()[:, 1], guess)
        others[at[0]] += b.totals()
        total = others.astype(np.uint64)
        out = [(-1, number, np.bincount(b.word, weights=b.t, minlength=size).astype("<f8").tobytes())]
        for i, place in zip([number, *(x[0] for x in told_)], at, strict=True):
            if len(place):
                out.append((i, number, _dump(total[place, 0], total[place, 1])))
        yield notes_of(out)

    replies = cut(told(placed.where(F.col("bucket") >= buckets), sent, seat, note))
    usual.direct = summed(replies, size)
    for _ in range(SWEEPS):
        usual.sweep(rarer + usual.totals())
    totals = rarer + usual.totals()
    share = parent_share(totals, discounts[1])
    own, base = usual.averaged(totals)
    base = base[:size]
    matrix = share[:, None] * base[None, :]
    matrix[0] = base
    np.add.at(matrix, (usual.context, usual.word), own)
    with np.errstate(divide="ignore"):
        usual_log = docs.sparkSession.sparkContext.broadcast(np.log10(matrix))  # (CONTEXTS + 1) CONTEXTS numbers
    usual_plain = np.log10(often + 0.1) - floor

    def judge(number, own, notes):
        """For each block of a bucket: known words, base and model score of each text."""
        tail = np.concatenate([np.zeros((0, 2)), *(np.stack(_load(raw), axis=1).astype(np.float64) for _, raw in notes)])
        if number >= buckets:
            b = Followers(number, own, size, seed, discounts[1])
            log, plain, known = np.log10(b.probabilities(tail, base)), usual_plain[b.rank], np.ones(len(b.rank))
        else:
            b = Bucket(number, own)
            every = np.concatenate([totals, tail])
            own_, parent = b.seating.averaged(every)
            prob = parent_share(every, discounts[1])[b.context] * parent[:-1][b.word] + _found(b.key, own_, b.word * (b.contexts + 1) + b.context)
            log, plain, known = np.log10(prob), np.log10(b.known[b.word] + 0.1) - floor, b.known[b.word] > 0
        yield pa.RecordBatch.from_arrays([pa.array(b.chunks, pa.int64()), pa.array(_by_text(b.owner, b.lengths, log, plain, known), pa.binary())], names=["chunk", "load"])

    sums = told(placed.where("bucket >= 0"), replies, judge, "chunk long, load binary").select("chunk", F.lit(1).alias("part"), F.lit(None).cast(T.ArrayType(kind)).alias("ids"), "load")
    heads = dealt.where("bucket < 0").select("chunk", F.lit(0).alias("part"), "ids", "load")
    out = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def finish(batches):
        head = None

        def done():
            ids, flags, per_text, known, plain, log = head
            return pa.RecordBatch.from_arrays([ids, pa.array(flags.astype(bool)), pa.array(per_text.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(np.full(len(flags), n, np.int64)), pa.array(plain), pa.array(log)], names=out.names)

        for batch in batches:
            for part, ids, raw in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                if part == 0:
                    if head:
                        yield done()
                    flags, per_text, places, context, rank = _load(raw)
                    owner = np.repeat(np.arange(len(flags)), places)
                    context, rank = context.astype(np.int64), rank.astype(np.int64)
                    head = (ids.values, flags, per_text, places.astype(np.float64), *(np.bincount(owner, weights=x, minlength=len(flags)).astype(np.float64) for x in (usual_plain[rank], usual_log.value[context, rank])))
                else:
                    texts, known, log, plain = _load(raw)
                    for total, more in zip(head[3:], (known, plain * -UNIT, log * -UNIT), strict=True):
                        total[texts] += more
        if head:
            yield done()

    return heads.unionByName(sums).repartition("chunk").sortWithinPartitions("chunk", "part").mapInArrow(tidy(finish), out)
