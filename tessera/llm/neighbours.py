"""Approximate nearest neighbours by multiprobe p-stable hashing.

Unit vectors are hashed in TABLES tables by ``floor((a . v + b) / WIDTH)`` for several Gaussian directions a. A query visits its
own bucket and then the perturbed ones in the order of their estimated success (the sum of squared distances to the slots'
borders) up to a limit on that sum. The tables' candidates are merged and ranked exactly: cosine in double precision on the
original vectors, ties to the smaller id. The limit is fitted so that RECALL of the true neighbours of FITTED sampled queries
lie within it; those are found by one pass over all vectors. Queries that would have to visit more than MOST buckets in a table,
or that met fewer than k candidates, are ranked against all vectors, each block of queries with each block of vectors, in one job.

Equal vectors are hashed and compared once; only the k + 1 smallest ids of each can matter. The number of directions follows
the number of vectors, so that buckets keep their size as the table grows. Buckets and their queries are compared in lanes of
at most LANE rows, as matrix products; every lane of a bucket's vectors is a key of its own, so a hot bucket is spread over tasks.

Defined cases: vectors that are null, all zero, or hold null or non-finite components take no part, neither do null ids; vectors are
compared with those of their own length only; repeated ids and repeated rows are rows of their own, and a query leaves out just its own
row; components of any size are scaled by a power of two first, so that no cosine overflows; fewer than k candidates give
fewer rows; an empty table gives none; other columns are ignored."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mix, small, tidy

TABLES, WIDTH = 4, 2.5
#: Vectors in a bucket, about, if they lay evenly.
FILL = 64
#: Sampled queries that the limit is fitted on, and the share of their true neighbours that must lie within it.
FITTED, RECALL = 160, 0.96
#: Buckets that a query visits in a table at most.
MOST = 3000
#: Vectors of a bucket, or queries of a bucket, in a row; queries, and vectors, that the exact ranking takes at a time.
LANE, BLOCK = 256, 2048
SEED = 20240229


def directions_for(n: int) -> int:
    """Directions in a table: one more multiplies the populated buckets by about 2.4."""
    return int(np.clip(round(np.log(max(n, 2) / FILL) / np.log(2.4)), 3, 24))


class Tables:
    """The hash functions of all tables."""

    def __init__(self, dim: int, directions: int, tables: int = TABLES, width: float = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.dim, self.directions, self.tables, self.width = dim, directions, tables, width
        self.a = rng.standard_normal((dim, tables * directions))
        self.b = rng.uniform(0, width, tables * directions)
        self.salt = mix(np.arange(1, tables + 1, dtype=np.uint64))
        self.coef = mix(np.arange(100, 100 + directions, dtype=np.uint64)) | np.uint64(1)

    def places(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, tables, directions): places in units of the width."""
        return ((unit @ self.a + self.b) / self.width).reshape(len(unit), self.tables, self.directions)

    def keys(self, slots: np.ndarray) -> np.ndarray:
        """Bucket keys for slots (..., tables, directions)."""
        with np.errstate(over="ignore"):
            return mix((slots.astype(np.int64).view(np.uint64) * self.coef).sum(axis=-1, dtype=np.uint64) + self.salt).view(np.int64)

    def cost(self, query: np.ndarray, other: np.ndarray) -> float:
        """The least perturbation cost at which the place ``query`` visits the bucket of ``other`` in some table."""
        slot, low = np.floor(query), query - np.floor(query)
        step = np.floor(other) - slot
        each = np.where(step == 0, 0.0, np.where(step == -1, low**2, np.where(step == 1, (1 - low) ** 2, np.inf)))
        return float(each.sum(axis=1).min())

    def probes(self, place: np.ndarray, limit: float, most: int = MOST) -> np.ndarray | None:
        """Keys of the buckets within the limit, each table's likeliest first; None if a table has more than ``most``."""
        slot, out = np.floor(place), []
        for t in range(self.tables):
            low = place[t] - slot[t]
            total = np.zeros(1)
            with np.errstate(over="ignore"):
                key = (slot[t].astype(np.int64).view(np.uint64) * self.coef).sum(keepdims=True, dtype=np.uint64) + self.salt[t]
                for j in range(self.directions):
                    total = np.concatenate([total, total + low[j] ** 2, total + (1 - low[j]) ** 2])
                    key = np.concatenate([key, key - self.coef[j], key + self.coef[j]])
                    near = total <= limit
                    total, key = total[near], key[near]
                    if len(total) > most:
                        return None
            out.append(mix(key[np.argsort(total, kind="stable")]).view(np.int64))
        return np.concatenate(out)


class Best:
    """The best candidates of each query met so far, with ties at the end."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, {}, {}

    def add(self, queries: list[bytes], scores: np.ndarray, vectors: list, ids: list) -> None:
        for q, row in zip(queries, scores, strict=True):
            fresh = np.flatnonzero(row >= self.least.get(q, -2.0))
            if len(fresh):
                found = self.rows.setdefault(q, {})
                for j in fresh.tolist():
                    found[vectors[j]] = (float(row[j]), ids[j])
                if len(found) > 4 * self.k:
                    self.trim(q)

    def trim(self, q: bytes) -> None:
        found = self.rows[q]
        if len(found) >= self.k:
            least = sorted((x[0] for x in found.values()), reverse=True)[self.k - 1] - 1e-9
            self.least[q] = least
            self.rows[q] = {v: x for v, x in found.items() if x[0] >= least}

    def batch(self) -> pa.RecordBatch:
        for q in self.rows:
            self.trim(q)
        flat = [(q, v, ids) for q, found in self.rows.items() for v, (_, ids) in found.items()]
        self.rows, self.least = {}, {}
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.binary()), pa.array([x[1] for x in flat], pa.binary()), pa.array([x[2] for x in flat])] if flat else [], names=["q", "v", "ids"] if flat else [])


def _matrix(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    flat = column.cast(pa.large_binary())
    return np.frombuffer(b"".join(flat.to_pylist()), kind).reshape(-1, dim).astype(np.float64)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; scaling by powers of two changes nothing but the exponents."""
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (a, b))
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def nearest(vectors: DataFrame, is_query, k: int = 5, tables: int = TABLES, recall: float = RECALL, most: int = MOST, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score, probed: the k nearest found of every row that passes ``is_query`` (a condition on the column vec_id).
    probed: whether the buckets that the query visited gave enough, or it was ranked against all rows, block by block."""
    spark = vectors.sparkSession
    kind = "<f8" if vectors.schema[vector_col].dataType.elementType.typeName() == "double" else "<f4"
    ids = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].alias("e")).where("vec_id is not null and e is not null")
    fine = ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("e", lambda x: x != 0)
    rows = rows.where(fine)
    none = spark.createDataFrame([], f"query_id {ids}, rank int, vec_id {ids}, score double, probed boolean")
    rows = rows.withColumn("n", F.size("e"))
    lengths = [r["n"] for r in rows.groupBy("n").count().orderBy(F.desc("count"), "n").collect()]  # a row for each length of vectors
    if len(lengths) > 1:
        rows = cut(rows)
    out = [_of_length(rows.where(F.col("n") == n).select("vec_id", "e"), n, is_query, k, tables, recall, most, kind, ids) for n in lengths]
    return reduce(DataFrame.unionByName, out, none) if len(out) != 1 else out[0]


def _of_length(rows: DataFrame, dim: int, is_query, k: int, tables: int, recall: float, most: int, kind: str, ids: str) -> DataFrame:
    """The same for vectors of one length: rows of vec_id and e."""
    spark = rows.sparkSession
    none = spark.createDataFrame([], f"query_id {ids}, rank int, vec_id {ids}, score double, probed boolean")

    def pack(batches):
        for batch in batches:
            values = np.asarray(batch.column(1).flatten()).astype(kind).reshape(-1, dim) + 0.0  # no negative zero
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.astype(kind).tobytes() for v in values], pa.binary())], names=["vec_id", "v"])

    rows = rows.mapInArrow(tidy(pack), f"vec_id {ids}, v binary")
    first = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    kinds = cut(few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))  # k + 1 ids at most
    asking = cut(rows.where(is_query).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies")))
    asked = cut(asking.select(F.col("v").alias("q")).distinct().withColumn("h", F.xxhash64("q")))
    n, n_asked = kinds.count(), asked.count()
    if not n_asked:
        return none
    found_schema = f"q binary, v binary, ids array<{ids}>"

    def unit(v: np.ndarray) -> np.ndarray:
        v = v / np.abs(v).max(axis=1, keepdims=True)
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    def against_all(names: list[bytes]):
        """The best of all vectors for the given queries."""
        held = spark.sparkContext.broadcast((names, unit(_matrix(pa.array(names, pa.binary()), dim, kind))))

        def run(batches):
            best, (queries, those) = Best(k + 1), held.value
            for batch in batches:
                for at in range(0, len(batch), 2000):
                    part = batch.slice(at, 2000)
                    v = part.column(0).to_pylist()
                    best.add(queries, those @ unit(_matrix(part.column(0), dim, kind)).T, v, part.column(1).to_pylist())
            if best.rows:
                yield best.batch()

        return kinds.select("v", "ids").mapInArrow(tidy(run), found_schema)

    def scored(found: DataFrame) -> DataFrame:
        """What was found, once, with exact scores; of each query the best k + 2 and their ties."""

        def exact(batches):
            for batch in batches:
                scores = cosines(_matrix(batch.column(0), dim, kind), _matrix(batch.column(1), dim, kind)) if len(batch) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=["q", "v", "ids", "score"])

        one = found.groupBy("q", "v").agg(F.first("ids").alias("ids")).mapInArrow(tidy(exact), f"{found_schema}, score double")
        best = Window.partitionBy("q").orderBy(F.desc("score"))
        return one.withColumn("n", F.rank().over(best)).where(F.col("n") <= k + 2).drop("n")

    def settled(found: DataFrame) -> DataFrame:
        """The best k + 1 rows of each query."""
        each = scored(found).select("q", "score", (F.col("q") == F.col("v")).alias("same"), F.posexplode("ids").alias("at", "vec_id"), "ids")
        single = each.select("q", "score", "vec_id", (F.col("same") & (F.array_position("ids", F.col("vec_id")) == F.col("at") + 1)).alias("own"))  # the first row of that id with the query's vector
        place = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        return single.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k + 1).drop("n")

    # the limit, from the true neighbours of some queries
    hashes = Tables(dim, directions_for(n), tables)
    some = [bytes(r["q"]) for r in asked.orderBy("h", "q").limit(FITTED).collect()]
    true = scored(against_all(some)).where("q <> v").withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "v"))).where(F.col("n") <= k)
    true = true.select("q", "v").collect()  # FITTED k rows
    ends = [hashes.places(unit(_matrix(pa.array([bytes(r[x]) for r in true], pa.binary()), dim, kind))) for x in ("q", "v")] if true else []
    costs = [hashes.cost(a, b) for a, b in zip(*ends, strict=True)]
    limit = float(np.quantile(costs, recall, method="higher")) if costs else 0.0
    tables_ = spark.sparkContext.broadcast(hashes)

    def index(batches):
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                keys = tables_.value.keys(np.floor(tables_.value.places(unit(_matrix(part.column(0), dim, kind)))))
                again = pa.array(np.repeat(np.arange(len(part)), tables_.value.tables))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), part.column(0).take(again), part.column(1).take(again)], names=["key", "v", "ids"])

    def probe(batches):
        """(key, query) for every bucket that a query visits; no key for queries left to the exact ranking."""
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                keys = [tables_.value.probes(p, limit, most) if np.isfinite(limit) else None for p in tables_.value.places(unit(_matrix(part.column(0), dim, kind)))]
                again = pa.array(np.repeat(np.arange(len(part)), [1 if x is None else len(x) for x in keys]))
                flat = pa.concat_arrays([pa.array([None], pa.int64()) if x is None else pa.array(x) for x in keys]) if keys else pa.array([], pa.int64())
                yield pa.RecordBatch.from_arrays([flat, part.column(0).take(again)], names=["key", "q"])

    def laned(rows: DataFrame, what: str, keys: list[str]) -> DataFrame:
        """Rows of at most about LANE members of a bucket, or of a lane of one."""
        number = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / LANE).alias("lanes"))
        named = rows.join(number, keys).withColumn("own", F.pmod(F.xxhash64(what), F.col("lanes")))
        return named.groupBy(*keys, "own").agg(F.collect_list(F.struct(*(c for c in rows.columns if c not in keys))).alias(what))

    visits = cut(asked.select("q").mapInArrow(tidy(probe), "key long, q binary"))
    indexed = kinds.select("v", "ids").mapInArrow(tidy(index), f"key long, v binary, ids array<{ids}>")
    buckets = cut(laned(indexed, "v", ["key"]).withColumnRenamed("own", "lane"))
    meetings = laned(visits.where("key is not null"), "q", ["key"]).join(buckets, "key").select("q", "v")  # every lane of a bucket meets all lanes of its queries

    def compare(batches):
        best = Best(k + 1)
        for batch in batches:
            for queries, members in zip(batch.column(0), batch.column(1), strict=True):
                q, v = queries.values.field("q"), members.values
                names = q.to_pylist()
                best.add(names, unit(_matrix(q, dim, kind)) @ unit(_matrix(v.field("v"), dim, kind)).T, v.field("v").to_pylist(), v.field("ids").to_pylist())
            if len(best.rows) > 20_000:
                yield best.batch()
        if best.rows:
            yield best.batch()

    found = cut(settled(meetings.mapInArrow(tidy(compare), found_schema)).withColumn("probed", F.lit(True)))
    enough = found.groupBy("q").count().where(F.col("count") > k).select("q")
    rest = cut(asked.join(enough, "q", "left_anti"))
    blocks = -(-rest.count() // BLOCK)
    if blocks:

        def grid(batches):
            best, held = Best(k + 1), (None, None)
            for batch in batches:
                for number, queries, members in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                    if number != held[0]:
                        if best.rows:
                            yield best.batch()
                        names = queries.as_py()
                        held = (number, names, unit(_matrix(pa.array(names, pa.binary()), dim, kind)))
                    v = members.values
                    best.add(held[1], held[2] @ unit(_matrix(v.field("v"), dim, kind)).T, v.field("v").to_pylist(), v.field("ids").to_pylist())
            if best.rows:
                yield best.batch()

        asks = rest.groupBy(F.pmod("h", F.lit(blocks)).alias("block")).agg(F.collect_list("q").alias("queries"))  # BLOCK, about
        chunks_ = -(-n // BLOCK)
        against = kinds.groupBy(F.pmod(F.xxhash64("v"), F.lit(chunks_)).alias("chunk")).agg(F.collect_list(F.struct("v", "ids")).alias("members"))  # BLOCK, about
        against = against.select("members", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
        cells = against.join(asks, "block").select("block", "queries", "members")
        more = cut(settled(cells.mapInArrow(tidy(grid), found_schema)).withColumn("probed", F.lit(False)))
        found = found.join(rest.select("q"), "q", "left_anti").unionByName(more)
    mine = asking.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "copies").join(found, "q").where(~((F.col("query_id") == F.col("vec_id")) & F.col("own")))
    place = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    ranked = mine.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "probed", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")
