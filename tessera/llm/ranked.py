"""Ranked lexical search: WAND over shards of documents.

Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. The documents are read once: wherever they
lie, shards of at most SHARD documents and POSTINGS postings become an inverted index of the terms that the queries ask for, and
nothing else of them is kept. From these come the counts over all documents: N documents with a term, L terms, a term's df.

Then each shard answers each query by WAND. A term's maximum impact in the shard bounds what it can add. Documents are visited in
blocks, the first ones short so that the heap fills; in a block the terms are ordered by their maximum impact, and the pivot is the
first at which the running sum reaches the heap's threshold: a document with none of the terms from the pivot on cannot enter, so the
lists before the pivot are only looked up for the documents of those from the pivot on, dearest list first, and a document is
left as soon as what it has and the maxima of the lists to come stay below the threshold. The heaps of all shards are merged by a
window with a group limit, so at most k rows of a query leave a task.

Queries are taken in blocks of about QUERY_BYTES of text, drawn by hash, so neither the driver nor an executor ever holds more of
them; each block reads the documents once. Terms are compared by 64-bit hashes. All scores are whole numbers.

Defined cases: null, empty and sign-only texts have no terms and match nothing; a query without terms gives no rows; documents
and queries are told apart as rows, so ids may be null or repeated (a null doc_id comes after all others among equal scores,
then rows in any order); a query that holds a term twice counts it twice; empty tables give no rows; other columns are ignored."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, chunks, lean, tidy, written
from .shingle_join import bundle, unbundle

#: Documents, and postings about, of a shard.
SHARD, POSTINGS = 8192, 4_000_000
#: Documents of a shard's first block; each block has twice as many, up to the last number.
FIRST, MOST = 256, 4096
#: Bytes of query text that are answered in one pass over the documents, about.
QUERY_BYTES = 4 << 20


def weight(n_docs: int, df: int) -> int:
    """floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """25 + (75 n N) div L of each document."""
    if len(n) and 75 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([25 + 75 * x * n_docs // n_terms for x in n.tolist()], np.int64)
    return 25 + 75 * n * n_docs // n_terms


class Shard:
    """Postings of some documents: for term t the documents ``doc[first[t]:first[t + 1]]``, ascending, and each one's impact."""

    def __init__(self, first: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int):
        self.first, self.doc, self.impact, self.docs = first, doc, impact, docs
        self.highest = np.zeros(len(first) - 1, np.int64)
        some = np.flatnonzero(np.diff(first))
        if len(some):
            self.highest[some] = np.maximum.reduceat(impact, first[some])
        self.looked = 0  # documents whose lists were looked up, for the tests

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that hold the k best of the shard, all that tie with the k-th included; scores above 0 only."""
        most = self.highest[terms] * weights
        order = np.argsort(most, kind="stable")
        order = order[most[order] > 0]
        terms, weights, most = terms[order], weights[order], most[order]
        sums = np.cumsum(most)  # what the lists up to each one can add
        lists = [self.doc[self.first[t] : self.first[t + 1]] for t in terms.tolist()]
        gains = [self.impact[self.first[t] : self.first[t + 1]] for t in terms.tolist()]
        docs, scores, least, begin, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 1, 0, FIRST
        while begin < self.docs and len(terms):
            end = min(begin + step, self.docs)
            pivot = int(np.searchsorted(sums, least))  # before it, no document can reach the threshold
            if pivot == len(terms):
                break
            edges = [np.searchsorted(x, (begin, end)).tolist() for x in lists]
            found = np.unique(np.concatenate([x[a:z] for x, (a, z) in zip(lists[pivot:], edges[pivot:], strict=True)]))
            self.looked += len(found)
            score = np.zeros(len(found), np.int64)
            for i in range(len(terms) - 1, -1, -1):
                if not len(found):
                    break
                a, z = edges[i]
                if z > a:
                    at = np.searchsorted(lists[i][a:z], found)
                    at[at == z - a] = 0
                    here = lists[i][a + at] == found
                    score[here] += weights[i] * gains[i][a + at[here]]
                fine = score + (sums[i - 1] if i else 0) >= least
                if not fine.all():
                    found, score = found[fine], score[fine]
            docs, scores = np.concatenate([docs, found]), np.concatenate([scores, score])
            if len(docs) > k:
                least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                docs, scores = docs[scores >= least], scores[scores >= least]
            begin, step = end, min(2 * step, MOST)
        return docs, scores


def _blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The queries as rows (id, text), about QUERY_BYTES of them at a time."""
    rows = written(queries.select(queries[id_col].alias("item_id"), queries[text_col].alias("text")).where("text is not null"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 100), F.lit(0))).first()[0]
    parts = max(1, -(-size // QUERY_BYTES))
    for i in range(parts):
        mine = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i)
        if found := mine.collect():  # about QUERY_BYTES
            yield found


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each query, equal scores by ascending doc_id."""
    lean(docs.sparkSession)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    kind = queries.schema[item_col].dataType.simpleString()
    out = None
    for items in _blocks(queries, item_col, item_text):
        part = _answer(texts, [r["text"] for r in items], k)
        ids = docs.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], f"item int, item_id {kind}")
        part = part.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")  # about QUERY_BYTES at most
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


def _answer(texts: DataFrame, items: list[str], k: int) -> DataFrame:
    """item (the place in ``items``), rank, doc_id, score."""
    spark = texts.sparkSession
    words = Words([x.encode() for x in items], "plain")
    terms, times = np.unique(words.hash), []
    for i in range(len(items)):
        times.append(np.unique(np.searchsorted(terms, words.hash[words.first[i] : words.first[i + 1]]), return_counts=True))
    asked = spark.sparkContext.broadcast((terms, times))

    def index(batches):
        terms = asked.value[0]
        ids, sizes, docs, at, tf, held = [], [], [], [], [], 0

        def flush():
            doc, term, times = (np.concatenate(x) for x in (docs, at, tf))
            order = np.argsort(term, kind="stable")
            df = np.bincount(term, minlength=len(terms))
            n = np.concatenate(sizes)
            load = bundle(doc[order].astype("<u4"), times[order].astype("<u4"), n.astype("<i8"))
            row = [f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}", ids, int(np.count_nonzero(n)), int(n.sum()), df.tolist(), load]
            types = (pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names=["shard", "ids", "docs", "terms", "df", "load"])

        for batch in batches:
            for part, raw in chunks(batch):
                words = Words(raw, "plain")
                found = np.searchsorted(terms, words.hash)
                found[found == len(terms)] = 0
                hit = terms[found] == words.hash if len(terms) else np.zeros(len(words.hash), bool)
                pairs, count = np.unique(words.text_of()[hit] * len(terms) + found[hit], return_counts=True)
                docs.append(pairs // max(1, len(terms)) + len(ids))
                at.append(pairs % max(1, len(terms)))
                tf.append(count)
                sizes.append(words.count)
                ids += part.column(0).to_pylist()
                held += len(pairs)
                if len(ids) >= SHARD or held >= POSTINGS:
                    yield flush()
                    ids, sizes, docs, at, tf, held = [], [], [], [], [], 0
        if ids:
            yield flush()

    shards = written(texts.mapInArrow(tidy(index), "shard string, ids array<long>, docs long, terms long, df array<long>, load binary"))
    n_docs, n_terms = shards.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    each = shards.select(F.posexplode("df").alias("term", "n")).where("n > 0")
    df = np.zeros(len(terms), np.int64)
    for r in each.groupBy("term").agg(F.sum("n").alias("n")).collect():  # the terms of a block of queries
        df[r["term"]] = r["n"]
    weights = np.array([weight(n_docs, x) for x in df.tolist()], np.int64)
    known = spark.sparkContext.broadcast(weights)

    def wand(batches):
        times, weights = asked.value[1], known.value
        for batch in batches:
            for shard, ids, df, load in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc, tf, n = unbundle(load, "<u4", "<u4", "<i8")
                tf = tf.astype(np.int64)
                m = lengths(n, n_docs, max(1, n_terms))
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
                index = Shard(np.concatenate([[0], np.cumsum(df)]).astype(np.int64), doc.astype(np.int64), impact, len(ids))
                rows = []
                for item, (term, many) in enumerate(times):
                    found, score = index.best(term, weights[term] * many, k)
                    if len(found):
                        best = sorted(zip((-score).tolist(), [ids[i] is None for i in found], [ids[i] or 0 for i in found], strict=True))[:k]
                        rows += [(item, None if no else i, -s, shard) for s, no, i in best]
                columns = zip(*rows, strict=True) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["item", "doc_id", "score", "shard"])

    heaps = shards.select("shard", "ids", "df", "load").mapInArrow(tidy(wand), "item int, doc_id long, score long, shard string")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "shard")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")
