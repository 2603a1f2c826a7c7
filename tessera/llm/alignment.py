"""Cross-tokenizer alignment with byte-owner arrays.

Both tokenizers cut the same bytes, a space and the text. For a chunk of documents the token that owns each byte is written down for
either tokenizer (``np.repeat`` of token places over their lengths). Where consecutive bytes have another pair of owners a new
overlap begins: these are the links. Where both owners change at once both tokenizers have a boundary: these cuts separate the groups.

How often a pair of ids is linked is counted over all documents. Each task packs its links into blocks of about LINKS: the distinct
pairs with their counts, the most frequent first, and for each link its pair's place in that list. Spark adds the pairs of all
blocks up, finds the highest count of each id of B, and sends every block the counts of its own list; a pair occurs once in a block, so
no pair is hot, and a hot id of B has no more rows than there are ids of A. Blocks then sum up their documents.

Defined cases: null and empty texts have no tokens, zeros and ''; so have texts of which a tokenizer does not give back the bytes (for
example those that hold U+2581, which the second one reads as a space); special tokens' strings inside texts are plain text; ids may be
null or repeated, each row stands for itself; a text of any length is one block's at most, whole; an empty table gives no rows;
other columns are ignored."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, lean, tidy, written
from .packing import encoder
from .shingle_join import bundle, unbundle

#: Links of a block, about, and its documents at most.
LINKS, DOCS = 4_000_000, 50_000
_ALIGNERS: dict = {}


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligned:
    """Some texts cut by both tokenizers; arrays over all tokens, links and groups, and ``doc_*``: which text each belongs to."""

    def __init__(self, ids: list[tuple[list[int], list[int]] | None], size_a: np.ndarray, size_b: np.ndarray):
        self.n = len(ids)
        self.a, self.doc_a = self._flat([x and x[0] for x in ids])
        self.b, self.doc_b = self._flat([x and x[1] for x in ids])
        long_a, long_b = size_a[self.a], size_b[self.b]
        own_a, own_b = np.repeat(np.arange(len(self.a)), long_a), np.repeat(np.arange(len(self.b)), long_b)
        new_a, new_b = (np.diff(x, prepend=-1) != 0 for x in (own_a, own_b))
        start = np.flatnonzero(new_a | new_b)
        self.link_a, self.link_b = self.a[own_a[start]], self.b[own_b[start]]
        self.doc_link = self.doc_a[own_a[start]]
        both = new_a & new_b
        self.cut = np.flatnonzero(both)
        self.doc_group = self.doc_a[own_a[self.cut]]
        group = np.cumsum(both) - 1
        self.group_a, self.group_b = group[np.cumsum(long_a) - long_a], group[np.cumsum(long_b) - long_b]

    @staticmethod
    def _flat(ids: list[list[int] | None]) -> tuple[np.ndarray, np.ndarray]:
        count = [len(x or ()) for x in ids]
        flat = np.fromiter((i for x in ids for i in x or ()), np.int64, sum(count))
        return flat, np.repeat(np.arange(len(ids)), count)

    def per_doc(self, of: np.ndarray) -> np.ndarray:
        return np.bincount(of, minlength=self.n)


class Aligner:
    """Two tokenizers' files, loaded once in a worker."""

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None, pieces: str):
        import json

        import sentencepiece

        self.encode_a = encoder(vocabulary, ranks, pattern, literal=True)
        own = byte_level()
        model = json.load(open(vocabulary, encoding="utf-8"))
        entries = model["model"]["vocab"] | {t["content"]: t["id"] for t in model["added_tokens"]}
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for piece, i in entries.items():
            self.bytes_a[i] = bytes(own[c] for c in piece)
        self.model_b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.model_b.is_byte(i) else p.replace("▁", " ").encode() for i in range(self.model_b.get_piece_size()) for p in [self.model_b.id_to_piece(i)]]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # every id as it is written: inside its list, and at the list's end
        self.written = [f"{i}{end}" for ends, t in ((",|", self.bytes_a), (",;", self.bytes_b)) for i in range(len(t)) for end in ends]

    @classmethod
    def load(cls, *files) -> Aligner:
        if files not in _ALIGNERS:
            _ALIGNERS[files] = cls(*files)
        return _ALIGNERS[files]

    def ids(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both, or None where the bytes are not those of a space and the text."""
        a, b, raw = self.encode_a(" " + text), self.model_b.encode(text), (" " + text).encode()
        fine = b"".join([self.bytes_a[i] for i in a]) == raw and b"".join([self.bytes_b[i] for i in b]) == raw
        return (a, b) if fine else None

    def align(self, texts: list[bytes | None]) -> Aligned:
        return Aligned([self.ids(t.decode()) if t else None for t in texts], self.size_a, self.size_b)

    def groups(self, x: Aligned) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        key = np.concatenate([2 * x.group_a, 2 * x.group_b + 1])
        order = np.argsort(key, kind="stable")
        last = np.diff(key[order], append=-1) != 0
        entry = (np.concatenate([x.a, x.b + len(self.bytes_a)])[order] * 2 + last).tolist()
        edges = np.concatenate([[0], np.cumsum(x.per_doc(x.doc_a) + x.per_doc(x.doc_b))]).tolist()
        return ["".join([self.written[i] for i in entry[p:q]])[:-1] for p, q in zip(edges, edges[1:], strict=False)]


def groups(docs: DataFrame, vocabulary: str, pieces: str, ranks: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, groups (``a1,a2|b1;a3|b2,b3``), cuts (the byte of a space and the text where each group begins)."""
    lean(docs.sparkSession)
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, groups string, cuts array<long>"

    def run(batches):
        both = Aligner.load(vocabulary, ranks, pattern, pieces)
        for batch in batches:
            for part, texts in chunks(batch):
                x = both.align(texts)
                size = np.bincount(x.doc_a, weights=both.size_a[x.a], minlength=x.n).astype(np.int64)
                inside = x.cut - (np.cumsum(size) - size)[x.doc_group]
                edges = np.cumsum(x.per_doc(x.doc_group))[:-1]
                cuts = [c.tolist() for c in np.split(inside, edges)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(both.groups(x), pa.string()), pa.array(cuts, pa.list_(pa.int64()))], names=["doc_id", "groups", "cuts"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(run), schema)


def align(docs: DataFrame, vocabulary: str, pieces: str, ranks: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row."""
    lean(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = f"block string, ids array<{kind}>, groups_sha256 array<string>, pairs array<long>, counts array<long>, heads binary, links binary"
    names = [x.split()[0] for x in blocks.split(", ")]

    def pack(batches):
        both = Aligner.load(vocabulary, ranks, pattern, pieces)
        width, ids, digests, heads, links, held = len(both.bytes_b), [], [], [], [], 0

        def flush():
            pairs, at, count = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            by = np.argsort(-count, kind="stable")
            place = np.empty(len(by), np.int64)
            place[by] = np.arange(len(by))
            row = [uuid.uuid4().hex, pa.concat_arrays(ids), digests, pairs[by], count[by], bundle(*(np.concatenate(x).astype("<i8") for x in zip(*heads, strict=True))), bundle(place[at].astype("<u4"))]
            texts = pa.ListArray.from_arrays(pa.array([0, len(row[1])], pa.int32()), row[1])
            types = (pa.string(), None, pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([texts if t is None else pa.array([x], t) for x, t in zip(row, types, strict=True)], names=names)

        for batch in batches:
            for part, texts in chunks(batch):
                x = both.align(texts)
                ids.append(part.column(0))
                digests += [g and hashlib.sha256(g.encode()).hexdigest() for g in both.groups(x)]
                heads.append([x.per_doc(d) for d in (x.doc_a, x.doc_b, x.doc_group, x.doc_link)])
                links.append(x.link_a * width + x.link_b)
                held += len(links[-1])
                if held >= LINKS or len(digests) >= DOCS:
                    yield flush()
                    ids, digests, heads, links, held = [], [], [], [], 0
        if ids:
            yield flush()

    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    packed = written(texts.mapInArrow(tidy(pack), blocks))
    entries = packed.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "x")).select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    totals = entries.groupBy("pair").agg(F.sum("n").alias("count"))
    b = F.pmod("pair", F.lit(_width(pieces)))
    known = written(totals.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy(b))))
    answers = entries.select("block", "place", "pair").join(known, "pair").groupBy("block").agg(F.collect_list(F.struct("place", "count", "best")).alias("known"))
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def total(batches):
        for batch in batches:
            for i in range(len(batch)):
                ids, digests, found = (batch.column(j)[i].values for j in (0, 1, 4))
                heads, links = batch.column(2)[i].as_py(), unbundle(batch.column(3)[i].as_py(), "<u4")[0]
                n_a, n_b, n_groups, n_links = unbundle(heads, "<i8", "<i8", "<i8", "<i8")
                place, count, best = (np.asarray(found.field(j).to_numpy(zero_copy_only=False)) for j in range(3)) if found is not None else [np.zeros(0, np.int64)] * 3
                counts, bests = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                counts[place], bests[place] = count, best
                sums = []
                for x in (bests, counts):
                    upto = np.concatenate([[0], np.cumsum(x[links])])
                    ends = np.cumsum(n_links)
                    sums.append(upto[ends] - upto[ends - n_links])
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (n_a, n_b, n_groups, n_links, *sums)), digests], names=[x.split()[0] for x in out.split(", ")])

    done = packed.select("block", "ids", "groups_sha256", "heads", "links").join(answers, "block", "left").drop("block")
    return done.mapInArrow(tidy(total), out)


def _width(pieces: str) -> int:
    """Ids of the second tokenizer."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
