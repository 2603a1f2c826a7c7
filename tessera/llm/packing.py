"""Best-fit packing of token sequences by bin completion.

Texts are tokenised where they lie; only (length, rank among equal lengths) matters afterwards. The histogram of lengths
has at most ``capacity`` entries whatever the corpus, so the packing itself is solved on the driver for the histogram:
best-fit decreasing gives the first incumbent; bin completion then takes the largest length left and enumerates the fillings around
it lazily, least waste first, leaving out dominated ones (a filling beside which another piece would fit, and all others where one
piece fills the room), prunes by the waste that an improvement may still spend, and applies a filling as often as the counts
allow, on the way back also once. The search ends when the lower bound is reached, when all is enumerated, or when its STEPS are
used up: every filling, every way back and every step inside an enumeration counts, dead ends too. The best packing found
stands then; every row tells the sequences used and the lower bound, so that the gap is seen.
Each piece finds its place from its length and rank with a table of filling runs; ranks follow the order of the input's files, so of
pieces with equal lengths those that come first in the table come first in the packing.

Defined cases: a null text is empty (one token, the end mark); a null id is carried; repeated rows are packed each on their
own; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import base64
import re
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, cut, lean, small, tidy

CAPACITY = 2048
#: The id after each document.
END = 0
#: Steps that the branch and bound may take, dead ends and the steps of enumerations included; some seconds at most.
STEPS = 1_000_000
#: Tables of sums that a search holds at a time, up to 0.7 MB each; an enumeration that goes on after others makes its own again.
TABLES = 16
#: On these characters both libraries split alike; other texts go through the slower one.
_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e¡-¬®-ɏ]|<\|")
_ENCODERS: dict = {}


def encoder(vocabulary: str, ranks: str | None = None, pattern: str | None = None, literal: bool = False):
    """text -> ids of the tokenizers file ``vocabulary``, no special tokens added. ``ranks``: the same vocabulary as ranks, for plain
    texts; ``literal``: special tokens' strings inside texts are plain text."""
    key = (vocabulary, ranks, literal)
    if key not in _ENCODERS:
        fast, slow = None, []
        if ranks:
            import tiktoken

            pairs = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(ranks, "rb") if x.strip())}
            fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=pairs, special_tokens={})

        def encode(text: str) -> list[int]:
            if fast is None or _PLAIN.search(text):
                if not slow:
                    from tokenizers import Tokenizer

                    slow.append(Tokenizer.from_file(vocabulary))
                    slow[0].encode_special_tokens = literal
                return slow[0].encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        _ENCODERS[key] = encode
    return _ENCODERS[key]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all of ``capacity`` but the first, which may be shorter."""
    first = n - capacity * ((n - 1) // capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, the piece's slice of the input and rank among the slice's pieces of that length; on one
    piece of each slice where it lies in the input."""
    lean(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), *(T.StructField(x, T.LongType()) for x in ("start", "length", "ids_crc32", "slice", "rank")), T.StructField("place", T.StringType())])

    def run(batches):
        encode, task, number, current, seen = encoder(vocabulary, ranks, pattern), TaskContext.get().partitionId() << 24, 0, None, []
        for batch in batches:
            at, out = [], []
            for i, (text, place) in enumerate(zip(batch.column(1), batch.column(2).to_pylist(), strict=True)):
                if place != current:
                    current, number, seen, told = place, number + 1, [0] * (capacity + 1), place
                ids = np.array([*encode(text.as_py() or ""), END], dtype="<u4")
                for piece, (start, n) in enumerate(cuts(len(ids), capacity)):
                    at.append(i)
                    out.append((piece, start, n, zlib.crc32(ids[start : start + n].tobytes()), task | number, seen[n], told))
                    seen[n] += 1
                    told = None
            piece, *rest, places = zip(*out, strict=True) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in rest), pa.array(places, pa.string())], names=schema.names)

    block = F.lpad(F.input_file_block_start().cast("string"), 20, "0")
    place = F.concat_ws("|", F.input_file_name(), block, F.lpad(F.spark_partition_id().cast("string"), 9, "0"))
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), place.alias("place")).mapInArrow(tidy(run), schema)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing on a histogram: (times, {length: copies})."""
    by_room: dict[int, list[list]] = {}
    rooms: list[bool] = [False] * (capacity + 1)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = next((r for r in range(length, capacity) if rooms[r]), None)
            if room is None:
                k = min(capacity // length, left)
                times = left // k
                group, room = [times, {length: k}], capacity - k * length
                left -= times * k
            else:
                group = by_room[room][-1]
                times = min(group[0], left)
                left -= times
                group[0] -= times
                if not group[0]:
                    by_room[room].pop()
                    rooms[room] = bool(by_room[room])
                group, room = [times, group[1] | {length: group[1].get(length, 0) + 1}], room - length
            by_room.setdefault(room, []).append(group)
            rooms[room] = True
    return [(times, fill) for groups in by_room.values() for times, fill in groups]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: for each threshold, pieces that cannot share plus what does not fit beside them."""
    hist = np.zeros(capacity + 1, dtype=np.int64)
    for k, v in counts.items():
        hist[k] = v
    number, size = np.cumsum(hist), np.cumsum(hist * np.arange(capacity + 1))
    best = -(-int(size[-1]) // capacity)
    for a in range(0, capacity // 2 + 1):
        large = int(number[-1] - number[capacity - a])  # longer than capacity - a
        middle = int(number[capacity - a] - number[capacity // 2])
        rest = int(size[capacity // 2] - (size[a - 1] if a else 0))  # a .. capacity / 2
        free = middle * capacity - int(size[capacity - a] - size[capacity // 2])
        best = max(best, large + middle + max(0, -(-(rest - free) // capacity)))
    return best


class Steps:
    """What is left of a search's steps, and the tables that its enumerations used last."""

    def __init__(self, left: int):
        self.left = left
        self.tables: OrderedDict[object, tuple[list[int], list[int]]] = OrderedDict()

    def take(self, n: int = 1) -> bool:
        """Use n steps; whether any were left."""
        self.left -= n
        return self.left >= 0


def likely(counts: np.ndarray, room: int) -> Iterator[dict[int, int]]:
    """Some fillings without waste, found by table look-ups: the pair with the largest member, then triples."""
    have = counts[: room + 1] > 0
    sizes = np.flatnonzero(have).astype(np.int32)

    def pair(rest: int, used: dict[int, int], top: int) -> dict[int, int] | None:
        """The pair with sum ``rest`` with the largest member, no member above top."""
        a = sizes[(sizes <= min(rest - 1, top)) & (sizes >= (rest + 1) // 2)][::-1]
        for x in a[have[rest - a]].tolist():
            want: dict[int, int] = dict(used)
            for y in (x, rest - x):
                want[y] = want.get(y, 0) + 1
            if all(counts[y] >= k for y, k in want.items()):
                return want
        return None

    if found := pair(room, {}, room):
        yield found
    for x in sizes[::-1].tolist():
        if room - x >= 2 and (found := pair(room - x, {x: 1}, x)):
            yield found
            return


def fillings(counts: np.ndarray, room: int, waste: int, steps: Steps | None = None) -> Iterator[dict[int, int]]:
    """All undominated fillings of ``room`` that waste no more than ``waste``, least waste first, each once, as far as the steps go.

    One piece that fills it all dominates the rest; a filling beside which another piece would fit is dominated by that one."""
    steps = steps or Steps(STEPS)
    if room <= 0:
        yield {}
        return
    if counts[room]:
        yield {room: 1}
        return
    number = np.count_nonzero(counts[: room + 1])
    if not number:
        if room <= waste:
            yield {}
        return
    if not steps.take(number):
        return
    given = []
    for fill in likely(counts, room):
        given.append(fill)
        yield fill
    mine = object()

    def table() -> tuple[list[int], list[int]]:
        """The sizes, largest first, and for each i a bit for every sum that pieces from sizes[i] on can make."""
        if mine in steps.tables:
            steps.tables.move_to_end(mine)
            return steps.tables[mine]
        sizes = np.flatnonzero(counts[: room + 1])[::-1].tolist()
        after, full = [1] * (len(sizes) + 1), (1 << (room + 1)) - 1
        for i in range(len(sizes) - 1, -1, -1):
            reach, x, n, step = after[i + 1], sizes[i], min(int(counts[sizes[i]]), room // sizes[i]), 1
            while n > 0:
                reach |= reach << (x * min(step, n)) & full
                n, step = n - step, 2 * step
            after[i] = reach
        steps.tables[mine] = sizes, after
        if len(steps.tables) > TABLES:
            steps.tables.popitem(last=False)
        return sizes, after

    def exactly(i: int, rest: int) -> Iterator[list[tuple[int, int]]]:
        """(length, copies) of pieces from sizes[i] on with the sum ``rest``, largest first."""
        if not rest:
            yield []
            return
        while i < number and table()[1][i] >> rest & 1:
            x = table()[0][i]
            i += 1
            for n in range(min(int(counts[x]), rest // x), 0, -1):
                if not steps.take():
                    return
                if table()[1][i] >> (rest - n * x) & 1:
                    for more in exactly(i, rest - n * x):
                        yield [(x, n), *more]

    for lost in range(min(waste, room) + 1):
        small_ = [x for x in reversed(table()[0]) if x <= lost]  # all of them must be used up
        if sum(x * int(counts[x]) for x in small_) > room - lost:
            return
        if not steps.take(1 + len(small_)):
            return
        if table()[1][0] >> (room - lost) & 1:
            for found in exactly(0, room - lost):
                fill = dict(found)
                if fill not in given and all(fill.get(x, 0) == counts[x] for x in small_):
                    yield fill


def bin_completion(counts: dict[int, int], capacity: int, steps: int = STEPS) -> list[tuple[int, dict[int, int]]]:
    """Packs a histogram of lengths; (times, {length: copies}) for each filling."""
    counts = {k: v for k, v in counts.items() if v}
    best = best_fit(counts, capacity)
    bins, least = sum(t for t, _ in best), lower_bound(counts, capacity)
    total = sum(k * v for k, v in counts.items())
    start, left_over = np.zeros(capacity + 1, dtype=np.int64), Steps(steps)
    for k, v in counts.items():
        start[k] = v

    def options(left: np.ndarray, waste: int):
        """(times, filling, what is left then) around the largest piece left: as often as possible, and once for each on the way back. ``left``
        becomes its own."""
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1

        def without(whole: dict[int, int], times: int) -> np.ndarray:
            after = left.copy()
            after[top] += 1
            for k, v in whole.items():
                after[k] -= v * times
            return after

        again = []
        for fill in fillings(left, capacity - top, (bins - 1) * capacity - total - waste, left_over):
            whole = fill | {top: fill.get(top, 0) + 1}
            times = min((int(left[k]) + (k == top)) // v for k, v in whole.items())
            lost = capacity - sum(k * v for k, v in whole.items())
            if lost:
                times = max(1, min(times, ((bins - 1) * capacity - total - waste) // lost))
            yield times, whole, without(whole, times)
            if times > 1:
                again.append(whole)
        for whole in again:
            yield 1, whole, without(whole, 1)

    stack = [(0, None, options(start, 0))] if len(counts) else []
    while stack and bins > least and left_over.take(10):
        waste, done, more = stack[-1]
        times, whole, after = next(more, (0, None, None))
        if whole is None:
            stack.pop()
            continue
        spent = waste + times * (capacity - sum(k * v for k, v in whole.items()))
        if spent > (bins - 1) * capacity - total:  # no better than the incumbent
            continue
        if after.any():
            stack.append((spent, ((times, whole), done), options(after, spent)))
            continue
        fills, at = [(times, whole)], done
        while at:
            fills.append(at[0])
            at = at[1]
        best, bins = fills, sum(t for t, _ in fills)
    return best


def runs(fills: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """For each length, runs of ranks that share a filling: length, first rank, first sequence, copies in a sequence, offset."""
    seen: dict[int, int] = {}
    rows, sequence = [], 0
    for times, fill in fills:
        offset = 0
        for length in sorted(fill, reverse=True):
            copies = fill[length]
            rows.append((length, seen.get(length, 0), sequence, copies, offset))
            seen[length] = seen.get(length, 0) + times * copies
            offset += length * copies
        sequence += times
    rows.sort()
    return dict(zip(("length", "rank", "sequence", "copies", "offset"), np.array(rows, dtype=np.int64).reshape(-1, 5).T, strict=True))


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece of every document in its place; and in every row the
    sequences in all and the lower bound on them."""
    cut_up = cut(pieces(docs, vocabulary, ranks, pattern, capacity, id_col, text_col))
    by_slice = cut_up.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    places = cut(cut_up.where("place is not null").select("slice", "place"))  # a row for each split of the input
    by_slice = by_slice.join(small(places, places.count()), "slice")
    before = Window.partitionBy("length").orderBy("place", "slice").rowsBetween(Window.unboundedPreceding, -1)
    by_slice = cut(by_slice.select("length", "slice", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    counts = {r["length"]: r["n"] for r in by_slice.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    fills = bin_completion(counts, capacity)
    plan, used, least = runs(fills), sum(t for t, _ in fills), lower_bound(counts, capacity)
    starts = plan["length"] << 48 | plan["rank"]
    schema = T.StructType([*cut_up.schema.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        for batch in batches:
            length, rank = (np.asarray(batch.column(batch.schema.get_field_index(x))) for x in ("length", "rank"))
            at = np.searchsorted(starts, length << 48 | rank, side="right") - 1
            i, k = rank - plan["rank"][at], plan["copies"][at]
            found = (plan["sequence"][at] + i // k, plan["offset"][at] + i % k * length)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, found)], names=schema.names)

    ranked = cut_up.join(small(by_slice.drop("n"), by_slice.count(), BROADCAST_ROWS // 2), ["length", "slice"])
    found = ranked.select(*cut_up.columns[:5], (F.col("rank") + F.col("before")).alias("rank")).mapInArrow(tidy(place), schema)
    return found.withColumns({"sequences": F.lit(used).cast("long"), "lower_bound": F.lit(least).cast("long")})
