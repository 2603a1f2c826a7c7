"""Tokens of a caption and the spans that later stages must not tear apart.

Window functions over (caption, position) find quotes and hyphen words in rows of tokens; where a caption's tokens are one list, they are found
inside the list, a batch of captions at a time, and nothing is exchanged."""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .fold import longest_spans
from .tokenizer import sentence_spans, text_pieces

#: Tokens that a worker holds at a time, about; one caption's are never divided.
BATCH_TOKENS = 50_000
_CELLS = {"i": pa.int32(), "text": pa.string(), "char_start": pa.int32(), "char_end": pa.int32(), "whitespace": pa.string()}
_TOKEN = re.compile(r"[^\W_]+|[^\s]")
QUOTE_MARKS = ('"', "“", "”")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other columns and tokens[] of rows whose last column is the caption, in batches of bounded size whatever the captions' lengths."""
    for batch in batches:
        captions, first = batch.column(batch.num_columns - 1), 0
        sizes, cells = [0], {c: [] for c in _CELLS}
        for at in range(len(batch)):
            text = captions[at].as_py() or ""
            spans = [m.span() for m in _TOKEN.finditer(text)]
            cells["i"] += range(len(spans))
            cells["text"] += [text[a:z] for a, z in spans]
            cells["char_start"] += [a for a, _ in spans]
            cells["char_end"] += [z for _, z in spans]
            cells["whitespace"] += [x if (x := text[z : z + 1]).isspace() else "" for _, z in spans]
            sizes.append(len(cells["i"]))
            if sizes[-1] >= BATCH_TOKENS or at == len(batch) - 1:
                items = pa.StructArray.from_arrays([pa.array(cells[c], t) for c, t in _CELLS.items()], names=list(_CELLS))
                lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), items)
                others = [x.slice(first, at + 1 - first) for x in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*others, lists], names=[*batch.schema.names[:-1], "tokens"])
                first, sizes, cells = at + 1, [0], {c: [] for c in _CELLS}


def token_lists(captions: DataFrame) -> DataFrame:
    """The rows with tokens[] in place of the caption: a row for each caption, so that nothing needs an exchange to bring tokens together."""
    others = captions.drop("caption")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema)
    return captions.select(*others.columns, "caption").mapInArrow(_tokens, f"{kinds}, tokens array<struct<i:int,text:string,char_start:int,char_end:int,whitespace:string>>")


def tokenize(captions: DataFrame) -> DataFrame:
    """caption_id, token…: runs of letters and digits, every other sign on its own. Stands in where no annotator gives tokens."""
    return token_lists(captions.select("caption_id", "caption")).select("caption_id", F.inline("tokens"))


_CELL = pa.struct(list(_CELLS.items()))
_SPAN = pa.struct(
    [(c, pa.int32()) for c in ("char_start", "char_end")] + [(c, pa.string()) for c in ("kind", "rule_id", "text")] + [(c, pa.int32()) for c in ("token_start", "token_end", "final_start", "final_end")]
)
_LISTS = "tokens array<struct<i:int,text:string,char_start:int,char_end:int,whitespace:string>>, protected_spans array<struct<char_start:int,char_end:int,kind:string,rule_id:string,text:string,token_start:int,token_end:int,final_start:int,final_end:int>>"


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _lists(bounds: np.ndarray, items: pa.Array) -> pa.ListArray:
    """Lists of items between bounds; an empty one is null."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items, mask=pa.array(np.diff(bounds) == 0))


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _piece_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other columns and tokens[] of rows whose last column is ``text_pieces``, in batches of bounded size whatever the captions' lengths."""
    for batch in batches:
        at = 0
        ends = _bounds(_sizes(batch.columns[-1]))
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + BATCH_TOKENS, "right")) - 1)
            lists = batch.columns[-1].slice(at, to - at)
            pieces = lists.flatten()
            inner, tied = pieces.field("tokens"), pieces.field("tied").to_numpy(zero_copy_only=False)
            n = _sizes(inner)
            text = inner.flatten()
            white = np.zeros(len(text), bool)
            last = np.cumsum(n) - 1
            white[last[tied & (n > 0)]] = True
            bounds = _bounds(n)[_bounds(_sizes(lists))]
            length = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = _bounds(length + white)  # characters before each token, over the whole batch
            row = np.repeat(np.arange(to - at), np.diff(bounds))
            start = upto[:-1] - upto[bounds[:-1]][row]
            cells = [np.arange(len(text)) - bounds[:-1][row], text, start, start + length, pc.if_else(pa.array(white), " ", "")]
            items = pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x.astype(np.int32)) for x in cells], names=list(_CELLS))
            yield pa.RecordBatch.from_arrays([*(x.slice(at, to - at) for x in batch.columns[:-1]), _lists(bounds, items)], names=[*batch.schema.names[:-1], "tokens"])
            at = to


def _longest(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest first, then earliest, each kept unless it overlaps one kept before; in their order."""
    kept: list[tuple[int, int]] = []
    for a, z in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
        k = bisect(kept, (a, z))
        if (k == 0 or kept[k - 1][1] <= a) and (k == len(kept) or z <= kept[k][0]):
            kept.insert(k, (a, z))
    return kept


def _quotes(text: pa.Array, row: np.ndarray) -> list[tuple[int, int]]:
    """The spans of ``quote_spans`` as places in the batch."""
    straight = np.flatnonzero(pc.equal(text, '"').to_numpy(zero_copy_only=False))
    first = np.searchsorted(row[straight], row[straight])  # the row's first mark
    opens = ((np.arange(len(straight)) - first) % 2 == 0)[:-1] & (row[straight][1:] == row[straight][:-1])
    found = list(zip(straight[:-1][opens], straight[1:][opens] + 1, strict=True))
    curly = np.flatnonzero(pc.is_in(text, pa.array(["“", "”"])).to_numpy(zero_copy_only=False))
    if len(curly):
        begins = pc.equal(text.take(pa.array(curly)), "“").to_numpy(zero_copy_only=False)
        pair = begins[:-1] & ~begins[1:] & (row[curly][1:] == row[curly][:-1])
        found += zip(curly[:-1][pair], curly[1:][pair] + 1, strict=True)
    return [(int(a), int(z)) for a, z in found]


def _hyphen_words(text: pa.Array, whitespace: pa.Array, row: np.ndarray) -> list[tuple[int, int]]:
    """The spans of ``hyphen_spans`` as places in the batch."""
    at = np.flatnonzero(pc.equal(text, "-").to_numpy(zero_copy_only=False))
    at = at[(at > 0) & (at < len(text) - 1)]
    at = at[(row[at - 1] == row[at]) & (row[at + 1] == row[at])]
    if not len(at):
        return []
    free = lambda k: pc.equal(whitespace.take(pa.array(k)), "").to_numpy(zero_copy_only=False)
    at = at[free(at) & free(at - 1)]
    part = lambda k: (pc.match_substring_regex(x := text.take(pa.array(k)), r"\A[\p{L}\p{N}]+\z").to_numpy(zero_copy_only=False)) & pc.match_substring_regex(x, r"\p{L}").to_numpy(zero_copy_only=False)
    at = at[part(at - 1) & part(at + 1)]
    runs: list[list[int]] = []
    for k in at.tolist():
        if runs and runs[-1][1] == k:
            runs[-1][1] = k + 2
        else:
            runs.append([k - 1, k + 2])
    return [(a, z) for a, z in runs if any(len(text[k].as_py()) >= 2 for k in range(a, z, 2))]


def _protected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other columns, tokens[] with protected spans made one, and protected_spans[] of rows whose last column is tokens[]."""
    for batch in batches:
        lists = batch.columns[-1]
        sizes, flat = _sizes(lists), lists.flatten()
        row = np.repeat(np.arange(len(batch)), sizes)
        text, white, char_start, char_end = (flat.field(c) for c in ("text", "whitespace", "char_start", "char_end"))
        quotes = _longest(_quotes(text, row))
        ends = [q[1] for q in quotes]

        def outside(a: int, z: int, quotes=quotes, ends=ends) -> bool:
            k = bisect(ends, a)  # the first quote that ends after a
            return k == len(quotes) or quotes[k][0] >= z

        words = [w for w in _hyphen_words(text, white, row) if outside(*w)]
        spans = sorted([(a, z, "quote") for a, z in quotes] + [(a, z, "hyphen_word") for a, z in words])
        begins = np.ones(len(flat), bool)
        for a, z, _ in spans:
            begins[a + 1 : z] = False
        starts = np.flatnonzero(begins)
        lasts = np.append(starts[1:], len(flat))[: len(starts)] - 1
        bounds, place = _bounds(sizes), _bounds(begins)
        finals = place[bounds]
        texts = ["".join(x + y for x, y in zip(text[a:z].to_pylist(), [*white[a : z - 1].to_pylist(), ""], strict=True)) for a, z, _ in spans]
        one = text.take(pa.array(starts))
        if spans:
            made = np.zeros(len(starts), bool)
            made[place[[a for a, _, _ in spans]]] = True
            one = pc.replace_with_mask(one, pa.array(made), pa.array(texts, pa.string()))
        number = place[:-1] - finals[:-1][row]  # of the merged token that a token begins
        cells = [pa.array(number[starts].astype(np.int32)), one, char_start.take(pa.array(starts)), char_end.take(pa.array(lasts)), white.take(pa.array(lasts))]
        tokens = _lists(finals, pa.StructArray.from_arrays(cells, fields=list(_CELL)))
        rows = [
            (char_start[a].as_py(), char_end[z - 1].as_py(), kind, SPAN_RULES[kind], said, int(a - bounds[row[a]]), int(z - bounds[row[a]]), int(number[a]), int(number[a]) + 1)
            for (a, z, kind), said in zip(spans, texts, strict=True)
        ]
        found = pa.array([dict(zip([f.name for f in _SPAN], x, strict=True)) for x in rows], _SPAN)
        counted = np.bincount(row[[a for a, _, _ in spans]], minlength=len(batch)) if spans else np.zeros(len(batch), int)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], tokens, _lists(_bounds(counted), found)], names=[*batch.schema.names[:-1], "tokens", "protected_spans"])


def protected_lists(captions: DataFrame, by_rules: bool = False) -> DataFrame:
    """The rows with tokens[] in which every protected span is one, and protected_spans[]: what ``protected_spans``, ``merged_tokens`` and
    ``attach`` make of rows of tokens, without an exchange. Tokens are those of ``tokenize``, or by rules those of ``rule_tokens``."""
    others = captions.drop("caption")
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others.schema)
    last, made = (text_pieces(captions["caption"]).alias("pieces"), _piece_tokens) if by_rules else (captions["caption"], _tokens)
    return captions.select(*others.columns, last).mapInArrow(lambda batches: _protected(made(batches)), kinds + _LISTS)


def quote_marks(lists: DataFrame) -> DataFrame:
    """caption_id, token… of quotation marks alone: all that quote_spans looks at, and the ends of its spans."""
    return lists.select("caption_id", F.inline(F.filter("tokens", lambda t: t.text.isin(*QUOTE_MARKS))))


def near_hyphens(lists: DataFrame) -> DataFrame:
    """caption_id, token… within two places of a hyphen: hyphen_spans makes of them the same spans as of all tokens.

    A tied part, its hyphen and the part before lie side by side there, and between tokens that are left out and the next that is not there
    is no hyphen, so nothing is tied across a gap."""
    is_hyphen = lambda k: F.coalesce(F.get("tokens", k)["text"] == "-", F.lit(False))
    near = F.filter("tokens", lambda t, k: (t.text == "-") | is_hyphen(k - 1) | is_hyphen(k + 1) | is_hyphen(k - 2) | is_hyphen(k + 2))
    return lists.where(F.exists("tokens", lambda t: t.text == "-")).select("caption_id", F.inline(near))


def quote_spans(tokens: DataFrame) -> DataFrame:
    """caption_id, token_start, token_end: straight quotes pair in order; an opening quote pairs with the next closing one
    if no other quote of its kind stands between."""
    by = Window.partitionBy("caption_id").orderBy("i")
    straight = tokens.where(F.col("text") == '"').withColumns({"n": F.row_number().over(by), "end": F.lead("i").over(by)})
    straight = straight.where("n % 2 = 1 and end is not null")
    curly = tokens.where(F.col("text").isin("“", "”")).withColumns({"next": F.lead("text").over(by), "end": F.lead("i").over(by)})
    curly = curly.where((F.col("text") == "“") & (F.col("next") == "”"))
    both = [x.select("caption_id", F.col("i").alias("token_start"), (F.col("end") + 1).alias("token_end")) for x in (straight, curly)]
    return both[0].unionByName(both[1])


def hyphen_spans(tokens: DataFrame) -> DataFrame:
    """caption_id, token_start, token_end: longest runs of parts joined by hyphens without white space, some part of two signs or more."""
    by = Window.partitionBy("caption_id").orderBy("i")
    part = F.col("text").rlike(r"(?U)^[\p{L}\p{N}]+$") & F.col("text").rlike(r"\p{L}")
    rows = tokens.withColumn("part", part)
    before = lambda c, k: F.lag(c, k).over(by)
    tied = (before("text", 1) == "-") & (before("whitespace", 1) == "") & before("part", 2) & (before("whitespace", 2) == "")
    rows = rows.withColumn("tied", F.coalesce(tied, F.lit(False))).where("part")
    rows = rows.withColumn("run", F.sum(F.when(F.col("tied"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy("caption_id", "run").agg(F.min("i").alias("token_start"), (F.max("i") + 1).alias("token_end"), F.count(F.lit(1)).alias("parts"), F.max(F.length("text")).alias("longest"))
    return runs.where("parts >= 2 and longest >= 2").select("caption_id", "token_start", "token_end")


def _with_text(spans: DataFrame, tokens: DataFrame) -> DataFrame:
    """Character places and text of token spans."""
    inside = spans.join(tokens.drop("caption"), "caption_id").where("i >= token_start and i < token_end")
    piece = F.struct("i", "text", "whitespace")
    keys = [c for c in spans.columns]
    out = inside.groupBy(*keys).agg(F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"), F.array_sort(F.collect_list(piece)).alias("all"))
    text = F.array_join(F.transform("all", lambda x, k: F.when(k == F.size("all") - 1, x.text).otherwise(F.concat(x.text, x.whitespace))), "")
    return out.select(*keys, "char_start", "char_end", text.alias("text"))


def protected_spans(tokens: DataFrame) -> DataFrame:
    """Quotes, then hyphen words outside quotes; overlaps go to the longest, then to the earliest span."""
    quotes = longest_spans(quote_spans(tokens), ["caption_id"], "token_start", "token_end").withColumns({"kind": F.lit("quote"), "rule_id": F.lit("R3")})
    words = longest_spans(hyphen_spans(tokens), ["caption_id"], "token_start", "token_end").withColumns({"kind": F.lit("hyphen_word"), "rule_id": F.lit("R5")})
    q = quotes.select(F.col("caption_id").alias("cid"), F.col("token_start").alias("qs"), F.col("token_end").alias("qe"))
    free = words.join(q, (F.col("caption_id") == F.col("cid")) & (F.col("token_start") < F.col("qe")) & (F.col("qs") < F.col("token_end")), "left_anti")
    return _with_text(quotes.unionByName(free), tokens)


def merged_tokens(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """Tokens with every protected span made one, numbered anew."""
    s = spans.select(F.col("caption_id").alias("cid"), "token_start", "token_end", F.col("text").alias("span_text"))
    rows = tokens.join(s, (F.col("caption_id") == F.col("cid")) & (F.col("i") >= F.col("token_start")) & (F.col("i") < F.col("token_end")), "left").drop("cid", "token_end")
    key = F.coalesce("token_start", "i")
    one = rows.groupBy("caption_id", key.alias("k")).agg(
        F.coalesce(F.max("span_text"), F.max("text")).alias("text"), F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"), F.max_by("whitespace", "i").alias("whitespace")
    )
    return one.withColumn("i", F.row_number().over(Window.partitionBy("caption_id").orderBy("k")) - 1).drop("k")


def attach(spans: DataFrame, merged: DataFrame) -> DataFrame:
    """Spans with the place of the merged token that has exactly their characters."""
    m = merged.select("caption_id", "char_start", "char_end", F.col("i").alias("final_start"))
    return spans.join(m, ["caption_id", "char_start", "char_end"], "left").withColumn("final_end", F.col("final_start") + 1)


def summary(spans: DataFrame) -> DataFrame:
    return spans.groupBy("kind").agg(F.count(F.lit(1)).alias("spans"), F.count_distinct("caption_id").alias("captions"))


# Rules of the second stage, and of what a model adds in the third (tags, dependencies, morphology, lemmas, noun chunks).
TOKEN_RULE, SPAN_RULES = "R2", {"quote": "R3", "hyphen_word": "R5"}
MODEL_RULES = ("R6", "R8", "R9", "R10", "R11")


def rule_ids(captions: DataFrame, spans: DataFrame, model: bool = False) -> DataFrame:
    """caption_id, rule_ids[] in the order of the rules: tokenization, the kinds of spans that the caption has, and what a model did."""
    kinds = spans.groupBy("caption_id").agg(F.collect_set("kind").alias("kinds"))
    out = captions.select("caption_id").join(kinds, "caption_id", "left")
    none = F.array().cast("array<string>")
    found = F.concat(*(F.when(F.coalesce(F.array_contains("kinds", kind), F.lit(False)), F.array(F.lit(rule))).otherwise(none) for kind, rule in SPAN_RULES.items()))
    return out.select("caption_id", F.concat(F.array(F.lit(TOKEN_RULE)), found, F.array(*map(F.lit, MODEL_RULES)) if model else none).alias("rule_ids"))


def preprocess(captions: DataFrame) -> DataFrame:
    """The records of the second stage: caption_id, caption, tokens[] with protected spans made one, protected_spans[], rule_ids[].

    A row for each caption throughout, so nothing is exchanged or kept."""
    out = protected_lists(captions.select("caption_id", F.col("caption").alias("_said"), "caption"), by_rules=True)
    none = F.array().cast("array<string>")
    has = lambda kind: F.coalesce(F.exists("protected_spans", lambda s: s.kind == kind), F.lit(False))
    found = F.concat(F.array(F.lit(TOKEN_RULE)), *(F.when(has(kind), F.array(F.lit(rule))).otherwise(none) for kind, rule in SPAN_RULES.items()))
    cells = ("char_start", "char_end", "kind", "rule_id", "text")
    spans = F.transform("protected_spans", lambda s: F.struct(*(s[c].alias(c) for c in cells), s.final_start.alias("token_start"), s.final_end.alias("token_end")))
    return out.select("caption_id", F.col("_said").alias("caption"), "tokens", spans.alias("protected_spans"), found.alias("rule_ids"))


def stage3_records(annotated: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """Annotated captions with sentences[] (by the rule of ``sentence_spans``, unless the annotator gave some) and rule_ids[]. spans: the protected
    spans of the second stage, if there were any."""
    tokens = annotated.select("caption_id", F.inline("tokens"))
    rows = sentence_spans(tokens).groupBy("caption_id").agg(F.array_sort(F.collect_list(F.struct("token_start", "token_end", "char_start", "char_end"))).alias("_found"))
    none = annotated.select("caption_id", F.lit("").alias("kind")).limit(0)
    out = annotated.join(rows, "caption_id", "left").join(rule_ids(annotated, none if spans is None else spans, model=True), "caption_id", "left")
    with_text = F.transform("_found", lambda s: F.struct(F.substring(F.col("caption"), s.char_start + 1, s.char_end - s.char_start).alias("text"), s.token_start.alias("token_start"), s.token_end.alias("token_end"), s.char_start.alias("char_start"), s.char_end.alias("char_end")))
    given = F.col("sentences") if "sentences" in annotated.columns else F.lit(None)
    return out.withColumn("sentences", F.coalesce(given, with_text) if "sentences" in annotated.columns else with_text).drop("_found")
