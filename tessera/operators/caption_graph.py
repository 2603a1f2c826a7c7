"""The rules of ``extract`` inside each caption: one pass over Arrow batches of captions, without an exchange.

A caption's graph depends on that caption and the lexicons alone, so where the lexicons are counted to be small they travel with the
function and nothing is joined. The steps are those of ``extract``, in the same order and with the same null rules; a test holds both
against each other."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ..schema import MISSING_SOURCE, MISSING_TARGET, RAW_EDGE, RAW_MENTION

#: Rows of a lexicon that may travel with the function.
LEXICON_ROWS = 50_000
#: Keys of texts that a worker remembers.
CACHED = 1 << 14

_SPACES, _SEPARATORS = re.compile(r"\s+"), re.compile(r"[\s_\-]+")
_TOKEN = ("text", "lemma", "pos", "tag", "dep", "head_i", "char_start", "char_end", "whitespace")
_CHUNK, _SEGMENT = ("root_i", "token_start", "token_end"), ("segment_id", "token_start", "token_end")


def _names(schema: str) -> list[str]:
    return [x.strip().split(" ", 1)[0] for x in schema.split(", ")][1:]  # without the caption


_MENTION, _EDGE = _names(RAW_MENTION), _names(RAW_EDGE)


@lru_cache(CACHED)
def query_key(x: str | None) -> str | None:
    """``normalize_query``."""
    return None if x is None else _SPACES.sub(" ", x.lower()).strip(" ")


@lru_cache(CACHED)
def spaced_key(x: str | None) -> str | None:
    """``separator_key``."""
    return None if x is None else _SEPARATORS.sub(" ", x.lower()).strip(" ")


@lru_cache(CACHED)
def variant_keys(x: str | None) -> frozenset[str]:
    """``surface_variant_keys``."""
    if x is None:
        return frozenset()
    spaced = spaced_key(x)
    return frozenset((query_key(x), spaced, spaced.replace(" ", ""), spaced.replace(" ", "_"))) - {""}


def joined(words, sep: str = " ") -> str:
    return sep.join([w for w in words if w is not None])


class Caption:
    """The columns of one caption's tokens."""

    __slots__ = (*_TOKEN, "shape", "chunks", "segments", "n")

    def __init__(self, shape, tokens, chunks, segments):
        self.shape, self.chunks, self.segments = shape, chunks, segments
        for name, column in zip(_TOKEN, tokens, strict=True):
            setattr(self, name, column)
        self.n = len(self.text)

    def written(self, a: int, z: int) -> str:
        """Tokens as they stand in the caption."""
        return "".join([t + (w or "") for t, w in zip(self.text[a:z], self.whitespace[a:z], strict=True) if t is not None]).strip(" ")


def values(column: pa.Array) -> list:
    """As ``to_pylist``, by way of NumPy where that keeps the values; several times as fast."""
    if pa.types.is_string(column.type) or not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def captions(batch: pa.RecordBatch) -> Iterator[tuple[str, Caption]]:
    def lists(names, prefix):
        out = []
        for name in names:
            column = batch.column(f"{prefix}{name}")
            ends = list(accumulate(values(pc.fill_null(pc.list_value_length(column), 0)), initial=0))
            out.append((values(column.flatten()), ends))
        return out

    tokens, chunks, segments = lists(_TOKEN, "t_"), lists(_CHUNK, "c_"), lists(_SEGMENT, "s_")
    cell = lambda columns, r: [cells[ends[r] : ends[r + 1]] for cells, ends in columns]
    for r, (name, shape) in enumerate(zip(values(batch.column("caption_id")), values(batch.column("caption_shape")), strict=True)):
        yield name, Caption(shape, cell(tokens, r), list(zip(*cell(chunks, r), strict=True)), list(zip(*cell(segments, r), strict=True)))


def columns(annotated: DataFrame) -> DataFrame:
    """What ``captions`` reads."""
    part = lambda array, names, prefix: [F.col(f"{array}.{n}").alias(f"{prefix}{n}") for n in names]
    return annotated.select("caption_id", "caption_shape", *part("tokens", _TOKEN, "t_"), *part("noun_chunks", _CHUNK, "c_"), *part("tag_segments", _SEGMENT, "s_"))


def greedy(spans: list, start, end) -> list:
    """Sorted spans, each kept unless it overlaps one kept before."""
    kept = []
    for x in spans:
        if all(start(x) >= end(y) or start(y) >= end(x) for y in kept):
            kept.append(x)
    return kept


def phrases_of(c: Caption, prepositions: dict, widths: list[int]) -> list[tuple]:
    """(start, end, key, row) of the phrases of the lexicon in a sentence, longest first, then earliest."""
    if c.shape != "sentence":
        return []
    w = [None if t is None else t.lower() for t in c.text]
    found = []
    for k in widths:
        for s in range(c.n - k + 1):
            key = joined(w[s : s + k])
            if key in prepositions:
                found.append((s, s + k, key, prepositions[key]))
    found.sort(key=lambda x: (x[0] - x[1], x[0]))
    return greedy(found, lambda x: x[0], lambda x: x[1])


def span_objects(c: Caption, objects: dict, blocked_deps, blocked_pos) -> list[dict]:
    """For each noun chunk its best object, in chunk order."""
    out = []
    for ix, (root, begin, end) in enumerate(c.chunks):
        if root is None or begin is None or end is None or not begin <= root < end:
            continue
        if begin < 0 or root >= c.n:
            raise ValueError(f"noun chunk {ix} lies outside the caption's {c.n} tokens")
        last = c.lemma[root]
        for start in range(begin, root + 1):
            if start != root and (c.dep[start] in blocked_deps or c.pos[start] in blocked_pos):
                continue
            exact = query_key(c.written(start, root + 1))
            keys = [exact]
            if last:
                changed = joined([*exact.split(" ")[:-1], query_key(last)])
                if changed != exact:
                    keys.append(changed)
            hits = [(0 if query_key(objects[k]["query"]) == exact else 1, n, objects[k]) for n, k in enumerate(keys) if k in objects]
            if hits:
                row = min(hits, key=lambda x: x[:2])[2]
                cut = _core(c, start, root + 1, row)
                out.append({"ix": ix, "root": root, "c_start": begin, "c_end": end, "start": start + cut, "end": root + 1, "row": row})
                break
    return out


def _core(c: Caption, a: int, z: int, row: dict) -> int:
    some = lambda *xs: [x for x in xs if x]
    suffixes = None
    for group in (some(row["canonical_surface"], row["canonical_label_key"]), row["synset_lemmas"] or [], some(row["query"])):
        if not group:
            continue
        keys = set().union(*map(variant_keys, group))
        if suffixes is None:
            suffixes = [variant_keys(joined(c.text[j:z])) | variant_keys(joined(c.lemma[j:z])) for j in range(a, z)]
        for j, forms in enumerate(suffixes):
            if forms & keys:
                return j
    return 0


def reached(roots: list[int], steps: dict[int, list[int]]) -> list[tuple]:
    """(root, node, depth, path) of everything reached along the steps."""
    out, level = [], [(r, r, 0, (r,)) for r in roots]
    while level:
        out += level
        level = [(root, n, depth + 1, (*path, n)) for root, node, depth, path in level for n in steps.get(node, ()) if n not in path]
    return out


def _modifiers(c: Caption, objects: list[dict], taken: set[int], phrases: dict, r) -> list[dict]:
    out = []
    for o in objects:
        ix, inside = o["ix"], range(max(o["c_start"], 0), min(o["c_end"], c.n))
        excluded = {i for i in inside if i in taken or o["start"] <= i < o["end"]}
        quantity = {}
        for i in inside:  # as SQL has it: unknown where neither is so and one is null
            dep, pos = c.dep[i], c.pos[i]
            quantity[i] = True if dep in r.QUANTITY_DEPS or pos == "NUM" else None if dep is None or pos is None else False
        usable = [i for i in inside if i not in excluded]
        roots = [i for i in usable if c.dep[i] in r.ATTRIBUTE_DEPS and quantity[i] is False]
        steps: dict[int, list[int]] = {}
        for i in usable:
            if c.dep[i] == "conj" and quantity[i] is False and c.head_i[i] is not None and c.head_i[i] != i:
                steps.setdefault(c.head_i[i], []).append(i)
        anchors = reached(roots, steps)
        nodes = {node for _, node, _, _ in anchors}
        spans, open_ = [], o["c_start"]
        for i in inside:
            edge = i in excluded or c.dep[i] in r.MWE_BOUNDARY_DEPS or c.pos[i] in r.MWE_BOUNDARY_POS
            if edge or quantity[i]:
                open_ = i + 1
            elif quantity[i] is False and i in nodes:
                for start in range(open_, i):
                    row = phrases.get(spaced_key(joined(c.text[start : i + 1])))
                    if row is not None:
                        spans.append((start - i - 1, -i, start, row))
        spans.sort(key=lambda x: x[:3])
        chosen = greedy(spans, lambda x: x[2], lambda x: 1 - x[1])
        covered = set()
        put = lambda kind, start, end, text, lemma, unit, span_key, source, ord_: out.append({"ix": ix, "key": f"a_{ix}_{start}_{end}", "kind": kind, "start": start, "end": end, "text": text, "lemma": lemma, "unit": unit, "span_key": span_key, "source": source, "ord": ord_})  # noqa: E731, B023
        for _, anchor, start, row in chosen:
            end = 1 - anchor
            covered.update(range(start, end))
            put("attribute", start, end, joined(c.text[start:end]), joined(c.lemma[start:end]), "mwe", row["span_key"], "attribute_mwe", [1, ix, 1, start])
        single = {i for i in usable if i not in covered}
        for i in usable:
            if i in single and quantity[i]:
                put("quantity", i, i + 1, c.text[i], c.lemma[i], None, None, None, [1, ix, 1, i])
        for root, node, depth, path in anchors:
            if root not in covered and node in single:
                put("attribute", node, node + 1, c.text[node], c.lemma[node], "single_token", None, "conj_of_attribute_modifier" if depth else None, [1, ix, 1, root, depth, *path])
    return out


def _floating(c: Caption, objects: list[dict], phrases: dict, r) -> list[dict]:
    out = []
    if c.shape != "tag_list":
        return out
    for _, s, e in c.segments:
        if s is None or e is None or any(s <= o["start"] < e for o in objects):
            continue
        words = [i for i in range(max(s, 0), min(e, c.n)) if c.pos[i] not in ("PUNCT", "SPACE")]
        if not words:
            continue
        text, first = joined(c.text[i] for i in words), words[0]
        row = phrases.get(spaced_key(text)) if len(words) > 1 else None
        known = row is not None and row["span_key"] is not None
        if known or (len(words) == 1 and (c.pos[first] in r.FLOATING_POS or c.tag[first] in r.FLOATING_TAGS)):
            out.append({"key": f"f_{first}", "start": first, "end": words[-1] + 1, "text": text, "lemma": joined(c.lemma[i] for i in words), "unit": "mwe" if known else "single_token", "span_key": row["span_key"] if known else None, "source": "tag_list_unattached_attribute_mwe" if known else "tag_list_unattached_attribute", "ord": [1, first, 0]})
    return out


def verb_phrases(c: Caption, kids: dict[int, list[int]], taken: set[int]) -> Iterator[tuple[int, list[tuple]]]:
    """For each free verb of a sentence its candidates (rank, parts, preps, key, text): alone, with a preposition under it, with a particle, with both."""
    is_prep = lambda i: c.dep[i] == "prep" or c.pos[i] == "ADP"
    for head in range(c.n) if c.shape == "sentence" else ():
        if c.pos[head] != "VERB" or head in taken:
            continue
        loose = [i for i in kids.get(head, ()) if i not in taken]
        direct = [q for q in loose if is_prep(q) and q > head]
        found = [(3, [head], [], query_key(c.text[head]), c.text[head])]

        def add(rank: int, parts: list[int], preps: list[int]) -> None:
            text = joined(c.text[i] for i in parts)
            found.append((rank, parts, preps, query_key(text), text))  # noqa: B023

        for q in direct:
            add(2, [head, q], [q])
        for p in loose:
            if c.dep[p] == "prt" or c.tag[p] == "RP":
                own = [p] if is_prep(p) else []
                add(1, [head, p], own)
                under = [q for q in kids.get(p, ()) if q not in taken and is_prep(q) and q > head]
                for q in dict.fromkeys([*(q for q in direct if q != p), *under]):
                    add(0, [head, p, q], [*own, q])
        yield head, found


def _actions(c: Caption, kids, taken, actions: dict) -> list[dict]:
    out = []
    for head, found in verb_phrases(c, kids, taken):

        def place(x):
            rank, parts, _, key, _ = x
            bad = not actions.get(key)
            return bad, bad and rank != 3, -len(parts), rank, parts

        rank, parts, preps, key, text = min(found, key=place)
        out.append({"head": head, "key": f"v_{head}", "lemma": c.lemma[head] if len(parts) == 1 else key, "parts": parts, "preps": preps, "text": text, "synset": actions.get(key)})
    return out


class Graph:
    """Mentions and edges of a caption by the lexicons: dictionaries by key."""

    def __init__(self, lexicons: dict[str, dict], widths: list[int]):
        self.lex, self.widths = lexicons, widths

    def __call__(self, c: Caption) -> tuple[list[tuple], list[tuple]]:
        from . import extract as r  # the rules' word lists

        lex = self.lex
        kids: dict[int, list[int]] = {}
        for i, h in enumerate(c.head_i):
            if h is not None and h != i:
                kids.setdefault(h, []).append(i)
        phrases = phrases_of(c, lex["prepositions"], self.widths)
        taken = {i for s, e, _, _ in phrases for i in range(s, e)}
        spans = span_objects(c, lex["objects"], r.BLOCKED_START_DEPS, r.BLOCKED_START_POS)
        objects = greedy([o for o in spans if not any(i in taken for i in range(o["start"], o["end"]))], lambda o: o["start"], lambda o: o["end"])
        by_token = {i: f"o_{o['ix']}" for o in objects for i in range(o["start"], o["end"])}
        mods = _modifiers(c, objects, taken, lex["phrases"], r)
        acts = _actions(c, kids, taken, lex["actions"])
        mentions, ids = self._mentions(c, objects, mods, _floating(c, objects, lex["phrases"], r), acts)
        return mentions, self._edges(c, r, kids, phrases, taken, by_token, mods, acts, ids)

    def _mentions(self, c: Caption, objects, mods, floating, acts) -> tuple[list[tuple], dict[str, str]]:
        tag, rows = c.shape == "tag_list", []
        at = {o["ix"]: o["c_start"] for o in objects}
        moved = lambda ix, ord_: [ord_[0], at[ix], *ord_[2:]] if tag else ord_  # noqa: E731 - a chunk in a tag list is placed by its tokens
        for o in objects:
            raw, x = c.written(o["start"], o["end"]), o["row"]
            lemma = c.lemma[o["start"]] if o["end"] - o["start"] == 1 else query_key(raw)
            rows.append((moved(o["ix"], [1, o["ix"], 0]), f"o_{o['ix']}", {"mention_type": "object", "text": raw, "lemma": lemma, "rule_id": "R12", "token_start": o["start"], "token_end": o["end"], **{k: x[k] for k in ("canonical_surface", "canonical_selection_tag", "parent_lemmas", "parent_synset_ids", "selected_synset", "selected_lexfile")}}))
        for m in mods:
            rows.append((moved(m["ix"], m["ord"]), m["key"], {"mention_type": m["kind"], "text": m["text"], "lemma": m["lemma"], "rule_id": "R14" if m["kind"] == "quantity" else "R13", "token_start": m["start"], "token_end": m["end"], "attribute_unit_type": m["unit"], "inventory_span_key": m["span_key"], "modifier_source": m["source"]}))
        for m in floating:
            rows.append((m["ord"], m["key"], {"mention_type": "attribute", "text": m["text"], "lemma": m["lemma"], "rule_id": "R13", "token_start": m["start"], "token_end": m["end"], "attribute_unit_type": m["unit"], "inventory_span_key": m["span_key"], "modifier_source": m["source"]}))
        for a in acts:
            rows.append(([4, a["head"]], a["key"], {"mention_type": "action", "text": a["text"], "lemma": a["lemma"], "rule_id": "R15", "token_start": min(a["parts"]), "token_end": max(a["parts"]) + 1, "token_indices": a["parts"], "selected_synset": a["synset"]}))
        rows.sort(key=lambda x: x[:2])
        out, ids = [], {}
        for n, (_, key, m) in enumerate(rows):
            ids[key] = m["mention_id"] = f"m{n}"
            start, end = m["token_start"], m["token_end"]
            m |= {"stage": "stage4", "confidence": "high", "char_start": c.char_start[start], "char_end": c.char_end[end - 1]}
            m.setdefault("token_indices", list(range(start, end)))
            within = [k for k, s, e in c.segments if s is not None and e is not None and s <= start < e] if tag else []
            for segment in within or [None]:
                m["segment_id"] = segment
                out.append(tuple(map(m.get, _MENTION)))
        return out, ids

    def _edges(self, c: Caption, r, kids, phrases, taken, by_token, mods, acts, ids) -> list[tuple]:
        rows: list[tuple] = []  # ord, src, dst, the rest
        put = lambda ord_, kind, src, dst, label, rule, **more: rows.append((ord_, src, dst, {"edge_type": kind, "label": label, "rule_id": rule, **more}))
        for m in mods:
            put(m["ord"], f"has_{m['kind']}", f"o_{m['ix']}", m["key"], f"has_{m['kind']}", "R14" if m["kind"] == "quantity" else "R13")

        on_object = {h: [i for i in ks if i in by_token] for h, ks in kids.items()}
        steps = {h: [i for i in ks if c.dep[i] == "conj"] for h, ks in on_object.items()}
        targets: dict[int, list[tuple]] = {}  # by preposition: base, depth, path, obj
        goals: dict[int, list[int]] = {}
        for prep, ks in on_object.items():
            goals[prep] = bases = [i for i in ks if c.dep[i] == "pobj"]
            for base in bases:
                best: dict[str, tuple] = {}  # a mention once for each base
                for _, node, depth, path in reached([base], steps):
                    obj = by_token.get(node)
                    if obj is not None and (obj not in best or (depth, path) < best[obj][1:3]):
                        best[obj] = (base, depth, path, obj)
                targets.setdefault(prep, []).extend(best.values())
        for prep in targets:
            targets[prep].sort()

        for start, end, key, row in phrases:
            final, initial = start + row["final_offset"], start + row["initial_offset"]
            if not (0 <= final < c.n and 0 <= initial < c.n) or c.pos[final] != "ADP":
                continue
            at = c.head_i[initial]
            if at is None or not 0 <= at < c.n:
                continue
            if at in by_token:
                sources = [by_token[at]]
            elif c.pos[at] in ("VERB", "AUX"):
                sources = list(dict.fromkeys(by_token[i] for i in sorted(on_object.get(at, ()))))
            else:
                sources = []
            found = targets.get(final, [])
            ns, nt = len(sources), len({x[0] for x in found})
            if not ns or not nt:
                scope = "source_and_target_missing" if not ns and not nt else "target_missing" if ns else "source_missing"
            else:
                scope = "source_and_target" if ns > 1 and nt > 1 else "source" if ns > 1 else "target" if nt > 1 else "none"
            kind = "relation" if ns == 1 and nt == 1 else "ambiguous_relation_candidate"
            for sn, src in enumerate(sources or [MISSING_SOURCE]):
                for tn, dst in enumerate([x[3] for x in found] or [MISSING_TARGET]):
                    put([2, start, sn, tn], kind, src, dst, row["canonical_relation"], "R18.1", raw_span_surface=key, matched_token_indices=[str(i) for i in range(start, end)], relation_components=row["components"], ambiguity_scope=scope)

        agents: dict[int, set[str]] = {}
        low = lambda x: x is not None and x.lower() == "by"
        for a in acts:
            head, src, turned = a["head"], a["key"], False
            for i in on_object.get(head, ()):
                dep, obj = c.dep[i], by_token[i]
                if dep == "nsubj":
                    put([5, head, 0, i], "event_role", src, obj, "agent", "R16")
                    agents.setdefault(head, set()).add(obj)
                elif dep in r.PASSIVE_SUBJECT_DEPS:
                    turned = True
                    put([5, head, 0, i], "event_role", src, obj, "patient", "R17.1", raw_role="theme", voice_normalization="passive_to_active")
                elif dep in r.PATIENT_DEPS:
                    put([5, head, 0, i], "event_role", src, obj, "patient", "R17")
            for by in kids.get(head, ()) if turned else ():
                if c.dep[by] in r.PASSIVE_BY_DEPS and (low(c.lemma[by]) or low(c.text[by])):
                    for i in goals.get(by, ()):
                        put([5, head, 1, by, i], "event_role", src, by_token[i], "agent", "R16.2", raw_role="by_agent_or_causer", voice_normalization="passive_to_active")
                        agents.setdefault(head, set()).add(by_token[i])
        last: dict[int, dict] = {}
        for a in acts:  # in the order of heads: the last one has the preposition
            for by in a["preps"]:
                last[by] = a
        for by, a in last.items():
            for i in goals.get(by, ()):
                put([6, by, i], "event_role", a["key"], by_token[i], "patient", "R17")

        active = [a for a in acts if not any(c.dep[i] in r.PASSIVE_SIGNS for i in kids.get(a["head"], ()))]
        for a in active:
            head = a["head"]
            obj = by_token.get(c.head_i[head])
            if c.dep[head] == "acl" and c.tag[head] == "VBG" and head not in agents and obj is not None:
                put([7, head], "event_role", a["key"], obj, "agent", "R16.3")
                agents[head] = {obj}
        waiting, number = [(a["head"], a["key"], c.head_i[a["head"]]) for a in active if c.dep[a["head"]] == "conj"], 0
        while True:  # as many rounds as the longest chain of conjuncts
            number += 1
            new = [(head, src, next(iter(agents[over]))) for head, src, over in waiting if head not in agents and head != over and len(agents.get(over, ())) == 1]
            if not new:
                break
            for head, src, obj in new:
                put([8, number, head], "event_role", src, obj, "agent", "R16.1")
                agents[head] = {obj}

        if c.shape == "sentence":
            eaten = {i for a in acts for i in a["preps"]} | taken
            for i in range(c.n):
                src = by_token.get(c.head_i[i]) if c.pos[i] == "ADP" and i not in eaten else None
                if src is not None:
                    for base, depth, path, obj in targets.get(i, ()):
                        put([9, i, base, depth, *path], "relation", src, obj, c.lemma[i] or c.text[i], "R18")

        rows.sort(key=lambda x: x[:3])
        out = []
        for n, (_, src, dst, e) in enumerate(rows):
            e |= {"edge_id": f"e{n}", "source_mention_id": ids.get(src, src), "target_mention_id": ids.get(dst, dst), "stage": "stage4", "confidence": "high"}
            out.append(tuple(map(e.get, _EDGE)))
        return out


def _array(lists: list[list[tuple]], kind: pa.DataType) -> pa.Array:
    """Lists of rows as an array of struct lists."""
    fields = list(kind.value_type)
    flat = [x for rows in lists for x in rows]
    cells = zip(*flat, strict=True) if flat else [[] for _ in fields]
    rows = pa.StructArray.from_arrays([pa.array(list(v), f.type) for v, f in zip(cells, fields, strict=True)], fields=fields)
    ends = pa.array(accumulate(map(len, lists), initial=0), pa.int32())
    return pa.ListArray.from_arrays(ends, rows, type=kind)


def _struct(schema: str) -> str:
    return "array<struct<" + ", ".join(x.strip().replace(" ", ":", 1) for x in schema.split(", ")[1:]) + ">>"


def small(lexicon: DataFrame, rows: int) -> dict | None:
    """The lexicon's rows by key, if they are few and each key has one."""
    found = [r.asDict() for r in lexicon.limit(rows + 1).collect()]
    out = {r["key"]: r for r in found if r["key"] is not None}
    return out if len(found) <= rows and len(out) == sum(r["key"] is not None for r in found) else None


_CANDIDATE = "place string, unit string, start int, end int, anchor int, surface string, plural boolean, objectless boolean, span_key string"


class Candidates:
    """The spans of a caption that may be attributes, as ``builders.attribute_candidates`` has them without the caption."""

    def __init__(self, objects: dict, prepositions: dict, mode: str):
        self.objects, self.prepositions, self.mode = objects, prepositions, mode
        self.widths = sorted({r["width"] for r in prepositions.values()})

    def __call__(self, c: Caption) -> list[tuple]:
        from . import builders as b  # the rules' word lists

        phrases, singles, loose = [], [], []
        taken = {i for s, e, _, _ in phrases_of(c, self.prepositions, self.widths) for i in range(s, e)}
        spans = span_objects(c, self.objects, b.BLOCKED_START_DEPS, b.BLOCKED_START_POS)
        quantity = [dep in b.QUANTITY_DEPS or pos == "NUM" for dep, pos in zip(c.dep, c.pos, strict=True)]
        for o in spans:
            base, place = o["c_start"], f"c{o['ix']}"
            inside = range(base, min(o["c_end"], c.n))
            usable = {i for i in inside if i not in taken and not o["start"] <= i < o["end"] and not quantity[i]}
            first = base  # after the last border
            for i in inside:
                border = i not in usable or c.dep[i] in b.MWE_BOUNDARY_DEPS or c.pos[i] in b.MWE_BOUNDARY_POS
                if self._anchor(c, i, usable, len(inside), b):
                    if not border:
                        for start in range(first, i):
                            phrases.append((place, b.PHRASE, start, i + 1, i, joined(c.text[start : i + 1]), False, False))
                    singles.append((place, b.SINGLE, i, i + 1, i, c.text[i], c.tag[i] in b.PLURAL_TAGS, False))
                if border:
                    first = i + 1
        if c.shape == "tag_list":
            for ix, (_, s, e) in enumerate(c.segments):
                if s is None or e is None or any(s <= o["root"] < e for o in spans):
                    continue
                words = [i for i in range(max(s, 0), min(e, c.n)) if c.pos[i] not in ("PUNCT", "SPACE")]
                if len(words) > 1 and not any(quantity[i] or i in taken for i in words):
                    loose.append((f"s{ix}", b.PHRASE, words[0], words[-1] + 1, words[-1], joined(c.text[i] for i in words), False, True))
        found = {"all": (phrases, singles, loose), "mwe_only": (phrases, loose), "single_token_only": (singles,)}[self.mode]
        return [(*x, key) for rows in found for x in rows if (key := query_key(x[5]))]

    @staticmethod
    def _anchor(c: Caption, i: int, usable: set[int], steps: int, b) -> bool:
        """Heads are followed from conjunct to conjunct, at most once round the chunk, up to a modifier."""
        for _ in range(steps):
            if i not in usable:
                return False
            if c.dep[i] in b.ATTRIBUTE_DEPS:
                return True
            if c.dep[i] != "conj" or c.head_i[i] is None or c.head_i[i] == i:
                return False
            i = c.head_i[i]
        return False


def candidates(annotated: DataFrame, spans: Candidates) -> DataFrame:
    """caption_id and the columns of a candidate: a row for each."""
    schema = StructType.fromDDL(f"caption_id string, {_CANDIDATE}")
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def run(batches):
        for batch in batches:
            rows = [(name, *x) for name, c in captions(batch) for x in spans(c)]
            cells = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(cells, kinds, strict=True)], names=schema.names)

    return columns(annotated).mapInArrow(run, schema)


def graphs(annotated: DataFrame, graph: Graph) -> DataFrame:
    """caption_id, mentions[], edges[]: a row for each caption."""
    schema = StructType.fromDDL(f"caption_id string, mentions {_struct(RAW_MENTION)}, edges {_struct(RAW_EDGE)}")
    kinds = [to_arrow_type(schema[n].dataType) for n in ("mentions", "edges")]

    def run(batches):
        for batch in batches:
            names, found = [], []
            for name, c in captions(batch):
                names.append(name)
                found.append(graph(c))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(_array([f[k] for f in found], kind) for k, kind in enumerate(kinds))], names=["caption_id", "mentions", "edges"])

    return columns(annotated).mapInArrow(run, schema)
