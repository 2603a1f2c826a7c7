"""Report views, the index from their rows to captions, and the query interface over both."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import pipe_join, sorted_union
from ..schema import require
from .fold import dimension

# The views with their columns.
_TAIL = ("count", "caption_count", "example_caption_ids")
VIEWS: dict[str, tuple[str, ...]] = {
    "objects": ("canonical_object", "object_raw_surfaces", "object_parent_concepts", *_TAIL),
    "attributes": ("canonical_attribute", "attribute_kind", "attribute_raw_surfaces", *_TAIL),
    "actions": ("canonical_action", "action_raw_surfaces", *_TAIL),
    "relations": ("source_object", "source_object_raw_surfaces", "source_parent_concepts", "relation", "target_object", "target_object_raw_surfaces", "target_parent_concepts", *_TAIL),
    "object_cooccurrence": ("source_object", "source_object_raw_surfaces", "source_parent_concepts", "target_object", "target_object_raw_surfaces", "target_parent_concepts", *_TAIL),
    "attribute_object_pairs": ("object", "object_raw_surfaces", "object_parent_concepts", "attribute", "attribute_kind", "attribute_raw_surfaces", *_TAIL),
    "patient_action_pairs": ("patient_object", "patient_object_raw_surfaces", "patient_parent_concepts", "action", "action_raw_surfaces", *_TAIL),
    "agent_action_pairs": ("agent_object", "agent_object_raw_surfaces", "agent_parent_concepts", "action", "action_raw_surfaces", *_TAIL),
    "patient_action_agent_triples": ("patient_object", "patient_object_raw_surfaces", "action", "action_raw_surfaces", "agent_object", "agent_object_raw_surfaces", *_TAIL),
    "relation_components": ("relation", "component_index", "component", *_TAIL),
}
# The columns that name a row of a view.
KEYS: dict[str, tuple[str, ...]] = {
    "objects": ("canonical_object",), "attributes": ("canonical_attribute", "attribute_kind"), "actions": ("canonical_action",),
    "relations": ("source_object", "relation", "target_object"), "object_cooccurrence": ("source_object", "target_object"),
    "attribute_object_pairs": ("object", "attribute", "attribute_kind"), "patient_action_pairs": ("patient_object", "action"),
    "agent_action_pairs": ("agent_object", "action"), "patient_action_agent_triples": ("patient_object", "action", "agent_object"),
    "relation_components": ("relation", "component_index", "component"),
}
DEFAULT_SORT, DEFAULT_DIR = "count", "desc"
PAGE, PAGES = (10, 200), (10, 100)


def view_catalog() -> list[tuple[str, str, str, str]]:
    """name, default sort, default direction, columns."""
    return [(name, DEFAULT_SORT, DEFAULT_DIR, "|".join(columns)) for name, columns in VIEWS.items()]


def _surfaces(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Raw surfaces of a label over all its rows."""
    return table.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("raw_variants")))).alias("surfaces"))


def _with_surfaces(rows: DataFrame, label: str, names: DataFrame, out: str) -> DataFrame:
    n = names.select(F.col(names.columns[0]).alias("_label"), F.col("surfaces").alias(out))
    return rows.join(n, F.col(label) == F.col("_label"), "left").drop("_label")


def numbered(view: DataFrame, name: str, cut=lambda df: df.checkpoint()) -> DataFrame:
    """Rows with _row_id from 1, in the order of count and key. Numbers are given from a global sort: the place in its partition
    plus the rows of the partitions before, so no task sees all rows."""
    rows = view.select(*(pipe_join(c).alias(c) if view.schema[c].dataType.typeName() == "array" else F.col(c) for c in VIEWS[name]))
    at = F.monotonically_increasing_id()
    rows = cut(rows.orderBy(F.desc("count"), *KEYS[name]).withColumn("_at", at))
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    out = rows.join(F.broadcast(sizes), part == F.col("_part"))
    return out.select((F.col("_before") + F.col("_at") - F.shiftleft(part, 33) + 1).alias("_row_id"), *VIEWS[name])


def views(tables: dict[str, DataFrame], triples: DataFrame) -> dict[str, DataFrame]:
    """All views from the count tables, unnumbered."""
    objects = _surfaces(tables["object_counts"], ("object",))
    verbs = _surfaces(tables["action_counts"], ("action",))
    words = _surfaces(tables["attribute_counts"], ("attribute",))
    o, a, v = tables["object_counts"], tables["attribute_counts"], tables["action_counts"]
    out = {
        "objects": o.select(F.col("object").alias("canonical_object"), F.col("raw_variants").alias("object_raw_surfaces"), F.col("parent_concepts").alias("object_parent_concepts"), *_TAIL),
        "attributes": a.select(F.col("attribute").alias("canonical_attribute"), "attribute_kind", F.col("raw_variants").alias("attribute_raw_surfaces"), *_TAIL),
        "actions": v.select(F.col("action").alias("canonical_action"), F.col("raw_variants").alias("action_raw_surfaces"), *_TAIL),
        "relation_components": tables["relation_component_counts"].select(*VIEWS["relation_components"]),
    }
    r = tables["relation_triple_counts"].withColumnsRenamed({"source": "source_object", "target": "target_object"})
    for name, rows in (("relations", r), ("object_cooccurrence", tables["object_cooccurrence_pair_counts"])):
        for end in ("source", "target"):
            rows = _with_surfaces(rows, f"{end}_object", objects, f"{end}_object_raw_surfaces")
        out[name] = rows.select(*VIEWS[name])
    pairs = _with_surfaces(tables["object_attribute_pair_counts"], "object", objects, "object_raw_surfaces")
    out["attribute_object_pairs"] = _with_surfaces(pairs, "attribute", words, "attribute_raw_surfaces").select(*VIEWS["attribute_object_pairs"])
    roles = tables["agent_patient_pair_counts"]
    for role in ("patient", "agent"):
        rows = roles.where(F.col("role") == role).select(F.col("target").alias(f"{role}_object"), F.col("target_parent_concepts").alias(f"{role}_parent_concepts"), "action", *_TAIL)
        rows = _with_surfaces(_with_surfaces(rows, f"{role}_object", objects, f"{role}_object_raw_surfaces"), "action", verbs, "action_raw_surfaces")
        out[f"{role}_action_pairs"] = rows.select(*VIEWS[f"{role}_action_pairs"])
    t = triples.withColumnsRenamed({"patient": "patient_object", "agent": "agent_object"})
    for label, names, col in (("patient_object", objects, "patient_object_raw_surfaces"), ("action", verbs, "action_raw_surfaces"), ("agent_object", objects, "agent_object_raw_surfaces")):
        t = _with_surfaces(t, label, names, col)
    out["patient_action_agent_triples"] = t.select(*VIEWS["patient_action_agent_triples"])
    return out


def merged_kinds(table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the same label as attribute and as quantity made one, their kinds joined by a pipe (sorted)."""
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    return table.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("attribute_kind")), "|").alias("attribute_kind"), F.sum("count").alias("count"), union("raw_variants").alias("raw_variants"))


# --- queries


def where(view: DataFrame, q: str = "", filters: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows in which some text column contains ``q`` (any case; no wildcards), and whose filtered columns hold a listed value.
    Columns that the view does not have are ignored."""
    text = [c for c, kind in view.dtypes if kind == "string"]
    out = view
    if q and text:
        out = out.where(reduce(lambda a, b: a | b, (F.coalesce(F.contains(F.lower(F.col(c)), F.lit(q.lower())), F.lit(False)) for c in text)))
    for c, values in (filters or {}).items():
        if c in view.columns and values:
            out = out.where(F.col(c).cast("string").isin(values))
    return out


def _clamp(n: int, to: tuple[int, int]) -> int:
    return min(max(n, to[0]), to[1])


def rows(view: DataFrame, q: str = "", filters: dict[str, list[str]] | None = None, sort: str = DEFAULT_SORT, direction: str = DEFAULT_DIR, page: int = 1, page_size: int = 20) -> DataFrame:
    """One page of a view, with ``total`` matching rows on each. An unknown sort column means the default; ties go by _row_id."""
    size = _clamp(page_size, PAGE)
    by = sort if sort in view.columns else DEFAULT_SORT
    key = F.col(by).asc() if direction == "asc" else F.col(by).desc()
    found = where(view, q, filters)
    return found.orderBy(key, "_row_id").offset((max(page, 1) - 1) * size).limit(size).withColumn("total", F.lit(found.count()))


def filter_values(view: DataFrame, column: str, q: str = "", page: int = 1, page_size: int = 50) -> DataFrame:
    """Distinct values of a column with their rows and counts, the most counted first."""
    size = _clamp(page_size, PAGES)
    value = F.col(column).cast("string")
    found = view.where(value.isNotNull() & (value != ""))
    if q:
        found = found.where(F.contains(F.lower(value), F.lit(q.lower())))
    out = found.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("row_count"), F.sum("count").alias("total"))
    return out.orderBy(F.desc("total"), "value").offset((max(page, 1) - 1) * size).limit(size)


def row_captions(index: DataFrame, captions: DataFrame, view_name: str, row_id: int, page: int = 1, page_size: int = 50, view: DataFrame | None = None) -> DataFrame:
    """Captions behind a row, by id. The index is partitioned by view, so only that view's files are read. Where it has none for the
    row, and the ``view`` is given, the row's own examples stand in."""
    size = _clamp(page_size, PAGE)
    ids = index.where((F.col("view_name") == view_name) & (F.col("row_id") == row_id)).select("caption_id").distinct()
    if view is not None:
        own = view.where(F.col("_row_id") == row_id).select(F.explode(F.split("example_caption_ids", "[|]")).alias("caption_id"), F.lit(1).alias("_by"))
        both = ids.withColumn("_by", F.lit(0)).unionByName(own)
        ids = both.withColumn("_first", F.min("_by").over(Window.partitionBy(F.lit(row_id)))).where("_by = _first and caption_id <> ''").select("caption_id").distinct()  # the captions of one row
    some = ids.orderBy("caption_id").offset((max(page, 1) - 1) * size).limit(size)
    return captions.join(F.broadcast(some), "caption_id", "left_semi").orderBy("caption_id")  # a page of ids


def captions_in_order(captions: DataFrame, ids: list[str]) -> DataFrame:
    """The captions asked for, in the order asked for."""
    wanted = F.array(*(F.lit(i) for i in ids)) if ids else F.array().cast("array<string>")
    return captions.where(F.col("caption_id").isin(ids)).orderBy(F.array_position(wanted, F.col("caption_id")))


# --- the index

_RENAMED = {
    "objects": ("entity_exists", {"canonical_object": "object"}),
    "attributes": ("attribute_exists", {"canonical_attribute": "attribute", "attribute_kind": "attribute_kind"}),
    "actions": ("action_event", {"canonical_action": "action"}),
    "relations": ("relation", {"source_object": "source", "relation": "relation", "target_object": "target"}),
    "object_cooccurrence": ("object_pair_in_caption", {"source_object": "source_object", "target_object": "target_object"}),
    "attribute_object_pairs": ("has_attribute", {"object": "object", "attribute": "attribute", "attribute_kind": "attribute_kind"}),
    "patient_action_agent_triples": ("triple", {"patient_object": "patient", "action": "action", "agent_object": "agent"}),
    "relation_components": ("relation_component", {"relation": "relation", "component_index": "component_index", "component": "component"}),
}


def caption_index(facts: dict[str, DataFrame], numbered_views: dict[str, DataFrame]) -> DataFrame:
    """view_name, row_id, caption_id, each once. A row whose kinds are joined by a pipe stands for each of them. ``facts`` has the kinds of
    all_facts, and ``triple`` (counts.triple_facts) where that view is indexed; a view that is not known is an error.

    Facts that are dealt by caption are made distinct as they lie, before and after they meet their row, so the index needs no exchange."""
    each = []
    for name, view in numbered_views.items():
        if name in ("patient_action_pairs", "agent_action_pairs"):
            role = name.split("_")[0]
            found = facts["event_role"].where(F.col("role") == role).select("caption_id", F.col("target").alias(f"{role}_object"), "action")
        elif name in _RENAMED:
            kind, columns = _RENAMED[name]
            found = facts[kind].select("caption_id", *(F.col(c).alias(k) for k, c in columns.items()))
        else:
            raise ValueError(f"no such view: {name}")
        keys = list(KEYS[name])
        named = view.select(F.col("_row_id").alias("row_id"), *keys)
        if "attribute_kind" in keys:
            named = named.withColumn("attribute_kind", F.explode(F.split("attribute_kind", "[|]")))
        rows = found.distinct().join(dimension(_unambiguous(named, keys, name)), keys).select("row_id", "caption_id")
        if "attribute_kind" in keys:  # a row of two kinds may meet a caption by each
            rows = rows.distinct()
        each.append(rows.select(F.lit(name).alias("view_name"), "row_id", "caption_id"))
    return reduce(DataFrame.unionByName, each)


def _unambiguous(named: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows (row_id, keys) of a view; a key that two rows have fails the job, since an index over it would lead to both."""
    one = named.groupBy(*keys).agg(F.min("row_id").alias("row_id"), F.max("row_id").alias("_other"))
    said = F.concat(F.lit(f"two rows of {name} have the key "), F.to_json(F.struct(*keys)))
    return one.withColumn("row_id", require(F.col("row_id") == F.col("_other"), said, F.col("row_id"))).drop("_other")


def index_mismatches(view: DataFrame, index: DataFrame, view_name: str) -> DataFrame:
    """Rows whose caption_count is not the number of captions that the index has for them."""
    there = index.where(F.col("view_name") == view_name).groupBy("row_id").agg(F.count_distinct("caption_id").alias("indexed"))
    both = view.select(F.col("_row_id").alias("row_id"), "caption_count").join(there, "row_id", "left").fillna(0, ["indexed"])
    return both.where("caption_count <> indexed")


def ambiguous_keys(view: DataFrame, name: str) -> DataFrame:
    """Keys that more than one row of a view has; an index over such a view would be ambiguous."""
    return view.groupBy(*KEYS[name]).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def merge_rows(view: DataFrame, extra: DataFrame, name: str) -> DataFrame:
    """A view with further rows: counts of the same key add up, lists are united, new keys are appended."""
    lists = [c for c in VIEWS[name] if c not in (*KEYS[name], "count", "caption_count")]
    both = view.select(*VIEWS[name]).unionByName(extra.select(*VIEWS[name]))
    split = lambda c: sorted_union(F.flatten(F.collect_list(F.split(F.coalesce(c, F.lit("")), "[|]"))))
    return both.groupBy(*KEYS[name]).agg(*(pipe_join(split(F.col(c))).alias(c) for c in lists), F.sum("count").alias("count"), F.sum("caption_count").alias("caption_count")).select(*VIEWS[name])


def kind_collisions(table: DataFrame, label: Column | str = "attribute") -> DataFrame:
    """Labels that are both an attribute and a quantity."""
    return table.groupBy(label).agg(F.array_sort(F.collect_set("attribute_kind")).alias("kinds"), F.sum("count").alias("count")).where(F.size("kinds") > 1)
