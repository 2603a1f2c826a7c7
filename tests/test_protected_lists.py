"""Protected spans inside token lists are those of rows of tokens, and need no exchange."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import tokenizer, tokens
from tessera.plans import queries
from tessera.plans.language import stage2_records

TEXTS = [
    None, "", " ", "plain words", '"ab-cd" ef-gh', 'x "a “b" c” d-e f-g-hh-i', "“a” “b “c” ” \"", '" “x-yy” "', "-a b-", "ab--cd ef-gh, ij-kl", "a-b c-d", "ab -cd ef- gh ij-kl-", '"', "-", "  two  blanks \"in  side\"  ",
    "\U0001f600-x\U0001f600 é-ée “q-r", 'one "two" three "four" five "six', "a \"b c\" d\t-ee-ff", "well-known (self-made) don't U.S.-based 3-4 x2-y3",
]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("by_rules", [False, True])
def test_lists_hold_what_rows_make(spark, by_rules):
    captions = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "caption_id string, caption string").coalesce(1)
    lists = tokens.protected_lists(captions, by_rules)
    rows = tokenizer.rule_tokens(captions) if by_rules else tokens.tokenize(captions)
    spans = tokens.protected_spans(rows)
    merged = tokens.merged_tokens(rows, spans)
    cells = ["caption_id", "i", "text", "char_start", "char_end", "whitespace"]
    assert _rows(lists.select("caption_id", F.inline("tokens")).select(*cells)) == _rows(merged.select(*cells)) != []
    names = ["caption_id", "char_start", "char_end", "kind", "rule_id", "text", "token_start", "token_end", "final_start", "final_end"]
    found = lists.select("caption_id", F.inline("protected_spans"))
    assert _rows(found.select(*names)) == _rows(tokens.attach(spans, merged).select(*names)) != []
    assert {r.kind for r in found.collect()} == {"quote", "hyphen_word"}


def test_batches_are_bounded(monkeypatch):
    cut = lambda text: [{"tokens": [*p.replace("-", " - ").split()], "tied": True} for p in text.split()]
    rows = [None if t is None else cut(t) for t in TEXTS]
    kind = pa.list_(pa.struct([("tokens", pa.list_(pa.string())), ("tied", pa.bool_())]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, kind)], names=["n", "pieces"])
    whole = pa.Table.from_batches(tokens._protected(tokens._piece_tokens(iter([batch]))))
    monkeypatch.setattr(tokens, "BATCH_TOKENS", 7)
    parts = list(tokens._protected(tokens._piece_tokens(iter([batch]))))
    assert len(parts) > 5 and pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()


@pytest.mark.parametrize("query", [queries.protected_spans, stage2_records])
def test_nothing_is_exchanged(spark, sf, query):
    assert "Exchange" not in query(spark, sf)._jdf.queryExecution().executedPlan().toString()
