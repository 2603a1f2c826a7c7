"""Tokens come in batches of bounded size, and those that queries keep make the same spans as all."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import tokens


def test_long_captions_come_in_parts():
    batch = pa.RecordBatch.from_pydict({"caption_id": pa.array([str(i) for i in range(40)]), "caption": pa.array(["a-b " * 5000] * 39 + [None])})
    out = list(tokens._tokens(iter([batch])))
    sizes = [len(x.column(1).flatten()) for x in out]
    assert sum(sizes) == 39 * 15_000 and max(sizes) <= tokens.BATCH_TOKENS + 15_000
    assert [i for x in out for i in x.column(0).to_pylist()] == [str(i) for i in range(40)]


def test_places_and_white_space(spark):
    rows = spark.createDataFrame([(7, "x_y\u00a0\U0001f600 z"), (8, None), (9, "")], "caption_id long, caption string")
    got = [tuple(r) for r in tokens.tokenize(rows).orderBy("caption_id", "i").collect()]
    assert got == [(7, 0, "x", 0, 1, ""), (7, 1, "_", 1, 2, ""), (7, 2, "y", 2, 3, "\u00a0"), (7, 3, "\U0001f600", 4, 5, " "), (7, 4, "z", 6, 7, "")]


TEXTS = ["a-b c d e f-g-h i", "-a b-", "ab--cd ef-gh, x y z ij-kl", "ab -cd ef- gh ij-kl-", "a b c d", "- - ab-cd - ef", "ab-cd ef-gh", 'q "ab-cd" x “y z” “ “w” "', None]


@pytest.mark.parametrize("few, spans", [(tokens.near_hyphens, tokens.hyphen_spans), (tokens.quote_marks, tokens.quote_spans)])
def test_few_tokens_make_the_same_spans(spark, few, spans):
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "caption_id string, caption string")
    rows = rows.withColumn("caption", F.concat("caption", F.lit(" tail w")))
    kept, every = few(tokens.token_lists(rows)), tokens.tokenize(rows)
    assert kept.count() < every.count()
    found = lambda t: sorted(tuple(r) for r in spans(t).collect())
    assert found(kept) == found(every) != []
