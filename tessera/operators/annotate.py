"""Annotation of captions by a model that the caller brings.

The engine ships no language model. An annotator is any object with ``annotate(texts) -> list of lists of token dicts``; it is built
once in each Python worker by a factory, and fed captions in batches of similar length."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ANNOTATED

#: Columns of what an annotator returns for a caption.
_FIELDS = [x.split(" ")[0] for x in ("caption_id", "caption", "caption_shape")]


class Annotator(Protocol):
    def annotate(self, texts: list[str]) -> list[dict]:
        """For each text ``tokens`` and ``noun_chunks`` as dicts of the annotated schema."""
        ...


def annotate(captions: DataFrame, factory: Callable[[], Annotator], batch: int = 256) -> DataFrame:
    """Annotated captions. Rows are sorted by length inside each partition, so that a batch holds texts of like length."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for rows in frames:
            for at in range(0, len(rows), batch):
                part = rows.iloc[at : at + batch]
                found = model.annotate(part["caption"].tolist())
                yield pd.DataFrame({**{c: part[c].tolist() for c in _FIELDS}, "tokens": [x["tokens"] for x in found], "noun_chunks": [x.get("noun_chunks", []) for x in found], "tag_segments": [x.get("tag_segments", []) for x in found]})

    return captions.select(*_FIELDS).sortWithinPartitions(F.length("caption")).mapInPandas(run, ANNOTATED)


def component_list(names: list[str]) -> list[str]:
    """Names stripped, each once, in the order given."""
    return list(dict.fromkeys(n.strip() for n in names if n.strip()))


def summary(annotated: DataFrame) -> DataFrame:
    """Captions, tokens, chunks and segments by shape."""
    return annotated.groupBy("caption_shape").agg(F.count(F.lit(1)).alias("captions"), F.sum(F.size("tokens")).alias("tokens"), F.sum(F.size("noun_chunks")).alias("noun_chunks"), F.sum(F.when(F.size("tag_segments") > 0, F.size("tag_segments")).otherwise(0)).alias("segments"))
