import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    *(T.StructField(x, T.StringType()) for x in ("row", "id", "h", "norm", "score", "rank", "token", "rep", "position", "kept", "held_out", "row_")),
])


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, ties, repeated rows, one long text; ids and sources may be null."""
    long = " ".join(f"word{i % 977} filler{i}" for i in range(30_000))
    return [
        (1, "The quick brown fox jumps over the lazy dog", "en", "a"), (2, "the QUICK brown fox jumps over the lazy dog", "en", "a"), (3, None, "en", "a"), (4, "", None, None), (5, "   \n\t", "de", "b"),
        (6, "one two", "de", "b"), (6, "one two", "de", "b"), (None, "one two", None, "b"), (None, None, None, None), (7, long, "en", "a"), (8, long + " more", "en", "c"), (9, "ÀÉ 日本語 <|endoftext|> text", "fr", "c"), (10, "12 34 !!", "fr", "c"),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, *["x"] * (len(SCHEMA.fields) - 4)) for r in edge_rows], SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").persist()
