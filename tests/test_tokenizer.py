"""The rule tokenizer against tokens written by hand, and its short cuts against the rounds."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import tokenizer

CASES = {
    "I'm sure they don't know; you'll've cannot it's James's dog.": "I|'m|sure|they|do|n't|know|;|you|'ll|'ve|can|not|it|'s|James|'s|dog|.",
    "Dr. Smith's U.S. trip (10km, $5.50) at 8am... see http://x.org/a?b=c!": "Dr.|Smith|'s|U.S.|trip|(|10|km|,|$|5.50|)|at|8|am|...|see|http://x.org/a?b=c|!",
    'ok. (He said "no.") well-known 3-4 a,b': 'ok|.|(|He|said|"|no|.|"|)|well|-|known|3|-|4|a|,|b',
    "x@y.com, 192.168.0.1:80 50%; 20°C. and/or e.g. :) <3": "x@y.com|,|192.168.0.1:80|50|%|;|20°C|.|and/or|e.g.|:)|<3",
    "gonna dont ill Its we’re let's mustn't've": "gon|na|do|nt|ill|Its|we|’re|let|'s|must|n't|'ve",
    "a-b-c/d e:f 1+2 mother-in-law end.Next": "a|-|b|-|c|/|d|e|:|f|1|+|2|mother|-|in|-|law|end|.|Next",
    "the&&& of%%% A$$$ US$5 +7 (((a))) 5$ Mr.": "the|&|&|&|of%%%|A$|$|$|US$|5|+7|(|(|(|a|)|)|)|5|$|Mr.",
    "two  blanks\n\nand lines ": "two| |blanks|\n\n|and|lines",
    "  first": "  |first",
    "": "",
}


def test_literal_expectations(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "caption_id int, caption string")
    rows = df.select("caption", F.array_join(tokenizer.text_tokens(F.col("caption")), "|").alias("t")).collect()
    assert {r["caption"]: r["t"] for r in rows} == CASES


def test_tokens_give_the_text_back(spark):
    df = spark.createDataFrame([*((i, t) for i, t in enumerate(CASES)), (50, None), (51, " \t "), (52, "x" * 5000 + "." * 3000 + ("a." * 700))], "caption_id int, caption string")
    texts = {r["caption_id"]: r["caption"] or "" for r in df.collect()}
    got = {}
    for r in tokenizer.rule_tokens(df).orderBy("caption_id", "i").collect():
        text = texts[r["caption_id"]]
        assert text[r["char_start"] : r["char_end"]] == r["text"] and r["i"] == len(got.setdefault(r["caption_id"], []))
        got[r["caption_id"]].append(r["text"] + r["whitespace"])
    assert {k: "".join(v) for k, v in got.items()} == {k: v for k, v in texts.items() if v}
    assert tokenizer.rule_tokens(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_short_cuts_equal_the_rounds(spark, seed):
    rng = random.Random(seed)
    parts = ["don't", "dont", "I'm", "ill", "Mr", "U.S", "km", "10", "A", "a", "word", "ÑANDÚ", "ß", "xD", "8", "co", "vs", *"...,,;:!?&#*\"“”{}()[]'’$%+-–—/<>=°😀|@"]
    chunks = [(("".join(rng.choice(parts) for _ in range(rng.randint(1, 5)))),) for _ in range(4000)]
    df = spark.createDataFrame(chunks, "c string").distinct()
    c = F.col("c")
    both = df.select("c", tokenizer.chunk_tokens(c).alias("a"), tokenizer.folded_tokens(c).alias("b")).where("a <> b")
    assert both.collect() == []


def test_sentences(spark):
    text = 'One. "Two two." (Three?) four... five'
    tokens = tokenizer.rule_tokens(spark.createDataFrame([("k", text)], "caption_id string, caption string"))
    rows = tokenizer.sentence_spans(tokens).orderBy("sentence").collect()
    found = [text[r["char_start"] : r["char_end"]] for r in rows]
    assert found == ['One. "', 'Two two."', "(Three?)", "four...", "five"]  # an opening quote cannot be told from a closing one, and stays with what has ended


def test_both_ways_to_sentences_agree(spark):
    texts = [*CASES, 'One. "Two two." (Three?) four... five', '") . ! x .', "...", '"', "a. b. c", ".)\n\n(.", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "caption_id int, caption string")
    rows = lambda d: sorted(tuple(r) for r in d.select("caption_id", "sentence", "token_start", "token_end").collect())
    assert rows(tokenizer.text_sentences(df)) == rows(tokenizer.sentence_spans(tokenizer.rule_tokens(df)))


def test_stage_two_and_three_records(spark):
    from tessera.operators import tokens
    from tessera.schema import ANNOTATED

    text = 'A "big red" hot-air balloon. It flies!'
    rows = [("a", text), ("b", None), ("c", ""), ("d", "plain")]
    df = spark.createDataFrame(rows, "caption_id string, caption string")
    got = {r["caption_id"]: r for r in tokens.preprocess(df).collect()}
    assert [t["text"] for t in got["a"]["tokens"]] == ["A", '"big red"', "hot-air", "balloon", ".", "It", "flies", "!"]
    assert [(s["kind"], s["rule_id"], s["text"], s["token_start"], s["token_end"]) for s in got["a"]["protected_spans"]] == [("quote", "R3", '"big red"', 1, 2), ("hyphen_word", "R5", "hot-air", 2, 3)]
    assert {k: r["rule_ids"] for k, r in got.items()} == {"a": ["R2", "R3", "R5"], "b": ["R2"], "c": ["R2"], "d": ["R2"]}
    assert got["b"]["tokens"] is None and got["d"]["protected_spans"] is None
    cells = [(t["i"], t["text"], "", "", "", "", "", 0, "", t["char_start"], t["char_end"], t["whitespace"]) for t in got["a"]["tokens"]]
    annotated = spark.createDataFrame([("a", text, "sentence", cells, [], []), ("n", "", "sentence", [], [], [])], ANNOTATED)
    spans = spark.createDataFrame([("a", "quote")], "caption_id string, kind string")
    done = {r["caption_id"]: r for r in tokens.stage3_records(annotated, spans).collect()}
    assert [(s["text"], s["token_start"], s["token_end"]) for s in done["a"]["sentences"]] == [('A "big red" hot-air balloon.', 0, 5), ("It flies!", 5, 8)]
    assert done["a"]["rule_ids"] == ["R2", "R3", "R6", "R8", "R9", "R10", "R11"] and done["n"]["sentences"] is None
