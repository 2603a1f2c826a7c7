"""Alignment of two tokenizers against plain loops over tokens."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import alignment
from tessera.llm.queries import PIECES, VOCABULARY

OUT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plainly(rows):
    """What the operator returns, from token spans compared one with another."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = alignment.byte_level()

    def spans(tokens):
        at, out = 0, []
        for i, raw in tokens:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out, b"".join(raw for _, raw in tokens)

    found, pairs = [], Counter()
    for i, text in rows:
        first, second, raw = [], [], (" " + (text or "")).encode()
        if text:
            first, one = spans([(t, bytes(own[c] for c in a.id_to_token(t))) for t in a.encode(" " + text, add_special_tokens=False).ids])
            ids = b.encode(text)
            second, two = spans([(t, bytes([int(b.id_to_piece(t)[3:5], 16)]) if b.is_byte(t) else b.id_to_piece(t).replace("▁", " ").encode()) for t in ids])
            if one != raw or two != raw:
                first, second = [], []
        links, j = [], 0
        for x, p, q in first:
            while j and second[j - 1][2] > p:
                j -= 1
            while j < len(second) and second[j][1] < q:
                if second[j][2] > p:
                    links.append((x, second[j][0]))
                j += 1
        ends = sorted({q for *_, q in first} & {q for *_, q in second})
        groups, at = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(t) for t, p, q in side if p >= at and q <= end) for side in (first, second)))
            at = end
        pairs.update(links)
        found.append((i, len(first), len(second), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "", ";".join(groups)))
    best = defaultdict(int)
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    out = [(i, x, y, g, len(links), sum(pairs[p] == best[p[1]] for p in links), sum(pairs[p] for p in links), s) for i, x, y, g, links, s, _ in found]
    return sorted(out, key=str), {(i, t) for i, *_, t in found}


def result(df):
    return sorted((tuple(r[c] for c in OUT) for r in df.collect()), key=str)


def test_documents(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    df = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, texts = plainly(rows)
    assert result(alignment.align(df, pieces=PIECES, **VOCABULARY)) == want
    assert {(r["doc_id"], r["groups"]) for r in alignment.groups(df, pieces=PIECES, **VOCABULARY).collect()} == texts


def test_hard_rows_in_small_blocks(spark, edge_rows, monkeypatch):
    monkeypatch.setattr(alignment, "LINKS", 50)
    more = [(20, "<|endoftext|> <s> </s> <unk> <0x41>"), (21, "lower ▁ block"), (22, "퟿\u0000  　  tab\t\n\r\n"), (23, "👩‍👩‍👧 ñandú ﬁ é"), (24, " "), (25, "x" * 5000), (26, "日本語テキスト" * 50)]
    rows = [(i, t if t is None else t[:3000]) for i, t, *_ in edge_rows] + more
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = alignment.align(df.selectExpr("doc_id", "text", "doc_id as ids", "text as links"), pieces=PIECES, **VOCABULARY)
    assert result(got) == plainly(rows)[0]


def test_cuts_lie_where_both_end(spark):
    text = "Unbelievable ñandú, 1234"
    row = alignment.groups(spark.createDataFrame([("k", text)], "doc_id string, text string"), pieces=PIECES, **VOCABULARY).first()
    raw, cuts = (" " + text).encode(), [*row["cuts"], len((" " + text).encode())]
    assert cuts[0] == 0 and cuts == sorted(set(cuts)) and len(row["groups"].split(";")) == len(row["cuts"])
    a = alignment.Aligner.load(VOCABULARY["vocabulary"], VOCABULARY["ranks"], VOCABULARY["pattern"], PIECES)
    for group, p, q in zip(row["groups"].split(";"), cuts, cuts[1:], strict=False):
        one, two = ([int(i) for i in side.split(",")] for side in group.split("|"))
        assert b"".join(a.bytes_a[i] for i in one) == b"".join(a.bytes_b[i] for i in two) == raw[p:q]


def test_empty(edge, empty):
    assert alignment.align(empty, pieces=PIECES, **VOCABULARY).count() == 0
    assert alignment.align(edge.where("text is null"), pieces=PIECES, **VOCABULARY).where("n_a = 0 and groups_sha256 = ''").count() == 2
