"""Queries of the rule tokenizer, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shape, tokenizer, tokens
from ..operators.tokenizer import _BARE, _CUT, _ENDS, _FIXED, _HYPHEN, _ICON, _WHOLE, _WORDS, ADDRESS, CURRENCY, FIXED, MOST, PUNCTUATION, QUOTES, UNITS, _any, _class
from . import adapters
from .queries import query

_SPACE = "\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"


def _sql(pattern: str) -> str:
    """A pattern as SQL text, in the other engine's syntax."""
    return "'" + pattern.replace(_ICON, "[\\x{a6}\\x{a9}\\x{ae}\\x{482}\\x{2100}-\\x{214f}\\x{2195}-\\x{23ff}\\x{2400}-\\x{27bf}\\x{1f000}-\\x{1faff}]").replace("\\u00a1", "\\x{a1}").replace("\\uffff", "\\x{ffff}").replace("'", "''") + "'"


def _is_fixed(x: str) -> str:
    plain = f"regexp_matches({x}, '^\\p{{L}}+$')"
    return f"(length({x}) <= {_FIXED} AND (({plain} AND regexp_matches({x}, {_sql(_BARE)}) AND NOT regexp_matches({x}, {_sql(_WORDS)})) OR (NOT {plain} AND (regexp_matches({x}, {_sql(_WHOLE)}) OR regexp_matches({x}, {_sql(_CUT)})))))"


def _fixed(x: str) -> str:
    groups = lambda p: "[" + ", ".join(f"regexp_extract({x}, {_sql(p)}, {i + 1})" for i in range(p.count("(") - p.count("(?"))) + "]"
    cases = " ".join(f"WHEN regexp_matches({x}, {_sql(p)}) THEN list_filter({groups(p)}, lambda y: y <> '')" for p in FIXED)
    return f"CASE WHEN regexp_matches({x}, {_sql(_WHOLE)}) OR regexp_matches({x}, {_sql(_WORDS)}) THEN [{x}] {cases} ELSE [{x}] END"


def _infixed(x: str) -> str:
    """Cut at infixes; where the signs' neighbours overlap, the second turn finds the rest."""
    rules = [
        f"([0-9])([+\\-*^])([0-9-])", f"([\\p{{Ll}}{_class(QUOTES)}])(\\.)([\\p{{Lu}}{_class(QUOTES)}])", "(\\p{L})(,)(\\p{L})", f"(\\p{{L}})({_HYPHEN})(\\p{{L}})", "([\\p{L}0-9])([:<>=/])(\\p{L})",
    ]
    out = f"regexp_replace({x}, {_sql(f'([^.])(\\.\\.+|…|{_ICON})')}, '\\1\ufdd0\\2\ufdd0', 'g')"
    for rule in rules:
        for _ in range(2):
            out = f"regexp_replace({out}, {_sql(rule)}, '\\1\ufdd0\\2\ufdd0\\3', 'g')"
    return f"list_filter(string_split({out}, '\ufdd0'), lambda y: y <> '')"


_PREFIX = f"^(?:{_ENDS}|US\\$|[CA]\\$|[{_class(CURRENCY)}]|[§%=—–]|\\+(?:[^0-9]|$))"
#: Tokens of documents in SQL: table token(doc_id, i, text), by rounds over the distinct chunks.
TOKEN_SQL = f"""
piece AS (SELECT doc_id, generate_subscripts(l, 1) AS p, unnest(l) AS piece FROM (SELECT doc_id, regexp_extract_all(text, '[^{_SPACE}]+ ?|[{_SPACE}]+') AS l FROM documents)),
chunk AS (SELECT DISTINCT regexp_replace(piece, ' $', '') AS chunk FROM piece WHERE NOT regexp_matches(piece, '^[{_SPACE}]+$')),
r AS (
  SELECT chunk, cast([] AS VARCHAR[]) AS b, chunk AS core, cast([] AS VARCHAR[]) AS a, false AS done FROM chunk
  UNION ALL
  SELECT chunk,
    CASE WHEN stop OR pfx = '' OR (NOT bare_fixed AND short_fixed AND sfx <> '') THEN b ELSE list_append(b, pfx) END,
    CASE WHEN stop THEN core WHEN pfx <> '' AND bare_fixed THEN bare WHEN sfx <> '' AND short_fixed THEN short
         ELSE substr(bare, 1, length(bare) - length(sfx)) END,
    CASE WHEN stop OR sfx = '' OR (pfx <> '' AND bare_fixed) THEN a ELSE list_prepend(sfx, a) END,
    stop OR (pfx <> '' AND bare_fixed) OR (sfx <> '' AND short_fixed)
  FROM (
    SELECT *, core = '' OR {_is_fixed("core")} OR (pfx = '' AND sfx = '') AS stop, {_is_fixed("bare")} AS bare_fixed, {_is_fixed("short")} AS short_fixed
    FROM (SELECT *, substr(core, 1, length(core) - length(sfx)) AS short
      FROM (SELECT *, CASE WHEN length(s1) >= length(s2) AND length(s1) >= length(s3) THEN s1 WHEN length(s2) >= length(s3) THEN s2 ELSE s3 END AS sfx
        FROM (SELECT *, regexp_extract(bare, {_sql(f"(?:{_ENDS}|['’][sS]|[—–])$")}) AS s1, regexp_extract(bare, {_sql(f"[0-9](US\\$|[CA]\\$|[{_class(CURRENCY)}]|{_any(UNITS)}|\\+)$")}, 1) AS s2,
                     regexp_extract(bare, {_sql(f"(?:°[FfCcKk]|[0-9\\p{{Ll}}%²\\-+{_class(PUNCTUATION + QUOTES)}]|\\p{{Lu}}\\p{{Lu}})(\\.)$")}, 1) AS s3
          FROM (SELECT *, substr(core, length(pfx) + 1) AS bare
            FROM (SELECT *, CASE WHEN starts_with(core, '+') THEN CASE WHEN regexp_matches(core, '^\\+[0-9]') THEN '' ELSE '+' END ELSE regexp_extract(core, {_sql(_PREFIX)}) END AS pfx FROM r WHERE NOT done))))))),
cut AS (
  SELECT chunk, list_concat(b, CASE WHEN core = '' THEN [] WHEN {_is_fixed("core")} THEN {_fixed("core")}
                                    WHEN length(core) <= {MOST} AND regexp_matches(core, {_sql(ADDRESS)}) THEN [core] ELSE {_infixed("core")} END, a) AS tokens
  FROM r WHERE done),
tokens AS (SELECT doc_id, p, coalesce(tokens, [piece]) AS tokens, tokens IS NOT NULL AND piece LIKE '% ' AS tied FROM piece LEFT JOIN cut ON chunk = regexp_replace(piece, ' $', '') AND NOT regexp_matches(piece, '^[{_SPACE}]+$')),
token AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p, k) - 1 AS i, text, k = last AND tied AS ws
          FROM (SELECT doc_id, p, tied, len(tokens) AS last, generate_subscripts(tokens, 1) AS k, unnest(tokens) AS text FROM tokens))"""


@query(
    "rule_tokens",
    f"WITH RECURSIVE {TOKEN_SQL} SELECT doc_id, count(i) AS n_tokens, coalesce(sum(length(token.text)), 0)::BIGINT AS n_chars, md5(coalesce(string_agg(token.text, chr(31) ORDER BY i), '')) AS digest FROM documents LEFT JOIN token USING (doc_id) GROUP BY doc_id",
)
def rule_tokens(spark, sf_dir):
    docs = adapters.table(spark, sf_dir, "documents").select("doc_id", F.coalesce(tokenizer.text_tokens(F.coalesce("text", F.lit(""))), F.array()).alias("t"))
    joined = F.array_join("t", "\x1f")
    # the joined text holds a sign between every two tokens
    n = F.size("t").cast("long")
    return docs.select("doc_id", n.alias("n_tokens"), (F.length(joined) - F.greatest(n - 1, F.lit(0))).cast("long").alias("n_chars"), F.md5(joined.cast("binary")).alias("digest"))


@query(
    "rule_sentences",
    f"""WITH RECURSIVE {TOKEN_SQL},
f AS (SELECT *, regexp_matches(text, '^(?:[.!?。？！।]|\\.\\.+|…)$') AS e, regexp_matches(text, {_sql(f"^[{_class(QUOTES)})\\]}}]$")}) AS c FROM token),
t AS (SELECT *, coalesce(last_value(CASE WHEN c THEN NULL ELSE e END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i), false) AS tail FROM f),
g AS (SELECT *, lag(tail) OVER (PARTITION BY doc_id ORDER BY i) AND NOT tail AS begins FROM t),
s AS (SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS sentence FROM g)
SELECT doc_id, sentence::INTEGER AS sentence, min(i)::INTEGER AS token_start, (max(i) + 1)::INTEGER AS token_end FROM s GROUP BY doc_id, sentence""",
)
def rule_sentences(spark, sf_dir):
    """The sentences of all documents as ranges of tokens."""
    return tokenizer.text_sentences(adapters.table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("caption_id", "doc_id")


@query(
    "stage2_records",
    f"""WITH RECURSIVE {TOKEN_SQL},
s AS (SELECT * FROM token WHERE doc_id % 10 <> 0),
q AS (SELECT doc_id, i AS a, lead(i) OVER w + 1 AS e, row_number() OVER w % 2 = 1 AS opens FROM s WHERE text = '"' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
quote AS (SELECT doc_id, a, e FROM q WHERE opens AND e IS NOT NULL),
f AS (SELECT *, regexp_matches(text, '^[\\p{{L}}\\p{{N}}]+$') AND regexp_matches(text, '\\p{{L}}') AS part FROM s),
t AS (SELECT *, lag(text) OVER w = '-' AND NOT lag(ws) OVER w AND lag(part, 2) OVER w AND NOT lag(ws, 2) OVER w AS tied FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
r2 AS (SELECT *, sum(CASE WHEN coalesce(tied, false) THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM t WHERE part),
word AS (SELECT doc_id, min(i) AS a, max(i) + 1 AS e FROM r2 GROUP BY doc_id, run HAVING count(*) >= 2 AND max(length(text)) >= 2),
free AS (SELECT * FROM word w WHERE NOT EXISTS (SELECT 1 FROM quote q WHERE q.doc_id = w.doc_id AND w.a < q.e AND q.a < w.e)),
n AS (SELECT doc_id, count(*) AS quotes, sum(e - a - 1) AS gone FROM quote GROUP BY 1), m AS (SELECT doc_id, count(*) AS words, sum(e - a - 1) AS gone FROM free GROUP BY 1),
c AS (SELECT doc_id, count(*) AS k FROM s GROUP BY 1)
SELECT cast(d.doc_id AS VARCHAR) AS caption_id, (coalesce(k, 0) - coalesce(n.gone, 0) - coalesce(m.gone, 0))::INTEGER AS n_tokens, coalesce(quotes, 0)::INTEGER AS n_quotes, coalesce(words, 0)::INTEGER AS n_hyphen_words,
       'R2' || CASE WHEN quotes > 0 THEN '|R3' ELSE '' END || CASE WHEN words > 0 THEN '|R5' ELSE '' END AS rule_ids
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id) WHERE d.doc_id % 10 <> 0""",
)
def stage2_records(spark, sf_dir):
    """The second stage over all sentences: tokens by rules, quotes and hyphen words made one."""
    sentences, _ = shape.split(shape.route(adapters.captions(spark, sf_dir)))
    rows = tokens.preprocess(sentences)
    of = lambda kind: F.coalesce(F.size(F.filter("protected_spans", lambda s: s.kind == kind)), F.lit(0))
    count = lambda c: F.greatest(c, F.lit(0))  # noqa: E731 - the size of null is -1
    return rows.select("caption_id", count(F.size("tokens")).alias("n_tokens"), count(of("quote")).alias("n_quotes"), count(of("hyphen_word")).alias("n_hyphen_words"), F.array_join("rule_ids", "|").alias("rule_ids"))
