"""Text normalisation as column expressions. All of it runs inside the JVM but ``surface_key``, which needs NFKD."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space, and the four separators that Java's class leaves out.
SPACES = r"(?U)[\s\x1c-\x1f]+"
#: Runs of what separates the words of a phrase.
SEPARATORS = r"(?U)[\s\x1c-\x1f_\-]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_c(col), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normalize_display(col: Column | str) -> Column:
    """White space collapsed, case kept."""
    return F.trim(F.regexp_replace(_c(col), SPACES, " "))


def normalize_query(col: Column | str) -> Column:
    """Lower case, white space collapsed."""
    return normalize_display(F.lower(_c(col)))


def lexicon_key(col: Column | str) -> Column:
    """Stripped and lower case; inner spaces are kept."""
    return F.lower(strip(col))


def separator_key(col: Column | str) -> Column:
    """Lower case, runs of spaces, underscores and hyphens made one space."""
    return F.trim(F.regexp_replace(F.lower(_c(col)), SEPARATORS, " "))


def separator_variants(col: Column | str) -> Column:
    """The phrase with spaces, hyphens and underscores between its words; one entry for a single word, none for none."""
    words = F.filter(F.split(separator_key(col), " "), lambda w: w != "")
    return F.filter(F.array_distinct(F.array(*(F.array_join(words, x) for x in (" ", "-", "_")))), lambda v: v != "")


def surface_variant_keys(col: Column | str) -> Column:
    """Normalised, separated, joined and underscored forms, in this order, without repeats."""
    spaced = separator_key(col)
    forms = F.array(normalize_query(col), spaced, F.replace(spaced, F.lit(" "), F.lit("")), F.replace(spaced, F.lit(" "), F.lit("_")))
    return F.filter(F.array_distinct(forms), lambda v: v != "")


def lookup_queries(col: Column | str) -> Column:
    """Struct array (kind, query) to look up a surface: exact, separator, joined; repeats of an earlier query are left out."""
    exact, spaced = normalize_query(col), separator_key(col)
    joined = F.replace(spaced, F.lit(" "), F.lit(""))
    each = F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("query")) for k, v in (("exact", exact), ("separator", spaced), ("joined", joined))))
    first = F.array(exact, spaced, joined)
    return F.filter(each, lambda x, i: (x.query != "") & (F.array_position(first, x.query) == i + 1))


def lemma_key(col: Column | str) -> Column:
    """Spaces and hyphens as underscores, lower case."""
    return F.translate(normalize_query(col), " -", "__")


def fold_punctuation(col: Column | str) -> Column:
    """Typographic quotes and dashes as ASCII."""
    return F.translate(_c(col), "‘’‛ʼ“”‐‑‒–—−", "''''\"\"------")


def tighten(col: Column | str) -> Column:
    """No spaces around hyphens and apostrophes."""
    return F.regexp_replace(_c(col), r"(?U)\s*([-'])\s*", "$1")


def display_surface(col: Column | str) -> Column:
    """Folded punctuation, tight hyphens and apostrophes, collapsed spaces; case and accents stay."""
    return normalize_display(tighten(fold_punctuation(col)))


@F.pandas_udf(T.StringType())
def _strip_accents(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)))


def surface_key(col: Column | str) -> Column:
    """``display_surface`` without accents, lower case. NFKD has no built-in function, so this one runs in Python."""
    return normalize_query(tighten(_strip_accents(fold_punctuation(col))))


def sense_key(col: Column | str) -> Column:
    """A WordNet sense key ``lemma%1:02:03:04:05`` from a sense id ``oewn-lemma__1.02.03.04.05``, '' for anything else."""
    parts = [F.regexp_extract(_c(col), r"^oewn-(.+)__(\d+)\.(\d+)\.(\d+)\.([^.]*)\.([^.]*)$", i) for i in range(1, 7)]
    return F.when(parts[0] == "", F.lit("")).otherwise(F.concat(parts[0], F.lit("%"), F.concat_ws(":", *parts[1:])))


def pipe_split(col: Column | str) -> Column:
    """The non-empty parts of a pipe-joined list; null gives an empty list."""
    return F.filter(F.split(F.coalesce(_c(col), F.lit("")), "[|]"), lambda x: x != "")


def pipe_join(col: Column | str) -> Column:
    return F.array_join(_c(col), "|")


def sorted_union(*cols: Column | str) -> Column:
    """Sorted distinct members of several arrays; null arrays and members count for nothing."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.filter(F.concat(*(F.coalesce(_c(c), empty) for c in cols)), lambda x: x.isNotNull() & (x != ""))))


def is_plural_noun(pos: Column | str, tag: Column | str, morph: Column | str) -> Column:
    return (_c(pos) == "NOUN") & ((_c(tag) == "NNS") | F.coalesce(_c(morph), F.lit("")).contains("Number=Plur"))


def text_or_lemma(text: Column | str, lemma: Column | str) -> Column:
    """Lower-case text, or the lemma where the text is blank."""
    return F.coalesce(F.nullif(lexicon_key(text), F.lit("")), F.nullif(lexicon_key(lemma), F.lit("")))


def partition_of(col: Column | str, n: int) -> Column:
    return F.pmod(F.crc32(_c(col).cast("binary")), F.lit(n))


#: Irregular English forms that the label matcher knows, singular or base form first.
IRREGULAR = {
    "child": ["children"], "foot": ["feet"], "goose": ["geese"], "man": ["men"], "mouse": ["mice"], "person": ["people"],
    "tooth": ["teeth"], "woman": ["women"], "hold": ["held"], "lie": ["lying", "lay"], "run": ["ran", "running"],
    "sit": ["sat", "sitting"], "stand": ["stood"], "take": ["took", "taken"], "wear": ["wore", "worn"], "write": ["wrote", "written"],
}


def stems(col: Column | str) -> Column:
    """Base forms that a label's last word may be an inflected form of: without a plural, past or -ing ending, and irregular ones by
    IRREGULAR; the label itself is not among them."""
    label = normalize_query(col)
    last = F.regexp_extract(label, r"([^ ]*)$", 1)
    front = F.regexp_extract(label, r"^(.*?)[^ ]*$", 1)
    cut = lambda pattern, put: F.when(last.rlike(pattern), F.regexp_replace(last, pattern, put))
    regular = [
        cut("ies$", "y"), cut("(s|x|z|ch|sh)es$", "$1"), cut("([^s])s$", "$1"), cut("ied$", "y"), cut("ed$", ""), cut("ed$", "e"), cut("ing$", ""), cut("ing$", "e"),
        cut(r"([b-df-hj-np-tv-z])\1(ed|ing)$", "$1"),
    ]
    back = {}
    for base, forms in IRREGULAR.items():
        for form in forms:
            back.setdefault(form, []).append(base)
    table = F.create_map(*(x for k, v in sorted(back.items()) for x in (F.lit(k), F.array(*map(F.lit, sorted(v))))))
    found = F.concat(F.array_compact(F.array(*regular)), F.coalesce(table[last], F.array().cast("array<string>")))
    found = F.filter(F.array_distinct(found), lambda x: (F.length(x) > 1) & (x != last))
    return F.transform(found, lambda x: F.concat(front, x))


def inflections(col: Column | str) -> Column:
    """Plural, past and -ing forms of a label's last word, the label first; irregular forms from IRREGULAR."""
    label = normalize_query(col)
    last = F.regexp_extract(label, r"([^ ]*)$", 1)
    front = F.regexp_extract(label, r"^(.*?)[^ ]*$", 1)
    doubled = F.regexp_replace(last, r"([b-df-hj-np-tv-z])$", "$1$1")
    short = last.rlike(r"^[^aeiou]*[aeiou][b-df-hj-np-tv-z]$") & ~last.rlike("[wxy]$")
    plural = F.when(last.rlike("[^aeiou]y$"), F.regexp_replace(last, "y$", "ies")).when(last.rlike("(s|x|z|ch|sh)$"), F.concat(last, F.lit("es"))).otherwise(F.concat(last, F.lit("s")))
    past = F.when(last.rlike("e$"), F.concat(last, F.lit("d"))).when(last.rlike("[^aeiou]y$"), F.regexp_replace(last, "y$", "ied")).when(short, F.concat(doubled, F.lit("ed"))).otherwise(F.concat(last, F.lit("ed")))
    going = F.when(last.rlike("[^eoy]e$"), F.regexp_replace(last, "e$", "ing")).when(short, F.concat(doubled, F.lit("ing"))).otherwise(F.concat(last, F.lit("ing")))
    table = F.create_map(*(x for k, v in sorted(IRREGULAR.items()) for x in (F.lit(k), F.array(*map(F.lit, v)))))
    odd = F.coalesce(table[last], F.array().cast("array<string>"))
    forms = F.concat(F.array(last, plural, past, going), odd)
    return F.when(last == "", F.array(label)).otherwise(F.array_distinct(F.transform(forms, lambda f: F.concat(front, f))))
