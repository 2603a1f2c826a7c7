"""A rule tokenizer for English, as column expressions.

White space cuts a text into chunks. A chunk is taken apart from its ends: as long as what is left is no fixed expression
(contraction, abbreviation, time, emoticon), one prefix and one suffix are taken off in each round, until nothing comes off; then the
rest is a fixed expression, an address (URL, mail, IP), or it is cut at its infixes. A single space after a token belongs to it; any
other white space is a token of its own, so tokens and their spaces give the text back.

The rounds are a fold over as many steps as a chunk has signs (each round takes off at least one, but the last two), so all runs in the JVM
and a text needs no exchange; numbers and places of tokens come from one window over the text, which later steps on
the text's tokens share. Long runs of signs at the ends of long chunks come off at once: no fixed expression is that long.

Defined cases: null and empty texts have no tokens; chunks above MOST characters are no addresses; a chunk that holds the
noncharacter U+FDD0 is not cut at infixes; repeated ids give repeated places; other columns are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Characters and words of English tokenization.
PUNCTUATION = "…,:;!?¿؟¡()[]{}<>_#*&。？！，、；：～·।،۔؛٪"
QUOTES = "'\"”“`‘´’‚„»«「」『』（）〔〕【】《》〈〉⟦⟧"
CURRENCY = "$£€¥฿﷼₠₡₢₣₤₥₦₧₨₩₪₫₭₮₯₰₱₲₳₴₵₶₷₸₹₺₻₼₽₾₿"
UNITS = "km km² km³ m m² m³ dm dm² dm³ cm cm² cm³ mm mm² mm³ ha µm nm yd in ft kg g mg µg t lb oz m/s km/h kmh mph hPa Pa mbar mb MB kb KB gb GB tb TB T G M K %"
#: Words before 'll, 'd and their like; those that take 've, 're and 's.
SUBJECTS, HAVE, ARE, IS = "i you he she it we they", "i you we they", "you we they", "he she it"
QUESTIONS = "who what when where why how there that this these those"
#: Verbs before n't; those that also take n't've, and those that take 've.
NOT, NOT_HAVE, MODAL_HAVE = "ai are is was were have has dare", "ca could do does did had may might must need ought sha should wo would", "could might must should would"
#: Words that a contraction without its apostrophe would be.
WORDS = "ill its hell shell shed were well whore"
SINGLE = "'cause 'em 'll 'nuff doin' goin' nothin' nuthin' ol' somethin' lovin' havin' 'cos 'coz 'bout 'til 'tis 'twas ma'am o'clock 're 's 'S 'd and/or w/o a.m. p.m. e.g. i.e. vs. v.s. C++ D.C. Ph.D. E.G. I.E. O'clock Ma'am 'Cause 'Cos"
TITLES = "Adm Bros Co Corp Dr Gen Gov Inc Jr Ltd Md Messrs Mo Mont Mr Mrs Ms Prof Rep Rev Sen St Ave Mt Sr Ala Ariz Ark Calif Colo Conn Del Fla Ga Id Ia Ill Ind Kan Kans Ky La Mass Mich Minn Miss Neb Nebr Nev Okla Ore Pa Tenn Va Wash Wis Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec"
EMOTICONS = ":) :( :D :P :p ;) ;( ;D :-) :-( :-D :-P ;-) :') :'( :/ :-/ :| :-| :o :O :-o :-O :* :-* :3 :> :< :] :[ =) =( =D =| =/ =3 8) 8-) 8D XD xD xDD ^_^ ^__^ ^___^ -_- -__- o_o o_O O_o O_O o.o O.O 0_0 0.0 <3 <33 </3 (: (; (= (-: ): ;_; T_T v_v V_V >.< >:( >:o :x :X :0 :1 ಠ_ಠ (-_-) (o_o) \\o/ /o\\"

MOST = 1024
#: No fixed expression has more characters.
_FIXED = 16
_MARK = "\ufdd0"


def _class(signs: str) -> str:
    return "".join("\\" + c if c in "[](){}<>\\^$*+?.|-&#" else c for c in signs)


def _any(words: str, titled: bool = False) -> str:
    """Alternatives for the words, with a capital too if ``titled``."""
    escape = lambda w: "".join(c if c.isalnum() or c in "'’²³µ" or ord(c) > 127 else "\\" + c for c in w)
    out = []
    for w in words.split():
        first = f"[{w[0].upper()}{w[0]}]" if titled and w[0].isalpha() and w[0].upper() != w[0] else escape(w[0])
        out.append((first + escape(w[1:])).replace("'", "['’]"))
    return "|".join(sorted(out, key=len, reverse=True))


_A = "['’]?"
#: Patterns of fixed expressions; each group is a token.
FIXED = [
    f"^([Ii])({_A}m)(a)?$",
    f"^({_any(SUBJECTS, True)})({_A}ll|{_A}d)({_A}ve)?$",
    f"^({_any(HAVE, True)})({_A}ve)$",
    f"^({_any(ARE, True)})({_A}re)$",
    f"^({_any(IS, True)})({_A}s)$",
    f"^({_any(QUESTIONS, True)})({_A}s|{_A}ll|{_A}d|{_A}re|{_A}ve)$",
    f"^({_any(QUESTIONS, True)})({_A}ll|{_A}d)({_A}ve)$",
    f"^({_any(NOT + ' ' + NOT_HAVE, True)})(n{_A}t)$",
    f"^({_any(NOT_HAVE, True)})(n{_A}t)({_A}ve)$",
    f"^({_any(MODAL_HAVE, True)})({_A}ve)$",
    "^([Cc]an)(not)$",
    "^([Gg]on)(na)$",
    "^([Gg]ot)(ta)$",
    f"^([Ll]et)(['’]s)$",
    f"^([Cc]['’]m)(on)$",
    f"^([Yy]{_A})(all)$",
    f"^([Hh]ow)({_A}d)({_A}y)$",
    f"^([Nn]ot)({_A}ve)$",
    "^(1[0-2]|[1-9])([ap]\\.?m\\.?)$",
]
_WORDS = f"^(?:{_any(WORDS, True)})$"
_WHOLE = f"^(?:{_any(SINGLE)}|(?:{_any(TITLES)})\\.|[a-zäöü]\\.|{_any(EMOTICONS)})$"
#: All of them; begun with one anchor, so that a search tries the first place only.
_CUT = "^(?:" + "|".join(p[1:-1].replace("(", "(?:").replace("(?:?:", "(?:") for p in FIXED) + ")$"
#: A fixed expression of letters only, such as "dont".
_BARE = _CUT.replace(_A, "").replace("['’]", "#")  # ^(?:…)$



def _bare_words() -> set[str]:
    """What _BARE matches, word by word."""
    subjects, questions, not_, not_have = (x.split() for x in (SUBJECTS, QUESTIONS, NOT, NOT_HAVE))
    out = {"im", "ima", "cannot", "gonna", "gotta", "yall", "howdy", "notve"}
    out |= {w + e for w in subjects for e in ("ll", "d", "llve", "dve")} | {w + "ve" for w in (HAVE + " " + MODAL_HAVE).split()} | {w + "re" for w in ARE.split()} | {w + "s" for w in IS.split()}
    out |= {w + e for w in questions for e in ("s", "ll", "d", "re", "ve", "llve", "dve")} | {w + "nt" for w in (*not_, *not_have)} | {w + "ntve" for w in not_have}
    return {x for w in out - set(WORDS.split()) for x in (w, w[0].upper() + w[1:])}


#: Words that are taken for plain only after a look at the rounds; looked up in a hash set.
_UNSAFE = sorted(_bare_words() | {*TITLES.split(), "vs", "co", "US", "C", "A"})
#: Chunks that are one token, words first; a word and one sign after it; a word between signs of which no fixed expression is made.
_WORD_PIECE = "^\\p{L}+ ?$"
_ONE = "^(?:[a-z]\\.|[^\\p{So}])$"
_BEFORE = "^\\p{L}+[%$]+$"
_ENDED = "^(?:\\p{L}+[,;:!?]|\\p{L}*(?<=\\p{L}\\p{Ll})\\.)$"
_SAFE = '[,!?&#*"“”{}]'
_AROUND = f"^{_SAFE}*+\\p{{L}}+{_SAFE}*$"
#: Pieces of a text: chunks with the space that belongs to them, and other white space.
_PIECES = "(?U)[^\\s\\x1c-\\x1f]+ ?|[\\s\\x1c-\\x1f]+"
_ALL_BLANK = "(?U)^[\\s\\x1c-\\x1f]+$"

_ICON = "[\\p{So}&&[^°]]"
_ENDS = f"……|\\.\\.+|[{_class(PUNCTUATION + QUOTES)}]|{_ICON}"
PREFIX = f"^(?:{_ENDS}|US\\$|[CA]\\$|[{_class(CURRENCY)}]|[§%=—–]|\\+(?![0-9]))"
SUFFIX = (
    f"(?:{_ENDS}|['’][sS]|[—–]|(?<=[0-9])\\+|(?<=°[FfCcKk])\\.|(?<=[0-9])(?:US\\$|[CA]\\$|[{_class(CURRENCY)}])|(?<=[0-9])(?:{_any(UNITS)})"
    f"|(?<=[0-9\\p{{Ll}}%²\\-+{_class(PUNCTUATION + QUOTES)}])\\.|(?<=\\p{{Lu}}\\p{{Lu}})\\.)$"
)
_HYPHEN = "---|--|——|[-–—~]"
INFIX = (
    f"(?<!^)(?:\\.\\.+|…|{_ICON}|(?<=[0-9])[+\\-*^](?=[0-9-])|(?<=[\\p{{Ll}}{_class(QUOTES)}])\\.(?=[\\p{{Lu}}{_class(QUOTES)}])"
    f"|(?<=\\p{{L}}),(?=\\p{{L}})|(?<=\\p{{L}})(?:{_HYPHEN})(?=\\p{{L}})|(?<=[\\p{{L}}0-9])[:<>=/](?=\\p{{L}}))"
)
_LABEL = "[A-Za-z0-9\\u00a1-\\uffff](?:[A-Za-z0-9\\u00a1-\\uffff_-]*[A-Za-z0-9\\u00a1-\\uffff])?"
ADDRESS = f"^(?:[A-Za-z0-9_+.-]{{2,}}://)?(?:[^\\s@]+@)?(?:(?:{_LABEL}\\.)+[\\p{{Ll}}]{{2,63}}|(?:[0-9]{{1,3}}\\.){{3}}[0-9]{{1,3}})(?::[0-9]{{2,5}})?(?:[/?#]\\S*)?$"
_RUN = f"[{_class(PUNCTUATION + QUOTES).replace('…', '')}]"


def is_fixed(text: Column) -> Column:
    """Whether the text is a fixed expression, of one token or several."""
    plain = text.rlike("^\\p{L}+$")
    bare = plain & text.rlike(_BARE) & ~text.rlike(_WORDS)
    return (F.length(text) <= _FIXED) & (bare | (~plain & (text.rlike(_WHOLE) | text.rlike(_CUT))))


def _fixed_tokens(text: Column) -> Column:
    """The tokens of a fixed expression."""
    out = F.array(text)
    for pattern in reversed(FIXED):
        groups = F.array(*(F.regexp_extract(text, pattern, i + 1) for i in range(pattern.count("(") - pattern.count("(?"))))
        out = F.when(text.rlike(pattern), F.filter(groups, lambda x: x != "")).otherwise(out)
    return F.when(text.rlike(_WHOLE) | text.rlike(_WORDS), F.array(text)).otherwise(out)


def _let(value: Column, use) -> Column:
    """``use(value)``, the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _rest(text: Column, n: Column) -> Column:
    return F.substring(text, n + 1, F.length(text))


def chunk_tokens(chunk: Column) -> Column:
    """array<string>: the tokens of a text without white space. Most chunks are told by their shape, the others are folded."""
    head, last = F.substring(chunk, F.lit(1), F.length(chunk) - 1), F.substring(chunk, F.length(chunk), F.lit(1))
    word = F.regexp_extract(chunk, "\\p{L}+", 0)
    at = F.instr(chunk, word)
    around = F.concat(_signs(F.substring(chunk, F.lit(1), at - 1)), F.array(word), _signs(_rest(chunk, at - 1 + F.length(word))))
    safe = ~word.isin(*_UNSAFE)
    out = F.when(chunk.rlike(_ENDED) & ~head.isin(*_UNSAFE), F.array(head, last)).when(chunk.rlike(_ONE) | (chunk.rlike("^\\p{L}+$") & safe) | (chunk.rlike(_BEFORE) & safe), F.array(chunk))
    return out.when(chunk.rlike(_AROUND) & safe, around).otherwise(folded_tokens(chunk))


def _signs(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def folded_tokens(chunk: Column) -> Column:
    """The same by rounds, for chunks of any shape."""
    none = F.array().cast("array<string>")
    free = F.greatest(F.length(chunk) - 4 * _FIXED, F.lit(0))
    lead = F.least(F.length(F.regexp_extract(chunk, f"^{_RUN}+", 0)), free)
    trail = F.least(F.length(F.regexp_extract(chunk, f"{_RUN}+$", 0)), free - lead)
    first, last = F.substring(chunk, F.lit(1), lead), F.substring(chunk, F.length(chunk) - trail + 1, trail)
    core = F.substring(chunk, lead + 1, F.length(chunk) - lead - trail)

    def step(s: Column, _: Column) -> Column:
        prefix = F.regexp_extract(s.core, PREFIX, 0)
        ends = _let(F.struct(prefix.alias("prefix"), _rest(s.core, F.length(prefix)).alias("bare")), lambda x: F.struct(x.prefix.alias("prefix"), x.bare.alias("bare"), F.regexp_extract(x.bare, SUFFIX, 0).alias("suffix")))

        def off(x: Column) -> Column:
            short = F.substring(s.core, F.lit(1), F.length(s.core) - F.length(x.suffix))
            has, ends = x.prefix != "", x.suffix != ""
            to = lambda core, before, after, done: F.struct(
                F.concat(s.before, F.array(x.prefix)).alias("before") if before else s.before.alias("before"),
                core.alias("core"),
                F.concat(F.array(x.suffix), s.after).alias("after") if after else s.after.alias("after"),
                F.lit(done).alias("done"),
            )
            return (
                F.when(~has & ~ends, to(s.core, False, False, True))
                .when(has & is_fixed(x.bare), to(x.bare, True, False, True))
                .when(ends & is_fixed(short), to(short, False, True, True))
                .when(has & ends, to(F.substring(x.bare, F.lit(1), F.length(x.bare) - F.length(x.suffix)), True, True, False))
                .when(has, to(x.bare, True, False, False))
                .otherwise(to(short, False, True, False))
            )

        still = F.struct(s.before.alias("before"), s.core.alias("core"), s.after.alias("after"), F.lit(True).alias("done"))
        return F.when(s.done | (s.core == "") | is_fixed(s.core), still).otherwise(_let(ends, off))

    steps = F.length(F.regexp_replace(core, "[\\p{L}\\p{N}]", "")) + 3
    start = F.struct(none.alias("before"), core.alias("core"), none.alias("after"), F.lit(False).alias("done"))

    def finish(s: Column) -> Column:
        cut = F.filter(F.split(F.regexp_replace(s.core, INFIX, f"{_MARK}$0{_MARK}"), _MARK), lambda x: x != "")
        address = (F.length(s.core) <= MOST) & s.core.rlike(ADDRESS)
        inside = F.when(s.core == "", none).when(is_fixed(s.core), _fixed_tokens(s.core)).when(address | s.core.contains(_MARK), F.array(s.core)).otherwise(cut)
        return F.concat(s.before, inside, s.after)

    folded = F.aggregate(F.sequence(F.lit(1), steps), start, step, finish)
    return F.concat(_signs(first), folded, _signs(last))


def text_tokens(text: Column) -> Column:
    """array<string>: the tokens of a text, white space that is a token included; null for null."""
    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_PIECES), 0), piece_tokens))


def piece_tokens(piece: Column) -> Column:
    """The tokens of a chunk with the space that belongs to it, or of white space. Words come first, since most pieces are words."""
    word = F.rtrim(piece)
    return F.when(piece.rlike(_WORD_PIECE) & ~word.isin(*_UNSAFE), F.array(word)).when(piece.rlike(_ALL_BLANK), F.array(piece)).otherwise(_let(word, chunk_tokens))


def text_pieces(text: Column) -> Column:
    """array<struct<tokens,tied>>: the tokens of each piece of a text, and whether a space follows the last of them; null for null."""
    tied = lambda p: p.rlike("(?U)[^\\s\\x1c-\\x1f] $")
    return F.transform(F.regexp_extract_all(text, F.lit(_PIECES), 0), lambda p: F.struct(piece_tokens(p).alias("tokens"), tied(p).alias("tied")))


def rule_tokens(captions: DataFrame, id_col: str = "caption_id", text_col: str = "caption") -> DataFrame:
    """caption_id, i, text, char_start, char_end, whitespace of every token."""
    pieces = captions.select(captions[id_col].alias("caption_id"), F.posexplode(F.regexp_extract_all(captions[text_col], F.lit(_PIECES), 0)).alias("p", "piece"))
    tied = F.col("piece").rlike("(?U)[^\\s\\x1c-\\x1f] $")
    found = pieces.withColumns({"tied": tied, "tokens": piece_tokens(F.col("piece"))})
    rows = found.select("caption_id", "p", "tied", F.size("tokens").alias("n"), F.posexplode("tokens").alias("k", "text"))
    rows = rows.withColumn("whitespace", F.when(F.col("tied") & (F.col("k") == F.col("n") - 1), " ").otherwise(""))
    by = Window.partitionBy("caption_id").orderBy("p", "k")
    end = F.sum(F.length("text") + F.length("whitespace")).over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.length("whitespace")
    rows = rows.withColumns({"i": (F.row_number().over(by) - 1).cast("int"), "char_end": end.cast("int")})
    return rows.select("caption_id", "i", "text", (F.col("char_end") - F.length("text")).cast("int").alias("char_start"), "char_end", "whitespace")


#: Tokens that end a sentence, and those that still belong to one that has ended.
_ENDS_SENTENCE = "^(?:[.!?。？！।]|\\.\\.+|…)$"
_CLOSES = f"^[{_class(QUOTES)})\\]}}]$"


def text_sentences(captions: DataFrame, id_col: str = "caption_id", text_col: str = "caption") -> DataFrame:
    """caption_id, sentence, token_start, token_end: the sentences of ``sentence_spans``, without a row for each token.

    A text's tokens become a text of three letters (ends, closes, other) in which a pattern finds the sentences; only they are exchanged."""
    kind = lambda t: F.when(t.rlike(_ENDS_SENTENCE), "E").when(t.rlike(_CLOSES), "C").otherwise("O")
    letters = F.array_join(F.transform(text_tokens(captions[text_col]), kind), "")
    found = captions.select(captions[id_col].alias("caption_id"), F.posexplode(F.regexp_extract_all(letters, F.lit("[^E]*E[EC]*|[^E]+"), 0)).alias("sentence", "s"))
    by = Window.partitionBy("caption_id").orderBy("sentence").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("s")).over(by)
    return found.select("caption_id", "sentence", (end - F.length("s")).cast("int").alias("token_start"), end.cast("int").alias("token_end"))


def sentence_spans(tokens: DataFrame) -> DataFrame:
    """caption_id, sentence, token_start, token_end, char_start, char_end: a sentence ends after a run of closing signs that begins
    with a full stop, question or exclamation mark; what follows the last one is a sentence too."""
    by = Window.partitionBy("caption_id").orderBy("i")
    ends = F.col("text").rlike(_ENDS_SENTENCE)
    closing = F.col("text").rlike(_CLOSES)
    rows = tokens.withColumns({"ends": ends, "closing": closing})
    # a closing sign belongs to the run if the last token that is none of them ended a sentence
    last = F.last(F.when(~F.col("closing"), F.col("ends")), ignorenulls=True).over(by)
    rows = rows.withColumn("tail", F.coalesce(last, F.lit(False)))
    begins = F.lag("tail").over(by) & ~F.col("tail")
    rows = rows.withColumn("sentence", F.sum(F.when(begins, 1).otherwise(0)).over(by).cast("int"))
    return rows.groupBy("caption_id", "sentence").agg(F.min("i").alias("token_start"), (F.max("i") + 1).alias("token_end"), F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"))
