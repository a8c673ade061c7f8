"""Text analysis as Column expressions (F1, F2, P5, S8 defaults).

The tokeniser approximates Treebank-style word tokenisation with a short chain of regular-expression
rewrites that mean the same in Java regex (Spark) and RE2 (DuckDB), so the oracle can repeat it:

1. ``...`` and then ``--`` become spaces;
2. runs of ``:`` / ``,`` not followed by a digit (``12:30`` stays whole) become a space;
3. brackets, quotes, symbol characters and every white-space character become blanks;
4. periods that end a word (followed by white space or the end) become a space;
5. the clitics ``'s 'm 'd 'll 're 've n't`` at the end of a word are cut off;
6. the text is split on blanks;
7. a token survives only if it is made of letters and digits alone (``no-one``, ``u.s`` and ``12:30``
   are dropped whole, never split); one-word contractions (``cannot``) are cut in two; stop words go.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.functions.stopwords import ENGLISH

# The rewrite chain, in order.  Each step is (kind, pattern, replacement): "literal" replaces
# a plain substring, "chars" maps each listed character to a space, "regex" is a regular expression with
# Spark's ``$n`` group syntax.  Literal and character steps avoid the regex engine (same result, cheaper).
REWRITES: tuple[tuple[str, str, str], ...] = (
    ("literal", "...", " "),
    ("literal", "--", " "),
    ("regex", r"[:,]+([^0-9:,]|$)", " $1"),
    ("chars", ';?!()[]{}<>"“”«»@#$%&\t\n\x0b\x0c\r', " "),
    ("regex", r"[.]+(\s|$)", " "),
    ("regex", r"('(s|m|d|ll|re|ve)|n't)(\s|$)", " "),
)
# White space was mapped to blanks by the "chars" step, so the split is on one blank (a plain string
# split, no regex); runs of blanks give empty tokens, which the word filter drops.
SPLIT = " "
# The published Treebank contractions of one word; each is two tokens, cut after the third letter.
CONTRACTIONS = ("cannot", "gimme", "gonna", "gotta", "lemme", "wanna")
ANALYSIS = "treebank-like-3"  # version of the token rules, stored with every saved index
WORD = r"^[\p{L}\p{N}]+$"


def normalize(text: Column) -> Column:
    """F1 + F2 first half: lower-case, then the rewrite chain."""
    out = F.lower(text)
    for kind, pattern, repl in REWRITES:
        if kind == "literal":
            out = F.replace(out, F.lit(pattern), F.lit(repl))
        elif kind == "chars":
            out = F.translate(out, pattern, repl * len(pattern))
        else:
            out = F.regexp_replace(out, pattern, repl)
    return out


def token_array(text: Column) -> Column:
    """``array<string>`` of raw tokens (before the word and stop-word filters)."""
    return F.split(normalize(text), SPLIT)


def is_word(token: Column) -> Column:
    """P5 first half: letters and digits only."""
    return token.rlike(WORD)


def default_stopwords(language: str = "english") -> tuple[str, ...]:
    """The packaged stop list for ``language`` (only ``english``; pass any other list as words or a table)."""
    if language != "english":
        raise ValueError(f"no packaged stop list for {language!r}; pass the words or a table")
    return ENGLISH


def contraction_parts(token: Column) -> Column:
    """``cannot`` -> ``can``, ``not`` and the like; any other token alone."""
    cut = F.array(F.substring(token, 1, 3), F.substring(token, 4, 3))
    return F.when(token.isin(*CONTRACTIONS), cut).otherwise(F.array(token))


def resolve_stopwords(stopwords) -> tuple[str, ...] | DataFrame:
    """``None`` → Spark's English list; ``()`` → no stop words; a list → that list (lower-cased);
    a DataFrame with a ``word`` column → kept as a table (joined, never collected)."""
    if stopwords is None:
        return default_stopwords("english")
    if isinstance(stopwords, DataFrame):
        return stopwords
    if isinstance(stopwords, str):
        return default_stopwords(stopwords)
    return tuple(dict.fromkeys(w.rstrip().lower() for w in stopwords))


def tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stopwords=None,
           out_id: str = "doc_id") -> DataFrame:
    """Rows ``(out_id, term)`` for every kept token of every row (duplicates kept: they are tf).

    A stop list given as a Python sequence becomes an ``InSet`` predicate (hash set, codegen, no
    join); one given as a DataFrame becomes a left-anti join that AQE broadcasts when it is small.
    """
    sw = resolve_stopwords(stopwords)
    t = df.select(F.col(id_col).alias(out_id), F.explode(token_array(F.col(text_col))).alias("term"))
    t = t.filter(is_word(F.col("term"))).select(out_id, F.explode(contraction_parts(F.col("term"))).alias("term"))
    if isinstance(sw, DataFrame):
        return t.join(sw.select(F.col("word").alias("term")), "term", "left_anti").select(out_id, "term")
    if sw:
        t = t.filter(_not_stopword(sw))
    return t


def kept_words(df: DataFrame, text_col: str, stopwords: tuple[str, ...], out: str) -> DataFrame:
    """``df`` with the tokens that :func:`tokens` gives for ``text_col`` as one array ``out``, in place of the text (null for a
    null text)."""
    words = df.withColumn(out, F.filter(token_array(F.col(text_col)), is_word)).drop(text_col)
    cut = F.flatten(F.transform(out, contraction_parts))
    words = words.withColumn(out, F.when(F.exists(out, lambda t: t.isin(*CONTRACTIONS)), cut).otherwise(F.col(out)))
    return words.withColumn(out, F.filter(out, lambda t: ~t.isin(*stopwords))) if stopwords else words


@functools.lru_cache(maxsize=16)
def _not_stopword(words: tuple[str, ...]) -> Column:
    """``term NOT IN (...)`` built as one SQL expression (one JVM call instead of one per word);
    Catalyst turns it into an ``INSET`` hash lookup."""
    quoted = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    return F.expr(f"term NOT IN ({quoted})")
