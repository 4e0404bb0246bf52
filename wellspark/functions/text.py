"""Text cleaning as native column expressions (no Python per row).

Regex classes are spelled out so that Spark (Java regex), DuckDB (RE2) and
Python agree: ``\\p{Nd}`` for digits (Python's ``\\d`` is Unicode, Java's is
ASCII), ``[\\p{L}\\p{N}_]{2,}`` for word tokens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# The 32 ASCII punctuation marks (Python ``string.punctuation``).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# English stop words (the NLTK English list), in the list's own order.
STOP_WORDS_EN = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren "
    "weren't won won't wouldn wouldn't"
).split()

# Noun suffix rules for lemmas (WordNet's noun detachment rules), in order.
NOUN_SUFFIX_RULES = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
                     ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")]

URL_PATTERN = r"http\S+|www\S+"
DIGITS_PATTERN = r"\p{Nd}+"
PUNCT_CLASS = "".join("\\" + x for x in PUNCTUATION)
NON_LETTER_PATTERN = r"[^a-zA-Z\s]"
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
# ------------------------------------------------------------------------------


def txt_lower(c: Column) -> Column:
    return F.lower(c)


def txt_strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL_PATTERN, "")


def txt_strip_digits(c: Column) -> Column:
    return F.regexp_replace(c, DIGITS_PATTERN, "")


def txt_strip_punct(c: Column) -> Column:
    # ``translate`` looks every character up in a map of strings
    return F.regexp_replace(c, f"[{PUNCT_CLASS}]+", "")


def txt_strip_digits_punct(c: Column) -> Column:
    """Both at once: each only takes single characters out."""
    return F.regexp_replace(c, rf"[\p{{Nd}}{PUNCT_CLASS}]+", "")


def txt_letters_only(c: Column) -> Column:
    return F.regexp_replace(c, NON_LETTER_PATTERN, " ")


def txt_tokens(c: Column) -> Column:
    """Whitespace split without empty strings (Python ``str.split()``)."""
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def word_count(c: Column) -> Column:
    return F.size(txt_tokens(c))


def txt_stopwords(tokens: Column, stop_words: list[str] = STOP_WORDS_EN) -> Column:
    """Drop stop words, keeping order and repeats (``array_except`` would
    de-duplicate)."""
    # ``isin`` over more than 10 literals becomes a hash-set lookup (InSet),
    # also inside the lambda; ``array_contains`` would scan the list per token.
    return F.filter(tokens, lambda x: ~x.isin(*stop_words))


def word_tokens(c: Column) -> Column:
    """Lower-case word tokens of two or more letters/digits/underscores."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_PATTERN), 0)


def clean_tokens(c: Column, stop_words: list[str] = STOP_WORDS_EN) -> Column:
    """lower -> strip URLs -> strip digits -> strip punctuation -> split ->
    drop stop words (the reference order; lemmas are a separate join)."""
    t = txt_strip_digits_punct(txt_strip_urls(txt_lower(c)))
    return txt_stopwords(txt_tokens(t), stop_words)


def clean_text(c: Column, stop_words: list[str] = STOP_WORDS_EN) -> Column:
    return F.array_join(clean_tokens(c, stop_words), " ")


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams of a token array, in order.  Built with
    ``zip_with`` over shifted slices: the token array is evaluated once,
    not once per element as it would be inside a ``transform`` lambda."""
    m = F.greatest(F.size(tokens) - n + 1, F.lit(0))
    grams = F.slice(tokens, 1, m)
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(tokens, k + 1, m), lambda a, b: F.concat_ws(" ", a, b))
    return grams
