"""Column functions for text: all built-in expressions, no Python workers."""

from __future__ import annotations

import glob
import os
import string
import zipfile
from collections.abc import Iterable

import pyspark
from pyspark import SparkContext
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the e-mail grammar, with "@" or " at ", "." or " dot " ---
EMAIL_PATTERN = (
    r"(?i)[a-z0-9!#$%&'*+/=?^_`{|}~-]+(?:\.[a-z0-9!#$%&'*+/=?^_`{|}~-]+)*"
    r"(?:@|\sat\s)"
    r"(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(?:\.|\sdot\s))+"
    r"[a-z0-9](?:[a-z0-9-]*[a-z0-9])?"
)
# --- fixed values: a term is two or more word characters ---
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"
# --- fixed values: characters the vocabulary builder turns into spaces ---
VOCABULARY_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'

WHITESPACE = r"[\s\p{Z}]+"
#: ``scheme:rest`` where the rest is more than a port number.
URL_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:.*[^0-9]"


def java_split(text: Column) -> Column:
    """Split on one space the way ``java.lang.String.split`` does.

    Inner and leading empty strings stay, trailing ones go; an empty string is
    one empty word and a string of spaces has no words.
    """
    words = F.split(F.rtrim(text), " ", -1)
    return (
        F.when(F.length(text) == 0, F.array(F.lit("")))
        .when(F.length(F.rtrim(text)) == 0, F.array().cast("array<string>"))
        .otherwise(words)
    )


def split_trimmed(text: Column, sep: str = ",") -> Column:
    """Split on a separator and trim every cell."""
    return F.transform(F.split(text, f"\\Q{sep}\\E", -1), lambda cell: F.trim(cell))


def whitespace_tokens(text: Column) -> Column:
    """Tokens between runs of white space, without empty ones."""
    return F.filter(F.split(text, WHITESPACE, -1), lambda t: t != "")


def terms(text: Column) -> Column:
    """Lower-cased terms of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), F.lit(0))


def vocabulary_words(text: Column) -> Column:
    """Lower-cased words after the vocabulary's filter characters became spaces."""
    spaced = F.translate(F.lower(text), VOCABULARY_FILTERS, " " * len(VOCABULARY_FILTERS))
    return F.filter(F.split(spaced, " ", -1), lambda t: t != "")


def letters_only(text: Column) -> Column:
    """Lower case with everything but a-z replaced by one space per character."""
    return F.regexp_replace(F.lower(text), "[^a-zA-Z]", " ")


def flatten_whitespace(text: Column) -> Column:
    """Tabs, carriage returns and newlines become spaces (safe for TSV cells)."""
    return F.translate(text, "\r\n\t", "   ")


def strip_line_indents(text: Column) -> Column:
    """Drop ``CR LF TAB`` sequences and outer white space from a post body."""
    bare = F.replace(text, F.lit("\r\n\t"), F.lit(""))
    return F.regexp_replace(bare, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def spaces_and_plus(text: Column) -> Column:
    """Every white-space character or ``+`` becomes one space."""
    return F.regexp_replace(text, r"[\s+]", " ")


def strip_non_word(text: Column) -> Column:
    """Runs of non-word characters (Unicode) become one space; outer ones go."""
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}_]+", " "))


def squeeze_repeats(text: Column) -> Column:
    """Two or more equal characters in a row become exactly two."""
    return F.regexp_replace(text, r"(.)\1+", "$1$1")


def is_url(token: Column) -> Column:
    return token.startswith("http") | token.startswith("www") | token.rlike(URL_SCHEME)


def drop_urls(tokens: Column) -> Column:
    """Remove tokens that start with http or www, or carry another URL scheme."""
    return F.filter(tokens, lambda t: ~is_url(t))


def remove_emails(text: Column) -> Column:
    """Replace every e-mail address in any case, also the spelled-out form, by a space.

    The spelled-out form takes prose such as ``me at noon dot dot`` with it.

    The cheap look-ups keep the expensive pattern off texts that cannot match.
    """
    candidate = text.contains("@") | text.rlike(r"(?i)\sat\s")
    return F.when(candidate, F.regexp_replace(text, EMAIL_PATTERN, " ")).otherwise(text)


def english_stop_words() -> list[str]:
    """Spark's English stop words; read from its library when no session runs."""
    if SparkContext._active_spark_context is not None:
        return list(StopWordsRemover.loadDefaultStopWords("english"))
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    (jar,) = glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar"))
    with zipfile.ZipFile(jar) as library:
        words = library.read("org/apache/spark/ml/feature/stopwords/english.txt")
    return words.decode("utf-8").split("\n")


def excluded_tokens(extra: Iterable[str] = ("urllink",)) -> list[str]:
    """English stop words as shipped with Spark, ASCII punctuation, and extras."""
    return sorted({*english_stop_words(), *string.punctuation, *extra} - {""})


def drop_tokens(tokens: Column, excluded: Iterable[str]) -> Column:
    """Case-sensitive removal; a long list becomes a hash-set test."""
    words = sorted(set(excluded))
    return F.filter(tokens, lambda t: ~t.isin(words))


def keep_lengths(tokens: Column, shortest: int = 2, longest: int = 15) -> Column:
    return F.filter(tokens, lambda t: F.length(t).between(shortest, longest))


def drop_blank(tokens: Column) -> Column:
    """Drop tokens made of dots only and blank ones."""
    return F.filter(tokens, lambda t: ~t.rlike(r"^\.*$") & (F.trim(t) != ""))


def join_tokens(tokens: Column, sep: str = " ") -> Column:
    return F.array_join(tokens, sep)


def parse_token_list(text: Column) -> Column:
    """A stringified list (JSON quoting, or single quotes) back to an array."""
    options = {"allowSingleQuotes": "true"}
    return F.from_json(text, "array<string>", options)


def clean_post(text: Column) -> Column:
    """The simple cleaning: letters only, tokens of 2 to 15, no stop words."""
    tokens = whitespace_tokens(letters_only(text))
    return join_tokens(keep_lengths(drop_tokens(tokens, excluded_tokens())))


def basic_tokens(text: Column, excluded: Iterable[str]) -> Column:
    """First half of the full pipeline, up to (not including) lemmas."""
    tokens = drop_tokens(whitespace_tokens(remove_emails(text)), excluded)
    return F.transform(drop_urls(tokens), squeeze_repeats)


def final_tokens(tokens: Column, excluded: Iterable[str]) -> Column:
    """Second half: lower case, stop words again, no dots or blanks."""
    lowered = F.transform(tokens, lambda t: F.trim(F.lower(t)))
    return drop_blank(drop_tokens(lowered, excluded))
