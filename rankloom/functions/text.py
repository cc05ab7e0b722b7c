"""Tokens, normalisation and small string helpers."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

WORD = r"[\p{L}\p{N}]+"

# Whitespace as Python's str.split() sees it (fixed values), as the inside of a
# character class and as plain characters.
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CHARACTERS = "".join(
    chr(c)
    for first, last in (
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    )
    for c in range(first, last + 1)
)

# Inflection endings removed by the tuned analysis, per language (fixed values).
STEM_SUFFIXES = {
    "nl": ("ingen", "heden", "eren", "en", "e", "s"),
    "en": ("ings", "ing", "ed", "es", "s"),
    "de": ("ungen", "heiten", "keiten", "en", "er", "e", "s"),
    "fr": ("ements", "ement", "eaux", "es", "s"),
    "es": ("ciones", "mente", "es", "s"),
}
MIN_STEM = 4


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def tokens(text) -> Column:
    """Lower-cased runs of letters and digits, in order; never null."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(text), F.lit(""))), F.lit(WORD), F.lit(0))


def case_tokens(text) -> Column:
    """Whitespace-separated tokens with their case kept."""
    return F.array_remove(F.split(collapse_whitespace(F.coalesce(_col(text), F.lit(""))), " "), "")


def stem(term, language: str = "nl") -> Column:
    """Remove one known ending when at least ``MIN_STEM`` characters stay."""
    suffixes = "|".join(STEM_SUFFIXES[language])
    return F.regexp_replace(_col(term), rf"^(.{{{MIN_STEM},}}?)(?:{suffixes})$", "$1")


def collapse_whitespace(text) -> Column:
    """Every whitespace run becomes one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(_col(text), f"[{SPACE_CLASS}]+", " "))


def blank_to_null(text) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(collapse_ends(text), F.lit(""))


def collapse_ends(text) -> Column:
    """Trim Unicode whitespace at both ends only."""
    return F.btrim(_col(text), F.lit(SPACE_CHARACTERS))


@functools.cache
def _combining_marks() -> dict[int, None]:
    return {c: None for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))}


@F.pandas_udf(T.StringType())
def _fold_marks(texts: pd.Series) -> pd.Series:
    marks = _combining_marks()
    return texts.map(lambda text: unicodedata.normalize("NFKD", text).translate(marks), na_action="ignore")


def normalise(text) -> Column:
    """Accent-free, lower-case words separated by single spaces.

    Spark has no compatibility decomposition, so non-ASCII values pass an Arrow
    batch function; ASCII values reach it as null and stay in the JVM.
    """
    value = F.coalesce(_col(text), F.lit(""))
    folded = F.coalesce(_fold_marks(F.when(value.rlike(r"[^\x00-\x7F]"), value)), value)
    return F.trim(F.regexp_replace(F.lower(folded), r"[^\p{L}\p{N}]+", " "))


def lookup_keys(text) -> Column:
    """The normalised form and the same without spaces; empty array when blank."""
    spaced = normalise(text)
    return keys_of_normalised(spaced)


def keys_of_normalised(spaced) -> Column:
    spaced = _col(spaced)
    return F.array_remove(
        F.array_distinct(F.array(spaced, F.replace(spaced, F.lit(" "), F.lit("")))), ""
    )


def allowed_edits(token, min_len: int = 4, max_edits: int = 1) -> Column:
    """Edits a query token may differ by.

    All-upper-case tokens and tokens with a digit stay exact; purely alphabetic
    ones of ``min_len`` or more may differ by ``max_edits``.
    """
    token = _col(token)
    upper = token.rlike(r"\p{Lu}") & ~token.rlike(r"[\p{Ll}\p{Lt}]")
    digit = token.rlike(r"\p{N}")
    alphabetic = token.rlike(r"^\p{L}+$") & (F.length(token) >= min_len)
    return F.when(upper | digit, F.lit(0)).when(alphabetic, F.lit(max_edits)).otherwise(F.lit(0))


# Words up to this length are compared by all their deletions, longer ones by their halves.
SHORT_WORD = 10


def deletion_keys(term) -> Column:
    """The term and every form of it with one character removed.

    Two terms at Levenshtein distance at most one always share such a key.
    """
    term = _col(term)
    shorter = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(term), F.lit(1))),
        lambda i: F.concat(F.substr(term, F.lit(1), i - 1), F.substr(term, i + 1)),
    )
    return F.array_distinct(F.concat(F.array(term), shorter))


def _halves(term: Column, length: Column) -> list[Column]:
    """The first half of a word of ``length`` characters if ``term`` begins with it, and the second if it ends with it."""
    half = F.floor(length / 2).cast("int")
    named = lambda kind, part: F.concat_ws(" ", F.lit(kind), length.cast("string"), part)
    return [named("begin", F.substr(term, F.lit(1), half)), named("end", F.right(term, length - half))]


def one_edit_keys(term, probing: bool) -> Column:
    """Keys of which two terms at Levenshtein distance at most one share one, one of them ``probing``.

    An edit leaves one half of a word as it is. So a word has a key for each of its halves
    and is looked up by the halves that words of its own length, one less and one more
    would have: eight keys at most, however long the word. Halves of short words say
    little; these have a key for every deleted character (words of a length in between
    have both, so any two that may be one edit apart share a kind).
    """
    term = _col(term)
    length = F.length(term)
    lengths = (-1, 0, 1) if probing else (0,)
    halves = F.array(*(key for d in lengths for key in _halves(term, length + d)))
    none = F.array().cast("array<string>")
    deletions = F.transform(deletion_keys(term), lambda k: F.concat(F.lit("short "), k))
    return F.concat(
        F.when(length <= SHORT_WORD + 1, deletions).otherwise(none),
        F.when(length >= SHORT_WORD, halves).otherwise(none),
    )


# Spark's levenshtein walks a long word anew for every character.
_LONG_WORD = 64


def edits_up_to_one(a, b) -> Column:
    """0 for equal terms, 1 for terms one edit apart, else -1.

    What long terms have in common at their start is found by halving; behind the first
    difference and the edit there, the rest must be equal.
    """
    a, b = _col(a), _col(b)
    n, m = F.length(a), F.length(b)

    def halve(s: Column, _: Column) -> Column:
        middle = F.ceil((s["least"] + s["most"]) / 2).cast("int")
        same = F.substr(a, F.lit(1), middle) == F.substr(b, F.lit(1), middle)
        closer = F.struct(
            F.when(same, middle).otherwise(s["least"]).alias("least"),
            F.when(same, s["most"]).otherwise(middle - 1).alias("most"),
        )
        return F.when(s["least"] >= s["most"], s).otherwise(closer)

    start = F.struct(F.lit(0).alias("least"), F.least(n, m).alias("most"))
    shared = F.aggregate(F.sequence(F.lit(0), F.lit(31)), start, halve, lambda s: s["least"])
    rest = F.substr(a, shared + F.when(n >= m, 2).otherwise(1)) == F.substr(b, shared + F.when(m >= n, 2).otherwise(1))
    long = F.when(a == b, 0).when((F.abs(n - m) <= 1) & rest, 1).otherwise(-1)
    return F.when(F.greatest(n, m) <= _LONG_WORD, F.levenshtein(a, b, 1)).otherwise(long)


def split_list(text, delimiters: str) -> Column:
    """Parts between any of the delimiter characters, trimmed, empties dropped."""
    tight = F.regexp_replace(
        collapse_ends(text), f"[{SPACE_CLASS}]*[{delimiters}][{SPACE_CLASS}]*", delimiters[0]
    )
    return F.array_remove(F.split(tight, re.escape(delimiters[0])), "")


def split_terms(text) -> Column:
    """Comma-separated terms, trimmed, empties dropped."""
    return split_list(text, ",")


def embedding_text(title, body) -> Column:
    """Title, newline, body, trimmed; a single space when both are empty."""
    joined = collapse_ends(
        F.concat(F.coalesce(_col(title), F.lit("")), F.lit("\n"), F.coalesce(_col(body), F.lit("")))
    )
    return F.when(joined == "", F.lit(" ")).otherwise(joined)


def display_score(score, reranker_score) -> Column:
    """The reranker score unless it is missing or zero."""
    return F.coalesce(F.nullif(_col(reranker_score), F.lit(0.0)), _col(score))


def percent(value, signed: bool = False) -> Column:
    """A share as percent with one decimal."""
    return F.format_string("%+.1f" if signed else "%.1f", _col(value) * 100)
