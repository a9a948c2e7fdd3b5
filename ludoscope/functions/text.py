"""Column expressions on text (inventory C1-C3, T2, K5)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Entities of landed descriptions and their replacements, applied in this order.
ENTITIES = [
    ("&#10;&#10;", " "),
    ("&#10;", " "),
    ("&rsquo;", "'"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&ldquo;", '"'),
    ("&rdquo;", '"'),
    ("&quot;", '"'),
]

WORD = r"[\p{L}\p{N}_]+"
TERM = r"[\p{L}\p{N}_]{2,}"


def clean_description(col: Column, strict: bool = False) -> Column:
    """Entities to characters, runs of white space to one blank, ends trimmed.

    ``strict`` leaves the semicolon of ``&mdash;`` behind, as data loaded before may hold it.
    """
    for entity, plain in ENTITIES:
        if strict and entity == "&mdash;":
            entity = "&mdash"
        col = F.replace(col, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(col, r"[\s\x1c-\x1f\x85\p{Z}]+", " "))


def keep_printable(col: Column) -> Column:
    """Only printable ASCII characters and white space stay."""
    return F.regexp_replace(col, r"[^\x20-\x7E\t\n\r\x0B\f]", "")


def title_words(col: Column) -> Column:
    """Hyphens to blanks and a capital first letter per word; the rest of a word is left alone."""
    words = F.filter(F.split(F.replace(col, F.lit("-"), F.lit(" ")), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " ")


def tokens(col: Column) -> Column:
    """The words of a text, as an array."""
    return F.regexp_extract_all(col, F.lit(f"({WORD})"), 1)


def terms(col: Column) -> Column:
    """T5: lower-cased words of two or more characters."""
    return F.regexp_extract_all(F.lower(col), F.lit(f"({TERM})"), 1)


def sorted_words(col: Column) -> Column:
    """Lower-cased words in alphabetical order, joined by blanks: the form titles are compared in."""
    return F.array_join(F.array_sort(tokens(F.lower(col))), " ")


def title_score(col: Column, query: Column) -> Column:
    """K5: 1 for equal titles, less by the share of characters to edit, regardless of word order."""
    a, b = sorted_words(col), sorted_words(query)
    longest = F.greatest(F.length(a), F.length(b), F.lit(1))
    return 1 - F.levenshtein(a, b) / longest
