"""Column functions for titles, tags, lists, labels (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import NO_GENRES, RATING_MAX, RATING_MIN

# Patterns of a trailing release year and of a word token.
YEAR_PATTERN = r"\((\d{4})\)$"
YEAR_SUFFIX = r"\s*\(\d{4}\)$"
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def title_year(title: Column) -> Column:
    return F.nullif(F.regexp_extract(title, YEAR_PATTERN, 1), F.lit("")).cast("int")


def title_clean(title: Column) -> Column:
    return strip(F.regexp_replace(title, YEAR_SUFFIX, ""))


def genres_list(genres: Column) -> Column:
    return F.when(genres == NO_GENRES, F.array().cast("array<string>")).otherwise(
        F.split(genres, r"\|")
    )


def clean_tag(tag: Column) -> Column:
    return strip(F.lower(F.coalesce(tag, F.lit(""))))


def to_bigint(col: Column) -> Column:
    """Nullable integer: anything that is not a number becomes null."""
    return col.try_cast("bigint")


def parse_list(col: Column) -> Column:
    """List-literal text to an array; anything unparsable gives an empty list."""
    parsed = F.from_json(col, "array<string>", {"allowSingleQuotes": "true"})
    return F.coalesce(F.when(F.ltrim(col).startswith("["), parsed), F.array().cast("array<string>"))


def tolerant_list(col: Column) -> Column:
    """As parse_list, but plain text becomes a one-element list."""
    text = strip(col)
    parsed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
    empty = F.array().cast("array<string>")
    plain = F.when(F.length(text) > 0, F.array(text)).otherwise(empty)
    return F.when(col.isNull(), empty).otherwise(
        F.coalesce(F.when(text.startswith("["), parsed), plain)
    )


def as_list(df: DataFrame, column: str) -> Column:
    """A list column in either form, text or array; null is an empty list."""
    c = F.col(column)
    if dict(df.dtypes)[column] == "string":
        return tolerant_list(c)
    return F.coalesce(c, F.array().cast("array<string>"))


def token(prefix: str, name: Column) -> Column:
    """Lower-case name with underscores behind a kind prefix."""
    return F.concat(F.lit(prefix), F.replace(F.lower(name), F.lit(" "), F.lit("_")))


def first_n(arr: Column, n: int) -> Column:
    return F.slice(arr, 1, n)


def word_tokens(text: Column) -> Column:
    """Lower-cased words of at least two word characters, whole text."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD_PATTERN})"), F.lit(1)
    )


def long_words(text: Column, longer_than: int = 4) -> Column:
    """Lower-cased whitespace-separated words longer than a length."""
    words = F.split(strip(F.lower(text)), r"\s+")
    return F.filter(words, lambda w: F.length(w) > longer_than)


def preview(text: Column, limit: int = 200) -> Column:
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))
    ).otherwise(text)


def percent_label(score: Column) -> Column:
    """Whole percent, truncated toward zero."""
    return (score * 100).cast("int")


def clip(col: Column, low: float = RATING_MIN, high: float = RATING_MAX) -> Column:
    return F.least(F.greatest(col, F.lit(low)), F.lit(high))


def has_poster(url: Column) -> Column:
    return F.coalesce(url.startswith("http"), F.lit(False))
