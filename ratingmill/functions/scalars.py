"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratingmill.params import DEFAULTS

SECONDS_PER_DAY = 86_400


def clip_rating(score: Column, low: float = DEFAULTS.rating_low, high: float = DEFAULTS.rating_high) -> Column:
    return F.when(score.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), score)))


def genre_array(genres: Column) -> Column:
    """Pipe-separated genres to an array of trimmed, known names."""
    names = F.transform(F.split(genres, r"\|"), lambda g: F.trim(g))
    return F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda g: (g != "") & (g != "Unknown"))


def primary_genre(genres: Column) -> Column:
    first = F.get(F.split(genres, r"\|"), F.lit(0))
    return F.coalesce(F.nullif(F.trim(first), F.lit("")), F.lit("Unknown"))


def release_year(title: Column) -> Column:
    text = F.regexp_extract(title, r"\((\d{4})\)", 1)
    return F.nullif(text, F.lit("")).try_cast("int")


def decade(year: Column, unknown: str = "Unknown") -> Column:
    return F.coalesce(F.concat((F.floor(year / 10) * 10).cast("int").cast("string"), F.lit("s")), F.lit(unknown))


def parse_list_text(text: Column) -> Column:
    """A list printed as ``['A', 'B']``, or a pipe-separated string, to an array."""
    as_list = F.from_json(text, "array<string>")  # takes single quotes as well
    listed = F.when(F.trim(text).startswith("["), as_list).otherwise(F.split(text, r"\|"))
    return F.coalesce(listed, F.array().cast("array<string>"))


def text_length(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0))


def activity_level(count: Column) -> Column:
    """Activity bucket of the user dimension."""
    return F.when(count < 50, "Low").when(count < 500, "Medium").otherwise("High")


def activity_band(count: Column) -> Column:
    """Activity bucket of the activity-by-genre table."""
    return F.when(count < 20, "Low (<20)").when(count < 100, "Medium (20-100)").otherwise("High (>100)")


def method_family(method: Column) -> Column:
    first_word = F.split_part(method, F.lit(" "), F.lit(1))
    return F.coalesce(F.split_part(first_word, F.lit("-"), F.lit(1)), F.lit("Unknown"))


def strip_commas(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("double")


def safe_ratio(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(default))


def epoch_date(seconds: Column) -> Column:
    """UTC date of epoch seconds, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(seconds / SECONDS_PER_DAY).cast("int"))


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two arrays, null when both are empty."""
    both = F.size(F.array_union(left, right))
    shared = F.size(F.array_intersect(left, right))
    return F.try_divide(shared.cast("double"), both)


def rounded(score: Column, digits: int = 6) -> Column:
    """Round and turn a negative zero into zero."""
    return F.round(score, digits) + F.lit(0.0)
