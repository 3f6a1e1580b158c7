"""Scans: CSV with a declared schema, optional inputs, column contract, metadata payloads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingmill.sources import schemas

# Fixed value of the metadata service.
POSTER_PREFIX = "https://image.tmdb.org/t/p/w500"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header line.

    ``multi_line`` is for text that holds line breaks (metadata); it makes a file unsplittable,
    so ratings, tags and links are read without it.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def read_optional_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """As ``read_csv``; an absent file gives an empty frame with the declared columns."""
    try:
        return read_csv(spark, path, schema, multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def require_columns(df: DataFrame, required: Iterable[str], source: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{source} lacks the columns {', '.join(missing)}")
    return df


def payload_metadata(
    payloads: DataFrame,
    payload: str = "payload",
    cast_separator: str = "|",
    no_director: str = "Unknown",
) -> DataFrame:
    """Metadata columns out of JSON payloads ``(movieId, payload)``.

    Keeps the first five cast names, the first crew member whose job is Director, the poster
    address and the language. Use ``" "`` and ``""`` for the variant joined by spaces.
    """
    doc = F.from_json(F.col(payload), schemas.PAYLOAD)
    parsed = payloads.select("movieId", doc.alias("doc"))
    names = F.transform(
        F.slice(F.coalesce("doc.credits.cast", F.array().cast("array<struct<name:string>>")), 1, 5),
        lambda person: F.coalesce(person["name"], F.lit("")),
    )
    directors = F.filter("doc.credits.crew", lambda member: member["job"] == "Director")
    return parsed.select(
        "movieId",
        F.coalesce("doc.overview", F.lit("")).alias("overview"),
        F.array_join(names, cast_separator).alias("cast"),
        F.coalesce(F.get(directors, F.lit(0))["name"], F.lit(no_director)).alias("director"),
        F.when(F.coalesce("doc.poster_path", F.lit("")) == "", "")
        .otherwise(F.concat(F.lit(POSTER_PREFIX), "doc.poster_path"))
        .alias("poster_url"),
        F.coalesce("doc.original_language", F.lit("")).alias("original_language"),
    )
