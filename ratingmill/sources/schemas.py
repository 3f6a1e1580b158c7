"""Declared schemas of the inputs; nothing is inferred."""

from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

TAGS = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("tag", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

LINKS = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("imdbId", T.StringType()),
        T.StructField("tmdbId", T.LongType()),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("overview", T.StringType()),
        T.StructField("cast", T.StringType()),
        T.StructField("director", T.StringType()),
        T.StructField("poster_url", T.StringType()),
        T.StructField("original_language", T.StringType()),
    ]
)

RECOMMENDATIONS = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("predicted_rating", T.DoubleType()),
        T.StructField("method", T.StringType()),
    ]
)

_PERSON = T.StructType([T.StructField("name", T.StringType())])
_CREW = T.StructType([T.StructField("job", T.StringType()), T.StructField("name", T.StringType())])

PAYLOAD = T.StructType(
    [
        T.StructField("overview", T.StringType()),
        T.StructField("poster_path", T.StringType()),
        T.StructField("original_language", T.StringType()),
        T.StructField(
            "credits",
            T.StructType(
                [
                    T.StructField("cast", T.ArrayType(_PERSON)),
                    T.StructField("crew", T.ArrayType(_CREW)),
                ]
            ),
        ),
    ]
)

REQUIRED = {
    "ratings": ("userId", "movieId", "rating", "timestamp"),
    "movies": ("movieId", "title", "genres"),
}
