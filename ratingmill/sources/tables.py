"""Ratings, movies, links and metadata as views over the order tables and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rating_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line, duplicates of (userId, movieId) included."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', l_shipdate)")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
        seconds.alias("timestamp"),
        "l_orderkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Newest row per (userId, movieId).

    Spark keeps at most one row per key and map task before the shuffle (window group limit),
    so a key with very many duplicates does not reach one task whole.
    """
    newest = Window.partitionBy("userId", "movieId").orderBy(
        F.desc("timestamp"), "l_orderkey", "l_suppkey", "l_linenumber", F.desc("l_quantity")
    )
    return (
        rating_rows(spark, folder)
        .withColumn("_n", F.row_number().over(newest))
        .filter("_n = 1")
        .select("userId", "movieId", "rating", "timestamp")
    )


def movies(spark: SparkSession, folder: str) -> DataFrame:
    year = F.concat(F.lit(" ("), (F.col("p_size") + 1970).cast("string"), F.lit(")"))
    title = F.when(F.col("p_size") % 10 == 0, F.col("p_name")).otherwise(F.concat("p_name", year))
    words = F.split("p_name", " ")
    genres = F.when(F.col("p_brand") == "Brand#13", "").otherwise(
        F.concat_ws("|", "p_type", F.get(words, F.lit(0)), F.get(words, F.lit(1)))
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("movieId"), title.alias("title"), genres.alias("genres")
    )


def type_movies(spark: SparkSession, folder: str) -> DataFrame:
    """Movies whose only genre is the part type, for baskets that do not hold everything."""
    return movies(spark, folder).select(
        "movieId", "title", F.split_part("genres", F.lit("|"), F.lit(1)).alias("genres")
    )


def links(spark: SparkSession, folder: str) -> DataFrame:
    """External ids for the parts of even size."""
    return (
        table(spark, folder, "part")
        .filter("p_size % 2 = 0")
        .select(
            F.col("p_partkey").alias("movieId"),
            F.format_string("tt%07d", F.col("p_partkey")).alias("imdbId"),
            (F.col("p_partkey") + 100_000).alias("tmdbId"),
        )
    )


def tags(spark: SparkSession, folder: str) -> DataFrame:
    """One tag per order line of a returned item, named by its flag and status."""
    rows = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', l_shipdate)")
    return rows.select(
        F.col("l_suppkey").alias("userId"), F.col("l_partkey").alias("movieId"), F.concat_ws(", ", "l_returnflag", "l_linestatus").alias("tag"), seconds.alias("timestamp")
    )


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One metadata payload per document: every word is a cast name, the source is the crew."""
    words = F.split("text", " ")
    cast = F.transform(words, lambda w: F.struct(w.alias("name")))
    job = F.when(F.col("source") == "src0", "Producer").otherwise("Director")
    crew = F.array(
        F.struct(F.lit("Editor").alias("job"), F.col("lang").alias("name")),
        F.struct(job.alias("job"), F.col("source").alias("name")),
    )
    body = F.struct(
        F.col("text").alias("overview"),
        F.when(F.col("lang") == "en", "").otherwise(F.concat(F.lit("/"), "source", F.lit(".jpg"))).alias("poster_path"),
        F.col("lang").alias("original_language"),
        F.struct(cast.alias("cast"), crew.alias("crew")).alias("credits"),
    )
    return table(spark, folder, "documents").select(F.col("doc_id").alias("movieId"), F.to_json(body).alias("payload"))


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Overview, cast and director taken from documents with the same id."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("movieId"),
        F.col("text").alias("overview"),
        F.when(F.col("lang") != "en", F.concat_ws("|", "lang", "source")).alias("cast"),
        F.nullif("source", F.lit("src0")).alias("director"),
    )
