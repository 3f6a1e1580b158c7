"""Tasks of the text features grow with the words."""

import re

from pyspark.sql import functions as F

from ratingmill.operators import text


def test_text_tasks_grow_with_the_words(spark, monkeypatch):
    docs = spark.range(60).select("id", F.concat_ws(" ", F.lit("red blue green"), F.concat(F.lit("word"), F.col("id") % 7)).alias("text"))
    expected = sorted((r["id"], r["term"], round(r["weight"], 9)) for r in text.tfidf(docs).collect())
    monkeypatch.setattr(text, "_TASK_ROWS", 20)
    found = text.tfidf(docs)
    # 60 texts of 4 words count 8 rows each.
    assert re.search(r"hashpartitioning\(id#\d+L?, 24\)", found._jdf.queryExecution().executedPlan().toString())
    assert sorted((r["id"], r["term"], round(r["weight"], 9)) for r in found.collect()) == expected
