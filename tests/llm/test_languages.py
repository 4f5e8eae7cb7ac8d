"""Every language with enough trusted documents has a threshold of its own."""

from pyspark.sql import functions as F

from tidemark.llm.kneser_ney import Quality, quality_scores


def test_any_number_of_languages(spark):
    languages, each = 1100, 2
    docs = spark.range(languages * each).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("l"), F.col("id") % languages).alias("lang"),
        F.concat_ws(" ", F.lit("some plain words"), F.repeat(F.lit("of it "), (F.col("id") % 7).cast("int"))).alias("text"),
    )
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    scores = quality_scores(docs, labels, Quality(quantile=1.0, least_trusted=each))
    # With its own quantile of 1 every language accepts all that it trusts.
    assert scores.count() == languages * each and scores.filter("NOT accepted").count() == 0
    own = scores.groupBy("lang").agg(F.max("perplexity").alias("most"), F.max("threshold").alias("limit"))
    assert own.filter("abs(most - `limit`) > 1e-9 * most").count() == 0
