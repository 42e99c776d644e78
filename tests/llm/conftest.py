import pytest


@pytest.fixture()
def make(spark):
    """A documents frame from (doc_id, text) rows, with null and clashing extra columns."""
    from pyspark.sql import functions as F

    def build(rows, parts=3):
        df = spark.createDataFrame(list(rows), "doc_id long, text string").repartition(parts)
        names = ["lang", "source", "n_words", "score", "batch", "__tf_batch", "__tf_to", "component_id", "embedding"]
        return df.select("*", *[F.lit(None).cast("string").alias(n) for n in names])

    return build

