"""Training of the text models."""

from pyspark.sql import functions as F

from screenwell.learning import text


def test_labels_share_one_pass_over_the_texts(spark):
    """Five labels: the texts are made for the document frequencies and for the stored features only."""
    seen = spark.sparkContext.accumulator(0)

    def narrative(i):
        seen.add(1)
        return f"word{i % 3} word{i % 5} always"

    made = F.udf(narrative, "string").asNondeterministic()
    labels = F.array(*[(F.col("id") % (k + 2) == 0).cast("int") for k in range(5)])
    rows = spark.range(40).select(made("id").alias("text"), labels.alias("labels"))
    model = text.train_symptoms(rows, labels=list("abcde"), iterations=2)
    assert len(model.models) == 5
    assert seen.value <= 2 * 40
