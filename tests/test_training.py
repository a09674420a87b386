"""How training rows are dealt to tasks."""

from pyspark.sql import functions as F

from creditloom.operators import training


class Sizes:
    """A learner whose model is the rows of each task."""

    def fit(self, train):
        return sorted(r["n"] for r in train.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())


def test_training_rows_of_one_task_are_dealt_to_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = 4 * cores * training.LEAST_ROWS
    one_task = spark.range(0, rows, 1, 1).withColumn("label", F.col("id") % 2)
    sizes = training.fit_models({"sizes": Sizes}, one_task)["sizes"]
    assert len(sizes) == cores and sum(sizes) == rows and sizes[-1] < 1.1 * rows / cores
    dealt = training.spread(one_task)
    assert dealt.exceptAll(one_task).isEmpty() and dealt.count() == rows


def test_few_training_rows_stay_in_their_task(spark):
    few = spark.range(0, training.LEAST_ROWS, 1, 1)
    assert training.spread(few) is few
