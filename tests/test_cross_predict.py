"""Training rows of a fold come in one partition per core, however finely the table is split."""

from pyspark.sql import functions as F

from folio.evaluation.validation import cross_predict


def test_partitions_of_the_training_rows_do_not_grow_with_the_table(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(3000).repartition(60).select("id", (F.col("id") % 3).cast("string").alias("label"), F.sha2(F.col("id").cast("string"), 512).alias("x"))
    seen = []

    def fit_predict(train, test):
        seen.append((train.rdd.getNumPartitions(), train.count()))
        return test.withColumn("p", F.col("label"))

    split = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "60"}
    before = {key: spark.conf.get(key, None) for key in split}
    for key, value in split.items():
        spark.conf.set(key, value)
    try:
        done = cross_predict(rows, fit_predict, 3)
        ids = [r["id"] for r in done.collect()]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert sorted(ids) == list(range(3000)) and sum(n for _, n in seen) == 6000
    assert all(parts <= cores for parts, _ in seen)
