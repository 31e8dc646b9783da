from pyspark.sql import functions as F

from flowlens.operators.sampling import bernoulli_sample, hash_sample, stratified_sample


def test_random_samples(spark):
    df = spark.range(0, 20_000, numPartitions=4).withColumn("c", F.col("id") % 2)
    for sample in (bernoulli_sample(df), stratified_sample(df, "c"), stratified_sample(df, "c", {0: 0.3, 1: 0.3})):
        shares = [r.n / 10_000 for r in sample.groupBy("c").agg(F.count("*").alias("n")).collect()]
        assert len(shares) == 2 and all(0.27 < s < 0.33 for s in shares)
    assert bernoulli_sample(df).exceptAll(bernoulli_sample(df)).count() == 0


def test_stratified_sample_drops_missing_class(spark):
    df = spark.createDataFrame([(None,)] * 50 + [("a",)] * 50, "c string")
    assert stratified_sample(df, "c", 1.0).count() == 50


def test_hash_sample_does_not_depend_on_partitions(spark):
    df = spark.range(0, 20_000).withColumn("k", F.col("id") * 7)
    one = hash_sample(df.coalesce(1), ["id", "k"])
    many = hash_sample(df.repartition(9), ["id", "k"])
    assert one.exceptAll(many).count() == 0 == many.exceptAll(one).count()
    assert 0.28 < one.count() / 20_000 < 0.32
