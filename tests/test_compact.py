"""Training rows in few partitions: the same rows and models, and no task that a pass has to start in vain."""

from pyspark.sql import functions as F

from pennant.models import estimators as ES


def labelled(spark, n=600, parts=12):
    d = spark.range(0, n, 1, parts).select(F.col("id"), (F.col("id") % 7 * 1.0).alias("a"), (F.col("id") % 11 * 1.0).alias("b"),
                                           F.when(F.col("id") % 4 == 0, 1.0).otherwise(0.0).alias("label"),
                                           F.when(F.col("id") % 5 == 4, "test").otherwise("train").alias("split"))
    return ES.assemble(d, ["a", "b"])


def test_compact_keeps_the_rows_in_few_partitions(spark):
    d = labelled(spark)
    few = ES.compact(d, least=200, most=10_000)
    assert few.rdd.getNumPartitions() == 3 and sorted(map(str, few.collect())) == sorted(map(str, d.collect()))
    assert ES.compact(d, least=10, most=50).rdd.getNumPartitions() == 12          # a bound of rows a partition, whatever the cores
    assert ES.compact(d, least=10, most=10_000).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    empty = ES.compact(d.limit(0))
    assert empty.count() == 0


def test_weights_of_train_rows_add_no_partitions(spark):
    d = labelled(spark)
    w = ES.balanced_weights(d, "label", train=F.col("split") == "train")
    assert w.rdd.getNumPartitions() == d.rdd.getNumPartitions()
    rows = w.collect()
    train = [r for r in rows if r.split == "train"]
    for label in (0.0, 1.0):
        own = [r for r in train if r.label == label]
        assert {round(r.weight, 12) for r in own} == {round(len(train) / (2 * len(own)), 12)}
    assert {r.weight for r in rows if r.split == "test"} == {1.0} and len(rows) == 600


def test_weights_where_the_condition_is_null(spark):
    d = spark.createDataFrame([(1.0, "train"), (1.0, None), (0.0, "train"), (2.0, "test")], "label double, split string")
    got = {(r.label, r.split): r.weight for r in ES.balanced_weights(d, "label", train=F.col("split") == "train").collect()}
    assert got == {(1.0, "train"): 1.0, (1.0, None): 1.0, (0.0, "train"): 1.0, (2.0, "test"): 1.0}


def test_boosted_trees_of_compact_rows_are_the_same(spark):
    d = ES.balanced_weights(labelled(spark), "label")
    seen = []
    for x in (d, ES.compact(d, least=300)):
        got = ES.positive_probability(ES.gbt_classifier(iters=4, depth=3).fit(x).transform(d)).select("id", F.round("p", 9).alias("p"))
        seen.append({r.id: r.p for r in got.collect()})
    assert seen[0] == seen[1] and len(set(seen[0].values())) > 2
