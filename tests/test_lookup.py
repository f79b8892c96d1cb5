import pytest
from pyspark.sql import functions as F

from clickmill.operators.lookup import attach, broadcast_if_small, measured_bytes
from frames import rows_of


def skewed(spark):
    """1,200 facts: a third on key 7, a third without a key, identical copies among both; keys up to 60 miss."""
    return spark.range(1200).select(
        F.when(F.col("id") < 400, 7).when(F.col("id") >= 800, F.col("id") % 60).cast("bigint").alias("key"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("payload"))


def lookup(spark):
    return spark.range(40).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"),
                                  F.when(F.col("id") != 7, F.col("id") * 1.5).alias("price"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("heavy", [1, 4, 1024])
def test_shuffled_join_equals_plain_join(spark, how, heavy):
    fact, dim = skewed(spark), lookup(spark)
    plain = rows_of(fact.join(dim, "key", how))
    assert rows_of(attach(fact, dim, "key", how)) == plain
    assert rows_of(attach(fact, dim, "key", how, broadcast_bytes=0, heavy_parts=heavy)) == plain


def test_more_heavy_keys_than_any_fixed_number(spark):
    """2,000 keys of equal load, all heavy for this many parts."""
    fact = spark.range(40_000).select((F.col("id") % 2000).alias("key"), "id")
    dim = spark.range(1900).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    joined = attach(fact, dim, "key", broadcast_bytes=0, heavy_parts=1000)
    row = joined.agg(F.count(F.lit(1)), F.count("twice"), F.sum("twice")).first()
    assert tuple(row) == (40_000, 38_000, 20 * 1900 * 1899)


def test_two_key_columns_and_a_cheaper_frame_to_weigh(spark):
    fact = skewed(spark).withColumn("day", F.when(F.col("payload") % 3 == 0, "a").otherwise("b"))
    dim = lookup(spark).withColumn("day", F.lit("a"))
    plain = rows_of(fact.join(dim, ["key", "day"], "left"), *fact.columns, "name", "price")
    got = attach(fact, dim, ["key", "day"], broadcast_bytes=0, heavy_parts=2, weigh=fact.select("key", "day"))
    assert rows_of(got, *fact.columns, "name", "price") == plain


def test_heavy_and_null_keys_do_not_meet_on_one_task(spark):
    facts = skewed(spark).repartition(6)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach(facts, lookup(spark).hint("merge"), "key", broadcast_bytes=0, heavy_parts=1)
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 1200 and max(sizes) < 600  # key 7 or the nulls alone are 400, both on one task 800


def test_broadcast_only_when_the_measured_size_fits(spark):
    dim = lookup(spark)
    size = measured_bytes(dim)
    assert 40 * 48 <= size <= 40 * 60
    assert "Broadcast" in attach(skewed(spark), dim, "key")._jdf.queryExecution().toString()
    small = broadcast_if_small(dim, size)._jdf.queryExecution().toString()
    large = broadcast_if_small(dim, size - 1)._jdf.queryExecution().toString()
    assert "broadcast" in small and "broadcast" not in large


def test_other_join_types_are_refused(spark):
    with pytest.raises(ValueError):
        attach(skewed(spark), lookup(spark), "key", "full", broadcast_bytes=0)
