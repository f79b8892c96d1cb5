import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickmill.operators.cuts import cut_keys, sort_tie, sort_value, tiles
from clickmill.operators.ranking import number_rows
from frames import rows_of


def tied(spark, n, groups=1):
    return spark.range(n).select(
        "id", (F.col("id") % groups).alias("g"), F.when(F.col("id") % 3 == 0, F.col("id") % 7).alias("v"))


def by_cuts(df, k, value, by=(), **options):
    return tiles(df, k, {"tile": (sort_value(value), sort_tie(F.col("id")))}, by, **options)


@pytest.mark.parametrize("n,k,most_rows,bins", [(11, 5, 20_000, 1024), (3, 5, 20_000, 1024), (0, 5, 20_000, 1024), (4, 1, 20_000, 1024),
                                                (60, 80, 20_000, 1024), (1000, 7, 20_000, 1024), (11, 5, 1, 2), (1000, 7, 3, 50)])
def test_tiles_equal_the_built_in(spark, n, k, most_rows, bins):
    df = tied(spark, n)
    order = [F.col("v").asc_nulls_first(), F.col("id").asc()]
    ours = rows_of(by_cuts(df, k, F.col("v"), most_rows=most_rows, bins=bins), "id", "tile")
    theirs = rows_of(df.withColumn("tile", F.ntile(k).over(Window.orderBy(*order))), "id", "tile")
    assert ours == theirs


@pytest.mark.parametrize("most_rows", [30, 20_000])
def test_tiles_in_groups_with_one_group_much_larger_and_a_null_group(spark, most_rows):
    df = spark.range(500).select("id", F.when(F.col("id") < 300, 0).when(F.col("id") < 310, 1)
                                 .when(F.col("id") < 340, None).otherwise(F.col("id") % 3 + 2).alias("g"),
                                 (F.col("id") % 4).alias("v"))
    order = [F.col("v").desc(), F.col("id").asc()]
    ours = rows_of(by_cuts(df, 5, -F.col("v"), ["g"], most_rows=most_rows), "id", "g", "tile")
    theirs = rows_of(df.withColumn("tile", F.ntile(5).over(Window.partitionBy("g").orderBy(*order))), "id", "g", "tile")
    assert ours == theirs


@pytest.mark.parametrize("most_rows", [4, 20_000])
def test_odd_values_and_null_ties_sort_like_spark(spark, most_rows):
    values = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e-300, -5.5, 5.5, 1e18, 0.1 + 0.2, 0.3]
    df = spark.createDataFrame([(v, i if i else None) for i, v in enumerate(values * 3)], "v double, id bigint")
    order = [F.col("v").asc_nulls_first(), F.col("id").asc_nulls_first()]
    ours = rows_of(by_cuts(df, 6, F.col("v"), most_rows=most_rows), "id", "tile")
    theirs = rows_of(df.withColumn("tile", F.ntile(6).over(Window.orderBy(*order))), "id", "tile")
    assert ours == theirs


def test_cut_rows_are_found_without_sorting_or_moving_the_rows(spark):
    """Of a large tied group only the rows of small intervals reach an exchange, and no row is sorted or range-partitioned."""
    df = spark.range(50_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 97).otherwise(0).alias("v"))
    key = F.struct(F.col("v").cast("double").alias("v"), F.col("id").alias("t"))
    cuts = cut_keys(df, 5, {"tile": key}, most_rows=100)
    plan = cuts._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan
    assert [tuple(c) for c in cuts.first()["tile"]] == [
        tuple(r) for r in df.orderBy("v", "id").select(F.col("v").cast("double"), "id").collect()[9999:49999:10_000]]


def test_one_tied_value_spreads_over_partitions(spark):
    df = spark.range(2000).withColumn("v", F.lit(9999))
    numbered = number_rows(df, [F.col("v").desc(), F.col("id").asc()], partitions=8)
    assert rows_of(numbered, "id", "__rn") == sorted([(i, i + 1) for i in range(2000)], key=repr)
    assert len(numbered.inputFiles()) == 8


def test_bucket_sizes_with_a_remainder(spark):
    df = tied(spark, 11)
    sizes = rows_of(by_cuts(df, 5, F.col("id")).groupBy("tile").count())
    assert sizes == [(1, 3), (2, 2), (3, 2), (4, 2), (5, 2)]


def test_merged_neighbouring_ranges_keep_the_order(spark):
    """Several tasks after adaptive merging: fewer than the ranges, more than one."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    parts = "spark.sql.shuffle.partitions"
    df = spark.range(200_000).select("id", F.pmod(F.xxhash64("id"), F.lit(50)).alias("v"))
    before = {key: spark.conf.get(key) for key in (size, least, parts)}
    for key, value in ((size, "400k"), (least, "100k"), (parts, "40")):
        spark.conf.set(key, value)
    try:
        order = [F.col("v").asc(), F.col("id").asc()]
        numbered = number_rows(df, order)
        assert 1 < len(numbered.inputFiles()) < 40
        expected = df.withColumn("__rn", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
        assert numbered.select("id", "__rn").exceptAll(expected.select("id", "__rn")).isEmpty()
        assert numbered.count() == 200_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_keys_of_a_group_are_sorted_once_and_not_for_each_cut(spark):
    df = spark.range(500).select("id", (F.col("id") % 2).alias("g"), (F.col("id") % 9).cast("double").alias("v"))
    key = F.struct(F.col("v"), F.col("id").alias("t"))
    cuts = cut_keys(df, 5, {"tile": key}, by=["g"])
    assert "filter(sort_array" not in cuts._jdf.queryExecution().optimizedPlan().toString()
    for row in cuts.collect():
        ordered = sorted((i % 9, i) for i in range(500) if i % 2 == row["g"])
        assert [(k["v"], k["t"]) for k in row["tile"]] == [ordered[50 * i - 1] for i in range(1, 5)]
