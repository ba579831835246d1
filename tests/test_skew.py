import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marlstone.catalog import plan_text
from marlstone.operators.relational import lookup
from marlstone.operators.skew import group_members, skewed_lookup, spread_evenly, with_group_stats
from tests.conftest import rows


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key; one key is null; some rows are copies."""
    return spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0))
        .when(F.col("id") % 50 == 1, F.lit(None).cast("int"))
        .otherwise((F.col("id") % 97).cast("int"))
        .alias("k"),
        (F.col("id") % 11).alias("g"),
        (F.col("id") % 13).cast("double").alias("v"),
    )


def test_group_stats_equal_a_window(skewed):
    stats = {"total": F.sum("v"), "n": F.count(F.lit(1))}
    window = Window.partitionBy("k")
    wanted = skewed.withColumns({name: agg.over(window) for name, agg in stats.items()})
    got = with_group_stats(skewed, ["k"], stats)
    assert got.columns == wanted.columns
    assert rows(got) == rows(wanted)


def test_group_stats_over_two_keys_without_broadcast(skewed, without_broadcast):
    wanted = skewed.withColumn("top", F.max("v").over(Window.partitionBy("k", "g")))
    assert rows(with_group_stats(skewed, ["k", "g"], {"top": F.max("v")})) == rows(wanted)


def test_skewed_lookup_equals_a_join(spark, skewed):
    table = skewed.groupBy("k").agg(F.max("v").alias("top")).where("k is null or k % 2 = 0")
    assert rows(skewed_lookup(skewed, table, ["k"])) == rows(
        skewed.join(table, "k").select("k", "g", "v", "top")
    )


@pytest.fixture
def small_partitions(spark, without_broadcast):
    """Thresholds by which a few thousand rows make a skewed partition."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("operator", ["stats", "lookup", "plain lookup"])
def test_a_hot_key_is_split_with_two_scans(spark, tmp_path, small_partitions, operator):
    path = str(tmp_path / "t")
    key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5000).alias("k")
    spark.range(200_000).repartition(8).select(key, F.rand(1).alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    if operator == "stats":
        got = with_group_stats(df, ["k"], {"top": F.max("v")})
    else:
        table = spark.read.parquet(path).groupBy("k").agg(F.max("v").alias("top"))
        got = skewed_lookup(df, table, ["k"]) if operator == "lookup" else lookup(df, table, ["k"], "top")
    got.collect()
    final = plan_text(got, "simple").split("== Initial Plan ==")[0]
    assert "skew=true" in final and final.count("FileScan") <= 2


def test_members_come_in_bounded_lists(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), (F.col("id") % 300).alias("v"))
    groups = group_members(df, ["k"], F.col("v"), max_members=20)
    sizes = groups.select(F.max(F.size("members")).alias("n"), F.count(F.lit(1)).alias("parts")).first()
    assert sizes.n <= 60 and sizes.parts > 10
    back = groups.select("k", F.explode("members").alias("m")).select("k", "m.member", "m.copies")
    wanted = df.groupBy("k", F.col("v").alias("member")).count().withColumnRenamed("count", "copies")
    assert rows(back) == rows(wanted)


def test_copies_do_not_lengthen_a_list(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    (group,) = group_members(df, ["k"], F.col("v"), max_members=10).collect()
    assert [tuple(m) for m in group.members] == [("same", 5000)]


def test_spread_evenly(spark):
    def sizes(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]

    one_part = spark.range(800).coalesce(1).withColumn("k", F.lit(1))
    cores = spark.sparkContext.defaultParallelism
    few = sizes(spread_evenly(one_part))
    assert len(few) == cores and max(few) - min(few) <= 8
    assert len(sizes(spread_evenly(one_part, rows_per_part=20))) == 40
