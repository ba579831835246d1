import pytest
from pyspark.sql import functions as F

from marlstone import catalog
from marlstone.session import shared_dir
from tests.conftest import rows


def test_views_and_sql(spark):
    catalog.register(people=spark.createDataFrame([("a", 13), ("b", 20)], "name string, age int"))
    assert rows(catalog.run_sql(spark, "SELECT name FROM people WHERE age >= :low", {"low": 20})) == [("b",)]
    catalog.register_global(credit_table=spark.range(3))
    assert spark.newSession().sql("SELECT * FROM global_temp.credit_table").count() == 3
    spark.catalog.dropTempView("people")
    spark.catalog.dropGlobalTempView("credit_table")


def test_plan_text_shows_pushdown(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("v", F.col("id") * 2).withColumn("w", F.lit("x")).write.parquet(path)
    plan = catalog.plan_text(spark.read.parquet(path).where("v > 3").select("id"))
    assert "PushedFilters: [IsNotNull(v), GreaterThan(v,3)]" in plan
    assert "ReadSchema: struct<id:bigint,v:bigint>" in plan


def test_cached_and_rebuilt(spark):
    parent = spark.range(10).where("id % 2 = 0")
    before = parent.where("id > 3")
    cached, after = catalog.cached_and_rebuilt(parent, lambda df: df.where("id > 3"))
    assert "InMemoryTableScan" in catalog.plan_text(after)
    assert rows(after) == rows(before)
    cached.unpersist()


def test_plan_facts(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("v", F.col("id") * 2).write.parquet(path)
    facts = catalog.plan_facts(spark.read.parquet(path).where("v > 3").groupBy("v").count())
    steps = {r.operator for r in facts.where("fact is null").collect()}
    assert {"Exchange", "HashAggregate"} <= steps and any(s.startswith("Scan parquet") for s in steps)
    told = {r.fact: r.value for r in facts.where("operator like 'Scan%' and fact is not null").collect()}
    assert told["PushedFilters"] == "[IsNotNull(v), GreaterThan(v,3)]" and told["ReadSchema"] == "struct<v:bigint>"


class FakeContext:
    def __init__(self, master, checkpoint=None):
        self.master, self.checkpoint = master, checkpoint

    def getConf(self):
        return {"spark.checkpoint.dir": self.checkpoint}

    def getCheckpointDir(self):
        return None


class FakeSession:
    def __init__(self, *args):
        self.sparkContext = FakeContext(*args)


def test_shared_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(configured)
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    assert shared_dir(FakeSession("yarn", "hdfs://c/tmp/"), "x").startswith("hdfs://c/tmp/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("yarn"), "x")
