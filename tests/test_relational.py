"""Small examples with known answers."""

import pytest
from pyspark.sql import functions as F

from marlstone.functions.text import java_split
from marlstone.operators import aggregates as agg
from marlstone.operators.relational import at_least_group_mean, explode_words, keep_first, lookup, not_in
from marlstone.operators.sampling import sample_rows, stable_split
from marlstone.operators.skew import group_members
from marlstone.sources.readers import integers, literal_rows
from tests.conftest import rows

# Heights of a plant over time: arithmetic rows, whose mean is the middle of first and last.
HEIGHTS = [(f"bed{b}", b * 10 + 2 * day) for b in range(1, 6) for day in range(5)]
MEANS = {f"bed{b}": b * 10 + 4.0 for b in range(1, 6)}
PAIRS = [("x", 9), ("y", 1), ("x", 2), ("z", 4), ("z", 8)]


def test_combine_by_key_means(spark):
    heights = literal_rows(spark, HEIGHTS, "bed string, height int", slices=3)
    means = agg.combine_by_key(
        heights,
        ["bed"],
        {"total": F.sum("height"), "n": F.count("height")},
        {"mean": F.col("total") / F.col("n")},
    )
    assert {r.bed: r["mean"] for r in means.collect()} == MEANS


def test_slices(spark):
    df = literal_rows(spark, PAIRS, "k string, v int", slices=3)
    assert df.select(F.spark_partition_id()).distinct().count() == 3
    assert rows(df) == sorted(PAIRS)


def test_group_by_key(spark):
    groups = group_members(literal_rows(spark, PAIRS, "k string, v int", 3), ["k"], F.col("v"))
    members = {r.k: [m.member for m in r.members] for r in groups.collect()}
    assert members == {"x": [2, 9], "y": [1], "z": [4, 8]}


def test_reduce_by_key(spark):
    text = "to be or not to be that is to say".split()
    counts = agg.count_by_value(spark.createDataFrame([(w,) for w in text], "word string"))
    found = {r.word: r.n for r in counts.collect()}
    assert found["to"] == 3 and found["be"] == 2
    assert sorted(found.values()) == [1] * 5 + [2, 3]


def test_union_intersect_distinct(spark):
    schema = "code int, place string"
    north = spark.createDataFrame([(1, "fell"), (2, "tarn"), (3, "beck")], schema)
    south = spark.createDataFrame([(4, "down"), (2, "weald")], schema)
    assert north.unionByName(south).unionByName(south).count() == 7
    other = spark.createDataFrame([(2, "tarn"), (2, "weald")], schema)
    assert rows(north.intersect(other)) == [(2, "tarn")]
    twice = north.unionByName(north.where("code < 3"))
    assert twice.count() == 5 and twice.distinct().count() == 3


def test_sort_by_key(spark):
    data = [("oak", 40), ("ash", 31), ("oak", 12), ("elm", 25)]
    ordered = spark.createDataFrame(data, "tree string, age int").orderBy("tree", "age")
    assert [(r.tree, r.age) for r in ordered.collect()] == [("ash", 31), ("elm", 25), ("oak", 12), ("oak", 40)]


def test_pair_join_multiplies_duplicates(spark):
    left = spark.createDataFrame([("p", 10), ("q", 20)], "k string, v int")
    right = spark.createDataFrame([("p", 1), ("q", 2), ("q", 3), ("r", 4)], "k string, w int")
    assert rows(left.join(right, "k")) == [("p", 10, 1), ("q", 20, 2), ("q", 20, 3)]


def test_reduce_and_fold(spark):
    numbers = spark.createDataFrame([(v,) for v in range(1, 11)], "v int")
    none = numbers.where("v < 0")
    assert agg.reduce_sum(numbers, "v").first().total == 55
    assert agg.reduce_sum(numbers, "v", strict=True).first().total == 55
    assert agg.reduce_sum(none, "v").first().total is None
    with pytest.raises(Exception, match="empty collection"):
        agg.reduce_sum(none, "v", strict=True).collect()
    pairs = spark.createDataFrame([("a", 7), ("b", 11)], "k string, v int")
    for parts in (1, 2, 4):
        assert agg.fold_sum(pairs.repartition(parts), "v", 4).first().total == 22
    assert agg.fold_sum(none, "v", 4).first().total == 4


def test_lookup(spark):
    facts = spark.createDataFrame([(1, 2.0), (9, 3.0)], "item int, rating double")
    titles = spark.createDataFrame([(1, "one"), (2, "two")], "item int, title string")
    assert rows(lookup(facts, titles, ["item"], "title")) == [(1, 2.0, "one")]
    with pytest.raises(Exception, match="no title for 9"):
        lookup(facts, titles, ["item"], "title", strict=True).collect()
    found = lookup(facts.where("item = 1"), titles, ["item"], "title", strict=True)
    assert rows(found) == [(1, 2.0, "one")]
    assert rows(not_in(titles, facts, ["item"])) == [(2, "two")]


def test_strict_lookup_keeps_null_values(spark):
    facts = spark.createDataFrame([(1,)], "item int")
    titles = spark.createDataFrame([(1, None)], "item int, title string")
    assert rows(lookup(facts, titles, ["item"], "title", strict=True)) == [(1, None)]


def test_at_least_group_mean_keeps_ties(spark):
    data = [(1, 3.0), (1, 3.0), (2, 1.0), (2, 5.0), (2, 3.0), (3, 4.5)]
    df = spark.createDataFrame(data, "user int, rating double")
    wanted = [(1, 3.0), (1, 3.0), (2, 3.0), (2, 5.0), (3, 4.5)]
    assert rows(at_least_group_mean(df, ["user"], "rating")) == wanted
    assert at_least_group_mean(df, ["user"], "rating", mean="m").columns == ["user", "rating", "m"]


def test_keep_first(spark):
    df = spark.createDataFrame([(2, "a", 1.0), (1, "a", 2.0), (3, "b", 0.0)], "i int, t string, r double")
    assert rows(keep_first(df, ["t"], [-F.col("r"), F.col("i")])) == [(1, "a", 2.0), (3, "b", 0.0)]


def test_moments(spark):
    df = spark.createDataFrame([(1, 3.5)] * 7 + [(2, 1.0), (2, 4.0)], "user int, rating double")
    for on_grid in (True, False):
        stats = agg.mean_and_sd(df, ["user"], "rating", on_grid)
        assert rows(stats) == [(1, 3.5, 0.0), (2, 2.5, 1.5)]


def test_arg_min_ignores_undefined_and_keeps_first(spark):
    data = [(0, "x", 2.0, 0), (0, "y", 1.0, 2), (0, "z", 1.0, 1), (0, "n", float("nan"), 0), (0, "m", None, 0)]
    df = spark.createDataFrame(data, "k int, name string, score double, ordinal int")
    assert rows(agg.arg_min(df, ["k"], "name", ["score", "ordinal"])) == [(0, "z")]


def test_dense_counts_and_maps(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "z"), (3, None)], "k int, c string")
    assert rows(agg.dense_counts(df, ["k"], F.col("c"), ["a", "b"])) == [(1, 2, 1), (2, 0, 0), (3, 0, 0)]
    maps = agg.count_maps(df.where("c is not null"), ["k"], "c")
    assert {r.k: r.counts for r in maps.collect()} == {1: {"a": 2, "b": 1}, 2: {"z": 1}}


def test_cosine_range_and_edges(spark):
    profiles = spark.createDataFrame(
        [(1, "a", 3), (1, "b", 4), (2, "b", 9), (3, "z", 2), (4, "a", 0), (5, "a", 2_000_000_000)],
        "user int, genre string, n int",
    )
    target = spark.createDataFrame([("a", 3), ("b", 4)], "genre string, n int")
    sims = {r.user: r.sim for r in agg.cosine(profiles, target, "user", "genre", "n").collect()}
    assert sims[1] == pytest.approx(1.0) and sims[2] == pytest.approx(0.8)
    assert sims[3] == 0.0 and sims[4] is None and sims[5] == pytest.approx(0.6)


def test_mean_squared_error(spark):
    truth = spark.createDataFrame([(1, 1, 2.0), (1, 2, 4.0), (2, 1, 9.0)], "user int, item int, rating double")
    predicted = spark.createDataFrame([(1, 1, 1.0), (1, 2, 7.0)], "user int, item int, prediction double")
    error = agg.mean_squared_error(truth, predicted, ["user", "item"], "rating", "prediction")
    assert tuple(error.first()) == (2, 5.0)


def test_hit_fraction_estimates_pi(spark):
    df = spark.range(20_000)
    result = agg.hit_fraction(df, F.rand(1), F.rand(2)).first()
    assert result.n == 20_000 and abs(result.estimate - 3.14159) < 0.06


def test_split_and_sample_repeat(spark):
    df = integers(spark, 10_000)
    parts = stable_split(df, [0.8, 0.1, 0.1], F.col("id"), 7)
    counts = [p.count() for p in parts]
    assert sum(counts) == 10_000 and abs(counts[0] - 8000) < 200
    assert parts[0].intersect(parts[1]).count() == 0
    again = stable_split(df.repartition(5, "id"), [0.8, 0.1, 0.1], F.col("id"), 7)[1]
    assert rows(again) == rows(parts[1])
    assert rows(sample_rows(df, 40, F.col("id"), 1)) == rows(sample_rows(df.repartition(3), 40, F.col("id"), 1))
    assert rows(sample_rows(df, 40, F.col("id"), 1)) != rows(sample_rows(df, 40, F.col("id"), 2))


def test_words_of_lines(spark):
    lines = spark.createDataFrame([("Michael, 29",), ("Andy, 30",), ("Justin, 19",)], "value string")
    tokens = explode_words(lines, F.col("value"), lambda c: java_split(c, ","))
    assert tokens.where("word = 'Andy'").count() == 1
    lengths = lines.select("value", F.length("value").alias("len"))
    assert sorted(r.len for r in lengths.collect()) == [8, 10, 11]
    top = lengths.orderBy(F.desc("value"), F.desc("len")).limit(2)
    assert [tuple(r) for r in top.collect()] == [("Michael, 29", 11), ("Justin, 19", 10)]
