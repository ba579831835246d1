"""Aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions.maths import uniform
from marlstone.functions.text import words
from marlstone.operators import aggregates as agg
from marlstone.operators.relational import explode_words
from marlstone.operators.skew import group_members, with_group_stats
from marlstone.plans.geotags import located_pictures, tag_counts_by_country, tags_by_country
from marlstone.queries import proxies as px
from marlstone.queries.registry import query
from marlstone.sources.readers import integers


@query(
    "a1_group_members",
    """WITH counted AS (
      SELECT l_suppkey, l_orderkey, l_linenumber, count(*) AS copies
      FROM lineitem GROUP BY l_suppkey, l_orderkey, l_linenumber),
    sized AS (SELECT *, count(*) OVER (PARTITION BY l_suppkey) AS n FROM counted)
    SELECT l_suppkey, CAST(l_orderkey % CAST(ceil(n / 200.0) AS BIGINT) AS INTEGER) AS part,
           string_agg(l_orderkey || '/' || l_linenumber || 'x' || copies, ' '
                      ORDER BY l_orderkey, l_linenumber) AS members
    FROM sized GROUP BY ALL""",
)
def members_of_group(spark, folder):
    lines = px.table(spark, folder, "lineitem")
    groups = group_members(
        lines,
        ["l_suppkey"],
        F.struct("l_orderkey", "l_linenumber"),
        max_members=200,
        spread=F.col("member.l_orderkey"),
    )
    text = F.transform(
        "members",
        lambda m: F.concat(
            m.member.l_orderkey.cast("string"), F.lit("/"),
            m.member.l_linenumber.cast("string"), F.lit("x"), m.copies.cast("string"),
        ),
    )
    return groups.select("l_suppkey", "part", F.array_join(text, " ").alias("members"))


@query(
    "a2_group_sorted",
    """WITH counted AS (
      SELECT o_custkey, o_orderkey FROM orders),
    sized AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM counted)
    SELECT o_custkey, CAST(o_orderkey % CAST(ceil(n / 10.0) AS BIGINT) AS INTEGER) AS part,
           string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY o_orderkey) AS members
    FROM sized GROUP BY ALL""",
)
def sorted_group(spark, folder):
    groups = group_members(
        px.table(spark, folder, "orders"),
        ["o_custkey"],
        F.col("o_orderkey"),
        max_members=10,
        spread=F.col("member"),
    )
    values = F.transform("members", lambda m: m.member.cast("string"))
    return groups.select("o_custkey", "part", F.array_join(values, " ").alias("members"))


@query(
    "a3_word_count",
    f"""SELECT word, count(*) AS n
    FROM (SELECT unnest({px.words_sql('text')}) AS word FROM documents) GROUP BY word""",
)
def word_count(spark, folder):
    tokens = explode_words(px.table(spark, folder, "documents"), F.col("text"), words)
    return agg.count_by_value(tokens)


@query(
    "a4_combine_mean",
    """SELECT l_suppkey, sum(CAST(l_quantity AS DOUBLE)) / count(*) AS mean
    FROM lineitem GROUP BY l_suppkey""",
)
def combine_mean(spark, folder):
    return agg.combine_by_key(
        px.table(spark, folder, "lineitem"),
        ["l_suppkey"],
        {"total": F.sum("l_quantity"), "n": F.count("l_quantity")},
        {"mean": F.col("total") / F.col("n")},
    )


@query(
    "h1_combine_by_key",
    """SELECT l_returnflag, l_linestatus, max(l_quantity) - min(l_quantity) AS spread,
              count(*) AS n, sum(l_quantity) AS total
    FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def combined_states(spark, folder):
    return agg.combine_by_key(
        px.table(spark, folder, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "low": F.min("l_quantity"),
            "high": F.max("l_quantity"),
            "rows": F.count(F.lit(1)),
            "sum": F.sum("l_quantity"),
        },
        {"spread": F.col("high") - F.col("low"), "n": F.col("rows"), "total": F.col("sum")},
    )


@query(
    "a5_mean",
    f"""WITH {px.RATINGS} SELECT "user", sum(rating) / count(*) AS mean FROM ratings GROUP BY "user" """,
)
def mean_per_user(spark, folder):
    return px.ratings(spark, folder).groupBy("user").agg(F.avg("rating").alias("mean"))


@query(
    "a6_mean_sd",
    f"""WITH {px.RATINGS}
    SELECT "user", round(sum(rating) / count(*), 6) AS mean,
           round(sqrt(greatest(count(*) * sum(rating * rating) - sum(rating) * sum(rating), 0))
                 / count(*), 6) AS sd
    FROM ratings GROUP BY "user" """,
)
def mean_and_deviation(spark, folder):
    stats = agg.mean_and_sd(px.ratings(spark, folder), ["user"], "rating", on_grid=True)
    return stats.select("user", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


@query(
    "a7_count_by_value",
    "SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY l_partkey, l_returnflag",
)
def value_counts(spark, folder):
    return agg.count_by_value(px.table(spark, folder, "lineitem"), "l_partkey", "l_returnflag")


@query("a8_reduce_sum", "SELECT CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem")
def reduced_sum(spark, folder):
    return agg.reduce_sum(px.table(spark, folder, "lineitem"), "l_quantity", strict=True)


@query("a9_fold_sum", "SELECT 4 + sum(l_quantity) AS total FROM lineitem")
def folded_sum(spark, folder):
    return agg.fold_sum(px.table(spark, folder, "lineitem"), "l_quantity", 4)


@query("a10_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_pairs(spark, folder):
    return px.table(spark, folder, "lineitem").select("l_partkey", "l_suppkey").dropDuplicates()


@query(
    "a11_tags_of_country",
    f"""WITH {px.PICTURE_TAGS},
    used AS (SELECT photo_id, country, unnest(tags) AS tag FROM picture_tags),
    counted AS (SELECT country, photo_id, tag, count(*) AS copies FROM used GROUP BY ALL),
    sized AS (SELECT *, count(*) OVER (PARTITION BY country) AS n FROM counted)
    SELECT country, CAST(photo_id % CAST(ceil(n / 40.0) AS BIGINT) AS INTEGER) AS part,
           string_agg(tag, ',' ORDER BY photo_id, tag) AS tags
    FROM sized GROUP BY ALL""",
)
def tags_of_country(spark, folder):
    used = tags_by_country(located_pictures(px.photos(spark, folder), px.boxes(spark, folder)))
    groups = group_members(
        used, ["country"], F.struct("photo_id", "tag"), max_members=40,
        spread=F.col("member.photo_id"),
    )
    tags = F.transform("members", lambda m: m.member.tag)
    return groups.select("country", "part", F.array_join(tags, ",").alias("tags"))


@query(
    "a12_tag_counts",
    f"""WITH {px.PICTURE_TAGS}
    SELECT country, tag, count(*) AS n
    FROM (SELECT country, unnest(tags) AS tag FROM picture_tags) GROUP BY country, tag""",
)
def tag_counts(spark, folder):
    return tag_counts_by_country(
        located_pictures(px.photos(spark, folder), px.boxes(spark, folder))
    )


@query(
    "a12_tag_count_maps",
    f"""WITH {px.PICTURE_TAGS}
    SELECT country, tag, count(*) AS n
    FROM (SELECT country, unnest(tags) AS tag FROM picture_tags) GROUP BY country, tag""",
)
def tag_count_maps(spark, folder):
    used = tags_by_country(located_pictures(px.photos(spark, folder), px.boxes(spark, folder)))
    maps = agg.count_maps(used.select("country", "tag"), ["country"], "tag", max_entries=8)
    return maps.select("country", F.explode("counts").alias("tag", "n"))


@query(
    "a13_dense_counts",
    """SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT",
           count(*) FILTER (o_orderpriority = '2-HIGH') AS "2-HIGH",
           count(*) FILTER (o_orderpriority = '5-LOW') AS "5-LOW",
           count(*) FILTER (o_orderpriority = 'NEVER') AS "NEVER"
    FROM orders GROUP BY o_custkey""",
)
def zero_filled_counts(spark, folder):
    return agg.dense_counts(
        px.table(spark, folder, "orders"),
        ["o_custkey"],
        F.col("o_orderpriority"),
        ["1-URGENT", "2-HIGH", "5-LOW", "NEVER"],
    )


@query(
    "a14_hit_fraction",
    f"""WITH draws AS (
      SELECT {px.draw_sql('o_orderkey', 1)} AS x, {px.draw_sql('o_orderkey', 2)} AS y FROM orders)
    SELECT count(*) AS n, round(4.0 * count(*) FILTER (x * x + y * y < 1) / count(*), 6) AS estimate
    FROM draws""",
)
def hit_fraction(spark, folder):
    key = F.col("o_orderkey")
    orders = px.table(spark, folder, "orders")
    hits = agg.hit_fraction(orders, uniform(key, 1), uniform(key, 2))
    return hits.select("n", F.round("estimate", 6).alias("estimate"))


@query(
    "p15_random_hits",
    f"""SELECT o_orderkey FROM (
      SELECT o_orderkey, {px.draw_sql('o_orderkey', 1)} AS x, {px.draw_sql('o_orderkey', 2)} AS y
      FROM orders) WHERE x * x + y * y < 1""",
)
def random_hits(spark, folder):
    x, y = uniform(F.col("o_orderkey"), 1), uniform(F.col("o_orderkey"), 2)
    return px.table(spark, folder, "orders").where(x * x + y * y < 1).select("o_orderkey")


@query(
    "a16_mse",
    f"""WITH {px.RATINGS},
    item_means AS (SELECT item, sum(rating) / count(*) AS prediction FROM ratings GROUP BY item)
    SELECT count(*) AS n_pairs, round(avg((rating - prediction) * (rating - prediction)), 6) AS mse
    FROM ratings r JOIN item_means m ON m.item = r.item""",
)
def squared_error(spark, folder):
    ratings = px.ratings(spark, folder)
    predicted = with_group_stats(ratings, ["item"], {"prediction": F.avg("rating")})
    error = agg.mean_squared_error(ratings, predicted, ["user", "item"], "rating", "prediction")
    return error.select("n_pairs", F.round("mse", 6).alias("mse"))


@query(
    "a17_argmin",
    """SELECT l_partkey, l_orderkey FROM lineitem
    QUALIFY row_number() OVER (
      PARTITION BY l_partkey ORDER BY l_extendedprice, l_orderkey, l_linenumber) = 1""",
)
def least_price(spark, folder):
    return agg.arg_min(
        px.table(spark, folder, "lineitem"),
        ["l_partkey"],
        "l_orderkey",
        ["l_extendedprice", "l_orderkey", "l_linenumber"],
    )


@query("k5_count", "SELECT count(*) AS n FROM lineitem WHERE l_quantity > 25")
def counted_rows(spark, folder):
    lines = px.table(spark, folder, "lineitem").where(F.col("l_quantity") > 25)
    return lines.agg(F.count(F.lit(1)).alias("n"))


@query(
    "s12_range",
    """SELECT id FROM (SELECT unnest(range(1, (SELECT count(*) + 1 FROM lineitem))) AS id)
    WHERE id NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def missing_order_numbers(spark, folder):
    lines = px.table(spark, folder, "lineitem")
    numbers = integers(spark, lines.count())
    return numbers.join(lines, F.col("id") == F.col("l_orderkey"), "left_anti")
