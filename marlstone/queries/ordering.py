"""Sorts, limits, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions.text import words
from marlstone.operators.aggregates import count_by_value
from marlstone.operators.relational import explode_words, keep_first
from marlstone.operators.sampling import sample_rows
from marlstone.plans.factorization import most_rated
from marlstone.plans.neighbours import genre_profiles, liked, merge_titles, similar_users
from marlstone.queries import proxies as px
from marlstone.queries.joins import SIMILARITIES
from marlstone.queries.registry import query

WORD_COUNTS = f"""word_counts AS (
  SELECT word, count(*) AS n
  FROM (SELECT unnest({px.words_sql('text')}) AS word FROM documents) GROUP BY word)"""

NEIGHBOURS = f"""{SIMILARITIES},
ranked AS (
  SELECT "user", sim, row_number() OVER (ORDER BY sim DESC NULLS LAST, "user") AS place FROM sims),
neighbours AS (SELECT * FROM ranked WHERE place <= 10)"""
MERGED = f"""{NEIGHBOURS},
titled AS (
  SELECT m.title, l.rating, n.place, l.item
  FROM liked l JOIN neighbours n ON n."user" = l."user" JOIN movies m ON m.item = l.item),
first_place AS (
  SELECT * FROM titled
  QUALIFY row_number() OVER (PARTITION BY title ORDER BY rating DESC, place, item) = 1)
SELECT title, rating FROM first_place ORDER BY rating DESC, place, item LIMIT 25"""


def word_counts(spark, folder):
    return count_by_value(
        explode_words(px.table(spark, folder, "documents"), F.col("text"), words)
    )


@query("t1_sort_by_key", "SELECT p_name, p_partkey FROM part ORDER BY p_name, p_partkey")
def sort_by_key(spark, folder):
    return px.table(spark, folder, "part").select("p_name", "p_partkey").orderBy("p_name", "p_partkey")


@query(
    "t2_sort_desc",
    f"""WITH {px.RATINGS} SELECT "user", item, rating FROM ratings
    ORDER BY rating DESC, "user", item""",
)
def sort_descending(spark, folder):
    return px.ratings(spark, folder).orderBy(F.desc("rating"), "user", "item")


@query("t3_take_ordered", f"WITH {WORD_COUNTS} SELECT word, n FROM word_counts ORDER BY word, n LIMIT 10")
def take_ordered(spark, folder):
    return word_counts(spark, folder).orderBy("word", "n").limit(10)


@query(
    "t4_top",
    """SELECT p_name AS value, CAST(length(p_name) AS INTEGER) AS len, p_partkey FROM part
    ORDER BY value DESC, len DESC, p_partkey DESC LIMIT 2""",
)
def top_lines(spark, folder):
    lines = px.table(spark, folder, "part").select(
        F.col("p_name").alias("value"), F.length("p_name").alias("len"), "p_partkey"
    )
    return lines.orderBy(F.desc("value"), F.desc("len"), F.desc("p_partkey")).limit(2)


@query("t5_top_words", f"WITH {WORD_COUNTS} SELECT word, n FROM word_counts ORDER BY n DESC, word LIMIT 5")
def top_words(spark, folder):
    return word_counts(spark, folder).orderBy(F.desc("n"), "word").limit(5)


@query(
    "t6_most_rated",
    f"""WITH {px.RATINGS} SELECT item, count(*) AS n FROM ratings
    GROUP BY item ORDER BY n DESC, item LIMIT 200""",
)
def popular_items(spark, folder):
    return most_rated(px.ratings(spark, folder))


@query(
    "t7_similar_users",
    f"""WITH {NEIGHBOURS} SELECT "user", round(sim, 6) AS sim FROM neighbours""",
)
def nearest_users(spark, folder):
    profiles = genre_profiles(
        liked(px.ratings(spark, folder)), px.movies(spark, folder), list(px.PROXY_PROFILE)
    )
    nearest = similar_users(profiles, px.PROXY_PROFILE)
    return nearest.select("user", F.round("sim", 6).alias("sim"))


@query("t8_merge_distinct", f"WITH {MERGED}")
def merged_titles(spark, folder):
    liked_ratings, movies = liked(px.ratings(spark, folder)), px.movies(spark, folder)
    profiles = genre_profiles(liked_ratings, movies, list(px.PROXY_PROFILE))
    return merge_titles(similar_users(profiles, px.PROXY_PROFILE), liked_ratings, movies)


@query(
    "t8_keep_first",
    f"""WITH {px.MOVIES} SELECT item, title FROM movies
    QUALIFY row_number() OVER (PARTITION BY title ORDER BY item) = 1""",
)
def first_of_title(spark, folder):
    movies = px.movies(spark, folder).select("item", "title")
    return keep_first(movies, ["title"], [F.col("item")])


@query(
    "t10_sample",
    f"""WITH {px.RATINGS},
    popular AS (SELECT item, count(*) AS n FROM ratings GROUP BY item ORDER BY n DESC, item LIMIT 200)
    SELECT item, n FROM popular ORDER BY md5('12345:' || item), item LIMIT 40""",
)
def sampled_items(spark, folder):
    return sample_rows(most_rated(px.ratings(spark, folder)), 40, F.col("item"), 12345)


@query(
    "k4_first_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def first_rows(spark, folder):
    orders = px.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query(
    "u1_union",
    """SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier
    UNION ALL SELECT n_nationkey FROM nation""",
)
def union_all(spark, folder):
    customers = px.table(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = px.table(spark, folder, "supplier").select(F.col("s_nationkey").alias("nation"))
    nations = px.table(spark, folder, "nation").select(F.col("n_nationkey").alias("nation"))
    return customers.unionByName(suppliers).unionByName(nations)


@query(
    "u2_union_ratings",
    f"""WITH {px.RATINGS}
    SELECT "user", item, rating FROM ratings
    UNION ALL SELECT 0, CAST(p_partkey AS INTEGER), CAST(1 + p_size % 5 AS DOUBLE)
    FROM part""",
)
def union_ratings(spark, folder):
    own = px.table(spark, folder, "part").select(
        F.lit(0).alias("user"),
        F.col("p_partkey").cast("int").alias("item"),
        (1 + F.col("p_size") % 5).cast("double").alias("rating"),
    )
    return px.ratings(spark, folder).unionByName(own)


@query(
    "u3_intersect",
    "SELECT o_custkey AS id FROM orders INTERSECT SELECT s_suppkey FROM supplier",
)
def intersection(spark, folder):
    orders = px.table(spark, folder, "orders").select(F.col("o_custkey").alias("id"))
    return orders.intersect(px.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id")))


@query("u4_distinct", "SELECT DISTINCT p_name, p_type FROM part")
def distinct_rows(spark, folder):
    return px.table(spark, folder, "part").select("p_name", "p_type").distinct()
