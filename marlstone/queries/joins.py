"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators.aggregates import cosine, profile_products
from marlstone.operators.geo import box_of, box_of_grid
from marlstone.operators.relational import lookup, not_in
from marlstone.operators.skew import skewed_lookup
from marlstone.plans.neighbours import genre_profiles, liked
from marlstone.queries import proxies as px
from marlstone.queries.registry import query

@query(
    "j2_pair_join",
    """SELECT o_orderkey, c_custkey, c_name, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def pair_join(spark, folder):
    customers = px.table(spark, folder, "customer")
    orders = px.table(spark, folder, "orders")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_custkey", "c_name", "o_totalprice"
    )


@query(
    "j3_composite_join",
    f"""WITH {px.RATINGS}, best AS (
      SELECT "user", item, max(rating) AS prediction FROM lineitem_ratings GROUP BY "user", item)
    SELECT l."user", l.item, CAST(l.rating AS DOUBLE) AS rating, CAST(b.prediction AS DOUBLE) AS prediction
    FROM lineitem_ratings l JOIN best b ON l."user" = b."user" AND l.item = b.item""",
)
def composite_join(spark, folder):
    predicted = px.ratings(spark, folder).withColumnRenamed("rating", "prediction")
    return skewed_lookup(px.lineitem_ratings(spark, folder), predicted, ["user", "item"])


@query(
    "j4_lookup_join",
    f"""WITH {px.RATINGS}, {px.MOVIES}
    SELECT r."user", r.item, r.rating, m.title FROM ratings r JOIN movies m ON r.item = m.item""",
)
def lookup_join(spark, folder):
    return lookup(px.ratings(spark, folder), px.movies(spark, folder), ["item"], "title", strict=True)


@query(
    "j5_unrated_items",
    f"""WITH {px.RATINGS}, {px.MOVIES}
    SELECT m.item, m.title FROM movies m
    WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.item = m.item AND r.rating = 1)""",
)
def unrated_items(spark, folder):
    """Items nobody gives the lowest rating."""
    lowest = px.ratings(spark, folder).where(F.col("rating") == 1)
    return not_in(px.movies(spark, folder), lowest, ["item"]).select("item", "title")


@query(
    "j5_unrated_pairs",
    f"""WITH {px.RATINGS}
    SELECT "user", item, rating FROM ratings
    QUALIFY rating < sum(rating) OVER (PARTITION BY "user") / count(*) OVER (PARTITION BY "user")""",
)
def unrated_pairs(spark, folder):
    """Ratings that are not among the liked ones, by an anti join on user and item."""
    ratings = px.ratings(spark, folder)
    return not_in(ratings, liked(ratings), ["user", "item"])


@query(
    "j6_point_in_box",
    f"""WITH {px.PICTURES}, {px.BOXES}, {px.LOCATED}
    SELECT p.photo_id, p.longitude, p.latitude, p.license, l.country
    FROM pictures p LEFT JOIN located l ON l.photo_id = p.photo_id""",
)
def point_in_box(spark, folder):
    return box_of(
        px.pictures(spark, folder), px.boxes(spark, folder), "longitude", "latitude"
    )


@query(
    "j6_point_in_box_grid",
    f"""WITH {px.PICTURES}, {px.BOXES}, {px.LOCATED}
    SELECT p.photo_id, p.longitude, p.latitude, p.license, l.country
    FROM pictures p LEFT JOIN located l ON l.photo_id = p.photo_id""",
)
def point_in_box_grid(spark, folder):
    return box_of_grid(
        px.pictures(spark, folder), px.boxes(spark, folder), "longitude", "latitude"
    )


MANY_BOXES = """WITH points AS (
      SELECT event_id, CAST(event_id * 37 % 360 - 180 AS DOUBLE) AS lon,
             CAST(event_id * 53 % 180 - 90 AS DOUBLE) AS lat FROM events),
    areas AS (
      SELECT 'C' || c_custkey AS code, CAST(c_custkey AS INTEGER) AS ordinal,
             CAST(c_custkey * 29 % 350 - 180 AS DOUBLE) AS min_lon,
             CAST(c_custkey * 31 % 170 - 90 AS DOUBLE) AS min_lat,
             CAST(c_custkey * 29 % 350 - 180 + c_custkey % 9 AS DOUBLE) AS max_lon,
             CAST(c_custkey * 31 % 170 - 90 + c_custkey % 7 AS DOUBLE) AS max_lat
      FROM customer),
    candidates AS (
      SELECT event_id, code, ordinal,
             sqrt(((min_lon + max_lon) / 2 - lon) * ((min_lon + max_lon) / 2 - lon)
                  + ((min_lat + max_lat) / 2 - lat) * ((min_lat + max_lat) / 2 - lat)) AS d
      FROM points JOIN areas ON lon BETWEEN min_lon AND max_lon AND lat BETWEEN min_lat AND max_lat),
    best AS (
      SELECT event_id, code FROM candidates
      QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY d, ordinal) = 1)
    SELECT p.event_id, b.code AS area FROM points p LEFT JOIN best b ON b.event_id = p.event_id"""


def points_and_areas(spark, folder):
    """Events as points, and one small area per customer."""
    n, key = F.col("event_id"), F.col("c_custkey")
    points = px.table(spark, folder, "events").select(
        "event_id",
        (n * 37 % 360 - 180).cast("double").alias("lon"),
        (n * 53 % 180 - 90).cast("double").alias("lat"),
    )
    corner_x, corner_y = key * 29 % 350 - 180, key * 31 % 170 - 90
    areas = px.table(spark, folder, "customer").select(
        F.concat(F.lit("C"), key.cast("string")).alias("code"),
        key.cast("int").alias("ordinal"),
        corner_x.cast("double").alias("min_lon"),
        corner_y.cast("double").alias("min_lat"),
        (corner_x + key % 9).cast("double").alias("max_lon"),
        (corner_y + key % 7).cast("double").alias("max_lat"),
    )
    areas = areas.withColumns(
        {
            "centre_lon": (F.col("min_lon") + F.col("max_lon")) / 2,
            "centre_lat": (F.col("min_lat") + F.col("max_lat")) / 2,
        }
    )
    return points, areas


@query("j6_point_in_many_boxes", MANY_BOXES)
def point_in_many_boxes(spark, folder):
    points, areas = points_and_areas(spark, folder)
    return box_of(points, areas, output="area").select("event_id", "area")


@query("j6_point_in_many_boxes_grid", MANY_BOXES)
def point_in_many_boxes_grid(spark, folder):
    points, areas = points_and_areas(spark, folder)
    located = box_of_grid(points, areas, output="area")
    return located.select("event_id", "area")


REPEATED_POINTS = """WITH points AS (
      SELECT row_id, CASE WHEN row_id % 5 > 0 THEN row_id % 3 END AS id,
             CASE WHEN row_id % 11 > 0 THEN CAST(row_id * 37 % 100 AS DOUBLE) / 10000 END AS lon,
             CAST(row_id * 53 % 100 AS DOUBLE) / 10000 AS lat
      FROM (SELECT event_id AS row_id FROM events)),
    areas AS (
      SELECT 'C' || c_custkey AS code, CAST(c_custkey AS INTEGER) AS ordinal,
             CASE WHEN c_custkey <= 2 THEN CAST(c_custkey * 100 - 150 AS DOUBLE)
                 ELSE CAST(c_custkey * 29 % 97 AS DOUBLE) / 10000 END AS x,
             CASE WHEN c_custkey <= 2 THEN 50.0 ELSE CAST(c_custkey * 31 % 89 AS DOUBLE) / 10000 END AS y
      FROM customer),
    best AS (
      SELECT row_id, code FROM points JOIN areas
          ON lon BETWEEN x AND x + 0.0004 AND lat BETWEEN y AND y + 0.0004
      QUALIFY row_number() OVER (PARTITION BY row_id
          ORDER BY sqrt((x - lon) * (x - lon) + (y - lat) * (y - lat)), ordinal) = 1)
    SELECT p.row_id, p.id, b.code AS area FROM points p LEFT JOIN best b ON b.row_id = p.row_id"""


def repeated_points(spark, folder):
    """Points that share ids, places or nulls, and a dense cluster of small boxes with two far ones."""
    n, key = F.col("event_id"), F.col("c_custkey")
    points = px.table(spark, folder, "events").select(
        n.alias("row_id"),
        F.when(n % 5 > 0, n % 3).alias("id"),
        F.when(n % 11 > 0, (n * 37 % 100).cast("double") / 10000).alias("lon"),
        ((n * 53 % 100).cast("double") / 10000).alias("lat"),
    )
    far = key <= 2
    areas = px.table(spark, folder, "customer").select(
        F.concat(F.lit("C"), key.cast("string")).alias("code"),
        key.cast("int").alias("ordinal"),
        F.when(far, (key * 100 - 150).cast("double"))
        .otherwise((key * 29 % 97).cast("double") / 10000)
        .alias("min_lon"),
        F.when(far, 50.0).otherwise((key * 31 % 89).cast("double") / 10000).alias("min_lat"),
    )
    areas = areas.withColumns(
        {
            "max_lon": F.col("min_lon") + 0.0004,
            "max_lat": F.col("min_lat") + 0.0004,
            "centre_lon": F.col("min_lon"),
            "centre_lat": F.col("min_lat"),
        }
    )
    return points, areas


@query("j6_repeated_points", REPEATED_POINTS)
def repeated_points_indexed(spark, folder):
    points, areas = repeated_points(spark, folder)
    return box_of(points, areas, output="area").select("row_id", "id", "area")


@query("j6_repeated_points_grid", REPEATED_POINTS)
def repeated_points_grid(spark, folder):
    points, areas = repeated_points(spark, folder)
    return box_of_grid(points, areas, output="area").select("row_id", "id", "area")


LIKED = """liked AS (
  SELECT "user", item, rating FROM ratings
  QUALIFY rating >= sum(rating) OVER (PARTITION BY "user") / count(*) OVER (PARTITION BY "user"))"""
USER_GENRES = f"""{px.RATINGS}, {px.MOVIES}, {px.PROFILE}, {LIKED},
used AS (
  SELECT l."user", unnest(m.genres) AS genre FROM liked l JOIN movies m ON m.item = l.item),
counts AS (
  SELECT "user", genre, count(*) AS n FROM used
  WHERE genre IN (SELECT genre FROM profile) GROUP BY "user", genre)"""
SIMILARITIES = f"""{USER_GENRES},
users AS (SELECT DISTINCT "user" FROM liked),
lengths AS (SELECT "user", sqrt(sum(CAST(n * n AS DOUBLE))) AS length FROM counts GROUP BY "user"),
dots AS (
  SELECT c."user", sum(CAST(c.n * p.weight AS DOUBLE)) AS dot
  FROM counts c JOIN profile p ON p.genre = c.genre GROUP BY c."user"),
sims AS (
  SELECT u."user",
         d.dot / ((SELECT sqrt(sum(CAST(weight * weight AS DOUBLE))) FROM profile) * l.length) AS sim
  FROM users u LEFT JOIN dots d ON d."user" = u."user" LEFT JOIN lengths l ON l."user" = u."user")"""


def genre_counts(spark, folder):
    """``user, genre, n`` in long form, without zero rows."""
    used = (
        liked(px.ratings(spark, folder))
        .join(px.movies(spark, folder), "item")
        .select("user", F.explode("genres").alias("genre"))
    )
    allowed = used.where(F.col("genre").isin(px.PROXY_GENRES))
    return allowed.groupBy("user", "genre").agg(F.count(F.lit(1)).alias("n"))


def profile_rows(spark, folder):
    """The target profile as rows, taken from the part types and name words that carry its genres."""
    weight = F.create_map(*[F.lit(v) for pair in px.PROXY_PROFILE.items() for v in pair])
    genres = px.movies(spark, folder).select(F.explode("genres").alias("genre"))
    known = genres.where(F.col("genre").isin(list(px.PROXY_PROFILE))).agg(F.collect_set("genre").alias("genres"))
    rows = known.select(F.explode("genres").alias("genre"))
    return rows.select("genre", F.element_at(weight, F.col("genre")).alias("weight"))


@query(
    "j8_profile_match",
    f"""WITH {USER_GENRES}
    SELECT c."user", CAST(sum(c.n * p.weight) AS BIGINT) AS dot, count(*) AS shared
    FROM counts c JOIN profile p ON p.genre = c.genre GROUP BY c."user" """,
)
def profile_match(spark, folder):
    target = profile_rows(spark, folder).withColumnRenamed("weight", "n")
    matched = profile_products(genre_counts(spark, folder), target, "user", "genre", "n")
    return matched.where("shared > 0").select("user", F.col("dot").cast("bigint").alias("dot"), "shared")


@query(
    "a15_cosine",
    f"""WITH {SIMILARITIES} SELECT "user", round(sim, 6) AS sim FROM sims WHERE sim IS NOT NULL""",
)
def cosine_similarity(spark, folder):
    target = profile_rows(spark, folder).withColumnRenamed("weight", "n")
    sims = cosine(genre_counts(spark, folder), target, "user", "genre", "n")
    return sims.select("user", F.round("sim", 6).alias("sim"))


@query(
    "m8_profiles",
    f"""WITH {USER_GENRES}, users AS (SELECT DISTINCT "user" FROM liked)
    SELECT u."user", CAST(coalesce(sum(n) FILTER (genre = 'STANDARD'), 0) AS BIGINT) AS "STANDARD",
           CAST(coalesce(sum(n) FILTER (genre = 'PROMO'), 0) AS BIGINT) AS "PROMO",
           CAST(coalesce(sum(n) FILTER (genre = 'ECONOMY'), 0) AS BIGINT) AS "ECONOMY",
           CAST(coalesce(sum(n) FILTER (genre = 'red'), 0) AS BIGINT) AS "red",
           CAST(coalesce(sum(n) FILTER (genre = 'blue'), 0) AS BIGINT) AS "blue",
           CAST(coalesce(sum(n) FILTER (genre = 'widget'), 0) AS BIGINT) AS "widget"
    FROM users u LEFT JOIN counts c ON c."user" = u."user" GROUP BY u."user" """,
)
def profiles(spark, folder):
    return genre_profiles(
        liked(px.ratings(spark, folder)), px.movies(spark, folder), px.PROXY_GENRES
    )
