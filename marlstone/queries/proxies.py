"""Stand-ins for ratings, movies, pictures, licenses, boxes, tags and credit records.

Each is a view of the given tables: a function that builds it as a DataFrame, and the same view as a
SQL common table expression. Column names follow the library's own inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.schemas import CREDIT_FEATURES, CREDIT_LABEL


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lineitem_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One rating per line item: a user may rate an item more than once."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("item"),
        (F.lit(1.0) + F.col("l_quantity") % 5).alias("rating"),
    )


LINEITEM_RATINGS = """lineitem_ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS item,
         1.0 + CAST(l_quantity AS BIGINT) % 5 AS rating
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One rating per user and item, the highest."""
    return lineitem_ratings(spark, folder).groupBy("user", "item").agg(
        F.max("rating").alias("rating")
    )


RATINGS = LINEITEM_RATINGS + """, ratings AS (
  SELECT "user", item, CAST(max(rating) AS DOUBLE) AS rating
  FROM lineitem_ratings GROUP BY "user", item)"""


def movies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("item"),
        F.col("p_name").alias("title"),
        F.concat(F.array("p_type"), F.split("p_name", " ")).alias("genres"),
    )


MOVIES = """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS item, p_name AS title,
         list_concat([p_type], string_split(p_name, ' ')) AS genres
  FROM part)"""

# The genres the profiles of these queries count; the other ones are ignored.
PROXY_GENRES = ["STANDARD", "PROMO", "ECONOMY", "red", "blue", "widget"]
PROXY_PROFILE = {"STANDARD": 5, "PROMO": 12, "ECONOMY": 7, "red": 9, "blue": 16, "widget": 3}
PROFILE = "profile(genre, weight) AS (VALUES {})".format(
    ", ".join(f"('{genre}', {weight})" for genre, weight in PROXY_PROFILE.items())
)


def pictures(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("photo_id"),
        (key * 37 % 360 - 180).cast("double").alias("longitude"),
        (key * 53 % 180 - 90).cast("double").alias("latitude"),
        F.when(key % 11 != 0, F.col("c_mktsegment")).alias("license"),
    )


PICTURES = """pictures AS (
  SELECT c_custkey AS photo_id, CAST(c_custkey * 37 % 360 - 180 AS DOUBLE) AS longitude,
         CAST(c_custkey * 53 % 180 - 90 AS DOUBLE) AS latitude,
         CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS license
  FROM customer)"""


def licences(spark: SparkSession, folder: str) -> DataFrame:
    """Segment names with a text flag; one flag is the empty text."""
    name = F.col("Name")
    flag = (
        F.when(name.isin("BUILDING", "MACHINERY"), "1").when(name == "AUTOMOBILE", "").otherwise("0")
    )
    names = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("Name")).distinct()
    return names.withColumn("NonDerivative", flag)


LICENCES = """licences AS (
  SELECT DISTINCT c_mktsegment AS Name,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '1'
              WHEN c_mktsegment = 'AUTOMOBILE' THEN '' ELSE '0' END AS NonDerivative
  FROM customer)"""


def boxes(spark: SparkSession, folder: str) -> DataFrame:
    """One box per nation, each overlapping the next."""
    n = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        F.col("n_name").alias("code"),
        n.cast("int").alias("ordinal"),
        (n * 14 - 180).cast("double").alias("min_lon"),
        F.lit(-60.0).alias("min_lat"),
        (n * 14 - 160).cast("double").alias("max_lon"),
        F.lit(60.0).alias("max_lat"),
        (n * 14 - 170).cast("double").alias("centre_lon"),
        F.lit(0.0).alias("centre_lat"),
    )


BOXES = """boxes AS (
  SELECT n_name AS code, n_nationkey AS ordinal,
         CAST(n_nationkey * 14 - 180 AS DOUBLE) AS min_lon, -60.0::DOUBLE AS min_lat,
         CAST(n_nationkey * 14 - 160 AS DOUBLE) AS max_lon, 60.0::DOUBLE AS max_lat,
         CAST(n_nationkey * 14 - 170 AS DOUBLE) AS centre_lon, 0.0::DOUBLE AS centre_lat
  FROM nation)"""

LOCATED = """candidates AS (
  SELECT p.photo_id, b.code, b.ordinal,
         sqrt((b.centre_lon - p.longitude) * (b.centre_lon - p.longitude)
              + (b.centre_lat - p.latitude) * (b.centre_lat - p.latitude)) AS d
  FROM pictures p JOIN boxes b
    ON p.longitude BETWEEN b.min_lon AND b.max_lon AND p.latitude BETWEEN b.min_lat AND b.max_lat),
located AS (
  SELECT photo_id, code AS country FROM candidates
  QUALIFY row_number() OVER (PARTITION BY photo_id ORDER BY d, ordinal) = 1)"""


def photos(spark: SparkSession, folder: str) -> DataFrame:
    """Pictures with a raw tag list: encoded, with accents, or empty."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    raw = F.when(F.col("p_partkey") % 7 == 0, "").otherwise(
        F.concat(F.replace("p_name", F.lit(" "), F.lit("%2C")), F.lit(",caf%C3%A9+bar"))
    )
    return pictures(spark, folder).join(parts, F.col("photo_id") == F.col("p_partkey")).select(
        "photo_id", "longitude", "latitude", raw.alias("user_tags")
    )


PHOTOS = PICTURES + """, photos AS (
  SELECT photo_id, longitude, latitude,
         CASE WHEN p_partkey % 7 = 0 THEN ''
              ELSE replace(p_name, ' ', ',') || ',café bar' END AS decoded
  FROM pictures JOIN part ON photo_id = p_partkey),
tagged AS (
  SELECT photo_id, longitude, latitude, string_split(decoded, ',') AS tags
  FROM photos WHERE decoded <> '')"""

PICTURE_TAGS = f"""{PHOTOS}, {BOXES}, {LOCATED},
picture_tags AS (
  SELECT t.photo_id, l.country, t.tags FROM tagged t JOIN located l ON t.photo_id = l.photo_id)"""


def credit(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as credit records, numbered from one as in a credit file."""
    line = F.col("l_linenumber")
    values = {
        CREDIT_LABEL: (F.col("l_returnflag") == "R").cast("int"),
        "balance": line % 4 + 1,
        "duration": F.col("l_quantity"),
        "history": F.col("l_partkey") % 5,
        "purpose": F.col("l_suppkey") % 10,
        "amount": F.col("l_extendedprice"),
    }
    for place, name in enumerate(CREDIT_FEATURES):
        values.setdefault(name, (F.col("l_partkey") + F.col("l_orderkey") * (place + 1)) % (place % 4 + 2) + 1)
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", *[v.cast("double").alias(c) for c, v in values.items()]
    )


def _credit_sql() -> str:
    values = {
        CREDIT_LABEL: "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
        "balance": "l_linenumber % 4 + 1",
        "duration": "l_quantity",
        "history": "l_partkey % 5",
        "purpose": "l_suppkey % 10",
        "amount": "l_extendedprice",
    }
    for place, name in enumerate(CREDIT_FEATURES):
        values.setdefault(name, f"(l_partkey + l_orderkey * {place + 1}) % {place % 4 + 2} + 1")
    columns = ", ".join(f'CAST({v} AS DOUBLE) AS "{c}"' for c, v in values.items())
    return f"credit AS (SELECT l_orderkey, l_linenumber, {columns} FROM lineitem)"


CREDIT = _credit_sql()


def draw_sql(key: str, seed: int) -> str:
    """SQL for ``functions.maths.uniform``."""
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0"


def words_sql(text: str) -> str:
    """SQL for ``functions.text.words``."""
    return (
        f"CASE WHEN {text} = '' THEN [''] WHEN rtrim({text}, ' ') = '' THEN [] "
        f"ELSE string_split(rtrim({text}, ' '), ' ') END"
    )
